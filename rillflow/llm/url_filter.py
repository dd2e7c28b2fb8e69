"""URL filters: a sorted array of 64-bit digests, memory-mapped and probed by vectorised binary search.

The listed strings (hosts, or host plus path) become a digest index (see digests). A probing task takes the digests of
a url's host, of its parent domains and of host plus path, searches the sorted keys for all of a batch at once, and
confirms each equal key against the stored string, so a digest collision never blocks a url.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm import digests
from rillflow.llm.common import LOWER, UPPER

#: Allow and block rules (verdict, host, path); the longest that fits decides before the digest list does.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: The unwanted sites of the query's list, each under three domains; their subdomains are listed with them.
SITES, DOMAINS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm"), ("example.com", "example.net", "example.org")


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ?, # or the end; empty for null or without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls without one. Longest: by the rule's text, host plus path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def unwanted(pages: DataFrame, sites=SITES, domains=DOMAINS, rules=RULES, url: str = "url") -> DataFrame:
    """entry: the unwanted sites, the hosts of pages under them, and the full urls (host plus path) of pages that a rule
    blocks: a list that grows with the pages."""
    hosts = [f"{s}.{d}" for s in sites for d in domains]
    own = pages.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    under = F.exists(F.array(*[F.lit(h) for h in hosts]), lambda h: (F.col("host") == h) | F.col("host").endswith(F.concat(F.lit("."), h)))
    _, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    seen = own.select(F.when(verdict == "block", F.concat("host", "path")).when(under, F.col("host")).alias("entry")).where("entry is not null")
    return pages.sparkSession.range(1).select(F.explode(F.array(*[F.lit(h) for h in hosts])).alias("entry")).unionByName(seen).distinct()


def write_index(entries: DataFrame, column: str) -> str:
    """Writes the distinct non-empty strings of a column as a digest index; returns its folder.

    Null and empty entries are left out, repeated ones count once. An empty table gives an index without entries.
    """
    rows = entries.select(F.col(column).alias("entry")).where("entry is not null and entry <> ''").distinct()
    return digests.write(rows.withColumn("digest", F.xxhash64("entry")), rows.count(), "url-index")


def candidates(host: bytes, path: bytes, longest: int) -> list[bytes]:
    """What of a url may be listed, first what names it most narrowly as a host: the host, its parent domains, host
    plus path. Strings longer than the longest entry can't be; they are not even made, so a host of any number of
    labels takes time in proportion to its length."""
    out, at = [], len(host)
    while at > 0 and len(host) - (at := host.rfind(b".", 0, at) + 1) <= longest:
        out.append(host[at:])
        at -= 1
    if host and at == 0 and len(host) <= longest:  # a host that starts with a full stop
        out.append(host)
    whole = host + path
    return out[::-1] + ([whole] if path and len(whole) <= longest else [])


def filter_urls(pages: DataFrame, index: str, rules=RULES, url: str = "url", key: str = "page_id") -> DataFrame:
    """key, host, path, rule, verdict, listed (the entry that blocked it) for every row.

    A url is listed if its host, a parent domain of it, or host plus path is an entry. Null urls and urls without ://
    have empty host and path, fit no rule and are allowed; urls of any length are judged whole; repeated rows are
    judged one by one; an empty table gives an empty result; other columns of pages, whatever their names, are not
    read.
    """
    rows = pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        listing = digests.Index(index)
        for batch in batches:
            owner, asked = [], []
            for i, (host, path) in enumerate(zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)):
                some = candidates(host.encode(), path.encode(), listing.longest)
                owner += [i] * len(some)
                asked += some
            found = np.array([xxhash.xxh64_intdigest(x, 42) for x in asked], np.uint64).view(np.int64)
            listed: list[str | None] = [None] * batch.num_rows
            for i in listing.found(found).tolist():
                if listed[owner[i]] is None and asked[i] in listing.entries(int(found[i])):
                    listed[owner[i]] = asked[i].decode()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "host", "path")), pa.array(listed, pa.string())], names=["key", "host", "path", "listed"])

    judged = rows.mapInArrow(judge, f"key {rows.schema['key'].dataType.simpleString()}, host string, path string, listed string")
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed").isNotNull(), "block").otherwise("allow")
    return judged.select(F.col("key").alias(key), "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "listed")

