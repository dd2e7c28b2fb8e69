"""Quality rules: the log-likelihood ratio of hashed word n-grams between a trusted target and the raw corpus.

Words and pairs of neighbouring words are hashed to a fixed number of buckets. Two multinomials are estimated over the
buckets, one from trusted documents and one from all; a document's score is the mean log ratio of its n-grams. The
threshold comes with the fit: the score below which a stated share of the trusted documents lies; it decides about every
document. Texts fall into two folds by their hash, and a text is scored by the weights that the other fold's trusted
documents gave, so a trusted document's own words don't raise its score (nor those of its copies). Fixed rules on whole
texts (word count, repeated windows) come first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from rillflow.llm.common import BLANKS, staged

#: Buckets of either multinomial; its weights are part of the plan and their number does not grow with the data.
BUCKETS = 1 << 14
#: Added to each bucket of both sides: a share of a bucket's mean count, so that it means the same at every size.
SMOOTHING = 0.2
#: The share of trusted documents that may lie below the threshold, and the grid that thresholds lie on.
LOST, STEP = 0.002, 0.001
LEAST_WORDS, MOST_REPEATED = 50, 50
#: A set of integer ids is held as bitmaps of 4 KB for 32,768 ids each, which are broadcast up to so many bytes.
BITMAP, SENT = 4096, 64 << 20
SYMBOLS = r"[#*$%&|<>]"


def words_of(text: Column) -> Column:
    """Words by ASCII white space; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS))


def buckets(words: Column, n: int = BUCKETS) -> Column:
    """The bucket of each word and of each pair of neighbours, as one array."""
    at = lambda *w: F.pmod(F.xxhash64(*w), F.lit(n)).cast("int")
    single = F.transform(words, lambda w: at(w))
    pairs = F.transform(words, lambda w, i: at(w, F.get(words, i + 1)))
    return F.concat(single, F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(0))))


def fold(text: Column) -> Column:
    """0 or 1, by a hash of the text."""
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(2)).cast("int")


def marked(documents: DataFrame, trusted: DataFrame) -> DataFrame:
    """doc_id, text, _trusted (whether trusted has the doc_id; false for null) of every document.

    Integer ids become bitmaps, 64 times as dense as the ids, so that the texts need not be shuffled to meet them until
    a corpus has some 500 million documents; beyond that, and for ids of other types, ids are joined by a shuffle.
    """
    ids = trusted.select(F.col("doc_id").alias("_id")).where("_id is not null").distinct()
    rows = documents.select("doc_id", "text")
    if isinstance(documents.schema["doc_id"].dataType, IntegralType) and isinstance(trusted.schema["doc_id"].dataType, IntegralType):
        at = F.bitmap_bit_position("_id")
        bits = staged(ids.groupBy(F.bitmap_bucket_number("_id").alias("_bucket")).agg(F.bitmap_construct_agg(at).alias("_bits")), "trusted-ids")
        if bits.count() * BITMAP <= SENT:
            met = rows.withColumn("_bucket", F.bitmap_bucket_number("doc_id")).join(F.broadcast(bits), "_bucket", "left")
            place = F.bitmap_bit_position("doc_id")
            byte = F.conv(F.hex(F.substring("_bits", (place / 8 + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            return met.select("doc_id", "text", F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False)).alias("_trusted"))
    return rows.join(ids, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "text", F.col("_id").isNotNull().alias("_trusted"))


def fit(documents: DataFrame, trusted: DataFrame, n: int = BUCKETS) -> list[list[float]]:
    """The log ratio of each bucket, for texts of fold 0 and of fold 1. trusted: doc_id of trusted documents, all of
    which count, in the fold that they aren't in themselves.

    Counts of the raw side are over every document. Smoothing keeps every ratio finite; without trusted documents all
    are 0. The counts that reach the driver are one row per bucket.
    """
    words = marked(documents, trusted).select("_trusted", fold(F.col("text")).alias("f"), words_of(F.col("text")).alias("w"))
    grams = words.select(*[F.when(F.col("_trusted") & (F.col("f") != k), 1).otherwise(0).alias(f"t{k}") for k in (0, 1)], F.explode(buckets(F.col("w"), n)).alias("b"))
    found = {r.b: r for r in grams.groupBy("b").agg(F.count("*").alias("raw"), F.sum("t0").alias("t0"), F.sum("t1").alias("t1")).collect()}
    raw = sum(r.raw for r in found.values())

    def weights(k: str) -> list[float]:
        target = sum(r[k] for r in found.values())
        more = SMOOTHING * target / n
        # Both multinomials at the target's size, so that a bucket that either side hardly saw says nothing.
        return [math.log((r[k] + more) / (r.raw * target / raw + more)) if target and (r := found.get(b)) else 0.0 for b in range(n)]

    return [weights("t0"), weights("t1")]


def score(documents: DataFrame, weights: list[list[float]]) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio of every document.

    ratio is the sum of the weights of a document's n-grams divided by their number. A null or empty text has no words
    and fails the base rules; its ratio is 0. Repeated rows are judged one by one; other columns are not read. Words of
    any length and lines of any number are handled; nothing is shuffled. The result is a written table: filters on it
    must not be pushed below the expressions, which would then be evaluated once for each use.
    """
    n = len(weights[0])
    tables = [F.split(F.lit(",".join(f"{w:.9g}" for w in one)), ",").cast("array<double>") for one in weights]
    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", text.alias("text"), words_of(F.col("text")).alias("w"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    triples = F.transform("w", lambda w, i: F.xxhash64(w, F.get("w", i + 1), F.get("w", i + 2)))
    rows = rows.select("doc_id", "text", "w", F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"), F.coalesce(F.regexp_count("text", F.lit(SYMBOLS)), F.lit(0)).cast("long").alias("n_symbols"), lines.alias("lines"), F.slice(triples, 1, F.greatest(F.size("w") - 2, F.lit(0))).alias("h"), buckets(F.col("w"), n).alias("b"))
    rows = rows.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    total = lambda one: F.aggregate("b", F.lit(0.0), lambda x, b: x + F.get(one, b))
    ratio = F.when(fold(F.col("text")) == 0, total(tables[0])).otherwise(total(tables[1])) / F.greatest(F.size("b"), F.lit(1))
    ordered = F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))
    rows = rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", ratio.alias("ratio"), ordered.alias("s"))
    same = lambda x, i, by: F.coalesce(x["h"] == F.get("s", i + by)["h"], F.lit(False))
    twice = F.sort_array(F.transform(F.filter("s", lambda x, i: same(x, i, -1) | same(x, i, 1)), lambda x: x["p"]))
    rows = rows.withColumn("p", twice).drop("s")
    # A repeated window covers three words, less what the next one covers itself.
    covered = F.aggregate(F.transform("p", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("p", i + 1) - p, F.lit(3)))), F.lit(0), lambda total, c: total + c)
    rows = rows.withColumn("n_repeat_words", covered.cast("long"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "ratio")
    return staged(rows, "ratio-scores")


def threshold(scored: DataFrame, trusted: DataFrame, lost: float = LOST) -> float:
    """The highest multiple of STEP with at most `lost` of the trusted documents that pass the base rules below it.

    Counted over all of them by a histogram of STEP-wide bins, whose number is bounded by the weights' range. Without
    trusted documents it is -infinity: the ratio rejects nothing.
    """
    ids = trusted.select("doc_id").where("doc_id is not null").distinct()
    kept = scored.where(~F.col("base_failed")).select("doc_id", "ratio").join(ids, "doc_id", "left_semi")
    bins = sorted((r.bin, r["count"]) for r in kept.groupBy(F.floor(F.col("ratio") / STEP).alias("bin")).count().collect())
    below, allowed = 0, lost * sum(n for _, n in bins)
    for low, n in bins:
        if (below := below + n) > allowed:
            return low * STEP
    return -math.inf


def judge(scored: DataFrame, least: float) -> DataFrame:
    """scored with kept: the base rules hold and the ratio is no less than the threshold."""
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= least))
