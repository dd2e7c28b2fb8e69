"""PII: fixed patterns, and terms that disclose a protected entity by what the corpus says about them.

Protected entities are the values that the patterns find, and the kinds themselves (that a text holds an email, a card,
a secret). A term in an entity's documents discloses it if, over the corpus, seeing the term tells almost as much as
seeing the entity: their pointwise mutual information reaches a share of the entity's own information, -log2 of its
frequency. Such terms get spans wherever they stand, in documents without the entity too: removed if the term all but
determines an entity, generalised otherwise. Rare coincidences don't count: a pair needs support in several documents.
Secrets (long runs of hex digits, such as access tokens) are protected beside the base kinds; each has a span.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.common import staged

#: The base kinds, and what else is protected; a span's rank is its kind's place in BASE + PROTECTED + ACTIONS.
BASE, PROTECTED, ACTIONS = ("email", "ip", "card", "phone"), ("secret",), ("remove", "generalise")
KINDS = BASE + PROTECTED
#: Documents that must hold term and entity together; the share of the entity's information that discloses it; and
#: the share of a term's documents that hold the entity from which on the term is removed.
SUPPORT, DISCLOSED, REMOVED = 3, 0.95, 0.9
#: Runs of letters, digits and characters beyond ASCII, of any length: short names and numbers disclose, too.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# The contract's patterns in a form that takes linear time and constant stack: possessive runs, no start inside a run
# that has just failed (unless a match has just ended there), and repetition by single characters with a look ahead.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?=\.{_LABEL})(?:(?=\.?{_LABEL})[A-Za-z0-9.-])+",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:(?=[\x20-]?[0-9])[0-9\x20-])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![0-9A-Za-z])[0-9a-fA-F]{32,}+(?![0-9A-Za-z])",
}
#: A text without this character has no match of the kind.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}


def found(text: Column, kind: str) -> Column:
    """The kind's matches in order: array of (gap, value): the code points since the last match, and the match."""
    pattern = PATTERNS[kind]
    gaps, values = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rows = F.transform(values, lambda v, i: F.struct(F.length(F.get(gaps, i)).alias("gap"), v.alias("value")))
    might = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else F.lit(True)
    if kind in ("ip", "card", "secret"):
        might = might & text.rlike("[0-9]")
    return F.when(might, rows).otherwise(F.array().cast("array<struct<gap:int,value:string>>"))


def valid(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10).cast("int")))
    luhn = F.when(F.length(digits).between(12, 19), F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0).otherwise(False)
    secret = value.rlike("[0-9]") & value.rlike("[A-Fa-f]")
    return F.when(kind == "email", True).when(kind == "secret", secret).when(kind == "ip", value.rlike(rf"^{part}(?:\.{part}){{3}}$")).when(kind == "card", luhn).otherwise(F.length(digits).between(9, 15))


def valid_as(kind: str):
    return lambda m: valid(F.lit(kind), m["value"])


def scan(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, matches): rid, doc_id, text t and might (whether it has a valid match) of every document; rid, kind, rank, start, end, value of each valid match.

    rid numbers the rows of the written scan, so it stays the same whatever is computed again later.
    """
    text = F.coalesce("text", F.lit(""))
    scanned = documents.select("doc_id", text.alias("t")).select(F.monotonically_increasing_id().alias("rid"), "doc_id", "t", *[found(F.col("t"), k).alias(k) for k in KINDS])
    might = [F.exists(F.col(k), valid_as(k)) for k in KINDS]
    scanned = staged(scanned.withColumn("might", reduce(or_, might)), "pii-scan")
    each = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(i).alias("rank"), F.col(k).alias("found")) for i, k in enumerate(KINDS)])
    some = scanned.where("might").select("rid", F.explode(each).alias("e"))
    rows = some.select("rid", "e.kind", "e.rank", F.posexplode("e.found").alias("pos", "m")).select("rid", "kind", "rank", "pos", "m.*")
    upto = F.sum(F.col("gap") + F.length("value")).over(Window.partitionBy("rid", "kind").orderBy("pos"))
    rows = rows.withColumn("end", upto.cast("long")).withColumn("start", F.col("end") - F.length("value")).where(valid(F.col("kind"), F.col("value")))
    return scanned.select("rid", "doc_id", "t", "might"), staged(rows.select("rid", "kind", "rank", "start", "end", "value"), "pii-matches")


def distinct_terms(rows: DataFrame) -> DataFrame:
    """rid, term of each different term of each row."""
    return rows.select("rid", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("t"), F.lit(TERM), F.lit(0)))).alias("term"))


def occurrences(rows: DataFrame) -> DataFrame:
    """rid, term, start, end of each term at each place it stands."""
    # Zipped without a lambda, which would split the text again for each term.
    zipped = F.arrays_zip(F.split("t", TERM, -1).alias("gap"), F.regexp_extract_all("t", F.lit(TERM), F.lit(0)).alias("term"))
    each = rows.select("rid", F.posexplode(zipped).alias("pos", "m")).select("rid", "pos", F.length("m.gap").alias("gap"), "m.term").where("term is not null")
    end = F.sum(F.col("gap") + F.length("term")).over(Window.partitionBy("rid").orderBy("pos")).cast("long")
    return each.withColumn("end", end).select("rid", F.lower("term").alias("term"), (F.col("end") - F.length("term")).alias("start"), "end")


def outside(terms: DataFrame, matches: DataFrame) -> DataFrame:
    """The occurrences that overlap no match; terms don't overlap each other."""
    taken = matches.select("rid", F.lit(None).cast("string").alias("term"), "start", "end")
    by = Window.partitionBy("rid").orderBy("start", F.col("term").isNotNull())
    match = F.col("term").isNull()
    before = F.max(F.when(match, F.col("end"))).over(by.rowsBetween(Window.unboundedPreceding, 0))
    after = F.lead(F.when(match, F.col("start"))).over(by)
    rows = terms.unionByName(taken).withColumns({"before": before, "after": after})
    return rows.where(~match & (F.coalesce("before", F.lit(0)) <= F.col("start")) & (F.col("after").isNull() | (F.col("after") >= F.col("end")))).select("rid", "term", "start", "end")


def disclosing(n: int, matches: DataFrame, held: DataFrame, n_term: DataFrame, support: int = SUPPORT, disclosed: float = DISCLOSED) -> DataFrame:
    """entity, term, pmi, action of the pairs that disclose. Frequencies are numbers of documents, over all n documents;
    a pair's is that of documents that hold both, at whatever distance. held: rid, term of the documents with matches;
    n_term: term, n_term over all documents, terms with support only."""
    values = matches.select("rid", F.concat("kind", F.lit(":"), F.lower("value")).alias("entity")).distinct()
    kinds = matches.select("rid", F.col("kind").alias("entity")).distinct()
    # Written, so that Spark knows their size and can split a frequent entity's rows in the joins.
    n_value = staged(values.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= support), "pii-values")
    n_kind = kinds.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= support)
    often = values.join(n_value.select("entity"), "entity").unionByName(kinds)
    n_entity = staged(n_value.unionByName(n_kind), "pii-entities")
    n_both = held.join(often, "rid").groupBy("entity", "term").agg(F.count("*").alias("n_both")).where(F.col("n_both") >= support)
    pairs = n_both.join(n_entity, "entity").join(n_term, "term")
    pmi = F.log2(F.col("n_both") * F.lit(float(n)) / (F.col("n_entity") * F.col("n_term")))
    own = F.log2(F.lit(float(n)) / F.col("n_entity"))
    action = F.when(F.col("n_both") >= REMOVED * F.col("n_term"), "remove").otherwise("generalise")
    return pairs.where((own > 0) & (pmi >= disclosed * own)).select("entity", "term", pmi.alias("pmi"), action.alias("action"))


def find(documents: DataFrame) -> DataFrame:
    """doc_id, spans of every document: (kind, rank, start, end): the base kinds, secret, remove and generalise.

    Spans are ordered by start, then kind as listed; those of a term that discloses several entities are one. A null text counts as empty and has none; repeated rows each have
    theirs; an empty table gives an empty result. Terms that overlap a base span of their document are left out, of the
    frequencies too; every other occurrence of a disclosing term, in any document, has a span.
    """
    rows, matches = scan(documents)
    free = staged(outside(occurrences(rows.where("might")), matches), "pii-terms")
    plain = rows.where("not might").select("rid", "t")
    held = free.select("rid", "term").distinct()
    n_term = held.select("term").unionByName(distinct_terms(plain).select("term")).groupBy("term").agg(F.count("*").alias("n_term")).where(F.col("n_term") >= SUPPORT)
    pairs = disclosing(rows.count(), matches, held, n_term)
    terms = staged(pairs.groupBy("term").agg(F.max("action").alias("kind")), "pii-disclosing")
    # Written, so that its size is known before the texts would be shuffled to meet it.
    also = staged(distinct_terms(plain).join(terms, "term", "left_semi").select("rid").distinct(), "pii-also")
    hits = free.unionByName(occurrences(plain.join(also, "rid", "left_semi"))).join(terms, "term")
    more = hits.select("rid", "start", F.when(F.col("kind") == "remove", len(KINDS)).otherwise(len(KINDS) + 1).alias("rank"), "kind", "end")
    every = matches.select("rid", "start", "rank", "kind", "end").unionByName(more)
    spans = every.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("spans"))
    none = F.array().cast(spans.schema["spans"].dataType)
    return rows.select("rid", "doc_id").join(spans, "rid", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))
