"""Mixing sources to target weights: a low-discrepancy source schedule.

Slot k of the mix takes the golden-ratio point frac((k + 1) * phi); the cumulative weights of the sources map it to one
source, so every stretch of the mix has close to the target shares. Slots are ranked per source. Each source's
documents are shuffled (ordered by a hash) and laid end to end; that stream is cut into blocks of equal numbers of
words, and the slot of rank r takes block r mod blocks in pass r div blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.common import WORDS, bucket_bits, hash_bucket, running_total, staged

#: Weights of the sources in code point order, repeating; the mix as a share of all words; uses of a source at most.
WEIGHTS, SHARE, REPEATS = (5, 2, 1), 1.5, 2.0
#: Words in a block, and the least number of blocks of a source that has words enough.
BLOCK, LEAST_BLOCKS = 64, 256
PHI = (math.sqrt(5) - 1) / 2
#: Slots are numbered high * STRIDE + low so that fractions stay exact to 1e-10 far beyond 1e12 slots.
STRIDE = 1 << 16
CELLS = 1024


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: float = REPEATS) -> DataFrame:
    """src, source, source_size, target of each source, from rows (source, size): one row per source in one window.

    Sources by code point, null last, take the weights in turn. Targets are share * all words by weight; where that is
    above repeats * source_size, that is the target, and the rest is dealt again to the others by weight: the common
    level L for which the sum of min(repeats * size, L * weight) is the whole. Sources without words have target 0.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    rows = per.withColumn("src", F.row_number().over(ordered) - 1)
    rows = rows.withColumn("w", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("src") % len(weights))).withColumn("most", F.col("source_size") * F.lit(float(repeats)))
    filling = Window.orderBy(F.col("most") / F.col("w"), "src")
    below = filling.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole) * F.lit(float(share))
    left = F.sum("w").over(whole) - F.coalesce(F.sum("w").over(below), F.lit(0.0))
    level = (total - F.coalesce(F.sum("most").over(below), F.lit(0.0))) / left
    rows = rows.withColumn("level", level).withColumn("level", F.when(F.col("level") <= F.col("most") / F.col("w"), F.col("level")))
    first = F.first("level", ignorenulls=True).over(filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return rows.withColumn("first", first).select("src", "source", "source_size", F.when(F.col("first").isNull(), F.col("most")).otherwise(F.least("most", F.col("first") * F.col("w"))).alias("target"))


def fraction(k: Column) -> Column:
    """frac((k + 1) * phi)."""
    high, low = F.floor((k + 1) / STRIDE), (k + 1) % STRIDE
    step = math.fmod(STRIDE * PHI, 1)
    return F.pmod(F.pmod(high * F.lit(step), F.lit(1.0)) + F.pmod(low * F.lit(PHI), F.lit(1.0)), F.lit(1.0))


def schedule(spark, sources: DataFrame, n_slots: int) -> DataFrame:
    """slot, src, rank of every slot. sources: src, low, high (cumulative slot shares in [0, 1])."""
    cells = sources.where("high > low").withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)))))
    slots = spark.range(0, n_slots, 1, max(1, -(-n_slots // (4 * STRIDE)))).select(F.col("id").alias("slot"), fraction(F.col("id")).alias("u"))
    slots = slots.withColumn("cell", F.least(F.floor(F.col("u") * CELLS), F.lit(CELLS - 1)))
    mapped = slots.join(cells, "cell").where("u >= low and u < high").select("slot", "src", F.floor(F.col("slot") / STRIDE).alias("stretch"))
    return running_total(mapped, ["src"], "stretch", ["slot"], F.lit(1), "rank").select("slot", "src", "rank")


def mix(documents: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: float = REPEATS, block: int = BLOCK, row: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, schedule) of the mix, both deterministic.

    Documents: doc_id, h (a hash of the text, unless row is given), source, size, source_size, target, taken, one row per input row; taken
    counts words, repeats included, at most ceil(repeats) times size. Schedule: slot, src, block, pass. Null texts have
    size 0 and are never taken; a null source is a source; repeated rows are separate stretches of the stream; an empty
    table gives empty results. Only doc_id, text and source are read.
    """
    spark = documents.sparkSession
    rows = documents.select("doc_id", "source", n_words(F.col("text")).alias("size"), (F.xxhash64("text") if row is None else row).alias("h"))
    rows = staged(rows, "mix-sizes")
    per = staged(targets(rows, weights, share, repeats), "mix-targets")
    passes = math.ceil(repeats)
    width = F.greatest(F.ceil(F.col("source_size") / F.greatest(F.lit(LEAST_BLOCKS), F.ceil(F.col("source_size") / block))), F.lit(1)).cast("long")
    per = per.withColumn("width", width).withColumn("blocks", F.ceil(F.col("source_size") / F.col("width")).cast("long"))
    per = per.withColumn("share", F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0))
    total = per.agg(F.coalesce(F.sum("share"), F.lit(0.0)), F.coalesce(F.max("source_size"), F.lit(0))).first()
    n_slots, bits = round(total[0]), bucket_bits(rows.count())
    upto = F.sum("share").over(Window.orderBy("src").rowsBetween(Window.unboundedPreceding, 0))
    per = staged(per.withColumn("high", upto).withColumn("all", F.nullif(F.max("high").over(Window.partitionBy()), F.lit(0.0))).select("src", "source", "source_size", "target", "width", "blocks", ((F.col("high") - F.col("share")) / F.col("all")).alias("low"), F.when(F.col("high") == F.col("all"), 1.0).otherwise(F.col("high") / F.col("all")).alias("high")), "mix-sources")
    ranked = schedule(spark, per.select("src", "low", "high"), n_slots).join(per.select("src", "blocks"), "src")
    planned = ranked.where(F.col("rank") < F.col("blocks") * passes).select("slot", "src", (F.col("rank") % F.col("blocks")).alias("block"), F.floor(F.col("rank") / F.col("blocks")).alias("pass"))
    takes = planned.groupBy("src", "block").agg(F.count("*").alias("times"))

    placed = rows.join(per.select("src", F.col("source").alias("_source"), "source_size", "target", "width"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = placed.withColumn("order", F.xxhash64("doc_id", "h", "size")).withColumn("bucket", hash_bucket(F.col("order"), bits))
    placed = running_total(placed, ["src"], "bucket", ["order", "doc_id", "h"], F.col("size"), "start").select("doc_id", "h", "source", "size", "src", "source_size", "target", "width", "start")
    placed = staged(placed, "mix-placed")
    end = F.col("start") + F.col("size")
    pieces = placed.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / F.col("width")), F.floor((end - 1) / F.col("width")))))
    pieces = pieces.withColumn("words", F.least(end, (F.col("block") + 1) * F.col("width")) - F.greatest(F.col("start"), F.col("block") * F.col("width"))).select("src", "start", "block", "words")
    # Spark sizes the pieces like their documents, however many there are; a merge join doesn't send them through the driver.
    taken = pieces.hint("merge").join(takes, ["src", "block"]).groupBy("src", "start").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    full = placed.where("size > 0").join(taken, ["src", "start"], "left").unionByName(placed.where("size = 0").withColumn("taken", F.lit(0).cast("long")))
    return full.select("doc_id", "h", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")), planned


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, as it stands: white space between and before the words is kept."""
    gaps, words = F.split(text, WORDS, -1), F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    return F.array_join(F.slice(F.zip_with(gaps, words, lambda g, w: F.concat(g, F.coalesce(w, F.lit("")))), 1, n.cast("int")), "")


def mixed_rows(documents: DataFrame, **how) -> DataFrame:
    """The mix's rows: a document as often as all its words are taken, and a part of it where a pass ends inside it.

    A pass takes the blocks of a source's stream one after another, so what it takes of a document is a stretch from
    its first word on; that stretch is cut out of the text as it stands, and n_chars (if there) is counted anew. Rows
    equal in all columns are interchangeable: what is taken of them together is dealt as whole copies and one part.
    Documents without words, null texts and documents not taken leave no row; an empty table gives an empty result.
    """
    columns = documents.columns
    row = lambda: F.struct(F.xxhash64(*columns).alias("a"), F.hash(*columns).alias("b"))
    taken, _ = mix(documents, row=row(), **how)
    per = taken.groupBy(F.col("h").alias("_mix_h")).agg(F.sum("taken").alias("_mix_taken"), F.max("size").alias("_mix_size")).where("_mix_taken > 0")
    # One shuffle of the texts serves both: repeated rows become one, which then meets what is taken of it.
    rows = documents.withColumn("_mix_h", row()).dropDuplicates(["_mix_h"]).join(per, "_mix_h")
    rows = rows.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("_mix_taken") / F.col("_mix_size")))))
    rest = F.col("_mix_taken") - (F.col("_mix_copy") - 1) * F.col("_mix_size")
    part = rest < F.col("_mix_size")
    made = {"text": F.when(part, first_words(F.col("text"), rest)).otherwise(F.col("text"))}
    if "n_chars" in columns:
        kind = documents.schema["n_chars"].dataType
        made["n_chars"] = F.when(part, F.length(made["text"]).cast(kind)).otherwise(F.col("n_chars"))
    return rows.withColumns(made).select(*columns)
