"""A corpus in five stages: quality, near duplicates, benchmark passages, source mix, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents, in their order and whatever their names. A stage reads
doc_id, text and (mix, shards) source and lang; other columns go through. Nulls in any column, texts of any length,
repeated rows and empty tables are allowed; what becomes of them is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm import decontamination, mixing, quality_cnn, sharding, simhash
from rillflow.llm.common import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts: score 0.3 or more. It is fitted on labelled documents of the corpus.

    A null text is scored as an empty one; equal texts have equal scores, so repeated rows stay or go together. Without
    labels every score is 0.5 and all documents stay; labels of one class only accept or reject all.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = quality_cnn.train(docs, labels)
    return quality_cnn.score(docs, net, threshold=0.3, prefix="_stage_").where("_stage_predicted = 1").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one of smallest doc_id (nulls last), among equal ones of smallest text hash.

    The hash is what the whole text is told apart by; of rows equal in doc_id and text one stays. Null and empty texts
    are one group. Groups are op8's: fingerprints of four-word shingles that differ in 4 bits or fewer link.
    """
    keyed = docs.withColumn("_stage_h", F.xxhash64("text"))
    found = simhash.near_duplicates(keyed, ["doc_id", "_stage_h"])
    first = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_stage_h")).alias("x"))
    kept = first.select(F.col("x.doc_id").alias("_stage_id"), F.col("x._stage_h").alias("_stage_kept")).distinct()
    rows = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col("_stage_id")) & (F.col("_stage_h") == F.col("_stage_kept")), "left_semi")
    return rows.dropDuplicates(["doc_id", "_stage_h"]).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window. Null and empty texts have no words and stay; repeated rows are judged one
    by one; without a benchmark all documents stay."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.decontaminate(docs, benchmark, prefix="_stage_").where("_stage_n_hit = 0").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights: documents as often, and as far, as the schedule takes them.

    A null source is a source. Documents without words, null texts among them, leave no row; what is taken of rows equal
    in all columns is taken of them together. Only text and n_chars of a document that a pass ends in are cut.
    """
    return mixing.mixed_rows(docs).select(*docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of the mix. Null lang and source count as empty, a null text
    has no bytes; repeated rows are separate rows of one shard."""
    return sharding.shard(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminated", decontaminated), ("mixed", mixed), ("sharded", sharded)]

#: A trained network decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
