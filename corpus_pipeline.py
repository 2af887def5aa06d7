"""A corpus pipeline: toxicity, quality, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
run() writes each stage's result as Parquet in the shared folder and reads it for the next.

Rows whose text is null pass the first two stages by their models' score of an empty text, are no duplicates, and
are packed as an empty text. near_duplicates decides row by row: of a group one row stays, whatever ids its rows have or lack, and of
rows without words one for each doc_id and text (all of them, where they lack an id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from termloom.llm import near_dups, packing, quality_model, secrets, toxicity
from termloom.llm.common import materialise, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts toxic go."""
    weights, curve = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.where(docs, weights, curve, lambda score: score < 0.7)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not predict good go."""
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    if not model[0].any() and not docs.isEmpty():
        raise ValueError("the quality model has learned nothing, since there are no labels: no document would stay")
    return quality_model.where(docs, model, lambda score: score >= 0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, similarity 0.8) the document of the smallest id stays."""
    rows = materialise(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = near_dups.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), 5, 80)
    ids = rows.select("_row", "doc_id", F.when(F.btrim("text", F.lit(" \t\r\n")) == "", F.col("text")).alias("blank"))
    known = ids.join(found.select(F.col("doc_id").alias("_row"), "n_shingles", "component_id"), "_row")
    worded = F.col("n_shingles") > 0
    key = [
        F.when(worded, F.col("component_id")).alias("a"),
        F.when(~worded, F.col("doc_id")).alias("b"),
        F.when(~worded, F.col("blank")).alias("c"),
        F.when(~worded & F.col("doc_id").isNull(), F.col("_row")).alias("d"),
    ]
    first = known.groupBy(*key).agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "_row")).alias("first"))
    return rows.join(first.select("first._row"), "_row", "left_semi").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark; n_chars follows the text."""
    out = secrets.redacted(docs)
    return out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 ids and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: The models' scores and the packing's linear program have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
