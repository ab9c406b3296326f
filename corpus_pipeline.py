"""From raw documents to token ids: quality, near-duplicates, benchmark passages, secrets, pieces.

Each stage takes the documents that the one before kept, whole. All but the last return rows with
the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm import decontaminate, pieces, quality_gam, secrets, similar
from postmill.llm.common import cut, read_table, remove, shared_folder
from postmill.llm.queries import piece_model

#: SQL can express neither the classifier nor the pieces.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches 0.5 stay."""
    model = quality_gam.learn(docs, read_table(spark, sf_dir, "labels"))
    return docs.where(quality_gam.score_column(model) >= 0.5)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (SimHash candidates, five-word shingles, Jaccard 0.8 or more) one row stays: with the least id, none last."""
    keyed, key = similar.with_row_key(docs), list(similar.ROW_KEY)
    best = F.struct(F.col("doc_id").isNull(), "doc_id", *key)
    first = similar.near_copies(keyed).groupBy("root").agg(F.min(best).alias("r")).select(*(F.col(f"r.{k}") for k in key))
    return keyed.join(first, key, "left_semi").dropDuplicates(key).select(*docs.columns)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with any word inside a benchmark window go."""
    keyed, key = similar.with_row_key(docs), list(similar.ROW_KEY)
    found = cut(decontaminate.contaminated_keys(keyed, read_table(spark, sf_dir, "benchmark"), key))
    found = F.broadcast(found) if found.count() <= similar.FEW else found  # few keys go to the texts
    return keyed.join(found, key, "left_anti").select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with its secrets blotted out and n_chars to match."""
    found = secrets.find_secrets(docs, carry=docs.columns)
    clean = found.withColumn("clean", secrets.redacted(F.col("row.text"), F.col("spans")))
    count = F.when(F.size("spans") > 0, F.length("clean").cast("long")).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("clean"), "n_chars": count}
    return clean.select(*(new.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them."""
    return pieces.encode_pieces(docs, piece_model(), keep_ids=True)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", uncontaminated),
    ("secrets", without_secrets),
    ("pieces", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written as Parquet in the shared folder and read again.

    A stage's folder goes once the next one is written; the last one stays, for the result reads it.
    """
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = read_table(spark, sf_dir, "documents"), None
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            at = f"{folder}/{name}"
            docs.write.parquet(at)
            docs = spark.read.parquet(at)
            if before:
                remove(spark, before)
            before = at
    return docs
