"""The corpus pipeline: documents in, packed sequences out.

``STAGES`` run in order. Each takes (spark, docs, sf_dir) and returns a
DataFrame; ``run`` writes it as Parquet below the shared folder and reads it
back as the next stage's docs, which cuts the lineage. Every stage works on
all rows its predecessor kept; all but the last return the columns of
``documents``.

1. toxicity: documents that the trained model rejects go
2. near_duplicates: one document of each group of near copies stays
3. decontamination: documents that hold a passage of the benchmark go
4. secrets: secrets in the text are replaced
5. packing: the documents' ids are packed into sequences

No stage can be expressed in SQL as a whole, so there is no ``ORACLE_SQL``;
the tests compare each stage with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm.decontaminate import without_leaks
from linkloom.llm.neardup import without_near_duplicates
from linkloom.llm.packing import pack_documents
from linkloom.llm.secrets import redact_secrets
from linkloom.llm.toxicity import without_toxic
from linkloom.session import join_path, new_work_dir

ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = join_path(new_work_dir(spark, "pipeline"), name)
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
