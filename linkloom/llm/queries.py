"""Queries of the training-data operators: name -> (callable, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .decontaminate import find_leaks
from .divergence import DIVERGENCE_SQL, source_divergence
from .extract_html import extract_pages
from .langid import language_digest
from .lloyd import CLUSTERS_SQL, cluster_digest
from .lm_score import score_digest
from .neardup import COMPONENTS_SQL, near_duplicates
from .packing import pack_documents
from .repetition import VERDICT_SQL, repetition_digest
from .secrets import secret_digest
from .sharding import shard_digest
from .token_files import token_digest
from .toxicity import toxicity_digest

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: QueryFn
    sql: str | None = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


REGISTRY: dict[str, Query] = {
    "op1_decontamination": Query(lambda spark, d: find_leaks(
        _table(spark, d, "documents"), _table(spark, d, "benchmark"))),
    "op2_html_extraction": Query(lambda spark, d: extract_pages(_table(spark, d, "pages"))),
    "op3_repetition": Query(lambda spark, d: repetition_digest(_table(spark, d, "documents")), VERDICT_SQL),
    "op4_sharding": Query(lambda spark, d: shard_digest(_table(spark, d, "documents"))),
    "op5_toxicity": Query(lambda spark, d: toxicity_digest(
        _table(spark, d, "documents"), _table(spark, d, "labels"))),
    "op6_packing": Query(lambda spark, d: pack_documents(_table(spark, d, "documents"))),
    "op7_secrets": Query(lambda spark, d: secret_digest(_table(spark, d, "documents"))),
    "op8_language_id": Query(lambda spark, d: language_digest(_table(spark, d, "documents"))),
    "op9_near_duplicates": Query(lambda spark, d: near_duplicates(_table(spark, d, "documents")),
                                 COMPONENTS_SQL),
    "op10_token_files": Query(lambda spark, d: token_digest(_table(spark, d, "documents"))),
    "op11_lm_score": Query(lambda spark, d: score_digest(_table(spark, d, "documents"))),
    "op12_clusters": Query(lambda spark, d: cluster_digest(_table(spark, d, "embeddings")), CLUSTERS_SQL),
    "op13_source_divergence": Query(lambda spark, d: source_divergence(_table(spark, d, "documents")),
                                    DIVERGENCE_SQL),
}


def queries() -> dict[str, QueryFn]:
    return {name: q.run for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}
