"""All registered queries by key, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from riskspark.plans import (
    model_queries,
    site_oracle,
    site_queries,
    stream_oracle,
    stream_queries,
    text_oracle,
    text_queries,
)
from riskspark.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

_SITE_KEYS = (
    "site_dose_risk",
    "site_features",
    "coerce_and_clip",
    "cs_sr_ratio",
    "validate_quarantine",
    "advanced_validate",
    "scenario_override_check",
    "question_validation",
    "source_name_clean",
    "upload_admission",
    "keyed_merge",
    "positional_zip",
    "nearest_layer_km",
    "scenario_compare",
    "scenario_requests",
    "scenario_defaults",
    "scenario_request_quarantine",
    "csv_training_table",
    "export_roundtrip",
    "dedup_scoring",
    "feature_stats",
    "holdout_metrics",
    "spatial_blocks",
    "spatial_folds",
    "kfold_fallback",
    "cv_summary",
    "median_impute",
    "standardize",
    "importance_drivers",
)

_TEXT_KEYS = (
    "doc_chunks",
    "chunk_dedup",
    "term_stats",
    "tfidf_weights",
    "search_topk",
    "search_topk_per_question",
    "search_stored_index",
    "citations",
    "prompt_build",
    "evidence_answer",
    "risk_report",
)

_MODEL_KEYS = (
    "ridge_loo",
    "forest_train_score",
    "extra_trees_cv",
    "leaderboard",
    "synthetic_sites",
    "tree_shap",
)

_STREAM_KEYS = ("stream_scoring", "stream_ingest", "stream_ingest_restart", "rate_limit_audit", "rate_limit_stream", "rate_limit_late")


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    named = {
        **{k: getattr(site_queries, k) for k in _SITE_KEYS},
        **{k: getattr(text_queries, k) for k in _TEXT_KEYS},
        **{k: getattr(model_queries, k) for k in _MODEL_KEYS},
        **{k: getattr(stream_queries, k) for k in _STREAM_KEYS},
    }
    return {k: _shipped(q) for k, q in named.items()}


def oracle_sql() -> dict[str, str]:
    return {
        **site_oracle.oracle_sql(),
        **text_oracle.oracle_sql(),
        **stream_oracle.oracle_sql(),
    }
