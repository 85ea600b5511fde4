"""Registered queries over site records: cleaning, scoring, joins, folds, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark import schema as S
from riskspark.functions.features import base_features, equation_scorer
from riskspark.functions.numeric import half_up, to_number
from riskspark.functions.risk import classify
from riskspark.functions.text import clean_source_name
from riskspark.operators import cleaning, drivers, folds, joins, nearest, ranking, scenarios
from riskspark.operators import statistics as stats
from riskspark.session import materialize, scratch_path
from riskspark.sources import fixtures, sinks
from riskspark.sources.tables import csv_table, parquet_table

c = F.col
FOLD_BLOCK_DEG = 0.5
ONE_BLOCK_DEG = 1000.0
# Importances of the equation's drivers, standing in for a fitted model's.
FIXED_IMPORTANCES = {
    n: w
    for n, w in zip(
        S.MODEL_COLUMNS,
        (0.62, 0.05, 0.03, 0.02, 0.04, 0.03, 0.05, 0.02, 0.02, 0.01, 0.01)
        + (0.04, 0.02, 0.02, 0.01, 0.01),
        strict=True,
    )
}


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equation_scorer(fixtures.sites(spark, sf_dir))


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = fixtures.with_target(_scored(spark, sf_dir))
    return scored.withColumnRenamed("dose", "prediction")


def _rounded(names, places: int = 6) -> list:
    return [half_up(c(n), places).alias(n) for n in names]


def site_dose_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_scored(spark, sf_dir)).select(
        "site_id", half_up(c("dose"), 8).alias("dose"), S.TARGET, "risk_level", "advisory"
    )


def site_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = base_features(fixtures.sites(spark, sf_dir))
    return features.select("site_id", *_rounded(S.MODEL_COLUMNS, 8))


def coerce_and_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = fixtures.dirty_real_sites(spark, sf_dir)
    columns = [n for n in dirty.columns if n != "site_id"]
    return cleaning.real_features(dirty, columns, keep=["site_id"])


def cs_sr_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = cleaning.real_features(
        fixtures.real_sites(spark, sf_dir), S.feature_columns("env_plus"), keep=["site_id"]
    )
    return features.withColumn(S.RATIO, half_up(c(S.RATIO), 4))


def validate_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(fixtures.sites(spark, sf_dir), S.BASE_RULES)


def advanced_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record rules of the real profile, with defaults for columns the sites lack."""
    sites = cleaning.fill_absent(fixtures.real_sites(spark, sf_dir), S.REAL_DEFAULTS)
    return _validated(sites, S.REAL_RULES)


def _validated(sites: DataFrame, rules) -> DataFrame:
    """Status and errors of each site, within its row."""
    sites = sites.select("site_id", *rules)
    checked = cleaning.validate(sites, rules)
    status = F.when(F.size("errors") == 0, "clean").otherwise("quarantined")
    return checked.select(
        "site_id", status.alias("status"), F.array_join("errors", "; ").alias("errors")
    )


def scenario_override_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = cleaning.check_overrides(fixtures.scenario_requests(spark, sf_dir))
    return checked.select(
        "event_id", "name", F.array_join("unknown", ", ").alias("unknown"), "accepted"
    )


def question_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = fixtures.questions_with_misses(spark, sf_dir).withColumn(
        "top_k", c("query_id") % 13
    )
    checked = cleaning.check_questions(asked.withColumn("question", F.trim("question")))
    return checked.select("query_id", "top_k", F.coalesce("problem", F.lit("ok")).alias("status"))


def source_name_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = parquet_table(spark, sf_dir, "pages")
    return pages.select("page_id", clean_source_name(c("url")).alias("source_name"))


def upload_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffix = F.element_at(F.array(*map(F.lit, (".pdf", ".PDF", ".txt", ""))), c("kind"))
    listing = parquet_table(spark, sf_dir, "documents").select(
        "doc_id",
        c("n_chars"),
        c("source"),
        (c("doc_id") % 4 + 1).cast("int").alias("kind"),
    )
    files = listing.select(
        "doc_id",
        F.concat("source", F.lit("-"), c("doc_id").cast("string"), suffix).alias("name"),
        F.when(c("doc_id") % 7 == 0, 0).otherwise(c("n_chars") * 4000).alias("size"),
    )
    admitted = cleaning.admit_uploads(files)
    return admitted.select(
        "doc_id", "name", "size", F.coalesce("reason", F.lit("admitted")).alias("status")
    )


def _partial_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Environment and nuclide tables, neither of which has all columns."""
    real = fixtures.real_sites(spark, sf_dir).withColumnRenamed("site_id", S.RECORD_ID)
    env = real.select(
        S.RECORD_ID, "latitude", "longitude", *(n for n in S.ENV_COLUMNS if n in real.columns)
    )
    env = cleaning.fill_absent(env, {n: S.REAL_DEFAULTS[n] for n in S.ENV_COLUMNS})
    nuclides = real.select(
        S.RECORD_ID, "latitude", *S.ARTIFICIAL_NUCLIDES,
        F.when(c(S.RECORD_ID) % 11 == 0, "n/a")
        .otherwise(c("cs137_kBq_m2").cast("string"))
        .alias(S.REAL_TARGET),
    )
    nuclides = cleaning.fill_absent(nuclides, {n: S.REAL_DEFAULTS[n] for n in S.NUCLIDE_COLUMNS})
    # Both are read by the tests of their keys and by the join.
    return materialize(env, "env"), materialize(nuclides, "nuclides")


def keyed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables joined on the record id."""
    merged = joins.training_table(*_partial_tables(spark, sf_dir))
    return cleaning.drop_missing_target(merged, S.REAL_TARGET)


def csv_training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tables by way of CSV files, where every column is text."""
    read = []
    for table in _partial_tables(spark, sf_dir):
        path = scratch_path(spark, "table-csv")
        table.write.option("header", True).csv(path)
        read.append(csv_table(spark, path))
    merged = joins.training_table(*read)
    numbers = [n for n in merged.columns if n != S.RECORD_ID]
    kept = cleaning.drop_missing_target(cleaning.coerce(merged, numbers), S.REAL_TARGET)
    return kept.withColumn(S.RECORD_ID, c(S.RECORD_ID).cast("long"))


def positional_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = parquet_table(spark, sf_dir, "orders")
    left = orders.select("o_orderkey", "o_custkey")
    right = orders.select(
        c("o_totalprice"), c("o_orderkey").alias("price_key"), c("o_custkey")
    )
    return joins.positional_zip(left, right, ["o_orderkey"], ["o_totalprice", "price_key"])


def nearest_layer_km(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = fixtures.sites(spark, sf_dir).select("site_id", "latitude", "longitude")
    found = nearest.nearest_distance_km(points, fixtures.layer(spark, sf_dir))
    return found.select("site_id", *_rounded(["distance_to_water_km"], 4))


def scenario_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = scenarios.compare_scenarios(
        fixtures.sites(spark, sf_dir), fixtures.SCENARIOS, equation_scorer
    )
    return compared.select(
        "site_id", "scenario", S.TARGET, "risk_level", "delta_vs_baseline_usv_h"
    )


LACKING = ("distance_to_water_km", "population_density_km2")


def scenario_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites that lack columns which a scenario changes: defaults, then the override."""
    sites = fixtures.sites(spark, sf_dir).drop(*LACKING)
    compared = scenarios.compare_scenarios(sites, fixtures.SCENARIOS, equation_scorer)
    return compared.select(
        "site_id", "scenario", S.TARGET, "risk_level", "delta_vs_baseline_usv_h"
    )


def scenario_request_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted requests for sites that don't exist; twice the event's id leads beyond the sites."""
    checked = cleaning.check_overrides(fixtures.scenario_requests(spark, sf_dir))
    asked = checked.where("accepted").withColumn("site_id", 2 * c("event_id"))
    lost = scenarios.requests_without_site(fixtures.sites(spark, sf_dir), asked)
    return lost.select("site_id", c("name").alias("scenario"), "reason")


def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenario results written as CSV and read back."""
    path = scratch_path(spark, "scenarios-csv")
    sinks.write_scenarios(scenario_compare(spark, sf_dir), path)
    back = csv_table(spark, path)
    return back.select(
        c("site_id").cast("long").alias("site_id"), "scenario",
        to_number(c(S.TARGET)).alias(S.TARGET), "risk_level",
        to_number(c("delta_vs_baseline_usv_h")).alias("delta_vs_baseline_usv_h"),
    )


def scenario_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted event requests applied to the site with the event's number."""
    checked = cleaning.check_overrides(fixtures.scenario_requests(spark, sf_dir))
    asked = checked.where("accepted").withColumn("site_id", c("event_id"))
    compared = scenarios.compare_requests(fixtures.sites(spark, sf_dir), asked, equation_scorer)
    return compared.select(
        "site_id", "scenario", S.TARGET, "risk_level", "delta_vs_baseline_usv_h"
    )


def dedup_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenarios.score_distinct(fixtures.sites(spark, sf_dir), equation_scorer)


def feature_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = stats.feature_stats(
        base_features(fixtures.sites(spark, sf_dir)), S.MODEL_COLUMNS
    )
    return table.select("feature", *_rounded(["mean", "std"]))


def holdout_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _measured(spark, sf_dir).select("site_id", "target", "prediction")
    split = ranking.holdout_split(materialize(rows.dropna(), "measured"), "site_id")
    return split.groupBy("is_test").agg(*stats.regression_metrics()).select(
        "is_test", "n", *_rounded(["mae", "rmse", "r2"])
    )


def spatial_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = fixtures.sites(spark, sf_dir).select("site_id", "latitude", "longitude")
    return folds.block_sizes(folds.with_blocks(points))


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = fixtures.sites(spark, sf_dir).select("site_id", "latitude", "longitude")
    return materialize(points, "points")


def spatial_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocked = folds.with_blocks(_points(spark, sf_dir), FOLD_BLOCK_DEG)
    assigned = folds.group_folds(folds.block_sizes(blocked))
    return assigned.select("block", "n_rows", c("fold").cast("long").alias("fold"))


def kfold_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = folds.spatial_folds(_points(spark, sf_dir), size=ONE_BLOCK_DEG)
    return folded.select("site_id", c("fold").cast("long").alias("fold"))


def cv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(
        _measured(spark, sf_dir).select(
            "site_id", "latitude", "longitude", "target", "prediction"
        ),
        "measured",
    )
    folded = folds.spatial_folds(rows, size=FOLD_BLOCK_DEG)
    return stats.fold_summary(folded).select(
        "folds", "n_rows", *_rounded(["cv_mae", "cv_rmse", "cv_r2", "cv_r2_std"])
    )


def median_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = materialize(base_features(fixtures.sites(spark, sf_dir)), "features")
    medians = stats.exact_medians(features, S.MODEL_COLUMNS)
    return stats.impute(features, medians).select("site_id", *_rounded(S.MODEL_COLUMNS))


def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = base_features(fixtures.sites(spark, sf_dir))
    scaled = stats.standardize(features, stats.scaling(features, S.MODEL_COLUMNS))
    return scaled.select("site_id", *_rounded(S.MODEL_COLUMNS))


def importance_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = base_features(fixtures.sites(spark, sf_dir))
    rows = stats.feature_stats(features, S.MODEL_COLUMNS).collect()  # one row per feature
    moments = {r["feature"]: (r["mean"], r["std"]) for r in rows}
    local = drivers.importance_contributions(moments, FIXED_IMPORTANCES)
    top = drivers.top_drivers(features, local)
    return top.select(
        "site_id",
        c("driver_rank").cast("long").alias("driver_rank"),
        "feature",
        "direction",
        *_rounded(["value", "contribution"]),
    )
