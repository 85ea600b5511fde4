"""Site, layer, scenario and query tables derived from the given star-schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark import schema as S
from riskspark.sources.tables import parquet_table, spread_scan

c = F.col


def _whole_mean(col: Column) -> Column:
    """Mean of whole numbers; exact, so it does not depend on row order."""
    return F.sum(F.floor(col + 0.5)).cast("double") / F.count("*")


def _modulo(col: Column, factor: int, divisor: int) -> Column:
    return ((col * factor) % divisor).cast("double")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One site per order, with out-of-range values and missing cells."""
    orders = parquet_table(spark, sf_dir, "orders")
    customer = parquet_table(spark, sf_dir, "customer")
    nation = parquet_table(spark, sf_dir, "nation")
    lines = (
        parquet_table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").alias("n_lines"),
            _whole_mean(c("l_quantity")).alias("qty"),
            (_whole_mean(c("l_discount") * 100.0) / 100.0).alias("disc"),
            (_whole_mean(c("l_tax") * 100.0) / 100.0).alias("tax"),
        )
    )
    # The explicit partitioning is the one the join on the order key needs anyway.
    joined = (
        orders.repartition("o_orderkey")
        .join(lines, c("o_orderkey") == c("l_orderkey"), "left")
        .join(customer, c("o_custkey") == c("c_custkey"))
        .join(nation, c("c_nationkey") == c("n_nationkey"))
    )
    return joined.select(
        c("o_orderkey").alias("site_id"),
        (c("o_totalprice") / 3.0 - 500.0).alias("contamination_bq_m2"),
        (c("qty") * 2.2).alias("soil_clay_pct"),
        (c("disc") * 150.0).alias("soil_organic_pct"),
        (_modulo(c("o_orderkey"), 37, 1800) - 50.0).alias("rainfall_mm_year"),
        (c("c_acctbal") / 10.0).alias("elevation_m"),
        (c("tax") * 1200.0).alias("slope_deg"),
        (_modulo(c("o_orderkey"), 13, 220) / 10.0 - 1.0).alias("distance_to_water_km"),
        _modulo(c("o_custkey"), 7, 6500).alias("population_density_km2"),
        (
            45.0 + c("n_regionkey") * 4.0 + (c("c_custkey") % 25).cast("double") * 0.0173
        ).alias("latitude"),
        (
            -8.0 + c("n_nationkey") * 1.5 + (c("c_custkey") % 40).cast("double") * 0.0131
        ).alias("longitude"),
        (c("n_lines").cast("double") * 11.0).alias("land_cover_urban_pct"),
    )


def with_target(scored: DataFrame) -> DataFrame:
    """A measured dose that differs from the equation by up to 10 %, exactly."""
    wobble = 1.0 + (((c("site_id") * 31) % 21).cast("double") - 10.0) / 100.0
    return scored.withColumn("target", c("dose") * wobble)


def layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line segment per supplier: ``feature_id, lat1, lon1, lat2, lon2``."""
    supplier = parquet_table(spark, sf_dir, "supplier")
    nation = parquet_table(spark, sf_dir, "nation")
    key = c("s_suppkey")

    def lat(divisor: int, step: float) -> Column:
        return 45.0 + c("n_regionkey") * 4.0 + (key % divisor).cast("double") * step

    def lon(divisor: int, step: float) -> Column:
        return -8.0 + c("n_nationkey") * 1.5 + (key % divisor).cast("double") * step

    return supplier.join(nation, c("s_nationkey") == c("n_nationkey")).select(
        key.alias("feature_id"),
        lat(11, 0.05).alias("lat1"),
        lon(13, 0.04).alias("lon1"),
        lat(17, 0.06).alias("lat2"),
        lon(19, 0.05).alias("lon2"),
    )


def real_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites under the real-profile column names; nuclides in kBq."""
    return sites(spark, sf_dir).select(
        c("site_id"),
        c("latitude"),
        c("longitude"),
        c("soil_clay_pct").alias("clay_fraction_0_30"),
        c("soil_organic_pct").alias("organic_carbon_b0"),
        c("slope_deg").alias("slope_deg_final"),
        c("elevation_m"),
        (c("contamination_bq_m2") / 1000.0).alias("cs137_kBq_m2"),
        (c("population_density_km2") / 100.0).alias("sr90_kBq_m2"),
    )


def dirty_real_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real-profile sites as read from text files, with cells that are not numbers."""
    clean = real_sites(spark, sf_dir)
    text = clean.select("site_id", *(c(n).cast("string").alias(n) for n in clean.columns[1:]))
    bad = (
        F.when(c("site_id") % 17 == 0, "n/a")
        .when(c("site_id") % 19 == 0, " 12.5 ")
        .when(c("site_id") % 23 == 0, "NaN")
        .otherwise(c("cs137_kBq_m2"))
    )
    return text.withColumn("cs137_kBq_m2", bad)


# Request-sized what-if list: (name, overrides).
SCENARIOS = (
    ("Wet year", {"rainfall_mm_year": 1100.0}),
    ("Remediation", {"contamination_bq_m2": 15000.0}),
    ("Near water", {"distance_to_water_km": 0.2, "slope_deg": 12.0}),
)


def scenario_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scenario request per event; some change columns that do not exist."""
    number = F.get_json_object("props", "$.k").cast("double")
    extra = F.when(c("event_type") == "error", F.create_map(F.lit("wind_speed"), c("value")))
    extra = extra.when(c("event_type") == "signup", F.create_map(F.lit("albedo"), c("value")))
    known = F.create_map(F.lit("rainfall_mm_year"), number, F.lit("slope_deg"), c("value"))
    return parquet_table(spark, sf_dir, "events").select(
        c("event_id"),
        F.when(c("event_id") % 29 == 0, "").otherwise(
            F.concat_ws(" ", "event_type", c("event_id").cast("string"))
        ).alias("name"),
        F.map_concat(known, F.coalesce(extra, F.create_map().cast("map<string,double>"))).alias(
            "overrides"
        ),
    )


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a page table: the document id serves as page and arrival order."""
    pages = parquet_table(spark, sf_dir, "documents").select(
        c("doc_id").alias("ingest_seq"), c("source"), c("doc_id").alias("page"), c("text")
    )
    return spread_scan(pages)


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts as questions."""
    return parquet_table(spark, sf_dir, "benchmark").select(
        c("item_id").alias("query_id"), c("text").alias("question")
    )


def questions_with_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The questions plus a blank one and one of unknown words for every item."""
    items = questions(spark, sf_dir)
    variants = F.array(
        F.struct(c("query_id").alias("id"), c("question").alias("q")),
        F.struct((c("query_id") + 1_000_000_000).alias("id"), F.lit("   ").alias("q")),
        F.struct((c("query_id") + 2_000_000_000).alias("id"), F.lit("qqqzzz vvvxxx").alias("q")),
    )
    return items.select(F.explode(variants).alias("v")).select(
        c("v.id").alias("query_id"), c("v.q").alias("question")
    )


def as_request_log(events: DataFrame) -> DataFrame:
    """Events as an access log: who called which path, when."""
    return events.select(
        c("event_id").alias("request_id"),
        c("user_id").cast("string").alias("client"),
        c("event_type").alias("path"),
        F.lit("GET").alias("method"),
        c("ts").cast("timestamp").alias("ts"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_request_log(parquet_table(spark, sf_dir, "events"))
