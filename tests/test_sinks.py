import pytest
from pyspark.sql import functions as F

from riskspark import schema as S
from riskspark import session
from riskspark.functions.features import equation_scorer
from riskspark.functions.risk import classify
from riskspark.operators import scenarios
from riskspark.session import shared_dir
from riskspark.sources import sinks
from riskspark.sources.tables import csv_table, page_table


def test_exports(spark, tmp_path):
    sites = spark.createDataFrame([(i, *S.BASE_DEFAULTS.values()) for i in range(3)], S.SITE_SCHEMA)
    sinks.write_predictions(classify(equation_scorer(sites)), str(tmp_path / "p"))
    assert spark.read.json(str(tmp_path / "p")).where("risk_level = 'Elevated'").count() == 3
    compared = scenarios.compare_scenarios(sites, [("Dry", {"rainfall_mm_year": 0.0})], equation_scorer)
    sinks.write_scenarios(compared, str(tmp_path / "s"))
    assert csv_table(spark, str(tmp_path / "s")).where("scenario = 'Dry'").count() == 3
    reports = sites.select("site_id", F.lit("# a\n\nb").alias("report_markdown"))
    sinks.write_reports(reports, str(tmp_path / "r"))
    text = "".join(p.read_text() for p in (tmp_path / "r").glob("part-*"))
    assert text.count("# a\n\nb\n---\n") == 3


def test_page_table_fills_missing_text(spark):
    df = spark.createDataFrame([("s", 1, None)], "src string, p int, body string")
    row = page_table(df, "src", "p", "body").first()
    assert row.asDict() == {"source": "s", "page": 1, "text": ""}


class _Session:
    """A session with a given setting, or without one."""

    def __init__(self, setting):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext, self.made = self, None

    def getCheckpointDir(self):
        return self.made

    def setCheckpointDir(self, folder):
        self.made = folder


def test_shared_dir_comes_from_the_session(spark):
    given = _Session("/some/shared/place/")
    assert shared_dir(given) == "/some/shared/place" and given.made is None
    own = _Session(None)
    own.sparkContext.master = "local[2]"
    assert shared_dir(own) == own.made == shared_dir(own)
    far = _Session(None)
    far.sparkContext.master = "spark://host:7077"
    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        shared_dir(far)
    assert shared_dir(spark) == shared_dir(spark)


def test_advanced_profile_scenarios(spark):
    row = {n: S.REAL_DEFAULTS[n] for n in S.allowed_overrides("real")}
    sites = spark.createDataFrame([(1, *row.values())], ["site_id", *row])

    def scorer(df):
        return df.withColumn("dose", F.col("cs137_kBq_m2") / 100.0)

    rows = scenarios.compare_scenarios(sites, [("More", {"cs137_kBq_m2": 80.0})], scorer, "real")
    got = {r["scenario"]: (r[S.TARGET], r["delta_vs_baseline_usv_h"]) for r in rows.collect()}
    assert got == {"Baseline": (0.274, 0.0), "More": (0.8, 0.526)}


def test_scratch_is_removed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    path = session.scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    session.remove_scratch(spark)
    assert not (tmp_path / "riskspark" / spark.sparkContext.applicationId).exists()
