import math

import pytest
from pyspark.sql import functions as F

from riskspark import schema as S
from riskspark.functions.features import base_features, equation_scorer
from riskspark.functions.numeric import clip, half_up, non_negative, to_number
from riskspark.functions.risk import classify, risk_level
from riskspark.functions.text import clean_source_name
from riskspark.operators import cleaning, joins
from riskspark.sources.tables import csv_table, missing_columns, upload_listing

NAN, INF = float("nan"), float("inf")


def values(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_numbers_from_text(spark):
    df = spark.createDataFrame([("1.5",), (" 2 ",), ("NA",), ("",), ("NaN",), ("null",), ("inf",),
                                (None,)], "x string")
    got = [r[0] for r in df.select(to_number(F.col("x"))).collect()]
    assert got == [1.5, 2.0, None, None, None, None, INF, None]


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(-5.0,), (50.0,), (500.0,), (None,)], "x double")
    assert [r[0] for r in df.select(clip(F.col("x"), 0, 100)).collect()] == [0.0, 50.0, 100.0, None]


def test_bands_are_strict_at_their_edges(spark):
    doses = [0.0, 0.0999, 0.1, 0.3, 0.7, 1.5, 99.0, NAN, None]
    df = spark.createDataFrame([(d,) for d in doses], "dose double")
    got = [r[0] for r in df.select(risk_level(F.col("dose"))).collect()]
    assert got == ["Low", "Low", "Moderate", "Elevated", "High", "Critical", "Critical",
                   "Critical", None]


def test_level_uses_unrounded_dose(spark):
    df = spark.createDataFrame([(0.09999,), (-1.0,), (NAN,)], "dose double")
    got = values(classify(df), S.TARGET, "risk_level")
    assert got == [(0.1, "Low"), (0.0, "Low"), (0.0, "Low")]


def test_non_negative(spark):
    df = spark.createDataFrame([(NAN,), (-2.0,), (3.0,), (None,)], "x double")
    assert [r[0] for r in df.select(non_negative(F.col("x"))).collect()] == [0.0, 0.0, 3.0, None]


def test_half_up(spark):
    df = spark.createDataFrame([(0.12345,), (0.0625,), (-0.5,)], "x double")
    assert [r[0] for r in df.select(half_up(F.col("x"), 3)).collect()] == [0.123, 0.063, -0.5]


def test_absent_columns_get_defaults_but_cells_stay_empty(spark):
    df = spark.createDataFrame([(1, None, 120.0)], "site_id long, slope_deg double, soil_clay_pct double")
    row = base_features(df).first()
    assert row["slope_deg"] is None and row["soil_clay_pct"] == 100.0
    assert row["contamination_bq_m2"] == S.BASE_DEFAULTS["contamination_bq_m2"]
    assert row["runoff_potential"] is None


def test_dose_equation_by_hand(spark):
    site = dict(S.BASE_DEFAULTS)
    df = spark.createDataFrame([(1, *site.values())], S.SITE_SCHEMA)
    retention = (0.55 * 28 + 0.45 * 6) / 100
    expected = (
        0.025
        + 35000 * 6.2e-6 * (1 + 0.8 * retention)
        + 0.035 * math.log1p(750) * math.log1p(4) / 20
        + 0.08 * math.exp(-2.5 / 3)
        + 0.006 * math.log1p(180) * 1.35
        + 0.025 * math.sin(math.radians(59.91)) * math.cos(math.radians(10.75))
        - 1.5e-5 * 120
    )
    assert equation_scorer(df).first()["dose"] == pytest.approx(expected, abs=1e-12)


def test_more_contamination_means_more_dose(spark):
    df = spark.createDataFrame([(i, i * 1000.0) for i in range(5)], "site_id long, contamination_bq_m2 double")
    doses = [r["dose"] for r in equation_scorer(df).orderBy("site_id").collect()]
    assert doses == sorted(doses) and doses[0] < doses[-1]


def test_ratio_of_input_wins(spark):
    given = spark.createDataFrame([(1, 50.0, 5.0, 3.0)], "site_id long, cs137_kBq_m2 double, "
                                  "sr90_kBq_m2 double, ratio_cs_sr double")
    features = S.feature_columns("nuclide_only")
    assert cleaning.real_features(given, features).first()[S.RATIO] == 3.0
    derived = cleaning.real_features(given.drop(S.RATIO), features).first()[S.RATIO]
    assert derived == pytest.approx(10.0)


def test_ratio_is_taken_before_clipping(spark):
    df = spark.createDataFrame([(-50.0, -5.0)], "cs137_kBq_m2 double, sr90_kBq_m2 double")
    row = cleaning.real_features(df, S.feature_columns("nuclide_only")).first()
    assert row["cs137_kBq_m2"] == 0.0 and row[S.RATIO] == pytest.approx(10.0)


def test_real_features_name_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "site_id long")
    with pytest.raises(ValueError, match="soil_colour"):
        cleaning.real_features(df, ["soil_colour"])


def test_unknown_feature_set():
    with pytest.raises(ValueError, match="env_only.*env_plus"):
        S.feature_columns("nope")


def test_validation_rejects_extra_columns_and_bad_cells(spark):
    row = {**S.BASE_DEFAULTS, "slope_deg": 95.0, "latitude": NAN, "rainfall_mm_year": -1.0}
    df = spark.createDataFrame([(7, *(row[c] for c in S.BASE_COLUMNS))], S.SITE_SCHEMA)
    clean, bad = cleaning.split_quarantine(cleaning.validate(df, S.BASE_RULES))
    assert clean.isEmpty()
    assert bad.first()["errors"] == ["rainfall_mm_year: below 0", "slope_deg: above 90",
                                     "latitude: not finite"]
    with pytest.raises(ValueError, match="extra"):
        cleaning.validate(df.withColumn("extra", F.lit(1)), S.BASE_RULES)


def test_override_check(spark):
    rows = [("a", {"slope_deg": 1.0}), ("b", {"zz": 1.0, "aa": 2.0}), ("", {}), ("n", {"slope_deg": NAN})]
    got = values(cleaning.check_overrides(spark.createDataFrame(rows, S.SCENARIO_SCHEMA)),
                 "unknown", "accepted")
    assert got == [([], True), (["aa", "zz"], False), ([], False), ([], False)]


def test_question_check(spark):
    rows = [("why?", 4), ("hm", 4), ("x" * 4001, 4), ("why?", 0), ("why?", 11), (None, 4)]
    got = values(cleaning.check_questions(spark.createDataFrame(rows, "question string, top_k int")),
                 "problem")
    assert [g[0] for g in got] == [None, "question too short", "question too long",
                                   "top_k out of range", "top_k out of range", "question too short"]


def test_source_names(spark):
    rows = ["../../etc/pass wd?.pdf", "a/b/", "...", "ok-name_1.pdf", "x" * 200]
    df = spark.createDataFrame([(r,) for r in rows], "n string")
    got = [r[0] for r in df.select(clean_source_name(F.col("n"))).collect()]
    assert got == ["pass wd_.pdf", "b", "uploaded.pdf", "ok-name_1.pdf", "x" * 120]


def test_upload_listing_and_admission(spark, tmp_path):
    (tmp_path / "a.PDF").write_bytes(b"x" * 10)
    (tmp_path / "b.pdf").write_bytes(b"")
    (tmp_path / "c.txt").write_bytes(b"x")
    got = dict(values(cleaning.admit_uploads(upload_listing(spark, str(tmp_path))), "name", "reason"))
    assert got == {"a.PDF": None, "c.txt": "not a pdf"}  # Spark lists no empty files
    rows = [("d.pdf", S.MAX_UPLOAD_BYTES + 1), ("e.pdf", S.MAX_UPLOAD_BYTES), ("f.pdf", 0)]
    listing = spark.createDataFrame(rows, "name string, size long")
    reasons = [r["reason"] for r in cleaning.admit_uploads(listing).collect()]
    assert reasons == ["too large", None, "empty"]


def test_csv_scan_and_target_filter(spark, tmp_path):
    (tmp_path / "t.csv").write_text("Code,target_dose_rate\na,0.5\nb,NA\nc,\nd,1e-1\n")
    table = csv_table(spark, str(tmp_path / "t.csv"))
    kept = cleaning.drop_missing_target(table, S.REAL_TARGET)
    assert sorted(values(kept, "Code", S.REAL_TARGET)) == [("a", 0.5), ("d", 0.1)]
    with pytest.raises(ValueError):
        cleaning.drop_missing_target(table.where("Code = 'b'"), S.REAL_TARGET)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        csv_table(spark, str(tmp_path / "none.csv"))


def _tables(spark, n=80):
    env = cleaning.fill_absent(spark.range(n).withColumnRenamed("id", S.RECORD_ID),
                               {c: S.REAL_DEFAULTS[c] for c in S.ENV_COLUMNS})
    nuclides = cleaning.fill_absent(spark.range(n).withColumnRenamed("id", S.RECORD_ID),
                                    {c: S.REAL_DEFAULTS[c] for c in S.NUCLIDE_COLUMNS})
    return env, nuclides.withColumn(S.REAL_TARGET, F.lit(0.1))


def test_training_table_choice(spark):
    env, nuclides = _tables(spark)
    with_env = cleaning.fill_absent(nuclides, {c: S.REAL_DEFAULTS[c] for c in S.ENV_COLUMNS})
    assert joins.training_table(env, with_env) is with_env
    assert joins.training_table(with_env, nuclides) is with_env
    zipped = joins.training_table(env, nuclides, env_order=[S.RECORD_ID], nuclide_order=[S.RECORD_ID])
    merged = joins.training_table(env, nuclides)
    for table in (zipped, merged):
        assert table.count() == 80
        assert not missing_columns(table, {*S.feature_columns(), S.REAL_TARGET})
    repeated = nuclides.union(nuclides.limit(1))
    with pytest.raises(ValueError, match="not unique"):
        joins.training_table(env, repeated)
    with pytest.raises(ValueError, match="record id"):
        joins.training_table(env.drop(S.RECORD_ID), nuclides)


def test_merge_renames_clashes(spark):
    left = spark.createDataFrame([("a", 1.0)], "Code string, latitude double")
    right = spark.createDataFrame([("a", 2.0)], "Code string, latitude double")
    assert joins.keyed_merge(left, right).columns == ["Code", "latitude", "latitude_nuclide"]
