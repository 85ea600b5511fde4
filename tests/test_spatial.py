import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark import schema as S
from riskspark.operators import folds, joins, nearest, ranking
from riskspark.operators import statistics as stats
from riskspark.session import materialize


def greedy(histogram, splits):
    load, placed = [0] * splits, []
    for size, groups in sorted(histogram, reverse=True):
        for _ in range(groups):
            f = min(range(splits), key=lambda i: (load[i], i))
            load[f] += size
            placed.append(f)
    return placed


def test_fold_cycles_equal_the_greedy_rule():
    rng = random.Random(3)
    for _ in range(800):
        sizes = rng.sample(range(1, rng.choice([5, 30, 400])), rng.randint(1, 4))
        histogram = [(s, rng.randint(1, 12)) for s in sizes]
        splits = rng.randint(1, 7)
        placed = []
        for _, first, end, turn in folds.fold_cycles(histogram, splits):
            assert first == len(placed)
            placed += [turn[(r - first) % len(turn)] for r in range(first, end)]
        assert placed == greedy(histogram, splits)


def test_one_giant_block_costs_no_simulation():
    parts = list(folds.fold_cycles([(10**9, 1), (1, 3 * 10**9)], 4))
    assert len(parts) <= 8 and parts[-1][2] == 3 * 10**9 + 1


def _sites(spark, rows):
    return materialize(
        spark.createDataFrame(rows, "site_id long, latitude double, longitude double"), "t"
    )


def test_blocks_stay_whole_and_folds_are_even(spark):
    rng = random.Random(1)
    rows = [(i, rng.random(), rng.random()) for i in range(2000)]
    table = _sites(spark, rows)
    folded = folds.spatial_folds(table, 5, 0.05)
    blocked = folds.with_blocks(folded, 0.05)
    assert folded.count() == 2000
    assert blocked.groupBy("block").agg(F.countDistinct("fold").alias("n")).where("n > 1").isEmpty()
    sizes = [r["count"] for r in folded.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 10


def test_few_blocks_and_one_block(spark):
    two = folds.spatial_folds(_sites(spark, [(i, float(i % 2), 0.0) for i in range(10)]), 5, 0.5)
    assert two.select("fold").distinct().count() == 2
    one = folds.spatial_folds(_sites(spark, [(i, 0.0, 0.0) for i in range(13)]), 5, 0.5)
    assert sorted(r["count"] for r in one.groupBy("fold").count().collect()) == [2, 2, 3, 3, 3]
    with pytest.raises(ValueError):
        folds.spatial_folds(_sites(spark, [(1, 0.0, 0.0)]))
    with pytest.raises(ValueError):
        folds.with_blocks(_sites(spark, [(1, 0.0, 0.0)]), 0.0)


def test_hot_block_takes_the_salted_path(spark):
    rows = [(i, 0.0 if i % 3 == 0 else i * 0.1, 0.0) for i in range(900)]
    blocked = folds.with_blocks(_sites(spark, rows), 0.05)
    assigned = folds.group_folds(folds.block_sizes(blocked))
    small = joins.lookup_join(blocked, assigned, "block", "n_rows")
    large = joins.lookup_join(blocked, assigned, "block", "n_rows", rows=1)
    key = ["site_id", "fold"]
    assert sorted(small.select(key).collect()) == sorted(large.select(key).collect())
    assert large.count() == 900


def test_global_rank_is_dense(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1009).alias("k"), F.lit(1).alias("one"))
    ranked = ranking.global_rank(df, ["k"], "rank", "total").orderBy("k").collect()
    assert [r["rank"] for r in ranked] == list(range(1000))
    assert {r["total"] for r in ranked} == {1000}


def test_hash_cutoffs_walk_several_levels(spark):
    import hashlib

    table = materialize(spark.range(3000).withColumnRenamed("id", "k"), "k")
    order = sorted((hashlib.md5(f"{i}|7".encode()).hexdigest(), i) for i in range(3000))
    got = ranking.hash_cutoffs(table, "k", 7, [0, 5, 1500, 2999], leaf_rows=1)
    assert got == [order[i] for i in (0, 5, 1500, 2999)]
    split = ranking.holdout_split(table, "k", 0.2, 7)
    chosen = {r["k"] for r in split.where("is_test").collect()}
    assert chosen == {i for _, i in order[:600]}


def test_top_rows_and_cutoff(spark):
    df = spark.range(5000).select((F.col("id") % 50).alias("total"), F.col("id").alias("term"))
    df = df.withColumn("term", F.format_string("%05d", "term"))
    kept = ranking.at_least_top(df, "total", 120)
    assert kept.count() == 200
    top = ranking.top_rows(kept, [F.col("total").desc(), F.col("term")], 120, "term").collect()
    expected = sorted(((i % 50, f"{i:05d}") for i in range(5000)), key=lambda x: (-x[0], x[1]))[:120]
    assert [(r["total"], r["term"]) for r in top] == expected


def brute(px, py, segments):
    best = math.inf
    for x1, y1, x2, y2 in segments:
        dx, dy = x2 - x1, y2 - y1
        d2 = dx * dx + dy * dy
        t = 0.0 if d2 == 0 else max(0.0, min(1.0, ((px - x1) * dx + (py - y1) * dy) / d2))
        best = min(best, math.hypot(px - x1 - t * dx, py - y1 - t * dy))
    return best


def mercator(lon, lat):
    r = 6378137.0
    return r * math.radians(lon), r * math.log(math.tan(math.pi / 4 + math.radians(lat) / 2))


@pytest.mark.parametrize("shape", ["spread", "clustered", "star"])
def test_nearest_equals_brute_force(spark, shape):
    rng = random.Random(5)
    lines = []
    for i in range(300):
        if shape == "clustered":
            lon, lat = 10 + rng.gauss(0, 1e-4), 50 + rng.gauss(0, 1e-4)
            lines.append((i, lat, lon, lat + 1e-5, lon - 1e-5))
        elif shape == "star":
            lines.append((i, 50.0, 10.0, 50 + rng.uniform(-9, 9), 10 + rng.uniform(-9, 9)))
        else:
            lon, lat = rng.uniform(-20, 40), rng.uniform(30, 65)
            lines.append((i, lat, lon, lat + rng.uniform(-3, 3), lon + rng.uniform(-3, 3)))
    lines += lines[:50]
    layer = spark.createDataFrame(lines, "feature_id long, lat1 double, lon1 double, lat2 double, "
                                  "lon2 double")
    points = [(i, rng.uniform(25, 70), rng.uniform(-60, 60)) for i in range(200)]
    points += [(200, None, 1.0)]
    df = spark.createDataFrame(points, "site_id long, latitude double, longitude double")
    got = {r["site_id"]: r["distance_to_water_km"] for r in
           nearest.nearest_distance_km(df, layer).collect()}
    assert got.pop(200) == 0.0 and len(got) == 200
    metric = [(*mercator(lo1, la1), *mercator(lo2, la2)) for _, la1, lo1, la2, lo2 in lines]
    for i, lat, lon in points[:200]:
        assert got[i] == pytest.approx(brute(*mercator(lon, lat), metric) / 1000, rel=1e-9, abs=1e-9)


def test_empty_layer_gives_zero(spark):
    df = spark.createDataFrame([(1, 50.0, 10.0)], "site_id long, latitude double, longitude double")
    layer = spark.createDataFrame([], "feature_id long, lat1 double, lon1 double, lat2 double, "
                                  "lon2 double")
    assert nearest.nearest_distance_km(df, layer).first()["distance_to_water_km"] == 0.0


def test_medians_bracketed_and_direct(spark):
    rng = np.random.default_rng(0)
    data = {
        "a": rng.normal(size=5001),
        "b": np.where(rng.random(5001) < 0.6, 0.0, rng.random(5001)),
        "c": np.repeat(2.5, 5001),
        "d": np.round(rng.gamma(2.0, size=5001), 1),
    }
    rows = [tuple(None if (i % 7 == 0 and n == "a") else float(v[i]) for n, v in data.items())
            for i in range(5001)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    expected = {n: np.nanmedian([np.nan if r[i] is None else r[i] for r in rows])
                for i, n in enumerate(data)}
    assert stats.exact_medians(df, list(data)) == pytest.approx(expected)
    assert stats.exact_medians(df, list(data), leaf=3) == pytest.approx(expected)
    groups = {"low": F.col("d") < 1.0, "all": F.lit(True), "pair": F.col("d") == 1.5}
    by_group = stats.grouped_medians(df, ["a", "d"], groups, leaf=2)
    assert by_group["all"] == pytest.approx({n: expected[n] for n in ("a", "d")})
    for key, kept in (("low", lambda r: r[3] < 1.0), ("pair", lambda r: r[3] == 1.5)):
        for i, n in ((0, "a"), (3, "d")):
            some = [np.nan if r[i] is None else r[i] for r in rows if kept(r)]
            assert by_group[key][n] == pytest.approx(np.nanmedian(some))
    huge = spark.createDataFrame([(v,) for v in (-1e308, 1e308, 1e-300, 5e-324, 0.0)], "x double")
    assert stats.exact_medians(huge, ["x"], leaf=1) == {"x": 5e-324}
    with pytest.raises(ValueError, match="no values"):
        stats.exact_medians(df.withColumn("e", F.lit(None).cast("double")), ["e"])


def test_metrics_by_hand(spark):
    rows = [(1.0, 1.5), (2.0, 2.0), (4.0, 3.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "target double, prediction double")
    m = df.agg(*stats.regression_metrics()).first()
    assert (m["n"], m["mae"]) == (3, 0.5)
    assert m["rmse"] == pytest.approx(math.sqrt(1.25 / 3))
    assert m["r2"] == pytest.approx(1 - 1.25 / (14 / 3))
    constant = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "target double, prediction double")
    assert constant.agg(*stats.regression_metrics()).first()["r2"] == 1.0
    single = constant.limit(1).agg(*stats.regression_metrics()).first()
    assert single["r2"] is None


def test_constant_feature_has_std_one(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert stats.feature_stats(df, ["x"]).first()["std"] == 1.0
    assert stats.scaling(df, ["x"]) == {"x": (1.0, 1.0)}


def test_default_block_size():
    assert S.BLOCK_SIZE_DEG == 0.02 and S.CV_SPLITS == 5


def test_cutoffs_end_on_equal_keys(spark):
    rows = [(5,)] * 20 + [(i,) for i in range(100, 110)]
    table = materialize(spark.createDataFrame(rows, "k long"), "equal")
    ordered = sorted((r["h"], r["k"]) for r in table.select("k", ranking.shuffle_hash("k", 7).alias("h")).collect())
    got = ranking.hash_cutoffs(table, "k", 7, [0, 12, 29], leaf_rows=5)
    assert got == [ordered[i] for i in (0, 12, 29)]
    with pytest.raises(ValueError, match="null"):
        ranking.hash_cutoffs(spark.createDataFrame([(None,), (1,)], "k long"), "k", 7, [0])


def test_unequal_tables_are_not_zipped(spark):
    a, b = spark.range(10).toDF("x"), spark.range(7).toDF("y")
    with pytest.raises(ValueError, match="10 and 7"):
        joins.positional_zip(a, b, ["x"], ["y"])


def test_rows_without_coordinates_are_set_aside(spark):
    rows = [(1, 1.0, 2.0), (2, None, 2.0), (3, 1.0, None), (4, None, None)]
    df = spark.createDataFrame(rows, "site_id long, latitude double, longitude double")
    with pytest.raises(ValueError, match="coordinates"):
        folds.with_blocks(df)
    located, rest = folds.split_located(df)
    assert [r["site_id"] for r in located.collect()] == [1]
    assert sorted(r["site_id"] for r in rest.collect()) == [2, 3, 4]
    assert folds.with_blocks(located).first()["block"] == "0_0"


def test_points_of_one_place_share_a_walk(spark, monkeypatch):
    kept = {}
    stored = nearest.materialize

    def watched(df, name, *args):
        kept[name] = stored(df, name, *args)
        return kept[name]

    monkeypatch.setattr(nearest, "materialize", watched)
    spots = [(i, 50.0 + i % 3, 10.0 + i % 2) for i in range(600)] + [(600, None, 1.0)]
    points = spark.createDataFrame(spots, "site_id long, latitude double, longitude double")
    layer = spark.createDataFrame(
        [(50.0, 10.0, 50.5, 10.5), (52.0, 11.0, 52.0, 12.0)], "lat1 double, lon1 double, lat2 double, lon2 double"
    )
    found = {r["site_id"]: r["distance_to_water_km"] for r in nearest.nearest_distance_km(points, layer).collect()}
    assert kept["places"].count() == 6
    assert len(found) == 601 and found[600] == 0.0
    assert found[0] == pytest.approx(0.0, abs=1e-6) and found[5] == pytest.approx(0.0, abs=1e-6)
    assert all(found[i] == found[i % 6] for i in range(600)) and found[1] > 0
