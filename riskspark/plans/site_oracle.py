"""The same site queries as ANSI SQL over the given tables."""

from __future__ import annotations

from riskspark import schema as S
from riskspark.operators.drivers import REPORT_DRIVERS
from riskspark.operators.scenarios import BASELINE
from riskspark.plans.site_queries import FIXED_IMPORTANCES, FOLD_BLOCK_DEG, LACKING
from riskspark.sources.fixtures import SCENARIOS


def half_up(expr: str, places: int = 6) -> str:
    return f"floor(({expr}) * 1e{places} + 0.5) / 1e{places}"


def clip(col: str, low, high) -> str:
    out = col
    if low is not None:
        out = f"greatest({out}, {float(low)})"
    if high is not None:
        out = f"least({out}, {float(high)})"
    return f"CASE WHEN {col} IS NOT NULL THEN {out} END"


SITES = """
li AS (
  SELECT l_orderkey, COUNT(*) AS n,
         CAST(SUM(CAST(ROUND(l_quantity) AS BIGINT)) AS DOUBLE) / COUNT(*) AS qty,
         CAST(SUM(CAST(ROUND(l_discount * 100.0) AS BIGINT)) AS DOUBLE) / COUNT(*) / 100.0 AS disc,
         CAST(SUM(CAST(ROUND(l_tax * 100.0) AS BIGINT)) AS DOUBLE) / COUNT(*) / 100.0 AS tax
  FROM lineitem GROUP BY l_orderkey),
sites AS MATERIALIZED (
  SELECT o.o_orderkey AS site_id,
    o.o_totalprice / 3.0 - 500.0 AS contamination_bq_m2,
    li.qty * 2.2 AS soil_clay_pct,
    li.disc * 150.0 AS soil_organic_pct,
    CAST((o.o_orderkey * 37) % 1800 AS DOUBLE) - 50.0 AS rainfall_mm_year,
    c.c_acctbal / 10.0 AS elevation_m,
    li.tax * 1200.0 AS slope_deg,
    CAST((o.o_orderkey * 13) % 220 AS DOUBLE) / 10.0 - 1.0 AS distance_to_water_km,
    CAST((o.o_custkey * 7) % 6500 AS DOUBLE) AS population_density_km2,
    45.0 + n.n_regionkey * 4.0 + CAST(c.c_custkey % 25 AS DOUBLE) * 0.0173 AS latitude,
    -8.0 + n.n_nationkey * 1.5 + CAST(c.c_custkey % 40 AS DOUBLE) * 0.0131 AS longitude,
    CAST(li.n AS DOUBLE) * 11.0 AS land_cover_urban_pct
  FROM orders o
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey)"""


def features(source: str, out: str, extra: str = "") -> str:
    """CTEs that turn base columns of ``source`` into model columns in ``out``."""
    cleaned = ", ".join(
        f"{clip(n, *S.BASE_CLIP[n])} AS {n}" if n in S.BASE_CLIP else n for n in S.BASE_COLUMNS
    )
    return f"""
{out}_clean AS (SELECT site_id, {extra} {cleaned} FROM {source}),
{out} AS (
  SELECT *,
    (soil_clay_pct * 0.55 + soil_organic_pct * 0.45) / 100.0 AS soil_retention_index,
    ln(1.0 + rainfall_mm_year) * ln(1.0 + slope_deg) / 20.0 AS runoff_potential,
    exp(-distance_to_water_km / 3.0) AS water_proximity_index,
    ln(1.0 + population_density_km2) * (1.0 + land_cover_urban_pct / 100.0) AS exposure_pressure,
    sin(radians(latitude)) * cos(radians(longitude)) AS spatial_lat_lon_interaction
  FROM {out}_clean)"""


DOSE_SUM = """CAST(0.025 AS DOUBLE)
  + contamination_bq_m2 * 0.0000062 * (1.0 + soil_retention_index * 0.8)
  + runoff_potential * 0.035 + water_proximity_index * 0.08 + exposure_pressure * 0.006
  + spatial_lat_lon_interaction * 0.025 + elevation_m * -0.000015"""
DOSE = f"CASE WHEN ({DOSE_SUM}) IS NOT NULL THEN greatest({DOSE_SUM}, 0.01) END"


def band(field: int, dose: str = "dose") -> str:
    cases = " ".join(f"WHEN {dose} < {b[0]} THEN '{b[field]}'" for b in S.RISK_BANDS[:-1])
    return (
        f"CASE WHEN {dose} IS NULL THEN NULL {cases} ELSE '{S.RISK_BANDS[-1][field]}' END"
    )


SCORED = f"""{SITES}, {features('sites', 'feat')},
scored AS (SELECT *, {DOSE} AS dose FROM feat)"""
MEASURED = f"""{SCORED},
measured AS (
  SELECT *, dose * (1.0 + (CAST((site_id * 31) % 21 AS DOUBLE) - 10.0) / 100.0) AS target,
         dose AS prediction FROM scored)"""
METRICS = """count(target - prediction) AS n, avg(abs(target - prediction)) AS mae,
  sqrt(avg(power(target - prediction, 2))) AS rmse,
  1 - sum(power(target - prediction, 2)) / (var_pop(target) * count(target)) AS r2"""


def cols(names, places: int = 6) -> str:
    return ", ".join(f"{half_up(n, places)} AS {n}" for n in names)


REAL = f"""{SITES},
real_sites AS (
  SELECT site_id, latitude, longitude, soil_clay_pct AS clay_fraction_0_30,
    soil_organic_pct AS organic_carbon_b0, slope_deg AS slope_deg_final, elevation_m,
    contamination_bq_m2 / 1000.0 AS cs137, population_density_km2 / 100.0 AS sr90
  FROM sites)"""


def real_column(name: str) -> str:
    source = {"cs137_kBq_m2": "cs137", "sr90_kBq_m2": "sr90"}.get(name, name)
    held = {"clay_fraction_0_30", "organic_carbon_b0", "slope_deg_final", "elevation_m"}
    if name not in held | {"latitude", "longitude", "cs137_kBq_m2", "sr90_kBq_m2"}:
        return f"CAST({S.REAL_DEFAULTS[name]} AS DOUBLE) AS {name}"
    return f"{clip(source, *S.REAL_CLIP.get(name, (None, None)))} AS {name}"


def raw_column(name: str) -> str:
    """A real-profile column before clipping, or its default."""
    source = {"cs137_kBq_m2": "cs137", "sr90_kBq_m2": "sr90"}.get(name, name)
    held = {"clay_fraction_0_30", "organic_carbon_b0", "slope_deg_final", "elevation_m"}
    if name in held | {"latitude", "longitude", "cs137_kBq_m2", "sr90_kBq_m2"}:
        return f"{source} AS {name}"
    return f"CAST({S.REAL_DEFAULTS[name]} AS DOUBLE) AS {name}"


def rule_checks(rules=S.BASE_RULES) -> str:
    parts = []
    for name, (low, high) in rules.items():
        whens = f"WHEN {name} IS NULL THEN '{name}: missing'"
        if low is not None:
            whens += f" WHEN {name} < {low} THEN '{name}: below {low:g}'"
        if high is not None:
            whens += f" WHEN {name} > {high} THEN '{name}: above {high:g}'"
        parts.append(f"CASE {whens} END")
    return f"concat_ws('; ', {', '.join(parts)})"


def clean_name(expr: str) -> str:
    base = f"regexp_extract({expr}, '([^/]*)/*$', 1)"
    plain = f"regexp_replace({base}, '[^A-Za-z0-9._ -]', '_', 'g')"
    return f"coalesce(nullif(substr(trim({plain}, ' .'), 1, 120), ''), 'uploaded.pdf')"


REQUESTS = """
requests AS (
  SELECT event_id, CASE WHEN event_id % 29 = 0 THEN '' ELSE event_type || ' ' || event_id END AS name,
    CAST(json_extract(props, '$.k') AS DOUBLE) AS rain, value AS slope,
    CASE event_type WHEN 'error' THEN 'wind_speed' WHEN 'signup' THEN 'albedo' ELSE '' END AS unknown
  FROM events)"""


def compared(source: str) -> str:
    """CTE ``result`` from ``variants``: site, scenario, place, changed base columns."""
    return f"""{features(source, 'vf', 'scenario, scenario_seq,')},
  vs AS (SELECT *, {DOSE} AS dose FROM vf),
  vd AS (SELECT site_id, scenario, scenario_seq, {half_up('greatest(dose, 0.0)', 4)} AS published,
           dose FROM vs),
  vn AS (SELECT *, CASE WHEN dose IS NOT NULL THEN published END AS d4 FROM vd),
  vb AS (SELECT *, max(CASE WHEN scenario_seq = 0 THEN d4 END) OVER (PARTITION BY site_id) AS base FROM vn),
  result AS (
    SELECT v.site_id, v.scenario, v.d4 AS dose_rate_usv_h, {band(1, 'v.dose')} AS risk_level,
      {half_up('v.d4 - v.base', 4)} AS delta_vs_baseline_usv_h
    FROM vb v)"""


def _variants(source: str = "sites") -> str:
    """One scan of the sites beside a list of the scenarios."""
    names = ("Baseline", *(name for name, _ in SCENARIOS))
    listed = ", ".join(f"({seq}, '{name}')" for seq, name in enumerate(names))
    columns = []
    for n in S.BASE_COLUMNS:
        cases = "".join(
            f" WHEN {seq} THEN CAST({overrides[n]} AS DOUBLE)"
            for seq, (_, overrides) in enumerate(SCENARIOS, start=1)
            if n in overrides
        )
        columns.append(f"CASE scenario_seq{cases} ELSE {n} END AS {n}" if cases else n)
    return f"""variants AS (SELECT site_id, scenario, scenario_seq, {', '.join(columns)}
      FROM {source} CROSS JOIN (VALUES {listed}) AS listed(scenario_seq, scenario))"""


def _request_variants() -> str:
    changed = ", ".join(
        {"rainfall_mm_year": "r.rain", "slope_deg": "r.slope"}.get(n, f"s.{n}") + f" AS {n}"
        for n in S.BASE_COLUMNS
    )
    plain = ", ".join(S.BASE_COLUMNS)
    return f"""variants AS (
      SELECT site_id, 'Baseline' AS scenario, 0 AS scenario_seq, {plain} FROM sites
      UNION ALL
      SELECT s.site_id, r.name, 1, {changed} FROM requests r JOIN sites s ON s.site_id = r.event_id
      WHERE r.unknown = '' AND r.name <> '')"""


def _unpivot(aggregate: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS feature, {aggregate.format(n=n)} FROM feat" for n in S.MODEL_COLUMNS
    )


NEAREST = f"""WITH {SITES},
layer AS (
  SELECT s.s_suppkey AS feature_id,
    45.0 + n.n_regionkey * 4.0 + CAST(s.s_suppkey % 11 AS DOUBLE) * 0.05 AS lat1,
    -8.0 + n.n_nationkey * 1.5 + CAST(s.s_suppkey % 13 AS DOUBLE) * 0.04 AS lon1,
    45.0 + n.n_regionkey * 4.0 + CAST(s.s_suppkey % 17 AS DOUBLE) * 0.06 AS lat2,
    -8.0 + n.n_nationkey * 1.5 + CAST(s.s_suppkey % 19 AS DOUBLE) * 0.05 AS lon2
  FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey),
seg AS (
  SELECT radians(lon1) * 6378137.0 AS x1, ln(tan(radians(lat1) / 2.0 + pi() / 4)) * 6378137.0 AS y1,
         radians(lon2) * 6378137.0 AS x2, ln(tan(radians(lat2) / 2.0 + pi() / 4)) * 6378137.0 AS y2
  FROM layer),
pt AS (
  SELECT site_id, radians(longitude) * 6378137.0 AS px,
         ln(tan(radians(latitude) / 2.0 + pi() / 4)) * 6378137.0 AS py FROM sites),
pairs AS (
  SELECT site_id, px, py, x1, y1, x2 - x1 AS dx, y2 - y1 AS dy,
    CASE WHEN x1 = x2 AND y1 = y2 THEN 0.0 ELSE greatest(0.0, least(1.0,
      ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1))
      / (power(x2 - x1, 2) + power(y2 - y1, 2)))) END AS t
  FROM pt CROSS JOIN seg)
SELECT site_id, {half_up(
    'min(sqrt(power(px - (x1 + t * dx), 2) + power(py - (y1 + t * dy), 2))) / 1000.0', 4
)} AS distance_to_water_km
FROM pairs GROUP BY site_id"""


def blocks(size: float, source: str = "sites") -> str:
    return f"""
origin AS (SELECT min(latitude) AS lat0, min(longitude) AS lon0 FROM {source}),
blocked AS (
  SELECT s.*, CAST(CAST(floor((latitude - lat0) / {size}) AS BIGINT) AS VARCHAR) || '_' ||
         CAST(CAST(floor((longitude - lon0) / {size}) AS BIGINT) AS VARCHAR) AS block
  FROM {source} s CROSS JOIN origin),
sizes AS (SELECT block, count(*) AS n_rows FROM blocked GROUP BY block)"""


def greedy_folds(splits: int = S.CV_SPLITS) -> str:
    """One recursion step per block: the lightest fold takes it."""
    loads = ", ".join(f"CAST(0 AS BIGINT) AS l{i}" for i in range(splits))
    least = "least(" + ", ".join(f"g.l{i}" for i in range(splits)) + ")"
    pick = "CASE " + " ".join(
        f"WHEN g.l{i} = {least} THEN {i}" for i in range(splits)
    ) + " END"
    grown = ", ".join(
        f"g.l{i} + CASE WHEN ({pick}) = {i} THEN o.n_rows ELSE 0 END" for i in range(splits)
    )
    return f"""
ordered AS (SELECT block, n_rows, row_number() OVER (ORDER BY n_rows DESC, block) AS k FROM sizes),
g AS (
  SELECT CAST(0 AS BIGINT) AS k, CAST('' AS VARCHAR) AS block, CAST(0 AS BIGINT) AS n_rows,
         CAST(-1 AS BIGINT) AS fold, {loads}
  UNION ALL
  SELECT o.k, o.block, o.n_rows, CAST({pick} AS BIGINT), {grown}
  FROM g JOIN ordered o ON o.k = g.k + 1)"""


MERGED = f"""WITH {REAL}
            SELECT site_id AS "Code", latitude, longitude, {', '.join(
                n if n in ('clay_fraction_0_30', 'organic_carbon_b0', 'slope_deg_final',
                           'elevation_m')
                else f'CAST({S.REAL_DEFAULTS[n]} AS DOUBLE) AS {n}' for n in S.ENV_COLUMNS)},
              latitude AS latitude_nuclide, cs137 AS "cs137_kBq_m2", sr90 AS "sr90_kBq_m2",
              {', '.join(f'CAST({S.REAL_DEFAULTS[n]} AS DOUBLE) AS "{n}"'
                         for n in S.NATURAL_NUCLIDES)},
              cs137 AS target_dose_rate
            FROM real_sites WHERE site_id % 11 <> 0 AND cs137 IS NOT NULL"""


def contribution_ctes() -> str:
    """CTEs ``st`` (moments) and ``l`` (contributions) over ``feat``."""
    stats = _unpivot("avg({n}) AS mean, stddev_samp({n}) AS std")
    contributions = " UNION ALL ".join(
        f"""SELECT f.site_id, '{n}' AS feature, {i} AS place, f.{n} AS value,
        (f.{n} - s.mean) / s.std * {w} AS contribution
        FROM feat f JOIN st s ON s.feature = '{n}'"""
        for i, (n, w) in enumerate(FIXED_IMPORTANCES.items())
    )
    return f"st AS MATERIALIZED ({stats}), l AS ({contributions})"


def report_ctes() -> str:
    """CTEs ``told`` (scenarios) and ``why`` (drivers): Markdown lists per site."""

    def number(value: str) -> str:
        return f"printf('%.3f', floor({value} * 1000 + 0.5) / 1000)"

    return f"""{SITES}, {features('sites', 'feat')}, {contribution_ctes()},
      ranked_drivers AS (SELECT *, row_number() OVER (PARTITION BY site_id
        ORDER BY abs(contribution) DESC, place) AS driver_rank FROM l WHERE contribution IS NOT NULL),
      why AS (SELECT site_id, max(feature) FILTER (WHERE driver_rank = 1) AS strongest,
        string_agg('- ' || feature || ' = ' || {number('value')} || CASE WHEN contribution >= 0
          THEN ' increases risk' ELSE ' decreases risk' END, chr(10) ORDER BY driver_rank) AS drivers
        FROM ranked_drivers WHERE driver_rank <= {REPORT_DRIVERS} GROUP BY site_id),
      {_variants()}, {compared('variants')},
      told AS (SELECT site_id,
        max(dose_rate_usv_h) FILTER (WHERE scenario = '{BASELINE}') AS dose,
        max(risk_level) FILTER (WHERE scenario = '{BASELINE}') AS level,
        string_agg('- ' || scenario || ' -> ' || {number('dose_rate_usv_h')} || ' uSv/h, '
          || risk_level || ' (' || CASE WHEN delta_vs_baseline_usv_h < 0 THEN '' ELSE '+' END
          || {number('delta_vs_baseline_usv_h')} || ')', chr(10) ORDER BY list_position(
          {['Baseline', *(n for n, _ in SCENARIOS)]}, scenario)) AS lines
        FROM result GROUP BY site_id)"""


def oracle_sql() -> dict[str, str]:
    model = cols(S.MODEL_COLUMNS, 8)
    dirty = ["latitude", "longitude", "clay_fraction_0_30", "organic_carbon_b0",
             "slope_deg_final", "elevation_m", "cs137_kBq_m2", "sr90_kBq_m2"]
    env_plus = [n for n in S.feature_columns("env_plus") if n != S.RATIO]
    stats = _unpivot("avg({n}) AS mean, stddev_samp({n}) AS std")
    medians = ", ".join(
        f"coalesce({n}, (SELECT median({n}) FROM feat)) AS {n}" for n in S.MODEL_COLUMNS
    )
    scaled = ", ".join(
        f"({n} - (SELECT avg({n}) FROM feat)) / (SELECT stddev_pop({n}) FROM feat) AS {n}"
        for n in S.MODEL_COLUMNS
    )
    vector = ", ".join(half_up(n, 8) for n in S.BASE_COLUMNS)
    return {
        "site_dose_risk": f"""WITH {SCORED}
            SELECT site_id, {half_up('dose', 8)} AS dose,
              {half_up('dose', 4)} AS dose_rate_usv_h,
              {band(1)} AS risk_level, {band(2)} AS advisory FROM scored""",
        "site_features": f"""WITH {SITES}, {features('sites', 'feat')}
            SELECT site_id, {model} FROM feat""",
        "coerce_and_clip": f"""WITH {REAL.replace(
            "contamination_bq_m2 / 1000.0 AS cs137",
            "CASE WHEN site_id % 17 = 0 THEN NULL WHEN site_id % 19 = 0 THEN 12.5 "
            "WHEN site_id % 23 = 0 THEN NULL ELSE contamination_bq_m2 / 1000.0 END AS cs137",
        )}
            SELECT site_id, {', '.join(map(real_column, dirty))} FROM real_sites""",
        "cs_sr_ratio": f"""WITH {REAL}
            SELECT site_id, {', '.join(map(real_column, env_plus))},
              {half_up('greatest(cs137 / (sr90 + 1e-9), 0.0)', 4)} AS ratio_cs_sr
            FROM real_sites""",
        "validate_quarantine": f"""WITH {SITES}, checked AS (
              SELECT site_id, {rule_checks()} AS errors FROM sites)
            SELECT site_id, CASE WHEN errors = '' THEN 'clean' ELSE 'quarantined' END AS status,
              errors FROM checked""",
        "advanced_validate": f"""WITH {REAL}, filled AS (
              SELECT site_id, {', '.join(map(raw_column, S.REAL_RULES))} FROM real_sites),
            checked AS (SELECT site_id, {rule_checks(S.REAL_RULES)} AS errors FROM filled)
            SELECT site_id, CASE WHEN errors = '' THEN 'clean' ELSE 'quarantined' END AS status,
              errors FROM checked""",
        "scenario_override_check": f"""WITH {REQUESTS}
            SELECT event_id, name, unknown,
              (unknown = '' AND length(name) BETWEEN 1 AND 100) AS accepted FROM requests""",
        "question_validation": """WITH items AS (
              SELECT item_id AS query_id, trim(text) AS question FROM benchmark
              UNION ALL SELECT item_id + 1000000000, '' FROM benchmark
              UNION ALL SELECT item_id + 2000000000, 'qqqzzz vvvxxx' FROM benchmark)
            SELECT query_id, query_id % 13 AS top_k,
              CASE WHEN length(question) < 3 THEN 'question too short'
                WHEN length(question) > 4000 THEN 'question too long'
                WHEN query_id % 13 NOT BETWEEN 1 AND 10 THEN 'top_k out of range'
                ELSE 'ok' END AS status FROM items""",
        "source_name_clean": f"SELECT page_id, {clean_name('url')} AS source_name FROM pages",
        "upload_admission": """WITH files AS (
              SELECT doc_id, source || '-' || doc_id ||
                CASE doc_id % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PDF' WHEN 2 THEN '.txt' ELSE '' END
                AS name,
                CASE WHEN doc_id % 7 = 0 THEN 0 ELSE n_chars * 4000 END AS size FROM documents)
            SELECT doc_id, name, size, CASE WHEN lower(name) NOT LIKE '%.pdf' THEN 'not a pdf'
              WHEN size = 0 THEN 'empty' WHEN size > 26214400 THEN 'too large'
              ELSE 'admitted' END AS status FROM files""",
        "keyed_merge": MERGED,
        "csv_training_table": MERGED,
        "positional_zip": """WITH a AS (
              SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS k FROM orders),
            b AS (SELECT o_totalprice, o_orderkey AS price_key,
              row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS k FROM orders)
            SELECT o_orderkey, o_custkey, o_totalprice, price_key FROM a JOIN b USING (k)""",
        "nearest_layer_km": NEAREST,
        "scenario_compare": f"""WITH {SITES}, {_variants()}, {compared('variants')}
            SELECT * FROM result""",
        "scenario_defaults": f"""WITH {SITES}, lacking AS (
              SELECT * REPLACE ({', '.join(
                  f'CAST({S.BASE_DEFAULTS[n]} AS DOUBLE) AS {n}' for n in LACKING)}) FROM sites),
            {_variants('lacking')}, {compared('variants')} SELECT * FROM result""",
        "scenario_request_quarantine": f"""WITH {SITES}, {REQUESTS}
            SELECT 2 * event_id AS site_id, name AS scenario, 'unknown site' AS reason FROM requests
            WHERE unknown = '' AND name <> '' AND 2 * event_id NOT IN (SELECT site_id FROM sites)""",
        "export_roundtrip": f"""WITH {SITES}, {_variants()}, {compared('variants')}
            SELECT * FROM result""",
        "scenario_requests": f"""WITH {SITES}, {REQUESTS}, {_request_variants()},
            {compared('variants')} SELECT * FROM result""",
        "dedup_scoring": f"""WITH {SCORED}
            SELECT site_id, {half_up('dose', 4)} AS dose_rate_usv_h, {band(1)} AS risk_level,
              count(*) OVER (PARTITION BY {vector}) AS n_same FROM scored""",
        "feature_stats": f"""WITH {SITES}, {features('sites', 'feat')}, st AS ({stats})
            SELECT feature, {half_up('mean')} AS mean, {half_up('std')} AS std FROM st""",
        "holdout_metrics": f"""WITH {MEASURED},
            known AS (SELECT site_id, target, prediction FROM measured WHERE target IS NOT NULL),
            ranked AS (SELECT *, row_number() OVER (ORDER BY
              md5(CAST(site_id AS VARCHAR) || '|42'), site_id) AS k, count(*) OVER () AS total
              FROM known),
            m AS (SELECT k <= ceil(total * 0.2) AS is_test, {METRICS} FROM ranked GROUP BY 1)
            SELECT is_test, n, {cols(['mae', 'rmse', 'r2'])} FROM m""",
        "spatial_blocks": f"WITH {SITES}, {blocks(S.BLOCK_SIZE_DEG)} SELECT * FROM sizes",
        "spatial_folds": f"""WITH RECURSIVE {SITES}, {blocks(FOLD_BLOCK_DEG)}, {greedy_folds()}
            SELECT block, n_rows, fold FROM g WHERE fold >= 0""",
        "kfold_fallback": f"""WITH {SITES},
            r AS (SELECT site_id, row_number() OVER (ORDER BY
              md5(CAST(site_id AS VARCHAR) || '|42'), site_id) - 1 AS k, count(*) OVER () AS n
              FROM sites),
            s AS (SELECT site_id, k, n // 5 AS base, n % 5 AS extra FROM r)
            SELECT site_id, CAST(CASE WHEN k < extra * (base + 1) THEN k // (base + 1)
              ELSE extra + (k - extra * (base + 1)) // base END AS BIGINT) AS fold FROM s""",
        "cv_summary": f"""WITH RECURSIVE {MEASURED}, {blocks(FOLD_BLOCK_DEG, 'measured')},
            {greedy_folds()},
            f AS (SELECT g.fold, {METRICS} FROM blocked b JOIN g ON g.block = b.block
              WHERE g.fold >= 0 GROUP BY g.fold),
            m AS (SELECT count(*) AS folds, CAST(sum(n) AS BIGINT) AS n_rows, avg(mae) AS cv_mae,
              avg(rmse) AS cv_rmse, avg(r2) AS cv_r2, stddev_pop(r2) AS cv_r2_std FROM f)
            SELECT folds, n_rows, {cols(['cv_mae', 'cv_rmse', 'cv_r2', 'cv_r2_std'])} FROM m""",
        "median_impute": f"""WITH {SITES}, {features('sites', 'feat')},
            m AS (SELECT site_id, {medians} FROM feat)
            SELECT site_id, {cols(S.MODEL_COLUMNS)} FROM m""",
        "standardize": f"""WITH {SITES}, {features('sites', 'feat')},
            z AS (SELECT site_id, {scaled} FROM feat)
            SELECT site_id, {cols(S.MODEL_COLUMNS)} FROM z""",
        "importance_drivers": f"""WITH {SITES}, {features('sites', 'feat')}, {contribution_ctes()},
            r AS (SELECT *, row_number() OVER (PARTITION BY site_id
              ORDER BY abs(contribution) DESC, place) AS driver_rank
              FROM l WHERE contribution IS NOT NULL)
            SELECT site_id, driver_rank, feature,
              CASE WHEN contribution >= 0 THEN 'increases risk' ELSE 'decreases risk' END
                AS direction,
              {cols(['value', 'contribution'])} FROM r WHERE driver_rank <= 8""",
    }
