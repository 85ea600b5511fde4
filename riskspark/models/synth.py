"""Synthetic training sites with a noisy dose, drawn per block of ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark import schema as S
from riskspark.functions.features import base_features, dose_sum
from riskspark.functions.numeric import clip

ID_BLOCK = 1024

# Fixed values: (column, distribution, parameters, scale, clip range).
DRAWS = (
    ("contamination_bq_m2", "lognormal", (10.25, 0.65), 1.0, (500.0, 150000.0)),
    ("soil_clay_pct", "beta", (2.2, 4.0), 65.0, None),
    ("soil_organic_pct", "beta", (1.8, 7.0), 18.0, None),
    ("rainfall_mm_year", "normal", (780.0, 260.0), 1.0, (120.0, 1800.0)),
    ("elevation_m", "normal", (160.0, 220.0), 1.0, (-5.0, 1400.0)),
    ("slope_deg", "gamma", (2.1, 2.2), 1.0, (0.0, 38.0)),
    ("distance_to_water_km", "gamma", (2.4, 1.8), 1.0, (0.05, 22.0)),
    ("population_density_km2", "lognormal", (5.0, 1.15), 1.0, (1.0, 6500.0)),
    ("latitude", "uniform", (45.0, 66.0), 1.0, None),
    ("longitude", "uniform", (-8.0, 32.0), 1.0, None),
    ("land_cover_urban_pct", "beta", (1.4, 3.2), 100.0, None),
    ("noise", "normal", (0.0, S.DOSE_NOISE_STD), 1.0, None),
)


def _draw_block(seed: int, block: int) -> np.ndarray:
    rng = np.random.default_rng([seed, block])
    columns = []
    for _, distribution, params, scale, bounds in DRAWS:
        values = getattr(rng, distribution)(*params, size=ID_BLOCK) * scale
        columns.append(np.clip(values, *bounds) if bounds else values)
    return np.column_stack(columns)


def synthetic_sites(ids: DataFrame, seed: int = S.SEED) -> DataFrame:
    """Base columns and ``dose_rate_usv_h`` for each ``site_id``.

    A site's values depend on the seed and its id alone, so they are the same
    however the ids are partitioned. Ids that lie together are cheapest.
    """
    names = [d[0] for d in DRAWS]

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["site_id"].to_numpy()
            values = np.empty((len(ids), len(names)))
            for block in np.unique(ids // ID_BLOCK):
                mine = ids // ID_BLOCK == block
                values[mine] = _draw_block(seed, int(block))[ids[mine] % ID_BLOCK]
            out = pd.DataFrame(values, columns=names)
            out.insert(0, "site_id", ids)
            yield out

    fields = ", ".join(f"{n} double" for n in names)
    drawn = ids.select("site_id").mapInPandas(draw, f"site_id long, {fields}")
    noisy = base_features(drawn).withColumn(
        S.TARGET, clip(dose_sum() + F.col("noise"), S.DOSE_FLOOR, None)
    )
    return noisy.select("site_id", *S.BASE_COLUMNS, S.TARGET)


def synthetic_range(spark: SparkSession, n: int = 5000, seed: int = S.SEED) -> DataFrame:
    return synthetic_sites(spark.range(n).withColumnRenamed("id", "site_id"), seed)
