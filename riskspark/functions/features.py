"""Engineered site features and the transparent dose equation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark import schema as S
from riskspark.functions.numeric import clip

c = F.col


def soil_retention() -> Column:
    return (c("soil_clay_pct") * 0.55 + c("soil_organic_pct") * 0.45) / 100.0


def runoff_potential() -> Column:
    return F.log1p("rainfall_mm_year") * F.log1p("slope_deg") / 20.0


def water_proximity() -> Column:
    return F.exp(-c("distance_to_water_km") / 3.0)


def exposure_pressure() -> Column:
    return F.log1p("population_density_km2") * (1.0 + c("land_cover_urban_pct") / 100.0)


def spatial_term() -> Column:
    return F.sin(F.radians("latitude")) * F.cos(F.radians("longitude"))


def base_features(df: DataFrame) -> DataFrame:
    """Replace base columns by cleaned ones and add the derived model columns.

    Only columns the input lacks get a default; empty cells stay empty. All
    other columns of ``df`` are kept.
    """
    inputs = {n: c(n) if n in df.columns else F.lit(v) for n, v in S.BASE_DEFAULTS.items()}
    others = [n for n in df.columns if n not in S.MODEL_COLUMNS]
    cleaned = [
        clip(inputs[n].cast("double"), *S.BASE_CLIP.get(n, (None, None))).alias(n)
        for n in S.BASE_COLUMNS
    ]
    derived = (
        soil_retention(),
        runoff_potential(),
        water_proximity(),
        exposure_pressure(),
        spatial_term(),
    )
    return df.select(*others, *cleaned).select(
        "*", *(e.alias(n) for e, n in zip(derived, S.ENGINEERED_COLUMNS, strict=True))
    )


def dose_sum() -> Column:
    """The terms of the dose equation before its floor."""
    return (
        F.lit(S.DOSE_CONSTANT)
        + c("contamination_bq_m2")
        * S.DOSE_PER_CONTAMINATION
        * (1.0 + c("soil_retention_index") * S.DOSE_RETENTION_GAIN)
        + c("runoff_potential") * S.DOSE_PER_RUNOFF
        + c("water_proximity_index") * S.DOSE_PER_PROXIMITY
        + c("exposure_pressure") * S.DOSE_PER_EXPOSURE
        + c("spatial_lat_lon_interaction") * S.DOSE_PER_SPATIAL
        + c("elevation_m") * S.DOSE_PER_ELEVATION
    )


def dose_equation() -> Column:
    """Noise-free dose rate from the model columns; an exact scorer."""
    return clip(dose_sum(), S.DOSE_FLOOR, None)


def equation_scorer(df: DataFrame) -> DataFrame:
    """Score a frame of base records with the dose equation; adds ``dose``."""
    return base_features(df).withColumn("dose", dose_equation())
