"""Record cleaning, real-profile features and rule-based quarantine."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark import schema as S
from riskspark.functions.numeric import clip, to_number
from riskspark.sources.tables import require_columns

c = F.col


def fill_absent(df: DataFrame, defaults: Mapping[str, float]) -> DataFrame:
    """Add columns the frame lacks with their default; empty cells stay empty."""
    return df.withColumns({n: F.lit(v) for n, v in defaults.items() if n not in df.columns})


def coerce(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({n: to_number(c(n)) for n in columns if n in df.columns})


def clip_columns(df: DataFrame, ranges: Mapping[str, tuple]) -> DataFrame:
    return df.withColumns({n: clip(c(n), *r) for n, r in ranges.items() if n in df.columns})


def real_features(
    df: DataFrame, features: Iterable[str], keep: Iterable[str] = ()
) -> DataFrame:
    """Cleaned model columns of the real profile, in the given order.

    A ratio column in the input wins; only without one is it derived, and then
    from the values before clipping.
    """
    features = list(features)
    wanted = {*features, *S.COORDINATES, S.RATIO}
    derive_ratio = S.RATIO in features and S.RATIO not in df.columns
    if S.RATIO in features:
        wanted |= set(S.ARTIFICIAL_NUCLIDES)
    full = fill_absent(df, {n: v for n, v in S.REAL_DEFAULTS.items() if n in wanted})
    full = coerce(require_columns(full, features), S.REAL_DEFAULTS)
    if derive_ratio:
        cs, sr = (c(n) for n in S.ARTIFICIAL_NUCLIDES)
        full = full.withColumn(S.RATIO, cs / (sr + 1e-9))
    ranges = dict(S.REAL_CLIP)
    if S.RATIO in features:
        ranges[S.RATIO] = S.REAL_RULES[S.RATIO]
    return clip_columns(full, ranges).select(*keep, *features)


def drop_missing_target(df: DataFrame, target: str) -> DataFrame:
    """Keep rows whose target is a number; a table without any is an error."""
    kept = df.withColumn(target, to_number(c(target))).where(c(target).isNotNull())
    if kept.isEmpty():
        raise ValueError(f"target column {target!r} has no numeric values")
    return kept


def rule_errors(rules: Mapping[str, tuple]) -> Column:
    """Names of the broken rules of a record as ``column: what``, in rule order."""
    checks = []
    for name, (low, high) in rules.items():
        value = c(name)
        finite = ~F.isnan(value) & (F.abs(value) < float("inf"))
        problem = F.when(value.isNull(), "missing").when(~finite, "not finite")
        if low is not None:
            problem = problem.when(value < low, f"below {low:g}")
        if high is not None:
            problem = problem.when(value > high, f"above {high:g}")
        checks.append(F.concat(F.lit(f"{name}: "), problem))
    return F.array_compact(F.array(*checks))


def validate(
    df: DataFrame, rules: Mapping[str, tuple], keys: Iterable[str] = ("site_id",)
) -> DataFrame:
    """Add ``errors``. Columns without a rule or key role make the frame invalid."""
    unknown = sorted(set(df.columns) - set(rules) - set(keys))
    if unknown:
        raise ValueError(f"unexpected columns: {', '.join(unknown)}")
    require_columns(df, rules)
    return df.withColumn("errors", rule_errors(rules))


def split_quarantine(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows) of a validated frame."""
    clean = validated.where(F.size("errors") == 0).drop("errors")
    return clean, validated.where(F.size("errors") > 0)


def check_overrides(scenarios: DataFrame, profile: str = "base") -> DataFrame:
    """Add the sorted ``unknown`` override names and ``accepted`` per scenario."""
    allowed = F.array(*(F.lit(n) for n in S.allowed_overrides(profile)))
    unknown = F.array_sort(F.array_except(F.map_keys("overrides"), allowed))
    low, high = S.SCENARIO_NAME_LENGTH
    bad_number = F.exists(
        F.map_values("overrides"), lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    )
    return scenarios.withColumn("unknown", unknown).withColumn(
        "accepted",
        (F.size("unknown") == 0)
        & F.coalesce(F.length("name").between(low, high), F.lit(False))
        & ~bad_number,
    )


def check_questions(questions: DataFrame) -> DataFrame:
    """Add ``problem`` (null when fine) to rows of ``question, top_k``."""
    low, high = S.QUESTION_LENGTH
    size = F.length(F.coalesce(c("question"), F.lit("")))
    return questions.withColumn(
        "problem",
        F.when(size < low, "question too short")
        .when(size > high, "question too long")
        .when(~F.coalesce(c("top_k").between(1, S.MAX_TOP_K), F.lit(False)), "top_k out of range"),
    )


def admit_uploads(listing: DataFrame) -> DataFrame:
    """Add ``reason`` (null when admitted) to rows of ``name, size``."""
    return listing.withColumn(
        "reason",
        F.when(~F.coalesce(F.lower("name").endswith(".pdf"), F.lit(False)), "not a pdf")
        .when(F.coalesce(c("size"), F.lit(0)) <= 0, "empty")
        .when(c("size") > S.MAX_UPLOAD_BYTES, "too large"),
    )
