"""Result exports: predictions as JSON, scenarios as CSV, reports as Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_SEPARATOR = "\n---\n"


def write_predictions(scored: DataFrame, path: str) -> None:
    """One JSON object per line."""
    scored.write.mode("overwrite").json(path)


def write_scenarios(compared: DataFrame, path: str) -> None:
    flat = [f.name for f in compared.schema.fields if "<" not in f.dataType.simpleString()]
    compared.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def write_reports(reports: DataFrame, path: str) -> None:
    """Markdown files of many reports each, with a rule between them."""
    text = reports.select(F.col("report_markdown"))
    text.write.mode("overwrite").option("lineSep", REPORT_SEPARATOR).text(path)
