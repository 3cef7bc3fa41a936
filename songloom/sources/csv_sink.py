"""The CSV and parquet sinks of the finished catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame

from songloom.operators.shape import CATALOGUE_COLUMNS, complete_columns, export_ready
from songloom.plans.staging import stage

BYTE_ORDER_MARK = "\ufeff"


def _sorted(songs: DataFrame, staged: bool) -> DataFrame:
    """Rows in export order. A global sort first samples its input to find the ranges, which runs
    the part of the plan since the last shuffle twice. ``staged`` writes that part out once instead,
    which pays when it is a scan of many small remote files."""
    complete = complete_columns(songs)
    return export_ready(stage(complete) if staged else complete)


def write_csv(
    songs: DataFrame, path: str, bom: bool = True, mode: str = "errorifexists", staged: bool = False
) -> None:
    """Sorted CSV part files: header, minimal quoting, doubled quotes, null and ``''`` both blank.

    ``bom`` starts each part with a UTF-8 byte-order mark. Part names follow the row order. The
    parts stay apart: joining them would pull the whole table through one task.
    """
    out = _sorted(songs, staged)
    if bom:
        first, *others = CATALOGUE_COLUMNS
        out = out.withColumnRenamed(first, BYTE_ORDER_MARK + first)
    (
        out.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_csv(spark, path: str) -> DataFrame:
    """Read the sink back: blanks come back as nulls."""
    schema = ", ".join(f"{name} {kind}" for name, kind in CATALOGUE_COLUMNS.items())
    return (
        spark.read.option("header", True).option("escape", '"').option("multiLine", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("enforceSchema", True).schema(schema).csv(path)
    )


def write_parquet(songs: DataFrame, path: str, mode: str = "errorifexists", staged: bool = False) -> None:
    _sorted(songs, staged).write.mode(mode).parquet(path)
