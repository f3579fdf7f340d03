"""Report sink: one folder per named table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None
) -> None:
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_reports(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """Write every table under ``folder`` and return name → path."""
    paths = {name: f"{folder}/{name}" for name in tables}
    for name, df in tables.items():
        write_report(df, paths[name], fmt)
    return paths
