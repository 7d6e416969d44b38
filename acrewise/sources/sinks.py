"""Writers for tables, reports and fitted models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Write a table as parquet (default) or header CSV, in parallel part files."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_report(report: DataFrame, path: str) -> None:
    """Write an aggregate-sized report as JSON lines."""
    report.write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
