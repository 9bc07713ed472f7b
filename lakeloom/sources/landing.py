"""Files that other systems put into the landing area."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FORMATS = ("parquet", "csv")


def landing_path(root: str, system: str, component: str, *, level: str | None = None, fmt: str = "parquet") -> str:
    """``<root>/ingress/<system>/<format>/<component>/[<level>/]``."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown landing format: {fmt}")
    tail = f"{level}/" if level else ""
    return f"{root.rstrip('/')}/ingress/{system}/{fmt}/{component}/{tail}"


def read_landing(
    spark: SparkSession,
    root: str,
    system: str,
    component: str,
    *,
    level: str | None = None,
    fmt: str = "parquet",
    schema=None,
) -> DataFrame:
    """One component. CSV without a schema has its types inferred, which reads it twice."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        reader = reader.option("inferSchema", "true")
    if fmt == "csv":
        reader = reader.option("header", "true")
    else:
        reader = reader.option("mergeSchema", "true")
    return reader.load(landing_path(root, system, component, level=level, fmt=fmt))
