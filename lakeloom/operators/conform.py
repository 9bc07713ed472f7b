"""Bringing a frame to a schema: flatten, rename, cast with a budget, contracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from lakeloom.session import scratch_dir


def flatten_structs(rows: DataFrame) -> DataFrame:
    """Flat columns first, then the fields of every struct as ``struct_field``. One level."""
    flat = [F.col(f"`{f.name}`") for f in rows.schema if not isinstance(f.dataType, T.StructType)]
    nested = [
        F.col(f"`{f.name}`")[g.name].alias(f"{f.name}_{g.name}")
        for f in rows.schema
        if isinstance(f.dataType, T.StructType)
        for g in f.dataType
    ]
    return rows.select(*flat, *nested)


def with_missing(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add typed null columns where the frame lacks them."""
    lacking = {name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in rows.columns}
    return rows.withColumns(lacking) if lacking else rows


def union_versions(*versions: DataFrame) -> DataFrame:
    """Union by name of file versions that do not have the same columns."""
    first, *others = versions
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def select_trimmed(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``{source: target}`` columns as trimmed text."""
    return rows.select(*[F.trim(F.col(f"`{s}`").cast("string")).alias(t) for s, t in columns.items()])


@dataclass(frozen=True)
class ErrorBudget:
    """How many casts may fail in one step and in the whole job."""

    stage: int = 100
    total: int = 250

    def charge(self, failed: int, spent: int = 0) -> int:
        """Failures so far including this step; raises when a limit is passed."""
        if failed > self.stage or spent + failed > self.total:
            raise ValueError(f"{failed} casts failed in this step, {spent + failed} in total")
        return spent + failed


def failed_cast(column: str, kind: T.DataType) -> Column:
    value = F.col(f"`{column}`")
    return value.isNotNull() & value.try_cast(kind).isNull()


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast every schema column; a value that cannot be cast becomes null."""
    return rows.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])


def cast_failures(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """One row with the number of failed casts per column and in all (``total``)."""
    counts = [F.count_if(failed_cast(f.name, f.dataType)).alias(f.name) for f in schema]
    one = rows.agg(*counts)
    total = F.lit(0).cast("bigint")
    for f in schema:
        total = total + F.col(f"`{f.name}`")
    return one.withColumn("total", total)


def conform_within(rows: DataFrame, schema: T.StructType, budget: ErrorBudget = ErrorBudget(), spent: int = 0) -> DataFrame:
    """Like :func:`conform`, after checking the failures against the budget.

    The rows are computed once: they are written to the scratch folder, counted by an observation of
    that write, and read back.
    """
    spark, path, seen = rows.sparkSession, scratch_dir(rows.sparkSession, "conformed"), Observation()
    failures = [F.when(failed_cast(f.name, f.dataType), 1).otherwise(0) for f in schema]
    counted = rows.select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema], sum(failures, F.lit(0)).alias("_failed"))
    counted.observe(seen, F.coalesce(F.sum("_failed"), F.lit(0)).alias("total")).drop("_failed").write.parquet(path)
    budget.charge(seen.get["total"], spent)
    return spark.read.schema(conform(rows, schema).schema).parquet(path)


def drop_empty_columns(rows: DataFrame) -> DataFrame:
    """Leave out columns that hold no value at all. Reads the data once, so on request only."""
    counted = rows.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in rows.columns]).first()
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if counted[c] > 0])


def contract_errors(schema: T.StructType) -> Column:
    """Names of the non-nullable columns that are null in a row."""
    checks = [F.when(F.col(f"`{f.name}`").isNull(), F.lit(f.name)) for f in schema if not f.nullable]
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def split_contract(rows: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the not-null contract, and the others with their ``_errors``."""
    checked = rows.withColumn("_errors", contract_errors(schema))
    return checked.filter(F.size("_errors") == 0).drop("_errors"), checked.filter(F.size("_errors") > 0)


def truncate_to_width(rows: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Cut over-long text to the column's width in characters."""
    return rows.withColumns({c: F.left(F.col(f"`{c}`"), F.lit(n)) for c, n in widths.items()})


def profile(rows: DataFrame, *, sample: int = 5, where: Column | None = None) -> dict:
    """Row count, schema and a few rows, for debugging."""
    shown = rows if where is None else rows.filter(where)
    return {"count": rows.count(), "schema": rows.schema.simpleString(), "sample": shown.limit(sample).collect()}
