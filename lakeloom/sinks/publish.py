"""The last step of a job: its rows are cast, counted and checked in one pass, then committed or not."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from lakeloom.operators.conform import ErrorBudget, contract_errors, failed_cast, truncate_to_width
from lakeloom.session import scratch_dir
from lakeloom.sinks.versions import Version, _files, replace, upsert


@dataclass(frozen=True)
class Report:
    """What a publication has counted; ``failed`` has the failed casts of each column that has any."""

    rows: int
    rejected: int
    failed: dict[str, int]
    spent: int
    version: Version


@contextmanager
def staged_conformed(rows: DataFrame, schema: T.StructType, *, widths: dict[str, int] | None = None) -> Iterator[tuple[DataFrame, dict[str, int]]]:
    """The rows with every column cast, plus ``_errors``, in files that go with the block, and what was counted meanwhile.

    The counts ride on the write as an observation of its last step, so the rows are computed once; a
    repeated task counts once, too, as only finished tasks of a result stage report.
    """
    broken = [F.when(failed_cast(f.name, f.dataType), F.lit(f.name)) for f in schema]
    cast = rows.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema], F.array_compact(F.array(*broken)).alias("_failed"))
    checked = (truncate_to_width(cast, widths) if widths else cast).withColumn("_errors", contract_errors(schema))
    seen, path = Observation(), scratch_dir(rows.sparkSession, "conformed")
    counts = [F.count_if(F.array_contains("_failed", f.name)).alias(f"failed.{f.name}") for f in schema]
    counted = checked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.size("_errors") > 0).alias("rejected"), *counts)
    try:
        counted.write.parquet(path)
        kinds = T.StructType([*(T.StructField(f.name, f.dataType) for f in schema), T.StructField("_errors", T.ArrayType(T.StringType()))])
        yield rows.sparkSession.read.schema(kinds).parquet(path), seen.get
    finally:
        files, place = _files(rows.sparkSession, path)
        files.delete(place, True)


def publish(
    rows: DataFrame,
    target: str,
    schema: T.StructType,
    *,
    keys: list[str] | None = None,
    budget: ErrorBudget = ErrorBudget(),
    spent: int = 0,
    widths: dict[str, int] | None = None,
    rejects: str | None = None,
) -> Report:
    """Bring rows to the schema and into a table: an upsert with ``keys``, else its whole new content.

    Too many failed casts raise before anything is committed. Rows without a value that the schema
    demands go to ``rejects`` (their whole new content) with the names of the columns.
    """
    with staged_conformed(rows, schema, widths=widths) as (found, counts):
        failed = {f.name: counts[f"failed.{f.name}"] for f in schema if counts[f"failed.{f.name}"]}
        spent = budget.charge(sum(failed.values()), spent)
        good = found.where(F.size("_errors") == 0).drop("_errors")
        if rejects:
            replace(found.where(F.size("_errors") > 0), rejects)
        version = upsert(target, good, keys) if keys else replace(good, target)
    return Report(counts["rows"], counts["rejected"], failed, spent, version)
