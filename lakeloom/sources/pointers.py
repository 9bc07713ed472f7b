"""Pointers from what was decoded back to the record it came in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

POINTER = "pointer"
PARTS = ("file", "block", "id", "print")


def with_pointer(records: DataFrame, column: str, *, record_id: str | None = None) -> DataFrame:
    """Add where a record lies: file and block for files, the queue's id otherwise, and a hash of its text.

    Works on batches and streams; for files it has to be the first step, as later ones lose the
    files' metadata. It is copied to rejects instead of the record, which may hold personal data.
    """
    print_ = F.xxhash64(F.col(column))
    if record_id is None:
        parts = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.lit(None).cast("string"), print_]
    else:
        parts = [F.lit(None).cast("string"), F.lit(None).cast("bigint"), F.col(record_id).cast("string"), print_]
    return records.select("*", F.struct(*[p.alias(n) for p, n in zip(parts, PARTS)]).alias(POINTER))


def pointer_of(rows: DataFrame) -> list[str]:
    """The pointer's column, if the rows have one."""
    return [POINTER] if POINTER in rows.columns else []


def records_of(rejects: DataFrame, records: DataFrame, column: str, *, record_id: str | None = None) -> DataFrame:
    """The records that rejects point to, with the rejects' ``errors``, to be repaired and sent again.

    ``records`` are read anew from their source; equal records of one block are one.
    """
    known = records if POINTER in records.columns else with_pointer(records, column, record_id=record_id)
    wanted = rejects.select(POINTER, "errors").groupBy(POINTER).agg(F.array_distinct(F.flatten(F.collect_list("errors"))).alias("errors")).alias("w")
    same = [_part("k", p).eqNullSafe(_part("w", p)) for p in PARTS]
    return known.alias("k").join(wanted, same).select("k.*", "w.errors")


def _part(side: str, name: str) -> Column:
    return F.col(f"{side}.{POINTER}.{name}")
