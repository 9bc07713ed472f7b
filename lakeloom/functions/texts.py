"""Text, base64 and CSV-in-a-field expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lakeloom.functions.nested import let


def decode_base64(text: Column) -> Column:
    """UTF-8 text behind base64; null if the input is not base64."""
    return F.try_to_binary(text, F.lit("base64")).cast("string")


def encode_base64(text: Column) -> Column:
    """Base64 of UTF-8 text on one line."""
    lines = F.base64(text.cast("binary"))
    return F.replace(F.replace(lines, F.lit("\r"), F.lit("")), F.lit("\n"), F.lit(""))


def stream_event_type(arn: Column) -> Column:
    """Event type at the end of a stream name: last ``/`` part, then last ``-`` part."""
    return F.element_at(F.split(F.element_at(F.split(arn, "/"), -1), "-"), -1)


def strip_prefix(text: Column, prefix: str) -> Column:
    return F.when(text.startswith(prefix), F.substring(text, len(prefix) + 1, 1 << 30)).otherwise(text)


def clean_name(text: Column) -> Column:
    """Name in the form used for matching: trimmed upper case."""
    return F.upper(F.trim(text))


def deletions(text: Column, distance: int) -> Column:
    """All texts reached by removing up to ``distance`` characters.

    Two texts within that edit distance always share at least one of them, which
    turns an edit-distance join into an equality join.
    """

    def drop_one(value: Column) -> Column:
        positions = F.when(F.length(value) > 0, F.sequence(F.lit(1), F.length(value))).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(
            positions,
            lambda i: F.concat(F.substr(value, F.lit(1), i - 1), F.substr(value, i + 1)),
        )

    reached = F.array(text)
    layer = reached
    for _ in range(distance):
        layer = F.array_distinct(F.flatten(F.transform(layer, drop_one)))
        reached = F.array_union(reached, layer)
    return reached


def csv_rows(text: Column) -> Column:
    """Rows of a CSV text as an array of header -> value maps, blank lines left out."""
    lines = F.filter(F.split(text, r"\r\n|\r|\n"), lambda line: F.length(line) > 0)

    def rows(lines: Column) -> Column:
        def under(header: Column) -> Column:
            return F.transform(
                F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))),
                lambda line: F.map_from_arrays(header, _fit(csv_cells(line), F.size(header))),
            )

        return let(csv_cells(F.get(lines, F.lit(0))), under)

    return let(lines, rows)


# Fixed value: a comma and the cell after it, quoted or not.
CSV_CELL = ',("(?:[^"]|"")*"|[^,]*)'


def csv_cells(line: Column) -> Column:
    """Cells of one CSV line; quotes may hold commas, a doubled quote is one quote."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(CSV_CELL), F.lit(1))
    return F.transform(
        raw,
        lambda cell: F.when(
            cell.startswith('"'),
            F.replace(F.substr(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(cell),
    )


def _fit(cells: Column, width: Column) -> Column:
    """Pad with nulls or cut so that a short or long line still fits the header."""

    def fitted(cells: Column) -> Column:
        lacking = F.greatest(width - F.size(cells), F.lit(0))
        return F.slice(F.concat(cells, F.array_repeat(F.lit(None).cast("string"), lacking)), 1, width)

    return let(cells, fitted)
