"""Token ids in Arrow files of equal-length sequences, readable at random without copying.

A file holds record batches of ``batch_rows`` sequences in two fixed-size lists: ``ids`` (16 bits
where the vocabulary fits) and ``mask`` (false on the padding behind the last document of a
file). Sequence ``i`` of a file is row ``i % batch_rows`` of batch ``i // batch_rows``. A second
Arrow file beside it lists the documents with the place of their first id and their length.

Nulls and empty texts hold the end id alone. Rows with equal doc_id follow each other by text,
a null doc_id comes first, an empty table gives no files. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakeloom.llm.common import giving_back, parts_for, put_file, shared_files, small_batches, staged
from lakeloom.llm.tokens import arrow_rows, encoded_batches
from lakeloom.session import scratch_dir

LENGTH, BATCH_ROWS, ROWS_PER_FILE = 1024, 256, 8192
_FILES = "part int, path string, n_docs long, n_tokens long"
_DOCS = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64())])
_OUT = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


class _Writer:
    """Collects ids and hands out full record batches."""

    def __init__(self, length: int, batch_rows: int, kind: pa.DataType):
        self.length, self.batch_rows, self.kind = length, batch_rows, kind
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.held: list[np.ndarray] = []
        self.count = 0

    def _batch(self, ids: np.ndarray, used: int) -> pa.RecordBatch:
        mask = np.arange(len(ids)) < used
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(v), self.length) for v in (ids, mask)]
        return pa.RecordBatch.from_arrays(lists, schema=self.schema)

    def add(self, ids: np.ndarray):
        self.held.append(ids)
        self.count += len(ids)
        size = self.length * self.batch_rows
        if self.count >= size:
            flat = np.concatenate(self.held)
            cut = self.count // size * size
            for a in range(0, cut, size):
                yield self._batch(flat[a : a + size], size)
            self.held, self.count = [flat[cut:]], self.count - cut

    def rest(self):
        if self.count:
            flat = np.concatenate(self.held)
            full = np.zeros(-(-self.count // self.length) * self.length, flat.dtype)
            full[: self.count] = flat
            yield self._batch(full, self.count)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, *, lowers: bool, end: int, wide: bool = False,
                      length: int = LENGTH, batch_rows: int = BATCH_ROWS, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Encode whole texts in ascending doc_id order into files below ``path``; one row per file."""
    kind = pa.uint32() if wide else pa.uint16()

    def write(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        target = f"{path}/part-{part:06d}.arrow"
        kept: list[pa.RecordBatch] = []
        place = 0

        def tokens(out):
            nonlocal place
            made = _Writer(length, batch_rows, kind)
            with pa.ipc.new_file(out, made.schema) as sink:
                for batch, ids, counts in encoded_batches(batches, tokenizer, lowers, end):
                    starts = place + np.cumsum(counts) - counts
                    kept.append(arrow_rows(_DOCS, doc_id=batch.column("doc_id"), at=starts, n_tokens=counts))
                    place += int(counts.sum())
                    for ready in made.add(ids.astype(kind.to_pandas_dtype())):
                        sink.write_batch(ready)
                for ready in made.rest():
                    sink.write_batch(ready)

        def index(out):
            with pa.ipc.new_file(out, _DOCS) as sink:
                for rows in kept:
                    sink.write_batch(rows)

        put_file(target, tokens)
        put_file(target + ".docs", index)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [target], "n_docs": [sum(r.num_rows for r in kept)], "n_tokens": [place]})

    small_batches(docs.sparkSession)  # not a whole file's texts at once on both sides of a worker
    n = parts_for(docs, rows_per_file)
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    return staged(ordered.mapInArrow(giving_back(write), _FILES), "token-files")


class TokenFile:
    """Random access to one file; local files are mapped, so slices are views."""

    def __init__(self, path: str):
        files, inner = shared_files(path)
        local = type(files).__name__ == "LocalFileSystem"
        self.reader = pa.ipc.open_file(pa.memory_map(inner) if local else files.open_input_file(inner))
        self.length = self.reader.schema.field("ids").type.list_size
        self.rows = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 1

    def _values(self, batch: int, column: str) -> pa.Array:
        lists = self.reader.get_batch(batch).column(column)
        return lists.values.slice(lists.offset * self.length, len(lists) * self.length)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view) and mask of one sequence."""
        a = i % self.rows * self.length
        ids = self._values(i // self.rows, "ids").to_numpy()[a : a + self.length]
        mask = self._values(i // self.rows, "mask").slice(a, self.length).to_numpy(zero_copy_only=False)
        return ids, mask

    def tokens(self, start: int, count: int) -> np.ndarray:
        """Ids of a stretch, across batches if need be."""
        size, found = self.length * self.rows, []
        while count:
            a = start % size
            values = self._values(start // size, "ids").to_numpy()[a : a + count]
            found.append(values)
            start, count = start + len(values), count - len(values)
        return np.concatenate(found) if len(found) != 1 else found[0]


def read_token_files(files: DataFrame) -> DataFrame:
    """One row per document of the files, in the files' own order: place, length and crc32 of its 32-bit ids."""

    def read(batches):
        for batch in batches:
            for part, path in zip(batch.column("part").to_pylist(), batch.column("path").to_pylist()):
                held = TokenFile(path)
                where, inner = shared_files(path + ".docs")
                with where.open_input_file(inner) as source:
                    for docs in pa.ipc.open_file(source).read_all().to_batches():
                        at, n = docs.column("at").to_numpy(), docs.column("n_tokens").to_numpy()
                        crc = [zlib.crc32(held.tokens(a, c).astype("<u4")) for a, c in zip(at.tolist(), n.tolist())]
                        yield arrow_rows(_OUT, part=np.full(len(at), part), doc_id=docs.column("doc_id"), at=at, n_tokens=n, ids_crc32=crc)

    kinds = "part int, doc_id long, at long, n_tokens long, ids_crc32 long"
    spread = files.select("part", "path").repartition(max(1, files.count()))
    return spread.mapInArrow(giving_back(read), kinds)


def token_file_digest(docs: DataFrame, tokenizer: str, *, lowers: bool, end: int) -> DataFrame:
    """Write the files, read them back, and place every document in the order of all."""
    files = write_token_files(docs, scratch_dir(docs.sparkSession, "tokens"), tokenizer, lowers=lowers, end=end)
    # one row per file, so this window stays small
    before = files.select("part", (F.sum("n_tokens").over(Window.orderBy("part")) - F.col("n_tokens")).alias("before"))
    return read_token_files(files).join(before, "part").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def digest_query(spark: SparkSession, documents: DataFrame) -> DataFrame:
    return token_file_digest(documents, tokenizer_path("word_bpe_49k.json"), lowers=True, end=2)
