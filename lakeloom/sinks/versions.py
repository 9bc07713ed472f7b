"""Tables whose current files are named by a pointer.

A table is a folder with data below ``_data/_version=<write>/<partition>`` and pointers ``_versions/<n>.json``.
Every write puts its files into a folder of its own and then adds one pointer, which names the folders
of each partition, the partition columns and the schema. Data is never moved, and nothing that a pointer
names is changed: a write that dies leaves the table as it was, readers keep what they started with, and
of two writes that began with the same pointer the second fails. Column types, those of partition columns
included, come from the pointer, so a text ``01`` stays a text. Work on pointers is in proportion to the
number of partitions, not of rows.

A plain folder of files becomes such a table with its first write; until then it is read as it is, its
partition columns with the types that the writer's rows have. Read tables by ``read_table_path``: other
readers see the plain files only.
"""

from __future__ import annotations

import dataclasses
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeloom.session import scratch_dir

DATA, POINTERS, MARK = "_data", "_versions", "_version"
MAX_RECORDS_PER_FILE = 5_000_000


class LostRace(RuntimeError):
    """Another write was committed since this one began; begin again."""


@dataclass(frozen=True)
class Version:
    """What a pointer says. ``parts`` has the folders of each partition; a plain folder is the folder ''."""

    number: int
    schema: T.StructType
    keys: tuple[str, ...]
    fmt: str
    parts: dict[str, list[str]] = field(default_factory=dict)
    #: Number of the next pointer, as seen when this one was read.
    following: int = 1

    def text(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "keys": list(self.keys), "format": self.fmt, "parts": self.parts})


def current(spark: SparkSession, target: str) -> Version | None:
    """The greatest whole pointer; None where there is none. A pointer that was cut off does not count."""
    files, folder = _files(spark, f"{target}/{POINTERS}")
    if not files.exists(folder):
        return None
    numbers = _numbers(files, folder)
    for number in reversed(numbers):
        try:
            found = json.loads(_read_text(spark, f"{target}/{POINTERS}/{number:012d}.json"))
        except ValueError:
            continue
        return Version(number, T.StructType.fromJson(found["schema"]), tuple(found["keys"]), found["format"], found["parts"], numbers[-1] + 1)
    return None


def commit(spark: SparkSession, target: str, base: Version | None, new: Version) -> None:
    """Add the pointer that follows the one a write began with."""
    number = base.following if base else 1
    files, path = _files(spark, f"{target}/{POINTERS}/{number:012d}.json")
    try:
        out = files.create(path, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception):
            raise LostRace(f"{target} has a version {number} already") from error
        raise
    try:
        out.write(bytearray(new.text(), "utf-8"))
    finally:
        out.close()


def read_table_path(spark: SparkSession, target: str, *, fmt: str = "parquet") -> DataFrame:
    """The current rows of a table; a plain folder without pointers is read by Spark alone."""
    version = current(spark, target.rstrip("/"))
    return spark.read.format(fmt).load(target) if version is None else read_version(spark, target, version)


def read_version(spark: SparkSession, target: str, version: Version, *, parts: Iterable[str] | None = None, place: str | None = None) -> DataFrame:
    """Rows of a version, of some partitions only if these are named; ``place`` adds the folder of each row's file."""
    target, wanted = target.rstrip("/"), list(version.parts if parts is None else parts)
    plain = [_join(target, p) for p in wanted if "" in version.parts[p]]
    own = [_join(target, folder, p) for p in wanted for folder in version.parts[p] if folder]
    columns = [F.col(f"`{c}`") for c in version.schema.names]
    if place:
        columns.append(F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias(place))
    whole = T.StructType([*version.schema.fields, T.StructField(MARK, T.StringType())])
    read = []
    if plain:
        read.append(spark.read.format(version.fmt).schema(version.schema).option("basePath", target).load(plain).select(*columns))
    if own:
        read.append(spark.read.format(version.fmt).schema(whole).option("basePath", f"{target}/{DATA}").load(own).select(*columns))
    if not read:
        return spark.createDataFrame([], T.StructType([*version.schema.fields, *([T.StructField(place, T.StringType())] if place else [])]))
    return read[0] if len(read) == 1 else read[0].unionByName(read[1])


def replace(rows: DataFrame, target: str, *, keys: list[str] | None = None, fmt: str = "parquet") -> Version:
    """Make ``rows``, which may read the table itself, its whole content; keeps its partition columns unless others are given."""
    spark, target = rows.sparkSession, target.rstrip("/")
    base = begin(spark, target, rows.schema, fmt)
    keys = tuple(base.keys if keys is None and base else keys or ())
    folder, written = _write(rows, target, keys, fmt)
    return _commit(spark, target, base, Version(0, _nullable(rows.schema), keys, fmt, {p: [folder] for p in written}))


def replace_partitions(rows: DataFrame, target: str, keys: list[str], *, fmt: str = "parquet") -> Version:
    """Make ``rows`` the content of the partitions that they are in; the other partitions stay."""
    spark, target = rows.sparkSession, target.rstrip("/")
    base = begin(spark, target, rows.schema, fmt)
    if base and tuple(keys) != base.keys:
        raise ValueError(f"{target} is partitioned by {base.keys}")
    schema = base.schema if base else _nullable(rows.schema)
    folder, written = _write(rows.select(*[F.col(f"`{c}`") for c in schema.names]), target, tuple(keys), fmt)
    return _commit(spark, target, base, Version(0, schema, tuple(keys), fmt, (base.parts if base else {}) | {p: [folder] for p in written}))


def upsert(target: str, stage: DataFrame, keys: list[str], *, fmt: str = "parquet") -> Version:
    """Delete the rows that match the stage on all keys, insert all stage rows.

    Only partitions that hold a matching row are written again, without it; stage rows of other
    partitions are added to these as files of their own. Which partitions those are, is found by
    reading the table's keys, in the stage's partitions only where its partition columns are among the
    keys. Null keys match nothing; duplicates within the stage are kept. The stage is computed once.
    """
    spark, target = stage.sparkSession, target.rstrip("/")
    base = begin(spark, target, stage.schema, fmt)
    if base is None:
        return replace(stage, target, fmt=fmt)
    columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in base.schema]
    held = scratch_dir(spark, "upsert")
    stage.select(*columns).write.parquet(held)
    try:
        stage = spark.read.schema(base.schema).parquet(held)
        replaced = stage.select(*keys).distinct()
        touched = list(base.parts)
        if base.keys:
            there = read_version(spark, target, base, place="_place").select(*keys, "_place")
            hit = there.join(replaced, keys, "left_semi").select("_place").distinct()
            touched = sorted({_partition(r[0], len(base.keys)) for r in hit.toLocalIterator()})
        left = read_version(spark, target, base, parts=touched).join(replaced, keys, "left_anti").select(*base.schema.names)
        folder, written = _write(left.unionByName(stage), target, base.keys, fmt)
    finally:
        files, path = _files(spark, held)
        files.delete(path, True)
    parts = {p: folders for p, folders in base.parts.items() if p not in set(touched)}
    for p in written:
        parts[p] = [*parts.get(p, []), folder]
    return _commit(spark, target, base, Version(0, base.schema, base.keys, fmt, parts))


def drop_parts(spark: SparkSession, target: str, stale: DataFrame) -> int:
    """Take the partitions in ``stale`` (a row of partition columns each) out of the table; returns how many went."""
    target = target.rstrip("/")
    base = current(spark, target)
    if base is None or not base.keys:
        raise ValueError(f"{target} has no versions with partitions")
    kinds = T.StructType([T.StructField("_part", T.StringType()), *(T.StructField(k, T.StringType()) for k in base.keys)])
    known = spark.createDataFrame([(p, *_values(p)) for p in base.parts], kinds)
    typed = known.select("_part", *[F.col(k).cast(base.schema[k].dataType).alias(k) for k in base.keys]).alias("a")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in base.keys]
    gone = {r[0] for r in typed.join(stale.select(*base.keys).distinct().alias("b"), same, "left_semi").select("_part").collect()}
    if gone:
        _commit(spark, target, base, Version(0, base.schema, base.keys, base.fmt, {p: f for p, f in base.parts.items() if p not in gone}))
    return len(gone)


def compact(spark: SparkSession, target: str, *, folders: int = 8) -> int:
    """Write partitions of more than ``folders`` folders anew, as one folder; returns how many there were."""
    target = target.rstrip("/")
    base = current(spark, target)
    many = [p for p, own in base.parts.items() if len(own) > folders] if base else []
    if many:
        folder, written = _write(read_version(spark, target, base, parts=many), target, base.keys, base.fmt)
        kept = {p: own for p, own in base.parts.items() if p not in set(many)}
        _commit(spark, target, base, Version(0, base.schema, base.keys, base.fmt, kept | {p: [folder] for p in written}))
    return len(many)


def vacuum(spark: SparkSession, target: str, *, keep: int = 2, older_than_s: float = 7 * 86400) -> list[str]:
    """Delete data that none of the last ``keep`` pointers names, and older pointers; returns the folders.

    Only folders that were last written ``older_than_s`` seconds ago go: younger ones may belong to a
    write that is not committed yet.
    """
    target = target.rstrip("/")
    files, data = _files(spark, f"{target}/{DATA}")
    _, pointers = _files(spark, f"{target}/{POINTERS}")
    if current(spark, target) is None:
        return []
    named, whole, old = set(), 0, []
    for number in reversed(_numbers(files, pointers)):
        _, path = _files(spark, f"{target}/{POINTERS}/{number:012d}.json")
        if whole >= keep:
            old.append(path)
            continue
        try:
            parts = json.loads(_read_text(spark, path.toString()))["parts"]
        except ValueError:
            continue  # cut off: it names nothing, but its number stays taken
        whole += 1
        named |= {folder for own in parts.values() for folder in own}
    limit = spark._jvm.java.lang.System.currentTimeMillis() - int(older_than_s * 1000)
    gone = []
    for path in old:
        files.delete(path, False)
    for status in files.listStatus(data) if files.exists(data) else []:
        folder = f"{DATA}/{status.getPath().getName()}"
        if folder not in named and status.getModificationTime() <= limit:
            files.delete(status.getPath(), True)
            gone.append(folder)
    if "" not in named:  # the plain files from before the first pointer
        _, root = _files(spark, target)
        for status in files.listStatus(root):
            name = status.getPath().getName()
            if name not in (DATA, POINTERS) and status.getModificationTime() <= limit:
                files.delete(status.getPath(), True)
    return gone


def begin(spark: SparkSession, target: str, like: T.StructType, fmt: str) -> Version | None:
    """The version that a write starts from: the current one, or a plain folder with the types of ``like``."""
    found = current(spark, target)
    if found is not None:
        return found
    files, path = _files(spark, target)
    inner = [s for s in files.listStatus(path)] if files.exists(path) else []
    if not any(not s.getPath().getName().startswith((".", "_")) or "=" in s.getPath().getName() for s in inner):
        # nothing but perhaps a pointer that was cut off
        taken = f"{target}/{POINTERS}"
        files, pointers = _files(spark, taken)
        numbers = _numbers(files, pointers) if files.exists(pointers) else []
        return Version(0, like, (), fmt, {}, numbers[-1] + 1) if numbers else None
    plain = spark.read.format(fmt).load(target)
    kinds = {f.name: f.dataType for f in like}
    leaves = {_inside(target, f) for f in plain.inputFiles()}
    keys = tuple(step.split("=", 1)[0] for step in next(iter(leaves)).split("/")) if leaves and "" not in leaves else ()
    fields = [T.StructField(f.name, kinds.get(f.name, f.dataType) if f.name in keys else f.dataType) for f in plain.schema]
    return Version(0, T.StructType(fields), keys, fmt, {p: [""] for p in leaves})


def _commit(spark: SparkSession, target: str, base: Version | None, new: Version) -> Version:
    commit(spark, target, base, new)
    number = base.following if base else 1
    return dataclasses.replace(new, number=number, following=number + 1)


def _write(rows: DataFrame, target: str, keys: tuple[str, ...], fmt: str) -> tuple[str, set[str]]:
    """Write rows to a folder of their own; returns it and the partitions in it."""
    spark, folder = rows.sparkSession, f"{DATA}/{MARK}={uuid.uuid4().hex}"
    writer = (rows.hint("rebalance", *keys) if keys else rows).write.format(fmt).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    (writer.partitionBy(*keys) if keys else writer).save(f"{target}/{folder}")
    if not keys:
        return folder, {""}
    files, path = _files(spark, f"{target}/{folder}")
    if not any("=" in s.getPath().getName() for s in files.listStatus(path)):
        return folder, set()
    read = spark.read.format(fmt).schema(rows.schema).load(f"{target}/{folder}")
    return folder, {_partition(f.rsplit("/", 1)[0], len(keys)) for f in read.inputFiles()}


def _partition(place: str, depth: int) -> str:
    """The partition's steps at the end of a file's folder, which Spark gives URL-encoded."""
    return "/".join(unquote(place).split("/")[-depth:])


def _inside(target: str, file: str) -> str:
    steps = unquote(file).split("/")[:-1]
    at = next((k for k, step in enumerate(steps) if "=" in step and all("=" in s for s in steps[k:])), len(steps))
    return "/".join(steps[at:])


def _numbers(files, folder) -> list[int]:
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())


def _values(part: str) -> list[str | None]:
    values = [unquote(step.split("=", 1)[1]) for step in part.split("/")]
    return [None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in values]


def _join(*steps: str) -> str:
    return "/".join(s for s in steps if s)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _read_text(spark: SparkSession, path: str) -> str:
    files, found = _files(spark, path)
    stream = files.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
