"""Jaccard join of word n-gram sets as a blocked sparse matrix product.

Documents are rows and distinct shingles columns of an incidence matrix; equal rows are one. The product
of the matrix with its transpose holds the overlap of every pair. It is never computed whole:

* A set of n shingles can spare ``m = floor((100 - least) * n / 100)`` of them, and sizes of linked sets
  differ by ``least`` percent at most. Rows with more than m columns of their own cannot link and go
  first, judged on the columns with the smallest hashes (all columns for small sets), then, for what is
  left, on all of them.
* Columns are ordered from rare to frequent. Linked rows share one of their first ``m + 1`` columns, so
  only these say which rows have to meet. Each such column has a pivot, its smallest row.
* First every pivot is multiplied with the rows of its columns. Columns whose rows are then in one
  component are done. Of each other column all rows meet, one group per pivot, cut by size into bands
  and by bytes into blocks: a task multiplies two blocks, adds up overlaps over slices of columns,
  discards pairs below the size-derived bound and passes on a spanning forest of the rest. That keeps
  every component, and bounds what a task holds by two blocks and what it returns by their rows.

``first_of_each`` starts from SimHash: distinct fingerprints of all documents that a walk of their trie finds
within BUDGET bits are judged on their sets, and what that links needs no product. The product then
links the rest, as fingerprints of sets that are as alike as ``least`` often differ in more bits.

Shingles and sets are known by 64-bit hashes. Null text is empty; a document without words links with
nothing, not even with another one. Rows with a null doc_id take part but name no component unless no
other id is there (then null). Repeated rows have equal sets. Other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, LongType

from lakeloom.llm.common import discard, give_back, giving_back, recorded, staged
from lakeloom.llm.simhash import SEED, components, fingerprint, forest, near_links

WORDS, LEAST = 4, 85
#: Shingles and rows of a block.
CAP, ROWS = 1 << 18, 512
#: Rows of a product after which a worker returns memory.
LARGE = 256
#: Sets below this size show all columns at first, larger ones those with small hashes: SHOWN times what can be spared.
SMALL, SHOWN = 64, 5 / 3
_MUL = np.uint64(0x9E3779B97F4A7C15)
#: Columns of a dense slice, and pairs that are spelled out at once.
_WIDE, _PAIRS = 2048, 1 << 21


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Distinct hashes of the runs of ``words`` words, in order; fewer words are one run."""
    import xxhash

    parts = text.encode().lower().split() if text else []
    if not parts:
        return np.zeros(0, np.uint64)
    each = np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in parts), np.uint64, len(parts))
    runs = max(1, len(parts) - words + 1)
    found = np.full(runs, min(words, len(parts)), np.uint64)
    for k in range(min(words, len(parts))):
        found = (found ^ each[k : k + runs]) * _MUL
        found ^= found >> np.uint64(31)
    return np.unique(found)


def set_id(found: np.ndarray) -> int | None:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).view(np.int64)) if len(found) else None


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Common values of each of the sets ``a`` with each of the sets ``b``: a product of sparse matrices."""
    total = np.zeros((len(a), len(b)), np.int64)
    columns, own = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    rows = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in [*a, *b]])
    left = rows < len(a)
    in_a, in_b = (np.bincount(own[side], minlength=len(columns)) for side in (left, ~left))
    meet = in_a * in_b
    heavy = meet * 32 >= total.size
    # frequent columns: dense slices
    number = np.cumsum(heavy) - 1
    many = heavy[own]
    for start in range(0, int(heavy.sum()), _WIDE):
        at = number[own] - start
        here = many & (at >= 0) & (at < _WIDE)
        one, two = (np.zeros((n, _WIDE), np.float32) for n in total.shape)
        one[rows[here & left], at[here & left]] = 1
        two[rows[here & ~left] - len(a), at[here & ~left]] = 1
        total += (one @ two.T).astype(np.int64)
    # rare columns: the pairs of each
    rest = ~many & (meet[own] > 0)
    order = np.argsort(own[rest & ~left], kind="stable")
    theirs, mine = (rows[rest & ~left] - len(a))[order], rows[rest & left]
    first = np.searchsorted(own[rest & ~left][order], own[rest & left])
    wide = in_b[own[rest & left]]
    ends = np.cumsum(wide)
    start = 0
    while start < len(mine):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _PAIRS, "right")))
        n = wide[start:stop]
        nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        cells = np.repeat(mine[start:stop], n) * len(b) + theirs[np.repeat(first[start:stop], n) + nth]
        total += np.bincount(cells, minlength=total.size).reshape(total.shape)
        start = stop
    return total


def near(common: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, least: int) -> np.ndarray:
    both = size_a[:, None] + size_b[None, :] - common
    return common * 100 >= both * least


def _limit(least: int) -> int:
    """Hashes below it are shown of every set."""
    return min(1 << 64, int(SHOWN * (100 - least) / 100 * 2**64))


def _prints(docs: DataFrame, words: int, least: int, simhash: bool) -> DataFrame:
    """Of every row its set's hash and size, its SimHash fingerprint (null if not asked for), and the columns that are shown at first."""
    last = np.uint64(_limit(least) - 1)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_id(F.col("text")).alias("tid"), "text")

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sets = [shingle_set(t, words) for t in texts]
            simple = pa.array(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64), pa.int64()) if simhash else pa.nulls(len(texts), pa.int64())
            shown = [s if len(s) < SMALL else s[: np.searchsorted(s, last, "right")] for s in sets]
            held = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, shown)]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.uint64), *shown]).view(np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tid"), pa.array(map(set_id, sets), pa.int64()), pa.array([len(s) for s in sets], pa.int64()), simple, held],
                names=["doc_id", "tid", "fp", "n", "simhash", "shown"])

    return rows.mapInArrow(giving_back(run), rows.select("doc_id", "tid").schema.add("fp", "long").add("n", "long").add("simhash", "long").add("shown", ArrayType(LongType())))


def _text_id(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _able(prints: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Sets that do not have more shown columns of their own than they can spare."""
    spare = f"n * {100 - least} div 100"
    # the columns of a small set tell only where all possible partners show them, too
    low = -(1 << 63)  # turns unsigned order into signed order
    tells = (F.col("n") * 100 < SMALL * least) | (F.col("col").bitwiseXOR(F.lit(low)) <= F.lit(_limit(least) - 1 + low))
    each = prints.where(f"n * 100 >= (n + 1) * {least}").select("fp", "n", F.explode("shown").alias("col")).select("fp", "col", tells.alias("tells"))
    lone = each.groupBy("col").agg(F.min("fp").alias("fp"), F.max("fp").alias("other"), F.bool_and("tells").alias("tells")).where("tells and fp = other")
    own = lone.groupBy("fp").agg(F.count(F.lit(1)).alias("own"))
    return sets.where(f"n * 100 >= (n + 1) * {least}").join(own, "fp", "left").where(f"coalesce(own, 0) <= {spare}").drop("own")


def _rows(docs: DataFrame, able: DataFrame, words: int) -> DataFrame:
    """The whole sets, from the text of one document each."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_id(F.col("text")).alias("tid"), "text")
    wanted = able.select(F.col("first.doc_id").alias("id"), F.col("first.tid").alias("hash"))
    # texts are dealt by key at every size, not only where the wanted sets are too many to be sent whole
    found = texts.join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tid") == F.col("hash")), "left_semi").select("text")

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t, words) for t in batch.column("text").to_pylist()]
            held = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(map(set_id, sets), pa.int64()), pa.array([len(s) for s in sets], pa.int64()), held], names=["fp", "n", "cols"])

    kind = able.select("fp", "n").schema.add("cols", ArrayType(LongType()))
    return staged(found.mapInArrow(giving_back(run), kind).dropDuplicates(["fp"]), "rows")


def _prefixes(rows: DataFrame, least: int) -> DataFrame:
    """The first columns of each row, rare before frequent; rows with too many columns of their own have none."""
    each = rows.select("fp", "n", F.explode("cols").alias("col"))
    often = each.groupBy("col").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    own = Window.partitionBy("fp")
    ranked = each.join(often, "col").select(
        "fp", "n", "col", F.row_number().over(own.orderBy("often", "col")).alias("rank"), F.count(F.lit(1)).over(own).alias("shared"))
    return ranked.where(f"rank <= n * {100 - least} div 100 + 1 - (n - shared)").select("fp", "n", "col")


def _products(members: DataFrame, key: list[str], rows: DataFrame, least: int) -> DataFrame:
    """Links of each group of ``members``: rows of ``block`` 0 with those of block 1, or of one block with themselves.

    At least one row of a pair has to be ``top``; rows of one ``label`` need no link.
    """

    def run(table):
        def column(name):
            return table.column(name).to_numpy()

        fp, block, top, label, n = (column(c) for c in ("fp", "block", "top", "label", "n"))
        sets = [np.asarray(x.values).view(np.uint64) for x in table.column("cols")]
        blocks = np.unique(block)
        a = np.flatnonzero(block == blocks[0])
        b = a if len(blocks) == 1 else np.flatnonzero(block == blocks[1])
        linked = near(overlaps([sets[k] for k in a], [sets[k] for k in b]), n[a], n[b], least)
        linked &= (top[a][:, None] | top[b][None, :]) & (label[a][:, None] != label[b][None, :])
        i, j = np.nonzero(np.triu(linked, 1) if len(blocks) == 1 else linked)
        ends = np.array(forest(len(fp), [(a[i], b[j])]), np.int64).reshape(-1, 2)
        if len(fp) >= LARGE:
            del linked, i, j, sets
            give_back()
        return pa.table({"u": pa.array(fp[ends[:, 0]], pa.int64()), "v": pa.array(fp[ends[:, 1]], pa.int64())})

    whole = members.join(rows.select("fp", "cols"), "fp")
    return whole.groupBy(*key).applyInArrow(run, "u long, v long").distinct()


def _parts(members: DataFrame, by: list[str], cap: int, most: int) -> DataFrame:
    """Members with the number of blocks ``k`` of their group."""
    sizes = members.groupBy(*by).agg((F.greatest(F.expr(f"sum(n) div {cap}"), F.expr(f"count(*) div {most}")) + 1).cast("int").alias("k"))
    return members.join(sizes, by)


def _near_prints(prints: DataFrame) -> DataFrame:
    """Sets ``fp, n`` and the ``pivot`` to which SimHash links them: one set of their fingerprint, and of each that is near."""
    named = staged(prints.where("n > 0").select("fp", "n", "simhash").distinct(), "fingerprints")
    pivots = staged(named.groupBy("simhash").agg(F.min(F.struct("fp", "n")).alias("pivot")), "pivots")
    links = near_links(pivots.select(F.col("simhash").alias("fp")))
    one, two = (pivots.select(F.col("simhash").alias(end), F.col("pivot").alias(name)) for end, name in (("u", "pivot"), ("v", "other")))
    across = links.join(one, "u").join(two, "v").select("pivot", F.col("other.fp").alias("fp"), F.col("other.n").alias("n"))
    return staged(named.join(pivots, "simhash").select("pivot", "fp", "n").unionByName(across).distinct(), "near")


def _stars(stars: DataFrame, rows: DataFrame, least: int, cap: int, most: int) -> DataFrame:
    """Links of sets ``fp`` with their ``pivot``."""
    alike = f"n * 100 >= pivot.n * {least} and pivot.n * 100 >= n * {least}"
    stars = _parts(stars.where("fp <> pivot.fp").where(alike).select("pivot", "fp", "n").distinct(), ["pivot"], cap, most)
    chunk = F.pmod(F.xxhash64("fp"), F.col("k"))
    rays = stars.select("pivot", "fp", "n", chunk.alias("chunk"), F.lit(1).alias("block"), F.lit(True).alias("top"), F.col("fp").alias("label"))
    centres = rays.select("pivot", "chunk").distinct().select(
        "pivot", F.col("pivot.fp").alias("fp"), F.col("pivot.n").alias("n"), "chunk", F.lit(0).alias("block"), F.lit(True).alias("top"), F.col("pivot.fp").alias("label"))
    return staged(_products(rays.unionByName(centres), ["pivot", "chunk"], rows, least), "links")


def set_links(docs: DataFrame, able: DataFrame, words: int, least: int, cap: int, most: int, near: DataFrame | None = None) -> DataFrame:
    """Links ``u, v`` that connect all sets whose Jaccard similarity is ``least`` percent or more, among those that can have any.

    Pairs in ``near`` are judged first; what they connect is not compared again.
    """
    rows = _rows(docs, able, words)
    known = None if near is None else _stars(near, rows, least, cap, most)
    prefix = staged(_prefixes(rows, least), "prefixes")
    pivots = prefix.groupBy("col").agg(F.min(F.struct("fp", "n")).alias("pivot"), F.count(F.lit(1)).alias("times")).where("times > 1")
    members = staged(prefix.join(pivots.drop("times"), "col"), "members")

    stars = members.select("pivot", "fp", "n")
    if known is not None:
        own = components(known)
        one, two = (own.select(F.col("node").alias(f"{side}_node"), F.col("root").alias(f"{side}_root")) for side in ("ray", "centre"))
        joined = stars.join(one, F.col("fp") == F.col("ray_node"), "left").join(two, F.col("pivot.fp") == F.col("centre_node"), "left")
        stars = joined.where("coalesce(ray_root, fp) <> coalesce(centre_root, pivot.fp)").select("pivot", "fp", "n")
    links = _stars(stars, rows, least, cap, most)
    if known is not None:
        links = known.unionByName(links)

    roots = components(links)
    placed = members.join(roots, members["fp"] == roots["node"], "left").select("col", "pivot", "fp", "n", F.coalesce("root", "fp").alias("label"))
    mixed = placed.groupBy("col").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("col")
    left = placed.join(mixed, "col", "left_semi").select("pivot", "fp", "n", "label").distinct()
    # linked sizes are at most one band apart: a group has a band on top and the one below
    band = F.floor(F.log("n") / float(-np.log(least / 100 - 0.005)))
    banded = left.withColumn("z", F.explode(F.array(F.struct(band.alias("z"), F.lit(True).alias("top")), F.struct((band + 1).alias("z"), F.lit(False).alias("top")))))
    banded = staged(banded.select("pivot", "fp", "n", "label", "z.z", "z.top"), "mixed")
    worth = banded.groupBy("pivot", "z").agg(F.max("top").alias("tops"), F.min("label").alias("low"), F.max("label").alias("high")).where("tops and low <> high")
    group = _parts(banded.join(worth.select("pivot", "z"), ["pivot", "z"], "left_semi"), ["pivot", "z"], cap, most)
    group = group.withColumn("block", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")).withColumn("meets", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    pairs = group.withColumn("low", F.least("block", "meets")).withColumn("high", F.greatest("block", "meets"))
    more = _products(pairs.select("pivot", "z", "low", "high", "fp", "n", "label", "block", "top"), ["pivot", "z", "low", "high"], rows, least)
    return links.unionByName(staged(more, "links"))


def near_sets(docs: DataFrame, words: int, least: int, *, cap: int = CAP, most: int = ROWS, simhash: bool = False) -> tuple[DataFrame, DataFrame]:
    """``doc_id, tid, fp, n, simhash`` of every row (its text's and its set's hash, null without words, size, and fingerprint if asked for), and ``fp, root, component_id`` (one set's hash and the smallest doc_id for all that links reach)."""
    with recorded() as made:
        shown = staged(_prints(docs, words, least, simhash), "shown")
    prints = staged(shown.drop("shown"), "prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tid")).alias("first")
    sets = staged(prints.where("n > 0").groupBy("fp").agg(first, F.max("n").alias("n")), "sets")
    able = staged(_able(shown, sets, least), "able")
    discard(docs.sparkSession, made)  # the columns shown at first are the largest of these tables
    roots = components(set_links(docs, able, words, least, cap, most, _near_prints(prints) if simhash else None))
    named = sets.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.col("first.doc_id").alias("doc_id"), F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return prints, named.join(smallest, "root").select("fp", "root", "component_id")


def classes(docs: DataFrame, words: int = WORDS, least: int = LEAST, *, cap: int = CAP, most: int = ROWS) -> DataFrame:
    """Every document with the size of its set and the smallest doc_id that links of ``least`` percent reach."""
    prints, found = near_sets(docs, words, least, cap=cap, most=most)
    whole = prints.join(found.select("fp", "component_id"), "fp", "left")
    return whole.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def first_of_each(docs: DataFrame, words: int, least: int) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id; all of its columns.

    Documents without words are a group. A null doc_id stays only where the group has no other; rows that
    agree in doc_id and text are one document and stay together.
    """
    prints, groups = near_sets(docs, words, least, simhash=True)
    kept = prints.join(groups.select("fp", "root"), "fp", "left").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tid")).alias("first"))
    kept = staged(kept.select(F.col("first.doc_id").alias("__id"), F.col("first.tid").alias("__tid")), "kept")
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["__id"]) & (_text_id(docs["text"]) == kept["__tid"]), "left_semi")


#: The same by counting the common shingles of all pairs of distinct sets.
SQL = r"""
with recursive d as (
    select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
), s as (
    select r, doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
        else list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) end as shingles
    from d
), sets as (
    select shingles, row_number() over () as k, min(doc_id) as doc_id, len(shingles) as n from s where len(shingles) > 0 group by shingles
), each as (
    select k, n, unnest(shingles) as shingle from sets
), link as (
    select a.k as u, b.k as v from each a join each b on a.shingle = b.shingle and a.k <> b.k
    group by a.k, b.k, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach as (
    select k as u, k as v from sets union select reach.u, link.v from reach join link on link.u = reach.v
), least as (
    select reach.u as k, min(sets.doc_id) as component_id from reach join sets on sets.k = reach.v group by reach.u
)
select s.doc_id, cast(len(s.shingles) as bigint) as n_shingles, case when len(s.shingles) = 0 then s.doc_id else least.component_id end as component_id
from s left join sets on sets.shingles = s.shingles left join least on least.k = sets.k
"""
