"""Prefix trie of conversations, rolled up in bands of depth.

Every conversation is rebuilt with the opening turns of the first one of its hundred. A node is known by
its depth and two 64-bit keys: the exclusive or of its turns' hashes, each mixed with its place, so that
prefixes need no order and long conversations are cut into blocks. Its representative is its smallest
member; a conversation's keys within one band of ``height`` depths are one path.

Totals of subtrees come in bands: each node adds its values to its ancestors on the path of its own band
only, at most ``height`` of them. The roots of the bands with these totals are a trie of their own, whose
depth is smaller by the factor ``height``, and are rolled up in the same way; a completed band root then
adds its total to the path of the band above it. So rounds grow with the logarithm of the depth, and a
node is exploded into no more than twice ``height`` rows.

Turns of equal number follow role and text; null role and text are empty. Rows with a null conv_id belong
to no conversation. ``conv_id % 100`` keeps the sign of conv_id. Other columns are ignored; an empty
table gives no rows, not even a root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lakeloom.llm.common import staged
from lakeloom.operators.latest import number_rows

#: Conversations that share their opening turns, and what the number of these is taken from.
GROUP, OPENING = 100, 6
#: Depths in a band, and turns in a block of a running key.
HEIGHT, SPAN = 16, 256
KEY = ["depth", "ka", "kb"]


def rebuilt(conversations: DataFrame, group: int = GROUP, opening: int = OPENING) -> tuple[DataFrame, DataFrame]:
    """Turns ``conv_id, depth, a, b, chars`` of the rebuilt conversations, and ``conv_id, length`` of them all."""
    known = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    numbered = number_rows(known, ["conv_id"], ["turn", "role", "text"], into="pos")
    turns = staged(numbered.select("conv_id", F.col("pos").cast("long").alias("pos"), F.xxhash64("role", "text").alias("one"), F.xxhash64(F.lit("b"), "text", "role").alias("two"), F.length("text").cast("long").alias("chars")), "turns")
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    bases = counts.where(f"conv_id % {group} = 0").select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % opening
    convs = counts.select("conv_id", "n", taken.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base")).join(bases, "base", "left")
    convs = staged(convs.select("conv_id", "n", "h", "base", F.expr("least(h, coalesce(there, 0))").alias("given")), "conversations")
    # a base has fewer than ``opening`` opening turns and ``group`` conversations
    heads = turns.where(f"conv_id % {group} = 0 and pos < {opening}").withColumnRenamed("conv_id", "base")
    borrowed = convs.join(heads, "base").where("pos <= h").select("conv_id", F.col("pos").alias("depth"), "one", "two", "chars")
    own = turns.join(convs.select("conv_id", "h", "given"), "conv_id").where("pos > h").select("conv_id", F.expr("pos - h + given").alias("depth"), "one", "two", "chars")
    all_turns = borrowed.unionByName(own).select("conv_id", "depth", F.xxhash64("depth", "one").alias("a"), F.xxhash64("depth", "two").alias("b"), "chars")
    return staged(all_turns, "rebuilt"), convs.select("conv_id", F.expr("given + greatest(n - h, 0)").alias("length"))


def running(steps: DataFrame, span: int = SPAN) -> DataFrame:
    """``steps`` with ``ka, kb``: the exclusive or of ``a`` and of ``b`` up to each ``depth`` (from 1) of a conversation.

    Windows hold a block of ``span`` steps; the totals of blocks are steps of the next, shorter round.
    """
    most = steps.agg(F.max("depth")).first()[0] or 0
    block = F.expr(f"(depth - 1) div {span}")
    inside = Window.partitionBy("conv_id", "block").orderBy("depth")
    found = steps.withColumn("block", block).withColumn("ka", F.bit_xor("a").over(inside)).withColumn("kb", F.bit_xor("b").over(inside))
    if most <= span:
        return found.drop("block")
    totals = staged(steps.groupBy("conv_id", block.alias("block")).agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")).select("conv_id", (F.col("block") + 1).alias("depth"), "a", "b"), "totals")
    before = running(totals, span).select("conv_id", F.col("depth").alias("block"), F.col("ka").alias("la"), F.col("kb").alias("lb"))
    keys = [F.col(f"k{c}").bitwiseXOR(F.coalesce(f"l{c}", F.lit(0))).alias(f"k{c}") for c in "ab"]
    return found.join(before, ["conv_id", "block"], "left").select(*steps.columns, *keys)


def rollup(paths: DataFrame, nodes: DataFrame, values: list[str], height: int = HEIGHT) -> DataFrame:
    """Sums of ``values`` over each node's subtree.

    ``paths`` has ``conv_id`` and key of every prefix, ``nodes`` a row for each key with one of its ``conv_id``.
    """
    band = F.expr(f"depth div {height}").alias("band")
    segments = staged(paths.groupBy("conv_id", band).agg(F.sort_array(F.collect_list(F.struct(*KEY))).alias("path")), "segments")

    def summed(rows, up):
        return rows.select(F.explode(up).alias("up"), *values).groupBy(*[F.col(f"up.{k}").alias(k) for k in KEY]).agg(*[F.sum(v).alias(v) for v in values])

    in_band = nodes.withColumn("band", band).join(segments, ["conv_id", "band"])
    inside = staged(summed(in_band, F.expr(f"slice(path, 1, cast(depth % {height} + 1 as int))")), "inside")
    if (paths.agg(F.max("depth")).first()[0] or 0) < height:
        return inside
    roots = nodes.where(f"depth % {height} = 0").select("conv_id", *KEY)
    shorter = [F.expr(f"depth div {height}").alias("depth"), "ka", "kb"]
    completed = rollup(
        paths.where(f"depth % {height} = 0").select("conv_id", *shorter), roots.join(inside, KEY).select("conv_id", *shorter, *values), values, height
    ).withColumn("depth", F.col("depth") * height)
    above = roots.where("depth > 0").join(completed, KEY).withColumn("band", band - 1).join(segments, ["conv_id", "band"])
    both = inside.unionByName(summed(above, F.col("path")))
    return staged(both.groupBy(*KEY).agg(*[F.sum(v).alias(v) for v in values]), "subtrees")


def id_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined ``conv_id`` of each key.

    Ids travel in long pieces of text, cut where range slices end; a task keeps the state of one digest.
    """
    ordered = staged(ends.select(*KEY, "conv_id"), "ends").repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    kind = ends.select(*KEY).schema

    def pieces(batches):
        for batch in batches:
            keys, ids = list(zip(*(batch.column(k).to_pylist() for k in KEY))), batch.column("conv_id").to_pylist()
            starts = [k for k in range(len(ids)) if not k or keys[k] != keys[k - 1]]
            rows = [(*keys[a], ids[a], ",".join(map(str, ids[a:z]))) for a, z in zip(starts, [*starts[1:], len(ids)])]
            yield pa.RecordBatch.from_pydict({c: [r[k] for r in rows] for k, c in enumerate([*KEY, "first", "piece"])}, schema=pa.schema([*((k, pa.int64()) for k in KEY), ("first", pa.int64()), ("piece", pa.string())]))

    def digests(batches):
        done, key, state = [], None, None
        shape = pa.schema([*((k, pa.int64()) for k in KEY), ("ends_sha256", pa.string())])
        table = lambda rows: pa.RecordBatch.from_pydict({c: [r[k] for r in rows] for k, c in enumerate(shape.names)}, schema=shape)
        for batch in batches:
            for *own, piece in zip(*(batch.column(c).to_pylist() for c in [*KEY, "piece"])):
                if own != key:
                    done += [(*key, state.hexdigest())] if key else []
                    key, state = own, hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
            yield table(done)
            done = []
        yield table([(*key, state.hexdigest())] if key else [])

    cut = ordered.mapInArrow(pieces, kind.add("first", "long").add("piece", "string"))
    return cut.repartition(*KEY).sortWithinPartitions(*KEY, "first").select(*KEY, "piece").mapInArrow(digests, ends.select(*KEY).schema.add("ends_sha256", "string"))


def nodes_of(conversations: DataFrame, height: int = HEIGHT, span: int = SPAN) -> DataFrame:
    """Every node of the trie with its members, children, leaves, saved tokens and ends."""
    turns, lengths = rebuilt(conversations)
    steps = running(turns, span)
    zero = F.lit(0).cast("long")
    tops = lengths.select("conv_id", *[zero.alias(c) for c in ("depth", "a", "b", "chars", "ka", "kb")])
    paths = staged(tops.unionByName(steps.select(*tops.columns)), "paths")
    parent = [F.max(F.col(f"k{c}").bitwiseXOR(F.col(c))).alias(f"p{c}") for c in "ab"]
    nodes = staged(paths.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"), *parent), "nodes")
    below = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb")).agg(F.count(F.lit(1)).alias("n_children"))
    told = staged(nodes.join(below, KEY, "left").na.fill(0, ["n_children"]), "children")
    own = told.select("conv_id", *KEY, F.expr("cast(n_children = 0 as bigint)").alias("n_leaves"), F.expr("(n_convs - 1) * chars").alias("saved_tokens"))
    totals = rollup(paths.select("conv_id", *KEY), own, ["n_leaves", "saved_tokens"], height)
    ends = id_digests(paths.join(lengths.select("conv_id", F.col("length").alias("depth")), ["conv_id", "depth"]))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    whole = told.join(totals, KEY).join(ends, KEY, "left").join(parents, ["depth", "pa", "pb"], "left")
    return whole.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


#: The same with whole prefixes as keys, every node joined with all its ancestors.
SQL = r"""
with recursive given as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
), t as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos from given
), crc as (
    select distinct conv_id, cast(conv_id as varchar) as s, 0 as b, cast(4294967295 as bigint) as v from given
    union all
    select conv_id, s, b + 1, xor(x >> 1, case when x % 2 = 1 then cast(3988292384 as bigint) else cast(0 as bigint) end)
    from (select *, case when b % 8 = 0 then xor(v, cast(ascii(substr(s, b // 8 + 1, 1)) as bigint)) else v end as x from crc where b < 8 * length(s))
), convs as (
    select conv_id, conv_id - conv_id % 100 as base, xor(v, cast(4294967295 as bigint)) % 6 as h from crc where b = 8 * length(s)
), turns as (
    select c.conv_id, 0 as own, p.pos, p.role, p.text from convs c join t p on p.conv_id = c.base and p.pos <= c.h
    union all
    select c.conv_id, 1, p.pos, p.role, p.text from convs c join t p on p.conv_id = c.conv_id and p.pos > c.h
), paths as (
    select conv_id, row_number() over w as depth, string_agg(md5(length(role) || ':' || role || text), '') over w as k, length(text) as chars
    from turns window w as (partition by conv_id order by own, pos rows between unbounded preceding and current row)
    union all
    select conv_id, 0, '', 0 from convs
), nodes as (
    select depth, k, min(conv_id) as conv_id, count(*) as n_convs, max(chars) as chars, substr(k, 1, 32 * (depth - 1)) as up from paths group by depth, k
), children as (
    select up, depth - 1 as depth, count(*) as n from nodes where depth > 0 group by up, depth
), told as (
    select n.*, coalesce(c.n, 0) as n_children from nodes n left join children c on c.up = n.k and c.depth = n.depth
), totals as (
    select p.depth, p.k, sum(case when t.n_children = 0 then 1 else 0 end) as n_leaves, sum((t.n_convs - 1) * t.chars) as saved_tokens
    from told t join paths p on p.conv_id = t.conv_id and p.depth <= t.depth group by p.depth, p.k
), ends as (
    select depth, k, string_agg(cast(conv_id as varchar), ',' order by conv_id) as ids
    from paths p where depth = (select max(depth) from paths q where q.conv_id = p.conv_id) group by depth, k
)
select t.conv_id, t.depth, p.conv_id as parent_conv_id, t.n_convs, t.n_children, cast(s.n_leaves as bigint) as n_leaves,
    cast(s.saved_tokens as bigint) as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from told t join totals s on s.depth = t.depth and s.k = t.k
left join ends e on e.depth = t.depth and e.k = t.k
left join nodes p on p.depth = t.depth - 1 and p.k = t.up
"""
