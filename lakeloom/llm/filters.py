"""Audit of how document filters overlap, for every order in which they can be applied.

A document's failing filters are the bits of its mask. Documents are counted once per part and mask;
the counts become a table of cells: for every part and every set of applied filters (again as bits)
what is still kept. A recursive CTE starts with the empty prefix and, at each level, adds every unused
letter, joins the cell of the widened bits and emits what the new step removes. All later work is on
these prefixes, whose number depends on parts and filters only.

Null text is empty, null ``lang`` the part ``''`` (as is an empty one). Only a row with a smaller
doc_id makes a text a copy: rows with a null doc_id neither are copies nor make any, and repeated rows
with the smallest doc_id are all originals. Several labels of a doc_id count as the best quality and the
worst toxicity that one of them has; rows without labels are neither good nor toxic. Other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeloom.llm.common import staged

BLANKS = r"[\x20\x09-\x0D]+"
MARKS, CAPITALS = "#$%&*|", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = "ABCDE"
#: The filter that compares documents with each other; the others look at one text.
COPY = "E"


def bit_of(letter: str) -> int:
    return 1 << LETTERS.index(letter)


def own_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.array_remove(F.split(text, BLANKS), "")
    facts = F.struct(
        F.size(words).cast("long").alias("words"), F.size(F.array_distinct(words)).cast("long").alias("distinct"), F.length(text).cast("long").alias("chars"),
        (F.length(text) - F.length(F.translate(text, CAPITALS, ""))).cast("long").alias("capitals"), (F.translate(text, MARKS, "") != text).alias("marked"),
    )
    fails = lambda f: {"A": f["words"] < 100, "B": f["distinct"] * 100 < f["words"] * 80, "C": f["capitals"] * 100 > f["chars"] * 10, "D": f["marked"]}
    # through a one-element array, so that the words are split once for all filters
    masks = F.transform(F.array(facts), lambda f: sum((F.when(no, bit_of(letter)).otherwise(0) for letter, no in fails(f).items()), F.lit(0)))
    return masks[0]


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask`` with the numbers ``n, good, toxic`` of documents.

    Rows that agree in id, text and part meet first, ids are looked up next, equal texts meet last:
    no step gathers a hot id, part or text before it was counted in every task.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.sha2(text, 256).alias("print"), own_failures(text).alias("own"))
    counted = rows.groupBy("doc_id", "part", "print", "own").agg(F.count(F.lit(1)).alias("n"))
    flags = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    known = counted.join(flags, "doc_id", "left").na.fill(0, ["good", "toxic"])
    numbers = ["n", "good", "toxic"]
    told = known.select("part", "print", "own", "doc_id", "n", (F.col("n") * F.col("good")).alias("good"), (F.col("n") * F.col("toxic")).alias("toxic"))
    # a text's rows of a part: all numbers, those without an id, and those of the smallest id
    by_text = told.groupBy("print", "part", "own").agg(
        *[F.sum(c).alias(c) for c in numbers],
        *[F.sum(F.when(F.col("doc_id").isNull(), F.col(c)).otherwise(0)).alias(f"{c}_free") for c in numbers],
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", *numbers))).alias("first"),
    )
    everywhere = Window.partitionBy("print")  # a row for each part
    by_text = by_text.withColumn("least", F.min("first.doc_id").over(everywhere))
    original = lambda c: F.col(f"{c}_free") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first")[c]).otherwise(0)
    split = by_text.select("part", F.explode(F.array(
        F.struct(F.col("own").alias("mask"), *[original(c).alias(c) for c in numbers]),
        F.struct(F.col("own").bitwiseOR(bit_of(COPY)).alias("mask"), *[(F.col(c) - original(c)).alias(c) for c in numbers]),
    )).alias("m"))
    return split.where("m.n > 0").groupBy("part", "m.mask").agg(*[F.sum(f"m.{c}").alias(c) for c in numbers])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each step of each order of the filters keeps and removes, by part."""
    spark = docs.sparkSession
    whole = 1 << len(LETTERS)
    counts = staged(masks(docs, labels), "masks")
    kept = lambda c: F.sum(F.when(F.col("mask").bitwiseAND(F.col("applied")) == 0, F.col(c)).otherwise(0)).alias(c)
    cells = counts.withColumn("applied", F.explode(F.sequence(F.lit(0), F.lit(whole - 1)))).groupBy("part", "applied").agg(*map(kept, ("n", "good", "toxic")))
    bits = [(letter, bit_of(letter)) for letter in LETTERS]
    fails = counts.select("part", "mask", "n", F.explode(F.array(*[F.struct(F.lit(x).alias("letter"), F.lit(b).alias("bit")) for x, b in bits])).alias("f")).groupBy("part", "f.letter", "f.bit").agg(
        F.sum(F.when(F.col("mask").bitwiseAND(F.col("f.bit")) > 0, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("mask") == F.col("f.bit"), F.col("n")).otherwise(0)).alias("unique_fails"))
    # the recursion reads its tables at every level
    tables = {"cells": staged(cells, "cells"), "fails": staged(fails, "fails")}
    # a row for each part and prefix: parts alone decide how many, so no limit of rows is needed
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    prefixes = staged(spark.sql(WALK, **tables), "prefixes")
    return spark.sql(ORDERS, {"size": len(LETTERS)}, prefixes=prefixes)


WALK = """
with recursive walk(part, prefix, step, applied, letter, kept, good, toxic, removed, redundant, unique_fails, good_lost, toxic_lost) as (
    select part, '', 0, 0, '', n, good, toxic, 0L, 0L, 0L, 0L, 0L from {cells} where applied = 0
    union all
    select w.part, concat(w.prefix, f.letter), w.step + 1, w.applied | f.bit, f.letter, c.n, c.good, c.toxic,
           w.kept - c.n, f.fails - (w.kept - c.n), f.unique_fails, w.good - c.good, w.toxic - c.toxic
    from walk w
    join {fails} f on f.part = w.part and (w.applied & f.bit) = 0
    join {cells} c on c.part = w.part and c.applied = (w.applied | f.bit)
)
select * from walk where step > 0
"""

#: Whole orders take the step of each of their prefixes.
ORDERS = """
with steps as (
    select o.part, o.prefix as filter_order, p.step, p.letter, p.kept, p.removed, p.redundant, p.unique_fails, p.good_lost, p.toxic_lost
    from {prefixes} o join {prefixes} p on p.part = o.part and p.prefix = left(o.prefix, p.step)
    where o.step = :size
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) over (partition by part, letter) as shapley
from steps
"""

#: The same without a recursion: every order is spelled out and compared with every document's failures.
SQL = r"""
with t as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents
), w as (
    select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words, min(doc_id) over (partition by text) as least from t
), flags as (
    select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
    from labels where doc_id is not null group by doc_id
), f as (
    select w.part, coalesce(g.good, 0) as good, coalesce(g.toxic, 0) as toxic,
        concat(case when len(words) < 100 then 'A' else '' end,
               case when 100 * len(list_distinct(words)) < 80 * len(words) then 'B' else '' end,
               case when 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) then 'C' else '' end,
               case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end,
               case when w.doc_id > least then 'E' else '' end) as failed
    from w left join flags g on g.doc_id = w.doc_id
), counted as (
    select part, failed, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by all
), letter as (
    select unnest(['A', 'B', 'C', 'D', 'E']) as x
), orders as (
    select a.x || b.x || c.x || d.x || e.x as filter_order from letter a, letter b, letter c, letter d, letter e
    where length(regexp_replace('ABCDE', '[' || a.x || b.x || c.x || d.x || e.x || ']', '', 'g')) = 0
), steps as (
    select filter_order, step, substr(filter_order, step, 1) as x, substr(filter_order, 1, step - 1) as before
    from orders, (select unnest([1, 2, 3, 4, 5]) as step)
), told as (
    select c.*, s.*, contains(failed, x) as fails, length(translate(failed, before, '')) < length(failed) as gone from counted c, steps s
), summed as (
    select part, filter_order, step, x,
        sum(case when not gone and not fails then n else 0 end) as kept, sum(case when not gone and fails then n else 0 end) as removed,
        sum(case when gone and fails then n else 0 end) as redundant, sum(case when failed = x then n else 0 end) as unique_fails,
        sum(case when not gone and fails then good else 0 end) as good_lost, sum(case when not gone and fails then toxic else 0 end) as toxic_lost
    from told group by part, filter_order, step, x
)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
    cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
    cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, x) as bigint) as shapley
from summed
"""
