"""The filter audit against brute force, with nulls, copies, repeated rows and labels."""

import random
import re
from itertools import permutations

import pytest

from lakeloom.llm import filters

DOCS = "doc_id long, text string, lang string, part string, mask int, good int"
LABELS = "doc_id long, quality int, toxic int, text string"


def brute(docs, labels):
    text_of = lambda r: r[1] or ""
    rows = []
    for r in docs:
        text = text_of(r)
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": r[0] is not None and any(o[0] is not None and o[0] < r[0] and text_of(o) == text for o in docs),
        }
        own = [x for x in labels if x[0] == r[0] and r[0] is not None]
        rows.append((r[2] or "", {k for k, v in fails.items() if v}, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    found = {}
    for part in {r[0] for r in rows}:
        mine, total = [r for r in rows if r[0] == part], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                total[x] += len(gone)
                found[part, "".join(order), step] = [len(left), len(gone), sum(x in r[1] for r in mine) - len(gone), sum(r[1] == {x} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), v in found.items():
            if p == part:
                v.append(total[order[step - 1]])
    return found


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(11)
    words = ["river", "Stone", "ALPHA", "a", "50%", "x|y", "été"] + [f"w{k}" for k in range(300)]
    texts = [" ".join(rng.choice(words[: rng.choice([7, 40, 307])]) for _ in range(rng.choice([3, 99, 100, 130]))) for _ in range(40)]
    texts += [None, "", " \t\n", "ABC", "A" + "b" * 9, "A" + "b" * 10, "x" * 50_000, " ".join(map(str, range(20_000)))] + texts[:9] * 2
    docs = [(k, t, rng.choice(["en", "de", None, ""]), "clash", 7, 7) for k, t in enumerate(texts)]
    docs += [docs[3], docs[3], (None, texts[0], "en", None, None, None), (None, texts[1], None, None, None, None), (-5, texts[2], "de", None, None, None), (45, texts[5], "de", None, None, None)]
    labels = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1, None]), "x") for r in docs if rng.random() < 0.7] + [(3, 1, 0, "x"), (3, 0, 1, "x"), (None, 1, 1, "x"), (9999, 1, 1, "x")]
    return docs, labels


def test_audit_equals_brute_force(spark, tables):
    docs, labels = tables
    got = filters.audit(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(labels, LABELS))
    numbers = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert dict(got.dtypes) == {"part": "string", "filter_order": "string", "step": "int", **dict.fromkeys(numbers, "bigint")}
    rows = got.collect()
    assert len(rows) == len({r.part for r in rows}) * 600
    assert {(r.part, r.filter_order, r.step): [r[c] for c in numbers] for r in rows} == brute(docs, labels)


def test_empty_tables(spark, tables):
    docs, labels = (spark.createDataFrame(t, s) for t, s in zip(tables, (DOCS, LABELS)))
    assert filters.audit(docs.limit(0), labels).count() == 0
    assert {(r.good_lost, r.toxic_lost) for r in filters.audit(docs, labels.limit(0)).collect()} == {(0, 0)}


def test_plan_has_no_product(spark, tables):
    plan = filters.masks(*(spark.createDataFrame(t, s) for t, s in zip(tables, (DOCS, LABELS))))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
