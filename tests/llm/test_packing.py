"""Best-fit packing against its definition and a sequential best fit."""

import bisect
import random

import pytest
from pyspark.sql import functions as F
from regatlas.llm import packing as pk


def sequential(sizes, capacity):
    gaps, n = [], 0
    for s in sorted(sizes, reverse=True):
        i = bisect.bisect_left(gaps, s)
        gap = gaps.pop(i) if i < len(gaps) else capacity
        n += gap == capacity and i >= len(gaps)
        bisect.insort(gaps, gap - s)
    return len(gaps)


def test_sweep_takes_the_successor():
    rng = random.Random(5)
    for n in (0, 1, 30, 200):
        gaps, items = [rng.randrange(1, 40) for _ in range(n)], sorted((rng.choice([7, 7, 7, rng.randrange(1, 45)]) for _ in range(n)), reverse=True)
        at, left = pk.best_fit(items, gaps, 45)
        free = list(gaps)
        for size, k in zip(items, at):
            fits = [g for g in free if g >= size]
            taken = free[k] if k < len(free) else 45
            assert taken == min(fits) if fits else k == len(free)
            if k == len(free):
                free.append(45)
            free[k] -= size
        assert free == left and min(left, default=0) >= 0


@pytest.mark.parametrize(("capacity", "top"), [(100, 100), (1000, 90), (64, 60)])
@pytest.mark.parametrize("stripe", [50_000, 100])
def test_pack(spark, monkeypatch, capacity, top, stripe):
    monkeypatch.setattr(pk, "STRIPE", stripe)
    rng = random.Random(capacity)
    sizes = [rng.randrange(1, top + 1) for _ in range(600)] + [7] * 300
    rows = [(1, capacity, (1 << 62) + i, s) for i, s in enumerate(sizes)] + [(2, 50, i, min(s, 50)) for i, s in enumerate(sizes[:100])]
    out = pk.pack(spark.createDataFrame(rows, "budget_id int, capacity int, id long, size int")).collect()
    assert sorted((r.budget_id, r.id, r.size) for r in out) == sorted((b, i, s) for b, _, i, s in rows)
    used = {}
    for r in out:
        used[(r.budget_id, r.container)] = used.get((r.budget_id, r.container), 0) + r.size
    assert all(u <= (capacity if b == 1 else 50) for (b, _), u in used.items())
    best = sequential(sizes, capacity)
    assert sum(b == 1 for b, _ in used) <= (best if stripe > 1000 else 1.02 * best + 1)


def test_documents(spark):
    texts = [(1, "word " * 700, "x"), (1, "word " * 700, "y"), (1, "other", None), (2, None, None), (3, "", None), (4, "tiny text", None), (None, "no id", None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, size string")
    budgets = spark.createDataFrame([(1, 256, "a"), (2, 4096, "b"), (3, None, "c"), (4, 0, "d")], "budget_id int, capacity int, purpose string")
    rows = pk.pack_documents(docs, budgets)
    assert rows.select("budget_id").distinct().count() == 2
    tokens = {r.budget_id: (r.pieces, r.tokens) for r in pk.packing_report(rows, budgets).collect()}
    assert tokens[1][1] == tokens[2][1] and tokens[2][0] == 4 and tokens[1][0] == 3 + 3
    assert rows.where("budget_id = 1").agg(F.max("size")).first()[0] == 256
    faults = pk.packing_faults(rows.union(rows.where("budget_id = 2 AND doc_id = 4")), budgets).collect()
    assert sorted((r.budget_id, r.texts, r.overfull, r.cut_needlessly, r.repeated) for r in faults) == [(1, 4, 0, 0, 0), (2, 4, 0, 1, 1)]
    assert pk.pack_documents(docs.where("false"), budgets).count() == 0
    assert pk.pack_documents(docs, budgets.where("false")).count() == 0
