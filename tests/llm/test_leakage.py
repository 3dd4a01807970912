"""Leaked evaluation passages against brute force."""

import random
import re

from regatlas.llm import leakage as lk

ITEM, DOC = "item_id long, text string, h string, at int", "doc_id long, text string, words int"


def brute(items, docs, run=6):
    out = set()
    for i, t, *_ in items:
        w = re.findall(r"\w+", (t or "").lower())
        for d, x, *_ in docs:
            v = re.findall(r"\w+", (x or "").lower())
            held = {tuple(v[k : k + run]) for k in range(len(v) - run + 1)}
            marks = set()
            for k in range(len(w) - run + 1):
                if tuple(w[k : k + run]) in held:
                    marks |= set(range(k, k + run))
            if marks and 2 * len(marks) >= len(w):
                out.add((i, d))
    return out


def run(spark, items, docs):
    got = lk.leaked_items(spark.createDataFrame(items, ITEM), spark.createDataFrame(docs, DOC))
    rows = [(r.item_id, r.doc_id) for r in got.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_random_texts(spark, monkeypatch):
    rng = random.Random(11)
    word = lambda: rng.choice("alpha beta gamma delta eps zeta eta theta X_1 ÄB 42".split())
    items = [(i, " ".join(word() for _ in range(rng.randrange(3, 40))), "h", 1) for i in range(30)]
    docs = []
    for d in range(60):
        w = rng.choice(items)[1].split()
        cut = w[rng.randrange(max(1, len(w) // 2)) :]
        if rng.random() < 0.5 and len(cut) > 8:
            cut[rng.randrange(len(cut))] = "changed"
        docs.append((d, ". ".join([" ".join(word() for _ in range(9)), " ".join(cut).upper(), " ".join(word() for _ in range(9))]), 1))
    docs += [(100, None, 1), (101, "", 1), (102, docs[0][1], 1), (0, docs[0][1], 1), (103, "short", 1)]
    items += [(90, None, "h", 1), (91, "five words only in here", "h", 1), items[0]]
    want = brute(items, docs)
    assert want and run(spark, items, docs) == want
    monkeypatch.setattr(lk, "BROADCAST_SHINGLES", 0)
    assert run(spark, items, docs) == want


def test_empty_and_long(spark):
    text = " ".join(f"w{i}" for i in range(20))
    assert run(spark, [(1, text, "h", 1)], []) == set() == run(spark, [], [(1, text, 1)])
    long = " ".join(["filler"] * 200_000) + " " + text
    assert run(spark, [(1, text, "h", 1)], [(5, long, 1)]) == {(1, 5)}
