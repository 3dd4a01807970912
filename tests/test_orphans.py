"""Orphan references against a row-by-row check."""

import random
from datetime import datetime, timedelta

from regatlas.operators.orphans import orphan_references, orphan_report, unresolved_keys

T0 = datetime(2024, 1, 1)
RECORDS = "record_id long, section_id string, built_at timestamp, collection string, reason string"
PARENTS = "section_id string, created_at timestamp, deleted_at timestamp, key string"


def brute(records, parents):
    out = set()
    for rid, key, at, *_ in records:
        if key is None or not key.strip():
            continue
        own = [p for p in parents if p[0] == key]
        if any(at and c and c <= at and (d is None or d > at) for _, c, d, *_ in own):
            continue
        made = [c for _, c, *_ in own if c]
        out.add((rid, "missing" if not own else "late" if at and made and min(made) > at else "deleted"))
    return out


def run(spark, records, parents):
    rows = orphan_references(spark.createDataFrame(records, RECORDS), spark.createDataFrame(parents, PARENTS), record_id="record_id", key="section_id", at="built_at")
    got = [(r.record_id, r.reason) for r in rows.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_random_histories_with_hot_key(spark):
    rng = random.Random(7)
    keys = ["hot"] * 5 + [f"k{i}" for i in range(12)]
    day = lambda: T0 + timedelta(days=rng.randrange(120), hours=rng.randrange(24))
    parents = []
    for _ in range(60):
        c = day()
        parents.append((rng.choice(keys), c, rng.choice([None, None, c + timedelta(days=rng.randrange(0, 50))]), "x"))
    records = [(i, rng.choice([*keys, "gone", "", "  ", None]), day(), "enums", "x") for i in range(400)]
    records += records[:20]
    assert run(spark, records, parents) == brute(records, parents)


def test_nulls_and_exact_keys(spark):
    parents = [("a", T0, None, None), ("b", None, None, None), (None, T0, None, None), ("d", T0, T0, None)]
    records = [(1, "a", T0, None, None), (2, "A", T0, None, None), (3, "b", T0, None, None), (4, "a", None, None, None), (5, "d", T0, None, None), (6, "a", T0 - timedelta(days=1), None, None), (7, "a ", T0, None, None)]
    assert run(spark, records, parents) == brute(records, parents) == {(2, "missing"), (3, "deleted"), (4, "deleted"), (5, "deleted"), (6, "late"), (7, "missing")}


def test_empty_tables(spark):
    records = [(1, "a", T0, "enums", None)]
    assert run(spark, records, []) == {(1, "missing")}
    assert run(spark, [], [("a", T0, None, None)]) == set()


def test_and_not_over_key_ranges(spark):
    refs = spark.createDataFrame([(f"k{i}", p) for i in range(50) for p in (3, 4)], "key string, period int")
    parents = spark.createDataFrame([(f"k{i}", 2, None if i % 2 else 3) for i in range(0, 50, 3)], "key string, first int, last int")
    left = {(r.key, r.period) for r in unresolved_keys(refs, parents).collect()}
    alive = {(f"k{i}", p) for i in range(0, 50, 3) for p in (3, 4) if i % 2 or p == 3}
    assert left == {(f"k{i}", p) for i in range(50) for p in (3, 4)} - alive


def test_report(spark):
    records = spark.createDataFrame([(1, "a", T0, "enums", None), (2, "b", T0, "enums", None)], RECORDS)
    lost = orphan_references(records, spark.createDataFrame([], PARENTS), record_id="record_id", key="section_id", at="built_at")
    assert [tuple(r) for r in orphan_report(lost, records, record_id="record_id", at="built_at", by="collection").collect()] == [("enums", "2024-01", "missing", 2)]
