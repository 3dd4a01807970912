"""Differences of two copies against a dictionary comparison."""

import random
from datetime import datetime

import pyarrow as pa
from regatlas.functions.lookalike import plain_identifier
from regatlas.operators.copydiff import chunk_rows, copy_differences, register_differences

FIELD = "array<struct<name:string,bit_range:string,access:string,reset_value:string,typical_value:string,description:string>>"
LEFT = f"record_id long, collection string, module string, register_name string, address string, bit_fields {FIELD}, built_at timestamp, side string, chunk string"
RIGHT = f"alt_id long, module string, register_name string, address string, bit_fields {FIELD}, built_at timestamp, difference string"
T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_random_copies(spark):
    rng = random.Random(3)
    left = {f"K{i:04}": (str(rng.randrange(5)), rng.choice([None, "x"])) for i in range(800)}
    right = dict(left)
    for k in rng.sample(sorted(left), 25):
        right.pop(k)
    for k in rng.sample(sorted(right), 25):
        right[k] = ("new", right[k][1])
    right |= {f"K{i:04}x": ("1", "y") for i in range(0, 300, 20)}
    schema = "key string, a string, b string"
    got = copy_differences(
        spark.createDataFrame([(k, *v) for k, v in left.items()], schema), spark.createDataFrame([(k, *v) for k, v in right.items()], schema), ["key"], ["a", "b"], only_left="l", only_right="r"
    ).collect()
    want = {(k, "l") for k in left.keys() - right.keys()} | {(k, "r") for k in right.keys() - left.keys()}
    want |= {(k, f) for k in left.keys() & right.keys() for i, f in enumerate("ab") if left[k][i] != right[k][i]}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def chunks_of(sides, keys, batch=None):
    rows = pa.RecordBatch.from_pydict({"side": pa.array(sides, pa.string()), "key_hash": pa.array(keys, pa.int64()), "row_hash": pa.array(keys, pa.int64()), "row_hash_2": pa.array([k >> 3 for k in keys], pa.int64())})
    batches = [rows.slice(i, batch) for i in range(0, len(keys), batch)] if batch else [rows]
    out = [r for b in chunk_rows(iter(batches)) for r in zip(b.column("side").to_pylist(), b.column("key_hash").to_pylist(), b.column("chunk").to_pylist())]
    assert [r[:2] for r in out] == list(zip(sides, keys))
    return [r[2] for r in out]


def test_chunks_are_cut_by_content():
    rng = random.Random(1)
    keys = [rng.getrandbits(60) for _ in range(3000)]
    base, more = chunks_of(["l"] * 3000, keys), chunks_of(["l"] * 3001, keys[:1000] + [5] + keys[1000:])
    assert len(set(base)) > 300 and len(set(base) - set(more)) <= 3
    assert chunks_of(["l"] * 3000 + ["r"] * 3000, keys * 2)[3000:] == base


def test_chunks_do_not_depend_on_batches():
    rng = random.Random(2)
    keys = [rng.getrandbits(60) for _ in range(500)] + [7] * 5000 + [rng.getrandbits(60) for _ in range(500)]
    sides = ["l"] * 2000 + ["r"] * 4000
    whole = chunks_of(sides, keys)
    assert max(whole.count(c) for c in {c for c in whole}) <= 6000 and max(int(c.split(":")[0]) for c in whole) <= 1024
    for batch in (1, 7, 1000):
        assert chunks_of(sides, keys, batch) == whole
    assert chunks_of([], []) == []


def test_registers(spark):
    f = lambda *names: [(n, "<0>", "RW", None, "t", "d") for n in names]
    left = [
        (1, "registers", "Abc", "R_ONE", "0x10", f("A", "B"), T1, None, None), (2, "registers", "ABC", "R_ONE", "0x11", f("A", "B"), T2, None, None), (2, "registers", "ABC", "R_ONE", "0x11", f("A", "B"), T2, None, None),
        (3, "registers", "abc", "R_TWO", None, None, T1, None, None), (4, "registers", "abc", "R_THREE", "0x1", f("A"), T1, None, None), (5, "registers", "abc", None, "0x1", None, T1, None, None),
        (6, "registers", "abc", " ", "0x1", None, T1, None, None), (7, "enums", "abc", "R_ENUM", "0x1", None, T1, None, None),
    ]
    right = [
        (1, "abc", "r_оne", " 0X11 ", [("b", "<0>", "rw", "", "z", "z"), (" A ", "<0>", "RW", " ", None, None)], T1, None), (2, "abc", "R​_TWO", "", [], None, None),
        (3, "abc", "R_THREE", "0x2", f("A", "C"), T1, None), (4, "abc", "R_FOUR", "0x2", None, T1, None),
    ]
    got = register_differences(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT))
    assert got.columns == ["module", "register_name", "difference"]
    assert sorted(tuple(r) for r in got.collect()) == [("ABC", "R_FOUR", "only_alt"), ("ABC", "R_THREE", "address"), ("ABC", "R_THREE", "bit_fields")]
    assert register_differences(spark.createDataFrame([], LEFT), spark.createDataFrame([], RIGHT)).count() == 0
    assert register_differences(spark.createDataFrame([], LEFT), spark.createDataFrame(right, RIGHT)).count() == 4


def test_plain_identifier(spark):
    rows = spark.createDataFrame([("ＡВ​Ｃ＿１",), (" ﬁx́ ",), (None,)], "s string")
    assert [r[0] for r in rows.select(plain_identifier(rows.s)).collect()] == ["ABC_1", "FIX", None]
