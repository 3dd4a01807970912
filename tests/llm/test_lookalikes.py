"""Look-alike classes and rewriting."""

from regatlas.llm import lookalikes as lk


def sources(spark, texts):
    return {"s": spark.createDataFrame(list(enumerate(texts)), "row_key long, text string")}


CASES = {
    "ＲＸ＿ＣＦＧ １２": "RX_CFG 12", "naïve": "naïve", "he​ad﻿er": "header", "a b c d": "a b c d", "oﬀset ﬃx": "offset ffix", "DΑNО_X": "DANO_X", "ＡАΑb": "AAAb",
}
SAME = ["plain", "", None, "Счётчик принимает", "默认值（ＩＤ）："[:4], "，：；。", "25 kΩ ± 3 μs²", "naïve façade", "Δt = 2 · π", "СОМ"]


def test_rewrites(spark):
    texts = [*CASES, *SAME] + ["DANO header offset abc RX naïve naïve"] * 5
    rows = {r.row_key: r for r in lk.canonical_texts(sources(spark, texts)).collect()}
    assert [rows[i].canonical for i in range(len(CASES))] == list(CASES.values())
    assert all(rows[len(CASES) + i].canonical == t for i, t in enumerate(SAME))
    found = {r.row_key for r in lk.unusual_rows(sources(spark, texts)).collect()}
    assert found == set(range(len(CASES)))


def test_representative_is_the_most_frequent_member(spark):
    texts = sources(spark, ["Ａx"] * 2 + ["А1a"] * 9)["s"].select("text")
    classes = lk.lookalike_classes(texts)
    assert classes["Ａ"] == "А" == classes.get("A", "А")


def test_empty_and_long(spark):
    assert lk.unusual_rows({"s": spark.createDataFrame([], "row_key long, text string")}).count() == 0
    assert lk.rewriter({})("x") == "x"
    whole = lk.rewriter({"Ｘ": "X", "​": ""})
    assert whole("Ｘ​" * 50_000) == "X" * 50_000


def test_accents_without_a_letter_of_their_own(spark):
    rows = [(1, "x\u0302 axis"), (2, "5\u0304 and \u0301"), (3, "за\u0301мок"), (4, "cafe\u0301"), (5, "naïve café"), (6, "plain")]
    got = {r.row_key: r.canonical for r in lk.canonical_texts({"s": spark.createDataFrame(rows, "row_key long, text string")}).collect()}
    assert got == {1: "x axis", 2: "5 and ", 3: "замок", 4: "café", 5: "naïve café", 6: "plain"}
