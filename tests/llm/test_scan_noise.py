"""Scan noise: the trie search against brute force, detection and repair on small streams."""

import random

import pytest
from regatlas.llm import misreadings as mr
from regatlas.llm import scan_noise as sn

SCHEMA = "block_id long, doc_file string, pos int, type string, text string, text_level int, page_idx int, table_body string, field string, word string, n int"


def blocks(spark, rows):
    out = [(i, r.get("doc", "d"), r.get("pos", i), r.get("type", "text"), r.get("text"), r.get("level"), r.get("page", 0), r.get("table"), "f", "w", 1) for i, r in enumerate(rows)]
    return spark.createDataFrame(out, SCHEMA)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), new[-1] + 1, row[j] + 1))
        row = new
    return row[-1]


def test_candidates_are_complete(spark):
    """Every word within the distance is found through the shared segments: against all pairs."""
    rng = random.Random(7)
    some = lambda n: sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 11))) for _ in range(n)})
    words = [*some(150), "register", "controller", "interrupt", "address"]
    tokens = [*some(80), "regixter", "regster", "regisster", "cnntroller", "contrnller", "intenupt", "äöü"]
    rows = [(x, 1, x in words, x in tokens) for x in {*words, *tokens}]
    got = {(r.word, r.candidate): r.distance for r in mr.candidates(spark.createDataFrame(rows, "word string, n long, known boolean, asks boolean")).collect()}
    want = {(t, w): d for t in tokens for w in words if 0 < (d := distance(t, w)) <= mr.distance_allowed(len(t))}
    assert got == want


@pytest.mark.parametrize(
    ("true", "seen", "cost"),
    [("packed", "pocked", 1), ("modern", "rnodern", 1), ("during", "diiring", 1), ("during", "dijring", 2), ("posted", "po5fed", 2), ("register", "regixter", 3), ("resets", "reset", None), ("latter", "letter", None), ("same", "same", 0)],
)
def test_shape_cost(true, seen, cost):
    assert mr.shape_cost(true, seen, mr.cost_allowed(len(seen))) == cost


def test_word_filter_holds_every_word(spark):
    words = [f"w{i}é" for i in range(5000)]
    held = mr.word_filter(spark.createDataFrame([(w,) for w in words], "word string"))
    assert all(w in held for w in words) and sum(f"x{i}" in held for i in range(5000)) < 500
    assert "x" not in mr.word_filter(spark.createDataFrame([], "word string"))


@pytest.mark.parametrize(("token", "want"), [("Ox1F", "0x1F"), ("0xl3O", "0x130"), ("3l", "31"), ("0x1F", None), ("42", None), ("Is", None), ("USB2", None), ("S5", "55"), ("0xSO", "0x50")])
def test_numbers(token, want):
    assert sn.number_misread(token) == want


CLEAN = "the level shifter validates the packed header and the self clearing copy throttles each trace port"


def noise(spark, rows):
    base = [{"text": CLEAN, "doc": f"x{i}"} for i in range(60)]
    got = sn.scan_noise(blocks(spark, [*rows, *base]))
    assert got.columns == ["block_id", "field", "noise"]
    return {tuple(r) for r in got.collect()}


def test_detection(spark):
    rows = [
        {"text": "the level shif-\nter validates", "doc": "a"},
        {"text": "the packed hea¬", "doc": "b", "pos": 1}, {"type": "table", "table": "<table><tr><td>range</td></tr></table>", "doc": "b", "pos": 2}, {"text": "der and the copy", "doc": "b", "pos": 3},
        {"text": "range 3 -\n16384", "doc": "c", "page": 5}, {"text": "ABC-\nDEF", "doc": "c"},
        {"type": "header", "text": "Chapter 1: DEMO", "doc": "e"}, {"text": "the packed\nchapter 2:  demo\n- 7 -", "doc": "e", "page": 4}, {"text": "Page 8 of 9\nthe copy\n1024", "doc": "e", "page": None},
        {"text": "the pocked headcr", "doc": "f"}, {"text": "at Ox1F0 now", "doc": "f"},
        {"type": "table", "table": "<table><tr><td>Lets the lev-<br/>el shifter</td><td>&lt;3l&gt;</td></tr></table>", "doc": "g"},
        {"text": None, "doc": None}, {"text": "", "doc": "h"}, {"type": "table", "table": None, "doc": "h"}, {"text": "the раcked heаder", "doc": "i"},
        {"text": "the level self-\nclearing copy", "doc": "k", "level": 2},
    ]
    got = noise(spark, rows)
    assert got == {
        (0, "text", "hyphen"), (1, "text", "hyphen"), (7, "text", "running"), (7, "text", "page_number"), (8, "text", "page_number"), (9, "text", "misread"), (10, "text", "misread"),
        (11, "table_body", "hyphen"), (11, "table_body", "misread"),
    }


def test_repair(spark):
    base = [{"text": CLEAN, "doc": f"x{i}"} for i in range(60)]
    rows = [
        {"text": "the level shif-\n  ter validates\nthe self-\nclearing copy.\nChapter 1\nThe pocked\nhea-", "doc": "a"}, {"text": "der and the trace\nport", "doc": "a"}, {"type": "footer", "text": "Chapter 9", "doc": "a"},
        {"type": "table", "table": "<table><tr><td>&lt;3l&gt;</td><td>trace po-<br>rt</td></tr></table>", "doc": "a"},
    ]
    got = {(r.block_id, r.field): r.repaired for r in sn.repaired_texts(blocks(spark, rows + base)).collect()}
    assert got[(0, "text")] == "the level shifter validates the self-clearing copy.\nThe packed header"
    assert got[(1, "text")] == "and the trace port"
    assert got[(3, "table_body")] == "<table><tr><td>&lt;31&gt;</td><td>trace port</td></tr></table>"


def test_long_text_repeats_and_empty_table(spark):
    long = "\n".join([CLEAN] * 3000) + "\nthe lev-\nel"
    df = blocks(spark, [{"text": long}])
    assert {tuple(r) for r in sn.scan_noise(df.union(df)).collect()} == {(0, "text", "hyphen")}
    assert sn.scan_noise(df.where("false")).count() == 0 and sn.repaired_texts(df.where("false")).count() == 0


def test_neighbours_across_spans(spark):
    rows = [{"text": CLEAN, "pos": i} for i in range(sn.SPAN - 1)] + [{"text": "the lev-", "pos": sn.SPAN - 1}, {"text": "el", "pos": sn.SPAN * 3}]
    assert {tuple(r) for r in sn.scan_noise(blocks(spark, rows)).collect()} == {(sn.SPAN - 1, "text", "hyphen")}


def test_capital_taken_for_a_small_letter(spark):
    base = [{"text": CLEAN + " clock and optional translation", "doc": f"x{i}"} for i in range(120)]
    rows = [{"text": "the cIock drives", "doc": "a"}, {"text": "an optionaI port", "doc": "b"}, {"text": "CIock and TransIation", "doc": "c"}, {"text": "the CIOCK at 5 MHz for IOs, SoC and txData", "doc": "d"}]
    df = blocks(spark, rows + base)
    assert {tuple(r) for r in sn.scan_noise(df).collect()} == {(i, "text", "misread") for i in range(3)}
    got = {r.block_id: r.repaired for r in sn.repaired_texts(df).collect()}
    assert [got[i] for i in range(3)] == ["the clock drives", "an optional port", "Clock and Translation"]


SOUND = [
    "Буфер очищается перед новой передачей.", "Ο καταχωρητής μηδενίζεται.", "Der Zähler übernimmt den ältesten Eintrag.", "时钟关闭期间，事件路由器丢弃当前描述符。", "cooperative naïve coöperative x̂ ﬁne a\u200bb",
    "fields: A & B < C; 0x1F; CRC-\nSEED", "",
]


def test_sound_text_of_any_script_is_unchanged(spark):
    rows = [{"text": t} for t in SOUND] + [{"type": "table", "table": f"<table><tr><td>{t} <b>x</b> &lt;y&gt;</td></tr></table>"} for t in SOUND]
    got = {(r.block_id, r.field): r.repaired for r in sn.repaired_texts(blocks(spark, rows + [{"text": CLEAN}] * 60)).collect()}
    for i, t in enumerate(SOUND):
        if t:
            assert got[(i, "text")] == t.replace("\n", " ")
        assert got[(i + len(SOUND), "table_body")] == rows[i + len(SOUND)]["table"]


def test_blocks_of_furniture_are_passed_over(spark):
    rows = [
        {"type": "header", "text": "Chapter 9: DEMO", "pos": 1}, {"text": "the level shif-", "pos": 2}, {"text": "Chapter 7: DEMO", "pos": 3}, {"text": "ter, which validates", "pos": 4},
        {"text": "wholly other words here.", "pos": 70},
    ]
    df = blocks(spark, rows + [{"text": CLEAN, "doc": f"x{i}"} for i in range(60)])
    assert {tuple(r) for r in sn.scan_noise(df).collect()} == {(1, "text", "hyphen"), (2, "text", "running")}
    got = {r.block_id: r.repaired for r in sn.repaired_texts(df).collect()}
    assert [got[i] for i in (1, 2, 3, 4)] == ["the level shifter,", "", "which validates", "wholly other words here."]


def test_page_numbers_by_the_document_s_offset(spark):
    feet = [{"type": "footer", "text": f"Rev D | {p + 109}", "page": p, "doc": "a"} for p in range(4)]
    rows = [
        {"text": "114\nthe copy", "page": 5, "doc": "a"}, {"text": "the copy\n5", "page": 5, "doc": "a"}, {"text": "~~ 112 " + "~" * 80, "page": 3, "doc": "a"}, {"text": "Page iv", "page": 3, "doc": "b"},
        {"text": "- ii -", "page": 1, "doc": "c"}, {"text": "- iii -", "page": 2, "doc": "c"}, {"text": "MIX", "page": 2, "doc": "c"}, {"text": "six\n第 5 页", "page": 2, "doc": "d"}, {"text": "版本 12\n在 67 个周期内", "page": 2, "doc": "d"},
    ]
    got = {r.block_id for r in sn.scan_noise(blocks(spark, rows + feet)).collect()}
    assert got == {0, 2, 3, 4, 5, 7}
