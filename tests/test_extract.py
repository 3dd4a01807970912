"""Extraction of a small block stream, tables and the adapter."""

from pyspark.sql import functions as F
from regatlas.functions import tables as tb
from regatlas.operators import adapter, extract, quality
from regatlas.profile import Profile

BLOCK = (
    "block_id long, doc_file string, module string, pos int, type string, text string, text_level int, page_idx int, table_body string, latex string, code_body string, sub_type string, "
    "code_caption array<string>, image_caption array<string>, img_path string"
)
PROFILE = Profile.from_dict(
    {
        "bit_position_patterns": [r"^b\d+(?:-b\d+)?$"], "enum_suffixes": ["_KIND"],
        "table_header_aliases": {
            "bit_position": ["lines"], "field_name": ["flag"], "register": ["cell"], "address": ["place"], "mnemonic": ["short form"], "value": ["number"], "access": ["rights"], "reset": ["at start"], "description": ["remark"],
        },
    }
)


def table_html(*rows):
    return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"


def stream(spark, rows, doc="d", module="Pump"):
    keys = [c.split()[0] for c in BLOCK.split(", ")]
    full = [{"block_id": i, "doc_file": doc, "module": module, "pos": i, **r} for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r.get(k) for k in keys) for r in full], BLOCK)


HEATER = table_html(["Lines", "Flag", "Rights", "At start", "Remark"], ["b4", "warm", "read", "1", "Water flows"], ["none", "IGNORED", "", "", ""], ["b6-b5", "", "write", "", ""])
ROWS = [
    {"type": "footer", "text": "printed in the mill"},
    {"type": "text", "text": "7 Water Pump", "text_level": 2, "page_idx": 40},
    {"type": "text", "text": "Two valves & a wheel.", "page_idx": 40},
    {"type": "chart", "image_caption": ["Flow", "by hour"], "img_path": "shots/flow.svg", "page_idx": 41},
    {"type": "table", "table_body": table_html(["Cell", "Place"], ["PUMP_LOST", "0xBEE"], ["PUMP_HEAT", "from 0xC0F on"]), "page_idx": 41},
    {"type": "text", "text": "7.3 PUMP_HEAT", "text_level": 3, "page_idx": 42},
    {"type": "text", "text": "Keep it covered.", "page_idx": 42},
    {"type": "table", "table_body": HEATER, "page_idx": 42},
    {"type": "table", "table_body": table_html(["Lines", "Flag"], ["b8", "dry"]), "page_idx": 43},
    {"type": "text", "text": "7.4 PUMP_VALVE_KIND", "text_level": 3, "page_idx": 44},
    {"type": "table", "table_body": table_html(["Number", "Short form", "Remark"], ["3", "BALL", "round"], ["", "", "left out"], ["5", "GATE", ""]), "page_idx": 44},
    {"type": "equation", "latex": "p = q / r", "page_idx": 45},
    {"type": "code", "code_body": "open\n  valve", "sub_type": "listing", "code_caption": ["Start", "slowly"], "page_idx": 45},
    {"type": "text", "text": "7 Water Pump", "text_level": 4, "page_idx": 60},
    {"type": "text", "text": "Empty it in winter.", "page_idx": 60},
    {"type": "table", "table_body": table_html(["Tool", "Size"], ["spanner", "9"]), "page_idx": 60},
]


def test_build(spark):
    kb = extract.build_kb(stream(spark, ROWS).unionByName(stream(spark, ROWS)), PROFILE)
    secs = {r.section_id: r for r in kb["sections"].collect()}
    pump = secs["pump:7-water-pump"]
    assert (pump.text, pump.level, pump.page) == ("Two valves & a wheel. Empty it in winter.", 2, 40) and sorted(secs) == ["pump:7-3-pump-heat", "pump:7-4-pump-valve-kind", "pump:7-water-pump"]
    regs = [(r.register_name, r.address, r.description, r.page, [(f["name"], f["bit_range"], f["access"], f["reset_value"]) for f in r.bit_fields]) for r in kb["registers"].collect()]
    assert regs == [("PUMP_HEAT", "0xC0F", "7.3 PUMP_HEAT", 42, [("warm", "b4", "read", "1"), ("RESERVED", "b6-b5", "write", ""), ("dry", "b8", "", "")])]
    assert [(r.name, [(v["value"], v["mnemonic"], v["description"]) for v in r["values"]]) for r in kb["enums"].collect()] == [("PUMP_VALVE_KIND", [("3", "BALL", "round"), ("5", "GATE", "")])]
    assert [(r.img_path, r.caption, r.context) for r in kb["figures"].collect()] == [("images/Pump/flow.svg", "Flow by hour", pump.text)]
    assert [(r.latex, r.page) for r in kb["formulas"].collect()] == [("p = q / r", 45)]
    assert [(r.text, r.caption, r.sub_type) for r in kb["algorithms"].collect()] == [("open valve", "Start slowly", "listing")]
    assert [(r.caption, r.header, r["rows"]) for r in kb["tables"].collect()] == [("7 Water Pump", ["Tool", "Size"], [["spanner", "9"]])]


def test_one_collection_alone_is_the_same(spark):
    blocks = stream(spark, ROWS)
    whole = extract.build_kb(blocks, PROFILE)
    for name in extract.COLLECTIONS:
        assert extract.build_kb(blocks, PROFILE, (name,))[name].collect() == whole[name].collect()


def test_fields_without_a_register_are_lost_and_registers_outlast_headings(spark):
    bits = {"type": "table", "table_body": table_html(["Lines", "Flag"], ["b2", "wet"])}
    alone = extract.build_kb(stream(spark, [bits]), PROFILE)
    assert alone["registers"].isEmpty() and alone["tables"].isEmpty()
    rows = [{"type": "text", "text": "PUMP_LEFT"}, {"type": "text", "text": "9 Spare parts", "text_level": 1}, bits, {"type": "text", "text": "nine or more words stand here before the PUMP_RIGHT"}, bits]
    kb = extract.build_kb(stream(spark, rows), PROFILE)
    assert [(r.register_name, [f["name"] for f in r.bit_fields]) for r in kb["registers"].collect()] == [("PUMP_LEFT", ["wet", "wet"])]
    assert kb["sections"].first().text == "nine or more words stand here before the PUMP_RIGHT"


def test_forward_fill_over_spans(spark):
    rows = [(g, i, i if i % 7 == 3 else None) for g in "ab" for i in range(40)]
    got = extract.forward_fill(spark.createDataFrame(rows, "k string, p int, v int"), "k", "p", ["v"], span=4).collect()
    assert len(got) == 80 and all(r.last_v == (None if r.p < 3 else (r.p - 3) // 7 * 7 + 3) for r in got)


def test_columns_and_classes(spark):
    df = spark.createDataFrame([(["Register", "BAR", "Address", "Type"],), (["Register", "BAR", "Description"],), (["Bit Pos", "Field Name"],), (["x"],)], "h array<string>")
    got = df.select(tb.find_col(F.col("h"), "address"), tb.classify_table(F.col("h"))).collect()
    assert [tuple(r) for r in got] == [(2, "summary"), (1, "summary"), (None, "bitfield"), (None, "other")]


def test_html_rows(spark):
    body = "<table><tr><th>A<br/>B</th><td>x &lt;3&gt; Confidential</td></tr><tr><td> </td></tr><tr><td>c<b>d</b>"
    df = spark.createDataFrame([(body,), (None,), ("",)], "b string")
    assert [r[0] for r in df.select(tb.html_rows(F.col("b"))).collect()] == [[["A B", "x <3>"], ["c d"]], [], []]


def test_adapter(spark):
    schema = "doc_file string, pos int, label string, text string, level int, page_no int, table_body string, caption string, img_uri string"
    items = [
        ("d", 0, "Page_Header", "h", None, 1, None, None, None), ("d", 1, "section_header", "T", None, 3, None, None, None), ("d", 2, "title", "T", 2, None, None, None, None), ("d", 3, "table", None, None, 1, "<table/>", None, None),
        ("d", 4, "table", None, None, 1, None, None, None), ("d", 5, "chart", None, None, 2, None, "c", "u"), ("d", 6, "formula", " ", None, 1, None, None, None), ("d", 7, "code", "x", None, 1, None, None, None),
        ("d", 8, "caption", "cap", None, 0, None, None, None), ("d", 9, None, "p", None, 1, None, None, None),
    ]
    got = {r.pos: r for r in adapter.to_blocks(spark.createDataFrame(items, schema)).collect()}
    assert {p: r.type for p, r in got.items()} == {0: "header", 1: "text", 2: "text", 3: "table", 5: "image", 7: "code", 8: "text", 9: "text"}
    assert (got[1].text_level, got[1].page_idx, got[2].text_level, got[2].page_idx, got[8].page_idx, got[5].image_caption, got[9].text_level) == (1, 2, 2, 0, 0, ["c"], None)


def test_quality(spark):
    blocks = stream(spark, ROWS)
    tables = extract.table_blocks(blocks, PROFILE)
    counts = quality.audit_counts(blocks.union(stream(spark, ROWS[:3], doc="e")), tables, PROFILE).collect()
    got = {(r.metric, r.label): r.n for r in counts if r.doc_file is None}
    assert got == {
        ("block", "text"): 9, ("block", "table"): 5, ("block", "footer"): 2, ("block", "chart"): 1, ("block", "equation"): 1, ("block", "code"): 1, ("heading", "2"): 2, ("heading", "3"): 2, ("heading", "4"): 1,
        ("table", "bitfield"): 2, ("table", "summary"): 1, ("table", "enum"): 1, ("table", "other"): 1, ("anchor", "distinct"): 2,
    }
    assert {(r.metric, r.label): r.n for r in counts if r.doc_file == "e"} == {("block", "text"): 2, ("block", "footer"): 1, ("heading", "2"): 1}
    regs = "record_id long, built_at int, register_name string, address string, bit_fields array<struct<name:string>>"
    a = spark.createDataFrame([(1, 1, "R_A", "0x1", [("F",)]), (2, 1, "R_B", "", [("F",), ("G",)]), (3, 1, "R_C", None, None)], regs)
    b = spark.createDataFrame([(1, 1, "r_a", "0X1", [("f",)]), (2, 1, "R_B", "0x2", [("G",)]), (3, 1, "R_D", None, None)], regs)
    met = quality.compare(a, b, ["built_at", "record_id"], ["built_at", "record_id"])
    assert {(r.name, r.side, r.address, r.field_jaccard) for r in met.collect()} == {("R_A", "both", "agree", 1.0), ("R_B", "both", "missing_a", 0.5), ("R_C", "only_a", None, None), ("R_D", "only_b", None, None)}
    assert quality.compare_summary(met).first().jaccard == 0.5
    assert quality.compare_summary(met.where("false")).first().jaccard == 1.0


def test_validation(spark):
    dup = spark.createDataFrame([("section", "s", 2), ("section", "t", 3)], "kind string, key string, n long")
    orphans = spark.createDataFrame([("enums", 4)], "collection string, n_orphans long")
    cover = spark.createDataFrame([("registers_with_address", 1, 5, 0.2, True), ("sections_with_text", 1, 5, 0.2, False)], "metric string, n long, of long, share double, low boolean")
    want = {("error", "duplicate section", 2), ("error", "orphans in enums", 4), ("warning", "low registers_with_address", 4)}
    assert {tuple(r) for r in quality.validation_report(dup, orphans, cover).collect()} == want
    assert {r.level for r in quality.validation_report(dup, orphans, cover, strict=True).collect()} == {"error"}
    assert quality.validation_report(dup.where("false"), orphans.where("false"), cover.where("false")).isEmpty()


def test_gold_questions_against_the_knowledge_base(spark):
    asked = "item_id long, expected struct<register_name:string,caption_contains:string,section_contains:string>, needle string"
    items = [(1, ("pump_heat", None, None), "x"), (2, ("PUMP_COLD", " ", ""), "x"), (3, (None, "by HOUR", None), "x"), (4, (None, "by day", None), "x"), (5, (None, None, "wheel"), "x"), (6, (None, None, "sail"), "x"), (7, None, "x")]
    kb = [spark.createDataFrame(rows, schema) for rows, schema in (
        ([("PUMP_HEAT",), (None,)], "register_name string"), ([("Flow by hour",)], "caption string"), ([(None, "a Wheel"), ("t", None)], "title string, text string"),
    )]
    got = {tuple(r) for r in quality.unanchored_questions(spark.createDataFrame(items, asked), *kb).collect()}
    assert got == {(2, "register not in the knowledge base"), (4, "caption not in the knowledge base"), (6, "section not in the knowledge base")}
