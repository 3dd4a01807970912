"""Queries that must take in all of their rows, on small tables of their own or against the SQL without its cut."""

from pathlib import Path

import __spark_entry__ as entry
import duckdb
import pytest
from regatlas.operators import chunk

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="no test tables here")
@pytest.mark.parametrize("name", ["rrf_fusion", "rrf_bonus", "relative_fusion", "hybrid_module_filter"])
def test_fusion_keeps_questions_without_a_vector(spark, name):
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    whole = entry.oracle_sql()[name]
    got = entry.queries()[name](spark, str(DATA))
    rows = {tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in got.collect()}
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({whole})").fetchall()
    assert len({r[0] for r in rows}) > con.execute("SELECT count(*) FROM embeddings WHERE vec_id % 50 = 0").fetchone()[0]
    assert rows == {tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in want}


def test_hit_rates_judge_by_what_is_expected(spark, tmp_path):
    field = "array<struct<name:string,bit_range:string,access:string,reset_value:string,typical_value:string,description:string>>"
    expected = "struct<register_name:string,bit_field:string,caption_contains:string,section_contains:string>"
    tables = {
        "eval_items": (
            [
                (1, "fifo overflow", None, None, "prose", (None, None, None, "FIFO")), (2, "fifo overflow", None, None, "prose", (None, None, None, "absent")),
                (3, "fifo overflow", None, None, "prose", (None, None, None, " ")), (4, "fifo overflow", None, "modb", "prose", (None, None, None, "second")),
                (5, "q", "ctrl", None, "register", ("B_CTRL", "big en", None, None)), (6, "q", "ctrl", "MODA", "register", ("C_CTRL", None, None, None)), (7, "q", "flow", None, "figure", (None, None, "Block", None)),
            ],
            f"item_id long, query string, keyword string, module string, type string, expected {expected}",
        ),
        "documents": ([(0, "fifo overflow fifo overflow", "s", "MODA"), (50, "second text on fifo overflow and more words", "s", "MODB"), (100, "nothing", "s", None)], "doc_id long, text string, source string, module string"),
        "embeddings": ([(0, [1.0, 0.0])], "vec_id long, embedding array<float>"),
        "knowledge": (
            [
                (1, "registers", "MODA", "A_CTRL", None, None, []), (2, "registers", "MODA", "B_CTRL", None, None, [("BIG_EN", "", "", "", "", "")]), (3, "registers", "MODB", "C_CTRL", None, None, None),
                (4, "figures", "MODA", None, "flow of data", None, None), (5, "figures", "MODA", None, "Block flow", None, None),
            ],
            f"record_id long, collection string, module string, register_name string, caption string, description string, bit_fields {field}",
        ),
        "kb_sections": ([("s", "t", 1)], "section_id string, text string, section_row long"),
    }
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        if name == "knowledge":
            df = df.selectExpr("*", "'' AS address", "'s' AS section_id", "CAST(NULL AS STRING) AS name")
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    got = {(r.config, r.type): (r.n, r.hit1, r.hit5) for r in entry.queries()["hit_at_k"](spark, str(tmp_path)).collect()}
    prose = {(c, "prose"): (4, 2, 2) for c in ("bm25", "hybrid_rrf", "hybrid_rrf_bonus", "hybrid_relative")}
    assert got == prose | {("search_registers", "register"): (2, 0, 1), ("search_concepts", "figure"): (1, 0, 1)}


@pytest.mark.skipif(not DATA.exists(), reason="no test tables here")
def test_chunks_of_all_sources(spark):
    rows = entry.queries()["breadcrumb_chunks"](spark, str(DATA)).orderBy("chunk_idx").collect()
    assert [r.chunk_idx for r in rows] == list(range(len(rows)))
    kinds = list(dict.fromkeys(r.kind for r in rows))
    assert kinds == ["section", "algorithm", "register", "enum", "markdown"]  # these tables hold no table of another class
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    want = con.execute(f"SELECT chunk_idx, kind, section_id, ord, piece, breadcrumb, embed_text FROM ({entry.oracle_sql()['breadcrumb_chunks']})").fetchall()
    assert {tuple(r[c] for c in ("chunk_idx", "kind", "section_id", "ord", "piece", "breadcrumb", "embed_text")) for r in rows} == set(want)


def test_units_of_all_sources(spark):
    long = "words enough to make one chunk of their own"
    common = "'M' AS module, 's' AS section_id, 1 AS page, 1 AS ord"
    kb = {
        "sections": spark.sql(f"SELECT {common}, 'T' AS title, '{long}' AS text"),
        "algorithms": spark.sql(f"SELECT {common}, '' AS caption, 'code' AS sub_type, '{long}' AS text"),
        "registers": spark.sql(f"SELECT {common}, 'R_CTRL' AS register_name, '0x4' AS address, '{long}' AS description, array(named_struct('name', 'EN', 'bit_range', '0', 'access', 'RW', 'reset_value', '0', 'description', 'on')) AS bit_fields"),
        "enums": spark.sql(f"SELECT {common}, 'E' AS name, array(named_struct('value', '0', 'mnemonic', 'OFF', 'description', '{long}')) AS values"),
        "tables": spark.sql(f"SELECT {common}, 'C' AS caption, array('a', 'b') AS header, array(array('{long}', 'x')) AS rows"),
    }
    marked = spark.sql(f"SELECT 'M' AS module, 'H' AS heading, '{long}' AS body, 0 AS ord")
    units = chunk.units(kb, dict.fromkeys(kb, "ord") | {"tables": ["ord", "section_id"]}, marked)
    got = {r.kind: (r.breadcrumb, r.text) for r in chunk.chunks(units).collect()}
    assert got == {
        "section": ("M › T", long), "algorithm": ("M › code", long), "register": ("M › R_CTRL", f"R_CTRL. 0x4. {long}. 0 EN RW 0 on"), "enum": ("M › E", f"E. 0 OFF {long}"),
        "table": ("M › C", f"a | b {long} | x"), "markdown": ("M › H", long),
    }
