"""Ranking, fusion, chunking and look-up."""

import math
import random

import numpy as np
from pyspark.sql import functions as F
from regatlas.functions.text import haystack
from regatlas.operators import chunk, rank, search


def ranking(spark, rows):
    return spark.createDataFrame([(1, k, s, i + 1) for i, (k, s) in enumerate(rows)], "qid long, doc_id long, score double, rank int")


def fused(df):
    return {r.doc_id: round(r.fused, 6) for r in df.collect()}


def test_bm25_prefers_the_matching_document(spark):
    docs = spark.createDataFrame([(0, "The unit receives jobs from the queue"), (1, "Clock settings"), (2, "")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "which unit receives a job job"), (2, "nothing matches zzz"), (3, "")], "qid long, query string")
    (hit,) = rank.bm25_topk(docs, "doc_id", "text", asked).collect()
    idf, dl, avg = math.log(1 + (3 - 1 + 0.5) / 1.5), 7, 9 / 3
    each = idf * 2.5 / (1 + 1.5 * (0.25 + 0.75 * dl / avg))
    assert (hit.qid, hit.doc_id) == (1, 0) and abs(hit.score - 4 * each) < 1e-6


def test_dense_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(rank, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(0)
    v = rng.normal(size=(80, 8)).round(2)
    df = spark.createDataFrame([(i, [float(x) for x in v[i]]) for i in range(80)], "id long, v array<float>")
    got = {(r.qid, r.rank): r.id for r in rank.dense_topk(df, "id", "v", df.where("id % 10 = 0").select(F.col("id").alias("qid"), F.col("v").alias("vector")), 7).collect()}
    v32 = v.astype(np.float32).astype(np.float64)
    for q in range(0, 80, 10):
        s = np.round(v32 @ v32[q], 9)
        assert [got[(q, i + 1)] for i in range(7)] == sorted(range(80), key=lambda k: (-s[k], k))[:7]


def test_relative_score(spark):
    got = fused(rank.relative_score(ranking(spark, [(0, 0.8), (1, 0.4)]), ranking(spark, [(1, 10.0), (2, 5.0)]), "doc_id"))
    assert got == {0: 0.5, 1: 0.75, 2: 0.25}


def test_rrf_bonus_once_and_ties(spark):
    a, b = ranking(spark, [(0, 0.9), (1, 0.5)]), ranking(spark, [(1, 9.0), (0, 1.0)])
    rows = rank.rrf(a, b, "doc_id", 0.1, 0.05).collect()
    assert {r.doc_id: round(r.fused, 6) for r in rows} == {k: round(1 / 61 + 1 / 62 + 0.1, 6) for k in (0, 1)}
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.rank)] == [0, 1]


def test_module_filter_comes_after_fusion(spark):
    hits = rank.rrf(ranking(spark, [(i, 1.0 - i / 10) for i in range(4)]), ranking(spark, []), "doc_id")
    docs = spark.createDataFrame([(i, "M" if i > 1 else "N") for i in range(4)], "doc_id long, module string")
    assert [(r.doc_id, r.rank, r.place) for r in rank.pooled(hits, docs, "doc_id", F.col("module") == "M", top_k=1).collect()] == [(2, 3, 1)]


def test_split_covers_text_and_keeps_the_tail():
    rng = random.Random(2)
    for n in (10, 40, 900, 901, 3000):
        text = "".join(rng.choice("abc ;. ") for _ in range(n)).strip()
        pieces = chunk.split_text(text)
        assert all(40 <= len(p) <= 900 for p in pieces) and (len(text) > 900 or pieces == [text] * (len(text) >= 40))
    text = "x" * 1000
    assert [len(p) for p in chunk.split_text(text)] == [900, 250, 150]


def test_markdown_units(spark):
    docs = spark.createDataFrame([(1, "lead\n# One\na\n|t|\n\n b\n## Two\n### Three\nc"), (2, None)], "doc_id long, text string")
    got = [(r.heading, r.body) for r in chunk.markdown_units(docs, "doc_id", "text").orderBy("unit").collect()]
    assert got == [("", "lead"), ("One", "a b"), ("Three", "c")]


def test_numbered(spark):
    rows = chunk.numbered(spark.range(500).select(F.col("id").alias("a"), (-F.col("id")).alias("b")), ["b"], "i").collect()
    assert {r.i: r.a for r in rows} == {i: 499 - i for i in range(500)}


def test_register_search(spark):
    field = "array<struct<name:string,description:string>>"
    regs = spark.createDataFrame([(i, "MODA" if i % 2 else "MODB", f"R_{i}", None, "s", [("EN", "turns it on")]) for i in range(60)], f"record_id long, module string, register_name string, address string, section_id string, bit_fields {field}")
    regs = regs.withColumn("description", F.lit("Desc"))
    secs = spark.createDataFrame([("s", "old", 1), ("s", "new", 2)], "section_id string, text string, section_row long")
    asked = spark.createDataFrame([(1, " TURNS it ", ""), (2, "r_7 desc en", "moda"), (3, "r_8", "moda"), (4, "%", ""), (5, "", "")], "qid long, query string, module string")
    got = search.search_registers(regs, secs, asked).collect()
    assert {(r.qid, r.n_found) for r in got} == {(1, 60), (2, 1)} and len(got) == 51 and {r.related_section for r in got} == {"new"}
    assert regs.select(haystack(F.col("register_name"), F.col("description"), F.col("bit_fields"))).first()[0] == "r_0 desc en turns it on"


def test_search_prose(spark):
    docs = spark.createDataFrame([(1, "water pump", "left"), (2, "pump and wheel and pump", "right"), (3, "wheel", "left"), (4, None, None)], "doc_id long, text string, module string")
    asked = spark.createDataFrame([(1, "pump", None), (2, "pump", " LEFT "), (3, "wheel", "")], "qid long, query string, module string")
    dense = spark.createDataFrame([(1, 3, 0.9, 1), (1, 1, 0.8, 2)], "qid long, doc_id long, score double, rank int")
    got = rank.search_prose(docs, "doc_id", "text", asked, dense, module="module").collect()
    assert sorted((r.qid, r.place, r.doc_id, r.note) for r in got) == [
        (1, 1, 1, "hybrid"), (1, 2, 3, "hybrid"), (1, 3, 2, "hybrid"), (2, 1, 1, "lexical only"), (3, 1, 3, "lexical only"), (3, 2, 2, "lexical only"),
    ]
    alone = rank.search_prose(docs, "doc_id", "text", asked, None, module="module", fusion="relative", top_k=1, scorer=F.col("doc_id").cast("double")).collect()
    assert sorted((r.qid, r.doc_id, r.note) for r in alone) == [(1, 2, "lexical only"), (2, 1, "lexical only"), (3, 3, "lexical only")]
    assert rank.search_prose(docs.where("false"), "doc_id", "text", asked).isEmpty()


def test_query_blocks_are_whole(spark, monkeypatch):
    monkeypatch.setattr(rank, "QUERY_BLOCK", 3)
    monkeypatch.setattr(search, "NEEDLE_BLOCK", 2)
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)], "k long, v array<float>")
    got = rank.dense_topk(vectors, "k", "v", spark.createDataFrame([(i, [1.0, float(i)]) for i in range(10)], "qid long, vector array<float>"), n=2).collect()
    assert sorted((r.qid, r.rank, r.k) for r in got) == [(q, r, 20 - r) for q in range(10) for r in (1, 2)]
    hays = spark.createDataFrame([(i, f"n{i} n{i + 1}") for i in range(9)], "k long, h string")
    met = search.containing(hays, "k", F.col("h"), spark.createDataFrame([(f"n{i}",) for i in range(10)], "w string"), "w").collect()
    assert sorted(tuple(r) for r in met) == sorted((i, f"n{j}") for i in range(9) for j in (i, i + 1))
