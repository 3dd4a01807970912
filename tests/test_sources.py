"""Files and streams: what is written is read again."""

import json

import pytest
from pyspark.errors import AnalysisException
from regatlas.operators.extract import build_kb
from regatlas.sources import files
from regatlas.streaming.arrivals import append_kb, arriving_blocks

STREAM = [{"type": "text", "text": "1 Unit", "text_level": 1, "page_idx": 0}, {"type": "text", "text": "Body text of the unit."}, {"type": "image", "image_caption": ["c"], "img_path": "a/b.png", "extra": 1}]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "deep" / "demo_content_list.json").write_text(json.dumps(STREAM))
    (tmp_path / "in" / "other.json").write_text("[]")
    return tmp_path


def test_block_streams_and_kb(spark, folder):
    blocks = files.read_block_streams(spark, str(folder / "in"))
    rows = blocks.orderBy("pos").collect()
    assert [(r.pos, r.module, r.type) for r in rows] == [(0, "DEMO", "text"), (1, "DEMO", "text"), (2, "DEMO", "image")] and rows[1].page_idx is None
    files.write_kb(build_kb(blocks), str(folder / "kb"))
    kb = files.read_kb(spark, str(folder / "kb"))
    assert kb["sections"].first().text == "Body text of the unit." and kb["registers"].count() == 0 and kb["figures"].first().context == "Body text of the unit."
    files.write_block_stream(blocks, str(folder / "out"))
    assert [b["type"] for b in json.loads(spark.read.text(str(folder / "out")).first()[0])] == ["text", "text", "image"]


def test_missing_kb(spark, tmp_path):
    assert files.read_kb(spark, str(tmp_path / "none"))["enums"].count() == 0
    with pytest.raises(AnalysisException):
        files.read_kb(spark, str(tmp_path / "none"), strict=True)


def test_gold(spark, tmp_path):
    (tmp_path / "q.jsonl").write_text('{"id": "1", "type": "register", "expected": {"register_name": "R_A"}}\n\n{broken\n')
    rows = files.read_gold(spark, str(tmp_path / "q.jsonl")).collect()
    assert [(r.id, r.broken) for r in rows] == [("1", None), (None, "{broken")] and rows[0].expected.register_name == "R_A"


def test_arrivals(spark, folder):
    run = lambda: append_kb(arriving_blocks(spark, str(folder / "in")), str(folder / "kb"), str(folder / "state")).awaitTermination()
    run()
    (folder / "in" / "two_content_list.json").write_text(json.dumps(STREAM))
    run()
    assert {r.module for r in spark.read.parquet(str(folder / "kb" / "sections")).collect()} == {"DEMO", "TWO"}


def test_index_falls_back_to_chunks_alone(spark, tmp_path):
    chunks = spark.createDataFrame([(0, "a"), (1, "b")], "chunk_idx long, embed_text string")
    vectors = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "chunk_idx long, embedding array<float>")
    for name, part, whole in (("none", None, False), ("part", vectors.limit(1), False), ("full", vectors, True)):
        files.write_index(str(tmp_path / name), chunks, part, "m")
        got, held = files.read_index(spark, str(tmp_path / name))
        assert got.count() == 2 and (held is not None) == whole
    assert files.read_index(spark, str(tmp_path / "full"), "other")[1] is None and files.read_index(spark, str(tmp_path / "full"), "m")[1].count() == 2
