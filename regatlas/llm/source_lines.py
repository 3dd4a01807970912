"""Lines repeated across one source's documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normal_line(line: Column) -> Column:
    """A line without digits, letter case and the amount of white space; null when it holds no letter."""
    plain = F.lower(F.regexp_replace(F.regexp_replace(line, r"\p{Nd}+", ""), r"(?U)\s+", " "))
    plain = F.trim(plain)
    return F.when(plain.rlike(r"\p{L}"), plain)


def numbered_lines(blocks: DataFrame) -> DataFrame:
    """``blocks`` with one row a line: ``line_no`` from 1, ``line``, ``norm`` and its hashes, of 64 and of 32 bits."""
    rows = blocks.select("*", F.posexplode(F.split("text", "\n", -1)).alias("line_at", "line")).withColumn("norm", normal_line(F.col("line")))
    return rows.withColumn("line_no", F.col("line_at") + 1).withColumns({"line_hash": F.xxhash64("norm"), "line_check": F.hash("norm")}).drop("line_at")


def is_body(df: DataFrame) -> Column:
    return (F.col("type") == "text") & F.col("text_level").isNull()


KEY = ["source", "line_hash", "line_check"]


def _excessive(blocks: DataFrame, min_documents: int, min_share: float) -> DataFrame:
    """``(source, line_hash, line_check, n_documents)`` of the lines that very many documents of a source hold.

    Only hashes of lines and documents are shuffled, distinct before and after the exchange, so the text of a line never
    moves and a source or line that holds a third of all rows is spread over its documents.
    """
    sizes = blocks.select("source", "doc_file").distinct().groupBy("source").agg(F.count("doc_file").alias("all_documents"))
    lines = numbered_lines(blocks.where(is_body(blocks)).select("source", "doc_file", "text")).where("norm is not null and source is not null and doc_file is not null")
    held = lines.select(*KEY, F.xxhash64("doc_file").alias("doc")).distinct()
    counted = held.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_documents"))
    enough = (F.col("n_documents") >= min_documents) & (F.col("n_documents") >= F.col("all_documents") * min_share)
    return counted.where(F.col("n_documents") >= min_documents).join(sizes, "source").where(enough).select(*KEY, "n_documents")


def excessive_lines(blocks: DataFrame, min_documents: int = 3, min_share: float = 0.1) -> DataFrame:
    """``(source, norm, n_documents)``: lines that body blocks of very many documents of a source hold."""
    lines = numbered_lines(blocks.where(is_body(blocks)).select("source", "text")).where("norm is not null").select(*KEY, "norm")
    return lines.join(_excessive(blocks, min_documents, min_share), KEY).groupBy(*KEY).agg(F.min("norm").alias("norm"), F.max("n_documents").alias("n_documents")).select("source", "norm", "n_documents")


def repeated_lines(blocks: DataFrame, min_documents: int = 3, min_share: float = 0.1) -> DataFrame:
    """``(block_id, line_no, source, line)`` of every excessive line in a body block.

    A null source or document makes a line uncounted; null and empty text hold no line; lines without letters never
    count; repeated rows count once. Lines are told apart by 96 bits of hashes. An empty table gives an empty result.
    """
    often = _excessive(blocks, min_documents, min_share).drop("n_documents")
    lines = numbered_lines(blocks.where(is_body(blocks)).select("block_id", "source", "text")).where("norm is not null")
    return lines.join(often, KEY).select("block_id", "line_no", "source", "line").distinct()


def without_repeated_lines(blocks: DataFrame, min_documents: int = 3, min_share: float = 0.1) -> DataFrame:
    """``(block_id, source, clean_text, removed)``: each body block rebuilt without its excessive lines."""
    often = _excessive(blocks, min_documents, min_share).select(*KEY, F.lit(True).alias("often"))
    lines = numbered_lines(blocks.where(is_body(blocks)).select("block_id", "source", "text").dropDuplicates(["block_id", "source", "text"]))
    lines = lines.join(often, KEY, "left").withColumn("excessive", F.col("norm").isNotNull() & F.coalesce("often", F.lit(False)))
    kept = F.array_sort(F.collect_list(F.when(~F.col("excessive"), F.struct("line_no", "line"))))
    rebuilt = lines.groupBy("block_id", "source").agg(kept.alias("kept"), F.count_if("excessive").alias("removed"))
    return rebuilt.select("block_id", "source", F.array_join(F.transform("kept", lambda x: x["line"]), "\n").alias("clean_text"), "removed")
