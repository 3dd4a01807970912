"""Exact look-up of registers and concepts for batches of keyword queries."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..functions import text as tx
from ..session import cut

CAP = 50
NEEDLE_BLOCK = 50_000


def containing(rows: DataFrame, key: str, hay: Column, needles: DataFrame, needle: str) -> DataFrame:
    """``(key, needle)`` of all rows whose lower-case ``hay`` contains a lower-case ``needle``.

    Needles go in blocks of about NEEDLE_BLOCK, one after the other, into one multi-pattern automaton each, so a row is
    read once a block instead of once a needle.
    """
    distinct = needles.select(F.lower(F.col(needle)).alias("n")).where("n <> ''").distinct()
    blocks = max(1, -(-distinct.count() // NEEDLE_BLOCK))
    kind = rows.schema[key].dataType.simpleString()
    hays = rows.select(key, hay.alias("hay"))
    out = None
    for b in range(blocks):
        words = [r.n for r in distinct.where(F.pmod(F.xxhash64("n"), F.lit(blocks)) == b).collect()]  # one block

        def find(batches: Iterator[pa.RecordBatch], words: list[str] = words) -> Iterator[pa.RecordBatch]:
            import ahocorasick

            trie = ahocorasick.Automaton()
            for w in words:
                trie.add_word(w, w)
            if words:
                trie.make_automaton()
            for batch in batches:
                met = [(k, w) for k, h in zip(*(c.to_pylist() for c in batch.columns)) if h and words for w in {w for _, w in trie.iter(h)}]
                ids = pa.array([k for k, _ in met], batch.schema.field(0).type)
                yield pa.RecordBatch.from_arrays([ids, pa.array([w for _, w in met], pa.string())], [key, "needle"])

        part = hays.mapInArrow(find, f"{key} {kind}, needle string")
        part = cut(part) if blocks > 1 else part  # so that the driver holds one block at a time
        out = part if out is None else out.unionByName(part)
    return out


def _in_module(row_module: str, asked: str) -> Column:
    want = F.lower(F.trim(F.coalesce(F.col(asked), F.lit(""))))
    return (want == "") | F.lower(F.coalesce(F.col(row_module), F.lit(""))).contains(want)


def _hits(rows: DataFrame, key: str, hay: Column, queries: DataFrame) -> DataFrame:
    asked = queries.select("qid", F.lower(F.trim("query")).alias("needle"), F.col("module").alias("asked_module"))
    return containing(rows, key, hay, asked.where("needle <> ''"), "needle").join(asked, "needle").drop("needle")


def search_registers(registers: DataFrame, sections: DataFrame, queries: DataFrame, key: str = "record_id", cap: int = CAP) -> DataFrame:
    """``(qid, place, register..., related_section, n_found)`` for ``queries(qid, query, module)``, at most ``cap`` a query.

    The query is a substring of the register's joined name, description and field texts; the module, if given, a substring
    of the register's. Blank queries find nothing in a batch. ``related_section`` is the text of the last section with
    the register's ``section_id``. ``n_found`` counts before the cap.
    """
    hits = _hits(registers, key, tx.haystack(F.col("register_name"), F.col("description"), F.col("bit_fields")), queries)
    found = hits.join(registers.select(key, "module", "register_name", "address", "section_id"), key).where(_in_module("module", "asked_module")).drop("asked_module").distinct()
    found = cut(found)
    first = found.withColumn("place", F.row_number().over(W.Window.partitionBy("qid").orderBy(key))).where(F.col("place") <= cap)
    placed = first.join(found.groupBy("qid").agg(F.count(F.lit(1)).alias("n_found")), "qid")
    texts = sections.groupBy("section_id").agg(F.max_by("text", "section_row").alias("related_section"))
    return placed.join(texts, "section_id", "left").withColumn("related_section", F.coalesce("related_section", F.lit("")))


def search_concepts(tables: dict[str, tuple[DataFrame, Column]], queries: DataFrame, key: str, capped: tuple[str, ...] = ("sections", "tables"), cap: int = CAP) -> DataFrame:
    """``(qid, kind, key, place)``: hits in each kind of ``tables`` (rows with ``key`` and ``module``, and what to look in)."""
    out = None
    for kind, (rows, hay) in tables.items():
        hits = _hits(rows, key, hay, queries).join(rows.select(key, "module"), key).where(_in_module("module", "asked_module")).select("qid", F.lit(kind).alias("kind"), key).distinct()
        placed = hits.withColumn("place", F.row_number().over(W.Window.partitionBy("qid").orderBy(key)))
        placed = placed.where(F.col("place") <= cap) if kind in capped else placed
        out = placed if out is None else out.unionByName(placed)
    return out
