"""Differences between two copies of data, by content-defined chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lookalike import blank, plain_identifier
from ..session import cut, parallelism

#: Rows in the rolling window, the mask a rolling hash must meet (on average every MASK + 1 rows), and the rows after which a chunk is cut anyway.
WINDOW, MASK, MOST = 2, 1, 1024
_MIX, _LANES = np.uint64(0x9E3779B97F4A7C15), (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def _cuts(side: np.ndarray, keys: np.ndarray, before: int) -> np.ndarray:
    """Which rows, but for the first ``before`` that only fill the window, end a chunk: where the rolling hash of the side's last
    WINDOW keys meets MASK, where the next row is of the other side, and every MOST rows without either."""
    rolling, full = keys.copy(), np.arange(len(keys)) >= WINDOW - 1
    for k in range(1, WINDOW):
        rolling[k:] = rolling[k:] * _MIX + keys[:-k]
        full[k:] &= side[k:] == side[:-k]
    ends = full & (((rolling >> np.uint64(20)) & np.uint64(MASK)) == 0)
    ends[:-1] |= side[:-1] != side[1:]
    ends = ends[before:]
    stops = np.concatenate([[0], np.flatnonzero(ends) + 1, [len(ends)]])
    for k in np.flatnonzero(np.diff(stops) > MOST):
        ends[stops[k] + MOST - 1 : stops[k + 1] : MOST] = True
    return ends


def chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut rows, sorted by side and key, into chunks and give each row its chunk's fingerprint.

    In: ``side, key_hash, row_hash, row_hash_2, ...``. A chunk ends where the hash of the last WINDOW keys meets MASK, so both
    copies are cut at the same places wherever they hold the same keys. The fingerprint has the number of rows and two sums
    of row hashes by their place, 128 bits. Memory: a batch, and one chunk of at most MOST rows.
    """
    held: pa.Table | None = None  # the unfinished chunk
    last, last_side = np.empty(0, np.uint64), np.empty(0, bool)  # the WINDOW - 1 keys before it
    for batch in _with_end(batches):
        rows = held if batch is None else pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if rows is None or not rows.num_rows:
            continue
        side = np.asarray(rows.column("side").to_numpy(zero_copy_only=False) == "l")
        keys = rows.column("key_hash").to_numpy().view(np.uint64)
        ends = _cuts(np.concatenate([last_side, side]), np.concatenate([last, keys]), len(last))
        if batch is None:
            ends[-1] = True
        done = int(np.flatnonzero(ends)[-1]) + 1 if ends.any() else 0
        held = rows.slice(done) if done < rows.num_rows else None
        if not done:
            continue
        last, last_side = (np.concatenate(x)[done + len(last) - WINDOW + 1 :] if done + len(last) >= WINDOW else np.concatenate(x) for x in ((last, keys[:done]), (last_side, side[:done])))
        stops = np.flatnonzero(ends[:done]) + 1
        starts = np.concatenate([[0], stops[:-1]])
        sizes = stops - starts
        place = np.arange(done) - np.repeat(starts, sizes)
        marks = []
        for column, lane in zip(("row_hash", "row_hash_2"), _LANES):
            mixed = (rows.column(column).to_numpy()[:done].view(np.uint64) ^ (place.astype(np.uint64) * _MIX)) * lane
            marks.append(np.add.reduceat(mixed ^ (mixed >> np.uint64(29)), starts))
        names = np.array([f"{n}:{a:016x}{b:016x}" for n, a, b in zip(sizes.tolist(), *(m.tolist() for m in marks))])
        yield from rows.slice(0, done).append_column("chunk", pa.array(np.repeat(names, sizes), pa.string())).combine_chunks().to_batches()


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def copy_differences(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str], *, only_left: str, only_right: str) -> DataFrame:
    """``(*keys, difference)``: keys on one side only, and each field whose value differs between the copies.

    Keys are unique on each side and not null; fields are strings, null equal to null. One row per difference.
    Two empty copies give an empty result.

    Scale: one shuffle by key range of (keys, fields) of both sides together; only chunks whose fingerprint the other
    side lacks are joined row by row, so equal copies cost one sort. Chunks are short, MASK + 1 keys on average, since a chunk
    falls out only as a whole: with a share d of changed keys about (1 - d) ** (MASK + 1) of the rows do.
    """
    spark = left.sparkSession

    def row(side: str, df: DataFrame) -> DataFrame:
        shown = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-")) for c in [*keys, *fields]]
        return df.select(
            F.lit(side).alias("side"), *keys, *fields,
            F.xxhash64(*keys).alias("key_hash"),
            F.xxhash64(*shown).alias("row_hash"), F.conv(F.substring(F.md5(F.concat_ws("\x01", *shown)), 1, 15), 16, 10).cast("long").alias("row_hash_2"),
        )

    both = row("l", left).unionByName(row("r", right))
    parted = both.repartitionByRange(parallelism(spark), *keys).sortWithinPartitions("side", *keys)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in both.schema) + ", chunk string"
    chunks = cut(parted.mapInArrow(chunk_rows, schema).drop("key_hash", "row_hash", "row_hash_2"))
    one, two = chunks.where("side = 'l'").drop("side"), chunks.where("side = 'r'").drop("side")
    rest_one = one.join(two.select("chunk").distinct(), "chunk", "left_anti")
    rest_two = two.join(one.select("chunk").distinct(), "chunk", "left_anti")
    a = rest_one.select(*keys, F.struct(*fields).alias("a"))
    b = rest_two.select(*keys, F.struct(*fields).alias("b"))
    met = a.join(b, keys, "full_outer")
    found = F.when(F.col("b").isNull(), F.array(F.lit(only_left))).when(F.col("a").isNull(), F.array(F.lit(only_right))).otherwise(
        F.filter(F.array(*[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in fields]), lambda x: x.isNotNull())
    )
    return met.select(*keys, F.explode(found).alias("difference"))


def _plain(text: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", ""))


def register_snapshot(registers: DataFrame, tie: str) -> DataFrame:
    """Newest row of each register as ``module, register_name, address, bit_fields`` in comparable form.

    Registers without a name are left out; a null module counts as ''. Rows with equal ``built_at`` are told apart by
    their content and ``tie``; a null ``built_at`` is older than any other. ``bit_fields`` becomes the digest of the
    sorted (name, bit_range, access, reset_value), all without letter case and outer blanks.
    """
    name = plain_identifier(F.col("register_name"))
    member = lambda x, c: F.to_json(F.array(*[_plain(x[k]) for k in c]))
    fields = F.array_sort(F.transform(F.coalesce("bit_fields", F.array()), lambda x: member(x, ("name", "bit_range", "access", "reset_value"))))
    rows = registers.where(~blank(F.col("register_name"))).select(
        F.upper(_plain(F.col("module"))).alias("module"), name.alias("register_name"),
        F.struct(
            F.col("built_at").alias("at"), F.col(tie).alias("tie"), _plain(F.col("address")).alias("address"), F.sha2(F.to_json(fields), 256).alias("bit_fields")
        ).alias("row"),
    )
    newest = rows.where("register_name <> ''").groupBy("module", "register_name").agg(F.max("row").alias("row"))
    return newest.select("module", "register_name", "row.address", "row.bit_fields")


def register_differences(knowledge: DataFrame, other: DataFrame) -> DataFrame:
    """Registers on one side only and registers whose address or bit fields differ, one row a difference."""
    left = register_snapshot(knowledge.where("collection = 'registers'"), "record_id")
    right = register_snapshot(other, "alt_id")
    return copy_differences(left, right, ["module", "register_name"], ["address", "bit_fields"], only_left="only_knowledge", only_right="only_alt")


def difference_report(differences: DataFrame) -> DataFrame:
    """Number of differences per module and kind."""
    return differences.groupBy("module", "difference").agg(F.count(F.lit(1)).alias("n_registers"))
