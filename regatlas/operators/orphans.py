"""References to records that do not exist, by key bitmaps per key range and period."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from ..functions.lookalike import blank
from ..session import cut

# Keys to a key range; Spark's bitmap functions hold as many bits.
RANGE_KEYS = 32768
NO_PERIOD = -1
#: Parts that a key's records are dealt into where they meet what is known of the key.
SALTS = 16


def _salted(rows: DataFrame, few: DataFrame, on: list[str], how: str) -> DataFrame:
    """``rows`` joined with ``few``, which has one row for each ``on``; a key that holds a third of all rows goes to SALTS tasks."""
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int"))
    spread = few.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    return dealt.join(spread, [*on, "_salt"], how).drop("_salt")


def _month(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts) - 1


@F.pandas_udf(T.BinaryType())
def _squeeze(bits: pd.Series) -> pd.Series:
    """Deflate bitmaps: most are sparse."""
    return bits.map(lambda b: None if b is None else zlib.compress(bytes(b), 1))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _and_not(refs: pd.Series, parents: pd.Series) -> pd.Series:
    """Positions set in ``refs`` and not in ``parents``."""

    def one(r: bytes, p: bytes | None) -> np.ndarray:
        left = np.frombuffer(zlib.decompress(r), np.uint8)
        if p is not None:
            left = left & ~np.frombuffer(zlib.decompress(p), np.uint8)
        return np.flatnonzero(np.unpackbits(left, bitorder="little")).astype(np.int32)

    return pd.Series([one(r, p) for r, p in zip(refs, parents)])


def encode_keys(rows: DataFrame, key: str, ranges: int) -> DataFrame:
    """Give every distinct ``key`` a dense integer within one of ``ranges`` key ranges.

    Adds ``key_range`` and ``code`` (0-based). ``rows`` must already be reduced to few rows a key.
    """
    rows = rows.withColumn("key_range", F.pmod(F.xxhash64(key), F.lit(ranges)).cast("int"))
    order = W.Window.partitionBy("key_range").orderBy(key)
    return rows.withColumn("code", (F.dense_rank().over(order) - 1).cast("long"))


def _bitmaps(rows: DataFrame, name: str) -> DataFrame:
    part = rows.select(
        "key_range", "period",
        F.floor(F.col("code") / RANGE_KEYS).alias("block"),
        F.pmod("code", F.lit(RANGE_KEYS)).alias("bit"),
    )
    packed = part.groupBy("key_range", "block", "period").agg(F.bitmap_construct_agg("bit").alias(name))
    return packed.withColumn(name, _squeeze(name))


def unresolved_keys(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """``(key, period)`` pairs whose key isn't alive during the whole period.

    ``refs(key, period)`` are distinct; ``parents(key, first, last)`` give the periods that a parent row
    covers from their first to their last instant, ``last`` null for ever. Bitmaps of the references and
    of the covering parents are built for each key range and period; reference AND NOT parent survives.
    """
    span = refs.agg(F.min(F.when(F.col("period") >= 0, F.col("period"))), F.max("period"), F.approx_count_distinct("key")).first()
    lo, hi, n_refs = span[0] or 0, span[1] if span[1] is not None else -1, span[2]
    n_keys = n_refs + parents.agg(F.approx_count_distinct("key")).first()[0]
    ranges = max(1, -(-n_keys // RANGE_KEYS))
    clipped = parents.select(
        "key", F.greatest("first", F.lit(lo)).alias("first"), F.least(F.coalesce("last", F.lit(hi)), F.lit(hi)).alias("last")
    ).where("first <= last")
    both = refs.select("key", "period", F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last")).unionByName(
        clipped.distinct().select("key", F.lit(None).cast("int").alias("period"), "first", "last")
    )
    coded = cut(encode_keys(both, "key", ranges))
    ref_bits = _bitmaps(coded.where("first is null"), "ref_bits")
    alive = coded.where("first is not null").select("key_range", "code", F.explode(F.sequence("first", "last")).alias("period"))
    parent_bits = _bitmaps(alive, "parent_bits")
    left = (
        ref_bits.join(parent_bits, ["key_range", "block", "period"], "left")
        .select("key_range", "block", "period", F.explode(_and_not("ref_bits", "parent_bits")).alias("bit"))
        .select("key_range", "period", (F.col("block") * RANGE_KEYS + F.col("bit")).alias("code"))
    )
    names = coded.where("first is null").select("key_range", "code", "period", "key")
    return left.join(names, ["key_range", "code", "period"]).select("key", "period")


def orphan_references(
    records: DataFrame, parents: DataFrame, *, record_id: str, key: str, at: str, created: str = "created_at", deleted: str = "deleted_at"
) -> DataFrame:
    """Records whose ``key`` names no parent row that is alive at the record's time ``at``.

    Returns distinct ``(record_id, key, at, reason)`` under those names: ``missing`` when no parent row has
    the key, ``late`` when all of them are created later, else ``deleted``.

    Nulls: a null or blank key is no reference; a record without a time never finds a living parent
    (``missing`` or ``deleted``); a parent row without ``created`` exists but never lives; null ``deleted``
    means alive for ever. Repeated rows count once. Empty tables give an empty result, an empty parent
    table makes every reference ``missing``. Further columns on either side are ignored.

    Scale: references shrink to distinct (key, month) for the bitmaps, which settle all whose parent covers the month. Only
    the rest meets parent rows: their distinct instants by key and day, with running counts instead of pairs. Where records
    themselves are joined, those of one key are dealt into SALTS parts, so a key that holds a third of all rows has no task
    of its own.
    """
    rec = records.select(F.col(record_id).alias("rid"), F.col(key).alias("key"), F.col(at).alias("at")).where(~blank(F.col("key")))
    rec = rec.withColumn("period", F.coalesce(_month(F.col("at")), F.lit(NO_PERIOD)))
    par = parents.select(F.col(key).alias("key"), F.col(created).alias("c"), F.col(deleted).alias("d")).where(~blank(F.col("key")))
    lives = par.where("c is not null and (d is null or d > c)")
    covering = lives.select("key", (_month(F.col("c")) + 1).alias("first"), (_month(F.col("d")) - 1).alias("last"))
    # one row a key and first month is enough: the one that lives longest
    covering = covering.groupBy("key", "first").agg(F.when(F.count("last") == F.count(F.lit(1)), F.max("last")).alias("last"))
    open_pairs = unresolved_keys(rec.select("key", "period").distinct(), covering)

    cand = cut(_salted(rec, open_pairs, ["key", "period"], "left_semi").distinct())
    keys = cand.select("key").distinct()
    first_seen = par.groupBy("key").agg(F.min("c").alias("first_c")).join(keys, "key", "left_semi").withColumn("known", F.lit(True))

    # rows alive at an instant = running sum of creations and deletions, split by day
    events = (
        lives.join(keys, "key", "left_semi")
        .select("key", F.explode(F.array(F.struct(F.col("c").alias("t"), F.lit(1).alias("n")), F.struct(F.col("d").alias("t"), F.lit(-1).alias("n")))).alias("e"))
        .select("key", "e.t", "e.n")
        .where("t is not null")
        .groupBy("key", "t")
        .agg(F.sum("n").alias("n"))
    )
    asked = cand.where("at is not null").select("key", F.col("at").alias("t")).distinct()
    day = F.to_date("t")
    daily = (
        events.groupBy("key", day.alias("day")).agg(F.sum("n").alias("net"))
        .unionByName(asked.select("key", day.alias("day"), F.lit(0).cast("long").alias("net")).distinct())
        .groupBy("key", "day").agg(F.sum("net").alias("net"))
    )
    before = W.Window.partitionBy("key").orderBy("day").rowsBetween(W.Window.unboundedPreceding, -1)
    base = daily.select("key", "day", F.coalesce(F.sum("net").over(before), F.lit(0)).alias("base"))
    stream = events.select("key", "t", "n", F.lit(False).alias("q")).unionByName(asked.select("key", "t", F.lit(0).cast("long").alias("n"), F.lit(True).alias("q")))
    within = W.Window.partitionBy("key", "day").orderBy("t").rangeBetween(W.Window.unboundedPreceding, W.Window.currentRow)
    running = stream.withColumn("day", day).withColumn("n", F.sum("n").over(within)).where("q")
    alive = running.join(base, ["key", "day"]).where("base + n > 0").select("key", F.col("t").alias("at"))

    lost = _salted(_salted(cand, alive.distinct(), ["key", "at"], "left_anti"), first_seen, ["key"], "left")
    reason = F.when(F.col("known").isNull(), "missing").when(F.col("first_c") > F.col("at"), "late").otherwise("deleted")
    return lost.select(F.col("rid").alias(record_id), F.col("key").alias(key), F.col("at").alias(at), reason.alias("reason")).distinct()


def orphan_report(orphans: DataFrame, records: DataFrame, *, record_id: str, at: str, by: str) -> DataFrame:
    """Number of failing records per ``by``, month of ``at`` and reason."""
    kinds = records.select(record_id, by).distinct()
    return (
        orphans.join(kinds, record_id)
        .groupBy(by, F.date_format(at, "yyyy-MM").alias("month"), "reason")
        .agg(F.count_distinct(record_id).alias("n_records"))
    )
