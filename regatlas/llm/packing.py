"""Filling fixed-capacity containers with items: bulk-synchronous best fit."""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.chunk import numbered
from ..session import cut

#: Items and gaps of one budget that one sweep takes, and the most budgets that one job packs for.
STRIPE, MOST_BUDGETS = 50_000, 1000


def token_counts(texts: DataFrame, column: str, vocabulary: str | None = None) -> DataFrame:
    """``texts`` with ``tokens``: the length of ``column`` in tokens of a public byte-level BPE.

    ``vocabulary`` is the path of its ranks on every executor; by default the installed public one.
    """

    @F.pandas_udf(T.IntegerType())
    def count(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import public_tokenizers
        import tiktoken

        with open(vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")) as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, f)}
        encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        for column in it:
            yield column.map(lambda t: len(encoding.encode_ordinary(t)), na_action="ignore").astype("Int32")

    return texts.withColumn("tokens", count(column))


def split_items(items: DataFrame, capacities: list[tuple[int, int]]) -> DataFrame:
    """``items(..., size)`` once for each of ``capacities`` (budget, capacity): ``budget_id, capacity, piece`` and the piece's
    ``size``; an item is cut only where it exceeds the capacity."""
    budgets = F.array(*[F.struct(F.lit(b).cast("int").alias("budget_id"), F.lit(c).cast("int").alias("capacity")) for b, c in capacities])
    each = items.withColumn("_budget", F.explode(budgets)).select("*", "_budget.*").drop("_budget")
    pieces = each.withColumn("piece", F.explode(F.sequence(F.lit(0), F.ceil(F.col("size") / F.col("capacity")).cast("int") - 1)))
    return pieces.withColumn("size", F.least("capacity", F.col("size") - F.col("piece") * F.col("capacity")).cast("int"))


def best_fit(sizes: list[int], gaps: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Sweep over ``sizes``, which fall: each takes its successor among the gaps, the smallest that holds it, or a new container.

    Containers are numbered: first those of ``gaps``, then new ones. Returns the container of each size and all gaps left.
    """
    free: dict[int, list[int]] = {}  # containers by their gap
    for at, gap in enumerate(gaps):
        free.setdefault(gap, []).append(at)
    order, left, out = sorted(free), list(gaps), []
    for size in sizes:
        i = bisect.bisect_left(order, size)
        if i < len(order):
            gap = order[i]
            at = free[gap].pop()
            if not free[gap]:
                del free[gap]
                order.pop(i)
        else:
            gap, at = capacity, len(left)
            left.append(capacity)
        left[at] = rest = gap - size
        if rest:
            if rest in free:
                free[rest].append(at)
            else:
                free[rest] = [at]
                bisect.insort(order, rest)
        out.append(at)
    return out, left


def _sweep(names: list[str], round_no: int):  # noqa: ANN202
    """Sweep of one stripe. Items of a new container that is at least half empty are given back, unless ``last``."""

    def sweep(rows: pa.Table) -> pa.Table:
        budget, capacity, stripe, last = (rows.column(c)[0].as_py() for c in ("budget_id", "capacity", "stripe", "last"))
        rows = rows.sort_by([("size", "descending"), ("number", "ascending")])
        gaps, items = rows.filter(pc.field("kind") == 0), rows.filter(pc.field("kind") == 1)
        at, left = best_fit(items.column("size").to_pylist(), gaps.column("size").to_pylist(), capacity)
        ids = gaps.column("container").to_pylist() + [f"{round_no}.{stripe}.{i}" for i in range(len(left) - len(gaps))]
        again = set() if last else {i for i in range(len(gaps), len(left)) if 2 * left[i] >= capacity}
        placed = items.set_column(items.schema.get_field_index("container"), "container", pa.array([None if i in again else ids[i] for i in at], pa.string()))
        open_ = [i for i, gap in enumerate(left) if gap and i not in again]
        known = {"budget_id": [budget] * len(open_), "capacity": [capacity] * len(open_), "kind": [0] * len(open_), "size": [left[i] for i in open_], "container": [ids[i] for i in open_]}
        rest = pa.table({c: pa.array(known[c], placed.schema.field(c).type) if c in known else pa.nulls(len(open_), placed.schema.field(c).type) for c in names})
        return pa.concat_tables([placed.select(names), rest])

    return sweep


def pack(pieces: DataFrame) -> DataFrame:
    """``pieces(budget_id, capacity, size, ...)``, 0 < size <= capacity, with the ``container`` of each.

    Every piece is placed exactly once and no container exceeds its capacity. In each superstep the open items and gaps of a
    budget are sorted by size over range partitions and dealt by rank into stripes of at most STRIPE elements, so that each
    stripe has the same mixture; all stripes are swept at once: larger items go first, each takes its successor among the
    stripe's gaps, and of two that want one gap the one of higher rank has it; gaps are updated in place, and where none
    holds the item a container opens. Then each stripe gives back the items of its containers that stayed half empty, and the
    next superstep packs these with the gaps of all stripes, over at most half as many stripes, until one is left. One stripe
    is plain best-fit decreasing. Nothing but the number of elements per budget reaches the driver. An empty input gives an
    empty result.
    """
    own = [c for c in pieces.columns if c not in ("budget_id", "capacity", "size")]
    names = ["budget_id", "capacity", "kind", "size", "container", *own]
    kind = {f.name: f.dataType.simpleString() for f in pieces.schema} | {"kind": "int", "container": "string"}
    schema = ", ".join(f"`{c}` {kind[c]}" for c in names)
    whole = F.col("size") >= F.col("capacity")
    out = pieces.where(whole).withColumn("container", F.concat_ws(".", F.lit("whole"), *[F.col(c).cast("string") for c in own])).select("budget_id", "size", "container", *own)
    elements = pieces.where(~whole).withColumn("kind", F.lit(1)).withColumn("container", F.lit(None).cast("string")).select(*names)
    most: dict[int, int] = {}
    round_no = 0
    while True:
        stripes = {r.budget_id: -(-r.n // STRIPE) for r in elements.groupBy("budget_id").agg(F.count(F.lit(1)).alias("n"), F.sum("kind").alias("items")).collect() if r["items"]}
        if not stripes:
            return out
        stripes = {b: max(1, min(n, most.get(b, n))) for b, n in stripes.items()}
        many, last = _by_budget(stripes), _by_budget({b: int(n == 1) for b, n in stripes.items()}) == 1
        ranked = numbered(elements.where(F.col("budget_id").isin(list(stripes))), ["budget_id", "kind", "size", *own], "number")
        dealt = ranked.withColumn("stripe", F.pmod("number", many).cast("int")).withColumn("last", last)
        met = cut(dealt.groupBy("budget_id", "stripe").applyInArrow(_sweep(names, round_no), schema))
        out = out.unionByName(met.where("kind = 1 AND container IS NOT NULL").select("budget_id", "size", "container", *own))
        again = met.where("kind = 1 AND container IS NULL")
        least = again.groupBy("budget_id").agg(F.min("size").alias("least"))
        elements = again.unionByName(met.where("kind = 0").join(least, "budget_id").where("size >= least").select(*names))
        most, round_no = {b: n // 2 for b, n in stripes.items()}, round_no + 1


def _by_budget(values: dict[int, int]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("budget_id")]


def pack_documents(documents: DataFrame, budgets: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``(budget_id, container, doc_id, text_key, piece, size)``: every non-empty text in containers of each budget.

    Repeated rows count once; two texts under one ``doc_id`` are two items (``text_key`` tells them apart); null and empty
    texts hold no token. A null or non-positive capacity is no budget; more than MOST_BUDGETS budgets are refused. Empty
    tables give an empty result. Texts are sized where they are read; only their keys and sizes are shuffled.
    """
    caps = budgets.where("capacity > 0 AND budget_id IS NOT NULL").groupBy("budget_id").agg(F.min("capacity").alias("capacity")).orderBy("budget_id").limit(MOST_BUDGETS + 1).collect()
    if len(caps) > MOST_BUDGETS:
        raise ValueError(f"more than {MOST_BUDGETS} budgets")
    if not caps:
        caps = [(0, 1)]
        documents = documents.where("false")
    sized = token_counts(documents.select("doc_id", "text").where("text <> ''"), "text", vocabulary).where("tokens > 0")
    items = cut(sized.select("doc_id", F.xxhash64("text").alias("text_key"), F.col("tokens").alias("size")).distinct())
    packed = pack(split_items(items, [tuple(c) for c in caps]))
    return packed.select("budget_id", "container", "doc_id", "text_key", "piece", "size")


def packing_report(assignment: DataFrame, budgets: DataFrame) -> DataFrame:
    """Containers, pieces, tokens and the share of unused space for each budget."""
    full = assignment.groupBy("budget_id", "container").agg(F.count(F.lit(1)).alias("pieces"), F.sum("size").alias("used"))
    sums = full.groupBy("budget_id").agg(F.count(F.lit(1)).alias("containers"), F.sum("pieces").alias("pieces"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"))
    return sums.join(budgets.select("budget_id", "capacity").distinct(), "budget_id").withColumn("unused", 1 - F.col("tokens") / (F.col("containers") * F.col("capacity")))


def packing_faults(assignment: DataFrame, budgets: DataFrame) -> DataFrame:
    """``(budget_id, texts, overfull, cut_needlessly, repeated)``: texts placed, containers above their capacity, texts in several
    pieces that would fit one container, pieces placed twice."""
    caps = budgets.select("budget_id", "capacity").distinct()
    full = assignment.groupBy("budget_id", "container").agg(F.sum("size").alias("used")).join(caps, "budget_id")
    over = full.groupBy("budget_id").agg(F.count_if(F.col("used") > F.col("capacity")).alias("overfull"))
    whole = assignment.groupBy("budget_id", "doc_id", "text_key").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.count_distinct("piece").alias("pieces")).join(caps, "budget_id")
    texts = whole.groupBy("budget_id").agg(
        F.count(F.lit(1)).alias("texts"), F.count_if((F.col("n") > 1) & (F.col("size") <= F.col("capacity"))).alias("cut_needlessly"), F.sum(F.col("n") - F.col("pieces")).alias("repeated")
    )
    return texts.join(over, "budget_id").select("budget_id", "texts", "overfull", "cut_needlessly", "repeated")
