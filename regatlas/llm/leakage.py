"""Evaluation passages leaking into training text, by a prefix-filtered set join of word shingles."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from ..session import cut

#: Words in a run; shingles of the items up to which they are broadcast.
RUN = 6
BROADCAST_SHINGLES = 2_000_000
_WORDS = re.compile(r"\w+")


def words(text: Column) -> Column:
    """Runs of letters, digits and underscores, without letter case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]+)"), 1)


def shingles(df: DataFrame, n: int) -> DataFrame:
    """One row for each run of ``n`` words: ``at`` (from 0) and its 64-bit hash ``h``. Needs a column ``words``."""
    many = F.when(F.size("words") >= n, F.transform(F.sequence(F.lit(1), F.size("words") - (n - 1)), lambda i: F.xxhash64(F.slice("words", i, n))))
    return df.select("*", F.posexplode(many).alias("at", "h")).drop("words")


def _covered(item: list[str], text: str, n: int) -> int:
    """Words of ``item`` in runs of ``n`` or more words that ``text`` holds too, word by word."""
    own = [" ".join(item[i : i + n]) for i in range(len(item) - n + 1)]
    wanted = set(own)
    doc = _WORDS.findall(text.lower())
    held = {s for i in range(len(doc) - n + 1) if (s := " ".join(doc[i : i + n])) in wanted}
    marks = [False] * len(item)
    for i, s in enumerate(own):
        if s in held:
            marks[i : i + n] = [True] * n
    return sum(marks)


def leaked_items(items: DataFrame, documents: DataFrame, run: int = RUN, share: float = 0.5) -> DataFrame:
    """``(item_id, doc_id, n_words, covered)``: at least ``share`` of the item's words lie in runs of ``run`` or more
    consecutive words that the document holds too.

    Null and empty texts, and items of fewer than ``run`` words, never leak. Repeated rows count once; where an id has
    several texts, each counts. Empty tables give an empty result.

    The item's shingles are ordered by rarity in the corpus. To cover ``share`` of n words takes at least
    k = ceil(share * n / run) shingles, so every leak meets one of the S - k + 1 rarest: only these are joined for
    candidates. A length bound (the document's words) and a positional bound (distinct item positions met) prune them,
    and the rest is verified word by word. Corpus shingles are dropped in the map stage unless an item has them; the
    items' shingles are broadcast only when counted to be at most BROADCAST_SHINGLES, else joined by shuffle.
    """
    gold = items.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") >= run).distinct()
    gold = cut(gold.withColumn("n_words", F.size("words")).withColumn("item_key", F.xxhash64("item_id", "words")))
    grams = cut(shingles(gold.select("item_key", "n_words", "words"), run))
    wanted = grams.select("h").distinct()
    if grams.count() <= BROADCAST_SHINGLES:
        wanted = F.broadcast(wanted)
    texts = documents.select("doc_id", "text").where("text <> ''")
    doc_words = texts.select("doc_id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("words"))
    met = shingles(doc_words.withColumn("doc_words", F.size("words")), run).select("doc_id", "text_key", "doc_words", "h")
    met = cut(met.join(wanted, "h", "left_semi").distinct())

    rarity = met.groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    rank = W.Window.partitionBy("item_key").orderBy("df", "h", "at")
    ordered = (
        grams.join(rarity, "h")
        .withColumn("rank", F.row_number().over(rank))
        .withColumn("have", F.count(F.lit(1)).over(W.Window.partitionBy("item_key")))
        .withColumn("need", F.ceil(F.col("n_words") * share / run))
    )
    prefix = ordered.where("rank <= have - need + 1").select("item_key", "n_words", "need", "h")
    pairs = prefix.join(met, "h").where(F.col("doc_words") >= run).select("item_key", "doc_id", "text_key").distinct()
    positions = grams.join(pairs, "item_key").join(met.select("doc_id", "text_key", "h"), ["doc_id", "text_key", "h"])
    reach = positions.groupBy("item_key", "doc_id", "text_key", "n_words").agg(F.collect_set("at").alias("starts"))
    cover = F.size(F.array_distinct(F.flatten(F.transform("starts", lambda p: F.sequence(p, p + (run - 1))))))
    near = reach.where(cover >= F.col("n_words") * share).select("item_key", "doc_id", "text_key", "n_words")

    @F.pandas_udf(T.IntegerType())
    def covered(item: pd.Series, text: pd.Series) -> pd.Series:
        return pd.Series([_covered(list(i), t, run) for i, t in zip(item, text)], dtype="int32")

    keyed = texts.withColumn("text_key", F.xxhash64("text"))
    sure = near.join(gold.select("item_key", "item_id", "words"), "item_key").join(keyed, ["doc_id", "text_key"])
    checked = sure.select("item_id", "doc_id", "n_words", covered("words", "text").alias("covered"))
    return checked.where(F.col("covered") >= F.col("n_words") * share).groupBy("item_id", "doc_id").agg(F.max("n_words").alias("n_words"), F.max("covered").alias("covered"))


def leakage_report(leaks: DataFrame) -> DataFrame:
    """Documents that leak each item."""
    return leaks.groupBy("item_id").agg(F.count_distinct("doc_id").alias("n_documents"), F.max(F.col("covered") / F.col("n_words")).alias("most"))
