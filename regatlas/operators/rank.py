"""Lexical, dense and fused rankings for batches of queries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..functions.text import tokenize
from ..session import cut

# BM25 and fusion constants, length of each list, pool.
K1, B, RRF_K, LIST, POOL, TOP = 1.5, 0.75, 60, 60, 30, 5
# End of fixed values.
#: Query vectors to a block; terms of all queries up to which they are broadcast.
QUERY_BLOCK, BROADCAST_TERMS = 2048, 500_000


def postings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(term, key, tf)``."""
    return docs.select(key, F.explode(tokenize(F.col(text))).alias("term")).groupBy("term", key).agg(F.count(F.lit(1)).alias("tf"))


def term_stats(posts: DataFrame, n_docs: int) -> DataFrame:
    """``(term, df, idf)``."""
    stats = posts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return stats.withColumn("idf", F.log(1 + (F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5)))


def _top(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    ranked = rows.withColumn("rank", F.row_number().over(W.Window.partitionBy("qid").orderBy(*order)))
    return ranked.where(F.col("rank") <= n)


def bm25_topk(docs: DataFrame, key: str, text: str, queries: DataFrame, n: int = LIST) -> DataFrame:
    """``(qid, key, score, rank)`` of the best ``n`` documents of each of ``queries(qid, query)``; only scores above 0.

    A repeated query term counts repeatedly. Ties go to the lower key; ``key`` is unique in ``docs``. Documents are tokenised
    once; only postings of query terms leave the stage that reads them, as long as these are BROADCAST_TERMS at most.
    """
    asked = cut(queries.select("qid", F.explode(tokenize(F.col("query"))).alias("term")).groupBy("qid", "term").agg(F.count(F.lit(1)).alias("qtf")))
    wanted = asked.select("term").distinct()
    tokens = docs.select(key, tokenize(F.col(text)).alias("terms"))
    rows = tokens.select(key, F.size("terms").alias("dl"), F.explode_outer("terms").alias("term"))
    asked_terms = F.broadcast(wanted) if wanted.count() <= BROADCAST_TERMS else wanted
    # a term of no query is dropped where its document is read; each document keeps one row for its length
    kept = rows.join(asked_terms.withColumn("asked", F.lit(True)), "term", "left").groupBy(key, F.when(F.col("asked"), F.col("term")).alias("term")).agg(F.count(F.lit(1)).alias("tf"), F.max("dl").alias("dl"))
    kept = cut(kept)
    sizes = kept.groupBy(key).agg(F.max("dl").alias("dl")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.greatest("dl", F.lit(0))).alias("tokens")).first()
    n_docs, n_tokens = sizes.n, sizes.tokens or 0
    avgdl = n_tokens / n_docs if n_docs else 0.0
    posts = kept.where("term IS NOT NULL")
    met = posts.join(term_stats(posts, n_docs), "term").join(asked, "term")
    base = K1 * (1 - B + B * F.col("dl") / avgdl) if avgdl else F.lit(K1)
    part = F.col("qtf") * F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + base)
    scored = met.groupBy("qid", key).agg(F.round(F.sum(part), 9).alias("score")).where("score > 0")
    return _top(scored, n, F.desc("score"), F.asc(key))


def dense_topk(vectors: DataFrame, key: str, vector: str, queries: DataFrame, n: int = LIST) -> DataFrame:
    """``(qid, key, score, rank)`` of the ``n`` vectors with the largest dot product with each of ``queries(qid, vector)``.

    Queries go in blocks of about QUERY_BLOCK, one after the other, against all rows as matrix products; each task keeps its
    best ``n`` a query, so the shuffle holds tasks x queries x n rows at most. Ties go to the lower key.
    """
    total = queries.count()
    blocks = max(1, -(-total // QUERY_BLOCK))
    slot = F.pmod(F.xxhash64("qid"), F.lit(blocks))
    out = None
    for b in range(blocks):
        rows = queries.where(slot == b).select("qid", "vector").collect()  # one block of at most about QUERY_BLOCK vectors
        if not rows:
            continue
        ids, matrix = np.array([r.qid for r in rows]), np.array([r.vector for r in rows], np.float64)

        def best(batches: Iterator[pd.DataFrame], ids: np.ndarray = ids, matrix: np.ndarray = matrix) -> Iterator[pd.DataFrame]:
            keep_s, keep_k = np.empty((len(ids), 0)), np.empty((len(ids), 0), np.int64)
            for df in batches:
                if not len(df):
                    continue
                s = np.round(matrix @ np.stack(df["v"].to_numpy()).astype(np.float64).T, 9)
                s, k = np.hstack([keep_s, s]), np.hstack([keep_k, np.broadcast_to(df["k"].to_numpy(), (len(ids), len(df)))])
                order = np.lexsort((k, -s), axis=1)[:, :n]
                keep_s, keep_k = np.take_along_axis(s, order, 1), np.take_along_axis(k, order, 1)
            m = keep_s.shape[1]
            yield pd.DataFrame({"qid": np.repeat(ids, m), key: keep_k.ravel(), "score": keep_s.ravel()})

        part = vectors.select(F.col(key).alias("k"), F.col(vector).alias("v")).where("v IS NOT NULL").mapInPandas(best, f"qid long, {key} long, score double")
        part = cut(part) if blocks > 1 else part  # so that the driver holds one block at a time
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = vectors.sparkSession.createDataFrame([], f"qid long, {key} long, score double")
    return _top(out, n, F.desc("score"), F.asc(key))


def _bonus(best: Column, rank1: float, rank2_3: float) -> Column:
    return F.when(best == 1, F.lit(rank1)).when(best <= 3, F.lit(rank2_3)).otherwise(F.lit(0.0))


def _ordered(fused: DataFrame, key: str) -> DataFrame:
    order = W.Window.partitionBy("qid").orderBy(F.desc("fused"), F.asc_nulls_last("dense_rank"), F.asc_nulls_last("bm25_rank"), F.asc(key))
    return fused.withColumn("rank", F.row_number().over(order))


def _both(dense: DataFrame, lexical: DataFrame, key: str) -> DataFrame:
    named = lambda df, name: df.select("qid", key, F.col("rank").alias(f"{name}_rank"), F.col("score").alias(f"{name}_score"))
    both = named(dense, "dense").withColumns({"bm25_rank": F.lit(None).cast("int"), "bm25_score": F.lit(None).cast("double")}).unionByName(
        named(lexical, "bm25").withColumns({"dense_rank": F.lit(None).cast("int"), "dense_score": F.lit(None).cast("double")})
    )
    return both.groupBy("qid", key).agg(*[F.max(c).alias(c) for c in ("dense_rank", "bm25_rank", "dense_score", "bm25_score")])


def rrf(dense: DataFrame, lexical: DataFrame, key: str, rank1: float = 0.0, rank2_3: float = 0.0) -> DataFrame:
    """``(qid, key, fused, rank, ...)`` by reciprocal ranks, with an optional bonus for the best rank, added once."""
    met = _both(dense, lexical, key)
    part = lambda c: F.coalesce(1 / (RRF_K + F.col(c)), F.lit(0.0))
    best = F.least("dense_rank", "bm25_rank")
    fused = F.round(part("dense_rank") + part("bm25_rank") + _bonus(best, rank1, rank2_3), 9)
    return _ordered(met.withColumn("fused", fused), key)


def relative_score(dense: DataFrame, lexical: DataFrame, key: str, weight: float = 0.5, rank1: float = 0.0, rank2_3: float = 0.0) -> DataFrame:
    """``(qid, key, fused, rank, ...)`` by scores relative to each list's best; a list whose best isn't above 0 is skipped.

    ``weight`` is the dense list's. Where a query lacks one of the lists, reciprocal ranks are used instead.
    """
    met = _both(dense, lexical, key)
    per_query = W.Window.partitionBy("qid")
    top = lambda c: F.max(c).over(per_query)
    met = met.withColumns({"dense_top": top("dense_score"), "bm25_top": top("bm25_score")})
    part = lambda c, w: F.when(F.col(f"{c}_top") > 0, w * F.coalesce(F.col(f"{c}_score") / F.nullif(F.col(f"{c}_top"), F.lit(0.0)), F.lit(0.0))).otherwise(0.0)
    rank = lambda c: F.when(F.col(f"{c}_top") > 0, F.col(f"{c}_rank"))
    relative = part("dense", weight) + part("bm25", 1 - weight) + F.coalesce(_bonus(F.least(rank("dense"), rank("bm25")), rank1, rank2_3), F.lit(0.0))
    reciprocal = F.coalesce(1 / (RRF_K + F.coalesce("dense_rank", "bm25_rank")), F.lit(0.0)) + _bonus(F.least("dense_rank", "bm25_rank"), rank1, rank2_3)
    lone = F.col("dense_top").isNull() | F.col("bm25_top").isNull()
    listed = F.col("dense_top").isNull() | F.col("bm25_top").isNull() | rank("dense").isNotNull() | rank("bm25").isNotNull()
    return _ordered(met.where(listed).withColumn("fused", F.round(F.when(lone, reciprocal).otherwise(relative), 9)), key).drop("dense_top", "bm25_top")


def pooled(fused: DataFrame, payload: DataFrame, key: str, module: Column | None = None, pool: int = POOL, top_k: int = TOP) -> DataFrame:
    """The first ``top_k`` of the first ``pool`` fused hits that satisfy ``module``, which is tested after fusion."""
    hits = fused.join(payload, key)
    hits = hits.where(module) if module is not None else hits
    order = W.Window.partitionBy("qid").orderBy("rank")
    return hits.withColumn("place", F.row_number().over(order)).where(F.col("place") <= min(pool, max(1, min(50, top_k))))


def reranked(hits: DataFrame, scorer: Column) -> DataFrame:
    """Hits of the pool placed anew by ``scorer``, a model's score as a column; their fusion scores stay."""
    order = W.Window.partitionBy("qid").orderBy(F.desc("model_score"), "place")
    return hits.withColumn("model_score", scorer).withColumn("place", F.row_number().over(order))


def search_prose(
    docs: DataFrame, key: str, text: str, queries: DataFrame, dense: DataFrame | None = None, *, module: str | None = None, fusion: str = "rrf", weight: float = 0.5, bonus: tuple[float, float] = (0.0, 0.0),
    top_k: int = TOP, scorer: Column | None = None,
) -> DataFrame:
    """``(qid, key, place, fused, note)``: hybrid search of ``docs`` for ``queries(qid, query, module)``.

    BM25 and the ``dense`` list (of dense_topk, or none) are fused by reciprocal ranks (``rrf``) or ``relative`` scores; of the
    pool those stay whose column ``module`` contains the query's; ``scorer`` places them anew by a model's score. A query
    without a dense list has its BM25 list alone, and ``note`` says so. Blank modules ask for all.
    """
    lexical = bm25_topk(docs, key, text, queries)
    none = docs.sparkSession.createDataFrame([], "qid long, score double, rank int").withColumn(key, F.lit(None).cast(docs.schema[key].dataType))
    near = none if dense is None else dense
    fused = rrf(near, lexical, key, *bonus) if fusion == "rrf" else relative_score(near, lexical, key, weight, *bonus)
    asked = queries.select("qid", F.lower(F.trim(F.coalesce("module", F.lit("")))).alias("_want"))
    held = F.lower(F.coalesce(F.col(module), F.lit(""))).contains(F.col("_want")) if module else None
    hits = pooled(fused.join(asked, "qid"), docs, key, held, top_k=POOL if scorer is not None else top_k)
    if scorer is not None:
        hits = reranked(hits, scorer).where(F.col("place") <= top_k)
    told = near.select("qid").distinct().withColumn("_dense", F.lit(True))
    note = F.when(F.col("_dense"), "hybrid").otherwise("lexical only")
    return hits.join(told, "qid", "left").select("qid", key, "place", "fused", note.alias("note"))
