"""Approximate nearest neighbours by inner product with a permutation index.

A vector is represented by the order in which it ranks the pivots. A block of vectors keeps
one inverted file per pivot: the place that each of its vectors gives that pivot. A query
reads the files in step, adds up how far its own places differ (the footrule distance), and
the RERANK_SHARE of each block nearest by that are ranked anew by the exact inner product.

Vectors and queries meet in cells of one block each, so a task holds BLOCK vectors and
QUERY_BLOCK queries, whatever the tables hold. One more coordinate brings vectors of
different length to one length, so that a large inner product is a small angle.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailflow.llm.shared import shared_table

PIVOTS = 128  # places fit one signed byte
PIVOT_SAMPLE = 1024  # vectors among which pivots are chosen
BLOCK = 4096
QUERY_BLOCK = 1024
RERANK_SHARE = 0.25
TOP = 20


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of vectors that take part, one row per id.

    Null ids, null, empty or zero vectors and those with null or non-finite components take no
    part. Of several rows with one id the least vector counts.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")
    )
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = rows.where(~bad & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def choose_pivots(rows: DataFrame) -> np.ndarray:
    """PIVOTS different vectors at most, from the PIVOT_SAMPLE rows with the least hashed ids."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).collect()
    if not sample:
        return np.zeros((0, 0))
    widths = [len(r.v) for r in sample]
    width = max(set(widths), key=lambda w: (widths.count(w), w))
    seen = dict.fromkeys(tuple(r.v) for r in sample if len(r.v) == width)
    return np.array(list(seen)[:PIVOTS])


def places(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """pivots x vectors: the place of each pivot in each vector's order, as int8."""
    order = np.argsort(-(vectors @ pivots.T), 1, kind="stable")
    out = np.empty(order.shape, np.int8)
    np.put_along_axis(out, order, np.arange(order.shape[1], dtype=np.int8)[None, :].repeat(len(order), 0), 1)
    return np.ascontiguousarray(out.T)


def _longer(vectors: np.ndarray, length: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(length**2 - (vectors**2).sum(1), 0))
    return np.concatenate((vectors, rest[:, None]), 1)


def footrule(files: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Distance of each vector of a block to one query, from the block's inverted files."""
    apart = np.abs(files - own[:, None]).view(np.uint8)
    if len(apart) % 2 == 0:
        apart = apart[0::2] + apart[1::2]  # two places differ by 254 at most
    return apart.sum(0, dtype=np.uint16)


def inner_products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Summed from the first component to the last, so that equal vectors score equally."""
    return np.add.accumulate(rows * query, 1)[:, -1]


def search_block(ids, vectors, query_ids, queries, pivots, length, top=TOP, share=RERANK_SHARE):
    """The nearest `top` of one block for each query: arrays query_id, vec_id, score."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    files = places(_longer(vectors, length), pivots)
    # A query is a direction only: the added coordinate is zero.
    own = places(np.concatenate((queries, np.zeros((len(queries), 1))), 1), pivots)
    n = len(ids)
    count = min(n, max(top, math.ceil(share * n)) + 1)
    out = ([], [], [])
    for i, query_id in enumerate(query_ids):
        key = footrule(files, own[:, i]).astype(np.int64) * n + np.arange(n)  # ties to the smaller id
        near = np.sort(np.argpartition(key, count - 1)[:count])
        near = near[ids[near] != query_id]
        if not len(near):
            continue
        rough = vectors[near] @ queries[i]
        if len(near) > top:
            least = np.partition(rough, len(near) - top)[len(near) - top]
            near = near[rough >= least - 1e-9 * (1 + abs(least))]
        score = inner_products(vectors[near], queries[i])
        best = np.lexsort((ids[near], -score))[:top]
        out[0].append(np.full(len(best), query_id))
        out[1].append(ids[near][best])
        out[2].append(score[best])
    return [np.concatenate(x) if x else np.zeros(0) for x in out]


def nearest(
    vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    top: int = TOP, share: float = RERANK_SHARE,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the `top` found for each query, ties to the smaller id.

    A query does not find rows of its own id. Vectors take part as `usable` says, and only if
    they have the usual number of components; queries that take no part and empty tables give no
    rows. Other columns are ignored.
    """
    rows = shared_table(usable(vectors, id_col, vector_col), "permutation_vectors")
    asked = usable(queries, id_col, vector_col)
    schema = "query_id long, vec_id long, score double"
    pivots = choose_pivots(rows)
    width = pivots.shape[1]
    rows, asked = rows.where(F.size("v") == width), asked.where(F.size("v") == width)
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, length = rows.agg(F.count("*"), F.sqrt(F.max(square))).first()
    n_queries = asked.count() if n else 0
    blocks, query_blocks = max(1, math.ceil(n / BLOCK)), max(1, math.ceil(n_queries / QUERY_BLOCK))
    pivots = _longer(pivots, length or 0.0)

    def deal(df: DataFrame, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        at = F.pmod(F.xxhash64("vec_id"), F.lit(own_n)).cast("int")
        return df.select(
            at.alias(own), F.explode(F.sequence(F.lit(0), F.lit(other_n - 1))).alias(other), "vec_id", "v"
        )

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.zeros(0)] * 3
        if left.num_rows and right.num_rows:
            a, b = (np.array(t.column("v").to_pylist()) for t in (left, right))
            ids = [t.column("vec_id").to_numpy() for t in (left, right)]
            found = search_block(ids[0], a, ids[1], b, pivots, length, top, share)
        return pa.table({
            "query_id": pa.array(found[0].astype(np.int64)),
            "vec_id": pa.array(found[1].astype(np.int64)),
            "score": pa.array(found[2].astype(float)),
        })

    keys = ("block", "query_block")
    found = (
        deal(rows, "block", blocks, "query_block", query_blocks)
        .groupBy(*keys)
        .cogroup(deal(asked, "query_block", query_blocks, "block", blocks).select(*keys, "vec_id", "v").groupBy(*keys))
        .applyInArrow(cell, schema)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
