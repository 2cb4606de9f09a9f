"""Exact top-k inner products by MaxScore: essential terms are traversed, the others only probed."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hoarfrost.llm.common import ship, stored

#: Rows of a shard of candidates, queries of a block, and candidates traversed between two thresholds.
SHARD_ROWS, QUERY_ROWS, STRIDE = 8192, 4096, 2048
#: Below this, sums of integers are exact in doubles.
EXACT = float(1 << 53)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of numbers as the columns of a matrix (terms x rows); a shorter list has zeros at its end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), int(lengths.max()) if len(lengths) else 0), flat.dtype if len(flat) else np.float64)
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = flat
    return np.ascontiguousarray(out.T)


def top_of_shard(query: np.ndarray, postings: np.ndarray, low: np.ndarray, high: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Positions of the k best candidates of one shard, by score and then smaller id.

    Term t's contribution lies between two bounds, from the extremes of its postings. Counted from its
    lower bound it is never negative. Terms whose ranges together stay below what the threshold leaves
    are non-essential: they cannot lift a candidate by themselves. The postings of the essential terms
    are added up first; a candidate goes on only while its sum and the ranges of the terms not yet
    probed can reach the threshold. Equal scores are kept, as the id decides between them.
    """
    a, b = query * low, query * high
    least, reach = np.minimum(a, b), np.abs(b - a)
    floor = float(least.sum())
    order = np.argsort(reach, kind="stable")
    within = np.cumsum(reach[order])
    best, scores, threshold = np.zeros(0, np.int64), np.zeros(0), -np.inf
    for first in range(0, postings.shape[1], STRIDE):
        at = np.arange(first, min(first + STRIDE, postings.shape[1]))
        at = at[at != own]
        optional = int(np.searchsorted(within, threshold - floor, "left"))
        essential = np.sort(order[optional:])
        block = postings[:, first : first + STRIDE]
        # One traversal in place where all are essential, as before the first threshold.
        block = block if optional == 0 else block[essential]
        sums = (query if optional == 0 else query[essential]) @ block
        sums = sums[at - first]
        missing = float(least[order[:optional]].sum())
        for n in range(optional - 1, -1, -4):
            some = order[max(0, n - 3) : n + 1]
            keep = sums + missing + within[n] >= threshold
            if not keep.all():
                at, sums = at[keep], sums[keep]
            if not len(at):
                break
            sums = sums + query[some] @ postings[np.ix_(some, at)]
            missing -= float(least[some].sum())
        at, sums = np.concatenate([best, at]), np.concatenate([scores, sums])
        if len(at) > k:
            near = np.flatnonzero(sums >= np.partition(sums, len(sums) - k)[len(sums) - k])
            near = near[np.lexsort((ids[at[near]], -sums[near]))][:k]
            at, sums = at[near], sums[near]
        best, scores = at, sums
        if len(best) == k:
            threshold = scores.min()
    return best


def search_shard(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k best candidates of a shard for every query of a block: query, query_id, vec_id, score."""
    q, p = matrix(queries.column("terms")), matrix(candidates.column("terms"))
    terms = max(q.shape[0], p.shape[0])
    q, p = (np.vstack([x, np.zeros((terms - len(x), x.shape[1]), x.dtype)]) for x in (q, p))
    ids, rows = candidates.column("vec_id").to_numpy(zero_copy_only=False), candidates.column("row").to_numpy()
    ids = np.where(np.isnan(ids.astype(float)), np.iinfo(np.int64).max, ids).astype(np.int64) if ids.dtype.kind == "f" else ids
    where = {int(r): i for i, r in enumerate(rows)}
    # Whole numbers too large for exact doubles are added up as Python integers, with the same steps.
    large = terms and max(1.0, np.abs(q).max(initial=0)) * max(1.0, np.abs(p).max(initial=0)) * terms >= EXACT
    if large:
        q, p = (np.array([[int(v) for v in row] for row in x], object).reshape(x.shape) for x in (q, p))
    low, high = (p.min(1), p.max(1)) if p.shape[1] else (np.zeros(terms), np.zeros(terms))
    out = {"query": [], "query_id": [], "vec_id": [], "score": []}
    query_rows, query_ids = queries.column("row").to_pylist(), queries.column("vec_id").to_pylist()
    vec_ids = candidates.column("vec_id")
    picks = []
    for i, (row, query_id) in enumerate(zip(query_rows, query_ids, strict=True)):
        v = q[:, i]
        if large:
            scores = v @ p if terms else np.zeros(p.shape[1], object)
            order = sorted((j for j in range(len(ids)) if j != where.get(row, -1)), key=lambda j: (-scores[j], ids[j]))[:k]
            found, got = np.array(order, np.int64), [int(scores[j]) for j in order]
        else:
            found = top_of_shard(v, p, low, high, ids, where.get(row, -1), k)
            got = (v @ p[:, found]).astype(np.int64).tolist()
        picks.append(found)
        out["query"] += [row] * len(found)
        out["query_id"] += [query_id] * len(found)
        out["score"] += [max(-(1 << 63), min((1 << 63) - 1, s)) for s in got]
    chosen = np.concatenate(picks) if picks else np.zeros(0, np.int64)
    return pa.table({
        "query": pa.array(out["query"], pa.int64()), "query_id": pa.array(out["query_id"], pa.int64()),
        "vec_id": vec_ids.combine_chunks().take(pa.array(chosen)).cast(pa.int64()) if len(chosen) else pa.array([], pa.int64()),
        "score": pa.array(out["score"], pa.int64()),
    })


def whole_terms(vectors: DataFrame, vec: str, key: str, scale: int) -> DataFrame:
    """Stored rows with a number of their own, the id, and floor(scale * x) of every component as a double.

    Vectors that are null, or hold a null or non-finite component, are left out.
    """
    sound = F.col(vec).isNotNull() & F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.lit(False)))
    terms = F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    rows = vectors.where(sound).select(F.col(key).cast("long").alias("vec_id"), terms.alias("terms"))
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "terms"), "vector-terms")


def top_k(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best rows for each query, itself excepted: query_id, rank (from 1), vec_id, score.

    Both have row, vec_id and terms. Rows are dealt to shards and queries to blocks by hash; each
    shard is searched for each block, and the shards' best are merged. Scores are exact. Ties go to the
    smaller vec_id (null last). With fewer than k other rows, all are returned. Empty vectors score 0,
    and a shorter vector counts as if it ended in zeros. Each row is a query or candidate of its own,
    equal rows too.
    """
    ship(rows.sparkSession)
    shards, blocks = max(1, -(-rows.count() // SHARD_ROWS)), max(1, -(-queries.count() // QUERY_ROWS))
    own = F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard")
    block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).alias("block")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = queries.select(block, every(shards).alias("shard"), "row", "vec_id", "terms")
    right = rows.select(every(blocks).alias("block"), own, "row", "vec_id", "terms")

    def search(q: pa.Table, c: pa.Table) -> pa.Table:
        return search_shard(q, c, k)

    grouped = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard"))
    found = grouped.applyInArrow(search, "query long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    merged = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return merged.select("query_id", "rank", "vec_id", "score")
