"""Exact hard negatives: scores of anchors bounded along a spanning tree, only what may count rescored."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hoarfrost.llm.common import file_system, map_arrow, ship, stored
from hoarfrost.session import scratch

#: Anchors of a block, candidates of a shard, and candidates that go through a tree together.
BLOCK_ANCHORS, SHARD_ROWS, STEP_ROWS = 512, 65_536, 8192
#: Below this, sums of integers are exact in doubles.
EXACT = float(1 << 53)
#: Scores travel as decimals, so that those beyond a long are still told apart.
SCORE, WIDEST, LONG = "decimal(38,0)", 10**38 - 1, (1 << 63) - 1


class Rows(NamedTuple):
    """Vectors of a shard or a block, a row each."""

    row: np.ndarray
    vec_id: np.ndarray
    known: np.ndarray  # whether there is a vec_id
    label: np.ndarray
    terms: np.ndarray


def matrix(column: pa.ChunkedArray | pa.Array, width: int = 0) -> np.ndarray:
    """Lists of numbers as rows of a matrix of doubles; a shorter list has zeros at its end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), max(width, int(lengths.max(initial=0)))))
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def rows_of(table: pa.Table) -> Rows:
    ids = table.column("vec_id").combine_chunks()
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    return Rows(table.column("row").to_numpy(), ids.fill_null(0).to_numpy(), known, table.column("label").to_numpy(), matrix(table.column("terms")))


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x for x in (a, b))
    return a, b


# ---- trees ----


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A minimum spanning tree by distance (Prim), walked from its root in depth: the order of the
    vectors, the parent's place in that order (-1 at the root), and the edge's length."""
    n = len(vectors)
    squares = (vectors * vectors).sum(1)
    near, parent, left = np.full(n, np.inf), np.full(n, -1), np.ones(n, bool)
    children: list[list[int]] = [[] for _ in range(n)]
    at = 0
    for _ in range(n):
        left[at] = False
        if parent[at] >= 0:
            children[parent[at]].append(at)
        far = squares + squares[at] - 2 * (vectors @ vectors[at])
        closer = left & (far < near)
        near[closer], parent[closer] = far[closer], at
        if left.any():
            at = int(np.where(left, near, np.inf).argmin())
            if not left[at]:  # nothing is at a finite distance
                at = int(np.flatnonzero(left)[0])
                parent[at] = 0
    order, place, stack = [], np.zeros(n, np.int64), [0]
    while stack:
        at = stack.pop()
        place[at] = len(order)
        order.append(at)
        stack += children[at][::-1]
    order = np.array(order, np.int64)
    up = np.where(parent[order] >= 0, place[parent[order]], -1)
    edges = vectors[order] - vectors[np.where(parent[order] >= 0, parent[order], order)]
    return order, up, np.sqrt((edges * edges).sum(1))


class Walk:
    """Scores of a block of anchors against candidates, anchor by anchor down the tree.

    A child's score of a candidate differs from its parent's by at most the edge's length times the
    candidate's norm. Each anchor takes over its parent's scores as centres of such ranges, and only
    the candidates asked for whose range meets the anchor's window are scored.
    """

    def __init__(self, anchors: np.ndarray, up: np.ndarray, edges: np.ndarray, candidates: np.ndarray):
        self.anchors, self.candidates = same_width(anchors, candidates)
        self.up, self.edges = up, edges
        self.norms = np.sqrt((self.candidates * self.candidates).sum(1))
        self.state: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.waiting = np.bincount(up[up >= 0], minlength=len(up))
        self.scored = 0

    def scores(self, at: int, wanted: np.ndarray, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of the wanted candidates (a mask) that may score from low to high. To
        be called for every anchor, in order; low above high asks for none."""
        parent = int(self.up[at])
        if parent < 0:
            centre, radius = np.zeros(len(self.norms)), np.sqrt((self.anchors[at] ** 2).sum()) * self.norms
        else:
            centre, radius = self.state[parent]
            radius = radius + self.edges[at] * self.norms
            self.waiting[parent] -= 1
            if not self.waiting[parent]:
                del self.state[parent]
        # Scores are whole numbers, so half of one and a little for the rounding of doubles is room enough.
        room = 0.5 + 1e-9 * (np.abs(centre) + radius)
        may = wanted & (centre + radius >= low - room) & (centre - radius <= high + room) if low <= high else np.zeros(len(wanted), bool)
        places = np.flatnonzero(may)
        exact = (self.candidates if len(places) == len(may) else self.candidates[places]) @ self.anchors[at]
        self.scored += len(places)
        if self.waiting[at]:
            centre, radius = centre.copy(), radius.copy()
            centre[places], radius[places] = exact, 0.0
            self.state[at] = (centre, radius)
        return places, exact


# ---- one block against one shard ----


def too_large(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether sums of products may not be exact in doubles."""
    return bool(np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(a.shape[1], b.shape[1], 1) >= EXACT)


def whole(x: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)


def best_first(places: np.ndarray, scores: np.ndarray, c: Rows) -> np.ndarray:
    """Order by falling score, then smaller vec_id (none last), then row."""
    return np.lexsort((c.row[places], c.vec_id[places], ~c.known[places], -scores))


def _steps(block: Rows, up: np.ndarray, edges: np.ndarray, c: Rows, wanted, window, take) -> None:
    """Take every anchor's candidates, some at a time. `window` is asked before each anchor."""
    large = too_large(block.terms, c.terms)
    for first in range(0, len(c.row), STEP_ROWS):
        part = Rows(*(x[first : first + STEP_ROWS] for x in c))
        if large:  # exact whole numbers of any size, without bounds
            a, b = same_width(block.terms, part.terms)
            a, b = whole(a), whole(b)
            for at in range(len(block.row)):
                places = np.flatnonzero(wanted(at, part))
                exact = b[places] @ a[at] if a.shape[1] else np.zeros(len(places), object)
                take(at, places, exact, part)
            continue
        walk = Walk(block.terms, up, edges, part.terms)
        for at in range(len(block.row)):
            take(at, *walk.scores(at, wanted(at, part), *window(at)), part)


def positives_of(block: Rows, up: np.ndarray, edges: np.ndarray, seeds: np.ndarray, c: Rows, k: int) -> list[tuple]:
    """Each anchor's first k candidates of its label: (anchor row, row, vec_id, score).

    `seeds`: a score that k rows of the label are known to reach (minus infinity if none is known).
    """
    best: list[list[tuple]] = [[] for _ in block.row]
    least = seeds.copy()

    def wanted(at: int, part: Rows) -> np.ndarray:
        return (part.label == block.label[at]) & (part.row != block.row[at])

    def take(at: int, places: np.ndarray, scores: np.ndarray, part: Rows) -> None:
        keep = scores >= least[at]
        places, scores = places[keep], scores[keep]
        if not len(places):
            return
        first = best_first(places, scores, part)[:k]
        found = zip(scores[first].tolist(), part.known[places[first]].tolist(), part.vec_id[places[first]].tolist(), part.row[places[first]].tolist(), strict=True)
        best[at] = sorted([*best[at], *((-s, not known, i, r) for s, known, i, r in found)])[:k]
        if len(best[at]) == k:
            least[at] = max(least[at], -best[at][-1][0])

    _steps(block, up, edges, c, wanted, lambda at: (least[at], np.inf), take)
    return [(int(block.row[at]), r, None if unknown else i, int(-s)) for at, found in enumerate(best) for s, unknown, i, r in found]


def negatives_of(block: Rows, up: np.ndarray, edges: np.ndarray, positives: list[list[dict]], c: Rows, k: int, share: tuple[int, int]) -> list[tuple]:
    """For each anchor and positive the first k candidates of other labels that score at most as much as
    the positive and at least share[0] / share[1] of it: (anchor row, positive row, row, vec_id, score)."""
    low, high = share
    tops = [sorted({p["score"] for p in found}, reverse=True) for found in positives]
    tops = [[p for p in scores if low * p <= high * p] for scores in tops]  # of a negative score no share is below it
    best: list[dict[int, list[tuple]]] = [{p: [] for p in scores} for scores in tops]

    def window(at: int) -> tuple[float, float]:
        if not tops[at]:
            return 1.0, 0.0
        floors = [-found[-1][0] if len(found) == k else low * p / high - 1 for p, found in best[at].items()]
        return float(min(floors)), float(tops[at][0])

    def take(at: int, places: np.ndarray, scores: np.ndarray, part: Rows) -> None:
        if not len(places) or not tops[at]:
            return
        order = best_first(places, scores, part)
        places, scores = places[order], scores[order]
        falling = -scores.astype(float) if scores.dtype == object else -scores
        for p in tops[at]:
            if scores.dtype == object:
                picks = [i for i in range(len(scores)) if scores[i] <= p and low * p <= high * scores[i]][:k]
            else:
                start = int(np.searchsorted(falling, -p, "left"))
                picks = [i for i in range(start, min(start + k, len(scores))) if low * p <= high * int(scores[i])]
            if picks:
                more = [(-int(scores[i]), not part.known[places[i]], int(part.vec_id[places[i]]), int(part.row[places[i]])) for i in picks]
                best[at][p] = sorted([*best[at][p], *more])[:k]

    _steps(block, up, edges, c, lambda at, part: part.label != block.label[at], window, take)
    return [
        (int(block.row[at]), p["row"], r, None if unknown else i, -s)
        for at, found in enumerate(positives)
        for p in found
        for s, unknown, i, r in best[at].get(p["score"], [])
    ]


# ---- jobs ----


def labelled_terms(vectors: DataFrame, vec: str, key: str, label: str, scale: int) -> DataFrame:
    """Stored rows that take part: a number of their own, vec_id, label, and floor(scale * x) of every
    component as a double. Rows with a null label, a null vector, or a null or non-finite component do not."""
    sound = F.col(label).isNotNull() & F.col(vec).isNotNull()
    sound &= F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.lit(False)))
    terms = F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    rows = vectors.where(sound).select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), terms.alias("terms"))
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "terms"), "labelled-terms")


def _blocks(anchors: DataFrame) -> DataFrame:
    """Anchors with the block they belong to: parts of one label, or several labels that have few anchors."""
    sizes = anchors.groupBy(F.col("label").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    sizes = stored(sizes, "anchor-labels")
    few = sizes.where(F.col("_n") < BLOCK_ANCHORS).agg(F.sum("_n")).first()[0] or 0
    pools = max(1, -(-few // BLOCK_ANCHORS))
    parts = F.ceil(F.col("_n") / BLOCK_ANCHORS)
    pooled = F.col("_n") < BLOCK_ANCHORS
    block = F.when(pooled, F.xxhash64(F.lit("pool"), F.pmod(F.xxhash64("label"), F.lit(pools)))).otherwise(
        F.xxhash64(F.lit("part"), "label", F.pmod(F.xxhash64("row"), parts))
    )
    return anchors.join(sizes, F.col("label") == F.col("_of")).select(block.alias("block"), "row", "vec_id", "label", "terms")


TREE = "block long, place int, row long, vec_id long, label long, terms array<double>, up int, edge double, seed double"


def plant(table: pa.Table, k: int) -> pa.Table:
    """A block of anchors in the order of its tree, with parents, edges and what k rows are known to reach."""
    table = table.sort_by("row")
    block = rows_of(table)
    order, up, edges = spanning_tree(block.terms)
    seeds = np.full(len(order), -np.inf)
    if not too_large(block.terms, block.terms):
        for i in range(len(order)):
            others = block.terms[(block.label == block.label[i]) & (np.arange(len(order)) != i)]
            if len(others) >= k:
                seeds[i] = np.partition(others @ block.terms[i], len(others) - k)[len(others) - k]
    table = table.take(pa.array(order))
    more = {"place": np.arange(len(order), dtype=np.int32), "up": up.astype(np.int32), "edge": edges, "seed": seeds[order]}
    for name, values in more.items():
        table = table.append_column(name, pa.array(values))
    return table.select(["block", "place", "row", "vec_id", "label", "terms", "up", "edge", "seed"])


def _kept(trees: DataFrame, label: str) -> str:
    """Write blocks, each whole in one file and in order; the folder's address. Tasks read them there."""
    path = scratch(trees.sparkSession, label)
    files = max(1, trees.count() // (8 * BLOCK_ANCHORS))
    trees.repartition(files, "block").sortWithinPartitions("block", "place").write.parquet(path)
    return path


def each_block(path: str) -> Iterator[pa.Table]:
    """The blocks of a folder, one after the other; only one file's rows are held at a time."""
    fs, folder = file_system(path)
    for file in sorted(pads.dataset(folder, format="parquet", filesystem=fs, exclude_invalid_files=False).files):
        table = pads.dataset(file, format="parquet", filesystem=fs).to_table()
        blocks = table.column("block").to_numpy()
        cuts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])) if len(blocks) else []
        for a, b in zip(cuts, np.append(cuts[1:], len(blocks)), strict=True) if len(blocks) else ():
            yield table.slice(a, b - a)


def _search(candidates: DataFrame, path: str, decide, columns: Sequence[str]) -> DataFrame:
    """Run every block of a folder past every candidate: the named columns and the score. Candidates stay where they are, and each task
    reads the blocks, so neither side is copied for the other."""
    names = [*columns, "score"]
    schema = ", ".join([*(f"{x} long" for x in columns), f"score {SCORE}"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def search(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard = rows_of(pa.Table.from_batches(held))
            for block in each_block(path):
                found = decide(block, shard)
                if found:
                    *columns, scores = zip(*found, strict=True)
                    wide = pa.array([max(-WIDEST, min(WIDEST, s)) for s in scores], pa.decimal128(38, 0))
                    yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in columns), wide], names)

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= SHARD_ROWS:
                yield from search(held)
                held, n = [], 0
        if n:
            yield from search(held)

    return map_arrow(candidates, run, schema)


def hard_negatives(
    rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100), shard_rows: int | None = None
) -> DataFrame:
    """For each anchor and each of its positives, the hardest rows of other labels below the positive.

    `rows` and `anchors` (some of the rows) have row, vec_id, label and terms. An anchor's positives are
    its first `positives` other rows of its label. Of the rows of other labels, the first `negatives`
    count whose score is at most the positive's and at least share[0] / share[1] of it. Rows are ordered
    by falling score, then smaller vec_id (null last). Fewer are returned where there are fewer.

    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score. Scores are
    exact up to 38 digits, and shown within the limits of a long. Every row is itself, also if another has its vec_id.
    Empty vectors score 0, and a shorter vector counts as if it ended in zeros. Empty tables give no rows.
    """
    spark = rows.sparkSession
    ship(spark)
    trees = stored(_blocks(anchors).groupBy("block").applyInArrow(lambda t: plant(t, positives), TREE), "anchor-trees")
    n, spread = rows.count(), 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    if shard_rows is None:
        shard_rows = max(1024, min(SHARD_ROWS, n // spread))
    candidates = rows.select("row", "vec_id", "label", "terms").repartition(max(1, -(-n // shard_rows)), "row")

    def tree(table: pa.Table) -> tuple[Rows, np.ndarray, np.ndarray]:
        return rows_of(table), table.column("up").to_numpy(), table.column("edge").to_numpy()

    def alike(table: pa.Table, shard: Rows) -> list[tuple]:
        return positives_of(*tree(table), table.column("seed").to_numpy(), shard, positives)

    def unlike(table: pa.Table, shard: Rows) -> list[tuple]:
        told = [[{"row": p["row"], "score": int(p["score"])} for p in x or []] for x in table.column("positives").to_pylist()]
        return negatives_of(*tree(table), told, shard, negatives, share)

    found = _search(candidates, _kept(trees, "anchors"), alike, ["anchor", "row", "vec_id"])
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    found = stored(found.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= positives).drop("_rank"), "positives")
    each = found.groupBy(F.col("anchor").alias("_of")).agg(F.collect_list(F.struct("row", "score")).alias("positives"))  # `positives` at most
    windows = trees.join(each, F.col("row") == F.col("_of"), "left").drop("_of")
    below = _search(candidates, _kept(windows, "windows"), unlike, ["anchor", "positive", "row", "vec_id"])
    best = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    below = below.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    named = found.select(F.col("anchor").alias("_a"), F.col("row").alias("_p"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = named.join(anchors.select(F.col("row").alias("_row"), F.col("vec_id").alias("anchor_id")), F.col("_a") == F.col("_row"))
    joined = below.join(named, (F.col("anchor") == F.col("_a")) & (F.col("positive") == F.col("_p")))
    low, high = (F.lit(x).cast(SCORE) for x in (-LONG - 1, LONG))
    scores = [F.least(F.greatest(F.col(c), low), high).cast("long").alias(name) for c, name in (("positive_score", "positive_score"), ("score", "negative_score"))]
    return joined.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), *scores)
