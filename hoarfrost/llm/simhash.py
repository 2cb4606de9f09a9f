"""SimHash near-duplicates: a self-join of fingerprints by traversing a binary trie against itself."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoarfrost.llm.common import map_arrow, pieces, stored, text_buffers, unlike
from hoarfrost.llm.components import components

SEED = 42
BITS = 64
#: Node pairs that a traversal widens together.
FRONTIER = 1 << 18
#: Bits by which a node pair with too many fingerprints for one task is split at a time.
STEP_BITS = 6


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased (A-Z) texts with one space between words: bytes, starts and ends of words, words a text."""
    upper = (data >= 0x41) & (data <= 0x5A)
    data = np.where(upper, data + 32, data).astype(np.uint8)
    white = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    n = len(data)
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    word = ~white
    begins = word.copy()
    begins[1:] &= white[:-1] | first[1:n]
    starts = np.flatnonzero(begins)
    closes = word.copy()
    closes[:-1] &= white[1:] | first[1:n]
    ends = np.flatnonzero(closes) + 1
    lengths = ends - starts
    out = np.full(int(lengths.sum()) + len(lengths), 0x20, np.uint8)
    new_starts = np.cumsum(lengths + 1) - lengths - 1
    keep = np.ones(len(out), bool)
    keep[new_starts + lengths] = False
    out[keep] = data[word]
    counts = np.diff(np.searchsorted(starts, offsets))
    return out, new_starts, new_starts + lengths, counts


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """The fingerprint of each text: bit b is set if set in over half the hashes of its shingles."""
    from xxhash import xxh64_intdigest

    out, starts, ends, counts = words_of(data, offsets)
    shingles = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    first = np.repeat(np.cumsum(counts) - counts, shingles)
    number = np.arange(len(first)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    last = first + np.minimum(number + width, np.repeat(counts, shingles)) - 1
    raw = out.tobytes()
    spans = zip(starts[first + number].tolist(), ends[last].tolist(), strict=True)
    hashes = np.fromiter((xxh64_intdigest(raw[a:b], SEED) for a, b in spans), np.uint64, len(first))
    prints = np.zeros(len(counts), np.uint64)
    filled = np.flatnonzero(shingles)
    if len(filled):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, BITS)
        ones = np.add.reduceat(bits, (np.cumsum(shingles) - shingles)[filled], axis=0, dtype=np.int64)
        majority = 2 * ones > shingles[filled, None]
        prints[filled] = np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel()
    return prints


def fingerprints(docs: DataFrame, width: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, mark (a hash of the text) and fp (the fingerprint's 64 bits as a long). A text without
    words has fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", 1 << 20):
            prints = fingerprints_of(*text_buffers(batch.column("_text")), width)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_mark"), pa.array(prints.view(np.int64))], ["doc_id", "mark", "fp"])

    rows = docs.select(F.col(key).cast("long").alias("_id"), F.xxhash64(text).alias("_mark"), F.col(text).alias("_text"))
    return map_arrow(rows, run, "doc_id long, mark long, fp long")


class Groups:
    """Components of links that arrive bit by bit, kept as one label per item."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while len(a):
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                break
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label[:] = up


def trie_join(values: np.ndarray, roots: np.ndarray, depth: int, budget: int, groups: Groups) -> None:
    """Link all pairs of one trie, or of two, that differ in at most `budget` bits.

    `values` is sorted, distinct in each root; a trie node is a range of it. `roots` has rows (low,
    high, low, high, error): two nodes at `depth`, or a node with itself, and the bits in which they
    already differ. Both nodes of a pair go down together: equal branches keep the error, crossed ones
    add one, and a pair over the budget is pruned with all that is below it. Two single
    fingerprints are compared at once.
    """
    ones: dict[int, np.ndarray] = {}

    def before(level: int) -> np.ndarray:
        if level not in ones:
            bit = (values >> np.uint64(BITS - 1 - level)) & np.uint64(1)
            ones[level] = np.concatenate([[0], np.cumsum(bit.astype(np.int64))])
        return ones[level]

    stack = [(depth, roots)]
    while stack:
        level, pairs = stack.pop()
        if len(pairs) > FRONTIER:
            half = len(pairs) // 2
            stack += [(level, pairs[half:]), (level, pairs[:half])]
            continue
        a, ah, b, bh, error = pairs.T
        itself = (a == b) & (ah == bh)
        single = (ah - a == 1) & (bh - b == 1)
        near = single & ~itself
        if near.any():
            x, y = a[near], b[near]
            close = np.bitwise_count(values[x] ^ values[y]) <= budget
            groups.add(x[close], y[close])
        pairs, itself = pairs[~single], itself[~single]
        if level == BITS or not len(pairs):
            # At the last level a range holds equal values: one for each side of a pair.
            if len(pairs):
                groups.add(pairs[:, 0], pairs[:, 2])
            continue
        a, ah, b, bh, error = pairs.T
        sums = before(level)
        am, bm = ah - (sums[ah] - sums[a]), bh - (sums[bh] - sums[b])
        children = np.concatenate([
            np.stack([a, am, b, bm, error], 1),
            np.stack([am, ah, bm, bh, error], 1),
            np.stack([a, am, bm, bh, error + 1], 1),
            np.stack([am, ah, b, bm, error + 1], 1)[~itself],
        ])
        alive = (children[:, 0] < children[:, 1]) & (children[:, 2] < children[:, 3]) & (children[:, 4] <= budget)
        stack.append((level + 1, children[alive]))


def forest(names: list[np.ndarray], side: np.ndarray, values: np.ndarray, budget: int) -> np.ndarray:
    """For rows of several node pairs, a forest that connects their links: (fingerprint, fingerprint) rows.

    `names` are turn, depth, left and right. Rows of a node paired with itself have side 0; of two
    different nodes, the left one's rows have side 0 and the right one's side 1.
    """
    order = np.lexsort((values, side, *names[::-1]))
    turn, depth, left, right = names = [x[order] for x in names]
    side, values = side[order], values[order]
    change = np.ones(len(values) + 1, bool)
    change[1:-1] = np.logical_or.reduce([x[1:] != x[:-1] for x in names])
    edges = np.flatnonzero(change)
    low, high = edges[:-1], edges[1:]
    mid = high - np.add.reduceat(side, low)
    error = np.bitwise_count(left[low] ^ right[low]).astype(np.int64)
    alone = np.stack([low, high, low, high, error], 1)
    roots = np.where((left[low] == right[low])[:, None], alone, np.stack([low, mid, mid, high, error], 1))
    roots = roots[(roots[:, 0] < roots[:, 1]) & (roots[:, 2] < roots[:, 3])]
    groups, levels = Groups(len(values)), depth[roots[:, 0]]
    for level in np.unique(levels):
        trie_join(values, roots[levels == level], int(level), budget, groups)
    moved = np.flatnonzero(groups.label != np.arange(len(values)))
    back = turn[moved].astype(np.uint64)  # a node's rows are turned alike
    plain = [(x >> back) | (x << (np.uint64(BITS) - back) % np.uint64(BITS)) for x in (values[moved], values[groups.label[moved]])]
    return np.stack(plain, 1).view(np.int64)


def near_links(prints: DataFrame, budget: int, rows_a_task: int | None = None) -> DataFrame:
    """Links that connect all distinct fingerprints (column fp) at most `budget` bits apart: a, b.

    Two such fingerprints agree in one of budget + 1 blocks of bits at least. Each fingerprint is dealt
    to one node per block, turned so that the block stands first: the node of the trie under that
    prefix. A node's task joins it with itself. Where a node has more than `rows_a_task` fingerprints,
    it is replaced by pairs of the nodes STEP_BITS below it, as far as they are within the budget, again
    and again until no pair is too large. Each task returns a forest, never all pairs.
    """
    spark = prints.sparkSession
    cuts = [BITS * i // (budget + 1) for i in range(budget + 2)]
    turned = [F.shiftleft("fp", c).bitwiseOR(F.shiftrightunsigned("fp", BITS - c)) if c else F.col("fp") for c in cuts[:-1]]
    nodes = F.array(*(
        F.struct(F.lit(c).alias("turn"), F.lit(cuts[i + 1] - c).alias("depth"), F.shiftrightunsigned(t, BITS - (cuts[i + 1] - c)).alias("left"), t.alias("value"))
        for i, (c, t) in enumerate(zip(cuts[:-1], turned, strict=True))
    ))
    rows = prints.select(F.inline(nodes)).select("turn", "depth", "left", F.col("left").alias("right"), F.lit(0).alias("side"), "value")
    rows = stored(rows, "trie-nodes")
    if rows_a_task is None:
        rows_a_task = max(256, min(20_000, rows.count() // (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    name, ready = ["turn", "depth", "left", "right"], []
    while True:
        large = rows.groupBy(*name).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > rows_a_task) & (F.col("depth") < BITS)).select(*name)
        large = stored(large, "trie-large")
        if large.isEmpty():
            ready.append(rows)
            break
        ready.append(rows.join(large, name, "left_anti"))
        rows = stored(_lower(rows.join(large, name, "left_semi"), budget), "trie-nodes")
    rows = ready[0]
    for more in ready[1:]:
        rows = rows.unionByName(more)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if got:
            table = pa.Table.from_batches(got)
            names = [table.column(x).to_numpy() for x in name]
            links = forest(names, table.column("side").to_numpy(), table.column("value").to_numpy().view(np.uint64), budget)
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])

    return map_arrow(rows.select(*name, "side", "value").repartition(*name), join, "a long, b long").distinct()


def _lower(rows: DataFrame, budget: int) -> DataFrame:
    """Rows of node pairs, dealt to the pairs of nodes STEP_BITS below that are still within the budget."""
    rows = rows.withColumn("down", F.least(F.lit(STEP_BITS), F.lit(BITS) - F.col("depth")))
    rows = rows.withColumn("own", F.expr(f"shiftrightunsigned(value, {BITS} - depth - down)"))
    masks = [m for m in range(1 << STEP_BITS) if m.bit_count() <= budget]
    rows = rows.withColumn("mask", F.explode(F.array(*map(F.lit, masks)))).where(F.expr("mask < shiftleft(1, down)"))
    # The partner's prefix: the other node's prefix, then the own next bits with those of the mask changed.
    other = F.expr("shiftleft(IF(side = 0, right, left), down) | ((own & (shiftleft(1L, down) - 1)) ^ mask)")
    rows = rows.withColumn("other", other).where(F.bit_count(F.col("own").bitwiseXOR(F.col("other"))) <= budget)
    within = F.col("left") == F.col("right")
    # Two nodes under one node are paired once: the smaller prefix is on the left.
    left = F.when(within, F.least("own", "other")).when(F.col("side") == 0, F.col("own")).otherwise(F.col("other"))
    right = F.when(within, F.greatest("own", "other")).when(F.col("side") == 0, F.col("other")).otherwise(F.col("own"))
    side = F.when(within, (F.col("own") > F.col("other")).cast("int")).otherwise(F.col("side"))
    return rows.select("turn", (F.col("depth") + F.col("down")).alias("depth"), left.alias("left"), right.alias("right"), side.alias("side"), "value")


def near_duplicates(docs: DataFrame, width: int, budget: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with its fingerprint and component: doc_id, mark (a hash of the text), fp,
    component_id.

    Documents link if their fingerprints differ in at most `budget` bits; component_id is the smallest
    doc_id that links lead to. Equal fingerprints are joined once, whatever their number. Null and
    empty texts, and texts of white space, have fingerprint zero and link like any other. A null
    doc_id never names a component unless it has no other. An empty table gives no rows.
    """
    return _with_roots(docs, width, budget, key, text).select("doc_id", "mark", "fp", "component_id")


def _with_roots(docs: DataFrame, width: int, budget: int, key: str, text: str) -> DataFrame:
    """As near_duplicates, with root: the fingerprint that stands for the component, unlike its
    component_id no other component's."""
    prints = stored(fingerprints(docs, width, key, text), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-prints")
    roots = components(near_links(distinct.select("fp"), budget))
    named = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = stored(named, "print-roots")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.select("fp", "root").join(smallest, "root").select(F.col("fp").alias("of"), "root", "component_id")
    return prints.join(classes, F.col("fp") == F.col("of")).drop("of")


def one_of_each(docs: DataFrame, width: int, budget: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay if one document of each component does: the one with the smallest
    key (a null key only where there is no other), all columns as they are. Of rows equal in key and text
    one stays.
    """
    found = _with_roots(docs, width, budget, key, text)
    # Components may share a component_id: null, or a doc_id that several unlike texts carry.
    first = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark")
    best = found.groupBy("root").agg(F.min(first).alias("first")).select("first.doc_id", "first.mark")
    of, at = unlike(docs, "of"), unlike(docs, "at")
    best = best.select(F.col("doc_id").alias(of), F.col("mark").alias(at))
    kept = docs.join(best, docs[key].cast("long").eqNullSafe(best[of]) & (F.xxhash64(docs[text]) == best[at]), "left_semi")
    number, mark = unlike(docs, "number"), unlike(docs, "mark")
    kept = kept.withColumns({number: F.col(key).cast("long"), mark: F.xxhash64(text)})
    return kept.dropDuplicates([number, mark]).drop(number, mark)
