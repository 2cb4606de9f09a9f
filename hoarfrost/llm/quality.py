"""Text quality by a generalised additive model with pairwise interactions.

Cyclic boosting of shallow trees learns one lookup table per feature and per chosen pair of features;
a score is the sum of table entries at a text's bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoarfrost.llm.common import map_arrow, pieces, text_buffers, unlike
from hoarfrost.llm.simhash import words_of
from hoarfrost.llm.tokens import span_hashes

FEATURES = (
    "words", "word_length", "letters", "upper", "digits", "marks", "symbols", "white", "lines", "line_words",
    "distinct_words", "top_word", "repeated_words", "distinct_lines", "marked_words", "shout_words", "bare_words", "stops",
)
#: Bytes of text that are measured together; about a hundred bytes of arrays each.
STEP_BYTES = 1_000_000
#: Labelled rows that a model learns from at most; beyond, those with the smallest hashes of their ids.
TRAINING_ROWS = 20_000


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per owner, how many different hashes there are, and how often the commonest occurs."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    runs = np.diff(np.append(np.flatnonzero(new), len(owner)))
    most = np.zeros(n)
    np.maximum.at(most, owner[new], runs)
    return np.bincount(owner[new], minlength=n).astype(float), most


def features_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The features of each text, from the whole of it: shares of kinds of bytes, words and lines."""
    n = len(offsets) - 1
    share = lambda a, b: np.divide(a, b, out=np.zeros(n), where=b > 0)
    size = np.diff(offsets).astype(float)
    upper = (data >= 0x41) & (data <= 0x5A) | (data >= 0x80) & (data <= 0x9E) & (np.concatenate([[0], data[:-1]]) == 0xC3)
    letter = upper | (data >= 0x61) & (data <= 0x7A) | (data >= 0xC0)
    digit = (data >= 0x30) & (data <= 0x39)
    line = data == 0x0A
    white = (data == 0x20) | (data >= 0x09) & (data <= 0x0D)
    mark = ~(letter | digit | white) & (data < 0x80)
    stop = np.isin(data, np.frombuffer(b".,?!;:", np.uint8))
    low, starts, ends, counts = words_of(data, offsets)
    words, owner = counts.astype(float), np.repeat(np.arange(n), counts)
    hashes = span_hashes(low, starts, ends)
    distinct, most = _distinct(owner, hashes, n)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    # Words are counted in the text as it is, since lower case hides shouting.
    place = np.flatnonzero(~white)
    mark_of, upper_of, letter_of = (np.concatenate([[0], np.cumsum(x[place])]) for x in (mark, upper, letter))
    lengths = ends - starts
    to = np.cumsum(lengths)
    marks_in, upper_in, letter_in = (x[to] - x[to - lengths] for x in (mark_of, upper_of, letter_of))
    of_words = lambda x: np.bincount(owner[x], minlength=n).astype(float)
    breaks = np.sort(np.concatenate([offsets[:-1][size > 0], np.flatnonzero(line) + 1]))
    breaks = np.unique(breaks[breaks < len(data)])
    stops_at = np.append(breaks[1:], len(data))
    line_owner = np.searchsorted(offsets, breaks, "right") - 1
    line_hash = span_hashes(data, breaks, stops_at)
    lines, _ = _distinct(line_owner, line_hash, n)
    all_lines = np.bincount(line_owner, minlength=n).astype(float)
    columns = [
        np.log1p(words), share(_sums(~white, offsets), words), share(_sums(letter, offsets), size), share(_sums(upper, offsets), _sums(letter, offsets)),
        share(_sums(digit, offsets), size), share(_sums(mark, offsets), size), share(_sums(mark & ~stop, offsets), size), share(_sums(white, offsets), size),
        np.log1p(all_lines), share(words, all_lines), share(distinct, words), share(most, words), share(of_words(again), words), share(lines, all_lines),
        share(of_words(marks_in >= 2), words), share(of_words((upper_in == letter_in) & (letter_in > 1)), words), share(of_words(letter_in == 0), words),
        share(_sums(stop, offsets), words),
    ]
    return np.stack(columns, 1)


@dataclass
class Gam:
    """Bin edges per feature, a table per feature and per pair, and the intercept; sums are log-odds."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    coarse: list[np.ndarray]
    pair_tables: list[np.ndarray]
    intercept: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The chance of label 1 of each row, by adding the entries of all tables at its bins."""
        total = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], x[:, j], "right")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _tree(g: np.ndarray, h: np.ndarray, depth: int, ridge: float, least: float) -> np.ndarray:
    """A shallow tree over ordered bins, as each bin's value: the best split, then each side again."""
    total_g, total_h = g.sum(), h.sum()
    if depth and len(g) > 1:
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gains = _gain(left_g, left_h, ridge) + _gain(total_g - left_g, total_h - left_h, ridge) - _gain(total_g, total_h, ridge)
        gains[(left_h < least) | (total_h - left_h < least)] = -1
        cut = int(np.argmax(gains)) + 1
        if gains[cut - 1] > 1e-9:
            return np.concatenate([_tree(g[:cut], h[:cut], depth - 1, ridge, least), _tree(g[cut:], h[cut:], depth - 1, ridge, least)])
    return np.full(len(g), total_g / (total_h + ridge))


def _pair_tree(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> tuple[np.ndarray, float]:
    """A tree over two features: the best cut of one, then the best cut of the other on each side."""
    best, value = -1.0, np.zeros_like(g)
    for axis in (0, 1):
        a, b = (g, h) if axis == 0 else (g.T, h.T)
        for cut in range(1, len(a)):
            sides = [_tree(a[s].sum(0), b[s].sum(0), 1, ridge, least) for s in (slice(0, cut), slice(cut, None))]
            gain = sum(float((2 * v * a[s].sum(0) - v * v * b[s].sum(0)).sum()) for v, s in zip(sides, (slice(0, cut), slice(cut, None)), strict=True))
            if gain > best:
                best = gain
                out = np.concatenate([np.tile(sides[0], (cut, 1)), np.tile(sides[1], (len(a) - cut, 1))])
                value = out if axis == 0 else out.T
    return value, best


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 200, pairs: int = 6, pair_rounds: int = 40, rate: float = 0.1, bins: int = 48, coarse_bins: int = 8) -> Gam:
    """Boost in cycles: each round gives every feature one small tree on the current residuals, so
    related features share the credit. The pairs whose residuals a two-way tree explains best are then
    boosted in the same manner. Without rows of both labels the model is the rows' share of ones."""
    ridge, least, n = 1.0, 2.0, max(1, len(y))
    cut = lambda v, k: np.unique(np.quantile(v, np.linspace(0, 1, k + 1)[1:-1])) if len(v) else np.zeros(0)
    edges = [cut(x[:, j], bins) for j in range(x.shape[1])]
    coarse = [cut(x[:, j], coarse_bins) for j in range(x.shape[1])]
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Gam(edges, [np.zeros(len(e) + 1) for e in edges], [], coarse, [], float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    at = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    total = np.full(n, model.intercept)
    chance = lambda: 1 / (1 + np.exp(-np.clip(total, -30, 30)))
    for _ in range(rounds):
        for j, e in enumerate(edges):
            p = chance()
            g, h = (np.bincount(at[j], w, len(e) + 1) for w in (y - p, p * (1 - p)))
            step = rate * _tree(g, h, 2, ridge, least)
            model.tables[j] += step
            total += step[at[j]]
    low = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]
    cells = lambda a, b, w: np.bincount(low[a] * (len(coarse[b]) + 1) + low[b], w, (len(coarse[a]) + 1) * (len(coarse[b]) + 1)).reshape(len(coarse[a]) + 1, -1)
    p = chance()
    gains = [(_pair_tree(cells(a, b, y - p), cells(a, b, p * (1 - p)), ridge, least)[1], a, b) for a in range(x.shape[1]) for b in range(a)]
    model.pairs = [(a, b) for gain, a, b in sorted(gains, reverse=True)[:pairs] if gain > 0]
    model.pair_tables = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for table, (a, b) in zip(model.pair_tables, model.pairs, strict=True):
            p = chance()
            step = rate * _pair_tree(cells(a, b, y - p), cells(a, b, p * (1 - p)), ridge, least)[0]
            table += step
            total += step[low[a], low[b]]
    return model


def held_out(key: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of the id as text is 0 modulo 5 (so is a null id)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5, F.lit(0)) == 0


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", most: int = TRAINING_ROWS) -> Gam:
    """Fit on at most `most` labelled documents that are not held out.

    Where there are more, those with the smallest hashes of their ids are taken. A label that is null
    teaches nothing; an id with several labels counts as 1 if most of them are. Of several rows with
    one id one is used. Only features of the text enter the model.
    """
    marked = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    marked = marked.groupBy(F.col(key).cast("long").alias("_id")).agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("_y"))
    marked = marked.orderBy(F.xxhash64("_id"), "_id").limit(most)
    rows = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text")).join(F.broadcast(marked), "_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", STEP_BYTES):
            x = features_of(*text_buffers(batch.column("_text")))
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_y"), values], ["_id", "_y", "x"])

    sample = map_arrow(rows.select("_id", "_y", "_text"), measure, "_id long, _y int, x array<double>")
    sample = sample.groupBy("_id").agg(F.min(F.struct("x", "_y")).alias("_r")).select("_id", "_r.x", "_r._y").orderBy("_id").limit(most).collect()
    x = np.array([r["x"] for r in sample], float).reshape(len(sample), len(FEATURES))
    return fit(x, np.array([r["_y"] for r in sample], float))


def with_scores(docs: DataFrame, model: Gam, text: str = "text", name: str = "score") -> DataFrame:
    """All rows and columns, with the model's score of the whole text (null: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, STEP_BYTES):
            scores = model.score(features_of(*text_buffers(batch.column(text))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{name}` double"
    return map_arrow(docs, run, schema)


def good_ones(docs: DataFrame, model: Gam, limit: float, text: str = "text") -> DataFrame:
    """The rows that the model scores at `limit` or more, all columns as they are."""
    name = unlike(docs, "score")
    return with_scores(docs, model, text, name).where(F.col(name) >= limit).drop(name)


def score_documents(docs: DataFrame, labels: DataFrame, limit: float = 0.3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's score: the key, held_out, score and predicted (1 if the score is at least `limit`).

    Empty and null texts are scored by the features of an empty text. Repeated rows are scored each. With
    an empty label table every score is a half. An empty table gives no rows.
    """
    model = learn(docs, labels, key, text)
    scored = with_scores(docs.select(F.col(key), F.col(text)), model, text)
    return scored.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))
