"""Periodic runs of words, found online by catching squares over dyadic blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoarfrost.llm.common import map_arrow, pieces, ragged, text_buffers

#: Words that the batch job appends at a time, and comparisons that one step makes together.
APPENDED, COMPARED = 1 << 16, 1 << 22
MIXED = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


class SquareCatcher:
    """Squares and runs of a growing sequence of whole numbers, reported as they come up.

    Whenever an aligned block of 2 ** k numbers is complete, a catcher is kept for it. Squares of period
    q in [2 ** (k + 1) - 1, 2 ** (k + 2) - 1) are its business: the first half of such a square holds a
    whole aligned block of that size, which comes again q places later. Appended numbers complete
    windows of 2 ** k numbers; a catcher compares its block with those that end inside its reach.
    Neighbouring blocks that recur at the same distance are one stretch of equal numbers; where a stretch
    ends, suffix comparisons of less than a block give its exact ends. A stretch of at least q numbers is
    a square, and all squares of a stretch are one run.

    Windows are compared by hashes that double their width from level to level, and what is reported is
    checked number by number. `append` may be called with any number of numbers at a time, and keeps
    hashes only as far back as catchers reach. `longest` bounds the length of a run that can matter.
    """

    def __init__(self, min_length: int = 1, min_exponent: int = 2, longest: int | None = None):
        if min_exponent < 2:
            raise ValueError("a run holds a square at least")
        self.min_length, self.min_exponent, self.longest = min_length, min_exponent, longest
        self.numbers, self.n = np.zeros(1 << 10, np.int64), 0
        self.hashes: list[tuple[int, np.ndarray]] = []  # per level: first place and hashes of the windows from there
        self.open: list[np.ndarray] = []  # per level: rows (period, first block, last block) that may go on
        self.found: list[np.ndarray] = []
        self.ends: dict[tuple[int, int], int] = {}  # first and last place of the runs found, and their period
        self.cover = np.full(1 << 10, -1, np.int64)  # of each number, which of the found runs was last to cover it

    def append(self, numbers: np.ndarray) -> None:
        """Take in more numbers; runs that they end are added to what `runs` gives."""
        numbers = np.asarray(numbers, np.int64)
        if not len(numbers):
            return
        while self.n + len(numbers) > len(self.numbers):
            self.numbers = np.concatenate([self.numbers, np.zeros_like(self.numbers)])
            self.cover = np.concatenate([self.cover, np.full_like(self.cover, -1)])
        self.numbers[self.n : self.n + len(numbers)] = numbers
        before, self.n = self.n, self.n + len(numbers)
        fresh_from, fresh = before, _mix(numbers.astype(np.uint64))
        reach = self.n if self.longest is None else min(self.n, self.longest)
        level = 0
        while level == 0 or (2 * (1 << level) - 1) * self.min_exponent <= reach:
            size = 1 << level
            if level == len(self.hashes):
                self.hashes.append((fresh_from, np.zeros(0, np.uint64)))
                self.open.append(np.zeros((0, 3), np.int64))
            first, kept = self.hashes[level]
            kept = np.concatenate([kept, fresh])
            self._catch(level, first, kept, fresh_from)
            # Catchers reach four blocks back, and the next level begins with all that is kept here.
            drop = max(0, self.n - first - (4 * self.min_exponent + 4) * size) // size * size
            self.hashes[level] = (first + drop, kept[drop:].copy() if drop else kept)
            # Windows of the next level that have become whole start where its last ones left off.
            level += 1
            fresh_from = first
            if level < len(self.hashes):
                fresh_from = self.hashes[level][0] + len(self.hashes[level][1])
            fresh = _joined(kept[fresh_from - first :], size)

    def _catch(self, level: int, first: int, hashes: np.ndarray, fresh_from: int) -> None:
        """Compare blocks with the windows from `fresh_from` on, chain the matches, report what has ended."""
        size = 1 << level
        low, high = 2 * size - 1, 4 * size - 1
        end = first + len(hashes)
        matches = [self.open[level]]
        # Blocks some of whose windows are new; a block may meet windows of its own completion time.
        from_block = max(-(-first // size), -(-(fresh_from - high + 1) // size), 0)
        to_block = -(-(end - low) // size)  # blocks that start before end - low
        step = max(1, COMPARED // (high - low))
        padded = np.concatenate([hashes, np.zeros(high, np.uint64)])
        for at in range(from_block, to_block, step):
            starts = np.arange(at, min(at + step, to_block), dtype=np.int64) * size
            local = starts - first
            windows = np.lib.stride_tricks.sliding_window_view(padded[low:], high - low)[local[0] : local[-1] + 1 : size]
            block, lag = np.nonzero(windows == hashes[local][:, None])
            q, s = lag + low, starts[block]
            new = (s + q >= fresh_from) & (s + q < end)
            if new.any():
                matches.append(np.stack([q[new], s[new], s[new]], 1))
        rows = np.concatenate(matches)
        if not len(rows):
            return
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        cut = np.ones(len(rows), bool)
        cut[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 2] + size)
        at = np.flatnonzero(cut)
        chained = np.stack([rows[at, 0], rows[at, 1], rows[np.append(at[1:], len(rows)) - 1, 2]], 1)
        # The next block of a stretch may come with words not yet here.
        alive = chained[:, 2] + size + chained[:, 0] >= end
        self.open[level] = chained[alive]
        self._report(level, chained[~alive])

    def _report(self, level: int, stretches: np.ndarray) -> None:
        """Exact ends of stretches, and those that are runs: (start, end, period)."""
        size = 1 << level
        q, a, b = stretches.T
        b = b + size
        need = np.maximum(self.min_exponent * q, self.min_length) - q
        able = b - a + 2 * (size - 1) >= need
        if able.any() and self.found:
            # A stretch inside a known run, at a multiple of its period, is that run again.
            runs = np.concatenate(self.found)
            over = self.cover[a]
            x, y, p = runs[over].T
            able &= ~((over >= 0) & (x <= a) & (y >= b + q) & (q % p == 0))
        q, a, b = q[able], a[able], b[able]
        if not len(q):
            return
        # Equal hashes are taken at their word only so far: stretches are cut where numbers differ.
        sound = np.fromiter((self._same(x, y, p) for x, y, p in zip(a.tolist(), b.tolist(), q.tolist(), strict=True)), bool, len(q))
        if not sound.all():
            parts = [np.stack([a, b, q], 1)[sound]]
            for x, y, p in np.stack([a, b, q], 1)[~sound].tolist():
                edges = np.concatenate([[x - 1], x + np.flatnonzero(self.numbers[x:y] != self.numbers[x + p : y + p]), [y]])
                parts.append(np.stack([edges[:-1] + 1, edges[1:], np.full(len(edges) - 1, p)], 1))
            a, b, q = np.concatenate(parts).T
            a, b, q = a[b > a], b[b > a], q[b > a]
        a, b = a - self._equal(a, q, -1, size), b + self._equal(b, q, 1, size)
        able = b - a >= np.maximum(self.min_exponent * q, self.min_length) - q
        q, a, b = q[able], a[able], b[able]
        # A multiple of a run's period has the run's ends.
        order = np.lexsort((q, b + q, a))
        q, a, b = q[order], a[order], b[order]
        first = np.ones(len(q), bool)
        first[1:] = (a[1:] != a[:-1]) | ((b + q)[1:] != (b + q)[:-1])
        first[first] = [p < self.ends.get((x, y + p), p + 1) for x, y, p in zip(a[first].tolist(), b[first].tolist(), q[first].tolist(), strict=True)]
        found = np.stack([a, b + q, q], 1)[first]
        known = sum(map(len, self.found))
        for i, (x, y, p) in enumerate(found.tolist()):
            self.ends[x, y] = p
            self.cover[x:y] = known + i
        if len(found):
            self.found.append(found)

    def _same(self, a: int, b: int, q: int) -> bool:
        return bool(np.array_equal(self.numbers[a:b], self.numbers[a + q : b + q]))

    def _equal(self, at: np.ndarray, q: np.ndarray, way: int, most: int) -> np.ndarray:
        """Equal numbers at distance q from a place on, going one way; fewer than `most`. Steps double."""
        done, active, step = np.zeros(len(at), np.int64), np.arange(len(at)), 1
        while len(active):
            p = at[active] + way * done[active]
            room = np.minimum(np.minimum(step, most - done[active]), p if way < 0 else self.n - p - q[active])
            lengths = np.maximum(room, 0)
            if way > 0:
                left = ragged(p, lengths)
            else:
                left = np.repeat(2 * p - 1, lengths) - ragged(p, lengths)
            same = self.numbers[left] == self.numbers[left + np.repeat(q[active], lengths)]
            # Length of the first stretch of equals of each row.
            ends = np.cumsum(lengths)
            index = np.arange(len(same)) - np.repeat(ends - lengths, lengths)
            bad = np.where(same, np.repeat(lengths, lengths), index)
            got = lengths.copy()
            filled = np.flatnonzero(lengths)
            if len(filled):
                got[filled] = np.minimum.reduceat(bad, (ends - lengths)[filled])
            done[active] += got
            active = active[(got == lengths) & (lengths == step)]
            step *= 2
        return done

    def runs(self) -> np.ndarray:
        """All runs so far as rows (start, length, period), by start and then period.

        Stretches that have not ended count up to the last number. Of the periods of one run the
        smallest stays: a run that has another period as well has the same ends for both.
        """
        kept = list(self.found), dict(self.ends), self.cover.copy()
        for level, rows in enumerate(self.open):
            self._report(level, rows)
        rows = np.concatenate([np.zeros((0, 3), np.int64), *self.found])
        self.found, self.ends, self.cover = kept
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        first = np.ones(len(rows), bool)
        first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
        rows = rows[first]
        rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
        return np.stack([rows[:, 0], rows[:, 1] - rows[:, 0], rows[:, 2]], 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIXED[0]
    return x ^ (x >> np.uint64(29))


def _joined(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of windows twice as wide; not linear, so no regular sequence makes them meet."""
    if len(hashes) <= width:
        return np.zeros(0, np.uint64)
    return _mix(hashes[: len(hashes) - width] * MIXED[1] + hashes[width:])


# ---- texts ----


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (bytes other than space and 0x09 to 0x0D) of texts, and words a text."""
    white = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, closes = ~white, ~white
    begins[1:] &= white[:-1] | edge[1 : len(data)]
    closes[:-1] &= white[1:] | edge[1 : len(data)]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each word, equal for equal words only; and the words' bytes without gaps, with offsets."""
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    packed = data[ragged(starts, lengths)]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(packed))])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64), packed, offsets


def runs_of_texts(numbers: np.ndarray, counts: np.ndarray, min_length: int, min_exponent: int, appended: int = APPENDED) -> tuple[np.ndarray, np.ndarray]:
    """Runs of texts whose words lie one after the other: text, and rows (start, length, period) in it.

    Texts of like length share a stream, in which a number of its own ends each text, so no run can go on
    from one text to the next.
    """
    owner, found = [], []
    first = np.cumsum(counts) - counts
    kind = np.frexp(counts)[1]
    for k in np.unique(kind):
        texts = np.flatnonzero((kind == k) & (counts >= min_length))
        if not len(texts):
            continue
        sizes = counts[texts] + 1
        ends = np.cumsum(sizes)
        stream = np.full(int(ends[-1]), -1, np.int64)
        stream[ends - 1] = -1 - np.arange(len(texts))
        inside = np.ones(len(stream), bool)
        inside[ends - 1] = False
        stream[inside] = numbers[ragged(first[texts], counts[texts])]
        catcher = SquareCatcher(min_length, min_exponent, int(counts[texts].max()))
        for at in range(0, len(stream), appended):
            catcher.append(stream[at : at + appended])
        rows = catcher.runs()
        text = np.searchsorted(ends, rows[:, 0], "right")
        rows[:, 0] -= (ends - sizes)[text]
        owner.append(texts[text])
        found.append(rows)
    owner = np.concatenate([np.zeros(0, np.int64), *owner])
    found = np.concatenate([np.zeros((0, 3), np.int64), *found])
    order = np.argsort(owner, kind="stable")
    return owner[order], found[order]


def collapse_runs(docs: DataFrame, min_length: int, min_exponent: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with its periodic runs of words, and its text with each run cut to one period.

    Returns the key, words (their number), runs (start, length and period in words, by start and then
    period) and collapsed (the words that stay, joined by single spaces). A run is a stretch of words whose
    smallest period is q, at least min_length words and min_exponent periods long, that no neighbouring
    word continues. A word goes if any run contains it after that run's first q words.

    Null and empty texts, and texts of white space, have no words and no runs, and an empty text. Keys may
    be null or repeat; each row is judged by itself. Whole texts are searched, a very long one in one task
    that appends it piece by piece. Other columns are not looked at; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            data, offsets = text_buffers(batch.column("_text"))
            starts, ends, counts = word_spans(data, offsets)
            numbers, packed, at = word_numbers(data, starts, ends)
            owner, rows = runs_of_texts(numbers, counts, min_length, min_exponent)
            first = np.cumsum(counts) - counts
            begin = first[owner] + rows[:, 0]
            # Words inside a run after its first period, by counting begins and ends.
            change = np.zeros(len(starts) + 1, np.int64)
            np.add.at(change, begin + rows[:, 2], 1)
            np.add.at(change, begin + rows[:, 1], -1)
            stays = np.flatnonzero(np.cumsum(change[:-1]) == 0)
            sizes = np.diff(at)[stays]
            out = np.full(int(sizes.sum()) + len(stays), 0x20, np.uint8)
            words = np.ones(len(out), bool)
            words[np.cumsum(sizes + 1) - 1] = False
            out[words] = packed[ragged(at[:-1][stays], sizes)]
            # Each text's last space is left out.
            left = np.diff(np.searchsorted(stays, np.append(first, len(starts))))
            spans = np.concatenate([[0], np.cumsum(sizes + 1)])
            row_end = spans[np.cumsum(left)]
            keep = np.ones(len(out), bool)
            keep[row_end[left > 0] - 1] = False
            text_ends = np.concatenate([[0], np.cumsum(np.diff(np.concatenate([[0], row_end])) - (left > 0))])
            texts = pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(text_ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(out[keep])))
            each = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], ["start", "length", "period"])
            per_text = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(counts) + 1)), pa.int32()), each)
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(counts.astype(np.int64)), per_text, texts.cast(pa.string())], ["_key", "words", "runs", "collapsed"])

    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kind = docs.schema[key].dataType.simpleString()
    found = map_arrow(rows, run, f"_key {kind}, words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return found.select(F.col("_key").alias(key), "words", "runs", "collapsed")
