"""Minimum bin slack: pack pieces of documents into as few sequences as possible."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoarfrost.llm.common import gapless, map_arrow, pieces, stored, text_buffers
from hoarfrost.llm.tokens import crc_of, encoder, with_end

PIECE_SCHEMA = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> list[int]:
    """Lengths whose sum comes nearest to `room` without passing it, by a subset-sum bitset.

    Bit s of the set says that some combination sums to s. Lengths are added from the longest to the
    shortest, each as often as it is there and fits; the sets before each step lead back to one
    combination. It ends early when the room is filled without slack.
    """
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in lengths:
        for _ in range(min(counts[length], room // length)):
            more = (reach | reach << length) & mask
            if more == reach:
                break
            steps.append((length, reach))
            reach = more
        if reach >> room:
            break
    best, chosen = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        if not before >> best & 1:
            chosen.append(length)
            best -= length
    return chosen


def plan_bins(histogram: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins for all pieces, from the number of pieces of each length: (how many bins, [(length, times)]).

    Each bin takes the longest piece left and the fullest combination of others beside it. The same
    combination is used as often as the pieces allow, so there are at most a few bins' worth of plans
    per length, however many pieces there are.
    """
    left, out = {k: v for k, v in histogram.items() if v}, []
    while left:
        lengths = sorted(left, reverse=True)
        longest = lengths[0]
        left[longest] -= 1
        chosen = fullest([x for x in lengths if left[x]], left, size - longest) if longest < size else []
        left[longest] += 1
        need: dict[int, int] = {}
        for x in (longest, *chosen):
            need[x] = need.get(x, 0) + 1
        times = min(left[x] // n for x, n in need.items())
        out.append((times, sorted(need.items(), reverse=True)))
        for x, n in need.items():
            left[x] -= times * n
            if not left[x]:
                del left[x]
    return out


def token_pieces(docs: DataFrame, tokenizer: str, end: int, size: int, key: str = "doc_id", text: str = "text", lower: bool = True) -> DataFrame:
    """Every document as ids with `end` after them, cut into pieces of `size` where longer: one row each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        tool = encoder(tokenizer, lower, special=True)
        for batch in pieces(batches, text, 1 << 20):
            ids, offsets = with_end(*tool.encode(*text_buffers(batch.column(text))), end)
            counts = np.diff(offsets)
            parts = -(-counts // size)
            doc = np.repeat(np.arange(len(counts)), parts)
            number = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = number * size
            length = np.minimum(size, counts[doc] - start)
            at = offsets[doc] + start
            crcs = [crc_of(ids[a : a + n]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            keys = batch.column(key).take(pa.array(doc))
            arrays = [pa.array(np.arange(row, row + len(doc))), keys, pa.array(number.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crcs, pa.int64())]
            row += len(doc)
            yield pa.RecordBatch.from_arrays(arrays, ["row", "doc_id", "piece", "start", "length", "ids_crc32"])

    return map_arrow(docs.select(F.col(key).cast("long").alias(key), text), cut, PIECE_SCHEMA, keeps=True)


def pack(items: DataFrame, size: int) -> DataFrame:
    """Sequences for a stored table of pieces with row (unique) and length (1 to `size`).

    What decides is the histogram of lengths, at most `size` numbers. The plan made from it says which
    bins the first, second, ... piece of each length goes to; every piece then finds its own place from
    its number among the pieces of its length. Adds sequence_id and offset (gapless from 0).
    """
    histogram = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_length: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    bins = 0
    for times, needs in plan_bins(histogram, size):
        offset = 0
        for length, n in needs:
            first = used.get(length, 0)
            by_length.setdefault(length, []).append((first, n, bins, offset))
            used[length] = first + times * n
            offset += length * n
        bins += times
    table = {length: np.array(rows, np.int64) for length, rows in by_length.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(x).to_numpy() for x in ("length", "_rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, edges) if len(order) else []:
                plan = table[int(length[rows[0]])]
                step = plan[np.searchsorted(plan[:, 0], rank[rows], "right") - 1]
                within = rank[rows] - step[:, 0]
                sequence[rows] = step[:, 2] + within // step[:, 1]
                offset[rows] = step[:, 3] + within % step[:, 1] * length[rows]
            columns = [c for c, name in zip(batch.columns, batch.schema.names, strict=True) if name != "_rank"]
            names = [x for x in batch.schema.names if x != "_rank"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema) + ", sequence_id long, offset long"
    return map_arrow(gapless(items, "length", "row", "_rank"), place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end: int, size: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack whole documents: doc_id, piece, start, length, ids_crc32, sequence_id and offset per piece.

    A null or empty text is one piece, its end id. Repeated rows and null keys are documents of their
    own. An empty table gives no rows. Only documents longer than `size` ids are cut.
    """
    items = stored(token_pieces(docs, tokenizer, end, size, key, text), "pieces")
    return pack(items, size).drop("row")
