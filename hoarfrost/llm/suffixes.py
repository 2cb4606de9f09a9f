"""Exact removal of repeated byte strings with suffix arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoarfrost.llm.common import map_arrow, pieces, ragged, release, ship, stored, text_buffers
from hoarfrost.llm.runs import word_spans
from hoarfrost.llm.tokens import FACTOR, VALUES, span_hashes

#: Bytes of an anchor; bytes of windows in a shard; different windows of one anchor in a shard.
ANCHOR_BYTES, SHARD_BYTES, SHARD_KINDS = 32, 2 << 20, 2000
#: Bytes of whole anchors that a shard sorts together: suffixes that cannot be equal need no common order.
SORTED_BYTES = 256 << 10
#: Bytes of one text whose strings choose their anchors together.
SEGMENT_BYTES = 1 << 20
#: Bytes that stand for a word where words are compared.
CODE_BYTES = 4
#: A string of a sorted run: its hash, its window, its start there, and whether its shard holds it twice.
STRING = np.dtype([("s1", "<u8"), ("s2", "<u8"), ("w1", "<i8"), ("w2", "<i8"), ("first", "<i4"), ("known", "?")])


# ---- one shard ----


def words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, zeros after the end."""
    out = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        out[: len(out) - step] = (out[: len(out) - step] << np.uint64(8 * step)) | (out[step:] if step == 1 else out[step:])
    return out[: len(text)]


def suffix_array(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Order of the suffixes of several strings that lie one after the other, each ending with a mark
    of its own that sorts before every byte (by place among equals). `left`: bytes to the string's end.

    Larsson-Sadakane refinement: suffixes are first grouped by seven bytes; then every group that has
    more than one is sorted by the groups that stand h bytes later, and h doubles. Groups of one
    take no further part.
    """
    n = len(text)
    # Seven bytes, zero after the string's end, and how many of them there are (8: more follow).
    valid = np.minimum(left, 8)
    key = words(text) >> np.uint64(8)
    cut = valid < 7
    key[cut] &= ~((np.uint64(1) << (np.uint64(8) * (7 - valid[cut]).astype(np.uint64))) - np.uint64(1))
    key = (key << np.uint64(8)) | valid.astype(np.uint64)
    order = np.argsort(key)
    sorted_ = key[order]
    ended = np.flatnonzero((sorted_ & np.uint64(255)) < 8)
    order[ended] = order[ended][np.lexsort((order[ended], sorted_[ended]))]
    first = np.ones(n, bool)
    first[1:] = (sorted_[1:] != sorted_[:-1]) | ((sorted_[1:] & np.uint64(255)) < 8)
    group = np.flatnonzero(first)
    rank = np.empty(n, np.uint32)
    rank[order] = np.repeat(group.astype(np.uint32), np.diff(np.append(group, n)))
    lone = first & np.append(first[1:], True)
    slots, h = np.flatnonzero(~lone), 7
    while len(slots):
        at = order[slots]
        both = rank[at].astype(np.uint64)
        both <<= np.uint64(32)
        both |= rank[at + h]
        by = np.argsort(both)
        at, both = at[by], both[by]
        order[slots] = at
        first = np.ones(len(at), bool)
        first[1:] = both[1:] != both[:-1]
        group = np.flatnonzero(first)
        rank[at] = np.repeat(slots[group].astype(np.uint32), np.diff(np.append(group, len(at))))
        slots = slots[~(first & np.append(first[1:], True))]
        h *= 2
    return order


def common_prefixes(text: np.ndarray, left: np.ndarray, starts: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place, the bytes that its suffix shares with the one before it in the order (Kasai).

    Going through the text, the shared length falls by at most one a step. It falls by exactly one
    where the bytes before both suffixes are equal; only the other places are compared, eight bytes at
    a time, all together.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    alone = np.ones(n, bool)
    inner = np.ones(n, bool)
    inner[starts] = False
    check = np.flatnonzero(inner & (before >= 0))
    check = check[inner[before[check]]]
    alone[check] = text[check - 1] != text[before[check] - 1]
    shared = np.zeros(n, np.int64)
    eight = words(text)
    a = np.flatnonzero(alone & (before >= 0))
    b, step = before[a], 0
    while len(a):
        differ = eight[a + step] ^ eight[b + step]
        ended = differ != 0
        if ended.any():
            d = differ[ended]
            equal = sum((d >> np.uint64(8 * k) == 0).astype(np.int64) for k in range(1, 8))
            shared[a[ended]] = step + equal
            a, b = a[~ended], b[~ended]
        step += 8
        over = np.minimum(left[a], left[b]) <= step
        shared[a[over]] = step
        a, b = a[~over], b[~over]
    shared = np.minimum(shared, np.minimum(left, np.where(before >= 0, left[before], 0)))
    last = np.maximum.accumulate(np.where(alone, np.arange(n), 0))
    return np.maximum(shared[last] - (np.arange(n) - last), 0)


def repeated_starts(windows: list[bytes], owned: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which starts of the windows begin a string of `length` bytes that begins elsewhere too.

    Window i owns its first owned[i] starts and stands for counts[i] equal ones. Returns, for every
    owned start: window, start, whether it is repeated, and whether it is the first of its group.
    """
    text = np.frombuffer(b"".join(windows), np.uint8)
    sizes = np.fromiter(map(len, windows), np.int64, len(windows))
    starts = np.cumsum(sizes) - sizes
    window = np.repeat(np.arange(len(sizes)), sizes)
    left = (starts + sizes)[window] - np.arange(len(text))
    order = suffix_array(text, left)
    shared = common_prefixes(text, left, starts, order)
    group_of = np.cumsum(shared[order] < length) - 1
    mine = np.arange(len(text)) - starts[window] < owned[window]
    weight = np.where(mine, counts[window], 0)
    total = np.bincount(group_of, weight[order], minlength=1)
    group = np.empty(len(text), np.int64)
    group[order] = group_of
    place = np.flatnonzero(mine)
    leader = np.full(int(group_of[-1]) + 1 if len(group_of) else 0, len(text), np.int64)
    np.minimum.at(leader, group[place], place)
    return window[place], place - starts[window[place]], total[group[place]] >= 2, leader[group[place]] == place


# ---- anchors ----


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring starts whose strings of `length` bytes choose the same anchor.

    A string's anchor is, of its substrings of ANCHOR_BYTES bytes, the leftmost with the smallest
    hash. Equal strings have equal anchors at equal places wherever they stand, so strings need to be
    compared only where anchors are equal. Returns text, first start, number of starts and anchor hash.
    """
    empty = np.zeros(0, np.int64)
    sizes = np.diff(offsets)
    if len(data) < length or not (sizes >= length).any():
        return empty, empty, empty, empty.view(np.uint64)
    hashes, span, factor = VALUES[data], 1, FACTOR
    while span < ANCHOR_BYTES:
        hashes = hashes[: len(hashes) - span] * np.uint64(factor) + hashes[span:]
        span, factor = 2 * span, factor * factor % (1 << 64)
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(32)
    low = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    width, span = length - ANCHOR_BYTES + 1, 1
    while 2 * span <= width:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    if width > span:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    chosen = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    doc = np.flatnonzero(sizes >= length)
    counts = sizes[doc] - length + 1
    starts = ragged(offsets[:-1][doc], counts)
    doc = np.repeat(doc, counts)
    anchor = chosen[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], starts[at], np.diff(np.append(at, len(starts))), hashes[anchor[at]]


Coder = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def word_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts as CODE_BYTES bytes of hash for each word, with new offsets."""
    starts, ends, counts = word_spans(data, offsets)
    hashes = span_hashes(data, starts, ends)
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0x94D049BB133111EB)
    codes = (hashes >> np.uint64(64 - 8 * CODE_BYTES)).astype("<u4").view(np.uint8)
    return codes, CODE_BYTES * np.concatenate([[0], np.cumsum(counts)])


def segments(offsets: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """First text and offsets of parts of a buffer: whole texts together, or overlapping parts of one long text.

    Every string of `length` bytes starts in one part only, and is whole there.
    """
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SEGMENT_BYTES, "right")) - 1)
        low, high = int(offsets[at]), int(offsets[to])
        if to > at + 1 or high - low <= SEGMENT_BYTES:
            yield at, offsets[at : to + 1]
        else:
            for first in range(low, high, SEGMENT_BYTES):
                yield at, np.array([first, min(first + SEGMENT_BYTES + length - 1, high)])
        at = to


def _windows(docs: DataFrame, length: int, coder: Coder | None) -> DataFrame:
    """A row per run of starts: doc, hash of the text, first start, starts, times, anchor and content hash.

    Where a text goes on with the same run again and again, as periodic text does, that is one row: the
    run comes `times` times, each `starts` places after the one before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in pieces(batches, "_text"):
            data, offsets = text_buffers(batch.column("_text"))
            if coder:
                data, offsets = coder(data, offsets)
            for text, part in segments(offsets, length):
                low = int(part[0])
                doc, first, n, anchor = anchors(data[low : part[-1]], part - low, length)
                raw = data[low : part[-1]].tobytes()
                digests = np.empty((len(first), 2), np.int64)
                for at in range(0, len(first), 1 << 15):
                    spans = zip(first[at : at + (1 << 15)].tolist(), n[at : at + (1 << 15)].tolist(), strict=True)
                    some = b"".join([xxh3_128_digest(raw[a : a + k + length - 1]) for a, k in spans])
                    digests[at : at + (1 << 15)] = np.frombuffer(some, np.int64).reshape(-1, 2)
                new = np.ones(len(first), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1]) | (n[1:] != n[:-1]) | (digests[1:] != digests[:-1]).any(1)
                lead = np.flatnonzero(new)
                times = np.diff(np.append(lead, len(first)))
                doc, first, n, anchor, digests = (x[lead] for x in (doc, first, n, anchor, digests))
                rows = pa.array(doc + text)
                arrays = [batch.column("_id").take(rows), batch.column("_mark").take(rows), pa.array(first + low - offsets[doc + text]), pa.array(n.astype(np.int32))]
                arrays += [pa.array(times), pa.array(anchor.view(np.int64)), pa.array(np.ascontiguousarray(digests[:, 0])), pa.array(np.ascontiguousarray(digests[:, 1]))]
                yield pa.RecordBatch.from_arrays(arrays, ["_id", "_mark", "first", "starts", "times", "anchor", "w1", "w2"])

    return map_arrow(docs, run, "_id long, _mark long, first long, starts int, times long, anchor long, w1 long, w2 long")


def _packed(docs: DataFrame, coder: Coder | None = None) -> DataFrame:
    """The texts compressed, for shuffles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=1)
        for batch in pieces(batches, "_text"):
            data, offsets = text_buffers(batch.column("_text"))
            if coder:
                data, offsets = coder(data, offsets)
            packed = pa.array([zip_.compress(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.binary())
            names = [x for x in batch.schema.names if x != "_text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), packed], [*names, "_zip"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "_text")
    return map_arrow(docs, run, f"{fields}, _zip binary")


DECIDED = pa.schema([(x, pa.int64()) for x in ("w1", "w2", "first", "starts", "anchor", "piece")] + [("run", pa.binary())])


def _decide(table: pa.Table, length: int) -> pa.Table:
    """Runs of repeated starts of each window. If the anchor is spread over shards, also all different
    strings of the block, as sorted runs that are cut where the other shards' runs are cut."""
    from xxhash import xxh3_128_digest

    contents = table.column("content").to_pylist()
    w1, w2, anchor, parts = (table.column(x).to_numpy() for x in ("w1", "w2", "anchor", "parts"))
    window, start, repeated, leader = repeated_starts(contents, table.column("starts").to_numpy().astype(np.int64), table.column("n").to_numpy(), length)
    hit = np.flatnonzero(repeated)
    new = np.ones(len(hit), bool)
    new[1:] = (window[hit][1:] != window[hit][:-1]) | (start[hit][1:] != start[hit][:-1] + 1)
    first = np.flatnonzero(new)
    runs, sizes = hit[first], np.diff(np.append(first, len(hit)))
    n = len(runs)
    none = pa.nulls(n, pa.int64())
    out = pa.table([pa.array(w1[window[runs]]), pa.array(w2[window[runs]]), pa.array(start[runs]), pa.array(sizes), none, none, pa.nulls(n, pa.binary())], schema=DECIDED)
    if not len(contents) or parts[0] == 1:
        return out
    at = np.flatnonzero(leader)
    strings = np.empty(len(at), STRING)
    digests = b"".join([xxh3_128_digest(contents[w][s : s + length]) for w, s in zip(window[at].tolist(), start[at].tolist(), strict=True)])
    strings["s1"], strings["s2"] = np.frombuffer(digests, np.uint64).reshape(-1, 2).T
    strings["w1"], strings["w2"], strings["first"], strings["known"] = w1[window[at]], w2[window[at]], start[at], repeated[at]
    strings = strings[np.lexsort((strings["s2"], strings["s1"]))]
    piece = ((strings["s1"] >> np.uint64(32)) * np.uint64(parts[0]) >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
    packed = [x.tobytes() for x in np.split(strings, cuts[1:])]
    none = pa.nulls(len(cuts), pa.int64())
    more = pa.table([none, none, none, none, pa.array(np.full(len(cuts), anchor[0])), pa.array(piece[cuts]), pa.array(packed, pa.binary())], schema=DECIDED)
    return pa.concat_tables([out, more])


def late_repeats(runs: list[np.ndarray]) -> np.ndarray:
    """Strings that are in one sorted run only once, but in other runs too, by binary search of each run
    in all others. A string is in a run once at most."""
    late = []
    for i, run in enumerate(runs):
        there = np.zeros(len(run), bool)
        for j, other in enumerate(runs):
            if i == j or not len(other):
                continue
            at = np.searchsorted(other["s1"], run["s1"])
            while True:
                inside = np.minimum(at, len(other) - 1)
                alike = (at < len(other)) & (other["s1"][inside] == run["s1"])
                there |= alike & (other["s2"][inside] == run["s2"])
                # Where only the first halves are equal, the next string of the run may be the one.
                on = alike & (other["s2"][inside] < run["s2"])
                if not on.any():
                    break
                at = at + on
        late.append(run[there & ~run["known"]])
    return np.concatenate(late) if late else np.zeros(0, STRING)


def repeated_spans(docs: DataFrame, length: int, shard_bytes: int = SHARD_BYTES, shard_kinds: int = SHARD_KINDS, coder: Coder | None = None) -> DataFrame:
    """Starts of repeated strings, for rows with _id, _mark and _text: _id, _mark and spans (begin, end).
    With a coder, strings and spans are those of the coded texts.

    Runs of starts whose anchor occurs once in the corpus are done with. Of the others, equal windows
    are counted and kept once. The windows that are left are dealt to shards by anchor, so that equal
    strings meet, and each shard is decided by its suffix array. An anchor with more than
    `shard_kinds` different windows is spread over several shards; their sorted strings are then
    merged by binary search.
    """
    spark = docs.sparkSession
    rows = stored(_windows(docs, length, coder), "windows")
    again = stored(rows.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1").select("anchor"), "anchors")
    members = stored(rows.join(again, "anchor", "left_semi"), "members")
    kinds = members.groupBy("anchor", "w1", "w2").agg(F.sum("times").alias("n"), F.min(F.struct("_id", "_mark", "first", "starts")).alias("r"))
    kinds = stored(kinds.select("anchor", "w1", "w2", "n", "r.*"), "kinds")
    total = kinds.agg(F.sum(F.col("starts") + length)).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-total // shard_bytes), min(partitions, -(-total // (64 << 10))))
    shard_kinds = min(shard_kinds, max(64, kinds.count() // partitions))
    split = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > shard_kinds)
    split = stored(split.select(F.col("anchor").alias("of"), F.ceil(F.col("k") / shard_kinds).alias("parts")), "split")
    dealt = kinds.join(split, F.col("anchor") == F.col("of"), "left")
    part = F.pmod(F.xxhash64("w1", "w2"), F.coalesce("parts", F.lit(1)))
    # A shard below zero holds a part of one split anchor.
    shard = F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("anchor"), F.lit(shards))).otherwise(-1 - F.shiftrightunsigned(F.xxhash64("anchor", part), 1))
    dealt = dealt.select("_id", "_mark", F.struct("first", "starts", shard.alias("shard"), "anchor", F.coalesce("parts", F.lit(1)).alias("parts"), "w1", "w2", "n").alias("w"))
    wanted = dealt.groupBy(F.col("_id").alias("_of"), F.col("_mark").alias("_at")).agg(F.collect_list("w").alias("ws"))
    same = F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_mark") == F.col("_at"))
    held = _packed(docs, coder).join(stored(wanted, "wanted"), same).select("_zip", "ws")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                text = unzip.decompress(batch.column("_zip")[i].as_py())
                ws = pa.RecordBatch.from_struct_array(batch.column("ws")[i].values)
                spans = zip(ws.column("first").to_pylist(), ws.column("starts").to_pylist(), strict=True)
                content = pa.array([text[a : a + n + length - 1] for a, n in spans], pa.binary())
                names = ["shard", "anchor", "parts", "w1", "w2", "n", "starts"]
                yield pa.RecordBatch.from_arrays([*(ws.column(x) for x in names), content], [*names, "content"])

    windows = map_arrow(held, cut, "shard long, anchor long, parts long, w1 long, w2 long, n long, starts int, content binary")

    def decide(table: pa.Table) -> pa.Table:
        table = table.sort_by("anchor").combine_chunks()
        anchor, sizes = table.column("anchor").to_numpy(), pc.binary_length(table.column("content")).to_numpy()
        # Cuts between anchors, after each further SORTED_BYTES.
        at = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if len(anchor) else np.zeros(0, np.int64)
        block = (np.cumsum(sizes) - sizes)[at] // SORTED_BYTES
        cuts = at[np.append(True, block[1:] != block[:-1])] if len(at) else at
        parts = [_decide(table.slice(a, b - a), length) for a, b in zip(cuts, np.append(cuts[1:], len(anchor)), strict=True)]
        release()
        return pa.concat_tables(parts) if parts else DECIDED.empty_table()

    ship(spark)
    decided = windows.groupBy("shard").applyInArrow(decide, "w1 long, w2 long, first long, starts long, anchor long, piece long, run binary")
    decided = stored(decided, "decided")
    found = decided.where("run IS NULL").select("w1", "w2", "first", "starts")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            for anchor, piece, run in zip(*(batch.column(x).to_pylist() for x in ("anchor", "piece", "run")), strict=True):
                runs.setdefault((anchor, piece), []).append(np.frombuffer(run, STRING))
        for late in map(late_repeats, runs.values()):
            columns = [pa.array(late[x].astype(np.int64)) for x in ("w1", "w2", "first")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.ones(len(late), np.int64))], ["w1", "w2", "first", "starts"])

    late = map_arrow(decided.where("run IS NOT NULL").select("anchor", "piece", "run").repartition("anchor", "piece"), merge, "w1 long, w2 long, first long, starts long")
    found = found.unionByName(late).groupBy("w1", "w2").agg(F.collect_list(F.struct("first", "starts")).alias("runs"))
    found = stored(found.select(F.col("w1").alias("f1"), F.col("w2").alias("f2"), "runs"), "repeated")
    # A window that very many documents hold is joined once for each bucket of them, not once for each.
    # A bucket's documents are then put together in one task: a row each, however many windows they have.
    bucket = F.pmod(F.xxhash64("_id", "_mark"), F.lit(max(partitions, members.count() // 5000)))
    holders = members.groupBy("w1", "w2", bucket.alias("p")).agg(
        F.collect_list(F.struct("_id", "_mark", F.col("first").alias("at"), (F.col("starts") * (F.col("times") - 1)).alias("on"))).alias("held")
    )
    holders = stored(holders, "holders").join(found, (F.col("w1") == F.col("f1")) & (F.col("w2") == F.col("f2")))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            held, runs = batch.column("held"), batch.column("runs")
            one, other = (np.diff(x.offsets.to_numpy()).astype(np.int64) for x in (held, runs))
            held, runs = held.flatten(), runs.flatten()
            # Every holder of a window with every run of the window.
            left = np.repeat(np.arange(len(held)), np.repeat(other, one))
            right = ragged(np.repeat(np.cumsum(other) - other, one), np.repeat(other, one))
            ids = held.field("_id").take(pa.array(left))
            at, on, first, starts = (x.to_numpy() for x in (held.field("at"), held.field("on"), runs.field("first"), runs.field("starts")))
            # A run that comes again after fewer places than its strings are long is one span.
            begin = at[left] + first[right]
            end = begin + on[left] + starts[right] + length - 1
            columns = [ids.is_valid().to_numpy(zero_copy_only=False).astype(np.int64), ids.fill_null(0).to_numpy(), held.field("_mark").to_numpy()[left], begin, end]
            parts.append(unions(np.stack(columns, 1)))
        rows = unions(np.concatenate([np.zeros((0, 5), np.int64), *parts]))
        lead = np.flatnonzero(np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(1))) if len(rows) else np.zeros(0, np.int64)
        spans = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in (3, 4)], ["begin", "end"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(lead, len(rows)), pa.int32()), spans)
        yield pa.RecordBatch.from_arrays([pa.array(rows[lead, 1], mask=rows[lead, 0] == 0), pa.array(rows[lead, 2]), lists], ["_id", "_mark", "spans"])

    placed = map_arrow(holders.select("p", "held", "runs").repartition("p"), gather, "_id long, _mark long, spans array<struct<begin:bigint,end:bigint>>")
    return stored(placed.groupBy("_id", "_mark").agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")


def unions(rows: np.ndarray) -> np.ndarray:
    """Rows (three names, begin, end) by name and begin, those of one name that overlap or touch as one."""
    if len(rows) < 2:
        return rows
    rows = rows[np.lexsort(rows[:, ::-1].T)]
    named = np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(1))
    # The furthest end so far in each name: ends are made to grow from name to name.
    lift = (np.cumsum(named) - 1) * (int(rows[:, 4].max()) + 1)
    furthest = np.maximum.accumulate(rows[:, 4] + lift) - lift
    new = named.copy()
    new[1:] |= rows[1:, 3] > furthest[:-1]
    lead = np.flatnonzero(new)
    out = rows[lead].copy()
    out[:, 4] = furthest[np.append(lead[1:], len(rows)) - 1]
    return out


def union_of(spans: list[dict[str, int]]) -> list[dict[str, int]]:
    """Overlapping and touching spans as one, in order."""
    out: list[dict[str, int]] = []
    for s in sorted(spans, key=lambda x: x["begin"]):
        if out and s["begin"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
        else:
            out.append(dict(s))
    return out


SPANS = "array<struct<begin:bigint,end:bigint>>"


def _with_spans(docs: DataFrame, length: int, key: str, text: str, carry: Sequence[str], coder: Coder | None, **sizes: int) -> DataFrame:
    """_id, the carried columns as _c0 and so on, _zip (the text) and its spans."""
    mark = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    kept_columns = [F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)]
    rows = docs.select(F.col(key).cast("long").alias("_id"), mark.alias("_mark"), F.coalesce(F.col(text), F.lit("")).alias("_text"), *kept_columns)
    spans = repeated_spans(rows.select("_id", "_mark", "_text"), length, coder=coder, **sizes)
    spans = spans.select(F.col("_id").alias("_of"), F.col("_mark").alias("_at"), "spans")
    return _packed(rows).join(spans, F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_mark") == F.col("_at")), "left").drop("_of", "_at", "_mark")


def _cut(joined: DataFrame, text: bool, ranges: Callable[[np.ndarray, list[dict[str, int]]], list[dict[str, int]]] | None = None) -> DataFrame:
    """The texts without their spans: kept, n_bytes, spans, and with `text` kept_text."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            kept, sizes, removed = [], [], []
            for i, packed in enumerate(batch.column("_zip")):
                data = unzip.decompress(packed.as_py())
                runs, at, parts = union_of(batch.column("spans")[i].as_py() or []), 0, []
                if ranges and runs:
                    runs = ranges(np.frombuffer(data, np.uint8), runs)
                for s in runs:
                    parts.append(data[at : s["begin"]])
                    at = s["end"]
                kept.append(b"".join([*parts, data[at:]]))
                sizes.append(len(data))
                removed.append(runs)
            names = [x for x in batch.schema.names if x not in ("_zip", "spans")]
            columns = [*(batch.column(x) for x in names), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(removed, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))]
            if text:
                columns.append(pa.array([x.decode(errors="ignore") for x in kept], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [*names, "kept", "n_bytes", "spans", *["kept_text"][: int(text)]])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema if f.name not in ("_zip", "spans"))
    return map_arrow(joined, take, f"{fields}, kept binary, n_bytes long, spans {SPANS}{', kept_text string' if text else ''}")


def remove_repeats(docs: DataFrame, length: int, key: str = "doc_id", text: str = "text", carry: Sequence[str] = (), as_text: bool = False, **sizes: int) -> DataFrame:
    """Every document without the bytes of any `length`-byte string that also starts elsewhere.

    Returns the key, the columns in `carry`, kept (the remaining bytes, which may cut a character), n_bytes
    (of the whole text) and spans (maximal removed runs, begin and end in bytes); with `as_text` also
    kept_text, the remaining text without such parts of characters. All places of a repeated string are
    removed, in the same document or in others; strings are judged on the input.

    Null texts are empty, shorter texts are kept whole. Rows that are equal in key and text are
    separate documents, so all their long strings repeat. Null keys are allowed.
    """
    out = _cut(_with_spans(docs, length, key, text, carry, None, **sizes), as_text)
    return out.select(F.col("_id").alias(key), *(F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)), "kept", "n_bytes", "spans", *["kept_text"][: int(as_text)])


def remove_repeated_words(docs: DataFrame, words: int, key: str = "doc_id", text: str = "text", carry: Sequence[str] = (), **sizes: int) -> DataFrame:
    """Every document without any `words` consecutive words that also stand elsewhere.

    As remove_repeats, but strings are compared word by word (bytes other than white space), so what
    lies between the words does not count. Words are compared by hashes of CODE_BYTES bytes, all of a
    string's together. A removed run ends where the next word that stays begins, or with the text.
    Returns the key, the columns in `carry`, kept_text, n_bytes and spans (in bytes of the text).
    """

    def ranges(data: np.ndarray, runs: list[dict[str, int]]) -> list[dict[str, int]]:
        starts = np.append(word_spans(data, np.array([0, len(data)]))[0], len(data))
        whole = [(-(-s["begin"] // CODE_BYTES), s["end"] // CODE_BYTES) for s in runs]
        return [{"begin": int(starts[a]), "end": int(starts[b])} for a, b in whole if b - a >= words]

    out = _cut(_with_spans(docs, CODE_BYTES * words, key, text, carry, word_codes, **sizes), True, ranges)
    return out.select(F.col("_id").alias(key), *(F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)), "kept_text", "n_bytes", "spans")
