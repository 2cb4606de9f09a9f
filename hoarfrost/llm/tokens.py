"""Token ids of whole texts from a tokenizers file, each distinct piece being encoded once per worker.

A byte-pair tokenizer first splits a text into pieces (words, numbers, marks) and then encodes each
piece by itself. Here the split is done for many texts at once on their bytes, and the library encodes
only pieces that this worker has not seen yet. Texts with characters beyond Latin-1, or with unusual
white space, are handed to the library whole. The ids are the library's in either case.
"""

from __future__ import annotations

import os
import unicodedata
import zlib

import numpy as np
import pyarrow as pa

from hoarfrost.llm.common import CACHES, ragged

#: Pieces that a worker remembers, at about 50 bytes each. Later ones are encoded again when met.
REMEMBERED = 1 << 20

SPACE, WHITE, LETTER, NUMBER, OTHER = 1, 0, 2, 3, 4


def _classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each Latin-1 character; its lower case; whether a text that holds it goes to the library."""
    kind, lower, odd = (np.zeros(256, t) for t in (np.uint8, np.uint8, bool))
    for code in range(256):
        char, category = chr(code), unicodedata.category(chr(code))
        kind[code] = LETTER if category[0] == "L" else NUMBER if category[0] == "N" else OTHER
        if char in " \t\n\r":
            kind[code] = SPACE if char == " " else WHITE
        elif char.isspace() or category == "Cc":
            odd[code] = True
        lower[code] = ord(char.lower()) if len(char.lower()) == 1 and ord(char.lower()) < 256 else code
    return kind, lower, odd


KIND, LOWER, ODD = _classes()
#: Random odd factor and byte values of the piece hash.
FACTOR = 0x9E3779B97F4A7C15
VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes of text that are hashed together, so that the powers for them stay small.
HASHED_BYTES = 1 << 18
_powers: list[np.ndarray] = []
CACHES.append(_powers)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """FACTOR ** i and its inverse modulo 2 ** 64, for i below n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, HASHED_BYTES + 1)
        both = []
        for base in (FACTOR, pow(FACTOR, -1, 1 << 64)):
            out = np.empty(size, np.uint64)
            out[0], have, step = 1, 1, base
            while have < size:
                more = min(have, size - have)
                out[have : have + more] = out[:more] * np.uint64(step)
                have, step = have + more, step * step % (1 << 64)
            both.append(out)
        _powers[:] = both
    return _powers[0], _powers[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, independent of where it stands. Spans are in order and
    do not overlap; some at a time are hashed together, whatever the length of the text."""
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        low = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, low + HASHED_BYTES, "right")))
        high = int(ends[to - 1])
        up, down = powers(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(VALUES[data[low:high]] * up[: high - low], out=sums[1:])
        out[at:to] = (sums[ends[at:to] - low] - sums[starts[at:to] - low]) * down[starts[at:to] - low]
        at = to
    return out


def _contractions(data: np.ndarray, kind: np.ndarray, first: np.ndarray, after_space: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of an apostrophe that begins a piece 's 't 'm 'd 're 've 'll, and the lengths of what follows it."""
    n = len(data)
    at = np.flatnonzero(data[: max(n - 1, 0)] == 0x27)
    alone = (first[at] | (kind[at - 1] != OTHER)) & (kind[at + 1] == LETTER) & ~first[at + 1]
    if not after_space:
        alone &= first[at] | (kind[at - 1] != SPACE)
    at = at[alone]
    one, two = data[at + 1], np.where(at + 2 < n, data[np.minimum(at + 2, n - 1)], 0)
    two = np.where((at + 2 < n) & ~first[np.minimum(at + 2, n - 1)], two, 0)
    length = np.where(np.isin(one, np.frombuffer(b"stmd", np.uint8)), 1, 0)
    pairs = ((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)
    length = np.where((length == 0) & pairs, 2, length)
    return at[length > 0], length[length > 0]


def split(data: np.ndarray, begins: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of texts that lie one after the other. `begins`: where a (non-empty) text starts.

    Returns the bytes (in lower case if asked), and starts and ends of the pieces. With `lower`, white
    space belongs to no piece and each number sign is one; else a space stands before its piece.
    """
    n = len(data)
    code = data.astype(np.uint16)
    lead = np.flatnonzero(data >= 0xC0)
    code[lead] = ((code[lead] & 0x03) << 6) | (code[lead + 1] & 0x3F)
    code[lead + 1] = code[lead]
    if lower:
        data, small = data.copy(), LOWER[code]
        ascii_only = np.ones(n, bool)
        ascii_only[lead] = ascii_only[lead + 1] = False
        data[ascii_only] = small[ascii_only]
        data[lead + 1] = (small[lead] & 0x3F) | 0x80
        data[lead] = 0xC0 | (small[lead] >> 6)
        code = small
    kind = KIND[code]
    first = np.zeros(n, bool)
    first[begins] = True
    white = kind <= SPACE
    group = np.where(white, 0, kind)
    run = first.copy()
    run[1:] |= group[1:] != group[:-1]
    if lower:
        number = kind == NUMBER
        number[lead + 1] = False
        run |= number
    else:
        # The last white character before a word is a piece of its own, or part of the word if a space.
        words = np.flatnonzero(run & ~white & ~first)
        words = words[white[words - 1]]
        run[words[kind[words - 1] == SPACE]] = False
        run[words - 1] = True
    at, length = _contractions(data, kind, first, after_space=lower)
    run[at + 1] = False
    rest = at + 1 + length
    rest = rest[rest < n]
    run[rest[(kind[rest] == LETTER) & ~first[rest]]] = True
    starts = np.flatnonzero(run)
    ends = np.append(starts[1:], n)
    if lower:
        keep = ~white[starts]
        starts, ends = starts[keep], ends[keep]
    return data, starts, ends


class Table:
    """Numbers of the hashes that were added, in the order of adding; open addressing in flat arrays of
    twice the most hashes (a power of two)."""

    def __init__(self, most: int):
        self.keys, self.numbers = (np.zeros(2 * most, t) for t in (np.uint64, np.int32))
        self.size = 0

    def _place(self, keys: np.ndarray) -> np.ndarray:
        mixed = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        return (mixed >> np.uint64(65 - len(self.keys).bit_length())).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where it isn't there. No hash is zero."""
        out, rows, at = np.full(len(keys), -1, np.int64), np.arange(len(keys)), self._place(keys)
        while len(rows):
            there = self.keys[at]
            hit = there == keys[rows]
            out[rows[hit]] = self.numbers[at[hit]]
            more = ~hit & (there != 0)
            rows, at = rows[more], (at[more] + 1) % len(self.keys)
        return out

    def add(self, keys: np.ndarray) -> None:
        """Add distinct hashes that are not there yet."""
        numbers, at = np.arange(self.size, self.size + len(keys), dtype=np.int32), self._place(keys)
        self.size += len(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] == 0)
            self.keys[at[free]] = keys[free]
            mine = np.zeros(len(keys), bool)
            mine[free] = self.keys[at[free]] == keys[free]
            self.numbers[at[mine]] = numbers[mine]
            keys, numbers, at = keys[~mine], numbers[~mine], (at[~mine] + 1) % len(self.keys)


class Encoder:
    """Ids of whole texts by a tokenizers file. Its special strings are ordinary text, or with `special`
    what the library's plain call makes of them."""

    def __init__(self, path: str, lower: bool, special: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = not special
        added = self.library.get_added_tokens_decoder().values() if special else ()
        self.literals = [x.content.encode() for x in added]
        self.lower = lower
        self.known = Table(REMEMBERED)
        self.starts, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.ids, self.used = np.zeros(1 << 18, np.uint32), 0

    def _whole(self, texts: list[str]) -> list[list[int]]:
        encode = self.library.encode_batch_fast
        return [x.ids for at in range(0, len(texts), 4096) for x in encode(texts[at : at + 4096], add_special_tokens=False)]

    def _keep(self, ids: list[list[int]], at: int) -> None:
        flat = np.array([i for x in ids for i in x], np.uint32)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        while at + len(ids) > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.lengths[at : at + len(ids)] = lengths
        self.starts[at : at + len(ids)] = self.used + np.cumsum(lengths) - lengths
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)

    def _split_ids(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and for each text the number of ids before it."""
        data, starts, ends = split(data, begins, self.lower)
        hashes = span_hashes(data, starts, ends) | np.uint64(1)
        coded = pa.array(hashes).dictionary_encode()
        codes, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy()
        found = self.known.find(distinct)
        new = np.flatnonzero(found < 0)
        mark, used = self.known.size, self.used
        if len(new):
            example = np.empty(len(distinct), np.int64)
            example[codes[::-1]] = np.arange(len(codes))[::-1]
            raw, where = data.tobytes(), example[new]
            texts = [raw[a:b].decode() for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
            self._keep(self._whole(texts), mark)
            found[new] = mark + np.arange(len(new))
        slots = found[codes]
        lengths = self.lengths[slots]
        ids = self.ids[ragged(self.starts[slots], lengths)]
        before = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(starts, begins)]
        room = max(0, REMEMBERED - mark)
        kept = new[:room]
        self.known.add(distinct[kept])
        if len(kept) < len(new):
            # The ids of pieces that are not remembered were needed this once.
            self.used = int(self.starts[mark + len(kept)]) if len(kept) else used
        return ids, before

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in a buffer one after the other (uint32), and each text's offset among them."""
        lengths = np.diff(offsets)
        hard = np.zeros(len(data), bool)
        odd = np.zeros(256, bool)
        odd[:128], odd[0xC4:] = ODD[:128], True
        hard |= odd[data]
        lead = np.flatnonzero((data == 0xC2) | (data == 0xC3))
        hard[lead] |= ODD[((data[lead] & 3) << 6) | (data[lead + 1] & 0x3F)]
        bad = np.zeros(len(data) + 1, np.int64)
        np.cumsum(hard, out=bad[1:])
        odd_rows = bad[offsets[1:]] > bad[offsets[:-1]]
        raw = data.tobytes() if self.literals else b""
        for literal in self.literals:
            at = raw.find(literal)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, "right")) - 1
                odd_rows[row] = True
                at = raw.find(literal, int(offsets[row + 1]))
        plain = np.flatnonzero((lengths > 0) & ~odd_rows)
        if odd_rows.any():
            easy = data[ragged(offsets[:-1][plain], lengths[plain])]
        else:
            easy = data
        counts, flat = np.zeros(len(lengths), np.int64), np.zeros(0, np.uint32)
        if len(plain):
            begins = np.cumsum(lengths[plain]) - lengths[plain]
            flat, before = self._split_ids(easy, begins)
            counts[plain] = np.diff(np.append(before, len(flat)))
        if odd_rows.any():
            rows = np.flatnonzero(odd_rows)
            found = self._whole([data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in rows])
            counts[rows] = [len(x) for x in found]
            out = np.empty(counts.sum(), np.uint32)
            places = np.cumsum(counts) - counts
            out[ragged(places[plain], counts[plain])] = flat
            for i, ids in zip(rows, found, strict=True):
                out[places[i] : places[i] + len(ids)] = ids
            flat = out
        return flat, np.concatenate([[0], np.cumsum(counts)])


_encoders: dict[tuple[str, bool, bool], Encoder] = {}
CACHES.append(_encoders)


def encoder(path: str, lower: bool, special: bool = False) -> Encoder:
    """This worker's encoder for a file."""
    if (path, lower, special) not in _encoders:
        _encoders[path, lower, special] = Encoder(path, lower, special)
    return _encoders[path, lower, special]


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with one more at the end of each text."""
    out = np.full(len(ids) + len(offsets) - 1, end, np.uint32)
    counts = np.diff(offsets)
    moved = offsets + np.arange(len(offsets))
    out[ragged(moved[:-1], counts)] = ids
    return out, moved


def crc_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))
