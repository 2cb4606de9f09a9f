"""Corpus operators against brute-force versions, exact round trips and hard inputs."""

import collections
import random
import re
import time
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from hoarfrost.llm import dom, leaks, packing, quality, queries, separators, sharding, simhash, suffixes, wavelet
from hoarfrost.llm.common import new_folder, text_buffers
from hoarfrost.llm.tokens import Encoder

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, score int"
LONG = " ".join(f"word{i}" for i in range(3000))
HARD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, LONG), (6, LONG), (6, LONG), (None, "null key"), (8, "é ß 中 \x00 ' 's don't"), (9, "Ä!! " * 300)]


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame([(k, t, None, None, None, "x", 1) for k, t in HARD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(spark):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


@pytest.mark.parametrize(("name", "lower"), [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_ids_are_the_library_s(name, lower):
    random.seed(1)
    bits = ["a", "b", " ", "\n", "'", "'s", "'re", "don't", "9", "!", "é", "É", "²", "½", "\t", " '", "中", " ", "́", "<|endoftext|>", "Σ", "µ", "\x1c", "Ÿ"]
    some = ["".join(random.choices(bits, k=random.randint(0, 12))) for _ in range(4000)]
    tool = Encoder(public_tokenizers.path(name), lower)
    ids, at = tool.encode(*text_buffers(pa.array(some)))
    want = [x.ids for x in tool.library.encode_batch(some, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == want


def test_special_strings_are_the_plain_call_s(spark):
    some = ["a<|endoftext|>b", "<|startoftext|>", "plain", "", "<|endoftext|><|endoftext|> x", "<|end", "oftext|>", "É <|endoftext|>"]
    df = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    for name, end, found in (("byte_bpe_50k.json", 2, lambda p: wavelet.index_documents(df, p, 2)), ("word_bpe_49k.json", 1, lambda p: packing.pack_documents(df, p, 1, 100))):
        path = public_tokenizers.path(name)
        plain = Tokenizer.from_file(path)
        want = {k: crc(plain.encode(t, add_special_tokens=False).ids + [end]) for k, t in enumerate(some)}
        got = found(path)
        assert {r[0]: r[1] for r in got.select("doc_id", [c for c in got.columns if "crc" in c][0]).collect()} == want


def test_rendezvous_moves_rows_only_to_the_new_shard(spark, hard, empty):
    rows = sharding.shard_records(spark.range(3000).selectExpr("id AS doc_id", "string(id) AS text"), [1.0] * 7).collect()
    assert all(r.grown_shard in (r.shard, 7) for r in rows) and any(r.grown_shard == 7 for r in rows)
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.text_crc32 == zlib.crc32(str(r.doc_id).encode()) and r.size == 16 + len(str(r.doc_id))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    weighted = sharding.shard_records(spark.range(3000).selectExpr("id AS doc_id", "'' AS text"), [1.0, 3.0]).where("shard = 1").count()
    assert 2100 < weighted < 2400
    assert sharding.shard_records(hard, [1.0] * 3).count() == len(HARD) and sharding.shard_records(empty, [1.0]).count() == 0


def repeats(values, length):
    count = collections.Counter(t[i : i + length] for t in values for i in range(len(t) - length + 1))
    out = []
    for t in values:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append(bytes(b for b, x in zip(t, gone, strict=True) if not x))
    return out


@pytest.mark.parametrize("kinds", [2000, 8])
def test_repeats_are_removed_exactly(spark, kinds):
    random.seed(5)
    words = lambda n: " ".join("".join(random.choices("abcdefgh", k=random.randint(2, 9))) for _ in range(n))
    shared = words(120)
    some = [f"{words(30)} {shared if random.random() < 0.5 else shared[: random.randint(380, 420)]} {words(random.randint(0, 60))}" for _ in range(300)]
    some += [t for _, t in texts(spark)]
    df = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in suffixes.remove_repeats(df, 400, shard_kinds=kinds).collect()}
    assert [got[i] for i in range(len(some))] == repeats([t.encode() for t in some], 400)


def without_repeated_words(values, n):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in values]
    count = collections.Counter(tuple(w[i : i + n]) for w in split for i in range(len(w) - n + 1))
    out = []
    for t, w in zip(values, split, strict=True):
        gone = {j for i in range(len(w) - n + 1) if count[tuple(w[i : i + n])] > 1 for j in range(i, i + n)}
        at = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", t)] + [len(t)]
        cut = t[: at[0]] + "".join(t[at[i] : at[i + 1]] for i in range(len(w)) if i not in gone)
        out.append(cut)
    return out


def test_repeated_words_are_removed_exactly(spark, hard, empty):
    random.seed(6)
    words = lambda n: [random.choice("abcd") * random.randint(1, 9) for _ in range(n)]
    shared, gaps = words(70), (" ", "\n", " \t ")
    some = []
    for _ in range(200):
        part = shared[: random.randint(49, 70)] if random.random() < 0.5 else shared[random.randint(0, 20) :]
        some.append("".join(w + random.choice(gaps) for w in [*words(30), *part, *words(random.randint(0, 40))]))
    some += [t for _, t in texts(spark)] + ["", " \n", "é " * 300, "one two", "x y " * 400]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(some)], "doc_id long, text string")
    found = suffixes.remove_repeated_words(df, 51).collect()
    got = {r.doc_id: r.kept_text for r in found}
    assert [got[i] for i in range(len(some))] == without_repeated_words(some, 51)
    kept = sorted((str(r.doc_id), r.kept_text) for r in suffixes.remove_repeated_words(hard, 51).collect())
    assert kept == sorted(zip((str(k) for k, _ in HARD), without_repeated_words([t or "" for _, t in HARD], 51), strict=True))
    assert suffixes.remove_repeated_words(empty, 51).collect() == []


@pytest.mark.parametrize("text", ["a" * 60_000, "abcdefghij" * 5000, "ab" * 900 + "x" + "ab" * 900, "a" * 3000 + LONG + "a" * 3000])
def test_periodic_texts_are_few_windows(spark, monkeypatch, text):
    monkeypatch.setattr(suffixes, "SEGMENT_BYTES", 7000)
    some = [text, "before " + text[:1500], LONG[:9000]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(some)], "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in suffixes.remove_repeats(df, 400).collect()}
    assert [got[i] for i in range(len(some))] == repeats([t.encode() for t in some], 400)
    rows = df.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_mark"), F.col("text").alias("_text"))
    assert suffixes._windows(rows, 400, None).count() < 1000


def test_suffix_arrays_and_common_prefixes():
    random.seed(2)
    for _ in range(100):
        some = [bytes(random.choices(b"ab\0", k=random.randint(1, 30))) for _ in range(random.randint(1, 6))]
        raw, sizes = b"".join(some), np.array([len(x) for x in some])
        starts = np.cumsum(sizes) - sizes
        left = np.repeat(starts + sizes, sizes) - np.arange(len(raw))
        text = np.frombuffer(raw, np.uint8)
        order = suffixes.suffix_array(text, left)
        suffix = [raw[i : i + n] for i, n in enumerate(left)]
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: (suffix[i], i))
        found = suffixes.common_prefixes(text, left, starts, order)
        for a, b in zip(order[:-1], order[1:], strict=True):
            assert found[b] == next((k for k, (x, y) in enumerate(zip(suffix[a], suffix[b], strict=False)) if x != y), min(left[a], left[b]))


def test_wavelet_matrix_answers_like_the_ids(spark):
    ids = np.random.default_rng(3).integers(0, 700, 5000).astype(np.uint32)
    keys, counts, matrix = wavelet.unpack(wavelet.pack([1, None], np.array([2000, 3000]), ids))
    assert keys == [1, None] and (matrix.decode() == ids).all() and (matrix.access(np.arange(0, 5000, 7)) == ids[::7]).all()
    for token in (0, 5, 699, 900, 5000):
        assert matrix.count(token) == (ids == token).sum() and matrix.count(token, 1234) == (ids[:1234] == token).sum()
        assert (matrix.places(token) == np.flatnonzero(ids == token)).all()


def reference(name, end):
    tool = Tokenizer.from_file(public_tokenizers.path(name))
    tool.encode_special_tokens = True
    return lambda t: tool.encode(t or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_wavelet_files_hold_every_document(spark, hard, empty):
    encode, start = reference("byte_bpe_50k.json", 2), 0
    got = sorted(queries.QUERIES["op5_wavelet_tokens"](spark, FOLDER).collect())
    for (key, text), row in zip(sorted(texts(spark)), got, strict=True):
        ids = encode(text)
        assert tuple(row) == (key, start, len(ids), crc(ids))
        start += len(ids)
    path, folder = public_tokenizers.path("byte_bpe_50k.json"), new_folder(spark, "wavelet")
    files = wavelet.write_shards(hard, path, 2, folder, shard_ids=5)
    assert sorted(r.n_tokens for r in wavelet.read_shards(files, folder).collect()) == sorted(len(encode(t)) for _, t in HARD)
    assert wavelet.lookup(files, folder, 2).count() == sum(encode(t).count(2) for _, t in HARD)
    assert wavelet.index_documents(empty, path, 2).count() == 0


@pytest.mark.parametrize("block", [8, 1 << 22])
def test_separators_are_found_across_blocks(spark, hard, block):
    path, folder = public_tokenizers.path("byte_bpe_50k.json"), new_folder(spark, "flat")
    encode = reference("byte_bpe_50k.json", 50256)
    rows = hard.where("doc_id IS NULL OR doc_id NOT IN (5, 6)")
    order = separators.write_flat(rows, path, 50256, folder)
    found = separators.scan_flat(separators.flat_files(spark, order, folder), folder, 50256, block)
    got = order.join(found, ["file", "ordinal"]).collect()
    want = collections.Counter((k, len(encode(t))) for k, t in HARD if k not in (5, 6))
    assert collections.Counter((r.doc_id, r.n_tokens) for r in got) == want and all(r.closed for r in got)


def test_counts_of_the_whole_table(spark, empty):
    encode = reference("byte_bpe_50k.json", 50256)
    got = {r.doc_id: r.n_tokens for r in queries.QUERIES["op4_separator_counts"](spark, FOLDER).collect()}
    assert got == {k: len(encode(t)) for k, t in texts(spark)}
    assert separators.count_tokens(empty, public_tokenizers.path("byte_bpe_50k.json"), 50256).count() == 0


def test_packing_is_gapless_and_tight(spark, hard, empty):
    encode, path = reference("word_bpe_49k.json", 1), public_tokenizers.path("word_bpe_49k.json")
    for rows, want in ((queries.QUERIES["op9_bin_slack_packing"](spark, FOLDER).collect(), texts(spark)), (packing.pack_documents(hard, path, 1, 100).collect(), HARD)):
        size = 4096 if len(want) != len(HARD) else 100
        pieces = [(k, i // size, i, ids[i : i + size]) for k, t in want for ids in [encode(t)] for i in range(0, len(ids), size)]
        key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
        assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(((k, p, s, len(x), crc(x)) for k, p, s, x in pieces), key=key)
        bins = collections.defaultdict(list)
        for r in rows:
            bins[r.sequence_id].append((r.offset, r.length))
        for found in bins.values():
            at = 0
            for offset, length in sorted(found):
                assert offset == at
                at += length
            assert at <= size
        if size == 4096:
            assert len(bins) <= -(-sum(r.length for r in rows) // size) + 1
    assert packing.pack_documents(empty, path, 1, 4096).count() == 0


def components(values, budget):
    values = np.array(values, np.uint64)
    label = list(range(len(values)))
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= budget).tolist():
            a, b = sorted((label[i], label[j]))
            label = [a if x == b else x for x in label] if a != b else label
    return label


def test_fingerprints_and_components(spark, hard, empty):
    from xxhash import xxh64_intdigest

    def print_of(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in low).split(" ") if w]
        hashes = [xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))] if words else []
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    rows = sorted(texts(spark))
    got = {r.doc_id: r for r in queries.QUERIES["op7_trie_simhash"](spark, FOLDER).collect()}
    prints = [print_of(t) for _, t in rows]
    assert [got[k].fingerprint for k, _ in rows] == [f"{p:016x}" for p in prints]
    assert [got[k].component_id for k, _ in rows] == [rows[i][0] for i in components(prints, 2)]
    found = simhash.near_duplicates(hard, 3, 2).collect()
    assert len(found) == len(HARD) and {r.component_id for r in found if r.fp == 0} == {1}
    assert simhash.one_of_each(hard, 3, 2).where("doc_id = 6").count() == 0 and simhash.near_duplicates(empty, 3, 2).count() == 0


def test_each_component_keeps_one_document(spark):
    unlike = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcdef"]
    some = [(None, unlike[0]), (None, unlike[1]), (None, unlike[1]), (7, unlike[2]), (7, unlike[3]), (None, unlike[4]), (9, unlike[4]), (8, unlike[4]), (9, unlike[5])]
    kept = simhash.one_of_each(spark.createDataFrame(some, "doc_id long, text string"), 3, 2).collect()
    want = [(None, unlike[0]), (None, unlike[1]), (7, unlike[2]), (7, unlike[3]), (8, unlike[4]), (9, unlike[5])]
    assert collections.Counter(map(tuple, kept)) == collections.Counter(want)


@pytest.mark.parametrize(("budget", "limit"), [(2, None), (2, 3), (3, 20)])
def test_trie_links_connect_what_is_near(spark, budget, limit):
    random.seed(budget)
    values = {0} | {random.getrandbits(64) for _ in range(200)}
    for base in [random.getrandbits(64) for _ in range(8)]:
        for _ in range(30):
            x = base
            for _ in range(random.randint(0, 4)):
                x ^= 1 << random.randrange(64)
            values.add(x)
    values = sorted(values)
    df = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    place = {v: i for i, v in enumerate(values)}
    groups = simhash.Groups(len(values))
    links = [(place[r.a % (1 << 64)], place[r.b % (1 << 64)]) for r in simhash.near_links(df, budget, limit).collect()]
    groups.add(np.array([a for a, _ in links], int), np.array([b for _, b in links], int))
    assert groups.label.tolist() == components(values, budget)


def test_search_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{FOLDER}/embeddings.parquet'")
    got = sorted(map(tuple, queries.QUERIES["op8_maxscore_search"](spark, FOLDER).collect()))
    assert got == sorted(con.sql(queries.ORACLES["op8_maxscore_search"]).fetchall())
    from hoarfrost.llm import maxscore

    odd = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (50, []), (3, None), (4, [float("nan")]), (5, [None]), (6, [1e300]), (7, [0.25])]
    rows = maxscore.whole_terms(spark.createDataFrame(odd, "vec_id long, v array<double>"), "v", "vec_id", 256)
    best = [tuple(r) for r in maxscore.top_k(rows, rows.where("vec_id = 0"), 2).orderBy("rank").collect()]
    assert len(best) == 4 and {b[2] for b in best} <= {0, 6, 7}


def test_quality_model_separates(spark, hard, empty):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op6_gam_quality"](spark, "/root/testdata/sf0.01").collect() if r.doc_id in labels and r.held_out]
    assert sum(r.predicted == labels[r.doc_id] for r in rows) >= 0.95 * len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.score_documents(hard, none).collect()] == [0.5] * len(HARD)
    assert quality.score_documents(empty, none).count() == 0


def test_leaks_are_found_and_nothing_else(spark, hard, empty):
    bench = {r.item_id: r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    docs = texts(spark)
    docs += [(10_000 + i, f"{d} {t.upper()} {d}") for (i, t), (_, d) in zip(bench.items(), docs, strict=False)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.find_leaks(df, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()}

    def words(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return leaks.terms_of(data, np.array([0, len(data)]))[0].tolist()

    items, want = {k: words(t) for k, t in bench.items()}, set()
    for key, text in docs:
        some = words(text)
        want |= {(key, k) for k, w in items.items() if any(some[i : i + len(w)] == w for i in range(len(some)))}
    # The planted ones count even where upper case has changed a letter (\u00df to SS).
    assert got == want | {(10_000 + i, i) for i in range(len(bench))}
    none = spark.createDataFrame([], "item_id long, text string")
    assert leaks.find_leaks(hard, none).count() == 0 and leaks.find_leaks(empty, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).count() == 0
    assert leaks.without_leaks(hard, none).count() == len(HARD)


def test_leaks_of_thousands_of_items_are_found(spark):
    """Copies, and paraphrases with every second word changed outside the answer, of many and of long items."""
    random.seed(6)
    vocabulary = ["".join(random.choices("abcdefghijklmnop", k=random.randint(3, 9))) for _ in range(9000)]
    words = lambda n: random.choices(vocabulary, k=n)
    items = [words(random.randint(15, 59)) for _ in range(2000)] + [words(n) for n in range(100, 501, 20)]
    docs, want = [" ".join(words(120)) for _ in range(300)], set()
    for i in [*range(0, 2000, 8), *range(2000, len(items))]:
        item, answer = items[i], len(items[i]) - max(1, len(items[i]) // 3)
        half = [w if k >= answer or k % 2 else random.choice(vocabulary) for k, w in enumerate(item)]
        for text in (item, half):
            want.add((len(docs), i))
            docs.append(" ".join([*words(random.randint(20, 50)), *text, *words(30)]))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    found = [(r.doc_id, r.item_id) for r in leaks.find_leaks(df, bench).select("doc_id", "item_id").collect()]
    assert len(found) == len(set(found)) and set(found) == want


def test_one_scan_serves_many_spaces(spark, monkeypatch):
    """Items that fill several spaces are looked for in one scan; a task that can keep one space at a time,
    and looks after every text, finds the same as one that keeps all."""
    random.seed(8)
    vocabulary = ["".join(random.choices("abcdefghijklmnop", k=random.randint(3, 9))) for _ in range(4000)]
    items = [random.choices(vocabulary, k=random.randint(15, 59)) for _ in range(150)] + [random.choices(vocabulary, k=300)]
    docs = [" ".join([*random.choices(vocabulary, k=40), *random.choice(items), *random.choice(items)]) for _ in range(60)]
    df = spark.createDataFrame([*enumerate(docs), (None, docs[0]), (7, None), (8, "")], "doc_id long, text string")
    rows = [(i, " ".join(x)) for i, x in enumerate(items)] + [(None, " ".join(items[0])), (5, ""), (6, None)]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    monkeypatch.setattr(leaks, "RANK", 32)
    kept = leaks.find_leaks(df, bench)
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    monkeypatch.setattr(leaks, "KEEP_BYTES", 0)
    monkeypatch.setattr(leaks, "GATHER_BYTES", 1)
    columns = ("doc_id", "mark", "item_id", "shared", "answered", "first_word", "words")
    one, other = (collections.Counter(map(tuple, x.select(*columns).collect())) for x in (kept, leaks.find_leaks(df, bench)))
    assert one == other
    words = {i: x for i, x in enumerate(items)} | {None: items[0]}
    text_of = dict(enumerate(docs)) | {None: docs[0]}
    want = {(d, i) for d, text in text_of.items() for i, x in words.items() if " ".join(x) in text}
    assert {(d, i) for d, _, i, *_ in one} == want


def test_longest_common_subsequence():
    random.seed(4)
    for _ in range(200):
        a, b = ([random.randint(0, 4) for _ in range(random.randint(1, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert leaks.longest_common(a, b) == table[-1][-1]


def test_marginals_equal_enumeration():
    import itertools

    tree = dom.parse("<body><nav><a>x</a></nav><article><p>Some text here.</p></article></body>")
    model = dom.train([(t, dom.states(t, True)) for t in map(dom.parse, dom.PAGES)])
    own, total, sums = [model.evidence(x) for x in dom.facts(tree)], 0.0, np.zeros(len(tree.tags))
    for states in itertools.product((0, 1), repeat=len(tree.tags)):
        weight = model.root[states[0]] + sum(own[i][s] for i, s in enumerate(states))
        weight += sum(model.edges.get(tree.tags[i], model.any_edge)[states[tree.parents[i]], states[i]] for i in range(1, len(states)))
        total += np.exp(weight)
        sums += np.exp(weight) * np.array(states)
    assert np.allclose(model.marginals(tree), sums / total)


def test_pages(spark):
    import re

    rows = {r.page_id: r.text for r in queries.QUERIES["op10_dom_main_text"](spark, FOLDER).collect()}
    for page in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        main = re.search(r"<article>(.*?)</article>", page.html, re.S)
        if main:
            plain = re.sub(r"<[^>]*>", "\0", re.sub(r"</?b>", "", main[1]))
            assert rows[page.page_id] == " ".join(filter(None, (" ".join(dom.html.unescape(x).split()) for x in plain.split("\0"))))
    odd = spark.createDataFrame([(1, None, None), (2, "u", ""), (3, "u", "<p"), (4, "u", "a &amp b"), (4, "u", "<script>x")], "page_id long, url string, html string")
    assert dom.extract(odd, dom.learn(odd)).count() == 5 and dom.extract(odd.limit(0), dom.learn(odd.limit(0))).count() == 0


@pytest.mark.parametrize("raw", ["<script>for(i=0;i<n;i++){f(i);}</script>", "<SCRIPT>if (a<b) s = '</scripts>' + \"<!-- \";</Script >", "<style>/* a<b */</style>", "<textarea><p 'x</textarea>"])
def test_raw_elements_end_at_their_closing_tag(raw):
    page = "<body>{}<article><p>Some text here.</p></article><p>After</p></body>"
    with_raw, without = (dom.parse(page.format(x)) for x in (raw, ""))
    assert [t for _, t in with_raw.texts if t] == [t for _, t in without.texts if t] == ["Some text here.", "After"]
    assert [x for x in with_raw.tags if x != raw[1:].split(">")[0].lower()] == without.tags
    assert [t for _, t in dom.parse("<p>a</p><script>i<n</script").texts if t] == ["a"]


def texts_of(page):
    return [t for _, t in dom.parse(page).texts if t]


def test_quotes_open_values_only_after_an_equals_sign():
    assert texts_of("<p title=it's>First one.</p><p>Second.</p>") == ["First one.", "Second."]
    assert texts_of("<p title = 'a > b' x=\"it's\" it's \" >One</p><p y=>Two</p><a href=/x?a=b>Three</a>") == ["One", "Two", "Three"]
    assert texts_of('<p class="open>One</p><p>Two</p>') == ["One", "Two"]  # a value that never ends
    assert texts_of("One <a href='x' title=\"y") == ["One "]


def test_elements_in_a_line_end_no_block():
    for mark in ("<img src=x>", "<input>", "<wbr>", "<svg><path d='M0'/></svg>", "<script>var a = 1 < 2;</script>", "<button></button>"):
        page = dom.parse(f"<p>wo{mark}rd</p><p>next</p>")
        assert "".join(t if t is not None else "|" for _, t in page.texts).strip("|").replace("||", "|") == "word|next"
    assert "".join(t if t is not None else "|" for _, t in dom.parse("a<br>b").texts) == "a|b"


def test_broken_pages_take_linear_time():
    for page in ("<a " * 350_000, "<a b='" * 170_000, '<a "' * 250_000 + 'x="', "<div>" * 60_000 + "</p>" * 60_000, "<p><b>" * 60_000, "<ul><li>" * 40_000 + "<td>" * 40_000, "<!--" * 250_000, "<script>" * 100_000):
        start = time.perf_counter()
        dom.parse(page)
        assert time.perf_counter() - start < 6


def test_pipeline_takes_every_decision(spark):
    docs, kept = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), docs.schema)
        kept.append({r.doc_id: r.text for r in docs.collect()})
    good, one, left, clean = kept
    scores = {r.doc_id: r.predicted for r in queries.QUERIES["op6_gam_quality"](spark, FOLDER).collect()}
    assert set(good) == {k for k, p in scores.items() if p}
    order = sorted(one)
    assert [left[k] for k in order] == without_repeated_words([one[k] for k in order], 51)
    assert not {n: c for n, c in collections.Counter(tuple(w[i : i + 51]) for w in map(str.split, left.values()) for i in range(len(w) - 50)).items() if c > 1}
    assert set(clean) <= set(left) and set(left) == set(one) <= set(good)
    packed = corpus_pipeline.run(spark, FOLDER)
    assert {r.doc_id for r in packed.collect()} == set(clean)
    assert packed.where(F.col("length") > 4096).count() == 0


CLASHES = ("_id", "_mark", "_bad", "_best", "_score", "score", "of", "at", "number", "mark", "item_id", "spans", "row")


def test_columns_of_any_name_are_kept(spark, hard):
    """Every operator and stage leaves other columns alone, whatever they are called."""
    wide = hard.drop("score", "_row").withColumns({c: F.lit(7) for c in CLASHES})
    benchmark = spark.createDataFrame([(1, "an item of no document at all, with an answer. It is nowhere.")], "item_id long, text string")
    labels = spark.createDataFrame([(k, int(k) % 2) for k in (1, 3, 4, 5)], "doc_id long, quality int")
    for kept in (simhash.one_of_each(wide, 3, 2), leaks.without_leaks(wide, benchmark), quality.good_ones(wide, quality.learn(wide, labels), 0.0)):
        rows = kept.collect()
        assert kept.columns == wide.columns and rows and all(r[c] == 7 for r in rows for c in CLASHES)
    n = len(HARD)
    path = public_tokenizers.path("word_bpe_49k.json")
    assert sharding.shard_records(wide, [1.0] * 3).count() == suffixes.remove_repeats(wide, 400).count() == n
    assert simhash.near_duplicates(wide, 3, 2).count() == quality.score_documents(wide, labels).count() == n
    assert packing.pack_documents(wide, path, 1, 5000).count() >= n and wavelet.index_documents(wide, path, 1).count() == n
    assert separators.count_tokens(wide, public_tokenizers.path("byte_bpe_50k.json"), 50256).count() == n
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, wide, FOLDER).count() >= 0


@pytest.mark.parametrize("ids", [[], [0], [1], [5, 5, 5], [0, 0], [1 << 20, 3, 0, 7], list(range(70_000))])
def test_planes_of_odd_shapes_come_back(ids):
    """No ids, only zeros or only ones in a plane, and ids beyond 16 bits."""
    ids = np.array(ids, np.uint32)
    matrix = wavelet.WaveletMatrix.build(ids)
    assert matrix.decode().tolist() == ids.tolist()
    assert matrix.access(np.arange(min(len(ids), 50))).tolist() == ids[:50].tolist()
