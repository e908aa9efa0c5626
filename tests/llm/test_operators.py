"""Brute-force comparisons and awkward inputs: nulls, empty and long texts, ties, repeats, empty tables, extra columns."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from tests.compare import duck, rows
from wearlake.llm import bytebpe, fingerprint, jaccard, mixing, packing, pqdedup, quality, queries, quotes, rangecoder, textvec, tokencount, tokenfile, toxicity

TOK = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(TOK)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet " * 4000
TEXTS = [
    None, "", " \n ", "It's 'tis we've  a\n\n b", "x<|endoftext|>y", "日本語 ½ Ⅷ 👍🏽 é'd", LONG,
    "one two three four five six seven", "one two three four five six seven", "ONE two three four five six seven eight",
    "a b", "A b", "\x00 \x1c z",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows_ = [
        (k, t, None, None if k % 4 == 0 else f"s{k % 3}", None) for k, t in enumerate(TEXTS)
    ] + [(7, TEXTS[7], "en", "s1", 5)]
    # extra columns with names that results use
    return spark.createDataFrame(rows_, SCHEMA).selectExpr(
        "*", "1 AS size", "2 AS score", "'z' AS node", "3 AS id", "4 AS part"
    )


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_token_counts(docs, empty):
    got = tokencount.token_counts(docs, TOK).toPandas()
    want = Counter(
        (k, len((t or "").encode()), len(_ids(t)), len(_ids(t)) > 1024) for k, t in [*enumerate(TEXTS), (7, TEXTS[7])]
    )
    assert Counter(got.itertuples(index=False, name=None)) == want
    assert tokencount.token_counts(empty, TOK).count() == 0


def test_token_file_round_trip(spark, docs, empty):
    for df, texts in (
        (docs, sorted([*enumerate(TEXTS), (7, TEXTS[7])], key=lambda x: (x[0], x[1] or ""))), (empty, [])
    ):
        path = tokenfile.scratch_path(spark)
        tokenfile.write_token_file(df, path, TOK)
        got = [tuple(r) for r in tokenfile.read_token_file(spark, path).orderBy("start").collect()]
        start, want = 0, []
        for k, t in texts:
            ids = [*_ids(t), 0]
            want.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
            start += len(ids)
        assert got == want


def test_range_coder():
    rng = np.random.default_rng(0)
    repeated = np.tile(rng.integers(0, 50257, 50), 80)
    cases = [rng.zipf(1.3, n).clip(0, 50256) for n in (0, 1, 700, 33, 4096)]
    cases += [
        repeated[:3999], np.zeros(4096, int), np.array([7]), np.arange(4096) * 1_000_000, np.array([0, 4294967295] * 9),
        rng.integers(0, 1 << 32, 4096),
    ]
    for blocks in ([], cases[:1], cases, cases * 9):
        coded = rangecoder.encode(blocks, lanes_at_once=4)
        assert all(np.array_equal(a, b) for a, b in zip(blocks, rangecoder.decode(coded, [len(b) for b in blocks])))
    assert len(rangecoder.encode([repeated])[0]) < 0.3 * len(repeated)  # repeats are predicted
    assert rangecoder.encode(cases)[2] == rangecoder.encode([cases[2]])[0]  # a block depends on nothing else
    for wrong in ([-1], [1 << 32], range(4097)):
        with pytest.raises(ValueError):
            rangecoder.encode([np.array(wrong)])


def test_coded_bytes_stay():
    k = np.arange(70_000)
    ids = (k * k * 31 + k // 7 * 977 + (k % 11) ** 4) % (1 + k % 1500)
    blocks = [ids[:0], ids[:9], *(ids[a : a + 4096] for a in range(9, len(ids), 4096))]
    assert zlib.crc32(b"".join(rangecoder.encode(blocks))) == 930930384


@pytest.mark.parametrize("kind", [bytebpe.LibraryIds, bytebpe.RankCounter])
def test_frequent_pieces_outlive_rare_ones(kind, monkeypatch):
    monkeypatch.setattr(bytebpe, "CACHE_PIECES", 200)
    held, new = kind(TOK), []
    add = held.add
    held.add = lambda data, starts, ends: (
        new.extend(data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())), add(data, starts, ends)
    )
    for k in range(60):
        texts = [f"the weather isn't fine, {' '.join(3 * chr(97 + j) + chr(97 + k % 26) + chr(97 + k // 26) for j in range(10))} été\u3000 あ", "\x1c \x85"]
        raw = [t.encode() for t in texts]
        data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
        want = [_ids(t) for t in texts]
        if kind is bytebpe.RankCounter:
            assert held.counts(data, offsets).tolist() == [len(x) for x in want]
        else:
            ids, begin = held.encode(data, offsets)
            assert ids.tolist() == sum(want, []) and np.diff(begin).tolist() == [len(x) for x in want]
    assert held.keys.size < 300
    assert new.count(b" weather") == 1 and len(new) > 600  # so the table was renewed several times


def test_chunks_and_damage():
    ids = np.random.default_rng(2).zipf(1.3, 9000).clip(0, 50256)
    payload = tokenfile.pack_chunk([1, None, 3], np.array([600, 0, 8400]), ids)
    names, lengths, back = tokenfile.unpack_chunk(payload)
    assert names == [1, None, 3] and lengths.tolist() == [600, 0, 8400] and np.array_equal(back, ids)
    assert tokenfile.unpack_chunk(tokenfile.pack_chunk([], np.zeros(0, int), ids[:0]))[0] == []
    for at in (0, 9, 20, 40, len(payload) // 2, len(payload) - 9):
        damaged = bytearray(payload)
        damaged[at] ^= 8
        with pytest.raises(ValueError):
            tokenfile.unpack_chunk(bytes(damaged))
    for size in (5, 100, len(payload) - 300):
        with pytest.raises(ValueError):
            tokenfile.unpack_chunk(payload[:size])


def _thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_words_that_collide_in_polynomials(spark):
    word = _thue_morse(1024)
    texts = [word, word.translate(str.maketrans("ab", "ba"))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert [
        r["n_tokens"] for r in tokencount.token_counts(df, TOK).orderBy("doc_id").collect()
    ] == [len(_ids(t)) for t in texts]
    path = tokenfile.scratch_path(spark)
    tokenfile.write_token_file(df, path, TOK)
    assert [
        r["ids"] for r in tokenfile.read_token_file(spark, path).orderBy("doc_id").collect()
    ] == [[*_ids(t), 0] for t in texts]
    assert [
        r["ids_crc32"] for r in packing.pack(df, TOK).orderBy("doc_id").collect()
    ] == [zlib.crc32(np.array([*_ids(t), 2], "<u4").tobytes()) for t in texts]
    assert [r["component_id"] for r in jaccard.jaccard_components(df).orderBy("doc_id").collect()] == [0, 1]


def test_pieces_with_equal_hashes(monkeypatch):
    true = textvec.hash_words
    monkeypatch.setattr(textvec, "hash_words", lambda words, begin, size: true(words, begin, size) & np.uint64(3))
    data, offsets = textvec.column_bytes(pa.array([t or "" for t in TEXTS]))
    ids, begin = bytebpe.LibraryIds(TOK).encode(data, offsets)
    assert [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:])] == [_ids(t) for t in TEXTS]
    assert bytebpe.RankCounter(TOK).counts(data, offsets).tolist() == [len(_ids(t)) for t in TEXTS]


def test_long_text_in_slices(monkeypatch):
    text = "".join(t or "" for t in TEXTS) * 2 + "x" * 5000 + " y  z " + " \n" * 700 + "é " * 900 + "end of it"
    data, offsets = textvec.column_bytes(pa.array([text]))
    monkeypatch.setattr(bytebpe, "SLICE", 300)
    assert bytebpe.LibraryIds(TOK).encode(data, offsets)[0].tolist() == _ids(text)
    assert bytebpe.RankCounter(TOK).counts(data, offsets).tolist() == [len(_ids(text))]
    assert len(bytebpe.slices(data)) > 50


def test_packing(docs, empty):
    got = packing.pack(docs, TOK).toPandas().sort_values(["sequence_id", "offset"])
    size = got.groupby("sequence_id")["length"]
    assert (got["offset"] == size.cumsum() - got["length"]).all() and size.sum().max() <= 1024
    own = got.sort_values(["doc_id", "piece"])
    for k, t in enumerate(TEXTS):
        ids, mine = [*_ids(t), 2], own[own.doc_id == k]
        pieces = {(r.start, r.length, r.ids_crc32) for r in mine.itertuples()}
        assert all(zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()) == c for s, n, c in pieces)
        assert sum(n for _, n, _ in pieces) == len(ids) and all(n == 1024 for s, n, _ in pieces if s)
    assert packing.pack(empty, TOK).count() == 0


def test_pack_plan_is_tight():
    lengths = np.random.default_rng(1).integers(1, 1025, 20_000)
    plan, sequences = packing.pack_plan(np.bincount(lengths, minlength=1025))
    placed = np.zeros(1025, int)
    for length, a, b, _, _ in plan:
        placed[length] += b - a
    assert (placed == np.bincount(lengths, minlength=1025)).all()
    assert sequences <= 1.01 * -(-lengths.sum() // 1024)


def test_mixing_against_sql(docs, empty):
    frame = docs.toPandas()
    got = mixing.mix(docs).toPandas()
    assert rows(got) == rows(duck(queries.MIXING_SQL, documents=frame))
    assert mixing.mix(empty).count() == 0
    base = docs.select("doc_id", "text", "lang", "source", "n_chars")
    taken = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in mixing.mixed_documents(base).collect())
    assert taken == got["taken"].sum()


def _hash(text):
    """The hash by which rows of one id are ordered."""
    h = xxhash.xxh64((text or "").encode(), seed=42).intdigest()
    return h - (1 << 64) if h >> 63 else h


def test_fingerprints(spark, docs, empty):
    got = fingerprint.edited_fingerprints(docs).toPandas().sort_values(["doc_id", "n_chars"])
    order = sorted([*enumerate(TEXTS), (7, TEXTS[7])], key=lambda x: (x[0], _hash(x[1])))
    edited = []
    for (_, a), (_, b) in zip(order, [*order[1:], order[0]]):
        a, b = a or "", b or ""
        edited.append(hashlib.sha256((a[: len(a) - len(a) // 2] + b[: len(a) // 2]).encode()).hexdigest())
    assert Counter(got["edited_sha256"]) == Counter(edited)
    one = got[got.doc_id.isin([7, 8])]
    assert one["fingerprint"].nunique() == 1
    assert fingerprint.edited_fingerprints(empty).count() == 0
    lone = fingerprint.edited_fingerprints(spark.createDataFrame([(5, "a b c")], "doc_id long, text string")).toPandas()
    assert len(lone) == 1 and lone["near_next"][0] == 1.0


def test_fingerprints_over_many_parts(spark):
    texts = [f"w{k} " * (k % 9) for k in range(300)]
    df = spark.createDataFrame([(k * 7, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    whole = fingerprint.in_order(df, rows_per_part=11).toPandas()
    assert (whole["sentinel"] == 0).sum() == 300
    parts = whole.sort_values(["part", "sentinel", "id"]).groupby("part")["id"].apply(list).tolist()
    follows = {a: b for p in parts for a, b in zip(p, p[1:])}
    assert all(follows[k * 7] == (k + 1) % 300 * 7 for k in range(300))


@pytest.mark.parametrize("each", [7, 100, 10_000])
def test_fingerprint_parts_of_hot_ids(spark, each):
    """Rows of one id and without id are many parts, and each still meets its successor."""
    rows_ = [(None, f"n{k}") for k in range(400)] + [(5, f"t{k}") for k in range(400)] + [(k, f"x{k}") for k in range(200)]
    rows_ += [(5, "again")] * 30 + [(None, None)] * 3
    df = spark.createDataFrame(rows_, "doc_id long, text string").repartition(4)
    whole = fingerprint.in_order(df, rows_per_part=each).toPandas()
    assert (whole.sentinel == 0).sum() == len(rows_)
    own = [(None if i != i else int(i), t) for i, t in zip(whole[whole.sentinel == 0].id, whole[whole.sentinel == 0].text)]
    assert Counter(own) == Counter((i, t or "") for i, t in rows_)
    if each == 7:
        assert whole[(whole.id == 5) & (whole.sentinel == 0)].part.nunique() > 30 and whole[whole.id.isna()].part.nunique() > 30
        assert whole[whole.sentinel == 0].groupby("part").size().max() < 60
    place = lambda r: (r[0] is not None, r[0] or 0, _hash(r[1]))
    order = sorted(((i, t or "") for i, t in rows_), key=place)
    want = Counter(zip(order, [*order[1:], order[0]]))
    got = Counter()
    for _, p in whole.groupby("part"):
        p = [(None if i != i else int(i), t, n) for i, t, n in zip(p.id, p.text, p.sentinel)]
        p.sort(key=lambda r: (r[2], place(r)))
        got.update((a[:2], b[:2]) for a, b in zip(p, p[1:]) if not a[2])
    assert got == want


def test_sketch_estimates():
    rng = np.random.default_rng(4)
    words = [f"t{x}" for x in rng.integers(0, 10**9, 4000)]
    a, b = " ".join(words[:3000]), " ".join(words[1000:])
    data, offsets = textvec.column_bytes(pa.array([a, b]))
    x, y = fingerprint.sketches(data, offsets)
    assert abs(fingerprint.resemblance(x, y) - 0.5) < 0.15 and abs(fingerprint.containment(x, y) - 2 / 3) < 0.2
    assert abs(fingerprint.distinct_count(x) / 2996 - 1) < 0.3
    assert (fingerprint.from_string(fingerprint.to_string(x)) == x).all()


def _components(texts, percent=75):
    sets = []
    for t in texts:
        w = (t or "").lower().split() if t else []
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(sets))], [len(s) for s in sets]


@pytest.mark.parametrize("hot,pairs", [(1024, 4), (3, 0)])
def test_jaccard(spark, hot, pairs):
    rng = np.random.default_rng(8)
    base = [[f"w{x}" for x in rng.integers(0, 5000, rng.integers(5, 60))] for _ in range(12)]
    texts = [None, "", "a b", "A b", "a c"]
    for k in range(150):
        w = list(base[k % 12])
        for _ in range(rng.integers(0, 3)):
            w[rng.integers(0, len(w))] = f"x{rng.integers(0, 50)}"
        texts.append(" ".join(w))
    want, sizes = _components(texts)
    df = spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string"
    ).repartition(4).selectExpr("*", "1 AS node", "2 AS token")
    got = jaccard.jaccard_components(df, hot=hot, pairs_per_posting=pairs).toPandas().sort_values("doc_id")
    assert got["component_id"].tolist() == want and got["n_shingles"].tolist() == sizes


def test_jaccard_links_and_grid(spark, monkeypatch):
    rng = np.random.default_rng(12)
    base = [[f"w{x}" for x in rng.integers(0, 5000, 30)] for _ in range(3)]
    texts = [None, "", "a b"]
    for k in range(120):
        w = list(base[k % 3]) + [f"tail{x}" for x in rng.integers(0, 3, 2)]
        for _ in range(rng.integers(0, 3)):
            w[rng.integers(0, len(w))] = f"x{rng.integers(0, 9)}"
        texts.append(" ".join(w))
    sets = [
        {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
        if w
        else set()
        for w in ((t or "").split() for t in texts)
    ]
    same = lambda x, y: bool(x and y) and 100 * len(x & y) >= 75 * len(x | y)
    want = [sum(same(sets[i], sets[j]) for j in range(len(texts)) if j != i) for i in range(len(texts))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    small = jaccard._candidates
    monkeypatch.setattr(
        jaccard, "_candidates",
        lambda tokens, lists, nodes, percent: small(tokens, lists, nodes, percent, group=5, block=4),
    )
    members, links = jaccard.jaccard_join(df)
    got = members.toPandas().sort_values("doc_id")
    assert got["n_links"].tolist() == want and got["n_shingles"].tolist() == [len(x) for x in sets]
    pairs = {(r["a"], r["b"]) for r in links.collect()}
    first = {}
    for k, t in enumerate(texts):
        first.setdefault(t, k)
    names = sorted(k for t, k in first.items() if t)
    assert pairs == {(i, j) for i in names for j in names if i < j and same(sets[i], sets[j])}
    components, _ = _components(texts)
    assert jaccard.jaccard_components(
        df, pairs_per_posting=1e9
    ).orderBy("doc_id").toPandas()["component_id"].tolist() == components


def test_jaccard_bitmap_bound():
    rng = np.random.default_rng(3)
    maps, sets = [], []
    for size, width in ((90, 1024), (100, 1024), (120, 1024), (130, 2048), (40, 512)):
        own = rng.choice(160, size, replace=False).astype(np.uint64)
        place = (textvec.mix64(own) & np.uint64(width - 1)).astype(np.int64)
        maps.append(np.packbits(np.bincount(place, minlength=width) & 1, bitorder="little").view(np.uint64))
        sets.append(set(own.tolist()))
    i, j = np.triu_indices(len(maps), 1)
    found = jaccard.differing(maps, i, j)
    true = np.array([len(sets[a] ^ sets[b]) for a, b in zip(i, j)])
    assert (found <= true).all() and (found >= 0.6 * true).all() and ((true - found) % 2 == 0).all()


def test_jaccard_awkward(docs, empty):
    got = jaccard.jaccard_components(docs).toPandas()
    assert len(got) == len(TEXTS) + 1 and set(got[got.doc_id.isin([7, 8])]["component_id"]) == {7}
    assert jaccard.jaccard_components(empty).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 16))
    x[100:200] = x[:100] + rng.normal(size=(100, 16)) * 0.08
    x[200:230] = x[0]
    rows_ = [(k, v.tolist(), k % 2 if k < 200 else 0) for k, v in enumerate(x)]
    rows_ += [
        (900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, x[0].tolist(), None),
        (904, [1.0, None], 1), (905, [1.0, 2.0], 1), (906, [2.0, 4.0], 1),
    ]
    got = pqdedup.near_duplicate_vectors(
        spark.createDataFrame(rows_, "vec_id long, embedding array<double>, label int"), block=64
    ).toPandas().set_index("vec_id").sort_index()

    unit = x / np.linalg.norm(x, axis=1)[:, None]
    label = np.array([r[2] for r in rows_[:300]])
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    assert (
        got["n_links"].to_numpy()[:300] <= near.sum(axis=1)
    ).all() and got["n_links"][:300].sum() >= 0.9 * near.sum()
    assert (got.loc[[900, 901, 902, 903, 904], "n_links"] == 0).all() and got.loc[906, "component_id"] == 905
    none = pqdedup.near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"))
    assert none.count() == 0


def test_vectors_with_other_labels_and_columns(spark):
    x = [1.0, 2.0]
    rows_ = [(1, x, "7"), (2, x, "7"), (3, x, "seven"), (4, x, None), (None, x, "7"), (2, x, "7")]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<double>, label string")
    df = df.selectExpr("*", "1 AS node", "2 AS unit", "3 AS list", "4 AS q", "'m' AS m", "5 AS n_links", "6 AS component")
    got = pqdedup.near_duplicate_vectors(df).toPandas()
    assert sorted(got["n_links"]) == [0, 0, 3, 3, 3, 3] and sorted(got[got.n_links > 0]["component_id"]) == [1, 1, 1, 1]


@pytest.mark.parametrize(
    ("kind", "labels", "links"),
    [
        ("double", [1.2, 1.7, 1.2, -0.0, 0.0], [1, 0, 1, 1, 1]),
        ("string", ["1", "1.0", "1", "true", "x"], [1, 0, 1, 0, 0]),
        ("boolean", [True, False, True, None, False], [1, 1, 1, 0, 1]),
        ("array<int>", [[1], [1, 2], [1], None, [2]], [1, 0, 1, 0, 0]),
    ],
)
def test_vectors_link_by_the_value_of_labels(spark, kind, labels, links):
    df = spark.createDataFrame(
        [(k, [1.0, 2.0], v) for k, v in enumerate(labels)], f"vec_id long, embedding array<double>, label {kind}"
    )
    got = pqdedup.near_duplicate_vectors(df).toPandas().sort_values("vec_id")
    assert list(got["n_links"]) == links


MESSAGES = [
    (1, 0, "user", "Hello there, how is the build?\n\nSecond para here."), (
        1, 1, "assistant", "> Hello there,  how IS the build?\n\nFine thanks."
    ),
    (
        1, 3, "user", "On Mon, Bob wrote:\n> Fine thanks.\n>> hello there, how is the build?\nOK"
    ), (1, 4, "user", "plain"), (
        2, 0, "user", "> fine thanks.\nelsewhere"
    ), (2, 0, "user", "> fine thanks.\nelsewhere"),
    (2, 70, "user", None), (2, 200, None, "On x wrote:\nno quote"), (None, 1, "user", "> plain"), (3, None, "user", "> plain"), (
        4, 1, "user", "> unknown\n> \n> second para here.\nyes\r\n> plain"
    ), (4, 0, "a", ""), (4, 129, "a", "> yes\n>\n> > deep\n"),
]


def test_quotes_against_sql(spark):
    df = spark.createDataFrame(MESSAGES, "conv_id long, turn long, role string, text string")
    got = quotes.link_quotations(df.selectExpr("*", "1 AS key", "2 AS own", "3 AS passages")).toPandas()
    assert rows(got) == rows(
        duck(quotes.SQL, conversations=df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    )
    first = got[got.conv_id == 1].sort_values("reply_rank")
    assert first["turn"].tolist() == [0, 1, 3, 4] and first["reply_rank"].tolist() == [0, 1, 2, 3]
    parts = quotes.assembled(quotes.link_quotations(df), 3).toPandas()
    own = parts[parts.conv_id == 1].sort_values("part")["messages"].tolist()
    assert [
        [m["turn"] for m in p] for p in own
    ] == [[0, 1, 3], [4]] and parts["messages"].map(len).sum() == got["reply_rank"].notna().sum()
    reply = got[(got.conv_id == 1) & (got.turn == 3)].iloc[0]
    assert (reply["parent_turn"], reply["n_linked"], reply["text"]) == (1, 2, "OK")
    assert quotes.link_quotations(df.filter("conv_id = 99")).count() == 0


def _labelled(spark):
    rng = np.random.default_rng(9)
    words = [f"w{k}" for k in range(300)]
    docs_, labels = [], []
    for k in range(400):
        w = rng.choice(words, rng.integers(20, 80)).tolist()
        toxic, bad = k % 5 == 0, k % 7 == 0
        if toxic:
            w[3] = w[9] = f"scumword{k % 9}"
        if bad:
            w = [f"{x.upper()}!!" for x in w]
        docs_.append((k, " ".join(w)))
        labels.append((k, int(not bad), int(toxic)))
    return spark.createDataFrame(docs_, "doc_id long, text string"), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int"
    )


def test_toxicity(spark, docs, empty):
    d, labels = _labelled(spark)
    model = toxicity.fit_toxicity(d, labels)
    got = toxicity.score_toxicity(d, model).toPandas()
    assert ((got.doc_id % 5 == 0) == got.toxic).mean() > 0.97 and got["severity"].between(0, 3).all()
    assert toxicity.score_toxicity(
        docs, model, keep=True
    ).count() == len(TEXTS) + 1 and toxicity.score_toxicity(empty, model).count() == 0
    bare = toxicity.fit_toxicity(d, labels.filter("toxic = 0"))
    assert not toxicity.score_toxicity(docs, bare).toPandas()["toxic"].any()


def test_quality(spark, docs, empty):
    d, labels = _labelled(spark)
    model = quality.fit_quality(d, labels)
    got = quality.score_quality(d, model).toPandas()
    assert ((got.doc_id % 7 != 0) == (got.predicted == 1)).mean() > 0.97 and got["score"].between(0, 1).all()
    assert quality.score_quality(docs, model).toPandas()["score"].notna().all() and quality.score_quality(
        empty, model
    ).count() == 0
    assert quality.score_quality(docs, quality.fit_quality(d, labels.limit(0))).toPandas()["score"].notna().all()


def test_reply_order_of_a_long_conversation(spark):
    rng = np.random.default_rng(3)
    rows_ = [
        (1, int(t), "user", f"message {t}" if t % 3 else f"> message {rng.integers(0, max(1, t))}\nand {t}")
        for t in range(300)
    ]
    df = spark.createDataFrame(rows_, "conv_id long, turn long, role string, text string").repartition(4)
    got = quotes.link_quotations(df).toPandas()
    assert rows(got) == rows(duck(quotes.SQL, conversations=df.toPandas()))
    order = got.sort_values("reply_rank")
    assert order["reply_rank"].tolist() == list(range(300)) and [
        (p, t) for p, t in zip(order.parent_turn, order.turn)
    ] == sorted(zip(got.parent_turn, got.turn))


def _loss(w, theta, text, feature, value, grade, penalty):
    score = np.bincount(text, value * w[feature], minlength=len(grade))
    above = np.concatenate(
        (np.ones((len(grade), 1)), 1 / (1 + np.exp(theta[None, :] - score[:, None])), np.zeros((len(grade), 1))), axis=1
    )
    at = np.arange(len(grade))
    return -np.log(above[at, grade] - above[at, grade + 1]).mean() + penalty * (w @ w) / (2 * len(grade))


def test_ordinal_fit_is_the_optimum():
    rng = np.random.default_rng(5)
    n, features = 200, 6
    text, feature = np.repeat(np.arange(n), 3), rng.integers(0, features, 3 * n)
    value = rng.uniform(0.5, 2, 3 * n)
    score = np.bincount(text, value * np.linspace(-1, 1.5, features)[feature], minlength=n) + rng.logistic(size=n)
    grade = np.digitize(score, [0.0, 1.0, 2.5])
    w, theta = toxicity.fit_ordinal(text, feature, value, grade, features, steps=3000)
    best = _loss(w, theta, text, feature, value, grade, 1.0)
    for k in range(features + 3):
        for step in (1e-3, -1e-3):
            x = np.concatenate((w, theta))
            x[k] += step
            assert _loss(x[:features], x[features:], text, feature, value, grade, 1.0) >= best - 1e-9


def test_toxicity_scores_by_formula(spark):
    d, labels = _labelled(spark)
    model = toxicity.fit_toxicity(d, labels)
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(d, model).collect()}
    for r in d.collect():
        words = re.findall(r"[a-z\u0080-\uffff]+", r["text"].lower())
        counts = Counter()
        for w in words:
            raw = np.frombuffer(w.encode(), np.uint8)
            kinds = [textvec.span_hashes(raw, np.array([0]), np.array([len(raw)]))[0]]
            kinds += [
                textvec.mix64(textvec.span_hashes(raw, np.array([0]), np.array([min(k, len(raw))])) ^ np.uint64(k))[0]
                for k in toxicity.PREFIXES
            ]
            counts.update(int(x) for x in kinds)
        place = {int(k): i for i, k in enumerate(model.keys)}
        score = sum(
            model.weights[place[k]] * np.log1p(50 * c / np.sqrt(len(words))) for k, c in counts.items() if k in place
        )
        above = 1 / (1 + np.exp(model.theta - score))
        assert np.isclose(got[r["doc_id"]]["p_toxic"], above[0]) and np.isclose(
            got[r["doc_id"]]["severity"], above.sum()
        )
        assert got[r["doc_id"]]["grade"] == int(np.argmax(np.append(1, above) - np.append(above, 0)))


def test_quality_scores_by_formula():
    rng = np.random.default_rng(6)
    x = np.concatenate((rng.normal(0, 1, (80, 4)), rng.normal(1, 2, (120, 4))))
    y = np.repeat([0, 1], [80, 120])
    model = quality.fit_quadratic(x, y, 0.2, 0.1)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    own = [np.cov(z[y == k].T, bias=True) for k in (0, 1)]
    common = 0.4 * own[0] + 0.6 * own[1]
    density = []
    for k in (0, 1):
        s = 0.8 * own[k] + 0.2 * common
        s = 0.9 * s + 0.1 * np.trace(s) / 4 * np.eye(4)
        e = z - z[y == k].mean(axis=0)
        density.append(-0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", e, np.linalg.inv(s), e))
    model.temperature = 3.0
    assert np.allclose(model.scores(x), 1 / (1 + np.exp((density[0] - density[1]) / 3 + np.log(80 / 120))))
    t = quality.best_temperature(model.differences(x) * 50, y, model.log_priors)
    assert 20 < t < 200  # what was made 50 times too sure is brought back
    assert quality.best_temperature(np.array([1.0]), np.array([1]), model.log_priors) == 1.0


def test_fingerprints_against_all_hashes(spark, docs):
    got = fingerprint.edited_fingerprints(docs).toPandas()
    order = sorted([*enumerate(TEXTS), (7, TEXTS[7])], key=lambda r: (r[0], _hash(r[1])))

    def hashes(t):
        words = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        data, offsets = textvec.column_bytes(pa.array([words]))
        return sorted({int(h) >> 16 for h in textvec.word_shingles(data, offsets)[0]})

    def alike(x, y):
        union = sorted(set(x) | set(y))[: fingerprint.K]
        return sum(h in x and h in y for h in union) / len(union) if union else 1.0

    want = []
    for (k, a), (_, b) in zip(order, [*order[1:], order[0]]):
        a, b = a or "", b or ""
        x, e, y = (hashes(t)[: fingerprint.K] for t in (a, a[: len(a) - len(a) // 2] + b[: len(a) // 2], b))
        want.append((k, len(a), x, e, alike(x, e), alike(x, y)))
    rows_ = [
        (
            r.doc_id, r.n_chars, fingerprint.from_string(r.fingerprint).tolist(),
            fingerprint.from_string(r.edited_fingerprint).tolist(), r.near_edited, r.near_next,
        ) for r in got.itertuples()
    ]
    assert sorted(rows_, key=repr) == sorted(want, key=repr)


def test_merging_and_comparing_fingerprints(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 400, 120)) for _ in range(9)]
    df = spark.createDataFrame(
        [(k, k % 2, t) for k, t in enumerate(texts)] + [(9, 1, None)], "doc_id long, part long, text string"
    ).repartition(4)
    prints = fingerprint.fingerprints(df).join(df.select("doc_id", "part"), "doc_id")
    got = {
        r["part"]: fingerprint.from_string(r["fingerprint"]).tolist()
        for r in fingerprint.merged_fingerprints(prints, "part").collect()
    }
    for p in (0, 1):
        data, offsets = textvec.column_bytes(pa.array([t for k, t in enumerate(texts) if k % 2 == p]))
        assert got[p] == sorted({int(h) >> 16 for h in textvec.word_shingles(data, offsets)[0]})[: fingerprint.K]
    pairs = spark.createDataFrame(
        [
            (
                fingerprint.to_string(np.arange(5, dtype=np.uint64)),
                fingerprint.to_string(np.arange(3, 9, dtype=np.uint64)),
            ),
            (None, ""),
        ],
        "a string, b string",
    )
    one, none = (tuple(r)[2:] for r in fingerprint.compared(pairs, "a", "b").collect())
    assert np.allclose(one, (2 / 9, 2 / 5, 5, 6)) and none == (None,) * 4


def test_long_texts_in_slices_are_the_same(monkeypatch):
    rng = np.random.default_rng(4)
    text = " ".join(f"W{x}!" + "\n" * int(x % 5 == 0) for x in rng.integers(0, 300, 3000)) + " é" * 40
    for t in (text, "a b c", "x" * 900, " " * 700, "one two three four " + " " * 700, ""):
        data, offsets = textvec.column_bytes(pa.array([t]))
        keys = np.unique(np.concatenate(toxicity.feature_hits(data, offsets)[0])) if t else np.zeros(0, np.uint64)
        whole = fingerprint.sketches(data, offsets)[0], [
            *toxicity.sparse_rows(data, offsets, keys), *jaccard._sets(data, offsets, 5)
        ]
        monkeypatch.setattr(textvec, "SLICE", 256)
        cut = fingerprint.sketches(data, offsets)[0], [
            *toxicity.sparse_rows(data, offsets, keys), *jaccard._sets(data, offsets, 5)
        ]
        monkeypatch.undo()
        assert np.array_equal(whole[0], cut[0]) and all(np.array_equal(x, y) for x, y in zip(whole[1], cut[1]))


def test_pieces_are_the_librarys():
    data, offsets = textvec.column_bytes(pa.array([t or "" for t in TEXTS]))
    ids, begin = bytebpe.library_ids(TOK).encode(data, offsets)
    assert [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:])] == [_ids(t) for t in TEXTS]


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.001"
    docs_ = cp._documents(spark, sf)
    for name, stage in cp.STAGES[:4]:
        before, kept = docs_, cp.materialise(stage(spark, docs_, sf), name)
        assert kept.columns == before.columns
        if name == "near_duplicates":
            texts = [r["text"] for r in before.orderBy("doc_id").collect()]
            ids = [r["doc_id"] for r in before.orderBy("doc_id").collect()]
            groups, _ = _components(texts)
            assert sorted(r["doc_id"] for r in kept.collect()) == [i for k, i in enumerate(ids) if groups[k] == k]
        docs_ = kept
    assert cp.STAGES[4][1](spark, docs_, sf).count() >= docs_.count()


def test_pipeline_keeps_columns_and_drops_repeated_rows(spark):
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.001"
    base = [
        (k, "the same words again and again in one text " + "of a kind" * (k % 2), "en", "s", 1)
        for k in (0, 1, 2, 0, 1, 2)
    ]
    base += [
        (5, None, None, None, None), (None, base[0][1], "en", "s", 1), (6, "", "en", "s", 0),
        (7, "quite another text that stands alone here", "en", "s", 1), (7, base[0][1], "en", "s", 1),
    ]
    own = spark.createDataFrame(base, SCHEMA).selectExpr(
        "*", "123 AS score", "7 AS predicted", "true AS toxic", "9 AS grade", "-5 AS size", "8 AS taken", "'n' AS node",
        "4 AS id", "5 AS component_id", "6 AS _id", "7 AS _node", "8 AS _first", "9 AS _place", "10 AS _near_id",
        "true AS _corpus_toxic", "0 AS _corpus_predicted", "1 AS _mix_size", "1 AS _mix_taken", "1 AS _mix_first",
    )
    theirs = ["_id", "_node", "_first", "_place", "_near_id", "_corpus_toxic", "_corpus_predicted", "_mix_size", "_mix_taken", "_mix_first"]
    kept = cp.drop_near_copies(spark, own, sf)
    want = [(0, base[0][1]), (1, base[1][1]), (5, None), (None, base[0][1]), (6, ""), (7, base[9][1])]
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(want) and kept.columns == own.columns
    for _, stage in cp.STAGES[:4]:
        out = stage(spark, own, sf).collect()
        assert out and all(
            (
                r["score"], r["predicted"], r["toxic"], r["grade"], r["size"], r["taken"], r["node"], r["id"]
            ) == (123, 7, True, 9, -5, 8, "n", 4) for r in out
        )
        assert {tuple(r[c] for c in theirs) for r in out} == {(6, 7, 8, 9, 10, True, 0, 1, 1, 1)}
        assert stage(spark, own.filter("false"), sf).count() == 0
    assert cp.STAGES[4][1](spark, own, sf).count() == len(base)


def test_which_of_repeated_rows_stays(spark):
    words = "the same words again and again in one text"
    rows_ = [(1, words.upper(), "a"), (1, words, "b"), (1, words, "a"), (1, f" {words}", "c")]
    kept = set()
    for order in (rows_, rows_[::-1], rows_[2:] + rows_[:2]):
        df = spark.createDataFrame(order, "doc_id long, text string, lang string").repartition(3)
        kept.add(tuple(tuple(r) for r in jaccard.drop_near_copies(df).collect()))
    assert len(kept) == 1 and len(kept.pop()) == 1


def test_pipeline_stages_against_their_operators(spark):
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.001"
    docs_ = cp._documents(spark, sf)
    toxic = {r["doc_id"] for r in queries.op1_toxicity(spark, sf).filter("toxic").collect()}
    bad = {r["doc_id"] for r in queries.op4_quality(spark, sf).filter("score < 0.5").collect()}
    ids = {r["doc_id"] for r in docs_.collect()}
    assert {r["doc_id"] for r in cp.drop_toxic(spark, docs_, sf).collect()} == ids - toxic
    assert {r["doc_id"] for r in cp.drop_low_quality(spark, docs_, sf).collect()} == ids - bad
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs_).collect()}
    words = Counter()
    for r in cp.mix_sources(spark, docs_, sf).collect():
        words[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert dict(words) == {k: n for k, n in taken.items() if n}
    pieces = cp.pack_sequences(spark, docs_, sf).toPandas()
    assert pieces.groupby("doc_id")["length"].sum().to_dict() == {
        r["doc_id"]: len(_ids(r["text"])) + 1 for r in docs_.collect()
    }


def test_repeated_ids_among_labelled_rows(spark):
    from wearlake.llm.labelled import class_counts, labelled_sample

    d = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "e")], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (2, 0), (3, 1), (3, 0), (None, 1), (9, 0)], "doc_id long, quality int"
    )
    assert labelled_sample(d, labels, "quality", 10).count() == 2 and class_counts(labels, "quality") == (2, 1)
