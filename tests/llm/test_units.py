"""The numpy parts against plain versions of the same."""

import numpy as np
import pyarrow as pa
import pytest

from retailflow.llm import attention, attention_lm, chunking, mixing, order_minhash, packing, permutation_index, quality, suffix_dedup, warc, words


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(1)
    for t in range(40):
        n = int(rng.integers(1, 160))
        data = rng.integers(0, rng.integers(2, 5), n).astype(np.uint8)
        if t % 3 == 0:
            data = np.tile(data[: max(1, n // 7)], 8)
        order, rank = suffix_dedup.suffix_array(data)
        plain = sorted(range(len(data)), key=lambda i: bytes(data[i:]))
        assert list(order) == plain and list(rank[order]) == list(range(len(data)))
        expected = [0]
        for a, b in zip(plain, plain[1:]):
            k = 0
            while max(a, b) + k < len(data) and data[a + k] == data[b + k]:
                k += 1
            expected.append(k)
        assert list(suffix_dedup.common_prefixes(data, order, rank, 7)) == expected


def test_equal_strings_have_equal_anchors_and_every_string_one():
    rng = np.random.default_rng(2)
    shared = rng.integers(97, 123, 900).astype(np.uint8).tobytes()
    texts = [rng.integers(97, 123, n).astype(np.uint8).tobytes() + shared + b"x" * n for n in (0, 5, 333, 450)]
    found = suffix_dedup.stretches(texts)
    for t, text in enumerate(texts):
        assert found["count"][found["text"] == t].sum() == len(text) - suffix_dedup.WIDTH + 1
    keys = []
    for t, text in enumerate(texts):
        at, mine = text.index(shared), {}
        for i in np.flatnonzero(found["text"] == t):
            for s in range(found["start"][i], found["start"][i] + found["count"][i]):
                mine[s - at] = (found["gram"][i], found["core"][i])
        keys.append([mine[k] for k in range(len(shared) - suffix_dedup.WIDTH + 1)])
    assert all(k == keys[0] for k in keys)


def test_long_texts_in_pieces_give_the_same_stretches(monkeypatch):
    text = np.random.default_rng(3).integers(97, 123, 9000).astype(np.uint8).tobytes()

    def keys():
        f = suffix_dedup.stretches([text])
        return {s: (g, c) for a, n, g, c in zip(f["start"], f["count"], f["gram"], f["core"]) for s in range(a, a + n)}

    whole = keys()
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    assert keys() == whole and len(whole) == len(text) - suffix_dedup.WIDTH + 1


def test_gear_hash():
    data = np.random.default_rng(4).integers(0, 256, 300).astype(np.uint8)
    h = chunking.gear_hash(data)
    for i in range(31, 300):
        plain = sum(int(chunking._GEAR[data[i - j]]) << j for j in range(32)) % 2**32
        assert int(h[i]) == plain


def test_cuts_cover_the_text_and_survive_an_insertion():
    rng = np.random.default_rng(5)
    a = rng.integers(97, 123, 20_000).astype(np.uint8)
    b = np.concatenate((a[:5000], rng.integers(97, 123, 7).astype(np.uint8), a[5000:]))
    cut = []
    for x in (a, b):
        ends = chunking.cut_points(x, np.array([0]), np.array([len(x)]))[0]
        sizes = np.diff([0, *ends])
        assert ends[-1] == len(x) and sizes.max() <= chunking.MAX_CHUNK and sizes[:-1].min() >= chunking.MIN_CHUNK
        cut.append({bytes(x[s:e]) for s, e in zip([0, *ends], ends)})
    assert len(cut[0] & cut[1]) > 0.97 * len(cut[0])


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_is_the_plain_one(seed):
    rng = np.random.default_rng(seed)
    caps = (16, 32, 64)
    lengths = sorted(rng.integers(1, 65, 400).tolist(), reverse=True)
    bins, offsets, final = packing.best_fit(lengths, caps)
    used = dict.fromkeys(bins.tolist(), 0)
    for n, b, o in zip(lengths, bins.tolist(), offsets):
        assert o == used[b]
        used[b] += n
    _plain_best_fit(lengths, caps, bins, final)


def _plain_best_fit(lengths, caps, bins, final):
    """Walk with lists: best fit among open bins, least cost per token for new ones."""

    def cost(c):
        return c + c * c / packing.ATTENTION_SPAN + packing.BIN_OVERHEAD

    left = list(lengths)
    room, used, mine = [], [], []
    stack = {r: [] for r in range(max(caps) + 1)}  # open bins by room, the latest last
    for n in lengths:
        left.remove(n)
        fitting = [r for r in room if r >= n]
        if fitting:
            best = min(fitting)
            b = stack[best].pop()
        else:
            options = []
            for c in caps:
                if c >= n:
                    rest, filled, coming = c - n, n, sorted(left, reverse=True)
                    for x in coming:
                        if x <= rest:
                            rest -= x
                            filled += x
                    options.append((cost(c) / filled, -c))
            b = len(room)
            room.append(-min(options)[1])
            used.append(0)
        used[b] += n
        room[b] -= n
        stack[room[b]].append(b)
        mine.append(b)
    assert mine == list(bins)
    assert list(final) == [next(c for c in sorted(caps) if c >= u) for u in used]


def test_trees_learn_and_flattened_scores_match_a_walk():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = quality.fit_trees(x, y, rounds=40)
    p = trees.score(x)
    assert ((p > 0.5) == y).mean() > 0.97

    def walk(row):
        total = trees.base
        for f, c, leaf in zip(trees.feature, trees.cut, trees.leaf):
            i = 0
            for _ in range(trees.depth):
                i = 2 * i + 1 + int(row[f[i]] > c[i])
            total += leaf[i - len(f)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(p[:50], [walk(r) for r in x[:50]])
    assert quality.fit_trees(np.zeros((0, 5)), np.zeros(0)).score(np.zeros((2, 5))).tolist() == [0.5, 0.5]


def test_statistics_do_not_depend_on_the_neighbours():
    texts = ["Some words. And more", None, "", "a a a a", "LOUD!! WORDS!!", "x" * 10_000, "Ünï cödé"]
    together = quality.statistics(texts)
    for i, t in enumerate(texts):
        assert np.allclose(together[i], quality.statistics([t])[0])
    assert not together[1].any()


def test_gradient():
    counts = np.r_[np.full(1500, 20.0), np.zeros(48_757)]
    vocabulary = attention.Vocabulary(counts)
    vocabulary.learn_pairs(np.random.default_rng(0).integers(0, 3, (vocabulary.begin + 1, attention.CLASSES * attention.MEMBERS + 1)).astype(float))
    flat = attention.initial(vocabulary).astype(float)
    rng = np.random.default_rng(1)
    flat += rng.normal(0, 0.05, len(flat))
    attention.views(flat)["vectors"][vocabulary.blank] = 0
    sizes = np.array([3, 40, 17])
    inputs, targets, blank, _ = attention.layout(rng.integers(0, 1600, sizes.sum()), sizes, vocabulary)
    _, g = attention.gradient(flat, inputs, targets, blank, vocabulary)
    at = 0
    for shape in attention.SHAPES.values():
        size = int(np.prod(shape))
        k = at + int(np.abs(g[at : at + size]).argmax())
        ends = []
        for d in (1e-4, -1e-4):
            moved = flat.copy()
            moved[k] += d
            ends.append(attention.gradient(moved, inputs, targets, blank, vocabulary)[0])
        assert np.isclose(g[k], (ends[0] - ends[1]) / 2e-4, rtol=1e-2, atol=1e-6)
        at += size


def test_scores_are_causal_and_a_distribution():
    rng = np.random.default_rng(2)
    vocabulary = attention.Vocabulary(rng.integers(0, 50, 2000).astype(float))
    vocabulary.learn_pairs(np.zeros((vocabulary.begin + 1, attention.CLASSES * attention.MEMBERS + 1)))
    flat = attention.initial(vocabulary)
    flat += rng.normal(0, 0.1, len(flat)).astype(np.float32)
    attention.views(flat)["vectors"][vocabulary.blank] = 0
    text = rng.integers(0, 2000, 70)
    whole = attention.score(flat, text, np.array([70]), vocabulary)
    assert np.allclose(whole[:50], attention.score(flat, text[:50], np.array([50]), vocabulary), atol=1e-4)
    pair = attention.score(flat, np.r_[text, text[:9]], np.array([70, 9]), vocabulary)
    assert np.allclose(pair, np.r_[whole, whole[:9]], atol=1e-4)
    # Every next token after one beginning: the probabilities add up to one.
    many = np.concatenate([np.r_[text[:20], k] for k in range(2000)])
    last = attention.score(flat, many, np.full(2000, 21), vocabulary).reshape(2000, 21)[:, 20]
    assert np.isclose(np.exp(last).sum(), 1, atol=1e-3)


def test_matched_in_order_decides_as_the_longest_common_subsequence():
    rng = np.random.default_rng(7)

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(max(row[j + 1], new[j], row[j] + (x == y)))
            row = new
        return row[-1]

    for _ in range(300):
        a = rng.integers(0, rng.integers(2, 60), rng.integers(1, 40)).astype(np.uint64)
        b = np.array([x for x in a if rng.random() > 0.1] + [99] * int(rng.integers(0, 3)), np.uint64)
        if rng.random() < 0.3:
            rng.shuffle(b)
        expected = plain(a.tolist(), b.tolist())
        for least in (1, int(0.8 * len(a)) + 1):
            got = order_minhash.matched_in_order(a, b, least)
            assert (got >= least) == (expected >= least) and (got <= expected or got < least)
            if len(set(a.tolist())) == len(a):
                assert got == expected or got < least


def test_sketches_follow_order():
    a = [f"t{i}" for i in range(60)]
    same, moved = " ".join(a).encode(), " ".join(a[30:] + a[:30]).encode()
    _, keys = order_minhash.sketches([same, same, moved, b"", b"one"])
    assert (keys[0] == keys[1]).all() and (keys[0] != keys[2]).mean() > 0.3
    assert not keys[3].any() and keys[4].all()


def test_words_and_shingles():
    doc, code = words.word_codes([b"a bb  a", b"", b"\tbb\n"])
    assert doc.tolist() == [0, 0, 0, 2] and code[0] == code[2] and code[1] == code[3]
    doc, code = words.shingle_codes([b"a b c d e f", b"a b c d e", b"x y", b"", b"x y"])
    assert doc.tolist() == [0, 0, 1, 2, 4] and code[0] == code[2] and code[3] == code[4]
    d, c = np.array([0, 0, 0, 1, 1]), np.array([5, 5, 6, 5, 5], np.uint64)
    assert words.occurrences(d, c).tolist() == [0, 1, 0, 0, 1]


def test_footrule():
    rng = np.random.default_rng(8)
    vectors, pivots = rng.normal(size=(30, 6)), rng.normal(size=(128, 6))
    files = permutation_index.places(vectors, pivots)
    own = files[:, 3].astype(int)
    assert permutation_index.footrule(files, files[:, 3]).tolist() == np.abs(files.astype(int) - own[:, None]).sum(0).tolist()


def test_reversed_host_keys():
    key = warc.reversed_host_key
    assert key("http://www.Example.com:80/a?b=1") == "com,example)/a?b=1"
    assert key("https://sub.example.com:8443") == "com,example,sub:8443)/"
    assert key(None) == "" and key("not a url") == "not a url" and key("http://[bad") == "http://[bad"


def test_water_filling(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), (None, 50), ("c", 0)], "source string, source_size long")
    got = {r.source: (r.weight, r.target) for r in mixing.water_fill(sizes).collect()}
    # 1,725 wanted: a, c and the null source stop at twice their size, b takes the rest.
    assert got == {"a": (5, 200.0), "b": (2, 1425.0), "c": (1, 0.0), None: (5, 100.0)}


def test_excerpts_are_cut_into_the_subwords_of_their_words():
    encode = attention_lm.encoder(attention_lm.TOKENIZER).encode_ordinary
    texts = [(b"", True), (b"a b a", False), (b"", False), ("größer 中文 unforeseeable".encode(), True)] * 300
    want = [[p for w in t.split() + [b""] * c for p in attention_lm.subwords(w, encode)] for t, c in texts]
    assert [x.tolist() for x in attention_lm.cut_excerpts(texts, encode)] == [w for w in want if w]
    assert attention_lm.cut_excerpts([], encode) == []


def test_words_are_cut_in_few_calls_and_once_for_all_tasks():
    real, calls = attention_lm.encoder(attention_lm.TOKENIZER).encode_ordinary, []

    def encode(text):
        calls.append(text)
        return real(text)

    texts = [(f"w{i} größer{i % 7} 中{i}".encode(), i % 2 == 0) for i in range(1000)]
    want = [[p for w in t.split() + [b""] * c for p in attention_lm.subwords(w, real)] for t, c in texts]
    assert [x.tolist() for x in attention_lm.cut_excerpts(texts, encode)] == want
    assert len(calls) < 10
    before = len(calls)
    assert [x.tolist() for x in attention_lm.cut_excerpts(texts, encode)] == want
    assert len(calls) == before


def test_split_is_that_of_bytes():
    rng = np.random.default_rng(3)
    signs = list(" \t\n\x0b\f\raBZé中\x00\x1c\x85  😀")
    texts = ["".join(rng.choice(signs, n)) for n in rng.integers(0, 12, 3000)] + ["", None, " "]
    counts, found = attention_lm._split(pa.array(texts))
    want = [(t or "").encode().lower().split() for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert [w.encode() for w in found.to_pylist()] == [w for ws in want for w in ws]


def test_gradient_and_scores_do_not_depend_on_how_many_blocks_are_worked_on_at_once(monkeypatch):
    rng = np.random.default_rng(1)
    vocabulary = attention.Vocabulary(np.r_[np.full(1500, 20.0), np.zeros(48_757)])
    vocabulary.learn_pairs(rng.integers(0, 3, (vocabulary.begin + 1, attention.CLASSES * attention.MEMBERS + 1)).astype(float))
    flat = attention.initial(vocabulary).astype(float)
    flat += rng.normal(0, 0.05, len(flat))
    sizes = rng.integers(1, 90, 60)
    pieces = rng.integers(0, 1600, sizes.sum())
    inputs, targets, blank, _ = attention.layout(pieces, sizes, vocabulary)
    found = []
    for attend, rows in ((10**6, 10**6), (5, 7), (attention.ATTEND, attention.ROWS)):
        monkeypatch.setattr(attention, "ATTEND", attend)
        monkeypatch.setattr(attention, "ROWS", rows)
        loss, g = attention.gradient(flat, inputs, targets, blank, vocabulary)
        scores = attention.score(flat.astype(np.float32), pieces, sizes, vocabulary)
        assert np.isclose(-scores.mean(), loss, atol=1e-4)
        found.append(g)
    assert np.allclose(found[0], found[1], atol=1e-9) and np.allclose(found[0], found[2], atol=1e-9)
