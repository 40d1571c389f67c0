"""The whole job: cases that a cap, a sample or a threshold would lose."""

import hashlib
import random
from collections import Counter
from itertools import combinations, product

import numpy as np
import pyarrow as pa

import corpus_pipeline
from llm_helpers import SF_DIR
from retailflow.llm import attention_lm, chunking, order_minhash, suffix_dedup, warc


def template_family(families, seed=3):
    """(doc_id, text): twins at 0.84 among texts of one template that are at 0.75 to each other."""
    rng = random.Random(seed)
    word = lambda: f"x{rng.randrange(10**9)}"
    template = [f"t{i}" for i in range(84)]
    rows = []
    for f in range(families):
        own = [word() for _ in range(14)]
        rows.append((f, " ".join([*template, *own])))
        rows.append((10_000 + f, " ".join([*template, *own[:6], *(word() for _ in range(8))])))
    return rows


def brute_force_classes(rows):
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_op8_twins_in_a_large_template_family(spark):
    rows = template_family(400)
    want = brute_force_classes(rows)
    assert len(set(want.values())) == 400
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in order_minhash.near_duplicates(docs).collect()} == want
    kept = corpus_pipeline.near_dedup(spark, docs, SF_DIR).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(want.values()))


def test_op8_cells_of_a_large_class(spark):
    """Two large classes, many small ones: all pairs across classes meet once, and no cell is of one class."""
    part = {i: 0 if i < 2500 else 2500 if i < 3500 else i for i in range(4200)}
    rows = spark.createDataFrame([(0, 77, i, p) for i, p in part.items()], "at int, key long, doc_id long, part long")
    rows = rows.union(rows.where("doc_id >= 4198 OR doc_id < 600").withColumn("key", rows["key"] + 1))
    for key, docs in ((77, range(4200)), (78, [*range(600), 4198, 4199])):
        members, copies = {}, 0
        for r in order_minhash._dealt(rows.where(rows["key"] == key)).collect():
            for other in r.others:
                members.setdefault((min(r.cell, other), max(r.cell, other)), {}).setdefault(r.cell, []).append(r.doc_id)
                copies += 1
        met = Counter()
        for (low, high), sides in members.items():
            if low == high:
                assert len({part[i] for i in sides[low]}) > 1
            else:
                assert {part[i] for i in sides.get(low, [])} | {part[i] for i in sides.get(high, [])} != {0}
            left = sides.get(low, [])
            pairs = combinations(left, 2) if low == high else product(left, sides.get(high, []))
            met.update((min(i, j), max(i, j)) for i, j in pairs if part[i] != part[j])
        assert set(met.values()) == {1}
        assert len(met) == sum(part[i] != part[j] for i, j in combinations(docs, 2))
        if key == 78:  # 600 of one class in two cells and two strangers in one
            assert copies <= 600 + 2 * 3


def test_op8_near_copies_and_strangers_in_one_bucket(spark, monkeypatch):
    monkeypatch.setattr(order_minhash, "CELL", 16)
    rows = template_family(60)
    base = rows[0][1].split()
    rows += [(20_000 + i, " ".join([*base[:95], f"c{i}", *base[96:]])) for i in range(150)]
    want = brute_force_classes(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in order_minhash.near_duplicates(docs).collect()} == want


def test_op1_files_are_bounded_by_bytes(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 40_000)
    monkeypatch.setattr(warc, "ARCHIVE_STEPS", [1_000, 10_000])
    sizes = [i % 900 for i in range(300)] + [9_000] * 20 + [60_000, 70_000, 0]
    rows = [(i, f"http://h.org/{i}", "abcdefghij"[i % 10] * n) for i, n in enumerate(sizes)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    index, path = warc.archive_pages(pages, str(tmp_path / "archives"))
    got = {r.page_id: (r.bytes, r.digest) for r in warc.index_captures(index).collect()}
    assert got == {i: (len(t), hashlib.sha1(t.encode()).hexdigest()) for i, _, t in rows}
    files = sorted(f.stat().st_size for f in (tmp_path / "archives").glob("part-*"))
    head = 500  # bytes of a record's headers, at most
    assert all(size <= 40_000 + 40 * head for size in files[:-2]) and 60_000 < files[-2] < files[-1] < 70_000 + head


def test_op2_learns_from_all_text_and_real_pairs_across_words(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("ab cd ef gh".split()) for _ in range(n)) for n in (3000, 700, 3, 1)] + ["", None]
    docs = spark.createDataFrame([(2 * i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = docs.where(~attention_lm.held_out(docs["doc_id"]))
    learnt = [(r.text or "").encode().split() for r in docs.collect()]
    assert len(learnt) > 3
    got = attention_lm.gather(docs, attention_lm.TOKENIZER).collect()
    trained = Counter(w for r in got if r.excerpt is not None for w in bytes(r.excerpt).split())
    assert trained == Counter(w for ws in learnt for w in ws)
    assert sum(bool(r.closed) for r in got) == len(learnt)
    encode = attention_lm.encoder(attention_lm.TOKENIZER).encode_ordinary
    want = Counter()
    for ws in learnt:
        pieces = [attention_lm.subwords(w, encode) for w in (b"", *ws, b"")]
        want.update(a[-1] * attention_lm.SUBWORDS + b[0] for a, b in zip(pieces, pieces[1:]))
    found = Counter()
    for r in got:
        if r.pair is not None:
            found[r.pair] += r.n
    assert found == want


def test_op2_deals_equal_excerpts_to_many_places(spark):
    docs = spark.range(1000).selectExpr("id AS doc_id", "'one text of all' AS text").repartition(3)
    got = attention_lm.gather(docs, attention_lm.TOKENIZER).where("excerpt IS NOT NULL")
    places = [r.place for r in got.select(attention_lm.place().alias("place")).collect()]
    assert len(places) > 700 and len(set(places)) > 0.99 * len(places)
    assert all(0.4 < sum(p % 2 == turn for p in places) / len(places) < 0.6 for turn in (0, 1))


def test_op5_finds_passages_of_51_words(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8))) for _ in range(5000)]
    some = lambda n: " ".join(rng.choices(words, k=n))
    rows, places = [], {}
    for i in range(500):
        passage, before = some(51), some(60) + " "
        rows.append((i, f"{some(45)} {passage} {some(60)}"))
        rows.append((1000 + i, f"{before}{passage} {some(30)}"))
        places[1000 + i] = (len(before), len(before) + len(passage))
    got = {r.doc_id: r for r in chunking.repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    caught = sum(got[i].n_removed > 0 for i in places)
    assert caught >= 0.99 * len(places)
    assert sum(got[i].n_removed for i in places) >= 0.7 * sum(b - a for a, b in places.values())
    # Nothing but the passages goes, but for bytes beside them that are equal by chance.
    assert all(a - 4 <= s.start and s.end <= b + 4 for i, (a, b) in places.items() for s in got[i].spans or [])
    assert not any(got[i].n_removed for i in range(500))


def test_op5_blocks_of_any_size_give_the_same(spark, monkeypatch):
    rng = random.Random(8)
    passages = [" ".join(f"w{rng.randrange(400)}" for _ in range(70)) for _ in range(40)]
    rows = [(i, " ".join(rng.choices(passages, k=rng.randrange(6)))) for i in range(300)]
    # Ids that are null or repeat, in other blocks too; one passage in every document of a stretch.
    rows += [(None, passages[0]), (7, passages[1] + " " + passages[1]), (None, passages[0]), (9, None)]
    rows += [(1000 + i, f"{passages[2]} only here {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    found = []
    for block, group in ((1 << 20, 500_000), (100, 50), (1, 7)):
        monkeypatch.setattr(chunking, "BLOCK_CHUNKS", block)
        monkeypatch.setattr(chunking, "GROUP_CHUNKS", group)
        found.append(sorted(map(str, chunking.repeated_chunks(docs).collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) == len(rows)


def test_op5_equal_halves_of_a_digest_are_told_apart():
    digest = lambda *pairs: np.array(pairs, np.uint64).tobytes()
    table = pa.table({
        "block": [10, 20, 30], "group": [0, 0, 0], "base": [0, 5, 0],
        "digests": [digest((1, 1), (2, 2)), digest((1, 3), (2, 2)), digest((1, 1), (1, 3), (4, 4))],
        "docs": pa.array([[8, 9], [3, None], [8, 1, 2]], pa.list_(pa.int64())),
    })
    got = chunking._later(table).to_pylist()
    assert got == [
        {"block": 10, "entries": [1], "from_docs": [None]},  # a null id is the smallest
        {"block": 20, "entries": [5], "from_docs": [1]},
        {"block": 30, "entries": [0], "from_docs": [8]},  # equal ids: the earlier block
    ]


def test_op5_cuts_do_not_depend_on_the_text_before(spark):
    rng = np.random.default_rng(6)
    texts = [rng.integers(97, 123, 400).astype(np.uint8) for _ in range(50)]
    size = np.full(50, 400)
    together = chunking.cut_points(np.concatenate(texts), np.cumsum(size) - size, size)
    assert together == [chunking.cut_points(t, np.array([0]), np.array([400]))[0] for t in texts]


def test_stretches_of_periodic_text_are_bounded():
    text = "0123456789abcdefghijklmnopqrstuvwxyz" * 3000
    cores = np.unique(suffix_dedup.stretches([text.encode()])["core"])
    batch = pa.record_batch({
        "doc_id": pa.array([1]), "body": pa.array([2]), "text": [text], "cores": pa.array([cores.tolist()], pa.list_(pa.int64())),
    })
    (pieces,) = suffix_dedup._candidates(iter([batch]))
    size, start = pieces.column("count").to_numpy(), pieces.column("start").to_numpy()
    assert len(size) > 20 and size.max() <= suffix_dedup.MERGED + suffix_dedup.STEP
    order = np.argsort(start)
    assert size.sum() == len(text) - suffix_dedup.WIDTH + 1
    assert (np.diff(start[order]) == size[order][:-1]).all()
    assert all(text[a : a + n + suffix_dedup.WIDTH - 1].encode() == p for a, n, p in zip(start, size, pieces.column("piece").to_pylist()))


def test_long_periodic_texts_go_whole_and_others_stay(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(map(chr, rng.integers(97, 123, 37)))
    lines = [word() for _ in range(3)]
    rows = [(i, line * 20_000) for i, line in enumerate(lines)]
    rows += [(10, "".join(word() for _ in range(4000))), (11, lines[0] * 12), (12, lines[1] * 8), (13, "".join(word() for _ in range(9)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.suffix_dedup(docs).collect()}
    for i in (0, 1, 2, 11):
        assert got[i][0] == got[i][1] and got[i][2] == 1
    assert [got[i][1] for i in (10, 12, 13)] == [0, 0, 0]
