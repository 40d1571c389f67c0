"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_helpers import CLASHES, LONG, SF_DIR, documents, empty_documents, messy_documents, messy_rows, words_of
from retailflow.llm import attention_lm, chunking, content_sort, mixing, order_minhash, packing, permutation_index, quality, suffix_dedup, warc
from retailflow.llm.components import components
from retailflow.llm.shared import shared_table

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def messy(spark):
    return shared_table(messy_documents(spark), "messy")


def labels(spark):
    rows = [(i, i % 2, 0) for i in range(12)] + [(None, 1, 0), (3, None, 0), (4, 7, 0), (5, 1, 1), (99, 1, 0)]
    return spark.createDataFrame(rows, LABELS).withColumn("text", F.lit("other"))


def by_id(df, column):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r[column])
    return out


def test_content_sort(spark, messy):
    for keep, pick in (("smallest", min), ("largest", max)):
        got = content_sort.content_sort(messy, keep=keep).collect()
        groups = {}
        for i, t, *_ in messy_rows():
            groups.setdefault((t or "").encode().lower(), []).append(i)
        # A null id is smaller than any.
        key = lambda i: -1 if i is None else i
        want = Counter()
        for ids in groups.values():
            stays = pick(ids, key=key)
            for i in ids:
                want[i, stays, len(ids)] += 1
        assert Counter((r.id, r.keep_id, r.group_size) for r in got) == want
        assert sum(r.kept for r in got) == len(groups)
        assert all(r.id == r.keep_id for r in got if r.kept)
    assert content_sort.content_sort(empty_documents(spark)).count() == 0


def test_copies_fill_many_partitions(spark, conf):
    conf("spark.sql.shuffle.partitions", "7")
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("one text")).otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    got = content_sort.content_sort(docs, keep="largest")
    hot = got.where("group_size > 1")
    assert hot.select("keep_id", "group_size").distinct().collect() == [(2999, 2000)]
    assert hot.count() == 2000 and got.where("kept").count() == 1001


def test_mixing(spark, messy):
    got = mixing.mix(messy)
    assert set(got.columns) == {*messy.columns, "mix_size", "mix_source_size", "mix_target", "mix_copies"}
    rows = got.collect()
    assert len(rows) == len(messy_rows())
    sizes = Counter()
    for _, t, _, s, _ in messy_rows():
        sizes[s] += len(words_of(t))
    assert all(r.mix_size == len(words_of(r.text)) and r.mix_source_size == sizes[r.source] for r in rows)
    assert all(0 <= r.mix_copies <= 2 for r in rows)
    assert mixing.mixed_documents(messy).columns == messy.columns
    assert mixing.mix(empty_documents(spark)).count() == 0
    nothing = spark.createDataFrame([(1, None, "s"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.mix_size, r.mix_target) for r in mixing.mix(nothing).collect()] == [(0, 0.0)] * 2


def test_packing(spark, messy):
    rows = packing.pack_documents(messy).collect()
    want = Counter()
    for i, t, *_ in messy_rows():
        want[i] += len(words_of(t)) + 1
    got = Counter()
    for r in rows:
        got[r.doc_id] += r.piece_tokens
    assert got == want
    assert packing.pack_documents(empty_documents(spark)).count() == 0
    odd = spark.createDataFrame([(1, None), (2, 0), (3, -4), (4, 5000)], "doc_id long, n_tokens long")
    assert sorted((r.doc_id, r.piece_tokens, r.bin_capacity) for r in packing.pack(odd).collect()) == [(4, 904, 1024), (4, 4096, 4096)]


def test_quality(spark, messy):
    got = quality.quality_report(messy, labels(spark))
    rows = got.collect()
    assert len(rows) == len(messy_rows()) and all(0 <= r.score <= 1 for r in rows)
    empties = {r.score for r in rows if r.doc_id in (100, 101)}
    assert len(empties) == 1  # null as empty
    none = quality.quality_report(messy, spark.createDataFrame([], LABELS))
    assert {r.score for r in none.collect()} == {0.5}
    assert quality.quality_report(empty_documents(spark), labels(spark)).count() == 0
    kept = quality.keep_good(messy, labels(spark))
    assert kept.schema == messy.schema
    good = Counter(r.doc_id for r in rows if r.predicted)
    assert Counter(r.doc_id for r in kept.collect()) == good


def test_order_minhash(spark, messy):
    classes = by_id(order_minhash.near_duplicates(messy), "class_id")
    assert classes[3] == classes[105] == classes[106] == [3]
    assert classes[107] == classes[108] == [107]
    assert classes[103] == classes[104] == [103]  # very long, one word more
    assert classes[100] == classes[101] == classes[102] == [100]  # no words
    assert classes[7] == [7, 7, 7] and classes[None] == [None, None]
    assert classes[109] == classes[110] == [109] or classes[110] == [110]
    assert order_minhash.near_duplicates(empty_documents(spark)).count() == 0


def test_copies_that_only_their_base_is_near_to(spark):
    """Ten copies of one text, each with its own changes: near to the base, not to each other."""
    words = [f"w{i * 7919 % 100003}" for i in range(600)]
    rows = [(50, " ".join(words))]
    for k in range(10):
        own = list(words)
        for j in range(10):
            own[k * 60 + j * 6] = f"change{k}x{j}"
        rows.append((k, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = by_id(order_minhash.near_duplicates(docs), "class_id")
    assert all(v == [0] for v in classes.values())


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 201), (200, 202)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    want = {i: 0 for i in range(1, 41)} | {101: 100, 201: 200, 202: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_suffix_dedup(spark, messy):
    got = by_id(suffix_dedup.suffix_dedup(messy), "n_removed")
    assert got[103] == [len(LONG)] and got[104] == [len(LONG)]
    repeated = len(messy_rows()[7][1])
    assert got[7] == ([repeated] * 3 if repeated >= suffix_dedup.WIDTH else [0] * 3)
    assert got[100] == got[101] == [0] and got[None] == [0, 0]
    both = got[109][0]
    assert both == got[110][0] >= suffix_dedup.WIDTH
    assert suffix_dedup.suffix_dedup(empty_documents(spark)).count() == 0


def test_strings_that_overlap_themselves(spark):
    docs = spark.createDataFrame([(1, "ab" * 400), (2, "z" * 399), (3, "q" * 401), (4, "é" * 300)], "doc_id long, text string")
    got = by_id(suffix_dedup.suffix_dedup(docs), "n_removed")
    assert got == {1: [800], 2: [0], 3: [401], 4: [600]}


def test_chunking(spark, messy):
    got = by_id(chunking.repeated_chunks(messy), "n_removed")
    assert got[3] == [0] and got[105][0] > 0 and got[106] == got[105]
    assert sorted(got[7])[0] == 0 and got[103] == [0] and got[104][0] > len(LONG) - 400
    assert got[100] == got[101] == [0] and len(got[None]) == 2
    kept = by_id(chunking.without_repeats(messy), "text")
    assert kept[3] == [messy_rows()[3][1]] and kept[100] == [None]
    assert len(kept[104][0]) < 400
    assert chunking.repeated_chunks(empty_documents(spark)).count() == 0


def test_attention_lm(spark, messy):
    rows = attention_lm.score_documents(messy).collect()
    assert Counter(r.n_tokens for r in rows) == Counter(len(words_of(t)) + 1 for _, t, *_ in messy_rows())
    assert all(r.score < 0 and r.base_score < 0 for r in rows)
    assert attention_lm.score_documents(empty_documents(spark)).count() == 0
    # The one row is held out (crc32('1') % 5 is 1 for some id below), so nothing is learnt.
    import zlib

    held = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1)
    one = spark.createDataFrame([(held, "two words", None, None, 0)], "doc_id long, text string, lang string, source string, n_chars long")
    (r,) = attention_lm.score_documents(one).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0) and r.score < 0


def test_permutation_index(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 5 + 1), float(i % 3), 1.0]) for i in range(40)]
    rows += [(100, None), (101, []), (102, [0.0] * 3), (103, [nan, 1.0, 1.0]), (104, [inf, 1.0, 1.0]), (105, [1.0, None, 1.0]), (None, [1.0] * 3), (106, [1.0] * 4), (7, rows[7][1])]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(0) for c in CLASHES if c != "score"})
    data = data.withColumn("v", F.lit(1)).withColumn("score", F.lit(2)).withColumn("rank", F.lit(1)).withColumn("block", F.lit(1))
    got = permutation_index.nearest(data, data.where("vec_id % 20 = 0"), top=5).collect()
    by_query = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by_query.setdefault(r.query_id, []).append((r.vec_id, r.score))
    vectors = dict(rows[:40])
    for q in (0, 20):
        scores = {i: sum(a * b for a, b in zip(vectors[q], v)) for i, v in vectors.items() if i != q}
        assert by_query[q] == sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:5]
    assert by_query.keys() == {0, 20}
    assert permutation_index.nearest(data.limit(0), data.limit(0)).count() == 0
    few = permutation_index.nearest(data.where("vec_id < 3"), data.where("vec_id = 0"))
    assert [r.vec_id for r in few.orderBy("rank").collect()] and few.count() == 2


PAGES = "page_id long, url string, html string"


def test_warc(spark):
    big, tail = "<p>é</p>\r\n\r\nWARC/1.0\r\n" * 60, "x" * 999
    rows = [
        (1, "http://www.a.org/x", big), (2, "http://a.org/y?q=1 2", big), (3, None, None), (4, "http://b.org/\r\nX: y", ""),
        (5, "http://b.org/ü%20", tail), (6, "http://b.org/", tail), (None, "http://c.org/", "small"), (9, "http://a.org/x", big), (9, "http://a.org/x", big),
        (10, "http://z.org/", "y" * 300_000),
    ]
    pages = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit(1) for c in ("digest", "bytes", "key", "file", "last", "n", "block")})
    index, _ = warc.archive_pages(pages)
    got = Counter((r.page_id, r.url, r.bytes, r.kind, r.refers_to) for r in warc.index_captures(index).collect())
    want = Counter()
    for i, url, html in rows:
        repeat = html == big and i != 9
        want[i, url or "", len((html or "").encode()), "revisit" if repeat else "response", 9 if repeat else None] += 1
    assert got == want
    found = warc.CaptureIndex.open(index)
    captures = found.lookup("http://a.org/x")
    assert [(c["page_id"], c["kind"]) for c in captures] == [(1, "revisit"), (9, "response"), (9, "response")]
    assert found.read(captures[1]) == big.encode()
    assert found.read(found.lookup("http://z.org/")[0]) == b"y" * 300_000
    assert found.lookup("http://nowhere.org/") == []
    empty, _ = warc.archive_pages(spark.createDataFrame([], PAGES))
    assert warc.index_captures(empty).count() == 0
    assert warc.CaptureIndex.open(empty).lookup("http://a.org/") == []


def test_lookup_through_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    pages = spark.range(300).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://h"), (F.col("id") % 20).cast("string"), F.lit(".org/p")).alias("url"), F.lit("t").alias("html")
    )
    found = warc.CaptureIndex.open(warc.archive_pages(pages)[0])
    for k in (0, 7, 19):
        assert [c["page_id"] for c in found.lookup(f"http://h{k}.org/p")] == list(range(k, 300, 20))


def test_pipeline_stage_by_stage(spark):
    """Each stage of the whole against a plain version of its decision."""
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    docs = documents(spark)
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = shared_table(stage(spark, docs, SF_DIR), f"test_{name}")
        kept.append(docs.collect())
        if name != "packing":
            assert docs.columns == documents(spark).columns
    everything = {r.doc_id: r for r in documents(spark).collect()}
    good = {r.doc_id for r in quality.quality_report(documents(spark), spark.read.parquet(f"{SF_DIR}/labels.parquet")).collect() if r.predicted}
    assert {r.doc_id for r in kept[0]} == good and 0 < len(good) < len(everything)
    first = {}
    for i in sorted(good):
        first.setdefault(everything[i].text.encode().lower(), i)
    assert sorted(r.doc_id for r in kept[1]) == sorted(first.values())
    near = order_minhash.near_duplicates(spark.createDataFrame(kept[1], docs_schema(spark)))
    assert sorted(r.doc_id for r in kept[2]) == sorted({r.class_id for r in near.collect()})
    copies = Counter(r.doc_id for r in kept[3])
    assert set(copies) <= {r.doc_id for r in kept[2]} and max(copies.values()) <= 2
    total = sum(len(words_of(r.text)) for r in kept[2])
    assert abs(sum(len(words_of(r.text)) for r in kept[3]) - 1.5 * total) < 0.1 * total
    tokens = Counter()
    for r in kept[4]:
        tokens[r.doc_id] += r.piece_tokens
    assert tokens == Counter({i: n * (len(words_of(everything[i].text)) + 1) for i, n in copies.items()})
    again = Counter()
    for r in corpus_pipeline.run(spark, SF_DIR).collect():
        again[r.doc_id] += r.piece_tokens
    assert again == tokens


def docs_schema(spark):
    return documents(spark).schema
