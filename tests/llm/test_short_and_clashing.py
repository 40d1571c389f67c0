"""Texts of few words wherever batches are cut, and columns named like those used inside."""

import random

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import DOC_SCHEMA, SF_DIR
from pyspark.sql import functions as F
from retailflow.llm import quality
from retailflow.llm.content_sort import drop_exact_copies
from retailflow.llm.mixing import mix, mixed_documents
from retailflow.llm.order_minhash import drop_near_copies, near_duplicates, sketches
from retailflow.llm.words import SLICE_BYTES, row_slices, shingle_codes

INSIDE = (
    "cut", "passes", "mix_source", "mix_place", "mix_size", "mix_source_size", "mix_target", "mix_copies", "_document", "_whole",
    "row", "id", "digest", "word", "c", "n", "keys", "start", "chunk", "body", "score", "size", "a", "b", "node", "root",
    "prefix", "label_id", "y", "bucket", "part", "place", "_part", "_row", "min_id", "class_id", "kept", "keep_id",
)


@pytest.mark.parametrize("words", range(8))
def test_any_number_of_words_alone(words):
    text = " ".join(f"w{i}" for i in range(words)).encode()
    doc, _ = shingle_codes([text])
    assert len(doc) == (max(words - 4, 1) if words else 0)
    sketches([text])


@pytest.mark.parametrize("words", (2, 3))
def test_few_words_alone_in_a_partition(spark, words):
    text = " ".join(f"w{i}" for i in range(words))
    docs = spark.createDataFrame([(1, text, "en", "s", 1)], DOC_SCHEMA).coalesce(1)
    assert [r.doc_id for r in near_duplicates(docs).collect()] == [1]
    assert [r.text for r in drop_near_copies(docs).collect()] == [text]


def test_few_words_before_a_long_text(spark):
    long = " ".join(f"x{i}" for i in range(450_000))
    batch = pa.record_batch({"text": ["w0 w1", long]})
    assert len(long) > SLICE_BYTES and [p.num_rows for p in row_slices(batch, 0)] == [1, 1]
    docs = spark.createDataFrame([(1, "w0 w1", "en", "s", 1), (2, long, "en", "s", 1), (3, "w0 w1", "en", "s", 1)], DOC_SCHEMA)
    found = {r.doc_id: r.class_id for r in near_duplicates(docs.coalesce(1)).collect()}
    assert found[1] == found[3] != found[2]


def _with_clashes(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefgh") * 3 for _ in range(40)), "en", f"s{i % 3}", 9) for i in range(30)]
    docs = spark.createDataFrame(rows + rows[:4], DOC_SCHEMA)
    return docs.withColumns({c: F.lit(f"own {c}") for c in INSIDE})


def test_clashing_columns_pass_every_stage(spark):
    docs = _with_clashes(spark)
    plain = docs.select(*[f.split()[0] for f in DOC_SCHEMA.split(", ")])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows, few = stage(spark, docs, SF_DIR), stage(spark, plain, SF_DIR)
        assert rows.columns == docs.columns, name
        assert all(r[c] == f"own {c}" for r in rows.collect() for c in INSIDE), name
        assert sorted(map(str, rows.select(*plain.columns).collect())) == sorted(map(str, few.collect())), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() > 0


def test_mix_replaces_its_four_columns_only(spark):
    mixed = mix(_with_clashes(spark))
    assert all(r.cut == "own cut" and r.passes == "own passes" and r.mix_size == 40 for r in mixed.collect())
    assert mixed_documents(_with_clashes(spark)).columns == _with_clashes(spark).columns


def test_same_trees_for_any_partitions_of_a_large_table(spark):
    labels = spark.range(6000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    text = F.concat_ws(" ", *[F.md5(F.concat("doc_id", F.lit(i)).cast("binary")) for i in range(3)])
    docs = labels.withColumn("text", F.when(F.col("quality") == 1, text).otherwise(F.concat(text, F.lit(" !!!"))))
    one, other = (
        quality.fit_quality(docs.repartition(n, F.rand(n)), labels.repartition(n, F.rand(n)), max_rows=500) for n in (2, 9)
    )
    assert np.array_equal(one.feature, other.feature) and np.array_equal(one.cut, other.cut)
    assert np.array_equal(one.leaf, other.leaf)


def test_stages_keep_one_row_whatever_the_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "same text here"), (1, "same text here"), (1, "other"), (None, "q"), (None, "q"), (7, "q"), (7, "q"), (None, text)]
    near = [(5, text + " more"), (5, text + " more"), (9, None), (None, ""), (8, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows + near], DOC_SCHEMA).repartition(5)
    exact = sorted(((r.doc_id, r.text) for r in drop_exact_copies(docs).collect()), key=str)
    assert exact == sorted(
        [(1, "same text here"), (1, "other"), (None, "q"), (None, text), (5, text + " more"), (None, ""), (8, " ")], key=str
    )
    largest = [r.doc_id for r in drop_exact_copies(docs, keep="largest").where("coalesce(text, '') IN ('', 'q')").collect()]
    assert sorted(largest) == [7, 9]
    kept = sorted(((r.doc_id, r.text) for r in drop_near_copies(docs).collect()), key=str)
    assert kept == sorted([(1, "same text here"), (1, "other"), (None, "q"), (None, text), (None, "")], key=str)
    assert drop_exact_copies(docs.limit(0)).count() == drop_near_copies(docs.limit(0)).count() == 0
