"""Small tables, plain implementations and DuckDB comparison for the llm tests."""

from collections import Counter

import duckdb

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "labels", "benchmark")

# Names that operators use inside.
CLASHES = (
    "row", "id", "digest", "word", "c", "n", "keys", "start", "chunk", "body", "gram", "score", "size",
    "mix_size", "mix_copies", "a", "b", "node", "root", "prefix", "label_id", "y", "w_id", "c_id", "bucket",
)

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(20_000))
PASSAGE = " ".join(f"passage{i * 7 % 83}" for i in range(70))


def messy_rows():
    """(doc_id, text, lang, source, n_chars): nulls, empty and long texts, ties, repeated rows."""
    prose = [" ".join(f"w{(i * 31 + j * j * 7) % 401}" for j in range(60 + i)) for i in range(12)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(prose)]
    rows += [
        (100, None, None, None, None),
        (101, "", "en", "s1", 0),
        (102, " \t\n ", "en", None, 4),
        (None, "no id here", "en", "s2", 10),
        (None, None, None, None, None),
        (103, LONG, "en", "s0", len(LONG)),
        (104, LONG + " tail", "en", "s1", len(LONG) + 5),
        (105, prose[3], "en", "s2", 5),  # a copy
        (106, prose[3].upper(), "en", "s2", 5),  # a copy but for case
        (107, "one", "en", "s0", 3),
        (108, "One", "en", "s0", 3),
        (109, "ünïcödé ÄÖ " + PASSAGE, "de", "s1", 9),
        (110, PASSAGE + " end of it", "de", "s1", 9),
        (7, prose[7], "en", "s1", len(prose[7])),  # a repeated row
        (7, prose[7], "en", "s1", len(prose[7])),
    ]
    return rows


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def messy_documents(spark):
    docs = spark.createDataFrame(messy_rows(), DOC_SCHEMA)
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit(1) for c in CLASHES})


def empty_documents(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def documents(spark, sf_dir=SF_DIR):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def duckdb_rows(sql, sf_dir=SF_DIR):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def same_rows(df, sql, sf_dir=SF_DIR):
    columns, rows = duckdb_rows(sql, sf_dir)
    assert sorted(columns) == sorted(df.columns)
    order = [df.columns.index(c) for c in sorted(columns)]
    theirs = [columns.index(c) for c in sorted(columns)]
    ours = Counter(tuple(r[i] for i in order) for r in df.collect())
    assert ours == Counter(tuple(r[i] for i in theirs) for r in rows)


def words_of(text):
    return (text or "").encode().lower().split()


def jaccard(a, b):
    """Of the multisets of five-word shingles."""
    a, b = (Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))) for w in (a, b))
    both = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - both
    return both / total if total else 1.0


