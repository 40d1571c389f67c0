"""The queries of the numbered operators, and their DuckDB SQL where there is one."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.llm.attention_lm import score_documents
from retailflow.llm.chunking import repeated_chunks
from retailflow.llm.content_sort import content_sort
from retailflow.llm.divergence import divergence_audit
from retailflow.llm.fp_tree import lexical_search
from retailflow.llm.mixing import mix
from retailflow.llm.order_minhash import near_duplicates
from retailflow.llm.packing import pack_documents
from retailflow.llm.permutation_index import nearest
from retailflow.llm.quality import quality_report
from retailflow.llm.suffix_dedup import suffix_dedup
from retailflow.llm.toxicity import toxicity_report
from retailflow.llm.warc import archive_pages, index_captures


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_index(spark, sf_dir):
    index, _ = archive_pages(_table(spark, sf_dir, "pages"))
    return index_captures(index).select(
        "page_id",
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        "refers_to",
    )


def op2_attention_lm(spark, sf_dir):
    return score_documents(_table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark, sf_dir):
    return pack_documents(_table(spark, sf_dir, "documents"))


def op4_suffix_arrays(spark, sf_dir):
    return suffix_dedup(_table(spark, sf_dir, "documents"))


def op5_gear_chunks(spark, sf_dir):
    return repeated_chunks(_table(spark, sf_dir, "documents"))


def op6_permutation_index(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op7_quality_classifier(spark, sf_dir):
    return quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_order_minhash(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op9_source_mixing(spark, sf_dir):
    rows = mix(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "source",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


def op10_content_sort(spark, sf_dir):
    rows = content_sort(_table(spark, sf_dir, "documents"), keep="largest")
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op11_source_divergence(spark, sf_dir):
    return divergence_audit(_table(spark, sf_dir, "documents"))


def op12_fp_tree_search(spark, sf_dir):
    return lexical_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_toxicity_trees(spark, sf_dir):
    return toxicity_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc_index,
        op2_attention_lm,
        op3_best_fit_packing,
        op4_suffix_arrays,
        op5_gear_chunks,
        op6_permutation_index,
        op7_quality_classifier,
        op8_order_minhash,
        op9_source_mixing,
        op10_content_sort,
        op11_source_divergence,
        op12_fp_tree_search,
        op13_toxicity_trees,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op1_warc_index": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), q AS (
  SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p
), r AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS last FROM q
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN last IS NULL OR page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM r
""",
    "op9_source_mixing": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS size,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source
), step(i, source, size, w, capped) AS (
  SELECT 0, source, size, w, false FROM s
  UNION ALL
  -- Each step fixes the sources that the share of what is left would lift above their cap.
  SELECT i + 1, source, size, w, capped OR hit FROM (
    SELECT *, (NOT capped) AND 2 * size * 2 * (sum(CASE WHEN capped THEN 0 ELSE w END) OVER ())
              <= w * (3 * (sum(size) OVER ()) - 2 * (sum(CASE WHEN capped THEN 2 * size ELSE 0 END) OVER ())) AS hit
    FROM step) WHERE i < 60
), f AS (
  SELECT source, size,
         CASE WHEN capped THEN (2 * size)::DOUBLE
              ELSE (w * (150 * sum(size) OVER () - 100 * sum(CASE WHEN capped THEN 2 * size ELSE 0 END) OVER ()))::DOUBLE
                   / (100 * sum(CASE WHEN capped THEN 0 ELSE w END) OVER ())::DOUBLE END AS target
  FROM step WHERE i = 60
), r AS (
  SELECT d.doc_id, d.source, d.size, f.size AS source_size, f.target,
         CASE WHEN f.size > 0 THEN floor(f.target / f.size)::BIGINT ELSE 0 END AS passes,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place) - d.size / 2.0 AS middle
  FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source
)
SELECT doc_id, source, size, source_size, target,
       (size * (passes + CASE WHEN middle < target - passes * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
""",
    "op10_content_sort": f"""
WITH t AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
""",
    "op11_source_divergence": rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), t AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
g AS (
  SELECT lang, source, coalesce(any_value(s.n), 0)::HUGEINT AS n FROM d
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source) s USING (lang, source)
  GROUP BY lang, source
), p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS times,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * l.v) AS p,
         1 + (1000000000::HUGEINT * (kept.n + 2)) // (l.n + 2 * l.v) AS q
  FROM g JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN c USING (lang, source, term)
), f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE times > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM r
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
""",
    "op12_fp_tree_search": rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), s AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0),
t AS (
  SELECT row, doc_id, n, term, count(*) AS tf
  FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL
), i AS (
  SELECT DISTINCT item_id, text,
         unnest(list_distinct(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
  FROM benchmark
), w AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM t CROSS JOIN s GROUP BY term
), r AS (
  SELECT item_id, text, row, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))))::BIGINT AS score
  FROM i JOIN t USING (term) JOIN w USING (term) CROSS JOIN s
  GROUP BY item_id, text, row, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
  FROM r WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50
""",
}
