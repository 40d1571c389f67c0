"""Ranked lexical search: a document FP-tree, walked depth first with bounds, for each query item.

Only terms of the items matter, so a document is the vector of its terms among those, the
terms in most documents first. A task gathers the vectors of some documents, sorts them,
and so lays their prefix tree out as nested runs: documents under one trie path stand
together. Runs of at most 1,024, 128 and 16 documents, cut where the paths part, are the
levels of the tree. Each run keeps, for every term below it, the largest count of the term,
and its smallest length norm, which bound the score of all its documents. A search opens the
most promising run first and leaves out those that cannot reach the documents found so far.

Items are taken in blocks of bounded size that are broadcast, each against all documents.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.llm.terms import LETTERS_DIGITS, term_lists

TOP = 50
BLOCK_BYTES = 8 << 20  # text of the items of one block, about
SHARD_ENTRIES = 1_000_000  # terms of documents in one tree
LEVELS = (1024, 128, 16)  # documents of a run at most
OPEN = 4  # runs opened at once
SLICE_TERMS = 500_000  # terms of documents that are counted at once
DOCS, TERMS = -1, -2  # rows of the counting pass beside those of terms


def impact(tf, m):
    """The part of a score that grows with the count of a term and falls with the length norm."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def length_norm(n: int, docs: int, terms: int) -> int:
    return 100 - 50 + (50 * n * docs) // terms


def weight(docs: int, held: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * held + 1)))


def vectors(raws: list[bytes | None], code: dict[bytes, int]):
    """(document, code, count) of every term with a code, by document; and each text's terms in all."""
    doc, codes, total = [], [], np.zeros(len(raws), np.int64)
    done, size = [], 0

    def count():
        if not codes:
            return
        both = np.concatenate(doc) * len(code) + np.concatenate(codes)
        both, times = np.unique(both, return_counts=True)
        done.append((both, times))
        doc.clear()
        codes.clear()

    get = code.get
    for i, raw in enumerate(raws):
        for terms in term_lists(raw, LETTERS_DIGITS):
            total[i] += len(terms)
            found = np.fromiter((get(t, -1) for t in terms), np.int64, len(terms))
            found = found[found >= 0]
            doc.append(np.full(len(found), i))
            codes.append(found)
            size += len(terms)
            if size > SLICE_TERMS:
                count()
                size = 0
    count()
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), total
    both, times = (np.concatenate(x) for x in zip(*done))
    both, where = np.unique(both, return_inverse=True)  # a very long text may be counted in parts
    times = np.bincount(where, times).astype(np.int64)
    return both // len(code), both % len(code), times, total


class Tree:
    """The tree of one shard: documents in trie order, runs by level, entries by term in each level.

    ids, m: of the documents; doc, term, tf: entries by document, terms ascending.
    """

    def __init__(self, ids, m, doc, term, tf):
        n = len(ids)
        edge = np.searchsorted(doc, np.arange(n + 1))
        paths = term.astype(">u4")
        raw = paths.tobytes()
        keys = [raw[4 * a : 4 * b] for a, b in zip(edge[:-1], edge[1:])]
        order = sorted(range(n), key=keys.__getitem__)
        shared = np.zeros(n + 1, np.int64)  # length of the path shared with the document before
        for i in range(1, n):
            a, b = edge[order[i - 1]], edge[order[i]]
            size = min(edge[order[i - 1] + 1] - a, edge[order[i] + 1] - b)
            differ = term[a : a + size] != term[b : b + size]
            shared[i] = differ.argmax() if differ.any() else size
        self.ids, self.m = ids[order], m[order]
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        # Documents are the last level; the others are nested runs of them.
        bounds, runs = [], [(0, n)]
        for limit in LEVELS:
            runs = [piece for a, b in runs for piece in _parted(a, b, shared, limit)]
            bounds.append(np.array([a for a, _ in runs] + [n]))
        bounds.append(np.arange(n + 1))
        by_term = np.lexsort((place[doc], term))
        term, node, most = term[by_term], place[doc][by_term], tf[by_term]
        self.key, self.gain, self.node, self.sizes = [], [], [], []
        below = None
        for bound in reversed(bounds):
            least = np.minimum.reduceat(self.m, bound[:-1])
            if below is not None:
                # Entries of the level below to those of the runs that hold its runs.
                node = np.searchsorted(bound, below[node], "right") - 1
                new = np.ones(len(term), bool)
                new[1:] = (term[1:] != term[:-1]) | (node[1:] != node[:-1])
                first = np.flatnonzero(new)
                term, node, most = term[first], node[first], np.maximum.reduceat(most, first)
            self.key.insert(0, term * len(least) + node)
            self.gain.insert(0, impact(most, least[node]))
            self.node.insert(0, node)
            self.sizes.insert(0, len(least))
            below = bound[:-1]
        # The runs of the next level that a run opens into.
        self.opens = [np.searchsorted(low, high) for high, low in zip(bounds, bounds[1:])]

    def bounds(self, level: int, terms: np.ndarray, weights: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Upper bounds of the scores in runs low..high of a level (exact ones of documents)."""
        size, key = self.sizes[level], self.key[level]
        a = np.searchsorted(key, terms[:, None] * size + low).ravel()
        b = np.searchsorted(key, terms[:, None] * size + high).ravel()
        length = b - a
        at = np.repeat(a - (np.cumsum(length) - length), length) + np.arange(length.sum())
        gain = self.gain[level][at] * np.repeat(np.repeat(weights, len(low)), length)
        # Scores are whole numbers below 2^53, which doubles add exactly.
        score = np.bincount(self.node[level][at], gain, size)
        nodes = np.concatenate([np.arange(x, y) for x, y in zip(low, high)])
        return nodes, score[nodes].astype(np.int64)

    def search(self, terms: np.ndarray, weights: np.ndarray, best, top: int = TOP):
        """`best` (scores and ids, best first) with the documents of this tree taken in."""
        score, ids = best
        floor = score[top - 1] if len(score) == top else 1
        nodes, most = self.bounds(0, terms, weights, np.array([0]), np.array([self.sizes[0]]))
        stack = [(0, nodes, most)]
        self.opened = 0
        while stack:
            level, nodes, most = stack.pop()
            keep = most >= floor  # equal scores are ranked by id, so they go on
            nodes, most = nodes[keep], most[keep]
            if not len(nodes):
                continue
            if level == len(self.sizes) - 1:
                score = np.concatenate((score, most))
                ids = np.concatenate((ids, self.ids[nodes]))
                first = np.lexsort((ids, -score))[:top]
                score, ids = score[first], ids[first]
                if len(score) == top:
                    floor = score[-1]
                continue
            order = np.argsort(-most, kind="stable")
            if len(order) > OPEN:
                stack.append((level, nodes[order[OPEN:]], most[order[OPEN:]]))
            chosen = np.sort(nodes[order[:OPEN]])
            self.opened += len(chosen)
            opens = self.opens[level]
            stack.append((level + 1, *self.bounds(level + 1, terms, weights, opens[chosen], opens[chosen + 1])))
        return score, ids


def _parted(a: int, b: int, shared: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Runs of at most `limit` documents of a..b, cut where the paths part; neighbours share a run."""
    out, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        if y - x <= limit:
            out.append((x, y))
            continue
        inner = shared[x + 1 : y]
        cuts = [x, *(x + 1 + np.flatnonzero(inner == inner.min())).tolist(), y]
        start = x
        for left, right in zip(cuts, cuts[1:]):
            if right - start > limit and left > start:
                todo.append((start, left))
                start = left
        todo.append((start, y))
    return sorted(out)


NO_ID = np.iinfo(np.int64).max


def _trees(batches: Iterator[pa.RecordBatch], code: dict, docs: int, terms: int) -> Iterator[Tree]:
    """Trees of the documents that hold a term of the items, SHARD_ENTRIES entries or so each."""
    parts, entries, held = [], 0, 0

    def tree():
        ids, m, doc, term, tf = (np.concatenate(x) for x in zip(*parts))
        return Tree(ids, m, doc, term, tf)

    for batch in batches:
        column = batch.column(0)
        all_ids = column.fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
        for start in range(0, batch.num_rows, 512):
            raws = batch.column(1).slice(start, 512).to_pylist()
            doc, term, tf, total = vectors(raws, code)
            if not len(doc):
                continue
            some, doc = np.unique(doc, return_inverse=True)
            m = np.array([length_norm(int(n), docs, terms) for n in total[some]], np.int64)
            parts.append((all_ids[start : start + 512][some], m, doc + held, term, tf))
            held += len(some)
            entries += len(doc)
            if entries > SHARD_ENTRIES:
                yield tree()
                parts, entries, held = [], 0, 0
    if parts:
        yield tree()


def _block_search(docs: DataFrame, items: list[tuple[int, bytes]], top: int) -> DataFrame | None:
    """(item, doc_id, score): each task's best documents of a block of items."""
    sc = docs.sparkSession.sparkContext
    of = {item: sorted({t for terms in term_lists(raw, LETTERS_DIGITS) for t in terms}) for item, raw in items}
    words = sorted({t for terms in of.values() for t in terms})
    code = sc.broadcast({t: i for i, t in enumerate(words)})  # terms of a block of items

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, with_terms, in_all = np.zeros(len(code.value), np.int64), 0, 0
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                _, term, _, total = vectors(batch.column(0).slice(start, 512).to_pylist(), code.value)
                held += np.bincount(term, minlength=len(held))
                with_terms, in_all = with_terms + int((total > 0).sum()), in_all + int(total.sum())
        some = np.flatnonzero(held)
        terms = np.concatenate((some, [DOCS, TERMS]))
        yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array([*held[some], with_terms, in_all], pa.int64())], ["term", "n"])

    # One row per term of the block reaches the driver.
    counted = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {r.term: r.n for r in counted.collect()}
    n_docs, n_terms = counts.get(DOCS, 0), counts.get(TERMS, 0)
    used = sorted((i for i in counts if i >= 0), key=lambda i: (-counts[i], i))  # the most frequent first
    if not used:
        return None
    rank = {words[i]: r for r, i in enumerate(used)}
    weights = np.array([weight(n_docs, counts[i]) for i in used], np.int64)
    queries = {item: np.array(sorted(rank[t] for t in terms if t in rank), np.int64) for item, terms in of.items()}
    shared = sc.broadcast((rank, weights, {item: q for item, q in queries.items() if len(q)}))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, weights, queries = shared.value
        none = np.zeros(0, np.int64)
        best = {item: (none, none) for item in queries}
        for tree in _trees(batches, rank, n_docs, n_terms):
            for item, q in queries.items():
                best[item] = tree.search(q, weights[q], best[item], top)
        for item, (score, ids) in best.items():
            columns = [pa.array(np.full(len(ids), item)), pa.array(ids, mask=ids == NO_ID), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return docs.mapInArrow(search, "item long, doc_id long, score long")


def lexical_search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the `top` documents of each item with a score above 0.

    A score sums weight(term) * impact(count, length norm) over the different terms of the item.
    Equal scores rank by doc_id, a null id last. Ids are whole numbers; documents that repeat an id rank as
    rows of their own. Null and empty texts have no terms. Equal rows of `items` are one item;
    rows that share an item_id with other text are ranked each for itself. Other columns are
    ignored; empty tables and items without a known term give no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    items = items.select("item_id", F.col("text").cast("binary").alias("text")).where("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    id_type = items.schema["item_id"].dataType
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", id_type)])
    found = None
    for i in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i)
        # About block_bytes; in one order, so that a rerun numbers the items alike.
        rows = sorted(((r.item_id, bytes(r.text)) for r in rows.collect()), key=lambda r: (str(r[0]), r[1]))
        best = _block_search(docs, [(n, raw) for n, (_, raw) in enumerate(rows)], top)
        if best is None:
            continue
        best_first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = best.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(n, item_id) for n, (item_id, _) in enumerate(rows)], schema)
        best = best.join(names, "item").select("item_id", "rank", "doc_id", "score")
        found = best if found is None else found.unionByName(best)
    if found is None:
        fields = [T.StructField("item_id", id_type), T.StructField("rank", T.IntegerType())]
        fields += [T.StructField(c, T.LongType()) for c in ("doc_id", "score")]
        return spark.createDataFrame([], T.StructType(fields))
    return found
