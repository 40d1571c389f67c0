"""Near-duplicate documents by Order MinHash.

A sketch samples the PICKS least of a document's shingles (five words, labelled with how often
each came before) and keeps them in the order of the text, so it reacts to moved passages as
an edit distance does. Documents that share a sketch are candidates, and a pair is verified by
an alignment. First each document is held against two of its bucket, chosen by a hash for each
table anew, which joins most groups. What is still apart in a bucket is then paired whole: buckets of
up to BLOCK documents by a join, larger ones in cells of CELL x CELL documents, where counts of
shingles in BINS rule out pairs that cannot reach the threshold. That loses no pair, and a bucket
of n documents of different classes takes n * n / 2 comparisons of counts.

Similarity: shingles that a banded alignment matches in order, over all shingles of both
(matched ones once). Without moved passages this is the Jaccard similarity of the shingles.
Copies of one word sequence are one node of the graph: they never make pairs.
"""

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailflow.llm.components import components
from retailflow.llm.shared import numbered, one_of_each, shared_table
from retailflow.llm.words import mixed, occurrences, row_slices, shingle_codes

THRESHOLD = 0.8
PICKS = 3
BLOCK = 24  # documents of a bucket that are paired by a join; larger ones in cells
CELL = 512  # documents of a large bucket that meet as many others in one task
BINS = 2048  # of a profile, a power of two
TABLES = 14  # of two texts with similarity 0.8, one in 20,000 shares no sketch

_rng = np.random.default_rng(8)


def _normal(text: str | None) -> bytes:
    return b" ".join((text or "").encode().lower().split())


def sketches(raw: list[bytes], tables: int = TABLES, picks: int = PICKS) -> tuple[np.ndarray, np.ndarray]:
    """Shingle counts, and a texts x tables array of sketch keys (0 for texts without words)."""
    doc, code = shingle_codes(raw)
    n = len(raw)
    counts = np.bincount(doc, minlength=n)
    out = np.zeros((n, tables), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return counts, out
    with np.errstate(over="ignore"):
        label = mixed(code + occurrences(doc, code).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        sizes = counts[full]
        start = np.cumsum(sizes) - sizes
        row = np.repeat(np.arange(len(full)), sizes)
        factors = np.random.default_rng(88).integers(0, 2**64, (tables, 2), np.uint64)
        top = np.uint64(2**64 - 1)
        for t in range(tables):
            h = (label ^ factors[t, 0]) * (factors[t, 1] | np.uint64(1))
            h ^= h >> np.uint64(29)
            at = np.full((picks, len(full)), np.iinfo(np.int64).max)
            for p in range(picks):
                least = np.minimum.reduceat(h, start)
                hit = np.flatnonzero(h == least[row])
                at[p, row[hit[::-1]]] = hit[::-1]  # of equal values the first
                h[at[p]] = top
            at = np.sort(at, 0)
            key = np.full(len(full), np.uint64(t + 1))
            for p in range(picks):
                # A text with fewer shingles picks its last again; that is the same for its copies.
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + label[np.minimum(at[p], start + sizes - 1)])
            out[full, t] = key
    return counts, out


def matched_in_order(a: np.ndarray, b: np.ndarray, least: int) -> int:
    """Length of an alignment, `least` or more if the longest common subsequence is.

    Shingles are first matched one to one by value and count; their longest ascending run is the
    answer if it is long enough (the longest of all where no shingle repeats). Otherwise rows of
    a band are filled: outside it too much would be left unmatched.
    """
    start = 0
    stop = min(len(a), len(b))
    same = np.flatnonzero(a[:stop] != b[:stop])
    start = int(same[0]) if len(same) else stop
    a, b = a[start:], b[start:]
    stop = min(len(a), len(b))
    same = np.flatnonzero(a[::-1][:stop] != b[::-1][:stop])
    tail = int(same[0]) if len(same) else stop
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    fixed = start + tail
    if not len(a) or not len(b):
        return fixed
    zeros = [np.zeros(len(x), np.int64) for x in (a, b)]
    with np.errstate(over="ignore"):
        la, lb = (x + occurrences(z, x).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for x, z in zip((a, b), zeros))
    _, ia, ib = np.intersect1d(la, lb, assume_unique=True, return_indices=True)
    if fixed + len(ia) < least:
        return fixed + len(ia)
    places = ib[np.argsort(ia)]
    if (np.diff(places) > 0).all():
        return fixed + len(ia)
    tops: list[int] = []  # least end of an ascending run of each length
    for x in places.tolist():
        k = bisect_left(tops, x)
        tops[k : k + 1] = [x]
    if fixed + len(tops) >= least:
        return fixed + len(tops)
    return fixed + _banded(a, b, len(a) + len(b) - 2 * (least - fixed))


def _banded(a: np.ndarray, b: np.ndarray, unmatched: int) -> int:
    """Longest common subsequence if at most `unmatched` elements are left over, in a band."""
    before = np.zeros(len(b) + 1, np.int64)
    for i in range(len(a)):
        low, high = max(0, i - unmatched), min(len(b), i + unmatched + 1)
        if low >= high:
            continue
        row = before.copy()
        here = np.maximum(before[low + 1 : high + 1], before[low:high] + (b[low:high] == a[i]))
        row[low + 1 : high + 1] = np.maximum.accumulate(np.maximum(here, row[low]))
        before = row
        before[high + 1 :] = before[high]
    return int(before[-1])


def similarity(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Of two shingle sequences; at the threshold or above just if their best alignment is."""
    total = len(a) + len(b)
    if not total:
        return 1.0
    least = int(np.ceil(threshold * total / (1 + threshold) - 1e-9))
    if min(len(a), len(b)) < least:
        return 0.0
    m = matched_in_order(a, b, least)
    return m / (total - m)


def _sequences(texts: list[str | None]) -> list[np.ndarray]:
    doc, code = shingle_codes([_normal(t) for t in texts])
    return np.split(code, np.cumsum(np.bincount(doc, minlength=len(texts)))[:-1])


def sketch_table(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the word sequence, n shingles, keys (one per table)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, 1):
                raw = [_normal(t) for t in part.column(1).to_pylist()]
                counts, keys = sketches(raw)
                flat = pa.array(keys.view(np.int64).ravel())
                ends = pa.array(np.arange(len(raw) + 1, dtype=np.int32) * keys.shape[1])
                digests = pa.array([hashlib.blake2b(r, digest_size=16).digest() for r in raw], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), digests, pa.array(counts), pa.ListArray.from_arrays(ends, flat)],
                    ["doc_id", "digest", "n", "keys"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, digest binary, n long, keys array<long>")


def _buckets(nodes: DataFrame) -> DataFrame:
    """at, key, doc_id, n and every column of `nodes` but its keys, a row per table."""
    rest = [c for c in nodes.columns if c != "keys"]
    return nodes.where("n > 0").select(*rest, F.posexplode("keys").alias("at", "key"))


def _ordered(a, b):
    return F.greatest(a, b).alias("a"), F.least(a, b).alias("b")


def _may_reach(a, b, threshold: float):
    """Whether the numbers of shingles leave room for the similarity."""
    return F.least(a, b) >= threshold * F.greatest(a, b)


def candidates(nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs (a, b): each document with the first and the last of each of its buckets, by a hash
    that differs from table to table."""
    place = F.struct(F.xxhash64("at", "doc_id").alias("h"), "doc_id", "n")
    keyed = _buckets(nodes).withColumn("place", place)
    ends = keyed.groupBy("at", "key").agg(F.count("*").alias("size"), F.min("place").alias("low"), F.max("place").alias("high"))
    ends = ends.where("size > 1").select("at", "key", F.array("low", "high").alias("ends"))
    pairs = keyed.join(ends, ["at", "key"]).select("doc_id", "n", F.explode("ends").alias("end"))
    return (
        pairs.where((F.col("doc_id") != F.col("end.doc_id")) & _may_reach("n", "end.n", threshold))
        .select(*_ordered("doc_id", "end.doc_id"))
        .distinct()
    )


def profiles(raw: list[bytes]) -> np.ndarray:
    """How many shingles of each text fall into each of BINS, 255 at most: no more shingles of
    two texts can be equal than their profiles leave room for."""
    doc, code = shingle_codes(raw)
    places = doc * BINS + (code >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    return np.minimum(np.bincount(places, minlength=len(raw) * BINS), 255).astype(np.uint8).reshape(-1, BINS)


def profile_table(docs: DataFrame) -> DataFrame:
    """doc_id, profile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, 1):
                for start in range(0, part.num_rows, 256):
                    some = part.slice(start, 256)
                    found = profiles([_normal(t) for t in some.column(1).to_pylist()])
                    yield pa.RecordBatch.from_arrays(
                        [some.column(0), pa.array([x.tobytes() for x in found], pa.binary())], ["doc_id", "profile"]
                    )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, profile binary")


def _leftover(profile: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Shingles that are surely not matched, of a text and each of others, from their profiles."""
    return (np.maximum(others, profile) - np.minimum(others, profile)).sum(1, dtype=np.int64)


def close_pairs(at, own, n, part, keys, profile, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs of one cell of table `at` (0 first) that may reach the threshold.

    Rows with `own` are held against those without, or against each other if all have it. Pairs
    of one part, and those that share a key of an earlier table, are left to others.
    """
    coarse = np.minimum(profile.reshape(len(n), -1, 4).sum(2, dtype=np.int64), 255).astype(np.uint8)
    left = np.flatnonzero(own)
    within = len(left) == len(n)
    right = left if within else np.flatnonzero(~own)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for place, i in enumerate(left.tolist()):
        j = right[place + 1 :] if within else right
        j = j[part[j] != part[i]]
        total = n[j] + n[i]
        most = total - 2 * np.ceil(threshold * total / (1 + threshold) - 1e-9)
        fits = np.abs(n[j] - n[i]) <= most
        j, most = j[fits], most[fits]
        if at:
            fits = ~(keys[j, :at] == keys[i, :at]).any(1)
            j, most = j[fits], most[fits]
        for kind in (coarse, profile):
            fits = _leftover(kind[i], kind[j]) <= most
            j, most = j[fits], most[fits]
        out.append((np.full(len(j), i), j))
    none = [(np.zeros(0, np.int64),) * 2]
    i, j = (np.concatenate(x) for x in zip(*(out or none)))
    return i, j


def _dealt(rows: DataFrame) -> DataFrame:
    """rows with their cell of the bucket and the cells to meet there, `others`.

    Parts of more than CELL / 2 documents have cells of their own, which never meet one another, so
    a large part that shares a bucket with few others moves once for each cell of the others.
    """
    bucket = ["at", "key"]
    parts = rows.groupBy(*bucket, "part").agg(F.count("*").alias("members"))
    large = parts.where(F.col("members") > CELL // 2).withColumn("own", F.ceil(F.col("members") / CELL))
    before = Window.partitionBy(*bucket).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    large = large.withColumn("before", F.coalesce(F.sum("own").over(before), F.lit(0))).drop("members")
    several = F.when(F.col("members") <= CELL // 2, F.col("members"))
    own = F.when(F.col("members") > CELL // 2, F.ceil(F.col("members") / CELL))
    cells = parts.groupBy(*bucket).agg(
        F.ceil(F.coalesce(F.sum(several), F.lit(0)) / CELL).alias("shared"), F.coalesce(F.sum(own), F.lit(0)).alias("owned")
    )
    rows = rows.join(cells, bucket).join(large, [*bucket, "part"], "left")
    first = F.col("shared") + F.col("before")
    spread = F.xxhash64("doc_id")
    cell = F.when(F.col("own").isNull(), F.pmod(spread, "shared")).otherwise(first + F.pmod(spread, "own"))
    everything = F.sequence(F.lit(0).cast("long"), F.col("shared") + F.col("owned") - 1)
    foreign = F.filter(everything, lambda c: F.col("own").isNull() | (c < first) | (c >= first + F.col("own")))
    return rows.withColumn("cell", cell).withColumn("others", foreign)


def _cell_pairs(rows: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """Pairs (doc_id, other_doc_id) of large buckets: all of CELL x CELL documents at a time.

    Cells of one large part alone are never made."""
    ids = rows.select(F.col("doc_id").alias("id")).distinct()
    texts = docs.select("doc_id", "text").dropDuplicates(["doc_id"])
    texts = texts.join(ids.hint("merge"), F.col("doc_id") == F.col("id"), "left_semi")
    known = shared_table(profile_table(texts), "omh_profiles").withColumnRenamed("doc_id", "id")
    rows = _dealt(rows).join(known.hint("merge"), F.col("doc_id") == F.col("id")).select(
        "at", "key", "doc_id", "n", "part", "keys", "profile", "cell", F.explode("others").alias("other")
    )
    rows = rows.withColumn("low", F.least("cell", "other")).withColumn("high", F.greatest("cell", "other"))

    def run(table: pa.Table) -> pa.Table:
        column = lambda name: table.column(name).to_numpy()
        ids, n, at = column("doc_id"), column("n"), int(table.column("at")[0].as_py())
        keys = np.array(table.column("keys").to_pylist(), np.int64).reshape(len(ids), -1)
        profile = np.frombuffer(b"".join(table.column("profile").to_pylist()), np.uint8).reshape(len(ids), BINS)
        i, j = close_pairs(at, column("cell") == column("low"), n, column("part"), keys, profile, threshold)
        return pa.table({"doc_id": pa.array(ids[i]), "other_doc_id": pa.array(ids[j])})

    return rows.groupBy("at", "key", "low", "high").applyInArrow(run, "doc_id long, other_doc_id long")


def still_apart(nodes: DataFrame, docs: DataFrame, roots: DataFrame, seen: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs that share a bucket, whose components differ and whose shingles leave room for the
    threshold, without those of `seen`. Each is made in the first bucket that it shares."""
    part = nodes.join(roots, F.col("doc_id") == F.col("node"), "left")
    part = part.select("doc_id", "n", "keys", F.coalesce("root", "doc_id").alias("part"))
    keyed = _buckets(part)
    mixed_buckets = (
        keyed.groupBy("at", "key")
        .agg(F.count("*").alias("size"), F.min("part").alias("low"), F.max("part").alias("high"))
        .where("low < high")
        .select("at", "key", "size")
    )
    rows = keyed.join(mixed_buckets, ["at", "key"]).join(part.select("doc_id", "keys"), "doc_id")
    rows = shared_table(rows, "omh_apart")
    small = rows.where(F.col("size") <= BLOCK)
    other = small.select("at", "key", *(F.col(c).alias(f"other_{c}") for c in ("doc_id", "n", "part", "keys")))
    first = F.array_intersect("keys", "other_keys")[0] == F.col("key")
    apart = (F.col("doc_id") > F.col("other_doc_id")) & (F.col("part") != F.col("other_part"))
    pairs = small.join(other, ["at", "key"]).where(apart & _may_reach("n", "other_n", threshold) & first)
    pairs = pairs.select("doc_id", "other_doc_id").union(_cell_pairs(rows.where(F.col("size") > BLOCK), docs, threshold))
    return pairs.select(*_ordered("doc_id", "other_doc_id")).join(seen, ["a", "b"], "left_anti")


def verified(pairs: DataFrame, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """pairs: (a, b). Those whose texts reach the threshold, with their similarity."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    # Ids and pairs grow with the corpus, so neither they nor texts are ever broadcast.
    texts = docs.select("doc_id", "text").join(ids.hint("merge"), F.col("doc_id") == F.col("id"), "left_semi")
    texts = shared_table(texts, "omh_texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                left, right = (part.column(i).to_pylist() for i in (2, 3))
                different = dict.fromkeys([*left, *right])
                codes = dict(zip(different, _sequences(list(different))))
                sims = np.array([similarity(codes[x], codes[y], threshold) for x, y in zip(left, right)])
                keep = pa.array(sims >= threshold)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sims)], ["a", "b", "similarity"]).filter(keep)

    first = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")
    both = first.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, similarity double")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: doc_id, copy_of (smallest id with the same words in order),
    class_id (smallest id of its class), kept (whether it is that one).

    Letters A-Z compare without case and white space as one space. Texts without words, null
    ones included, are copies of each other. Rows with a null id have class null and are kept.
    Rows that repeat an id and its words are alike; ids are otherwise taken to be unique. Extra
    columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = shared_table(sketch_table(rows), "omh_sketches")
    named = table.where("doc_id IS NOT NULL")
    # Copies agree in everything but the id, so one row can speak for all.
    nodes = named.groupBy("digest").agg(F.min(F.struct("doc_id", "n", "keys")).alias("first"))
    nodes = shared_table(nodes.select("digest", "first.doc_id", "first.n", "first.keys"), "omh_nodes")
    pairs = shared_table(candidates(nodes, threshold), "omh_candidates")
    links = shared_table(verified(pairs, rows.where("doc_id IS NOT NULL"), threshold).select("a", "b").distinct(), "omh_links")
    more = shared_table(still_apart(nodes, rows.where("doc_id IS NOT NULL"), components(links), pairs, threshold), "omh_more_candidates")
    found = verified(more, rows.where("doc_id IS NOT NULL"), threshold).select("a", "b").distinct()
    roots = components(links.union(shared_table(found, "omh_more_links")))
    classes = nodes.join(roots, F.col("doc_id") == F.col("node"), "left").select(
        F.col("digest").alias("of"), F.col("doc_id").alias("copy_of"), F.coalesce("root", "doc_id").alias("class_id")
    )
    has_id = F.col("doc_id").isNotNull()
    return table.join(classes, F.col("digest") == F.col("of"), "left").select(
        "doc_id",
        F.when(has_id, F.col("copy_of")).alias("copy_of"),
        F.when(has_id, F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class of near copies, with its columns: that with the smallest doc_id.

    Rows are told apart by a number, so ids may repeat or be null; a null id counts as the smallest,
    and of rows with one id any one stays. Texts without words, null ones included, are
    one class. Other columns are kept, whatever their names. No rows give no rows.
    """
    rows, number = numbered(docs, "omh_rows")
    classes = near_duplicates(rows.select(F.col(number).alias("doc_id"), "text"), threshold)
    classes = shared_table(classes.select(F.col("doc_id").alias("row"), F.col("class_id").alias("group")), "omh_classes")
    return one_of_each(rows, number, classes)
