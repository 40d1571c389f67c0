"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics are computed in numpy over all bytes of an Arrow batch at once. The trees are
fitted on a bounded sample of labelled documents (MAX_FIT_ROWS, chosen by a hash of the id)
and flattened into arrays; every document is scored by walking all trees for a whole
batch in step. No text is shuffled.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.words import row_slices

MAX_FIT_ROWS = 20_000
HASH_STEPS = 1_000_000
REJECT_BELOW = 0.3
FOLDS = 5

FEATURES = (
    "log_bytes", "upper", "lower", "digit", "high", "mark", "newline", "space",
    "log_words", "word_mean", "word_sd", "long_words", "short_words", "mark_ends", "double_mark_ends",
    "mark_words", "upper_words", "repeats_before", "repeats_two_before", "distinct", "top_word",
    "line_mean", "comma", "stop", "distinct_bytes", "worst_mark_ends", "worst_mark_words", "worst_repeats",
    "worst_upper",
)
WINDOW = 64  # words; the worst_* statistics are of the worst window of a text

_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = 5  # other visible ASCII
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("a") : ord("z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[128:] = 4
_KIND[[9, 11, 12, 13, 32]] = 6
_KIND[10] = 7
_POWERS = np.cumprod(np.full(4096, 1099511628211, np.uint64))


def _per(values, starts, ends):
    """Sums of values[starts:ends], by running sums."""
    running = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=running[1:])
    return running[ends] - running[starts]


def statistics(texts: list[str | None]) -> np.ndarray:
    """The statistics of each text; a null or empty text has zeros."""
    raw = [(t or "").encode() for t in texts]
    n = len(raw)
    size = np.array([len(r) for r in raw], np.int64)
    # A space closes every text, so that no word runs into the next one.
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    first = np.cumsum(size + 1) - size - 1
    last = first + size
    kind = _KIND[data]
    out = {name: np.zeros(n) for name in FEATURES}
    whole = np.maximum(size, 1)
    counts = [_per(kind == k, first, last) for k in range(8)]
    for name, k in (("upper", 1), ("lower", 2), ("digit", 3), ("high", 4), ("mark", 5), ("space", 6), ("newline", 7)):
        out[name] = counts[k] / whole
    out["log_bytes"] = np.log1p(size)
    out["line_mean"] = np.log1p(size / (counts[7] + 1))
    out["comma"] = _per(data == ord(","), first, last) / whole
    out["stop"] = _per((data == ord(".")) | (data == ord("!")) | (data == ord("?")), first, last) / whole

    seen = np.zeros((n, 256), bool)
    own = np.ones(len(data), bool)
    own[last] = False  # the spaces between texts
    seen[np.repeat(np.arange(n), size), data[own]] = True
    out["distinct_bytes"] = seen.sum(1).astype(float)

    letter = kind < 6
    begin = np.flatnonzero(letter & ~np.concatenate(([False], letter[:-1])))
    if not len(begin):
        return np.stack([out[name] for name in FEATURES], 1)
    end = np.flatnonzero(letter & ~np.concatenate((letter[1:], [False]))) + 1
    length = end - begin
    doc = np.searchsorted(first, begin, "right") - 1
    # A word's hash: its bytes times powers by place, summed; places wrap in very long words.
    place = np.arange(len(data), dtype=np.int64)
    shift = np.zeros(len(data), np.int64)
    shift[begin] = np.diff(begin, prepend=0)
    place -= np.cumsum(shift)
    with np.errstate(over="ignore"):
        mixed = (data.astype(np.uint64) + np.uint64(1)) * _POWERS[place % len(_POWERS)] * letter
        code = np.add.reduceat(mixed, begin) ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    per_word = np.bincount(doc, minlength=n)
    words = np.maximum(per_word, 1)

    def share(flags):
        return np.bincount(doc, flags, n) / words

    mean = np.bincount(doc, length, n) / words
    out["log_words"], out["word_mean"] = np.log1p(per_word), mean
    out["word_sd"] = np.sqrt(np.maximum(np.bincount(doc, length.astype(float) ** 2, n) / words - mean**2, 0))
    out["long_words"], out["short_words"] = share(length > 14), share(length <= 3)
    mark_end = kind[end - 1] == 5
    double = mark_end & (length > 1) & (kind[np.maximum(end - 2, 0)] == 5)
    marks = _per(kind == 5, begin, end) == length
    uppers = _per(kind == 1, begin, end) * 2 > length
    before = np.zeros(len(code), bool)
    before[1:] = (code[1:] == code[:-1]) & (doc[1:] == doc[:-1])
    second = np.zeros(len(code), bool)
    second[2:] = (code[2:] == code[:-2]) & (doc[2:] == doc[:-2])
    for name, flags in (
        ("mark_ends", mark_end), ("double_mark_ends", double), ("mark_words", marks),
        ("upper_words", uppers), ("repeats_before", before), ("repeats_two_before", second),
    ):
        out[name] = share(flags)
    order = np.argsort(code, kind="stable")
    new = np.concatenate(([True], code[order][1:] != code[order][:-1]))
    times = np.diff(np.append(np.flatnonzero(new), len(code)))
    owner = doc[order][new]
    out["distinct"] = np.bincount(owner, minlength=n) / words
    top = np.zeros(n)
    np.maximum.at(top, owner, times)
    out["top_word"] = top / words
    # Runs of WINDOW words within a text; a text's last window may be shorter.
    number = np.arange(len(doc)) - np.repeat(np.cumsum(per_word) - per_word, per_word)
    window = np.flatnonzero(number % WINDOW == 0)
    held = np.diff(np.append(window, len(doc)))
    for name, flags in (
        ("worst_mark_ends", double), ("worst_mark_words", marks),
        ("worst_repeats", before | second), ("worst_upper", uppers),
    ):
        worst = np.zeros(n)
        np.maximum.at(worst, doc[window], np.add.reduceat(flags.astype(float), window) / np.maximum(held, 16))
        out[name] = worst
    return np.stack([out[name] for name in FEATURES], 1)


@dataclass
class Trees:
    """Trees as arrays: node i of tree t tests feature[t, i] <= cut[t, i], children 2i+1, 2i+2."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-total))


def fit_trees(
    x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15,
    bins: int = 64, ridge: float = 1.0, least: int = 8,
) -> Trees:
    """Second-order boosting on the logistic loss, splits from histograms of binned values."""
    n, width = x.shape
    inner = 2**depth - 1
    mean = float(np.clip(y.mean(), 1e-4, 1 - 1e-4)) if n else 0.5
    base = float(np.log(mean / (1 - mean)))
    if not n:
        return Trees(base, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)), depth)
    edges = np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], axis=0).T  # width x (bins - 1)
    binned = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(width)], 1)
    offset = np.arange(width) * bins
    raw = np.full(n, base)
    features, cuts, leaves = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            nodes = 2**level
            at = node - (nodes - 1)
            cell = (at[:, None] * width * bins + offset + binned).ravel()
            cells = nodes * width * bins
            sums = [
                np.bincount(cell, None if v is None else np.repeat(v, width), cells).reshape(nodes, width, bins)
                for v in (g, h, None)
            ]
            left = [np.cumsum(s, 2)[:, :, :-1] for s in sums]
            right = [s.sum(2, keepdims=True) - a for s, a in zip(sums, left)]
            gain = sum(a[0] ** 2 / (a[1] + ridge) for a in (left, right))
            gain -= (sums[0].sum(2) ** 2 / (sums[1].sum(2) + ridge))[:, :, None]
            gain[(left[2] < least) | (right[2] < least)] = -1
            best = gain.reshape(nodes, -1).argmax(1)
            f, b = np.divmod(best, bins - 1)
            use = gain[np.arange(nodes), f, b] > 1e-6
            spot = np.arange(nodes) + nodes - 1
            feature[spot] = np.where(use, f, 0)
            cut[spot] = np.where(use, edges[f, b], np.inf)
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
        at = node - inner
        leaf = -np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + ridge) * rate
        raw += leaf[at]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    return Trees(base, np.array(features), np.array(cuts), np.array(leaves), depth)


def _fold(column):
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % FOLDS


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> Trees:
    """Trees from labelled documents outside the held-out fold.

    `max_rows` labels at most, those with the least hashes of the id, so the sample and what
    reaches the driver are bounded whatever the tables hold, and are the same for any
    partitions. Labels other than 0 and 1 are left out; a document labelled twice counts twice.
    """
    known = labels.select(F.col("doc_id").alias("label_id"), F.col("quality").alias("y")).where(
        F.col("y").isin(0, 1) & F.col("label_id").isNotNull() & (_fold(F.col("label_id")) != 0)
    )
    share = min(1.0, 1.2 * max_rows / max(known.count(), 1))
    known = known.withColumn("place", F.xxhash64("label_id"))
    # The filter only spares the sort most rows; ids and labels of max_rows rows are broadcast.
    near = known.where(F.pmod("place", F.lit(HASH_STEPS)) <= int(share * HASH_STEPS))
    step = F.pmod("place", F.lit(HASH_STEPS))
    sample = near.orderBy(step, "place", "label_id", "y").limit(max_rows)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, 1):
                x = statistics(part.column(1).to_pylist())
                columns = [part.column(0), pa.array(list(x), pa.list_(pa.float64())), part.column(2)]
                yield pa.RecordBatch.from_arrays(columns, ["y", "x", "place"])

    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
        .select(F.col("y").cast("double"), "text", "place")
        .mapInArrow(measure, "y double, x array<double>, place long")
        .orderBy("place", "y", "x")
        .limit(2 * max_rows)
        .toArrow()
    )
    y = rows.column("y").to_numpy()
    x = np.array(rows.column("x").to_pylist(), float).reshape(len(y), len(FEATURES))
    order = np.lexsort((y, *x.T[::-1]))  # the same trees whatever order the rows came in
    return fit_trees(x[order], y[order])


def score_quality(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id and score (0 to 1) of every row; a null text scores as an empty one.

    Repeated rows and null ids are scored like any; other columns are ignored; an empty table
    gives an empty result. Scores depend on the text alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)  # as large as the trees, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, 1):
                score = shared.value.score(statistics(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score)], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, score double")


def quality_report(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    scored = score_quality(docs, fit_quality(docs, labels, **options))
    return scored.select(
        "doc_id",
        (_fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= REJECT_BELOW).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents with a score of REJECT_BELOW or more, with their columns, whatever their names.

    A null text is judged as an empty one, repeated rows and null ids alike; an empty table
    gives an empty one.
    """
    trees = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, **options))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, place):
                score = trees.value.score(statistics(part.column(place).to_pylist()))
                yield part.filter(pa.array(score >= REJECT_BELOW))

    return docs.mapInArrow(run, docs.schema)
