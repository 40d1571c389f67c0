"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

A bounded sample of labelled documents (MAX_FIT_ROWS) gives a lexicon: words that toxic
documents hold more often, with their log odds. Each text becomes a few dense numbers: how dense
lexicon words are, how near they stand to words for the second person, capitals, punctuation
and disguised spellings. Boosted trees on these score the text, and an isotonic step turns
scores into shares of toxic documents.

Documents of the sample get features from a lexicon of the other folds and, for the
calibration, scores from trees of the other folds, so neither sees its own label.
No text is shuffled but those of the sample.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.quality import Trees, fit_trees
from retailflow.llm.shared import shared_table
from retailflow.llm.terms import LETTERS, term_lists
from retailflow.llm.words import row_slices

MAX_FIT_ROWS = 20_000
HELD_OUT, FOLDS = 1, 3  # crc32 of the id by FOLDS; this remainder is never learnt from
TOXIC_FROM = 0.7
PARTS = 4  # folds of the sample
MAX_WORDS = 5_000  # of the lexicon
LEAST_DOCS = 3  # toxic documents that hold a word of the lexicon, at least
SURE = 2.0  # standard errors by which its log odds exceed 0, at least
STRONG = 2.0  # log odds from which a word counts as strong
NEAR = 3  # words between a lexicon word and one for the second person, at most
WINDOW = 64  # words

# Words for the second person in the languages of the corpus.
SECOND_PERSON = frozenset(
    w.encode()
    for w in (
        "you your yours yourself u ur tu te ti toi ton ta tes vous votre vos "
        "tú tus usted ustedes vosotros du dich dir dein deine deinen ihr euch euer"
    ).split()
)
# Signs that stand for letters in disguised words.
_PLAIN = bytes.maketrans(b"013457@$!|", b"oieastasil")
# Kinds of bytes: a letter, 1 a digit or sign that may disguise one, a space for the others.
_KINDS = bytes(97 if b >= 128 or chr(b).isalpha() else 49 if chr(b) in "0123456789@$!|*_.-#+" else 32 for b in range(256))
_CASES = bytes(65 if 65 <= b <= 90 else 97 if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_DISGUISED = re.compile(rb"a1{1,3}a|(?<![a1])1a")
_SPACED = re.compile(rb"(?<![a1])(?:a ){3,}a(?![a1])")
_CAPS = re.compile(rb"(?<!a)(?<!A)A{3,}(?![Aa])")
_DOUBLED = re.compile(rb"(.)\1+")
_DROP = bytes(b for b in range(128) if not chr(b).isalpha())
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])

FEATURES = (
    "log_words", "hits", "hit_share", "hit_log_odds", "strong", "strong_share", "strong_kinds", "odds_sum", "odds_top",
    "worst_window", "second_share", "near_second", "near_share", "upper_share", "caps_share", "exclaims", "questions",
    "shouts", "stars", "disguised_share", "disguised_hits", "stretched_share", "stretched_hits", "spaced", "spaced_hits",
)


def _squeezed(word: bytes) -> bytes:
    return _DOUBLED.sub(rb"\1", word)


@dataclass
class Lexicon:
    """Words with their log odds; strong ones without doubled letters, too; all words to look for."""

    odds: dict[bytes, float]
    squeezed: frozenset[bytes]
    marks: frozenset[bytes]

    @staticmethod
    def of(odds: dict[bytes, float]) -> "Lexicon":
        strong = frozenset(_squeezed(w) for w, v in odds.items() if v >= STRONG)
        return Lexicon(odds, strong, SECOND_PERSON | odds.keys())

    def disguised(self, word: bytes) -> bool:
        low = word.lower()
        spellings = low.translate(None, _DROP), low.translate(_PLAIN).translate(None, _DROP)
        return any(w in self.odds or _squeezed(w) in self.squeezed for w in spellings)


def _around(found: Iterator[re.Match], kinds: bytes, raw: bytes) -> list[bytes]:
    """The stretches without a space in `kinds` that hold the matches."""
    out, end = [], -1
    for m in found:
        if m.end() <= end:
            continue
        start = kinds.rfind(b" ", 0, m.start()) + 1
        end = kinds.find(b" ", m.end())
        end = len(raw) if end < 0 else end
        out.append(raw[start:end])
    return out


def _stretched(raw: bytes, kinds: bytes) -> list[bytes]:
    """Words that hold an ASCII letter three times in a row."""
    data = np.frombuffer(raw, np.uint8)
    thrice = (data[2:] == data[1:-1]) & (data[2:] == data[:-2])
    if not thrice.any():
        return []
    out, end = [], -1
    for i in (np.flatnonzero(thrice & _LETTER[data[2:]])).tolist():
        if i >= end:
            start = max(kinds.rfind(b" ", 0, i), kinds.rfind(b"1", 0, i)) + 1
            end = i + 3
            while end < len(raw) and kinds[end] == 97:
                end += 1
            out.append(raw[start:end])
    return out


def features(raw: bytes | None, lexicon: Lexicon) -> list[float]:
    """Of one whole text; a null or empty one has zeros."""
    out = dict.fromkeys(FEATURES, 0.0)
    if not raw:
        return list(out.values())
    words = hits = strong = seconds = near = 0
    odds, kinds_seen, last_second, last_hit = [], set(), -NEAR - 1, -NEAR - 1
    window: Counter = Counter()
    marks, get = lexicon.marks, lexicon.odds.get
    for terms in term_lists(raw, LETTERS):
        for i, t in [(i, t) for i, t in enumerate(terms, words) if t in marks]:
            second, value = t in SECOND_PERSON, get(t)
            if second:
                seconds += 1
                near += i - last_hit <= NEAR
                last_second = i
            if value is not None:
                hits += 1
                odds.append(value)
                near += not second and i - last_second <= NEAR
                last_hit = i
                if value >= STRONG:
                    strong += 1
                    kinds_seen.add(t)
                    window[i // WINDOW] += 1
        words += len(terms)
    whole, all_words = len(raw), max(words, 1)
    kinds = raw.translate(_KINDS)
    disguised = _around(_DISGUISED.finditer(kinds), kinds, raw)
    stretched = _stretched(raw, kinds)
    spaced = [raw[m.start() : m.end()] for m in _SPACED.finditer(kinds)] if b"a a a a" in kinds else []
    cases = raw.translate(_CASES)

    out["log_words"] = np.log1p(words)
    out["hits"], out["hit_share"] = np.log1p(hits), hits / all_words
    out["hit_log_odds"] = sum(odds) / max(hits, 1)
    out["strong"], out["strong_share"], out["strong_kinds"] = np.log1p(strong), strong / all_words, len(kinds_seen)
    out["odds_sum"], out["odds_top"] = sum(odds), max(odds, default=0.0)
    out["worst_window"] = max(window.values(), default=0)
    out["second_share"], out["near_second"], out["near_share"] = seconds / all_words, np.log1p(near), near / all_words
    out["upper_share"] = (whole - len(raw.translate(None, _UPPER))) / whole
    out["caps_share"] = len(_CAPS.findall(cases)) / all_words if b"AAA" in cases else 0.0
    out["exclaims"], out["questions"] = raw.count(b"!") / all_words, raw.count(b"?") / all_words
    out["shouts"] = sum(raw.count(two) for two in (b"!!", b"??", b"!?", b"?!")) / all_words
    out["stars"] = raw.count(b"*") / all_words
    out["disguised_share"], out["disguised_hits"] = len(disguised) / all_words, sum(map(lexicon.disguised, disguised))
    out["stretched_share"] = len(stretched) / all_words
    out["stretched_hits"] = sum(_squeezed(w.lower()) in lexicon.squeezed for w in stretched)
    out["spaced"], out["spaced_hits"] = len(spaced), sum(map(lexicon.disguised, spaced))
    return [float(v) for v in out.values()]


def lexicon_of(words: list[bytes], toxic: np.ndarray, clean: np.ndarray, all_toxic: int, all_clean: int) -> dict[bytes, float]:
    """Words with log odds of standing in a toxic document rather than a clean one, where those are sure."""
    odds = np.log((toxic + 0.5) / (all_toxic + 1)) - np.log((clean + 0.5) / (all_clean + 1))
    error = np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    use = np.flatnonzero((toxic >= LEAST_DOCS) & (odds >= SURE * error))
    use = use[np.lexsort((use, -(odds / error)[use]))][:MAX_WORDS]
    return {words[i]: float(odds[i]) for i in sorted(use)}


@dataclass
class Steps:
    """A rising function: value at each place, straight lines between."""

    place: np.ndarray
    value: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.interp(x, self.place, self.value) if len(self.place) else x


def isotonic(x: np.ndarray, y: np.ndarray) -> Steps:
    """Pool adjacent violators: the rising step function nearest to y, each step at the mean of its places."""
    if not len(x):
        return Steps(np.zeros(0), np.zeros(0))
    blocks: list[list[float]] = []  # sums of x and y, rows
    for a, b in sorted(zip(x.tolist(), y.tolist())):
        blocks.append([a, b, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    # A part of a row of each class keeps steps off 0 and 1; the order of steps stays.
    value = np.array([(b[1] + 0.05) / (b[2] + 0.1) for b in blocks])
    return Steps(np.array([b[0] / b[2] for b in blocks]), np.maximum.accumulate(value))


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees
    calibrate: Steps

    def score(self, raws: list[bytes | None]) -> np.ndarray:
        x = np.array([features(r, self.lexicon) for r in raws]).reshape(len(raws), len(FEATURES))
        return self.calibrate(self.trees.score(x))


def _fold(column, folds: int):
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds


def _trees(x, y):
    return fit_trees(x, y, rounds=60, depth=3, rate=0.15)


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> Model:
    """Lexicon, trees and calibration from labelled documents outside the held-out fold.

    `max_rows` labels at most, those with the least hashes of the id, whatever the tables hold and
    however they are dealt. Labels other than 0 and 1 are left out. Without any
    label every document scores 0.5.
    """
    known = labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").alias("y")).where(
        F.col("y").isin(0, 1) & F.col("label_id").isNotNull() & (_fold(F.col("label_id"), FOLDS) != HELD_OUT)
    )
    place = F.xxhash64("label_id")
    # max_rows ids and labels, so broadcasting them is bounded.
    known = known.distinct().withColumn("place", place).orderBy("place", "label_id", "y").limit(max_rows)
    sample = (
        docs.select("doc_id", F.col("text").cast("binary").alias("text"))
        .join(F.broadcast(known), F.col("doc_id") == F.col("label_id"))
        .select("place", F.col("y").cast("int").alias("y"), F.pmod("place", F.lit(PARTS)).cast("int").alias("part"), "text")
    )
    sample = shared_table(sample, "toxicity_sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for part, y, raw in zip(*(batch.column(c).to_pylist() for c in ("part", "y", "text"))):
                words = {t for terms in term_lists(raw, LETTERS) for t in terms}
                held.update((w, 2 * part + y) for w in words)
                held[b"", 2 * part + y] += 1  # documents
        words = [w for w, _ in held]
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), pa.array([k for _, k in held], pa.int64()), pa.array(list(held.values()), pa.int64())],
            ["word", "kind", "n"],
        )

    kinds = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"k{k}") for k in range(2 * PARTS)]
    counts = sample.mapInArrow(count, "word binary, kind long, n long").groupBy("word").agg(*kinds)
    toxic = sum((F.col(f"k{2 * p + 1}") for p in range(1, PARTS)), F.col("k1"))
    clean = sum((F.col(f"k{2 * p}") for p in range(1, PARTS)), F.col("k0"))
    counts = counts.withColumns({"toxic": toxic, "clean": clean})
    # Of the words that toxic documents hold often enough those with the highest ratio: a bounded number.
    often = counts.where((F.col("word") == b"") | (F.col("toxic") >= LEAST_DOCS))
    ratio = (F.col("toxic") + 0.5) / (F.col("clean") + 0.5)
    rows = often.orderBy(F.desc(F.col("word") == b""), F.desc(ratio), F.desc("toxic"), "word").limit(4 * MAX_WORDS + 1).collect()
    total = np.array(rows[0][1 : 1 + 2 * PARTS], np.int64).reshape(PARTS, 2) if rows and rows[0].word == b"" else np.zeros((PARTS, 2), int)
    words = [bytes(r.word) for r in rows if r.word != b""]
    table = np.array([r[1 : 1 + 2 * PARTS] for r in rows if r.word != b""], np.int64).reshape(-1, PARTS, 2)

    def lexicon(parts):
        of, every = table[:, parts].sum(1), total[parts].sum(0)
        return Lexicon.of(lexicon_of(words, of[:, 1], of[:, 0], int(every[1]), int(every[0])))

    others = [[q for q in range(PARTS) if q != p] for p in range(PARTS)]
    shared = docs.sparkSession.sparkContext.broadcast([lexicon(o) for o in others])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(raw, shared.value[p]) for p, raw in zip(batch.column("part").to_pylist(), batch.column("text").to_pylist())]
            columns = [batch.column("place"), batch.column("y"), batch.column("part"), pa.array(x, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["place", "y", "part", "x"])

    got = sample.mapInArrow(measure, "place long, y int, part int, x array<double>").orderBy("place", "y", "x").limit(2 * max_rows).toArrow()
    y, part = (got.column(c).to_numpy().astype(int) for c in ("y", "part"))
    x = np.array(got.column("x").to_pylist(), float).reshape(len(y), len(FEATURES))
    unseen = np.zeros(len(y))
    for p in range(PARTS):
        unseen[part == p] = _trees(x[part != p], y[part != p]).score(x[part == p])
    return Model(lexicon(list(range(PARTS))), _trees(x, y), isotonic(unseen, y))


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row; a null text scores as an empty one.

    Repeated rows and null ids are scored like any; other columns are ignored; an empty table
    gives an empty result. Scores depend on the text alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_WORDS and the number of trees

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, 1):
                score = shared.value.score(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score)], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    scored = score_toxicity(docs, fit_toxicity(docs, labels, **options))
    return scored.select(
        "doc_id",
        (_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )
