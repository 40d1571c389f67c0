"""Score documents with a causal self-attention model learnt from the training documents.

1. One pass counts the words of all training documents and the subword pairs between
   neighbouring words, and cuts each document into excerpts that hold all of its text.
2. The word counts give the counts of subwords and of subword pairs inside words.
3. Rounds of training, each on its share of all excerpts: every task trains from the same weights
   and the weights are averaged by tokens seen, summed in Spark position by position.
4. One pass scores every token of every document. Frequent words (a bounded table) get their
   count there; rarer ones are joined with the counts as rows.
"""

import base64
import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm import attention
from retailflow.llm.shared import shared_table
from retailflow.llm.words import row_slices

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SUBWORDS = 50_257  # ids of that file and one for the end mark
END_ID = SUBWORDS - 1
END = b""  # the end mark among words, which are never empty
FOLDS, HELD_OUT = 5, 1
EXCERPT_WORDS = 128  # all text is cut into excerpts of so many words, the last of a document shorter
ROUND_RATES = (8e-3, 3e-3)
BATCH = 32  # excerpts of one step
LEAST_STEPS = 100  # of a round; with few excerpts it passes over them again
TASK_BYTES = 8 << 20  # of excerpts that one task trains on
CUT_TEXTS = 512  # excerpts that a task cuts into subwords at once
FREQUENT_WORDS = 200_000  # at most, broadcast with their counts
CACHE_WORDS = 400_000
CACHE_PAIRS = 1_000_000  # different pairs between words that a task gathers before it hands them on

_encoders: dict = {}
_numbered: dict = {}


def encoder(path: str):
    """The tokenizer of a rank file, one per Python worker; it merges within lines, and is given a word a line."""
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("own", pat_str=r"\n|[^\n]+", mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def subwords(word: bytes, encode) -> list[int]:
    return encode(" " + word.decode()) if word else [END_ID]


class _Words(dict):
    """Number of each word; words: by number; flat: all subwords, and by number their place and how many."""

    def __init__(self, encode):
        self.encode, self.words = encode, [END]
        self.flat, self.offset, self.size = array("i", [END_ID]), array("l", [0]), array("l", [1])
        self[END] = 0
        (self.line_end,) = encode("\n")

    def _add(self, words: list[bytes]) -> None:
        """Number words that have none, all cut in one call: words hold no line ends, so these part them."""
        if not words:
            return
        pieces = np.array(self.encode((b" " + b"\n ".join(words) + b"\n").decode()), np.int32)
        ends = pieces == self.line_end
        sizes = np.diff(np.flatnonzero(ends), prepend=-1) - 1
        self.offset.extend((len(self.flat) + np.cumsum(sizes) - sizes).tolist())
        self.size.extend(sizes.tolist())
        self.flat.frombytes(pieces[~ends].tobytes())
        self.update(zip(words, range(len(self), len(self) + len(words))))
        self.words += words

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Number of each; every different word is looked up once."""
        found = words.cast(pa.binary()).dictionary_encode()
        different = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._add([w for w in different if w not in self])
        return np.fromiter(map(self.__getitem__, different), np.int64, len(different))[found.indices.to_numpy()]

    def pieces(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Subwords of the words with these numbers, one after another, and how many each has."""
        flat, offset, size = (np.array(x) for x in (self.flat, self.offset, self.size))
        sizes = size[at]
        first = np.cumsum(sizes) - sizes
        return flat[np.arange(sizes.sum()) + np.repeat(offset[at] - first, sizes)], sizes


def known_words(encode) -> _Words:
    """Words that this Python worker has cut, for whichever task it runs; it begins anew beyond CACHE_WORDS."""
    if encode not in _numbered or len(_numbered[encode]) > CACHE_WORDS:
        _numbered[encode] = _Words(encode)
    return _numbered[encode]


def _split(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """How many words each text has, and all words; lower-cased in A-Z, cut at ASCII white space."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    real = pc.not_equal(words, "")
    ends = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False))))[np.cumsum(pc.list_value_length(lists).to_numpy())]
    return np.diff(ends, prepend=0), words.filter(real)


def _closed(counts: np.ndarray, numbers: np.ndarray, end: int) -> np.ndarray:
    """The numbers of the words of texts, with that of the end mark behind each text."""
    out = np.full(len(numbers) + len(counts), end)
    out[np.arange(len(numbers)) + np.repeat(np.arange(len(counts)), counts)] = numbers
    return out


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def _summed(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    different, at = np.unique(np.concatenate(codes), return_inverse=True)
    return different, np.bincount(at, np.concatenate(counts), len(different)).astype(np.int64)


def gather(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Of training documents: word and n (summed by task); an excerpt with its closing mark and
    a number of its own; or pair (last subword of a word x SUBWORDS + first of the next) and n (summed by task). Before
    the first word of a document stands the end mark."""
    schema = pa.schema(
        [("word", pa.binary()), ("n", pa.int64()), ("excerpt", pa.binary()), ("closed", pa.bool_()), ("pair", pa.int64()), ("number", pa.int64())]
    )

    def rows(size, **columns):
        given = [columns.get(f.name) for f in schema]
        arrays = [pa.nulls(size, f.type) if c is None else pa.array(c, f.type) for f, c in zip(schema, given)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_ordinary
        number = TaskContext.get().partitionId() << 40
        cache, totals = known_words(encode), np.zeros(0, np.int64)
        codes, sums = [], []

        def counted():
            some = np.flatnonzero(totals)
            return rows(len(some), word=[cache.words[i] for i in some.tolist()], n=totals[some])

        for batch in batches:
            for part in row_slices(batch, 0):
                if known_words(encode) is not cache:
                    yield counted()
                    cache, totals = known_words(encode), np.zeros(0, np.int64)
                counts, words = _split(part.column(0))
                at = np.append(cache[END], _closed(counts, cache.numbers(words), cache[END]))
                found = np.bincount(at[1:], minlength=len(cache))
                found[: len(totals)] += totals
                totals = found
                # Excerpts: each text has one at least.
                pieces = np.maximum(-(-counts // EXCERPT_WORDS), 1)
                begin, nth = np.cumsum(counts) - counts, np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                offsets = np.append(np.repeat(begin, pieces) + nth * EXCERPT_WORDS, len(words)).astype(np.int32)
                excerpts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), words), " ").cast(pa.binary())
                numbers = np.arange(number, number + len(excerpts))
                yield rows(len(excerpts), excerpt=excerpts, closed=nth + 1 == np.repeat(pieces, pieces), number=numbers)
                number += len(excerpts)
                flat, offset, size = (np.array(x) for x in (cache.flat, cache.offset, cache.size))
                first, last = flat[offset].astype(np.int64), flat[offset + size - 1].astype(np.int64)
                found, n = np.unique(last[at[:-1]] * SUBWORDS + first[at[1:]], return_counts=True)
                codes.append(found)
                sums.append(n)
                if sum(map(len, codes)) > 2 * CACHE_PAIRS:
                    found, n = _summed(codes, sums)
                    codes, sums = [found], [n]
                    if len(found) > CACHE_PAIRS:
                        yield rows(len(found), pair=found, n=n)
                        codes, sums = [], []
        yield counted()
        found, n = _summed(codes, sums)
        yield rows(len(found), pair=found, n=n)

    known = docs.where(~held_out(F.col("doc_id"))).select("text")
    return known.mapInArrow(run, "word binary, n long, excerpt binary, closed boolean, pair long, number long")


def word_table(gathered: DataFrame, tokenizer: str) -> DataFrame:
    """word, c and pieces (subword ids) of every word of the training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_ordinary
        for batch in batches:
            words = _Words(encode)
            pieces, sizes = words.pieces(words.numbers(batch.column(0)))
            offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(pieces, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["word", "c", "pieces"])

    counts = gathered.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("c"))
    return counts.mapInArrow(run, "word binary, c long, pieces array<int>")


def learn_vocabulary(words: DataFrame, between: DataFrame) -> attention.Vocabulary:
    """Counts of subwords and their pairs; a table of at most SUBWORDS, then INPUTS x OUTCOMES.

    between: pair and n of neighbouring words, as `gather` has them.
    """
    single = words.select(F.explode("pieces").alias("piece"), "c").groupBy("piece").agg(F.sum("c").alias("n")).toArrow()
    counts = np.zeros(SUBWORDS)
    counts[single.column("piece").to_numpy()] = single.column("n").to_numpy()
    vocabulary = attention.Vocabulary(counts)
    inputs, outcomes = vocabulary.begin + 1, attention.CLASSES * attention.MEMBERS + 1
    own_in, own_out = vocabulary.inputs, vocabulary.outcomes
    shared = words.sparkSession.sparkContext.broadcast((own_in, own_out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_in, own_out = shared.value
        cells = np.zeros(inputs * outcomes)
        for batch in batches:
            c = batch.column(0).to_numpy().astype(float)
            lists = batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            ids = lists.flatten().to_numpy()
            begin = np.cumsum(sizes) - sizes
            inner = np.ones(len(ids), bool)
            inner[begin + sizes - 1] = False
            at = np.flatnonzero(inner)
            each = np.repeat(c, sizes)
            pair = own_in[ids[at]].astype(np.int64) * outcomes + own_out[ids[at + 1]]
            cells += np.bincount(pair, each[at], len(cells))
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(cells[at])], ["cell", "n"])

    def run_between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_in, own_out = shared.value
        own_in = own_in.copy()
        own_in[END_ID] = inputs - 1  # after the end mark a text begins
        cells = np.zeros(inputs * outcomes)
        for batch in batches:
            before, after = np.divmod(batch.column(0).to_numpy(), SUBWORDS)
            cells += np.bincount(own_in[before].astype(np.int64) * outcomes + own_out[after], batch.column(1).to_numpy(), len(cells))
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(cells[at])], ["cell", "n"])

    inside = words.select("c", "pieces").mapInArrow(run, "cell long, n double")
    both = inside.union(between.select("pair", "n").mapInArrow(run_between, "cell long, n double"))
    found = both.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells = np.zeros(inputs * outcomes)
    cells[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    vocabulary.learn_pairs(cells.reshape(inputs, outcomes))
    return vocabulary


def place():
    """Where an excerpt is dealt, below 2**32; equal ones go to different places by their number."""
    return F.pmod(F.xxhash64("excerpt", "number"), F.lit(2**32))


def cut_excerpts(texts: list[tuple[bytes, bool]], encode) -> list[np.ndarray]:
    """Subword ids of each excerpt, the end mark behind closed ones; excerpts without any are left out."""
    out = []
    for a in range(0, len(texts), CUT_TEXTS):
        cache = known_words(encode)
        some = texts[a : a + CUT_TEXTS]
        counts, words = _split(pa.array([t for t, _ in some], pa.string()))
        at = _closed(counts, cache.numbers(words), cache[END])
        ends = np.cumsum(counts + 1) - 1
        keep = np.ones(len(at), bool)
        keep[ends] = [c for _, c in some]
        pieces, sizes = cache.pieces(at[keep])
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum(keep)[ends]]
        out += [x for x in np.split(pieces, ends[:-1]) if len(x)]
    return out


def train(excerpts: DataFrame, vocabulary: attention.Vocabulary, tokenizer: str) -> np.ndarray:
    """Weights after as many rounds as there are ROUND_RATES; each excerpt belongs to one."""
    context = excerpts.sparkSession.sparkContext
    n, size = excerpts.agg(F.count("*"), F.coalesce(F.sum(F.length("excerpt")), F.lit(0))).first()
    tasks = max(1, -(-size // (TASK_BYTES * len(ROUND_RATES))))
    # By the whole, not by the task: more tasks than planned must not mean more work.
    passes = -(-LEAST_STEPS * BATCH * tasks * len(ROUND_RATES) // max(n, 1))
    weights = attention.initial(vocabulary)
    for turn, rate in enumerate(ROUND_RATES):
        shared = context.broadcast((weights, vocabulary))

        def run(batches: Iterator[pa.RecordBatch], turn=turn, rate=rate, shared=shared) -> Iterator[pa.RecordBatch]:
            encode = encoder(tokenizer).encode_ordinary
            start, vocabulary = shared.value
            texts = sorted((e, c) for b in batches for e, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            cut = cut_excerpts(texts, encode)
            rng = np.random.default_rng(turn)
            order = np.concatenate([rng.permutation(len(cut)) for _ in range(passes)]) if cut else []

            def steps():
                for a in range(0, len(order), BATCH):
                    rows = [cut[i] for i in order[a : a + BATCH]]
                    yield np.concatenate(rows), np.array([len(r) for r in rows], np.int64)

            after, tokens, _ = attention.train(start, steps(), vocabulary, rate)
            change = (after - start).astype(float) * tokens
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(change), dtype=np.int32)), pa.array(change), pa.array(np.full(len(change), tokens))],
                ["i", "change", "tokens"],
            )

        mine = excerpts.where(F.pmod(place(), F.lit(len(ROUND_RATES))) == turn)
        dealt = mine.repartition(tasks, F.floor(place() / len(ROUND_RATES)))
        moved = dealt.mapInArrow(run, "i int, change double, tokens long").groupBy("i")
        table = moved.agg((F.sum("change") / F.greatest(F.sum("tokens"), F.lit(1))).alias("change")).toArrow()
        step = np.zeros(len(weights))
        step[table.column("i").to_numpy()] = table.column("change").to_numpy()
        weights = (weights + step).astype(np.float32)
    return weights


def frequent_words(words: DataFrame) -> dict[bytes, int]:
    """The most frequent words, FREQUENT_WORDS at most, by a cut through steps of the count."""
    step = F.floor(F.log2("c") * 8)
    steps = words.groupBy(step.alias("step")).count().collect()
    room, cut = FREQUENT_WORDS, None
    for row in sorted(steps, key=lambda r: -r["step"]):
        room -= row["count"]
        if room < 0:
            break
        cut = row["step"]
    if cut is None:
        return {}
    table = words.where(step >= cut).select("word", "c").toArrow()
    return dict(zip(table.column("word").to_pylist(), table.column("c").to_pylist()))


def _base(c, total, distinct):
    """log10 of the smoothed share of a word with count c."""
    return F.log10((c + 0.5) / F.lit(total + 0.5 * (distinct + 1)))


def score_documents(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Nulls count as empty texts, which hold the end mark only; a null id counts as an empty one
    for the fold. Repeated rows are scored, and learnt from, each. Extra columns are ignored;
    an empty table gives an empty result. Without training documents every subword is as likely as
    any. `tokenizer` is a rank file that every executor can read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    gathered = shared_table(gather(rows, tokenizer), "lm_gathered")
    words = shared_table(word_table(gathered, tokenizer), "lm_words")
    vocabulary = learn_vocabulary(words, gathered.where("pair IS NOT NULL"))
    excerpts = gathered.where("excerpt IS NOT NULL").select("excerpt", "closed", "number")
    weights = train(excerpts, vocabulary, tokenizer)
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    divisor = total + 0.5 * (distinct + 1)
    shared = rows.sparkSession.sparkContext.broadcast((weights, vocabulary, frequent_words(words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_ordinary
        weights, vocabulary, frequent = shared.value
        cache, base, state = None, [], []
        for batch in batches:
            for part in row_slices(batch, 2):
                if known_words(encode) is not cache:
                    cache, base, state = known_words(encode), np.zeros(0), np.zeros(0, bool)
                counts, words = _split(part.column(2))
                at = _closed(counts, cache.numbers(words), cache[END])
                counts = counts + 1
                # By number, the base score and whether it is known (else the word is to be looked up).
                c = [frequent.get(w, -1) for w in cache.words[len(base) :]]
                base = np.append(base, [0.0 if n < 0 else math.log10((n + 0.5) / divisor) for n in c])
                state = np.append(state, np.array(c, np.int64) >= 0)
                doc = np.repeat(np.arange(len(counts)), counts)
                pieces, sizes = cache.pieces(at)
                per_doc = np.bincount(doc, sizes, len(counts)).astype(np.int64)
                logp = attention.score(weights, pieces, per_doc, vocabulary)
                scores = np.bincount(np.repeat(np.arange(len(counts)), per_doc), logp, len(counts)) / np.log(10)
                found = state[at]
                look = np.flatnonzero(~found)
                ends = np.searchsorted(doc[look], np.arange(len(counts) + 1)).astype(np.int32)
                rare = pa.ListArray.from_arrays(pa.array(ends), pa.array([cache.words[i] for i in at[look].tolist()], pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(counts),
                        pa.array(np.bincount(doc, found, len(counts)).astype(np.int64)),
                        pa.array(np.bincount(doc, base[at], len(counts))), pa.array(scores), rare,
                    ],
                    ["row", "doc_id", "n_tokens", "known", "base", "score", "rare"],
                )

    scored = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
        run, "row long, doc_id long, n_tokens long, known long, base double, score double, rare array<binary>"
    )
    scored = shared_table(scored, "lm_scored")
    looked = scored.select("row", F.explode("rare").alias("rare_word")).groupBy("row", "rare_word").count()
    c = F.coalesce("c", F.lit(0))
    rest = (
        looked.join(words.select("word", "c"), F.col("rare_word") == F.col("word"), "left")
        .groupBy(F.col("row").alias("rest_row"))
        .agg(
            F.sum(F.col("count") * _base(c, total, distinct)).alias("rest_base"),
            F.sum(F.when(c > 0, F.col("count")).otherwise(0)).alias("rest_known"),
        )
    )
    return scored.join(rest, F.col("row") == F.col("rest_row"), "left").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest_base", F.lit(0.0))).alias("base_score"),
        "score",
    )
