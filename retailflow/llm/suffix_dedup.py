"""Exact substring de-duplication with suffix arrays.

Every byte that a string of WIDTH bytes covers goes if that string also starts anywhere else.
The corpus is dealt to shards so that equal strings meet:

* The anchor of a string is its least hashed GRAM-byte part. Equal strings have equal anchors,
  so strings are dealt by the anchor, a stretch of text with all its strings for one anchor.
* Before that, stretches that can't repeat are left out. All strings that hold their anchor at
  places of one STEP share a core of bytes; a core that occurs once rules them out. This only
  saves work: a core that repeats proves nothing.
* Each shard sorts the suffixes of its text (Larsson-Sadakane refinement), gets common prefixes
  by Kasai's method and finds strings with a common prefix of WIDTH with a neighbour.
* An anchor with more stretches or bytes than a shard takes fills several shards. What is left single in
  one of them is searched in the sorted strings of the others by binary search.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.shared import shared_table
from retailflow.llm.words import mixed, row_slices

WIDTH = 400
GRAM = 65
STEP = 112  # anchor places of one core; WIDTH - GRAM + 1 is a multiple of it
PIECE = 1 << 20  # window starts of a text that are worked on at once
SHARD_BYTES = 1 << 20
SHARD_STRETCHES = 1500  # of one anchor in one shard
ANCHOR_BYTES = 2 << 20  # of one anchor in one shard
MERGED = 4096  # strings of neighbours with one anchor that go as one stretch, about

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STARTS = WIDTH - GRAM + 1  # places of the anchor in a string


class _Rolling:
    """Hashes of substrings of one piece of data: running sums of bytes times powers."""

    _up = _down = np.zeros(0, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(_Rolling._up) < n + 1:
            inverse = np.uint64(pow(int(_BASE), -1, 2**64))
            with np.errstate(over="ignore"):
                _Rolling._up = np.cumprod(np.full(n + 1, _BASE))
                _Rolling._down = np.cumprod(np.full(n + 1, inverse))
        self.sums = np.zeros(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _Rolling._up[:n], out=self.sums[1:])

    def of(self, start, stop):
        with np.errstate(over="ignore"):
            return (self.sums[stop] - self.sums[start]) * _Rolling._down[start]

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        with np.errstate(over="ignore"):
            return (self.sums[size:] - self.sums[:-size]) * _Rolling._down[:n]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours, by running minima from both ends of blocks."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def stretches(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Runs of neighbouring strings with one anchor and one core, as arrays.

    text, start (of the first string), count, gram (the anchor's code), core (code of the core).
    """
    names = ("text", "start", "count", "gram", "core")
    parts: dict[str, list] = {n: [] for n in names}
    # Short texts go together; long ones in pieces that overlap by a string.
    jobs, held, size = [], [], 0
    for i, t in enumerate(texts):
        if len(t) < WIDTH:
            continue
        for at in range(0, len(t) - WIDTH + 1, PIECE):
            piece = (i, at, t[at : at + PIECE + WIDTH - 1])
            held.append(piece)
            size += len(piece[2])
            if size >= PIECE:
                jobs.append(held)
                held, size = [], 0
    if held:
        jobs.append(held)
    low = np.uint64((1 << 23) - 1)  # a place in the data of one job
    for job in jobs:
        data = np.frombuffer(b"".join(p[2] for p in job), np.uint8)
        lengths = np.array([len(p[2]) for p in job])
        first = np.cumsum(lengths) - lengths
        rolling = _Rolling(data)
        grams = mixed(rolling.grams(GRAM))
        keyed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)  # ties: leftmost
        anchor = (_sliding_min(keyed, _STARTS) & low).astype(np.int64)
        strings = lengths - WIDTH + 1
        owner = np.repeat(np.arange(len(job)), strings)
        start = np.arange(len(owner)) - np.repeat(np.cumsum(strings) - strings, strings) + first[owner]
        at = anchor[start]
        step = (at - start) // STEP
        new = np.ones(len(start), bool)
        new[1:] = (at[1:] != at[:-1]) | (step[1:] != step[:-1]) | (owner[1:] != owner[:-1])
        head = np.flatnonzero(new)
        at, step, begin = at[head], step[head], start[head]
        core_start = at - step * STEP
        core = rolling.of(core_start, at - (step + 1) * STEP + 1 + WIDTH)
        piece = owner[head]
        parts["text"].append(np.array([p[0] for p in job])[piece])
        parts["start"].append(begin - first[piece] + np.array([p[1] for p in job])[piece])
        parts["count"].append(np.diff(np.append(head, len(start))))
        parts["gram"].append(grams[at].view(np.int64))
        parts["core"].append(mixed(core + step.astype(np.uint64)).view(np.int64))
    return {n: np.concatenate(v) if v else np.zeros(0, np.int64) for n, v in parts.items()}


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes and rank of each, by Larsson-Sadakane refinement.

    Suffixes are sorted by 8 bytes, then groups that are still equal by the rank of the suffix
    8, 16, 32 ... places on. A group's rank is the place of its last member; groups of one are
    done and left alone.
    """
    n = len(data)
    padded = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key = (key << np.uint64(8)) | padded[j : n + j]
    order = np.argsort(key, kind="stable")
    last = np.append(np.flatnonzero(np.diff(key[order]) != 0), n - 1)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(last, np.diff(last, prepend=-1))
    h = 8
    # Zero bytes at the very end could equal the padding: the shorter suffix must come first.
    active = np.flatnonzero(np.repeat(np.diff(last, prepend=-1) > 1, np.diff(last, prepend=-1)))
    while len(active):
        suffix = order[active]
        ahead = suffix + h
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1 - np.minimum(ahead - n, 1 << 20))
        # Groups lie one after another, so one sort by (group, second) sorts each in itself.
        both = rank[suffix] * (2 * n + (1 << 21)) + second + (1 << 20) + 1
        sort = np.argsort(both)
        suffix, both = suffix[sort], both[sort]
        order[active] = suffix
        change = np.append(np.flatnonzero(np.diff(both) != 0), len(active) - 1)
        sizes = np.diff(change, prepend=-1)
        rank[suffix] = np.repeat(active[change], sizes)
        active = active[np.repeat(sizes > 1, sizes)]
        h *= 2
    return order, rank


def common_prefixes(data: np.ndarray, order: np.ndarray, rank: np.ndarray, lanes: int = 2048) -> np.ndarray:
    """Common prefix of each suffix in `order` with the one before, by Kasai's method.

    The text is cut into lanes that walk forward together, each keeping what it knows of its
    last suffix; a lane either compares 8 more bytes or steps on.
    """
    n = len(data)
    # The padding differs from every byte, and a suffix ends where the text ends.
    wide = np.concatenate((data, np.zeros(16, np.uint8)))
    eight = np.zeros(n + 8, np.uint64)
    for j in range(8):
        eight |= wide[j : n + 8 + j].astype(np.uint64) << np.uint64(8 * j)
    out = np.zeros(n, np.int64)
    bounds = np.linspace(0, n, min(lanes, n) + 1).astype(np.int64)
    at, stop = bounds[:-1].copy(), bounds[1:]
    h = np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    while len(live):
        i, k = at[live], h[live]
        place = rank[i]
        j = order[place - 1]
        room = n - np.maximum(i, j) - k
        room[place == 0] = 0
        differ = eight[np.minimum(i + k, n)] ^ eight[np.minimum(j + k, n)]
        lowest = differ & (~differ + np.uint64(1))
        equal = np.where(differ == 0, 8, (np.log2(np.maximum(lowest, 1).astype(np.float64)) / 8).astype(np.int64))
        equal = np.minimum(equal, np.maximum(room, 0))
        k = k + equal
        step = equal < 8
        here = live[step]
        out[place[step]] = np.where(place[step] == 0, 0, k[step])
        at[here] += 1
        h[live] = k
        h[here] = np.maximum(np.where(place[step] == 0, 0, k[step]) - 1, 0)
        live = live[at[live] < stop[live]]
    return out


def repeated_strings(pieces: list[bytes], counts: np.ndarray, lanes: int = 2048):
    """For stretches of text with `counts` strings each: which strings occur more than once.

    Returns a flag for each string (stretch by stretch) and a class number: equal strings have one class.
    """
    names: dict[bytes, int] = {}
    which = np.array([names.setdefault(p, len(names)) for p in pieces], np.int64)
    different = list(names)
    times = np.bincount(which, minlength=len(different))
    lengths = np.array([len(p) for p in different])
    strings = lengths - WIDTH + 1
    data = np.frombuffer(b"".join(different), np.uint8)
    order, rank = suffix_array(data)
    prefix = common_prefixes(data, order, rank, lanes)
    first = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(different)), strings)
    before = np.cumsum(strings) - strings
    start = np.arange(len(owner)) - before[owner] + first[owner]
    run = np.cumsum(prefix < WIDTH)  # suffixes in order with WIDTH equal bytes
    run_of = run[rank[start]]
    weight = np.bincount(run_of, times[owner], minlength=run[-1] + 1 if len(run) else 1)
    flags, classes = weight[run_of] > 1, run_of
    rows = np.repeat(before[which], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return flags[rows], classes[rows]


def _intervals(flags: np.ndarray, counts: np.ndarray):
    """Stretch, first and end of runs of flagged strings."""
    ends = np.cumsum(counts)
    edge = np.zeros(len(flags), bool)
    edge[ends - counts] = True
    begin = np.flatnonzero(flags & (edge | ~np.concatenate(([False], flags[:-1]))))
    stop = np.flatnonzero(flags & np.concatenate((edge[1:] | ~flags[1:], [True]))) + 1
    owner = np.searchsorted(ends, begin, "right")
    return owner, begin - (ends - counts)[owner], stop - (ends - counts)[owner]


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("body"), text.alias("text"))


def _raw(part: pa.RecordBatch, column: int) -> list[bytes]:
    return [t.encode() for t in part.column(column).to_pylist()]


def _cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in row_slices(batch, 2):
            found = stretches(_raw(part, 2))
            # Each core of a text once: a text that repeats itself may hold one very often.
            order = np.lexsort((found["core"], found["text"]))
            text, core = found["text"][order], found["core"][order]
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (core[1:] != core[:-1])
            head = np.flatnonzero(new)
            owner = pa.array(text[head])
            columns = [part.column(0).take(owner), part.column(1).take(owner), pa.array(core[head])]
            times = pa.array(np.diff(np.append(head, len(text))))
            yield pa.RecordBatch.from_arrays([*columns, times], ["doc_id", "body", "core", "times"])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of one anchor whose cores repeat, neighbours of one anchor as one stretch.

    In periodic text one anchor may go on to the end, so a stretch ends after MERGED strings and the
    next one begins at the following string.
    """
    for batch in batches:
        for part in row_slices(batch, 2):
            raw = _raw(part, 2)
            found = stretches(raw)
            lists = part.column(3)
            flat = lists.values.to_numpy(zero_copy_only=False)
            offsets = lists.offsets.to_numpy()
            good = np.zeros(len(found["core"]), bool)
            bounds = np.searchsorted(found["text"], np.arange(len(raw) + 1))
            for i in range(len(raw)):
                a, b = bounds[i], bounds[i + 1]
                good[a:b] = np.isin(found["core"][a:b], flat[offsets[i] : offsets[i + 1]])
            found = {k: v[good] for k, v in found.items()}
            text, start, count, gram = (found[k] for k in ("text", "start", "count", "gram"))
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (gram[1:] != gram[:-1]) | (start[1:] != (start + count)[:-1])
            head = np.flatnonzero(new)
            since = start - np.repeat(start[head], np.diff(np.append(head, len(start))))
            new[1:] |= since[1:] // MERGED != since[:-1] // MERGED
            head = np.flatnonzero(new)
            total = np.add.reduceat(count, head) if len(head) else count
            text, start, gram = text[head], start[head], gram[head]
            bodies = [raw[t][s : s + c + WIDTH - 1] for t, s, c in zip(text.tolist(), start.tolist(), total.tolist())]
            owner = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(owner), part.column(1).take(owner), pa.array(gram),
                    pa.array(start), pa.array(total), pa.array(bodies, pa.binary()),
                ],
                ["doc_id", "body", "gram", "start", "count", "piece"],
            )


def _shard(table: pa.Table) -> pa.Table:
    """Runs of repeated strings of a shard; of split anchors also every different string."""
    counts = table.column("count").to_numpy()
    flags, classes = repeated_strings(table.column("piece").to_pylist(), counts)
    owner, begin, stop = _intervals(flags, counts)
    starts = table.column("start").to_numpy()
    split = table.column("split").to_numpy(zero_copy_only=False)
    # The first string of each class, in stretches of split anchors.
    each = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(each)) - np.repeat(np.cumsum(counts) - counts, counts)
    rows = np.flatnonzero(split[each])
    _, pick = np.unique(classes[rows], return_index=True)
    rows = rows[pick]
    pieces = table.column("piece")
    texts = {s: pieces[s].as_py() for s in np.unique(each[rows]).tolist()}
    strings = (texts[s][p : p + WIDTH] for s, p in zip(each[rows].tolist(), place[rows].tolist()))
    digests = [hashlib.blake2b(x, digest_size=16).digest() for x in strings]
    both = np.concatenate((owner, each[rows]))
    first = np.concatenate((begin, place[rows])) + starts[both]
    last = np.concatenate((stop, place[rows] + 1)) + starts[both] + WIDTH - 1
    single = np.concatenate((np.zeros(len(owner), bool), ~flags[rows]))
    take = pa.array(both)
    return pa.table({
        "doc_id": table.column("doc_id").combine_chunks().take(take),
        "body": table.column("body").combine_chunks().take(take),
        "shard": table.column("shard").combine_chunks().take(take),
        "start": pa.array(first),
        "end": pa.array(last),
        "digest": pa.array([None] * len(owner) + digests, pa.binary()),
        "single": pa.array(single),
    })


def _merge(table: pa.Table) -> pa.Table:
    """Strings that are single in their shard and found in another one, by binary search."""
    digest = np.array(table.column("digest").to_pylist(), dtype="S17")  # never ends in the padding
    shard = table.column("shard").to_numpy()
    single = table.column("single").to_numpy(zero_copy_only=False)
    found = np.zeros(len(digest), bool)
    everything = np.sort(digest)
    for s in np.unique(shard):
        own = np.flatnonzero(shard == s)
        low, high = (np.searchsorted(everything, digest[own], side) for side in ("left", "right"))
        found[own] = high - low > 1  # a shard gives each string once
    return table.filter(pa.array(found & single)).select(["doc_id", "body", "start", "end"])


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, body, start, end) of byte spans to remove, maybe overlapping, and the candidate rows."""
    rows = _rows(docs)
    cores = rows.mapInArrow(_cores, "doc_id long, body long, core long, times long")
    cores = shared_table(cores, "suffix_cores")
    twice = cores.groupBy("core").agg(F.sum("times").alias("n")).where("n > 1").select("core")
    wanted = cores.join(twice, "core").groupBy("doc_id", "body").agg(F.collect_set("core").alias("cores"))
    wanted = wanted.select(F.col("doc_id").alias("w_id"), F.col("body").alias("w_body"), "cores")
    same = F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("body") == F.col("w_body"))
    found = shared_table(rows.join(wanted, same).select("doc_id", "body", "text", "cores"), "suffix_candidates")
    pieces = found.mapInArrow(
        _candidates, "doc_id long, body long, gram long, start long, count long, piece binary"
    )
    pieces = shared_table(pieces, "suffix_pieces")
    sizes = shared_table(pieces.groupBy("gram").agg(F.count("*").alias("n"), F.sum(F.length("piece")).alias("bytes")), "suffix_grams")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    ways = F.greatest(F.ceil(F.col("n") / SHARD_STRETCHES), F.ceil(F.col("bytes") / ANCHOR_BYTES))
    hot = sizes.select(F.col("gram").alias("hot_gram"), ways.alias("ways")).where("ways > 1")
    # Few rows: an anchor is hot with SHARD_STRETCHES stretches or ANCHOR_BYTES. Spark decides by size.
    hot = shared_table(hot, "suffix_hot")
    dealt = pieces.join(hot, F.col("gram") == F.col("hot_gram"), "left")
    way = F.pmod(F.xxhash64("doc_id", "body", "start"), F.coalesce("ways", F.lit(1)))
    # A split anchor has shards of its own, numbered below zero.
    own = -1 - F.pmod(F.xxhash64("gram", way), F.lit(2**40))
    shard = F.when(F.col("ways").isNotNull(), own).otherwise(F.pmod(F.xxhash64("gram"), F.lit(shards)))
    dealt = dealt.select(
        "doc_id", "body", "start", "count", "piece", shard.alias("shard"), F.col("ways").isNotNull().alias("split")
    )
    result = dealt.groupBy("shard").applyInArrow(
        _shard, "doc_id long, body long, shard long, start long, end long, digest binary, single boolean"
    )
    result = shared_table(result, "suffix_shards")
    buckets = max(1, -(-result.where("digest IS NOT NULL").count() // 100_000))
    merged = (
        result.where("digest IS NOT NULL")
        .groupBy(F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket"))
        .applyInArrow(lambda t: _merge(t), "doc_id long, body long, start long, end long")
    )
    spans = result.where("digest IS NULL").select("doc_id", "body", "start", "end").union(merged)
    return spans, found


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {k: [] for k in ("n_removed", "n_spans", "sha", "kept")}
        for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            raw, at, removed, runs, kept = text.encode(), 0, 0, 0, []
            reach = -1  # end of the last removed run
            for s in spans:
                a, b = s["start"], s["end"]
                if a > reach:
                    runs += 1
                    kept.append(raw[at:a])
                    removed += b - a
                elif b > reach:
                    removed += b - reach
                at = reach = max(reach, b)
            kept.append(raw[at:])
            rest = b"".join(kept)
            for k, v in zip(out, (removed, runs, hashlib.sha256(rest).hexdigest(), rest)):
                out[k].append(v)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1),
                pa.array(out["n_removed"], pa.int64()), pa.array(out["n_spans"], pa.int64()),
                pa.array(out["sha"], pa.string()), pa.array(out["kept"], pa.binary()),
            ],
            ["doc_id", "body", "n_removed", "n_spans", "sha", "kept"],
        )


def cut_documents(docs: DataFrame) -> DataFrame:
    """doc_id, body (hash of the text), n_removed, n_spans, sha (SHA-256) and kept (the bytes that
    are left) of every document that loses bytes."""
    spans, found = repeated_spans(docs)
    lists = spans.groupBy("doc_id", "body").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    lists = lists.select(F.col("doc_id").alias("s_id"), F.col("body").alias("s_body"), "spans")
    same = F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("body") == F.col("s_body"))
    cut = found.select("doc_id", "body", "text").join(lists, same).select("doc_id", "body", "text", "spans")
    return cut.mapInArrow(_cut, "doc_id long, body long, n_removed long, n_spans long, sha string, kept binary")


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null text counts as empty; texts under WIDTH bytes lose nothing. Rows that repeat an id
    are documents of their own, so a repeated row of WIDTH bytes or more loses all of it. Null
    ids are kept as they are. Extra columns are ignored; an empty table gives an empty result.
    """
    cut = cut_documents(docs).select(
        F.col("doc_id").alias("c_id"), F.col("body").alias("c_body"), "n_removed", "n_spans", "sha"
    ).dropDuplicates(["c_id", "c_body"])
    whole = _rows(docs).select(
        "doc_id", "body", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("own_sha")
    )
    same = F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("body") == F.col("c_body"))
    return whole.join(cut, same, "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("sha", "own_sha").alias("kept_sha256"),
    )
