"""Substring de-duplication with content-defined chunks.

A gear rolling hash over the last 32 bytes cuts a text where its top bits are zero, so a cut
depends on nearby bytes only and an insertion shifts no later chunk. Chunks are compared by
a 128-bit digest. The first chunk of a digest stays; later ones are repeats, and runs of
repeats of MIN_RUN bytes or more are removed (a shorter run may be a common phrase). Letters
A-Z compare without case.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.shared import shared_table
from retailflow.llm.words import row_slices

# So fine that a passage of over 50 words (about 320 bytes) has a run of whole chunks in common.
MIN_CHUNK, MAX_CHUNK, CUT_BITS = 16, 256, 4  # 16 bytes, then 16 more on average
MIN_RUN = 64
BLOCK_CHUNKS = 1 << 20  # of documents whose chunks are compared with one another first
GROUP_CHUNKS = 500_000  # of different blocks that are compared at once, about
ROW_GROUP = 16 << 20  # bytes; rows are long, and a reader takes up to 4,096 of a row group
WINDOW = 32  # bytes of the hash; no cut so near to the start of a text that others would be hashed

BLOCK_SCHEMA = (
    "block long, group long, base long, digests binary, docs array<long>, rows array<long>, "
    "counts array<int>, lengths array<short>, entries array<int>"
)
_BLOCK_ARROW = pa.schema([
    ("block", pa.int64()), ("group", pa.int64()), ("base", pa.int64()), ("digests", pa.binary()),
    *((n, pa.list_(t)) for n, t in [
        ("docs", pa.int64()), ("rows", pa.int64()), ("counts", pa.int32()), ("lengths", pa.int16()), ("entries", pa.int32()),
    ]),
])
SPAN_SCHEMA = (
    "row long, doc_id long, n_bytes long, n_chunks long, n_removed long, n_spans long, "
    "spans array<struct<start: long, end: long>>, copied_from array<long>"
)
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

_GEAR = np.random.default_rng(11).integers(0, 2**32, 256, np.uint32)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """The gear hash of the 32 bytes that end at each place: doubled windows, five times."""
    h = _GEAR[data]
    for s in (1, 2, 4, 8, 16):
        longer = h.copy()
        longer[s:] += h[:-s] << np.uint32(s)
        h = longer
    return h


def cut_points(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> list[list[int]]:
    """Chunk ends of each text that lies at data[first:first + size]; offsets in the text."""
    marks = np.flatnonzero(gear_hash(data) >> np.uint32(32 - CUT_BITS) == 0) + 1  # a cut follows the byte
    low, high = np.searchsorted(marks, first, "left"), np.searchsorted(marks, first + size, "right")
    marks = marks.tolist()
    out = []
    for f, n, a, b in zip(first.tolist(), size.tolist(), low.tolist(), high.tolist()):
        ends, last, stop = [], f, f + n
        for m in marks[a:b]:
            while m - last > MAX_CHUNK:
                last += MAX_CHUNK
                ends.append(last - f)
            if m - last >= MIN_CHUNK and m - f >= WINDOW:
                last = m
                ends.append(m - f)
        while stop - last > MAX_CHUNK:
            last += MAX_CHUNK
            ends.append(last - f)
        if stop > last:
            ends.append(n)
        out.append(ends)
    return out


def _block(held: list, groups: int) -> Iterator[pa.RecordBatch]:
    """Rows of one block for BLOCK_SCHEMA: the block itself, then its distinct digests by group."""
    docs = pa.concat_arrays([h[1] for h in held])
    rows = np.concatenate([h[0].to_numpy() for h in held])
    counts, lengths = (np.concatenate([h[i] for h in held]) for i in (2, 3))
    digests = np.concatenate([h[4] for h in held])
    order = np.lexsort((rows, docs.fill_null(0).to_numpy(), docs.is_valid().to_numpy(zero_copy_only=False)))
    begin, block, docs, rows = (np.cumsum(counts) - counts)[order], rows.min(), docs.take(pa.array(order)), rows[order]
    counts = counts[order]
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(lengths)) + (begin - (np.cumsum(counts) - counts))[owner]
    digests, lengths = digests[place], lengths[place]
    by = np.lexsort((digests[:, 1], digests[:, 0]))  # stable: the first of a digest comes first
    new = np.ones(len(by), bool)
    new[1:] = (digests[by[1:]] != digests[by[:-1]]).any(1)
    entries = np.empty(len(by), np.int32)
    entries[by] = np.cumsum(new) - 1
    yield pa.RecordBatch.from_pylist(
        [{
            "block": block, "group": -1, "docs": docs, "rows": rows, "counts": counts.astype(np.int32),
            "lengths": lengths.astype(np.int16), "entries": entries,
        }],
        _BLOCK_ARROW,
    )
    first = by[new]
    group = ((digests[first, 0] >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
    start = np.flatnonzero(np.diff(group, prepend=-1))
    raw, ends = digests[first].tobytes(), np.append(start, len(first))[1:]
    own = pa.array(np.append(start, len(first)).astype(np.int32))
    n = len(start)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, block)), pa.array(group[start]), pa.array(start),
            pa.array([raw[16 * a : 16 * b] for a, b in zip(start, ends)], pa.binary()),
            pa.ListArray.from_arrays(own, docs.take(pa.array(owner[first]))),
            *(pa.nulls(n, t.type) for t in list(_BLOCK_ARROW)[5:]),
        ],
        schema=_BLOCK_ARROW,
    )


def chunk_blocks(docs: DataFrame, groups: int, block_chunks: int) -> DataFrame:
    """Documents in blocks of about `block_chunks` chunks, of consecutive rows; BLOCK_SCHEMA.

    A row with group -1 is a block: its documents by (doc_id, row) with their numbers of chunks, and
    of all chunks in that order the length and the entry, a number of its digest in the block. The
    other rows hold the distinct digests of a block, dealt by digest into `groups`: entries from
    `base` on, and the document of each one's first chunk in the block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size_held = [], 0
        for batch in batches:
            for part in row_slices(batch, 2):
                raw = [(t or "").encode().lower() for t in part.column(2).to_pylist()]
                size = np.array([len(r) for r in raw], np.int64)
                data = np.frombuffer(b"".join(raw) or b"\0", np.uint8)
                ends = cut_points(data, np.cumsum(size) - size, size)
                digests = [
                    hashlib.blake2b(r[a:b], digest_size=16).digest() for r, e in zip(raw, ends) for a, b in zip([0, *e], e)
                ]
                lengths = np.array([b - a for e in ends for a, b in zip([0, *e], e)], np.int64)
                counts = np.array([len(e) for e in ends], np.int64)
                both = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
                held.append((part.column(0), part.column(1), counts, lengths, both))
                size_held += len(lengths) + len(counts)
                if size_held >= block_chunks:
                    yield from _block(held, groups)
                    held, size_held = [], 0
        if held:
            yield from _block(held, groups)

    return docs.select("row", "doc_id", "text").mapInArrow(run, BLOCK_SCHEMA)


def _later(table: pa.Table) -> pa.Table:
    """Of one group of digests: entries that other blocks hold first, and the document there."""
    table = table.combine_chunks()
    digests = [np.frombuffer(d, np.uint64).reshape(-1, 2) for d in table.column("digests").to_pylist()]
    counts = np.array([len(d) for d in digests])
    hi, lo = np.concatenate(digests).T
    line = np.repeat(np.arange(len(counts)), counts)
    entry = np.arange(len(hi)) + (table.column("base").to_numpy() - (np.cumsum(counts) - counts))[line]
    docs = pc.list_flatten(table.column("docs")).combine_chunks()
    docs = docs if isinstance(docs, pa.Array) else pa.concat_arrays(docs.chunks)
    ids, known = docs.fill_null(0).to_numpy(), docs.is_valid().to_numpy(zero_copy_only=False)
    by = np.argsort(hi, kind="stable")
    equal = hi[by[1:]] == hi[by[:-1]]
    twice = by[np.append(equal, False) | np.insert(equal, 0, False)]
    blocks = table.column("block").to_numpy()[line[twice]]
    twice = twice[np.lexsort((blocks, ids[twice], known[twice], lo[twice], hi[twice]))]
    new = np.ones(len(twice), bool)
    new[1:] = (hi[twice[1:]] != hi[twice[:-1]]) | (lo[twice[1:]] != lo[twice[:-1]])
    first = twice[new][np.cumsum(new) - 1]
    later, first = twice[~new], first[~new]
    by = np.argsort(line[later], kind="stable")
    later, first = later[by], first[by]
    lines, start = np.unique(line[later], return_index=True)
    own = pa.array(np.append(start, len(later)).astype(np.int32))
    return pa.Table.from_arrays(
        [
            table.column("block").take(pa.array(lines)),
            pa.ListArray.from_arrays(own, pa.array(entry[later].astype(np.int32))),
            pa.ListArray.from_arrays(own, docs.take(pa.array(first))),
        ],
        ["block", "entries", "from_docs"],
    )


def _spans(block: pa.Table, later: pa.Table, min_run: int) -> pa.Table:
    """SPAN_SCHEMA rows of the documents of one block."""
    row = {c: block.column(c).combine_chunks().flatten() for c in ("docs", "rows", "counts", "lengths", "entries")}
    row = {c: pa.concat_arrays(v.chunks) if isinstance(v, pa.ChunkedArray) else v for c, v in row.items()}
    counts, lengths, entries = (row[c].to_numpy().astype(np.int64) for c in ("counts", "lengths", "entries"))
    ids, known = row["docs"].fill_null(0).to_numpy(), row["docs"].is_valid().to_numpy(zero_copy_only=False)
    n, owner = len(entries), np.repeat(np.arange(len(counts)), counts)
    first = np.empty(entries.max(initial=-1) + 1, np.int64)
    first[entries[::-1]] = np.arange(n)[::-1]
    from_id, from_known = ids[owner[first]], known[owner[first]]
    repeat = first[entries] != np.arange(n)
    if later.num_rows:
        there = np.concatenate([np.asarray(e, np.int64) for e in later.column("entries").to_pylist()])
        source = pa.array([d for docs in later.column("from_docs").to_pylist() for d in docs], pa.int64())
        elsewhere = np.zeros(len(first), bool)
        elsewhere[there] = True
        from_id, from_known = from_id.copy(), from_known.copy()
        from_id[there], from_known[there] = source.fill_null(0).to_numpy(), source.is_valid().to_numpy(zero_copy_only=False)
        repeat |= elsewhere[entries]
    edge = np.ones(n, bool)
    edge[1:] = owner[1:] != owner[:-1]
    begins = np.flatnonzero(repeat & (edge | ~np.insert(repeat, 0, False)[:n]))
    ends = np.flatnonzero(repeat & np.append((edge | ~repeat)[1:], True)[:n])
    total = np.append(0, np.cumsum(lengths))
    at = total[np.append(0, np.cumsum(counts))]  # where each text begins
    long = total[ends + 1] - total[begins] >= min_run
    begins, ends = begins[long], ends[long]
    of = owner[begins]
    bounds = np.searchsorted(of, np.arange(len(counts) + 1)).tolist()
    starts, stops = (total[begins] - at[of]).tolist(), (total[ends + 1] - at[of]).tolist()
    spans, sources = [], []
    for a, b in zip(bounds, bounds[1:]):
        if a == b:
            spans.append(None)
            sources.append(None)
            continue
        spans.append([{"start": s, "end": e} for s, e in zip(starts[a:b], stops[a:b])])
        inside = np.concatenate([entries[x : y + 1] for x, y in zip(begins[a:b], ends[a:b])])
        sources.append(np.unique(from_id[inside[from_known[inside]]]))
    removed = np.bincount(of, total[ends + 1] - total[begins], len(counts)).astype(np.int64)
    return pa.Table.from_arrays(
        [
            row["rows"], row["docs"], pa.array(np.diff(at)), pa.array(counts), pa.array(removed),
            pa.array(np.diff(bounds)), pa.array(spans, _SPANS), pa.array(sources, pa.list_(pa.int64())),
        ],
        ["row", "doc_id", "n_bytes", "n_chunks", "n_removed", "n_spans", "spans", "copied_from"],
    )


def removed_spans(rows: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """rows: (row, doc_id, text) with `row` unique. One row per document: row, doc_id, n_bytes,
    n_chunks, n_removed, n_spans, spans (start and end in bytes) and copied_from (ids of the
    documents that hold the first copies).

    A block sends each of its different digests once, so a chunk that many documents share is one
    entry per block, and gets back only those that another block holds first.
    """
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // ((MIN_CHUNK + 2**CUT_BITS) * GROUP_CHUNKS)))
    stored = shared_table(chunk_blocks(rows, groups, BLOCK_CHUNKS), "chunk_blocks", **{"parquet.block.size": ROW_GROUP})
    digests = stored.where("group >= 0").select("block", "group", "base", "digests", "docs")
    later = digests.groupBy("group").applyInArrow(_later, "block long, entries array<int>, from_docs array<long>")
    blocks = stored.where("group = -1").select("block", "docs", "rows", "counts", "lengths", "entries")

    def spans(block: pa.Table, later: pa.Table) -> pa.Table:
        return _spans(block, later, min_run)

    return blocks.groupBy("block").cogroup(later.groupBy("block")).applyInArrow(spans, SPAN_SCHEMA)


def repeated_chunks(docs: DataFrame, **options) -> DataFrame:
    """What `removed_spans` says of each document, without the row number.

    Of equal chunks that of the smallest (doc_id, place) stays; a null id is the smallest, and
    rows that repeat an id are documents of their own. Null and empty texts have no chunks.
    Extra columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    return removed_spans(rows, **options).drop("row")


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """doc_id and text without the removed spans (bytes that are no whole character go too)."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = shared_table(rows, "chunking_rows")
    spans = removed_spans(rows, **options).where("n_removed > 0").select("row", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if spans:
                    raw, at, kept = text.encode(), 0, []
                    for s in spans:
                        kept.append(raw[at : s["start"]])
                        at = s["end"]
                    text = b"".join([*kept, raw[at:]]).decode(errors="ignore")
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.join(spans, "row", "left").select("doc_id", "text", "spans").mapInArrow(cut, "doc_id long, text string")
