"""Words and word shingles of many texts at once, in numpy."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20  # of text that are worked on at once
SHINGLE = 5

_rng = np.random.default_rng(5)
_BY_PLACE = _rng.integers(0, 2**64, 4096, np.uint64) | np.uint64(1)
_BY_WORD = _rng.integers(0, 2**64, SHINGLE, np.uint64) | np.uint64(1)
_IN_WORD = np.ones(256, bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False


def row_slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `limit` bytes of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = size = 0
    for i, s in enumerate(sizes):
        if i > start and size + s > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += s
    if start < batch.num_rows:
        yield batch.slice(start)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (multiply and shift, twice)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_codes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and 64-bit code of every word, in order; equal words have equal codes."""
    size = np.array([len(r) for r in raw], np.int64)
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    first = np.cumsum(size + 1) - size - 1
    inside = _IN_WORD[data]
    begin = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    shift = np.zeros(len(data), np.int64)
    shift[begin] = np.diff(begin, prepend=0)
    place = np.arange(len(data)) - np.cumsum(shift)
    with np.errstate(over="ignore"):
        terms = (data.astype(np.uint64) + np.uint64(1)) * _BY_PLACE[place & 4095] * inside
        code = np.add.reduceat(terms, begin)
    return np.searchsorted(first, begin, "right") - 1, mixed(code)


def shingle_codes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and code of every run of SHINGLE words; a shorter text is one shingle."""
    doc, code = word_codes(raw)
    counts = np.bincount(doc, minlength=len(raw))
    with np.errstate(over="ignore"):
        total = code * _BY_WORD[0]
        for j in range(1, SHINGLE):
            total[: max(len(code) - j, 0)] += code[j:] * _BY_WORD[j]
    last = np.cumsum(counts)
    left = np.repeat(last, counts) - np.arange(len(code))  # words from here to the end of the text
    # Of a short text the first word stands for all; the words past its end are taken out.
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    for d in short:
        a, b = last[d] - counts[d], last[d]
        with np.errstate(over="ignore"):
            total[a] = (code[a:b] * _BY_WORD[: b - a]).sum() + np.uint64(b - a)
    keep = left >= SHINGLE
    keep[(last - counts)[short]] = True
    return doc[keep], mixed(total[keep])


def occurrences(doc: np.ndarray, code: np.ndarray) -> np.ndarray:
    """How many times each code has come before in its text."""
    order = np.lexsort((code, doc)) if len(doc) and (np.diff(doc) < 0).any() else _by_code(doc, code)
    d, c = doc[order], code[order]
    new = np.ones(len(c), bool)
    new[1:] = (c[1:] != c[:-1]) | (d[1:] != d[:-1])
    start = np.flatnonzero(new)
    out = np.empty(len(c), np.int64)
    out[order] = np.arange(len(c)) - np.repeat(start, np.diff(np.append(start, len(c))))
    return out


def _by_code(doc, code):
    # One sort by a code that holds the text too; texts stay together, equal codes in order.
    with np.errstate(over="ignore"):
        return np.argsort(code ^ mixed(doc.astype(np.uint64) + np.uint64(1)), kind="stable")
