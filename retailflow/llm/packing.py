"""Best-fit packing into bins of several permitted sequence lengths.

Pieces are placed longest first into the open bin that they fill best. If none has room, a
bin is opened at the length with the least cost per token, judged by what the pieces still to
come could fill it with. At the end each bin shrinks to the least length that holds it.

Each partition packs its own pieces: only ids and lengths enter, nothing is shuffled, and a
lost task is packed again from its input. A partition leaves a few bins part empty.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.shared import WORD

CAPACITIES = (512, 1024, 2048, 4096)
BIN_OVERHEAD = 32  # tokens that a bin costs beside its length
ATTENTION_SPAN = 16_384  # a bin of this length costs as much again for attention


def best_fit(lengths, capacities=CAPACITIES, overhead=BIN_OVERHEAD, span=ATTENTION_SPAN):
    """Bin and offset of each piece, and the final capacity of each bin.

    lengths: whole numbers from 1 to the largest capacity, in falling order.
    """
    capacities = sorted(capacities)
    left = np.bincount(np.asarray(lengths, np.int64), minlength=capacities[-1] + 1).tolist()
    coming = sum(1 << n for n, c in enumerate(left) if c)  # bit n: a piece of length n is to come
    rooms: list[list[int]] = [[] for _ in range(capacities[-1] + 1)]  # open bins by free room
    open_rooms = 0  # bit r: a bin with free room r is open
    opened: list[int] = []  # the capacity each bin was opened at
    used: list[int] = []
    bins, offsets = [], []

    def fill(room: int) -> int:
        """How many tokens of the coming pieces fit, largest first."""
        start, taken, length = room, 0, -1
        while room > 0:
            here = (coming & ((2 << room) - 1)).bit_length() - 1
            if here == length:
                taken += 1
            else:
                length, taken = here, 1
            while length > 0 and taken > left[length]:
                length, taken = (coming & ((1 << length) - 1)).bit_length() - 1, 1
            if length <= 0:
                break
            room -= length
        return start - room

    for n in map(int, lengths):
        left[n] -= 1
        if not left[n]:
            coming &= ~(1 << n)
        fits = open_rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                open_rooms &= ~(1 << room)
        else:
            cost = [((c + c * c / span + overhead) / (n + fill(c - n)), -c) for c in capacities if c >= n]
            room = -min(cost)[1]
            b = len(opened)
            opened.append(room)
            used.append(0)
        bins.append(b)
        offsets.append(used[b])
        used[b] += n
        if room > n:
            rooms[room - n].append(b)
            open_rooms |= 1 << (room - n)
    final = np.asarray(capacities)[np.searchsorted(capacities, used)] if used else np.zeros(0, np.int64)
    return np.asarray(bins, np.int64), np.asarray(offsets, np.int64), final


def pack(
    lengths: DataFrame,
    capacities: tuple[int, ...] = CAPACITIES,
    overhead: float = BIN_OVERHEAD,
    span: float = ATTENTION_SPAN,
) -> DataFrame:
    """lengths: (doc_id, n_tokens). One row per piece of a document.

    A document longer than the largest capacity is cut into pieces of that size and a rest.
    Columns: doc_id, piece, piece_start, piece_tokens, bin_id, bin_offset, bin_tokens,
    bin_capacity. bin_id is unique over all partitions. Lengths that are null or below 1 give
    no piece; null ids and repeated rows are packed like any; an empty table gives none.
    """
    largest = max(capacities)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        total = table.column("n_tokens").to_numpy()
        pieces = -(-total // largest)
        row = np.repeat(np.arange(len(total)), pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        length = np.minimum(total[row] - piece * largest, largest)
        ids = table.column("doc_id").combine_chunks().take(pa.array(row))
        order = np.lexsort((piece, ids.fill_null(0).to_numpy(), -length))
        length = length[order]
        bins, offsets, final = best_fit(length, capacities, overhead, span)
        content = np.bincount(bins, length, len(final)).astype(np.int64)
        first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        columns = {
            "doc_id": ids.take(pa.array(order)),
            "piece": piece[order],
            "piece_start": piece[order] * largest,
            "piece_tokens": length,
            "bin_id": bins + first,
            "bin_offset": offsets,
            "bin_tokens": content[bins],
            "bin_capacity": final[bins],
        }
        out = pa.table({k: v if isinstance(v, pa.ChunkedArray | pa.Array) else pa.array(v, pa.int64()) for k, v in columns.items()})
        yield from out.to_batches(max_chunksize=20_000)

    rows = lengths.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("n_tokens").cast("long").alias("n_tokens"))
    names = ["doc_id", "piece", "piece_start", "piece_tokens", "bin_id", "bin_offset", "bin_tokens", "bin_capacity"]
    return rows.where("n_tokens > 0").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def document_lengths(docs: DataFrame) -> DataFrame:
    """Words of the whole text and one end token; a null text has the end only."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    return docs.select("doc_id", (words + 1).cast("long").alias("n_tokens"))


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    return pack(document_lengths(docs), **options)
