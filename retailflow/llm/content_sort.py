"""Exact de-duplication by sorting contents.

Texts are lower-cased in A-Z only, range-partitioned by sampled splitters over (first
bytes, digest, id) and sorted by Spark's external sort, which puts equal texts next to each
other. Each partition is then streamed once and neighbours are compared in full.

The id is part of the splitter key, so copies of one text may fill many partitions: no task
holds a group. A run that touches the edge of its partition is completed from at most two
rows per partition.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.shared import numbered, one_of_each, shared_table

PREFIX_BYTES = 24
_NO_ID = np.iinfo(np.int64).min


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            bodies = pc.ascii_lower(pc.fill_null(part.column(1), ""))
            raw = [b.encode() for b in bodies.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    bodies.cast(pa.string()),
                    pa.array([b[:PREFIX_BYTES] for b in raw], pa.binary()),
                    pa.array([hashlib.sha256(b).digest() for b in raw], pa.binary()),
                ],
                ["id", "body", "prefix", "digest"],
            )


def _marker(keep_last: bool):
    """Turn a sorted partition into rows that know their run; holds the ids of one run only."""

    def emit(ids, digests, sizes, edge):
        """ids: of whole runs, one after another; digests, sizes and edge: one per run."""
        ends = np.cumsum(sizes)
        starts = ends - sizes
        stays = np.zeros(len(ids), bool)
        stays[ends - 1 if keep_last else starts] = True
        keep = ids[ends - 1] if keep_last else ids[starts]
        each = np.repeat(np.arange(len(sizes)), sizes)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, mask=ids == _NO_ID),
                pa.array(digests, pa.binary()).take(pa.array(each)),
                pa.array(keep[each], mask=keep[each] == _NO_ID),
                pa.array(sizes[each]),
                pa.array(np.asarray(edge)[each]),
                pa.array(stays),
            ],
            ["id", "digest", "keep_id", "group_size", "edge", "stays"],
        )

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the ids of the run that is still open
        body = digest = None
        first = True
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = pc.fill_null(batch.column(0), int(_NO_ID)).to_numpy(zero_copy_only=False)
            bodies, digests = batch.column(1), batch.column(2)
            new = np.ones(len(ids), bool)
            new[0] = digest != digests[0].as_py() or body != bodies[0].as_py()
            if len(ids) > 1:
                same = pc.and_(
                    pc.equal(digests.slice(1), digests.slice(0, len(ids) - 1)),
                    pc.equal(bodies.slice(1), bodies.slice(0, len(ids) - 1)),
                )
                new[1:] = ~same.to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(new)
            if len(starts):
                if body is not None:
                    whole = np.concatenate([*held, ids[: starts[0]]])
                    yield emit(whole, [digest], np.array([len(whole)]), [first])
                    first = False
                if len(starts) > 1:
                    sizes = np.diff(starts)
                    edge = np.zeros(len(sizes), bool)
                    edge[0], first = first, False
                    names = digests.take(pa.array(starts[:-1])).to_pylist()
                    yield emit(ids[starts[0] : starts[-1]], names, sizes, edge)
                held = [ids[starts[-1] :]]
            else:
                held.append(ids)
            body, digest = bodies[-1].as_py(), digests[-1].as_py()
        if body is not None:
            whole = np.concatenate(held)
            yield emit(whole, [digest], np.array([len(whole)]), [True])

    return mark


def content_sort(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """One row per row of `docs`: id, digest (SHA-256), keep_id, group_size, kept.

    `keep` is 'smallest' or 'largest' and names the id that stays in a group of equal texts.
    A null text counts as empty, a null id as the smallest. Of repeated rows with the id that
    stays, one is kept. Ids are whole numbers. Other columns are ignored; an empty table
    gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(keep)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.mapInArrow(_normalised, "id long, body string, prefix binary, digest binary")
    key = ["prefix", "digest", "id"]
    runs = (
        rows.repartitionByRange(*key)
        .sortWithinPartitions(*key)
        .select("id", "body", "digest")
        .mapInArrow(
            _marker(keep == "largest"),
            "id long, digest binary, keep_id long, group_size long, edge boolean, stays boolean",
        )
    )
    runs = shared_table(runs, "content_sort_runs")
    # The smallest struct has a null id if there is one; max() alone passes nulls over.
    best = F.max("keep_id") if keep == "largest" else F.min(F.struct("keep_id"))["keep_id"]
    edges = (
        runs.where("edge AND stays")
        .groupBy("digest")
        .agg(best.alias("whole_keep"), F.sum("group_size").alias("whole_size"))
    )
    # At most two runs of a partition touch its edges, so this holds two rows per partition.
    joined = runs.join(F.broadcast(edges), "digest", "left")
    keep_id = F.when(F.col("edge"), F.col("whole_keep")).otherwise(F.col("keep_id"))
    return joined.select(
        "id",
        F.lower(F.hex("digest")).alias("digest"),
        keep_id.alias("keep_id"),
        F.when(F.col("edge"), F.col("whole_size")).otherwise(F.col("group_size")).alias("group_size"),
        (F.col("stays") & F.col("id").eqNullSafe(keep_id)).alias("kept"),
    )


def drop_exact_copies(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """One row of each group of equal texts, with its columns: that with the smallest (largest) doc_id.

    Rows are told apart by a number, so ids may repeat or be null; a null id counts as the smallest,
    and of rows with one id any one stays. A null text equals an empty one. Very long texts
    are compared whole; other columns are kept, whatever their names. No rows give no rows.
    """
    rows, number = numbered(docs, "content_sort_rows")
    marks = shared_table(content_sort(rows, id_col=number, keep=keep).where("group_size > 1"), "content_sort_groups")
    return one_of_each(rows, number, marks.select(F.col("id").alias("row"), F.col("keep_id").alias("group")), keep)
