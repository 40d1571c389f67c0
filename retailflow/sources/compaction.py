"""Many small Parquet files into few."""

import uuid
from math import ceil

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.constants import COMPACTED_BYTES


PART = "part-of-run-"


def _bytes_below(spark: SparkSession, path: str) -> int:
    # The file source lists path and length; `content` is never read.
    files = spark.read.format("binaryFile").load(path)
    return files.agg(F.sum("length")).first()[0] or 0


def compact(
    spark: SparkSession,
    src: str,
    dst: str,
    files: int | None = None,
    target_bytes: int = COMPACTED_BYTES,
) -> None:
    """Rewrite the Parquet folder `src` into `dst`, which is replaced.

    The number of files follows the size of the input, and each task joins
    neighbouring small files without a shuffle. With `files`, rows are dealt out
    evenly to that many files instead, so that many tasks write everything.
    The root folder is read, so leftovers of failed stream batches, which the
    sink's log does not list, stay out.

    The result is written beside `dst` and takes its place only when it is
    complete; until then `dst` is untouched.
    """
    a, b = (f"{resolved(spark, p)}/" for p in (src, dst))
    if a.startswith(b) or b.startswith(a):
        raise ValueError(f"compaction of {src} would overwrite its own input at {dst}")
    try:
        events = spark.read.parquet(src)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"compaction input {src} does not exist") from e
        raise
    if files is None:
        out = events.coalesce(max(1, ceil(_bytes_below(spark, src) / target_bytes)))
    else:
        out = events.repartition(files)
    aside = f"{dst.rstrip('/')}-{uuid.uuid4().hex}"
    out.write.parquet(aside)
    _replace(spark, aside, dst)


def _parts(spark: SparkSession, dst: str) -> list[str]:
    """Names of the parts that runs of `compact_new` have put in place."""
    folder, fs = hadoop_path(spark, dst)
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(n for n in names if n.startswith(PART))


def compact_new(spark: SparkSession, src: str, dst: str, target_bytes: int = COMPACTED_BYTES) -> int:
    """Add what a stream stored since the last such run to `dst`; returns the number of files read.

    The sink's log says which files count, so leftovers of failed batches stay out, and files
    compacted before are not opened again. Each run adds one folder, moved into place
    in one step after its list of files is stored in `<dst>-sources`; a list without its folder
    counts for nothing. So a run that stops leaves nothing behind that is read, and the
    next one takes its files. Read the result with `read_compacted`. One run at a time.
    """
    parts, lists = _parts(spark, dst), f"{dst.rstrip('/')}-sources"
    stored = spark.createDataFrame([(f,) for f in spark.read.parquet(src).inputFiles()], "path string")
    if parts:
        stored = stored.join(spark.read.parquet(*(f"{lists}/{p}" for p in parts)), "path", "left_anti")
    files = sorted(r.path for r in stored.collect())  # as many as a read's file list has on the driver
    if not files:
        return 0
    part = f"{PART}{len(parts):08d}"
    listed = spark.createDataFrame([(f,) for f in files], "path string")
    listed.coalesce(1).write.mode("overwrite").parquet(f"{lists}/{part}")
    size = spark.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0]
    aside = f"{dst.rstrip('/')}-{uuid.uuid4().hex}"
    spark.read.parquet(*files).coalesce(max(1, ceil(size / target_bytes))).write.parquet(aside)
    new, fs = hadoop_path(spark, aside)
    place, _ = hadoop_path(spark, f"{dst.rstrip('/')}/{part}")
    fs.mkdirs(place.getParent())
    if fs.exists(place) or not fs.rename(new, place):
        raise OSError(f"{aside} is complete but could not be moved to {place.toString()}")
    return len(files)


def read_compacted(spark: SparkSession, dst: str) -> DataFrame:
    """All parts that `compact_new` has added."""
    return spark.read.option("recursiveFileLookup", True).parquet(dst)


def hadoop_path(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def resolved(spark: SparkSession, path: str) -> str:
    """One name for each folder, however it is written: scheme, authority, dots, links.

    What does not exist yet is resolved as far as it does.
    """
    hadoop, fs = hadoop_path(spark, path)
    if fs.getUri().getScheme() == "file":
        return "file:" + spark._jvm.java.io.File(hadoop.toUri().getPath()).getCanonicalPath()
    full = spark._jvm.org.apache.hadoop.fs.Path(fs.makeQualified(hadoop).toUri().normalize())
    missing = []
    while not fs.exists(full) and full.getParent() is not None:
        missing.insert(0, full.getName())
        full = full.getParent()
    return "/".join([fs.resolvePath(full).toString().rstrip("/"), *missing])


def _replace(spark: SparkSession, aside: str, dst: str) -> None:
    """Put the folder `aside` in the place of `dst`."""
    new, fs = hadoop_path(spark, aside)
    place, _ = hadoop_path(spark, dst)
    if not fs.exists(place):
        moved = fs.rename(new, place)
    else:
        old, _ = hadoop_path(spark, f"{aside}-old")
        moved = fs.rename(place, old) and fs.rename(new, place)
        if moved:
            fs.delete(old, True)
    if not moved:
        raise OSError(f"{aside} is complete but could not be moved to {dst}")
