"""CSV landing zone: `<base>/date(YYYY-MM-DD)/<entity>..._<HH>.csv`.

Names come from the header of each file and every column is text: nothing is
inferred from the values, so no extra pass over the files is made. Files may
order their columns differently or lack optional ones: those with the same
header are read together, and a column that a file lacks is NULL in its rows.
"""

from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.constants import LANDING_FILES

LANDING_FILE = "landing_file"
# The last such part of a path; a folder above may have a name like it.
HOUR_IN_NAME = r".*_(\d{2})\.csv"


def _headers(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """Header lines with the files that begin with them; empty files have none.

    One job finds the first line of every file, whatever their number: only lines of a
    file's first split are compared, each task sends one line per file on, and the files are
    grouped by that line. Spark lists the files on the driver for any read; what
    comes back here is that list once more, by header.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    begins = (F.col("_metadata.file_block_start") == 0) & (F.trim("value") != "")
    lines = lines.where(begins).select(
        F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("at")
    )
    files = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    groups = files.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return [(r.header, r.files) for r in groups.orderBy("header").collect()]


def _read_csv(spark: SparkSession, path: str, with_file: bool = False) -> DataFrame:
    groups = _headers(spark, path)
    reader = spark.read.option("header", True)
    if not groups:
        return reader.csv(path)
    parts = []
    for _, files in groups:
        # Spark's own reading of a header, from one file of those that share it.
        schema = T.StructType([T.StructField(n, T.StringType()) for n in reader.csv(files[0]).columns])
        rows = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
        one_kind = rows.option("recursiveFileLookup", True).csv(path if len(groups) == 1 else files)
        if with_file:
            one_kind = one_kind.withColumn(LANDING_FILE, F.col("_metadata.file_path"))
        parts.append(one_kind)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def landing_day(base: str, day: date | str) -> str:
    return f"{base.rstrip('/')}/date({day})"


def read_landing(
    spark: SparkSession,
    base: str,
    kind: str | None,
    day: date | str,
    hour: int | str | None = None,
) -> DataFrame:
    """One day of an entity, or one hour of that day; the whole folder if `kind` is None.

    Spark reports a day or an hour without files as PATH_NOT_FOUND, with the path.
    """
    folder = landing_day(base, day)
    if kind is None:
        if hour is not None:
            raise ValueError("an hour is read of one entity")
        return _read_csv(spark, folder)
    ending = "*.csv" if hour is None else f"_{int(hour):02d}.csv"
    return _read_csv(spark, f"{folder}/{LANDING_FILES[kind]}{ending}".replace("**", "*"))


def read_entity(
    spark: SparkSession, base: str, prefix: str, with_file: bool = False
) -> DataFrame:
    """The files of one entity from a folder where several are mixed.

    The name prefix chooses the entity while the folder is listed, so other
    files are not opened. `with_file` adds the file of each row as a column.
    """
    if prefix not in LANDING_FILES:
        raise ValueError(f"no entity {prefix!r}; known: {', '.join(LANDING_FILES)}")
    return _read_csv(spark, f"{base.rstrip('/')}/{prefix}*", with_file)


def landing_inventory(
    spark: SparkSession, base: str, kind: str, day: date | str, hours: Iterable[int]
) -> DataFrame:
    """hour, state, files, bytes for each hour asked for, from one listing of the day.

    `state` is 'found', 'empty' (files, but not a byte in them) or 'absent' (no file, or no
    folder of that day): what would stop a load, or load nothing, can be seen before it.
    """
    wanted = spark.createDataFrame([(f"{h:02d}",) for h in sorted(set(map(int, hours)))], "hour string")
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        # The file source lists path and length; `content` is never read.
        listed = files.load(f"{landing_day(base, day)}/{LANDING_FILES[kind]}*.csv".replace("**", "*"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        sizes = spark.createDataFrame([], "hour string, files long, bytes long")
    else:
        hour = F.regexp_extract("path", HOUR_IN_NAME, 1).alias("hour")
        # A scan passes over files without a byte; the list of files behind it has them.
        every = spark.createDataFrame([(f,) for f in listed.inputFiles()], "path string")
        counts = every.groupBy(hour).agg(F.count("*").alias("files"))
        sizes = counts.join(listed.groupBy(hour).agg(F.sum("length").alias("bytes")), "hour", "left")
    state = F.when(F.col("bytes") > 0, "found").when(F.col("files") > 0, "empty").otherwise("absent")
    none = F.lit(0).cast("long")
    return wanted.join(sizes, "hour", "left").select(
        "hour", state.alias("state"), F.coalesce("files", none).alias("files"), F.coalesce("bytes", none).alias("bytes")
    )


def landing_hours(df: DataFrame) -> DataFrame:
    """Rows by the hour in the name of the file they came from (`read_entity` with_file)."""
    per_file = df.groupBy(LANDING_FILE).agg(F.count("*").alias("rows"))
    hour = F.regexp_extract(LANDING_FILE, HOUR_IN_NAME, 1)
    return per_file.groupBy(hour.alias("hour")).agg(F.sum("rows").alias("rows"))
