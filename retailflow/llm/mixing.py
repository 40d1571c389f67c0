"""Mix sources to target weights by capped water-filling, with seeded repetitions.

A source gets its share of the words wanted by its weight, but no more than `max_epochs`
times its size; what it can't take goes to the others by weight until none is above its cap.
A source's rate is then whole passes over it plus a seeded part of one more pass.

Everything a document needs is its source's row: the whole passes, and a cut in the seeded
order below which documents are taken once more. So the texts are never shuffled. Cuts come
from sums per source and hash bucket; only the one bucket of a source that holds its cut is
ordered document by document.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailflow.llm.shared import WORD, shared_table

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_EPOCHS = 2
SEED = 17
BUCKET_DIGITS = 3  # of the hexadecimal order key: 4,096 buckets a source


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    place = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return docs.withColumn("mix_size", size).withColumn("mix_place", place)


def water_fill(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """sizes: one row (source, source_size) per source; adds weight and target.

    Weights repeat over the sources in code-point order, null last. With the sources in order
    of cap per weight, those that stop at their cap come first, so one running sum finds them
    and the water level. All sums are whole numbers; only the target is a double.
    """
    everything = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    table = sizes.select(
        "source",
        "source_size",
        weight.cast("long").alias("weight"),
        (F.col("source_size") * max_epochs).alias("cap"),
        (F.sum("source_size").over(everything) * share_percent).alias("wanted"),  # in hundredths
    )
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    capped = F.col("cap") * 100 * after <= F.col("weight") * (F.col("wanted") - before * 100)
    table = table.withColumn("capped", capped)
    taken = F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything)
    rest = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything)
    level = F.col("weight") * (F.col("wanted") - taken * 100) / (rest * 100)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level)
    return table.select("source", "source_size", "weight", target.alias("target"))


def source_plan(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """One row per source: source_size, target, passes (whole), cut (null: no part of a pass)."""
    narrow = _sized(docs, seed).select("source", "mix_size", "mix_place")
    narrow = shared_table(narrow, "mixing_sizes")
    bucket = F.substring("mix_place", 1, BUCKET_DIGITS)
    buckets = narrow.groupBy("source", bucket.alias("bucket")).agg(F.sum("mix_size").alias("words"))
    sizes = buckets.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = water_fill(sizes, **options)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("passes", passes.cast("long")).withColumn(
        "part", F.col("target") - F.col("passes") * F.col("source_size")
    )
    plan = shared_table(plan.select("source", "source_size", "weight", "target", "passes", "part"), "mixing_plan")

    by_source = Window.partitionBy("source").orderBy("bucket")
    running = buckets.withColumn(
        "before", F.sum("words").over(by_source.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")
    )
    parts = plan.where("part > 0").select(F.col("source").alias("p_source"), "part")
    same = F.col("source").eqNullSafe(F.col("p_source"))
    # The bucket in which the part of a pass ends; all documents of earlier buckets are in.
    last = (
        running.join(parts, same)
        .where((F.col("before") < F.col("part")) & (F.col("part") <= F.col("before") + F.col("words")))
        .select("p_source", F.col("bucket").alias("p_bucket"), "before", "part")
    )
    last = shared_table(last, "mixing_last_buckets")
    inside = narrow.join(last, same & (bucket == F.col("p_bucket")))
    places = inside.groupBy("p_source", "p_bucket", "before", "part", "mix_place").agg(F.sum("mix_size").alias("words"))
    order = Window.partitionBy("p_source").orderBy("mix_place").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("before") + F.sum("words").over(order) - F.col("words") / 2
    ends = (
        places.withColumn("middle", middle)
        .groupBy("p_source", "p_bucket")
        # A document is in if the part reaches its middle; none: the cut lies before the bucket.
        .agg(F.max(F.when(F.col("middle") < F.col("part"), F.col("mix_place"))).alias("inside"))
        .select("p_source", F.coalesce("inside", "p_bucket").alias("cut"))
    )
    plan = plan.join(ends, same, "left").select("source", "source_size", "weight", "target", "passes", "cut")
    return shared_table(plan, "mixing_sources")


def mix(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """`docs` with mix_size (words), mix_source_size, mix_target and mix_copies (0 to max_epochs).

    Needs doc_id, text, source; other columns pass through, columns of these four names are
    replaced. A null text has no words, null sources form one source (the last), a null id
    has the place of an empty one. Rows with the same id are taken alike. An empty table gives
    an empty result. The words taken of a source differ from its target by half a document
    at most (of the rows of one id together).
    """
    plan = source_plan(docs, seed, **options).select(
        F.col("source").alias("mix_source"),
        F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
        "passes",
        "cut",
    )
    new = ["mix_size", "mix_source_size", "mix_target", "mix_copies"]
    # The documents' own columns travel as one, so none of their names meets one used here.
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in new]).alias("_document")
    sized = _sized(docs.select(own, "doc_id", "text", "source"), seed)
    # One small row per source: Spark broadcasts it by its size or splits a hot source.
    joined = sized.join(plan, sized["source"].eqNullSafe(plan["mix_source"]))
    once_more = F.coalesce(F.col("mix_place") <= F.col("cut"), F.lit(False)).cast("long")
    return joined.withColumn("mix_copies", F.col("passes") + once_more).select("_document.*", *new)


def mixed_documents(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The mixture itself: each row as often as it is taken, with its own columns, whatever their names.

    Nulls, repeated rows and empty tables as in `mix`; documents without words are not taken.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole")
    copies = mix(docs.select(own, "doc_id", "text", "source"), seed, **options).where("mix_copies > 0")
    times = F.explode(F.sequence(F.lit(1), F.col("mix_copies")))
    return copies.withColumn("mix_copies", times).select("_whole.*")
