"""Source divergence audit: how far the word use of each source lies from its peers and its language.

Documents are tokenised and counted per map task; one shuffle by (lang, term) brings the counts
of a term together. All pairs of sources of a language are then compared by Gustavson's row
accumulation: a task holds the term-major index of a block of terms, each group scatters its
terms through it into one dense accumulator over its peers, and one row per pair of groups
leaves the task, never one per pair of postings. Terms a group lacks have the smoothed value
of a zero count there. The accumulator starts with that baseline and is corrected
where both groups hold the term.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailflow.llm.shared import shared_table
from retailflow.llm.terms import LETTERS, term_lists

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
HELD_COUNTS = 300_000  # counts of a map task before they are sent on
BLOCK_ROWS = 500_000  # index entries of a block of terms
BLOCK_WORK = 500_000_000  # index entries times groups of a block
CELL_PAIRS = 4_000_000  # pairs of groups of one task
GATHER = 2_000_000  # index entries scattered at once


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of lang, source, text to counts; a row without a term counts a group's documents."""
    times: dict[tuple[str, str], Counter] = {}
    held: dict[tuple[str, str], Counter] = {}
    docs: Counter = Counter()

    def rows():
        for group, terms in times.items():
            names = list(terms)
            size = len(names) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([group[0]] * size, pa.string()),
                    pa.array([group[1]] * size, pa.string()),
                    pa.array([*names, None], pa.binary()).cast(pa.string()),
                    pa.array([*terms.values(), 0], pa.int64()),
                    pa.array([*(held[group][t] for t in names), docs[group]], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )

    for batch in batches:
        for lang, source, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
            group = lang, source
            if group not in times:
                times[group], held[group] = Counter(), Counter()
            docs[group] += 1
            seen: set[bytes] = set()
            for terms in term_lists(raw, LETTERS):
                times[group].update(terms)
                seen.update(terms)
            held[group].update(seen)
        if sum(map(len, times.values())) > HELD_COUNTS:
            yield from rows()
            times, held, docs = {}, {}, Counter()
    yield from rows()


def apart(p, q):
    """(p - q)^2 / (p + q), rounded down; whole numbers below 2^30, so int64 holds it all."""
    return (p - q) ** 2 // (p + q)


def row_sums(group: int, index: dict, floor: np.ndarray) -> np.ndarray:
    """Sums of `apart` over all terms of a block between `group` and each later group.

    index: term, group and p of each entry, term-major; own: entries by group (group-major
    order and bounds); bounds of terms; terms: how many. floor: each group's p of a zero count.
    """
    many, own, edge = len(floor), index["own"], index["own_edge"]
    mine = own[edge[group] : edge[group + 1]]
    held = np.diff(edge)
    none = apart(floor[group], floor)
    row = (index["terms"] - held[group] - held) * none
    # Terms of this group against zero counts of the others, and the other way about.
    step = max(1, GATHER // max(many, 1))
    for start in range(0, len(mine), step):
        row += apart(index["p"][mine[start : start + step]][:, None], floor).sum(0)
    back = np.concatenate(([0], np.cumsum(apart(index["p"][own], floor[group]))))
    row += back[edge[1:]] - back[edge[:-1]]
    # Terms that both hold: entries of this group's terms, scattered over their groups.
    low, high = index["term_edge"][index["term"][mine]], index["term_edge"][index["term"][mine] + 1]
    total = np.cumsum(high - low)
    start = 0
    while start < len(mine):
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + GATHER, "right")))
        size = (high - low)[start:stop]
        at = np.repeat(low[start:stop] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        peer, q = index["group"][at], index["p"][at]
        p = np.repeat(index["p"][mine[start:stop]], size)
        change = apart(p, q) - apart(p, floor[peer]) - apart(floor[group], q) + none[peer]
        # Whole numbers below 2^53 in all, so doubles add them exactly.
        row += np.bincount(peer, change, many).astype(np.int64)
        start = stop
    return row[group + 1 :]


def _block_pairs(entries: pa.Table, groups: pa.Table) -> pa.Table:
    """Entries (term, source, p) of a block of terms, all groups (source, floor, mine) to pair rows."""
    order = np.argsort(np.array(groups.column("source").to_pylist(), object), kind="stable")
    names = groups.column("source").take(pa.array(order)).combine_chunks()
    floor = groups.column("floor").to_numpy()[order]
    mine = groups.column("mine").to_numpy(zero_copy_only=False)[order]
    place = {s: i for i, s in enumerate(names.to_pylist())}
    group = np.array([place[s] for s in entries.column("source").to_pylist()], np.int64)
    coded = entries.column("term").combine_chunks().dictionary_encode()
    term, terms = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
    by_term = np.lexsort((group, term))
    term, group, p = term[by_term], group[by_term], entries.column("p").to_numpy()[by_term]
    index = {
        "term": term,
        "group": group,
        "p": p,
        "terms": terms,
        "term_edge": np.searchsorted(term, np.arange(terms + 1)),
        "own": np.argsort(group, kind="stable"),
        "own_edge": np.concatenate(([0], np.cumsum(np.bincount(group, minlength=len(floor))))),
    }
    a, b, value = [], [], []
    for g in np.flatnonzero(mine):
        sums = row_sums(int(g), index, floor)
        a.append(np.full(len(sums), g))
        b.append(np.arange(g + 1, len(floor)))
        value.append(sums)
    none = [np.zeros(0, np.int64)]
    a, b, value = (np.concatenate(x or none) for x in (a, b, value))
    lang = groups.column("lang")[0].as_py()
    return pa.table({
        "lang": pa.array([lang] * len(a), pa.string()),
        "a": names.take(pa.array(a)),
        "b": names.take(pa.array(b)),
        "value": pa.array(value, pa.int64()),
    })


def _share(n: str, total: str, terms: str) -> str:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)) in exact decimals."""
    return f"""1 + (cast({n} + 2 as decimal(20, 0)) * cast({SCALE} as decimal(10, 0)))
      div cast({total} + 2 * {terms} as decimal(20, 0))"""


def divergence_audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: each source of a language against its peers and terms.

    Part `pair` has one row per other source of the language, part `term` the `top` terms that
    the source uses more than its language does. Terms are kept if `min_docs` rows of the
    language hold them. Shares are smoothed and scaled whole numbers, so sums are exact.

    A null text, lang or source counts as ''. Repeated rows count as documents of their own,
    ids and other columns are not read, an empty table gives an empty result. Equal values
    rank by the bytes of the item. A language whose terms are all too rare has pairs of value
    0 and no terms; a source alone in its language has no pairs.
    """
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.col("text").cast("binary").alias("text"),
    )
    counts = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    term = Window.partitionBy("lang", "term")
    # One shuffle serves both the sums by source and those by language.
    counts = (
        counts.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .withColumns({
            "lang_n": F.sum("n").over(term),
            "lang_docs": F.sum("docs").over(term),
            "first": F.min("source").over(term) == F.col("source"),
        })
        .where((F.col("lang_docs") >= min_docs) | F.col("term").isNull())
        .select("lang", "term", "source", "n", "lang_n", "first")
    )
    counts = shared_table(counts, "divergence_counts")
    held = F.col("term").isNotNull()
    # One row per language, then one per group; as small as the result has sources.
    groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if(held).alias("held"))
    firsts = counts.groupBy("lang").agg(F.count_if(held & F.col("first")).alias("terms"))
    langs = groups.groupBy("lang").agg(
        F.sum("total").alias("lang_total"), F.sum("held").alias("entries"), F.count("*").alias("groups")
    )
    langs = langs.join(firsts, "lang").withColumns({
        "blocks": F.expr(f"""greatest(1, ceil(entries / {BLOCK_ROWS}),
          ceil(entries * groups / greatest({BLOCK_WORK}, 64.0D * groups * groups)))"""),
        "parts": F.expr(f"greatest(1, ceil(1.0D * groups * groups / {CELL_PAIRS}))"),
    })
    floor = F.expr(f"CASE WHEN terms > 0 THEN {_share('0', 'total', 'terms')} ELSE 0 END")
    groups = groups.join(langs, "lang").withColumn("floor", floor)
    groups = shared_table(groups, "divergence_groups")

    entries = counts.where(held).join(groups.drop("held"), ["lang", "source"]).select(
        "lang", "source", "term", "blocks", "parts",
        F.expr(_share("n", "total", "terms")).alias("p"),
        F.expr(_share("lang_n", "lang_total", "terms")).alias("q"),
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    used_more = (
        entries.where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
        .withColumn("rank", F.row_number().over(by_value))
        .where(F.col("rank") <= top)
    )

    cell = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("cell")
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block")
    left = entries.select("lang", block, "source", "term", "p", cell)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    right = groups.select("lang", "source", "floor", "parts", every)
    right = right.select("lang", "source", "floor", "block", "parts", cell)
    right = right.withColumn("mine", F.pmod(F.xxhash64("source"), F.col("parts")) == F.col("cell"))
    keys = ["lang", "block", "cell"]
    sums = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(_block_pairs, "lang string, a string, b string, value long")
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"))
    )
    both = F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item")),
    )
    pairs = (
        sums.select("lang", "value", F.explode(both).alias("side"))
        .select("lang", "side.source", F.lit("pair").alias("part"), "side.item", "value")
        .withColumn("rank", F.row_number().over(by_value))
    )
    return pairs.unionByName(used_more)
