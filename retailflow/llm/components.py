"""Connected components of a table of links, by rounds of Spark jobs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.shared import shared_table


def components(links: DataFrame) -> DataFrame:
    """links: (a, b) long. Returns (node, root): the smallest node of each component.

    Each round hangs larger neighbours on the smallest one, then shortens the trees (large star,
    small star), so paths halve and the rounds grow with the logarithm of the longest path.
    Sums and minima combine before their shuffle; a node with very many links is split by
    Spark's skew handling in the join. Every round is a written table.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = shared_table(edges, "links_0")
    done, turn = False, 0
    while not done:
        turn += 1
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = shared_table(large, f"links_large_{turn}")
        parents = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(parents, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                    F.struct("a", F.col("m").alias("b")),
                )
            ).alias("e")
        )
        small = small.select("e.a", "e.b").where("a <> b").distinct()
        new = shared_table(small, f"links_{turn}")
        done = new.exceptAll(edges).isEmpty() and edges.exceptAll(new).isEmpty()
        edges = new
    # Every node but the roots now has one link, to its root.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
