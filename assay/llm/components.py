"""Connected components of a link table, without ever holding it in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.workspace import new_folder


#: Tasks that share the links of a hot node.
SALTS = 16


def _with_least(edges: DataFrame) -> DataFrame:
    """``edges`` with the ``least`` neighbour of ``u``. A node's links are dealt over ``SALTS`` tasks:
    its minimum, one row, is sent to each of them."""
    salts = F.array(*map(F.lit, range(SALTS)))
    least = edges.groupBy("u").agg(F.min("v").alias("least")).withColumn("salt", F.explode(salts))
    dealt = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    # Merged, not broadcast: a table of all linked nodes has no bound.
    return dealt.join(least.hint("merge"), ["u", "salt"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        _with_least(both)
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.least("u", "least").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    return _with_least(edges).select(
        F.when(F.col("v") == F.col("least"), F.col("u")).otherwise(F.col("v")).alias("u"),
        F.col("least").alias("v"),
    ).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked with, for every node that is not a root.

    ``edges`` holds ``u`` and ``v`` in any order, repeats and loops allowed. Alternating stars halve
    the distance to the root, so rounds grow with the logarithm of the longest chain. Each round is
    written to the shared folder: the lineage is cut there and a lost executor costs one round at
    most. Minima are taken in each task before the shuffle.
    """
    spark = edges.sparkSession
    base = new_folder(spark)
    state, last = (
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        None,
    )
    step = 0
    while True:
        path = f"{base}/round={step}"
        state.write.parquet(path)
        state = spark.read.parquet(path)
        seen = state.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if seen == last or not seen[0]:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last, step = seen, step + 1
        state = _small_star(_large_star(state))
