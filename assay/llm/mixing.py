"""Mixing of sources to target weights by weighted fair queueing.

Each source queues its documents in a repeatable shuffled order. A document's virtual finish time is
its source's words up to and including it, divided by the source's target; the second lap of a queue
goes on where the first ended. Sorted by finish time, copies are taken up to the total budget: at any
point of that order the sources have been served in proportion to their targets.

Both orders are range sorts over all partitions, and both running sums are in two levels: totals of
the pieces that each partition holds are summed first, then rows inside their piece. So no source, no
id and no finish time lies in one task. Only numbers are sorted; the rows themselves are stored once,
under a number of their own, and joined with what the mix takes of each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.ranked import stored_in_order
from assay.llm.text import word_count
from assay.workspace import new_folder

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_LAPS = 2

_KEY_BITS = 60


def shuffle_key(doc_id: Column) -> Column:
    """60 bits of the md5 of the id's text: the order in which a source queues its documents."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, _KEY_BITS // 4), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, laps: int) -> DataFrame:
    """``source_size``, ``weight`` and ``target`` of each ``source_key``; one row a source. Sources are
    ranked in one task, which sorts three numbers and a name of each: ten million are below 1 GB.

    Sources weigh ``weights`` in turn, by code point, the null source (an empty key) last. Water
    filling: with the sources sorted by cap / weight, the level for a source shares what the caps
    before it leave among the weights from it on. That rises while caps bind and falls once a cap is
    taken off that does not bind, so the common level is the largest.
    """
    by_name = Window.orderBy(F.col("source_key") == "", "source_key")
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    ranked = sizes.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    )
    cap = F.col("source_size") * laps
    by_ratio = Window.orderBy(cap / F.col("weight"), F.col("source_key") == "", "source_key")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (
        F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    ) / F.sum("weight").over(onward)
    levelled = ranked.withColumn("own_level", level).withColumn(
        "level", F.max("own_level").over(whole)
    )
    return levelled.select(
        "source_key",
        "source_size",
        "weight",
        F.least(cap.cast("double"), F.col("level") * F.col("weight")).alias("target"),
    )


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = f"{new_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _running(ordered: DataFrame, *group: str) -> DataFrame:
    """``upto``: the sum of ``size`` up to each row of a table stored in order, within its group."""
    totals = ordered.groupBy(*group, "part").agg(F.sum("size").alias("size"))
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*group, "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy(*group, "part").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    return (
        ordered.join(starts, [*group, "part"])
        .withColumn("upto", F.col("before") + F.sum("size").over(inside))
        .drop("before", "part", "slot")
    )


def mix(
    docs: DataFrame,
    *,
    size: str | None = None,
    tie: str | None = None,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    laps: int = MOST_LAPS,
) -> DataFrame:
    """``row`` (the document as a struct), ``size``, ``source_size``, ``target`` and ``copies``.

    ``docs`` has ``doc_id``, ``source`` and ``text``, or a column named by ``size`` with the number of
    words; any further columns travel inside ``row`` and cannot clash. Every row of ``docs`` comes back
    once, with the number of copies that the mix takes, 0 to ``laps``.

    A null source is a source of its own. A null or empty text has size 0, is never taken and does
    not delay others. Rows that share an id, or have none, queue one by one, in the order of the column
    named by ``tie`` (of the text's md5 if none is); rows that are equal in that as well, in any order.
    So each is taken or left on its own, and reruns agree on all but which of some equal rows it was.
    An empty table gives no rows.
    """
    words = F.col(size).cast("bigint") if size else word_count(F.col("text"))
    if tie is not None:
        told_apart = F.col(tie).cast("string")
    elif "text" in docs.columns:
        told_apart = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    else:
        told_apart = F.lit("")
    rows = _stored(
        docs.select(
            F.struct("*").alias("row"),
            F.col("doc_id").alias("id"),
            F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("source_key"),
            F.coalesce(words, F.lit(0)).alias("size"),
            shuffle_key(F.col("doc_id")).alias("key"),
            F.coalesce(told_apart, F.lit("")).alias("tie"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "rows",
    )
    order = ["source_key", "key", "id", "tie", "uid"]
    queued = _running(stored_in_order(rows.drop("row"), order), "source_key").withColumnRenamed("upto", "finish")
    sizes = rows.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    targets = _stored(source_targets(sizes, weights, share, laps), "targets").drop("weight")
    queue = _stored(queued.join(targets, "source_key"), "queue")

    lapped = queue.filter("size > 0").withColumn("lap", F.explode(F.array(*map(F.lit, range(laps)))))
    time = F.try_divide(F.col("finish") + F.col("lap") * F.col("source_size"), F.col("target"))
    copies = lapped.withColumn("time", time).select("time", *order, "lap", "size")
    served = _running(stored_in_order(copies, ["time", *order, "lap"]))
    budget = targets.agg(F.sum("target").alias("budget")).scalar()
    taken = served.filter(F.col("upto") <= budget).groupBy("uid").agg(F.count(F.lit(1)).alias("copies"))
    counted = queue.select("uid", "source_size", "target").join(taken, "uid", "left")
    return rows.select("row", "size", "uid").join(counted, "uid").select(
        "row",
        "size",
        "source_size",
        F.col("target").cast("double").alias("target"),
        F.coalesce("copies", F.lit(0)).cast("int").alias("copies"),
    )


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: each taken document once or more often, with the columns of ``docs``. Nulls, ties
    and empty tables are as in :func:`mix`; texts without a word are in no mix."""
    chosen = mix(docs, **settings).filter(F.col("copies") > 0)
    return chosen.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
