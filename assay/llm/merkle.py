"""Merkle manifest of a dataset, by nested intervals of leaf ranks.

The rows of each tree are ranked; a leaf covers the interval of its own rank, and a node the intervals
of its children. All nodes of a level have the same width, so the parent of an interval is found in a
bucket of its level: its start divided by the parent's width. A join on buckets attaches ancestors
from the root down, and the siblings of a child are the parent's interval without the child's.

Each level has a sixteenth of the nodes below it, so all joins but the last are small. No tree and no
level lies in one task: ranks come from a range sort, nodes are grouped by the sixteen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.ranked import pieces, stored_in_order
from assay.workspace import new_folder

FANOUT = 16


def digest(*texts: Column) -> Column:
    """Lowercase hex SHA-256 of the texts in a row."""
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def field_text(value: Column) -> Column:
    """A field in a leaf: its UTF-8 bytes' count, a colon and the value; a null is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*fields: Column) -> Column:
    return digest(*map(field_text, fields))


def _width(level: int, fanout: int) -> int:
    return fanout**level


def _parents(nodes: DataFrame, level: int, fanout: int) -> DataFrame:
    """The nodes of ``level`` over those of the level below, in trees that have several of these."""
    width = _width(level, fanout)
    start = (F.floor(F.col("lo") / width) * width).cast("bigint")
    grouped = (
        nodes.filter(F.col("n") > _width(level - 1, fanout))
        .groupBy("tree", "n", start.alias("start"))
        .agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"))
    )
    return grouped.select(
        "tree",
        "n",
        F.col("start").alias("lo"),
        F.least(F.col("start") + width, F.col("n")).alias("hi"),
        digest(F.array_join("children.digest", "")).alias("digest"),
        "children",
    )


def _grown(leaves: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels above ``leaves``, each stored, and the top of each tree with its digest."""
    spark, folder = leaves.sparkSession, new_folder(leaves.sparkSession)
    largest = leaves.agg(F.max("n")).first()[0] or 0
    levels, below = [], leaves.select("tree", "lo", "hi", "n", "digest")
    tops = below.filter("n = 1").select("tree", "digest")
    while largest > _width(len(levels), fanout):
        level = len(levels) + 1
        _parents(below, level, fanout).write.parquet(f"{folder}/level={level}")
        nodes = spark.read.parquet(f"{folder}/level={level}")
        levels.append(nodes)
        tops = tops.unionByName(
            nodes.filter(F.col("n") <= _width(level, fanout)).select("tree", "digest")
        )
        below = nodes.select("tree", "lo", "hi", "n", "digest")
    return levels, tops


def _siblings(keep: Column) -> Column:
    return F.array_join(F.transform(keep, lambda child: child["digest"]), "")


def _with_ancestors(nodes: DataFrame, level: int, above: DataFrame, tops: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` of ``level`` with ``path``, the siblings at each step up, and what ``tops`` holds.

    ``above`` has the level above with the same columns, ``tops`` a path for the top of each tree.
    """
    carried = [name for name in tops.columns if name not in ("tree", "path")]
    width = _width(level, fanout)
    at_top = nodes.filter(F.col("n") <= width).join(tops, "tree")
    if above is None:
        return at_top
    inner = nodes.filter(F.col("n") > width).withColumn(
        "bucket", F.floor(F.col("lo") / (width * fanout)).cast("bigint")
    )
    parents = above.select(
        "tree",
        F.floor(F.col("lo") / (width * fanout)).cast("bigint").alias("bucket"),
        F.col("lo").alias("from"),
        F.col("hi").alias("to"),
        F.col("children").alias("run"),
        F.col("path").alias("path_above"),
        *carried,
    )
    joined = inner.join(parents, ["tree", "bucket"]).filter("from <= lo AND hi <= to")
    left = F.filter("run", lambda child: child["hi"] <= F.col("lo"))
    right = F.filter("run", lambda child: child["lo"] >= F.col("hi"))
    step = F.struct(_siblings(left).alias("left"), _siblings(right).alias("right"))
    placed = joined.withColumn("path", F.concat(F.array(step), "path_above"))
    return at_top.unionByName(placed.select(*at_top.columns))


def _paths(levels: list[DataFrame], leaves: DataFrame, tops: DataFrame, fanout: int) -> DataFrame:
    """``leaves`` with the way up to their tree's top and on."""
    above = None
    for level in range(len(levels), 0, -1):
        above = _with_ancestors(levels[level - 1], level, above, tops, fanout)
    return _with_ancestors(leaves, 0, above, tops, fanout)


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows``, which have ``tree``, with their interval ``lo`` to ``hi`` and the tree's ``n``."""
    stored = stored_in_order(rows, ["tree", *order])
    at = F.col("before") + F.col("slot") - F.col("first")
    found = stored.join(pieces(stored, "tree"), ["tree", "part"]).select(
        *rows.columns, at.alias("lo"), (at + 1).alias("hi"), F.col("total").alias("n")
    )
    path = f"{new_folder(rows.sparkSession)}/leaves"
    found.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def manifest(
    docs: DataFrame, leaf: Column, tree: Column, order: Sequence[Column], *, fanout: int = FANOUT
) -> DataFrame:
    """``row`` (each row of ``docs`` as a struct), ``leaf``, ``subroot``, ``root`` and ``path``.

    The leaves of each ``tree`` stand in ``order``, nulls first; rows that tie by their digest, equal
    rows in any order, which changes no digest. Every ``fanout`` nodes in a row have a parent, the last
    run of a level may be shorter, and a tree's only node is its subroot. Subroots stand in the order
    of their tree's UTF-8 bytes, null first, and give the root in the same way. ``path`` holds, level by
    level up to the root, the digests of the siblings to the left and to the right, each in a row.

    A null tree is a tree of its own, other nulls are as :func:`leaf_digest` has them. Columns of any
    name pass through in ``row``. An empty table gives no rows.
    """
    if fanout < 2:
        raise ValueError("a node needs two children or more")
    rows = docs.select(
        F.struct("*").alias("row"),
        leaf.alias("digest"),
        F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit("")).alias("tree"),
        *[column.alias(f"order_{i}") for i, column in enumerate(order)],
    )
    leaves = _placed(rows, [*[f"order_{i}" for i in range(len(order))], "digest"])
    levels, subroots = _grown(leaves, fanout)

    crowns = _placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"])
    upper_levels, roots = _grown(crowns, fanout)
    no_path = F.expr("CAST(array() AS array<struct<left: string, right: string>>)")
    at_root = roots.select("tree", F.col("digest").alias("root"), no_path.alias("path"))
    subroot_paths = _paths(upper_levels, crowns, at_root, fanout).select(
        F.col("name").alias("tree"), F.col("digest").alias("subroot"), "root", "path"
    )
    found = _paths(levels, leaves, subroot_paths, fanout)
    return found.select("row", F.col("digest").alias("leaf"), "subroot", "root", "path")


def proof_digest(path: Column) -> Column:
    """The digest of all siblings on a path, from the leaf up, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(
        path, leaf, lambda node, step: digest(step["left"], node, step["right"])
    )
