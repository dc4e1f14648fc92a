"""SimHash near-duplicates through sharded BK-trees.

Fingerprints within three bits of each other agree on one of four 16-bit blocks, and on one of four
12-bit blocks of what is left. Each choice of both blocks names a shard, so a fingerprint goes to 16
small shards, and two that are to be linked meet in at least one. Every shard has a BK-tree: a child
hangs below its parent by their Hamming distance, and a search follows only the edges that differ from
the query's own distance by at most the radius. Trees are not broadcast, as nothing bounds their total
size; the fingerprints travel to the shards instead, which is the same search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.components import components
from assay.workspace import new_folder

SHINGLE = 3
RADIUS = 3

# Bounds of memory, not of results: shingles summed at a time, pairs of query and node per sweep.
_SUMMED = 50_000
_SWEEP = 2_000_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits; a bit is set if it is in more than half of the shingles' hashes. No word: zero."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    if len(tokens) < shingle:
        grams = [b" ".join(tokens)]
    else:
        grams = map(b" ".join, zip(*[tokens[i:] for i in range(shingle)]))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(gram, 42) for gram in grams), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _SUMMED):
        part = hashes[at : at + _SUMMED].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """``id``, the ``tie`` of equal ids (a hash of the text) and the signed 64-bit ``fp`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(x.as_py(), shingle) for x in batch.column("body")), np.uint64, len(batch)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("tie"), pa.array(found.view(np.int64))],
                names=["id", "tie", "fp"],
            )

    body = docs[text].cast("string")
    rows = docs.select(
        docs[doc_id].cast("bigint").alias("id"), F.xxhash64(body).alias("tie"), body.alias("body")
    )
    return rows.mapInArrow(run, "id bigint, tie bigint, fp bigint")


def shards(fp: Column) -> Column:
    """The 16 shards of a fingerprint, each as one long: choice of blocks, then their bits."""
    out = []
    for outer in range(4):
        block = F.shiftrightunsigned(fp, 16 * outer).bitwiseAND(F.lit(0xFFFF))
        high = F.shiftright(fp, 16 * (outer + 1)) if outer < 3 else F.lit(0).cast("bigint")
        rest = F.shiftleft(high, 16 * outer).bitwiseOR(fp.bitwiseAND(F.lit((1 << 16 * outer) - 1)))
        for inner in range(4):
            part = F.shiftrightunsigned(rest, 12 * inner).bitwiseAND(F.lit(0xFFF))
            out.append(
                F.lit((4 * outer + inner) << 28).bitwiseOR(F.shiftleft(block, 12)).bitwiseOR(part)
            )
    return F.array(*out)


class Forest:
    """BK-trees of many shards side by side; ``starts`` are the places where shards begin."""

    def __init__(self, values: np.ndarray, starts: np.ndarray):
        self.values = values
        sizes = np.diff(np.append(starts, len(values)))
        self.root = np.repeat(starts, sizes)
        self.size = np.repeat(sizes, sizes)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        at = self.root.copy()
        waiting = np.flatnonzero(np.arange(len(values)) != at)
        nodes, keys = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while len(waiting):
            # The first to come down an edge that has no child becomes it, the others go on below.
            edge = at[waiting] * 65 + self._distance(waiting, at[waiting])
            taken, first, which = np.unique(edge, return_index=True, return_inverse=True)
            child = waiting[first]
            nodes.append(child)
            keys.append(taken)
            self.levels.append((child, at[child]))
            at[waiting] = child[which]
            waiting = waiting[at[waiting] != waiting]
        order = np.argsort(np.concatenate(keys), kind="stable")
        self._edges = np.concatenate(keys)[order]
        self._children = np.concatenate(nodes)[order]

    def _distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.values[a] ^ self.values[b]).astype(np.int64)

    def search(self, queries: np.ndarray, radius: int, label: np.ndarray, one: np.ndarray):
        """Pairs within the radius. Subtrees that lie wholly in the query's component are passed by."""
        query, node = queries, self.root[queries]
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        while len(query):
            far = self._distance(query, node)
            hit = (far <= radius) & (query != node)
            found.append((query[hit], node[hit]))
            low = np.searchsorted(self._edges, node * 65 + np.maximum(far - radius, 0))
            high = np.searchsorted(self._edges, node * 65 + np.minimum(far + radius, 64), "right")
            many = high - low
            query = np.repeat(query, many)
            place = np.arange(len(query)) - np.repeat(np.cumsum(many) - many, many)
            node = self._children[np.repeat(low, many) + place]
            open_ = one[node] != label[query]
            query, node = query[open_], node[open_]
        return tuple(map(np.concatenate, zip(*found)))

    def single_component(self, label: np.ndarray) -> np.ndarray:
        """Of each subtree the component that all of it is in, or -1."""
        one = label.copy()
        for child, parent in reversed(self.levels):
            one[parent[one[child] != one[parent]]] = -1
        return one

    def link(self, radius: int) -> np.ndarray:
        """For each value the first value of its shard that it is linked with over any steps."""
        label = np.arange(len(self.values))
        one = np.full(len(label), -1)
        queries = np.flatnonzero(self.size > 1)
        ends = np.cumsum(self.size[queries]) // _SWEEP
        for sweep in np.split(queries, np.flatnonzero(np.diff(ends)) + 1):
            a, b = self.search(sweep, radius, label, one)
            label = merged(label, a, b)
            one = self.single_component(label)
        return label


def merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking ``a`` with ``b``; a component's label is its smallest member."""
    while True:
        left, right = label[a], label[b]
        apart = left != right
        if not apart.any():
            return label
        a, b, left, right = a[apart], b[apart], left[apart], right[apart]
        to = np.arange(len(label))
        np.minimum.at(to, np.maximum(left, right), np.minimum(left, right))
        while (to[to] != to).any():
            to = to[to]
        label = to[label]


def _shard_links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, fp = np.empty(0, np.int64), np.empty(0, np.int64)

        def linked(shard: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
            first = Forest(fp.view(np.uint64), starts).link(radius)
            joined = first != np.arange(len(fp))
            return pa.RecordBatch.from_arrays(
                [pa.array(fp[joined]), pa.array(fp[first[joined]])], names=["u", "v"]
            )

        for batch in batches:
            shard = np.append(shard, batch.column("shard").to_numpy())
            fp = np.append(fp, batch.column("fp").to_numpy())
            if len(shard) < 200_000:
                continue
            # The last shard may go on in the next batch.
            whole = int(np.searchsorted(shard, shard[-1])) if len(shard) else 0
            if whole:
                yield linked(shard[:whole], fp[:whole])
                shard, fp = shard[whole:], fp[whole:]
        if len(shard):
            yield linked(shard, fp)

    return run


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``u``, ``v`` between the distinct ``fp`` that leave out none of their connections.

    Each shard gives a spanning forest of its links, so a dense group gives as many rows as it has
    members and not their square.
    """
    if not 0 <= radius <= 3:
        raise ValueError("four blocks find all links of up to three bits")
    partitions = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = distinct.select("fp", F.explode(shards(F.col("fp"))).alias("shard"))
    sorted_ = dealt.repartition(partitions, "shard").sortWithinPartitions("shard", "fp")
    return sorted_.mapInArrow(_shard_links(radius), "u bigint, v bigint")


def near_groups(docs: DataFrame, *, shingle: int = SHINGLE, radius: int = RADIUS, **columns) -> DataFrame:
    """``id``, ``tie``, ``fp`` and ``component`` of every row of ``docs``, and whether it is the ``first``.

    Texts of equal words in equal order share a fingerprint whatever their case in A to Z; texts
    without words, null ones included, share fingerprint zero and are linked like any other.
    ``component`` is the smallest id reachable over links, null only if no linked row has an id.
    ``first`` marks the rows of the group's smallest id (null last), then tie; rows that equal each
    other in id and text are all marked.
    """
    spark = docs.sparkSession
    path = f"{new_folder(spark)}/fingerprints"
    fingerprints(docs, shingle=shingle, **columns).write.parquet(path)
    marked = spark.read.parquet(path)
    order = F.struct(F.col("id").isNull().alias("n"), "id", "tie")
    distinct = marked.groupBy("fp").agg(F.min(order).alias("least"))
    roots = components(links(distinct.select("fp"), radius))
    grouped = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    least = grouped.groupBy("root").agg(F.min("least").alias("least"))
    by_fp = grouped.select("fp", "root").join(least, "root").select("fp", "least")
    return marked.join(by_fp, "fp").select(
        "id",
        "tie",
        "fp",
        F.col("least.id").alias("component"),
        (order == F.col("least")).alias("first"),
    )


def without_copies(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", **settings
) -> DataFrame:
    """One row of ``docs`` for each group, the one marked ``first``; of equal rows any one."""

    def key(ident: Column, tie: Column) -> Column:
        return F.struct(ident.isNull().alias("n"), F.coalesce(ident, F.lit(0)).alias("id"), tie.alias("tie"))

    groups = near_groups(docs, text=text, doc_id=doc_id, **settings).filter("first")
    firsts = groups.select(key(F.col("id"), F.col("tie")).alias("key")).distinct()
    keyed = docs.select(
        F.struct("*").alias("row"),
        key(docs[doc_id].cast("bigint"), F.xxhash64(docs[text].cast("string"))).alias("key"),
    )
    one = Window.partitionBy("key").orderBy(F.lit(0))
    return (
        keyed.join(firsts, "key")
        .withColumn("copy", F.row_number().over(one))
        .filter("copy = 1")
        .select("row.*")
    )


def as_text(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
