"""Prefix trie of conversations, by range minima over sorted common prefixes.

A conversation is the row of its turns. Each turn's prefix has a key of 128 bits: the sum of hashed
(place, turn) pairs, so that a conversation of any length is keyed in pieces. Only what two or more
conversations share needs sorting: the array of a conversation's shared keys is short, and a tail that
it has alone is a chain of nodes known beforehand.

Conversations are sorted by these arrays over all partitions and cut into blocks. In a block, ``lcp[i]``
is the number of turns that ``i`` shares with the one before it, and a sparse table holds the minima of
all runs of ``lcp`` whose length is a power of two. A candidate prefix, ``d`` turns of conversation
``i``, reaches left and right as far as ``lcp`` stays at ``d`` or above: both ends are found by halving
steps in the table, for all candidates at once, each on its own. Between the ends lie its members.

A node whose interval touches the edge of its block beyond which the prefix goes on is open: its parts
are sums over members, so they are added up over blocks. There are at most as many open nodes in a
block as its two edge conversations share turns with their neighbours.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.ranked import pieces, stored_in_order
from assay.workspace import new_folder

#: Conversations with a common beginning: those from one multiple of this to the next.
FAMILY = 100
#: A rebuilt conversation takes fewer than so many turns of its family's first.
MOST_HEAD = 6

#: A prefix with more than this part of all prefixes of all conversations is looked up by broadcast;
#: there are fewer such prefixes than that.
_HOT_PART = 1000

_LIMBS = 4
_TAIL_CHUNK = 1000

_PART_SCHEMA = (
    "kind string, node string, depth bigint, conv_id bigint, parent_conv_id bigint, parent string,"
    " n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string,"
    " to_depth bigint, block bigint"
)
_NODE_SCHEMA = (
    "node string, depth bigint, conv_id bigint, parent string, n_convs bigint, n_children bigint,"
    " n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
ROOT = ""


def head_length(conv_id: Column) -> Column:
    """How many turns a rebuilt conversation takes from its family's first one."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % MOST_HEAD).cast("bigint")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = f"{new_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations (``conv``, ``part``, ``slot``, ``depth``, ``turn_hash``,
    ``chars``), and each conversation with its number of turns (``conv``, ``len``)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    known = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.col("turn").alias("turn"),
        F.md5(content.cast("binary")).alias("turn_hash"),
        F.length(text).cast("bigint").alias("chars"),
    )
    stored = stored_in_order(known, ["conv", F.col("turn").asc_nulls_first(), "turn_hash"])
    runs = pieces(stored, "conv").withColumn("h", head_length(F.col("conv")))
    numbered = (
        stored.join(runs, ["conv", "part"])
        .withColumn("place", F.col("before") + F.col("slot") - F.col("first"))
    )
    heads = numbered.filter(
        (F.col("conv") % FAMILY == 0) & (F.col("place") < MOST_HEAD - 1)
    ).select(F.col("conv").alias("base"), "place", "turn_hash", "chars")
    sizes = runs.filter("before = 0").select("conv", "h", "total")
    base_sizes = heads.groupBy("base").agg(F.count(F.lit(1)).alias("base_len"))
    base = F.col("conv") - F.col("conv") % FAMILY
    convs = _stored(
        sizes.withColumn("base", base)
        .join(base_sizes, "base", "left")
        .withColumn("taken", F.least("h", F.coalesce("base_len", F.lit(0))))
        .withColumn("len", F.col("taken") + F.greatest(F.col("total") - F.col("h"), F.lit(0))),
        "conversations",
    )
    # The joins are by conversation and piece, so one with most of the rows is spread like the pieces.
    shifts = runs.select("conv", "part").join(convs.select("conv", "taken"), "conv")
    own = (
        numbered.filter("place >= h")
        .join(shifts, ["conv", "part"])
        .select(
            "conv",
            "part",
            "slot",
            (F.col("place") - F.col("h") + F.col("taken") + 1).alias("depth"),
            "turn_hash",
            "chars",
        )
    )
    begun = (
        convs.join(heads, "base")
        .filter("place < taken")
        .select(
            "conv",
            F.lit(-1).cast("bigint").alias("part"),
            F.col("place").alias("slot"),
            (F.col("place") + 1).alias("depth"),
            "turn_hash",
            "chars",
        )
    )
    return _stored(own.unionByName(begun), "turns"), convs.select("conv", "len")


def keyed_prefixes(turns: DataFrame) -> DataFrame:
    """``conv``, ``depth``, the ``key`` of the conversation's first ``depth`` turns and the last one's
    ``chars``; sums run within pieces, on top of the sums of earlier pieces."""
    hashed = F.md5(F.concat_ws("|", "depth", "turn_hash").cast("binary"))
    limbs = {
        f"limb_{i}": F.conv(F.substring(hashed, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(_LIMBS)
    }
    cut = turns.withColumns(limbs)
    sums = cut.groupBy("conv", "part").agg(*[F.sum(name).alias(name) for name in limbs])
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "conv", "part", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_before") for n in limbs]
    )
    upto = Window.partitionBy("conv", "part").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    running = [(F.col(f"{n}_before") + F.sum(n).over(upto)).cast("string") for n in limbs]
    return cut.join(starts, ["conv", "part"]).select(
        "conv", "depth", F.md5(F.concat_ws(".", *running).cast("binary")).alias("key"), "chars"
    )


def shared_prefixes(prefixes: DataFrame) -> DataFrame:
    """The prefixes that several conversations have. Very common ones do not go through the join, which
    would send all rows of one to a single task."""
    counted = prefixes.groupBy("depth", "key").agg(F.count(F.lit(1)).alias("members"))
    common = _stored(counted.filter("members > 1"), "common")
    many = F.greatest(F.lit(prefixes.count() // _HOT_PART), F.lit(1))
    hot = common.filter(F.col("members") > many).select("depth", "key", F.lit(True).alias("hot"))
    marked = prefixes.join(F.broadcast(hot), ["depth", "key"], "left")
    rest = common.filter(F.col("members") <= many).select("depth", "key")
    others = marked.filter("hot IS NULL").join(rest, ["depth", "key"], "left_semi")
    return marked.filter("hot").unionByName(others).drop("hot")


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Minima of the runs of 1, 2, 4, ... values; entry i of each is of the run that starts at i."""
    table = [values]
    width = 1
    while 2 * width <= len(values):
        last = table[-1]
        table.append(np.minimum(last[:-width], last[width:]))
        width *= 2
    return table


def run_minimum(table: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least value from ``left`` to ``right``, both included."""
    power = np.frexp((right - left + 1).astype(np.float64))[1] - 1
    out = np.empty(len(left), table[0].dtype)
    for k in np.unique(power).tolist():
        at = power == k
        out[at] = np.minimum(table[k][left[at]], table[k][right[at] - (1 << k) + 1])
    return out


def extents(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and last neighbour of each ``at`` with which it shares ``depth`` turns: binary
    searches by halving steps, a step being taken if the minimum over it is at least ``depth``."""
    n = len(table[0])
    left, right = at.copy(), at.copy()
    for k in range(len(table) - 1, -1, -1):
        width, minima = 1 << k, table[k]
        fits = right + width < n
        step = fits & (minima[np.where(fits, right + 1, 0)] >= depth)
        right[step] += width
        # Entry 0 stands for the neighbour in the block before, so no step may take it in.
        fits = left - width >= 0
        step = fits & (minima[np.where(fits, left - width + 1, 0)] >= depth)
        left[step] -= width
    return left, right


def _common(keys: list[list[str]]) -> np.ndarray:
    """How many keys each row shares with the row before it."""
    sizes = np.fromiter(map(len, keys), np.int64, len(keys))
    codes: dict[str, int] = {}
    flat = np.fromiter(
        (codes.setdefault(key, len(codes)) for row in keys for key in row), np.int64, int(sizes.sum())
    )
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(flat)) - np.repeat(starts, sizes)
    before = np.append(0, sizes[:-1])
    inside = place < np.repeat(before, sizes)
    other = np.repeat(np.append(0, starts[:-1]), sizes) + place
    same = np.zeros(len(flat), bool)
    same[inside] = flat[inside] == flat[other[inside]]
    upto = np.append(0, np.cumsum(same))
    return upto[starts + sizes] - upto[starts]


def _ends(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def block_nodes(table: pa.Table) -> pa.Table:
    """The nodes of one block, from its conversations in order; ``side`` tells the neighbours' from
    the blocks before (-1) and after (1)."""
    table = table.sort_by([("side", "ascending"), ("slot", "ascending")])
    side = table.column("side").to_numpy()
    all_keys = table.column("keys").to_pylist()
    shared = _common(all_keys)
    own = np.flatnonzero(side == 0)
    first, n = int(own[0]), len(own)
    # Common turns with the one before and, beyond the block's end, with the one after.
    lcp = shared[own].copy()
    if first == 0:
        lcp[0] = -1
    following = np.append(lcp[1:], shared[own[-1] + 1] if own[-1] + 1 < len(side) else -1)
    keys = [all_keys[i] for i in own.tolist()]
    chars = [table.column("chars")[int(i)].as_py() for i in own]
    conv = table.column("conv").to_numpy()[own]
    length = table.column("len").to_numpy()[own]
    size = np.fromiter(map(len, keys), np.int64, n)

    # Characters of the first d turns of each conversation, at starts[i] + d.
    upto = np.append(0, np.cumsum(np.fromiter((c for row in chars for c in row), np.int64, int(size.sum()))))
    starts = np.append(0, np.cumsum(size))[:-1]

    def chars_of(i: np.ndarray, d: np.ndarray) -> np.ndarray:
        return upto[starts[i] + np.maximum(d, 0)] - upto[starts[i]]

    inner = lcp.copy()
    inner[0] = -1  # the interval of a block ends at its first row
    minima, least = sparse_table(inner), sparse_table(conv)
    shared_chars = np.append(0, np.cumsum(chars_of(np.arange(n), np.minimum(lcp, size))))
    leaf = np.append(0, np.cumsum(following < length))
    # Where a conversation parts from the one before it, by depth and then place.
    parts = np.flatnonzero(length > lcp)
    order = np.lexsort((parts, lcp[parts]))
    parting = (lcp[parts] + 1)[order] * (n + 1) + parts[order]
    changes = np.append(np.flatnonzero(np.diff(length)), n - 1)
    run_end = changes[np.searchsorted(changes, np.arange(n))]

    def spans(i: np.ndarray, d: np.ndarray):
        left, right = extents(minima, i, d)
        opened = ((left == 0) & (lcp[0] >= d)) | ((right == n - 1) & (following[-1] >= d)) | (d == 0)
        return left, right, opened

    # A prefix is a candidate where it begins: beyond what is shared with the row before.
    begin = np.maximum(np.append(0, inner[1:]), 0)
    count = size - begin
    count[0] += 1  # the root
    at = np.repeat(np.arange(n), count)
    within = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    depth = within + np.where(at == 0, 0, begin[at] + 1)
    left, right, opened = spans(at, depth)
    members = right - left + 1
    # Members that have the prefix in common with the one before them add what is shared beyond it.
    goes_on = lcp[left] >= depth
    base = chars_of(left, depth - 1)
    counted = members - ~goes_on
    from_row = left + ~goes_on
    saved = shared_chars[right + 1] - shared_chars[from_row] - counted * base

    def parted(row: np.ndarray) -> np.ndarray:
        return np.searchsorted(parting, (depth + 1) * (n + 1) + row)

    children = parted(right + 1) - parted(left + 1) + ((lcp[left] <= depth) & (length[left] > depth))
    ended = np.where(length[left] == depth, np.minimum(run_end[left], right) - left + 1, 0)

    up_left, up_right, up_open = spans(at, np.maximum(depth - 1, 0))
    up_conv = run_minimum(least, up_left, up_right)
    node_conv = run_minimum(least, left, right)
    leaves = leaf[right + 1] - leaf[left]

    def key_at(i: int, d: int) -> str:
        return keys[i][d - 1] if d > 0 else ROOT

    rows = {name: [] for name in ("kind", "node", "parent", "parent_conv_id", "ends")}
    ids = conv.tolist()
    for i, d, a, e, is_open, p_open, p_conv in zip(
        at.tolist(), depth.tolist(), left.tolist(), ended.tolist(), opened.tolist(), up_open.tolist(), up_conv.tolist()
    ):
        rows["kind"].append("open" if is_open else "node")
        rows["node"].append(key_at(i, d) if is_open else None)
        known = d > 0 and not p_open
        rows["parent"].append(key_at(i, d - 1) if d > 0 and p_open else None)
        rows["parent_conv_id"].append(p_conv if known else None)
        these = ids[a : a + e]
        rows["ends"].append(",".join(map(str, these)) if is_open else _ends(these))

    # What a conversation has alone: a chain from its last shared turn on.
    alone = np.flatnonzero(length > size)
    last = size[alone]
    t_left, t_right, t_open = spans(alone, last)
    t_conv = run_minimum(least, t_left, t_right)
    for i, d, is_open, p_conv in zip(alone.tolist(), last.tolist(), t_open.tolist(), t_conv.tolist()):
        rows["kind"].append("tail")
        rows["node"].append(None)
        rows["parent"].append(key_at(i, d) if is_open else None)
        rows["parent_conv_id"].append(None if is_open else p_conv)
        rows["ends"].append(_ends([ids[i]]))
    total, k = len(rows["kind"]), len(alone)
    ones = np.ones(k, np.int64)

    def number(nodes: np.ndarray, tails: np.ndarray) -> pa.Array:
        return pa.array(np.append(nodes, tails).astype(np.int64))

    return pa.table(
        {
            "kind": pa.array(rows["kind"], pa.string()),
            "node": pa.array(rows["node"], pa.string()),
            "depth": number(depth, last + 1),
            "conv_id": number(node_conv, conv[alone]),
            "parent_conv_id": pa.array(rows["parent_conv_id"], pa.int64()),
            "parent": pa.array(rows["parent"], pa.string()),
            "n_convs": number(members, ones),
            "n_children": number(children, 0 * ones),
            "n_leaves": number(leaves, ones),
            "saved_tokens": number(saved, 0 * ones),
            "ends": pa.array(rows["ends"], pa.string()),
            "to_depth": number(depth, length[alone]),
            "block": pa.array(np.full(total, int(table.column("block")[0].as_py()), np.int64)),
        }
    )


def _open_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open nodes from their parts, which come sorted by node and block: one pass, one node in hand."""
    names = ("node", "depth", "conv_id", "parent", "n_convs", "n_children", "n_leaves", "saved_tokens")
    held: dict | None = None
    digest, some = hashlib.sha256(), False
    done: list[dict] = []

    def closed() -> dict:
        return {**held, "ends_sha256": digest.hexdigest()}

    def out(rows: list[dict]) -> pa.RecordBatch:
        types = {name: pa.int64() for name in names} | {n: pa.string() for n in ("node", "parent", "ends_sha256")}
        return pa.RecordBatch.from_pydict(
            {name: pa.array([row[name] for row in rows], types[name]) for name in (*names, "ends_sha256")}
        )

    for batch in batches:
        for row in batch.to_pylist():
            if held is None or (row["depth"], row["node"]) != (held["depth"], held["node"]):
                if held is not None:
                    done.append(closed())
                held = {name: row[name] for name in names}
                digest, some = hashlib.sha256(), False
            else:
                held["conv_id"] = min(held["conv_id"], row["conv_id"])
                for name in names[4:]:
                    held[name] += row[name]
            if row["ends"]:
                digest.update((("," if some else "") + row["ends"]).encode())
                some = True
        if done:
            yield out(done)
            done = []
    if held is not None:
        yield out([closed()])


def trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations, one row each: ``conv_id``, the smallest
    member, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``
    and ``ends_sha256``.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are not looked at. Null
    turns come first; turns that tie in number stand in the order of a hash of role and text, so reruns
    agree; equal rows are turns of their own. A null role or text is empty. Turns without a conversation
    id belong to no conversation and are left out. Without any conversation there are no nodes.
    """
    rebuilt, convs = rebuilt_turns(turns)
    prefixes = _stored(keyed_prefixes(rebuilt), "prefixes")
    arrays = (
        shared_prefixes(prefixes)
        .groupBy("conv")
        .agg(F.sort_array(F.collect_list(F.struct("depth", "key", "chars"))).alias("shared"))
    )
    rows = convs.join(arrays, "conv", "left").select(
        "conv",
        "len",
        F.coalesce("shared.key", F.array().cast("array<string>")).alias("keys"),
        F.coalesce("shared.chars", F.array().cast("array<bigint>")).alias("chars"),
    )
    ordered = stored_in_order(rows, ["keys", "len", "conv"])

    # Blocks are numbered without gaps, so that each knows its neighbours.
    edges = ordered.groupBy("part").agg(F.min("slot").alias("first"), F.max("slot").alias("last"))
    blocks = edges.withColumn("block", F.row_number().over(Window.orderBy("part")).cast("bigint"))
    ends = blocks.select(
        "part",
        F.explode(
            F.array(
                F.struct(F.col("first").alias("slot"), (F.col("block") - 1).alias("block"), F.lit(1).alias("side")),
                F.struct(F.col("last").alias("slot"), (F.col("block") + 1).alias("block"), F.lit(-1).alias("side")),
            )
        ).alias("end"),
    ).select("part", "end.*")
    columns = ["conv", "len", "keys", "chars", "slot", "block", "side"]
    inside = ordered.join(blocks.select("part", "block"), "part").withColumn("side", F.lit(0))
    beside = ordered.join(ends, ["part", "slot"]).join(
        blocks.select("block"), "block", "left_semi"
    )
    found = _stored(
        inside.select(*columns)
        .unionByName(beside.select(*columns))
        .groupBy("block")
        .applyInArrow(block_nodes, _PART_SCHEMA),
        "parts",
    )

    opened = found.filter("kind = 'open'").repartition("depth", "node").sortWithinPartitions("depth", "node", "block")
    merged = _stored(opened.drop("kind", "parent_conv_id", "to_depth").select(
        "node", "depth", "conv_id", "parent", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"
    ).mapInArrow(_open_nodes, _NODE_SCHEMA), "open")

    tails = found.filter("kind = 'tail'")
    chunks = tails.select(
        "conv_id",
        "parent",
        "parent_conv_id",
        F.col("ends").alias("ends_here"),
        F.col("depth").alias("from_depth"),
        "to_depth",
        F.explode(F.sequence("depth", "to_depth", F.lit(_TAIL_CHUNK).cast("bigint"))).alias("chunk"),
    ).repartition("conv_id", "chunk")
    last = F.least(F.col("chunk") + _TAIL_CHUNK - 1, F.col("to_depth"))
    is_first = F.col("depth") == F.col("from_depth")
    is_last = F.col("depth") == F.col("to_depth")
    chains = chunks.withColumn("depth", F.explode(F.sequence("chunk", last))).select(
        "conv_id",
        "depth",
        F.when(is_first, F.col("parent")).alias("parent"),
        F.when(is_first, F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.lit(1).cast("bigint").alias("n_convs"),
        F.when(is_last, 0).otherwise(1).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(is_last, F.col("ends_here")).otherwise(hashlib.sha256().hexdigest()).alias("ends_sha256"),
    )
    names = chains.columns
    closed = found.filter("kind = 'node'").withColumn("ends_sha256", F.col("ends")).select(*names)
    edge = merged.withColumn("parent_conv_id", F.lit(None).cast("bigint")).select(*names)
    nodes = closed.unionByName(edge).unionByName(chains)

    above = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("open_conv_id"))
    resolved = nodes.filter("parent IS NOT NULL").join(above, "parent", "left")
    whole = resolved.withColumn("parent_conv_id", F.col("open_conv_id")).select(*names).unionByName(
        nodes.filter("parent IS NULL")
    )
    return whole.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    )
