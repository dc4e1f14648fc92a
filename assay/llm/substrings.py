"""Removal of repeated passages by seed and extend.

Documents are dealt into blocks of bounded size by their id and text. Each window of words has one anchor: the
smallest hash of the word runs in it (winnowing), so equal windows have equal anchors, and only about
one run in seven ever is an anchor. Blocks are joined on these anchors. Around a shared anchor the
match is extended both ways, to every window that has it as its anchor; of each window the first
holder is found, and windows that lie side by side make up the maximal repeats.

What crosses between blocks is an anchor or a window once a block: a passage that a third of all
documents hold is a row for each block, not for each holder, let alone each pair of holders.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.blocks import BLOCK_BYTES, block_of, blocked, signed, texts_of, unsigned, with_row

WINDOW = 20
ANCHOR = 8

# Odd multipliers of the two rolling hashes.
_RUN_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_WINDOW_FACTOR = np.uint64(0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def _rolled(hashes: np.ndarray, length: int, factor: np.uint64) -> np.ndarray:
    """A hash of each run of ``length`` word hashes, also of runs that cross documents."""
    n = max(len(hashes) - length + 1, 0)
    out = np.zeros(n, np.uint64)
    for i in range(length):
        out *= factor
        out += hashes[i : i + n]
    out ^= out >> np.uint64(33)
    out *= _MIX
    out ^= out >> np.uint64(29)
    return out


class Block:
    """The documents of one block by id (null last), then text, as one row of words."""

    def __init__(self, table: pa.Table, text: str, window: int, anchor: int):
        ids = table.column("id").to_pylist()
        texts = texts_of(table, text)
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        self.order = np.array(order, np.int64)
        self.ids = [ids[i] for i in order]
        split = [texts[i].encode().split() for i in order]
        self.counts = np.fromiter(map(len, split), np.int64, len(split))
        self.words = [word for words in split for word in words]
        self.window = window
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(map(digest, self.words), np.uint64, len(self.words))

        ends = np.repeat(np.cumsum(self.counts), self.counts)
        whole = max(len(hashes) - window + 1, 0)
        #: Where windows start that lie within one document; their anchors and their own hashes.
        self.starts = np.flatnonzero(np.arange(whole) + window <= ends[:whole])
        runs = _rolled(hashes, anchor, _RUN_FACTOR)
        smallest = runs[:whole].copy()
        for offset in range(1, window - anchor + 1):
            np.minimum(smallest, runs[offset : offset + whole], out=smallest)
        self.anchors = smallest[self.starts]
        self._hashes = hashes

    def windows(self) -> np.ndarray:
        return _rolled(self._hashes, self.window, _WINDOW_FACTOR)[self.starts]

    def holders(self, places: np.ndarray) -> list[int | None]:
        """The ids of the documents that hold these words."""
        which = np.searchsorted(np.cumsum(self.counts), places, "right")
        return [self.ids[i] for i in which.tolist()]

    def repeated(self, elsewhere: np.ndarray) -> np.ndarray:
        """Words covered by a window found earlier in this block or, by its hash, ``elsewhere``."""
        hashes = self.windows()
        distinct, first = np.unique(hashes, return_index=True)
        again = np.ones(len(hashes), bool)
        again[first[~np.isin(distinct, elsewhere)]] = False
        edges = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(edges, self.starts[again], 1)
        np.add.at(edges, self.starts[again] + self.window, -1)
        return np.cumsum(edges)[:-1] > 0


def repeats(
    docs: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    window: int = WINDOW,
    anchor: int = ANCHOR,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``row``, ``n_words``, ``n_removed``, the ``kept`` text and the removed ``spans`` of each document.

    A word goes if a window of ``window`` words that covers it starts earlier too, in a document of
    smaller id or earlier in its own; a span is a maximal run of such words, from its first word to
    behind its last. The kept words are joined by one blank. Texts shorter than a window lose nothing;
    a null text has no words. Rows without an id come last; rows of one id, or of none, go by their
    block, a hash of id and text, then by their text, and of equal rows one comes first, so that the
    others repeat it. Windows are judged on the input.
    Columns of ``docs`` stay inside ``row``, so none can clash.

    Windows are equal if two 64-bit hashes, of the whole and of the anchor, are equal.
    """
    if not 0 < anchor <= window:
        raise ValueError("an anchor lies inside a window")
    source = blocked(docs, docs[doc_id], docs[text], block_bytes)
    by_block = source.groupBy("block")

    def seeds(table: pa.Table) -> pa.Table:
        own = np.unique(Block(table, text, window, anchor).anchors)
        return pa.table({"block": block_of(table, len(own)), "anchor": signed(own)})

    shared = (
        by_block.applyInArrow(seeds, "block bigint, anchor bigint")
        .withColumn("blocks", F.count(F.lit(1)).over(Window.partitionBy("anchor")))
        .filter("blocks > 1")
        .select("block", "anchor")
    )

    def extended(table: pa.Table, seeds: pa.Table) -> pa.Table:
        block = Block(table, text, window, anchor)
        around = np.flatnonzero(np.isin(block.anchors, unsigned(seeds.column("anchor"))))
        hashes, first = np.unique(block.windows()[around], return_index=True)
        at = around[first]
        return pa.table(
            {
                "block": block_of(table, len(at)),
                "anchor": signed(block.anchors[at]),
                "hash": signed(hashes),
                "id": pa.array(block.holders(block.starts[at]), pa.int64()),
            }
        )

    holders = by_block.cogroup(shared.groupBy("block")).applyInArrow(
        extended, "block bigint, anchor bigint, hash bigint, id bigint"
    )
    first = Window.partitionBy("anchor", "hash").orderBy(F.col("id").asc_nulls_last(), "block")
    later = (
        holders.withColumn("place", F.row_number().over(first))
        .filter("place > 1")
        .select("block", "hash")
    )

    schema = with_row(
        source,
        "n_words bigint, n_removed bigint, kept string, spans array<struct<start:int,end:int>>",
    )

    def cut(table: pa.Table, later: pa.Table) -> pa.Table:
        block = Block(table, text, window, anchor)
        gone = block.repeated(unsigned(later.column("hash")))
        kept, removed, spans = [], [], []
        ends = np.cumsum(block.counts)
        for start, end in zip((ends - block.counts).tolist(), ends.tolist()):
            lost = gone[start:end]
            words = block.words[start:end]
            if lost.any():
                words = [words[i] for i in np.flatnonzero(~lost).tolist()]
                edges = np.flatnonzero(np.diff(np.concatenate(([0], lost.view(np.int8), [0]))))
                spans.append([{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
            else:
                spans.append([])
            kept.append(b" ".join(words).decode())
            removed.append(int(lost.sum()))
        return pa.table(
            {
                "row": table.column("row").take(pa.array(block.order)),
                "n_words": pa.array(block.counts),
                "n_removed": pa.array(removed, pa.int64()),
                "kept": pa.array(kept, pa.string()),
                "spans": pa.array(
                    spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                ),
            }
        )

    return by_block.cogroup(later.groupBy("block")).applyInArrow(cut, schema)


def without_repeats(docs: DataFrame, *, text: str = "text", **settings) -> DataFrame:
    """``docs`` with repeated passages cut from ``text``; a text that loses nothing stays as it is."""
    found = repeats(docs, text=text, **settings)
    cut = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row")[text])
    return found.select(
        *[(cut if name == text else F.col("row")[name]).alias(name) for name in docs.columns]
    )
