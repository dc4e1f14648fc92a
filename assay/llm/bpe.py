"""Byte-level BPE over a public rank file: encoding with offsets, and decoding.

Pre-tokenisation uses no regular expression. Every code point gets a class, every class is a function
from scanner state to scanner state, and such functions compose associatively: the text is cut into
equal stretches, the function of each stretch is worked out for all stretches side by side, a prefix
scan over these gives the state at the head of each, and a second sweep marks the boundaries.

The slices between boundaries are merged by rank. A slice is merged once and kept in a cache of bounded
size; new slices of a chunk are merged together, one merge per slice and round.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache, cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

# Bounds of memory, not of results: slices kept per worker, code points scanned at a time, and the
# longest slice that is merged beside others.
CACHED_SLICES = 300_000
CHUNK_CHARS = 1_000_000
_SIDE_BY_SIDE = 40
_STRETCH = 64

# The code points with Unicode's White_Space property.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)

# Classes. A blank that a following word takes along is LEAD, white space before more of it (or at
# the end) is RUN, any other white space is LAST; an apostrophe is SHORT or LONG if a one-letter or
# two-letter ending follows that may form a slice of its own.
LETTER, NUMBER, OTHER, SHORT, LONG, LEAD, RUN, LAST = range(8)
# States: what the code point before left open.
_NOTHING, _LETTERS, _NUMBERS, _OTHERS, _LED, _ONE_MORE, _TWO_MORE, _SPACES = range(8)
_FRESH = 8  # added to the class of a document's first code point


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and boundary mark for each class (rows) and state (columns)."""
    opens = {
        LETTER: _LETTERS, NUMBER: _NUMBERS, OTHER: _OTHERS, SHORT: _ONE_MORE,
        LONG: _TWO_MORE, LEAD: _LED, RUN: _SPACES, LAST: _NOTHING,
    }
    goes_on = {
        (LETTER, _LETTERS): _LETTERS, (LETTER, _LED): _LETTERS,
        (LETTER, _TWO_MORE): _ONE_MORE, (LETTER, _ONE_MORE): _NOTHING,
        (NUMBER, _NUMBERS): _NUMBERS, (NUMBER, _LED): _NUMBERS,
        **{(c, s): _OTHERS for c in (OTHER, SHORT, LONG) for s in (_OTHERS, _LED)},
        (RUN, _SPACES): _SPACES,
    }
    step = np.zeros((16, 8), np.uint8)
    cut = np.ones((16, 8), bool)
    for kind, first in opens.items():
        step[kind] = step[kind + _FRESH] = first
        for state in range(8):
            if (kind, state) in goes_on:
                step[kind, state] = goes_on[kind, state]
                cut[kind, state] = False
    return step.ravel(), cut.ravel()


_STEP, _CUT = _automaton()
# bytes.translate looks up a whole array at about a byte a nanosecond.
_STEP_TABLE = bytes(_STEP).ljust(256, b"\0")
_CUT_TABLE = bytes(_CUT.astype(np.uint8)).ljust(256, b"\0")


def _looked_up(at: np.ndarray, table: bytes) -> np.ndarray:
    return np.frombuffer(at.tobytes().translate(table), np.uint8).reshape(at.shape)


@cache
def _general_classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    by_initial = {"L": LETTER, "N": NUMBER}
    for point in range(0x110000):
        kind = by_initial.get(unicodedata.category(chr(point))[0])
        if kind is not None:
            table[point] = kind
    table[list(WHITE_SPACE)] = RUN
    return table


def classes(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of each code point; ``starts`` are the places where documents begin."""
    n = len(points)
    fresh = np.zeros(n + 2, bool)
    fresh[starts] = True
    fresh[n:] = True
    kind = _general_classes()[points]

    space = kind == RUN
    more = np.append(space[1:], True) | fresh[1 : n + 1]
    kind[space & ~more] = LAST
    kind[space & ~more & (points == 0x20)] = LEAD

    quotes = np.flatnonzero(points == ord("'"))
    padded = np.append(points, np.zeros(2, points.dtype))
    first, second = padded[quotes + 1], padded[quotes + 2]
    first_in = ~fresh[quotes + 1]
    second_in = first_in & ~fresh[quotes + 2]
    short = first_in & np.isin(first, [ord(c) for c in "stmd"])
    long = second_in & (
        ((second == ord("e")) & ((first == ord("r")) | (first == ord("v"))))
        | ((first == ord("l")) & (second == ord("l")))
    )
    kind[quotes[short]] = SHORT
    kind[quotes[long]] = LONG
    kind[starts] += _FRESH
    return kind


def boundaries(kind: np.ndarray) -> np.ndarray:
    """True where a slice begins, by scans over composed transition functions."""
    n = len(kind)
    lanes = -(-n // _STRETCH)
    padded = np.full(lanes * _STRETCH, OTHER, np.uint8)
    padded[:n] = kind
    columns = np.ascontiguousarray(padded.reshape(lanes, _STRETCH).T) * np.uint8(8)

    # The function of each stretch, as its eight images.
    images = np.broadcast_to(np.arange(8, dtype=np.uint8), (lanes, 8)).copy()
    for column in columns:
        images = _looked_up(column[:, None] + images, _STEP_TABLE)
    images = images.copy()
    # Prefix compositions by doubling: after them, images[i] is the function of stretches 0 to i.
    reach = 1
    while reach < lanes:
        images[reach:] = np.take_along_axis(images[reach:], images[:-reach].astype(np.intp), axis=1)
        reach *= 2

    state = np.zeros(lanes, np.uint8)
    state[1:] = images[:-1, 0]
    marks = np.empty((_STRETCH, lanes), np.uint8)
    for row, column in enumerate(columns):
        at = column + state
        marks[row] = _looked_up(at, _CUT_TABLE)
        state = _looked_up(at, _STEP_TABLE)
    return marks.T.ravel()[:n].astype(bool)


class Ranks:
    """A rank file: token bytes by id, and the merged id of every pair of tokens that may merge."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            by_bytes = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = [b""] * (max(by_bytes.values()) + 1)
        for token, rank in by_bytes.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([by_bytes[bytes([b])] for b in range(256)], np.int64)
        self._none = len(self.tokens)
        self._by_bytes = by_bytes
        # Slices that were merged, with their ids as 32-bit numbers in a row.
        self._cache: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all tokens in a row, and where each begins and how long it is."""
        lengths = np.fromiter(map(len, self.tokens), np.int64, len(self.tokens))
        return np.frombuffer(b"".join(self.tokens), np.uint8), np.cumsum(lengths) - lengths, lengths

    @cached_property
    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of ids, sorted, as one number each, and the rank of the token that they make."""
        known = self._by_bytes
        made = np.fromiter(
            (
                number
                for token, rank in known.items()
                for i in range(1, len(token))
                if token[:i] in known and token[i:] in known
                for number in (known[token[:i]] << 32 | known[token[i:]], rank)
            ),
            np.int64,
        ).reshape(-1, 2)
        made = made[np.argsort(made[:, 0])]
        return np.ascontiguousarray(made[:, 0]), np.ascontiguousarray(made[:, 1])

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        keys, made = self._pairs
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, made[at], self._none)

    def merge_long(self, piece: bytes) -> bytes:
        """One slice, by a heap of pairs over linked symbols."""
        ids = self.byte_ids[list(piece)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        by_id, known = self.tokens, self._by_bytes

        def rank_at(left: int, right: int) -> int | None:
            return known.get(by_id[ids[left]] + by_id[ids[right]])

        heap = [(rank, i) for i in range(n - 1) if (rank := rank_at(i, i + 1)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or rank_at(i, j) != rank:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n:
                    found = rank_at(left, right)
                    if found is not None:
                        heapq.heappush(heap, (found, left))
        return np.array([x for x in ids if x >= 0], np.int32).tobytes()

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Slices side by side: in each round every unfinished one makes its lowest, leftmost merge."""
        done = [b""] * len(pieces)
        if not pieces:
            return done
        owner = np.arange(len(pieces))
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        # rank[i] belongs to the pair of symbols i and i + 1; the last symbol of a slice has none.
        rank = np.full(len(ids), self._none, np.int64)
        rank[:-1] = self._pair_ranks(ids[:-1], ids[1:])
        rank[np.cumsum(lengths) - 1] = self._none
        while len(owner):
            heads = np.cumsum(lengths) - lengths
            best = np.minimum.reduceat(rank, heads)
            finished = best == self._none
            if finished.any():
                raw = ids.astype(np.int32).tobytes()
                at = 4 * heads[finished]
                to = at + 4 * lengths[finished]
                for k, a, b in zip(owner[finished].tolist(), at.tolist(), to.tolist()):
                    done[k] = raw[a:b]
                going = ~finished
                stay = np.repeat(going, lengths)
                ids, rank, best = ids[stay], rank[stay], best[going]
                owner, lengths = owner[going], lengths[going]
                heads = np.cumsum(lengths) - lengths
                if not len(owner):
                    break
            equal = np.flatnonzero(rank == np.repeat(best, lengths))
            hits = equal[np.searchsorted(equal, heads)]
            ids[hits] = best
            keep = np.ones(len(ids), bool)
            keep[hits + 1] = False
            last = hits + 1 == heads + lengths - 1
            ids, rank = ids[keep], rank[keep]
            lengths = lengths - 1
            heads = np.cumsum(lengths) - lengths
            hits = hits - np.arange(len(hits))
            inner = ~last
            rank[hits[last]] = self._none
            rank[hits[inner]] = self._pair_ranks(ids[hits[inner]], ids[hits[inner] + 1])
            back = hits[hits > heads]
            rank[back - 1] = self._pair_ranks(ids[back - 1], ids[back])
        return done

    def ids(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each slice, as 32-bit numbers in a row."""
        if len(self._cache) > CACHED_SLICES // 2:
            self._older, self._cache = self._cache, {}
        known, older, whole = self._cache, self._older, self._by_bytes
        side_by_side = []
        for piece in set(pieces):
            if piece in known:
                continue
            if piece in older:
                known[piece] = older[piece]
            elif piece in whole:
                known[piece] = whole[piece].to_bytes(4, "little")
            elif len(piece) > _SIDE_BY_SIDE:
                known[piece] = self.merge_long(piece)
            else:
                side_by_side.append(piece)
        known.update(zip(side_by_side, self.merge_many(side_by_side)))
        return list(map(known.__getitem__, pieces))


@lru_cache(maxsize=2)
def ranks(path: str) -> Ranks:
    return Ranks(path)


def slices(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """The slices of all texts in a row, and how many each text has."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    if not sizes.sum():
        return [], np.zeros(len(texts), np.int64)
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    heads = np.cumsum(sizes) - sizes
    marks = boundaries(classes(points, heads[sizes > 0]))
    cuts = np.flatnonzero(marks)
    raw = joined.encode()
    at = cuts
    if len(raw) > len(points):
        at = np.flatnonzero(np.frombuffer(raw, np.int8) >= -64)[cuts]  # not a continuation byte
    ends = [*at[1:].tolist(), len(raw)]
    pieces = [raw[a:b] for a, b in zip(at.tolist(), ends)]
    upto = np.searchsorted(cuts, np.append(heads, len(points)))
    return pieces, np.diff(upto)


def encode_texts(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, and how many each text has; scanned as one chunk."""
    pieces, counts = slices(texts)
    found = ranks(path).ids(pieces)
    flat = np.frombuffer(b"".join(found), np.int32)
    upto = np.append(0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4))
    return flat, np.diff(upto[np.append(0, np.cumsum(counts))])


def _chunks(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in a row with up to ``CHUNK_CHARS`` bytes together, or a single longer one."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    upto = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(texts):
        most = CHUNK_CHARS + (upto[at - 1] if at else 0)
        end = max(int(np.searchsorted(upto, most, "right")), at + 1)
        yield [text or "" for text in texts.slice(at, end - at).to_pylist()]
        at = end


def decode_ids(
    flat: np.ndarray, counts: np.ndarray, path: str, offsets: np.ndarray | None = None
) -> list[bytes]:
    """The bytes of texts from their ids in a row and how many each has. With the ``offsets`` that
    encoding retained, every token's bytes go to their place in its text at once; a text whose tokens
    do not cover it without gaps raises."""
    known = ranks(path)
    if offsets is None:
        by_id, ends = known.tokens, np.cumsum(counts, dtype=np.int64)
        return [
            b"".join(map(by_id.__getitem__, flat[a:b].tolist()))
            for a, b in zip((ends - counts).tolist(), ends.tolist())
        ]
    letters, starts, lengths = known.table
    wide = lengths[flat]
    upto = np.append(0, np.cumsum(wide, dtype=np.int64))
    edges = np.append(0, np.cumsum(counts, dtype=np.int64))
    bases = upto[edges]
    places = np.repeat(bases[:-1], counts) + offsets
    if not np.array_equal(places, upto[:-1]):
        raise ValueError("offsets and ids do not belong together")
    source = np.repeat(starts[flat] - places, wide) + np.arange(upto[-1])
    raw = letters[source].tobytes()
    return [raw[a:b] for a, b in zip(bases[:-1].tolist(), bases[1:].tolist())]


def encode(
    docs: DataFrame, path: str, *, text: str = "text", offsets: bool = True, decoded: bool = False
) -> DataFrame:
    """``docs`` with ``ids`` and, if wanted, ``offsets``: the first byte of each token in the text.

    ``decoded`` adds the bytes that the ids stand for, as :func:`decode` would, without sending them
    back first. ``path`` names a rank file that every node can open. A null or empty text has no ids.
    Columns of ``docs`` by these three names are replaced, all others are passed on.
    """
    added = [StructField("ids", ArrayType(IntegerType()))]
    if offsets:
        added.append(StructField("offsets", ArrayType(IntegerType())))
    if decoded:
        added.append(StructField("decoded", BinaryType()))
    kept = docs.drop(*[field.name for field in added])
    schema = StructType([*kept.select(F.struct("*").alias("row")).schema, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = np.fromiter(map(len, ranks(path).tokens), np.int32)
        for batch in batches:
            done = 0
            for chunk in _chunks(batch.column("text_in")):
                flat, counts = encode_texts(chunk, path)
                edges = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
                columns = [
                    batch.column("row").slice(done, len(chunk)),
                    pa.ListArray.from_arrays(edges, pa.array(flat)),
                ]
                at = None
                if offsets:
                    wide = lengths[flat]
                    at = np.append(np.cumsum(wide) - wide, 0)
                    first = np.append(0, np.cumsum(counts))[:-1]
                    at = (at[:-1] - np.repeat(at[first], counts)).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(edges, pa.array(at)))
                if decoded:
                    columns.append(pa.array(decode_ids(flat, counts, path, at), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                done += len(chunk)

    rows = kept.select(F.struct("*").alias("row"), kept[text].cast("string").alias("text_in"))
    found = rows.mapInArrow(run, schema)
    return found.select("row.*", *[field.name for field in added])


def decode(
    tokens: DataFrame, path: str, *, ids: str = "ids", offsets: str | None = None, out: str = "decoded"
) -> DataFrame:
    """``tokens`` with the bytes of its ``ids`` in ``out``; null ids give no bytes. A column named by
    ``offsets`` says where each token's bytes go, and must fit the ids."""
    kept = tokens.drop(out)
    schema = StructType(
        [*kept.select(F.struct("*").alias("row")).schema, StructField(out, BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ids_in")
            counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            at = batch.column("at_in").flatten().to_numpy() if offsets else None
            text = decode_ids(column.flatten().to_numpy(), counts, path, at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(text, pa.binary())], names=schema.names
            )

    rows = kept.select(
        F.struct("*").alias("row"),
        kept[ids].alias("ids_in"),
        *([F.when(kept[ids].isNotNull(), kept[offsets]).alias("at_in")] if offsets else []),
    )
    return rows.mapInArrow(run, schema).select("row.*", out)
