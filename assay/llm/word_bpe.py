"""BPE with word ends over a public vocabulary file: speculate, verify, and merge only what fails.

A text is cut at special tokens, normalised and split into words. For each new word the longest tokens
from left to right are proposed. A sequence of tokens is what the merges would make if, and only if,
every token is made by the merges from its own symbols, and every two neighbours stay apart when they
alone are merged: a merge across a seam would involve the last symbols of one token and the first of
the next, and nothing further off. So all seams of all new words are checked side by side, by undoing
the merges on both sides of each seam, latest first, and asking before each step whether the two
symbols that face each other would have merged first. Words with a failing seam are merged exactly.

Words and their ids are kept in a cache of bounded size.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import cache, cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

# Bounds of memory, not of results: words kept per worker, code points worked on at a time, and the
# longest word that is merged beside others.
CACHED_WORDS = 300_000
CHUNK_CHARS = 1_000_000
_SIDE_BY_SIDE = 40

#: Ends a word's bytes; it never occurs in UTF-8.
_END = b"\xff"
_NEVER = np.int64(1) << 40
#: A lone surrogate, which no text holds.
_MARK = "\udc00"

# The steps of a vocabulary file that this operator follows.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_PRE_TOKENIZERS = ["Split", "ByteLevel"]
_WORD_END = "</w>"


def _byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary: itself if it is visible in
    Latin-1, else the next free one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


@cache
def _unassigned() -> np.ndarray:
    """For each code point, whether Python's Unicode tables do not know it."""
    return np.array([unicodedata.category(chr(point)) == "Cn" for point in range(0x110000)])


class Words:
    """A vocabulary file: its splitting, its merges, and the bytes of each token."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, normalizer, splitter = spec["model"], spec["normalizer"], spec["pre_tokenizer"]
        steps = [step["type"] for step in normalizer["normalizers"]]
        cuts = [step["type"] for step in splitter["pretokenizers"]]
        if steps != _NORMALIZERS or cuts != _PRE_TOKENIZERS or model["end_of_word_suffix"] != _WORD_END:
            raise ValueError(f"{path} is not a lower-casing BPE with word ends")
        self._word = regex.compile(splitter["pretokenizers"][0]["pattern"]["Regex"])
        special = {entry["content"]: entry["id"] for entry in spec["added_tokens"]}
        self.special = special
        longest_first = sorted(special, key=len, reverse=True)
        self._special = regex.compile("|".join(f"({regex.escape(s)})" for s in longest_first) or r"(?!)")

        vocabulary: dict[str, int] = model["vocab"]
        size = max([*vocabulary.values(), *special.values()]) + 1
        self.names = [""] * size
        for name, i in [*vocabulary.items(), *special.items()]:
            self.names[i] = name
        # How each token is made: the rank of its merge and the two tokens; symbols have rank -1.
        self.rank = np.full(size, -1, np.int64)
        self.left = np.zeros(size, np.int64)
        self.right = np.zeros(size, np.int64)
        self._bytes: list[bytes | None] = [None] * size
        self._symbol: dict[bytes, int] = {}
        for letter, byte in _byte_letters().items():
            if byte == _END[0]:
                continue  # in no text, so in no word
            for end in (b"", _END):
                i = vocabulary[letter + (_WORD_END if end else "")]
                self._bytes[i] = bytes([byte]) + end
                self._symbol[self._bytes[i]] = i
        made_twice = set()
        pairs = np.empty((len(model["merges"]), 2), np.int64)
        for rank, (a, b) in enumerate(model["merges"]):
            x, y, made = vocabulary[a], vocabulary[b], vocabulary[a + b]
            if self._bytes[made] is not None:
                made_twice.add(made)
            else:
                self.rank[made], self.left[made], self.right[made] = rank, x, y
                parts = self._bytes[x], self._bytes[y]
                self._bytes[made] = None if None in parts else b"".join(parts)
            pairs[rank] = x << 32 | y, made
        self._made = pairs[:, 1]
        order = np.argsort(pairs[:, 0], kind="stable")
        self._pair_keys, self._pair_ranks = pairs[order, 0], order
        self._rank_of = dict(zip(pairs[:, 0].tolist(), range(len(pairs))))

        self._place_ids = np.array(
            [self._symbol.get(bytes([b]) + end, 0) for end in (b"", _END) for b in range(256)], np.int64
        )

        # Only tokens that the merges make from their own symbols may be proposed.
        tokens = [i for i in range(size) if self._bytes[i] is not None and i not in made_twice]
        self._proposed = {self._bytes[i]: i for i in tokens}
        ids = np.array([i for i in tokens if self.rank[i] >= 0], np.int64)
        unmade = ids[~self.apart(self.left[ids], self.right[ids], self.rank[ids])]
        # A token whose parts would merge otherwise is never made, nor is one built on it.
        lost = set(unmade.tolist())
        for i in ids[np.argsort(self.rank[ids])].tolist():
            if i in lost or int(self.left[i]) in lost or int(self.right[i]) in lost:
                lost.add(i)
                self._proposed.pop(self._bytes[i], None)
        # By symbol: the token that ends here, or -1, and what may follow.
        self._trie: dict = {}
        for raw, i in self._proposed.items():
            node = self._trie
            *inner, last = self._places(raw)
            for symbol in inner:
                node = node.setdefault(symbol, [-1, {}])[1]
            node.setdefault(last, [-1, {}])[0] = i
        # Special tokens stand among the words under names that no text can hold.
        self._fixed = {_MARK + name: i.to_bytes(4, "little") for name, i in special.items()}
        self._cache: dict[str, bytes] = dict(self._fixed)
        self._older: dict[str, bytes] = {}

    @staticmethod
    def _places(raw: bytes) -> list[int]:
        """The symbols of a token: bytes, and a byte that ends a word as another 256."""
        return list(raw) if raw[-1:] != _END else [*raw[:-2], raw[-2] + 256]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self._pair_keys, key), len(self._pair_keys) - 1)
        return np.where(self._pair_keys[at] == key, self._pair_ranks[at], _NEVER)

    def apart(
        self, left: np.ndarray, right: np.ndarray, before: np.ndarray | None = None
    ) -> np.ndarray:
        """Whether tokens that lie side by side would not merge across their seam; with ``before``,
        not before the merge of that rank.

        The two symbols at the seam are undone, the later made one first: of equal ones the right,
        as merges go from the left. A pair merges across the seam if its rank comes before that of
        the merge which took one of the two away; a merge on the right of equal rank comes later.
        """
        x, y = left.astype(np.int64), right.astype(np.int64)
        limit = np.full(len(x), _NEVER, np.int64) if before is None else before.astype(np.int64)
        good = np.ones(len(x), bool)
        at = np.arange(len(x))
        while len(at):
            crossing = self._ranks(x, y) < limit
            good[at[crossing]] = False
            made_x, made_y = self.rank[x], self.rank[y]
            going = ~crossing & (np.maximum(made_x, made_y) >= 0)
            at, x, y, limit = at[going], x[going], y[going], limit[going]
            made_x, made_y = made_x[going], made_y[going]
            undo_left = made_x > made_y
            limit = np.where(undo_left, made_x, made_y + 1)
            x, y = np.where(undo_left, self.right[x], x), np.where(undo_left, y, self.left[y])
        return good

    def propose(self, raw: bytes) -> list[int]:
        """The longest tokens from left to right; ``raw`` ends in the word's end."""
        symbols = self._places(raw)
        found, n, trie = [], len(symbols), self._trie
        at = 0
        while at < n:
            node, i, token = trie, at, -1
            while i < n and (hit := node.get(symbols[i])) is not None:
                ends, node = hit
                i += 1
                if ends >= 0:
                    token, at = ends, i
            found.append(token)
        return found

    def merge(self, raw: bytes) -> list[int]:
        """The ids of one word by its merges: the lowest rank first, from the left."""
        symbol = self._symbol
        ids = [symbol[raw[i : i + 1]] for i in range(len(raw) - 2)] + [symbol[raw[-2:]]]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of, made = self._rank_of, self._made
        heap = [
            (rank, i) for i in range(n - 1) if (rank := rank_of.get(ids[i] << 32 | ids[i + 1])) is not None
        ]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or rank_of.get(ids[i] << 32 | ids[j]) != rank:
                continue
            ids[i], ids[j] = int(made[rank]), -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (found := rank_of.get(ids[a] << 32 | ids[b])) is not None:
                    heapq.heappush(heap, (found, a))
        return [i for i in ids if i >= 0]

    def _merge_many(self, raws: list[bytes]) -> list[bytes]:
        """Words side by side: in each round every unfinished one makes its first merge."""
        done = [b""] * len(raws)
        if not raws:
            return done
        owner = np.arange(len(raws))
        lengths = np.fromiter(map(len, raws), np.int64, len(raws)) - 1
        places = np.fromiter((p for raw in raws for p in self._places(raw)), np.int64, int(lengths.sum()))
        ids = self._place_ids[places]
        rank = np.full(len(ids), _NEVER, np.int64)
        rank[:-1] = self._ranks(ids[:-1], ids[1:])
        rank[np.cumsum(lengths) - 1] = _NEVER
        while len(owner):
            heads = np.cumsum(lengths) - lengths
            best = np.minimum.reduceat(rank, heads)
            finished = best == _NEVER
            if finished.any():
                raw = ids.astype(np.int32).tobytes()
                starts = 4 * heads[finished]
                for k, a, b in zip(
                    owner[finished].tolist(), starts.tolist(), (starts + 4 * lengths[finished]).tolist()
                ):
                    done[k] = raw[a:b]
                stay = np.repeat(~finished, lengths)
                ids, rank = ids[stay], rank[stay]
                owner, lengths, best = owner[~finished], lengths[~finished], best[~finished]
                continue
            lowest = np.flatnonzero(rank == np.repeat(best, lengths))
            hits = lowest[np.searchsorted(lowest, heads)]
            ids[hits] = self._made[best]
            keep = np.ones(len(ids), bool)
            keep[hits + 1] = False
            ids, rank = ids[keep], rank[keep]
            hits -= np.arange(len(hits))
            lengths = lengths - 1
            heads = np.cumsum(lengths) - lengths
            inner = hits < heads + lengths - 1
            rank[hits[~inner]] = _NEVER
            rank[hits[inner]] = self._ranks(ids[hits[inner]], ids[hits[inner] + 1])
            back = hits[hits > heads]
            rank[back - 1] = self._ranks(ids[back - 1], ids[back])
        return done

    def _merged(self, words: list[str]) -> dict[str, bytes]:
        """The ids of new words, as 32-bit numbers in a row: proposed, verified, merged if need be."""
        if not words:
            return {}
        raws = [word.encode() + _END for word in words]
        proposals = list(map(self.propose, raws))
        counts = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter((i for ids in proposals for i in ids), np.int64, int(counts.sum()))
        owner = np.repeat(np.arange(len(words)), counts)
        inner = owner[:-1] == owner[1:]
        seams = flat[:-1][inner] << 32 | flat[1:][inner]
        distinct, which = np.unique(seams, return_inverse=True)
        holds = self.apart(distinct >> 32, distinct & 0xFFFFFFFF)[which]
        raw, ends = flat.astype(np.int32).tobytes(), (4 * np.cumsum(counts)).tolist()
        found = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        failed = np.unique(owner[:-1][inner][~holds]).tolist()
        short = [k for k in failed if len(raws[k]) <= _SIDE_BY_SIDE]
        for k, ids in zip(short, self._merge_many([raws[k] for k in short])):
            found[k] = ids
        for k in failed:
            if len(raws[k]) > _SIDE_BY_SIDE:
                found[k] = np.array(self.merge(raws[k]), np.int32).tobytes()
        return dict(zip(words, found))

    def ids(self, words: list[str]) -> list[bytes]:
        if len(self._cache) > CACHED_WORDS // 2:
            self._older, self._cache = self._cache, dict(self._fixed)
        known, older = self._cache, self._older
        new = []
        for word in set(words):
            if word not in known:
                if word in older:
                    known[word] = older[word]
                else:
                    new.append(word)
        known.update(self._merged(new))
        return list(map(known.__getitem__, words))

    def _split(self, text: str) -> list[str]:
        """Words of a text without special tokens. White space needs no replacing: it is in no word.
        Capitals are lowered one by one, so a final sigma is not told from others.

        Tables of characters differ between versions of Unicode, but only in what the older one has
        not assigned: a text with such a character is split by the tables of the library itself.
        """
        if not text.isascii():
            if _unassigned()[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any():
                normalizer, splitter = self._library
                text = normalizer.normalize_str(text)
                return [word for word, _ in splitter.pre_tokenize_str(text)]
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self._word.findall(text.lower())

    @cached_property
    def _library(self):
        from tokenizers import Regex, normalizers, pre_tokenizers

        return (
            normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]),
            pre_tokenizers.Split(Regex(self._word.pattern), "removed", invert=True),
        )

    def _words(self, text: str) -> list[str]:
        if not self.special or self._special.search(text) is None:
            return self._split(text)
        out = []
        for part in filter(None, self._special.split(text)):
            if part in self.special:
                out.append(_MARK + part)
            else:
                out += self._split(part)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has."""
        words = list(map(self._words, texts))
        found = self.ids([word for each in words for word in each])
        upto = np.append(0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4))
        edges = np.append(0, np.cumsum(np.fromiter(map(len, words), np.int64, len(words))))
        return np.frombuffer(b"".join(found), np.int32), np.diff(upto[edges])

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.names.__getitem__, ids))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Words:
    return Words(path)


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


def encode(docs: DataFrame, path: str, *, text: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` with ``ids``, and with ``decoded`` the text that they stand for.

    ``path`` names a vocabulary file that every node can open. A null or empty text has no ids, and
    decodes to an empty text. Columns of ``docs`` by these two names are replaced, all others pass
    through as they are; repeated rows give repeated rows.
    """
    added = [StructField("ids", ArrayType(IntegerType()))]
    if decoded:
        added.append(StructField("decoded", StringType()))
    kept = docs.drop(*[field.name for field in added])
    schema = StructType([*kept.select(F.struct("*").alias("row")).schema, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            done = 0
            for chunk in _chunks(batch.column("text_in")):
                flat, counts = words.encode(chunk)
                edges = np.append(0, np.cumsum(counts)).astype(np.int32)
                columns = [
                    batch.column("row").slice(done, len(chunk)),
                    pa.ListArray.from_arrays(pa.array(edges), pa.array(flat)),
                ]
                if decoded:
                    every = flat.tolist()
                    texts = [words.decode(every[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                    columns.append(pa.array(texts, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                done += len(chunk)

    rows = kept.select(F.struct("*").alias("row"), docs[text].cast("string").alias("text_in"))
    return rows.mapInArrow(run, schema).select("row.*", *[field.name for field in added])


def decode(tokens: DataFrame, path: str, *, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``tokens`` with the text of its ``ids`` in ``out``; null ids give an empty text."""
    kept = tokens.drop(out)
    schema = StructType([*kept.select(F.struct("*").alias("row")).schema, StructField(out, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            texts = [words.decode(found or []) for found in batch.column("ids_in").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string())], names=schema.names
            )

    rows = kept.select(F.struct("*").alias("row"), kept[ids].alias("ids_in"))
    return rows.mapInArrow(run, schema).select("row.*", out)
