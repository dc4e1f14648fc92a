"""The trie against a plain dictionary of prefixes, and its searches against scans."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from assay.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def _rebuilt(rows) -> dict[int, list[tuple[str, str]]]:
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {conv: [turn for _, turn in sorted(found)] for conv, found in turns.items()}
    out = {}
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 6
        family = int(conv / 100) * 100 if conv < 0 else conv - conv % 100
        out[conv] = own.get(family, [])[:h] + own[conv][h:]
    return out


def _plain(rows) -> Counter:
    convs = _rebuilt(rows)
    members = defaultdict(list)
    for conv, turns in convs.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
    children = Counter(prefix[:-1] for prefix in members if prefix)
    leaves, saved = Counter(), Counter()
    for prefix, these in members.items():
        for depth in range(len(prefix) + 1):
            leaves[prefix[:depth]] += not children[prefix]
            saved[prefix[:depth]] += (len(these) - 1) * len(prefix[-1][1]) if prefix else 0
    out = Counter()
    for prefix, these in members.items():
        ended = ",".join(str(c) for c in sorted(these) if len(convs[c]) == len(prefix))
        out[
            (
                min(these),
                len(prefix),
                min(members[prefix[:-1]]) if prefix else None,
                len(these),
                children[prefix],
                leaves[prefix],
                saved[prefix],
                hashlib.sha256(ended.encode()).hexdigest(),
            )
        ] += 1
    return out


def _found(spark, rows, partitions: int = 4, coalesce: bool = False) -> Counter:
    """The trie over many small blocks: partitions are not merged."""
    settings = {
        "spark.sql.adaptive.coalescePartitions.enabled": str(coalesce).lower(),
        "spark.sql.shuffle.partitions": str(partitions),
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        nodes = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA).repartition(5))
        return Counter(tuple(row) for row in nodes.collect())
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _random_rows(seed: int, convs: int, texts: int, longest: int, ids: int) -> list[tuple]:
    pick = random.Random(seed)
    rows = []
    for conv in pick.sample(range(ids), convs):
        for turn in range(pick.randint(1, longest)):
            rows.append((conv, turn, pick.choice("ua"), f"{'é' * pick.randint(0, texts)}"))
    return rows


@pytest.mark.parametrize("seed, partitions", [(1, 7), (2, 3)])
def test_random_conversations_over_blocks(spark, seed, partitions):
    rows = _random_rows(seed, convs=150, texts=1, longest=7, ids=3000)
    assert _found(spark, rows, partitions) == _plain(rows)


def test_whole_families(spark):
    rows = _random_rows(4, convs=200, texts=3, longest=9, ids=200)
    assert _found(spark, rows, coalesce=True) == _plain(rows)


def test_copies_of_one_conversation_over_blocks(spark):
    """A third of all conversations are the same, another third begin with it."""
    talk = [("user", "hi"), ("assistant", "what?"), ("user", "never mind")]
    more = [("assistant", "well"), ("user", "bye")]
    rows = []
    for conv in range(0, 90):
        turns = {0: talk, 1: talk + more, 2: [("user", f"own {conv}")]}[conv % 3]
        rows += [(conv, i, *turn) for i, turn in enumerate(turns)]
    assert _found(spark, rows, 5) == _plain(rows)


def test_edge_rows(spark):
    rows = [
        (None, 0, "user", "of no conversation"),
        (1, None, "user", "first"),
        (1, 0, None, "no role"),
        (1, 0, None, "no role"),
        (1, 1, "user", None),
        (1, 2, "user", ""),
        (2, None, None, None),
        (-7, 3, "user", "x" * 50_000),
        (100, 0, "a:b", "c"),
        (101, 0, "a", ":bc"),
        (9_000_000_000, 1, "user", "汉字 😀"),
        (300, 0, "user", "only turn"),
        (301, 0, "user", "only turn"),
        (399, 5, "assistant", "last"),
    ]
    assert _found(spark, rows, 5) == _plain(rows)


def test_turnless_conversations_and_empty_tables(spark):
    assert _found(spark, [(None, 1, "user", "x")]) == Counter()
    assert not prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count()
    # Rebuilt from a base that is not there: short ones lose all their turns.
    heads = [c for c in range(1, 60) if zlib.crc32(str(c).encode()) % 6 >= 2]
    rows = [(c, 0, "user", "lost") for c in heads]
    assert _found(spark, rows, 3) == _plain(rows)


def test_a_long_conversation_has_a_long_chain(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_TAIL_CHUNK", 50)
    rows = [(5, turn, "user", f"turn {turn}") for turn in range(170)]
    rows += [(105, turn, "user", f"turn {turn}") for turn in range(40)] + [(6, 0, "user", "short")]
    assert _found(spark, rows, 3) == _plain(rows)


def test_extents_against_scans():
    pick = np.random.default_rng(3)
    for n in (1, 2, 3, 17, 64, 65):
        lcp = pick.integers(0, 4, n)
        lcp[0] = -1
        table = prefix_trie.sparse_table(lcp)
        at, depth = pick.integers(0, n, 200), pick.integers(0, 4, 200)
        left, right = prefix_trie.extents(table, at, depth)
        least = prefix_trie.run_minimum(table, left, right)
        for i, d, a, b, m in zip(at, depth, left, right, least):
            first = last = i
            while first > 0 and lcp[first] >= d:
                first -= 1
            while last + 1 < n and lcp[last + 1] >= d:
                last += 1
            assert (a, b) == (first, last) and m == lcp[a : b + 1].min()
