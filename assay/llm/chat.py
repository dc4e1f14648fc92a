"""Chat formatting with role repair of least cost.

A legal conversation is an optional system turn, then user and assistant in turn, from a user turn on.
The automaton's state is the role of the last turn that was put out. Each given turn is put out as it
is, put out under another role, put out behind an inserted empty turn, or merged into the turn before;
dynamic programming finds the cheapest legal sequence.

A turn acts on the states as a matrix of costs, and such matrices multiply associatively (sums, minima).
Turns are sorted into pieces by conversation and turn, so a conversation of any length is spread over
pieces. A piece sums its first and last conversation up in a matrix each; the matrices of a conversation
are chained in one task to find the states at its seams, which are joined back by piece, and every piece
then repairs its own turns.

Markers are ``<|`` and what follows. A text that holds ``<|`` would forge them, so a backslash is put in
between; where there are some already, one more, so that :func:`unescaped` finds the text again.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from assay.workspace import new_folder

ROLES = ("system", "user", "assistant")
START = "start"
STATES = (START, *ROLES)
#: What may follow each state, and where a conversation may end.
FOLLOWS = {START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
ENDS = ("user", "assistant")

# Costs. A role that is none of the three has to be replaced, which is cheap.
MERGE, INSERT, RELABEL, NAME = 1, 2, 3, 1
KEPT, MERGED, RELABELLED = "keep", "merge", "relabel"

PIECE_BYTES = 8 << 20
_NEVER = 1 << 30
_MARKER = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\*)\\\|")


@lru_cache(maxsize=None)
def moves(role: str | None) -> tuple[tuple[int, int, int, str, str, str | None], ...]:
    """(from, to, cost, action, role put out, role inserted before) of a turn, the preferred first."""
    found = []
    for at, state in enumerate(STATES):
        for out in ROLES:
            change = 0 if out == role else (RELABEL if role in ROLES else NAME)
            action = RELABELLED if change else KEPT
            if out in FOLLOWS[state]:
                found.append((at, STATES.index(out), change, action, out, None))
            for between in FOLLOWS[state]:
                if out in FOLLOWS[between]:
                    found.append((at, STATES.index(out), change + INSERT, action, out, between))
            if state == out:
                found.append((at, at, change + MERGE, MERGED, out, None))
    rank = (KEPT, MERGED, RELABELLED)
    found.sort(key=lambda m: (m[2], rank.index(m[3]), m[5] is not None, m[0], m[1]))
    return tuple(found)


def forward(costs: Sequence[int], roles: Sequence[str | None]) -> list[list[int]]:
    """The least cost of each state before the first turn and after every turn."""
    table = [list(costs)]
    for role in roles:
        after = [_NEVER] * len(STATES)
        for at, to, cost, *_ in moves(role):
            after[to] = min(after[to], table[-1][at] + cost)
        table.append(after)
    return table


def matrix(roles: Sequence[str | None]) -> list[int]:
    """The cost from each state to each over these turns, row after row."""
    n = len(STATES)
    return [
        cost
        for at in range(n)
        for cost in forward([0 if i == at else _NEVER for i in range(n)], roles)[-1]
    ]


def end_costs(last: bool) -> list[int]:
    return [0 if state in ENDS else _NEVER for state in STATES] if last else [0] * len(STATES)


@lru_cache(maxsize=100_000)
def _repair(roles: tuple[str | None, ...], start: int, end: int | None):
    begin = [0 if i == start else _NEVER for i in range(len(STATES))]
    table = forward(begin, roles)
    closing = table[-1]
    if end is None:
        # A conversation of a system turn alone is closed by making it a user's.
        closing = [a + b for a, b in zip(closing, end_costs(True))]
        end = closing.index(min(closing))
    path, state = [], end
    for i in range(len(roles) - 1, -1, -1):
        move = next(
            m for m in moves(roles[i]) if m[1] == state and table[i][m[0]] + m[2] == table[i + 1][state]
        )
        path.append(move)
        state = move[0]
    return tuple(reversed(path))


def repair(roles: Sequence[str | None], start: int = 0, end: int | None = None):
    """The cheapest moves over the turns; among equals the last turn settles first, as ``moves`` ranks.

    ``end`` is the state to arrive at, or None at the end of a conversation.
    """
    return _repair(tuple(roles), start, end)


def seams(pieces: list[tuple[int, object, list[int]]]) -> dict[tuple[int, object], tuple[int, int | None]]:
    """The states at both ends of each piece's share of a conversation; ``None``: it ends there.

    ``pieces`` are (piece, conversation, matrix) in order. Shares of one conversation stand together.
    """
    n = len(STATES)
    out = {}
    for _, shares in groupby(pieces, key=lambda p: (p[1] is None, p[1])):
        shares = list(shares)
        table = [[0] + [_NEVER] * (n - 1)]
        for _, _, cost in shares:
            table.append([min(table[-1][a] + cost[n * a + b] for a in range(n)) for b in range(n)])
        closing = [a + b for a, b in zip(table[-1], end_costs(True))]
        state = closing.index(min(closing))
        for i in range(len(shares) - 1, -1, -1):
            piece, conversation, cost = shares[i]
            before = min(range(n), key=lambda a: (table[i][a] + cost[n * a + state], a))
            out[piece, conversation] = (before, None if i == len(shares) - 1 else state)
            state = before
    return out


def escaped(text: str) -> str:
    """A text that holds no marker."""
    return _MARKER.sub(r"<\1\\|", text) if "|" in text else text


def unescaped(text: str) -> str:
    """The text that :func:`escaped` made this of."""
    return _ESCAPED.sub(r"<\1|", text)


def render(move, text: str, first: bool, last: bool) -> str:
    """A turn's part of the rendered conversation; the parts in order make up the whole."""
    _, _, _, action, out, inserted = move
    if action == MERGED:
        head = "\n"
    else:
        head = "" if first else "<|end|>\n"
        if inserted:
            head += f"<|{inserted}|>\n<|end|>\n"
        head += f"<|{out}|>\n"
    return head + escaped(text) + ("<|end|>\n" if last else "")


def _role(value: str | None) -> str | None:
    return (value or "").strip().lower() or None


def format_chat(turns: DataFrame) -> DataFrame:
    """``row``, ``action``, ``role_out``, ``inserted``, ``cost`` and ``rendered`` of every turn.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``. Turns go by number (null first), then
    role, then text; rows without a ``conv_id`` are one conversation. Roles are compared without case
    and outer blanks; a null or other role may become any of the three. A null text is empty. A
    conversation must not end with its system turn, so a lone one becomes a user's. The ``rendered``
    parts of a conversation, joined in order, are its text; markers inside the turns' own texts are
    escaped. Columns of ``turns`` stay inside ``row``, so none can clash.
    """
    spark = turns.sparkSession
    size = turns.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    pieces = max(1, -(-size // PIECE_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col(name) for name in ("conversation", "turn_no", "role_in", "body", "nonce")]
    path = f"{new_folder(spark)}/pieces"
    (
        turns.select(
            F.struct("*").alias("row"),
            F.col("conv_id").cast("string").alias("conversation"),
            F.col("turn").alias("turn_no"),
            F.col("role").cast("string").alias("role_in"),
            F.col("text").cast("string").alias("body"),
            # Only parts rows that are equal in all that counts.
            F.monotonically_increasing_id().alias("nonce"),
        )
        .repartitionByRange(pieces, *order)
        .sortWithinPartitions(*order)
        .select(
            "row",
            "conversation",
            "role_in",
            "body",
            F.spark_partition_id().alias("piece"),
            F.monotonically_increasing_id().alias("place"),
        )
        .write.parquet(path)
    )
    stored = spark.read.parquet(path)

    def shares(table: pa.Table) -> list[tuple[str | None, list[str | None], list[int]]]:
        """Conversations of a piece in order: id, roles and the rows that hold them."""
        place = table.column("place").to_pylist()
        rows = sorted(range(len(place)), key=place.__getitem__)
        names, roles = table.column("conversation").to_pylist(), table.column("role_in").to_pylist()
        return [
            (name, [_role(roles[i]) for i in own], own)
            for name, own in ((n, list(g)) for n, g in groupby(rows, key=names.__getitem__))
        ]

    def summed(table: pa.Table) -> pa.Table:
        found = shares(table)
        edges = found if len(found) < 3 else [found[0], found[-1]]
        piece = table.column("piece")[0].as_py()
        return pa.table(
            {
                "piece": pa.array([piece] * len(edges), pa.int32()),
                "at": pa.array(range(len(edges)), pa.int32()),
                "conversation": pa.array([name for name, _, _ in edges], pa.string()),
                "cost": pa.array([matrix(roles) for _, roles, _ in edges], pa.list_(pa.int32())),
            }
        )

    by_piece = stored.groupBy("piece")
    # Two rows a piece, whatever it holds.
    ends = by_piece.applyInArrow(summed, "piece int, at int, conversation string, cost array<int>")

    def chained(table: pa.Table) -> pa.Table:
        shares = sorted(table.to_pylist(), key=lambda e: (e["piece"], e["at"]))
        known = seams([(e["piece"], e["conversation"], e["cost"]) for e in shares])
        return pa.table(
            {
                "piece": pa.array([piece for piece, _ in known], pa.int32()),
                "conversation": pa.array([name for _, name in known], pa.string()),
                "start": pa.array([start for start, _ in known.values()], pa.int32()),
                "end": pa.array([end for _, end in known.values()], pa.int32()),
            }
        )

    states = ends.groupBy("conversation").applyInArrow(
        chained, "piece int, conversation string, start int, end int"
    )

    schema = StructType(
        [
            stored.schema["row"],
            StructField("action", StringType()),
            StructField("role_out", StringType()),
            StructField("inserted", StringType()),
            StructField("cost", IntegerType()),
            StructField("rendered", StringType()),
        ]
    )

    def repaired(table: pa.Table, states: pa.Table) -> pa.Table:
        known = {
            name: (start, end)
            for name, start, end in zip(*(states.column(c).to_pylist() for c in ("conversation", "start", "end")))
        }
        texts = table.column("body").to_pylist()
        order, moves_, rendered = [], [], []
        for name, roles, rows in shares(table):
            start, end = known.get(name, (0, None))
            path = repair(roles, start, end)
            order += rows
            moves_ += path
            for i, (move, row) in enumerate(zip(path, rows)):
                last = end is None and i == len(rows) - 1
                rendered.append(render(move, texts[row] or "", move[0] == 0, last))
        return pa.table(
            {
                "row": table.column("row").take(pa.array(order)),
                "action": pa.array([m[3] for m in moves_], pa.string()),
                "role_out": pa.array([m[4] for m in moves_], pa.string()),
                "inserted": pa.array([m[5] for m in moves_], pa.string()),
                "cost": pa.array([m[2] for m in moves_], pa.int32()),
                "rendered": pa.array(rendered, pa.string()),
            }
        )

    return by_piece.cogroup(states.groupBy("piece")).applyInArrow(repaired, schema)
