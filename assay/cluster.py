"""Session settings that depend on the size of the data."""

from __future__ import annotations

from math import isqrt

KIB, MIB, GIB = 2**10, 2**20, 2**30

# Bounds of what one task reads, shuffles or writes.
_SHUFFLE_BLOCK = 64 * KIB
_SMALLEST_PIECE = 128 * MIB
_LARGEST_PIECE = 2 * GIB
_LARGEST_SPLIT = GIB
_LARGEST_FILE = 512 * MIB


def session_settings(
    input_bytes: int, cores: int, *, expansion: float = 1.0
) -> dict[str, str]:
    """Settings for jobs over ``input_bytes`` of stored data on ``cores`` executor cores.

    ``expansion`` is how much larger the data is when shuffled than when stored: about 1 for plain CSV,
    3 or so for compressed Parquet. Splits are of stored bytes, shuffle pieces of expanded ones.

    Adaptive execution merges shuffle partitions that are too small but does not split those of an
    aggregate or a window, so their number must fit the largest shuffle from the start.

    A shuffle cuts the output of each of M map tasks into R blocks. With pieces of a fixed size both
    numbers grow with the data, and the blocks shrink until reading them is all seeks: at 100 TB in
    pieces of 128 MiB a block holds 180 bytes. So pieces grow with the square root of the data, which
    keeps a block near 64 KiB, up to what a task sorts with little spilling. From there on blocks
    shrink again: at 100 TB, in pieces of 2 GiB and splits of 1 GiB, one holds about 23 KB.
    """
    shuffled = int(input_bytes * expansion)
    piece = min(max(isqrt(shuffled * _SHUFFLE_BLOCK), _SMALLEST_PIECE), _LARGEST_PIECE)
    partitions = max(cores, -(-shuffled // piece))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Merging aims at this size, and a rebalanced write at files of about this much shuffled data.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(piece, _LARGEST_FILE)),
        # Without a piece for every core, keep all cores busy instead of merging up to that size.
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": str(
            shuffled < cores * piece
        ).lower(),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(min(piece, _LARGEST_SPLIT)),
        "spark.sql.session.timeZone": "UTC",
    }
