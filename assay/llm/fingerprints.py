"""One-permutation MinHash with optimal densification and packed low-order bits, in SQL expressions.

A document's shingles (five words, or all of them if fewer) are hashed once. The upper bits of a hash
name its bin and each bin keeps its smallest hash. An empty bin borrows from a full one that a hash of
both bin numbers picks: the same walk over bins for every document, so two documents that share a full
bin agree on the borrowed value. Of each bin eight bits are stored, as two hex digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.rules import let
from assay.llm.text import words

SHINGLE = 5
BINS = 256
STORED_BITS = 8
_BIN_BITS = 8
_LARGEST = (1 << (64 - _BIN_BITS)) - 1
_STEPS = 8


def shingle_hashes(tokens: Column) -> Column:
    """64-bit hashes of the shingles, repeats included; none for a text without words."""

    def hashed(ids: Column) -> Column:
        def whole(ids: Column) -> Column:
            return F.array(F.aggregate(ids, F.lit(42).cast("bigint"), lambda a, x: F.xxhash64(a, x)))

        runs = F.transform(
            ids, lambda x, i: F.xxhash64(x, *[F.get(ids, i + k) for k in range(1, SHINGLE)])
        )
        return (
            F.when(F.size(ids) >= SHINGLE, F.slice(runs, F.lit(1), F.greatest(F.size(ids) - SHINGLE + 1, F.lit(0))))
            .when(F.size(ids) > 0, whole(ids))
            .otherwise(F.array().cast("array<bigint>"))
        )

    return let(F.transform(tokens, lambda w: F.xxhash64(w)), hashed)


def _bin(h: Column) -> Column:
    """-128 to 127, so that sorted hashes lie bin after bin."""
    return F.shiftright(h, 64 - _BIN_BITS)


def _is_empty(h: Column) -> Column:
    return h.bitwiseAND(F.lit(_LARGEST)) == _LARGEST


def bin_minima(hashes: Column) -> Column:
    """The smallest hash of each of the bins, in order; an empty bin shows the largest value of its own.

    One such value for each bin is sorted in with the hashes, and the first of each bin stays.
    """
    first = -(BINS // 2)
    largest = F.transform(
        F.sequence(F.lit(first).cast("bigint"), F.lit(first + BINS - 1).cast("bigint")),
        lambda b: F.shiftleft(b, 64 - _BIN_BITS).bitwiseOR(F.lit(_LARGEST)),
    )
    return let(
        F.array_sort(F.concat(hashes, largest)),
        lambda s: F.filter(
            s, lambda h, i: F.coalesce(_bin(h) != _bin(F.get(s, i - 1)), F.lit(True))
        ),
    )


def densified(minima: Column) -> Column:
    """The stored bits of all bins; an empty bin walks over bins until it meets a full one.

    The walk goes by a hash of the bin and the step. After ``_STEPS`` steps, which only short texts
    need, the full bin whose hash with this one is smallest lends its value.
    """
    low = F.lit((1 << STORED_BITS) - 1).cast("bigint")

    def filled(full: Column) -> Column:
        def met(b: Column, step: int) -> Column:
            place = F.pmod(F.xxhash64(b, F.lit(step)), F.lit(BINS)).cast("int")
            return let(F.get(minima, place), lambda h: F.when(~_is_empty(h), h))

        def nearest(b: Column) -> Column:
            rated = F.transform(
                full, lambda h: F.struct(F.xxhash64(b, _bin(h), F.lit(-1)).alias("at"), h.alias("h"))
            )
            return F.array_min(rated)["h"]

        def stored(h: Column) -> Column:
            lent = F.coalesce(*[met(_bin(h), step) for step in range(_STEPS)], nearest(_bin(h)))
            # Hashed with the bin once more: else all that lend one value would agree by one chance.
            return F.xxhash64(F.when(_is_empty(h), lent).otherwise(h), _bin(h)).bitwiseAND(low)

        return F.transform(minima, stored)

    return let(F.filter(minima, lambda h: ~_is_empty(h)), filled)


def packed(text: Column) -> Column:
    """The fingerprint as ``BINS * STORED_BITS / 64`` longs; all zero for a text without words."""
    per_long = 64 // STORED_BITS

    def pack(values: Column) -> Column:
        def joined(k: Column) -> Column:
            out = F.get(values, k * per_long)
            for i in range(1, per_long):
                out = F.shiftleft(out, STORED_BITS).bitwiseOR(F.get(values, k * per_long + i))
            return out

        return F.transform(F.sequence(F.lit(0), F.lit(BINS // per_long - 1)), joined)

    found = let(
        shingle_hashes(words(text)), lambda h: let(bin_minima(h), lambda m: let(densified(m), pack))
    )
    has_word = F.length(F.array_join(words(text), "")) > 0
    none = F.array_repeat(F.lit(0).cast("bigint"), BINS // per_long)
    return F.when(has_word, found).otherwise(none)


def as_text(fingerprint: Column) -> Column:
    """``BINS * STORED_BITS / 4`` lower-case hex digits."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(left: Column, right: Column) -> Column:
    """Estimated Jaccard similarity of the shingles of two packed fingerprints.

    The share of agreeing bins, less those that agree by chance: bits that are stored alone agree in
    one of 256 bins of unrelated texts. Two texts without words are alike (1.0).
    """
    chance = 2.0**-STORED_BITS
    lowest = F.lit(0x0101010101010101)

    def equal_bytes(a: Column, b: Column) -> Column:
        # Folded upon itself, a byte that differs leaves its lowest bit set.
        def folded(by: int) -> Callable[[Column], Column]:
            return lambda x: x.bitwiseOR(F.shiftrightunsigned(x, by))

        differ = a.bitwiseXOR(b)
        for by in (4, 2, 1):
            differ = let(differ, folded(by))
        return 64 // STORED_BITS - F.bit_count(differ.bitwiseAND(lowest))

    agree = F.aggregate(F.zip_with(left, right, equal_bytes), F.lit(0), lambda n, x: n + x)
    corrected = F.greatest((agree / F.lit(float(BINS)) - chance) / (1 - chance), F.lit(0.0))
    return F.when(left == right, F.lit(1.0)).otherwise(corrected)


def fingerprints(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``row`` (the document), and its ``packed`` fingerprint; a null text counts as empty.

    Equal texts, and texts whose words are equal, have equal fingerprints. Texts without words share
    the fingerprint of zeros. Columns of ``docs`` stay inside ``row``, so none can clash.
    """
    return docs.select(F.struct("*").alias("row"), packed(docs[text].cast("string")).alias("packed"))


def beside_next(rows: DataFrame, doc_id: Column, tie: Column, value: Column) -> DataFrame:
    """``rows`` with ``next``: the ``value`` of the row that follows by descending id.

    The last is followed by the first; a null id comes last, equal ids go by ``tie``. Ids are cut
    into ranges at some of their own quantiles, and a row that ends a range is sent along to the
    range that it follows on, so that no range needs another and no sort holds all rows.
    """
    spark = rows.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    found = rows.agg(
        F.percentile_approx(doc_id, shares, max(10_000, 10 * ranges)).alias("ends"),
        F.max(doc_id).alias("most"),
    ).first()
    ends = sorted(set(found["ends"] or []))
    bounds = F.array(*map(F.lit, ends)) if ends else F.array().cast("array<bigint>")

    # How many ends lie below an id, by halving.
    steps = [1 << k for k in reversed(range(max(len(ends), 1).bit_length()))]
    below = F.lit(0)
    if ends:
        below = F.aggregate(
            F.array(*map(F.lit, steps)),
            F.lit(0),
            lambda n, step: F.when(
                F.coalesce(F.get(bounds, n + step - 1) < F.coalesce(doc_id, F.lit(ends[0])), F.lit(False)),
                n + step,
            ).otherwise(n),
        )
    own = rows.withColumn("own_range", below).withColumns({"order_id": doc_id, "order_tie": tie})
    ends_range = F.coalesce(F.get(bounds, F.col("own_range")) == F.col("order_id"), F.lit(False))
    first = F.col("order_id").eqNullSafe(F.lit(found["most"]).cast("bigint"))
    sent = F.array_compact(
        F.array(
            F.struct(F.col("own_range").alias("range"), F.lit(False).alias("guest")),
            F.when(ends_range, F.struct((F.col("own_range") + 1).alias("range"), F.lit(True).alias("guest"))),
            F.when(first, F.struct(F.lit(0).alias("range"), F.lit(True).alias("guest"))),
        )
    )
    dealt = own.withColumn("to", F.explode(sent))
    order = Window.partitionBy("to.range").orderBy(
        F.col("to.guest"), F.col("order_id").desc_nulls_last(), F.col("order_tie").asc_nulls_first()
    )
    return (
        dealt.withColumn("next", F.lead(value).over(order))
        .filter(~F.col("to.guest"))
        .drop("own_range", "order_id", "order_tie", "to")
    )
