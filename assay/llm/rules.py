"""Line-first quality rules, in SQL expressions alone.

Every line is judged by itself: punctuation at its end, navigation marks, symbols, capitals and
boilerplate phrases. A long line is not failed for its last mark or for a phrase. Lines that fail go,
and so do later copies of a line. A document is then rejected if too many of its words went with them,
or if it is short or repeats itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.text import words

FEWEST_WORDS = 50
MOST_REPEATED_PERCENT = 50
MOST_LOST_PERCENT = 40

#: From so many characters on, a line's last mark and a phrase in it do not fail it.
LONG_LINE = 200

# Blanks after a line, what it may end with (in other scripts any mark but bullets and
# commas), symbols, navigation marks and boilerplate phrases.
BLANKS = (
    " \t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"
)
LINE_END = r"""[.!?:;"')]|[\p{Po}\p{Pe}\p{Pf}&&[^\x00-\x7F•·،、，]]"""
SYMBOLS = r"[#*$%&|<>]"
NAVIGATION = r"[|>»•·]"
CAPITALS = r"\p{Lu}{2,}"
BOILERPLATE = (
    r"(?i)cookie|copyright|rights reserved|licensed under|released under the|javascript|"
    r"click here|subscribe|terms of (use|service)|privacy policy|lorem ipsum|"
    r"rechte vorbehalten|datenschutzerkl|nutzungsbedingungen|hier klicken|droits r.serv|"
    r"politique de confidentialit|mentions l.gales|cliquez ici|derechos reservados|"
    r"pol.tica de privacidad|haga clic"
)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, also where lambdas refer to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def line_passes(line: Column, long_line: int | None = LONG_LINE) -> Column:
    """Whether a line holds prose. Its words are taken as its blanks and one more."""
    bare = F.rtrim(line, F.lit(BLANKS))
    weight = F.length(bare) - F.length(F.replace(bare, F.lit(" "), F.lit(""))) + 1
    long = F.lit(False) if long_line is None else F.length(bare) >= long_line
    return (
        (F.length(F.trim(bare)) > 0)
        & (long | F.rlike(F.right(bare, F.lit(1)), F.lit(LINE_END)))
        & (F.regexp_count(bare, F.lit(SYMBOLS)) * 10 <= weight)
        & (F.regexp_count(bare, F.lit(NAVIGATION)) * 5 < weight)
        & (F.regexp_count(bare, F.lit(CAPITALS)) * 2 <= weight)
        & (long | ~F.rlike(bare, F.lit(BOILERPLATE)))
    )


def repeated_words(tokens: Column) -> Column:
    """Words inside three-word windows found twice or more, the first finding included.

    Windows are compared by a 64-bit hash within their document. Positions of equal windows are found
    by sorting, and only in documents that have any.
    """

    def from_windows(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            let(
                F.array_sort(
                    F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
                ),
                from_sorted,
            )
        )

    def from_sorted(ordered: Column) -> Column:
        def twin(e: Column, k: Column) -> Column:
            before, after = F.get(ordered, k - 1)["h"], F.get(ordered, k + 1)["h"]
            return F.coalesce(e["h"] == before, F.lit(False)) | F.coalesce(
                e["h"] == after, F.lit(False)
            )

        places = F.array_sort(F.transform(F.filter(ordered, twin), lambda e: e["i"]))
        return let(places, covered)

    def covered(places: Column) -> Column:
        reach = F.transform(
            places, lambda p, k: F.least(F.coalesce(F.get(places, k + 1) - p, F.lit(3)), F.lit(3))
        )
        return F.aggregate(reach, F.lit(0), lambda total, x: total + x)

    def windows(tokens: Column) -> Column:
        hashed = F.transform(
            tokens, lambda w, i: F.xxhash64(w, F.get(tokens, i + 1), F.get(tokens, i + 2))
        )
        return F.slice(hashed, F.lit(1), F.greatest(F.size(tokens) - 2, F.lit(0)))

    return let(windows(tokens), from_windows)


def measure(
    docs: DataFrame, *, text: str = "text", long_line: int | None = LONG_LINE
) -> DataFrame:
    """``row``, the counts of the whole text, the cleaned text and the verdict.

    A null text counts as empty: no words, so it fails. Lines end at line feeds; a line of blanks
    alone has no word, is not counted as a copy, and is dropped from the cleaned text. Lines of
    ``long_line`` characters or more are spared two rules; with None, no line is. Columns of
    ``docs`` stay inside ``row``, so none can clash. Equal rows get equal results.
    """
    body = F.coalesce(F.col("text_in"), F.lit(""))
    base = docs.select(F.struct("*").alias("row"), docs[text].cast("string").alias("text_in"))
    # The arrays go from one select to the next by name: each is worked out once a document.
    tokens = base.select("row", body.alias("body"), words(F.col("text_in")).alias("tokens"))
    kept_lines = F.filter(F.split(F.col("body"), "\n"), lambda line: line_passes(line, long_line))
    spoken = F.filter(
        F.split(F.col("body"), "\n"), lambda line: F.length(F.trim(F.translate(line, "\t\x0b\x0c\r", "    "))) > 0
    )
    counted = tokens.select(
        "row",
        F.size("tokens").cast("bigint").alias("n_words"),
        F.length(F.array_join("tokens", "")).cast("bigint").alias("word_chars"),
        F.regexp_count(F.col("body"), F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        let(spoken, lambda s: F.size(s) - F.size(F.array_distinct(s))).cast("bigint").alias("n_dup_lines"),
        let(F.col("tokens"), repeated_words).cast("bigint").alias("n_repeat_words"),
        F.array_join(F.array_distinct(kept_lines), "\n").alias("clean_text"),
    )
    judged = counted.withColumn(
        "kept_words", F.size(words(F.col("clean_text"))).cast("bigint")
    ).withColumn(
        "base_failed",
        (F.col("n_words") < FEWEST_WORDS)
        | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT),
    )
    lost = (F.col("n_words") - F.col("kept_words")) * 100
    return judged.withColumn(
        "kept", ~F.col("base_failed") & (lost <= F.col("n_words") * MOST_LOST_PERCENT)
    )


def clean(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """The kept documents with their failing lines removed from ``text``; other columns as they were.
    Null, empty and short texts go, for they fail; equal rows stay or go together."""
    kept = measure(docs, text=text).filter("kept")
    return kept.select(
        *[
            (F.col("clean_text") if name == text else F.col("row")[name]).alias(name)
            for name in docs.columns
        ]
    )
