"""Quality rules, line first: clean each line, then judge what is left of the document.

DataFrame functions only; nothing is shuffled, every document is judged by itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW_WORDS = 8

# Ends of sentences, and words of site navigation and boilerplate.
SENTENCE_END = r"[.!?…。！？:;][\"'”’»)\]*]*[\x20\x09-\x0D]*$"
NAVIGATION = r"(?i)^\W*(home|menu|log ?in|log ?out|sign (in|up)|next( page)?|prev(ious)?( page)?|back to top|skip to (main )?content|read more|share|search|contact( us)?|about( us)?|sitemap)\b"
BOILERPLATE = r"(?i)lorem ipsum|all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|(we )?uses? cookies|enable javascript|javascript is (disabled|required)"


@dataclass(frozen=True)
class Rules:
    """Limits of the rules. Shares are of the document's word characters."""

    min_words: int = 20
    max_repeat_percent: int = 30
    short_line_words: int = 10  # a line this short must end as a sentence does
    navigation_words: int = 6  # longest line that can be navigation
    max_line_symbol_share: float = 0.3  # symbols a word of the line
    max_lost_share: float = 0.5


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _line_fails(line: Column, rules: Rules) -> Column:
    n = _count(line, WORD)
    return (
        ((n < rules.short_line_words) & ~line.rlike(SENTENCE_END))
        | ((n <= rules.navigation_words) & line.rlike(NAVIGATION))
        | line.rlike(BOILERPLATE)
        | (_count(line, SYMBOL) > n * F.lit(rules.max_line_symbol_share))
        | line.contains("{")
    )


def measured(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """documents with a struct column `quality` of counts and verdicts.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_chars (word
    characters of the lines that fail), base_failed, kept, cleaned (the lines that pass,
    joined by \\n). A null text counts as an empty one: no words, base_failed, not kept,
    cleaned ''. Other columns, null or not, are carried along untouched; so are repeated
    rows. Column names that start with __q are taken.
    """
    carried = documents.columns
    rows = documents.withColumn("__q", F.coalesce(F.col("text"), F.lit("")))
    rows = rows.select(
        *[F.col(f"`{c}`") for c in carried],
        "__q",
        F.regexp_extract_all("__q", F.lit(f"({WORD})")).alias("__qw"),
        F.filter(F.split("__q", "\n"), lambda x: x.rlike(WORD)).alias("__ql"),
    )
    rows = rows.withColumns(
        {
            # A window by the 64-bit hash of its words.
            "__qh": F.when(
                F.size("__qw") >= WINDOW_WORDS,
                F.transform(
                    F.sequence(F.lit(1), F.size("__qw") - (WINDOW_WORDS - 1)),
                    lambda i: F.xxhash64(F.slice("__qw", i, WINDOW_WORDS)),
                ),
            ).otherwise(F.array().cast("array<bigint>")),
            "__qn": F.size("__qw").cast("long"),
            "__qf": F.transform(
                "__ql",
                lambda x: F.struct(x.alias("line"), _line_fails(x, rules).alias("fails")),
            ),
        }
    )
    rows = rows.withColumn("__qr", _repeat_words(F.col("__qh")))
    chars = lambda text: F.length(F.regexp_replace(text, BLANK, "")).cast("long")
    rows = rows.withColumns(
        {
            "__qc": chars(F.col("__q")),
            "__qx": F.aggregate(
                F.filter("__qf", lambda x: x["fails"]),
                F.lit(0).cast("long"),
                lambda total, x: total + chars(x["line"]),
            ),
            "__qb": (F.col("__qn") < rules.min_words)
            | (100 * F.col("__qr") > rules.max_repeat_percent * F.col("__qn")),
        }
    )
    quality = F.struct(
        F.col("__qn").alias("n_words"),
        F.col("__qc").alias("word_chars"),
        _count(F.col("__q"), SYMBOL).alias("n_symbols"),
        (F.size("__ql") - F.size(F.array_distinct("__ql"))).cast("long").alias("n_dup_lines"),
        F.col("__qr").alias("n_repeat_words"),
        F.col("__qx").alias("lost_chars"),
        F.col("__qb").alias("base_failed"),
        (~F.col("__qb") & (F.col("__qx") <= F.col("__qc") * F.lit(rules.max_lost_share))).alias("kept"),
        F.array_join(
            F.transform(F.filter("__qf", lambda x: ~x["fails"]), lambda x: x["line"]), "\n"
        ).alias("cleaned"),
    )
    return rows.select(*[F.col(f"`{c}`") for c in carried], quality.alias("quality"))


def _repeat_words(hashes: Column) -> Column:
    """Words covered by windows found twice or more, from the hash of each window.

    Most texts repeat none, which the distinct hashes show. Else the (hash, position)
    pairs are sorted, so equal windows are neighbours, and the positions that repeat are
    sorted again: each adds the words up to the next one, a window's length at most.
    """
    pairs = F.array_sort(
        F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i")))
    )
    # Neighbours are compared by zipping the pairs with themselves, moved by one.
    none = F.array(F.struct(F.lit(None).cast("bigint").alias("h"), F.lit(None).cast("bigint").alias("i")))
    beside = F.arrays_zip(
        pairs.alias("x"),
        F.concat(none, pairs).alias("before"),
        F.concat(F.slice(pairs, 2, F.greatest(F.size(pairs), F.lit(1))), none).alias("after"),
    )
    found = F.array_sort(
        F.transform(
            F.filter(
                beside,
                lambda p: p["x"]["h"].isNotNull()
                & (p["x"]["h"].eqNullSafe(p["before"]["h"]) | p["x"]["h"].eqNullSafe(p["after"]["h"])),
            ),
            lambda p: p["x"]["i"],
        )
    )
    gaps = F.aggregate(
        found,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW_WORDS).cast("long").alias("last")),
        lambda a, i: F.struct(
            (a["n"] + F.least(i - a["last"], F.lit(WINDOW_WORDS).cast("long"))).alias("n"), i.alias("last")
        ),
        lambda a: a["n"],
    )
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), gaps).otherwise(F.lit(0).cast("long"))
