r"""Quality rules, line first.

Every line is judged by itself: ``symbols`` (more than one of ``#*$%&|<>`` per
four words), ``shouting`` (an exclamation mark per two words or more),
``navigation`` (two or more separators with fewer than four words for each),
``boilerplate`` (a short line with a stock phrase) and ``punctuation`` (four
words or more without any sentence mark).  Failing lines are removed; a document
that loses more than ``max_lost`` of its characters is rejected.  Beside it
stand base measures of the whole text.  All of it happens inside a row: no
shuffle, whatever the number of documents per source.

Rows: one result row per row of the documents; extra columns are ignored by
``quality`` and carried along by ``cleaned``.  A null text counts as empty: no
words, ``base_failed``, not kept.  A null id stays null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.native import let, split_words

SYMBOLS = r"[#*$%&|<>]"
SENTENCE_MARKS = r"[.!?:;…。！？]"
SEPARATORS = r"[|»›·•]"
BOILERPLATE = (r"(?i)(^|[^a-z0-9])(all rights reserved|cookie policy|privacy policy|terms of (use|service)|"
               r"accept cookies|click here|sign (up|in)|log ?in|subscribe|read more|skip to content|"
               r"enable javascript|share (this|on)|lorem ipsum)($|[^a-z0-9])")
BOILERPLATE_WORDS = 12
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT, MAX_LOST = 10, 20, 0.5


def line_fails(line: Column) -> Column:
    """Whether a line breaks a rule; a blank line never does."""
    words = F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+"))
    return let(words, lambda n: (n > 0) & (
        (4 * F.regexp_count(line, F.lit(SYMBOLS)) > n)
        | (2 * (F.length(line) - F.length(F.replace(line, F.lit("!"), F.lit("")))) >= n)
        | let(F.regexp_count(line, F.lit(SEPARATORS)), lambda s: (s >= 2) & (n < 4 * (s + 1)))
        | ((n <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE))
        | ((n >= 4) & ~line.rlike(SENTENCE_MARKS))))


def kept_text(text: Column) -> Column:
    return F.array_join(F.filter(F.split(text, "\n"), lambda line: ~line_fails(line)), "\n")


def _repeat_words(words: Column) -> Column:
    """Words inside a window of WINDOW words that the text has at least twice."""
    def covered(hashes: Column) -> Column:
        n = F.size(hashes)
        placed = F.arrays_zip(hashes, F.sequence(F.lit(0), n - 1)).cast("array<struct<h:bigint,p:int>>")

        def count(ordered: Column) -> Column:
            again = F.filter(ordered, lambda x, i: ((i > 0) & (F.get(ordered, i - 1)["h"] == x["h"]))
                             | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)))
            places = F.sort_array(F.transform(again, lambda x: x["p"]))
            return F.aggregate(
                places, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
                lambda a, p: F.struct((a["n"] + p + WINDOW - F.greatest(p, a["end"])).alias("n"),
                                      (p + WINDOW).alias("end")),
                lambda a: a["n"])
        return F.when(F.size(F.array_distinct(hashes)) == n, 0).otherwise(let(F.sort_array(placed), count))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW),
                          lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))
    return F.when(F.size(words) <= WINDOW, 0).otherwise(let(windows, covered))


def _measures(words: Column, text: Column) -> dict[str, Column]:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _repeat_words(words).cast("long"),
    }


def _base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def quality(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            max_lost: float = MAX_LOST) -> DataFrame:
    """Per row: the base measures, ``base_failed``, the share of characters that the
    line rules remove (``lost``) and ``kept``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
        .select("id", text.alias("text"), split_words(text).alias("words"))
    judged = rows.select("id", *(c.alias(k) for k, c in _measures(F.col("words"), F.col("text")).items()),
                         F.when(F.length("text") == 0, F.lit(0.0))
                         .otherwise(1 - F.length(kept_text(F.col("text"))) / F.length("text")).alias("lost"))
    failed = _base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return judged.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", failed.alias("base_failed"), "lost",
                         (~failed & (F.col("lost") <= max_lost)).alias("kept"))


def cleaned(documents: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars",
            max_lost: float = MAX_LOST) -> DataFrame:
    """The documents that the rules keep, without their failing lines, in all their columns."""
    columns = documents.columns
    inner = F.coalesce(F.col("_row")[text_col].cast("string"), F.lit(""))
    rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_row")).select("_row", inner.alias("_text"))
    text = F.col("_text")
    enough = F.filter(F.array(kept_text(text)), lambda kept: F.length(kept) >= (1 - max_lost) * F.length(text))
    # bound variables and a generator: a filter would be pushed below and compute each part again and again
    kept = let(split_words(text), lambda words: F.when(
        ~_base_failed(F.size(words), _repeat_words(words)), enough))
    rows = rows.select("_row", F.explode_outer(kept).alias("_kept")).where(F.col("_kept").isNotNull())
    new = {text_col: F.col("_kept")}
    if chars_col in columns:
        new[chars_col] = F.length("_kept").cast(documents.schema[chars_col].dataType)
    return rows.select(*(new.get(c, F.col("_row")[c]).alias(c) for c in columns))
