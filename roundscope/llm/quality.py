"""Quality rules: line-first cleaning, in DataFrame operations only.

Every line with a word is judged by itself, and lines that fail go:

- punctuation: a line fails if over a third of its words end in runs of marks (``!!``, ``???``), or if it has fewer
  than ``short_line`` words and does not end like a sentence;
- navigation: a line fails if at least one word in five is a bare separator, or if over a quarter of its words hold
  a symbol of ``#*$%&|<>``;
- boilerplate: a line fails if it holds a phrase of site furniture (cookie notices, licences, sign-in prompts).

A document whose remaining lines hold less than ``least_share`` of its word characters is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundscope.llm.common import text_rows

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
SENTENCE_END = (*".!?…。！？:;\"'”’»)]",)
MARKS = ("!!", "??", "!?", "?!")
SEPARATORS = "|»«›‹•·>/\\-"
MARKED_WORD = r"[!?]{2,}(?=[\x20\x09-\x0D]|$)"
SEPARATOR_WORD = r"(?<![^\x20\x09-\x0D])[|»«›‹•·>/\\-]+(?![^\x20\x09-\x0D])"
SYMBOL_WORD = r"[#*$%&|<>][^\x20\x09-\x0D]*"
PHRASES = (
    "cookie", "javascript", "privacy policy", "terms of use", "terms of service", "all rights reserved", "copyright",
    "released under", "licensed under", "subscribe", "newsletter", "sign in", "sign up", "log in", "login", "click here",
    "read more", "lorem ipsum",
)
MIN_WORDS = 50
REPEAT_PERCENT = 50
WINDOW = 3
SHORT_LINE = 8
LEAST_SHARE = 0.5


def words(text: Column) -> Column:
    """Runs of characters outside ASCII white space."""
    for blank in SPACE[1:]:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def occurrences(text: Column, characters: str) -> Column:
    """How many of the characters a text holds; passes over it once for each, without a regular expression."""
    rest = text
    for c in characters:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return F.length(text) - F.length(rest)


def any_of(text: Column, parts: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for p in parts:
        found = found | text.contains(p)
    return found


def packed_windows(tokens: Column, mask: Column) -> Column:
    """Word windows as sorted numbers: a hash in the upper bits, the window's place in the bits of ``mask``."""
    starts = F.sequence(F.lit(0), F.size(tokens) - WINDOW)
    hashed = F.transform(
        starts,
        lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(WINDOW)]).bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long")),
    )
    return F.when(F.size(tokens) > WINDOW, F.sort_array(hashed))


def same_upper(a: Column, b: Column, mask: Column) -> Column:
    return F.coalesce(a.bitwiseXOR(b).bitwiseAND(F.bitwise_not(mask)) == 0, F.lit(False))


def window_text(tokens: Column, place: Column) -> Column:
    return F.struct(*[F.get(tokens, place + k).alias(f"w{k}") for k in range(WINDOW)])


def places_by_words(tokens: Column) -> Column:
    """Starts of repeated windows, found by sorting the windows' words themselves."""
    starts = F.sequence(F.lit(0), F.size(tokens) - WINDOW)
    listed = F.sort_array(F.transform(starts, lambda i: F.struct(window_text(tokens, i).alias("w"), i.alias("at"))))
    beside = F.filter(listed, lambda x, j: F.coalesce((x["w"] == F.get(listed, j - 1)["w"]) | (x["w"] == F.get(listed, j + 1)["w"]), F.lit(False)))
    return F.sort_array(F.transform(beside, lambda x: x["at"]))


def covered(places: Column) -> Column:
    """Words that windows starting at ascending ``places`` cover."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    step = F.aggregate(
        places,
        zero,
        lambda s, p: F.struct((s["n"] + F.least(F.lit(WINDOW), p - s["last"])).alias("n"), p.alias("last")),
        lambda s: s["n"],
    )
    return F.coalesce(step, F.lit(0))


def failing_line(line: Column, short_line: int) -> Column:
    """Whether a line fails a rule; the columns q_has_* of its text tell which rules can fail at all."""
    n = F.size(words(line))
    ended = F.substring(F.rtrim(line, F.lit(SPACE)), -1, 1).isin(*SENTENCE_END)
    fragment = ~ended & (n < short_line)
    marked = F.col("q_has_marks") & (F.regexp_count(line, F.lit(MARKED_WORD)) * 3 > n)
    separated = F.col("q_has_separators") & (F.regexp_count(line, F.lit(SEPARATOR_WORD)) * 5 >= n)
    symbols = (F.col("n_symbols") > 0) & (F.regexp_count(line, F.lit(SYMBOL_WORD)) * 4 > n)
    furniture = F.col("q_has_phrase") & any_of(F.lower(line), PHRASES)
    return fragment | marked | separated | symbols | furniture


def judged_rows(rows: DataFrame, text: str, short_line: int = SHORT_LINE, least_share: float = LEAST_SHARE) -> DataFrame:
    """``rows`` with the counts and the verdict beside them; the text column holds no null."""
    t, tokens, lines, kept = F.col(text), F.col("q_words"), F.col("q_lines"), F.col("q_kept")
    rows = rows.withColumns(
        {
            "q_words": words(t),
            "q_lines": F.filter(F.split(t, "\n"), lambda l: l.rlike(WORD)),
            "q_has_marks": any_of(t, MARKS),
            "q_has_separators": any_of(t, (*SEPARATORS,)),
            "q_has_phrase": any_of(F.lower(t), PHRASES),
            "n_symbols": occurrences(t, SYMBOLS).cast("long"),
        }
    )
    # Places of windows fit into as many low bits as the number of words has.
    rows = rows.withColumn("q_mask", F.expr("shiftleft(1L, length(bin(size(q_words)))) - 1L"))
    s, mask = F.col("q_packed"), F.col("q_mask")
    rows = rows.withColumns(
        {
            "q_packed": packed_windows(tokens, mask),
            "q_kept": F.filter(lines, lambda l: ~failing_line(l, short_line)),
            "n_words": F.size(tokens).cast("long"),
            "word_chars": F.length(F.array_join(tokens, "")).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_lines": F.size(lines).cast("long"),
        }
    )
    rows = rows.withColumn(
        "q_beside", F.filter(s, lambda x, j: same_upper(x, F.get(s, j - 1), mask) | same_upper(x, F.get(s, j + 1), mask))
    )
    d = F.col("q_beside")
    place = lambda x: x.bitwiseAND(mask).cast("int")
    # Different windows of one hash stand side by side somewhere; such a text is looked at by its words.
    clash = F.exists(
        F.sequence(F.lit(1), F.size(d) - 1),
        lambda j: same_upper(F.get(d, j), F.get(d, j - 1), mask)
        & (window_text(tokens, place(F.get(d, j))) != window_text(tokens, place(F.get(d, j - 1)))),
    )
    by_hash = F.sort_array(F.transform(d, place))
    rows = rows.withColumn(
        "q_places", F.when(F.coalesce(F.size(d), F.lit(0)) < 2, F.array().cast("array<int>")).when(clash, places_by_words(tokens)).otherwise(by_hash)
    )
    all_kept = F.size(kept) == F.size(lines)
    rows = rows.withColumns(
        {
            "n_repeat_words": covered(F.col("q_places")).cast("long"),
            "n_kept_lines": F.size(kept).cast("long"),
            "kept_chars": F.when(all_kept, F.col("word_chars")).otherwise(F.length(F.array_join(words(F.array_join(kept, "\n")), "")).cast("long")),
        }
    )
    rows = rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("kept_chars") >= least_share * F.col("word_chars")))


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", short_line: int = SHORT_LINE, least_share: float = LEAST_SHARE) -> DataFrame:
    """One row per row of ``docs``: doc_id, counts, base_failed, kept, and the text of the lines that stay.

    Null and empty texts have no words: all counts are zero and they are rejected. Repeated rows are judged alike;
    other columns are not read. An empty table gives no rows.
    """
    rows = judged_rows(text_rows(docs, id_col, text_col), "text", short_line, least_share)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_kept_lines", "kept_chars"]
    return rows.select("doc_id", *counts, "base_failed", "kept", F.array_join("q_kept", "\n").alias("clean_text"))


def keep_good(docs: DataFrame, text_col: str = "text", short_line: int = SHORT_LINE, least_share: float = LEAST_SHARE) -> DataFrame:
    """Rows of documents that are kept, with all columns as they were.

    Null and empty texts go, repeated rows go or stay together; an empty table gives no rows.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("q_row")
    rows = docs.select(whole, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("q_text"))
    judged = judged_rows(rows, "q_text", short_line, least_share)
    # The row number keeps the filter above the columns it reads; below them Spark would repeat them in each other.
    return judged.withColumn("q_at", F.monotonically_increasing_id()).where("kept and q_at >= 0").select("q_row.*")
