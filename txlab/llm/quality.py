"""Line-first cleaning: rules per line, then a verdict on what the document has lost. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import WORD, words

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A document that loses more than this share of its characters is rejected.
MAX_LOST_PERCENT = 40
#: A line without end punctuation passes if it has this many words.
PROSE_WORDS = 8
#: Fragments are lines of at most so many characters.
SHORT_CHARS = 200
#: A line of any length fails if over one character in so many is a symbol.
SYMBOL_EACH = 10
SYMBOLS = r"[#*$%&|<>]"

#: A line is finished by one of these, with closing quotes or brackets after it.
FINISHED = r"""[.!?:;。！？…]["')\]}»”’]*[\x20\x09-\x0D]*$"""
#: Menus: three or more entries of at most 30 characters between separators, so no longer run without one.
SEPARATORS = "|»›•·>"
LONG_ENTRY = rf"[^{SEPARATORS}]{{31}}"
#: Whole words only, and together they must be so much of a line: prose may mention them.
BOILERPLATE_PERCENT = 40
BOILERPLATE = (r"(?i)(?<![\p{L}\p{N}])(((copyright|©|\(c\)).{0,60})?all rights reserved|privacy policy|cookie policy|terms of (use|service)|"
               r"((this|our) (web)?site )?uses cookies|accept (all )?cookies|enable javascript|click here|read more|sign up|log ?in|"
               r"subscribe (to|now)|newsletter|share (this|on)|follow us|skip to (main )?content|back to top|lorem ipsum)(?![\p{L}\p{N}])")


def line_fails(line: Column, prose_words: int = PROSE_WORDS) -> Column:
    """Which rule a line with a word breaks: ``punctuation``, ``navigation``, ``boilerplate``, or NULL for none."""
    fragment = ~line.rlike(FINISHED) & (F.size(words(line)) < prose_words)
    noisy = (F.regexp_count(line, F.lit(SYMBOLS)) * SYMBOL_EACH > F.length(line))
    menu = (F.regexp_count(line, F.lit(f"[{SEPARATORS}]")) >= 2) & ~line.rlike(LONG_ENTRY)
    phrases = F.length(line) - F.length(F.regexp_replace(line, BOILERPLATE, ""))
    stock = line.rlike(BOILERPLATE) & (phrases * 100 >= F.length(F.trim(line)) * BOILERPLATE_PERCENT)
    return (F.when(noisy, "punctuation").when(menu, "navigation").when(stock, "boilerplate")
            .when(F.length(line) > SHORT_CHARS, None).when(fragment, "punctuation"))


def clean_lines(docs: DataFrame, text: str = "text", max_lost_percent: int = MAX_LOST_PERCENT,
                prose_words: int = PROSE_WORDS) -> DataFrame:
    """``docs`` with ``cleaned`` (lines that pass, joined again), ``n_lines`` (lines with a word), ``n_removed_lines``,
    ``n_line_chars``, ``n_lost_chars`` (code points of lines with a word, and of those removed) and ``lost_too_much``.

    Lines end at a line feed. Lines without a word stay as they are, for they part paragraphs. A NULL text has no
    lines and loses nothing; its ``cleaned`` is NULL.
    """
    bare = F.coalesce(F.col(text), F.lit(""))
    judged = docs.withColumn("_lines", F.transform(F.split(bare, "\n"), lambda l: F.struct(
        l.alias("line"), l.rlike(WORD).alias("has"),
        F.when(l.rlike(WORD), line_fails(l, prose_words)).alias("rule"), F.length(l).alias("chars"))))
    has = F.filter("_lines", lambda x: x["has"])
    gone = F.filter("_lines", lambda x: x["rule"].isNotNull())
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda s, x: s + x["chars"])
    out = judged.select(
        *[c for c in docs.columns],
        F.when(F.col(text).isNotNull(), F.array_join(F.transform(F.filter("_lines", lambda x: x["rule"].isNull()), lambda x: x["line"]), "\n")).alias("cleaned"),
        F.size(has).cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_removed_lines"),
        total(has).alias("n_line_chars"), total(gone).alias("n_lost_chars"))
    return out.withColumn("lost_too_much", F.col("n_lost_chars") * 100 > F.col("n_line_chars") * max_lost_percent)


def text_figures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and ``base_failed``.

    Five-word windows are compared by a 64-bit hash of their words. Texts without a repeated window stop there; in
    the others the windows are sorted with their places, and the places covered by a repeated one are counted.
    Each array is a column of its own, so that it is computed once and not once for each element that needs it.
    """
    keep = list(docs.columns)
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.col("n_words").cast("int")
    lines = F.filter(F.split(t, "\n"), lambda l: l.rlike(WORD))
    d = docs.withColumn("_w", words(F.col(text))).withColumn("_l", lines)
    d = d.select(
        *keep, F.size("_w").cast("long").alias("n_words"), F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_1"))
    keep += ["n_words", "word_chars", "n_symbols", "n_dup_lines"]

    def part(c: Column, start: int, short: int) -> Column:
        return F.slice(c, start, F.greatest(n - short, F.lit(0)))

    five = F.transform("_1", lambda h, i: F.xxhash64(h, *[F.get("_1", i + k) for k in range(1, 5)]))
    d = d.select(*keep, part(five, 1, 4).alias("_5"))
    d = d.withColumn("_again", F.size(F.array_distinct("_5")) < F.size("_5"))
    d = d.select(*keep, F.when(F.col("_again"), F.sort_array(F.zip_with(
        "_5", F.sequence(F.lit(1), F.size("_5")), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_s"))
    before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice("_s", 1, F.size("_s") - 1))
    after = F.concat(F.slice("_s", 2, F.size("_s") - 1), F.array(F.lit(None).cast("struct<h:bigint,i:int>")))
    like_before = F.zip_with("_s", before, lambda a, b: F.struct(a["h"].alias("h"), a["i"].alias("i"), a["h"].eqNullSafe(b["h"]).alias("same")))
    at = F.zip_with(like_before, after, lambda a, b: F.when(a["same"] | a["h"].eqNullSafe(b["h"]), a["i"]))
    d = d.select(*keep, F.when(F.col("_s").isNotNull(), F.sort_array(F.filter(at, lambda i: i.isNotNull()))).alias("_at"))
    steps = F.zip_with("_at", F.concat(F.slice("_at", 2, F.size("_at") - 1), F.array(F.lit(None).cast("int"))),
                       lambda a, b: F.least(F.coalesce(b - a, F.lit(5)), F.lit(5)))
    covered = F.when(F.col("_at").isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), lambda s, x: s + x))
    # A later filter on the verdict must not be pushed below the figures: the optimizer would copy them into it, each
    # step several times the one before. A partition's number stops that. It is never negative, so decides nothing.
    d = d.select(*keep, covered.cast("long").alias("n_repeat_words"), F.spark_partition_id().alias("_partition"))
    failed = ((F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
              | (F.col("_partition") < 0))
    return d.withColumn("base_failed", failed).drop("_partition")


def judge(docs: DataFrame, text: str = "text", max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """``docs`` with the figures of both functions and ``kept``: no base rule failed, and not too much text lost.

    One pass without a shuffle; each row is judged by itself, so that repeated rows get equal verdicts. NULL and empty
    texts have no words and fail. Columns named like a
    figure or like a column used in between are replaced.
    """
    made = ["cleaned", "n_lines", "n_removed_lines", "n_line_chars", "n_lost_chars", "lost_too_much", "n_words",
            "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    plain = docs.drop(*made, "_lines", "_w", "_l", "_1", "_5", "_again", "_s", "_at", "_partition")
    out = text_figures(clean_lines(plain, text, max_lost_percent), text)
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("lost_too_much"))
