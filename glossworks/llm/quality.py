"""Quality rules with thresholds from mergeable quantile sketches, in DataFrame functions only.

Fixed cut-offs judge a language or source by another's habits. Here each rule's
measure is sketched per language and source: counts in buckets of fixed width
(shares) or of fixed ratio (lengths), which merge by addition, have a known error
and give the same quantiles whatever the order of the rows. A source's sketch is
blended with that of its language, and that with the whole, as if `PRIOR` more
documents had been seen, so that small sources lean on large ones without a
switch. A rule's limit lies beyond the quantile at which its measure's ordinary
values end, by `spread` times the distance of that quantile from the median.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import BLANK_CHARS, BLANKS, LOWER, UPPER, materialize, row_key, small, words

#: measure: the quantile at which its ordinary values end (rules of repetition have long tails of sound texts, so theirs ends later),
#: whether the lower end is judged too, and its buckets: a width, or for lengths a ratio.
RULES = {
    "symbol_share": (0.90, False, 1 / 64),
    "dup_line_share": (0.995, False, 1 / 64),
    "repeat_share": (0.995, False, 1 / 64),
    "shout_share": (0.995, False, 1 / 64),
    "word_chars_mean": (0.90, True, 1.02),
}
LEAST_WORDS, MOST_REPEATED, WINDOW = 50, 50, 3
#: Documents that a level's sketch lends to the one below it, and the distance of a limit.
PRIOR, SPREAD = 20, 2.0
SYMBOLS = "#*$%&|<>"


def with_measures(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """keep and, as long (null text: empty): n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words, n_upper, n_letters."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    gone = lambda chars: (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(BLANK_CHARS))) > 0)
    rows = docs.select(
        *keep, words(text, BLANKS).alias("__w"), gone(BLANK_CHARS).alias("__blank"), F.length(text).alias("__len"), lines.alias("__l"),
        gone(SYMBOLS).alias("n_symbols"), gone(UPPER).alias("n_upper"), gone(UPPER + LOWER).alias("n_letters"),
    )
    # the windows sorted by hash: one whose neighbour is equal is found twice or more
    grams = F.arrays_zip(*[F.slice("__w", i + 1, F.greatest(F.size("__w") - (WINDOW - 1), F.lit(0))).alias(str(i)) for i in range(WINDOW)])
    rows = rows.select("*", F.sort_array(F.transform(grams, lambda g, i: F.struct(F.xxhash64(g).alias("h"), i.alias("i")))).alias("__s"))
    hash_at = lambda i: F.try_element_at(F.col("__s"), i)["h"]
    twice = F.filter("__s", lambda x, i: F.coalesce(hash_at(i + 2) == x["h"], F.lit(False)) | F.when(i > 0, hash_at(i) == x["h"]).otherwise(F.lit(False)))
    rows = rows.select("*", F.sort_array(F.transform(twice, lambda x: x["i"])).alias("__t"))
    # each adds the words that the one before it doesn't hold
    covered = F.aggregate(
        "__t", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")), lambda a, i: F.struct((a["n"] + F.least(i - a["last"], F.lit(WINDOW))).alias("n"), i.alias("last")), lambda a: a["n"]
    )
    return rows.select(
        *keep, F.size("__w").cast("long").alias("n_words"), (F.col("__len") - F.col("__blank")).cast("long").alias("word_chars"), "n_symbols",
        F.size("__l").cast("long").alias("n_lines"), (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"), "n_upper", "n_letters",
    )


def _shares(rows: DataFrame) -> DataFrame:
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return rows.withColumns(
        {"symbol_share": per("n_symbols", "word_chars"), "dup_line_share": per("n_dup_lines", "n_lines"), "repeat_share": per("n_repeat_words", "n_words"), "shout_share": per("n_upper", "n_letters"), "word_chars_mean": per("word_chars", "n_words")}
    )


def _bucket(rule: str) -> Column:
    step = RULES[rule][2]
    return F.floor(F.col(rule) / step if step < 1 else F.log(F.greatest(F.col(rule), F.lit(1.0))) / math.log(step)).cast("long")


def _edge(rule: str, bucket: Column) -> Column:
    """The lower end of a bucket."""
    step = RULES[rule][2]
    return bucket * F.lit(step) if step < 1 else F.pow(F.lit(step), bucket)


def sketches(rows: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """lang, source, rule, bucket, n: how many rows have a measure in a bucket. Sketches merge by adding n."""
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), _bucket(r).alias("bucket")) for r in RULES]))
    return rows.select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), each.alias("x")).groupBy("lang", "source", "x.rule", "x.bucket").agg(F.count("*").alias("n"))


def _blended(own: DataFrame, keys: list[str], above: DataFrame, above_keys: list[str]) -> DataFrame:
    """keys, rule, bucket, share: own sketches (keys, rule, bucket, n) to which the level above lends PRIOR documents, as shares of the whole."""
    groups = own.groupBy(*keys, "rule").agg(F.sum("n").alias("all"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in above_keys], F.col("rule") == F.col("__rule"))
    lent = above.select(*[F.col(k).alias(f"__{k}") for k in above_keys], F.col("rule").alias("__rule"), "bucket", "share")
    # exact sums: the order of the rows changes nothing
    lent = groups.join(small(lent), same).select(*keys, "rule", "bucket", (F.col("share") * PRIOR).cast("decimal(28,9)").alias("n"))
    both = own.select(*keys, "rule", "bucket", F.col("n").cast("decimal(28,9)").alias("n")).unionByName(lent).groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*keys, "rule")
    return both.withColumn("share", F.col("n").cast("double") / F.sum("n").over(whole).cast("double")).select(*keys, "rule", "bucket", "share")


def thresholds(rows: DataFrame, lang_col: str, source_col: str, spread: float = SPREAD) -> DataFrame:
    """__lang, __source and low_<rule>, high_<rule>: the limits of each language and source with a row."""
    narrow = materialize(sketches(rows, lang_col, source_col), "sketches")
    by_lang = narrow.groupBy("lang", "rule", "bucket").agg(F.sum("n").alias("n"))
    total = narrow.groupBy("rule", "bucket").agg(F.sum("n").alias("n"))
    every = total.withColumn("share", F.col("n").cast("double") / F.sum("n").over(Window.partitionBy("rule")).cast("double"))  # a row for each bucket of a rule
    lang = materialize(_blended(by_lang, ["lang"], every, []), "sketches-lang")
    found = _blended(narrow, ["lang", "source"], lang, ["lang"])
    own = Window.partitionBy("lang", "source", "rule").orderBy("bucket")
    ranked = found.withColumn("up_to", F.sum(F.col("share").cast("decimal(28,12)")).over(own))
    at = lambda p: F.min(F.when(F.col("up_to") >= p - 1e-9, F.col("bucket")))
    limits = []
    for rule, (p, both, _) in RULES.items():
        here = F.col("rule") == rule
        q = {name: _edge(rule, at(F.lit(x)) + up) for name, x, up in (("high", p, 1), ("middle_low", 0.5, 0), ("middle_high", 0.5, 1), ("low", 1 - p, 0))}
        high = q["high"] + spread * (q["high"] - q["middle_low"])
        low = q["low"] - spread * (q["middle_high"] - q["low"]) if both else F.lit(None).cast("double")
        limits.append((here, rule, high, low))
    # the quantiles of a group's rules
    per = ranked.groupBy("lang", "source", "rule").agg(*[c for _, rule, high, low in limits for c in (high.alias(f"high_{rule}"), low.alias(f"low_{rule}"))])
    pick = lambda side, rule: F.max(F.when(F.col("rule") == rule, F.col(f"{side}_{rule}"))).alias(f"{side}_{rule}")
    return per.groupBy(F.col("lang").alias("__lang"), F.col("source").alias("__source")).agg(*[pick(side, rule) for rule in RULES for side in ("low", "high")])


def _judged(docs: DataFrame, keep: dict[str, Column], text_col: str, lang_col: str, source_col: str, spread: float) -> DataFrame:
    """keep, the measures, base_failed and kept of each row; what is kept is written with the measures, so that no row has to be found again."""
    columns = {**keep, "__l0": F.col(lang_col), "__s0": F.col(source_col), "__text": F.col(text_col)}
    rows = with_measures(docs.select(*[c.alias(k) for k, c in columns.items()]), [*keep, "__l0", "__s0"], "__text")
    rows = _shares(materialize(rows, "measures"))
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    # what fails the base is no example of a group's habits
    limits = small(materialize(thresholds(rows.where(~base), "__l0", "__s0", spread), "limits"))
    within = F.lit(True)
    for rule, (_, both, _) in RULES.items():
        within = within & (F.col(rule) <= F.col(f"high_{rule}"))
        if both:
            within = within & (F.col(rule) >= F.col(f"low_{rule}"))
    joined = rows.join(limits, F.col("__l0").eqNullSafe(F.col("__lang")) & F.col("__s0").eqNullSafe(F.col("__source")), "left")
    return joined.withColumns({"base_failed": base, "kept": ~base & within})


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", spread: float = SPREAD) -> DataFrame:
    """id_col, key (row_key), the measures, base_failed, kept of each row.

    A null text counts as empty and fails the base; a null language or source is
    a group of its own; repeated rows count as often as they come; a measure at its
    limit stays within; an empty table gives an empty table, a very long text is one row. Windows are compared by 64-bit hashes within one text.
    """
    found = _judged(docs, {"__id": F.col(id_col), "key": row_key(id_col, text_col)}, text_col, lang_col, source_col, spread)
    return found.select(F.col("__id").alias(id_col), "key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The documents that verdicts() keeps, as they are; texts are written once and never shuffled."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return _judged(docs, {"__row": whole}, text_col, lang_col, source_col, SPREAD).where("kept").select("__row.*")
