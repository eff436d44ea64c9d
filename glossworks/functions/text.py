"""Column functions on text, and tables of sentences, clauses and tokens."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Contraction endings, longest first, and what they stand for.
CONTRACTIONS = (("n't", " not"), ("'re", " are"), ("'ve", " have"), ("'ll", " will"), ("'d", " would"), ("'m", " am"), ("'s", " is"))
#: Words that carry no gloss.
STOP_WORDS = (
    "a", "an", "the", "is", "are", "was", "were", "am", "be", "been", "being", "have", "has", "had", "do", "does", "did", "will", "would", "could", "should", "shall", "may", "might", "can", "must",
    "i", "me", "my", "mine", "we", "us", "our", "ours", "you", "your", "yours", "he", "him", "his", "she", "her", "hers", "it", "its", "they", "them", "their", "theirs", "this", "that", "these", "those",
    "and", "but", "or", "nor", "so", "yet", "for", "in", "on", "at", "to", "of", "by", "with", "from", "up", "as", "into", "about", "between", "through", "after", "before", "not", "no", "if", "then", "than",
    "when", "while", "who", "whom", "which", "what", "where", "how", "all", "each", "every", "both", "few", "more", "most", "some", "any", "such", "only", "own", "same", "too", "very", "just", "also",
    "now", "here", "there",
)
MAX_WORDS = 12


def normalize_unicode(c: Column) -> Column:
    """Curly quotes, dashes, ellipsis and no-break space as ASCII."""
    plain = F.translate(c, "‘’“”–—\xa0", "''\"\"-- ")
    return F.replace(plain, F.lit("…"), F.lit("..."))


def expand_contractions(c: Column) -> Column:
    """didn't: did not; in any case, wherever an ending stands, with straight or curly apostrophes."""
    return reduce(lambda t, x: F.regexp_replace(t, f"(?i){x[0]}", x[1]), CONTRACTIONS, F.translate(c, "‘’", "''"))


def split_sentences(df: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """keep, pos, sentence: the parts between runs of . ! ?, trimmed, blank ones left out, numbered from 0 among those kept."""
    parts = F.filter(F.transform(F.split(F.col(text_col), r"[.!?]+"), lambda s: F.trim(F.regexp_replace(s, r"[\s]+", " "))), lambda s: s != "")
    return df.select(*keep, F.posexplode(parts).alias("pos", "sentence"))


def pack_clauses(df: DataFrame, keep: list[str], sentence_col: str = "sentence", max_words: int = MAX_WORDS) -> DataFrame:
    """keep, clause_pos, clause: sentences of more words are cut at , ; : and dashes and filled up again to at most max_words."""
    count = lambda s: F.size(F.split(s, " "))
    s = F.trim(F.regexp_replace(F.col(sentence_col), r"\s+", " "))
    parts = F.filter(F.transform(F.split(s, r"\s*(?:[,;:]|–|—|--)\s*"), lambda p: F.trim(p)), lambda p: p != "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"))

    def fold(acc, part):
        joined = F.when(acc["now"] == "", part).otherwise(F.concat_ws(" ", acc["now"], part))
        fits = (acc["now"] == "") | (count(joined) <= max_words)
        return F.struct(
            F.when(fits, acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["now"]))).alias("done"),
            F.when(fits, joined).otherwise(part).alias("now"),
        )

    packed = F.aggregate(parts, start, fold, lambda acc: F.when(acc["now"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["now"]))))
    clauses = F.when(count(s) <= max_words, F.filter(F.array(s), lambda x: x != "")).otherwise(packed)
    return df.select(*keep, F.posexplode(clauses).alias("clause_pos", "clause"))


def clean_token(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")


def content_tokens(df: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """keep, pos, token: cleaned tokens but stop words and plain numbers; pos counts every token from 0."""
    tokens = df.select(*keep, F.posexplode(F.split(F.trim(F.col(text_col)), r"\s+")).alias("pos", "raw")).withColumn("token", clean_token(F.col("raw")))
    return content_words(tokens).drop("raw")


def content_words(tokens: DataFrame) -> DataFrame:
    """The rows whose token is neither blank nor a stop word nor a plain number."""
    return tokens.where((F.col("token") != "") & ~F.col("token").isin(*STOP_WORDS) & ~F.col("token").rlike(r"^[0-9]+$"))


def clean_id(c: Column) -> Column:
    """'' for null and nan, 123 for 123.0."""
    s = F.trim(c)
    return F.when(c.isNull() | (F.lower(s) == "nan"), "").when(s.rlike(r"^-?[0-9]+\.0+$"), F.regexp_replace(s, r"\.0+$", "")).otherwise(s)


def gloss_key(c: Column) -> Column:
    return F.replace(F.lower(F.trim(c)), F.lit("_"), F.lit(" "))


def sentence_key(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.trim(c), r"[.!?。！？\s]+$", ""))


def safe_id(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"[^A-Za-z0-9._-]+", "_")


def batch_name(c: Column) -> Column:
    """Lower case, runs of other than letters and digits as one dash, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def text_type(c: Column) -> Column:
    """sentence: white space within, or closed by a mark; else word."""
    t = F.btrim(c, F.lit(" \t\r\n"))
    return F.when(t.contains(" ") | t.rlike(r"[.!?]\z"), "sentence").otherwise("word")


def public_name(c: Column, suffix: str = ".mp4") -> Column:
    return F.concat(F.substring(F.md5(c.cast("string")), 1, 10), F.lit(suffix))
