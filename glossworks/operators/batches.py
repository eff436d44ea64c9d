"""Recording batches and release dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossworks.functions.common import blank_to_null, first_wins, new_rows_only
from glossworks.functions.text import public_name, text_type

#: Endings of file names that belong to one dictionary key, longest first; the first is the dictionary's own.
SUFFIXES = ("_hiya_complete.mp4", "_hiya.mp4", "_hiya")


def gloss_sources(sentence_glosses: DataFrame) -> DataFrame:
    """gloss (lower case), sentences: the distinct ones in first-seen order. sentence_glosses: sentence, gloss, seq."""
    first = sentence_glosses.groupBy(F.lower("gloss").alias("gloss"), "sentence").agg(F.min("seq").alias("seq"))
    return first.groupBy("gloss").agg(F.transform(F.sort_array(F.collect_list(F.struct("seq", "sentence"))), lambda x: x["sentence"]).alias("sentences"))


def build_batch(glosses: DataFrame, sentences: DataFrame, batch_id: str) -> DataFrame:
    """text, batch_id, type, origin_sentence, ord: distinct words with their first sentence, then distinct sentences that are none of the words.

    glosses: sentence, gloss, seq; sentences: text, seq.
    """
    words = glosses.where(F.col("gloss").isNotNull()).groupBy(F.lower("gloss").alias("text")).agg(F.min("seq").alias("ord"), F.min_by("sentence", "seq").alias("origin_sentence"))
    words = words.select("text", F.lit("word").alias("type"), "origin_sentence", "ord")
    kept = sentences.select(F.trim("text").alias("text"), "seq").where("text <> ''").groupBy("text").agg(F.min("seq").alias("ord"))
    kept = kept.join(words.select("text"), "text", "left_anti").select("text", F.lit("sentence").alias("type"), F.col("text").alias("origin_sentence"), "ord")
    return words.unionByName(kept).withColumn("batch_id", F.lit(batch_id))


def build_release_dict(approved: DataFrame) -> DataFrame:
    """The six columns of a release: video_file, text, batch_id, type, description, origin_sentence.

    approved: filename, sentenceText, word, batchFile, description, _origin (struct with src_sentence).
    """
    kind = text_type(F.coalesce("sentenceText", F.lit("")))
    return approved.select(
        F.col("filename").alias("video_file"), F.when(kind == "sentence", F.col("sentenceText")).otherwise(F.col("word")).alias("text"), F.regexp_replace(F.coalesce("batchFile", F.lit("")), r"\.jsonl$", "").alias("batch_id"),
        kind.alias("type"), F.coalesce("description", F.lit("")).alias("description"), F.coalesce("_origin.src_sentence", F.lit("")).alias("origin_sentence"),
    )


def fill_descriptions(df: DataFrame, dictionary: DataFrame, fallback: DataFrame) -> DataFrame:
    """df (text, type, ...) with description: the dictionary's, else the fallback's (gloss tokens of a sentence, definition of a word)."""
    own = dictionary.select(F.lower("text").alias("__k"), blank_to_null(F.col("description")).alias("__a"))
    other = fallback.select(F.lower("text").alias("__k"), blank_to_null(F.col("description")).alias("__b"))
    joined = df.withColumn("__k", F.lower("text")).join(own, "__k", "left").join(other, "__k", "left")
    return joined.withColumn("description", F.coalesce("__a", "__b", F.lit(""))).drop("__k", "__a", "__b")


def assign_reviewers(videos: DataFrame, reviewers: DataFrame, existing: DataFrame) -> DataFrame:
    """videoId, reviewerId of every pair that isn't there yet. reviewers is a small table of people: every video meets each."""
    pairs = videos.select("videoId").distinct().crossJoin(reviewers.select("reviewerId").distinct())
    return new_rows_only(pairs, existing, ["videoId", "reviewerId"])


def ingest_named_files(files: DataFrame, texts: DataFrame, existing: DataFrame, pattern: str, id_prefix: str) -> tuple[DataFrame, DataFrame]:
    """Rows to append (videoId, sentenceId, name, text) and one row of counters: found, unmatched, missing_text, existing, appended."""
    sid = F.regexp_extract("name", pattern, 1)
    rows = files.select("name", F.when(sid != "", sid.cast("long")).alias("sentenceId"))
    rows = rows.join(texts.select(F.col("id").alias("sentenceId"), "text"), "sentenceId", "left").withColumn("videoId", F.concat(F.lit(id_prefix + "_"), F.col("sentenceId")))
    rows = rows.join(existing.select("videoId").distinct().withColumn("known", F.lit(True)), "videoId", "left")
    fits = F.col("text").isNotNull()
    counts = rows.agg(
        F.count("*").alias("found"), F.count_if(F.col("sentenceId").isNull()).alias("unmatched"), F.count_if(F.col("sentenceId").isNotNull() & ~fits).alias("missing_text"),
        F.count_if(fits & F.col("known").isNotNull()).alias("existing"), F.count_if(fits & F.col("known").isNull()).alias("appended"),
    )
    return rows.where(fits & F.col("known").isNull()).drop("known"), counts


def append_named_files(files: DataFrame, texts: DataFrame, existing: DataFrame, pattern: str, id_prefix: str) -> DataFrame:
    """ingest_named_files behind its gate: fails if any file has no id or no text."""
    rows, counts = ingest_named_files(files, texts, existing, pattern, id_prefix)
    got = counts.first()
    if got.unmatched or got.missing_text:
        raise ValueError(f"refusing to append: {got.unmatched} names without an id, {got.missing_text} without a text")
    return rows


def bare_key(name: Column) -> Column:
    return F.coalesce(*[F.when(F.endswith(name, F.lit(x)), F.left(name, F.length(name) - len(x))) for x in SUFFIXES], name)


def stable_id(key: Column, base: int = 100_000, slots: int = 27_000) -> Column:
    """A number in a reserved range that every run gives the same key; keys may share one."""
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % slots + base).cast("long")


def attach_dictionary(files: DataFrame, dictionary: DataFrame) -> DataFrame:
    """name, key, word, gloss, sentenceId: a file without an entry has its key as word. dictionary: ref, word, gloss."""
    own = dictionary.where(F.col("ref").endswith(SUFFIXES[0])).select(bare_key(F.col("ref")).alias("key"), F.trim("word").alias("word"), F.trim("gloss").alias("gloss"))
    joined = files.withColumn("key", bare_key(F.col("name"))).join(own, "key", "left")
    return joined.withColumns({"word": F.coalesce(blank_to_null(F.col("word")), "key"), "gloss": F.coalesce("gloss", F.lit("")), "sentenceId": stable_id(F.col("key"))})


def batch_texts(annotations: DataFrame) -> DataFrame:
    """id, text, language of the distinct sentence ids, the first of each."""
    rows = annotations.where("sentence_id IS NOT NULL").select(F.col("sentence_id").alias("id"), F.col("sentence_text").alias("text"), F.coalesce("language", F.lit("en")).alias("language"), "seq")
    return first_wins(rows, ["id"], ["seq"]).drop("seq")


def publish_rows(results: DataFrame, annotations: DataFrame, batch: str, date: str, existing: DataFrame) -> DataFrame:
    """Rows for completed clips that have an annotation and aren't known yet, with a snapshot of the source."""
    done = results.where("status = 'completed'").select("filename").distinct()
    rows = done.join(annotations, "filename").select(
        F.concat(F.lit("gen_"), "video_id", F.lit("_" + date)).alias("videoId"), F.col("sentence_text").alias("sentenceText"), F.col("language"), F.lit(batch + ".jsonl").alias("batchFile"),
        F.struct(F.col("video_id").alias("src_videoId"), F.col("sentence_id").alias("src_sid"), F.col("sentence_text").alias("src_sentence"), F.col("filename").alias("src_filename")).alias("_origin"),
    )
    return new_rows_only(rows, existing, ["videoId"]).withColumn("videoFileName", public_name(F.col("videoId")))
