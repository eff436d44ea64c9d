"""Review decisions, collection of approved recordings, clip indexes.

Approval has three meanings, kept apart: the latest decision (review_status,
sentence_progress, generated_review), ever approved (approved_ids,
approved_files, collect) and every decision row counted (batch_progress).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossworks.functions.common import blank_to_null, last_wins, stem
from glossworks.operators.segments import match_original

STATUSES = ("approved", "rejected")


def latest_decisions(decs: DataFrame, order: str = "seq") -> DataFrame:
    """videoId, decision: the last by order; null ids are left out."""
    return decs.where(F.col("videoId").isNotNull()).groupBy("videoId").agg(F.max_by("decision", order).alias("decision"))


def _status(decision: Column) -> Column:
    return F.when(decision.isin(*STATUSES), decision).otherwise("pending")


def review_status(subs: DataFrame, decs: DataFrame, batch: str | None = None) -> DataFrame:
    """Submissions (of a batch) with status: approved, rejected or pending by the latest decision."""
    own = subs.where(F.col("source") == "submission")
    if batch:
        own = own.where(F.col("videoFileName").startswith(batch + "_"))
    joined = own.join(latest_decisions(decs), "videoId", "left")
    return joined.withColumn("status", _status(F.col("decision"))).drop("decision")


def review_summary(status: DataFrame) -> DataFrame:
    """One row: total, approved, rejected, pending."""
    return status.agg(F.count("*").alias("total_submissions"), *[F.count_if(F.col("status") == s).alias(s) for s in (*STATUSES, "pending")])


def sentence_progress(batch: DataFrame, subs: DataFrame, decs: DataFrame) -> DataFrame:
    """Each sentence of a batch with its counts of recordings; 0 without any."""
    status = review_status(subs, decs).groupBy("sentenceId").agg(F.count("*").alias("recorded"), *[F.count_if(F.col("status") == s).alias(s) for s in (*STATUSES, "pending")])
    joined = batch.select("id", "text").join(status, F.col("id") == F.col("sentenceId"), "left").drop("sentenceId")
    return joined.fillna(0, ["recorded", *STATUSES, "pending"])


def batch_progress(batch: DataFrame, subs: DataFrame, decs: DataFrame) -> DataFrame:
    """One row: sentences, recorded, approved, rejected, pending_recording, pending_review; here every decision row counts, so pending_review can be below 0."""
    own = subs.where(F.col("source") == "submission").join(batch.select(F.col("id").alias("sentenceId")).distinct(), "sentenceId", "left_semi")
    recorded = own.agg(F.countDistinct("sentenceId").alias("recorded_sentences"), F.count("*").alias("recorded"))
    judged = decs.join(own.select("videoId").distinct(), "videoId", "left_semi").agg(*[F.count_if(F.col("decision") == s).alias(s) for s in STATUSES])
    total = batch.agg(F.countDistinct("id").alias("sentences"))
    one = total.join(F.broadcast(recorded)).join(F.broadcast(judged))  # one row each
    return one.withColumns({"pending_recording": F.greatest(F.lit(0), F.col("sentences") - F.col("recorded_sentences")), "pending_review": F.col("recorded") - F.col("approved") - F.col("rejected")})


def generated_review(subs: DataFrame, decs: DataFrame, prefix: str) -> DataFrame:
    """videoId, word (id without prefix), status of generated clips; the last row of an id wins in both tables."""
    own = last_wins(subs.where(F.col("videoId").startswith(prefix)), ["videoId"], ["seq"])
    joined = own.join(latest_decisions(decs), "videoId", "left")
    return joined.select("videoId", F.substring("videoId", len(prefix) + 1, 1 << 20).alias("word"), _status(F.col("decision")).alias("status"))


def approved_ids(decs: DataFrame) -> DataFrame:
    return decs.where("decision = 'approved' AND videoId IS NOT NULL").select("videoId").distinct()


def approved_files(decs: DataFrame, info_name: Column | str = "videoInfo.videoFileName") -> DataFrame:
    """name: files ever approved; the name is in videoInfo or, in older rows, at the top."""
    nested = F.col(info_name) if isinstance(info_name, str) else info_name
    name = F.coalesce(blank_to_null(nested), blank_to_null(F.col("videoFileName")))
    return decs.where("decision = 'approved'").select(name.alias("name")).where("name IS NOT NULL").distinct()


def collect(subs: DataFrame, decs: DataFrame, accepted: DataFrame, batches: DataFrame, batch: str | None = None) -> DataFrame:
    """Manifest rows of submissions ever approved whose lower-case text is accepted (text); text and type come from the batch."""
    own = subs.where(F.col("source") == "submission")
    texts = batches.select("id", "batch", "text", "type", "seq")
    if batch:
        own = own.where(F.col("videoFileName").startswith(batch + "_"))
        texts = texts.where(F.col("batch") == batch)
    texts = last_wins(texts, ["id"], ["batch", "seq"]).select(F.col("id").alias("sentenceId"), F.col("text").alias("batch_text"), "type")
    taken = own.join(approved_ids(decs), "videoId", "left_semi")
    taken = taken.withColumn("__t", F.lower(F.coalesce("sentenceText", F.lit("")))).join(accepted.select(F.lower("text").alias("__t")).distinct(), "__t", "left_semi").drop("__t")
    return taken.join(texts, "sentenceId", "left").select(
        F.col("videoId").alias("video_id"), F.col("videoFileName").alias("filename"), F.col("sentenceId").alias("sentence_id"), F.coalesce("batch_text", "sentenceText").alias("sentence_text"), F.coalesce("language", F.lit("en")).alias("language"), "type",
    )


def annotate(manifest: DataFrame, sentence_glosses: DataFrame) -> DataFrame:
    """manifest and glosses: those of the same sentence, else the text in upper case as the one gloss. sentence_glosses: sentence, glosses."""
    joined = manifest.join(sentence_glosses.select(F.col("sentence").alias("sentence_text"), "glosses"), "sentence_text", "left")
    return joined.withColumn("glosses", F.when(F.size("glosses") > 0, F.col("glosses")).otherwise(F.array(F.upper(F.coalesce("sentence_text", F.lit(""))))))


def filter_to_inventory(ann: DataFrame, inv: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose video is there, and one row: kept, dropped."""
    have = inv.select(key).distinct().withColumn("__there", F.lit(True))
    counts = ann.join(have, key, "left").agg(F.count_if("__there").alias("kept"), F.count_if(F.col("__there").isNull()).alias("dropped"))
    return ann.join(have, key, "left_semi"), counts


def prepare_dataset(selection: DataFrame, inventory: DataFrame) -> DataFrame:
    """selection (source, vid, ...) with filename and found."""
    joined = selection.join(inventory.select("source", "vid", "path"), ["source", "vid"], "left")
    return joined.withColumns({"found": F.col("path").isNotNull(), "filename": F.when(F.col("path").isNotNull(), F.concat("vid", F.lit(".mp4")))})


def latest_per_gloss(files: DataFrame, name_col: str = "name") -> DataFrame:
    """gloss (upper case), path: of names word_<gloss>_<14 digits>.mp4 the one of the latest time."""
    grammar = r"^word_(.+)_([0-9]{14})\.mp4$"
    rows = files.select(F.col(name_col).alias("path"), F.upper(F.regexp_extract(name_col, grammar, 1)).alias("gloss"), F.regexp_extract(name_col, grammar, 2).alias("ts")).where("gloss <> ''")
    return rows.groupBy("gloss").agg(F.max_by("path", F.struct("ts", "path")).alias("path"))


def first_per_key(subs: DataFrame, key: Column, where: Column, order: str = "seq") -> DataFrame:
    """key, path: the first submission of each key, as for single letters."""
    rows = subs.where(where).select(key.alias("key"), F.col("videoFileName").alias("path"), F.col(order).alias("o")).where("key IS NOT NULL")
    return rows.groupBy("key").agg(F.min_by("path", F.struct("o", "path")).alias("path"))


def clip_index(*sources: tuple[DataFrame, int, str]) -> DataFrame:
    """gloss, path, origin: of all sources (gloss, path, seq; priority; name) the highest priority, within one the last, wins."""
    rows = None
    for df, prio, name in sources:
        own = df.select(F.lower(F.trim("gloss")).alias("gloss"), "path", "seq", F.lit(prio).alias("prio"), F.lit(name).alias("origin"))
        rows = own if rows is None else rows.unionByName(own)
    return rows.where("gloss <> ''").groupBy("gloss").agg(F.max_by(F.struct("path", "origin"), F.struct("prio", "seq")).alias("w")).select("gloss", "w.path", "w.origin")


def play_plan(glosses: DataFrame, index: DataFrame, letters: DataFrame) -> DataFrame:
    """job, pos, char_pos, unit, path: a gloss with a clip plays it, another is spelled by the letters that have one. letters: letter, path."""
    g = glosses.withColumn("key", F.lower(F.trim("gloss")))
    joined = g.join(index.select(F.col("gloss").alias("key"), F.col("path").alias("clip")), "key", "left")
    hit = joined.where("clip IS NOT NULL").select("job", "pos", F.lit(0).alias("char_pos"), F.col("key").alias("unit"), F.col("clip").alias("path"))
    spelled = joined.where("clip IS NULL").select("job", "pos", F.posexplode(F.split("key", "")).alias("char_pos", "unit")).where("unit <> ''")
    spelled = spelled.join(letters.select(F.lower("letter").alias("unit"), "path"), "unit").select("job", "pos", "char_pos", "unit", "path")
    return hit.unionByName(spelled)


def attach_by_stem(files: DataFrame, annotations: DataFrame) -> DataFrame:
    """files (name) with stem and sentence_text of the longest annotated stem that a name contains; null where there is none."""
    own = annotations.groupBy(stem(F.col("filename")).alias("stem")).agg(F.min("sentence_text").alias("sentence_text"))
    found = match_original(files, own.withColumn("seq", F.lit(0)))
    return files.join(found, "name", "left").join(own, "stem", "left").select(*files.columns, "stem", "sentence_text")


def gloss_video_db(clips: DataFrame) -> DataFrame:
    """gloss, clips (sorted paths), n, duration."""
    return clips.groupBy("gloss").agg(F.sort_array(F.collect_list("path")).alias("clips"), F.count("*").alias("n"), F.sum("duration").alias("duration"))


def with_exists(subs: DataFrame, inventory: DataFrame) -> DataFrame:
    """subs and file_exists."""
    have = inventory.select(F.col("name").alias("videoFileName")).distinct().withColumn("__there", F.lit(True))
    return subs.join(have, "videoFileName", "left").withColumn("file_exists", F.coalesce("__there", F.lit(False))).drop("__there")


def batch_sizes(batches: DataFrame) -> DataFrame:
    return batches.groupBy("batch").agg(F.count("*").alias("sentence_count"))
