"""Segment boundaries, clips, and labels of derived files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossworks.functions.common import contained, materialize, stem

#: Frame rates whose ratio rendered views are slowed by.
RENDER_RATIO = 30 / 25
UNSAFE = r"[^\p{L}\p{N}._-]"


def to_split_points(raw: DataFrame) -> DataFrame:
    """stem, seg, start, end, label in seconds of videos that have segments and aren't words. raw: video_name, fps, segments."""
    rows = raw.where((F.size("segments") > 0) & ~F.col("video_name").startswith("word_"))
    fps = F.coalesce(F.nullif(F.col("fps"), F.lit(0.0)), F.lit(25.0))
    return rows.select(stem(F.col("video_name")).alias("stem"), fps.alias("fps"), F.posexplode("segments").alias("seg", "s")).select(
        "stem", "seg", (F.coalesce("s.orig_start", F.lit(0)) / F.col("fps")).alias("start"), (F.coalesce("s.orig_end", F.lit(0)) / F.col("fps")).alias("end"), F.coalesce("s.token", F.lit("")).alias("label")
    )


def clip_name(stem_col: Column, seg: Column, label: Column) -> Column:
    return F.regexp_replace(F.concat(stem_col, F.lit("_seg"), F.lpad(seg.cast("string"), 3, "0"), F.lit("_"), label), UNSAFE, "_")


def clips(segments: DataFrame, videos: DataFrame) -> DataFrame:
    """stem, seg, label, start_frame, end_frame, clip: whole frames, the end within the video, empty clips left out. videos: stem, fps, total_frames."""
    joined = segments.join(videos.select("stem", "fps", "total_frames"), "stem")
    cut = joined.select(
        "stem", "seg", "label", (F.col("start") * F.col("fps")).cast("int").alias("start_frame"), F.least((F.col("end") * F.col("fps")).cast("int"), F.col("total_frames").cast("int")).alias("end_frame")
    )
    return cut.where("end_frame > start_frame").withColumn("clip", F.concat(clip_name(F.col("stem"), F.col("seg"), F.col("label")), F.lit(".mp4")))


def match_original(files: DataFrame, stems: DataFrame, how: str = "longest") -> DataFrame:
    """name, stem: the original that a derived file's name contains; the longest, or by how="first" the first by seq."""
    own = files.select("name", stem(F.col("name")).alias("text"))
    if how == "longest":
        return contained(own, stems.select("stem", F.lit(1).alias("kinds")), distinct=False).groupBy("name").agg(F.max(F.struct(F.length("stem").alias("n"), "stem"))["stem"].alias("stem"))
    found = contained(own, stems, distinct=False).join(stems.groupBy("stem").agg(F.min("seq").alias("seq")), "stem")
    return found.groupBy("name").agg(F.min_by("stem", F.struct("seq", "stem")).alias("stem"))


def scale_segments(segments: DataFrame, variants: DataFrame, params: DataFrame) -> DataFrame:
    """name, aug_type, seg, start, end, label of derived files: divided by the speed ratio of a temporal variant, by 30/25 of a
    rendered view of a sentence, unchanged of an image variant. variants: name, aug_type, aug_name, stem; params: aug_name, stem, speed_ratio."""
    # variants have their ratios before they meet the segments: the result, by far the largest table, isn't shuffled
    joined = variants.join(params, ["aug_name", "stem"], "left").join(segments, "stem")
    ratio = F.when(F.col("aug_type") == "temporal", F.coalesce("speed_ratio", F.lit(1.0))).when((F.col("aug_type") == "view") & F.col("stem").startswith("sentence_"), F.lit(RENDER_RATIO)).otherwise(F.lit(1.0))
    return joined.select("name", "aug_type", "stem", "seg", (F.col("start") / ratio).alias("start"), (F.col("end") / ratio).alias("end"), "label")


def clean_label(label: Column) -> Column:
    return F.regexp_replace(F.upper(label), r"[.,!?;:]+$", "")


def segment_labels(segments: DataFrame) -> DataFrame:
    """seg_stem (as clips are named), gloss: upper case without closing marks; empty ones left out."""
    return segments.select(clip_name(F.col("stem"), F.col("seg"), F.col("label")).alias("seg_stem"), clean_label(F.col("label")).alias("gloss")).where("gloss <> ''")


def training_names(files: DataFrame) -> DataFrame:
    """files and out: prefix, directories joined by _, stem, level suffix; over 250 characters cut to 200 and twelve of the md5.

    files: rel_path, prefix, level (null: none).
    """
    whole = F.concat(F.col("prefix"), F.replace(F.regexp_replace("rel_path", r"\.[^./]*$", ""), F.lit("/"), F.lit("_")))
    mark = F.concat(F.lit("_"), F.col("level"))
    leveled = F.when(F.col("level").isNull() | F.endswith(whole, mark), whole).otherwise(F.concat(whole, mark))
    short = F.when(F.length(leveled) + 4 > 250, F.concat(F.substring(leveled, 1, 200), F.lit("_"), F.substring(F.md5(leveled), 1, 12))).otherwise(leveled)
    return files.withColumn("out", F.concat(short, F.lit(".mp4")))


def single_gloss(poses: DataFrame, gloss_map: DataFrame, labels: DataFrame) -> DataFrame:
    """stem, gloss, how: the gloss of each pose file by the first that holds: the longest segment in its name has a label (segment), the
    longest word_ stem in its name (word), a sentence_ stem (sentence: none), the longest stem of one gloss (single), nothing (unmatched).
    poses: stem; gloss_map: stem, glosses; labels: seg_stem, gloss."""
    tasks = int(poses.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(poses.select(F.col("stem").alias("name")).repartition(tasks, "name").distinct(), "poses")
    segs = labels.groupBy(F.col("seg_stem").alias("stem")).agg(F.min("gloss").alias("label"))
    originals = gloss_map.groupBy("stem").agg(F.min("glosses").alias("glosses"))
    keys = materialize(segs.join(originals, "stem", "full_outer"), "stems")
    word, sentence, one = F.startswith("stem", F.lit("word_")), F.startswith("stem", F.lit("sentence_")), F.size("glosses") == 1
    size, known = F.struct(F.length("stem"), "stem"), F.col("glosses").isNotNull()
    # of each place the longest stem of a layer is enough
    layers = [F.when(F.coalesce(holds, F.lit(False)), 1 << i).otherwise(0) for i, holds in enumerate((F.col("label").isNotNull(), word & known, sentence & known, one))]
    found = contained(rows, keys.select("stem", reduce(Column.bitwiseOR, layers).alias("kinds")).where("kinds > 0"), distinct=False).join(keys, "stem")
    best = found.groupBy("name").agg(
        F.max_by("label", F.when(F.col("label").isNotNull(), size)).alias("label"), F.max_by("glosses", F.when(word & known, size)).alias("word"),
        F.bool_or(sentence & known).alias("sentence"), F.max_by("glosses", F.when(one, size)).alias("one"),
    )
    first = lambda c: F.get(c, F.lit(0))
    layers = (("segment", F.col("label").isNotNull(), F.col("label")), ("word", F.col("word").isNotNull(), F.upper(first("word"))), ("sentence", F.coalesce("sentence", F.lit(False)), F.lit(None)), ("single", F.col("one").isNotNull(), first("one")))
    gloss, how = F.lit(None).cast("string"), F.lit("unmatched")
    for kind, holds, value in reversed(layers):
        gloss, how = F.when(holds, value).otherwise(gloss), F.when(holds, kind).otherwise(how)
    return rows.join(best, "name", "left").select(F.col("name").alias("stem"), gloss.alias("gloss"), how.alias("how"))


def label_table(glosses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ref, gloss without closing marks, and one row: entries, skipped_sentence, skipped_unmatched. glosses: as of single_gloss."""
    clean = F.regexp_replace("gloss", r"[.,!?;:]+$", "")
    rows = glosses.select(F.col("stem").alias("ref"), clean.alias("gloss")).where("gloss <> ''")
    none = F.col("gloss").isNull()
    counts = glosses.agg(F.count_if(~none & (clean != "")).alias("entries"), F.count_if(none & F.col("stem").contains("sentence_")).alias("skipped_sentence"), F.count_if(none & ~F.col("stem").contains("sentence_")).alias("skipped_unmatched"))
    return rows, counts


def require_labels(rows: DataFrame) -> DataFrame:
    if rows.isEmpty():
        raise ValueError("no pose file has a gloss")
    return rows


def video_gloss_map(annotations: DataFrame, manifest: DataFrame, sentence_glosses: DataFrame) -> DataFrame:
    """stem, glosses of the first source that has rows: annotations, the manifest's words in upper case, the sentences' glosses."""
    if not annotations.isEmpty():
        return annotations.select(stem(F.col("filename")).alias("stem"), "glosses")
    if not manifest.isEmpty():
        words = F.filter(F.split(F.upper(F.trim(F.coalesce("sentence_text", F.lit("")))), r"\s+"), lambda x: x != "")
        return manifest.select(stem(F.col("filename")).alias("stem"), words.alias("glosses"))
    return sentence_glosses.select(F.trim("sentence").alias("stem"), "glosses")
