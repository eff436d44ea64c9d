"""Training entries: selection, padding, splits, resources of tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from glossworks.functions.common import blank_to_null, digest, first_by_hash, first_wins, last_wins, materialize, ranked, small, stem
from glossworks.functions.text import gloss_key, sentence_key

PRESETS = {"36x": (10, 10, 15), "21x": (10, 0, 10)}
TARGET = 3000


def sentence_videos(manifest: DataFrame, glosses: DataFrame | None = None) -> DataFrame:
    """Sentences only: texts that are a key of the gloss map (sentence), or without one (data set mode) files named sentence_*."""
    if glosses is None:
        return manifest.where(F.col("filename").startswith("sentence_"))
    keys = glosses.select(sentence_key(F.col("sentence")).alias("__k")).distinct()
    return manifest.withColumn("__k", sentence_key(F.col("sentence_text"))).join(keys, "__k", "left_semi").drop("__k")


def pad_to_target(current: DataFrame, sources: DataFrame, target: int = TARGET, times: float | None = None) -> DataFrame:
    """idx, pseudo_gloss, text, path, prio of the rows that fill current up to target, or up to so many times its own rows.

    sources: prio (0: earlier tasks, newest first; then the sets), seq, pseudo_gloss, text, path; distinct by lower-case text,
    none of current's. A row needs a text and a path; files word_* of earlier tasks are out.
    """
    have = current.count()
    need = (target if times is None else round(times * have)) - have
    usable = sources.where((F.trim("text") != "") & F.col("path").isNotNull() & ~((F.col("prio") == 0) & stem(F.col("path")).startswith("word_"))).withColumn("__k", digest(F.lower("text")))
    known = current.select(digest(F.lower(F.trim("sentence_text"))).alias("__k")).distinct()
    fresh = first_wins(usable.select("prio", "seq", "__k"), ["__k"], ["prio", "seq"]).join(known, "__k", "left_anti")
    taken = materialize(ranked(fresh, ["prio", "seq"], max(0, need)).select("__k", F.col("__rank").cast("int").alias("idx")), "taken")
    # keys stand for texts up to here; only texts that are taken are moved
    return first_wins(usable.join(small(taken), "__k"), ["__k"], ["prio", "seq"]).select("prio", "pseudo_gloss", "text", "path", "idx")


def build_entries(current: DataFrame, pads: DataFrame | None, glosses: DataFrame) -> DataFrame:
    """fileid, text (pseudo-gloss), original_text, video_name, is_pad, fallback, without pads of the current rows only. glosses: sentence, glosses.

    The pseudo-gloss is the supplied one, else the map's, else (pads only) the raw
    text; a current row without one has a null text, see require_glosses. Of
    several entries of the map for one sentence the least counts.
    """
    own = glosses.select(digest(sentence_key(F.col("sentence"))).alias("__k"), F.lower(F.array_join("glosses", " ")).alias("__g")).groupBy("__k").agg(F.min("__g").alias("__g"))
    rows = current.select("filename", F.col("sentence_text"), F.lit(None).cast("string").alias("pseudo_gloss"), F.lit(False).alias("is_pad"))
    if pads is not None:
        rows = rows.unionByName(pads.select(F.format_string("pad_%05d.mp4", "idx").alias("filename"), F.col("text").alias("sentence_text"), "pseudo_gloss", F.lit(True).alias("is_pad")))
    joined = rows.withColumn("__k", digest(sentence_key(F.col("sentence_text")))).join(small(materialize(own, "glosses")), "__k", "left")
    known = F.coalesce(blank_to_null(F.col("pseudo_gloss")), "__g")
    text = F.coalesce(known, F.when(F.col("is_pad"), F.col("sentence_text")))
    return joined.select(stem(F.col("filename")).alias("fileid"), text.alias("text"), F.col("sentence_text").alias("original_text"), F.col("filename").alias("video_name"), "is_pad", (F.col("is_pad") & known.isNull()).alias("fallback"))


def require_glosses(entries: DataFrame) -> DataFrame:
    missing = entries.where("text IS NULL").select("video_name").limit(20).collect()
    if missing:
        raise ValueError(f"no pseudo-gloss for {', '.join(r.video_name for r in missing)}")
    return entries


def split_train_val_test(entries: DataFrame, frac: float = 0.09, seed: int = 42) -> DataFrame:
    """entries and split: val from pads only (a share of all, one at least, the pads at most), test = current rows, train = current and the other pads."""
    n = entries.agg(F.count("*").alias("n"), F.count_if("is_pad").alias("pads")).first()
    n_val = min(max(1, round(n.n * frac)) if n.n else 0, n.pads)
    val = first_by_hash(entries.where("is_pad"), "fileid", n_val, seed)
    splits = F.when(F.col("is_pad") & val, F.array(F.lit("val"))).when(F.col("is_pad"), F.array(F.lit("train"))).otherwise(F.array(F.lit("train"), F.lit("test")))
    return entries.withColumn("split", F.explode(splits))


def entry_tokens(entries: DataFrame) -> DataFrame:
    return entries.select(F.explode(F.split(F.lower("text"), r"\s+")).alias("token")).where("token <> ''").distinct()


def pool_index(sign_pool: DataFrame) -> DataFrame:
    """phrase (tokens joined, lower case), utterance_id."""
    return sign_pool.select(F.lower(F.trim(F.array_join("tokens", " "))).alias("phrase"), "utterance_id").where("phrase <> ''")


def word_index(word_meta: DataFrame, approved: DataFrame, inventory: DataFrame) -> DataFrame:
    """token, name, path: alternates of a clip's word (comma list) with approval, metadata and a file (of one name the last).

    word_meta: filename, alternate_words; approved: name; inventory: name, path, seq.
    """
    files = last_wins(inventory.select("name", "path", "seq"), ["name"], ["seq"]).drop("seq")
    rows = word_meta.select(F.col("filename").alias("name"), F.explode(F.split("alternate_words", ",")).alias("token")).withColumn("token", gloss_key(F.col("token"))).where("token <> ''").distinct()
    return rows.join(approved.select("name").distinct(), "name", "left_semi").join(files, "name")


def resolve_resources(tokens: DataFrame, index: DataFrame, features: DataFrame, max_per_gloss: int = 5) -> DataFrame:
    """token, ord, name, has_feature of up to max_per_gloss candidates, cut off first and then checked; a token without any has one row of nulls.

    index: token, name, seq; features: name.
    """
    lead = Window.partitionBy("token").orderBy("seq", "name")
    own = index.join(tokens.select("token").distinct(), "token", "left_semi").withColumn("ord", F.row_number().over(lead)).where(F.col("ord") <= max_per_gloss)
    have = features.select("name").distinct().withColumn("has_feature", F.lit(True))
    found = own.select("token", "ord", "name").join(have, "name", "left").withColumn("has_feature", F.coalesce("has_feature", F.lit(False)))
    return tokens.select("token").distinct().join(found, "token", "left").select("token", "ord", "name", "has_feature")


def resource_counts(resolved: DataFrame) -> DataFrame:
    """tokens, hits (with a usable clip), missing (without a candidate), clips, feature_missing."""
    per = resolved.groupBy("token").agg(F.count("name").alias("c"), F.count_if("has_feature").alias("f"))
    return per.agg(F.count("*").alias("tokens"), F.count_if(F.col("f") > 0).alias("hits"), F.count_if(F.col("c") == 0).alias("missing"), F.sum("f").alias("clips"), F.sum(F.col("c") - F.col("f")).alias("feature_missing"))


def choose_preset(counts: DataFrame, preset: str = "36x", least: float = 0.4) -> DataFrame:
    """hit_rate and preset: 36x gives way to 21x below the least hit rate."""
    rate = F.col("hits") / F.greatest(F.col("tokens"), F.lit(1))
    return counts.select(rate.alias("hit_rate"), F.when((F.lit(preset) == "36x") & (rate < least), "21x").otherwise(preset).alias("preset"))


def split_variants(variants: DataFrame, frac: float = 0.1, seed: int = 42) -> DataFrame:
    """variants and split: a share to val in seeded order, test a copy of val, the rest train."""
    n_val = round(variants.count() * frac)
    val = first_by_hash(variants, "variant_id", n_val, seed)
    splits = F.when(val, F.array(F.lit("val"), F.lit("test"))).otherwise(F.array(F.lit("train")))
    return variants.withColumn("split", F.explode(splits))


def category_counts(split: DataFrame) -> DataFrame:
    """category, train, val, test."""
    return split.groupBy("category").pivot("split", ["train", "val", "test"]).agg(F.count(F.lit(1))).fillna(0)


def frame_stats(variants: DataFrame) -> DataFrame:
    """cat, n, min, max, mean, median (cut to a whole number) of the frames."""
    return variants.groupBy(F.substring("category", 1, 1).alias("cat")).agg(
        F.count("*").alias("n"), F.min("n_frames").alias("min"), F.max("n_frames").alias("max"), F.round(F.avg("n_frames"), 6).alias("mean"), F.median("n_frames").cast("long").alias("median")
    )


def top_drops(drops: DataFrame, n: int = 20) -> DataFrame:
    """reason, n: the most frequent reasons. drops: reason."""
    return drops.groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(n)


def pending(files: DataFrame, done: DataFrame, approved: DataFrame | None = None, cap: int | None = None) -> DataFrame:
    """Files (name, dir) without an output yet, if asked for only approved ones and the first cap of each directory."""
    rows = files.join(done.select("name").distinct(), "name", "left_anti")
    if approved is not None:
        rows = rows.join(approved.select("name").distinct(), "name", "left_semi")
    if cap is not None:
        rows = rows.withColumn("__r", F.row_number().over(Window.partitionBy("dir").orderBy("name"))).where(F.col("__r") <= cap).drop("__r")
    return rows
