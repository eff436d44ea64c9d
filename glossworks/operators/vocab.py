"""Pose validation and vocabulary merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MIN_FRAMES = 6


def validate_poses(index: DataFrame, min_frames: int = MIN_FRAMES) -> DataFrame:
    """index with valid and reason (unreadable, too_short)."""
    bad = F.col("error").isNotNull() | F.col("n_frames").isNull()
    reason = F.when(bad, "unreadable").when(F.col("n_frames") < min_frames, "too_short")
    return index.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())


def funnel(validated: DataFrame) -> DataFrame:
    """total, readable, valid."""
    return validated.agg(F.count("*").alias("total"), F.count_if(~F.coalesce(F.col("reason") == "unreadable", F.lit(False))).alias("readable"), F.count_if("valid").alias("valid"))


def merge_vocab(prev: DataFrame, new: DataFrame) -> DataFrame:
    """token, id: earlier ids stay (<pad> is now <blank>), new tokens follow in order from the highest id on. Fails on an empty earlier vocabulary.

    Only tokens that are really new are ranked, by parts of their order: first
    by their leading character, then within it, so no task ranks them all.
    """
    top = prev.agg(F.max("id")).first()[0]
    if top is None:
        raise ValueError("the previous vocabulary is empty")
    no_blank = F.lit(prev.where("token = '<blank>'").isEmpty())
    old = prev.select(F.when((F.col("token") == "<pad>") & no_blank, "<blank>").otherwise(F.col("token")).alias("token"), F.col("id").cast("long").alias("id"))
    fresh = new.select("token").distinct().join(old.select("token"), "token", "left_anti")
    if not old.where("token = '<blank>'").isEmpty():
        fresh = fresh.where("token <> '<pad>'")
    parts = fresh.withColumn("lead", F.substring("token", 1, 2))
    sizes = parts.groupBy("lead").count().withColumn("before", F.coalesce(F.sum("count").over(Window.orderBy("lead").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = parts.withColumn("r", F.row_number().over(Window.partitionBy("lead").orderBy("token"))).join(sizes.select("lead", "before"), "lead")
    return old.unionByName(ranked.select("token", (F.col("before") + F.col("r") + top).cast("long").alias("id")))


def merge_entries(prev: DataFrame, new: DataFrame) -> DataFrame:
    """line of both files, blank ones left out, repeats kept."""
    return prev.select(F.trim("line").alias("line")).unionByName(new.select(F.trim("line").alias("line"))).where("line <> ''")
