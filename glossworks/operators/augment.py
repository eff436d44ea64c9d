"""Plans of augmented and rendered videos, and their summary."""

from __future__ import annotations

from math import prod

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from glossworks.functions.common import hash_order, materialize, ranked, small

TYPES = ("2d_cv", "temporal", "3d_views", "identity")


def plan_augment(videos: DataFrame, augs: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """stem, aug_name, out of what is still to be made, and one row: cached, new. videos: stem; augs: aug_name, enabled; existing: out."""
    jobs = videos.select("stem").distinct().crossJoin(small(augs.where("enabled").select("aug_name").distinct()))
    jobs = jobs.withColumn("out", F.concat("aug_name", F.lit("/"), "stem", F.lit(".mp4")))
    marked = jobs.join(existing.select("out").distinct().withColumn("there", F.lit(True)), "out", "left")
    return marked.where("there IS NULL").select("stem", "aug_name", "out"), marked.agg(F.count_if("there").alias("cached"), F.count_if(F.col("there").isNull()).alias("new"))


def plan_render(tracked: DataFrame, config: DataFrame) -> DataFrame:
    """type, stem, save_name, yaw, pitch, zoom: each tracked video from each viewpoint, and as each enabled template from its viewpoints.

    config: one row with viewpoints: array<struct<name, yaw, pitch, zoom>>, templates: array<struct<template_dir, enabled, viewpoints>>.
    """
    one = F.broadcast(config.limit(1))  # the one row
    views = tracked.select("stem").crossJoin(one.select(F.inline("viewpoints"))).select(F.lit("fixed_viewpoint").alias("type"), "stem", F.concat_ws("_", "stem", "name").alias("save_name"), "yaw", "pitch", "zoom")
    label = F.substring(F.replace(F.replace("template_dir", F.lit(".jpeg"), F.lit("")), F.lit(" "), F.lit("_")), 1, 20)
    tpl = one.select(F.inline("templates")).where("enabled").select(label.alias("label"), F.inline("viewpoints"))
    plain = F.col("name") == "original"
    named = F.concat(F.lit("x_"), "stem", F.lit("_"), "label", F.when(plain, "").otherwise(F.concat(F.lit("_"), "name")))
    turned = [F.when(~plain, F.col(c)).alias(c) for c in ("yaw", "pitch", "zoom")]
    return views.unionByName(tracked.select("stem").crossJoin(small(tpl)).select(F.lit("cross_reenact").alias("type"), "stem", named.alias("save_name"), *turned))


def plan_combined(views: DataFrame, augs: DataFrame, n: int = 5, seed: int = 0) -> DataFrame:
    """name, aug_name: n seeded augmentations of each word view whose viewpoint moves on two axes or more. views: name, viewpoint; augs: aug_name."""
    axes = sum(F.col("viewpoint").contains(k).cast("int") for k in ("yaw_", "pitch_", "zoom_"))
    rows = views.where(F.col("name").startswith("word_") & (axes >= 2)).crossJoin(small(augs.select("aug_name").distinct()))
    ranked = rows.withColumn("__r", F.row_number().over(Window.partitionBy("name", "viewpoint").orderBy(hash_order(seed, F.col("name"), F.col("viewpoint"), F.col("aug_name")))))
    return ranked.where(F.col("__r") <= n).select("name", "viewpoint", "aug_name")


def augment_summary(results: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """category and a count for each type, earlier categories kept where this run has none; 3d_cv_combined counts as 2d_cv in the totals.

    results: category, aug_type; prior: category and the counts.
    """
    kinds = (*TYPES, "3d_cv_combined")
    now = results.groupBy("category").pivot("aug_type", list(kinds)).agg(F.count(F.lit(1))).fillna(0)
    return now if prior is None else now.unionByName(prior.join(now.select("category"), "category", "left_anti").select(*now.columns))


def augment_totals(summary: DataFrame) -> DataFrame:
    counts = {k: F.coalesce(F.sum(F.col(k) + (F.col("3d_cv_combined") if k == "2d_cv" else 0)), F.lit(0)) for k in TYPES}
    rows = summary.agg(*[c.alias(k) for k, c in counts.items()])
    return rows.withColumn("total", sum(F.col(k) for k in TYPES))


def param_grid(spark: SparkSession, lists: dict[str, list | DataFrame]) -> DataFrame:
    """Every combination of the parameters' values: lists, or the distinct values of a table's first column.

    A combination is a number in mixed radix whose digits are the values' places, so
    their count is known before, and numbers are dealt evenly over all tasks.
    """
    tables = {k: materialize(v.select(F.col(v.columns[0]).alias(k)).distinct(), "values") for k, v in lists.items() if isinstance(v, DataFrame)}
    sizes = {k: tables[k].count() if k in tables else len(v) for k, v in lists.items()}
    df, stride = spark.range(prod(sizes.values())), 1
    for name, values in lists.items():
        digit = F.expr(f"id div {stride}L % {max(1, sizes[name])}L")
        if name in tables:
            places = ranked(tables[name], [name]).withColumnRenamed("__rank", "__digit")
            df = df.withColumn("__digit", digit).join(small(places), "__digit").drop("__digit")
        else:
            df = df.withColumn(name, F.get(F.array(*[F.lit(v) for v in values]), digit.cast("int")))
        stride *= max(1, sizes[name])
    return df.select(*lists)
