"""Reports over render jobs and tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GENERATED, EXCLUDED = ("success", "retry_success"), ("skipped_short", "failed")


def run_report(results: DataFrame) -> DataFrame:
    """One row: a count for each status, total_generated, total_excluded, total_seconds, avg_seconds of a generated one."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in (*GENERATED, *EXCLUDED)]
    one = results.agg(F.count("*").alias("total"), *counts, F.round(F.coalesce(F.sum("wall_sec"), F.lit(0.0)), 1).alias("total_seconds"), F.sum("wall_sec").alias("__s"))
    made = F.col("success") + F.col("retry_success")
    return one.withColumns({"total_generated": made, "total_excluded": F.col("skipped_short") + F.col("failed"), "avg_seconds": F.round(F.coalesce("__s", F.lit(0.0)) / F.greatest(F.lit(1), made), 1)}).drop("__s")


#: Names that bound the parts in which names are ranked: a power of two less one.
BOUNDS = 1023


def batch_todo(files: DataFrame, done: DataFrame, size: int = 200) -> DataFrame:
    """name, batch (from 1) of what isn't done, in name order.

    Names are ranked in parts of about equal size; the bounds of the parts are
    BOUNDS of the names, taken by hash. They set the sizes, never the result.
    """
    rest = files.select("name").where("name IS NOT NULL").distinct().join(done.select("name").distinct(), "name", "left_anti")
    bounds = sorted((r.name for r in rest.orderBy(F.xxhash64("name"), "name").limit(BOUNDS).collect()), key=lambda n: n.encode())
    known, steps = F.array(*[F.lit(b) for b in bounds]).cast("array<string>"), [F.lit(1 << i) for i in reversed(range(BOUNDS.bit_length()))]

    def further(at: Column, step: Column) -> Column:
        return F.when(F.coalesce(F.get(known, at + step - 1) <= F.col("name"), F.lit(False)), at + step).otherwise(at)

    rest = rest.withColumn("part", F.aggregate(F.array(*steps), F.lit(0), further))
    sizes = rest.groupBy("part").count().withColumn("before", F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # a row for each part
    ranked = rest.withColumn("r", F.row_number().over(Window.partitionBy("part").orderBy("name"))).join(F.broadcast(sizes.select("part", "before")), "part")
    return ranked.select("name", (F.floor((F.col("before") + F.col("r") - 1) / size) + 1).cast("long").alias("batch"))


def progress_by_batch(log: DataFrame) -> DataFrame:
    """batch (null: all), ok, failed."""
    count = [F.count_if(F.col("status") == s).alias(s) for s in ("ok", "failed")]
    return log.groupBy("batch").agg(*count).unionByName(log.agg(F.lit(None).cast(log.schema["batch"].dataType).alias("batch"), *count))


#: What an update sets; the rest of a known job stays as it is.
UPDATED = ("status", "source_video_path", "generated_video_path", "sentence_text", "created_at", "updated_at")


def upsert_jobs(existing: DataFrame, incoming: DataFrame, order: list[str], key: str = "job_id", updated: tuple[str, ...] = UPDATED) -> tuple[DataFrame, DataFrame]:
    """The table after incoming rows were upserted one after the other by order, and one row: inserted, updated, skipped (rows without an output).

    A new job is inserted by its first row; each further row of its id, and every
    row of a known one, is an update and sets the updated columns (created_at
    too, so that a job that ran again comes first in listings). order: what numbers
    incoming rows, such as their place in the log.
    """
    usable = incoming.where("generated_video_path IS NOT NULL")
    rest = [c for c in existing.columns if c != key]
    at = F.struct(*order)
    own = usable.groupBy(key).agg(F.min_by(F.struct(*rest), at).alias("first"), F.max_by(F.struct(*rest), at).alias("last"), F.count("*").alias("n"))
    both = existing.select(key, F.struct(*rest).alias("a")).join(own, key, "full_outer")
    known, new = F.col("a").isNotNull(), F.col("n").isNotNull()
    take = lambda c: F.when(new & F.lit(c in updated), F.col(f"last.{c}")).when(known, F.col(f"a.{c}")).otherwise(F.col(f"first.{c}"))
    counts = both.agg(F.count_if(~known).alias("inserted"), (F.coalesce(F.sum("n"), F.lit(0)) - F.count_if(~known)).alias("updated"))
    skipped = incoming.agg(F.count_if(F.col("generated_video_path").isNull()).alias("skipped"))
    return both.select(key, *[take(c).alias(c) for c in rest]), counts.join(F.broadcast(skipped))  # one row each


def failures(results: DataFrame) -> DataFrame:
    """filename, error (of the last attempt, 80 characters at most) of failed items."""
    return results.where("status = 'failed'").select("filename", F.substring(F.coalesce(F.element_at(F.when(F.size("attempts") > 0, F.col("attempts")), -1)["error"], F.lit("")), 1, 80).alias("error"))


def recent(df: DataFrame, order: list[Column], limit: int = 50, where: Column | None = None, per: str | None = None) -> DataFrame:
    """The newest rows (1 to 200) by order, of all or of each per."""
    limit = min(200, max(1, limit))
    rows = df if where is None else df.where(where)
    if per is None:
        return rows.orderBy(*order).limit(limit)
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(per).orderBy(*order))).where(F.col("__r") <= limit).drop("__r")


def retention(tasks: DataFrame, keep: int = 5) -> DataFrame:
    """task_id of completed tasks beyond the newest keep; keep <= 0 cleans nothing. The newest are found by a distributed top-k."""
    done = tasks.where("status = 'completed'")
    if keep <= 0:
        return done.select("task_id").limit(0)
    newest = done.orderBy(F.desc("created_at"), F.desc("task_id")).limit(keep).select("task_id")
    return done.select("task_id").join(newest, "task_id", "left_anti")


def trained_tasks(tasks: DataFrame, files: DataFrame, vocab: DataFrame) -> DataFrame:
    """task_id, name, has_prototypes, vocab_size of tasks that have a model. files: task_id, kind (model, prototypes); vocab: task_id, token."""
    models = files.where("kind = 'model'").select("task_id").distinct()
    protos = files.where("kind = 'prototypes'").select("task_id").distinct().withColumn("p", F.lit(True))
    sizes = vocab.groupBy("task_id").agg(F.countDistinct("token").alias("vocab_size"))
    rows = tasks.join(models, "task_id", "left_semi").join(protos, "task_id", "left").join(sizes, "task_id", "left")
    return rows.select("task_id", "name", F.coalesce("p", F.lit(False)).alias("has_prototypes"), F.coalesce("vocab_size", F.lit(0)).alias("vocab_size"))


def attach_results(results: DataFrame, batches: DataFrame, subs: DataFrame, pattern: str) -> DataFrame:
    """Completed results with the text and source id of the sentence whose id is in the file name. batches: id, text; subs: videoFileName, videoId, seq."""
    sid = lambda c: F.when(F.regexp_extract(c, pattern, 1) != "", F.regexp_extract(c, pattern, 1).cast("long"))
    texts = batches.groupBy(F.col("id").alias("sid")).agg(F.max_by("text", "seq").alias("text"))
    ids = subs.select(sid("videoFileName").alias("sid"), "videoId", "seq").where("sid IS NOT NULL").groupBy("sid").agg(F.max_by("videoId", "seq").alias("video_id"))
    return results.where("status = 'completed'").select("filename", sid("filename").alias("sid")).join(texts, "sid", "left").join(ids, "sid", "left")


def stage_funnel(records: DataFrame, results: DataFrame, stages: list[str]) -> DataFrame:
    """stage, entered, ok, failed: a stage takes the ids whose stage before was ok; all, if that has no result. results: stage, id, ok."""
    now, out = records.select("id").distinct(), None
    seen = {r.stage for r in results.select("stage").distinct().where(F.col("stage").isin(*stages)).collect()}  # no more than the stages named
    for stage in stages:
        own = now.join(results.where(F.col("stage") == stage).groupBy("id").agg(F.max("ok").alias("ok")), "id", "left")
        row = own.agg(F.lit(stage).alias("stage"), F.count("*").alias("entered"), F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("failed"))
        out = row if out is None else out.unionByName(row)
        if stage in seen:
            now = own.where("ok").select("id")
    return out
