"""Review reports kept up to date: each increment of the logs changes the counts that it touches, and the logs aren't read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossworks.operators.review import STATUSES, _status
from glossworks.streaming.ledger import Ledger

KINDS = (*STATUSES, "pending")
COUNTS = ("recorded", *KINDS)


def batch_of(name: Column) -> Column:
    """What stands before the first _ of a file name."""
    return F.substring_index(name, "_", 1)


def _decisions(spark: SparkSession, path: str) -> Ledger:
    return Ledger(spark, f"{path}/decisions", "videoId string, decision string, seq long", ("videoId",))


def _recordings(spark: SparkSession, path: str) -> Ledger:
    return Ledger(spark, f"{path}/recordings", "videoId string, sentenceId string, batch string, source string, n long", ("videoId", "sentenceId", "batch", "source"))


def _counts(spark: SparkSession, path: str) -> Ledger:
    return Ledger(spark, f"{path}/counts", f"sentenceId string, batch string, {', '.join(f'{c} long' for c in COUNTS)}", ("sentenceId", "batch"))


def _later(before: Column, new: Column) -> Column:
    """The decision of the later seq; of equal ones the last as text; one without a seq never wins."""
    older = before.isNull() | before["seq"].isNull() | (F.struct(before["seq"], before["decision"]) < F.struct(new["seq"], new["decision"]))
    winner = F.when(new["seq"].isNotNull() & older, new).otherwise(F.coalesce(before, new))
    return F.struct(winner["decision"].alias("decision"), winner["seq"].alias("seq"))


def _sums(columns: tuple[str, ...]):
    return lambda before, new: F.struct(*[(F.coalesce(before[c], F.lit(0)) + new[c]).alias(c) for c in columns])


def _counted(n: Column, status: Column) -> list[Column]:
    return [F.when(status == k, n).otherwise(F.lit(0)).alias(k) for k in KINDS]


def advance(spark: SparkSession, path: str, n: int, subs: DataFrame, decs: DataFrame, batch: Column | None = None) -> None:
    """Step n (from 0, without gaps) of the reports at path: new rows of the submissions and of the decisions, in any order.

    A recording counts by its id's decision of the latest seq, as in review_status.
    An id's rows are counted before they are shuffled, so that a hot id is few rows.
    Null ids have no decision; empty increments change nothing. A step
    may run again, with the same rows, until the next one has run.
    """
    given = batch_of(F.col("videoFileName")) if batch is None else batch
    decisions, recordings, counts = _decisions(spark, path), _recordings(spark, path), _counts(spark, path)

    last = F.max(F.when(F.col("seq").isNotNull(), F.struct("seq", "decision"))).alias("w")
    new = decs.where("videoId IS NOT NULL").groupBy("videoId").agg(last).select("videoId", "w.decision", F.col("w.seq").cast("long").alias("seq"))
    judged = decisions.step(n, new, _later)
    turned = judged.select("videoId", _status(F.col("before.decision")).alias("was"), _status(F.col("after.decision")).alias("now")).where("was <> now")

    own = subs.select("videoId", F.col("sentenceId").cast("string").alias("sentenceId"), given.alias("batch"), "source")
    added = recordings.step(n, own.groupBy("videoId", "sentenceId", "batch", "source").agg(F.count("*").alias("n")), _sums(("n",)))

    # what was recorded before moves with its decision; what is new counts as its id stands now
    moved = recordings.rows(n - 1, turned).where("source = 'submission'").join(turned, "videoId")
    moved = moved.select("sentenceId", "batch", F.lit(0).cast("long").alias("recorded"), *[(x - y).alias(k) for k, x, y in zip(KINDS, _counted(F.col("n"), F.col("now")), _counted(F.col("n"), F.col("was")), strict=True)])
    fresh = added.where("source = 'submission'").withColumn("n", F.col("after.n") - F.coalesce("before.n", F.lit(0)))
    stands = decisions.rows(n, fresh).select("videoId", "decision")
    fresh = fresh.join(stands, "videoId", "left").select("sentenceId", "batch", F.col("n").alias("recorded"), *_counted(F.col("n"), _status(F.col("decision"))))
    sums = moved.unionByName(fresh).groupBy("sentenceId", "batch").agg(*[F.sum(c).alias(c) for c in COUNTS])
    counts.step(n, sums, _sums(COUNTS))


def summary(spark: SparkSession, path: str, n: int, batch: str | None = None) -> DataFrame:
    """review_summary of review_status after step n, from the counts alone."""
    rows = _counts(spark, path).rows(n)
    rows = rows.where(F.col("batch") == batch) if batch else rows
    total = {"total_submissions": "recorded", **{k: k for k in KINDS}}
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in total.items()])


def sentence_progress(spark: SparkSession, path: str, n: int, batch: DataFrame) -> DataFrame:
    """review.sentence_progress after step n, from the counts alone."""
    rows = _counts(spark, path).rows(n).groupBy("sentenceId").agg(*[F.sum(c).alias(c) for c in COUNTS])
    joined = batch.select("id", "text").join(rows, F.col("id").cast("string") == F.col("sentenceId"), "left").drop("sentenceId")
    return joined.fillna(0, list(COUNTS))


def generated_review(spark: SparkSession, path: str, n: int, prefix: str) -> DataFrame:
    """review.generated_review after step n, from one row a recording and one a decision."""
    own = _recordings(spark, path).rows(n).where(F.col("videoId").startswith(prefix)).select("videoId").distinct()
    joined = own.join(_decisions(spark, path).rows(n), "videoId", "left")
    return joined.select("videoId", F.substring("videoId", len(prefix) + 1, 1 << 20).alias("word"), _status(F.col("decision")).alias("status"))


def stream_reports(rows: DataFrame, path: str) -> int:
    """Advances the reports at path by each micro-batch of rows, run over all that is there; returns the last step (-1: none).

    rows: the columns of both logs, and log: submission or decision. The stream's own batch
    numbers are the steps, so a batch that runs again after a failure counts once.
    """

    def batch(df: DataFrame, epoch: int) -> None:
        own = df.persist()
        advance(df.sparkSession, path, epoch, own.where("log = 'submission'"), own.where("log = 'decision'"))
        own.unpersist()

    rows.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).foreachBatch(batch).start().awaitTermination()
    return _last_step(rows.sparkSession, path)


def _last_step(spark: SparkSession, path: str) -> int:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/counts/steps")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return max((int(f.getPath().getName()) for f in files.listStatus(place)), default=-1) if files.exists(place) else -1
