"""Structured Streaming jobs: live reviews, counters, recognition sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from glossworks.functions.common import last_wins
from glossworks.operators.similarity import nearest_prototype

#: Frames of a window and between windows, and least hand and head scores.
SIZE, STRIDE, LEAST = 6, 3, 0.8


def stream_table(spark: SparkSession, path: str, schema, glob: str = "*.parquet", per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", per_trigger).parquet(path)


#: Parts that ids are dealt to by hash, each a folder of the index.
PARTS = 256


def stream_reviews(rows: DataFrame, path: str, key: str = "videoId", time: str = "addedAt") -> DataFrame:
    """Each id once and for all, with the earliest row of the micro-batch that first has it; run over all that is there.

    Beside the rows stands an index of the ids seen, in PARTS folders by hash, each
    file with a Bloom filter. A micro-batch reads the folders that its own ids
    belong to, and of them what batches before it wrote: one that runs again
    writes the same again. There is no horizon after which an id comes anew. Null ids are
    one id.
    """
    spark = rows.sparkSession
    kind = rows.schema[key].dataType.simpleString()
    part = F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")

    def batch(df: DataFrame, epoch: int) -> None:
        own = df.sparkSession
        best = F.min_by(F.struct(*df.columns), F.struct(time, F.xxhash64(*df.columns))).alias("w")
        new = df.groupBy(F.col(key).alias("__k")).agg(best).select("w.*").withColumn("part", part)
        new.write.mode("overwrite").parquet(f"{path}/batches/{epoch}")
        new = own.read.parquet(f"{path}/batches/{epoch}")
        parts = [r.part for r in new.select("part").distinct().collect()]  # PARTS at most
        folders = [p for p in (f"{path}/index/part={x}" for x in parts) if epoch and _there(own, p)]
        if folders:
            seen = own.read.option("basePath", f"{path}/index").schema(f"`{key}` {kind}, part int, batch long").parquet(*folders).where(F.col("batch") < epoch)
            same = new[key].eqNullSafe(seen[key]) & (new["part"] == seen["part"])
            new = new.join(seen, same, "left_anti")
        new.drop("part").write.mode("overwrite").parquet(f"{path}/rows/batch={epoch}")
        # what a run of this batch that failed has left in the index goes first
        fresh = own.read.parquet(f"{path}/rows/batch={epoch}").select(key, part.alias("part"), F.lit(epoch).cast("long").alias("batch"))
        fresh.repartition("part").write.mode("overwrite").partitionBy("part", "batch").option("partitionOverwriteMode", "dynamic").option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(f"{path}/index")
        _forget(own, f"{path}/batches/{epoch}")

    rows.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).foreachBatch(batch).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{path}/rows").select(*rows.columns)


def _there(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def stream_progress(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").count()


def kept_frames(frames: DataFrame) -> DataFrame:
    return frames.where((F.col("hand") >= LEAST) & (F.col("head") >= LEAST))


def session_windows(frames: DataFrame) -> DataFrame:
    """session, window (from 0), centre, vec (mean of its frames): windows of SIZE kept frames, STRIDE apart. The batch twin of stream_windows."""
    own = Window.partitionBy("session").orderBy("frame_no")
    rows = kept_frames(frames).withColumn("n", F.row_number().over(own)).withColumn("vecs", F.collect_list("vec").over(own.rowsBetween(1 - SIZE, 0)))
    return _means(rows.where((F.col("n") >= SIZE) & ((F.col("n") - SIZE) % STRIDE == 0)))


def _means(rows: DataFrame) -> DataFrame:
    """session, window, centre, vec of rows with n and the vecs of a full window."""
    mean = F.transform(F.sequence(F.lit(1), F.size(F.element_at("vecs", 1))), lambda d: F.aggregate("vecs", F.lit(0.0), lambda a, v: a + F.element_at(v, d)) / SIZE)
    return rows.select("session", F.floor((F.col("n") - SIZE) / STRIDE).cast("long").alias("window"), (F.col("n") - SIZE + SIZE // 2).cast("long").alias("centre"), mean.alias("vec"))


def advance(frames: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """session_windows that new frames complete, and the state after them: session, n (kept frames so far), vecs (the last SIZE - 1, in order)."""
    old = state.select("session", "n", F.size("vecs").alias("k"), F.posexplode("vecs").alias("p", "vec"))
    old = old.select("session", (F.col("n") - F.col("k") + F.col("p") + 1).alias("n"), "vec", F.lit(False).alias("new"))
    kept = kept_frames(frames).join(state.select("session", F.col("n").alias("before")), "session", "left")
    own = Window.partitionBy("session").orderBy("frame_no")
    fresh = kept.select("session", (F.coalesce("before", F.lit(0)) + F.row_number().over(own)).alias("n"), "vec", F.lit(True).alias("new"))
    rows = old.unionByName(fresh).withColumn("vecs", F.collect_list("vec").over(Window.partitionBy("session").orderBy("n").rowsBetween(1 - SIZE, 0)))
    full = rows.where("new").where((F.col("n") >= SIZE) & ((F.col("n") - SIZE) % STRIDE == 0))
    last = rows.groupBy("session").agg(F.max("n").alias("n"), F.max_by("vecs", "n").alias("v"))
    after = last.select("session", "n", F.when(F.size("v") >= SIZE, F.slice("v", 2, SIZE - 1)).otherwise(F.col("v")).alias("vecs"))
    return _means(full), after


#: Micro-batches after which the states of all sessions are written together, and without a frame in which a session is forgotten.
WHOLE, IDLE = 16, 1000


def _forget(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stream_windows(frames: DataFrame, path: str, prototypes: DataFrame | None = None, idle: int = IDLE) -> DataFrame:
    """session_windows of a stream, run over all that is there; with prototypes (as of nearest_prototype) each window's token and score.

    A session's state is a count and SIZE - 1 vectors. A micro-batch reads the last
    state of all sessions (written every WHOLE batches) and what changed since,
    and writes the sessions it changed and its windows under its own number: a
    batch that runs again writes the same again. Sessions without a frame for
    idle batches and states that no batch needs any more are dropped.
    """
    spark, kinds = frames.sparkSession, {f.name: f.dataType.simpleString() for f in frames.schema.fields}
    schema = f"session {kinds['session']}, n bigint, vecs array<{kinds['vec']}>, seen bigint"

    def before(own: SparkSession, epoch: int) -> DataFrame:
        """The states that batches before this one left."""
        if not epoch:
            return own.createDataFrame([], schema)
        whole = (epoch - 1) // WHOLE * WHOLE
        parts = [f"{path}/whole/{whole}", *(f"{path}/changed/{e}" for e in range(whole + 1, epoch))]
        return last_wins(own.read.schema(schema).parquet(*parts), ["session"], ["seen"])

    def batch(df: DataFrame, epoch: int) -> None:
        own = df.sparkSession
        state = before(own, epoch)
        windows, after = advance(df, state)
        if prototypes is not None:
            named = windows.withColumn("id", F.struct("session", "window"))
            windows = named.join(nearest_prototype(named, prototypes), "id").drop("id")
        windows.write.mode("overwrite").parquet(f"{path}/windows/batch={epoch}")
        changed = kept_frames(df).select("session").distinct()
        after = after.join(changed, "session", "left_semi").select("session", F.col("n").cast("long").alias("n"), "vecs", F.lit(epoch).cast("long").alias("seen"))
        after.write.mode("overwrite").parquet(f"{path}/changed/{epoch}")
        if epoch % WHOLE == 0:
            now = own.read.schema(schema).parquet(f"{path}/changed/{epoch}")
            rest = state.join(now.select("session"), "session", "left_anti").where(F.col("seen") > epoch - idle)
            now.unionByName(rest).write.mode("overwrite").parquet(f"{path}/whole/{epoch}")
            old = epoch - WHOLE  # still needed if this batch runs again
            _forget(own, f"{path}/whole/{old - WHOLE}", *(f"{path}/changed/{e}" for e in range(old - WHOLE, old + 1)))

    frames.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).foreachBatch(batch).start().awaitTermination()
    return spark.read.parquet(f"{path}/windows").drop("batch")


def run_once(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there and gives what it wrote; exactly once by the sink's own checkpoint."""
    spark = stream.sparkSession
    if mode == "append":
        stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).format("parquet").start(f"{path}/rows").awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{path}/rows")

    def keep(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/rows/{epoch % 2}")
        df.sparkSession.createDataFrame([(epoch % 2,)], "last int").write.mode("overwrite").parquet(f"{path}/last")

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    return spark.read.parquet(f"{path}/rows/{spark.read.parquet(f'{path}/last').first().last}")
