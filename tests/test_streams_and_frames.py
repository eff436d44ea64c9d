"""Ids once for all on a stream, and videos that are cut into stretches."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from glossworks.operators import frames, jobs
from glossworks.streaming import live


def test_an_id_that_comes_again_after_years_adds_nothing(spark, tmp_path):
    schema = "videoId string, addedAt timestamp, n int"
    parts = [
        [("a", "2001-01-01", 1), ("b", "2001-01-02", 2), ("a", "2000-12-31", 3), (None, "2001-01-01", 4)],
        [("a", "2019-01-01", 5), ("c", "2019-01-01", 6)],
        [("b", "1990-01-01", 7), ("c", "2024-01-01", 8), (None, "2024-01-01", 9), ("d", "2024-01-01", 10)],
    ]
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(source)
    for i, part in enumerate(parts):
        spark.createDataFrame(part, "videoId string, at string, n int").select("videoId", F.to_timestamp("at").alias("addedAt"), "n").coalesce(1).write.parquet(f"{source}/{i}")
        got = live.stream_reviews(stream(), out)
    want = [("a", 3), ("b", 2), ("c", 6), ("d", 10), (None, 4)]
    assert sorted(((r.videoId, r.n) for r in got.collect()), key=str) == sorted(want, key=str)
    # the last batch runs again, as after a failure before its commit
    last = max(os.listdir(f"{out}/checkpoint/commits"), key=lambda x: (x.isdigit(), x))
    for name in (last, f".{last}.crc"):
        if os.path.exists(f"{out}/checkpoint/commits/{name}"):
            os.remove(f"{out}/checkpoint/commits/{name}")
    again = live.stream_reviews(stream(), out)
    assert sorted(((r.videoId, r.n) for r in again.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("chunk", [7, 16, 4096])
def test_stretches_change_nothing(spark, monkeypatch, chunk):
    monkeypatch.setattr(frames, "CHUNK", chunk)
    r = random.Random(1)
    wave = lambda n: [r.choice([0.0, 1.0, 5.0, 5.0]) if (i // 30) % 2 == 0 else r.choice([0.0, 0.5]) for i in range(n)]
    rows = [(v, i * 3 + (i > 50) * 40, x) for v, n in (("a", 200), ("b", 25), ("c", 1), (None, 90)) for i, x in enumerate(wave(n))]
    diffs = spark.createDataFrame(rows, "video string, i int, diff double").repartition(4)
    placed = {(x.video, x.i): (x.place, x.n) for x in frames._in_order(diffs.select("video", F.col("i").alias("at"), "diff"), "video", "at").select("video", F.col("at").alias("i"), F.col("i").alias("place"), "n").collect()}
    by = {}
    for v, i, x in rows:
        by.setdefault(v, []).append((i, x))
    assert placed == {(v, i): (p, len(own)) for v, own in by.items() for p, (i, _) in enumerate(sorted(own))}
    want = {}
    for v, own in by.items():
        xs = [x for _, x in sorted(own)]
        at = [i for i, _ in sorted(own)]
        s = [sum(w) / len(w) for w in (xs[max(0, p - 5) : p + 5] for p in range(len(xs)))]
        active = next((i for i, x in zip(at, s, strict=True) if x > 2.0), None)
        quiet = next((i for i, x in zip(at, s, strict=True) if active is not None and x < 1.5 and i > active), None)
        again = next((i for i, x in zip(at, s, strict=True) if quiet is not None and x > 2.0 and i > quiet), None)
        want[v] = (len(xs) + 1, quiet if again is not None and quiet >= 10 and len(xs) + 1 >= 20 else None)
    assert {x.video: (x.n, x.cut) for x in frames.repeat_cut(diffs).collect()} == want
    line = frames.gloss_timeline(diffs.select(F.col("video").alias("job"), F.col("i").alias("pos"), F.lit("G").alias("gloss"), F.when(F.col("diff") > 0, F.col("diff")).alias("duration")))
    own = Window.partitionBy("job").orderBy("pos")
    assert line.withColumn("want", F.coalesce(F.sum(F.col("end") - F.col("start")).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))).where("abs(start - want) > 1e-9 OR start IS NULL").count() == 0
    sentences = diffs.select(F.col("video").alias("job"), F.col("i").alias("idx"), F.col("diff").cast("int").alias("n_frames"))
    clips = {}
    for v, own_rows in by.items():
        kept = [(i, int(x)) for i, x in sorted(own_rows) if int(x) > 0]
        t = 0
        for k, (i, n) in enumerate(kept):
            end = t + n + (125 if k < len(kept) - 1 else 0)
            clips[v, i] = (round(t / 25, 3), round(end / 25, 3))
            t = end
    assert {(x.job, x.idx): (x.start_time, x.end_time) for x in frames.test_timeline(sentences, 25.0).collect()} == clips


def test_one_long_video_is_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(frames, "CHUNK", 100)
    diffs = spark.range(5000).select(F.lit("v").alias("video"), F.col("id").cast("int").alias("i"), F.lit(1.0).alias("diff"))
    placed = frames._in_order(diffs.withColumnRenamed("i", "at"), "video", "at")
    assert placed.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_upserts_follow_the_given_order(spark):
    schema = "job_id string, status string, generated_video_path string, updated_at int, line int"
    new = spark.createDataFrame([("a", "running", "x", 5, 1), ("a", "completed", "y", 2, 2)], schema)
    merged, _ = jobs.upsert_jobs(spark.createDataFrame([], schema), new, ["line"])
    assert merged.first().status == "completed"
    with pytest.raises(TypeError):
        jobs.upsert_jobs(new, new)


def _json_like(r, depth=0):
    kind = r.randrange(4 if depth < 3 else 2)
    if kind == 0:
        return r.choice([1, -2.5, None, True, 10**12])
    if kind == 1:
        return "".join(r.choices('ab,"\\[]{}:é \n', k=r.randint(0, 12)))
    if kind == 2:
        return [_json_like(r, depth + 1) for _ in range(r.randint(0, 3))]
    return {f"k{i},": _json_like(r, depth + 1) for i in range(r.randint(0, 3))}


@pytest.mark.parametrize("split", ["64", "128m"])
def test_json_files_are_read_in_splits(spark, tmp_path, split):
    import json

    from glossworks.sources import io

    r = random.Random(3)
    maps = [{f"key {i} {r.random()}": json.dumps(_json_like(r)) for i in range(n)} for n in (0, 1, 60, 25)]
    arrays = [[{"id": i, "text": json.dumps(_json_like(r)), "more": {"a": [i, i]}} for i in range(n)] for n in (0, 1, 70)]
    for kind, files in (("maps", maps), ("arrays", arrays)):
        (tmp_path / kind).mkdir()
        for i, data in enumerate(files):
            (tmp_path / kind / f"{i}.json").write_text(json.dumps(data, indent=2 if i % 2 else None, ensure_ascii=bool(i % 2)), newline="")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert dict(map(tuple, io.read_json_map(spark, f"{tmp_path}/maps", "string").collect())) == {k: v for m in maps for k, v in m.items()}
        got = io.read_json_array(spark, f"{tmp_path}/arrays", "id int, text string, more struct<a: array<int>>").collect()
        assert sorted((x.id, x.text, x.more.a) for x in got) == sorted((x["id"], x["text"], x["more"]["a"]) for a in arrays for x in a)
        (tmp_path / "cut").mkdir()
        (tmp_path / "cut" / "x.json").write_text(json.dumps(arrays[2])[:-9])
        with pytest.raises(Exception, match="left open"):
            io.read_json_array(spark, f"{tmp_path}/cut", "id int").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_grid_in_mixed_radix(spark):
    import itertools

    from glossworks.operators import augment

    table = spark.createDataFrame([("x",), ("y",), (None,), ("x",)], "s string")
    got = augment.param_grid(spark, {"a": [1, 2, 3], "b": table, "c": [0.5, 1.5]})
    assert got.columns == ["a", "b", "c"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(itertools.product([1, 2, 3], ["x", "y", None], [0.5, 1.5]), key=str)
    assert augment.param_grid(spark, {"a": [1], "b": table.where("false")}).count() == 0
    big = augment.param_grid(spark, {k: list(range(100)) for k in "abcd"})
    assert big.rdd.getNumPartitions() > 1 and big.where("a = 7 AND b = 3 AND c = 99 AND d = 0").count() == 1
