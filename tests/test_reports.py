"""Review reports that follow the logs by increments, against the batch queries over all rows so far."""

import os
import random

from pyspark.sql import functions as F

from glossworks.operators import review as rv
from glossworks.streaming import ledger, reports
from glossworks.streaming.ledger import Ledger

SUBS = "videoId string, sentenceId long, videoFileName string, source string, seq long"
DECS = "videoId string, decision string, seq long"


def _logs(r, steps):
    """Increments: a hot id, repeated rows, ids judged before they are recorded, decisions out of order, nulls and empty increments."""
    out, seq = [], list(range(10_000))
    r.shuffle(seq)
    for i in range(steps):
        ids = lambda: r.choice(["hot", "hot", None, *(f"{r.choice(['gen_', 'v'])}{k}" for k in range(12))])
        subs = [(ids(), r.choice([1, 2, 3, None]), f"b{r.randint(1, 2)}_{r.randint(1, 9)}.mp4", r.choice(["submission", "submission", "generated"]), seq.pop()) for _ in range(0 if i == 3 else 25)]
        decs = [(ids(), r.choice(["approved", "rejected", "odd", None]), r.choice([seq.pop(), seq.pop(), None])) for _ in range(0 if i in (3, 5) else 15)]
        out.append((subs + subs[:3], decs + decs[:2]))
    return out


def _set(df):
    return sorted(map(str, (r.asDict() for r in df.select(*sorted(df.columns)).collect())))


def _same(spark, path, n, subs, decs):
    batch = spark.createDataFrame([(k, f"text {k}") for k in (1, 2, 3, 4)], "id long, text string")
    all_subs, all_decs = spark.createDataFrame(subs, SUBS), spark.createDataFrame(decs, DECS)
    for b in (None, "b1"):
        assert _set(reports.summary(spark, path, n, b)) == _set(rv.review_summary(rv.review_status(all_subs, all_decs, b)))
    assert _set(reports.sentence_progress(spark, path, n, batch)) == _set(rv.sentence_progress(batch, all_subs, all_decs))
    assert _set(reports.generated_review(spark, path, n, "gen_")) == _set(rv.generated_review(all_subs, all_decs, "gen_"))


def _by_hand(subs, decs):
    """total, approved, rejected, pending by going through all rows."""
    last = {}
    for video, decision, seq in decs:
        if video is not None and seq is not None:
            last[video] = max(last.get(video, (-1, "")), (seq, decision), key=lambda x: x[0])
    status = [d if d in ("approved", "rejected") else "pending" for d in (last.get(s[0], (0, None))[1] for s in subs if s[3] == "submission")]
    return len(status), *(status.count(k) for k in ("approved", "rejected", "pending"))


def test_reports_follow_increments_and_equal_the_batch_queries(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "PART_ROWS", 32)
    path, subs, decs = str(tmp_path), [], []
    for n, (s, d) in enumerate(_logs(random.Random(3), 4)):
        for _ in range(2 if n == 1 else 1):  # a step that runs again changes nothing
            reports.advance(spark, path, n, spark.createDataFrame(s, SUBS).coalesce(1), spark.createDataFrame(d, DECS).coalesce(1))
        subs, decs = subs + s, decs + d
        assert reports.summary(spark, path, n).first() == _by_hand(subs, decs)
    _same(spark, path, n, subs, decs)


def test_a_step_reads_the_parts_of_its_keys_and_few_runs_are_kept(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "PART_ROWS", 64)
    kept = Ledger(spark, str(tmp_path), "k string, n long", ("k",))
    add = lambda before, new: F.struct((F.coalesce(before["n"], F.lit(0)) + new["n"]).alias("n"))
    kept.step(0, spark.range(4000).select(F.col("id").cast("string").alias("k"), F.lit(1).cast("long").alias("n")), add)
    for n in range(1, 8):
        changes = kept.step(n, spark.createDataFrame([("7", 1), (f"new {n}", 5)], "k string, n long"), add)
        assert {r.k: r.before and r.before.n for r in changes.collect()} == {"7": n, f"new {n}": None}
    ids = spark.createDataFrame([("7",)], "k string")
    some, every = kept.rows(7, ids), kept.rows(7)
    assert some.collect() == [("7", 8)]
    assert (every.count(), every.agg(F.sum("n")).first()[0]) == (4007, 4000 + 7 + 35)
    read = lambda df: df.select(F.col("_metadata.file_path").alias("f")).distinct().count()
    parts = kept._runs(7)[0][2]
    assert parts > 32 and len(kept._runs(7)) <= 5
    asked = [r[0] for r in ids.select(kept._part(parts)).collect()]
    base = spark.read.parquet(f"{tmp_path}/runs/0")
    assert len(asked) == 1 and read(base.where(F.col("__part").isin(asked))) == 1 and read(base) > 32
    assert "PartitionFilters: [isnotnull(__part" in kept._read(kept._runs(7), ids)._jdf.queryExecution().toString()
    assert len(os.listdir(f"{tmp_path}/runs")) <= len(set(kept._runs(6) + kept._runs(7))) + 1


def test_reports_by_a_stream(spark, tmp_path):
    path, subs, decs = f"{tmp_path}/out", [], []
    schema = SUBS + ", decision string, log string"
    for i, (s, d) in enumerate(_logs(random.Random(5), 2)):
        rows = [(*x, None, "submission") for x in s] + [(v, None, None, None, q, w, "decision") for v, w, q in d]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        n = reports.stream_reports(stream, path)
        assert n == i
        subs, decs = subs + s, decs + d
    _same(spark, path, n, subs, decs)


def test_reports_of_empty_logs(spark, tmp_path):
    reports.advance(spark, str(tmp_path), 0, spark.createDataFrame([], SUBS), spark.createDataFrame([], DECS))
    assert reports.summary(spark, str(tmp_path), 0).first() == (0, 0, 0, 0)
