"""Job, streaming and reader queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from glossworks.functions.common import shared_dir
from glossworks.operators import jobs as jb
from glossworks.operators import similarity as sr
from glossworks.sources import io
from glossworks.streaming import live, reports

from .tables import table as t

STATUS = "CASE o_custkey % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'skipped_short' WHEN 2 THEN 'retry_success' ELSE 'success' END"


def _results(s, d):
    return t(s, d, "orders").select(F.concat("o_orderkey", F.lit(".mp4")).alias("filename"), F.expr(STATUS).alias("status"), (F.col("o_orderkey") % 100).cast("double").alias("wall_sec"), F.expr("transform(sequence(1, cast(o_orderkey % 3 as int) + 1), i -> named_struct('status', 'failed', 'error', concat('try ', i)))").alias("attempts"))


def _files(s, d):
    return t(s, d, "orders").select(F.concat(F.lpad(F.col("o_orderkey").cast("string"), 8, "0"), F.lit(".mp4")).alias("name"), "o_orderkey")


def _jobs(s, d, where):
    return t(s, d, "orders").where(where).select(F.concat(F.lit("job"), "o_orderkey").alias("job_id"), F.concat(F.lit(where[0:1]), "o_orderkey").alias("video_id"), F.lit("completed").alias("status"), F.when(F.col("o_orderkey") % 11 != 0, F.concat(F.lit(where[0:1]), "o_custkey")).alias("generated_video_path"), F.col("o_orderdate").alias("created_at"), F.col("o_orderdate").alias("updated_at"))


def _again(s, d):
    """Jobs that run once more, a fifth of them twice."""
    once = _jobs(s, d, "(o_orderkey % 3 = 0)")
    later = lambda df, n: df.withColumns({c: F.col(c) + F.make_interval(days=F.lit(n)) for c in ("created_at", "updated_at")})
    twice = later(once.where("CAST(substring(job_id, 4) AS BIGINT) % 5 = 0"), 2).withColumn("generated_video_path", F.when(F.col("generated_video_path").isNotNull(), "late"))
    return later(once, 1).unionByName(twice)


def _tasks(s, d):
    return t(s, d, "orders").select(F.concat(F.lit("task"), "o_orderkey").alias("task_id"), F.col("o_orderpriority").alias("name"), F.when(F.col("o_orderstatus") == "F", "completed").otherwise("running").alias("status"), F.col("o_orderdate").alias("created_at"))


def _stages(s, d):
    return t(s, d, "orders").select(F.col("o_orderkey").alias("id")), t(s, d, "orders").select(F.explode(F.array(F.lit("stage"), F.lit("submit"))).alias("stage"), F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 4 != 0).alias("ok"))


def _place(s):
    return f"{shared_dir(s)}/stream-{uuid.uuid4().hex}"


def _events(s, d):
    return live.stream_table(s, d, t(s, d, "events").schema, "events.parquet")


def _frames(s, d, events):
    hand = F.least(F.lit(1.0), F.lit(0.7) + F.col("value") / 200)
    return events.select(F.col("user_id").alias("session"), F.col("event_id").alias("frame_no"), hand.alias("hand"), F.lit(0.9).alias("head"), F.array(F.col("value"), (F.col("event_id") % 7).cast("double"), F.lit(1.0)).alias("vec"))


VECTORS = """k AS (SELECT user_id AS session, event_id, value, event_id % 7 AS v2, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events WHERE least(1.0, 0.7 + value / 200) >= 0.8),
        w AS (SELECT session, n, avg(value) OVER x AS a, avg(v2) OVER x AS b FROM k WINDOW x AS (PARTITION BY session ORDER BY n ROWS BETWEEN 5 PRECEDING AND CURRENT ROW))"""
WINDOWS = f"""{VECTORS}
        SELECT session, ((n - 6) // 3)::BIGINT AS "window", (n - 3)::BIGINT AS centre, round(a, 6) AS a, round(b, 6) AS b FROM w WHERE n >= 6 AND (n - 6) % 3 = 0"""


RECOGNIZED = f"""WITH {VECTORS}, p (x, y, z, token) AS (VALUES (1.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 'LOUD'), (0.0, 1.0, 0.0, 'SEVEN'), (0.3, 0.3, 0.9, 'EVEN')),
        f AS (SELECT session || '/' || ((n - 6) // 3) AS id, (a * x + b * y + z) / (sqrt(a * a + b * b + 1) * sqrt(x * x + y * y + z * z)) AS sim, token FROM w, p WHERE n >= 6 AND (n - 6) % 3 = 0)
        SELECT id, arg_max(token, sim) AS token, round(max(sim), 6) AS score FROM f GROUP BY id"""


def _flat(df):
    return df.select("session", "window", "centre", F.round(F.get("vec", F.lit(0)), 6).alias("a"), F.round(F.get("vec", F.lit(1)), 6).alias("b"))


def _protos(s):
    return s.createDataFrame([(0, [1.0, 0.0, 0.0], "LOUD"), (1, [0.0, 1.0, 0.0], "SEVEN"), (2, [0.3, 0.3, 0.9], "EVEN")], "proto_id int, vec array<double>, token string")


def _recognize_live(s, d):
    rows = live.stream_windows(_frames(s, d, _events(s, d)), _place(s), _protos(s))
    return rows.select(F.concat_ws("/", "session", "window").alias("id"), "token", F.round("score", 6).alias("score"))


def _recognize(s, d):
    protos = _protos(s)
    w = live.session_windows(_frames(s, d, t(s, d, "events"))).withColumn("id", F.concat_ws("/", "session", "window"))
    return sr.nearest_prototype(w, protos).withColumn("score", F.round("score", 6))


def _summary_live(s, d):
    """Submissions and decisions as one stream of events."""
    video = F.expr("'v' || (user_id * 20 + event_id % 20)")
    rows = _events(s, d).where("event_type IN ('view', 'click', 'purchase', 'error')").select(
        video.alias("videoId"), (F.col("user_id") % 50).alias("sentenceId"), F.expr("'b' || user_id % 3 || '_x.mp4'").alias("videoFileName"), F.when(F.col("event_type") == "view", "submission").otherwise("generated").alias("source"),
        F.col("event_id").alias("seq"), F.when(F.col("event_type") == "purchase", "approved").otherwise("rejected").alias("decision"), F.when(F.col("event_type").isin("view", "click"), "submission").otherwise("decision").alias("log"),
    )
    path = _place(s)
    return reports.summary(s, path, reports.stream_reports(rows, path), "b1")


def _jsonl(s, d):
    place = _place(s)
    lines = t(s, d, "events").select(F.when(F.col("event_id") % 10 == 0, "not json").when(F.col("event_id") % 10 == 1, "  ").otherwise(F.to_json(F.struct("event_id", "event_type"))).alias("value"))
    lines.write.text(place)
    good, bad = io.read_jsonl(s, place, t(s, d, "events").select("event_id", "event_type").schema)
    return good.unionByName(bad.groupBy(F.col("line").alias("event_type")).agg(F.count("*").alias("event_id")))


def _tsv(s, d):
    place = _place(s)
    docs = t(s, d, "labels")
    docs.write.csv(place, header=True, sep="\t")
    return io.read_tsv(s, place, docs.schema)


def _json_map(s, d):
    place = _place(s)
    objects = t(s, d, "nation").groupBy("n_regionkey").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("n_name", F.array("n_nationkey"))))).alias("value"))
    objects.write.partitionBy("n_regionkey").text(place)  # one object to a file
    return io.read_json_map(s, place, "array<int>").select("key", F.get("value", F.lit(0)).alias("first"))


def _json_array(s, d):
    place = _place(s)
    rows = t(s, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    arrays = rows.groupBy("c_nationkey").agg(F.to_json(F.collect_list(F.struct("c_custkey", "c_name"))).alias("value"))  # files hold what one reader takes
    arrays.write.partitionBy("c_nationkey").text(place)
    return io.read_json_array(s, place, rows.drop("c_nationkey").schema).select("c_custkey", "c_name")


def _written_csv(s, d):
    place, rows = _place(s), t(s, d, "orders").select("o_orderpriority", "o_orderkey", "o_custkey", "o_orderstatus")
    io.write_csv(rows, place, ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    return io.read_csv(s, place, rows.select("o_orderkey", "o_orderstatus", "o_orderpriority").schema)


def _written_jsonl(s, d):
    place, rows = _place(s), t(s, d, "conversations").select("conv_id", "turn", "role", "text")
    io.write_jsonl(rows, place)
    return io.read_jsonl(s, place, rows.schema)[0]


def _written_lines(s, d):
    place = _place(s)
    io.write_lines(t(s, d, "conversations"), place, "text")
    return s.read.text(place).select(F.md5("value").alias("line"))


def _inventory(s, d):
    place = _place(s)
    t(s, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("dir")).write.partitionBy("dir").parquet(place)
    return io.file_inventory(s, place, "*.parquet").groupBy("dir").agg((F.count("*") > 0).alias("found"), (F.min("length") > 0).alias("filled"))


QUERIES = {
    "jb1_run_report": (
        lambda s, d: jb.run_report(_results(s, d)),
        f"""WITH r AS (SELECT {STATUS} AS status, (o_orderkey % 100)::DOUBLE AS w FROM orders), c AS (SELECT count(*) AS total, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'retry_success') AS retry_success, count(*) FILTER (status = 'skipped_short') AS skipped_short, count(*) FILTER (status = 'failed') AS failed, sum(w) AS s FROM r)
        SELECT total, success, retry_success, skipped_short, failed, round(s, 1) AS total_seconds, success + retry_success AS total_generated, skipped_short + failed AS total_excluded, round(s / greatest(1, success + retry_success), 1) AS avg_seconds FROM c""",
    ),
    "jb2_batch_todo": (
        lambda s, d: jb.batch_todo(_files(s, d), _files(s, d).where("o_orderkey % 3 = 0"), 200),
        "SELECT lpad(o_orderkey::VARCHAR, 8, '0') || '.mp4' AS name, (row_number() OVER (ORDER BY o_orderkey) - 1) // 200 + 1 AS batch FROM orders WHERE o_orderkey % 3 <> 0",
    ),
    "jb2_progress_by_batch": (
        lambda s, d: jb.progress_by_batch(t(s, d, "orders").select((F.col("o_orderkey") % 8).alias("batch"), F.when(F.col("o_custkey") % 5 == 0, "failed").otherwise("ok").alias("status"))),
        "SELECT o_orderkey % 8 AS batch, count(*) FILTER (o_custkey % 5 <> 0) AS ok, count(*) FILTER (o_custkey % 5 = 0) AS failed FROM orders GROUP BY ROLLUP (o_orderkey % 8)",
    ),
    "jb3_upsert_jobs": (
        lambda s, d: jb.upsert_jobs(_jobs(s, d, "o_orderkey % 2 = 0"), _again(s, d), order=["updated_at"])[0].select("job_id", "video_id", "generated_video_path", "created_at"),
        """SELECT 'job' || o_orderkey AS job_id, CASE WHEN o_orderkey % 2 = 0 THEN 'o' ELSE '(' END || o_orderkey AS video_id, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 3 <> 0 THEN 'o' || o_custkey WHEN o_orderkey % 5 = 0 THEN 'late' ELSE '(' || o_custkey END AS generated_video_path,
        o_orderdate + to_days(CASE WHEN o_orderkey % 3 <> 0 OR o_orderkey % 11 = 0 THEN 0 WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END) AS created_at FROM orders WHERE o_orderkey % 2 = 0 OR (o_orderkey % 3 = 0 AND o_orderkey % 11 <> 0)""",
    ),
    "jb3_upsert_counts": (
        lambda s, d: jb.upsert_jobs(_jobs(s, d, "o_orderkey % 2 = 0"), _again(s, d), order=["updated_at"])[1],
        "SELECT count(*) FILTER (o_orderkey % 2 <> 0 AND o_orderkey % 11 <> 0) AS inserted, count(*) FILTER (o_orderkey % 2 = 0 AND o_orderkey % 11 <> 0) + count(*) FILTER (o_orderkey % 5 = 0 AND o_orderkey % 11 <> 0) AS updated, count(*) FILTER (o_orderkey % 11 = 0) + count(*) FILTER (o_orderkey % 5 = 0 AND o_orderkey % 11 = 0) AS skipped FROM orders WHERE o_orderkey % 3 = 0",
    ),
    "jb4_failures": (lambda s, d: jb.failures(_results(s, d)), "SELECT o_orderkey || '.mp4' AS filename, 'try ' || (o_orderkey % 3 + 1) AS error FROM orders WHERE o_custkey % 5 = 0"),
    "jb5_recent": (
        lambda s, d: jb.recent(_tasks(s, d), [F.desc("created_at"), F.col("task_id")], 500, F.col("status") == "completed"),
        "SELECT 'task' || o_orderkey AS task_id, o_orderpriority AS name, 'completed' AS status, o_orderdate AS created_at FROM orders WHERE o_orderstatus = 'F' ORDER BY created_at DESC, task_id LIMIT 200",
    ),
    "jb5_recent_per_name": (
        lambda s, d: jb.recent(_tasks(s, d), [F.desc("created_at"), F.col("task_id")], 3, per="name"),
        "SELECT 'task' || o_orderkey AS task_id, o_orderpriority AS name, CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'running' END AS status, o_orderdate AS created_at FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, 'task' || o_orderkey) <= 3",
    ),
    "jb6_retention": (
        lambda s, d: jb.retention(_tasks(s, d), 5),
        "SELECT 'task' || o_orderkey AS task_id FROM orders WHERE o_orderstatus = 'F' QUALIFY row_number() OVER (ORDER BY o_orderdate DESC, 'task' || o_orderkey DESC) > 5",
    ),
    "jb7_trained_tasks": (
        lambda s, d: jb.trained_tasks(_tasks(s, d), t(s, d, "lineitem").select(F.concat(F.lit("task"), "l_orderkey").alias("task_id"), F.when(F.col("l_returnflag") == "R", "model").when(F.col("l_returnflag") == "A", "prototypes").otherwise("log").alias("kind")), t(s, d, "lineitem").select(F.concat(F.lit("task"), "l_orderkey").alias("task_id"), F.col("l_partkey").alias("token"))),
        """WITH l AS (SELECT l_orderkey, bool_or(l_returnflag = 'R') AS m, bool_or(l_returnflag = 'A') AS p, count(DISTINCT l_partkey) AS v FROM lineitem GROUP BY 1)
        SELECT 'task' || o_orderkey AS task_id, o_orderpriority AS name, p AS has_prototypes, v AS vocab_size FROM orders JOIN l ON l_orderkey = o_orderkey WHERE m""",
    ),
    "jb8_attach_results": (
        lambda s, d: jb.attach_results(t(s, d, "orders").select(F.concat(F.lit("makeup_"), F.col("o_orderkey") % 70, F.lit("_x.mp4")).alias("filename"), F.when(F.col("o_custkey") % 5 == 0, "failed").otherwise("completed").alias("status")).distinct(), t(s, d, "batches"), t(s, d, "submissions").withColumn("videoFileName", F.concat(F.lit("makeup_"), "sentenceId", F.lit("_x.mp4"))), r"^makeup_([0-9]+)_"),
        """WITH r AS (SELECT DISTINCT o_orderkey % 70 AS sid FROM orders WHERE o_custkey % 5 <> 0), b AS (SELECT id AS sid, arg_max(text, seq) AS text FROM {batches} GROUP BY 1), v AS (SELECT sentenceId AS sid, arg_max(videoId, seq) AS video_id FROM {submissions} GROUP BY 1)
        SELECT sid, 'makeup_' || sid || '_x.mp4' AS filename, text, video_id FROM r LEFT JOIN b USING (sid) LEFT JOIN v USING (sid)""",
    ),
    "jb9_stage_funnel": (
        lambda s, d: jb.stage_funnel(*_stages(s, d), ["stage", "submit", "fetch"]),
        """WITH c AS (SELECT count(*) AS n, count(*) FILTER (o_custkey % 4 <> 0) AS ok FROM orders) SELECT 'stage' AS stage, n AS entered, ok, n - ok AS failed FROM c UNION ALL SELECT 'submit', ok, ok, 0 FROM c UNION ALL SELECT 'fetch', ok, 0, 0 FROM c""",
    ),
    "st1_stream_reviews": (
        lambda s, d: live.stream_reviews(_events(s, d).select(F.expr("'v' || (user_id * 20 + event_id % 20)").alias("videoId"), F.col("ts").cast("timestamp").alias("addedAt")), _place(s)).select("videoId"),
        "SELECT DISTINCT 'v' || (user_id * 20 + event_id % 20) AS videoId FROM events",
    ),
    "st2_stream_progress": (lambda s, d: live.run_once(live.stream_progress(_events(s, d).select(F.col("event_type").alias("status"))), _place(s), "complete"), 'SELECT event_type AS status, count(*) AS "count" FROM events GROUP BY 1'),
    "st2_stream_summary": (
        _summary_live,
        """WITH l AS (SELECT videoId, max_by(decision, seq) AS decision FROM {decisions} GROUP BY 1), s AS (SELECT coalesce(l.decision, 'pending') AS status FROM {submissions} s LEFT JOIN l USING (videoId) WHERE s.source = 'submission' AND starts_with(videoFileName, 'b1_'))
        SELECT count(*) AS total_submissions, count(*) FILTER (status = 'approved') AS approved, count(*) FILTER (status = 'rejected') AS rejected, count(*) FILTER (status = 'pending') AS pending FROM s""",
    ),
    "st3_stream_windows": (lambda s, d: _flat(live.stream_windows(_frames(s, d, _events(s, d)), _place(s))), f"WITH {WINDOWS}"),
    "st3_session_windows": (lambda s, d: _flat(live.session_windows(_frames(s, d, t(s, d, "events")))), f"WITH {WINDOWS}"),
    "st3_recognize": (
        lambda s, d: _recognize(s, d),
        RECOGNIZED,
    ),
    "st3_stream_recognize": (lambda s, d: _recognize_live(s, d), RECOGNIZED),
    "io1_read_jsonl": (
        lambda s, d: _jsonl(s, d),
        "SELECT event_id, event_type FROM events WHERE event_id % 10 > 1 UNION ALL SELECT count(*), 'not json' FROM events WHERE event_id % 10 = 0",
    ),
    "io2_read_json_map": (lambda s, d: _json_map(s, d), "SELECT n_name AS key, n_nationkey AS first FROM nation"),
    "io2_read_json_array": (lambda s, d: _json_array(s, d), "SELECT c_custkey, c_name FROM customer"),
    "io3_read_tsv": (lambda s, d: _tsv(s, d), "SELECT * FROM labels"),
    "io4_file_inventory": (lambda s, d: _inventory(s, d), "SELECT DISTINCT 'dir=' || o_orderstatus AS dir, true AS found, true AS filled FROM orders"),
    "io5_write_csv": (lambda s, d: _written_csv(s, d), "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders"),
    "io5_write_jsonl": (lambda s, d: _written_jsonl(s, d), "SELECT conv_id, turn, role, text FROM conversations"),
    "io5_write_lines": (lambda s, d: _written_lines(s, d), "SELECT md5(regexp_replace(text, '[\\r\\n]+', ' ', 'g')) AS line FROM conversations"),
}
