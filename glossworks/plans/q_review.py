"""Review and collection queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from glossworks.functions.common import shared_dir
from glossworks.operators import review as rv
from glossworks.streaming import reports

from .tables import table as t

LATEST = "latest AS (SELECT videoId, max_by(decision, seq) AS decision FROM {decisions} GROUP BY videoId)"
STATUS = "status AS (SELECT s.*, CASE WHEN l.decision IN ('approved', 'rejected') THEN l.decision ELSE 'pending' END AS status FROM {submissions} s LEFT JOIN latest l USING (videoId) WHERE s.source = 'submission')"


def _sub(s, d):
    return t(s, d, "submissions"), t(s, d, "decisions")


def _words(s, d):
    return t(s, d, "sentence_glosses").select(F.lower("gloss").alias("text"))


PROGRESS = f"""WITH {LATEST}, {STATUS}, n AS (SELECT sentenceId, count(*) AS recorded, count(*) FILTER (status = 'approved') AS approved, count(*) FILTER (status = 'rejected') AS rejected, count(*) FILTER (status = 'pending') AS pending FROM status GROUP BY 1)
        SELECT id, text, coalesce(recorded, 0) AS recorded, coalesce(approved, 0) AS approved, coalesce(rejected, 0) AS rejected, coalesce(pending, 0) AS pending FROM {{batches}} b LEFT JOIN n ON b.id = n.sentenceId WHERE batch = 'b1'"""


def _progress_by_increments(s, d, steps=3):
    """The logs in steps whose rows come out of order."""
    path, (subs, decs) = f"{shared_dir(s)}/reports-{uuid.uuid4().hex}", _sub(s, d)
    for n in range(steps):
        now = F.col("seq") % steps == steps - 1 - n
        reports.advance(s, path, n, subs.where(now), decs.where(now))
    return reports.sentence_progress(s, path, steps - 1, t(s, d, "batches").where("batch = 'b1'"))


QUERIES = {
    "rv1_review_status": (
        lambda s, d: rv.review_status(*_sub(s, d)).select("videoId", "sentenceId", "videoFileName", "status", "seq"),
        f"WITH {LATEST}, {STATUS} SELECT videoId, sentenceId, videoFileName, status, seq FROM status",
    ),
    "rv1_review_summary": (
        lambda s, d: rv.review_summary(rv.review_status(*_sub(s, d), batch="b1")),
        f"WITH {LATEST}, {STATUS} SELECT count(*) AS total_submissions, count(*) FILTER (status = 'approved') AS approved, count(*) FILTER (status = 'rejected') AS rejected, count(*) FILTER (status = 'pending') AS pending FROM status WHERE starts_with(videoFileName, 'b1_')",
    ),
    "rv2_sentence_progress": (
        lambda s, d: rv.sentence_progress(t(s, d, "batches").where("batch = 'b1'"), *_sub(s, d)),
        PROGRESS,
    ),
    "rv2_incremental_progress": (_progress_by_increments, PROGRESS),
    "rv3_batch_progress": (
        lambda s, d: rv.batch_progress(t(s, d, "batches"), *_sub(s, d)),
        """WITH own AS (SELECT * FROM {submissions} WHERE source = 'submission' AND sentenceId IN (SELECT id FROM {batches})),
        r AS (SELECT count(DISTINCT sentenceId) AS recorded_sentences, count(*) AS recorded FROM own),
        j AS (SELECT count(*) FILTER (decision = 'approved') AS approved, count(*) FILTER (decision = 'rejected') AS rejected FROM {decisions} WHERE videoId IN (SELECT videoId FROM own)),
        b AS (SELECT count(DISTINCT id) AS sentences FROM {batches})
        SELECT *, greatest(0, sentences - recorded_sentences) AS pending_recording, recorded - approved - rejected AS pending_review FROM b, r, j""",
    ),
    "rv4_generated_review": (
        lambda s, d: rv.generated_review(t(s, d, "generated"), t(s, d, "gen_decisions"), "gen_1"),
        """WITH l AS (SELECT videoId, max_by(decision, seq) AS decision FROM {gen_decisions} GROUP BY 1)
        SELECT DISTINCT g.videoId, substr(g.videoId, 6) AS word, coalesce(l.decision, 'pending') AS status FROM {generated} g LEFT JOIN l USING (videoId) WHERE starts_with(g.videoId, 'gen_1')""",
    ),
    "rv5_approved_ids": (lambda s, d: rv.approved_ids(t(s, d, "decisions")), "SELECT DISTINCT videoId FROM {decisions} WHERE decision = 'approved'"),
    "rv5_approved_files": (
        lambda s, d: rv.approved_files(t(s, d, "decisions"), "infoFileName"),
        "SELECT DISTINCT coalesce(infoFileName, videoFileName) AS name FROM {decisions} WHERE decision = 'approved'",
    ),
    "rv6_collect": (
        lambda s, d: rv.collect(*_sub(s, d), t(s, d, "submissions").where("sentenceId % 4 <> 1").select(F.col("sentenceText").alias("text")), t(s, d, "batches")),
        """WITH b AS (SELECT id, max_by(text, batch || '|' || seq) AS text, max_by(type, batch || '|' || seq) AS type FROM {batches} GROUP BY id)
        SELECT s.videoId AS video_id, s.videoFileName AS filename, s.sentenceId AS sentence_id, coalesce(b.text, s.sentenceText) AS sentence_text, s.language, b.type
        FROM {submissions} s LEFT JOIN b ON s.sentenceId = b.id WHERE s.source = 'submission' AND s.sentenceId % 4 <> 1 AND s.videoId IN (SELECT videoId FROM {decisions} WHERE decision = 'approved')""",
    ),
    "rv7_annotate": (
        lambda s, d: rv.annotate(
            t(s, d, "manifest").select("filename", "sentence_text"),
            t(s, d, "manifest").where("sentence_id % 2 = 0").groupBy(F.col("sentence_text").alias("sentence")).agg(F.sort_array(F.collect_set(F.upper("language"))).alias("glosses")),
        ).select("filename", "sentence_text", F.array_join("glosses", " ").alias("glosses")),
        """WITH g AS (SELECT sentence_text, string_agg(DISTINCT upper(language), ' ' ORDER BY upper(language)) AS glosses FROM {manifest} WHERE sentence_id % 2 = 0 GROUP BY 1)
        SELECT filename, m.sentence_text, coalesce(glosses, upper(m.sentence_text)) AS glosses FROM {manifest} m LEFT JOIN g USING (sentence_text)""",
    ),
    "rv8_filter_to_inventory": (
        lambda s, d: rv.filter_to_inventory(t(s, d, "documents").select("doc_id", "lang", "source"), t(s, d, "labels"), "doc_id")[0],
        "SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    ),
    "rv8_kept_and_dropped": (
        lambda s, d: rv.filter_to_inventory(t(s, d, "documents").select("doc_id"), t(s, d, "labels"), "doc_id")[1],
        "SELECT count(*) FILTER (doc_id IN (SELECT doc_id FROM labels)) AS kept, count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM labels)) AS dropped FROM documents",
    ),
    "rv9_prepare_dataset": (
        lambda s, d: rv.prepare_dataset(
            t(s, d, "documents").select("source", F.col("doc_id").cast("string").alias("vid")),
            t(s, d, "documents").join(t(s, d, "approved_docs"), "doc_id", "left_semi").select("source", F.col("doc_id").cast("string").alias("vid"), F.concat("lang", F.lit("/"), "doc_id").alias("path")),
        ),
        """SELECT d.source, CAST(d.doc_id AS VARCHAR) AS vid, CASE WHEN a.doc_id IS NOT NULL THEN d.lang || '/' || d.doc_id END AS path, a.doc_id IS NOT NULL AS found, CASE WHEN a.doc_id IS NOT NULL THEN d.doc_id || '.mp4' END AS filename
        FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM {approved_docs}) a USING (doc_id)""",
    ),
    "rv10_latest_per_gloss": (
        lambda s, d: rv.latest_per_gloss(t(s, d, "clips")),
        """SELECT gloss, max_by(name, ts || name) AS path FROM (SELECT name, upper(regexp_extract(name, '^word_(.+)_([0-9]{{14}})\\.mp4$', 1)) AS gloss, regexp_extract(name, '^word_(.+)_([0-9]{{14}})\\.mp4$', 2) AS ts FROM {clips}) WHERE gloss <> '' GROUP BY gloss""".replace("{{", "{").replace("}}", "}"),
    ),
    "rv11_first_per_key": (
        lambda s, d: rv.first_per_key(t(s, d, "submissions"), F.substring("translatorId", 2, 1), F.col("source") == "submission"),
        "SELECT substr(translatorId, 2, 1) AS key, arg_min(videoFileName, seq) AS path FROM {submissions} WHERE source = 'submission' GROUP BY 1",
    ),
    "rv12_clip_index": (
        lambda s, d: rv.clip_index(
            (t(s, d, "submissions").select(F.col("sentenceText").alias("gloss"), F.col("videoFileName").alias("path"), "seq"), 1, "submissions"),
            (t(s, d, "batches").where("id % 2 = 0").select(F.concat(F.lit("Text "), "id").alias("gloss"), F.concat(F.lit("p3/"), "batch").alias("path"), F.col("seq")), 2, "phase3"),
        ),
        """WITH u AS (SELECT lower(sentenceText) AS gloss, videoFileName AS path, 1 AS prio, seq, 'submissions' AS origin FROM {submissions}
        UNION ALL SELECT 'text ' || id, 'p3/' || batch, 2, seq, 'phase3' FROM {batches} WHERE id % 2 = 0)
        SELECT gloss, path, origin FROM u QUALIFY row_number() OVER (PARTITION BY gloss ORDER BY prio DESC, seq DESC) = 1""",
    ),
    "rv13_play_plan": (
        lambda s, d: rv.play_plan(
            t(s, d, "documents").select(F.col("doc_id").alias("job"), F.posexplode(F.split("text", " ")).alias("pos", "gloss")),
            t(s, d, "benchmark_words").select(F.col("word").alias("gloss"), F.concat("word", F.lit(".mp4")).alias("path")),
            t(s, d, "benchmark_words").select(F.substring("word", 1, 1).alias("letter")).distinct().select("letter", F.concat(F.lit("letters/"), "letter").alias("path")),
        ),
        """WITH g AS (SELECT doc_id AS job, unnest(range(len(string_split(text, ' '))))::INT AS pos, lower(trim(unnest(string_split(text, ' ')))) AS key FROM documents), i AS (SELECT word AS key, word || '.mp4' AS clip FROM {benchmark_words}),
        l AS (SELECT DISTINCT substr(word, 1, 1) AS unit FROM {benchmark_words}), j AS (SELECT * FROM g LEFT JOIN i USING (key)),
        p AS (SELECT job, pos, key, unnest(range(length(key))) AS char_pos FROM j WHERE clip IS NULL)
        SELECT job, pos, 0 AS char_pos, key AS unit, clip AS path FROM j WHERE clip IS NOT NULL
        UNION ALL SELECT job, pos, char_pos, unit, 'letters/' || unit FROM (SELECT job, pos, char_pos, substr(key, char_pos + 1, 1) AS unit FROM p) JOIN l USING (unit)""",
    ),
    "rv14_attach_by_stem": (
        lambda s, d: rv.attach_by_stem(
            t(s, d, "manifest").select(F.concat(F.lit("aug-"), F.regexp_replace("filename", r"\.mp4$", "_seg001_x.mp4")).alias("name")),
            t(s, d, "manifest").where("seq % 2 = 0").select("filename", "sentence_text"),
        ),
        """WITH f AS (SELECT DISTINCT 'aug-' || replace(filename, '.mp4', '_seg001_x.mp4') AS name FROM {manifest}), a AS (SELECT replace(filename, '.mp4', '') AS stem, min(sentence_text) AS sentence_text FROM {manifest} WHERE seq % 2 = 0 GROUP BY 1),
        m AS (SELECT name, max_by(stem, length(stem)) AS stem FROM f JOIN a ON contains(name, stem) GROUP BY 1) SELECT name, stem, sentence_text FROM f LEFT JOIN m USING (name) LEFT JOIN a USING (stem)""",
    ),
    "rv15_gloss_video_db": (
        lambda s, d: rv.gloss_video_db(t(s, d, "submissions").select(F.col("sentenceText").alias("gloss"), F.col("videoFileName").alias("path"), (F.col("seq") % 10).alias("duration"))).withColumn("clips", F.md5(F.array_join("clips", ","))),
        "SELECT sentenceText AS gloss, md5(string_agg(videoFileName, ',' ORDER BY videoFileName)) AS clips, count(*) AS n, sum(seq % 10)::BIGINT AS duration FROM {submissions} GROUP BY 1",
    ),
    "rv16_with_exists": (
        lambda s, d: rv.with_exists(t(s, d, "submissions"), t(s, d, "files")).select("videoId", "seq", "videoFileName", "file_exists"),
        "SELECT videoId, seq, videoFileName, videoFileName IN (SELECT name FROM {files}) AS file_exists FROM {submissions}",
    ),
    "rv17_batch_sizes": (lambda s, d: rv.batch_sizes(t(s, d, "batches")), "SELECT batch, count(*) AS sentence_count FROM {batches} GROUP BY batch"),
}
