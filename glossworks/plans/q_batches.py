"""Batch and dictionary queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossworks.functions.common import new_rows_only
from glossworks.operators import batches as bt

from .tables import table as t

#: conversations as glosses of sentences; turn orders within a conversation, so that seq is unique
GLOSSES = "SELECT conv_id * 1000 + turn AS seq, text AS sentence, upper(role) || '_' || CAST((conv_id + turn) % 40 AS STRING) AS gloss FROM {conversations}"


def _glosses(s, d):
    return s.sql(GLOSSES, conversations=t(s, d, "conversations"))


def _pub(s, d):
    man = t(s, d, "manifest").withColumn("video_id", F.concat(F.lit("v"), "seq"))
    res = man.select("filename", F.when(F.col("seq") % 4 == 0, "failed").otherwise("completed").alias("status"))
    return bt.publish_rows(res, man.where("seq % 5 <> 0"), "b9", "20240101", man.where("seq % 7 = 0").select(F.concat(F.lit("gen_v"), "seq", F.lit("_20240101")).alias("videoId")))


def _ingest(s, d):
    files = t(s, d, "manifest").select("filename").withColumnRenamed("filename", "name")
    texts = t(s, d, "documents").where("doc_id % 5 <> 0").select(F.col("doc_id").alias("id"), "text")
    known = t(s, d, "documents").where("doc_id % 7 = 0").select(F.concat(F.lit("x_"), "doc_id").alias("videoId"))
    return bt.ingest_named_files(files, texts, known, r"^sentence_([0-9]+)\.mp4$", "x")


QUERIES = {
    "bt1_gloss_sources": (
        lambda s, d: bt.gloss_sources(_glosses(s, d)).select("gloss", F.size("sentences").alias("n"), F.element_at("sentences", 1).alias("first"), F.md5(F.array_join("sentences", "|")).alias("all_md5")),
        f"WITH g AS ({GLOSSES}), f AS (SELECT lower(gloss) AS gloss, sentence, min(seq) AS seq FROM g GROUP BY 1, 2) SELECT gloss, count(*)::INT AS n, arg_min(sentence, seq) AS first, md5(string_agg(sentence, '|' ORDER BY seq)) AS all_md5 FROM f GROUP BY gloss",
    ),
    "bt2_build_batch": (
        lambda s, d: bt.build_batch(_glosses(s, d), _glosses(s, d).select(F.when(F.col("seq") % 10 == 0, F.lower("gloss")).otherwise(F.col("sentence")).alias("text"), "seq"), "b1"),
        f"""WITH g AS ({GLOSSES}), w AS (SELECT lower(gloss) AS text, 'word' AS type, arg_min(sentence, seq) AS origin_sentence, min(seq) AS ord FROM g GROUP BY 1),
        s AS (SELECT trim(CASE WHEN seq % 10 = 0 THEN lower(gloss) ELSE sentence END) AS text, min(seq) AS ord FROM g GROUP BY 1)
        SELECT text, type, origin_sentence, ord, 'b1' AS batch_id FROM w UNION ALL SELECT text, 'sentence', text, ord, 'b1' FROM s WHERE text <> '' AND text NOT IN (SELECT text FROM w)""",
    ),
    "bt3_release_dict": (
        lambda s, d: bt.build_release_dict(
            t(s, d, "manifest").select("filename", F.col("sentence_text").alias("sentenceText"), F.col("language").alias("word"), F.concat("source", F.lit(".jsonl")).alias("batchFile"), F.lit(None).cast("string").alias("description"), F.struct(F.col("sentence_text").alias("src_sentence")).alias("_origin"))
        ),
        """SELECT filename AS video_file, CASE WHEN k = 'sentence' THEN sentence_text ELSE language END AS text, source AS batch_id, k AS type, '' AS description, sentence_text AS origin_sentence
        FROM (SELECT *, CASE WHEN contains(x, ' ') OR regexp_matches(x, '[.!?]$') THEN 'sentence' ELSE 'word' END AS k FROM (SELECT *, trim(sentence_text, ' ' || chr(9) || chr(10) || chr(13)) AS x FROM {manifest}))""",
    ),
    "bt4_fill_descriptions": (
        lambda s, d: bt.fill_descriptions(
            t(s, d, "documents").select("doc_id", F.concat(F.lit("T"), "doc_id").alias("text")),
            t(s, d, "documents").where("doc_id % 2 = 0").select(F.concat(F.lit("t"), "doc_id").alias("text"), F.when(F.col("doc_id") % 4 == 0, " ").otherwise(F.col("lang")).alias("description")),
            t(s, d, "documents").where("doc_id % 3 = 0").select(F.concat(F.lit("t"), "doc_id").alias("text"), F.col("source").alias("description")),
        ),
        "SELECT doc_id, 'T' || doc_id AS text, CASE WHEN doc_id % 2 = 0 AND doc_id % 4 <> 0 THEN lang WHEN doc_id % 3 = 0 THEN source ELSE '' END AS description FROM documents",
    ),
    "bt5_assign_reviewers": (
        lambda s, d: bt.assign_reviewers(t(s, d, "submissions"), t(s, d, "nation").select(F.col("n_name").alias("reviewerId")), t(s, d, "submissions").where("seq % 2 = 0").select("videoId", F.lit("NATION_1").alias("reviewerId"))),
        "SELECT videoId, n_name AS reviewerId FROM (SELECT DISTINCT videoId FROM {submissions}), nation EXCEPT SELECT videoId, 'NATION_1' FROM {submissions} WHERE seq % 2 = 0",
    ),
    "bt5_new_rows_only": (
        lambda s, d: new_rows_only(t(s, d, "submissions").select("videoId"), t(s, d, "decisions"), ["videoId"]),
        "SELECT DISTINCT videoId FROM {submissions} WHERE videoId NOT IN (SELECT videoId FROM {decisions})",
    ),
    "bt6_ingest_counts": (
        lambda s, d: _ingest(s, d)[1],
        """SELECT count(*) AS found, count(*) FILTER (seq % 3 <> 0) AS unmatched, count(*) FILTER (seq % 3 = 0 AND seq % 5 = 0) AS missing_text, count(*) FILTER (seq % 3 = 0 AND seq % 5 <> 0 AND seq % 7 = 0) AS existing,
        count(*) FILTER (seq % 3 = 0 AND seq % 5 <> 0 AND seq % 7 <> 0) AS appended FROM {manifest}""",
    ),
    "bt6_ingest_rows": (
        lambda s, d: _ingest(s, d)[0],
        "SELECT 'x_' || doc_id AS videoId, doc_id AS sentenceId, 'sentence_' || doc_id || '.mp4' AS name, text FROM documents WHERE doc_id % 3 = 0 AND doc_id % 5 <> 0 AND doc_id % 7 <> 0",
    ),
    "bt7_attach_dictionary": (
        lambda s, d: bt.attach_dictionary(
            t(s, d, "documents").select(F.concat("lang", "doc_id", F.when(F.col("doc_id") % 2 == 0, "_hiya.mp4").otherwise("_hiya")).alias("name")),
            t(s, d, "documents").where("doc_id % 3 <> 1").select(F.concat("lang", "doc_id", F.lit("_hiya_complete.mp4")).alias("ref"), F.col("source").alias("word"), F.concat(F.lit(" g"), "doc_id").alias("gloss")),
        ),
        """SELECT key, key || CASE WHEN doc_id % 2 = 0 THEN '_hiya.mp4' ELSE '_hiya' END AS name, CASE WHEN doc_id % 3 <> 1 THEN source ELSE key END AS word, CASE WHEN doc_id % 3 <> 1 THEN 'g' || doc_id ELSE '' END AS gloss,
        ('0x' || substr(md5(key), 1, 8))::BIGINT % 27000 + 100000 AS sentenceId FROM (SELECT *, lang || doc_id AS key FROM documents)""",
    ),
    "bt8_batch_texts": (
        lambda s, d: bt.batch_texts(t(s, d, "manifest").withColumn("sentence_id", F.col("seq") % 90)),
        "SELECT seq % 90 AS id, arg_min(sentence_text, seq) AS text, arg_min(language, seq) AS language FROM {manifest} GROUP BY 1",
    ),
    "bt9_publish_rows": (
        lambda s, d: _pub(s, d).select("videoId", "sentenceText", "language", "batchFile", F.col("_origin.src_filename").alias("src_filename"), "videoFileName"),
        """SELECT 'gen_v' || seq || '_20240101' AS videoId, sentence_text AS sentenceText, language, 'b9.jsonl' AS batchFile, filename AS src_filename, substr(md5('gen_v' || seq || '_20240101'), 1, 10) || '.mp4' AS videoFileName
        FROM {manifest} WHERE seq % 4 <> 0 AND seq % 5 <> 0 AND seq % 7 <> 0""",
    ),
}
