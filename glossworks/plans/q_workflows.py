"""The workloads over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import q_gloss as g
from . import q_segments as s3
from . import q_training as tr
from . import workflows as wf
from .tables import table as t


def _w1(s, d):
    texts = t(s, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    lemmas = g._lemmas(g._distinct(s, d))
    return wf.text_to_batch(texts, t(s, d, "benchmark_words").unionByName(g._phrases(s, d).withColumnRenamed("phrase", "word")), lemmas, g._lexicon(lemmas), "b1")


def _w2(s, d, *want):
    """want: what of entries, recipe and variants is made; all if nothing is named."""
    m = t(s, d, "manifest")
    sources = m.select(F.lit(1).alias("prio"), "seq", F.lit(None).cast("string").alias("pseudo_gloss"), F.col("sentence_text").alias("text"), F.col("filename").alias("path"))
    subs = t(s, d, "submissions")
    accepted = subs.select(F.col("sentenceText").alias("text"))
    glosses = t(s, d, "batches").select(F.col("text").alias("sentence"), F.array(F.concat(F.lit("w"), F.col("id") % 7), F.concat(F.lit("w"), F.col("id") % 11)).alias("glosses"))
    index = tr._index(s, d)
    return wf.reviews_to_training_set(subs, t(s, d, "decisions"), accepted, t(s, d, "batches"), glosses, sources, index, index.where("ok").select("name", "n_frames"), times=2, want=want or ("entries", "recipe", "variants"))


def _w3(s, d):
    raw = s3._raw(s, d).groupBy("l_orderkey", "stem").agg(F.transform(F.sort_array(F.collect_list(F.struct("seg", "a", "b", "label"))), lambda x: F.struct(x["a"].alias("orig_start"), x["b"].alias("orig_end"), x["label"].alias("token"))).alias("segments"))
    raw = raw.select(F.concat("stem", F.lit(".mp4")).alias("video_name"), F.lit(25.0).alias("fps"), "segments")
    none = s.createDataFrame([], "out string")
    poses = s3._poses(s, d).withColumns({"n_frames": F.lit(9), "error": F.lit(None).cast("string")})
    return wf.segments_to_labels(raw, s3._videos(s, d).where("total_frames > 0"), s3._augs(s).withColumn("enabled", F.lit(True)), none, s3._params(s, d), s3._map(s, d), poses, s3._prev(s, d))


#: clauses of the conversations, their tokens, and the gloss of each; seq orders the tokens.
W1 = f"""{g.SENTENCES}, p AS (SELECT conv_id * 1000 + turn AS id, pos, len(string_split(sentence, ' ')) AS n, sentence, list_filter(list_transform(regexp_split_to_array(sentence, '\\s*(?:[,;:]|–|—|--)\\s*'), lambda x: trim(x)), lambda x: x <> '') AS a FROM parts),
        f AS (SELECT id, pos, a, 1 AS i, []::VARCHAR[] AS done, CAST('' AS VARCHAR) AS now FROM p WHERE n > 12
        UNION ALL SELECT id, pos, a, i + 1, CASE WHEN now = '' OR len(string_split(now || ' ' || a[i], ' ')) <= 12 THEN done ELSE list_append(done, now) END,
        CASE WHEN now = '' THEN a[i] WHEN len(string_split(now || ' ' || a[i], ' ')) <= 12 THEN now || ' ' || a[i] ELSE a[i] END FROM f WHERE i <= len(a)),
        clauses AS (SELECT id, pos, 0 AS cp, sentence AS clause FROM p WHERE n <= 12
        UNION ALL SELECT id, pos, unnest(range(len(done) + 1)), unnest(list_append(done, now)) FROM f WHERE i = len(a) + 1 AND len(a) > 0),
        b AS (SELECT list_filter(list_transform(regexp_split_to_array(lower(trim(text)), '\\s+'), lambda x: {g.CLEAN.format(x='x')}), lambda x: x <> '') AS w FROM benchmark),
        ph AS (SELECT DISTINCT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS phrase FROM b),
        {g.RAW}, {g.TOKENS}, {g.FOUND.replace("v AS (SELECT word FROM {benchmark_words})", "v AS (SELECT word FROM {benchmark_words} UNION SELECT phrase FROM ph)")},
        ex AS (SELECT id, pos, cp, clause, list_filter(list_transform(regexp_split_to_array(lower(trim({g.EXPAND.format(x='clause')})), '\\s+'), lambda x: {g.CLEAN.format(x='x')}), lambda x: x <> '') AS w FROM clauses),
        g2 AS (SELECT id, pos, cp, clause, w, i, phrase IS NOT NULL AS two FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM ex) LEFT JOIN ph ON phrase = w[i] || ' ' || w[i + 1]),
        walk AS (SELECT id, pos, cp, 1::BIGINT AS i FROM ex UNION ALL SELECT g2.id, g2.pos, g2.cp, g2.i + CASE WHEN two THEN 2 ELSE 1 END FROM walk JOIN g2 ON walk.id = g2.id AND walk.pos = g2.pos AND walk.cp = g2.cp AND walk.i = g2.i),
        kept AS (SELECT * FROM (SELECT id, pos, cp, clause, i - 1 AS tp, CASE WHEN two THEN w[i] || ' ' || w[i + 1] ELSE w[i] END AS token FROM walk JOIN g2 USING (id, pos, cp, i)) WHERE token NOT IN ({g.STOPS}) AND NOT regexp_full_match(token, '[0-9]+')),
        own AS (SELECT k.*, ((k.id::HUGEINT * 10000 + k.pos) * 10000 + cp) * 10000 + tp AS seq,
        upper(replace(coalesce(v1.word, v2.word, vl.m3, CASE WHEN length(k.token) % 3 = 0 THEN lem.lemma END), 'ß', 'ss')) AS gloss
        FROM kept k LEFT JOIN lem ON lem.token = k.token LEFT JOIN v v1 ON v1.word = k.token LEFT JOIN v v2 ON v2.word = lem.lemma LEFT JOIN vl ON vl.lemma = lem.lemma)"""
#: the manifest of approved submissions, padded with the other texts.
W2 = f"""b AS (SELECT id, max_by(text, batch || '|' || seq) AS text FROM {{batches}} GROUP BY id),
        cur AS (SELECT s.videoFileName AS filename, coalesce(b.text, s.sentenceText) AS sentence_text FROM {{submissions}} s LEFT JOIN b ON s.sentenceId = b.id WHERE s.source = 'submission' AND s.videoId IN (SELECT videoId FROM {{decisions}} WHERE decision = 'approved')),
        src AS (SELECT 1 AS prio, seq, NULL::VARCHAR AS pseudo_gloss, sentence_text AS text, filename AS path FROM {{manifest}}), {tr.PADS},
        gm AS (SELECT {tr.KEY.format(c='text')} AS k, min('w' || id % 7 || ' w' || id % 11) AS g FROM {{batches}} GROUP BY 1), {tr.JOINED}, {tr.VAL}"""

QUERIES = {
    "w1_text_to_batch": (
        lambda s, d: _w1(s, d)["batch"].select("text", "type", "origin_sentence", "batch_id"),
        f"""WITH RECURSIVE {W1}, ws AS (SELECT lower(gloss) AS text, arg_min(clause, seq) AS origin_sentence FROM own WHERE gloss IS NOT NULL GROUP BY 1)
        SELECT text, 'word' AS type, origin_sentence, 'b1' AS batch_id FROM ws UNION ALL SELECT DISTINCT trim(clause), 'sentence', trim(clause), 'b1' FROM clauses WHERE trim(clause) <> '' AND trim(clause) NOT IN (SELECT text FROM ws)""",
    ),
    "w1_vocabulary": (lambda s, d: _w1(s, d)["vocabulary"], f"WITH RECURSIVE {W1} SELECT gloss, count(*) AS freq FROM own WHERE gloss IS NOT NULL GROUP BY 1"),
    "w2_variants": (lambda s, d: _w2(s, d, "variants")["variants"], None),
    "w2_entries": (
        lambda s, d: _w2(s, d, "entries")["entries"],
        f"WITH {W2} SELECT * EXCLUDE (val), CASE WHEN val THEN 'val' ELSE 'train' END AS split FROM r UNION ALL SELECT * EXCLUDE (val), 'test' FROM r WHERE NOT is_pad",
    ),
    "w3_labels": (lambda s, d: _w3(s, d)["labels"], f"WITH {s3.SINGLE} SELECT stem AS ref, regexp_replace(gloss, '[.,!?;:]+$', '') AS gloss FROM single WHERE gloss IS NOT NULL AND regexp_replace(gloss, '[.,!?;:]+$', '') <> ''"),
    "w3_vocabulary": (lambda s, d: _w3(s, d)["vocabulary"], f"WITH {s3.SINGLE}, {s3.VOC}, l AS (SELECT DISTINCT regexp_replace(gloss, '[.,!?;:]+$', '') AS token FROM single WHERE gloss IS NOT NULL) SELECT * FROM old UNION ALL SELECT token, (SELECT max(id) FROM old) + row_number() OVER (ORDER BY token) FROM l WHERE token <> '' AND token NOT IN (SELECT token FROM old)"),
}
