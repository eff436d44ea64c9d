"""Segment, augmentation and vocabulary queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossworks.operators import augment as au
from glossworks.operators import segments as sg
from glossworks.operators import vocab as vo

from .tables import table as t

TEMPORAL = [("speed_050x", 0.5), ("speed_075x", 0.75), ("speed_125x", 1.25), ("speed_150x", 1.5), ("speed_200x", 2.0), ("subsample_step2", 2.0), ("subsample_step3", 3.0)]
AUGS = "augs AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}', {r}::DOUBLE)" for n, r in TEMPORAL) + ") v(aug_name, ratio))"
#: lines of an order as segments of a video; the running sum of tenths of quantities bounds them
RAW = """SELECT l_orderkey, CASE WHEN l_orderkey % 9 = 0 THEN 'word_w' || CAST(l_orderkey AS STRING) ELSE 'sentence_' || CAST(l_orderkey AS STRING) END AS stem, seg, a, a + q AS b, label FROM (
    SELECT l_orderkey, q, label, (row_number() OVER w) - 1 AS seg, CAST((sum(q) OVER w) AS BIGINT) - q AS a FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, CAST(l_quantity AS BIGINT) AS q, CASE WHEN l_linenumber % 3 = 0 THEN 'go.' WHEN l_linenumber % 3 = 1 THEN 'a/b!' ELSE '...' END AS label FROM {lineitem}) x
    WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, q ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) y"""
SEGS = f"raw AS ({RAW}), segs AS (SELECT stem, seg, CAST(a AS DOUBLE) / 25 AS \"start\", CAST(b AS DOUBLE) / 25 AS \"end\", label FROM raw WHERE NOT starts_with(stem, 'word_'))"
NAME = "regexp_replace(stem || '_seg' || lpad(seg::VARCHAR, 3, '0') || '_' || label, '[^\\p{L}\\p{N}._-]', '_', 'g')"
LABELS = f"labs AS (SELECT {NAME} AS seg_stem, regexp_replace(upper(label), '[.,!?;:]+$', '') AS gloss FROM segs WHERE label <> '...')"


def _raw(s, d):
    return s.sql(RAW, lineitem=t(s, d, "lineitem"))


def _segs(s, d):
    rows = _raw(s, d).groupBy("l_orderkey", "stem").agg(F.transform(F.sort_array(F.collect_list(F.struct("seg", "a", "b", "label"))), lambda x: F.struct(x["a"].alias("orig_start"), x["b"].alias("orig_end"), x["label"].alias("token"))).alias("segments"))
    return sg.to_split_points(rows.select(F.concat("stem", F.lit(".mp4")).alias("video_name"), F.lit(25.0).alias("fps"), "segments"))


def _videos(s, d):
    return t(s, d, "orders").select(F.concat(F.lit("sentence_"), "o_orderkey").alias("stem"), F.lit(25.0).alias("fps"), (F.col("o_orderkey") % 40 * 4).alias("total_frames"))


def _augs(s):
    return s.createDataFrame(TEMPORAL, "aug_name string, ratio double")


def _all(s, d):
    return t(s, d, "orders").select(F.concat(F.lit("sentence_"), "o_orderkey").alias("stem"))


def _derived(s, d):
    temporal = _all(s, d).crossJoin(F.broadcast(_augs(s))).select(F.concat("aug_name", F.lit("_"), "stem", F.lit(".mp4")).alias("name"), F.lit("temporal").alias("aug_type"), "aug_name", "stem")
    views = _all(s, d).select(F.concat("stem", F.lit("_yaw_left.mp4")).alias("name"), F.lit("view").alias("aug_type"), F.lit("yaw_left").alias("aug_name"), "stem")
    return temporal.unionByName(views)


def _params(s, d):
    return _all(s, d).crossJoin(F.broadcast(_augs(s))).select("aug_name", "stem", F.col("ratio").alias("speed_ratio"))


#: pose files by the names of their training clips: segments, words, augmented words and sentences, and files of no original

def _names(rows, prefix, level, path):
    named = sg.training_names(rows.select(path.alias("rel_path"), F.lit(prefix).alias("prefix"), F.lit(level).alias("level")))
    return named.select(F.regexp_replace("out", r"\.mp4$", "").alias("stem"))


def _word(key="o_orderkey"):
    """Stems with underscores, of which some begin as others do."""
    return F.concat(F.lit("word_"), F.when(F.col(key) % 4 == 0, "ice").otherwise("ice_crème"), F.lit("_"), (F.col(key) % 700).cast("string"))


def _poses(s, d):
    o = t(s, d, "orders")
    clip = _names(sg.segment_labels(_segs(s, d)), "seg_", "sentence", F.concat("seg_stem", F.lit(".mp4")))
    words = _names(o.where("o_orderkey % 9 = 0").withColumn("w", _word()), "orig_", "word", F.concat("w", F.lit(".mp4")))
    moved = _names(o.where("o_orderkey % 9 = 1").withColumn("w", _word()), "aug_word_", "word", F.concat(F.lit("blur/cv-"), "w", F.lit("-2.mp4")))
    whole = _names(o, "aug_", "sentence", F.concat(F.lit("speed/"), F.lit("sentence_"), "o_orderkey", F.lit(".mp4")))
    other = t(s, d, "nation").select(F.concat(F.lit("x_"), "n_name").alias("stem"))
    return clip.unionByName(words).unionByName(moved).unionByName(whole).unionByName(other).distinct()


def _map(s, d):
    o = t(s, d, "orders")
    w = o.where("o_orderkey % 18 < 2").select(_word().alias("stem"), F.array(F.concat(F.lit("w"), F.col("o_orderkey") % 700, F.lit("."))).alias("glosses")).distinct()
    x = o.where("o_orderkey % 9 <> 0").select(F.concat(F.lit("sentence_"), "o_orderkey").alias("stem"), F.array(F.lit("A"), F.lit("B")).alias("glosses"))
    n = t(s, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_name").alias("stem"), F.array(F.lit("N!")).alias("glosses"))
    return w.unionByName(x).unionByName(n)


def _single(s, d):
    return sg.single_gloss(_poses(s, d), _map(s, d), sg.segment_labels(_segs(s, d)))


#: every stem against every name; segments only against names of their own video
WORD = "'word_' || CASE WHEN o_orderkey % 4 = 0 THEN 'ice' ELSE 'ice_crème' END || '_' || o_orderkey % 700"
SINGLE = f"""{SEGS}, {LABELS}, names AS (SELECT DISTINCT name, regexp_extract(name, 'sentence_[0-9]+') AS video FROM (SELECT 'seg_' || seg_stem || '_sentence' AS name FROM labs
        UNION ALL SELECT 'orig_' || {WORD} || '_word' FROM orders WHERE o_orderkey % 9 = 0 UNION ALL SELECT 'aug_word_blur_cv-' || {WORD} || '-2_word' FROM orders WHERE o_orderkey % 9 = 1
        UNION ALL SELECT 'aug_speed_sentence_' || o_orderkey || '_sentence' FROM orders UNION ALL SELECT 'x_' || n_name FROM nation)),
        gmap AS (SELECT DISTINCT {WORD} AS stem, 'w' || o_orderkey % 700 || '.' AS one FROM orders WHERE o_orderkey % 18 < 2 UNION ALL SELECT 'sentence_' || o_orderkey, NULL FROM orders WHERE o_orderkey % 9 <> 0 UNION ALL SELECT n_name, 'N!' FROM nation WHERE n_nationkey % 2 = 0),
        seg AS (SELECT name, arg_max(gloss, length(seg_stem)) AS label FROM names JOIN labs ON video = regexp_extract(seg_stem, 'sentence_[0-9]+') AND contains(name, seg_stem) WHERE video <> '' GROUP BY name),
        word AS (SELECT name, arg_max(one, length(stem)) AS g FROM names JOIN gmap ON starts_with(stem, 'word_') AND contains(name, stem) GROUP BY name),
        sentence AS (SELECT DISTINCT name FROM names JOIN gmap ON starts_with(stem, 'sentence_') AND contains(name, stem)),
        lone AS (SELECT name, arg_max(one, length(stem)) AS g FROM names JOIN gmap ON one IS NOT NULL AND contains(name, stem) GROUP BY name),
        single AS (SELECT name AS stem, CASE WHEN seg.label IS NOT NULL THEN seg.label WHEN word.g IS NOT NULL THEN upper(word.g) WHEN sentence.name IS NOT NULL THEN NULL ELSE lone.g END AS gloss,
        CASE WHEN seg.label IS NOT NULL THEN 'segment' WHEN word.g IS NOT NULL THEN 'word' WHEN sentence.name IS NOT NULL THEN 'sentence' WHEN lone.g IS NOT NULL THEN 'single' ELSE 'unmatched' END AS how
        FROM names LEFT JOIN seg USING (name) LEFT JOIN word USING (name) LEFT JOIN sentence USING (name) LEFT JOIN lone USING (name))"""


def _config(s):
    return s.sql("""SELECT array(named_struct('name', 'front', 'yaw', 0.0D, 'pitch', 0.0D, 'zoom', 1.0D), named_struct('name', 'yaw_left', 'yaw', -15.0D, 'pitch', 0.0D, 'zoom', 1.0D)) AS viewpoints,
    array(named_struct('template_dir', 'a very long template name.jpeg', 'enabled', true, 'viewpoints', array(named_struct('name', 'original', 'yaw', 0.0D, 'pitch', 0.0D, 'zoom', 1.0D), named_struct('name', 'up', 'yaw', 0.0D, 'pitch', 10.0D, 'zoom', 1.0D))),
    named_struct('template_dir', 'off', 'enabled', false, 'viewpoints', array(named_struct('name', 'original', 'yaw', 0.0D, 'pitch', 0.0D, 'zoom', 1.0D)))) AS templates""")


def _plan(s, d):
    return au.plan_augment(_all(s, d), _augs(s).withColumn("enabled", F.col("ratio") != 3.0), _all(s, d).where("stem LIKE '%1'").select(F.concat(F.lit("speed_050x/"), "stem", F.lit(".mp4")).alias("out")))


def _views(s, d):
    return t(s, d, "orders").select(F.concat(F.when(F.col("o_orderkey") % 3 == 0, "sentence_").otherwise("word_"), "o_orderkey").alias("name"), F.when(F.col("o_orderkey") % 40 == 0, "yaw_l_zoom_in").otherwise("yaw_l").alias("viewpoint"))


def _results(s, d):
    return t(s, d, "orders").select(F.col("o_orderpriority").alias("category"), F.expr("element_at(array('2d_cv', 'temporal', '3d_views', 'identity', '3d_cv_combined'), cast(o_custkey % 5 as int) + 1)").alias("aug_type")).where("category <> '5-LOW'")


def _prior(s, d):
    return t(s, d, "orders").select(F.col("o_orderpriority").alias("category")).distinct().withColumns({k: F.lit(v).cast("long") for k, v in zip((*au.TYPES, "3d_cv_combined"), (1, 2, 3, 4, 5), strict=True)})


SUMMARY = """now AS (SELECT o_orderpriority AS category, count(*) FILTER (o_custkey % 5 = 0) AS "2d_cv", count(*) FILTER (o_custkey % 5 = 1) AS "temporal", count(*) FILTER (o_custkey % 5 = 2) AS "3d_views", count(*) FILTER (o_custkey % 5 = 3) AS "identity", count(*) FILTER (o_custkey % 5 = 4) AS "3d_cv_combined"
        FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1), summary AS (SELECT * FROM now UNION ALL SELECT '5-LOW', 1, 2, 3, 4, 5)"""


def _tokens(s, d, lang):
    docs = t(s, d, "documents").where(F.col("lang") == lang)
    return docs.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("token")).where("token <> ''").distinct()


def _prev(s, d):
    words = _tokens(s, d, "en").where("length(token) < 4").select("token", (F.conv(F.substring(F.md5("token"), 1, 6), 16, 10).cast("int") + 1).alias("id"))
    return words.unionByName(s.createDataFrame([("<pad>", 0)], "token string, id int"))


VOC = """en AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS token FROM documents WHERE lang = 'en'), fr AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS token FROM documents WHERE lang = 'fr'),
        old AS (SELECT token, ('0x' || substr(md5(token), 1, 6))::BIGINT + 1 AS id FROM en WHERE length(token) BETWEEN 1 AND 3 UNION ALL SELECT '<blank>', 0),
        fresh AS (SELECT token FROM fr WHERE token <> '' EXCEPT SELECT token FROM old)"""


def _index(s, d):
    return t(s, d, "documents").select(F.col("doc_id").cast("string").alias("stem"), (F.col("doc_id") % 12).cast("int").alias("n_frames"), F.when(F.col("doc_id") % 10 == 0, "bad").alias("error"))


def _lines(s, d, rest):
    return t(s, d, "orders").where(f"o_orderkey % 2 = {rest}").select(F.when(F.col("o_orderkey") % 5 == 0, "  ").otherwise(F.concat(F.lit(" "), "o_orderstatus")).alias("line"))


QUERIES = {
    "sg1_split_points": (lambda s, d: _segs(s, d).select("stem", F.col("seg").cast("long").alias("seg"), "start", "end", "label"), f"WITH {SEGS} SELECT * FROM segs"),
    "sg2_clips": (
        lambda s, d: sg.clips(_segs(s, d), _videos(s, d)),
        f"""WITH {SEGS}, c AS (SELECT stem, seg::INT AS seg, label, trunc("start" * 25)::INT AS start_frame, least(trunc("end" * 25)::INT, (split_part(stem, '_', 2)::BIGINT % 40 * 4)::INT) AS end_frame FROM segs) SELECT *, {NAME} || '.mp4' AS clip FROM c WHERE end_frame > start_frame""",
    ),
    "sg3_scale_segments": (
        lambda s, d: sg.scale_segments(_segs(s, d), _derived(s, d), _params(s, d)).select("name", "aug_type", "stem", F.col("seg").cast("long").alias("seg"), F.round("start", 6).alias("start"), F.round("end", 6).alias("end"), "label"),
        f"""WITH {SEGS}, {AUGS}, few AS (SELECT 'sentence_' || o_orderkey AS stem FROM orders), v AS (SELECT aug_name || '_' || stem || '.mp4' AS name, 'temporal' AS aug_type, stem, ratio FROM few, augs UNION ALL SELECT stem || '_yaw_left.mp4', 'view', stem, 1.2 FROM few)
        SELECT name, aug_type, stem, seg, round("start" / ratio, 6) AS "start", round("end" / ratio, 6) AS "end", label FROM v JOIN segs USING (stem)""",
    ),
    "sg4_match_original": (
        lambda s, d: sg.match_original(_derived(s, d).select("name").unionByName(t(s, d, "nation").select(F.concat(F.lit("cv_flip_"), "n_name", F.lit("_part_2.mp4")).alias("name"))), _all(s, d).withColumn("seq", F.lit(1)).unionByName(t(s, d, "nation").select(F.col("n_name").alias("stem"), F.lit(2).alias("seq")))),
        f"WITH {AUGS}, few AS (SELECT 'sentence_' || o_orderkey AS stem FROM orders) SELECT aug_name || '_' || stem || '.mp4' AS name, stem FROM few, augs UNION ALL SELECT stem || '_yaw_left.mp4', stem FROM few UNION ALL SELECT 'cv_flip_' || n_name || '_part_2.mp4', n_name FROM nation",
    ),
    "sg5_plan_augment": (
        lambda s, d: _plan(s, d)[0],
        f"WITH {AUGS}, few AS (SELECT 'sentence_' || o_orderkey AS stem FROM orders) SELECT stem, aug_name, aug_name || '/' || stem || '.mp4' AS out FROM few, augs WHERE ratio <> 3 AND NOT (aug_name = 'speed_050x' AND stem LIKE '%1')",
    ),
    "sg5_plan_counts": (
        lambda s, d: _plan(s, d)[1],
        "SELECT count(*) FILTER (o_orderkey % 10 = 1) AS cached, 6 * count(*) - count(*) FILTER (o_orderkey % 10 = 1) AS new FROM orders",
    ),
    "sg6_plan_render": (
        lambda s, d: au.plan_render(_all(s, d), _config(s)),
        """WITH few AS (SELECT 'sentence_' || o_orderkey AS stem FROM orders)
        SELECT 'fixed_viewpoint' AS type, stem, stem || '_front' AS save_name, 0::DOUBLE AS yaw, 0::DOUBLE AS pitch, 1::DOUBLE AS zoom FROM few UNION ALL SELECT 'fixed_viewpoint', stem, stem || '_yaw_left', -15, 0, 1 FROM few
        UNION ALL SELECT 'cross_reenact', stem, 'x_' || stem || '_a_very_long_template', NULL, NULL, NULL FROM few UNION ALL SELECT 'cross_reenact', stem, 'x_' || stem || '_a_very_long_template_up', 0, 10, 1 FROM few""",
    ),
    "sg7_plan_combined": (
        lambda s, d: au.plan_combined(_views(s, d), _augs(s), 5, 3),
        f"""WITH {AUGS}, v AS (SELECT 'word_' || o_orderkey AS name, 'yaw_l_zoom_in' AS viewpoint FROM orders WHERE o_orderkey % 40 = 0 AND o_orderkey % 3 <> 0)
        SELECT name, viewpoint, aug_name FROM v, augs QUALIFY row_number() OVER (PARTITION BY name ORDER BY md5('3|' || name || '|' || viewpoint || '|' || aug_name)) <= 5""",
    ),
    "sg8_augment_summary": (lambda s, d: au.augment_summary(_results(s, d), _prior(s, d)), f"WITH {SUMMARY} SELECT * FROM summary"),
    "sg8_augment_totals": (
        lambda s, d: au.augment_totals(au.augment_summary(_results(s, d), _prior(s, d))),
        f"""WITH {SUMMARY} SELECT sum("2d_cv" + "3d_cv_combined")::BIGINT AS "2d_cv", sum("temporal")::BIGINT AS "temporal", sum("3d_views")::BIGINT AS "3d_views", sum("identity")::BIGINT AS "identity", sum("2d_cv" + "3d_cv_combined" + "temporal" + "3d_views" + "identity")::BIGINT AS total FROM summary""",
    ),
    "sg9_segment_labels": (lambda s, d: sg.segment_labels(_segs(s, d)), f"WITH {SEGS}, {LABELS} SELECT * FROM labs"),
    "sg10_training_names": (
        lambda s, d: sg.training_names(t(s, d, "documents").select("doc_id", F.concat(F.col("lang"), F.lit("/"), F.repeat(F.lit("abcdefghij"), (F.col("doc_id") % 30).cast("int")), F.when(F.col("doc_id") % 2 == 0, "_word").otherwise(""), F.lit(".mp4")).alias("rel_path"), F.lit("aug_").alias("prefix"), F.lit("word").alias("level"))).select("doc_id", "out"),
        """WITH s AS (SELECT doc_id, 'aug_' || lang || '_' || repeat('abcdefghij', (doc_id % 30)::INT) || '_word' AS k FROM documents) SELECT doc_id, CASE WHEN length(k) + 4 > 250 THEN substr(k, 1, 200) || '_' || substr(md5(k), 1, 12) ELSE k END || '.mp4' AS out FROM s""",
    ),
    "sg11_single_gloss": (lambda s, d: _single(s, d), f"WITH {SINGLE} SELECT * FROM single"),
    "sg12_label_table": (
        lambda s, d: sg.label_table(_single(s, d))[0],
        f"WITH {SINGLE} SELECT stem AS ref, regexp_replace(gloss, '[.,!?;:]+$', '') AS gloss FROM single WHERE gloss IS NOT NULL AND regexp_replace(gloss, '[.,!?;:]+$', '') <> ''",
    ),
    "sg12_label_counts": (
        lambda s, d: sg.label_table(_single(s, d))[1],
        f"WITH {SINGLE} SELECT count(*) FILTER (gloss IS NOT NULL) AS entries, count(*) FILTER (gloss IS NULL AND contains(stem, 'sentence_')) AS skipped_sentence, count(*) FILTER (gloss IS NULL AND NOT contains(stem, 'sentence_')) AS skipped_unmatched FROM single",
    ),
    "sg13_video_gloss_map": (
        lambda s, d: sg.video_gloss_map(t(s, d, "manifest").limit(0).select("filename", F.array("language").alias("glosses")), t(s, d, "manifest").withColumn("sentence_text", F.concat_ws(" ", "language", "source")), t(s, d, "manifest")).select("stem", F.array_join("glosses", "|").alias("glosses")),
        "SELECT replace(filename, '.mp4', '') AS stem, upper(language) || '|' || upper(source) AS glosses FROM {manifest}",
    ),
    "sg14_validate_poses": (
        lambda s, d: vo.validate_poses(_index(s, d)).select("stem", "valid", "reason"),
        "SELECT doc_id::VARCHAR AS stem, doc_id % 10 <> 0 AND doc_id % 12 >= 6 AS valid, CASE WHEN doc_id % 10 = 0 THEN 'unreadable' WHEN doc_id % 12 < 6 THEN 'too_short' END AS reason FROM documents",
    ),
    "sg14_funnel": (
        lambda s, d: vo.funnel(vo.validate_poses(_index(s, d))),
        "SELECT count(*) AS total, count(*) FILTER (doc_id % 10 <> 0) AS readable, count(*) FILTER (doc_id % 10 <> 0 AND doc_id % 12 >= 6) AS valid FROM documents",
    ),
    "sg15_merge_vocab": (
        lambda s, d: vo.merge_vocab(_prev(s, d), _tokens(s, d, "fr")),
        f"WITH {VOC} SELECT * FROM old UNION ALL SELECT token, (SELECT max(id) FROM old) + row_number() OVER (ORDER BY token) FROM fresh",
    ),
    "sg16_merge_entries": (
        lambda s, d: vo.merge_entries(_lines(s, d, 0), _lines(s, d, 1)),
        "SELECT o_orderstatus AS line FROM orders WHERE o_orderkey % 5 <> 0",
    ),
    "sg17_param_grid": (
        lambda s, d: au.param_grid(s, {"yaw": t(s, d, "part").select(F.col("p_size").cast("int") - 25), "brand": t(s, d, "part").select("p_brand"), "zoom": [1, 2]}),
        "SELECT yaw, brand, zoom FROM (SELECT DISTINCT p_size::INT - 25 AS yaw FROM part), (SELECT DISTINCT p_brand AS brand FROM part), (VALUES (1), (2)) b(zoom)",
    ),
}
