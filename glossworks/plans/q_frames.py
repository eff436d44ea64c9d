"""Frame, timeline and similarity queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from glossworks.operators import frames as fr
from glossworks.operators import gloss as gl
from glossworks.operators import similarity as sr

from .tables import table as t

#: events as frames: a user is a video, values are scores
FRAMES = """SELECT user_id AS video, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS frame, CASE WHEN event_id % 11 = 0 THEN NULL ELSE least(1.0, 0.5 + value / 200) END AS body, least(1.0, 0.3 + value / 90) AS lhand,
    least(1.0, 0.25 + value / 80) AS rhand, value * 3 AS lx, value * 2 AS ly, value * 1.5 AS rx, value * 2.5 AS ry, 576 AS side FROM {events}"""
NUM = f"f AS ({FRAMES}), num AS (SELECT *, frame - 1 AS i, count(*) OVER (PARTITION BY video) AS n FROM f)"
REF = f"""{NUM}, ref AS (SELECT video, max(n) AS n, {', '.join(f"avg({c}) FILTER (m) AS r_{c}" for c in ('body', 'lhand', 'rhand', 'lx', 'ly', 'rx', 'ry'))}, max(side) AS side FROM
        (SELECT *, body IS NOT NULL AND i >= greatest(1, n // 4) AND i < greatest(greatest(1, n // 4) + 1, n - n // 4) AS m FROM num) GROUP BY video)"""
FLAGS = f"""{REF}, j AS (SELECT num.video, i, num.n, body, (r_body - body) / r_body > 0.13 AS b, (r_lhand - lhand) / r_lhand > 0.5 OR lhand < 0.3 AS l, (r_rhand - rhand) / r_rhand > 0.5 OR rhand < 0.3 AS r,
        sqrt(pow(lx - r_lx, 2) + pow(ly - r_ly, 2)) AS lj, sqrt(pow(rx - r_rx, 2) + pow(ry - r_ry, 2)) AS rj, ref.side FROM num JOIN ref USING (video) WHERE ref.n >= 4 AND r_body IS NOT NULL),
        c AS (SELECT *, b::INT + ((l AND r) OR (l AND rj > side * 0.1) OR (r AND lj > side * 0.1))::INT + (lj > side * 0.25 AND rj > side * 0.25)::INT AS cats FROM j),
        flags AS (SELECT video, i, n, CASE WHEN body IS NULL THEN true ELSE cats >= 2 END AS glitch, CASE WHEN body IS NOT NULL THEN cats END AS n_categories,
        CASE WHEN body IS NULL THEN 'no_pose' ELSE concat_ws(';', CASE WHEN b THEN 'body_drop' END, CASE WHEN l THEN 'lhand_lost' END, CASE WHEN r THEN 'rhand_lost' END, CASE WHEN lj > side * 0.1 THEN 'lwrist_jump' END, CASE WHEN rj > side * 0.1 THEN 'rwrist_jump' END) END AS reasons FROM c)"""
SIMS = "sims AS (SELECT q.vec_id AS q, c.vec_id AS id, list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS sim FROM embeddings q, embeddings c WHERE q.vec_id % 20 = 0)"
TL = "tl AS (SELECT job, idx, n_frames + CASE WHEN lead(idx) OVER w IS NOT NULL THEN 125 ELSE 0 END AS len FROM (SELECT o_custkey AS job, o_orderkey AS idx, o_orderkey % 90 AS n_frames FROM orders) WHERE n_frames > 0 WINDOW w AS (PARTITION BY job ORDER BY idx)), tt AS (SELECT job, idx, len, coalesce(sum(len) OVER (PARTITION BY job ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS began FROM tl), timeline AS (SELECT job, idx, round(began / 25, 3)::DOUBLE AS start_time, round((began + len) / 25, 3)::DOUBLE AS end_time FROM tt)"


def _frames(s, d):
    return s.sql(FRAMES, events=t(s, d, "events"))


def _flags(s, d):
    f = _frames(s, d)
    return fr.glitch_flags(f, fr.mid_reference(f))


def _diffs(s, d):
    return _frames(s, d).select("video", (F.col("frame") - 1).alias("i"), (F.col("lx") / 3 / 20).alias("diff"))


def _timeline(s, d):
    return fr.test_timeline(t(s, d, "orders").select(F.col("o_custkey").alias("job"), F.col("o_orderkey").alias("idx"), (F.col("o_orderkey") % 90).alias("n_frames")), 25.0)


def _vec(s, d, where="true"):
    return t(s, d, "embeddings").where(where).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")


def _top(s, d, k, least=-1.0):
    return sr.top_k_similar(_vec(s, d, "vec_id % 20 = 0"), _vec(s, d), k, least)


def _means(s, d):
    """One prototype for each label: the mean of its vectors."""
    each = _vec(s, d).select("label", F.posexplode("vec").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    means = each.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda x: x["m"]).alias("vec"))
    return means.select(F.col("label").cast("long").alias("proto_id"), "vec", F.concat(F.lit("t"), "label").alias("token"))


def _neighbours(s, d):
    """The five nearest of each word but itself."""
    return _top(s, d, 6).where("q <> id").withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy("rank"))).where("r <= 5").select(F.concat(F.lit("w"), "q").alias("word"), F.concat(F.lit("w"), "id").alias("neighbour"), F.round("sim", 9).alias("sim"))


QUERIES = {
    "fr1_mid_reference": (
        lambda s, d: fr.mid_reference(_frames(s, d)).select("video", "n", *[F.round(f"r_{c}", 6).alias(f"r_{c}") for c in ("body", "lhand", "rhand", "lx", "ly", "rx", "ry")], "side", "reason"),
        f"WITH {REF} SELECT video, n, {', '.join(f'round(r_{c}, 6) AS r_{c}' for c in ('body', 'lhand', 'rhand', 'lx', 'ly', 'rx', 'ry'))}, side, CASE WHEN n < 4 THEN 'too_short' WHEN r_body IS NULL THEN 'no_pose_in_middle' END AS reason FROM ref",
    ),
    "fr2_glitch_flags": (lambda s, d: _flags(s, d).withColumn("i", F.col("i").cast("long")), f"WITH {FLAGS} SELECT video, i, n, glitch, n_categories, reasons FROM flags"),
    "fr3_tail_cut": (
        lambda s, d: fr.tail_cut(_flags(s, d)).withColumn("cut_at", F.col("cut_at").cast("long")),
        f"""WITH {FLAGS}, p AS (SELECT video, max(n) AS n, max(i) FILTER (NOT glitch OR i <= n // 2) + 2 AS cut_at, arg_max(reasons, i) AS reasons FROM flags GROUP BY video)
        SELECT video, n, cut_at, n + 1 - cut_at AS n_drop, CASE WHEN n + 1 > cut_at THEN array_to_string(range(cut_at, n + 1), ',') ELSE '' END AS drop_frames, reasons FROM p""",
    ),
    "fr4_repeat_cut": (
        lambda s, d: fr.repeat_cut(_diffs(s, d)).withColumn("cut", F.col("cut").cast("long")),
        f"""WITH {NUM}, s AS (SELECT video, i, n AS m, avg(lx / 3 / 20) OVER (PARTITION BY video ORDER BY i ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING) AS s FROM num),
        a AS (SELECT *, min(i) FILTER (s > 2) OVER (PARTITION BY video) AS active FROM s), q AS (SELECT *, min(i) FILTER (s < 1.5 AND i > active) OVER (PARTITION BY video) AS quiet FROM a),
        p AS (SELECT video, max(m) + 1 AS n, max(quiet) AS quiet, min(i) FILTER (s > 2 AND i > quiet) AS again FROM q GROUP BY video) SELECT video, n, CASE WHEN again IS NOT NULL AND quiet >= 10 AND n >= 20 THEN quiet END AS cut FROM p""",
    ),
    "fr5_pad_plan": (
        lambda s, d: fr.pad_plan(t(s, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 30).cast("int").alias("n_frames"))),
        "SELECT o_orderkey, n::INT AS n_frames, CASE WHEN n < 20 THEN 5 + (greatest(20 - (n + 10), 0) + 1) // 2 ELSE 0 END::INT AS pad_front, CASE WHEN n < 20 THEN 5 + greatest(20 - (n + 10), 0) // 2 ELSE 0 END::INT AS pad_back FROM (SELECT o_orderkey, o_orderkey % 30 AS n FROM orders)",
    ),
    "fr6_gloss_timeline": (
        lambda s, d: fr.gloss_timeline(t(s, d, "orders").select(F.col("o_custkey").alias("job"), F.col("o_orderkey").alias("pos"), F.col("o_orderpriority").alias("gloss"), F.when(F.col("o_orderkey") % 4 != 0, (F.col("o_orderkey") % 7).cast("double") / 4).alias("duration"))),
        """WITH g AS (SELECT o_custkey AS job, o_orderkey AS pos, o_orderpriority AS gloss, (o_orderkey % 7)::DOUBLE / 4 AS d FROM orders WHERE o_orderkey % 4 <> 0)
        SELECT job, pos, gloss, coalesce(sum(d) OVER (PARTITION BY job ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "start", sum(d) OVER (PARTITION BY job ORDER BY pos) AS "end" FROM g""",
    ),
    "fr7_test_timeline": (lambda s, d: _timeline(s, d), f"WITH {TL} SELECT * FROM timeline"),
    "fr7_composite_frames": (
        lambda s, d: fr.composite_frames(t(s, d, "orders").select(F.col("o_custkey").alias("job"), F.col("o_orderkey").alias("idx"), F.array(F.col("o_orderpriority"), F.col("o_orderstatus")).alias("glosses")), t(s, d, "orders").groupBy(F.col("o_orderpriority").alias("gloss")).agg((F.count("*") % 7).alias("n_frames"))),
        "WITH w AS (SELECT o_orderpriority AS gloss, count(*) % 7 AS n_frames FROM orders GROUP BY 1) SELECT o_custkey AS job, o_orderkey AS idx, n_frames FROM orders JOIN w ON gloss = o_orderpriority",
    ),
    "fr8_at_time": (
        lambda s, d: fr.at_time(t(s, d, "events").select(F.col("user_id").alias("job"), "event_id", (F.col("value") / 3).alias("t")), _timeline(s, d)),
        f"WITH {TL}, e AS (SELECT user_id AS job, event_id, value / 3 AS t FROM events) SELECT e.job, event_id, t, idx FROM e JOIN timeline l ON e.job = l.job AND l.start_time <= t AND t < l.end_time",
    ),
    "sr1_search": (
        lambda s, d: sr.search(_vec(s, d, "vec_id % 20 = 0"), _vec(s, d).withColumn("text", F.concat(F.lit("text "), "id")), 5, 11),
        f"""WITH {SIMS}, p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(sim, 12) DESC, id) AS r FROM sims WHERE length('text ' || id) > 5) WHERE r <= 15),
        k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY md5('11|' || q || '|' || id)) AS x FROM p) WHERE x <= 5) SELECT q, id, round(sim, 4) AS score, (row_number() OVER (PARTITION BY q ORDER BY r))::INT AS rank FROM k""",
    ),
    "sr2_top_k_similar": (
        lambda s, d: _top(s, d, 10, 0.1).withColumn("sim", F.round("sim", 6)),
        f"WITH {SIMS} SELECT q, id, round(sim, 6) AS sim, (row_number() OVER (PARTITION BY q ORDER BY round(sim, 12) DESC, id))::INT AS rank FROM sims WHERE sim >= 0.1 QUALIFY row_number() OVER (PARTITION BY q ORDER BY round(sim, 12) DESC, id) <= 10",
    ),
    "sr3_match_clips": (
        lambda s, d: sr.match_clips(
            _vec(s, d, "vec_id % 20 = 0").select(F.lit(1).alias("job"), F.col("id").alias("pos"), F.concat(F.lit("W"), "id").alias("gloss")),
            _vec(s, d).where("id % 20 <> 0 OR id % 60 = 0").select(F.concat(F.lit("w"), "id").alias("gloss"), F.concat("id", F.lit(".mp4")).alias("path")),
            _vec(s, d, "vec_id % 100 = 0").select(F.concat(F.lit("w"), "id").alias("word"), F.concat(F.lit("w"), F.col("id") + 1).alias("lemma")),
            _neighbours(s, d).select(F.col("word").alias("gloss"), "neighbour", "sim"), 0.3,
        ),
        f"""WITH {SIMS}, b AS (SELECT q, arg_max(id, sim) AS nb, max(sim) AS sim FROM sims WHERE id <> q GROUP BY q), m AS (SELECT max(vec_id) AS top FROM embeddings),
        c AS (SELECT q, nb, sim, q % 60 = 0 AS own, q % 100 = 0 AND q < top AS lem, sim >= 0.3 AND (nb % 20 <> 0 OR nb % 60 = 0) AS near FROM b, m)
        SELECT 1 AS job, q AS pos, 'W' || q AS gloss, CASE WHEN own THEN q || '.mp4' WHEN lem THEN (q + 1) || '.mp4' WHEN near THEN nb || '.mp4' END AS path, CASE WHEN own THEN 'exact' WHEN lem THEN 'lemma' WHEN near THEN 'semantic' ELSE 'none' END AS match_type,
        CASE WHEN own THEN 1.0 WHEN lem THEN 0.9 WHEN near THEN round(sim, 3) ELSE 0.0 END::DOUBLE AS score FROM c""",
    ),
    "sr4_nearest_prototype": (
        lambda s, d: sr.nearest_prototype(_vec(s, d), _means(s, d)).withColumn("score", F.round("score", 6)),
        """WITH p AS (SELECT label, list(m ORDER BY i) AS vec FROM (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY ALL) GROUP BY 1)
        SELECT c.vec_id AS id, 't' || arg_max(p.label, list_cosine_similarity(p.vec, c.embedding::DOUBLE[])) AS token, round(max(list_cosine_similarity(p.vec, c.embedding::DOUBLE[])), 6) AS score FROM embeddings c, p GROUP BY 1""",
    ),
    "tx12_explain_unmatched": (
        lambda s, d: gl.explain_unmatched(_neighbours(s, d), _vec(s, d).select(F.concat(F.lit("w"), "id").alias("word"), F.concat(F.lit("meaning "), "label").alias("definition")), 0.3, 0.2),
        f"""WITH {SIMS}, r AS (SELECT q, id, sim, row_number() OVER (PARTITION BY q ORDER BY round(sim, 12) DESC, id) AS r FROM sims WHERE id <> q), x AS (SELECT q, id, sim, r, label FROM r JOIN embeddings ON vec_id = id WHERE r <= 5)
        SELECT 'w' || q AS word, max(CASE WHEN r = 1 AND sim >= 0.3 THEN 'meaning ' || label ELSE '' END) AS gloss, coalesce(string_agg('w' || id, ', ' ORDER BY r) FILTER (sim >= 0.2 AND r <= 3), '') AS alternate_words FROM x GROUP BY q""",
    ),
}
