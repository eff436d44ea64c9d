"""The operators' queries, each over its whole table, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, decontaminate, fim, gaussian, licenses, mixing, pii, quality, secrets, simhash, tokens, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(_table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda x: x["k"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.digest_text(F.col("base")), 256).alias("base_sha256"), pii.digest_text(F.col("spans")).alias("spans"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.verdicts(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs).select("doc_id", "source", "block", "release", "deadline", "slot", "position")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(_table(spark, sf_dir, "documents"))
    back = fim.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audited(_table(spark, sf_dir, "conversations"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaussian.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pii, op2_warc, op3_secret_scan, op4_quality_rules, op5_license_scan, op6_toxicity, op7_token_counts, op8_mixing, op9_simhash, op10_decontaminate, op11_fill_in_middle, op12_conversations, op13_quality)
}
#: op1, op4, op6, op7, op9, op13 and the pipeline rest on what DuckDB lacks (pattern scores, KLL sketches, learned weights, byte-pair
#: merges, XXH64); tests hold them against brute force. op3 and op5 learn and compress.
SQL: dict[str, str] = {
    "op11_fill_in_middle": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '(?s)[A-Za-z]+|[^A-Za-z]') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        c AS (SELECT *, len(t)::BIGINT AS n, list_transform([0, 1, 2, 3], lambda g: ('0x' || substr(h, 1 + 8 * g, 8))::BIGINT) AS r FROM d),
        p AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
            CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 90 THEN 'plain' WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM c),
        s AS (SELECT *, array_to_string(t[1:a], '') AS pre, array_to_string(t[a + 1:b], '') AS mid, array_to_string(t[b + 1:], '') AS suf FROM p)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
        FROM s""",
    "op12_conversations": r"""
        WITH RECURSIVE src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
        coded AS (SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i::INT, 1))::BIGINT)),
            lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT) % 20 AS code FROM src),
        dam AS (SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role, CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
            unnest(CASE code WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM coded WHERE code <> 0),
        num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(concat_ws('|', coalesce(length(conv_id::VARCHAR)::VARCHAR, 'null'), length(role), conv_id, role, text)), copy) AS i FROM dam),
        flt AS (SELECT *, regexp_extract(text, '(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS fin, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS prev FROM num),
        sym AS (SELECT *, CASE WHEN fin = '' THEN 'b' WHEN again THEN 'd' WHEN fin NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault, role[1] AS c FROM flt),
        con AS (SELECT conv_id, list(struct_pack(f := fault IN ('b', 'd'), t := (fault = 't')::INT, c := c) ORDER BY i) AS rows, count(*) AS n, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
            count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (prev IS NOT NULL AND prev[1] || c NOT IN ('su', 'ua', 'au')) AS illegal, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM sym GROUP BY conv_id),
        -- the best of each state (nothing, system, user, assistant): its cost in nine digits, then its letters
        vit AS (SELECT conv_id, rows, n, 0::BIGINT AS i, '000000000' AS z, NULL::VARCHAR AS s, '000000002I' AS u, '000000004II' AS a FROM con
            UNION ALL SELECT conv_id, rows, n, i + 1, z, s, @u, @a FROM (
                SELECT conv_id, rows, n, i, @z AS z, @s AS s, @ru AS u, @ra AS a FROM (SELECT *, rows[i + 1] AS r FROM vit WHERE i < n))),
        fin AS (SELECT conv_id, least(z, a)[1:9]::BIGINT AS cost, least(z, a)[10:] AS audit FROM vit WHERE i = n),
        let AS (SELECT conv_id, p, audit[p] AS l, sum(CASE WHEN audit[p] <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY p) AS i, sum(CASE WHEN audit[p] <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY p) AS o
            FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM fin)),
        ln AS (SELECT let.conv_id, p, l, o, CASE WHEN l <> 'I' THEN sym.role END AS role, CASE WHEN l <> 'I' THEN text ELSE '' END AS text FROM let LEFT JOIN sym ON sym.conv_id IS NOT DISTINCT FROM let.conv_id AND sym.i = let.i WHERE l <> 'D'),
        st AS (SELECT conv_id, max(CASE WHEN o = 1 AND l = 'K' AND role[1] = 's' THEN 1 ELSE 0 END) AS sys FROM ln GROUP BY conv_id),
        rep AS (SELECT ln.conv_id, sha256(string_agg(CASE WHEN l = 'K' THEN role WHEN (o - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p)) AS h FROM ln JOIN st ON st.conv_id IS NOT DISTINCT FROM ln.conv_id GROUP BY ln.conv_id)
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN con ON con.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN fin ON fin.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN rep ON rep.conv_id IS NOT DISTINCT FROM o.conv_id""",
    "op8_mixing": """
        WITH RECURSIVE n AS (SELECT source, floor(sqrt(count(*)::DOUBLE) * 1024)::BIGINT AS root FROM documents GROUP BY source),
        c AS (SELECT source, greatest(root * 4096 // (SELECT sum(root) FROM n), 1)::BIGINT AS w FROM n),
        o AS (SELECT source, w, row_number() OVER (ORDER BY coalesce(source, ''), source) - 1 AS i FROM c WHERE w > 0),
        f AS (SELECT source, i, w // (SELECT list_reduce(list(w), lambda a, b: gcd(a, b)) FROM o) AS share FROM o),
        a AS (SELECT list(share ORDER BY i) AS sh, sum(share)::BIGINT AS d FROM f),
        sim AS (SELECT 0::BIGINT AS t, list_transform(sh, lambda x: 0::BIGINT) AS taken, -1::BIGINT AS pick, -1::BIGINT AS nth FROM a
            UNION ALL SELECT t + 1, list_transform(taken, lambda x, j: x + CASE WHEN j = p % 100000 + 1 THEN 1 ELSE 0 END), p % 100000, taken[p % 100000 + 1] FROM (
                SELECT t, taken, list_min(list_filter(list_transform(taken, lambda x, j: CASE WHEN x * d // sh[j] <= t THEN ((x + 1) * d + sh[j] - 1) // sh[j] * 100000 + j - 1 END), lambda y: y IS NOT NULL)) AS p
                FROM sim, a WHERE t < d)),
        r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS rn FROM documents)
        SELECT doc_id, r.source, rn // 8 AS block, rn // 8 * d // share AS release, ((rn // 8 + 1) * d + share - 1) // share AS deadline,
               rn // 8 // share * d + sim.t - 1 AS slot, rn % 8 AS position
        FROM r CROSS JOIN a LEFT JOIN f ON r.source IS NOT DISTINCT FROM f.source LEFT JOIN sim ON sim.pick = f.i AND sim.nth = (rn // 8) % share AND sim.t > 0""",
    "op10_decontaminate": r"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS k, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
        b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
        wins AS (SELECT DISTINCT item_id, win, len(win) AS n FROM (SELECT item_id, list_slice(w, i, i + 9) AS win FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0))),
        sizes AS (SELECT DISTINCT n FROM wins),
        places AS (SELECT k, n, i, list_slice(w, i, i + n - 1) AS win FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
        found AS (SELECT k, i, places.n, item_id FROM places JOIN wins USING (win)),
        hit AS (SELECT k, count(*) AS n_hit FROM (SELECT DISTINCT k, unnest(range(i, i + n)) AS p FROM found) GROUP BY k),
        held AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT k, item_id::VARCHAR AS item FROM found) GROUP BY k)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (k) LEFT JOIN held USING (k)""",
    "op2_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS payload_digest FROM p),
        m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS keeper FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN keeper IS NULL OR keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN keeper <> page_id THEN keeper END AS refers_to
        FROM m""",
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline


def _edit(x: str, cost: str, letter: str) -> str:
    """A state's cost in nine digits and its letters after one more edit."""
    return f"(lpad((({x})[1:9]::BIGINT + {cost})::VARCHAR, 9, '0') || ({x})[10:] || '{letter}')"


def _best(states: str, cost: str, letter: str) -> str:
    return f"least({', '.join(_edit(x, cost, letter) for x in states)})"


_user = f"least(u, {_best('zsa', '2', 'I')})"
SQL["op12_conversations"] = reduce(
    lambda sql, part: sql.replace(*part),
    (
        ("@ru", f"least({_edit('u', '3', 'D')}, CASE WHEN NOT r.f THEN {_best('zsa', '2 + r.t', 'R')} END, CASE WHEN NOT r.f AND r.c = 'u' THEN {_best('zsa', 'r.t', 'K')} END)"),
        ("@ra", f"least({_edit('a', '3', 'D')}, CASE WHEN NOT r.f THEN {_edit('u', '2 + r.t', 'R')} END, CASE WHEN NOT r.f AND r.c = 'a' THEN {_edit('u', 'r.t', 'K')} END)"),
        ("@z", _edit("z", "3", "D")),
        ("@s", f"least({_edit('s', '3', 'D')}, CASE WHEN NOT r.f AND r.c = 's' THEN {_edit('z', 'r.t', 'K')} END)"),
        ("@u", _user),
        ("@a", f"least(a, {_edit(_user, '2', 'I')})"),
    ),
    SQL["op12_conversations"],
)
