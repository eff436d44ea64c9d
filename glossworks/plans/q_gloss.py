"""Text and gloss queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossworks.functions import text as tx
from glossworks.functions.common import materialize
from glossworks.operators import gloss as gl

from .tables import table as t

STOPS = ", ".join(f"'{w}'" for w in tx.STOP_WORDS)
#: sentences of the conversations, numbered within a turn
SENTENCES = """parts AS (SELECT conv_id, turn, unnest(list_filter(list_transform(regexp_split_to_array(text, '[.!?]+'), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '')) AS sentence, generate_subscripts(list_filter(list_transform(regexp_split_to_array(text, '[.!?]+'), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> ''), 1) - 1 AS pos FROM conversations)"""
CLEAN = "regexp_replace(lower({x}), '^[^\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+$', '', 'g')"
RAW = "raw AS (SELECT conv_id, turn, unnest(regexp_split_to_array(trim(text), '\\s+')) AS raw, generate_subscripts(regexp_split_to_array(trim(text), '\\s+'), 1) - 1 AS pos FROM conversations)"
TOKENS = f"tokens AS (SELECT * FROM (SELECT conv_id, turn, pos, {CLEAN.format(x='raw')} AS token FROM raw) WHERE token <> '' AND token NOT IN ({STOPS}) AND NOT regexp_full_match(token, '[0-9]+'))"
LEMMA = "regexp_replace({w}, '(?:ing|ed|es|s)$', '')"
FOUND = f"""v AS (SELECT word FROM {{benchmark_words}}), lem AS (SELECT DISTINCT token, {LEMMA.format(w='token')} AS lemma FROM tokens),
        vl AS (SELECT {LEMMA.format(w='word')} AS lemma, min(word) AS m3 FROM v JOIN (SELECT DISTINCT token FROM tokens) k ON k.token = word GROUP BY 1),
        found AS (SELECT l.token, CASE WHEN a.word IS NOT NULL THEN 'exact' WHEN b.word IS NOT NULL THEN 'lemma' WHEN vl.m3 IS NOT NULL THEN 'lemma_lemma' END AS match_type,
        CASE WHEN a.word IS NOT NULL THEN 0.95 WHEN b.word IS NOT NULL THEN 0.90 WHEN vl.m3 IS NOT NULL THEN 0.85 END::DOUBLE AS confidence, coalesce(a.word, b.word, vl.m3) AS matched_to
        FROM lem l LEFT JOIN v a ON a.word = l.token LEFT JOIN v b ON b.word = l.lemma LEFT JOIN vl ON vl.lemma = l.lemma)"""
EXPAND = "translate({x}, '‘’', '''''')"
for _end, _full in tx.CONTRACTIONS:
    EXPAND = f"regexp_replace({EXPAND}, '" + _end.replace("'", "''") + f"', '{_full}', 'gi')"
ASCII = "replace(translate({x}, '‘’“”–—' || chr(160), '''''''\"\"-- '), '…', '...')"
KEY = ["conv_id", "turn"]


def _conv(s, d):
    return t(s, d, "conversations")


def _tokens(s, d):
    return tx.content_tokens(_conv(s, d), KEY)


def _lemmas(tokens):
    return tokens.select(F.col("token").alias("word")).distinct().withColumn("lemma", F.regexp_replace("word", "(?:ing|ed|es|s)$", ""))


def _lookup(s, d, tokens):
    return gl.lookup_vocab(tokens, t(s, d, "benchmark_words"), _lemmas(tokens))


def _distinct(s, d):
    """Each token once: texts are cut into words once for all that needs their words only."""
    return materialize(_tokens(s, d).select("token").distinct(), "tokens")


def _found(s, d):
    return _lookup(s, d, _distinct(s, d))


def _lexicon(lemmas):
    return lemmas.withColumn("tag", F.when(F.length("word") % 3 == 0, "NOUN").otherwise("X"))


def _glosses(s, d):
    words = _distinct(s, d)
    return gl.extract_glosses(_tokens(s, d), KEY, _lookup(s, d, words), _lexicon(_lemmas(words)))


def _report(s, d):
    conv, seq = _conv(s, d), (F.col("conv_id") * 1000 + F.col("turn")).alias("seq")
    # turns meet their files before they are cut into words; a word carries the key of its sentence, never the sentence
    files = conv.select(*KEY, F.col("role").alias("file"), F.struct(seq, *KEY).alias("seq"))
    words = materialize(gl.count_words(tx.content_tokens(conv.select(*KEY, "text").join(files, KEY), ["file", "seq"])), "words")
    sentences = conv.select(F.struct(seq, *KEY).alias("seq"), F.col("text").alias("sentence"))
    return gl.report_words(words, sentences, _lookup(s, d, words), t(s, d, "benchmark_words").select("word", F.md5("word").alias("ref"), F.upper("word").alias("gloss")))


GLOSSES = f"glosses AS (SELECT conv_id, turn, pos, upper(replace(CASE WHEN f.matched_to IS NOT NULL THEN f.matched_to WHEN length(t.token) % 3 = 0 THEN {LEMMA.format(w='t.token')} END, 'ß', 'ss')) AS gloss FROM tokens t LEFT JOIN found f USING (token))"
REPORT = f"""report AS (SELECT t.token AS word, CASE WHEN f.matched_to IS NULL THEN 'unmatched' ELSE 'matched' END AS status, coalesce(f.match_type, '') AS match_type, f.confidence, coalesce(f.matched_to, '') AS matched_to,
        CASE WHEN f.matched_to IS NULL THEN '' ELSE md5(f.matched_to) END AS ref, CASE WHEN f.matched_to IS NULL THEN '' ELSE upper(f.matched_to) END AS gloss, t.count, t.source_sentence, t.source_file
        FROM (SELECT token, count(*) AS count, {ASCII.format(x='trim(arg_min(c.text, conv_id * 1000 + turn))')} AS source_sentence, string_agg(DISTINCT role, '; ' ORDER BY role) AS source_file FROM tokens JOIN conversations c USING (conv_id, turn) GROUP BY token) t JOIN found f USING (token))"""
QUERIES = {
    "tx1_normalize_unicode": (
        lambda s, d: _conv(s, d).select(*KEY, tx.normalize_unicode(F.concat(F.lit("It’s “don‘t”—we’LL…\xa0"), F.col("text"))).alias("text")),
        f"SELECT conv_id, turn, 'It''s \"don''t\"-we''LL... ' || {ASCII.format(x='text')} AS text FROM conversations",
    ),
    "tx2_expand_contractions": (
        lambda s, d: _conv(s, d).select(*KEY, tx.expand_contractions(F.concat(F.lit("Didn’t I've WE'LL it‘s he'd I'm they're "), F.col("text"))).alias("text")),
        f"SELECT conv_id, turn, 'Did not I have WE will it is he would I am they are ' || {EXPAND.format(x='text')} AS text FROM conversations",
    ),
    "tx3_split_sentences": (lambda s, d: tx.split_sentences(_conv(s, d), KEY), f"WITH {SENTENCES} SELECT conv_id, turn, pos::INT AS pos, sentence FROM parts"),
    "tx4_pack_clauses": (
        lambda s, d: tx.pack_clauses(tx.split_sentences(_conv(s, d), KEY), [*KEY, "pos"]).groupBy(*KEY, "pos").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("clause_pos", "clause"))), lambda x: x["clause"]), " | ").alias("clauses")),
        f"""WITH RECURSIVE {SENTENCES}, p AS (SELECT conv_id, turn, pos, len(string_split(sentence, ' ')) AS n, sentence, list_filter(list_transform(regexp_split_to_array(sentence, '\\s*(?:[,;:]|–|—|--)\\s*'), lambda x: trim(x)), lambda x: x <> '') AS a FROM parts),
        f AS (SELECT conv_id, turn, pos, a, 1 AS i, CAST('' AS VARCHAR) AS done, CAST('' AS VARCHAR) AS now FROM p WHERE n > 12
        UNION ALL SELECT conv_id, turn, pos, a, i + 1, CASE WHEN now = '' OR len(string_split(now || ' ' || a[i], ' ')) <= 12 THEN done ELSE done || now || ' | ' END,
        CASE WHEN now = '' THEN a[i] WHEN len(string_split(now || ' ' || a[i], ' ')) <= 12 THEN now || ' ' || a[i] ELSE a[i] END FROM f WHERE i <= len(a))
        SELECT conv_id, turn, pos::INT AS pos, sentence AS clauses FROM p WHERE n <= 12 UNION ALL SELECT conv_id, turn, pos::INT, done || now FROM f WHERE i = len(a) + 1 AND len(a) > 0""",
    ),
    "tx5_content_tokens": (lambda s, d: _tokens(s, d), f"WITH {RAW}, {TOKENS} SELECT conv_id, turn, pos::INT AS pos, token FROM tokens"),
    "tx6_phrases": (
        lambda s, d: gl.tokenize_with_phrases(_conv(s, d), KEY, _phrases(s, d).unionByName(_openings(s, d)), "text").groupBy(*KEY).agg(F.count("*").alias("n"), F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]), "|")).alias("tokens")),
        f"""WITH RECURSIVE b AS (SELECT list_filter(list_transform(regexp_split_to_array(lower(trim(text)), '\\s+'), lambda x: {CLEAN.format(x='x')}), lambda x: x <> '') AS w, item_id FROM benchmark),
        c AS (SELECT conv_id, turn, list_filter(list_transform(regexp_split_to_array(lower(trim(text)), '\\s+'), lambda x: {CLEAN.format(x='x')}), lambda x: x <> '') AS w FROM conversations),
        ph AS (SELECT DISTINCT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS phrase FROM b UNION SELECT array_to_string(w[1:2 + conv_id % 11], ' ') FROM c WHERE turn = 0 AND len(w) >= 2),
        m AS (SELECT conv_id, turn, i, max(n) AS n FROM (SELECT conv_id, turn, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM (SELECT conv_id, turn, w, unnest(range(1, len(w) + 1)) AS i FROM c), range(2, 13) r(n) WHERE i + n - 1 <= len(w)) JOIN ph USING (phrase) GROUP BY ALL),
        g AS (SELECT p.*, coalesce(n, 1) AS n FROM (SELECT conv_id, turn, w, unnest(range(1, len(w) + 1)) AS i FROM c) p LEFT JOIN m USING (conv_id, turn, i)),
        walk AS (SELECT conv_id, turn, 1::BIGINT AS i FROM c UNION ALL SELECT g.conv_id, g.turn, g.i + n FROM walk JOIN g ON walk.conv_id = g.conv_id AND walk.turn = g.turn AND walk.i = g.i)
        SELECT conv_id, turn, count(*) AS n, md5(string_agg(array_to_string(w[i:i + n - 1], ' '), '|' ORDER BY i)) AS tokens FROM walk JOIN g USING (conv_id, turn, i) GROUP BY 1, 2""",
    ),
    "tx7_lookup_vocab": (lambda s, d: _found(s, d), f"WITH {RAW}, {TOKENS}, {FOUND} SELECT * FROM found"),
    "tx8_extract_glosses": (
        lambda s, d: _glosses(s, d).select(*KEY, F.array_join("glosses", " ").alias("glosses")),
        f"WITH {RAW}, {TOKENS}, {FOUND}, {GLOSSES} SELECT conv_id, turn, string_agg(gloss, ' ' ORDER BY pos) AS glosses FROM glosses WHERE gloss IS NOT NULL GROUP BY 1, 2",
    ),
    "tx9_vocab_stats": (lambda s, d: gl.vocab_stats(_glosses(s, d)), f"WITH {RAW}, {TOKENS}, {FOUND}, {GLOSSES} SELECT gloss, count(*) AS freq FROM glosses WHERE gloss IS NOT NULL GROUP BY 1"),
    "tx9_vocab_summary": (
        lambda s, d: gl.vocab_summary(gl.vocab_stats(_glosses(s, d))),
        f"WITH {RAW}, {TOKENS}, {FOUND}, {GLOSSES} SELECT count(DISTINCT gloss) AS size, count(gloss) AS total_tokens FROM glosses",
    ),
    "tx10_gloss_descriptions": (
        lambda s, d: gl.gloss_descriptions(
            t(s, d, "documents").select(F.upper("lang").alias("gloss"), F.col("source").alias("ref")),
            t(s, d, "documents").select(F.col("source").alias("ref"), F.when(F.col("doc_id") % 3 == 0, " ").otherwise(F.col("text")).alias("gloss"), F.col("doc_id").alias("seq")),
        ),
        """WITH m AS (SELECT DISTINCT upper(lang) AS gloss, source AS ref FROM documents), k AS (SELECT source AS ref, trim(text) AS description, doc_id FROM documents WHERE doc_id % 3 <> 0)
        SELECT gloss, arg_min(description, doc_id) AS description FROM m JOIN k USING (ref) WHERE description <> '' GROUP BY gloss""",
    ),
    "tx11_match_report": (lambda s, d: _report(s, d), f"WITH {RAW}, {TOKENS}, {FOUND}, {REPORT} SELECT * FROM report"),
    "tx11_report_totals": (
        lambda s, d: gl.report_totals(_report(s, d)),
        f"WITH {RAW}, {TOKENS}, {FOUND}, {REPORT} SELECT count(*) AS total, count(*) FILTER (status = 'matched') AS matched, count(*) FILTER (status = 'unmatched') AS unmatched FROM report",
    ),
    "tx13_enhance_glosses": (
        lambda s, d: gl.enhance_glosses(_report(s, d), _lemmas(_tokens(s, d)).where("length(word) % 2 = 0").select(F.concat(F.lit(" "), "word").alias("key"), F.concat(F.lit("g "), "word").alias("gloss"), F.col("lemma").alias("alternate_words"))).select("word", "status", "gloss", "alternate_words", "enhanced"),
        f"""WITH {RAW}, {TOKENS}, {FOUND}, {REPORT} SELECT word, status, CASE WHEN h THEN 'g ' || word ELSE gloss END AS gloss, CASE WHEN h THEN {LEMMA.format(w='word')} ELSE '' END AS alternate_words, CASE WHEN status = 'unmatched' THEN h END AS enhanced
        FROM (SELECT *, status = 'unmatched' AND length(word) % 2 = 0 AS h FROM report)""",
    ),
    "tx14_clean_id": (
        lambda s, d: t(s, d, "documents").select("doc_id", tx.clean_id(F.expr("CASE doc_id % 5 WHEN 0 THEN 'nan' WHEN 1 THEN doc_id || '.0' WHEN 2 THEN NULL WHEN 3 THEN doc_id || '.5' ELSE 'x' || doc_id END")).alias("id")),
        "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN doc_id::VARCHAR WHEN 2 THEN '' WHEN 3 THEN doc_id || '.5' ELSE 'x' || doc_id END AS id FROM documents",
    ),
    "tx15_keys": (
        lambda s, d: t(s, d, "pages").select("page_id", tx.gloss_key(F.concat(F.lit(" A_b "), "page_id")).alias("gloss_key"), tx.sentence_key(F.concat("page_id", F.lit(" is it?! "))).alias("sentence_key"), tx.safe_id(F.col("url")).alias("safe_id"), tx.batch_name(F.col("url")).alias("batch"), tx.text_type(F.substring("url", 1, 9)).alias("kind")),
        """SELECT page_id, 'a b ' || page_id AS gloss_key, page_id || ' is it' AS sentence_key, regexp_replace(trim(url), '[^A-Za-z0-9._-]+', '_', 'g') AS safe_id, regexp_replace(regexp_replace(lower(trim(url)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS batch, CASE WHEN regexp_matches(substr(url, 1, 9), '[.!?]$') THEN 'sentence' ELSE 'word' END AS kind FROM pages""",
    ),
    "tx16_public_name": (lambda s, d: t(s, d, "documents").select("doc_id", tx.public_name(F.col("doc_id")).alias("name")), "SELECT doc_id, substr(md5(doc_id::VARCHAR), 1, 10) || '.mp4' AS name FROM documents"),
}


def _phrases(s, d):
    words = F.filter(F.transform(F.split(F.lower(F.trim("text")), r"\s+"), tx.clean_token), lambda w: w != "")
    b = t(s, d, "benchmark").select(words.alias("w")).where("size(w) > 1")
    return b.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat_ws(" ", F.element_at("w", i), F.element_at("w", i + 1)))).alias("phrase")).distinct()


def _openings(s, d):
    """The first two to twelve words of each conversation."""
    words = F.filter(F.transform(F.split(F.lower(F.trim("text")), r"\s+"), tx.clean_token), lambda w: w != "")
    first = _conv(s, d).where("turn = 0").select(words.alias("w"), (F.col("conv_id") % 11 + 2).cast("int").alias("n")).where("size(w) > 1")
    return first.select(F.array_join(F.slice("w", F.lit(1), F.col("n")), " ").alias("phrase")).distinct()
