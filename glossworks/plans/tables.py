"""The domain's tables, derived from the driver's by SQL that Spark and DuckDB both read."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIDEO = "'v' || CAST(user_id * 20 + event_id % 20 AS STRING)"
#: name -> SQL; {x} is a base table or another of these.
TABLES = {
    "decisions": f"""SELECT {VIDEO} AS videoId, CASE event_type WHEN 'purchase' THEN 'approved' ELSE 'rejected' END AS decision, event_id AS seq,
        CASE WHEN event_id % 3 = 0 THEN CAST(NULL AS STRING) ELSE 'b' || CAST(user_id % 3 AS STRING) || '_' || CAST(user_id * 20 + event_id % 20 AS STRING) || '.mp4' END AS videoFileName,
        'b' || CAST(user_id % 3 AS STRING) || '_' || CAST(user_id * 20 + event_id % 20 AS STRING) || '.mp4' AS infoFileName
        FROM {{events}} WHERE event_type IN ('purchase', 'error')""",
    "submissions": f"""SELECT {VIDEO} AS videoId, user_id % 50 AS sentenceId, 'text ' || CAST(user_id % 50 AS STRING) AS sentenceText, 't' || CAST(user_id % 7 AS STRING) AS translatorId,
        'b' || CAST(user_id % 3 AS STRING) || '_' || CAST(user_id * 20 + event_id % 20 AS STRING) || '.mp4' AS videoFileName, 'en' AS language,
        CASE event_type WHEN 'view' THEN 'submission' ELSE 'generated' END AS source, event_id AS seq, ts AS addedAt
        FROM {{events}} WHERE event_type IN ('view', 'click')""",
    "generated": f"""SELECT 'gen_' || CAST(user_id AS STRING) || '_' || CAST(event_id % 20 AS STRING) AS videoId, event_id AS seq, 'word ' || CAST(event_id % 20 AS STRING) AS sentenceText, event_type AS source FROM {{events}} WHERE event_type = 'click'""",
    "gen_decisions": f"""SELECT 'gen_' || CAST(user_id AS STRING) || '_' || CAST(event_id % 20 AS STRING) AS videoId, CASE event_type WHEN 'purchase' THEN 'approved' ELSE 'rejected' END AS decision, event_id AS seq FROM {{events}} WHERE event_type IN ('purchase', 'error')""",
    "batches": """SELECT DISTINCT 'b' || CAST(o_orderkey % 3 AS STRING) AS batch, o_orderkey % 60 AS id, 'sentence ' || CAST(o_orderkey % 60 AS STRING) || ' of ' || CAST(o_orderkey % 3 AS STRING) AS text,
        CASE WHEN o_orderkey % 60 % 4 = 0 THEN 'word' ELSE 'sentence' END AS type, CAST(o_orderkey % 3 AS BIGINT) AS seq FROM {orders}""",
    "files": """SELECT DISTINCT 'b' || CAST(user_id % 3 AS STRING) || '_' || CAST(user_id * 20 + event_id % 20 AS STRING) || '.mp4' AS name FROM {events} WHERE event_id % 7 <> 0""",
    "clips": """SELECT 'word_' || chr(97 + CAST(user_id % 26 AS INT)) || CAST(event_id % 5 AS STRING) || '_' || CAST(20240101000000 + event_id AS STRING) || '.mp4' AS name, event_id AS seq FROM {events}""",
    "sentence_glosses": """SELECT conv_id AS sentence_id, turn AS seq, text AS sentence, upper(role) || '_' || CAST(turn % 4 AS STRING) AS gloss, CAST(turn AS BIGINT) AS pos FROM {conversations}""",
    "manifest": """SELECT doc_id AS seq, CASE WHEN doc_id % 3 = 0 THEN 'sentence_' || CAST(doc_id AS STRING) || '.mp4' ELSE 'word_' || lang || CAST(doc_id AS STRING) || '.mp4' END AS filename, replace(lower(text), 'ß', 'ss') AS sentence_text, lang AS language, source, doc_id AS sentence_id FROM {documents}""",
    "approved_docs": """SELECT l.doc_id FROM {labels} l WHERE l.quality = 1""",
    "benchmark_words": """SELECT DISTINCT word FROM (SELECT explode(split(lower(text), '[^a-z]+')) AS word FROM {benchmark}) w WHERE length(word) > 1""",
}
#: Spark and DuckDB explode differently.
DUCK = {"benchmark_words": """SELECT DISTINCT word FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS word FROM {benchmark}) w WHERE length(word) > 1"""}


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in BASE:
        return base(spark, sf_dir, name)
    sql = TABLES[name]
    return spark.sql(sql, **{x: table(spark, sf_dir, x) for x in set(re.findall(r"\{([a-z]\w*)\}", sql))})


def with_tables(sql: str) -> str:
    """DuckDB SQL with the tables that it names in braces defined in front."""
    defined: dict[str, str] = {}

    def define(text: str) -> str:
        for name in re.findall(r"\{([a-z]\w*)\}", text):
            if name not in BASE and name not in defined:
                body = define(DUCK.get(name, TABLES[name]))
                defined[name] = f"{name} AS ({body})"
        return re.sub(r"\{([a-z]\w*)\}", r"\1", text)

    body = define(sql).strip()
    if not defined:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {', '.join(defined.values())}, {body[15:]}"
    return f"WITH {', '.join(defined.values())}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {', '.join(defined.values())} {body}"
