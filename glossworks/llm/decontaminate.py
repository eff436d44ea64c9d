"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

An item's windows are ten consecutive words (a shorter item is one window). A
window is the set of its word shingles (three words; fewer in a shorter
window), and a document holds it only if it holds all of them, so by the prefix
principle one shingle is enough to find every candidate: the rarest, by counts
over all documents. A shared prefix shingle fixes where the window would lie;
it must lie within the document's length, and then the shingles that cover it
must stand at their places. Only shingles of the items leave the scan of the
documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_WORD, ascii_lower, materialize, row_key, small, words

WINDOW, SHINGLE = 10, 3


def _words(text: str) -> Column:
    return words(ascii_lower(F.col(text)), NOT_WORD)


def _windows(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """item, win (its words), len: each window of each item."""
    return (
        items.select(F.col(item_col).alias("item"), _words(text_col).alias("w"))
        .where(F.size("w") > 0)
        .select("item", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))).alias("i"))
        .select("item", F.slice("w", F.col("i") + 1, window).alias("win"))
        .distinct()
        .select("item", "win", F.size("win").alias("len"))
    )


def _shingles(of: str, size: Column, k: int) -> Column:
    """array<struct<p, g>>: each k words and where they begin."""
    parts = [F.slice(of, i + 1, F.greatest(size - (k - 1), F.lit(0))).alias(f"w{i}") for i in range(k)]
    return F.arrays_zip(*parts)


def occurrences(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """key (row_key of a document), at (its word where a window begins), len, item."""
    windows = materialize(_windows(items, item_col, item_text, window), "windows")
    sizes = [r[0] for r in windows.select(F.least(F.col("len"), F.lit(SHINGLE))).distinct().collect()]  # at most three numbers
    distinct = windows.select("win", "len").distinct()
    read = docs.select(row_key(id_col, text_col).alias("key"), _words(text_col).alias("w")).select("key", "w", F.size("w").alias("n"))
    holds, hits = None, None
    for k in sorted(sizes):
        g = F.array(*[F.col(f"z.w{i}") for i in range(k)])
        own = (
            distinct.where(F.least(F.col("len"), F.lit(SHINGLE)) == k)
            .select("win", "len", F.posexplode(_shingles("win", F.col("len"), k)).alias("off", "z"))
            .select("win", "len", "off", g.alias("g"))
        )
        known = small(own.select("g").distinct().select("g", F.xxhash64(*[F.col("g")[i] for i in range(k)]).alias("h")))
        # the hash finds, the words decide
        found = (
            read.where(F.col("n") >= k)
            .select("key", "n", F.posexplode(_shingles("w", F.col("n"), k)).alias("pos", "z"))
            .select("key", "n", "pos", F.xxhash64(*[F.col(f"z.w{i}") for i in range(k)]).alias("h"), *[F.col(f"z.w{i}").alias(f"w{i}") for i in range(k)])
            .join(known, "h")
            .where(F.expr(" AND ".join(f"g[{i}] = w{i}" for i in range(k))))
            .select("key", "n", "pos", "g")
        )
        holds = own if holds is None else holds.unionByName(own)
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        none = docs.sparkSession.createDataFrame([], "key long, at int, len int")
        return none.crossJoin(windows.select("item").limit(0))
    hits = materialize(hits.distinct(), "hits")
    # prefix: of the shingles of a window, the rarest over all documents; a shingle that no document has ends it
    counts = hits.groupBy("g").count()
    holds = holds.join(counts, "g", "left")
    ranked = holds.groupBy("win", "len").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "g", "off")).alias("rarest"),
        F.collect_list(F.struct("off", "g")).alias("all"),  # no more than the words of a window
    )
    # every SHINGLE-th of them and the last cover the window
    prefix = small(
        ranked.where("rarest.n > 0").select(
            F.col("rarest.g").alias("g"), F.col("rarest.off").alias("off"), "win", "len",
            F.filter("all", lambda x: (x["off"] % SHINGLE == 0) | (x["off"] == F.greatest(F.col("len") - SHINGLE, F.lit(0)))).alias("cover"),
        )
    )
    candidates = (
        hits.join(prefix, "g")
        .withColumn("at", F.col("pos") - F.col("off"))
        .where((F.col("at") >= 0) & (F.col("at") + F.col("len") <= F.col("n")))
        .select("key", "at", "win", "len", F.size("cover").alias("need"), F.explode("cover").alias("c"))
        .select("key", "at", "win", "len", "need", (F.col("at") + F.col("c.off")).alias("pos"), F.col("c.g").alias("g"))
    )
    sure = candidates.join(hits.select("key", "pos", "g"), ["key", "pos", "g"]).groupBy("key", "at", "win", "len", "need").count().where(F.col("count") == F.col("need"))
    return sure.select("key", "at", "win", "len").join(small(windows.select("item", "win")), "win").select("key", "at", "len", "item")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """id_col, n_words, n_hit, n_items, items (sorted as strings), contaminated of each document.

    Null and wordless texts have no words and are clean, wordless items have no
    window; rows of equal id and text get the same result each. An empty table
    of items leaves every document clean.
    """
    found = materialize(occurrences(docs, items, id_col, text_col, item_col), "occurrences")
    hit = found.select("key", F.explode(F.sequence("at", F.col("at") + F.col("len") - 1)).alias("p")).distinct().groupBy("key").agg(F.count("*").alias("n_hit"))
    of = found.select("key", F.col("item").cast("string").alias("item")).distinct().groupBy("key").agg(F.array_sort(F.collect_list("item")).alias("items"))
    found = hit.join(of, "key", "left")
    rows = docs.select(id_col, row_key(id_col, text_col).alias("key"), F.size(_words(text_col)).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return rows.join(found, "key", "left").select(
        id_col, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The documents in which no window of an item occurs, as they are."""
    bad = occurrences(docs, items, id_col, text_col, item_col).select(F.col("key").alias("__key")).distinct()
    return docs.join(bad, row_key(id_col, text_col) == F.col("__key"), "left_anti")
