"""From texts to glosses: phrases, vocabulary lookup, statistics, match reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossworks.functions.common import materialize, small
from glossworks.functions.text import clean_token, normalize_unicode

#: Part-of-speech tags whose unmatched words are kept.
KEPT_TAGS = ("NOUN", "PROPN", "VERB", "ADJ", "ADV", "NUM", "PRON")
#: Confidence of the lookup layers.
EXACT, LEMMA, BOTH_LEMMAS, SEMANTIC = 0.95, 0.90, 0.85, 0.70


def phrase_trie(phrases: DataFrame) -> DataFrame:
    """depth, path, ends: each way of words by which a phrase of two words or more begins, and whether a phrase ends there. phrases: phrase (lower case, single blanks)."""
    words = phrases.where(F.col("phrase").contains(" ")).select("phrase").distinct().withColumn("w", F.split("phrase", " "))
    ways = words.select("phrase", F.explode(F.transform(F.sequence(F.lit(1), F.size("w")), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice("w", F.lit(1), n), " ").alias("path")))).alias("x"))
    return ways.groupBy("x.depth", "x.path").agg(F.bool_or(F.col("x.path") == F.col("phrase")).alias("ends"))


def _phrases_at(rows: DataFrame, phrases: DataFrame) -> DataFrame:
    """row, pos, n: the longest phrase that begins at a place and its words, where there is one. rows: row, w (words).

    All places walk the trie together, a level at a time: who finds no way on falls
    out, and the walk ends when nobody is left, however long phrases are.
    """
    trie = materialize(phrase_trie(phrases), "trie")
    deepest = trie.agg(F.max("depth")).first()[0] or 0
    level = lambda d: small(trie.where(F.col("depth") == d).select("path", "ends"))
    places = rows.select("row", "w", F.posexplode("w").alias("pos", "path")).select("row", "pos", "path", F.slice("w", F.col("pos") + 2, F.lit(max(1, deepest - 1))).alias("next"))
    walking = materialize(places.join(level(1), "path").where("size(next) > 0").select("row", "pos", "path", "next"), "walk")
    found, depth = None, 1
    while depth < deepest and not walking.isEmpty():
        depth += 1
        on = walking.where(F.size("next") >= depth - 1).select("row", "pos", F.concat_ws(" ", "path", F.element_at("next", depth - 1)).alias("path"), "next")
        walking = materialize(on.join(level(depth), "path").select("row", "pos", "path", "next", "ends"), "walk")
        ended = walking.where("ends").select("row", "pos", F.lit(depth).alias("n"))
        found = ended if found is None else found.unionByName(ended)
    if found is None:
        return rows.sparkSession.createDataFrame([], "row long, pos int, n int")
    return found.groupBy("row", "pos").agg(F.max("n").alias("n"))


def tokenize_with_phrases(df: DataFrame, keep: list[str], phrases: DataFrame, text_col: str = "sentence") -> DataFrame:
    """keep, pos, token: from left to right the longest phrase that begins at a word, else the word. phrases: phrase (lower case, single blanks).

    The greedy choice needs only the phrases found in a row: of those in order, each
    that begins after the last chosen one ends.
    """
    words = F.filter(F.transform(F.split(F.lower(F.trim(F.col(text_col))), r"\s+"), clean_token), lambda w: w != "")
    rows = materialize(df.select(*keep, words.alias("__w"), F.monotonically_increasing_id().alias("__row")), "words")
    own = _phrases_at(rows.select(F.col("__row").alias("row"), F.col("__w").alias("w")), phrases).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "n"))).alias("__found"))
    none = F.array().cast("array<struct<pos:int,n:int>>")

    def choose(acc: Column, x: Column) -> Column:
        return F.when(x["pos"] >= acc["end"], F.struct((x["pos"] + x["n"]).alias("end"), F.concat(acc["kept"], F.array(x)).alias("kept"))).otherwise(acc)

    chosen = rows.join(own.withColumnRenamed("row", "__row"), "__row", "left")
    chosen = chosen.select(*keep, "__w", F.aggregate(F.coalesce("__found", none), F.struct(F.lit(0).alias("end"), none.alias("kept")), choose, lambda a: a["kept"]).alias("__kept"))
    covered = F.flatten(F.transform("__kept", lambda x: F.sequence(x["pos"], x["pos"] + x["n"] - 1)))
    places = F.when(F.size("__w") > 0, F.sequence(F.lit(0), F.size("__w") - 1)).otherwise(F.array().cast("array<int>"))
    single = F.transform(F.array_except(places, covered), lambda i: F.struct(i.alias("pos"), F.get("__w", i).alias("token")))
    phrase = F.transform("__kept", lambda x: F.struct(x["pos"].alias("pos"), F.array_join(F.slice("__w", x["pos"] + 1, x["n"]), " ").alias("token")))
    return chosen.select(*keep, F.inline(F.concat(single, phrase)))


def lookup_vocab(tokens: DataFrame, vocab: DataFrame, lemmas: DataFrame, similar: DataFrame | None = None, threshold: float = SEMANTIC) -> DataFrame:
    """token, match_type, confidence, matched_to of each distinct token; null where no layer has it.

    tokens: token; vocab: word; lemmas: word, lemma; similar: token, word, sim (best neighbours, see similarity.top_k_similar).
    Layers: the word itself, its lemma, its lemma as another entry's lemma, the nearest entry by vectors; the first that has it counts.
    """
    distinct = tokens.select("token").distinct()
    v = vocab.select(F.lower("word").alias("w")).distinct()
    lem = lemmas.groupBy(F.lower("word").alias("token")).agg(F.min(F.lower("lemma")).alias("lemma"))
    exact = v.select(F.col("w").alias("token"), F.col("w").alias("m1"))
    by_lemma = v.select(F.col("w").alias("lemma"), F.col("w").alias("m2"))
    entry_lemmas = lem.join(v, F.col("token") == F.col("w")).groupBy("lemma").agg(F.min("w").alias("m3"))
    joined = distinct.join(exact, "token", "left").join(lem, "token", "left").join(by_lemma, "lemma", "left").join(entry_lemmas, "lemma", "left")
    if similar is None:
        joined = joined.withColumns({"m4": F.lit(None).cast("string"), "sim": F.lit(None).cast("double")})
    else:
        best = similar.where(F.col("sim") >= threshold).groupBy("token").agg(F.max_by("word", F.struct("sim", "word")).alias("m4"), F.max("sim").alias("sim"))
        joined = joined.join(best, "token", "left")
    layers = (("exact", "m1", F.lit(EXACT)), ("lemma", "m2", F.lit(LEMMA)), ("lemma_lemma", "m3", F.lit(BOTH_LEMMAS)), ("semantic", "m4", F.col("sim")))

    def pick(value) -> Column:
        return F.coalesce(*[F.when(F.col(m).isNotNull(), value(kind, m, conf)) for kind, m, conf in layers])

    return joined.select("token", pick(lambda k, m, c: F.lit(k)).alias("match_type"), pick(lambda k, m, c: c.cast("double")).alias("confidence"), pick(lambda k, m, c: F.col(m)).alias("matched_to"))


def extract_glosses(tokens: DataFrame, keep: list[str], found: DataFrame, pos_lexicon: DataFrame) -> DataFrame:
    """keep, glosses (upper case, in token order): matched tokens, and unmatched ones of a kept tag. tokens: keep, pos, token; pos_lexicon: word, lemma, tag."""
    joined = tokens.join(found.select("token", "matched_to"), "token", "left").join(pos_lexicon.select(F.col("word").alias("token"), "lemma", "tag"), "token", "left")
    gloss = F.when(F.col("matched_to").isNotNull(), F.col("matched_to")).when(F.col("tag").isin(*KEPT_TAGS), F.coalesce("lemma", "token"))
    rows = joined.select(*keep, "pos", F.upper(gloss).alias("gloss")).where("gloss IS NOT NULL")
    return rows.groupBy(*keep).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "gloss"))), lambda x: x["gloss"]).alias("glosses"))


def vocab_stats(glosses: DataFrame) -> DataFrame:
    """gloss, freq of every occurrence. glosses: glosses."""
    return glosses.select(F.explode("glosses").alias("gloss")).groupBy("gloss").agg(F.count("*").alias("freq"))


def vocab_summary(stats: DataFrame) -> DataFrame:
    return stats.agg(F.count("*").alias("size"), F.coalesce(F.sum("freq"), F.lit(0)).alias("total_tokens"))


def gloss_descriptions(matches: DataFrame, dictionary: DataFrame) -> DataFrame:
    """gloss, description: the first dictionary text that isn't blank. matches: gloss, ref; dictionary: ref, gloss (text), seq."""
    rows = matches.select("gloss", "ref").distinct().join(dictionary.select("ref", F.trim(F.col("gloss")).alias("description"), "seq"), "ref").where("description <> ''")
    return rows.groupBy("gloss").agg(F.min_by("description", F.struct("seq", "description")).alias("description"))


def count_words(tokens: DataFrame) -> DataFrame:
    """token, count, seq (the least), source_file (the files joined by "; ") of each distinct word. tokens: token, file, seq."""
    return tokens.groupBy("token").agg(F.count("*").alias("count"), F.min("seq").alias("seq"), F.array_join(F.sort_array(F.collect_set("file")), "; ").alias("source_file"))


def match_report(tokens: DataFrame, found: DataFrame, dictionary: DataFrame, threshold: float = SEMANTIC) -> DataFrame:
    """A row for each distinct word over all files: status, match, count, the first sentence (in ASCII marks), the files joined by "; ".

    tokens: token, file, sentence, seq (orders files and sentences); found: as of lookup_vocab; dictionary: word, ref, gloss. A word
    found with less confidence than the threshold is unmatched and keeps the confidence. Each word carries its sentence here; of many
    tokens use count_words and report_words.
    """
    # seq and sentence together are the order and the sentence's key
    placed = tokens.withColumn("seq", F.struct("seq", "sentence"))
    words = count_words(placed)
    return report_words(words, words.select("seq", F.col("seq.sentence").alias("sentence")).distinct(), found, dictionary, threshold)


def report_words(words: DataFrame, sentences: DataFrame, found: DataFrame, dictionary: DataFrame, threshold: float = SEMANTIC) -> DataFrame:
    """match_report() of words (as of count_words) whose sentences stand apart: they meet the words last, so that none is sent with every word.

    sentences: seq, sentence; of several of one seq the least counts.
    """
    found = found.withColumns({c: F.when(F.col("confidence") >= threshold, F.col(c)) for c in ("match_type", "matched_to")})
    entries = dictionary.groupBy(F.lower("word").alias("matched_to")).agg(F.min_by(F.struct("ref", "gloss"), F.struct("ref", "gloss")).alias("e"))
    first = sentences.groupBy("seq").agg(F.min("sentence").alias("source_sentence"))
    joined = words.join(found, "token", "left").join(entries, "matched_to", "left").join(first, "seq", "left")
    return joined.select(
        F.col("token").alias("word"), F.when(F.col("matched_to").isNotNull(), "matched").otherwise("unmatched").alias("status"), F.coalesce("match_type", F.lit("")).alias("match_type"), F.round("confidence", 2).alias("confidence"),
        F.coalesce("matched_to", F.lit("")).alias("matched_to"), F.coalesce("e.ref", F.lit("")).alias("ref"), F.coalesce("e.gloss", F.lit("")).alias("gloss"), "count", normalize_unicode(F.trim("source_sentence")).alias("source_sentence"), "source_file",
    )


def report_totals(report: DataFrame) -> DataFrame:
    return report.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "matched").alias("matched"), F.count_if(F.col("status") == "unmatched").alias("unmatched"))


def explain_unmatched(neighbours: DataFrame, definitions: DataFrame, best: float = 0.40, alternate: float = 0.35) -> DataFrame:
    """word, gloss, alternate_words from the five nearest entries of each word (word, neighbour, sim): the best's definition, up to three others."""
    ranked = neighbours.groupBy("word").agg(F.slice(F.sort_array(F.collect_list(F.struct("sim", "neighbour")), asc=False), 1, 5).alias("n"))  # a top-k list is short already
    top = ranked.withColumns({"top": F.element_at("n", 1)["neighbour"], "sim": F.element_at("n", 1)["sim"]}).join(definitions.select(F.col("word").alias("top"), "definition"), "top", "left")
    others = F.slice(F.transform(F.filter("n", lambda x: (x["sim"] >= alternate) & (x["neighbour"] != F.col("word"))), lambda x: x["neighbour"]), 1, 3)
    return top.select("word", F.when(F.col("sim") >= best, F.coalesce("definition", F.lit(""))).otherwise("").alias("gloss"), F.array_join(others, ", ").alias("alternate_words"))


def enhance_glosses(report: DataFrame, curated: DataFrame) -> DataFrame:
    """report with curated gloss and alternates on unmatched rows only. curated: key, gloss, alternate_words."""
    own = curated.select(F.lower(F.trim("key")).alias("__k"), F.col("gloss").alias("__g"), F.col("alternate_words").alias("__a"))
    joined = report.withColumn("__k", F.lower(F.trim("word"))).join(own, "__k", "left")
    hit = (F.col("status") == "unmatched") & F.col("__g").isNotNull()
    return joined.withColumns({"gloss": F.when(hit, F.col("__g")).otherwise(F.col("gloss")), "alternate_words": F.when(hit, F.col("__a")).otherwise(F.lit("")), "enhanced": F.when(F.col("status") == "unmatched", F.col("__g").isNotNull())}).drop("__k", "__g", "__a")
