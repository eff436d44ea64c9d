"""Secret scans with a random forest that removes false findings.

Candidates are unbroken strings that mix letters and digits. Each is described by
its length, by how likely its character transitions are in the words of the corpus,
by how much of it such words cover, by its path (the document's source) and by
the words of its whole line and the signs beside it. Transitions and the dictionary are counted over
all words of all documents; the dictionary stays a table, which the candidates'
pieces are joined to. A random forest learned from labelled findings keeps what
looks like a secret.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, row_key, small

#: A candidate: sixteen or more characters without white space, letters and digits among them.
SHAPE = r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])(?=[0-9_+/=-]*+[A-Za-z])[A-Za-z0-9_+/=-]{16,}+"
_shape = re.compile(SHAPE)
#: Words before a candidate that name a secret, and signs of assignment.
NAMES = r"(?:token|secret|passw(?:or)?d|passwd|pwd|api[_-]?key|apikey|access[_-]?key|private[_-]?key|credential|auth|bearer)"
_named = re.compile(NAMES + r"\W{0,6}$", re.I)
_name = re.compile(NAMES, re.I)
_assigned = re.compile(r"[=:]\s*[\"']?$")
_word = re.compile(r"[^\W\d_]+")
#: Labelled findings that the forest is fitted on at most (a part of them by hash), its trees and their depth.
MOST_LABELLED, TREES, DEPTH = 50_000, 40, 8
#: Features of a candidate's own form, of its place and neighbours; and those that tell what names and signs stand before it.
FORM = ("length", "transitions", "switches", "entropy", "covered", "digits", "upper", "hexadecimal", "path", "line_words", "before_known", "after_known", "after_word")
CONTEXT = ("named", "assigned", "quoted")
FEATURES = FORM + CONTEXT
CANDIDATE = "start int, end int, value string, before string, after string, line_words int, left string, right string"
#: Characters before and after a candidate that names and signs are looked for in: more than any of them takes.
BESIDE = 64
SEED = 42


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """id, key, path and each candidate with what its line has on either side; places are code points."""
    kind = docs.schema[id_col].dataType.simpleString()

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc, key, path, text in zip(frame["id"], frame["key"], frame["path"], frame["text"], strict=True):
                for line, places in groupby(_shape.finditer(text), key=lambda m: text.rfind("\n", 0, m.start()) + 1):  # noqa: B031, B023
                    end = text.find("\n", line)
                    end = end if end >= 0 else len(text)
                    # the line's words once for all its candidates
                    words = [w.span() for w in _word.finditer(text, line, end)]
                    starts, ends = [w[0] for w in words], [w[1] for w in words]
                    for m in places:
                        a, b = m.span()
                        before, after = bisect_right(ends, a), bisect_left(starts, b)
                        spelled = lambda order: next((w for w in (text[slice(*words[i])] for i in order) if not _name.fullmatch(w)), "").lower()  # noqa: B023, E731
                        left, right = spelled(range(before - 1, -1, -1)), spelled(range(after, len(words)))
                        rows.append((doc, key, path, a, b, m.group(), text[max(line, a - BESIDE) : a], text[b : min(b + BESIDE, end)], before + len(words) - after, left, right))
            out = pd.DataFrame(rows, columns=["id", "key", "path", "start", "end", "value", "before", "after", "line_words", "left", "right"])
            out["id"] = pd.Series([r[0] for r in rows], dtype=frame["id"].dtype)
            yield out

    some = docs.where(F.col(text_col).rlike("[A-Za-z0-9_+/=-]{16}")).select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(path_col).cast("string").alias("path"), F.col(text_col).alias("text"))
    return some.mapInPandas(read, f"id {kind}, key long, path string, {CANDIDATE}")


def dictionary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """w, n: the words of ASCII letters, in lower case, and how many documents have them; over all documents."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sums: Counter = Counter()
            for text in frame["text"]:
                sums.update(set(_ascii.findall(text.lower())))
            yield pd.DataFrame({"w": list(sums.keys()), "n": list(sums.values())})

    counted = docs.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text")).mapInPandas(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    return materialize(counted, "dictionary")


_ascii = re.compile(r"(?<![a-z0-9_])[a-z]+(?![a-z0-9_])")


def transitions(words: DataFrame) -> dict[str, int]:
    """Two letters -> how often they follow each other in the words, by the documents that have them."""
    pairs = words.select("n", F.explode(F.expr("transform(sequence(1, greatest(length(w) - 1, 1)), i -> substring(w, i, 2))")).alias("p")).where("length(p) = 2")
    return {r.p: r.n for r in pairs.groupBy("p").agg(F.sum("n").alias("n")).collect()}  # at most 26 * 26


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """found and x: array<double>, in the order of FEATURES. words: w, n, as of dictionary."""
    pairs = transitions(words)
    firsts: Counter = Counter()
    for pair, n in pairs.items():
        firsts[pair[0]] += n
    kinds = {f.name: f.dataType.simpleString() for f in found.schema.fields}

    def described(value: str, path: str | None, before: str, after: str, line_words: int) -> list[float]:
        low, n = value.lower(), len(value)
        moves = [math.log((pairs.get(low[i : i + 2], 0) + 1) / (firsts[low[i]] + 40)) for i in range(n - 1)]
        shape = ["a" if c.islower() else "A" if c.isupper() else "9" if c.isdigit() else "-" for c in value]
        counts = Counter(value)
        return [
            float(n), sum(moves) / max(1, len(moves)), sum(a != b for a, b in zip(shape, shape[1:], strict=False)) / n, -sum(c / n * math.log2(c / n) for c in counts.values()),
            shape.count("9") / n, shape.count("A") / n, float(all(c in "0123456789abcdef" for c in low)), float(sum(map(ord, path or "")) % 64), float(line_words),
            float(bool(re.match(r"[\"']?\W*\s[a-zA-Z]", after))), float(bool(_named.search(before))), float(bool(_assigned.search(before))), float(before[-1:] in "\"'" and before != "" and after[:1] == before[-1:]),
        ]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = list(zip(frame["value"], frame["path"], frame["before"], frame["after"], frame["line_words"], strict=True))
            own = [[w.lower() for w in re.findall(r"[A-Z]?[a-z]{3,}|[A-Z]{4,}", r[0])] for r in rows]
            yield frame.assign(own=own, d=[described(*r) for r in rows])

    schema = ", ".join(f"`{c}` {k}" for c, k in kinds.items()) + ", own array<string>, d array<double>"
    read_rows = materialize(found.withColumn("at", F.xxhash64(*found.columns)).mapInPandas(read, schema + ", at long"), "candidates")
    asked = read_rows.select("at", "value", F.explode(F.concat(F.transform("own", lambda w: F.struct(w.alias("w"), F.lit(0).alias("side"))), F.array(F.struct(F.col("left").alias("w"), F.lit(1).alias("side")), F.struct(F.col("right").alias("w"), F.lit(2).alias("side"))))).alias("a"))
    known = asked.dropDuplicates(["at", "a"]).select("at", "a.w", "a.side").join(words, "w")
    looked = known.groupBy("at").agg(F.collect_set(F.when(F.col("side") == 0, F.col("w"))).alias("known"), F.max(F.when(F.col("side") == 1, F.log1p("n"))).alias("l"), F.max(F.when(F.col("side") == 2, F.log1p("n"))).alias("r"))
    joined = read_rows.join(looked, "at", "left")
    inside = F.filter("own", lambda w: F.array_contains(F.coalesce("known", F.array().cast("array<string>")), w))
    covered = F.aggregate(inside, F.lit(0), lambda t, w: t + F.length(w)) / F.length("value")
    d = lambda i: F.element_at("d", i + 1)
    x = F.array(d(0), d(1), d(2), d(3), covered, d(4), d(5), d(6), d(7), d(8), F.coalesce("l", F.lit(0.0)), F.coalesce("r", F.lit(0.0)), d(9), d(10), d(11), d(12))
    return joined.select(*found.columns, x.alias("x"))


def weak_labels(found: DataFrame) -> DataFrame:
    """key, start, secret: findings labelled by what stands before them, where the corpus brings no labels of its own.

    A credential's name and a sign of assignment make a secret; no name and no
    assignment make a false finding; what lies between stays unlabelled. A forest
    learned from these labels must not see the names and signs (scan leaves CONTEXT out).
    """
    named, assigned = F.col("before").rlike(f"(?i){NAMES}\\W{{0,6}}$"), F.col("before").rlike("[=:]\\s*[\"']?$")
    return found.select("key", "start", F.when(named & assigned, 1).when(~named & ~assigned, 0).alias("secret")).where("secret IS NOT NULL")


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """id_col, start, end, value, probability, secret (int: 1 from a probability above 0.5) of every candidate.

    labelled: key (row_key), start, secret (0 or 1) of labelled findings; null:
    weak_labels of the rows whose key isn't divisible by five, from which the forest
    learns how secrets look and where they stand, without CONTEXT. It is fitted on at most
    about MOST_LABELLED of them. With fewer than two kinds of label every named candidate is kept.
    Null and empty texts and an empty table have no candidate; repeated rows are scanned each, and equal
    candidates get equal probabilities; a candidate of any length is one; a null path is empty.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    words = dictionary(docs, text_col)
    found = materialize(features(candidates(docs, id_col, text_col, path_col), words), "candidates")
    used = FEATURES if labelled is not None else FORM
    if labelled is None:
        labelled = weak_labels(found.where(F.pmod("key", F.lit(5)) != 0))
    labelled = materialize(labelled.groupBy("key", "start").agg(F.max("secret").alias("secret")), "findings")
    many = labelled.count()
    if many > MOST_LABELLED:
        labelled = labelled.where(F.pmod(F.xxhash64("key", "start", F.lit("findings")), F.lit(1 << 20)) < (1 << 20) * MOST_LABELLED // many)
    x = array_to_vector(F.slice("x", 1, len(used)))  # CONTEXT comes last
    train = found.dropDuplicates(["key", "start"]).join(small(labelled), ["key", "start"]).select(x.alias("x"), F.col("secret").cast("double").alias("y"))
    train = materialize(train.repartition(8), "labelled")
    out = found.select(F.col("id").alias(id_col), "start", "end", "value", "x")
    if train.select("y").distinct().count() < 2:
        named = F.element_at("x", FEATURES.index("named") + 1)
        return out.select(id_col, "start", "end", "value", named.alias("probability"), named.cast("int").alias("secret"))
    forest = RandomForestClassifier(featuresCol="x", labelCol="y", numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(train)
    judged = forest.transform(out.withColumn("x", x))
    sure: Column = vector_to_array("probability")[1]
    return judged.select(id_col, "start", "end", "value", sure.alias("sure"), F.col("prediction").cast("int").alias("secret")).withColumnRenamed("sure", "probability")
