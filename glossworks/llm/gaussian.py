"""A quality classifier: regularised quadratic discriminant over transformed document statistics.

Each text is described by a few statistics (lengths, shares of symbols, capitals,
repeated and distinct words, ...), transformed so that a class lies about a centre.
Each class has a mean and a covariance; the covariance is shrunk towards the pooled
one and towards its diagonal, by the two parts that do best on a fold that gave no
moments. Its Cholesky factor is worked out once and kept, so that a text's score is
the difference of two Mahalanobis log densities, two triangular products. Moments
and losses are sums that Spark adds up over all labelled rows; nothing but them
comes to the driver. Neither learning nor scoring sees anything but texts and labels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANK_CHARS, materialize, row_key, small

WORD = re.compile(r"[^ \t-\r]+")
SYMBOLS = "#*$%&|<>~^=_{}[]\\"
STOPS = ".,;:"
#: The statistics, in this order.
NAMES = ("words", "word_chars", "symbols", "calls", "stops", "capitals", "digits", "distinct", "repeated", "short", "dup_lines", "line_words", "most_frequent", "bare", "doubled")
#: Parts of the pooled covariance, parts of its diagonal and tempers of the log density difference that are tried.
POOLED, DIAGONAL, TEMPERS = (0.0, 0.3, 0.6, 0.9), (0.01, 0.05, 0.2), (1.0, 0.5, 0.25, 0.125)
#: One part in so many of the labelled rows only chooses among them; a score from which a text is predicted 1.
FOLDS, LEAST = 4, 0.3


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a text (null: empty): logarithms of lengths, square roots of shares."""
    text = text or ""
    words = WORD.findall(text)
    n, chars = len(words), sum(map(len, words))
    if not n:
        return [0.0] * len(NAMES)
    per = lambda x: math.sqrt(x / n)
    lines = [x for x in (line.strip(BLANK_CHARS) for line in text.split("\n")) if x]
    code, low = (np.frombuffer(x.encode("utf-32-le", "surrogatepass"), "<u4") for x in (text, text.lower()))
    capitals = int((code != low).sum()) if len(code) == len(low) else sum(map(str.isupper, text))
    counted = Counter(words)
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    again = sum(c for c in grams.values() if c > 1)
    return [
        math.log1p(n), math.log1p(chars / n), min(3.0, per(sum(text.count(c) for c in SYMBOLS))), min(3.0, per(text.count("!") + text.count("?"))), min(3.0, per(sum(text.count(c) for c in STOPS))),
        math.sqrt(min(1.0, capitals / chars)), math.sqrt(int(((code >= 48) & (code < 58)).sum()) / chars), math.log(len(counted)) / math.log(n + 1), math.sqrt(again / max(1, n - 2)),
        math.sqrt(sum(len(w) <= 3 for w in words) / n), math.sqrt(1 - len(set(lines)) / len(lines)), math.log1p(n / len(lines)), math.sqrt(max(counted.values()) / n), math.sqrt(sum(map(str.isalpha, words)) / n),
        math.sqrt(sum(map(str.__eq__, words, words[1:])) / n),
    ]


def described(rows: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """keep and x: the statistics of each text."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[keep].assign(x=[statistics(t) for t in frame["__text"]])

    schema = "".join(f"`{c}` {kinds[c]}, " for c in keep) + "x array<double>"
    return rows.select(*keep, F.col(text_col).alias("__text")).mapInPandas(read, schema)


@dataclass
class Gaussian:
    """A class's density: its mean, the inverse of its covariance's Cholesky factor, and the logarithm of factor and prior."""

    mean: np.ndarray
    whiten: np.ndarray
    constant: float

    @classmethod
    def of(cls, mean: np.ndarray, covariance: np.ndarray, prior: float) -> Gaussian:
        factor = np.linalg.cholesky(covariance)
        return cls(mean, np.linalg.inv(factor), math.log(prior) - float(np.log(np.diag(factor)).sum()))

    def log_density(self, x: np.ndarray) -> np.ndarray:
        """Without the term that both classes share."""
        z = (x - self.mean) @ self.whiten.T
        return self.constant - 0.5 * np.einsum("ij,ij->i", z, z)


@dataclass
class Discriminant:
    """Both classes' densities with their cached factors, and how much their difference is tempered."""

    poor: Gaussian
    good: Gaussian
    temper: float = 1.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        return self.good.log_density(x) - self.poor.log_density(x)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1: the tempered difference by the logistic function."""
        return 0.5 * (1 + np.tanh(0.5 * self.temper * self.difference(x)))


def moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """y -> how many, the sum of x, the sum of its products; rows: x, y. Sums of a task's rows are added up by Spark."""
    d = len(NAMES)

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {0: np.zeros((d + 1, d + 1)), 1: np.zeros((d + 1, d + 1))}
        for frame in frames:
            for y, part in frame.groupby("y"):
                x = np.column_stack([np.ones(len(part)), np.array(part["x"].tolist())])
                total[y] += x.T @ x
        i, j = np.indices((d + 1, d + 1)).reshape(2, -1)
        for y, m in total.items():
            if m[0, 0]:
                yield pd.DataFrame({"y": y, "i": i, "j": j, "s": m.ravel()})

    summed = rows.select("x", "y").mapInPandas(add, "y int, i int, j int, s double").groupBy("y", "i", "j").agg(F.sum("s").alias("s"))
    out = {}
    for r in summed.collect():  # 2 * (d + 1) ** 2 rows
        out.setdefault(r.y, np.zeros((d + 1, d + 1)))[r.i, r.j] = r.s
    return {y: (m[0, 0], m[0, 1:], m[1:, 1:]) for y, m in out.items()}


def shrunk(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled: float, diagonal: float) -> Discriminant:
    """The discriminant whose class covariances are so far pooled, and then so far diagonal."""
    n = sum(s[0] for s in sums.values())
    mean = {y: total / count for y, (count, total, _) in sums.items()}
    own = {y: products / count - np.outer(mean[y], mean[y]) for y, (count, _, products) in sums.items()}
    within = sum(sums[y][0] / n * own[y] for y in sums)
    floor = np.diag(np.maximum(np.diag(within), 1e-4))  # a statistic that hardly varies still has a width

    def density(y: int) -> Gaussian:
        mixed = (1 - pooled) * own[y] + pooled * within
        return Gaussian.of(mean[y], (1 - diagonal) * mixed + diagonal * floor, sums[y][0] / n)

    return Discriminant(density(0), density(1))


def fit(labelled: DataFrame) -> Discriminant | None:
    """From rows of key, x, y (0 or 1), all of them; null where a class is missing from either fold."""
    rows = materialize(labelled.select("x", F.col("y").cast("int").alias("y"), F.pmod(F.xxhash64("key"), F.lit(FOLDS)).alias("fold")), "labelled")
    learned, judging = moments(rows.where("fold > 0")), rows.where("fold = 0")
    if len(learned) < 2 or min(s[0] for s in learned.values()) < 2:
        every = moments(rows)
        return shrunk(every, 0.9, 0.2) if len(every) == 2 and min(s[0] for s in every.values()) >= 2 else None
    tried = [(p, d, shrunk(learned, p, d)) for p in POOLED for d in DIAGONAL]

    def lose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(tried), len(TEMPERS)))
        for frame in frames:
            x, sign = np.array(frame["x"].tolist()).reshape(-1, len(NAMES)), np.where(frame["y"] == 1, 1.0, -1.0)
            for i, (_, _, model) in enumerate(tried):
                z = sign * model.difference(x)
                total[i] += [np.logaddexp(0, -t * z).sum() for t in TEMPERS]
        i, j = np.indices(total.shape).reshape(2, -1)
        yield pd.DataFrame({"i": i, "j": j, "loss": total.ravel()})

    losses = judging.mapInPandas(lose, "i int, j int, loss double").groupBy("i", "j").agg(F.round(F.sum("loss"), 6).alias("loss"))
    best = losses.orderBy("loss", "i", "j").first()
    if best is None:
        return shrunk(learned, 0.9, 0.2)
    pooled, diagonal, _ = tried[best.i]
    out = shrunk(moments(rows), pooled, diagonal)  # the moments of every labelled row
    out.temper = TEMPERS[best.j]
    return out


def held_out(id_col: str = "doc_id"):
    """Rows that learning never sees: crc32 of the id as text divisible by five (a null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """id_col, held_out, score, predicted of each row. labels: id_col, quality (of several the lowest).

    A null text is empty, an empty one has statistics of 0 and is scored like any
    other; rows that repeat are all returned, equal texts with equal scores, and
    learned from once; a score of exactly least is predicted 1; a text of any length is
    read to its end; labels other than 0 and 1 are left out. Without labels of both
    kinds nothing is learned: every text scores 0.5. An empty table gives an empty table.
    """
    found = materialize(described(docs.select(F.col(id_col).alias("__id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("__t")), ["__id", "key"], "__t"), "statistics")
    known = labels.select(F.col(id_col).alias("__lid"), F.col("quality").cast("int").alias("y")).where("y IN (0, 1)").groupBy("__lid").agg(F.min("y").alias("y"))
    model = fit(found.where(~held_out("__id")).dropDuplicates(["key"]).join(small(known), F.col("__id") == F.col("__lid")).select("key", "x", "y"))
    id_type = docs.schema[id_col].dataType.simpleString()

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = np.array(frame["x"].tolist()).reshape(-1, len(NAMES))
            yield pd.DataFrame({"id": frame["__id"], "score": model.score(x) if model else np.full(len(x), 0.5)})

    scored = found.select("__id", "x").mapInPandas(judge, f"id {id_type}, score double")
    return scored.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))
