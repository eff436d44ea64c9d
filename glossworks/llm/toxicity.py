"""Toxicity by a weighted finite-state pattern grammar.

A text is read clause by clause. A first transducer maps words to symbols: insult
stems (prefix arcs with weights learned from labelled rows), threats, targets,
negations, reported speech. Five machines over these symbols, each a table of
arcs, say which weight a word brings (insult, threat), whether a negation reaches
it, whether it is reported, and whether the clause has a target. They are composed
(their product) into one table of arcs from state and symbol to state and cell;
a clause's weights add up by cell, so a word weighs by what stands about it. How
much less a negated or reported weight counts, and how much more one with a
target, is learned: the logistic function of a text takes its totals and the
parts of them that the cells hold.

Learning: stems are word prefixes that far more toxic than other documents
hold; of near copies (equal least shingle hash) one row counts, else a passage
copied often would be learned word by word. The logistic function is fitted on
a fourth of the labelled rows that gave no stems. Neither learning nor scoring sees anything
but texts and labels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, row_key, small

#: Prefix lengths of stems, toxic rows that a stem needs, its least log odds, and the labelled rows that are learned from at most (a
#: part of them by hash; stems are as many as these hold).
LENGTHS, LEAST_ROWS, LEAST_ODDS, MOST_LABELLED = (3, 4, 5, 6, 7), 6, 2.5, 400_000
#: Words whose symbols are given; the languages of the data.
TARGETS = frozenset("you your yours yourself he she they him her them du dich dir ihr euch sie tu toi vous te ton tes usted ustedes ellos ellas".split())
NEGATIONS = frozenset("not never nobody isn't aren't don't nicht kein keine keinen niemals ne jamais nunca jamás".split())
REPORTS = frozenset("said says wrote writes called quoted sagte sagt schrieb nannte dit disait écrit dijo dice escribió llamó".split())
THREATS = frozenset("kill hurt beat destroy burn strangle stab töten umbringen schlagen verbrennen tuer frapper brûler détruire matar golpear quemar destruir".split())
#: Words that a negation reaches, and the weights of a clause's cells before any are learned.
REACH, NEGATED, REPORTED, AIMED = 2, 0.5, 0.7, 1.3
CLAUSE = re.compile(r"[.!?;:,\n()\"«»“”]+")
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
SYMBOLS = INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = range(6)


@dataclass(frozen=True)
class Machine:
    """A transducer: arcs from (state, symbol) to (state, outputs), outputs a set of marks; state 0 is the start, and every state an end."""

    arcs: dict[tuple, tuple]

    def __matmul__(self, other: Machine) -> Machine:
        """The composition that reads a symbol in both at once: states are pairs, outputs both's."""
        start, arcs, todo = (self.start, other.start), {}, [(self.start, other.start)]
        seen = {start}
        while todo:
            a, b = todo.pop()
            for symbol in SYMBOLS:
                (x, out), (y, more) = self.arcs[a, symbol], other.arcs[b, symbol]
                arcs[(a, b), symbol] = ((x, y), out | more)
                if (x, y) not in seen:
                    seen.add((x, y))
                    todo.append((x, y))
        return Machine({((0 if k[0] == start else k[0]), k[1]): ((0 if v[0] == start else v[0]), v[1]) for k, v in arcs.items()})

    @property
    def start(self):
        return 0


def _marks(kind: int, mark: str) -> Machine:
    """One state: a symbol's mark."""
    return Machine({(0, x): (0, frozenset({mark} if x == kind else ())) for x in SYMBOLS})


def _after(kind: int, mark: str, reach: int | None = None) -> Machine:
    """Marks the words after one of the kind: the next reach of them, or all to the clause's end."""
    states = (reach or 1) + 1
    arcs = {}
    for state in range(states):
        for x in SYMBOLS:
            left = states - 1 if x == kind else state if reach is None else max(0, state - 1)
            arcs[state, x] = (left, frozenset({mark} if state else ()))
    return Machine(arcs)


INSULTS, THREATENED = _marks(INSULT, "insult"), _marks(THREAT, "threat")
NEGATING, REPORTING, AIMING = _after(NEGATION, "negated", REACH), _after(REPORT, "reported"), _after(TARGET, "aimed")
#: Cells of a clause's weights: what brings it, and whether it is negated or reported; those of a clause with a target stand apart.
CELLS = tuple((kind, negated, reported) for kind in ("insult", "threat") for negated in (False, True) for reported in (False, True))


def compiled() -> tuple[list[list[tuple[int, int]]], list[bool]]:
    """The composed grammar as tables: arcs[state][symbol] = (state, cell or -1), and whether a state has seen a target."""
    whole = INSULTS @ THREATENED @ NEGATING @ REPORTING @ AIMING
    number = {0: 0}
    for (state, _), (to, _) in whole.arcs.items():
        for x in (state, to):
            number.setdefault(x, len(number))
    arcs, aimed = [[(0, -1)] * len(SYMBOLS) for _ in number], [False] * len(number)
    for (state, symbol), (to, out) in whole.arcs.items():
        kind = next((k for k in ("insult", "threat") if k in out), None)
        cell = CELLS.index((kind, "negated" in out, "reported" in out)) if kind else -1
        arcs[number[state]][symbol] = (number[to], cell)
        aimed[number[state]] = aimed[number[state]] or "aimed" in out
    return arcs, aimed


class Grammar:
    """Reads texts: word symbols as a cache over prefix arcs, clauses by the composed tables."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.symbols: dict[str, tuple[int, float]] = {}
        self.arcs, self.aimed = compiled()
        self.before = [(NEGATED if negated else 1.0) * (REPORTED if reported else 1.0) for _, negated, reported in CELLS]

    def symbol(self, word: str) -> tuple[int, float]:
        """Symbol and weight; of several prefix arcs the heaviest."""
        weight = max((self.stems[p] for p in prefixes(word) if p in self.stems), default=0.0)
        threat = word in THREATS
        kind = THREAT if threat else INSULT if weight else TARGET if word in TARGETS else NEGATION if word in NEGATIONS else REPORT if word in REPORTS else OTHER
        if len(self.symbols) > 400_000:
            self.symbols.clear()
        self.symbols[word] = (kind, max(weight, 1.0) if threat else weight)
        return self.symbols[word]

    def clause(self, words: list[str]) -> tuple[list[float], bool]:
        """The weights of the cells along the grammar's one path for a clause, and whether it has a target."""
        cells, state, known, arcs = [0.0] * len(CELLS), 0, self.symbols, self.arcs
        for word in words:
            symbol, weight = known.get(word) or self.symbol(word)
            state, cell = arcs[state][symbol]
            if cell >= 0:
                cells[cell] += weight
        return cells, self.aimed[state]

    def features(self, text: str | None) -> tuple[float, ...]:
        """Of the clauses: the highest total, the sum, the sum for a hundred words; and the parts of all weights that are threats,
        negated, reported, and in clauses with a target."""
        text = (text or "").lower()
        known, symbol = self.symbols.get, self.symbol
        found = WORD.findall(text)
        if not any((known(w) or symbol(w))[0] in (INSULT, THREAT) for w in found):
            return NOTHING
        high = total = aims = 0.0
        sums = [0.0] * len(CELLS)
        for part in CLAUSE.split(text):
            cells, aimed = self.clause(WORD.findall(part))
            own = sum(c * f for c, f in zip(cells, self.before, strict=True)) * (AIMED if aimed else 1.0)
            high, total = max(high, own), total + own
            sums = [a + b for a, b in zip(sums, cells, strict=True)]
            aims += sum(cells) * aimed
        every = sum(sums)
        parts = [sum(x for x, cell in zip(sums, CELLS, strict=True) if test(cell)) / every for test in (lambda c: c[0] == "threat", lambda c: c[1], lambda c: c[2])]
        return (high, total, 100 * total / len(found), *parts, aims / every)


NOTHING = (0.0,) * 7
NAMES = ("high", "total", "share", "threats", "negated", "reported", "aimed")


def prefixes(word: str) -> list[str]:
    """Its prefixes, and the whole word with an end mark."""
    return [*[word[:n] for n in LENGTHS if n <= len(word)], word + "$"]


def _signature(text: str) -> int:
    """The least hash of the text's three-word shingles: near copies mostly share it."""
    w = text.lower().encode("utf-8", "surrogatepass").split()
    return min((xxhash.xxh64_intdigest(b" ".join(w[i : i + 3])) for i in range(max(1, len(w) - 2))), default=0) - (1 << 63)


def learn_stems(rows: DataFrame) -> dict[str, float]:
    """prefix -> weight, from rows of text and toxic (0 or 1). Counted over all rows; only the stems come to the driver."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sums: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
                sums[int(toxic)].update({p for w in set(WORD.findall(text.lower())) for p in prefixes(w)})
            keys = list(sums[0].keys() | sums[1].keys())
            yield pd.DataFrame({"p": keys, "pos": [sums[1][k] for k in keys], "neg": [sums[0][k] for k in keys]})

    totals = rows.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    n_pos, n_neg = (totals[0] or 0) + 1, (totals[1] or 0) + 1
    counted = rows.select("text", "toxic").mapInPandas(count, "p string, pos long, neg long").groupBy("p").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    odds = F.log((F.col("pos") + 0.5) / n_pos) - F.log((F.col("neg") + 0.5) / n_neg)
    best = counted.where(F.col("pos") >= LEAST_ROWS).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    found = {r.p: float(r.odds) for r in best.select("p", "odds").collect()}  # as many as MOST_LABELLED rows can hold
    # a longer prefix that adds nothing to a shorter one isn't needed
    return {p: w for p, w in found.items() if not any(p[:n] in found and found[p[:n]] >= w - 0.5 for n in range(min(LENGTHS), len(p)))}


def _signed(rows: DataFrame) -> DataFrame:
    """One row of each group of near copies."""

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[["key"]].assign(sig=np.array([_signature(t) for t in frame["text"]], dtype=np.int64))

    first = materialize(rows.select("key", "text").mapInPandas(sign, "key long, sig long").groupBy("sig").agg(F.min("key").alias("key")), "signatures")
    return rows.join(small(first.select("key").distinct()), "key", "left_semi")


def _features(rows: DataFrame, stems: dict[str, float], keep: list[str]) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grammar = Grammar(stems)
        for frame in frames:
            x = np.array([grammar.features(t) for t in frame["text"]], dtype=float).reshape(-1, len(NAMES))
            yield frame[keep].assign(**{name: x[:, i] for i, name in enumerate(NAMES)})

    return rows.select(*keep, "text").mapInPandas(read, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + "".join(f", {name} double" for name in NAMES))


def _inputs() -> list:
    return [F.log1p("high"), F.log1p("total"), F.log1p("share"), *map(F.col, NAMES[3:])]


def fit(labelled: DataFrame) -> tuple[dict[str, float], list[float]]:
    """Stems, and the logistic function's constant and weights, from rows of key, text, toxic."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    labelled = labelled.where(F.col("toxic").isNotNull())
    many = labelled.count()
    if many > MOST_LABELLED:
        labelled = labelled.where(F.pmod(F.xxhash64("key", F.lit("labelled")), F.lit(1 << 20)) < (1 << 20) * MOST_LABELLED // many)
    rows = _signed(labelled.where(F.col("toxic").isin(0, 1)).select("key", F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic")))
    rows = materialize(rows.dropDuplicates(["key"]).withColumn("part", F.pmod(F.col("key"), F.lit(4))), "labelled")
    stems = learn_stems(rows.where("part > 0"))
    points = materialize(_features(rows.where("part = 0"), stems, ["toxic"]), "points")
    if points.select("toxic").distinct().count() < 2:  # nothing to tell apart: hostile at a clause of the least odds
        return stems, [-math.log1p(LEAST_ODDS) * 4, 4.0, *[0.0] * (len(NAMES) - 1)]
    model = LogisticRegression(featuresCol="x", labelCol="y", regParam=1e-3, maxIter=50).fit(points.select(array_to_vector(F.array(*_inputs())).alias("x"), F.col("toxic").cast("double").alias("y")))
    return stems, [float(model.intercept), *map(float, model.coefficients)]


def scores(docs: DataFrame, model: tuple[dict[str, float], list[float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, score (0 to 1), predicted of each row; a null text is empty, an empty one scores as a text without hostile stems."""
    stems, (constant, *weights) = model
    found = _features(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), stems, ["id"])
    z = F.lit(constant)
    for w, x in zip(weights, _inputs(), strict=True):
        z = z + F.lit(w) * x
    rows = found.select(F.col("id").alias(id_col), (1 / (1 + F.exp(-z))).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(id_col: str = "doc_id"):
    """Rows that learning never sees: crc32 of the id as text divisible by five (a null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, held_out, score, predicted of each row. labels: id_col, toxic (of several the highest).

    A null text is empty; an empty one scores as a text without hostile stems;
    rows that repeat are all returned, equal texts with equal scores; a score of
    0.5 is predicted 1; a text of any length is read to its end; an empty table
    gives an empty table.
    """
    known = small(labels.select(F.col(id_col).alias("__id"), F.col("toxic").alias("__toxic")).where("__toxic IS NOT NULL").groupBy("__id").agg(F.max("__toxic").alias("__toxic")))
    train = docs.where(~held_out(id_col)).join(known, F.col(id_col) == F.col("__id")).select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"), F.col("__toxic").alias("toxic"))
    out = scores(docs, fit(train), id_col, text_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "score", "predicted")
