"""Fill-in-middle transformation with a learned index of token boundaries.

A text's tokens (runs of ASCII letters, any other code point alone) begin at
boundary offsets, an increasing function of their rank. The function is learned
piece by piece: each segment is the longest stretch of boundaries that one line
passes within `error` code points, found by narrowing the cone of slopes that
still fit. What the lines miss is kept as residuals of one byte, so that a cut at
a rank is one prediction and one exact correction, and no list of tokens is kept.
Prefix, middle and suffix are then cut from the text by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How far a line may be off a boundary (residuals fit a signed byte), and the boundaries that a segment is first tried on.
ERROR, FIRST = 120, 256
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts so many stay plain, and of a hundred others so many put the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20


def boundaries(text: str) -> np.ndarray:
    """Where tokens begin, and the end: offsets in code points; n tokens have n + 1."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = ((code | 32) >= 97) & ((code | 32) <= 122) & (code < 128)
    starts = np.flatnonzero(np.concatenate([[True], ~(letter[1:] & letter[:-1])])) if len(code) else np.zeros(0, np.int64)
    return np.append(starts, len(code)).astype(np.int64)


@dataclass
class RankIndex:
    """Segments (the rank each begins at, its offset there, its slope) and a residual for every boundary."""

    ranks: np.ndarray
    offsets: np.ndarray
    slopes: np.ndarray
    residuals: np.ndarray

    @classmethod
    def fit(cls, offsets: np.ndarray, error: int = ERROR) -> RankIndex:
        """Lines through the first boundary of each segment that miss none of its boundaries by more than error."""
        ranks, slopes, at, n = [], [], 0, len(offsets)
        while at < n:
            ranks.append(at)
            end, low, high, width, slope = at + 1, -np.inf, np.inf, FIRST, 0.0
            while end < n:
                steps = np.arange(end - at, min(n, end + width) - at)
                rise = offsets[end : end + width] - offsets[at]
                lows, highs = np.maximum.accumulate((rise - error) / steps), np.minimum.accumulate((rise + error) / steps)
                lows, highs = np.maximum(lows, low), np.minimum(highs, high)
                fits = int(np.argmax(lows > highs)) if (lows > highs).any() else len(steps)
                if fits:
                    low, high, end = lows[fits - 1], highs[fits - 1], end + fits
                    slope = (low + high) / 2
                if fits < len(steps):
                    break
                width *= 2
            slopes.append(slope)
            at = end
        out = cls(np.array(ranks, np.int64), offsets[ranks], np.array(slopes, np.float64), np.zeros(0, np.int8))
        missed = offsets - out.predict(np.arange(n))
        out.residuals = missed.astype(np.int8 if np.abs(missed).max() < 128 else np.int64)
        return out

    def predict(self, rank: np.ndarray) -> np.ndarray:
        i = np.searchsorted(self.ranks, rank, side="right") - 1
        return self.offsets[i] + np.rint(self.slopes[i] * (rank - self.ranks[i])).astype(np.int64)

    def locate(self, rank) -> np.ndarray:
        """The exact offsets of boundaries: predictions and their residuals."""
        rank = np.asarray(rank, np.int64)
        return self.predict(rank) + self.residuals[rank]


def _draw(seed: int, id_col: Column, group: int) -> Column:
    """The group-th eight hexadecimal digits of the sha256 of seed:id as a number; a null id is empty."""
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(code, 8 * group - 7, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, error: int = ERROR) -> DataFrame:
    """id_col, n (tokens), form (plain, psm or spm), prefix_chars, middle_chars, segments, output of each row.

    Two draws by the id give the ranks of the cuts. A text stays plain if it is
    empty (or null), holds a mark, or its draw says so: its output is the text
    and its lengths are null. Repeated rows are all returned and equal, texts of any length are cut at any of
    their boundaries, ids alone decide the draws; an empty table gives an empty
    table. segments: how many lines the text's index has.
    """

    @F.pandas_udf("n long, first long, second long, segments long")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, one, other in batches:
            rows = []
            for text, a, b in zip(texts, one, other, strict=True):
                offsets = boundaries(text)
                n = len(offsets) - 1
                index = RankIndex.fit(offsets, error)
                first, second = index.locate(sorted((a % (n + 1), b % (n + 1))))
                rows.append((n, first, second, len(index.ranks)))
            yield pd.DataFrame(rows, columns=["n", "first", "second", "segments"])

    text, draws = F.coalesce(F.col(text_col), F.lit("")), [_draw(seed, F.col(id_col), g) for g in (1, 2, 3, 4)]
    rows = docs.select(F.col(id_col).alias("__id"), text.alias("__text"), draws[2].alias("__plain"), draws[3].alias("__order"), cut(text, draws[0], draws[1]).alias("__c"))
    marked = F.col("__text").contains(PREFIX) | F.col("__text").contains(SUFFIX) | F.col("__text").contains(MIDDLE)
    plain = (F.col("__text") == "") | marked | (F.col("__plain") % 100 >= 100 - PLAIN)
    form = F.when(plain, "plain").when(F.col("__order") % 100 < SUFFIX_FIRST, "spm").otherwise("psm")
    first, second = F.col("__c.first").cast("int"), F.col("__c.second").cast("int")
    prefix, middle = F.substring("__text", F.lit(1), first), F.substring("__text", first + 1, second - first)
    suffix = F.substring("__text", second + 1, F.length("__text") - second)
    output = F.when(F.col("form") == "plain", F.col("__text")).when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)).otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    cutting = F.col("form") != "plain"
    return rows.withColumn("form", form).select(
        F.col("__id").alias(id_col), F.col("__c.n").alias("n"), "form", F.when(cutting, F.col("__c.first")).alias("prefix_chars"), F.when(cutting, F.col("__c.second") - F.col("__c.first")).alias("middle_chars"), F.col("__c.segments").alias("segments"), output.alias("output")
    )


def restored(output: Column, form: Column) -> Column:
    """The text again. Marks can't arise where parts meet, as none of them begins within another, so each stands where it is first found."""
    p, s, m = (F.instr(output, F.lit(x)) for x in (PREFIX, SUFFIX, MIDDLE))
    part = lambda start, end: F.substring(output, start + 3, end - start - 3)
    middle = F.substring(output, m + 3, F.length(output))
    return F.when(form == "plain", output).when(form == "psm", F.concat(part(p, s), middle, part(s, m))).otherwise(F.concat(part(p, m), middle, part(s, p)))
