"""What several operators share: shared tables, row keys, word columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossworks.functions.common import BROADCAST_BYTES, fits, materialize, shared_dir, small

__all__ = ["BLANKS", "BLANK_CHARS", "BROADCAST_BYTES", "NOT_WORD", "ascii_lower", "fits", "materialize", "most_frequent", "row_key", "shared_dir", "small", "words"]

#: ASCII white space: space and tab to carriage return.
BLANKS = "[\\x20\\x09-\\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"
#: What separates words of ASCII letters, digits and anything beyond ASCII.
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
def most_frequent(counted: DataFrame, limit: int, n: str = "n") -> DataFrame:
    """The rows of the highest counts, at most limit of them: all beyond a count that a histogram of powers of 2^(1/16) gives."""
    step = F.floor(F.log2(F.col(n)) * 16)
    bars = counted.where(F.col(n) > 0).groupBy(step.alias("step")).agg(F.count("*").alias("rows")).orderBy(F.desc("step")).collect()  # about a thousand at most
    taken, least = 0, None
    for bar in bars:
        taken += bar["rows"]
        if taken > limit:
            break
        least = bar["step"]
    return counted.where(F.lit(False)) if least is None else counted.where((F.col(n) > 0) & (step >= least))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Rows of equal id and text are the same document wherever they are joined by this key."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column, separators: str) -> Column:
    """The words between separators; null: none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")
