"""Near copies by the Jaccard similarity of word shingles, without a pair missed.

Two sets of similarity t or more share a shingle among the first n - ceil(t * n) + 1
of each under any common order, so only texts that meet at such a shingle are held
against each other: first by parities of their shingles, which differ in no more places
than the sets do, then by the whole sets. The order puts shingles last that a sample
of the texts has often; it decides how many meet, never what is found.

As only groups are wanted, texts that meet are first held against one of them.
What is then still in different groups at a shingle is compared pair by pair; where
very many are, in blocks, so that only pairs that pass leave a task. Shingles at which
the same texts meet count as one, the first of them in the order.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, most_frequent, row_key, small
from .graph import components

#: Words of a shingle and the least similarity of a link.
SHINGLE, LEAST = 5, 0.8
SEED = 42
#: One text in so many is sampled for the order, and so many of its frequent shingles come last.
SAMPLE, COMMON = 16, 50_000
#: Texts at a shingle above which they are compared in blocks, and texts of a block.
DENSE, BLOCK = 64, 512
#: Rounds of holding each text against one other at each shingle.
TURNS = 2
#: Bits of a set's parities for each of its shingles, at least.
PARITY = 2
#: Bytes, as small() measures them, up to which a side is broadcast here: the driver holds several of them in turn.
HELD = 4 << 20


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct XXH64 values of a text's word shingles; a text of fewer words is one shingle, a blank one has none."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.int64)
    size = min(shingle, len(found))
    hashed = xxhash.xxh64_intdigest
    grams = map(b" ".join, zip(*(found[i:] for i in range(size)), strict=False))
    return np.unique(np.fromiter((hashed(g, SEED) for g in grams), dtype=np.uint64, count=len(found) - size + 1).view(np.int64))


def parities(found: np.ndarray) -> np.ndarray:
    """For each of 64 * 2^k parts of the hashes whether the set has an odd number in it; halves folded by xor give those of fewer parts."""
    parts = 64
    while parts < PARITY * len(found):
        parts *= 2
    odd = np.bincount(found & (parts - 1), minlength=parts) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _common(docs: DataFrame, text_col: str, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several sampled texts have, in order, and their counts."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for text in frame["text"]:
                yield pd.DataFrame({"h": shingles(text, shingle)})

    some = docs.where(F.pmod(F.xxhash64(text_col), F.lit(SAMPLE)) == 0).select(F.col(text_col).alias("text"))
    counted = materialize(some.mapInPandas(read, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 2"), "similar-order")
    often = most_frequent(counted, COMMON).toPandas().sort_values("h")
    return often["h"].to_numpy(dtype=np.int64), often["n"].to_numpy(dtype=np.int64)


def _folded(odd: Column, size: Column) -> Column:
    """The parities in size longs: as they are, or their halves folded once (sets that may be similar are that close in size)."""
    return F.when(F.size(odd) <= size, odd).otherwise(F.zip_with(F.slice(odd, 1, size), F.slice(odd, size + 1, size), lambda x, y: x.bitwiseXOR(y)))


def _possible(pairs: DataFrame, marks: DataFrame, least: float) -> DataFrame:
    """Of the pairs a, b those that may have the similarity: sets that do differ in (1 - least) / (1 + least) of their joint size,
    and their parities in no more places."""
    both = pairs
    for x in "ab":
        both = both.join(marks.select(F.col("sid").alias(x), F.col("n").alias(f"n{x}"), F.col("odd").alias(f"odd{x}")), x)
    size = F.least(F.size("odda"), F.size("oddb"))
    differ = F.zip_with(_folded(F.col("odda"), size), _folded(F.col("oddb"), size), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(differ, F.lit(0), lambda t, x: t + x)
    return both.where(apart <= (1 - least) / (1 + least) * (F.col("na") + F.col("nb")) + 1e-9).select("a", "b")


def _dense(frame: pd.DataFrame, least: float) -> pd.DataFrame:
    """a, b of two blocks' texts (or one's, if i is j) in different groups whose sizes, places and parities allow the similarity and
    that have no earlier shingle in common (before: a text's shingles before this one), so that a pair comes once."""
    low, high = frame["i"].iloc[0], frame["j"].iloc[0]
    sides = [frame[frame["block"] == x] for x in (low, high)]
    rate, share, out = (1 - least) / (1 + least), least / (1 + least), []
    parts = [{size: (own, np.stack(own["odd"].to_list()).view(np.uint64)) for size, own in side.groupby(side["odd"].map(len))} for side in sides]
    for size, (left, x) in parts[0].items():
        for other, (right, y) in parts[1].items():
            if max(size, other) > 2 * min(size, other):
                continue
            joint = min(size, other)
            u, v = (m if m.shape[1] == joint else m[:, :joint] ^ m[:, joint:] for m in (x, y))
            sid, n, p, root, before = (left[c].to_numpy() for c in ("sid", "n", "p", "root", "before"))
            far, m, q, others, earlier = (right[c].to_numpy() for c in ("sid", "n", "p", "root", "before"))
            seen = [set(e) for e in earlier]
            for k in range(len(u)):
                fits = (others != root[k]) & (np.minimum(n[k], m) >= least * np.maximum(n[k], m) - 1e-9) & (np.minimum(n[k] - p[k], m - q) >= share * (n[k] + m) - 1e-9)
                at = np.flatnonzero(fits)
                apart = np.bitwise_count(v[at] ^ u[k]).sum(axis=1, dtype=np.int64)
                at = at[apart <= rate * (m[at] + n[k]) + 1e-9]
                out += [(min(sid[k], far[i]), max(sid[k], far[i])) for i in at if seen[i].isdisjoint(before[k])]
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Of the pairs a, b those whose sets have the similarity."""
    both = pairs.join(sets.select(F.col("sid").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("sid").alias("b"), F.col("s").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.where(shared >= least * (F.size("sa") + F.size("sb") - shared) - 1e-9).select("a", "b")


def _fingerprinted(found: np.ndarray) -> int:
    from .simhash import majority  # which names this module

    return majority(found)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, least: float = LEAST, near: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """id_col, key (row_key) and root (of its group) of each row; groups are linked over pairs of similarity least or more.

    Words are what white space separates, ASCII letters in lower case. Null and
    blank texts have no shingle and are one group. Rows that repeat are all
    returned; an empty table gives an empty table. near: gives links (a, b) among SimHash fingerprints (fp) of the
    sets; those texts are held against each other first, which changes no group.
    """
    common, often = _common(docs, text_col, shingle)

    def first(found: np.ndarray) -> np.ndarray:
        many = np.zeros(len(found), dtype=np.int64)
        if len(common):
            at = np.minimum(np.searchsorted(common, found), len(common) - 1)
            many = np.where(common[at] == found, often[at], 0)
        return found[np.lexsort((found, many))][: len(found) - math.ceil(least * len(found) - 1e-9) + 1]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingles(t, shingle) for t in frame["text"]]
            sids = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], dtype=np.uint64).view(np.int64)
            yield frame[["id", "key", "at"]].assign(sid=sids, n=np.array([len(s) for s in sets], dtype=np.int32), odd=[parities(s) for s in sets], first=[first(s) for s in sets], fp=[_fingerprinted(s) if near else 0 for s in sets])

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[["sid"]].assign(s=[shingles(t, shingle) for t in frame["text"]])

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    placed_at = texts.withColumn("at", F.monotonically_increasing_id())
    rows = materialize(placed_at.mapInPandas(read, f"id {kind}, key long, at long, sid long, n int, odd array<long>, first array<long>, fp long"), "similar-rows")

    def reaches(m: str) -> Column:
        """Whether what a set of n has from its p-th shingle on is enough for a set of m or more; else it has no link that this shingle is the first to show."""
        return F.col("n") + F.col(m) <= (1 + least) / least * (F.col("n") - F.col("p")) + 1e-6

    # one row of each distinct set meets the others
    heads = rows.groupBy("sid").agg(F.min("at").alias("at"))
    firsts = materialize(rows.join(small(heads, HELD), ["sid", "at"], "left_semi").select("sid", "n", "odd", "first", "fp"), "similar-firsts")
    met = firsts.select("sid", "n", F.posexplode("first").alias("p", "h"))
    # what a shingle's texts have in common is aggregated, so that one of very many texts is no task of its own; first the many shingles of
    # one text go, then one of those with the same texts is enough
    shared = materialize(met.groupBy("h").agg(F.min("sid").alias("a"), F.max("sid").alias("b")).where("a < b").select("h"), "similar-shared")
    met = materialize(met.join(small(shared, HELD), "h", "left_semi"), "similar-met")
    texts_of = met.groupBy("h").agg(F.min("n").alias("low"), F.min(F.struct("sid", "p"))["p"].alias("p"), F.count("*").alias("c"), F.bit_xor(F.xxhash64("sid")).alias("x"))
    one = materialize(texts_of.groupBy("c", "x").agg(F.min_by(F.struct("h", "low"), F.struct("p", "h")).alias("x1")).select("x1.*"), "similar-one")
    met = materialize(met.join(small(one, HELD), "h").where(reaches("low")).select("h", "sid", "n", "p"), "similar-met")

    def apart(at: DataFrame, roots: DataFrame | None, **sums: Column) -> DataFrame:
        """Of the rows at shingles those that may still have a link to another group there, with roots as they are now and the
        aggregates of their shingle. Each turn reads only what the one before it left."""
        if roots is not None:
            now = roots.select(F.col("node").alias("root"), F.col("root").alias("now"))
            at = materialize(at.join(small(now, HELD), "root", "left").select("h", "sid", "n", "p", F.coalesce("now", "root").alias("root")), "similar-rooted")
        found = at.groupBy("h").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.min("n").alias("low"), *[c.alias(k) for k, c in sums.items()]).where("least < most")
        return materialize(at.join(small(materialize(found.drop("least", "most"), "similar-sums"), HELD), "h").where(reaches("low")).drop("low"), "similar-apart")

    def sized(n: str, m: str) -> Column:
        return F.least(n, m) >= least * F.greatest(n, m) - 1e-9

    def may(n: str, p: str, m: str, q: str) -> Column:
        """Whether sets of n and m whose first common shingle is their p-th and q-th can have the similarity."""
        return sized(n, m) & (F.least(F.col(n) - F.col(p), F.col(m) - F.col(q)) >= least / (1 + least) * (F.col(n) + F.col(m)) - 1e-9)

    marks = firsts.select("sid", "n", "odd")

    def linked(pairs: DataFrame) -> DataFrame:
        some = materialize(pairs, "similar-pairs")
        asked = some.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
        asked = materialize(rows.select("sid", "key").join(asked, "sid").groupBy("sid").agg(F.min("key").alias("key")), "similar-asked")
        sets = texts.join(small(asked, HELD), "key").dropDuplicates(["sid"]).select("sid", "text").mapInPandas(whole, "sid long, s array<long>")
        return materialize(_verified(some, materialize(sets, "similar-sets"), least), "similar-links")

    def grown(roots: DataFrame | None, found: DataFrame) -> DataFrame:
        """The groups when these links are added to them; a group so far stands as its star."""
        stars = found if roots is None else roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(found)
        return materialize(components(stars), "similar-roots")

    roots = None
    if near is not None:
        # texts of one fingerprint against one of them, and these as the anchors link them
        alike = materialize(firsts.groupBy("fp").agg(F.min("sid").alias("sid")), "similar-fps")
        same = firsts.select("fp", F.col("sid").alias("b")).join(small(alike, HELD), "fp").select(F.col("sid").alias("a"), "b")
        pairs = near(alike.select("fp")).withColumnsRenamed({"a": "x", "b": "y"})
        for fp, c in (("x", "a"), ("y", "b")):
            pairs = pairs.join(small(alike.select(F.col("fp").alias(fp), F.col("sid").alias(c)), HELD), fp)
        pairs = same.unionByName(pairs.select("a", "b")).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        roots = grown(roots, linked(_possible(pairs, marks, least)))

    # each text against one of those that it meets, twice with another one
    at = met.withColumn("root", F.col("sid"))
    for turn in range(TURNS):
        lead = F.min(F.struct(F.xxhash64(F.lit(turn), "sid").alias("o"), "sid", "n", "root"))
        at = apart(at, roots, lead=lead)
        pairs = at.where((F.col("root") != F.col("lead.root")) & sized("n", "lead.n"))
        pairs = pairs.select(F.least("sid", "lead.sid").alias("a"), F.greatest("sid", "lead.sid").alias("b")).distinct()
        roots = grown(roots, linked(_possible(pairs, marks, least)))

    # shingles at which several groups meet
    left = apart(at.select("h", "sid", "n", "p", "root"), roots, many=F.count("*"))
    few = left.where(F.col("many") <= DENSE)
    other = few.select("h", F.col("sid").alias("b"), F.col("n").alias("m"), F.col("p").alias("q"), F.col("root").alias("rb"))
    across = few.join(other, "h").where((F.col("sid") < F.col("b")) & (F.col("root") != F.col("rb")) & may("n", "p", "m", "q")).select(F.col("sid").alias("a"), "b").distinct()
    # many meet: each pair of blocks is a group of its own
    blocks = F.ceil(F.col("many") / BLOCK).cast("int")
    dense = left.where(F.col("many") > DENSE).select("h", "sid", "n", "p", "root", blocks.alias("blocks"), F.pmod(F.xxhash64("sid"), blocks).cast("int").alias("block"))
    dense = dense.join(firsts.select("sid", "odd", "first"), "sid").withColumn("before", F.slice("first", F.lit(1), F.col("p")))
    dense = dense.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dense = dense.select("h", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"), "block", "sid", "n", "p", "root", "odd", "before")
    within = dense.groupBy("h", "i", "j").applyInPandas(lambda frame: _dense(frame, least), "a long, b long").where("a <> b")
    across = _possible(across, marks, least).unionByName(within).distinct()
    roots = grown(roots, linked(across))
    return rows.select("id", "key", "sid").join(roots.withColumnRenamed("node", "sid"), "sid", "left").select(F.col("id").alias(id_col), "key", F.coalesce("root", "sid").alias("root"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, least: float = LEAST, near: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """docs with one row of each group: the one of the least id (of several, that of the least key; a null id comes last)."""
    found = near_copies(docs, id_col, text_col, shingle, least, near)
    order = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.col("key").alias("k"))
    stay = found.groupBy("root").agg(F.min(order).alias("x")).select(F.col("x.k").alias("__key"))
    rows = docs.withColumn("__key", row_key(id_col, text_col)).join(stay, "__key", "left_semi")
    return rows.dropDuplicates(["__key"]).select(*docs.columns)
