"""SimHash near-duplicates by anchor-point covering.

The anchors are the words of a product of perfect codes: two binary Golay codes
of 23 bits (covering radius 3) and a Hamming code of 15 bits (radius 1); three
bits stay outside. Two fingerprints that differ in at most t bits have a point
between them that is t/2 bits from either, and that point has an anchor within
the covering radius. So it is enough to replicate each fingerprint to every
anchor within the covering radius plus half the threshold, rounded up, and to
compare what meets at an anchor: about 16 copies for t = 2, where the plain
bound (radius plus threshold) gives 152 and no further pair.

An anchor with many fingerprints isn't compared pair by pair: its members are
dealt by the points one bit away from each, where at most 65 distinct ones can
meet, and two of them meet exactly if they differ in at most two bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import similar
from .common import materialize, row_key
from .graph import components

#: Bits that two linked fingerprints may differ in. The anchors' radius is laid out for two.
THRESHOLD = 2
SEED = 42
#: Members above which an anchor is resolved by midpoints.
DENSE = 64
#: Shingles hashed at a time within one text.
BLOCK = 1 << 16


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the 64-bit hashes, as a signed number."""
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), BLOCK):
        ones += np.unpackbits(hashes[start : start + BLOCK].astype(">i8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(hashes)).astype(np.uint8)).view(">i8")[0])


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Bits set in over half of the XXH64 values of the word shingles, as a signed 64-bit number."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    if len(found) < shingle:
        grams = iter([b" ".join(found)])
        total = 1
    else:
        grams = map(b" ".join, zip(*(found[i:] for i in range(shingle)), strict=False))
        total = len(found) - shingle + 1
    ones = np.zeros(64, dtype=np.int64)
    hashed = xxhash.xxh64_intdigest
    for start in range(0, total, BLOCK):
        size = min(BLOCK, total - start)
        block = np.fromiter((hashed(g, SEED) for _, g in zip(range(size), grams, strict=False)), dtype=">u8", count=size)
        ones += np.unpackbits(block.view(np.uint8).reshape(size, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * ones > total).astype(np.uint8)
    return int(np.packbits(bits).view(">i8")[0])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """id_col, key (row_key) and fp (long) of each row."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[["id", "key"]].assign(fp=np.array([fingerprint(t, shingle) for t in frame["text"]], dtype=np.int64))

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    return rows.mapInPandas(batches, f"id {kind}, key long, fp long").withColumnRenamed("id", id_col)


class Perfect:
    """A perfect cyclic code: for each syndrome the one nearest error and those of one bit more."""

    def __init__(self, length: int, generator: int, radius: int):
        from itertools import combinations

        self.length, degree = length, generator.bit_length() - 1
        rest = []
        for i in range(length):
            r = 1 << i
            while r.bit_length() > degree:
                r ^= generator << (r.bit_length() - 1 - degree)
            rest.append(r)
        self.rest = np.array(rest, dtype=np.int64)
        self.nearest = np.zeros(1 << degree, dtype=np.int64)
        further: list[list[int]] = [[] for _ in range(1 << degree)]
        for weight in range(radius + 2):
            for places in combinations(range(length), weight):
                error = sum(1 << p for p in places)
                syndrome = 0
                for p in places:
                    syndrome ^= rest[p]
                if weight <= radius:
                    self.nearest[syndrome] = error
                else:
                    further[syndrome].append(error)
        self.many = np.array([len(x) for x in further], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.many)[:-1]])
        self.further = np.array([e for x in further for e in x], dtype=np.int64)

    def syndromes(self, block: np.ndarray) -> np.ndarray:
        out = np.zeros(len(block), dtype=np.int64)
        for i in range(self.length):
            out ^= ((block >> i) & 1) * self.rest[i]
        return out


#: Generator polynomials of the Golay and the Hamming code (fixed values), as bits.
CODES = ((23, 0b101011100011, 3), (23, 0b101011100011, 3), (15, 0b10011, 1))


def anchors_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors within the covering radius plus one of each fingerprint: rows of fps, anchors."""
    global _codes
    if "_codes" not in globals():
        _codes = [Perfect(*c) for c in CODES]
    shift, blocks, homes, found = 0, [], [], []
    for code in _codes:
        block = (fps >> shift) & ((1 << code.length) - 1)
        syndrome = code.syndromes(block)
        blocks.append((code, shift, block, syndrome))
        homes.append((block ^ code.nearest[syndrome]) << shift)
        shift += code.length
    home = homes[0] | homes[1] | homes[2]
    rows = [np.arange(len(fps))]
    found = [home]
    for (code, at, block, syndrome), own in zip(blocks, homes, strict=True):
        many = code.many[syndrome]
        row = np.repeat(np.arange(len(fps)), many)
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        error = code.further[code.first[syndrome][row] + nth]
        rows.append(row)
        found.append((home[row] ^ own[row]) | ((block[row] ^ error) << at))
    return np.concatenate(rows), np.concatenate(found)


def _replicate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        fps = frame["fp"].to_numpy(dtype=np.int64)
        for start in range(0, len(fps), 50_000):
            part = fps[start : start + 50_000]
            rows, anchors = anchors_of(part)
            yield pd.DataFrame({"anchor": anchors, "fp": part[rows]})


def _compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by anchor. Gives (a, b): b's least linked partner within its anchor; or (a, null) for a member of a dense anchor."""

    def links(anchor: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        many = np.diff(np.r_[first, len(anchor)])
        dense = np.repeat(many > DENSE, many)
        far = fp[dense]
        anchor, fp, many = anchor[~dense], fp[~dense], many[many <= DENSE]
        left, right = [], []
        for step in range(1, int(many.max(initial=1))):
            i = np.flatnonzero(anchor[step:] == anchor[:-step])
            i = i[np.bitwise_count((fp[i] ^ fp[i + step]).view(np.uint64)) <= THRESHOLD]
            left.append(i)
            right.append(i + step)
        a, b = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (left, right))
        label = np.arange(len(fp))
        while len(a):  # the least row reachable within the anchor
            low = np.minimum(label[a], label[b])
            if (low == label[a]).all() and (low == label[b]).all():
                break
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
        own = np.flatnonzero(label != np.arange(len(fp)))
        return pd.DataFrame({"a": pd.array(np.r_[fp[label[own]], np.unique(far)], dtype="Int64"), "b": pd.array(np.r_[fp[own], np.zeros(len(np.unique(far)), dtype=np.int64)], dtype="Int64").copy()}).assign(b=lambda x: x["b"].mask(np.arange(len(x)) >= len(own)))

    held = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    dense_at: int | None = None
    for frame in frames:
        anchor = np.r_[held[0], frame["anchor"].to_numpy(dtype=np.int64)]
        fp = np.r_[held[1], frame["fp"].to_numpy(dtype=np.int64)]
        if dense_at is not None:  # an anchor whose first members went out as dense
            own = anchor == dense_at
            if own.any():
                yield pd.DataFrame({"a": pd.array(np.unique(fp[own]), dtype="Int64"), "b": pd.array([None] * len(np.unique(fp[own])), dtype="Int64")})
            anchor, fp = anchor[~own], fp[~own]
            if len(anchor):
                dense_at = None
        if not len(anchor):
            held = (anchor, fp)
            continue
        last = int(np.searchsorted(anchor, anchor[-1]))
        if len(anchor) - last > DENSE:  # its rest is still to come
            dense_at, last = int(anchor[-1]), len(anchor)
        held = (anchor[last:], fp[last:])
        if last:
            yield links(anchor[:last], fp[:last])
    if len(held[0]):
        yield links(*held)


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) that join all fingerprints within the threshold, fewer than all pairs. fps: distinct fp."""
    dealt = fps.select("fp").mapInPandas(_replicate, "anchor long, fp long")
    met = materialize(dealt.repartition("anchor").sortWithinPartitions("anchor", "fp").mapInPandas(_compare, "a long, b long"), "simhash-met")
    dense = met.where(F.col("b").isNull()).select(F.col("a").alias("fp")).distinct()
    bits = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("long") for i in range(64)])
    near = (
        dense.select("fp", F.explode(bits).alias("bit"))
        .select("fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("point"))
        .groupBy("point")
        .agg(F.collect_set("fp").alias("members"))  # at most 65 differ from a point in one bit or none
        .where(F.size("members") > 1)
        .select(F.array_min("members").alias("a"), F.explode("members").alias("b"))
        .where(F.col("a") != F.col("b"))
    )
    return met.where(F.col("b").isNotNull()).unionByName(near).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """id_col, key (row_key), fp, root (of its group: a fingerprint), component_id (least id of the group) of each row.

    Null and blank texts have fingerprint 0 and link like any other. Rows that
    repeat an id are all returned; null ids never name a component unless all
    of its ids are null. An empty table gives an empty table.
    """
    rows = materialize(with_fingerprints(docs, id_col, text_col, shingle), "simhash-rows")
    fps = materialize(rows.groupBy("fp").agg(F.min(id_col).alias("least")), "simhash-fps")
    roots = components(materialize(links(fps), "simhash-links"))
    linked = roots.join(fps.withColumnRenamed("fp", "node"), "node")
    of_root = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    grouped = linked.join(of_root, "root").select(F.col("node").alias("fp"), "root", "component_id")
    every = fps.join(grouped, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id"))
    return rows.join(materialize(every, "simhash-groups"), "fp").select(id_col, "key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, least: float | None = None) -> DataFrame:
    """docs with one row of each group: the one of the least id (of several, that of the least key; a null id comes last).

    Groups are linked over fingerprints within the threshold; with least, over texts
    that share that part of their shingles. Then what the anchors bring together is
    held against the whole sets, and as sets of similarity 0.8 differ in about ten
    bits of 64, where no covering code finds every pair with few copies, the prefix join of
    similar.py goes on from these groups and finds the other links.
    """
    if least is not None:
        return similar.keep_one(docs, id_col, text_col, shingle, least, near=links)
    found = near_duplicates(docs, id_col, text_col, shingle)
    first = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.col("key").alias("k"))
    stay = found.groupBy("root").agg(F.min(first).alias("x")).select(F.col("x.k").alias("__key"))
    rows = docs.withColumn("__key", row_key(id_col, text_col)).join(stay, "__key", "left_semi")
    return rows.dropDuplicates(["__key"]).select(*docs.columns)
