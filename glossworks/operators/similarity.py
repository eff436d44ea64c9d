"""Nearest vectors by cosine, exactly, over a metric index.

The angle between vectors is a metric. An index deals all vectors to cells about
pivots and knows the least and the greatest angle of each cell's rows to its pivot, so
by the triangle inequality a query can tell from its angle to a pivot how near a
cell's rows may come. Each query first meets the nearest cells that hold k rows; the
k-th best of these bounds what is left, and only cells that may come nearer are
met next. Cells are cut into slices of bounded size and queries are packed by the
cells they visit, so both sides meet by a join on the cell, whatever its size.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from glossworks.functions.common import hash_order, materialize

#: Queries of a block, rows of a slice at most (about), cells at most, and rows that the pivots are fitted on at most (a part of all by hash).
BLOCK, SLICE, MOST_CELLS, MOST_SAMPLED = 4096, 2048, 4096, 20_000
#: Steps of the pivots' fit, and the angle that rounding may be wrong by.
STEPS, SLACK = 5, 1e-6
#: Pairs of a block and a slice that a task holds at a time (about 3 MB each at 64 dimensions), and similarities that it works out at a time.
HELD, AT_ONCE = 4, 1 << 18
#: Visits of queries to cells that a task makes at a time.
VISITS = 1 << 14


def _unit(rows) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of those that have a direction, and their places."""
    m = np.array([np.asarray(r, dtype=np.float64) for r in rows])
    if m.size == 0:
        return np.zeros((0, 1)), np.zeros(0, dtype=int)
    norms = np.sqrt((m * m).sum(axis=1))
    keep = np.flatnonzero(norms > 0)
    return m[keep] / norms[keep, None], keep


def _angles(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ pivots.T, -1.0, 1.0))


def _fitted(unit: np.ndarray, cells: int) -> np.ndarray:
    """Pivots: starts far from each other, then some steps towards the middle of what is nearest."""
    unit = np.unique(unit, axis=0)
    rng = np.random.default_rng(0)
    chosen = [int(rng.integers(len(unit)))]
    away = np.maximum(0, 1 - unit @ unit[chosen[0]])  # rounding may put a row nearer to itself than it is
    while len(chosen) < min(cells, len(unit)):
        chosen.append(int(rng.choice(len(unit), p=away / away.sum()) if away.sum() > 0 else rng.integers(len(unit))))
        away = np.minimum(away, np.maximum(0, 1 - unit @ unit[chosen[-1]]))
    pivots = unit[chosen]
    for _ in range(STEPS):
        own = (unit @ pivots.T).argmax(axis=1)
        sums = np.zeros_like(pivots)
        np.add.at(sums, own, unit)
        norms = np.sqrt((sums * sums).sum(axis=1))
        pivots = np.where(norms[:, None] > 0, sums / np.maximum(norms, 1e-12)[:, None], pivots)
    return pivots


def _candidates(sims: np.ndarray, ids: np.ndarray, k: int, min_sim: float) -> pd.DataFrame:
    """q, far (the order's key), id, sim of all that may be among a query's best k: those as near as its k-th, ties included."""
    far = -np.round(sims, 12)
    last = np.partition(far, min(k, far.shape[1]) - 1, axis=1)[:, min(k, far.shape[1]) - 1, None]
    q, at = np.nonzero((far <= last) & (sims >= min_sim))
    return pd.DataFrame({"q": q, "far": far[q, at], "id": ids[at], "sim": sims[q, at]})


def _nearest(parts: list[pd.DataFrame], k: int) -> pd.DataFrame:
    """The best k of each query; ties by id."""
    rows = pd.concat([p for p in parts if len(p)] or parts[:1], ignore_index=True).sort_values(["q", "far", "id"], ignore_index=True)
    return rows[rows.groupby("q").cumcount() < k]


def _packed(df: DataFrame, prefix: str, size: int) -> DataFrame:
    """cell, <prefix>block, <prefix>ids, <prefix>width and <prefix>unit (float64 bytes) of up to size rows of one cell; df: cell, id, vec, in the order of cell."""
    kind = df.schema["id"].dataType.simpleString()
    names = ["cell", *[prefix + x for x in ("block", "ids", "width", "unit")]]

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, ids, n, cell = [], [], 0, None

        def block() -> pd.DataFrame:
            rows = np.concatenate(held)
            return pd.DataFrame([[cell, uuid.uuid4().hex, np.concatenate(ids), rows.shape[1], rows.tobytes()]], columns=names)

        for frame in frames:
            for here, part in frame.groupby("cell", sort=False):
                for start in range(0, len(part), size):
                    some = part.iloc[start : start + size]
                    if n and (here != cell or n + len(some) > size):
                        yield block()
                        held, ids, n = [], [], 0
                    unit, keep = _unit(some["vec"])
                    cell = here
                    if len(unit):
                        held.append(unit)
                        ids.append(some["id"].to_numpy()[keep])
                        n += len(unit)
        if n:
            yield block()

    return df.select("cell", "id", "vec").mapInPandas(pack, f"cell int, {names[1]} string, {names[2]} array<{kind}>, {names[3]} int, {names[4]} binary")


def _dealt(df: DataFrame, counts: dict[int, int], size: int) -> DataFrame:
    """df (cell, id, ...) with a cell's rows together in tasks, but those of a cell of many times size rows dealt over so many tasks."""
    many = {c: n // size + 1 for c, n in counts.items() if n > size}  # a number for each large cell, MOST_CELLS at most
    slices = F.lit(1)
    if many:
        slices = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in many.items() for x in pair]), F.col("cell")), F.lit(1))
    return df.withColumn("__slice", F.pmod(F.xxhash64("id"), slices)).repartition("cell", "__slice").sortWithinPartitions("cell", "__slice").drop("__slice")


@dataclass
class VectorIndex:
    """The cells' pivots, least and greatest angles and numbers of rows (MOST_CELLS of each at most), and the table of their packed rows."""

    pivots: np.ndarray | None
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray
    blocks: DataFrame

    def _routed(self, queries: DataFrame, choose: Callable[[np.ndarray, pd.DataFrame], list[np.ndarray]]) -> DataFrame:
        """id, vec, cell: a row for each cell that choose gives a query by its angles to the pivots."""
        pivots, kinds = self.pivots, {c: queries.schema[c].dataType.simpleString() for c in ("id", "vec")}
        step = max(1, VISITS // len(self.rows))  # queries x cells at a time

        def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for start in range(0, len(frame), step):
                    some = frame.iloc[start : start + step]
                    unit, keep = _unit(some["vec"])
                    if not len(unit):
                        continue
                    some = some.iloc[keep]
                    cells = choose(_angles(unit, pivots), some) if pivots is not None else [np.zeros(1, int)] * len(some)
                    sizes = [len(c) for c in cells]
                    out = some.loc[some.index.repeat(sizes), ["id", "vec"]]
                    yield out.assign(cell=np.concatenate(cells).astype(np.int32))

        return queries.mapInPandas(route, f"id {kinds['id']}, vec {kinds['vec']}, cell int")

    def first_cells(self, queries: DataFrame, k: int) -> DataFrame:
        """The cells nearest to each query that hold k rows together."""
        rows = self.rows

        def choose(angles: np.ndarray, _: pd.DataFrame) -> list[np.ndarray]:
            order = np.argsort(angles, axis=1, kind="stable")
            need = (np.cumsum(rows[order], axis=1) < k).sum(axis=1) + 1
            return [o[:n] for o, n in zip(order, need, strict=True)]

        return self._routed(queries, choose)

    def further_cells(self, queries: DataFrame, k: int) -> DataFrame:
        """The other cells that may hold a row as near as the query's limit (an angle). queries: id, vec, limit."""
        rows, low, high = self.rows, self.low, self.high

        def choose(angles: np.ndarray, some: pd.DataFrame) -> list[np.ndarray]:
            order = np.argsort(angles, axis=1, kind="stable")
            need = (np.cumsum(rows[order], axis=1) < k).sum(axis=1) + 1
            least = np.maximum(angles - high, low - angles)
            may = (least <= some["limit"].to_numpy()[:, None] + SLACK) & (rows > 0)
            for m, o, n in zip(may, order, need, strict=True):
                m[o[:n]] = False  # met already
            return [np.flatnonzero(m) for m in may]

        return self._routed(queries, choose)

    def _met(self, visits: DataFrame, k: int, min_sim: float) -> DataFrame:
        """q, id, sim: of each query and task the best k rows of the cells it visits. visits: id, vec, cell."""
        q_type, id_type = visits.schema["id"].dataType.simpleString(), self.blocks.schema["rids"].dataType.elementType.simpleString()
        visits = materialize(visits, "visits")
        counts = {r.cell: r.n for r in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # MOST_CELLS rows at most
        asked = materialize(_packed(_dealt(visits, counts, BLOCK), "q", BLOCK), "queries")

        def near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            # a task mostly sees a block of queries with all its rows before the next: keep the best of each
            best: dict[str, tuple[np.ndarray, pd.DataFrame]] = {}
            for frame in frames:
                for row in frame.itertuples(index=False):
                    queries, vectors = (np.frombuffer(unit).reshape(-1, width) for unit, width in ((row.qunit, row.qwidth), (row.runit, row.rwidth)))
                    ids, step = np.asarray(row.rids), max(1, AT_ONCE // max(1, len(vectors)))
                    found = [_candidates(queries[i : i + step] @ vectors.T, ids, k, min_sim).assign(q=lambda x, i=i: x["q"] + i) for i in range(0, len(queries), step)]
                    names, before = best.get(row.qblock, (np.asarray(row.qids), None))
                    best[row.qblock] = names, _nearest(found if before is None else [before, *found], k)
                    if len(best) > 1:
                        done = next(iter(best))
                        if done != row.qblock:
                            names, rows = best.pop(done)
                            yield pd.DataFrame({"q": names[rows["q"]], "id": rows["id"], "sim": rows["sim"]})
            for names, rows in best.values():
                yield pd.DataFrame({"q": names[rows["q"]], "id": rows["id"], "sim": rows["sim"]})

        met = asked.join(self.blocks, "cell").select([c for c in [*asked.columns, *self.blocks.columns] if c != "cell"])
        # rows of megabytes: by Spark's own number of rows a task would hold all of its pairs at once
        conf, key = met.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
        rows = conf.get(key)
        conf.set(key, HELD)
        try:
            return materialize(met.mapInPandas(near, f"q {q_type}, id {id_type}, sim double"), "nearest")
        finally:
            conf.set(key, rows)

    def _limited(self, queries: DataFrame, found: DataFrame, k: int, min_sim: float) -> DataFrame:
        """queries (id, vec) and limit: the angle of the k-th best of found, or of min_sim if that is less."""
        own = Window.partitionBy("q").orderBy(F.desc("sim"))
        last = found.withColumn("__r", F.row_number().over(own)).where(F.col("__r") == k).select(F.col("q").alias("__q"), "sim")
        least = F.greatest(F.coalesce("sim", F.lit(-1.0)), F.lit(float(max(-1.0, min_sim))))
        return queries.join(last, F.col("id") == F.col("__q"), "left").select("id", "vec", F.acos(F.greatest(F.least(least, F.lit(1.0)), F.lit(-1.0))).alias("limit"))

    def top_k(self, queries: DataFrame, k: int, min_sim: float = -1.0) -> DataFrame:
        """q, id, sim, rank of the k nearest rows of each query (id, vec) with at least min_sim; ties by id; see top_k_similar."""
        queries = queries.select("id", "vec").where("vec IS NOT NULL")
        found = self._met(self.first_cells(queries, k), k, min_sim)
        if self.pivots is not None:
            further = self.further_cells(self._limited(queries, found, k, min_sim), k)
            found = found.unionByName(self._met(further, k, min_sim))
        rank = F.row_number().over(Window.partitionBy("q").orderBy(F.round("sim", 12).desc(), "id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    def pairs(self, queries: DataFrame, k: int, min_sim: float = -1.0) -> tuple[int, int]:
        """How many pairs top_k works out, and how many there are."""
        queries = queries.select("id", "vec").where("vec IS NOT NULL")
        first = materialize(self.first_cells(queries, k), "visits")
        visits = first
        if self.pivots is not None:
            visits = first.unionByName(self.further_cells(self._limited(queries, self._met(first, k, min_sim), k, min_sim), k))
        rows = self.rows
        return sum(r.n * int(rows[r.cell]) for r in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()), queries.count() * int(rows.sum())


def build_index(df: DataFrame, cells: int | None = None) -> VectorIndex:
    """The index of all rows (id, vec); zero and null vectors are left out. cells: null takes half the root of the rows, MOST_CELLS at most.

    Pivots are fitted on the driver, on at most about MOST_SAMPLED rows taken by hash; every row is dealt to its nearest pivot.
    """
    df = df.select("id", "vec").where("vec IS NOT NULL")
    n = df.count()
    cells = min(MOST_CELLS, max(1, int(n**0.5 / 2) if cells is None else cells))
    pivots = None
    if cells > 1:
        sample = df.where(F.pmod(F.xxhash64("id", F.lit("pivots")), F.lit(1 << 20)) < (1 << 20) * MOST_SAMPLED // n) if n > MOST_SAMPLED else df
        unit = _unit([r.vec for r in sample.select("vec").collect()])[0]
        pivots = _fitted(unit, cells) if len(unit) > 1 else None
    if pivots is None:
        rows = df.withColumn("cell", F.lit(0))
        blocks = materialize(_packed(_dealt(rows, {0: n}, SLICE), "r", SLICE), "vectors")
        return VectorIndex(None, np.zeros(1), np.full(1, np.pi), np.array([n]), blocks)
    kinds = {c: df.schema[c].dataType.simpleString() for c in ("id", "vec")}

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), 256):
                unit, keep = _unit(frame["vec"].iloc[start : start + 256])
                if len(unit):
                    angles = _angles(unit, pivots)
                    yield frame.iloc[start : start + 256].iloc[keep].assign(cell=angles.argmin(axis=1).astype(np.int32), angle=angles.min(axis=1))

    dealt = materialize(df.mapInPandas(assign, f"id {kinds['id']}, vec {kinds['vec']}, cell int, angle double"), "assigned")
    low, high, rows = np.zeros(len(pivots)), np.full(len(pivots), -1.0), np.zeros(len(pivots), dtype=np.int64)
    for r in dealt.groupBy("cell").agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.count("*").alias("n")).collect():  # MOST_CELLS rows at most
        low[r.cell], high[r.cell], rows[r.cell] = r.low, r.high, r.n
    counts = {c: int(x) for c, x in enumerate(rows)}
    return VectorIndex(pivots, low, high, rows, materialize(_packed(_dealt(dealt, counts, SLICE), "r", SLICE), "vectors"))


def top_k_similar(left: DataFrame, right: DataFrame, k: int, min_sim: float = -1.0, cells: int | None = None) -> DataFrame:
    """q, id, sim, rank: for each query of left (id, vec) the k nearest rows of right (id, vec) with at least min_sim; ties by id.

    Zero and null vectors are left out on both sides, ids of left are distinct. Exact: cells are left out only where the triangle inequality
    proves that no row of theirs is among the k.
    """
    return build_index(right, cells).top_k(left, k, min_sim)


def search(queries: DataFrame, corpus: DataFrame, k: int = 50, seed: int = 0) -> DataFrame:
    """q, id, score (four digits), rank: k (1 to 200) of the 3 k nearest texts longer than five characters, drawn in seeded order, best first."""
    k = min(200, max(1, k))
    pool = top_k_similar(queries, corpus.where(F.length(F.trim("text")) > 5), 3 * k)
    drawn = pool.withColumn("__d", F.row_number().over(Window.partitionBy("q").orderBy(hash_order(seed, F.col("q"), F.col("id"))))).where(F.col("__d") <= k)
    best = F.row_number().over(Window.partitionBy("q").orderBy("rank"))
    return drawn.withColumn("rank", best).select("q", "id", F.round("sim", 4).alias("score"), "rank")


def match_clips(glosses: DataFrame, index: DataFrame, lemmas: DataFrame, near: DataFrame | None = None, threshold: float = 0.7) -> DataFrame:
    """job, pos, gloss, path, match_type, score: the gloss itself (1.0), its lemma (0.9), the nearest entry (three digits), or none.

    index: gloss, path; lemmas: word, lemma; near: gloss, neighbour, sim.
    """
    entries = index.groupBy(F.lower("gloss").alias("k")).agg(F.min("path").alias("path"))
    g = glosses.withColumn("k", F.lower("gloss")).join(lemmas.groupBy(F.lower("word").alias("k")).agg(F.min(F.lower("lemma")).alias("lemma")), "k", "left")
    g = g.join(entries.withColumnRenamed("path", "p1"), "k", "left").join(entries.select(F.col("k").alias("lemma"), F.col("path").alias("p2")), "lemma", "left")
    if near is None:
        g = g.withColumns({"p3": F.lit(None).cast("string"), "sim": F.lit(None).cast("double")})
    else:
        best = near.where(F.col("sim") >= threshold).groupBy(F.lower("gloss").alias("k")).agg(F.max_by(F.lower("neighbour"), F.struct("sim", "neighbour")).alias("nb"), F.max("sim").alias("sim"))
        g = g.join(best, "k", "left").join(entries.select(F.col("k").alias("nb"), F.col("path").alias("p3")), "nb", "left")
    kind = F.when(F.col("p1").isNotNull(), "exact").when(F.col("p2").isNotNull(), "lemma").when(F.col("p3").isNotNull(), "semantic").otherwise("none")
    score = F.when(F.col("p1").isNotNull(), 1.0).when(F.col("p2").isNotNull(), 0.9).when(F.col("p3").isNotNull(), F.round("sim", 3)).otherwise(0.0)
    return g.select("job", "pos", "gloss", F.coalesce("p1", "p2", "p3").alias("path"), kind.alias("match_type"), score.alias("score"))


def nearest_prototype(windows: DataFrame, prototypes: DataFrame) -> DataFrame:
    """id, token, score of the nearest prototype of each window; ties by proto_id. windows: id, vec; prototypes: proto_id, vec, token."""
    best = build_index(prototypes.select(F.col("proto_id").alias("id"), "vec"), cells=1).top_k(windows, 1)
    return best.join(prototypes.select(F.col("proto_id").alias("__p"), "token"), F.col("id") == F.col("__p")).select(F.col("q").alias("id"), "token", F.col("sim").alias("score"))
