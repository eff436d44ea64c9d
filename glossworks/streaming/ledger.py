"""A table of one row a key that grows by numbered steps, at the cost of what each step brings."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossworks.functions.common import last_wins, small
from glossworks.streaming.live import _forget

#: Rows of one part of a run, and parts of a run at most.
PART_ROWS, MOST_PARTS = 1 << 20, 1 << 14


@dataclass(frozen=True)
class Ledger:
    """A snapshot in runs: each has the rows that some steps left, in parts by the hash of the first key; of a key's rows the last step's counts.

    A step reads the rows of its own keys from the parts that may have them, and
    writes one run: its rows, with those of the last runs while these have at most
    twice as many. So there are about log2 of the rows runs, and a row is
    written again about as many times, however many steps there are. A step that
    is run again writes the same again, as it starts from the step before it, whose runs
    stay until the next. Null keys are keys.
    """

    spark: SparkSession
    path: str
    schema: str
    keys: tuple[str, ...]

    @property
    def values(self) -> list[str]:
        return [c for c in self._empty().columns if c not in self.keys]

    def _empty(self) -> DataFrame:
        return self.spark.sql("SELECT CAST(NULL AS STRING) AS x WHERE false").select(F.from_json("x", self.schema).alias("x")).select("x.*")

    def _runs(self, n: int) -> list[tuple[int, int, int]]:
        """Step, rows (at most) and parts of each run that step n left."""
        if n < 0:
            return []
        kept = self.spark.read.schema("step long, rows long, parts long").parquet(f"{self.path}/steps/{n}")
        return sorted(tuple(r) for r in kept.collect())  # log2 of the rows

    def _part(self, parts: int) -> Column:
        return F.pmod(F.xxhash64(self.keys[0]), F.lit(parts)).cast("int")

    def _read(self, runs: list[tuple[int, int, int]], ids: DataFrame | None = None) -> DataFrame:
        """Rows of the runs with __step; of ids alone, from the parts that they belong to."""
        frames, known = [self._empty().withColumn("__step", F.lit(-1).cast("long"))], {}
        for step, _, parts in runs:
            rows = self.spark.read.schema(f"{self.schema}, __part int").parquet(f"{self.path}/runs/{step}")
            if ids is not None and parts > 1:
                if parts not in known:
                    known[parts] = [r[0] for r in ids.select(self._part(parts)).distinct().collect()]  # MOST_PARTS at most
                asked = known[parts]
                rows = rows.where(F.col("__part").isin(asked)) if len(asked) < parts else rows
            frames.append(rows.drop("__part").withColumn("__step", F.lit(step).cast("long")))
        rows = reduce(DataFrame.unionByName, frames)
        if ids is None or not runs:
            return rows
        own = small(ids.select(F.col(self.keys[0]).alias("__id")).distinct())
        return rows.join(own, F.col(self.keys[0]).eqNullSafe(F.col("__id")), "left_semi")

    def rows(self, n: int, ids: DataFrame | None = None) -> DataFrame:
        """The table after step n (before the first: -1); with ids (the first key) theirs alone."""
        return last_wins(self._read(self._runs(n), ids), list(self.keys), ["__step"]).drop("__step")

    def step(self, n: int, delta: DataFrame, merge: Callable[[Column, Column], Column]) -> DataFrame:
        """Merges delta, one row a key, as step n; returns keys, before (null for a new key) and after of each.

        merge gives the new values, a struct, from those before (or null) and delta's.
        """
        keys, values = list(self.keys), self.values
        delta.select(*keys, *values).write.mode("overwrite").parquet(f"{self.path}/deltas/{n}")
        delta = self.spark.read.schema(self.schema).parquet(f"{self.path}/deltas/{n}")
        old = self.rows(n - 1, delta).select(*[F.col(k).alias(f"__{k}") for k in keys], F.struct(*values).alias("before"))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
        both = delta.select(*keys, F.struct(*values).alias("new")).join(old, same, "left").select(*keys, "before", "new")
        whole = F.struct(*values).alias("after")
        changes = both.select(*keys, "before", F.inline(F.array(merge(F.col("before"), F.col("new"))))).select(*keys, "before", whole)
        changes.write.mode("overwrite").parquet(f"{self.path}/changes/{n}")
        changes = self.spark.read.schema(changes.schema).parquet(f"{self.path}/changes/{n}")

        last = runs = self._runs(n - 1)
        rows = size = changes.count()
        taken = []
        while rows and runs and runs[-1][1] <= 2 * size:
            *runs, run = runs
            taken.append(run)
            size += run[1]
        if rows:
            parts = min(MOST_PARTS, 1 << (size // PART_ROWS).bit_length())
            own = changes.select(*keys, "after.*").withColumn("__step", F.lit(n).cast("long"))
            merged = last_wins(self._read(taken).unionByName(own), keys, ["__step"]).drop("__step").withColumn("__part", self._part(parts))
            merged.repartition(parts, "__part").write.mode("overwrite").partitionBy("__part").parquet(f"{self.path}/runs/{n}")
            runs = [*runs, (n, size, parts)]
        listed = F.array(*[F.struct(*map(F.lit, r)) for r in runs]).cast("array<struct<step:bigint,rows:bigint,parts:bigint>>")
        self.spark.range(1, numPartitions=1).select(F.inline(listed)).write.mode("overwrite").parquet(f"{self.path}/steps/{n}")

        needed = {r[0] for r in [*last, *runs]}
        gone = [r[0] for r in (self._runs(n - 2) if n > 1 else []) if r[0] not in needed]
        _forget(self.spark, f"{self.path}/deltas/{n}", f"{self.path}/changes/{n - 2}", *(f"{self.path}/runs/{r}" for r in gone), f"{self.path}/steps/{n - 3}")
        return changes
