"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Weights are whole numbers. With W their sum (divided, as they are, by their
greatest common divisor), block k of a source of weight w is released at slot
floor(k*W/w) and due by ceil((k+1)*W/w); earliest deadline first gives every slot
to a released block, so that before any slot each source is less than one block
off its target. After W slots every source is exactly on target, so W slots are
worked out and repeated for ever without an error that grows: a block's slot
follows from its number alone, and no task sees a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, small

BLOCK = 8
#: Slots that are worked out at most, and at a time. Weights that need more don't get a plan (they are better rounded by who sets them).
MOST_SLOTS, CHUNK = 1 << 21, 1024
#: Default weights are parts of so many.
PARTS = 4096
#: Sources are dealt in this many parts of equal hash prefix (16 ** PREFIX) for numbering.
PREFIX = 3


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def default_weights(counts: DataFrame) -> DataFrame:
    """source, n -> source, weight: the root of each source's rows, so that large sources weigh less than they fill, as a whole number of
    PARTS of all roots and 1 at least. They sum to PARTS and one for each source at most, however many rows there are."""
    root = F.floor(F.sqrt(F.col("n").cast("double")) * 1024).cast("long")
    every = counts.agg(F.sum(root).alias("every"))
    weight = F.greatest(F.expr(f"__root * {PARTS} div every"), F.lit(1))
    return counts.select("source", root.alias("__root")).join(F.broadcast(every)).select("source", weight.cast("long").alias("weight"))


def shares(weights: DataFrame) -> DataFrame:
    """One row: D and sources, an array of (source, share): the weights above 0 by their greatest common divisor, in order of name, and their sum."""
    whole = weights.where("weight > 0").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("source", F.lit("")).alias("name"), "source", F.col("weight").cast("long").alias("weight")))).alias("w"))

    def gcd(a: Column, b: Column) -> Column:
        """Euclid's steps; 64-bit numbers need fewer than 92."""
        turned = F.aggregate(F.sequence(F.lit(1), F.lit(92)), F.struct(a.alias("a"), b.alias("b")), lambda s, _: F.when(s["b"] == 0, s).otherwise(F.struct(s["b"].alias("a"), F.pmod(s["a"], F.greatest(s["b"], F.lit(1))).alias("b"))))
        return turned["a"]

    divisor = F.aggregate("w", F.lit(0).cast("long"), lambda a, x: gcd(x["weight"], a))
    known = whole.select("w", F.greatest(divisor, F.lit(1)).alias("g"))
    parts = F.transform("w", lambda x: F.struct(x["source"].alias("source"), _div(x["weight"], F.col("g")).alias("share")))
    return known.select(parts.alias("sources")).select(F.aggregate("sources", F.lit(0).cast("long"), lambda a, x: a + x["share"]).alias("D"), "sources")


def template(plan: DataFrame) -> DataFrame:
    """D, source, share, nth, at: the slot of each block of the first D slots, by earliest deadline first; ties by the order of names."""

    def jobs(taken):
        def job(s, i):
            k = F.element_at(taken, (i + 1).cast("int"))
            due = _div((k + 1) * F.col("D") + s["share"] - 1, s["share"])
            return F.struct(due.alias("due"), i.alias("i"), _div(k * F.col("D"), s["share"]).alias("release"), k.alias("k"))

        return F.transform("sources", job)

    def slot(state, t):
        ready = F.array_min(F.filter(jobs(state["taken"]), lambda j: j["release"] <= t))
        return F.element_at(
            F.transform(
                F.array(ready),
                lambda j: F.struct(
                    F.transform(state["taken"], lambda k, i: k + F.when(i == j["i"], 1).otherwise(0).cast("long")).alias("taken"),
                    F.concat(state["out"], F.array(F.struct(t.alias("at"), j["i"].alias("i"), j["k"].alias("nth")))).alias("out"),
                ),
            ),
            1,
        )

    none = F.array().cast("array<struct<at:bigint,i:int,nth:bigint>>")

    def chunk(state, c):
        """CHUNK slots, so that what is appended to stays short."""
        start = F.struct(state["taken"].alias("taken"), none.alias("out"))
        ran = F.aggregate(F.sequence(c * CHUNK, F.least((c + 1) * CHUNK, F.col("D")) - 1), start, slot)
        return F.element_at(F.transform(F.array(ran), lambda r: F.struct(r["taken"].alias("taken"), F.concat(state["done"], F.array(r["out"])).alias("done"))), 1)

    start = F.struct(F.transform("sources", lambda s: F.lit(0).cast("long")).alias("taken"), F.array().cast("array<array<struct<at:bigint,i:int,nth:bigint>>>").alias("done"))
    fits = F.when(F.col("D") <= MOST_SLOTS, F.col("D")).otherwise(F.raise_error(F.concat(F.lit("the weights sum to "), F.col("D").cast("string"), F.lit(f" by their greatest common divisor, more than {MOST_SLOTS}"))).cast("long"))
    chunks = F.sequence(F.lit(0).cast("long"), _div(F.col("D") - 1, F.lit(CHUNK).cast("long")))
    plan = materialize(plan.withColumn("D", fits), "plan")  # one row; else its expressions would be worked out again in every slot
    ran = plan.where(F.size("sources") > 0).select("D", "sources", F.aggregate(chunks, start, chunk, lambda s: s["done"]).alias("done"))
    each = ran.select("D", "sources", F.explode("done").alias("out")).select("D", "sources", F.inline("out"))
    return each.select("D", F.element_at("sources", F.col("i") + 1).alias("s"), "nth", "at").select("D", "s.source", "s.share", "nth", "at")


def numbered(docs: DataFrame, id_col: str, source_col: str) -> DataFrame:
    """docs and __rn: from 0 within a source, in the order of md5(id), id. A hot source is numbered in 16 ** PREFIX parts."""
    code = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.withColumn("__md5", code).withColumn("__part", F.substring("__md5", 1, PREFIX))
    sizes = rows.groupBy(F.col(source_col).alias("__source"), F.col("__part").alias("__p")).agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__source").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"), "offsets")
    own = Window.partitionBy(source_col, "__part").orderBy("__md5", id_col)
    rows = rows.withColumn("__rn", F.row_number().over(own))
    joined = rows.join(offsets, F.col(source_col).eqNullSafe(F.col("__source")) & (F.col("__part") == F.col("__p")))
    return joined.withColumn("__rn", (F.col("__before") + F.col("__rn") - 1).cast("long")).drop("__md5", "__part", "__source", "__p", "__before")


def mix(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source", block: int = BLOCK) -> DataFrame:
    """docs with block (number within its source), release, deadline, slot, position; columns of these names give way.

    Reading by slot, then position, gives the mixture: before any slot each source
    is less than one block off its weight's part, however long it goes on. All
    rows are returned: a source that ends early leaves its later slots free, one
    without a weight (or with none above 0) has null in the added columns. A null
    source is a source of its own, null ids come in md5('') order, rows that repeat
    an id in any; an empty table gives an empty table.
    weights: source, weight (whole numbers); null: default_weights.
    """
    docs = docs.drop("block", "release", "deadline", "slot", "position")
    rows = numbered(docs, id_col, source_col)
    if weights is None:
        weights = default_weights(docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n")))
    slots = materialize(template(shares(weights)), "slots")
    of = small(slots.select(F.col("D").alias("__d"), F.col("source").alias("__src"), F.col("share").alias("__share"), F.col("nth").alias("__nth"), F.col("at").alias("__at")))
    each = small(slots.select(F.col("source").alias("__own"), F.col("share").alias("__s")).distinct())
    rows = rows.join(each, F.col(source_col).eqNullSafe(F.col("__own")), "left").withColumn("block", F.expr(f"__rn div {int(block)}"))
    rows = rows.join(of, F.col(source_col).eqNullSafe(F.col("__src")) & (F.col("block") % F.col("__s") == F.col("__nth")), "left")
    return rows.select(
        *docs.columns, "block", F.expr("block * __d div __share").alias("release"), F.expr("((block + 1) * __d + __share - 1) div __share").alias("deadline"),
        F.expr("block div __share * __d + __at").alias("slot"), (F.col("__rn") % block).alias("position"),
    )
