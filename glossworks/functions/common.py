"""Winners by an explicit order, rows that are new, seeded orders, names that contain others, shared tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import islice
from zlib import crc32

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _winner(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("__w"))  # partial aggregates: hot keys meet small
    return best.select(*keys, *[F.col("__w")[c].alias(c) for c in rest]).select(*df.columns)


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes first by order."""
    return _winner(df, keys, order, F.min_by)


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes last by order."""
    return _winner(df, keys, order, F.max_by)


def new_rows_only(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new whose keys aren't in existing, one for each key: appending them twice adds nothing."""
    return new.join(existing.select(*keys).distinct(), keys, "left_anti").dropDuplicates(keys)


def hash_order(seed: int | str, *cols: Column) -> Column:
    """A repeatable random order: md5 of the seed and the columns as text."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols]))


#: Buckets of a histogram, and rows of the last one that come to the driver.
BARS = 1024


def first_by_hash(df: DataFrame, key: str, n: int, seed: int | str) -> Column:
    """The condition under which a row is among df's first n by hash_order(seed, key), key; rows that repeat a key of them fulfil it too.

    The n-th row is found by counting rows in BARS equal ranges of the hash, then in
    BARS parts of the range that holds it, until few are left (six times at most).
    Nothing is sorted or shuffled but counts; who has the condition needs no join.
    """
    if n <= 0:
        return F.lit(False)
    code = hash_order(seed, F.col(key))
    keys = materialize(df.select(F.col(key).alias("k"), F.conv(F.substring(code, 1, 15), 16, 10).cast("long").alias("v")), "keys")
    low, width, left = 0, 1 << 60, n
    while True:
        step = max(1, width // BARS)
        inside = (F.col("v") >= low) & (F.col("v") < low + width)
        bars = keys.where(inside).groupBy(F.expr(f"(v - {low}L) div {step}L").alias("bar")).agg(F.count("*").alias("n")).collect()  # BARS rows at most
        held = 0
        for bar, held in sorted((r.bar, r.n) for r in bars):
            if left <= held:
                break
            left -= held
        else:
            return F.lit(True)  # fewer than n rows
        low, width = low + bar * step, step
        if held <= BARS or width == 1:
            break
    some = keys.where((F.col("v") >= low) & (F.col("v") < low + width)).groupBy(hash_order(seed, F.col("k")).alias("h"), "k").agg(F.count("*").alias("n")).collect()  # BARS rows, or those of one 60-bit code
    for h, k, many in sorted(map(tuple, some)):
        left -= many
        if left <= 0:
            break
    return (code < h) | ((code == h) & (F.col(key) <= F.lit(k)))


def ranked(df: DataFrame, order: list[str], n: int | None = None) -> DataFrame:
    """df and __rank (from 0) by order, of the first n rows: ranks within ranges of the order, and the rows of the ranges before them.

    Ranges that begin after n are left out before anything is sorted. df is written
    once, so let it be narrow. Ties of the order are ranked in any order.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "ranges")
    sizes = {r["__part"]: r.n for r in dealt.groupBy("__part").agg(F.count("*").alias("n")).collect()}  # a row for each range
    before, offsets = 0, []
    for part in sorted(sizes):
        if n is None or before < n:
            offsets.append((part, before))
        before += sizes[part]
    known = F.broadcast(df.sparkSession.createDataFrame(offsets, "__part int, __before long"))
    own = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    rows = dealt.join(known, "__part").withColumn("__rank", F.col("__before") + own - 1).drop("__part", "__before")
    return rows if n is None else rows.where(F.col("__rank") < n)


def by_null_safe(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """rows joined to other, whose keys are unique; null keys meet."""
    named = other.withColumnsRenamed({k: f"__{k}" for k in keys})
    return rows.join(named, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])).drop(*[f"__{k}" for k in keys])


def sum_before(df: DataFrame, key: str, stretch: Column, order: str, value: str, name: str = "before") -> DataFrame:
    """df and name: the sum of value over the earlier rows of its key, made within stretches and of the sums of the stretches before them, so
    that a key of very many rows is spread over tasks. Stretches follow the order."""
    rows = df.withColumn("__stretch", stretch)
    earlier = Window.partitionBy(key).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(key, "__stretch").agg(F.sum(value).alias("__s")).select(key, F.col("__stretch").alias("stretch"), F.sum("__s").over(earlier).alias("__carried"))
    within = F.sum(value).over(Window.partitionBy(key, "__stretch").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    joined = by_null_safe(rows.withColumn("__w", within).withColumnRenamed("__stretch", "stretch"), small(materialize(sums, "stretches")), [key, "stretch"])
    return joined.withColumn(name, F.coalesce("__carried", F.lit(0)) + F.coalesce("__w", F.lit(0))).drop("stretch", "__carried", "__w")


def digest(text: Column) -> Column:
    """32 bytes that stand for a text as a key: long texts are sorted and shuffled badly."""
    return F.unhex(F.sha2(text, 256))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(name: Column) -> Column:
    """A file name without its last suffix."""
    return F.regexp_replace(file_name(name), r"\.[^.]*$", "")


#: Characters of the stems of one automaton; stems and places of a shard; sampled names and stems by which shards are laid out; and
#: characters by which a place may begin a stem at all, with the most openings that are told to tasks, and that a pattern finds.
SHARD_CHARS, SHARD_NAMES, SHARD_SAMPLED, OPENING, MOST_OPENINGS, FEW_OPENINGS = 2_000_000, 200_000, 20_000, 4, 50_000, 256


def _told(chain: list[tuple[str, int]], every: bool) -> Iterator[str]:
    """Of stems that each begin with the one before: every one, or the longest of each kind (a bit)."""
    seen = 0
    for stem, bits in reversed(chain):
        if every or bits & ~seen:
            yield stem
            seen |= bits


def _scanned(stems: dict[str, int], rows: Iterable[tuple[str, str]], every: bool) -> Iterator[tuple[str, str]]:
    """Each name with stems in its text, by an automaton that reads the text once."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for stem in stems:
        machine.add_word(stem, stem)
    if len(machine):
        machine.make_automaton()
        for name, text in rows:
            at: dict[int, list[tuple[str, int]]] = {}
            for end, stem in machine.iter(text):
                at.setdefault(end - len(stem), []).append((stem, stems[stem]))
            for found in {stem for chain in at.values() for stem in _told(chain, every)}:
                yield name, found


def _framed(pairs: Iterable[tuple], columns: list[str], size: int = 20_000) -> Iterator[pd.DataFrame]:
    pairs = iter(pairs)
    while rows := list(islice(pairs, size)):
        yield pd.DataFrame(dict(zip(columns, map(list, zip(*rows, strict=True)), strict=True)))


def _sampled(df: DataFrame, n: int, *keys: str) -> tuple[DataFrame, float]:
    """About SHARD_SAMPLED of df's n rows, taken by hash, and the rows that one of them stands for."""
    share = min(1 << 20, max(1, SHARD_SAMPLED * (1 << 20) // max(1, n)))
    return df.where(F.pmod(F.xxhash64(*keys, F.lit("bounds")), F.lit(1 << 20)) < share), (1 << 20) / share


def contained(names: DataFrame, stems: DataFrame, distinct: bool = True) -> DataFrame:
    """name, stem: every stem that is a part of a name. names: name, or name and text (what is read instead of the name); stems: stem; blank stems are in no name.

    With a column kinds (bits) of stems, of those that begin at one place of a name only
    the longest of each kind come. Without distinct a pair may come for each of its places.

    Stems that begin at a place of a name are prefixes of what follows there; in order
    they stand before it, and all strings between begin with them. So stems and places are cut
    into shards by ranges of one order and read in it once, with the stems that the
    place begins with at hand. A shard is told the stems that are prefixes of its first,
    and a text of very many names has several shards, between which names are dealt.
    Places at which no stem opens lead nowhere. Few stems aren't shuffled
    at all: an automaton reads names where they lie.
    """
    every = "kinds" not in stems.columns
    bits = F.lit(0) if every else F.bit_or("kinds").cast("int")
    own = materialize(stems.where("stem <> ''").groupBy("stem").agg(bits.alias("bits")), "stems")
    rows = names.select("name", F.col("text" if "text" in names.columns else "name").alias("text")).where("name <> '' AND text <> ''")
    rows = rows.distinct() if distinct else rows
    chars, shortest, longest, n_stems = own.agg(F.sum(F.length("stem")), F.min(F.length("stem")), F.max(F.length("stem")), F.count("*")).first()
    if (chars or 0) <= SHARD_CHARS:
        few = {r.stem: r.bits for r in own.collect()}  # SHARD_CHARS characters at most

        def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            yield from _framed(_scanned(few, (pair for frame in frames for pair in zip(frame["name"], frame["text"], strict=True)), every), ["name", "stem"])

        found = rows.mapInPandas(read, "name string, stem string")
        return found.distinct() if distinct and "text" in names.columns else found
    opening = min(OPENING, shortest)
    opens = own.select(F.substring("stem", 1, opening)).distinct().limit(MOST_OPENINGS + 1).collect()
    begins = {r[0] for r in opens} if len(opens) <= MOST_OPENINGS else None  # many openings: every place leads to a shard

    few_begins = "|".join(map(re.escape, sorted(begins))) if begins is not None and len(begins) <= FEW_OPENINGS else None

    def openings(text: str) -> Iterator[int]:
        last = len(text) - shortest
        if few_begins is None:
            yield from (i for i in range(last + 1) if begins is None or text[i : i + opening] in begins)
            return
        find, i = re.compile(few_begins).search, -1  # compiled once a process
        while (met := find(text, i + 1)) and (i := met.start()) <= last:
            yield i

    def rests(name: str, text: str) -> Iterator[tuple[str, str]]:
        return ((name, text[i : i + longest]) for i in openings(text))

    def places(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _framed((x for frame in frames for pair in zip(frame["name"], frame["text"], strict=True) for x in rests(*pair)), ["name", "text"])

    # bounds: every so many rows of a sample of both, so that a text of very many names is several of them
    some, each_name = _sampled(rows, rows.count(), "name")
    some = materialize(some.mapInPandas(places, "name string, text string"), "places")
    some, each_place = _sampled(some, some.count(), "name", "text")
    few_stems, each_stem = _sampled(own, n_stems, "stem")
    weights = sorted([(r.text, each_name * each_place) for r in some.collect()] + [(r.stem, each_stem) for r in few_stems.collect()])  # about SHARD_SAMPLED of each
    bounds, held = [], 0.0
    for text, weight in weights:
        held += weight
        while held > SHARD_NAMES:
            bounds.append(text)
            held -= SHARD_NAMES

    def sent(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def each() -> Iterator[tuple[int, str, str]]:
            for frame in frames:
                for pair in zip(frame["name"], frame["text"], strict=True):
                    for name, text in rests(*pair):
                        least, most = bisect_left(bounds, text), bisect_right(bounds, text)
                        yield most if most - least < 2 else least + 1 + crc32(name.encode()) % (most - least), name, text

        yield from _framed(each(), ["shard", "name", "text"])

    def ranged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(shard=[bisect_right(bounds, x) for x in frame["text"]])

    asked = rows.mapInPandas(sent, "shard int, name string, text string").select("shard", "text", F.lit(-1).alias("bits"), "name")
    known = own.select(F.col("stem").alias("text"), "bits")
    heads = own.sparkSession.createDataFrame(list(enumerate(bounds, 1)), "shard int, first string")
    prefixes = heads.select("shard", F.explode(F.transform(F.sequence(F.lit(1), F.length("first")), lambda i: F.substring("first", F.lit(1), i))).alias("text"))
    at_hand = prefixes.join(known, "text").unionByName(known.mapInPandas(ranged, "text string, bits int, shard int"))

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def pairs() -> Iterator[tuple[str, str]]:
            chain: list[tuple[str, int]] = []
            now = None
            for frame in frames:
                for shard, text, kinds, name in zip(*(frame[c].tolist() for c in ("shard", "text", "bits", "name")), strict=True):
                    if shard != now:
                        now, chain = shard, []
                    while chain and not text.startswith(chain[-1][0]):
                        chain.pop()
                    if kinds >= 0:
                        if not chain or chain[-1][0] != text:
                            chain.append((text, kinds))
                    else:
                        for stem in _told(chain, every):
                            yield name, stem

        yield from _framed(pairs(), ["name", "stem"])

    # a stem (bits from 0) comes before the places that it begins; -1 marks these
    ordered = at_hand.select("shard", "text", "bits", F.lit(None).cast("string").alias("name")).unionByName(asked)
    ordered = ordered.repartition(len(bounds) + 1, "shard").sortWithinPartitions("shard", "text", F.desc("bits"))
    found = ordered.mapInPandas(scan, "name string, stem string")
    return found.distinct() if distinct else found


#: Measured bytes up to which a table is broadcast.
BROADCAST_BYTES = 64 << 20


def fits(df: DataFrame, limit: int | None = None) -> bool:
    """Whether df's rows, measured as JSON and eight bytes a column, are few bytes."""
    row = F.octet_length(F.to_json(F.struct(*df.columns))) + 8 * len(df.columns)
    return (df.agg(F.sum(row.cast("long"))).first()[0] or 0) <= (BROADCAST_BYTES if limit is None else limit)


def small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """df with a hint to broadcast it if it fits."""
    return F.broadcast(df) if fits(df, limit) else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one only where none is set and all runs on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.glossworks.shared.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="glossworks-")
        spark.conf.set("spark.glossworks.shared.dir", found)
    return found


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again: cuts the lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/glossworks-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
