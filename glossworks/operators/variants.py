"""Augmented variants of sentences: orders of tokens, and features joined in that order.

Everything is planned on ids (the recipe); features meet the plan last.
"""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossworks.functions.common import hash_order, materialize, small

from .training import PRESETS

#: Seeded orders that are tried for each list, and places of the lists that are worked out at a time.
TRIES, AT_ONCE = 8, 1 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each whole number of 64 bits as another that looks drawn."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _drawn(seeds: np.ndarray, step: int, numbers: np.ndarray) -> np.ndarray:
    """A number for each seed and number (a row each, or one row for all), for a step."""
    start = _mixed(seeds + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    return _mixed(start[:, None] + (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))


def _first_places(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of lists of one length (a row each) the first place of each place's value, and how often the most frequent value stands there."""
    order = np.argsort(codes, axis=1, kind="stable")
    ordered = np.take_along_axis(codes, order, 1)
    at = np.broadcast_to(np.arange(codes.shape[1]), codes.shape)
    begun = np.maximum.accumulate(np.where(np.diff(ordered, axis=1, prepend=ordered[:, :1] - 1) != 0, at, 0), axis=1)
    first = np.empty_like(order)
    np.put_along_axis(first, order, np.take_along_axis(order, begun, 1), 1)
    return first, (at - begun).max(axis=1) + 1


def _derangements(codes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """derangement() of lists of one length, a row of value codes and a seed each."""
    many, n = codes.shape
    own = np.arange(n)
    found = np.tile(own, (many, 1))
    if n < 2 or not many:
        return found
    first, most = _first_places(codes)
    found[(most < n) & (2 * most > n)] = np.roll(own, -1)
    left = np.flatnonzero(2 * most <= n)
    for step in range(TRIES):
        if not len(left):
            return found
        order = np.argsort(_drawn(seeds[left], step, own), axis=1, kind="stable")
        kept = (np.take_along_axis(first[left], order, 1) == first[left]).any(axis=1)
        found[left[~kept]] = order[~kept]
        left = left[kept]
    # places in order by value and turned by no less than the most frequent value's places, and by no more than all others
    order = np.lexsort((_drawn(seeds[left], TRIES, own), _drawn(seeds[left], TRIES + 1, first[left])), axis=1)
    turn = most[left] + (_drawn(seeds[left], TRIES + 2, own[:1])[:, 0] % (n - 2 * most[left] + 1).astype(np.uint64)).astype(np.int64)
    turned = np.empty_like(order)
    np.put_along_axis(turned, order, np.take_along_axis(order, (own + turn[:, None]) % n, 1), 1)
    found[left] = turned
    return found


def _seeds(seed: int, keys: Iterable[str]) -> np.ndarray:
    return np.frombuffer(b"".join([md5(f"{seed}|{key}".encode()).digest() for key in keys]), dtype="<u8")[::2]


def derangement(tokens: list[str], seed: int, key: str) -> list[int]:
    """A seeded order of the places in which no place keeps its value; where one token is more than half of the list there is none, and
    the list is turned by one.

    Up to TRIES orders are drawn; if each keeps a value, places are put in a drawn order by value and turned so far that none meets its own.
    Lists of one token or of equal tokens stay as they are.
    """
    codes = {t: i for i, t in enumerate(dict.fromkeys(tokens))}
    return _derangements(np.array([[codes[t] for t in tokens]], dtype=np.int64), _seeds(seed, [key]))[0].tolist()


def derange(tokens: list[str], seed: int, key: str) -> list[str]:
    """The tokens in the order of derangement()."""
    return [tokens[i] for i in derangement(tokens, seed, key)]


def _slots(preset: str) -> list[tuple[str, int, str, bool]]:
    """category, variant, the mark of its id, and whether its order is drawn."""
    n_a, n_b, n_c = PRESETS[preset]
    made = [(kind, v, f"_{kind.lower()}v{v}", v > 0) for kind, n in (("B", n_b), ("C", n_c)) for v in range(n)]
    return [("A_base", 0, "", False), *(("A_shuf", v, f"_a{v}", True) for v in range(n_a)), *made]


def _tokens(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda x: x != "")


def _ordered(rows: DataFrame, slots: list[tuple[str, int, str, bool]], seed: int) -> DataFrame:
    """rows (fileid, tokens, ...) for each slot, with variant_id, category, variant and order (of the places). A sentence goes to Python once
    for all its variants, and its other columns don't; who doesn't ask for the order draws none. Sentences are few bytes and much work, so
    they are dealt over tasks first, by number."""

    marks = [mark for _, _, mark, moved in slots if moved]
    drawn = [i for i, slot in enumerate(slots) if slot[3]]

    @F.arrow_udf("array<array<int>>")
    def orders(fileids: pa.Array, tokens: pa.Array) -> pa.Array:
        sizes = pc.list_value_length(tokens).to_numpy(zero_copy_only=False)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        codes = tokens.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        seeds = _seeds(seed, (f"{f}{m}" for f in fileids.to_pylist() for m in marks)).reshape(len(sizes), len(marks))
        starts = begins[:-1] * len(slots)  # of each row's orders, which lie one after another
        flat = np.empty(begins[-1] * len(slots), dtype=np.int32)
        for n in np.unique(sizes):
            same, step = np.flatnonzero(sizes == n), max(1, AT_ONCE // max(1, int(n) * len(slots)))
            for i in range(0, len(same), step):
                rows = same[i : i + step]
                own = codes[begins[rows, None] + np.arange(n)].astype(np.int64)
                found = np.tile(np.arange(n), (len(rows), len(slots), 1))
                found[:, drawn] = _derangements(np.repeat(own, len(marks), axis=0), seeds[rows].ravel()).reshape(len(rows), len(marks), n)
                flat[starts[rows, None] + np.arange(n * len(slots))] = found.reshape(len(rows), -1)
        ends = np.concatenate([[0], np.cumsum(np.repeat(sizes, len(slots)))]).astype(np.int32)
        return pa.ListArray.from_arrays(np.arange(len(sizes) + 1, dtype=np.int32) * len(slots), pa.ListArray.from_arrays(ends, flat))

    kinds = F.array(*[F.struct(F.lit(i).alias("slot"), F.lit(c).alias("category"), F.lit(v).alias("variant"), F.lit(m).alias("mark")) for i, (c, v, m, _) in enumerate(slots)])
    dealt = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fileid", "tokens")
    each = dealt.withColumn("__o", orders("fileid", "tokens")).select(*rows.columns, "__o", F.explode(kinds).alias("__k"))
    return each.select(F.concat("fileid", F.col("__k.mark")).alias("variant_id"), *rows.columns, F.col("__k.category").alias("category"), F.col("__k.variant").alias("variant"), F.get("__o", F.col("__k.slot")).alias("order"))


def expand_variants(entries: DataFrame, preset: str = "36x", seed: int = 0, kinds: str = "ABC") -> DataFrame:
    """variant_id, fileid, category (A_base, A_shuf, B, C), variant, tokens of the variants that are asked for (kinds: letters of A, B, C).

    Each sentence has its base, shuffled copies of it (A), and variants to be made
    of word clips (B, C) whose first keeps the order. entries: fileid, text.
    """
    rows = _ordered(entries.select("fileid", _tokens(F.col("text")).alias("tokens")), [s for s in _slots(preset) if s[0][0] in kinds], seed)
    return rows.select("variant_id", "fileid", "category", "variant", F.transform("order", lambda i: F.get("tokens", i)).alias("tokens"))


def fixed_points(entries: DataFrame, preset: str = "36x", seed: int = 0) -> DataFrame:
    """n, fixed_points: variants whose order is drawn, and those of them that keep a token in its place though all tokens differ (of two or more). entries: fileid, text."""
    rows = _ordered(entries.select("fileid", _tokens(F.col("text")).alias("tokens")), [s for s in _slots(preset) if s[3]], seed)
    same = F.exists(F.transform("order", lambda o, i: F.get("tokens", o) == F.get("tokens", i)), lambda x: x)
    return rows.agg(F.count("*").alias("n"), F.count_if(same & (F.size(F.array_distinct("tokens")) == F.size("tokens")) & (F.size("tokens") > 1)).alias("fixed_points"))


def clip_plans(entries: DataFrame, resources: DataFrame, frames: DataFrame, preset: str = "36x", seed: int = 0, kinds: str = "BC") -> DataFrame:
    """variant_id, fileid, category, clips (token, name, n_frames in the variant's order) of the variants of each sentence that are asked for
    (kinds: B, C or both).

    Distinct tokens of a sentence are joined once to their candidates; all its
    variants are then planned in its row, so that nothing of variants x tokens is
    shuffled. A token that many sentences have is dealt over tasks by the adaptive
    skew join, or its candidates are broadcast if their bytes are few. Choices are
    those of recipe(). entries: fileid (of several rows the least text counts), text; resources: category (B or C), token, ord,
    name, of usable clips only; frames: name, n_frames (a name that isn't there: null), and feat if clips shall have it: it meets each
    token of a sentence once for all variants.
    """
    own = ["feat"] if "feat" in frames.columns else []
    size = frames.groupBy("name").agg(F.max("n_frames").cast("long").alias("n_frames"), *[F.max_by(c, "n_frames").alias(c) for c in own])
    known = resources.join(size, "name", "left")
    pick = lambda kind: F.transform(F.sort_array(F.collect_list(F.when(F.col("category") == kind, F.struct("ord", "name", "n_frames", *own)))), lambda x: F.struct(*[x[c].alias(c) for c in ("name", "n_frames", *own)]))
    lists = known.groupBy("token").agg(F.slice(pick("B"), 1, 1).alias("B"), pick("C").alias("C"))  # a handful of each token
    lists = materialize(lists, "candidates")
    rows = entries.groupBy("fileid").agg(_tokens(F.min("text")).alias("tokens"))
    met = rows.select("fileid", F.explode(F.array_distinct("tokens")).alias("token")).join(small(lists), "token")
    of_row = met.groupBy("fileid").agg(F.map_from_entries(F.collect_list(F.struct("token", F.struct("B", "C")))).alias("known"))
    found = rows.join(of_row, "fileid", "left").select("fileid", "tokens", F.transform("tokens", lambda t: F.try_element_at("known", t)).alias("at"))
    each = _ordered(found, [s for s in _slots(preset) if s[0] in tuple(kinds)], seed)
    draw = lambda pos: F.conv(F.substring(hash_order(seed, F.col("variant_id"), pos), 1, 8), 16, 10).cast("long")

    def clip(i: Column, pos: Column) -> Column:
        at = F.get("at", i)
        chosen = F.when(F.col("category") == "B", F.get(at["B"], F.lit(0))).otherwise(F.get(at["C"], F.try_mod(draw(pos), F.size(at["C"])).cast("int")))
        return F.struct(F.get("tokens", i).alias("token"), *[chosen[c].alias(c) for c in ("name", "n_frames", *own)])

    return each.select("variant_id", "fileid", "category", F.transform("order", clip).alias("clips"))


def plan_rows(plans: DataFrame) -> DataFrame:
    """variant_id, category, pos, token, name: as of recipe()."""
    return plans.select("variant_id", "category", F.posexplode("clips").alias("pos", "c")).select("variant_id", "category", "pos", "c.token", "c.name")


def plan_drops(plans: DataFrame) -> DataFrame:
    """category, reason: as of drops()."""
    lost = plans.select("category", F.explode("clips").alias("c")).where("c.n_frames IS NULL OR c.n_frames = 0")
    reason = F.when(F.col("c.name").isNull(), "no_clip").when(F.col("c.n_frames").isNull(), "load_fail").otherwise("empty")
    return lost.select("category", F.concat_ws(":", reason, "c.token").alias("reason"))


def plan_variants(plans: DataFrame) -> DataFrame:
    """variant_id, category, used, n_frames: as of planned_variants()."""
    good = plans.select("variant_id", "category", F.filter("clips", lambda c: c["n_frames"] > 0).alias("good")).where("size(good) > 0")
    return good.select("variant_id", "category", F.transform("good", lambda c: c["name"]).alias("used"), F.aggregate("good", F.lit(0).cast("long"), lambda a, c: a + c["n_frames"]).alias("n_frames"))


def plan_features(plans: DataFrame) -> DataFrame:
    """variant_id, feat, used, n_frames: as of concat_features(), of plans whose clips have feat."""
    good = plans.select("variant_id", F.filter("clips", lambda c: c["n_frames"] > 0).alias("o")).where("size(o) > 0")
    return good.select("variant_id", F.flatten(F.transform("o", lambda x: x["feat"])).alias("feat"), F.transform("o", lambda x: x["name"]).alias("used")).withColumn("n_frames", F.size("feat"))


def recipe(variants: DataFrame, resources: DataFrame, seed: int = 0) -> DataFrame:
    """variant_id, category, pos, token, name (null: no candidate): the clip of each token of the B and C variants.

    resources: category (B or C), token, ord, name, of usable clips only. B takes
    the first, C one by a seeded draw.
    """
    slots = variants.where(F.col("category").isin("B", "C")).select("variant_id", "category", F.posexplode("tokens").alias("pos", "token"))
    cands = resources.groupBy("category", "token").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "name"))), lambda x: x["name"]).alias("names"))  # a handful of each token
    draw = F.conv(F.substring(hash_order(seed, F.col("variant_id"), F.col("pos")), 1, 8), 16, 10).cast("long")
    pick = F.when(F.col("category") == "B", F.lit(0)).otherwise(draw % F.size("names")).cast("int")
    return slots.join(cands, ["category", "token"], "left").select("variant_id", "category", "pos", "token", F.when(F.col("names").isNotNull(), F.get("names", pick)).alias("name"))


def drops(plan: DataFrame, frames: DataFrame) -> DataFrame:
    """reason of each token that a variant loses: no clip, or a clip without frames. frames: name, n_frames."""
    joined = plan.join(frames, "name", "left")
    reason = F.when(F.col("name").isNull(), "no_clip").when(F.col("n_frames").isNull(), "load_fail").when(F.col("n_frames") == 0, "empty")
    return joined.select("category", F.concat_ws(":", reason, "token").alias("reason"), reason.alias("r")).where("r IS NOT NULL").drop("r")


def planned_variants(plan: DataFrame, frames: DataFrame) -> DataFrame:
    """variant_id, category, used (clip names in order), n_frames; variants that lose every token are left out."""
    good = plan.join(frames.where("n_frames > 0"), "name")
    return good.groupBy("variant_id", "category").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]).alias("used"), F.sum("n_frames").alias("n_frames"))


def concat_features(plan: DataFrame, features: DataFrame) -> DataFrame:
    """variant_id, feat, n_frames, used: the clips' frames one after another in token order. features: name, n_frames, feat.

    Wide rows meet here only; popular clips are dealt over their variants by
    the adaptive skew join.
    """
    rows = plan.join(features.where("n_frames > 0"), "name")
    ordered = F.sort_array(F.collect_list(F.struct("pos", "name", "feat")))
    return rows.groupBy("variant_id").agg(ordered.alias("o")).select("variant_id", F.flatten(F.transform("o", lambda x: x["feat"])).alias("feat"), F.transform("o", lambda x: x["name"]).alias("used")).withColumn("n_frames", F.size("feat"))
