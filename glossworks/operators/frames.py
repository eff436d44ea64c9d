"""Frame scores and timelines by window functions over stretches of a video or job, so that a very long one is spread over tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from glossworks.functions.common import by_null_safe, materialize, small, sum_before

#: Values of the order that a window sees together.
CHUNK = 4096
#: Falls and jumps from which a frame is a glitch.
BODY_DROP, HAND_DROP, HAND_LOW, WRIST_JUMP, BOTH_JUMP = 0.13, 0.50, 0.30, 0.10, 0.25
ACTIVE, QUIET, HALF_WINDOW = 2.0, 1.5, 5
SHORT_FRAMES, PAD = 20, 5
HOLD_FRAMES = 125


def _in_order(df: DataFrame, key: str, order: str) -> DataFrame:
    """df with i (from 0, in order within key) and n (rows of key). Ranks are made within stretches of CHUNK values of order, to which the
    rows of the stretches before are added, so that a key of very many rows is spread over tasks."""
    rows = df.withColumn("stretch", F.floor(F.col(order) / CHUNK))
    sizes = rows.groupBy(key, "stretch").agg(F.count("*").alias("__n"))
    all_of, before = Window.partitionBy(key), Window.partitionBy(key).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(key, "stretch", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("before"), F.sum("__n").over(all_of).alias("n"))
    rank = F.row_number().over(Window.partitionBy(key, "stretch").orderBy(order)) - 1
    joined = by_null_safe(rows.drop("i", "n").withColumn("__i", rank), small(materialize(offsets, "stretches")), [key, "stretch"])
    return joined.withColumn("i", (F.col("before") + F.col("__i")).cast("int")).drop("__i", "before", "stretch")


def _numbered(frames: DataFrame) -> DataFrame:
    """frames with i (from 0) and n."""
    return _in_order(frames, "video", "frame")


def mid_reference(frames: DataFrame) -> DataFrame:
    """video, n, r_body, r_lhand, r_rhand, r_lx, r_ly, r_rx, r_ry, side, reason: means over the middle half; frames without a pose (null body) don't count."""
    lo = F.greatest(F.lit(1), F.floor(F.col("n") / 4))
    hi = F.greatest(lo + 1, F.col("n") - F.floor(F.col("n") / 4))
    mid = (F.col("i") >= lo) & (F.col("i") < hi) & F.col("body").isNotNull()
    means = [F.avg(F.when(mid, F.col(c))).alias(f"r_{c}") for c in ("body", "lhand", "rhand", "lx", "ly", "rx", "ry")]
    ref = _numbered(frames).groupBy("video").agg(F.first("n").alias("n"), *means, F.max("side").alias("side"))
    return ref.withColumn("reason", F.when(F.col("n") < 4, "too_short").when(F.col("r_body").isNull(), "no_pose_in_middle"))


def glitch_flags(frames: DataFrame, ref: DataFrame, min_cats: int = 2) -> DataFrame:
    """video, i, n, glitch, n_categories, reasons of frames of videos with a reference; a frame without a pose is a glitch."""
    j = _numbered(frames).drop("n", "side").join(ref.where("reason IS NULL"), "video")
    drop = lambda c: F.when(F.col(f"r_{c}") > 0, (F.col(f"r_{c}") - F.col(c)) / F.col(f"r_{c}")).otherwise(F.lit(0.0))
    jump = lambda s: F.hypot(F.col(f"{s}x") - F.col(f"r_{s}x"), F.col(f"{s}y") - F.col(f"r_{s}y"))
    lost = lambda c: (drop(c) > HAND_DROP) | (F.col(c) < HAND_LOW)
    body, left, right = drop("body") > BODY_DROP, lost("lhand"), lost("rhand")
    big = lambda s, f: jump(s) > F.col("side") * f
    hand = (left & right) | (left & big("r", WRIST_JUMP)) | (right & big("l", WRIST_JUMP))
    wrist = big("l", BOTH_JUMP) & big("r", BOTH_JUMP)
    cats = body.cast("int") + hand.cast("int") + wrist.cast("int")
    named = [F.when(c, F.lit(n)) for c, n in ((body, "body_drop"), (left, "lhand_lost"), (right, "rhand_lost"), (big("l", WRIST_JUMP), "lwrist_jump"), (big("r", WRIST_JUMP), "rwrist_jump"))]
    none = F.col("body").isNull()
    return j.select("video", "i", "n", F.when(none, True).otherwise(cats >= min_cats).alias("glitch"), F.when(~none, cats).alias("n_categories"), F.when(none, "no_pose").otherwise(F.concat_ws(";", *named)).alias("reasons"))


def tail_cut(flags: DataFrame) -> DataFrame:
    """video, n, cut_at (1-based; n + 1: keep all), n_drop, drop_frames, reasons (of the last frame): the unbroken run of glitches at the end, in the tail half only."""
    tail = F.col("i") > F.floor(F.col("n") / 2)
    last_good = F.max(F.when(~F.col("glitch") | ~tail, F.col("i")))
    per = flags.groupBy("video").agg(F.first("n").alias("n"), last_good.alias("good"), F.max_by("reasons", "i").alias("reasons"))
    cut = per.withColumn("cut_at", F.col("good") + 2).withColumn("n_drop", F.col("n") + 1 - F.col("cut_at"))
    frames = F.when(F.col("n_drop") > 0, F.array_join(F.sequence(F.col("cut_at"), F.col("n")).cast("array<string>"), ",")).otherwise("")
    return cut.select("video", "n", "cut_at", "n_drop", frames.alias("drop_frames"), "reasons")


def repeat_cut(diffs: DataFrame) -> DataFrame:
    """video, n (frames), cut: where an action begins to repeat, null if none, too early (< 10) or of fewer than 20 frames. diffs: video, i, diff.

    Stretches of CHUNK frames overlap by the window of the mean, so a long video is
    smoothed by many tasks; first hits are aggregates of the smoothed frames.
    """
    rows = _in_order(diffs.select("video", F.col("i").alias("at"), "diff"), "video", "at")
    own, place = F.floor(F.col("i") / CHUNK), F.col("i") % CHUNK
    halo = F.array(own, F.when(place < HALF_WINDOW, own - 1), F.when(place >= CHUNK - HALF_WINDOW, own + 1))
    near = rows.select("video", "at", "i", "n", "diff", F.explode(F.array_distinct(F.array_compact(halo))).alias("part"))
    smooth = F.avg("diff").over(Window.partitionBy("video", "part").orderBy("i").rowsBetween(-HALF_WINDOW, HALF_WINDOW - 1))
    s = materialize(near.withColumn("s", smooth).where(F.col("part") == own).select("video", F.col("at").alias("i"), F.col("n").alias("m"), "s"), "smoothed")

    def first(known: DataFrame | None, hit: Column, name: str) -> DataFrame:
        """Of each video what is known and the first frame that hits."""
        met = s if known is None else by_null_safe(s, small(known).drop("m"), ["video"])
        kept = [] if known is None else [c for c in known.columns if c not in ("video", "m")]
        return materialize(met.groupBy("video").agg(F.max("m").alias("m"), *[F.max(c).alias(c) for c in kept], F.min(F.when(hit, F.col("i"))).alias(name)), name)

    found = first(None, F.col("s") > ACTIVE, "active")
    found = first(found, (F.col("s") < QUIET) & (F.col("i") > F.col("active")), "quiet")
    per = first(found, (F.col("s") > ACTIVE) & (F.col("i") > F.col("quiet")), "again").withColumn("n", F.col("m") + 1)
    return per.select("video", "n", F.when(F.col("again").isNotNull() & (F.col("quiet") >= 10) & (F.col("n") >= 20), F.col("quiet")).alias("cut"))


def pad_plan(videos: DataFrame, min_frames: int = SHORT_FRAMES, pad: int = PAD) -> DataFrame:
    """videos (n_frames) with pad_front, pad_back."""
    extra = F.greatest(F.lit(min_frames) - (F.col("n_frames") + 2 * pad), F.lit(0))
    short = F.col("n_frames") < min_frames
    return videos.withColumns({"pad_front": F.when(short, pad + F.floor((extra + 1) / 2)).otherwise(0).cast("int"), "pad_back": F.when(short, pad + F.floor(extra / 2)).otherwise(0).cast("int")})


def gloss_timeline(glosses: DataFrame) -> DataFrame:
    """job, pos, gloss, start, end of matched glosses (duration not null): each begins where the one before ends."""
    rows = sum_before(glosses.where("duration IS NOT NULL").select("job", "pos", "gloss", "duration"), "job", F.floor(F.col("pos") / CHUNK), "pos", "duration")
    return rows.select("job", "pos", "gloss", F.col("before").alias("start"), (F.col("before") + F.col("duration")).alias("end"))


def test_timeline(sentences: DataFrame, fps: float, hold: int = HOLD_FRAMES) -> DataFrame:
    """job, idx, start_time, end_time in seconds: clips one after another, each but the last held. sentences: job, idx, n_frames (0 or null: left out)."""
    rows = _in_order(sentences.where("n_frames > 0").select("job", "idx", "n_frames"), "job", "idx")
    rows = rows.withColumn("len", F.col("n_frames") + F.when(F.col("i") < F.col("n") - 1, hold).otherwise(0))
    rows = sum_before(rows.select("job", "idx", "len"), "job", F.floor(F.col("idx") / CHUNK), "idx", "len")
    return rows.select("job", "idx", F.round(F.col("before") / fps, 3).alias("start_time"), F.round((F.col("before") + F.col("len")) / fps, 3).alias("end_time"))


def composite_frames(sentences: DataFrame, words: DataFrame) -> DataFrame:
    """job, idx, n_frames of sentences made of word clips: the sum over those found. sentences: job, idx, glosses; words: gloss, n_frames."""
    found = sentences.select("job", "idx", F.explode("glosses").alias("gloss")).join(words, "gloss")
    return found.groupBy("job", "idx").agg(F.sum("n_frames").alias("n_frames"))


def at_time(events: DataFrame, timeline: DataFrame, slot: float = 5.0) -> DataFrame:
    """job, t, idx: the sentence that is on (start <= t < end); events without one are left out. Sentences meet events by slots of time."""
    t = timeline.select("job", "idx", "start_time", "end_time", F.explode(F.sequence(F.floor(F.col("start_time") / slot), F.floor(F.col("end_time") / slot))).alias("slot"))
    e = events.withColumn("slot", F.floor(F.col("t") / slot))
    return e.join(t, ["job", "slot"]).where("start_time <= t AND t < end_time").drop("slot", "start_time", "end_time")
