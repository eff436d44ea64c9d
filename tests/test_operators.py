"""Small hand-made tables: the traps, the gates, and properties."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossworks.functions import common, text
from glossworks.operators import augment, batches, frames, gloss, jobs, review, segments, similarity, training, variants, vocab
from glossworks.sources import io
from glossworks.streaming import live

SUBS = "videoId string, sentenceId long, sentenceText string, videoFileName string, language string, source string, seq long"
DECS = "videoId string, decision string, videoFileName string, info string, seq long"


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.fixture(scope="module")
def subs(spark):
    return spark.createDataFrame([("v1", 1, "Hello", "a_1.mp4", "en", "submission", 1), ("v2", 1, "hello", "a-02_1.mp4", "en", "submission", 2), ("v3", 2, "x", "a_2.mp4", None, "submission", 3), ("v1", 1, "Hello", "a_1.mp4", "en", "submission", 4), (None, 3, "x", "a_3.mp4", "en", "submission", 5), ("g1", 1, "Hello", "a_9.mp4", "en", "generated", 6)], SUBS)


@pytest.fixture(scope="module")
def decs(spark):
    return spark.createDataFrame([("v1", "approved", None, "a_1.mp4", 1), ("v1", "rejected", None, "a_1.mp4", 2), ("v2", "rejected", "a-02_1.mp4", None, 3), ("v2", "approved", "a-02_1.mp4", "", 4), ("v9", "approved", "z.mp4", None, 5), (None, "approved", None, None, 6), ("v3", "odd", None, None, 7)], DECS)


def test_three_meanings_of_approved(subs, decs):
    status = {(r.videoId, r.seq): r.status for r in review.review_status(subs, decs).collect()}
    assert status == {("v1", 1): "rejected", ("v1", 4): "rejected", ("v2", 2): "approved", ("v3", 3): "pending", (None, 5): "pending"}
    assert rows(review.approved_ids(decs)) == ["('v1',)", "('v2',)", "('v9',)"]
    assert rows(review.approved_files(decs, "info")) == ["('a-02_1.mp4',)", "('a_1.mp4',)", "('z.mp4',)"]
    batch = subs.sparkSession.createDataFrame([(1, "one"), (2, "two"), (7, "none")], "id long, text string")
    got = review.batch_progress(batch, subs, decs).first()
    assert (got.recorded, got.approved, got.rejected, got.pending_recording, got.pending_review) == (4, 2, 2, 1, 0)


def test_a_batch_prefix_ends_at_the_underscore(subs, decs):
    assert review.review_status(subs, decs, "a").count() == 4 and review.review_status(subs, decs, "a-02").count() == 1


def test_sentences_without_recordings_count_zero(spark, subs, decs):
    batch = spark.createDataFrame([(1, "one"), (7, "none")], "id long, text string")
    assert rows(review.sentence_progress(batch, subs, decs)) == ["(1, 'one', 3, 1, 2, 0)", "(7, 'none', 0, 0, 0, 0)"]


def test_results_dont_depend_on_partitions(subs, decs):
    assert rows(review.review_status(subs.repartition(7), decs.repartition(3))) == rows(review.review_status(subs.coalesce(1), decs.coalesce(1)))


def test_appending_twice_adds_nothing(spark):
    new, old = spark.createDataFrame([("a",), ("b",), ("b",)], "videoId string"), spark.createDataFrame([("a",)], "videoId string")
    first = common.new_rows_only(new, old, ["videoId"])
    assert rows(first) == ["('b',)"] and common.new_rows_only(new, old.unionByName(first), ["videoId"]).count() == 0


def test_jsonl(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\nnot json\n{"a": "odd"}\n{"b": 2}\n')
    good, bad = io.read_jsonl(spark, str(tmp_path / "x.jsonl"), T.StructType([T.StructField("a", T.LongType())]))
    assert rows(good) == ["(1,)", "(None,)"] and bad.count() == 2
    none, _ = io.read_jsonl(spark, str(tmp_path / "missing.jsonl"), T.StructType([T.StructField("a", T.LongType())]))
    assert none.count() == 0 and none.columns == ["a"]


def test_readers_and_writers(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1)], "k string, n int")
    io.write_csv(df, str(tmp_path / "c"), ["n", "k"])
    assert io.read_csv(spark, str(tmp_path / "c"), T.StructType([T.StructField("n", T.IntegerType()), T.StructField("k", T.StringType())])).count() == 2
    (tmp_path / "m.json").write_text('{"one": ["A", "B"], "two": []}')
    assert rows(io.read_json_map(spark, str(tmp_path / "m.json"), "array<string>")) == ["('one', ['A', 'B'])", "('two', [])"]
    (tmp_path / "a.json").write_text('[{"n": 1},\n {"n": 2}]')
    assert io.read_json_array(spark, str(tmp_path / "a.json"), T.StructType([T.StructField("n", T.LongType())])).count() == 2
    io.write_jsonl(df, str(tmp_path / "j"))
    io.write_lines(df, str(tmp_path / "l"), "k")
    (tmp_path / "v").mkdir()
    (tmp_path / "v" / "a.b.mp4").write_bytes(b"x")
    (tmp_path / "v" / "empty.mp4").write_bytes(b"")
    assert [(r.name, r.stem, r.dir, r.length) for r in io.file_inventory(spark, str(tmp_path / "v"), "*.mp4").collect()] == [("a.b.mp4", "a.b", "v", 1)]


def test_text_functions(spark):
    one = lambda s, f: spark.createDataFrame([(s,)], "s string").select(f(F.col("s"))).first()[0]
    assert one("WE'LL didn't I’ve it‘s", text.expand_contractions) == "WE will did not I have it is"
    assert [one(x, text.clean_id) for x in (None, "NaN", "123.0", "12.5", "")] == ["", "", "123", "12.5", ""]
    assert [one(x, text.text_type) for x in ("word", "two words", "end.\n", "")] == ["word", "sentence", "sentence", "word"]
    assert one(" A_b ", text.gloss_key) == "a b" and one("is it ?! ", text.sentence_key) == "is it"


def test_clauses_are_packed(spark):
    long = "one two three four five six, seven eight nine ten eleven twelve; thirteen, " + " ".join(["w"] * 14)
    got = text.pack_clauses(spark.createDataFrame([(1, long), (2, "short, one"), (3, "")], "id int, sentence string"), ["id"]).collect()
    assert [(r.clause_pos, len(r.clause.split())) for r in got if r.id == 1] == [(0, 12), (1, 1), (2, 14)]
    assert [r.clause for r in got if r.id == 2] == ["short, one"] and not [r for r in got if r.id == 3]


def test_the_longest_phrase_wins(spark):
    phrases = spark.createDataFrame([("new york",), ("new york city",), ("new",)], "phrase string")
    got = gloss.tokenize_with_phrases(spark.createDataFrame([(1, "In New York City, new York!"), (2, "new")], "id int, sentence string"), ["id"], phrases).orderBy("id", "pos").collect()
    assert [(r.id, r.pos, r.token) for r in got] == [(1, 0, "in"), (1, 1, "new york city"), (1, 4, "new york"), (2, 0, "new")]


def test_phrases_of_rows_without_a_key(spark):
    phrases = spark.createDataFrame([("ice cream",)], "phrase string")
    got = gloss.tokenize_with_phrases(spark.createDataFrame([(None, "Ice cream now"), (1, "ice")], "id int, sentence string"), ["id"], phrases)
    assert rows(got) == ["(1, 0, 'ice')", "(None, 0, 'ice cream')", "(None, 2, 'now')"]


def test_a_report_keeps_what_was_nearly_found(spark):
    tokens = spark.createDataFrame([("go", "f", "I’d go…", 1), ("gone", "f", "x", 2)], "token string, file string, sentence string, seq int")
    found = spark.createDataFrame([("go", "semantic", 0.8, "went"), ("gone", "semantic", 0.513, "went")], "token string, match_type string, confidence double, matched_to string")
    report = {r.word: r for r in gloss.match_report(tokens, found, spark.createDataFrame([("went", "r", "g")], "word string, ref string, gloss string")).collect()}
    assert (report["go"].status, report["go"].source_sentence, report["go"].ref) == ("matched", "I'd go...", "r")
    assert (report["gone"].status, report["gone"].confidence, report["gone"].matched_to) == ("unmatched", 0.51, "")


def test_a_sentence_equal_to_a_word_is_left_out(spark):
    g = spark.createDataFrame([("s1", "HELLO", 1), ("s2", "Hello", 2)], "sentence string, gloss string, seq long")
    s = spark.createDataFrame([("hello", 1), ("Hello", 2), (" s1 ", 3), ("", 4)], "text string, seq long")
    assert sorted((r.text, r.type, r.origin_sentence) for r in batches.build_batch(g, s, "b").collect()) == [("Hello", "sentence", "Hello"), ("hello", "word", "s1"), ("s1", "sentence", "s1")]


def test_ingest_gate(spark):
    files, texts = spark.createDataFrame([("x_1.mp4",), ("odd.mp4",)], "name string"), spark.createDataFrame([(1, "one")], "id long, text string")
    with pytest.raises(ValueError, match="1 names without an id"):
        batches.append_named_files(files, texts, spark.createDataFrame([], "videoId string"), r"x_([0-9]+)", "p")


def test_padding_and_split(spark):
    current = spark.createDataFrame([("sentence_1.mp4", "Alpha")], "filename string, sentence_text string")
    sources = spark.createDataFrame([(0, 1, "G", "one", "p/word_x.mp4"), (0, 2, "G", "One", "p/a.mp4"), (1, 1, None, "ONE", "b"), (1, 2, None, "alpha", "c"), (2, 1, None, "two!.", "d"), (2, 2, None, " ", "e")], "prio int, seq int, pseudo_gloss string, text string, path string")
    pads = training.pad_to_target(current, sources, 10)
    assert sorted((r.idx, r.text) for r in pads.collect()) == [(0, "One"), (1, "two!.")]
    glosses = spark.createDataFrame([("Alpha", ["A", "L"]), ("two", ["T"])], "sentence string, glosses array<string>")
    entries = training.require_glosses(training.build_entries(current, pads, glosses))
    assert sorted((r.fileid, r.text, r.fallback) for r in entries.collect()) == [("pad_00000", "G", False), ("pad_00001", "t", False), ("sentence_1", "a l", False)]
    split = training.split_train_val_test(entries)
    assert sorted((r.split, r.is_pad) for r in split.collect()) == [("test", False), ("train", False), ("train", True), ("val", True)]
    with pytest.raises(ValueError, match="sentence_1.mp4"):
        training.require_glosses(training.build_entries(current, pads, glosses.limit(0)))


def test_candidates_are_cut_before_features_are_checked(spark):
    index = spark.createDataFrame([("t", f"c{i}", i) for i in range(6)], "token string, name string, seq int")
    got = training.resolve_resources(spark.createDataFrame([("t",), ("none",)], "token string"), index, spark.createDataFrame([("c5",)], "name string"))
    assert got.where("token = 't'").count() == 5 and got.where("has_feature").count() == 0
    counts = training.resource_counts(got).first()
    assert (counts.hits, counts.missing, counts.feature_missing) == (0, 1, 5) and training.choose_preset(training.resource_counts(got)).first().preset == "21x"


def test_recorded_counts_of_variants(spark):
    entries = spark.createDataFrame([("s1", "a b c"), ("s2", "a a"), ("s3", "one")], "fileid string, text string")
    full = variants.expand_variants(entries)
    assert full.count() == 3 * 36 and variants.expand_variants(entries, "21x").count() == 3 * 21
    assert rows(full) == rows(variants.expand_variants(entries.repartition(5)))
    none = variants.planned_variants(variants.recipe(full, spark.createDataFrame([], "category string, token string, ord int, name string")), spark.createDataFrame([], "name string, n_frames int"))
    assert none.count() == 0
    assert full.where("category LIKE 'A%'").count() == 3 * (1 + 10)
    split = training.split_variants(full)
    assert rows(split.where("split = 'val'").select("variant_id")) == rows(split.where("split = 'test'").select("variant_id")) and split.where("split = 'val'").count() == 11


def test_derangement():
    for n in range(2, 9):
        tokens = [f"t{i}" for i in range(n)]
        got = variants.derange(tokens, 1, "k")
        assert sorted(got) == sorted(tokens) and all(a != b for a, b in zip(got, tokens, strict=True)) and got == variants.derange(tokens, 1, "k")
    assert variants.derange(["a", "a", "a", "b"], 1, "k") == ["a", "a", "b", "a"]  # none exists: turned by one
    assert variants.derange(["a"], 1, "k") == ["a"] and variants.derange(["a", "a"], 1, "k") == ["a", "a"] and variants.derange([], 1, "k") == []


def test_features_in_token_order(spark):
    plan = spark.createDataFrame([("v", "B", 1, "y", "c2"), ("v", "B", 0, "x", "c1"), ("v", "B", 2, "z", None), ("w", "B", 0, "e", "c0")], "variant_id string, category string, pos int, token string, name string")
    feats = spark.createDataFrame([("c1", 2, [[1.0], [2.0]]), ("c2", 1, [[3.0]]), ("c0", 0, [])], "name string, n_frames int, feat array<array<float>>")
    got = variants.concat_features(plan, feats).collect()
    assert [(r.variant_id, r.feat, r.used) for r in got] == [("v", [[1.0], [2.0], [3.0]], ["c1", "c2"])]
    assert sorted(r.reason for r in variants.drops(plan, feats).collect()) == ["empty:e", "no_clip:z"]


def test_the_longest_stem_wins(spark):
    stems = spark.createDataFrame([("sentence_1", 0), ("sentence_10", 1), ("odd", 2), ("odd_name", 3)], "stem string, seq int")
    files = spark.createDataFrame([("aug_sentence_10.mp4",), ("cv_odd_name_x.mp4",), ("none.mp4",)], "name string")
    assert rows(segments.match_original(files, stems)) == ["('aug_sentence_10.mp4', 'sentence_10')", "('cv_odd_name_x.mp4', 'odd_name')"]
    assert rows(segments.match_original(files.limit(2), stems, "first"))[1] == "('cv_odd_name_x.mp4', 'odd')"


def test_names_as_training_clips_have_them(spark):
    """Segments named by segment_labels and training_names keep their labels; words and sentences go by what their names contain."""
    points = spark.createDataFrame([("my_long-clip", 0, "go."), ("my_long-clip", 1, "ice/cream!"), ("sentence_12", 0, "GO")], "stem string, seg int, label string")
    labels = segments.segment_labels(points)
    files = labels.select(F.concat("seg_stem", F.lit(".mp4")).alias("rel_path"), F.lit("seg_").alias("prefix"), F.lit("sentence").alias("level"))
    poses = segments.training_names(files).select(F.regexp_replace("out", r"\.mp4$", "").alias("stem"))
    more = ["aug_word_ice_cream", "cv-word_apple-2", "x_sentence_12_y", "sentence_1234", "aug_FRANCE", "word_icy", "nothing", "ab"]
    poses = poses.unionByName(spark.createDataFrame([(x,) for x in more], "stem string"))
    known = [("word_ice", ["ice"]), ("word_ice_cream", ["cream", "x"]), ("word_apple", ["apple"]), ("sentence_12", ["A", "B"]), ("FRANCE", ["France"]), ("b", ["bee"]), ("sentence_1", ["A"])]
    got = {r.stem: (r.gloss, r.how) for r in segments.single_gloss(poses, spark.createDataFrame(known, "stem string, glosses array<string>"), labels).collect()}
    assert got == {
        "seg_my_long-clip_seg000_go._sentence": ("GO", "segment"), "seg_my_long-clip_seg001_ice_cream__sentence": ("ICE/CREAM", "segment"), "seg_sentence_12_seg000_GO_sentence": ("GO", "segment"),
        "aug_word_ice_cream": ("CREAM", "word"), "cv-word_apple-2": ("APPLE", "word"), "x_sentence_12_y": (None, "sentence"), "sentence_1234": (None, "sentence"),
        "aug_FRANCE": ("France", "single"), "word_icy": (None, "unmatched"), "nothing": (None, "unmatched"), "ab": ("bee", "single"),
    }
    assert segments.label_table(segments.single_gloss(poses, spark.createDataFrame(known, "stem string, glosses array<string>"), labels))[0].count() == 7
    texts = spark.createDataFrame([("word_ice.mp4", "ice"), ("word_ice_cream.mp4", "ice cream")], "filename string, sentence_text string")
    attached = review.attach_by_stem(spark.createDataFrame([("aug_word_ice_cream.mp4",), ("aug-word_ice-2.mp4",), ("other.mp4",)], "name string"), texts)
    assert rows(attached) == ["('aug-word_ice-2.mp4', 'word_ice', 'ice')", "('aug_word_ice_cream.mp4', 'word_ice_cream', 'ice cream')", "('other.mp4', None, None)"]


def test_batches_in_name_order(spark, monkeypatch):
    monkeypatch.setattr(jobs, "BOUNDS", 7)
    names = [f"same_long_prefix_{i:03d}.mp4" for i in range(90)] + ["é.mp4", "z.mp4", "A.mp4"]
    todo = jobs.batch_todo(spark.createDataFrame([(n,) for n in names * 2], "name string"), spark.createDataFrame([(names[5],)], "name string"), 10)
    want = sorted((n for n in names if n != names[5]), key=lambda n: n.encode())
    assert {r.name: r.batch for r in todo.collect()} == {n: i // 10 + 1 for i, n in enumerate(want)}


def test_more_augmentations_than_a_thousand(spark):
    augs = spark.createDataFrame([(f"a{i:04d}", True) for i in range(1500)], "aug_name string, enabled boolean")
    plan, counts = augment.plan_augment(spark.createDataFrame([("s",)], "stem string"), augs, spark.createDataFrame([("a0003/s.mp4",)], "out string"))
    assert plan.count() == 1499 and tuple(counts.first()) == (1, 1499)
    views = spark.createDataFrame([("word_x", "yaw_1_zoom_2")], "name string, viewpoint string")
    assert augment.plan_combined(views, augs, 1200).count() == 1200


def test_clip_edges(spark):
    segs = spark.createDataFrame([("s", 0, 0.0, 1.0, "go/é."), ("s", 1, 1.0, 9.0, "b"), ("s", 2, 2.0, 2.0, "c"), ("s", 3, 9.0, 10.0, "d")], "stem string, seg int, start double, end double, label string")
    got = segments.clips(segs, spark.createDataFrame([("s", 25.0, 100)], "stem string, fps double, total_frames int")).orderBy("seg").collect()
    assert [(r.start_frame, r.end_frame, r.clip) for r in got] == [(0, 25, "s_seg000_go_é..mp4"), (25, 100, "s_seg001_b.mp4")]


def test_vocabulary_merge(spark):
    v = lambda r: spark.createDataFrame(r, "token string, id int")
    got = {r.token: r.id for r in vocab.merge_vocab(v([("<pad>", 0), ("b", 5)]), v([("<pad>", 0), ("c", 1), ("a", 2), ("b", 3)])).collect()}
    assert got == {"<blank>": 0, "b": 5, "a": 6, "c": 7}
    with pytest.raises(ValueError, match="empty"):
        vocab.merge_vocab(v([]), v([("a", 1)]))


def test_tail_cut_stops_at_the_first_good_frame(spark):
    schema = "video string, frame int, body double, lhand double, rhand double, lx double, ly double, rx double, ry double, side int"
    good, bad = (0.9, 0.9, 0.9, 0.0, 0.0, 0.0, 0.0, 100), (0.5, 0.1, 0.1, 50.0, 0.0, 50.0, 0.0, 100)
    plan = {"two": [good] * 8 + [bad] * 2, "last_good": [good] * 7 + [bad, bad, good], "short": [good] * 3, "no_pose": [good] * 9 + [(None,) * 7 + (100,)], "blind": [good, *[(None,) * 7 + (100,)] * 6, good]}
    df = spark.createDataFrame([(v, i, *f) for v, fs in plan.items() for i, f in enumerate(fs)], schema)
    ref = frames.mid_reference(df)
    assert {r.video: r.reason for r in ref.collect()} == {"two": None, "last_good": None, "short": "too_short", "no_pose": None, "blind": "no_pose_in_middle"}
    got = {r.video: (r.cut_at, r.n_drop, r.drop_frames) for r in frames.tail_cut(frames.glitch_flags(df, ref)).collect()}
    assert got == {"two": (9, 2, "9,10"), "last_good": (11, 0, ""), "no_pose": (10, 1, "10")}


def test_repeat_and_padding(spark):
    again, once = [5.0] * 20 + [0.0] * 20 + [5.0] * 20, [5.0] * 20 + [0.0] * 40
    df = spark.createDataFrame([(v, i, x) for v, xs in (("again", again), ("once", once)) for i, x in enumerate(xs)], "video string, i int, diff double")
    got = {r.video: r.cut for r in frames.repeat_cut(df).collect()}
    assert got["once"] is None and 20 <= got["again"] <= 25
    pads = frames.pad_plan(spark.createDataFrame([(3,), (19,), (20,)], "n_frames int"))
    assert [(r.n_frames, r.pad_front, r.pad_back) for r in pads.collect()] == [(3, 9, 8), (19, 5, 5), (20, 0, 0)]


def test_neighbours(spark):
    schema = "id int, vec array<float>"
    left = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None)], schema)
    right = spark.createDataFrame([(10, [2.0, 0.0]), (11, [1.0, 0.0]), (12, [0.0, 1.0]), (13, [0.0, 0.0]), (14, [1.0, 1.0])], schema)
    got = similarity.top_k_similar(left, right.repartition(4), 3, 0.5).orderBy("rank").collect()
    assert [(r.q, r.id, round(r.sim, 3)) for r in got] == [(1, 10, 1.0), (1, 11, 1.0), (1, 14, 0.707)]


def test_windows_of_kept_frames_and_their_stream(spark, tmp_path):
    schema = "session string, frame_no long, hand double, head double, vec array<double>"
    plan = {"s5": 5, "s6": 6, "s8": 8, "s9": 9}
    data = [(s, 2 * i, 0.9, 0.9, [float(i), 1.0]) for s, n in plan.items() for i in range(n)] + [(s, 2 * i + 1, 0.5, 0.9, [99.0, 9.0]) for s in plan for i in range(3)]
    df = spark.createDataFrame(data, schema)
    batch = live.session_windows(df)
    assert {r.session: r["count"] for r in batch.groupBy("session").count().collect()} == {"s6": 1, "s8": 1, "s9": 2}
    for i, part in enumerate((df.where("frame_no < 8"), df.where("frame_no >= 8"))):
        part.coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    assert rows(live.stream_windows(stream, f"{tmp_path}/out")) == rows(batch)


def test_jobs(spark):
    schema = "job_id string, video_id string, generated_video_path string, created_at int"
    old = spark.createDataFrame([("a", "A", "x", 1), ("b", "B", "y", 2)], schema)
    new = spark.createDataFrame([("b", "B2", "z", 9), ("b", "B3", "zz", 10), ("c", "C", "w", 9), ("c", "C2", "ww", 11), ("d", "D", None, 9)], schema)
    merged, counts = jobs.upsert_jobs(old, new, order=["created_at"])  # one row of an id, set by its last; a new one keeps what its first inserted
    assert rows(merged) == ["('a', 'A', 'x', 1)", "('b', 'B', 'zz', 10)", "('c', 'C', 'ww', 11)"] and tuple(counts.first()) == (1, 3, 1)
    tasks = spark.createDataFrame([(f"t{i}", "completed", i) for i in range(7)] + [("x", "running", 9)], "task_id string, status string, created_at int")
    assert rows(jobs.retention(tasks)) == ["('t0',)", "('t1',)"] and jobs.retention(tasks, 0).count() == 0
    todo = jobs.batch_todo(spark.createDataFrame([(f"f{i:02d}",) for i in range(7)], "name string"), spark.createDataFrame([("f00",)], "name string"), 4)
    assert sorted((r.batch, r.name) for r in todo.collect()) == [(1, "f01"), (1, "f02"), (1, "f03"), (1, "f04"), (2, "f05"), (2, "f06")]


def test_parameter_grid(spark):
    assert augment.param_grid(spark, {"a": [1, 2, 3], "b": list(range(10))}).count() == 30


def test_nearest_of_many_equal_vectors_are_the_least_ids(spark):
    right = spark.range(5000).select("id", F.when(F.col("id") % 1000 == 7, F.array(F.lit(1.0), F.lit(0.1))).otherwise(F.array(F.lit(1.0), F.lit(0.0))).alias("vec")).repartition(3)
    left = spark.createDataFrame([(1, [2.0, 0.0]), (2, [10.0, 1.0]), (3, [0.0, 0.0])], "id long, vec array<double>")
    got = similarity.top_k_similar(left, right, 6).collect()
    assert sorted((r.q, r["rank"], r.id) for r in got) == [*((1, i + 1, x) for i, x in enumerate([0, 1, 2, 3, 4, 5])), *((2, i + 1, x) for i, x in enumerate([7, 1007, 2007, 3007, 4007, 0]))]
    assert similarity.top_k_similar(left, right.where("id < 0"), 6).count() == 0


def test_a_map_s_sentence_of_several_entries_takes_the_least(spark):
    current = spark.createDataFrame([("sentence_1.mp4", "Go home.")], "filename string, sentence_text string")
    pads = spark.createDataFrame([], "idx int, pseudo_gloss string, text string, path string, prio int")
    glosses = spark.createDataFrame([("Go home", ["GO", "HOME"]), ("Go home!", ["AWAY"])], "sentence string, glosses array<string>")
    assert [r.text for r in training.build_entries(current, pads, glosses).collect()] == ["away"]


def test_repeated_variants_keep_their_number(spark):
    made = spark.createDataFrame([(f"v{i % 30}", "A_base") for i in range(60)], "variant_id string, category string")
    got = training.split_variants(made, frac=0.2).collect()
    count = {s: sum(r.split == s for r in got) for s in ("train", "val", "test")}
    assert count["val"] == count["test"] == 12 and count["train"] == 48


def test_second_workload_by_hand(spark):
    """Entries to variants: every choice made again row by row."""
    import hashlib

    from glossworks.plans import q_training, q_workflows

    sf = "/root/testdata/sf0.001"
    md5 = lambda *x: hashlib.md5("|".join(map(str, x)).encode()).hexdigest()
    found = q_workflows._w2(spark, sf)
    entries = [(r.fileid, (r.text or "").split()) for r in found["entries"].where("NOT is_pad AND split = 'test'").collect()]
    clips = {}
    for r in q_training._index(spark, sf).collect():
        clips.setdefault(r.token, []).append(r)
    usable = {token: [r for r in sorted(own, key=lambda r: (r.seq, r.name))[:5] if r.ok] for token, own in clips.items()}
    made, built = [], {}
    for fileid, tokens in entries:
        made += [(fileid, "A_base")] + [(f"{fileid}_a{v}", "A_shuf") for v in range(10)]
        for kind, many in (("B", 10), ("C", 15)):
            for v in range(many):
                name = f"{fileid}_{kind.lower()}v{v}"
                order = variants.derange(tokens, 0, name) if v else tokens
                for pos, token in enumerate(order):
                    if own := usable.get(token):
                        pick = own[0 if kind == "B" else int(md5(0, name, pos)[:8], 16) % len(own)]
                        if pick.n_frames > 0:
                            built[name] = kind
    made += built.items()
    first = {x for x, _ in sorted(made, key=lambda x: (md5(42, x[0]), x[0]))[: round(len(made) * 0.1)]}
    want = sorted((x, kind, split) for x, kind in made for split in (("val", "test") if x in first else ("train",)))
    assert sorted((r.variant_id, r.category, r.split) for r in found["variants"].collect()) == want
