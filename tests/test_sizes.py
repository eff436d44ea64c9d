"""What must not grow with more than the input: plans, tasks and bytes."""

from pyspark.sql import functions as F

from glossworks.functions import common
from glossworks.operators import gloss, segments, training, variants
from glossworks.plans import q_gloss, q_training, q_workflows
from glossworks.plans.tables import table


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _entries(spark, n=50):
    return spark.createDataFrame([(f"s{i}", " ".join(f"w{(i + j) % 7}" for j in range(6))) for i in range(n)], "fileid string, text string").coalesce(1)


def test_who_asks_for_no_order_draws_none(spark):
    made = variants.expand_variants(_entries(spark))
    assert "ArrowEvalPython" not in _plan(made.select("variant_id", "category")) and "ArrowEvalPython" in _plan(made)
    split = training.split_variants(made).select("variant_id", "split")
    assert "ArrowEvalPython" not in _plan(split) and split.where("split = 'val'").count() == round(50 * 36 * 0.1)


def test_orders_are_drawn_in_as_many_tasks_as_a_shuffle_has(spark):
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert variants.expand_variants(_entries(spark)).rdd.getNumPartitions() == tasks


def test_fixed_points_need_no_join(spark):
    found = variants.fixed_points(_entries(spark))
    assert "Join" not in _plan(found) and found.first() == (50 * 33, 0)
    assert variants.fixed_points(_entries(spark).limit(0)).first() == (0, 0)


def test_of_stems_that_begin_alike_only_the_longest_of_each_kind_comes(spark, monkeypatch):
    """sentence_1234 is begun by sentence_1, sentence_12 and so on: a name has one of them, whatever their number, and a text of all names is dealt."""
    for chars, names in ((10**6, 200_000), (7, 40)):
        monkeypatch.setattr(common, "SHARD_CHARS", chars)
        monkeypatch.setattr(common, "SHARD_NAMES", names)
        stems = spark.createDataFrame([(f"sentence_{i}", 1) for i in range(1, 300)] + [("sentence", 2), ("xy", 1)], "stem string, kinds int")
        files = spark.createDataFrame([(f"a_sentence_{i}_sentence",) for i in range(1, 300)], "name string")
        found = sorted(tuple(r) for r in common.contained(files, stems).collect())
        want = [(f"a_sentence_{i}_sentence", s) for i in range(1, 300) for s in (f"sentence_{i}", "sentence")]
        assert found == sorted(want)


def test_a_counted_word_carries_no_sentence(spark, monkeypatch):
    """a sentence meets its words last; sent with every word it is shuffled as often as it has words."""
    sf, seen, count = "/root/testdata/sf0.001", [], gloss.count_words
    monkeypatch.setattr(gloss, "count_words", lambda tokens: seen.append(tokens) or count(tokens))
    report = q_gloss._report(spark, sf)
    assert [t.columns for t in seen] == [["file", "seq", "pos", "token"]] and report.where("source_sentence IS NULL").isEmpty()
    tokens = seen[0].join(table(spark, sf, "conversations").select("conv_id", "turn", F.col("text").alias("sentence")), [F.col("seq.conv_id") == F.col("conv_id"), F.col("seq.turn") == F.col("turn")])
    whole = gloss.match_report(tokens.select("token", "file", "sentence", "seq"), q_gloss._found(spark, sf), table(spark, sf, "benchmark_words").select("word", F.md5("word").alias("ref"), F.upper("word").alias("gloss")))
    assert whole.exceptAll(report).isEmpty() and report.count() == whole.count()


def test_orders_are_drawn_for_many_sentences_at_once(spark, monkeypatch):
    """No list that can be deranged is given up, and few lists at a time or many come out alike."""
    half = ["a"] * 10 + ["b"] * 10
    assert all(x != y for x, y in zip(half, variants.derange(half, 0, "k"), strict=True))
    texts = ["", "a", "a a", "a a b", "b a a b", " ".join(half), "c d e f g", "c d e c d e c"]
    made = variants.expand_variants(spark.createDataFrame([(None if i == 5 else f"s{i}", t) for i, t in enumerate(texts)], "fileid string, text string").coalesce(1), seed=3)
    rows = made.where("fileid IS NOT NULL").collect()
    assert len(rows) == 7 * 36
    for r in rows:
        tokens = texts[int(r.fileid[1:])].split()
        assert r.tokens == (variants.derange(tokens, 3, r.variant_id) if r.variant or r.category == "A_shuf" else tokens)
    monkeypatch.setattr(variants, "AT_ONCE", 1)
    again = variants.expand_variants(made.sparkSession.createDataFrame([("s6", texts[6])], "fileid string, text string"), seed=3)
    assert again.exceptAll(made.where("fileid = 's6'")).isEmpty()


def test_features_meet_a_sentence_once_for_all_its_variants(spark):
    words = spark.createDataFrame([("w0", 0, "x", 2), ("w1", 0, "y", 0), ("w1", 1, "z", 1), ("w2", 0, "u", 3)], "token string, ord int, name string, n_frames int")
    frames = words.select("name", "n_frames", F.expr("transform(sequence(1, greatest(n_frames, 1)), i -> array(cast(i AS float), cast(ascii(name) AS float))) AS feat"))
    usable = words.select("token", "ord", "name").crossJoin(spark.createDataFrame([("B",), ("C",)], "category string"))
    plans = variants.clip_plans(_entries(spark, 5), usable, frames)
    want = variants.concat_features(variants.plan_rows(variants.clip_plans(_entries(spark, 5), usable, frames.drop("feat"))), frames)
    got = variants.plan_features(plans)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect())) and got.count() == 5 * 25
    assert variants.clip_plans(_entries(spark, 5), usable, frames, kinds="B").select("category").distinct().collect() == [("B",)]


def test_the_first_workload_cuts_its_texts_into_words_once(spark, monkeypatch):
    """lemmas and lexicon come from one written table of distinct words."""
    calls, tokens = [], q_gloss._tokens
    monkeypatch.setattr(q_gloss, "_tokens", lambda s, d: calls.append(d) or tokens(s, d))
    monkeypatch.setattr(q_workflows.wf, "text_to_batch", lambda *given: given)
    *_, lemmas, lexicon, _ = q_workflows._w1(spark, "/root/testdata/sf0.001")
    assert len(calls) == 1 and all("Generate" not in _plan(x) for x in (lemmas, lexicon))


def test_each_result_of_the_second_workload_comes_from_its_own_steps(spark, monkeypatch):
    """Entries draw no variants, variants make no pads, and both come as when all is wanted."""
    sf, calls = "/root/testdata/sf0.001", []
    whole = q_workflows._w2(spark, sf)
    for module, name in ((training, "pad_to_target"), (variants, "clip_plans")):
        monkeypatch.setattr(module, name, lambda *given, f=getattr(module, name), name=name, **more: calls.append(name) or f(*given, **more))
    for want, step in (("entries", "pad_to_target"), ("variants", "clip_plans")):
        calls.clear()
        got = q_workflows.QUERIES[f"w2_{want}"][0](spark, sf)
        assert calls == [step] and got.exceptAll(whole[want]).isEmpty() and whole[want].exceptAll(got).isEmpty()


def test_variants_of_a_kind_are_those_of_all(spark):
    made = variants.expand_variants(_entries(spark, 9), seed=5)
    for kinds in ("A", "BC"):
        own = variants.expand_variants(_entries(spark, 9), seed=5, kinds=kinds)
        want = made.where(F.substring("category", 1, 1).isin(*kinds))
        assert own.exceptAll(want).isEmpty() and own.count() == want.count() > 0


def test_pads_are_found_by_keys_of_their_texts(spark, monkeypatch):
    """whole texts are neither sorted nor shuffled to find which are new; texts that differ in case only are one, current ones none."""
    seen, first = [], training.first_wins
    monkeypatch.setattr(training, "first_wins", lambda df, *given: seen.append(df) or first(df, *given))
    current = spark.createDataFrame([("a.mp4", " One ")], "filename string, sentence_text string")
    texts = [(2, 1, "two"), (1, 2, "TWO"), (1, 1, "one"), (1, 3, "Three"), (1, 3, "four"), (2, 4, " "), (2, 5, "two "), (0, 6, "five")]
    sources = spark.createDataFrame([(p, s, None, t, f"word_{t}.mp4") for p, s, t in texts], "prio int, seq long, pseudo_gloss string, text string, path string")
    got = training.pad_to_target(current, sources, 4).collect()
    assert got[0].__fields__ == ["prio", "pseudo_gloss", "text", "path", "idx"] and sorted((r.idx, r.text.lower(), r.prio) for r in got)[0] == (0, "two", 1)
    assert {r.text for r in got} == {"TWO", "Three", "four"} and all(r.path == f"word_{r.text}.mp4" for r in got) and {r.idx for r in got} == {0, 1, 2}
    assert seen[0].columns == ["prio", "seq", "__k"] and dict(seen[0].dtypes)["__k"] == "binary"
    assert len(training.pad_to_target(current, sources, 9).collect()) == 4


def test_entries_are_worked_out_once(spark):
    """the look for rows without a gloss and the result read one table."""
    entries = q_training._entries(spark, "/root/testdata/sf0.001")
    assert "Join" not in _plan(entries) and "Aggregate" not in _plan(entries) and entries.where("is_pad").count() > 0


def test_scaled_segments_are_not_shuffled(spark):
    """a variant has its ratio before it meets the segments, so variants x segments rows are no join's input; repeated parameters still count."""
    segs = spark.range(40).selectExpr("concat('sentence_', id % 8) AS stem", "id div 8 AS seg", "double(id) AS start", "double(id + 1) AS end", "'x' AS label")
    made = spark.createDataFrame([(f"{a}_{i}", k, a, f"sentence_{i}") for i in range(9) for k, a in (("temporal", "slow"), ("temporal", "none"), ("view", "slow"), ("image", "slow"))], "name string, aug_type string, aug_name string, stem string")
    params = spark.createDataFrame([("slow", f"sentence_{i}", 2.0) for i in range(8)] + [("slow", "sentence_3", 4.0)], "aug_name string, stem string, speed_ratio double")
    got = segments.scale_segments(segs, made, params)
    ratio = {"view": 1.2, "image": 1.0}
    want = [(s.stem, v.aug_type, v.aug_name, r) for s in segs.collect() for v in made.collect() if v.stem == s.stem
            for r in ([2.0, 4.0] if v.stem == "sentence_3" else [2.0]) if v.aug_name == "slow"] + [(s.stem, "temporal", "none", 1.0) for s in segs.collect()]
    starts = {(s.stem, s.seg): s.start for s in segs.collect()}
    assert got.count() == len(want) and all(r.start in [starts[r.stem, r.seg] / x for x in ((2.0, 4.0) if r.aug_type == "temporal" and r.name.startswith("slow") else (ratio.get(r.aug_type, 1.0),))] for r in got.collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    outer, inner = plan.index("Join Inner"), plan.index("Join LeftOuter")
    assert outer < inner  # the segments come last
