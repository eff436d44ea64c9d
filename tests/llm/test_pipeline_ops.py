"""op1, op4, op8, op9, op10 and the pipeline against brute force."""

import random
import time

import pytest
from pyspark.sql import functions as F

from glossworks.llm import decontaminate, mixing, pii, quality, queries, simhash
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the old river ran past a quiet mill where nobody had worked for many long years and yet the wheel still turned in the wind at night".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(PROSE) + r.choice(["", "s", "ing", str(r.randint(0, 9))]) for _ in range(n))


ITEMS = [(1, prose("item", 30)), (2, "Only three words"), (3, ""), (4, None), (5, prose("item", 30)), (6, "Été À la mer")]
TEXTS = [
    prose(1, 120), prose(1, 120), prose(1, 119) + " changed", prose(2, 200), prose("item", 30), "x " + prose("item", 12) + " y", "we know only THREE words here", "", None, "   \n\t ",
    "mail a.b+c@x-y.example.com, x@y.z_q@w.v and 10.0.0.255 or 999.1.1.1.1.1 1.2.3.4.5.6.7.8", "card 4111 1111 1111 1111 or 4111-1111-1111-1112 1234567890123 no 5 5555-5555-5555-4444",
    "call +1 (415) 555-2671 or +49 30 901820 +5 or +123456789012345678 ++44 20 7946 0958)", "4" * 3000, "été à la mer ÉTÉ À LA MER", "line a\nline a\n\nline b\nline a #*$%&|<>", "a b c a b c a b c d", "😀 mail 😀@x.com é@é.fr a@b.cd 😀 1.1.1.1",
    " ".join(["##$$ %%&&"] * 60), prose(3, 5000) + " " + prose("item", 30) + " " + prose(4, 5000), "only three", "w " * 60,
]
ROWS = [(i, t, "en" if i % 3 else None, "a" if i % 2 else "b", len(t or "")) for i, t in enumerate(TEXTS)]
ROWS += [(4, TEXTS[4], None, "a", 1), (4, TEXTS[4], None, "a", 1), (None, TEXTS[0], "en", None, 1), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    # columns whose names the operators use themselves
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5).withColumns({"key": F.lit(1), "slot": F.lit(2), "spans": F.lit("x"), "fp": F.lit(0), "n": F.lit(1)})


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_personal_data(docs):
    found = pii.personal_data(docs).select("doc_id", pii.digest_text(F.col("base")).alias("base"), pii.digest_text(F.col("spans")).alias("spans")).collect()
    want = sorted((str(i), ",".join(brute.pii(t)[0])) for i, t, *_ in ROWS)
    assert sorted((str(r.doc_id), r.base) for r in found) == want
    assert all(set(r.base.split(",")) <= set(r.spans.split(",")) or not r.base for r in found)


def test_patterns_discover_unseen_identifiers(spark):
    rows = [(i, f"please write to mail{i}@example.com today") for i in range(20)] + [(99, "please write to hidden(at)example.com today"), (98, "some other words then hidden(at)example.org here")]
    long = "x" * 300
    rows += [(97, f"you may write to {long}(at){long}(dot){long}"), (96, f"{long} phone: 030/12-34-56-78 nothing"), (95, "they write to 1(at)nowhere todays")]
    rows += [(200 + i, f"{long} phone: +49 30 90{i:04d}1 or") for i in range(9)]
    found = {r.doc_id: r.s for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", pii.digest_text(F.col("spans")).alias("s")).collect()}
    assert found[99] == "email:16:37" and found[98] == "" and found[97] == "email:17:926"  # of any length
    assert found[96] == "phone:308:323"  # by "<long word> phone", whatever its length


def test_scores_against_brute_force(spark):
    r = random.Random(12)
    seeds = [(r.randint(0, 1), (0, f"p{r.randint(0, 12)}"), f"s{r.randint(0, 60)}") for _ in range(150)]
    places = [(r.randint(0, 1), (0, f"p{r.randint(0, 14)}"), f"i{r.randint(0, 30)}" if r.random() < 0.7 else f"s{r.randint(0, 60)}") for _ in range(90)]
    schema = "k int, pattern struct<place: int, words: string>, v string"
    got = {(x.k, tuple(x.pattern), x.v): x.score for x in pii.score(spark.createDataFrame(seeds, schema), spark.createDataFrame(places, schema)).collect()}
    want = brute.scores(seeds, places, pii.ROUNDS, pii.INSTANCE_SURE, pii.LEAST_SEEDS, pii.PATTERN_SURE)
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-9 for x in want) and any(0 < x < 1 for x in want.values())


def test_a_text_of_very_many_addresses(spark):
    n = 100_000
    text = " ".join(f"a{i}@b.cd 1.2.3.4" for i in range(n // 2))
    began = time.time()
    row = pii.personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).select(F.size("base").alias("n"), F.element_at("base", -1)["e"].alias("end"), F.size("spans").alias("all")).first()
    assert (row.n, row.end, row.all) == (n, len(text), n) and time.time() - began < 60


def test_masking_covers_every_span_and_leaves_the_rest(docs):
    out = {r.doc_id: r for r in pii.mask(docs).collect() if r.doc_id is not None}
    assert pii.mask(docs).columns == docs.columns and pii.mask(docs).count() == len(ROWS)
    assert out[10].text.startswith("mail [EMAIL], [EMAIL]") and "10.0.0.255" not in out[10].text and out[10].n_chars == len(out[10].text)
    assert out[3].text == TEXTS[3] and out[8].text is None


def test_quality_measures(docs):
    found = quality.verdicts(docs).collect()
    names = list(brute.quality(""))
    got = sorted(str((r.doc_id, *[r[c] for c in names])) for r in found)
    assert got == sorted(str((i, *brute.quality(t).values())) for i, t, *_ in ROWS)
    assert all(not r.kept for r in found if r.base_failed)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= {r.doc_id for r in found if r.kept}


def test_kept_against_brute_force(spark):
    r = random.Random(2)
    rows = []
    for i in range(400):
        source = r.choice(["a", "a", "a", "b", None])
        text = prose(i, r.randint(40, 120))
        if source == "b" or r.random() < 0.05:
            text = text.replace(" ", " & ", r.randint(5, 40))
        if r.random() < 0.1:
            text = "\n".join(["same line of words"] * r.randint(1, 5) + [text])
        if r.random() < 0.05:
            text = text.replace(" the ", "w" * r.randint(1, 30)) if r.random() < 0.5 else text.upper()
        rows.append((i, text, r.choice(["en", "en", "de", None]), source, 0))
    want = brute.kept(rows)
    assert 20 < sum(not k for k in want.values()) < 200
    for parts in (1, 7):  # and whatever the order
        assert {x.doc_id: x.kept for x in quality.verdicts(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()} == want


def test_quality_limits_follow_the_group(spark):
    rows = [(i, prose(i, 100), "en", "plain", 0) for i in range(150)] + [(1000 + i, prose(i, 100).replace(" ", "#| "), "en", "code", 0) for i in range(150)] + [(5000, prose(7, 100).replace(" ", "#| "), "en", "plain", 0)]
    kept = {r.doc_id: r.kept for r in quality.verdicts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(kept[i] for i in range(150)) and all(kept[1000 + i] for i in range(150)) and not kept[5000]


def test_fingerprints_and_components(docs):
    found = simhash.near_duplicates(docs).collect()
    prints = {str(r.doc_id) + str(r.key): r.fp & (1 << 64) - 1 for r in found}
    assert sorted(map(str, prints.values()))
    want = sorted(f"{brute.fingerprint(t):016x}" for _, t, *_ in ROWS)
    assert sorted(f"{r.fp & (1 << 64) - 1:016x}" for r in found) == want
    groups = brute.components([(i, brute.fingerprint(t)) for i, t, *_ in ROWS])
    assert all(r.component_id == groups[r.doc_id] for r in found if r.doc_id is not None)


@pytest.mark.parametrize("shape", ["scattered", "dense"])
def test_links_join_what_two_bits_join(spark, shape):
    r = random.Random(5)
    if shape == "dense":  # one anchor with more members than are compared pair by pair
        centre = r.getrandbits(64)
        fps = {centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))) for _ in range(1500)}
    else:
        fps = set()
        for _ in range(150):
            c = r.getrandbits(64)
            fps |= {c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))) for _ in range(6)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp long")).collect()
    mask = (1 << 64) - 1
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for e in edges:
        root[find(e.a & mask)] = find(e.b & mask)
    want = brute.components([(f, f) for f in fps])
    groups = {}
    for f in fps:
        groups.setdefault(find(f), set()).add(want[f])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_keep_one_of_each_group(docs):
    kept = simhash.keep_one(docs)
    groups = brute.components([(i, brute.fingerprint(t)) for i, t, *_ in ROWS])
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(groups.values()))


def test_contamination(docs, items):
    found = decontaminate.contamination(docs, items).select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("h"), "contaminated").collect()
    want = brute.contamination([(i, t) for i, t, *_ in ROWS], ITEMS)
    assert sorted(str(tuple(r)) for r in found) == sorted(map(str, want))
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()} == {w[0] for w in want if not w[5]}


def test_mix_keeps_every_row(docs):
    out = mixing.mix(docs, block=2)
    rows = out.collect()
    assert len(rows) == len(ROWS) and all(r.release <= r.slot < r.deadline for r in rows)
    assert len({(r.slot, r.position) for r in rows}) == len(rows)


@pytest.mark.parametrize("name", ["op1_pii", "op4_quality_rules", "op8_mixing", "op9_simhash", "op10_decontaminate"])
def test_empty_tables(spark, tmp_path, name):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


def test_pipeline_against_brute_force(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(i, prose(i % 40, 80) if i % 3 else prose(i, 90), "en", f"s{i % 3}", 0) for i in range(120)]
    rows += [(500, prose(77, 40) + " " + prose("item", 30) + " " + prose(78, 40), "en", "s0", 0), (501, prose(79, 60) + " mail me@example.org now", "en", "s1", 0), (502, "too short", "en", "s1", 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS[:1], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    good = [r for r in rows if not brute.quality(r[1])["base_failed"]]
    groups = brute.near_copies([r[1] for r in good])
    one = [r for i, r in enumerate(good) if groups[i] == i]
    clean = {r[0] for r, c in zip(one, brute.contamination([(r[0], r[1]) for r in one], ITEMS[:1]), strict=True) if not c[5]}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == clean and len(out) == len(clean)
    assert next(r.text for r in out if r.doc_id == 501).endswith("mail [EMAIL] now")



@pytest.mark.parametrize("stage", range(5))
def test_every_stage_bears_nulls_empty_tables_and_clashing_names(spark, tmp_path, stage):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    run = corpus_pipeline.STAGES[stage][1]
    odd = [(1, prose(1, 80), None, None, None), (None, None, None, None, None), (2, "", "en", None, 0), (2, "", "en", None, 0), (None, prose(2, 80), "en", "a", 1)]
    names = {n: F.lit(1) for n in ("key", "sid", "h", "n", "at", "fp", "root", "block", "slot", "position", "spans", "base", "pos", "w", "kept", "n_words")}
    docs = spark.createDataFrame(odd, SCHEMA).withColumns(names)
    out = run(spark, docs, str(tmp_path))
    last = stage == len(corpus_pipeline.STAGES) - 1
    assert last or out.columns == docs.columns
    assert out.count() == {0: 2, 1: 3, 2: 5, 3: 5, 4: 5}[stage]
    assert run(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_a_side_is_broadcast_by_its_bytes(spark):
    from glossworks.llm.common import small

    def broadcasts(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    rows = spark.createDataFrame([(1, "x" * 1000), (2, None)], "id long, w string")
    assert broadcasts(small(rows)) and broadcasts(small(rows.limit(0))) and not broadcasts(small(rows, 1000))
