"""The metric index: exact whatever the cells, few pairs where vectors lie in groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossworks.operators import similarity

SCHEMA = "id long, vec array<double>"


def _brute(left, right, k, least=-1.0):
    out = {}
    for q, x in left:
        if np.linalg.norm(x):
            sims = [(-round(float(np.dot(x, v) / np.linalg.norm(x) / np.linalg.norm(v)), 12), i) for i, v in right if np.linalg.norm(v)]
            out[q] = [i for s, i in sorted(sims)[:k] if -s >= least]
    return {q: ids for q, ids in out.items() if ids}


def _found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.q, r["rank"])):
        out.setdefault(r.q, []).append(r.id)
    return out


def _groups(n, groups, spread, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, 16))
    rows = [(i, (centres[i % groups] + spread * rng.normal(size=16)).round(3)) for i in range(n)]
    return [*rows, (n, np.zeros(16)), *((n + 1 + i, rows[0][1]) for i in range(30))]  # one without a direction, thirty equal ones


@pytest.mark.parametrize(("cells", "k", "least"), [(1, 3, -1.0), (7, 40, -1.0), (25, 5, 0.5), (300, 1, -1.0)])
def test_every_neighbour_is_found(spark, monkeypatch, cells, k, least):
    monkeypatch.setattr(similarity, "SLICE", 16)
    monkeypatch.setattr(similarity, "BLOCK", 8)
    data = _groups(600, 12, 0.3, 1)
    right = spark.createDataFrame([(i, v.tolist()) for i, v in data], SCHEMA).repartition(5)
    asked = [(i, v) for i, v in data if i % 20 == 0]
    left = spark.createDataFrame([(i, v.tolist()) for i, v in asked], SCHEMA)
    assert _found(similarity.top_k_similar(left, right, k, least, cells)) == _brute(asked, data, k, least)


def test_far_cells_are_not_met(spark):
    data = _groups(4000, 40, 0.05, 2)
    right = spark.createDataFrame([(i, v.tolist()) for i, v in data], SCHEMA)
    left = right.where("id % 20 = 0")
    index = similarity.build_index(right, 80)
    done, every = index.pairs(left, 5)
    assert done < every / 10 and int(index.rows.sum()) == len(data) - 1
    asked = [(i, v) for i, v in data if i % 20 == 0]
    assert _found(index.top_k(left, 5)) == _brute(asked, data, 5)


def test_neither_side_meets_by_a_cross_join(spark):
    right = spark.createDataFrame([(i, v.tolist()) for i, v in _groups(200, 4, 0.3, 3)], SCHEMA)
    plan = similarity.top_k_similar(right.limit(50), right, 3)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def _contained(names, stems):
    return sorted((n, s) for n in set(names) for s in set(stems) if s and s in n)


@pytest.mark.parametrize("chars", [10_000, 60, 7])
def test_every_stem_in_a_name_is_found(spark, monkeypatch, chars):
    """In one automaton, and in shards whose bounds stems and their prefixes straddle; hot shards in parts."""
    import random

    from glossworks.functions import common

    monkeypatch.setattr(common, "SHARD_CHARS", chars)
    monkeypatch.setattr(common, "SHARD_NAMES", 40)
    r = random.Random(4)
    some = lambda n: "".join(r.choices("abé_", k=r.randint(1, n)))
    stems = [some(6) for _ in range(60)] + ["a", "ab", "aba", "abab", "", None, "sentence_1", "sentence_12", "sentence_12_a"]
    names = [some(14) for _ in range(150)] + [f"x_sentence_1{i}_a" for i in range(90)] + ["", None, "z", "z", "abab", "b" * 3000]
    df = lambda xs, c: spark.createDataFrame([(x,) for x in xs], f"{c} string").repartition(3)
    got = sorted(map(tuple, common.contained(df(names, "name"), df(stems, "stem")).collect()))
    assert got == _contained([n for n in names if n], [s for s in stems if s])
    assert common.contained(df(names, "name"), df([""], "stem")).count() == common.contained(df([], "name"), df(stems, "stem")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 7, 500, 1999, 2000, 5000])
def test_the_first_of_a_seeded_order(spark, monkeypatch, n):
    import hashlib

    from glossworks.functions import common

    monkeypatch.setattr(common, "BARS", 8)
    keys = [f"k{i % 1700}" for i in range(2000)]  # some come twice
    df = spark.createDataFrame([(k,) for k in keys], "key string").repartition(3)
    code = lambda k: (hashlib.md5(f"42|{k}".encode()).hexdigest(), k)
    first = set(sorted(keys, key=code)[:n])
    got = df.where(common.first_by_hash(df, "key", n, 42))
    assert sorted(r.key for r in got.collect()) == sorted(k for k in keys if k in first)
    plan = got._jdf.queryExecution().toString()
    assert "TakeOrdered" not in plan and "Exchange" not in plan.partition("Physical")[2].replace("Exchange RoundRobin", "")


@pytest.mark.parametrize("n", [None, 0, 1, 100, 999, 5000])
def test_ranks_in_ranges(spark, n):
    from glossworks.functions import common

    df = spark.range(1000).select((F.col("id") % 3).alias("prio"), (F.col("id") * 7919 % 1000).alias("seq"))
    got = common.ranked(df, ["prio", "seq"], n)
    order = sorted((i % 3, i * 7919 % 1000) for i in range(1000))
    assert sorted((r["__rank"], r.prio, r.seq) for r in got.collect()) == [(i, *x) for i, x in enumerate(order[: n if n is not None else 1000])]
    plan = got._jdf.queryExecution().toString()
    assert "TakeOrdered" not in plan and "SinglePartition" not in plan


def test_phrases_of_any_length(spark):
    import random

    from glossworks.operators import gloss

    r = random.Random(5)
    some = lambda n: " ".join(r.choices("a b c the".split(), k=n))
    phrases = sorted({some(r.randint(1, 12)) for _ in range(60)} | {"the united states of america today", "a b"})
    texts = [some(r.randint(0, 40)) for _ in range(120)] + ["The united states of America, today!", "", "  ", " ".join(["a b"] * 3000)]

    def brute(text):
        words, out, i = [w for w in (x.strip(",!") for x in text.lower().split()) if w], [], 0
        while i < len(words):
            n = next((n for n in range(min(12, len(words) - i), 1, -1) if " ".join(words[i : i + n]) in phrases), 1)
            out.append((i, " ".join(words[i : i + n])))
            i += n
        return out

    phrases = set(phrases)
    rows = [(i // 2, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "row int, sentence string").selectExpr("*", "1 AS w", "2 AS found", "3 AS kept")
    got = gloss.tokenize_with_phrases(df, ["row", "w", "found"], spark.createDataFrame([(p,) for p in phrases], "phrase string").unionAll(spark.createDataFrame([("x",)], "phrase string")))
    assert sorted((x.row, x.pos, x.token) for x in got.collect()) == sorted((k, *t) for k, text in rows for t in brute(text))
    assert gloss.tokenize_with_phrases(df, ["row"], spark.createDataFrame([], "phrase string")).count() == sum(len(t.split()) for _, t in rows)


def test_pieces_of_any_size_find_the_same_and_rounding_draws_no_negative_chance(spark, monkeypatch):
    """what a task holds is bounded by pairs, similarities and visits, not by Spark's rows of a batch."""
    for seed in range(20):
        units, _ = similarity._unit(np.random.default_rng(seed).normal(size=(200, 64)))
        assert similarity._fitted(units, 8).shape == (8, 64)
    key, rows = "spark.sql.execution.arrow.maxRecordsPerBatch", np.random.default_rng(1).normal(size=(120, 5))
    data = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "id long, vec array<double>")
    found = lambda: sorted((r.q, r["rank"], r.id, round(r.sim, 9)) for r in similarity.top_k_similar(data, data, 4, cells=6).collect())
    before, want = spark.conf.get(key), found()
    for name in ("HELD", "AT_ONCE", "VISITS"):
        monkeypatch.setattr(similarity, name, 1)
    assert found() == want and spark.conf.get(key) == before
