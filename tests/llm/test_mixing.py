"""The pipeline's mixture against its target weights."""

import math

import pytest
from pyspark.sql import functions as F

from glossworks.llm import mixing
from tests.llm import brute


def test_no_source_of_the_pipeline_drifts_from_its_weight(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.range(20 * 800).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 20).alias("source"))
    got = corpus_pipeline.mixed_documents(spark, docs, "").select("slot", "source").distinct().collect()
    assert sorted(r.slot for r in got) == list(range(20 * 100))  # a slot for each block, and none free
    done = dict.fromkeys({r.source for r in got}, 0)
    for t, r in enumerate(sorted(got)):
        done[r.source] += 1
        assert all(abs(n - (t + 1) / 20) < 1 for n in done.values())


@pytest.mark.parametrize("weights", [[60, 25, 10, 5], [100000, 10], [700, 299, 1], [1], [(i * 7919) % 5 + 1 for i in range(300)]])
def test_deviation_from_the_weights_over_several_periods(spark, monkeypatch, weights):
    monkeypatch.setattr(mixing, "CHUNK", 100)
    names = [None if i == 3 else f"s{i:04d}" for i in range(len(weights))]
    plan = mixing.shares(spark.createDataFrame([*zip(names, weights, strict=True), ("none", 0)], "source string, weight long"))
    slots = {r["at"]: r.source for r in mixing.template(plan).collect()}
    order = [slots[t] for t in range(len(slots))] * 3
    whole = sum(weights)
    sizes = dict(zip(names, weights, strict=True))
    assert len(slots) == whole // math.gcd(*weights) and set(order) == set(sizes)
    done = dict.fromkeys(sizes, 0)
    for t, source in enumerate(order, 1):
        done[source] += 1
        # what was given moves by one source a slot; the others only fall behind, and are looked at now and then
        for name in (source, *(sizes if t % 97 == 0 or len(sizes) < 5 else ())):
            assert abs(done[name] * whole - t * sizes[name]) < whole


def test_the_plan_is_earliest_deadline_first(spark):
    weights = [("a", 12), ("b", 5), ("c", 2), ("d", 1)]
    got = mixing.template(mixing.shares(spark.createDataFrame(weights, "source string, weight long"))).orderBy("at").collect()
    assert ["abcd".index(r.source) for r in got] == brute.pfair([12, 5, 2, 1], 20)


def test_weights_that_need_too_many_slots_are_refused(spark):
    with pytest.raises(Exception, match="the weights sum to"):
        mixing.template(mixing.shares(spark.createDataFrame([("a", 1 << 40), ("b", 1)], "source string, weight long"))).count()


def test_default_weights_need_few_slots_however_many_rows(spark):
    counts = [(f"s{i}", 4_400_000 + 977 * i) for i in range(1000)] + [("huge", 10**15), ("tiny", 1), (None, 50)]
    plan = mixing.shares(mixing.default_weights(spark.createDataFrame(counts, "source string, n long"))).first()
    assert len(plan.sources) == len(counts) and plan.D <= mixing.PARTS + len(counts) and all(s.share >= 1 for s in plan.sources)
