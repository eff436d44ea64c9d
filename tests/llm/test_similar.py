"""Near copies of the pipeline against all pairs."""

import random

import pytest

from glossworks.llm import similar
from tests.llm.brute import near_copies as groups
from tests.llm.test_pipeline_ops import PROSE, SCHEMA, prose


def edited(text, n, seed):
    r, words = random.Random(seed), text.split()
    for i in r.sample(range(len(words)), n):
        words[i] = r.choice(PROSE) + "xyz"
    return " ".join(words)


def texts():
    out = [None, "", " ", "one two", "One  TWO", "one two three"]
    for i in range(15):
        base = prose(i, 60 + 9 * i)
        out += [base, *(edited(base, n, 100 * i + n) for n in range(0, 8))]
    chain = prose("chain", 200)
    out += [" ".join(chain.split()[8 * i : 8 * i + 120]) for i in range(10)]  # neighbours only are near
    passage = prose("passage", 30)
    out += [f"{prose(f'a{i}', 60)} {passage}" for i in range(70)]  # one passage that all have
    big = prose("big", 150)
    return [*out, *(edited(big, i % 4, 7000 + i) for i in range(80))]


@pytest.mark.parametrize("sample, dense, block", [(1, 64, 512), (1 << 40, 64, 512), (1 << 40, 3, 7)])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, sample, dense, block):
    for name, value in (("SAMPLE", sample), ("DENSE", dense), ("BLOCK", block)):  # neither the order nor blocks change anything
        monkeypatch.setattr(similar, name, value)
    rows = texts()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").repartition(5)
    want = groups(rows)
    assert 70 < len(set(want)) < len(rows) - 100
    found = {r.doc_id: r.root for r in similar.near_copies(docs).collect()}
    assert len(found) == len(rows)
    assert len({(found[i], want[i]) for i in found}) == len(set(found.values())) == len(set(want))
    assert sorted(r.doc_id for r in similar.keep_one(docs).collect()) == sorted(set(want))


def test_no_rows_and_repeated_rows(spark):
    assert similar.keep_one(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, None)], "doc_id long, text string")
    assert similar.near_copies(docs).count() == 4 and sorted(r.doc_id for r in similar.keep_one(docs).collect()) == [1, 2]


def test_the_pipeline_s_stage_drops_a_near_copy(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    base = prose("stage", 200)
    rows = [(1, base, "en", "a", 0), (2, edited(base, 3, 1), "en", "a", 0), (3, prose("else", 200), "en", "a", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r.doc_id for r in corpus_pipeline.distinct_documents(spark, docs, "").collect()) == [1, 3]


def test_turns_read_what_is_left_and_broadcasts_are_bounded(spark, monkeypatch):
    limits, rows, small, materialize = [], {}, similar.small, similar.materialize

    def held(df, limit=None):
        limits.append(limit)
        return small(df, limit)

    def written(df, label):
        out = materialize(df, label)
        rows.setdefault(label, []).append(out)
        return out

    monkeypatch.setattr(similar, "small", held)
    monkeypatch.setattr(similar, "materialize", written)
    some = texts()[:60]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(some)], "doc_id long, text string")
    assert sorted(r.doc_id for r in similar.keep_one(docs).collect()) == sorted(set(groups(some)))
    assert limits and all(x is not None and x <= 4 << 20 for x in limits)  # whatever the input, the driver holds no more at once
    rooted = [x.count() for x in rows["similar-rooted"]]
    assert len(rooted) <= similar.TURNS + 1  # once a turn
    assert rooted[-1] < rows["similar-met"][-1].count()  # settled shingles are not read again
