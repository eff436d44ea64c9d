"""The pipeline's near copies meet at SimHash anchors first, and its groups stay those of all pairs."""

import numpy as np
import pytest

from glossworks.llm import simhash, similar
from tests.llm.brute import near_copies as groups
from tests.llm.test_pipeline_ops import SCHEMA
from tests.llm.test_similar import texts


def test_near_copies_meet_at_anchors_first(spark, monkeypatch):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    asked, own = [], simhash.links

    def spied(fps):
        asked.append(fps.count())
        return own(fps)

    monkeypatch.setattr(simhash, "links", spied)
    rows = texts()
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(rows)], SCHEMA)
    assert sorted(r.doc_id for r in corpus_pipeline.distinct_documents(spark, docs, "").collect()) == sorted(set(groups(rows)))
    assert len(asked) == 1 and asked[0] > 100


def test_fingerprints_of_sets():
    assert simhash.majority(similar.shingles("one two three", 3)) == simhash.fingerprint("one two three") and simhash.majority(np.zeros(0, dtype=np.int64)) == 0
