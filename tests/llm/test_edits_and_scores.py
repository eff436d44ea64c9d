"""op11, op12, op13."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossworks.llm import conversations, fim, gaussian, queries
from tests.llm.test_pipeline_ops import SCHEMA, TEXTS, prose
from tests.oracle import differences

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- op11 ---------------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("error", [0, 2, 120, 5000])
def test_the_rank_index_is_exact(error):
    r = random.Random(1)
    texts = ["", "a", "aa", "é", "a1", "a" * 5000 + "1" * 5000 + "b" * 100_000 + ". ." * 1000, prose(3, 3000)]
    texts += ["".join(r.choices("abcXYZ .,é\n0", k=r.randint(0, 3000))) for _ in range(40)]
    for text in texts:
        offsets = fim.boundaries(text)
        assert list(offsets) == [0, *itertools.accumulate(len(t) for t in TOKEN.findall(text))]
        index = fim.RankIndex.fit(offsets, error)
        assert (index.locate(np.arange(len(offsets))) == offsets).all()
        assert np.abs(index.residuals.astype(int)).max() <= error + 1
        assert index.residuals.dtype == np.int8 or error > 120


def _filled(doc, text, seed=1):
    """The rule as it is written."""
    text = text or ""
    tokens = TOKEN.findall(text)
    code = sha(f"{seed}:{'' if doc is None else doc}")
    h = [int(code[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    pre, mid, suf = ("".join(tokens[i:j]) for i, j in ((0, a), (a, b), (b, None)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(tokens), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(tokens), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(tokens), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_fill_in_middle_against_the_rule(spark):
    r = random.Random(2)
    texts = [*TEXTS, "a <P> b", "x<M>", "<S>", "<", "<P", "<<P<S", "M>" * 9, "word " * 40_000, "x" * 200_000]
    texts += ["".join(r.choices("ab <>PSM.é👍", k=r.randint(1, 30))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (None, None), (7, "twice"), (7, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS form", "2 AS output", "3 AS segments", "4 AS __id", "5 AS first")
    made = fim.fill_in_middle(docs).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in made.collect()), key=str)
    assert got == sorted(((d, *_filled(d, t), t or "") for d, t in rows), key=str)
    assert {"plain", "psm", "spm"} == {r[2] for r in got}


# -- op12 ---------------------------------------------------------------------------------------------------------------------------


def cheapest(symbols, cap):
    """Every edit that costs cap or less; the cheapest, of those the least."""
    found = []

    def go(i, state, cost, audit):
        if cost > cap:
            return
        if i == len(symbols) and state in (0, 3):
            found.append((cost, audit))
        given = 3 if state == 2 else 2
        go(i, given, cost + 2, audit + "I")
        if i < len(symbols):
            initial, forced, cut_off = symbols[i]
            go(i + 1, state, cost + 3, audit + "D")
            if not forced:
                go(i + 1, given, cost + 2 + cut_off, audit + "R")
                if (state, initial) in {(0, "s"), (0, "u"), (1, "u"), (3, "u"), (2, "a")}:
                    go(i + 1, {"s": 1, "u": 2, "a": 3}[initial], cost + cut_off, audit + "K")

    go(0, 0, 0, "")
    return min(found)


def search(symbols, size):
    """By pieces of size rows: cost, letters, and the most rows held."""
    pieces = [symbols[i : i + size] for i in range(0, len(symbols), size)]
    state, between = [(0, 0, 0)], []
    for piece in pieces:
        matrix = {p: [(p, 0, 0)] for p in range(4)}
        for symbol in piece:
            matrix = {p: conversations.step_matrix(m, symbol) for p, m in matrix.items()}
        found = conversations.compose(state, matrix)
        between.append({q: p for q, _, _, p in found})
        state = [x[:3] for x in found]
    cost, _, exit = min((c + 2 * conversations.ENDING[q], r, q) for q, c, r in state)
    ends, last = [], exit
    for back in reversed(between):
        ends.append((back[last], last))
        last = back[last]
    audit, held = "", 0
    for piece, (entry, to) in zip(pieces, reversed(ends), strict=True):
        s = conversations.Search(entry)
        told = [x for symbol in piece for x in s.push(*symbol, None)] + s.finish(to)
        audit, held = audit + "".join(x for x, _ in told), max(held, s.held)
    return cost, audit + "I" * conversations.ENDING[exit], held


def _random_symbols(r, n, kind):
    initial = lambda i: r.choice("sua-") if kind == 0 or r.random() < 0.1 else "ua"[i % 2]
    rows = [(initial(i), r.random() < (0.7 if kind == 2 else 0.15), r.random() < 0.2) for i in range(n)]
    return [(i, f, t and not f) for i, f, t in rows]


def test_edits_are_the_cheapest_and_least(monkeypatch):
    monkeypatch.setattr(conversations, "STEP", 3)
    r = random.Random(3)
    for i in range(900):
        symbols = _random_symbols(r, r.randint(1, 6), i % 3)
        cost, audit, _ = search(symbols, 100)
        assert (cost, audit) == cheapest(symbols, cost), symbols
        assert all(search(symbols, size)[:2] == (cost, audit) for size in (1, 2, 3)), symbols


def test_survivors_meet_and_few_rows_are_held():
    r = random.Random(4)
    symbols = _random_symbols(r, 20_000, 1)
    whole = search(symbols, len(symbols))
    assert whole[2] < 2 * conversations.STEP and whole[:2] == search(symbols, 777)[:2]


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello!"), (2, 5, "assistant", "x."), (2, 5, "assistant", "x."), (2, None, "user", "y?"), (2, 9, None, None),
    (3, 0, None, "z."), (None, 1, "user", "q."), (None, None, "assistant", None), (4, 1, "tool", "out of"), (4, 2, "user", "\t\n "), (4, 30, "assistant", "out of"), (5, 3, "user", "a" * 200_000), (6, 0, "", "."),
]


def test_repair_gives_sound_conversations(spark):
    r = random.Random(5)
    many = [(100 + i % 7, i // 7, r.choice(["system", "user", "assistant", "tool"]), r.choice(["yes.", "no", " ", f"row {i}!"])) for i in range(700)]
    conv = spark.createDataFrame(ROWS + many, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS key", "2 AS piece", "3 AS copy", "4 AS digest", "5 AS code")
    rows = conversations.damaged(conv)
    for piece in (4096, 10):
        made, totals = conversations.repair(rows, piece)
        by = {}
        for e in sorted(made.collect(), key=lambda e: (e.key or "", e.key is None, e.piece, e.seq)):
            by.setdefault(e.key, []).append(e)
        costs = {t.key: t.cost for t in totals.collect()}
        assert set(by) == set(costs)
        for key, es in by.items():
            assert re.fullmatch("(s?(ua)+)?", "".join(e.role[:1] for e in es if e.role is not None)), key
            assert all(e.text == "" and e.turn is None for e in es if e.edit == "I")
            assert sum({"K": 0, "R": 2, "D": 3, "I": 2}[e.edit] for e in es) <= costs[key]


def test_repair_against_sql_by_pieces(spark, tmp_path):
    r = random.Random(6)
    many = [(i % 9, i // 9, r.choice(["system", "user", "assistant", "tool"]), r.choice(["yes.", "no", " ", f"row {i % 40}!"])) for i in range(1500)]
    spark.createDataFrame(ROWS + many, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = sorted(con.execute(queries.SQL["op12_conversations"]).fetchall(), key=str)
    docs = spark.read.parquet(f"{tmp_path}/conversations.parquet")
    for piece in (4096, 16):
        assert sorted(map(tuple, conversations.audited(docs, piece).collect()), key=str) == want


def test_conversations_without_a_row_left(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = conversations.audited(spark.createDataFrame([(gone, 0, "user", "x.")], "conv_id long, turn long, role string, text string")).first()
    assert tuple(got) == (gone, 0, 0, 0, 0, 0, 0, "", sha(""))
    assert conversations.audited(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# -- op13 ---------------------------------------------------------------------------------------------------------------------------


def _graded(n):
    r = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        words = prose(i, r.randint(30, 120)).split()
        poor = i % 4 == 0
        if poor:
            kind = i % 3
            words = [w + "###" for w in words] if kind == 0 else [w.upper() + "!!" for w in words] if kind == 1 else words[:5] * 12
        rows.append((i, " ".join(words)))
        labels.append((i, int(not poor), 0))
    return rows, labels


def test_quality_is_told_apart_and_held_out(spark):
    rows, labels = _graded(1200)
    extra = [(5000, None), (5001, ""), (5002, rows[1][1]), (5002, rows[1][1]), (None, "x"), (5003, "long words " * 30_000)]
    docs = spark.createDataFrame([*rows, *extra], "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS key", "3 AS x", "4 AS y", "5 AS score", "6 AS quality", "7 AS __t")
    marks = spark.createDataFrame([*labels, (5001, None, 0), (5002, 7, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    got = gaussian.quality_scores(docs, marks).collect()
    assert len(got) == 1206 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    by = {r.doc_id: r for r in got}
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0) for r in got)
    held = [(by[i].predicted, q) for i, q, _ in labels if by[i].held_out]
    assert sum(p == q for p, q in held) / len(held) > 0.97
    assert by[5002].score == by[1].score and by[5000].score == by[5001].score


def test_the_discriminant_is_that_of_two_gaussians():
    r = np.random.default_rng(8)
    d = len(gaussian.NAMES)
    x = {0: r.normal(size=(500, d)) * 2 + 1, 1: r.normal(size=(900, d))}
    model = gaussian.shrunk({y: (float(len(v)), v.sum(0), v.T @ v) for y, v in x.items()}, 0.3, 0.05)
    point = r.normal(size=(5, d))
    own = {y: np.cov(v.T, bias=True) for y, v in x.items()}
    within = (500 * own[0] + 900 * own[1]) / 1400

    def density(y):
        s = 0.95 * (0.7 * own[y] + 0.3 * within) + 0.05 * np.diag(np.diag(within))
        away = point - x[y].mean(0)
        return np.log(len(x[y]) / 1400) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", away, np.linalg.inv(s), away)

    assert np.allclose(model.difference(point), density(1) - density(0))
    assert np.allclose(model.score(point), 1 / (1 + np.exp(density(0) - density(1))))


def test_moments_are_sums_over_all_rows(spark):
    r = np.random.default_rng(9)
    x = r.normal(size=(60, len(gaussian.NAMES)))
    rows = spark.createDataFrame([(v.tolist(), i % 3 % 2) for i, v in enumerate(x)], "x array<double>, y int").repartition(5)
    n, total, products = gaussian.moments(rows)[1]
    own = x[[i for i in range(60) if i % 3 % 2]]
    assert n == len(own) and np.allclose(total, own.sum(0)) and np.allclose(products, own.T @ own)


def test_statistics_of_odd_texts():
    assert gaussian.statistics(None) == gaussian.statistics(" \n\t") == [0.0] * len(gaussian.NAMES)
    for text in ("İ" * 10, "a", "\x1c\x1c", "  x", "!", "A" * 100_000, "#" * 5000):
        assert all(np.isfinite(gaussian.statistics(text))) and len(gaussian.statistics(text)) == len(gaussian.NAMES)


def test_nothing_is_learned_without_both_kinds(spark):
    docs = spark.createDataFrame([(i, "some words") for i in range(20)], "doc_id long, text string")
    for labels in ([], [(i, 1, 0) for i in range(20)], [(0, 1, 0), (1, 0, 0)]):
        got = gaussian.quality_scores(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
        assert len(got) == 20 and {r.score for r in got} == {0.5}


@pytest.mark.parametrize("name", ["op11_fill_in_middle", "op13_quality"])
def test_empty_tables(spark, tmp_path, name):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", ["op11_fill_in_middle", "op12_conversations"])
def test_against_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, "/root/testdata/sf0.001"), queries.SQL[name], "/root/testdata/sf0.001") == ""
