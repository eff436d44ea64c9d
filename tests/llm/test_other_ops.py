"""op2, op3, op5, op6, op7."""

import base64
import hashlib
import itertools
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from glossworks.llm import licenses, queries, secrets, tokens, toxicity, warc
from tests.llm.test_pipeline_ops import SCHEMA, TEXTS, prose


def test_warc_round_trip(spark):
    big, same = "é<p>" * 30_000, "y" * 1000
    rows = [(1, "http://a/", big), (2, "http://b/\r\nX: y", same), (3, None, same), (7, "u", same), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (8, "u", ""), (9, "u", big), (10, "u", "a\r\n\r\nb")]
    got = {r.page_id: r for r in warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert len(got) == len(rows)
    for page, _, html in rows:
        raw = (html or "").encode()
        assert (got[page].payload_bytes, got[page].payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
    assert {p: got[p].refers_to for p in got if got[p].record_type == "revisit"} == {1: 9, 2: 7, 3: 7}


def test_warc_chunks_carry_digests(spark, tmp_path):
    html = "".join(random.Random(1).choices("abcdef", k=50_000))
    planned = warc.plan(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string"))
    table = warc.read_chunks(warc.write_archives(warc.chunks(planned), str(tmp_path / "w")), str(tmp_path / "w"), with_data=True).orderBy("i").collect()
    assert len(table) == 4 and b"".join(r.data for r in table).decode() == html
    for r in table:
        assert r.digest == hashlib.sha1(html[: (r.i + 1) * warc.CHUNK].encode()).hexdigest()


def test_warc_ids_and_repeated_rows(spark):
    rows = [("None", "u", "a"), (None, "u", "b"), ("x>y\r\n z", "u", "c"), ("r", "u", "z" * 2000), ("r", "u", "z" * 2000), ("q", "u", "z" * 2000)]
    docs = spark.createDataFrame(rows, "page_id string, url string, html string").selectExpr("*", "1 AS id", "2 AS digest", "'k' AS kind", "3 AS i")
    got = warc.round_trip(docs).collect()
    assert sorted((str(r.page_id), r.record_type, r.refers_to) for r in got) == [("None", "response", None)] * 2 + [("q", "revisit", "r"), ("r", "response", None), ("r", "response", None), ("x>y\r\n z", "response", None)]


def test_warc_stretches_are_dealt_over_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "STRETCH", 1)
    pages = spark.createDataFrame([(i, "u", str(i) * 3000) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    stretches = warc.write_archives(warc.chunks(warc.plan(pages)), str(tmp_path / "w"))
    table = warc.read_chunks(stretches, str(tmp_path / "w"))
    assert stretches.count() >= 30 and table.select(F.spark_partition_id().alias("p")).distinct().count() > 10


@pytest.mark.parametrize("damage", ["cut", "short", "long", "garbage"])
def test_warc_damage_is_found(spark, tmp_path, damage):
    whole = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Target-URI: u\r\nWARC-Payload-Digest: sha1:" + base64.b32encode(hashlib.sha1(b"abc").digest()) + b"\r\nX-Payload-Length: 3\r\nContent-Length: %d\r\n\r\nHTTP/1.1 200 OK\r\n\r\nabc\r\n\r\n"
    size = {"short": 50, "long": 20}.get(damage, 22)
    member = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = member.compress(whole % size) + member.flush()
    data = {"cut": data[:-12], "garbage": b"\0" * 40}.get(damage, data)
    place = tmp_path / "a.warc.gz"
    place.write_bytes(data)
    stretches = spark.createDataFrame([(str(place), 0, len(data))], "path string, start long, end long")
    with pytest.raises(Exception, match="EOFError|ValueError|error|damaged"):
        warc.records(warc.read_chunks(stretches, str(tmp_path))).collect()


def test_warc_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("word_bpe_49k.json")


def test_token_counts_are_the_library_s(spark, tokenizer):
    from tokenizers import Tokenizer

    r = random.Random(3)
    letters = "abcdeéñß'’ \t\n\x1c\xa00123٣½<|endoftext|>ΣσςİŁ.,!?日本語кирил👍"
    texts = [t for t in TEXTS if t] + ["".join(r.choices(letters, k=r.randint(0, 60))) for _ in range(200)] + ["don't we'll 'tis ''s", "a<|endoftext|>b <|startoftext|>", "x" * 500]
    library = Tokenizer.from_file(tokenizer)
    rows = [(i, t) for i, t in enumerate([*texts, "", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for chunk in (1 << 16, 7):  # whole, and cut anywhere
        got = {x.doc_id: x for x in tokens.token_counts(docs, tokenizer, 50, chunk=chunk).collect()}
        assert len(got) == len(rows)
        for i, t in rows:
            n = len(library.encode(t or "", add_special_tokens=False).ids)
            assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 50), t


def test_a_long_text_without_white_space(spark, tokenizer):
    from tokenizers import Tokenizer

    text = "".join(random.Random(5).choices("abcdefé12.", k=1_000_000))
    rows = [(1, text), (1, text), (2, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS key", "3 AS n_tokens", "4 AS i", "5 AS piece")
    n = len(Tokenizer.from_file(tokenizer).encode(text, add_special_tokens=False).ids)
    assert sorted((r.doc_id, r.n_tokens) for r in tokens.token_counts(docs, tokenizer, 50).collect()) == [(1, n), (1, n), (2, 2)]


def test_composition_is_associative(tokenizer):
    units = tokens.units_of(tokenizer)
    a, b, c = (tokens.state_map(units, x) for x in ("the qu", "ick brow", "n fox's tail"))
    left, right = tokens.compose(units, tokens.compose(units, a, b), c), tokens.compose(units, a, tokens.compose(units, b, c))
    assert left == right


def test_license_blocks(spark):
    text = "\n".join(["Some prose about nothing.", "Licensed under the Apache License, Version 2.0.", "More prose.", "", "", "", "", "This work is licensed under the GNU General Public License, version 2.", "", "", "", "", "My driving license expired last week, sadly."])
    rows = [(1, text), (2, None), (3, ""), (4, licenses.TEMPLATES["MIT"].split("\n", 4)[4]), (1, text)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.license, r.exact) for r in got) == [(1, "Apache-2.0", True)] * 2 + [(1, "GPL-2.0", True)] * 2 + [(4, "MIT", True)]
    assert all(r.size_with < r.size_alone for r in got)
    first = next(r for r in got if r.license == "Apache-2.0")
    assert "Apache License" in text[first.block_start : first.block_end]
    assert licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS n", "3 AS license", "4 AS exact")).count() == len(got)


def _found(text):
    return [(r[2], r[5], r[6]) for r in licenses.licenses_of(text)]


def test_a_version_must_fit():
    assert _found("This work is licensed under the GNU General Public License, version 3.") == [("GPL-3.0", 0, True)]
    assert _found("This work is licensed under the GNU General Public License, version 7.") == []
    assert _found("This work is now licensed under the GNU General Public License, version 3.") == [("GPL-3.0", 1, False)]
    assert _found("This work is licensed under the GNU Lesser General Public License, version 3.") == [("LGPL-3.0", 0, True)]


def test_licenses_wherever_they_stand():
    for n in (0, 20, 60, 200, 3000):  # at the end of a line of any length
        assert _found(prose(n, n) + ". Licensed under the MIT License.") == [("MIT", 0, True)], n
    two = "Licensed under the MIT License.\nLicensed under the Apache License, Version 2.0."
    assert _found(two) == [("Apache-2.0", 0, True), ("MIT", 0, True)]
    four = "\n".join(["Licensed under the BSD 2-Clause License.", "Licensed under the BSD 3-Clause License.", two])
    assert [x[0] for x in _found(four)] == ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MIT"]
    for name, text in licenses.TEMPLATES.items():  # every notice by itself
        assert all(name in [x[0] for x in _found(line)] for line in text.split("\n"))
    words = "license warranty " * 20_000  # license words alone, in one sentence and in many
    assert _found(words + "Released under the ISC License. " + words.replace("warranty", "warranty.")) == [("ISC", 0, True)]


def test_licenses_against_every_template(spark):
    """Without compression: each part against each notice."""
    r = random.Random(9)
    notices = [(name, line) for name, text in licenses.TEMPLATES.items() for line in text.split("\n")]
    texts = [f"{prose(i, 30)}.\n{r.choice(notices)[1]}\n{prose(i + 1, 30)}. {r.choice(notices)[1]} {prose(i + 2, 9)}" for i in range(60)]

    def brute(text):
        held = set()
        for line in text.split("\n"):
            for name, notice in notices:
                if notice in line:
                    held.add(name)
        return held

    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS n", "3 AS license", "'x' AS exact")
    found = {}
    for row in licenses.scan(docs).where("exact").collect():
        found.setdefault(row.doc_id, set()).add(row.license)
    assert all(brute(t) <= found.get(i, set()) for i, t in rows)


def test_secrets_forest(spark):
    r = random.Random(4)
    hexes = ["".join(r.choices("0123456789abcdef", k=40)) for _ in range(80)]
    rows = [(i, f'{prose(i, 40)} token = "{h}" {prose(i + 1, 20)}', "s1") for i, h in enumerate(hexes)]
    rows += [(200 + i, f"{prose(i, 30)} {prose(i, 3).replace(' ', '-')}-page-{i:04d}-of-the-book {prose(i, 5)}", "s2") for i in range(80)] + [(900, None, None), (901, "", "s1")]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    kept = {x.doc_id for x in got if x.secret}
    assert kept == set(range(80)) and {x.doc_id for x in got} >= set(range(200, 280))
    one = next(x for x in got if x.doc_id == 5)
    assert rows[5][1][one.start : one.end] == one.value == hexes[5]


def test_secret_candidates_of_any_length(spark):
    key = "".join(random.Random(6).choices("ABCdef0123456789+/", k=5000))
    rows = [(1, f'api_key = "{key}"', "s"), (1, f'api_key = "{key}"', "s"), (2, "a " * 50_000 + "word-with-a-1-in-it", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS id", "'p' AS path", "2 AS value", "3 AS x", "4 AS at")
    got = secrets.scan(docs).collect()
    assert sorted((x.doc_id, len(x.value), x.secret) for x in got) == [(1, 5000, 1), (1, 5000, 1), (2, 19, 0)]


def test_secret_features_against_brute_force(spark):
    rows = [(1, 'river mill token = "riverMill00112233xy" wheel', "s"), (2, "river mill", None), (3, "mill wheel", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    words = secrets.dictionary(docs)
    assert {r.w: r.n for r in words.collect()} == {"river": 2, "mill": 3, "token": 1, "wheel": 2}
    pairs = secrets.transitions(words)
    assert pairs["ri"] == 2 and pairs["mi"] == 3 and pairs["to"] == 1
    got = secrets.features(secrets.candidates(docs), words).first()
    x = dict(zip(secrets.FEATURES, got.x, strict=True))
    assert x["length"] == 19 and abs(x["covered"] - 9 / 19) < 1e-9 and x["digits"] == 8 / 19 and x["named"] == x["assigned"] == x["quoted"] == 1.0
    assert abs(x["before_known"] - math.log1p(3)) < 1e-9 and abs(x["after_known"] - math.log1p(2)) < 1e-9 and x["line_words"] == 4


def _toxic_rows(n):
    r = random.Random(8)
    insults = ["gromk" + e for e in ("a", "el", "ion", "us", "ish", "ard", "en")]
    rows, labels = [], []
    for i in range(n):
        words = prose(i, 60).split()
        toxic = int(i % 5 == 0)
        for _ in range(4 * toxic):
            words.insert(r.randrange(len(words)), r.choice(insults))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return rows, labels


def test_toxicity_learns_stems_and_holds_out(spark):
    rows, labels = _toxic_rows(900)
    docs = spark.createDataFrame([*rows, (5000, None), (5001, ""), (5002, rows[0][1])], "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS key", "3 AS score", "4 AS high", "5 AS toxic")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, marks).collect()}
    assert len(got) == 903 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    held = [(got[i].predicted, t) for i, _, t in labels if got[i].held_out]
    assert sum(p == t for p, t in held) / len(held) > 0.97
    assert got[5000].predicted == got[5001].predicted == 0 and got[5002].score == got[0].score


def test_clauses_weigh_what_stands_about_a_stem():
    g = toxicity.Grammar({"gromk": 4.0})
    plain, aimed, negated, said = (g.features(t)[0] for t in ("what a gromkel", "you gromkel", "not a gromkel", "they said gromkel"))
    assert aimed > plain > negated and said < aimed
    assert g.features("nothing here") == g.features(None) == toxicity.NOTHING
    assert g.features("I kill you")[3] == 1.0 and g.features("gromk")[3] == 0.0
    long = "gromk. " * 50_000 + "x"
    assert abs(g.features(long)[1] - 4.0 * 50_000) < 1e-3


def test_the_composed_grammar_reads_as_its_machines_do():
    """Every clause of up to five symbols: the one table against the five machines read side by side, and against plain rules."""
    arcs, aimed = toxicity.compiled()
    machines = [toxicity.INSULTS, toxicity.THREATENED, toxicity.NEGATING, toxicity.REPORTING, toxicity.AIMING]
    for size in range(6):
        for clause in itertools.product(toxicity.SYMBOLS, repeat=size):
            state, cells, states, own = 0, [], [0] * 5, []
            for symbol in clause:
                state, cell = arcs[state][symbol]
                cells.append(cell)
                out = frozenset()
                for i, m in enumerate(machines):
                    states[i], marks = m.arcs[states[i], symbol]
                    out |= marks
                kind = next((k for k in ("insult", "threat") if k in out), None)
                own.append(toxicity.CELLS.index((kind, "negated" in out, "reported" in out)) if kind else -1)
            assert cells == own and aimed[state] == (toxicity.TARGET in clause)
            for i, symbol in enumerate(clause):
                if symbol in (toxicity.INSULT, toxicity.THREAT):
                    near, told = toxicity.NEGATION in clause[max(0, i - toxicity.REACH) : i], toxicity.REPORT in clause[:i]
                    assert toxicity.CELLS[cells[i]] == ("insult" if symbol == toxicity.INSULT else "threat", near, told)


def test_without_labels_nothing_is_learned(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    got = toxicity.toxicity(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert len(got) == 1 and got[0].predicted == 0


@pytest.mark.parametrize("name", ["op3_secret_scan", "op5_license_scan", "op6_toxicity", "op7_token_counts"])
def test_empty_tables(spark, tmp_path, name):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


def test_warc_many_repeated_digests_move_no_payload_by_digest(spark, monkeypatch):
    """Where repeated digests are too many to broadcast, the payloads are dealt by their own ids."""
    from glossworks.functions import common

    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    rows = [(i, "u", "z" * 2000 if i % 3 else str(i)) for i in range(40)] + [(None, "u", "z" * 2000), (3, "u", "again"), (1, "u", "z" * 2000)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    planned = warc.plan(docs)
    text = planned._jdf.queryExecution().toString()
    assert "__digest" not in "".join(line.partition("hashpartitioning")[2] for line in text.splitlines())
    got = {(r.page_id, r["__to"]) for r in planned.where("__bytes >= 1000").collect()}
    assert got == {(i, 38) for i in range(40) if i % 3 and i != 38} | {(38, None), (None, 38), (1, 38)} and planned.count() == len(rows)


def test_secret_neighbours_of_a_very_long_line(spark):
    key = "".join(random.Random(6).choices("abcdef0123456789", k=40))
    line = "river " + "- " * 5000 + f'token = "{key}" ' + "? " * 5000 + "mill wheel"
    found = secrets.candidates(spark.createDataFrame([(1, "x\n" + line + "\ny", "s")], "doc_id long, text string, source string")).first()
    assert (found.line_words, found.left, found.right, found.value) == (4, "river", "mill", key)
