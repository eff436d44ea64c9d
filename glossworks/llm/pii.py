"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Four rules (e-mail, IP address, card, phone) give the seed entities of each
text. Seeds induce lexical patterns by kind: the two words before an entity, the
one before it, the one after it, and the two about it. A pattern is worth the share
of its identifier-shaped fillers that are known, an unseen identifier what the
patterns about it are worth together; the two score each other over the aggregated
pattern-instance graph for a few rounds, and instances of high confidence become
spans where a trusted pattern is about them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, row_key

KINDS = ("email", "ip", "card", "phone")
#: The rules, written so that the same leftmost matches come without backtracking over long runs: an e-mail starts where
#: its run of characters does (or where the last match ended), a card is a whole run of 13 to 19 digits.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Identifier-shaped strings that the rules leave: addresses with a written-out or wide at sign, IPv6 or marked-up
#: addresses, digit groups without a plus or with other separators.
SHAPED = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,}+(?:@|＠|\(at\)|\[at\]|\{at\})[A-Za-z0-9-]++(?:(?:\.|\(dot\)|\[dot\])[A-Za-z0-9-]++)*+|(?<![0-9A-Za-z:.])[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){3,}+|(?<![0-9A-Za-z])\(?[0-9](?:[().\x20/\x2D]{0,3}[0-9]){6,}+(?![0-9A-Za-z])"
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Rounds of scoring, seeds that a pattern needs, and the confidences from which a pattern and an instance count.
ROUNDS, LEAST_SEEDS, PATTERN_SURE, INSTANCE_SURE = 3, 3, 0.8, 0.8
#: The two words before a span, the last of them, and the first word after it; numbers and marks of assignment don't count.
BEFORE, LAST, NEXT = r"(?<![^\s0-9])([^\s0-9]++\s++[^\s0-9]++)[\s:=(\x22]*+$", r"([^\s]+)$", r"^[\s,;:)\x22']*+([^\s0-9]++)"
PATTERNS = ("two before", "one before", "one after", "about")


def _luhn(value: Column) -> Column:
    digits = F.reverse(F.regexp_replace(value, "[^0-9]", ""))
    each = F.transform(F.filter(F.split(digits, ""), lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + (c.cast("int") * 2 >= 10).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return digits.between(9, 15)
    return F.lit(True)


def _let(value: Column, body) -> Column:
    """body of value, which is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, start: Column, merge, block: int = 256) -> Column:
    """For each value what merge makes of those before it; by blocks, so that what is appended to stays short in texts of very many spans."""

    def before(v: Column, first: Column) -> Column:
        """What precedes each of a few values, appended one by one."""
        kind = F.array(first)
        state = F.struct(first.alias("now"), F.slice(kind, 1, 0).alias("out"))
        return F.aggregate(v, state, lambda a, x: F.struct(merge(a["now"], x).alias("now"), F.concat(a["out"], F.array(a["now"])).alias("out")), lambda a: a["out"])

    def by_blocks(v: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / block).cast("int")), lambda c: F.slice(v, c * block + 1, block))
        return _let(parts, lambda p: _let(_prefix(p), lambda s: F.flatten(F.zip_with(p, s, before))))

    def _prefix(p: Column) -> Column:
        sums = F.transform(p, lambda b: F.aggregate(b, start, merge))
        state = F.struct(start.alias("now"), F.slice(F.array(start), 1, 0).alias("out"))
        return F.aggregate(sums, state, lambda a, x: F.struct(join(a["now"], x).alias("now"), F.concat(a["out"], F.array(a["now"])).alias("out")), lambda a: a["out"])

    join = getattr(merge, "join", merge)
    return F.when(F.size(values) == 0, F.slice(F.array(start), 1, 0)).otherwise(_let(values, by_blocks))


def _merging(step, join):
    """A merge of a state and a value, and of two states."""

    def merge(a: Column, x: Column) -> Column:
        return step(a, x)

    merge.join = join
    return merge


def _matches(found: str, gaps: str) -> Column:
    """array<struct<s, e, v, g, h>> from the matches and what stands before and after each, in code points."""
    before = F.slice(F.col(gaps), 1, F.size(found))
    lengths = F.zip_with(before, F.col(found), lambda g, m: F.length(g) + F.length(m))
    began = _running(lengths, F.lit(0), lambda a, x: a + x)
    pairs = F.arrays_zip(before.alias("g"), F.col(found).alias("m"), began.alias("at"), F.slice(F.col(gaps), 2, F.size(found)).alias("h"))
    spans = F.transform(pairs, lambda z: F.struct((z["at"] + F.length(z["g"])).alias("s"), (z["at"] + F.length(z["g"]) + F.length(z["m"])).alias("e"), z["m"].alias("v"), z["g"].alias("g"), z["h"].alias("h")))
    return F.when(F.size(found) == 0, F.array().cast("array<struct<s:int,e:int,v:string,g:string,h:string>>")).otherwise(spans)


def _apart(more: Column, base: Column) -> Column:
    """Those of more that overlap none of base: in the order of their starts, no base span before one ends after its start, and none
    after it starts before its end."""
    far = (1 << 31) - 1
    span = lambda o: lambda x: F.struct(x["s"].alias("s"), F.lit(o).alias("o"), x["e"].alias("e"), x["k"].alias("k"), x["v"].alias("v"), x["two"].alias("two"), x["next"].alias("next"))
    ends = _merging(lambda a, x: F.greatest(a, F.when(x["o"] == 0, x["e"]).otherwise(0)), F.greatest)
    starts = _merging(lambda a, x: F.least(a, F.when(x["o"] == 0, x["s"]).otherwise(far)), F.least)

    def kept(z: Column) -> Column:
        both = F.arrays_zip(z.alias("x"), _running(z, F.lit(0), ends).alias("end"), F.reverse(_running(F.reverse(z), F.lit(far), starts)).alias("start"))
        free = F.filter(both, lambda y: (y["x"]["o"] == 1) & (y["end"] <= y["x"]["s"]) & (y["start"] >= y["x"]["e"]))
        return F.transform(free, lambda y: F.struct(*[y["x"][c].alias(c) for c in ("k", "s", "e", "v", "two", "next")]))

    merged = F.sort_array(F.concat(F.transform(base, span(0)), F.transform(more, span(1))))
    return F.when((F.size(more) == 0) | (F.size(base) == 0), more).otherwise(_let(merged, kept))


def with_spans(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """keep, base: array<struct<k (place in KINDS), s, e, v, two (words before), next (word after)>>, more: the same of identifier-shaped strings beside base spans (k: -1)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rules = {"email": (EMAIL, text.contains("@")), "ip": (IP, text.contains(".")), "card": (CARD, F.lit(True)), "phone": (PHONE, text.contains("+")), "more": (SHAPED, F.lit(True))}
    # texts without a mark of a rule never meet its expression
    found = [F.when(mark, F.regexp_extract_all(text, F.lit(rule), 0)).otherwise(F.array().cast("array<string>")).alias(f"__m_{kind}") for kind, (rule, mark) in rules.items()]
    rows = docs.select(*keep, text.alias("__text"), *found)
    gaps = [F.when(F.size(f"__m_{kind}") > 0, F.split("__text", rule, -1)).alias(f"__g_{kind}") for kind, (rule, _) in rules.items()]
    rows = rows.select("*", *gaps)

    def spans(kind: str, k: int) -> Column:
        every = _matches(f"__m_{kind}", f"__g_{kind}")
        good = F.filter(every, lambda x: _valid(kind, x["v"]))
        two, after = lambda x: F.lower(F.regexp_extract(x["g"], BEFORE, 1)), lambda x: F.lower(F.regexp_extract(x["h"], NEXT, 1))
        return F.transform(good, lambda x: F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e"), x["v"].alias("v"), two(x).alias("two"), after(x).alias("next")))

    rows = rows.select(*keep, *[spans(kind, k).alias(f"__{kind}") for k, kind in enumerate(KINDS)], spans("more", -1).alias("__more"))
    rows = rows.select(*keep, F.concat(*[F.col(f"__{kind}") for kind in KINDS]).alias("base"), "__more")
    return rows.select(*keep, "base", _apart(F.col("__more"), F.col("base")).alias("more"))


def _patterns(x: str) -> Column:
    """array<struct<place in PATTERNS, words>> of a span."""
    two, after = F.col(f"{x}.two"), F.col(f"{x}.next")
    one = F.regexp_extract(two, LAST, 1)
    about = F.when((one != "") & (after != ""), F.concat_ws(" ", one, after)).otherwise("")
    found = F.array(*[F.struct(F.lit(i).alias("place"), w.alias("words")) for i, w in enumerate((two, one, after, about))])
    return F.filter(found, lambda p: p["words"] != "")


def _fits(kind: Column, value: Column) -> Column:
    """Whether an identifier-shaped string can be of a kind at all."""
    n = F.length(F.regexp_replace(value, "[^0-9]", ""))
    at = value.rlike(r"@|＠|\((?:at)\)|\[at\]|\{at\}")
    return F.when(kind == 0, at).when(kind == 1, ~at & (value.contains(":") | value.rlike(r"^[0-9]+(?:\.[0-9]+){3}$"))).when(kind == 2, ~at & n.between(13, 19)).otherwise(~at & n.between(7, 15) & value.rlike(r"[().\x20/-]"))


def _trusted(graph: DataFrame) -> DataFrame:
    """k, pattern, known, worth of the patterns that are trusted. graph: k, pattern, v, score."""
    scored = graph.groupBy("k", "pattern").agg(F.count_if(F.col("score") >= INSTANCE_SURE).alias("known"), F.avg("score").alias("worth"))
    return scored.where((F.col("known") >= LEAST_SEEDS) & (F.col("worth") >= PATTERN_SURE))


def score(seeds: DataFrame, places: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """k, pattern, v, score: the graph after some rounds, each pattern and instance once, however often they meet. seeds, places: k, pattern, v."""
    known = seeds.groupBy("k", "pattern", "v").agg(F.lit(1.0).alias("score"))
    graph = materialize(known.unionByName(places.groupBy("k", "pattern", "v").agg(F.lit(0.0).alias("score"))).groupBy("k", "pattern", "v").agg(F.max("score").alias("score")), "graph")
    for _ in range(rounds):
        # noisy or: what the trusted patterns about an unseen instance leave of doubt
        sure = F.col("worth") * F.log2(1 + F.col("known")) / (1 + F.log2(1 + F.col("known")))
        found = graph.where("score < 1").join(_trusted(graph), ["k", "pattern"]).groupBy("k", "v").agg((1 - F.exp(F.sum(F.log(F.greatest(1 - sure, F.lit(1e-9)))))).alias("new"))
        graph = materialize(graph.join(found, ["k", "v"], "left").select("k", "pattern", "v", F.greatest("score", F.coalesce("new", F.lit(0.0))).alias("score")), "graph")
    return graph


def discover(rows: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """key, k, s, e of further spans. rows: key, base, more as of with_spans."""
    seeds = rows.select(F.explode("base").alias("x")).select("x.k", "x.v", F.explode(_patterns("x")).alias("pattern"))
    kinds = F.explode(F.array(*[F.lit(i) for i in range(len(KINDS))])).alias("k")
    places = rows.select("key", F.explode("more").alias("x")).select("key", "x.s", "x.e", "x.v", _patterns("x").alias("patterns"), kinds).where(_fits(F.col("k"), F.col("v")))
    places = materialize(places.select("key", "s", "e", "v", "k", F.explode("patterns").alias("pattern")), "places")
    graph = score(seeds, places, rounds)
    sure = graph.where((F.col("score") >= INSTANCE_SURE) & (F.col("score") < 1)).join(_trusted(graph), ["k", "pattern"], "left_semi").select("k", "pattern", "v")
    taken = places.join(sure.distinct(), ["k", "pattern", "v"], "left_semi")
    return taken.groupBy("key", "s", "e").agg(F.min("k").alias("k")).select("key", "k", "s", "e")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, key (row_key), base and spans: array<struct<k (place in KINDS), s, e>>, sorted; s and e in code points, e exclusive.

    Spans hold the base ones and those that the patterns discover; a discovered
    one never overlaps a base one, and of two kinds it is the first. A null text is
    empty; rows of equal id and text get the same spans; a text of any length is
    read whole; an empty table gives an empty table.
    """
    rows = with_spans(docs.select(F.col(id_col).alias("__id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("__t")), ["__id", "key"], "__t")
    rows = materialize(rows, "spans")
    bare = lambda c: F.sort_array(F.transform(c, lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"))))
    further = discover(rows.where((F.size("base") > 0) | (F.size("more") > 0)).dropDuplicates(["key"]))
    further = further.groupBy("key").agg(F.collect_list(F.struct("k", "s", "e")).alias("further"))
    joined = rows.select("__id", "key", bare(F.col("base")).alias("base")).join(further, "key", "left")
    return joined.select(F.col("__id").alias(id_col), "key", "base", F.sort_array(F.concat("base", F.coalesce("further", F.array().cast("array<struct<k:int,s:int,e:int>>")))).alias("spans"))


def digest_text(spans: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """docs with every span replaced by [KIND]; length_col, if there, is the new length. Overlapping spans are all covered."""
    found = personal_data(docs, id_col, text_col).where(F.size("spans") > 0).dropDuplicates(["key"]).select(F.col("key").alias("__key"), F.col("spans").alias("__spans"))
    rows = docs.join(found, row_key(id_col, text_col) == F.col("__key"), "left")
    text, names = F.col(text_col), F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    order = F.sort_array(F.transform("__spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))

    def rebuilt(spans: Column) -> Column:
        covered = _running(F.transform(spans, lambda x: x["e"]), F.lit(0), lambda a, e: F.greatest(a, e))

        def piece(x: Column, at: Column) -> Column:
            gap = F.substring(text, at + 1, F.greatest(x["s"] - at, F.lit(0)))
            return F.when(x["e"] <= at, "").otherwise(F.concat(gap, F.element_at(names, x["k"] + 1)))

        end = F.array_max(F.transform(spans, lambda x: x["e"]))
        return F.concat(F.array_join(F.zip_with(spans, covered, piece), ""), F.substring(text, end + 1, F.greatest(F.length(text) - end, F.lit(0))))

    masked = _let(order, rebuilt)
    out = rows.withColumn(text_col, F.when(F.col("__spans").isNull(), text).otherwise(masked))
    if length_col and length_col in docs.columns:
        out = out.withColumn(length_col, F.when(F.col("__spans").isNull(), F.col(length_col)).otherwise(F.length(text_col)).cast(docs.schema[length_col].dataType))
    return out.select(*docs.columns)
