"""Conversation structure repair by a survivor-coalescence Viterbi.

A sound conversation has an optional system row and then pairs of user and
assistant. Rows are kept, given another role, deleted, or preceded by inserted
rows at the least cost; of equally cheap edits the least in ASCII order counts.

The edits are found by a Viterbi search over four states (nothing yet, system,
user, assistant). Each state's survivor is a node of a backpointer tree whose nodes
count what refers to them. Where all survivors share an ancestor, what leads to it is
decided: it is emitted and forgotten, so that a search holds undecided rows
only. Ties are decided by comparing the undecided letters of both survivors,
which differ after their last common node. States that a rival beats in
whatever follows are dropped at once, so survivors meet soon.

Conversations are cut into pieces of `PIECE` turns, which tasks read in order, so
that one of any length is spread over tasks. What a piece does is a matrix over
entry and exit states: the least cost, and the rank of its letters among the
exits of one entry (two letter strings over the same rows never begin each
other, so ranks settle ties over pieces). Matrices are composed along each
conversation; each piece is then searched from its known entry to its known exit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK_CHARS, materialize, small

#: Turns of a piece; rows between two looks for a common ancestor.
PIECE, STEP = 4096, 64
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLED, DELETED, INSERTED, CUT_OFF = 2, 3, 2, 1
#: States: nothing yet, after a system row, after a user's, after an assistant's. Which state an initial leads to, and the roles given.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
GIVEN = {START: "user", SYSTEM: "user", ASSISTANT: "user", USER: "assistant"}
LEGAL = ("su", "ua", "au")
FAULTS = ("blank", "duplicate", "truncated", "illegal")
#: Inserts that lead from a state to each it can reach, none more than needed; and those that end a conversation.
INSERTS = {(p, q): n for p, to in ((START, (0, None, 1, 2)), (SYSTEM, (None, 0, 1, 2)), (USER, (None, None, 0, 1)), (ASSISTANT, (None, None, 1, 0))) for q, n in enumerate(to) if n is not None}
ENDING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
#: A state is beaten if a rival's cost and this number are below its own: the rival can do all that it can for so much more.
BEATEN = [(ASSISTANT, SYSTEM, 0), (ASSISTANT, START, DELETED), (ASSISTANT, USER, INSERTED), (USER, ASSISTANT, INSERTED), (USER, SYSTEM, INSERTED), (USER, START, INSERTED + DELETED), (START, SYSTEM, 0), (START, USER, INSERTED), (SYSTEM, USER, INSERTED)]


def _moves(initial: str, forced: bool, cut_off: bool) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, letters) of a row: inserts before it, then its own edit."""
    out = []
    for (p, mid), n in INSERTS.items():
        before, letters = INSERTED * n, INSERT * n
        out.append((p, mid, before + DELETED, letters + DELETE))
        if not forced:
            given = USER if mid != USER else ASSISTANT
            out.append((p, given, before + REROLED + cut_off * CUT_OFF, letters + REROLE))
            if (mid, initial) in NEXT:
                out.append((p, NEXT[mid, initial], before + cut_off * CUT_OFF, letters + KEEP))
    return out


MOVES = {(i, f, t): _moves(i, f, t) for i in "sua-" for f in (False, True) for t in (False, True)}


class Node:
    """A survivor's last row: the survivor before it, its letters, its row, and how many nodes and states refer to it."""

    __slots__ = ("depth", "letters", "parent", "refs", "row")

    def __init__(self, parent: Node | None, letters: str, row, depth: int):
        self.parent, self.letters, self.row, self.depth, self.refs = parent, letters, row, depth, 0
        if parent is not None:
            parent.refs += 1


def _release(node: Node | None) -> None:
    """One reference less; nodes that nothing refers to fall away."""
    while node is not None:
        node.refs -= 1
        if node.refs:
            return
        node.parent, node = None, node.parent


class Search:
    """Reads (initial, forced, cut_off, row) one by one from an entry state; gives decided (letters, row) in order."""

    def __init__(self, entry: int):
        root = Node(None, "", None, 0)
        self.tips: dict[int, tuple[int, Node]] = {entry: (0, root)}
        root.refs = 1
        self.read, self.held = 0, 0

    @staticmethod
    def _less(x: Node, x_letters: str, y: Node, y_letters: str) -> bool:
        """Whether x's undecided letters and x_letters come before y's: what stands after their last common node is compared."""
        while x is not y:
            x_letters, y_letters, x, y = x.letters, y.letters, x.parent, y.parent
        return x_letters < y_letters

    def push(self, initial: str, forced: bool, cut_off: bool, row) -> list[tuple[str, object]]:
        best: dict[int, tuple[int, Node, str]] = {}
        for p, q, cost, letters in MOVES[initial, forced, cut_off]:
            if p not in self.tips:
                continue
            before, node = self.tips[p]
            cost += before
            if q not in best or cost < best[q][0] or (cost == best[q][0] and self._less(node, letters, best[q][1], best[q][2])):
                best[q] = (cost, node, letters)
        for rival, beaten, more in BEATEN:
            if rival in best and beaten in best and best[rival][0] + more < best[beaten][0]:
                del best[beaten]
        old, self.tips = self.tips, {}
        for q, (cost, node, letters) in best.items():
            tip = Node(node, letters, row, node.depth + 1)
            tip.refs = 1
            self.tips[q] = (cost, tip)
        for _, node in old.values():
            _release(node)
        self.read += 1
        return self._decided() if self.read % STEP == 0 else []

    def _chain(self, tip: Node) -> list[Node]:
        chain = []
        while tip is not None:
            chain.append(tip)
            tip = tip.parent
        return chain[::-1]

    def _decided(self) -> list[tuple[str, object]]:
        """What leads to the last node that all survivors share: from the oldest on, while one node alone refers to the one before it."""
        chain = self._chain(next(iter(self.tips.values()))[1])
        self.held = max(self.held, len(chain))
        last = 0
        while last + 1 < len(chain) and chain[last].refs == 1:
            last += 1
        out = [(n.letters, n.row) for n in chain[: last + 1] if n.letters]
        root = chain[last]
        root.parent, root.letters, root.row = None, "", None  # the nodes before it fall away
        return out

    def finish(self, exit: int) -> list[tuple[str, object]]:
        """The rest of what leads to the exit state."""
        return [(n.letters, n.row) for n in self._chain(self.tips[exit][1]) if n.letters]


def step_matrix(matrix: list[tuple[int, int, int]], symbol: tuple[str, bool, bool]) -> list[tuple[int, int, int]]:
    """One row more for the (exit, cost, rank) entries of one entry state; ranks order letter strings over the same rows."""
    best: dict[int, tuple[int, int, str]] = {}
    known = {q: (c, r) for q, c, r in matrix}
    for p, q, cost, letters in MOVES[symbol]:
        if p in known:
            mine = (known[p][0] + cost, known[p][1], letters)
            if q not in best or mine < best[q]:
                best[q] = mine
    order = sorted(best, key=lambda q: best[q][1:])
    return [(q, best[q][0], rank) for rank, q in enumerate(order)]


def compose(left: list[tuple[int, int, int]], right: dict[int, list[tuple[int, int, int]]]) -> list[tuple[int, int, int, int]]:
    """(exit, cost, rank, state between) of one entry state over two pieces."""
    best: dict[int, tuple] = {}
    for p, cost, rank in left:
        for q, more, after in right.get(p, ()):
            mine = (cost + more, rank, after, p)
            if q not in best or mine < best[q]:
                best[q] = mine
    order = sorted(best, key=lambda q: best[q][1:3])
    return [(q, best[q][0], i, best[q][3]) for i, q in enumerate(order)]


# -- tables -------------------------------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """key (conv_id as text), turn, copy, role, text: rows dropped, emptied, without end marks, repeated, or given to the user by
    crc32(conv_id:turn) % 20. Nulls are one space, but for key and turn."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("string").alias("key"), F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"), spaced("text").alias("text"), code.alias("code")).where("code <> 0")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("key", "turn", F.explode(copies).alias("copy"), F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))


def _digest() -> Column:
    """Of conversation, role and text."""
    size = lambda c: F.coalesce(F.length(c).cast("string"), F.lit("null"))
    return F.md5(F.concat_ws("|", size("key"), size("role"), "key", "role", "text"))


def prepared(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """rows (key, turn, copy, role, text) and their piece, digest, letter (the role's first), initial (s, u, a or -), blank, cut_off, and later:
    whether role and text stand in an earlier turn of the conversation."""
    last, first = F.right(F.btrim("text", F.lit(BLANK_CHARS)), F.lit(1)), F.substring("role", 1, 1)
    rows = rows.select(
        "*", F.coalesce(F.floor(F.col("turn") / piece).cast("long"), F.lit(-(1 << 62)).cast("long")).alias("piece"), _digest().alias("digest"), first.alias("letter"),
        F.when(first.isin("s", "u", "a"), first).otherwise("-").alias("initial"), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut_off"),
    )
    turns = rows.groupBy("digest").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.bool_or(F.col("turn").isNull()).alias("none"))
    # only what stands in two turns is joined to the rows
    twice = turns.where((F.col("low") < F.col("high")) | (F.col("none") & F.col("low").isNotNull())).select(F.col("digest").alias("__d"), F.when(~F.col("none"), F.col("low")).alias("__first"))
    joined = rows.join(small(materialize(twice, "repeated-turns")), F.col("digest") == F.col("__d"), "left")
    later = F.col("__d").isNotNull() & F.col("turn").isNotNull() & (F.col("__first").isNull() | (F.col("__first") < F.col("turn")))
    return joined.withColumn("later", later).drop("__d", "__first")


#: The order of a conversation's rows; equal ones of a turn stand together.
ORDER = [F.asc_nulls_first, F.asc, F.asc, F.asc], ["turn", "role", "digest", "copy"]


def _order() -> list[Column]:
    return [way(c) for way, c in zip(*ORDER, strict=True)]


def _batched(rows: Iterator[dict], size: int = 5_000) -> Iterator[pd.DataFrame]:
    """Frames of size rows; what has been yielded isn't held."""
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pd.DataFrame(held, dtype=object)
            held = []
    if held:
        yield pd.DataFrame(held, dtype=object)


def _streamed(df: DataFrame, read: Callable[[Iterator], Iterator[dict]], schema: str) -> DataFrame:
    """read over the rows of each task, one by one and in their order."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _batched(read(row for frame in frames for row in frame.itertuples(index=False))):
            yield frame[names]

    names = [part.split()[0] for part in schema.split(", ")]
    return df.mapInPandas(run, schema)


def _fault(row, before: str | None) -> str:
    """A row's first fault; before: the digest of the row before it in its piece."""
    return "blank" if row.blank else "duplicate" if row.later or row.digest == before else "truncated" if row.cut_off else ""


def piece_matrices(rows: DataFrame) -> DataFrame:
    """key, piece, the counts of its faults, first and last (roles' letters) and matrix (entry, exit, cost, rank) of each piece."""

    def read(found: Iterator) -> Iterator[dict]:
        piece, matrix, before = None, {}, None

        def done() -> dict:
            return piece | {"matrix": [{"entry": p, "exit": q, "cost": c, "rank": r} for p, m in matrix.items() for q, c, r in m]}

        for row in found:
            if piece is None or (piece["key"], piece["piece"]) != (row.key, row.piece):
                if piece is not None:
                    yield done()
                piece, before = {"key": row.key, "piece": row.piece, **dict.fromkeys(FAULTS, 0), "first": row.letter, "last": None}, None
                matrix = {p: [(p, 0, 0)] for p in range(4)}
            fault, before = _fault(row, before), row.digest
            if fault:
                piece[fault] += 1
            piece["illegal"] += piece["last"] is not None and piece["last"] + row.letter not in LEGAL
            piece["last"] = row.letter
            matrix = {p: step_matrix(m, (row.initial, fault in ("blank", "duplicate"), fault == "truncated")) for p, m in matrix.items()}
        if piece is not None:
            yield done()

    narrow = rows.select("key", "piece", "turn", "role", "digest", "copy", "initial", "letter", "blank", "later", "cut_off")
    ordered = narrow.repartition("key", "piece").sortWithinPartitions("key", "piece", *_order())
    return _streamed(ordered, read, "key string, piece long, blank long, duplicate long, truncated long, illegal long, first string, last string, matrix array<struct<entry:int,exit:int,cost:long,rank:int>>")


def routes(pieces: DataFrame) -> DataFrame:
    """key, piece, entry, exit, ending (inserts after a conversation's last piece, else null) of each piece and, in that of the last, the
    conversation's cost and counts of faults (else null)."""

    def follow(run: list) -> list[dict]:
        state, between, totals, last = [(START, 0, 0)], [], dict.fromkeys(FAULTS, 0), None
        for row in run:
            right: dict[int, list] = {}
            for m in row.matrix:
                right.setdefault(m["entry"], []).append((m["exit"], m["cost"], m["rank"]))
            found = compose(state, right)
            between.append({q: p for q, _, _, p in found})
            state = [x[:3] for x in found]
            totals = {k: v + getattr(row, k) for k, v in totals.items()}
            totals["illegal"] += last is not None and last + row.first not in LEGAL
            last = row.last
        cost, _, exit = min((c + INSERTED * ENDING[q], r, q) for q, c, r in state)
        out = []
        for row, back in zip(reversed(run), reversed(between), strict=True):
            out.append({"key": row.key, "piece": row.piece, "entry": back[exit], "exit": exit, "ending": None, "cost": None, **dict.fromkeys(FAULTS)})
            exit = back[exit]
        out[0] |= {"ending": ENDING[out[0]["exit"]], "cost": cost, **totals}
        return out

    def read(found: Iterator) -> Iterator[dict]:
        run: list = []
        for row in found:
            if run and run[0].key != row.key:
                yield from follow(run)
                run = []
            run.append(row)
        if run:
            yield from follow(run)

    ordered = pieces.repartition("key").sortWithinPartitions("key", "piece")
    return _streamed(ordered, read, "key string, piece long, entry int, exit int, ending int, cost long, blank long, duplicate long, truncated long, illegal long")


def edits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """key, piece, seq, edit, turn, role, text of every edit in order: rows kept, re-roled or inserted with the role they have then, deleted
    ones with a null role. rows: as of prepared; found: as of routes. A piece's route comes before its rows in the task that reads it."""

    def read(found: Iterator) -> Iterator[dict]:
        route, search, state, seq, before = None, None, START, 0, None

        def told(decided: list) -> Iterator[dict]:
            nonlocal state, seq
            for letters, row in decided:
                for letter in letters:
                    role = None if letter == DELETE else row.role if letter == KEEP else GIVEN[state]
                    state = state if role is None else NEXT[state, role[:1]]
                    inserted = letter == INSERT
                    yield {"key": route.key, "piece": route.piece, "seq": seq, "edit": letter, "turn": None if inserted else row.turn, "role": role, "text": "" if inserted else None if role is None else row.text}
                    seq += 1

        def close() -> Iterator[dict]:
            yield from told(search.finish(int(route.exit)))
            yield from told([(INSERT * int(route.ending or 0), None)])

        for row in found:
            if row.data == 0:
                if search is not None:
                    yield from close()
                route, search, state, seq, before = row, Search(int(row.entry)), int(row.entry), 0, None
                continue
            fault, before = _fault(row, before), row.digest
            yield from told(search.push(row.initial, fault in ("blank", "duplicate"), fault == "truncated", row))
        if search is not None:
            yield from close()

    own = ["key", "piece", "turn", "role", "digest", "copy", "text", "initial", "blank", "later", "cut_off"]
    data = rows.select(*own, F.lit(1).alias("data"), *[F.lit(0).alias(c) for c in ("entry", "exit", "ending")])
    heads = found.select("key", "piece", *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in own[2:]], F.lit(0).alias("data"), "entry", "exit", F.coalesce("ending", F.lit(0)).alias("ending"))
    ordered = heads.unionByName(data).repartition("key", "piece").sortWithinPartitions("key", "piece", "data", *_order())
    # a number that may be null comes to pandas as a floating one: turns go as text
    ordered = ordered.withColumn("turn", F.col("turn").cast("string"))
    made = _streamed(ordered, read, "key string, piece long, seq long, edit string, turn string, role string, text string")
    return made.withColumn("turn", F.col("turn").cast("long"))


def repair(rows: DataFrame, piece: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """The edits of each conversation, and its key, cost and counts of faults. rows: key, turn, copy (orders equal rows of a turn), role, text.

    Nulls: a null key is a conversation of its own, null turns come first; role and
    text must not be null. Rows of one turn are ordered by role and a digest of
    role and text, repeated ones stand together and are duplicates; an empty text
    is blank; a text of any length is held only while its row is undecided; a
    conversation of any length is spread over tasks by turns. An empty table gives
    empty tables.
    """
    rows = materialize(prepared(rows, piece), "turns")
    found = materialize(routes(materialize(piece_matrices(rows), "matrices")), "routes")
    return edits(rows, found), found.where("cost IS NOT NULL").select("key", "cost", *FAULTS)


def digests(made: DataFrame) -> DataFrame:
    """key, audit (the edits' letters), repaired_sha256 (of role:text lines) from edits; lines are hashed as they come."""

    def read(found: Iterator) -> Iterator[dict]:
        key, letters, hashed, lines, begun = None, [], None, 0, False
        done = lambda: {"key": key, "audit": "".join(letters), "repaired_sha256": hashed.hexdigest()}
        for row in found:
            if not begun or row.key != key:
                if begun:
                    yield done()
                key, letters, hashed, lines, begun = row.key, [], hashlib.sha256(), 0, True
            letters.append(row.edit)
            if row.role is not None:
                hashed.update((("\n" if lines else "") + row.role + ":" + row.text).encode("utf-8", "surrogatepass"))
                lines += 1
        if begun:
            yield done()

    ordered = made.repartition("key").sortWithinPartitions("key", "piece", "seq")
    return _streamed(ordered.select("key", "edit", "role", "text"), read, "key string, audit string, repaired_sha256 string")


def gaps(rows: DataFrame) -> DataFrame:
    """key, gaps: turns missing between a conversation's first and last."""
    turns = rows.where("turn IS NOT NULL").select("key", "turn").distinct().groupBy("key").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count("*").alias("n"))
    return turns.select("key", (F.col("high") - F.col("low") + 1 - F.col("n")).alias("gaps"))


def audited(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation after damaged(); one without a
    row left has zeros, an empty audit and the empty text's hash. A null conv_id is a conversation of its own; see repair."""
    rows = damaged(conversations)
    made, totals = repair(rows, piece)
    every = conversations.select("conv_id").distinct().withColumn("key", F.col("conv_id").cast("string"))
    out = every
    for part in (totals, digests(made), gaps(rows)):
        part = part.withColumnRenamed("key", "__key")
        out = out.join(part, F.col("key").eqNullSafe(F.col("__key")), "left").drop("__key")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("conv_id", *map(zero, ("gaps", *FAULTS, "cost")), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
