"""Token counts by finite-state compilation of a byte-pair tokenizer with word ends.

A word's byte-pair encoding has a local form: its last token is the one vocabulary
entry that ends there and stands beside the token before it without a merge
across them. What a further byte can do depends only on the longest suffix read
that still begins an entry, and on the last token and count at each place within
it. That is a state; its transitions (compiled when first met, then kept) carry
how many tokens the encoding gains or loses, and a second set of transitions ends
the word.

White space always returns the tokenizer to its start. So the state map of a
chunk of text is what precedes its first white space, the count between the
first and the last, and what follows the last; maps compose associatively, and a
scan over the chunks of a long text gives its count wherever it was cut.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_key

#: Characters in a chunk; longer texts are dealt over tasks.
CHUNK = 1 << 16
#: Entries that a worker remembers of words and of transitions before it starts anew.
REMEMBERED = 400_000
#: Unicode white space; str.split() also splits at the four separators below.
SPACE = re.compile("[\t\n\x0b\x0c\r \x85\xa0  -     　]+")
SEPARATORS = re.compile("[\x1c-\x1f]")


def _byte_letters() -> dict[int, str]:
    """The usual printable stand-ins of bytes in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTransducer:
    """Counts the tokens of one pre-token."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str):
        self.rank = {tuple(m): i for i, m in enumerate(merges)}
        self.end = end
        made = {"".join(m) for m in self.rank}
        inner = {t for t in made if not t.endswith(end)}
        self.letters = _byte_letters()
        self.inner = inner | set(self.letters.values())
        self.final = {t for t in made if t.endswith(end)} | {c + end for c in self.letters.values()}
        self.longest = max(len(t.removesuffix(end)) for t in self.inner | self.final)
        self.begins = {t.removesuffix(end)[:i] for t in self.inner | self.final for i in range(len(t.removesuffix(end)) + 1)}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.restart()

    def restart(self) -> None:
        """State 0: nothing read. A state is (suffix, ((last token, count so far less that at the end), ...)) by places from the end."""
        start = ("", (("", 0),))
        self.states, self.number = [start], {start: 0}
        self.next: dict[tuple[int, int], tuple[int, int]] = {}
        self.ends: dict[tuple[int, int], int] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        while len(symbols) > 1:
            best = min(range(len(symbols) - 1), key=lambda i: self.rank.get((symbols[i], symbols[i + 1]), 1 << 60))
            pair = (symbols[best], symbols[best + 1])
            if pair not in self.rank:
                break
            out, i = [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == pair:
                    out.append("".join(pair))
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def symbols(self, token: str) -> list[str]:
        return [*token[: -len(self.end) - 1], token[-len(self.end) - 1 :]] if token.endswith(self.end) else list(token)

    def apart(self, left: str, right: str) -> bool:
        """Whether the two stay two tokens side by side; alone, an entry must be reachable by its merges."""
        if (left, right) not in self.pairs:
            self.pairs[left, right] = self.merged([*self.symbols(left), *self.symbols(right)]) == ([left, right] if left else [right])
        return self.pairs[left, right]

    def last(self, state: int, letter: str, entries: set[str], end: str) -> tuple[str, int]:
        """The last token after a letter, and the count against that before the letter."""
        suffix, places = self.states[state]
        read = suffix + letter
        for size in range(min(len(read), len(places)), 0, -1):
            token = read[-size:] + end
            before, count = places[size - 1]
            if token in entries and self.apart(before, token):
                return token, count + 1
        raise AssertionError(f"no token ends {read!r}")

    def step(self, state: int, byte: int) -> tuple[int, int]:
        letter = self.letters[byte]
        token, gain = self.last(state, letter, self.inner, "")
        suffix, places = self.states[state]
        read, size = suffix + letter, len(suffix) + 1
        while read[-size:] not in self.begins if size else False:
            size -= 1
        to = (read[-size:] if size else "", ((token, 0), *((t, c - gain) for t, c in places[:size])))
        if to not in self.number:
            self.number[to] = len(self.states)
            self.states.append(to)
        self.next[state, byte] = (self.number[to], gain)
        return self.next[state, byte]

    def finish(self, state: int, byte: int) -> int:
        self.ends[state, byte] = self.last(state, self.letters[byte], self.final, self.end)[1]
        return self.ends[state, byte]

    def count(self, word: bytes) -> int:
        if len(self.next) > REMEMBERED:
            self.restart()
        state, total, known = 0, 0, self.next
        for byte in word[:-1]:
            state, gain = known.get((state, byte)) or self.step(state, byte)
            total += gain
        gain = self.ends.get((state, word[-1]))
        return total + (self.finish(state, word[-1]) if gain is None else gain)


class Units(dict):
    """white-space-delimited unit -> tokens."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model, kinds = spec["model"], [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if kinds != ["NFC", "Replace", "Lowercase"] or not split["invert"] or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError(f"{path}: not a lower-casing tokenizer with word ends")
        self.words = WordTransducer(model["vocab"], [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]], model["end_of_word_suffix"])
        self.find = regex.compile(split["pattern"]["Regex"]).findall
        self.added = re.compile("|".join(re.escape(t["content"]) for t in sorted(spec["added_tokens"], key=lambda t: -len(t["content"]))) or r"(?!)")

    def __missing__(self, unit: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        n = len(self.added.findall(unit)) if "<" in unit else 0
        for piece in self.added.split(unit) if n else [unit]:
            if piece.isascii():
                piece = piece.lower()
            else:
                piece = "".join(c.lower() for c in unicodedata.normalize("NFC", piece))  # letter by letter: no final sigma
            n += sum(self.words.count(w.encode("utf-8", "surrogatepass")) for w in self.find(piece))
        self[unit] = n
        return n

    def count(self, text: str) -> int:
        units = SPACE.split(text) if SEPARATORS.search(text) else text.split()
        return sum(map(self.__getitem__, units))


def state_map(units: Units, chunk: str) -> tuple[str, int | None, str]:
    """(head, count, tail); count is null, and head the whole chunk, where it has no white space."""
    first = SPACE.search(chunk)
    if not first:
        return chunk, None, ""
    cut = len(chunk)
    while cut and not SPACE.match(chunk, cut - 1):
        cut -= 1
    return chunk[: first.start()], units.count(chunk[first.end() : cut]), chunk[cut:]


def total(units: Units, state: tuple[str, int | None, str]) -> int:
    """The tokens of a text from its state map."""
    return units.count(state[0]) + (state[1] or 0) + units.count(state[2])


def compose(units: Units, a: tuple[str, int | None, str], b: tuple[str, int | None, str]) -> tuple[str, int | None, str]:
    """The state map of two chunks, a before b."""
    if a[1] is None:
        return a[0] + b[0], b[1], b[2]
    if b[1] is None:
        return a[0], a[1], a[2] + b[0]
    return a[0], a[1] + units.count(a[2] + b[0]) + b[1], b[2]


_units: dict[str, Units] = {}


def units_of(path: str) -> Units:
    if path not in _units:
        _units[path] = Units(path)
    return _units[path]


def token_counts(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """id_col, n_bytes, n_tokens, over_limit (n_tokens > limit) of each row.

    Every text is counted by state maps; one of more than chunk characters has
    several, which are dealt over tasks. path: the tokenizer's file, found on every
    executor. Null texts count as empty; rows of equal id and text are counted alike
    and all returned; an empty table gives an empty table.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    long = F.length(text) > chunk
    kind = docs.schema[id_col].dataType.simpleString()

    def short(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        units = units_of(path)
        for frame in frames:
            yield pd.DataFrame({"id": frame["id"], "n_bytes": frame["n_bytes"], "n_tokens": [total(units, state_map(units, t)) for t in frame["text"]]})

    def maps(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        units = units_of(path)
        for frame in frames:
            found = [state_map(units, t) for t in frame["piece"]]
            yield frame[["key", "i"]].assign(head=[x[0] for x in found], n=pd.array([x[1] for x in found], dtype="Int64"), tail=[x[2] for x in found])

    def scan(frame: pd.DataFrame) -> pd.DataFrame:
        """Neighbours compose pairwise until one map is left."""
        units = units_of(path)
        now = [(h, None if pd.isna(n) else int(n), t) for h, n, t in zip(*(frame.sort_values("i")[c] for c in ("head", "n", "tail")), strict=True)]
        while len(now) > 1:
            now = [compose(units, *now[i : i + 2]) if i + 1 < len(now) else now[i] for i in range(0, len(now), 2)]
        return pd.DataFrame({"key": [frame["key"].iloc[0]], "n_tokens": [total(units, now[0])]})

    n_bytes = F.octet_length(text).cast("long").alias("n_bytes")
    few = docs.where(~long).select(F.col(id_col).alias("id"), n_bytes, text.alias("text")).mapInPandas(short, f"id {kind}, n_bytes long, n_tokens long")
    far = docs.where(long).select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), n_bytes, text.alias("text"))
    pieces = far.dropDuplicates(["key"]).select("key", "text", F.posexplode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / chunk).cast("int"))).alias("i", "__at")).select("key", "i", F.substring("text", F.col("i") * chunk + 1, F.lit(chunk)).alias("piece"))
    of_long = pieces.repartition("key", "i").mapInPandas(maps, "key long, i int, head string, n long, tail string").groupBy("key").applyInPandas(scan, "key long, n_tokens long")
    many = far.select("id", "key", "n_bytes").join(of_long, "key").select("id", "n_bytes", "n_tokens")
    return few.unionByName(many).select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
