"""Plain Python versions of the operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def pii(text):
    """kind:start:end of the base spans, by kind, and their counts."""
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    found, counts = [], {}
    for kind, (rule, good) in rules.items():
        own = [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(rule, text) if good(m.group())]
        counts[f"n_{kind}"] = len(own)
        found += own
    return found, counts


def scores(seeds, places, rounds, sure, least, trust):
    """(kind, pattern, value) -> score after some rounds."""
    graph = {x: 0.0 for x in places} | {x: 1.0 for x in seeds}
    for _ in range(rounds):
        by = defaultdict(list)
        for (k, p, _), x in graph.items():
            by[k, p].append(x)
        worth = {}
        for at, xs in by.items():
            known = sum(x >= sure for x in xs)
            if known >= least and sum(xs) / len(xs) >= trust:
                worth[at] = sum(xs) / len(xs) * math.log2(1 + known) / (1 + math.log2(1 + known))
        doubt = defaultdict(lambda: 1.0)
        for (k, p, v), x in graph.items():
            if x < 1 and (k, p) in worth:
                doubt[k, v] *= max(1 - worth[k, p], 1e-9)
        graph = {(k, p, v): max(x, 1 - doubt[k, v]) if (k, v) in doubt else x for (k, p, v), x in graph.items()}
    return graph


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    repeat = {i + d for i, w in enumerate(windows) if many[w] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeat), "base_failed": n < 50 or 100 * len(repeat) > 50 * n,
    }


def kept(rows):
    """doc_id -> whether quality rules keep it. rows: doc_id, text, lang, source."""
    from glossworks.llm.quality import PRIOR, RULES, SPREAD

    measures, good = {}, {}
    for doc, text, lang, source, *_ in rows:
        q = quality(text)
        lines = sum(1 for x in text.split("\n") if WORD.search(x))
        upper, letters = len(re.findall("[A-Z]", text)), len(re.findall("[A-Za-z]", text))
        per = lambda a, b: a / max(1, b)
        measures[doc] = {"symbol_share": per(q["n_symbols"], q["word_chars"]), "dup_line_share": per(q["n_dup_lines"], lines), "repeat_share": per(q["n_repeat_words"], q["n_words"]), "shout_share": per(upper, letters), "word_chars_mean": per(q["word_chars"], q["n_words"])}
        good[doc] = not q["base_failed"]

    def shares(docs, rule):
        step = RULES[rule][2]
        count = Counter(math.floor(m / step) if step < 1 else math.floor(math.log(max(m, 1.0)) / math.log(step)) for m in (measures[d][rule] for d in docs))
        return {b: n / len(docs) for b, n in count.items()}, len(docs)

    def blend(own, above):
        mine, n = own
        return {b: (mine.get(b, 0) * n + above.get(b, 0) * PRIOR) / (n + PRIOR) for b in mine.keys() | above.keys()}

    def limits(rule, lang, source):
        p, both, step = RULES[rule]
        level = lambda test: [r[0] for r in rows if good[r[0]] and test(r)]
        every = shares(level(lambda r: True), rule)[0]
        dist = blend(shares(level(lambda r: r[2] == lang and r[3] == source), rule), blend(shares(level(lambda r: r[2] == lang), rule), every))
        at, total = {}, 0.0
        for b in sorted(dist):
            total += dist[b]
            for x in (p, 0.5, 1 - p):
                if total >= x - 1e-9:
                    at.setdefault(x, b)
        edge = (lambda b: b * step) if step < 1 else (lambda b: step**b)
        high, low = edge(at[p] + 1), edge(at[1 - p])
        return (low - SPREAD * (edge(at[0.5] + 1) - low) if both else -1.0), high + SPREAD * (high - edge(at[0.5]))

    found = {}
    for doc, _, lang, source, *_ in rows:
        within = lambda rule: (lambda lo_hi: lo_hi[0] <= measures[doc][rule] <= lo_hi[1])(limits(rule, lang, source))  # noqa: B023, E731
        found[doc] = good[doc] and all(within(rule) for rule in RULES)
    return found


def fingerprint(text):
    words = WORD.findall((text or "").translate(UP))
    if not words:
        return 0
    grams = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def components(prints):
    """doc_id -> least doc_id reachable over fingerprints that differ in two bits or fewer."""
    by = defaultdict(list)
    for doc, fp in prints:
        by[fp].append(doc)
    keys, root = list(by), {}
    for k in keys:
        root[k] = k

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = defaultdict(list)
    for k in keys:
        least[find(k)] += by[k]
    return {d: min(x for x in least[find(k)] if x is not None) if any(x is not None for x in least[find(k)]) else None for k in keys for d in by[k]}


def contamination(docs, items):
    """docs: (doc_id, text); items: (item_id, text)."""
    split = lambda t: PLAIN_WORD.findall((t or "").translate(UP))
    windows = defaultdict(set)
    for item, text in items:
        w = split(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w = split(text)
        hit, held = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if own := windows.get(tuple(w[i : i + size])):
                    hit |= set(range(i, i + size))
                    held |= own
        out.append((doc, len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(map(str, held))).encode()).hexdigest(), bool(hit)))
    return out


def pfair(shares, period):
    """Slot by slot: the source (its place in shares) that earliest deadline first picks."""
    taken, out = [0] * len(shares), []
    for t in range(period):
        ready = [(-(-(k + 1) * period // s), i) for i, (k, s) in enumerate(zip(taken, shares, strict=True)) if k * period // s <= t]
        out.append(min(ready)[1])
        taken[out[-1]] += 1
    return out


def five_words(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_copies(texts):
    """Place -> least place reachable over pairs of similarity 0.8 or more."""
    sets, root = [five_words(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or (a and sets[j] and 5 * len(a & sets[j]) >= 4 * len(a | sets[j])):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(texts))]
