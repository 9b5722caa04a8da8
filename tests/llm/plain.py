"""Plain versions of the operators over a few rows: (doc_id, text) pairs, null texts as None."""

import hashlib
import re
from collections import Counter, defaultdict

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def low(i):
    """A null doc_id loses against any other where the largest counts."""
    return float("-inf") if i is None else i


def exact(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc is None, doc or 0, doc))
    out = []
    for text, members in groups.items():
        keep = min(m[:3] for m in members)
        keep_id = next(m[3] for m in members if m[:3] == keep)
        out += [(m[3], keep_id, len(members), m[3] == keep_id, sha(text)) for m in members]
    return out


def key(line):
    return line.strip(SPACES).translate(LOWER)


def lines(rows, cut=False):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(doc)
    common = {k: max(h, key=low) for k, h in holders.items() if len(h) >= 3}
    out = []
    for doc, text in rows:
        parts = (text or "").split("\n")
        stay = [x for x in parts if common.get(key(x), doc) == doc]
        out.append((doc, "\n".join(stay)) if cut else (doc, len(parts), len(parts) - len(stay), sha("\n".join(stay))))
    return out


def shingles(text):
    words = [w.translate(LOWER) for w in WORD.findall(text or "")]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def near(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = root(i)
        least[r] = doc if r not in least else min(least[r], doc, key=low)
    return [(doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(rows)]


PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def valid(kind, value):
    digits = re.sub(r"[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in p.finditer(text or "") if valid(k, m[0])]


def quality(rows):
    """The figures of one text each; no line here is above a host's limit."""
    out = []
    for doc, text in rows:
        text = text or ""
        words = WORD.findall(text)
        grams = Counter(zip(words, words[1:], words[2:], strict=False))
        covered = {i + o for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for o in range(3)}
        raw = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        out.append((doc, len(words), sum(map(len, words)), symbols, len(raw) - len(set(raw)), len(covered), failed, not failed))
    return out
