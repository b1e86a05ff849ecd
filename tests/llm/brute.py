"""Plain, slow versions of what the operators compute, over lists of (id, text)."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FOLDED = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SPACED = re.compile("[^\x20\x09-\x0d]+")


def folded(text):
    return FOLDED.findall((text or "").translate(ASCII_LOWER))


def spaced(text):
    return SPACED.findall(text or "")


def token_count(word, pieces, longest):
    """Greedy longest match; None where a part matches no piece."""
    n = at = 0
    while at < len(word):
        for end in range(min(len(word), at + longest), at, -1):
            if word[at:end] in pieces:
                break
        else:
            return None
        at, n = end, n + 1
    return n


def token_counts(rows, pieces):
    pieces = set(pieces)
    longest = max(map(len, pieces), default=0)
    out = []
    for i, text in rows:
        counts = [token_count("▁" + w, pieces, longest) for w in spaced(text)]
        unknown = counts.count(None)
        out.append((i, len(counts), sum(c for c in counts if c is not None) + unknown, unknown))
    return out


def _luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if k % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


PERSONAL = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+",
     lambda m: 13 <= len(re.sub("[^0-9]", "", m)) <= 19 and _luhn(re.sub("[^0-9]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
)


def personal(text):
    """Counts per kind, and the base spans as kind:start:end."""
    counts, spans = [], []
    for kind, pattern, valid in PERSONAL:
        found = [m for m in re.finditer(pattern, text or "", re.ASCII) if valid(m[0])]
        counts.append(len(found))
        spans += [f"{kind}:{m.start()}:{m.end()}" for m in found]
    return (*counts, hashlib.sha256(",".join(spans).encode()).hexdigest()), spans


PHRASES = (("mit", ["mit", "license"]), ("apache", ["apache", "license"]), ("gpl", ["general", "public", "license"]))


def base_licenses(text):
    words = folded(text)
    places = [
        (label, i) for label, phrase in PHRASES for i in range(len(words) - len(phrase) + 1)
        if words[i: i + len(phrase)] == phrase
    ]
    starts = [i for _, i in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for label, _ in places})))


def contamination(rows, items):
    windows = defaultdict(set)
    for item, text in items:
        words = folded(text)
        n = min(13, len(words))
        for at in range(len(words) - n + 1) if n else ():
            windows[tuple(words[at: at + n])].add(item)
    lengths = sorted({len(w) for w in windows})
    out = []
    for i, text in rows:
        words, hit, found = folded(text), set(), set()
        for n in lengths:
            for at in range(len(words) - n + 1):
                owners = windows.get(tuple(words[at: at + n]))
                if owners:
                    hit.update(range(at, at + n))
                    found |= owners
        named = ",".join(sorted(map(str, found)))
        out.append((i, len(words), len(hit), len(found), hashlib.sha256(named.encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(words)))
    return out


def shingles(text):
    words = spaced((text or "").translate(ASCII_LOWER))
    if not words:
        return set()
    return {tuple(words[i: i + 5]) for i in range(max(1, len(words) - 4))}


def near_duplicates(rows):
    """All pairs that share a shingle are compared."""
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    common = defaultdict(int)
    for ids in holders.values():
        for k, i in enumerate(ids):
            for j in ids[:k]:
                common[min(i, j), max(i, j)] += 1
    for (i, j), n in common.items():
        if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
            a, b = root(i), root(j)
            label[max(a, b)] = min(a, b)
    return [(i, len(sets[i]), root(i), root(i) == i) for i in sets]


def line_dedup(rows, least):
    """Texts without the lines of any run of at least so many words that stands earlier."""
    order = sorted({(i, zlib.crc32(t.encode()), t) for i, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0]))
    first, lines_of, gone = {}, {}, defaultdict(set)
    for row, (i, _, text) in enumerate(order):
        lines_of[row] = lines = text.split("\n")
        words = [len(line.split()) for line in lines]
        for a in range(len(lines)):
            total = 0
            for b in range(a, len(lines)):
                total += words[b]
                if total >= least:
                    run = tuple(lines[a: b + 1])
                    if run in first:
                        if first[run] < (row, a):
                            gone[row].update(range(a, b + 1))
                    else:
                        first[run] = (row, a)
    texts = {}
    for row, (i, _, text) in enumerate(order):
        kept = [line for k, line in enumerate(lines_of[row]) if k not in gone[row]]
        texts[i, text] = (len(lines_of[row]), len(gone[row]), "\n".join(kept))
    return [(i, *(texts[i, t] if t is not None else (0, 0, None))) for i, t in rows]


def ranked_search(rows, items, k):
    texts = [(i, folded(t)) for i, t in rows]
    texts = [(i, w) for i, w in texts if w]
    n_docs, length = len(texts), sum(len(w) for _, w in texts)
    df = Counter(term for _, w in texts for term in set(w))
    out = []
    for item, text in items:
        terms, scored = set(folded(text)), []
        for i, w in texts:
            counts, score = Counter(w), 0
            m = 50 + (50 * len(w) * n_docs) // length
            for t in terms & counts.keys():
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += weight * ((10**9 * counts[t]) // (1000 * counts[t] + 20 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, rank + 1, i, -score) for rank, (score, _, i) in enumerate(scored[:k])]
    return out


LETTERS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def source_divergence(rows, least, top):
    """``rows`` are (text, lang, source)."""
    rows = [(LETTERS.findall((t or "").translate(ASCII_LOWER)), a or "", b or "") for t, a, b in rows]
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for words, lang, source in rows:
        groups[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in docs:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        counts = {s: c for (a, s), c in groups.items() if a == lang}

        def shares(count):
            total = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + (10**9 * (count[t] + 2)) // total for t in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(sum(counts.values(), Counter()))
        for s in counts:
            pairs = [(sum((x - y) ** 2 // (x + y) for x, y in ((p[s][t], p[o][t]) for t in kept)), o) for o in counts if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found[:most])]
    return out


def nearest(vectors, queries, k):
    """``vectors`` are distinct (id, list); scores in double precision."""
    valid = [(i, np.array(v, dtype=float) / max(map(abs, v))) for i, v in vectors
             if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i, v in valid:
        if i in queries:
            others = [(-(v @ w) / (np.linalg.norm(v) * np.linalg.norm(w)), j) for j, w in valid if j != i and len(w) == len(v)]
            out[i] = [(j, -s) for s, j in sorted((round(s, 12), j) for s, j in others)[:k]]
    return out
