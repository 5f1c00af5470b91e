"""Plain Python versions of what the operators must return."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from fractions import Fraction

PLAIN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SPACED = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def plain(text):
    return PLAIN.findall((text or "").translate(LOWER))


def licenses(text, phrases):
    w, at, labels = plain(text), [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def deduplicated(rows, n=13):
    """rows: (id, text) to [(id, words, removed, kept)]."""
    words = [(i, SPACED.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - n + 1):
                g = tuple(w[k : k + n])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        if i is not None:
            for k in range(len(w) - n + 1):
                if first[tuple(w[k : k + n])] < i:
                    gone[k : k + n] = [True] * n
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), sum(gone), " ".join(kept)))
    return out


def quality(text):
    w = SPACED.findall(text or "")
    lines = [x for x in (text or "").split("\n") if SPACED.search(x)]
    seen = defaultdict(list)
    for k in range(len(w) - 4):
        seen[tuple(w[k : k + 5])].append(k)
    covered = set()
    for places in seen.values():
        if len(places) > 1:
            for k in places:
                covered |= set(range(k, k + 5))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def secrets(text):
    t = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.ASCII) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24])


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    t = text or ""
    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    digits = lambda x: re.sub("[^0-9]", "", x)
    out += [(m.start(), 2, "card", m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return sorted(out + [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m[0])) <= 15])


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)


def shingles(text, n=5):
    w = plain(text)
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def near(rows, least=Fraction(4, 5)):
    """[(id, text)] to [(class_id, n_links)] in order; ids may be null or repeated."""
    sets = [shingles(t) if i is not None else frozenset() for i, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and Fraction(both, len(sets[a] | sets[b])) >= least:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least_id = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least_id[find(a)] = min(least_id.get(find(a), i), i)
    return [(None if i is None else least_id[find(a)], links[a]) for a, (i, _) in enumerate(rows)]


def leaks(docs, items, least=Fraction(4, 5)):
    wanted = defaultdict(set)
    for i, t in items:
        if i is not None:
            wanted[i] |= shingles(t)
    lengths = {len(g) for s in wanted.values() for g in s}
    held = defaultdict(set)
    for i, t in docs:
        w = plain(t)
        if i is not None:
            held[i] |= {tuple(w[k : k + n]) for n in lengths for k in range(len(w) - n + 1)}
    return {(d, i, len(s & h), len(s)) for d, h in held.items() for i, s in wanted.items() if s and Fraction(len(s & h), len(s)) >= least}
