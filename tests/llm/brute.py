"""Plain versions of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = str.maketrans(UPPER, LOWER)
WHITE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LETTER_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def named(rows):
    return [(i, t or "") for i, t in rows if i is not None]


def similar(rows, size=5):
    """{id: (set size, component)}; ids must not repeat."""
    sets = {}
    for i, t in named(rows):
        w = WHITE_WORDS.findall(t.translate(FOLD))
        sets[i] = {tuple(w[s : s + size]) for s in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    above = {i: i for i in sets}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    names = sorted(sets)
    for n, a in enumerate(names):
        for b in names[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                above[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def without_windows(rows, window, items):
    """Rows of (id, n, removed, kept items) after the rule of earlier documents; `items` splits a text."""
    split = [(i, items(t)) for i, t in named(rows)]
    first = {}
    for i, w in sorted(split, key=lambda r: r[0]):
        for s in range(len(w) - window + 1):
            first.setdefault(tuple(w[s : s + window]), i)
    out = []
    for i, w in split:
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < i:
                gone.update(range(s, s + window))
        out.append((i, len(w), len(gone), [x for k, x in enumerate(w) if k not in gone]))
    return out


def contamination(rows, benchmark, size=13):
    windows = defaultdict(set)
    for i, t in named(benchmark):
        w = LETTER_WORDS.findall(t.translate(FOLD))
        n = min(size, len(w))
        for s in range(len(w) - n + 1) if w else ():
            windows[tuple(w[s : s + n])].add(str(i))
    out = []
    for i, t in named(rows):
        w, hit, items = LETTER_WORDS.findall(t.translate(FOLD)), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                found = windows.get(tuple(w[s : s + n]))
                if found:
                    hit.update(range(s, s + n))
                    items |= found
        out.append((i, len(w), len(hit), len(items), sha(",".join(sorted(items)).encode()), bool(hit) and 20 * len(hit) >= len(w)))
    return out


ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_secrets(text):
    t = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    count = lambda kind: sum(f[3] == kind for f in found)
    return count("assign"), count("access"), count("hex"), sha(",".join(f"{f[3]}:{f[0]}:{f[2]}" for f in sorted(found)).encode())


def removed_lines(rows, align, few=8, rarest=0.5, least=20):
    """(id, n_lines, n_removed) by the rule of rare lines; `align` gives the blocks of two line lists."""
    lines = []
    for i, t in named(rows):
        kept = [x.strip(" \t\r\x0b\x0c") for x in t.split("\n")]
        lines.append((i, [x for x in kept if x]))
    holders, rows_of, seqs = defaultdict(set), defaultdict(int), defaultdict(list)
    for n, (i, v) in enumerate(lines):
        seqs[i].append(v)
        for x in v:
            holders[x].add(i)
        for x in set(v):
            rows_of[x] += 1
    out = []
    for i, v in lines:
        first = {}
        for p, x in enumerate(v):
            first.setdefault(x, p)
        rank = sorted(first, key=lambda x: (min(255, rows_of[x]), first[x]))
        rare = set(rank[: math.ceil(rarest * len(rank))]) | {x for x in first if rows_of[x] <= few}
        partners = {min(holders[x]) for x in rare if len(x.encode()) >= least and min(holders[x]) < i}
        gone = set()
        shared = lambda seq: [p for p, x in enumerate(seq) if rows_of[x] > 1]
        at = shared(v)
        for a in partners:
            for theirs in seqs[a]:
                there = shared(theirs)
                for block in align([v[p] for p in at], at, [len(v[p].encode()) for p in at], [theirs[p] for p in there], there, least):
                    gone.update(block)
        out.append((i, len(v), len(gone)))
    return out
