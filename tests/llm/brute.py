"""Plain Python versions of the corpus operators, for small tables."""

import collections
import hashlib
import re
import zlib

import numpy as np

LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NONSPACE = re.compile(r"[^\x20\x09-\x0D]+")
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]


def fold(text):
    return (text or "").encode().translate(LOW).decode()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def leaks(docs, items, window=10):
    known = collections.defaultdict(set)
    for i, t in items:
        ws = ALNUM.findall(fold(t))
        n = min(window, len(ws))
        for s in range(len(ws) - n + 1) if n else ():
            known[tuple(ws[s : s + n])].add(str(i) if i is not None else "")
    sizes, out = {len(x) for x in known}, []
    for d, t in docs:
        ws = ALNUM.findall(fold(t))
        hit, ids = set(), set()
        for n in sizes:
            for s in range(len(ws) - n + 1):
                if (k := tuple(ws[s : s + n])) in known:
                    hit.update(range(s, s + n))
                    ids |= known[k]
        out.append((d, len(ws), len(hit), sorted(ids), bool(hit)))
    return sorted(out, key=repr)


def components(docs, size=4, percent=85):
    sets = []
    for d, t in docs:
        w = NONSPACE.findall(fold(t))
        sets.append((d, {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()))
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inverted = collections.defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            inverted[x].append(i)
    for i, (d, s) in enumerate(sets):
        if d is None or not s:
            continue
        for j, n in collections.Counter(j for x in s for j in inverted[x] if j < i).items():
            e, other = sets[j]
            if e is not None and 100 * n >= percent * (len(s) + len(other) - n):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return sorted(((d, len(s), root(d) if d is not None else None) for d, s in sets), key=repr)


def repeats(docs, length=100):
    key = lambda r: (r[0] if r[0] is not None else 2**63 - 1, zlib.crc32((r[1] or "").encode()))
    first = {}
    for r in sorted(docs, key=key):
        b = (r[1] or "").encode()
        for i in range(len(b) - length + 1):
            first.setdefault(b[i : i + length], (key(r), i))
    out = []
    for r in docs:
        b = (r[1] or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] != (key(r), i):
                gone[i : i + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((r[0], len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), kept))
    return sorted(out, key=repr)


def licences(docs):
    out = []
    for d, t in docs:
        ws, starts, labels = ALNUM.findall(fold(t)), [], set()
        for phrase, label in PHRASES:
            p = phrase.split()
            for i in range(len(ws) - len(p) + 1):
                if ws[i : i + len(p)] == p:
                    starts.append(i)
                    labels.add(label)
        out.append((d, len(ws), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))))
    return sorted(out, key=repr)


def edited(docs):
    """(doc_id, n_chars, sha256 of the edited text, similarity to it, similarity to the next) by padded 5-word shingles."""
    order = sorted(docs, key=lambda r: (-(r[0] if r[0] is not None else -(10**18)), r[1] or ""))
    grams = lambda t: {tuple(w[max(0, j - 4) : j + 1]) for w in [t.split()] for j in range(len(w))}
    alike = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    out = []
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        cut = len(t) // 3
        e = t[: len(t) - cut] + nxt[:cut]
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), alike(grams(t), grams(e)), alike(grams(t), grams(nxt))))
    return out
