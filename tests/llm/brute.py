"""Plain versions of the operators, for comparison."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def exact(rows, keep):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        best = (min if keep == "min" else max)(ids) if ids else None
        out.append((i, best, len(groups[t or ""]), i == best, sha(t or "")))
    return out


def shingles(text, size=5):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def near(rows, percent):
    """{doc_id: component} over all pairs."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= percent * len(sets[a] | sets[b]):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def strip_repeats(rows, window=13):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k:k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        if i is not None:
            for k in range(len(w) - window + 1):
                if first[tuple(w[k:k + window])] < i:
                    gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def contaminated(rows, items, share=0.8, reach=20, span=9):
    def tok(t):
        return [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]

    out = {}
    for d, t in rows:
        w = tok(t)
        for i, text in items:
            b = tok(text)
            if len(b) < span or d is None:
                continue
            size = min(reach, len(b))
            for shift in range(-len(b) + 1, len(w)):
                m = [0 <= shift + k < len(w) and w[shift + k] == b[k] for k in range(len(b))]
                if max(sum(m[s:s + size]) for s in range(len(b) - size + 1)) >= share * size:
                    out.setdefault(d, set()).add(i)
                    break
    return out


ASSIGN = re.compile(
    r"((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
    r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def base_spans(text):
    t = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{z}" for a, k, z in sorted(spans)]


def distance(a, b):
    """Letters more, less or other, or two neighbours swapped."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]
