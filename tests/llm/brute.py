"""Plain versions of the operators' contracts, one text or pair at a time."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

SPACED = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def words(text, pattern=SPACED, lower=False):
    if text is None:
        return []
    return pattern.findall(text.translate(_LOWER) if lower else text)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def contaminated(documents, benchmark, window=13):
    windows = defaultdict(set)
    for item, text in benchmark:
        w = words(text, ALNUM, True)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add("" if item is None else str(item))
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in documents:
        w = words(text, ALNUM, True)
        hit, items = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i : i + n]))
                if found:
                    hit.update(range(i, i + n))
                    items |= found
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(items), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def repeated(documents, window=20):
    """(doc_id, words, removed, digest of what is kept)."""
    seen, out = set(), []
    for doc, text in sorted(documents):
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def repeated_words(documents, window):
    """Words covered by a window that occurs at two places at least: {doc_id: set of word numbers}."""
    places = defaultdict(set)
    for doc, text in documents:
        w = words(text)
        for i in range(len(w) - window + 1):
            places[tuple(w[i : i + window])].add((doc, i))
    out = defaultdict(set)
    for found in places.values():
        if len(found) > 1:
            for doc, i in found:
                out[doc].update(range(i, i + window))
    return dict(out)


def shingles(text, n=5):
    w = words(text, SPACED, True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def components(nodes, links):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def near_copies(documents):
    sets = {doc: shingles(text) for doc, text in documents}
    having = defaultdict(list)
    for doc, s in sets.items():
        for x in s:
            having[x].append(doc)
    common = defaultdict(int)
    for docs in having.values():
        for i, a in enumerate(docs):
            for b in docs[i + 1 :]:
                common[min(a, b), max(a, b)] += 1
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    found = components(sets, links)
    return [(doc, len(s), found[doc], found[doc] == doc) for doc, s in sets.items()]


def near_vectors(rows, least=0.93):
    """rows: (vec_id, vector or None, label). (vec_id, links, component, kept)."""
    usable = {}
    for i, v, label in rows:
        if v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        v = np.array(v, float)
        if len(v) and np.linalg.norm(v) > 0:
            usable[i] = (v / np.linalg.norm(v), label)
    ids = sorted(usable)
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if usable[a][1] == usable[b][1] and len(usable[a][0]) == len(usable[b][0]):
                if usable[a][0] @ usable[b][0] >= least:
                    links.append((a, b))
    found = components([r[0] for r in rows], links)
    n = defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return [(i, n[i], found[i], found[i] == i) for i, _, _ in rows]


def top_inner(rows, k, is_query, scale=256):
    """rows: (vec_id, vector or None). (query_id, rank, vec_id, score)."""
    usable = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        x = [int(np.floor(scale * np.float64(c))) for c in v]
        usable[i] = min(x, usable.get(i, x))
    out = []
    for q, x in usable.items():
        if is_query(q):
            others = [(-sum(a * b for a, b in zip(x, y)), i) for i, y in usable.items() if i != q and len(y) == len(x)]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(others)[:k], 1)]
    return sorted(out)


def aligned_tokens(text, one, two, byte_of):
    """((id, bytes) of one's tokens, of two's), or two empty lists where their bytes are not those of the text."""
    if not text:
        return [], []
    a = one.encode(" " + text, add_special_tokens=False)
    first = [(i, bytes(byte_of[c] for c in t)) for i, t in zip(a.ids, a.tokens)]
    second = []
    for i in two.encode(text):
        piece = two.id_to_piece(i)
        second.append((i, bytes([int(piece[3:5], 16)]) if two.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    same = b"".join(t for _, t in first) == whole == b"".join(t for _, t in second)
    return (first, second) if same else ([], [])


def alignments(documents, one, two, byte_of):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    per, counts = [], defaultdict(int)
    for doc, text in documents:
        first, second = aligned_tokens(text, one, two, byte_of)
        spans = []
        for tokens in (first, second):
            at, own = 0, []
            for i, t in tokens:
                own.append((i, at, at + len(t)))
                at += len(t)
            spans.append(own)
        links, j = [], 0
        for i, lo, hi in spans[0]:
            while spans[1][j][2] <= lo:
                j += 1
            m = j
            while m < len(spans[1]) and spans[1][m][1] < hi:
                links.append((i, spans[1][m][0]))
                m += 1
        ends = sorted({s[2] for s in spans[0]} & {s[2] for s in spans[1]})
        cells = [[[], []] for _ in ends]
        for side, own in enumerate(spans):
            k = 0
            for i, _, hi in own:
                while ends[k] < hi:
                    k += 1
                cells[k][side].append(str(i))
        groups = ["|".join(map(",".join, cell)) for cell in cells]
        for p in set(links):
            counts[p] += 1
        per.append((doc, len(first), len(second), links, groups))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [
        (doc, a, b, len(g), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), ";".join(g))
        for doc, a, b, links, g in per
    ]
