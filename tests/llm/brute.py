"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import math
import re
from collections import Counter

import xxhash


def words(text):
    return (text or "").encode().split()


def simhash(text, shingle=4):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [b" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(items, linked):
    """Union-find over all pairs; items are (id, value) rows; None ids allowed."""
    parent = list(range(len(items)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(items)):
        groups.setdefault(find(i), []).append(i)
    out = [None] * len(items)
    for members in groups.values():
        ids = [items[i][0] for i in members if items[i][0] is not None]
        for i in members:
            out[i] = min(ids) if ids else None
    return out


def remove_repeats(texts, window=35):
    """Per text: words, removed flags."""
    ws = [words(t) for t in texts]
    where = {}
    for d, w in enumerate(ws):
        for p in range(len(w) - window + 1):
            where.setdefault(b" ".join(w[p:p + window]), []).append((d, p))
    gone = [[False] * len(w) for w in ws]
    for places in where.values():
        if len(places) > 1:
            for d, p in places:
                gone[d][p:p + window] = [True] * window
    return ws, gone


def targets(sizes, weights=(1, 2, 3), cap=3):
    """Targets by resharing the excess in rounds; sizes: {source: words}, None last."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        rest, mass = total - sum(fixed.values()), sum(weight[s] for s in free)
        share = {s: rest * weight[s] / mass for s in free}
        above = [s for s in free if share[s] > cap * sizes[s] + 1e-9]
        if not above:
            return {**fixed, **share}
        fixed |= {s: cap * sizes[s] for s in above}


def statistics(text):
    """word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words."""
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            hit |= {i, i + 1, i + 2}
    return sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), dup, len(hit), len(w)


def drop_repeated_lines(rows, min_chars, min_docs):
    """(n_lines, n_dropped, kept text) of each (doc_id, text)."""
    def key(line):
        return "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    held = {}
    for r, (i, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            held.setdefault(key(line), {})[r] = float("-inf") if i is None else i
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        own = float("-inf") if i is None else i
        stay = [x for x in lines if len(k := key(x)) < min_chars or len(held[k]) < min_docs or max(held[k].values()) == own]
        out.append((len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def ranked(rows, items, k):
    """{(item, text): [(doc_id, score), ...]} by scoring every document."""
    def split(text):
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return [w for w in re.split("[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text) if w]

    docs = [(i, split(t)) for i, t in rows]
    docs = [(i, w, Counter(w)) for i, w in docs if w]
    n_docs, n_terms = len(docs), sum(len(w) for _, w, _ in docs)
    df = Counter(t for _, _, tf in docs for t in tf)
    out = {}
    for item, text in items:
        scored = []
        for i, w, tf in docs:
            m = 100 - 75 + (75 * len(w) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m))
                        for t in split(text) if tf[t])
            if score > 0:
                scored.append((-score, i is None, i))
        out[item, text] = [(i, -s) for s, _, i in sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k]]
    return out


def alignment(texts, a, b):
    """Per text: the groups as ([a ids], [b ids]), from the two tokenizers' own ids."""
    out = []
    for text in texts:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        to_byte = {}
        printable = [c for c in range(256) if 0x21 <= c <= 0x7E or 0xA1 <= c <= 0xAC or 0xAE <= c <= 0xFF]
        for c in printable:
            to_byte[chr(c)] = c
        for n, c in enumerate(x for x in range(256) if x not in printable):
            to_byte[chr(256 + n)] = c
        x = [bytes(to_byte[c] for c in a.id_to_token(i)) for i in ids_a]
        y = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
             for i in ids_b]
        if not text or b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
            out.append([])
            continue
        found, i, j, at_a, at_b, own = [], 0, 0, 0, 0, ([], [])
        while i < len(x) or j < len(y):
            if at_a <= at_b and i < len(x):
                own[0].append(ids_a[i])
                at_a += len(x[i])
                i += 1
            else:
                own[1].append(ids_b[j])
                at_b += len(y[j])
                j += 1
            if at_a == at_b and own[0] and own[1]:
                found.append(own)
                own = ([], [])
        out.append(found)
    return out


def link_counts(groups):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, the spelt groups."""
    links = [Counter((a, b) for x, y in doc for a in x for b in y) for doc in groups]
    count = Counter(pair for doc in links for pair in doc)
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    return [(sum(len(x) for x, _ in doc), sum(len(y) for _, y in doc), len(doc), sum(own.values()),
             sum(n for p, n in own.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in own.items()),
             ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in doc))
            for doc, own in zip(groups, links)]
