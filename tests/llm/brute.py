"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def part(doc_id, parts):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % parts


def words(text, pattern="[^\x20\x09-\x0d]+"):
    return re.findall(pattern, (text or "").translate(LOWER))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())


def near_duplicates(rows, percent):
    """{doc_id: (n, component)} of rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                a0, b0 = root(a), root(b)
                label[max(a0, b0)] = min(a0, b0)
    return {i: (len(sets[i]), root(i)) for i in ids}


def contamination(docs, items, window=10):
    """[(n_words, n_hit, n_items, digest)] in the order of the documents."""
    pattern = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    windows = defaultdict(set)
    for item, text in items:
        w = words(text, pattern)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[i : i + k])].add(None if item is None else str(item))
    out = []
    for _, text in docs:
        w, hit, found = words(text, pattern), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
                    found |= windows[tuple(w[i : i + k])]
        ids = sorted(found - {None})
        out.append((len(w), len(hit), len(ids), sha256(",".join(ids).encode()).hexdigest()))
    return out


def secrets(text):
    """Base spans (start, kind index, end)."""
    text = text or ""
    kinds = (
        (r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 8),
        (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
        (r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
    )
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(kinds) for m in re.finditer(p, text) if ok(m))


def language_model(rows, steps=20, rounds=100, buckets=24):
    """[(n_tokens, n_known, train_tokens, base, score)] in the order of the rows."""
    texts = [[*words(t), None] for _, t in rows]
    parts = [part(i, 7) for i, _ in rows]

    def count(keep):
        one, two = Counter(), Counter()
        for t, p in zip(texts, parts, strict=True):
            if keep(p):
                one.update(t)
                two.update(zip([None, *t[:-1]], t, strict=True))
        return one, two

    one, two = count(lambda p: p not in (None, 2))
    main, pairs = count(lambda p: p not in (None, 2, 5))
    n, kinds, m = sum(one.values()), len(one), sum(main.values())
    step = lambda p: round(steps * math.log10(p)) if p > 0 else None
    back = lambda s: 0.0 if s is None else 10 ** (s / steps)
    bucket = lambda c: min(c.bit_length(), buckets - 1)
    seen = defaultdict(Counter)
    for t, p in zip(texts, parts, strict=True):
        if p == 5:
            for h, w in zip([None, *t[:-1]], t, strict=True):
                c = main[h]
                seen[bucket(c)][step(pairs[h, w] / c if c else 0), step(main[w] / m if m else 0)] += 1
    weights = {}
    for b in range(buckets):
        w = [1 / 3] * 3 if b else [0, 0.5, 0.5]
        first = [float(x > 0) for x in w]
        if b > 1 and b not in seen:
            w = weights[b - 1]
        for _ in range(rounds if b in seen else 0):
            got = first[:]
            for (p2, p1), times in seen[b].items():
                each = [w[0] * back(p2), w[1] * back(p1), w[2] / (kinds + 1)]
                got = [g + times * e / sum(each) for g, e in zip(got, each, strict=True)]
            w = [g / sum(got) for g in got]
        weights[b] = w
    out = []
    for t in texts:
        base = sum(math.log10((one[w] + 1) / (n + kinds + 1)) for w in t)
        score = 0.0
        for h, w in zip([None, *t[:-1]], t, strict=True):
            c, a = one[h], weights[bucket(one[h])]
            p = (a[0] * two[h, w] / c if c else 0) + (a[1] * one[w] / n if n else 0) + a[2] / (kinds + 1)
            score += math.log10(p)
        out.append((len(t), sum(one[w] > 0 for w in t), n, base, score))
    return out


def ranking(docs, items, k=20):
    """[(item, rank, doc_id, score)] of rows (id, text)."""
    pattern = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"
    counted = [(i, Counter(words(t, pattern))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counted:
            m = 75 + 25 * sum(c.values()) * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in words(text, pattern)
                if t in c
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return out


def _h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def _tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([_h(*at[i : i + 8]) for i in range(0, len(at), 8)])
    return levels


def _proof(levels, i, leaf):
    siblings = []
    for at in levels[:-1]:
        low = i // 8 * 8
        run = at[low : low + 8]
        siblings += run[: i - low] + run[i - low + 1 :]
        leaf, i = _h(*run[: i - low], leaf, *run[i - low + 1 :]), i // 8
    return siblings, leaf


def merkle(rows):
    """[(doc_id, leaf, subroot, root, proof, folded)] of rows (doc_id, text, lang, source, n_chars)."""

    def leaf(doc_id, text, lang, source, n_chars):
        values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
        return _h(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))

    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        now = text
        if text is not None and part(doc_id, 3) == 0:
            now = text.translate(LOWER)
        stored = leaf(doc_id, text, lang, source, n_chars)
        groups[lang].append((doc_id, stored, leaf(doc_id, now, lang, source, n_chars)))
    first = lambda v: (v is not None, v)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (first(r[0])[0], r[0] or 0, r[1]))
        trees[g] = _tree([r[1] for r in groups[g]])
    top = _tree([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for i, (doc_id, stored, now) in enumerate(groups[g]):
            low, folded = _proof(trees[g], i, now)
            high, folded = _proof(top, at, folded)
            out.append((doc_id, stored, trees[g][-1][0], top[-1][0], _h(*low, *high), folded))
    return out


def lines(rows, min_chars=40, min_docs=5):
    """[(doc_id, n_lines, n_dropped, kept text)] of rows (doc_id, text)."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc_id)
    keeper = {
        k: max((d for d in docs if d is not None), default=None) for k, docs in holders.items() if len(docs) >= min_docs
    }
    out = []
    for doc_id, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if key(x) not in keeper or keeper[key(x)] == doc_id]
        out.append((doc_id, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return out
