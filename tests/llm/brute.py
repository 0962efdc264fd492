"""Brute-force versions of the operators: plain loops over all rows."""

import hashlib
from collections import Counter

SPACE = b" \t\n\r\x0b\x0c"


def words(text, lower=False):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def sha(data):
    return hashlib.sha256(data).hexdigest()


def near_groups(rows, n=3, share=85):
    """{doc_id: (n_shingles, component_id)} by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = words(text, True)
        k = min(n, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    order = sorted(range(len(rows)), key=lambda i: len(sets[i]))
    for x, i in enumerate(order):
        for j in order[x + 1:]:
            a, b = sets[i], sets[j]
            if 100 * len(a) < share * len(b):
                break
            both = len(a & b)
            if a and 100 * both >= share * (len(a) + len(b) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)}


def _gone(units_of, rows, width):
    seen = Counter()
    units = [units_of(t) for _, t in rows]
    for u in units:
        seen.update(u[i:i + width] for i in range(len(u) - width + 1))
    for (d, _), u in zip(rows, units):
        gone = [False] * len(u)
        upto = 0
        for i in range(len(u) - width + 1):
            if seen[u[i:i + width]] > 1:
                for j in range(max(upto, i), i + width):
                    gone[j] = True
                upto = i + width
        yield d, u, gone


def substring(rows, width):
    """[(doc_id, n_words, n_removed, kept_sha256)]"""
    out = []
    for d, u, gone in _gone(lambda t: tuple(words(t)), rows, width):
        kept = [w for w, g in zip(u, gone) if not g]
        out.append((d, len(u), sum(gone), sha(b" ".join(kept))))
    return out


def suffix(rows, length):
    """[(doc_id, n_bytes, n_removed, n_spans, kept_sha256)]"""
    out = []
    for d, u, gone in _gone(lambda t: (t or "").encode(), rows, length):
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((d, len(u), sum(gone), spans, sha(bytes(b for b, g in zip(u, gone) if not g))))
    return out


def scores(rows, folds=7, fold=2):
    """{doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)}"""
    import math
    from zlib import crc32

    toks = {d: [*words(t, True), b""] for d, t in rows}
    held = {d: crc32(str(d).encode()) % folds == fold for d, _ in rows}
    count = Counter(w for d, t in toks.items() if not held[d] for w in t)
    n, v = sum(count.values()), len(count)
    return {d: (held[d], len(t), sum(count[w] > 0 for w in t), n,
                sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t)) for d, t in toks.items()}


def shingle_words(text, n=5):
    import re
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def leaks(docs, items, threshold=.8):
    out = []
    sets = [(i, shingle_words(t)) for i, t in items]
    for d, t in docs:
        have = shingle_words(t)
        out += [(d, i, len(s & have), len(s)) for i, s in sets
                if s and len(s & have) >= threshold * len(s) - 1e-9]
    return out


def variants(vocab):
    """{word: (form, root, n, n_near, form_n)} by trying every edit of every word."""
    letters = sorted({c for w in vocab for c in w})
    near = {}
    for w in vocab:
        found = set()
        for i in range(len(w) + 1 if len(w) < 100 else 1):
            found |= {w[:i] + c + w[i:] for c in letters}
            if i < len(w):
                found |= {w[:i] + c + w[i + 1:] for c in letters} | {w[:i] + w[i + 1:]}
        near[w] = sorted((found & vocab.keys()) - {w}, key=lambda o: (-vocab[o], o))
    form = {w: o[0] for w, o in near.items() if o and vocab[o[0]] >= 10 * vocab[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(near[w]), vocab[form[w]] if w in form else None)
            for w, n in vocab.items()}


def search(docs, items, top):
    """[(item_id, rank, doc_id, score)] by scoring every document for every item."""
    import math
    import re
    term = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: term.findall((t or "").translate(lower))
    found = [(d, w) for d, w in ((d, split(t)) for d, t in docs) if w]
    n_docs, total = len(found), sum(len(w) for _, w in found)
    df = Counter(t for _, w in found for t in set(w))
    out = []
    for item, text in {(i, t): None for i, t in items}:
        scored = []
        for d, w in found:
            tf, m = Counter(w), 75 + (25 * len(w) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((1000000000 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in split(text) if tf[t])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        scored.sort(key=lambda x: x[:3])
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(scored[:top])]
    return out
