"""Plain versions of the operators' definitions, for small inputs."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold_case(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(fold_case(text))


def crc(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


class Sets:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, x, y):
        x, y = sorted((self.find(x), self.find(y)))
        self.parent[y] = x


def near_duplicates(rows, size, percent):
    """doc_id -> (n_shingles, component, kept) for rows (doc_id, text) with distinct ids."""
    sets = {}
    for doc, text in rows:
        w = words(text)
        sets[doc] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    s = Sets()
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            s.join(a, b)
    return {d: (len(x), s.find(d), s.find(d) == d) for d, x in sets.items()}


def repeats(rows, window=100):
    """doc_id -> (bytes, removed, spans, sha256, kept bytes) for rows (doc_id, text) with distinct ids."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - window + 1):
            s = raw[p : p + window]
            if s in seen:
                gone[p : p + window] = b"\1" * window
            seen.add(s)
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        out[doc] = (len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest(), kept)
    return out


def targets(sizes, weights=(1, 2, 3), cap=3):
    """source -> target by repeated resharing."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = total - sum(fixed.values())
        open_w = sum(w[s] for s in order if s not in fixed)
        share = {s: rest * w[s] / open_w for s in order if s not in fixed}
        over = [s for s, t in share.items() if t > cap * sizes[s]]
        if not over:
            return {**fixed, **share}
        for s in over:
            fixed[s] = cap * sizes[s]


def vector_links(rows, threshold):
    """vec_id -> (links, component, kept) for rows (vec_id, vector, label)."""
    import numpy as np

    s, links, by_label = Sets(), Counter(), defaultdict(list)
    for v, x, label in rows:
        s.find(v)
        if label is None or x is None or any(c is None or not np.isfinite(c) for c in x) or not any(x):
            continue
        by_label[label, len(x)].append((v, np.array(x, float) / np.linalg.norm(np.array(x, float))))
    for group in by_label.values():
        for (a, x), (b, y) in itertools.combinations(group, 2):
            if float(x @ y) >= threshold:
                links[a] += 1
                links[b] += 1
                s.join(a, b)
    return {v: (links[v], s.find(v), s.find(v) == v) for v, _, _ in rows}


# ---------------------------------------------------------------------------
# tries, quality counts, Merkle trees
# ---------------------------------------------------------------------------
def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def rebuilt(rows):
    """Turn lists by conversation, rebuilt from their base conversation, of (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append((turn is not None, turn or 0, sha(f"{len(role.encode())}:", role, text), (role, text)))
    turns = {c: [x[3] for x in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, own in turns.items():
        h = crc(c) % 9
        base = turns.get(c - (abs(c) % 5 if c > 0 else -(abs(c) % 5)), [])
        out[c] = tuple(base[:h] + own[h:])
    return out


def trie_nodes(turns):
    members, kids = defaultdict(list), defaultdict(list)
    for c, s in turns.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for s in members:
        if s:
            kids[s[:-1]].append(s)
    leaves, saved, out = {}, {}, []
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[k] for k in kids[s]) or 1
        saved[s] = sum(saved[k] for k in kids[s]) + ((len(members[s]) - 1) * len(s[-1][1].encode()) if s else 0)
        ends = ",".join(str(c) for c in sorted(members[s]) if len(turns[c]) == len(s))
        out.append((min(members[s]), len(s), min(members[s[:-1]]) if s else None, len(members[s]), len(kids[s]), leaves[s], saved[s], sha(ends)))
    return sorted(out, key=str)


def quality_counts(text):
    ws, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(ws) - 7):
        at[tuple(ws[i : i + 8])].append(i)
    covered = {j for starts in at.values() if len(starts) > 1 for i in starts for j in range(i, i + 8)}
    n_symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(ws), sum(map(len, ws)), n_symbols, len(lines) - len(set(lines)), len(covered)


def merkle_rows(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, text, lang, source, n_chars)."""

    def value(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(d, t, lang, s, n):
        return sha(*map(value, (d, s, lang, n, t)))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def path(tree, i):
        out = []
        for nodes in tree[:-1]:
            out.append(("".join(nodes[i ^ 1 : (i ^ 1) + 1]), i % 2))
            i //= 2
        return out

    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((leaf(*r), r))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        groups[lang].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        trees.append(levels([h for h, _ in groups[lang]]))
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, lang in enumerate(langs):
        for i, (h, (d, t, _, s, n)) in enumerate(groups[lang]):
            steps = path(trees[k], i) + path(top, k)
            node = leaf(d, t, lang, s, n if n is None or d is None or crc(d) % 7 else n + 1)
            for sibling, right in steps:
                node = sha(sibling, node) if right else sha(node, sibling)
            out.append((d, h, trees[k][-1][0], top[-1][0], sha(*[x for x, _ in steps]), node, node == top[-1][0]))
    return sorted(out, key=str)
