"""Plain Python versions of the corpus operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict


def words(text):
    return (text or "").encode().split()


def cut_windows(rows, window):
    held = [(d, words(t)) for d, t in rows]
    seen = Counter(tuple(w[i:i + window]) for _, w in held for i in range(len(w) - window + 1))
    out = []
    for d, w in held:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def jaccard_components(rows, k=3, pct=90):
    sets = []
    for _, t in rows:
        w = words((t or "").encode().lower().decode())
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    where = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in where[g])
        for j, n in common.items():
            if 100 * n >= pct * (len(s) + len(sets[j]) - n):
                top[find(i)] = find(j)
        for g in s:
            where[g].append(i)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            low[r] = min(low.get(r, d), d)
    return [(d, len(sets[i]), low.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def benchmark_matches(docs, items, k=5, pct=80):
    def normal(t):
        return [w.lower().strip(_PUNCTUATION) or w for w in words(t)]

    def bag(w, k=k):
        return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else Counter()

    out = []
    for d, t in docs:
        w = normal(t)
        for item, text in items:
            x = normal(text)
            if not x or not w:
                continue
            own, n = (bag(x), min(len(x), len(w))) if len(x) >= k else (Counter([tuple(x)]), len(x))
            best = None
            for s in range(len(w) - n + 1):
                b = bag(w[s:s + n]) if len(x) >= k else Counter([tuple(w[s:s + n])])
                a, u = sum((b & own).values()), sum((b | own).values())
                if a * 100 >= u * pct and (best is None or a / u > best[0]):
                    best = (a / u, s, n)
            if best:
                out.append((d, item, *best))
    return out


_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        worth = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(worth) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p in _PATTERNS.items() for m in re.finditer(p, text or "") if _valid(k, m.group())]


def unigram_scores(rows):
    held = [(d, d is not None and zlib.crc32(str(d).encode()) % 7 == 2, [*words((t or "").encode().lower().decode()), b"\n"]) for d, t in rows]
    c = Counter(w for _, out, ws in held if not out for w in ws)
    n, v = sum(c.values()), len(c)
    return [(d, out, len(ws), sum(w in c for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for d, out, ws in held]


def dropped_lines(rows, depth=2, rare=2):
    """(id, lines that stay) under the template rules."""
    big = float("inf")

    def tokens(line):
        own = [w for w in re.split(r"[ \t\x0b\x0c\r]+", line) if w]
        masked = ["<*>" if re.search("[0-9]", w) else w for w in own]
        return tuple(own if sum(w == "<*>" for w in masked) * 2 > len(own) else masked)

    seen = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(tokens(line)) >= 2:
                seen[tokens(line)].add(big if d is None else d)
    leaves = defaultdict(list)
    for t in seen:
        leaves[len(t), t[:depth]].append(t)
    templates = defaultdict(list)
    for leaf, own in leaves.items():
        held = Counter((i, w) for t in own for i, w in enumerate(t))
        for t in own:
            counts = [held[i, w] for i, w in enumerate(t)]
            median = sorted(counts)[len(t) // 2]
            literal = tuple((i, w) for (i, w), c in zip(enumerate(t), counts) if c > 1 and c * rare >= median and w != "<*>")
            if len(literal) >= 3 and 3 * len(literal) >= 2 * len(t):
                templates[leaf, literal].append(t)
    first = {t: min(ds) for t, ds in seen.items()}
    for own in templates.values():
        low = min(min(seen[t]) for t in own)
        for t in own:
            first[t] = min(first[t], low)
    return [(d, None if t is None else "\n".join(x for x in t.split("\n") if first.get(tokens(x), big) >= (big if d is None else d)))
            for d, t in rows]


def one_table_scores(rows, discount=0.75, strength=1.0):
    """(id, score) of a Pitman-Yor model of whole-word contexts where no bigram occurs twice in training: one table for each dish."""
    held = [(d, zlib.crc32(str(d).encode()) % 7 == 2, ["\n", "\n", *words(t.lower()), "\n"]) for d, t in rows]
    grams = [g for _, out, ws in held if not out for g in zip(ws, ws[1:], ws[2:])]
    pairs = [g[1:] for g in grams]
    assert len(set(pairs)) == len(pairs)
    two, one, root = Counter(g[:2] for g in grams), Counter(b for b, _ in pairs), Counter(w for _, w in pairs)
    n = sum(root.values())

    def p(a, b, w):
        x = (root[w] - discount if w in root else strength + discount * len(root)) / (strength + n)
        for is_dish, customers in (((b, w) in pairs_seen, one[b]), ((a, b, w) in grams_seen, two[a, b])):
            x = (is_dish * (1 - discount) + (strength + discount * customers) * x) / (strength + customers)
        return x

    pairs_seen, grams_seen = set(pairs), set(grams)
    return [(d, sum(math.log10(p(*g)) for g in zip(ws, ws[1:], ws[2:]))) for d, _, ws in held]
