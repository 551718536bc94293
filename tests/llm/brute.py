"""Brute-force versions of the operators, and small inputs with every odd case."""

import random
import re
from collections import Counter, defaultdict

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = " \t\n\x0b\x0c\r"


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("aeioustrnlm") for _ in range(rng.randint(2, 8))) for _ in range(n))


def words(text):
    return WORD.findall((text or "").translate(LOW))


def shingles(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def probability_jaccard(a, b):
    keys = set(a) | set(b)
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in keys) for d in set(a) & set(b))


def groups(items, similar):
    """Smallest index of the component of each item."""
    parent = list(range(len(items)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if similar(items[i], items[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(items))]


def line_shingles(line):
    return frozenset(line[i : i + 3] for i in range(max(1, len(line) - 2)))


def dedup_lines(rows):
    """rows of (doc_id, text) in order -> texts without repeated lines."""
    seen = list(dict.fromkeys(line for _, t in rows for line in (t or "").split("\n") if line.strip(BLANK)))
    sets = [line_shingles(line) for line in seen]
    root = dict(zip(seen, groups(sets, lambda a, b: len(a & b) / len(a | b) >= 0.8)))
    taken, out = set(), []
    for _, t in rows:
        kept = []
        for line in (t or "").split("\n"):
            if line.strip(BLANK):
                if root[line] in taken:
                    continue
                taken.add(root[line])
            kept.append(line)
        out.append("\n".join(kept))
    return out


def repeated_bytes(rows):
    """rows of (doc_id, text) in order -> (n, removed, spans, kept bytes)."""
    seen, out = set(), []
    for _, text in rows:
        b = (text or "").encode()
        cover = bytearray(len(b))
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                cover[i : i + 100] = b"\x01" * 100
            seen.add(b[i : i + 100])
        kept = bytes(x for x, c in zip(b, cover) if not c)
        out.append((len(b), len(b) - len(kept), len([s for s in bytes(cover).split(b"\x00") if s]), kept))
    return out


def contamination(text, items, width=10):
    """n_words, n_hit and the items with occurring windows."""
    w, hit, found = words(text), set(), set()
    for item, item_text in items:
        iw = words(item_text)
        n = min(len(iw), width)
        windows = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if iw else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(item)
    return len(w), len(hit), found


def documents():
    """Rows (doc_id, text): copies, near copies, shared passages, odd texts."""
    rows = [(i, prose(i, 60)) for i in range(12)]
    passage = prose(99, 40)
    for i in range(12, 18):
        rows.append((i, prose(i, 20) + "\n" + passage + "\n" + prose(i + 100, 20)))
    base = prose(7, 120).split()
    for i in range(18, 24):
        near = list(base)
        near[(i * 17) % 120] = "changed"
        rows.append((i, " ".join(near)))
    rows += [(24, rows[0][1]), (25, rows[0][1]), (26, None), (27, ""), (28, " \n\n\t"), (29, "x"), (30, "short line\nshort line\n\nshort line")]
    rows += [(31, "é" * 300 + "\n" + "ü" * 120), (32, "é" * 300), (33, "ab " * 5000), (34, passage.upper()), (35, "Word." * 400)]
    return rows


def by_key(rows):
    out = defaultdict(list)
    for r in rows:
        out[r[0]].append(r)
    return out
