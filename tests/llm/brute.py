"""Slow and plain versions of the operators, and awkward documents to hold them against."""

import random
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Columns that the operators use inside, under names of their own.
EXTRA = "node long, chunk_id string, component string, label_id long, key string, payload string, sequence_id string, kept string"


def words(text):
    return WORD.findall(text or "")


def fold(doc_id, n):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def awkward():
    """(doc_id, text): nulls, empty and very long texts, ties, copies and near copies, other scripts, odd blanks."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(1, 6))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage, base = prose(60), prose(120).split()
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "Two Words"), (5, "two words"), (6, "a b c d e"), (7, "A B C D E")]
    rows += [(None, "no id here at all"), (None, None), (8, "same id"), (8, "same id"), (8, "same id, other text")]
    rows += [(10, "x" * 5000 + " " + "y" * 300), (11, "a " * 400), (12, "  nbsp em \x1fctl \x85nel"), (13, "line\nline\n\nline\r\nother\x0bline\x0c")]
    rows += [(20 + i, prose(rng.randint(20, 90))) for i in range(40)]
    rows += [(70 + i, f"{prose(12)} {passage} {prose(9)}") for i in range(5)]
    rows += [(80 + i, " ".join(base)) for i in range(4)]
    for i in range(30):  # a chain of near copies, each a few words further
        at = rng.randrange(0, 115)
        base = base[:at] + [rng.choice(vocabulary) for _ in range(rng.choice([1, 1, 2, 5]))] + base[at + 1 :]
        rows.append((90 + i, " ".join(base)))
    rows += [(130, prose(6000)), (131, "z " + prose(500))]
    return rows


def frame(spark, rows, extra=True):
    full = [(*r, 7, None, "c", 1, "k", "p", "s", "t") for r in rows] if extra else rows
    return spark.createDataFrame(full, "doc_id long, text string" + (", " + EXTRA if extra else ""))


def shingles(text, n=5):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def jaccard_components(rows, percent=75):
    """[(doc_id, size, component)] by row, and the number of links."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders, links = defaultdict(list), 0
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x])
        for j, k in shared.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                links += 1
                parent[root(i)] = root(j)
        for x in s:
            holders[x].append(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        own = [x for x in (least.get(root(i)), doc_id) if x is not None]
        least[root(i)] = min(own) if own else None
    return [(d, len(s), least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))], links


def repeated(rows, window=35):
    """By row: the words and which of them lie in a repeated window."""
    texts = [words(t) for _, t in rows]
    many = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if many[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((w, gone))
    return out


def sort_key(row):
    return tuple((v is None, str(v)) for v in row)
