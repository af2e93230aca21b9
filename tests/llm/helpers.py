"""Small tables with every awkward case, and plain Python versions of the operators."""

from __future__ import annotations

import random
import re
from collections import Counter

import xxhash

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")

#: Columns whose names the operators use themselves.
CLASH = ["doc", "score", "row", "id", "key", "hash", "ranges", "tokens", "epoch", "domain", "fp", "u", "digest", "kept"]


def prose(seed: int, words: int, lines: int = 4) -> str:
    rnd = random.Random(seed)
    w = ["".join(rnd.choice("abcdefghijklmnopé") for _ in range(rnd.randint(2, 8))) for _ in range(words)]
    cut = max(1, words // lines)
    return "\n".join(" ".join(w[i:i + cut]).capitalize() + "." for i in range(0, words, cut))


def documents(spark, rows, clash=True):
    """``rows`` of (doc_id, text); other columns filled in, with nulls among them."""
    data = [(i, t, [None, "en", "fr"][k % 3], [None, "s1", "s2", "s1"][k % 4], None if t is None else len(t), *([k] * len(CLASH) if clash else []))
            for k, (i, t) in enumerate(rows)]
    extra = "".join(f", `{c}` int" for c in CLASH) if clash else ""
    return spark.createDataFrame(data, f"doc_id long, text string, lang string, source string, n_chars long{extra}")


def awkward():
    """Null and repeated ids, null, empty, blank, very long texts, copies, near copies and repeated rows."""
    base = prose(1, 120)
    near = base.replace("é", "e", 1)
    return [(1, base), (2, base), (3, near), (4, None), (5, ""), (6, " \n\t\n"), (None, base), (None, prose(2, 60)), (7, prose(3, 80)),
            (7, prose(3, 80)), (7, prose(4, 70)), (8, "x"), (9, "ab cd ef"), (10, prose(5, 30_000, 900)), (11, "\n".join(["a b c"] * 40)),
            (12, prose(6, 90) + "\n" + base), (13, "1234 5678 !!! ???"), (14, "Ünïcödé " * 30), (15, "line\r\nends\r\nhere\x00\x0b ok")]


def alnum(text):
    return ALNUM.findall((text or "").translate(FOLD))


def contamination(docs, items, k=10):
    windows = {}
    for item, text in items:
        w = alnum(text)
        n = min(k, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    sizes = {len(x) for x in windows}
    out = []
    for doc, text in docs:
        w = alnum(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (who := windows.get(tuple(w[i:i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= who
        out.append((doc, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def simhash(text):
    w = SPACED.findall((text or "").translate(FOLD))
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    bits = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        bits.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in bits if 2 * bits[b] > len(shingles))


def groups(prints, budget=4):
    """Component number of each fingerprint in a list."""
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= budget:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def base_counts(text):
    w = SPACED.findall(text or "")
    c = Counter(zip(w, w[1:], w[2:]))
    repeated = {i + j for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in text or ""), dup, len(repeated), failed
