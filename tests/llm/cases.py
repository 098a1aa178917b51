"""Small document tables and plain-Python counterparts of the operators."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "size long, score double, label int, n long, gram long, slot int, text_key long"
LOWER = {c: c + 32 for c in range(65, 91)}
SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def prose(seed: int, n: int, vocabulary: int = 4000) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}é" if r.random() < 0.2 else f"word{r.randrange(vocabulary)}" for _ in range(n))


def edited(text: str, seed: int, share: float) -> str:
    r = random.Random(seed)
    return " ".join(f"edit{seed}x{i}" if r.random() < share else w for i, w in enumerate(text.split(" ")))


def odd_rows() -> list[tuple]:
    """Nulls, empty and blank texts, short ones, repeated rows, a long one, control characters, other scripts."""
    same = prose(1, 60)
    rows = [
        (1, same, "en", "a"),
        (2, same, "en", "b"),
        (2, same, "en", "b"),
        (3, None, "en", "a"),
        (4, "", None, "a"),
        (5, " \t\n \r\n", "en", None),
        (6, "one", "en", "a"),
        (7, "One", "en", "a"),
        (8, "one two", "en", "a"),
        (9, prose(2, 9000), "en", "long"),
        (10, "a\x00b \x1f \x7f c" * 40, "en", "a"),
        (11, "слово слово слово " * 40, None, None),
        (12, "字" * 300, "zh", "a"),
        (None, prose(3, 80), "en", "a"),
        (None, None, None, None),
        (13, prose(4, 80) + "\n" + prose(4, 80), "en", "a"),
        (14, "x " * 400, "en", "a"),
    ]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


def documents(spark, rows):
    return spark.createDataFrame([r if len(r) == 5 else (r[0], r[1], "en", "a", 1) for r in rows], SCHEMA)


def with_clashes(docs):
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in CLASHING.split(", ")])


def grams(text, n: int) -> frozenset:
    w = re.findall(SPACED, (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def components(rows, n: int, percent: int) -> dict:
    """doc_id -> smallest doc_id reached by links (all pairs compared)."""
    sets = [(i, grams(t, n)) for i, t, *_ in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            both = len(x & y)
            if both and 100 * both >= percent * (len(x) + len(y) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def contamination(rows, items) -> list[tuple]:
    words = lambda t: re.findall(ALNUM, (t or "").translate(LOWER))
    windows = []
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        windows += [(item, tuple(w[i : i + n])) for i in range(len(w) - n + 1)] if n else []
    out = []
    for doc, text, *_ in rows:
        w = words(text)
        hit, found = set(), set()
        for item, phrase in windows:
            n = len(phrase)
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) == phrase:
                    hit.update(range(i, i + n))
                    found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def base_counts(text) -> tuple:
    text = text or ""
    w = re.findall(SPACED, text)
    lines = [x for x in text.split("\n") if re.search(SPACED, x)]
    threes = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {k for i in range(len(w) - 2) if threes[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        len(w) < 50 or 100 * len(covered) > 50 * len(w),
    )


def repeated_bytes(rows, length: int = 100) -> dict:
    """doc_id -> (bytes, removed, spans, sha256 of the rest); ids must be distinct."""
    seen, out = set(), {}
    for doc, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            s = raw[p : p + length]
            if s in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(s)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        rest = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out
