"""Plain Python versions of the operators, for small inputs."""

import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = "the and of er on th ing able or em ip sum dol re ti na".split()


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(words))


def documents(spark, rows, more="lang string, source string, n_chars bigint"):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(*r, *(("en", "src1") if len(r) == 2 else ()), len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, f"doc_id bigint, text string, {more}")


def components(nodes, links):
    low = {n: n for n in nodes}

    def top(n):
        while low[n] != n:
            n = low[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        low[b] = a
    return {n: top(n) for n in nodes}


def shingle_set(text, words=4):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1)))


def jaccard_groups(texts, percent=85, words=4):
    sets = {k: shingle_set(t, words) for k, t in texts.items()}
    keys = sorted(texts)
    links = [
        (a, b) for i, a in enumerate(keys) for b in keys[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return {k: len(s) for k, s in sets.items()}, components(keys, links)


def repeated(texts, length=100):
    """(bytes, removed, runs, digest of the rest) by doc_id, strings judged in order of doc_id and start."""
    first, out = {}, {}
    for k in sorted(texts):
        data = (texts[k] or "").encode()
        gone = [False] * len(data)
        for s in range(len(data) - length + 1):
            if first.setdefault(data[s : s + length], (k, s)) != (k, s):
                gone[s : s + length] = [True] * length
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[k] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def edits(item, text):
    """Fewest edits of item against any stretch of text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, t in enumerate(text):
            new.append(min(row[j] + (c != t), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _holds(kind, s):
    digits = [int(c) for c in re.sub("[^0-9]", "", s)]
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        twice = [d * 2 - 9 if d > 4 else d * 2 for d in digits[-2::-2]]
        return 12 <= len(digits) <= 19 and (sum(digits[::-2]) + sum(twice)) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    kinds = list(PII)
    found = [(m.start(), kinds.index(k), m.end()) for k, p in PII.items() for m in re.finditer(p, text or "") if _holds(k, m.group())]
    return [f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(found)]
