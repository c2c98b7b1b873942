"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base_rules(text: str | None) -> tuple:
    text = text or ""
    words = SPACED.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(grams)
    repeat = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
    n = len(words)
    failed = n < 50 or 100 * len(repeat) > 50 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeat), failed


def contamination(docs: list[tuple], items: list[tuple], n: int = 10) -> dict:
    windows: dict[tuple, set[str]] = {}
    for item, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        size = min(n, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(str(item))
    out = {}
    for doc, text in docs:
        words = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if (w := tuple(words[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[w]
        out[doc] = (len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def jaccard_components(docs: list[tuple], n: int = 3, percent: int = 85) -> dict:
    sets = {}
    for doc, text in docs:
        words = SPACED.findall((text or "").translate(LOWER))
        sets[doc] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by: dict[tuple, list] = {}
    for d in sorted(sets):
        others = {o for g in sets[d] for o in by.get(g, ())}
        for o in others:
            both = len(sets[d] & sets[o])
            if 100 * both >= percent * (len(sets[d]) + len(sets[o]) - both):
                a, b = sorted((find(d), find(o)))
                root[b] = a
        for g in sets[d]:
            by.setdefault(g, []).append(d)
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


def repeated_bytes(docs: list[tuple], k: int = 50) -> dict:
    seen: dict[bytes, int] = {}
    data = {d: (t or "").encode() for d, t in docs}
    for d in sorted(data):
        for i in range(len(data[d]) - k + 1):
            seen.setdefault(data[d][i : i + k], d)
    out = {}
    for d, b in data.items():
        covered = bytearray(len(b))
        for i in range(len(b) - k + 1):
            if seen[b[i : i + k]] < d:
                covered[i : i + k] = b"\1" * k
        spans = len(re.findall(rb"\x01+", bytes(covered)))
        rest = bytes(x for x, c in zip(b, covered, strict=True) if not c)
        out[d] = (len(b), sum(covered), spans, hashlib.sha256(rest).hexdigest())
    return out


def filter_masks(docs: list[tuple]) -> list[tuple]:
    """(part, bits of the failed filters A to E) of each (doc_id, text, lang)."""
    ids: dict[str, list] = {}
    for doc, text, _ in docs:
        ids.setdefault(text or "", []).append(doc)
    out = []
    for doc, text, lang in docs:
        text = text or ""
        words = SPACED.findall(text)
        fails = (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            any(c in "#$%&*|" for c in text), doc is not None and any(d is not None and d < doc for d in ids[text]),
        )
        out.append((lang or "", sum(1 << i for i, f in enumerate(fails) if f)))
    return out


def filter_audit(docs: list[tuple], good: set, toxic: set) -> dict:
    import itertools

    masks = filter_masks(docs)
    rows = [(part, bits, doc in good, doc in toxic) for (part, bits), (doc, *_) in zip(masks, docs, strict=True)]
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        removed_in_all = Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                bit = 1 << "ABCDE".index(f)
                gone = [r for r in left if r[1] & bit]
                failing = [r for r in own if r[1] & bit]
                left = [r for r in left if not r[1] & bit]
                removed_in_all[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(r[1] == bit for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone), f
                ]
        for key, values in out.items():
            if key[0] == part:
                values[-1] = removed_in_all[values[-1]] if isinstance(values[-1], str) else values[-1]
    return {k: tuple(v) for k, v in out.items()}


def ranked(docs: list[tuple], items: list[tuple], top: int = 10) -> dict:
    """(item_id, text) -> [(doc_id, score), ...] by full scoring."""
    import math

    words = [ALNUM.findall((t or "").translate(LOWER)) for _, t in docs]
    n, total = sum(bool(w) for w in words), sum(map(len, words))
    counts = [Counter(w) for w in words]
    df = Counter(t for c in counts for t in c)
    out = {}
    for item, text in items:
        terms = Counter(ALNUM.findall((text or "").translate(LOWER)))
        scores = []
        for (doc, _), c, w in zip(docs, counts, words, strict=True):
            score = 0
            for t, repeats in terms.items():
                if c[t]:
                    m = 25 + 75 * len(w) * n // total
                    score += repeats * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out[item, text or ""] = [(None if unnamed else doc, -s) for s, unnamed, doc in sorted(scores)[:top]]
    return out


def article_text(page: str | None) -> str:
    """What stands in the article element of a page of the test data."""
    import html

    found = re.search(r"<article>(.*?)(</article>|\Z)", page or "", re.S)
    blocks = re.split(r"</?(?:h1|p)>", found[1]) if found else []
    texts = [" ".join(html.unescape(b.replace("<b>", "").replace("</b>", "").replace("<br>", " ")).split()) for b in blocks]
    return "\n".join(t for t in texts if t)
