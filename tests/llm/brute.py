"""Plain versions of what the operators compute, for small tables."""

import hashlib
import html
import re
from collections import defaultdict


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def leaks(docs, items, window=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        words = pattern.findall(lower(text or ""))
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[k:k + n])].add(item)
    found = []
    for doc, text in docs:
        words = pattern.findall(lower(text or ""))
        hit, ids = [0] * len(words), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if tuple(words[k:k + n]) in windows:
                    ids |= windows[tuple(words[k:k + n])]
                    hit[k:k + n] = [1] * n
        names = sorted(str(i) for i in ids if i is not None)
        found.append((doc, len(words), sum(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), sum(hit) > 0))
    return found


def repeats(docs, length=50):
    first = {}
    rank = lambda doc: float("inf") if doc is None else doc
    for doc, text in docs:
        raw = (text or "").encode()
        for i in range(len(raw) - length + 1):
            first[raw[i:i + length]] = min(rank(doc), first.get(raw[i:i + length], float("inf")))
    found = []
    for doc, text in docs:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if first[raw[i:i + length]] < rank(doc):
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        found.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return found


def linked(docs, words, percent):
    sets = []
    for _, text in docs:
        own = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
        sets.append(frozenset(tuple(own[i:i + words]) for i in range(len(own) - words + 1)) if len(own) >= words
                    else frozenset([tuple(own)] if own else []))
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [(doc, len(sets[i]), least.get(root(i)) if sets[i] else doc) for i, (doc, _) in enumerate(docs)]


def article(page):
    """Of the pages of the test tables: what stands in the article, by its tags."""
    inside = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.S)[1]
    parts = re.sub(r"<[^>]*>", "", re.sub(r"<(/?)(h1|p|br)>", "\0", inside)).split("\0")
    return "\n".join(x for x in (" ".join(html.unescape(part).split()) for part in parts) if x)


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda row: tuple((x is None, str(type(x)), x or 0) for x in row))
