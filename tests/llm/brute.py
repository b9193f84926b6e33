"""Plain single-process versions of the contracts, written apart from the operators."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import xxhash

WS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_ascii(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def decontaminate(docs, items, window=10):
    """docs, items: (id, text).  -> {id: (n_words, n_hit, n_items, sha, contaminated)}"""
    wins = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(lower_ascii(t or ""))
        n = min(window, len(w))
        for at in range(len(w) - n + 1) if w else ():
            if i is not None:
                wins[tuple(w[at : at + n])].add(str(i))
            else:
                wins[tuple(w[at : at + n])]
    sizes = {len(x) for x in wins}
    out = {}
    for d, t in docs:
        w = ALNUM.findall(lower_ascii(t or ""))
        hit, seen = [False] * len(w), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if (x := tuple(w[at : at + n])) in wins:
                    hit[at : at + n] = [True] * n
                    seen |= wins[x]
        out[d] = (len(w), sum(hit), len(seen), sha(",".join(sorted(seen))), any(hit))
    return out


def simhash(text, shingle=3):
    w = WS.findall(lower_ascii(text or ""))
    if not w:
        return 0
    hs = [xxhash.xxh64(" ".join(w[i : i + shingle]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def simhash_classes(docs, bits=2):
    """-> {id: (fingerprint, component)} for distinct ids."""
    fp = {d: simhash(t) for d, t in docs}
    least = {}
    for d, f in fp.items():
        least[f] = min(d, least.get(f, d))
    root = {f: f for f in least}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fs = list(least)
    for i, a in enumerate(fs):
        for b in fs[:i]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                if least[x] < least[y]:
                    root[y] = x
                elif x != y:
                    root[x] = y
    return {d: (f"{f:016x}", least[find(f)]) for d, f in fp.items()}


def repeats(docs, window=50):
    """-> {id: (n_words, n_removed, kept sha)} for distinct ids."""
    first = {}
    words = {d: WS.findall(t or "") for d, t in docs}
    for d in sorted(words):
        w = words[d]
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), d)
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out[d] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def quality(text):
    """-> n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    text = text or ""
    w = WS.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WS.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count = defaultdict(int)
    for g in grams:
        count[g] += 1
    hit = [False] * len(w)
    for i, g in enumerate(grams):
        if count[g] > 1:
            hit[i : i + 5] = [True] * 5
    rep = sum(hit)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, rep, len(w) < 10 or 100 * rep > 20 * len(w)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def pii(text):
    """Base spans (kind, start, end) in the order of the contract."""
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, p, ok in kinds for m in re.finditer(p, text) if ok(m[0])]


def crc(data: bytes) -> int:
    return zlib.crc32(data)
