"""Plain versions of the contracts, for comparison."""

from __future__ import annotations

import hashlib
import re
import sys
import zlib

import numpy as np

sys.set_int_max_str_digits(0)

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        n = int(c)
        if i % 2:
            n = sum(divmod(2 * n, 10))
        total += n
    return total % 10 == 0


def base_spans(text):
    found = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda d=digits: 16 <= len(d) <= 19 and _luhn(d),
                "phone": lambda d=digits: 8 <= len(d) <= 15,
            }[kind]()
            if good:
                found.append((kind, *m.span()))
    return found


def base_sha256(text):
    joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base_spans(text))
    return hashlib.sha256(joined.encode()).hexdigest()


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text))


def decontaminated(docs, benchmark, size=13):
    """``docs``: (id, text); gives (id, n_words, n_hit, n_items, sha, contaminated)."""
    windows = {}
    for item, text in benchmark:
        words = bench_words(text)
        for i in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(
                "null" if item is None else str(item)
            )
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, hit, items = bench_words(text), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    items |= windows[w]
        sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        bad = bool(hit) and 20 * len(hit) >= len(words)
        out.append((doc, len(words), len(hit), len(items), sha, bad))
    return out


def near_words(text):
    return re.findall("[^\x20\x09-\x0d]+", lower_ascii(text))


def shingles(text, size=5):
    words = near_words(text)
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def near_duplicates(docs):
    """``docs``: (id, text); gives (id, n_shingles, component_id, kept), all pairs compared."""
    sets = {}
    for doc, text in docs:
        sets.setdefault(doc, shingles(text))
    ids, parent = sorted(sets), {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if not sets[a] or not sets[b] or root(a) == root(b):
                continue
            if min(len(sets[a]), len(sets[b])) * 100 < 75 * max(len(sets[a]), len(sets[b])):
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [(d, len(shingles(t)), root(d), d == root(d)) for d, t in docs]


def token_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def ids_crc32(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def top_k(vectors, k=10):
    """``vectors``: (id, list); gives (query, rank, id, score)."""
    clean = [
        (i, np.floor(1024 * np.array(v, dtype=np.float64)).astype(np.int64))
        for i, v in vectors
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for q, a in clean:
        if q % 100 == 0:
            scored = sorted((-int(a @ b), i) for i, b in clean if i != q and len(a) == len(b))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out
