"""Plain one-machine versions of the operators, to hold the Spark ones against."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def exact(rows):
    """(id, text) rows to (id, keep, size, kept, sha) rows."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = []
    for i, text in rows:
        own = groups[text or ""]
        keep = max((x for x in own if x is not None), default=None)
        out.append((i, keep, len(own), i == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return out


def fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text or ""))
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, links):
    """Smallest id that each one reaches; links are pairs of positions."""
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    least = {}
    for k, i in enumerate(ids):
        r = find(k)
        least[r] = i if least.get(r) is None else least[r] if i is None else min(least[r], i)
    return [least[find(k)] for k in range(len(ids))]


def near(values, budget=2):
    v = np.array(values, np.uint64)
    return [(i, int(j)) for i in range(len(v)) for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= budget) if i < j]


_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contaminated(text, items, window=13):
    """(n_words, n_hit, items that occur as sorted text, contaminated)."""
    words = _WORD.findall(low(text or ""))
    hit, found = [False] * len(words), set()
    for item, body in items:
        own = _WORD.findall(low(body or ""))
        k = min(window, len(own))
        for at in range(len(own) - k + 1 if k else 0):
            for i in range(len(words) - k + 1):
                if words[i : i + k] == own[at : at + k]:
                    hit[i : i + k] = [True] * k
                    if item is not None:
                        found.add(str(item))
    n = sum(hit)
    return len(words), n, sorted(found), n > 0 and 20 * n >= len(words)


def tokens(texts, path, end):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(path)
    return [[*coder.encode(t or "", add_special_tokens=False).ids, end] for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def lines(rows, ratio, least):
    """(id, host, text) rows to (id, text, n_lines, n_dropped)."""
    pages, seen = Counter(h for _, h, _ in rows), Counter()
    for _, host, text in rows:
        seen.update({(host, x.strip(" ")) for x in (text or "").split("\n") if x.strip(" ")})
    out = []
    for i, host, text in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        every = text.split("\n")
        stays = [x for x in every if not x.strip(" ") or seen[host, x.strip(" ")] < least or seen[host, x.strip(" ")] <= ratio * pages[host]]
        out.append((i, "\n".join(stays), len(every), len(every) - len(stays)))
    return out


def cut_repeats(rows, window):
    """(id, text) rows to (id, words, removed, kept text) rows; a null id is the smallest."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    order = [float("-inf") if i is None else i for i, _ in split]
    least = {}
    for o, (_, w) in zip(order, split):
        for a in range(len(w) - window + 1):
            s = tuple(w[a : a + window])
            least[s] = min(o, least.get(s, o))
    out = []
    for o, (i, w) in zip(order, split):
        gone = {p for a in range(len(w) - window + 1) if least[tuple(w[a : a + window])] < o for p in range(a, a + window)}
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def divergences(rows, least_docs, top):
    """(lang, source, text) rows to (lang, source, part, item, value, rank) rows."""
    split = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(t or ""))) for lang, source, t in rows]
    docs, counts, whole = Counter(), defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in split:
        docs.update({(lang, w) for w in words})
    for lang, source, words in split:
        held = [w for w in words if docs[lang, w] >= least_docs]
        counts[lang, source].update(held)
        whole[lang].update(held)
    kept = {lang: [w for (x, w), n in docs.items() if x == lang and n >= least_docs] for lang in whole}

    def p(count, total, v):
        return 1 + 10**9 * (count + 2) // (total + 2 * v)

    def f(a, b):
        return (a - b) ** 2 // (a + b)

    out = []
    for (lang, source), own in counts.items():
        v, total, every = len(kept[lang]), sum(own.values()), sum(whole[lang].values())
        ps = {w: p(own[w], total, v) for w in kept[lang]}
        pairs = []
        for (x, other), theirs in counts.items():
            if x == lang and other != source:
                n = sum(theirs.values())
                pairs.append((sum(f(ps[w], p(theirs[w], n, v)) for w in ps), other))
        apart = [(f(a, q), w) for w, a in ps.items() if own[w] and a > (q := p(whole[lang][w], every, v))]
        for part, found in (("pair", pairs), ("term", apart)):
            ranked = sorted(found, key=lambda r: (-r[0], r[1].encode()))
            out += [(lang, source, part, item, value, k) for k, (value, item) in enumerate(ranked, 1) if part == "pair" or k <= top]
    return out
