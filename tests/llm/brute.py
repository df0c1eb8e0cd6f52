"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections import Counter, defaultdict

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
_FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_WORD = re.compile(r"[^\x20\x09-\x0d]+")
_WHITE = " \t\n\x0b\x0c\r"


def words(text):
    return _WORD.findall(text or "")


def folded_words(text):
    return words((text or "").translate(_FOLD))


def shingles(text, size):
    w = folded_words(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def components(sets: dict, percent: int) -> dict:
    """Smallest id reachable by links; sets: {id: set}."""
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in sets.items():
        for shingle in s:
            holders[shingle].append(i)
    for i, s in sets.items():
        common = Counter(j for shingle in s for j in holders[shingle] if j < i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in sets}


def line_dedup(docs: dict, min_chars=40, min_docs=5) -> dict:
    """{id: text} with repeated lines in the largest id only."""
    key = lambda line: line.strip(_WHITE).translate(_FOLD)
    holders = defaultdict(set)
    for i, text in docs.items():
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    gone = {k: max(ids) for k, ids in holders.items() if len(ids) >= min_docs}
    return {
        i: "\n".join(line for line in (text or "").split("\n") if gone.get(key(line), i) == i) for i, text in docs.items()
    }


def plain_words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def leaks(docs: dict, items: dict, size=5, percent=80) -> dict:
    """{(doc, item): similarity} of the best item-sized window."""

    def grams(w):
        k = min(size, len(w))
        return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if w else []

    item_words = {i: plain_words(t) for i, t in items.items()}
    counts = {i: Counter(grams(w)) for i, w in item_words.items() if w}
    df = Counter(s for c in counts.values() for s in c)
    most = math.log(1 + len(counts))
    weight = {s: math.log(1 + len(counts) / n) for s, n in df.items()}
    found = {}
    for d, text in docs.items():
        w = plain_words(text)
        here = set(grams(w))
        for i, item in counts.items():
            if not here & set(item) and len(item_words[i]) >= size:
                continue
            n = len(item_words[i])
            for start in range(max(1, len(w) - n + 1)):
                own = Counter(grams(w[start : start + n]))
                shared = sum(min(k, own[s]) * weight[s] for s, k in item.items())
                union = sum(max(k, own[s]) * weight[s] for s, k in item.items())
                union += sum(k for s, k in own.items() if s not in item) * most
                if union and 100 * shared / union >= percent - 1e-9:
                    found[d, i] = max(found.get((d, i), 0), shared / union)
    return found


def targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2.0) -> dict:
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, full = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(full.values())
        given = {s: w[s] * left / sum(w[r] for r in rest) for s in rest}
        over = [s for s in rest if given[s] > most * sizes[s]]
        if not over:
            return {**full, **given}
        full.update({s: most * sizes[s] for s in over})


def copies(doc_id, rate, seed="mix"):
    draw = int(hashlib.md5(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:12], 16) / 2**48
    return math.floor(rate) + (draw < rate - math.floor(rate))


def removed(docs: list, length=50):
    """[(n_bytes, n_removed, n_spans, kept)] for [(id, text)], by looking at every string."""
    raw = [(i, (t or "").encode()) for i, t in docs]
    least = {}
    for i, b in raw:
        for k in range(len(b) - length + 1):
            s = b[k : k + length]
            least[s] = min(i, least.get(s, i))
    out = []
    for i, b in raw:
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if least[b[k : k + length]] < i:
                gone[k : k + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def naive_spans(text):
    """Base spans by the patterns as they are written."""
    from lawloom.llm.pii import KINDS, luhn

    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ips = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    found += [("ip", m) for m in ips if all(int(p.lstrip("0")[:9] or "0") <= 255 for p in m.group().split("."))]
    cards = re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
    found += [("card", m) for m in cards if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    phones = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
    found += [("phone", m) for m in phones if 10 <= len(digits(m)) <= 15]
    return sorted(((k, m.start(), m.end()) for k, m in found), key=lambda s: (s[1], KINDS.index(s[0])))
