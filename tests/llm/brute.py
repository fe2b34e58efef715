"""Plain versions of the operators, by their definitions, for small tables."""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter, defaultdict

import xxhash

SPACE = " \t\n\v\f\r"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def line_dedup(docs):
    """{doc_id: (n_lines, n_dropped, kept)}, for unique ids."""
    key = lambda line: line.strip(SPACE).translate(LOWER)
    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc_id)
    out = {}
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == doc_id]
        out[doc_id] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def fingerprint(text):
    words = WORDS.findall((text or "").translate(LOWER))
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(docs, bits=2):
    """[(doc_id, fingerprint, component_id)] of rows."""
    prints = [fingerprint(text) for _, text in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[root(i)].append(doc_id)
    return [(doc_id, prints[i], min(least[root(i)], default=None)) for i, (doc_id, _) in enumerate(docs)]


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(docs, items):
    """[(doc_id, n_words, n_hit, item names)]"""
    windows = defaultdict(set)
    for name, text in items:
        words = bench_words(text)
        size = min(10, len(words))
        for i in range(len(words) - size + 1) if words else []:
            windows[tuple(words[i:i + size])].add(str(name))
    out = []
    for doc_id, text in docs:
        words, hit, names = bench_words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                found = windows.get(tuple(words[i:i + size]))
                if found:
                    hit.update(range(i, i + size))
                    names |= found
        out.append((doc_id, len(words), len(hit), sorted(names)))
    return out


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """{source: target} of {source: size}."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in order if s not in full)
        now = {s: most * sizes[s] if s in full else rest * weight[s] / open_weight for s in order}
        over = {s for s in order if s not in full and now[s] > most * sizes[s]}
        if not over:
            return now
        full |= over


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text):
    """[(kind index, start, end)]"""
    text = text or ""
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return sorted(out)


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    words = WORDS.findall(text or "")
    lines = [x for x in (text or "").split("\n") if x.strip(SPACE)]
    windows = Counter(zip(words, words[1:], words[2:]))
    again = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(again), len(words) < 50 or 100 * len(again) > 50 * len(words))


def article(page):
    """Text of the article of the given pages, which are all built alike."""
    inside = re.search(r"<article>(.*?)</article>", page or "", re.S)
    parts = re.split(r"</?(?:h1|p)>", inside[1]) if inside else []
    texts = (" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split()) for x in parts)
    return "\n".join(x for x in texts if x)
