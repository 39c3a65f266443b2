"""Plain versions of the operators, for small tables."""

import re
from itertools import combinations

KINDS = ("email", "ip", "card", "phone")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def valid(kind, m):
    digits = re.sub("[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
            "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def base_spans(text):
    return [(k, m.start(), m.end()) for k in KINDS for m in PATTERNS[k].finditer(text or "") if valid(k, m.group())]


def redact(text):
    """Base spans only, kind after kind."""
    for k in KINDS:
        text = PATTERNS[k].sub(lambda m: f"<{k.upper()}>" if valid(k, m.group()) else m.group(), text)
    return text


def grams(text, n=5):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def classes(docs, threshold=0.8):
    """{doc_id: (class_id, n_links)} of (doc_id, text) rows with distinct ids, over all pairs."""
    sets = {d: grams(t) for d, t in docs}
    parent = {d: d for d in sets}
    links = dict.fromkeys(sets, 0)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and both >= threshold * len(sets[a] | sets[b]) - 1e-9:
            links[a] += 1
            links[b] += 1
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {d: (find(d), links[d]) for d in sets}


def hits(text, items, window=10):
    """(words, hit words, items) against {item_id: text}."""
    w = words(text)
    hit, found = set(), set()
    for item, t in items.items():
        v = words(t)
        n = min(window, len(v))
        for i in range(len(v) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == v[i:i + n]:
                    hit.update(range(j, j + n))
                    found.add(item)
    return len(w), len(hit), found


#: ASCII letters and U+00C0 to U+00FF.
LETTERS = {chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x100))}
