"""Plain versions of the contracts, over lists of rows."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def contaminated(docs, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = defaultdict(set)
    for item, text in items:
        w = cut(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, held = cut(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if found := windows.get(tuple(w[i : i + size])):
                    hit.update(range(i, i + size))
                    held |= found
        out.append((doc, len(w), len(hit), len(held), sha(",".join(sorted(held))), bool(hit)))
    return out


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_components(docs):
    sets = [(doc, shingles(text)) for doc, text in docs]
    of = {doc: doc for doc, _ in sets}

    def root(x):
        while of[x] != x:
            x = of[x]
        return x

    where = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            where[x].append(k)
    pairs = {(i, j) for ks in where.values() if len(ks) > 1 for n, i in enumerate(ks) for j in ks[n + 1 :]}
    for i, j in pairs:
        (a, s), (b, t) = sets[i], sets[j]
        if 100 * len(s & t) >= 75 * len(s | t):
            low, high = sorted((root(a), root(b)))
            of[high] = low
    return [(doc, len(s), root(doc), root(doc) == doc) for doc, s in sets]


def quality(docs):
    out = []
    for doc, text in docs:
        text = text or ""
        w = words(text)
        runs = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        counts = Counter(runs)
        covered = {i + k for i, r in enumerate(runs) if counts[r] > 1 for k in range(8)}
        lines = [x for x in text.split("\n") if words(x)]
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        out.append(
            (doc, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)
        )
    return out


def line_dedup(docs):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for doc, text in docs:
        for x in (text or "").split("\n"):
            if len(key(x)) >= 10:
                holders[key(x)].add(doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def archives(pages):
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    newest = {}
    for page, html in pages:
        newest[digest(html)] = max(page, newest.get(digest(html), page))
    return [
        (p, len((h or "").encode()), digest(h), "response" if newest[digest(h)] == p else "revisit",
         None if newest[digest(h)] == p else newest[digest(h)])
        for p, h in pages
    ]


def personal_data(docs):
    """Straight use of the patterns of the contract."""
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

    def luhn(d):
        odd, even = [int(x) for x in d[::-1][::2]], [int(x) * 2 for x in d[::-1][1::2]]
        return (sum(odd) + sum(x // 10 + x % 10 for x in even)) % 10 == 0

    out = []
    for doc, text in docs:
        text, spans = text or "", []
        for kind, pattern in (("email", email), ("ip", ip), ("card", card), ("phone", phone)):
            for m in pattern.finditer(text):
                digits = re.sub("[^0-9]", "", m.group())
                good = {
                    "email": lambda: True,
                    "ip": lambda: all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.group().split(".")),
                    "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
                    "phone": lambda: 8 <= len(digits) <= 15,
                }[kind]()
                if good:
                    spans.append(f"{kind}:{m.start()}:{m.end()}")
        counts = [sum(s.startswith(k) for s in spans) for k in ("email", "ip", "card", "phone")]
        out.append((doc, *counts, sha(",".join(spans))))
    return out
