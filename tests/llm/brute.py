"""Brute-force versions of the corpus operators, in plain Python, for small fixtures."""

import re
from collections import defaultdict
from itertools import combinations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, n=5):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def classes(keys, linked):
    """key -> smallest key reachable by ``linked(i, j)`` between positions."""
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(keys)), 2):
        if linked(i, j):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    low = defaultdict(list)
    for i, k in enumerate(keys):
        low[find(i)].append(k)
    return [min(low[find(i)]) for i in range(len(keys))]


def similar(a, b):
    both = len(a & b)
    return bool(a) and bool(b) and 100 * both >= 80 * (len(a) + len(b) - both)


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contaminated(text, items, n=10):
    """(n_words, n_hit, item ids) of one text."""
    words, hit, found = bench_words(text), set(), set()
    for item, t in items:
        w = bench_words(t)
        size = min(n, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            for at in range(len(words) - size + 1):
                if words[at:at + size] == w[k:k + size]:
                    hit.update(range(at, at + size))
                    found.add(item)
    return len(words), len(hit), sorted(map(str, found))


def pii_spans(text):
    """Base spans (kind, start, end), by start and kind order."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c in "0123456789"]
        total = sum(d if i % 2 == 0 else 2 * d // 10 + 2 * d % 10 for i, d in enumerate(reversed(digits)))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return [(("email", "ip", "card", "phone")[k], s, e) for s, k, e in sorted(out)]


def secret_values(text):
    """(start, value) of every secret candidate, found one character after another."""
    word = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")
    part = word | set("+/")
    key, named = part | {"="}, part | set("!@#$%^*~")
    names = r"(?i:token|secret|password|passwd|passphrase|pwd|api_?key|access_?key|private_?key|credentials?|bearer)(?i:_[a-z]{1,12})?"

    def run(t, p, chars):
        while p < len(t) and t[p] in chars:
            p += 1
        return p

    def named_end(t, p):
        if p >= len(t) or t[p] not in named - {"-"}:
            return 0
        e = p
        while e < len(t) and (t[e] in named or (t[e] == "." and t[e + 1:e + 2] in named)):
            e += 1
        if e - p < 8:
            return 0
        e += min(2, run(t, e, "=") - e)
        return 0 if t[e:e + 1] in key else e

    def after_name(t, p):
        return re.search(names + r"[\"'`]?[ \t]{0,3}(?:=>|[:=]{1,2})[ \t]{0,3}[\"'`]?\Z", t[max(0, p - 60):p]) is not None

    def signed_end(t, p):
        a = run(t, p + 3, word)
        b = run(t, a + 1, word)
        fits = t.startswith("eyJ", p) and a - p >= 11 and t[a:a + 1] == "." and b > a + 1 and t[b:b + 1] == "."
        return run(t, b + 1, word) if fits else 0

    def block_end(t, p):
        first = re.compile("-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY( BLOCK)?-----").match(t, p)
        at = t.find("-----", first.end()) if first else -1
        last = re.compile("-----END [A-Z0-9 ]{0,40}PRIVATE KEY( BLOCK)?-----").match(t, at) if at >= 0 else None
        return last.end() if last else 0

    def run_end(t, p):
        if t[p] not in key or (p and t[p - 1] in key):
            return 0
        e = run(t, p, key)
        for q in range(p, e):
            if (q == 0 or t[q - 1] not in part) and signed_end(t, q):
                return signed_end(t, q)
        gives = re.compile("[A-Za-z_-]{0,40}" + names + "={1,2}").match(t, p)
        fits = e - p >= 16 and any("0" <= c <= "9" for c in t[p:e])
        return e if fits and not (gives and named_end(t, gives.end())) else 0

    def cut(t):
        q = 0
        while q < len(t):
            end = 0
            if q == 0 or t[q - 1] not in part:
                end = signed_end(t, q)
                e = run(t, q, part)
                tail = run(t, e, "=") == len(t)
                digit = any("0" <= c <= "9" for c in t[q:e])
                long = e - q >= 16 or (tail and e < len(t) and len(t) - q >= 16)
                if not end and e > q and ((digit and long) or (q and t[q - 1] == "=" and e - q >= 8)):
                    end = len(t) if tail else e
            if end:
                yield q, t[q:end]
            q = end or q + 1

    out, p = [], 0
    while p < len(text):
        end = block_end(text, p) or (after_name(text, p) and named_end(text, p)) or run_end(text, p)
        if end:
            t = text[p:end]
            if t.startswith("-----BEGIN ") or (after_name(text, p) and named_end(t, 0) == len(t)):
                out.append((p, t))
            else:
                out.extend((p + q, v) for q, v in cut(t))
        p = end or p + 1
    return out
