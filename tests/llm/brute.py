"""Plain Python versions of the operators, written from their contracts."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def chat(rows):
    """conv_id -> (n_turns, turns_sha256, loss_chars, loss_sha256)."""
    by = defaultdict(list)
    for r in rows:
        by[r["conv_id"]].append(((r["turn"] is not None, r["turn"] or 0), r["role"] or "", r["text"] or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(t for _, role, t in turns if role == "assistant")
        out[c] = (len(turns), sha("".join(f"{role}\n{t}\n" for _, role, t in turns)), len(loss), sha(loss))
    return out


def simhash(text):
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode("utf-8"), seed=42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def groups(prints, distance=4):
    """Row number -> smallest row number linked, by comparing all pairs."""
    keys = sorted(set(prints))
    parent = {k: k for k in keys}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (a ^ b).bit_count() <= distance and root(a) != root(b):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {k: root(k) for k in keys}


def quality(text):
    words = WORDS.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    hit = set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit), failed)


def spans(text, kinds, keep):
    found = []
    for rank, (kind, pattern) in enumerate(kinds.items()):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if keep(kind, m):
                found.append((m.start(), rank, m.end(), kind))
    return sorted(found)


def digest(found):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in found)


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
       "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
       "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def keep_pii(kind, m):
    digits = re.sub("[^0-9]", "", m.group())
    if kind == "ip":
        return all(int(x) <= 255 for x in m.group().split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15 if kind == "phone" else True


SECRETS = {"assign": r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
           "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}


def keep_secret(kind, m):
    return {"assign": lambda: len(m.group(2)) >= 8, "access": lambda: len(m.group()) >= 16,
            "hex": lambda: len(m.group()) >= 32}[kind]()


def coverage(text, item):
    """Greedy string tiling word by word."""
    a, b = (re.findall(r"\w+", (t or "").lower()) for t in (text, item))
    ma, mb, covered = set(), set(), 0
    while True:
        best = None
        for j in range(len(b)):
            for i in range(len(a)):
                k = 0
                while (i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]
                       and i + k not in ma and j + k not in mb):
                    k += 1
                if k >= 5 and (best is None or k > best[0]):
                    best = (k, i, j)
        if best is None:
            return covered, len(b)
        k, i, j = best
        ma |= set(range(i, i + k))
        mb |= set(range(j, j + k))
        covered += k


def mixing_targets(sizes, weights=(5, 2, 1)):
    """source -> target, resharing the excess round by round."""
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * share > 2 * sizes[s] + 1e-9}
        if not over:
            for s in open_:
                target[s] = weight[s] * share
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target
