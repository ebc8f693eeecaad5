"""Plain single-machine versions of the operators, for comparison on small inputs."""

import math
import re
from collections import Counter

import xxhash

from ledgerspark.llm import leaks, line_dedup, quality

SPACE = r"[\x20\x09-\x0D]+"


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text)


def _signed(h):
    return h - (1 << 64) if h >> 63 else h


def _hash(value, seed=42):
    data = value.encode() if isinstance(value, str) else value.to_bytes(8, "little", signed=True)
    return _signed(xxhash.xxh64_intdigest(data, seed % (1 << 64)))


# Quality rules.


def quality_counts(text):
    words = [w for w in re.split(SPACE, text or "") if w]
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.sub(SPACE, "", line):
            again += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k + i for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for i in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(covered)


def _letter(c):
    import unicodedata

    return unicodedata.category(c)[0] in "LMN"


def tokens(text):
    found, last = [], None
    for c in text or "":
        kind = None if c in " \t\n\x0b\x0c\r" else _letter(c)
        if kind is not None and kind == last:
            found[-1] += c
        elif kind is not None:
            found.append(c)
        last = kind
    return found


def quality_buckets(text):
    h = [_hash(t) for t in tokens(text)]
    return [x % quality.BUCKETS for x in h + [_hash(b, _hash(a)) for a, b in zip(h, h[1:])]]


def quality_scores(docs, trusted):
    """docs: (id, text); scores in order."""
    raw, target = Counter(), Counter()
    for i, text in docs:
        found = quality_buckets(text)
        raw.update(found)
        if i in trusted:
            target.update(found)
    r, t = sum(raw.values()), sum(target.values())
    weight = {b: round(math.log((target[b] + quality.PRIOR * n / r) / ((t + quality.PRIOR) * n / r)), 6) for b, n in raw.items()}
    out = []
    for _, text in docs:
        found = quality_buckets(text)
        out.append(sum(weight[b] for b in found) / len(found) if found else 0.0)
    return out


def quality_kept(docs, trusted):
    scores = quality_scores(docs, trusted)
    out = []
    for (_, text), score in zip(docs, scores):
        n, _, _, _, again = quality_counts(text)
        out.append(n >= 50 and 100 * again <= 50 * n and score >= quality.THRESHOLD)
    return out


# Line dedup.


def _shingles(line):
    k = line_dedup.SHINGLE
    return {line[i : i + k] for i in range(len(line) - k + 1)} or {line}


def dropped_lines(docs):
    """docs: (id, text) without repeated rows; for each, numbers of the lines that go."""
    places = {}
    for d, (i, text) in enumerate(docs):
        for no, line in enumerate((text or "").split("\n") if text is not None else []):
            line = line.strip(" \t\x0b\x0c\r")
            if line:
                places.setdefault(line, []).append(((i is None, i if i is not None else 0, _hash(text), no), d, no))
    lines = list(places)
    sets, root = [_shingles(x) for x in lines], list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(lines)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and len(x & y) >= line_dedup.SIMILAR * len(x | y):
                root[find(a)] = find(b)
    groups = {}
    for k, line in enumerate(lines):
        groups.setdefault(find(k), []).extend(places[line])
    gone = [[] for _ in docs]
    for found in groups.values():
        for _, d, no in sorted(found)[1:]:
            gone[d].append(no)
    return [sorted(x) for x in gone]


def without_lines(docs):
    """docs: (id, text); those that keep a sign or had none."""
    out = []
    for (i, text), gone in zip(docs, dropped_lines(docs)):
        if gone:
            text = "\n".join(x for no, x in enumerate(text.split("\n")) if no not in gone)
            if not text.strip(" \t\n\x0b\x0c\r"):
                continue
        out.append((i, text))
    return out


# SimHash.


def fingerprint(text):
    words = [w for w in re.split(SPACE, lower_ascii(text or "")) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def near_classes(rows):
    """rows: (id, fingerprint); for each, the index of its component's root."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (rows[a][1] ^ rows[b][1]).bit_count() <= 2:
                root[find(a)] = find(b)
    return [find(x) for x in range(len(rows))]


# Decontamination.


def leak_words(text):
    return [w for w in "".join(c if _letter(c) and not _mark(c) else " " for c in lower_ascii(text or "")).split(" ") if w]


def _mark(c):
    import unicodedata

    return unicodedata.category(c)[0] == "M"


def leaked(docs, items):
    """docs and items: (id, text); (doc id, item id, most same words, first word) of matches."""
    out = {}
    for i, text in docs:
        w = leak_words(text)
        for item, passage in items:
            v, seen = leak_words(passage), set()
            if len(v) < leaks.LEAST:
                continue
            for mask in (leaks.MASKS if len(v) > 3 else ("111",)):
                on = [k for k, bit in enumerate(mask) if bit == "1"]
                index = {}
                for p in range(len(v) - len(mask) + 1):
                    index.setdefault(tuple(v[p + k] for k in on), []).append(p)
                for at in range(len(w) - len(mask) + 1):
                    for p in index.get(tuple(w[at + k] for k in on), ()):
                        shift = at - p
                        if (i, item, shift) in seen:
                            continue
                        seen.add((i, item, shift))
                        equal = [v[k] == w[k + shift] for k in range(max(-shift, 0), min(len(v), len(w) - shift))]
                        same = max(sum(equal[k : k + leaks.AROUND]) for k in range(max(1, len(equal) - leaks.AROUND + 1)))
                        if same >= (len(v) if len(v) < 5 else min(leaks.ENOUGH, math.ceil(len(v) * leaks.SHARE))):
                            best, first = out.get((i, item), (0, shift))
                            out[i, item] = max(best, same), min(first, shift)
    return sorted((i, item, *found) for (i, item), found in out.items())
