"""Plain versions of the operators, for small tables."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def left_out(doc_id, parts, rest):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % parts == rest


def personal(text):
    """Base spans: (start, kind's number, end)."""
    text = text or ""
    patterns = (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    )

    def fine(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == 1:
            return all(int(p) <= 255 for p in value.split("."))
        if kind == 2:
            total = sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(map(int, digits[::-1])))
            return 12 <= len(digits) <= 19 and total % 10 == 0
        return kind == 0 or 9 <= len(digits) <= 15

    return sorted(
        (m.start(), kind, m.end()) for kind, p in enumerate(patterns) for m in re.finditer(p, text) if fine(kind, m[0])
    )


def cut(rows, depth=50):
    """(id, text) -> (bytes, removed, spans, sha256) by every string of ``depth`` bytes."""
    ids = [math.inf if i is None else i for i, _ in rows]
    data = [(t or "").encode() for _, t in rows]
    first = {}
    for i, d in zip(ids, data):
        for k in range(len(d) - depth + 1):
            first[d[k:k + depth]] = min(i, first.get(d[k:k + depth], math.inf))
    result = []
    for i, d in zip(ids, data):
        gone = bytearray(len(d))
        for k in range(len(d) - depth + 1):
            if first[d[k:k + depth]] < i:
                gone[k:k + depth] = b"\1" * depth
        kept = bytes(b for b, g in zip(d, gone) if not g)
        runs = len([1 for g, _ in itertools.groupby(gone) if g])
        result.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return result


def word_scores(rows, learned):
    """(id, text) -> (n_tokens, n_known, N, base score)."""
    tokens = [[*words(t), None] for _, t in rows]
    counts = Counter(t for own, yes in zip(tokens, learned) if yes for t in own)
    total, kinds = sum(counts.values()), len(counts)
    return [
        (len(own), sum(counts[t] > 0 for t in own), total, sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in own))
        for own in tokens
    ]


def reachable(ids, linked):
    """The smallest id that each is connected with; ``linked(a, b)`` for a < b."""
    low = {i: i for i in ids}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for a, b in itertools.combinations(sorted(ids), 2):
        if linked(a, b):
            x, y = sorted((root(a), root(b)))
            low[y] = x
    return {i: root(i) for i in ids}


def shingles(text, size):
    own = words(text)
    return {tuple(own[k:k + size]) for k in range(len(own) - size + 1)} or ({tuple(own)} if own else set())


def judge(url, rules):
    m = re.search(r"://", url or "")
    rest = url[m.end():] if m else ""
    host = re.match(r"[^/?#]*", rest)[0].translate(UPPER)
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    fits = [
        (len(r), r, v) for v, r in rules
        if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])
    ]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def shares(sizes, weights, most=3):
    """Targets of ordered sources."""
    w = [weights[k % len(weights)] for k in range(len(sizes))]
    target, full, left = [0.0] * len(sizes), set(), float(sum(sizes))
    while len(full) < len(sizes):
        open_ = [k for k in range(len(sizes)) if k not in full]
        share = left / sum(w[k] for k in open_)
        over = [k for k in open_ if share * w[k] > most * sizes[k]]
        for k in over or open_:
            target[k] = most * sizes[k] if over else share * w[k]
        if not over:
            break
        left -= sum(target[k] for k in over)
        full.update(over)
    return target


def tokens_of(tokenizer, processor, text):
    """Ids and bytes of a blank and the text by both libraries; None without tokens."""
    if not text:
        return None
    first = tokenizer.encode(" " + text, add_special_tokens=False).ids
    second = processor.encode(text)
    letters = [b for b in range(256) if chr(b).isprintable() and chr(b) != " "]
    of = {chr(b): b for b in letters} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in letters)}
    bytes_1 = [bytes(of[c] for c in tokenizer.id_to_token(i)) for i in first]
    bytes_2 = [
        bytes([int(processor.id_to_piece(i)[3:5], 16)]) if processor.is_byte(i) else processor.id_to_piece(i).replace("▁", " ").encode()
        for i in second
    ]
    whole = (" " + text).encode()
    return (first, bytes_1, second, bytes_2) if b"".join(bytes_1) == whole == b"".join(bytes_2) else None


def aligned(tokenizer, processor, texts):
    """For each text (n_a, n_b, n_groups, n_links, n_best, count_sum, sha256), by walking over every byte."""
    found, times = [], {}
    for text in texts:
        tokens = tokens_of(tokenizer, processor, text)
        if tokens is None:
            found.append(None)
            continue
        first, bytes_1, second, bytes_2 = tokens
        at_1 = [k for k, t in enumerate(bytes_1) for _ in t]
        at_2 = [k for k, t in enumerate(bytes_2) for _ in t]
        links = [(first[i], second[j]) for i, j in sorted(set(zip(at_1, at_2, strict=True)))]
        for link in links:
            times[link] = times.get(link, 0) + 1
        groups, one, two = [], [], []
        for p, (i, j) in enumerate(zip(at_1, at_2, strict=True)):
            one += [first[i]] if p == 0 or at_1[p - 1] != i else []
            two += [second[j]] if p == 0 or at_2[p - 1] != j else []
            last = p + 1 == len(at_1)
            if last or (at_1[p + 1] != i and at_2[p + 1] != j):
                groups.append(",".join(map(str, one)) + "|" + ",".join(map(str, two)))
                one, two = [], []
        found.append((len(first), len(second), groups, links))
    best = {}
    for (_, b), n in times.items():
        best[b] = max(best.get(b, 0), n)
    return [(0,) * 6 + ("",) if f is None else (
        f[0], f[1], len(f[2]), len(f[3]), sum(times[x] == best[x[1]] for x in f[3]), sum(times[x] for x in f[3]),
        hashlib.sha256(";".join(f[2]).encode()).hexdigest(),
    ) for f in found]


def whitened(vectors, components):
    """Exact deviations, whitened vectors and explained parts of rows of whole numbers, each distinct one fitted once."""
    x = [list(map(int, v)) for v in vectors]
    distinct = sorted(set(map(tuple, x)))
    n, sums = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums, strict=True)] for v in distinct])
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1][:components]
    rows = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums, strict=True)] for v in x])
    return n, deviation, rows @ vectors_[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def mixed_bits(texts, learned, mixer):
    """Bits of each text under the context-mixing model: dictionaries of counts, and the mixer's weights as they are."""
    def tokens(text):
        return b" ".join((text or "").encode().lower().split()) + b"\n"

    def coded(data):
        for k, byte in enumerate(data):
            word = max(data.rfind(b" ", 0, k), data.rfind(b"\n", 0, k)) + 1
            seen = [(n, (bytes(4) + data[:k])[-n:]) for n in (1, 2, 3, 4)] + [("word", data[word:k])]
            for place in range(8):
                yield [(c, place, byte >> (8 - place)) for c in seen], place, byte >> (7 - place) & 1, seen[0][1][0]

    counts = {}
    for text, known in zip(texts, learned):
        for cells, _, bit, _ in coded(tokens(text)) if known else ():
            for cell in cells:
                counts.setdefault(cell, [0, 0])[bit] += 1
    found = []
    for text in texts:
        total = 0.0
        for cells, place, bit, before in coded(tokens(text)):
            n = [counts.get(cell, (0, 0)) for cell in cells]
            x = [max(-127, min(127, round(14 * math.log((one + 0.08) / (zero + 0.08))))) / 14 for zero, one in n]
            level = [min(3, int(math.log2(sum(c) + 1) / 2)) for c in n]
            weights = mixer.weights[(place * 4 + level[4]) * 4 + level[3]]
            mixed = max(-11.4, min(11.4, sum(w * v for w, v in zip(weights, x))))
            at = max(0.0, min(23 - 1e-4, mixed + 11.5))
            low = int(at)
            table = mixer.refined[before][low] * (1 - at + low) + mixer.refined[before][low + 1] * (at - low)
            p = max(1e-5, min(1 - 1e-5, (1 / (1 + math.exp(-mixed)) + table) / 2))
            total -= math.log2(p if bit else 1 - p)
        found.append(total)
    return found
