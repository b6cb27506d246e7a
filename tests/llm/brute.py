"""Plain versions of the operators, for small inputs."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def pieces(ids, capacity):
    """Lengths of a document's pieces: the first takes the remainder."""
    first = len(ids) % capacity or capacity
    if len(ids) <= capacity:
        return [len(ids)]
    return [first] + [capacity] * ((len(ids) - first) // capacity)


def near_duplicates(docs, size, percent):
    """{id: (set size, least id of its component, whether that is its own)}."""
    sets = {}
    for key, text in docs:
        words = WORD.findall((text or "").encode().lower())
        n = min(size, len(words))
        sets[key] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()
    parent = {key: key for key in sets}

    def root(key):
        while parent[key] != key:
            key = parent[key]
        return key

    keys = sorted(sets)
    for a, b in itertools.combinations(keys, 2):
        both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if both and 100 * both >= percent * either:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {key: (len(sets[key]), root(key), root(key) == key) for key in keys}


def repeats(docs, length):
    """{id: (bytes, removed bytes, removed runs, digest of the rest)}."""
    seen, out = set(), {}
    for key, text in sorted(docs):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            if window in seen:
                covered[at : at + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, c in zip(data, covered) if not c)
        spans = sum(1 for value, _ in itertools.groupby(covered) if value)
        out[key] = (len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest())
    return out


def contamination(docs, items, window, share):
    """{id: (words, words hit, items, digest of the items, contaminated)}."""
    windows = {}
    for item, text in items:
        words = ITEM_WORD.findall((text or "").encode().lower())
        n = min(window, len(words))
        for at in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[at : at + n]), set()).add("" if item is None else str(item))
    sizes, out = {len(w) for w in windows}, {}
    for key, text in docs:
        words = ITEM_WORD.findall((text or "").encode().lower())
        hit, found = set(), set()
        for n in sizes:
            for at in range(len(words) - n + 1):
                items_of = windows.get(tuple(words[at : at + n]))
                if items_of:
                    found |= items_of
                    hit.update(range(at, at + n))
        names = ",".join(sorted(found))
        out[key] = (
            len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(),
            bool(hit) and share * len(hit) >= len(words),
        )
    return out


def repeated_chunks(docs, bounds_of):
    """{id: (text left, removed lines)} for the chunks that ``bounds_of`` cuts."""
    seen, out = set(), {}
    for key, text in sorted(docs):
        if text is None:
            out[key] = (None, 0)
            continue
        data, parts, removed = text.encode(), [], 0
        for start, end, filled in bounds_of(data) if data else []:
            part = data[start:end]
            if filled >= 2 and part in seen:
                removed += part.count(b"\n") + (not part.endswith(b"\n"))
            else:
                parts.append(part)
                if filled >= 2:
                    seen.add(part)
        out[key] = (b"".join(parts).decode(), removed)
    return out


def repeated_passages(docs, spans_of):
    """{id: (text left, removed lines)} for the spans of lines that ``spans_of`` gives."""
    first, out = {}, {}
    for key, text in sorted(docs, key=lambda d: d[0]):
        data = (text or "").encode()
        lines = re.findall(rb"[^\n]*\n|[^\n]+", data)
        begins = [0, *itertools.accumulate(len(line) for line in lines)]
        gone = set()
        for start, end in sorted(spans_of(data)) if data else []:
            at = first.setdefault(data[start:end], (key, start))
            if at[0] != key or start >= at[1] + end - start:
                ends = [b - line.endswith(b"\n") for b, line in zip(begins[1:], lines)]
                gone |= {i for i in range(len(lines)) if begins[i] >= start and ends[i] <= end}
        # A blank line goes as the filled line before it does, the first ones as the first.
        filled = [i for i, line in enumerate(lines) if line.split()]
        owners = [max((f for f in filled if f <= i), default=filled[0] if filled else i) for i in range(len(lines))]
        left = b"".join(line for line, owner in zip(lines, owners) if owner not in gone)
        out[key] = (None if text is None else left.decode(), sum(o in gone for o in owners))
    return out


def line_counts(text, encoding):
    """Tokens of each line: a token goes where most of its characters are, the earlier if equal."""
    sections = re.split(r"(?<=\n)", text)
    ends = list(itertools.accumulate((len(s) for s in sections), initial=0))
    counts = Counter()
    for start, end in encoding.offsets:
        end = max(end, start + 1)
        shares = [min(end, ends[i + 1]) - max(start, ends[i]) for i in range(len(sections))]
        counts[shares.index(max(shares))] += 1
    return [counts[i] for i in range(len(sections))]


LETTERS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def lowered(text):
    return (text or "").encode().translate(LETTERS)


def resampled(docs, target, percent, least_words, buckets, seed):
    """{id: (features, weight, score, rank)}; ids are different whole numbers or None."""

    def features(text):
        words = ITEM_WORD.findall(lowered(text))
        return words, [b" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]

    def counted(texts):
        return Counter(zlib.crc32(f) % buckets for text in texts for f in features(text)[1])

    s, t = counted(text for _, text in docs), counted(target)
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(buckets)}
    out, able = {}, []
    for key, text in docs:
        words, found = features(text)
        weight = sum(gain[zlib.crc32(f) % buckets] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[key] = (len(found), weight, score, None)
        if len(words) >= least_words:
            able.append((-score, key is None, key or 0, key))
    for rank, (*_, key) in enumerate(sorted(able, key=lambda a: a[:3])[: percent * len(able) // 100], 1):
        out[key] = (*out[key][:3], rank)
    return out


def simhash(text, size):
    words = WORD.findall(lowered(text))
    n = min(size, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1) if n]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def hamming_components(prints, bits):
    """{id: least id reachable} of {id: fingerprint}."""
    parent = {key: key for key in prints}

    def root(key):
        while parent[key] != key:
            key = parent[key]
        return key

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= bits:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {key: root(key) for key in prints}


def collocations(docs, least, most_words, first, cover):
    """[(lang, rank, phrase, a, l, r, n, score)] of (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, most_words + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {(lang, p): a for (lang, p), a in f.items() if a >= least and len(p) > 1}
    gone = set()
    for (lang, p), a in often.items():
        for i, j in itertools.combinations(range(len(p) + 1), 2):
            if 1 < j - i < len(p) and 100 * a >= cover * f[lang, p[i:j]]:
                gone.add((lang, p[i:j]))
    rows = []
    for (lang, p), a in often.items():
        if (lang, p) not in gone:
            cuts = [(f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min((1000 * a * n[lang] // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
            rows.append((lang, -score, -a, b" ".join(p), left, right))
    out = []
    for lang, of in itertools.groupby(sorted(rows), key=lambda r: r[0]):
        for rank, (_, score, a, p, left, right) in zip(range(1, first + 1), of):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return out
