"""Plain versions of the contracts, one text or pair at a time."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

KINDS = {
    "assign": (re.compile(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
                          r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?"
                          r"([A-Za-z0-9+/_.=-]+)"), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 32),
}


def utf8(text):
    return (text or "").encode()


def secrets(text):
    found = []
    for place, (kind, (pattern, group, least)) in enumerate(KINDS.items()):
        found += [(m.start(), place, kind, m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    counts = [sum(one[2] == kind for one in found) for kind in KINDS]
    spans = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found))
    return (*counts, hashlib.sha256(spans.encode()).hexdigest(), spans)


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 4 == 2


def simhash(text, words=4):
    tokens = re.findall(rb"[^\x20\x09-\x0d]+", utf8(text).lower())
    if not tokens:
        return 0
    shingles = [b" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(one, 42) for one in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(one >> bit & 1 for one in hashes) > len(hashes))


def groups(nodes, links):
    """Smallest connected node for each node."""
    root = {node: node for node in nodes}

    def find(node):
        while root[node] != node:
            node = root[node]
        return node

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


def simhash_groups(rows, distance=4):
    """(id, fingerprint, smallest id) of (id, text) rows."""
    prints = [simhash(text) for _, text in rows]
    size = len(rows)
    links = [(i, j) for i in range(size) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= distance]
    root = groups(range(size), links)
    least = {}
    for place, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root[place]] = min(doc_id, least.get(root[place], doc_id))
    return [(doc_id, f"{prints[place]:016x}", least.get(root[place])) for place, (doc_id, _) in enumerate(rows)]


def able(vector):
    return bool(vector) and all(x is not None and np.isfinite(x) for x in vector) and any(x != 0 for x in vector)


def embedding_groups(rows, threshold=0.93):
    """(id, links, smallest id, kept) of (id, vector, label) rows."""
    unit = [np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if able(v) else None for _, v, _ in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i)
             if rows[i][2] is not None and rows[i][2] == rows[j][2] and unit[i] is not None and unit[j] is not None
             and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= threshold]
    root, count = groups(range(len(rows)), links), [0] * len(rows)
    for i, j in links:
        count[i] += 1
        count[j] += 1
    least = {}
    for place, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            least[root[place]] = min(vec_id, least.get(root[place], vec_id))
    return [(vec_id, count[place], least.get(root[place]), vec_id is not None and vec_id == least.get(root[place]))
            for place, (vec_id, _, _) in enumerate(rows)]


def tokenizer(name):
    own = Tokenizer.from_file(public_tokenizers.path(name))
    own.no_truncation()
    own.no_padding()
    return own


def bpe(own, text):
    ids = own.encode(text or "", add_special_tokens=False).ids
    digest = lambda value: hashlib.sha256(value.encode()).hexdigest()
    return len(ids), digest(" ".join(map(str, ids))), digest(own.decode(ids, skip_special_tokens=False))


def record(own, text):
    ids = own.encode(text or "", add_special_tokens=False).ids + [0]
    return len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())


def edit_distance_within(passage, text):
    """Fewest edits of the passage against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, letter in enumerate(passage, 1):
        following = [i]
        for j, other in enumerate(text, 1):
            following.append(min(row[j - 1] + (letter != other), row[j] + 1, following[j - 1] + 1))
        row = following
    return min(row)


def word_list(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", utf8(text))


def fills(sizes, repeats=3, weights=(5, 2, 1)):
    """Target of each source, with what is left at a limit shared again one pass at a time."""
    names = sorted((name for name in sizes if name is not None), key=str.encode) + [None] * (None in sizes)
    weight = {name: weights[place % len(weights)] for place, name in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = [name for name in names if name not in full]
        if not left:
            return {name: float(repeats * sizes[name]) for name in names}
        rate = (total - sum(repeats * sizes[name] for name in full)) / sum(weight[name] for name in left)
        above = {name for name in left if weight[name] * rate > repeats * sizes[name]}
        if not above:
            return {name: min(weight[name] * rate, float(repeats * sizes[name])) for name in names}
        full |= above


def mixed(rows, qualities):
    """(id, size, source size, target, taken) of (id, text, source) rows."""
    sizes, keyed = {}, {}
    for doc_id, text, source in rows:
        size = len(word_list(text))
        sizes[source] = sizes.get(source, 0) + size
        digest = hashlib.md5(utf8(text)).hexdigest()
        own = hashlib.md5(f"mix:{'' if doc_id is None else doc_id}:{size}:{digest}".encode()).hexdigest()
        key = -np.log((int(own[:13], 16) + 0.5) / 2 ** 52) / qualities.get(doc_id, 1.0)
        keyed.setdefault(source, []).append((key, doc_id is not None, doc_id or 0, size))
    result, aimed = [], fills(sizes) if rows else {}
    for source, own in keyed.items():
        budget = int(np.floor(aimed[source] + 0.5))
        epochs, rest = divmod(budget, sizes[source]) if sizes[source] else (0, 0)
        for _, there, doc_id, size in sorted(own):
            part = min(size, max(0, rest))
            rest -= size
            result.append((doc_id if there else None, size, sizes[source], aimed[source], epochs * size + part))
    return result


def planted_words(doc_id, text):
    """The words of a document as the contract repeats them."""
    words = word_list(text)
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def word_runs(words, shortest=12):
    """(start, length, smallest period) of all maximal runs, one period after the other."""
    number = {word: place for place, word in enumerate(dict.fromkeys(words))}
    codes = np.array([number[word] for word in words], np.int64)
    found = {}
    for period in range(1, len(codes) // 2 + 1):
        same = np.concatenate([[0], codes[period:] == codes[:-period], [0]]).astype(np.int8)
        for start, end in zip(np.flatnonzero(np.diff(same) == 1).tolist(), np.flatnonzero(np.diff(same) == -1).tolist()):
            if end - start + period >= max(shortest, 2 * period):
                found.setdefault((start, end - start + period), period)
    return sorted((start, length, period) for (start, length), period in found.items())


def run_digests(doc_id, text):
    """The row of a document: runs and collapsed text as digests."""
    words = planted_words(doc_id, text)
    found = word_runs(words)
    dropped = {place for start, length, period in found for place in range(start + period, start + length)}
    best = max(found, key=lambda one: (one[1], -one[0], -one[2]), default=(None, None, None))
    return (len(found), best[0], best[1], best[2], 1000 * best[1] // best[2] if found else None,
            hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(word for place, word in enumerate(words) if place not in dropped)).hexdigest())


def whitened(rows, components=8):
    """Usable ids, their exact deviations, n, leading components, their variances and the coordinates of each vector."""
    good = [(vec_id, v) for vec_id, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    width = max({len(v) for _, v in good}, key=lambda size: (sum(len(v) == size for _, v in good), size), default=0)
    good = [(vec_id, [int(np.floor(1024 * float(c))) + 100_000 for c in v]) for vec_id, v in good if len(v) == width]
    n, sums = len(good), [sum(x[place] for _, x in good) for place in range(width)]
    deviations = [sum((n * entry - total) ** 2 for entry, total in zip(x, sums)) for _, x in good]
    z = np.array([[(n * entry - total) / n for entry, total in zip(x, sums)] for _, x in good]).reshape(n, width)
    values, axes = np.linalg.eigh(z.T @ z / max(1, n))
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return [one[0] for one in good], deviations, n, values, (z @ axes) / np.sqrt(values), float((z * z).sum() / max(1, n))
