"""The nearest examples of whole texts against a plain TF-IDF cosine."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np

from txnlake.llm import toxicity


def test_neighbours(spark):
    rng = random.Random(5)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    texts = {i: " ".join(rng.choice(words[:40] if rng.random() < 0.5 else words) for _ in range(rng.randint(3, 60)))
             for i in range(500)}
    labels = [(i, int(i % 3 == 0)) for i in range(500)]
    scored = toxicity.toxicity(spark.createDataFrame(list(texts.items()), "doc_id long, text string"),
                               spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    counts = {i: Counter(text.split()) for i, text in texts.items()}
    frequency = Counter(word for one in counts.values() for word in one)
    vectors = {}
    for i, one in counts.items():
        own = {word: (1 + math.log(n)) * (math.log((1 + len(texts)) / (1 + frequency[word])) + 1) for word, n in one.items()}
        length = math.sqrt(sum(x * x for x in own.values()))
        vectors[i] = {word: x / length for word, x in own.items()}
    examples = [row["doc_id"] for row in scored if not row["held_out"]]
    assert len(examples) > 2 * toxicity.BLOCK
    for row in scored:
        own = vectors[row["doc_id"]]
        cosines = {i: sum(x * vectors[i].get(word, 0.0) for word, x in own.items()) for i in examples}
        expected = sorted((x for x in cosines.values() if x > 1e-8), reverse=True)[:toxicity.NEIGHBOURS]
        assert len(row["evidence"]) == len(expected)
        for one, cosine in zip(row["evidence"], expected):
            assert abs(one["cosine"] - cosine) < 1e-8 and abs(cosines[one["id"]] - cosine) < 1e-8


def test_stems(spark):
    """Insults with ever new endings are known by their stems, which count as terms of the cosine."""
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda least: "".join(rng.choice(letters) for _ in range(rng.randint(least, 9)))
    common = [word(3) for _ in range(150)]
    texts, labels = {}, []
    for i in range(1200):
        words = [rng.choice(common) for _ in range(rng.randint(20, 80))] + [word(7) for _ in range(10)]
        if i % 4 == 0:
            words += [rng.choice(["grobia", "lumpen"]) + word(3) for _ in range(2)]
        rng.shuffle(words)
        texts[i] = " ".join(words)
        labels.append((i, int(i % 4 == 0)))
    scored = toxicity.toxicity(spark.createDataFrame(list(texts.items()), "doc_id long, text string"),
                               spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [row for row in scored if row["held_out"]]
    caught = [row["predicted"] for row in held if row["doc_id"] % 4 == 0]
    alone = [1 - row["predicted"] for row in held if row["doc_id"] % 4]
    assert sum(caught) >= 0.9 * len(caught) and sum(alone) >= 0.9 * len(alone)

    examples = [row["doc_id"] for row in scored if not row["held_out"]]
    told = np.array([i % 4 == 0 for i in examples], float)
    stems = toxicity.telling_stems([texts[i] for i in examples], told)
    assert {b"grob", b"grobi", b"grobia", b"lump", b"lumpe", b"lumpen"} <= set(stems)
    known = {stem.decode() for stem in stems}
    counts = {}
    for i, text in texts.items():
        counts[i] = Counter(text.split())
        for one, n in list(counts[i].items()):
            counts[i].update({("stem", one[:k]): n for k in toxicity.STEMS if len(one) >= k and one[:k] in known})
    frequency = Counter(term for one in counts.values() for term in one)
    vectors = {}
    for i, one in counts.items():
        own = {term: (1 + math.log(n)) * (math.log((1 + len(texts)) / (1 + frequency[term])) + 1) for term, n in one.items()}
        length = math.sqrt(sum(x * x for x in own.values()))
        vectors[i] = {term: x / length for term, x in own.items()}
    for row in held[:60]:
        own = vectors[row["doc_id"]]
        cosines = sorted((sum(x * vectors[i].get(term, 0.0) for term, x in own.items()) for i in examples), reverse=True)
        for one, cosine in zip(row["evidence"], cosines[:toxicity.NEIGHBOURS], strict=True):
            assert abs(one["cosine"] - cosine) < 1e-8


def test_bounds():
    """The bounds read few blocks, and the neighbours are those of all products."""
    rng = np.random.default_rng(3)
    size, terms, asked = 1024, 600, 40
    group = np.arange(size) % 16
    vectors = np.zeros((size, terms))
    for place in range(size):
        vectors[place, rng.integers(0, 24, 12)] = rng.uniform(0.1, 0.3, 12)
        vectors[place, 24 + group[place]] = 4
        vectors[place, 100 + rng.integers(0, 500, 25)] = rng.uniform(1, 2, 25)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    row, term = np.nonzero(vectors)
    often = np.bincount(term, minlength=terms)
    index = toxicity.Index(row, term, vectors[row, term], vectors[row, term] * often[term], size, terms)
    places = index.order
    left_out = rng.integers(0, size, asked)
    queries = vectors[places[left_out]]
    read, inner = [], index._read
    index._read = lambda *given: (read.append(next(one for one in given if np.ndim(one) == 2 and one.dtype == bool).sum()), inner(*given))[1]
    row, term = np.nonzero(queries)
    near, where = index.nearest(asked, row, term, queries[row, term], 15, left_out)
    every = np.round(queries @ vectors[places].T, toxicity.DECIMALS)
    every[np.arange(asked), left_out] = 0
    for own in range(asked):
        expected = np.lexsort((np.arange(size), -every[own]))[:15]
        assert where[own].tolist() == expected.tolist()
        assert np.abs(near[own] - every[own, expected]).max() < 1e-8
    assert sum(read) <= 0.25 * asked * index.blocks, sum(read) / asked / index.blocks
