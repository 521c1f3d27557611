"""Periodic runs against all periods one after the other."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from txnlake.llm import runs
from txnlake.llm.queries import QUERIES


@pytest.mark.parametrize("name", ["edge", "small"])
def test_query(request, spark, folder, name):
    source = request.getfixturevalue("edge") if name == "edge" else folder
    rows = spark.read.parquet(f"{source}/documents.parquet").select("doc_id", "text").collect()
    found = [tuple(row) for row in QUERIES["op12_square_runs"](spark, source).collect()]
    assert sorted(map(repr, found)) == sorted(repr((one, *brute.run_digests(one, text))) for one, text in rows)


def sequences(rng):
    words = lambda size, letters: [rng.randrange(letters) for _ in range(size)]
    size = rng.randint(0, 150)
    kind = rng.randrange(6)
    if kind < 2:
        return words(size, 2 + kind)
    if kind == 2:
        unit = words(rng.randint(1, 30), rng.choice([2, 5, 50]))
        return words(rng.randint(0, 9), 3) + (unit * 40)[:size] + words(rng.randint(0, 9), 3)
    if kind == 3:
        return [0] * size
    a, b = [0], [0, 1]
    while len(b) < size:
        a, b = b, b + a if kind == 4 else b + [1 - x for x in b]
    return b[:size]


@pytest.mark.parametrize("portion", [1, 3, 17, 1 << 16])
def test_random(portion, monkeypatch):
    monkeypatch.setattr(runs, "PORTION", portion)
    rng = random.Random(portion)
    for _ in range(60):
        rows = [sequences(rng) for _ in range(rng.randint(0, 5))]
        for exact in (False, True):
            found = runs.find_runs([np.array(row, np.int64) for row in rows], exact=exact)
            assert [list(map(tuple, one.tolist())) for one in found] == [brute.word_runs(row) for row in rows]


def test_fingerprints_that_collide():
    """The Thue-Morse sequence deceives sums modulo 2^64; its runs are right all the same."""
    row = [0]
    while len(row) < 4096:
        row += [1 - x for x in row]
    assert list(map(tuple, runs.find_runs([np.array(row)])[0].tolist())) == brute.word_runs(row)


def test_long_text(monkeypatch):
    """Words of a long text are split in parts, and it is searched in portions."""
    rng = random.Random(2)
    unit = [f"w{rng.randrange(60)}" for _ in range(700)]
    text = ("\t".join(unit) + " é\x1c\x85 ") * 30
    expected, short = runs.search_texts([text.encode()])
    monkeypatch.setattr(runs, "PIECE", 100)
    monkeypatch.setattr(runs, "PORTION", 1000)
    found, other = runs.search_texts([text.encode()])
    assert found[0].tolist() == expected[0].tolist() == [list(one) for one in brute.word_runs(brute.word_list(text))]
    assert other == short == [b" ".join(brute.word_list(text)[:701])]


def test_neighbours_do_not_matter(spark):
    texts = ["a b " * 8, None, "", " \t\n", "x " * 12, "x " * 11, "a b " * 8, "q w e r t z " * 2 + "q"]
    rows = spark.createDataFrame([(place, text, "r") for place, text in enumerate(texts)], "id int, text string, runs string")
    found = {row["id"]: row for row in runs.periodic_runs(rows).collect()}
    assert [[tuple(one) for one in found[place]["runs"]] for place in range(8)] == [
        [(0, 16, 2)], [], [], [], [(0, 12, 1)], [], [(0, 16, 2)], [(0, 13, 6)]]
    assert [found[place]["collapsed"] for place in range(8)] == ["a b", "", "", "", "x", ("x " * 11).strip(), "a b", "q w e r t z"]
