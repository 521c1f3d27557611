"""Excerpts of benchmark items at every offset."""

from __future__ import annotations

import random

import pytest

from txnlake.llm import decontaminate


def words(rng, count):
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(count))


@pytest.mark.parametrize("edits", [0, 8])
@pytest.mark.parametrize("size", [95, 135, 170])
def test_every_offset(size, edits):
    rng = random.Random(size + edits)
    item, before, after = words(rng, 60), words(rng, 40), words(rng, 40)
    item = item[:345].strip()
    texts = []
    for offset in range(len(item) - size + 1):
        excerpt = list(item[offset:offset + size])
        for place in rng.sample(range(size), edits):
            excerpt[place] = rng.choice(["7", "7" + excerpt[place]])
        texts.append(f"{before} {''.join(excerpt)} {after}")
    found = decontaminate.Passages([(5, item)]).search(texts)
    assert [[one["item_id"] for one in own] for own in found] == [[5]] * len(texts)
    assert decontaminate.Passages([(5, item)]).search([f"{before} {after}"]) == [[]]


@pytest.mark.parametrize("size", [50, 53, 60, 70, 79, 80, 94])
def test_short_excerpts(size):
    """Exact excerpts from 50 characters on, at every offset; 49 characters of a longer item are not one."""
    rng = random.Random(size)
    item, before, after = words(rng, 60)[:345].strip(), words(rng, 40), words(rng, 40)
    texts = [f"{before} 7{item[at:at + size]}7 {after}" for at in range(len(item) - size + 1)]
    # A blank at an end of an excerpt stays beside a digit, so all of it is there.
    found = decontaminate.Passages([(5, item)]).search(texts)
    assert [[one["item_id"] for one in own] for own in found] == [[5]] * len(texts)
    for own, text in zip(found, texts):
        assert (own[0]["edits"], own[0]["end"] - own[0]["start"] >= size) == (0, True)
    short = [f"{before} 7{item[at:at + 49]}7 {after}" for at in range(0, 250, 7)]
    assert decontaminate.Passages([(5, item)]).search(short) == [[]] * len(short)


@pytest.mark.parametrize("size", [1, 2, 10, 13, 29, 39])
def test_short_items(size):
    rng = random.Random(size)
    item = words(rng, 20)[:size].replace(" ", "a", 1) if size < 3 else words(rng, 20)[:size - 1].strip() + "x"
    own = decontaminate.Passages([(7, item), (8, item), (9, "!?")])
    hit = [item, f"so {item.upper()}, yes", f"{item}!", f"x\n{item}"]
    miss = [f"{item}s", f"s{item} s{item}", "", item[:-1], f"9{item}"]
    assert [[one["item_id"] for one in row] for row in own.search(hit + miss)] == [[7, 8]] * len(hit) + [[]] * len(miss)
    start = own.search(hit)[1][0]
    assert (start["start"], start["end"], start["edits"]) == (3, 3 + len(item), 0)


def test_halves_of_a_long_passage():
    """160 characters from the start, or the last ones, with 16 edits at any places."""
    rng = random.Random(9)
    item = words(rng, 80)[:333].strip()
    for begin in (0, 80, len(item) - 160):
        for _ in range(40):
            part = list(item[begin:begin + 160])
            for place in rng.sample(range(160), 16):
                part[place] = "7"
            found = decontaminate.Passages([(5, item)]).search([f"{words(rng, 9)} {''.join(part)} {words(rng, 9)}"])
            assert [one["item_id"] for one in found[0]] == [5]


def test_hashes_of_any_size():
    import numpy as np
    codes = np.random.default_rng(1).integers(32, 50, 300).astype(np.uint32)
    for size in (1, 2, 3, 5, 8, 13, 31, 32, 39):
        hashes = decontaminate.window_hashes(codes, size)
        assert len(hashes) == 300 - size + 1
        same = {}
        for at, value in enumerate(hashes.tolist()):
            assert same.setdefault(codes[at:at + size].tobytes(), value) == value
        assert len(set(same.values())) == len(same)
    assert len(decontaminate.window_hashes(codes[:4], 5)) == 0
