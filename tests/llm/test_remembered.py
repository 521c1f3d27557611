"""What the encoder of token records remembers of the words it meets."""

from __future__ import annotations

import random

import brute
import numpy as np
import public_tokenizers

from txnlake.llm import records


def test_common_words_stay(monkeypatch):
    """Words in use are worked out once, however many rare ones pass by; ids are those of the library."""
    monkeypatch.setattr(records, "REMEMBERED", 200)
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
    common = [word() for _ in range(100)]
    texts = [" ".join([*common, *(word() for _ in range(30)), "x" * (70 if place % 50 == 0 else 7), "Ünï, 12\n"]) for place in range(150)]
    own, library = records.Encoder(public_tokenizers.path("byte_bpe_50k.json")), brute.tokenizer("byte_bpe_50k.json")
    asked, inner = [], own._word
    own._word = lambda one: (asked.append(one), inner(one))[1]
    for text in texts:
        assert np.frombuffer(own.encode(text), own.kind).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(own.known) + len(own.earlier) < 1000
    common = {" " + one for one in common[1:]}
    assert sum(one in common for one in asked) == len(common)
