"""Preference pairs on edge cases, gaps between ids and single conversations against a plain version."""

from __future__ import annotations

import duckdb
import pytest

from txnlake.llm import chat
from txnlake.llm.oracles import ORACLE
from txnlake.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def order(turn):
    return (turn[0] is not None, turn[0] or 0, turn[1].encode(), turn[2].encode())


def ending(turns):
    text, spans = "", []
    for _, role, said in turns:
        piece = f"<|{role}|>\n{said}\n"
        if role == "assistant":
            spans.append(f"{len(text)}:{len(text) + len(piece)}")
        text += piece
    return text, ",".join(spans)


def plain(rows):
    """Pairs of a whole table, one conversation at a time."""
    talks = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            talks.setdefault(conv, set()).add((turn, role or "", text or ""))
    lasts = {}
    for conv, turns in talks.items():
        replies = [one for one in turns if one[1] == "assistant" and one[0] is not None]
        if replies:
            number = max(one[0] for one in replies)
            lasts[conv] = (number, min((one[2] for one in replies if one[0] == number), key=str.encode))
    ids, found = sorted(lasts), []
    for conv, turns in talks.items():
        other = set(turns)
        if conv in lasts:
            number = lasts[conv][0]
            other = {one for one in turns if one[0] != number or one[1] != "assistant"}
            if len(ids) > 1:
                other.add((number, "assistant", lasts[ids[(ids.index(conv) + 1) % len(ids)]][1]))
        differing = sorted(turns ^ other, key=order)
        before = lambda one: not differing or order(one)[:2] < order(differing[0])[:2]
        prompt = sorted((one for one in turns & other if before(one)), key=order)
        chosen, rejected = (ending(sorted((one for one in side if not before(one)), key=order)) for side in (turns, other))
        found.append((conv, ending(prompt)[0], chosen[0], rejected[0], chosen[1], rejected[1]))
    return sorted(found)


def edge_rows(tables):
    return [row[:4] for row in tables["conversations"]]


CASES = {
    "gaps": [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (7, 0, "user", "a"), (7, 1, "assistant", "c"), (1000, 3, "assistant", "d"),
             (1000, 3, "assistant", "\U0001f642"), (1000, 3, "user", "\u00e9")],
    "single": [(4, 0, "user", "a"), (4, 1, "assistant", "b"), (5, 0, "user", "no reply")],
    "same reply": [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "c"), (2, 1, "assistant", "b")],
    "later turns": [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (2, 5, "assistant", "x"), (2, 6, None, None)],
    "numbers": [(1, -(2**63), "assistant", "low"), (1, 2**63 - 1, "assistant", "high"), (2, None, "assistant", "none"), (2, 0, "assistant", "z")],
}


@pytest.mark.parametrize("name", ["edge", *CASES])
def test_pairs_equal_the_plain_version(spark, tables, name):
    rows = edge_rows(tables) if name == "edge" else CASES[name]
    turns = spark.createDataFrame(rows, SCHEMA)
    pairs = chat.preference_pairs(turns, chat.swapped_replies(turns))
    masks = [chat.mask_text(pairs[name]).alias(name) for name in ("chosen_mask", "rejected_mask")]
    found = pairs.select("pair_id", "prompt", "chosen", "rejected", *masks).collect()
    assert sorted(map(tuple, found)) == plain(rows)


@pytest.mark.parametrize("where", ["edge", "empty"])
def test_query_and_sql(spark, where, request):
    folder = request.getfixturevalue(where)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    found = QUERIES["op5_preference_format"](spark, folder)
    expected = connection.execute(ORACLE["op5_preference_format"])
    names = [one[0] for one in expected.description]
    assert sorted(names) == sorted(found.columns)
    assert sorted(map(repr, map(tuple, found.select(*names).collect()))) == sorted(map(repr, expected.fetchall()))


def test_given_pairs_need_no_swap(spark):
    chosen = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "good"), (2, 0, "user", "only here")], SCHEMA)
    rejected = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "bad"), (3, 0, "user", "only there")], SCHEMA)
    found = {row.pair_id: row for row in chat.preference_pairs(chosen, rejected).collect()}
    assert found[1].prompt == "<|user|>\nq\n" and found[1].chosen == "<|assistant|>\ngood\n"
    assert [tuple(one) for one in found[1].rejected_mask] == [(0, len("<|assistant|>\nbad\n"))]
    assert found[2].prompt == found[2].rejected == found[3].prompt == found[3].chosen == ""
    assert found[2].chosen_mask == [] and found[3].rejected == "<|user|>\nonly there\n"
