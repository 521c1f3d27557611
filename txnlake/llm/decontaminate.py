"""Benchmark passages in texts: q-gram counts in diagonal bands, verified by banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from txnlake.llm.common import whole

#: Length of a q-gram.
Q = 8
#: Characters of the longest passage; of longer items, windows are searched.
PASSAGE = 160
#: Characters of the windows of an item, and from one window's start to the next. Every excerpt of
#: WINDOW + STRIDE - 1 characters holds a whole window, wherever it begins.
WINDOW, STRIDE = 80, 16
#: Edits that a passage or window may have for each of its characters.
EDIT_SHARE = 0.1
#: Characters of the shortest excerpt of a longer item, without any edit.
EXCERPT = 50
#: Characters of its seeds, a power of two, and from one to the next: every excerpt holds a whole seed.
SEED, SEED_STEP = 32, 16
#: Shorter items match as a whole, between borders of words and without any edit.
WHOLE = 40
#: Diagonals that a band advances by; it is longer by the edit budget, so bands overlap.
BAND = 16
#: Characters of items in one index, which is what a task holds in memory.
BLOCK_CHARS = 1 << 20
#: Characters of texts searched at a time.
SLICE = 1 << 20
#: Candidates aligned at a time.
ALIGNED = 1 << 11
MOST_EDITS = int(PASSAGE * EDIT_SHARE)
#: Marks between texts: more than any budget of edits, so no passage reaches across.
GAP = BAND + 4 * (MOST_EDITS + 1)
BITMAP = 22
MATCH = "array<struct<item_id:long,passages:int,edits:int,start:int,`end`:int>>"


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """The code of each letter or digit, else that of a space; the last code is the mark."""
    codes = np.full(0x110001, 32, np.uint32)
    known = np.fromiter((code for code in range(0x110000) if chr(code).isalnum()), np.int64)
    codes[known] = known
    codes[0x110000] = 0x110000
    return codes


def lowered(text: str) -> str:
    """Lower case, one character for each."""
    low = text.lower()
    return low if len(low) == len(text) else "".join([x if len(x := c.lower()) == 1 else c for c in text])


def normalised(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, places, starts): texts in lower case, each run of other signs as one space.

    Texts are divided by GAP marks. places are the positions of the codes in the joined texts,
    starts the position where each text begins there.
    """
    parts = [lowered(text) for text in texts]
    lengths = np.array([len(part) for part in parts], np.int64)
    starts = np.cumsum(lengths + GAP) - lengths
    codes = np.full(int((lengths + GAP).sum()) + GAP, 0x110000, np.uint32)
    flat = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    spot = np.arange(len(flat)) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    codes[spot] = flat
    codes = _kinds()[codes]
    keep = np.ones(len(codes), bool)
    space = codes == 32
    keep[1:] = ~(space[1:] & space[:-1])
    places = np.flatnonzero(keep)
    return codes[places], places, starts


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A polynomial hash of so many codes from each place on, put together from powers of two."""
    if len(codes) < size:
        return np.zeros(0, np.uint64)
    base, result, done = 0x9E3779B97F4A7C15, None, 0
    hashes, width = codes.astype(np.uint64), 1
    while True:
        if size & width:
            # What is there already lies before this part.
            result = hashes if result is None else result[:len(codes) - done - width + 1] * np.uint64(
                pow(base, width, 1 << 64)) + hashes[done:]
            done += width
        if 2 * width > size:
            return result * np.uint64(0xD6E8FEB86659FD93)
        hashes, width = hashes[:-width] * np.uint64(pow(base, width, 1 << 64)) + hashes[width:], 2 * width


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of the q-grams from each place on."""
    return window_hashes(codes, Q)


class Table:
    """Places of some hashes, with a bitmap that answers most questions."""

    def __init__(self, hashes: list[np.ndarray]):
        flat = np.concatenate([np.zeros(0, np.uint64), *hashes])
        self.order = np.argsort(flat, kind="stable")
        self.hashes, self.first = np.unique(flat[self.order], return_index=True)
        self.counts = np.diff(np.append(self.first, len(flat)))
        self.bitmap = np.zeros(1 << BITMAP, bool)
        self.bitmap[self.hashes >> np.uint64(64 - BITMAP)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, number of the hash) of all known ones."""
        at = np.flatnonzero(self.bitmap[hashes >> np.uint64(64 - BITMAP)]) if len(self.hashes) else np.zeros(0, np.int64)
        spot = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        real = self.hashes[spot] == hashes[at] if len(at) else np.zeros(0, bool)
        return at[real], spot[real]

    def entries(self, spot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(how many entries each hash has, the entries of all)."""
        often = self.counts[spot]
        return often, self.order[np.repeat(self.first[spot] - (np.cumsum(often) - often), often) + np.arange(often.sum())]


class Passages:
    """The passages of some benchmark items with indexes of their q-grams, seeds and short wholes."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items, self.codes = [], []
        seeds, wholes, self.wholes = [], {}, {}
        self.seed_item, self.seed_place, self.long = [], [], []
        for item, text in items:
            codes, _, _ = normalised([text])
            inside = np.flatnonzero((codes != 0x110000) & (codes != 32))
            codes = codes[inside[0]:inside[-1] + 1] if len(inside) else codes[:0]
            if 0 < len(codes) < WHOLE:
                wholes.setdefault(len(codes), []).append((item, codes))
            if len(codes) < WHOLE:
                continue
            for passage in self._passages(codes):
                self.items.append(item)
                self.codes.append(passage)
            if len(codes) > EXCERPT:
                starts = np.unique(np.append(np.arange(0, len(codes) - SEED + 1, SEED_STEP), len(codes) - SEED))
                seeds.append(window_hashes(codes, SEED)[starts])
                self.seed_item += [len(self.long)] * len(starts)
                self.seed_place += starts.tolist()
                self.long.append((item, codes))
        self.seeds = Table(seeds)
        self.seed_item, self.seed_place = np.array(self.seed_item, np.int64), np.array(self.seed_place, np.int64)
        for size, own in wholes.items():
            self.wholes[size] = (Table([window_hashes(codes, size) for _, codes in own]), own)
        self.sizes = sizes = np.array([len(passage) for passage in self.codes], np.int64)
        self.budgets = (sizes * EDIT_SHARE).astype(np.int64)
        # Q-gram lemma: so many q-grams stay, in a band of as many diagonals as edits plus one.
        self.least = sizes + 1 - Q * (self.budgets + 1)
        hashes = [gram_hashes(passage) for passage in self.codes]
        self.grams = Table(hashes)
        self.owner = np.repeat(np.arange(len(hashes)), [len(one) for one in hashes])
        self.place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(one)) for one in hashes]])

    @classmethod
    def _passages(cls, codes: np.ndarray) -> list[np.ndarray]:
        """A short item whole; windows of a longer one.

        Up to PASSAGE characters both. Longer passages need not be searched: cut into halves, one half has
        at most half of the edits, and both halves of the last passage are windows too.
        """
        result = [codes] if len(codes) < PASSAGE else [codes[-PASSAGE:][:WINDOW]]
        return result + (cls._cut(codes, WINDOW, STRIDE) if len(codes) > WINDOW else [])

    @staticmethod
    def _cut(codes: np.ndarray, size: int, step: int) -> list[np.ndarray]:
        """Parts of so many codes, one every step and one at the end."""
        last = max(0, len(codes) - size)
        return [codes[start:start + size] for start in sorted({*range(0, last, step), last})]

    def candidates(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, band) pairs that share enough q-grams with the text."""
        at, spot = self.grams.find(gram_hashes(codes))
        at, spot = self._dense(at, spot, len(codes))
        often, entry = self.grams.entries(spot)
        owner = self.owner[entry]
        # Diagonals are moved up by a passage, so that none is negative.
        diagonal = np.repeat(at, often) - self.place[entry] + PASSAGE
        bands = (len(codes) + PASSAGE) // BAND + 2
        key = owner * bands + diagonal // BAND + 1
        before = diagonal % BAND <= self.budgets[owner]
        keys = np.sort(np.concatenate([key, key[before] - 1]))
        if not len(keys):
            return keys, keys
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        shared = np.diff(np.append(starts, len(keys)))
        found = keys[starts]
        enough = shared >= self.least[found // bands]
        return found[enough] // bands, found[enough] % bands - 1

    def excerpts(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, first place, place after the last) of exact excerpts of at least EXCERPT characters."""
        at, spot = self.seeds.find(window_hashes(codes, SEED))
        often, entry = self.seeds.entries(spot)
        at, item, place = np.repeat(at, often), self.seed_item[entry], self.seed_place[entry]
        result: dict[tuple[int, int], tuple[int, int]] = {}
        for begin, number, start in zip(at.tolist(), item.tolist(), place.tolist()):
            name, own = self.long[number]
            known = result.get((number, begin - start))
            if known and known[0] <= begin < known[1] or (codes[begin:begin + SEED] != own[start:start + SEED]).any():
                continue
            low = min(begin, start)
            apart = np.flatnonzero(codes[begin - low:begin] != own[start - low:start])
            first = begin - low + int(apart[-1]) + 1 if len(apart) else begin - low
            high = min(len(codes) - begin, len(own) - start)
            apart = np.flatnonzero(codes[begin:begin + high] != own[start:start + high])
            result[number, begin - start] = first, begin + (int(apart[0]) if len(apart) else high)
        return [(self.long[number][0], first, after) for (number, _), (first, after) in result.items() if after - first >= EXCERPT]

    def whole_items(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, first place, place after the last) of short items between borders of words."""
        border = np.concatenate([[True], (codes == 32) | (codes == 0x110000), [True]])
        result = []
        for size, (known, items) in self.wholes.items():
            at, spot = known.find(window_hashes(codes, size))
            free = border[at] & border[at + size + 1]
            often, entry = known.entries(spot[free])
            for begin, one in zip(np.repeat(at[free], often).tolist(), entry.tolist()):
                if (codes[begin:begin + size] == items[one][1]).all():
                    result.append((items[one][0], begin, begin + size))
        return result

    def _dense(self, at: np.ndarray, spot: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hits with enough others around for the least demanding passage."""
        if not len(at) or not len(self.least):
            return at[:0], spot[:0]
        reach = PASSAGE + MOST_EDITS
        near = np.searchsorted(at, at + reach, side="right") - np.searchsorted(at, at - reach)
        dense = near >= self.least.min()
        return at[dense], spot[dense]

    def align(self, codes: np.ndarray, passage: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(edits, first place, place after the last) of the best alignment inside each band.

        A cell holds edits and start together; a row takes a substitution, a letter left out and,
        by a running minimum, letters put in.
        """
        lengths, most = self.sizes[passage], int(self.budgets[passage].max())
        width, size = BAND + 3 * (most + 1), int(lengths.max())
        base = band * BAND - PASSAGE - most
        letters = np.zeros((len(passage), size), np.uint32)
        for row, one in enumerate(passage):
            letters[row, :lengths[row]] = self.codes[one]
        place = base[:, None] + np.arange(width + size)
        around = codes[np.clip(place, 0, len(codes) - 1)]
        around[(place < 0) | (place >= len(codes))] = 0x110000
        step = np.int32(1 << 20)
        across = np.arange(width, dtype=np.int32)
        cells = np.tile(across, (len(passage), 1))
        edits = np.full(len(passage), most + 1, np.int64)
        first, after = np.zeros(len(passage), np.int64), np.zeros(len(passage), np.int64)
        live, ends, limit = np.arange(len(passage)), set(lengths.tolist()), step * (self.budgets[passage] + 1).astype(np.int32)
        for row in range(size):
            following = cells + step * (around[:, row:row + width] != letters[:, row, None])
            following[:, :-1] = np.minimum(following[:, :-1], cells[:, 1:] + step)
            cells = np.minimum.accumulate(following - step * across, axis=1) + step * across
            if row + 1 in ends or row % 8 == 7:
                done = lengths[live] == row + 1
                best = cells.argmin(axis=1)
                value = cells[np.arange(len(live)), best]
                own = live[done]
                edits[own], first[own] = value[done] // step, base[own] + value[done] % step
                after[own] = base[own] + lengths[own] + best[done]
                # Edits never become fewer, so what is over its budget is given up.
                going = ~done & (value < limit[live])
                if not going.all():
                    live, cells, around, letters = live[going], cells[going], around[going], letters[going]
                    if not len(live):
                        break
        return edits, first, after

    def search(self, texts: list[str]) -> list[list[dict]]:
        """Matches of each text: item_id, passages found, fewest edits, start and end in the text."""
        matches: list[dict] = [{} for _ in texts]
        codes, places, starts = normalised(texts)

        def note(item: int, passage, edits: int, first: int, after: int) -> None:
            begin, end = places[max(0, first)], places[min(len(places), after) - 1] + 1
            own = int(np.searchsorted(starts, (begin + end) // 2, side="right") - 1)
            if own >= 0:
                held = matches[own].setdefault(item, {"found": set(), "edits": edits, "start": begin, "end": end})
                held["found"].add(passage)
                held["edits"] = min(edits, held["edits"])
                held["start"], held["end"] = min(held["start"], begin), max(held["end"], end)

        passage, band = self.candidates(codes)
        # Passages of one length are aligned together.
        order = np.argsort(self.sizes[passage], kind="stable")
        passage, band = passage[order], band[order]
        for low in range(0, len(passage), ALIGNED):
            part = slice(low, low + ALIGNED)
            edits, first, after = self.align(codes, passage[part], band[part])
            for row in np.flatnonzero(edits <= self.budgets[passage[part]]):
                one = int(passage[part][row])
                note(self.items[one], one, int(edits[row]), int(first[row]), int(after[row]))
        for item, first, after in self.excerpts(codes):
            note(item, "excerpt", 0, first, after)
        for item, first, after in self.whole_items(codes):
            note(item, "whole", 0, first, after)
        return [[{"item_id": item, "passages": len(one["found"]), "edits": one["edits"],
                  "start": int(max(0, one["start"] - start)), "end": int(min(len(text), one["end"] - start))}
                 for item, one in sorted(found.items())] for found, start, text in zip(matches, starts, texts)]


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of bounded length; the driver holds one of them at a time."""
    held, size = [], 0
    for row in benchmark.select(F.col(item_id).cast("long"), text).filter(
            F.col(item_id).isNotNull() & F.col(text).isNotNull()).toLocalIterator():
        held.append((row[0], row[1]))
        size += len(row[1])
        if size >= BLOCK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _searched(text: Column, passages) -> Column:
    @F.pandas_udf(MATCH)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = passages.value
        for texts in batches:
            values, result, start, held = texts.tolist(), [], 0, 0
            for place, value in enumerate(values):
                held += len(value) + GAP
                if held >= SLICE or place == len(values) - 1:
                    result += own.search(values[start:place + 1])
                    start, held = place + 1, 0
            yield pd.Series(result, dtype=object)

    # Declared so, Spark evaluates it once and not again for a filter on the result.
    return run.asNondeterministic()(text)


def contamination(rows: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """All rows with matches: array<struct<item_id, passages, edits, start, end>>.

    A row matches an item if its whole text holds one of the item's passages with at most a tenth
    of its characters edited, after lower-casing and turning every run of signs into one space.
    Passages are windows of 80 characters every 16, and the whole item if it has 40 to 159. So
    every excerpt of 95 characters or more is found at any offset if at most 8 of them are edited;
    a longer one may have 8 edits for each whole 80 characters beyond its first 15, and so any 160
    characters from a multiple of 80 on may have 16. Shorter excerpts are found from 50 characters on
    without any edit. Items of fewer than 40 characters match as a whole, without any edit and between
    borders of words. passages counts what was found of the item, edits are the fewest of any of it, and
    start and end are characters of the text. Texts that are null or empty match nothing, nor do items
    without an id, a text or any letter or digit. Items of equal id are one item. The benchmark
    passes through the driver in blocks of a million characters, and a task holds an index of each
    block. A column named matches is replaced.
    """
    rows = rows.drop("matches")
    context = rows.sparkSession.sparkContext
    found = [_searched(whole(text), context.broadcast(Passages(block))) for block in _blocks(benchmark, item_id, item_text)]
    parts = [f"_matches{number}" for number in range(len(found))]
    searched = rows.withColumns(dict(zip(parts, found)))
    both = reduce(lambda a, b: F.concat(a, b), map(F.col, parts), F.array().cast(MATCH))
    return searched.withColumn("matches", both).drop(*parts)
