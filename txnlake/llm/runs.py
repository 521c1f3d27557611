"""Periodic runs of words: catchers over completed power-of-two blocks find squares as words are appended."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from txnlake.llm.common import whole

#: A run has at least so many words, and at least twice its period.
SHORTEST = 12
#: Words of the smallest block; it catches all periods below those of the next larger one.
SMALLEST = 2
#: Words appended at a time.
PORTION = 1 << 16
#: Bytes of short texts that are searched as one sequence.
SLICE = 1 << 19
#: Bytes of a text that are split into words at a time.
PIECE = 1 << 22
SPACE = b" \t\n\v\f\r"
RUNS = ArrayType(StructType([StructField(name, LongType()) for name in ("start", "length", "period")]))


def _mixed(codes: np.ndarray) -> np.ndarray:
    """A scattered 64-bit number for each code."""
    value = (codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(31)
    value *= np.uint64(0x94D049BB133111EB)
    return value ^ value >> np.uint64(29)


class Catchers:
    """Squares in a growing sequence of codes, merged into runs.

    Every completed block of 2^k codes, aligned to a multiple of its size, is a catcher. An
    appended code ends a suffix of 2^k codes, which is compared with the two blocks that lie
    between 2^(k+1) - 1 and 2^(k+2) - 2 codes before it (the smallest blocks take all shorter
    periods as well). Of a run with such a period p, the stretch of codes that are equal to those p
    before holds at least p codes, so it holds such a block: no run is missed. A catch is
    compared backwards once; then every appended code advances it until one differs. What holds a
    square, two periods, is a run.

    Blocks are compared by fingerprints, sums of codes times powers of an odd number modulo 2^64.
    Equal blocks always have equal fingerprints. Every reported run is verified code by code, and if
    any is wrong, the sequence is searched again with names of equal blocks instead (exact=True).
    """

    BASE = 0xD6E8FEB86659FD93

    def __init__(self, longest: int, shortest: int = SHORTEST, exact: bool = False):
        self.longest, self.shortest, self.exact = longest, shortest, exact
        self.size, self.codes = 0, np.zeros(0, np.int64)
        self.sums, self.power, self.inverse = np.zeros(1, np.uint64), np.ones(1, np.uint64), np.ones(1, np.uint64)
        self.open = np.zeros((3, 0), np.int64)
        self.closed: list[np.ndarray] = []
        self.names: list[np.ndarray] = []

    def _grow(self, codes: np.ndarray) -> None:
        size = self.size + len(codes)
        if size > len(self.codes):
            room = max(size, 2 * len(self.codes), PORTION)
            self.codes = np.concatenate([self.codes[:self.size], np.empty(room - self.size, np.int64)])
            for name, base in (("power", self.BASE), ("inverse", pow(self.BASE, -1, 1 << 64))):
                factors = np.full(room + 1, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors))
            self.sums = np.concatenate([self.sums[:self.size + 1], np.empty(room - self.size, np.uint64)])
        self.codes[self.size:size] = codes
        if not self.exact:
            terms = _mixed(codes) * self.inverse[self.size:size]
            self.sums[self.size + 1:size + 1] = self.sums[self.size] + np.cumsum(terms)
        self.size = size

    def _name(self) -> None:
        """Names of all blocks of each power of two: equal names for equal blocks."""
        self.names = [np.unique(self.codes[:self.size], return_inverse=True)[1]]
        width = 1
        while 2 * width <= min(self.size, self.longest):
            last = self.names[-1]
            pairs = last[:-width] * (int(last.max()) + 1) + last[width:]
            self.names.append(np.unique(pairs, return_inverse=True)[1])
            width *= 2

    def _prints(self, at, width: int) -> np.ndarray:
        """Fingerprints of the blocks of so many codes, a power of two, from some places on."""
        if self.exact:
            return self.names[width.bit_length() - 1][at]
        after = slice(at.start + width, at.stop + width) if isinstance(at, slice) else at + width
        return (self.sums[after] - self.sums[at]) * self.power[at]

    def _catches(self, block: int, low: int, shifts: int, since: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, period) of the suffixes that end at a code from `since` on and equal a block."""
        first, last = max(0, since - block + 1), self.size - block + 1
        places, periods = [], []
        for shift in range(shifts):
            start = max(first, low + shift * block)
            if start >= last:
                break
            number = (start - low) // block - shift
            blocks = np.arange(number, (last - 1 - low) // block - shift + 1) * block
            skipped = start - low - (number + shift) * block
            caught = np.repeat(self._prints(blocks, block), block)[skipped:skipped + last - start]
            hit = start + np.flatnonzero(caught == self._prints(slice(start, last), block))
            places.append(hit)
            periods.append(hit - ((hit - low) // block - shift) * block)
        return (np.concatenate(places), np.concatenate(periods)) if places else (np.zeros(0, np.int64),) * 2

    def _extent(self, place: np.ndarray, period: np.ndarray, ahead: bool) -> np.ndarray:
        """How many codes from each place on (or before it) equal those one period earlier."""
        total, level = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)

        def advance(some: np.ndarray, step: int) -> np.ndarray:
            at = place[some] + total[some] if ahead else place[some] - total[some] - step
            fits = at + step <= self.size if ahead else at >= period[some]
            some, at = some[fits], at[fits]
            same = self._prints(at, step) == self._prints(at - period[some], step)
            total[some[same]] += step
            return some[same]

        some, step = np.arange(len(place)), 1
        while len(some) and step <= self.longest:
            some = advance(some, step)
            level[some] = step
            step *= 2
        while step > 1:
            step //= 2
            advance(np.flatnonzero(level >= step), step)
        return total

    def append(self, codes: np.ndarray) -> None:
        """Append some codes; runs that they end are closed."""
        since = self.size
        self._grow(codes)
        if not self.exact:
            self._search(since)

    def _search(self, since: int) -> None:
        found = [self.open]
        block = SMALLEST
        while block == SMALLEST or 2 * block - 1 <= self.longest // 2:
            low, shifts = (1, -(-(4 * block - 2) // block)) if block == SMALLEST else (2 * block - 1, 2)
            place, period = self._catches(block, low, shifts, since)
            if len(place):
                start = place - period - self._extent(place, period, ahead=False)
                own = np.unique(start * (self.size + 1) + period, return_index=True)[1]
                found.append(np.stack([start[own], period[own], place[own] + block]))
            block *= 2
        # What is open already comes first, and the first of equal ones stays.
        start, period, reach = np.concatenate(found, axis=1)
        own = np.unique(start * (self.size + 1) + period, return_index=True)[1]
        start, period, reach = start[own], period[own], reach[own]
        reach = reach + self._extent(reach, period, ahead=True)
        self._close(start, period, reach, reach < self.size)
        self.open = np.stack([start, period, reach])[:, reach == self.size]

    def _close(self, start: np.ndarray, period: np.ndarray, reach: np.ndarray, done: np.ndarray) -> None:
        enough = done & (reach - start >= np.maximum(self.shortest, 2 * period))
        self.closed.append(np.stack([start, reach, period])[:, enough])

    def runs(self) -> np.ndarray:
        """(start, length, period) of all runs, ordered by start and period; ends the sequence."""
        if self.exact and self.size:
            self._name()
            self._search(0)
        self._close(*self.open, np.ones(self.open.shape[1], bool))
        start, reach, period = np.concatenate(self.closed, axis=1)
        order = np.lexsort((period, reach, start))
        start, reach, period = start[order], reach[order], period[order]
        # A stretch with several periods has the smallest one; all others are its multiples.
        own = np.ones(len(start), bool)
        own[1:] = (start[1:] != start[:-1]) | (reach[1:] != reach[:-1])
        start, length, period = start[own], (reach - start)[own], period[own]
        if not self.exact and not self._true(start, length, period):
            other = Catchers(self.longest, self.shortest, exact=True)
            other.append(self.codes[:self.size])
            return other.runs()
        order = np.lexsort((period, start))
        return np.stack([start, length, period], axis=1)[order]

    def _true(self, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bool:
        """Whether all runs repeat code by code; some at a time, so memory stays bounded."""
        codes, begin, often = self.codes[:self.size], start + period, length - period
        limits = np.searchsorted(np.cumsum(often), np.arange(0, int(often.sum()) + PORTION, PORTION), side="left")
        for low, high in zip(limits[:-1].tolist(), [*limits[1:-1].tolist(), len(start)]):
            for run in range(low, high) if high - low < 8 else ():
                at = slice(int(begin[run]), int(begin[run] + often[run]))
                if (codes[at] != codes[at.start - int(period[run]):at.stop - int(period[run])]).any():
                    return False
            if high - low >= 8:
                many = often[low:high]
                place = np.repeat(begin[low:high] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
                if (codes[place] != codes[place - np.repeat(period[low:high], many)]).any():
                    return False
        return True


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a bounded part of it at a time."""
    start = 0
    while len(text) - start > PIECE:
        end = start + PIECE
        while end < len(text) and text[end] not in SPACE:
            end += 1
        yield text[start:end].split()
        start = end
    yield text[start:].split()


def _numbers(texts: list[bytes]) -> list[np.ndarray]:
    """The words of each text as numbers, the same for equal words."""
    known: dict[bytes, int] = {}

    def number(words: list[bytes]) -> np.ndarray:
        for word in set(words).difference(known):
            known[word] = len(known)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    return [np.concatenate([number(words) for words in pieces(text)]) for text in texts]


def find_runs(sequences: list[np.ndarray], shortest: int = SHORTEST, exact: bool = False) -> list[np.ndarray]:
    """Runs (start, length, period) of each sequence of numbers from 0 on."""
    catchers = Catchers(max(map(len, sequences), default=0), shortest, exact)
    # Each sequence ends with a number of its own, so no square reaches across.
    joined = [part for place, numbers in enumerate(sequences) for part in (numbers, np.array([-1 - place]))]
    joined = np.concatenate(joined) if joined else np.zeros(0, np.int64)
    for low in range(0, len(joined), PORTION):
        catchers.append(joined[low:low + PORTION])
    found = catchers.runs()
    starts = np.cumsum([0] + [len(numbers) + 1 for numbers in sequences])
    owner = np.searchsorted(starts, found[:, 0], side="right") - 1
    found[:, 0] -= starts[owner]
    return np.split(found, np.searchsorted(owner, np.arange(1, len(sequences)))) if sequences else []


def collapsed(text: bytes, size: int, runs: np.ndarray) -> bytes:
    """The words of a text without those that any run has after its first period, joined by one space."""
    if not len(runs):
        return b" ".join([b" ".join(words) for words in pieces(text) if words])
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept, parts, at = np.cumsum(change)[:size] == 0, [], 0
    for words in pieces(text):
        parts += [word for word, keep in zip(words, kept[at:at + len(words)].tolist()) if keep]
        at += len(words)
    return b" ".join(parts)


def _slices(texts: list[bytes]) -> Iterator[list[int]]:
    """Places of texts in groups of similar length, at most SLICE bytes or one text each."""
    held, size = [], 0
    for place in sorted(range(len(texts)), key=lambda place: len(texts[place])):
        if held and size + len(texts[place]) > SLICE:
            yield held
            held, size = [], 0
        held.append(place)
        size += len(texts[place])
    if held:
        yield held


def search_texts(texts: list[bytes], shortest: int = SHORTEST) -> tuple[list[np.ndarray], list[bytes]]:
    """Runs and collapsed form of each text."""
    runs, short = [np.zeros((0, 3), np.int64)] * len(texts), [b""] * len(texts)
    for part in _slices(texts):
        numbers = _numbers([texts[place] for place in part])
        for place, own, found in zip(part, numbers, find_runs(numbers, shortest)):
            runs[place], short[place] = found, collapsed(texts[place], len(own), found)
    return runs, short


def periodic_runs(rows: DataFrame, text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """All rows with runs, an array of (start, length, period), and collapsed, a text.

    Words are what lies between spaces, tabs and line ends, numbered from 0. A run is a stretch
    with smallest period q, at least `shortest` and 2q words long, that no neighbouring word
    extends. Runs are ordered by start, then period. collapsed joins by one space the words that no
    run holds after its first q words. A null text, an empty one and one of white space have no
    runs and collapse to the empty text. Repeated rows and null ids are rows like any other; columns
    named like the results are replaced; an empty table gives an empty result. Texts are searched whole
    and on their own, so results depend neither on the batch nor on the partition; a task holds
    a batch of texts and some numbers for each word of a slice of it, or of one long text.
    """
    rows = rows.withColumn("_whole", whole(text)).drop("runs", "collapsed")
    kept = [name for name in rows.columns if name != "_whole"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, short = search_texts(batch.column("_whole").cast(pa.binary()).to_pylist(), shortest)
            flat = np.concatenate([np.zeros((0, 3), np.int64), *found])
            offsets = pa.array(np.cumsum([0] + [len(one) for one in found]), pa.int32())
            each = pa.StructArray.from_arrays([pa.array(flat[:, column]) for column in range(3)], names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in kept], pa.ListArray.from_arrays(offsets, each),
                 pa.array(short, pa.binary()).cast(pa.string())], names=[*kept, "runs", "collapsed"])

    schema = StructType([*[rows.schema[name] for name in kept], StructField("runs", RUNS), StructField("collapsed", StringType())])
    return rows.mapInArrow(search, schema)
