"""BPE encoding and decoding: longest matches are proposed, adjacent pairs verified."""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from txnlake.llm.common import whole
from txnlake.llm.pretokens import LONG, REMEMBERED, WORDS, Splitter, byte_letters

NEVER = np.iinfo(np.int64).max
END = "\0"
#: Letters are bytes; the last one of a word counts as another letter.
LAST, LETTERS = 256, 512


def _cut(flat: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Runs of tokens as int32 bytes."""
    octets, ends = flat.astype(np.int32).tobytes(), (4 * np.cumsum(counts)).tolist()
    return [octets[start:end] for start, end in zip([0, *ends], ends)]


class Codec:
    """A word-end BPE vocabulary with its merges.

    A word is encoded by greedy longest match first. Two adjacent tokens are compatible if no
    merge across their border comes before the merges that build them; if all adjacent pairs are
    compatible, and every token encodes itself, the proposal is what merging gives. Other words
    are merged step by step, many at a time.
    """

    def __init__(self, path: str):
        self.splitter = Splitter(path, WORDS, lower=True)
        model = self.splitter.settings["model"]
        suffix = model["end_of_word_suffix"]
        if model["type"] != "BPE" or not suffix or model["ignore_merges"] or model["continuing_subword_prefix"]:
            raise ValueError("not a BPE vocabulary with word ends")
        self.names = {number: token for token, number in model["vocab"].items()}
        self.names |= {number: token for token, number in self.splitter.added.items()}
        spelled = lambda token: token.removesuffix(suffix) + END if token.endswith(suffix) else token
        self.vocab = {spelled(token): number for token, number in model["vocab"].items()}
        self.codes = {letter: code for code, letter in enumerate(byte_letters())}
        self.size = max(self.names) + 1
        self.spelled = [self.names.get(number) for number in range(self.size)]
        parts = [merge if isinstance(merge, list) else merge.split(" ") for merge in model["merges"]]
        left = np.array([model["vocab"][a] for a, _ in parts], np.int64)
        right = np.array([model["vocab"][b] for _, b in parts], np.int64)
        made = np.array([model["vocab"][a.removesuffix(suffix) + b if a.endswith(suffix) else a + b] for a, b in parts], np.int64)
        self.merges = {(a, b): (rank, c) for rank, (a, b, c) in enumerate(zip(left.tolist(), right.tolist(), made.tolist()))}
        self._index(left, right, made)
        self._grow()
        self.known: dict[str, bytes] = {}

    def _index(self, left: np.ndarray, right: np.ndarray, made: np.ndarray) -> None:
        """Spines of all tokens, and which tokens encode themselves."""
        ranks = np.arange(len(left))
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], ranks[order], made[order]
        parent_left, parent_right = np.full(self.size, -1), np.full(self.size, -1)
        birth = np.full(self.size, -1)
        parent_left[made], parent_right[made], birth[made] = left, right, ranks
        self.right_spine, self.right_end = self._spine(parent_right, birth)
        self.left_spine, self.left_end = self._spine(parent_left, birth)
        # A token must be built by one merge of parts that were there before it.
        own = np.zeros(self.size, bool)
        own[[number for spelling, number in self.vocab.items() if len(spelling.removesuffix(END)) == 1]] = True
        sound = (birth[left] < ranks) & (birth[right] < ranks) & (birth[made] == ranks)
        sound &= ~self._crossing(left, right, inside=True)
        for a, b, c, good in zip(left.tolist(), right.tolist(), made.tolist(), sound.tolist()):
            own[c] = good and own[a] and own[b]
        self.own = own

    def _spine(self, child: np.ndarray, birth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts of each token along one edge, and the rank of the merge that uses each part up."""
        nodes, ends = [np.arange(self.size)], [np.full(self.size, NEVER)]
        while True:
            last = nodes[-1]
            following = np.where(last >= 0, child[last], -1)
            if (following < 0).all():
                return np.stack(nodes), np.stack(ends)
            ends.append(np.where(following >= 0, birth[last], -1))
            nodes.append(following)

    def _crossing(self, left: np.ndarray, right: np.ndarray, inside: bool = False) -> np.ndarray:
        """Whether some merge crosses the border between two tokens.

        A part x at the end of the left token and a part y at the start of the right one merge if
        that merge comes before the one that uses up x, and not after the one that uses up y
        (of equal merges the one further left is first). inside leaves out the tokens themselves.
        """
        crossed = np.zeros(len(left), bool)
        for i in range(len(self.right_spine)):
            x = self.right_spine[i][left]
            for j in range(len(self.left_spine)):
                if inside and not i and not j:
                    continue
                y = self.left_spine[j][right]
                at = np.nonzero((x >= 0) & (y >= 0) & ~crossed)[0]
                if not len(at):
                    continue
                key = x[at] * self.size + y[at]
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                rank = np.where(self.keys[place] == key, self.ranks[place], NEVER)
                crossed[at] = (rank < self.right_end[i][left[at]]) & (rank <= self.left_end[j][right[at]]) & (rank < NEVER)
        return crossed

    def _grow(self) -> None:
        """The trie of all tokens over letters; the last letter of a word is its byte plus LAST."""
        step: dict[int, int] = {}
        token = [-1] * (1 + LETTERS)
        for spelling, number in self.vocab.items():
            letters = [self.codes[letter] for letter in spelling.removesuffix(END)]
            letters[-1] += LAST if spelling.endswith(END) else 0
            node = 1 + letters[0]
            for letter in letters[1:]:
                following = step.setdefault(node * LETTERS + letter, len(token))
                if following == len(token):
                    token.append(-1)
                node = following
            token[node] = number
        self.token = np.array(token)
        self.steps = np.array(sorted(step), np.int64)
        self.nodes = np.array([step[key] for key in self.steps.tolist()], np.int64)

    def _proposals(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and tokens of greedy longest matches; a match never passes the last letter of a word.

        The longest match is found for all places at once, then one walk follows the matches.
        """
        padded = np.append(letters, 0)
        node = 1 + letters
        best, reach = self.token[node], np.ones(len(letters), np.int64)
        at, depth = np.arange(len(letters)), 1
        while len(at):
            key = node * LETTERS + padded[at + depth]
            place = np.minimum(np.searchsorted(self.steps, key), len(self.steps) - 1)
            going = self.steps[place] == key
            at, node, depth = at[going], self.nodes[place[going]], depth + 1
            token = self.token[node]
            complete = token >= 0
            best[at[complete]], reach[at[complete]] = token[complete], depth
        starts, place, steps = [], 0, reach.tolist()
        while place < len(steps):
            starts.append(place)
            place += steps[place]
        starts = np.array(starts, np.int64)
        if (best[starts] < 0).any():
            raise ValueError("a letter is missing from the vocabulary")
        return starts, best[starts]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the merge of each pair of tokens, or NEVER, and what it makes."""
        key = left * self.size + right
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[place] == key, self.ranks[place], NEVER), self.made[place]

    def _merged(self, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merging of many words step by step: always the lowest rank, of equal ones the leftmost.

        Words lie in rows of one width with a border cell on each side, and each round does the next
        merge of all rows that have one. Returns all tokens in order and their number per word.
        """
        rows, width = len(sizes), int(sizes.max()) + 2
        cells = np.full(rows * width, -1, np.int64)
        first = np.arange(rows) * width + 1
        inside = np.repeat(first, sizes) + np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        cells[inside] = tokens
        after, before = np.arange(rows * width) + 1, np.arange(rows * width) - 1
        ranks, makes = np.full(rows * width, NEVER), np.full(rows * width, -1, np.int64)
        self._offer(inside, cells, after, ranks, makes)
        open_rows = np.arange(rows)
        by_row = ranks.reshape(rows, width)
        while len(open_rows):
            at = open_rows * width + by_row[open_rows].argmin(axis=1)
            going = ranks[at] < NEVER
            open_rows, at = open_rows[going], at[going]
            gone = after[at]
            cells[at], cells[gone], ranks[gone] = makes[at], -1, NEVER
            after[at] = after[gone]
            before[after[at]] = at
            self._offer(at, cells, after, ranks, makes)
            left = before[at]
            self._offer(left[cells[left] >= 0], cells, after, ranks, makes)
        kept = cells >= 0
        return cells[kept], kept.reshape(rows, width).sum(axis=1)

    def _offer(self, at: np.ndarray, cells: np.ndarray, after: np.ndarray, ranks: np.ndarray, makes: np.ndarray) -> None:
        """Look up the merges of the tokens at some places with those after them."""
        right = cells[after[at]]
        found, made = self._rank(cells[at], right)
        ranks[at], makes[at] = np.where(right >= 0, found, NEVER), made

    def _merged_long(self, tokens: list[int]) -> list[int]:
        """The same for long words, with the pairs in a heap."""
        after, before = [*range(1, len(tokens)), -1], [*range(-1, len(tokens) - 1)]
        heap = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] >= 0 and (found := self.merges.get((tokens[at], tokens[after[at]]))):
                heapq.heappush(heap, (found[0], at, tokens[at], tokens[after[at]], found[1]))

        for place in range(len(tokens)):
            offer(place)
        while heap:
            _, at, a, b, made = heapq.heappop(heap)
            if tokens[at] != a or after[at] < 0 or tokens[after[at]] != b:
                continue
            gone = after[at]
            tokens[at], tokens[gone], after[at] = made, -1, after[gone]
            if after[at] >= 0:
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [token for token in tokens if token >= 0]

    def _learn(self, fresh: dict[str, bytes]) -> dict[str, bytes]:
        """Codes of words as int32 bytes: one check for the pairs of all proposals, merging for failing words."""
        words = list(fresh)
        sizes = np.fromiter(map(len, fresh.values()), np.int64, len(words))
        letters = np.frombuffer(b"".join(fresh.values()), np.uint8).astype(np.int64)
        ends = np.cumsum(sizes)
        letters[ends - 1] += LAST
        starts, flat = self._proposals(letters)
        owner = np.searchsorted(ends, starts, side="right")
        failing = np.zeros(len(words), bool)
        failing[owner[~self.own[flat]]] = True
        inner = np.nonzero(owner[1:] == owner[:-1])[0]
        pairs, which = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        crossed = self._crossing(pairs // self.size, pairs % self.size)
        failing[owner[inner[crossed[which]]]] = True
        codes = _cut(flat, np.bincount(owner, minlength=len(words)))
        # Rows of similar length share a matrix, so padding at most doubles it.
        width = np.where(sizes <= LONG, np.maximum(4, 2 ** np.ceil(np.log2(sizes)).astype(np.int64)), 0)
        base = self.token[1 + letters]
        for one in np.unique(width[failing]).tolist():
            chosen = np.nonzero(failing & (width == one))[0]
            if one:
                many = sizes[chosen]
                inside = np.repeat(ends[chosen] - many - (np.cumsum(many) - many), many) + np.arange(many.sum())
                merged = _cut(*self._merged(base[inside], many))
            else:
                merged = [np.array(self._merged_long(base[ends[word] - sizes[word]:ends[word]].tolist()), np.int32).tobytes()
                          for word in chosen]
            for word, ids in zip(chosen.tolist(), merged):
                codes[word] = ids
        return dict(zip(words, codes))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as the tokenizer gives them without adding special tokens."""
        split: list[list[list[str] | bytes]] = []
        fresh: dict[str, bytes] = {}
        if len(self.known) > REMEMBERED:
            self.known = {}
        for text in texts:
            parts: list = []
            for place, piece in enumerate(self.splitter.pieces(text)):
                if place % 2:
                    parts.append(np.int32(self.splitter.added[piece]).tobytes())
                    continue
                words = self.splitter.words(piece)
                if words is None:
                    words = [word + END for word in self.splitter.asked(piece)]
                    fresh.update((word, bytes(map(self.codes.__getitem__, word[:-1]))) for word in words if word not in self.known)
                else:
                    fresh.update((word, word.encode()) for word in set(words).difference(self.known))
                parts.append(words)
            split.append(parts)
        known, long = self.known, {}
        for word, ids in (self._learn(fresh) if fresh else {}).items():
            (known if len(word) <= LONG else long)[word] = ids
        result = []
        for parts in split:
            octets = []
            for part in parts:
                if isinstance(part, bytes):
                    octets.append(part)
                elif long and not long.keys().isdisjoint(part):
                    octets += [long[word] if word in long else known[word] for word in part]
                else:
                    octets += map(known.__getitem__, part)
            result.append(np.frombuffer(b"".join(octets), np.int32))
        return result

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by one space, as this vocabulary has no decoder; unknown ids are skipped."""
        known = ids[(ids >= 0) & (ids < self.size)]
        return " ".join([name for name in map(self.spelled.__getitem__, known.tolist()) if name is not None])


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec for each vocabulary in a worker."""
    return Codec(path)


#: Characters of texts that are encoded at a time, so that memory does not follow the batch.
SLICE = 1 << 20


def _slices(sizes: list[int]) -> list[tuple[int, int]]:
    result, start, held = [], 0, 0
    for place, size in enumerate(sizes):
        held += size
        if held >= SLICE:
            result.append((start, place + 1))
            start, held = place + 1, 0
    return [*result, (start, len(sizes))] if start < len(sizes) else result


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0] + [len(row) for row in rows])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *rows]), pa.int32()))


def encoded(text: Column, path: str) -> Column:
    """Ids of whole texts as array<int>; a null text is the empty text and has none."""
    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        own, values = codec(path), texts.to_pylist()
        return _lists([row for start, end in _slices([len(value) for value in values]) for row in own.encode(values[start:end])])

    return run(whole(text))


def decoded(ids: Column, path: str) -> Column:
    """Texts of arrays of ids; a null array gives the empty text."""
    @F.arrow_udf("string")
    def run(rows: pa.Array) -> pa.Array:
        own = codec(path)
        none = np.zeros(0, np.int32)
        return pa.array([own.decode(row.values.drop_null().to_numpy() if row.is_valid else none) for row in rows], pa.string())

    return run(ids)


def round_trip(text: Column, path: str) -> Column:
    """struct(ids, decoded): `encoded` and `decoded` of whole texts in one call, so each text is encoded once."""
    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def run(texts: pa.Array) -> pa.Array:
        own, values, ids = codec(path), texts.to_pylist(), []
        for start, end in _slices([len(value) for value in values]):
            ids += own.encode(values[start:end])
        return pa.StructArray.from_arrays([_lists(ids), pa.array([own.decode(row) for row in ids], pa.string())], names=["ids", "decoded"])

    return run(whole(text))
