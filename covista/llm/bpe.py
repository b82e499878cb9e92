"""Byte-level BPE as a monoid: texts are cut in halves, halves are encoded, neighbours are joined.

Two tree reductions are nested. A text is halved down to leaves of some thousand characters; a leaf
is split by the pattern and its pieces are encoded. Joining two neighbours splits a window around the
seam anew and grows it until a piece ends where a piece of the right half starts: the pattern never
looks back, so everything behind that point stands. A long piece is halved down to short byte strings
in the same manner; there a window of tokens around the seam is merged anew and grown until its outer
tokens are those that were there before. A token sequence is the encoding of its bytes exactly when
each two neighbouring tokens are, so the pairs outside the window prove that nothing else moves.

Short texts in which a piece starts at each space are taken together, up to some number of characters:
each different word is looked up once, and the new ones are merged side by side in arrays.

Empty and null texts have no tokens. Work within a text is of order n log n; memory is that of the texts
taken together, or of one longer text, beside the bounded tables of known words and pieces.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAF_CHARS = 32768
LEAF_BYTES = 24
LONG_BYTES = 96
LEAF_WORD = 48
LEAF_TOKENS = 4096
# words of a generation, and pieces, remembered by a worker
REMEMBERED = 100_000
# characters of texts that are encoded together
AHEAD_CHARS = 1 << 20
# pieces merged side by side
ROWS = 2048
# a space before white space, with which it makes one piece (every character of the pattern's \s and a few more)
SEAM = re.compile(r" \s")


def pack(ids) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def unpack(ids: bytes) -> list[int]:
    return np.frombuffer(ids, dtype="<u4").tolist()


class Merges:
    """Short byte strings merged side by side: one row a string, and in each round the best pair of every row."""

    NONE = np.iinfo(np.int32).max

    def __init__(self, ranks: dict[bytes, int]):
        self.end = max(ranks.values(), default=0) + 1  # stands behind a string
        single = [ranks.get(bytes([i]), self.end) for i in range(256)]
        self.single = np.array(single, dtype=np.int64)
        pairs = [(a, b, rank) for token, rank in ranks.items() for i in range(1, len(token))
                 if (a := ranks.get(token[:i])) is not None and (b := ranks.get(token[i:])) is not None]
        left, right, rank = np.array(pairs, dtype=np.int64).reshape(-1, 3).T
        # pairs of tokens in an open hash table
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.found = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, self.NONE, dtype=np.int32)
        key = self.key(left, right)
        slot, rest = self.slot(key), np.arange(len(key))
        while len(rest):
            free = rest[self.keys[slot[rest]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            self.keys[slot[placed]], self.found[slot[placed]] = key[placed], rank[placed]
            rest = np.setdiff1d(rest, placed, assume_unique=True)
            slot[rest] = slot[rest] + 1 & self.mask

    def key(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left * (self.end + 1) + right

    def slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens, NONE for a pair that is no token."""
        key = self.key(left, right)
        slot = self.slot(key)
        there = self.keys[slot]
        rest = np.nonzero((there != key) & (there >= 0))[0]
        while len(rest):
            slot[rest] = slot[rest] + 1 & self.mask
            there = self.keys[slot[rest]]
            rest = rest[(there != key[rest]) & (there >= 0)]
        return self.found[slot]

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Packed tokens of each word; no word is empty."""
        sizes = np.array([len(w) for w in words])
        n, width = len(words), int(sizes.max(initial=0))
        place = np.arange(width + 1)
        data = np.frombuffer(b"".join([w.ljust(width + 1, b"\0") for w in words]), dtype=np.uint8).reshape(n, width + 1)
        ids = np.where(place < sizes[:, None], self.single[data], self.end)
        rank = np.full((n, width + 1), self.NONE, dtype=np.int32)
        rank[:, :-1] = self.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width)
        ids, flat, start = ids.ravel(), rank.ravel(), np.arange(n) * (width + 1)
        after = np.arange(1, len(ids) + 1)
        before = after - 2
        before[start] = -1
        rows = np.arange(n)
        while len(rows):
            at = start[rows] + rank[rows].argmin(1)  # the leftmost of equals
            more = flat[at] < self.NONE
            rows, at = rows[more], at[more]
            best, gone = flat[at].astype(np.int64), after[at]
            later = after[gone]
            ids[at], ids[gone], flat[gone] = best, self.end, self.NONE
            after[at], before[later] = later, at
            flat[at] = self.rank(best, ids[later])
            inner = np.nonzero(before[at] >= 0)[0]
            earlier = before[at[inner]]
            flat[earlier] = self.rank(ids[earlier], best[inner])
        ids = ids.reshape(n, width + 1)
        live = ids < self.end
        tokens, ends = pack(ids[live]), (4 * live.sum(1).cumsum()).tolist()
        return [tokens[a:b] for a, b in zip([0, *ends], ends)]


class Encoder:
    """The monoid of encoded texts for one table of ranks and one pattern.

    ``spaced``: the pattern starts a piece at each space before a character that is no white space, and a space
    with letters is one piece. Words between spaces can then be encoded, and remembered, one by one.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, spaced: bool = True):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.spaced = spaced
        self.packed = {token: rank.to_bytes(4, "little") for token, rank in ranks.items()}
        self.merges = Merges(ranks)
        self.spelling = pa.array(map(self.bytes_of.get, range(self.merges.end)), pa.large_binary())
        self.pieces: dict[str, bytes] = {}  # packed tokens
        self.words: dict[str, bytes] = {}  # of a word with a space before it
        self.older: dict[str, bytes] = {}  # words of the generation before

    # texts

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Packed tokens of each text."""
        some, chars = [], 0
        for text in texts:
            some.append(text)
            chars += len(text)
            if chars >= AHEAD_CHARS:
                yield from self._encode_some(some)
                some, chars = [], 0
        yield from self._encode_some(some)

    def _encode_some(self, texts: list[str]) -> Iterator[bytes]:
        alike = [len(t) <= LEAF_CHARS and self.spaces_part(t) for t in texts]
        made = self.side_by_side([t for t, same in zip(texts, alike) if same])
        return (next(made) if same else self.encode(t) for t, same in zip(texts, alike))

    def side_by_side(self, texts: list[str]) -> Iterator[bytes]:
        """Packed tokens of short texts in which a piece starts at each space: each different word is looked up once."""
        parts = pc.split_pattern(pa.array(texts, pa.string()), " ")
        firsts = parts.offsets.to_numpy()
        later = np.ones(firsts[-1], dtype=bool)
        later[firsts[:-1]] = False  # no space before it
        words = parts.flatten().filter(pa.array(later)).dictionary_encode()
        ids = pa.array(self.known(words.dictionary.to_pylist()), pa.large_binary()).take(words.indices)
        # what the words of a text have lies together
        _, at, tokens = ids.buffers()
        starts = firsts - np.arange(len(firsts))
        at = np.frombuffer(at, dtype=np.int64) if len(ids) else np.zeros(1, dtype=np.int64)
        for text, a, b in zip(texts, starts, starts[1:]):
            yield self.split(text.split(" ", 1)[0]) + (tokens[at[a]:at[b]].to_pybytes() if b > a else b"")

    def known(self, words: list[str]) -> list[bytes]:
        """Tokens of different words with a space before them, each word with at least a character."""
        made = list(map(self.words.get, words))
        new = [i for i, ids in enumerate(made) if ids is None]
        plain, mixed = [], []
        for i in new:
            word = words[i]
            if (ids := self.older.get(word)) is not None:
                made[i] = ids
            elif len(word) > LEAF_WORD:
                made[i] = self.split(f" {word}")
            else:
                (plain if word.isalpha() else mixed).append(i)
        cut = self.find(f" {' '.join([words[i] for i in mixed])}") if mixed else []  # a word starts at each space
        tokens = self.tokens([*dict.fromkeys(cut)])
        starts = [k for k, p in enumerate(cut) if p[0] == " "]
        for i, a, b in zip(mixed, starts, [*starts[1:], len(cut)]):
            made[i] = b"".join([tokens[p] for p in cut[a:b]])
        for i, ids in zip(plain, self.tokens([f" {words[i]}" for i in plain]).values()):
            made[i] = ids
        if len(self.words) >= REMEMBERED:
            self.words, self.older = {}, self.words
        self.words.update([(words[i], made[i]) for i in new if len(words[i]) <= LEAF_WORD])
        return made

    def tokens(self, pieces: list[str]) -> dict[str, bytes]:
        """Packed tokens of different pieces, in their order."""
        coded = [p.encode() for p in pieces]
        made = list(map(self.packed.get, coded))
        new = np.array([i for i, ids in enumerate(made) if ids is None], dtype=np.int64)
        sizes = np.array([len(coded[i]) for i in new.tolist()], dtype=np.int64)
        for i in new[sizes > LEAF_BYTES].tolist():
            made[i] = self.whole(coded[i])
        order = np.argsort(sizes, kind="stable")  # like sizes together
        short = new[order][sizes[order] <= LEAF_BYTES].tolist()
        for at in range(0, len(short), ROWS):
            some = short[at:at + ROWS]
            for i, ids in zip(some, self.merges.encode([coded[i] for i in some])):
                made[i] = ids
        return dict(zip(pieces, made))

    def remember(self, word: str, ids: bytes) -> None:
        """Of two generations of words the older goes when the younger is full, so that frequent words stay known."""
        if len(self.words) >= REMEMBERED:
            self.words, self.older = {}, self.words
        self.words[word] = ids

    def encode(self, text: str) -> bytes:
        """Packed tokens of a text."""
        return b"".join(self.leaf(text) if len(text) <= LEAF_CHARS else self.tree(text)[1])

    def tree(self, text: str) -> tuple[list[str], list[bytes]]:
        """A text cut at ends of pieces, and the tokens of each part."""
        if len(text) > LEAF_CHARS:
            middle = len(text) // 2
            return self.join(self.tree(text[:middle]), self.tree(text[middle:]))
        if parts := self.apart(text):
            parts = parts[:1] + [f" {p}" for p in parts[1:]]
        else:
            parts = self.find(text)
        return parts, self.leaf(text)

    def apart(self, text: str) -> list[str] | None:
        """What lies between the spaces of a text, if a piece starts at each of them."""
        return text.split(" ") if self.spaces_part(text) else None

    def spaces_part(self, text: str) -> bool:
        return self.spaced and text != "" and text[0] != " " != text[-1] and not SEAM.search(text)

    def leaf(self, text: str) -> list[bytes]:
        """Tokens of the parts that ``tree`` cuts a short text into."""
        if not (parts := self.apart(text)):
            return [self.piece(p) for p in self.find(text)]
        words = self.words
        try:
            return [self.split(parts[0]), *map(words.__getitem__, parts[1:])]
        except KeyError:
            return [self.split(parts[0]), *[words.get(p) or self.word(p) for p in parts[1:]]]

    def word(self, word: str) -> bytes:
        """Tokens of a word and the space before it."""
        if (ids := self.older.get(word)) is None:
            if word.isalpha() and len(word) < LEAF_BYTES:
                ids = self.whole(f" {word}".encode())
            else:
                ids = self.split(f" {word}")
        if len(word) <= LEAF_WORD:
            self.remember(word, ids)
        return ids

    def split(self, text: str) -> bytes:
        return b"".join([self.piece(p) for p in self.find(text)])

    def join(self, left, right):
        """The product of two encoded texts.

        A part of the left half stands if it ends two characters before the seam: a match is
        decided by its own characters and at most two more. The window starts at the first other.
        """
        (parts, ids), (later, later_ids) = left, right
        back = tail = 0
        while back < len(parts) and tail < 2:
            back += 1
            tail += len(parts[-back])
        cut = len(parts) - back
        seam = "".join(parts[cut:])
        size = 4
        while True:
            starts, at = {len(seam): 0}, len(seam)
            for k, p in enumerate(later[:size], 1):
                at += len(p)
                starts[at] = k
            whole = size >= len(later)
            made = self.find(seam + "".join(later[:size]))
            end = 0
            for n, p in enumerate(made, 1):
                end += len(p)
                if end in starts and (whole or end <= at - 2):
                    made, rest = made[:n], starts[end]
                    break
            else:
                size *= 4
                continue
            if len(made) == back == rest == 1 and end > LEAF_WORD:  # one piece across the seam
                new = [self.product(ids[-1], later_ids[0])]
            else:
                new = [self.piece(p) for p in made]
            return parts[:cut] + made + later[rest:], ids[:cut] + new + later_ids[rest:]

    # pieces

    def piece(self, piece: str) -> bytes:
        """Packed tokens of a piece: one token if the whole is one, else the folded tree."""
        if (ids := self.pieces.get(piece)) is not None:
            return ids
        ids = self.whole(piece.encode())
        if len(piece) <= LEAF_WORD:
            if len(self.pieces) >= REMEMBERED:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def whole(self, data: bytes) -> bytes:
        if (ids := self.packed.get(data)) is not None:
            return ids
        if len(data) <= LEAF_BYTES:
            return b"".join([self.packed[p] for p in self.merged(data)])
        return pack(self.fold(data))

    def fold(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        middle = len(data) // 2
        return self.seam(self.fold(data[:middle]), self.fold(data[middle:]))

    def product(self, left: bytes, right: bytes) -> bytes:
        return pack(self.seam(unpack(left), unpack(right)))

    def seam(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of two byte strings put together, from the tokens of each."""
        size = 2
        while True:
            head, a = (left[:-size], left[-size:]) if size < len(left) else ([], left)
            b, tail = right[:size], right[size:]
            window = self.merge(self.decode(a + b))
            if (not head or window[0] == a[0]) and (not tail or window[-1] == b[-1]):
                return head + window + tail
            size *= 2

    def merge(self, data: bytes) -> list[int]:
        """Tokens of a string without halving it."""
        if len(data) > LONG_BYTES:
            return self.merge_long(data)
        return [self.ranks[p] for p in self.merged(data)]

    def merged(self, data: bytes) -> list[bytes]:
        """Merge the neighbours of lowest rank, leftmost first, until none has a rank."""
        rank, none = self.ranks.get, len(self.ranks)
        parts = [data[i:i + 1] for i in range(len(data))]
        pairs = [rank(data[i:i + 2], none) for i in range(len(data) - 1)]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            at = pairs.index(best)
            part = parts[at] = parts[at] + parts.pop(at + 1)
            del pairs[at]
            if at < len(pairs):
                pairs[at] = rank(part + parts[at + 1], none)
            if at:
                pairs[at - 1] = rank(parts[at - 1] + part, none)
        return parts

    def merge_long(self, data: bytes) -> list[int]:
        """The same for long strings, with a heap over a linked list."""
        ranks, n = self.ranks, len(data)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # a part is data[i:end[i]]
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        live = bytearray(b"\1") * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not live[i] or j >= n or not live[j] or end[j] != stop:
                continue
            end[i], live[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(data[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (h := before[i]) >= 0 and (r := ranks.get(data[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i:end[i]]])
            i = end[i]
        return out

    def spelled(self, ids: bytes) -> bytes:
        """Bytes of packed tokens."""
        parts = self.spelling.take(pa.array(np.frombuffer(ids, dtype="<u4")))
        if parts.null_count:
            raise KeyError("no such token")
        _, at, data = parts.buffers()
        at = np.frombuffer(at, dtype=np.int64)
        return data[at[0]:at[len(parts)]].to_pybytes()

    def decode(self, ids) -> bytes:
        """Bytes of a token sequence: halves are decoded and concatenated."""
        if len(ids) <= LEAF_TOKENS:
            return b"".join([self.bytes_of[i] for i in ids])
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return Encoder(ranks, pattern)


def encoded(text: Column, path: str, pattern: str) -> Column:
    """Token ids of a text, packed as little-endian unsigned 32-bit integers. ``path``: a rank file
    present on every machine (a line per token: base64, rank)."""

    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        tool = encoder(path, pattern)
        return pa.array(tool.encode_all(t.as_py() or "" for t in texts), pa.binary())

    return run(text)


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """Bytes of packed token ids; null ids give none."""

    @F.arrow_udf("binary")
    def run(packed: pa.Array) -> pa.Array:
        tool = encoder(path, pattern)
        return pa.array((tool.spelled(p.as_py() or b"") for p in packed), pa.binary())

    return run(ids)


def unpacked(ids: Column) -> Column:
    """Packed ids as an array of longs."""

    @F.arrow_udf("array<bigint>")
    def run(packed: pa.Array) -> pa.Array:
        return pa.array((unpack(p.as_py() or b"") for p in packed), pa.list_(pa.int64()))

    return run(ids)


def tokenized(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids",
              back: str = "decoded") -> DataFrame:
    """``df`` with two binary columns: packed token ids and the bytes they decode to.

    A null text counts as empty. Columns already named so are replaced; rows, repeated ones
    included, stay as they are. Nothing is shuffled.
    """
    return (df.withColumn(ids, encoded(F.col(text), path, pattern))
            .withColumn(back, decoded(F.col(ids), path, pattern)))
