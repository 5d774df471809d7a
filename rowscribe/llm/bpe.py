"""Byte-level BPE: a segment tree over the ranks of adjacent pairs.

Each leaf holds (rank, position) of the pair that starts there, or nothing; an
inner node holds the smaller of its children, so the root names the leftmost
pair of the lowest rank. A merge changes three leaves and the nodes above
them, in logarithmic time, until the root is empty.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from rowscribe.llm.common import SEGMENT, Recent, chunks, held, pick, rows_of

#: Fixed value: the pattern that splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NONE = 1 << 62
_PLACE = (1 << 32) - 1
#: Bits of a symbol, bytes of words that are merged together, and characters of texts whose words are.
_SYMBOL, _LONG, _CHUNK = 24, 64, 1 << 20


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if it prints, else the next free one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    signs = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [signs[b] for b in range(256)]


#: The ids of a piece joined by commas, the bytes they decode to, and the ids.
Piece = tuple[bytes, bytes, tuple[int, ...]]


class Pairs:
    """The ranks of mergeable pairs and, by rank, the symbol that each makes."""

    def __init__(self, merges: list[tuple[int, int, int]]) -> None:
        self.ranks = {left << _SYMBOL | right: rank for rank, (left, right, _) in enumerate(merges)}
        self.made = [made for _, _, made in merges]
        keys = np.array(list(self.ranks), np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.sorted_ranks = np.append(np.array(list(self.ranks.values()), np.int64)[order], 0)
        self.made_of = np.array(self.made, np.int64)

    def leaves(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The keys of pairs that start at the places; a negative symbol is in no pair."""
        key = left << _SYMBOL | right
        at = np.searchsorted(self.keys, key)
        found = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.sorted_ranks[at] << 32 | place, _NONE)


def put(tree: list[int], i: int, key: int) -> None:
    """Change a leaf, and the nodes above it as far as their least key changes."""
    tree[i] = key
    while i > 1:
        other = tree[i ^ 1]
        if other < key:
            key = other
        i >>= 1
        if tree[i] == key:
            return
        tree[i] = key


def merge(symbols: list[int], pairs: Pairs) -> list[int]:
    """Merge adjacent symbols, the lowest rank first and the leftmost of equals,
    until none can be merged."""
    n = len(symbols)
    if n < 2:
        return symbols
    rank_of, made = pairs.ranks.get, pairs.made
    leaves = 1 << (n - 1).bit_length()
    tree = [_NONE] * (2 * leaves)
    for i in range(n - 1):
        rank = rank_of(symbols[i] << _SYMBOL | symbols[i + 1])
        if rank is not None:
            tree[leaves + i] = rank << 32 | i
    for i in range(leaves - 1, 0, -1):
        left, right = tree[2 * i], tree[2 * i + 1]
        tree[i] = left if left < right else right
    # A symbol that was merged into the one before it is -1; places link to their neighbours.
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (least := tree[1]) < _NONE:
        i = least & _PLACE
        j = after[i]
        symbol = symbols[i] = made[least >> 32]
        symbols[j] = -1
        following, previous = after[j], before[i]
        after[i] = following
        put(tree, leaves + j, _NONE)
        key = _NONE
        if following < n:
            before[following] = i
            rank = rank_of(symbol << _SYMBOL | symbols[following])
            if rank is not None:
                key = rank << 32 | i
        put(tree, leaves + i, key)
        if previous >= 0:
            rank = rank_of(symbols[previous] << _SYMBOL | symbol)
            put(tree, leaves + previous, _NONE if rank is None else rank << 32 | previous)
    return [s for s in symbols if s >= 0]


def merge_many(words: list[list[int]], pairs: Pairs) -> list[tuple[int, ...]]:
    """As `merge` for each of many short words: their trees are rows of one array, and each
    step merges one pair in every word that has one."""
    out: list = [None] * len(words)
    of_size: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        if 1 < len(word) <= _LONG:
            of_size.setdefault(1 << (len(word) - 1).bit_length(), []).append(i)
        else:
            out[i] = tuple(merge(word, pairs))
    for size, members in of_size.items():
        symbols = np.full((len(members), size + 1), -1, np.int64)
        places = np.arange(size)
        used = places < np.array([len(words[i]) for i in members])[:, None]
        symbols[:, :size][used] = np.fromiter(chain.from_iterable(words[i] for i in members), np.int64)
        tree = np.full((len(members), 2 * size), _NONE, np.int64)
        tree[:, size:] = pairs.leaves(symbols[:, :-1], symbols[:, 1:], places)
        for i in range(size - 1, 0, -1):
            tree[:, i] = np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1])
        after = np.tile(places + 1, (len(members), 1))
        before = np.tile(np.arange(-1, size), (len(members), 1))

        def put(rows: np.ndarray, at: np.ndarray, keys: np.ndarray, size: int = size, tree: np.ndarray = tree) -> None:
            node = at + size
            tree[rows, node] = keys
            while (node := node >> 1)[0]:
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        rows = np.arange(len(members))
        while True:
            rows = rows[tree[rows, 1] < _NONE]
            if not len(rows):
                break
            least = tree[rows, 1]
            i, symbol = least & _PLACE, pairs.made_of[least >> 32]
            j = after[rows, i]
            following, previous = after[rows, j], before[rows, i]
            symbols[rows, i], symbols[rows, j] = symbol, -1
            after[rows, i], before[rows, following] = following, i
            put(rows, j, np.full(len(rows), _NONE))
            put(rows, i, pairs.leaves(symbol, symbols[rows, following], i))
            inner = previous >= 0
            if inner.any():
                some, previous = rows[inner], previous[inner]
                put(some, previous, pairs.leaves(symbols[some, previous], symbol[inner], previous))
        left = symbols >= 0
        ends = np.cumsum(left.sum(axis=1)).tolist()
        flat, start = symbols[left].tolist(), 0
        for i, end in zip(members, ends):
            out[i] = tuple(flat[start:end])
            start = end
    return out


class Codec:
    """Encodes and decodes with a vocabulary file of byte-level BPE."""

    def __init__(self, vocabulary: str) -> None:
        with open(vocabulary, encoding="utf-8") as file:
            spec = json.load(file)
        ids, alphabet = spec["model"]["vocab"], byte_alphabet()
        self.byte_ids = [ids[sign] for sign in alphabet]
        self.pairs = Pairs([(ids[a], ids[b], ids[a + b]) for a, b in spec["model"]["merges"]])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte_of = {sign: b for b, sign in enumerate(alphabet)}
        self.raw = {i: bytes(byte_of[c] for c in token) for token, i in ids.items() if token not in self.special}
        self.raw |= {i: token.encode() for token, i in self.special.items()}
        self.names = {i: b"%d" % i for i in self.raw}
        self.find = regex.compile(PATTERN).findall
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split
        self.pieces = Recent(self._piece)
        self.segments = Recent(self._segment)
        self.digested = Recent(self._digested)

    def _piece(self, piece: str) -> Piece:
        return self._described(tuple(merge([self.byte_ids[b] for b in piece.encode()], self.pairs)))

    def _segment(self, segment: str) -> tuple[int, ...]:
        if segment in self.special:
            return (self.special[segment],)
        return tuple(i for piece in self.found(segment) for i in self.pieces[piece][2])

    def _digested(self, segment: str) -> tuple[bytes, bytes]:
        if segment in self.special:
            return self._described((self.special[segment],))[:2]
        return self._joined(self.found(segment))

    def found(self, segment: str) -> list[str]:
        """The pieces of a segment; a blank and ASCII letters are one."""
        return [segment] if segment[0] == " " and segment.isascii() and segment[1:].isalpha() else self.find(segment)

    def _joined(self, pieces: list[str]) -> tuple[bytes, bytes]:
        if len(pieces) == 1:
            return self.pieces[pieces[0]][:2]
        names, raws, _ = zip(*map(self.pieces.__getitem__, pieces))
        return b",".join(names), b"".join(raws)

    def _described(self, ids: tuple[int, ...]) -> Piece:
        return b",".join(map(self.names.__getitem__, ids)), b"".join(map(self.raw.__getitem__, ids)), ids

    def parts(self, text: str) -> list[str]:
        """The special tokens and the segments between them. No segment holds a special token."""
        # White space starts a piece of the pattern and never continues one, so
        # segments that start with a whole run of it are encoded independently.
        if any(s in text for s in self.special):
            return [x for part in self.split(text) for x in ([part] if part in self.special else SEGMENT.findall(part))]
        return SEGMENT.findall(text)

    def prepare(self, lists: list[list[str]], known: Recent) -> dict[str, list[str]]:
        """Merge the pieces of all segments that are not known yet together; the pieces of these segments."""
        pieces_of = {s: self.found(s) for s in known.unknown(set().union(*lists)) if s not in self.special}
        new = self.pieces.unknown(set(chain.from_iterable(pieces_of.values())))
        byte_id = self.byte_ids.__getitem__
        for piece, ids in zip(new, merge_many([list(map(byte_id, p.encode())) for p in new], self.pairs)):
            self.pieces.keep(piece, self._described(ids))
        return pieces_of

    def encode(self, text: str) -> list[int]:
        return [i for ids in map(self.segments.__getitem__, self.parts(text)) for i in ids]

    def encoded(self, texts: list[str | None]) -> Iterator[list[int]]:
        """The ids of each text, nulls as empty ones."""
        for lists in chunks(texts, self.parts, _CHUNK):
            self.prepare(lists, self.segments)
            for parts in lists:
                yield [i for ids in map(self.segments.__getitem__, parts) for i in ids]

    def digests(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """For each text the number of its ids, and the digests of the ids joined by commas and of what
        they decode to."""
        for lists in chunks(texts, self.parts, _CHUNK):
            for segment, pieces in self.prepare(lists, self.digested).items():
                self.digested.keep(segment, self._joined(pieces))
            for parts in lists:
                names, raws = zip(*map(self.digested.__getitem__, parts)) if parts else ((), ())
                ids, decoded = b",".join(names), b"".join(raws).decode("utf-8", "replace").encode()
                yield ids.count(b",") + 1 if ids else 0, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.raw.get(i, b"") for i in ids]).decode("utf-8", "replace")


def codec(vocabulary: str) -> Codec:
    """The codec that a worker process holds for a file."""
    return held(Codec, vocabulary)


def encode(df: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every whole text.

    A null text counts as empty, an empty one has no ids. Rows are not
    compared, so repeated and null ids stay as they are; other columns are left
    out. A word of n bytes without a break takes n log n steps.
    """

    def run(batches):
        code = codec(vocabulary)
        for keys, texts in rows_of(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(code.encoded(texts), pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    return pick(df, doc_id=doc_id, text=text).selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(df: DataFrame, vocabulary: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, text) of every list of ids; null ids count as an empty list. Bytes
    that aren't UTF-8 become the replacement character, and ids that the vocabulary
    has not, null ones too, decode to nothing."""

    def run(batches):
        code = codec(vocabulary)
        for keys, lists in rows_of(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([code.decode(i or []) for i in lists], pa.string())], ["doc_id", "text"]
            )

    return pick(df, doc_id=doc_id, ids=ids).selectExpr("cast(doc_id as long) doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(df: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded and its
    ids decoded again in the same task, of which only the digests are kept."""

    def run(batches):
        code = codec(vocabulary)
        for keys, texts in rows_of(batches):
            counts, digests, decoded = zip(*code.digests(texts)) if texts else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return (
        pick(df, doc_id=doc_id, text=text)
        .selectExpr("cast(doc_id as long) doc_id", "text")
        .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    )
