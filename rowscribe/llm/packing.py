"""Harmonic packing of token sequences.

A length belongs to the class of the k-th part of a sequence, capacity // k,
and k pieces of a class fill a sequence, so classes fill theirs independently
of each other and of other workers. As documents may be cut, a document gives
pieces of exactly the lengths of classes, the longest that fits first, and a
sequence is padded by the remainder of capacity / k only; classes with more
than SLACK of it are not used. What is left of each class, fewer than k
pieces, is a bounded number of pieces; they are combined into sequences, the
longest first.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowscribe.llm.bpe import byte_alphabet
from rowscribe.llm.common import WHITE_SPACE, Recent, checkpointed, held, pick, rows_of

#: The id after each document, and the tokens of a sequence.
END_ID, CAPACITY = 2, 4096
#: Tokens of padding that a full sequence of a class may have.
SLACK = 4


def classes(capacity: int = CAPACITY, slack: int = SLACK) -> list[int]:
    """The piece lengths, ascending: the parts of a sequence that fill it up to the slack."""
    sizes = {capacity // k for k in range(1, capacity + 1)}
    return sorted(s for s in sizes if capacity % s <= slack)


def pieces(length: int, sizes: list[int]) -> list[int]:
    """Class lengths, the longest that fits first, that add up to a length."""
    out = [sizes[-1]] * (length // sizes[-1])
    rest = length % sizes[-1]
    while rest:
        out.append(sizes[bisect.bisect_right(sizes, rest) - 1])
        rest -= out[-1]
    return out


class Encoder:
    """Ids of a text as little-endian bytes. The vocabulary drops white space and
    never joins across it, so each word between is encoded once and kept."""

    #: A word of small letters and the ASCII signs that may end it need no normalizing; they are two
    #: pieces. These letters are composed and have one small form.
    plain = re.compile(r"([a-zß-öø-ÿ]+)([!-/:-@\[-`{-~]*)").fullmatch
    #: What Python splits at and the vocabulary does not.
    separators = "\x1c\x1d\x1e\x1f"
    word = re.compile(f"[^{WHITE_SPACE}]+").findall

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.alphabet = self.tokenizer.model, byte_alphabet()
        self.pieces = Recent(self._piece, 100_000)
        self.words = Recent(self._word, 200_000)

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = "".join(map(self.alphabet.__getitem__, piece.encode()))
        return self._bytes([token.id for token in self.model.tokenize(piece)])

    def _word(self, word: str) -> bytes:
        found = self.plain(word.lower())
        if found:
            return self.pieces[found[1]] + (self.pieces[found[2]] if found[2] else b"")
        return self._bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        words = self.word(text) if any(s in text for s in self.separators) else text.split()
        return b"".join(map(self.words.__getitem__, words))


def encoder(vocabulary: str) -> Encoder:
    return held(Encoder, vocabulary)


def cut(df: DataFrame, vocabulary: str, doc_id: str, text: str, capacity: int) -> DataFrame:
    """The pieces of every document, numbered within class and task."""

    def run(batches):
        code, sizes = encoder(vocabulary), classes(capacity)
        seen = dict.fromkeys(sizes, 0)
        end = END_ID.to_bytes(4, "little")
        for keys, texts in rows_of(batches):
            out: list[tuple] = []
            for key, one in zip(keys, texts):
                ids = (code.encode(one) if one else b"") + end
                start = 0
                for size in pieces(len(ids) // 4, sizes):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + size)])
                    out.append((key, start, size, crc, len(ids) // 4, seen[size]))
                    seen[size] += 1
                    start += size
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "nth"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names) if out else pa.RecordBatch.from_pydict(
                {n: pa.array([], pa.int64()) for n in names}
            )

    texts = pick(df, doc_id=doc_id, text=text).selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    names = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, nth long"
    return texts.mapInArrow(run, names).withColumn("task", F.spark_partition_id())


def combine(capacity: int):
    """Sequences out of pieces of any class lengths: each goes to the fullest
    sequence that has room. The last ones, not full, are cut down to powers of
    two, which need no padding, as far as their pieces allow."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], ignore_index=True)
        room: dict[int, list[int]] = {}
        free: list[int] = []  # room of the open sequences, ascending
        members: list[list[int]] = []
        for i, size in enumerate(rows["length"]):
            at = bisect.bisect_left(free, size)
            if at == len(free):
                members.append([])
                bin_, left = len(members) - 1, capacity
            else:
                left = free.pop(at)
                bin_ = room[left].pop()
            members[bin_].append(i)
            if left > size:
                bisect.insort(free, left - size)
                room.setdefault(left - size, []).append(bin_)
        done: list[list[int]] = []
        for bin_ in members:
            sizes = rows["length"].to_numpy()
            while bin_:
                total = int(sizes[bin_].sum())
                goal, chosen, rest = 1 << (total.bit_length() - 1), [], []
                if total < capacity - SLACK and total != goal:
                    for i in bin_:  # the longest first
                        if sizes[i] <= goal:
                            chosen.append(i)
                            goal -= int(sizes[i])
                        else:
                            rest.append(i)
                if goal or not rest:
                    chosen, rest = bin_, []
                done.append(chosen)
                bin_ = rest
        rows["sequence"], rows["offset"] = 0, 0
        sequence, offset = rows["sequence"].to_numpy(copy=True), rows["offset"].to_numpy(copy=True)
        for n, bin_ in enumerate(done):
            at = 0
            for i in bin_:
                sequence[i], offset[i] = n, at
                at += int(rows["length"].iat[i])
        rows["sequence"], rows["offset"] = sequence, offset
        return rows.drop(columns=["only"])

    return run


def pack(df: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece.

    A null or empty text is a document of the end id alone. Rows with equal or
    null ids are packed as documents of their own. Other columns are left out.
    An empty table gives no pieces.

    Texts are encoded once. Pieces, without their ids, are written; their
    numbers in a class are the counts of the tasks before and the number in the
    task, so no class is gathered anywhere.
    """
    # Read from what was written, so that a task's numbers stay those of its rows.
    cut_up = checkpointed(cut(df, vocabulary, doc_id, text, capacity))
    by_class = Window.partitionBy("length").orderBy("task")
    counts = (
        cut_up.groupBy("task", "length")
        .agg(F.count("*").alias("n"))
        .select(
            "task",
            "length",
            (F.sum("n").over(by_class) - F.col("n")).alias("before"),
            F.sum("n").over(Window.partitionBy("length")).alias("in_class"),
        )
    )
    per = F.floor(F.lit(capacity) / F.col("length")).cast("long")
    placed = cut_up.join(counts, ["task", "length"]).withColumn("at", F.col("before") + F.col("nth")).withColumn("per", per)
    whole = F.col("at") < F.col("in_class") - F.col("in_class") % F.col("per")
    # A class has fewer than `capacity` sequences' worth of parts: its length and number make an id.
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    full = placed.where(whole).select(
        *columns,
        (F.floor(F.col("at") / F.col("per")) * (capacity + 1) + F.col("length")).cast("long").alias("sequence_id"),
        ((F.col("at") % F.col("per")) * F.col("length")).cast("long").alias("offset"),
    )
    # Fewer than `per` pieces of each class: a number that depends on the capacity alone.
    names = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence long, offset long"
    left = placed.where(~whole).select(*columns, F.lit(0).alias("only")).groupBy("only").applyInPandas(combine(capacity), names)
    return full.unionByName(left.select(*columns, (F.col("sequence") * (capacity + 1)).alias("sequence_id"), "offset"))
