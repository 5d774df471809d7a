"""Tokens of each section of a text, by the offsets of the tokens of the whole.

A text is encoded once as a whole. The spans of its tokens are joined with
those of its sections by position, and a token that crosses a boundary goes
where the rule says:

    first     the section with its first character
    last      the section with its last character
    majority  the section with most of its characters, the earlier of equals
    split     every section that it touches, by its share of characters

A token of a part of a character's bytes spans the whole character.
"""

from __future__ import annotations

import base64
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from rowscribe.llm.common import pick, rows_of

RULES = ("first", "last", "majority", "split")
#: From so many white characters on end, the encoder's own splitter may run out of stack.
LONG_BLANK = 100_000
_BLANK = regex.compile(r"\s{%d}" % LONG_BLANK)


@cache
def encoder(vocabulary: str, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder of a rank file and the number of bytes of each token."""
    with open(vocabulary, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, i in ranks.items():
        sizes[i] = len(token)
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes


def token_ids(text: str, vocabulary: str, pattern: str) -> np.ndarray:
    """The ids of a text. One with very long white space is split here and encoded piece by piece."""
    code, _ = encoder(vocabulary, pattern)
    if len(text) >= LONG_BLANK and _BLANK.search(text):
        pieces = regex.findall(pattern, text)
        return np.array([i for piece in pieces for i in code._encode_single_piece(piece)], np.int64)
    return code.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype(np.int64)


def spans(text: str, vocabulary: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last character of every token of a text."""
    _, sizes = encoder(vocabulary, pattern)
    raw = np.frombuffer(text.encode(), np.uint8)
    ends = np.cumsum(sizes[token_ids(text, vocabulary, pattern)])
    starts = np.concatenate([[0], ends[:-1]])[: len(ends)].astype(np.int64)
    if len(raw) == len(text):
        return starts, ends
    of_byte = np.cumsum((raw & 0xC0) != 0x80) - 1
    return of_byte[starts], of_byte[ends - 1] + 1


def lines(text: str) -> np.ndarray:
    """Where each line starts, and the end; a line holds its line feed."""
    if text.isascii():
        breaks = np.flatnonzero(np.frombuffer(text.encode(), np.uint8) == 10) + 1
    else:
        breaks = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 10) + 1
    return np.unique(np.concatenate([[0], breaks, [len(text)]]))


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and crossing tokens of each section [bounds[i], bounds[i + 1])."""
    n = len(bounds) - 1
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, ends - 1, "right") - 1
    across = np.flatnonzero(first != last)
    counts = np.bincount(first[first == last], minlength=n).astype(np.float64)
    crossing = np.zeros(n, np.int64)
    for t in across:
        over = np.arange(first[t], last[t] + 1)
        share = np.minimum(bounds[over + 1], ends[t]) - np.maximum(bounds[over], starts[t])
        crossing[over] += 1
        if rule == "split":
            counts[over] += share / share.sum()
        else:
            counts[{"first": over[0], "last": over[-1], "majority": over[np.argmax(share)]}[rule]] += 1
    return counts, crossing


def token_counts(
    df: DataFrame, vocabulary: str, pattern: str, rule: str = "majority", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, section, start, end, n_tokens, n_crossing) of every line of every text.

    start and end are characters, section counts from 0. A null or empty text
    has no sections and so no rows. The counts of a text's sections add up to
    its tokens under every rule. Rows are not compared, so repeated rows give
    repeated results; other columns are left out.
    """
    if rule not in RULES:
        raise ValueError(f"rule {rule!r} is none of {RULES}")

    def run(batches):
        for keys, texts in rows_of(batches):
            parts: list[tuple] = []
            for key, one in zip(keys, texts):
                if one:
                    bounds = lines(one)
                    counts, crossing = attribute(*spans(one, vocabulary, pattern), bounds, rule)
                    parts.append((key, bounds[:-1], bounds[1:], counts, crossing))
            if not parts:
                continue
            owners = pa.array([p[0] for p in parts], pa.int64()).take(
                pa.array(np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts]))
            )
            sections = np.concatenate([np.arange(len(p[1])) for p in parts])
            columns = [owners, pa.array(sections)] + [pa.array(np.concatenate([p[i] for p in parts])) for i in (1, 2, 3, 4)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"])

    return (
        pick(df, doc_id=doc_id, text=text)
        .selectExpr("cast(doc_id as long) doc_id", "text")
        .mapInArrow(run, "doc_id long, section long, start long, end long, n_tokens double, n_crossing long")
    )
