"""Vocabulary, token ids and labels.

A token is a run of characters other than blank, tab, carriage return and line
feed. The vocabulary is learned from the corpus; id 0 stands for any other
token.
"""

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowscribe.functions import fixed
from rowscribe.operators.columns import column, free_names, quoted, with_column
from rowscribe.operators.order import sorted_position

#: Largest vocabulary that :func:`encode` looks up inside each task.
LOOKUP_LIMIT = 200_000
#: Largest vocabulary that :func:`build_vocabulary` ranks in one task.
RANKED_TOGETHER = 10_000
#: The most frequent tokens, which :func:`encode_by_join` looks up instead of joining them.
HOT_TOKENS = 20_000
#: Longest token, in bytes, that is sent to the tasks as it is.
KEY_BYTES = 64
DEFAULT_VOCABULARY = 32_000
DEFAULT_LENGTH = 2048

_BLANK_RUN = "[ \\t\\r\\n]+"


@dataclass(frozen=True)
class Vocabulary:
    """``frame`` has columns ``id``, ``token``, ``count``, the most frequent token first.
    Ids run from 1 to at most ``size``; rows with others are not used."""

    frame: DataFrame
    size: int

    def entries(self, above: int = 0) -> DataFrame:
        """The entries with ids in the vocabulary's size, and above another id."""
        return self.frame.where((F.col("id") > above) & (F.col("id") <= self.size))


def tokens(text: Column, limit: int | None = None) -> Column:
    """The tokens of a text, or the first ``limit`` of them. The rest of a long
    text is then not split at all."""
    # Splitting leaves an empty string before leading and after trailing blanks.
    if limit is None:
        return F.array_remove(F.split(text, _BLANK_RUN), "")
    some = F.split(text, _BLANK_RUN, limit + 2)
    return F.slice(F.array_remove(some, ""), 1, limit)


def build_vocabulary(df: DataFrame, text: str, size: int = DEFAULT_VOCABULARY) -> Vocabulary:
    """The ``size`` most frequent tokens; ties go to the smaller token.

    Counts are combined before the shuffle, so frequent tokens do not gather. A
    large vocabulary is ranked by many tasks, in ranges of counts and of tokens
    with the same count, after tokens too rare to matter are left out.
    """
    counts = (
        df.select(F.explode(tokens(column(df, text))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    if size <= RANKED_TOGETHER:
        best = [F.desc("count"), F.asc("token")]
        rank = F.row_number().over(Window.orderBy(*best))
        frame = counts.orderBy(*best).limit(size).select(rank.alias("id"), "token", "count")
        return Vocabulary(frame, size)
    candidates = without_rare(counts, size).withColumn("fewer", -F.col("count"))
    ranked = sorted_position(candidates, ["fewer", "token"]).where(F.col("position") < size)
    return Vocabulary(ranked.select((F.col("position") + 1).cast("int").alias("id"), "token", "count"), size)


def written(vocabulary: Vocabulary, path: str) -> Vocabulary:
    """The vocabulary as a table in ``path``, so that what encodes with it reads
    it and does not learn it anew. It is learned and written at once."""
    vocabulary.frame.write.parquet(path)
    return Vocabulary(vocabulary.frame.sparkSession.read.parquet(path), vocabulary.size)


def without_rare(counts: DataFrame, size: int) -> DataFrame:
    """Drop tokens that cannot be among the ``size`` most frequent, exactly.

    If at least ``size`` tokens have a count of m binary digits or more, tokens
    with fewer digits can go. The table of digits has at most 64 rows.
    """
    digits = F.length(F.bin("count"))
    at_least = F.sum("n").over(Window.orderBy(F.desc("digits")))
    cut = (
        counts.groupBy(digits.alias("digits"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("at_least", at_least)
        .where(F.col("at_least") >= size)
        .agg(F.coalesce(F.max("digits"), F.lit(1)).alias("cut"))
    )
    return counts.where(digits >= cut.scalar())


def encode(
    df: DataFrame,
    text: str,
    vocabulary: Vocabulary,
    max_length: int | None = DEFAULT_LENGTH,
    out: str = "token_ids",
) -> DataFrame:
    """Add the ids of the first ``max_length`` tokens of ``text`` (None: of all).

    A vocabulary of up to ``LOOKUP_LIMIT`` tokens is sent to the tasks and
    looked up there, without any shuffle. A larger one is joined, with the same
    result. A null text has null ids.
    """
    if vocabulary.size <= LOOKUP_LIMIT:
        return encode_by_lookup(df, text, vocabulary, max_length, out)
    return encode_by_join(df, text, vocabulary, max_length, out)


def encode_by_lookup(
    df: DataFrame, text: str, vocabulary: Vocabulary, max_length: int | None, out: str = "token_ids"
) -> DataFrame:
    (split,) = free_names(df, "_tokens")
    prepared = df.withColumn(split, tokens(column(df, text), max_length))
    prepared, found = _looked_up(prepared, F.col(split), vocabulary.entries(), vocabulary.size)
    ids = F.transform(found, lambda i: F.coalesce(i, F.lit(0)))
    return with_column(prepared, out, ids).select(*[F.col(quoted(c)) for c in df.columns if c != out], F.col(quoted(out)))


def _looked_up(df: DataFrame, words: Column, entries: DataFrame, size: int) -> tuple[DataFrame, Column]:
    """A frame with a further column, and an expression on it of the ids of ``words`` in
    up to ``size`` entries, null for words that are not there."""
    # A map is searched from its start, so the vocabulary is spread over many
    # small maps and the hash of a token tells which one to search. Short keys
    # bound what is sent: `size` entries of at most 65 bytes and an id.
    slots = max(1, size // 4)

    def slot(token: Column) -> Column:
        return F.pmod(F.hash(token), F.lit(slots))

    spread = entries.groupBy(slot(F.col("token")).alias("slot")).agg(
        F.collect_list(F.struct(_short_key(F.col("token")).alias("key"), "id")).alias("entries")
    )
    none = F.array().cast("array<struct<key:string,id:int>>")
    maps = (
        df.sparkSession.range(slots)
        .select(F.col("id").cast("int").alias("slot"))
        .join(spread, "slot", "left")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("slot", F.coalesce("entries", none).alias("entries")))
            ).alias("slots")
        )
        .select(F.transform("slots", lambda s: F.map_from_entries(s["entries"])))
    )
    # Spark allows no subquery inside a lambda, so the maps are a column first.
    # The new columns are used once, which makes the optimizer merge the
    # projections: the maps are then a constant of the expression and are not
    # copied into any row. The outer transform only names them.
    (name,) = free_names(df, "_maps")
    found = F.get(
        F.transform(
            F.array(F.col(name)), lambda m: F.transform(words, lambda t: F.get(m, slot(t))[_short_key(t)])
        ),
        F.lit(0),
    )
    return df.withColumn(name, maps.scalar()), found


def _short_key(token: Column) -> Column:
    """The token, or a digest of a long one. A line feed is never in a token, so
    the two cannot be mistaken for each other."""
    digest = F.concat(F.lit("\n"), F.sha2(token, 256))
    return F.when(F.octet_length(token) > KEY_BYTES, digest).otherwise(token)


def encode_by_join(
    df: DataFrame, text: str, vocabulary: Vocabulary, max_length: int | None, out: str = "token_ids"
) -> DataFrame:
    """As :func:`encode_by_lookup`, with an equi-join on the token.

    The ``HOT_TOKENS`` most frequent entries, which are collected when this is
    called, are looked up in the tasks, so what is joined has no token with a large
    share of all. Ids depend on the text alone, so the other tokens of a text are
    joined once, under its digest, and rows find their ids by it: null or repeated
    keys make no difference. The joins carry digests, positions and ids. Their size
    is left to the optimizer to judge, so no vocabulary is broadcast unchecked, and
    adaptive execution splits the partitions of frequent texts and of frequent
    tokens without an entry.
    """
    hot = min(vocabulary.size, HOT_TOKENS)
    digest, known, entries = free_names(df, "_digest", "_known", "_entries")
    known_ids, cold_tokens, filled = _arrow_steps(vocabulary.entries().where(F.col("id") <= hot), max_length)
    name = F.unhex(F.sha2(column(df, text), 256))
    # Positions count the cold tokens of a text; they tell the order of the gaps.
    place = F.shiftleft(F.col("pos").cast("long"), 32) + F.coalesce("id", F.lit(0)).cast("long")
    ids = (
        df.select(name.alias("digest"), cold_tokens(column(df, text)).alias("cold"))
        .where(F.col("cold") != "")
        .groupBy("digest")
        .agg(F.any_value("cold").alias("cold"))
        .select("digest", F.posexplode(F.split("cold", " ")).alias("pos", "token"))
        .join(vocabulary.entries(above=hot).select("token", "id"), "token", "left")
        .groupBy("digest")
        .agg(F.sort_array(F.collect_list(place)).alias(entries))
        .withColumnRenamed("digest", digest)
    )
    joined = df.withColumn(digest, name).withColumn(known, known_ids(column(df, text))).join(ids, digest, "left")
    value = filled(F.col(known), F.col(entries))
    return with_column(joined, out, value).select(*[F.col(quoted(c)) for c in df.columns if c != out], F.col(quoted(out)))


def _arrow_steps(hot: DataFrame, limit: int | None) -> tuple[Callable[..., Column], ...]:
    """Functions of columns, on whole Arrow arrays: the ids of a text's first ``limit`` tokens, null
    for those not in ``hot``; these tokens, joined by blanks; and the ids with their gaps filled."""
    entries = hot.select(_short_key(F.col("token")).alias("key"), F.col("id").cast("int").alias("id")).toArrow().combine_chunks()
    keys, key_ids = (pa.array(entries[c].to_pylist(), t) for c, t in (("key", pa.large_string()), ("id", pa.int32())))
    sent = hot.sparkSession.sparkContext.broadcast((keys, key_ids))
    blank = np.zeros(256, bool)
    blank[[9, 10, 13, 32]] = True
    key_bytes = KEY_BYTES

    def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All tokens, and where those of each row start, and the last ones end."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if not len(texts):
            return pa.array([], pa.large_string()), np.zeros(1, np.int64)
        _, offsets, data = texts.buffers()
        rows = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data or b"", np.uint8)[rows[0] : rows[-1]]
        rows = rows - rows[0]
        inside = ~blank[raw]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        heads, tails = rows[rows < len(raw)], rows[rows > 0] - 1
        first[heads], last[tails] = inside[heads], inside[tails]
        starts = np.flatnonzero(first)
        sizes = np.flatnonzero(last) - starts + 1
        body, bounds = raw[inside], np.searchsorted(starts, rows)
        if limit is not None:
            counts = np.diff(bounds)
            kept = np.arange(len(starts)) - np.repeat(bounds[:-1], counts) < limit
            body, sizes = body[np.repeat(kept, sizes)], sizes[kept]
            bounds = np.concatenate([[0], np.cumsum(np.minimum(counts, limit))])
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        parts = [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(body))]
        return pa.Array.from_buffers(pa.large_string(), len(sizes), parts), bounds

    def looked_up(found: pa.Array) -> pa.Array:
        keys, key_ids = sent.value
        long = np.asarray(pc.greater(pc.binary_length(found), key_bytes))
        if long.any():
            digests = ["\n" + hashlib.sha256(t.encode()).hexdigest() for t in found.filter(pa.array(long)).to_pylist()]
            found = pc.replace_with_mask(found, pa.array(long), pa.array(digests, pa.large_string()))
        return key_ids.take(pc.index_in(found, value_set=keys))

    def lists(values: pa.Array, bounds: np.ndarray, rows: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values, mask=rows.is_null())

    @F.arrow_udf("array<int>")
    def known_ids(texts: pa.Array) -> pa.Array:
        found, bounds = split(texts)
        return lists(looked_up(found), bounds, texts)

    @F.arrow_udf("string")
    def cold_tokens(texts: pa.Array) -> pa.Array:
        found, bounds = split(texts)
        cold = looked_up(found).is_null()
        before = np.concatenate([[0], np.cumsum(np.asarray(cold))])
        of_row = pa.ListArray.from_arrays(pa.array(before[bounds], pa.int32()), found.filter(cold).cast(pa.string()))
        return pc.binary_join(of_row, " ")

    @F.arrow_udf("array<int>")
    def filled(known: pa.Array, entries: pa.Array) -> pa.Array:
        values = known.flatten()
        gaps = pc.bit_wise_and(entries.flatten(), pa.scalar(0xFFFFFFFF, pa.int64())).cast(pa.int32())
        counts = np.asarray(pc.list_value_length(known).fill_null(0))
        return lists(pc.replace_with_mask(values, values.is_null(), gaps), np.concatenate([[0], np.cumsum(counts)]), known)

    return known_ids, cold_tokens, filled


def prompt_masked_labels(
    token_ids: Column, prompt: Column, max_length: int | None = None
) -> Column:
    """The ids, with those of the prompt replaced by the ignored label.

    ``prompt`` is the start of the encoded text and must end at a token
    boundary, as rendered prompts do. ``max_length`` is that of the ids.
    """
    asked = F.size(tokens(prompt, max_length))
    size = F.size(token_ids)
    return F.concat(
        F.array_repeat(F.lit(fixed.IGNORED_LABEL), F.least(asked, size)),
        F.slice(token_ids, asked + 1, F.greatest(size, F.lit(1))),
    )


def encode_with_labels(
    df: DataFrame,
    vocabulary: Vocabulary,
    max_length: int | None = DEFAULT_LENGTH,
) -> DataFrame:
    """Add ``token_ids`` and ``labels`` for ``text``.

    Labels mask ``prompt_text`` where the renderer has given it; all of a text
    without a prompt is to be learned.
    """
    encoded = encode(df, "text", vocabulary, max_length)
    ids = F.col("token_ids")
    if "prompt_text" not in df.columns:
        return with_column(encoded, "labels", ids)
    labels = prompt_masked_labels(ids, column(df, "prompt_text"), max_length)
    return with_column(encoded, "labels", labels)
