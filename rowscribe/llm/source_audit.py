"""How the sources of a language differ in their words, by products of one-hot levels.

The words of a language that enough of its documents have are its terms. A
source gives a term a price, a smoothed share that depends on the source and on
the number of times it has the term: the level. Two sources differ by the sum
over all terms of the difference of their prices.

The table of terms and sources becomes a matrix with a row for each term and a
column for each (source, level) that is 1 where the source has the term so many
times; also the level 0 has its column. That matrix's transpose times itself
counts for every two columns the terms that have both: the joint tables of
levels of all pairs of sources. A joint table is priced once for all terms
that share its levels.

The product is made in blocks. Rows are dealt out by a hash of the term, columns
by tiles of sources, so a task holds some thousand rows of two tiles at most. A
block is ordered by how frequent its terms are, so that terms with the same
levels are together, and multiplied in parts of a limited number of columns.
Entries are 0 and 1 and sums below 2^24, so products of floats are exact; prices
are whole numbers throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowscribe.llm.common import pick
from rowscribe.sources.scratch import scratch_path

#: A term is in at least so many documents of its language.
DOCUMENTS = 30
#: Prices are shares of this, rounded down, plus 1; counts are smoothed by SMOOTHING.
SCALE, SMOOTHING = 1_000_000_000, 5
#: Terms of each source that are listed.
LISTED = 50
#: Rows of a block, about, sources of a tile, and columns that are multiplied at once.
BLOCK, TILE, COLUMNS = 4096, 128, 1536
#: Bytes of text that a task counts at once, and rows that it sends at once.
PIECE, SENT = 32 << 20, 20_000

#: Bytes as they count: A-Z as a-z, those of letters and beyond ASCII as they are, others as blanks.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def lowered(texts: pa.Array) -> pa.Array:
    """The texts with their bytes as they count, words between blanks."""
    ends = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    own = data.slice(ends[0], ends[-1] - ends[0]).to_pybytes() if data else b""
    return pa.Array.from_buffers(texts.type, len(texts), [None, pa.py_buffer(ends - ends[0]), pa.py_buffer(own.translate(LETTERS))])


def pieces(batches: Iterator[pa.RecordBatch], size: int = PIECE) -> Iterator[pa.Table]:
    """The rows in pieces of about so many bytes of text; a longer text makes its piece longer."""
    held, total = [], 0
    for batch in batches:
        reached = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False), dtype=np.int64)
        bounds = [0, *(np.flatnonzero(np.diff(reached // size)) + 1).tolist(), len(batch)]
        for start, stop in zip(bounds, bounds[1:]):
            if stop == start:
                continue
            own = int(reached[stop - 1] - (reached[start - 1] if start else 0))
            if held and total + own > size:
                yield pa.Table.from_batches(held).combine_chunks()
                held, total = [], 0
            held.append(batch.slice(start, stop - start))
            total += own
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def piece_counts(piece: pa.Table) -> pa.RecordBatch:
    """(lang, term, docs, n, counts) of the rows (lang, source, text) of a piece: of every term of
    a language the documents, the occurrences, and those in each source that has it."""
    langs, sources, texts = (piece[c].combine_chunks() for c in ("lang", "source", "text"))
    langs, sources = langs.dictionary_encode(), sources.dictionary_encode()
    lang, source = langs.indices.to_numpy(), sources.indices.to_numpy()
    order = np.lexsort((source, lang))
    at = np.empty(len(order), np.int64)
    at[order] = np.arange(len(order))
    words = pc.ascii_split_whitespace(lowered(texts))
    coded = words.flatten().dictionary_encode()
    # Documents of a source are together, so a sort by term and document groups at every level.
    key = coded.indices.to_numpy().astype(np.int64) * len(order) + np.repeat(at, np.diff(words.offsets.to_numpy()))
    key.sort()
    start = np.flatnonzero(np.diff(key, prepend=-1))
    n = np.diff(start, append=len(key))
    term, doc = np.divmod(key[start], len(order))
    # Blanks at the ends of a text leave an empty word.
    real = term != pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    n, term, doc = n[real], term[real], order[doc[real]]
    of_lang, of_source = lang[doc], source[doc]
    new = (np.diff(term, prepend=-1) != 0) | (np.diff(of_lang, prepend=-1) != 0)
    rows, cells = np.flatnonzero(new), np.flatnonzero(new | (np.diff(of_source, prepend=-1) != 0))
    summed = lambda starts: pa.array(np.add.reduceat(n, starts) if len(starts) else starts, pa.int64())
    named = lambda values, codes: values.dictionary.cast(pa.string()).take(pa.array(codes))
    counts = pa.StructArray.from_arrays([named(sources, of_source[cells]), summed(cells)], ["source", "n"])
    of_row = pa.array(np.append(np.searchsorted(cells, rows), len(cells)), pa.int32())
    docs = pa.array(np.diff(rows, append=len(n)), pa.int64())
    columns = [named(langs, of_lang[rows]), named(coded, term[rows]), docs, summed(rows), pa.ListArray.from_arrays(of_row, counts)]
    return pa.RecordBatch.from_arrays(columns, ["lang", "term", "docs", "n", "counts"])


def term_counts(df: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, term, docs, n, counts): of each term that a piece of the table has, the documents with
    it, its occurrences, and those in each source. A frequent term sends one row a piece, whatever
    the sources."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            counted = piece_counts(piece)
            for start in range(0, len(counted), SENT):
                yield counted.slice(start, SENT)

    rows = groups(df, lang=lang, source=source, text=text)
    return rows.mapInArrow(count, "lang string, term string, docs long, n long, counts array<struct<source: string, n: long>>")


def groups(df: DataFrame, **columns: str) -> DataFrame:
    """The columns as text, nulls as empty."""
    rows = pick(df, **columns)
    return rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns))


def price(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTHING) / (total + SMOOTHING * terms)), in whole numbers of any size."""
    share = lambda kind, scale: F.call_function("div", (n.cast("long") + SMOOTHING).cast(kind) * F.lit(SCALE).cast(scale), (total + SMOOTHING * terms).cast(kind))
    # Decimals where the product may be too large for a long.
    return (1 + F.when(n < 2**63 // SCALE - SMOOTHING, share("long", "long")).otherwise(share("decimal(20,0)", "decimal(10,0)"))).cast("long")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared scratch folder as a table, whose size Spark knows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many rows have both columns, for every column of two one-hot matrices."""
    return np.rint(left.T @ right).astype(np.int64)


def one_hot(n: np.ndarray, prices: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a table of counts by row and source and their prices: the indicators of every level of
    every source, the source of each column, and its price. Columns of a source are together."""
    sources = np.arange(n.shape[1])
    key = sources * (int(n.max(initial=0)) + 1) + n
    columns, first, at = np.unique(key, return_index=True, return_inverse=True)
    matrix = np.zeros((len(n), len(columns)), np.float32)
    matrix[np.arange(len(n))[:, None], at.reshape(n.shape)] = 1
    return matrix, first % n.shape[1], prices.reshape(-1)[first]


def parts(n: np.ndarray, columns: int = COLUMNS) -> Iterator[slice]:
    """Slices of rows in each of which about so many levels are new."""
    key = np.arange(n.shape[1]) * (int(n.max(initial=0)) + 1) + n
    first = np.unique(key, return_index=True)[1] // max(1, n.shape[1])
    new = np.cumsum(np.bincount(first, minlength=len(n)))
    bounds = [0, *(np.flatnonzero(np.diff(new // columns)) + 1).tolist(), len(n)]
    for start, stop in zip(bounds, bounds[1:]):
        if stop > start:
            yield slice(start, stop)


def differences(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Sums over all rows of the differences of prices, for each source of the left and of the
    right table, which are given as counts and prices."""
    out = np.zeros((left[0].shape[1], right[0].shape[1]), np.int64)
    order = np.argsort(left[0].sum(axis=1) + right[0].sum(axis=1), kind="stable")
    same = left is right
    left = tuple(a[order] for a in left)
    right = left if same else tuple(a[order] for a in right)
    for rows in parts(left[0] if same else np.concatenate([left[0], right[0]], axis=1)):
        x, of_x, price_x = one_hot(left[0][rows], left[1][rows])
        y, of_y, price_y = (x, of_x, price_x) if same else one_hot(right[0][rows], right[1][rows])
        ends_x, ends_y = np.flatnonzero(np.diff(of_x, prepend=-1)), np.flatnonzero(np.diff(of_y, prepend=-1))
        # Wide tables in strips, so that the joint tables of a strip alone are held.
        for a, b in strips(ends_x, len(of_x)):
            joint = product(x[:, a:b], y)
            joint *= np.abs(price_x[a:b, None] - price_y[None, :])
            summed = np.add.reduceat(joint, ends_y, axis=1)
            starts = ends_x[(ends_x >= a) & (ends_x < b)] - a
            out[of_x[a + starts]] += np.add.reduceat(summed, starts, axis=0)
    return out


def strips(starts: np.ndarray, n: int, columns: int = COLUMNS) -> Iterator[tuple[int, int]]:
    """Ranges of whole sources with about so many columns each."""
    low = 0
    bounds = [*starts.tolist()[1:], n]
    for i, stop in enumerate(bounds):
        if stop - low >= columns or stop == n:
            yield low, stop
            low = stop


def table_of(row: np.ndarray, at: np.ndarray, n: np.ndarray, prices: np.ndarray, rows: int, nothing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The counts and prices of a tile by row and source; `nothing` are the sources' prices of 0."""
    counts = np.zeros((rows, len(nothing)), np.int64)
    priced = np.broadcast_to(nothing, counts.shape).copy()
    counts[row, at], priced[row, at] = n, prices
    return counts, priced


def block_differences(frame: pd.DataFrame) -> pd.DataFrame:
    """The sums of a block: (lang, a, b, value, seen) for the sources a of its left tile and b of its right one."""
    lang, i, j = frame["lang"].iat[0], int(frame["left"].iat[0]), int(frame["right"].iat[0])
    sides = {}
    # Rows without a term say which sources a tile has; those count as -1.
    numbers, rows = pd.factorize(frame["term"])
    real = numbers >= 0
    for tile in {i, j}:
        own = (frame["tile"] == tile).to_numpy()
        known = frame[own & ~real].sort_values("at")
        ids, nothing = known["at"].to_numpy(np.int64), known["price"].to_numpy(np.int64)
        held = frame[own & real]
        at = np.searchsorted(ids, held["at"].to_numpy(np.int64))
        values = held["n"].to_numpy(np.int64), held["price"].to_numpy(np.int64)
        sides[tile] = ids, table_of(numbers[own & real], at, *values, len(rows), nothing)
    value = differences(sides[i][1], sides[j][1])
    a, b = np.repeat(sides[i][0], len(sides[j][0])), np.tile(sides[j][0], len(sides[i][0]))
    out = pd.DataFrame({"lang": lang, "a": a, "b": b, "value": value.reshape(-1), "seen": len(rows)})
    return out[out["a"] < out["b"]]


def audit(
    df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", documents: int = DOCUMENTS, listed: int = LISTED,
    block: int = BLOCK, tile: int = TILE,
) -> DataFrame:
    """(lang, source, part, item, value, rank) of every source of every language.

    Part `pair` has the other sources of the language as items, and as values the sum over
    all terms of the difference of prices; part `term` the `listed` terms that the source has
    and prices most above the language. Ranks descend by value, items of equal ones ascend.

    Nulls count as empty texts, and an empty language or source is one like others. A source
    without terms has the price of 0 for each; a language without terms gives pairs of value 0
    and no terms. Each row is a document, also a repeated one. Other columns are left out. An
    empty table gives no rows.
    """
    # What a term has in all pieces meets once; from there on, also on disk, there are kept terms only.
    of_term = Window.partitionBy("term", "lang")
    kept = (
        term_counts(df, text, lang, source)
        .withColumns({"docs": F.sum("docs").over(of_term), "lang_n": F.sum("n").over(of_term)})
        .where(F.col("docs") >= documents)
        .select("lang", "term", "lang_n", F.inline("counts"))
        .groupBy("lang", "source", "term", "lang_n")
        .agg(F.sum("n").alias("n"))
    )
    kept = stored(kept, "terms")

    totals = kept.groupBy("lang").agg(F.countDistinct("term").alias("terms"), F.sum("n").alias("lang_total"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    numbered_ = Window.partitionBy("lang").orderBy("source")
    sources = (
        groups(df, lang=lang, source=source)
        .distinct()
        .join(totals, "lang", "left")
        .join(own, ["lang", "source"], "left")
        .na.fill(0, ["terms", "lang_total", "total"])
        .withColumn("at", F.row_number().over(numbered_) - 1)
        .withColumn("tiles", F.ceil(F.count("*").over(Window.partitionBy("lang")) / tile).cast("long"))
        .withColumn("tile", F.floor(F.col("at") / tile).cast("long"))
        .withColumn("blocks", F.ceil((F.col("terms") + 1) / block).cast("long"))
        # The price of a term that the source has not.
        .withColumn("nothing", F.when(F.col("terms") > 0, price(F.lit(0), F.col("total"), F.col("terms"))))
    )
    sources = stored(sources, "sources")
    entries = (
        kept.join(sources, ["lang", "source"])
        .withColumn("price", price(F.col("n"), F.col("total"), F.col("terms")))
        .withColumn("above", F.col("price") - price(F.col("lang_n"), F.col("lang_total"), F.col("terms")))
        .select("lang", "source", "term", "n", "price", "above", "at", "tile", "tiles", "blocks")
    )

    # Each tile meets each other one, and itself, in every block of rows.
    meets = lambda other: (F.least("tile", other).alias("left"), F.greatest("tile", other).alias("right"))
    columns = ["lang", "block", "tile", "at", "term", "n", "price"]
    cells = entries.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    marks = (
        sources.where(F.col("terms") > 0)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumns({"term": F.lit(None).cast("string"), "n": F.lit(0).cast("long"), "price": F.col("nothing")})
    )
    both = cells.select(*columns, *meets(F.col("other"))).unionByName(marks.select(*columns, *meets(F.col("other"))))
    met = both.groupBy("lang", "block", "left", "right").applyInPandas(block_differences, "lang string, a long, b long, value long, seen long")
    summed = met.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))

    of = lambda name: sources.select("lang", F.col("at").alias(name), F.col("source").alias(f"source_{name}"), F.col("nothing").alias(f"nothing_{name}"), "terms")
    pairs = (
        of("a")
        .join(of("b").drop("terms"), "lang")
        .where(F.col("a") < F.col("b"))
        .join(summed, ["lang", "a", "b"], "left")
        .na.fill(0, ["value", "seen"])
        # Terms that no source of the two tiles has cost the difference of the prices of 0.
        .withColumn("rest", (F.col("terms") - F.col("seen")) * F.abs(F.col("nothing_a") - F.col("nothing_b")))
        .withColumn("value", F.col("value") + F.coalesce("rest", F.lit(0).cast("long")))
    )
    sides = F.array(*(F.struct(F.col(f"source_{x}").alias("source"), F.col(f"source_{y}").alias("item")) for x, y in ("ab", "ba")))
    pair_rows = pairs.select("lang", F.explode(sides).alias("side"), "value").select("lang", "side.source", F.lit("pair").alias("part"), "side.item", "value")
    term_rows = entries.where(F.col("above") > 0).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.col("above").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(best))
    return ranked(pair_rows).unionByName(ranked(term_rows).where(F.col("rank") <= listed))
