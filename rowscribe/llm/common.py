"""Helpers that several operators share."""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowscribe.sources.scratch import use_checkpoints

#: Unicode's White_Space property, plainly.
WHITE_SPACE = "\t\n\x0b\x0c\r\x20\x85\xa0  -     　"
#: White space and what follows it up to the next white space.
SEGMENT = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame) -> DataFrame:
    """The columns as c0, c1, ..., so that names that clash can't be confused."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def position(df: DataFrame, name: str) -> str:
    """The name in `numbered` of the column with exactly this name, the first if several."""
    if name not in df.columns:
        raise ValueError(f"no column {name!r} among {df.columns}")
    return f"c{df.columns.index(name)}"


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Columns of exactly the given names under new names; other columns, also
    those that differ in case only, are left out."""
    frame = numbered(df)
    return frame.select(*(F.col(position(df, name)).alias(new) for new, name in columns.items()))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once for each row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, written to the shared checkpoint folder, so that what follows
    neither computes them again nor depends on the executors that made them."""
    use_checkpoints(df.sparkSession)
    return df.checkpoint()


def fold(doc_id: Column) -> Column:
    """The fold of a row: crc32 of the id as text, modulo 5; fold 0 is held out.
    A null id counts as the text of nothing."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def lowest_hashes(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows whose keys hash lowest, all if there are fewer. A threshold that is set by
    the number of rows leaves little over n of them, however many tasks there are."""
    total = df.count()
    h = F.xxhash64(key)
    share = (1.1 * n + 100) / max(total, 1)
    near = df.where(h < int(min(share, 1.0) * 2.0**63 * 2 - 2.0**63)) if share < 1 else df
    return near.orderBy(h, key).limit(n)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list]]:
    """The columns of each batch as Python lists."""
    for batch in batches:
        yield [column.to_pylist() for column in batch.columns]


class Recent(dict):
    """A table of what `make` gives for a key, bounded in memory: when full it
    becomes the older generation, from which what is still asked for is taken."""

    def __init__(self, make: Callable, size: int = 200_000) -> None:
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value

    def unknown(self, keys: Iterable) -> list:
        """Those of the keys that the table has not."""
        older = self.older
        return [key for key in keys if key not in self and key not in older]


def chunks(texts: Iterable[str | None], split: Callable[[str], list[str]], size: int) -> Iterator[list[list[str]]]:
    """What texts split into, nulls as empty ones, in lists of some `size` characters of texts."""
    lists, held = [], 0
    for text in texts:
        lists.append(split(text or ""))
        held += len(text or "")
        if held >= size:
            yield lists
            lists, held = [], 0
    if lists:
        yield lists


_HELD: list = []


def held(make: Callable, *args):
    """What make gives, held for the next tasks of a worker until one asks for another. Spark
    gives a worker the tasks of every stage, so it has the tables of one operator at a time."""
    key = (make, args)
    if not _HELD or _HELD[0] != key:
        release()
        _HELD[:] = [key, make(*args)]
    return _HELD[1]


def release() -> None:
    """Drop what is held; for tasks that need memory and no table."""
    if _HELD:
        _HELD.clear()
        gc.collect()  # tables and what fills them name each other


def mix(x: np.ndarray) -> np.ndarray:
    """A finalizer of 64-bit hashes: every input bit changes every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def task_sums(df: DataFrame, count: Callable[[Iterator], Iterator[tuple[np.ndarray, np.ndarray]]]) -> DataFrame:
    """(slot, n): sums of what `count` yields for each task as (slots, numbers).

    Each task adds up its rows in arrays of fixed size and sends its non-zero
    slots only, so the shuffle is bounded by tasks times slots.
    """

    def emit(batches):
        for slots, numbers in count(batches):
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(numbers, pa.int64())], ["slot", "n"])

    return df.mapInArrow(emit, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))


def to_array(sums: DataFrame, size: int) -> np.ndarray:
    """The sums as one array on the driver. `size` bounds it."""
    got = sums.toPandas()
    out = np.zeros(size, np.int64)
    out[got["slot"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return out
