"""Order, sampling and batching.

A table has no row order, so order is always that of key columns that identify
a row. Nothing here sorts or numbers a whole table in one task: positions are
the sum of a partition's offset, from counts, and a rank inside the partition.
"""

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowscribe.operators.columns import free_names, quoted, reject_taken

# Rows are counted per prefix of their digest, so what is numbered in one task
# and broadcast has at most 16**4 = 65,536 rows (16**5 for very many shards),
# however large the table is.
_DIGITS = 4
_MORE_DIGITS = 5
_MANY_SHARDS = 4096


def shuffle_digest(seed: int, keys: Sequence[str]) -> Column:
    """The value that rows are shuffled by: a function of seed and key only, so
    it does not depend on partitioning or on retried tasks."""
    return F.md5(
        F.concat_ws(":", F.lit(str(seed)), *[F.col(quoted(key)).cast("string") for key in keys])
    )


def shuffled_position(
    df: DataFrame, seed: int, keys: Sequence[str], *, shards: int | None = None
) -> DataFrame:
    """Add ``position``, from 0, in the order of a seeded shuffle.

    The table is shuffled once, into ``shards`` ranges of the order with about
    equal row counts, each sorted. Writing the result therefore gives files
    that hold consecutive positions. Counting reads the key columns alone.
    """
    shards, digits = _layout(df, shards)
    prefixes = _prefix_counts(df, seed, keys, digits)
    return _place(df, prefixes, seed, keys, digits, shards)


def shuffle_take(
    df: DataFrame, n: int, seed: int, keys: Sequence[str], *, shards: int | None = None
) -> DataFrame:
    """The first ``n`` rows of a seeded shuffle, with their ``position``.

    Rows past the prefix with the n-th row are dropped before anything is
    shuffled. Of that prefix the rows are counted again by twice the digits, so
    only ``n`` rows and a 16**8-th part of the table move.
    """
    shards, digits = _layout(df, shards)
    prefixes = _prefix_counts(df, seed, keys, digits).where(F.col("_before") < n)
    edge = prefixes.agg(F.max(F.struct("_prefix", "_before")).alias("edge"))
    digest = shuffle_digest(seed, keys)
    at_edge = df.where(
        F.substring(digest, 1, digits) == edge.select(F.col("edge._prefix")).scalar()
    )
    before_edge = edge.select(F.col("edge._before")).scalar()
    last = (
        _prefix_counts(at_edge, seed, keys, 2 * digits)
        .where(F.col("_before") + before_edge < n)
        .agg(F.max("_prefix"))
    )
    kept = df.where(F.substring(digest, 1, 2 * digits) <= last.scalar())
    return _place(kept, prefixes, seed, keys, digits, shards).where(F.col("position") < n)


def assign_batches(
    df: DataFrame,
    batch_size: int,
    accumulation: int,
    seed: int,
    keys: Sequence[str],
    *,
    shards: int | None = None,
) -> DataFrame:
    """Add ``position``, ``micro_batch`` and ``step`` (optimizer step), from 0,
    for one pass over the rows in seeded order."""
    reject_taken(df, "position", "micro_batch", "step")
    return shuffled_position(df, seed, keys, shards=shards).withColumns(
        {
            "micro_batch": F.expr(f"position div {batch_size}"),
            "step": F.expr(f"position div {batch_size * accumulation}"),
        }
    )


def epoch_batches(
    positioned: DataFrame, batch_size: int, accumulation: int, epochs: int, seed: int
) -> DataFrame:
    """Batches of several passes: each row of :func:`shuffled_position` once for each
    ``epoch``, from 0, with its ``place`` in the epoch's own order, and with
    ``micro_batch`` and ``step`` counted on from one epoch to the next.

    The first epoch keeps the positions. Each other one permutes them by itself, with
    keys of its seed, so no epoch sorts or shuffles the rows again: the result is as
    large as its columns times the epochs, and laid out as ``positioned`` is.
    """
    reject_taken(positioned, "epoch", "place", "micro_batch", "step")
    rounds, n = free_names(positioned, "_rounds", "_n")
    total = positioned.agg(F.count(F.lit(1))).scalar()
    keys = F.array(
        *[
            F.struct(F.lit(e).cast("long").alias("epoch"), F.array(*map(F.lit, _round_keys(seed, e))).cast("array<bigint>").alias("keys"))
            for e in range(epochs)
        ]
    )
    rows = positioned.withColumn(n, total).withColumn(rounds, F.explode(keys))
    epoch, place = F.col(rounds)["epoch"], _permuted(F.col("position"), F.col(n), F.col(rounds)["keys"])
    micro_batches = F.ceil(F.col(n) / batch_size).cast("long")
    steps = F.ceil(micro_batches / accumulation).cast("long")
    rows = rows.withColumn("place", place).withColumn("epoch", epoch)
    return rows.withColumns(
        {
            "micro_batch": F.col("epoch") * micro_batches + F.expr(f"place div {batch_size}"),
            "step": F.col("epoch") * steps + F.expr(f"place div {batch_size * accumulation}"),
        }
    ).drop(rounds, n)


#: Rounds of the permutation of an epoch.
_ROUNDS = 24


def _round_keys(seed: int, epoch: int) -> list[int]:
    """A number of 60 bits for each round of an epoch; none for the first, which stays as it is."""
    return [
        int(hashlib.md5(f"{seed}:{epoch}:{i}".encode()).hexdigest()[:15], 16) for i in range(_ROUNDS if epoch else 0)
    ]


def _permuted(position: Column, n: Column, keys: Column) -> Column:
    """A keyed permutation of the numbers below n, whatever n is: each round pairs x with
    (key - x) mod n, and a bit that depends on the larger of the two tells whether they change places."""

    def step(x: Column, key: Column) -> Column:
        other = (key % n - x + n) % n
        larger = F.greatest(x, other)
        mixed = (larger % 2147483647 * 48271 + key % 2147483647) % 2147483647 * 69621 % 2147483647
        return F.when(F.floor(mixed / 1024) % 2 == 1, other).otherwise(x)

    return F.aggregate(keys, position.cast("long"), step)


def step_budget(
    df: DataFrame, batch_size: int, accumulation: int, epochs: float = 1.0, max_steps: int = -1
) -> DataFrame:
    """Row count and number of optimizer steps of a training run, as one row."""
    micro_batches = F.ceil(F.col("n_rows") / F.lit(batch_size))
    per_epoch = F.ceil(micro_batches / F.lit(accumulation))
    steps = F.lit(max_steps) if max_steps > 0 else F.ceil(per_epoch * F.lit(float(epochs)))
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", steps.cast("long").alias("steps"))


def head(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in key order, sorted; nulls first, ties by chance.

    A running top-n: every task keeps at most ``n`` rows, and one task gets
    those. So ``n`` has to be that of a sample; see :func:`shuffle_take` or the
    order of files for more.
    """
    return df.orderBy(*[F.col(quoted(key)) for key in keys]).limit(max(n, 0))


def sorted_position(
    df: DataFrame, keys: Sequence[str], *, within: str | None = None, shards: int | None = None
) -> DataFrame:
    """Add ``position``, from 0, in key order; for each value of ``within`` anew.

    Nulls come first; rows with equal keys are ordered by a hash of all columns.
    Nothing is sorted as a whole and nothing runs while this is planned. Rows are
    counted by ranges of the first key's value, and rows of heavy ranges by ranges
    inside these; a value that is half of a range is cut by the next key, and where
    there is none by the hash. A position is the sum of the counts before its range
    and the rank inside it. Ranges, and values of ``within`` no heavier than one, are
    dealt out by hash, so a first key with any share of the rows is ranked by many
    tasks, if it is a number or date. Strings are told apart by six bytes, of others
    and of rows that are alike in every column those that are equal stay together.

    What is broadcast has some rows for each of ``shards`` (by default the number
    of shuffle partitions), and none for each row or light value.
    """
    shards = shards or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own, names = [f"_c{i}" for i in range(len(df.columns))], list(df.columns)
    rows = df.toDF(*own)
    key_columns = [own[names.index(key)] for key in keys]
    rows = rows.select(
        *own,
        (F.col(own[names.index(within)]) if within else F.lit(0)).alias("_w"),
        *[_number(F.col(c), rows.schema[c].dataType).alias(f"_x{i}") for i, c in enumerate(key_columns)],
        F.xxhash64(*[c for c in own if not _holds_map(rows.schema[c].dataType)]).alias("_h"),
    )
    exact = _is_exact(df.schema[keys[0]].dataType)
    total = F.col("_n") if within is None else rows.agg(F.count(F.lit(1))).scalar()
    path, starts, counted = ["_w"], [], rows
    for level in range(_LEVELS):
        ranges = _counted(counted, path, len(keys), total if level == 0 else F.max("_total"), level)
        weight = F.col("_n") * (shards * _RANGES_PER_SHARD) / F.col("_total")
        heavy = (weight > 1) & (F.col("_n") > _LIGHT)
        bounds = [c for c in ranges.columns if c not in path and c != "_n"]
        columns = [F.col(c).alias(f"{c}_") for c in path] + bounds
        columns.append(F.when(heavy, F.ceil(weight * _SLOTS).cast("double")).alias("_slots"))
        if level == 0:
            # Of light values of `within` none is sent.
            ranges = ranges.where(heavy)
        else:
            starts.append(f"_start{level}")
            before = Window.partitionBy(*path[:-1]).orderBy(path[-1])
            columns.append((F.sum("_n").over(before) - F.col("_n")).alias(starts[-1]))
        # Ranges of the level, found by the numbers of the levels before.
        alike = F.col("_w").eqNullSafe(F.col("_w_"))
        for c in path[1:]:
            alike = alike & (F.col(c) == F.col(f"{c}_"))
        kept = [c for c in rows.columns if c != "_total"]
        found = rows.select(*kept).join(F.broadcast(ranges.select(*columns)), alike, "left")
        number = F.when(F.col("_slots").isNotNull(), _slot_of_keys(len(keys), exact))
        added = [number.alias(f"_r{level}")] if level < _LEVELS - 1 else []
        rows = found.select(*kept, *(starts[-1:] if level else []), "_total", *added)
        if added:
            path = [*path, f"_r{level}"]
            counted = rows.where(F.col(path[-1]).isNotNull())
    rank = F.row_number().over(Window.partitionBy(*path).orderBy(*key_columns, "_h")) - 1
    position = sum((F.coalesce(start, F.lit(0)) for start in starts), rank)
    return rows.select(*own, position.cast("long").alias("_position")).toDF(*names, "position")


#: Tables of counts: of the whole, of ranges, and of ranges in these; ranges that a shuffle partition
#: gets, about; slots for each such range in what is cut; and rows that one task ranks at any rate.
_LEVELS = 3
_RANGES_PER_SHARD = 4
_SLOTS = 8
_LIGHT = 10_000
_LARGEST = 1.7976931348623157e308


def _counted(rows: DataFrame, path: list[str], keys: int, total: Column, level: int) -> DataFrame:
    """Rows of each range, and where it can be cut; the last table is only counted."""
    stats = [F.count(F.lit(1)).alias("_n")]
    for i in range(keys):
        stats += [F.min(f"_x{i}").alias(f"_lo{i}"), F.max(f"_x{i}").alias(f"_hi{i}")]
    stats.append(F.percentile_approx("_x0", 0.5, 1000).alias("_middle"))
    if level == 0:
        return rows.groupBy(*path).agg(*stats).withColumn("_total", total)
    return rows.groupBy(*path).agg(*stats, total.alias("_total"))


def _is_exact(dtype: T.DataType) -> bool:
    """Whether values with the same :func:`_number` are the same, if below 2 to the 53."""
    return isinstance(dtype, (T.IntegralType, T.DoubleType, T.FloatType, T.DateType, T.BooleanType))


def _number(value: Column, dtype: T.DataType) -> Column:
    """A number that does not fall where the value rises; null for null. 0 for types that
    have none, so these are ranked together."""
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        x = value.cast("int" if isinstance(dtype, T.BooleanType) else "double").cast("double")
    elif isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        day = F.unix_date(value.cast("date")).cast("double")
        x = day
        if not isinstance(dtype, T.DateType):
            x = day * 86400 + F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
    elif isinstance(dtype, T.StringType):
        start = F.rpad(F.hex(F.substring(value.cast("binary"), 1, 6)), 12, "0")
        x = F.conv(start, 16, 10).cast("double")
    else:
        x = F.when(value.isNotNull(), F.lit(0.0))
    x = F.when(F.isnan(x), _LARGEST).otherwise(F.least(F.greatest(x, F.lit(-_LARGEST)), F.lit(_LARGEST)))
    return F.when(value.isNotNull(), x)


def _slot_of_keys(keys: int, exact: bool) -> Column:
    """The number of a row's range inside the range it is in, in key order."""
    slots, x, middle = F.col("_slots"), F.col("_x0"), F.col("_middle")
    if keys > 1:
        inside = _slot(F.col("_x1"), F.col("_lo1"), F.col("_hi1"), slots)
    else:
        inside = F.floor((F.col("_h").cast("double") / 2.0**64 + 0.5) * slots)
    outer = _slot(x, F.col("_lo0"), F.col("_hi0"), slots)
    if not exact:
        return outer.cast("long")
    # Below the middle value, in it, and above it.
    inner = F.when(x < middle, 0).when((x == middle) & (F.abs(x) < 2.0**53), 1 + inside).otherwise(slots + 3)
    return (outer * (slots + 4) + F.when(x.isNull() | (F.abs(middle) >= 2.0**53), 0).otherwise(inner)).cast("long")


def _slot(x: Column, low: Column, high: Column, slots: Column) -> Column:
    """The slot of a number between the least and the largest; 0 for null."""
    part = F.floor((x / 2 - low / 2) / (high / 2 - low / 2) * slots)
    return F.when(x.isNull(), 0).when(low < high, 1 + part).otherwise(1)


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_holds_map(field.dataType) for field in dtype)
    return isinstance(dtype, (T.MapType, T.VariantType))


def _layout(df: DataFrame, shards: int | None) -> tuple[int, int]:
    shards = shards or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shards, _MORE_DIGITS if shards > _MANY_SHARDS else _DIGITS


def _prefix_counts(df: DataFrame, seed: int, keys: Sequence[str], digits: int) -> DataFrame:
    """Rows per digest prefix and rows before it, in digest order."""
    return (
        df.select(F.substring(shuffle_digest(seed, keys), 1, digits).alias("_prefix"))
        .groupBy("_prefix")
        .count()
        .withColumn("_before", F.coalesce(_sum_before("_prefix"), F.lit(0)))
    )


def _place(
    df: DataFrame,
    prefixes: DataFrame,
    seed: int,
    keys: Sequence[str],
    digits: int,
    shards: int,
) -> DataFrame:
    """Send each prefix to its shard and number the rows there."""
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    placed = prefixes.select(
        "_prefix",
        "_before",
        F.floor(F.col("_before") * F.lit(shards) / total).cast("int").alias("_shard"),
    ).select(
        "_prefix",
        "_shard",
        F.min("_before").over(Window.partitionBy("_shard")).alias("_start"),
    )
    reject_taken(df, "position")
    digest, prefix, shard, start = free_names(df, "_digest", "_prefix", "_shard", "_start")
    placed = placed.withColumnsRenamed({"_prefix": prefix, "_shard": shard, "_start": start})
    rank = F.row_number().over(
        Window.partitionBy(shard).orderBy(digest, *[F.col(quoted(key)) for key in keys])
    )
    return (
        df.withColumn(digest, shuffle_digest(seed, keys))
        .withColumn(prefix, F.substring(digest, 1, digits))
        .join(F.broadcast(placed), prefix)
        .repartitionById(shards, F.col(shard))
        .withColumn("position", F.col(start) + rank - 1)
        .drop(digest, prefix, shard, start)
    )


def _sum_before(order: str) -> Column:
    return F.sum("count").over(
        Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
