"""URL filter: rules for hosts and paths, and a character language-model ratio
for URLs that no rule decides.

Two Markov models of variable order, of accepted and of rejected URLs, give
each character's probability after the characters before it: the longest
context first, smoothed by the next shorter one in proportion to how seldom
the context was seen. The difference of log-likelihoods, divided by the
length, is held against a threshold calibrated on a held-out fold.

The models learn from every URL that a rule decides. Each context and character
is counted by itself, in a table that grows with the corpus; URLs are scored by
joins with it, so neither the driver nor a task holds a model. Grams that are frequent in all
URLs are few, by their share of all places, and are looked up instead.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowscribe.llm.common import checkpointed, pick

#: Characters before the predicted one that the longest context has.
ORDER = 4
#: Kinds of characters: bytes, and what is before a URL's start. A context and its character
#: are one number with so many values a digit, the character last.
KINDS = 257
#: Parts of a log-ratio: sums of whole numbers are the same in every order.
PARTS = 1 << 32
#: URLs whose characters are looked at together.
BATCH = 1000
#: A gram with more than one in so many places is looked up; there are fewer of them than that.
HEAVY = 10_000
#: Weight of the shorter context, in observations.
WEIGHT = 2.0
#: Scores are calibrated in this many steps over [-RANGE, RANGE].
STEPS, RANGE = 2000, 10.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A host and the start of a path, as `example.net/en/`."""

    pattern: str
    allow: bool

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path; empty where url is null or has no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return (F.coalesce(F.translate(raw, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit("")))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, the first of equals, and whether it allows; null where none does."""
    name, allow = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for rule in sorted(rules, key=lambda r: len(r.pattern)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.pattern).otherwise(name)
        allow = F.when(fits, rule.allow).otherwise(allow)
    return name, allow


def grams(urls: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each character of the URLs with the ORDER before it, as a number; and the URLs' sizes."""
    raw = [np.frombuffer(u.encode(), np.uint8).astype(np.int64) for u in urls]
    start = np.full(ORDER, KINDS - 1, np.int64)
    text = np.concatenate([part for r in raw for part in (start, r)])
    sizes = np.array([len(r) for r in raw], np.int64)
    own = np.ones(len(text), bool)
    begin = np.concatenate([[0], np.cumsum(sizes + ORDER)[:-1]])
    own[(begin[:, None] + np.arange(ORDER)).ravel()] = False
    places = np.flatnonzero(own)
    out = np.zeros(len(places), np.int64)
    for before in range(ORDER, -1, -1):
        out = out * KINDS + text[places - before]
    return out, sizes


def count_grams(frame: DataFrame) -> DataFrame:
    """(gram, accepted, rejected, times): how often each gram of any URL is in the (read, learn) rows
    whose `learn` is true, in those where it is false, 0 for one that is in others only, and in all."""

    def count(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                found, sizes = grams(batch.column(0).to_pylist())
                learn = batch.column(1).to_pylist()
                kinds, of = np.unique(found, return_inverse=True)
                numbers = []
                for side in (True, False):
                    weight = np.repeat([x is side for x in learn], sizes)
                    numbers.append(pa.array(np.bincount(of[weight], minlength=len(kinds)), pa.int64()))
                numbers.append(pa.array(np.bincount(of, minlength=len(kinds)), pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int64()), *numbers], ["gram", "accepted", "rejected", "times"])

    counted = frame.select("read", "learn").mapInArrow(count, "gram long, accepted long, rejected long, times long")
    return counted.groupBy("gram").agg(*(F.sum(name).alias(name) for name in ("accepted", "rejected", "times")))


def summed(counts: DataFrame, gram: Column) -> DataFrame:
    return counts.groupBy(gram.alias("gram")).agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))


def gram_ratios(counts: DataFrame, accepted: int, rejected: int) -> DataFrame:
    """(gram, ratio): the log-likelihood of each gram's character among the accepted less that
    among the rejected, in PARTS. `accepted` and `rejected` are the sums of the counts."""
    levels = [counts.select("gram", "accepted", "rejected")]
    for order in range(ORDER - 1, -1, -1):  # every place has one gram of each order
        levels.insert(0, summed(levels[0], F.col("gram") % KINDS ** (order + 1)))
    totals = {"accepted": F.lit(accepted), "rejected": F.lit(rejected)}
    shorter = {side: F.lit(1 / 256) for side in totals}
    likely = None
    for order, level in enumerate(levels):
        if order:
            # At most KINDS rows have the same context, or the same end.
            context = Window.partitionBy(F.expr(f"gram div {KINDS}"))
            level = level.withColumns({f"all_{side}": F.sum(side).over(context) for side in totals}).withColumn("end", F.col("gram") % KINDS**order)
            level = level.join(likely.withColumnRenamed("gram", "end"), "end")
            totals = {side: F.col(f"all_{side}") for side in totals}
            shorter = {side: F.col(f"likely_{side}") for side in totals}
        likely = level.select("gram", *(((F.col(side) + WEIGHT * shorter[side]) / (totals[side] + WEIGHT)).alias(f"likely_{side}") for side in totals))
    ratio = F.log("likely_accepted") - F.log("likely_rejected")
    return likely.select("gram", F.round(ratio * PARTS).cast("long").alias("ratio"))


def sum_ratios(frame: DataFrame, ratios: DataFrame, often: DataFrame) -> DataFrame:
    """(row, total): the sum of the ratios of all characters of each (row, read) that has any.

    Grams of `often`, fewer than HEAVY, are added up where the URL is read; the others meet
    their ratio in a join by gram, which then has no gram with a larger share.
    """
    known = often.select("gram").join(ratios, "gram").toPandas().sort_values("gram")
    sent = frame.sparkSession.sparkContext.broadcast((known["gram"].to_numpy(np.int64), known["ratio"].to_numpy(np.int64)))

    def places(batches):
        heavy, ratio = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                found, sizes = grams(batch.column(1).to_pylist())
                own = batch.column(0).to_numpy(zero_copy_only=False)
                at = np.repeat(np.arange(len(own)), sizes)
                place = np.minimum(np.searchsorted(heavy, found), max(len(heavy) - 1, 0))
                is_heavy = heavy[place] == found if len(heavy) else np.zeros(len(found), bool)
                sums = np.zeros(len(own), np.int64)
                np.add.at(sums, at[is_heavy], ratio[place[is_heavy]])
                # A URL's sum has a key of its own below all grams, which meets nothing.
                rows = np.concatenate([own, own[at[~is_heavy]]])
                keys = np.concatenate([-1 - own, found[~is_heavy]])
                summed_up = np.concatenate([sums, np.zeros(len(keys) - len(own), np.int64)])
                columns = [pa.array(x, pa.int64()) for x in (rows, keys, summed_up)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "gram", "known"])

    found = frame.select("row", "read").mapInArrow(places, "row long, gram long, known long")
    rare = ratios.join(often.select("gram"), "gram", "left_anti")
    total = F.sum(F.coalesce("ratio", "known")).alias("total")
    return found.join(rare, "gram", "left").groupBy("row").agg(total)


def calibrate(held: DataFrame) -> float:
    """The score that best tells the held-out classes of (score, allow) apart, by the mean of
    their shares on the right side; the middle of equals, 0 without both classes."""
    at = F.floor((F.col("score") + RANGE) / (2 * RANGE) * STEPS)
    step = F.least(F.greatest(at, F.lit(0)), F.lit(STEPS - 1)).cast("int").alias("step")
    numbers = np.zeros((2, STEPS), np.int64)
    for row in held.groupBy("allow", step).count().collect():
        numbers[int(row["allow"]), row["step"]] = row["count"]
    rejected, accepted = numbers
    if not rejected.sum() or not accepted.sum():
        return 0.0
    below = np.concatenate([[0], np.cumsum(rejected)]) / rejected.sum()
    above = 1 - np.concatenate([[0], np.cumsum(accepted)]) / accepted.sum()
    best = np.flatnonzero(np.isclose(below + above, (below + above).max()))
    return float((best[0] + best[-1]) / 2 / STEPS * 2 * RANGE - RANGE)


def filter_urls(df: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every URL.

    A null URL or one without `://` has an empty host and path. The models read
    host, path and what follows; of such a URL they read nothing, and its score
    is 0. A score at or above the threshold allows. Without URLs of both kinds
    to learn from every score is 0, and what no rule blocks is allowed. Each row is judged by itself, so
    repeated and null ids stay as they are; other columns are left out.
    """
    frame = pick(df, page_id=page_id, url=url).withColumn("url", F.col("url").cast("string"))
    host, path = host_and_path(F.col("url"))
    frame = frame.withColumn("host", host).withColumn("path", path)
    name, allow = matching_rule(F.col("host"), F.col("path"), rules)
    read = F.when(F.instr("url", "://") > 0, F.translate(F.substring(F.col("url"), F.instr("url", "://") + 3, F.length("url")), _UPPER, _LOWER))
    frame = frame.withColumns({"rule": name, "allow": allow}).withColumn("read", F.coalesce(read, F.lit("")))
    held_out = F.crc32(F.col("url").cast("binary")) % 5 == 0
    frame = frame.withColumn("held_out", held_out).withColumn("learn", F.when(~F.col("held_out"), F.col("allow")))
    # Numbered in a checkpoint, so that scores find their rows whatever is computed again.
    frame = checkpointed(frame.drop("url").withColumn("row", F.monotonically_increasing_id()))
    filled = frame.where(F.col("read") != "")
    counts = checkpointed(count_grams(filled))
    accepted, rejected, times = counts.agg(F.sum("accepted"), F.sum("rejected"), F.sum("times")).first()
    if accepted and rejected:
        often = counts.where(F.col("times") * HEAVY > times)
        ratios = checkpointed(gram_ratios(counts, accepted, rejected))
        totals = checkpointed(sum_ratios(filled, ratios, often))
        mean = F.coalesce("total", F.lit(0)) / F.lit(float(PARTS)) / F.greatest(F.octet_length("read"), F.lit(1))
        scored = frame.join(totals, "row", "left").withColumn("score", mean)
        threshold = calibrate(scored.where(F.col("held_out") & F.col("allow").isNotNull()))
    else:
        scored, threshold = frame.withColumn("score", F.lit(0.0)), 0.0
    verdict = F.when(F.coalesce("allow", F.col("score") >= threshold), "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
