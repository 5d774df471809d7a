"""A quality classifier: Naive Bayes weights under a support vector machine.

A text's features say which n-grams of words and of bytes it has. Each is
scaled by the log of its share in good over its share in bad texts. A linear
model with hinge loss is fitted to the scaled features by dual coordinate
descent, and its margin is turned into a probability by a logistic curve.

The fit is on labelled rows of the training folds of a bounded number: their
ids are chosen first, so texts are neither shuffled nor gathered to choose them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowscribe.llm.common import Recent, fold, lowest_hashes, mix, pick, rows_of, task_sums, to_array

#: Hashed features.
FEATURES = 1 << 18
#: n-grams of words and of bytes.
WORDS, BYTES = (1, 2), (2, 3)
#: The bound of the fit: labelled ids, those that hash lowest, whose texts give the log-count
#: ratios; of these the ids that the margin is fitted to, and the bytes of such a text. Longer
#: texts count for the ratios only.
LABELLED_IDS, SAMPLE_IDS, SAMPLE_BYTES = 20_000, 4000, 16_384
EPOCHS, COST, SMOOTHING = 15, 0.1, 1.0
#: A score from here on is predicted good.
THRESHOLD = 0.3
#: Bytes of a text whose byte n-grams are hashed at once.
_BLOCK = 1 << 20
_WORD = Recent(xxhash.xxh3_64_intdigest, 200_000)


def features(text: str | None) -> np.ndarray:
    """The sorted slots of a text's n-grams; A-Z are not lower-cased, as capitals tell."""
    raw = (text or "").encode()
    words = raw.split()
    hashes = np.fromiter(map(_WORD.__getitem__, words), np.uint64, len(words))
    out = []
    for n in WORDS:
        gram = np.full(max(0, len(hashes) - n + 1), n, np.uint64)
        for i in range(n):
            gram = mix(gram * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(gram)])
        out.append(np.unique((gram >> np.uint64(46)).astype(np.int32)))
    for at in range(0, len(raw), _BLOCK):
        part = np.frombuffer(raw[at : at + _BLOCK + max(BYTES) - 1], np.uint8).astype(np.uint32)
        for n in BYTES:
            gram = np.full(max(0, len(part) - n + 1), n, np.uint32)
            for i in range(n):
                gram = gram << np.uint32(8) | part[i : i + len(gram)]
            gram = np.unique(gram).astype(np.uint64)
            out.append((mix(gram) >> np.uint64(46)).astype(np.int32))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.int32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    ratio: np.ndarray
    slope: float
    offset: float

    def score(self, text: str | None) -> float:
        at = margin(self.weights, self.bias, self.ratio, features(text))
        return float(1 / (1 + np.exp(-np.clip(self.slope * at + self.offset, -40, 40))))


def log_count_ratio(counts: np.ndarray) -> np.ndarray:
    """counts: [bad, good] by feature."""
    bad, good = counts + SMOOTHING
    return np.log(good / good.sum()) - np.log(bad / bad.sum())


def coordinate_descent(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, seed: int = 10) -> tuple[np.ndarray, float]:
    """Weights of the features and a bias of the linear hinge-loss model over rows whose
    features are scaled by the ratio, with the classes weighted to equal parts."""
    random = np.random.default_rng(seed)
    weights, bias = np.zeros(len(ratio)), 0.0
    scaled = [ratio[r] for r in rows]
    norms = [max(float(s @ s), 1e-12) ** 0.5 for s in scaled]
    scaled = [s / n for s, n in zip(scaled, norms)]
    signs = np.where(labels, 1.0, -1.0)
    share = max(labels.mean(), 1e-9), max(1 - labels.mean(), 1e-9)
    cost = np.where(labels, COST / 2 / share[0], COST / 2 / share[1]) * 10
    alpha = np.zeros(len(rows))
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)):
            gradient = signs[i] * (weights[rows[i]] @ scaled[i] + bias) - 1
            new = min(max(alpha[i] - gradient / 2, 0.0), cost[i])
            if new != alpha[i]:
                move = (new - alpha[i]) * signs[i]
                weights[rows[i]] += move * scaled[i]
                bias += move
                alpha[i] = new
    return weights, bias


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of label 1, by Newton's method."""
    slope, offset = 1.0, 0.0
    # Targets short of 0 and 1 keep the curve finite where the classes separate.
    good, bad = labels.sum(), (~labels).sum()
    target = np.where(labels, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([margins, np.ones(len(margins))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)) @ x.T + 1e-6 * np.eye(2), x @ (target - p))
        slope, offset = slope + np.clip(step[0], -5, 5), offset + np.clip(step[1], -5, 5)
    return float(max(slope, 1e-6)), float(offset)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> Model | None:
    """A model learned from labelled rows of folds 1 to 4; None unless both labels occur.

    A row with a null id or label teaches nothing. The log-count ratios are of all rows
    with the LABELLED_IDS labelled ids that hash lowest; the margin is of the first
    SAMPLE_IDS of these, one text for each, if of up to SAMPLE_BYTES bytes; a fifth
    of them fits the curve.
    """
    # Repeated labels of a document count once, by their least.
    known = pick(labels, doc_id=doc_id, quality=quality).where("quality in (0, 1) and doc_id is not null")
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("good"))
    learned = lowest_hashes(known.where(fold(F.col("doc_id")) != 0), "doc_id", LABELLED_IDS).collect()
    if not learned:
        return None
    rows = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def labelled(ids: list) -> DataFrame:
        # At most LABELLED_IDS pairs of numbers.
        return rows.join(F.broadcast(docs.sparkSession.createDataFrame(ids, "doc_id long, good int")), "doc_id")

    def count(batches):
        total = np.zeros(2 * FEATURES, np.int64)
        for texts, good in rows_of(batches):
            for one, label in zip(texts, good):
                total[features(one) + label * FEATURES] += 1
        slots = np.flatnonzero(total)
        yield slots, total[slots]

    counts = to_array(task_sums(labelled(learned).select("text", "good"), count), 2 * FEATURES).reshape(2, FEATURES)
    short = labelled(learned[:SAMPLE_IDS]).where(F.octet_length("text") <= SAMPLE_BYTES)
    # A repeated document teaches once, by its least text.
    sample = short.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("good").alias("good")).collect()
    sample.sort(key=lambda r: xxhash.xxh3_64_intdigest(str(r["doc_id"])))
    labels_ = np.array([r["good"] == 1 for r in sample], bool)
    if not labels_.any() or labels_.all():
        return None
    own = [features(r["text"]) for r in sample]
    ratio = log_count_ratio(counts)
    held = np.arange(len(own)) % 5 == 0
    if held.sum() < 10 or not labels_[held].any() or labels_[held].all() or not labels_[~held].any() or labels_[~held].all():
        held[:] = False
    kept = np.flatnonzero(~held)
    weights, bias = coordinate_descent([own[i] for i in kept], labels_[kept], ratio)
    judged = np.flatnonzero(held) if held.any() else kept
    margins = np.array([margin(weights, bias, ratio, own[i]) for i in judged])
    return Model(weights, bias, ratio, *logistic(margins, labels_[judged]))


def margin(weights: np.ndarray, bias: float, ratio: np.ndarray, slots: np.ndarray) -> float:
    """The margin of a row whose scaled features have length one."""
    scaled = ratio[slots]
    return float(weights[slots] @ scaled) / max(float(scaled @ scaled), 1e-12) ** 0.5 + bias


def score_quality(df: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text.

    A null text is scored as an empty one, by the model's bias. Without a
    model every score is 0.5. Rows are judged by their text alone, so repeated
    rows share their result; other columns are left out.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            model = sent.value
            scores = pa.array([model.score(t) if model else 0.5 for t in batch.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), scores], ["doc_id", "held_out", "score"])

    docs = pick(df, doc_id=doc_id, text=text)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id")) == 0).alias("held_out"), F.col("text").cast("string").alias("text"))
    scored = docs.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
