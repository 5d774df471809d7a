"""Language identification by a convolutional network over bytes.

A text is cut into windows of fixed length. Bytes are embedded, filters of
several widths slide over them, each filter's maximum over the window is
kept, and a softmax tells the languages apart. A text's probabilities are
those of all its windows together. The network is trained in numpy, on the
driver, on a bounded sample of labelled rows; windows are applied in batches.

To filter, the network has one output more, for text in none of the languages.
It learns that from the sample's windows with exchanged or shuffled bytes and
from drawn ones. A text's score is the mean over its windows of the
log-probability of all the languages; labelled rows that it did not learn from
set the score under which a text goes.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rowscribe.llm.common import fold, numbered, pick, position, release

#: Bytes of a window, of an embedded byte, and the filters of each width.
WINDOW, EMBEDDING, FILTERS = 128, 8, 16
WIDTHS = (2, 3, 4)
#: The bound of the training sample: rows of each language, bytes of a text (longer ones
#: don't teach), and windows of a text, evenly spaced. Predictions look at whole texts.
SAMPLE_ROWS, SAMPLE_BYTES, SAMPLE_WINDOWS = 400, 16_384, 8
EPOCHS, MINIBATCH, RATE = 5, 64, 0.004
#: To filter, one in so many rows of a language is not learned but calibrates, and so many of
#: these may score under the threshold.
CALIBRATING, SPARE = 5, 0.02
#: Windows that are computed together, and texts that are Python objects at a time.
BATCH, TEXTS = 256, 500


def windows(raw: bytes) -> np.ndarray:
    """The windows of a text, the last one filled with zero bytes."""
    n = max(1, -(-len(raw) // WINDOW))
    return np.frombuffer(raw.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


@dataclass
class Network:
    """Parameters: embedding, filters and biases of each width, and the output layer."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    output: np.ndarray
    offset: np.ndarray
    #: The lowest score of a text in one of the languages; None for a network that can't tell.
    threshold: float | None = None

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Log-probabilities of the languages for each window, and of none of them if it was learned."""
        tables = [np.tensordot(self.embedding, f.reshape(w, EMBEDDING, -1), ([1], [1])) for w, f in zip(WIDTHS, self.filters)]
        pooled = np.empty((len(x), FILTERS * len(WIDTHS)), np.float32)
        wide = x.astype(np.intp)
        for i, (width, table) in enumerate(zip(WIDTHS, tables)):
            span = WINDOW - width + 1
            total = table[:, 0].take(wide[:, :span], axis=0)
            for j in range(1, width):
                total += table[:, j].take(wide[:, j : j + span], axis=0)
            pooled[:, i * FILTERS : (i + 1) * FILTERS] = total.max(axis=1) + self.biases[i]
        return log_softmax(np.maximum(pooled, 0) @ self.output + self.offset)


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def foreign(x: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Windows that are in none of the languages of the given ones, as many as these: the
    same with bytes exchanged or shuffled, and bytes of few kinds or scripts drawn by chance."""
    out = x.copy()
    for i, kind in enumerate(np.arange(len(x)) % 6):
        if kind < 2:  # another language in the same letters
            exchange = np.arange(256)
            for low, high in ((65, 91), (97, 123), (128, 192), (195, 224)):
                exchange[low:high] = low + random.permutation(high - low)
            out[i] = exchange[x[i]]
        elif kind == 2:
            out[i] = random.permutation(x[i])
        elif kind == 3:
            out[i] = random.choice(random.integers(32, 127, random.integers(2, 80)), WINDOW)
        elif kind == 4:
            out[i] = random.integers(0, 256, WINDOW)
        else:  # letters of another script, some white space and signs among them
            start = int(random.integers(0x250, 0xD700))
            points = start + random.integers(0, random.integers(10, 2000), WINDOW)
            points = np.where(random.random(WINDOW) < random.choice([0.0, 0.1, 0.2]), random.integers(32, 64, WINDOW), points)
            text = "".join(map(chr, np.minimum(points, 0xD7FF))).encode()
            at = int(random.integers(0, len(text) - WINDOW + 1))
            out[i] = np.frombuffer(text[at : at + WINDOW], np.uint8)
    return np.where(x == 0, 0, out)


def train(texts: list[str], labels: list[str], seed: int = 5, others: bool = False) -> Network:
    """A network fitted by Adam to the windows of the texts; with `others` its last output,
    which has no name, is that of windows in none of the languages."""
    random = np.random.default_rng(seed)
    languages = sorted(set(labels))
    parts = [windows(t.encode()) for t in texts]
    parts = [p[np.unique(np.linspace(0, len(p) - 1, SAMPLE_WINDOWS).astype(int))] for p in parts]
    x = np.concatenate(parts).astype(np.int64)
    y = np.repeat([languages.index(label) for label in labels], [len(p) for p in parts])
    outputs = len(languages) + others
    if others:
        x, y = np.concatenate([x, foreign(x, random)]), np.concatenate([y, np.full(len(y), len(languages))])
    weight = (len(y) / (outputs * np.bincount(y, minlength=outputs)))[y].astype(np.float32)
    features = FILTERS * len(WIDTHS)
    p = [random.normal(0, 0.5, (256, EMBEDDING))]
    p += [random.normal(0, (2 / (w * EMBEDDING)) ** 0.5, (w * EMBEDDING, FILTERS)) for w in WIDTHS]
    p += [np.zeros(FILTERS) for _ in WIDTHS]
    p += [random.normal(0, (1 / features) ** 0.5, (features, outputs)), np.zeros(outputs)]
    p = [a.astype(np.float32) for a in p]
    first, second, step, k = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0, len(WIDTHS)
    for _ in range(EPOCHS):
        order = random.permutation(len(y))
        for at in range(0, len(y), MINIBATCH):
            rows = order[at : at + MINIBATCH]
            bytes_, n = x[rows], len(rows)
            embedded = p[0][bytes_]
            pooled, peaks = [], []
            for i, w in enumerate(WIDTHS):
                view = np.lib.stride_tricks.sliding_window_view(embedded, w, axis=1).transpose(0, 1, 3, 2)
                out = view.reshape(n, WINDOW - w + 1, w * EMBEDDING) @ p[1 + i]
                peak = out.argmax(axis=1)
                peaks.append(peak)
                pooled.append(np.take_along_axis(out, peak[:, None], 1)[:, 0] + p[1 + k + i])
            flat = np.concatenate(pooled, axis=1)
            hidden = np.maximum(flat, 0)
            likely = np.exp(log_softmax(hidden @ p[-2] + p[-1]))
            likely[np.arange(n), y[rows]] -= 1
            likely *= weight[rows][:, None] / n
            grad = [np.zeros_like(a) for a in p]
            grad[-2], grad[-1] = hidden.T @ likely, likely.sum(axis=0)
            back = (likely @ p[-2].T) * (flat > 0)
            for i, w in enumerate(WIDTHS):
                g = back[:, i * FILTERS : (i + 1) * FILTERS]
                grad[1 + k + i] = g.sum(axis=0)
                places = peaks[i][:, :, None] + np.arange(w)  # rows, filters, width
                seen = np.take_along_axis(bytes_, places.reshape(n, -1), 1).reshape(n, FILTERS, w)
                source = p[0][seen].reshape(n, FILTERS, w * EMBEDDING)
                grad[1 + i] = np.einsum("nf,nfd->df", g, source)
                spread = (g[:, :, None] * p[1 + i].T[None]).reshape(-1, EMBEDDING)
                np.add.at(grad[0], seen.reshape(-1), spread)
            step += 1
            for a, g, m, v in zip(p, grad, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                a -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(languages, p[0], p[1 : 1 + k], p[1 + k : 1 + 2 * k], p[-2], p[-1])


def window_sums(network: Network, texts: list[str | None], value: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums over each text's windows of what `value` makes of their log-probabilities, in a
    column for each language at most, and the number of windows; 0 for a text without a letter."""
    held: list[tuple[int, np.ndarray]] = []
    sums, sizes = np.zeros((len(texts), len(network.languages))), np.zeros(len(texts), np.int64)

    def flush() -> None:
        if held:
            owners = np.repeat([i for i, _ in held], [len(w) for _, w in held])
            np.add.at(sums, owners, value(network.log_odds(np.concatenate([w for _, w in held]))))
            held.clear()

    size = 0
    for i, text in enumerate(texts):
        if text and any(map(str.isalpha, text)):
            own = windows(text.encode())
            sizes[i] = len(own)
            for at in range(0, len(own), BATCH):
                held.append((i, own[at : at + BATCH]))
                size += len(held[-1][1])
                if size >= BATCH:
                    flush()
                    size = 0
    flush()
    return sums, sizes


def predict(network: Network | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """The language and its probability for each text; `und` and 0 without a letter or a network."""
    langs, scores = ["und"] * len(texts), [0.0] * len(texts)
    if network is None:
        return langs, scores
    sums, sizes = window_sums(network, texts, lambda odds: odds[:, : len(network.languages)])
    likely = np.exp(log_softmax(sums))
    for i in np.flatnonzero(sizes):
        langs[i], scores[i] = network.languages[int(likely[i].argmax())], float(likely[i].max())
    return langs, scores


def known_scores(network: Network, texts: list[str | None]) -> np.ndarray:
    """The mean over a text's windows of the log-probability that they are in any of the
    languages; minus infinity without a letter. The network has to have learned the others."""
    sums, sizes = window_sums(network, texts, lambda odds: np.logaddexp.reduce(odds[:, :-1], axis=1)[:, None])
    return np.where(sizes > 0, sums[:, 0] / np.maximum(sizes, 1), -np.inf)


def training_sample(df: DataFrame, doc_id: str, text: str, lang: str) -> list:
    """(text, lang) of rows of folds 1 to 4 that have a text and a language: at most
    SAMPLE_ROWS of each language, those whose ids hash lowest.

    Numbers of rows set a hash for each language under which little over SAMPLE_ROWS of them
    lie, so only these are ranked, however many tasks there are. The driver holds one
    number a language, as the network has an output for each.
    """
    rows = pick(df, doc_id=doc_id, text=text, lang=lang).where(
        (fold(F.col("doc_id")) != 0) & F.col("lang").isNotNull() & (F.length(F.trim("text")) > 0) & (F.octet_length("text") <= SAMPLE_BYTES)
    )
    hashed = rows.withColumn("h", F.xxhash64("doc_id"))
    limits = []
    for name, n, least in hashed.groupBy("lang").agg(F.count("*"), F.min("h")).collect():
        share = min(1.0, (1.1 * SAMPLE_ROWS + 100) / n)
        limits.append((name, max(least, min(2**63 - 1, int(share * 2.0**64) - 2**63))))
    if not limits:
        return []
    known = df.sparkSession.createDataFrame(limits, StructType([StructField("lang", rows.schema["lang"].dataType), StructField("limit", LongType())]))
    start = hashed.join(F.broadcast(known), "lang").where("h <= limit").select("lang", "h", "text")
    ranked = start.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text")))
    picked = ranked.where(F.col("n") <= SAMPLE_ROWS)
    sample = picked.select("text", "lang").collect()
    sample.sort(key=lambda r: zlib.crc32(r["text"].encode()))
    return sample


def fit(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """A network learned from the training sample. None where no row can teach."""
    sample = training_sample(df, doc_id, text, lang)
    return train([r["text"] for r in sample], [r["lang"] for r in sample]) if sample else None


def fit_filter(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """A network that also tells texts in none of the languages, with its threshold. None
    where no row can teach.

    A text goes that is less likely in a language than not, unless as many of the
    calibrating rows of some language as SPARE allows score lower; then that is the threshold. A language
    with fewer rows than CALIBRATING is calibrated on those it was learned from.
    """
    of: dict[str, list[str]] = {}
    for row in training_sample(df, doc_id, text, lang):
        of.setdefault(row["lang"], []).append(row["text"])
    if not of:
        return None
    learned = [(t, name) for name, texts in of.items() for i, t in enumerate(texts) if (i + 1) % CALIBRATING]
    network = train([t for t, _ in learned], [name for _, name in learned], others=True)
    network.threshold = float(np.log(0.5))
    for texts in of.values():
        scores = known_scores(network, texts[CALIBRATING - 1 :: CALIBRATING] or texts)
        scores = scores[np.isfinite(scores)]
        if len(scores):
            network.threshold = min(network.threshold, float(np.quantile(scores, SPARE, method="lower")))
    return network


def predict_languages(df: DataFrame, network: Network | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every whole text.

    A text that is null, empty or has no letter is `und` with score 0, and so is
    every text if there was nothing to learn from. Ties go to the language
    that sorts first. Rows are judged by their text alone, so repeated rows
    share their result; other columns are left out.
    """
    sent = df.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        for batch in batches:
            langs, scores = predict(sent.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    docs = pick(df, doc_id=doc_id, text=text)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id")) == 0).alias("held_out"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_lettered(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text has a letter."""
    frame = numbered(df)
    return frame.where(F.col(position(df, text)).cast("string").rlike(r"\p{L}")).toDF(*df.columns)


def keep_languages(df: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text is in a learned language: those
    that score under the network's threshold go, and those without a letter. Without a network all stay."""
    if network is None:
        return df
    sent = df.sparkSession.sparkContext.broadcast(network)

    @F.arrow_udf("boolean")
    def known(texts: pa.Array) -> pa.Array:
        release()
        own, kept = sent.value, []
        for at in range(0, len(texts), TEXTS):
            rows = texts.slice(at, TEXTS).to_pylist()
            if own.threshold is None:
                kept += [lang != "und" for lang in predict(own, rows)[0]]
            else:
                kept += (known_scores(own, rows) >= own.threshold).tolist()
        return pa.array(kept, pa.bool_())

    frame = numbered(df)
    return frame.where(known(F.col(position(df, text)).cast("string"))).toDF(*df.columns)
