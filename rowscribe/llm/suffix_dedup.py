"""Removal of repeated passages by suffix sorting.

A byte is removed if it lies in a string of `length` bytes that also starts
in a document with a smaller id. Such strings are windows; a window's anchor
is the place in it whose K bytes hash lowest, so equal windows have equal
anchors, and neighbouring windows share theirs. What an anchor stands for is
the context of its windows, a stretch of less than twice the length.

1. Every document's anchors go to tasks by hash, as packed numbers. An anchor
   that only one document has settles all its windows. One whose whole context
   a smaller id has is wholly repeated. Of the others, the first of each
   context is to be sorted.
2. The contexts to be sorted go to tasks by their anchor. Their suffixes, the
   windows, are sorted by the deep-shallow method; equal ones are neighbours,
   and those of any but the smallest id are repeated.
3. The spans of each document are joined and cut out of its text.

Tasks settle what they can of their own rows first: of copies in one batch only
the smallest id goes on, so a passage that a third of all documents has comes
to one place once for each batch. Anchors with many contexts are sorted by
window, dealt out by the windows themselves. No step holds a text longer than
the longest document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowscribe.llm.common import mix, numbered, pick, position
from rowscribe.llm.suffix_sort import deep_shallow_sort

#: Bytes of the default window, and of the strings whose hashes choose anchors.
LENGTH, K = 50, 24
#: Bytes of text whose anchors meet in one task; larger executors may take more.
GROUP_BYTES = 8 << 20
#: Bytes of text that are looked at together, and windows of a long text.
BLOCK_BYTES = 1 << 19
#: Anchors that a task holds before it sends them; copies among them are settled.
ANCHORS = 1 << 19
#: Contexts of an anchor beyond which its windows are dealt out by themselves.
MANY_CONTEXTS = 2000
#: Sorting tasks for each task of anchors.
SORTS = 4
#: An id that stands for null: after all others.
LAST_ID = 2**63 - 1
#: What is known of an anchor: all windows repeated, or to be sorted by context or by window.
REPEATED, BY_CONTEXT, BY_WINDOW = 1, 2, 3
_PLACE = np.uint64((1 << 26) - 1)
_RANDOM = np.random.default_rng(7)
_BYTE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Runs:
    """The anchors of a block of texts: one entry for each run of windows with one anchor."""

    def __init__(self, raw: np.ndarray, sizes: np.ndarray, length: int) -> None:
        ends = np.cumsum(sizes)
        windows = len(raw) - length + 1
        self.raw = raw
        if windows <= 0:
            self.doc = self.begin = self.end = self.anchor = np.zeros(0, np.int64)
            self.hash = self.context = np.zeros(0, np.uint64)
            return
        up, down = _powers(_BASE, len(raw) + 1), _powers(_INVERSE, len(raw) + 1)
        # Sums that give the hash of any stretch from its two ends.
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * up[:-1])])
        hashes = mix((sums[K:] - sums[:-K]) * down[: len(raw) - K + 1])
        keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        span = length - K + 1
        least, size = keys, 1
        while size < span:
            step = min(size, span - size)
            least = np.minimum(least[:-step], least[step:])
            size += step
        anchors = (least[:windows] & _PLACE).astype(np.int64)
        owner = np.repeat(np.arange(len(sizes)), sizes)[:windows]
        valid = np.arange(windows) + length <= ends[owner]
        new = np.ones(windows, bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | ~valid[:-1]
        begin = np.flatnonzero(new & valid)
        last = valid.copy()
        last[:-1] &= new[1:] | ~valid[1:]
        end = np.flatnonzero(last) + 1  # one past the last window
        self.doc, self.begin, self.end, self.anchor = owner[begin], begin, end, anchors[begin]
        # Anchors have low hashes; mixed again they spread evenly over the parts.
        self.hash = mix(hashes[self.anchor] + np.uint64(_BASE))
        stretch = (sums[end + length - 1] - sums[begin]) * down[begin]
        shape = ((self.anchor - begin) << 20 | (end - begin)).astype(np.uint64)
        self.context = mix(mix(stretch) + shape)


def _blocks(texts: pa.Array, length: int):
    """(first row, where its text begins in the block, sizes, runs) of blocks of bounded
    size, read in place. A long text comes in several, whose windows follow each other."""
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BLOCK_BYTES, "right")) - 1)
        begin, end = bounds[at], bounds[to]
        sizes = np.diff(bounds[at : to + 1])
        if end - begin <= BLOCK_BYTES:
            yield at, 0, sizes, _Runs(raw[begin:end], sizes, length)
        else:
            for offset in range(0, max(1, int(end - begin) - length + 1), BLOCK_BYTES):
                part = raw[begin + offset : min(end, begin + offset + BLOCK_BYTES + length - 1)]
                yield at, offset, sizes, _Runs(part, np.array([len(part)]), length)
        at = to


def _ordinals(docs: np.ndarray, carry: dict[int, int]) -> np.ndarray:
    """The number of each run within its row; rows are ascending."""
    if not len(docs):
        return docs
    starts = np.flatnonzero(np.diff(docs, prepend=docs[0] - 1))
    within = np.arange(len(docs)) - np.repeat(starts, np.diff(np.append(starts, len(docs))))
    first = int(docs[0])
    within[docs == first] += carry.get(first, 0)
    carry.clear()
    carry[int(docs[-1])] = int(within[-1]) + 1
    return within


def _order(hashes: np.ndarray, contexts: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The order by hash, then context, then document; most hashes occur once."""
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    tied = np.flatnonzero(np.append(same, False) | np.append(False, same))
    among = order[tied]
    order[tied] = among[np.lexsort((docs[among], contexts[among], hashes[among]))]
    return order


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte, so that equal high bytes stand together and compress."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T).tobytes()


def _numbers(planes: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _code(ordinal: np.ndarray, context: np.ndarray, state) -> np.ndarray:
    """What is known of a run of a document: its number, a part of its context that
    must agree when it is met again, and the state."""
    return (ordinal.astype(np.int64) << 30) | ((context >> np.uint64(20)) & np.uint64((1 << 28) - 1)).astype(np.int64) << 2 | state


_ANCHOR_FIELDS = "part int, settled boolean, hash binary, context binary, doc binary, ordinal binary"


def _send_anchors(docs: DataFrame, parts: int, length: int) -> DataFrame:
    """Packed anchors by part of the range of hashes; of equal contexts in a batch only
    the smallest id's, the others are settled here."""

    def pack(part, settled, hashes, contexts, docs_, ordinals):
        return part, settled, _planes(hashes), _planes(contexts), _planes(docs_), _planes(ordinals)

    def run(batches):
        for batch in batches:
            ids = batch.column("doc").to_numpy()
            held, size = [], 0
            carry: dict[int, int] = {}
            for first, _, _, runs in _blocks(batch.column("text"), length):
                rows = runs.doc + first
                held.append((runs.hash, runs.context, ids[rows], _ordinals(rows, carry)))
                size += len(rows)
                if size >= ANCHORS:
                    yield send(held)
                    held, size = [], 0
            if size:
                yield send(held)

    def send(held):
        h, c, d, o = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order = _order(h, c, d)
        h, c, d, o = h[order], c[order], d[order], o[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
        head = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
        repeated = d > d[head]
        rows = []
        if repeated.any():
            rows.append(pack(int(c[0] % np.uint64(parts)), True, h[:0], c[:0], d[repeated], _code(o[repeated], c[repeated], REPEATED)))
        h, c, d, o = (x[~repeated] for x in (h, c, d, o))
        part = ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        edges = np.searchsorted(part, np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(edges)):
            s = slice(edges[p], edges[p + 1])
            # The part has the high bits; 32 more of the hash and 48 of the context decide.
            low = h[s].astype(np.uint32)
            rows.append(pack(int(p), False, low, c[s] >> np.uint64(16), d[s], o[s].astype(np.uint32)))
        return _rows(rows, _ANCHOR_FIELDS)

    return docs.select("doc", "text").mapInArrow(run, _ANCHOR_FIELDS)


def _rows(rows: list[tuple], fields: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    named = [f.split() for f in fields.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in named]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, named)], [n for n, _ in named])


def _judge(anchors: DataFrame) -> DataFrame:
    """(doc, code) of the runs that are repeated or to be sorted."""

    def run(group: pa.Table) -> pa.Table:
        docs, codes = [], []
        h, c, d, o = [], [], [], []
        for settled, hashes, contexts, ids, ordinals in zip(*(group.column(n).to_pylist() for n in ("settled", "hash", "context", "doc", "ordinal"))):
            if settled:
                docs.append(_numbers(ids, np.int64)), codes.append(_numbers(ordinals, np.int64))
            else:
                h.append(_numbers(hashes, np.uint32)), c.append(_numbers(contexts, np.uint64))
                d.append(_numbers(ids, np.int64)), o.append(_numbers(ordinals, np.uint32))
        if h:
            h, c, d, o = (np.concatenate(x) for x in (h, c, d, o))
            order = _order(h, c, d)
            h, c, d, o = h[order], c[order], d[order], o[order]
            new_hash = np.diff(h, prepend=h[:1]) != 0
            new_hash[0] = True
            new = new_hash.copy()
            new[1:] |= c[1:] != c[:-1]
            at = np.arange(len(h))
            repeated = d > d[np.maximum.accumulate(np.where(new, at, 0))]
            begin = np.flatnonzero(new_hash)
            sizes = np.diff(np.append(begin, len(h)))
            contexts = np.add.reduceat(new, begin)
            several = np.minimum.reduceat(d, begin) < np.maximum.reduceat(d, begin)
            state = np.where((contexts > 1) & several, np.where(contexts > MANY_CONTEXTS, BY_WINDOW, BY_CONTEXT), 0)
            state = np.where(repeated, REPEATED, np.repeat(state, sizes))
            told = state > 0
            docs.append(d[told]), codes.append(_code(o[told], c[told] << np.uint64(16), state[told]))
        return pa.table({"doc": np.concatenate(docs) if docs else np.zeros(0, np.int64), "code": np.concatenate(codes) if codes else np.zeros(0, np.int64)})

    return anchors.groupBy("part").applyInArrow(run, "doc long, code long")


_PIECE_FIELDS = "part long, doc long, tag long, begin long, end long, context binary"


def _send_contexts(told: DataFrame, parts: int, length: int) -> DataFrame:
    """Spans that are repeated, without a context, and contexts to be sorted, by part.
    Windows that are sent one by one are sent once for each batch, by the smallest id."""

    def run(batches):
        for batch in batches:
            docs, tags = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("doc", "tag"))
            codes = batch.column("codes")
            known, owners = codes.flatten().to_numpy(), np.repeat(np.arange(len(docs)), codes.value_lengths().to_numpy())
            edges = np.searchsorted(owners, np.arange(len(docs) + 1))
            single: dict[bytes, list[tuple[int, int]]] = {}
            carry: dict[int, int] = {}
            for first, offset, sizes, runs in _blocks(batch.column("text"), length):
                if not len(runs.doc):
                    continue
                rows = runs.doc + first
                numbers = _ordinals(rows, carry)
                state = _states(rows, numbers, runs.context, known[edges[first] : edges[rows[-1] + 1]], owners[edges[first] : edges[rows[-1] + 1]])
                # Where each run's text begins in the block.
                shift = offset - np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)[runs.doc]
                begin, end = runs.begin + shift, runs.end + shift
                # Runs side by side that are repeated make one span.
                whole = np.flatnonzero(state == REPEATED)
                if len(whole):
                    new = np.append(True, (begin[whole[1:]] != end[whole[:-1]]) | (rows[whole[1:]] != rows[whole[:-1]]))
                    s, e = whole[new], whole[np.append(np.flatnonzero(new)[1:] - 1, len(whole) - 1)]
                    yield _pieces(docs[rows[s]] % parts, docs[rows[s]], tags[rows[s]], begin[s], end[e] + length - 1, [None] * len(s))
                raw = runs.raw.tobytes()
                some = np.flatnonzero(state == BY_CONTEXT)
                if len(some):
                    contexts = [raw[a : b + length - 1] for a, b in zip(runs.begin[some].tolist(), runs.end[some].tolist())]
                    yield _pieces((runs.hash[some] % np.uint64(parts)).astype(np.int64), docs[rows[some]], tags[rows[some]], begin[some], end[some] - begin[some], contexts)
                for i in np.flatnonzero(state == BY_WINDOW).tolist():
                    for window in range(int(runs.begin[i]), int(runs.end[i])):
                        single.setdefault(raw[window : window + length], []).append((int(rows[i]), window + int(shift[i])))
            if single:
                yield _windows(single, docs, tags, parts, length)

    return told.mapInArrow(run, _PIECE_FIELDS)


def _states(rows: np.ndarray, numbers: np.ndarray, contexts: np.ndarray, known: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """The state of each run of a block, from what is known of the rows in it."""
    starts = np.full(int(rows[-1] - rows[0]) + 1, -1)
    heads = np.flatnonzero(np.diff(rows, prepend=rows[0] - 1))
    starts[rows[heads] - rows[0]] = heads
    ends = np.zeros(len(starts), np.int64)
    ends[rows[heads] - rows[0]] = np.append(heads[1:], len(rows))
    state = np.zeros(len(rows), np.int64)
    owners = owners - rows[0]
    inside = (owners >= 0) & (owners < len(starts))
    known, owners = known[inside], owners[inside]
    at = starts[owners] + (known >> 30) - numbers[starts[owners]]
    met = (starts[owners] >= 0) & (at >= starts[owners]) & (at < ends[owners])
    known, at = known[met], at[met]
    # A number that belongs to another text under this id has another context.
    met = _code(numbers[at], contexts[at], 0) == known & ~np.int64(3)
    state[at[met]] = known[met] & 3
    return state


def _pieces(part, docs, tags, begin, end, contexts: list) -> pa.RecordBatch:
    columns = [*(pa.array(x, pa.int64()) for x in (part, docs, tags, begin, end)), pa.array(contexts, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["part", "doc", "tag", "begin", "end", "context"])


def _windows(single: dict, docs: np.ndarray, tags: np.ndarray, parts: int, length: int) -> pa.RecordBatch:
    """One row for each string, of the smallest id that has it, to be sorted; spans of the others."""
    rows = []
    for string, owners in single.items():
        least = min(docs[row] for row, _ in owners)
        part = int.from_bytes(hashlib.blake2b(string, digest_size=8).digest(), "little") % parts
        for row, place in owners:
            if docs[row] > least:
                rows.append((docs[row] % parts, docs[row], tags[row], place, place + length, None))
            else:
                rows.append((part, docs[row], tags[row], place, 1, string))
    return _pieces(*zip(*rows))


def _sort_contexts(pieces: DataFrame, length: int) -> DataFrame:
    """(doc, tag, begin, end) of what is repeated, by sorting the windows of each part."""

    def run(group: pa.Table) -> pa.Table:
        ready = group.filter(pa.compute.is_null(group.column("context")))
        rest = group.filter(pa.compute.is_valid(group.column("context")))
        out = [ready.select(["doc", "tag", "begin", "end"])]
        if rest.num_rows:
            contexts = rest.column("context").to_pylist()
            doc, tag, begin, windows = (rest.column(n).to_numpy() for n in ("doc", "tag", "begin", "end"))
            text = np.frombuffer(b"".join(contexts), np.uint8)
            bounds = np.cumsum([0, *map(len, contexts)])[:-1]
            of = np.repeat(np.arange(len(doc)), windows)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
            order, first = deep_shallow_sort(text, bounds[of] + nth, length)
            heads = np.flatnonzero(first)
            least = np.minimum.reduceat(doc[of[order]], heads)
            least = np.repeat(least, np.diff(np.append(heads, len(order))))
            repeated = np.zeros(len(of), bool)
            repeated[order] = doc[of[order]] > least
            # Neighbouring windows of a context make one span.
            start = repeated & ~(np.append(False, repeated[:-1]) & (nth > 0))
            stop = repeated & ~(np.append(repeated[1:], False) & np.append(nth[1:] > 0, False))
            s, e = np.flatnonzero(start), np.flatnonzero(stop)
            places = begin[of[s]]
            out.append(pa.table({"doc": doc[of[s]], "tag": tag[of[s]], "begin": places + nth[s], "end": places + nth[e] + length}))
        return pa.concat_tables([t.cast(out[0].schema) for t in out])

    return pieces.groupBy("part").applyInArrow(run, "doc long, tag long, begin long, end long")


def merged(spans: list) -> list[tuple[int, int]]:
    """Sorted spans without overlaps; spans that touch are one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((begin, end))
    return out


def _keyed(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, doc, tag, text): the id, the id in place of null, a hash of the text, its bytes."""
    docs = pick(df, doc_id=doc_id, text=text).selectExpr("cast(doc_id as long) doc_id", "cast(cast(text as string) as binary) text")
    return docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc"), F.xxhash64("text").alias("tag"), "text")


def _parts(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(8, -(-size // GROUP_BYTES))


def repeated_spans(docs: DataFrame, texts: DataFrame, columns: list, parts: int, length: int) -> DataFrame:
    """(doc, spans array<struct<tag, begin, end>>): the bytes [begin, end) of each text that
    repeat strings of a smaller id. docs: rows as of `_keyed`; texts: the same rows dealt
    out by doc. columns: doc, tag and text of these, in terms of all their columns, whether
    needed or not: what is dealt out for the caller's join is the same then, and so is dealt out once."""
    if length < K:
        raise ValueError(f"strings of under {K} bytes have no anchors")
    told = _judge(_send_anchors(docs, parts, length))
    codes = told.groupBy("doc").agg(F.collect_list("code").alias("codes"))
    pieces = _send_contexts(texts.join(codes, "doc").select(*columns, "codes"), SORTS * parts, length)
    spans = _sort_contexts(pieces, length)
    return spans.groupBy("doc").agg(F.collect_list(F.struct("tag", "begin", "end")).alias("spans"))


_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _cut_out(tags: pa.Array, texts: pa.Array, spans: pa.Array) -> tuple[list[bytes], list[list[dict]]]:
    """What is left of each text without its spans, and those spans, joined."""
    rests, cuts = [], []
    for tag, raw, found in zip(tags.to_pylist(), texts.to_pylist(), spans.to_pylist()):
        raw = raw or b""
        removed = merged([(p["begin"], p["end"]) for p in found if p["tag"] == tag]) if found else []
        edges = [0, *(x for span in removed for x in span), len(raw)]
        rests.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
        cuts.append([{"begin": a, "end": b} for a, b in removed])
    return rests, cuts


def suffix_dedup(df: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, kept, spans) of every document: its bytes, what is left of
    them, and the spans that were removed.

    A null text counts as empty. A null id counts as larger than all others;
    equal ids are not smaller, so rows that repeat an id leave each other alone
    and share what smaller ids take. What is left need not be UTF-8, as spans are
    of bytes. Other columns are left out.
    """
    docs = _keyed(df, doc_id, text)
    parts = _parts(docs)
    texts = docs.repartition(parts, "doc")
    spans = repeated_spans(docs, texts, ["doc_id", "doc", "tag", "text"], parts, length)

    def run(batches):
        for batch in (b.slice(at, 1000) for b in batches for at in range(0, len(b), 1000)):
            rests, cuts = _cut_out(batch.column("tag"), batch.column("text"), batch.column("spans"))
            sizes = [len(raw or b"") for raw in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(rests, pa.binary()), pa.array(cuts, _SPANS)], ["doc_id", "n_bytes", "kept", "spans"]
            )

    joined = texts.join(spans, "doc", "left").select("doc_id", "tag", "text", "spans")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, kept binary, spans array<struct<begin: long, end: long>>")


def cut_repeats(df: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, with all their columns, and texts without what repeats a smaller id.

    A text whose bytes all repeat is empty then; its row stays. Bytes of a
    character of which others were removed go with them. A null text stays null.
    """
    docs = _keyed(df, doc_id, text)
    parts = _parts(docs)
    rows = numbered(df)
    own, raw = F.col(position(df, doc_id)).cast("long"), position(df, text)
    dealt = rows.withColumn("doc", F.coalesce(own, F.lit(LAST_ID))).repartition(parts, "doc")
    content = F.col(raw).cast("string").cast("binary")
    tag = F.xxhash64(content)
    # The number 1, by way of all columns, of whatever type.
    others = F.size(F.array_repeat(F.struct(*rows.columns), 1))
    spans = repeated_spans(docs, dealt, ["doc", tag.alias("tag"), content.alias("text"), others.alias("others")], parts, length)

    @F.arrow_udf("string")
    def rest(tags: pa.Array, texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([r.decode("utf-8", "ignore") for r in _cut_out(tags, texts, spans)[0]], pa.string())

    frame = dealt.join(spans, "doc", "left")
    left = F.when(content.isNotNull(), F.when(F.col("spans").isNull(), F.col(raw)).otherwise(rest(tag, content, "spans")))
    columns = [left.alias(c) if c == raw else F.col(c) for c in rows.columns]
    return frame.select(*columns).toDF(*df.columns)
