"""Near-duplicates by min-max hashing.

Each permutation of the shingles' hashes gives two values of a signature, its
minimum and its maximum. Bands of either kind make candidate pairs, which are
confirmed on the full sets of shingles; links make components.

Documents with equal sets are one class from the start. In a band's bucket the
classes are held against the bucket's first class, not against each other. Of
the pairs that this leaves open, those in one component need no more proof;
only members of one bucket in different components are compared, in blocks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowscribe.llm.common import Recent, checkpointed, held, mix, numbered, pick, position, rows_of

#: Permutations; each gives a minimum and a maximum.
PERMUTATIONS = 100
#: Values of a band. At a similarity of 0.8 all 40 bands miss one pair in seven million.
ROWS = 5
BANDS = 2 * PERMUTATIONS // ROWS
#: Sets of a block that are compared with those of another block in one task.
BLOCK = 1000
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80

_RANDOM = np.random.default_rng(20240229)
_FACTORS = (_RANDOM.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1))[:, None]
_TERMS = _RANDOM.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)[:, None]


def _words() -> Recent:
    return Recent(xxhash.xxh3_64_intdigest, 200_000)


def shingles(text: str | None, words: int) -> np.ndarray:
    """The sorted 64-bit hashes of a text's set of shingles of that many words.

    A-Z are lower-cased; fewer words make one shingle; without words the set is empty.
    """
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(held(_words).__getitem__, found), np.uint64, len(found))
    size = min(words, len(hashes))
    out = np.full(len(hashes) - size + 1, size, np.uint64)
    for i in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(out)])
    return np.unique(out)


def bands(hashes: np.ndarray) -> bytes:
    """The bands of a set as 64-bit keys, which differ between bands."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    most = np.zeros(PERMUTATIONS, np.uint32)
    for at in range(0, len(low), 4096):
        permuted = _FACTORS * low[at : at + 4096] + _TERMS
        np.minimum(least, permuted.min(axis=1), out=least)
        np.maximum(most, permuted.max(axis=1), out=most)
    values = np.concatenate([least, most]).reshape(BANDS, ROWS).astype(np.uint64)
    keys = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, i] + np.uint64(1))
    return keys.tobytes()


def _sign(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, node, check, bands): node and check name the set; null without words."""

    def run(batches):
        for keys, texts in rows_of(batches):
            counts, nodes, checks, signs = [], [], [], []
            known: dict[bytes, bytes] = {}  # many rows of a batch may be copies
            for text in texts:
                hashes = shingles(text, words)
                counts.append(len(hashes))
                if not len(hashes):
                    nodes.append(None), checks.append(None), signs.append(None)
                    continue
                name = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
                if name not in known:
                    known[name] = bands(hashes)
                nodes.append(int.from_bytes(name[:8], "little", signed=True))
                checks.append(int.from_bytes(name[8:], "little", signed=True))
                signs.append(known[name])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(nodes, pa.int64()), pa.array(checks, pa.int64()), pa.array(signs, pa.binary())],
                ["doc_id", "n_shingles", "node", "check", "bands"],
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, node long, check long, bands binary")


def _explode(classes: DataFrame) -> DataFrame:
    """(key, node) of every band of every class."""

    def run(batches):
        for batch in batches:
            nodes = batch.column(0).to_numpy(zero_copy_only=False)
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
            for at in range(0, len(nodes), 1000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[at * BANDS : (at + 1000) * BANDS]), pa.array(np.repeat(nodes[at : at + 1000], BANDS))], ["key", "node"]
                )

    return classes.select("node", "bands").mapInArrow(run, "key long, node long")


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar. Members meet their own sets first, so
    that what is dealt out by a much-named b is heavy, and Spark splits it."""

    def run(batches):
        for left, right, mine, other in rows_of(batches):
            similar = []
            for x, y in zip(mine, other):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True)) if 100 * min(len(x), len(y)) >= PERCENT * max(len(x), len(y)) else 0
                similar.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"]).filter(pa.array(similar, pa.bool_()))

    with_sets = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b"
    )
    return with_sets.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), with one root for each component.

    Each round sends every node to its smallest neighbour, or to itself if
    that is larger, and goes on with the links between those. As nodes are
    hashes, a round leaves a fraction of them. Rounds are checkpointed.
    """
    edges = checkpointed(links.where("a <> b").distinct())
    parents: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")))
        parents.append(parent)
        edges = (
            edges.join(parent.select(F.col("node").alias("a"), F.col("root").alias("x")), "a")
            .join(parent.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
            .where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        )
        edges = checkpointed(edges.distinct())
    if not parents:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = parents[-1]
    for parent in reversed(parents[:-1]):
        step = roots.select(F.col("node").alias("root"), F.col("root").alias("above"))
        roots = parent.join(step, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
    return checkpointed(roots)


def near_duplicates(df: DataFrame, words: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    component_id is the smallest doc_id that links reach, kept whether it is
    the document's own. A null, empty or blank text has no shingles, is linked
    with nothing and kept. A null id is never the smallest where there is another;
    where there is none component_id is null and the document kept. Rows
    that repeat an id and a text share its result. Other columns are left out.
    """
    docs = pick(df, doc_id=doc_id, text=text).selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    signed = checkpointed(_sign(docs, words))
    classes = signed.where("node is not null").groupBy("node", "check", "bands").agg(F.min("doc_id").alias("first"))
    classes = checkpointed(classes)
    roots = _link(docs, classes, words)

    # The smallest id of each class and of each component.
    labelled = classes.select("node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    named = labelled.select("node", "root").join(least, "root").select("node", "component_id")
    linked = signed.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return linked.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def _link(docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """(node, root) of the classes that have links."""
    spread = _explode(classes)
    shared = spread.groupBy("key").agg(F.min("node").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Buckets of one class, nearly all, end here.
    members = checkpointed(spread.join(shared, "key"))
    open_pairs = checkpointed(members.where("node <> b").select(F.col("node").alias("a"), "b").distinct())
    wanted = classes.select("node", "first").join(members.select("node").distinct(), "node")
    sets = checkpointed(_sets(docs, wanted, words))

    # First each class against one head, so that the members of a group send their
    # sets about once; then what is still open between components.
    best = open_pairs.groupBy("a").agg(F.min("b").alias("b"))
    links = checkpointed(_confirm(best, sets))
    rest = checkpointed(_across(open_pairs, components(links)))
    links = checkpointed(links.unionByName(_confirm(rest, sets)))
    roots = components(links)

    return components(links.unionByName(_compare(members.select("key", "node"), roots, sets)))


def _compare(members: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """The links (a, b) between members of one bucket that are in different components.

    In such a bucket the largest component is the main one and the others'
    members are strays. For each main component its strays are compared with
    all members of its buckets, in blocks: a set is sent once for each block of
    the other side, not once for each pair.
    """
    rooted = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    by_root = rooted.groupBy("key", "root").agg(F.count("*").alias("n"))
    main = by_root.groupBy("key").agg(F.max(F.struct("n", "root"))["root"].alias("main"), F.count("*").alias("k")).where("k > 1").drop("k")
    placed = checkpointed(rooted.join(main, "key").select("main", "node", "root").distinct())
    sizes = placed.groupBy("main").agg(
        F.ceil(F.sum((F.col("root") != F.col("main")).cast("long")) / BLOCK).alias("across"), F.ceil(F.count("*") / BLOCK).alias("down")
    )
    rows = placed.join(sizes, "main").join(sets, "node")
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1))
    columns = ["main", "i", "j", "node", "root", "hashes"]
    strays = rows.where("root <> main").withColumn("i", block("across")).withColumn("j", every("down")).select(columns)
    others = rows.withColumn("j", block("down")).withColumn("i", every("across")).select(columns).toDF(*columns)
    by = ["main", "i", "j"]
    return strays.groupBy(by).cogroup(others.groupBy(by)).applyInArrow(_similar_across, "a long, b long")


def _similar_across(strays: pa.Table, others: pa.Table) -> pa.Table:
    """The similar pairs (a, b) of a stray and one of the others in another component."""
    a, b = [], []
    if strays.num_rows and others.num_rows:
        own = [np.frombuffer(h, np.uint64) for h in others.column("hashes").to_pylist()]
        sizes = np.array([len(h) for h in own])
        hashes, owner = np.concatenate(own), np.repeat(np.arange(len(own)), sizes)
        nodes, roots = (others.column(n).to_numpy() for n in ("node", "root"))
        for node, root, raw in zip(*(strays.column(n).to_pylist() for n in ("node", "root", "hashes"))):
            mine = np.frombuffer(raw, np.uint64)
            at = np.minimum(np.searchsorted(mine, hashes), len(mine) - 1)
            both = np.bincount(owner[mine[at] == hashes], minlength=len(own))
            found = np.flatnonzero((100 * both >= PERCENT * (sizes + len(mine) - both)) & (roots != root))
            a += [node] * len(found)
            b += nodes[found].tolist()
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) of different components."""
    for side in ("a", "b"):
        pairs = pairs.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
    different = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    return pairs.where(different).select("a", "b")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, hashes): the full sets of the wanted (node, first), made again from the
    texts with those ids."""

    def run(batches):
        for texts, nodes in rows_of(batches):
            hashes = [shingles(text, words).tobytes() for text in texts]
            own = [int.from_bytes(hashlib.blake2b(h, digest_size=16).digest()[:8], "little", signed=True) == n for h, n in zip(hashes, nodes)]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(hashes, pa.binary())], ["node", "hashes"]).filter(pa.array(own, pa.bool_()))

    named = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("first")))
    return named.select("text", "node").mapInArrow(run, "node long, hashes binary").dropDuplicates(["node"])


def keep_first(df: DataFrame, words: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, with all their columns, of which near_duplicates keeps the document."""
    kept = near_duplicates(df, words, doc_id, text).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    frame = numbered(df)
    return frame.join(kept, F.col(position(df, doc_id)).cast("long").eqNullSafe(F.col("kept_id")), "left_semi").toDF(*df.columns)
