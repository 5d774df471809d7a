"""The queries of the operators, against their SQL or against plain Python."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from compare import connect, duck_result, spark_result
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from rowscribe.llm.oracle import ORACLE
from rowscribe.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert ORACLE.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    with connect(SMALL) as con:
        assert spark_result(QUERIES[name](spark, SMALL)) == duck_result(con, ORACLE[name])


def test_bpe_equals_the_library(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for row in QUERIES["op2_bpe"](spark, SMALL).collect():
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def packed_right(rows, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        of_doc[row["doc_id"]].append(row)
        of_sequence[row["sequence_id"]].append(row)
    assert set(of_doc) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for row in sorted(of_doc[doc_id], key=lambda r: r["start"]):
            assert (row["start"], row["doc_tokens"]) == (at, len(ids))
            assert row["ids_crc32"] == zlib.crc32(ids[at : at + row["length"]].tobytes())
            at += row["length"]
        assert at == len(ids)
    padding = 0
    for rows in of_sequence.values():
        at = 0
        for row in sorted(rows, key=lambda r: r["offset"]):
            assert row["offset"] == at
            at += row["length"]
        assert at <= 4096
        padding += 4096 - at if at & (at - 1) else 0
    return padding


def test_packing(spark, texts):
    rows = QUERIES["op3_packing"](spark, SMALL).collect()
    assert packed_right(rows, texts) <= 4096


def test_held_out_accuracy(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    languages = QUERIES["op5_language"](spark, "/root/testdata/sf0.01").join(documents, "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in languages) >= 0.97 * len(languages)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = QUERIES["op10_quality_model"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in scored) >= 0.9 * len(scored)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in scored)


def test_urls(spark):
    rows = {r["page_id"]: r for r in QUERIES["op6_url_filter"](spark, SMALL).collect()}
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()
    assert set(rows) == {p["page_id"] for p in pages}
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    for page in pages:
        rest = page["url"].partition("://")[2]
        host = rest.split("#")[0].split("?")[0].split("/")[0]
        path = rest[len(host) :].split("#")[0].split("?")[0]
        host = host.lower()
        fits = [r for r in rules if ("." + host).endswith("." + r.partition("/")[0]) and path.startswith("/" + r.partition("/")[2])]
        row = rows[page["page_id"]]
        assert (row["host"], row["path"], row["rule"]) == (host, path, max(fits, key=len, default=None))
        assert row["verdict"] == rules[row["rule"]] if row["rule"] else row["verdict"] in ("allow", "block")


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").cache()
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SMALL)
        assert after.columns == docs.columns, name
        assert 0 < after.count() <= before.count(), name
        before = after.cache()
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    assert packed_right(corpus_pipeline.STAGES[-1][1](spark, before, SMALL).collect(), texts) <= 4096
