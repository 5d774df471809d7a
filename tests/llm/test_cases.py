"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from rowscribe.llm import bpe, common, language, near_dedup, packing, quality_model, quality_rules, suffix_dedup, token_counts, top_k, url_filter
from rowscribe.llm.common import SEGMENT
from rowscribe.llm.queries import URL_RULES
from rowscribe.llm.suffix_sort import deep_shallow_sort

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SENTENCE = "the quick brown fox jumps over the lazy dog and runs far away from all the noise of the town"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(90_000))  # over a megabyte
CASES = [
    (1, SENTENCE), (2, SENTENCE), (3, None), (4, ""), (5, "  \n\t "), (6, LONG), (7, "start " + LONG[: 600_000]),
    (None, SENTENCE), (None, None), (8, "né à\u2003Zürich ### 42"), (2, SENTENCE), (9, "x" * 3000), (10, "short"),
]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(CASES, "doc_id long, text string")
    return frame.selectExpr("doc_id", "text", "'clash' as TEXT", "doc_id as DOC_ID", "'de' as lang", "1 as node", "2 as part")


def runs(docs):
    return {
        "op1": suffix_dedup.suffix_dedup(docs),
        "op2": bpe.round_trip(docs, BYTES),
        "op3": packing.pack(docs, WORDS),
        "op4": token_counts.token_counts(docs, RANKS, public_tokenizers.PATTERN),
        "op5": language.predict_languages(docs, language.fit(docs)),
        "op8": quality_rules.quality_rules(docs),
        "op9": near_dedup.near_duplicates(docs, 2),
        "op10": quality_model.score_quality(docs, quality_model.fit(docs, docs.sparkSession.createDataFrame([(i, 1) for i in range(9)], "doc_id long, quality int"))),
    }


def test_cases(docs):
    found = {name: df.collect() for name, df in runs(docs).items()}
    for name in ("op1", "op2", "op5", "op8", "op9", "op10"):
        assert len(found[name]) == len(CASES), name
    cut = {r["doc_id"]: r for r in found["op1"] if r["doc_id"]}
    assert cut[1]["kept"].decode() == SENTENCE and cut[2]["kept"] == b"" and cut[3]["n_bytes"] == 0
    assert [r["kept"] for r in found["op1"] if r["doc_id"] is None and r["n_bytes"]] == [b""]
    assert cut[6]["kept"].decode() == LONG and cut[7]["kept"] == b"start "
    # Inside one document nothing repeats a smaller id.
    assert cut[9]["kept"] == b"x" * 3000
    near = {r["doc_id"]: r for r in found["op9"]}
    assert near[1]["kept"] and not near[2]["kept"] and near[2]["component_id"] == 1
    assert near[4]["kept"] and near[4]["n_shingles"] == 0 and near[10]["n_shingles"] == 1
    assert {r["lang_pred"] for r in found["op5"] if r["doc_id"] in (3, 4, 5)} == {"und"}
    assert all(r["base_failed"] and not r["kept"] for r in found["op8"] if r["doc_id"] in (3, 4, 5, 10))
    assert {r["score"] for r in found["op10"]} == {0.5}
    assert sum(r["length"] for r in found["op3"] if r["doc_id"] == 4) == 1


def test_empty_tables(docs):
    for name, df in runs(docs.limit(0)).items():
        assert df.collect() == [], name


def test_stages_keep_columns(docs):
    for stage in (quality_rules.keep_good, near_dedup.keep_first, suffix_dedup.cut_repeats):
        out = stage(docs)
        assert out.columns == docs.columns and out.count() <= len(CASES)
    assert language.keep_languages(docs, None) is docs


def test_urls(spark):
    urls = [None, "", "no scheme", "HTTP://A.NET", "http://A.b.NET/x", "x://example.NET/en/?q", "x://net/?a://b", "x://y.org/fr/#/", "x://[::1]:80/p"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "1 as URL")
    got = {r["page_id"]: r for r in url_filter.filter_urls(pages, URL_RULES).collect()}
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"]) for i in range(len(urls))] == [
        ("", "", None), ("", "", None), ("", "", None), ("a.net", "", None), ("a.b.net", "/x", "net/"),
        ("example.net", "/en/", "example.net/en/"), ("net", "/", "net/"), ("y.org", "/fr/", "org/fr/"), ("[::1]:80", "/p", None),
    ]
    assert url_filter.filter_urls(pages.limit(0), URL_RULES).collect() == []


@pytest.mark.parametrize("sizes", [{}, {"BLOCK": 16, "QUERY_BLOCK": 2, "PROBE": 20}])
def test_top_k_by_brute_force(spark, monkeypatch, sizes):
    for name, size in sizes.items():
        monkeypatch.setattr(top_k, name, size)
    random = np.random.default_rng(0)
    rows = [(i, (random.normal(size=8) * 10 ** random.integers(0, 3)).tolist()) for i in range(300)]
    rows += [(300, [0.5] * 8), (301, [0.5] * 8), (302, [0.5] * 8), (50, rows[50][1]), (303, None), (304, [None] + [1.0] * 7)]
    rows += [(305, [float("nan")] * 8), (None, [1.0] * 8), (350, [1.0, 2.0]), (351, [2.0, 2.0]), (400, []), (450, [1e300] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as VEC_ID")
    got = [tuple(r) for r in top_k.top_k(frame).orderBy("query_id", "rank").collect()]
    whole, seen = {}, 2**63 - 1
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole[i] = [max(-seen - 1, min(seen, int(np.floor(256 * x)))) for x in v]
    want = []
    for q in sorted(i for i in whole if i % 50 == 0):
        products = {i: sum(a * b for a, b in zip(whole[q], v)) for i, v in whole.items() if i != q and len(v) == len(whole[q])}
        scored = sorted((-max(-seen - 1, min(seen, p)), i) for i, p in products.items())
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])]
    assert got == want
    assert top_k.top_k(frame.limit(0)).collect() == []


@pytest.mark.parametrize("by_coordinates", [0.0, 0.5, 2.0])
def test_pruning_loses_nothing(monkeypatch, by_coordinates):
    monkeypatch.setattr(top_k, "BY_COORDINATES", by_coordinates)
    random = np.random.default_rng(2)
    c = random.integers(-300, 300, (500, 12)) * random.integers(1, 9, (500, 1))
    q, ids, own = random.integers(-300, 300, (40, 12)), random.permutation(500), np.arange(40)
    products = q @ c.T
    want = [sorted((-int(products[i, j]), int(ids[j])) for j in range(500) if ids[j] != own[i])[:5] for i in range(40)]
    for least in (np.full(40, -np.inf), np.array([-float(w[-1][0]) for w in want]), np.array([-w[-1][0] * 0.4 for w in want])):
        rows, found, scores = top_k.best_of(q, c, own, ids, least, 5)
        got = [[(-s, j) for i, j, s in zip(rows, found, scores) if i == row] for row in range(40)]
        assert got == want


@pytest.mark.parametrize("length", [5, 16, 24, 33, 50])
def test_suffix_sort(length):
    random = np.random.default_rng(length)
    for text in (random.integers(97, 99, 800), np.tile(random.integers(97, 100, 90), 9), np.full(300, 120)):
        text = text.astype(np.uint8)
        raw, starts = text.tobytes(), np.arange(len(text) - length + 1)
        order, first = deep_shallow_sort(text, starts, length)
        strings = [raw[i : i + length] for i in order]
        assert order.tolist() == sorted(starts, key=lambda i: raw[i : i + length])
        assert first.tolist() == [i == 0 or strings[i] != strings[i - 1] for i in range(len(strings))]


def test_windows_dealt_by_themselves(spark, monkeypatch):
    shared = "a passage of well over fifty bytes that many of the documents share among them"
    rows = [(i, f"{i * 7919 % 1000:04d} own words {i} {shared} other words {i * 31}") for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    usual = sorted(map(tuple, suffix_dedup.suffix_dedup(frame).select("doc_id", "kept").collect()))
    pieces = suffix_dedup._keyed(frame, "doc_id", "text")
    monkeypatch.setattr(suffix_dedup, "MANY_CONTEXTS", 0)
    assert pieces.count() == 40
    assert sorted(map(tuple, suffix_dedup.suffix_dedup(frame).select("doc_id", "kept").collect())) == usual
    assert all(shared[5:-5].encode() not in kept for doc, kept in usual if doc)


@pytest.mark.parametrize("partitions", [4, 8, 40])
def test_texts_are_dealt_out_once(spark, partitions):
    shared = "a passage of well over fifty bytes that many of the documents share among them"
    rows = [(i, f"{i * 7919 % 1000:04d} own words {i} {shared} other words {i * 31}") for i in range(40)]
    frame = spark.createDataFrame([*rows, (None, rows[3][1]), (50, None), (3, "short")], "doc_id long, text string")
    # Columns of a type without order, without nulls, and with names in use.
    frame = frame.selectExpr("map('a', doc_id) as m", "coalesce(doc_id, 7) as doc", "text", "doc_id", "text as tag", "'x' as others")
    whole = {(r["doc_id"], r["text"]): r["text"] for r in frame.collect()}
    kept = {(r["doc_id"], r["n_bytes"]): r["kept"].decode() for r in suffix_dedup.suffix_dedup(frame).collect()}
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        cut = suffix_dedup.cut_repeats(frame)
        assert cut.columns == frame.columns
        found = {(r["doc_id"], r["tag"]): r for r in cut.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert set(found) == set(whole)
    for (doc, text), row in found.items():
        assert row["text"] == (None if text is None else kept[doc, len(text)])
        assert (row["m"], row["doc"], row["others"]) == ({"a": doc}, 7 if doc is None else doc, "x")
    plan = cut._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in plan and plan.count("ReusedExchange") == 1


def test_encoders_on_odd_texts():
    library, words = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
    codec, encoder = bpe.codec(BYTES), packing.encoder(WORDS)
    texts = ["", " ", "   a  b\n\n c ", "it's we'LL ' s", "<|endoftext|>x<|endoftext|>", "a\xa0\xa0 b\u2003\n c", "é\u0301 ﬁ İ ΣΑΣ", "12 345,6.", "日本語 text", "\x1ca \x85 b", "🙂🙂 ok", "A.B,C. d.,", "Éa. ÀÉÎ ñandú, große ÜBER. K Å ẞ ª µ ÿ."]
    for text in texts + ["".join(t) for t in zip(*texts[2:])]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids, text
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)
        want = words.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want, text
    assert "".join(SEGMENT.findall(texts[2])) == texts[2]
    assert regex.findall(bpe.PATTERN, texts[2]) == [p for s in SEGMENT.findall(texts[2]) for p in regex.findall(bpe.PATTERN, s)]


def test_plain_words_after_white_space_are_pieces():
    encoder = packing.Encoder(WORDS)
    text = "one two,\nThree... \x1cfour\x1d five$$$"
    want = Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want
    assert set(encoder.pieces) == {"one", "two", ",", "three", "...", "five", "$$$"}


def test_workers_hold_the_tables_of_one_operator():
    encoder = weakref.ref(packing.encoder(WORDS))
    assert packing.encoder(WORDS) is encoder()
    near_dedup.shingles("a b", 2)
    assert encoder() is None
    codec = weakref.ref(bpe.codec(BYTES))
    common.release()
    assert codec() is None


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts_add_up(rule):
    text = "one\n\n\n two é日\n\n"
    starts, ends = token_counts.spans(text, RANKS, public_tokenizers.PATTERN)
    bounds = token_counts.lines(text)
    counts, crossing = token_counts.attribute(starts, ends, bounds, rule)
    assert np.isclose(counts.sum(), len(starts)) and crossing.sum() > 0
    assert bounds.tolist() == [0, 4, 5, 6, 14, 15]


def test_near_duplicates_by_brute_force(spark):
    random = np.random.default_rng(1)
    base = [[f"w{x}" for x in random.integers(0, 500, 60)] for _ in range(6)]
    rows = []
    for i in range(150):
        words = list(base[i % 6])
        for at in random.integers(0, 60, i % 9):
            words[at] = f"new{random.integers(0, 9)}"
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: {tuple(t.split()[k : k + 2]) for k in range(59)} for i, t in rows}
    root = dict.fromkeys(sets)
    for i in sets:
        root[i] = i
    for i in sets:
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = {k: low if v == high else v for k, v in root.items()}
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame, 2).collect()}
    assert got == root


def test_encode_and_decode(spark, docs):
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect() if r["doc_id"]}
    encoded = bpe.encode(docs, BYTES)
    back = {r["doc_id"]: r["text"] for r in bpe.decode(encoded, BYTES).collect() if r["doc_id"]}
    assert back == texts
    odd = spark.createDataFrame([(1, [10**6, 72, None, -5]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert [r["text"] for r in bpe.decode(odd, BYTES).collect()] == [bpe.codec(BYTES).decode([72]), "", ""]


@pytest.mark.parametrize("blank", [" ", "\n", " "])
def test_token_counts_of_long_white_space(blank):
    n = 1_200_000
    text = "one two" + blank * n + "three"
    starts, ends = token_counts.spans(text, RANKS, public_tokenizers.PATTERN)
    assert starts[0] == 0 and ends[-1] == len(text) and ends.max() == len(text)
    short = "one two" + blank * 1000 + "three"
    usual = token_counts.token_ids(short, RANKS, public_tokenizers.PATTERN)
    code = token_counts.encoder(RANKS, public_tokenizers.PATTERN)[0]
    pieces = regex.findall(public_tokenizers.PATTERN, short)
    assert usual.tolist() == [i for p in pieces for i in code._encode_single_piece(p)]
    counts, _ = token_counts.attribute(starts, ends, np.array([0, 7, 7 + n, len(text)]), "majority")
    assert counts.sum() == len(starts)


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts_by_brute_force(rule):
    text = "ab  cd\n\n\n  é日 x\r\n  \n, end\n" * 3
    starts, ends = token_counts.spans(text, RANKS, public_tokenizers.PATTERN)
    bounds = token_counts.lines(text)
    line_of = [sum(b <= i for b in bounds[1:]) for i in range(len(text))]
    want, across = np.zeros(len(bounds) - 1), np.zeros(len(bounds) - 1)
    for a, b in zip(starts.tolist(), ends.tolist()):
        own = [line_of[i] for i in range(a, b)]
        shares = {line: own.count(line) / len(own) for line in sorted(set(own))}
        if len(shares) > 1:
            for line in shares:
                across[line] += 1
        if rule == "split":
            for line, share in shares.items():
                want[line] += share
        else:
            want[{"first": own[0], "last": own[-1], "majority": max(shares, key=lambda line: (shares[line], -line))}[rule]] += 1
    counts, crossing = token_counts.attribute(starts, ends, bounds, rule)
    assert np.allclose(counts, want) and crossing.tolist() == across.tolist() and across.any()


def test_quality_model_with_both_labels(spark, docs):
    good = "a well made sentence with many different words about rivers and mountains"
    bad = "### $$$ %%% buy buy buy &&& cheap *** now now now"
    rows = [(100 + i, f"{good} {i}" if i % 2 else f"{bad} {i}") for i in range(200)]
    extra = spark.createDataFrame(rows + rows[:20], "doc_id long, text string").selectExpr("doc_id", "text", "'clash' as TEXT", "doc_id as DOC_ID", "'de' as lang", "1 as node", "2 as part")
    every = docs.union(extra)
    labels = spark.createDataFrame([(i, (i % 2)) for i in range(1, 300)] + [(100, 1), (None, 1), (5, None)], "doc_id long, quality int").selectExpr("*", "3 as QUALITY")
    model = quality_model.fit(every, labels)
    scored = quality_model.score_quality(every, model).collect()
    assert len(scored) == len(CASES) + 220 and all(0 <= r["score"] <= 1 for r in scored)
    empty = {r["score"] for r in scored if r["doc_id"] in (3, 4)}
    assert len(empty) == 1
    of = {r["doc_id"]: r["score"] for r in scored}
    assert min(of[100 + i] for i in range(1, 200, 2)) > max(of[100 + i] for i in range(2, 200, 2))


def test_log_ratios_and_margins_by_brute_force(spark):
    rows = [(i, f"word{i % 7} common {'good' if i % 3 else 'bad'} x{i % 5}") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i, _ in rows], "doc_id long, quality int")
    model = quality_model.fit(frame, labels)
    counts = np.zeros((2, quality_model.FEATURES))
    for i, text in rows:
        if zlib.crc32(str(i).encode()) % 5:
            counts[int(i % 3 > 0)][quality_model.features(text)] += 1
    smooth = counts + 1
    want = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())
    assert np.allclose(model.ratio, want)
    for _, text in rows[:10]:
        slots = quality_model.features(text)
        scaled = want[slots] / np.linalg.norm(want[slots])
        margin = sum(model.weights[s] * x for s, x in zip(slots, scaled)) + model.bias
        assert np.isclose(model.score(text), 1 / (1 + np.exp(-(model.slope * margin + model.offset))))


def test_bpe_finds_the_segments_of_a_text_once(monkeypatch):
    codec, library = bpe.Codec(BYTES), Tokenizer.from_file(BYTES)
    texts = [" one two, two\nthree", None, "", "<|endoftext|> one<|endoftext|>", "é日 \x1cß's", " " * 5 + "x" * 200]
    splits, find, merged = [], codec.parts, []
    monkeypatch.setattr(codec, "parts", lambda text: splits.append(text) or find(text))
    monkeypatch.setattr(codec, "_piece", lambda piece: merged.append(piece))
    for text, (n, ids_digest, decoded) in zip(texts, codec.digests(texts), strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert (n, ids_digest) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert decoded == hashlib.sha256((text or "").encode()).hexdigest()
    assert splits == [t or "" for t in texts] and not merged
