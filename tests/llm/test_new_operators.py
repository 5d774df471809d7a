"""Periodic runs, personal data and the source audit against plain Python."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from hashlib import sha256
from itertools import pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rowscribe.llm import periodic_runs, pii, source_audit
from rowscribe.llm.queries import QUERIES
from rowscribe.sources import scratch

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def clashing(spark, rows, schema):
    """The rows, with columns whose names differ in case or are those that the operators use."""
    return spark.createDataFrame(rows, schema).selectExpr("*", "'clash' as TEXT", "1 as Doc_Id", "2 as n", "3 as runs", "4 as spans", "5 as term", "6 as at")


# --- Periodic runs -----------------------------------------------------------


def plain_runs(words, length=6, periods=4):
    """Every run, by comparing the words at every lag."""
    found = {}
    for lag in range(1, len(words) // periods + 1):
        i = 0
        while i + lag < len(words):
            start = i
            while i + lag < len(words) and words[i] == words[i + lag]:
                i += 1
            size = i - start + lag
            if i > start and size >= max(length, periods * lag):
                found.setdefault((start, size), lag)
            i += i == start
    return sorted((start, size, lag) for (start, size), lag in found.items())


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for start, size, lag in runs for i in range(start + lag, start + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{z},{q}\n" for s, z, q in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, sha256(lines.encode()).hexdigest(), sha256(kept.encode()).hexdigest())


def test_runs_by_brute_force():
    draw = random.Random(1)
    for _ in range(400):
        words = []
        for _ in range(draw.randint(0, 6)):
            root = [draw.randint(0, draw.choice([1, 2, 5])) for _ in range(draw.randint(1, 12))]
            whole = root * draw.randint(1, 8)
            words += whole[: len(whole) - draw.randint(0, len(root) - 1)] + [draw.randint(0, 2) for _ in range(draw.choice([0, 3]))]
        numbers = np.array(words, np.int64)
        for length, periods in ((6, 4), (20, 4), (1, 3), (9, 5)):
            assert periodic_runs.find_runs(numbers, len(words), length, periods) == plain_runs(words, length, periods)


def test_seeds_are_as_long_as_the_lag():
    for length, periods in ((6, 4), (30, 4), (1, 3)):
        spans = list(periodic_runs.classes(5000, length, periods))
        assert all(size >= high - 1 and size == min(periodic_runs.overlap(q, length, periods) for q in range(low, high)) for low, high, size in spans)
        assert all(a[1] == b[0] for a, b in pairwise(spans))
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(None, periods=2)


def test_run_query(spark, tmp_path):
    long = " ".join(f"w{i % 5000}" for i in range(40_000))
    rows = [
        (1, "a a a a a a b"), (2, "a a a a a"), (3, None), (4, ""), (5, " \t\n"), (6, long), (None, "x y " * 9), (None, None),
        (2, "x y z " * 5), (7, "a b a b a b a b c c c c c c a b a b a b a b"), (8, "p\x0bq\x0cr\x1cs p\rq r\x1cs " * 7), (9, "one two"),
    ]
    rows += [(i, " ".join(random.Random(i).choices("abc", k=i % 90))) for i in range(100, 400)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((plain_row(*row) for row in rows), key=repr)
    frame = clashing(spark, rows[:9], "doc_id long, text string")
    found = {r["doc_id"]: r for r in periodic_runs.periodic_runs(frame).collect()}
    assert found[1]["kept"] == "a b" and found[6]["runs"][0]["period"] == 5000 and len(found[6]["kept"].split()) == 5000
    assert periodic_runs.periodic_runs(frame.limit(0)).collect() == []


# --- Personal data -----------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return [int(c) for c in text if c in "0123456789"]


def luhn(text):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits(text)[::-1])) % 10 == 0


def plain_base(text):
    checks = (
        ("email", EMAIL, lambda m: True),
        ("ip", IP, lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", CARD, lambda m: 16 <= len(digits(m)) <= 19 and luhn(m)),
        ("phone", PHONE, lambda m: 8 <= len(digits(m)) <= 15),
    )
    return [(kind, m.start(), m.end()) for kind, found, good in checks for m in found.finditer(text) if good(m[0])]


def base_of(text):
    return [(pii.KINDS[k], a, b) for k, a, b, base in pii.find(text) if base]


def test_base_spans_by_brute_force():
    draw = random.Random(2)
    parts = ["@", ".", "a", "b-", "_", "+", "1", "23", "4.5", "255.", "256", "0001", " ", "-", "(", ")", "é", "日", "4465758382889437", "+1 (743) 555-3824", "x@y.z", "::", "card 4", "\n", "12:30"]
    for _ in range(6000):
        text = "".join(draw.choices(parts, k=draw.randint(0, 25)))
        assert base_of(text) == plain_base(text), text
    for text in ("1.2.3.4.5.6.7.8", "1.2.3.4 .5", "a@b.c@d.e", "a@b.c_d@e.f", "@.@", "++1 2", "+1" + "-" * 50 + "2", "0" * 400 + "1.1.1.1", "9" * 5000):
        assert base_of(text) == plain_base(text), text


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("josé@example.com", [("email", 0, 16)]),
        ("write to ann.lee (at) example (dot) org now", [("email", 9, 39)]),
        ("see fe80::1ff:fe23:4567:890a there", [("ip", 4, 28)]),
        ("std::vector Bad::Face 12:30:45", []),
        ("4465758382889437 4465758382889437", [("card", 0, 16), ("card", 17, 33)]),
        ("tel:030-1234567 x", [("phone", 4, 15)]),
        ("IBAN DE89 3704 0044 0532 0130 00.", [("account", 5, 32)]),
        ("DE89 3704 0044 0532 0130 01", []),
        ("ssn 078-05-1120", [("account", 4, 15)]),
        ("666-05-1120 and 000-12-3456", []),
        ('token = "24be64439e3e49cf46b2d7c90f3602a3"', [("secret", 9, 41)]),
        ("the token is password = welcome", []),
        ("http://bob:pa55word@example.com/x", [("email", 11, 31), ("secret", 7, 19)]),
        ("chapter 3, verse 16. 1999-2001; 3.14 is pi + 1", []),
    ],
)
def test_spans_beyond_the_base(text, want):
    assert [(pii.KINDS[k], a, b) for k, a, b, _ in pii.find(text)] == want


def test_pii_query(spark, tmp_path):
    long = "é name.19@mail5.example.com +1 (743) 555-3824 at 8.196.197.208, " * 20_000
    rows = [(1, "a@b.cd 1.2.3.4"), (1, "a@b.cd 1.2.3.4"), (2, None), (3, ""), (None, "日 x@y.zz"), (4, long), (5, "1" * 300_000 + "@" * 1000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], r["spans"]): r for r in QUERIES["op12_pii"](spark, str(tmp_path)).collect()}
    for doc_id, text in rows:
        base = plain_base(text or "")
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        row = got[doc_id, listed]
        assert row["base_sha256"] == sha256(listed.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in base) for k in ("email", "ip", "card", "phone")]
    frame = clashing(spark, rows[:5], "doc_id long, text string")
    assert pii.find_pii(frame).count() == 5 and pii.find_pii(frame.limit(0)).collect() == []
    clean = pii.redact(frame)
    assert clean.columns == frame.columns
    assert [r[1] for r in clean.collect()] == ["<email> <ip>", "<email> <ip>", None, "", "日 <email>"]


def test_pii_on_the_tables(spark):
    texts = dict(map(tuple, spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()))
    for row in QUERIES["op12_pii"](spark, SMALL).collect():
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in plain_base(texts[row["doc_id"]]))
        assert row["base_sha256"] == sha256(listed.encode()).hexdigest()


# --- Source audit --------------------------------------------------------------


def plain_audit(rows, documents, listed):
    """Rows (text, lang, source) to the audit, by plain counts of every term of every source."""
    rows = [tuple(x or "" for x in row) for row in rows]
    counts, seen = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate({i: i + 32 for i in range(65, 91)}))
        counts[lang, source].update(terms)
        counts[lang].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang, source in {(r[1], r[2]) for r in rows}:
        kept = [t for t, n in seen[lang].items() if n >= documents]

        def prices(key, kept=kept):
            total = sum(counts[key][t] for t in kept)
            return {t: 1 + 10**9 * (counts[key][t] + 5) // (total + 5 * len(kept)) for t in kept}

        own, of_lang = prices((lang, source)), prices(lang)
        pairs = []
        for other in {r[2] for r in rows if r[1] == lang} - {source}:
            theirs = prices((lang, other))
            pairs.append((-sum(abs(own[t] - theirs[t]) for t in kept), other.encode()))
        terms = [(of_lang[t] - own[t], t.encode()) for t in kept if counts[lang, source][t] and own[t] > of_lang[t]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:listed])):
            out += [(lang, source, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(items)]
    return sorted(out)


def audit_rows():
    draw = random.Random(4)
    words = ["The", "the", "of", "née", "日本", "x1y", "Ünder", "É", "a", "b", "it's", *(f"w{c}" for c in "abcdefghijklmnopqrst")]
    rows = []
    for i in range(500):
        lang = draw.choice(["en", "en", "de", None, "", "rare"] if i % 50 else ["one"])
        source = "hot" if draw.random() < 0.4 else draw.choice([None, "", *(f"s{n}" for n in range(9)), "ß", "Z"])
        rows.append((" ".join(draw.choices(words[: draw.randint(1, len(words))], k=draw.randint(0, 40))), lang, source))
    return rows + [(None, "en", "s1"), ("", "xx", "s1"), ("", "xx", "s2"), (None, None, None), ("the " * 30_000, "en", "s3"), rows[0], rows[0]]


@pytest.mark.parametrize(("tile", "block"), [(128, 4096), (4, 7)])
def test_audit_by_brute_force(spark, tile, block):
    rows = audit_rows()
    frame = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 as TERM", "2 as at", "3 as Lang", "4 as n", "5 as tile")
    got = source_audit.audit(frame, documents=9, listed=12, tile=tile, block=block)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, 9, 12)


def test_audit_of_a_source_without_terms(spark):
    rows = [("one two", "en", "a"), ("1 2 -", "en", "b"), ("two", "en", "c"), (None, "de", "a")]
    frame = spark.createDataFrame(rows, "text string, lang string, source string").coalesce(1)
    got = source_audit.audit(frame, documents=1, listed=2)
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, 1, 2)
    assert source_audit.audit(frame.where("source = 'b'"), documents=1).collect() == []


def test_audit_of_nothing(spark):
    frame = spark.createDataFrame([], "text string, lang string, source string")
    assert source_audit.audit(frame).collect() == []


def test_audit_writes_kept_terms_only(spark, tmp_path, monkeypatch):
    rows = [(f"common {'rare' + chr(97 + i // 26) + chr(97 + i % 26)}", "en", f"s{i % 3}") for i in range(200)]
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    monkeypatch.setattr(scratch, "scratch_root", lambda spark: str(tmp_path))
    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    try:
        got = sorted(map(tuple, source_audit.audit(frame).collect()))
    finally:
        spark.sparkContext.setCheckpointDir(before or str(tmp_path))
    assert got == plain_audit(rows, 30, 50)
    written = [path.read_bytes() for path in tmp_path.rglob("part-*")]
    assert any(b"common" in data for data in written)
    assert not any(b"rare" in data for data in written)


@pytest.mark.parametrize("size", [1, 40, 10**6])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_counts_of_pieces(size, kind):
    rows = [(text or "", lang or "", source or "") for text, lang, source in audit_rows() if len(text or "") < 1000] + [("", "en", "a"), ("  Née-x\u3000Y, ", "en", "a"), ("1", "de", "b")]
    table = pa.table([pa.array(x, kind) for x in zip(*rows)], ["text", "lang", "source"])
    batches = [*table.slice(0, 300).to_batches(max_chunksize=77), pa.RecordBatch.from_pylist([], schema=table.schema), *table.slice(300).to_batches()]
    cut = list(source_audit.pieces(iter(batches), size))
    assert pa.concat_tables(cut).to_pylist() == table.to_pylist()
    assert len(cut) == 1 if size == 10**6 else len(cut) > 100
    want, docs = Counter(), Counter()
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate({i: i + 32 for i in range(65, 91)}))
        want.update((lang, t, source) for t in terms)
        docs.update({(lang, t) for t in terms})
    got, seen = Counter(), Counter()
    for piece in cut:
        counted = source_audit.piece_counts(piece).to_pylist()
        assert len({(row["lang"], row["term"]) for row in counted}) == len(counted)
        for row in counted:
            seen[row["lang"], row["term"]] += row["docs"]
            assert row["n"] == sum(x["n"] for x in row["counts"])
            assert len({x["source"] for x in row["counts"]}) == len(row["counts"])
            got.update({(row["lang"], row["term"], x["source"]): x["n"] for x in row["counts"]})
    assert got == want and seen == docs


def test_prices_of_large_counts(spark):
    rows = [(n, total, terms) for n in (0, 1, 2**63 // 10**9 - 6, 2**63 // 10**9 - 5, 2**63 // 10**9, 10**15) for total, terms in ((n, 1), (n + 12345, 678))]
    frame = spark.createDataFrame(rows, "n long, total long, terms long")
    got = frame.select("n", "total", "terms", source_audit.price(F.col("n"), F.col("total"), F.col("terms")))
    assert sorted(map(tuple, got.collect())) == sorted((n, total, terms, 1 + 10**9 * (n + 5) // (total + 5 * terms)) for n, total, terms in rows)


def test_products_in_parts(monkeypatch):
    random_ = np.random.default_rng(3)
    n = random_.poisson(2, (500, 6)) * random_.integers(1, 9, (500, 1))
    cost = random_.integers(0, 1000, (6, 200))
    prices = cost[np.arange(6)[None, :], n]
    want = np.abs(prices[:, :, None] - prices[:, None, :]).sum(axis=0)
    whole = n, prices
    monkeypatch.setattr(source_audit, "COLUMNS", 7)
    monkeypatch.setattr(source_audit.parts, "__defaults__", (7,))
    monkeypatch.setattr(source_audit.strips, "__defaults__", (7,))
    assert len(list(source_audit.parts(n))) > 3
    assert (source_audit.differences(whole, whole) == want).all()
    assert (source_audit.differences((n[:, :2], prices[:, :2]), (n[:, 2:], prices[:, 2:])) == want[:2, 2:]).all()
