"""Scores of the URL filter against counts in plain dictionaries."""

import math
import random
import zlib
from collections import Counter

import pytest

from rowscribe.llm import url_filter
from rowscribe.llm.queries import URL_RULES


def exact_scores(rows):
    """{page_id: score} by the model of url_filter, of rows (page_id, url, rule allows or None)."""
    grams, befores = Counter(), Counter()
    places = {}
    for page_id, url, allow in rows:
        text = (None,) * url_filter.ORDER + tuple(url.partition("://")[2].lower().encode())
        places[page_id] = [text[i - url_filter.ORDER : i + 1] for i in range(url_filter.ORDER, len(text))]
        if allow is not None and zlib.crc32(url.encode()) % 5:
            for gram in places[page_id]:
                for order in range(url_filter.ORDER + 1):
                    grams[allow, gram[-order - 1 :]] += 1
                    befores[allow, order, gram[-order - 1 : -1]] += 1

    def likely(allow, gram):
        p = 1 / 256
        for order in range(url_filter.ORDER + 1):
            seen = befores[allow, order, gram[-order - 1 : -1]]
            p = (grams[allow, gram[-order - 1 :]] + url_filter.WEIGHT * p) / (seen + url_filter.WEIGHT)
        return p

    return {i: sum(math.log(likely(True, g) / likely(False, g)) for g in own) / max(len(own), 1) for i, own in places.items()}


@pytest.mark.parametrize("heavy", [1, 40, url_filter.HEAVY])
def test_scores_are_of_exact_counts(spark, monkeypatch, heavy):
    monkeypatch.setattr(url_filter, "HEAVY", heavy)
    draw = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789-éüñ日本語\0"
    rows = []
    for i in range(600):
        host, allow = draw.choice([("example.net/en/", True), ("a.org/fr/", True), ("b.net/", False), ("c.example.com/de/", False), ("d.info/", None)])
        rows.append((i, f"http://{host}{''.join(draw.choices(letters, k=draw.randint(0, 60)))}", allow))
    rows += [(600, rows[0][1], rows[0][2]), (601, rows[4][1], rows[4][2])]
    pages = spark.createDataFrame([(i, url) for i, url, _ in rows], "page_id long, url string")
    got = {r["page_id"]: r for r in url_filter.filter_urls(pages, URL_RULES).collect()}
    assert len(got) == len(rows)
    want = exact_scores(rows)
    assert {i: r["score"] for i, r in got.items()} == pytest.approx(want, abs=1e-7)
    assert all(r["verdict"] == ("allow" if allow else "block") for i, _, allow in rows if allow is not None for r in [got[i]])
