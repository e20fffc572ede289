"""Ranked search against scoring every document of every item."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from math import floor, log

import numpy as np
import pytest
from netrill.llm import lexical_search

ITEMS = "item_id long, text string, score int"


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, top):
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    n, total = len(held), sum(len(t) for _, t in held)
    df = Counter(w for _, t in held for w in set(t))
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item].update(terms(text))
    out = []
    for item, words in wanted.items():
        found = []
        for doc, t in held:
            m = 50 + 50 * len(t) * n // total
            counts = Counter(t)
            score = sum(
                floor(1000 * log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * counts[w] // (1000 * counts[w] + 20 * m))
                for w in words
                if counts[w]
            )
            if score:
                found.append((-score, doc is None, doc or 0, doc))
        found = sorted(found, key=lambda x: x[:3])[:top]
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(found, 1)]
    return out


@pytest.mark.parametrize(("segment", "stride", "share", "size"), [(1 << 19, 1024, 1 / 16, 4 << 20), (300, 8, 0.3, 200), (50, 4, 0.0, 60)])
def test_like_brute_force(spark, docs_of, monkeypatch, segment, stride, share, size):
    for name, value in {"SEGMENT": segment, "STRIDE": stride, "SHORT_SHARE": share, "ITEM_BYTES": size}.items():
        monkeypatch.setattr(lexical_search, name, value)
    rng = random.Random(4)
    words = [f"W{i}" for i in range(40)] + ["é_É", "the", "THE", "of", "日本"]
    shares = [1 / (i + 1) for i in range(len(words))]
    prose = lambda low, high: rng.choice([" ", "-", "\x00"]).join(rng.choices(words, shares, k=rng.randrange(low, high)))
    docs = [(i, prose(1, 60)) for i in range(300)]
    docs += [(7, docs[7][1]), (None, docs[8][1]), (None, None), (400, ""), (401, "..."), (402, "w39 " * 5000)]
    items = [(i, prose(1, 30)) for i in range(9)] + [(1, "w39 w38"), (1, "w39 w38"), (None, "w5"), (20, None), (21, "?!"), (22, "absent")]
    frame = spark.createDataFrame([(*x, 1) for x in items], ITEMS)
    for top in (5, 50):
        got = lexical_search.ranked(docs_of(docs).repartition(3), frame, top).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(docs, items, top)))


def test_strides_are_skipped():
    places = np.arange(0, 40_000, dtype=np.int64)
    rare = lexical_search.Postings(places[:60], np.full(60, 1000))
    common = lexical_search.Postings(places, np.full(40_000, 3))
    best = lexical_search.Best(50)
    assert lexical_search.search([rare, common], 40_000, places, best) == 1
    assert best.scores.tolist() == [1003] * 50
    assert best.docs.tolist() == list(range(50))


def test_nothing(spark, docs_of, odd, nothing):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "word twice", 2)], ITEMS)
    assert lexical_search.ranked(odd, none).collect() == []
    assert lexical_search.ranked(nothing, some).collect() == []
    got = [(r["item_id"], r["rank"], r["doc_id"]) for r in lexical_search.ranked(odd, some).collect()]
    assert sorted(got) == [(1, 1, 4), (1, 2, 5), (1, 3, 5)]
