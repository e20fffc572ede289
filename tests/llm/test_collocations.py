"""Collocations against brute force, whatever the number of shards and slots."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from netrill.llm import collocations


def brute(rows, least, longest=5, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = {
            q[i:j]
            for q, a in found.items()
            for i in range(len(q))
            for j in range(i + 2, len(q) + 1)
            if j - i < len(q) and a >= counts[q[i:j]]
        }
        ranked = []
        for p, a in found.items():
            if p in inside:
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    words = "The cat sat on a mat éa ÉB b,c d. x".split(" ")
    rows = []
    for _ in range(120):
        text = rng.choice([" ", "\t", "  "]).join(rng.choice(words) for _ in range(rng.randrange(0, 25)))
        rows.append((rng.choice(["en", "fr", None, ""]), text))
    return rows + [("en", "over the LONG bridge we go")] * 7 + [("fr", None), (None, "\n.\v!"), (None, None)]


@pytest.mark.parametrize(("shards", "slots"), [(4, 1 << 20), (2, 16), (1, 64)])
def test_like_brute_force(spark, monkeypatch, shards, slots):
    """Also when nearly every phrase shares its slot with others."""
    monkeypatch.setattr(collocations, "slots_for", lambda words: slots)
    monkeypatch.setattr(collocations, "TOGETHER", 200)
    rows = corpus(shards)
    docs = spark.createDataFrame([(t, x, "clash", 1) for x, t in rows], "text string, lang string, key string, n int")
    for top in (2000, 3):
        got = collocations.mine(docs.repartition(3), least=6, shards=shards, top=top).collect()
        assert sorted(map(tuple, got)) == brute(rows, 6, top=top)


def test_slots_marked_before_the_words_are_seen(spark, monkeypatch):
    """Phrases of one late shard, whose pairs share slots with words of an early one, count in full."""
    monkeypatch.setattr(collocations, "slots_for", lambda words: 128)
    early = " . ".join(f"w{i}" for i in range(40))
    late = " . ".join(" ".join(f"{x}{i}" for x in "abcde") for i in range(12))
    rows = [("en", (early, early, "x", late)[i % 4]) for i in range(24)]
    docs = spark.createDataFrame([(t, x) for x, t in rows], "text string, lang string").coalesce(1)
    got = collocations.mine(docs, least=6).collect()
    assert sorted(map(tuple, got)) == brute(rows, 6)


def test_nothing_and_long_texts(spark, odd, nothing):
    assert collocations.mine(nothing, least=1).collect() == []
    got = collocations.mine(odd, least=2).collect()
    assert [r["phrase"] for r in got if r["a"] == 2 and r["lang"] == "und"] == ["same words twice over here"]
    text = "ab cd " * 100_000
    long = spark.createDataFrame([(text, "en")], "text string, lang string")
    assert sorted(map(tuple, collocations.mine(long).collect())) == brute([("en", text)], 100)


def test_words_with_one_code_are_refused(spark, monkeypatch):
    monkeypatch.setattr(collocations.xxhash, "xxh64_intdigest", lambda data, seed=0: len(data))
    made = [collocations.pa.record_batch({"text": ["aa bb aa bb"], "lang": ["en"]})]
    rows = [tuple(r.values()) for b in collocations._encoding(2, 0)(iter(made)) for r in b.to_pylist()]
    encoded = spark.createDataFrame(rows, collocations.ENCODED)
    found, stamps = collocations.frequent(encoded, 4, 2, 2, 2)
    with pytest.raises(Exception, match="choose another seed"):
        collocations.dictionary(encoded, found, stamps).collect()
