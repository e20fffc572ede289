from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
from netrill.llm import language_model as lm


def brute_base(rows, train):
    counts = Counter(t for _, text in train for t in lm.tokens_of(text))
    total, distinct = sum(counts.values()), len(counts)
    floor = total + 0.5 * (distinct + 1)
    return [
        (
            i,
            len(lm.tokens_of(text)),
            sum(counts[t] > 0 for t in lm.tokens_of(text)),
            total,
            round(sum(math.log10((counts[t] + 0.5) / floor) for t in lm.tokens_of(text)), 6),
        )
        for i, text in rows
    ]


def brute_score(text, train):
    """The model with exact levels instead of the filter."""
    words, pairs = Counter(), Counter()
    for _, other in train:
        tokens = lm.tokens_of(other)
        words.update(tokens)
        pairs.update(zip([lm.END, *tokens], tokens))

    def level(n):
        return 1.5 * 2 ** math.floor(math.log2(n)) - 0.5 if n >= lm.LEAST_COUNT else 0.0

    total = sum(words.values())
    floor = total + 0.5 * (len(words) + 1)
    tokens, out = lm.tokens_of(text), 0.0
    for before, token in zip([lm.END, *tokens], tokens):
        alone = (level(words[token]) + 0.5) / floor
        both = min(level(pairs[before, token]), level(words[before]))
        out += math.log10((both + lm.WEIGHT * alone) / (level(words[before]) + lm.WEIGHT))
    return out


def corpus(n=400):
    rng = random.Random(3)
    words = [f"w{int(rng.paretovariate(0.7)) % 500}" for _ in range(3000)]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(40)))) for i in range(n)]


def test_base_score_and_model_match_brute_force(docs_of, monkeypatch):
    monkeypatch.setattr(lm, "HEAD_WORDS", 20)  # most words take the way of rare ones
    rows = corpus()
    train = [row for row in rows if not lm.held_out(row[0])]
    docs = docs_of(rows)
    got = lm.scored(docs, docs_of(train)).collect()
    base = sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    assert base == sorted(brute_base(rows, train))
    assert all(r.held_out == lm.held_out(r.doc_id) for r in got)
    texts = dict(rows)
    near = [abs(r.score - brute_score(texts[r.doc_id], train)) < 1e-6 for r in got]
    # A false hit of the filter may move a score; with 12 bits an entry that is rare.
    assert np.mean(near) > 0.9


def test_scores_hold_beyond_the_broadcast_bound(docs_of, odd, nothing, monkeypatch):
    """A filter larger than the bound keeps its 12 bits an entry, and levels are looked up in its segments."""
    monkeypatch.setattr(lm, "MOST_BITS", 1 << 14)
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 700)
    rows = corpus()
    train = [row for row in rows if not lm.held_out(row[0])]
    texts = dict(rows)
    got = lm.scored(docs_of(rows), docs_of(train)).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    base = sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    assert base == sorted(brute_base(rows, train))
    assert np.mean([abs(r.score - brute_score(texts[r.doc_id], train)) < 1e-6 for r in got]) > 0.9
    monkeypatch.setattr(lm, "MOST_BITS", 0)
    assert {r.n_tokens for r in lm.scored(odd, odd).collect() if r.doc_id in (1, 2, 3)} == {1}
    assert lm.scored(odd, odd).count() == 10
    assert lm.scored(nothing, nothing).count() == 0
    alone = lm.scored(docs_of([(1, "a b")]), nothing).first()
    assert (alone.n_known, alone.train_tokens, alone.n_tokens) == (0, 0, 3)


def test_pairs_seen_once_are_known(docs_of):
    train = docs_of([(1, "alpha beta gamma delta")])
    got = {r.doc_id: r.score for r in lm.scored(docs_of([(1, "alpha beta gamma delta"), (2, "alpha gamma beta delta")]), train).collect()}
    assert got[1] > got[2] + 0.01


def test_odd_rows(odd, nothing, docs_of):
    got = lm.scored(odd, odd).collect()
    assert len(got) == 10
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert all(r.n_known == r.n_tokens for r in got)
    assert lm.scored(nothing, nothing).count() == 0
    alone = lm.scored(docs_of([(1, "a b")]), nothing).first()
    assert (alone.n_known, alone.train_tokens, alone.n_tokens) == (0, 0, 3)


def test_levels_are_read_back():
    rng = np.random.default_rng(1)
    codes = np.sort(rng.integers(0, 2**63, 5000, dtype=np.uint64))
    counts = rng.integers(1, 1000, 5000).astype(np.uint32)
    import pandas as pd

    frames = pd.DataFrame(list(lm.packed(codes, counts)), columns=["part", "codes", "counts"])
    merged = pd.concat(lm._merge(iter([frames])))
    bits = 8 * 1024
    data = np.zeros(lm.PARTS * bits // 8, np.uint8)
    for _, row in pd.concat(lm._segments(bits)(iter([merged]))).iterrows():
        data[row["part"] * bits // 8 : (row["part"] + 1) * bits // 8] = np.frombuffer(row["bits"], np.uint8)
    got = lm.Filter(bits, data).counts(codes)
    level = np.floor(np.log2(counts))
    want = np.where(counts >= lm.LEAST_COUNT, 1.5 * 2.0**level - 0.5, 0)
    assert np.mean(got == want) > 0.999 and np.all(got >= want)


def test_digests_are_those_of_the_library(monkeypatch):
    """Tokens digested by columns are the plain tokens, however texts are cut into pieces."""
    import pyarrow as pa
    import xxhash
    from netrill.llm import word_codes

    rng = random.Random(5)
    texts = ["".join(rng.choice("abAZ é\t\n \x0b\x1f\x85[@") for _ in range(rng.randrange(100))) for _ in range(300)]
    texts += [None, "", " ", "a" * 31, "a" * 32, "b" * 70 + " c", None]
    tokens = [lm.tokens_of(text) for text in texts]
    for size in (1, 100, 1_000_000):
        monkeypatch.setattr(word_codes, "PIECE_BYTES", size)
        for column in (pa.array(["before", *texts]).slice(1), pa.chunked_array([texts[:50], [], texts[50:]], pa.string())):
            got = [lm.token_codes(some) for some in word_codes.pieces_of(column)]
            assert np.concatenate([sizes for _, sizes in got]).tolist() == list(map(len, tokens))
            codes = np.concatenate([codes for codes, _ in got]).tolist()
            assert codes == [xxhash.xxh64_intdigest(t) for own in tokens for t in own]


def test_one_way_at_any_size(docs_of, monkeypatch):
    """A small filter goes the same way as a large one, without words or filters broadcast or brought to the driver."""
    from pyspark import SparkContext

    def refused(*_):
        raise AssertionError("broadcast")

    monkeypatch.setattr(SparkContext, "broadcast", refused)
    rows = corpus(60)
    train = [row for row in rows if not lm.held_out(row[0])]
    whole = sorted(map(tuple, lm.scored(docs_of(rows), docs_of(train)).collect()))
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 50)
    cut = sorted(map(tuple, lm.scored(docs_of(rows), docs_of(train)).collect()))
    assert [row[:5] for row in whole] == [row[:5] for row in cut]
    assert np.allclose([row[5:] for row in whole], [row[5:] for row in cut])
