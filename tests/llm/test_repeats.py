from __future__ import annotations

import hashlib
import random

import numpy as np
from netrill.llm import deep_shallow, repeats


def brute(texts: list[bytes], length: int) -> list[tuple[int, int, int, str]]:
    """Count every string of `length` bytes and mark those that start at two places."""
    times: dict[bytes, int] = {}
    for text in texts:
        for at in range(len(text) - length + 1):
            piece = text[at : at + length]
            times[piece] = times.get(piece, 0) + 1
    out = []
    for text in texts:
        gone = np.zeros(len(text) + 1, bool)
        for at in range(len(text) - length + 1):
            if times[text[at : at + length]] > 1:
                gone[at : at + length] = True
        spans = int(np.sum(gone[:-1] & ~np.r_[False, gone[:-1]][: len(text)])) if text else 0
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def some_texts(seed: int) -> list[str]:
    rng = random.Random(seed)

    def noise(n):
        return "".join(rng.choice("abcdé ") for _ in range(n))

    shared = [noise(n) for n in (350, 395, 400, 401, 600, 1200)]
    texts = ["", None, "short", noise(399), noise(2000)]
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts.append(rng.choice(shared) if rng.random() < 0.6 else noise(rng.randrange(500)))
            if rng.random() < 0.3:
                piece = rng.choice(shared)
                parts.append(piece[rng.randrange(200) :])
        texts.append("".join(parts))
    texts += [texts[7], texts[7], texts[9], "a" * 900, "ab" * 700, "x" * 399]
    return texts


def test_results_match_brute_force(docs_of):
    for seed in (1, 2):
        texts = some_texts(seed)
        got = repeats.removed(docs_of(list(enumerate(texts)))).collect()
        want = brute([(t or "").encode() for t in texts], repeats.LENGTH)
        assert sorted(map(tuple, got)) == [(i, *row) for i, row in enumerate(want)]


def test_pieces_of_long_texts(monkeypatch):
    rng = random.Random(4)
    text = bytes(rng.choice(b"abc") for _ in range(30_000))
    whole = [np.concatenate([r[k] for r in repeats.anchors([text, b"", text[:5000]])]) for k in (1, 2, 3, 4)]
    covered = sorted((a, b) for _, _, _, first, last in repeats.anchors([text]) for a, b in zip(first, last))
    assert covered[0][0] == 0 and covered[-1][1] == len(text) - repeats.LENGTH
    assert all(b + 1 == a for (_, b), (a, _) in zip(covered, covered[1:]))
    monkeypatch.setattr(repeats, "PIECE", 7_000)
    cut = [np.concatenate([r[k] for r in repeats.anchors([text, b"", text[:5000]])]) for k in (1, 2)]
    assert set(zip(cut[0], cut[1])) == set(zip(whole[0], whole[1]))


def test_sorting_and_extents():
    rng = random.Random(6)
    for _ in range(300):
        base = bytes(rng.choice(b"ab") for _ in range(200))
        strings = list({base[: rng.randrange(200)] + bytes(rng.choice(b"ab") for _ in range(rng.randrange(20))) for _ in range(rng.randrange(2, 40))})
        assert [strings[i] for i in deep_shallow.ordered(strings)] == sorted(strings)
        pairs = list({(rng.choice(strings), rng.choice(strings)) for _ in range(30)})
        if len(pairs) < 2:
            continue
        lefts, rights = [p[0] for p in pairs], [p[1] for p in pairs]
        want = []
        for i, (left, right) in enumerate(pairs):
            best = (0, 0)
            for j, (other, after) in enumerate(pairs):
                a, b = deep_shallow.common(left, other), deep_shallow.common(right, after)
                if i != j and a + b >= 90:
                    best = (max(best[0], a), max(best[1], b))
            want.append(best)
        assert deep_shallow.extents(lefts, rights, 90) == want


def test_odd_rows(odd, nothing):
    got = {r["doc_id"]: r for r in repeats.removed(odd.select("doc_id", "text", "lang")).collect()}
    assert got[1]["n_bytes"] == got[2]["n_bytes"] == 0
    assert (got[6]["n_removed"], got[6]["n_spans"]) == (30_000, 1)
    assert got[5]["n_removed"] == 0
    assert repeats.removed(odd).count() == 10
    assert repeats.removed(nothing).count() == 0
