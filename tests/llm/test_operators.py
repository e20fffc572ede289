"""The native operators, archives, pieces, near-duplicates and toxicity against brute force."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from netrill.llm import decontamination, licenses, near_duplicates, pieces, quality, toxicity, warc
from netrill.session import shared_folder


def prose(rng, n, words="alpha beta gamma delta epsilon zeta eta theta iota kappa".split()):
    return " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(n))


@pytest.fixture()
def items(spark):
    rng = random.Random(2)
    texts = [(1, prose(rng, 30)), (2, prose(rng, 12)), (3, "too short"), (None, None)]
    return spark.createDataFrame(texts, "item_id long, text string")


@pytest.mark.parametrize("bound", [300_000, 0])
def test_decontamination(docs_of, items, monkeypatch, bound):
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", bound)
    rng = random.Random(3)
    passage = items.first()["text"].split()
    near = list(passage)
    for place in (4, 11, 19):
        near[place] = "other"
    rows = [(i, prose(rng, 60)) for i in range(20)]
    rows += [(20, prose(rng, 20) + " " + " ".join(passage).upper() + ". " + prose(rng, 5))]
    rows += [(21, " ".join(near)), (21, "clean one"), (None, " ".join(passage[5:25])), (22, None), (23, "")]
    docs = docs_of(rows)
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.report(docs, items).collect()}
    assert got == {(20, 1), (21, 1), (None, 1)}
    kept = sorted(map(repr, [(r["doc_id"], r["text"]) for r in decontamination.clean(docs, items).collect()]))
    assert kept == sorted(map(repr, [*rows[:20], rows[22], rows[24], rows[25]]))


@pytest.mark.parametrize("rows", [1, 1 << 20])
def test_seeds_beyond_the_bound_are_sent_to_no_executor(docs_of, items, monkeypatch, rows):
    """Only the table of marks is, which has a fixed size; seeds that share a mark lose no hit."""
    rng = random.Random(3)
    passages = [r["text"] for r in items.collect()]
    docs = docs_of([(i, prose(rng, 40)) for i in range(9)] + [(9, passages[0]), (10, passages[1] + " " + prose(rng, 9))])
    more = items.unionByName(items.where("item_id = 2").selectExpr("1L as item_id", "text"))
    wanted = sorted(map(tuple, decontamination.report(docs, more).collect()))
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(decontamination, "MARK_ROWS", rows, raising=False)
    found = decontamination.report(docs, more)
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert [("Broadcast" in line, "seed#" in line) for line in joins if "_row#" not in line] == [(False, True)]
    assert sorted(map(tuple, found.collect())) == wanted
    assert {(i, j) for i, j, *_ in wanted} == {(9, 1), (10, 1), (10, 2)}


def test_license_texts_are_found_in_other_spellings(docs_of, spark):
    text = licenses.KNOWN[0][1]
    rows = [
        (1, "Copyright (c) 2020 A. Person\n\n" + text.upper().replace("SUBLICENSE", "SUBLICENCE")),
        (2, text.replace(" ", "\n* ")),
        (3, text + " and more"),
        (4, None),
        (None, ""),
        (5, "Released under the MIT Licence!"),
    ]
    got = {r["doc_id"]: r["license_id"] for r in licenses.scan(docs_of(rows), licenses.known_licenses(spark)).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: None, 4: None, None: None, 5: "MIT notice"}


def test_quality_figures(docs_of):
    clean = "the cat of a house and that dog in the garden " * 1
    text = " ".join(f"{w}{i}" for i in range(30) for w in ("the", "and")) + " the of a in it"
    rows = [(1, text), (2, "a b c a b c"), (3, None), (4, "x\nx\n \n\nx"), (None, clean)]
    got = {r["doc_id"]: r for r in quality.judge(docs_of(rows)).collect()}
    assert got[1]["kept"] and not got[1]["base_failed"]
    assert got[2]["n_repeat_words"] == 6 and got[2]["base_failed"]
    assert (got[3]["n_words"], got[3]["kept"]) == (0, False)
    assert (got[4]["n_dup_lines"], got[4]["n_lines"]) == (2, 3)


def test_archives(spark):
    rows = [(1, "u1", "same"), (7, "u7", "same"), (7, "u0", "same"), (None, None, "same"), (3, "u3", None), (4, "ü\n", "é" * 2_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = shared_folder(spark, "test-warc")
    index = warc.written(warc.write_archives(pages, folder), "test-index")
    got = sorted((r["page_id"] or -1, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.read_archives(index, folder).collect())
    assert got == [(-1, "revisit", 7, 4), (1, "revisit", 7, 4), (3, "response", None, 0), (4, "response", None, 4_000_000), (7, "response", None, 4), (7, "revisit", 7, 4)]
    assert warc.read_archives(warc.written(warc.write_archives(pages.limit(0), folder), "none"), folder).count() == 0


def test_pieces_match_the_library(odd, nothing):
    import sentencepiece

    path = pieces.default_model()
    model, library = pieces.model_of(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(8)
    texts = ["", " ", "▁", "a" * 3000, " " * 400, "<s> </s> <0x41>", "wörd  the\n\tword"]
    texts += ["".join(rng.choice("abc ▁\n\té你🙂\x00ß the in er 12.,") for _ in range(rng.randrange(60))) for _ in range(3000)]
    for text, ids in zip(texts, library.encode(texts)):
        assert model.encode(text) == ids, text
        assert model.decode([model.begin, *ids, model.end]) == library.decode(ids), text
    rows = pieces.encoded(odd, path, with_ids=True).collect()
    assert len(rows) == 10 and {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {2}
    assert all(library.decode(r["ids"]) == r["decoded"] for r in rows)
    assert pieces.encoded(nothing, path).count() == 0


def test_pieces_are_cut_at_marks_and_lines():
    import sentencepiece

    path = pieces.default_model()
    model, library = pieces.PieceModel(open(path, "rb").read()), sentencepiece.SentencePieceProcessor(model_file=path)
    model.encode("word")
    assert len(model.cuts) == 1
    # The word is kept once, whatever mark or line is behind it.
    model.encode("word$$$ word%%%\n word. word")
    assert set(model.cuts) == {"▁word", "$$$", "%%%", "\n", "."}
    rng = random.Random(9)
    units = [*model.texts[259::97], "²", ".", "x².y", "$$$", "\n", " ", "é", "’s", "--", "(a)", "1,000", "🙂", "\x00", "<0x41>"]
    texts = ["".join(rng.choice(units) for _ in range(rng.randrange(40))) for _ in range(2000)]
    for text, ids in zip(texts, library.encode(texts)):
        assert model.encode(text) == ids, text
        assert model.decode_cuts(model.encode_cuts(text) if text else []) == library.decode(ids), text
    small = _small_cuts(model, texts[:50])
    assert small == library.encode(texts[:50])


def _small_cuts(model, texts):
    """Ids with hardly any room for cuts and pairs."""
    kept = pieces.KEEP_CUTS, pieces.KEEP_PAIRS
    pieces.KEEP_CUTS, pieces.KEEP_PAIRS = 3, 5
    try:
        return [model.encode(text) for text in texts]
    finally:
        pieces.KEEP_CUTS, pieces.KEEP_PAIRS = kept


def brute_components(rows):
    sets = [set(near_duplicates.Shingler()(text).tolist()) for _, text in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                label[root(i)] = root(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None and sets[i]:
            low[root(i)] = min(low.get(root(i), doc_id), doc_id)
    return [(d, len(s), low.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def test_near_duplicates(docs_of, nothing, odd):
    rng = random.Random(12)
    rows = [(i, prose(rng, rng.randrange(2, 90))) for i in range(40)]
    chain = prose(rng, 120).split()
    for i in range(40, 80):  # a chain of copies that drift apart
        chain[rng.randrange(120)] = f"new{i}"
        rows.append((i, " ".join(chain)))
    rows += [(80, rows[3][1].upper()), (80, rows[5][1]), (None, rows[7][1]), (90, None), (91, " "), (92, "one two")]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_duplicates.judged(docs_of(rows)).collect()]
    assert sorted(got, key=repr) == sorted(brute_components(rows), key=repr)
    kept = near_duplicates.distinct(docs_of(rows)).collect()
    assert len(kept) == len({c for _, n, c in brute_components(rows) if n}) + 2
    assert near_duplicates.judged(nothing).count() == 0
    assert near_duplicates.distinct(odd).columns == odd.columns


def test_toxicity_learns_altered_words(docs_of, spark, odd, nothing):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = prose(rng, 30, "tha the ing ona ere sti lon mar".split()).split()
        if toxic:
            words.insert(rng.randrange(30), rng.choice(["scoundrel", "blockhead"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    marks = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.judged(docs_of(rows), marks).collect()
    held = [(r["predicted"], labels[r["doc_id"]][1]) for r in got if r["held_out"]]
    assert held and sum(a == b for a, b in held) >= 0.95 * len(held)
    altered = docs_of([(1, "a s.c.o.u.n.d.r.e.l here"), (2, "the tha"), (3, "b l o c k h e a d"), (None, None)])
    weights = toxicity.learned(docs_of(rows), marks)
    scores = {r["doc_id"]: r["score"] for r in toxicity.scored(altered, weights, ["doc_id"]).collect()}
    assert scores[1] > 0.7 and scores[3] > 0.7 and scores[2] < 0.3 and 0 <= scores[None] < 0.3
    assert toxicity.accepted(odd, marks).columns == odd.columns
    assert all(r["score"] == 0 for r in toxicity.judged(odd, marks.limit(0)).collect())
    assert toxicity.judged(nothing, marks).count() == 0


def test_toxicity_is_learnt_outside_the_driver(docs_of, spark, nothing, monkeypatch):
    """The driver gets the weights only; they are those of a plain call."""
    rows = [(i, "you utter blockhead again" if i % 3 == 0 else "a fine day to you again") for i in range(90)]
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    taken = toxicity.learned(docs_of(rows), marks)
    own = [(i, toxicity.units_of(text)) for i, text in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    plain = toxicity.train([units for i, units in own if i % 3 == 0], [units for i, units in own if i % 3])
    assert taken.slope and np.allclose(taken.triple, plain.triple)
    assert np.allclose((taken.offset, taken.slope, taken.middle), (plain.offset, plain.slope, plain.middle))
    assert not toxicity.learned(nothing, marks).slope
    called = []
    monkeypatch.setattr(toxicity, "train", lambda *kinds: called.append(kinds) or plain)
    assert toxicity.learned(docs_of(rows), marks).slope == plain.slope
    assert not called
