from __future__ import annotations

import hashlib
import math
import random
import re

from netrill.llm import privacy


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """The base patterns as they are stated."""
    out = [
        (m.start(), 0, m.end())
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
    ]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits[::-1])]
        if 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_match_the_stated_patterns():
    rng = random.Random(5)
    for _ in range(30_000):
        text = "".join(rng.choice("a.@1925+- ()_é%Z\n") for _ in range(rng.randrange(60)))
        assert privacy.base_spans(text) == plain_spans(text), text
    for text in ("1.2.3.4.5.6.7.8", "a@b.c_d@e.f", "4111 1111 1111 1111", "+1 (255) 555-8013", "1" * 5000):
        assert privacy.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1" * 100_000):
        privacy.base_spans(text)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_rows_without_findings(odd, nothing):
    got = privacy.found(odd.select("doc_id", "text"), ["doc_id"]).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(got) == 10
    assert all(r["spans"] == "" and r["base_sha256"] == empty and r["n_email"] == 0 for r in got)
    assert privacy.found(nothing.select("doc_id", "text"), ["doc_id"]).count() == 0
    assert rows_of(privacy.sanitised(odd)) == rows_of(
        odd.withColumn("n_chars", odd["n_chars"])
    )
    assert privacy.sanitised(nothing).count() == 0


def test_words_that_reveal_an_entity(docs_of):
    # "Quillon" stands near one address in four texts and nowhere else; "the" stands everywhere.
    texts = [f"the note {i} from Quillon is at q.q@example.org today the end" for i in ("x", "y", "z", "v")]
    texts += ["the rest of the corpus is from here is at the end today note"] * 12
    texts += ["Quillen wrote to r@example.net", "call +1 555 123 4567 or 10.0.0.1"]
    docs = docs_of(list(enumerate(texts)))
    # Four of seven different texts hold the address: seven texts can't give six bits.
    got = {r["doc_id"]: r for r in privacy.found(docs, ["doc_id"], gain=0.3).collect()}
    for i in range(4):
        start = texts[i].index("Quillon")
        mail = texts[i].index("q.q@")
        assert f"term:{start}:{start + 7},email:{mail}:{mail + 15}" in got[i]["spans"]
        base = f"email:{mail}:{mail + 15}"
        assert got[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    assert got[16]["spans"].startswith("email:") and "term" not in got[16]["spans"]
    assert (got[17]["n_phone"], got[17]["n_ip"], got[17]["n_email"]) == (1, 1, 0)
    clean = {r["doc_id"]: r for r in privacy.sanitised(docs, gain=0.3).collect()}
    assert clean[0]["text"] == "the note x from <TERM> is at <EMAIL> today the end"
    assert clean[0]["n_chars"] == len(clean[0]["text"])
    assert clean[5]["text"] == texts[5]


def limit_of(k: int, n: int) -> float:
    z = privacy.DEVIATE
    return (k / n + z * z / (2 * n) - z * math.sqrt(k / n * (1 - k / n) / n + (z / (2 * n)) ** 2)) / (1 + z * z / n)


def brute_terms(texts: list[str], residual: float, gain: float) -> dict[tuple[str, str], float]:
    """All pairs of entities and words over the different texts."""
    texts = sorted(set(texts))
    holders: dict[str, set[int]] = {}
    users: dict[str, set[int]] = {}
    beside: dict[str, set[int]] = {}
    for i, text in enumerate(texts):
        spans = plain_spans(text)
        for name in privacy._entities(text, spans):
            holders.setdefault(name, set()).add(i)
        for word in set(privacy._WORD.findall(text.lower())):
            users.setdefault(word, set()).add(i)
        for m in privacy._WORD.finditer(text):
            if not any(m.start() < e and s < m.end() for s, _, e in spans):
                beside.setdefault(m[0].lower(), set()).add(i)
    out = {}
    for name, where in holders.items():
        for word, places in beside.items():
            k, n = len(where & places), len(users[word])
            if k >= 2 and limit_of(k, n) >= 2**-residual and limit_of(k, n) >= 2**gain * len(where) / len(texts):
                out[name, word] = limit_of(k, n)
    return out


def shares(docs, residual, gain):
    scan = privacy.scanned(docs, ["doc_id"])
    return {(r["entity"], r["term"]): r["limit"] for r in privacy.revealing(docs, scan, residual, gain).collect()}


def test_statistics_match_brute_force(docs_of):
    rng = random.Random(9)
    names = ["Alda", "Berto", "Cinta", "Doria", "the", "and", "note"]
    texts = []
    for i in range(400):
        k = rng.randrange(4)
        words = [rng.choice(names[4:]) for _ in range(rng.randrange(12))]
        words += [names[k], f"{names[k].lower()}@h{k % 3}.example.org"] if rng.random() < 0.4 else []
        words += [f"rare{rng.randrange(150)}"] if rng.random() < 0.3 else []
        words += [f"Net{k}", f"10.0.{k}.{rng.randrange(99)}"] if rng.random() < 0.1 else []
        words += [f"+1 555 {200 + k} {1000 + i}", f"Line{k}"] if rng.random() < 0.1 else []
        words += [rng.choice(names)] if rng.random() < 0.2 else []
        texts.append(" ".join(words))
    texts += rng.sample(texts, 60)
    docs = docs_of(list(enumerate(texts))).repartition(4)
    for residual, gain in ((1.0, 0.5), (2.0, 1.0), (0.5, 2.0), (1.0, 3.0)):
        want, got = brute_terms(texts, residual, gain), shares(docs, residual, gain)
        assert got.keys() == want.keys()
        assert all(abs(got[key] - value) < 1e-9 for key, value in want.items())
    assert brute_terms(texts, 1.0, 0.5) and brute_terms(texts, 2.0, 1.0)


def test_terms_do_not_depend_on_the_size_of_the_corpus(docs_of):
    texts = [f"note {i} from Quillon q.q@example.org" for i in ("one", "two", "six")] * 100
    # A value in one text only, with a word that stands nowhere else: no evidence at any size.
    texts += ["filler text of Zimrad z@example.net"]
    # Two different addresses of a domain that one word stands with.
    texts += ["Firmata writes from a@firm.example", "Firmata again from b@firm.example"]
    for n in (500, 2500):
        more = [f"filler note text number {'abcdefghij'[i % 10]}{i}zz" for i in range(n)]
        docs = docs_of(list(enumerate([*texts, *more]))).repartition(5)
        got = shares(docs, privacy.RESIDUAL, privacy.GAIN)
        assert set(got) == {
            ("email:q.q@example.org", "quillon"),
            ("email:@example.org", "quillon"),
            ("email:@firm.example", "firmata"),
        }
        assert abs(got["email:q.q@example.org", "quillon"] - limit_of(3, 3)) < 1e-9


def test_planted_names_are_found_and_ordinary_words_stay(docs_of):
    rng = random.Random(3)
    common = [f"{a}{b}" for a in ("ta", "ko", "mi", "ru", "se") for b in ("lan", "dor", "vek", "mus", "pil", "gat")]
    rare = [f"{a}{b}{c}" for a in ("za", "pe", "hu") for b in common[:20] for c in ("en", "is")]
    texts, planted = [], set()
    for person in range(20):
        planted.add(f"name{person}q")
        for _ in range(2 + person % 4):
            words = [rng.choice(common) for _ in range(30)] + [rng.choice(rare)]
            words += [f"Name{person}q", f"user{person}@mail{person % 3}.example.com"]
            rng.shuffle(words)
            texts.append(" ".join(words))
    texts += [" ".join([rng.choice(common) for _ in range(30)] + [rng.choice(rare)]) for _ in range(1500)]
    docs = docs_of(list(enumerate(texts)))
    found = {term for _, term in shares(docs, privacy.RESIDUAL, privacy.GAIN)}
    assert found == planted


def test_terms_are_removed_in_the_whole_text(docs_of):
    # A greeting far from the address in the signature, an account code, and the name once more.
    gap = "the words between them " * 10
    texts = [f"Quillon7 writes {gap}{i} q.q@example.org {gap}Quillon7 again" for i in ("one", "two", "six", "ten")]
    texts += [f"{gap}writes again {i}" for i in range(400)]
    got = {r["doc_id"]: r["text"] for r in privacy.sanitised(docs_of(list(enumerate(texts)))).collect()}
    for i, word in enumerate(("one", "two", "six", "ten")):
        assert got[i] == f"<TERM> writes {gap}{word} <EMAIL> {gap}<TERM> again"
    assert got[10] == texts[10]


def test_clashing_names_are_kept(odd, docs_of):
    from pyspark.sql import functions as F

    names = ["spans", "base_sha256", "n_email", "n_ip", "n_card", "n_phone", "row_key", "text_code", "entities", "kept_0"]
    docs = docs_of([(1, "write to a@example.org"), (2, None), (None, "plain")])
    for name in names:
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    got = {r["doc_id"]: r.asDict() for r in privacy.sanitised(docs).collect()}
    assert got[1]["text"] == "write to <EMAIL>" and got[2]["text"] is None
    assert all(row[name] == f"own {name}" for row in got.values() for name in names)
