"""Toxicity by a subsequence string kernel, a support vector machine and Nyström landmarks.

The kernel of two units (a word with its borders, or a window of a long one) counts the
three-character subsequences they share, gaps included, each weighted by DECAY to the power
of the stretch it spans; it is normalised. Inserted characters and gaps therefore cost
a little and don't hide a word. Landmarks among training units give the Nyström feature map
`K(x, L) K(L, L)^(-1/2)`; a linear support vector machine learns on it. Labels are those of
whole texts: a text is toxic by its worst unit, so for each toxic text the unit that counts
is chosen anew in a few rounds. The machine then collapses into one weight for each
three-character subsequence, which is all that is sent to the workers.

Training takes a bounded sample of labelled rows, in one task and not in the driver, to which only
the weights come; every row is scored over its whole text.

Edge cases: null and empty texts score as the lowest unit does; a null doc_id is in the
learning part and has no label; labels without a doc_id or a value are not used, of several
for a doc_id the largest counts; without labels of both kinds every score is 0; repeated
rows are scored one by one; empty tables give an empty result; `accepted` keeps further
columns under their names, other functions don't read them.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Collection, Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netrill.llm.common import table

FOLDS, HELD_OUT = 3, 1
REJECT = 0.7
#: Bounds of the sample: labelled texts of each kind, and characters of a text that is learnt from.
TOXIC_SAMPLE, CLEAN_SAMPLE, SAMPLE_CHARS = 1500, 3000, 20_000
DECAY, LANDMARKS, CLEAN_LANDMARKS, ROUNDS = 0.7, 72, 24, 3
NEGATIVES, HARD, COST = 20_000, 6_000, 1000
#: Longest unit with its two borders, and the step of windows over longer words.
LONGEST, STEP = 18, 8
SYMBOLS = 48
START, END = 46, 47
KEEP_UNITS = 400_000
#: Units whose triples are held at a time; each takes up to 816 numbers, several times over.
ROWS = 512


def _codes(unit: str) -> list[int]:
    """a-z have codes of their own; other characters share a few."""
    return [ord(c) - 97 if "a" <= c <= "z" else 26 + ord(c) % 20 for c in unit]


_SPELT = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
_MARKS = re.compile(r"[\W_]+")


def units_of(text: str | None) -> set[str]:
    """Words in lower case without marks; single characters in a row are one word.

    A word with marks inside gives its whole, so that marks hide nothing, and its longer parts.
    """
    text = (text or "").lower()
    out = set()
    words = set(text.split())
    words.update("".join(m[0].split()) for m in _SPELT.finditer(text))
    for word in words:
        if word.isalnum():
            out.add(word)
            continue
        parts = [part for part in _MARKS.split(word) if part]
        out.add("".join(parts))
        if len(parts) > 1:
            out.update(part for part in parts if len(part) > 2)
    out.discard("")
    return out


def windows(unit: str) -> list[bytes]:
    """Codes of a unit with its borders, a byte each; of a long one in stretches."""
    codes = bytes([START, *(_codes(unit) or [26]), END])
    if len(codes) <= LONGEST:
        return [codes]
    starts = range(0, len(codes) - LONGEST + STEP, STEP)
    return [codes[at : at + LONGEST] for at in starts]


_SHAPES: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _shape(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all triples of a unit of this size, their weights, and the decay between places."""
    if size not in _SHAPES:
        places = np.array(list(combinations(range(size), 3)), np.int64).T
        weights = (DECAY ** (places[2] - places[0] + 1)).astype(np.float32)
        gap = np.arange(size)[None, :] - np.arange(size)[:, None]
        decay = np.where(gap > 0, DECAY ** np.maximum(gap - 1, 0), 0.0).astype(np.float32)
        _SHAPES[size] = places, weights, decay
    return _SHAPES[size]


def triples(block: np.ndarray) -> np.ndarray:
    """Triple numbers of units of one size, a row each."""
    a, b, c = _shape(block.shape[1])[0]
    return (block[:, a] * SYMBOLS + block[:, b]) * SYMBOLS + block[:, c]


def norms(block: np.ndarray) -> np.ndarray:
    """Square roots of the kernel of each unit with itself, by the kernel's recursion."""
    decay = _shape(block.shape[1])[2]
    same = (block[:, :, None] == block[:, None, :]).astype(np.float32) * DECAY**2
    ending = same
    for _ in range(2):
        ending = same * (decay.T @ ending @ decay)
    return np.sqrt(ending.sum(axis=(1, 2)))


def by_size(codes: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in the list, units as rows) in blocks of one size."""
    sizes = np.array([len(c) for c in codes])
    for size in np.unique(sizes):
        for where in np.array_split(np.flatnonzero(sizes == size), max(1, (sizes == size).sum() // 4096)):
            if len(where):
                rows = np.frombuffer(b"".join([codes[i] for i in where]), np.uint8)
                yield where, rows.reshape(len(where), size).astype(np.int64)


class Weights:
    """A collapsed machine: the weight of every triple, the offset, and the scale of scores."""

    def __init__(self, triple: np.ndarray, offset: float, slope: float, middle: float):
        self.triple, self.offset, self.slope, self.middle = triple, offset, slope, middle

    def margins(self, codes: list[bytes]) -> np.ndarray:
        out = np.zeros(len(codes), np.float32)
        for where, block in by_size(codes):
            weights = _shape(block.shape[1])[1]
            for begin in range(0, len(where), ROWS):
                rows = block[begin : begin + ROWS]
                out[where[begin : begin + ROWS]] = self.triple[triples(rows)] @ weights / norms(rows)
        return out + self.offset

    def unit_margins(self, units: list[str]) -> np.ndarray:
        """The largest margin of a unit's windows."""
        cut = [windows(unit) for unit in units]
        if not cut:
            return np.zeros(0, np.float32)
        starts = np.cumsum([0, *[len(c) for c in cut[:-1]]])
        return np.maximum.reduceat(self.margins(list(chain.from_iterable(cut))), starts)

    def score(self, margin: float) -> float:
        return float(1 / (1 + np.exp(np.clip(-self.slope * (margin - self.middle), -60, 60))))


NOTHING_LEARNT = Weights(np.zeros(SYMBOLS**3, np.float32), 0.0, 0.0, 0.0)


def _dense(codes: list[bytes]) -> np.ndarray:
    """Normalised feature vectors of a few units; they lie in memory by triple, as `_features` reads them."""
    out = np.zeros((SYMBOLS**3, len(codes)), np.float32).T
    for where, block in by_size(codes):
        numbers, weights = triples(block), _shape(block.shape[1])[1]
        for row, own, norm in zip(where, numbers, norms(block), strict=True):
            out[row] = np.bincount(own, weights, SYMBOLS**3) / norm
    return out


def _features(codes: list[bytes], dense: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Nyström features: kernels with the landmarks times the inverse root of their own kernel."""
    kernels = np.zeros((len(codes), len(dense)), np.float32)
    flat = np.ascontiguousarray(dense.T)
    for where, block in by_size(codes):
        weights = _shape(block.shape[1])[1]
        for part in np.array_split(np.arange(len(where)), max(1, len(where) // 16)):
            got = np.einsum("nck,c->nk", flat[triples(block[part])], weights, optimize=True)
            kernels[where[part]] = got / norms(block[part])[:, None]
    return kernels @ root


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Squared-hinge support vector machine by Newton steps; the last entry is the offset."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64, copy=False)
    w = np.zeros(x.shape[1])
    penalty = np.eye(len(w)) * ridge
    penalty[-1, -1] = 1e-6
    active = np.ones(len(x), bool)
    for _ in range(30):
        own, cost = x[active], weight[active]
        step = np.linalg.solve(penalty + own.T @ (own * cost[:, None]), own.T @ (cost * y[active]))
        now = y * (x @ step) < 1
        w = step
        if (now == active).all():
            break
        active = now
    return w


def _grams(unit: str) -> set[str]:
    wide = f"<{unit}>"
    return {wide[i : i + 4] for i in range(max(1, len(wide) - 3))}


def _document_counts(texts: list[list[str]]) -> dict[str, int]:
    out: dict[str, int] = {}
    for text in texts:
        for unit in text:
            out[unit] = out.get(unit, 0) + 1
    return out


def _first_values(toxic: list[list[str]], clean: list[list[str]]) -> dict[str, float]:
    """How telling the most telling group of four characters of each unit is, in deviations."""
    counts = []
    for texts in (toxic, clean):
        n: dict[str, int] = {}
        for text in texts:
            for gram in {gram for unit in text for gram in _grams(unit)}:
                n[gram] = n.get(gram, 0) + 1
        counts.append(n)
    size, other = len(toxic), len(clean)

    def telling(gram: str) -> float:
        a, b = counts[0].get(gram, 0), counts[1].get(gram, 0)
        share = (a + b + 1) / (size + other + 2)
        return (a / size - b / other) / np.sqrt(share * (1 - share) * (1 / size + 1 / other))

    value = {gram: telling(gram) for gram in counts[0]}
    return {u: max(value[g] for g in _grams(u)) for u in {u for text in toxic for u in text}}


def _landmarks(codes: list[bytes], most: int) -> list[int]:
    """The first units that aren't much like one before them; only chosen ones are held as vectors."""
    chosen: list[int] = []
    held: list[np.ndarray] = []
    for place, code in enumerate(codes):
        if len(chosen) == most:
            break
        row = _dense([code])[0]
        if all(one @ row < 0.7 for one in held):
            chosen.append(place)
            held.append(row)
    return chosen


#: Characters put into telling units, in turn.
INSERTED = "xoeqizhu"


def _varied(unit: str) -> list[str]:
    """The unit with a character inserted or doubled at each place inside, and with an ending."""
    places = range(1, len(unit))
    out = [f"{unit[:i]}{INSERTED[(i + len(unit)) % len(INSERTED)]}{unit[i:]}" for i in places]
    return [*out, *[f"{unit[:i]}{unit[i - 1]}{unit[i:]}" for i in places], f"{unit}s"]


def _fitted(
    ranked: list[str], times: dict[str, int], known_clean: list[str], negatives: list[str], in_good: dict[str, int]
) -> tuple[Weights, list[str]]:
    """A machine that tells the `ranked` units from the `negatives`, and the varied units it learnt from.

    Its vectors are let go before the next round makes its own.
    """
    candidates = [windows(u)[0] for u in ranked[:400]]
    landmarks = [candidates[i] for i in _landmarks(candidates, LANDMARKS - CLEAN_LANDMARKS)]
    landmarks += [windows(u)[0] for u in known_clean[:CLEAN_LANDMARKS]]
    dense = _dense(landmarks)
    values, vectors = np.linalg.eigh((dense @ dense.T).astype(np.float64))
    root = (vectors / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    common = [u for u in ranked[:300] if times[u] > 1]
    varied = [(v, times[u]) for u in common for v in _varied(u)]
    positives = [*ranked, *[v for v, _ in varied]]
    positive_codes = [windows(u)[0] for u in positives]
    gain = np.sqrt([*[times[u] for u in ranked], *[0.25 * n for _, n in varied]])
    negative_units = [(c, in_good[u]) for u in negatives for c in windows(u)]
    loss = np.sqrt([n for _, n in negative_units])
    y = np.r_[np.ones(len(positive_codes)), -np.ones(len(negative_units))]
    cost = np.r_[gain / gain.sum(), 8 * loss / loss.sum()]
    # The features are not named here, so that the machine can let them go.
    w = _machine(_features([*positive_codes, *[c for c, _ in negative_units]], dense, root), y, cost * COST)
    weights = Weights((dense.T @ (root @ w[:-1])).astype(np.float32), float(w[-1]), 1.0, 0.0)
    return weights, [v for v, _ in varied]


def train(toxic: list[Collection[str]], clean: list[Collection[str]]) -> Weights:
    """Learn from the units of toxic and clean texts; the order of texts and units doesn't matter."""
    bad = sorted(sorted(text) for text in toxic if text)
    good = sorted(sorted(text) for text in clean if text)
    if not bad or not good:
        return NOTHING_LEARNT
    in_bad, in_good = _document_counts(bad), _document_counts(good)
    scale = len(bad) / len(good)
    # A unit can make a text toxic only if it hardly occurs in clean ones.
    allowed = {u for u, n in in_bad.items() if n >= 0.9 * (n + scale * in_good.get(u, 0))}
    known_clean = sorted(in_good, key=lambda u: (zlib.crc32(u.encode()), u))
    telling = _first_values(bad, good)

    def picked(values: dict[str, float], enough: float) -> dict[str, int]:
        """Per unit the toxic texts that it is held to make toxic: all their telling units, or the best."""
        times: dict[str, int] = {}
        for text in bad:
            own = [u for u in text if u in allowed]
            if own:
                best = max(values[u] for u in own)
                for u in own:
                    if values[u] >= min(best, max(enough, 0.6 * best)):
                        times[u] = times.get(u, 0) + 1
        return times

    times = picked(telling, 5.0)
    negatives = known_clean[:NEGATIVES]
    weights = NOTHING_LEARNT
    for _ in range(ROUNDS):
        if not times:
            return NOTHING_LEARNT
        ranked = sorted(times, key=lambda u: (-times[u], -telling[u], u))[:1500]
        weights, varied = _fitted(ranked, times, known_clean, negatives, in_good)
        # The units that count in toxic texts, and the clean units that look worst.
        margins = dict(zip(known_clean, weights.unit_margins(known_clean).tolist(), strict=True))
        hard = sorted(known_clean, key=lambda u: (-margins[u], u))[:HARD]
        negatives = sorted({*known_clean[:NEGATIVES], *hard})
        own = sorted(in_bad)
        margins |= dict(zip(own, weights.unit_margins(own).tolist(), strict=True))
        times = picked(margins, 0.0)
    worst_bad = np.array([max(margins[u] for u in text) for text in bad])
    worst_good = np.array([max(margins[u] for u in text) for text in good])
    return _scaled(weights, worst_bad, worst_good, weights.unit_margins(varied))


def _scaled(weights: Weights, bad: np.ndarray, good: np.ndarray, varied: np.ndarray) -> Weights:
    """Fit the logistic scale of text margins, with targets held off 0 and 1.

    Varied units count a little as toxic texts, so that the scale leaves room for them.
    """
    x = np.r_[bad, good, varied].astype(np.float64)
    high, low = (len(bad) + 1) / (len(bad) + 2), 1 / (len(good) + 2)
    sizes = (len(bad), len(good), len(varied))
    y = np.repeat([high, low, high], sizes)
    cost = np.repeat([0.5 / len(bad), 0.5 / len(good), 0.04 / max(1, len(varied))], sizes)
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        gradient = np.array([np.sum(cost * (p - y) * x) + 1e-4 * a, np.sum(cost * (p - y))])
        curve = cost * np.maximum(p * (1 - p), 1e-6)
        hessian = np.array(
            [[np.sum(curve * x * x) + 1e-4, np.sum(curve * x)], [np.sum(curve * x), np.sum(curve) + 1e-9]]
        )
        step = np.clip(np.linalg.solve(hessian, gradient), -1, 1)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return Weights(weights.triple, weights.offset, float(a), float(-b / a) if a else 0.0)


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row with the machine that the labelled texts of a task give."""
    kinds: tuple[list[Collection[str]], list[Collection[str]]] = [], []
    for batch in batches:
        for toxic, text in zip(batch.column("_toxic").to_pylist(), batch.column("text"), strict=True):
            # A set would take several times the room.
            kinds[int(toxic)].append(tuple(map(sys.intern, units_of(text.as_py()))))
    w = train(kinds[1], kinds[0])
    row = {"triple": [w.triple.tobytes()], "offset": [w.offset], "slope": [w.slope], "middle": [w.middle]}
    yield pa.RecordBatch.from_pydict(row)


def _fold(doc_id):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def learned(docs: DataFrame, labels: DataFrame) -> Weights:
    """Train on a bounded sample of labelled rows that aren't held out.

    So many labels of each kind, in the order of their ids' hashes, are joined with `docs`.
    """
    own = labels.where("doc_id is not null and toxic is not null").where(_fold(F.col("doc_id")) != HELD_OUT)
    own = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    picked = own.where("toxic = 1").orderBy(*order).limit(TOXIC_SAMPLE)
    picked = picked.unionAll(own.where("toxic = 0").orderBy(*order).limit(CLEAN_SAMPLE))
    picked = picked.select(F.col("doc_id").alias("_labelled"), F.col("toxic").alias("_toxic"))
    texts = docs.where(F.length("text") <= SAMPLE_CHARS).select("doc_id", "text")
    rows = texts.join(F.broadcast(picked), F.col("doc_id") == F.col("_labelled"))
    # Repeated ids could bring more rows than labels.
    rows = rows.select("_toxic", "text").limit(2 * (TOXIC_SAMPLE + CLEAN_SAMPLE)).coalesce(1)
    found = rows.mapInArrow(_training, "triple binary, offset double, slope double, middle double").first()
    if found is None:
        return NOTHING_LEARNT
    return Weights(np.frombuffer(found["triple"], np.float32), found["offset"], found["slope"], found["middle"])


class Scorer:
    """Scores texts; margins of units are kept, up to a bound."""

    def __init__(self, weights: Weights):
        self.weights = weights
        self.known: dict[str, float] = {}
        self.least = float(weights.unit_margins([""])[0]) if weights.slope else 0.0

    def scores(self, texts: list[str | None]) -> list[float]:
        if not self.weights.slope:
            return [0.0] * len(texts)
        units = [units_of(text) for text in texts]
        if len(self.known) > KEEP_UNITS:
            self.known.clear()
        new = list(set().union(*units).difference(self.known))
        for begin in range(0, len(new), 20_000):
            part = new[begin : begin + 20_000]
            self.known.update(zip(part, self.weights.unit_margins(part).tolist(), strict=True))
        find = self.known.__getitem__
        return [self.weights.score(max(map(find, own), default=self.least)) for own in units]


def _scoring(shared, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                scores = scorer.scores(part.column("text").to_pylist())
                columns = [part.column(name) for name in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], [*names, "score"])

    return run


def scored(docs: DataFrame, weights: Weights, names: list[str]) -> DataFrame:
    """The columns `names` of `docs` and `score`; `names` doesn't hold `score`."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    types = {field.name: field.dataType.simpleString() for field in docs.schema.fields}
    schema = "".join(f"`{name}` {types[name]}, " for name in names) + "score double"
    return docs.select(*dict.fromkeys([*names, "text"])).mapInArrow(_scoring(shared, names), schema)


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` without the rows that score as toxic; columns as they are."""
    names = docs.columns
    inner = {name: f"c{place}" if name != "text" else name for place, name in enumerate(names)}
    renamed = docs.select(*[F.col(f"`{name}`").alias(inner[name]) for name in names])
    rows = scored(renamed, learned(docs, labels), list(inner.values()))
    return rows.where(F.col("score") < REJECT).select(*[F.col(inner[name]).alias(name) for name in names])


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs`."""
    slim = docs.select("doc_id", "text")
    rows = scored(slim, learned(slim, labels), ["doc_id"])
    return rows.select(
        "doc_id",
        (_fold(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= REJECT).cast("int").alias("predicted"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return judged(table(spark, folder, "documents"), table(spark, folder, "labels"))
