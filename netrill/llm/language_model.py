"""Language-model scoring with a log-frequency Bloom filter.

Words and pairs of neighbours are counted over all training texts. A count is stored as
its level, `1 + floor(log2 count)`: an entry for each level up to it goes into a Bloom
filter, and a reader probes levels until one is missing. The filter grows with its entries,
so its false hits stay as rare in any corpus. It gives the probability of a token after
another, `(c(v, w) + M * P(w)) / (c(v) + M)` with `P(w)` as in the base score, all counts
read from the filter.

The model is a table of parts of the hash space, at any size: a part's filter segment is made
where it is read. Texts are dealt into blocks; the different words and pairs of a block are
shuffled to their parts, and their levels come back to the block's texts.

The base score needs exact counts of all words: they lie beside the levels and come back with
them. A block asks for a word once, so no hot key meets in a task. Words are told apart by
their 64-bit digests.

Edge cases: a null or empty text has the end token only; a null doc_id counts as the
empty text in the fold's checksum; repeated rows are counted and scored one by one; an
empty table gives an empty result; with no training texts all counts are 0; further
columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netrill.llm.common import table, written
from netrill.llm.word_codes import pieces_of, word_codes

#: The end token is no word: words hold no blank.
END = b" "
FOLDS, HELD_OUT = 5, 1
#: Entries are stored for counts from here on.
LEAST_COUNT = 1
#: Bits for an entry and probes for a look.
ENTRY_BITS, PROBES = 12, 4
#: Bounds of former broadcasts, of words with exact counts and of the filter. Nothing is broadcast now,
#: and results don't depend on them.
HEAD_WORDS, MOST_BITS = 100_000, 1 << 29
#: Weight of the word's own probability against the pair's count.
WEIGHT = 20.0
#: Parts of the hash space: the counts of one part are merged in one task.
PARTS = 256
#: Tokens whose counts are held in a task before they are given on.
KEEP_TOKENS = 3_000_000
#: Tokens of a block of texts, about, and bytes of a token for that.
BLOCK_TOKENS, TOKEN_BYTES = 1_500_000, 6
MOST_LEVELS = 40

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public constants of splitmix)."""
    x = values + _M1
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def pair_codes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * np.uint64(3) + mixed(second))


def tokens_of(text: str | None) -> list[bytes]:
    """Words with A-Z lowered, then the end."""
    words = (text or "").encode().lower().split()
    words.append(END)
    return words


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def token_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit codes of the tokens of some texts in a row, number of tokens of each text), as by `tokens_of`."""
    import xxhash

    words, sizes = word_codes(texts)
    sizes = sizes + 1
    codes = np.empty(len(words) + len(sizes), np.uint64)
    end = np.zeros(len(codes), np.bool_)
    end[np.cumsum(sizes) - 1] = True
    codes[end] = xxhash.xxh64_intdigest(END)
    codes[~end] = words
    return codes, sizes


def pairs_of(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Codes of (token before, token) for all tokens of some texts; before the first stands an end."""
    before = np.empty_like(codes)
    before[1:] = codes[:-1]
    # Each text ends in the end token, so the one before a text's first token is an end already.
    before[0] = codes[sizes[0] - 1]
    return pair_codes(before, codes)


def thin(codes: np.ndarray) -> bytes:
    """Ascending 32-bit codes as differences, byte plane by byte plane: the upper planes compress to nothing."""
    steps = np.diff(codes.astype(np.uint32), prepend=np.uint32(0))
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def full(data: bytes) -> np.ndarray:
    """The codes that `thin` has written."""
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T)
    return np.cumsum(steps.view(np.uint32).ravel(), dtype=np.uint32)


def packed(codes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """(part, codes, counts) of each part of the hash space; codes ascend."""
    edges = np.searchsorted(codes >> np.uint64(56), np.arange(PARTS + 1, dtype=np.uint64))
    for part in range(PARTS):
        low, high = edges[part], edges[part + 1]
        if low < high:
            # 40 bits of a code: 8 choose the part, 32 are kept.
            yield part, thin((codes[low:high] >> np.uint64(24)).astype(np.uint32)), counts[low:high].tobytes()


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, int)
    return codes[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def high_bits(codes: np.ndarray) -> np.ndarray:
    """The 32 bits of codes after the 8 that choose the part."""
    return (codes >> np.uint64(24)).astype(np.uint32)


def low_bytes(codes: np.ndarray) -> bytes:
    """The last 24 bits of codes, byte plane by byte plane."""
    return codes.astype(np.uint32).view(np.uint8).reshape(-1, 4).T[:3].tobytes()


def whole_codes(part: int, high: np.ndarray, rest: bytes) -> np.ndarray:
    """64-bit codes from their part, `high_bits` and `low_bytes`."""
    planes = np.frombuffer(rest, np.uint8).reshape(3, -1).astype(np.uint64)
    low = planes[0] | planes[1] << np.uint64(8) | planes[2] << np.uint64(16)
    return np.uint64(part) << np.uint64(56) | high.astype(np.uint64) << np.uint64(24) | low


class Sums:
    """Counts by code. What comes waits until it is as much as what is there, so each code is sorted a few times only."""

    def __init__(self) -> None:
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, self.more = 0, 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((codes, counts))
        self.more += len(codes)
        if self.more >= max(self.size, 100_000):
            self._join()

    def _join(self) -> None:
        self.waiting = [summed(*map(np.concatenate, zip(*self.waiting, strict=True)))]
        self.size, self.more = len(self.waiting[0][0]), 0

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """Ascending codes with their sums; nothing is left."""
        if not self.waiting:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._join()
        self.size = 0
        return self.waiting.pop()


COUNTS = "part int, codes binary, rest binary, counts binary"
_COUNTS = pa.schema([("part", pa.int32()), ("codes", pa.binary()), ("rest", pa.binary()), ("counts", pa.binary())])


def _counted(codes: np.ndarray, exact: bool) -> pa.RecordBatch:
    """Packed counts of codes by part; `rest` holds what is left of the codes if they are to be told apart exactly."""
    codes, counts = np.unique(codes, return_counts=True)
    rows = list(packed(codes, counts.astype(np.uint32)))
    ends = np.cumsum([0, *[len(row[2]) // 4 for row in rows]])
    rest = [low_bytes(codes[a:b]) if exact else None for a, b in pairwise(ends)]
    columns = [[row[0] for row in rows], [row[1] for row in rows], rest, [row[2] for row in rows]]
    return pa.RecordBatch.from_pydict(dict(zip(_COUNTS.names, columns, strict=True)), schema=_COUNTS)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a task by part of the hash space: words under their own mixed codes, pairs under pair codes."""
    words: list[np.ndarray] = []
    pairs: list[np.ndarray] = []
    size = 0

    def ended() -> Iterator[pa.RecordBatch]:
        yield _counted(np.concatenate(words), True)
        words.clear()
        yield _counted(np.concatenate(pairs), False)
        pairs.clear()

    for batch in batches:
        for some in pieces_of(batch.column("text")):
            codes, sizes = token_codes(some)
            words.append(mixed(codes))
            pairs.append(pairs_of(codes, sizes))
            size += len(codes)
            if size >= KEEP_TOKENS:
                yield from ended()
                size = 0
    if words:
        yield from ended()


def _merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sum the packed counts of a part; give the codes worth an entry with their levels.

    Words, which come with the `rest` of their codes, are given with exact counts as well.
    """
    part: int | None = None
    entries, words = Sums(), Sums()

    def ended() -> pd.DataFrame:
        codes, counts = entries.taken()
        keep = counts >= LEAST_COUNT
        levels = (np.floor(np.log2(counts[keep])) + 1).astype(np.uint8)
        own, times = words.taken()
        row = {"part": part, "codes": thin(codes[keep]), "levels": levels.tobytes(), "n": int(levels.sum())}
        row |= {"words": thin(high_bits(own)), "rest": low_bytes(own), "counts": times.tobytes()}
        return pd.DataFrame([row | {"distinct": len(own), "total": int(times.sum())}])

    for frame in frames:
        rests = frame["rest"] if "rest" in frame else [None] * len(frame)
        for number, more, rest, times in zip(frame["part"], frame["codes"], rests, frame["counts"], strict=True):
            if number != part:
                if part is not None:
                    yield ended()
                part = number
            codes, counts = full(more), np.frombuffer(times, np.uint32).astype(np.int64)
            entries.add(codes, counts)
            if rest is not None:
                words.add(whole_codes(part, codes, rest), counts)
    if part is not None:
        yield ended()


def _places(part: np.ndarray, codes: np.ndarray, level: int, bits: int) -> Iterator[np.ndarray]:
    """Bits that stand for (code, level) inside the segment of a part."""
    x = mixed((codes.astype(np.uint64) << np.uint64(8)) + np.uint64(level))
    y = mixed(x) | np.uint64(1)
    base, bits = part.astype(np.uint64) * np.uint64(bits), np.uint64(bits)
    for probe in range(PROBES):
        place = x + np.uint64(probe) * y
        # The remainder by a division, which numpy does faster.
        yield base + (place - place // bits * bits)


def segment(codes: np.ndarray, levels: np.ndarray, bits: int) -> np.ndarray:
    """Bloom bits of a part, packed."""
    bitmap = np.zeros(bits, np.bool_)
    for level in range(1, int(levels.max(initial=0)) + 1):
        own = codes[levels >= level]
        for places in _places(np.zeros(len(own), np.uint64), own, level, bits):
            bitmap[places] = True
    return np.packbits(bitmap)


def _segments(bits: int):
    """Bloom bits of each part; a segment's size is the same for all."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, raw, levels in zip(frame["part"], frame["codes"], frame["levels"], strict=True):
                data = segment(full(raw), np.frombuffer(levels, np.uint8), bits)
                yield pd.DataFrame({"part": [part], "bits": [data.tobytes()]})

    return run


def middles(levels: np.ndarray) -> np.ndarray:
    """The middle of a level's counts, 2^(l-1) to 2^l - 1; nothing stored reads as 0."""
    return np.where(levels > 0, 1.5 * 2.0 ** (levels - 1) - 0.5, 0.0)


class Filter:
    """Reads levels back and turns them into counts."""

    def __init__(self, bits: int, data: np.ndarray):
        self.bits, self.data = bits, data

    def counts(self, codes: np.ndarray) -> np.ndarray:
        return middles(self.levels(codes >> np.uint64(56), (codes >> np.uint64(24)).astype(np.uint32)))

    def levels(self, part: np.ndarray, short: np.ndarray) -> np.ndarray:
        levels = np.zeros(len(short), np.int64)
        active = np.arange(len(short))
        for level in range(1, MOST_LEVELS):
            held = np.ones(len(active), np.bool_)
            for places in _places(part[active], short[active], level, self.bits):
                byte = self.data[(places >> np.uint64(3)).view(np.int64)]
                held &= (byte >> (np.uint64(7) - (places & np.uint64(7))).astype(np.uint8)) & 1 == 1
            active = active[held]
            if not len(active):
                break
            levels[active] = level
        return levels


class Tokens:
    """Tokens of some texts in a row, with the different words and pairs among them in ascending order of codes."""

    def __init__(self, texts: pa.ChunkedArray):
        parts = [token_codes(some) for some in pieces_of(texts)]
        codes = np.concatenate([np.zeros(0, np.uint64), *[own for own, _ in parts]])
        self.sizes = np.concatenate([np.zeros(0, np.int64), *[own for _, own in parts]])
        self.words, self.word = np.unique(mixed(codes), return_inverse=True)
        before = np.empty_like(self.word)
        before[1:] = self.word[:-1]
        before[0] = self.word[self.sizes[0] - 1]
        self.pairs, first, self.pair = np.unique(pairs_of(codes, self.sizes), return_index=True, return_inverse=True)
        #: The two words of each different pair.
        self.first, self.second = before[first], self.word[first]

    def by_text(self, values: np.ndarray) -> np.ndarray:
        """Sums over the tokens of each text."""
        return np.add.reduceat(values, np.cumsum(self.sizes) - self.sizes)


#: A part of the model (`block` null), or what a block of texts asks of it and, with levels and counts, is told:
#: words by their whole codes, pairs by 32 bits. A model's codes are those of words and pairs together.
LOOKS = "block bigint, part int, words binary, rest binary, codes binary, levels binary, counts binary"
_LOOKS = pa.schema(
    [("block", pa.int64()), ("part", pa.int32())]
    + [(name, pa.binary()) for name in ("words", "rest", "codes", "levels", "counts")]
)


def _looks(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_LOOKS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _LOOKS.types, strict=True)], schema=_LOOKS)


def _edges(codes: np.ndarray) -> np.ndarray:
    """Where the parts of ascending codes begin and end."""
    return np.searchsorted(codes >> np.uint64(56), np.arange(PARTS + 1, dtype=np.uint64))


def _asking(texts: pa.Table) -> pa.Table:
    """The different words and pairs of a block, by part."""
    tokens = Tokens(texts.column("text"))
    block, rows = texts.column("block")[0].as_py(), []
    edges = zip(pairwise(_edges(tokens.words)), pairwise(_edges(tokens.pairs)), strict=True)
    for part, ((a, b), (c, d)) in enumerate(edges):
        if a < b or c < d:
            words = tokens.words[a:b]
            rows.append((block, part, thin(high_bits(words)), low_bytes(words), thin(high_bits(tokens.pairs[c:d])), None, None))
    return pa.Table.from_batches([_looks(rows)])


def _look_up(bits: int):
    """Levels and exact counts for the rows that follow their part of the model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_, known, times, at = None, None, None, None

        def told(rows: list[dict]) -> pa.RecordBatch:
            """Answers to rows of one part, looked up together."""
            part = rows[0]["part"]
            high, pairs = [full(row["words"]) for row in rows], [full(row["codes"]) for row in rows]
            codes, place = np.unique(np.concatenate([*high, *pairs]), return_inverse=True)
            words, spot = np.unique(
                np.concatenate([whole_codes(part, h, row["rest"]) for h, row in zip(high, rows, strict=True)]),
                return_inverse=True,
            )
            counts, levels = np.zeros(len(words), np.int64), np.zeros(len(codes), np.uint8)
            # With no training texts a part has no model.
            if part == at:
                levels = filter_.levels(np.zeros(len(codes), np.uint64), codes).astype(np.uint8)
                if len(known):
                    near = np.minimum(np.searchsorted(known, words), len(known) - 1)
                    counts = np.where(known[near] == words, times[near], 0)
            levels, counts = levels[place], counts[spot]
            a, c, out = 0, sum(map(len, high)), []
            for row, own, other in zip(rows, high, pairs, strict=True):
                b, d = a + len(own), c + len(other)
                out.append((row["block"], part, None, None, levels[c:d].tobytes(), levels[a:b].tobytes(), counts[a:b].tobytes()))
                a, c = b, d
            return _looks(out)

        for batch in batches:
            waiting: list[dict] = []
            size = 0
            for row in batch.to_pylist():
                if waiting and (row["part"] != waiting[0]["part"] or size >= KEEP_TOKENS):
                    yield told(waiting)
                    waiting, size = [], 0
                if row["block"] is None:
                    at, codes = row["part"], full(row["codes"])
                    filter_ = Filter(bits, segment(codes, np.frombuffer(row["levels"], np.uint8), bits))
                    known = whole_codes(at, full(row["words"]), row["rest"])
                    times = np.frombuffer(row["counts"], np.int64)
                else:
                    waiting.append(row)
                    size += (len(row["words"]) + len(row["codes"])) // 4
            if waiting:
                yield told(waiting)

    return run


SCORED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def _scoring(total: int, distinct: int):
    """Scored rows of a block from its texts and the answers to it."""
    floor = total + 0.5 * (distinct + 1)

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        tokens = Tokens(texts.column("text"))
        answers = answers.sort_by("part")

        def joined(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(b"".join(answers.column(name).to_pylist()), kind)

        # The answers' `codes` are the levels of pairs, `levels` those of words.
        own, pairs = middles(joined("levels", np.uint8).astype(np.int64)), middles(joined("codes", np.uint8).astype(np.int64))
        counts = joined("counts", np.int64)
        before = own[tokens.first]
        alone = (own[tokens.second] + 0.5) / floor
        logs = np.log10((np.minimum(pairs, before) + WEIGHT * alone) / (before + WEIGHT))
        base = np.log10((counts + 0.5) / floor)
        ids = texts.column("doc_id").to_pylist()
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "held_out": pa.array(map(held_out, ids), pa.bool_()),
                "n_tokens": pa.array(tokens.sizes, pa.int64()),
                "n_known": pa.array(tokens.by_text((counts > 0).astype(np.int64)[tokens.word]), pa.int64()),
                "train_tokens": pa.array([total] * len(ids), pa.int64()),
                "base_score": pa.array(tokens.by_text(base[tokens.word]), pa.float64()),
                "score": pa.array(tokens.by_text(logs[tokens.pair]), pa.float64()),
            }
        )

    return run


MODEL = (
    "part int, codes binary, levels binary, n bigint, words binary, rest binary, counts binary, "
    "distinct bigint, total bigint"
)


def learned(docs: DataFrame) -> tuple[DataFrame, int, int, int]:
    """The written model of `docs` (text), a row for each part; bits of a segment, tokens and different tokens."""
    parts = docs.select("text").mapInArrow(_counter, COUNTS).repartition(PARTS, "part").sortWithinPartitions("part")
    model = written(parts.mapInPandas(_merge, MODEL), "lm-model")
    sums = [F.coalesce(F.sum(name), F.lit(0)) for name in ("total", "distinct")]
    largest, total, distinct = model.agg(F.coalesce(F.max("n"), F.lit(0)), *sums).first()
    return model, max(64, -(-int(largest) * ENTRY_BITS // 64) * 64), int(total), int(distinct)


def scored(docs: DataFrame, train: DataFrame) -> DataFrame:
    """Base and model scores of `docs` (doc_id, text), learnt from the rows of `train`."""
    model, bits, total, distinct = learned(train)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = slim.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # Blocks go by the rows' own digests: both uses of the texts then see the same blocks, from one shuffle.
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 + int(size) // (TOKEN_BYTES * BLOCK_TOKENS)))
    texts = slim.select(block.alias("block"), "doc_id", "text").groupBy("block")
    nothing = F.lit(None).cast("bigint").alias("block")
    asked = model.select(nothing, "part", "words", "rest", "codes", "levels", "counts")
    asked = asked.unionByName(texts.applyInArrow(_asking, LOOKS))
    asked = asked.repartition(PARTS, "part").sortWithinPartitions("part", F.asc_nulls_first("block"))
    answers = asked.mapInArrow(_look_up(bits), LOOKS)
    return texts.cogroup(answers.groupBy("block")).applyInArrow(_scoring(total, distinct), SCORED)


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))
    return scored(docs, docs.where(fold != HELD_OUT))
