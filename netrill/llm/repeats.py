"""Exact substring deduplication by sampled suffixes and deep-shallow sorting.

Removed is every byte inside a string of LENGTH bytes that also starts elsewhere. Each such
string is assigned to an anchor: the leftmost smallest hash of the GRAM-byte strings in
it. Equal strings have their anchor at the same place inside, so it is enough to compare
anchors of one hash, with the bytes around them; only these suffixes, one in some 170, are
sorted. The steps:

1. anchors of all texts, written without their bytes;
2. hashes that occur at two places or more (partial sums by key);
3. texts that hold such anchors are brought together with them, equal texts once;
4. contexts of these anchors meet by hash; equal contexts are put together in each task
   first, then the suffixes after the anchor are sorted and compared (`deep_shallow`);
5. the repeated stretches of a text are merged and cut out.

Equal texts need no comparison to be removed whole; one of them stands for all in 3-4.

Edge cases: a null text is empty; texts under LENGTH bytes keep everything; a null doc_id
stays null; repeated rows are equal texts, each of which is removed; overlapping and
adjoining stretches are one span; an empty table gives an empty result; further columns
are not read. Texts of any length are read whole, in pieces that overlap. The contexts of
one hash meet in one task: with a hot passage this is a row of under a kilobyte for each
different surrounding of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netrill.llm.common import table, written
from netrill.llm.deep_shallow import extents

LENGTH, GRAM = 400, 64
#: Starts of GRAM-byte strings inside a string of LENGTH bytes.
STARTS = LENGTH - GRAM + 1
#: Bytes hashed in one go; longer texts are cut into pieces.
PIECE = 2_000_000

_G1, _G2, _G3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BYTES = (np.arange(1, 257, dtype=np.uint64) * _G1) ^ (np.arange(1, 257, dtype=np.uint64) * _G3 >> np.uint64(29))


def _gram_codes(data: np.ndarray) -> np.ndarray:
    """A 64-bit code of the GRAM bytes from each place; built by doubling."""
    codes, width, factor = _BYTES[data], 1, 0xBF58476D1CE4E5B9
    while width < GRAM:
        codes = codes[:-width] * np.uint64(factor) + codes[width:]
        factor = (factor * factor + 2 * width * 0x9E3779B97F4A7C15) % 2**64 | 1
        width *= 2
    codes ^= codes >> np.uint64(31)
    codes *= _G3
    codes ^= codes >> np.uint64(29)
    return codes


def _smallest(values: np.ndarray) -> np.ndarray:
    """Smallest of STARTS values from each place; built by doubling."""
    width = 1
    while 2 * width <= STARTS:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = STARTS - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _chunk_anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, place, first, last) of the anchors of some texts in a row that end at `ends`.

    An anchor at `place` serves the strings that start at `first` to `last`.
    """
    codes = _gram_codes(data)
    # The place in the low bits makes the leftmost of equal hashes the smallest.
    low = np.uint64((1 << 24) - 1)
    values = (codes & ~low) | np.arange(len(codes), dtype=np.uint64)
    anchor = (_smallest(values) & low).astype(np.int64)
    starts = np.arange(len(anchor))
    own_end = ends[np.searchsorted(ends, starts, side="right")]
    valid = np.flatnonzero(starts + LENGTH <= own_end)
    if not len(valid):
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, nothing
    chosen = anchor[valid]
    new = np.r_[True, (chosen[1:] != chosen[:-1]) | (valid[1:] != valid[:-1] + 1)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:] - 1, len(valid) - 1]
    place = chosen[first]
    return codes[place].astype(np.int64), place, valid[first], valid[last]


def anchors(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(number of the text, keys, places, first and last starts); a long text may come in parts."""

    def pieces() -> Iterator[tuple[int, int, bytes]]:
        for number, text in enumerate(texts):
            if len(text) >= LENGTH:
                for begin in range(0, len(text) - LENGTH + 1, PIECE):
                    # The next piece begins where this one's last string starts, plus one.
                    yield number, begin, text[begin : begin + PIECE + LENGTH - 1]

    def ended(chunk: list[tuple[int, int, bytes]]):
        data = np.frombuffer(b"".join(piece for _, _, piece in chunk), np.uint8)
        sizes = [len(piece) for _, _, piece in chunk]
        ends = np.cumsum(sizes)
        keys, place, first, last = _chunk_anchors(data, ends)
        owner = np.searchsorted(ends, first, side="right")
        edges = np.searchsorted(owner, np.arange(len(chunk) + 1))
        for at, (number, begin, _) in enumerate(chunk):
            own = slice(edges[at], edges[at + 1])
            shift = begin - (ends[at] - sizes[at])
            yield number, keys[own], place[own] + shift, first[own] + shift, last[own] + shift

    chunk, size = [], 0
    for piece in pieces():
        chunk.append(piece)
        size += len(piece[2])
        if size >= PIECE:
            yield from ended(chunk)
            chunk, size = [], 0
    if chunk:
        yield from ended(chunk)


def _bytes_of(column: pa.Array) -> list[bytes]:
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def _anchoring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = batch.column("code").to_pylist()
        for begin in range(0, batch.num_rows, 1000):
            found = list(anchors(_bytes_of(batch.column("text").slice(begin, 1000))))
            if found:
                owners = [codes[begin + number] for number, keys, *_ in found for _ in range(len(keys))]
                columns = [np.concatenate([one[at] for one in found]) for at in range(1, 5)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owners, pa.binary()), *[pa.array(column, pa.int64()) for column in columns]],
                    ["code", "key", "place", "first", "last"],
                )


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes before (backwards) and after each open anchor; equal contexts of a batch once, with all owners."""
    for batch in batches:
        held: dict[tuple[int, bytes, bytes], list[tuple[bytes, int]]] = {}
        size = 0

        def ended() -> pa.RecordBatch:
            rows = list(held.items())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([key for (key, _, _), _ in rows], pa.int64()),
                    pa.array([left for (_, left, _), _ in rows], pa.binary()),
                    pa.array([right for (_, _, right), _ in rows], pa.binary()),
                    pa.array([[{"code": c, "place": p} for c, p in owners] for _, owners in rows], _OWNERS),
                ],
                ["key", "left", "right", "owners"],
            )

        for code, text, found in zip(
            batch.column("code").to_pylist(),
            _bytes_of(batch.column("text")),
            batch.column("anchors").to_pylist(),
            strict=True,
        ):
            for one in found:
                place = one["place"]
                left = text[one["first"] : place][::-1]
                right = text[place : one["last"] + LENGTH]
                held.setdefault((one["key"], left, right), []).append((code, place))
                size += len(left) + len(right)
                if size > 16_000_000:
                    yield ended()
                    held.clear()
                    size = 0
        if held:
            yield ended()


_OWNERS = pa.list_(pa.struct([("code", pa.binary()), ("place", pa.int64())]))


def _comparing(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated stretches (code, begin, end) of contexts that come sorted by key."""
    key = None
    group: dict[tuple[bytes, bytes], list[tuple[bytes, int]]] = {}
    out: list[tuple[bytes, int, int]] = []

    def compare() -> None:
        contexts = list(group)
        reach = [(0, 0)] * len(contexts)
        if len(contexts) > 1:
            reach = extents([left for left, _ in contexts], [right for _, right in contexts], LENGTH)
        for (left, right), (before, after) in zip(contexts, reach, strict=True):
            owners = group[left, right]
            if len(owners) > 1:
                before, after = len(left), len(right)
            if before + after >= LENGTH:
                out.extend((code, place - before, place + after) for code, place in owners)

    def rows() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array([row[0] for row in out], pa.binary()),
                pa.array([row[1] for row in out], pa.int64()),
                pa.array([row[2] for row in out], pa.int64()),
            ],
            ["code", "begin", "end"],
        )
        out.clear()
        return batch

    for batch in frames:
        columns = [batch.column(name).to_pylist() for name in ("key", "left", "right", "owners")]
        for now, left, right, owners in zip(*columns, strict=True):
            if now != key:
                if len(group) > 1 or any(len(o) > 1 for o in group.values()):
                    compare()
                group.clear()
                key = now
            group.setdefault((left, right), []).extend((o["code"], o["place"]) for o in owners)
        if len(out) > 20_000:
            yield rows()
    if group:
        compare()
    yield rows()


def _cutting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the stretches of each text and cut them out."""
    for batch in batches:
        removed, spans, digests = [], [], []
        for text, copies, stretches in zip(
            _bytes_of(batch.column("text")),
            batch.column("copies").to_pylist(),
            batch.column("stretches").to_pylist(),
            strict=True,
        ):
            if copies > 1 and len(text) >= LENGTH:
                stretches = [{"begin": 0, "end": len(text)}]
            kept, at, n, gone = hashlib.sha256(), 0, 0, 0
            for one in sorted(stretches or (), key=lambda s: s["begin"]):
                begin, end = one["begin"], one["end"]
                # A stretch that begins after the last one's end is a span of its own.
                if not n or begin > at:
                    kept.update(text[at:begin])
                    n += 1
                    at = begin
                gone += max(0, end - at)
                at = max(at, end)
            kept.update(text[at:])
            removed.append(gone)
            spans.append(n)
            digests.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("code"),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.int64()),
                pa.array(digests, pa.string()),
            ],
            ["code", "n_removed", "n_spans", "kept_sha256"],
        )


RESULT = "code binary, n_removed bigint, n_spans bigint, kept_sha256 string"


def stretches(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(written distinct texts with repeated anchors, repeated stretches (code, begin, end) of them).

    `docs` has (code, text); the first result also holds `copies`.
    """
    found = docs.mapInArrow(
        _anchoring, "code binary, key bigint, place bigint, first bigint, last bigint"
    )
    found = written(found, "repeat-anchors")
    # A hash at two places: by a code of (text, place), so that equal texts don't count twice.
    spot = F.xxhash64("code", "place")
    twice = found.groupBy("key").agg(F.min(spot).alias("low"), F.max(spot).alias("high"))
    # Written, so that both sides of the join are plain shuffles and a hot key can be split.
    twice = written(twice.where("low <> high").select("key"), "repeat-keys")
    open_ = found.join(twice, "key", "left_semi")
    open_ = open_.groupBy("code").agg(F.collect_set(F.struct("key", "place", "first", "last")).alias("anchors"))
    texts = docs.groupBy("code").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    held = written(texts.join(open_, "code", "left"), "repeat-texts")
    contexts = held.where("anchors is not null").select("code", "text", "anchors")
    contexts = contexts.mapInArrow(
        _contexts, "key bigint, left binary, right binary, owners array<struct<code:binary,place:bigint>>"
    )
    contexts = contexts.repartition("key").sortWithinPartitions("key")
    return held, contexts.mapInArrow(_comparing, "code binary, begin bigint, end bigint")


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of `docs`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.unhex(F.md5(text)).alias("code"))
    held, found = stretches(rows.select("code", "text"))
    found = found.groupBy("code").agg(F.collect_list(F.struct("begin", "end")).alias("stretches"))
    # Texts without repeated anchors that occur once need no cut and no second shuffle.
    plain = held.where("anchors is null and copies = 1").select(
        "code", F.lit(0).cast("long"), F.lit(0).cast("long"), F.sha2(F.col("text").cast("binary"), 256)
    )
    others = held.where("anchors is not null or copies > 1").select("code", "text", "copies")
    cut = others.join(found, "code", "left").mapInArrow(_cutting, RESULT)
    results = written(plain.unionAll(cut).toDF("code", "n_removed", "n_spans", "kept_sha256"), "repeat-results")
    slim = rows.select("doc_id", "code", F.octet_length("text").cast("long").alias("n_bytes"))
    return slim.join(results, "code").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """The contract's columns, and `repeated`: whether anything was removed."""
    rows = removed(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.withColumn("repeated", F.col("n_removed") > 0)
