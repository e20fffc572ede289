"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time.

Items are taken in blocks of bounded size; each block's terms are looked up in every
document. Documents go into segments, a segment being the whole inverted index of at most
SEGMENT postings of the terms asked for (a longer document has one of its own): one list
of documents and counts a term. Corpus statistics are sums over the segments.

A segment is searched item by item. Its short lists are summed term at a time into
accumulators, which from then on act as one list with a bound, the largest sum. That list
and the long lists are walked document at a time in strides of ascending documents: a
stride whose bounds together cannot reach the item's present k-th score is skipped in all
lists, and in the others the lists are probed by descending bound, only for documents
which the bounds left over still let into the result. Bounds are exact integers and a
document that could tie is never skipped, so the result is exact.

Each task hands on at most k documents an item, and a window picks the k of all.

Rows with one item_id are one item, whose terms are those of all its texts; a null item_id
is an item too. Every row of documents counts, rows with one doc_id each on their own, a
null doc_id last among ties. Null or empty texts have no term and match nothing, and empty
tables give an empty result. Only doc_id, text and item_id are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netrill.llm.common import table, written

TOP = 50
#: Bytes of item texts that are searched for together; one pass over the documents each.
ITEM_BYTES = 4 << 20
#: Postings of a segment.
SEGMENT = 1 << 19
#: Lists of under this share of a segment's documents are short.
SHORT_SHARE = 1 / 16
#: Documents of a stride.
STRIDE = 1024

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_CASE = str.maketrans(UPPER, LOWER)
NO_ID = np.iinfo(np.int64).max

INDEX = (
    "docs array<bigint>, sizes array<bigint>, terms array<int>, ends array<int>, "
    "places array<int>, counts array<bigint>, n_docs bigint, n_terms bigint"
)
FOUND = "item int, doc_id bigint, no_id boolean, score bigint"


def terms_of(text: str | None) -> list[str]:
    return _TERM.findall(text.translate(_CASE)) if text else []


def _indexing(vocabulary):
    """Segments of a partition's documents; `vocabulary` is a broadcast of term numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = vocabulary.value
        segment = _Segment()
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                terms = terms_of(text.as_py())
                if not terms:
                    continue
                counts = Counter(terms)
                held = [(numbers[t], c) for t, c in counts.items() if t in numbers]
                segment.add(doc, len(terms), held)
                if len(segment.counts) >= SEGMENT:
                    yield segment.row()
                    segment = _Segment()
        if segment.n_docs:
            yield segment.row()

    return run


class _Segment:
    def __init__(self) -> None:
        self.docs, self.sizes, self.terms, self.places, self.counts = [], [], [], [], []
        self.n_docs = self.n_terms = 0

    def add(self, doc: int | None, size: int, held: list[tuple[int, int]]) -> None:
        self.n_docs += 1
        self.n_terms += size
        if held:
            place = len(self.docs)
            self.docs.append(doc)
            self.sizes.append(size)
            self.terms.extend(t for t, _ in held)
            self.counts.extend(c for _, c in held)
            self.places.extend([place] * len(held))

    def row(self) -> pa.RecordBatch:
        terms = np.array(self.terms, np.int32)
        order = np.argsort(terms, kind="stable")
        terms = terms[order]
        last = np.flatnonzero(np.diff(terms, append=-1))
        columns = [
            pa.array([self.docs], pa.list_(pa.int64())),
            pa.array([self.sizes], pa.list_(pa.int64())),
            pa.array([terms[last]], pa.list_(pa.int32())),
            pa.array([(last + 1).astype(np.int32)], pa.list_(pa.int32())),
            pa.array([np.array(self.places, np.int32)[order]], pa.list_(pa.int32())),
            pa.array([np.array(self.counts, np.int64)[order]], pa.list_(pa.int64())),
            pa.array([self.n_docs], pa.int64()),
            pa.array([self.n_terms], pa.int64()),
        ]
        names = [part.split()[0] for part in INDEX.split(", ")]
        return pa.RecordBatch.from_arrays(columns, names)


class Best:
    """An item's best k (score, document) so far; ties go to the smaller document."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.scores = np.zeros(0, np.int64)
        self.docs = np.zeros(0, np.int64)
        #: Scores below this can't enter.
        self.least = 1

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        scores, docs = np.concatenate([self.scores, scores]), np.concatenate([self.docs, docs])
        order = np.lexsort((docs, -scores))[: self.top]
        self.scores, self.docs = scores[order], docs[order]
        if len(order) == self.top:
            self.least = int(self.scores[-1])


class Postings:
    """One ascending list of documents (by place) and their impacts, with its bound."""

    def __init__(self, places: np.ndarray, impacts: np.ndarray) -> None:
        self.places, self.impacts = places, impacts
        self.bound = int(impacts.max())

    def stride_bounds(self, strides: int) -> np.ndarray:
        """The largest impact in each stride of documents."""
        out = np.zeros(strides, np.int64)
        np.maximum.at(out, self.places // STRIDE, self.impacts)
        return out

    def probe(self, places: np.ndarray) -> np.ndarray:
        """Impacts of ascending places, 0 where the list lacks them."""
        at = np.searchsorted(self.places, places)
        at[at == len(self.places)] = 0
        return np.where(self.places[at] == places, self.impacts[at], 0)

    def between(self, low: int, high: int) -> np.ndarray:
        return self.places[np.searchsorted(self.places, low) : np.searchsorted(self.places, high)]


def accumulated(lists: list[Postings]) -> Postings:
    """Short lists summed term at a time into one."""
    places, where = np.unique(np.concatenate([x.places for x in lists]), return_inverse=True)
    sums = np.zeros(len(places), np.int64)
    begin = 0
    for one in lists:
        sums[where[begin : begin + len(one.places)]] += one.impacts
        begin += len(one.places)
    return Postings(places, sums)


def search(lists: list[Postings], n_docs: int, docs: np.ndarray, best: Best) -> int:
    """Bring the best documents of a segment into `best`; the number of strides looked into."""
    short = [x for x in lists if len(x.places) < n_docs * SHORT_SHARE]
    walked = [x for x in lists if len(x.places) >= n_docs * SHORT_SHARE]
    if short:
        walked.append(accumulated(short) if len(short) > 1 else short[0])
    walked.sort(key=lambda x: -x.bound)
    if sum(x.bound for x in walked) < best.least:
        return 0
    strides = -(-n_docs // STRIDE)
    bounds = np.array([x.stride_bounds(strides) for x in walked])
    # What the lists from each one on can still add, by stride.
    rest = np.cumsum(bounds[::-1], axis=0)[::-1]
    looked = 0
    for stride in np.flatnonzero(rest[0] >= best.least).tolist():
        if rest[0, stride] < best.least:
            continue
        looked += 1
        low = stride * STRIDE
        high = low + STRIDE
        scores = np.zeros(STRIDE, np.int64)
        live = np.zeros(STRIDE, bool)
        for number, one in enumerate(walked):
            left = int(rest[number, stride])
            if not left:
                break
            if left >= best.least:
                # A document that no list so far holds may still enter.
                live[one.between(low, high) - low] = True
            live &= scores + left >= best.least
            at = np.flatnonzero(live)
            if len(at):
                scores[at] += one.probe(at + low)
        at = np.flatnonzero(live & (scores >= best.least))
        if len(at):
            best.add(scores[at], docs[at + low])
    return looked


def _searching(statistics, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = statistics.value
        weights, items, n, total = shared["weights"], shared["items"], shared["n"], shared["total"]
        best = [Best(top) for _ in items]
        for batch in batches:
            for row in range(batch.num_rows):
                one = {name: batch.column(name)[row].values for name in batch.schema.names if name[:2] != "n_"}
                docs = one["docs"].fill_null(NO_ID).to_numpy(zero_copy_only=False)
                terms, ends, places, counts, sizes = (
                    one[name].to_numpy(zero_copy_only=False) for name in ("terms", "ends", "places", "counts", "sizes")
                )
                if not len(terms):
                    continue
                m = 100 - 50 + (50 * sizes * n) // total
                impacts = (1_000_000_000 * counts) // (1000 * counts + 20 * m[places])
                lists = {}
                for begin, end, term in zip([0, *ends[:-1].tolist()], ends.tolist(), terms.tolist(), strict=True):
                    if weights[term]:
                        lists[term] = Postings(places[begin:end], weights[term] * impacts[begin:end])
                for number, wanted in enumerate(items):
                    if held := [lists[t] for t in wanted if t in lists]:
                        search(held, len(docs), docs, best[number])
        sizes = [len(x.docs) for x in best]
        found = np.concatenate([x.docs for x in best]) if best else np.zeros(0, np.int64)
        scores = np.concatenate([x.scores for x in best]) if best else np.zeros(0, np.int64)
        columns = [
            pa.array(np.repeat(np.arange(len(best), dtype=np.int32), sizes)),
            pa.array(found),
            pa.array(found == NO_ID),
            pa.array(scores),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "no_id", "score"])

    return run


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _block(docs: DataFrame, items: list[tuple[int | None, list[str]]], top: int) -> DataFrame:
    """item_id, rank, doc_id, score for the items of one block."""
    spark = docs.sparkSession
    vocabulary: dict[str, int] = {}
    wanted: dict[int | None, set[int]] = {}
    for item, texts in items:
        held = wanted.setdefault(item, set())
        for text in texts:
            held.update(vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(text))
    shared = spark.sparkContext.broadcast(vocabulary)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index = written(slim.mapInArrow(_indexing(shared), INDEX), "lexical-index")
    n, total = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    lists = F.arrays_zip("terms", "ends", F.array_insert(F.col("ends"), 1, F.lit(0)).alias("begins"))
    lists = index.select(F.explode(lists).alias("list")).where("list.terms is not null")
    sizes = lists.groupBy(F.col("list.terms").alias("term"))
    sizes = sizes.agg(F.sum(F.col("list.ends") - F.col("list.begins")).alias("df"))
    # One row a term of the block, so bounded by the block's bytes.
    weights = [0] * len(vocabulary)
    for term, df in sizes.collect():
        weights[term] = weight(n, df)
    facts = {"weights": weights, "items": [sorted(x) for x in wanted.values()], "n": n, "total": total}
    found = index.mapInArrow(_searching(spark.sparkContext.broadcast(facts), top), FOUND)
    order = Window.partitionBy("item").orderBy(F.desc("score"), "no_id", "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame(list(enumerate(wanted)), "item int, item_id bigint")
    doc_id = F.when(~F.col("no_id"), F.col("doc_id"))
    return ranked.join(names, "item").select("item_id", "rank", doc_id.alias("doc_id"), "score")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """Each item's `top` documents: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // ITEM_BYTES) or 1
    rows = rows.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    parts = []
    for number in range(blocks):
        held = rows.where(F.col("block") == number).groupBy("item_id").agg(F.collect_set("text").alias("texts"))
        block = [(r["item_id"], r["texts"]) for r in held.toLocalIterator()]
        if block:
            parts.append(_block(docs, block, top))
    if not parts:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def query(spark: SparkSession, folder: str) -> DataFrame:
    return ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL = rf"""
with doc_terms as (
  select doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents),
sizes as (select doc_id, count(*) as n from doc_terms group by doc_id),
totals as (select count(*) as docs, cast(sum(n) as bigint) as terms from sizes),
wanted as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
counts as (
  select doc_id, term, count(*) as tf from doc_terms
  where term in (select term from wanted) group by doc_id, term),
weights as (
  select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) as w
  from counts, totals group by term, docs),
impacts as (
  select c.doc_id, c.term,
    w.w * ((1000000000 * c.tf) // (1000 * c.tf + 20 * (100 - 50 + (50 * s.n * t.docs) // t.terms))) as impact
  from counts c join weights w using (term) join sizes s using (doc_id), totals t),
scores as (
  select item_id, doc_id, cast(sum(impact) as bigint) as score
  from wanted join impacts using (term) group by item_id, doc_id)
select item_id, cast(rank as integer) as rank, doc_id, score from (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank
  from scores where score > 0)
where rank <= {TOP}
"""
