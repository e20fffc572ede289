"""Near-duplicates by an inverted join of MinHash coordinates.

Texts with one shingle set are one class. A class has COORDINATES minima; it is posted
under those (coordinate, value) pairs that another class has too. Two classes with at
least AGREE equal coordinates share one of the first `n - AGREE + 1` of their n postings
in any common order (prefix), and rare pairs come first, so hot ones are left out. From the
postings candidates are taken in two turns. First each class meets the smallest class of
each of its postings, which joins a group of copies by links that grow with its size, not
with its square. Then only postings whose classes are still in different components are
merged, in pairs of blocks of bounded size: pairs of one component are skipped, equal
coordinates are counted, and pairs with AGREE or more are confirmed where they meet. A
pair of blocks gives no pair out but the links that join components not yet joined by it,
so its output stays below its number of classes. All candidates are confirmed on the full
sets, by 100 * intersection >= 75 * union.

With the given numbers a pair of similarity 0.75 has fewer equal coordinates than AGREE
with a probability below 1 in 200,000, and a larger similarity far below that.

Edge cases: null texts, and texts without words, have the empty set and are linked with
nothing; a null doc_id takes part and counts as larger than any other, and a component of
nulls has a null component_id (its rows are kept); repeated rows are rows of one class;
rows of one doc_id with different texts are separate; an empty table gives an empty
result; `distinct` keeps further columns under their names, others don't read them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from netrill.llm.common import table, written
from netrill.llm.components import components

WORDS = 5
COORDINATES, AGREE = 64, 30
SIMILAR = 75
#: Classes of a posting, and shingles of these, that are merged with one another in one group.
BLOCK, BLOCK_SHINGLES = 1500, 4_000_000

_G1, _G2, _G3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public constants of splitmix)."""
    x = x + _G1
    x = (x ^ (x >> np.uint64(30))) * _G2
    x = (x ^ (x >> np.uint64(27))) * _G3
    return x ^ (x >> np.uint64(31))


_SEEDS = _mixed(np.arange(1, 2 * COORDINATES + WORDS + 2, dtype=np.uint64) * _G2)
_FACTORS = _SEEDS[:COORDINATES].astype(np.uint32) | np.uint32(1)
_OFFSETS = _SEEDS[COORDINATES : 2 * COORDINATES].astype(np.uint32)
_PLACES, _STEP = _SEEDS[2 * COORDINATES : -1] | np.uint64(1), _SEEDS[-1] | np.uint64(1)
_BYTES = _mixed(np.arange(256, dtype=np.uint64))
_BYTES[65:91] = _BYTES[97:123]  # A-Z as a-z
_BLANK = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
_BYTES[_BLANK] = 0


class Shingler:
    """Shingle sets as sorted 64-bit codes, worked out for a whole text at a time."""

    def __init__(self) -> None:
        self.powers = np.ones(1, np.uint64)

    def __call__(self, text: str | None) -> np.ndarray:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        solid = ~_BLANK[raw]
        starts = np.flatnonzero(solid[1:] & ~solid[:-1]) + 1
        if len(raw) and solid[0]:
            starts = np.concatenate([[0], starts])
        if not len(starts):
            return np.zeros(0, np.uint64)
        # A word's code: its bytes' codes, weighted by their places in it; blanks add nothing.
        widths = np.diff(starts, append=len(raw))
        if widths.max() > len(self.powers):
            self.powers = np.cumprod(np.full(2 * widths.max(), _STEP))
        first = starts[0]
        places = np.arange(first, len(raw)) - np.repeat(starts, widths)
        codes = _mixed(np.add.reduceat(_BYTES[raw[first:]] * self.powers[places], starts - first))
        length = min(WORDS, len(codes))
        out = np.full(len(codes) - length + 1, np.uint64(length))
        for at in range(length):
            out += codes[at : at + len(out)] * _PLACES[at]
        return np.unique(_mixed(out))


def signature(codes: np.ndarray) -> np.ndarray:
    """The minimum of each coordinate's hash, 32 bits wide."""
    out = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    high = (codes >> np.uint64(32)).astype(np.uint32)
    for begin in range(0, len(high), 1024):
        hashed = high[begin : begin + 1024, None] * _FACTORS
        hashed += _OFFSETS
        np.minimum(out, hashed.min(axis=0), out=out)
    return out


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    if 100 * min(len(a), len(b)) < SIMILAR * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= SIMILAR * (len(a) + len(b) - both)


def _signing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingle = Shingler()
    for batch in batches:
        sizes, names, signatures = [], [], []
        for text in batch.column("text").to_pylist():
            codes = shingle(text)
            sizes.append(len(codes))
            names.append(hashlib.blake2b(codes.tobytes(), digest_size=16).digest() if len(codes) else None)
            signatures.append(signature(codes).tobytes() if len(codes) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_code"),
                pa.array(sizes, pa.int64()),
                pa.array(names, pa.binary()),
                pa.array(signatures, pa.binary()),
            ],
            ["doc_id", "text_code", "n_shingles", "set_code", "signature"],
        )


def _text_code(text: str = "text"):
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def signed(docs: DataFrame) -> DataFrame:
    """Written (doc_id, text_code, n_shingles, set_code, signature) of every row."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_code().alias("text_code"))
    schema = "doc_id bigint, text_code binary, n_shingles bigint, set_code binary, signature binary"
    return written(slim.mapInArrow(_signing, schema), "near-signed")


def classes_of(rows: DataFrame) -> DataFrame:
    """Written (class_id, set_code, text_code, n_shingles, signature), a row for each set."""
    groups = rows.where("n_shingles > 0").groupBy("set_code").agg(
        F.min("text_code").alias("text_code"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature"),
    )
    return written(groups.withColumn("class_id", F.monotonically_increasing_id()), "near-classes")


def _posting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    high = np.arange(COORDINATES, dtype=np.int64) << 32
    for batch in batches:
        for begin in range(0, batch.num_rows, 4096):
            part = batch.slice(begin, 4096)
            raw = b"".join(part.column("signature").to_pylist())
            tokens = np.frombuffer(raw, np.uint32).reshape(-1, COORDINATES).astype(np.int64) | high
            ids = np.repeat(part.column("class_id").to_numpy(), COORDINATES)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(tokens.ravel())], ["class_id", "token"])


def postings(classes: DataFrame) -> DataFrame:
    """Written (token, class_id): the prefix postings of each class that can have a partner."""
    every = classes.select("class_id", "signature").mapInArrow(_posting, "class_id bigint, token bigint")
    often = every.groupBy("token").agg(F.count("*").alias("often")).where("often > 1")
    lists = every.join(often, "token").groupBy("class_id").agg(
        F.sort_array(F.collect_list(F.struct("often", "token"))).alias("tokens")
    )
    lists = lists.where(F.size("tokens") >= AGREE)
    prefix = F.slice("tokens", 1, F.size("tokens") - (AGREE - 1))
    out = lists.select("class_id", F.explode(prefix).alias("one"))
    return written(out.select("class_id", F.col("one.token").alias("token")), "near-postings")


def _agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) with AGREE equal coordinates and sizes that allow the similarity."""
    side = classes.select("class_id", "n_shingles", "signature")
    left = side.select(F.col("class_id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("signature").alias("s_a"))
    right = side.select(F.col("class_id").alias("b"), F.col("n_shingles").alias("n_b"), F.col("signature").alias("s_b"))
    sizes = 100 * F.least("n_a", "n_b") >= SIMILAR * F.greatest("n_a", "n_b")
    both = pairs.join(left, "a").join(right, "b").where(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = (
                np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint32).reshape(-1, COORDINATES)
                for name in ("s_a", "s_b")
            )
            equal = pa.array((first == second).sum(axis=1) >= AGREE)
            yield batch.select(["a", "b"]).filter(equal)

    return both.select("a", "b", "s_a", "s_b").mapInArrow(run, "a bigint, b bigint")


def _shingling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingle = Shingler()
    for batch in batches:
        codes = [shingle(text).tobytes() for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("class_id"), pa.array(codes, pa.binary())], ["class_id", "codes"])


def sets_of(posted: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Written (class_id, codes): the full set of each class that has a posting."""
    texts = docs.select(_text_code().alias("text_code"), "text")
    texts = texts.groupBy("text_code").agg(F.first("text").alias("text"))
    needed = classes.select("class_id", "text_code").join(posted.select("class_id").distinct(), "class_id")
    rows = texts.join(needed, "text_code").select("class_id", "text")
    return written(rows.mapInArrow(_shingling, "class_id bigint, codes binary"), "near-sets")


def _confirming(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [
            similar(np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(other.as_buffer(), np.uint64))
            for one, other in zip(batch.column("codes_a"), batch.column("codes_b"), strict=True)
        ]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Written pairs (a, b) whose full sets are similar."""
    one = sets.select(F.col("class_id").alias("a"), F.col("codes").alias("codes_a"))
    other = sets.select(F.col("class_id").alias("b"), F.col("codes").alias("codes_b"))
    rows = pairs.join(one, "a").join(other, "b").select("a", "b", "codes_a", "codes_b")
    return written(rows.mapInArrow(_confirming, "a bigint, b bigint"), "near-links")


def joining(rows: pa.Table) -> list[tuple[int, int]]:
    """Links between the two sides of a pair of blocks that join its components.

    Rows come sorted by side; a block with itself has one side. Of links between
    components that are joined already, by a label or by links before, none is given.
    """
    side, ids, labels, n = (rows.column(name).to_numpy() for name in ("side", "class_id", "label", "n_shingles"))
    first = int((side == 0).sum())
    same = first == len(side)
    labels = labels.copy()
    if (labels == labels[0]).all():
        return []
    signs = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)
    ends = np.cumsum(n)
    words = None
    out = []
    for place in range(first):
        begin = place + 1 if same else first
        where = begin + np.flatnonzero(labels[begin:] != labels[place])
        where = where[(signs[where] == signs[place]).sum(axis=1) >= AGREE]
        where = where[100 * np.minimum(n[where], n[place]) >= SIMILAR * np.maximum(n[where], n[place])]
        if not len(where):
            continue
        if words is None:
            # Shingles of this pair of blocks, numbered.
            codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.uint64)
            every, words = np.unique(codes, return_inverse=True)
            marked = np.zeros(len(every), np.int64)
        own = words[ends[place] - n[place] : ends[place]]
        marked[own] = 1
        theirs = np.concatenate([words[ends[x] - n[x] : ends[x]] for x in where])
        both = np.add.reduceat(marked[theirs], np.cumsum(n[where]) - n[where])
        marked[own] = 0
        for x in where[100 * both >= SIMILAR * (n[where] + n[place] - both)]:
            if labels[x] != labels[place]:
                out.append((min(ids[x], ids[place]), max(ids[x], ids[place])))
                labels[labels == labels[x]] = labels[place]
    return out


def _merging(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`joining` of each pair of blocks, from rows sorted by it."""

    def made(links: list[tuple[int, int]]) -> pa.RecordBatch:
        both = np.array(links, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        now = now if held is None else pa.concat_tables([held, now])
        change = np.zeros(now.num_rows - 1, bool)
        for name in ("token", "i", "j"):
            change |= np.diff(now.column(name).to_numpy()) != 0
        ends = np.flatnonzero(change) + 1
        links, begin = [], 0
        for end in ends.tolist():
            if end - begin > 1:
                links += joining(now.slice(begin, end - begin))
            begin = end
        held = now.slice(begin)
        yield made(links)
    if held is not None:
        yield made(joining(held))


def _across(posted: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components, from the postings that have classes of several."""
    known = posted.join(labels, F.col("class_id") == F.col("id"), "left")
    known = known.select("token", "class_id", F.coalesce("label", "class_id").alias("label"))
    known = known.join(classes.select("class_id", "n_shingles"), "class_id")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES))
    open_ = known.groupBy("token").agg(
        blocks.cast("int").alias("blocks"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    rows = known.join(open_.where("low <> high").select("token", "blocks"), "token")
    own = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")
    rows = rows.select("token", "class_id", "label", "n_shingles", "blocks", own.alias("own"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.select("*", others.alias("other")).select(
        "token",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"),
        "class_id",
        "label",
        "n_shingles",
    )
    rows = rows.join(classes.select("class_id", "signature"), "class_id").join(sets, "class_id")
    rows = rows.repartition(F.col("token"), F.col("i"), F.col("j")).sortWithinPartitions("token", "i", "j", "side")
    return rows.mapInArrow(_merging, "a bigint, b bigint").distinct()


def links(docs: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links (a, b) that join every component of classes, labels (id, label) of linked classes)."""
    posted = postings(classes)
    low = posted.groupBy("token").agg(F.min("class_id").alias("b"))
    star = posted.join(low, "token").where("class_id <> b").select(F.col("class_id").alias("a"), "b").distinct()
    sets = sets_of(posted, classes, docs)
    every = confirmed(_agreeing(star, classes), sets)
    rest = written(_across(posted, components(every), classes, sets), "near-links")
    every = written(every.unionAll(rest), "near-links")
    return every, components(every)


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, text_code, n_shingles, component_id, group (null: empty set) of every row."""
    rows = signed(docs)
    classes = classes_of(rows)
    _, labels = links(docs, classes)
    groups = classes.select("class_id", F.col("set_code").alias("_set")).join(
        labels, F.col("class_id") == F.col("id"), "left"
    )
    groups = groups.select("_set", F.coalesce("label", "class_id").alias("group"))
    rows = rows.select("doc_id", "text_code", "n_shingles", "set_code")
    rows = rows.join(groups, F.col("set_code") == F.col("_set"), "left").drop("_set", "set_code")
    rows = written(rows, "near-grouped")
    smallest = rows.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("component_id"))
    out = rows.join(smallest.withColumnRenamed("group", "_group"), F.col("group") == F.col("_group"), "left")
    component = F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_code", "n_shingles", component.alias("component_id"), "group")


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    return grouped(docs).select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def distinct(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each group: of the smallest doc_id, then of the smallest text code.

    Rows with an empty set belong to no group and all stay.
    """
    rows = grouped(docs)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_code"))
    chosen = rows.where("group is not null").groupBy("group").agg(F.min(order).alias("one"))
    chosen = chosen.select(
        F.col("one.doc_id").alias("_id"), F.col("one.text_code").alias("_code"), F.lit(False).alias("_empty")
    )
    empty = rows.where("group is null").select("doc_id", "text_code", F.lit(True)).distinct()
    chosen = chosen.unionAll(empty)
    names = docs.columns
    inner = [f"c{place}" for place in range(len(names))]
    own = docs.toDF(*inner)
    ident, text = inner[names.index("doc_id")], inner[names.index("text")]
    own = own.withColumn("_own", _text_code(text))
    same = F.col(ident).cast("long").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_code"))
    kept = own.join(chosen, same)
    # Repeated rows of one group: one stays.
    place = F.row_number().over(W.partitionBy(ident, "_own").orderBy(F.lit(0)))
    kept = kept.withColumn("_place", place).where(F.col("_empty") | (F.col("_place") == 1))
    return kept.select(*inner).toDF(*names)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return judged(table(spark, folder, "documents").select("doc_id", "text"))


def _parts(source: str) -> str:
    """Statement parts over `source` (rn, doc_id, text) that end in `judged` (rn, doc_id, n_shingles, component_id)."""
    return rf"""
nw as (
  select rn, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') as w
  from {source}
), nsets as (
  select rn, doc_id, case when len(w) = 0 then [] when len(w) < {WORDS} then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(w[i:i + {WORDS - 1}], ' ')))
    end as s
  from nw
), nclass as (
  select list_sort(s) as s, min(rn) as c from nsets where len(s) > 0 group by 1
), nitems as (select c, unnest(s) as g from nclass),
nfreq as (select g, count(*) as often from nitems group by g),
npref as (
  select c, g, row_number() over (partition by c order by often, g) as place, count(*) over (partition by c) as n
  from nitems join nfreq using (g)
), npost as (select c, g, n from npref where place <= n - cast(ceil(n * {SIMILAR} / 100.0) as bigint) + 1),
ncand as (
  select distinct a.c as a, b.c as b from npost a join npost b on a.g = b.g and a.c < b.c
    and 100 * least(a.n, b.n) >= {SIMILAR} * greatest(a.n, b.n)
), nlink as (
  select a, b from ncand join nclass x on x.c = a join nclass y on y.c = b
  where 100 * len(list_intersect(x.s, y.s)) >= {SIMILAR} * (len(x.s) + len(y.s) - len(list_intersect(x.s, y.s)))
), nedge as (select a as u, b as v from nlink union all select b, a from nlink),
nreach as (select c as u, c as v from nclass union select r.u, e.v from nreach r join nedge e on e.u = r.v),
ncomp as (select u as c, min(v) as k from nreach group by u),
nmember as (
  select n.rn, n.doc_id, len(n.s) as n_shingles, m.k
  from nsets n left join nclass k on k.s = list_sort(n.s) and len(n.s) > 0 left join ncomp m on m.c = k.c
), nlow as (select k, min(doc_id) as component_id from nmember where k is not null group by k),
judged as (
  select rn, doc_id, cast(n_shingles as bigint) as n_shingles,
    case when nmember.k is null then doc_id else component_id end as component_id
  from nmember left join nlow on nlow.k = nmember.k
)"""


SQL = f"""
with recursive docs as (select row_number() over () as rn, doc_id, text from documents), {_parts("docs")}
select doc_id, n_shingles, component_id, doc_id is not distinct from component_id as kept from judged
"""
