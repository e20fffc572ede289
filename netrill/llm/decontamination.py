"""Benchmark decontamination by spaced seeds.

Words are runs of letters and digits in lower case. A seed is the hash of the words
that a fixed mask selects from a window of eight; the positions a mask ignores may hold
substitutes. Seeds of test items and documents are joined, and around each hit the
aligned words are compared one by one: of the item's words up to `MARGIN` before and
after the window, three in four must be equal in place. Both sides bring these words
along, never whole texts. All of it is built-in functions; documents are read once and
never shuffled while the seeds of the benchmark stay below `BROADCAST_BYTES`. Beyond
that a table of marks, of bounded size, tells which seeds of documents can be any item's,
and only those are shuffled.

Edge cases: null or empty texts have no words and no hits; items of fewer than eight
words have no seed and match nothing; a null doc_id or item_id is a value like others;
repeated rows give the same (doc_id, item_id) once; empty tables give an empty result;
further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netrill.llm.common import held, table, text_or_empty

SPAN = 8
#: Selected places of the window (fixed values); each mask starts and ends with a selected one.
MASKS = ("10111011", "11011101", "11100111", "11011011")
MARGIN = 4
#: Least share of equal words around a hit, in hundredths.
SIMILAR = 75
#: Seeds of the benchmark, each with its words, of up to so many bytes together go to every executor.
BROADCAST_BYTES = 32 << 20
#: Most rows of the table of marks, some 40 MB in an executor. A row marks 64 places, a seed three of them.
MARK_ROWS = 1 << 20

NOT_WORD = r"[^\p{L}\p{N}]+"


def _codes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), NOT_WORD), lambda word: word != "")
    return F.transform(words, lambda word: F.xxhash64(word))


def _seeds(frame: DataFrame, place: str) -> DataFrame:
    """One row for each window and mask: `place` (its start) and `seed`."""
    last = F.size("codes") - SPAN
    starts = F.when(last >= 0, F.sequence(F.lit(0), last))
    out = frame.select("*", F.explode(starts).alias(place))
    seeds = F.array(
        *[
            F.xxhash64(
                F.lit(number),
                *[F.get("codes", F.col(place) + at) for at, bit in enumerate(mask) if bit == "1"],
            )
            for number, mask in enumerate(MASKS)
        ]
    )
    return out.select("*", F.explode(seeds).alias("seed"))


def _words(place: str) -> Column:
    """The words of a window and up to `MARGIN` on either side, null beyond the text's ends."""
    return F.array(*[F.get("codes", F.col(place) + step) for step in range(-MARGIN, SPAN + MARGIN)])


def _verified(hits: DataFrame) -> DataFrame:
    """Compare `words` with `item_words`, place by place."""
    equal = F.filter(F.zip_with("words", "item_words", lambda word, other: word == other), lambda same: same)
    # Held, the comparison can't become a condition of the join above: as one it would end
    # code generation there, and every seed would carry a copy of its document's words.
    out = held(hits, n_equal=F.size(equal))
    return out.select("row", "item_id", "at", "item_at", "n_equal", "n_compared").where(
        100 * F.col("n_equal") >= SIMILAR * F.col("n_compared")
    )


def _seed_bytes(tests: DataFrame) -> float:
    """Size of all seed rows: about 250 bytes and the item's name, for each window and mask."""
    windows = F.greatest(F.size("codes").cast("double") - (SPAN - 1), F.lit(0.0))
    name = F.coalesce(F.octet_length(F.col("item_id").cast("string")), F.lit(0))
    return tests.agg(F.sum(len(MASKS) * windows * (250 + name))).first()[0] or 0


def _mark() -> tuple[Column, Column]:
    """Row of a seed in the table of marks, and its three places there."""
    row = F.shiftrightunsigned("seed", 18).bitwiseAND(MARK_ROWS - 1)
    places = [F.shiftrightunsigned("seed", step).bitwiseAND(63).cast("int") for step in (0, 6, 12)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]
    return row, bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def _marked(found: DataFrame, seeds: DataFrame) -> DataFrame:
    """The rows of `found` whose seed may be one of `seeds`; none of those is lost."""
    row, bits = _mark()
    marks = seeds.select(row.alias("_row"), bits.alias("_bits")).groupBy("_row").agg(F.bit_or("_bits").alias("_marks"))
    near = found.join(F.broadcast(marks), row == F.col("_row"))
    return near.where(F.col("_marks").bitwiseAND(bits) == bits).drop("_row", "_marks")


def overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Verified hits: row (struct of doc_id and the text's hash), item_id, at, item_at, n_equal, n_compared."""
    text = text_or_empty()
    rows = docs.select(
        F.struct(F.col("doc_id"), F.xxhash64(text).alias("code")).alias("row"), _codes(text).alias("codes")
    )
    tests = items.select("item_id", _codes(text).alias("codes"))
    last = F.least(F.col("item_at") + SPAN + MARGIN, F.size("codes"))
    compared = (last - F.greatest(F.col("item_at") - MARGIN, F.lit(0))).alias("n_compared")
    seeds = _seeds(tests, "item_at").select("seed", "item_id", "item_at", _words("item_at").alias("item_words"), compared)
    found = _seeds(rows, "at")
    if _seed_bytes(tests) <= BROADCAST_BYTES:
        seeds = F.broadcast(seeds)
    else:
        found = _marked(found, seeds)
        # The hint keeps Spark from sending all seeds to every executor: it reckons with the size of the file.
        seeds = seeds.hint("merge")
    return _verified(found.select("row", "at", "seed", _words("at").alias("words")).join(seeds, "seed"))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct `row`s of `docs` that hold a passage of an item."""
    return overlaps(docs, items).select("row").distinct()


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """`docs` without contaminated rows; columns and clean rows as they are, null doc_ids included."""
    bad = contaminated(docs, items).select(
        F.col("row.doc_id").alias("_bad_id"), F.col("row.code").alias("_bad_code")
    )
    same = docs["doc_id"].eqNullSafe(bad["_bad_id"]) & (
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == bad["_bad_code"]
    )
    return docs.join(bad, same, "left_anti")


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_hits (distinct verified places), best (most equal words of a hit)."""
    return (
        overlaps(docs, items)
        .groupBy("row.doc_id", "item_id", "at", "item_at")
        .agg(F.max("n_equal").alias("n_equal"))
        .groupBy("doc_id", "item_id")
        .agg(F.count("*").alias("n_hits"), F.max("n_equal").cast("long").alias("best"))
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def _key(mask: str, place: str) -> str:
    return "concat_ws(' ', " + ", ".join(f"w[{place} + {i + 1}]" for i, bit in enumerate(mask) if bit == "1") + ")"


def seeds_sql(source: str, ident: str) -> str:
    return " union all ".join(
        f"select {ident}, pos, {number} as mask, {_key(mask, 'pos')} as seed from {source}, unnest(range(0, len(w) - {SPAN - 1})) as t(pos)"
        for number, mask in enumerate(MASKS)
    )


def bad_rows_sql(source: str) -> str:
    """Statement parts that end in `verified` (rn, item, pos, iat, n_equal, n_compared) over `source` (rn, doc_id, text)."""
    words = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
    return f"""
dw as (select rn, {words} as w from {source}),
iw as (select row_number() over () as item, item_id, {words} as w from benchmark),
ds as ({seeds_sql("dw", "rn")}), bs as ({seeds_sql("iw", "item")}),
hits as (select distinct ds.rn, bs.item, ds.pos, bs.pos as iat from ds join bs on ds.mask = bs.mask and ds.seed = bs.seed),
verified as (
  select h.rn, iw.item_id, h.pos, h.iat,
    len(list_filter(range(greatest(h.iat - {MARGIN}, 0), least(h.iat + {SPAN + MARGIN}, len(iw.w))),
      lambda i: i + h.pos - h.iat >= 0 and coalesce(iw.w[i + 1] = dw.w[i + h.pos - h.iat + 1], false))) as n_equal,
    least(h.iat + {SPAN + MARGIN}, len(iw.w)) - greatest(h.iat - {MARGIN}, 0) as n_compared
  from hits h join dw on dw.rn = h.rn join iw on iw.item = h.item
  where 100 * n_equal >= {SIMILAR} * n_compared
)"""


SQL = f"""
with docs as (select row_number() over () as rn, doc_id, text from documents), {bad_rows_sql("docs")},
places as (
  select doc_id, item_id, pos, iat, max(n_equal) as n_equal from verified join docs using (rn) group by all
)
select doc_id, item_id, count(*) as n_hits, cast(max(n_equal) as bigint) as best from places group by doc_id, item_id
"""
