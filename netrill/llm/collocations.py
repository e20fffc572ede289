"""Phrase collocations by dynamic itemset counting.

The corpus is encoded once: texts become arrays of 64-bit word codes (language and word),
with 0 between pieces, dealt over SHARDS shards. The shards are then scanned in a cycle,
one a step, and every scan counts phrases of all lengths at once. A word counts from step
0. A longer phrase counts from the step after both its subphrases, the one without its
last and the one without its first word, have reached the threshold, wherever in the cycle
that is, and for exactly one full cycle. So pairs are being counted while words still are,
and no length waits for the one before.

Which phrases have reached the threshold is broadcast as one byte a slot, the first step
at which a phrase of that slot did so; the number of slots has a fixed bound (MOST_SLOTS),
whatever the corpus. Two phrases in one slot only make some phrase count that need not:
when it starts follows from the slots alone, so it counts for a full cycle all the same
and its count is exact. Counts are keyed by the phrase's word codes and summed before and
after the shuffle, so a phrase that is everywhere is one row a task.

Null texts are empty, a null language is `und`; repeated rows all count; no other column
is read, so their names can't clash. Empty tables give an empty result. Word codes are
checked: if two words with a code in use share it, the run fails and asks for another seed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netrill.llm.common import discarded, table, written
from netrill.session import shared_folder

LEAST = 100
LONGEST = 5
TOP = 2000
#: Shards of the cycle, so steps that a phrase is counted for.
SHARDS = 4
#: Bounds of the broadcast table of first steps, one byte a slot.
LEAST_SLOTS, MOST_SLOTS = 1 << 20, 1 << 26
#: Texts are encoded in slices of about this many bytes.
SLICE = 4 << 20
#: Words that are counted at a time.
TOGETHER = 1 << 20

NEVER = 255
_BREAKS = r"[.,;:!?\x0A-\x0D]"
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

ENCODED = "shard int, codes array<bigint>, langs array<string>, words array<string>, n bigint"
#: `info` packs, from the top, the step after that of reaching the threshold (0: not yet), the
#: step of starting to count, and the slot.
COUNTED = "key binary, cnt bigint, info bigint"
STATE = COUNTED + ", done boolean"
REACHED, ACT = 1 << 48, 1 << 32


def mixed(values: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix, whose constants are fixed values."""
    values = values + _MIX[0]
    values = (values ^ (values >> np.uint64(30))) * _MIX[1]
    values = (values ^ (values >> np.uint64(27))) * _MIX[2]
    return values ^ (values >> np.uint64(31))


def word_tokens(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words and piece ends ("\\n") of texts, and the number of the text each belongs to."""
    # Lower case comes second: this function is wrong on slices of long strings.
    texts = pc.ascii_lower(pc.replace_substring_regex(texts, _BREAKS, " \n "))
    texts = pc.replace_substring(texts, "\t", " ")
    texts = pc.binary_join_element_wise(texts, pa.scalar("\n", texts.type), pa.scalar(" ", texts.type))
    lists = pc.split_pattern(texts, " ")
    at = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    words = lists.flatten()
    some = pc.not_equal(words, "")
    return words.filter(some).dictionary_encode(), at[some.to_numpy(zero_copy_only=False)]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
    parts = np.cumsum(sizes) // SLICE
    cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        if end > begin:
            yield batch.slice(begin, end - begin)


def _encoding(shards: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealt = 0
        for batch in batches:
            for part in _slices(batch):
                tokens, at = word_tokens(part.column("text").cast(pa.large_string()))
                words, which = tokens.dictionary.to_pylist(), tokens.indices.to_numpy(zero_copy_only=False)
                langs = part.column("lang").dictionary_encode()
                of_lang, names = langs.indices.to_numpy(zero_copy_only=False), langs.dictionary.to_pylist()
                by_word = np.array([xxhash.xxh64_intdigest(w.encode(), seed) for w in words], np.uint64)
                by_lang = np.array([xxhash.xxh64_intdigest(x.encode(), seed + 1) for x in names], np.uint64)
                spoken = of_lang[at]
                codes = mixed(by_word[which] ^ mixed(by_lang)[spoken])
                codes[codes == 0] = 1
                real = by_word[which] != xxhash.xxh64_intdigest(b"\n", seed)
                codes[~real] = 0
                codes = codes.view(np.int64)
                shard = (at + dealt) % shards
                dealt = (dealt + part.num_rows) % shards
                rows = {"shard": [], "codes": []}
                for number in range(shards):
                    held = codes[shard == number]
                    if held.any():
                        rows["shard"].append(number)
                        rows["codes"].append(held)
                yield _rows(rows, len(rows["shard"]))
                # The slice's different words with their languages; and each language's total.
                pairs = _distinct(spoken[real], which[real], len(names), len(words))
                of, place = pairs // len(words), pairs % len(words)
                held = mixed(by_word[place] ^ mixed(by_lang)[of])
                held[held == 0] = 1
                totals = np.bincount(spoken[real], minlength=len(names)).tolist()
                blank = [[]] * len(names)
                yield _rows(
                    {
                        "codes": [held.view(np.int64), *blank],
                        "langs": [langs.dictionary.take(pa.array(of)), *[[x] for x in names]],
                        "words": [tokens.dictionary.take(pa.array(place)).cast(pa.string()), *blank],
                        "n": [None, *totals],
                    },
                    1 + len(names),
                )

    return run


def _distinct(high: np.ndarray, low: np.ndarray, highs: int, lows: int) -> np.ndarray:
    """The different values of high * lows + low."""
    both = high.astype(np.int64) * lows + low
    if highs * lows > 8 * len(both) + 1000:
        return np.unique(both)
    seen = np.zeros(highs * lows, bool)
    seen[both] = True
    return np.flatnonzero(seen)


def _rows(columns: dict[str, list], size: int) -> pa.RecordBatch:
    texts = pa.list_(pa.string())
    kinds = {"shard": pa.int32(), "codes": pa.list_(pa.int64()), "langs": texts, "words": texts, "n": pa.int64()}
    absent = {"shard": -1}
    made = [pa.array(columns.get(name, [absent.get(name)] * size), kind) for name, kind in kinds.items()]
    return pa.RecordBatch.from_arrays(made, list(kinds))


def _naming(stamps):
    """(key, lang, word) of the dictionaries' words that have reached the threshold, or share a slot with one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = stamps.value
        mask = np.uint64(len(held) - 1)
        for batch in batches:
            for row in range(batch.num_rows):
                codes, langs, words = (batch.column(name)[row].values for name in ("codes", "langs", "words"))
                codes = codes.to_numpy(zero_copy_only=False)
                at = np.flatnonzero(held[codes.view(np.uint64) & mask] != NEVER)
                keys = _packed(np.ascontiguousarray(codes[at]), 1)
                at = pa.array(at)
                yield pa.RecordBatch.from_arrays([keys, langs.take(at), words.take(at)], ["key", "lang", "word"])

    return run


def _packed(codes: np.ndarray, size: int) -> pa.Array:
    """Rows of `size` codes as binary values."""
    rows = len(codes)
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * (8 * size))
    return pa.Array.from_buffers(pa.binary(), rows, [None, offsets.buffers()[1], pa.py_buffer(codes.tobytes())])


def _counting(stamps, step: int, shards: int, longest: int):
    """Count what is active in a step; `stamps` is the broadcast table of first steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = stamps.value
        mask = np.uint64(len(held) - 1)
        waiting: list[np.ndarray] = []
        for batch in batches:
            lists = batch.column("codes")
            for row in range(batch.num_rows):
                # Every text ends in a 0, so no phrase goes from one list into the next.
                waiting.append(lists[row].values.to_numpy(zero_copy_only=False).view(np.uint64))
                if sum(map(len, waiting)) >= TOGETHER:
                    yield from _counted(np.concatenate(waiting), held, mask, step, shards, longest)
                    waiting = []
        if waiting:
            yield from _counted(np.concatenate(waiting), held, mask, step, shards, longest)

    return run


def _counted(codes, held, mask, step, shards, longest) -> Iterator[pa.RecordBatch]:
    if step < shards:
        at = np.flatnonzero(codes)
        yield _totals(codes, codes[at], at, np.zeros(len(at), np.int64), 1, mask)
    # First steps of the phrases from each place on; only places of a phrase that has one are gone on with.
    seen = np.where(codes != 0, held[codes & mask], NEVER)
    at, digests = np.flatnonzero(seen[:-1] != NEVER), codes
    digests = digests[at]
    for size in range(2, longest + 1):
        latest = np.maximum(seen[at], seen[at + 1])
        both = latest != NEVER
        at, digests, latest = at[both], digests[both], latest[both]
        digests = mixed(digests * _MIX[0] + codes[at + (size - 1)])
        act = latest.astype(np.int64) + 1
        active = act > step - shards
        if active.any():
            yield _totals(codes, digests[active], at[active], act[active], size, mask)
        if size < longest:
            # Another phrase may have marked the slot before this one's own words were seen: never
            # earlier than those, or the longer phrases' cycle would begin before they are come to.
            found = np.maximum(held[digests & mask], latest)
            seen.fill(NEVER)
            seen[at] = found
            there = found != NEVER
            at, digests = at[there], digests[there]


def _totals(codes, digests, places, act, size, mask) -> pa.RecordBatch:
    found, first, counts = np.unique(digests, return_index=True, return_counts=True)
    places = places[first]
    keys = np.ascontiguousarray(codes[places[:, None] + np.arange(size)])
    info = act[first] * ACT + (found & mask).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [_packed(keys, size), pa.array(counts.astype(np.int64)), pa.array(info)], ["key", "cnt", "info"]
    )


def slots_for(words: int) -> int:
    """A slot for 16 words, at least; a power of two between the bounds."""
    return min(MOST_SLOTS, max(LEAST_SLOTS, 1 << max(0, words // 16).bit_length()))


def _mark(stamps: np.ndarray, reached: DataFrame, step: int) -> bool:
    """Note the step in the slots of phrases that have reached the threshold in it."""
    slot = F.col("info").bitwiseAND(ACT - 1) + 1
    bits = reached.groupBy(F.call_function("bitmap_bucket_number", slot).alias("bucket")).agg(
        F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", slot)).alias("bits")
    )
    some = False
    # At most MOST_SLOTS / 8 bytes, whatever the corpus.
    for row in bits.collect():
        at = np.flatnonzero(np.unpackbits(np.frombuffer(bytes(row["bits"]), np.uint8), bitorder="little"))
        at += (row["bucket"] - 1) * 32768
        stamps[at] = np.minimum(stamps[at], step)
        some = True
    return some


def encode(docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """The written table of word codes by shard, with the dictionary and word totals in shard -1."""
    slim = docs.select(
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col("lang"), F.lit("und")).alias("lang"),
    )
    rows = slim.mapInArrow(_encoding(shards, seed), ENCODED)
    path = shared_folder(docs.sparkSession, "collocations-codes")
    rows.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(ENCODED).parquet(path)


def frequent(
    encoded: DataFrame, words: int, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS
) -> tuple[DataFrame, np.ndarray]:
    """(key, cnt) of all phrases of 1 to `longest` words that occur `least` times, and the first steps.

    A key has 8 bytes a word.
    """
    spark = encoded.sparkSession
    stamps = np.full(slots_for(words), NEVER, np.uint8)
    folder = shared_folder(spark, "collocations-counts")
    act = F.call_function("div", F.col("info") % REACHED, F.lit(ACT))
    step, last = 0, 0
    while step < last + shards:
        # From any step on the cycle comes to every shard once in `shards` steps.
        shared = spark.sparkContext.broadcast(stamps)
        scanned = encoded.where(F.col("shard") == step % shards).select("codes")
        rows = scanned.mapInArrow(_counting(shared, step, shards, longest), COUNTED)
        if step:
            before = spark.read.schema(STATE).parquet(f"{folder}/step={step - 1}").where(~F.col("done"))
            rows = rows.unionByName(before.drop("done"))
        total = rows.groupBy("key").agg(F.sum("cnt").alias("cnt"), F.max("info").alias("info"))
        new = (F.col("cnt") >= least) & (F.col("info") < REACHED)
        total = total.withColumn("info", F.col("info") + F.when(new, F.lit((step + 1) * REACHED)).otherwise(0))
        total = total.withColumn("done", act + (shards - 1) == step)
        total = total.where(~F.col("done") | (F.col("cnt") >= least))
        path = f"{folder}/step={step}"
        total.write.option("compression", "zstd").partitionBy("done").parquet(path)
        state = spark.read.schema(STATE).parquet(path)
        longer = F.octet_length("key") < 8 * longest
        if _mark(stamps, state.where((F.col("info") >= (step + 1) * REACHED) & longer), step):
            last = step + 1
        shared.unpersist()
        if step:
            discarded(spark, f"{folder}/step={step - 1}/done=false")
        step += 1
    whole = spark.read.schema("step int, " + STATE).parquet(folder)
    return whole.where("done").select("key", "cnt"), stamps


def _subphrase(first: int | F.Column, size: F.Column) -> F.Column:
    return F.substring(F.col("key"), 8 * first + 1 if isinstance(first, int) else first * 8 + 1, size * 8)


def dictionary(encoded: DataFrame, found: DataFrame, stamps: np.ndarray) -> DataFrame:
    """(key, lang, word) of the words of `found`; fails if two words share a code."""
    shared = encoded.sparkSession.sparkContext.broadcast(stamps)
    entries = encoded.where((F.col("shard") == -1) & F.col("n").isNull()).select("codes", "langs", "words")
    entries = entries.mapInArrow(_naming(shared), "key binary, lang string, word string")
    used = found.where(F.octet_length("key") == 8).select("key")
    # Different rows first: every slice has its own.
    words = entries.distinct().join(used, "key", "left_semi")
    words = words.groupBy("key").agg(F.first("lang").alias("lang"), F.first("word").alias("word"), F.count("*").alias("n"))
    clash = F.raise_error("two words share a code: choose another seed")
    return words.select("key", "lang", F.when(F.col("n") == 1, F.col("word")).otherwise(clash).alias("word"))


def mine(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    shards: int = SHARDS,
    seed: int = 0,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first `top` phrases."""
    encoded = encode(docs, shards, seed)
    totals = encoded.where((F.col("shard") == -1) & F.col("n").isNotNull())
    totals = totals.groupBy(F.get("langs", 0).alias("lang")).agg(F.sum("n").alias("n"))
    words = totals.agg(F.sum("n")).first()[0] or 0
    found, stamps = frequent(encoded, words, least, longest, shards)
    found = written(found, "collocations-frequent")
    spoken = written(dictionary(encoded, found, stamps), "collocations-words")
    size = F.call_function("div", F.octet_length("key"), F.lit(8))
    phrases = found.withColumn("size", size).where("size > 1")

    # A phrase is inside a longer one that is as frequent only if it is so one word further on.
    ends = F.array(_subphrase(0, F.col("size") - 1), _subphrase(1, F.col("size") - 1))
    covered = phrases.select("cnt", F.explode(ends).alias("key")).where(F.octet_length("key") > 8).distinct()
    kept = phrases.join(covered, ["key", "cnt"], "left_anti")

    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), (F.col("size") - 1).cast("int"))))
    cuts = cuts.select(
        "key", "size", "cnt", "cut",
        _subphrase(0, F.col("cut")).alias("left_key"),
        _subphrase(F.col("cut"), F.col("size") - F.col("cut")).alias("right_key"),
        _subphrase(0, F.lit(1)).alias("word_key"),
    )
    cuts = cuts.join(found.select(F.col("key").alias("left_key"), F.col("cnt").alias("l")), "left_key")
    cuts = cuts.join(found.select(F.col("key").alias("right_key"), F.col("cnt").alias("r")), "right_key")
    of_lang = spoken.select(F.col("key").alias("word_key"), "lang")
    cuts = cuts.join(of_lang, "word_key").join(totals, "lang")
    wide = lambda name: F.col(name).cast("decimal(19,0)")
    over = (wide("cnt") * wide("n")).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    score = F.call_function("div", over, wide("l") * wide("r"))
    best = cuts.groupBy("key", "lang", "n", F.col("cnt").alias("a")).agg(
        F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best")
    )
    places = F.sequence(F.lit(0), F.call_function("div", F.octet_length("key"), F.lit(8)).cast("int") - 1)
    spelt = best.select("key", F.explode(places).alias("place"))
    spelt = spelt.withColumn("word_key", _subphrase(F.col("place"), F.lit(1)))
    spelt = spelt.join(spoken.select(F.col("key").alias("word_key"), "word"), "word_key")
    spelt = spelt.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("parts"))
    spelt = spelt.select("key", F.array_join(F.col("parts.word"), " ").alias("phrase"))
    named = best.join(spelt, "key").select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return mine(table(spark, folder, "documents"))


SQL = f"""
with pieces as (
  select row_number() over () as piece, lang, regexp_extract_all(part, '[^\\x20\\x09]+') as words
  from (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\\x0A-\\x0D]')) as part
    from documents)),
totals as (select lang, sum(len(words)) as n from pieces group by lang),
starts as (
  select lang, words, unnest(generate_series(1, len(words))) as place from pieces),
grams as (
  select lang, size, words[place:place + size - 1] as phrase
  from starts, (select unnest(generate_series(1, {LONGEST})) as size)
  where place + size - 1 <= len(words)),
found as (select lang, size, phrase, count(*) as f from grams group by all having count(*) >= {LEAST}),
inside as (
  select lang, size - 1 as size, f, unnest([phrase[:size - 1], phrase[2:]]) as phrase from found where size > 2),
kept as (
  select * from found p where size > 1 and not exists (
    select 1 from inside i where i.lang = p.lang and i.size = p.size and i.phrase = p.phrase and i.f >= p.f)),
cuts as (
  select k.lang, k.phrase, k.f as a, k.cut, l.f as l, r.f as r, t.n,
    (1000::hugeint * k.f::hugeint * t.n::hugeint) // (l.f::hugeint * r.f::hugeint) as score
  from (select *, unnest(generate_series(1, size - 1)) as cut from kept) k
  join found l on l.lang = k.lang and l.phrase = k.phrase[:k.cut]
  join found r on r.lang = k.lang and r.phrase = k.phrase[k.cut + 1:]
  join totals t on t.lang = k.lang),
lowest as (
  select *, row_number() over (partition by lang, phrase order by score, cut) as best from cuts),
ranked as (
  select lang, array_to_string(phrase, ' ') as phrase, a, l, r, n, score from lowest where best = 1)
select lang, rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score from (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from ranked)
where rank <= {TOP}
"""
