"""Personal data: base patterns, and terms that reveal the persons behind them.

Base matches (e-mail, IPv4, card, phone) come from fixed patterns. Protected entities are
their values and the classes these belong to: an address's domain, an IP network, a card's
issuer, a phone number without its last four digits. Over the whole corpus it is counted in
how many different texts a word occurs, and in how many together with an entity, wherever in
the text. From n texts with a word, k of which hold the entity, follows a lower confidence
limit (Wilson) of P(e|t). A word reveals the entity if that limit leaves at most RESIDUAL bits
of uncertainty, if it is GAIN bits above the entity's own frequency, and if k is two or more:
one text is no evidence. None of these depends on the number of texts. Such words are
generalised throughout the entity's texts. Base spans always stay.

Only texts with an entity can hold revealing words, so these are found first. An entity in one
text and a word in one such text can't count, nor a word that most often stands elsewhere; what
remains is told to the count over all texts by a bitmap of bounded size, which may let further
words pass (they are joined away) but loses none. Counts are partial in each task before they are
shuffled. Copies count once: words of texts that may occur again are kept by text; which ones
may is told by another such bitmap.

Edge cases: null and empty texts have no spans (SHA-256 of the empty string); a null
doc_id stays null; repeated rows are handled one by one and count as one text in
all statistics; overlapping base spans all stay; an empty table gives an empty
result; further columns, whatever their names, are kept by `sanitised` and not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netrill.llm.common import table, text_or_empty, written

KINDS = ("email", "ip", "card", "phone")
#: Bits of an entity's information that may remain unknown; bits above its own frequency.
RESIDUAL, GAIN = 1.0, 6.0
#: Different texts with entity and word, and the limit's normal deviate (one-sided 90 %).
LEAST_TEXTS, DEVIATE = 2, 1.2816
#: Distinct words a task counts before it hands them on.
KEEP_WORDS = 400_000
#: Places of the bitmaps of repeated texts and of words; two in one place cost space only.
PLACES, WORD_PLACES = 1 << 24, 1 << 26
#: The code of a text beside its row's own columns.
CODE = "_privacy_text_code"

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does, so later starts need no look.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W_]{3,}")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @: what stands before it back to the last match or border."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        rest = _DOMAIN.match(text, at + 1) if start < at else None
        if rest:
            done = rest.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of all base matches, ordered."""
    out = [(start, 0, end) for start, end in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            out += [
                (m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))
            ]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _entities(text: str, spans: list[tuple[int, int, int]]) -> list[str]:
    """The values of all matches and the classes they belong to."""
    out = set()
    for start, kind, end in spans:
        value = text[start:end].lower()
        if kind == 0:
            group = value[value.index("@") :]
        elif kind == 1:
            parts = [part.lstrip("0") or "0" for part in value.split(".")]
            value, group = ".".join(parts), ".".join(parts[:3]) + ".*"
        else:
            value = re.sub(r"[^0-9]", "", value)
            group = (value[:6] if kind == 2 else value[:-4]) + "*"
        out |= {f"{KINDS[kind]}:{value}", f"{KINDS[kind]}:{group}"}
    return list(out)


def _outside(text: str, spans: list[tuple[int, int, int]]) -> list[dict]:
    """All words of a text but those that touch a match: term, start, end."""
    out, at, covered = [], 0, 0
    for m in _WORD.finditer(text):
        # Matches are ordered by start: what begins before the word's end may cover it.
        while at < len(spans) and spans[at][0] < m.end():
            covered = max(covered, spans[at][2])
            at += 1
        if covered <= m.start():
            out.append({"term": m[0].lower(), "start": m.start(), "end": m.end()})
    return out


_OUTSIDE = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(kept: list[str]):
    """One row per document: kept columns, base matches, entities and the words of texts that have some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, bases, entities, outsides = [], [], [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                spans = base_spans(text)
                kinds = [kind for _, kind, _ in spans]
                numbers.append([kinds.count(k) for k in range(len(KINDS))])
                bases.append(spans_text(spans))
                entities.append(_entities(text, spans))
                outsides.append(_outside(text, spans) if spans else [])
            columns = {f"kept_{i}": batch.column(name) for i, name in enumerate(kept)}
            columns["row_key"] = pa.array([uuid.uuid4().hex if base else None for base in bases], pa.string())
            columns["text_code"] = batch.column(CODE)
            for k, kind in enumerate(KINDS):
                columns[f"n_{kind}"] = pa.array([row[k] for row in numbers], pa.int64())
            columns["base_sha256"] = pa.array([hashlib.sha256(base.encode()).hexdigest() for base in bases], pa.string())
            columns["base"] = pa.array(bases, pa.string())
            columns["entities"] = pa.array(entities, pa.list_(pa.string()))
            columns["outside"] = pa.array(outsides, _OUTSIDE)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def scanned(docs: DataFrame, kept: list[str]) -> DataFrame:
    """The written scan of `docs`: base spans, and entities with the words of their texts."""
    types = {field.name: field.dataType.simpleString() for field in docs.schema.fields}
    schema = "".join(f"kept_{i} {types[name]}, " for i, name in enumerate(kept))
    schema += "row_key string, text_code bigint, " + ", ".join(f"n_{kind} bigint" for kind in KINDS)
    schema += ", base_sha256 string, base string, entities array<string>"
    schema += ", outside array<struct<term:string,start:bigint,end:bigint>>"
    columns = dict.fromkeys([*kept, "text"])
    return written(docs.select(*columns, _code()).mapInArrow(_scan(kept), schema), "privacy-scan")


def _code() -> Column:
    return F.xxhash64(text_or_empty()).alias(CODE)


def _bitmap(places: DataFrame, size: int) -> np.ndarray:
    """Packed bits of a column of places below `size`; at most `size` / 32768 rows of 4 KB are collected."""
    at = F.col(places.columns[0]) + 1
    parts = places.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    )
    bitmap = np.zeros(size // 8, np.uint8)
    for row in parts.collect():
        start = (row["part"] - 1) * 4096
        bits = np.frombuffer(bytes(row["bits"]), np.uint8)[: bitmap.size - start]
        bitmap[start : start + bits.size] = bits
    return bitmap


def _count(words_of, texts_of):
    """Partial counts of words (`term` set), and the words of a text that may occur again (`words` set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, repeated = words_of.value, texts_of.value
        counts: Counter = Counter()
        seen: set[int] = set()

        def chosen(words) -> list[str]:
            places = ((word, zlib.crc32(word.encode()) % WORD_PLACES) for word in words)
            return [word for word, place in places if wanted[place >> 3] >> (place & 7) & 1]

        def rows(terms: list[str], codes: list[int], lists: list[list[str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([*terms, *[None] * len(codes)], pa.string()),
                    pa.array([*[counts[term] for term in terms], *[None] * len(codes)], pa.int64()),
                    pa.array([*[None] * len(terms), *codes], pa.int64()),
                    pa.array([*[None] * len(terms), *lists], pa.list_(pa.string())),
                ],
                ["term", "n_docs", "text_code", "words"],
            )

        for batch in batches:
            codes = batch.column(CODE).to_numpy()
            places = codes % PLACES
            again = repeated[places >> 3] >> (places & 7) & 1
            copied: dict[int, list[str]] = {}
            for text, code, maybe in zip(batch.column("text").to_pylist(), codes.tolist(), again, strict=True):
                if not maybe:
                    counts.update(set(_WORD.findall(text.lower())))
                elif code not in seen:
                    if len(seen) >= KEEP_WORDS:
                        seen.clear()
                    seen.add(code)
                    copied[code] = chosen(set(_WORD.findall(text.lower())))
            full = len(counts) >= KEEP_WORDS
            if copied or full:
                yield rows(chosen(counts) if full else [], list(copied), list(copied.values()))
            if full:
                counts.clear()
        yield rows(chosen(counts), [], [])

    return run


def _texts_of_words(docs: DataFrame, words: DataFrame) -> DataFrame:
    """(term, n_term): in how many different texts of `docs` a word of `words` occurs."""
    context = docs.sparkSession.sparkContext
    repeated = docs.select(_code()).groupBy(CODE).count().where("count > 1")
    texts_of = _bitmap(repeated.select(F.pmod(CODE, F.lit(PLACES)).alias("place")), PLACES)
    words_of = _bitmap(words.select(F.pmod(F.crc32("term"), F.lit(WORD_PLACES)).alias("place")), WORD_PLACES)
    counted = docs.select(text_or_empty().alias("text"), _code()).mapInArrow(
        _count(context.broadcast(words_of), context.broadcast(texts_of)),
        "term string, n_docs bigint, text_code bigint, words array<string>",
    )
    counted = written(counted, "privacy-counts")
    copied = counted.where("words is not null").dropDuplicates(["text_code"])
    copied = copied.select(F.explode("words").alias("term"), F.lit(1).cast("long").alias("n_docs"))
    counts = counted.where("term is not null").select("term", "n_docs").unionByName(copied)
    counts = counts.groupBy("term").agg(F.sum("n_docs").alias("n_term"))
    return counts.join(words.select("term"), "term", "left_semi")


def _limit(part: str, whole: str) -> Column:
    """Lower confidence limit of a share of which `part` of `whole` texts were seen."""
    n, share, square = F.col(whole), F.col(part) / F.col(whole), DEVIATE**2
    spread = F.sqrt(share * (1 - share) / n + square / (4 * n * n))
    return (share + square / (2 * n) - DEVIATE * spread) / (1 + square / n)


def revealing(docs: DataFrame, scan: DataFrame, residual: float = RESIDUAL, gain: float = GAIN) -> DataFrame:
    """(entity, term, limit): words of `docs` that reveal an entity of their `scan`, and the limit of P(e|t)."""
    least = 2.0**-residual
    texts = scan.where(F.size("entities") > 0).dropDuplicates(["text_code"])
    texts = texts.select("text_code", "entities", F.array_distinct("outside.term").alias("terms"))
    own = texts.select("text_code", F.explode("entities").alias("entity"))
    entities = own.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= LEAST_TEXTS)
    own = own.join(entities, "entity")
    held = texts.join(own.select("text_code").distinct().withColumn("held", F.lit(1)), "text_code", "left")
    held = held.select("text_code", "held", F.explode("terms").alias("term"))
    # All texts with a word are at least those with an entity: what can't reach the limit there can't at all.
    words = held.groupBy("term").agg(F.count("held").alias("n_held"), F.count("*").alias("n_found"))
    words = words.where(F.col("n_held") >= LEAST_TEXTS).where(_limit("n_held", "n_found") >= least)
    words = written(words, "privacy-words")
    words = words.join(_texts_of_words(docs, words), "term").where(_limit("n_held", "n_term") >= least)
    pairs = held.where("held is not null").join(words.select("term", "n_term"), "term").join(own, "text_code")
    pairs = pairs.groupBy("entity", "term", "n_entity", "n_term").agg(F.count("*").alias("n_pair"))
    total = scan.agg(F.countDistinct("text_code")).first()[0]
    pairs = pairs.where(F.col("n_pair") >= LEAST_TEXTS).withColumn("limit", _limit("n_pair", "n_term"))
    above = F.col("limit") >= 2.0**gain * F.col("n_entity") / F.lit(max(total, 1))
    return pairs.where((F.col("limit") >= least) & above).select("entity", "term", "limit")


def _term_spans(scan: DataFrame, terms: DataFrame) -> DataFrame:
    """row_key and its revealing words' spans."""
    hits = scan.where(F.size("entities") > 0).select("row_key", "entities", F.explode("outside").alias("one"))
    hits = hits.select("row_key", "entities", "one.*").join(terms.select("entity", "term"), "term")
    hits = hits.where(F.array_contains("entities", F.col("entity")))
    return hits.groupBy("row_key").agg(
        F.collect_set(F.struct("start", F.lit(len(KINDS)).alias("kind"), "end")).alias("terms")
    )


def _all_spans(base: str, terms: str):
    """Base and term spans in order of start, then kind as listed (terms last)."""
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    parts = F.when(F.col(base) == "", F.array().cast("array<string>")).otherwise(F.split(base, ","))
    own = F.transform(
        parts,
        lambda part: F.struct(
            F.split(part, ":")[1].cast("long").alias("start"),
            (F.array_position(kinds, F.split(part, ":")[0]) - 1).cast("int").alias("kind"),
            F.split(part, ":")[2].cast("long").alias("end"),
        ),
    )
    return F.when(F.col(terms).isNull(), F.col(base)).otherwise(
        F.concat_ws(
            ",",
            F.transform(
                F.sort_array(F.concat(own, F.col(terms))),
                lambda s: F.concat_ws(
                    ":", F.coalesce(F.get(kinds, s["kind"]), F.lit("term")), s["start"], s["end"]
                ),
            ),
        )
    )


def _found(docs: DataFrame, kept: list[str], gain: float) -> DataFrame:
    """Every row of `docs`: kept columns as kept_0 and so on, base counts and digest, and all spans."""
    scan = scanned(docs, kept)
    terms = _term_spans(scan, revealing(docs, scan, gain=gain))
    columns = [*[f"kept_{i}" for i in range(len(kept))], *[f"n_{kind}" for kind in KINDS], "base_sha256"]
    # Rows without matches, nearly all, don't take part in the join.
    plain = scan.where(F.size("entities") == 0).select(*columns, F.col("base").alias("spans"))
    others = scan.where(F.size("entities") > 0).join(terms, "row_key", "left")
    return plain.unionByName(others.select(*columns, _all_spans("base", "terms").alias("spans")))


def found(docs: DataFrame, kept: list[str], gain: float = GAIN) -> DataFrame:
    """Every row of `docs` with its kept columns, base counts and digest, and all spans."""
    rows = _found(docs, kept, gain)
    return rows.toDF(*kept, *rows.columns[len(kept) :])


def blanked(text: str, spans: str) -> str:
    """Replace spans by their kind in angle brackets; of overlapping ones the first names the whole."""
    out, end = [], 0
    for part in spans.split(",") if spans else ():
        kind, start, stop = part.split(":")
        if int(start) >= end:
            out += [text[end : int(start)], f"<{kind.upper()}>"]
        end = max(end, int(stop))
    return "".join([*out, text[end:]])


def sanitised(docs: DataFrame, gain: float = GAIN) -> DataFrame:
    """`docs` with personal data and revealing words replaced; n_chars, if there, follows the text."""
    names = docs.columns
    rows = _found(docs, names, gain).select(*[f"kept_{i}" for i in range(len(names))], "spans")
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns[: len(names)])
            texts = [
                blanked(text, spans) if spans else text
                for text, spans in zip(columns[at].to_pylist(), batch.column("spans").to_pylist(), strict=True)
            ]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    out = rows.mapInArrow(run, docs.schema)
    if "n_chars" in names:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
    return out


def query(spark: SparkSession, folder: str) -> DataFrame:
    return found(table(spark, folder, "documents").select("doc_id", "text"), ["doc_id"])
