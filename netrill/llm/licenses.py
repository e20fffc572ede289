"""Licence scan: whole texts against digests of known licences.

A text is brought to a canonical form by built-in functions (case, copyright lines,
punctuation and white space, equivalent spellings) and its SHA-256 is joined with the
digests of the known texts, which go through the same form.

Edge cases: a null or empty text has the digest of the empty form and matches nothing;
a null doc_id stays null; repeated rows are looked up one by one; known texts of one
form are one licence, the smallest name; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netrill.llm.common import table, text_or_empty
from netrill.llm.license_texts import KNOWN

#: Lines that only name a holder of rights; they differ between copies of one licence.
COPYRIGHT_LINE = (
    r"(?m)^[^\p{L}\p{N}\n]*(copyright[^\p{L}\p{N}\n]*(\(c\)|©|[0-9]{4})|\(c\)|©|all rights reserved)[^\n]*$"
)
NOT_WORD = r"[^\p{L}\p{N}]+"

#: Words counted as the same word (fixed values).
SPELLINGS = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("copyright holder", "copyright owner"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("judgement", "judgment"),
    ("organisation", "organization"),
    ("noninfringement", "non infringement"),
    ("per cent", "percent"),
    ("whilst", "while"),
    ("https", "http"),
)

#: Known texts up to this many are sent to every executor; more are joined by a shuffle.
BROADCAST_ROWS = 100_000


def canonical(text: Column) -> Column:
    """Each word stands between blanks of its own, so that neighbours are replaced as well."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    out = F.concat(F.lit(" "), F.regexp_replace(out, NOT_WORD, "  "), F.lit(" "))
    for spelling, word in SPELLINGS:
        wide, plain = spelling.replace(" ", "  "), word.replace(" ", "  ")
        out = F.replace(out, F.lit(f" {wide} "), F.lit(f" {plain} "))
    return F.btrim(out)


def digests(known: DataFrame) -> DataFrame:
    """(digest, license_id) of `known` (license_id, text); empty forms are left out."""
    form = canonical(text_or_empty())
    return (
        known.select("license_id", form.alias("form"))
        .where("form <> ''")
        .groupBy(F.sha2("form", 256).alias("digest"))
        .agg(F.min("license_id").alias("license_id"))
    )


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, canonical_sha256, license_id (null: none known) of every row of `docs`."""
    names = digests(known)
    if names.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        names = F.broadcast(names)
    texts = docs.select(
        "doc_id", F.sha2(canonical(text_or_empty()), 256).alias("canonical_sha256")
    )
    return texts.join(names, texts["canonical_sha256"] == names["digest"], "left").select(
        "doc_id", "canonical_sha256", "license_id"
    )


def known_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(KNOWN), "license_id string, text string")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return scan(table(spark, folder, "documents"), known_licenses(spark))


def _canonical_sql(text: str) -> str:
    out = f"regexp_replace(lower({text}), '{COPYRIGHT_LINE}', ' ', 'g')"
    out = f"' ' || regexp_replace({out}, '{NOT_WORD}', '  ', 'g') || ' '"
    for spelling, word in SPELLINGS:
        wide, plain = spelling.replace(" ", "  "), word.replace(" ", "  ")
        out = f"replace({out}, ' {wide} ', ' {plain} ')"
    return f"trim({out}, ' ')"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_ROWS = ", ".join(f"({_literal(name)}, {_literal(text)})" for name, text in KNOWN)
SQL = f"""
with known(license_id, text) as (values {_ROWS}),
names as (
  select sha256(form) as digest, min(license_id) as license_id
  from (select license_id, {_canonical_sql("text")} as form from known) where form <> '' group by 1
), texts as (
  select doc_id, sha256({_canonical_sql("coalesce(text, '')")}) as canonical_sha256 from documents
)
select doc_id, canonical_sha256, license_id from texts left join names on canonical_sha256 = digest
"""
