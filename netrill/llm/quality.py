"""Quality rules: a threshold table compiled into one projection.

Every figure is a built-in expression over the row; no user function and no shuffle.

Edge cases: a null text counts as empty (no words, fails the word-count rule); a null
doc_id stays null; repeated rows are judged one by one; an empty table gives an empty
result; other columns of the input are never read. Very long texts are handled as a
whole: sorting makes the work n log n in the words of a text.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netrill.llm.common import BLANK_RUN, BLANKS, NOT_BLANK, held, table, text_or_empty

SYMBOLS = "#*$%&|<>"

#: Frequent function words of the four languages of the corpus (fixed values).
STOP_WORDS = (
    "the be to of and that have with a in is it for on was as are at by or this he "
    "le la les de des du un une et en que qui pour par est au pas il elle dans "
    "der die das und von den dem ein eine mit zu ist nicht auf im es sich auch für "
    "el los las del y una por con para como su al se lo"
).split()


class Rule(NamedTuple):
    """Keep a text while `least <= value <= most`; `value` names a figure or a ratio of figures."""

    name: str
    value: str
    least: float
    most: float


#: The ratio `a / b` is written as a pair of figures; a text without words has no ratios.
RULES = (
    Rule("word_count", "n_words", 50, 200_000),
    Rule("mean_word_length", "word_chars / n_words", 1.5, 20.0),
    Rule("symbols_per_word", "n_symbols / n_words", 0.0, 0.5),
    Rule("stop_word_share", "n_stop_words / n_words", 0.02, 1.0),
    Rule("repeated_line_share", "n_dup_lines / n_lines", 0.0, 0.5),
    Rule("repeated_word_share", "n_repeat_words / n_words", 0.0, 0.5),
)


def _verdict(rule: Rule) -> Column:
    over, _, under = rule.value.partition(" / ")
    value = F.col(over).cast("double")
    if under:
        value = value / F.nullif(F.col(under).cast("double"), F.lit(0.0))
    return F.coalesce(value.between(rule.least, rule.most), F.lit(False))


def measured(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) with the figures of every whole text."""
    text = text_or_empty()
    words = F.filter(F.split(text, BLANK_RUN), lambda word: word != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_BLANK))
    out = docs.select(F.col("doc_id"), F.col("text"))
    out = held(out, words=words, lines=lines)
    out = out.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda word: F.lower(word).isin(STOP_WORDS)))
        .cast("long")
        .alias("n_stop_words"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("codes"),
    )
    return _with_repeats(out)


def _with_repeats(frame: DataFrame) -> DataFrame:
    """Words in 3-word windows that occur twice or more.

    Windows are sorted by content, equal neighbours are kept, and the union of their
    places is counted from the gaps between consecutive starts.
    """
    plain = [name for name in frame.columns if name != "codes"]
    starts = F.when(F.size("codes") >= 3, F.sequence(F.lit(0), F.size("codes") - 3)).otherwise(
        F.array().cast("array<int>")
    )
    window = F.transform(
        starts,
        lambda i: F.struct(
            F.xxhash64(F.get("codes", i), F.get("codes", i + 1), F.get("codes", i + 2)).alias("code"),
            i.alias("start"),
        ),
    )
    out = held(frame, ordered=F.sort_array(window)).select(*plain, "ordered")

    def repeated(one: Column, place: Column) -> Column:
        before, after = F.get("ordered", place - 1)["code"], F.get("ordered", place + 1)["code"]
        return F.coalesce(one["code"] == before, F.lit(False)) | F.coalesce(
            one["code"] == after, F.lit(False)
        )

    found = F.transform(F.filter("ordered", repeated), lambda one: one["start"])
    out = held(out, found=F.sort_array(found)).select(*plain, "found")
    gaps = F.transform(
        "found",
        lambda start, place: F.least(
            F.lit(3), F.coalesce(F.get("found", place + 1) - start, F.lit(3))
        ),
    )
    total = F.aggregate(gaps, F.lit(0).cast("long"), lambda sum_, gap: sum_ + gap)
    return out.select(*plain, total.alias("n_repeat_words"))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Figures, base failure, the names of failed rules and the verdict of each document."""
    figures = measured(docs)
    failed = F.filter(
        F.array(*[F.when(~_verdict(rule), F.lit(rule.name)) for rule in rules]),
        lambda name: name.isNotNull(),
    )
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return figures.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_stop_words",
        "n_lines",
        base.alias("base_failed"),
        F.concat_ws(",", failed).alias("failed_rules"),
        (~base & (F.size(failed) == 0)).alias("kept"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents"))


def _rule_sql(rule: Rule) -> str:
    over, _, under = rule.value.partition(" / ")
    value = f"cast({over} as double)" + (f" / nullif(cast({under} as double), 0)" if under else "")
    return f"coalesce({value} between {rule.least} and {rule.most}, false)"


_STOPS = ", ".join(f"'{word}'" for word in STOP_WORDS)
_ALL = " and ".join(_rule_sql(rule) for rule in RULES)
_FAILED = ", ".join(
    f"case when not {_rule_sql(rule)} then '{rule.name}' end" for rule in RULES
)
SQL = rf"""
with docs as (
  select row_number() over () as rn, doc_id, coalesce(text, '') as text from documents
), split as (
  select rn, doc_id, text,
    regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
  from docs
), grams as (
  select rn, i, words[i] as a, words[i + 1] as b, words[i + 2] as c
  from split, unnest(range(1, len(words) - 1)) as t(i)
), twice as (
  select rn, i, count(*) over (partition by rn, a, b, c) as times from grams
), places as (
  select distinct rn, i + k as place from twice, unnest([0, 1, 2]) as u(k) where times > 1
), repeats as (
  select rn, count(*) as n from places group by rn
), figures as (
  select s.doc_id, cast(len(words) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
    cast(length(text) - length(translate(text, '{SYMBOLS}', '')) as bigint) as n_symbols,
    cast(len(lines) as bigint) as n_lines,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(len(list_filter(words, lambda w: lower(w) in ({_STOPS}))) as bigint) as n_stop_words,
    coalesce(r.n, 0) as n_repeat_words
  from split s left join repeats r on s.rn = r.rn
), judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    concat_ws(',', {_FAILED}) as failed_rules, {_ALL} as passed
  from figures
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words,
  n_lines, base_failed, failed_rules, not base_failed and passed as kept
from judged
"""
