"""Quality rules whose thresholds come from the data of each language and source alone.

Every document gets a few counts, and from them whole-number ratios. The ratios of each (language, source) go into
a quantile sketch: a histogram whose buckets keep the six leading bits of a value. Such sketches merge by adding
counts, in any order, so partial aggregation builds them, the sketch of a language is the sum of those of its
sources, and reruns agree. Documents meet the fences of their group by a join.

A fence lies some spreads beyond the group's outer quartile; the spread is the way from the median to that quartile. Where most
documents of a group have none of something, the spread is 0, and that of the language takes its place, there from the
median to the outer tenth; then that of all documents; then one unit, the width of the finest bucket. A ratio of a short text
is a matter of chance, so its events are compared, not the ratio: those that the fence allows for a text of its size, and some
standard deviations of that number (of one event, where less is allowed).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import free_name, words
from tidewatch.runtime import materialize

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: Ratios: counted events, what they are counted in, the whole number of units that one stands for, and how many come
#: together at the least (a window of three words found twice is six words).
RATIOS = {
    "symbols": ("n_symbols", "n_words", 1000, 1),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 1),
    "repeats": ("n_repeat_words", "n_words", 1000, 6),
    "word_length": ("word_chars", "n_words", 100, 1),
}

#: Ratios that have a lower fence as well.
LOW = ("word_length",)

#: Quantiles read from a sketch, in hundredths.
QUANTILES = (25, 50, 75, 90)


@dataclass(frozen=True)
class Rules:
    #: Base rules: fewest words, and most percent of words in repeated three-word windows.
    least_words: int = 50
    most_repeats: int = 50
    #: Fences lie this many spreads outside the quartiles.
    spread: int = 3
    #: Groups with fewer documents take the sketch of their language, and that failing, of all.
    least_group: int = 100
    #: A document is outside when its events are more than this many standard deviations of their number beyond the fence.
    noise: int = 3


def count_text(text: str | None) -> tuple[int, ...]:
    """The `COUNTS` of one text; null has none of anything."""
    found = words(text)
    n = len(found)
    if not n:
        return (0, 0, sum((text or "").count(c) for c in SYMBOLS), 0, 0, 0)
    blanks = sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    dup_lines = len(lines) - len(set(lines))
    repeats = 0
    if n >= 3:
        windows = list(zip(found, found[1:], found[2:]))
        if len(set(windows)) < n - 2:
            often = Counter(windows)
            reach = 0  # words before this one are counted
            for i, window in enumerate(windows):
                if often[window] > 1:
                    repeats += i + 3 - max(i, reach)
                    reach = i + 3
    return (n, len(text) - blanks, symbols, len(lines), dup_lines, repeats)


def with_counts(docs: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """`docs` with one column per count, and the names they got."""
    names = {c: free_name(docs, c) for c in COUNTS}
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
                       + [f"`{n}` bigint" for n in names.values()])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(zip(*[count_text(t) for t in batch.column(text).to_pylist()])) or [()] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, pa.int64()) for c in found]],
                                             [*batch.schema.names, *names.values()])

    return docs.mapInArrow(count, schema), names


def base_failed(rules: Rules) -> str:
    return f"(n_words < {rules.least_words} or 100 * n_repeat_words > {rules.most_repeats} * n_words)"


def sketches(counted: DataFrame, rules: Rules) -> DataFrame:
    """(lang, source, ratio, bucket, n) over the documents that pass the base rules."""
    passed = counted.where(f"n_words > 0 and not {base_failed(rules)}")
    long = passed.select("lang", "source", *[
        F.expr(f"({unit} * {events}) div {of}").alias(k) for k, (events, of, unit, _) in RATIOS.items()]).unpivot(
        ["lang", "source"], list(RATIOS), "ratio", "value")
    long = long.withColumn("drop_bits", F.expr("greatest(0, length(bin(value)) - 6)"))
    bucket = F.expr("shiftleft(shiftright(value, drop_bits), drop_bits)").alias("bucket")
    return long.groupBy("lang", "source", "ratio", bucket).agg(F.count(F.lit(1)).alias("n"))


def merge(sketch: DataFrame, by: list[str]) -> DataFrame:
    """The sketches of coarser groups: counts add up."""
    return sketch.groupBy(*by, "ratio", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """(by..., ratio, n_docs, q25, q50, q75, q90); a sketch has at most some hundreds of buckets."""
    group = Window.partitionBy(*by, "ratio")
    sketch = sketch.withColumns({"n_docs": F.sum("n").over(group), "upto": F.sum("n").over(
        group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))})
    return sketch.groupBy(*by, "ratio").agg(F.max("n_docs").alias("n_docs"), *[
        F.min(F.when(100 * F.col("upto") >= q * F.col("n_docs"), F.col("bucket"))).alias(f"q{q}") for q in QUANTILES])


def fences(counted: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per (lang, source) among documents that pass the base rules: `high_<ratio>`, `low_<ratio>`."""
    fine = materialize(sketches(counted, rules), "quality-sketches")
    read = [f"q{q}" for q in QUANTILES]
    own = quantiles(fine, ["lang", "source"])
    lang = quantiles(merge(fine, ["lang"]), ["lang"]).withColumnsRenamed({c: f"{c}_" for c in ("lang", "ratio", "n_docs", *read)})
    every = quantiles(merge(fine, []), []).drop("n_docs").withColumnsRenamed({c: f"{c}__" for c in ("ratio", *read)})
    met = own.join(lang, F.col("lang").eqNullSafe(F.col("lang_")) & (F.col("ratio") == F.col("ratio_")))
    met = met.join(every, F.col("ratio") == F.col("ratio__"))
    use = {q: F.when(F.col("n_docs") >= rules.least_group, F.col(q)).when(
        F.col("n_docs_") >= rules.least_group, F.col(f"{q}_")).otherwise(F.col(f"{q}__")) for q in read}

    def spread(*ways: Column) -> Column:
        return F.coalesce(*[F.when(way > 0, way) for way in ways], F.lit(1))

    def way(upper: str, lower: str, mark: str) -> Column:
        return F.col(upper + mark) - F.col(lower + mark)

    up = spread(use["q75"] - use["q50"], way("q90", "q50", "_"), way("q90", "q50", "__"))
    down = spread(use["q50"] - use["q25"], way("q50", "q25", "_"), way("q50", "q25", "__"))
    met = met.select("lang", "source", "ratio", (use["q75"] + rules.spread * up).alias("high"),
                     F.greatest(F.lit(0), use["q25"] - rules.spread * down).alias("low"))
    parts = [F.max(F.when(F.col("ratio") == r, F.col("high"))).alias(f"high_{r}") for r in RATIOS]
    parts += [F.max(F.when(F.col("ratio") == r, F.col("low"))).alias(f"low_{r}") for r in LOW]
    return materialize(met.groupBy("lang", "source").agg(*parts), "quality-fences")


def judge(counted: DataFrame, limits: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """`counted` with `base_failed` and `kept`."""
    limits = limits.withColumnsRenamed({"lang": "lang_", "source": "source_"})
    met = counted.join(limits, F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_")), "left")
    inside = F.lit(True)
    for ratio, (events, of, unit, lump) in RATIOS.items():
        for sign, fence in ((1, f"high_{ratio}"), (-1, f"low_{ratio}")):
            if sign > 0 or ratio in LOW:
                # In units: events, what the fence allows, and the variance of that, which is at least one event's.
                allowed = F.col(fence).cast("double") * F.col(of)
                beyond = sign * (float(unit) * F.col(events) - allowed)
                variance = float(unit * lump) * F.greatest(allowed, F.lit(float(unit * lump)))
                inside = inside & ((beyond <= 0) | (beyond * beyond <= float(rules.noise ** 2) * variance))
    met = met.withColumn("base_failed", F.expr(base_failed(rules)))
    met = met.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
    return met.drop(*limits.columns)


def quality_verdicts(docs: DataFrame, rules: Rules = Rules(), doc_id: str = "doc_id", text: str = "text",
                     lang: str = "lang", source: str = "source") -> DataFrame:
    """(doc_id, the counts, base_failed, kept), one row per input row.

    Null and empty texts have no words and fail the base rules. Null languages and sources are groups of their
    own. Each row is judged for itself (repeated rows count each in the sketches); an empty table gives no rows.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"),
                         F.col(source).alias("source"))
    counted = materialize(with_counts(narrow)[0].drop("text"), "quality-counts")
    return judge(counted, fences(counted, rules), rules).drop("lang", "source")


def keep_good(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang",
              source: str = "source") -> DataFrame:
    """The rows of `docs` that pass, with the columns of `docs` only.

    The counts are taken a second time beside the texts, which spares a shuffle of the texts.
    """
    first = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    limits = fences(materialize(with_counts(first)[0].drop("text"), "quality-counts"), rules)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    second = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"), whole)
    return judge(with_counts(second)[0], limits, rules).where("kept").select("row.*")


#: The verdicts in SQL.
SQL = r"""
with split as (
  select doc_id, lang, source, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), lines as (
  select doc_id, count(*)::bigint as n_lines, (count(*) - count(distinct line))::bigint as n_dup_lines
  from (select doc_id, unnest(string_split(text, chr(10))) as line from split)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id
), places as (select doc_id, w, unnest(range(1, len(w) - 1)) as i from split where len(w) >= 3
), windows as (
  select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as often from places
), repeats as (
  select doc_id, count(distinct place)::bigint as n_repeat_words
  from (select doc_id, unnest([i, i + 1, i + 2]) as place from windows where often > 1) group by doc_id
), counted as (
  select doc_id, lang, source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
  from split left join lines using (doc_id) left join repeats using (doc_id)
), judged as (select *, (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed from counted
), long as (
  select lang, source, unnest(['symbols', 'dup_lines', 'repeats', 'word_length']) as ratio,
    unnest([1000 * n_symbols // n_words, 1000 * n_dup_lines // n_lines, 1000 * n_repeat_words // n_words,
            100 * word_chars // n_words]) as value from judged where not base_failed
), fine as (
  select lang, source, ratio, (value >> greatest(0, length(bin(value)) - 6)) << greatest(0, length(bin(value)) - 6) as bucket,
    count(*) as n from long group by all
), levels as (
  select 1 as level, lang, source, ratio, bucket, n from fine
  union all select 2, lang, null, ratio, bucket, sum(n) from fine group by all
  union all select 3, null, null, ratio, bucket, sum(n) from fine group by all
), ranked as (
  select *, sum(n) over (partition by level, lang, source, ratio) as n_docs,
    sum(n) over (partition by level, lang, source, ratio order by bucket rows unbounded preceding) as upto from levels
), quantiles as (
  select level, lang, source, ratio, max(n_docs) as n_docs, min(bucket) filter (100 * upto >= 25 * n_docs) as q25,
    min(bucket) filter (100 * upto >= 50 * n_docs) as q50, min(bucket) filter (100 * upto >= 75 * n_docs) as q75,
    min(bucket) filter (100 * upto >= 90 * n_docs) as q90 from ranked group by all
), used as (
  select a.lang, a.source, a.ratio,
    case when a.n_docs >= 100 then a.q25 when b.n_docs >= 100 then b.q25 else c.q25 end as q25,
    case when a.n_docs >= 100 then a.q50 when b.n_docs >= 100 then b.q50 else c.q50 end as q50,
    case when a.n_docs >= 100 then a.q75 when b.n_docs >= 100 then b.q75 else c.q75 end as q75,
    coalesce(nullif(b.q90 - b.q50, 0), nullif(c.q90 - c.q50, 0), 1) as wide_up,
    coalesce(nullif(b.q50 - b.q25, 0), nullif(c.q50 - c.q25, 0), 1) as wide_down
  from quantiles a join quantiles b on b.level = 2 and a.lang is not distinct from b.lang and a.ratio = b.ratio
    join quantiles c on c.level = 3 and a.ratio = c.ratio where a.level = 1
), limits as (
  select lang, source, ratio, q75 + 3 * coalesce(nullif(q75 - q50, 0), wide_up) as high,
    greatest(0, q25 - 3 * coalesce(nullif(q50 - q25, 0), wide_down)) as low from used
), fences as (
  select lang, source, max(high::double) filter (ratio = 'symbols') as high_symbols, max(high::double) filter (ratio = 'dup_lines') as high_dup_lines,
    max(high::double) filter (ratio = 'repeats') as high_repeats, max(high::double) filter (ratio = 'word_length') as high_word_length,
    max(low::double) filter (ratio = 'word_length') as low_word_length
  from limits group by all
), allowed as (
  select j.*, high_symbols * n_words as a1, high_dup_lines * n_lines as a2, high_repeats * n_words as a3,
    high_word_length * n_words as a4, low_word_length * n_words as a5
  from judged j left join fences f on j.lang is not distinct from f.lang and j.source is not distinct from f.source
), beyond as (
  select *, 1000.0::double * n_symbols - a1 as b1, 1000.0::double * n_dup_lines - a2 as b2, 1000.0::double * n_repeat_words - a3 as b3,
    100.0::double * word_chars - a4 as b4, a5 - 100.0::double * word_chars as b5 from allowed
)
select doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and coalesce((b1 <= 0 or b1 * b1 <= 9000 * greatest(a1, 1000)) and (b2 <= 0 or b2 * b2 <= 9000 * greatest(a2, 1000))
    and (b3 <= 0 or b3 * b3 <= 54000 * greatest(a3, 6000)) and (b4 <= 0 or b4 * b4 <= 900 * greatest(a4, 100))
    and (b5 <= 0 or b5 * b5 <= 900 * greatest(a5, 100)), false) as kept
from beyond
"""
