"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every document gets a place in a seeded shuffle of its source. Its virtual finish time is the running number
of words of its source at its end, divided by the source's target; a source is queued up to `repeats` times
in a row. All sources are then served in the order of virtual time until the total budget is spent.

Neither order needs a sort in one task. The shuffle key is uniform, so slots of it cut a source evenly: a
source of n documents has about sqrt(n) slots of sqrt(n) documents, sums of the slots before a slot come from
one short row per slot. Virtual time is cut in slots in the same way, and only the slot in which the budget
runs out is put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import WORD, free_name, running_sums
from tidewatch.runtime import materialize

CYCLE = (1, 2, 3)
REPEATS = 3
SEED = "mix-1"


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def shuffle_key(doc_id: Column, size: Column, seed: str) -> Column:
    """A uniform hexadecimal key that depends on the document and the seed only."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")),
                             size.cast("string")).cast("binary"))


def source_targets(sized: DataFrame, cycle: tuple[int, ...] = CYCLE, repeats: int = REPEATS) -> DataFrame:
    """(source, n, source_size, place, weight, target) from rows (source, size).

    Weights repeat `cycle` over the sources in code point order, null last. Targets share the total of all
    sizes by weight; a target stops at `repeats` times its source's size and the excess goes to the others by
    weight. Taking sources by size per weight, those that stop come first, so running sums settle it in one pass.
    """
    stats = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    ranked = running_sums(stats.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], ["one"], "sources")
    weights = F.array(*[F.lit(w) for w in cycle])
    ranked = ranked.select("source", "n", "source_size", F.col("before_one").alias("place"),
                           F.get(weights, (F.col("before_one") % len(cycle)).cast("int")).cast("bigint").alias("weight"))
    order = [(F.col("source_size") / F.col("weight")).asc(), F.col("place").asc()]
    laid = materialize(running_sums(ranked, order, ["source_size", "weight"], "fill"), "targets")
    total, weight = laid.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weight = total or 0, weight or 0
    left = F.lit(total) - repeats * F.col("before_source_size")
    full = (repeats * F.col("source_size")).cast("double") * (F.lit(weight) - F.col("before_weight")) \
        <= F.col("weight").cast("double") * left
    laid = laid.withColumn("full", full)
    stopped = laid.where("full").agg(F.sum("source_size"), F.sum("weight")).first()
    rest, rest_weight = total - repeats * (stopped[0] or 0), weight - (stopped[1] or 0)
    share = F.col("weight") * F.lit(float(rest)) / F.lit(float(rest_weight or 1))
    return laid.select("source", "n", "source_size", "place", "weight",
                       F.when(F.col("full"), (repeats * F.col("source_size")).cast("double"))
                       .otherwise(share).alias("target"))


def queue(sized: DataFrame, targets: DataFrame, seed: str = SEED) -> DataFrame:
    """Add `key`, the source's columns, and `served`: the words of its source up to and with this document."""
    u = F.conv(F.substring("key", 1, 12), 16, 10).cast("double") / float(1 << 48)
    own = F.col("source").eqNullSafe(F.col("_source"))
    keyed = sized.withColumn("key", shuffle_key(F.col("doc_id"), F.col("size"), seed))
    keyed = keyed.join(targets.withColumnRenamed("source", "_source"), own).drop("_source")
    keyed = keyed.withColumn("slot", F.floor(u * F.ceil(F.sqrt("n"))))
    before = Window.partitionBy("place").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = keyed.groupBy("place", "slot").agg(F.sum("size").alias("in_slot"))
    slots = slots.select("place", "slot", F.coalesce(F.sum("in_slot").over(before), F.lit(0)).alias("before_slot"))
    inside = Window.partitionBy("place", "slot").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    return (keyed.join(slots, ["place", "slot"])
            .withColumn("served", F.col("before_slot") + F.sum("size").over(inside))
            .drop("slot", "before_slot"))


def finish_time(turn: Column) -> Column:
    return F.coalesce((turn * F.col("source_size") + F.col("served")) / F.col("target"), F.lit(0.0))


def truncate(queued: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """Add `copies`: how often each document is served before the budget, the sum of all sizes, is spent."""
    total, n = queued.agg(F.sum("size"), F.count(F.lit(1))).first()
    total, grain = total or 0, max(1, round((n * repeats) ** 0.5))
    turns = queued.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    turns = turns.withColumn("finish", finish_time(F.col("turn")))
    turns = turns.withColumn("time_slot", F.least(F.floor(F.col("finish") * grain), F.lit(2 * grain)))
    by_slot = Window.orderBy("time_slot").rowsBetween(Window.unboundedPreceding, 0)
    # One row per slot of virtual time: about twice the square root of the number of documents.
    spent = turns.groupBy("time_slot").agg(F.sum("size").alias("in_slot"))
    spent = spent.withColumn("until", F.sum("in_slot").over(by_slot))
    last = spent.where(F.col("until") > total).orderBy("time_slot").select(
        "time_slot", F.col("until") - F.col("in_slot")).first()
    if last is None:
        return queued.withColumn("copies", F.lit(repeats))
    slot, before = last
    names = ["finish", "place", "turn", "key", "doc_id"]
    in_order = Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, 0)
    edge = turns.where(F.col("time_slot") == slot).withColumn("spent", F.sum("size").over(in_order) + F.lit(before))
    # The first copy that no longer fits; everything earlier in virtual time is served.
    first_out = edge.where(F.col("spent") > total).orderBy(*names).select(*names[:4]).first()

    def served(turn: int) -> Column:
        own = [finish_time(F.lit(turn)), F.col("place"), F.lit(turn), F.col("key")]
        earlier = F.lit(False)
        for mine, bound in reversed(list(zip(own, first_out))):
            earlier = (mine < F.lit(bound)) | ((mine == F.lit(bound)) & earlier)
        return earlier.cast("int")

    copies = F.lit(0)
    for turn in range(repeats):
        copies = copies + served(turn)
    return queued.withColumn("copies", copies)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        cycle: tuple[int, ...] = CYCLE, repeats: int = REPEATS, seed: str = SEED,
        mark: Column | None = None) -> DataFrame:
    """(doc_id, source, mark, size, source_size, target, copies, taken), one row per input row.

    Null and empty texts have size 0 and are served at their place with 0 words; a null source is a source,
    the last one; repeated rows are documents of their own; an empty table gives no rows. `mark` is carried
    along, so that a caller can find its rows again.
    """
    sized = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                        count_words(F.col(text)).alias("size"), (F.lit(0) if mark is None else mark).alias("mark"))
    sized = materialize(sized, "mix-sizes")
    queued = materialize(queue(sized, materialize(source_targets(sized, cycle, repeats), "mix-targets"), seed), "mix-queue")
    out = truncate(queued, repeats).withColumn("taken", F.col("copies") * F.col("size"))
    return out.select("doc_id", "source", "mark", "size", "source_size", "target", F.col("copies").cast("int"),
                      F.col("taken").cast("bigint"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it, with the columns of `docs` only.

    Rows are met again by id and a digest of all their columns; rows equal in both are the same document
    several times, numbered on both sides.
    """
    doc_id = options.get("doc_id", "doc_id")
    digest, nth, copies, own = (free_name(docs, x) for x in ("_digest", "_nth", "_copies", "_own"))
    same = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in docs.columns])
    chosen = mix(docs, mark=same, **options)
    alike = Window.partitionBy("doc_id", "mark").orderBy("copies")
    chosen = chosen.withColumn(nth, F.row_number().over(alike)).select(
        F.col("doc_id").alias(own), F.col("mark").alias(digest), nth, F.col("copies").alias(copies))
    here = docs.withColumn(digest, same)
    here = here.withColumn(nth, F.row_number().over(Window.partitionBy(doc_id, digest).orderBy(F.lit(0))))
    met = here.join(chosen.where(F.col(copies) > 0).withColumnsRenamed({digest: digest + "r", nth: nth + "r"}),
                    F.col(doc_id).eqNullSafe(F.col(own)) & (F.col(digest) == F.col(digest + "r"))
                    & (F.col(nth) == F.col(nth + "r")))
    return met.withColumn(own, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(
        *[F.col(f"`{c}`") for c in docs.columns])


#: The mix of `documents` in SQL, in one ordered pass; the same shuffle key, the same arithmetic.
SQL = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents
), stats as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as place
  from sized group by source
), weighted as (select *, (place % 3 + 1)::bigint as weight from stats
), filled as (
  select *, coalesce(sum(source_size) over w, 0) as before_size, coalesce(sum(weight) over w, 0) as before_weight
  from weighted window w as (order by source_size::double / weight, place rows between unbounded preceding and 1 preceding)
), stops as (
  select *, (3 * source_size)::double * ((select sum(weight) from weighted) - before_weight)
    <= weight::double * ((select sum(source_size) from weighted) - 3 * before_size) as is_full from filled
), targets as (
  select source, place, source_size, case when is_full then (3 * source_size)::double else
    weight * ((select sum(source_size) from weighted) - 3 * (select coalesce(sum(source_size), 0) from stops where is_full))::double
    / ((select sum(weight) from weighted) - (select coalesce(sum(weight), 0) from stops where is_full))::double end as target
  from stops
), keyed as (
  select s.*, t.place, t.source_size, t.target,
    md5('mix-1|' || coalesce(doc_id::varchar, '') || '|' || size::varchar) as key
  from sized s join targets t on s.source is not distinct from t.source
), queued as (
  select *, (sum(size) over (partition by place order by key, doc_id rows unbounded preceding))::bigint as served from keyed
), turns as (
  select *, coalesce((turn * source_size + served)::double / target, 0.0) as finish
  from queued, (select unnest([0, 1, 2]) as turn)
), spent as (
  select *, sum(size) over (order by finish, place, turn, key, doc_id rows unbounded preceding) as spent from turns
), cut as (
  select *, bool_or(spent > (select sum(size) from sized)) over (order by finish, place, turn, key, doc_id rows unbounded preceding) as is_out
  from spent
)
select doc_id, size, source_size, target, (count(*) filter (not is_out) * size)::bigint as taken
from cut group by doc_id, key, size, source_size, target, served
"""
