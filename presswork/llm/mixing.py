"""Mixing sources to target weights, along a curriculum whose shares change with time.

Each source has a rate of words over the training time ``t`` in [0, 1],
``target * (1 + ramp * (2 t - 1))``. Its integral, the cumulative demand
``target * ((1 - ramp) t + ramp t^2)``, reaches the target at ``t = 1``. The documents
of a source, in a shuffled order, form a stream of words; the stream starts again as often
as the target demands. The position of a document is the time at which the cumulative
demand arrives at its first word, the inverse of that integral.

Only DataFrame functions. A source's running sum is taken in two steps, over buckets of
the shuffled order and inside each bucket, so a source with a third of all rows is spread
over as many tasks as it has buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presswork.llm.tables import read_table
from presswork.storage import as_table

WEIGHTS = (5, 2, 1)
# Sources of the weight at the same place: much of it early, evenly, late.
RAMPS = (-0.5, 0.0, 0.5)
MAX_REPEATS = 3
# Hex digits of the shuffling key that make a bucket: 4096 buckets a source.
BUCKET_DIGITS = 3


def count_words(text: str | Column) -> Column:
    """Runs of anything but ASCII white space; 0 for null."""
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(words, F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    ramps: Sequence[float] = RAMPS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """``source, source_size, target, ramp`` from one row ``source, source_size`` a source.

    Sources by code point, null last, take the weights in turn and share the total of all
    sizes. A target stops at ``max_repeats`` times the source's size and the rest is
    shared again by weight, until none is above: with the sources ordered by size per
    weight, the first k are capped for the least k at which the share of the next one fits.
    The table has a row per source to mix, so one task orders it.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    ranked = sizes.withColumn("_turn", turn)
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("_turn") + 1)
    ranked = ranked.withColumn("_weight", pick(weights).cast("long"))
    ranked = ranked.withColumn("ramp", pick(ramps).cast("double"))
    cap = F.col("source_size") * max_repeats
    by_cap = Window.orderBy(
        F.col("source_size") / F.col("_weight"), F.col("source").asc_nulls_last()
    )
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        ranked.withColumn("_place", F.row_number().over(by_cap))
        .withColumn("_left", F.sum("source_size").over(everything))
        .withColumn("_left", F.col("_left") - F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("_heavy", F.sum("_weight").over(rest))
    )
    fits = F.col("_left") * F.col("_weight") <= cap * F.col("_heavy")
    level = F.min(F.when(fits, F.struct("_place", "_left", "_heavy"))).over(everything)
    shared = F.col("_weight") * F.col("_level._left") / F.col("_level._heavy")
    target = F.when(F.col("_place") < F.col("_level._place"), cap.cast("double"))
    return levels.withColumn("_level", level).select(
        "source",
        "source_size",
        target.otherwise(shared.cast("double")).alias("target"),
        "ramp",
    )


def _position(share: Column, ramp: Column) -> Column:
    """The time at which the share of the target is reached."""
    root = F.sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * share)
    return F.when(ramp == 0, share).otherwise((root - (1 - ramp)) / (2 * ramp))


def mix(
    docs: DataFrame,
    size: Column | None = None,
    seed: int = 0,
    weights: Sequence[int] = WEIGHTS,
    ramps: Sequence[float] = RAMPS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """All rows and columns of ``docs`` (``doc_id``, ``source`` and, unless ``size`` is
    given, ``text``), with a struct ``mix``: ``size, source_size, target, passes, taken,
    positions``.

    ``passes`` is how often the mix takes the document, always whole; ``taken`` is its words
    times that; ``positions`` the training position of each pass, in order. The sum of
    ``taken`` over a source is off its target by half a document at most, and no document
    is taken more than ``max_repeats`` times. The order of the documents inside a source
    follows MD5 of seed and ``doc_id``, so reruns agree.

    Null texts and texts without words have size 0, take nothing, and pass where the stream
    is when their turn comes. A null source is a source of its own, the last. Rows that
    share a ``doc_id`` are rows of their own. An empty table gives an empty one. Other
    columns pass through, whatever their names, except that ``mix`` is replaced.
    """
    of_row = F.col("_row")
    rows = docs.select(
        F.struct(*[docs[name] for name in docs.columns if name != "mix"]).alias("_row"),
        docs["source"].alias("source"),
        (count_words(docs["text"]) if size is None else size).alias("_size"),
        F.md5(F.concat(F.lit(f"{seed}:"), docs["doc_id"].cast("string"))).alias("_key"),
        docs["doc_id"].alias("_id"),
    ).withColumn("_bucket", F.substring(F.coalesce("_key", F.lit("0")), 1, BUCKET_DIGITS))
    buckets = rows.groupBy("source", "_bucket").agg(F.sum("_size").alias("_words"))
    in_source = Window.partitionBy("source").orderBy("_bucket")
    buckets = buckets.withColumn("_before", F.sum("_words").over(in_source) - F.col("_words"))
    sizes = buckets.groupBy("source").agg(F.sum("_words").alias("source_size"))
    targets = source_targets(sizes, weights, ramps, max_repeats)
    placed = buckets.alias("b").join(
        targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))
    )
    placed = placed.select("b.source", "_bucket", "_before", "source_size", "target", "ramp")
    joined = rows.alias("r").join(
        placed.alias("p"),
        F.col("r.source").eqNullSafe(F.col("p.source"))
        & (F.col("r._bucket") == F.col("p._bucket")),
    )
    joined = joined.drop(F.col("p.source"), F.col("p._bucket"))
    in_bucket = Window.partitionBy("source", "_bucket").orderBy("_key", "_id", "_size")
    running = F.sum("_size").over(in_bucket.rowsBetween(Window.unboundedPreceding, -1))
    whole = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0))
    left = F.col("target") - whole * F.col("source_size")
    once_more = (F.col("_at") + F.col("_size") / 2 <= left).cast("long")
    passes = F.least(whole + once_more, F.lit(max_repeats)).cast("int")
    share = lambda turn: F.coalesce(
        (turn * F.col("source_size") + F.col("_at")) / F.nullif("target", F.lit(0.0)), F.lit(0.0)
    )
    turns = F.filter(
        F.array(*[F.lit(turn) for turn in range(max_repeats)]), lambda turn: turn < F.col("_passes")
    )
    mixed = (
        joined.withColumn("_at", F.col("_before") + F.coalesce(running, F.lit(0)))
        .withColumn("_passes", passes)
        .withColumn(
            "mix",
            F.struct(
                F.col("_size").alias("size"),
                "source_size",
                "target",
                F.col("_passes").alias("passes"),
                (F.col("_passes") * F.col("_size")).alias("taken"),
                F.transform(turns, lambda turn: _position(share(turn), F.col("ramp"))).alias(
                    "positions"
                ),
            ),
        )
    )
    names = [name for name in docs.columns if name != "mix"]
    return mixed.select(*[of_row[name].alias(name) for name in names], "mix")


def arrange(mixed: DataFrame) -> DataFrame:
    """The training order: a row per pass, range-sorted by ``position``, rows that are not
    taken left out. ``mix`` gives way to ``position``."""
    names = [mixed[name] for name in mixed.columns if name not in ("mix", "position")]
    passes = mixed.select(*names, F.explode("mix.positions").alias("position"))
    return passes.repartitionByRange("position", "doc_id").sortWithinPartitions(
        "position", "doc_id"
    )


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    sized = as_table(documents.select("doc_id", "source", count_words("text").alias("size")))
    mixed = mix(sized, size=sized["size"])
    first = F.round(F.try_element_at("mix.positions", F.lit(1)), 9)
    rows = mixed.select(
        "doc_id",
        "mix.size",
        "mix.source_size",
        "mix.target",
        "mix.taken",
        "mix.passes",
        first.alias("position"),
    )
    return rows.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


SQL = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint
         as size, md5('0:' || doc_id::varchar) as shuffled
  from documents
), sizes as (
  select source, sum(size)::bigint as source_size from sized group by source
), ranked as (
  select *, (row_number() over (order by source nulls last) - 1) % 3 as turn from sizes
), weighted as (
  select *, [5, 2, 1][turn + 1]::bigint as weight, [-0.5, 0.0, 0.5][turn + 1]::double as ramp
  from ranked
), levels as (
  select *, row_number() over by_cap as place,
         (sum(source_size) over () - coalesce(sum(source_size * 3) over (by_cap
          rows between unbounded preceding and 1 preceding), 0))::bigint as remaining,
         (sum(weight) over (by_cap rows between current row and unbounded following))::bigint
           as heavy
  from weighted
  window by_cap as (order by source_size / weight, source nulls last)
), level as (
  select place, remaining, heavy from levels
  where remaining * weight <= source_size * 3 * heavy order by place limit 1
), targets as (
  select s.source, s.source_size, s.ramp,
         case when s.place < l.place then (s.source_size * 3)::double
              else (s.weight * l.remaining)::double / l.heavy::double end as target
  from levels s, level l
), streams as (
  select d.doc_id, d.size, t.source_size, t.target, t.ramp,
         coalesce(sum(d.size) over (partition by d.source order by shuffled, doc_id, d.size
           rows between unbounded preceding and 1 preceding), 0)::bigint as at_word,
         coalesce(floor(t.target / nullif(t.source_size, 0)), 0)::bigint as whole
  from sized d join targets t on d.source is not distinct from t.source
), passed as (
  select *, least(whole + (at_word + size / 2 <= target - whole * source_size)::bigint, 3)::int
         as passes,
         coalesce(at_word / nullif(target, 0), 0) as share
  from streams
)
select doc_id, size, source_size, target, (passes * size)::bigint as taken, passes,
       case when passes > 0 then round(case when ramp = 0 then share
         else (sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * share) - (1 - ramp)) / (2 * ramp) end, 9)
       end as position
from passed
"""
