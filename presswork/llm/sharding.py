"""Shards of documents by a lookup table of prime size that the shards' permutations fill.

Each shard has an order of its own over all slots, ``(offset + j * skip) mod slots`` with
offset and skip from MD5 of its name; the number of slots is prime, so every such walk meets
each slot once. The shards take turns, and each takes the first slot of its walk that is
free, until none is. So all have the same number of slots, but for one, and a shard that goes
leaves most slots of the others where they were. A document belongs to the shard in the slot
that MD5 of its ``doc_id`` points to.

Only DataFrame functions. The table has a row per slot and is filled once, in one expression
over one row; the documents meet it in a broadcast join, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.tables import read_table
from presswork.storage import as_table

SHARDS = tuple(f"shard-{i:02d}" for i in range(32))
# Prime, and over a hundred slots a shard: their numbers of slots differ by less than 1%.
SLOTS = 4099
# The table is broadcast, and filling it takes time by the square of its size.
MOST_SLOTS = 20_000


def _hash(text: Column) -> Column:
    """The first 60 bits of MD5."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(
    spark: SparkSession, shards: Sequence[str] = SHARDS, slots: int = SLOTS
) -> DataFrame:
    """``slot, shard``, a row per slot. The names must differ, their order sets that of the
    turns; ``slots`` is a prime not below their number and not above ``MOST_SLOTS``."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("needs shards with names that differ")
    if not is_prime(slots) or not len(shards) <= slots <= MOST_SLOTS:
        raise ValueError(f"needs a prime from {len(shards)} to {MOST_SLOTS}: {slots}")
    names = F.array(*map(F.lit, shards))
    walks = F.transform(
        names,
        lambda name: F.transform(
            F.sequence(F.lit(0), F.lit(slots - 1)),
            lambda j: (
                (
                    _hash(F.concat(F.lit("offset:"), name)) % slots
                    + j * (_hash(F.concat(F.lit("skip:"), name)) % (slots - 1) + 1)
                )
                % slots
            ).cast("int"),
        ),
    )
    # A table of its own first: otherwise each turn would compute the walks again.
    begun = as_table(spark.range(1).select(walks.alias("walks")))

    def turn(filled: Column, number: Column) -> Column:
        shard = number % len(shards)
        walk = F.element_at("walks", shard + 1)
        free = F.filter(walk, lambda slot: F.element_at(filled, slot + 1) < 0)
        taken = F.element_at(free, 1)
        return F.element_at(
            F.transform(
                F.array(taken),
                lambda slot: F.transform(
                    filled, lambda held, j: F.when(j == slot, shard).otherwise(held)
                ),
            ),
            1,
        )

    filled = F.aggregate(
        F.sequence(F.lit(0), F.lit(slots - 1)), F.array_repeat(F.lit(-1), slots), turn
    )
    listed = begun.select(F.posexplode(filled).alias("slot", "_shard"))
    return as_table(listed.select("slot", F.element_at(names, F.col("_shard") + 1).alias("shard")))


def deal(docs: DataFrame, table: DataFrame, slots: int = SLOTS) -> DataFrame:
    """All rows and columns of ``docs``, with ``slot`` and ``shard``, which replace columns
    of these names. ``table`` is a lookup table with as many ``slots``.

    Rows that share a ``doc_id`` share their shard; a null ``doc_id`` counts as the empty
    string, so such rows are in one shard too. An empty table gives an empty one.
    """
    names = [name for name in docs.columns if name not in ("slot", "shard")]
    key = F.concat(F.lit("doc:"), F.coalesce(docs["doc_id"].cast("string"), F.lit("")))
    placed = docs.select(*[docs[name] for name in names], (_hash(key) % slots).cast("int").alias("slot"))
    return placed.join(F.broadcast(table), "slot").select(*names, "slot", "shard")


def op7_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id")
    return deal(documents, lookup_table(spark))


SQL = f"""
with recursive shards as (
  select i, 'shard-' || lpad(i::varchar, 2, '0') as shard
  from (select unnest(range(0, {len(SHARDS)})) as i)
), seeds as (
  select i, ('0x' || substr(md5('offset:' || shard), 1, 15))::bigint % {SLOTS} as first,
         ('0x' || substr(md5('skip:' || shard), 1, 15))::bigint % ({SLOTS} - 1) + 1 as skip
  from shards
), walks as materialized (
  select list(list_transform(range(0, {SLOTS}), lambda j: (first + j * skip) % {SLOTS}) order by i)
           as all_walks from seeds
), fill as (
  select 0 as turn, list_transform(range(0, {SLOTS}), lambda j: -1) as filled
  union all
  select turn + 1, list_concat(filled[: slot], [turn % {len(SHARDS)}], filled[slot + 2 :])
  from (
    select turn, filled,
           list_filter(all_walks[turn % {len(SHARDS)} + 1], lambda s: filled[s + 1] < 0)[1] as slot
    from fill, walks where turn < {SLOTS}
  )
), slots as (
  select unnest(range(0, {SLOTS}))::int as slot, unnest(filled) as i
  from fill where turn = {SLOTS}
), placed as (
  select doc_id, (('0x' || substr(md5('doc:' || coalesce(doc_id::varchar, '')), 1, 15))::bigint
                  % {SLOTS})::int as slot
  from documents
)
select doc_id, slot, shard from placed join slots using (slot) join shards using (i)
"""
