"""Mixing sources to target weights by Pfair scheduling.

Every source's documents are put in a shuffled but fixed order and cut into blocks of `block_chars` characters. Time is
counted in slots, one block each. A source with weight w may run its block number j (from 0) from slot floor(j / w) on
and has to have run it by slot ceil((j + 1) / w). In each slot the released block with the earliest deadline runs, so
after any number of slots every source is less than one block away from its share.

Weights are whole shares of a cycle of slots, and the schedule repeats with the cycle, so one cycle is worked out
(with heaps over the sources; its length is set by their number and not by the rows) and every
block finds its slot by division. Once a source has run out, its slots stay empty and the others keep their order;
`on_target` is false from that slot on. No row is left out or repeated.

The place of a document within its source comes from sums over 4,096 ranges of a hash, so a source that holds most
rows is spread over that many groups.

Edge cases: rows without source form a source of their own; null and empty texts have size 0 and stand in the block
where they fall; a document longer than a block starts in one block and uses up the following ones; rows that are
equal in id and text are interchangeable; sources without positive weight come last, with a null slot; an empty table
gives an empty table. Columns of the input named like an added one (`mix_block`, `mix_slot`, `mix_offset`,
`on_target`) are replaced; other columns stay.
"""

from __future__ import annotations

from heapq import heappop, heappush

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

BLOCK_CHARS = 16_384
LEAST_CYCLE = 1_000
RANGES = 3  # leading hexadecimal digits of the hash
ADDED = ("mix_block", "mix_slot", "mix_offset", "on_target")


def source_key(source: Column) -> Column:
    """A text for each source, with one of its own for null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def place_key(doc_id: Column, text: Column) -> Column:
    """The hash that orders the documents of a source."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))


def source_totals(sized: DataFrame) -> dict[str, int]:
    """Characters of each source; one row per source comes to the driver."""
    return {r["__source"]: r["chars"] for r in sized.groupBy("__source").agg(F.sum("__chars").alias("chars")).collect()}


def tempered(totals: dict[str, int]) -> dict[str, int]:
    """Default targets: the whole square root of a source's characters, so large sources count less than their size."""
    return {name: max(1, _whole_root(chars)) for name, chars in totals.items()}


def _whole_root(n: int) -> int:
    from math import isqrt

    return isqrt(int(n))


def shares(weights: dict[str, float]) -> tuple[dict[str, int], int]:
    """Whole shares of a cycle for positive weights, at least one each, the rest by largest remainder; the cycle."""
    positive = {name: w for name, w in sorted(weights.items()) if w and w > 0}
    if not positive:
        return {}, 0
    cycle = max(LEAST_CYCLE, 8 * len(positive))
    free, total = cycle - len(positive), sum(positive.values())
    parts = {name: divmod(w * free, total) for name, w in positive.items()}
    whole = {name: 1 + int(p[0]) for name, p in parts.items()}
    left = cycle - sum(whole.values())
    for name in sorted(parts, key=lambda n: (-parts[n][1], n))[:left]:
        whole[name] += 1
    return whole, cycle


def schedule(spark: SparkSession, whole: dict[str, int], cycle: int) -> DataFrame:
    """One cycle by earliest deadline first: `__source`, its block `__turn` in the cycle, and the `__slot`.

    Two heaps hold the next block of each source, by release time and by deadline: eight slots or so for each source.
    """
    names = sorted(whole)
    if not names:
        return spark.createDataFrame([], "__source string, __share int, __turn int, __slot int")
    ran, ready, waiting = [], [], [(0, i, 0) for i in range(len(names))]
    for slot in range(cycle):
        while waiting and waiting[0][0] <= slot:
            _, i, turn = heappop(waiting)
            heappush(ready, (-(-(turn + 1) * cycle // whole[names[i]]), i, turn))  # its deadline
        _, i, turn = heappop(ready)
        ran.append((names[i], whole[names[i]], turn, slot))
        if turn + 1 < whole[names[i]]:
            heappush(waiting, ((turn + 1) * cycle // whole[names[i]], i, turn + 1))
    return spark.createDataFrame(ran, "__source string, __share int, __turn int, __slot int")


def mix(docs: DataFrame, chars: Column, key: Column, weights: dict[str | None, float] | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """`docs` with the slot of each row's block, its offset in characters in its source, and whether all sources still had blocks.

    `chars` is the size of a row and `key` the hash that orders the rows of a source (see `place_key`). `weights` are by
    value of `source`, None for rows without; by default they are `tempered`. Order by `mix_slot`, `mix_offset` to read
    the mix.
    """
    spark = docs.sparkSession
    sized = docs.drop(*ADDED).withColumns({"__source": source_key(F.col("source")), "__chars": chars.cast("bigint"), "__key": key})
    sized = sized.withColumn("__range", F.substring("__key", 1, RANGES))
    totals = source_totals(sized.select("__source", "__chars"))
    named = tempered(totals) if weights is None else {("null" if s is None else f"={s}"): w for s, w in weights.items()}
    whole, cycle = shares({s: w for s, w in named.items() if s in totals})
    once = schedule(spark, whole, cycle)

    before = Window.partitionBy("__source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sized.groupBy("__source", "__range").agg(F.sum("__chars").alias("__sum"))
    ranges = ranges.select("__source", "__range", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy("__source", "__range").orderBy("__key").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("__before", F.coalesce(F.sum("__chars").over(within), F.lit(0)))
    placed = placed.join(ranges, ["__source", "__range"])
    placed = placed.withColumn("mix_offset", F.col("__start") + F.col("__before"))
    placed = placed.withColumn("mix_block", F.expr(f"mix_offset div {block_chars}"))

    counted = spark.createDataFrame([(s, whole[s]) for s in sorted(whole)], "__source string, __share int")
    placed = placed.join(F.broadcast(counted), "__source", "left")  # one row per source
    placed = placed.withColumn("__turn", F.expr("mix_block % __share").cast("int"))
    placed = placed.join(F.broadcast(once.drop("__share")), ["__source", "__turn"], "left")  # one cycle
    placed = placed.withColumn("mix_slot", F.expr(f"(mix_block div __share) * {cycle} + __slot"))
    end = _first_empty_slot(spark, once, totals, cycle, block_chars)
    placed = placed.withColumn("on_target", F.coalesce(F.col("mix_slot") < F.lit(end), F.lit(False)))
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ADDED], *ADDED)


def _first_empty_slot(spark: SparkSession, once: DataFrame, totals: dict[str, int], cycle: int, block_chars: int) -> int:
    """The slot in which some source first has no block left, from the totals by source and one cycle."""
    if not totals or not cycle:
        return 0
    blocks = spark.createDataFrame([(s, -(-int(n or 0) // block_chars)) for s, n in totals.items()], "__source string, blocks bigint")
    missing = once.join(F.broadcast(blocks), "__source").where("__turn = blocks % __share")
    return missing.agg(F.min(F.expr(f"(blocks div __share) * {cycle} + __slot"))).first()[0] or 0


def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """`mix` for rows of documents, by the length and hash of their text."""
    return mix(docs, F.coalesce(F.length("text"), F.lit(0)), place_key(F.col("doc_id"), F.col("text")), weights, block_chars)


def in_mixed_order(docs: DataFrame, weights: dict[str | None, float] | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of `docs` with the columns of `docs`, sorted into the mix; rows of sources without weight come last."""
    rows = mixed(docs, weights, block_chars)
    return rows.orderBy(F.col("mix_slot").asc_nulls_last(), "mix_offset", place_key(F.col("doc_id"), F.col("text"))).select(*[F.col(f"`{c}`") for c in docs.columns if c not in ADDED])
