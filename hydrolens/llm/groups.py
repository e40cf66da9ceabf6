"""Connected groups over a table of links, as joins and aggregates.

Every round hands each node the smallest label among its neighbours and its own, first from larger to smaller nodes and
then back, until no link changes (the alternating large-star and small-star steps). Rounds are written to the shared
folder; only a count and two sums reach the driver. A node with very many links is aggregated before it is
exchanged and its links are split by the adaptive join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from hydrolens.session import delete_path, stage, stage_path


def components(links: DataFrame) -> DataFrame:
    """`node` and `component` (smallest node reachable) for every node of `links` (columns `a`, `b`, not null)."""
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    spark, path = links.sparkSession, stage_path(links.sparkSession, "links")
    pairs = stage(pairs, path=path)
    before = _state(pairs)
    while before[0]:
        done, path = path, stage_path(spark, "links")
        pairs = stage(_small_star(_large_star(pairs)), path=path)
        delete_path(spark, done)
        after = _state(pairs)
        if after == before:
            break
        before = after
    members = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(roots)


def _state(pairs: DataFrame) -> tuple:
    """Number and two sums over hashes of the links, which tell one set of links from another."""
    each = [F.sum(F.xxhash64("a", "b", F.lit(i)).cast("decimal(38,0)")) for i in (0, 1)]
    return tuple(pairs.agg(F.count(F.lit(1)), *each).first())


def _large_star(pairs: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour (or itself)."""
    both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    moved = pairs.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


LEADERS = 2


def members(rows: DataFrame, classes: DataFrame, by: str, keep: Callable[[DataFrame, str], DataFrame] = stage) -> tuple[DataFrame, DataFrame]:
    """`doc_id` and `rep` of each id, and the links (`a`, `b`) of ids whose rows are in several classes.

    `rows` has `doc_id` and the column `by`, `classes` has `by` (once) and `rep`.
    """
    each = rows.select("doc_id", by).join(classes.select(by, "rep"), by).select("doc_id", "rep")
    own = keep(each.groupBy("doc_id").agg(F.min("rep").alias("rep"), F.max("rep").alias("last")), "members")
    several = own.where("rep <> last").select("doc_id", F.col("rep").alias("b"))
    return own.drop("last"), each.join(several, "doc_id").select(F.col("rep").alias("a"), "b")


def bucket_groups(entries: DataFrame, check: Callable[[DataFrame], DataFrame], known: DataFrame, keep: Callable[[DataFrame, str], DataFrame], most: int) -> DataFrame:
    """`rep` and `component` (smallest node reachable) of every node that links with another.

    `entries` has `key` (a bucket) and `rep`; `check` gives for distinct pairs (`a` < `b`) whether they are `linked`, and
    their distance `d`, or null where none is known; pairs farther apart than `most` are never linked. `known` holds links
    known beforehand (`a`, `b`); `keep` stores what several passes read. A bucket never makes all its pairs at once. First
    its members are checked against `LEADERS` of them, the first in as many hash orders, and links merge groups. Pairs of
    a bucket that then still are in different groups can only be linked if their distances from each leader differ by
    `most` at most (triangle inequality); only these come out of the join and are checked one by one, so no linked pair
    of a bucket is lost.
    """
    orders = [F.min(F.struct(F.xxhash64("rep", F.lit(i)).alias("h"), F.col("rep").alias("other"))).alias(f"first{i}") for i in range(LEADERS)]
    dealt = entries.repartition("key")
    shared = dealt.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), *orders).where("low <> high")
    leaders = F.array(*[f"first{i}.other" for i in range(LEADERS)]).alias("leaders")
    buckets = keep(dealt.join(shared.select("key", leaders), "key"), "buckets")

    tested = keep(check(_pairs(buckets.select("rep", F.explode("leaders").alias("other")))), "pairs")
    found = tested.where("linked").select("a", "b").unionByName(known)
    groups = keep(components(found), "near-groups")

    labelled = buckets.join(groups.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    labelled = keep(labelled.distinct(), "bucket-groups")
    split = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    rest = labelled.join(split.select("key"), "key", "left_semi")
    for i in range(LEADERS):
        leader = F.col("leaders")[i]
        rest = rest.withColumns({"a": F.least("rep", leader), "b": F.greatest("rep", leader)})
        rest = rest.join(tested.select("a", "b", F.col("d").alias(f"d{i}")), ["a", "b"], "left")
        rest = rest.withColumn(f"d{i}", F.when(F.col("rep") == leader, 0).otherwise(F.col(f"d{i}"))).drop("a", "b")
    rest = keep(rest.drop("leaders"), "split-buckets")
    two = rest.select("key", F.col("rep").alias("other"), F.col("component").alias("group"), *[F.col(f"d{i}").alias(f"e{i}") for i in range(LEADERS)])
    near = " AND ".join(f"coalesce(abs(d{i} - e{i}) <= {most}, true)" for i in range(LEADERS))
    both = rest.alias("one").join(two.alias("two"), F.expr(f"one.key = two.key AND rep < other AND component <> `group` AND {near}"))
    pairs = _pairs(both.select("rep", "other")).join(tested.select("a", "b"), ["a", "b"], "left_anti")
    more = keep(check(pairs), "more-pairs").where("linked").select("a", "b")
    if more.limit(1).count():  # each group stands for its links
        groups = components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    return groups.withColumnRenamed("node", "rep")


def _pairs(pairs: DataFrame) -> DataFrame:
    """Distinct pairs of different nodes, the smaller as `a`."""
    return pairs.where("rep <> other").select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()
