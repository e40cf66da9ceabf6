"""How filters of a table overlap: what each removes, in any order of application, and what that costs.

Each filter has a table of the ids that fail it, written once. What is left after a prefix of an order depends on the
filters of the prefix only, so the sets of filters serve all orders. The filters are put before the others one after
the other: a left-anti join with its table gives the failing ids that get past a filter, and they are removed after every
set so far also when it has been applied; a left-semi join gives those that it catches, which from then on are redundant
after every such set. So each table is joined twice, and an id is one row for each filter it fails, whatever the number
of sets. Ids carry their part of the table, the number of equal rows they stand for, and whether a label marks them;
ids with equal fates are summed before their sets are listed, and the report of all orders comes from these few rows.

Joins see only ids that fail a filter, as two numbers each; texts are read once, to find what fails. Copies of a text are found by their hash; a text that very many rows
share is not exchanged to be compared with the first of them.

Edge cases: a null text is empty; rows without id fail no filter for being a copy, and no row is a copy of theirs; rows
equal in id, text and part count each; several labels of an id are taken together, any mark counting; rows without label
lose none; null and empty `lang` are one part; a table without rows has no parts. Other columns are passed over.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hydrolens.operators.lookup import lookup_join
from hydrolens.session import stage, staging

KEY = ["doc", "print"]
COPY = "E"


def text_filters() -> dict[str, Column]:
    """Conditions of failure on the whole `text`; copies of an earlier text (`E`) are found by `audit`."""
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count("text", F.lit("[A-Z]")) > 3 * F.length("text"),
        "D": F.rlike("text", F.lit("[#$%&*|]")),
    }


def ids(docs: DataFrame, labels: DataFrame, filters: dict[str, Column], part: Column) -> DataFrame:
    """A row for each distinct id and text: `doc`, `print`, `part`, `n` equal rows, labels, and each filter's failure."""
    with staging(docs.sparkSession) as keep:
        text = docs.select("doc_id", part.alias("part"), F.coalesce("text", F.lit("")).alias("text"))
        facts = text.select(
            "doc_id", "part", F.xxhash64("text", "part").alias("print"), F.unhex(F.sha2("text", 256)).alias("digest"), *[f.alias(name) for name, f in filters.items()]
        )
        facts = keep(facts, "audit-facts")
        first = facts.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
        facts = lookup_join(facts, first.select("digest", "first"), "digest").withColumn(COPY, F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))
        names = [*filters, COPY]
        rows = facts.groupBy("doc_id", "part", "print").agg(F.count(F.lit(1)).alias("n"), *[F.any_value(name).alias(name) for name in names])
        marks = labels.groupBy("doc_id").agg(*[F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c) for c in ("quality", "toxic")])
        rows = rows.join(marks, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("quality", "toxic")})
        # Rows without id keep their own prints, so the number that stands for them meets none of a real id.
        return stage(rows.select(F.coalesce("doc_id", F.lit(0)).alias("doc"), F.when(F.col("doc_id").isNull(), F.xxhash64("print")).otherwise(F.col("print")).alias("print"), "part", "n", "quality", "toxic", *names), "audit-ids")


def effects(rows: DataFrame, names: list[str]) -> DataFrame:
    """For each part, filter and set of other filters applied before it: what it has `removed`, what was `redundant`
    (removed by the set), and the `good` and `toxic` among the removed. Cases in which it removes nothing and nothing is
    redundant are left out. `rows` as `ids` gives them.
    """
    with staging(rows.sparkSession) as keep:
        counted = [*KEY, "part", "n", F.when(F.col("quality"), F.col("n")).otherwise(0).alias("good"), F.when(F.col("toxic"), F.col("n")).otherwise(0).alias("toxic")]
        failing = {name: keep(rows.where(name).select(*counted), f"failing-{name}") for name in names}

        # Each failing id with the sets after which its filter removes it, and those after which it is gone.
        none = F.expr("CAST(array() AS array<string>)")
        state = None
        for name, table in failing.items():
            own = table.select("*", F.lit(name).alias("filter"), F.array(F.lit("")).alias("removes"), none.alias("gone"))
            state = own if state is None else state.unionByName(own)
        for name in names:
            also = lambda sets: F.transform(sets, lambda before: F.concat(before, F.lit(name)))  # noqa: B023, E731
            others, earlier = state.where(F.col("filter") != name), failing[name].select(*KEY)
            passed = others.join(earlier, KEY, "left_anti").withColumns({"removes": F.concat("removes", also("removes")), "gone": F.concat("gone", also("gone"))})
            caught = others.join(earlier, KEY, "left_semi").withColumn("gone", F.concat("gone", also("gone"), also("removes")))
            state = keep(state.where(F.col("filter") == name).unionByName(passed).unionByName(caught), f"after-{name}")

        alike = state.groupBy("part", "filter", "removes", "gone").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
        zero = F.lit(0).cast("bigint")
        removed = alike.select("part", "filter", F.explode("removes").alias("before"), F.col("n").alias("removed"), zero.alias("redundant"), "good", "toxic")
        redundant = alike.select("part", "filter", F.explode("gone").alias("before"), zero.alias("removed"), F.col("n").alias("redundant"), zero.alias("good"), zero.alias("toxic"))
        sums = [F.sum(c).alias(c) for c in ("removed", "redundant", "good", "toxic")]
        return stage(removed.unionByName(redundant).groupBy("part", "before", "filter").agg(*sums), "audit-effects")


def interactions(rows: DataFrame, names: list[str]) -> DataFrame:
    """The report of all orders of the filters: for each part, order and step what the step's filter does."""
    found = effects(rows, names)
    totals = rows.groupBy("part").agg(F.sum("n").alias("rows"))

    # All orders of a handful of filters, the same for any table.
    steps = [
        ("".join(order), i + 1, name, "".join(sorted(order[:i], key=names.index)))
        for order in permutations(names)
        for i, name in enumerate(order)
    ]
    order, alone = Window.partitionBy("part", "filter_order").orderBy("step"), Window.partitionBy("part", "filter")
    zero = F.lit(0).cast("bigint")
    cells = totals.withColumn("cell", F.explode(F.array(*[F.struct(*map(F.lit, s)) for s in steps])))
    named = [F.col(f"cell.col{i + 1}").alias(c) for i, c in enumerate(("filter_order", "step", "filter", "before"))]
    joined = cells.select("part", "rows", *named).join(found, ["part", "before", "filter"], "left")
    joined = joined.withColumns({c: F.coalesce(c, zero) for c in ("removed", "redundant", "good", "toxic")})
    unique = F.max(F.when(F.length("before") == len(names) - 1, F.col("removed"))).over(alone)
    return joined.select(
        "part",
        "filter_order",
        "step",
        (F.col("rows") - F.sum("removed").over(order)).alias("kept"),
        "removed",
        "redundant",
        unique.alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("removed").over(alone).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`interactions` of the text filters and of copies on `docs`, by language."""
    filters = text_filters()
    return interactions(ids(docs, labels, filters, F.coalesce("lang", F.lit(""))), [*filters, COPY])
