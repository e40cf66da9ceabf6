"""A Merkle manifest of a dataset: one root, and for each row the hashes that prove it belongs to that root.

Rows are hashed where they are read, sorted by source and id in ranges, and cut into partitions of 16^3 consecutive
leaves of a source, so a partition is a whole subtree whatever the size of its source. Each partition works out its
own levels. Above that, partitions exchange subtree roots as in a butterfly: in round r the partitions that agree in
all base-16 digits but digit r form a group, swap the roots they hold for their 16^r partitions, and each hashes the
parent itself. So every partition of a group ends the round with its siblings and the next ancestor, ancestors are
hashed as often as there are partitions below them, and after the last round each partition holds the whole path to the
top of its source without any pass back down. Where the last subtree has too few partitions to stand opposite each
partition of its neighbours, its partitions take part in several groups. The first partition of each source then does
the same among the sources, and the partitions of a source read its path with their own.

A group holds at most 16 roots and a partition at most 4,096 leaves. What is sorted and exchanged is an id and 32 to
64 bytes a row, not the texts; the driver gets two numbers (most partitions of a source, number of sources).

Order: sources by the bytes of their name, none (null) first; rows of a source by id, rows without id first, equal ids
by the hash of the row. A node is the SHA-256 in hexadecimal of its children's hexadecimal hashes, 16 at a time, the last
ones fewer; levels are built while there is more than one node. Edge cases: each null field is marked as such, so null
and empty text differ; a single row is its own subroot, and the root if there is no other source; equal rows are leaves
each; columns beyond the hashed ones are passed over; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window, functions as F

from hydrolens.llm.common import map_rows
from hydrolens.session import stage, staging

FANOUT = 16
DEPTH = 3  # levels inside a partition
LEAVES = FANOUT**DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RANGE_BITS = 33  # monotonically_increasing_id: the partition above, the row below


def field(column: Column) -> Column:
    """A value with its length in bytes before it, or a mark of its absence."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: tuple[str, ...] = FIELDS, **instead: Column) -> Column:
    """The hash of a row (32 bytes); `instead` gives values to take for some fields."""
    return F.unhex(F.sha2(F.concat(*[field(instead.get(name, F.col(name))) for name in fields]), 256))


def parents(level: list[bytes]) -> list[bytes]:
    return [digest(b"".join(level[i : i + FANOUT])) for i in range(0, len(level), FANOUT)]


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def levels_of(leaves: list[bytes], whole: bool) -> list[list[bytes]]:
    """The levels of a partition, from its leaves on; `whole` if it holds all of its source."""
    levels = [leaves]
    while len(levels[-1]) > 1 if whole else len(levels) <= DEPTH:
        levels.append(parents(levels[-1]))
    return levels


def partitioned(leaves: DataFrame) -> DataFrame:
    """One row for each partition of `leaves` (`source`, `doc_id`, `leaf`, `other`), its rows packed in order.

    `source_no`, `part` and `parts` say which partition of which source it is; `root` is the partition's subtree root.
    """
    with staging(leaves.sparkSession) as keep:
        name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
        hashed = keep(leaves.select(name.alias("name"), "doc_id", "leaf", "other"), "merkle-leaves")
        order = ["name", "doc_id", "leaf"]
        rows = hashed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
        rows = keep(rows.withColumn("range", F.shiftright("at", RANGE_BITS)), "merkle-order")

        runs = rows.groupBy("name", "range").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
        of_source, before = Window.partitionBy("name"), Window.partitionBy("name").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        runs = keep(
            runs.select(
                "*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(of_source).alias("rows"), F.min("first").over(of_source).alias("opens")
            ),
            "merkle-runs",
        )
        # Sources are numbered by the range in which they open, of which there are as many as tasks, and by place in it.
        opening = runs.where("first = opens").select("name", "range", "first")
        ranges = opening.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
        earlier = ranges.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("earlier"))
        nth = F.row_number().over(Window.partitionBy("range").orderBy("first"))
        numbers = opening.withColumn("nth", nth).join(earlier, "range").select("name", (F.col("earlier") + F.col("nth") - 1).alias("source_no"))
        runs = keep(runs.join(numbers, "name").select("name", "range", "first", "start", "rows", "source_no"), "merkle-places")

        place = F.col("start") + F.col("at") - F.col("first")
        placed = rows.join(runs, ["name", "range"]).withColumn("place", place).withColumn("part", F.floor(place / LEAVES))
        dealt = placed.select("source_no", "part", "place", "rows", "doc_id", "leaf", "other").repartition("source_no", "part").sortWithinPartitions("source_no", "part", "place")
        return stage(map_rows(dealt, _packed, PACKED, 16), "merkle-parts")


PACKED = (
    "source_no bigint, part bigint, parts bigint, root string, ids array<bigint>, leaves binary, "
    "others array<struct<at: int, leaf: binary>>"
)


def _packed(rows: Iterator[dict]) -> Iterator[dict]:
    for (source_no, part), members in groupby(rows, key=lambda r: (r["source_no"], r["part"])):
        held = list(members)
        parts = -(-held[0]["rows"] // LEAVES)
        yield {
            "source_no": source_no,
            "part": part,
            "parts": parts,
            "root": levels_of([r["leaf"].hex().encode() for r in held], parts == 1)[-1][0].decode(),
            "ids": [r["doc_id"] for r in held],
            "leaves": b"".join(r["leaf"] for r in held),
            "others": [{"at": i, "leaf": r["other"]} for i, r in enumerate(held) if r["other"] is not None],
        }


PATH = "array<struct<before: string, after: string>>"


def butterfly(nodes: DataFrame, rounds: int) -> DataFrame:
    """`scope`, `part`, `digest` (the top of the scope) and `path` for each of `nodes` (`scope`, `part`, `parts`, `digest`).

    `path` has for each round the digests of the siblings before and after the node's ancestor.
    """
    state = nodes.withColumn("path", F.expr(f"CAST(array() AS {PATH})"))
    for done in range(rounds):
        span = FANOUT**done  # partitions below an ancestor
        state = (
            state.selectExpr("*", f"part DIV {span} AS node", f"part % {span} AS lane", f"parts > {span} AS goes_on")
            # A subtree that is cut short has fewer partitions than lanes; these serve the lanes left over too.
            .selectExpr("*", f"explode(IF(goes_on, sequence(lane, {span - 1}L, least({span}L, parts - node * {span})), array(lane))) AS to_lane")
            .groupBy("scope", "goes_on", F.expr(f"IF(goes_on, node DIV {FANOUT}, part)").alias("run"), "to_lane")
            .agg(F.sort_array(F.collect_list(F.expr("struct(node, digest, IF(lane = to_lane, struct(part, parts, path), NULL) AS member)"))).alias("swapped"))
            .selectExpr("scope", "goes_on", "transform(swapped, x -> x.digest) AS digests", "posexplode(swapped) AS (i, own)")
            .where("own.member IS NOT NULL")
            .selectExpr(
                "scope",
                "own.member.part",
                "own.member.parts",
                "IF(goes_on, sha2(array_join(digests, ''), 256), own.digest) AS digest",
                "IF(goes_on, concat(own.member.path, array(struct("
                "array_join(slice(digests, 1, i), '') AS before, array_join(slice(digests, i + 2, 16), '') AS after))), own.member.path) AS path",
            )
        )
    return state.select("scope", "part", "digest", "path")


def _rounds(nodes: int) -> int:
    count = 0
    while FANOUT**count < nodes:
        count += 1
    return count


def with_paths(parts: DataFrame) -> DataFrame:
    """`partitioned` rows with `subroot`, `root` and the `path` from the partition's root to it."""
    most, sources = parts.agg(F.max("parts"), F.max("source_no") + 1).first()
    inner = parts.select(F.col("source_no").alias("scope"), "part", "parts", F.col("root").alias("digest"))
    inner = stage(butterfly(inner, _rounds(most or 0)), "merkle-paths")
    leads = inner.where("part = 0").select(F.lit(0).alias("scope"), F.col("scope").alias("part"), F.lit(sources or 0).cast("bigint").alias("parts"), "digest")
    outer = butterfly(leads, _rounds(sources or 0)).select(F.col("part").alias("scope"), F.col("digest").alias("root"), F.col("path").alias("above"))
    paths = inner.join(outer, "scope").select(F.col("scope").alias("source_no"), "part", F.col("digest").alias("subroot"), "root", F.concat("path", "above").alias("path"))
    return parts.drop("root").join(paths, ["source_no", "part"])


def proofs(leaves: DataFrame) -> DataFrame:
    """`doc_id`, `leaf`, `subroot`, `root` and `proof` (siblings before and after, level by level) of each row.

    `leaves` has `source`, `doc_id`, `leaf` (32 bytes) and `other` (a leaf to be checked against the proof, or null).
    """

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        for row, at, leaves, path in _walk(rows):
            yield {"doc_id": row["ids"][at], "leaf": leaves[at].decode(), "subroot": row["subroot"], "root": row["root"], "proof": [{"before": b.decode(), "after": a.decode()} for b, a in path]}

    return map_rows(with_paths(partitioned(leaves)), run, f"doc_id bigint, leaf string, subroot string, root string, proof {PATH}", taken=4)


def verified(leaves: DataFrame) -> DataFrame:
    """`doc_id`, `leaf`, `subroot`, `root`, a digest of the proof, and whether `other` (or else the leaf) folds up to the root."""

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        for row, at, leaves, path in _walk(rows):
            folded = fold(row["changed"].get(at, leaves[at]), path)
            yield {
                "doc_id": row["ids"][at],
                "leaf": leaves[at].decode(),
                "subroot": row["subroot"],
                "root": row["root"],
                "proof_sha256": digest(b"".join(part for level in path for part in level)).decode(),
                "folded_root": folded.decode(),
                "verified": folded.decode() == row["root"],
            }

    schema = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return map_rows(with_paths(partitioned(leaves)), run, schema, taken=4)


def fold(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and the siblings on its path give."""
    for before, after in path:
        leaf = digest(before + leaf + after)
    return leaf


def _walk(rows: Iterator[dict]) -> Iterator[tuple[dict, int, list[bytes], list[tuple[bytes, bytes]]]]:
    """For each leaf of each partition: the partition, the leaf's place, all leaves, and the leaf's path."""
    for row in rows:
        size = len(row["ids"])
        leaves = [row["leaves"][32 * i : 32 * i + 32].hex().encode() for i in range(size)]
        row["changed"] = {c["at"]: c["leaf"].hex().encode() for c in row["others"]}
        levels = levels_of(leaves, row["parts"] == 1)
        above = [(p["before"].encode(), p["after"].encode()) for p in row["path"]]
        for at in range(size):
            if at % FANOUT == 0:  # leaves of one run share all but the first step
                shared = [_siblings(level, at // FANOUT**i) for i, level in enumerate(levels[1:-1], 1)] + above
            yield row, at, leaves, ([_siblings(leaves, at)] if len(levels) > 1 else []) + shared


def _siblings(level: list[bytes], at: int) -> tuple[bytes, bytes]:
    start = at - at % FANOUT
    return b"".join(level[start:at]), b"".join(level[at + 1 : start + FANOUT])
