"""Near-duplicate documents by circulant MinHash, banding and exact verification.

A text is lower-cased (A-Z only) and cut into words at ASCII white space; its set holds the distinct runs of five words
(the whole sequence if there are fewer), as 64-bit hashes. Two fixed permutations of 2^20 places make the whole
signature: the first scatters the set, the second gives the ranks, and coordinate k takes the smallest rank after
shifting the second permutation circularly by k. Signatures are cut into bands; documents that agree in a band are
candidates, and a candidate pair is linked if 100 * |intersection| >= percent * |union| of the full sets (85 unless given
otherwise). With 24 bands of four coordinates a pair with similarity 0.85 shares no band with probability
(1 - 0.85^4)^24 = 2 * 10^-8, one with 0.8 with 3 * 10^-6.

Equal sets are joined first, so copies stand as one. A bucket never makes all its pairs: its members are compared with
one lead, and links merge groups. Two members that are not linked through their lead can only be linked if what they
have besides the lead, or lack of it, agrees in part; such pairs are found by an exact filter on these small differences
(`_rest`) and compared on their full sets. So no link between members of a bucket is lost, and near copies of one text,
however many, cost one comparison each.

Edge cases: null and empty texts, and texts without a word, have the empty set and link with nothing; rows without id
link with nothing and have no component; rows that share an id are one node; a very long text is one set. An empty table
gives an empty table. Columns of the input named `n_shingles`, `component_id` or `kept` are replaced; others stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from hydrolens.llm.common import map_rows
from hydrolens.llm.groups import components, members
from hydrolens.session import stage

WORDS = 5
PLACES = 1 << 20
BANDS, ROWS = 24, 4
PERCENT = 85
SMALL = 200_000  # classes, about 46 MB as a hash table, that may be broadcast
REP = "struct<doc_id: bigint, digest: binary>"  # a class of equal sets: its smallest id and its digest
ADDED = ("n_shingles", "component_id", "kept")


class _WordHashes(dict):
    """64-bit hashes of words, remembering about 120,000 words."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < 120_000:
            self[word] = value
        return value


_HASHES = _WordHashes()


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's runs of five words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    runs = np.full(len(words) - width + 1, width, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            runs = _stirred(runs * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(words) - width + 1 + i])
    return np.unique(runs)


def _stirred(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=1)
def permutations(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and the ranks laid out so that row i holds all shifts for place i."""
    random = np.random.default_rng(20240229)
    scatter, ranks = random.permutation(PLACES).astype(np.uint32), random.permutation(PLACES).astype(np.uint32)
    ring = np.concatenate([ranks, ranks[:coordinates]])
    return scatter, np.lib.stride_tricks.sliding_window_view(ring, coordinates)


def signature(members: np.ndarray, coordinates: int = BANDS * ROWS) -> np.ndarray:
    """Coordinate k: the smallest rank of the scattered set under the second permutation shifted by k."""
    scatter, shifted = permutations(coordinates)
    places = np.unique(scatter[members & np.uint64(PLACES - 1)])
    best = np.full(coordinates, PLACES, np.uint32)
    for i in range(0, len(places), 1024):
        np.minimum(best, shifted[places[i : i + 1024]].min(0), out=best)
    return best


def band_keys(sig: np.ndarray) -> list[int]:
    """One signed 64-bit key for each band, its number included."""
    return [xxhash.xxh64_intdigest(sig[b * ROWS : (b + 1) * ROWS].tobytes(), b) - (1 << 63) for b in range(BANDS)]


def signed_documents(docs: DataFrame) -> DataFrame:
    """`doc_id`, size of its set, a 128-bit digest of the set, and the keys of its bands."""

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            found = shingles(row["text"])
            yield {
                "doc_id": row["doc_id"],
                "n_shingles": len(found),
                "digest": _digest(found),
                "bands": band_keys(signature(found)) if len(found) else [],
            }

    return map_rows(docs.select("doc_id", "text"), run, "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """`rep` and its full set, for the distinct classes in `wanted`; broadcast only after its rows were counted."""
    chosen = F.broadcast(wanted) if wanted.count() <= SMALL else wanted
    texts = docs.select("doc_id", "text").join(chosen.select(F.col("rep.doc_id").alias("doc_id")).distinct(), "doc_id", "left_semi")

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            found = shingles(row["text"])
            yield {"rep": {"doc_id": row["doc_id"], "digest": _digest(found)}, "members": found.view(np.int64)}

    made = map_rows(texts, run, f"rep {REP}, members array<bigint>")
    return made.join(chosen, "rep", "left_semi")


def _digest(members: np.ndarray) -> bytes | None:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest() if len(members) else None


def _alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs (`a`, `b`) with both sets (`one`, `two`), `common` and `linked`."""
    one = sets.select(F.col("rep").alias("a"), F.col("members").alias("one"))
    two = sets.select(F.col("rep").alias("b"), F.col("members").alias("two"))
    both = pairs.join(one, "a").join(two, "b").withColumn("common", F.expr("size(array_intersect(one, two))"))
    return both.withColumn("linked", F.expr(f"100 * common >= {percent} * (size(one) + size(two) - common)"))


def _buckets(classes: DataFrame) -> DataFrame:
    """`key`, `rep`, `n` of buckets with several members, with the bucket's `lead` (and its size `m`).

    The lead is the member that meets most others over all its buckets, so that the buckets of a group of near copies
    agree on one that is close to all.
    """
    entries = classes.select(F.explode("bands").alias("key"), "rep", "n")
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("low"), F.max("rep").alias("high"))
    met = stage(entries.join(shared.where("low <> high").select("key", "size"), "key"), "buckets")
    often = met.groupBy("rep").agg(F.sum("size").alias("often"))
    first = F.min(F.struct((-F.col("often")).alias("o"), F.col("rep").alias("lead"), F.col("n").alias("m"))).alias("first")
    leads = met.join(often, "rep").groupBy("key").agg(first).select("key", "first.lead", "first.m")
    return met.join(leads, "key").select("rep", "n", "lead", "m").where("rep <> lead").distinct()


def _rest(apart: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs (`a`, `b`) of different groups under one lead that may still be linked.

    `apart` has the members compared with each lead: `lead`, `rep`, sizes `m` and `n`, whether they are `linked`, and `d`,
    the members of one of both sets only. For two members x and y the difference of their sets is that of their d, so
    a link leaves at most g (|x| + |y|) of it, where g = (100 - percent) / (100 + percent), and needs
    (|d(x)| + |d(y)| - g (|x| + |y|)) / 2 common members of d(x) and d(y): at least one, if x is not linked with the
    lead. So the rarest members of d(x) and d(y), as many as exceed that need and one, have one in common. They are
    matched by classes of |d|, for which the need is known from both sides; members that no other d has match nothing.
    """
    several = apart.groupBy("lead").agg(F.count(F.lit(1)).alias("k"), F.bool_and("linked").alias("all")).where("k > 1 AND NOT all").select("lead")
    rows = apart.join(several, "lead", "left_semi").join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left")
    rows = rows.withColumns({"component": F.coalesce("component", "rep"), "size": F.size("d"), "wide": F.expr("1 + m div 48")})
    rows = stage(rows.withColumn("own", F.expr("size div wide")), "apart")
    each = rows.select("lead", "rep", F.explode("d").alias("member"))
    often = each.groupBy("lead", "member").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    each = each.join(often, ["lead", "member"])
    rank = F.row_number().over(Window.partitionBy("lead", "rep").orderBy("often", "member"))
    total = F.count(F.lit(1)).over(Window.partitionBy("lead", "rep"))
    each = each.select("lead", "rep", "member", rank.alias("rank"), total.alias("total"))
    each = each.join(rows.drop("d"), ["lead", "rep"]).withColumn("rank", F.expr("size - total + rank"))
    gap = f"({100 - percent} / {100 + percent}D)"
    reach = f"{gap} * n * (1 + 100D / {percent})"
    other = F.expr(f"explode(sequence(cast(greatest(0, floor((size - {reach}) / wide)) AS int), cast(floor((size + {reach}) / wide) AS int))) AS other")
    each = each.select("*", other)
    most = f"least(n * 100D / {percent}, m + (other + 1) * wide - 1)"  # how large the other set can be
    need = f"greatest(1, ceil((size + other * wide - {gap} * (n + {most})) / 2 - 1e-6))"
    each = stage(each.where(f"rank <= size - {need} + 1").select("lead", "member", "own", "other", "rep", "n", "size", "rank", "component", "linked"), "apart-members")
    left = each.where("NOT linked").select("lead", "member", "own", "other", *[F.col(c).alias(f"{c}1") for c in ("rep", "n", "size", "rank", "component")])
    right = each.select("lead", "member", F.col("own").alias("other"), F.col("other").alias("own"), *[F.col(c).alias(f"{c}2") for c in ("rep", "n", "size", "rank", "component")])
    need = f"greatest(1, ceil((size1 + size2 - {gap} * (n1 + n2)) / 2 - 1e-6))"
    met = left.join(right, ["lead", "member", "own", "other"]).where(f"component1 <> component2 AND rank1 <= size1 - {need} + 1 AND rank2 <= size2 - {need} + 1")
    met = met.where(f"100 * least(n1, n2) >= {percent} * greatest(n1, n2)")
    return met.select(F.least("rep1", "rep2").alias("a"), F.greatest("rep1", "rep2").alias("b")).distinct()


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """`doc_id`, `n_shingles` and `component_id` for each row of `docs` (`doc_id` bigint, `text`)."""
    signed = stage(signed_documents(docs), "minhash")
    named = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n"))
    classes = stage(classes.withColumn("rep", F.struct("doc_id", "digest")).drop("doc_id"), "equal-sets")
    own, shared_ids = members(named, classes, "digest")

    tests = stage(_buckets(classes), "lead-pairs")
    sets = stage(_sets(docs, tests.select("rep").union(tests.select("lead")).distinct()), "shingle-sets")
    compared = _alike(tests.select(F.col("rep").alias("a"), F.col("lead").alias("b"), "n", "m"), sets, percent)
    difference = F.expr("concat(array_except(one, two), array_except(two, one))").alias("d")
    apart = stage(compared.select(F.col("a").alias("rep"), F.col("b").alias("lead"), "n", "m", "linked", difference), "compared")
    links = shared_ids.unionByName(apart.where("linked").select(F.col("rep").alias("a"), F.col("lead").alias("b")))
    groups = stage(components(links), "near-groups")

    rest = stage(_rest(apart, groups, percent), "rest-pairs")
    if rest.limit(1).count():
        more = stage(_alike(rest, sets, percent).where("linked").select("a", "b"), "near-links")
        if more.limit(1).count():
            roots = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
            groups = components(more.unionByName(roots))
    whole = own.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", F.coalesce("component", "rep")["doc_id"].alias("component_id"))
    out = signed.select("doc_id", "n_shingles").join(whole, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def with_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """`docs` with `component_id` and `kept`: whether the row's id is the smallest of its group (rows without id stay)."""
    near = near_groups(docs, percent).select(F.col("doc_id").alias("__id"), "component_id").where("__id <> component_id").distinct()
    rows = docs.drop(*ADDED).join(near, F.col("doc_id") == F.col("__id"), "left").drop("__id")
    rows = rows.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
