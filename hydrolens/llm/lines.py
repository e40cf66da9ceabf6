"""Removal of repeated runs of lines, by a suffix array over line numbers.

Each distinct line has a number, and a document is the sequence of the numbers of its lines that hold a word. Prefix
doubling ranks the suffixes of all documents: after k rounds two suffixes have one rank exactly if their first 2^k lines
agree, that is, if they stand in one interval of the suffix array whose longest common prefix is 2^k lines or more. A
round sorts the distinct pairs (rank here, rank 2^k lines on), numbers them in that order, and hands the numbers back.
Suffixes that no other shares have no common prefix and drop out, so later rounds hold repeated lines only. A run of
any length n between 2^k and 2^(k+1) has as its interval those suffixes that agree in the rank at its start and in the
rank that ends with it.

A line goes if it lies in a run of `min_words` words or more that also occurs at an earlier place, places being ordered
by `doc_id`, then by the text's hash, then by line. To find these lines it is enough to look at the shortest such
run from each line on and the shortest one up to each line: every longer repeated run is covered by these. As each
line has a word, such a run has at most `min_words` lines, so the number of rounds depends on `min_words` alone.

All of it is DataFrame operations. Ranks and counts are aggregated before they are exchanged; only hashes, ranks and
places are exchanged, and the texts once to be rewritten.

Edge cases: null and empty texts have no lines and stay as they are; lines without a word belong to no run and stay;
rows without id come before all others; rows equal in id and text count as one document and are rewritten alike; a
document none of whose words is left has the text "" and `emptied`. An empty table gives an empty table. Columns of the
input named `lines`, `removed_lines` or `emptied` are replaced; other columns stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from hydrolens.session import stage

MIN_WORDS = 50
PLACE = ["doc", "print"]
ADDED = ("lines", "removed_lines", "emptied")
_DOC = "coalesce(doc_id, -9223372036854775808)"
_WORDS = r"[^\\x20\\x09-\\x0D]+"


def line_places(docs: DataFrame) -> DataFrame:
    """A row for each line that holds a word: document, number of the line, number among those rows, words, and a 128-bit id."""
    cut = rf"""
      filter(
        transform(split(text, '\n', -1), (line, i) -> named_struct(
          'line', i, 'words', regexp_count(line, '{_WORDS}'), 'id1', xxhash64(line), 'id2', xxhash64(1L, line))),
        x -> x.words > 0)"""
    found = docs.select(F.expr(f"{_DOC} AS doc"), F.xxhash64("text").alias("print"), F.posexplode(F.expr(cut)).alias("at", "x"))
    return found.select(*PLACE, "at", "x.line", "x.words", "x.id1", "x.id2")


def ranked(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The distinct keys that occur more than once, numbered in their order."""
    several = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    ordered = several.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stage(ordered.withColumn(name, F.monotonically_increasing_id()), "line-ranks")


def shortest_runs(first: DataFrame, min_words: int) -> DataFrame:
    """For each repeated line the shortest run of repeated lines with `min_words` words that starts or ends there.

    `first` has the places of repeated lines, `line` and `words`. Result: document, `start`, `size` in lines, `run` (the
    numbers of its lines).
    """
    order = Window.partitionBy(*PLACE).orderBy("at")
    near = F.collect_set(F.struct("at", "words", "line"))
    both = first.select(
        *PLACE, "at",
        F.array_sort(near.over(order.rangeBetween(0, min_words - 1))).alias("on"),
        F.reverse(F.array_sort(near.over(order.rangeBetween(1 - min_words, 0)))).alias("back"),
    )

    def run(side: str, step: str) -> str:
        return f"""aggregate({side}, named_struct('words', 0L, 'run', CAST(array() AS array<int>)),
          (s, x) -> IF(s.words < {min_words} AND x.at = at {step} size(s.run),
                       named_struct('words', s.words + x.words, 'run', concat(s.run, array(x.line))), s))"""

    sides = both.select(*PLACE, F.expr(f"explode(array(struct(at AS till, true AS forward, {run('on', '+')} AS r), struct(at AS till, false AS forward, {run('back', '-')} AS r))) AS x"))
    held = sides.where(f"x.r.words >= {min_words}").select(*PLACE, F.col("x.till").alias("at"), F.col("x.forward").alias("forward"), F.expr("IF(x.forward, x.r.run, reverse(x.r.run)) AS run"))
    return held.select(*PLACE, F.expr("IF(forward, at, at - size(run) + 1) AS start"), F.expr("size(run) AS size"), "run").dropDuplicates([*PLACE, "start", "size"])


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Document, hash of its text, and the sorted numbers of its lines to remove, for documents that have any."""
    places = stage(line_places(docs), "lines")
    ids = ["id1", "id2"]
    first = stage(places.join(ranked(places, ids, "rank"), ids).drop(*ids), "repeated-lines")
    runs = stage(shortest_runs(first, min_words), "line-runs")
    longest = runs.agg(F.max("size")).first()[0] or 0

    keyed, ranks, k = [], first.select(*PLACE, "at", "rank"), 0
    while longest >= 1 << k:
        span = 1 << k
        own = runs.where(f"size >= {span} AND size < {2 * span}").withColumn("at", F.col("start"))
        start = own.join(ranks.withColumnRenamed("rank", "left").dropDuplicates([*PLACE, "at"]), [*PLACE, "at"])
        if span == 1:
            keyed.append(start.withColumn("right", F.col("left")))
        else:
            start = start.withColumn("at", F.expr(f"start + size - {span}"))
            keyed.append(start.join(ranks.withColumnRenamed("rank", "right").dropDuplicates([*PLACE, "at"]), [*PLACE, "at"]))
        k += 1
        if longest >= 1 << k:
            longer = runs.where(f"size >= {2 * span}").select(*PLACE).distinct()
            ranks = doubled(ranks.join(longer, PLACE, "left_semi"), span)
    if not keyed:
        return runs.select("doc", "print", F.col("run").alias("gone")).limit(0)

    every = keyed[0]
    for more in keyed[1:]:
        every = every.unionByName(more)
    every = stage(every.select(*PLACE, "start", "size", "run", "left", "right"), "line-intervals")
    interval, place = ["size", "left", "right"], F.struct(*PLACE, "start")
    earliest = every.groupBy(*interval).agg(F.min(place).alias("earliest"), F.max(place).alias("latest"))
    later = every.join(earliest.where("latest > earliest"), interval).where(place > F.col("earliest"))
    gone = later.select(*PLACE, F.explode("run").alias("line")).groupBy(*PLACE)
    return gone.agg(F.array_sort(F.collect_set("line")).alias("gone"))


def doubled(ranks: DataFrame, span: int) -> DataFrame:
    """Ranks over `2 * span` lines from ranks over `span` lines; places whose run is not repeated drop out."""
    ahead = Window.partitionBy(*PLACE).orderBy("at").rangeBetween(span, span)
    pairs = ranks.withColumn("right", F.max("rank").over(ahead)).where("right IS NOT NULL").withColumnRenamed("rank", "left")
    pairs = stage(pairs, "line-pairs")
    keys = ["left", "right"]
    return stage(pairs.join(ranked(pairs, keys, "rank"), keys).drop(*keys), "line-doubled")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with the later copies of repeated runs cut from `text`, the number of `lines` and `removed_lines`, and `emptied`."""
    gone = repeated_lines(docs.select("doc_id", "text"), min_words)
    named = docs.drop(*ADDED).withColumns({"__doc": F.expr(_DOC), "__print": F.xxhash64("text")})
    gone = gone.select(F.col("doc").alias("__doc"), F.col("print").alias("__print"), F.col("gone").alias("__gone"))
    rows = named.join(gone, ["__doc", "__print"], "left").withColumn("__cut", F.expr(r"split(text, '\n', -1)"))
    rest = "array_join(transform(array_except(sequence(0, size(__cut) - 1), __gone), i -> __cut[i]), '\\n')"
    rows = rows.withColumns({
        "text": F.expr(f"CASE WHEN __gone IS NULL THEN text ELSE {rest} END"),
        "lines": F.expr("coalesce(size(__cut), 0)"),
        "removed_lines": F.expr("coalesce(size(__gone), 0)"),
    })
    rows = rows.withColumn("__bare", F.expr(f"__gone IS NOT NULL AND NOT text RLIKE '{_WORDS}'"))
    rows = rows.withColumns({"emptied": F.col("__bare"), "text": F.expr("IF(__bare, '', text)")})
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ADDED], *ADDED)
