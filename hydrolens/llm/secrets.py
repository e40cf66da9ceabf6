"""Secrets in text: fixed patterns, and character Markov models of random strings and ordinary identifiers.

Base spans are the leftmost non-overlapping matches of three patterns (`assign`, `access`, `hex`), kept if long enough.
Other strings of 16 or more letters, digits and `+/_=-` that touch no base span are scored by the log-likelihood ratio of
two first-order character models; those at or above `LEAST_RATIO` are added as `markov` spans. Both models come from
labelled samples: by default every base value of the table is a sample of a random string, and every other string of
`TRAIN_CHARS` or more characters one of an ordinary identifier. Only counts of character pairs leave the tasks, at most
68 * 68 for each label, and those are all that reaches the driver.

Everything is DataFrame operations. A match's place comes from the lengths of the pieces between matches, which `split`
and `regexp_extract_all` give in the same order.

Edge cases: a null text is empty and has no spans; texts are scanned whole, whatever their length; repeated rows have
the same spans; without samples every pair has the same ratio, 0, so no span is added; an empty table gives an empty
table. Columns of the input named like an added one (`spans`) are replaced, other columns stay.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# The base patterns and the least length of the part that counts.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = (("assign", ASSIGN, 2, 12), ("access", ACCESS, 0, 18), ("hex", HEX, 0, 16))
MARKOV = "markov"

CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
TRAIN_CHARS = 10
SAMPLE = r"[A-Za-z0-9+/_=-]{%d,}" % TRAIN_CHARS
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SIZE = len(ALPHABET) + 1  # one more for any other character
LEAST_RATIO = 12.0
EVEN = 0.5  # share of the random model that is even over all characters
SMOOTHING = 0.5
CHUNK = 128  # matches that one fold counts off
BACKING = 4.0  # weight, in counts, of the characters' overall frequencies in the identifiers' model


def _text(pattern: str) -> str:
    """A pattern as an SQL string."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def matches(text: str, pattern: str, group: int, least: int, kind: int, floor: str | None = None) -> str:
    """SQL for the array of (`start`, `kind`, `stop`, `value`) of the matches in `text` whose `group` has `least` or more characters.

    Places count code points, `stop` is exclusive, `value` is the group. `floor` is a pattern with the same kept matches
    that finds fewer others.
    """
    used = _text(floor or pattern)
    whole = f"regexp_extract_all({text}, {used}, 0)"
    value = f"regexp_extract_all({text}, {used}, {group})" if group else whole
    none = "CAST(array() AS array<struct<start: int, kind: int, stop: int, value: string>>)"
    pairs = f"""
      IF(size({whole}) = 0, CAST(array() AS array<struct<piece: string, found: string, value: string>>),
         zip_with(split({text}, {used}, -1), zip_with({whole}, {value}, (f, v) -> struct(f AS found, v AS value)),
                  (p, m) -> struct(p AS piece, m.found AS found, m.value AS value)))"""
    # Matches are counted off in chunks, so that no fold ever copies a long array: places within each chunk, then the
    # places at which the chunks begin.
    chunk = f"""
      aggregate(
        part,
        named_struct('at', 0, 'spans', {none}),
        (s, x) -> named_struct(
          'at', s.at + length(x.piece) + coalesce(length(x.found), 0),
          'spans', IF(length(x.value) >= {least},
            concat(s.spans, array(named_struct('start', s.at + length(x.piece), 'kind', {kind},
                                               'stop', s.at + length(x.piece) + length(x.found), 'value', x.value))),
            s.spans)))"""
    cut = f"transform(sequence(0, greatest(size(pairs) - 1, 0) div {CHUNK}), i -> slice(pairs, i * {CHUNK} + 1, {CHUNK}))"
    begins = "aggregate(chunks, array(0), (b, c) -> concat(b, array(element_at(b, -1) + c.at)))"
    placed = """
      flatten(zip_with(chunks, slice(begins, 1, size(chunks)), (c, b) -> transform(c.spans, x -> named_struct(
        'start', x.start + b, 'kind', x.kind, 'stop', x.stop + b, 'value', x.value))))"""
    return f"""
      transform(array({pairs}), pairs ->
        transform(array(transform({cut}, part -> {chunk})), chunks ->
          transform(array({begins}), begins -> {placed})[0])[0])[0]"""


def base_spans(text: str = "__text") -> str:
    """SQL for the base spans of a text, sorted by start, then kind."""
    floors = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}  # greedy runs: the same matches pass the length
    each = [matches(text, p, group, least, kind, floors.get(name)) for kind, (name, p, group, least) in enumerate(KINDS)]
    return f"array_sort(concat({', '.join(each)}))"


def character_numbers(value: Column) -> Column:
    """The place of each character in the alphabet, from 0, the last for any other."""
    return F.transform(F.split(value, ""), lambda c: F.when(F.instr(F.lit(ALPHABET), c) > 0, F.instr(F.lit(ALPHABET), c) - 1).otherwise(F.lit(SIZE - 1)))


def pair_numbers(numbers: Column) -> Column:
    """One number for each two neighbouring characters."""
    return F.zip_with(F.slice(numbers, 1, F.greatest(F.size(numbers) - 1, F.lit(0))), F.slice(numbers, 2, F.greatest(F.size(numbers) - 1, F.lit(0))), lambda a, b: a * SIZE + b)


def samples(docs: DataFrame) -> DataFrame:
    """Labelled strings of a table with `__text` and `__base`: `value`, and `label` 1 for base values, 0 for other strings."""
    found = docs.select(F.expr("transform(__base, x -> x.value)").alias("secret"), F.expr(f"regexp_extract_all(__text, {_text(SAMPLE)}, 0)").alias("strings"))
    labelled = F.concat(
        F.transform("secret", lambda v: F.struct(v.alias("value"), F.lit(1).alias("label"))),
        F.transform(F.array_except("strings", "secret"), lambda v: F.struct(v.alias("value"), F.lit(0).alias("label"))),
    )
    return found.select(F.explode(labelled).alias("x")).select("x.value", "x.label")


def train(labelled: DataFrame) -> list[float]:
    """For each pair of characters the log ratio of random strings to identifiers, from `value` and `label`."""
    pairs = labelled.select("label", F.explode(pair_numbers(character_numbers(F.col("value")))).alias("pair"))
    counts = {(r["label"], r["pair"]): r["n"] for r in pairs.groupBy("label", "pair").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not any(label == 0 for label, _ in counts) or not any(label == 1 for label, _ in counts):
        return [0.0] * (SIZE * SIZE)
    alone = [sum(counts.get((0, a * SIZE + b), 0) for a in range(SIZE)) + SMOOTHING for b in range(SIZE)]
    usual = [n / sum(alone) for n in alone]  # identifiers' characters whatever comes before
    table = []
    for a in range(SIZE):
        plain = [counts.get((0, a * SIZE + b), 0) + BACKING * usual[b] for b in range(SIZE)]
        noise = [counts.get((1, a * SIZE + b), 0) + SMOOTHING for b in range(SIZE)]
        for b in range(SIZE):
            random = EVEN / SIZE + (1 - EVEN) * noise[b] / sum(noise)
            table.append(math.log(random / (plain[b] / sum(plain))))
    return table


def log_ratio(value: Column, table: list[float]) -> Column:
    """Sum of a string's pair ratios."""
    ratios = F.expr("CAST(split('" + " ".join(f"{x:.6f}" for x in table) + "', ' ') AS array<double>)")
    return F.aggregate(pair_numbers(character_numbers(value)), F.lit(0.0), lambda total, pair: total + F.get(ratios, pair))


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `__text` (null as empty) and `__base` spans."""
    return docs.withColumn("__text", F.coalesce(F.col(f"`{text}`"), F.lit(""))).withColumn("__base", F.expr(base_spans()))


def untouched(found: str, base: str) -> str:
    """SQL for the spans of `found` that overlap no span of `base`.

    Base spans of one kind never overlap and stand in order, so of each kind only the last that starts before a span's
    end can reach into it; it is found by halving.
    """
    kinds = range(len(KINDS))
    sorted_kinds = ", ".join(f"filter({base}, b -> b.kind = {kind})" for kind in kinds)
    jumps = "array(" + ", ".join(str(1 << p) for p in reversed(range(31))) + ")"
    earlier = f"aggregate({jumps}, 0, (n, jump) -> IF(n <= size(spans) - jump AND spans[n + jump - 1].start < m.stop, n + jump, n))"
    clear = f"transform(array({earlier}), n -> n = 0 OR spans[greatest(n - 1, 0)].stop <= m.start)[0]"
    return f"""
      transform(array(struct({found} AS found, array({sorted_kinds}) AS kinds)), x ->
        filter(x.found, m -> forall(x.kinds, spans -> {clear})))[0]"""


def with_spans(docs: DataFrame, text: str = "text", labelled: DataFrame | None = None, least: float = LEAST_RATIO) -> DataFrame:
    """`docs` with `spans`: an array of (`start`, `kind`, `stop`, `value`), `kind` counting assign, access, hex, markov from 0."""
    found = with_base(docs.drop("spans"), text)
    table = train(samples(with_base(docs.select(text), text)) if labelled is None else labelled)
    found = found.withColumn("__more", F.expr(matches("__text", CANDIDATE, 0, 0, len(KINDS))))
    found = found.withColumn("__more", F.expr(untouched("__more", "__base")))
    scored = F.filter("__more", lambda m: log_ratio(m["value"], table) >= least)
    return found.withColumn("spans", F.array_sort(F.concat("__base", scored))).drop("__text", "__base", "__more")


def joined(spans: Column) -> Column:
    """Spans as `kind:start:stop`, comma-joined."""
    names = F.array(*[F.lit(name) for name, *_ in KINDS], F.lit(MARKOV))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))))


def span_report(docs: DataFrame) -> DataFrame:
    """Per document the number of base spans of each kind, a digest of these, and all spans."""
    found = with_spans(docs.select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = {kind})) AS bigint) AS n_{name}") for kind, (name, *_) in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
