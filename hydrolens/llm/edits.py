"""Fingerprints of whole texts by a randomised embedding of edit distance.

A text is walked character by character with coins that all texts share: at step t the character under the pointer is
written down, and coin (t, class of the character) says whether the pointer moves on. Texts a few edits apart fall back
into step soon after each edit, so a small edit distance gives a small Hamming distance of the written sequences. Coins
repeat after `PERIOD` steps, which lets one table lookup per character give the step at which the pointer moves on.

A fingerprint holds the written characters, hashed to four bits, at 256 sampled steps. The steps are spread evenly over
a range that follows the length of the text (its level, a power of two); the sample of a higher level, cut to a lower
level's range, is part of the lower one's, so texts of different lengths are compared on common steps. The likeness of
two fingerprints is their agreement there, less what chance gives: 1 for equal texts, near 0 for unrelated ones.

Near-duplicates: bands of sampled positions make buckets, and candidates are verified by likeness of whole fingerprints.
A band holds twelve written characters (fewer for texts of some dozen characters), so unrelated texts, and texts with a
passage in common, rarely share one. Two texts of likeness 0.8 share one of 48 bands with probability 0.98, of 0.85 with
0.9997. Members of a bucket are compared with two leads; the others only if their distances from these allow a link.

The text after each document in descending id is found by sorting: a bounded sample of row keys gives the borders of
ranges, each range is one task that streams through its rows in order, and the row that opens a range is also sent to
the range before it. Texts are exchanged once, and a task holds two documents at a time.

Edge cases: a null text is empty, with a fingerprint of level and padding; empty texts are alike (1) and unlike any
other (0); rows without id come last, ordered by the hash of their text, which also orders rows that share an id; rows
equal in both are interchangeable; a single row follows itself; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from hydrolens.llm.common import map_rows
from hydrolens.llm.groups import bucket_groups, members
from hydrolens.session import stage, staging

PERIOD = 4096
CLASSES = 64
SAMPLES = 256
BASE = 8  # the lowest level: 2^8 steps
BANDS, WIDTH = 48, 12
PER_RANGE = 20  # sampled keys for each range
PAD = 16
AT_ONCE = 1024  # fingerprints whose band keys are worked out at once
_DIGITS = np.frombuffer(b"0123456789abcdef.", np.uint8)


@lru_cache(maxsize=1)
def coins() -> list[list[int]]:
    """For each class of characters and each step of the period, the step (in the period) after the pointer moves on."""
    random = np.random.default_rng(7_919)
    table = []
    for _ in range(CLASSES):
        heads = random.random(PERIOD) < 0.5
        heads[random.integers(PERIOD)] = True
        moves = np.flatnonzero(heads)
        nearest = np.searchsorted(moves, np.arange(PERIOD))
        table.append(((np.append(moves, moves[0] + PERIOD)[nearest] + 1) % PERIOD).tolist())
    return table


@lru_cache(maxsize=64)
def sampled_steps(level: int) -> np.ndarray:
    """The 256 steps of a level: half of its upper half, a quarter from the half below, and so on."""
    steps, count = [], SAMPLES // 2
    for octave in range(level, BASE, -1):
        steps.append((1 << (octave - 1)) + _octave(octave)[:count])
        count //= 2
    steps.append(_octave(BASE)[: SAMPLES >> (level - BASE)])
    return np.concatenate(steps)


def _octave(octave: int) -> np.ndarray:
    random = np.random.default_rng(104_729 + octave)
    if octave == BASE:
        return random.permutation(1 << BASE)
    return random.permutation(1 << (octave - 1))[: SAMPLES // 2] if octave < 20 else random.integers(0, 1 << (octave - 1), SAMPLES // 2)


def level_of(n_chars: int) -> int:
    """The smallest level whose range holds the usual walk of so many characters."""
    return max(BASE, int(np.ceil(np.log2(max(1, 2.2 * n_chars)))))


def _walk(classes: bytes, state: int) -> list[int]:
    table = coins()
    return [state := table[c][state] for c in classes]


class Walk:
    """The walk over one text: when the pointer reaches each character."""

    def __init__(self, text: str, known: Walk | None = None, same: int = 0):
        """`known` is the walk over a text that agrees in the first `same` characters, which are not walked again."""
        self.points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        classes = ((self.points * np.uint32(0x9E3779B1)) >> np.uint32(26)).astype(np.uint8)
        done = known.states[: same + 1] if known is not None else np.zeros(1, np.int64)
        rest = _walk(classes[same if known is not None else 0 :].tobytes(), int(done[-1]))
        self.states = np.concatenate([done, np.array(rest, np.int64)])
        self.arrivals = np.concatenate([[0], np.cumsum(np.diff(self.states) % PERIOD)])

    def symbols(self) -> tuple[int, np.ndarray]:
        """Level, and the four-bit hash of the character written at each sampled step (16 after the end)."""
        n = len(self.points)
        level = level_of(n)
        at = np.searchsorted(self.arrivals, sampled_steps(level), side="right") - 1
        hashed = ((self.points * np.uint32(0x85EBCA6B)) >> np.uint32(28)).astype(np.uint8)
        return level, np.append(hashed, np.uint8(PAD))[np.minimum(at, n)]


def fingerprint(text: str | None) -> str:
    return as_text(*Walk(text or "").symbols())


def as_text(level: int, symbols: np.ndarray) -> str:
    return f"{level:02d}:" + _DIGITS[symbols].tobytes().decode()


def from_text(fp: str) -> tuple[int, np.ndarray]:
    level, digits = fp.split(":")
    return int(level), np.array([PAD if d == "." else int(d, 16) for d in digits], np.uint8)


def lifted(level: int, symbols: np.ndarray, to: int, pad: int = PAD) -> np.ndarray:
    """The symbols of a fingerprint on the steps of a higher level."""
    for at in range(level, to):
        own, start, count = [np.full(SAMPLES // 2, pad, symbols.dtype)], 0, SAMPLES // 2
        for _ in range(at, BASE, -1):
            own.append(symbols[start : start + count // 2])
            start, count = start + count, count // 2
        left = SAMPLES - sum(map(len, own))
        symbols = np.concatenate([*own, symbols[start : start + left]])
    return symbols


def likeness(one: tuple[int, np.ndarray], two: tuple[int, np.ndarray]) -> float:
    """From 0 (no more alike than by chance) to 1 (equal)."""
    top = max(one[0], two[0])
    a, b = lifted(*one, top), lifted(*two, top)
    size = min(len(a), len(b))
    a, b = a[:size], b[:size]
    either = (a != PAD) | (b != PAD)
    if not either.any():
        return 1.0 if one[0] == two[0] and np.array_equal(one[1], two[1]) else 0.0
    share = float(((a == b) & either).sum() / either.sum())
    return min(1.0, max(0.0, (share - 1 / 16) / (15 / 16)))


def edited(text: str, following: str) -> tuple[str, int]:
    """The text with its last third replaced by the beginning of the one that follows, and the length that stays."""
    cut = len(text) // 3
    stays = len(text) - cut
    return text[:stays] + following[:cut], stays


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.col("doc_id").isNull().cast("int").alias("k1"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("k2"), F.xxhash64(text).alias("k3"))


def borders(keyed: DataFrame, ranges: int) -> list[tuple[int, int, int]]:
    """The keys that open each range: the first of all, and others from the `PER_RANGE * ranges` rows of smallest hash."""
    keys = keyed.select("k1", "k2", "k3")
    least = keys.agg(F.min(F.struct("k1", "k2", "k3")).alias("k")).first()["k"]
    if least is None:
        return []
    sample = keys.orderBy(F.xxhash64("k2", "k3", "k1"), "k1", "k2", "k3").limit(PER_RANGE * ranges).collect()
    return sorted({tuple(least), *sorted(map(tuple, sample))[PER_RANGE // 2 :: PER_RANGE]})


def with_following(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows dealt out by range, sorted in descending id, each range closed by the row that follows it (`last`)."""
    keyed = _keyed(docs)
    opening = borders(keyed, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    count = max(1, len(opening))

    @F.pandas_udf("array<struct<range: int, last: boolean>>")
    def ranges(k1: pd.Series, k2: pd.Series, k3: pd.Series) -> pd.Series:
        out = []
        for key in zip(k1, k2, k3):
            i = bisect_right(opening, key) - 1
            out.append([{"range": i, "last": False}] + [{"range": (i - 1) % count, "last": True}] * (opening[i] == key))
        return pd.Series(out)

    dealt = keyed.withColumn("to", F.explode(ranges("k1", "k2", "k3"))).select("doc_id", "text", "k1", "k2", "k3", "to.range", "to.last")
    return dealt.repartitionById(count, "range").sortWithinPartitions("range", "last", "k1", "k2", "k3"), count


def edit_fingerprints(docs: DataFrame) -> DataFrame:
    """For each row of `docs` (`doc_id`, `text`) its fingerprint, that of its edited text, and their likeness.

    `near_edited` compares with the edited text, `near_next` with the document that follows in descending id.
    """

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        held, place, closed = None, None, False
        for row in rows:
            if row["range"] != place:
                held, place, closed = None, row["range"], False
            if closed:
                continue
            walk = Walk(row["text"])
            own = (row["doc_id"], row["text"], walk, walk.symbols())
            if held is not None:
                yield _result(held, own)
            held, closed = own, row["last"]

    dealt, _ = with_following(docs)
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return map_rows(dealt.select("doc_id", "text", "range", "last"), run, schema)


def _result(own: tuple, following: tuple) -> dict:
    doc_id, text, walk, symbols = own
    changed, same = edited(text, following[1])
    edit = Walk(changed, walk, same).symbols()
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
        "fingerprint": as_text(*symbols),
        "edited_fingerprint": as_text(*edit),
        "near_edited": likeness(symbols, edit),
        "near_next": likeness(symbols, following[3]),
    }


def with_components(docs: DataFrame) -> DataFrame:
    """`edit_fingerprints` with `component_id` (see `near_groups`)."""
    made = stage(edit_fingerprints(docs), "edit-fingerprints")
    near = components_of(made.select("doc_id", "n_chars", "fingerprint"))
    return made.join(near, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))


def _width(real: np.ndarray) -> np.ndarray:
    """Symbols in a band, by how many sampled steps a text reaches."""
    return np.array([2, 3, 5, 8, WIDTH])[np.searchsorted([8, 16, 32, 64], real, side="right")]


@lru_cache(maxsize=256)
def _bands(top: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each band of a level and width the order in which positions are sampled, their weights, and the band's own number."""
    random = np.random.default_rng([top, width])
    order = np.array([random.permutation(SAMPLES) for _ in range(BANDS)])
    # Of texts that reach half of the steps, the first 64 positions hold a full band as good as always.
    order = order[:, : 64 if width == WIDTH else SAMPLES]
    weights = random.integers(1, 1 << 63, order.shape, np.uint64) * np.uint64(2) + np.uint64(1)
    return order, weights, random.integers(1, 1 << 63, BANDS, np.uint64)


def band_keys(level: int, symbols: np.ndarray, top: int, width: int) -> np.ndarray:
    """Keys (texts x bands) of the rows of `symbols`, all of one level, on the steps of level `top`.

    A band takes positions in an order of its own until `width` of them lie within the text; those past its end that it
    meets on the way count too. So every band holds as many written characters, however short the text.
    """
    at = lifted(level, np.arange(symbols.shape[1], dtype=np.int64), top, -1)
    on = np.full((len(symbols), SAMPLES), PAD, np.uint8)
    on[:, : len(at)] = np.where(at >= 0, symbols[:, at], PAD)
    order, weights, number = _bands(top, width)
    keys = np.empty((len(symbols), BANDS), np.uint64)
    for band in range(BANDS):
        some = on[:, order[band]]
        real = some != PAD
        nth = np.cumsum(real, axis=1)
        taken = (nth < width) | (real & (nth == width))
        keys[:, band] = ((some + np.uint64(1)) * weights[band] * taken).sum(axis=1, dtype=np.uint64) + number[band]
    return _mixed(keys).view(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rows_of(prints: list[str]) -> np.ndarray:
    """The symbols of fingerprints of one level, a row each."""
    digits = np.frombuffer("".join(p[3:] for p in prints).encode(), np.uint8).reshape(len(prints), -1)
    table = np.zeros(256, np.uint8)
    table[_DIGITS] = np.arange(PAD + 1)
    return table[digits]


def keys_of(prints: list[str], chars: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(which of the texts, their keys) for each level, range and width under which texts of likeness `least` may meet.

    A text that a shorter or longer one of that likeness may follow across a border of levels or widths has keys on
    both sides: on the next level if a text longer by that share would be there, on the smaller width if a shorter one would be.
    """
    levels = np.array([int(p[:2]) for p in prints])
    longer = np.array([level_of(int(np.ceil(n / least)) + 1) for n in chars])
    for level in np.unique(levels):
        which = np.flatnonzero(levels == level)
        symbols = _rows_of([prints[i] for i in which])
        for top in (level, level + 1):
            here = np.ones(len(which), bool) if top == level else longer[which] > level
            on = lifted(level, np.arange(symbols.shape[1], dtype=np.int64), top, -1)
            real = (np.where(on >= 0, symbols[:, on], PAD) != PAD).sum(axis=1)
            own, smaller = _width(real), _width(np.floor(real * least))
            for width in np.unique(np.concatenate([own, smaller])):
                some = here & ((own == width) | (smaller == width)) & (real > 0)
                if some.any():
                    yield which[some], band_keys(level, symbols[some], top, int(width))


def near_groups(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """`doc_id`, `fingerprint` and `component_id`: the smallest id reachable over likenesses of `least` or more.

    Candidates share a band of sampled positions; equal texts count as one, empty texts and rows without id link with
    nothing.
    """

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            yield {"doc_id": row["doc_id"], "n_chars": len(row["text"] or ""), "fingerprint": fingerprint(row["text"])}

    made = stage(map_rows(docs.select("doc_id", "text"), run, "doc_id bigint, n_chars bigint, fingerprint string"), "edit-fingerprints")
    near = components_of(made, least)
    return made.select("doc_id", "fingerprint").join(near, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))


def likenesses(one: list[str], two: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """`likeness` of fingerprints pair by pair, and the steps in which they differ (-1 if their levels do)."""
    out, apart = np.empty(len(one)), np.full(len(one), -1)
    levels = np.array([(int(a[:2]), int(b[:2])) for a, b in zip(one, two)]).reshape(-1, 2)
    for level in np.unique(levels[levels[:, 0] == levels[:, 1], 0]):
        which = np.flatnonzero((levels == level).all(axis=1))
        a, b = _rows_of([one[i] for i in which]), _rows_of([two[i] for i in which])
        either = (a != PAD) | (b != PAD)
        n = either.sum(axis=1)
        apart[which] = (a != b).sum(axis=1)
        share = (n - apart[which]) / np.maximum(n, 1)
        out[which] = np.where(n > 0, np.clip((share - 1 / 16) / (15 / 16), 0, 1), 1.0)
    for i in np.flatnonzero(levels[:, 0] != levels[:, 1]):
        out[i] = likeness(from_text(one[i]), from_text(two[i]))
    return out, apart


def components_of(made: DataFrame, least: float = 0.8) -> DataFrame:
    """`doc_id` and `component_id` of the ids that have a text, once each; `made` has `doc_id`, `n_chars` and `fingerprint`."""
    spark = made.sparkSession

    def entries_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), AT_ONCE):
                part = batch.iloc[start : start + AT_ONCE]
                reps = part["rep"].to_numpy()
                for which, keys in keys_of(part["fingerprint"].tolist(), part["n_chars"].to_numpy(), least):
                    yield pd.DataFrame({"key": keys.ravel(), "rep": np.repeat(reps[which], keys.shape[1])})

    with staging(spark) as keep:
        named = made.where("doc_id IS NOT NULL AND n_chars > 0")
        classes = keep(named.groupBy("fingerprint").agg(F.min("doc_id").alias("rep"), F.max("n_chars").alias("n_chars")), "equal-fingerprints")
        own, shared_ids = members(named.select("doc_id", "fingerprint"), classes, "fingerprint", keep)
        entries = classes.mapInPandas(entries_of, "key bigint, rep bigint")
        texts = classes.select("rep", "fingerprint")

        @F.pandas_udf("linked boolean, d int")
        def compared(one: pd.Series, two: pd.Series) -> pd.DataFrame:
            alike, apart = likenesses(one.tolist(), two.tolist())
            return pd.DataFrame({"linked": alike >= least, "d": pd.array(np.where(apart < 0, None, apart), "Int32")})

        def check(pairs: DataFrame) -> DataFrame:
            one = texts.select(F.col("rep").alias("a"), F.col("fingerprint").alias("one"))
            two = texts.select(F.col("rep").alias("b"), F.col("fingerprint").alias("two"))
            return pairs.join(one, "a").join(two, "b").withColumn("x", compared("one", "two")).select("a", "b", "x.linked", "x.d")

        # Two texts whose fingerprints differ in more than this number of steps are less alike, however long they are.
        most = int(SAMPLES * 15 * (1 - least) / 16 + 1e-9)
        near = bucket_groups(entries, check, shared_ids, keep, most)
        return stage(own.join(near, "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("component_id")), "edit-components")
