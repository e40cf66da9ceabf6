"""Document scores by masked pseudo-likelihood under a small bidirectional network.

Tokens are characters. The network knows the 62 most frequent of the table, one class for all others and one for the edge
of a text. A character of the class of others has the probability of the class times its share of the class in all
texts (`backoff`), so every code point of the table has a probability of its own. Every
character in turn is hidden and predicted from the `SIDE` characters on either side of it: a layer of `HIDDEN` units over
the window (one table per place), then a softmax over the classes. The sum of the conditional log-probabilities of a
document's characters is its score.

What is learnt from comes from all texts: each task counts the windows of its texts, the counts are added up over all
tasks, and the network is trained in numpy on the table of counts. Training is spread over `SHARDS` shards of that table
(dealt by window, sorted, so a lost task repeats its steps): in each round every shard starts from the common weights
and makes one pass (more if it is small), and the results are averaged by the number of characters behind them. Only weights, a few ten
thousand numbers for each shard, pass the driver. A shard holds at most 64^5 / SHARDS windows, however large the input,
and goes through them in batches.

Edge cases: null and empty texts have no characters, score 0 and mean 0; a text of any length is scored whole, in
pieces; repeated rows have the same score; an empty table gives an empty table. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hydrolens.session import stage

CLASSES = 64
EDGE, OTHER = 0, CLASSES - 1
SIDE = 2
HIDDEN = 24
SHARDS = 8
ROUNDS = 4
LEAST_STEPS = 120  # a shard with few windows goes over them again until it has made so many steps
STEP = 0.006
BATCH = 2048
PIECE = 1 << 20
HELD = 1 << 20  # windows a task counts before it hands them on


def points_of(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le"), "<u4")


def character_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """`point` and `n`: how often each code point occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in batches:
            for value in batch.column(0):
                points, n = np.unique(points_of(value.as_py()), return_counts=True)
                for p, k in zip(points.tolist(), n.tolist()):
                    total[p] = total.get(p, 0) + k
        yield pa.RecordBatch.from_pydict({"point": pa.array(list(total), pa.int32()), "n": pa.array(list(total.values()), pa.int64())})

    return docs.select(text).mapInArrow(run, "point int, n bigint").groupBy("point").agg(F.sum("n").alias("n"))


def alphabet(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The 62 most frequent code points, sorted; class = place + 1."""
    return _most_frequent(character_counts(docs, text))


def _most_frequent(counts: DataFrame) -> np.ndarray:
    top = counts.orderBy(F.desc("n"), "point").limit(CLASSES - 2).collect()
    return np.array(sorted(r["point"] for r in top), np.uint32)


def backoff(counts: DataFrame, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of the class of others, sorted, and the log of each one's share of the class.

    `counts` has `point` and `n`; one row for each code point comes to the driver, 1.1 million at most.
    """
    rows = counts.where(~F.col("point").isin(known.tolist())).orderBy("point").toArrow()
    n = rows.column("n").to_numpy().astype(float)
    return rows.column("point").to_numpy().astype(np.uint32), np.log(n / n.sum()) if len(n) else n


def classes_of(points: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.full(len(points), OTHER, np.uint8)
    at = np.searchsorted(known, points)
    hit = known[np.minimum(at, len(known) - 1)] == points
    return np.where(hit, at + 1, OTHER).astype(np.uint8)


def _pieces(texts: list[str | None], known: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Window codes of the texts, a piece at a time, and the number of the text of each window.

    A code holds the classes of five neighbouring characters, six bits each, the predicted one in the middle.
    """
    rows, own, size = [], [], 0
    for number, text in enumerate(texts):
        classes = classes_of(points_of(text), known)
        for start in range(0, len(classes), PIECE):
            left, right = max(0, start - SIDE), min(len(classes), start + PIECE + SIDE)
            part = np.full(min(PIECE, len(classes) - start) + 2 * SIDE, EDGE, np.int32)
            part[SIDE - (start - left) : SIDE - (start - left) + right - left] = classes[left:right]
            n = len(part) - 2 * SIDE
            code = np.zeros(n, np.int32)
            for i in range(2 * SIDE + 1):
                code = (code << 6) | part[i : i + n]
            rows.append(code)
            own.append(np.full(n, number, np.int32))
            size += n
            if size >= PIECE:
                yield np.concatenate(rows), np.concatenate(own)
                rows, own, size = [], [], 0
    if rows:
        yield np.concatenate(rows), np.concatenate(own)


def window_counts(docs: DataFrame, known: np.ndarray, text: str = "text") -> DataFrame:
    """`code` and `n`: how often each window occurs in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, size = [], [], 0
        for batch in batches:
            for code, _ in _pieces(batch.column(0).to_pylist(), known):
                found, n = np.unique(code, return_counts=True)
                codes.append(found)
                counts.append(n)
                size += len(found)
                if size >= HELD:
                    codes, counts = _added(codes, counts)
                    size = len(codes[0])
                    if size >= HELD // 2:
                        yield _batch(codes[0], counts[0])
                        codes, counts, size = [], [], 0
        if codes:
            codes, counts = _added(codes, counts)
            yield _batch(codes[0], counts[0])

    return docs.select(text).mapInArrow(run, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def _added(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    every, inverse = np.unique(np.concatenate(codes), return_inverse=True)
    return [every], [np.bincount(inverse, np.concatenate(counts)).astype(np.int64)]


def _batch(codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"code": pa.array(codes, pa.int32()), "n": pa.array(counts, pa.int64())})


@dataclass
class Network:
    """`window`: a table per place of the window; then a hidden bias, the output weights and the output bias."""

    window: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def fresh(seed: int = 17) -> Network:
        random = np.random.default_rng(seed)
        return Network(
            random.normal(0, 0.3, (2 * SIDE, CLASSES, HIDDEN)).astype(np.float32),
            np.zeros(HIDDEN, np.float32),
            random.normal(0, 0.2, (HIDDEN, CLASSES)).astype(np.float32),
            np.zeros(CLASSES, np.float32),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.window, self.bias, self.out, self.out_bias)])

    @staticmethod
    def shaped(flat: np.ndarray) -> Network:
        sizes = [2 * SIDE * CLASSES * HIDDEN, HIDDEN, HIDDEN * CLASSES, CLASSES]
        parts = np.split(np.asarray(flat, np.float32), np.cumsum(sizes)[:-1])
        return Network(parts[0].reshape(2 * SIDE, CLASSES, HIDDEN), parts[1], parts[2].reshape(HIDDEN, CLASSES), parts[3])

    def hidden(self, context: np.ndarray) -> np.ndarray:
        total = self.window[0][context[0]] + self.bias
        for place in range(1, 2 * SIDE):
            total += self.window[place][context[place]]
        return np.tanh(total)

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Of the middle character of each window, given the others."""
        out = np.empty(len(codes), np.float32)
        for i in range(0, len(codes), 8192):
            context, target = split_codes(codes[i : i + 8192])
            logits = self.hidden(context) @ self.out + self.out_bias
            top = logits.max(1, keepdims=True)
            whole = np.log(np.exp(logits - top).sum(1)) + top[:, 0]
            out[i : i + 8192] = logits[np.arange(len(target)), target] - whole
        return out


def split_codes(codes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Classes at the places around the middle, in order, and the class in the middle."""
    places = [(codes >> (6 * (2 * SIDE - i))) & 63 for i in range(2 * SIDE + 1)]
    return places[:SIDE] + places[SIDE + 1 :], places[SIDE]


def fitted_further(network: Network, codes: np.ndarray, counts: np.ndarray, seed: int) -> Network:
    """Passes over the windows in shuffled batches, each window with the weight of its count (Adam steps)."""
    weights = Network.shaped(network.flat())
    parts = [weights.window, weights.bias, weights.out, weights.out_bias]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    random, passes = np.random.default_rng(seed), max(1, -(-LEAST_STEPS * BATCH // len(codes)))
    order = np.concatenate([random.permutation(len(codes)) for _ in range(min(passes, LEAST_STEPS))])
    usual = counts.mean() * BATCH
    for step, start in enumerate(range(0, len(order), BATCH), 1):
        at = order[start : start + BATCH]
        context, target = split_codes(codes[at])
        hidden = weights.hidden(context)
        logits = hidden @ weights.out + weights.out_bias
        share = np.exp(logits - logits.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        share[np.arange(len(at)), target] -= 1
        share *= (counts[at] / usual).astype(np.float32)[:, None]
        back = (share @ weights.out.T) * (1 - hidden * hidden)
        window = np.zeros_like(weights.window)
        for place in range(2 * SIDE):
            one_hot = np.zeros((CLASSES, len(at)), np.float32)
            one_hot[context[place], np.arange(len(at))] = 1
            window[place] = one_hot @ back
        slopes = [window, back.sum(0), hidden.T @ share, share.sum(0)]
        rate = STEP * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        for p, g, m, v in zip(parts, slopes, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * m / (np.sqrt(v) + 1e-6)
    return weights


def train(counts: DataFrame, rounds: int = ROUNDS, shards: int = SHARDS) -> Network:
    """Fit on the table of windows (`code`, `n`); every round is one job over the shards."""
    dealt = stage(counts.repartition(shards, "code").sortWithinPartitions("code"), "window-counts")
    network = Network.fresh()
    for turn in range(rounds):
        start = network.flat()

        def run(batches: Iterator[pa.RecordBatch], start: np.ndarray = start, turn: int = turn) -> Iterator[pa.RecordBatch]:
            held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
            codes = np.concatenate([c for c, _ in held]) if held else np.empty(0, np.int32)
            if len(codes):
                n = np.concatenate([n for _, n in held])
                fitted = fitted_further(Network.shaped(start), codes, n, turn).flat()
                yield pa.RecordBatch.from_pydict({"n": pa.array([int(n.sum())]), "weights": pa.array([fitted.tolist()], pa.list_(pa.float32()))})

        fitted = dealt.mapInArrow(run, "n bigint, weights array<float>").collect()  # one row for each task
        if fitted:
            fitted = sorted(fitted, key=lambda r: (r["n"], r["weights"][:4]))
            network = Network.shaped(np.average(np.array([r["weights"] for r in fitted]), axis=0, weights=[float(r["n"]) for r in fitted]))
    return network


def _charged(text: str | None, rare: np.ndarray, shares: np.ndarray) -> float:
    """The log shares, added up, of a text's characters that are among the `rare`."""
    points, n = np.unique(points_of(text), return_counts=True)
    if not len(rare) or not len(points):
        return 0.0
    at = np.minimum(np.searchsorted(rare, points), len(rare) - 1)
    return float((n * np.where(rare[at] == points, shares[at], 0.0)).sum())


def with_scores(docs: DataFrame, network: Network, known: np.ndarray, rest: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """`doc_id`, `n_chars`, `log_probability` (sum over all characters) and its mean.

    `rest` is the `backoff`; without it characters of the class of others have the probability of the class.
    """
    flat = network.flat()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network.shaped(flat)
        for batch in batches:
            total, size = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for codes, own in _pieces(batch.column(1).to_pylist(), known):
                every, inverse = np.unique(codes, return_inverse=True)  # each distinct window is evaluated once
                total += np.bincount(own, model.log_probabilities(every)[inverse].astype(float), batch.num_rows)
                size += np.bincount(own, minlength=batch.num_rows)
            if rest is not None:
                total += [_charged(text, *rest) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(total), pa.array(total / np.maximum(size, 1))], names=["doc_id", "n_chars", "log_probability", "mean_log_probability"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_chars bigint, log_probability double, mean_log_probability double")


def pseudo_likelihoods(docs: DataFrame) -> DataFrame:
    """Train on all texts of `docs` (`doc_id`, `text`) and score each."""
    counts = stage(character_counts(docs), "character-counts")
    known = _most_frequent(counts)
    return with_scores(docs, train(window_counts(docs, known)), known, backoff(counts, known))
