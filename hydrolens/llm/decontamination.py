"""Words of documents that repeat ten consecutive words of a benchmark item.

Documents are gathered into shards of about `SHARD_WORDS` words in the tasks that read them, and each shard becomes an
FM-index (`fmindex`), written once as one row. Test phrases are then looked up in every shard by backward search, all
phrases of a block at a time; occurrences are located by sampled suffix positions, and their words are merged into
removal spans. Documents are never exchanged: only spans, the numbers of phrases met, and a row per document are.

Words are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. A test phrase is ten consecutive
words of an item; an item of fewer words is one phrase. Items are cut into parts of `PART_WORDS` words that overlap by
nine, equal parts stand as one, and the distinct parts go to blocks of about `BLOCK_WORDS` words by their hash. The blocks
go to the tasks one after another, so neither the driver nor a task holds more of a benchmark than that, however large
it is. A document of more than `PART_WORDS` words is indexed in overlapping parts in the same way; no task holds more
than one document and one shard.

Edge cases: null and empty texts have no words; rows that share an id, or are equal, each keep their row; an item without
id counts for words but is not listed, and items that share an id count as one; an item without words has no phrase; empty
tables give no rows, or rows without hits. Other columns of the documents, whatever their names, are passed over by
`hits` and kept by `without_passages`.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from hydrolens.llm.common import map_rows
from hydrolens.llm.fmindex import FMIndex
from hydrolens.operators.lookup import lookup_join
from hydrolens.session import delete_path, stage, stage_path, staging

WINDOW = 10
SHARD_WORDS = 1 << 20
PART_WORDS = 1 << 19
BLOCK_WORDS = 1 << 20
SHARDS_PER_FILE = 16

# Bytes of words stay, A-Z in lower case; all others end a word. Every byte of a character beyond ASCII is 0x80 or more.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_PIECE = "struct<row: bigint, doc_id: bigint, one: bigint, two: bigint, words: bigint, start: int, skipped: bigint>"
_SHARD = f"vocabulary binary, symbols int, size int, bits binary, less binary, marks binary, places binary, pieces array<{_PIECE}>"
_SPANS = "array<struct<start: bigint, stop: bigint>>"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD_BYTES).split()


def parts_of(words: list[bytes], size: int) -> Iterator[tuple[int, list[bytes]]]:
    """Overlapping parts and the words before each; any ten consecutive words lie within one part."""
    for start in range(0, max(1, len(words) - WINDOW + 1), size):
        yield start, words[start : start + size + WINDOW - 1]


class Shard:
    """Documents on their way into an index."""

    def __init__(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict(count(1).__next__)
        self.pieces: list[dict] = []
        self.text: list[np.ndarray] = []
        self.size = 0

    def add(self, part: list[bytes], **piece) -> None:
        symbols = np.fromiter(map(self.numbers.__getitem__, part), np.int32, len(part))
        self.pieces.append({**piece, "start": self.size})
        self.text += [symbols, np.zeros(1, np.int32)]
        self.size += len(part) + 1

    def row(self) -> dict:
        symbols = len(self.numbers) + 1
        index = FMIndex.of(np.concatenate(self.text), symbols)
        return {"vocabulary": b" ".join(self.numbers), "symbols": symbols, "size": self.size, **index.to_columns(), "pieces": self.pieces}


def index_documents(docs: DataFrame, shard_words: int = SHARD_WORDS, part_words: int = PART_WORDS, path: str | None = None) -> DataFrame:
    """One row for each shard of `docs` (`doc_id`, `text`), written to `path` or the shared folder.

    `pieces` names the shard's documents: a row number unlike any other, the id, a 128-bit hash of the text, the number
    of its words, where the piece starts in the shard, and the document's words before it.
    """
    kind = _parse_datatype_string(_SHARD)
    arrow = to_arrow_schema(kind, prefers_large_types=False)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row, doc_id, one, two, text in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    words = words_of(text)
                    for skipped, part in parts_of(words, part_words):
                        shard.add(part, row=row, doc_id=doc_id, one=one, two=two, words=len(words), skipped=skipped)
                        if shard.size >= shard_words:
                            yield pa.RecordBatch.from_pylist([shard.row()], schema=arrow)
                            shard = Shard()
        if shard.pieces:
            yield pa.RecordBatch.from_pylist([shard.row()], schema=arrow)

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), *_content(), F.col("text").cast("binary").alias("text")
    )
    path = path or stage_path(docs.sparkSession, "fm-index")
    rows.mapInArrow(build, kind).write.option("maxRecordsPerFile", SHARDS_PER_FILE).parquet(path)
    return docs.sparkSession.read.schema(kind).parquet(path)


def _content() -> list:
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("one"), F.xxhash64(text, F.lit(1)).alias("two")]


def phrase_parts(benchmark: DataFrame) -> DataFrame:
    """`item_id` (string, may be null), `part` (digest) and `words` of each part of each item that has words."""

    def cut(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            words = words_of(row["text"])
            for _, part in parts_of(words, PART_WORDS) if words else ():
                yield {"item_id": row["item_id"], "words": b" ".join(part), "n": len(part)}

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text"))
    parts = map_rows(items, cut, "item_id string, words binary, n bigint")
    return parts.select("item_id", F.sha2("words", 256).alias("part"), "words", "n")


class Phrases:
    """The distinct phrases of a block: their words as numbers, and the parts that hold each."""

    def __init__(self, parts: list[tuple[str, bytes]]):
        numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.parts = [digest for digest, _ in parts]
        seen: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for i, (_, words) in enumerate(parts):
            symbols = np.fromiter(map(numbers.__getitem__, words.split()), np.int32)
            width = min(WINDOW, len(symbols))
            windows = np.unique(np.lib.stride_tricks.sliding_window_view(symbols, width), axis=0)
            seen.setdefault(width, []).append((windows, np.full(len(windows), i)))
        self.words = list(numbers)
        self.by_width = []
        for width, found in seen.items():
            windows, which = np.unique(np.concatenate([w for w, _ in found]), axis=0, return_inverse=True)
            owners = np.concatenate([o for _, o in found])
            by = np.argsort(which, kind="stable")
            starts = np.searchsorted(which[by], np.arange(len(windows) + 1))
            self.by_width.append((windows, owners[by], starts))

    def search(self, shard: dict) -> Iterator[dict]:
        """For each piece with occurrences: its row, spans of words (in the document), and the parts met."""
        index = FMIndex.from_columns(*(shard[c] for c in ("bits", "less", "marks", "places")))
        numbers = {word: i for i, word in enumerate(shard["vocabulary"].split(), 1)}
        symbols = np.array([numbers.get(word, 0) for word in self.words], np.int64)
        starts = np.array([p["start"] for p in shard["pieces"]])
        edges = np.zeros(shard["size"] + 1, np.int32)
        met: list[np.ndarray] = []
        for windows, owners, bounds in self.by_width:
            phrases = symbols[windows]
            known = np.flatnonzero(phrases.all(axis=1))
            low, high = index.intervals(phrases[known])
            there = np.flatnonzero(low < high)
            low, sizes, known = low[there], (high - low)[there], known[there]
            for chunk in _chunks(sizes):
                n = sizes[chunk]
                rows = np.repeat(low[chunk] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                at = index.locate(rows)
                np.add.at(edges, at, 1)
                np.add.at(edges, at + phrases.shape[1], -1)
                piece = np.searchsorted(starts, at, side="right") - 1
                piece, phrase = np.unique(np.stack([piece, np.repeat(known[chunk], n)]), axis=1)
                owned = bounds[phrase + 1] - bounds[phrase]
                ends = np.cumsum(owned)
                owner = owners[np.repeat(bounds[phrase] - (ends - owned), owned) + np.arange(owned.sum())]
                met.append(np.unique(np.stack([np.repeat(piece, owned), owner]), axis=1))
        if not met:
            return
        inside = np.diff((np.cumsum(edges) > 0).astype(np.int8), prepend=0)
        opens, closes = np.flatnonzero(inside == 1), np.flatnonzero(inside == -1)
        piece, owner = np.unique(np.concatenate(met, axis=1), axis=1)
        of_span = np.searchsorted(starts, opens, side="right") - 1
        for i in np.unique(piece):
            p = shard["pieces"][i]
            shift, mine = p["skipped"] - p["start"], slice(*np.searchsorted(of_span, [i, i + 1]))
            spans = [{"start": int(a) + shift, "stop": int(b) + shift} for a, b in zip(opens[mine], closes[mine])]
            yield {"row": p["row"], "one": p["one"], "two": p["two"], "spans": spans, "parts": [self.parts[k] for k in owner[slice(*np.searchsorted(piece, [i, i + 1]))]]}


def _chunks(sizes: np.ndarray, most: int = 1 << 20) -> Iterator[np.ndarray]:
    """Runs of intervals with about `most` occurrences in all."""
    if len(sizes):
        yield from np.split(np.arange(len(sizes)), np.flatnonzero(np.diff((np.cumsum(sizes) - 1) // most)) + 1)


def occurrences(index: DataFrame, parts: DataFrame, block_words: int = BLOCK_WORDS, path: str | None = None) -> DataFrame:
    """`row`, `one`, `two`, `spans` and `parts` of each piece of the index that holds a phrase, for each block of phrases."""
    spark = index.sparkSession
    distinct = parts.dropDuplicates(["part"])
    blocks = -(-(distinct.agg(F.sum("n")).first()[0] or 0) // block_words)
    schema = f"row bigint, one bigint, two bigint, spans {_SPANS}, parts array<string>"
    if not blocks:
        return spark.createDataFrame([], schema)
    path = path or stage_path(spark, "occurrences")
    shards = index.select("vocabulary", "size", "bits", "less", "marks", "places", "pieces")
    arrow = to_arrow_schema(_parse_datatype_string(schema), prefers_large_types=False)
    for block in range(blocks):
        mine = distinct.where(F.pmod(F.xxhash64("part"), F.lit(blocks)) == block)
        phrases = Phrases([(r.part, bytes(r.words)) for r in mine.select("part", "words").collect()])

        def search(batches: Iterator[pa.RecordBatch], phrases: Phrases = phrases) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    found = list(phrases.search(batch.slice(at, 1).to_pylist()[0]))
                    yield pa.RecordBatch.from_pylist(found, schema=arrow)

        shards.mapInArrow(search, _parse_datatype_string(schema)).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def merged(spans: list[dict]) -> list[dict]:
    """Spans in order, those that touch or overlap as one."""
    out: list[dict] = []
    for span in sorted(spans, key=lambda s: s["start"]):
        if out and span["start"] <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], span["stop"])
        else:
            out.append(dict(span))
    return out


def _merged_rows(found: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key, its spans merged over pieces and blocks."""

    def merge(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            spans = merged(row["spans"])
            yield {**row, "spans": spans, "n_hit": sum(s["stop"] - s["start"] for s in spans)}

    gathered = found.groupBy(*keys).agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return map_rows(gathered, merge, f"{', '.join(k + ' bigint' for k in keys)}, spans {_SPANS}, n_hit bigint")


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """For each row of `docs` (`doc_id`, `text`): `doc_id`, `n_words`, `n_hit`, the removal `spans` in words (end exclusive)
    and `items`, the ids of the items met (null if none is), sorted as strings."""
    spark = docs.sparkSession
    index_path, found_path = stage_path(spark, "fm-index"), stage_path(spark, "occurrences")
    with staging(spark) as keep:
        index, parts = index_documents(docs, path=index_path), keep(phrase_parts(benchmark), "item-parts")
        result = stage(_joined(index, parts, occurrences(index, parts, path=found_path)), "decontamination")
    for path in (index_path, found_path):
        delete_path(spark, path)
    return result


def _joined(index: DataFrame, parts: DataFrame, found: DataFrame) -> DataFrame:
    spans = _merged_rows(found, ["row"])
    met = found.select("row", F.explode("parts").alias("part")).join(parts.where("item_id IS NOT NULL").select("part", "item_id").distinct(), "part")
    items = met.groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    rows = index.select(F.explode("pieces").alias("p")).where("p.skipped = 0").select("p.row", "p.doc_id", F.col("p.words").alias("n_words"))
    joined = rows.join(spans.join(items, "row", "left"), "row", "left")
    return joined.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"), "spans", "items")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`hits` with the items as a count and a digest, and `contaminated`."""
    listed = F.coalesce(F.array_join("items", ","), F.lit(""))
    return hits(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def cut(text: bytes, spans: list[dict]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text.translate(_WORD_BYTES))]
    out, done = [], 0
    for span in spans:
        out.append(text[done : places[span["start"]][0]])
        done = places[span["stop"] - 1][1]
    return b"".join([*out, text[done:]])


def without_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` with all its columns, benchmark passages cut out of `text`."""
    found = occurrences(index_documents(docs), stage(phrase_parts(benchmark), "item-parts"))
    spans = _merged_rows(found, ["one", "two"]).select(F.struct("one", "two").alias("__content"), F.col("spans").alias("__spans"))
    one, two = _content()
    marked = lookup_join(docs.withColumn("__content", F.struct(one, two)), spans, "__content")

    @F.udf("string", useArrow=True)
    def rest(text: str | None, spans: list | None) -> str | None:
        return text if spans is None else cut(text.encode(), spans).decode()

    return marked.withColumn("text", rest("text", "__spans")).select(*docs.columns)
