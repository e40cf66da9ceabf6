"""Byte-pair encoding and decoding with a published vocabulary.

Merging keeps, for one short word, a contiguous array of part boundaries and beside it the merge rank of each adjacent
pair. The array is scanned for the smallest rank, the boundary inside that pair is deleted, and only the two
neighbouring ranks are looked up again. Words beyond `SHORT` parts keep the same ranks in a heap over a linked list,
since scanning would be quadratic there; both ways give the same ids.

Edge cases: a null text counts as empty and has no ids; a text of any length is encoded whole; repeated rows are
encoded alike; an empty table gives an empty table. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame, functions as F

from hydrolens.llm.common import map_rows

# Fixed value: how the vocabulary's publisher cuts text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SHORT = 96
BITS = 32
MASK = (1 << BITS) - 1
NONE = 1 << 62


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file, letter to byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Token bytes by id, merge ranks by pair of ids, and special strings, from one tokenizer file."""

    def __init__(self, path: str, remembered: int = 200_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, ids = byte_letters(), spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes = {
            i: token.encode() if token in self.special else bytes(letters[c] for c in token) for token, i in ids.items()
        } | {i: text.encode() for text, i in self.special.items()}
        self.single = [0] * 256
        for letter, byte in letters.items():
            self.single[byte] = ids[letter]
        self.ranks: dict[tuple[int, int], int] = {}  # the rank, and in the low bits the id that the pair becomes
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[ids[left], ids[right]] = rank << BITS | ids[left + right]
        self.words = regex.compile(WORDS)
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.memory = _Memory(self, remembered)

    def merge(self, word: bytes) -> list[int]:
        parts = [self.single[b] for b in word]
        return self.merge_short(parts) if len(parts) <= SHORT else self.merge_long(parts)

    def merge_short(self, parts: list[int]) -> list[int]:
        """Contiguous arrays: `parts[i]` begins at boundary i, `ranks[i]` is the rank of parts i and i + 1."""
        look = self.ranks.get
        ranks = [look(pair, NONE) for pair in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            i = ranks.index(least)
            parts[i] = joined = least & MASK
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = look((parts[i - 1], joined), NONE)
            if i < len(ranks):
                ranks[i] = look((joined, parts[i + 1]), NONE)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges in the same order, the smallest rank from a heap and parts in a linked list."""
        size, look = len(parts), self.ranks.get
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(found, i, parts[i], parts[i + 1]) for i in range(size - 1) if (found := look((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            found, i, left, right = heapq.heappop(heap)
            j, joined = after[i], found & MASK
            if parts[i] != left or j >= size or parts[j] != right:
                continue
            parts[i], parts[j], after[i] = joined, -1, after[j]
            if after[i] < size:
                before[after[i]] = i
                if (found := look((joined, parts[after[i]]))) is not None:
                    heapq.heappush(heap, (found, i, joined, parts[after[i]]))
            if before[i] >= 0 and (found := look((parts[before[i]], joined))) is not None:
                heapq.heappush(heap, (found, before[i], parts[before[i]], joined))
        return [p for p in parts if p >= 0]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, one after another."""
        out, memory = [], self.memory
        for i, piece in enumerate(self.cut.split(text) if self.cut else [text]):
            if i % 2:
                out.append(self.special[piece].to_bytes(4, "little"))
            else:
                out += map(memory.__getitem__, self.words.findall(piece))
        memory.trim()
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        numbers = array("I", ids)
        return b"".join(map(self.token_bytes.__getitem__, numbers)).decode("utf-8", errors="replace")


class _Memory(dict):
    """Encoded words that were met before, at most `size` of them between two texts: the older half goes when they are more."""

    def __init__(self, owner: Vocabulary, size: int):
        self.owner, self.size = owner, size

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.owner.merge(word.encode())).tobytes()
        if len(word) <= 40 and len(self) < 2 * self.size:
            self[word] = ids
        return ids

    def trim(self) -> None:
        if len(self) > self.size:
            for word in list(islice(self, len(self) - self.size // 2)):
                del self[word]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def public_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, text: str = "text", path: str | None = None, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`columns` of each row with `ids` (array of int), the whole text encoded."""
    return _mapped(docs, text, path, columns, "ids array<int>", lambda vocab, ids: {"ids": np.frombuffer(ids, "<i4")})


def decode_documents(tokens: DataFrame, path: str | None = None, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`columns` of each row with the `text` that its `ids` spell; null ids spell nothing."""
    path, kept = path or public_path(), tokens.select(*columns, "ids")

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        vocab = vocabulary(path)
        for row in rows:
            yield {c: row[c] for c in columns} | {"text": vocab.decode(array("I", row["ids"] or []).tobytes())}

    return map_rows(kept, run, f"{_ddl(tokens, columns)}, text string")


def token_digests(
    docs: DataFrame, text: str = "text", path: str | None = None, columns: tuple[str, ...] = ("doc_id",), with_ids: bool = False
) -> DataFrame:
    """`columns` of each row with its number of tokens and digests of its ids and of the text decoded from them, if asked also the ids."""

    def digest(vocab: Vocabulary, ids: bytes) -> dict:
        return {
            "n_tokens": len(ids) // 4,
            "ids_sha256": hashlib.sha256(ids).hexdigest(),
            "decoded_sha256": hashlib.sha256(vocab.decode(ids).encode()).hexdigest(),
        } | ({"ids": np.frombuffer(ids, "<i4")} if with_ids else {})

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return _mapped(docs, text, path, columns, schema, digest)


def _mapped(docs: DataFrame, text: str, path: str | None, columns: tuple[str, ...], schema: str, make) -> DataFrame:
    path = path or public_path()

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        vocab = vocabulary(path)
        for row in rows:
            yield {c: row[c] for c in columns} | make(vocab, vocab.encode(row["__text"] or ""))

    kept = docs.select(*columns, F.col(f"`{text}`").alias("__text"))
    return map_rows(kept, run, f"{_ddl(docs, columns)}, {schema}")


def _ddl(df: DataFrame, columns: tuple[str, ...]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)
