"""Object store: listing, fetching and writing blobs by key under a root folder or bucket."""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from heapq import heappush, heapreplace
from itertools import chain, islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from hydrolens.functions.text import media_type
from hydrolens.session import is_shared, parallelism, qualified_path, stage

IO_THREADS = 16
PAGE = 10_000  # names a task holds while it lists
RANGE_OBJECTS = 500_000  # names of a folder that one task lists
RANGE_SAMPLE = 20_000


# Names of objects that are still being written.
DRAFT = re.compile(r"^\.[0-9a-f]{32}\.part$")


def qualified_root(spark: SparkSession, root: str) -> str:
    """The root with its scheme, as the cluster resolves it; a machine-local root is an error on a cluster.

    A folder of the file system below the one all executors share, as a mounted one, is no such root.
    """
    full = qualified_path(spark, root)
    if full.startswith("file:") and not spark.sparkContext.master.startswith("local") and not is_shared(spark, full):
        raise ValueError(f"{full} is local to each machine; use a store that all executors reach")
    return full


def list_objects(spark: SparkSession, root: str, prefix: str = "", page: int = PAGE, per_range: int = RANGE_OBJECTS) -> DataFrame:
    """(key, size, last_modified) of all objects under a prefix, empty and hidden ones included.

    Folders are opened level by level, each by the task it falls to; contents are not read. A folder of more than one
    page is only counted there: its names are cut into ranges at sampled names, and each range is listed by a task of its own,
    page by page, so neither one flat folder nor one task holds the listing (see `pages` for what a store gives). Objects
    that are still being written do not count.
    """
    root = qualified_root(spark, root)
    seen = "key string, size bigint, last_modified timestamp, folder boolean, low string, high string"

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = open_root(root)
        for batch in batches:
            for folder in batch["key"]:
                names = _names(store, base, folder)
                held = list(islice(names, page + 1))
                if len(held) <= page:
                    yield _entries(store, base, folder, held)
                else:
                    cuts = _cuts(chain(held, names), per_range)
                    yield _shaped([(folder, None, None, True, low, high) for low, high in zip(["", *cuts], [*cuts, None])])

    def list_range(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = open_root(root)
        for batch in batches:
            for folder, low, high in batch[["key", "low", "high"]].itertuples(index=False, name=None):
                for names in pages(store, base, folder, low, high, page):
                    yield _entries(store, base, folder, names)

    level = spark.createDataFrame([(prefix.rpartition("/")[0],)], "key string")
    found = []
    while level.limit(1).count():
        inside = stage(_spread(level, "key").mapInPandas(look, seen), "listing")
        crowded = inside.where("low IS NOT NULL")
        parts = [inside]
        if crowded.limit(1).count():
            parts = [inside.where("low IS NULL")]
            # One range a task: its names are few, the work behind them is not.
            ranges = crowded.select("key", "low", "high").repartitionByRange(crowded.count(), "key", "low")
            parts.append(stage(ranges.mapInPandas(list_range, seen), "listing"))
        for part in parts:
            found.append(part.where("NOT folder").select("key", "size", "last_modified"))
        level = parts[0].where("folder").select("key")
        for part in parts[1:]:
            level = level.unionByName(part.where("folder").select("key"))
    listing = found[0]
    for more in found[1:]:
        listing = listing.unionByName(more)
    return listing.where(F.startswith("key", F.lit(prefix)))


def _names(store, base: str, folder: str) -> Iterator[str]:
    """The names in a folder, one after the other as the store gives them; none if there is no such folder.

    A local or mounted folder is read as a stream. Stores behind pyarrow give a folder as one list, of names and file
    information only.
    """
    from pyarrow import fs

    at = f"{base}/{folder}".rstrip("/")
    if isinstance(store, fs.LocalFileSystem):
        try:
            with os.scandir(at) as entries:
                for entry in entries:
                    if not DRAFT.match(entry.name):
                        yield entry.name
        except (FileNotFoundError, NotADirectoryError):
            return
    else:
        for info in store.get_file_info(fs.FileSelector(at, allow_not_found=True)):
            if not DRAFT.match(info.base_name):
                yield info.base_name


def _cuts(names: Iterable[str], per_range: int) -> list[str]:
    """Names at which a folder is cut into ranges of about `per_range`, from a sample of bounded size."""
    sample: list[tuple[int, str]] = []  # the names of smallest hash, the largest of these on top
    count = 0
    for name in names:
        count += 1
        rank = -int.from_bytes(hashlib.blake2b(name.encode("utf-8", "surrogateescape"), digest_size=7).digest())
        if len(sample) < RANGE_SAMPLE:
            heappush(sample, (rank, name))
        elif rank > sample[0][0]:
            heapreplace(sample, (rank, name))
    ranges = min(-(-count // per_range), len(sample))
    ordered = sorted(name for _, name in sample)
    return sorted({ordered[i * len(ordered) // ranges] for i in range(1, ranges)})


def pages(store, base: str, folder: str, low: str, high: str | None, page: int = PAGE) -> Iterator[list[str]]:
    """The names of a folder from `low` on and before `high`, at most `page` at a time."""
    names = (name for name in _names(store, base, folder) if low <= name and (high is None or name < high))
    while some := list(islice(names, page)):
        yield some


def _entries(store, base: str, folder: str, names: list[str]) -> pd.DataFrame:
    """What the store knows of these names; those that have gone meanwhile are left out."""
    from pyarrow import fs

    infos = store.get_file_info([f"{base}/{folder}/{name}".replace("//", "/") for name in names]) if names else []
    kinds = fs.FileType
    return _shaped([(f"{folder}/{n}".lstrip("/"), i.size, i.mtime, i.type == kinds.Directory, None, None) for n, i in zip(names, infos) if i.type != kinds.NotFound])


def _shaped(rows: list[tuple]) -> pd.DataFrame:
    found = pd.DataFrame(rows, columns=["key", "size", "last_modified", "folder", "low", "high"])
    return found.astype({"size": "Int64", "folder": bool}).assign(last_modified=pd.to_datetime(found["last_modified"], utc=True))


def open_root(root: str):
    """File system and base path of a root, as pyarrow knows them."""
    from pyarrow import fs

    if root.startswith("file:") or ":" not in root:
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", root)
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", root))


def _spread(keys: DataFrame, key: str, extra: Iterable[str] = ()) -> DataFrame:
    """Distinct keys over a fixed number of tasks.

    Keys are small and the work behind each is not, so the number is not left to sizes.
    """
    distinct = keys.select(F.col(key).alias("key"), *extra).where("key IS NOT NULL").distinct()
    return distinct.repartition(4 * parallelism(keys.sparkSession), "key")


def _in_parallel(work: Callable, items: Iterable) -> Iterator[list]:
    """Apply `work` to a few items at a time: a task mostly waits for the store, and holds only those."""
    with ThreadPoolExecutor(IO_THREADS) as pool:
        rest = iter(items)
        while some := list(islice(rest, IO_THREADS)):
            yield list(pool.map(work, some))


def fetch_objects(keys: DataFrame, root: str, key: str = "key", carry: str | None = None) -> DataFrame:
    """(key, content, error) once per distinct key; a missing object has an error and no content.

    Each task opens just its own keys, so nothing is listed and no bytes pass the driver. A number
    named `carry`, one per key, goes along.
    """
    root = qualified_root(keys.sparkSession, root)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = open_root(root)

        def one(row: tuple) -> tuple:
            try:
                with store.open_input_stream(f"{base}/{row[0]}") as source:
                    return row[0], source.read(), None, *row[1:]
            except OSError as problem:
                return row[0], None, type(problem).__name__, *row[1:]

        rows = (row for batch in batches for row in batch.itertuples(index=False, name=None))
        for some in _in_parallel(one, rows):
            yield pd.DataFrame(some, columns=["key", "content", "error", *extra])

    extra = [carry] if carry else []
    shape = "key string, content binary, error string" + "".join(f", {c} bigint" for c in extra)
    return _spread(keys, key, extra).mapInPandas(read, shape)


def existing_objects(keys: DataFrame, root: str, key: str = "key") -> DataFrame:
    """(key, found) once per distinct key, from file information alone."""
    root = qualified_root(keys.sparkSession, root)

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, base = open_root(root)
        for batch in batches:
            infos = store.get_file_info([f"{base}/{name}" for name in batch["key"]])
            yield pd.DataFrame({"key": batch["key"], "found": [i.type == fs.FileType.File for i in infos]})

    return _spread(keys, key).mapInPandas(look, "key string, found boolean")


def write_objects(blobs: DataFrame, root: str) -> int:
    """Store (key, content) rows as objects; returns how many.

    A key is written whole and then moved into place, so a retried task leaves the same object.
    Rows of one key must have one content: reduce to the last version per key before.
    """
    root = qualified_root(blobs.sparkSession, root)

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = open_root(root)
        made: set[str] = set()

        def one(row: tuple[str, bytes]) -> int:
            _put(store, f"{base}/{row[0]}", row[1], made)
            return 1

        for batch in batches:
            for written in _in_parallel(one, zip(batch["key"], batch["content"])):
                yield pd.DataFrame({"n": [sum(written)]})

    return blobs.select("key", "content").mapInPandas(put, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _put(store, path: str, content: bytes, made: set[str]) -> None:
    folder = path.rpartition("/")[0]
    if folder not in made:
        store.create_dir(folder, recursive=True)
        made.add(folder)
    draft = f"{folder}/.{uuid.uuid4().hex}.part"
    with store.open_output_stream(draft) as out:
        out.write(content)
    store.move(draft, path)


def copy_objects(pairs: DataFrame, root: str, to_root: str | None = None) -> int:
    """Copy the objects of (key, target) rows; returns how many. Bytes stay in the task that copies them."""
    root = qualified_root(pairs.sparkSession, root)
    to_root = root if to_root is None else qualified_root(pairs.sparkSession, to_root)

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (store, base), (other, to_base) = open_root(root), open_root(to_root)
        made: set[str] = set()

        def one(row: tuple[str, str]) -> int:
            with store.open_input_stream(f"{base}/{row[0]}") as source:
                _put(other, f"{to_base}/{row[1]}", source.read(), made)
            return 1

        for batch in batches:
            for done in _in_parallel(one, zip(batch["key"], batch["target"])):
                yield pd.DataFrame({"n": [sum(done)]})

    spread = pairs.select("key", "target").distinct().repartition(4 * parallelism(pairs.sparkSession), "target")
    return spread.mapInPandas(copy, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def artefact_table(blobs: DataFrame, path: str, mode: str = "append") -> None:
    """Store (key, content) rows as a table partitioned by the first part of the key."""
    blobs.select(
        "key", "content", media_type(F.col("key")).alias("content_type"), F.substring_index("key", "/", 1).alias("prefix")
    ).write.mode(mode).partitionBy("prefix").parquet(path)
