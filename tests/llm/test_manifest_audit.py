"""Merkle manifest, filter audit and benchmark decontamination against plain versions, and on awkward tables."""

import collections
import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from hydrolens.llm import audit, decontamination, merkle, queries
from hydrolens.llm.fmindex import FMIndex
from tests.llm.test_operators import AWKWARD, awkward

SMALL = "/root/testdata/sf0.001"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ---- manifest


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(level):
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, i):
    for level in levels[:-1]:
        start = i - i % 16
        yield level[start:i], level[i + 1 : start + 16]
        i //= 16


def manifest(rows):
    """rows of (doc_id, source, leaf, other) -> the query's rows."""
    by = collections.defaultdict(list)
    for row in rows:
        by[row[1]].append(row)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    members = {s: sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, r[2])) for s in names}
    trees = {s: climb([r[2] for r in members[s]]) for s in names}
    top = climb([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (doc_id, _, leaf, other) in enumerate(members[s]):
            path = [*siblings(trees[s], i), *siblings(top, k)]
            folded = other or leaf
            for before, after in path:
                folded = sha(*before, folded, *after)
            proof = sha(*[h for before, after in path for h in (*before, *after)])
            out.append((doc_id, leaf, trees[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


def query_rows(docs):
    for doc_id, text, lang, source, n_chars in docs:
        leaf, other = [sha(*map(field, (doc_id, source, lang, n_chars, t))) for t in (text, text and re.sub("[A-Z]", lambda m: m[0].lower(), text))]
        yield doc_id, source, leaf, other if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 else None


def as_text(rows):
    return sorted(map(repr, map(tuple, rows)))


def save(df, folder, name="documents"):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def test_manifest_of_given_and_awkward_tables(spark, tmp_path):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert as_text(queries.op11_merkle_manifest(spark, SMALL).collect()) == as_text(manifest(query_rows(docs)))
    rows = [*AWKWARD, (0, "Tampered", "en", "", 8), (-5, "x", None, "\U0001f600", 1), (9, "x", None, "￿", 1)]
    save(awkward(spark, rows), tmp_path)
    assert as_text(queries.op11_merkle_manifest(spark, str(tmp_path)).collect()) == as_text(manifest(query_rows(rows)))
    save(awkward(spark, []), tmp_path)
    assert queries.op11_merkle_manifest(spark, str(tmp_path)).count() == 0


def leaves(spark, rows):
    schema = "doc_id bigint, source string, leaf binary, other binary"
    return spark.createDataFrame([(i, s, bytes.fromhex(a), b and bytes.fromhex(b)) for i, s, a, b in rows], schema)


@pytest.mark.parametrize("fanout,depth,sizes", [(16, 3, [4096, 4097, 1]), (16, 1, [1, 2, 15, 16, 17, 255, 256, 257, 300, 1000]), (16, 1, [700] + [1] * 40)])
def test_paths_of_many_partitions(spark, monkeypatch, fanout, depth, sizes):
    """Small partitions, so that several rounds are needed and the last subtrees are cut short."""
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "LEAVES", fanout**depth)
    rows = [(i, f"s{k:03}", sha(f"{k}/{i}"), sha("other") if i % 7 == 0 else None) for k, n in enumerate(sizes) for i in range(n)]
    found = merkle.verified(leaves(spark, rows)).collect() if depth == 3 else in_process(spark, rows)
    assert as_text(found) == as_text(manifest(rows))


def in_process(spark, rows):
    """Partitions are cut in this process, as the workers do not see the changed depth; paths are found by Spark."""
    places = collections.defaultdict(list)
    for row in rows:
        places[row[1]].append(row)
    packed = []
    for number, source in enumerate(sorted(places)):
        held = [
            {"source_no": number, "part": i // merkle.LEAVES, "rows": len(places[source]), "doc_id": r[0], "leaf": bytes.fromhex(r[2]), "other": r[3] and bytes.fromhex(r[3])}
            for i, r in enumerate(places[source])
        ]
        packed += merkle._packed(iter(held))
    schema = merkle.PACKED
    kept = merkle.with_paths(spark.createDataFrame(packed, schema)).collect()
    out = []
    for row, at, level, path in merkle._walk(r.asDict(recursive=True) for r in kept):
        folded = merkle.fold(row["changed"].get(at, level[at]), path).decode()
        proof = merkle.digest(b"".join(part for step in path for part in step)).decode()
        out.append((row["ids"][at], level[at].decode(), row["subroot"], row["root"], proof, folded, folded == row["root"]))
    return out


def test_proofs_fold_to_the_root(spark):
    rows = [(i, "a" if i % 3 else None, sha(str(i)), None) for i in range(300)]
    for row in merkle.proofs(leaves(spark, rows)).collect():
        assert merkle.fold(row.leaf.encode(), [(p.before.encode(), p.after.encode()) for p in row.proof]).decode() == row.root


# ---- filter audit


def plain_audit(docs, labels):
    words, least, parts, out = re.compile(r"[^\x20\x09-\x0D]+"), {}, collections.defaultdict(list), []
    for doc_id, text, *_ in docs:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    good, toxic = ({i for i, *marks in labels if marks[k] == 1} for k in (0, 1))
    for doc_id, text, lang, *_ in docs:
        text = text or ""
        found, fails = words.findall(text), set()
        fails |= {"A"} if len(found) < 200 else set()
        fails |= {"B"} if 100 * len(set(found)) < 50 * len(found) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else set()
        fails |= {"D"} if re.search("[#$%&*|]", text) else set()
        fails |= {"E"} if doc_id is not None and least[text] < doc_id else set()
        parts[lang or ""].append((doc_id, fails))
    for part, rows in parts.items():
        report, total = [], collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, name in enumerate(order, 1):
                gone, left = [r for r in left if name in r[1]], [r for r in left if name not in r[1]]
                total[name] += len(gone)
                failing = sum(name in r[1] for r in rows)
                unique = sum(r[1] == {name} for r in rows)
                report.append((name, (part, "".join(order), step, len(left), len(gone), failing - len(gone), unique, sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone))))
        out += [(*row, total[name]) for name, row in report]
    return out


LABELS = "doc_id bigint, quality int, toxic int"


def test_audit_of_given_and_awkward_tables(spark, tmp_path):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert as_text(queries.op12_filter_audit(spark, SMALL).collect()) == as_text(plain_audit(docs, labels))

    rows = [*AWKWARD, (8, "Token #1 " * 300, "", "a", 9), (9, "Token #1 " * 300, "de", "a", 9), (None, "Token #1 " * 300, "de", "a", 9)]
    marks = [(6, 1, 0), (6, None, 1), (8, 0, 1), (9, 1, None), (None, 1, 1), (999, 1, 1), (7, None, None)]
    save(awkward(spark, rows), tmp_path)
    save(spark.createDataFrame(marks, LABELS), tmp_path, "labels")
    known = [m for m in marks if m[0] is not None]
    assert as_text(queries.op12_filter_audit(spark, str(tmp_path)).collect()) == as_text(plain_audit(rows, known))
    save(awkward(spark, []), tmp_path)
    assert queries.op12_filter_audit(spark, str(tmp_path)).count() == 0


def test_effects_follow_the_joins_for_any_filters(spark):
    """Three filters as random sets of ids: removed and redundant after each set of the others."""
    some = random.Random(3)
    rows = [(i, i, "p", 1 + i % 3, i % 2 == 0, i % 5 == 0, *(some.random() < 0.4 for _ in "XYZ")) for i in range(200)]
    table = spark.createDataFrame(rows, "doc bigint, print bigint, part string, n bigint, quality boolean, toxic boolean, X boolean, Y boolean, Z boolean")
    found = {(r.filter, r.before): (r.removed, r.redundant, r.good, r.toxic) for r in audit.effects(table, ["X", "Y", "Z"]).collect()}
    for at, name in enumerate("XYZ"):
        for size in range(3):
            for before in itertools.combinations([n for n in "XYZ" if n != name], size):
                failing = [r for r in rows if r[6 + at]]
                gone = [r for r in failing if not any(r[6 + "XYZ".index(b)] for b in before)]
                want = (sum(r[3] for r in gone), sum(r[3] for r in failing) - sum(r[3] for r in gone), sum(r[3] for r in gone if r[4]), sum(r[3] for r in gone if r[5]))
                assert found[name, "".join(before)] == want


# ---- decontamination


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.integers(1, 3), min_size=1, max_size=4))
def test_index_counts_and_locates(text, phrase):
    text = np.array([*text, 0], np.int32)
    index = FMIndex.from_columns(**FMIndex.of(text, 4).to_columns())
    low, high = index.intervals(np.array([phrase]))
    want = [i for i in range(len(text)) if text[i : i + len(phrase)].tolist() == phrase]
    assert sorted(index.locate(np.arange(low[0], max(low[0], high[0]))).tolist()) == want


def test_index_of_one_repeated_word_is_quick():
    text = np.append(np.ones(400_000, np.int32), 0)
    begin = time.perf_counter()
    index = FMIndex.of(text.astype(np.int32), 2)
    low, high = index.intervals(np.ones((1, 10), np.int64))
    assert high[0] - low[0] == 400_000 - 9
    assert time.perf_counter() - begin < 20


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_hits(docs, items):
    phrases = collections.defaultdict(set)
    for item_id, text in items:
        words = plain_words(text)
        size = min(10, len(words))
        for i in range(len(words) - size + 1) if words else ():
            phrases[tuple(words[i : i + size])].add(item_id)
    sizes, out = {len(p) for p in phrases}, []
    for doc_id, text, *_ in docs:
        words, hit, met = plain_words(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in phrases:
                    hit.update(range(i, i + size))
                    met |= phrases[tuple(words[i : i + size])]
        met = sorted(str(i) for i in met if i is not None)
        out.append((doc_id, len(words), len(hit), len(met), sha(",".join(met)), bool(hit)))
    return out


ITEMS = "item_id bigint, text string"
PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
BENCHMARK = [
    (1, PASSAGE), (2, PASSAGE.upper()), (2, "Short ünï ITEM"), (10, "one"), (None, "without id here"), (3, None), (4, ""), (5, " .. "),
    (6, "line 7 of a very long text that goes on and on line 8 of a"),
]


def contaminated(rows=AWKWARD):
    return [
        *rows,
        (20, f"x, {PASSAGE.title()}! y\n{PASSAGE} one {PASSAGE}", "en", "a", 1),
        (21, PASSAGE.rsplit(" ", 3)[0] + " other", "en", "a", 1),
        (22, "A short ünï-item, twice: SHORT ünï ITEM", "en", "a", 1),
        (23, "Without\tID HERE", "en", "a", 1),
        (24, PASSAGE * 3, "en", "a", 1),
    ]


def test_hits_of_given_and_awkward_tables(spark, tmp_path):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert as_text(queries.op13_decontamination(spark, SMALL).collect()) == as_text(plain_hits(docs, items))

    rows = contaminated()
    save(awkward(spark, rows), tmp_path)
    save(spark.createDataFrame(BENCHMARK, ITEMS), tmp_path, "benchmark")
    assert as_text(queries.op13_decontamination(spark, str(tmp_path)).collect()) == as_text(plain_hits(rows, BENCHMARK))
    save(spark.createDataFrame([], ITEMS), tmp_path, "benchmark")
    assert not any(r.contaminated for r in queries.op13_decontamination(spark, str(tmp_path)).collect())
    save(awkward(spark, []), tmp_path)
    assert queries.op13_decontamination(spark, str(tmp_path)).count() == 0


def test_parts_shards_and_blocks_change_nothing(spark):
    """Documents cut into overlapping parts of many shards, and phrases in many blocks, give the same spans."""
    rows = contaminated()
    docs = awkward(spark, rows)
    parts = decontamination.phrase_parts(spark.createDataFrame(BENCHMARK, ITEMS))
    whole = decontamination._joined(decontamination.index_documents(docs), parts, decontamination.occurrences(decontamination.index_documents(docs), parts))
    index = decontamination.index_documents(docs, shard_words=40, part_words=7)
    cut = decontamination._joined(index, parts, decontamination.occurrences(index, parts, block_words=5))
    assert index.count() > 1000
    pick = ["doc_id", "n_words", "n_hit", "spans", "items"]
    assert as_text(cut.select(*pick).collect()) == as_text(whole.select(*pick).collect())


def test_passages_are_cut_out(spark):
    rows = contaminated([(1, None, None, None, None), (2, "", "en", "a", 0), (3, "kept as it is", "en", "a", 1)])
    out = {r.doc_id: r.text for r in decontamination.without_passages(awkward(spark, rows), spark.createDataFrame(BENCHMARK, ITEMS)).collect()}
    assert len(out) == len(rows) and out[1] is None and out[2] == "" and out[3] == "kept as it is"
    assert out[20] == "x, ! y\n" and out[21].endswith("other") and out[22] == "A , twice: " and out[23] == ""
    again = decontamination.report(spark.createDataFrame(list(out.items()), "doc_id bigint, text string"), spark.createDataFrame(BENCHMARK, ITEMS))
    assert not any(r.contaminated for r in again.collect())


def test_other_columns_stay(spark):
    docs = awkward(spark, contaminated())
    assert decontamination.without_passages(docs, spark.createDataFrame(BENCHMARK, ITEMS)).columns == docs.columns
    assert docs.select(F.count("*")).first()[0] == len(contaminated())
