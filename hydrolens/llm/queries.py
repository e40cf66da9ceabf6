"""The registered query of each operator, over whole tables, and the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from hydrolens.llm import audit, bpe, decontamination, edits, embeddings, licenses, lines, merkle, minhash, mixing, quality, scoring, secrets
from hydrolens.llm.common import table
from hydrolens.llm.oracles import DECONTAMINATION, FILTER_AUDIT, LOWER, MERKLE, UPPER
from hydrolens.session import stage

THRESHOLD = 0.3


def op1_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.pseudo_likelihoods(table(spark, folder, "documents").select("doc_id", "text"))


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_digests(table(spark, folder, "documents"))


def op3_pfair_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    sized = docs.select(
        "doc_id", "source", F.coalesce(F.length("text"), F.lit(0)).alias("chars"), mixing.place_key(F.col("doc_id"), F.col("text")).alias("place")
    )
    return mixing.mix(sized, F.col("chars"), F.col("place")).drop("place")


def op4_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_matches(table(spark, folder, "documents"))


def op5_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = lines.without_repeats(docs)
    return rows.select("doc_id", "lines", "removed_lines", "emptied", F.sha2("text", 256).alias("text_sha256"))


def op6_cover_tree(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.with_links(table(spark, folder, "embeddings"))


def op7_circulant_minhash(spark: SparkSession, folder: str) -> DataFrame:
    near = minhash.near_groups(table(spark, folder, "documents"))
    return near.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    vectors = stage(quality.with_statistics(docs).drop("text"), "statistics")
    model = quality.train(vectors, table(spark, folder, "labels"))
    scored = quality.with_score(vectors, model)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op9_edit_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edits.with_components(table(spark, folder, "documents").select("doc_id", "text"))


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.span_report(table(spark, folder, "documents"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    lowered = F.translate("text", UPPER, LOWER)
    leaves = docs.select("source", "doc_id", merkle.leaf().alias("leaf"), F.when(tampered, merkle.leaf(text=lowered)).alias("other"))
    return merkle.verified(leaves)


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op13_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    runs = (
        op1_pseudo_likelihood, op2_bpe, op3_pfair_mixing, op4_licenses, op5_line_runs, op6_cover_tree, op7_circulant_minhash, op8_quality,
        op9_edit_fingerprints, op10_secrets, op11_merkle_manifest, op12_filter_audit, op13_decontamination,
    )
    return {run.__name__: run for run in runs}


def oracle() -> dict[str, str]:
    return {
        "op3_pfair_mixing": MIXING, "op5_line_runs": LINE_RUNS, "op6_cover_tree": LINKS, "op7_circulant_minhash": NEAR,
        "op11_merkle_manifest": MERKLE, "op12_filter_audit": FILTER_AUDIT, "op13_decontamination": DECONTAMINATION,
    }


MIXING = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(length(text), 0) AS chars, coalesce('=' || source, 'null') AS name,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS place
  FROM documents),
totals AS (SELECT name, sum(chars) AS chars, CAST(greatest(1, floor(sqrt(sum(chars)))) AS BIGINT) AS w FROM sized GROUP BY name),
size AS (SELECT greatest({mixing.LEAST_CYCLE}, 8 * count(*)) AS cycle, count(*) AS k, sum(w) AS w FROM totals),
parts AS (
  SELECT name, totals.chars, 1 + CAST((totals.w * (cycle - k)) // size.w AS BIGINT) AS part, (totals.w * (cycle - k)) % size.w AS rest
  FROM totals, size),
shares AS (
  SELECT name, chars, CAST(part + CASE WHEN row_number() OVER (ORDER BY rest DESC, name) <= cycle - sum(part) OVER () THEN 1 ELSE 0 END AS BIGINT) AS share,
         row_number() OVER (ORDER BY name) AS i
  FROM parts, size),
listed AS (SELECT list(share ORDER BY i) AS q, CAST(max(cycle) AS BIGINT) AS cycle, count(*) AS k FROM shares, size),
edf AS (
  SELECT CAST(0 AS BIGINT) AS t, list_transform(q, lambda x: CAST(0 AS BIGINT)) AS n, CAST(0 AS BIGINT) AS ran, CAST(0 AS BIGINT) AS turn FROM listed
  UNION ALL
  SELECT t + 1, list_transform(n, lambda x, i: x + CASE WHEN i = best THEN 1 ELSE 0 END), best, n[best]
  FROM (SELECT t, n, list_min(list_transform(list_filter(list_transform(n, lambda x, i: [((x + 1) * cycle + q[i] - 1) // q[i], i, (x * cycle) // q[i]]), lambda y: y[3] <= t), lambda y: y[1] * 1000000 + y[2])) % 1000000 AS best
        FROM edf, listed WHERE t < cycle)),
once AS (SELECT ran AS i, turn, t - 1 AS slot FROM edf WHERE t > 0),
placed AS (
  SELECT doc_id, source, chars, name, coalesce(sum(chars) OVER (PARTITION BY name ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS mix_offset
  FROM sized),
blocks AS (SELECT *, CAST(mix_offset // {mixing.BLOCK_CHARS} AS BIGINT) AS mix_block FROM placed),
missing AS (
  SELECT min(((chars + {mixing.BLOCK_CHARS - 1}) // {mixing.BLOCK_CHARS}) // share * cycle + slot) AS slot
  FROM shares JOIN once USING (i), size WHERE turn = ((chars + {mixing.BLOCK_CHARS - 1}) // {mixing.BLOCK_CHARS}) % share)
SELECT doc_id, source, CAST(blocks.chars AS INTEGER) AS chars, mix_block, CAST((mix_block // share) * cycle + once.slot AS BIGINT) AS mix_slot,
       CAST(mix_offset AS BIGINT) AS mix_offset, (mix_block // share) * cycle + once.slot < missing.slot AS on_target
FROM blocks JOIN shares USING (name) JOIN once ON once.i = shares.i AND turn = mix_block % share, size, missing
"""

LINE_RUNS = rf"""
WITH cut AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
numbered AS (
  SELECT doc_id, line, l[line + 1] AS content, len(regexp_extract_all(l[line + 1], '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT doc_id, l, unnest(range(len(l))) AS line FROM cut)),
seq AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS pos,
         sum(words) OVER (PARTITION BY doc_id ORDER BY line) AS till, md5(content) AS id
  FROM numbered WHERE words > 0),
often AS (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM seq),
near AS (
  SELECT a.doc_id, a.pos AS start, b.pos AS stop, b.till - a.till + a.words AS words, a.words AS first_words, b.words AS last_words
  FROM often a JOIN often b ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos AND a.pos + {lines.MIN_WORDS - 1}
  WHERE a.n > 1 AND b.n > 1),
runs AS (
  SELECT DISTINCT doc_id, start, stop FROM near
  WHERE words >= {lines.MIN_WORDS} AND (words - last_words < {lines.MIN_WORDS} OR words - first_words < {lines.MIN_WORDS})),
spelt AS (
  SELECT r.doc_id, start, stop, string_agg(id, ',' ORDER BY pos) AS content
  FROM runs r JOIN seq s ON s.doc_id = r.doc_id AND s.pos BETWEEN start AND stop GROUP BY ALL),
later AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, start) AS nth FROM spelt) WHERE nth > 1),
gone AS (
  SELECT DISTINCT s.doc_id, s.line FROM later r JOIN seq s ON s.doc_id = r.doc_id AND s.pos BETWEEN r.start AND r.stop),
kept AS (
  SELECT n.doc_id, string_agg(content, chr(10) ORDER BY n.line) AS rest, sum(words) AS words, count(*) AS kept_lines
  FROM numbered n LEFT JOIN gone g ON g.doc_id = n.doc_id AND g.line = n.line WHERE g.line IS NULL GROUP BY n.doc_id)
SELECT c.doc_id, CAST(coalesce(len(l), 0) AS INTEGER) AS lines, CAST(coalesce(len(l), 0) - coalesce(kept_lines, 0) AS INTEGER) AS removed_lines,
       coalesce(len(l), 0) > coalesce(kept_lines, 0) AND coalesce(words, 0) = 0 AS emptied,
       CASE WHEN text IS NULL THEN NULL WHEN coalesce(words, 0) = 0 AND len(l) > coalesce(kept_lines, 0) THEN sha256('') ELSE sha256(rest) END AS text_sha256
FROM cut c LEFT JOIN kept k USING (doc_id)
"""

LINKS = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
valid AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND list_bool_and(list_transform(e, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(e, lambda x: x <> 0))),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {embeddings.LEAST}),
reach(node, seen) AS (SELECT vec_id, vec_id FROM v UNION SELECT node, b FROM reach JOIN links ON seen = a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT node AS vec_id, coalesce(any_value(n), 0) AS n_links, min(seen) AS component_id, node = min(seen) AS kept
FROM reach LEFT JOIN counted ON vec_id = node GROUP BY node
"""

NEAR = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i + 1 : i + 5], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(greatest(least(len(w), 1), len(w) - 4))) AS i FROM worded)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= {minhash.PERCENT} * (p.n + q.n - c)),
reach(node, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT node, b FROM reach JOIN links ON seen = a)
SELECT node AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(seen) AS component_id, node = min(seen) AS kept
FROM reach LEFT JOIN sizes ON sizes.doc_id = node GROUP BY node
"""
