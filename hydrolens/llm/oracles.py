"""SQL for a second engine that gives the rows of the manifest, filter audit and decontamination queries."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_FIELD = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _level(k: int) -> str:
    """Nodes of level `k` + 1, the siblings on level `k`, and the documents' paths so far."""
    return f"""
counted{k} AS (SELECT *, count(*) OVER (PARTITION BY tree) > 1 AS goes_on FROM nodes{k}),
nodes{k + 1} AS (
  SELECT tree, idx // 16 AS idx, CASE WHEN any_value(goes_on) THEN sha256(string_agg(h, '' ORDER BY idx)) ELSE any_value(h) END AS h
  FROM counted{k} GROUP BY tree, idx // 16),
beside{k} AS (
  SELECT a.tree, a.idx, any_value(a.goes_on) AS goes_on, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM counted{k} a JOIN counted{k} b ON a.tree = b.tree AND a.idx // 16 = b.idx // 16 GROUP BY a.tree, a.idx),
paths{k + 1} AS (
  SELECT p.* REPLACE (p.idx // 16 AS idx, proof || l || r AS proof, CASE WHEN goes_on THEN sha256(l || folded || r) ELSE folded END AS folded)
  FROM paths{k} p JOIN beside{k} b ON p.tree = b.tree AND p.idx = b.idx),"""


INNER, OUTER = 6, 4  # levels of a source and above the sources: 16^6 rows of a source, 16^4 sources

MERKLE = f"""
WITH tampered AS (
  SELECT *, list_reduce(
      list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda state, byte: list_reduce([xor(state, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1))),
      CAST(4294967295 AS BIGINT)) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS tree, {_leaf("text")} AS leaf,
         CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf("text")} END AS other
  FROM tampered),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves),
nodes0 AS (SELECT tree, idx, leaf AS h FROM placed),
paths0 AS (SELECT doc_id, leaf, tree, idx, '' AS proof, other AS folded FROM placed),
{"".join(_level(k) for k in range(INNER))}
tops AS (SELECT tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS idx FROM nodes{INNER}),
nodes{INNER + 1} AS (SELECT 'root' AS tree, idx, h FROM tops),
paths{INNER + 1} AS (
  SELECT doc_id, leaf, h AS subroot, 'root' AS tree, tops.idx, proof, folded FROM paths{INNER} JOIN tops ON name = paths{INNER}.tree),
{"".join(_level(k) for k in range(INNER + 1, INNER + 1 + OUTER))}
root AS (SELECT h AS root FROM nodes{INNER + 1 + OUTER})
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM paths{INNER + 1 + OUTER}, root
"""

FILTER_AUDIT = r"""
WITH base AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
worded AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM base),
failing AS (
  SELECT part,
         [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t),
          regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > first, false)] AS f,
         coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS good,
         coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1), false) AS toxic
  FROM worded),
alike AS (
  SELECT part, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x, i: f[i]) AS fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM failing GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
  SELECT [a.c, b.c, c.c, d.c, e.c] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
steps AS (SELECT o, CAST(step AS INTEGER) AS step, o[step] AS c, o[1 : step - 1] AS before FROM (SELECT o, unnest(range(1, 6)) AS step FROM orders)),
counted AS (
  SELECT part, array_to_string(o, '') AS filter_order, step, c,
         sum(n) FILTER (NOT list_has_any(fails, before) AND NOT list_contains(fails, c)) AS kept,
         sum(n) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, c)) AS removed,
         sum(n) FILTER (list_has_any(fails, before) AND list_contains(fails, c)) AS redundant,
         sum(n) FILTER (fails = [c]) AS unique_fails,
         sum(good) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, c)) AS good_lost,
         sum(toxic) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, c)) AS toxic_lost
  FROM alike, steps GROUP BY ALL)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, c), 0) AS BIGINT) AS shapley
FROM counted
"""

_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH worded AS (SELECT row_number() OVER () AS nr, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i + 1 : i + size], ' ') AS phrase
  FROM (SELECT item_id, w, least(10, len(w)) AS size, unnest(range(len(w) - least(10, len(w)) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM phrases),
places AS (
  SELECT nr, size, i, array_to_string(w[i + 1 : i + size], ' ') AS phrase
  FROM (SELECT nr, w, size, unnest(range(len(w) - size + 1)) AS i FROM worded, sizes WHERE len(w) >= size)),
found AS (SELECT nr, i, size, item_id FROM places JOIN phrases USING (size, phrase)),
struck AS (SELECT nr, count(DISTINCT word) AS n_hit FROM (SELECT nr, unnest(range(i, i + size)) AS word FROM found) GROUP BY nr),
met AS (
  SELECT nr, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT nr, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY nr)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM worded LEFT JOIN struck USING (nr) LEFT JOIN met USING (nr)
"""
