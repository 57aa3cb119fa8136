"""DuckDB SQL for the training-data queries that SQL can express, each a plain formulation over whole tables."""

from __future__ import annotations

_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

#: All n-gram sets compared by their shared n-grams; near-duplicate classes by following links. Texts without words are alike
#: only if they are equal.
JACCARD = f"""
WITH RECURSIVE texts AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
grams AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN text END AS bare, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS g
  FROM texts
),
sets AS (SELECT g, bare, md5(coalesce('text ' || bare, 'set ' || array_to_string(g, '|'))) AS k, min(doc_id) AS copy_id, count(*) AS copies
         FROM grams GROUP BY g, bare),
held AS (SELECT k, len(g) AS n, unnest(g) AS gram FROM sets),
near AS (
  SELECT a.k AS ka, b.k AS kb FROM held a JOIN held b ON a.gram = b.gram AND a.k <> b.k
  GROUP BY a.k, b.k, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9
),
walk AS (
  SELECT s.k AS root, s.k AS k FROM sets s
  UNION
  SELECT w.root, n.kb FROM walk w JOIN near n ON n.ka = w.k
),
classes AS (SELECT w.root AS k, min(s.copy_id) AS class_id FROM walk w JOIN sets s ON s.k = w.k GROUP BY w.root),
linked AS (SELECT n.ka AS k, count(*) AS sets, sum(s.copies) AS documents FROM near n JOIN sets s ON s.k = n.kb GROUP BY n.ka)
SELECT g.doc_id, c.class_id, s.copy_id, CAST(s.copies - 1 + coalesce(l.documents, 0) AS BIGINT) AS n_links,
       CAST(coalesce(l.sets, 0) AS BIGINT) AS n_similar_classes
FROM grams g JOIN sets s ON s.g = g.g AND s.bare IS NOT DISTINCT FROM g.bare JOIN classes c ON c.k = s.k LEFT JOIN linked l ON l.k = s.k"""

#: Base 32 of a SHA-1: every five hexadecimal digits are four letters.
_BASE32 = " || ".join(
    f"'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((CAST('0x' || h[{5 * i + 1}:{5 * i + 5}] AS INTEGER) >> {shift}) & 31)]"
    for i in range(8) for shift in (15, 10, 5, 0))
WARC = f"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_page,
         sha1(coalesce(html, '')) AS h FROM pages
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_page OR first_page IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_page THEN first_page END AS refers_to
FROM payloads"""

#: Every window of every document looked up among the items' windows.
CONTAMINATION = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n,
         unnest(list_transform(range(1, greatest(len(w) - 11, 2)), lambda i: array_to_string(w[i:i + 12], ' '))) AS text
  FROM items WHERE len(w) > 0
),
places AS (
  SELECT d.r, s.n, unnest(range(1, len(d.w) - s.n + 2)) AS i, d.w FROM docs d, (SELECT DISTINCT n FROM windows) s
  WHERE len(d.w) >= s.n
),
found AS (SELECT p.r, p.i, p.n, x.item_id FROM places p JOIN windows x ON x.n = p.n AND x.text = array_to_string(p.w[p.i:p.i + p.n - 1], ' ')),
hits AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS at FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
          FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(m.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(m.names, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN hits h ON h.r = d.r LEFT JOIN named m ON m.r = d.r"""

#: The Merkle trees by recursion, level by level; a proof part is the side of the sibling and its digest.
MERKLE = """
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, lang, n_chars, text, source,
         doc_id IS NOT NULL AND n_chars IS NOT NULL AND xor(list_reduce(
           [CAST(4294967295 AS UBIGINT)] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS UBIGINT)),
           lambda c, b: list_reduce([xor(c, b)] || [CAST(0 AS UBIGINT) FOR z IN range(8)],
                                    lambda x, z: xor(x >> 1, CAST(3988292384 AS UBIGINT) * (x & CAST(1 AS UBIGINT))))),
           CAST(4294967295 AS UBIGINT)) % 7 = 0 AS touched
  FROM documents
),
leaves AS (
  SELECT r, doc_id, lang, touched, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) AS changed
  FROM (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-') AS head, coalesce(strlen(text) || ':' || text, '-') AS tail FROM docs)
),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
lower_nodes AS (
  SELECT lang, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM lower_nodes WHERE n > 1
  GROUP BY lang, level, pos // 2, n
),
subroots AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM lower_nodes WHERE n = 1),
upper_nodes AS (
  SELECT 0 AS level, pos, h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM upper_nodes WHERE n > 1
  GROUP BY level, pos // 2, n
),
parts AS (
  SELECT p.r, 0 AS tree, s.level, CASE WHEN (p.pos >> s.level) & 1 = 1 THEN 'L' ELSE 'R' END AS side, b.h
  FROM placed p JOIN (SELECT DISTINCT lang, level FROM lower_nodes WHERE n > 1) s ON s.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN lower_nodes b ON b.lang IS NOT DISTINCT FROM p.lang AND b.level = s.level AND b.pos = xor(p.pos >> s.level, 1)
  UNION ALL
  SELECT p.r, 1, s.level, CASE WHEN (t.pos >> s.level) & 1 = 1 THEN 'L' ELSE 'R' END, b.h
  FROM placed p JOIN subroots t ON t.lang IS NOT DISTINCT FROM p.lang, (SELECT DISTINCT level FROM upper_nodes WHERE n > 1) s
  LEFT JOIN upper_nodes b ON b.level = s.level AND b.pos = xor(t.pos >> s.level, 1)
),
proofs AS (
  SELECT r, sha256(coalesce(string_agg(h, '' ORDER BY tree, level), '')) AS proof_sha256,
         list(side || coalesce(h, '') ORDER BY tree, level) AS steps
  FROM parts GROUP BY r
),
done AS (
  SELECT p.doc_id, p.leaf, t.h AS subroot, (SELECT h FROM upper_nodes WHERE n = 1) AS root,
         coalesce(f.proof_sha256, sha256('')) AS proof_sha256,
         list_reduce([CASE WHEN p.touched THEN p.changed ELSE p.leaf END] || coalesce(f.steps, []), lambda h, s:
           sha256(CASE WHEN s[1] = 'L' THEN s[2:] || h ELSE h || s[2:] END)) AS folded_root
  FROM placed p JOIN subroots t ON t.lang IS NOT DISTINCT FROM p.lang LEFT JOIN proofs f ON f.r = p.r
)
SELECT *, folded_root = root AS verified FROM done"""

#: Every group's count of every kept term of its language, zeros included, and f of every two groups term by term.
DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
),
found AS (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS term FROM docs) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS lang_n FROM found GROUP BY lang, term HAVING count(*) >= 3),
langs AS (SELECT lang, sum(lang_n) AS size, count(*) AS v FROM kept GROUP BY lang),
grouped AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, sum(n) AS n FROM found GROUP BY lang, source, term),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.lang_n FROM grouped g JOIN kept k ON k.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
sizes AS (SELECT lang, source, sum(n) AS size FROM dense GROUP BY lang, source),
shares AS (
  SELECT d.lang, d.source, d.term, d.n, 1 + (CAST(1000000000 AS HUGEINT) * (d.n + 1)) // (s.size + l.v) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (d.lang_n + 1)) // (l.size + l.v) AS q
  FROM dense d JOIN sizes s ON s.lang = d.lang AND s.source = d.source JOIN langs l ON l.lang = d.lang
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL
),
every_pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(p.value, 0) AS value FROM grouped a JOIN grouped b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM every_pair
  UNION ALL
  SELECT * FROM (SELECT lang, source, 'term' AS part, item, value,
                        row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms) WHERE rank <= 200
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked"""

ORACLE = {"op3_ngram_jaccard_join": JACCARD, "op5_warc_record_table": WARC, "op6_wu_manber_decontamination": CONTAMINATION,
          "op11_merkle_manifest": MERKLE, "op12_source_divergence": DIVERGENCE}
