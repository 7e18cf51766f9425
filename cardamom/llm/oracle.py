"""DuckDB SQL for the numbered operators that SQL can express."""

from __future__ import annotations

_ORACLES: dict[str, str] = {}


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)


_ORACLES["op1_substring_dedup"] = r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
    SELECT doc_id, spot, array_to_string(ws[spot:spot + 49], ' ') AS run
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS spot FROM texts)
), firsts AS (
    SELECT run, min(doc_id) AS first_id FROM windows GROUP BY run HAVING min(doc_id) < max(doc_id)
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(spot, spot + 50)) AS pos
    FROM windows JOIN firsts USING (run) WHERE doc_id > first_id
), words AS (
    SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM texts
), kept AS (
    SELECT w.doc_id, count(g.pos) AS n_removed,
           coalesce(string_agg(w.word, ' ' ORDER BY w.pos) FILTER (g.pos IS NULL), '') AS text
    FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.pos = g.pos
    GROUP BY w.doc_id
)
SELECT t.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""

_ORACLES["op7_decontaminate"] = r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, size, array_to_string(ws[spot:spot + size - 1], ' ') AS run
    FROM (SELECT item_id, ws, least(len(ws), 13) AS size, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS spot FROM items WHERE len(ws) > 0)
), doc_windows AS (
    SELECT doc_id, size, spot, array_to_string(ws[spot:spot + size - 1], ' ') AS run
    FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS spot
          FROM texts, (SELECT DISTINCT size FROM item_windows))
), hits AS (
    SELECT d.doc_id, d.spot, d.size, i.item_id FROM doc_windows d JOIN item_windows i ON d.size = i.size AND d.run = i.run
), marked AS (
    SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(spot, spot + size)) AS pos FROM hits) GROUP BY doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM texts t LEFT JOIN marked m ON t.doc_id = m.doc_id LEFT JOIN listed l ON t.doc_id = l.doc_id
"""

_ORACLES["op5_warc_revisits"] = """
WITH pages_in AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), records AS (
    SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM pages_in
), firsts AS (
    SELECT payload_digest, min(page_id) AS first_page FROM records WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, r.payload_digest,
       CASE WHEN f.first_page < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_page < page_id THEN f.first_page END AS refers_to
FROM records r LEFT JOIN firsts f ON r.payload_digest = f.payload_digest
"""

_ORACLES["op4_mtree_top_k"] = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

_ORACLES["op11_fill_in_middle"] = """
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
           sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), draws AS (
    SELECT doc_id, t, n, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS c2,
           CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
                WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM texts
), cut AS (
    SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b FROM draws
), parts AS (
    SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

_ORACLES["op13_filter_audit"] = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), firsts AS (
    SELECT t, min(doc_id) AS first_id FROM texts GROUP BY t
), marks AS (
    SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), judged AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
           [len(ws) < 200,
            100 * len(list_distinct(ws)) < 50 * len(ws),
            100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
            regexp_matches(t, '[#$%&*|]'),
            coalesce(d.doc_id > first_id, false)] AS fails
    FROM texts d JOIN firsts USING (t) LEFT JOIN marks m ON d.doc_id = m.doc_id
), patterns AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
    FROM judged GROUP BY part, fails
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
    SELECT filter_order, step, instr('ABCDE', filter_order[step]) AS own,
           [instr('ABCDE', y) FOR y IN string_split(filter_order[1:step - 1], '') IF y <> ''] AS earlier
    FROM orders, (SELECT unnest(range(1, 6)) AS step)
), counted AS (
    SELECT part, filter_order, step, own,
           sum(n) FILTER (NOT fails[own] AND NOT gone) AS kept,
           sum(n) FILTER (fails[own] AND NOT gone) AS removed,
           sum(n) FILTER (fails[own] AND gone) AS redundant,
           sum(n) FILTER (fails[own] AND len(list_filter(fails, lambda f: f)) = 1) AS unique_fails,
           sum(n_good) FILTER (fails[own] AND NOT gone) AS good_lost,
           sum(n_toxic) FILTER (fails[own] AND NOT gone) AS toxic_lost
    FROM (SELECT *, len(list_filter(earlier, lambda k: fails[k])) > 0 AS gone FROM patterns, steps)
    GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""
