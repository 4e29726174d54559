"""SQL for DuckDB that gives the rows of the queries that SQL can express."""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6 = f"""WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item_id, {WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest([array_to_string(w[k:k + least(len(w), 10) - 1], ' ')
    FOR k IN range(1, greatest(len(w) - 10, 0) + 2)]) AS key FROM i WHERE len(w) > 0),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS k, w FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n),
dk AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS key FROM dw),
hits AS (SELECT doc_id, k, n, item_id FROM dk JOIN iw USING (n, key)),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
    sha256(array_to_string(list_sort(list_distinct(list(item_id))), ',')) AS digest FROM hits GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(digest, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)"""

ORACLE_SQL = {"op6_decontamination": OP6}
