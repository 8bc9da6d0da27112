"""DuckDB SQL for the queries that SQL can express."""

OP2 = """
WITH rules(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
fits AS (
  SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST, r.verdict DESC) AS place
  FROM split p LEFT JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""

OP5 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked AS (
  SELECT *, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn) AS before,
         length(regexp_replace(text, '([\\<\[])', '_\1', 'g')) AS escaped,
         length(regexp_replace(role, '([\\<\[])', '_\1', 'g')) AS escaped_role FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(escaped + CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 17 WHEN 'assistant' THEN 16 ELSE escaped_role + 25 END) AS BIGINT)
         AS formatted_chars,
       bool_and(CASE role WHEN 'system' THEN before = '' WHEN 'user' THEN before IN ('', 'system', 'assistant')
                WHEN 'assistant' THEN before = 'user' ELSE false END) AS valid
FROM marked GROUP BY conv_id
"""

OP10 = """
WITH listed AS (SELECT 'src' || i AS source, 1.0::DOUBLE AS weight FROM range(20) t(i)),
counts AS (SELECT source, count(*) AS n FROM documents WHERE source IN (SELECT source FROM listed) GROUP BY source),
rates AS (
  SELECT source, (SELECT sum(n) FROM counts) * weight / (SELECT sum(weight) FROM listed JOIN counts USING (source)) / n AS rate
  FROM counts JOIN listed USING (source)),
steps AS (
  SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf
  FROM rates, range(200) t(k)),
inverse AS (SELECT source, list(cdf ORDER BY k) AS cdfs FROM steps GROUP BY source),
drawn AS (
  SELECT d.*, ('0x' || substr(md5('17|' || doc_id), 1, 13))::BIGINT / 4503599627370496.0 AS draw, coalesce(cdfs, [exp(-1)]) AS cdfs
  FROM documents d LEFT JOIN inverse USING (source)),
numbered AS (SELECT * EXCLUDE (draw, cdfs), len(list_filter(cdfs, lambda x: x <= draw)) AS n FROM drawn)
SELECT * EXCLUDE (n, c), CAST(c AS INTEGER) AS copy, md5('17|' || doc_id || '|' || c) AS shuffle_key
FROM (SELECT *, unnest(range(n)) AS c FROM numbered)
"""

OP11 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
cut AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, w[s:s + n - 1] AS win FROM cut),
placed AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM words, (SELECT DISTINCT n FROM windows)),
hits AS (SELECT doc_id, s, n, item_id FROM (SELECT doc_id, n, s, w[s:s + n - 1] AS win FROM placed) JOIN windows USING (n, win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP12 = """
WITH held AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT)) AS numbers
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.numbers, b.numbers), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM held a JOIN held b ON a.vec_id <> b.vec_id AND a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives JOIN scored s USING (anchor_id)
WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10
"""


def op13(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Each round's books from the last ones'; a book is a list of entries (lists of whole numbers) in order."""
    assign = """
near{k} AS (
  SELECT p.vec_id, p.part, arg_min(e.entry, [e.apart, e.entry]) AS entry, min(e.apart) AS apart FROM (
    SELECT vec_id, c.part, c.cut, b.entry,
           CAST(list_sum(list_transform(list_zip(c.cut, b.numbers), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS apart
    FROM cuts c JOIN books{k} b USING (part)) e JOIN cuts p USING (vec_id, part) GROUP BY p.vec_id, p.part)"""
    improve = """
sums{k} AS (
  SELECT part, entry, pos, CAST(floor_div(sum(x), count(*)) AS BIGINT) AS x
  FROM (SELECT n.part, n.entry, unnest(range(1, len(c.cut) + 1)) AS pos, unnest(c.cut) AS x FROM near{k} n JOIN cuts c USING (vec_id, part))
  GROUP BY part, entry, pos),
books{next} AS (
  SELECT b.part, b.entry, coalesce(s.numbers, b.numbers) AS numbers
  FROM books{k} b LEFT JOIN (SELECT part, entry, list(x ORDER BY pos) AS numbers FROM sums{k} GROUP BY part, entry) s USING (part, entry))"""
    improve = improve.replace("floor_div(sum(x), count(*))", "(sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*)")
    steps = ",".join((assign + "," + improve).format(k=k, next=k + 1) for k in range(rounds)) + "," + assign.format(k=rounds)
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT)) AS numbers
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
cuts AS (
  SELECT vec_id, part, numbers[part * len(numbers) // {parts} + 1:(part + 1) * len(numbers) // {parts}] AS cut
  FROM kept, range({parts}) r(part)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {entries}),
books0 AS (SELECT part, entry, cut AS numbers FROM cuts JOIN first USING (vec_id)),{steps},
errors AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(apart) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(numbers, ','), ',' ORDER BY part, entry)) FROM books{rounds}) AS codebooks_sha256
FROM errors JOIN kept USING (vec_id)
"""


ORACLE_SQL: dict[str, str] = {
    "op2_url_verdicts": OP2, "op5_chat_format": OP5, "op10_source_mix": OP10,
    "op11_decontamination": OP11, "op12_hard_negatives": OP12, "op13_vector_codes": op13(),
}
