"""SQL that gives the rows of a registered query on the same tables."""

from panelweave.llm.feistel import FIRST, ROUNDS, SECOND, Permutation
from panelweave.llm.line_dedup import LEAST_WORDS
from panelweave.llm.mixing import SEED

LINES = f"""
WITH split AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
  FROM documents),
worded AS (
  SELECT doc_id, i, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS words FROM split),
lines AS (
  SELECT words, array_to_string(words, ' ') AS body, min((doc_id, i)) AS first FROM worded WHERE len(words) > 0 GROUP BY ALL),
places AS (
  SELECT first, words, body, unnest(range(len(words))) AS place FROM lines WHERE len(words) >= {LEAST_WORDS}),
variants AS (
  SELECT first, place, array_to_string(words[:place] || words[place + 2:], ' ') AS variant FROM places
  UNION ALL SELECT first, -1, body FROM lines WHERE len(words) >= {LEAST_WORDS}),
earliest AS (SELECT variant, place, min(first) AS least FROM variants GROUP BY ALL),
around AS (
  SELECT variant, min(least) FILTER (place < 0) AS whole, min(least) FILTER (place >= 0) AS shorter FROM earliest GROUP BY ALL),
near AS (
  SELECT DISTINCT first FROM variants JOIN earliest USING (variant, place) JOIN around USING (variant)
  WHERE first > least OR (place < 0 AND first > shorter) OR (place >= 0 AND first > whole)),
stays AS (SELECT first FROM lines WHERE first NOT IN (SELECT first FROM near)),
marked AS (
  SELECT s.*, len(w.words) > 0 AND (s.doc_id, s.i) NOT IN (SELECT first FROM stays) AS gone
  FROM split s JOIN worded w ON s.doc_id = w.doc_id AND s.i = w.i)
SELECT d.doc_id, count(m.i) AS n_lines, count(*) FILTER (m.gone) AS n_dropped,
       CASE WHEN d.text IS NOT NULL THEN coalesce(string_agg(m.line, chr(10) ORDER BY m.i) FILTER (NOT m.gone), '') END AS text
FROM documents d LEFT JOIN marked m ON d.doc_id = m.doc_id GROUP BY d.doc_id, d.text
"""

MIX = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS draw
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight, 2 * source_size AS most
  FROM sources),
marked AS (
  SELECT *, weight * (3 * sum(source_size) OVER () - 2 * coalesce(sum(most) OVER
      (ORDER BY most * (10 // weight), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    > 2 * most * sum(weight) OVER
      (ORDER BY most * (10 // weight), source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS is_full
  FROM ranked),
aimed AS (
  SELECT source, source_size, CASE WHEN is_full THEN most::DOUBLE ELSE
      (weight * (3 * sum(source_size) OVER () - 2 * sum(CASE WHEN is_full THEN most ELSE 0 END) OVER ()))::DOUBLE
      / (2 * sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
  FROM marked),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs FROM aimed),
summed AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, b.epochs,
         floor(b.target)::BIGINT - b.epochs * b.source_size AS rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY draw, s.doc_id NULLS LAST, s.size
           ROWS UNBOUNDED PRECEDING) - s.size AS before
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(rest - before, size)))::BIGINT AS taken
FROM summed
"""


def _rounds() -> str:
    """One pass through the network as nested subqueries over rows (doc_id, size, text_crc32, n, h, v, steps)."""
    kept = "doc_id, size, text_crc32, n, h, steps"
    sql = f"SELECT {kept}, v >> h AS a, v & ((1::BIGINT << h) - 1) AS b FROM walk WHERE steps = 0 OR v >= n"
    for i in range(ROUNDS):
        sql = f"SELECT {kept}, a, b, b * {FIRST} + {Permutation(2).key(i)} AS x FROM ({sql})"
        sql = f"SELECT {kept}, a, b, (xor(x, x >> 15) & 2147483647) * {SECOND} AS y FROM ({sql})"
        sql = f"SELECT {kept}, b AS a, xor(a, xor(y, y >> 13) & ((1::BIGINT << h) - 1)) AS b FROM ({sql})"
    return sql


def _remainder(byte: int) -> int:
    """Remainder of a byte for the reflected CRC-32 polynomial."""
    for _ in range(8):
        byte = (byte >> 1) ^ (0xEDB88320 if byte & 1 else 0)
    return byte


SHARDS = f"""
WITH RECURSIVE bytes AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 8 AS size, hex(encode(coalesce(text, ''))) AS digits
  FROM documents),
summed AS (
  SELECT doc_id, size, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(generate_series(0, size - 9),
        lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT)),
      lambda c, byte: xor(c >> 8, {[_remainder(i) for i in range(256)]}[(xor(c, byte) & 255) + 1])), 4294967295) AS text_crc32
  FROM bytes),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS LAST, size, text_crc32) - 1 AS row_no, count(*) OVER () AS n,
         greatest(1, (length(bin(greatest(count(*) OVER () - 1, 1))) + 1) // 2)::INTEGER AS h
  FROM summed),
walk AS (
  SELECT doc_id, size, text_crc32, n, h, row_no AS v, 0 AS steps FROM numbered
  UNION ALL
  SELECT doc_id, size, text_crc32, n, h, (a << h) | b AS v, steps + 1 AS steps FROM ({_rounds()}))
SELECT doc_id, size, text_crc32, 'rows' AS law, (v % 24)::INTEGER AS shard, v // 24 AS slot,
       NULL::INTEGER AS grown_shard
FROM walk WHERE steps > 0 AND v < n
"""

CALLS = """
WITH RECURSIVE messages AS (
  SELECT conv_id, turn, role, text, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
         concat_ws(':', conv_id, turn) AS id, count(*) AS copies
  FROM conversations GROUP BY ALL),
calls AS (
  SELECT *, concat_ws(':', conv_id, turn - 2) AS after_id, CASE role WHEN 'system' THEN 'configure' ELSE 'reply' END AS name
  FROM messages WHERE role IN ('system', 'user')),
levels AS (
  SELECT id, 0::BIGINT AS level FROM calls WHERE after_id NOT IN (SELECT id FROM calls)
  UNION ALL
  SELECT c.id, l.level + 1 FROM calls c JOIN levels l ON c.after_id = l.id),
results AS (SELECT *, concat_ws(':', conv_id, turn - 1) AS call_id FROM messages WHERE role = 'assistant'),
linked AS (
  SELECT c.conv_id, c.id AS call_id, c.name, l.level, c.copies, c.turn AS moment, 0 AS kind, r.text AS content,
         CASE WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
         CASE name WHEN 'configure' THEN '{"instruction":' || to_json(c.text) || ',"words":' || c.words || '}'
           ELSE '{"prompt":' || to_json(c.text) || ',"turn":' || c.turn || ',"words":' || c.words || '}' END AS arguments,
         concat_ws('; ',
           CASE WHEN name = 'configure' THEN CASE WHEN length(c.text) < 20 THEN 'instruction: below 20'
             WHEN length(c.text) > 300 THEN 'instruction: above 300' END
           ELSE CASE WHEN length(c.text) < 30 THEN 'prompt: below 30' WHEN length(c.text) > 400 THEN 'prompt: above 400' END END,
           CASE WHEN name = 'reply' AND c.turn > 6 THEN 'turn: above 6' END,
           CASE WHEN c.words < 5 THEN 'words: below 5' WHEN name = 'reply' AND c.words > 60 THEN 'words: above 60' END
         ) AS problems
  FROM calls c JOIN levels l USING (id) LEFT JOIN results r ON r.call_id = c.id
  UNION ALL
  SELECT conv_id, call_id, NULL, NULL, copies, turn, 2, text, 'orphan result', 'null', ''
  FROM results WHERE call_id NOT IN (SELECT id FROM calls)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY kind, level NULLS LAST, moment, call_id, content) - 1 AS position
  FROM linked)
SELECT conv_id, call_id, name, position, level, status, copies, problems,
       '{"arguments":' || arguments || ',"call_id":' || to_json(call_id) || ',"name":' || coalesce(to_json(name)::VARCHAR, 'null')
       || ',"position":' || position || ',"result":' || coalesce(to_json(content)::VARCHAR, 'null')
       || ',"status":' || to_json(status) || '}' AS json
FROM placed
"""

NEGATIVES = """
WITH whole AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.vector, b.vector)::BIGINT AS score
  FROM whole a JOIN whole b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

URLS = """
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(rule, host_, path_, verdict_) AS (VALUES
  ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'), ('example.org/en/1', 'example.org', '/en/1', 'block'),
  ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
listed AS (
  SELECT DISTINCT site FROM (
    SELECT regexp_extract(host, '(^|\\.)(([^.]*-)?(adult|ads|bets|casino|pills|spam)(-[^.]*)?\\..+)$', 2) AS site FROM parts)
  WHERE site <> ''),
best AS (
  SELECT host, path, max_by(rule, length(rule)) AS rule, max_by(verdict_, length(rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) JOIN rules ON (host = host_ OR ends_with(host, '.' || host_)) AND starts_with(path, path_)
  GROUP BY ALL),
hosts AS (
  SELECT host, max_by(site, length(site)) AS listed
  FROM (SELECT DISTINCT host FROM parts) JOIN listed ON host = site OR ends_with(host, '.' || site) GROUP BY ALL)
SELECT page_id, p.host, p.path, rule, coalesce(verdict, CASE WHEN listed IS NULL THEN 'allow' ELSE 'block' END) AS verdict, listed
FROM parts p LEFT JOIN best b ON p.host = b.host AND p.path = b.path LEFT JOIN hosts h ON p.host = h.host
"""

SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)),
counted AS (
  SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS digits FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(generate_series(0, len(digits) // 2 - 1),
        lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT)),
      lambda c, byte: xor(c >> 8, {[_remainder(i) for i in range(256)]}[(xor(c, byte) & 255) + 1])), 4294967295) AS h
  FROM counted),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
less AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.rest = w.word
  UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.rest = w.word),
best AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
known AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form,
         CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
walk AS (
  SELECT word, word AS root, form FROM known
  UNION ALL
  SELECT walk.word, k.word, k.form FROM walk JOIN known k ON walk.form = k.word)
SELECT k.word, k.form, walk.root, k.n, k.n_near, k.form_n
FROM known k JOIN walk ON k.word = walk.word WHERE walk.form IS NULL
"""
