"""DuckDB SQL of the operators' queries where SQL expresses them on whole tables."""

ORACLE: dict[str, str] = {}

ORACLE["op5_site_lines"] = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
l AS (
  SELECT r, doc_id, source, i, lines[i] AS raw, trim(lines[i], ' ' || chr(9) || chr(13)) AS line
  FROM d, unnest(generate_series(1, len(lines))) AS t(i)),
pages AS (SELECT source, count(*) AS pages FROM d GROUP BY source),
boiler AS (
  SELECT l.source, l.line FROM l JOIN pages p ON p.source IS NOT DISTINCT FROM l.source
  WHERE l.line <> '' GROUP BY l.source, l.line, p.pages
  HAVING count(DISTINCT l.r) >= 5 AND count(DISTINCT l.r) > 0.02 * p.pages),
marked AS (
  SELECT l.*, b.line IS NOT NULL AS gone
  FROM l LEFT JOIN boiler b ON b.source IS NOT DISTINCT FROM l.source AND b.line = l.line)
SELECT any_value(doc_id) AS doc_id, count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""

ORACLE["op6_substring_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT r, s, md5(array_to_string(w[s:s + 34], ' ')) AS h
  FROM d, unnest(generate_series(1, len(w) - 34)) AS t(s)),
again AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
hit AS (SELECT r, s FROM win SEMI JOIN again USING (h)),
gone AS (SELECT DISTINCT r, p FROM hit, unnest(generate_series(s, s + 34)) AS t(p)),
word AS (SELECT r, p, w[p] AS x FROM d, unnest(generate_series(1, len(w))) AS t(p)),
rest AS (
  SELECT word.r, count(*) AS n, string_agg(x, ' ' ORDER BY word.p) AS kept
  FROM word ANTI JOIN gone ON gone.r = word.r AND gone.p = word.p GROUP BY word.r)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(rest.n, 0) AS n_removed,
       sha256(coalesce(rest.kept, '')) AS kept_sha256
FROM d LEFT JOIN rest USING (r)
"""


ORACLE["op11_pivots"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND b.vec_id <> a.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
WHERE rank <= 20
"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    bits = "list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda ch: CAST(ord(ch) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, b: {bits}), 4294967295)"


ORACLE["op13_prefix_trie"] = f"""
WITH own AS (
  SELECT conv_id AS c, {{'r': coalesce(role, ''), 'x': coalesce(text, '')}} AS t,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
lists AS (SELECT c, list(t ORDER BY pos) AS ts FROM own GROUP BY c),
plan AS (
  SELECT c, ts, c - c % 5 AS head, {_crc32("CAST(c AS VARCHAR)")} % 9 AS h FROM lists),
built AS (
  SELECT plan.c, list_concat(coalesce(g.ts[1:h], []), plan.ts[h + 1:]) AS ts
  FROM plan LEFT JOIN lists g ON g.c = plan.head),
prefixes AS (
  SELECT c, d, ts[1:d] AS key, d = len(ts) AS is_end
  FROM (SELECT c, ts, unnest(range(len(ts) + 1)) AS d FROM built)),
nodes AS (
  SELECT d, key, min(c) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (is_end), '') AS ends,
         CASE WHEN d = 0 THEN 0 ELSE octet_length(encode(key[d].x)) END AS bytes
  FROM prefixes GROUP BY d, key),
above AS (
  SELECT n.*, p.conv_id AS parent FROM nodes n LEFT JOIN nodes p ON p.d = n.d - 1 AND p.key = n.key[1:n.d - 1]),
children AS (SELECT d - 1 AS d, key[1:d - 1] AS key, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
facts AS (
  SELECT a.*, coalesce(ch.n, 0) AS n_children FROM above a LEFT JOIN children ch ON ch.d = a.d AND ch.key = a.key),
below AS (
  SELECT u AS d, key[1:u] AS key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves,
         sum((n_convs - 1) * bytes) AS saved
  FROM (SELECT *, unnest(range(d + 1)) AS u FROM facts) GROUP BY 1, 2)
SELECT f.conv_id, f.d AS depth, f.parent AS parent_conv_id, f.n_convs, f.n_children,
       CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM facts f JOIN below b ON b.d = f.d AND b.key = f.key
"""
