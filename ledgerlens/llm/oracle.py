"""DuckDB statements of the queries that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _crc32(text: str) -> str:
    """The checksum of ASCII characters, bit by bit."""
    bits = "CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    return (f"xor(list_reduce(list_prepend(4294967295, [CAST(ascii(a) AS BIGINT) FOR a IN string_split({text}, '')]), "
            f"lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: {bits})), 4294967295)")


def _told(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_told, ["doc_id", "source", "lang", "n_chars", text])) + ")"


MANIFEST = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf("text")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0
              THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other
  FROM documents
), p AS (
  SELECT *, row_number() OVER (ORDER BY g, doc_id NULLS FIRST, leaf) AS id,
         row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM d
), node AS (
  SELECT g, 0 AS lvl, i, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM p
  UNION ALL
  SELECT g, lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8
  FROM node WHERE n > 1 GROUP BY g, lvl, n, i // 8
), sub AS (
  SELECT g, lvl AS height, h, row_number() OVER (ORDER BY g) - 1 AS i FROM node WHERE n = 1
), top AS (
  SELECT 0 AS lvl, i, h, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8
  FROM top WHERE n > 1 GROUP BY lvl, n, i // 8
), run AS (
  SELECT g, lvl, i // 8 AS run, string_agg(h, '' ORDER BY i) AS hs FROM node WHERE n > 1 GROUP BY g, lvl, i // 8
), top_run AS (
  SELECT lvl, i // 8 AS run, string_agg(h, '' ORDER BY i) AS hs FROM top WHERE n > 1 GROUP BY lvl, i // 8
), up AS (
  SELECT id, g, 0 AS lvl, i, coalesce(other, leaf) AS h, '' AS proof FROM p
  UNION ALL
  SELECT id, g, lvl + 1, i // 8, sha256(left(hs, 64 * (i % 8)) || h || substr(hs, 64 * (i % 8) + 65)),
         proof || left(hs, 64 * (i % 8)) || substr(hs, 64 * (i % 8) + 65)
  FROM (SELECT up.*, run.hs FROM up JOIN run ON up.g = run.g AND up.lvl = run.lvl AND up.i // 8 = run.run)
), over AS (
  SELECT id, 0 AS lvl, sub.i, up.h, proof FROM up JOIN sub ON up.g = sub.g AND up.lvl = sub.height
  UNION ALL
  SELECT id, lvl + 1, i // 8, sha256(left(hs, 64 * (i % 8)) || h || substr(hs, 64 * (i % 8) + 65)),
         proof || left(hs, 64 * (i % 8)) || substr(hs, 64 * (i % 8) + 65)
  FROM (SELECT over.*, top_run.hs FROM over JOIN top_run ON over.lvl = top_run.lvl AND over.i // 8 = top_run.run)
)
SELECT doc_id, leaf, sub.h AS subroot, top.h AS root, sha256(proof) AS proof_sha256, over.h AS folded_root,
       over.h = top.h AS verified
FROM p JOIN sub ON p.g = sub.g JOIN top ON top.n = 1 JOIN over ON over.id = p.id AND over.lvl = top.lvl
"""

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _and(state: str, cost: str, edits: str) -> str:
    """A state's nine digits of cost and its edits, with more of both; null where there is no way."""
    return f"lpad(CAST(CAST(left({state}, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0') || substr({state}, 10) || '{edits}'"


_INSERTED = (
    f"n, s, least(u, {_and('n', '5', 'I')}, {_and('s', '5', 'I')}, {_and('a', '5', 'I')}) AS u, "
    f"least(a, {_and('u', '5', 'I')}, {_and('n', '10', 'II')}, {_and('s', '10', 'II')}) AS a"
)


def _turn(states: str, role: str) -> str:
    """The cheapest way from some states to a turn of ``role``, by keeping a row or giving it the role."""
    kept, given = (", ".join(_and(x, c, e) for x in states) for c, e in (("more", "K"), ("1 + more", "R")))
    return f"CASE WHEN NOT gone THEN CASE WHEN initial = '{role}' THEN least({kept}) ELSE least({given}) END END"


REPAIR = f"""
WITH RECURSIVE k AS (
  SELECT coalesce('=' || conv_id, '') AS g, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS k
  FROM conversations
), r AS (
  SELECT g, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE k WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM k WHERE k <> 0
), o AS (
  SELECT *, left(role, 1) AS initial, rtrim(text, {_SPACES}) AS t,
         row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         row_number() OVER (PARTITION BY g, role, text ORDER BY turn NULLS FIRST, copy) AS time
  FROM r
), f AS (
  SELECT *, t = '' AS blank, t <> '' AND time > 1 AS dup, t <> '' AND time = 1 AND right(t, 1) NOT IN ('.', '!', '?') AS cut,
         lag(initial) OVER (PARTITION BY g ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS bad
  FROM o
), counts AS (
  SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated, count(*) FILTER (bad) AS illegal, count(*) AS m
  FROM f GROUP BY g
), dp AS (
  SELECT DISTINCT g, CAST(0 AS BIGINT) AS i, '000000000' AS n, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u,
         CAST(NULL AS VARCHAR) AS a
  FROM k
  UNION ALL
  SELECT g, i, {_and('n', '2', 'D')}, least({_and('s', '2', 'D')}, CASE WHEN NOT gone AND initial = 's' THEN {_and('n', 'more', 'K')} END),
         least({_and('u', '2', 'D')}, {_turn('nsa', 'u')}), least({_and('a', '2', 'D')}, {_turn('u', 'a')})
  FROM (
    SELECT g, i, gone, initial, more, {_INSERTED}
    FROM (
      SELECT dp.g, f.i, n, s, u, a, blank OR dup AS gone, initial, CASE WHEN cut THEN 5 ELSE 0 END AS more
      FROM dp JOIN f ON dp.g = f.g AND f.i = dp.i + 1))
), best AS (
  SELECT g, least(n, a) AS b
  FROM (SELECT g, {_INSERTED} FROM (SELECT dp.* FROM dp LEFT JOIN counts ON dp.g = counts.g WHERE dp.i = coalesce(m, 0)))
), letters AS (
  SELECT g, j, substr(b, j + 9, 1) AS e, sum(CASE WHEN substr(b, j + 9, 1) = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY g ORDER BY j) AS i,
         sum(CASE WHEN substr(b, j + 9, 1) = 'D' THEN 0 ELSE 1 END) OVER (PARTITION BY g ORDER BY j) AS z
  FROM (SELECT g, b, unnest(range(1, len(b) - 8)) AS j FROM best)
), said AS (
  SELECT l.g, j, z, e, f.role, f.text,
         max(CASE WHEN z = 1 AND e = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.g) AS system
  FROM letters AS l LEFT JOIN f ON l.g = f.g AND l.i = f.i WHERE e <> 'D'
), done AS (
  SELECT g, string_agg(CASE WHEN e = 'K' THEN role WHEN (z - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
                       || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS told
  FROM said GROUP BY g
)
SELECT i.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(left(b, 9) AS BIGINT) AS cost, substr(b, 10) AS audit,
       sha256(coalesce(told, '')) AS repaired_sha256
FROM (SELECT DISTINCT g, conv_id FROM k) AS i JOIN best ON i.g = best.g LEFT JOIN counts ON i.g = counts.g
     LEFT JOIN done ON i.g = done.g
"""

DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS p
  FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM (SELECT item_id, w, least(10, len(w)) AS m FROM b WHERE len(w) > 0))
), dw AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS p
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM d JOIN (SELECT DISTINCT m FROM win) ON len(w) >= m)
), hits AS (
  SELECT DISTINCT doc_id, m, i, item_id FROM dw JOIN win USING (m, p)
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit
  FROM (SELECT doc_id, i, unnest(range(m)) AS k FROM (SELECT DISTINCT doc_id, m, i FROM hits)) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id LEFT JOIN found ON d.doc_id = found.doc_id
"""

ARCHIVE = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), bits AS (
  SELECT h, array_to_string([['0000', '0001', '0010', '0011', '0100', '0101', '0110',
    '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][instr('0123456789abcdef', substr(h, k, 1))] FOR k IN range(1, 41)], '') AS s
  FROM (SELECT DISTINCT h FROM p)
), coded AS (
  SELECT h, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
    16 * CAST(substr(s, 5 * k + 1, 1) AS INTEGER) + 8 * CAST(substr(s, 5 * k + 2, 1) AS INTEGER)
    + 4 * CAST(substr(s, 5 * k + 3, 1) AS INTEGER) + 2 * CAST(substr(s, 5 * k + 4, 1) AS INTEGER)
    + CAST(substr(s, 5 * k + 5, 1) AS INTEGER), 1) FOR k IN range(32)], '') AS payload_digest
  FROM bits
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM f JOIN coded USING (h)
"""

REPEATS = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), s AS (
  SELECT doc_id, i, hash(substr(h, 2 * i + 1, 100)) AS a, hash(substr(h, 2 * i + 1, 100) || '!') AS b
  FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - 49)) AS i FROM d WHERE len(h) >= 100)
), gone AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY a, b) AS first_id FROM s) WHERE first_id < doc_id
), runs AS (
  SELECT doc_id, min(i) AS s, max(i) + 50 AS e
  FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g
        FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new
              FROM gone))
  GROUP BY doc_id, g
), gaps AS (
  SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS a, s AS b FROM runs
  UNION ALL SELECT doc_id, max(e), 1000000000 FROM runs GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS k FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
), total AS (
  SELECT doc_id, count(*) AS n_spans, sum(e - s) AS n_removed FROM runs GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN total ON d.doc_id = total.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM common JOIN n AS na ON a = na.doc_id JOIN n AS nb ON b = nb.doc_id
  WHERE 100 * c >= 75 * (na.n + nb.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), component AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN component ON d.doc_id = component.doc_id
"""
