"""DuckDB SQL for the queries of this subpackage that SQL can express."""

WORDS = r"list_filter(string_split(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '')"

# All windows of all pairs of a document and an item that share enough places for any window to reach 0.8.
LEAKS = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, w, len(w) AS n_words, least(len(w), 5) AS k FROM (SELECT item_id, {WORDS} AS w FROM benchmark WHERE text IS NOT NULL) WHERE len(w) > 0),
ds AS (SELECT doc_id, n, k, pos, array_to_string(w[pos + 1 : pos + k], ' ') AS s
       FROM (SELECT doc_id, w, len(w) AS n, k, UNNEST(range(0, len(w) - k + 1)) AS pos FROM d, (SELECT DISTINCT k FROM i) WHERE len(w) >= k)),
ips AS (SELECT item_id, n_words, k, item_pos, array_to_string(w[item_pos + 1 : item_pos + k], ' ') AS s
        FROM (SELECT item_id, w, n_words, k, UNNEST(range(0, n_words - k + 1)) AS item_pos FROM i)),
met AS (SELECT doc_id, item_id, n, n_words, k, pos, s, list(DISTINCT greatest(0, least(pos - item_pos, n - n_words))) AS aligned FROM ds JOIN ips USING (k, s) GROUP BY ALL),
pair AS (SELECT doc_id, item_id, n, n_words, greatest(least(n, n_words) - k + 1, 1) AS size, n_words - k + 1 AS m, list_distinct(flatten(list(aligned))) AS aligned
         FROM met GROUP BY doc_id, item_id, n, n_words, k HAVING COUNT(*) >= 0.8 / 1.8 * (size + m) - 1e-6),
win AS (SELECT *, UNNEST(range(0, greatest(n - n_words, 0) + 1)) AS start FROM pair),
wc AS (SELECT w.doc_id, w.item_id, w.start, w.n_words, w.size + w.m AS t, list_contains(w.aligned, w.start) AS aligned, met.s, COUNT(*) AS c
       FROM win w JOIN met ON met.doc_id = w.doc_id AND met.item_id = w.item_id AND met.n = w.n AND met.pos BETWEEN w.start AND w.start + w.size - 1 GROUP BY ALL),
ic AS (SELECT item_id, s, COUNT(*) AS c FROM ips GROUP BY item_id, s),
ov AS (SELECT doc_id, item_id, start, n_words, aligned, SUM(LEAST(wc.c, ic.c)) AS o, t FROM wc JOIN ic USING (item_id, s) GROUP BY ALL)
SELECT doc_id, item_id, CAST(start AS INTEGER) AS start, CAST(n_words AS INTEGER) AS n_words, ROUND(o / (t - o), 6) AS similarity
FROM ov WHERE o / (t - o) >= 0.8 QUALIFY ROW_NUMBER() OVER (PARTITION BY doc_id, item_id ORDER BY o / (t - o) DESC, aligned DESC, start) = 1
"""

LINE_DEDUP = """
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, pos, lines[pos + 1 : pos + 3] AS win FROM (SELECT doc_id, lines, UNNEST(range(0, len(lines) - 2)) AS pos FROM l)),
gone AS (SELECT DISTINCT doc_id, UNNEST([pos, pos + 1, pos + 2]) AS k
         FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY win ORDER BY doc_id, pos) AS rn FROM w) WHERE rn > 1),
x AS (SELECT doc_id, UNNEST(range(0, len(lines))) AS k, UNNEST(lines) AS line FROM l),
kept AS (SELECT x.doc_id, string_agg(x.line, chr(10) ORDER BY x.k) FILTER (WHERE g.k IS NULL) AS own, COUNT(*) AS n_lines, COUNT(g.k) AS n_removed
         FROM x LEFT JOIN gone g ON g.doc_id = x.doc_id AND g.k = x.k GROUP BY x.doc_id)
SELECT l.doc_id, CASE WHEN l.text IS NOT NULL THEN COALESCE(kept.own, '') END AS text, CAST(COALESCE(n_lines, 0) AS INTEGER) AS n_lines,
  CAST(COALESCE(n_removed, 0) AS INTEGER) AS n_removed FROM l LEFT JOIN kept USING (doc_id)
"""


def draws(shards: int) -> str:
    return ", ".join(f"CAST('0x' || substr(md5(key || ':{s}'), 1, 13) AS BIGINT)" for s in range(shards))


# CRC-32 is a fold over the bytes with a table that eight shifts of each entry give.
CRC_TABLE = """step(k, n, c) AS (SELECT r, 0, r FROM (SELECT UNNEST(range(256)) AS r)
  UNION ALL SELECT k, n + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE n < 8),
crc AS (SELECT list(c ORDER BY k) AS t FROM step WHERE n = 8)"""


def crc32(text: str) -> str:
    return (
        f"xor(list_reduce(list_transform(range(0, strlen({text})), lambda k: CAST('0x' || substr(hex({text}), 2 * k + 1, 2) AS BIGINT)), "
        "lambda acc, b: xor(acc >> 8, t[CAST(xor(acc, b) & 255 AS INTEGER) + 1]), CAST(4294967295 AS BIGINT)), 4294967295)"
    )


SHARDS = f"""
WITH RECURSIVE {CRC_TABLE},
rows AS (SELECT doc_id, COALESCE(text, '') AS text, COALESCE(CAST(doc_id AS VARCHAR), 'null') AS key FROM documents),
sums AS (SELECT doc_id, key, strlen(text) + 1 AS size,
  {crc32("text")} AS crc FROM rows, crc),
placed AS (SELECT *, list_position([{draws(8)}], list_max([{draws(8)}])) - 1 AS shard, list_position([{draws(9)}], list_max([{draws(9)}])) - 1 AS grown,
  CAST('0x' || substr(md5(key || chr(31) || CAST(size AS VARCHAR) || chr(31) || CAST(crc AS VARCHAR)), 1, 8) AS BIGINT) % 256 AS part FROM sums)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
  ROW_NUMBER() OVER (PARTITION BY shard ORDER BY part, doc_id, size, crc) - 1 AS slot, CAST(grown AS INTEGER) AS grown_shard FROM placed
"""

INFILL = """
WITH d AS (SELECT doc_id, COALESCE(text, '') AS t, length(COALESCE(text, '')) AS n, sha256('1:' || COALESCE(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
draw AS (SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS x, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS y,
  CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS plain, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS turned FROM d),
cut AS (SELECT *, least(x, y) AS a, greatest(x, y) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR plain >= 90 THEN 'plain' WHEN turned < 20 THEN 'spm' ELSE 'psm' END AS form FROM draw),
part AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM part
"""

# Conversations step by step, all side by side: the best way to each state after each row, as cost, letters and lines.
REPAIR = rf"""
WITH RECURSIVE {CRC_TABLE},
given AS (SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
  COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
drawn AS (SELECT *, {crc32("key")} % 20 AS draw FROM given, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
  CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, UNNEST(range(CASE draw WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM drawn),
placed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k,
  regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS solid FROM damaged),
seen AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS again, substr(role, 1, 1) AS i,
  LAG(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM placed),
faulty AS (SELECT *, CASE WHEN solid = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM seen),
facts AS (SELECT c.conv_id, COUNT(k) AS n, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps, COUNT(*) FILTER (fault = 'blank') AS blank,
  COUNT(*) FILTER (fault = 'duplicate') AS duplicate, COUNT(*) FILTER (fault = 'truncated') AS truncated,
  COUNT(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faulty f ON c.conv_id IS NOT DISTINCT FROM f.conv_id GROUP BY c.conv_id),
way(conv_id, k, n, state, cost, audit, lines) AS (SELECT conv_id, CAST(0 AS BIGINT), n, 'e', 0, '', CAST([] AS VARCHAR[]) FROM facts
  UNION ALL SELECT conv_id, k, n, state, cost, audit, lines FROM (
    SELECT w.conv_id, w.k + 1 AS k, n, CASE m WHEN 'D' THEN w.state WHEN 'K' THEN i ELSE CASE w.state WHEN 'u' THEN 'a' ELSE 'u' END END AS state,
      cost + CASE m WHEN 'D' THEN 4 WHEN 'K' THEN 0 ELSE 3 END + CASE WHEN m <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END AS cost, audit || m AS audit,
      CASE m WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
        ELSE list_append(lines, CASE w.state WHEN 'u' THEN 'assistant:' ELSE 'user:' END || text) END AS lines
    FROM (SELECT conv_id, k, n, CASE WHEN j = 0 THEN state WHEN (j = 1) = (state = 'u') THEN 'a' ELSE 'u' END AS state, cost + 3 * j AS cost, audit || repeat('I', j) AS audit,
        lines || CASE WHEN j = 0 THEN [] WHEN state = 'u' THEN ['assistant:', 'user:'][1:j] ELSE ['user:', 'assistant:'][1:j] END AS lines
        FROM way, (VALUES (0), (1), (2)) AS inserted(j) WHERE k < n) w
      JOIN faulty f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.k = w.k + 1, (VALUES ('D'), ('K'), ('R')) AS move(m)
    WHERE m = 'D' OR fault IN ('', 'truncated') AND (m = 'R' OR w.state || i IN ('es', 'eu', 'su', 'ua', 'au')))
  QUALIFY ROW_NUMBER() OVER (PARTITION BY conv_id, k, state ORDER BY cost, audit) = 1),
ended AS (SELECT conv_id, cost + 3 * j AS cost, audit || repeat('I', j) AS audit,
    lines || CASE WHEN j = 0 THEN [] WHEN state = 'u' THEN ['assistant:'] ELSE ['user:', 'assistant:'] END AS lines
  FROM way, (VALUES (0), (1), (2)) AS inserted(j) WHERE k = n AND (j = 0 AND state IN ('e', 'a') OR j = 1 AND state = 'u' OR j = 2 AND state = 's')
  QUALIFY ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY cost + 3 * j, audit || repeat('I', j)) = 1)
SELECT f.conv_id, gaps, blank, duplicate, truncated, illegal, CAST(cost AS BIGINT) AS cost, audit, sha256(COALESCE(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM facts f JOIN ended e ON f.conv_id IS NOT DISTINCT FROM e.conv_id
"""

SQL = {"op5_rendezvous_shards": SHARDS, "op8_benchmark_leaks": LEAKS, "op9_line_dedup": LINE_DEDUP, "op11_fill_in_middle": INFILL, "op13_repair_conversations": REPAIR}
