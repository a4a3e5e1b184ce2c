"""Checking SQL (DuckDB) of the text queries that SQL can express."""

from __future__ import annotations

from wardlens.llm import credentials

_WORD = r"[^\x20\x09-\x0D]+"

WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
f AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest,
             min(page_id) OVER (PARTITION BY payload) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM f"""

# crc32 from its polynomial: a table of 256 steps, then one byte of each distinct word at a time
IMPORTANCE = r"""
WITH RECURSIVE bits(i, c, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
steps AS (SELECT list(c ORDER BY i) AS x FROM bits WHERE k = 8),
texts AS (SELECT doc_id AS id, true AS doc, text FROM documents UNION ALL SELECT item_id, false, text FROM benchmark),
listed AS (SELECT id, doc, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
flat AS (SELECT id, doc, unnest(words) AS word FROM listed),
crc(word, h, p, c) AS (
  SELECT DISTINCT word, hex(encode(word)), 0, 4294967295 FROM flat
  UNION ALL SELECT word, h, p + 1, xor(c >> 8, x[(xor(c, ('0x' || substr(h, 2 * p + 1, 2))::BIGINT) & 255) + 1])
  FROM crc, steps WHERE 2 * p < length(h)),
hashed AS (SELECT word, xor(c, 4294967295) % 10000 AS bucket FROM crc WHERE 2 * p = length(h)),
counted AS (SELECT id, doc, bucket, count(*) AS n FROM flat JOIN hashed USING (word) GROUP BY ALL),
sides AS (SELECT bucket, coalesce(sum(n) FILTER (doc), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (NOT doc), 0)::DOUBLE AS t
          FROM counted GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM sides),
gains AS (SELECT bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain
          FROM sides, totals),
weights AS (SELECT id, sum(n * gain)::BIGINT AS weight FROM counted JOIN gains USING (bucket) WHERE doc GROUP BY id),
scored AS (SELECT id AS doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || id), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                / 4294967296::DOUBLE))))::BIGINT AS score
  FROM listed LEFT JOIN weights USING (id) WHERE doc),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
           FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scored s LEFT JOIN ranked r ON s.doc_id = r.doc_id"""

FILTER_AUDIT = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
fails AS (SELECT doc_id, part,
    (len(ws) < 100)::INT + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT
    + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * (min(doc_id) OVER (PARTITION BY t) < doc_id)::INT AS failed FROM words),
marked AS (SELECT part, failed, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
           FROM fails LEFT JOIN labels USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
orders(filter_order, used) AS (
  SELECT '', 0 UNION ALL SELECT filter_order || letter, used + bit FROM orders, letters WHERE used & bit = 0),
steps AS (SELECT filter_order, step::INT AS step, letter, bit, (SELECT coalesce(sum(b.bit), 0)::BIGINT FROM letters b
            WHERE contains(substr(filter_order, 1, step - 1), b.letter)) AS before
          FROM (SELECT filter_order FROM orders WHERE used = 31), range(1, 6) r(step), letters
          WHERE letter = substr(filter_order, step, 1)),
combined AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
             FROM marked GROUP BY ALL),
counted AS (SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (failed & (before | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (failed & bit <> 0 AND failed & before = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (failed & bit <> 0 AND failed & before <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (failed = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (failed & bit <> 0 AND failed & before = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (failed & bit <> 0 AND failed & before = 0), 0)::BIGINT AS toxic_lost
  FROM combined, steps GROUP BY ALL)
SELECT * EXCLUDE (letter), sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley FROM counted"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _credentials() -> str:
    c = credentials
    scans = {"assign": c.ASSIGN, "access": c.ACCESS, "hex": c.HEX, "weak": c.WEAK}
    cut = "\n  UNION ALL ".join(
        f"SELECT doc_id, '{scan}' AS scan, regexp_extract_all(t, {_quoted(p)}) AS ms, string_split_regex(t, {_quoted(p)}) AS ps FROM d"
        for scan, p in scans.items())
    value = f"length(regexp_extract(m, {_quoted(c.ASSIGN)}, 1))"

    def matches(pattern: str) -> str:
        return f"regexp_full_match(m, {_quoted(pattern)})"

    needs = " OR ".join(f"kind = '{k}' AND " + " AND ".join(f"has_{r}" for r in roles) for k, roles in c.NEEDS.items())
    roles = " ".join(f"WHEN '{k}' THEN '{r}'" for k, r in c.ROLE.items())
    kinds = ", ".join(f"'{k}'" for k in c.KINDS)
    strong = ", ".join(f"'{k}'" for k in c.STRONG)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
cut AS ({cut}),
laid AS (SELECT doc_id, scan, ms[i] AS m, sum(length(ps[i]) + length(ms[i])) OVER (PARTITION BY doc_id, scan ORDER BY i) AS e
         FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM cut)),
kinds AS (SELECT doc_id, e::BIGINT - length(m) AS s, e::BIGINT AS e, CASE
    WHEN scan = 'assign' THEN CASE WHEN {value} >= 8 THEN 'assign' END
    WHEN scan <> 'weak' THEN scan
    WHEN {matches(c.ASSIGN)} THEN CASE WHEN {value} < 8 THEN 'short' END
    WHEN {matches(c.LOGIN)} THEN 'login'
    WHEN {matches(c.ENDPOINT)} OR {matches(c.ADDRESS)} THEN 'endpoint'
    WHEN regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]') AND length(m) <= 128
      AND NOT regexp_matches(m, '{c.ACCESS}') AND NOT regexp_matches(m, '{c.HEX}') THEN 'blob' END AS kind FROM laid),
parts AS (SELECT *, CASE kind {roles} END AS role FROM kinds WHERE kind IS NOT NULL),
met AS (SELECT a.doc_id, a.kind, a.s, a.e, bool_or(b.role = 'identifier') AS has_identifier, bool_or(b.role = 'secret') AS has_secret
        FROM parts a JOIN parts b ON a.doc_id = b.doc_id AND b.s < a.e + {c.REACH} AND b.e > a.s - {c.REACH}
        WHERE a.kind NOT IN ({strong}) GROUP BY ALL),
spans AS (SELECT doc_id, kind, s, e FROM parts WHERE kind IN ({strong}) UNION ALL SELECT doc_id, kind, s, e FROM met WHERE {needs}),
shown AS (SELECT doc_id, kind, s, list_position([{kinds}], kind) AS o, concat_ws(':', kind, s, e) AS span FROM spans)
SELECT d.doc_id, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in c.STRONG)},
       sha256(coalesce(string_agg(span, ',' ORDER BY s, o) FILTER (o <= {len(c.STRONG)}), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY s, o), '') AS spans
FROM d LEFT JOIN shown ON d.doc_id = shown.doc_id GROUP BY d.doc_id"""


ORACLES = {"op4_warc": WARC, "op11_importance": IMPORTANCE, "op12_filter_audit": FILTER_AUDIT,
           "op13_credentials": _credentials()}
