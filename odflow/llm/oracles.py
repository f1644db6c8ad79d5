"""SQL for DuckDB that gives the rows of the queries, written from their definitions."""

from __future__ import annotations


def _spans(kind: str, rank: int, pattern: str, value: str, least: int) -> str:
    """Matches of one kind: the parts between matches and the matches themselves add up to offsets."""
    return f"""SELECT doc_id, '{kind}' AS kind, {rank} AS rank, start, start + length(m) AS stop FROM (
      SELECT doc_id, m, CAST(list_sum(list_transform(parts[1:k], lambda x: length(x))) + coalesce(list_sum(
        list_transform(ms[1:k - 1], lambda x: length(x))), 0) AS BIGINT) AS start FROM (
        SELECT doc_id, parts, ms, unnest(ms) AS m, unnest(range(1, len(ms) + 1)) AS k FROM (
          SELECT doc_id, string_split_regex(coalesce(text, ''), '{pattern}') AS parts,
            regexp_extract_all(coalesce(text, ''), '{pattern}') AS ms FROM documents)))
      WHERE length(regexp_extract(m, '{value}', 1)) >= {least}"""


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(name) for name in ("password", "passwd", "secret", "token"))
_ASSIGN = (f"(?:{_NAMES}|{_either_case('api')}_?{_either_case('key')})" r"""["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+""")
_ASSIGN_VALUE = (f"^(?:{_NAMES}|{_either_case('api')}_?{_either_case('key')})"
                 r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$""")

SECRETS = f"""WITH spans AS (
    {_spans('assign', 0, _ASSIGN, _ASSIGN_VALUE, 6)}
    UNION ALL {_spans('access', 1, 'AKIA[A-Z0-9]+', '(.*)', 20)}
    UNION ALL {_spans('hex', 2, '[0-9a-f]+', '(.*)', 24)}
    UNION ALL {_spans('github', 3, 'gh[pousr]_[A-Za-z0-9]{36,}', '(.*)', 1)}
    UNION ALL {_spans('pem', 4, '-----BEGIN [A-Z ]*PRIVATE KEY-----', '(.*)', 1)}),
  found AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans FROM spans GROUP BY doc_id)
  SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents d LEFT JOIN found USING (doc_id)"""

_CONTROL = r"<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>"


def _escaped_length(column: str) -> str:
    return (f"(length({column}) + length({column}) - length(replace({column}, '\\', '')) "
            f"+ len(regexp_extract_all({column}, '{_CONTROL}')))")


CHATS = f"""WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256, CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(24 + {_escaped_length('role')} + {_escaped_length('text')}) AS BIGINT) AS formatted_chars
  FROM rows GROUP BY conv_id"""

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_SYMBOLS = r"len(regexp_extract_all({}, '[#*$%&|<>]'))"

QUALITY = rf"""WITH texts AS (SELECT doc_id, text, words, len(words) AS n_words, list_filter(string_split(text, chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM (
      SELECT doc_id, text, {_WORDS.format('text')} AS words FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))),
  placed AS (SELECT doc_id, unnest(words) AS a, generate_subscripts(words, 1) AS pos FROM texts),
  triples AS (SELECT doc_id, pos, a, lead(a, 1) OVER w AS b, lead(a, 2) OVER w AS c FROM placed
      WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
  windows AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, a, b, c) AS often FROM triples WHERE c IS NOT NULL),
  repeated AS (SELECT doc_id, count(DISTINCT word) AS n FROM (
      SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS word FROM windows WHERE often > 1) GROUP BY doc_id),
  lines AS (SELECT doc_id, line, len({_WORDS.format('line')}) AS n, CAST(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT)
      AS chars FROM (SELECT doc_id, unnest(lines) AS line FROM texts)),
  judged AS (SELECT doc_id, chars, NOT regexp_matches(line, '[.!?…:;。！？]')
      OR regexp_matches(line, '(?i)^[ \t]*(home|menu|search|log ?in|sign ?(in|up)|next|previous|back to top|contact( us)?|about( us)?|site ?map)[ \t]*([|>»•·/-].*)?$')
      OR regexp_matches(line, '(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie|licensed under|released under|subscribe (now|to)|enable javascript|copyright \(?c|©)')
      OR {_SYMBOLS.format('line')} > n * 0.3 OR len(regexp_extract_all(line, '!!')) > n * 0.3 AS bad FROM lines),
  totals AS (SELECT doc_id, CAST(sum(chars) AS BIGINT) AS word_chars, CAST(coalesce(sum(chars) FILTER (bad), 0) AS BIGINT) AS lost,
      count(*) FILTER (bad) AS n_failed_lines FROM judged GROUP BY doc_id),
  base AS (SELECT t.doc_id, CAST(t.n_words AS BIGINT) AS n_words, coalesce(word_chars, 0) AS word_chars,
      CAST({_SYMBOLS.format('text')} AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
      coalesce(n, 0) AS n_repeat_words, coalesce(n_failed_lines, 0) AS n_failed_lines, coalesce(lost, 0) AS lost
      FROM texts t LEFT JOIN repeated USING (doc_id) LEFT JOIN totals USING (doc_id))
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_failed_lines,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND word_chars - lost >= word_chars * 0.6 AS kept FROM base"""

# Pairs are found by their shared shingles, groups by carrying the smallest id along links.
NEAR_DUPLICATES = rf"""WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  shingles AS (SELECT DISTINCT doc_id, array_to_string(w[k : k + 4], ' ') AS s FROM (
      SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS k FROM texts WHERE len(w) > 0)),
  sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
  pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b
      ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
  links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
      WHERE 100 * common >= 85 * (x.n + y.n - common)),
  reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
  least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
  SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
  FROM least LEFT JOIN sizes USING (doc_id)"""

WARC = """WITH payloads AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
      sha1(coalesce(html, '')) AS payload_digest FROM pages),
  kept AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END
      AS keeper FROM payloads)
  SELECT page_id, payload_bytes, payload_digest, CASE WHEN keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN keeper <> page_id THEN keeper END AS refers_to FROM kept"""

TOP_K = """WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  scored AS (SELECT q.vec_id AS query_id, r.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda k: q.v[k] * r.v[k])) AS BIGINT)
      AS score FROM whole q JOIN whole r ON q.vec_id % 100 = 0 AND r.vec_id <> q.vec_id),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
  SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10"""

# The checksum of conversation and turn, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_transform(range(1, length({key}) + 1), lambda k: CAST(ascii(substr({key}, k, 1)) AS BIGINT)),
      lambda crc, b: list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, xor(crc, b)),
      4294967295))"""
# (state, initial of a kept row, state after it), and the state after an inserted or rerolled one.
_KEEP = "(VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2))"
_FORCED = "CASE WHEN state = 2 THEN 3 ELSE 2 END"
# Up to two inserts after each row are enough: a third would come back to a state at a higher cost.
_INSERTED = f"""SELECT conv, pos, state, cost, audit FROM {{0}} UNION ALL
      SELECT conv, pos, {_FORCED}, cost + 2, audit || 'I' FROM {{0}} UNION ALL
      SELECT conv, pos, CASE WHEN state = 2 THEN 2 ELSE 3 END, cost + 4, audit || 'II' FROM {{0}}"""

REPAIR = rf"""WITH RECURSIVE originals AS (SELECT conv_id, coalesce('=' || CAST(conv_id AS VARCHAR), ' ') AS conv, turn,
      coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' ||
      coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
  kinds AS (SELECT *, {_CRC.format(key='key')} % 20 AS kind FROM originals),
  damaged AS (SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN ''
      WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM kinds WHERE kind <> 0
    UNION ALL SELECT conv, turn, role, text FROM kinds WHERE kind = 3),
  numbered AS (SELECT *, row_number() OVER w AS pos, substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER w AS before FROM damaged
      WINDOW w AS (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text)),
  judged AS MATERIALIZED (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
      WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1 THEN 2
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault FROM numbered),
  counts AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
      count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
      count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
      FROM judged GROUP BY conv),
  starts AS (SELECT conv, 0 AS pos, 0 AS state, 0 AS cost, '' AS audit FROM counts),
  -- Cheapest edits up to each row by state, cost and audit as one comparable pair.
  labels AS (SELECT conv, pos, state, min(struct_pack(cost := cost, audit := audit)) AS best
      FROM ({_INSERTED.format('starts')}) GROUP BY conv, pos, state
    UNION ALL SELECT conv, pos, state, min(struct_pack(cost := cost, audit := audit)) AS best FROM (
      WITH stepped AS (
        SELECT l.conv, l.pos + 1 AS pos, l.state, l.best.cost + 3 AS cost, l.best.audit || 'D' AS audit FROM labels l
          JOIN judged j ON j.conv = l.conv AND j.pos = l.pos + 1
        UNION ALL SELECT l.conv, l.pos + 1, k.next, l.best.cost + CASE WHEN j.fault = 3 THEN 1 ELSE 0 END, l.best.audit || 'K'
          FROM labels l JOIN judged j ON j.conv = l.conv AND j.pos = l.pos + 1 AND j.fault IN (0, 3)
          JOIN {_KEEP} k(state, initial, next) ON k.state = l.state AND k.initial = j.initial
        UNION ALL SELECT l.conv, l.pos + 1, {_FORCED.replace('state', 'l.state')}, l.best.cost + CASE WHEN j.fault = 3 THEN 3 ELSE 2 END,
          l.best.audit || 'R' FROM labels l JOIN judged j ON j.conv = l.conv AND j.pos = l.pos + 1 AND j.fault IN (0, 3))
      {_INSERTED.format('stepped')}) GROUP BY conv, pos, state),
  solved AS (SELECT l.conv, min(best) AS best FROM labels l JOIN counts c ON c.conv = l.conv AND c.n = l.pos
      WHERE state IN (0, 3) GROUP BY l.conv),
  letters AS (SELECT conv, best.audit AS audit, substr(best.audit, k, 1) AS letter, k FROM (
      SELECT conv, best, unnest(range(1, length(best.audit) + 1)) AS k FROM solved)),
  used AS (SELECT conv, letter, k, count(*) FILTER (letter <> 'I') OVER w AS pos, count(*) FILTER (letter <> 'D') OVER w AS number
      FROM letters WINDOW w AS (PARTITION BY conv ORDER BY k)),
  emitted AS (SELECT u.*, j.role, j.text, max(CASE WHEN number = 1 AND letter = 'K' AND j.initial = 's' THEN 1 ELSE 0 END)
      OVER (PARTITION BY u.conv) AS led FROM used u LEFT JOIN judged j ON j.conv = u.conv AND j.pos = u.pos AND letter <> 'I'
      WHERE letter <> 'D'),
  repaired AS (SELECT conv, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (number - led) % 2 = 1 THEN 'user'
      ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY k)) AS digest FROM emitted GROUP BY conv)
  SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(s.best.cost, 0) AS BIGINT) AS cost,
    coalesce(s.best.audit, '') AS audit, coalesce(r.digest, sha256('')) AS repaired_sha256
  FROM (SELECT DISTINCT conv_id, conv FROM originals) o LEFT JOIN counts c USING (conv) LEFT JOIN solved s USING (conv)
  LEFT JOIN repaired r USING (conv)"""
