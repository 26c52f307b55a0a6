"""DuckDB SQL that says another way what queries of this package return."""

from __future__ import annotations

from recurra.llm import license_scan

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def license_scan_sql() -> str:
    """The same rules, matched by another engine; containment by a join of detections with each other."""
    values = ",\n".join(
        f"({r.number}, {r.priority}, {_quoted(r.label)}, {_quoted(r.pattern)}, {r.is_base}, {license_scan.SCORES[r.priority]})"
        for r in license_scan.rules()
    )
    return f"""
WITH rules(number, priority, label, pattern, is_base, score) AS (VALUES {values}),
plain AS (
  SELECT row_number() OVER () AS r, doc_id, trim(regexp_replace({_LOWER}, '{_PLAIN}', ' ', 'g')) AS t FROM documents),
words AS (
  SELECT r, doc_id, CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END AS n_words, ' ' || replace(t, ' ', '  ') || ' ' AS w FROM plain),
-- A quick look that leaves out texts in which no rule can match.
likely AS (SELECT * FROM words WHERE regexp_matches(w, 'licen|under|permission|redistribut|public|reserved|confidential|warranty|gpl|cc|creative')),
hits AS (
  SELECT r, number, priority, label, is_base, score, regexp_extract_all(w, pattern) AS h, string_split_regex(w, pattern) AS g
  FROM likely, rules WHERE regexp_matches(w, pattern)),
counted AS (
  SELECT * REPLACE (list_transform(h, lambda x: (length(x) - length(replace(x, ' ', ''))) // 2) AS h,
                    list_transform(g, lambda x: (length(x) - length(replace(x, ' ', ''))) // 2) AS g) FROM hits),
placed AS (
  SELECT r, number, priority, label, is_base, score, h[k] AS extent, list_sum(g[1:k]) + coalesce(list_sum(h[1:k - 1]), 0) AS b
  FROM (SELECT *, unnest(range(1, len(h) + 1)) AS k FROM counted)),
spans AS (SELECT *, b + extent AS e FROM placed),
kept AS (
  SELECT * FROM spans x WHERE is_base OR NOT EXISTS (
    SELECT 1 FROM spans y WHERE y.r = x.r AND y.priority <= x.priority AND y.b <= x.b AND y.e >= x.e
      AND (y.b, -y.e, y.priority, y.number) < (x.b, -x.e, x.priority, x.number))),
per_doc AS (
  SELECT r, count(*) FILTER (is_base) AS n_base, min(b) FILTER (is_base) AS first_word, max(b) FILTER (is_base) AS last_word,
    list_sort(list(DISTINCT label) FILTER (is_base)) AS base_list, list_sort(list(DISTINCT label)) AS all_list, max(score) AS score
  FROM kept GROUP BY r)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(array_to_string(base_list, ','), '') AS base_labels,
  coalesce(array_to_string(all_list, ','), '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM words LEFT JOIN per_doc USING (r)
"""


# The digest's 40 hexadecimal digits in base 32: four bits a digit, five a letter.
WARC = """
WITH sized AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
digits AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, upper(sha1(payload)) AS hex FROM sized),
bits AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(strpos('0123456789ABCDEF', hex[i]) - 1), 4, '0')), '') AS b FROM digits),
named AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    list_sum(list_transform(range(0, 5), lambda j: CASE WHEN b[i * 5 + j + 1] = '1' THEN 1 << (4 - j) ELSE 0 END))::INT + 1, 1)), '') AS payload_digest
  FROM bits),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS lowest FROM named)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = lowest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = lowest THEN NULL ELSE lowest END AS refers_to
FROM firsts
"""

# Variants as texts where the query has hashes; doc_id is a key of documents, so it orders the places of a line.
LINE_DEDUP = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(len(string_split(text, chr(10))))) AS line_no
  FROM documents WHERE text IS NOT NULL),
lines AS (SELECT *, trim(regexp_replace(raw, '[ \t\n\x0b\x0c\r]+', ' ', 'g')) AS line FROM split),
placed AS (
  SELECT doc_id, raw, line_no, string_split(line, ' ') AS w, line, doc_id::HUGEINT * 1000000000 + line_no AS place FROM lines),
firsts AS (SELECT line, any_value(w) AS w, min(place) AS first FROM placed WHERE line <> '' GROUP BY line),
long AS (SELECT *, len(w) AS n FROM firsts WHERE len(w) >= 5),
variants AS (
  SELECT line, first, n, i, array_to_string(list_concat(w[1:i - 1], w[i + 1:]), ' ') AS v FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM long)),
earliest AS (SELECT v, n, i, min(first) AS e FROM variants GROUP BY ALL),
near AS (
  SELECT line FROM variants JOIN earliest USING (v, n, i) WHERE e < first
  UNION SELECT x.line FROM variants x JOIN long y ON y.line = x.v WHERE y.first < x.first
  UNION SELECT y.line FROM long y JOIN variants x ON y.line = x.v WHERE x.first < y.first),
judged AS (
  SELECT doc_id, raw, line_no, line <> '' AND place <> first AS exact, line <> '' AND place = first AND near.line IS NOT NULL AS is_near
  FROM placed LEFT JOIN firsts USING (line) LEFT JOIN near USING (line)),
per_doc AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (exact) AS n_exact, count(*) FILTER (is_near) AS n_near,
    coalesce(string_agg(raw, chr(10) ORDER BY line_no) FILTER (NOT coalesce(exact, false) AND NOT coalesce(is_near, false)), '') AS text
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_exact, 0) AS BIGINT) AS n_exact,
  CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CASE WHEN d.text IS NOT NULL THEN p.text END AS text
FROM documents d LEFT JOIN per_doc p USING (doc_id)
"""

DECONTAMINATION = r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 'b', item_id, coalesce(text, '') FROM benchmark),
words AS (
  SELECT kind, id, list_filter(string_split(regexp_replace(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda w: w <> '') AS w
  FROM texts),
windows AS (
  SELECT kind, id, i, array_to_string(w[i:i + 9], ' ') AS v, least(len(w), 10) AS n
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM words WHERE len(w) > 0 AND (kind = 'b' OR len(w) >= 10))),
-- Items shorter than a window are looked for at every place of every document.
short AS (SELECT DISTINCT v, n FROM windows WHERE kind = 'b' AND n < 10),
places AS (
  SELECT id, i, v, n FROM windows WHERE kind = 'd'
  UNION ALL
  SELECT id, i, array_to_string(w[i:i + n - 1], ' '), n
  FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, (SELECT DISTINCT n FROM short) WHERE kind = 'd' AND len(w) >= n)),
found AS (
  SELECT p.id AS doc_id, p.i, p.n, b.id AS item_id FROM places p JOIN windows b ON b.kind = 'b' AND b.v = p.v AND b.n = p.n),
hits AS (
  SELECT doc_id, count(DISTINCT word_no) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS word_no FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS l FROM found GROUP BY doc_id)
SELECT w.id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(l), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(l, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hits h ON h.doc_id = w.id LEFT JOIN items t ON t.doc_id = w.id WHERE w.kind = 'd'
"""


# CRC-32 by its table: one entry for every byte, then one step a character of an ASCII text.
_CRC_TABLE = """
crc_entries AS (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) AS v FROM range(256) t(i)),
crc_table AS (SELECT list(v ORDER BY i) AS entries FROM crc_entries)"""


def _crc32(text: str) -> str:
    """Needs crc_table in the FROM clause."""
    bytes_of = f"list_transform(string_split({text}, ''), lambda ch: CAST(ord(ch) AS BIGINT))"
    steps = f"list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {bytes_of}), lambda acc, b: xor(acc >> 8, entries[1 + (xor(acc, b) & 255)]))"
    return f"xor({steps}, 4294967295)"


def _framed(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR) END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_framed, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


def _climb(nodes: str, key: str) -> str:
    """One level up: runs of two become their hash until a group has one node."""
    return (
        f"SELECT {key}, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(size) + 1) // 2 "
        f"FROM {nodes} WHERE size > 1 GROUP BY {key}, level, pos // 2"
    )


def _fold(walk: str, nodes: str) -> str:
    """One step of every leaf's path: its sibling, if any, is hashed on its side."""
    beside = "coalesce(n.digest, '')"
    return (
        f"SELECT w.id, w.grp, w.level + 1, w.pos // 2, (w.size + 1) // 2, w.siblings || {beside}, "
        f"sha256(CASE WHEN w.pos % 2 = 1 THEN {beside} || w.acc ELSE w.acc || {beside} END) "
        f"FROM {walk} w LEFT JOIN {nodes} n ON n.grp = w.grp AND n.level = w.level AND n.pos = xor(w.pos, 1) WHERE w.size > 1"
    )


MERKLE = f"""
WITH RECURSIVE {_CRC_TABLE.strip()},
read AS (SELECT d.*, coalesce({_crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0, FALSE) AS tampered FROM documents d, crc_table),
hashed AS (
  SELECT doc_id, coalesce('=' || lang, '') AS grp, {_leaf('n_chars')} AS leaf, CASE WHEN tampered THEN {_leaf('(n_chars + 1)')} END AS changed FROM read
),
leaves AS (
  SELECT *, row_number() OVER () AS id, CAST(row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS BIGINT) AS pos,
         CAST(count(*) OVER (PARTITION BY grp) AS BIGINT) AS size
  FROM hashed
),
nodes(grp, level, pos, digest, size) AS (SELECT grp, 0, pos, leaf, size FROM leaves UNION ALL {_climb('nodes', 'grp')}),
subroots AS (
  SELECT 'all' AS grp, grp AS key, digest, CAST(row_number() OVER (ORDER BY grp) - 1 AS BIGINT) AS pos, CAST(count(*) OVER () AS BIGINT) AS size
  FROM nodes WHERE size = 1
),
tops(grp, level, pos, digest, size) AS (SELECT grp, 0, pos, digest, size FROM subroots UNION ALL {_climb('tops', 'grp')}),
walk(id, grp, level, pos, size, siblings, acc) AS (
  SELECT id, grp, 0, pos, size, '', coalesce(changed, leaf) FROM leaves UNION ALL {_fold('walk', 'nodes')}
),
high(id, grp, level, pos, size, siblings, acc) AS (
  SELECT w.id, s.grp, 0, s.pos, s.size, w.siblings, w.acc FROM walk w JOIN subroots s ON s.key = w.grp WHERE w.size = 1
  UNION ALL {_fold('high', 'tops')}
),
root AS (SELECT digest FROM tops WHERE size = 1)
SELECT l.doc_id, l.leaf, s.digest AS subroot, root.digest AS root, sha256(h.siblings) AS proof_sha256, h.acc AS folded_root, h.acc = root.digest AS verified
FROM leaves l JOIN high h ON h.id = l.id AND h.size = 1 JOIN subroots s ON s.key = l.grp, root
"""

# States: 0 nothing yet, 1 after system, 2 after user, 3 after a pair.
CONVERSATIONS = f"""
WITH RECURSIVE {_CRC_TABLE.strip()},
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations, crc_table
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM keyed, range(2) copies(c) WHERE kind <> 0 AND (c = 0 OR kind = 3)
),
compared AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS seen FROM damaged
),
numbered AS (
  SELECT *, row_number() OVER conv AS idx, left(role, 1) AS initial, lag(left(role, 1)) OVER conv AS before,
         regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS last_character
  FROM compared WINDOW conv AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen)
),
judged AS (
  SELECT *, CASE WHEN last_character = '' THEN 'blank' WHEN seen THEN 'duplicate' WHEN last_character NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM numbered
),
inserted(q, q2, cost, letters, lines) AS (
  VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
         (0, 2, 2, 'I', '_user:'), (1, 2, 2, 'I', '_user:'), (2, 3, 2, 'I', '_assistant:'), (3, 2, 2, 'I', '_user:'),
         (0, 3, 4, 'II', '_user:_assistant:'), (1, 3, 4, 'II', '_user:_assistant:'), (2, 2, 4, 'II', '_assistant:_user:'), (3, 3, 4, 'II', '_user:_assistant:')
),
edits(q, q2, letter, initial, role, cost) AS (
  VALUES (0, 1, 'K', 's', NULL, 0), (0, 2, 'K', 'u', NULL, 0), (1, 2, 'K', 'u', NULL, 0), (2, 3, 'K', 'a', NULL, 0), (3, 2, 'K', 'u', NULL, 0),
         (0, 2, 'R', NULL, 'user', 2), (1, 2, 'R', NULL, 'user', 2), (2, 3, 'R', NULL, 'assistant', 2), (3, 2, 'R', NULL, 'user', 2),
         (0, 0, 'D', NULL, NULL, 3), (1, 1, 'D', NULL, NULL, 3), (2, 2, 'D', NULL, NULL, 3), (3, 3, 'D', NULL, NULL, 3)
),
best(conv_id, idx, q, weight) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, {{'cost': 0, 'audit': '', 'lines': ''}} FROM conversations
  UNION ALL
  SELECT r.conv_id, r.idx, e.q2, min({{
           'cost': b.weight.cost + i.cost + e.cost + CASE WHEN e.letter <> 'D' AND r.fault = 'truncated' THEN 1 ELSE 0 END,
           'audit': b.weight.audit || i.letters || e.letter,
           'lines': b.weight.lines || replace(i.lines, '_', chr(10)) || CASE WHEN e.letter = 'D' THEN '' ELSE chr(10) || coalesce(e.role, r.role) || ':' || r.text END}})
  FROM best b JOIN judged r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.idx = b.idx + 1 JOIN inserted i ON i.q = b.q JOIN edits e ON e.q = i.q2
  WHERE (e.letter = 'D' OR r.fault NOT IN ('blank', 'duplicate')) AND (e.letter <> 'K' OR e.initial = r.initial)
  GROUP BY r.conv_id, r.idx, e.q2
),
facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
),
goal AS (
  SELECT b.conv_id, min({{'cost': b.weight.cost + i.cost, 'audit': b.weight.audit || i.letters, 'lines': b.weight.lines || replace(i.lines, '_', chr(10))}}) AS weight
  FROM best b LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM b.conv_id JOIN inserted i ON i.q = b.q
  WHERE b.idx = coalesce(f.n, 0) AND i.q2 IN (0, 3) GROUP BY b.conv_id
)
SELECT g.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(g.weight.cost AS BIGINT) AS cost, g.weight.audit AS audit, sha256(substr(g.weight.lines, 2)) AS repaired_sha256
FROM goal g LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM g.conv_id
"""
