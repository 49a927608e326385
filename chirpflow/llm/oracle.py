"""DuckDB twins of the operators that SQL can express."""

from __future__ import annotations

from .line_rules import BOILERPLATE_WORDS, MAX_LOSS, MAX_REPEATED, MIN_WORDS, PHRASES, SHORT_LINE_WORDS

WHITE = r"\x20\x09-\x0D"

LINE_RULES = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT r, doc_id, t, regexp_extract_all(t, '[^{WHITE}]+') AS words FROM d
), lines AS (
    SELECT r, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d
), judged AS (
    SELECT r, l, i, len(regexp_extract_all(l, '[^{WHITE}]+')) AS n,
           row_number() OVER (PARTITION BY r, l ORDER BY i) AS copy,
           len(regexp_extract_all(l, '[|>»•·]')) AS separators,
           len(list_filter(regexp_extract_all(l, '[^{WHITE}]+'), lambda w: regexp_full_match(w, '[|>»•·]'))) AS alone,
           len(regexp_extract_all(l, '[#*$%&|<>]')) AS symbols,
           length(regexp_replace(l, '[{WHITE}]+', '', 'g')) AS chars
    FROM lines
), ruled AS (
    SELECT r, copy, chars, CASE
        WHEN copy > 1 THEN 'repeated'
        WHEN separators >= 2 AND 2 * separators >= n - alone THEN 'navigation'
        WHEN n <= {BOILERPLATE_WORDS} AND regexp_matches(
            translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '{"|".join(p.decode() for p in PHRASES)}') THEN 'boilerplate'
        WHEN symbols > n THEN 'punctuation'
        WHEN n < {SHORT_LINE_WORDS} AND NOT regexp_matches(l, '[.!?:;,)\\]"''|\\-…”»。][{WHITE}]*$') THEN 'punctuation'
        END AS rule
    FROM judged WHERE n > 0
), by_line AS (
    SELECT r, count(*) AS n_lines, count(*) FILTER (copy > 1) AS n_dup_lines, count(rule) AS n_removed_lines,
           coalesce(sum(chars) FILTER (rule IS NOT NULL), 0) AS removed_chars,
           coalesce(string_agg(DISTINCT rule, ',' ORDER BY rule), '') AS removed_rules
    FROM ruled GROUP BY r
), places AS (
    SELECT r, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM w
), windows AS (
    SELECT r, i, a, lead(a) OVER s AS b, lead(a, 2) OVER s AS c FROM places WINDOW s AS (PARTITION BY r ORDER BY i)
), found AS (
    SELECT r, i, c IS NOT NULL AND count(*) OVER (PARTITION BY r, a, b, c) > 1 AS again FROM windows
), inside AS (
    SELECT r, again OR coalesce(lag(again) OVER s, false) OR coalesce(lag(again, 2) OVER s, false) AS yes
    FROM found WINDOW s AS (PARTITION BY r ORDER BY i)
), repeated AS (
    SELECT r, count(*) FILTER (yes) AS n FROM inside GROUP BY r
), counted AS (
    SELECT w.doc_id, len(words) AS n_words, length(regexp_replace(t, '[{WHITE}]+', '', 'g')) AS word_chars,
           len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(repeated.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
           coalesce(n_removed_lines, 0) AS n_removed_lines, coalesce(removed_chars, 0) AS removed_chars,
           coalesce(removed_rules, '') AS removed_rules
    FROM w LEFT JOIN by_line USING (r) LEFT JOIN repeated USING (r)
), failed AS (
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM counted
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND 100 * removed_chars <= {MAX_LOSS} * word_chars AS kept,
       CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed_lines AS BIGINT) AS n_removed_lines,
       CAST(removed_chars AS BIGINT) AS removed_chars, removed_rules
FROM failed
"""

# The other nine learn a model, search approximately, hash or use formats that
# SQL does not have; tests/llm holds them against brute force.
WARC = """
WITH d AS (
    SELECT row_number() OVER () AS r, page_id, encode(coalesce(html, '')) AS payload FROM pages
), s AS (
    SELECT r, page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM d
), bits AS (
    SELECT s.*, first_value(page_id) OVER (PARTITION BY hex ORDER BY page_id DESC NULLS LAST, r DESC) AS head,
           row_number() OVER (PARTITION BY hex ORDER BY page_id DESC NULLS LAST, r DESC) AS place
    FROM s
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)
           FOR i IN range(32)], 'string_agg', '') AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN head END AS refers_to
FROM bits
"""

ORACLE: dict[str, str] = {"op10_line_rules": LINE_RULES, "op8_warc": WARC}


# --------------------------------------------------- sampling, chats, repair

def _crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of a text's UTF-8 bytes, with the table ``crc`` in scope."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT"
    return (f"xor(list_reduce([{byte} FOR i IN range(octet_length(encode({text})))], lambda c, b: "
            "xor(crc_table[1 + (xor(c, b) & 255)], c >> 8), 4294967295::BIGINT), 4294967295::BIGINT)")


#: The table of CRC-32, eight steps of the reflected polynomial for each byte.
_CRC_TABLE = """crc AS (
    SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                            v::BIGINT) ORDER BY v) AS crc_table FROM range(256) AS t(v)
)"""


def _features(table: str) -> str:
    words = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return f"""(SELECT *, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) AS feature
        FROM (SELECT row_number() OVER () AS r, *, {words} AS w FROM {table}))"""


RESAMPLING = f"""
WITH {_CRC_TABLE}, own AS (
    SELECT r, feature FROM {_features("documents")}
), wanted AS (
    SELECT r, feature FROM {_features("benchmark")}
), hashed AS (
    SELECT feature, {_crc32("feature")} % 10000 AS bucket
    FROM (SELECT feature FROM own UNION SELECT feature FROM wanted), crc
), s AS (
    SELECT bucket, count(*) AS n FROM own JOIN hashed USING (feature) GROUP BY bucket
), t AS (
    SELECT bucket, count(*) AS n FROM wanted JOIN hashed USING (feature) GROUP BY bucket
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM own) + 10000)::DOUBLE
        / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM wanted) + 10000)::DOUBLE))) AS BIGINT) AS gain
    FROM s LEFT JOIN t USING (bucket)
), weighed AS (
    SELECT r, count(*) AS n_features, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
    FROM own JOIN hashed USING (feature) JOIN gains USING (bucket) GROUP BY r
), scored AS (
    SELECT d.r, d.doc_id, len(d.w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')),
               1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
    FROM (SELECT row_number() OVER () AS r, doc_id,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
          FROM documents) d LEFT JOIN weighed USING (r)
), ranked AS (
    SELECT *, n_words >= 20 AS takes_part, count(*) FILTER (n_words >= 20) OVER () AS n,
           row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place
    FROM scored
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, n_features, weight, score,
       CASE WHEN takes_part AND place <= 25 * n // 100 THEN place END AS rank
FROM ranked
"""

CHATS = r"""
WITH own AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), sized AS (
    SELECT *, replace(replace(text, '&', '&amp;'), '<|', '&lt;|') AS body,
           replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&nl;') AS heading,
           lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
    FROM own
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(body) + CASE WHEN before IS NOT DISTINCT FROM role THEN length('<|im_sep|>')
           ELSE length('<|im_start|>') + length(heading) + 1 + length('<|im_end|>') + 1 END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

#: Edits between rows: from one state (the last initial written) to another by inserted rows.
_INSERTS = """(VALUES ('', '', 0, '', []::VARCHAR[]), ('s', 's', 0, '', []), ('u', 'u', 0, '', []), ('a', 'a', 0, '', []),
    ('', 'u', 3, 'I', ['user:']), ('s', 'u', 3, 'I', ['user:']), ('a', 'u', 3, 'I', ['user:']), ('u', 'a', 3, 'I', ['assistant:']),
    ('', 'a', 6, 'II', ['user:', 'assistant:']), ('s', 'a', 6, 'II', ['user:', 'assistant:'])) AS ins(state, next, c, l, o)"""

REPAIR = rf"""
WITH RECURSIVE {_CRC_TABLE}, keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), kinds AS (
    SELECT *, {_crc32("k")} % 20 AS kind FROM keyed, crc
), hit AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM kinds
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM hit
), judged AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^{WHITE}]') THEN 'blank'
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                   WHEN NOT regexp_matches(text, '[.!?][{WHITE}]*$') THEN 'truncated' ELSE '' END AS fault,
           coalesce(lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] NOT IN ('su', 'ua', 'au'), false) AS illegal
    FROM placed
), counted AS (
    SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
    FROM judged GROUP BY conv_id
), path(conv_id, i, state, best) AS (
    SELECT conv_id, 0::BIGINT, '', {{'cost': 0, 'audit': '', 'out': []::VARCHAR[]}} FROM counted
    UNION ALL
    SELECT conv_id, i, state, min(best) FROM (
        SELECT j.conv_id, j.i, e.next AS state,
               {{'cost': p.best.cost + ins.c + e.c, 'audit': p.best.audit || ins.l || e.l,
                 'out': list_concat(p.best.out, ins.o, e.o)}} AS best
        FROM path p JOIN {_INSERTS} ON ins.state = p.state
        JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.i = p.i + 1,
        LATERAL (SELECT unnest([
            {{'next': ins.next, 'c': 4, 'l': 'D', 'o': []::VARCHAR[]}},
            CASE WHEN j.fault IN ('', 'truncated') AND (j.role[1] = 's' AND ins.next = '' OR j.role[1] = 'u' AND ins.next <> 'u'
                      OR j.role[1] = 'a' AND ins.next = 'u')
                 THEN {{'next': j.role[1], 'c': CASE j.fault WHEN 'truncated' THEN 3 ELSE 0 END, 'l': 'K',
                        'o': [j.role || ':' || j.text]}} END,
            CASE WHEN j.fault IN ('', 'truncated')
                 THEN {{'next': CASE ins.next WHEN 'u' THEN 'a' ELSE 'u' END,
                        'c': 3 + CASE j.fault WHEN 'truncated' THEN 3 ELSE 0 END, 'l': 'R',
                        'o': [CASE ins.next WHEN 'u' THEN 'assistant:' ELSE 'user:' END || j.text]}} END]) AS e) x
        WHERE e IS NOT NULL) GROUP BY conv_id, i, state
), ended AS (
    SELECT p.conv_id, min({{'cost': p.best.cost + ins.c, 'audit': p.best.audit || ins.l, 'out': list_concat(p.best.out, ins.o)}}) AS best
    FROM path p JOIN counted ON counted.conv_id IS NOT DISTINCT FROM p.conv_id AND counted.n = p.i
    JOIN {_INSERTS} ON ins.state = p.state WHERE ins.next IN ('', 'a') GROUP BY p.conv_id
)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit,
       sha256(coalesce(array_to_string(best.out, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM a.conv_id
"""

ORACLE |= {"op11_resample": RESAMPLING, "op12_chat": CHATS, "op13_repair": REPAIR}
