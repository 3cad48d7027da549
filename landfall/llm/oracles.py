"""DuckDB SQL for the registered queries that SQL can express."""

from landfall.llm.credentials import ACCESS, ASSIGN, BLANK, ENDPOINT, HEX
from landfall.llm.license_index import SLACK, phrase_spans, template_words
from landfall.llm.license_texts import TEMPLATES

#: Bare secrets in SQL, which has no lookarounds: a '=' before the run counts to it, so a secret right after ``NAME=`` is missed.
BARE = r"[A-Za-z0-9+/=]{40,}"

#: Where a document lies in its source's word stream decides what the schedule takes of it: the stream's first
#: ``floor(target)`` words, the stream being repeated.
OP6 = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, sum(size)::DOUBLE * 2 AS cap,
           [5.0, 2.0, 1.0][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT]::DOUBLE AS weight
    FROM sized GROUP BY source),
levels AS (
    SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5
               - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sources),
targets AS (
    SELECT source, source_size, least(cap, weight * coalesce(
        (SELECT arg_min(level, cap / weight) FROM levels WHERE level * weight < cap), 'inf'::DOUBLE)) AS target FROM levels),
placed AS (
    SELECT doc_id, source, size, sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), size, doc_id
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start FROM sized),
plan AS (
    SELECT source, source_size, ceil(source_size / 128)::BIGINT AS blocks, floor(target)::BIGINT % source_size AS rest,
           (floor(target)::BIGINT // source_size) * ceil(source_size / 128)::BIGINT
           + ceil((floor(target)::BIGINT % source_size) / 128)::BIGINT AS quota,
           sum(target) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING) / sum(target) OVER () AS high
    FROM targets WHERE target >= 1),
spans AS (SELECT *, coalesce(lag(high) OVER (ORDER BY source NULLS LAST), 0) AS low FROM plan),
points AS (
    SELECT slot, ((slot::HUGEINT * 5566755282872655) % 9007199254740992)::DOUBLE / 9007199254740992 AS point
    FROM (SELECT unnest(range(sum(quota)::BIGINT)) AS slot FROM plan)),
ranked AS (
    SELECT source, slot, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank
    FROM points JOIN spans ON low <= point AND point < high),
due AS (
    SELECT r.* FROM ranked r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source WHERE rank < quota),
reached AS (SELECT source, count(*) AS have FROM due GROUP BY source),
slots AS (
    SELECT * FROM due
    UNION ALL
    SELECT source, (SELECT sum(quota) FROM plan)::BIGINT + rank, rank
    FROM (SELECT p.source, unnest(range(coalesce(have, 0)::BIGINT, quota::BIGINT)) AS rank
          FROM plan p LEFT JOIN reached r ON r.source IS NOT DISTINCT FROM p.source)),
draws AS (
    SELECT s.source, slot, rank % blocks AS block,
           CASE WHEN rank = quota - 1 AND rest > 0 THEN rest - (rank % blocks) * 128
                ELSE least(128, source_size - (rank % blocks) * 128) END AS words
    FROM slots s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
pieces AS (
    SELECT doc_id, source, start, size, unnest(range((start // 128)::BIGINT, ((start + size - 1) // 128 + 1)::BIGINT)) AS block FROM placed WHERE size > 0),
firsts AS (
    SELECT doc_id, q.source, start, min(slot) AS first_slot
    FROM pieces q JOIN draws d ON q.source IS NOT DISTINCT FROM d.source AND q.block = d.block
    WHERE least(start + size - q.block * 128, words) > greatest(start - q.block * 128, 0) GROUP BY doc_id, q.source, start)
SELECT p.doc_id, p.size, source_size, target,
       (greatest(0, least(p.start + size, floor(target)::BIGINT) - least(p.start, floor(target)::BIGINT))
        + greatest(0, least(p.start + size, floor(target)::BIGINT - source_size) - p.start))::BIGINT AS taken,
       first_slot
FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
LEFT JOIN firsts f ON f.doc_id IS NOT DISTINCT FROM p.doc_id AND f.source IS NOT DISTINCT FROM p.source AND f.start = p.start AND p.size > 0
"""

_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP7 = rf"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
wins AS (
    SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS win
    FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
grams AS (
    SELECT id, i, l.n, array_to_string(w[i : i + l.n - 1], ' ') AS win
    FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM wins) k WHERE len(w) >= n) l),
hits AS (SELECT id, i, g.n, item FROM grams g JOIN wins s ON g.win = s.win AND g.n = s.n),
hit AS (SELECT id, count(DISTINCT spot) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS spot FROM hits) GROUP BY id),
named AS (SELECT id, list_sort(list(DISTINCT item)) AS items FROM hits GROUP BY id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (id) LEFT JOIN named USING (id)
"""

#: The template's length: marks of a turn, its role's marks, two blanks, and the escaped text.
_ESCAPED = r"length(regexp_replace({}, '([<\[])(\\*)(/?(?:s>|(?:INST|SYS|ROLE)\]))', '\1\\\2\3', 'g'))"

OP1 = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
spoken AS (
    SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS told,
           coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
           sum(9 + {_ESCAPED.format("text")} + CASE role WHEN 'assistant' THEN 0 WHEN 'user' THEN 13 WHEN 'system' THEN 11
               ELSE 15 + {_ESCAPED.format("role")} END)::BIGINT AS formatted_chars
    FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM spoken
"""

OP3 = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, '')))::BIGINT AS size FROM pages),
kept AS (SELECT *, CASE WHEN size >= 1000 THEN max(page_id) OVER (PARTITION BY payload) END AS keeper FROM payloads)
SELECT page_id, size AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN keeper IS NOT NULL AND page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM kept
"""



def _pieces(kind: int, pattern: str) -> str:
    quoted = pattern.replace("'", "''")
    return (rf"SELECT id, {kind} AS kind, string_split(regexp_replace(t, '{quoted}', chr(1) || '\0' || chr(1), 'g'), chr(1)) AS parts FROM docs")


_NEAR = "SELECT 1 FROM {} a WHERE a.id = c.id AND a.scope = c.scope AND abs(a.s - c.s) <= 400"
OP4 = rf"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, translate(coalesce(text, ''), chr(1), chr(2)) AS t FROM documents),
pieces AS (
    SELECT id, kind, unnest(parts) AS piece, generate_subscripts(parts, 1) AS turn
    FROM ({" UNION ALL ".join(_pieces(k, p) for k, p in enumerate((ASSIGN, ACCESS, HEX, BARE, ENDPOINT, BLANK)))})),
ends AS (SELECT *, sum(length(piece)) OVER (PARTITION BY id, kind ORDER BY turn) AS e FROM pieces),
spans AS (
    SELECT id, kind, e - length(piece) AS s, e FROM ends
    WHERE turn % 2 = 0 AND CASE kind WHEN 0 THEN length(regexp_extract(piece, '{ASSIGN.replace("'", "''")}', 2)) >= 12
        WHEN 3 THEN length(piece) = 40 AND regexp_matches(piece, '[A-Z]') AND regexp_matches(piece, '[a-z]') AND regexp_matches(piece, '[0-9]')
        ELSE true END),
scoped AS (
    SELECT *, count(*) FILTER (kind = 5) OVER (PARTITION BY id ORDER BY s, e, kind ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS scope
    FROM spans),
access AS (SELECT * FROM scoped WHERE kind = 1),
bare AS (SELECT * FROM scoped c WHERE kind = 3 AND EXISTS ({_NEAR.format("access")})),
secrets AS (SELECT * FROM bare UNION ALL SELECT * FROM scoped WHERE kind = 0),
ends_at AS (SELECT * FROM scoped c WHERE kind = 4 AND EXISTS ({_NEAR.format("access")}) AND EXISTS ({_NEAR.format("secrets")})),
found AS (
    SELECT id, kind, s, e, ['assign', 'access', 'hex', 'secret', 'endpoint'][kind + 1] || ':' || s || ':' || e AS span
    FROM (SELECT * FROM scoped WHERE kind < 3 UNION ALL SELECT * FROM bare UNION ALL SELECT * FROM ends_at))
SELECT any_value(doc_id) AS doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
       count(*) FILTER (kind = 2) AS n_hex, sha256(coalesce(string_agg(span, ',' ORDER BY s, kind) FILTER (kind < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY s, kind), '') AS spans
FROM docs LEFT JOIN found USING (id) GROUP BY id
"""

OP11 = rf"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, {_WORDS} AS w FROM documents),
held AS (SELECT id, doc_id, w, len(w)::BIGINT AS n FROM docs WHERE len(w) > 0),
size AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM held),
counts AS (SELECT id, term, count(*)::BIGINT AS tf FROM (SELECT id, unnest(w) AS term FROM held) GROUP BY id, term),
items AS (SELECT row_number() OVER () AS item, item_id, {_WORDS} AS w FROM benchmark),
wanted AS (SELECT DISTINCT item, item_id, unnest(w) AS term FROM items),
weights AS (
    SELECT term, floor(1000 * ln((2 * (SELECT docs FROM size) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
    FROM counts GROUP BY term),
scored AS (
    SELECT item, any_value(item_id) AS item_id, id, any_value(doc_id) AS doc_id, sum(weight * ((1000000000 * tf)
           // (1000 * tf + 8 * (10 + (90 * n * (SELECT docs FROM size)) // (SELECT words FROM size)))))::BIGINT AS score
    FROM wanted JOIN weights USING (term) JOIN counts USING (term) JOIN held USING (id) GROUP BY item, id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0)
SELECT item_id, place::INT AS rank, doc_id, score FROM ranked WHERE place <= 10
"""



def _quoted(words: list[bytes]) -> str:
    return "[" + ", ".join("'" + w.decode() + "'" for w in words) + "]"


_TEMPLATES = ", ".join(
    f"({n}, '{t.label}', {str(t.base).lower()}, {_quoted(template_words(t))})" for n, t in enumerate(TEMPLATES))
_PHRASES = ", ".join(f"({n}, {k}, {start}, {length})" for n, t in enumerate(TEMPLATES) for k, (start, length) in enumerate(phrase_spans(t)))

#: All phrases at all places, without an index: a phrase is where as many of its words as it has agree.
OP12 = rf"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, {_WORDS} AS w FROM documents),
templates(t, label, base, words) AS (VALUES {_TEMPLATES}),
phrases(t, k, o, n) AS (VALUES {_PHRASES}),
places AS (SELECT id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM docs),
spelled AS (SELECT t, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS q FROM templates),
size AS (SELECT count(*) FILTER (len(w) > 0) AS docs FROM docs),
weights AS (
    SELECT s.word, 1 + floor(1000 * ln((2 * (SELECT docs FROM size) + 2)::DOUBLE / (2 * count(DISTINCT p.id) + 1)::DOUBLE))::BIGINT AS weight
    FROM (SELECT DISTINCT word FROM spelled) s LEFT JOIN places p ON s.word = p.word GROUP BY s.word),
total AS (SELECT t, sum(weight) AS weight FROM spelled JOIN weights USING (word) GROUP BY t),
hits AS (
    SELECT p.id, f.t, f.k, p.pos - (s.q - f.o) AS place, p.pos - s.q AS shift
    FROM places p JOIN spelled s ON p.word = s.word JOIN phrases f ON f.t = s.t AND s.q >= f.o AND s.q < f.o + f.n
    GROUP BY p.id, f.t, f.k, place, shift HAVING count(*) = any_value(f.n)),
near AS (
    SELECT a.id, a.t, a.shift AS d, b.k, arg_min(b.shift, (abs(b.shift - a.shift), b.shift)) AS shift
    FROM hits a JOIN hits b ON a.id = b.id AND a.t = b.t WHERE a.k = 0 AND (b.k > 0 OR b.shift = a.shift)
    GROUP BY a.id, a.t, a.shift, b.k),
aligned AS (
    SELECT id, t, d FROM near JOIN phrases USING (t, k) GROUP BY id, t, d
    HAVING count(*) = (SELECT count(*) FROM phrases p WHERE p.t = near.t) AND max(abs(shift - d)) <= {SLACK}),
agreeing AS (
    SELECT DISTINCT a.id, a.t, a.d, s.q, s.word FROM aligned a JOIN near n ON a.id = n.id AND a.t = n.t AND a.d = n.d
    JOIN spelled s ON s.t = a.t JOIN places p ON p.id = a.id AND p.pos = s.q + n.shift AND p.word = s.word),
shares AS (
    SELECT id, t, sum(w.weight)::DOUBLE / any_value(x.weight)::DOUBLE AS share
    FROM agreeing JOIN weights w USING (word) JOIN total x USING (t) GROUP BY id, t, d),
named AS (SELECT id, max(share) AS score, list(DISTINCT label) AS labels FROM shares JOIN templates USING (t) GROUP BY id),
based AS (
    SELECT id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels
    FROM hits JOIN templates USING (t) WHERE base GROUP BY id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(n.labels, [])))), ','), '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM docs LEFT JOIN based b USING (id) LEFT JOIN named n USING (id)
"""

#: Unsigned checksum (CRC-32) of a short ASCII text, bit by bit.
_CRC = ("xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length({0}) + 1), lambda i: ascii({0}[i])::BIGINT)),"
        " lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, step: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295)")

OP13 = f"""
WITH turns AS (
    SELECT conv_id, turn, octet_length(encode(coalesce(text, '')))::BIGINT AS n,
           sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k
    FROM conversations WHERE conv_id IS NOT NULL),
lists AS (SELECT conv_id AS c, list({{'k': k, 'n': n}} ORDER BY turn NULLS FIRST, k[:30]) AS l FROM turns GROUP BY conv_id),
taken AS (SELECT c, l, c - c % 5 AS base, {_CRC.format("(c::VARCHAR)")} % 9 AS h FROM lists),
rebuilt AS (
    SELECT t.c, list_concat(coalesce(b.l[1:t.h], []), t.l[t.h + 1:]) AS l FROM taken t LEFT JOIN lists b ON b.c = t.base),
members AS (
    SELECT c, d, d = len(l) AS ends, md5(array_to_string(list_transform(l[1:d], lambda x: x.k), ',')) AS p, coalesce(l[d].n, 0) AS n
    FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM rebuilt)),
nodes AS (
    SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(n) AS saved,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
    FROM members GROUP BY d, p),
named AS (SELECT m.c, m.d, n.conv_id FROM members m JOIN nodes n USING (d, p)),
linked AS (SELECT n.*, u.conv_id AS parent FROM nodes n LEFT JOIN named u ON u.c = n.conv_id AND u.d = n.d - 1),
fans AS (SELECT parent, d - 1 AS d, count(*) AS n_children FROM linked WHERE d > 0 GROUP BY parent, d),
full_nodes AS (SELECT l.*, coalesce(f.n_children, 0) AS n_children FROM linked l LEFT JOIN fans f ON f.parent = l.conv_id AND f.d = l.d),
totals AS (
    SELECT a.conv_id, a.d, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
    FROM full_nodes y JOIN named a ON a.c = y.conv_id AND a.d <= y.d GROUP BY a.conv_id, a.d)
SELECT conv_id, d::BIGINT AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM full_nodes JOIN totals USING (conv_id, d)
"""

ORACLES = {"op4_credential_links": OP4, "op1_reply_trees": OP1, "op3_warc": OP3, "op6_low_discrepancy_mix": OP6, "op7_winnowing": OP7,
           "op11_reversed_search": OP11, "op12_license_index": OP12, "op13_prefix_trie": OP13}
