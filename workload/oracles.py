"""SQL counterparts of the registered queries, for DuckDB.

They are written independently of the Spark side: subtrees are found by exploding
pages into tokens and summing depths in a window, the merge with ``lag``.
"""

from __future__ import annotations

TOKENS = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<[^>]*>|[^<]+"
ENTITIES = (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))


# --- expressions ---------------------------------------------------------------


def path(url: str) -> str:
    whole = rf"regexp_extract({url}, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
    return f"regexp_replace({whole}, ';[^/]*$', '')"


def file_name(url: str) -> str:
    return f"regexp_extract({path(url)}, '([^/]*)$', 1)"


def stem(name: str) -> str:
    return rf"CASE WHEN regexp_matches({name}, '^.*[^.].*\.[^.]*$') THEN regexp_extract({name}, '^(.*[^.].*)\.[^.]*$', 1) ELSE {name} END"


def ext(url: str) -> str:
    return rf"lower(regexp_extract({file_name(url)}, '^.*[^.].*(\.[^.]*)$', 1))"


def normal(text: str) -> str:
    tight = rf"regexp_replace(regexp_replace(trim({text}), '\s*-\s*', '-', 'g'), '\s+', ' ', 'g')"
    return f"upper(replace({tight}, 'ß', 'ss'))"


def identifier(url: str) -> str:
    return normal(f"trim({stem(file_name(url))}, '_-. ')")


def kind(url: str) -> str:
    return f"CASE WHEN {ext(url)} = '.pdf' THEN 'pdf' WHEN {ext(url)} IN ('.doc', '.docx', '.rtf') THEN 'doc' ELSE 'html' END"


def stored_ext(url: str, doc_type: str) -> str:
    return (f"CASE WHEN {doc_type} = 'html' THEN '.html' WHEN {ext(url)} <> '' THEN {ext(url)}"
            f" WHEN {doc_type} = 'pdf' THEN '.pdf' ELSE '.bin' END")


def mime(doc_type: str) -> str:
    return (f"CASE {doc_type} WHEN 'html' THEN 'text/html; charset=utf-8' WHEN 'pdf' THEN 'application/pdf'"
            f" WHEN 'doc' THEN 'application/msword' ELSE 'application/octet-stream' END")


def canonical(doc_type: str, text: str) -> str:
    return (rf"CASE WHEN {doc_type} = 'html' THEN regexp_replace({text}, '(?is)<!--\s*Elapsed time:.*?-->', '', 'g')"
            f" ELSE {text} END")


def size(text: str) -> str:
    return f"CAST(octet_length(encode({text})) AS BIGINT)"


def language(url: str) -> str:
    return f"regexp_extract({url}, '^[a-z]+://[^/?#]*/([a-z]+)/', 1)"


def week(day: str) -> str:
    return f"strftime({day}, '%G-W%V')"


def decoded(text: str) -> str:
    for entity, char in ENTITIES:
        text = f"replace({text}, '{entity}', '{char}')"
    return text


# --- common table expressions ------------------------------------------------------

_LANG = language("url")
_FILE_URL = (
    f"CASE {_LANG} WHEN 'de' THEN regexp_replace(url, '/de/([0-9]+)[^#?]*', '/de/\\1.pdf')"
    f" WHEN 'es' THEN regexp_replace(url, '/es/([0-9]+)[^#?]*', '/es/\\1.docx') ELSE url END")

DOCS = f"""
urls AS (
  SELECT page_id AS fetch_seq, url AS page_url, {_FILE_URL} AS document_url, {_LANG} AS body_key,
         replace(html, '<!-- ad ', '<!-- Elapsed time: ') AS html
  FROM pages),
named AS (
  SELECT *, {identifier("document_url")} AS identifier, {kind("document_url")} AS document_type,
         {stored_ext("document_url", kind("document_url"))} AS ext
  FROM urls),
docs AS (
  SELECT *, CAST(DATE '2022-01-01' + TRY_CAST(identifier AS INTEGER) AS DATE) AS published_date,
         coalesce(strftime(DATE '2022-01-01' + TRY_CAST(identifier AS INTEGER), '%Y-%m'), 'undated') AS partition_date
  FROM named)"""

RUNS = DOCS + f""",
first_text AS (
  SELECT *, {canonical("document_type", "html")} AS body FROM docs WHERE page_url LIKE 'https:%'),
first_hash AS (SELECT *, sha256(body) AS file_hash, {size("body")} AS content_length FROM first_text),
known AS (SELECT identifier, arg_max(file_hash, fetch_seq) AS file_hash FROM first_hash GROUP BY identifier),
first_steps AS (
  SELECT *, lag(file_hash) OVER (PARTITION BY identifier ORDER BY fetch_seq) AS previous FROM first_hash),
first_named AS (
  SELECT *, CASE WHEN previous IS NULL THEN 'new' WHEN previous = file_hash THEN 'unchanged' ELSE 'changed' END AS outcome,
         body_key || '/' || partition_date || '/' || identifier
         || CASE WHEN previous IS NULL THEN '' ELSE '__' || substr(file_hash, 1, 12) END || ext AS storage_path
  FROM first_steps),
second_raw AS (
  SELECT *,
         CASE WHEN page_url LIKE '%//m.%' AND document_type = 'html' THEN '<!-- Elapsed time: ' || identifier || ' -->'
              WHEN page_url LIKE '%page=2%' THEN html || '<p>revised</p>' ELSE html END AS raw,
         CASE WHEN page_url LIKE '%spam-farm%' THEN 'HTTP 404' WHEN page_url LIKE '%cheap-pills%' THEN 'timed out' END AS fetch_failure
  FROM docs),
second_text AS (
  SELECT *, CASE WHEN fetch_failure IS NULL THEN {canonical("document_type", "raw")} END AS body FROM second_raw),
second_hash AS (
  SELECT *, CASE WHEN body <> '' THEN sha256(body) END AS file_hash,
         CASE WHEN fetch_failure IS NULL THEN {size("body")} END AS content_length,
         coalesce(fetch_failure, CASE WHEN body = '' THEN 'empty document body' END) AS reason
  FROM second_text),
second_ok AS (
  SELECT s.fetch_seq, coalesce(lag(s.file_hash) OVER (PARTITION BY s.identifier ORDER BY s.fetch_seq), k.file_hash) AS previous
  FROM second_hash s LEFT JOIN known k USING (identifier) WHERE s.reason IS NULL),
second_named AS (
  SELECT s.*, o.previous,
         CASE WHEN s.reason IS NOT NULL THEN 'failed' WHEN o.previous IS NULL THEN 'new'
              WHEN o.previous = s.file_hash THEN 'unchanged' ELSE 'changed' END AS outcome,
         s.body_key || '/' || s.partition_date || '/' || s.identifier
         || CASE WHEN o.previous IS NULL THEN '' ELSE '__' || substr(s.file_hash, 1, 12) END || s.ext AS storage_path
  FROM second_hash s LEFT JOIN second_ok o USING (fetch_seq))"""

# The same where no French page can be stored.
PERSISTED = RUNS.replace(" WHERE page_url LIKE 'https:%'", " WHERE page_url LIKE 'https:%' AND body_key <> 'fr'").replace(
    "THEN 'empty document body' END)", "THEN 'empty document body' END, CASE WHEN body_key = 'fr' THEN 'persist' END)")

# The same with a first run of all pages.
WHOLE_RUNS = RUNS.replace(" WHERE page_url LIKE 'https:%'", "")

_LISTING_HREF = f"""CASE {_LANG} WHEN 'de' THEN NULL ELSE word END"""
LISTING = f"""
listed AS (
  SELECT page_id AS page_seq, url, {_LANG} AS body_key, html,
         CAST(regexp_extract(url, '/([0-9]+)', 1) AS INTEGER) AS number,
         CASE WHEN url LIKE '%cheap-pills%' THEN 'timed out' END AS error, url LIKE '%spam-farm%' AS refused
  FROM pages),
entries AS (
  SELECT page_seq, url, body_key, number, CAST(pos - 1 AS INTEGER) AS row_pos, words[pos] AS word, texts[pos] AS text
  FROM (SELECT *, regexp_extract_all(html, '<li><a href="([^"]*)">', 1) AS words,
               regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)', 1) AS texts
        FROM listed WHERE error IS NULL AND NOT refused), unnest(range(1, len(words) + 1)) AS u(pos)),
rows AS (
  SELECT *, row_number() OVER (ORDER BY page_seq, row_pos) - 1 AS fetch_seq, CASE WHEN body_key <> 'de' THEN word END AS link,
         CAST(DATE '2024-01-01' + number AS DATE) AS published_date,
         regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || word AS document_url
  FROM entries)"""
LISTING_FAILURES = """
SELECT body_key, '2024-01' AS partition_date, url,
       'listing: ' || CASE WHEN refused THEN 'HTTP 503' ELSE error END AS reason,
       CAST(CASE WHEN refused THEN 503 END AS INTEGER) AS status
FROM listed WHERE refused OR error IS NOT NULL
UNION ALL
SELECT body_key, '2024-01', url, 'unparsable listing row (no document link)', CAST(NULL AS INTEGER)
FROM rows WHERE link IS NULL"""


def tokens(source: str, prefix: str) -> str:
    """CTEs exploding ``source(id, html)`` into tokens with their element names."""
    return rf"""
{prefix}_lists AS (SELECT id, regexp_extract_all(html, '{TOKENS}') AS ts FROM {source}),
{prefix}_tokens AS (
  SELECT id, pos, ts[pos] AS t, lower(regexp_extract(ts[pos], '^</?([a-zA-Z][a-zA-Z0-9]*)', 1)) AS name,
         ts[pos] LIKE '</%' AS closing
  FROM {prefix}_lists, unnest(range(1, len(ts) + 1)) AS u(pos))"""


def dropped(source: str, prefix: str) -> str:
    """CTEs ending in ``{prefix}(id, html)``: source without boilerplate elements."""
    names = "('nav', 'header', 'footer', 'form', 'button', 'noscript')"
    return tokens(source, prefix) + f""",
{prefix}_depth AS (
  SELECT *, sum(CASE WHEN name NOT IN {names} THEN 0 WHEN closing THEN -1 ELSE 1 END)
              OVER (PARTITION BY id ORDER BY pos) AS depth
  FROM {prefix}_tokens WHERE name NOT IN ('script', 'style')),
{prefix} AS (
  SELECT s.id, coalesce(string_agg(d.t, '' ORDER BY d.pos), '') AS html
  FROM {source} s LEFT JOIN {prefix}_depth d ON d.id = s.id AND d.depth = 0 AND NOT (d.name IN {names} AND d.closing)
  GROUP BY s.id)"""


def inside(source: str, prefix: str, opening: str) -> str:
    """CTEs ending in ``{prefix}(id, html)``: inside of the first div that is ``opening``."""
    return tokens(source, prefix) + f""",
{prefix}_opened AS (SELECT id, min(pos) AS start FROM {prefix}_tokens WHERE t LIKE '{opening}' GROUP BY id),
{prefix}_depth AS (
  SELECT t.*, sum(CASE WHEN name <> 'div' THEN 0 WHEN closing THEN -1 ELSE 1 END)
                OVER (PARTITION BY t.id ORDER BY pos) AS depth
  FROM {prefix}_tokens t JOIN {prefix}_opened o ON o.id = t.id AND t.pos > o.start),
{prefix}_end AS (SELECT id, min(pos) AS stop FROM {prefix}_depth WHERE depth < 0 GROUP BY id),
{prefix} AS (
  SELECT o.id, coalesce(string_agg(d.t, '' ORDER BY d.pos), '') AS html
  FROM {prefix}_opened o LEFT JOIN {prefix}_end e ON e.id = o.id
  LEFT JOIN {prefix}_depth d ON d.id = o.id AND (e.stop IS NULL OR d.pos < e.stop)
  GROUP BY o.id)"""


_CONTAINER = ("replace(replace(html, '<article>', '<div class=\"main content\"><div class=\"inner\">'),"
              " '</article>', '</div></div>')")
_BODY = "regexp_replace(regexp_replace(html, '(?is)^.*?<body>', ''), '(?is)</body>.*$', '')"
_NUMBER = "regexp_extract(url, '/([0-9]+)[^/]*/?$', 1)"
_ENDED = (f"CASE WHEN url LIKE '%?%' THEN replace({_CONTAINER}, '</h1>', '</h1></div></div><div><div>')"
          f" ELSE {_CONTAINER} END")
_DOWNLOAD = (f"replace({_ENDED}, '<footer>', '<a class=\"download\" href=\"/files/' || {_NUMBER}"
             " || '.pdf?v=1\">file</a><footer>')")
_SHAPE = "SELECT id AS page_id, sha256(html) AS text_hash, CAST(length(html) AS BIGINT) AS chars FROM"

STUBS = "shown AS (SELECT page_id AS id, url, " + _DOWNLOAD + " AS html FROM pages)," + inside(
    "shown", "part", '<div class="main content">') + r""",
texts AS (
  SELECT id, length(trim(""" + decoded(r"regexp_replace(html, '(?:<[^>]*>)+', ' ', 'g')") + r""")) AS chars FROM part),
links AS (
  SELECT s.id, s.url, s.html, CAST(t.chars AS BIGINT) AS chars,
         CASE WHEN t.chars < 200 THEN '/files/' || """ + _NUMBER.replace("url", "s.url") + r""" || '.pdf?v=1' END AS link
  FROM shown s JOIN texts t USING (id))"""

CURATION = WHOLE_RUNS + f""",
records AS (
  SELECT * FROM first_named WHERE outcome IN ('new', 'changed')
  QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY fetch_seq DESC) = 1),
chosen AS (SELECT * FROM records WHERE published_date >= DATE '2022-01-10' AND published_date < DATE '2024-06-01'),
bodies AS (SELECT fetch_seq AS id, {_BODY.replace("html", "body")} AS html FROM records WHERE document_type = 'html'),
{dropped("bodies", "clean")},
cleaned AS (
  SELECT r.fetch_seq, r.identifier,
         CASE WHEN r.document_type <> 'html' THEN r.body ELSE
           '<!DOCTYPE html>' || chr(10) || '<html lang="en">' || chr(10) || '<head>' || chr(10) || '<meta charset="utf-8">'
           || chr(10) || '<title>' || r.identifier || '</title>' || chr(10) || '</head>' || chr(10) || '<body>' || chr(10)
           || '<h1>' || r.identifier || '</h1>' || chr(10) || trim(c.html) || chr(10) || '</body>' || chr(10) || '</html>'
           || chr(10) END AS output
  FROM records r LEFT JOIN clean c ON c.id = r.fetch_seq),
curated AS (
  SELECT r.*, c.output, sha256(c.output) AS curated_hash,
         CASE WHEN r.page_url LIKE '%//blog.%' THEN 'unchanged' WHEN r.document_type = 'html' THEN 'transformed_html'
              ELSE 'copied_asis' END AS curated_outcome
  FROM chosen r JOIN cleaned c USING (fetch_seq) WHERE r.body_key <> 'fr')"""

UNITS = RUNS + "," + LISTING + f""",
failures AS (
  SELECT body_key, partition_date, document_url AS url, reason,
         CAST(CASE WHEN fetch_failure = 'HTTP 404' THEN 404 END AS INTEGER) AS status
  FROM second_named WHERE outcome = 'failed'
  UNION ALL {LISTING_FAILURES}),
found AS (
  SELECT body_key, partition_date, CAST(sum(CASE WHEN body_key = 'fr' THEN 2 ELSE 1 END) AS BIGINT) AS found
  FROM docs GROUP BY ALL),
marks AS (
  SELECT body_key, partition_date, count(*) FILTER (outcome = 'new') AS new, count(*) FILTER (outcome = 'changed') AS changed,
         count(*) FILTER (outcome = 'unchanged') AS unchanged FROM second_named WHERE outcome <> 'failed' GROUP BY ALL),
failed AS (SELECT body_key, partition_date, count(*) AS failed FROM failures GROUP BY ALL),
counted AS (
  SELECT body_key, partition_date, coalesce(found, 0) AS found, coalesce(new, 0) AS new, coalesce(changed, 0) AS changed,
         coalesce(unchanged, 0) AS unchanged, CAST(0 AS BIGINT) AS skipped, coalesce(failed, 0) AS failed
  FROM found FULL JOIN marks USING (body_key, partition_date) FULL JOIN failed USING (body_key, partition_date)),
units AS (
  SELECT body_key || '/' || partition_date AS unit, body_key, partition_date, found,
         new + changed + unchanged + skipped AS scraped, new, changed, unchanged, skipped, failed,
         greatest(found - (new + changed + unchanged + skipped) - failed, 0) AS missing
  FROM counted)"""

LINKED = LISTING + f""",
requested AS (
  SELECT document_url, min(fetch_seq) AS fetch_seq, arg_min(body_key, fetch_seq) AS body_key,
         arg_min(published_date, fetch_seq) AS published_date,
         arg_min(trim(CASE WHEN body_key = 'fr' OR text = '' THEN 'R-' || page_seq ELSE text END), fetch_seq) AS title
  FROM rows WHERE link IS NOT NULL GROUP BY document_url),
identified AS (
  SELECT *, {identifier("document_url")} AS identifier, document_url LIKE '%,%' AS gone,
         '<html><nav>menu</nav><div class=''content''> <p>' || document_url || '</p></div></html>' AS body FROM requested),
landed AS (
  SELECT i.*, CASE WHEN fetch_seq > first_ok THEN 'skipped' WHEN gone THEN 'failed' ELSE 'new' END AS outcome
  FROM identified i LEFT JOIN (SELECT identifier, min(fetch_seq) AS first_ok FROM identified WHERE NOT gone GROUP BY identifier)
  USING (identifier)),
link_failures AS (
  SELECT body_key FROM landed WHERE outcome = 'failed' UNION ALL SELECT body_key FROM ({LISTING_FAILURES})),
page_rows AS (SELECT page_seq, count(*) AS n FROM rows GROUP BY page_seq),
announced AS (
  SELECT body_key, sum(CASE WHEN url LIKE '%?%' THEN length(html) ELSE coalesce(n, 0) END) AS found
  FROM listed LEFT JOIN page_rows USING (page_seq) WHERE NOT refused AND error IS NULL GROUP BY body_key)"""

#: Documents of the stream that fail: those that are gone and those that come late.
_GONE_OR_LATE = "(document_url LIKE '%,%' OR regexp_extract(document_url, '[^/]*$') LIKE '%en%') AS gone"
_RUN_REPORT = """
marked AS (
  SELECT body_key, count(*) FILTER (outcome = 'new') AS new, count(*) FILTER (outcome = 'skipped') AS skipped FROM landed
  GROUP BY body_key),
lost AS (SELECT body_key, count(*) AS failed FROM link_failures GROUP BY body_key),
joined AS (
  SELECT body_key, CAST(coalesce(found, 0) AS BIGINT) AS found, coalesce(new, 0) AS new, coalesce(skipped, 0) AS skipped,
         coalesce(failed, 0) AS failed
  FROM announced FULL JOIN marked USING (body_key) FULL JOIN lost USING (body_key))
SELECT body_key || '/2024-01' AS unit, body_key, '2024-01' AS partition_date, found, new + skipped AS scraped, new,
       CAST(0 AS BIGINT) AS changed, CAST(0 AS BIGINT) AS unchanged, skipped, failed,
       greatest(found - new - skipped - failed, 0) AS missing FROM joined"""

_WEEKLY = f"""
totals AS (
  SELECT c_mktsegment AS body_key, {week("o_orderdate")} AS partition_date, count(*) AS found
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
fanout AS (
  SELECT t.*, CAST(u.page AS BIGINT) AS page
  FROM totals t, unnest(range(2, CAST(ceil(found / 10.0) AS BIGINT) + 1)) AS u(page))"""


def windows(spans: str, size: str) -> str:
    """Windows of ``spans(.., s, e)`` with ``e`` inclusive, for a size fixed per row."""
    unit = {"monthly": "month", "weekly": "week", "yearly": "year"}[size]
    text = {"monthly": "%Y-%m", "weekly": "%G-W%V", "yearly": "%Y"}[size]
    return f"""
SELECT x.*, strftime(a, '{text}') AS label, greatest(CAST(a AS DATE), s) AS window_start,
       least(CAST(a + INTERVAL 1 {unit} - INTERVAL 1 day AS DATE), e) AS window_end
FROM {spans} x, unnest(generate_series(CAST(date_trunc('{unit}', s) AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 {unit})) AS u(a)"""


_SPANS = """
spans AS (
  SELECT c_nationkey, o_orderpriority, CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL)"""
_BASE_PATH = path("url")
_ORIGIN = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"
_DIRECTORY = f"regexp_replace({_BASE_PATH}, '[^/]*$', '')"
_ODD = r"regexp_replace(url, '/([0-9]+)(\.html|/)?', ' /ir  -  sc - _\1_.tar.PDF;v=\1')"

#: The last change of content of each user.
LAST_EVENTS = """
WITH steps AS (
  SELECT *, 'U' || user_id AS identifier, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events)
SELECT identifier, props AS description, CAST(ts AS DATE) AS published_date,
       'events/' || strftime(ts, '%Y-%m') || '/' || identifier
       || CASE WHEN previous IS NULL THEN '' ELSE '__' || substr(sha256(event_type), 1, 12) END || '.html' AS storage_path,
       sha256(event_type) AS file_hash, CAST(octet_length(encode(event_type)) AS BIGINT) AS content_length, event_id AS fetch_seq
FROM steps WHERE previous IS NULL OR previous <> event_type
QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY ts DESC, event_id DESC) = 1"""

def kept(codec: str) -> str:
    """Markup with ``?`` for what a single-byte charset cannot write."""
    has = bytes(range(0x80, 0x100)).decode(codec, "ignore")
    return rf"regexp_replace(coalesce(html, ''), '[^\x00-\x7F{has}]', '?', 'g')"


ORACLES = {
    "declared_charsets": f"""
WITH texts AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN '<meta charset="windows-1251">' || {kept("cp1251")}
  WHEN 1 THEN '<?xml version="1.0" encoding="ISO-8859-2"?>' || {kept("iso8859-2")}
  WHEN 4 THEN {kept("cp1252")} ELSE coalesce(html, '') END AS text FROM pages)
SELECT page_id, sha256(text) AS text_sha256, length(text)::BIGINT AS chars FROM texts""",
    "escaped_titles": """
WITH titles AS (SELECT page_id, replace(replace(replace('A & B <' || url || '> ' || html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS title FROM pages)
SELECT page_id, sha256('<!DOCTYPE html>' || chr(10) || '<html lang="en">' || chr(10) || '<head>' || chr(10) || '<meta charset="utf-8">'
  || chr(10) || '<title>' || title || '</title>' || chr(10) || '</head>' || chr(10) || '<body>' || chr(10) || '<h1>' || title || '</h1>'
  || chr(10) || 'x' || chr(10) || '</body>' || chr(10) || '</html>' || chr(10)) AS page_sha256 FROM titles""",
    "partition_calendar": f"""WITH {_SPANS}
SELECT c_nationkey, o_orderpriority, label, window_start, window_end FROM (
  {windows("(SELECT * FROM spans WHERE o_orderpriority LIKE '1%')", "monthly")}
  UNION ALL {windows("(SELECT * FROM spans WHERE o_orderpriority LIKE '2%')", "weekly")}
  UNION ALL {windows("(SELECT * FROM spans WHERE o_orderpriority NOT LIKE '1%' AND o_orderpriority NOT LIKE '2%')", "yearly")})""",
    "assign_partition": f"""
SELECT strftime(o_orderdate, '%Y-%m') AS month, {week("o_orderdate")} AS week, strftime(o_orderdate, '%Y') AS year,
       CAST(date_trunc('week', o_orderdate) AS DATE) AS monday, count(*) AS orders
FROM orders GROUP BY ALL""",
    "source_lookup": """
SELECT c_custkey AS pos, 'nation-' || c_nationkey AS key, n_nationkey AS site_id, n_name AS display_name
FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "work_frontier": f"""
WITH spans AS (SELECT s_suppkey, s_name, (SELECT CAST(min(o_orderdate) AS DATE) FROM orders) AS s,
                      (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) AS e FROM supplier)
SELECT s_suppkey, s_name, label, window_start, window_end FROM ({windows("spans", "monthly")})""",
    "page_fanout": f"WITH {_WEEKLY} SELECT * FROM fanout",
    "listing_gaps": f"""WITH {_WEEKLY},
captured AS (
  SELECT DISTINCT c_mktsegment AS body_key, {week("l_shipdate")} AS partition_date, l_linenumber AS page
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey)
SELECT body_key, partition_date, page FROM fanout ANTI JOIN captured USING (body_key, partition_date, page)""",
    "capped_batch": f"""WITH {RUNS}
SELECT fetch_seq, identifier, file_hash FROM second_hash ORDER BY fetch_seq LIMIT 50""",
    "result_count": f"""WITH {LISTING},
counted AS (SELECT page_seq, count(*) AS n FROM rows GROUP BY page_seq)
SELECT page_seq, CASE WHEN url LIKE '%?%' THEN CAST(length(html) AS BIGINT) END AS announced,
       CASE WHEN url LIKE '%?%' THEN CAST(length(html) AS BIGINT) ELSE coalesce(n, 0) END AS found
FROM listed LEFT JOIN counted USING (page_seq) WHERE NOT refused AND error IS NULL""",
    "listing_rows": f"""WITH {LISTING}
SELECT fetch_seq, row_pos, link, 'R-' || page_seq AS reference, 'From "' || body_key || '"' AS description_text,
       published_date, url AS listing_url FROM rows""",
    "listing_records": f"""WITH {LISTING}
SELECT fetch_seq, {identifier("document_url")} AS identifier,
       trim(CASE WHEN body_key = 'fr' OR text = '' THEN 'R-' || page_seq ELSE text END) AS title,
       'From "' || body_key || '"' AS description, published_date, body_key, '2024-01' AS partition_date, document_url,
       {kind("document_url")} AS document_type
FROM rows WHERE link IS NOT NULL""",
    "site_date": """
SELECT o_orderkey, date_text, CASE WHEN regexp_matches(trim(date_text, ' ' || chr(10)), '^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$')
         THEN CAST(try_strptime(trim(date_text, ' ' || chr(10)), '%d/%m/%Y') AS DATE) END AS published_date
FROM (SELECT o_orderkey, CASE left(o_orderpriority, 1)
        WHEN '1' THEN strftime(o_orderdate, '%d-%m-%Y')
        WHEN '2' THEN '  ' || day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate) || chr(10)
        WHEN '3' THEN '31/' || strftime(o_orderdate, '%m/%Y')
        WHEN '4' THEN strftime(o_orderdate, '%d/%m/%y')
        ELSE strftime(o_orderdate, '%d/%m/%Y') END AS date_text FROM orders)""",
    "url_parts": f"""
WITH hrefs AS (
  SELECT page_id, url, CAST(pos - 1 AS INTEGER) AS pos, hs[pos] AS href, substr(hs[pos], 2) AS word
  FROM (SELECT *, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hs FROM pages), unnest(range(1, len(hs) + 1)) AS u(pos))
SELECT page_id, pos, {_ORIGIN} || href AS from_root, {_ORIGIN} || {_DIRECTORY} || word AS relative,
       {_ORIGIN} || regexp_replace({_DIRECTORY}, '[^/]+/$', '') || word AS parent,
       {_ORIGIN} || {_BASE_PATH} || '?q=' || word AS query_only,
       regexp_extract(url, '^([a-z]+:)', 1) || '//other.example' || href AS other_host,
       regexp_extract(url, '//([^/?#]*)', 1) AS host FROM hrefs""",
    "url_identifier": f"""
SELECT page_id, {identifier("url")} AS identifier, {identifier(_ODD)} AS odd_identifier,
       {normal("regexp_extract(html, '<title>([^<]*)', 1)")} AS title_identifier FROM pages""",
    "doc_type": f"""WITH {DOCS}
SELECT fetch_seq, document_type, ext, {stored_ext("page_url", "document_type")} AS fallback_ext,
       {mime("document_type")} AS content_type FROM docs""",
    "canonical_hash": f"""WITH {DOCS},
bodies AS (SELECT fetch_seq, {canonical("document_type", "html")} AS body FROM docs)
SELECT fetch_seq, sha256(body) AS file_hash, substr(sha256(body), 1, 12) AS version, {size("body")} AS content_length FROM bodies""",
    "strip_boilerplate": f"""
WITH source AS (SELECT page_id AS id, html FROM pages), {dropped("source", "kept")} {_SHAPE} kept""",
    "subtree_extract": f"""
WITH source AS (SELECT page_id AS id, {_CONTAINER} AS html FROM pages),
{inside("source", "part", '<div class="main content">')} {_SHAPE} part""",
    "clean_fallback": f"""
WITH source AS (
  SELECT page_id AS id, replace({_BODY}, '<div class="ad">', '<div class="wide social-banner"><div>nested</div>') AS html
  FROM pages),
{tokens("source", "seen")},
seen_opened AS (SELECT id, min(pos) AS start FROM seen_tokens WHERE t LIKE '%social-banner%' GROUP BY id),
seen_depth AS (
  SELECT t.id, t.pos, sum(CASE WHEN name <> 'div' THEN 0 WHEN closing THEN -1 ELSE 1 END) OVER (PARTITION BY t.id ORDER BY pos) AS depth
  FROM seen_tokens t JOIN seen_opened o ON o.id = t.id AND t.pos >= o.start),
seen_end AS (SELECT id, min(pos) AS stop FROM seen_depth WHERE depth = 0 GROUP BY id),
without AS (
  SELECT t.id, string_agg(t.t, '' ORDER BY t.pos) AS html
  FROM seen_tokens t LEFT JOIN seen_opened o ON o.id = t.id LEFT JOIN seen_end e ON e.id = t.id
  WHERE o.start IS NULL OR t.pos < o.start OR t.pos > e.stop GROUP BY t.id),
{dropped("without", "kept")}, trimmed AS (SELECT id, trim(html) AS html FROM kept) {_SHAPE} trimmed""",
    "stub_links": f"WITH {STUBS} SELECT id AS page_id, chars, link FROM links",
    "stub_resolve": f"""WITH {STUBS},
asked AS (
  SELECT * FROM links QUALIFY row_number() OVER (PARTITION BY regexp_replace(url, '#.*$', '') ORDER BY id) = 1),
stub AS (
  SELECT id, url, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || link AS target,
         row_number() OVER (PARTITION BY regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || link ORDER BY id) AS turn
  FROM asked WHERE link IS NOT NULL),
file AS (
  SELECT regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/files/' || {_NUMBER} || '.pdf?v=1' AS target,
         min(page_id + 1000000000) AS payload_seq, arg_min(url, page_id) AS url
  FROM pages WHERE url LIKE '%/en/%' GROUP BY 1)
SELECT id AS fetch_seq, url AS source_url, url AS document_url, 'html' AS document_type, id AS payload_seq,
       sha256(html) AS file_hash, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS INTEGER) AS status
FROM asked WHERE link IS NULL
UNION ALL
SELECT s.id, s.url, s.target, 'pdf', f.payload_seq, CASE WHEN f.url NOT LIKE '%www.%' THEN sha256('%PDF ' || f.url) END,
       CASE WHEN f.url IS NULL THEN 'document not captured' WHEN f.url LIKE '%www.%' THEN 'HTTP 410' END,
       CASE WHEN f.url LIKE '%www.%' THEN 410 END
FROM stub s LEFT JOIN file f USING (target) WHERE s.turn = 1""",
    "sequence_outcome": """
WITH steps AS (
  SELECT event_id AS fetch_seq, CAST(user_id AS VARCHAR) AS identifier, sha256(event_type) AS file_hash,
         lag(sha256(event_type)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_hash FROM events)
SELECT fetch_seq, identifier, previous_hash,
       CASE WHEN previous_hash IS NULL THEN 'new' WHEN previous_hash = file_hash THEN 'unchanged' ELSE 'changed' END AS outcome
FROM steps""",
    "merge_outcome": f"WITH {RUNS} SELECT fetch_seq, identifier, file_hash, content_length, outcome FROM second_named",
    "skip_known": f"""WITH {RUNS},
firsts AS (SELECT identifier, min(fetch_seq) AS first_ok FROM second_hash WHERE reason IS NULL GROUP BY identifier)
SELECT s.fetch_seq, s.identifier,
       CASE WHEN k.identifier IS NOT NULL OR s.fetch_seq > f.first_ok THEN 'skipped' WHEN s.reason IS NOT NULL THEN 'failed'
            ELSE 'new' END AS outcome
FROM second_hash s LEFT JOIN known k USING (identifier) LEFT JOIN firsts f USING (identifier)""",
    "landing_key": f"""WITH {RUNS}
SELECT fetch_seq, outcome, storage_path FROM second_named WHERE outcome IN ('new', 'changed')""",
    "append_objects": f"""WITH {RUNS}
SELECT storage_path, {mime("document_type")} AS content_type, partition_date, file_hash AS object_hash, content_length AS bytes
FROM second_named
WHERE outcome IN ('new', 'changed')
  AND storage_path NOT IN (SELECT storage_path FROM first_named WHERE outcome IN ('new', 'changed'))
QUALIFY row_number() OVER (PARTITION BY storage_path ORDER BY fetch_seq) = 1""",
    "merge_current": f"""WITH {RUNS},
log AS (
  SELECT 'r1' AS last_run_id, 1 AS run_seq, fetch_seq, identifier, page_url, document_url, body_key, partition_date, published_date,
         document_type, storage_path, file_hash, content_length FROM first_named WHERE outcome <> 'unchanged'
  UNION ALL
  SELECT 'r2', 2, fetch_seq, identifier, page_url, document_url, body_key, partition_date, published_date,
         document_type, storage_path, file_hash, content_length FROM second_named WHERE outcome IN ('new', 'changed'))
SELECT identifier, 'Page ' || identifier AS title, page_url AS description, published_date, body_key,
       upper(body_key) AS body_name, ascii(body_key) AS body_id, partition_date, page_url AS source_url, document_url,
       document_type, storage_path, file_hash, content_length, last_run_id, fetch_seq, CAST(run_seq AS BIGINT) AS run_seq
FROM log QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY run_seq DESC, fetch_seq DESC) = 1""",
    "hash_mismatch": f"""WITH {WHOLE_RUNS}
SELECT r.identifier, r.storage_path, r.file_hash, sha256(s.body) AS object_hash
FROM first_named r JOIN first_named o ON o.storage_path = r.storage_path AND o.outcome <> 'unchanged'
JOIN second_text s ON s.fetch_seq = o.fetch_seq
WHERE r.outcome <> 'unchanged' AND s.body IS NOT NULL AND sha256(s.body) <> r.file_hash""",
    "url_once": f"""WITH {LISTING}
SELECT min(fetch_seq) AS fetch_seq, document_url FROM rows WHERE link IS NOT NULL GROUP BY document_url""",
    "stream_merge": LAST_EVENTS,
    "snapshot_merge": LAST_EVENTS,
    "stream_keyed": LAST_EVENTS,
    "ingest_run": f"WITH {LINKED},{_RUN_REPORT}",
    "stream_crawls": f"""WITH {LINKED.replace("document_url LIKE '%,%' AS gone", _GONE_OR_LATE)},{_RUN_REPORT}""",
    "ingest_and_curate": f"""WITH {LINKED},
pages_out AS (
  SELECT *, '<!DOCTYPE html>' || chr(10) || '<html lang="en">' || chr(10) || '<head>' || chr(10) || '<meta charset="utf-8">'
         || chr(10) || '<title>' || identifier || '</title>' || chr(10) || '</head>' || chr(10) || '<body>' || chr(10) || '<h1>'
         || identifier || '</h1>' || chr(10) || '<p>' || document_url || '</p>' || chr(10) || '</body>' || chr(10) || '</html>'
         || chr(10) AS output
  FROM landed WHERE outcome = 'new' AND published_date >= DATE '2024-03-01' AND published_date < DATE '2025-06-01')
SELECT identifier, title, published_date, identifier || '.html' AS storage_path, sha256(output) AS file_hash,
       {size("output")} AS content_length, body_key || '/2024-01/' || identifier || '.html' AS original_storage_path,
       sha256(body) AS original_file_hash FROM pages_out""",
    "reconcile": f"WITH {UNITS} SELECT * FROM units",
    "reconcile_totals": f"""WITH {UNITS}
SELECT CAST(sum(found) AS BIGINT) AS found, CAST(sum(scraped) AS BIGINT) AS scraped, CAST(sum(new) AS BIGINT) AS new,
       CAST(sum(changed) AS BIGINT) AS changed, CAST(sum(unchanged) AS BIGINT) AS unchanged,
       CAST(sum(skipped) AS BIGINT) AS skipped, CAST(sum(failed) AS BIGINT) AS failed, CAST(sum(missing) AS BIGINT) AS missing
FROM units""",
    "failure_log": f"WITH {UNITS} SELECT * FROM failures",
    "persist_failures": f"""WITH {PERSISTED}
SELECT body_key, partition_date, 'failure' AS kind, document_url AS url, reason,
       CAST(CASE WHEN reason = 'HTTP 404' THEN 404 END AS INTEGER) AS status, count(*) AS rows
FROM second_named WHERE outcome = 'failed' GROUP BY ALL
UNION ALL SELECT body_key, partition_date, outcome, NULL, NULL, NULL, count(*) FROM second_named GROUP BY ALL""",
    "range_slice": """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= DATE '1996-01-15' AND o_orderdate < DATE '1997-03-01'""",
    "curate": f"""WITH {CURATION}
SELECT identifier, 'Page ' || identifier AS title, page_url AS description, published_date, body_key, upper(body_key) AS body_name,
       ascii(body_key) AS body_id, partition_date, page_url AS source_url, document_url, document_type,
       identifier || ext AS storage_path, curated_hash AS file_hash, {size("output")} AS content_length, 'r1' AS last_run_id,
       storage_path AS original_storage_path, file_hash AS original_file_hash, {mime("document_type")} AS content_type,
       curated_hash AS object_hash
FROM curated WHERE curated_outcome <> 'unchanged'""",
    "curate_outcome": f"WITH {CURATION} SELECT identifier, document_type, curated_outcome AS outcome FROM curated",
    "curate_failures": f"""WITH {CURATION}
SELECT identifier, 'missing object: ' || storage_path AS reason FROM chosen WHERE body_key = 'fr'""",
    "curate_summary": f"""WITH {CURATION}
SELECT count(*) AS processed, count(*) FILTER (curated_outcome = 'transformed_html') AS transformed_html,
       count(*) FILTER (curated_outcome = 'copied_asis') AS copied_asis, count(*) FILTER (curated_outcome = 'unchanged') AS unchanged,
       (SELECT count(*) FROM chosen WHERE body_key = 'fr') AS failed
FROM curated""",
}
