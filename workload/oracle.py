"""The same results in SQL for DuckDB, written from the rules and not from the Spark code."""

from __future__ import annotations

from workload.notes import EMAIL


def _unid(key: str) -> str:
    return f"lpad(upper(to_hex({key})), 32, '0')"


def _iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"


FILE = r"regexp_extract(url, '([^/?#]*)(?:[?#].*)?$', 1)"

PAGE_NAME = f"CASE WHEN url LIKE 'https:%' THEN upper({FILE}) ELSE {FILE} END"

TURN = f"""SELECT {_unid('conv_id')} AS unid, CAST(turn AS INTEGER) AS att_pos,
  'turn' || turn || '.' || role || CASE WHEN role = 'user' THEN '.TXT' ELSE '.txt' END AS name, text
  FROM conversations"""

DOCUMENT_META = "source AS meta_source, lang AS meta_lang, CAST(n_chars AS INTEGER) AS meta_size"

# Shapes of the tags in the pages: no '>' outside scripts, every script and style closed.
HTML_STEPS = (
    (r"(?s)<!--.*?-->", ""),
    (r"(?i)<!doctype[^>]*>", ""),
    (r"(?is)<script(?:\s[^>]*)?>.*?</script\s*>", " "),
    (r"(?is)<style(?:\s[^>]*)?>.*?</style\s*>", " "),
    (r"(?i)</?(?:html|head|body|title|meta|nav|ul|li|div|article|h1|footer|p|br)(?:\s[^>]*)?>", " "),
    (r"<[^>]*>", ""),
    ("&quot;", '"'),
    ("&copy;", "©"),
    ("&middot;", "·"),
    (r"&amp;|&amp\b", "&"),
    ("[ \t\n\f\r]+", " "),
)


def _html(column: str) -> str:
    expr = column
    for pattern, replacement in HTML_STEPS:
        expr = f"regexp_replace({expr}, '{pattern}', '{replacement}', 'g')"
    return f"trim({expr})"


def _saturate(value: str, low: str, high: str, type: str) -> str:
    return (
        f"CASE WHEN isnan({value}) THEN 0 WHEN {value} >= {high} THEN {high} "
        f"WHEN {value} <= {low} THEN {low} ELSE CAST(trunc({value}) AS {type}) END"
    )


def _wide(exponent: int) -> str:
    return f"(CASE WHEN l_discount = 0 THEN CAST('NaN' AS DOUBLE) ELSE (l_tax - 0.04) * 1e{exponent} END)"


INT_LOW, INT_HIGH = str(-(2**31)), str(2**31 - 1)
LONG_LOW, LONG_HIGH = "(-9223372036854775807 - 1)", str(2**63 - 1)
WRAPPED = "((l_orderkey * 3000017 - l_partkey * 5000011) % 4294967296 + 4294967296) % 4294967296"

LINES = "string_split(text, chr(10))"
LINE_KEYS = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
PLAIN_RUNS = f"array_to_string(list_filter({LINES}, lambda x: NOT contains(x, '|')), '')"

UNID_KEYS = f"SELECT o_orderkey AS pos, {_unid('o_custkey')} AS unid FROM orders"
ENTRIES = f"SELECT event_id AS pos, {_unid('user_id * 13')} AS unid FROM events"
DOCUMENTS = f"SELECT {_unid('doc_id')} AS unid, * FROM documents"
CUSTOMERS = f"SELECT {_unid('c_custkey')} AS unid, * FROM customer"

DEFAULT_META = f"""o_orderpriority AS meta_form, lpad(upper(to_hex(o_orderkey)), 8, '0') AS meta_noteid,
        {_unid('o_orderkey')} AS meta_unid, {_iso('o_orderdate')} AS meta_created,
        {_iso('o_orderdate + to_hours(o_custkey % 24)')} AS meta_addedtofile,
        {_iso('o_orderdate + to_days(3)')} AS meta_lastmodified,
        {_iso('o_orderdate + to_days(4)')} AS meta_lastmodifiedinfile,
        {_iso('o_orderdate + to_days(400)')} AS meta_lastaccessed,
        CAST(trunc(o_totalprice) AS INTEGER) AS meta_size"""

NAMED_PAGES = f"""SELECT {_unid('page_id')} AS unid,
  CASE WHEN url LIKE 'https:%' THEN upper({FILE}) ELSE {FILE} END AS name FROM pages"""

ORACLE = {
    "load_fields": f"""SELECT {_unid('doc_id')} AS unid, concat_ws(chr(10), source, lang, text) AS text, {DOCUMENT_META}
        FROM documents""",
    "load_sparse_fields": f"""SELECT * FROM (
        SELECT {_unid('doc_id')} AS unid, array_to_string(regexp_extract_all(text, '{EMAIL}'), ' ') AS text, {DOCUMENT_META}
        FROM documents) WHERE regexp_matches(text, '[^\\x00-\\x20]')""",
    "load_by_unid": f"""SELECT k.pos, k.unid, c_name || chr(10) || c_mktsegment AS text, c_acctbal AS meta_balance
        FROM ({UNID_KEYS}) k JOIN ({CUSTOMERS}) c ON k.unid = c.unid""",
    "load_attachments": f"""SELECT d.unid, t.att_pos, t.name AS attachment_name, t.text, {DOCUMENT_META}
        FROM ({TURN}) t JOIN ({DOCUMENTS}) d ON t.unid = d.unid WHERE regexp_matches(t.text, '[^\\x00-\\x20]')""",
    "load_attachment_pattern": f"""SELECT d.unid, t.att_pos, t.name AS attachment_name, t.text, {DOCUMENT_META}
        FROM ({TURN}) t JOIN ({DOCUMENTS}) d ON t.unid = d.unid
        WHERE regexp_matches(lower(t.name), '^turn[0-3]\\.(user|system)\\..*$')""",
    "load_entry_attachments": f"""SELECT e.pos, c.unid, t.att_pos, t.name AS attachment_name, t.text, c_name AS meta_owner
        FROM ({ENTRIES}) e JOIN ({CUSTOMERS}) c ON e.unid = c.unid JOIN ({TURN}) t ON t.unid = c.unid
        WHERE regexp_matches(t.text, '[^\\x00-\\x20]')""",
    "load_nested_attachments": f"""SELECT {_unid('page_id')} AS unid, 0 AS att_pos, {FILE} AS attachment_name,
          html AS text, url AS meta_url FROM pages WHERE {FILE} LIKE '%.%'
        UNION ALL SELECT {_unid('page_id')}, 1, 'link.url', url, url FROM pages""",
    "load_long_items": f"""SELECT coalesce(d.unid, p.unid) AS unid,
          concat_ws(chr(10), source, nullif(page, ''), nullif(replace(text, chr(10), ' '), ''),
            CAST(n_chars / 1024 AS VARCHAR) || ' 0.0') AS text, lang AS meta_lang,
          CAST(n_chars // 1024 AS INTEGER) AS meta_whole, n_chars / 1024 AS meta_size_k,
          {_iso("TIMESTAMP '2020-01-01' + to_seconds(n_chars)")} AS meta_seen, CAST(NULL AS INTEGER) AS meta_not_a_number,
          CAST(coalesce(doc_id, page_id) AS VARCHAR) AS meta_noteid
        FROM ({DOCUMENTS}) d FULL JOIN (SELECT page_id, {_unid('page_id')} AS unid,
          CASE WHEN {FILE} <> '' THEN {FILE} ELSE {_html('html')} END AS page FROM pages) p ON d.unid = p.unid""",
    "load_itemless_notes": f"""SELECT n.*, t.att_pos, t.name AS attachment_name, t.text,
          d.source AS meta_source, nullif(p.plain, '') AS meta_page
        FROM (SELECT {_unid('o_orderkey')} AS unid, {DEFAULT_META} FROM orders) n
        JOIN ({TURN}) t ON t.unid = n.unid LEFT JOIN ({DOCUMENTS}) d ON d.unid = n.unid
        LEFT JOIN (SELECT {_unid('page_id')} AS unid, {FILE} AS plain FROM pages) p ON p.unid = n.unid
        WHERE regexp_matches(t.text, '[^\\x00-\\x20]')""",
    "load_reserved_names": f"""SELECT k.batch, k.pos, k.unid, concat_ws(chr(10), lang, source, text) AS text,
          lang AS meta_batch, upper(source) AS meta_place
        FROM (SELECT 0 AS batch, * FROM ({UNID_KEYS}) UNION ALL SELECT 1, * FROM ({ENTRIES})) k
        JOIN ({DOCUMENTS}) d ON k.unid = d.unid""",
    "load_attachment_extension": f"""SELECT d.unid, t.att_pos, t.name AS attachment_name, t.text, lang AS meta_lang
        FROM ({TURN}) t JOIN ({DOCUMENTS}) d ON t.unid = d.unid
        WHERE lower(t.name) LIKE 'turn%.txt' AND regexp_matches(t.text, '[^\\x00-\\x20]')""",
    "load_file_attachments": f"""SELECT {_unid('page_id')} AS unid, 0 AS att_pos, {PAGE_NAME} AS attachment_name, html || chr(10) AS text,
        url AS meta_url FROM pages WHERE regexp_matches(lower({FILE}), '^[^/]*[.]html?$')""",
    "list_file_attachments": f"""SELECT {_unid('page_id')} AS unid, 0 AS att_pos, nullif({PAGE_NAME}, '') AS name,
        CAST(octet_length(encode(html)) + 1 AS BIGINT) AS length FROM pages""",
    "parser_udf": f"""SELECT {_unid('doc_id')} AS unid,
        translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS text, lang AS meta_lang FROM documents""",
    "parser_attachments": f"""SELECT d.unid, t.att_pos, t.name AS attachment_name, array_to_string(list_reverse(string_split(t.text, chr(10))), chr(10)) AS text
        FROM ({TURN}) t JOIN ({DOCUMENTS}) d ON t.unid = d.unid WHERE regexp_matches(t.text, '[^\\x00-\\x20]')""",
    "field_source": f"""SELECT array_to_string(regexp_extract_all(text, '{EMAIL}'), ' ') AS text,
        {_unid('doc_id')} AS meta_unid, lang AS meta_lang FROM documents""",
    "attachment_source": f"""SELECT text AS content, {_unid('conv_id')} AS meta_unid,
        CAST((SELECT count(*) FROM conversations n WHERE n.conv_id = c.conv_id) AS INTEGER) AS meta_turns
        FROM conversations c WHERE turn = 0""",
    "open_table": "SELECT * FROM orders",
    "fetch_by_unid": f"""SELECT k.pos, k.unid, source, lang, n_chars
        FROM ({UNID_KEYS}) k JOIN ({DOCUMENTS}) d ON k.unid = d.unid""",
    "fetch_by_noteid": """SELECT l_orderkey * 8 + l_linenumber AS pos, CAST(p_partkey AS INTEGER) AS note_id,
        p_name, p_brand, p_size FROM lineitem JOIN part ON l_partkey + l_suppkey = p_partkey""",
    "fetch_view_entries": f"""SELECT e.pos, c.unid, c_name, c_mktsegment
        FROM ({ENTRIES}) e JOIN ({CUSTOMERS}) c ON e.unid = c.unid""",
    "lookup_note": f"""SELECT {_unid('o_orderkey')} AS unid, CAST(o_orderkey AS INTEGER) AS note_id,
        o_orderpriority AS form, o_totalprice AS size FROM orders WHERE o_orderkey = 1234""",
    "append_sources": f"""SELECT 0 AS batch, unid, source, lang FROM ({DOCUMENTS})
        UNION ALL SELECT 1, unid, c_mktsegment, NULL FROM ({CUSTOMERS})
        UNION ALL SELECT 2, unid, source, lang FROM ({DOCUMENTS})""",
    "list_attachments": f"""SELECT t.unid, t.att_pos, t.name FROM ({TURN}) t JOIN ({DOCUMENTS}) d ON t.unid = d.unid""",
    "list_nested_attachments": f"""SELECT unid, CAST(p - 1 AS INTEGER) AS att_pos, (p - 1) || '-' || length(line) || '.txt' AS name
        FROM (SELECT unid, unnest({LINES}) AS line, generate_subscripts({LINES}, 1) AS p FROM ({DOCUMENTS}))""",
    "named_attachment": f"""SELECT {_unid('conv_id')} AS unid, 'turn1.txt' AS name,
        text AS content FROM conversations WHERE turn = 1""",
    "metadata_default": f"SELECT {DEFAULT_META} FROM orders",
    "metadata_empty": f"SELECT {_unid('doc_id')} AS unid, text FROM documents",
    "metadata_string": f"""SELECT {LINE_KEYS}, l_returnflag AS meta_l_returnflag, CAST(l_quantity AS VARCHAR) AS meta_quantity,
        CAST(l_linenumber AS VARCHAR) AS meta_line, CAST(l_discount AS VARCHAR) AS meta_discount,
        CASE WHEN l_discount > 0.05 THEN '' END AS meta_absent FROM lineitem""",
    "metadata_integer": f"""SELECT {LINE_KEYS}, l_linenumber AS meta_l_linenumber,
        CAST(trunc(-l_extendedprice) AS INTEGER) AS meta_price,
        CAST({_saturate(_wide(12), INT_LOW, INT_HIGH, 'BIGINT')} AS INTEGER) AS meta_saturated,
        CAST(CASE WHEN {WRAPPED} >= 2147483648 THEN {WRAPPED} - 4294967296 ELSE {WRAPPED} END AS INTEGER) AS meta_wrapped,
        CAST(NULL AS INTEGER) AS meta_text FROM lineitem""",
    "metadata_long": f"""SELECT {LINE_KEYS}, CAST(l_linenumber AS BIGINT) AS meta_l_linenumber, l_orderkey AS meta_l_orderkey,
        CAST(trunc(-l_extendedprice) AS BIGINT) AS meta_price,
        CAST({_saturate(_wide(21), LONG_LOW, LONG_HIGH, 'HUGEINT')} AS BIGINT) AS meta_saturated,
        CAST(NULL AS BIGINT) AS meta_text FROM lineitem""",
    "metadata_double": f"""SELECT {LINE_KEYS}, l_quantity AS meta_l_quantity, CAST(l_orderkey AS DOUBLE) AS meta_l_orderkey,
        l_extendedprice * (1 - l_discount) AS meta_net, CAST(NULL AS DOUBLE) AS meta_text FROM lineitem""",
    "metadata_temporal": f"""SELECT event_id, {_iso('ts')} AS meta_at, CAST(CAST(ts AS DATE) AS VARCHAR) AS meta_day,
        CAST(NULL AS VARCHAR) AS meta_kind, CAST(NULL AS VARCHAR) AS meta_number FROM events""",
    "metadata_custom": f"""SELECT o_orderkey, lower(string_split(o_orderpriority, '-')[-1]) AS meta_priority,
        o_orderstatus || '/' || o_orderpriority AS meta_label, CAST(year(o_orderdate) AS INTEGER) AS meta_year,
        CAST(round(o_totalprice * 100) AS BIGINT) AS meta_cents, o_totalprice / 1000 AS meta_thousands,
        {_iso('o_orderdate + to_days(30)')} AS meta_due FROM orders""",
    "metadata_override": f"""SELECT {_unid('p_partkey')} AS unid, p_name AS meta_name, p_size * 2 AS meta_size,
        p_retailprice AS meta_price, p_brand AS meta_brand FROM part""",
    "metadata_first_value": f"""SELECT {_unid('doc_id')} AS unid, regexp_extract_all(text, '{EMAIL}')[1] AS meta_contact,
        {LINES}[1] AS meta_title FROM documents""",
    "metadata_skip_missing": """SELECT d.doc_id, quality AS meta_quality, CAST(toxic AS BIGINT) AS meta_toxic,
        CAST(NULL AS VARCHAR) AS meta_author,
        CASE WHEN quality <> 0 THEN n_chars / quality END AS meta_per_quality, CAST(NULL AS INTEGER) AS meta_lang_number
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "fields_text": f"""SELECT {_unid('doc_id')} AS unid, concat_ws(chr(10), lang,
        nullif(array_to_string(regexp_extract_all(text, '{EMAIL}'), ' '), ''), source, text) AS text FROM documents""",
    "multivalue_text": f"SELECT {_unid('doc_id')} AS unid, replace(text, chr(10), ' ') AS text FROM documents",
    "richtext_text": f"SELECT {_unid('doc_id')} AS unid, {PLAIN_RUNS} AS text FROM documents",
    "mime_body": f"SELECT page_id, CASE WHEN {FILE} <> '' THEN {FILE} ELSE {_html('html')} END AS text FROM pages",
    "html_text": f"SELECT page_id, {_html('html')} AS text FROM pages",
    "item_dispatch": f"""SELECT 'document' AS origin, {_unid('doc_id')} AS unid,
          CASE WHEN contains(text, '|') THEN {PLAIN_RUNS} ELSE replace(text, chr(10), ' ') END AS text FROM documents
        UNION ALL SELECT 'page', {_unid('page_id')}, CASE WHEN {FILE} <> '' THEN {FILE} ELSE {_html('html')} END FROM pages""",
    "decode_text": "SELECT doc_id, text || '�' AS text FROM documents",
    "glob_filter": f"SELECT * FROM ({NAMED_PAGES}) WHERE regexp_matches(lower(name), '^[^5-9][^/]*\\.htm(l|)$')",
    "glob_default": f"SELECT * FROM ({NAMED_PAGES}) WHERE name LIKE '%.%'",
    "glob_match": """SELECT page_id, regexp_matches(lower(url), '^https:.*/[^/][^/]/[^/]*$') AS secure_language,
        regexp_matches(lower(url), '^[^/]*example[^/]*$') AS one_segment,
        regexp_matches(lower(url), '^.*\\.(com|net)/.*[?].*$') AS with_query FROM pages""",
    "blank_filter": f"""SELECT doc_id, chr(9) || chr(31) || ' ' || array_to_string(regexp_extract_all(text, '{EMAIL}'), ' ') || chr(10) AS text
        FROM documents
        WHERE regexp_matches(text, '{EMAIL}')""",
    "is_empty_string": f"""SELECT doc_id, regexp_extract(text, '{EMAIL}') = '' AS no_address,
        regexp_extract(text, '{EMAIL}') = '' AS null_address, false AS space, text <> '' AS has_text,
        regexp_matches(text, '[^\\x00-\\x20]') AS has_visible_text FROM documents""",
    "is_empty_array": f"""SELECT {_unid('doc_id')} AS unid, len(regexp_extract_all(text, '{EMAIL}')) = 0 AS no_contacts,
        len(regexp_extract_all(text, '{EMAIL}')) = 0 AS null_contacts, true AS has_lines FROM documents""",
}
