"""The expected result of each registered query as SQL for DuckDB, worked out from the tables alone."""

from __future__ import annotations

LINES = """
lines AS (
    SELECT doc_id, lang, i, line, strlen(line) AS size,
           CASE i % 4 WHEN 0 THEN lang || '/line-' || i || '.txt' WHEN 1 THEN 'line-' || i || '.txt'
                      WHEN 2 THEN lang || '//sub/line-' || i || '.txt' ELSE '/line-' || i || '.txt' END AS entry_name,
           CASE WHEN i % 4 = 3 THEN '%PDF-1.4' || chr(10) || line ELSE line END AS planted,
           CASE WHEN i % 3 <> 2 THEN 0 WHEN i % 6 = 2 THEN 1 ELSE 2 END AS depth
    FROM (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)
), planted AS (
    SELECT *, CASE WHEN i % 4 = 3 THEN 'application/pdf' WHEN line = '' THEN 'application/octet-stream'
                   ELSE 'text/plain' END AS entry_type FROM lines
)"""

CORPUS = """
corpus AS (
    SELECT 'page-' || page_id AS file_id, -1 AS k, NULL::BIGINT AS doc_id, html AS body, 'text/html' AS full_type,
           '.html' AS ext FROM pages
    UNION ALL
    SELECT 'doc-' || doc_id, doc_id % 8, doc_id, text,
           CASE doc_id % 8 WHEN 0 THEN 'text/plain' WHEN 1 THEN 'application/pdf' WHEN 2 THEN 'application/zip'
                WHEN 3 THEN 'application/gzip' WHEN 4 THEN 'image/png' WHEN 5 THEN 'application/x-7z-compressed'
                WHEN 6 THEN 'application/x-rar-compressed; version=4' ELSE 'application/x-bzip2' END,
           CASE doc_id % 8 WHEN 0 THEN '.txt' WHEN 1 THEN '.pdf' WHEN 2 THEN '.zip' WHEN 3 THEN '.gz' WHEN 4 THEN '.png'
                WHEN 5 THEN '.7z' WHEN 6 THEN '' ELSE '.bz2' END
    FROM documents
)"""

FLAT_FILES = "SELECT doc_id AS archive_id, i + 1 AS fragment_index, entry_name, size, md5(line) AS md5 FROM lines"

HTML_TEXT = r"""
trim(regexp_replace(
    replace(replace(replace(replace(replace(replace(replace(replace(replace(
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({html},
            '(?is)</?[ab]( [^>]*)?>', '', 'g'), '(?is)<!--.*?-->', '', 'g'), '(?is)^.*?<body[^>]*>', '', 'g'), '(?is)<script\b[^>]*>.*?</script>', ' ', 'g'),
            '(?is)<style\b[^>]*>.*?</style>', ' ', 'g'), '(?is)<noscript\b[^>]*>.*?</noscript>', ' ', 'g'),
            '(?s)<[a-zA-Z/!?][^>]*>', ' ', 'g'),
        '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''),
        '&copy;', '©'), '&middot;', '·'), '&amp;', '&'),
    '[ \t\r\n]+', ' ', 'g'))"""

JAVA_TRIM = r"regexp_replace(regexp_replace({text}, '^[\x00-\x20]+', ''), '[\x00-\x20]+$', '')"

# what text extraction with a limit of 2000 characters makes of the corpus with planted encryption
EXTRACTED = f"""
{CORPUS}, outcome AS (
    SELECT file_id,
           CASE WHEN k = -1 THEN CASE WHEN length({HTML_TEXT.format(html='body')}) > 2000 THEN 'TEXT_LIMIT' END
                WHEN k = 0 THEN CASE WHEN length(body) > 2000 THEN 'TEXT_LIMIT' END
                WHEN k = 1 AND doc_id % 16 = 1 THEN 'ENCRYPTED' WHEN k = 2 AND doc_id % 16 = 2 THEN 'ENCRYPTED'
                ELSE 'UNSUPPORTED' END AS error_class
    FROM corpus
)"""

PERMISSIONS = """
CASE doc_id // 2 % 4 WHEN 0 THEN 'rw-r--r--' WHEN 1 THEN 'rwxr-xr-x' WHEN 2 THEN 'rw-------' ELSE 'rwxr-x--x' END"""

BYTE_CUT = "left(text, list_max(list_filter(range(0, {n} + 1), lambda k: strlen(left(text, k::INT)) <= {n}))::INT)"

ROUTED = """
requests AS (
    SELECT o_orderkey AS request_id,
           CASE WHEN o_orderkey % 50 = 0 THEN '  ' WHEN o_orderkey % 50 <> 1 THEN o_custkey::VARCHAR END AS key FROM orders
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY request_id) AS nth FROM requests
)"""


ORACLE: dict[str, str] = {
    "file_scan": """
        SELECT 'page-' || page_id AS file_id, page_id || '.html' AS filename, strlen(html) AS length, md5(html) AS md5 FROM pages
        UNION ALL SELECT 'doc-' || doc_id, doc_id || '.txt', strlen(text), md5(text) FROM documents""",
    "route_split": f"""
        WITH {EXTRACTED}
        SELECT CASE WHEN error_class IS NULL THEN 'success' ELSE 'failure' END AS route, count(*) AS n_files
        FROM outcome GROUP BY 1""",
    "error_summary": f"""
        WITH {EXTRACTED}
        SELECT CASE WHEN error_class IS NULL THEN 'success' ELSE 'failure' END AS route, error_class, count(*) AS n_files
        FROM outcome GROUP BY 1, 2""",
    "change_audit": f"""
        WITH {EXTRACTED}
        SELECT 'extract' AS op, CASE WHEN error_class IS NULL THEN 'content modified' ELSE 'attributes modified' END AS change,
               CASE WHEN error_class IS NULL THEN 'success' ELSE 'failure' END AS route, count(*) AS n_files
        FROM outcome GROUP BY ALL""",
    "mime_identify": f"""
        WITH {CORPUS}
        SELECT file_id, split_part(full_type, ';', 1) AS mime_type, ext AS mime_extension, 'success' AS route FROM corpus""",
    "mime_clean": f"""
        WITH {CORPUS} SELECT file_id, full_type, split_part(full_type, ';', 1) AS clean_type FROM corpus""",
    "mime_extension": f"""
        WITH {CORPUS}
        SELECT split_part(full_type, ';', 1) AS mime_type, ext AS mime_extension, count(*) AS n_files FROM corpus GROUP BY 1, 2""",
    "mime_custom_rules": """
        SELECT doc_id,
               CASE WHEN starts_with(text, 'The') THEN 'text/x-the' WHEN starts_with(text, 'Th') THEN 'text/x-th'
                    WHEN starts_with(text, 'T') THEN 'text/x-any-t' WHEN substr(text, 2, 1) = 'e' AND strlen(left(text, 1)) = 1
                    THEN 'text/x-e-second' ELSE 'text/plain' END AS mime_type,
               CASE WHEN starts_with(text, 'The') THEN '.the' WHEN starts_with(text, 'Th') THEN '.th'
                    WHEN starts_with(text, 'T') THEN '.t' WHEN substr(text, 2, 1) = 'e' AND strlen(left(text, 1)) = 1
                    THEN '' ELSE '.txt' END AS mime_extension
        FROM documents""",
    "archive_recognise": f"""
        WITH {CORPUS} SELECT file_id, k IN (2, 3, 7) AS can_open, k IN (5, 6) AS only_recognised FROM corpus""",
    "unpack_flat": f"WITH {LINES} {FLAT_FILES}",
    "unpack_recursive": f"""
        WITH {LINES}
        SELECT doc_id AS archive_id, row_number() OVER (PARTITION BY doc_id ORDER BY depth, i) AS fragment_index, entry_name,
               depth::BIGINT AS depth, CASE depth WHEN 0 THEN '' WHEN 1 THEN 'inner.zip/' ELSE 'inner.zip/deep.tar/' END AS container,
               size, md5(line) AS md5
        FROM lines""",
    "unpack_budget_skip": f"""
        WITH RECURSIVE {LINES}, walk AS (
            SELECT doc_id, i, entry_name, size, line, size <= 1000 AS kept, CASE WHEN size <= 1000 THEN size ELSE 0 END AS used
            FROM lines WHERE i = 0
            UNION ALL
            SELECT n.doc_id, n.i, n.entry_name, n.size, n.line, n.size + w.used <= 1000,
                   CASE WHEN n.size + w.used <= 1000 THEN n.size + w.used ELSE w.used END
            FROM walk w JOIN lines n ON n.doc_id = w.doc_id AND n.i = w.i + 1
        )
        SELECT doc_id AS archive_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS fragment_index, entry_name, size,
               md5(line) AS md5
        FROM walk WHERE kept""",
    "unpack_budget_fail": f"""
        WITH {LINES}, running AS (
            SELECT *, sum(size) OVER (PARTITION BY doc_id ORDER BY i) AS used FROM lines
        )
        SELECT doc_id AS archive_id, CASE WHEN max(used) > 1500 THEN 'failure' ELSE 'original' END AS route,
               CASE WHEN max(used) > 1500 THEN 'SIZE_BUDGET' END AS error_class,
               coalesce(sum(size) FILTER (used <= 1500), 0)::BIGINT AS unpack_bytes, max(used) > 1500 AS threshold_breached,
               nullif(count(*) FILTER (used <= 1500), 0) AS fragment_count
        FROM running GROUP BY doc_id""",
    "unpack_nothing": f"""
        WITH {LINES}
        SELECT doc_id AS archive_id, CASE WHEN min(size) > 20 THEN 'failure' ELSE 'original' END AS route,
               CASE WHEN min(size) > 20 THEN 'NOTHING_UNPACKED' END AS error_class, sum(size) > 20 AS threshold_breached
        FROM lines GROUP BY doc_id""",
    "unpack_nonarchive": f"""
        WITH {CORPUS}
        SELECT to_failure, file_id, CASE WHEN k = 2 OR to_failure THEN 'failure' ELSE 'original' END AS route,
               CASE WHEN k = 2 THEN 'CORRUPT' WHEN k IN (5, 6) THEN 'UNSUPPORTED' ELSE 'NOT_AN_ARCHIVE' END AS error_class
        FROM corpus, (VALUES (true), (false)) AS policy(to_failure)""",
    "unpack_sub_error": f"""
        WITH {LINES}, counted AS (
            SELECT doc_id, doc_id % 4 = 1 AND count(*) > 2 AS broken, count(*) AS n_all, count(*) FILTER (depth = 0) AS n_own
            FROM lines GROUP BY doc_id
        )
        SELECT fail_on_sub_error, doc_id AS archive_id,
               CASE WHEN broken AND fail_on_sub_error THEN 'failure' ELSE 'original' END AS route,
               CASE WHEN broken AND fail_on_sub_error THEN 'CORRUPT' END AS error_class,
               CASE WHEN broken AND NOT fail_on_sub_error THEN 1::BIGINT ELSE 0::BIGINT END AS sub_errors,
               CASE WHEN broken THEN n_own ELSE n_all END AS fragment_count
        FROM counted, (VALUES (true), (false)) AS policy(fail_on_sub_error)""",
    "unpack_paths": f"""
        WITH {LINES}, placed AS (
            SELECT doc_id, i, lang, 'doc-' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '.zip' ELSE '.tar' END AS parent,
                   CASE i % 4 WHEN 0 THEN lang WHEN 2 THEN lang || '/sub' WHEN 3 THEN '/' END AS dir
            FROM lines
        )
        SELECT doc_id AS archive_id, i + 1 AS fragment_index,
               'line-' || i || '.txt' AS filename,
               coalesce(dir || '/', '/') AS path, parent || '/' || coalesce(dir, '') AS absolute_path,
               coalesce(dir || '/', '/') AS segment_path, parent AS segment_original_filename
        FROM placed""",
    "unpack_fragments": f"""
        WITH {LINES}
        SELECT doc_id AS archive_id, sha256(doc_id::VARCHAR) AS fragment_id, i + 1 AS fragment_index,
               count(*) OVER (PARTITION BY doc_id) AS fragment_count
        FROM lines""",
    "unpack_tar_metadata": f"""
        WITH {LINES}, stamped AS (
            SELECT *, doc_id % 2 = 1 AS is_tar,
                   strftime(make_timestamp((1704067200 + doc_id) * 1000000), '%Y-%m-%dT%H:%M:%S+0000') AS stamp FROM lines
        )
        SELECT doc_id AS archive_id, i + 1 AS fragment_index, CASE WHEN is_tar THEN 'user' || (doc_id % 7) END AS owner,
               CASE WHEN is_tar THEN 'group' || (doc_id % 3) END AS grp,
               CASE WHEN is_tar THEN {PERMISSIONS} END AS permissions,
               CASE WHEN is_tar THEN stamp END AS last_modified_time, CASE WHEN is_tar THEN stamp END AS creation_time
        FROM stamped""",
    "unpack_permissions": f"""
        WITH {LINES}
        SELECT CASE doc_id // 2 % 4 WHEN 0 THEN 420::BIGINT WHEN 1 THEN 493 WHEN 2 THEN 384 ELSE 2537 END AS mode,
               {PERMISSIONS} AS permissions, count(*) AS n_files
        FROM lines WHERE doc_id % 2 = 1 GROUP BY 1, 2""",
    "unpack_child_mime": f"""
        WITH {LINES}
        SELECT recursive, CASE WHEN recursive THEN entry_type ELSE 'application/octet-stream' END AS mime_type, count(*) AS n_files
        FROM planted, (VALUES (true), (false)) AS mode(recursive) GROUP BY 1, 2""",
    "unpack_parents": f"""
        WITH {LINES}
        SELECT doc_id AS archive_id, CASE WHEN doc_id % 2 = 0 THEN 'application/zip' ELSE 'application/x-tar' END AS mime_type,
               sum(size)::BIGINT AS unpack_bytes, false AS threshold_breached, sha256(doc_id::VARCHAR) AS fragment_id,
               count(*) AS fragment_count, 'original' AS route
        FROM lines GROUP BY doc_id""",
    "unpack_inherit": f"""
        WITH {LINES}
        SELECT doc_id AS archive_id, row_number() OVER (PARTITION BY doc_id ORDER BY depth, i) AS fragment_index, lang,
               'line-' || i || '.txt' AS filename
        FROM lines""",
    "unpack_atomic": f"""
        WITH {LINES}
        SELECT doc_id AS archive_id, count(*) AS n_files, sum(size)::BIGINT AS n_bytes
        FROM lines GROUP BY doc_id HAVING sum(size) <= 1500""",
    "unpack_lineage": f"""
        WITH {LINES}
        SELECT doc_id AS parent_id, sha256(doc_id || '/' || (i + 1)) AS child_id, i + 1 AS fragment_index FROM lines""",
    "unpack_large": f"""
        WITH {LINES}
        SELECT doc_id AS archive_id, i + 1 AS fragment_index, entry_name, size, md5(line) AS md5 FROM lines""",
    "archive_table": f"""
        WITH {LINES}
        SELECT doc_id AS archive_id, i + 1 AS pos, entry_name AS name, size, md5(line) AS md5,
               count(*) OVER (PARTITION BY doc_id) AS n_unpacked
        FROM lines QUALIFY size < 200 AND entry_name LIKE 'line-%'""",
    "archive_parents": f"""
        WITH {LINES}
        SELECT doc_id AS archive_id, count(*) AS n_unpacked, sum(size)::BIGINT AS unpack_bytes, NULL::VARCHAR AS error_class
        FROM lines GROUP BY doc_id""",
    "contains_search_set": f"""
        WITH {CORPUS}
        SELECT full_type AS mime_type, count(*) AS n_files FROM corpus
        WHERE full_type IN ('application/pdf', 'text/html', 'image/png') GROUP BY 1""",
    "contains_type": f"""
        WITH {LINES}
        SELECT doc_id AS archive_id, 'success' AS route,
               CASE WHEN doc_id % 2 = 0 THEN 'application/zip' ELSE 'application/x-tar' END AS archive_mime,
               count(*) FILTER (entry_type <> 'text/plain') > 0 AS found,
               arg_min(entry_type, i) FILTER (entry_type <> 'text/plain') AS found_mime, NULL::VARCHAR AS error_class
        FROM planted GROUP BY doc_id""",
    "contains_recursive": f"""
        WITH {LINES}, searched AS (
            SELECT doc_id, count(*) > 2 AS has_inner,
                   arg_min(entry_type, depth * 1000000 + i) FILTER (entry_type <> 'text/plain') AS deep_match,
                   arg_min(entry_type, i) FILTER (entry_type <> 'text/plain' AND depth = 0) AS own_match
            FROM planted GROUP BY doc_id
        ), matched AS (
            SELECT doc_id, recursive, CASE WHEN recursive THEN deep_match WHEN has_inner THEN 'application/zip' ELSE own_match
                   END AS found_mime
            FROM searched, (VALUES (true), (false)) AS mode(recursive)
        )
        SELECT recursive, doc_id AS archive_id, 'success' AS route,
               CASE WHEN doc_id % 2 = 0 THEN 'application/zip' ELSE 'application/x-tar' END AS archive_mime,
               found_mime IS NOT NULL AS found, found_mime, NULL::VARCHAR AS error_class
        FROM matched""",
    "contains_sub_error": f"""
        WITH {LINES}, searched AS (
            SELECT doc_id, doc_id % 4 = 1 AND count(*) > 2 AS broken,
                   count(*) FILTER (entry_type = 'application/pdf' AND depth = 0) > 0 AS own_match,
                   count(*) FILTER (entry_type = 'application/pdf') > 0 AS any_match
            FROM planted GROUP BY doc_id
        ), decided AS (
            SELECT doc_id, fail_on_sub_error, broken AND fail_on_sub_error AND NOT own_match AS failed,
                   CASE WHEN broken THEN own_match ELSE any_match END AS found
            FROM searched, (VALUES (true), (false)) AS policy(fail_on_sub_error)
        )
        SELECT fail_on_sub_error, doc_id AS archive_id, CASE WHEN failed THEN 'failure' ELSE 'success' END AS route,
               CASE WHEN failed THEN NULL WHEN doc_id % 2 = 0 THEN 'application/zip' ELSE 'application/x-tar' END AS archive_mime,
               CASE WHEN NOT failed THEN found END AS found,
               CASE WHEN NOT failed AND found THEN 'application/pdf' END AS found_mime,
               CASE WHEN failed THEN 'CORRUPT' END AS error_class
        FROM decided""",
    "contains_nonarchive": f"""
        WITH {CORPUS}
        SELECT to_failure, file_id, CASE WHEN k = 2 OR to_failure THEN 'failure' ELSE 'success' END AS route,
               NULL::VARCHAR AS archive_mime, NULL::BOOLEAN AS found, NULL::VARCHAR AS found_mime,
               CASE WHEN k = 2 THEN 'CORRUPT' WHEN k IN (5, 6) THEN 'UNSUPPORTED' ELSE 'NOT_AN_ARCHIVE' END AS error_class
        FROM corpus, (VALUES (true), (false)) AS policy(to_failure)""",
    "extract_html": f"""
        SELECT page_id, {HTML_TEXT.format(html='html')} AS text, 'text/plain' AS mime_type, 'success' AS route FROM pages""",
    "extract_planted": r"""
        SELECT doc_id, CASE WHEN doc_id % 6 = 4 THEN regexp_replace(t, '[^\x20-\x7E\x{A0}-\x{FF}]', '', 'g') ELSE t END AS text
        FROM (SELECT doc_id, trim(left(trim(regexp_replace(text, '[\x00-\x20\x{A0}]+', ' ', 'g')), 400)) AS t FROM documents)""",
    "extract_xml": r"""
        SELECT doc_id, trim(regexp_replace(text, '[ \t\r\n]+', ' ', 'g')) AS text, 'text/plain' AS mime_type, 'success' AS route
        FROM documents""",
    "extract_plain": f"""
        SELECT doc_id, {JAVA_TRIM.format(text='text')} AS text, 'text/plain' AS mime_type, 'success' AS route FROM documents""",
    "extract_char_limit": f"""
        SELECT doc_id, {JAVA_TRIM.format(text='left(text, 100)')} AS text, CASE WHEN length(text) > 100 THEN true END AS limit_reached
        FROM documents""",
    "extract_byte_limit": f"""
        SELECT doc_id, {JAVA_TRIM.format(text=BYTE_CUT.format(n=64))} AS text,
               CASE WHEN strlen(text) > 64 THEN true END AS limit_reached
        FROM documents""",
    "extract_byte_estimate": f"""
        SELECT doc_id, {JAVA_TRIM.format(text="left(text, 2048 // strlen(left(text, 1)))")} AS text,
               CASE WHEN length(text) * strlen(left(text, 1)) > 2048 THEN true END AS limit_reached
        FROM documents""",
    "extract_both_limits": f"""
        SELECT doc_id, {JAVA_TRIM.format(text=BYTE_CUT.replace('text', 'left(text, 1000)').format(n=1024))} AS text,
               CASE WHEN strlen(text) > 1024 THEN 'the document holds more text than the limit of 1024 bytes'
                    WHEN length(text) > 1000 THEN 'the document holds more text than the limit of 1000 characters'
                    END AS error_message
        FROM documents""",
    "extract_limit_policy": f"""
        SELECT doc_id, CASE WHEN length(text) > 1500 THEN 'failure' ELSE 'success' END AS route,
               CASE WHEN length(text) > 1500 THEN true END AS limit_reached,
               CASE WHEN length(text) > 1500 THEN 'TEXT_LIMIT' END AS error_class,
               md5(CASE WHEN length(text) > 1500 THEN text ELSE {JAVA_TRIM.format(text='text')} END) AS content_md5
        FROM documents""",
    "extract_trim": f"""
        SELECT doc_id, {JAVA_TRIM.format(text="left(' ' || chr(9) || chr(10) || text || ' ' || chr(13) || chr(10) || ' ', 40)")} AS text
        FROM documents""",
    "extract_empty": f"""
        SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 0::BIGINT ELSE strlen({JAVA_TRIM.format(text='text')}) END AS n_bytes,
               'success' AS route, 'text/plain' AS mime_type, NULL::BOOLEAN AS limit_reached
        FROM documents""",
    "extract_error_routes": f"""
        WITH {CORPUS}
        SELECT file_id, CASE WHEN k IN (-1, 0) THEN 'success' ELSE 'failure' END AS route,
               CASE WHEN k IN (-1, 0) THEN NULL WHEN doc_id % 16 IN (1, 2) THEN 'ENCRYPTED' ELSE 'UNSUPPORTED' END AS error_class,
               CASE WHEN k IN (-1, 0) THEN 'text/plain' ELSE split_part(full_type, ';', 1) END AS mime_type
        FROM corpus""",
    "keyed_delete_route": f"""
        WITH {ROUTED}, routed AS (
            SELECT request_id, key,
                   CASE WHEN key IS NULL OR trim(key) = '' THEN 'failure'
                        WHEN nth = 1 AND EXISTS (SELECT 1 FROM customer WHERE c_custkey::VARCHAR = key)
                        THEN 'success' ELSE 'not-found' END AS route
            FROM ranked
        )
        SELECT request_id, key, route, route = 'failure' AS penalized, CASE WHEN route = 'failure' THEN 'BLANK_KEY' END AS error_class
        FROM routed""",
    "keyed_delete_survivors": """
        SELECT o_orderkey::VARCHAR AS key, o_orderpriority AS value FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_orderkey)""",
    "keyed_delete_expr": """
        SELECT c_custkey, c_mktsegment || ':' || c_custkey AS key,
               CASE WHEN c_custkey % 2 = 0 THEN 'success' ELSE 'not-found' END AS route
        FROM customer""",
    "keyed_delete_replay": """
        SELECT event_id, CASE WHEN before = 'signup' THEN 'success' ELSE 'not-found' END AS route
        FROM (SELECT event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before
              FROM events WHERE event_type IN ('signup', 'error'))
        WHERE event_type = 'error'""",
    "keyed_delete_replay_store": """
        SELECT event_id, CASE WHEN before = 'signup' OR (before IS NULL AND who IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0))
                              THEN 'success' ELSE 'not-found' END AS route
        FROM (SELECT event_id, who, event_type, lag(event_type) OVER (PARTITION BY who ORDER BY ts, event_id) AS before
              FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS who FROM events)
              WHERE event_type IN ('signup', 'error'))
        WHERE event_type = 'error'""",
    "parse_data_size": """
        SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN -1::BIGINT WHEN doc_id % 7 < 5
                            THEN (n_chars * pow(1024, doc_id % 7))::BIGINT END AS n_bytes
        FROM documents""",
    "archive_text_report": f"""
        WITH {LINES}, cut AS (
            SELECT entry_type, CASE WHEN entry_type = 'application/pdf' THEN planted
                                    ELSE {JAVA_TRIM.format(text='left(line, 400)')} END AS content,
                   CASE WHEN entry_type = 'application/pdf' THEN 'UNSUPPORTED' WHEN length(line) > 400 THEN 'TEXT_LIMIT' END AS error_class
            FROM planted
        )
        SELECT entry_type, CASE WHEN entry_type = 'application/pdf' THEN 'failure' ELSE 'success' END AS route, error_class,
               count(*) AS n_files, sum(strlen(content))::BIGINT AS n_bytes
        FROM cut GROUP BY 1, 2, 3""",
}
