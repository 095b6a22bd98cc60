"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from docmart.llm import licenses

NORMALISED = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

EXACT_DEDUP = f"""
WITH t AS (
  SELECT doc_id, {NORMALISED} AS norm,
         row_number() OVER (PARTITION BY {NORMALISED} ORDER BY doc_id NULLS LAST) AS place
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       place = 1 AS kept,
       sha256(norm) AS text_sha256
FROM t
"""



def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical_lines(text: str) -> str:
    """The canonical form of ``licenses.canonical_lines``."""
    out = f"translate(coalesce({text}, ''), '{licenses.UPPER}', '{licenses.LOWER}')"
    out = f"regexp_replace({out}, {_quote(licenses.COPYRIGHT_LINE)}, '', 'g')"
    out = f"regexp_replace({out}, {_quote(licenses.HEAD_COPYRIGHT)}, '\\1')"
    out = f"regexp_replace({out}, {_quote(licenses.MARKS)}, ' ', 'g')"
    out = f"replace(replace({out}, chr(10) || ' ', chr(10)), ' ' || chr(10), chr(10))"
    out = f"replace(' ' || replace({out}, chr(10), ' ' || chr(10) || ' ') || ' ', ' ', '  ')"
    for old, new in licenses.SPELLINGS:
        out = f"replace({out}, ' {old.replace(' ', '  ')} ', ' {new.replace(' ', '  ')} ')"
    return out


def _one_line(lines: str) -> str:
    return f"trim(regexp_replace({lines}, '[ \\n]+', ' ', 'g'))"


LICENSE_SCAN = f"""
WITH known AS (
  SELECT digest, min(license) AS license
  FROM (SELECT license, sha256({_one_line('lines')}) AS digest
        FROM (SELECT license, {_canonical_lines('known')} AS lines
              FROM (VALUES {', '.join(f"({_quote(a)}, {_quote(b)})" for a, b in licenses.KNOWN)}) AS v(license, known)))
  GROUP BY digest
), docs AS (
  SELECT doc_id, row_number() OVER () AS row_no, {_canonical_lines('text')} AS lines FROM documents
), notices AS (
  SELECT row_no, string_agg(license, ' ' ORDER BY place) AS notices
  FROM (SELECT row_no, unnest(string_split(lines, chr(10))) AS line,
               generate_subscripts(string_split(lines, chr(10)), 1) AS place FROM docs)
  JOIN known ON sha256(trim(replace(line, '  ', ' '))) = digest
  GROUP BY row_no
)
SELECT doc_id, sha256({_one_line('lines')}) AS canonical_sha256, license, coalesce(notices, '') AS notices
FROM docs LEFT JOIN known ON sha256({_one_line('lines')}) = digest LEFT JOIN notices USING (row_no)
"""

SUBSTRING_DEDUP = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w)
), firsts AS (
  SELECT h, min(doc_id) AS first FROM windows GROUP BY h
), cut AS (
  SELECT doc_id, list(p) AS ps
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN firsts USING (h) WHERE doc_id > first)
  GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(len(ps), 0) AS n_removed,
       sha256(coalesce(array_to_string(list_filter(ws, lambda x, k: NOT list_contains(coalesce(ps, []), k)), ' '), '')) AS kept_sha256
FROM w LEFT JOIN cut USING (doc_id)
"""

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top
  FROM pages
)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (1 + ((('0x' || substr(hex, (1 + 10 * (i // 8))::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31))::INT, 1)), '') AS payload_digest,
       CASE WHEN top IS NULL OR page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN top IS NULL OR page_id = top THEN NULL ELSE top END AS refers_to,
       true AS intact
FROM p
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
), pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(node, seen) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT reach.node, pairs.b FROM reach JOIN pairs ON reach.seen = pairs.a
), roots AS (SELECT node, min(seen) AS root FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, root AS component_id, vec_id = root AS kept
FROM embeddings JOIN roots ON vec_id = node LEFT JOIN counts ON vec_id = a
"""

ORACLES = {
    "op13_embeddings": EMBEDDINGS,
    "op2_substring_dedup": SUBSTRING_DEDUP,
    "op5_warc": WARC,
    "op8_exact_dedup": EXACT_DEDUP,
    "op9_license_scan": LICENSE_SCAN,
}
