"""DuckDB SQL twin of each registered query (same column names and values)."""

from __future__ import annotations

from docmart import rules
from docmart.plans import queries as Q
from docmart.plans import sqltext as S
from docmart.plans.sqltext import WS, lit

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


def _cue(id_col: str, values: list[str]) -> str:
    return f"list_extract([{', '.join(lit(v) for v in values)}], CAST({id_col} % {len(values)} + 1 AS INTEGER))"


def _cued(name: str, id_col: str, text: str, values: list[str]) -> str:
    return f"SELECT * REPLACE ({_cue(id_col, values)} || ' ' || {text} AS {text}) FROM {name}"


oracle("html_clean", f"SELECT page_id, {S.clean_html('html')} AS text_clean FROM pages")

oracle("text_fold", f"SELECT doc_id, {S.fold('text')} AS text_folded FROM documents")

oracle("body_text_decode", """
SELECT conv_id, turn,
       CASE WHEN turn % 2 = 0 THEN replace(text, chr(10), ' ') ELSE text END AS body,
       replace(text, chr(10), ' ') AS body_from_list
FROM conversations""")

_kw_pattern = f'(?i)<a{WS}+(?:[^>]*?{WS}+)?href="(/[^"]*)"'
oracle("keyword_gated_link", f"""
SELECT page_id,
       CASE WHEN contains(lower(html), {lit(Q.KEYWORD)})
            THEN nullif(regexp_extract(html, {lit(_kw_pattern)}, 1), '') END AS CANAL_TURNO
FROM pages""")


def _tidy_role(e: str) -> str:
    alt = "|".join(rules.ROLE_CONNECTORS)
    r = S.strip_ws(f"regexp_replace({e}, {lit(f'(?i){WS}+({alt}){WS}*$')}, '')")
    r = S.strip_ws(f"regexp_replace({r}, {lit(f'(?i)^{WS}*({alt}){WS}+')}, '')")
    return S.strip_chars(r, rules.ROLE_EDGE_CHARS)


_defaults = "[" + ", ".join(lit(d) for d in rules.DEFAULT_ROLES) + "]"
oracle("list_roles", f"""
WITH b AS (
  SELECT page_id, html,
         regexp_replace(regexp_replace(html, '[\\r\\n\\t]', ' ', 'g'), '\\\\[rnt]', ' ', 'g') AS h
  FROM pages WHERE html IS NOT NULL AND html <> ''),
li AS (SELECT page_id, unnest(regexp_extract_all(h, '(?is)<li>(.*?)</li>', 1)) AS item FROM b),
c AS (SELECT page_id, {S.strip_tags_text(S.unescape('item'))} AS c FROM li),
s AS (SELECT page_id, {S.strip_chars('c', rules.ITEM_EDGE_CHARS)} AS s FROM c WHERE length(c) > 0),
r AS (SELECT page_id,
             unnest(CASE WHEN contains(s, ',') AND length(s) < {rules.ROLE_SPLIT_MAX_LEN}
                         THEN list_transform(string_split(s, ','), lambda x: {S.strip_ws('x')})
                         ELSE [s] END) AS r
      FROM s),
k AS (SELECT page_id, r FROM r
      WHERE length(r) BETWEEN {rules.ROLE_MIN_LEN} AND {rules.ROLE_MAX_LEN}
        AND NOT {S.contains_any(S.fold('r'), S.BLACKLIST_FOLDED)}),
t AS (SELECT page_id, {_tidy_role('r')} AS t FROM k),
roles AS (
  SELECT page_id, {S.capitalize_first('t')} AS role FROM t WHERE length(t) > 0
  UNION
  SELECT page_id, unnest({_defaults}) FROM b)
SELECT page_id, role AS NOMBRE_PARTICIPANTE FROM roles
UNION ALL
SELECT page_id, NULL FROM pages WHERE html IS NULL OR html = ''""")

_pay_text = S.fold(S.unescape("regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\\\\[nrtbf]', ' ', 'g')"))
_pay_hits = ", ".join(f"CASE WHEN regexp_matches(f, {lit('(?i)' + p)}) THEN {lit(n)} END"
                      for n, p in rules.PAYMENT_PATTERNS)
oracle("label_dictionary", f"""
SELECT doc_id, unnest(list_filter([{_pay_hits}], lambda x: x IS NOT NULL)) AS NOMBRE_MEDIO_PAGO
FROM (SELECT doc_id, {_pay_text} AS f FROM ({_cued('documents', 'doc_id', 'text', Q.PAYMENT_CUES)}))""")

oracle("label_dictionary_large", f"""
SELECT o_orderkey, array_to_string(list_sort(list_distinct(list_filter([
  CASE WHEN o_custkey % 5 <> 4 THEN 'Tasa ' || (o_orderkey % {Q.DICTIONARY_SIZE}) END,
  'Tasa ' || (o_custkey % {Q.DICTIONARY_SIZE})], lambda x: x IS NOT NULL))), '|') AS labels FROM orders""")

oracle("url_classifier", f"""
WITH r AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN {_cue('page_id', Q.LINK_CUES)} ELSE url END AS url,
                  '<a href="' || {_cue('page_id', Q.LINK_CUES)} || '">x</a> ' || html AS html FROM pages),
p AS (SELECT page_id, url, {S.first_href('html')} AS link FROM r)
SELECT page_id,
       {S.classify_link('url')} AS url_platform,
       CASE WHEN {S.classify_link('url')} IS NOT NULL THEN url END AS url_link,
       {S.classify_link('link')} AS html_platform,
       CASE WHEN {S.classify_link('link')} IS NOT NULL THEN link END AS html_link,
       regexp_matches(lower(url), '^https://') AS is_secure
FROM p""")

oracle("max_level", f"""
SELECT event_id,
       CAST(list_max(list_transform(regexp_extract_all(props, {lit('(?i)"k":' + WS + '+([0-9])')}, 1),
                                    lambda x: CAST(x AS INTEGER))) AS INTEGER) AS NIVEL_MIBA
FROM events""")

oracle("title_clean", f"""
SELECT 'part' AS src, p_partkey AS id, {S.clean_title('p_name')} AS title FROM part
UNION ALL
SELECT 'doc' AS src, doc_id AS id, {S.clean_title('text')} AS title FROM documents""")

oracle("person_and_required_flags", f"""
SELECT doc_id,
       CASE WHEN {S.contains_any(S.fold('text'), rules.LEGAL_PERSON_WORDS)} THEN 'N' ELSE 'Y' END AS PERSONA_FISICA,
       CASE WHEN {S.contains_any(S.fold('text'), rules.OPTIONAL_WORDS)}
              OR contains({S.fold('lang')}, {lit(rules.OPTIONAL_SUBTITLE_WORD)}) THEN 'N' ELSE 'Y' END AS OBLIGATORIEDAD
FROM ({_cued('documents', 'doc_id', 'text', Q.PERSON_CUES)})""")

oracle("contact_extract", f"""
SELECT doc_id, {S.phone('text')} AS TELEFONO_DEPENDENCIA, {S.mail('text')} AS MAIL_ATENCION
FROM ({_cued('documents', 'doc_id', 'text', Q.PHONE_CUES)})""")

oracle("type_router", """
SELECT 'events' AS tbl, event_id AS id,
       CASE event_type WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'views' ELSE 'purchases' END AS route
FROM events WHERE event_type IN ('click', 'view', 'purchase')
UNION ALL
SELECT 'documents', doc_id, 'es_para' FROM documents WHERE lang = 'es' AND contains(lower(text), 'para')
UNION ALL
SELECT 'documents', doc_id, 'src3' FROM documents WHERE source = 'src3'""")

_price = "('$' || CAST(CAST({c} AS DECIMAL(12,2)) AS VARCHAR))"
oracle("nested_projection", f"""
SELECT l_orderkey AS id, l_linenumber AS line,
       CAST(l_partkey AS VARCHAR) || ',' || CAST(l_suppkey AS VARCHAR) AS MODALIDAD_IDS,
       'price' AS type, 'Precio' AS title, {_price.format(c='l_extendedprice')} AS body
FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) || ',' || CAST(l_suppkey AS VARCHAR),
       'ship', 'Envío', strftime(l_shipdate, '%Y-%m-%d')
FROM lineitem""")

_kw_the = f'(?i)<a{WS}+(?:[^>]*?{WS}+)?href="(/[^"]*)"'
oracle("steps_posexplode", f"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '(?is)<li>(.*?)</li>', 1) AS items FROM pages),
s AS (SELECT page_id, CAST(generate_subscripts(items, 1) AS INTEGER) AS ORDEN_PASO, unnest(items) AS paso FROM l),
p AS (SELECT page_id, ORDEN_PASO, paso, {S.first_href('paso')} AS link FROM s WHERE paso IS NOT NULL)
SELECT page_id, ORDEN_PASO, {S.clean_html('paso')} AS DESCRIPCION_PASO_CLEAN,
       {S.classify_link('link')} AS NOMBRE_PLATAFORMA,
       CASE WHEN {S.classify_link('link')} IS NOT NULL THEN link END AS LINK_PLATAFORMA,
       CASE WHEN contains(lower(paso), 'the') THEN nullif(regexp_extract(paso, {lit(_kw_the)}, 1), '') END AS CANAL_TURNO
FROM p""")

oracle("conditional_flags", """
SELECT c_custkey,
       CASE WHEN c_acctbal > 0 THEN 'Y' ELSE 'N' END AS TIENE_SALDO,
       c_acctbal > 0 AS TIENE_SALDO_BOOL,
       regexp_matches(lower(c_mktsegment), 'machin|auto') AS ES_INDUSTRIAL,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' OR c_mktsegment IS NULL OR c_mktsegment = '' THEN 'Sin segmento'
            ELSE c_mktsegment END AS SEGMENTO,
       CAST(nullif(c_nationkey, 0) AS INTEGER) AS NACION,
       coalesce(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END, c_name) AS SEGMENTO_O_NOMBRE,
       CAST(c_nationkey AS VARCHAR) AS ID_NACION
FROM customer
WHERE length(c_name) > 5 AND regexp_matches(c_name, '[0-9]{9}$')""")

oracle("dim_hash_key", f"""
SELECT p_brand, p_type,
       arg_min(p_partkey, p_partkey) AS p_partkey, arg_min(p_name, p_partkey) AS p_name,
       arg_min(p_size, p_partkey) AS p_size, {S.content_key('p_brand', 'p_type')} AS DIM_KEY
FROM part GROUP BY p_brand, p_type""")

_doc_rows = """
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_returnflag, l.l_linestatus,
         p.p_brand AS NOMBRE_DOCUMENTO,
         CASE WHEN p.p_size <= 40 THEN p.p_type END AS LINK_MODELO,
         CASE WHEN p.p_retailprice > 1500 THEN 'Obligatoria' ELSE 'Opcional' END AS TIPO_DOCUMENTO
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""

oracle("fact_null_safe", f"""
WITH r AS ({_doc_rows}),
dim AS (SELECT DISTINCT NOMBRE_DOCUMENTO, LINK_MODELO, TIPO_DOCUMENTO,
               {S.content_key('NOMBRE_DOCUMENTO', 'LINK_MODELO', 'TIPO_DOCUMENTO')} AS ID_DOCUMENTO FROM r)
SELECT DISTINCT r.l_orderkey, dim.ID_DOCUMENTO
FROM r JOIN dim
  ON r.NOMBRE_DOCUMENTO IS NOT DISTINCT FROM dim.NOMBRE_DOCUMENTO
 AND r.LINK_MODELO IS NOT DISTINCT FROM dim.LINK_MODELO
 AND r.TIPO_DOCUMENTO IS NOT DISTINCT FROM dim.TIPO_DOCUMENTO""")

oracle("fact_defaulted_key", f"""
WITH s AS (
  SELECT l.l_orderkey, l.l_linenumber,
         CASE WHEN p.p_size <= 10 THEN NULL WHEN p.p_size <= 20 THEN '' ELSE p.p_name END AS t,
         CASE WHEN p.p_retailprice < 1000 THEN NULL ELSE p.p_type END AS d
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
k AS (SELECT l_orderkey, l_linenumber,
             CASE WHEN t IS NULL OR t = '' THEN {lit(rules.STEP_TITLE_DEFAULT)} ELSE t END AS t,
             coalesce(d, {lit(rules.STEP_TEXT_DEFAULT)}) AS d FROM s)
SELECT DISTINCT l_orderkey, l_linenumber AS ORDEN_PASO, {S.content_key('t', 'd')} AS ID_PASO FROM k""")

oracle("computed_key_join", f"""
WITH dim AS (
  SELECT DISTINCT o_orderpriority AS n, CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS f FROM orders)
SELECT o.o_orderkey, {S.content_key('dim.n', 'dim.f')} AS ID_REQUISITO, dim.f = 'Y' AS OBLIGATORIEDAD
FROM orders o JOIN dim ON o.o_orderpriority = dim.n AND (o.o_orderstatus = 'F') = (dim.f = 'Y')""")

oracle("block_bridge", f"""
WITH r AS ({_doc_rows}),
m AS (
  SELECT DISTINCT {S.content_key('l_orderkey', 'l_returnflag')} AS GROUP_KEY, 'left' AS ROLE,
         {S.content_key('CAST(l_partkey AS VARCHAR)')} AS MEMBER_KEY FROM r
  UNION
  SELECT DISTINCT {S.content_key('l_orderkey', 'l_returnflag')}, 'right',
         {S.content_key('NOMBRE_DOCUMENTO', 'LINK_MODELO', 'TIPO_DOCUMENTO')} FROM r WHERE l_linestatus = 'F')
SELECT * FROM m WHERE GROUP_KEY IN (SELECT GROUP_KEY FROM m GROUP BY GROUP_KEY HAVING count(DISTINCT ROLE) = 2)""")

_member = rules.IN_PERSON_MEMBER
oracle("dim_default_member", f"""
WITH web AS (
  SELECT DISTINCT n_name AS NOMBRE_PLATAFORMA_DE_TRAMITACION,
         'https://' || lower(n_name) || '.example/' AS LINK_AL_INICIO_DEL_TRAMITE,
         n_regionkey AS REGION FROM nation),
dim AS (
  SELECT *, {lit(rules.PLATFORM_WEB_MODALITY)} AS MODALIDAD,
         {lit(rules.PLATFORM_PREFIX)} || NOMBRE_PLATAFORMA_DE_TRAMITACION AS DESCRIPCION_PLATAFORMA_DE_TRAMITACION
  FROM web
  UNION ALL BY NAME
  SELECT {lit(_member[0])} AS NOMBRE_PLATAFORMA_DE_TRAMITACION, {lit(_member[1])} AS LINK_AL_INICIO_DEL_TRAMITE,
         {lit(_member[2])} AS MODALIDAD, {lit(_member[3])} AS DESCRIPCION_PLATAFORMA_DE_TRAMITACION)
SELECT *, {S.content_key('NOMBRE_PLATAFORMA_DE_TRAMITACION')} AS ID_PLATAFORMA_DE_TRAMITACION FROM dim""")

oracle("fact_two_origins", f"""
SELECT o_orderkey AS ID_TRAMITE, {S.content_key('o_orderpriority')} AS ID_PLATAFORMA_DE_TRAMITACION
FROM orders WHERE o_orderstatus = 'F'
UNION
SELECT o_orderkey, {S.content_key(lit(_member[0]))}
FROM orders WHERE list_contains([o_orderstatus, o_orderpriority], {lit(Q.URGENT)})""")

oracle("label_bridge", f"""
WITH j AS (SELECT l.doc_id, l.quality, l.toxic, d.lang FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
x AS (SELECT doc_id, unnest(list_filter([CASE WHEN quality = 1 THEN 'quality' END,
                                         CASE WHEN toxic = 1 THEN 'toxic' END,
                                         'lang:' || lang], lambda v: v IS NOT NULL)) AS NOMBRE_MEDIO_PAGO FROM j)
SELECT DISTINCT doc_id, NOMBRE_MEDIO_PAGO, {S.content_key('NOMBRE_MEDIO_PAGO')} AS ID_MEDIO_PAGO FROM x""")


def _rollup_sql(src: str, key: str) -> str:
    """A1 in SQL over ``src(key, CONCEPTO, PRECIO_DEC)``."""
    return f"""
SELECT {key},
       coalesce(array_to_string(list_transform(
           list_filter(list_sort(list(struct_pack(n := PRECIO_DEC IS NULL, a := PRECIO_DEC, l := CONCEPTO))),
                       lambda x: x.a IS NOT NULL), lambda x: CAST(x.a AS VARCHAR)), '|'), '') AS MONTO_COSTO,
       array_to_string(list_transform(
           list_sort(list(struct_pack(n := PRECIO_DEC IS NULL, a := PRECIO_DEC, l := CONCEPTO))),
           lambda x: x.l), '|') AS CONCEPTO_PAGO,
       CAST(max(PRECIO_DEC) AS VARCHAR) AS MAX_COSTO,
       CASE WHEN max(PRECIO_DEC) > 0 THEN 'Y' ELSE 'N' END AS REQUIERE_PAGO
FROM {src} GROUP BY {key}"""


_price_dec = "TRY_CAST(regexp_replace({c}, '[^0-9.]', '', 'g') AS DECIMAL(10,2))"
oracle("cost_rollup", f"""
WITH c AS (
  SELECT l_orderkey AS ID_TRAMITE,
         coalesce(CASE WHEN l_returnflag <> 'R' THEN l_returnflag END, {lit(rules.COST_DEFAULT_CONCEPT)}) AS CONCEPTO,
         CASE WHEN l_discount = 0 THEN 'Gratuito' ELSE {_price.format(c='l_extendedprice')} END AS PRECIO_STR
  FROM lineitem),
d AS (SELECT ID_TRAMITE, CONCEPTO, {_price_dec.format(c='PRECIO_STR')} AS PRECIO_DEC FROM c)
{_rollup_sql('d', 'ID_TRAMITE')}""")

oracle("presence_marker", f"""
SELECT source, max('Contiene secretos') AS MARCADOR FROM documents
WHERE regexp_matches(lower(text), {lit(Q.SECRET_PATTERN)}) GROUP BY source""")

oracle("first_by_order", """
SELECT user_id, arg_min(event_type, struct_pack(t := ts, e := event_id)) AS PRIMER_TIPO FROM events GROUP BY user_id""")

oracle("wide_main_costs", f"""
SELECT o_custkey AS CODIGO_TRAMITE, o_orderkey AS ID_PEDIDO, o_orderpriority AS CONCEPTO,
       CAST({_price_dec.format(c=_price.format(c='o_totalprice'))} AS VARCHAR) AS COSTO FROM orders""")

oracle("wide_main_table", f"""
WITH c AS (
  SELECT o_custkey AS CODIGO_TRAMITE, o_orderpriority AS CONCEPTO,
         {_price_dec.format(c=_price.format(c='o_totalprice'))} AS PRECIO_DEC FROM orders),
costs AS ({_rollup_sql('c', 'CODIGO_TRAMITE')}),
marker AS (SELECT o_custkey AS CODIGO_TRAMITE, 'Tiene pedidos urgentes' AS MARCO_NORMATIVO
           FROM orders WHERE regexp_matches(lower(o_orderpriority), 'urgent') GROUP BY o_custkey),
dates AS (SELECT o_custkey AS CODIGO_TRAMITE,
                 arg_min(o_orderdate, struct_pack(d := o_orderdate, k := o_orderkey)) AS first_d,
                 arg_max(o_orderdate, struct_pack(d := o_orderdate, k := o_orderkey)) AS last_d
          FROM orders GROUP BY o_custkey)
SELECT cu.c_custkey AS CODIGO_TRAMITE,
       strftime(first_d, '%Y-%m-%d %H:%M:%S') AS FECHA_ALTA_TRAMITE,
       strftime(last_d, '%Y-%m-%d %H:%M:%S') AS FECHA_ULT_MODIFICACION_TRAMITE,
       cu.c_name AS NOMBRE,
       coalesce(CASE WHEN cu.c_acctbal >= 0 THEN cu.c_mktsegment END, {lit(rules.PURPOSE_DEFAULT)}) AS FINALIDAD,
       coalesce(CASE WHEN cu.c_nationkey <> 0 THEN CAST(cu.c_nationkey AS VARCHAR) END,
                {lit(rules.DEPENDENCY_DEFAULT)}) AS ID_DEPENDENCIA,
       {lit(rules.PROCEDURE_TYPE_DEFAULT)} AS ID_TIPO_TRAMITE,
       costs.MONTO_COSTO, costs.CONCEPTO_PAGO, costs.REQUIERE_PAGO, marker.MARCO_NORMATIVO,
       CAST(NULL AS VARCHAR) AS FECHA_BAJA_TRAMITE, {lit(rules.NOT_SPECIFIED)} AS TIEMPO_RESPUESTA_ESTIMADO,
       CAST(NULL AS VARCHAR) AS CONCLUSION_TRAMITACION_DOC, cu.c_custkey AS ID_TRAMITE
FROM customer cu
LEFT JOIN costs ON cu.c_custkey = costs.CODIGO_TRAMITE
LEFT JOIN marker ON cu.c_custkey = marker.CODIGO_TRAMITE
LEFT JOIN dates ON cu.c_custkey = dates.CODIGO_TRAMITE""")

oracle("latest_snapshot", """
SELECT user_id, arg_max(event_id, struct_pack(t := ts, e := event_id)) AS event_id,
       strftime(arg_max(ts, struct_pack(t := ts, e := event_id)), '%Y-%m-%d %H:%M:%S.%f') AS ts,
       arg_max(event_type, struct_pack(t := ts, e := event_id)) AS event_type,
       arg_max(value, struct_pack(t := ts, e := event_id)) AS value
FROM events GROUP BY user_id""")

oracle("retention_window", f"""
SELECT event_id, user_id, event_type FROM events
WHERE ts > (SELECT max(ts) FROM events) - INTERVAL {Q.RETENTION_DAYS} DAY""")

oracle("expired_landing", f"""
SELECT event_id, user_id, event_type, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day
FROM events WHERE ts::DATE > (SELECT max(ts)::DATE FROM events) - INTERVAL {Q.RETENTION_DAYS} DAY""")

oracle("audit_publish", f"""
SELECT r_regionkey, r_name, {lit(Q.RUN_TS)} AS insert_into_dl_timestamp FROM region""")

oracle("land_and_scan_json", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props,
       CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
FROM events""")

oracle("incremental_landing", "SELECT event_id, user_id, event_type, value FROM events")


# ---------------------------------------------------------------------------
# Relational HTML mining
# ---------------------------------------------------------------------------

def _strip_invisible(e: str) -> str:
    e = f"regexp_replace({e}, '(?s)<!--.*?-->', '', 'g')"
    for t in ("script", "style"):
        e = f"regexp_replace({e}, {lit(rf'(?is)<{t}\b[^>]*>.*?</{t}\s*>')}, '', 'g')"
    return e


_href_re = (f"(?is)^<a{WS}(?:[^>]*?{WS})?href{WS}*={WS}*"
            f"(?:\"([^\"]*)\"|'([^']*)'|([^{rules.WS_CLASS}\"'>]+))")
_tokens_sql = f"""
  l AS (SELECT page_id, regexp_extract_all({_strip_invisible('html')}, '(<[^>]+>|[^<]+)', 1) AS l FROM pages),
  t0 AS (SELECT page_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS tok FROM l),
  t1 AS (SELECT *, lower(regexp_extract(tok, '^</?([A-Za-z][A-Za-z0-9]*)', 1)) AS tag FROM t0),
  tk AS (SELECT page_id, pos, tok, tag,
                CASE WHEN tag <> '' THEN CASE WHEN starts_with(tok, '</') THEN 'end' ELSE 'start' END
                     WHEN starts_with(tok, '<!') OR starts_with(tok, '<?') THEN 'decl' ELSE 'text' END AS kind
         FROM t1),
  tokens AS (SELECT *, CASE WHEN kind = 'start' AND tag = 'a' THEN coalesce(
                 {', '.join(f"nullif(regexp_extract(tok, {lit(_href_re)}, {g}), '')" for g in (1, 2, 3))}) END AS href
             FROM tk)"""

oracle("token_table", f"WITH {_tokens_sql} SELECT page_id, pos, kind, tag, tok, href FROM tokens")


def _clean_raw(e: str) -> str:
    return f"coalesce({S.strip_tags_text(S.unescape(e))}, '')"


oracle("list_items", f"""
WITH {_tokens_sql},
d AS (SELECT *, kind = 'start' AND tag IN ('ul', 'ol') AS is_ls, kind = 'end' AND tag IN ('ul', 'ol') AS is_le,
             sum(CASE WHEN kind = 'start' AND tag IN ('ul', 'ol') THEN 1
                      WHEN kind = 'end' AND tag IN ('ul', 'ol') THEN -1 ELSE 0 END)
                 OVER (PARTITION BY page_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS depth,
             last_value(CASE WHEN tag = 'a' AND kind = 'start' THEN pos WHEN tag = 'a' AND kind = 'end' THEN -1 END
                        IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS anchor
      FROM tokens),
r AS (SELECT *, unnest(CASE WHEN is_ls THEN ['open', 'child'] ELSE ['tok'] END) AS role
      FROM d WHERE depth >= 1 OR is_le),
k AS (SELECT *, CASE WHEN role = 'child' THEN depth - 1 WHEN is_le THEN depth + 1 ELSE depth END AS key FROM r),
lp AS (SELECT *, last_value(CASE WHEN role = 'open' THEN pos END IGNORE NULLS)
                   OVER (PARTITION BY page_id, key ORDER BY pos ROWS UNBOUNDED PRECEDING) AS list_pos FROM k),
ow AS (SELECT *, last_value(CASE WHEN role = 'tok' AND kind = 'start' AND tag = 'li' THEN pos
                                 WHEN role = 'tok' AND kind = 'end' AND tag = 'li' THEN -1 END IGNORE NULLS)
                   OVER (PARTITION BY page_id, key, list_pos ORDER BY pos ROWS UNBOUNDED PRECEDING) AS o FROM lp),
own AS (SELECT * FROM ow WHERE o >= 0 AND role = 'tok'),
fa AS (SELECT page_id, o, min(pos) AS a_pos, arg_min(href, pos) AS a_href FROM own
       WHERE tag = 'a' AND kind = 'start' AND href IS NOT NULL GROUP BY page_id, o),
per_item AS (
  SELECT own.page_id, own.o AS li_pos,
         {_clean_raw("string_agg(tok, ' ' ORDER BY pos) FILTER (WHERE kind = 'text')")} AS own_text,
         {_clean_raw("string_agg(tok, '' ORDER BY pos) FILTER (WHERE kind = 'text')")} AS full_text,
         {_clean_raw("string_agg(tok, '' ORDER BY pos) FILTER (WHERE kind = 'text' AND anchor = fa.a_pos)")} AS link_text,
         {_clean_raw("string_agg(tok, '' ORDER BY pos) FILTER (WHERE kind = 'text' AND anchor IS DISTINCT FROM fa.a_pos)")}
             AS rest_text,
         {S.unescape('any_value(fa.a_href)')} AS href
  FROM own LEFT JOIN fa ON own.page_id = fa.page_id AND own.o = fa.o
  GROUP BY own.page_id, own.o),
li AS (SELECT page_id, pos AS li_pos, list_pos, CAST(key AS INTEGER) AS depth FROM ow
       WHERE role = 'tok' AND kind = 'start' AND tag = 'li'),
lists AS (SELECT page_id, list_pos, max(pos) AS list_end FROM ow WHERE key >= 1 GROUP BY page_id, list_pos),
child AS (SELECT page_id, pos AS list_pos, CASE WHEN o >= 0 THEN o END AS parent_li FROM ow WHERE role = 'child'),
has_list AS (SELECT DISTINCT page_id, parent_li AS li_pos FROM child WHERE parent_li IS NOT NULL)
SELECT li.page_id, li.li_pos, li.list_pos, lists.list_end, li.depth, child.parent_li,
       coalesce(p.own_text, '') AS own_text, coalesce(p.full_text, '') AS full_text,
       coalesce(p.link_text, '') AS link_text, coalesce(p.rest_text, '') AS rest_text, p.href,
       h.li_pos IS NOT NULL AS has_list
FROM li
LEFT JOIN lists ON li.page_id = lists.page_id AND li.list_pos = lists.list_pos
LEFT JOIN child ON li.page_id = child.page_id AND li.list_pos = child.list_pos
LEFT JOIN per_item p ON li.page_id = p.page_id AND li.li_pos = p.li_pos
LEFT JOIN has_list h ON li.page_id = h.page_id AND li.li_pos = h.li_pos""")

_geo = """
  SELECT s.*, n.n_name, n.n_regionkey, r.r_name
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""
_money = "CAST(CAST({c} AS DECIMAL(12,2)) AS VARCHAR)"


def _req_flags(name: str) -> str:
    return (f"CASE WHEN {S.contains_any(S.fold(name), rules.OPTIONAL_WORDS)} THEN 'N' ELSE 'Y' END AS OBLIGATORIEDAD, "
            f"CASE WHEN {S.contains_any(S.fold(name), rules.LEGAL_PERSON_WORDS)} THEN 'N' ELSE 'Y' END AS PERSONA_FISICA")


oracle("requirements_flatten", f"""
WITH g AS ({_geo}),
leaves AS (
  SELECT s_suppkey, r_name || ': ' || n_name || ': ' || s_name AS n FROM g WHERE s_acctbal >= 0
  UNION ALL
  SELECT s_suppkey, r_name || ': ' || n_name || ': Saldo ' || {_money.format(c='s_acctbal')}
         || CASE WHEN s_acctbal < 1000 THEN ' (opcional)' ELSE '' END FROM g WHERE s_acctbal >= 0
  UNION ALL
  SELECT s_suppkey, 'Empresa ' || CAST(s_suppkey AS VARCHAR) FROM g WHERE s_acctbal >= 0)
SELECT s_suppkey, {S.capitalize_first('n')} AS NOMBRE_REQUISITO, {_req_flags('n')}, 'GENERAL' AS ID_SUBGRUPO
FROM leaves
UNION ALL
SELECT s_suppkey, 'Presentar nota de ' || s_name, 'Y', 'Y', 'GENERAL' FROM g WHERE s_acctbal < 0""")

oracle("documentation_catalogue", f"""
SELECT o_orderkey,
       CASE WHEN o_totalprice > 200000 THEN 'Copia del pedido ' ELSE 'Pedido ' END || CAST(o_orderkey AS VARCHAR)
         AS NOMBRE_DOCUMENTO,
       'prioridad ' || o_orderpriority AS DESCRIPCION_DOCUMENTO, 'N' AS TIENE_MODELO, NULL AS LINK_MODELO,
       'Obligatoria' AS TIPO_DOCUMENTO
FROM orders
UNION ALL
SELECT o_orderkey, 'Formulario ' || CAST(o_custkey AS VARCHAR), 'firmado', 'Y',
       'https://x.example/c/' || CAST(o_custkey AS VARCHAR) || '.pdf', 'Obligatoria' FROM orders
UNION ALL
SELECT o_orderkey, 'Comprobante ' || CAST(o_orderkey AS VARCHAR) || ' ()', '', 'Y',
       'https://x.example/o/' || CAST(o_orderkey AS VARCHAR), 'Obligatoria' FROM orders
UNION ALL
SELECT o_orderkey, 'Nota del ' || strftime(o_orderdate, '%Y-%m-%d'), '', 'N', NULL, 'Opcional' FROM orders""")

oracle("organisation_profile", f"""
WITH g AS ({_geo}),
v AS (SELECT s_suppkey, 'Ministerio de ' || n_name AS name,
             '4323-' || CAST(s_suppkey % 9000 + 1000 AS VARCHAR) AS phone,
             'contacto' || CAST(s_suppkey AS VARCHAR) || '@x.gob.ar' AS mail,
             CASE WHEN s_acctbal >= 0 THEN 'Av. Corrientes ' ELSE 'Calle Defensa ' END
               || CAST(s_suppkey + 100 AS VARCHAR) AS address,
             CASE WHEN n_regionkey = 0 THEN 'Lunes y martes de 8 a 12' ELSE 'Lunes a viernes de 9 a 15' END AS hours
      FROM g)
SELECT s_suppkey, name AS NOMBRE_DEPENDENCIA, 'Contacto Teléfono: ' || phone || ' ' || mail AS DESCRIPCION_DEPENDENCIA,
       hours AS HORARIO_DEPENDENCIA, address AS DIRECCION_DEPENDENCIA, phone AS TELEFONO_DEPENDENCIA,
       mail AS MAIL_ATENCION, CASE WHEN contains(lower(name), 'ministerio') THEN name END AS DEPENDENCIA_MINISTERIO
FROM v""")

_elements = f"""(
  SELECT * FROM ({_geo}), (VALUES
    (1, 'p', NULL, NULL), (2, 'h2', 'Nación', FALSE), (3, 'p', 'Nación', TRUE), (4, 'div', 'Nación', FALSE),
    (5, 'p', 'Nación', TRUE), (6, 'h3', 'Saldo', FALSE), (7, 'p', 'Saldo', TRUE), (8, 'div', 'Saldo', FALSE))
    AS e(place, tag, section_heading, run)
  WHERE place <> 4 OR s_acctbal < 0)"""
_element_text = f"""(CASE place WHEN 1 THEN 'Intro ' || r_name WHEN 2 THEN 'Nación' WHEN 3 THEN n_name WHEN 4 THEN 'Aviso'
  WHEN 5 THEN 'Cliente ' || CAST(s_suppkey AS VARCHAR) WHEN 6 THEN 'Saldo' WHEN 7 THEN {_money.format(c='s_acctbal')}
  WHEN 8 THEN 'Fin' END)"""
# A block between heading and paragraph ends the run.
_run = "(CASE WHEN place = 5 AND s_acctbal < 0 THEN FALSE WHEN place = 1 THEN NULL ELSE run END)"

oracle("page_sections", f"""
SELECT s_suppkey, tag, {_element_text} AS text, section_heading, {_run} AS in_run FROM {_elements}""")

oracle("page_residual", f"""
SELECT s_suppkey, string_agg({_element_text}, ' ' ORDER BY place) AS residual FROM {_elements}
WHERE NOT coalesce({_run}, FALSE) AND tag NOT IN ('h2', 'h3') GROUP BY s_suppkey""")

oracle("procedures_main_table", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS CODIGO_TRAMITE,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS FECHA_ALTA_TRAMITE,
       strftime(o_orderdate + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS FECHA_ULT_MODIFICACION_TRAMITE,
       'Pedido ' || CAST(o_orderkey AS VARCHAR) AS NOMBRE,
       'Prioridad ' || o_orderpriority || CASE WHEN o_orderstatus = 'F' THEN ' Nivel 2' ELSE '' END AS FINALIDAD,
       CAST(o_custkey AS VARCHAR) AS ID_DEPENDENCIA, '1' AS ID_TIPO_TRAMITE,
       CASE WHEN o_orderstatus = 'F' THEN 2 END AS NIVEL_MIBA,
       CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) AS MONTO_COSTO,
       o_orderpriority AS CONCEPTO_PAGO,
       CASE WHEN o_totalprice > 0 THEN 'Y' ELSE 'N' END AS REQUIERE_PAGO,
       CASE WHEN o_orderstatus = 'F' THEN {lit(rules.TARIFF_LAW_MARKER)} END AS MARCO_NORMATIVO,
       'https://tad.buenosaires.gob.ar/t/' || CAST(o_orderkey AS VARCHAR) AS CANAL_TURNO,
       CAST(NULL AS VARCHAR) AS FECHA_BAJA_TRAMITE, {lit(rules.NOT_SPECIFIED)} AS TIEMPO_RESPUESTA_ESTIMADO,
       CAST(NULL AS VARCHAR) AS CONCLUSION_TRAMITACION_DOC, CAST(o_orderkey AS VARCHAR) AS ID_TRAMITE
FROM orders""")

from docmart.plans import procedures_sql  # noqa: E402

oracle("staging_roundtrip", procedures_sql.STAGING)
oracle("consume_tables", procedures_sql.CONSUME)


# ---------------------------------------------------------------------------
# Markup as editors leave it (plans.markup)
# ---------------------------------------------------------------------------

_sup = "(SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS k, s_suppkey % 3 AS m FROM supplier)"

oracle("markup_documents", f"""
SELECT s_suppkey, d.* FROM {_sup}, LATERAL (VALUES
  ('Planilla ' || k, 'firmada', 'https://x.example/' || k || '?a=1&b=2', 'Obligatoria'),
  ('Constancia ' || k, 'copiaSello ' || k, NULL, 'Obligatoria'),
  ('Sello ' || k, '', NULL, 'Obligatoria'))
  AS d(NOMBRE_DOCUMENTO, DESCRIPCION_DOCUMENTO, LINK_MODELO, TIPO_DOCUMENTO)""")

oracle("markup_requirements", f"""
SELECT s_suppkey, d.* FROM {_sup}, LATERAL (VALUES
  ('Persona ' || k || ': Estatuto', 'Y', 'Y'), ('Persona ' || k || ': Poder (opcional)', 'N', 'Y'), ('Nota ' || k, 'Y', 'Y'))
  AS d(NOMBRE_REQUISITO, OBLIGATORIEDAD, PERSONA_FISICA) WHERE m <> 0
UNION ALL SELECT s_suppkey, 'Presentar nota ' || k, 'Y', 'Y' FROM {_sup} WHERE m = 0""")

oracle("markup_organisations", f"""
SELECT s_suppkey, 'Ministerio ' || k AS NOMBRE_DEPENDENCIA,
       CASE WHEN m = 0 THEN 'Av. Lima ' || k || ' Piso 2' ELSE ': Sede ' || k END AS DIRECCION_DEPENDENCIA,
       'Lunes Martes' AS HORARIO_DEPENDENCIA, 'Otro dato Aviso' AS DESCRIPCION_DEPENDENCIA
FROM {_sup}""")

oracle("markup_elements", f"""
SELECT s_suppkey, d.* FROM {_sup}, LATERAL (VALUES
  (0, 8, 'div', 0, 'Uno & dosVer másxyz', '/' || k), (1, 1, 'h2', 0, 'Uno & dos', NULL), (2, 6, 'ul', 0, 'Ver másx', '/' || k),
  (3, 5, 'li', 1, 'Ver más', '/' || k), (4, 4, 'a', 1, 'Ver', NULL))
  AS d(place, last, tag, depth, text, target)""")

oracle("extracted_items", f"""
SELECT s_suppkey, d.* FROM {_sup}, LATERAL (VALUES
  (CASE WHEN m <> 0 THEN 'Requisito' ELSE 'Suelto' END, 'DNI ' || k, '', NULL, NULL),
  (CASE WHEN m <> 0 THEN 'Requisito' ELSE 'Suelto' END, 'Formulario firmado', 'Formulario', 'firmado', '/f/' || k),
  ('Contacto', 'Mail ' || k, '', NULL, NULL)) AS d(KIND, full_text, link_text, rest_text, href)
UNION ALL SELECT s_suppkey, 'Celda', 'Celda ' || k, '', NULL, NULL FROM {_sup} WHERE m <> 2""")


# ---------------------------------------------------------------------------
# Snapshots (plans.snapshots)
# ---------------------------------------------------------------------------

_old = """(SELECT o_orderkey, o_custkey, o_orderpriority, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS o_totalprice
  FROM orders WHERE o_orderkey % 7 <> 0)"""
_new = """(SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS o_orderpriority, o_totalprice
  FROM orders WHERE o_orderkey % 11 <> 0)"""

oracle("snapshot_difference", f"""
SELECT 'insert' AS op, * FROM {_new} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {_old})
UNION ALL SELECT 'delete', * FROM {_old} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {_new})
UNION ALL SELECT 'update', n.* FROM {_new} n JOIN {_old} o USING (o_orderkey)
  WHERE n.o_orderpriority IS DISTINCT FROM o.o_orderpriority OR n.o_totalprice IS DISTINCT FROM o.o_totalprice""")

oracle("snapshot_difference_applied", f"SELECT * FROM {_new}")

oracle("record_history", """
SELECT c_custkey, v.* FROM (SELECT c_custkey, c_mktsegment AS s, c_custkey % 4 AS kind FROM customer), LATERAL (
  SELECT CASE WHEN o THEN NULL ELSE s END AS segment, a AS valid_from, b AS valid_to FROM (VALUES
    (0, false, 1, NULL), (1, false, 1, 3), (1, false, 4, NULL), (2, false, 1, 2), (2, true, 2, 4), (2, false, 4, NULL), (3, false, 1, 3))
    AS t(k, o, a, b) WHERE k = kind) v""")

oracle("quarantined_records", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 10 < 3 THEN 'quarantined' ELSE 'good' END AS state,
       CASE o_orderkey % 10 WHEN 0 THEN 'malformed' WHEN 1 THEN 'fields.tags: array expected'
         WHEN 2 THEN 'fields.tags[]: struct expected' ELSE o_orderpriority END AS detail
FROM orders""")

oracle("json_array_records", r"""
SELECT c_custkey AS id, 'a "quoted" {brace} [list] \ and ñ ' || c_name AS note, c_mktsegment || ',}' AS inner FROM customer""")

oracle("versioned_publish", f"""
SELECT n_nationkey, r_name, {lit(Q.RUN_TS)} AS insert_into_dl_timestamp FROM nation JOIN region ON n_regionkey = r_regionkey""")

oracle("incremental_jobs", ORACLES["staging_roundtrip"])


# ---------------------------------------------------------------------------
# Bucketed staging tables (plans.copartition)
# ---------------------------------------------------------------------------

oracle("copartitioned_main_table", f"""
WITH items AS (
  SELECT o_custkey, o_orderkey AS k, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS a,
         CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority ELSE {lit(rules.COST_DEFAULT_CONCEPT)} END AS l FROM orders),
facts AS (
  SELECT o_custkey,
         coalesce(string_agg(CAST(CAST(a AS DECIMAL(10,2)) AS VARCHAR), '|' ORDER BY a, l) FILTER (a IS NOT NULL), '') AS amounts,
         string_agg(l, '|' ORDER BY a IS NULL, a, l) AS labels, max(a) AS top,
         max(CASE WHEN k % 6 = 0 THEN {lit(rules.TARIFF_LAW_MARKER)} END) AS marker, min(CASE WHEN k % 3 = 0 THEN k END) AS step
  FROM items GROUP BY o_custkey)
SELECT CAST(c_custkey AS VARCHAR) AS CODIGO_TRAMITE, '2023-11-14 22:13:20' AS FECHA_ALTA_TRAMITE, true AS SIN_MODIFICACION,
       c_name AS NOMBRE, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment ELSE {lit(rules.PURPOSE_DEFAULT)} END AS FINALIDAD,
       CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_nationkey AS VARCHAR) ELSE {lit(rules.DEPENDENCY_DEFAULT)} END AS ID_DEPENDENCIA,
       amounts AS MONTO_COSTO, labels AS CONCEPTO_PAGO,
       CASE WHEN o_custkey IS NULL THEN NULL WHEN top > 0 THEN 'Y' ELSE 'N' END AS REQUIERE_PAGO,
       marker AS MARCO_NORMATIVO, 'https://turnos.example/' || step AS CANAL_TURNO
FROM customer LEFT JOIN facts ON o_custkey = c_custkey""")
