"""DuckDB twins of ``plans.procedures``: plain selects over customer, no parsing."""

from __future__ import annotations

from docmart import rules
from docmart.plans import procedures as P
from docmart.plans import sqltext as S
from docmart.plans.sqltext import lit


def _row(name: str, key: str, *values: str, source: str = "c", where: str = "") -> str:
    text = ", ".join(f"coalesce(CAST({v} AS VARCHAR), '{P.NOTHING}')" for v in values)
    return f"SELECT '{name}' AS tabla, {key} AS id, concat_ws('|', {text}) AS valores FROM {source}" + (f" WHERE {where}" if where else "")


def _turn(values) -> str:
    cases = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"(CASE n % {len(values)} {cases} END)"


_LINK = _turn(["'" + x.replace("{}", "' || k || '") + "'" for x in P.LINKS])
_PLATFORM = "(CASE n % 5 WHEN 0 THEN 'TAD' WHEN 1 THEN 'AGIP' WHEN 4 THEN 'Plataforma Web' END)"
_PRICE = "CAST(CAST(abs(c_acctbal) AS DECIMAL(12,2)) AS VARCHAR)"
_PAY = "(CASE n % 3 WHEN 0 THEN 'Visa' WHEN 1 THEN 'Rapipago' END)"
_BODY = "(CASE WHEN n % 5 <> 0 THEN 'Segmento ' || s || CASE WHEN n % 2 = 0 THEN ' Nivel 2' ELSE '' END END)"
_LEVEL = "(CASE WHEN n % 5 <> 0 AND n % 2 = 0 THEN 2 END)"
_OWNER = "(CASE WHEN n % 7 <> 0 THEN CAST(c_nationkey AS VARCHAR) END)"

# Requirements of a record: block, name, obligatory, natural person.
_REQS = """reqs AS (
  SELECT c.*, r.* FROM c, (VALUES
    (0, 'Documento de ', '', 'x', 'Y'), (0, 'Documento de ', '', 'x', 'Y'),
    (1, 'Persona Jurídica: Estatuto ', '', 'Y', 'N'), (1, 'Persona Jurídica: Poder ', ' (opcional)', 'N', 'N'),
    (1, 'Formulario ', ': copia', 'Y', 'Y'), (1, 'Planilla ', ' firmada', 'Y', 'Y')) AS r(block, head, tail, flag, person))"""
_NAME = "(head || k || tail)"
_FLAG = "(CASE WHEN flag = 'x' THEN CASE WHEN n % 3 = 0 THEN 'N' ELSE 'Y' END ELSE flag END)"
_BLOCK_ID = "(CASE WHEN n % 2 = 1 THEN 'r' || (block + 1) END)"
# Documents of a record, roles of a record.
_DOCS = """docs AS (
  SELECT c.*, 'Formulario ' || k AS name, 'copia' AS descr, 'N' AS model, NULL AS link FROM c UNION ALL
  SELECT c.*, 'Planilla ' || k, 'firmada', 'Y', 'https://x.example/m/' || k FROM c)"""
_ROLES = "roles AS (SELECT c.*, unnest([{}]) AS name FROM c)".format(
    ", ".join(["'Propietario'", "'Tercero ' || s", *[lit(r) for r in rules.DEFAULT_ROLES]]))
_BASE = (f"WITH c AS (SELECT *, c_custkey AS n, CAST(c_custkey AS VARCHAR) AS k, c_mktsegment AS s FROM customer),\n"
         f"{_REQS},\n{_DOCS},\n{_ROLES}\n")
_STEP1, _STEP2 = "'Solicitar turno'", "'Pedí un turno en acá'"

STAGING = _BASE + "\nUNION ALL ".join([
    _row("tramites_base", "k", "'Cliente ' || k", f"{P.EPOCH} + n", "'1700003600'", _BODY, _OWNER, "'1'", _LEVEL,
         f"coalesce({_PAY}, '')", f"CASE WHEN n % 4 = 0 THEN '{rules.IN_PERSON_MODALITY}' ELSE '1' END"),
    _row("documentos", "k", "CASE WHEN n % 2 = 1 THEN 'r2' END", "1", "name", "descr", "NULL", "model", "link", "'Obligatoria'", source="docs"),
    _row("pasos", "k", "1", _STEP1, _STEP2, _PLATFORM, f"CASE WHEN {_PLATFORM} IS NOT NULL THEN {_LINK} END", _LINK, "NULL", "'S'"),
    _row("pasos", "k", "2", "''", "NULL", "NULL", "NULL", "NULL", "NULL", "'S'"),
    _row("requisitos_norm", "k", _BLOCK_ID, "block", _NAME, _FLAG, "person", "'GENERAL'", source="reqs"),
    _row("participantes", "k", "name", source="roles"),
    _row("costos", "k", "CASE WHEN n % 6 <> 0 THEN s END", f"CASE WHEN n % 8 = 0 THEN 'Gratuito' ELSE '$' || {_PRICE} END"),
    _row("dependencias", "org", "'Nación ' || org", "NULL", "'No especificado'", "NULL",
         source=f"(SELECT DISTINCT {_OWNER} AS org FROM c)", where="org IS NOT NULL"),
    _row("marco_normativo", "k", "CASE WHEN n % 2 = 1 THEN 'Ley tarifaria vigente' ELSE 'Sin cambios' END"),
    _row("tipo_tramite", "k", "'Cliente ' || k", _BODY),
])

_PLATS = f"""(SELECT {_PLATFORM} AS name, min({_LINK}) AS link, 'Web/Online' AS kind, 'Plataforma: ' || {_PLATFORM} AS descr
  FROM c WHERE {_PLATFORM} IS NOT NULL GROUP BY ALL UNION ALL
  SELECT 'Presencial', NULL, 'Presencial', 'Trámite presencial')"""
_ALL_STEPS = "(VALUES ('Solicitar turno', 'Pedí un turno en acá'), ('Paso del Trámite', 'Sin descripción')) AS v(title, descr)"
_STAMP = "strftime(to_timestamp({}) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S')"
_GROUP = f"(SELECT DISTINCT k, n, CASE WHEN n % 2 = 1 THEN 'r2' END AS block FROM c)"
_SET = lambda columns, source: f"(SELECT DISTINCT {columns} FROM {source})"

CONSUME = _BASE + "\nUNION ALL ".join([
    _row("tipo_tramite", "k", "'Cliente ' || k", _BODY),
    _row("dependencias", "org", "'Nación ' || org", "'No especificado'",
         source=f"(SELECT DISTINCT {_OWNER} AS org FROM c)", where="org IS NOT NULL"),
    _row("participantes", S.content_key("name"), "name", "'Rol: ' || name",
         f"regexp_matches(lower(name), {lit(rules.PERSON_ROLE_PATTERN)})",
         f"regexp_matches(lower(name), {lit(rules.PROFESSIONAL_ROLE_PATTERN)})", source=_SET("name", "roles")),
    _row("tramites_participantes", "k", "name", source="roles"),
    _row("documentos", S.content_key("name", "link", "'Obligatoria'"), "name", "link", "'Obligatoria'", "descr", "NULL", "model", source="docs"),
    _row("tramites_documentos", "k", "name", "link", source="docs"),
    _row("requisitos", S.content_key("name", "flag"), "name", "flag = 'Y'", "name",
         source=_SET(f"{_NAME} AS name, {_FLAG} AS flag", "reqs")),
    _row("requisitos_tramites", "k", _NAME, f"{_FLAG} = 'Y'", "person = 'Y'", "'GENERAL'", source="reqs"),
    _row("requisitos_tramites_documentos", S.content_key("k", "block"), "'left'", "CASE WHEN n % 2 = 1 THEN 4 ELSE 6 END", source=_GROUP),
    _row("requisitos_tramites_documentos", S.content_key("k", "block"), "'right'", "2", source=_GROUP),
    _row("pasos", S.content_key("title", "descr"), "title", "descr", source=_ALL_STEPS),
    _row("tramites_pasos", "k", "1", "NULL", "'S'", "'Solicitar turno'"),
    _row("tramites_pasos", "k", "2", "NULL", "'S'", "'Paso del Trámite'"),
    _row("plataforma_de_tramitacion", S.content_key("name"), "name", "link", "kind", "descr", source=_PLATS),
    _row("tramites_plataforma", "k", _PLATFORM, "'Web/Online'", where=f"{_PLATFORM} IS NOT NULL"),
    _row("tramites_plataforma", "k", "'Presencial'", "'Presencial'", where="n % 4 = 0"),
    _row("medio_pago", S.content_key("name"), "name", lit(rules.PAYMENT_DESCRIPTION),
         source=f"(SELECT DISTINCT {_PAY} AS name FROM c)", where="name IS NOT NULL"),
    _row("tramites_medio_pago", "k", _PAY, where=f"{_PAY} IS NOT NULL"),
    _row("tramites", "k", _STAMP.format(f"{P.EPOCH} + n"), _STAMP.format("1700003600"), "'Cliente ' || k",
         f"coalesce({_BODY}, 'Sin finalidad')", f"coalesce({_OWNER}, '0')", "'1'", _LEVEL,
         f"CASE WHEN n % 8 = 0 THEN '' ELSE {_PRICE} END", "CASE WHEN n % 6 = 0 THEN 'General' ELSE s END",
         "CASE WHEN n % 8 <> 0 AND abs(c_acctbal) >= 0.005 THEN 'Y' ELSE 'N' END",
         f"CASE WHEN n % 2 = 1 THEN {lit(rules.TARIFF_LAW_MARKER)} END", _LINK, "NULL", lit(rules.NOT_SPECIFIED), "NULL", "k"),
])
