"""Registered queries: each operator run over the given tables, whole.

Every query takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
are named exactly as in its oracle (``plans.oracles``). Where an operator
needs nested content or HTML, the content is rendered row by row from the
given tables inside the query (never by gathering a group), so the work grows
with the tables and no group is collected into one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmart import rules
from docmart.functions import text as X
from docmart.operators import html_rel, mining, routing, star
from docmart.sources import landing
from docmart.streaming import incremental
from docmart.session import shared_dir, spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed run timestamp for reproducible audited publishes.
RUN_TS = "2024-01-01 00:00:00"
# When the queries land their snapshots.
LANDING_TS = "2024-02-01 06:00:00"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def price_text(c) -> F.Column:
    """A price as text the way a CMS stores it: '$' + two decimals."""
    return F.concat(F.lit("$"), c.cast("decimal(12,2)").cast("string"))


def text_of(template: str, *values: F.Column) -> F.Column:
    """``template`` with its {} replaced by values."""
    parts = template.split("{}")
    out = [F.lit(parts[0])]
    for v, p in zip(values, parts[1:]):
        out += [v, F.lit(p)]
    return F.concat(*out)


# ---------------------------------------------------------------------------
# Text functions
# ---------------------------------------------------------------------------

@query
def html_clean(spark, sf_dir):
    """T1 over every page."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", X.clean_html("html").alias("text_clean"))


@query
def text_fold(spark, sf_dir):
    """T2 over every document."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", X.fold("text").alias("text_folded"))


@query
def body_text_decode(spark, sf_dir):
    """Each turn's lines as a JSON-array string (even turns) or plain text
    (odd turns), and as a list; all decoded back to one string."""
    conv = table(spark, sf_dir, "conversations")
    lines = F.split(F.col("text"), "\n")
    encoded = F.when(F.col("turn") % 2 == 0, F.to_json(lines)).otherwise(F.col("text"))
    return conv.select("conv_id", "turn",
                       X.body_text(encoded).alias("body"),
                       X.body_text(lines, is_array=True).alias("body_from_list"))


KEYWORD = "für"


@query
def keyword_gated_link(spark, sf_dir):
    """T3 with keyword 'für' and site-relative links ('/')."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", X.keyword_link("html", KEYWORD, "/").alias("CANAL_TURNO"))


@query
def list_roles(spark, sf_dir):
    """T4 + G3: roles named in each page's list items, one row each."""
    pages = table(spark, sf_dir, "pages")
    roles = pages.select("page_id", mining.participants("html").alias("roles"))
    return roles.select("page_id", F.explode_outer("roles").alias("NOMBRE_PARTICIPANTE"))


# The given texts name no payment method, platform, phone or person kind, so each row gets one
# cue in turn by its id (the last of a list is none); the whole text is kept.
PAYMENT_CUES = [label for label, _ in rules.PAYMENT_PATTERNS] + ["PAGO   FACIL", "visado", "pago<br>fácil", ""]
LINK_CUES = ["https://tad.buenosaires.gob.ar/a", "http://formulario-sigeci.buenosaires.gob.ar/b",
             "https://atencionvirtual.agcontrol.gob.ar", "https://login.buenosaires.gob.ar/auth?x=1&amp;y=2",
             "https://www.agip.gob.ar/c.pdf", "https://afip.gob.ar", "https://mapa.buenosaires.gob.ar/d",
             *[f"https://x.example/e.{ext}" for ext in rules.PLATFORM_FILE_EXTENSIONS], "https://x.example/f", "/g"]
PERSON_CUES = ["Persona Jurídica", "EMPRESA", "sociedad anónima", "Apoderado", "(Opcional)", "si  corresponde", ""]
PHONE_CUES = ["Teléfono: 4323-8000", "telefono del área 43238001", "Contacto 4323 800", "llamar al 54321-8000",
              "Comunicate al (011) 4323-8003", "fax 4323-8004", ""]


def cue(id_col: str, values: list[str]) -> F.Column:
    """One of ``values`` in turn by the row's id."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(id_col) % len(values) + 1).cast("int"))


def cued(id_col: str, text: str, values: list[str]) -> F.Column:
    return F.concat(cue(id_col, values), F.lit(" "), F.col(text))


@query
def label_dictionary(spark, sf_dir):
    """T5 + G4: payment-method labels found in each document, one row each."""
    docs = table(spark, sf_dir, "documents").withColumn("text", cued("doc_id", "text", PAYMENT_CUES))
    labels = docs.select("doc_id", X.payment_labels("text").alias("labels"))
    return labels.select("doc_id", F.explode_outer("labels").alias("NOMBRE_MEDIO_PAGO")) \
        .filter(F.col("NOMBRE_MEDIO_PAGO").isNotNull())


#: A dictionary of this many labels, one pattern each.
DICTIONARY_SIZE = 2000
TARIFF_PATTERNS = [(f"Tasa {k}", rf"\btasa\s*{k}\b") for k in range(DICTIONARY_SIZE)]


@query
def label_dictionary_large(spark, sf_dir):
    """T5 with a dictionary of thousands of labels: each order's note names one in one of several spellings, a second
    one, a longer number and a word that only begins like one."""
    o = table(spark, sf_dir, "orders")
    code = (F.col("o_orderkey") % DICTIONARY_SIZE).cast("string")
    other = (F.col("o_custkey") % DICTIONARY_SIZE).cast("string")
    spelling = F.element_at(F.array(*[F.lit(x) for x in ("<b>TASA</b> ", "Tàsa&nbsp;", "tasa", "tasa\\n", "tasar ")]),
                            (F.col("o_custkey") % 5 + 1).cast("int"))
    note = text_of("Abonar {}{}, tasa {}x y tasa {}0000; o bien (tasa {}). {}", spelling, code, code, code, other, F.col("o_orderpriority"))
    found = o.select("o_orderkey", X.payment_labels(note, TARIFF_PATTERNS).alias("labels"))
    return found.select("o_orderkey", F.array_join("labels", "|").alias("labels"))


@query
def url_classifier(spark, sf_dir):
    """T6 over each page's URL and over the first link of its HTML; C1 flag."""
    link = cue("page_id", LINK_CUES)
    pages = table(spark, sf_dir, "pages").withColumns({
        "url": F.when(F.col("page_id") % 2 == 0, link).otherwise(F.col("url")),
        "html": F.concat(F.lit('<a href="'), link, F.lit('">x</a> '), F.col("html"))})
    by_url = X.classify_link(F.col("url"))
    by_html = X.platform("html")
    return pages.select(
        "page_id",
        by_url["NOMBRE_PLATAFORMA"].alias("url_platform"),
        by_url["LINK_PLATAFORMA"].alias("url_link"),
        by_html["NOMBRE_PLATAFORMA"].alias("html_platform"),
        by_html["LINK_PLATAFORMA"].alias("html_link"),
        X.flag_by_regex("url", "^https://").alias("is_secure"),
    )


# In the whole-row JSON the props text is escaped: {"k": 6} reads {\"k\": 6}.
LEVEL_KEY = r'k\\":'


@query
def max_level(spark, sf_dir):
    """T7 + P8: highest digit after the key in the whole record serialised as JSON."""
    ev = table(spark, sf_dir, "events")
    record = F.to_json(F.struct("event_id", "event_type", "props"))
    return ev.select("event_id", X.max_level(record, LEVEL_KEY).alias("NIVEL_MIBA"))


@query
def title_clean(spark, sf_dir):
    """T8 over part names and whole document texts."""
    part = table(spark, sf_dir, "part").select(
        F.lit("part").alias("src"), F.col("p_partkey").alias("id"), X.clean_title("p_name").alias("title"))
    docs = table(spark, sf_dir, "documents").select(
        F.lit("doc").alias("src"), F.col("doc_id").alias("id"), X.clean_title("text").alias("title"))
    return part.unionByName(docs)


@query
def person_and_required_flags(spark, sf_dir):
    """T11 and T12 (language as the block subtitle) over every document."""
    docs = table(spark, sf_dir, "documents").withColumn("text", cued("doc_id", "text", PERSON_CUES))
    return docs.select("doc_id", X.person_flag("text").alias("PERSONA_FISICA"),
                       X.required_flag("text", F.col("lang")).alias("OBLIGATORIEDAD"))


@query
def contact_extract(spark, sf_dir):
    """T13a phone and T13b mail over every document."""
    docs = table(spark, sf_dir, "documents").withColumn("text", cued("doc_id", "text", PHONE_CUES))
    return docs.select("doc_id", X.phone("text").alias("TELEFONO_DEPENDENCIA"),
                       X.mail("text").alias("MAIL_ATENCION"))


# ---------------------------------------------------------------------------
# Routing, projections, generators
# ---------------------------------------------------------------------------

EVENT_ROUTES = {"clicks": "click", "views": "view", "purchases": "purchase"}


@query
def type_router(spark, sf_dir):
    """F1 on a nested record field (P1), F2 type-and-title, F3 exact subtitle."""
    ev = table(spark, sf_dir, "events").select(F.struct(
        F.col("event_id").alias("id"),
        F.struct(F.col("event_type").alias("type"), F.col("props").alias("body")).alias("content"),
    ).alias("rec"))
    events = ev.select(F.lit("events").alias("tbl"), F.col("rec.id").alias("id"),
                       routing.route_label("rec.content.type", EVENT_ROUTES).alias("route")).filter(F.col("route").isNotNull())
    # A document may take both routes: one scan, one row per route taken.
    taken = F.array(F.when(routing.title_contains("lang", "es", "text", "Para"), F.lit("es_para")),
                    F.when(F.col("source") == "src3", F.lit("src3")))
    docs = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("tbl"), F.col("doc_id").alias("id"), F.explode_outer(taken).alias("route"))
    return events.unionByName(docs.filter(F.col("route").isNotNull()))


@query
def nested_projection(spark, sf_dir):
    """P2, P3, G1 over each lineitem nested as a record with content blocks."""
    li = table(spark, sf_dir, "lineitem")
    block = lambda typ, title, body: F.struct(
        F.lit(typ).alias("type"), F.struct(F.lit(title).alias("title"), body.alias("body")).alias("fields"))
    rec = li.select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"),
        F.array(F.struct(F.col("l_partkey").cast("string").alias("target_id")),
                F.struct(F.col("l_suppkey").cast("string").alias("target_id"))).alias("modalidad"),
        F.array(block("price", "Precio", price_text(F.col("l_extendedprice"))),
                block("ship", "Envío", F.date_format("l_shipdate", "yyyy-MM-dd")),
                block("flag", "Estado", F.concat("l_returnflag", "l_linestatus"))).alias("field_content"))
    ids = F.array_join(F.col("modalidad.target_id"), ",")  # P2: array<struct> -> array<string>
    exploded = routing.explode_blocks(rec.withColumn("MODALIDAD_IDS", ids), "field_content",
                                      types=["price", "ship"])
    return exploded.select("id", "line", "MODALIDAD_IDS", F.col("content.type").alias("type"),
                           "content.fields.*")  # P3


@query
def steps_posexplode(spark, sf_dir):
    """G5 + F4 over each page's list items as ordered steps, with T1, T6 and T3 per step."""
    pages = table(spark, sf_dir, "pages")
    items = F.regexp_extract_all(F.col("html"), F.lit("(?is)<li>(.*?)</li>"), 1)
    steps = routing.explode_with_order(pages.withColumn("items", items), "items",
                                       "ORDEN_PASO", "paso", keep=["page_id"])
    plat = X.platform("paso")
    return steps.select(
        "page_id", "ORDEN_PASO",
        X.clean_html("paso").alias("DESCRIPCION_PASO_CLEAN"),
        plat["NOMBRE_PLATAFORMA"].alias("NOMBRE_PLATAFORMA"),
        plat["LINK_PLATAFORMA"].alias("LINK_PLATAFORMA"),
        X.keyword_link("paso", "the", "/").alias("CANAL_TURNO"),
    )


@query
def conditional_flags(spark, sf_dir):
    """C1-C4, C8 projections and F5, F6 filters over customers."""
    cust = table(spark, sf_dir, "customer")
    kept = cust.filter((F.length("c_name") > 5) & F.col("c_name").rlike("[0-9]{9}$"))
    pays = F.when(F.col("c_acctbal") > 0, "Y").otherwise("N")
    return kept.select(
        "c_custkey",
        pays.alias("TIENE_SALDO"),
        X.yn_to_bool(pays).alias("TIENE_SALDO_BOOL"),
        X.flag_by_regex("c_mktsegment", "machin|auto").alias("ES_INDUSTRIAL"),
        X.default_if_blank(F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")),
                           "Sin segmento").alias("SEGMENTO"),
        F.nullif(F.col("c_nationkey"), F.lit(0)).cast("int").alias("NACION"),
        F.coalesce(F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")), F.col("c_name"))
        .alias("SEGMENTO_O_NOMBRE"),
        F.col("c_nationkey").cast("string").alias("ID_NACION"),
    )


# ---------------------------------------------------------------------------
# Dimensions, facts, bridges
# ---------------------------------------------------------------------------

@query
def dim_hash_key(spark, sf_dir):
    """M1 + D2 + K2: (brand, type) dimension, fixed survivor (lowest part key)."""
    part = table(spark, sf_dir, "part")
    return star.build_dimension(part, ["p_brand", "p_type"], "DIM_KEY",
                                attrs=["p_partkey", "p_name", "p_size"], order_by=["p_partkey"])


def _doc_rows(spark, sf_dir):
    """Lineitems seen as documents: (record, name, link or NULL, type)."""
    part = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_brand").alias("NOMBRE_DOCUMENTO"),
        F.when(F.col("p_size") <= 40, F.col("p_type")).alias("LINK_MODELO"),
        F.when(F.col("p_retailprice") > 1500, "Obligatoria").otherwise("Opcional").alias("TIPO_DOCUMENTO"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                 "l_returnflag", "l_linestatus")
    return li.join(part, li.l_partkey == part.p_partkey, "inner")


DOC_KEY = ["NOMBRE_DOCUMENTO", "LINK_MODELO", "TIPO_DOCUMENTO"]


@query
def fact_null_safe(spark, sf_dir):
    """M2 + J2: document facts keep documents without link (NULL-safe key)."""
    rows = _doc_rows(spark, sf_dir)
    return star.build_fact(rows, DOC_KEY, ["l_orderkey"], "ID_DOCUMENTO")


@query
def fact_defaulted_key(spark, sf_dir):
    """J6 + C2: step facts whose blank titles and NULL texts take defaults first."""
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") <= 10, F.lit(None)).when(F.col("p_size") <= 20, F.lit(""))
        .otherwise(F.col("p_name")).alias("TITULO_PASO"),
        F.when(F.col("p_retailprice") < 1000, F.lit(None)).otherwise(F.col("p_type")).alias("DESCRIPCION_PASO"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    steps = li.join(part, li.l_partkey == part.p_partkey, "inner").withColumn(
        "DESCRIPCION_PASO", F.coalesce("DESCRIPCION_PASO", F.lit(rules.STEP_TEXT_DEFAULT)))
    return star.build_fact(steps, ["TITULO_PASO", "DESCRIPCION_PASO"],
                           ["l_orderkey", F.col("l_linenumber").alias("ORDEN_PASO")], "ID_PASO",
                           defaults={"TITULO_PASO": rules.STEP_TITLE_DEFAULT})


@query
def computed_key_join(spark, sf_dir):
    """Orders joined to a (priority, flag) dimension on a computed boolean key."""
    orders = table(spark, sf_dir, "orders")
    flag = F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N")
    dim = (orders.select(F.col("o_orderpriority").alias("NOMBRE_REQUISITO"), flag.alias("OBLIGATORIEDAD"))
           .distinct()
           .withColumn("ID_REQUISITO", X.content_key("NOMBRE_REQUISITO", "OBLIGATORIEDAD"))
           .withColumn("OBL_BOOL", X.yn_to_bool("OBLIGATORIEDAD")))
    fact = orders.select("o_orderkey", "o_orderpriority",
                         (F.col("o_orderstatus") == "F").alias("is_final"))
    joined = fact.join(dim, (fact.o_orderpriority == dim.NOMBRE_REQUISITO) & (fact.is_final == dim.OBL_BOOL))
    return joined.select("o_orderkey", "ID_REQUISITO", F.col("OBL_BOOL").alias("OBLIGATORIEDAD"))


@query
def block_bridge(spark, sf_dir):
    """M3 + J5: requirements and documents of the same (order, block), as a
    linear group bridge."""
    rows = _doc_rows(spark, sf_dir)
    return star.build_bridge_from(
        rows, ["l_orderkey", "l_returnflag"], X.content_key(F.col("l_partkey").cast("string")),
        F.when(F.col("l_linestatus") == "F", X.content_key(*DOC_KEY)))


PLATFORM_COLS = ["NOMBRE_PLATAFORMA_DE_TRAMITACION", "LINK_AL_INICIO_DEL_TRAMITE", "MODALIDAD",
                 "DESCRIPCION_PLATAFORMA_DE_TRAMITACION"]


def in_person_member(spark) -> DataFrame:
    """The one-row default member."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in PLATFORM_COLS])
    return spark.createDataFrame([rules.IN_PERSON_MEMBER], schema)


@query
def dim_default_member(spark, sf_dir):
    """U1 + S9 + P7: platform dimension from nations plus the in-person member."""
    nation = table(spark, sf_dir, "nation")
    web = nation.select(
        F.col("n_name").alias("NOMBRE_PLATAFORMA_DE_TRAMITACION"),
        F.concat(F.lit("https://"), F.lower("n_name"), F.lit(".example/")).alias("LINK_AL_INICIO_DEL_TRAMITE"),
        F.col("n_regionkey").alias("REGION"),
    ).distinct().withColumn("MODALIDAD", F.lit(rules.PLATFORM_WEB_MODALITY)).withColumn(
        "DESCRIPCION_PLATAFORMA_DE_TRAMITACION",
        F.concat(F.lit(rules.PLATFORM_PREFIX), F.col("NOMBRE_PLATAFORMA_DE_TRAMITACION")))
    dim = web.unionByName(in_person_member(spark), allowMissingColumns=True)
    return dim.withColumn("ID_PLATAFORMA_DE_TRAMITACION", X.content_key("NOMBRE_PLATAFORMA_DE_TRAMITACION"))


URGENT = "1-URGENT"


@query
def fact_two_origins(spark, sf_dir):
    """U2 + U3 + F7: platform facts from final orders, plus in-person facts for
    orders whose code list holds the urgent code; the in-person key is a constant."""
    orders = table(spark, sf_dir, "orders")
    web = orders.filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("ID_TRAMITE"),
        X.content_key("o_orderpriority").alias("ID_PLATAFORMA_DE_TRAMITACION"))
    codes = F.array("o_orderstatus", "o_orderpriority")
    in_person = orders.filter(routing.array_has(codes, URGENT)).select(
        F.col("o_orderkey").alias("ID_TRAMITE"),
        F.lit(X.literal_key(rules.IN_PERSON_MEMBER[0])).alias("ID_PLATAFORMA_DE_TRAMITACION"))
    return web.union(in_person).distinct()


@query
def label_bridge(spark, sf_dir):
    """J8 + G4 + D1: document labels exploded, keyed, distinct."""
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    arr = F.filter(F.array(F.when(F.col("quality") == 1, F.lit("quality")),
                           F.when(F.col("toxic") == 1, F.lit("toxic")),
                           F.concat(F.lit("lang:"), F.col("lang"))), lambda x: x.isNotNull())
    rows = labels.join(docs, "doc_id").select("doc_id", F.explode_outer(arr).alias("NOMBRE_MEDIO_PAGO")) \
        .filter(F.col("NOMBRE_MEDIO_PAGO").isNotNull())
    return star.build_fact(rows, ["NOMBRE_MEDIO_PAGO"], ["doc_id", "NOMBRE_MEDIO_PAGO"], "ID_MEDIO_PAGO")


# ---------------------------------------------------------------------------
# Aggregates and the wide main table
# ---------------------------------------------------------------------------

def _costs(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("ID_TRAMITE"),
        F.coalesce(F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")),
                   F.lit(rules.COST_DEFAULT_CONCEPT)).alias("CONCEPTO"),
        F.when(F.col("l_discount") == 0, F.lit("Gratuito")).otherwise(price_text(F.col("l_extendedprice")))
        .alias("PRECIO_STR"))


def _emit_rollup(df: DataFrame, key: str) -> DataFrame:
    return df.select(
        key,
        F.array_join(F.transform("MONTO_COSTO", lambda x: x.cast("string")), "|").alias("MONTO_COSTO"),
        F.array_join("CONCEPTO_PAGO", "|").alias("CONCEPTO_PAGO"),
        F.col("MAX_COSTO").cast("string").alias("MAX_COSTO"),
        "REQUIERE_PAGO")


@query
def cost_rollup(spark, sf_dir):
    """A1 + C6: per order, sorted price and concept lists, highest price, pay flag."""
    costs = _costs(spark, sf_dir).withColumn("PRECIO_DEC", X.decimal_from_text("PRECIO_STR"))
    agg = star.list_rollup(costs, "ID_TRAMITE", "PRECIO_DEC", "CONCEPTO",
                           "MONTO_COSTO", "CONCEPTO_PAGO", "MAX_COSTO", "REQUIERE_PAGO")
    return _emit_rollup(agg, "ID_TRAMITE")


SECRET_PATTERN = r"token\s*=|api[_-]?key"


@query
def presence_marker(spark, sf_dir):
    """A2: per source, a marker when any document matches the pattern."""
    docs = table(spark, sf_dir, "documents")
    return star.presence_marker(docs, "source", "text", SECRET_PATTERN, "Contiene secretos", "MARCADOR")


@query
def first_by_order(spark, sf_dir):
    """A3: per user, the type of the earliest event (ties by event id)."""
    ev = table(spark, sf_dir, "events")
    return star.first_by(ev, "user_id", "event_type", ["ts", "event_id"], "PRIMER_TIPO")


def _epoch_text(c):
    return F.unix_timestamp(c).cast("string")


def _order_costs(orders, *more):
    return orders.select(
        F.col("o_custkey").alias("CODIGO_TRAMITE"), F.col("o_orderkey").alias("ID_PEDIDO"),
        F.col("o_orderpriority").alias("CONCEPTO"),
        X.decimal_from_text(price_text(F.col("o_totalprice"))).alias("PRECIO_DEC"), *more)


@query
def wide_main_costs(spark, sf_dir):
    """A1 as long rows: every order as a cost item of its customer, without a shuffle."""
    costs = _order_costs(table(spark, sf_dir, "orders"))
    return costs.select("CODIGO_TRAMITE", "ID_PEDIDO", "CONCEPTO", F.col("PRECIO_DEC").cast("string").alias("COSTO"))


@query
def wide_main_table(spark, sf_dir):
    """M4 (J9-J11, C5, C7, P4-P6, P9): customers with their order costs, an
    urgent-order marker and first/last order dates, as one wide table."""
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CODIGO_TRAMITE"), F.col("c_name").alias("NOMBRE"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("FINALIDAD"),
        F.when(F.col("c_nationkey") != 0, F.col("c_nationkey").cast("string")).alias("ID_DEPENDENCIA"))
    orders = table(spark, sf_dir, "orders")
    costs = _order_costs(orders, "o_orderdate", "o_orderkey")
    first = F.struct("o_orderdate", "o_orderkey")
    # Every order is in the lists; marker and dates are taken in the same pass over the orders.
    facts = star.list_rollup(
        costs, "CODIGO_TRAMITE", "PRECIO_DEC", "CONCEPTO", "MONTO_COSTO", "CONCEPTO_PAGO", "MAX_COSTO", "REQUIERE_PAGO",
        also={"MARCO_NORMATIVO": F.max(F.when(F.lower("CONCEPTO").rlike("urgent"), "Tiene pedidos urgentes")),
              "created": F.min_by(_epoch_text(F.col("o_orderdate")), first),
              "changed": F.max_by(_epoch_text(F.col("o_orderdate")), first)})
    wide = star.enrich_main(
        cust, "CODIGO_TRAMITE", [facts],
        fills={"FINALIDAD": rules.PURPOSE_DEFAULT, "ID_DEPENDENCIA": rules.DEPENDENCY_DEFAULT},
        constants={"FECHA_ALTA_TRAMITE": X.timestamp_from_epoch_text("created"),
                   "FECHA_ULT_MODIFICACION_TRAMITE": X.timestamp_from_epoch_text("changed"),
                   "ID_TIPO_TRAMITE": F.lit(rules.PROCEDURE_TYPE_DEFAULT),
                   "FECHA_BAJA_TRAMITE": F.lit(None).cast("timestamp"),
                   "TIEMPO_RESPUESTA_ESTIMADO": F.lit(rules.NOT_SPECIFIED),
                   "CONCLUSION_TRAMITACION_DOC": F.lit(None).cast("string")})
    ts = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return wide.select(
        "CODIGO_TRAMITE", ts("FECHA_ALTA_TRAMITE"), ts("FECHA_ULT_MODIFICACION_TRAMITE"), "NOMBRE",
        "FINALIDAD", "ID_DEPENDENCIA", "ID_TIPO_TRAMITE",
        F.array_join(F.transform("MONTO_COSTO", lambda x: x.cast("string")), "|").alias("MONTO_COSTO"),
        F.array_join("CONCEPTO_PAGO", "|").alias("CONCEPTO_PAGO"),
        "REQUIERE_PAGO", "MARCO_NORMATIVO", ts("FECHA_BAJA_TRAMITE"), "TIEMPO_RESPUESTA_ESTIMADO",
        "CONCLUSION_TRAMITACION_DOC", F.col("CODIGO_TRAMITE").alias("ID_TRAMITE"))


# ---------------------------------------------------------------------------
# Snapshots, retention, landing, publishing, streaming
# ---------------------------------------------------------------------------

def _ts_text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


@query
def latest_snapshot(spark, sf_dir):
    """D4 + S3: the latest event of each user."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    latest = star.latest_per_key(ev, ["user_id"], ["ts", "event_id"])
    return latest.select("user_id", "event_id", _ts_text("ts").alias("ts"), "event_type", "value")


RETENTION_DAYS = 7


@query
def retention_window(spark, sf_dir):
    """Events newer than the newest event minus 7 days."""
    ev = table(spark, sf_dir, "events")
    kept = landing.retention(ev, F.col("ts"), RETENTION_DAYS)
    return kept.select("event_id", "user_id", "event_type")


@query
def audit_publish(spark, sf_dir):
    """M5 (S7, S8, S12) twice on the same table (S6: the rerun replaces it)."""
    region = table(spark, sf_dir, "region")
    path = shared_dir(spark, "audit_publish") + "/region"
    landing.publish(spark, region, "docmart", "region_audit", path, RUN_TS)
    out = landing.publish(spark, region, "docmart", "region_audit", path, RUN_TS)
    return out.select("r_regionkey", "r_name", "insert_into_dl_timestamp")




@query
def land_and_scan_json(spark, sf_dir):
    """S1 + S2 + S5: land events as dated JSON, scan them back with a fixed schema."""
    ev = table(spark, sf_dir, "events")
    root = shared_dir(spark, "landing") + "/events"
    landing.land_json(ev, root, LANDING_TS, day_col="ts")
    back = landing.scan_json(spark, root, ev.schema)
    return back.select("event_id", _ts_text("ts").alias("ts"), "user_id", "event_type", "value", "props",
                       "year", "month", "day")


@query
def expired_landing(spark, sf_dir):
    """Events landed by day; folders of expired days are removed by the listing alone, and a scan
    with retention opens no others."""
    ev = table(spark, sf_dir, "events")
    root = shared_dir(spark, "expired") + "/events"
    landing.land_json(ev, root, LANDING_TS, day_col="ts")
    landing.expire(spark, root, 2 * RETENTION_DAYS)
    kept = landing.retained(spark, root, landing.scan_json(spark, root, ev.schema), RETENTION_DAYS)
    return kept.select("event_id", "user_id", "event_type", "year", "month", "day")


SPLIT_TS = "2024-01-15 00:00:00"


@query
def incremental_landing(spark, sf_dir):
    """Two landings, each followed by an availableNow stream run; the sink
    ends with every event exactly once."""
    ev = table(spark, sf_dir, "events")
    base = shared_dir(spark, "incremental")
    src, sink, ckpt = base + "/landing", base + "/sink", base + "/checkpoint"
    first = F.col("ts") < F.lit(SPLIT_TS).cast("timestamp")
    ev.filter(first).write.mode("append").parquet(src + "/batch=1")
    incremental.ingest_available(spark, src, sink, ckpt, ev.schema)
    ev.filter(~first).write.mode("append").parquet(src + "/batch=2")
    incremental.ingest_available(spark, src, sink, ckpt, ev.schema)
    out = spark.read.schema(ev.schema).parquet(sink)
    return out.select("event_id", "user_id", "event_type", "value")


# ---------------------------------------------------------------------------
# Relational HTML mining
# ---------------------------------------------------------------------------

@query
def token_table(spark, sf_dir):
    """H1 over every page."""
    pages = table(spark, sf_dir, "pages")
    return html_rel.html_tokens(pages, "page_id", "html").select("page_id", "pos", "kind", "tag", "tok", "href")


@query
def list_items(spark, sf_dir):
    """H2 over every page: list items with depth, parent, texts and first link."""
    pages = table(spark, sf_dir, "pages")
    items = html_rel.list_items(html_rel.html_tokens(pages, "page_id", "html"), "page_id")
    return items.select("page_id", "li_pos", "list_pos", "list_end", "depth", "parent_li", "own_text",
                        "full_text", "link_text", "rest_text", "href", "has_list")


def money(c):
    return c.cast("decimal(12,2)").cast("string")


def _supplier_geo(spark, sf_dir):
    sup = table(spark, sf_dir, "supplier")
    nat = table(spark, sf_dir, "nation")
    reg = table(spark, sf_dir, "region")
    return (sup.join(nat, sup.s_nationkey == nat.n_nationkey, "left")
               .join(reg, nat.n_regionkey == reg.r_regionkey, "left"))


@query
def requirements_flatten(spark, sf_dir):
    """H3 + T10 + T11 + T12 over each supplier rendered as a nested list
    (region > nation > supplier), or as paragraphs when its balance is negative."""
    s = _supplier_geo(spark, sf_dir)
    optional = F.when(F.col("s_acctbal") < 1000, F.lit(" (opcional)")).otherwise(F.lit(""))
    nested = F.concat(
        F.lit("<ul><li>"), F.col("r_name"), F.lit(":<ul><li>"), F.col("n_name"), F.lit("<ul><li>"), F.col("s_name"),
        F.lit("</li><li>Saldo "), money(F.col("s_acctbal")), optional, F.lit("</li></ul></li></ul></li><li>Empresa "),
        F.col("s_suppkey").cast("string"), F.lit("</li></ul>"))
    paras = F.concat(F.lit("<p>Presentar nota de "), F.col("s_name"), F.lit("</p><p>miBA nivel 2</p><p>abc</p>"))
    docs = s.select("s_suppkey", F.when(F.col("s_acctbal") >= 0, nested).otherwise(paras).alias("html"))
    reqs = mining.requirements(docs, "s_suppkey", "html")
    return reqs.select("s_suppkey", "NOMBRE_REQUISITO", "OBLIGATORIEDAD", "PERSONA_FISICA", "ID_SUBGRUPO")


@query
def documentation_catalogue(spark, sf_dir):
    """T9 + T8 over each order rendered as an obligatory list (plain,
    named-link and generic-link items) and an optional paragraph."""
    o = table(spark, sf_dir, "orders")
    first = F.when(F.col("o_totalprice") > 200000, F.lit("y copia del pedido ")).otherwise(F.lit("Pedido "))
    html = F.concat(
        F.lit("<h3>Documentación obligatoria</h3><ul><li>"), first, F.col("o_orderkey").cast("string"),
        F.lit(": prioridad "), F.col("o_orderpriority"),
        F.lit('</li><li><a href="https://x.example/c/'), F.col("o_custkey").cast("string"),
        F.lit('.pdf">Formulario '), F.col("o_custkey").cast("string"), F.lit("</a> firmado</li><li>Comprobante "),
        F.col("o_orderkey").cast("string"), F.lit(' (<a href="https://x.example/o/'), F.col("o_orderkey").cast("string"),
        F.lit('">descargar</a>)</li></ul><h3>Documentación opcional</h3><p>Nota del '),
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("</p>"))
    docs = mining.documentation(o.select("o_orderkey", html.alias("html")), "o_orderkey", "html")
    return docs.select("o_orderkey", "NOMBRE_DOCUMENTO", "DESCRIPCION_DOCUMENTO", "TIENE_MODELO", "LINK_MODELO",
                       "TIPO_DOCUMENTO")


@query
def organisation_profile(spark, sf_dir):
    """T13 over each supplier rendered as an organisation page."""
    s = _supplier_geo(spark, sf_dir)
    key = F.col("s_suppkey").cast("string")
    addr = F.when(F.col("s_acctbal") >= 0,
                  F.concat(F.lit("<h3>Dirección</h3><p>Av. Corrientes "), (F.col("s_suppkey") + 100).cast("string"),
                           F.lit("</p>"))) \
        .otherwise(F.concat(F.lit("<p>Calle Defensa "), (F.col("s_suppkey") + 100).cast("string"), F.lit("</p>")))
    hours = F.when(F.col("n_regionkey") == 0, F.lit("<h3>Días de atención</h3><p>Lunes y martes</p><p>de 8 a 12</p>")) \
        .otherwise(F.lit("<h3>Horario</h3><p>Lunes a viernes de 9 a 15</p>"))
    html = F.concat(
        F.lit("<h3>Organismo</h3><p>Ministerio de "), F.col("n_name"), F.lit("</p>"), addr, hours,
        F.lit("<h4>Contacto</h4><p>Teléfono: 4323-"), (F.col("s_suppkey") % 9000 + 1000).cast("string"),
        F.lit(" contacto"), key, F.lit("@x.gob.ar</p>"))
    orgs = mining.organisations(s.select("s_suppkey", html.alias("html")), "s_suppkey", "html")
    return orgs.select("s_suppkey", *mining.ORG_COLUMNS)


def _supplier_sections(spark, sf_dir):
    """Each supplier as a page of headings, paragraph runs (broken by a block where the balance
    is negative) and text outside any section."""
    s = _supplier_geo(spark, sf_dir)
    broken = F.when(F.col("s_acctbal") < 0, F.lit("<div>Aviso</div>")).otherwise(F.lit(""))
    html = F.concat(
        F.lit("<p>Intro "), F.col("r_name"), F.lit("</p><h2>Nación</h2><p>"), F.col("n_name"), F.lit("</p>"), broken,
        F.lit("<p>Cliente "), F.col("s_suppkey").cast("string"), F.lit("</p><h3>Saldo</h3><p>"), money(F.col("s_acctbal")),
        F.lit("</p><div>Fin</div>"))
    toks = html_rel.html_tokens(s.select("s_suppkey", html.alias("html")), "s_suppkey", "html")
    return html_rel.elements(toks, "s_suppkey")


@query
def page_sections(spark, sf_dir):
    """H4: every element with its section heading and whether it belongs to the heading's run."""
    sec = html_rel.heading_sections(_supplier_sections(spark, sf_dir), "s_suppkey")
    return sec.select("s_suppkey", "tag", "text", "section_heading", "in_run")


@query
def page_residual(spark, sf_dir):
    """H5: what is left of each page without its headings and their runs."""
    elems = _supplier_sections(spark, sf_dir)
    sec = html_rel.heading_sections(elems, "s_suppkey")
    used = sec.filter(F.coalesce(F.col("in_run"), F.lit(False)) | F.col("tag").isin(html_rel.HEADING_TAGS))
    return html_rel.residual_text(elems, used, "s_suppkey")


# ---------------------------------------------------------------------------
# The two jobs end to end (M6) on records derived from the given tables
# ---------------------------------------------------------------------------

def order_records(spark, sf_dir):
    """Each order as a nested content record (RAW_SCHEMA), built row by row:
    body with the priority (and a level for final orders), the customer as the
    owning organisation, the urgent modality, and three blocks: a cost item, a
    norms paragraph (tariff law for final orders) and one appointment step."""
    o = spread(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"))
    key = F.col("o_orderkey").cast("string")
    final = F.col("o_orderstatus") == "F"
    epoch = F.unix_timestamp("o_orderdate")
    block = lambda bid, typ, fields: F.struct(F.lit(bid).alias("id"), F.lit(typ).alias("type"), fields.alias("fields"))
    empty = {"title": F.lit(None).cast("string"), "body": F.lit(None).cast("array<string>"),
             "field_subtitulo": F.lit(None).cast("string"),
             "items": F.lit(None).cast("struct<id:string,type:string,fields:struct<field_name:string,field_price:string>>"),
             "field_items_paso_tramite": F.lit(None).cast(
                 "array<struct<id:string,type:string,fields:struct<title:string,body:string>>>")}

    def fields(**kw):
        return F.struct(*[(kw.get(k, v)).alias(k) for k, v in empty.items()])

    cost = block("c1", rules.BLOCK_COSTS, fields(items=F.struct(
        F.lit("i1").alias("id"), F.lit("item").alias("type"),
        F.struct(F.col("o_orderpriority").alias("field_name"), price_text(F.col("o_totalprice")).alias("field_price"))
        .alias("fields"))))
    norm = block("c2", rules.BLOCK_PARAGRAPH, fields(
        title=F.lit("Normativa aplicable"),
        body=F.array(F.when(final, F.lit("<p>Ley tarifaria vigente</p>")).otherwise(F.lit("<p>Sin cambios</p>")))))
    step_body = F.concat(F.lit('<p>Pedí un turno en <a href="https://tad.buenosaires.gob.ar/t/'), key,
                         F.lit('">TAD</a></p>'))
    step = block("c3", rules.BLOCK_STEPS, fields(field_items_paso_tramite=F.array(F.struct(
        F.lit("s1").alias("id"), F.lit("paso").alias("type"),
        F.struct(F.lit("Solicitar turno").alias("title"), step_body.alias("body")).alias("fields")))))
    org_html = F.concat(F.lit("<h3>Organismo</h3><p>Cliente "), F.col("o_custkey").cast("string"), F.lit("</p>"))
    return o.select(
        key.alias("id"), F.lit("tramite").alias("type"), F.concat(F.lit("Pedido "), key).alias("title"),
        epoch.cast("string").alias("created"), (epoch + 3600).cast("string").alias("changed"),
        F.concat(F.lit("/t/"), key).alias("url"),
        F.struct(
            F.concat(F.lit("<p>Prioridad "), F.col("o_orderpriority"),
                     F.when(final, F.lit(" Nivel 2")).otherwise(F.lit("")), F.lit("</p>")).alias("body"),
            F.concat(F.lit("Pedido "), key).alias("title"), F.lit("es").alias("langcode"),
            F.lit(None).cast("struct<id:string,title:string,url:string>").alias("field_areas"),
            F.struct(F.col("o_custkey").cast("string").alias("id"), F.struct(org_html.alias("body")).alias("fields"))
            .alias("field_organismos"),
            F.array(F.struct(F.when(F.col("o_orderpriority") == URGENT, F.lit(rules.IN_PERSON_MODALITY))
                             .otherwise(F.lit("1")).alias("target_id"))).alias("field_tramite_modalidad"),
            F.array(cost, norm, step).alias("field_content"),
        ).alias("fields"))


@query
def procedures_main_table(spark, sf_dir):
    """M6: orders as nested records -> landed as dated JSON (S1) -> raw_to_staging
    -> staging_to_consume; the wide main table, arrays and timestamps as text."""
    from docmart.plans import medallion

    base = shared_dir(spark, "procedures")
    # A record as JSON is many times as large as its order.
    landing.land_json(order_records(spark, sf_dir), base + "/raw", LANDING_TS, compression="gzip")
    staging = medallion.raw_to_staging(spark, base + "/raw", base + "/staging")
    main = medallion.staging_to_consume(spark, staging)["tramites"]
    ts = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return main.select(
        "CODIGO_TRAMITE", ts("FECHA_ALTA_TRAMITE"), ts("FECHA_ULT_MODIFICACION_TRAMITE"), "NOMBRE", "FINALIDAD",
        "ID_DEPENDENCIA", "ID_TIPO_TRAMITE", "NIVEL_MIBA",
        F.array_join(F.transform("MONTO_COSTO", lambda x: x.cast("string")), "|").alias("MONTO_COSTO"),
        F.array_join("CONCEPTO_PAGO", "|").alias("CONCEPTO_PAGO"), "REQUIERE_PAGO", "MARCO_NORMATIVO",
        "CANAL_TURNO", ts("FECHA_BAJA_TRAMITE"), "TIEMPO_RESPUESTA_ESTIMADO", "CONCLUSION_TRAMITACION_DOC",
        "ID_TRAMITE")


# The two jobs over awkward records register themselves.
from docmart.plans import copartition, markup, procedures, snapshots  # noqa: E402, F401
