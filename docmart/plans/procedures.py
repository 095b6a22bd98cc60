"""The two jobs over content records with the awkward shapes that real snapshots have.

Each customer becomes a record, rendered row by row: several requirement blocks, with block ids
missing in half of the records, equal items within a block, a stray end tag before a list,
participants in a block of another type, payment labels in the url, steps with each kind of
link, blank titles and NULL owners. Records are landed twice on one day, and once more as a
stale copy whose ``changed`` has fewer digits. Both jobs run with their default arguments; the
queries return all staging and all consume tables as tagged rows, facts joined to their dimensions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmart import rules, schema
from docmart.plans import medallion
from docmart.plans.queries import price_text, query, table
from docmart.plans.queries import text_of as _text
from docmart.session import shared_dir, spread
from docmart.sources import landing
from docmart.streaming import upsert

NOTHING = "∅"
MORNING, EVENING = "2024-02-01 06:00:00", "2024-02-01 18:00:00"
EPOCH = 1_700_000_000
#: Links of the first step in turn: a platform, another, an excluded host, a file, any other.
LINKS = ("https://tad.buenosaires.gob.ar/t/{}", "https://www.agip.gob.ar/{}", "https://mapa.buenosaires.gob.ar/{}",
         "https://x.example/{}.pdf", "https://x.example/{}")
PAYMENTS = ("/pago-con-visa", "/rapipago", "")

_ITEM = "struct<id:string,type:string,fields:struct<field_name:string,field_price:string>>"
_STEPS = "array<struct<id:string,type:string,fields:struct<title:string,body:string>>>"


def _turn(n: Column, values: list[Column]) -> Column:
    """``values`` in turn by ``n``."""
    return F.element_at(F.array(*values), (n % len(values) + 1).cast("int"))


def _block(block_id: Column, kind: str, **fields: Column) -> Column:
    empty = {"title": F.lit(None).cast("string"), "body": F.lit(None).cast("array<string>"),
             "field_subtitulo": F.lit(None).cast("string"), "items": F.lit(None).cast(_ITEM),
             "field_items_paso_tramite": F.lit(None).cast(_STEPS)}
    return F.struct(block_id.alias("id"), F.lit(kind).alias("type"),
                    F.struct(*[fields.get(k, v).alias(k) for k, v in empty.items()]).alias("fields"))


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One content record per customer (RAW_SCHEMA), and ``changed`` still to be set."""
    c = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"))
    c = c.withColumn("n", F.col("c_custkey"))
    n, k, seg = F.col("n"), F.col("c_custkey").cast("string"), F.col("c_mktsegment")
    blank = F.lit(None).cast("string")
    given = lambda name: F.when(n % 2 == 1, F.lit(name))
    twice = _block(given("r1"), rules.BLOCK_REQUIREMENTS,
                   body=F.array(_text("<ul><li>Documento de {}</li><li>Documento de {}</li></ul>", k, k)),
                   field_subtitulo=F.when(n % 3 == 0, F.lit("Opcional")))
    nested = _block(
        given("r2"), rules.BLOCK_REQUIREMENTS, body=F.array(
            _text("</ul><ul><li>Persona Jurídica:<ul><li>Estatuto {}</li><li>Poder {} (opcional)</li></ul></li></ul>", k, k),
            _text('<h3>Documentación obligatoria</h3><ul><li>Formulario {}: copia</li>'
                  '<li><a href="https://x.example/m/{}">Planilla {}</a> firmada</li></ul>', k, k, k)))
    roles = _block(F.lit("p1"), "lista_items", field_subtitulo=F.lit(rules.PARTICIPANTS_SUBTITLE),
                   body=F.array(_text("<ul><li>Propietario, Tercero {}</li></ul>", seg)))
    price = F.when(n % 8 == 0, F.lit("Gratuito")).otherwise(price_text(F.abs("c_acctbal")))
    cost = _block(F.lit("c1"), rules.BLOCK_COSTS, items=F.struct(
        F.lit("i1").alias("id"), F.lit("item").alias("type"),
        F.struct(F.when(n % 6 != 0, seg).alias("field_name"), price.alias("field_price")).alias("fields")))
    norm = _block(F.lit("n1"), rules.BLOCK_PARAGRAPH, title=F.lit("Normativa aplicable"), body=F.array(
        F.when(n % 2 == 1, F.lit("<p>Ley tarifaria vigente</p>")).otherwise(F.lit("<p>Sin cambios</p>"))))
    link = _turn(n, [_text(x, k) for x in LINKS])
    step = lambda i, title, body: F.struct(F.lit(i).alias("id"), F.lit("paso").alias("type"),
                                           F.struct(title.alias("title"), body.alias("body")).alias("fields"))
    steps = _block(F.lit("s1"), rules.BLOCK_STEPS, field_items_paso_tramite=F.array(
        step("1", F.lit("Solicitar turno"), _text('<p>Pedí un turno en <a href="{}">acá</a></p>', link)),
        step("2", F.lit(""), blank)))
    body = F.when(n % 5 == 0, F.lit("")).otherwise(_text(
        "<p>Segmento {}{}</p>", seg, F.when(n % 2 == 0, F.lit(" Nivel 2")).otherwise(F.lit(""))))
    owner = F.when(n % 7 != 0, F.col("c_nationkey").cast("string"))
    org = F.struct(owner.alias("id"), F.struct(
        _text("<h3>Organismo</h3><p>Nación {}</p>", F.col("c_nationkey").cast("string")).alias("body")).alias("fields"))
    return c.select(
        k.alias("id"), F.lit("tramite").alias("type"), _text("Cliente {}", k).alias("title"),
        (F.lit(EPOCH) + n).cast("string").alias("created"),
        _text("/t/{}{}", k, _turn(n, [F.lit(x) for x in PAYMENTS])).alias("url"),
        F.struct(
            body.alias("body"), _text("Cliente {}", k).alias("title"), F.lit("es").alias("langcode"),
            F.lit(None).cast("struct<id:string,title:string,url:string>").alias("field_areas"),
            org.alias("field_organismos"),
            F.array(F.struct(F.when(n % 4 == 0, F.lit(rules.IN_PERSON_MODALITY)).otherwise(F.lit("1")).alias("target_id")))
            .alias("field_tramite_modalidad"),
            F.array(twice, nested, roles, cost, norm, steps).alias("field_content")).alias("fields"))


def _staged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    base = shared_dir(spark, "customers")
    rows = customer_records(spark, sf_dir)
    version = lambda changed: rows.withColumn("changed", F.lit(changed))
    old = F.lit("Viejo")
    landing.land_json(version("1700003600").withColumn("title", old), base + "/raw", MORNING)
    landing.land_json(version("1700003600").unionByName(version("999999999").withColumn("title", old)),
                      base + "/raw", EVENING)
    return medallion.raw_to_staging(spark, base + "/raw", base + "/staging")


def _tagged(name: str, df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    kinds = dict(df.dtypes)
    text = [F.array_join(c, ",") if kinds[c].startswith("array") else
            F.date_format(c, "yyyy-MM-dd HH:mm:ss") if kinds[c] == "timestamp" else F.col(c).cast("string") for c in columns]
    return df.select(F.lit(name).alias("tabla"), F.col(key).cast("string").alias("id"),
                     F.concat_ws("|", *[F.coalesce(x, F.lit(NOTHING)) for x in text]).alias("valores"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@query
def staging_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 (S1-S3, S11, D4, F3, G1-G5, P8): the nine staging tables of the customers' records."""
    return _staging_rows(_staged(spark, sf_dir))


@query
def incremental_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 + D4 + M6: two landings, each followed by an incremental run that mines only what is new. The second changes
    a third of the records and adds another; then the whole of it is delivered once more. The tables end as a full
    run makes them."""
    base = shared_dir(spark, "upsert")
    third = F.col("id").cast("long") % 3
    rows = customer_records(spark, sf_dir).withColumn("changed", F.lit("1700003600"))
    run = upsert.Upsert(spark, base + "/raw", base + "/tables", buckets=8)
    first = rows.filter(third < 2).withColumn("title", F.when(third == 1, "Viejo").otherwise(F.col("title")))
    landing.land_json(first, base + "/raw", MORNING)
    run.run()
    landing.land_json(rows.filter(third > 0), base + "/raw", EVENING)
    run.run()
    again = landing.scan_json(spark, base + "/raw", schema.RAW_SCHEMA)
    run.take(again.filter(F.col("time") == "t180000"), 1_000)
    return _staging_rows(run.staging())


def _staging_rows(s: dict[str, DataFrame]) -> DataFrame:
    t = "ID_TRAMITE"
    return _union([
        _tagged("tramites_base", s["tramites_base"], "CODIGO_TRAMITE", [
            "NOMBRE", "created", "changed", "FINALIDAD", "ID_DEPENDENCIA", "ID_TIPO_TRAMITE", "NIVEL_MIBA",
            "MEDIOS_PAGO_ARRAY", "MODALIDAD_IDS"]),
        _tagged("documentos", s["documentos"], t, [
            "ID_CONTENT_RAW", "ORDEN_BLOQUE", "NOMBRE_DOCUMENTO", "DESCRIPCION_DOCUMENTO", "DURACION_VALIDEZ",
            "TIENE_MODELO", "LINK_MODELO", "TIPO_DOCUMENTO"]),
        _tagged("pasos", s["pasos"], t, [
            "ORDEN_PASO", "TITULO_PASO_RAW", "DESCRIPCION_PASO_CLEAN", "NOMBRE_PLATAFORMA", "LINK_PLATAFORMA", "CANAL_TURNO",
            "INTERVINIENTE", "MOSTRAR_EN_PLATAFORMA"]),
        _tagged("requisitos_norm", s["requisitos_norm"], t, [
            "ID_CONTENT_RAW", "ORDEN_BLOQUE", "NOMBRE_REQUISITO", "OBLIGATORIEDAD", "PERSONA_FISICA", "ID_SUBGRUPO"]),
        _tagged("participantes", s["participantes"], t, ["NOMBRE_PARTICIPANTE"]),
        _tagged("costos", s["costos"], t, ["CONCEPTO", "PRECIO_STR"]),
        _tagged("dependencias", s["dependencias"], "ID_DEPENDENCIA", [
            "NOMBRE_DEPENDENCIA", "DESCRIPCION_DEPENDENCIA", "HORARIO_DEPENDENCIA", "DIRECCION_DEPENDENCIA"]),
        _tagged("marco_normativo", s["marco_normativo"], t, ["BODY_CLEAN"]),
        _tagged("tipo_tramite", s["tipo_tramite"], "ID_TIPO_TRAMITE", ["TITULO_TIPO_TRAMITE", "DESCRIPCION_ESTADO"]),
    ])


@query
def consume_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 (M1-M4, J1-J11): the sixteen consume tables; each fact is joined to its dimension by key."""
    c = medallion.staging_to_consume(spark, _staged(spark, sf_dir))
    t = "ID_TRAMITE"

    def fact(name: str, dim: str, key: str, columns: list[str]) -> DataFrame:
        names = [x for x in c[dim].columns if x == key or x not in c[name].columns]
        return _tagged(name, c[name].join(c[dim].select(*names), key), t, columns)

    plat = "ID_PLATAFORMA_DE_TRAMITACION"
    bridge = c["requisitos_tramites_documentos"].groupBy("GROUP_KEY", "ROLE").agg(
        F.countDistinct("MEMBER_KEY").alias("members"))
    return _union([
        _tagged("tipo_tramite", c["tipo_tramite"], "ID_TIPO_TRAMITE", ["TITULO_TIPO_TRAMITE", "DESCRIPCION_ESTADO"]),
        _tagged("dependencias", c["dependencias"], "ID_DEPENDENCIA", ["NOMBRE_DEPENDENCIA", "HORARIO_DEPENDENCIA"]),
        _tagged("participantes", c["participantes"], "ID_PARTICIPANTE", [
            "NOMBRE_PARTICIPANTE", "DESCRIPCION_PARTICIPANTE", "ES_PERSONA_FISICA", "ES_PROFESIONAL"]),
        fact("tramites_participantes", "participantes", "ID_PARTICIPANTE", ["NOMBRE_PARTICIPANTE"]),
        _tagged("documentos", c["documentos"], "ID_DOCUMENTO", [
            "NOMBRE_DOCUMENTO", "LINK_MODELO", "TIPO_DOCUMENTO", "DESCRIPCION_DOCUMENTO", "DURACION_VALIDEZ", "TIENE_MODELO"]),
        fact("tramites_documentos", "documentos", "ID_DOCUMENTO", ["NOMBRE_DOCUMENTO", "LINK_MODELO"]),
        _tagged("requisitos", c["requisitos"], "ID_REQUISITO", ["NOMBRE_REQUISITO", "OBLIGATORIEDAD", "DESCRIPCION_REQUISITO"]),
        fact("requisitos_tramites", "requisitos", "ID_REQUISITO", [
            "NOMBRE_REQUISITO", "OBLIGATORIEDAD", "PERSONA_FISICA", "ID_SUBGRUPO"]),
        _tagged("requisitos_tramites_documentos", bridge, "GROUP_KEY", ["ROLE", "members"]),
        _tagged("pasos", c["pasos"], "ID_PASO", ["TITULO_PASO", "DESCRIPCION_PASO"]),
        fact("tramites_pasos", "pasos", "ID_PASO", ["ORDEN_PASO", "INTERVINIENTE", "MOSTRAR_EN_PLATAFORMA", "TITULO_PASO"]),
        _tagged("plataforma_de_tramitacion", c["plataforma_de_tramitacion"], plat, [
            "NOMBRE_PLATAFORMA_DE_TRAMITACION", "LINK_AL_INICIO_DEL_TRAMITE", "MODALIDAD",
            "DESCRIPCION_PLATAFORMA_DE_TRAMITACION"]),
        fact("tramites_plataforma", "plataforma_de_tramitacion", plat, ["NOMBRE_PLATAFORMA_DE_TRAMITACION", "MODALIDAD"]),
        _tagged("medio_pago", c["medio_pago"], "ID_MEDIO_PAGO", ["NOMBRE_MEDIO_PAGO", "DESCRIPCION"]),
        fact("tramites_medio_pago", "medio_pago", "ID_MEDIO_PAGO", ["NOMBRE_MEDIO_PAGO"]),
        _tagged("tramites", c["tramites"], "CODIGO_TRAMITE", [
            "FECHA_ALTA_TRAMITE", "FECHA_ULT_MODIFICACION_TRAMITE", "NOMBRE", "FINALIDAD", "ID_DEPENDENCIA", "ID_TIPO_TRAMITE",
            "NIVEL_MIBA", "MONTO_COSTO", "CONCEPTO_PAGO", "REQUIERE_PAGO", "MARCO_NORMATIVO", "CANAL_TURNO",
            "FECHA_BAJA_TRAMITE", "TIEMPO_RESPUESTA_ESTIMADO", "CONCLUSION_TRAMITACION_DOC", "ID_TRAMITE"]),
    ])
