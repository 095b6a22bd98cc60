"""The miners over markup as editors leave it: quoted ``>``, raw-text elements, missing end tags, split headings,
nested lists and containers. Each supplier is rendered, row by row, as one page for each of the three miners."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmart.operators import html_tree, mining
from docmart.operators.extract import Rule, extract_table, heading
from docmart.plans.queries import query, table
from docmart.plans.queries import text_of as _text


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select("s_suppkey", F.col("s_suppkey").cast("string").alias("k"), (F.col("s_suppkey") % 3).alias("m"))


@query
def markup_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T9 on trees: a ``>`` in an attribute before the target, a heading split in two (which is none), a list in a
    text area, items without end tags, an item with its nested list's whole text."""
    s = _suppliers(spark, sf_dir)
    html = _text(
        '<h3>Documentación <b>obligatoria</b></h3><ul><li>Nada {}</li></ul>'
        '<textarea><h3>Documentación obligatoria</h3><ul><li>Borrador {}</li></ul></textarea>'
        '<div><h3><span>Documentación obligatoria</span></h3></div><section><ul>'
        '<li><a title="a > b" href=\'https://x.example/{}?a=1&amp;b=2\'>Planilla {}</a> firmada'
        '<li>Constancia {}: copia<ul><li>Sello {}</ul></ul></section>', *[F.col("k")] * 6)
    docs = mining.documentation(s.select("s_suppkey", html.alias("html")), "s_suppkey", "html")
    return docs.select("s_suppkey", "NOMBRE_DOCUMENTO", "DESCRIPCION_DOCUMENTO", "LINK_MODELO", "TIPO_DOCUMENTO")


@query
def markup_requirements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T10 on trees: items outside lists and in text areas are none, end tags are missing, one page in three has
    no list and gives paragraphs."""
    s = _suppliers(spark, sf_dir)
    listed = _text('<li>Suelto {}</li><title><ul><li>Oculto {}</li></ul></title><ul class="x>y"><li>Persona {}:'
                   '<ol><li>Estatuto<li>Poder (opcional)</ol><li>Nota<!-- <li>no</li> --> {}</ul><p>Un párrafo</p>', *[F.col("k")] * 4)
    bare = _text('<p data-a="<ul>">Presentar nota {}<p>miBA nivel 2<div>Fin</div>', F.col("k"))
    reqs = mining.requirements(s.select("s_suppkey", F.when(F.col("m") == 0, bare).otherwise(listed).alias("html")),
                               "s_suppkey", "html")
    return reqs.select("s_suppkey", "NOMBRE_REQUISITO", "OBLIGATORIEDAD", "PERSONA_FISICA")


@query
def markup_organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T13 on trees: containers around the blocks; a run of paragraphs ends with its container; a label
    without sibling paragraphs is taken by its own text."""
    s = _suppliers(spark, sf_dir)
    address = F.when(F.col("m") == 0, _text("<div><h3>Dirección</h3><p>Av. Lima {}<p>Piso 2</div><p>Otro dato</p>", F.col("k"))) \
        .otherwise(_text("<section><h3>Dirección: <i>Sede {}</i></h3></section><p>Otro dato</p>", F.col("k")))
    html = F.concat(F.lit("<article><header><h2>El <em>Organismo</em></h2></header><div><p></p><p>Ministerio "), F.col("k"),
                    F.lit("</p></div>"), address,
                    F.lit("<h3>Horario</h3><p>Lunes</p><p>Martes</p><div><p>Aviso</p></div></article>"))
    orgs = mining.organisations(s.select("s_suppkey", html.alias("html")), "s_suppkey", "html")
    return orgs.select("s_suppkey", "NOMBRE_DEPENDENCIA", "DIRECCION_DEPENDENCIA", "HORARIO_DEPENDENCIA", "DESCRIPCION_DEPENDENCIA")


@query
def markup_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1, H2, H4 on trees: every element of every page that holds a link with a target or is a heading, with its
    place, depth of lists, whole text and first target."""
    pages = html_tree.with_tree(table(spark, sf_dir, "supplier").select("s_suppkey", _text(
        '<div id="{}"><h2>Uno &amp; dos</h2><ul><li><a href="/{}">Ver</a> <b>más</b><li>x</ul><p>y<a name=n>z</div>',
        *[F.col("s_suppkey").cast("string")] * 2).alias("html")), "html")
    found = F.transform(html_tree.select(lambda e: (e["link"] >= 0) | e["href"].isNotNull() | e["tag"].rlike("^h[1-6]$")),
                        lambda e: F.struct(e["i"].alias("place"), e["last"].alias("last"), e["tag"].alias("tag"), e["depth"].alias("depth"),
                                           html_tree.text(e).alias("text"), html_tree.link_parts(e)[-1].alias("target")))
    rows = pages.select("s_suppkey", F.explode_outer(found).alias("e")).filter(F.col("e").isNotNull())
    return rows.select("s_suppkey", "e.*")


ITEM_RULES = [
    Rule("Requisito", anchor=heading("^requisitos$")),
    Rule("Contacto", anchor=heading("contacto"), target=("p",)),
    Rule("Suelto", unless=("Requisito",)),
    Rule("Celda", tags=("td", "th"), absent=("textarea",)),
]


@query
def extracted_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: items by a table of rules: a list and a paragraph behind headings, list items where there is no such heading, cells
    unless the page has a text area. One page in three lacks the heading, one the area."""
    s = _suppliers(spark, sf_dir)
    html = F.concat(
        _text("<h2>Trámite {}</h2><p>Intro</p>", F.col("k")), F.when(F.col("m") != 0, "<h3><b>REQUISITOS</b></h3>").otherwise(""),
        _text('<div><ul><li>DNI {}<li><a href="/f/{}">Formulario</a> firmado</ul></div><h3>Contacto</h3><i>x</i><p>Mail {}'
              "<table><tr><td>Celda {}</table>", *[F.col("k")] * 4), F.when(F.col("m") == 2, "<textarea><td>No</textarea>").otherwise(""))
    return extract_table(s.select("s_suppkey", html.alias("html")), ["s_suppkey"], "html", ITEM_RULES).drop("POS")
