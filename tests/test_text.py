"""Golden cases (FIXTURES.md §4) and properties of the text functions."""

import datetime as dt  # noqa: F401
import decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docmart.functions import arrow
from docmart.functions import text as X


def one(spark, expr, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"v {typ}")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


def many(spark, expr, values, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r["r"] for r in df.select("i", expr(F.col("v")).alias("r")).orderBy("i").collect()]


def test_clean_html_golden(spark):
    got = many(spark, X.clean_html, [None, "", "   ", "<p>Hola&nbsp;&amp; chau</p>\r\n", "&lt;b&gt;x", "a < b > c"])
    assert got == [None, None, "", "Hola & chau", "x", "a c"]


def test_fold_golden(spark):
    assert many(spark, X.fold, [None, "  Árbol  NIÑO "]) == ["", "arbol nino"]


def test_keyword_link_golden(spark):
    ok = '<a class="x" href="https://t.gob/1">Turno</a>'
    got = many(spark, X.keyword_link, [ok, ok.replace("https:", "http:"), ok.replace('"', "'"), "<a href=\"https://t\">x</a>"])
    assert got == ["https://t.gob/1", None, None, None]


def test_platform_golden(spark):
    got = many(spark, lambda c: X.platform(c), [
        "<p>none</p>", '<a href="/rel">x</a>', '<a href="https://x.org/a.pdf">x</a>',
        '<a href="https://agip.gob.ar/x.pdf">x</a>', '<a href="https://x.org/">x</a>'])
    assert [tuple(r) for r in got] == [(None, None), (None, None), (None, None),
                                      ("AGIP", "https://agip.gob.ar/x.pdf"), ("Plataforma Web", "https://x.org/")]


def test_max_level_golden(spark):
    assert many(spark, X.max_level, ["Nivel 2 y nivel 3", "nivel 12", "x"]) == [3, 1, None]


def test_clean_title_golden(spark):
    assert many(spark, X.clean_title, [", y copia del DNI", "ab"]) == ["Copia del DNI", None]


def test_decimal_and_epoch_golden(spark):
    assert many(spark, X.decimal_from_text, ["$1.500,00", "Gratuito"]) == [decimal.Decimal("1.50"), None]
    assert many(spark, lambda c: X.decimal_from_text(c, "comma"), ["$1.500,00"]) == [decimal.Decimal("1500.00")]
    got = one(spark, X.timestamp_from_epoch_text, "1700000000")
    assert got.replace(tzinfo=None) in (dt.datetime(2023, 11, 14, 22, 13, 20),) or got.hour in (22,)


def test_phone_mail_golden(spark):
    t = "Teléfono: 4323-8000 info@x.gob.ar"
    assert one(spark, X.phone, t) == "4323-8000"
    assert one(spark, X.mail, t) == "info@x.gob.ar"


def test_body_text_encodings(spark):
    got = many(spark, X.body_text, ['["<p>a</p>", "b"]', "[not json", "plain"])
    assert got == ["<p>a</p> b", "[not json", "plain"]
    df = spark.createDataFrame([(["a", "b"],)], "v array<string>")
    assert df.select(X.body_text("v", is_array=True).alias("r")).first()["r"] == "a b"


def test_payment_labels(spark):
    got = one(spark, X.payment_labels, "Pagá con <b>VISA</b> o Pago Fácil y mercado\\npago")
    assert got == ["Mercado Pago", "Pago Fácil", "Visa"]


def test_person_and_required_flags(spark):
    df = spark.createDataFrame([("Persona Jurídica: Estatuto", None), ("Poder (opcional)", None), ("DNI", "Opcional")],
                               "n string, s string")
    got = [tuple(r) for r in df.select(X.person_flag("n"), X.required_flag("n", F.col("s"))).collect()]
    assert got == [("N", "Y"), ("Y", "N"), ("Y", "N")]


def test_content_key_separates_and_marks_null(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "x"), ("", "x")], "a string, b string")
    keys = [r[0] for r in df.select(X.content_key("a", "b")).collect()]
    assert len(set(keys)) == 4
    assert keys[0] == X.literal_key("ab", "c") and keys[2] == X.literal_key(None, "x")


# Properties ---------------------------------------------------------------

plain = st.text(alphabet=st.characters(blacklist_characters="<>&", blacklist_categories=("Cs",)), max_size=40)


@settings(max_examples=30, deadline=None)
@given(st.lists(plain, min_size=1, max_size=8))
def test_clean_html_idempotent_on_plain_text(spark, texts):
    once = many(spark, X.clean_html, texts)
    twice = many(spark, X.clean_html, once)
    # Whitespace-only text cleans to '' and '' cleans to NULL (source rule).
    assert twice == [o if o else None for o in once]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=8))
def test_fold_matches_python_and_is_idempotent(spark, texts):
    got = many(spark, X.fold, texts)
    assert got == [arrow.fold_one(t) for t in texts]
    assert [arrow.fold_one(g) for g in got] == got
