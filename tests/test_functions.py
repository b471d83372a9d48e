"""Scalar functions on the edge rows every fixture set must contain (FIXTURES.md section 4)."""

import datetime as dt
import string

from hypothesis import given, settings
from hypothesis import strategies as st

from cadastro import functions as cf


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {dtype}")


def test_lenient_int(spark):
    vals = ["12", "12.7", " 7 ", "", "x", "-3.9", "44,00", "99999999999", ".5", None, "+5", "12.", "1.2.3"]
    got = [r[0] for r in one_col(spark, vals).select(cf.lenient_int("x")).collect()]
    assert got == [12, 12, 7, None, None, -3, None, None, None, None, 5, 12, None]


def test_lenient_date(spark):
    vals = ["20210228", "20210230", "00000000", "0", "", "2021022", None, "202102281"]
    got = [r[0] for r in one_col(spark, vals).select(cf.lenient_date("x")).collect()]
    assert got == [dt.date(2021, 2, 28), None, None, None, None, None, None, None]


def test_year_month(spark):
    vals = ["202103", "20210315", "", None, "202113"]
    got = [r[0] for r in one_col(spark, vals).select(cf.year_month("x")).collect()]
    assert got == [dt.date(2021, 3, 1), None, None, None, None]


def test_decimal_comma_and_double(spark):
    vals = ["1234567,89", "10", "1.234,5", "", None, "1500,00"]
    df = one_col(spark, vals)
    floats = [r[0] for r in df.select(cf.decimal_comma("x")).collect()]
    assert floats[0] == 1234567.875  # float keeps the published type (cents lost)
    assert floats[1:] == [10.0, None, None, None, 1500.0]
    exact = [r[0] for r in df.select(cf.decimal_comma("x", "decimal(18,2)")).collect()]
    assert str(exact[0]) == "1234567.89"
    plain = [r[0] for r in df.select(cf.lenient_double("x")).collect()]
    assert plain == [None, 10.0, None, None, None, None]  # the published salary cast: comma -> null
    comma = [r[0] for r in df.select(cf.lenient_double("x", decimal_comma=True)).collect()]
    assert comma[5] == 1500.0


def test_clean_text(spark):
    vals = ["  JOÃO da silva ", "Santa Bárbara D'OESTE", "A  B", "a\tb", "ß", "", None, "ÆSIR «Œuvre» — x"]
    got = [r[0] for r in one_col(spark, vals).select(cf.clean_text("x")).collect()]
    assert got == ["Joao Da Silva", "Santa Barbara D'oeste", "A  B", "A\tb", "Ss", "", None,
                   "Aesir <<oeuvre>> -- X"]


def test_fold_column_and_name_forms_agree(spark):
    from pyspark.sql import functions as F

    import unicodedata

    vals = ["Ação", "ÿ ĳ Ǆ", "plain", None, "naïve café œ ß", unicodedata.normalize("NFD", "São José"),
            "Nguyễn Thị Ánh"]
    df = one_col(spark, vals)
    a = df.select(cf.ascii_fold("x")).collect()
    b = df.select(cf.ascii_fold(F.col("x"))).collect()
    assert a == b
    assert [r[0] for r in a] == ["Acao", "y ij DZ", "plain", None, "naive cafe oe ss", "Sao Jose", "Nguyen Thi Anh"]


def test_pad_compose_and_small_text_functions(spark):
    df = spark.createDataFrame(
        [("123", "0001", "56", " a'B.COM ", "S/N", "SP-Sao Paulo"),
         ("123456789", None, "7", None, "S/N B", "RJ-Varre-Sai"),
         ("", "2", "", "X'Y", "12", "Semhifen"),
         (None, "3", "1", "", None, None)],
        "cnpj string, ordem string, dv string, mail string, numero string, mun string")
    out = df.select(
        cf.zero_pad("cnpj", 8).alias("p"), cf.compose_id(cf.zero_pad("cnpj", 8), "ordem", "dv").alias("id"),
        cf.fix_email("mail").alias("m"), cf.blank_sentinels("numero").alias("n"),
        cf.initcap_or(cf.split_take("mun", "-", 1), "Nao Identificado").alias("mun1"),
        cf.initcap_or(cf.split_take("mun", "-", 1, keep_rest=True), "Nao Identificado").alias("mun2"),
    ).collect()
    assert [r.p for r in out] == ["00000123", "12345678", "00000000", None]
    assert [r.id for r in out] == ["00000123000156", None, "000000002", None]
    assert [r.m for r in out] == ["a@b.com", None, "x@y", ""]
    assert [r.n for r in out] == ["", "", "12", None]
    assert [r.mun1 for r in out] == ["Sao Paulo", "Varre", "Nao Identificado", "Nao Identificado"]
    assert [r.mun2 for r in out] == ["Sao Paulo", "Varre-sai", "Nao Identificado", "Nao Identificado"]


def test_code_labels(spark):
    df = spark.createDataFrame([(c,) for c in ["0", "9", "10", "01", "x", None, "1"]], "x string")
    got = [r[0] for r in df.select(cf.code_label(cf.lenient_int("x"), cf.AGE_BANDS)).collect()]
    assert got == ["Nao se aplica", "Mais de 80 anos", None, "0 a 12 anos", None, None, "0 a 12 anos"]
    sizes = [r[0] for r in spark.range(7).select(cf.code_label("id", cf.COMPANY_SIZES)).collect()]
    assert sizes == [None, "Nao Informado", "Micro Empresa", "Empresa de Pequeno Porte", None, "Demais", None]


def test_upper_trim(spark):
    got = [r[0] for r in one_col(spark, [" sp ", "rj", None]).select(cf.upper_trim("x")).collect()]
    assert got == ["SP", "RJ", None]


# every character the fold claims to handle: mapped letters and symbols, combining marks, ligatures
FOLDABLE = cf.text._FOLD_SRC + "".join(ch for ch, _ in cf.text._FOLD_MULTI)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=string.ascii_letters + " '-" + FOLDABLE, max_size=30), min_size=1, max_size=20))
def test_fold_is_ascii_and_idempotent(spark, texts):
    df = one_col(spark, texts)
    once = [r[0] for r in df.select(cf.ascii_fold("x")).collect()]
    assert all(s.isascii() for s in once)
    twice = [r[0] for r in one_col(spark, once).select(cf.ascii_fold("x")).collect()]
    assert once == twice


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=12)), min_size=1, max_size=20))
def test_lenient_parsers_never_raise(spark, texts):
    df = one_col(spark, texts)
    df.select(cf.lenient_int("x"), cf.lenient_date("x"), cf.year_month("x"), cf.lenient_double("x"),
              cf.decimal_comma("x"), cf.clean_text("x")).collect()


def test_every_printable_latin1_character_folds_to_ascii(spark):
    chars = [chr(c) for c in range(0xA0, 0x100)]
    got = [r[0] for r in one_col(spark, chars).select(cf.ascii_fold("x")).collect()]
    assert all(s.isascii() for s in got)
    assert "".join(got[0x0A:0x0B] + got[0x1A:0x1B]) == "ao"  # the ordinals of everyday addresses
    row = one_col(spark, ["1º andar 2ª casa, D´Oeste ½"]).select(cf.clean_text("x")).first()[0]
    assert row == "1o Andar 2a Casa, D'oeste  1/2"


def test_texts_that_are_no_numbers_or_dates_keep_their_meaning(spark):
    """The cheap guards of the lenient parsers against the plain parsers, on texts around every guard."""
    from pyspark.sql import functions as F

    texts = ["", " ", "x", "12", "12.", "12.7", "12.\n", ".5", "+", "-", "+7", "-3.9", "- 3", "1-2", " 7 ", "\t7\x7f", "7 ", "٣", "1..2", "12.7.8",
             "2147483647", "2147483648", "-2147483648", "00000000", "00000101", "20210228", "20210230", "20200229", "19000229", "20211301", "20210100",
             "20210132", "2021022", "202102281", "+20210228", "20210228 ", "2021022x", "2021-02-28", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    whole = F.regexp_replace(F.trim("t"), r"\.[0-9]*$", "")
    for new, plain in ((cf.lenient_int("t"), whole.try_cast("int")), (cf.lenient_long("t"), whole.try_cast("bigint")),
                       (cf.lenient_date("t").cast("string"), F.try_to_date("t", "yyyyMMdd").cast("string"))):
        assert [tuple(r) for r in df.select("t", new).collect()] == [tuple(r) for r in df.select("t", plain).collect()]
