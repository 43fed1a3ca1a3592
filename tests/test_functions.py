from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from issuerlake import functions as fn
from issuerlake.schemas import MACRO_TYPES


def apply(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select(f(F.col("v")).alias("o"), "i").orderBy("i").select("o").collect()]


def test_br_number(spark):
    got = apply(spark, fn.br_number, ["1.234,56", "37.552,89", "0,5", "12", "-1.000,01", "nan", "inf", "-", "", None, "1d", "1,2,3", " 7,5 "])
    assert got == [1234.56, 37552.89, 0.5, 12.0, -1000.01, None, None, None, None, None, None, None, 7.5]


def test_numeric_lenient(spark):
    assert apply(spark, fn.numeric_lenient, ["2.45", "2,45", "1e3", "x", "0x1p3", "NaN", None]) == [2.45, None, 1000.0, None, None, None, None]


def test_dates(spark):
    assert apply(spark, fn.date_lenient, ["31/12/2024", "31/02/2024", "2024-12-31", None]) == [dt.date(2024, 12, 31), None, None, None]
    assert apply(spark, fn.date_strict, ["2024-02-29"]) == [dt.date(2024, 2, 29)]
    with pytest.raises(Exception, match="(?i)date|parse"):
        apply(spark, fn.date_strict, ["29/02/2024"])


@pytest.mark.parametrize("text", ["2024-2-9", "2024-02-30", " 2024-02-9", "2024-02-29T00:00", "2024", "", "2024-02-2x"])
def test_plain_dates_are_read_as_by_the_format(spark, text):
    """What a cast would take or make null beyond the format still fails."""
    good = ["0001-01-01", "1582-10-10", "2018-11-04", "2024-02-29", "9999-12-31", None]
    by_format = [r[0] for r in spark.createDataFrame([(v,) for v in good], "v string").select(F.to_date("v", "yyyy-MM-dd")).collect()]
    assert apply(spark, fn.date_strict, good) == by_format
    with pytest.raises(Exception, match="parse"):
        apply(spark, fn.date_strict, [text])


def test_null_token(spark):
    assert apply(spark, fn.null_token, [" a ", "nan", " None", "-", "", " -\t", "n-a", None]) == ["a", None, None, None, None, None, "n-a", None]


def test_snake(spark):
    names = {
        "Codigo do Ativo": "codigo_do_ativo", "Garantia/Especie": "garantia_especie", "Ato Societario (1)": "ato_societario_1",
        "Quantidade  Cancelada": "quantidade_cancelada", "Última Atualização": "ultima_atualizacao", "a/%/b": "a_b", "ñandú": "ñandu",
    }
    assert [fn.snake_name(n) for n in names] == list(names.values())
    assert apply(spark, fn.snake_col, list(names)) == list(names.values())


def test_halve_doubled(spark):
    assert apply(spark, fn.halve_doubled, ["DIDI", "abcde", "", None]) == ["DI", "ab", "", None]


def test_cnpj(spark):
    assert apply(spark, fn.cnpj_digits, ["12.648.266/0001-24"]) == ["12648266000124"]
    assert apply(spark, fn.cnpj_format, ["12648266000124", "1"]) == ["12.648.266/0001-24", None]


def test_map_labels(spark):
    f = lambda c: fn.map_labels(c, MACRO_TYPES)
    assert apply(spark, f, ["TAXAS DE CÂMBIO", "TAXAS DE JUROS NACIONAL", "other"]) == ["FX", "DOMESTIC_RATES", None]
    with pytest.raises(Exception, match="unmapped label"):
        apply(spark, lambda c: fn.map_labels(c, MACRO_TYPES, strict=True), ["other"])


def test_l2_normalize(spark):
    got = apply(spark, fn.l2_normalize, [[3.0, 4.0], [0.0, 0.0], None], "array<float>")
    assert got == [[0.6, 0.8], [0.0, 0.0], None]


def test_object_path(spark):
    df = spark.createDataFrame([("T", None, "a b", "2024-01-01")], "t string, agg string, x string, d string")
    got = df.select(
        fn.object_path(F.lit("gold"), F.lit("CVM"), F.col("t"), agg=F.col("agg"), extra=F.col("x"), ref_date=F.col("d"), ext=F.lit("pdf"))
    ).first()[0]
    assert got == "gold/CVM/T_a_b-2024-01-01.pdf"


SPACES = " \t\n\x0b\x1c\x85  　"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aé1." + SPACES, max_size=30), min_size=5, max_size=25))
def test_whitespace_like_python(spark, texts):
    assert apply(spark, fn.collapse_ws, texts) == [" ".join(t.split()) for t in texts]
    assert apply(spark, fn.strip, texts) == [t.strip() for t in texts]
    assert apply(spark, fn.words, texts) == [t.split() for t in texts]
    assert apply(spark, fn.n_words, texts) == [len(t.split()) for t in texts]
