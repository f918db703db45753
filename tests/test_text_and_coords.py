"""Cleaning functions against plain-Python statements of the same rules."""

import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from incidex.functions.coords import coordinate_value, repair_coordinate, valid_coordinate
from incidex.functions.text import FOLD_FROM, FOLD_MULTI, FOLD_TO, label_to_identifier, merge_labels, normalize_text

FOLD = str.maketrans(FOLD_FROM, FOLD_TO)


def py_normalize(s):
    if s is None:
        return None
    s = s.translate(FOLD)
    for a, b in FOLD_MULTI:
        s = s.replace(a, b)
    s = re.sub(r"[^a-zA-Z0-9 \t\n\x0b\f\r]", "", s)
    s = re.sub(r"[ \t\n\x0b\f\r]+", " ", s)
    return s.strip(" ").upper()


def py_repair(v):
    """The coordinate rule: strip, keep sign, add a point after two digits."""
    if v is None:
        return None
    s = v.strip(" \t\n\x0b\f\r")
    sign = ""
    if s.startswith("-"):
        sign, s = "-", s[1:]
    if "." in s or len(s) <= 2:
        return sign + s
    return sign + s[:2] + "." + s[2:]


def _run(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in df.select("i", fn("v").alias("o")).orderBy("i").collect()]


def test_normalize_examples(spark):
    vals = ["Rua São João, nº 12", "  Jardim   Ângela\n", "Straße – Köln!", "Œuvre Æther", None, "",
            "VEDAÇÃO DA DIVULGAÇÃO", "a\tb\r\nc"]
    got = _run(spark, vals, normalize_text)
    assert got == [py_normalize(v) for v in vals]
    assert got[0] == "RUA SAO JOAO NO 12"
    assert got[2] == "STRASSE KOLN"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="aáàâãäçéèêëíîóôõöúüñßÆæÇÑ .,-–\t\nºª!?9", max_size=30), min_size=1, max_size=20))
def test_normalize_property(spark, values):
    assert _run(spark, values, normalize_text) == [py_normalize(v) for v in values]


EDGE_COORDS = ["-0.5", "abc", "-23550520123", None, "--1", "-", "", "\t-2355052\n", " -23.5 ",
               "46", "-23", "4612", "12.3", "-46.123"]


def test_repair_edges(spark):
    assert _run(spark, EDGE_COORDS, repair_coordinate) == [py_repair(v) for v in EDGE_COORDS]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="-0123456789. \tx", max_size=12)), min_size=1, max_size=25))
def test_repair_property(spark, values):
    assert _run(spark, values, repair_coordinate) == [py_repair(v) for v in values]


def test_coordinate_validity(spark):
    vals = ["-23.55", "0", "abc", None, "99999.5", "-46.1"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    out = df.select(coordinate_value(repair_coordinate("v")).alias("x")).select(
        "x", valid_coordinate("x").alias("ok")).collect()
    assert [r.x for r in out] == [-23.55, 0.0, None, None, None, -46.1]
    assert [bool(r.ok) for r in out] == [True, False, False, False, False, True]


def test_labels(spark):
    df = spark.createDataFrame([("Furto de veículo",), ("ROUBO DE VEÍCULO",), ("FURTO OUTROS",), (None,)], "t string")
    merged = [r.m for r in df.select(merge_labels("t", ["FURTO DE VEÍCULO", "ROUBO DE VEÍCULO"],
                                                  "FURTO ROUBO DE VEICULO").alias("m")).collect()]
    assert merged == ["FURTO ROUBO DE VEICULO", "FURTO ROUBO DE VEICULO", "FURTO OUTROS", None]
    ids = [r.i for r in df.select(label_to_identifier(normalize_text("t")).alias("i")).collect()]
    assert ids[2] == "FURTO_OUTROS"
