import datetime
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.text import render_text, word_count, words
from shelfmark.operators import prep

LIST = T.ArrayType(T.StringType())
SLOW = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
# Characters that Java and Python agree are assigned or not.
CHARACTERS = st.one_of(
    st.sampled_from("'\"\\\n\r\t abcé|[],\x00\x1c\x7f\x85\xa0\xad​ 　﻿😀\U000e0001"),
    st.characters(max_codepoint=0x24F),
)
STRINGS = st.text(CHARACTERS, max_size=12)


def test_validate_accepts_records(records):
    prep.validate_input(records)


def test_validate_none():
    with pytest.raises(ValueError, match="Input DataFrame is empty or None."):
        prep.validate_input(None)


def test_empty_comes_before_missing_columns(spark):
    empty = spark.createDataFrame(
        [], "title string, description string, feature string, brand string, main_cat string"
    )
    with pytest.raises(ValueError, match="Input DataFrame is empty or None."):
        prep.validate_input(empty)


def test_validate_missing_columns(spark):
    df = spark.createDataFrame([("Product 1", "Electronics")], "title string, main_cat string")
    with pytest.raises(ValueError, match="Input DataFrame is missing required columns") as error:
        prep.validate_input(df)
    assert "['asin', 'description', 'feature', 'brand']" in str(error.value)


def test_validate_is_case_sensitive(records):
    with pytest.raises(ValueError, match="missing required columns"):
        prep.validate_input(records.withColumnRenamed("title", "Title"))


def test_project_keeps_order_and_rows(records):
    out = prep.project_columns(records.withColumn("extra", F.lit(1)), ["title", "asin", "none"])
    assert out.columns == ["title", "asin", "main_cat"]
    assert out.count() == 3
    assert prep.project_columns(records, []).columns == [*prep.TEXT_COLUMNS, "main_cat"]


def test_combine_skips_nulls(records):
    rows = prep.combine_text(records).orderBy("asin").collect()
    assert [r.combined_text for r in rows] == [
        "123B | Product 1 | This is a great product. | Fast | BrandA",
        "123C | Product 2 | Cheap | BrandB",
        "123D | Product 3 | Works well | BrandC",
    ]


def test_preprocess(records):
    out = prep.preprocess(records)
    assert set(out.columns) == {"combined_text", "main_cat"}
    assert out.count() == records.count()
    kept = prep.preprocess(records, keep=["asin"])
    assert kept.columns == ["combined_text", "main_cat", "asin"]


def test_null_and_falsy_rules(spark):
    df = spark.createDataFrame(
        [("a", "", [], 0, False, "b"), (None,) * 6],
        "a string, b string, c array<string>, d int, e boolean, f string",
    )
    names = df.columns
    null = [r.x for r in prep.combine_text(df, names, "x").collect()]
    falsy = [r.x for r in prep.combine_text(df, names, "x", skip="falsy").collect()]
    assert null == ["a |  | [] | 0 | False | b", ""]
    assert falsy == ["a | b", ""]
    rest = prep.combine_text(df, names, "x", skip="falsy", exclude=["f"]).first().x
    assert rest == "a"


def test_list_styles(spark):
    df = spark.createDataFrame([(["x y", None, "it's"], [[1, None], []])], "l array<string>, n array<array<int>>")
    got = {s: prep.combine_text(df, ["l"], "x", list_style=s).first().x for s in ("repr", "flatten", "join")}
    assert got == {"repr": "['x y', None, \"it's\"]", "flatten": "x y | it's", "join": "x y it's"}
    assert prep.combine_text(df, ["n"], "x").first().x == "[[1, None], []]"
    with pytest.raises(ValueError):
        prep.combine_text(df, ["l"], list_style="other")


@SLOW
@given(st.lists(st.lists(st.one_of(st.none(), STRINGS), max_size=4), min_size=1, max_size=60))
def test_list_repr_is_pythons(spark, lists):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, l array<string>")
    out = df.select("i", render_text(F.col("l"), LIST).alias("x")).collect()
    assert {r.i: r.x for r in out} == {i: str(v) for i, v in enumerate(lists)}


@SLOW
@given(st.lists(st.floats(allow_subnormal=False), min_size=1, max_size=200))
def test_double_text_is_pythons(spark, values):
    values = [*values, 0.0, -0.0, 1e16, 1e15, 123456789.0, 1e-4, 1e-5, 2.0**70, 2.2250738585072014e-308, 1e23, 9.999999999999999e22, 0.1 + 0.2]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    out = df.select("i", render_text(F.col("v"), T.DoubleType()).alias("x")).collect()
    assert {r.i: r.x for r in out} == {i: str(v) for i, v in enumerate(values)}


def test_scalar_text(spark):
    df = spark.createDataFrame(
        [(True, 7, 1.5, datetime.date(2020, 1, 2), [1.0, None, math.inf])],
        "b boolean, i bigint, f float, d date, l array<double>",
    )
    assert prep.combine_text(df, df.columns, "x").first().x == "True | 7 | 1.5 | 2020-01-02 | [1.0, None, inf]"
    with pytest.raises(TypeError):
        prep.combine_text(spark.sql("select map('a', 1) as m"), ["m"])


def test_words_split_at_all_white_space(spark):
    text = "a b\tc\xa0d　e f\x1cg\x85h"
    df = spark.createDataFrame([(text,), ("",), (" \n",)], "t string")
    got = [r.w for r in df.select(words(F.col("t")).alias("w")).collect()]
    assert got == [text.split(), [], []]


@SLOW
@given(st.lists(st.one_of(st.none(), st.lists(STRINGS, max_size=4)), min_size=1, max_size=60))
def test_word_count_is_pythons(spark, lists):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, l array<string>")
    out = df.select("i", word_count(F.col("l"), LIST).alias("n")).collect()
    assert {r.i: r.n for r in out} == {
        i: sum(len(t.split()) for t in v or []) for i, v in enumerate(lists)
    }


def test_word_count_of_other_types(spark):
    df = spark.createDataFrame([("two words", 5, ["x", None])], "t string, n int, l array<string>")
    def count(name, strict=False):
        return df.select(word_count(F.col(name), df.schema[name].dataType, strict).alias("n")).first().n
    assert (count("t"), count("t", strict=True), count("n"), count("l")) == (2, 0, 0, 1)


RECORD = {"asin": "str", "price": "float", "tags": "List[str]", "image": "list[str]"}


def test_conform(spark):
    df = spark.createDataFrame(
        [
            ("a", 1.0, ["x"], [None], "keep"),
            (None, 1.0, [None], [], "keep"),
            ("c", None, None, None, "keep"),
        ],
        "asin string, price double, tags array<string>, image array<string>, other string",
    )
    valid, rejected = prep.conform(df, RECORD)
    assert valid.columns == list(RECORD)
    assert [r.asin for r in valid.collect()] == ["a"]
    assert [(r.asin, r.other, r.reject_reason) for r in rejected.collect()] == [
        (None, "keep", "asin: null; tags: not List[str]"),
        ("c", "keep", "price: null; tags: null; image: null"),
    ]


def test_conform_types_and_missing(spark):
    df = spark.createDataFrame([("1", 2)], "asin string, n int")
    valid, rejected = prep.conform(df, {"asin": "int", "n": "float", "gone": "bool"})
    assert valid.count() == 0
    assert rejected.first().reject_reason == "asin: not int; gone: missing"
    with pytest.raises(ValueError, match="Unknown field type"):
        prep.conform(df, {"asin": "date"})


def test_record_schema():
    got = prep.record_schema(RECORD).simpleString()
    assert got == "struct<asin:string,price:double,tags:array<string>,image:array<string>>"


def test_each_value_of_a_line_is_judged_by_its_own_type(spark):
    declared = {"id": "int", "name": "str", "tags": "List[str]", "any": "list", "price": "float", "new": "bool"}
    good = '{"id": 1, "name": "a", "tags": ["x"], "any": [1, "b"], "price": 2, "new": true, "more": {}}'
    cases = [
        (good, ""),
        (good.replace('["x"]', "[]").replace('"price": 2', '"price": 2.5'), ""),
        (good.replace('"a"', '["a"]'), "name: not str"),
        (good.replace('"a"', "7"), "name: not str"),
        (good.replace('"id": 1', '"id": "1"'), "id: not int"),
        (good.replace('"id": 1', '"id": 1.5'), "id: not int"),
        (good.replace('"id": 1', '"id": 99999999999999999999'), "id: not int"),
        (good.replace('["x"]', '["x", 1]'), "tags: not List[str]"),
        (good.replace('["x"]', '["x", null]'), "tags: not List[str]"),
        (good.replace('["x"]', '"x"').replace("true", "1"), "tags: not List[str]; new: not bool"),
        (good.replace('"a"', "null").replace('"price": 2, ', ""), "name: null; price: missing"),
        (good[:-1], "malformed line"),
        ("[1]", "malformed line"),
        ("", "malformed line"),
        (None, "malformed line"),
        ('{"id": 1, "id": 2}', "malformed line"),
    ]
    lines = spark.createDataFrame([(k, line) for k, (line, _) in enumerate(cases)], "k int, value string")
    valid, rejected = prep.conform_lines(lines, declared)
    assert {r.k: r.reject_reason for r in rejected.collect()} == {k: r for k, (_, r) in enumerate(cases) if r}
    assert rejected.columns == ["k", "value", "reject_reason"]
    assert [tuple(r) for r in valid.orderBy("price").collect()] == [
        (1, "a", ["x"], ["1", "b"], 2.0, True),
        (1, "a", [], ["1", "b"], 2.5, True),
    ]
    with pytest.raises(ValueError):
        prep.conform_lines(lines, {"it's": "str"})


def test_no_lines(spark):
    valid, rejected = prep.conform_lines(spark.createDataFrame([], "value string"), {"id": "int"})
    assert valid.columns == ["id"] and valid.count() == rejected.count() == 0
