import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rows import entries
from shardtally.functions.keyvalue import evaluate_once, param, with_largest_params
from shardtally.sources import schema


def arrays(spark, *values):
    rows = [(i, entries(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"id int, a {schema.KEY_VALUES.simpleString()}")


def column(df, expression):
    return [r[0] for r in df.orderBy("id").select(expression).collect()]


def test_missing_key_empty_and_null_array_give_null(spark):
    df = arrays(spark, {"k": "v"}, {"other": "v"}, {}, None)
    assert column(df, param("a", "k")) == ["v", None, None, None]


def test_slots_are_separate(spark):
    df = arrays(spark, {"k": "v"}, {"k": 7})
    assert column(df, param("a", "k", "int")) == [None, 7]
    assert column(df, param("a", "k", "string")) == ["v", None]


def test_first_of_repeated_keys_counts_unless_strict(spark):
    df = arrays(spark, [("k", "b"), ("k", "z")], {"k": "a"})
    assert column(df, param("a", "k")) == ["b", "a"]
    with pytest.raises(PySparkException, match="occurs more than once"):
        df.select(param("a", "k", strict=True)).collect()


def test_strict_ignores_repeats_of_other_keys(spark):
    df = arrays(spark, [("x", "1"), ("x", "2"), ("k", "v")])
    assert column(df, param("a", "k", strict=True)) == ["v"]


def largest(df, kind, key="k"):
    wanted = {"value": key}
    integers, strings = (wanted, {}) if kind == "int" else ({}, wanted)
    return column(with_largest_params(df, integers, strings, array="a"), "value")


def test_largest_value(spark):
    df = arrays(
        spark,
        [("k", "b"), ("x", "zz"), ("k", "c"), ("k", None)],
        {"k": "b"},
        {"x": "zz"},
        {},
        None,
    )
    assert largest(df, "string") == ["c", "b", "", "", ""]


def test_repeats_of_other_keys_do_not_matter(spark):
    df = arrays(spark, [("x", "9"), ("k", "b"), ("x", "1")], [("x", "1"), ("x", "9")])
    assert largest(df, "string") == ["b", ""]
    assert largest(df, "string", "x") == ["9", "9"]


def test_default_fills_null_only_beside_other_entries(spark):
    df = arrays(spark, {"k": None}, {"k": None, "x": "1"}, [("k", None), ("k", None)])
    assert largest(df, "string") == [None, "", None]


def test_largest_int_among_mixed_slots(spark):
    df = arrays(spark, [("k", 3), ("k", 12), ("k", "text")], {"k": "text"})
    assert largest(df, "int") == [12, None]
    assert largest(df, "string") == ["text", "text"]


def test_values_are_evaluated_once_and_inside_codegen(spark, tmp_path):
    path = str(tmp_path / "a")
    arrays(spark, {"k": "v"}).write.parquet(path)
    df = evaluate_once(spark.read.parquet(path), k=param("a", "k"))
    plan = df.where(F.col("k") == "v").select("id", "k")._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("array_position") == 1
    assert "*(1) Generate inline" in physical
    assert "int_value" not in physical.split("ReadSchema")[1]


def test_unused_slot_is_not_read(spark, tmp_path):
    path = str(tmp_path / "a")
    arrays(spark, {"k": "v"}).write.parquet(path)
    df = with_largest_params(spark.read.parquet(path), {}, {"v": "k"}, array="a").select("v")
    physical = df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "int_value" not in physical.split("ReadSchema")[1]
    assert df.columns == ["v"]
