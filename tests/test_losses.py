"""Counts of what typing and lookups lose, gathered by the write."""

import pytest
from pyspark.sql import functions as F

from cadastro.operators import lookup
from cadastro.operators.losses import Losses, report
from cadastro.plans import company_register as cr
from cadastro.plans.spec import consolidate
from cadastro.sources import write_table


@pytest.fixture()
def raw(spark):
    rows = [("1", "20240101", "3", "a"), ("x", "00000000", "99", "b"), (" ", "20240230", None, "c"), (None, "", "4", None), ("2.5", "2024", "y", "d")]
    return spark.createDataFrame(rows, "n string, data_x string, cod_k string, t string")


def test_typing_counts_values_that_became_null(spark, raw):
    losses = Losses("t")
    typed = losses.typing(raw, {"n": "int", "data_x": "date", "cod_k": "int", "t": "text"})
    assert typed.columns == raw.columns
    assert typed.count() == 5
    assert losses.rows() == [("t", "typing", "n", 1, 5), ("t", "typing", "data_x", 2, 5), ("t", "typing", "cod_k", 1, 5)]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("strategy", ["auto", "salted"])
def test_lookups_count_and_keep_their_rows(spark, how, strategy):
    fact = spark.createDataFrame([(1, 1), (2, 9), (3, None), (4, 2), (5, 1)], "i int, k int")
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    losses = Losses("t")
    got = losses.lookup(fact, dim, "k", how, strategy=strategy)
    want = lookup(fact, dim, "k", how)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert losses.rows() == [("t", f"{how} lookup", "k", 2 if how == "inner" else 1, 5)]


def test_one_scan_counts_and_writes(spark, tmp_dir):
    raw = spark.createDataFrame([(str(i), str(i % 4)) + ("x",) * 28 for i in range(100)], ", ".join(f"{c} string" for c in cr.ESTAB_COLUMNS))
    raw = raw.withColumn("cod_mun", (F.col("cnpj").cast("int") % 5).cast("string")).withColumn("cod_pais", F.lit("7"))
    raw.write.parquet(f"{tmp_dir}/raw")
    raw = spark.read.parquet(f"{tmp_dir}/raw")
    mun = spark.createDataFrame([(i, f"m{i}") for i in range(4)], "cod_mun int, nome_mun string")
    pais = spark.createDataFrame([(1, "p")], "cod_pais int, nome_pais string")
    losses = Losses("df_estab")
    df = consolidate(raw, cr.ESTAB, {"mun": mun, "pais": pais}, losses=losses)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("CollectMetrics") == 3 and "hashpartitioning" not in plan
    write_table(df, f"{tmp_dir}/out")
    plain = consolidate(raw, cr.ESTAB, {"mun": mun, "pais": pais})
    assert sorted(map(str, spark.read.parquet(f"{tmp_dir}/out").collect())) == sorted(map(str, plain.collect()))
    got = {(r.step, r.column_name): (r.lost, r.seen) for r in report(spark, [losses]).collect()}
    assert got["inner lookup", "cod_mun"] == (20, 100) and got["left lookup", "cod_pais"] == (80, 80)
    assert got["typing", "situacao_cadastral"] == (100, 100) and got["typing", "cod_mun"] == (0, 100)


def test_raw_texts_of_typed_values_are_not_looked_at_again(spark, monkeypatch):
    from pyspark.sql import functions as F

    from cadastro.operators import losses as module

    def only_of_lost_values(raw, kind):
        return F.when(raw == "x", F.lit(True)).otherwise(F.raise_error(F.lit("looked at a typed value")).cast("boolean"))

    monkeypatch.setattr(module, "has_value", only_of_lost_values)
    losses = module.Losses("t")
    losses.typing(spark.createDataFrame([("1",), ("x",), ("3",)], "cod string"), {"cod": "int"}).write.format("noop").mode("overwrite").save()
    assert losses.rows() == [("t", "typing", "cod", 1, 3)]
