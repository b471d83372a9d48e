"""Checked lookup joins: semantics, duplicate rejection, pruning and the broadcast bound."""

import pytest
from pyspark.sql import functions as F

from cadastro.operators import (
    DuplicateKeyError,
    inner_lookup,
    left_lookup,
    profile_dimensions,
    role_lookup,
    star_lookup,
    unmatched,
)
from cadastro.plans.spec import Lookup, TableSpec, consolidate


@pytest.fixture()
def fact(spark):
    return spark.createDataFrame([(1, 10), (2, 20), (3, None), (4, 99), (5, 10)], "id int, cod_pais int")


@pytest.fixture()
def pais(spark):
    return spark.createDataFrame([(10, "Brasil"), (20, "Chile")], "cod_pais int, nome_pais string")


def test_left_keeps_rows_and_nulls(fact, pais):
    out = sorted(tuple(r) for r in left_lookup(fact, pais, "cod_pais").select("id", "nome_pais").collect())
    assert out == [(1, "Brasil"), (2, "Chile"), (3, None), (4, None), (5, "Brasil")]


def test_inner_is_left_minus_unmatched(fact, pais):
    inner = inner_lookup(fact, pais, "cod_pais")
    gone = unmatched(fact, pais, "cod_pais")
    assert inner.count() + gone.count() == fact.count()
    assert sorted(r.id for r in gone.collect()) == [3, 4]


def test_duplicate_key_rejected(spark, fact):
    dup = spark.createDataFrame([(10, "A"), (10, "B"), (None, "x"), (None, "y")], "cod_pais int, nome_pais string")
    with pytest.raises(DuplicateKeyError):
        left_lookup(fact, dup, "cod_pais")
    # duplicated null keys never match anything, so they are not an error
    ok = spark.createDataFrame([(10, "A"), (None, "x"), (None, "y")], "cod_pais int, nome_pais string")
    assert left_lookup(fact, ok, "cod_pais").count() == 5


def test_role_lookup(spark, pais):
    fact = spark.createDataFrame([(1, 10, 20), (2, 20, None)], "id int, cod_pais int, cod_pais_rep int")
    out = role_lookup(left_lookup(fact, pais, "cod_pais"), pais, "cod_pais", "_rep")
    got = sorted((r.id, r.nome_pais, r.nome_pais_rep) for r in out.collect())
    assert got == [(1, "Brasil", "Chile"), (2, "Chile", None)]


def test_star_lookup_prunes_and_handles_missing(spark):
    fact = spark.createDataFrame([(1, "1", "a"), (2, "2", "b")], "id int, cod_uf string, cod_sexo string")
    uf = spark.createDataFrame([("1", "Sp"), ("2", "Rj")], "cod_uf string, uf string")
    with pytest.warns(UserWarning):
        out = star_lookup(fact, {"uf": uf, "sexo": None})
    assert sorted(tuple(r) for r in out.collect()) == [(1, "Sp", None), (2, "Rj", None)]
    with pytest.raises(KeyError):
        star_lookup(fact, {"uf": uf, "sexo": None}, missing="error")
    pruned = star_lookup(fact, {"uf": uf, "sexo": None}, keep=["uf"])
    assert "Join" in pruned._jdf.queryExecution().optimizedPlan().toString()
    assert pruned.columns == ["id", "cod_sexo", "uf"]


def test_broadcast_only_under_the_bound(spark, fact, pais):
    plan = left_lookup(fact, pais, "cod_pais")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    spark.conf.set("spark.cadastro.broadcastMaxBytes", "10")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = left_lookup(fact, pais, "cod_pais")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "_cadastro_salt" in plan
        got = sorted(tuple(r) for r in out.select("id", "nome_pais").collect())
        assert got == [(1, "Brasil"), (2, "Chile"), (3, None), (4, None), (5, "Brasil")]
    finally:
        spark.conf.unset("spark.cadastro.broadcastMaxBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_join_spreads_a_hot_key(spark, pais):
    from cadastro.operators.lookups import salted_join

    hot = spark.range(10_000).select(F.col("id").cast("int").alias("id"),
                                     F.when(F.col("id") % 3 == 0, 99).otherwise(10).alias("cod_pais"))
    out = salted_join(hot.repartition(8), pais, "cod_pais", "left")
    assert out.count() == 10_000
    assert out.filter(F.col("nome_pais") == "Brasil").count() == 6_666
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = out.filter(F.col("cod_pais") == 10).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(per_task) > 1  # the hot key landed on more than one reducer
    gone = salted_join(hot, pais, "cod_pais", "left_anti")
    assert gone.count() == 3_334 and gone.columns == ["cod_pais", "id"]  # same order as an unsalted USING join


def test_profile_one_job_for_many(spark, pais):
    empty = pais.filter(F.col("cod_pais") < 0)
    renamed = pais.select(F.col("cod_pais").alias("cod_x"), F.col("nome_pais").alias("x"))
    dup = pais.union(pais.filter(F.col("cod_pais") == 10))
    prof = profile_dimensions({"a": (pais, "cod_pais"), "b": (empty, "cod_pais"), "r": (renamed, "cod_x"),
                               "d": (dup, "cod_pais")})
    assert prof["a"].rows == 2 and prof["a"].max_rows_per_key == 1 and prof["a"].size_bytes > 0
    assert prof["b"].rows == 0
    assert prof["r"] == prof["a"]  # same table under other names: profiled once, same answer
    assert prof["d"].rows == 3 and prof["d"].max_rows_per_key == 2


def test_spec_prunes_left_but_never_inner(spark):
    raw = spark.createDataFrame([("1", "7"), ("2", "8")], "cod_a string, cod_b string")
    a = spark.createDataFrame([(1, "A")], "cod_a int, nome_a string")
    b = spark.createDataFrame([(7, "B")], "cod_b int, nome_b string")
    spec = TableSpec("t", ("cod_a", "cod_b"), kinds={"cod_a": "int", "cod_b": "int"},
                     lookups=(Lookup("a", "cod_a", "left"), Lookup("b", "cod_b", "inner")),
                     output=("cod_a", "cod_b"))
    out = consolidate(raw, spec, {"a": a, "b": b})
    assert [tuple(r) for r in out.collect()] == [(1, 7)]  # inner join on b kept: row 2 dropped
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(0, 30)), min_size=1, max_size=40))
def test_left_lookup_preserves_rows_and_inner_is_left_minus_unmatched(spark, codes):
    fact = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "id int, cod_pais int")
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(0, 31, 3)], "cod_pais int, nome_pais string")
    left = left_lookup(fact, dim, "cod_pais")
    assert left.count() == len(codes)
    expected_inner = sum(1 for c in codes if c is not None and c % 3 == 0)
    assert inner_lookup(fact, dim, "cod_pais").count() == expected_inner
    assert unmatched(fact, dim, "cod_pais").count() == len(codes) - expected_inner


def test_size_bound_is_never_below_the_row_size(spark):
    """Null-heavy, numeric and text-heavy dimensions against the rows Spark itself would broadcast."""
    from cadastro.operators.lookups import BroadcastBoundError

    nulls = spark.range(1000).select("id", *[F.lit(None).cast("long").alias(f"n{i}") for i in range(30)])
    numbers = spark.range(1000).select("id", *[F.rand(i).alias(f"n{i}") for i in range(8)])
    texts = spark.range(1000).select("id", F.repeat(F.lit("é"), 50).alias("t"))
    prof = profile_dimensions({"a": (nulls, "id"), "b": (numbers, "id"), "c": (texts, "id")})
    assert prof["a"].size_bytes >= 1000 * (8 + 31 * 8) and prof["b"].size_bytes >= 1000 * (8 + 9 * 8)
    assert prof["c"].size_bytes >= 1000 * (8 + 2 * 8 + 104)
    spark.conf.set("spark.cadastro.broadcastMaxBytes", "1000")
    try:
        with pytest.raises(BroadcastBoundError):
            left_lookup(numbers.select("id"), numbers, "id", strategy="broadcast")
    finally:
        spark.conf.unset("spark.cadastro.broadcastMaxBytes")


def test_only_hot_keys_are_salted(spark):
    from cadastro.operators.lookups import hot_keys

    fact = spark.range(30_000).select(F.expr("CASE WHEN id % 3 = 0 THEN -1 WHEN id % 7 = 1 THEN NULL ELSE id END").alias("k"))
    hot = hot_keys(fact, "k")
    assert set(hot) == {-1} and 80 <= hot[-1] <= 90
    assert hot_keys(fact.limit(0), "k") == {}
