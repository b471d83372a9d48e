"""Plan shape: native expressions only, broadcast lookups, pushdown and pruning reach the scan, no shuffle."""

from pyspark.sql import functions as F

from cadastro.plans import catalog
from cadastro.plans import company_register as cr
from cadastro.sources import read_positional, stage
from tests.conftest import SF001


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _raw_estab(spark, tmp_dir):
    raw = catalog.raw_establishments(spark, SF001)
    path = f"{tmp_dir}/raw"
    catalog._write_positional(raw, f"{path}/X.ESTABELE")
    return read_positional(spark, f"{path}/*ESTABELE", cr.ESTAB_COLUMNS)


def test_establishments_plan_is_native_and_shuffle_free(spark, tmp_dir):
    raw = _raw_estab(spark, tmp_dir)
    out = cr.consolidate_establishments(raw, catalog.lookup_dim(spark, SF001, "nation", "mun"),
                                        catalog.lookup_dim(spark, SF001, "region", "pais"))
    plan = physical(out)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert plan.count("BroadcastHashJoin") == 2
    # the only exchanges feed the broadcasts: the fact side is never shuffled
    assert plan.count("Exchange") == plan.count("BroadcastExchange")


def test_filter_and_projection_reach_the_scan(spark, tmp_dir):
    raw = _raw_estab(spark, tmp_dir)
    staged = stage(raw, "estab", root=f"{tmp_dir}/staging").read()
    out = cr.consolidate_establishments(staged, catalog.lookup_dim(spark, SF001, "nation", "mun"),
                                        catalog.lookup_dim(spark, SF001, "region", "pais"))
    q = out.filter(F.col("cep") == "00000001").select("cnpj", "nome_mun")
    plan = physical(q)
    assert "PushedFilters: [IsNotNull(cep), EqualTo(cep,00000001)" in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "cep#" in line][0]
    read_cols = scan.split("FileScan parquet [", 1)[1].split("]", 1)[0].split(",")
    # 4 of the 30 raw columns: the output pair, the filter column and the two lookup keys
    assert sorted(c.split("#")[0] for c in read_cols) == ["cep", "cnpj", "cod_mun", "cod_pais"]


def test_whole_stage_codegen_without_aqe(spark, tmp_dir):
    raw = _raw_estab(spark, tmp_dir)
    out = cr.consolidate_establishments(raw, catalog.lookup_dim(spark, SF001, "nation", "mun"),
                                        catalog.lookup_dim(spark, SF001, "region", "pais"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "*(" in physical(out)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_latest_release_is_partial_aggregate(spark):
    plan = physical(catalog.QUERIES["latest_release"](spark, SF001))
    assert "partial_max" in plan


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == list(cr.ESTAB_OUTPUT) + ["cnpj_completo"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.oracle_sql())


import pytest  # noqa: E402


@pytest.mark.parametrize("name", ["consolidate_regime", "consolidate_partners", "consolidate_companies",
                                  "consolidate_establishments", "consolidate_movements", "consolidate_estab_flows"])
@pytest.mark.parametrize("sf", [SF001, "/root/testdata/sf0.1"])
def test_consolidations_have_no_python_and_no_fact_shuffle(spark, name, sf):
    plan = physical(catalog.QUERIES[name](spark, sf))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert plan.count("Exchange") == plan.count("BroadcastExchange")


def test_partition_pruning_on_a_partitioned_sink(spark, tmp_dir):
    from cadastro.sources import write_table

    orders = catalog.table(spark, SF001, "orders")
    write_table(orders, f"{tmp_dir}/by_status", mode="overwrite", partition_by="o_orderstatus")
    import re

    plan = physical(spark.read.parquet(f"{tmp_dir}/by_status").filter(F.col("o_orderstatus") == "F"))
    plan = re.sub(r"#\d+L?", "", plan)
    assert "PartitionFilters: [isnotnull(o_orderstatus), (o_orderstatus = F)]" in plan


def test_typing_of_a_wide_table_stays_below_the_size_the_jvm_compiles(spark, tmp_dir):
    """A generated method above 8000 bytes is interpreted, not compiled, unless a JVM flag is set."""
    import contextlib
    import io
    import re

    catalog.raw_establishments(spark, SF001).write.parquet(f"{tmp_dir}/raw")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    shown = io.StringIO()
    try:
        out = cr.consolidate_establishments(spark.read.parquet(f"{tmp_dir}/raw"), catalog.lookup_dim(spark, SF001, "nation", "mun"),
                                            catalog.lookup_dim(spark, SF001, "region", "pais"), with_full_id=True)
        with contextlib.redirect_stdout(shown):
            out.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
    assert sizes and max(sizes) < 8000
