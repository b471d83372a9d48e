"""The register's dumps on disk: compressed, nothing shuffled left behind, gone once they were read."""

import datetime as dt
import os
import time

import pytest

from cadastro.plans import catalog
from cadastro.plans import company_register as cr
from cadastro.plans import runner
from cadastro.sources import read_positional

N = 600


@pytest.fixture()
def sf(spark, tmp_dir):
    """Tables with separators, quotes and accents in their texts, keys that repeat and keys that are null."""
    day = dt.datetime(2024, 1, 13)
    name = ['açaí; "doce"', "it's", "", " Ltda ", None, "ÿ"]
    orders = [(i, i % 7 if i % 50 else None, "OF"[i % 2], 1.5 * i, day + dt.timedelta(days=i % 40), f"{i % 5}-LOW") for i in range(N)]
    lines = [(i // 3, i % 11 if i % 60 else None, i % 5, i % 4 + 1, float(i % 50), "RAN"[i % 3], "OF"[i % 2], day + dt.timedelta(days=i % 90)) for i in range(N)]
    tables = {
        "region": ([(i, f"REGION {i}") for i in range(3)], "r_regionkey long, r_name string"),
        "nation": ([(i, f"NAÇÃO {i}", i % 3) for i in range(5)], "n_nationkey long, n_name string, n_regionkey long"),
        "customer": ([(i, name[i % 6], i % 5, i * 1.25, "AUTO") for i in range(7)], "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string"),
        "supplier": ([(i % 4, name[i % 6], i % 5) for i in range(6)], "s_suppkey long, s_name string, s_nationkey long"),
        "part": ([(i % 9 if i else None, name[i % 6], f"Brand#{i}", "SMALL", i) for i in range(12)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
    }
    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/sf/{table}.parquet")
    return f"{tmp_dir}/sf"


def files_of(folder):
    return [f"{d}/{f}" for d, _, names in os.walk(folder) for f in names if f.startswith("part-")]


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


ALL = ("lookups", "simples", "socios", "empresas", "estab")


def test_dumps_are_compressed_and_have_the_rows_of_plain_ones(spark, sf, tmp_dir, monkeypatch):
    monkeypatch.setitem(catalog.DUMP_FILES, "max_records_per_file", 50)
    catalog._register_dumps(spark, sf, f"{tmp_dir}/raw", ALL)
    files = files_of(f"{tmp_dir}/raw")
    assert files and all(f.endswith(".gz") for f in files)
    assert len([f for f in files if "ESTABELE" in f]) >= N // 2 // 50
    for key, make in {"simples": catalog.raw_regime, "socios": catalog.raw_partners, "empresas": catalog.raw_companies, "estab": catalog.raw_establishments}.items():
        catalog._write_positional(make(spark, sf), f"{tmp_dir}/plain/{key}")
        dump, plain = (read_positional(spark, p, cr.TABLES[key].raw_columns) for p in (f"{tmp_dir}/raw/{cr.GLOBS[key]}", f"{tmp_dir}/plain/{key}"))
        assert sorted_rows(dump) == sorted_rows(plain) and dump.count()


def test_a_dump_takes_less_than_half_the_disk_of_plain_text(spark, sf, tmp_dir):
    catalog._register_dumps(spark, sf, f"{tmp_dir}/raw", ("estab",))
    catalog._write_positional(catalog.raw_establishments(spark, sf).coalesce(1), f"{tmp_dir}/plain")
    taken, plain = (sum(map(os.path.getsize, files_of(p))) for p in (f"{tmp_dir}/raw", f"{tmp_dir}/plain"))
    assert 0 < taken < plain / 2


def test_dumps_leave_no_shuffle_files(spark, sf, tmp_dir):
    def shuffled():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {str(blocks.apply(i)) for i in range(blocks.size()) if "shuffle_" in str(blocks.apply(i))}

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.cadastro.broadcastMaxBytes")
    kept = {key: spark.conf.get(key, None) for key in keys}
    before = shuffled()
    try:
        spark.conf.set(keys[0], "-1")
        spark.conf.set(keys[1], "0")
        catalog.raw_establishments(spark, sf).write.parquet(f"{tmp_dir}/with_shuffles")
        assert shuffled() - before  # what a write leaves, else this test would show nothing
        before |= shuffled()
        catalog._register_dumps(spark, sf, f"{tmp_dir}/raw", ALL)
    finally:
        for key, value in kept.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    until = time.time() + 10
    while shuffled() - before and time.time() < until:  # they are deleted in the background
        time.sleep(0.2)
    assert not shuffled() - before


def test_the_setting_for_shuffle_files_is_put_back(spark):
    from cadastro.session import SHUFFLE_CLEANUP, shuffles_deleted

    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    with pytest.raises(ValueError), shuffles_deleted(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        raise ValueError
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before


def test_a_published_runs_dumps_are_gone_once_read(spark, sf, tmp_dir, monkeypatch):
    root, seen, publish = f"{tmp_dir}/run", [], runner.publish_company_register
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, *parts: root)
    monkeypatch.setattr(runner, "publish_company_register", lambda *a, **k: (seen.append(sorted(os.listdir(root))), publish(*a, **k))[1])
    out = catalog.q_register_publish(spark, sf)
    assert seen == [["raw"], ["later", "out"]]
    assert os.listdir(root) == ["out"]
    assert all(".zstd." in f for f in files_of(root))
    counts = {r.table_name: r["count"] for r in out.groupBy("table_name").count().collect()}
    mun = spark.read.parquet(f"{sf}/nation.parquet")
    estab = catalog.raw_establishments(spark, sf)
    assert counts == {
        "simples": N, "socios": catalog.raw_partners(spark, sf).count(), "empresas": 7,
        "estab": estab.join(mun, estab.cod_mun.cast("long") == mun.n_nationkey, "left_semi").count(),
        "cnae": 12, "mun": 5, "natju": 5, "pais": 3, "qual_socio": 5, "motivo": 7}


def test_broadcast_within_bound_keeps_repeated_and_null_keys(spark):
    from cadastro.operators.lookups import broadcast_within_bound

    fact = spark.createDataFrame([(i % 4 if i % 5 else None, i) for i in range(40)], "k long, v long")
    side = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (None, "d")], "k2 long, w string")
    kept = {key: spark.conf.get(key, None) for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.cadastro.broadcastMaxBytes")}
    rows, plans = [], []
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for bound in ("1000", "10"):
            spark.conf.set("spark.cadastro.broadcastMaxBytes", bound)
            dim = broadcast_within_bound({"side": (side, "k2")})["side"]
            joined = fact.join(dim, fact.k == dim.k2)
            rows.append(sorted_rows(joined))
            plans.append(joined._jdf.queryExecution().executedPlan().toString())
    finally:
        for key, value in kept.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert rows[0] == rows[1] and rows[0]
    assert "BroadcastHashJoin" in plans[0] and "BroadcastHashJoin" not in plans[1]
