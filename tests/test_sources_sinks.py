"""Raw-file scans (positional, headered, glob, lookup sets) and sinks (modes, partitions, staging)."""

import glob
import gzip
import os
import unicodedata

import pytest
from pyspark.sql import functions as F

from cadastro.sources import read_checked, read_headered, read_lookup_set, read_positional, stage, write_clustered, write_split, write_table
from cadastro.sources.delimited import RAW_LINE, ROW_STATUS, headers_of
from cadastro.session import path_exists


def write_bytes(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(data)


def test_positional_latin1_csv_edges(spark, tmp_dir):
    lines = [
        '"1";"Jos\xe9 ""Zé"" da Silva";"a;b"',  # doubled quotes, separator inside quotes, accents
        '"2";"";"x"',  # "" reads as null
        '"3";"short"',  # short row pads with null
        '"4";"long";"c";"extra";"more"',  # extra fields are dropped
    ]
    write_bytes(f"{tmp_dir}/raw/F.K03200$W.SOCIOCSV", ("\n".join(lines) + "\n").encode("latin-1"))
    df = read_positional(spark, f"{tmp_dir}/raw/*SOCIOCSV", ["a", "b", "c"])
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("1", 'José "Zé" da Silva', "a;b"), ("2", None, "x"), ("3", "short", None), ("4", "long", "c")]


def test_headered_with_decomposed_accents(spark, tmp_dir):
    header = unicodedata.normalize("NFD", "competência;região;extra")
    write_bytes(f"{tmp_dir}/mov/a.txt", f"{header}\n202101;1;x\n".encode("utf-8"))
    from cadastro.operators import rename_map

    df = read_headered(spark, f"{tmp_dir}/mov/*.txt", expected=["competência", "região"])
    out = df.transform(rename_map({"competência": "data", "região": "cod_regiao", "ausente": "y"}))
    assert set(out.columns) == {"data", "cod_regiao", "extra"}
    with pytest.raises(ValueError):
        df.transform(rename_map({"ausente": "y"}, strict=True))
    write_bytes(f"{tmp_dir}/bom/a.txt", "\ufeffcompetência;região\n202101;1\n".encode("utf-8"))
    bom = read_headered(spark, f"{tmp_dir}/bom/*.txt").transform(rename_map({"competência": "data"}))
    assert "data" in bom.columns and bom.first().data == "202101"


def test_lookup_set_matches_by_suffix(spark, tmp_dir):
    write_bytes(f"{tmp_dir}/F.K03200$Z.D1.PAISCSV", b'"10";"BRASIL"\n')
    write_bytes(f"{tmp_dir}/F.K03200$Z.D1.MUNICCSV", b'"7107";"S\xc3O PAULO"\n')
    got = read_lookup_set(spark, tmp_dir, {"PAIS": "pais", "MUNIC": "mun"})
    assert [tuple(r) for r in got["mun"].collect()] == [("7107", "SÃO PAULO")]
    with pytest.raises(FileNotFoundError):
        read_lookup_set(spark, tmp_dir, {"PAIS": "pais", "CNAE": "cnae"})
    assert list(read_lookup_set(spark, tmp_dir, {"CNAE": "cnae", "PAIS": "pais"}, strict=False)) == ["pais"]


def test_write_modes(spark, tmp_dir):
    df = spark.range(5)
    path = f"{tmp_dir}/t"
    write_table(df, path, mode="error")
    write_table(df, path, mode="append")
    write_table(df, path, mode="ignore")
    assert spark.read.parquet(path).count() == 10
    with pytest.raises(Exception):
        write_table(df, path, mode="error")
    write_table(df, path, mode="overwrite", encoding="UTF-8")  # text-only option dropped for parquet
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(ValueError):
        write_table(df, path, mode="upsert")


def test_partitioned_and_counted_writes(spark, tmp_dir):
    df = spark.range(100).withColumn("g", (F.col("id") % 3).cast("string"))
    write_table(df, f"{tmp_dir}/p", mode="overwrite", partition_by="g")
    assert sorted(d for d in os.listdir(f"{tmp_dir}/p") if d.startswith("g=")) == ["g=0", "g=1", "g=2"]
    back = spark.read.parquet(f"{tmp_dir}/p")
    assert back.filter("g = '1'").count() == 33
    write_table(df, f"{tmp_dir}/n", mode="overwrite", n_partitions=4)
    assert len(glob.glob(f"{tmp_dir}/n/part-*.parquet")) == 4
    write_table(df, f"{tmp_dir}/r", mode="overwrite", partition_by="g", rebalance=True)
    assert spark.read.parquet(f"{tmp_dir}/r").count() == 100


def test_stage_roundtrip_and_drop(spark, tmp_dir):
    st = stage(spark.range(10), "x", root=f"{tmp_dir}/staging")
    assert st.read().count() == 10
    st.drop()
    assert not path_exists(spark, st.path)


def test_headers_in_different_orders_are_read_by_name(spark, tmp_dir):
    for name, text in (("a", "x;y\n1;2\n"), ("b", "y;x\n20;10\n"), ("c", "\ufeffx;y;z\n5;6;7\n")):
        with open(f"{tmp_dir}/{name}.txt", "w", encoding="utf-8") as f:
            f.write(text)
    ab = read_headered(spark, f"{tmp_dir}/[ab].txt", expected=["x", "y"], strict=True)
    assert {(r.x, r.y) for r in ab.collect()} == {("1", "2"), ("10", "20")}
    every = read_headered(spark, f"{tmp_dir}/*.txt", expected=["x", "y"])
    assert {(r.x, r.y, r.z) for r in every.collect()} == {("1", "2", None), ("10", "20", None), ("5", "6", "7")}
    with pytest.raises(ValueError, match="unknown"):
        read_headered(spark, f"{tmp_dir}/*.txt", expected=["x", "y"], strict=True)
    with pytest.raises(ValueError, match="lacks"):
        read_headered(spark, f"{tmp_dir}/a.txt", expected=["x", "q"], strict=True)


def test_headers_of_compressed_and_large_files(spark, tmp_dir):
    """A compressed dump, one above the cost of an opening (read by a task of its own, which stops early), a BOM,
    an empty file and one without a line end."""
    with gzip.open(f"{tmp_dir}/a.txt.gz", "wt", encoding="utf-8") as f:
        f.write("ação;x\n1;2\n")
    for name, text in (("big", "x;ação\n" + "8;9\n" * 1_300_000), ("bom", "\ufeffação;x\r\n3;4\r\n"), ("empty", ""), ("short", "ação;x")):
        with open(f"{tmp_dir}/{name}.txt", "w", encoding="utf-8", newline="") as f:
            f.write(text)
    assert {k: sorted(os.path.basename(p) for p in v) for k, v in headers_of(spark, tmp_dir, ";", "UTF-8").items()} == {
        ("ação", "x"): ["a.txt.gz", "bom.txt", "short.txt"], ("x", "ação"): ["big.txt"]}
    got = read_headered(spark, tmp_dir, expected=["x", "ação"], strict=True).groupBy("x", "ação").count().collect()
    assert {(r.x, r["ação"], r["count"]) for r in got} == {("2", "1", 1), ("8", "9", 1_300_000), ("4", "3", 1)}


def test_headers_of_ten_thousand_files(spark, tmp_dir):
    for k in range(10_000):
        with open(f"{tmp_dir}/f{k:05}.txt", "w", encoding="latin-1") as f:
            f.write(f"código;y\n{k};1\n")
    df = read_headered(spark, f"{tmp_dir}/*.txt", encoding="ISO-8859-1")
    assert df.columns == ["código", "y"] and df.selectExpr("sum(int(`código`))").first()[0] == 9999 * 5000
    assert headers_of(spark, f"{tmp_dir}/f0000*.txt", ";", "ISO-8859-1") == {("código", "y"): None}


def test_headers_of_nothing(spark, tmp_dir):
    open(f"{tmp_dir}/empty.txt", "w").close()
    assert headers_of(spark, tmp_dir, ";", "UTF-8") == {}
    assert read_headered(spark, tmp_dir, expected=["a"]).collect() == []


def test_partitioned_writes_cluster_their_rows(spark, tmp_dir):
    df = spark.range(0, 4000, 1, 8).selectExpr("id", "id % 5 AS p")
    write_table(df, f"{tmp_dir}/clustered", partition_by="p")
    write_table(df, f"{tmp_dir}/loose", partition_by="p", rebalance=False)
    files = {n: sum(f.endswith(".parquet") for _, _, fs in os.walk(f"{tmp_dir}/{n}") for f in fs) for n in ("clustered", "loose")}
    assert files["clustered"] <= 10 < files["loose"] == 40
    with pytest.raises(ValueError):
        write_table(df, f"{tmp_dir}/both", n_partitions=2, rebalance=True)


def test_a_stored_table_is_merged_into_its_files_without_a_shuffle(spark, tmp_dir):
    """Every file read goes whole into one file written, where a shuffle would deal its rows to all four."""
    from cadastro.plans.catalog import QUERIES

    def written(df):
        held = df.select("l_orderkey", F.input_file_name().alias("f")).groupBy("f").agg(F.collect_list("l_orderkey").alias("k"))
        return [sorted(r.k) for r in held.collect()]

    spark.range(0, 8000, 1, 8).selectExpr("id AS l_orderkey", "id % 7 AS l_partkey").write.parquet(f"{tmp_dir}/lineitem.parquet")
    open_cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1g")  # a reading task for each file
    try:
        files = written(QUERIES["sink_partition_count"](spark, tmp_dir))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", open_cost)
    assert len(files) == 4 and sorted(k for f in files for k in f) == list(range(8000))
    assert all(len({k // 1000 for k in f}) == 2 == len(f) / 1000 for f in files)


def test_uneven_or_few_tasks_are_shuffled_into_even_files(spark, tmp_dir):
    few, none = spark.range(0, 400, 1, 2), spark.range(0, 400, 1, 8).where("id < 0")
    uneven = spark.range(0, 4000, 1, 8).where("id < 1000 OR id % 500 < 20")
    gone = spark.range(0, 4000, 1, 8).where("id >= 1000")  # a merged task without a row
    for name, df in (("few", few), ("uneven", uneven), ("gone", gone), ("none", none)):
        write_table(df, f"{tmp_dir}/{name}", n_partitions=4, shuffle=False)
        back, rows = spark.read.parquet(f"{tmp_dir}/{name}"), sorted(r.id for r in df.collect())
        assert sorted(r.id for r in back.collect()) == rows
        sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
        assert not rows or len(sizes) == 4 and max(sizes) <= 1.1 * len(rows) / 4
    df = spark.range(0, 4000, 1, 8).withColumn("p", F.col("id") % 3)
    write_table(df, f"{tmp_dir}/by", partition_by="p", n_partitions=2, shuffle=False)
    assert len(glob.glob(f"{tmp_dir}/by/p=*/*.parquet")) == 3 and spark.read.parquet(f"{tmp_dir}/by").count() == 4000


def test_rows_are_judged_and_split_in_one_write(spark, tmp_dir):
    lines = ['1;"a;b";x', "2;y", "3;a;b;c", '4;"open;x', '5;"say ""hi"";";z', '"6";"";""', "", "  ", "7;;", ';"q"r;s', "8;ção;x\r"]
    os.makedirs(f"{tmp_dir}/in")
    write_bytes(f"{tmp_dir}/in/a.csv", "\n".join(lines).encode("latin-1"))
    rows = read_checked(spark, f"{tmp_dir}/in", ["a", "b", "c"])
    got = {r[RAW_LINE]: (r[ROW_STATUS], r.a, r.b, r.c) for r in rows.collect()}
    assert got['1;"a;b";x'] == ("ok", "1", "a;b", "x") and got['5;"say ""hi"";";z'] == ("ok", "5", 'say "hi";', "z")
    assert got["2;y"] == ("short", None, None, None) and got["3;a;b;c"][0] == "long" and got['4;"open;x'][0] == "broken"
    assert got["8;ção;x"] == ("ok", "8", "ção", "x") and got["7;;"] == ("ok", "7", None, None) and len(got) == 9
    good, bad = write_split(rows, f"{tmp_dir}/out", ROW_STATUS)
    assert good.columns == ["a", "b", "c", RAW_LINE] and good.count() + bad.count() == 9
    assert {r[RAW_LINE] for r in bad.collect()} == {k for k, v in got.items() if v[0] != "ok"}
    assert all("_row_status=" in f for f in good.inputFiles())
    with pytest.raises(ValueError, match="multiLine"):
        read_checked(spark, f"{tmp_dir}/in", ["a"], multiLine=True)


def test_good_rows_are_read_as_without_the_check(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    write_bytes(f"{tmp_dir}/in/a.csv", '1;"a;b";x\n5;"say ""hi""";z\n7;;\n"8" ; y ;"z"\n'.encode())
    names = ["a", "b", "c"]
    checked = read_checked(spark, f"{tmp_dir}/in", names).where(f"{ROW_STATUS} = 'ok'").select(names)
    assert sorted(map(tuple, checked.collect()), key=str)[:3] == sorted(map(tuple, read_positional(spark, f"{tmp_dir}/in", names).collect()), key=str)[:3]


def test_clustered_files_are_skipped_by_filters_on_any_column(spark, tmp_dir):
    """Row groups whose ranges meet a filter: a fraction on either column, where a plain write has to read all."""
    import datetime as dt

    import pyarrow.parquet as pq

    df = spark.range(0, 40_000, 1, 8).selectExpr(
        "int(pmod(xxhash64(id), 1000)) AS mun", "concat('c', lpad(pmod(xxhash64(id, 1), 500), 4, '0')) AS cnae",
        "date_add(DATE'2020-01-01', int(pmod(xxhash64(id, 2), 900))) AS day", "CASE WHEN id % 3 = 0 THEN 7 ELSE int(id) END AS hot",
        "CASE WHEN id % 11 > 0 THEN id / 7.0D END AS part", "array(id) AS many", "map('k', id) AS pairs")
    write_clustered(df, f"{tmp_dir}/z", ["mun", "cnae", "day"], n_partitions=256)
    write_table(df, f"{tmp_dir}/plain", n_partitions=32)
    assert spark.read.parquet(f"{tmp_dir}/z").schema.simpleString() == df.schema.simpleString()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, spark.read.parquet(f"{tmp_dir}/z").collect())) == sorted(map(key, df.collect()))

    def groups(folder, column, value):
        hit = total = 0
        for f in glob.glob(f"{folder}/*.parquet"):
            meta = pq.ParquetFile(f).metadata
            for g in range(meta.num_row_groups):
                s = next(meta.row_group(g).column(i).statistics for i in range(meta.num_columns) if meta.row_group(g).column(i).path_in_schema == column)
                total, hit = total + 1, hit + (s.min <= value <= s.max)
        return hit / total

    for column, value in (("mun", 137), ("cnae", "c0250"), ("day", dt.date(2021, 5, 5))):
        assert groups(f"{tmp_dir}/plain", column, value) == 1.0 and groups(f"{tmp_dir}/z", column, value) <= 0.35
    write_clustered(df, f"{tmp_dir}/hot", ["hot", "part"], n_partitions=16)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmp_dir}/hot/*.parquet")]
    assert sum(sizes) == 40_000 and max(sizes) < 3 * 40_000 / 16
    write_clustered(df.where("false"), f"{tmp_dir}/none", ["mun"])
    assert spark.read.schema(df.schema).parquet(f"{tmp_dir}/none").count() == 0
