"""Ingestion jobs: links, listings, latest release, fetch plan, archives, codebooks, matching, streaming."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F


from cadastro.operators import archives, ingest, matching
from cadastro.plans import company_register as cr
from cadastro.plans import labour_flows as lf
from cadastro.sources import string_schema
from cadastro.streaming import ingest_new_files


def test_extract_links_with_suffix(spark):
    html = ('<html><a href="a.zip">A</a> <A class="x" HREF=\'b.zip\'>B</A> <a href="c.txt">C</a>'
            '<link href="d.zip"/><a href="q?x=1&amp;y=2.zip">Q</a></html>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = [r.link for r in ingest.extract_links(pages, suffix=".zip").collect()]
    assert got == ["a.zip", "b.zip", "q?x=1&y=2.zip"]  # <link> is not an anchor


def test_listing_and_latest_release(spark):
    lines = [("2022", "01-15-22  10:30AM       <DIR>          01"),
             ("2022", "03-02-22  09:00AM       <DIR>          03"),
             ("2022", "03-02-22  09:00AM       <DIR>          02"),  # same date: larger name wins
             ("2021", "12-31-21  11:59PM       <DIR>          12"),
             ("2021", "total 3"),
             ("1999", "12-31-99  11:59PM       <DIR>          12"),  # two-digit year pivot: 1999, not 2099
             ("1999", "02-30-99  11:59PM       <DIR>          02")]  # not a date
    parsed = ingest.parse_listing(spark.createDataFrame(lines, "folder string, line string"))
    latest = {r.folder: (r.name, r.release_date) for r in ingest.latest_release(parsed).collect()}
    assert latest == {"2022": ("03", dt.date(2022, 3, 2)), "2021": ("12", dt.date(2021, 12, 31)),
                      "1999": ("12", dt.date(1999, 12, 31))}


def test_fetch_plan(spark):
    manifest = spark.createDataFrame([("A.zip",), ("B.zip",), ("C.zip",)], "name string")
    existing = spark.createDataFrame([("A.zip",), ("B",), ("B",), ("Xzip",)], "name string")
    assert sorted(r.name for r in ingest.fetch_plan(manifest, existing).collect()) == ["C.zip"]
    assert ingest.fetch_plan(manifest, existing, overwrite=True).count() == 3


def test_archives_roundtrip_and_parse(spark, tmp_dir):
    rows = [("K1.ESTABELE", '"1";"LOJA Ã"\r\n"2";"B"'), ("K2.ESTABELE", '"3";"C"\n')]
    df = spark.createDataFrame(rows, "member string, text string").repartition(2)
    archives.write_archives(df, f"{tmp_dir}/zips", "member", "text").collect()
    assert len(os.listdir(f"{tmp_dir}/zips")) == 2
    expected = [("K1.ESTABELE", 0, '"1";"LOJA Ã"'), ("K1.ESTABELE", 1, '"2";"B"'), ("K2.ESTABELE", 0, '"3";"C"')]
    lines = archives.expand_archives(spark, f"{tmp_dir}/zips/*.zip")
    assert sorted((r.member, r.line_number, r.line) for r in lines.collect()) == expected
    # written again (as by a task that runs twice): the same files, not more
    archives.write_archives(df, f"{tmp_dir}/zips", "member", "text").collect()
    assert len(os.listdir(f"{tmp_dir}/zips")) == 2
    bad = spark.createDataFrame([("m", "日本")], "member string, text string")
    with pytest.raises(Exception, match="codec can't encode"):
        archives.write_archives(bad, f"{tmp_dir}/bad", "member", "text").collect()
    parsed = archives.lines_to_columns(lines, ["a", "b"])
    assert sorted(tuple(r) for r in parsed.collect()) == [("1", "LOJA Ã"), ("2", "B"), ("3", "C")]


def test_split_codebooks(spark):
    long = spark.createDataFrame([("Região", "1", "Norte"), ("REGIÃO", "2", "Sul"), ("Notas", "x", "y"),
                                  ("Município", "355030", "Sp-Sao Paulo")], "sheet string, code string, description string")
    out = sorted(tuple(r) for r in ingest.split_codebooks(long, lf.CODEBOOK_FILES["mov"]).collect())
    assert out == [("municipio", "355030", "Sp-Sao Paulo"), ("regiao", "1", "Norte"), ("regiao", "2", "Sul")]
    frames = ingest.codebook_frames(ingest.split_codebooks(long, lf.CODEBOOK_FILES["mov"]), ["regiao"])
    assert frames["regiao"].columns == ["cod_regiao", "regiao"]


def test_tiered_match(spark):
    addrs = spark.createDataFrame([
        (1, "Rua A", "01000", "Centro", "Sao Paulo", "SP"),   # address tier, score 100
        (2, "Rua B", "02000", "Centro", "Sao Paulo", "SP"),   # address score 85 but quality too coarse -> district
        (3, "Rua C", "03000", "Norte", "Sao Paulo", "SP"),    # district score 70 -> zip
        (4, "Rua D", "04000", "Sul", "Campinas", "SP"),       # nothing
    ], "id int, rua string, cep string, bairro string, cidade string, uf string")
    gaz = spark.createDataFrame([
        ("address", "Rua A, Centro, Sao Paulo, SP", "Rua A, Sao Paulo", 1.0, 1.0, 100, "Locality"),
        ("address", "Rua A, Centro, Sao Paulo, SP", "Rua A, Sao Paulo", 9.0, 9.0, 90, "PointAddress"),
        ("address", "Rua B, Centro, Sao Paulo, SP", "Rua B, Sao Paulo", 2.0, 2.0, 85, "Locality"),
        ("district", "Centro, Sao Paulo, SP", "Centro, Sao Paulo", 3.0, 3.0, 80, "Locality"),
        ("district", "Norte, Sao Paulo, SP", "Norte, Sao Paulo", 4.0, 4.0, 70, "Locality"),
        ("zip", "03000, Sao Paulo, SP", "03000", 5.0, 5.0, 10, "Postal"),
    ], "grain string, key string, matched_address string, lat double, lng double, score int, quality string")
    out = matching.tiered_match(addrs, gaz, street="rua", zip_code="cep", district="bairro", city="cidade", state="uf")
    got = sorted((r.id, r.match_tier, r.lat) for r in out.collect())
    assert got == [(1, "address", 1.0), (2, "district", 3.0), (3, "zip", 5.0), (4, None, None)]


def test_incremental_ingest_adds_only_new_files(spark, tmp_dir):
    cols = list(cr.SIMPLES_COLUMNS)
    land, out, ckpt = f"{tmp_dir}/land", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    schema = string_schema(cols)

    def drop(name, rows):
        os.makedirs(land, exist_ok=True)
        with open(f"{land}/{name}", "w", encoding="latin-1") as fh:
            fh.write("\n".join(";".join(f'"{v}"' for v in r) for r in rows) + "\n")

    drop("a.csv", [("1", "S", "20200101", "", "N", "", "")])
    ingest_new_files(spark, land, schema, out, ckpt, transform=cr.consolidate_regime)
    assert spark.read.parquet(out).count() == 1
    drop("b.csv", [("2", "N", "20200102", "", "N", "", ""), ("3", "N", "00000000", "", "N", "", "")])
    ingest_new_files(spark, land, schema, out, ckpt, transform=cr.consolidate_regime)
    ingest_new_files(spark, land, schema, out, ckpt, transform=cr.consolidate_regime)  # nothing new
    got = sorted((r.cnpj, r.data_inclusao_simples) for r in spark.read.parquet(out).collect())
    assert got == [("00000001", dt.date(2020, 1, 1)), ("00000002", dt.date(2020, 1, 2)), ("00000003", None)]


def test_streaming_consolidation_with_lookups(spark, tmp_dir):
    """The establishments spec (two broadcast lookups) on a stream: stream-static joins, no state."""
    from cadastro.plans import catalog
    from tests.conftest import SF001

    land = f"{tmp_dir}/estab"
    catalog._write_positional(catalog.raw_establishments(spark, SF001), f"{land}/drop1")
    mun = catalog.lookup_dim(spark, SF001, "nation", "mun")
    pais = catalog.lookup_dim(spark, SF001, "region", "pais")
    ingest_new_files(spark, f"{land}/*", string_schema(cr.ESTAB_COLUMNS), f"{tmp_dir}/out", f"{tmp_dir}/ckpt",
                     transform=lambda df: cr.consolidate_establishments(df, mun, pais))
    batch = cr.consolidate_establishments(catalog.raw_establishments(spark, SF001), mun, pais)
    streamed = spark.read.parquet(f"{tmp_dir}/out")
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch.select(streamed.columns)).count() == 0


def test_archive_members_are_read_by_entry_in_many_tasks(spark, tmp_dir):
    import warnings
    import zipfile

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")  # the duplicate name
        for a in range(4):
            with zipfile.ZipFile(f"{tmp_dir}/a{a}.zip", "w") as zf:
                for m in range(15):
                    zf.writestr(f"m{m}", f"{a} {m}\nend")
                zf.writestr("m0", "second m0")
    lines = archives.expand_archives(spark, f"{tmp_dir}/*.zip")
    got = [(r.archive[-6:], r.member, r.line_number, r.line) for r in lines.collect()]
    assert len(got) == 4 * 31 and sum(line == "second m0" for *_, line in got) == 4
    assert ("a2.zip", "m0", 0, "2 0") in got
    assert lines.select(F.spark_partition_id()).distinct().count() > 8


def test_releases_of_roots_with_equal_folder_names(spark):
    def listing(rows):
        return ingest.parse_listing(spark.createDataFrame(rows, "folder string, line string"))

    years = listing([("A", "01-01-24 10:00AM 2024"), ("B", "01-01-24 10:00AM 2024"), ("A", "01-01-23 10:00AM 2023")])
    months = listing([("A/2024", "02-01-24 10:00AM jan"), ("B/2024", "03-01-24 10:00AM mar"), ("A/2023", "09-01-24 10:00AM x")])
    files = listing([("A/2024/jan", "02-01-24 10:00AM 1 f.zip"), ("A/2024/jan", "02-01-24 10:00AM 1 g.zip"),
                     ("B/2024/mar", "03-01-24 10:00AM 1 h.zip"), ("B/2024/jan", "03-01-24 10:00AM 1 no.zip")])
    got = {(r.root, r.path) for r in ingest.latest_path([years, months]).collect()}
    assert got == {("A", "2024/jan"), ("B", "2024/mar")}
    found = {(r.root, r.path, r["name"]) for r in ingest.release_files([years, months], files).collect()}
    assert found == {("A", "2024/jan", "f.zip"), ("A", "2024/jan", "g.zip"), ("B", "2024/mar", "h.zip")}


def test_links_in_every_quote_style(spark):
    html = """<a href="it's.zip">x</a> <A class=c HREF='b&quot;q.zip'>y</A> <a href=bare.zip?x=1&amp;y=2>z</a> <a data-href="no" href="">"""
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    links = [r.link for r in ingest.extract_links(pages).collect()]
    assert links == ["it's.zip", 'b"q.zip', "bare.zip?x=1&y=2", ""]
    assert [r.link for r in ingest.extract_links(pages, suffix=".zip").collect()] == ["it's.zip", 'b"q.zip']


def test_files_older_than_a_week_are_read(spark, tmp_dir):
    cols = list(cr.SIMPLES_COLUMNS)
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    for k, age in enumerate((0, 30, 400)):
        os.makedirs(f"{tmp_dir}/land/d{k}")
        with open(f"{tmp_dir}/land/d{k}/x.csv", "w") as f:
            f.write(";".join([str(k)] * len(cols)) + "\n")
        old = os.path.getmtime(f"{tmp_dir}/land/d{k}/x.csv") - age * 86_400
        os.utime(f"{tmp_dir}/land/d{k}/x.csv", (old, old))
        assert ingest_new_files(spark, f"{tmp_dir}/land/*", string_schema(cols), out, ckpt, transform=cr.consolidate_regime) is None
        assert spark.read.parquet(out).count() == k + 1


def test_newest_paths_to_any_depth(spark):
    """Trees of unlike depth in one listing; a branch that is not the newest goes deeper; undated and file entries."""
    rows = [("a", "2023", "2023-05-01", True), ("a", "2024", "2024-01-01", True), ("a/2023", "12", "2023-12-01", True),
            ("a/2024", "01", "2024-01-05", True), ("a/2024", "02", "2024-02-05", True), ("a/2024/02", "x", "2024-02-06", True),
            ("a/2024/02/x", "f.zip", "2024-02-07", False), ("b", "only", "2020-01-01", True), ("c", "f.zip", "2020-01-01", False),
            ("d", "undated", None, True), ("e", "s", "2021-01-01", True), ("e", "t", "2021-01-01", True)]
    df = spark.createDataFrame(rows, "folder string, name string, d string, is_folder boolean").selectExpr(
        "folder", "name", "CAST(d AS DATE) AS release_date", "is_folder").repartition(3)
    got = {r.root: (r.path, r.name, r.depth) for r in ingest.newest_paths(df).collect()}
    assert got == {"a": ("2024/02/x", "x", 3), "b": ("only", "only", 1), "e": ("t", "t", 1)}
    assert ingest.newest_paths(df.where("false")).count() == 0
    deep = spark.createDataFrame([("/".join(["r", *map(str, range(i))]), str(i), True) for i in range(40)], "folder string, name string, is_folder boolean")
    deep = deep.selectExpr("folder", "name", "DATE'2024-01-01' AS release_date", "is_folder")
    assert ingest.newest_paths(deep).first().depth == 40
    with pytest.raises(RuntimeError, match="nest deeper"):
        ingest.newest_paths(deep, max_depth=10)


def test_an_archive_is_opened_once_a_task(spark, tmp_dir, monkeypatch):
    """Many members cost in proportion: the directory is read by every task, not for every member."""
    import zipfile

    import pandas as pd

    for name in ("a", "b"):
        with zipfile.ZipFile(f"{tmp_dir}/{name}.zip", "w") as zf:
            for i in range(300):
                zf.writestr(f"m{i}", f"{name}{i}\nend")
    members = pd.DataFrame([(f"{tmp_dir}/{n}.zip", i) for n in "ab" for i in range(300)], columns=["archive", "entry"])
    opened = []
    real = archives._open_storage
    monkeypatch.setattr(archives, "_open_storage", lambda uri: opened.append(uri) or real(uri))
    got = pd.concat(archives._stream_members("UTF-8", 100)(iter([members[:250], members[250:]])))
    assert len(opened) == 2 and len(got) == 1200 and set(got.line[got.line_number == 0]) == {f"{n}{i}" for n in "ab" for i in range(300)}
    monkeypatch.undo()
    assert archives.expand_archives(spark, f"{tmp_dir}/*.zip").count() == 1200


def test_content_delivered_again_adds_nothing(spark, tmp_dir):
    """Renamed, reordered and batched copies; a file with one row more; rows that repeat count; nulls are no texts."""
    from cadastro.streaming import ingest_new_content

    landing, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    os.makedirs(landing)

    def land(name, lines):
        with open(f"{landing}/{name}.csv", "w", encoding="latin-1") as f:
            f.write("\n".join(lines) + "\n")

    def run(**kw):
        ingest_new_content(spark, landing, string_schema(["a", "b"]), out, ckpt, **kw)
        return sorted((r.a or "", r.b or "") for r in spark.read.parquet(out).collect())

    land("one", ["1;x", "2;y", "2;y"])
    land("same", ["2;y", "1;x", "2;y"])  # alike in one batch
    assert run() == [("1", "x"), ("2", "y"), ("2", "y")]
    land("renamed", ["2;y", "2;y", "1;x"])
    land("fewer", ["1;x", "2;y"])
    land("null", [";x"])
    land("other_null", ["x;"])
    want = sorted([("1", "x"), ("2", "y"), ("2", "y"), ("1", "x"), ("2", "y"), ("", "x"), ("x", "")])
    assert run(max_files_per_trigger=1) == want
    assert run() == want  # nothing new
    land("late", ["1;x", "2;y", "2;y"])
    assert run() == want


def test_a_batch_that_runs_again_writes_its_rows_once(spark, tmp_dir):
    from cadastro.streaming import ingest_new_content

    landing, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    os.makedirs(landing)
    with open(f"{landing}/a.csv", "w") as f:
        f.write("1;x\n2;y\n")
    calls = []

    def flaky(df):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("lost")
        return df

    with pytest.raises(Exception, match="lost"):
        ingest_new_content(spark, landing, string_schema(["a", "b"]), out, ckpt, transform=flaky)
    ingest_new_content(spark, landing, string_schema(["a", "b"]), out, ckpt, transform=flaky)
    assert sorted(r.a for r in spark.read.parquet(out).collect()) == ["1", "2"]
