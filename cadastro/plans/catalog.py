"""Every operator as a query over the benchmark tables: ``QUERIES[name](spark, sf_dir) -> DataFrame``.

Each query reads whole tables (no sampling, no id subsets), reshapes them into the raw registry layout
(:mod:`cadastro.plans.fixtures`) and applies the library operator. Queries about files (scans, sinks,
archives, streaming) first write the derived raw data below the shared checkpoint folder with a Spark
job, then return the frame that reads it back.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as cf
from ..operators import archives, ingest, links, matching
from ..operators.cleaning import clean_types, kinds_by_rule
from ..operators.lookups import broadcast_within_bound, inner_lookup, left_lookup, role_lookup, star_lookup
from ..operators.losses import Losses
from ..operators.losses import report as losses_report
from ..operators.rename import rename_map
from ..session import delete_path, scratch_path, set_modified, shuffles_deleted
from ..sources import delimited, sinks
from ..streaming import ingest_new_content, ingest_new_files
from . import company_register as cr
from . import fixtures as fx
from . import labour_flows as lf

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derive(df: DataFrame, pairs) -> DataFrame:
    return df.select(*[F.expr(e).alias(c) for c, e in pairs])


# ---- raw frames ---------------------------------------------------------------------------------------

def raw_lookup(spark, sf, source: str, name: str) -> DataFrame:
    maker = {"nation": fx.lookup_nation, "region": fx.lookup_region, "part": fx.lookup_part,
             "supplier": fx.lookup_supplier, "customer": fx.lookup_customer}[source]
    return derive(table(spark, sf, source), maker(name))


def lookup_dim(spark, sf, source: str, name: str) -> DataFrame:
    return cr.consolidate_lookup(raw_lookup(spark, sf, source, name), name)


def raw_establishments(spark, sf, bounded: bool = False) -> DataFrame:
    """``bounded`` broadcasts parts and suppliers while their size is within the library's bound, so that the lines
    are shuffled for neither of them or for one only."""
    li, p, s = table(spark, sf, "lineitem"), table(spark, sf, "part"), table(spark, sf, "supplier")
    if bounded:
        p, s = p.select("p_partkey", "p_name", "p_brand", "p_type"), s.select("s_suppkey", "s_name", "s_nationkey")
        p, s = broadcast_within_bound({"part": (p, "p_partkey"), "supplier": (s, "s_suppkey")}).values()
    joined = li.join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey)
    return derive(joined, fx.raw_establishments(fx.SPARK))


def raw_partners(spark, sf) -> DataFrame:
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return derive(o.join(c, o.o_custkey == c.c_custkey), fx.raw_partners(fx.SPARK))


def raw_companies(spark, sf) -> DataFrame:
    return derive(table(spark, sf, "customer"), fx.raw_companies(fx.SPARK))


def raw_regime(spark, sf) -> DataFrame:
    return derive(table(spark, sf, "orders"), fx.raw_regime(fx.SPARK))


def raw_movements(spark, sf) -> DataFrame:
    return derive(table(spark, sf, "events"), fx.raw_movements(fx.SPARK))


def raw_estab_flows(spark, sf) -> DataFrame:
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return derive(o.join(c, o.o_custkey == c.c_custkey), fx.raw_estab_flows(fx.SPARK))


def codebooks_for(spark, sf, codes: dict) -> dict[str, DataFrame]:
    books = {}
    for name, (source, _) in codes.items():
        raw = derive(table(spark, sf, fx.codebook_table(source)), fx.codebook_rows(name, source))
        books[name] = lf.prepare_codebook(raw, name)
    return books


# ---- scalar functions ---------------------------------------------------------------------------------

def q_ascii_fold(spark, sf):
    return table(spark, sf, "documents").select("doc_id", cf.ascii_fold("text").alias("folded"))


def q_ascii_fold_latin1(spark, sf):
    """The signs of Latin-1 (U+00A0 to U+00BF and all letters) planted one per part name."""
    df = table(spark, sf, "part").select("p_partkey", F.expr("p_name || chr(int(160 + p_partkey % 96)) || 'x'").alias("raw"))
    return df.select("p_partkey", cf.ascii_fold("raw").alias("folded"))


def q_clean_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", cf.clean_text("text").alias("cleaned"))


def q_lenient_int(spark, sf):
    raw = F.expr("CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN 'x' "
                 "WHEN c_custkey % 13 = 0 THEN replace(CAST(c_acctbal AS STRING), '.', ',') "
                 "WHEN c_custkey % 17 = 0 THEN ' ' || CAST(c_nationkey AS STRING) || ' ' "
                 "ELSE CAST(c_acctbal AS STRING) END")
    df = table(spark, sf, "customer").select("c_custkey", raw.alias("raw"))
    return df.select("c_custkey", "raw", cf.lenient_int("raw").alias("value"))


def q_lenient_double(spark, sf):
    raw = F.expr("CASE WHEN l_linenumber = 7 THEN '' WHEN l_orderkey % 11 = 0 THEN 'x' "
                 "WHEN l_orderkey % 13 = 0 THEN replace(CAST(l_extendedprice AS STRING), '.', ',') "
                 "ELSE CAST(l_extendedprice AS STRING) END")
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return df.withColumn("value", cf.lenient_double("raw"))


def q_decimal_comma(spark, sf):
    raw = F.expr("CASE WHEN c_custkey % 7 = 0 THEN '' "
                 "WHEN c_custkey % 9 = 0 THEN '1.' || replace(CAST(c_acctbal AS STRING), '.', ',') "
                 "ELSE replace(CAST(c_acctbal AS STRING), '.', ',') END")
    df = table(spark, sf, "customer").select("c_custkey", raw.alias("raw"))
    return df.withColumn("value", cf.decimal_comma("raw"))


def q_lenient_date(spark, sf):
    ymd = "date_format(o_orderdate, 'yyyyMMdd')"
    raw = F.expr(f"CASE WHEN o_orderkey % 7 = 0 THEN '00000000' WHEN o_orderkey % 11 = 0 THEN '20210230' "
                 f"WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 17 = 0 THEN substr({ymd}, 1, 7) ELSE {ymd} END")
    df = table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    return df.withColumn("value", cf.lenient_date("raw"))


def q_year_month(spark, sf):
    raw = F.expr("CASE WHEN l_orderkey % 7 = 0 THEN date_format(l_shipdate, 'yyyyMMdd') "
                 "WHEN l_orderkey % 11 = 0 THEN '' ELSE date_format(l_shipdate, 'yyyyMM') END")
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return df.withColumn("value", cf.year_month("raw"))


def q_zero_pad(spark, sf):
    raw = F.expr("CASE WHEN c_custkey % 5 = 0 THEN CAST(c_custkey * 1000003 AS STRING) "
                 "WHEN c_custkey % 7 = 0 THEN '' ELSE CAST(c_custkey AS STRING) END")
    df = table(spark, sf, "customer").select("c_custkey", "c_nationkey", raw.alias("raw"))
    return df.select("c_custkey", "raw", cf.zero_pad("raw", 8).alias("padded"),
                     cf.zero_pad(F.col("c_nationkey").cast("string"), 7).alias("activity"))


def q_compose_id(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        cf.zero_pad(F.col("l_orderkey").cast("string"), 8).alias("root"),
        F.when(F.col("l_linenumber") != 7, cf.zero_pad(F.col("l_linenumber").cast("string"), 4)).alias("ordem"),
        cf.zero_pad((F.col("l_suppkey") % 100).cast("string"), 2).alias("dv"),
    )
    return df.select("l_orderkey", "l_linenumber", "l_suppkey", cf.compose_id("root", "ordem", "dv").alias("full_id"))


def q_code_label(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey",
                    cf.code_label(F.col("o_orderkey") % 12, cf.AGE_BANDS).alias("faixa_etaria"),
                    cf.code_label(F.col("o_orderkey") % 5, cf.PARTNER_KINDS).alias("id_socio"))


def q_code_label_beside(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", (F.col("p_size") % 7).cast("int").alias("porte"))
    return p.withColumn("nome_porte", cf.code_label("porte", cf.COMPANY_SIZES))


def q_code_label_text(spark, sf):
    raw = F.expr("CASE WHEN l_orderkey % 13 = 0 THEN 'x' ELSE CAST(l_linenumber % 4 AS STRING) END")
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return df.withColumn("id_matriz", cf.code_label(cf.lenient_int("raw"), cf.HEAD_OFFICE))


def q_upper_trim(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", cf.upper_trim(F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit("  "))).alias("uf"))


def q_fix_email(spark, sf):
    p = table(spark, sf, "part")
    raw = F.concat(F.lit(" "), F.upper("p_brand"), F.lit("'"), F.col("p_type"), F.lit(".COM "))
    return p.select("p_partkey", cf.fix_email(raw).alias("email"))


def q_blank_sentinels(spark, sf):
    raw = F.expr("CASE c_custkey % 5 WHEN 0 THEN 'S/N' WHEN 1 THEN 'S/N B' WHEN 2 THEN NULL "
                 "ELSE CAST(c_custkey AS STRING) END")
    return table(spark, sf, "customer").select("c_custkey", cf.blank_sentinels(raw).alias("numero"))


def q_split_take(spark, sf):
    raw = F.expr("CASE c_custkey % 4 WHEN 0 THEN 'SP-' || c_mktsegment "
                 "WHEN 1 THEN 'RJ-' || lower(c_mktsegment) || '-sai' WHEN 2 THEN c_mktsegment END")
    df = table(spark, sf, "customer").select("c_custkey", raw.alias("raw"))
    d = lf.UNKNOWN_MUNICIPALITY
    return df.select("c_custkey",
                     cf.initcap_or(cf.split_take("raw", "-", 1), d).alias("municipio"),
                     cf.initcap_or(cf.split_take("raw", "-", 1, keep_rest=True), d).alias("municipio_full"))


def q_typed_by_group(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        F.expr("CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE CAST(o_custkey AS STRING) END").alias("cod_cliente"),
        F.col("o_orderpriority").alias("nome_prioridade"),
        F.expr("CASE WHEN o_orderkey % 7 = 0 THEN '00000000' ELSE date_format(o_orderdate, 'yyyyMMdd') END")
        .alias("data_pedido"),
        F.col("o_totalprice").cast("string").alias("valor"),
    )
    kinds = kinds_by_rule(o.columns, {"int": {"prefix": "cod"}, "text": {"prefix": "nome"}, "date": {"contains": "data"}})
    return o.transform(clean_types(kinds))


def q_rename_map(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyyMM").alias("competência"),
        (F.col("o_custkey") % 5).cast("string").alias("Região"),
        ((F.col("o_orderkey") % 3) - 1).cast("string").alias("saldomovimentação"),
    )
    return o.transform(rename_map(lf.RENAMES["mov"]))


# ---- lookups ------------------------------------------------------------------------------------------

def _keyed_lineitem(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.expr("CASE WHEN l_orderkey % 9 = 0 THEN 99 ELSE CAST(l_suppkey % 25 AS INT) END").alias("cod_pais"),
    )


def q_left_lookup(spark, sf):
    return left_lookup(_keyed_lineitem(spark, sf), lookup_dim(spark, sf, "nation", "pais"), "cod_pais")


def q_inner_lookup(spark, sf):
    return inner_lookup(_keyed_lineitem(spark, sf), lookup_dim(spark, sf, "nation", "pais"), "cod_pais")


def q_lookup_unmatched(spark, sf):
    """The rows an inner lookup drops (unknown or null code), as the report next to the inner join."""
    from ..operators.lookups import unmatched

    return unmatched(_keyed_lineitem(spark, sf), lookup_dim(spark, sf, "nation", "pais"), "cod_pais")


def _skewed_lineitem(spark, sf):
    """lineitem with a third of all rows on one code, and unknown and null codes."""
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.expr(
        "CASE WHEN l_orderkey % 3 = 0 THEN 7 WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 9 = 1 THEN 99 "
        "ELSE CAST(l_suppkey % 25 AS INT) END").alias("cod_pais"))


def q_left_lookup_salted(spark, sf):
    """The way a lookup side above the broadcast bound is joined: hot keys salted."""
    return left_lookup(_skewed_lineitem(spark, sf), lookup_dim(spark, sf, "nation", "pais"), "cod_pais", strategy="salted")


def q_lookup_unmatched_salted(spark, sf):
    from ..operators.lookups import unmatched

    return unmatched(_skewed_lineitem(spark, sf), lookup_dim(spark, sf, "nation", "pais"), "cod_pais", strategy="salted")


def q_star_lookup_salted(spark, sf):
    ev = table(spark, sf, "events").select(
        "event_id", F.expr("CASE WHEN event_id % 3 = 0 THEN '1' ELSE CAST(user_id % 7 AS STRING) END").alias("cod_regiao"),
        F.expr("CASE WHEN event_id % 2 = 0 THEN '4' ELSE CAST(event_id % 30 AS STRING) END").alias("cod_uf"))
    return star_lookup(ev, codebooks_for(spark, sf, {"regiao": ("region", ""), "uf": ("nation", "")}), strategy="salted")


def q_role_lookup(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.expr("CAST(l_suppkey % 25 AS INT)").alias("cod_qual_socio"),
        F.expr("CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE CAST(l_partkey % 30 AS INT) END")
        .alias("cod_qual_socio_rep_legal"),
    )
    dim = lookup_dim(spark, sf, "nation", "qual_socio")
    out = role_lookup(li, dim, "cod_qual_socio", "_rep_legal")
    return left_lookup(out, dim, "cod_qual_socio")


def q_star_lookup(spark, sf):
    ev = table(spark, sf, "events").select(
        "event_id",
        F.expr("CAST(user_id % 7 AS STRING)").alias("cod_regiao"),
        F.expr("CAST(event_id % 30 AS STRING)").alias("cod_uf"),
        F.expr("CAST(user_id % 25 AS STRING)").alias("cod_secao"),
    )
    books = codebooks_for(spark, sf, {"regiao": ("region", ""), "uf": ("nation", ""), "secao": ("nation", "")})
    return star_lookup(ev, books)


# ---- whole tables -------------------------------------------------------------------------------------

def q_consolidate_lookups(spark, sf):
    sources = {"mun": "nation", "pais": "region", "cnae": "part", "natju": "supplier", "motivo": "customer", "qual_socio": "nation"}
    parts = [lookup_dim(spark, sf, src, name).toDF("code", "name").withColumn("lookup", F.lit(name))
             for name, src in sources.items()]
    return reduce(DataFrame.unionByName, parts)


def q_consolidate_regime(spark, sf):
    return cr.consolidate_regime(raw_regime(spark, sf))


def q_consolidate_partners(spark, sf):
    return cr.consolidate_partners(raw_partners(spark, sf), lookup_dim(spark, sf, "nation", "qual_socio"),
                                   lookup_dim(spark, sf, "region", "pais"))


def q_consolidate_companies(spark, sf):
    return cr.consolidate_companies(raw_companies(spark, sf), lookup_dim(spark, sf, "nation", "natju"),
                                    lookup_dim(spark, sf, "region", "qual_socio"))


def q_consolidate_establishments(spark, sf):
    return cr.consolidate_establishments(raw_establishments(spark, sf), lookup_dim(spark, sf, "nation", "mun"),
                                         lookup_dim(spark, sf, "region", "pais"), with_full_id=True)


def q_consolidate_movements(spark, sf):
    return lf.consolidate_flows(raw_movements(spark, sf), "mov", codebooks_for(spark, sf, fx.MOV_CODES))


def q_consolidate_estab_flows(spark, sf):
    return lf.consolidate_flows(raw_estab_flows(spark, sf), "estab", codebooks_for(spark, sf, fx.ESTAB_FLOW_CODES))


def q_loss_report(spark, sf):
    """What the establishments consolidation loses, counted by the one job that writes it."""
    losses = Losses("df_estab")
    path = scratch_path(spark, "loss_report")
    sinks.write_table(cr.consolidate_establishments(raw_establishments(spark, sf), lookup_dim(spark, sf, "nation", "mun"),
                                                    lookup_dim(spark, sf, "region", "pais"), losses=losses), path)
    return losses_report(spark, [losses])


# ---- scans --------------------------------------------------------------------------------------------

def _write_positional(df: DataFrame, path: str, encoding: str = "ISO-8859-1", header: bool = False, sep: str = ";", **options):
    sinks.write_table(df, path, mode="overwrite", fmt="csv", sep=sep, encoding=encoding, header=str(header).lower(),
                      quote='"', escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", **options)


def q_scan_positional(spark, sf):
    pairs = fx.documents_positional(fx.SPARK)
    path = scratch_path(spark, "scan_positional")
    _write_positional(derive(table(spark, sf, "documents"), pairs), path)
    read = delimited.read_positional(spark, path, [c for c, _ in pairs])
    # The line breaks of the text, undone: pairs of backslashes are set aside first.
    aside = F.replace("texto", F.lit("\\\\"), F.lit("\x01"))
    breaks = F.replace(F.replace(aside, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return read.withColumn("texto", F.replace(breaks, F.lit("\x01"), F.lit("\\")))


def q_scan_rejects(spark, sf):
    """A dump with short, long and broken rows among good ones (some with separators and quotes inside quoted
    fields), split in one write; both parts read back."""
    root = scratch_path(spark, "scan_rejects")
    derive(table(spark, sf, "orders"), fx.order_lines(fx.SPARK)).write.text(f"{root}/dump")
    rows = delimited.read_checked(spark, f"{root}/dump", ["o_orderkey", "priority", "status", "day"], encoding="UTF-8")
    good, bad = sinks.write_split(rows, f"{root}/split", delimited.ROW_STATUS)
    return good.drop(delimited.RAW_LINE).withColumn("row_status", F.lit("ok")).withColumn("line", F.lit(None).cast("string")).unionByName(
        bad.select("o_orderkey", "priority", "status", "day", F.col(delimited.ROW_STATUS).alias("row_status"), F.col(delimited.RAW_LINE).alias("line")))


def q_scan_headered(spark, sf):
    """The whole layout, in files of two column orders."""
    pairs = [("event_id", "CAST(event_id AS STRING)")] + fx.raw_movements(fx.SPARK)
    raw = derive(table(spark, sf, "events"), [*pairs, ("_odd", "event_id % 2")])
    names, path = [c for c, _ in pairs], scratch_path(spark, "scan_headered")
    _write_positional(raw.filter("_odd = 0").select(names), f"{path}/a.txt", encoding="UTF-8", header=True)
    _write_positional(raw.filter("_odd = 1").select(names[::-1]), f"{path}/b.txt", encoding="UTF-8", header=True)
    df = delimited.read_headered(spark, f"{path}/*.txt", expected=names, strict=True)
    return df.transform(rename_map(lf.RENAMES["mov"]))


def q_scan_glob(spark, sf):
    """A dump folder matched by the file glob, its part files in sub-folders; a decoy folder is skipped.

    The raw rows are written once, split into sub-folders by order-key parity (every row lands in one);
    reading the glob takes the whole folder, and the partition column it discovers is dropped by the
    table's ordered output projection.
    """
    raw = derive(table(spark, sf, "orders"), fx.raw_regime(fx.SPARK) + [("part", "o_orderkey % 2")])
    root = scratch_path(spark, "scan_glob")
    cols = [c for c, _ in fx.raw_regime(fx.SPARK)]
    sinks.write_table(raw, f"{root}/K3241.K03200Y0.D40113.SIMPLES.CSV.D40113", mode="overwrite", fmt="csv",
                      partition_by="part", sep=";", encoding="ISO-8859-1", quote='"', escape='"',
                      ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
    _write_positional(raw.select(cols), f"{root}/K3241.K03200Y0.D40113.EMPRECSV")  # must not be read
    return cr.consolidate_regime(delimited.read_positional(spark, f"{root}/{cr.GLOBS['simples']}", cols))


def q_scan_lookup_set(spark, sf):
    root = scratch_path(spark, "scan_lookup_set")
    sources = {"CNAE": "part", "MUNIC": "nation", "NATJU": "supplier", "PAIS": "region", "QUALS": "nation",
               "MOTI": "customer"}
    for file_id, src in sources.items():
        name = cr.LOOKUP_IDS[file_id]
        _write_positional(raw_lookup(spark, sf, src, name), f"{root}/F.K03200$Z.D40113.{file_id}CSV")
    _write_positional(raw_lookup(spark, sf, "region", "x"), f"{root}/F.K03200$Z.D40113.LEIAME")  # not a lookup
    frames = delimited.read_lookup_set(spark, root, cr.LOOKUP_IDS)
    parts = [cr.consolidate_lookup(df, name).toDF("code", "name").withColumn("lookup", F.lit(name))
             for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


# ---- sinks --------------------------------------------------------------------------------------------

def q_sink_roundtrip(spark, sf):
    path = scratch_path(spark, "sink_roundtrip")
    sinks.write_table(table(spark, sf, "orders"), path, mode="error", encoding="UTF-8")
    return spark.read.parquet(path)


def q_sink_modes(spark, sf):
    path = scratch_path(spark, "sink_modes")
    cust = table(spark, sf, "customer")
    sinks.write_table(cust, path, mode="error")
    sinks.write_table(cust, path, mode="append")
    sinks.write_table(cust, path, mode="ignore")  # path exists: nothing is written (the count proves it)
    try:
        sinks.write_table(cust, path, mode="error")
    except Exception:  # noqa: BLE001 - the expected "path already exists"
        pass
    else:
        raise AssertionError("mode='error' wrote over an existing table")
    return spark.read.parquet(path)


def q_sink_partitioned(spark, sf):
    path = scratch_path(spark, "sink_partitioned")
    sinks.write_table(table(spark, sf, "orders"), path, mode="overwrite", partition_by="o_orderstatus")
    return spark.read.parquet(path)


def q_sink_partition_count(spark, sf):
    path = scratch_path(spark, "sink_partition_count")
    sinks.write_table(table(spark, sf, "lineitem"), path, mode="overwrite", n_partitions=4, shuffle=False)
    return spark.read.parquet(path)


def q_sink_clustered(spark, sf):
    """Lines clustered by supplier, part and ship date at once; read back."""
    path = scratch_path(spark, "sink_clustered")
    sinks.write_clustered(table(spark, sf, "lineitem"), path, ["l_suppkey", "l_partkey", "l_shipdate"])
    return spark.read.parquet(path)


def q_staged_consolidation(spark, sf):
    """Raw text -> staged parquet -> consolidated establishments (the staging layer kept for re-reads)."""
    root = scratch_path(spark, "staged")
    _write_positional(raw_establishments(spark, sf), f"{root}/raw/K3241.K03200Y0.D40113.ESTABELE")
    raw = delimited.read_positional(spark, f"{root}/raw/{cr.GLOBS['estab']}", cr.ESTAB_COLUMNS)
    staged = sinks.stage(raw, "estab", root=f"{root}/staging")
    return cr.consolidate_establishments(staged.read(), lookup_dim(spark, sf, "nation", "mun"),
                                         lookup_dim(spark, sf, "region", "pais"), with_full_id=True)


# ---- ingestion ----------------------------------------------------------------------------------------

def q_extract_links(spark, sf):
    return ingest.extract_links(table(spark, sf, "pages"))


def q_extract_links_suffix(spark, sf):
    return ingest.extract_links(table(spark, sf, "pages"), suffix="e")


def _listing(spark, sf):
    return ingest.parse_listing(derive(table(spark, sf, "events"), fx.listing_lines(fx.SPARK)))


def q_parse_listing(spark, sf):
    return _listing(spark, sf).select("event_id", "folder", "release_date", "name")


def q_latest_release(spark, sf):
    return ingest.latest_release(_listing(spark, sf))


def _release_levels(spark, sf):
    tree, orders = fx.release_tree(fx.SPARK), table(spark, sf, "orders")
    return [ingest.parse_listing(derive(orders, tree[level])) for level in ("years", "months", "files")]


def q_latest_path(spark, sf):
    """Newest year folder, then the newest month folder inside it, for several roots with equal names."""
    return ingest.latest_path(_release_levels(spark, sf)[:2])


def q_latest_path_deep(spark, sf):
    """Newest path from every root of one listing, in trees of one to five levels of folders."""
    listing = derive(table(spark, sf, "orders"), fx.deep_listing(fx.SPARK)).select("folder", F.explode("lines").alias("e")).where("e.line IS NOT NULL").select(
        F.concat_ws("/", "folder", "e.below").alias("folder"), F.col("e.line").alias("line"))
    parsed = ingest.parse_listing(listing).withColumn("is_folder", F.col("line").contains("<DIR>"))
    return ingest.newest_paths(parsed)


def q_resolved_links(spark, sf):
    """The links of every page against its URL, with references of all kinds planted."""
    pages = table(spark, sf, "pages")
    found = ingest.extract_links(pages, keep=("page_id", "url"))
    planted = pages.select("page_id", "url", F.explode(F.array(*[F.lit(x) for x in fx.REFERENCES])).alias("link"))
    return links.resolved_links(found.unionByName(planted))


def q_link_manifest(spark, sf):
    """The files that any page links to, once each, as the fetch plan takes them."""
    pages = table(spark, sf, "pages").select("page_id", "url", F.expr("array('f' || page_id % 9 || '.zip?v=' || page_id % 2, "
                                                                    "'../d/./f' || page_id % 7 || '.zip#x', '/g.txt')").alias("links"))
    return links.link_manifest(links.resolved_links(pages.select("page_id", "url", F.explode("links").alias("link"))))


def q_release_files(spark, sf):
    """All files of the newest month folder of each root."""
    years, months, files = _release_levels(spark, sf)
    return ingest.release_files([years, months], files)


def q_fetch_plan(spark, sf):
    manifest = table(spark, sf, "part").select(F.concat(F.lit("F"), F.col("p_partkey").cast("string"), F.lit(".zip")).alias("name"))
    # files already on disk, one per shipped line: an archive (odd line numbers) or its unpacked folder
    existing = table(spark, sf, "lineitem").select(
        F.concat(F.lit("F"), F.col("l_suppkey").cast("string"),
                 F.when(F.col("l_linenumber") % 2 == 1, F.lit(".zip")).otherwise(F.lit(""))).alias("name"))
    return ingest.fetch_plan(manifest, existing)


def q_expand_archives(spark, sf):
    root = scratch_path(spark, "archives")
    docs = table(spark, sf, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("member"), "text")
    archives.write_archives(docs, root, "member", "text", encoding="UTF-8").write.format("noop").mode("overwrite").save()
    lines = archives.expand_archives(spark, f"{root}/*.zip", encoding="UTF-8")
    return lines.select(F.regexp_extract("member", r"^(\d+)\.txt$", 1).cast("long").alias("doc_id"),
                        "line_number", "line")


def q_split_codebooks(spark, sf):
    long = derive(table(spark, sf, "customer"), fx.long_codebook(fx.SPARK))
    split = ingest.split_codebooks(long, lf.CODEBOOK_FILES["mov"])
    path = scratch_path(spark, "codebooks")
    sinks.write_table(split, path, mode="overwrite", partition_by="codebook")
    return spark.read.parquet(path)


def q_tiered_match(spark, sf):
    return _matched(spark, sf, fx.addresses(fx.SPARK))


def q_tiered_match_fuzzy(spark, sf):
    """Addresses that are not spelled as in the gazetteer, matched by the words they share."""
    return _matched(spark, sf, fx.misspelt_addresses(fx.SPARK), min_score=80)


def _matched(spark, sf, addresses, **options):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    geo = n.join(r, n.n_regionkey == r.r_regionkey)
    addrs = derive(c.join(geo, c.c_nationkey == geo.n_nationkey), addresses)
    supp = s.join(geo, s.s_nationkey == geo.n_nationkey)
    gaz = reduce(DataFrame.unionByName, [derive(supp, pairs) for pairs in fx.gazetteer(fx.SPARK).values()])
    out = matching.tiered_match(addrs, gaz, street="rua", zip_code="cep", district="bairro", city="municipio", state="uf", **options)
    return out.select("c_custkey", "match_tier", "lat", "lng")


def q_incremental_ingest(spark, sf):
    """Raw regime rows land in three drops (a row-hash split: every row lands in exactly one); two
    availableNow runs and an idle third consolidate them, so the output must equal the whole table. The
    second drop's files carry modification times thirty days before the first's, as copied dumps do."""
    root = scratch_path(spark, "incremental")
    raw = raw_regime(spark, sf).withColumn("_drop", F.abs(F.xxhash64("cnpj", "data_inclusao_simples")) % 3)
    cols = [c for c, _ in fx.raw_regime(fx.SPARK)]
    schema = delimited.string_schema(cols)
    target, ckpt = f"{root}/out", f"{root}/checkpoint"
    _write_positional(raw.filter(F.col("_drop") == 0).select(cols), f"{root}/landing/drop0")
    ingest_new_files(spark, f"{root}/landing/*", schema, target, ckpt, transform=cr.consolidate_regime)
    _write_positional(raw.filter(F.col("_drop") == 1).select(cols), f"{root}/landing/drop1")
    set_modified(spark, f"{root}/landing/drop1", int(time.time() * 1000) - 30 * 86_400_000)
    _write_positional(raw.filter(F.col("_drop") == 2).select(cols), f"{root}/landing/drop2")
    ingest_new_files(spark, f"{root}/landing/*", schema, target, ckpt, transform=cr.consolidate_regime)
    ingest_new_files(spark, f"{root}/landing/*", schema, target, ckpt, transform=cr.consolidate_regime)
    return spark.read.parquet(target)


def q_incremental_dedup(spark, sf):
    """Two drops of raw regime rows, the first delivered again under new names: within a later run, and beside the
    second drop. The output must equal the whole table."""
    root = scratch_path(spark, "incremental_dedup")
    cols = [c for c, _ in fx.raw_regime(fx.SPARK)]
    raw = raw_regime(spark, sf).withColumn("_drop", F.abs(F.xxhash64("cnpj", "data_inclusao_simples")) % 2)

    def deliver(drop: int, name: str) -> None:
        rows = raw.filter(F.col("_drop") == drop).select(cols)
        _write_positional(rows.repartition(4, "cnpj"), f"{root}/landing/{name}")

    def run() -> None:
        ingest_new_content(spark, f"{root}/landing/*", delimited.string_schema(cols), f"{root}/out", f"{root}/checkpoint",
                           transform=cr.consolidate_regime)

    deliver(0, "drop0")
    run()
    deliver(1, "drop1")
    deliver(0, "again")
    run()
    deliver(1, "late")
    run()
    return spark.read.parquet(f"{root}/out").drop("batch")


# ---- whole-source runs --------------------------------------------------------------------------------

REGISTER_LOOKUP_SOURCES = {"CNAE": "part", "MUNIC": "nation", "NATJU": "nation", "PAIS": "region",
                           "QUALS": "nation", "MOTI": "customer"}


# Output -> the tables of a run that has it.
REGISTER_RUNS = {"simples": ("simples",), "socios": ("lookups", "socios"), "empresas": ("lookups", "empresas"), "estab": ("lookups", "estab")}


# The register's dumps as files: gzip text (level 5 takes a fifth of the plain text's disk for little time), and as a
# gzip file is read by one task, few rows in each.
DUMP_FILES = {"compression": "gzip", "zlib.compress.level": "FIVE", "max_records_per_file": 200_000}


def _register_dumps(spark, sf, raw_dir: str, tables) -> None:
    """The dumps that these tables of the register are made of, as they land (Latin-1, ';', compressed).

    What a dump's joins shuffled is deleted once it is written; the one that shuffles most comes first, beside no other."""
    dumps = {"estab": ("K3241.K03200Y0.D40113.ESTABELE", partial(raw_establishments, bounded=True)), "simples": ("K3241.K03200Y0.D40113.SIMPLES.CSV.D40113", raw_regime),
             "socios": ("K3241.K03200Y0.D40113.SOCIOCSV", raw_partners), "empresas": ("K3241.K03200Y0.D40113.EMPRECSV", raw_companies)}
    with shuffles_deleted(spark):
        for key, (name, raw) in dumps.items():
            if key in tables:
                _write_positional(raw(spark, sf), f"{raw_dir}/{name}", **DUMP_FILES)
        if "lookups" in tables:
            for file_id, src in REGISTER_LOOKUP_SOURCES.items():
                _write_positional(raw_lookup(spark, sf, src, cr.LOOKUP_IDS[file_id]), f"{raw_dir}/F.K03200$Z.D40113.{file_id}CSV", **DUMP_FILES)


def _register_run(spark, sf, output: str) -> DataFrame:
    """One output of a run of the company register: the dumps it needs are written, staged and
    consolidated in dependency order by the runner, and the named output is read back."""
    from .runner import run_company_register

    root, tables = scratch_path(spark, "register_run"), REGISTER_RUNS.get(output, ("lookups",))
    _register_dumps(spark, sf, f"{root}/data/raw/cnpj", tables)
    written = run_company_register(spark, f"{root}/data/raw/cnpj", f"{root}/data/trusted/cnpj", tables=tables, mode="overwrite", staged=True,
                                   with_full_id=True)
    return spark.read.parquet(written[f"df_{output}"])


def q_register_run(spark, sf):
    """The establishments output of the register run."""
    return _register_run(spark, sf, "estab")


def q_register_publish(spark, sf):
    """Two whole runs of the register published one after the other, the second cut short by a dump that is
    not there: what readers see is the first, all ten tables of it, as rows (table, key, content). A run's dumps
    are deleted when the run has ended."""
    from .runner import publish_company_register, read_published

    root = scratch_path(spark, "register_publish")
    _register_dumps(spark, sf, f"{root}/raw", ("lookups", *REGISTER_RUNS))
    publish_company_register(spark, f"{root}/raw", f"{root}/out", with_full_id=True, compression="zstd")
    delete_path(spark, f"{root}/raw")
    _register_dumps(spark, sf, f"{root}/later", ("lookups", "simples"))
    try:
        publish_company_register(spark, f"{root}/later", f"{root}/out", with_full_id=True, compression="zstd")
    except Exception:  # noqa: BLE001 - the expected missing dump
        pass
    else:
        raise AssertionError("a run without its dumps was published")
    delete_path(spark, f"{root}/later")
    names = ["simples", "socios", "empresas", "estab", *cr.LOOKUP_IDS.values()]
    parts = []
    for name in names:
        df = read_published(spark, f"{root}/out", f"df_{name}")
        texts = [F.col(c).cast("string") for c in df.columns if c != "capital_social"]
        parts.append(df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *texts).alias("content")))
    return reduce(DataFrame.unionByName, parts)


def _labour_run(spark, sf, level: str) -> DataFrame:
    """A labour level as it lands: a headered UTF-8 dump plus one comma CSV codebook per code,
    consolidated by the runner; the level's output is returned."""
    raw, codes = {"mov": (raw_movements, fx.MOV_CODES), "estab": (raw_estab_flows, fx.ESTAB_FLOW_CODES)}[level]
    root = scratch_path(spark, "labour_run")
    level_dir = f"{root}/data/raw/caged/{level}"
    _write_positional(raw(spark, sf), f"{level_dir}/CAGED202401.txt", encoding="UTF-8", header=True)
    for name, (source, _) in codes.items():
        book = derive(table(spark, sf, fx.codebook_table(source)), fx.codebook_rows(name, source))
        _write_positional(book, f"{level_dir}/aux_tables/{name}.csv", encoding="UTF-8", header=True, sep=",")
    from .runner import run_labour_flows

    paths = run_labour_flows(spark, f"{root}/data/raw/caged", f"{root}/data/trusted/caged", levels=(level,),
                             mode="overwrite", strict_codebooks=True)
    return spark.read.parquet(paths[lf.OUTPUT_NAMES[level]])


def q_labour_run(spark, sf):
    return _labour_run(spark, sf, "mov")


def q_labour_run_estab(spark, sf):
    return _labour_run(spark, sf, "estab")


QUERIES: dict[str, Query] = {
    name.removeprefix("q_"): fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
QUERIES |= {
    f"register_run_{name}": (lambda spark, sf, output=name: _register_run(spark, sf, output))
    for name in (*cr.LOOKUP_IDS.values(), "simples", "socios", "empresas")
}
