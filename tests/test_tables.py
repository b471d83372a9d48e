"""End to end on hand-made raw dumps: company register (Latin-1, positional) and labour flows (headered)."""

import datetime as dt
import os

import pytest

from cadastro.plans import company_register as cr
from cadastro.plans import labour_flows as lf
from cadastro.plans.runner import run_company_register, run_labour_flows


def put(path, lines, encoding):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(("\n".join(lines) + "\n").encode(encoding))


def q(*fields):
    return ";".join(f'"{f}"' for f in fields)


@pytest.fixture()
def company_raw(tmp_dir):
    raw = f"{tmp_dir}/data/raw/cnpj"
    lat = "latin-1"
    put(f"{raw}/F.K03200$Z.D1.PAISCSV", [q("10", "BRASIL"), q("105", "ALEMANHA")], lat)
    put(f"{raw}/F.K03200$Z.D1.QUALSCSV", [q("49", "SÓCIO-ADMINISTRADOR"), q("5", "ADMINISTRADOR")], lat)
    put(f"{raw}/F.K03200$Z.D1.NATJUCSV", [q("2062", "SOCIEDADE EMPRESÁRIA LIMITADA")], lat)
    put(f"{raw}/F.K03200$Z.D1.MUNICCSV", [q("7107", "SÃO PAULO"), q("6001", "RIO DE JANEIRO")], lat)
    put(f"{raw}/F.K03200$Z.D1.CNAECSV", [q("4711302", "COMÉRCIO VAREJISTA")], lat)
    put(f"{raw}/F.K03200$Z.D1.MOTICSV", [q("0", "SEM MOTIVO")], lat)
    put(f"{raw}/K3241.K03200Y0.D1.SIMPLES.CSV.D1", [q("123", "S", "20210228", "00000000", "N", "", "20210230")], lat)
    put(f"{raw}/K3241.K03200Y0.D1.SOCIOCSV", [
        q("123", "2", "JOÃO DA SILVA", "***123456**", "49", "20200115", "105", "", "", "5", "4"),
        q("456", "1", "EMPRESA X", "", "99", "0", "", "", "", "", ""),
    ], lat)
    put(f"{raw}/K3241.K03200Y0.D1.EMPRECSV", [q("123", "ACME LTDA", "2062", "49", "1234567,89", "2", "")], lat)
    estab = ["123", "0001", "55", "1", "LOJA SÃO JOSÉ", "2", "20050101", "0", "", "", "20050101", "4711302",
             "4712100,4713002", "RUA", "DAS FLORES", "S/N", "", "CENTRO", "01001000", "sp ", "7107", "11", "5555",
             "", "", "", "", " A'B.COM ", "", ""]
    unknown = list(estab)
    unknown[0], unknown[20] = "999", "9999"
    put(f"{raw}/K3241.K03200Y0.D1.ESTABELE", [q(*estab), q(*unknown)], lat)
    return raw


def test_company_register_end_to_end(spark, tmp_dir, company_raw):
    out = f"{tmp_dir}/data/trusted/cnpj"
    paths = run_company_register(spark, company_raw, out, mode="overwrite", staged=True, with_full_id=True)
    assert set(paths) == {"df_cnae", "df_mun", "df_natju", "df_pais", "df_qual_socio", "df_motivo",
                          "df_simples", "df_socios", "df_empresas", "df_estab"}
    read = lambda n: spark.read.parquet(paths[n])

    assert [tuple(r) for r in read("df_mun").orderBy("cod_mun").collect()] == [(6001, "Rio De Janeiro"),
                                                                                (7107, "Sao Paulo")]
    simples = read("df_simples").collect()[0]
    assert (simples.cnpj, simples.data_inclusao_simples, simples.data_exclusao_simples, simples.data_inclusao_mei,
            simples.data_exclusao_mei) == ("00000123", dt.date(2021, 2, 28), None, None, None)

    socios = {r.cnpj_empresa: r for r in read("df_socios").collect()}
    assert read("df_socios").columns == list(cr.SOCIOS_OUTPUT)
    s = socios["00000123"]
    assert (s.nome_socio, s.id_socio, s.faixa_etaria, s.nome_qual_socio, s.data_entrada_sociedade, s.nome_pais,
            s.num_rep_legal, s.nome_qual_socio_rep_legal) == (
        "Joao Da Silva", "PF", "31 a 40 anos",
        "Socio-administrador", dt.date(2020, 1, 15), "Alemanha", None, "Administrador")
    s = socios["00000456"]
    assert (s.id_socio, s.faixa_etaria, s.cod_qual_socio, s.nome_qual_socio, s.cod_pais) == ("PJ", None, 99, None, None)

    emp = read("df_empresas").collect()[0]
    assert read("df_empresas").columns == list(cr.EMPRESAS_OUTPUT)
    assert (emp.cnpj, emp.razao_social, emp.capital_social, emp.porte, emp.nome_porte, emp.nome_natju,
            emp.nome_qual_socio) == ("00000123", "Acme Ltda", 1234567.875, 2, "Micro Empresa",
                                     "Sociedade Empresaria Limitada", "Socio-administrador")

    est = read("df_estab").collect()
    assert len(est) == 1  # unknown municipality dropped by the inner join
    e = est[0]
    assert read("df_estab").columns == list(cr.ESTAB_OUTPUT) + ["cnpj_completo"]
    assert (e.cnpj, e.id_matriz, e.nome_fantasia, e.situacao_cadastral, e.data_situacao_cadastral, e.cod_pais,
            e.nome_pais, e.cnae_primario, e.numero, e.uf, e.nome_mun, e.correio_eletronico, e.cnpj_completo,
            e.cnae_secundario) == ("00000123", "Matriz", "Loja Sao Jose", 2, dt.date(2005, 1, 1), None, None,
                                   "4711302", "", "SP", "Sao Paulo", "a@b.com", "00000123000155", "4712100,4713002")


def test_keep_unknown_municipality(spark, tmp_dir, company_raw):
    out = f"{tmp_dir}/t2"
    paths = run_company_register(spark, company_raw, out, mode="overwrite", keep_unknown_municipality=True)
    assert spark.read.parquet(paths["df_estab"]).count() == 2


def test_labour_flows_end_to_end(spark, tmp_dir):
    raw = f"{tmp_dir}/data/raw/caged"
    mov_header = list(lf.RENAMES["mov"]) + ["competênciadec"]
    values = {"competência": "202103", "região": "3", "uf": "35", "município": "355030", "saldomovimentação": "1",
              "idade": "33", "horascontratuais": "44.00", "salário": "1500.5", "competênciadec": "202104"}
    row2 = dict(values, **{"município": "330490", "salário": "1500,00", "idade": "x"})
    row3 = dict(values, **{"município": "999"})
    lines = [";".join(mov_header)] + [";".join(r.get(h, "1") for h in mov_header) for r in (values, row2, row3)]
    put(f"{raw}/mov/CAGEDMOV202103.txt", lines, "utf-8")
    put(f"{raw}/mov/aux_tables/regiao.csv", ["cod_regiao,regiao", "3,SUDESTE"], "utf-8")
    put(f"{raw}/mov/aux_tables/municipio.csv", ["cod_municipio,municipio", "355030,Sp-São Paulo",
                                                 "330490,Rj-Varre-Sai"], "utf-8")
    est_header = list(lf.RENAMES["estab"])
    put(f"{raw}/estab/CAGEDESTAB202103.txt",
        [";".join(est_header), ";".join({"competência": "202103", "admitidos": "5", "desligados": "2",
                                          "saldomovimentação": "3"}.get(h, "3") for h in est_header)], "utf-8")
    put(f"{raw}/estab/aux_tables/regiao.csv", ["cod_regiao,regiao", "3,SUDESTE"], "utf-8")

    with pytest.warns(UserWarning):
        paths = run_labour_flows(spark, raw, f"{tmp_dir}/out", mode="overwrite")
    mov = spark.read.parquet(paths["movimentacoes"])
    assert mov.columns == lf.output_columns("mov")
    got = {r.municipio: r for r in mov.collect()}
    assert set(got) == {"Sao Paulo", "Varre", "Nao Identificado"}
    a = got["Sao Paulo"]
    assert (a.data, a.regiao, a.salario, a.idade, a.horas_contrato, a.sexo) == (
        dt.date(2021, 3, 1), "Sudeste", 1500.5, 33, 44, None)
    assert (got["Varre"].salario, got["Varre"].idade) == (None, None)  # decimal comma -> null by default
    est = spark.read.parquet(paths["estabelecimentos"]).collect()[0]
    assert (est.admitidos, est.desligados, est.saldo_movimentacao, est.regiao, est.municipio) == (
        5, 2, 3, "Sudeste", "Nao Identificado")

    with pytest.warns(UserWarning):
        opts = run_labour_flows(spark, raw, f"{tmp_dir}/out2", mode="overwrite", levels=("mov",),
                                salary_decimal_comma=True, keep_rest=True)
    got = {r.municipio: r for r in spark.read.parquet(opts["movimentacoes"]).collect()}
    assert got["Varre-sai"].salario == 1500.0
    with pytest.raises(FileNotFoundError):
        run_labour_flows(spark, raw, f"{tmp_dir}/out3", levels=("mov",), strict_codebooks=True)


def test_runner_with_a_text_output_format(spark, tmp_dir, company_raw):
    paths = run_company_register(spark, company_raw, f"{tmp_dir}/csv", mode="overwrite", fmt="csv",
                                 tables=("lookups", "estab"), header="true")
    back = spark.read.option("header", "true").csv(paths["df_estab"])
    assert back.count() == 1 and back.first().nome_mun == "Sao Paulo"


def test_dropped_establishments_report(spark, company_raw):
    from cadastro.sources import read_lookup_set, read_positional

    raw = read_positional(spark, f"{company_raw}/{cr.GLOBS['estab']}", cr.ESTAB_COLUMNS)
    mun = cr.consolidate_lookup(read_lookup_set(spark, company_raw, {"MUNIC": "mun"})["mun"], "mun")
    dropped = cr.dropped_establishments(raw, mun)
    assert [r.cnpj for r in dropped.collect()] == ["999"]  # the row with the unknown municipality 9999



def test_exact_capital_and_integer_codebook_keys(spark, company_raw, tmp_dir):
    from cadastro.sources import read_positional

    raw = read_positional(spark, f"{company_raw}/{cr.GLOBS['empresas']}", cr.EMPRESAS_COLUMNS)
    natju = spark.createDataFrame([(2062, "Ltda")], "cod_natju int, nome_natju string")
    quals = spark.createDataFrame([(49, "Socio")], "cod_qual_socio int, nome_qual_socio string")
    exact = cr.consolidate_companies(raw, natju, quals, kind_overrides={"capital_social": "decimal_comma"})
    assert str(exact.first().capital_social) == "1234567.89"  # B11: no float rounding

    header = list(lf.RENAMES["estab"])
    put(f"{tmp_dir}/k/estab/a.txt", [";".join(header), ";".join("01" if h == "região" else "3" for h in header)], "utf-8")
    put(f"{tmp_dir}/k/estab/aux_tables/regiao.csv", ["cod_regiao,regiao", "1,NORTE"], "utf-8")
    with pytest.warns(UserWarning):
        text_keys = run_labour_flows(spark, f"{tmp_dir}/k", f"{tmp_dir}/k_out1", levels=("estab",))
    with pytest.warns(UserWarning):
        int_keys = run_labour_flows(spark, f"{tmp_dir}/k", f"{tmp_dir}/k_out2", levels=("estab",), key_as_int=True)
    assert spark.read.parquet(text_keys["estabelecimentos"]).first().regiao is None  # '01' != '1' as text
    assert spark.read.parquet(int_keys["estabelecimentos"]).first().regiao == "Norte"  # B7: compared as ints


def test_a_second_append_run_uses_its_own_lookups(spark, company_raw, tmp_dir):
    from cadastro.plans.runner import run_company_register

    out = f"{tmp_dir}/appended"
    for n in (1, 2):
        paths = run_company_register(spark, company_raw, out, mode="append", staged=True, kind_overrides={"capital_social": "decimal_comma"})
        companies = spark.read.parquet(paths["df_empresas"])
        assert companies.count() % n == 0 and dict(companies.dtypes)["capital_social"].startswith("decimal")
        counts = {t: spark.read.parquet(p).count() for t, p in paths.items()}
        first = counts if n == 1 else first  # noqa: F821
    assert counts == {t: 2 * c for t, c in first.items()}


def test_labour_run_passes_writer_options(spark, tmp_dir):
    header = list(lf.RENAMES["estab"])
    put(f"{tmp_dir}/w/estab/a.txt", [";".join(header)] + [";".join("3" for _ in header)] * 10, "utf-8")
    with pytest.warns(UserWarning):
        paths = run_labour_flows(spark, f"{tmp_dir}/w", f"{tmp_dir}/w_out", levels=("estab",), max_records_per_file=3)
    parts = [f for f in os.listdir(paths["estabelecimentos"]) if f.endswith(".parquet")]
    assert len(parts) >= 4


def test_a_run_is_published_whole_or_not_at_all(spark, tmp_dir):
    """A run that fails midway leaves the old tables visible, all of them, and nothing of its own."""
    import os

    from cadastro.plans import catalog
    from cadastro.plans.runner import publish_company_register, read_published
    from tests.conftest import SF001

    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/out"
    catalog._register_dumps(spark, SF001, raw, ("lookups", "simples", "socios"))
    tables = ("lookups", "simples", "socios")
    first = publish_company_register(spark, raw, out, tables=tables, staged=True)
    pais, socios = (read_published(spark, out, f"df_{t}").count() for t in ("pais", "socios"))
    assert pais and socios
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        publish_company_register(spark, raw, out, tables=(*tables, "estab"), staged=True)
    assert [f for f in os.listdir(out) if f.startswith("version=")] == [f"version={first}"]
    assert read_published(spark, out, "df_pais").count() == pais
    second = publish_company_register(spark, raw, out, tables=("lookups",))
    with pytest.raises(KeyError):
        read_published(spark, out, "df_socios")
    third = publish_company_register(spark, raw, out, tables=tables)
    assert read_published(spark, out, "df_socios").count() == socios
    assert sorted(f for f in os.listdir(out) if f.startswith("version=")) == [f"version={second}", f"version={third}"]
