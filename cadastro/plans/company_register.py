"""Company-register tables: six lookups, regime options, partners, companies, establishments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    AGE_BANDS,
    COMPANY_SIZES,
    HEAD_OFFICE,
    PARTNER_KINDS,
    blank_sentinels,
    code_label,
    compose_id,
    fix_email,
    lenient_int,
    upper_trim,
    zero_pad,
)
from ..operators.cleaning import clean_types, kinds_by_rule
from .spec import Lookup, TableSpec, consolidate

# Lookup file ids (file names end in '<ID>CSV') and the table name each one feeds.
LOOKUP_IDS = {
    "CNAE": "cnae",
    "MUNIC": "mun",
    "NATJU": "natju",
    "PAIS": "pais",
    "QUALS": "qual_socio",
    "MOTI": "motivo",
}

# Raw column layouts (headerless files, by position) and their file-name globs.
SIMPLES_COLUMNS = (
    "cnpj", "opcao_simples", "data_inclusao_simples", "data_exclusao_simples",
    "opcao_mei", "data_inclusao_mei", "data_exclusao_mei",
)
SOCIOS_COLUMNS = (
    "cnpj_empresa", "id_socio", "nome_socio", "cpf_cnpj_socio", "cod_qual_socio", "data_entrada_sociedade",
    "cod_pais", "num_rep_legal", "nome_rep_legal", "cod_qual_socio_rep_legal", "faixa_etaria",
)
EMPRESAS_COLUMNS = (
    "cnpj", "razao_social", "cod_natju", "cod_qual_socio", "capital_social", "porte", "ente_fed_resp",
)
ESTAB_COLUMNS = (
    "cnpj", "cnpj_ordem", "cnpj_dv", "id_matriz", "nome_fantasia", "situacao_cadastral",
    "data_situacao_cadastral", "motivo_situacao_cadastral", "nome_cidade_ext", "cod_pais",
    "data_inicio_atividades", "cnae_primario", "cnae_secundario", "tipo_logradouro", "logradouro",
    "numero", "complemento", "bairro", "cep", "uf", "cod_mun", "ddd_1", "telefone_1", "ddd_2",
    "telefone_2", "ddd_fax", "fax", "correio_eletronico", "situacao_especial", "data_situacao_especial",
)
GLOBS = {"simples": "*SIMPLES*", "socios": "*SOCIOCSV", "empresas": "*EMPRECSV", "estab": "*ESTABELE"}

# Output column order of the consolidated tables.
SOCIOS_OUTPUT = (
    "cnpj_empresa", "nome_socio", "cpf_cnpj_socio", "id_socio", "faixa_etaria", "cod_qual_socio",
    "nome_qual_socio", "data_entrada_sociedade", "cod_pais", "nome_pais", "num_rep_legal", "nome_rep_legal",
    "cod_qual_socio_rep_legal", "nome_qual_socio_rep_legal",
)
EMPRESAS_OUTPUT = (
    "cnpj", "razao_social", "capital_social", "porte", "nome_porte", "ente_fed_resp", "cod_natju",
    "nome_natju", "cod_qual_socio", "nome_qual_socio",
)
ESTAB_OUTPUT = ESTAB_COLUMNS + ("nome_mun", "nome_pais")


# The register's naming rules (prefix "cod" int, prefix "nome" text, "data" in the name date).
COD, NOME, DATA = {"int": {"prefix": "cod"}}, {"text": {"prefix": "nome"}}, {"date": {"contains": "data"}}

SIMPLES = TableSpec(
    name="df_simples",
    raw_columns=SIMPLES_COLUMNS,
    kinds=kinds_by_rule(SIMPLES_COLUMNS, DATA),
    rules=({"cnpj": lambda: zero_pad("cnpj", 8)},),
    source_glob=GLOBS["simples"],
)

SOCIOS = TableSpec(
    name="df_socios",
    raw_columns=SOCIOS_COLUMNS,
    kinds=kinds_by_rule(SOCIOS_COLUMNS, COD | NOME | DATA, {"id_socio": "int", "faixa_etaria": "int"}),
    rules=({
        "cnpj_empresa": lambda: zero_pad("cnpj_empresa", 8),
        "id_socio": lambda: code_label("id_socio", PARTNER_KINDS),
        "faixa_etaria": lambda: code_label("faixa_etaria", AGE_BANDS),
    },),
    lookups=(
        Lookup("qual_socio", "cod_qual_socio_rep_legal", "left", suffix="_rep_legal"),
        Lookup("qual_socio", "cod_qual_socio", "left"),
        Lookup("pais", "cod_pais", "left"),
    ),
    output=SOCIOS_OUTPUT,
    source_glob=GLOBS["socios"],
)

EMPRESAS = TableSpec(
    name="df_empresas",
    raw_columns=EMPRESAS_COLUMNS,
    kinds=kinds_by_rule(EMPRESAS_COLUMNS, COD,
                        {"porte": "int", "razao_social": "text", "ente_fed_resp": "text",
                         "capital_social": "float_comma"}),
    rules=({
        "cnpj": lambda: zero_pad("cnpj", 8),
        "nome_porte": lambda: code_label("porte", COMPANY_SIZES),
    },),
    lookups=(Lookup("natju", "cod_natju", "left"), Lookup("qual_socio", "cod_qual_socio", "left")),
    output=EMPRESAS_OUTPUT,
    source_glob=GLOBS["empresas"],
)

ESTAB = TableSpec(
    name="df_estab",
    raw_columns=ESTAB_COLUMNS,
    kinds=kinds_by_rule(
        ESTAB_COLUMNS, COD | NOME | DATA,
        {"situacao_cadastral": "int", "motivo_situacao_cadastral": "int", "tipo_logradouro": "text",
         "logradouro": "text", "complemento": "text", "bairro": "text"},
    ),
    rules=(
        {
            "cnpj": lambda: zero_pad("cnpj", 8),
            "cnae_primario": lambda: zero_pad("cnae_primario", 7),
            "id_matriz": lambda: code_label(lenient_int("id_matriz"), HEAD_OFFICE),
            "uf": lambda: upper_trim("uf"),
            "correio_eletronico": lambda: fix_email("correio_eletronico"),
            "numero": lambda: blank_sentinels("numero"),
        },
        # second stage: sees the padded company root
        {"cnpj_completo": lambda: compose_id("cnpj", "cnpj_ordem", "cnpj_dv")},
    ),
    lookups=(Lookup("mun", "cod_mun", "inner"), Lookup("pais", "cod_pais", "left")),
    output=ESTAB_OUTPUT,
    source_glob=GLOBS["estab"],
    optional_output={"full_id": ("cnpj_completo",)},
)

TABLES = {"simples": SIMPLES, "socios": SOCIOS, "empresas": EMPRESAS, "estab": ESTAB}


def consolidate_lookup(raw: DataFrame, name: str | None = None) -> DataFrame:
    """A raw 2-column lookup (code, name) -> (``cod_<name>`` int, ``nome_<name>`` clean text)."""
    code, label = raw.columns[:2]
    out = raw.transform(clean_types({code: "int", label: "text"}))
    if name:
        out = out.withColumnsRenamed({code: f"cod_{name}", label: f"nome_{name}"})
    return out.select(out.columns[:2])


def consolidate_regime(raw: DataFrame) -> DataFrame:
    return consolidate(raw, SIMPLES)


def consolidate_partners(raw: DataFrame, qual_socio: DataFrame, pais: DataFrame, **kw) -> DataFrame:
    return consolidate(raw, SOCIOS, {"qual_socio": qual_socio, "pais": pais}, **kw)


def consolidate_companies(raw: DataFrame, natju: DataFrame, qual_socio: DataFrame, **kw) -> DataFrame:
    return consolidate(raw, EMPRESAS, {"natju": natju, "qual_socio": qual_socio}, **kw)


def consolidate_establishments(raw: DataFrame, mun: DataFrame, pais: DataFrame, *, with_full_id: bool = False,
                               **kw) -> DataFrame:
    """Establishments: inner join on municipality (rows with an unknown one are dropped, as the register's
    published tables do; pass ``how_overrides={'mun': 'left'}`` to keep them), left join on country."""
    return consolidate(raw, ESTAB, {"mun": mun, "pais": pais}, options=("full_id",) if with_full_id else (), **kw)


def dropped_establishments(typed_raw: DataFrame, mun: DataFrame) -> DataFrame:
    """The establishments the inner municipality join drops (lazy ``left_anti``); count it to report."""
    from ..operators.lookups import unmatched

    keyed = typed_raw.withColumn("cod_mun", lenient_int(F.col("cod_mun")))
    return unmatched(keyed, mun, "cod_mun")
