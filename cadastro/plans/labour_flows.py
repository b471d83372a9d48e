"""Labour-flow tables: individual movements ('mov') and per-establishment flows ('estab').

Both are headered ';' files whose accented headers are renamed, typed, and whose coded columns are
replaced by labels from one codebook each (a star of broadcast left joins).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean_text, initcap_or, lenient_double, lenient_int, split_take, year_month
from ..operators.lookups import star_lookup
from ..operators.rename import rename_map

# Header -> column name, per level, in output order.
RENAMES = {
    "mov": {
        "competência": "data",
        "região": "cod_regiao",
        "uf": "cod_uf",
        "município": "cod_municipio",
        "seção": "cod_secao",
        "subclasse": "cod_subclasse",
        "saldomovimentação": "saldo_movimentacao",
        "cbo2002ocupação": "cod_cbo_ocupacao",
        "categoria": "cod_categoria",
        "graudeinstrução": "cod_grau_instrucao",
        "idade": "idade",
        "horascontratuais": "horas_contrato",
        "raçacor": "cod_raca",
        "sexo": "cod_sexo",
        "tipoempregador": "cod_tipo_empregador",
        "tipoestabelecimento": "cod_tipo_estab",
        "tipomovimentação": "cod_tipo_mov",
        "tipodedeficiência": "cod_tipo_deficiencia",
        "indtrabintermitente": "cod_ind_trab_intermitente",
        "indtrabparcial": "cod_ind_trab_parcial",
        "salário": "salario",
        "tamestabjan": "cod_tamanho_estab",
        "indicadoraprendiz": "cod_ind_aprendiz",
        "fonte": "cod_fonte",
    },
    "estab": {
        "competência": "data",
        "região": "cod_regiao",
        "uf": "cod_uf",
        "município": "cod_municipio",
        "seção": "cod_secao",
        "subclasse": "cod_subclasse",
        "admitidos": "admitidos",
        "desligados": "desligados",
        "saldomovimentação": "saldo_movimentacao",
        "tipoempregador": "cod_tipo_empregador",
        "tipoestabelecimento": "cod_tipo_estab",
        "tamestabjan": "cod_tamanho_estab",
        "fonte_desl": "cod_fonte",
    },
}

# Layout-workbook sheet -> codebook file, per level.
CODEBOOK_FILES = {
    "mov": {
        "região": "regiao.csv",
        "uf": "uf.csv",
        "município": "municipio.csv",
        "seção": "secao.csv",
        "subclasse": "subclasse.csv",
        "fonte_desl": "fonte.csv",
        "categoria": "categoria.csv",
        "cbo2002ocupação": "cbo_ocupacao.csv",
        "graudeinstrução": "grau_instrucao.csv",
        "sexo": "sexo.csv",
        "tipoempregador": "tipo_empregador.csv",
        "tipoestabelecimento": "tipo_estab.csv",
        "tipomovimentação": "tipo_mov.csv",
        "indtrabparcial": "ind_trab_parcial.csv",
        "indtrabintermitente": "ind_trab_intermitente.csv",
        "tipodedeficiência": "tipo_deficiencia.csv",
        "raçacor": "raca.csv",
        "indicadoraprendiz": "ind_aprendiz.csv",
        "tamestabjan": "tamanho_estab.csv",
    },
    "estab": {
        "região": "regiao.csv",
        "uf": "uf.csv",
        "município": "municipio.csv",
        "seção": "secao.csv",
        "subclasse": "subclasse.csv",
        "tipoempregador": "tipo_empregador.csv",
        "tipoestabelecimento": "tipo_estab.csv",
        "tamestabjan": "tamanho_estab.csv",
        "fonte_desl": "fonte.csv",
    },
}

# Integer columns and output table of each level.
INT_COLUMNS = {"mov": ("horas_contrato", "idade", "saldo_movimentacao"),
               "estab": ("admitidos", "desligados", "saldo_movimentacao")}
OUTPUT_NAMES = {"mov": "movimentacoes", "estab": "estabelecimentos"}
# Fixed value: label for a municipality without one.
UNKNOWN_MUNICIPALITY = "Nao Identificado"


def codebook_names(level: str) -> list[str]:
    """Codebook (label) names of a level, e.g. ``['regiao', 'uf', ...]``."""
    return [f.removesuffix(".csv") for f in CODEBOOK_FILES[level].values()]


def output_columns(level: str) -> list[str]:
    return [c.removeprefix("cod_") for c in RENAMES[level].values()]


def prepare_codebook(raw: DataFrame, name: str) -> DataFrame:
    """Codebook CSV frame -> ``(cod_<name>, <name>)`` with the label as clean text (codes stay text)."""
    code, label = f"cod_{name}", name
    if code not in raw.columns or label not in raw.columns:
        c0, c1 = raw.columns[:2]
        raw = raw.withColumnsRenamed({c0: code, c1: label})
    return raw.select(F.col(code), clean_text(label).alias(label))


def consolidate_flows(
    raw: DataFrame,
    level: str,
    codebooks: Mapping[str, DataFrame | None],
    *,
    salary_decimal_comma: bool = False,
    keep_rest: bool = False,
    key_as_int: bool = False,
    missing: str = "null",
    check_unique: bool = True,
    strategy: str = "auto",
) -> DataFrame:
    """Raw headered frame of one level -> consolidated table.

    ``codebooks`` maps label names (``codebook_names(level)``) to prepared codebooks
    (:func:`prepare_codebook`). Options beyond the published behaviour: ``salary_decimal_comma`` reads
    '1500,00'; ``keep_rest`` keeps hyphens inside a municipality name; ``key_as_int`` compares codes as
    integers ('01' = '1') instead of raw text.
    """
    if level not in RENAMES:
        raise ValueError("level must be 'mov' or 'estab'")
    df = raw.transform(rename_map(RENAMES[level]))
    typed = {"data": year_month(F.col("data"))}
    typed.update({c: lenient_int(F.col(c)) for c in INT_COLUMNS[level]})
    if level == "mov":
        typed["salario"] = lenient_double(F.col("salario"), decimal_comma=salary_decimal_comma)
    df = df.withColumns(typed)
    names = output_columns(level)
    books = dict(codebooks)
    if key_as_int:
        df = df.withColumns({f"cod_{n}": lenient_int(F.col(f"cod_{n}")) for n in codebook_names(level)
                             if f"cod_{n}" in df.columns})
        books = {n: (b.withColumn(f"cod_{n}", lenient_int(F.col(f"cod_{n}"))) if b is not None else None)
                 for n, b in books.items()}
    wanted = [n for n in codebook_names(level) if n in names]
    df = star_lookup(df, {n: books.get(n) for n in wanted}, keep=wanted, missing=missing,
                     check_unique=check_unique, strategy=strategy)
    df = df.withColumn("municipio", initcap_or(split_take(F.col("municipio"), "-", 1, keep_rest=keep_rest),
                                                UNKNOWN_MUNICIPALITY))
    return df.select(*names)
