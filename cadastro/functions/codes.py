"""Code lists: small, fixed code -> label tables applied as a CASE expression (constant-folded by Catalyst)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._cols import as_col

# Code lists of the company register, as published with the data.
AGE_BANDS = {
    0: "Nao se aplica",
    1: "0 a 12 anos",
    2: "13 a 20 anos",
    3: "21 a 30 anos",
    4: "31 a 40 anos",
    5: "41 a 50 anos",
    6: "51 a 60 anos",
    7: "61 a 70 anos",
    8: "71 a 80 anos",
    9: "Mais de 80 anos",
}
COMPANY_SIZES = {1: "Nao Informado", 2: "Micro Empresa", 3: "Empresa de Pequeno Porte", 5: "Demais"}
PARTNER_KINDS = {1: "PJ", 2: "PF", 3: "Estrangeiro"}
HEAD_OFFICE = {1: "Matriz", 2: "Filial"}


def code_label(c, mapping: Mapping, otherwise=None) -> Column:
    """``CASE c WHEN k1 THEN v1 ... ELSE otherwise END``; an unlisted or null code gives ``otherwise``.

    Compare like with like: apply :func:`cadastro.functions.lenient_int` first to a text column holding
    integer codes (a bare string-to-int comparison raises under ANSI mode).
    """
    c = as_col(c)
    expr = None
    for code, label in mapping.items():
        expr = F.when(c == F.lit(code), F.lit(label)) if expr is None else expr.when(c == F.lit(code), F.lit(label))
    if expr is None:
        return F.lit(otherwise).cast("string")
    return expr.otherwise(F.lit(otherwise).cast("string"))
