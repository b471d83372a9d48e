"""Type cleaning by column kind: one ``withColumns`` projection for any number of columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame

from ..functions import clean_text, decimal_comma, lenient_date, lenient_double, lenient_int, year_month

# kind -> Column builder. 'str' is kept as an alias of 'text' for the reference's spelling.
KINDS: dict[str, Callable[[Column], Column]] = {
    "int": lenient_int,
    "text": clean_text,
    "str": clean_text,
    "date": lenient_date,
    "month": year_month,
    "double": lenient_double,
    "double_comma": lambda c: lenient_double(c, decimal_comma=True),
    "float_comma": lambda c: decimal_comma(c, "float"),
    "decimal_comma": lambda c: decimal_comma(c, "decimal(18,2)"),
}


def clean_types(kinds: Mapping[str, str] | str, cols: str | Iterable[str] | None = None):
    """Return a ``DataFrame -> DataFrame`` that casts columns leniently by kind.

    ``clean_types({"cod_x": "int", "nome_x": "text"})`` or the reference-style
    ``clean_types("int", ["a", "b"])``. Unknown kinds raise ``ValueError`` at call time.
    """
    if isinstance(kinds, str):
        cols = [cols] if isinstance(cols, str) else list(cols or [])
        kinds = {c: kinds for c in cols}
    for kind in kinds.values():
        if kind not in KINDS:
            raise ValueError(f"unsupported kind {kind!r}; expected one of {sorted(KINDS)}")

    def _apply(df: DataFrame) -> DataFrame:
        if not kinds:
            return df
        return df.withColumns({c: KINDS[k](c) for c, k in kinds.items()})

    return _apply


def columns_by_rule(columns: Iterable[str], prefix: str | None = None, contains: str | None = None) -> list[str]:
    """Column-group selection by name rule (prefix ``cod``/``nome``, substring ``data``)."""
    out = []
    for c in columns:
        if prefix is not None and c.startswith(prefix):
            out.append(c)
        elif contains is not None and contains in c:
            out.append(c)
    return out


def kinds_by_rule(columns: Iterable[str], rules: Mapping[str, Mapping[str, str]], extra: Mapping[str, str] | None = None):
    """Build a ``{col: kind}`` map from name rules, e.g. ``{"int": {"prefix": "cod"}, "date": {"contains": "data"}}``.

    Later rules win; ``extra`` entries win over all rules.
    """
    columns = list(columns)
    kinds: dict[str, str] = {}
    for kind, rule in rules.items():
        for c in columns_by_rule(columns, **rule):
            kinds[c] = kind
    kinds.update(extra or {})
    return kinds
