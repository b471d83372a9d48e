"""Text normalisation as native column expressions (no Python UDF in the hot path).

``ascii_fold`` replaces a row-at-a-time transliteration UDF: one ``translate`` for every one-to-one
letter mapping (and the deletion of combining marks, so decomposed text folds too) plus a short chain
of ``replace`` calls for the one-to-many ones. The letter table is generated from a rule (Unicode
compatibility decomposition with the combining marks removed) over the Latin blocks U+00C0..U+024F and
U+1E00..U+1EFF; the letters and symbols that have no decomposition are listed by hand.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._cols import as_col


# Latin blocks whose precomposed letters are folded by rule: Latin-1 Supplement, Latin Extended-A/B,
# Latin Extended Additional (Vietnamese and other stacked diacritics).
LATIN_BLOCKS = ((0xC0, 0x24F), (0x1E00, 0x1EFF))
# Combining diacritical marks: deleted, so decomposed (NFD) text folds like precomposed text.
COMBINING_MARKS = (0x300, 0x36F)


def _decomposition_table(blocks=LATIN_BLOCKS):
    """Letters whose NFKD form minus combining marks is plain ASCII, e.g. 'é' -> 'e', 'ǆ' -> 'dz'."""
    single, multi = {}, {}
    for first, last in blocks:
        for cp in range(first, last + 1):
            ch = chr(cp)
            if not unicodedata.category(ch).startswith("L"):
                continue
            base = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
            if base and base != ch and base.isascii():
                (single if len(base) == 1 else multi)[ch] = base
    return single, multi


# Letters without a decomposition and the signs of Latin-1 (all of U+00A0 to U+00BF, and the
# two operators), plus common punctuation beyond it, with their ASCII spelling.
EXTRA_FOLDS = {
    "ß": "ss", "Æ": "AE", "æ": "ae", "Ð": "D", "ð": "d", "Ø": "O", "ø": "o", "Þ": "Th", "þ": "th",
    "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "ĸ": "q", "Ŀ": "L", "ŀ": "l", "Ł": "L", "ł": "l",
    "Ŋ": "NG", "ŋ": "ng", "Œ": "OE", "œ": "oe", "Ŧ": "T", "ŧ": "t", "ƒ": "f",
    "\u00a0": " ", "¡": "!", "¢": "C/", "£": "PS", "¤": "$?", "¥": "Y=", "¦": "|", "§": "SS",
    "¨": '"', "©": "(c)", "ª": "a", "«": "<<", "¬": "!", "\u00ad": "", "®": "(r)", "¯": "-",
    "°": "deg", "±": "+-", "²": "2", "³": "3", "´": "'", "µ": "u", "¶": "P", "·": "*",
    "¸": ",", "¹": "1", "º": "o", "»": ">>", "¼": " 1/4 ", "½": " 1/2 ", "¾": " 3/4 ", "¿": "?",
    "×": "x", "÷": "/", "–": "-", "—": "--", "‘": "'", "’": "'", "“": '"', "”": '"', "…": "...", "€": "EUR",
}


def _fold_tables():
    single, multi = _decomposition_table()
    dropped = "".join(ch for ch, rep in EXTRA_FOLDS.items() if not rep)
    for ch, rep in EXTRA_FOLDS.items():
        if rep:
            (single if len(rep) == 1 else multi)[ch] = rep
    mapped = "".join(single)
    marks = "".join(chr(cp) for cp in range(COMBINING_MARKS[0], COMBINING_MARKS[1] + 1)
                    if unicodedata.combining(chr(cp)))
    # translate deletes source characters past the end of the replacement string: the marks go last
    return mapped + marks + dropped, "".join(single[ch] for ch in mapped), tuple(multi.items())


_FOLD_SRC, _FOLD_DST, _FOLD_MULTI = _fold_tables()
# 'ß' is the only one-to-many letter common in the data this library sees; the others are rare, so
# their replace chain only runs on the values still non-ASCII after translate and 'ß'.
_COMMON_MULTI = tuple((ch, rep) for ch, rep in _FOLD_MULTI if ch == "ß")
_RARE_MULTI = tuple((ch, rep) for ch, rep in _FOLD_MULTI if ch != "ß")


def _sql_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _rare_sql(expr: str) -> str:
    """The rare replacements, in order, as one fold over a literal list of them: a chain of calls per column would
    make the generated code of a wide table longer than the JVM compiles (it then interprets it, row by row)."""
    pairs = ", ".join(f"struct({_sql_literal(ch)} AS f, {_sql_literal(rep)} AS t)" for ch, rep in _RARE_MULTI)
    return f"aggregate(array({pairs}), {expr}, (done, p) -> replace(done, p.f, p.t))"


def ascii_fold_sql(expr: str) -> str:
    """The :func:`ascii_fold` expression as Spark SQL text over the SQL expression ``expr``."""
    out = f"translate({expr}, {_sql_literal(_FOLD_SRC)}, {_sql_literal(_FOLD_DST)})"
    for ch, rep in _COMMON_MULTI:
        out = f"replace({out}, {_sql_literal(ch)}, {_sql_literal(rep)})"
    return (f"CASE WHEN octet_length({expr}) = length({expr}) THEN {expr} "
            f"WHEN octet_length({out}) = length({out}) THEN {out} ELSE {_rare_sql(out)} END")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ascii_fold(c) -> Column:
    """Remove accents and spell Latin ligatures/symbols in ASCII: 'São João' -> 'Sao Joao', 'ß' -> 'ss'.

    Null stays null. Characters outside the table (other scripts) pass through unchanged.

    Cost: a pure-ASCII value (byte length = character length, counted without copying) is returned as
    is; otherwise one ``translate`` pass and one ``replace`` for 'ß'; the replace chain for rare
    ligatures/symbols runs only on values that are still non-ASCII after that.
    """
    if isinstance(c, str):  # one parsed SQL expression instead of ~60 Column-building calls
        return F.expr(ascii_fold_sql(_quoted(c)))
    out = F.translate(c, _FOLD_SRC, _FOLD_DST)
    for ch, rep in _COMMON_MULTI:
        out = F.replace(out, F.lit(ch), F.lit(rep))
    pairs = F.array(*[F.struct(F.lit(ch).alias("f"), F.lit(rep).alias("t")) for ch, rep in _RARE_MULTI])
    rare = F.aggregate(pairs, out, lambda done, p: F.replace(done, p["f"], p["t"]))
    # after translate and 'ß', only rare characters (or other scripts) can still be non-ASCII
    folded = F.when(_is_ascii(out), out).otherwise(rare)
    return F.when(_is_ascii(c), c).otherwise(folded)


def _is_ascii(c: Column) -> Column:
    """Byte length equals character length exactly when every character is ASCII (no copy, no regex)."""
    return F.octet_length(c) == F.length(c)


def clean_text(c) -> Column:
    """Registry text normal form: ASCII fold -> trim blanks -> initcap (words split on blanks only)."""
    if isinstance(c, str):
        return F.expr(f"initcap(trim({ascii_fold_sql(_quoted(c))}))")
    return F.initcap(F.trim(ascii_fold(c)))


def zero_pad(c, width: int) -> Column:
    """Left-pad with '0' to ``width``; longer values are cut to ``width`` (``lpad`` semantics)."""
    return F.lpad(as_col(c), width, "0")


def compose_id(*parts) -> Column:
    """Concatenate id parts; null when any part is null."""
    return F.concat(*[as_col(p) for p in parts])


def upper_trim(c) -> Column:
    return F.trim(F.upper(as_col(c)))


def fix_email(c) -> Column:
    """Lower-case, trim, and repair the apostrophe the source writes instead of '@'."""
    return F.replace(F.trim(F.lower(as_col(c))), F.lit("'"), F.lit("@"))


# Placeholders the register writes for "no street number".
NUMBER_SENTINELS = ("S/N", "S/N B")


def blank_sentinels(c, sentinels=NUMBER_SENTINELS) -> Column:
    """Sentinel values -> '' (null stays null, anything else unchanged)."""
    c = as_col(c)
    return F.when(c.isin(*sentinels), F.lit("")).otherwise(c)


def split_take(c, sep: str = "-", index: int = 1, keep_rest: bool = False) -> Column:
    """Element ``index`` (0-based) of ``c`` split on the regex ``sep``; null when absent.

    ``keep_rest=True`` splits at most ``index + 1`` times so the element keeps further separators
    ('RJ-Varre-Sai' -> 'Varre-Sai' instead of 'Varre').
    """
    parts = F.split(as_col(c), sep, index + 1) if keep_rest else F.split(as_col(c), sep)
    return F.get(parts, index)


def initcap_or(c, default: str) -> Column:
    """``initcap(coalesce(c, default))``."""
    return F.initcap(F.coalesce(as_col(c), F.lit(default)))
