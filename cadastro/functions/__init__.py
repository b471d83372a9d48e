"""Column -> Column functions (all native Spark expressions)."""

from .codes import AGE_BANDS, COMPANY_SIZES, HEAD_OFFICE, PARTNER_KINDS, code_label
from .parsing import decimal_comma, lenient_date, lenient_double, lenient_int, lenient_long, year_month
from .text import (
    NUMBER_SENTINELS,
    ascii_fold,
    blank_sentinels,
    clean_text,
    compose_id,
    fix_email,
    initcap_or,
    split_take,
    upper_trim,
    zero_pad,
)

__all__ = [
    "AGE_BANDS", "COMPANY_SIZES", "HEAD_OFFICE", "PARTNER_KINDS", "NUMBER_SENTINELS",
    "ascii_fold", "blank_sentinels", "clean_text", "code_label", "compose_id", "decimal_comma",
    "fix_email", "initcap_or", "lenient_date", "lenient_double", "lenient_int", "lenient_long",
    "split_take", "upper_trim", "year_month", "zero_pad",
]
