from ledgerline.functions.text import (
    code,
    country_label,
    is_blank,
    is_not_an_email,
    is_unnormalised,
    label,
    text_key,
)
from ledgerline.functions.money import as_of_date, month_of, to_eur

__all__ = [
    "as_of_date",
    "code",
    "country_label",
    "is_blank",
    "is_not_an_email",
    "is_unnormalised",
    "label",
    "month_of",
    "text_key",
    "to_eur",
]
