from ledgerline.operators.bitmaps import maybe_in
from ledgerline.operators.keys import any_of, first_per_key, keyed, sql_not_in, union_all, with_row_id
from ledgerline.operators.picks import current_status

__all__ = [
    "any_of",
    "current_status",
    "first_per_key",
    "keyed",
    "maybe_in",
    "sql_not_in",
    "union_all",
    "with_row_id",
]
