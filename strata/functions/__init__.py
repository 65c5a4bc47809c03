from .casts import try_cast_int, try_cast_date
from .rows import row_changed, rows_equal
from .strings import clean_strings

__all__ = ["try_cast_int", "try_cast_date", "row_changed", "rows_equal", "clean_strings"]
