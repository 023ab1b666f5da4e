from .dates import date_key, date_spine, partition_values
from .keys import surrogate_key
from .lookups import MONTH_WEIGHTS, lookup_constant
from .text import new_run_id, strip_prefix
from .validity import valid_at
from .variants import from_text, is_unreadable, typed, vget

__all__ = [
    "MONTH_WEIGHTS", "date_key", "date_spine", "from_text", "is_unreadable", "lookup_constant",
    "new_run_id", "partition_values", "strip_prefix", "surrogate_key", "typed", "valid_at", "vget",
]
