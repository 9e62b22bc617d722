"""Column -> Column helpers."""

from chunkwise.functions.numeric import (fill_constant, lax_double, lax_int, round2,
                                         round_python, threshold_label)
from chunkwise.functions.rules import (Rule, coercible, errors_column, max_length, one_of,
                                       required)
from chunkwise.functions.text import (camel_case, iso_timestamp, json_scalar, norm_category,
                                      not_like, serialize_value, snake_case, strip_blanks,
                                      truncate_text, upper_strings)

__all__ = [
    "Rule", "camel_case", "coercible", "errors_column", "fill_constant", "iso_timestamp",
    "json_scalar", "lax_double", "lax_int", "max_length", "norm_category", "not_like",
    "one_of", "required", "round2", "round_python", "serialize_value", "snake_case", "strip_blanks",
    "threshold_label", "truncate_text", "upper_strings",
]
