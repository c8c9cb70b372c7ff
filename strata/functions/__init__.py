from .columns import (bucket, flatten, integral_double_to_string, iso_timestamp, map_codes,
                      name_norm, normalize_columns, normalize_name, rate, title_case,
                      zero_as_missing_flags)
from .json import parse_json

__all__ = ["bucket", "flatten", "integral_double_to_string", "iso_timestamp", "map_codes",
           "name_norm", "normalize_columns", "normalize_name", "parse_json", "rate",
           "title_case", "zero_as_missing_flags"]
