from isochron.functions.timekeys import file_time, hour_floor, hour_key, hours_after, ntz_literal, reading_time
from isochron.functions.values import analytic_value, as_float32, blank_to_zero, decode_cell, parse_type_map
from isochron.functions.specs import differencing_spec, range_spec, year_spec

__all__ = [
    "analytic_value", "as_float32", "blank_to_zero", "decode_cell", "differencing_spec", "file_time",
    "hour_floor", "hour_key", "hours_after", "ntz_literal", "parse_type_map", "range_spec", "reading_time", "year_spec",
]
