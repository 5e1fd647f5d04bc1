"""Column-level helpers (all built-in Spark expressions, codegen friendly)."""

from blotter.functions.columns import (  # noqa: F401
    calendar_parts, normalize_flag, parse_ts, presence_flag, rate, valid_coords,
    normalize_key, month_name, day_name, title_label,
)
