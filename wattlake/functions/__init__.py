"""Column expressions (JVM-side, whole-stage codegen friendly)."""

from wattlake.functions.datetime import (date_parts, hour_offset_expr, is_weekend,
                                         shift_hours, weekday)
from wattlake.functions.weather import relative_humidity, wind_components
from wattlake.functions.target import (blend, clip_min, convert_units, exp_target,
                                       log_target, restore_site0_units)
from wattlake.functions.lookup import country_of_site, map_lookup, site_offset
from wattlake.functions.split import split_bucket

__all__ = ["date_parts", "hour_offset_expr", "is_weekend", "shift_hours", "weekday",
           "relative_humidity", "wind_components", "blend", "clip_min", "convert_units",
           "exp_target", "log_target", "restore_site0_units", "country_of_site",
           "map_lookup", "site_offset", "split_bucket"]
