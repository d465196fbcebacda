"""Fixed domain values.  These must equal the values the modelled project
uses, so they are stated plainly and in natural order."""

# --- fixed values -----------------------------------------------------------
# UTC offset in hours for sites 0..15 (no daylight saving).
SITE_UTC_OFFSETS = [-5, 0, -7, -5, -8, 0, -5, -5, -5, -6, -7, -5, 0, -6, -5, -5]

# Site -> country code.
SITE_COUNTRIES = {0: "US", 1: "UK", 2: "US", 3: "US", 4: "US", 5: "UK", 6: "US", 7: "CA",
                  8: "US", 9: "US", 10: "US", 11: "CA", 12: "IE", 13: "US", 14: "US", 15: "US"}

# Meter type -> name.
METER_NAMES = {0: "electricity", 1: "chilledwater", 2: "steam", 3: "hotwater"}

# Unit conversion multipliers (not exact inverses of each other; kept literal).
UNIT_FACTORS = {"kbtu_to_kwh": 0.2931, "kwh_to_kbtu": 3.4118,
                "kbtu_to_ton": 0.0833, "ton_to_kbtu": 12.0}

# Weather columns filled by linear and by cubic interpolation.
LINEAR_FILL_COLS = ["wind_direction", "wind_speed"]
CUBIC_FILL_COLS = ["air_temperature", "dew_temperature", "sea_level_pressure"]

# Required input columns.
METER_COLS = ["building_id", "meter", "timestamp"]
WEATHER_COLS = ["site_id", "timestamp", "air_temperature", "dew_temperature",
                "sea_level_pressure", "wind_speed", "wind_direction"]

# Model feature list (site_id and meter are carried for later use).
MODEL_FEATURES = ["building_id", "primary_use", "square_feet", "year_built", "country",
                  "dayofyear", "hour", "is_weekend", "is_holiday",
                  "rel_humidity", "dew_temperature", "sea_level_pressure",
                  "wind_speed", "wind_direction_y", "site_id", "meter"]

# Readings per complete meter in a leap year of hourly data.
FULL_YEAR_READINGS = 8784

# Input validation limits.
METER_LIMITS = {"building_id": (0, 1448), "meter": (0, 3)}
WEATHER_LIMITS = {"site_id": (0, 15), "air_temperature": (-95, 95),
                  "dew_temperature": (-95, 95), "sea_level_pressure": (800, 1100),
                  "wind_speed": (0, None), "wind_direction": (0, 360)}

# Rare-label defaults: share below tol -> 'Rare', only with more than n categories.
RARE_TOL = 0.05
RARE_MIN_CATEGORIES = 10
RARE_LABEL = "Rare"
# --- end fixed values -------------------------------------------------------
