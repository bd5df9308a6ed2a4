"""Fixed values that results depend on. They are stated here once and used by name."""

# ---- fixed values -------------------------------------------------------------------
# Combined access-log line: ip, identity, user, time, request, status, bytes, referrer, agent.
ACCESS_LOG_PATTERN = r'^([\d.]+) (\S+) (\S+) \[([\w\d:/]+\s[+\-]\d{4})\] "(.+?)" (\d{3}) ([\d\-]+) "([^"]+)" "([^"]+)"'  # noqa: E501
ANONYMOUS_USER = '"-"'

# Flight record, comma separated, positions from 0.
FLIGHT_FIELDS = {"carrier": 8, "flight_num": 9, "take_off_delay_mins": 15,
                 "origin": 16, "destination": 17}

# Sales record, pipe separated, positions from 0.
SALE_FIELDS = {"product_id": 7, "store_id": 2, "date": 4, "time": 5,
               "units": 8, "price": 10, "type": 6}
SALE_TYPE = "SALE"

# Delay status thresholds in minutes: default pair and the fallback pair.
DELAY_LIMITS = (10, 45)
FALLBACK_DELAY_LIMITS = (10, 60)

# Rows buffered per airport before they are released.
RELEASE_AT = 300

# Sliding window over the flight stream.
FLIGHT_WINDOW = "15 minutes"

# Words in a place name that mark it as no airport.
NON_AIRPORT_WORDS = ("Station", "Train", "Amtrak")

# A recommended item needs this many ratings; the report lists this many items.
MIN_RATINGS = 25
REPORT_SIZE = 25

# Housing survey measures averaged per state; the last two are yearly costs.
HOUSING_MEASURES = ("VALP", "ACR", "ELEP", "GASP", "FULP", "WATP")
HOUSING_LOT_SIZES = (1, 2, 3)

# PageRank: share kept by every page, share passed along links.
RANK_BASE = 0.15
RANK_DAMPING = 0.85
# -------------------------------------------------------------------------------------
