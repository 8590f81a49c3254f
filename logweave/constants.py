"""Fixed values that must equal the reference behaviour for equal results.

FIXED VALUES — do not edit: they define which lines are valid and how they map
to columns and batch keys.
"""

# FIXED VALUES ---------------------------------------------------------------
# Whole-line pattern: host, ident, user, [timestamp], "request", status, bytes.
# The reference applies its pattern with a whole-input match; Spark's regex
# functions search, so the end is anchored with \z (end of input) here.
LOG_LINE_REGEX = r'^(\S+)\s+\S+\s+\S+\s+\[([^\]]+)\]\s+"([^"]*)"\s+(\d{3})\s+(\S+)\z'

# English short month names, case-sensitive, January first.
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
               "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# Request line is split on runs of whitespace into method / path / protocol.
REQUEST_SPLIT_REGEX = r"\s+"

# Bytes field: "-" means zero, otherwise a signed 64-bit integer.
BYTES_DASH = "-"

# Error predicate: status in [400, 599] inclusive.
ERROR_STATUS_MIN = 400
ERROR_STATUS_MAX = 599

# Batching.
DEFAULT_BATCH_SIZE = 10000
MALFORMED_BATCH_KEY = "__malformed__"
FIXED_BATCH_PREFIX = "batch_"
MONTH_KEY_FORMAT = "%04d-%02d"
WEEK_KEY_FORMAT = "%04d-W%02d"
STRATEGY_ALIASES = {"monthly": "monthly", "month": "monthly",
                    "weekly": "weekly", "week": "weekly"}

# Top resources query.
TOP_RESOURCES_LIMIT = 20

# Result sinks: resource_path column width; report display widths.
RESOURCE_PATH_MAX = 512
REPORT_ROW_LIMIT = 20
REPORT_PATH_WIDTH = 47
REPORT_PATH_KEEP = 44
REPORT_RATE_DECIMALS = 4
COMPARE_DIFFS_SHOWN = 5

# The three queries by name.
ALL_QUERIES = ("q1", "q2", "q3")
# END FIXED VALUES -----------------------------------------------------------
