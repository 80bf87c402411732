"""Word lists, limits, tolerances, message texts and formats.

Results depend on these exact values, so they are stated once, plainly.
"""

SCHEMA_VERSION = "1.0"

# Whitespace as ECMAScript defines \s (Java's \s lacks everything after \x0B here).
WHITESPACE = r"[\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"

# Dashes read as a hyphen in range texts.
DASHES = r"[\x{2012}\x{2013}\x{2014}\x{2212}]"

# Range texts and the leading number of a percent text.
BOUNDED = r"(\d+(?:\.\d+)?)\s*(?:-|to)\s*(\d+(?:\.\d+)?)"
OPEN_HIGH = r"(\d+(?:\.\d+)?)(?:\s*\+|\s*and\s+above)"
AT_LEAST = r">=\s*(\d+(?:\.\d+)?)"
OPEN_LOW = r"(?:<|under|less\s+than)\s*(\d+(?:\.\d+)?)"
NUMBER_PREFIX = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"

MONTH_NAMES = [
    "january", "february", "march", "april", "may", "june", "july",
    "august", "september", "october", "november", "december",
]
EXTRA_MONTH_ABBREVIATIONS = {"sept": "09"}

# Enumerations of the candidate document.
ARTIFACT_TYPES = ["html", "pdf"]
CARRIERS = ["UPS", "FedEx"]
PROGRAMS = ["ground", "air", "international", "unknown"]
BASIS_HINTS = ["diesel", "jet", "gasoline", "unknown"]
SEVERITIES = ["info", "warning", "error"]
SOURCE_MODES = ["DIRECT", "DISCOVERY"]

# Default price series and the program each one drives.
SERIES_PROGRAM = {
    "PET.EMD_EPD2D_PTE_NUS_DPG.W": "ground",
    "PET.EER_EPJK_PF4_RGC_DPG.W": "air",
}

# Page outline limits.
MAX_HEADINGS = 50
MAX_TABLES = 15
MAX_LINKS = 50
MAX_SAMPLE_ROWS = 5
FIELD_MAX = 300
TABLE_TEXT_MAX = 200
LINK_TEXT_MAX = 120
LINK_WORDS = ["fuel", "surcharge", "table", "effective", "rate", "pdf"]

# Comparison tolerances.
VALUE_TOLERANCE = 0.01
BRACKET_EPSILON = 1e-9

# Bytes that the JSON parser takes for sure; single strings beyond 20 million characters it refuses.
PARSED_BYTES = 16 << 20

# Names of the documents of a run folder.
DELTA_FILE = "fsc_delta_records.jsonl"
MANIFEST_FILE = "run_manifest.json"
SNAPSHOT_FILE = "parsed.json"
META_FILE = "meta.json"
RESPONSE_FILE = "extraction_response.json"
REPORT_FILE = "validation_report.json"

# Categories of a parity report.
MISSING, EXTRA = "MISSING_IN_LLM", "EXTRA_IN_LLM"
VALUE_MISMATCH, SCOPE_MISMATCH = "BRACKET_VALUE_MISMATCH", "SCOPE_OR_DATE_MISMATCH"

STRUCTURAL_CODE = "PARSER_STRUCTURAL_ERROR"
GATE_FAILED_MESSAGE = "PARSER_STRUCTURAL_ERROR: Candidate schema validation failed."
STRUCTURE_FAILED_MESSAGE = "PARSER_STRUCTURAL_ERROR: Structural parse failure."
NO_PROGRAMS_MESSAGE = "No programs were extracted from the candidate."
NO_LINKS_MESSAGE = "LINKS_NOT_FOUND: No discoverable artifacts were found."
