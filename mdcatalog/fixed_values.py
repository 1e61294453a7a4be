"""Constants, patterns, word lists and formats of the catalog format.

Everything in this file is a fixed value. These must equal what existing
catalogs and their tools use, otherwise results would differ; they are stated
here once, as plain text, and used everywhere else by name.
"""

# --- profiling thresholds -------------------------------------------------
LOW_CARDINALITY = 12        # value sets up to this size are listed
SEMANTIC_MAJORITY = 0.9     # share of non-blank values that must match a pattern
TYPE_INFERENCE_ROWS = 1000  # rows looked at when inferring the type of a text column
DOCUMENT_SAMPLE = 100       # documents looked at per collection
COCHANGE_MIN = 2            # smallest co-change count that is reported
COCHANGE_TOP = 10           # partners reported per file

# --- semantic value patterns (checked in this order) ----------------------
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
ISO_TIME = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2})?(\.\d+)?(Z|[+-]\d{2}:?\d{2})?)?$"
MONETARY = r"^[\$€£¥]\s?-?\d[\d,]*(\.\d{2})?$|^-?\d[\d,]*\.\d{2}$"
BOOLEAN_WORDS = ["true", "false", "0", "1", "t", "f", "yes", "no", "y", "n"]
KEY_NAME = r"(?i)(^|_)id$|_id$|^id[A-Z]|Id$"
INTEGER = r"^-?\d+$"

# --- CSV type inference ---------------------------------------------------
CSV_BOOLEAN_WORDS = ["true", "false", "yes", "no", "t", "f"]
FRESHNESS_TYPE = r"(?i)DATE|TIME|TIMESTAMP"
FRESHNESS_NAME = r"(?i)(^|_)(date|time|timestamp)|_at$|_on$"

# --- descriptions that connectors write when they know nothing better ------
PLACEHOLDERS = [
    r"^SQLite (table|view) .+$",
    r"^MySQL (table|view) .+$",
    r"^PostgreSQL (table|view) .+$",
    r"^BigQuery (table|view) .+$",
    r"^MongoDB collection .+$",
    r"^File .+$",
    r"^Directory .+$",
    r"^Git file .+$",
    r"^Git directory .+$",
    r"^CSV file .+$",
    r"^API endpoint .+$",
    r"^API schema .+$",
    r"^GraphQL (type|query|mutation|subscription) .+$",
    r"^No description available$",
]

# --- Markdown and link patterns -------------------------------------------
LINK = r"\[([^\]]*)\]\(([^)]+)\)"
FK_LABEL = r"(?i)FK on (\w+)"
DIVIDER_CELL = r"^:?-+:?$"
HEADING_RELATION = {
    "relationships": "references",
    "related files": "co-changes",
    "joins": "joins-with",
    "see also": "see-also",
}
TEXT_RELATION = {
    "fk": "references",
    "references": "references",
    "joins-with": "joins-with",
    "see-also": "see-also",
}
RESERVED_FILES = ["index.md", "log.md"]
ROOT_NODE = "__root__"
LOG_TITLE = "# Change Log"

# --- frontmatter fields, in writing order ---------------------------------
FRONTMATTER_FIELDS = [
    "type", "title", "description", "resource", "tags",
    "timestamp", "content_hash", "enriched_against",
]

# --- audit rule names -----------------------------------------------------
RULE_UNPARSEABLE = "concept-unparseable"
RULE_MISSING_TYPE = "concept-missing-type"
RULE_ROOT_EXTRA_KEYS = "root-index-extra-keys"
RULE_SUBDIR_FRONTMATTER = "subdir-index-frontmatter"

# --- column-table layouts per source: header cell -> field ------------------
COLUMN_LAYOUTS = {
    "csv": [("Name", "name"), ("Type", "type")],
    "sqlite": [("Name", "name"), ("Type", "type"), ("Primary Key", "pk"),
               ("Nullable", "nullable"), ("Default", "default")],
    "mysql": [("Name", "name"), ("Type", "type"), ("Key", "key"), ("Nullable", "nullable"),
              ("Default", "default"), ("Extra", "extra"), ("Comment", "comment")],
    "postgresql": [("Name", "name"), ("Type", "type"), ("Nullable", "nullable"),
                   ("Comment", "comment")],
    "bigquery": [("Name", "name"), ("Type", "type"), ("Required", "mode"),
                 ("Description", "comment")],
    "mongodb": [("Name", "name"), ("Type", "type"), ("Presence", "presence")],
    "api": [("Name", "name"), ("Type", "type"), ("Required", "required")],
}

# --- evaluation bands and limits ------------------------------------------
SCORE_BANDS = {"low": (1, 2), "mid": (3, 3), "high": (4, 5)}
REGRESSION_DROP = 0.5
REDO_DIMENSIONS = ["grounding", "specificity"]
REDO_SCORE = 2

# --- personal-data column names ---------------------------------------------
PII_NAMES = ["email", "phone", "ssn", "dob", "first_name", "last_name", "address", "ip"]
PII_SEMANTICS = ["email", "uuid"]

# --- HTTP methods of an API path item ---------------------------------------
HTTP_METHODS = ["connect", "delete", "get", "head", "options", "patch", "post", "put", "trace"]

# --- GraphQL ----------------------------------------------------------------
GRAPHQL_SCALARS = ["String", "Int", "Float", "Boolean", "ID"]
GRAPHQL_KEYWORDS = ["schema", "scalar", "type", "interface", "union", "enum", "input", "directive", "extend"]

# White space as Unicode defines it (what trimming removes at both ends).
WHITESPACE = (
    "\t\n\v\f\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# How characters of a commit message are written inside double quotes, in this order.
QUOTED = [("\\", "\\\\"), ('"', '\\"'), ("\a", "\\a"), ("\b", "\\b"), ("\f", "\\f"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\v", "\\v")]
