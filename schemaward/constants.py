"""Names, word lists and tables that results must agree on."""

# Fallback for every declared type that cannot be resolved.
DEFAULT_TYPE = "VARCHAR(16777216)"

# Base types accepted as valid declared types.
VALID_BASE_TYPES = [
    "NUMBER", "DECIMAL", "NUMERIC", "INT", "INTEGER", "BIGINT", "SMALLINT",
    "TINYINT", "BYTEINT",
    "FLOAT", "FLOAT4", "FLOAT8", "DOUBLE", "DOUBLE PRECISION", "REAL",
    "VARCHAR", "CHAR", "CHARACTER", "STRING", "TEXT",
    "BINARY", "VARBINARY",
    "BOOLEAN",
    "DATE", "TIME", "TIMESTAMP", "TIMESTAMP_NTZ", "TIMESTAMP_LTZ", "TIMESTAMP_TZ",
    "VARIANT", "OBJECT", "ARRAY",
    "GEOGRAPHY", "GEOMETRY",
]

# Declared base type -> canonical base type.
TYPE_SYNONYMS = {
    "INT": "NUMBER",
    "BIGINT": "NUMBER",
    "SMALLINT": "NUMBER",
    "TINYINT": "NUMBER",
    "BYTEINT": "NUMBER",
    "NUM": "NUMBER",
    "DEC": "NUMBER",
    "DOUBLE PRECISION": "FLOAT",
    "TEXT": "VARCHAR",
    "STR": "VARCHAR",
    "STRING": "VARCHAR",
    "BOOL": "BOOLEAN",
    "DATETIME": "TIMESTAMP_NTZ",
    "DATE_TIME": "TIMESTAMP_NTZ",
    "TIMESTAMP_NO_TZ": "TIMESTAMP_NTZ",
    "TIMESTAMP_WITH_TZ": "TIMESTAMP_LTZ",
}

# Canonical base type -> warehouse type, the shipped default type map.
DEFAULT_TYPE_MAP = {
    "VARCHAR": "VARCHAR",
    "CHAR": "VARCHAR",
    "STRING": "VARCHAR",
    "TEXT": "VARCHAR",
    "NUMBER": "NUMBER",
    "INTEGER": "NUMBER",
    "INT": "NUMBER",
    "DECIMAL": "NUMBER",
    "NUMERIC": "NUMBER",
    "BOOLEAN": "BOOLEAN",
    "BOOL": "BOOLEAN",
    "DATE": "DATE",
    "TIMESTAMP": "TIMESTAMP_LTZ",
    "TIME": "TIME",
    "BIGINT": "NUMBER(38,0)",
}

# Base types that become NUMBER(38,0) when they map to NUMBER without parameters.
INTEGER_LIKE = ["NUMBER", "INTEGER", "INT", "DECIMAL", "NUMERIC"]

# Header keys whose cells are yes/no flags.
FLAG_KEYS = ["add_to_target", "is_primary_key", "deprecated"]

# Page labels read from the text above the tables.
TABLE_LABEL = "Table name:"
SCHEMA_LABEL = "Schema name:"
DATABASE_LABEL = "Database name:"
PRIMARY_KEYS_LABEL = "Primary Keys:"
FOREIGN_KEYS_LABEL = "Foreign Keys:"
HISTORISATION_SUFFIX = "Historization: SCD-2"
TITLE_PREFIX = "Table: "

# States from which a page is parsed again even though its hash is unchanged.
RETRY_STATES = ["PENDING_PARSE", "PARSE_FAILED", "API_FAILED_CONTENT", "DB_FAILED"]

MATCH_THRESHOLD = 80.0
MATCH_STRATEGY = "TOKEN_SET_RATIO"
