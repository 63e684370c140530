"""Schema facts: the "M" expectations and the declared-vs-observed view (P5).

Nothing here scans data: ``df.schema`` is known on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from probity.checks import Check

# Logical type family -> Spark type names (simpleString) that satisfy it.
FAMILIES = {
    "integer": {"tinyint", "smallint", "int", "bigint"},
    "int": {"tinyint", "smallint", "int", "bigint"},
    "long": {"tinyint", "smallint", "int", "bigint"},
    "bigint": {"tinyint", "smallint", "int", "bigint"},
    "number": {"tinyint", "smallint", "int", "bigint", "float", "double", "decimal"},
    "numeric": {"tinyint", "smallint", "int", "bigint", "float", "double", "decimal"},
    "decimal": {"decimal"},
    "double": {"double", "float"},
    "float": {"double", "float"},
    "string": {"string", "varchar", "char"},
    "text": {"string", "varchar", "char"},
    "varchar": {"string", "varchar", "char"},
    "timestamp": {"timestamp", "timestamp_ntz"},
    "datetime": {"timestamp", "timestamp_ntz"},
    "date": {"date"},
    "time": {"string", "time"},
    "boolean": {"boolean"},
    "bool": {"boolean"},
    "binary": {"binary"},
    "bytes": {"binary"},
    "array": {"array"},
    "object": {"struct", "map", "string"},
}

# Type names of databases -> the family that holds their values.
DATABASE_TYPES = {
    "tinyint": "integer", "smallint": "integer", "mediumint": "integer", "int2": "integer", "int4": "integer", "int8": "integer", "serial": "integer",
    "dec": "number", "fixed": "number", "real": "float", "float4": "float", "float8": "double", "double precision": "double",
    "tinytext": "text", "mediumtext": "text", "longtext": "text", "character varying": "text", "character": "text", "nvarchar": "text", "nchar": "text",
    "enum": "text", "set": "text", "json": "text", "jsonb": "text", "uuid": "text",
    "varbinary": "binary", "tinyblob": "binary", "blob": "binary", "mediumblob": "binary", "longblob": "binary", "bytea": "binary",
    "timestamptz": "timestamp", "bit": "boolean",
}


def database_family(wanted: str) -> str:
    """``INT(11) unsigned``, ``varchar(45)``, ``mediumtext`` -> a name of ``FAMILIES``; other names come back in lower case
    without length and attributes.  ``tinyint(1)`` is how a database spells a boolean, so it may hold either."""
    name = wanted.strip().lower()
    for word in (" unsigned", " signed", " zerofill", " with time zone", " without time zone"):
        name = name.replace(word, "")
    name = name.split("(")[0].split(" character set")[0].strip()
    return DATABASE_TYPES.get(name, name)

_CLASS_NAMES = {
    "ByteType": "tinyint",
    "ShortType": "smallint",
    "IntegerType": "int",
    "LongType": "bigint",
    "FloatType": "float",
    "DoubleType": "double",
    "DecimalType": "decimal",
    "StringType": "string",
    "BooleanType": "boolean",
    "BinaryType": "binary",
    "DateType": "date",
    "TimestampType": "timestamp",
    "TimestampNTZType": "timestamp_ntz",
}


def base_type(dt: T.DataType) -> str:
    s = dt.simpleString()
    return s.split("(")[0].split("<")[0]


def type_matches(dt: T.DataType, wanted: str) -> bool:
    """``wanted`` is a logical family (integer, number, string, timestamp ...),
    a Spark SQL name (bigint, decimal(10,2)) or a Spark class name (LongType)."""
    w = wanted.strip()
    if w in _CLASS_NAMES:
        return base_type(dt) == _CLASS_NAMES[w]
    wl = w.lower()
    if wl == dt.simpleString().lower():
        return True
    if wl.replace(" ", "").startswith("tinyint(1)") and base_type(dt) == "boolean":
        return True
    # a length only counts in Spark's own spelling (above); decimals must match in full
    if wl.startswith("decimal(") and base_type(dt) == "decimal":
        return wl.replace(" ", "") == dt.simpleString().lower()
    fam = FAMILIES.get(database_family(wl))
    if fam is not None:
        return base_type(dt) in fam
    return base_type(dt) == wl.split("(")[0]


def evaluate_schema_check(chk: Check, df: DataFrame) -> dict:
    """Result fields for an M check (element / missing counts are null: no scan)."""
    cols = df.columns
    k = chk.kind
    obs = None
    bad = None
    if k == "column_to_exist":
        ok = chk.column in cols
    elif k == "column_values_to_be_of_type":
        ok = chk.column in cols and type_matches(df.schema[chk.column].dataType, chk.p("type_"))
    elif k == "column_values_to_be_in_type_list":
        ok = chk.column in cols and any(type_matches(df.schema[chk.column].dataType, t) for t in chk.p("type_list"))
    elif k == "table_column_count_to_equal":
        obs = float(len(cols))
        ok = len(cols) == int(chk.p("value"))
    elif k == "table_column_count_to_be_between":
        obs = float(len(cols))
        lo, hi = chk.p("min_value"), chk.p("max_value")
        ok = (lo is None or len(cols) >= lo) and (hi is None or len(cols) <= hi)
    elif k == "table_columns_to_match_ordered_list":
        want = list(chk.p("column_list"))
        bad = sum(1 for i in range(max(len(want), len(cols))) if i >= len(want) or i >= len(cols) or want[i] != cols[i])
        ok = bad == 0
    elif k == "table_columns_to_match_set":
        want = set(chk.p("column_set"))
        have = set(cols)
        missing, extra = want - have, have - want
        exact = chk.p("exact_match", True)
        bad = len(missing) + (len(extra) if exact else 0)
        ok = bad == 0
    else:
        raise ValueError(f"not a schema check: {k}")
    return {
        "check_id": chk.check_id,
        "element_count": None,
        "missing_count": None,
        "unexpected_count": bad,
        "unexpected_percent": None,
        "success": bool(ok),
        "observed_value": obs,
    }


SCHEMA_VIEW_DDL = "table STRING, column STRING, position INT, declared_type STRING, observed_type STRING, status STRING"


def schema_view(spark: SparkSession, declared: dict[str, dict[str, str]], tables: dict[str, DataFrame]) -> DataFrame:
    """P5: declared against observed type per column.

    ``declared`` maps table -> {column: logical or physical type}.  Status:
    ``match``, ``type_differs``, ``missing`` (declared, absent from the data),
    ``extra`` (in the data, not declared), ``table_missing``.  Both sides are
    driver-side metadata (a few hundred rows at most)."""
    rows = []
    for table in sorted(set(declared) | set(tables)):
        decl = declared.get(table, {})
        df = tables.get(table)
        if df is None:
            for i, (c, t) in enumerate(decl.items()):
                rows.append((table, c, None, t, None, "table_missing"))
            continue
        obs = {f.name: f.dataType for f in df.schema.fields}
        pos = {c: i for i, c in enumerate(df.columns)}
        for c, t in decl.items():
            if c not in obs:
                rows.append((table, c, None, t, None, "missing"))
            else:
                status = "match" if (t is None or type_matches(obs[c], t)) else "type_differs"
                rows.append((table, c, pos[c], t, obs[c].simpleString(), status))
        for c in df.columns:
            if c not in decl:
                rows.append((table, c, pos[c], None, obs[c].simpleString(), "extra"))
    return spark.createDataFrame(rows, SCHEMA_VIEW_DDL)
