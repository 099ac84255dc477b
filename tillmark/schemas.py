"""Table schemas, keys and references of the retail model."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def spark_type(db_type: str) -> T.DataType:
    """The Spark type for a database column type such as ``decimal(5,2)`` or ``int(11)``.

    ``tinyint(1)`` stays an integer because status columns hold 0 to 5 in it.
    """
    text = db_type.strip().lower()
    name = re.match(r"[a-z]+", text)
    args = [int(n) for n in re.findall(r"\d+", text)]
    match name.group(0) if name else "":
        case "bigint":
            return T.LongType()
        case "int" | "integer" | "mediumint" | "smallint" | "tinyint":
            return T.IntegerType()
        case "bool" | "boolean" | "bit":
            return T.BooleanType()
        case "decimal" | "numeric":
            return T.DecimalType(*(args or [10, 0]))
        case "float" | "double" | "real":
            return T.DoubleType()
        case "datetime" | "timestamp":
            return T.TimestampNTZType()
        case "date":
            return T.DateType()
        case _:
            return T.StringType()


def struct_of(columns: list[tuple[str, str]]) -> T.StructType:
    """A schema from (column, database type) pairs."""
    return T.StructType([T.StructField(name, spark_type(kind)) for name, kind in columns])


def _parsed(columns: str) -> T.StructType:
    pairs = [c.split(maxsplit=1) for c in re.split(r",(?![^(]*\))", columns)]
    return T.StructType(
        [T.StructField(name, spark_type(kind), not kind.endswith("NOT NULL")) for name, kind in pairs]
    )


_STAMPS = "create_time TIMESTAMP_NTZ, update_time TIMESTAMP_NTZ"

# Column lists as Spark writes them.
_TABLES = {
    "py_user": """
        id BIGINT NOT NULL, username STRING, password STRING, nickname STRING, sex STRING,
        age INT, phone STRING, email STRING, birthday STRING, card STRING, content STRING,
        remarks STRING, role STRING""",
    "member_level": f"""
        id BIGINT NOT NULL, level_name STRING NOT NULL, min_points INT NOT NULL,
        max_points INT NOT NULL, discount DECIMAL(3,2) NOT NULL, description STRING, {_STAMPS}""",
    "supplier": f"""
        id BIGINT NOT NULL, supplier_name STRING NOT NULL, contact_person STRING,
        contact_phone STRING, address STRING, email STRING, status INT, {_STAMPS}""",
    "store": f"""
        id BIGINT NOT NULL, store_name STRING NOT NULL, store_code STRING NOT NULL,
        address STRING, manager STRING, phone STRING, business_hours STRING, status INT,
        {_STAMPS}""",
    "sales_channel": f"""
        id BIGINT NOT NULL, channel_name STRING NOT NULL, channel_type STRING NOT NULL,
        channel_code STRING NOT NULL, description STRING, commission_rate DECIMAL(5,2),
        status INT, {_STAMPS}""",
    "marketing_campaign": f"""
        id BIGINT NOT NULL, campaign_name STRING NOT NULL, campaign_type STRING NOT NULL,
        start_time TIMESTAMP_NTZ NOT NULL, end_time TIMESTAMP_NTZ NOT NULL,
        discount_rate DECIMAL(5,2), discount_amount DECIMAL(10,2),
        min_order_amount DECIMAL(10,2), channel_scope STRING, product_scope STRING,
        user_scope STRING, usage_limit INT, budget DECIMAL(10,2), status INT,
        description STRING, {_STAMPS}""",
    "product_category": f"""
        id BIGINT NOT NULL, category_name STRING NOT NULL, parent_id BIGINT, level INT,
        sort_order INT, status INT, {_STAMPS}""",
    "product": f"""
        id BIGINT NOT NULL, product_name STRING NOT NULL, product_code STRING NOT NULL,
        category_id BIGINT NOT NULL, supplier_id BIGINT, brand STRING, model STRING,
        unit STRING, price DECIMAL(10,2) NOT NULL, cost_price DECIMAL(10,2),
        market_price DECIMAL(10,2), stock INT, warning_stock INT, sales INT,
        weight DECIMAL(10,2), volume DECIMAL(10,2), is_new INT, is_hot INT,
        is_recommend INT, status INT, description STRING, {_STAMPS}""",
    "product_inventory": f"""
        id BIGINT NOT NULL, product_id BIGINT NOT NULL, store_id BIGINT NOT NULL,
        quantity INT NOT NULL, locked_quantity INT NOT NULL, {_STAMPS}""",
    "user_address": f"""
        id BIGINT NOT NULL, user_id BIGINT NOT NULL, receiver STRING NOT NULL,
        phone STRING NOT NULL, province STRING, city STRING, district STRING,
        detail_address STRING NOT NULL, is_default INT, {_STAMPS}""",
    "user_behavior": """
        id BIGINT NOT NULL, user_id BIGINT NOT NULL, product_id BIGINT,
        behavior_type STRING NOT NULL, search_keyword STRING, session_id STRING,
        ip_address STRING, user_agent STRING, referrer STRING, create_time TIMESTAMP_NTZ""",
    "sales_order": f"""
        id BIGINT NOT NULL, order_no STRING NOT NULL, user_id BIGINT NOT NULL,
        store_id BIGINT, order_source STRING NOT NULL, channel_id BIGINT, campaign_id BIGINT,
        order_status INT, payment_method STRING, payment_status INT,
        payment_time TIMESTAMP_NTZ, delivery_method STRING, delivery_status INT,
        delivery_time TIMESTAMP_NTZ, complete_time TIMESTAMP_NTZ, address_id BIGINT,
        total_amount DECIMAL(10,2) NOT NULL, discount_amount DECIMAL(10,2),
        shipping_amount DECIMAL(10,2), payment_amount DECIMAL(10,2) NOT NULL, remark STRING,
        {_STAMPS}""",
    "sales_detail": """
        id BIGINT NOT NULL, order_id BIGINT NOT NULL, product_id BIGINT NOT NULL,
        product_name STRING NOT NULL, product_code STRING NOT NULL, quantity INT NOT NULL,
        unit_price DECIMAL(10,2) NOT NULL, total_price DECIMAL(10,2) NOT NULL,
        discount_price DECIMAL(10,2), actual_price DECIMAL(10,2) NOT NULL,
        create_time TIMESTAMP_NTZ""",
}

SCHEMAS = {table: _parsed(columns) for table, columns in _TABLES.items()}

PRIMARY_KEY = "id"

UNIQUE_KEYS: dict[str, list[tuple[str, ...]]] = {
    "store": [("store_code",)],
    "sales_channel": [("channel_code",)],
    "product": [("product_code",)],
    "product_inventory": [("product_id", "store_id")],
    "sales_order": [("order_no",)],
}


@dataclass(frozen=True)
class Reference:
    """``child.column`` points at ``parent.id``; deleting the parent removes or blanks it."""

    child: str
    column: str
    parent: str
    on_delete: str  # "cascade" or "set null"


REFERENCES = [
    Reference("product", "category_id", "product_category", "cascade"),
    Reference("product", "supplier_id", "supplier", "set null"),
    Reference("product_inventory", "product_id", "product", "cascade"),
    Reference("product_inventory", "store_id", "store", "cascade"),
    Reference("user_address", "user_id", "py_user", "cascade"),
    Reference("user_behavior", "user_id", "py_user", "cascade"),
    Reference("user_behavior", "product_id", "product", "set null"),
    Reference("sales_order", "user_id", "py_user", "cascade"),
    Reference("sales_order", "store_id", "store", "set null"),
    Reference("sales_order", "address_id", "user_address", "set null"),
    Reference("sales_order", "channel_id", "sales_channel", "set null"),
    Reference("sales_order", "campaign_id", "marketing_campaign", "set null"),
    Reference("sales_detail", "order_id", "sales_order", "cascade"),
    Reference("sales_detail", "product_id", "product", "cascade"),
]


class SchemaChange(ValueError):
    """A column's new type cannot hold its old values, nor the old type the new ones."""


_WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def widened(old: T.DataType, new: T.DataType, name: str = "") -> T.DataType:
    """The narrowest type that holds all values of both, exactly.

    Whole numbers grow to longer ones, decimals in digits before and after the point, floats
    to doubles, dates to times of no zone, structs by columns (see ``merged``), lists and maps by
    their elements. Whole numbers up to 32 bits fit a double. Other changes raise ``SchemaChange``.
    """
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    kinds = (type(old), type(new))
    if all(k in _WHOLE_DIGITS for k in kinds):
        return max(old, new, key=lambda t: _WHOLE_DIGITS[type(t)])
    if all(k in _WHOLE_DIGITS or k is T.DecimalType for k in kinds):
        sides = [
            (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_WHOLE_DIGITS[type(t)], 0)
            for t in (old, new)
        ]
        before, after = (max(x) for x in zip(*sides))
        if before + after <= T.DecimalType(38, 0).precision:
            return T.DecimalType(before + after, after)
    small = {T.ByteType, T.ShortType}
    for a, b in (kinds, kinds[::-1]):
        if b is T.DoubleType and (a in small or a in (T.IntegerType, T.FloatType)):
            return T.DoubleType()
        if b is T.FloatType and (a in small or a is T.IntegerType):
            return T.FloatType() if a in small else T.DoubleType()
        if (a, b) == (T.DateType, T.TimestampNTZType):
            return T.TimestampNTZType()
    if kinds == (T.StructType, T.StructType):
        return merged(old, new, name)
    if kinds == (T.ArrayType, T.ArrayType):
        return T.ArrayType(widened(old.elementType, new.elementType, f"{name}[]"))
    if kinds == (T.MapType, T.MapType):
        return T.MapType(
            widened(old.keyType, new.keyType, f"{name} key"),
            widened(old.valueType, new.valueType, f"{name} value"),
        )
    raise SchemaChange(f"{name or 'column'}: {old.simpleString()} became {new.simpleString()}")


def merged(old: T.StructType, new: T.StructType, within: str = "") -> T.StructType:
    """All columns of both, types widened; names that differ by case alone are one column.

    New columns come last. A column that is gone stays, to be NULL from now on.
    """
    later = {f.name.lower(): f for f in new.fields}
    if len(later) < len(new.fields):
        raise SchemaChange(f"{within or 'table'}: columns whose names differ by case alone")
    prefix = f"{within}." if within else ""
    fields = []
    for f in old.fields:
        match = later.pop(f.name.lower(), None)
        kind = f.dataType if match is None else widened(f.dataType, match.dataType, prefix + f.name)
        fields.append(T.StructField(f.name, kind, True))
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in later.values()])


def fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns and types of a wider schema; columns it lacks are NULL."""
    present = {c.lower(): c for c in df.columns}

    def value(f: T.StructField) -> Column:
        name = present.get(f.name.lower())
        if name is None:
            return F.lit(None).cast(f.dataType).alias(f.name)
        old = df.schema[name].dataType
        column = F.col(f"`{name}`")
        return _as(column, old, f.dataType).alias(f.name)

    return df.select(*map(value, schema.fields))


def _as(value: Column, old: T.DataType, new: T.DataType) -> Column:
    """A value of a narrower type as one of a wider type, fields matched by name."""
    if old == new or not _has_struct(new):
        return value if old == new else value.cast(new)
    if isinstance(new, T.ArrayType):
        return F.transform(value, lambda x: _as(x, old.elementType, new.elementType))
    if isinstance(new, T.MapType):
        values = F.transform_values(value, lambda _, x: _as(x, old.valueType, new.valueType))
        return values.cast(new)
    present = {f.name.lower(): f for f in old.fields}
    fields = []
    for f in new.fields:
        match = present.get(f.name.lower())
        if match is None:
            fields.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            fields.append(_as(value.getField(match.name), match.dataType, f.dataType).alias(f.name))
    return F.when(value.isNotNull(), F.struct(*fields))


def _has_struct(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_struct(kind.elementType)
    if isinstance(kind, T.MapType):
        return _has_struct(kind.valueType)
    return isinstance(kind, T.StructType)


def required_columns(table: str) -> list[str]:
    return [f.name for f in SCHEMAS[table].fields if not f.nullable]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast ``df`` to ``schema`` and name the columns each row fails on.

    Columns missing from ``df`` become NULL. ``invalid_columns`` lists, per row, the
    columns whose text did not fit the type or whose value is missing though required;
    it is empty for a good row.
    """
    present = set(df.columns)

    def value(field: T.StructField) -> Column:
        if field.name not in present:
            return F.lit(None).cast(field.dataType)
        return F.col(field.name).try_cast(field.dataType)

    def broken(field: T.StructField) -> Column | None:
        # A column the source does not carry is not judged row by row.
        if field.name not in present:
            return None
        bad = F.col(field.name).isNotNull() & value(field).isNull()
        if not field.nullable:
            bad = bad | F.col(field.name).isNull()
        return F.when(bad, F.lit(field.name))

    checks = [c for c in map(broken, schema.fields) if c is not None]
    invalid = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    return df.select(
        *[value(f).alias(f.name) for f in schema.fields], invalid.alias("invalid_columns")
    )
