"""The canonical record: coercion and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import patterns as P

CANONICAL = (
    T.StructType()
    .add("id", "string")
    .add("text", "string")
    .add("source", "string")
    .add("language", "string")
    .add("domain", "string")
    .add("token_count", "long")
    .add("quality_score", "double")
    .add("dedup_signature", "string")
    .add("safety_flags", T.ArrayType(T.StringType()))
    .add("filtered", "boolean")
    .add("filter_reason", "string")
    .add("metadata", T.MapType(T.StringType(), T.StringType()))
)

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)


EMPTY_MAP = "cast(map() AS map<string,string>)"


def sql_list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def one_of(x: str, allowed: list[str], fallback: str = "unknown") -> str:
    return f"CASE WHEN {x} IN ({sql_list(allowed)}) THEN {x} ELSE '{fallback}' END"


def with_metadata_defaults(metadata: str) -> str:
    """Fill in the default keys; keys that are present win."""
    given = f"coalesce({metadata}, {EMPTY_MAP})"
    defaults = ", ".join(f"'{k}', '{v}'" for k, v in P.METADATA_DEFAULTS.items())
    return f"map_concat(map_filter(map({defaults}), (k, v) -> NOT map_contains_key({given}, k)), {given})"


def normalize_records(df: DataFrame) -> DataFrame:
    """Bring any frame to the canonical columns; missing ones get their default, extra ones stay."""
    types = {f.name: f.dataType for f in df.schema}

    def given(name: str, kind: str) -> str:
        return f"cast({name if name in types else 'NULL'} AS {kind})"

    def text_field(name: str, default: str = "") -> str:
        return f"coalesce(nullif({given(name, 'string')}, ''), '{default}')"

    def number(name: str, kind: str) -> str:
        # An empty string is a missing number; any other unreadable string is an error in ANSI mode.
        is_text = isinstance(types.get(name), T.StringType)
        return f"coalesce(cast({f"nullif({name}, '')" if is_text else given(name, kind)} AS {kind}), cast(0 AS {kind}))"

    if isinstance(types.get("safety_flags"), T.StringType):
        flags = "CASE WHEN coalesce(safety_flags, '') <> '' THEN array(safety_flags) END"
    else:
        flags = given("safety_flags", "array<string>")
    # Any non-empty string counts as true.
    is_text = isinstance(types.get("filtered"), T.StringType)
    filtered = "filtered <> ''" if is_text else given("filtered", "boolean")

    columns = {
        "id": text_field("id"),
        "text": text_field("text"),
        "source": one_of(text_field("source", "unknown"), P.VALID_SOURCES),
        "language": one_of(text_field("language", "unknown"), P.VALID_LANGUAGES),
        "domain": text_field("domain", "unknown"),
        "token_count": number("token_count", "bigint"),
        "quality_score": number("quality_score", "double"),
        "dedup_signature": text_field("dedup_signature"),
        "safety_flags": f"coalesce({flags}, cast(array() AS array<string>))",
        "filtered": f"coalesce({filtered}, false)",
        "filter_reason": text_field("filter_reason"),
        "metadata": with_metadata_defaults(given("metadata", "map<string,string>")),
    }
    extra = [f"`{c}`" for c in df.columns if c not in columns]
    return df.selectExpr(*extra, *[f"{x} AS {n}" for n, x in columns.items()])


def validate_records(df: DataFrame) -> DataFrame:
    """Add ``valid`` and ``invalid_field`` (the first field that breaks the canonical schema, else '')."""
    types = {f.name: f.dataType for f in df.schema}
    missing = [name for name in CANONICAL.names if name not in types]
    if missing:
        return df.select("*", F.lit(False).alias("valid"), F.lit(missing[0]).alias("invalid_field"))

    def typed(name: str, *kinds: type) -> Column:
        return F.col(name).isNotNull() if isinstance(types[name], kinds) else F.lit(False)

    def known(name: str, allowed: list[str]) -> Column:
        return F.coalesce(F.col(name).cast("string").isin(allowed), F.lit(False))

    checks = {
        "id": typed("id", T.StringType),
        "text": typed("text", T.StringType),
        "source": known("source", [*P.VALID_SOURCES, "unknown"]),
        "language": known("language", P.VALID_LANGUAGES),
        "token_count": typed("token_count", *_INTEGERS),
        "quality_score": typed("quality_score", *_INTEGERS, T.FloatType, T.DoubleType),
        "safety_flags": typed("safety_flags", T.ArrayType),
        "filtered": typed("filtered", T.BooleanType),
        "metadata": typed("metadata", T.MapType, T.StructType),
    }
    first_bad = F.coalesce(*[F.when(~ok, F.lit(name)) for name, ok in checks.items()], F.lit(""))
    return df.withColumn("invalid_field", first_bad).withColumn("valid", F.col("invalid_field") == "")
