"""Column lists and schemas of the wide-map fact and of the flat fact derived from it."""

from __future__ import annotations

from pyspark.sql import types as T

# The standard columns of the fact, in table order.
STANDARD_COLUMNS = [
    "timestampMs", "customerId", "clientId", "sessionId", "inSession",
    "userSessionId", "inUserSession", "platform", "platformSubcategory",
    "appName", "appBuild", "appVersion", "browserName", "browserVersion",
    "userId", "deviceManufacturer", "deviceMarketingName", "deviceModel",
    "deviceHardwareType", "deviceName", "deviceCategory", "deviceOperatingSystem",
    "deviceOperatingSystemVersion", "deviceOperatingSystemFamily", "country",
    "state", "city", "countryIso", "sub1Iso", "sub2Iso", "cityGid", "dma",
    "postalCode", "isp", "netSpeed", "sensorVersion", "appType", "asn",
    "timezoneOffsetMins", "connType", "watermarkMs", "partitionId", "retentionDate",
]

# Standard columns that are not strings, by type.
TIMESTAMPS = ("timestampMs", "watermarkMs", "flowStartTimeMs")
LONGS = ("userSessionId", "country", "state", "city")
INTEGERS = ("customerId", "cityGid", "isp", "asn", "timezoneOffsetMins", "connType", "partitionId")
SHORTS = ("inSession", "inUserSession", "dma")
DATES = ("retentionDate",)

# Standard columns that a flat table fills with 0 or '' when a writer leaves them out.
DEFAULTED_COLUMNS = (
    "browserName", "browserVersion", "userId", "deviceManufacturer", "deviceMarketingName",
    "deviceModel", "deviceHardwareType", "deviceName", "deviceCategory", "deviceOperatingSystem",
    "deviceOperatingSystemVersion", "deviceOperatingSystemFamily", "country", "state", "city",
    "postalCode", "isp", "netSpeed", "asn", "timezoneOffsetMins", "connType",
)

# The map columns, the dimensions of a report and the default report window.
GROUPS_PER_KIND = 15
DIMENSIONS = ["deviceCategory", "countryIso", "platform"]
WINDOW_HOURS = 6

GROUP_PREFIX = {"int": "metricIntGroup", "float": "metricFloatGroup", "string": "tagGroup"}
GROUP_KEYS = ["timestampMs", "clientId", "sessionId", "customerId"]
FLOW_COLUMNS = ["flowId", "flowStartTimeMs"]


def group_columns(kind: str) -> list[str]:
    """Names of the map columns of one kind ('int', 'float' or 'string'), lowest number first."""
    return [f"{GROUP_PREFIX[kind]}{n}" for n in range(1, GROUPS_PER_KIND + 1)]


# Columns of the raw fact that the flat fact does not carry.
EXCLUDED_COLUMNS = [*FLOW_COLUMNS, *group_columns("string")]


def standard_type(name: str) -> T.DataType:
    if name in TIMESTAMPS:
        return T.TimestampNTZType()
    if name in LONGS:
        return T.LongType()
    if name in INTEGERS:
        return T.IntegerType()
    if name in SHORTS:
        return T.ShortType()
    if name in DATES:
        return T.DateType()
    return T.StringType()


def wide_schema() -> T.StructType:
    """Schema of the raw fact: standard and flow columns, then 45 map columns."""
    values = {"int": T.IntegerType(), "float": T.FloatType(), "string": T.StringType()}
    fields = [T.StructField(c, standard_type(c)) for c in [*STANDARD_COLUMNS, *FLOW_COLUMNS]]
    for kind, value in values.items():
        fields += [T.StructField(g, T.MapType(T.StringType(), value)) for g in group_columns(kind)]
    return T.StructType(fields)


def positional_columns(int_columns: int, float_columns: int, string_columns: int = 0) -> list[str]:
    return (
        [f"int{i}" for i in range(1, int_columns + 1)]
        + [f"float{i}" for i in range(1, float_columns + 1)]
        + [f"string{i}" for i in range(1, string_columns + 1)]
    )


def flat_schema(
    int_columns: int, float_columns: int = 0, string_columns: int = 0, variant: str = "v1"
) -> T.StructType:
    """Schema of the flat fact. Variant 'v2' adds the flow columns and the string columns.

    Integer sums are stored as bigint, so that a large sum cannot overflow on the write.
    """
    if variant not in ("v1", "v2"):
        raise ValueError(f"unknown flat schema variant: {variant}")
    if min(int_columns, float_columns, string_columns) < 0:
        raise ValueError("column counts must not be negative")
    if variant == "v1" and string_columns:
        raise ValueError("string columns need variant 'v2'")
    names = list(STANDARD_COLUMNS)
    if variant == "v2":
        names = [names[0], *FLOW_COLUMNS, *names[1:]]
    value_types = {"int": T.LongType(), "float": T.FloatType(), "string": T.StringType()}
    fields = [T.StructField(c, standard_type(c)) for c in names]
    for kind, count in (("int", int_columns), ("float", float_columns), ("string", string_columns)):
        fields += [T.StructField(f"{kind}{i}", value_types[kind]) for i in range(1, count + 1)]
    return T.StructType(fields)


def column_class(name: str) -> str:
    """'int', 'float' or 'string' for a positional column, else 'metadata'."""
    for kind in ("int", "float", "string"):
        if name.startswith(kind) and name[len(kind):].isdigit():
            return kind
    return "metadata"
