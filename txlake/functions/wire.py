"""Contract check of JSON wire records, as one array of messages per row.

Types are read from a VARIANT, since a typed struct cannot tell ``10`` from
``true`` or ``"10"``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.constants import CHANNELS, COUNTRIES, CURRENCIES, MERCHANT_CATEGORIES, WIRE_FIELDS
from txlake.functions.rules import without_nulls

VOCABULARIES = {
    "currency": CURRENCIES,
    "merchant_category": MERCHANT_CATEGORIES,
    "country": COUNTRIES,
    "channel": CHANNELS,
}

# Fixed patterns: the calendar and week forms of an ISO 8601 date-time.
_TIME = r"([01]\d|2[0-3])(:?[0-5]\d(:?[0-5]\d([.,]\d+)?)?)?"
_ZONE = r"(Z|[+-]([01]\d|2[0-3])(:?[0-5]\d(:?[0-5]\d(\.\d+)?)?)?)?"
_REST = "(." + _TIME + _ZONE + ")?$"
_EXTENDED = r"^\d{4}-\d{2}-\d{2}" + _REST
_BASIC = r"^\d{8}" + _REST
_WEEK = r"^\d{4}-?W\d{2}(-?[1-7])?" + _REST
_NUMBER = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)"


def is_iso8601(text: Column) -> Column:
    """Whether a text is an ISO 8601 date-time, offsets optional.

    The pattern fixes the layout; a cast then refuses days no month has.
    """

    def piece(start: int, length: int) -> Column:
        return F.substring(text, start, length)

    def is_day(shown: Column) -> Column:
        return shown.try_cast("date").isNotNull()

    week = F.regexp_extract(text, r"W(\d{2})", 1).try_cast("int")
    last_week = F.weekofyear(F.concat(piece(1, 4), F.lit("-12-28")).try_cast("date"))
    known = (
        F.when(text.rlike(_EXTENDED), is_day(piece(1, 10)))
        .when(text.rlike(_BASIC), is_day(F.concat_ws("-", piece(1, 4), piece(5, 2), piece(7, 2))))
        .when(text.rlike(_WEEK), week.between(1, last_week))
    )
    return F.coalesce(known & (text >= "0001"), F.lit(False))


def _float_text(number: Column) -> Column:
    """A double as the contract's messages print it: an exponent below 1e-4 and from 1e16 on."""
    text = number.cast("string")
    plain = F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), r"(\.\d+?)0+$", "$1")
    short = F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), r"E(\d)", "E+$1")
    scientific = F.regexp_replace(F.regexp_replace(short, r"E([+-])(\d)$", "E$10$2"), "E", "e")
    size = F.abs(number)
    return F.when((size >= 1e-4) & (size < 1e16), plain).when(text.contains("E"), scientific).otherwise(text)


def _record(value: str) -> Column:
    """The record as a VARIANT; of a repeated key the last value counts.

    A VARIANT refuses repeated keys. Reading fields by name takes the last one of each, so
    such a record, whose keys can be listed, is read that way and written out again.
    """
    by_name = F.from_json(value, ", ".join(f"{f} VARIANT" for f in WIRE_FIELDS))
    again = F.when(F.json_object_keys(value).isNotNull(), F.try_parse_json(F.to_json(by_name)))
    return F.coalesce(F.try_parse_json(F.col(value)), again)


def with_wire_errors(df: DataFrame, value: str = "value", output: str = "errors") -> DataFrame:
    """Add the contract violations of a JSON text column, in contract order; empty when valid.

    The text is read twice, for its values and for its keys. Then each field's kind and text
    are taken once, in projections of their own, so the messages below only compare columns.
    """
    parsed = df.withColumns(
        {
            "_record": _record(value),
            "_keys": F.array_distinct(F.json_object_keys(F.col(value))),
        }
    )
    cells = parsed.withColumn("_shape", F.schema_of_variant("_record"))
    cells = cells.withColumns(
        {f"_v_{f}": F.try_variant_get("_record", f"$.{f}", "variant") for f in WIRE_FIELDS}
    )
    facts = {f"_k_{f}": F.schema_of_variant(f"_v_{f}") for f in WIRE_FIELDS}
    facts |= {f"_t_{f}": F.try_variant_get(f"_v_{f}", "$", "string") for f in WIRE_FIELDS}
    facts |= {
        "_amount": F.try_variant_get("_v_amount", "$", "double"),
        "_extra": F.array_except("_keys", F.array(*[F.lit(f) for f in WIRE_FIELDS])),
    }
    facts |= {f"_p_{f}": F.array_contains("_keys", f) for f in WIRE_FIELDS}
    return cells.withColumns(facts).select(*df.columns, _messages().alias(output))


def _messages() -> Column:
    """Fixed texts: the contract's messages, in its order."""

    def kind_of(field: str) -> Column:
        return F.col(f"_k_{field}")

    def text_of(field: str) -> Column:
        return F.col(f"_t_{field}")

    def present(field: str) -> Column:
        return F.col(f"_p_{field}")

    def is_text(field: str) -> Column:
        return F.coalesce(kind_of(field) == "STRING", F.lit(False))

    def shown(field: str) -> Column:
        text, kind = text_of(field), kind_of(field)
        quote = F.when(text.contains("'") & ~text.contains('"'), '"').otherwise("'")
        number = F.try_variant_get(f"_v_{field}", "$", "double")
        return (
            F.when(kind == "STRING", F.concat(quote, text, quote))
            .when(kind == "VOID", "None")
            .when(kind == "BOOLEAN", F.initcap(text))
            .when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), _float_text(number))
            .otherwise(F.coalesce(text, F.to_json(f"_v_{field}")))
        )

    missing = F.concat_ws(", ", *[F.when(~present(f), F.lit(f)) for f in WIRE_FIELDS])
    extra = F.array_join(F.array_sort("_extra"), ", ")
    checks = [
        F.when(F.length(missing) > 0, F.concat(F.lit("missing fields: "), missing)),
        F.when(F.size("_extra") > 0, F.concat(F.lit("unexpected fields: "), extra)),
    ]
    for field in ("transaction_id", "account_id", "device_id"):
        filled = is_text(field) & (F.length(text_of(field)) > 0)
        checks.append(
            F.when(present(field) & ~filled, F.lit(f"{field} must be a non-empty string"))
        )
    dated = is_text("timestamp") & is_iso8601(text_of("timestamp"))
    checks.append(
        F.when(present("timestamp") & ~dated, F.lit("timestamp must be an ISO-8601 string"))
    )
    number = F.coalesce(kind_of("amount").rlike(_NUMBER), F.lit(False))
    amount = F.col("_amount")
    printed = F.when(kind_of("amount") == "BIGINT", text_of("amount")).otherwise(
        _float_text(amount)
    )
    checks.append(
        F.when(present("amount") & ~number, F.lit("amount must be a number")).when(
            present("amount") & (amount <= 0), F.concat(F.lit("amount must be > 0, got "), printed)
        )
    )
    for field, words in VOCABULARIES.items():
        listed = "(" + ", ".join(f"'{w}'" for w in words) + ")"
        known = is_text(field) & text_of(field).isin(*words)
        checks.append(
            F.when(
                present(field) & ~known,
                F.concat(F.lit(f"{field} must be one of {listed}, got "), shown(field)),
            )
        )
    is_flag = F.coalesce(kind_of("is_fraud_label") == "BOOLEAN", F.lit(False))
    checks.append(
        F.when(present("is_fraud_label") & ~is_flag, F.lit("is_fraud_label must be a boolean"))
    )
    shape = F.col("_shape")
    # Fixed names: how the contract's messages call the JSON kinds.
    kind_name = (
        F.when(shape.startswith("ARRAY"), "list")
        .when(shape == "STRING", "str")
        .when(shape == "BIGINT", "int")
        .when(shape == "BOOLEAN", "bool")
        .when(shape == "VOID", "NoneType")
        .otherwise("float")
    )
    return (
        F.when(shape.isNull(), F.array(F.lit("record must be a dict, got invalid JSON")))
        .when(
            ~shape.startswith("OBJECT"),
            F.array(F.concat(F.lit("record must be a dict, got "), kind_name)),
        )
        .otherwise(without_nulls(checks))
    )
