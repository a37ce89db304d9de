"""Raw API payloads (JSON text) -> flat, typed rows.

The payload table has one JSON document per row; parsing, exploding and
projection are built-in expressions, so each payload is handled by whichever
task holds it and no document passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rivulet.functions.clean import parse_double, to_number

# --- fixed values: shapes of the public API payloads ----------------------
COUNTRY_SCHEMA = (
    "array<struct<name:struct<common:string,official:string>,capital:array<string>,"
    "region:string,subregion:string,cca2:string,cca3:string,population:string,area:double,"
    "languages:map<string,string>,currencies:map<string,struct<name:string>>>>"
)
OBSERVATION_SCHEMA = (
    "array<struct<indicator:struct<id:string,value:string>,"
    "country:struct<id:string,value:string>,date:string,value:string>>"
)
RATES_SCHEMA = "struct<base:string,date:string,rates:map<string,double>>"
# Currencies kept from a rate payload, in output column order.
RATE_CURRENCIES = ("USD", "EUR", "ZAR", "NGN", "KES", "EGP")
# ---------------------------------------------------------------------------


def join_map_values(m: Column, sep: str = ", ") -> Column:
    """Map values joined in document order; null when the map is empty or missing."""
    return F.when(F.size(m) > 0, F.array_join(F.map_values(m), sep))


def join_map_keys(m: Column, sep: str = ", ") -> Column:
    return F.when(F.size(m) > 0, F.array_join(F.map_keys(m), sep))


def join_map_field(m: Column, field: str, sep: str = ", ") -> Column:
    """A field of each struct value of a map, joined (missing fields skipped)."""
    return F.when(F.size(m) > 0,
                  F.array_join(F.transform(F.map_values(m), lambda v: v.getField(field)), sep))


def first_or_null(arr: Column) -> Column:
    """First array element, null for an empty or missing array."""
    return F.get(arr, 0)


def _split(parsed: DataFrame, reason: Column, drop: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(payloads without a reason, the others with their columns and ``reject_reason``)."""
    tagged = parsed.withColumn("reject_reason", reason)
    return (tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.filter(F.col("reject_reason").isNotNull()).drop(*drop))


def split_countries(payloads: DataFrame, payload_col: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Countries payloads (JSON array of country objects) -> (flat country rows, rejected payloads).

    Rejected, whole and with a ``reject_reason``: a missing payload, JSON that
    is malformed or cut off, no array (an error object), an element that is
    null, and a field of another type than the API's.  A population may be
    any number.
    """
    schema = f"struct<list:{COUNTRY_SCHEMA},_bad:string>"
    wrapped = F.concat(F.lit('{"list":'), F.col(payload_col), F.lit("}"))
    parsed = payloads.withColumn("_p", F.from_json(wrapped, schema, {"columnNameOfCorruptRecord": "_bad"}))
    reason = (F.when(F.col(payload_col).isNull(), "missing payload")
               .when(F.col("_p._bad").isNotNull(), "malformed or of another shape")
               .when(F.col("_p.list").isNull(), "no list")
               .when(F.exists("_p.list", lambda x: x.isNull()), "null element"))
    good, bad = _split(parsed, reason, ["_p"])
    c = F.col("c")
    return good.select(F.explode("_p.list").alias("c")).select(
        c["name"]["common"].alias("name"),
        c["name"]["official"].alias("official_name"),
        c["region"].alias("region"),
        c["subregion"].alias("subregion"),
        to_number(c["population"], "long").alias("population"),
        c["area"].alias("area"),
        first_or_null(c["capital"]).alias("capital"),
        join_map_values(c["languages"]).alias("languages"),
        join_map_field(c["currencies"], "name").alias("currencies"),
        join_map_keys(c["currencies"]).alias("currency_codes"),
        c["cca2"].alias("iso2"),
        c["cca3"].alias("iso3"),
    ), bad


def flatten_countries(payloads: DataFrame, payload_col: str = "payload") -> DataFrame:
    """One flat row per country of the good payloads (see :func:`split_countries`)."""
    return split_countries(payloads, payload_col)[0]


def split_observations(pages: DataFrame, payload_col: str = "payload",
                       observation: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """Two-part pages ``[metadata, [observation, ...]]`` -> (population records, rejected pages).

    A page is parsed once, into a variant, and its observations are read out
    of that.  Rejected: a missing or malformed page, and one whose second part
    is no list of observations (an error page) or holds a value that is no
    number.  Observations with a null
    value are dropped; a year that is not an integer becomes null.  With an
    ``Observation``, the first action over the records also reports
    ``observations``, ``dropped_null_value`` and ``bad_year`` counts.
    """
    parsed = (pages.withColumn("_v", F.try_parse_json(F.col(payload_col)))
              .withColumn("_rows", F.try_variant_get("_v", "$[1]", OBSERVATION_SCHEMA)))
    reason = (F.when(F.col(payload_col).isNull(), "missing payload").when(F.col("_v").isNull(), "malformed")
               .when(F.col("_rows").isNull(), "no list of observations")
               .when(F.exists("_rows", lambda r: r["value"].isNotNull() & parse_double(r["value"]).isNull()), "a value that is no number"))
    good, bad = _split(parsed, reason, ["_v", "_rows"])
    o = F.col("o")
    exploded = good.select(F.explode("_rows").alias("o"))
    if observation is not None:
        exploded = exploded.observe(
            observation, F.count(F.lit(1)).alias("observations"),
            F.count_if(o["value"].isNull()).alias("dropped_null_value"),
            F.count_if(o["value"].isNotNull() & o["date"].try_cast("int").isNull()).alias("bad_year"))
    return exploded.filter(o["value"].isNotNull()).select(
        o["indicator"]["id"].alias("indicator_id"),
        o["country"]["id"].alias("country_iso2"),
        o["country"]["value"].alias("country_name"),
        o["date"].try_cast("int").alias("year"),
        parse_double(o["value"]).alias("population"),
    ), bad


def flatten_observations(pages: DataFrame, payload_col: str = "payload",
                         observation: Observation | None = None) -> DataFrame:
    """Population records of the good pages (see :func:`split_observations`)."""
    return split_observations(pages, payload_col, observation)[0]


def split_rates(payloads: DataFrame, payload_col: str = "payload", currencies: Sequence[str] = RATE_CURRENCIES,
                base: str = "GBP") -> tuple[DataFrame, DataFrame]:
    """Rate payloads -> (one wide row each: whitelisted currencies, base, date; rejected payloads).

    Rejected: a missing or malformed payload, a rate that is no number, and an
    empty or missing rate map.
    """
    schema = RATES_SCHEMA[:-1] + ",_bad:string>"
    parsed = payloads.withColumn("_p", F.from_json(F.col(payload_col), schema, {"columnNameOfCorruptRecord": "_bad"}))
    reason = (F.when(F.col(payload_col).isNull(), "missing payload")
               .when(F.col("_p._bad").isNotNull(), "malformed or of another shape")
               .when(F.coalesce(F.size("_p.rates"), F.lit(0)) <= 0, "no rates"))
    good, bad = _split(parsed, reason, ["_p"])
    wanted = F.array(*[F.lit(c) for c in currencies])
    kept = F.map_filter("_p.rates", lambda k, v: F.array_contains(wanted, k))
    return good.select("_p", kept.alias("r")).select(
        *[F.col("r").getItem(c).alias(c) for c in currencies], F.lit(base).alias("base"), F.col("_p.date").alias("date")), bad


def flatten_rates(payloads: DataFrame, payload_col: str = "payload",
                  currencies: Sequence[str] = RATE_CURRENCIES, base: str = "GBP") -> DataFrame:
    """One wide row per good rate payload (see :func:`split_rates`)."""
    return split_rates(payloads, payload_col, currencies, base)[0]


def json_field(col: str | Column, path: str, dtype: str | None = None) -> Column:
    """One field of a JSON text column; optional try_cast to ``dtype``."""
    c = F.col(col) if isinstance(col, str) else col
    v = F.get_json_object(c, path)
    return v if dtype is None else v.try_cast(dtype)
