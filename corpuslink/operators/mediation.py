"""Two sources brought to one schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import alnum_only, normalize_key, strip_dot_zero, to_number
from .keyed import keep_keys

# The mediated vehicle schema and the two source mappings.
VEHICLE_SCHEMA = ["vin", "make", "model", "year", "price", "mileage", "fuel",
                  "transmission", "state", "region", "description"]
LISTING_MAPPING = {
    "VIN": "vin", "manufacturer": "make", "model": "model", "year": "year",
    "price": "price", "odometer": "mileage", "fuel": "fuel",
    "transmission": "transmission", "state": "state", "region": "region",
    "description": "description"}
DEALER_MAPPING = {
    "vin": "vin", "make_name": "make", "model_name": "model", "year": "year",
    "price": "price", "mileage": "mileage", "fuel_type": "fuel",
    "transmission": "transmission", "description": "description"}


def source_column(mapping: Mapping[str, str], target: str) -> str:
    return next(k for k, v in mapping.items() if v == target)


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def drop_unknown(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value does not contain "unknown" in any case."""
    return df.where(~F.contains(F.lower(F.col(column).cast("string")), F.lit("unknown")))


def drop_key(df: DataFrame, key: str = "vin") -> DataFrame:
    """Remove the key that would give matches away."""
    return df.drop(key)


def read_matching(source: DataFrame, keys: DataFrame | None, mapping: Mapping[str, str]) -> DataFrame:
    """Rows with a known make and year, key normalised, kept when in `keys`."""
    vin, make, year = (source_column(mapping, t) for t in ("vin", "make", "year"))
    df = source.withColumn(vin, normalize_key(F.col(vin).cast("string")))
    df = drop_unknown(drop_missing(df, [make, year]), make)
    return df.where(F.col(vin).isNotNull()) if keys is None else keep_keys(df, vin, keys)


def align_to_schema(df: DataFrame, mapping: Mapping[str, str],
                    schema: Sequence[str] = VEHICLE_SCHEMA,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Rename, fill missing columns and nulls with "", clean make, model, year
    and price, and add `price_num`."""
    by_target = {t: s for s, t in mapping.items() if s in df.columns}

    def text(target: str):
        source = by_target.get(target, target)
        if source not in df.columns:
            return F.lit("")
        return F.coalesce(F.col(source).cast("string"), F.lit(""))

    clean = {"make": alnum_only, "model": alnum_only,
             "year": strip_dot_zero, "price": strip_dot_zero}
    out = df.select(*keep, *[clean.get(c, lambda x: x)(text(c)).alias(c) for c in schema])
    return out.withColumn("price_num", to_number(F.col("price"))) if "price" in schema else out
