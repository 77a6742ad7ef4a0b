"""Raw to bronze: canonical columns, types, lineage; rows without a usable key are dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions import parsing
from tripmart.operators.columns import ensure_columns
from tripmart.operators.dedupe import dedupe_by_key
from tripmart.schemas import Contract
from tripmart.sources.readers import bronze_ready


def _standard(raw: DataFrame, contract: Contract) -> DataFrame:
    """Contract columns typed (text trimmed) next to the source file, in one projection."""
    df = ensure_columns(bronze_ready(raw), [*contract.names, "source_file"])
    values = [
        f"trim(`{f.name}`)" if f.type == "string" else parsing.typed_sql(df, f.name, f.type)
        for f in contract
    ]
    return df.selectExpr(
        *[f"{v} AS `{n}`" for v, n in zip(values, contract.names, strict=True)],
        "source_file",
        "current_timestamp() AS bronze_loaded_at",
    )


def bronze_trips(raw: DataFrame) -> DataFrame:
    day = F.to_date("tpep_pickup_datetime")
    return (
        _standard(raw, S.TRIPS_RAW)
        .withColumns({"pickup_date": day, "pickup_year": F.year(day), "pickup_month": F.month(day)})
        .filter(F.col("pickup_date").isNotNull())
        .select(*S.BRONZE_TRIPS.names)
    )


def bronze_weather(raw: DataFrame) -> DataFrame:
    return (
        _standard(raw, S.WEATHER_RAW)
        .withColumns({"weather_year": F.year("date"), "weather_month": F.month("date")})
        .filter(F.col("date").isNotNull())
        .select(*S.BRONZE_WEATHER.names)
    )


def bronze_zones(raw: DataFrame) -> DataFrame:
    """One row per (id, three texts); ids that are null are removed before the exchange."""
    typed = _standard(raw.withColumnsRenamed(S.ZONE_RENAMES), S.ZONES_RAW)
    keyed = typed.filter(F.col("location_id").isNotNull())
    return dedupe_by_key(keyed, S.ZONES_RAW.names, ["source_file"]).select(*S.BRONZE_ZONES.names)
