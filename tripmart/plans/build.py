"""Build and check a stored warehouse, all of it or only some months.

Each step reads the stored layer before it, and each table changes in one commit, so a run that dies
anywhere leaves whole tables and its repetition gives the same ones.  A run reads, writes and checks its
scope and months only: what an earlier run stored for other months is neither read nor rewritten.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.operators.aggregates import stacked
from tripmart.operators.dedupe import dedupe_few_copies
from tripmart.plans import bronze, checks, gold, marts, silver
from tripmart.sources.scope import Scope, in_months, month_list
from tripmart.sources.tables import VersionedTable, month_partitions
from tripmart.sources.writers import export_flat

SILVER = ["silver_trips", "silver_weather", "silver_zones"]
MARTS = ["mart_daily_demand", "mart_daily_payment_mix", "mart_weather_impact", "mart_zone_demand"]


class Warehouse:
    """Layer tables under ``root``.

    ``months`` restricts a step to those month partitions: trips, fact and marts of other months
    stay as they are, and a requested month that has no rows any more is emptied.  Trips, fact and
    marts of months outside ``scope`` stay as they are too.
    """

    def __init__(self, spark: SparkSession, root: str, scope: Scope, months: str | Iterable[str] = ()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.scope = scope
        self.months = month_list(months)
        self._raw: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name.split('_')[0]}/{name}"

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path(name), S.PARTITIONS.get(name, ()))

    def read(self, name: str) -> DataFrame:
        contract = S.CONTRACTS[name]
        return self.table(name).read(contract.ddl).select(*contract.names)

    def _rows(self, name: str) -> int | None:
        """This run's rows of a table by its commit; None where they are not whole partitions."""
        by = S.PARTITIONS.get(name, [])
        if by != ["pickup_year", "pickup_month"]:
            return self.table(name).rows()
        if not self.scope.whole_months:
            return None
        months = self.scope.months
        wanted = [m for m in months if m in self.months] if self.months else months
        return self.table(name).rows(month_partitions(wanted, by))

    def _in_months(self, df: DataFrame) -> DataFrame:
        """Only the months of this run; prunes the folders of a partitioned table."""
        if not self.months:
            return df
        return df.filter(in_months(F.col("pickup_year"), F.col("pickup_month"), self.months))

    def _this_run(self, df: DataFrame) -> DataFrame:
        """Only scope and months of this run; the month test prunes folders."""
        parts = F.col("pickup_year"), F.col("pickup_month")
        inside = self.scope.has_month(*parts) & self.scope.has_day(F.col("pickup_date"))
        return self._in_months(df.filter(inside))

    def trips(self, name: str) -> DataFrame:
        """This run's rows of silver trips, fact or a mart."""
        return self._this_run(self.read(name))

    def days(self) -> DataFrame:
        """This run's days; at most as many as the scope has."""
        return self._run_days(self.read("dim_date"))

    def _run_days(self, days: DataFrame) -> DataFrame:
        inside = days.filter(self.scope.has_day(F.col("date_day")))
        if not self.months:
            return inside
        return inside.filter(in_months(F.col("year_num"), F.col("month_num"), self.months))

    def weather(self) -> DataFrame:
        return self.read("dim_weather").filter(self.scope.has_day(F.col("weather_date")))

    def _found(self, *names: str) -> dict[str, dict[str, dict[str, str]]]:
        """Columns that the stored files really have, by folder."""
        return {n: checks.stored_schemas(self.spark, self.table(n).folders()) for n in names}

    def _column_faults(self, found: dict[str, dict[str, dict[str, str]]]) -> DataFrame | None:
        """Report of files with other columns than agreed; they cannot be read, so it stands alone."""
        reports = [
            checks.columns_suite(self.spark, name, folders)
            for name, folders in found.items()
            if checks.any_differences(folders, name)
        ]
        return stacked(reports) if reports else None

    def _raw_run(self, raw: DataFrame) -> DataFrame:
        """Raw trips of the run's months; on typed times a range that a scan can skip by."""
        time = "tpep_pickup_datetime"
        if not self.months:
            return raw
        moment = F.col(time)
        if dict(raw.dtypes).get(time) == "string":
            moment = moment.try_cast("timestamp_ntz")
        return raw.filter(Scope.covering(self.months).has_time(moment))

    def _save(self, name: str, df: DataFrame) -> None:
        by = S.PARTITIONS.get(name, [])
        if self.months and by == ["pickup_year", "pickup_month"]:
            wanted = df.filter(in_months(*map(F.col, by), self.months))
            self.table(name).replace_partitions(wanted, month_partitions(self.months, by))
        elif by:
            self.table(name).replace_partitions(df)
        else:
            self.table(name).replace(df)

    # -- steps -------------------------------------------------------------------------------

    def to_bronze(self, trips: DataFrame, weather: DataFrame, zones: DataFrame) -> None:
        """The inputs are kept for the row counts that the check takes.

        Rows counted while they pass may count twice after a lost executor, so they are counted on
        their own: from footers for Parquet, by a second scan for text.
        """
        self._raw = {"trips": self._raw_run(trips), "weather": weather, "zones": zones}
        self._save("bronze_trips", self._in_months(bronze.bronze_trips(self._raw["trips"])))
        self._save("bronze_weather", bronze.bronze_weather(weather))
        self._save("bronze_zones", bronze.bronze_zones(zones))

    def to_silver(self) -> None:
        trips = self._in_months(self.read("bronze_trips"))
        self._save(
            "silver_trips", silver.silver_trips(trips, self.scope, unique_rows=dedupe_few_copies)
        )
        self._save("silver_weather", silver.silver_weather(self.read("bronze_weather")))
        self._save("silver_zones", silver.silver_zones(self.read("bronze_zones")))

    def to_gold(self) -> None:
        """Dimensions first; the fact then joins the stored weather dimension."""
        trips = self.trips("silver_trips")
        self._save_days(gold.dim_date(trips))
        self._save("dim_zone", gold.dim_zone(self.read("silver_zones")))
        self._save("dim_weather", gold.dim_weather(self.read("silver_weather")))
        self._save("fact_trips", gold.fact_trips(trips, self.weather(), self.scope))

    def _save_days(self, days: DataFrame) -> None:
        """Days of other runs stay; this run's are replaced.

        The table is made from its last version; readers see that one until the new one is committed.
        """
        table = self.table("dim_date")
        if table.current() is not None:
            stored = self.read("dim_date")
            others = stored.join(self._run_days(stored).select("date_day"), "date_day", "left_anti")
            others = others.join(days.select("date_day"), "date_day", "left_anti")
            days = others.select(*days.columns).unionByName(days)
        table.replace(days.coalesce(1))

    def to_serving(self) -> None:
        fact, days, weather = self.trips("fact_trips"), self.days(), self.weather()
        zones = self.read("dim_zone")
        bound = self.scope.days
        self._save("mart_daily_demand", marts.mart_daily_demand(fact, days, bound))
        self._save("mart_daily_payment_mix", marts.mart_daily_payment_mix(fact))
        self._save("mart_weather_impact", marts.mart_weather_impact(fact, weather, days, bound))
        self._save("mart_zone_demand", marts.mart_zone_demand(fact, zones))

    def export(self, root: str) -> DataFrame:
        """Flat copies of the marts for a warehouse load, one reconciliation row each."""
        parts = []
        for name in MARTS:
            target = f"{root.rstrip('/')}/{name}"
            row = export_flat(
                self.read(name), target, S.CONTRACTS[name], S.EXPORT_FILES[name], self.table(name).rows()
            )
            parts.append(
                row.select(
                    F.lit(name).alias("dataset"),
                    F.lit("exported_rows_differ").alias("check_name"),
                    F.lit(checks.ERROR).alias("severity"),
                    "violations",
                )
            )
        return stacked(parts)

    # -- checks ------------------------------------------------------------------------------

    def check_bronze(self) -> DataFrame:
        """Contracts, and rows against the raw inputs of this run; only trips may lose rows."""
        parts = []
        found = self._found("bronze_trips", "bronze_weather", "bronze_zones")
        if faults := self._column_faults(found):
            return faults
        for kind in ("trips", "weather", "zones"):
            name = f"bronze_{kind}"
            stored = self.read(name)
            if kind == "trips":
                stored = self._in_months(stored)
            parts.append(checks.contract_suite(stored, name, found[name]))
            if kind in self._raw:
                rows = stored if kind == "trips" else self._rows(name)
                parts.append(checks.rowcount_relation(self._raw[kind], rows, name, kind == "trips"))
        return stacked([*parts, self._folders("bronze_trips"), self._folders("bronze_weather")])

    def check_silver(self) -> DataFrame:
        found = self._found(*SILVER)
        if faults := self._column_faults(found):
            return faults
        parts = [
            checks.silver_suite(
                self.trips("silver_trips"), self._this_run(self.read("bronze_trips")),
                found["silver_trips"], self._rows("bronze_trips"), self._rows("silver_trips"),
            ),
            self._folders("silver_trips"),
            self._folders("silver_weather"),
        ]
        for kind in ("weather", "zones"):
            name = f"silver_{kind}"
            parts.append(checks.contract_suite(self.read(name), name, found[name]))
            parts.append(checks.rowcount_relation(self._rows(f"bronze_{kind}"), self._rows(name), name, spark=self.spark))
        return stacked(parts)

    def check_gold(self) -> DataFrame:
        r = self.read
        found = self._found("fact_trips", "dim_date", "dim_zone", "dim_weather")
        if faults := self._column_faults(found):
            return faults
        suite = checks.gold_suite(
            self.trips("fact_trips"), self.trips("silver_trips"), self.days(), r("dim_zone"),
            r("dim_weather"), found,
        )
        exact = [
            checks.rowcount_exact(self._rows(source), self._rows(target), target, spark=self.spark)
            for source, target in (("silver_zones", "dim_zone"), ("silver_weather", "dim_weather"))
        ]
        return stacked([suite, *exact, self._folders("fact_trips")])

    def check_serving(self) -> DataFrame:
        found = self._found(*MARTS)
        if faults := self._column_faults(found):
            return faults
        suite = checks.serving_suite(
            {n: self.trips(n) for n in MARTS}, self.trips("fact_trips"), self.days(),
            self.read("dim_zone"), self.read("dim_weather"), found,
        )
        return stacked([suite, *[self._folders(n) for n in MARTS]])

    def _folders(self, name: str) -> DataFrame:
        stored = self.table(name).read()
        if "pickup_year" in S.PARTITIONS[name]:
            stored = self._in_months(stored)
        return checks.partition_coverage(stored, name, S.PARTITIONS[name])

    # -- everything --------------------------------------------------------------------------

    def run(self, trips: DataFrame, weather: DataFrame, zones: DataFrame) -> list[str]:
        """Raw to marts; a failed check stops before the next layer.  Returns the warnings."""
        warnings = []
        self.to_bronze(trips, weather, zones)
        warnings += checks.enforce(self.check_bronze())
        self.to_silver()
        warnings += checks.enforce(self.check_silver())
        self.to_gold()
        warnings += checks.enforce(self.check_gold())
        self.to_serving()
        warnings += checks.enforce(self.check_serving())
        return warnings
