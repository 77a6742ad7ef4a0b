"""Layer tables of one input folder, computed once per session and kept as Parquet.

Reports that need several layers read these tables instead of repeating the joins and the
deduplication behind them.  Tables live in the shared folder named by ``spark.checkpoint.dir``;
a table is used only after its write has been committed, so a lost executor costs a retry and
nothing else.  If a cluster names no folder, the layers stay lazy plans.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import bindings, schemas as S
from tripmart.operators.dedupe import dedupe_by_key
from tripmart.plans import bronze, gold, marts, silver
from tripmart.session import in_steps, shared_folder
from tripmart.sources.readers import read_csv
from tripmart.sources.scope import Scope
from tripmart.sources.writers import write_table

# Daily tables are small; only trips gain from month folders here.
BY_MONTH = {n: S.PARTITIONS[n] for n in ("silver_trips", "fact_trips")}
LANDED = "*.csv.gz"  # files of ``Layers.landing``

_RUN = uuid.uuid4().hex
_LOCK = threading.RLock()
_WRITTEN: dict[str, str] = {}


def run_root(spark: SparkSession) -> str | None:
    root = shared_folder(spark)
    return root and f"{root}/tripmart/{spark.conf.get('spark.app.id')}-{_RUN}"


def fingerprint(spark: SparkSession, folder: str, names: list[str]) -> str:
    """Identifies the current files of the inputs by path, time and length; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load([f"{folder}/{n}.parquet" for n in names])
    )
    state = files.agg(
        F.count("*").alias("files"),
        F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)")).alias("mix"),
    ).first()
    return f"{state.files}-{int(state.mix)}"


class Layers:
    """Every layer of ``folder`` by name; ``table`` returns stored data, the methods plans.

    Tables are kept under ``storage``, by default a folder of this application below the shared one.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        scope: Scope = bindings.DEFAULT_SCOPE,
        storage: str | None = None,
    ):
        self.spark = spark
        self.folder = folder
        self.scope = scope
        self.storage = storage
        self._root: str | None = None

    # -- lazy plans --------------------------------------------------------------------------

    def trips_raw(self) -> DataFrame:
        return bindings.trips_raw(self.spark, self.folder)

    def weather_raw(self) -> DataFrame:
        return bindings.weather_raw(self.spark, self.folder)

    def zones_raw(self) -> DataFrame:
        return bindings.zones_raw(self.spark, self.folder)

    def plan(self, name: str) -> DataFrame:
        """The layer as one plan over the inputs, nothing stored in between."""
        scope = self.scope
        if name == "bronze_trips":
            return bronze.bronze_trips(self.trips_raw())
        if name == "bronze_weather":
            return bronze.bronze_weather(self.weather_raw())
        if name == "bronze_zones":
            return bronze.bronze_zones(self.zones_raw())
        if name == "silver_trips":
            return silver.silver_trips(self.plan("bronze_trips"), scope)
        if name == "silver_weather":
            return silver.silver_weather(self.plan("bronze_weather"))
        if name == "silver_zones":
            return silver.silver_zones(self.plan("bronze_zones"))
        if name == "dim_date":
            raw = bindings.trips_raw(self.spark, self.folder, lineage=False)
            return gold.dim_date(silver.clean_trips(bronze.bronze_trips(raw), scope))
        if name == "dim_zone":
            return gold.dim_zone(self.plan("silver_zones"))
        if name == "dim_weather":
            return gold.dim_weather(self.plan("silver_weather"))
        if name == "fact_trips":
            raw = bindings.trips_raw(self.spark, self.folder, lineage=False)
            trips = silver.silver_trips(bronze.bronze_trips(raw), scope, lineage=False)
            return gold.fact_trips(trips, self.plan("silver_weather"), scope)
        fact = self.plan("fact_trips")
        if name == "mart_daily_demand":
            return marts.mart_daily_demand(fact)
        if name == "mart_daily_payment_mix":
            return marts.mart_daily_payment_mix(fact)
        if name == "mart_weather_impact":
            weather = self.plan("dim_weather").filter(scope.has_day(F.col("weather_date")))
            return marts.mart_weather_impact(fact, weather, row_bound=scope.days)
        if name == "mart_zone_demand":
            return marts.mart_zone_demand(fact, self.plan("dim_zone"))
        raise KeyError(name)

    # -- stored tables -----------------------------------------------------------------------

    def _from_stored(self, name: str) -> DataFrame:
        """The layer computed from the stored layer before it."""
        t = self.table
        if name == "dim_date":
            return gold.dim_date(t("silver_trips"))
        if name == "dim_zone":
            return gold.dim_zone(t("silver_zones"))
        if name == "dim_weather":
            return gold.dim_weather(t("silver_weather"))
        if name == "fact_trips":
            return gold.fact_trips(t("silver_trips"), t("dim_weather"), self.scope)
        if name == "mart_daily_demand":
            return marts.mart_daily_demand(t("fact_trips"), t("dim_date"), self.scope.days)
        if name == "mart_daily_payment_mix":
            return marts.mart_daily_payment_mix(t("fact_trips"))
        if name == "mart_weather_impact":
            weather = t("dim_weather").filter(self.scope.has_day(F.col("weather_date")))
            return marts.mart_weather_impact(
                t("fact_trips"), weather, t("dim_date"), self.scope.days
            )
        if name == "mart_zone_demand":
            return marts.mart_zone_demand(t("fact_trips"), t("dim_zone"))
        return self.plan(name)

    def root(self) -> str | None:
        """Folder of this input state and scope, None where nothing may be stored."""
        base = self.storage or run_root(self.spark)
        if base is None:
            return None
        if self._root is None:
            state = fingerprint(self.spark, self.folder, bindings.INPUTS)
            self._root = f"{base}/{state}/{self.scope.first}_{self.scope.last}"
        return self._root

    def table(self, name: str) -> DataFrame:
        """A layer table.  Bronze adds no shuffle to what it reads and stays a plan.

        So does the fact: it is stored silver with a broadcast date, and a copy of it would move and
        write all trips once more.
        """
        if name.startswith("bronze_") or name == "fact_trips" or self.root() is None:
            return self._from_stored(name)
        path = self.stored_path(name)
        contract = S.CONTRACTS[name]
        return self.spark.read.schema(contract.ddl).parquet(path).select(*contract.names)

    def stored_path(self, name: str) -> str:
        """Where a layer is stored, after making sure that it is."""

        def write(path: str) -> None:
            if name == "silver_trips":
                self._write_silver(path)
            else:
                write_table(self._from_stored(name), path, BY_MONTH.get(name, ()), rebalance=False)

        return self.written(name, write)

    def _write_silver(self, path: str) -> None:
        """Silver trips in two steps, so that what is shuffled to make trips is gone when they are deduplicated.

        Clean trips lie in a scratch folder between the steps, which is emptied afterwards. Trips are dealt by
        month once, for silver, whose files the fact is made from.
        """
        clean = self.scratch("clean")

        def stored_then_unique(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
            df.write.option("compression", "zstd").parquet(clean)
            return dedupe_by_key(self.spark.read.schema(df.schema).parquet(clean), keys, order)

        raw = bindings.trips_raw(self.spark, self.folder, few_suppliers=True)
        rows = silver.silver_trips(
            bronze.bronze_trips(raw), self.scope, unique_rows=stored_then_unique, spread=True
        )
        write_table(rows, path, BY_MONTH["silver_trips"], rebalance=False)
        self.spark.createDataFrame([], "line string").write.mode("overwrite").text(clean)

    def written(self, name: str, write) -> str:
        """Run ``write(path)`` once per input state; later calls only return the path."""
        path = f"{self.root() or self._no_folder()}/{name}"
        with _LOCK:
            if path not in _WRITTEN:
                with in_steps(self.spark):
                    write(path)
                _WRITTEN[path] = path
        return path

    def scratch(self, name: str) -> str:
        """A fresh shared folder for a sink to write to."""
        return f"{self.root() or self._no_folder()}/scratch/{name}-{uuid.uuid4().hex}"

    def landing(self, name: str) -> str:
        """Raw text files of an input, as the source system would deliver them, packed.

        Trips are dealt by month before their values become text, which takes more room.
        """

        def write(path: str) -> None:
            if name == "trips":
                month = F.date_format("tpep_pickup_datetime", "yyyy-MM")
                raw = bindings.trips_raw(self.spark, self.folder, lineage=False).drop("source_file")
                dealt = raw.withColumn("month", month).hint("rebalance", "month")
                writer = bindings.as_text(dealt, S.TRIPS_RAW.names).write.partitionBy("month")
            else:
                df = self.weather_raw() if name == "weather" else self.zones_raw()
                writer = df.drop("source_file").write.option(
                    "ignoreLeadingWhiteSpace", False
                ).option("ignoreTrailingWhiteSpace", False)
            writer.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)

        return self.written(f"landing_{name}", write)

    def landed(self, name: str) -> DataFrame:
        """Every landing file of an input, untyped."""
        return read_csv(self.spark, self.landing(name), pattern=LANDED, label=name)

    @staticmethod
    def _no_folder():
        raise ValueError("spark.checkpoint.dir must name a shared folder for queries that write")
