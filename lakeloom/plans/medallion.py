"""The lake: raw files to bronze, silver, dimensions, snapshot and gold, as catalog tables."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators import dims, gold, incremental, numbering, quality, scd2, silver
from lakeloom.schemas import FLIGHT_RAW
from lakeloom.sources import ingest, layout, tables
from lakeloom.sources.ledger import alone
from lakeloom.sources.staging import by_slices, file_system, remove, scope, spent, stage

SNAPSHOT_KEY = "aircraft_id"
SNAPSHOT_CHECKS = ["airport", *dims.PROFILE_COLUMNS]

# Digits kept of each reading in the snapshot's means, so that an unchanged aircraft compares equal.
SNAPSHOT_SCALE = 10

# How the files of the whole flights are compressed; half of a silver row is the hex text of its id.
PACKED = {"compression": "zstd"}

# Flights are aggregated in slices by key, each of so many MB of the silver table, at most so many.
SLICE_MB, MOST_SLICES = 512, 8

# Logical name to table, for code that names its sources.
SOURCES = {"raw_flight": "flight_raw", "stage_flight": "flight"}


@dataclass(frozen=True)
class Lake:
    """Tables of one database with their data under one root folder."""

    spark: SparkSession
    root: str
    database: str = "warehouse"
    #: Buckets of the open versions of a snapshot; a table keeps those that it began with.
    buckets: int = 16

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def create(self) -> None:
        """The database, with its managed tables under the root as well."""
        home = self.path("warehouse", self.database)
        quoted = home.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"create database if not exists {self.database} location '{quoted}'")

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def table(self, table: str) -> DataFrame:
        return tables.read(self.spark, self.name(table))

    def source(self, name: str) -> DataFrame:
        return self.table(SOURCES[name])

    def ingest(self, csv_path: str, header: bool = False, set_aside: bool = False) -> None:
        """Raw CSV to bronze; replaces what is there.

        The splits of the scan become the files, joined to the size wanted but never to fewer than there
        are cores to read them. Where the scan has fewer splits than its size asks for, as over
        compressed files, which cannot be split, the rows are dealt out evenly.

        Lines with too few or too many fields are filled up or cut off; with ``set_aside`` they go whole
        to ``flight_rejected`` instead, with why.
        """
        raw = ingest.read_raw_csv(self.spark, csv_path, FLIGHT_RAW, header)
        if set_aside:
            lines = ingest.read_raw_csv(self.spark, csv_path, FLIGHT_RAW, header, line="_line")
            rejected = ingest.bad_lines(lines, "_line")
            tables.write_overwrite(layout.balanced(rejected), self.name("flight_rejected"), self.path("bronze", "rejected"))
            raw = ingest.good_lines(lines, "_line")
        wanted = layout.partitions_for(layout.estimated_bytes(raw))
        splits = raw.rdd.getNumPartitions()
        width = min(splits, self.spark.sparkContext.defaultParallelism)
        sized = layout.sized_repartition(raw, floor=max(3, width), shuffle=splits < wanted)
        tables.write_overwrite(sized, self.name("flight_raw"), self.path("bronze", "flight"), **PACKED)

    def refine(self, batch_id: str) -> None:
        """Bronze to silver as one batch; running a batch again replaces it."""
        with scope(self.spark), spent(self.spark):
            typed = silver.conform(silver.dedupe_stored(self.source("raw_flight")))
            tables.write_append(
                typed, self.name("flight"), self.path("silver", "stage_flight"), batch_id=batch_id, **PACKED
            )

    def flights(self) -> DataFrame:
        return self.source("stage_flight").drop("batch_id")

    def _by_slices(self, flights: DataFrame, keys: list[str], label: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``make(flights)`` in slices by ``keys``, as many as the silver table's size asks for."""
        silver_path = self.path("silver", "stage_flight")
        files, where = file_system(self.spark, silver_path)
        size = layout.stored_bytes(self.spark, silver_path) if files.exists(where) else 0
        return by_slices(flights, keys, min(MOST_SLICES, layout.partitions_for(size, SLICE_MB, 1)), label, make)

    def build_airports(self) -> None:
        with scope(self.spark), spent(self.spark):
            tables.write_overwrite(dims.dim_airport(self.flights()), self.name("dim_airport"))

    def build_aircraft(self) -> None:
        airports, keys = self.table("dim_airport"), ["aircraft_id", "airplane_model"]
        with scope(self.spark), spent(self.spark):
            static = self._by_slices(
                self.flights(), keys, "aircraft", lambda part: dims.dim_aircraft_static(part, airports, number=False)
            )
            tables.write_overwrite(layout.balanced(numbering.dense_id(static, *keys)), self.name("dim_aircraft"))

    def load_passengers(self, batch_id: str | None = None) -> None:
        """Append the passengers whose key is not there yet, of all flights or of one batch, of
        which then only the partition is read."""
        flights = self.source("stage_flight")
        if batch_id is not None:
            flights = flights.where(F.col("batch_id") == batch_id)
        with scope(self.spark), spent(self.spark):
            batch = self._by_slices(flights.drop("batch_id"), dims.PASSENGER_KEY, "passengers", dims.dim_passenger)
            if self.exists("dim_passenger"):
                batch = incremental.new_rows(self.table("dim_passenger"), batch, "passenger_key")
            tables.write_append(
                batch, self.name("dim_passenger"), self.path("gold", "dim_passenger")
            )

    def _published(self) -> dict[str, str]:
        """What the view of the snapshots shows: its last moment and the folder of open versions."""
        if not self.exists("scd_dim_aircraft"):
            return {}
        shown = self.spark.sql(f"show tblproperties {self.name('scd_dim_aircraft')}").collect()
        return {row["key"]: row["value"] for row in shown if row["key"] in ("moment", "open_versions", "buckets")}

    def _open_table(self, number: int) -> str:
        return self.name(f"scd_dim_aircraft_open_{number}")

    def snapshot_aircraft(
        self, as_of: datetime | str, prefix: str = "dbt_", check: bool = True, flights: DataFrame | None = None
    ) -> None:
        """Take the aircraft profiles at ``as_of`` into the versioned dimension.

        ``as_of`` must be later than the last snapshot. With ``check`` a NULL in an open version or
        one just closed, but for the open end, is an error and nothing is published; older versions
        passed when they were written. ``flights`` stands for all of the silver table if given.

        ``scd_dim_aircraft`` is a view over a table of open versions, a new one for each run, and
        the closed ones of the moments published so far, which only grow. Replacing the view is the
        one step that publishes a run: before it readers see the last run, and what a run that broke
        off has written is not seen and is removed by the next one. The last two tables of open
        versions stay for readers. Open versions lie in buckets by their key, and a run moves its
        source only. One snapshot runs at a time; another fails with
        :class:`lakeloom.sources.ledger.Taken` and shows nothing.
        """
        with alone(self.spark, f"{self.path('gold', 'scd_dim_aircraft')}/_running", {"as_of": str(as_of)}):
            self._take_snapshot(as_of, prefix, check, flights)

    def _take_snapshot(self, as_of: datetime | str, prefix: str, check: bool, flights: DataFrame | None) -> None:
        published = self._published()
        moment = self.spark.range(1).select(
            F.date_format(scd2.moment_of(as_of), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("m")
        ).first()["m"]
        if moment is None:
            raise ValueError(f"no moment: {as_of}")
        if published and moment <= published["moment"]:
            raise ValueError(f"a snapshot at {moment} must be later than the last, {published['moment']}")

        home, closed = self.path("gold", "scd_dim_aircraft"), self.path("gold", "scd_dim_aircraft_closed")
        number = int(published["open_versions"].rsplit("-", 1)[1]) + 1 if published else 1
        present = self.spark.table(self._open_table(number - 1)) if published else None
        buckets = int(published.get("buckets", self.buckets))
        source = self.flights() if flights is None else flights
        with scope(self.spark), spent(self.spark):
            profile = self._by_slices(
                source, [SNAPSHOT_KEY], "profile", lambda part: dims.dim_aircraft_profile(part, SNAPSHOT_SCALE, one_pass=False)
            )
            versions = stage(
                scd2.advance(present, profile, SNAPSHOT_KEY, SNAPSHOT_CHECKS, as_of, prefix=prefix, buckets=buckets),
                "scd-dim-aircraft",
            )
            valid_to = scd2.version_columns(prefix)[-1]
            if check:
                quality.assert_not_null(versions, [valid_to])
            opened = f"{home}/v-{number}"
            for left in (opened, f"{closed}/run={number}"):
                remove(self.spark, left)
            self.spark.sql(f"drop table if exists {self._open_table(number)}")
            versions.where(f"{valid_to} is not null").write.parquet(f"{closed}/run={number}")
            scd2.store_open(versions.where(f"{valid_to} is null"), self._open_table(number), opened, SNAPSHOT_KEY, buckets)
            columns = ", ".join(versions.columns)
        quoted = closed.replace("`", "``")
        self.spark.sql(
            f"create or replace view {self.name('scd_dim_aircraft')} "
            f"tblproperties ('moment' = '{moment}', 'buckets' = '{buckets}', "
            f"'open_versions' = {tables.sql_text(opened)}) as "
            f"select {columns} from {self._open_table(number)} "
            f"union all select {columns} from parquet.`{quoted}` where run <= {number}"
        )
        if number > 2:
            self.spark.sql(f"drop table if exists {self._open_table(number - 2)}")
            remove(self.spark, f"{home}/v-{number - 2}")

    def top_cost(self, k: int = 5, exclude: str | None = "economy") -> DataFrame:
        # The dearest of all are among the dearest of their slice.
        found = self._by_slices(self.flights(), ["aircraft_id"], "top-cost", lambda part: gold.top_cost(part, k, exclude))
        return gold.dearest_first(found).limit(k)


def main() -> None:
    """Run one load: ``spark-submit medallion.py --root <folder> --csv <file> --batch <id>``."""
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("--root", required=True)
    parser.add_argument("--csv", required=True)
    parser.add_argument("--batch", required=True)
    parser.add_argument("--as-of", required=True, help="yyyy-MM-dd HH:mm:ss")
    parser.add_argument("--database", default="warehouse")
    args = parser.parse_args()

    lake = Lake(SparkSession.builder.getOrCreate(), args.root, args.database)
    lake.create()
    lake.ingest(args.csv)
    lake.refine(args.batch)
    lake.build_airports()
    lake.build_aircraft()
    lake.load_passengers()
    lake.snapshot_aircraft(args.as_of)
    lake.top_cost().show()


if __name__ == "__main__":
    main()
