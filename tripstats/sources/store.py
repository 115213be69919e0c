"""The store: plain parquet folders of landed events, partials, totals and logs.

    landed/batch_id=N/source=S/outcome=O    decoded messages; rejects keep text and reason
    cubes/<kind>/batch_id=N                 the two rollups of one processed batch
    partials/batch_id=N/table=T             the eleven statistics of one processed batch
    run_log/batch_id=N                      one row; its presence commits batch N; below zero,
                                            gathered rows of folded batches
    history/upto=N/K                        what pruned batches leave: rollups and rejects of a
                                            range of batches that ends with N
    history_log/upto=N                      one row, with the ranges there are; its presence commits
                                            them, and lets the folders of batches up to N go
    totals/version=K/part=P/table=T         parts of the eleven totals that version K changed
    sides/version=K/part=P                  the same of both sides of the joined totals
    fold_log/version=K                      one row, with the version each part is of; its presence
                                            commits version K

Every folder is written by one job with a path of its own, so writing it again replaces it:
a replayed batch or fold leaves the same result. Readers only look at what a log row commits.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripstats.operators.fold import one_table, pending_counts
from tripstats.operators.gate import backlog, peek
from tripstats.operators.maintain import SIDES, joined_totals
from tripstats.operators.rollup import FLIGHT_GRAIN, HOTEL_GRAIN, reaggregate
from tripstats.plans import reports
from tripstats.schemas import RUN_LOG, WIDE_SCHEMA, stat_table

_LANDED = (
    "company_id STRING, event_timestamp TIMESTAMP, id_hotel BIGINT, valor DOUBLE, "
    "data_reservada TIMESTAMP, data_reserva TIMESTAMP, id_reserva_hotel BIGINT, id_voo BIGINT, "
    "id_reserva_voo BIGINT, reason STRING, value STRING, "
    "batch_id BIGINT, source STRING, outcome STRING"
)
_CUBES = {
    "hotel": (
        "company_id STRING, cidade STRING, estrelas INT, mes_reserva INT, sum_valor DOUBLE, "
        "num_reservas BIGINT, batch_id BIGINT"
    ),
    "flight": (
        "company_id STRING, cidade_destino STRING, na_cidade BOOLEAN, dia_reserva DATE, "
        "sum_valor DOUBLE, num_reservas BIGINT, batch_id BIGINT"
    ),
}
_PARTS_OF = "MAP<INT, BIGINT>"  # part -> version that wrote it
_FOLD_LOG = f"version BIGINT, up_to BIGINT, folded_at TIMESTAMP, totals {_PARTS_OF}, sides {_PARTS_OF}"
# Totals are in so many parts, by table and company, sides by axis and company: a fold rewrites
# the parts of the companies it has rows of.
PARTS = 64

_GRAINS = {"hotel": HOTEL_GRAIN, "flight": FLIGHT_GRAIN}
_REJECTS = "batch_id BIGINT, source STRING, reason STRING, value STRING"
_HISTORY_LOG = "last BIGINT, ranges ARRAY<STRUCT<level: INT, last: BIGINT>>, upto BIGINT"
# So many ranges of a level are gathered in one of the next: a batch's rows are rewritten once a
# level, and the ranges grow with the logarithm of the batches.
FAN = 4

USABLE, REJECTED = "usable", "rejected"


def part_of(kind: str) -> Column:
    """Part of a row by company and `kind`."""
    return F.pmod(F.xxhash64(kind, "company_id"), F.lit(PARTS)).cast("int")


def touched_parts(rows: DataFrame, kind: str) -> list[int]:
    """Parts that have one of the rows; at most PARTS."""
    return sorted(r["part"] for r in rows.select(part_of(kind).alias("part")).distinct().collect())


def _some(versions: dict[int, int], parts: Sequence[int] | None) -> dict[int, int]:
    return versions if parts is None else {p: versions[p] for p in parts if p in versions}


class Store:
    """Reads and writes of one store folder, which every executor must be able to reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _read(self, folder: str, schema: str, batches: Sequence[int] | None = None) -> DataFrame:
        """The folder with its partition columns, empty if nothing was ever written.

        `batches` names the batch folders to open, so that the others are not even listed.
        """
        base = f"{self.root}/{folder}"
        paths = [base] if batches is None else [f"{base}/batch_id={i}" for i in batches]
        try:
            return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND" or batches is not None:
                raise
            return self.spark.createDataFrame([], schema)

    def _parts(self, folder: str, schema: str, versions: dict[int, int]) -> DataFrame:
        """The given parts, each as the version that wrote it last left it."""
        base = f"{self.root}/{folder}"
        if not versions:
            return self.spark.createDataFrame([], schema)
        paths = [f"{base}/version={version}/part={part}" for part, version in sorted(versions.items())]
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)

    def _write_parts(self, frame: DataFrame, folder: str, version: int, *partitions: str) -> None:
        """One file per part and table; a task holds a few parts."""
        self._replace(frame.repartition("part"), f"{folder}/version={version}", "part", *partitions)

    def _replace(self, frame: DataFrame, folder: str, *partitions: str) -> None:
        frame.write.mode("overwrite").partitionBy(*partitions).parquet(f"{self.root}/{folder}")

    # --- landed messages ---------------------------------------------------------------------

    def land(
        self, decoded: DataFrame, batch_id: int, sources: Sequence[str] = ()
    ) -> dict[str, int]:
        """Keep the decoded messages of a batch; statistics only ever read these columns.

        Returns how many messages of each of `sources` there are, observed while they are written.
        """
        outcome = F.when(F.col("reason").isNull(), USABLE).otherwise(REJECTED)
        counts = [F.count_if(F.col("source") == s).alias(f"n{i}") for i, s in enumerate(sources)]
        seen = Observation()
        self._replace(
            decoded.withColumn("outcome", outcome).observe(seen, F.count(F.lit(1)).alias("n"), *counts),
            f"landed/batch_id={batch_id}", "source", "outcome",
        )
        found = seen.get
        return {s: found[f"n{i}"] for i, s in enumerate(sources)}

    def landed(self, batches: range | None = None) -> DataFrame:
        """Landed messages, of the given batches or of all that were not pruned."""
        if batches is not None:
            return self._read("landed", _LANDED, batches)
        return self._read("landed", _LANDED).where(F.col("batch_id") > self.history()[0])

    def waiting(self) -> DataFrame:
        """Landed messages that no committed run has processed."""
        return self.landed().where(F.col("batch_id") > self.processed_up_to())

    def rejects(self) -> DataFrame:
        """Every message set aside, with its reason; pruning keeps them."""
        last, ranges = self.history()
        rejected = self._read("landed", _LANDED).where((F.col("outcome") == REJECTED) & (F.col("batch_id") > last))
        return self._gathered("rejects", _REJECTS, ranges).unionByName(
            rejected.select("batch_id", "source", "reason", "value")
        )

    def backlog(self) -> DataFrame:
        """Messages waiting per source."""
        return backlog(self.waiting())

    def backlog_peek(self, n: int = 6) -> DataFrame:
        """The first messages waiting in each source."""
        ordered = self.waiting().withColumn("_at", F.struct("batch_id", "event_timestamp"))
        return peek(ordered, "_at", n).drop("_at")

    # --- processed batches -------------------------------------------------------------------

    def write_cube(self, kind: str, cube: DataFrame, batch_id: int) -> DataFrame:
        self._replace(cube, f"cubes/{kind}/batch_id={batch_id}")
        return self.cubes(kind, range(batch_id, batch_id + 1)).drop("batch_id")

    def cubes(self, kind: str, batches: Sequence[int] | None = None) -> DataFrame:
        """Rollups of the given batches or of all; those of pruned ones under the last of their range."""
        if batches is not None:
            return self._read(f"cubes/{kind}", _CUBES[kind], batches)
        last, ranges = self.history()
        own = self._read(f"cubes/{kind}", _CUBES[kind]).where(F.col("batch_id") > last)
        return self._gathered(kind, _CUBES[kind], ranges).unionByName(own)

    # --- pruned batches ----------------------------------------------------------------------

    def history(self) -> tuple[int, list[tuple[int, int]]]:
        """Last pruned batch and the ranges (level, last batch) that hold what is left; (-1, [])."""
        log = self._read("history_log", _HISTORY_LOG)
        row = log.agg(F.max_by(F.struct("last", "ranges"), "upto").alias("row")).first()["row"]
        return (row["last"], [tuple(r) for r in row["ranges"]]) if row else (-1, [])

    def _gathered(self, kind: str, schema: str, ranges: Sequence[tuple[int, int]]) -> DataFrame:
        """One kind of what the ranges hold; there are few of them."""
        if not ranges:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/history/upto={last}/{kind}" for _, last in ranges]
        return self.spark.read.schema(schema).parquet(*paths)

    def _gather(self, up_to: int) -> None:
        """Put rollups and rejects of the batches up to one into ranges, then drop their folders.

        Rollups add up, so a range has one row a key, however many batches it has. The folders
        go after the log row that names the ranges stands; what a stop leaves goes next time.
        """
        last, ranges = self.history()
        if up_to > last:
            level, merged = 0, []
            while sum(at == level for at, _ in ranges) >= FAN - 1:
                merged += [r for r in ranges if r[0] == level]
                ranges = [r for r in ranges if r[0] != level]
                level += 1
            ranges = [*ranges, (level, up_to)]
            here = (F.col("batch_id") > last) & (F.col("batch_id") <= up_to)
            for kind, grain in _GRAINS.items():
                new = self._read(f"cubes/{kind}", _CUBES[kind]).where(here)
                rows = self._gathered(kind, _CUBES[kind], merged).unionByName(new)
                whole = reaggregate(rows, grain).withColumn("batch_id", F.lit(up_to).cast("bigint"))
                self._replace(whole, f"history/upto={up_to}/{kind}")
            aside = self._read("landed", _LANDED).where(here & (F.col("outcome") == REJECTED))
            kept = [c.split()[0] for c in _REJECTS.split(", ")]
            rejected = self._gathered("rejects", _REJECTS, merged).unionByName(aside.select(*kept))
            self._replace(rejected, f"history/upto={up_to}/rejects")
            row = self.spark.createDataFrame([(up_to, ranges)], _HISTORY_LOG.rsplit(",", 1)[0])
            self._replace(row, f"history_log/upto={up_to}")
            last = up_to
        for folders in ("landed/batch_id", "cubes/hotel/batch_id", "cubes/flight/batch_id"):
            self._drop(folders, last)
        self._drop("history_log/upto", last - 1)
        self._drop("history/upto", last, keep={at for _, at in ranges})

    def write_partials(self, wide: DataFrame, batch_id: int) -> None:
        """All eleven partial tables in one job, so that they appear together or not at all."""
        self._replace(wide, f"partials/batch_id={batch_id}", "table")

    def wide_partials(self, batches: Sequence[int] | None = None) -> DataFrame:
        """Partials of committed batches in wide form, of the given batches or of all."""
        schema = f"{WIDE_SCHEMA}, batch_id BIGINT"
        if batches is not None:
            return self._read("partials", schema, batches)
        partials = self._read("partials", schema)
        return partials.where(F.col("batch_id") <= self.processed_up_to())

    def partials(self, name: str) -> DataFrame:
        """One partial table with batch id, insertion time and whether it has been folded."""
        table = stat_table(name)
        _, up_to = self.folded()
        rows = one_table(self.wide_partials(), table, "batch_id", "inserido_em")
        return rows.withColumn("processed", F.col("batch_id") <= up_to)

    def pending(self) -> DataFrame:
        """Partial rows per table that no fold has consumed."""
        _, up_to = self.folded()
        return pending_counts(self.wide_partials(), up_to)

    def log_run(
        self, batch_id: int, start: datetime, end: datetime, rows: dict[str, int],
        compute_seconds: float, write_seconds: float,
    ) -> None:
        """Commit a batch."""
        row = (
            batch_id, start, end, rows["hotels"], rows["flights"], compute_seconds, write_seconds
        )
        columns = RUN_LOG.rsplit(",", 1)[0]
        log = self.spark.createDataFrame([row], columns)
        self._replace(
            log.withColumn("created_at", F.current_timestamp()), f"run_log/batch_id={batch_id}"
        )

    def run_log(self) -> DataFrame:
        log = self._read("run_log", f"{RUN_LOG}, batch_id BIGINT").drop("batch_id")
        return log.dropDuplicates(["id"])  # a run is there twice while the log is compacted

    def run_log_page(self, limit: int = 100, order: str = "desc") -> DataFrame:
        return reports.run_log_page(self.run_log(), limit, order)

    def processed_up_to(self) -> int:
        """Last committed batch, -1 before the first.

        A folded batch is committed whatever became of its log row.
        """
        log = self._read("run_log", RUN_LOG)
        return max(log.agg(F.coalesce(F.max("id"), F.lit(-1))).first()[0], self.folded()[1])

    # --- totals ------------------------------------------------------------------------------

    def write_totals(
        self, wide: DataFrame | None, version: int, up_to: int, touched: Sequence[int] = (),
        sides: DataFrame | None = None, touched_sides: Sequence[int] = (),
    ) -> None:
        """Write the parts of totals and sides that a version changes, then commit it.

        `wide` and `sides` have all rows of the touched parts; without any nothing is written
        but the log.
        """
        before = self.parts_of(version - 1)
        if touched:
            self._write_parts(wide.withColumn("part", part_of("table")), "totals", version, "table")
        if touched_sides:
            self._write_parts(sides.withColumn("part", part_of("axis")), "sides", version)
        after = [
            F.create_map(*(F.lit(x) for pair in (old | dict.fromkeys(new, version)).items() for x in pair))
            for old, new in zip(before, (touched, touched_sides))
        ]
        log = self.spark.range(1).select(
            F.lit(up_to).cast("bigint").alias("up_to"), F.current_timestamp().alias("folded_at"),
            *(parts.cast(_PARTS_OF).alias(name) for name, parts in zip(("totals", "sides"), after)),
        )
        self._replace(log, f"fold_log/version={version}")

    def parts_of(self, version: int) -> tuple[dict[int, int], dict[int, int]]:
        """Which version wrote each part of the totals and of the sides of a version."""
        log = self._read("fold_log", _FOLD_LOG).where(F.col("version") == version)
        row = log.select("totals", "sides").first()
        return (row["totals"] or {}, row["sides"] or {}) if row else ({}, {})

    def folded(self) -> tuple[int, int]:
        """Version of the totals and the last batch in it; (0, -1) before the first fold."""
        log = self._read("fold_log", _FOLD_LOG)
        last = log.agg(F.max(F.struct("version", "up_to")).alias("last")).first()["last"]
        return (last["version"], last["up_to"]) if last else (0, -1)

    def prune(self, keep_versions: int = 2, keep_batches: int = 0) -> None:
        """Drop what totals have consumed: folded messages, partials and versions before the last ones.

        Landed messages and rollups of all folded batches but the last `keep_batches` numbers go;
        their rejects stay, and their rollups as sums, from which `recomputed` still gives the
        same. Also gathers the log rows of folded batches in one folder, numbered below zero, which
        stands before the folders it replaces go; a run that is there twice counts once. Nothing
        that is still to be read is touched, so it may stop anywhere, and run between any two
        folds.
        """
        version, up_to = self.folded()
        if up_to >= keep_batches:
            self._gather(up_to - keep_batches)
        single = self._read("run_log", f"{RUN_LOG}, batch_id BIGINT").where(F.col("batch_id") >= 0)
        if single.where(F.col("id") <= up_to).isEmpty():
            return
        gathered = -2 - up_to
        self._replace(
            self.run_log().where(F.col("id") <= up_to), f"run_log/batch_id={gathered}"
        )
        self._drop("run_log/batch_id", up_to, keep={gathered})
        self._drop("partials/batch_id", up_to)
        self._drop("fold_log/version", version - keep_versions)
        kept = self._read("fold_log", _FOLD_LOG).select("totals", "sides").collect()
        for folder in ("totals", "sides"):  # at most PARTS for each version kept
            used = {(v, p) for row in kept for p, v in (row[folder] or {}).items()}
            self._drop_parts(folder, version, used)

    def _drop_parts(self, folder: str, version: int, used: set[tuple[int, int]]) -> None:
        """Delete the parts up to a version that no kept version uses."""
        jvm = self.spark._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}/version=*/part=*")
        files = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration())
        still, gone = {v for v, _ in used}, set()
        for status in files.globStatus(pattern) or []:
            path = status.getPath()
            number = int(path.getParent().getName().split("=")[1])
            part = int(path.getName().split("=")[1])
            if number <= version and (number, part) not in used:
                files.delete(path, True)
                gone.add(number)
        for number in gone - still:
            files.delete(jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}/version={number}"), True)

    def _drop(self, folders: str, up_to: int, keep: Collection[int] = ()) -> None:
        """Delete the numbered folders `folders`=..up_to that are there, all but `keep`."""
        jvm = self.spark._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folders}=*")
        files = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for status in files.globStatus(pattern) or []:
            number = int(status.getPath().getName().split("=")[1])
            if number <= up_to and number not in keep:
                files.delete(status.getPath(), True)

    def wide_totals(self, version: int | None = None, parts: Sequence[int] | None = None) -> DataFrame:
        """Totals of the latest or a given version in wide form, whole or in some parts."""
        versions = self.parts_of(self.folded()[0] if version is None else version)[0]
        return self._parts("totals", WIDE_SCHEMA, _some(versions, parts))

    def sides(self, version: int | None = None, parts: Sequence[int] | None = None) -> DataFrame:
        """Both sides of the joined totals, whole or in some parts."""
        versions = self.parts_of(self.folded()[0] if version is None else version)[1]
        return self._parts("sides", SIDES, _some(versions, parts))

    def joined(self, name: str, company: str | None = None) -> DataFrame:
        """Total revenue or ticket inputs as if all folded messages had come in one batch."""
        table = stat_table(name)
        by_name = dict(zip(("stats_faturamentos_totais", "stats_ticket_medio"), joined_totals(self.sides())))
        rows = by_name[table.name].select(*table.columns)
        return rows if company is None else reports.of_company(rows, company)

    def stat(self, name: str, company: str | None = None) -> DataFrame:
        """One total table, by full or short name, of all companies or of one."""
        rows = one_table(self.wide_totals(), stat_table(name))
        return rows if company is None else reports.of_company(rows, company)

    def clients(self) -> DataFrame:
        """Companies with hotel or flight revenue."""
        return reports.clients(self.stat("month_hotel"), self.stat("month_voos"))
