"""Stored intermediate tables, joins with a measured side, and connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripstats.session import shared_folder

# A side is broadcast only if its file, written before, is at most this large.
BROADCAST_BYTES = 16 * 1024 * 1024
# With this setting Spark deletes the shuffle files of a query when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class Stored:
    """A frame written once to the shared folder and read back: lineage ends at its files.

    Lost executors cost nothing but the tasks that ran on them. The files go when the table is
    dropped, at the latest when the driver ends.
    """

    def __init__(self, frame: DataFrame, release: bool = False):
        """The shuffle files that led to the table go with the query that writes it.

        Otherwise Spark deletes them when the driver's garbage collector finds them unused, which
        may be long after they filled the executors' disks. `release` runs it, for what other
        queries left.
        """
        spark = frame.sparkSession
        self.path = f"{shared_folder(spark)}/tripstats-{uuid.uuid4().hex}"
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._files.deleteOnExit(self._path)
        before = spark.conf.get(CLEANUP, None)
        spark.conf.set(CLEANUP, "true")
        try:
            frame.write.parquet(self.path, compression="zstd")
        finally:
            if before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)
        if release:
            jvm.System.gc()
        self.frame = spark.read.schema(frame.schema).parquet(self.path)

    def bytes(self) -> int:
        return self._files.getContentSummary(self._path).getLength()

    def drop(self) -> None:
        self._files.delete(self._path, True)


def beside(large: DataFrame, side: Stored, keys: list[str], how: str) -> DataFrame:
    """Join with a stored side: broadcast if its files are small, otherwise shuffled."""
    frame = F.broadcast(side.frame) if side.bytes() <= BROADCAST_BYTES else side.frame
    return large.join(frame, keys, how)


# Tables of at most so many bytes are handled by FEW_TASKS tasks.
SMALL_BYTES = 4 * 1024 * 1024
FEW_TASKS = 8


def components(links: DataFrame) -> DataFrame:
    """Component (its smallest node) of every linked node, from the links `a`, `b`.

    Alternating large-star and small-star. Hubs are handled by an aggregate with map-side
    combination and a join that Spark splits when one key is hot; no group is gathered. Where
    the written edges are small, the minima are broadcast to them, and a few tasks do it all.
    """
    current = Stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    stamp = None
    while True:
        row = current.frame.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if row == stamp or not row[0]:
            roots = current.frame.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return current.frame.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
        stamp, previous, edges = row, current, current.frame
        small = previous.bytes() <= SMALL_BYTES
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))

        def beside_minima(stars: DataFrame, lowest: DataFrame, small: bool = small) -> DataFrame:
            return stars.join(F.broadcast(lowest) if small else lowest, "u")

        def few(frame: DataFrame, small: bool = small) -> DataFrame:
            return frame.coalesce(FEW_TASKS) if small else frame

        lowest = few(both.groupBy("u").agg(F.min("v").alias("m"))).select("u", F.least("u", "m").alias("m"))
        large = beside_minima(both, lowest).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lowest = few(large.groupBy("u").agg(F.min("v").alias("m")))
        stars = beside_minima(large, lowest).where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        current = Stored(few(stars.union(lowest.select("u", "m")).where("a <> b").distinct()))
        previous.drop()


# Buckets choose their hub by one of so many orders of the nodes.
ORDERS = 2
# Rounds at least; they settle buckets of up to one more node than that.
ROUNDS = 3


def prefix_pairs(tokens: DataFrame, percent: int) -> DataFrame:
    """Pairs `a`, `b` of nodes of different components that may reach a Jaccard similarity.

    `tokens` has `node`, `component` and the distinct tokens of each node, one per row. Two sets
    that are similar enough share one of their rarest tokens: of n, the first
    n - ceil(percent * n / 100) + 1, and what follows the first one they share is long enough for
    the rest. No similar pair is left out, and copies that differ in more words than that do not
    meet, however many there are.
    """
    tokens = Stored(tokens)
    seen = tokens.frame.groupBy("token").agg(
        F.count("*").alias("df"), F.min("component").alias("x"), F.max("component").alias("y")
    )
    by_node = Window.partitionBy("node")
    rarest = (
        tokens.frame.join(seen, "token")
        .withColumn("n", F.count("*").over(by_node))
        .withColumn("rank", F.row_number().over(by_node.orderBy("df", "token")))
        .where(F.col("rank") <= F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1)
        .where("x < y").select("token", "node", "component", "n", "rank")
    )
    rarest = Stored(rarest).frame
    tokens.drop()
    return (
        rarest.toDF("token", "a", "ca", "na", "ra").join(rarest.toDF("token", "b", "cb", "nb", "rb"), "token")
        .where("a > b AND ca <> cb")
        .where(
            F.lit(100 + percent) * (F.least(F.col("na") - F.col("ra"), F.col("nb") - F.col("rb")) + 1)
            >= F.lit(percent) * (F.col("na") + F.col("nb"))
        )
        .select("a", "b").distinct()
    )


def linked_in_buckets(members: DataFrame, confirmed, tokens_of, percent: int) -> DataFrame:
    """Links between the nodes of each bucket, as many as fix the components.

    `members` has `bucket`, `node`; `confirmed` keeps the pairs `a`, `b` that are links;
    `tokens_of` gives `node`, `token` for a stored table of `node`. In each round every node is
    tried against one hub of its bucket that lies in another component; hubs differ by round
    and, in a few orders, by bucket. A hub leaves its bucket: it is linked with all others there
    or was tried against them. That settles small buckets, and groups of copies of any size with
    a few pairs per member. When a later round no longer links a tenth of the nodes it tried, nodes
    that still lie in a bucket with other components are compared by their rarest tokens. No
    pair that could join two components is left out.
    """
    shared = Stored(
        members.join(
            members.groupBy("bucket").agg(F.min("node").alias("x"), F.max("node").alias("y"))
            .where("x < y").select("bucket"),
            "bucket", "left_semi",
        ).withColumn("component", F.col("node"))
    )
    links: DataFrame | None = None
    turn = 0
    while True:
        order = F.xxhash64("node", F.pmod("bucket", F.lit(ORDERS)) + F.lit(ORDERS * turn))
        hubs = (
            shared.frame.groupBy("bucket")
            .agg(F.min_by(F.struct("node", "component"), order).alias("hub"), F.min("component").alias("x"), F.max("component").alias("y"))
            .where("x < y").select("bucket", "hub")
        )
        tried = Stored(
            shared.frame.join(hubs, "bucket").where("component <> hub.component")
            .select(F.greatest("node", "hub.node").alias("a"), F.least("node", "hub.node").alias("b")).distinct()
        )
        found = Stored(confirmed(tried.frame))
        n, gained = tried.frame.count(), found.frame.count()
        rest = shared.frame.join(hubs, "bucket").where("node <> hub.node").select("bucket", "node", "component")
        if gained:
            links = found.frame if links is None else links.union(found.frame)
            of = components(links)
            rest = (
                rest.drop("component").join(of, "node", "left")
                .select("bucket", "node", F.coalesce("component", "node").alias("component"))
            )
        following = Stored(rest)
        shared.drop()
        shared = following
        tried.drop()
        turn += 1
        if not n or (turn >= ROUNDS and 10 * gained < n):
            break
    left = Stored(
        shared.frame.join(
            shared.frame.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"))
            .where("x < y").select("bucket"),
            "bucket", "left_semi",
        ).select("node", "component").distinct()
    )
    shared.drop()
    nodes = Stored(left.frame.select("node"))
    rest = Stored(confirmed(prefix_pairs(tokens_of(nodes).join(left.frame, "node"), percent))).frame
    return rest if links is None else links.union(rest)
