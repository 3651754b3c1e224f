"""Session settings the library is tuned for, and a place to cut lineage."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Settings that matter for the joins here: runtime re-planning with skew splitting,
#: broadcast decided by measured size only, and UTC dates.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyworks")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session, such as a cluster's."""
    for key, value in SETTINGS.items():
        if key.startswith("spark.sql.adaptive."):
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str | None:
    """The cluster's shared checkpoint folder; where none is set, a scratch folder in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None and spark.sparkContext.master.startswith("local"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyworks-"))
    return spark.sparkContext.getCheckpointDir()


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Used where one costly intermediate feeds several branches. A written table survives
    lost executors, keeps column pruning and filter pushdown for its readers, and gives
    the optimizer real sizes for its broadcast decisions. On a cluster that names no
    shared folder the branches recompute instead.
    """
    spark = df.sparkSession
    folder = shared_dir(spark)
    if folder is None:
        return df
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Workspace:
    """The stored tables of one run in a folder of its own.

    A table is made when it is first asked for. Once its write is complete it is entered in the folder's
    manifest, with its schema; a run that starts again with the same folder reads what the manifest has and makes the rest.
    The folder belongs to one set of inputs and arguments, and all executors must see it.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _path(self, name: str):
        """Hadoop's file system and path of a name in the folder, so that any store that Spark writes to will do."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

    def complete(self) -> list[str]:
        """Names of the tables that are whole."""
        fs, path = self._path("_manifest")
        return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        fs, entry = self._path(f"_manifest/{name}")
        if not fs.exists(entry):
            df = make()
            df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
            out = fs.create(entry, True)
            out.write(bytearray(df.schema.json().encode()))
            out.close()
        lines = self.spark.read.text(f"{self.folder}/_manifest/{name}", wholetext=True)
        schema = StructType.fromJson(json.loads(lines.first()[0]))
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def clear(self) -> None:
        """Delete the tables of the manifest, entries first, and the manifest if nothing is left in it."""
        for name in self.complete():
            for part in (f"_manifest/{name}", name):
                fs, path = self._path(part)
                fs.delete(path, True)
        fs, path = self._path("_manifest")
        if fs.exists(path) and not fs.listStatus(path):
            fs.delete(path, True)


class LazyTables(Mapping):
    """Named tables, each built when it is first asked for, so that one doesn't cost the others' work."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers = dict(makers)
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)
