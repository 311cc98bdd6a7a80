"""Where staged tables and checkpoints live."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints. Only a local session may go without one, and
    then gets a folder of its own; on a cluster a machine-local folder would lose data."""
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="fundweave-")
    return _LOCAL[app]


_LOCAL: dict[str, str] = {}


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, name: str = "step", staged: list[str] | None = None, **options: str) -> DataFrame:
    """Writes `df` to the shared folder and reads it back: lineage is cut, and losing an executor
    costs a re-read of files instead of a recomputation. The path is added to `staged` for callers
    that can tell when nobody reads it any more; other steps stay until the folder is cleaned.
    `options` are the writer's."""
    path = new_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    if staged is not None:
        staged.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_ONCE: dict[tuple[str, str], tuple[str, DataFrame]] = {}


def once(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stored result of `build()`, built at its first use in a session or when its files are gone.
    For inputs that do not change while the session lasts."""
    key = (spark.sparkContext.applicationId, f"{shared_folder(spark)} {name}")
    if key not in _ONCE or not exists(spark, f"{_ONCE[key][0]}/_SUCCESS"):
        paths: list[str] = []
        frame = cut(build(), "once", paths)
        _ONCE[key] = (paths[0], frame)
    return _ONCE[key][1]


def discard(spark: SparkSession, staged: list[str]) -> None:
    """Deletes steps whose result has been written elsewhere."""
    while staged:
        place, store = _store(spark, staged.pop())
        store.delete(place, True)


def _store(spark: SparkSession, path: str):
    """A path and the store it lies in."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, store = _store(spark, path)
    return store.exists(place)


def files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, bytes) of the data files under a path."""
    place, store = _store(spark, path)
    found, out = store.listFiles(place, True), []
    while found.hasNext():
        f = found.next()
        if not f.getPath().getName().startswith(("_", ".")):
            out.append((f.getPath().getName(), f.getLen()))
    return out


def claim(spark: SparkSession, path: str) -> bool:
    """Creates a marker file; False if somebody has. The store's own create-if-absent decides."""
    place, store = _store(spark, path)
    return store.createNewFile(place)
