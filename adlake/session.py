"""Session helpers: building a session for tests/bench, scoped settings, scratch space.

Scratch tables always live under the shared folder the cluster names in
``spark.checkpoint.dir``; a folder of our own is only chosen when that setting
is unset (local tests), never a machine-local temp dir on a cluster.
"""
from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[int, str] = {}
_SCRATCH: dict[str, list[str]] = {}
_KEPT: dict[str, dict[tuple, str]] = {}


def build_session(master: str = "local[8]", app: str = "adlake", *, shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench (UI always off)."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               # small splits are not packed back into one task (the 4 MiB default
               # exceeds whole tables at test scale; large inputs are unaffected)
               .config("spark.sql.files.openCostInBytes", str(1024 * 1024))
               .config("spark.driver.memory", "8g"))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        value = spark.conf.get(key, None)
    except Exception:  # noqa: BLE001 - some keys are not SQL settings
        value = None
    if value is None:
        try:
            value = spark.sparkContext.getConf().get(key, None)
        except Exception:  # noqa: BLE001 - no SparkContext (e.g. Connect)
            value = None
    return value


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, choosing one only when it is unset."""
    value = _conf(spark, "spark.checkpoint.dir")
    if value:
        try:
            spark.sparkContext.setCheckpointDir(value)
        except Exception:  # noqa: BLE001
            pass
        return value
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    key = id(spark.sparkContext)
    if key not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[key] = tempfile.mkdtemp(prefix="adlake-checkpoints-")
        spark.sparkContext.setCheckpointDir(_LOCAL_SCRATCH[key])
    return _LOCAL_SCRATCH[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the shared scratch folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/adlake/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared scratch folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_table(spark: SparkSession, key: tuple, build: Callable[[], str]) -> str:
    """The path that ``build`` gave for ``key`` in this application, built again after a release."""
    kept = _KEPT.setdefault(spark.sparkContext.applicationId, {})
    if key not in kept:
        path = build()  # which may keep others
        kept = _KEPT.setdefault(spark.sparkContext.applicationId, {})
        kept[key] = path
    return kept[key]


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables of this application, whose DataFrames can't be read after it;
    tables kept for later use are built anew when they are next asked for. Returns how many there
    were. For use between jobs of a long session."""
    _KEPT.pop(spark.sparkContext.applicationId, None)
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)


def delete_scratch(spark: SparkSession, path: str) -> None:
    """Delete one scratch table of this application before the others."""
    paths = _SCRATCH.get(spark.sparkContext.applicationId, [])
    if path in paths:
        paths.remove(path)
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def conf_scope(spark: SparkSession, settings: dict[str, str]):
    """Apply SQL settings for the duration of a block, then restore them."""
    previous = {}
    for key, value in settings.items():
        previous[key] = _conf(spark, key)
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in previous.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def settings(spark: SparkSession, keys) -> dict[str, str | None]:
    """Effective value of each setting; unset keys map to None (M4)."""
    return {key: _conf(spark, key) for key in keys}


def delta_available() -> bool:
    try:
        import delta  # noqa: F401
        return True
    except ImportError:
        return False

