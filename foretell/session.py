"""Session helpers: shared scratch space for lineage cuts and staged tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

CHECKPOINT_CONF = "spark.checkpoint.dir"
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    They need it for the Arrow UDF wherever it is not installed on the executors.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).parent
    # the archive is only read by the driver, which serves it to the executors
    target = f"{tempfile.mkdtemp(prefix='foretell-package-')}/{package.name}"
    sc.addPyFile(shutil.make_archive(target, "zip", package.parent, package.name))
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master, where driver and executors share one disk, may fall back to
    a temporary folder; a cluster without the setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="foretell-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and continue from the written copy."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A driver-made table whose exact size the planner knows, so it can choose to broadcast."""
    fields = to_arrow_schema(StructType.fromDDL(schema))
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=fields), schema)
