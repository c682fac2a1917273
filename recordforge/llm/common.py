"""What several operators share: the shared folder, written tables, components of a graph."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a longest run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_scratch: dict[str, SparkSession] = {}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """``columns`` of a driver table; whatever else it holds is never read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine (tests) a local one is made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="recordforge-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def _remove_scratch() -> None:
    for path, spark in _scratch.items():
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001  the session has ended; its folder goes with its owner
            pass


atexit.register(_remove_scratch)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: its lineage ends here.

    A lost executor costs only the tasks it ran, and the table is read in columns
    as often as needed. The application's folder is removed when its driver ends.
    """
    spark = df.sparkSession
    root = f"{shared_dir(spark)}/recordforge-{spark.sparkContext.applicationId}"
    _scratch.setdefault(root, spark)
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package where they would not find it by themselves."""
    sc, root = spark.sparkContext, Path(__file__).resolve().parents[2]
    if str(root) in (sc.environment.get("PYTHONPATH", "") + ":" + os.environ.get("PYTHONPATH", "")).split(":"):
        return
    sc.environment["PYTHONPATH"] = ":".join(filter(None, [str(root), sc.environment.get("PYTHONPATH", "")]))
    if not sc.master.startswith("local["):
        path = Path(tempfile.mkdtemp(prefix="recordforge-")) / "recordforge.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in (root / "recordforge").rglob("*.py"):
                z.write(f, f.relative_to(root))
        sc.addPyFile(str(path))


def map_in_pandas(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInPandas`` with this package within the workers' reach."""
    ship(df.sparkSession)
    return df.mapInPandas(fn, schema)


def map_in_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow`` with this package within the workers' reach."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def merge_labels(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Join the sets of u and v in place; a label is the smallest member, always fully followed."""
    while True:
        a, b = label[u], label[v]
        open_ = a != b
        if not open_.any():
            return
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges (u, v)``: rows ``(node, component)``, the smallest node.

    Rounds of smallest-neighbour label passing, each followed by a pointer jump, so
    paths halve and stars end at once. Every round is aggregated map-side and joined on
    a side with unique keys (AQE splits a hot key of the other side), and is written to
    the shared folder. Nodes without an edge, null ends and loops give no row.
    """
    both = edges.where("u <> v").select("u", "v")
    both = written(both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v"))), "cc-edges")
    labels = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
    labels = written(labels.select("node", F.least("node", "m").alias("component")), "cc-labels")
    while True:  # labels only fall, so this ends
        near = (
            both.join(labels.withColumnRenamed("node", "v"), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        step = labels.join(near, "node").select("node", F.least("component", "near").alias("c"), F.col("component").alias("was"))
        step = written(step, "cc-step")
        jump = step.select(F.col("node").alias("c"), F.col("c").alias("c2"))
        new = written(step.join(jump, "c", "left").select("node", F.least("c", "c2").alias("component"), "was"), "cc-labels")
        labels = new.select("node", "component")
        if not new.where("component <> was").limit(1).count():
            return labels
