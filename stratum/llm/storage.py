"""Files and staged tables in the shared folder the cluster names."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from pathlib import Path

from stratum.session import ensure_checkpoint_dir

_SHIPPED: set[str] = set()


def folder(spark, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir`` (shared by driver and
    executors; a scratch folder only where a local session has none)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df, name: str):
    """Write ``df`` once as Parquet in the shared folder and read it back: a
    lineage cut that outlives executors and keeps columns prunable."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_measured(df, name: str, metrics: dict):
    """``stage``, and the values of aggregate columns ``metrics`` taken as the
    rows are written, without a job of their own."""
    from pyspark.sql import Observation
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    staged = stage(df.observe(seen, *(c.alias(k) for k, c in metrics.items())), name)
    return staged, seen.get


def filesystem(uri: str):
    """(pyarrow file system, path) of a Hadoop-style URI."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def write_atomic(uri: str, parts) -> None:
    """Write byte ``parts`` under a name of this attempt, then rename: a retried
    or doubled task never leaves half a file under the final name."""
    fs, path = filesystem(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
    fs.move(own, path)


def ship_package(spark) -> None:
    """Send this package's source to the workers, once an application, unless
    ``PYTHONPATH`` already leads them to it."""
    root = Path(__file__).resolve().parents[2]
    known = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    app = spark.sparkContext.applicationId
    if root in known or app in _SHIPPED:
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted((root / "stratum").rglob("*.py")):
            z.write(p, p.relative_to(root))
    uri = folder(spark, "stratum") + ".zip"
    write_atomic(uri, [data.getvalue()])
    spark.sparkContext.addPyFile(uri)
    _SHIPPED.add(app)
