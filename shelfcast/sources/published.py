"""Frames published in versions: a reader sees a whole one, whatever happens to the write of the next.

Each version has a folder of its own. Only when all its files are there, a small manifest that names the folder, its
format and its schema is put in place by a rename; readers start from the manifest with the highest number. A write that
fails leaves a folder that no manifest names. A frame read earlier stays on its own version.

In CSV files a null is nothing, and so an empty text is read back as a null; name another ``nullValue`` in the options to
keep the two apart.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, types as T

_MANIFEST = re.compile(r"_version-(\d{9})\.json$")


def _store(spark: SparkSession, path: str):
    """Hadoop's classes, and the file system that ``path`` lies in."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    return hadoop, hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions at ``path``, ascending; none where nothing was published."""
    hadoop, store = _store(spark, path)
    if not store.exists(hadoop.Path(path)):
        return []
    names = (str(f.getPath().getName()) for f in store.listStatus(hadoop.Path(path)))
    return sorted(int(m[1]) for name in names if (m := _MANIFEST.match(name)))


def _named(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/_version-{version:09d}.json"


def _manifest(spark: SparkSession, path: str, version: int) -> dict:
    if version not in versions(spark, path):
        raise FileNotFoundError(f"no version {version} at {path}")
    hadoop, store = _store(spark, path)
    stream = store.open(hadoop.Path(_named(path, version)))
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish(
    df: DataFrame, path: str, format: str = "csv", options: Mapping[str, str] | None = None
) -> int:
    """Write ``df`` in parallel as the next version at ``path`` and return its number.

    Of two that publish at once the later one may find its number taken; that is an error, and it is to be repeated.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    hadoop, store = _store(spark, path)
    number = max(versions(spark, path), default=0) + 1
    settings = {**({"header": "true"} if format == "csv" else {}), **(options or {})}
    folder = f"data-{uuid.uuid4().hex}"
    df.write.format(format).options(**settings).save(f"{path}/{folder}")
    content = {"folder": folder, "format": format, "options": settings, "schema": df.schema.jsonValue()}
    staged = hadoop.Path(f"{path}/.staged-{folder}")
    stream = store.create(staged, False)
    stream.write(json.dumps(content).encode())
    stream.close()
    place = hadoop.Path(_named(path, number))
    if store.exists(place) or not store.rename(staged, place):
        store.delete(staged, False)
        raise FileExistsError(f"version {number} at {path} was published meanwhile")
    return number


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The last version at ``path``, or the one of that number, with the types it was published with."""
    number = version or max(versions(spark, path), default=0)
    held = _manifest(spark, path, number)
    schema = T.StructType.fromJson(held["schema"])
    reader = spark.read.format(held["format"]).options(**held["options"])
    return reader.schema(schema).load(f"{path.rstrip('/')}/{held['folder']}")


def forget_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove all but the last ``keep`` versions (at least one), each one's manifest first; returns their numbers."""
    hadoop, store = _store(spark, path)
    old = versions(spark, path)[: -max(keep, 1)]
    for number in old:
        folder = _manifest(spark, path, number)["folder"]
        store.delete(hadoop.Path(_named(path, number)), False)
        store.delete(hadoop.Path(f"{path.rstrip('/')}/{folder}"), True)
    return old
