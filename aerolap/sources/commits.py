"""Numbered commit files: how a writer publishes folders that it has filled.

A writer fills folders of its own, then publishes one small JSON file
``<number>.json`` that names them. Publishing renames a finished file and fails
if that number is taken, so readers see a whole commit or none, and of two
writers one wins. Readers pin a number and read only what it names.

Publishing goes through Spark's file systems on the driver. Reading uses plain
paths and ``pyarrow.fs``, so that it also works in Spark's Python workers.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

from aerolap.session import local_path


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def publish(spark: SparkSession, folder: str, number: int, doc: dict) -> bool:
    """Write ``<folder>/<number>.json``; False if the number is taken."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = _path(spark, f"{folder.rstrip('/')}/{number}.json")
    draft = _path(spark, f"{folder.rstrip('/')}/.{number}-{uuid.uuid4().hex}.tmp")
    fs = target.getFileSystem(conf)
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(doc).encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    try:
        # fails if the target exists: never replaces a commit
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), spark._sc._gateway.new_array(rename, 0))
        return True
    except Exception:
        taken = fs.exists(target)
        fs.delete(draft, False)
        if taken:
            return False
        raise


def names(folder: str) -> list[str]:
    """File and folder names directly below ``folder`` (none if it is absent)."""
    lp = local_path(folder)
    if lp is not None:
        import os

        return os.listdir(lp) if os.path.isdir(lp) else []
    import pyarrow.fs as pafs

    from aerolap.sources.files import arrow_uri

    fs, p = pafs.FileSystem.from_uri(arrow_uri(folder))
    return [f.base_name for f in fs.get_file_info(pafs.FileSelector(p, allow_not_found=True))]


def numbers(folder: str) -> list[int]:
    """The published numbers, ascending."""
    found = (re.fullmatch(r"(\d+)\.json", n) for n in names(folder))
    return sorted(int(m[1]) for m in found if m)


def read(folder: str, number: int) -> dict:
    from aerolap.sources.files import open_binary

    with open_binary(f"{folder.rstrip('/')}/{number}.json") as f:
        return json.loads(f.read())
