"""Small text files that exactly one writer creates.

A commit is a file with the next number as its name. Whoever creates it has
committed; whoever finds it there has not, and must look at what the other did.
The text is written to a draft first and then linked or renamed to its name, so
a reader sees no file or a whole one.

On a local path the draft is linked, which fails if the name is taken. Elsewhere
it is renamed through ``FileContext`` without overwriting, which the file system
must do atomically (HDFS and ABFS do; an object store without a conditional put
does not).
"""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer committed something that this write did not see."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def create_once(spark: SparkSession, path: str, content: dict) -> bool:
    """Create ``path`` with ``content`` as JSON; False if it exists already."""
    target, fs = _fs(spark, path)
    draft, _ = _fs(spark, f"{path.rsplit('/', 1)[0]}/.draft-{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(draft.toUri().getPath(), target.toUri().getPath())
        else:
            jvm = spark.sparkContext._jvm
            kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            options = spark.sparkContext._gateway.new_array(kind, 1)
            options[0] = kind.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(draft, target, options)
    except FileExistsError:
        return False
    except Py4JJavaError as exc:
        if "FileAlreadyExistsException" not in str(exc.java_exception):
            raise
        return False
    finally:
        fs.delete(draft, False)                     # gone already after a rename
    return True


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in ``folder``, sorted; drafts are left out."""
    p, fs = _fs(spark, folder)
    if not fs.exists(p):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n for n in found if not n.startswith((".", "_")))


def load(spark: SparkSession, path: str) -> dict:
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
