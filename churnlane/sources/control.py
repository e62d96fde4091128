"""Small control files on the cluster file system: model registry entries,
contracts, snapshot version pointers.

These are a few hundred bytes each — metadata, never row data.  They go
through the Hadoop ``FileSystem`` of the session (so any cluster file system
works: HDFS, object stores, a shared mount) instead of a Spark job per file.
When the session has no JVM gateway (a remote session), the same calls fall
back to one-row Spark text reads/writes.

Files are written to a temporary name and renamed into place, so a reader
never sees a half-written file; callers keep versions immutable and pick the
newest by listing (``newest_numbered``) rather than rewriting a pointer.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    try:
        sc = spark.sparkContext
        jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    except Exception:            # no JVM gateway: use Spark jobs instead
        return None
    if jvm is None:
        return None
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(conf), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write ``text`` as the file ``path`` (replacing it)."""
    h = _fs(spark, path)
    if h is None:
        (spark.createDataFrame([(text,)], "value string").coalesce(1)
              .write.mode("overwrite").text(path))
        return
    jvm, fs, p = h
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, True)
    if not fs.rename(tmp, p):
        raise OSError(f"could not move control file into place: {path}")


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file ``path``; False where it exists already, so of several writers one succeeds."""
    h = _fs(spark, path)
    if h is None:
        try:
            spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("error").text(path)
        except AnalysisException:
            return False
        return True
    jvm, fs, p = h
    if fs.getUri().getScheme() == "file":
        # Hadoop's local file system looks first and creates then; the operating system does both at once
        fs.mkdirs(p.getParent())
        if not jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).createNewFile():
            return False
    try:
        out = fs.create(p, fs.getUri().getScheme() == "file")
    except Py4JJavaError as e:
        if fs.exists(p):
            return False
        raise e
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder that nothing reads any more (left where it is without a JVM gateway)."""
    h = _fs(spark, path)
    if h is not None:
        h[1].delete(h[2], True)


def rename(spark: SparkSession, source: str, to: str) -> bool:
    """Move a file; False where there is none (it has been moved already)."""
    jvm, fs, p = _fs(spark, source)
    return bool(fs.exists(p)) and bool(fs.rename(p, jvm.org.apache.hadoop.fs.Path(to)))


def list_files(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Full paths of the files of ``folder`` itself whose names end in ``suffix``."""
    _, fs, p = _fs(spark, folder)
    return [s.getPath().toString() for s in fs.listStatus(p) if s.isFile() and s.getPath().getName().endswith(suffix)] if fs.exists(p) else []


def file_states(spark: SparkSession, path: str) -> dict[str, str]:
    """``size:modified`` of the data file at ``path`` or of those directly in that folder (or matching that pattern), by full path."""
    jvm, fs, p = _fs(spark, path)
    found = list(fs.globStatus(p) or [])
    files = [f for s in found for f in (fs.listStatus(s.getPath()) if s.isDirectory() else [s])]
    return {f.getPath().toString(): f"{f.getLen()}:{f.getModificationTime()}" for f in files
            if f.isFile() and not f.getPath().getName().startswith(("_", "."))}


def read_text(spark: SparkSession, path: str) -> str | None:
    """Contents of ``path``, or None when it does not exist."""
    h = _fs(spark, path)
    if h is None:
        try:
            rows = spark.read.text(path).collect()   # one small control file
        except Exception:
            return None
        return "\n".join(r["value"] for r in rows) if rows else None
    jvm, fs, p = h
    if not fs.exists(p):
        return None
    if fs.getFileStatus(p).isDirectory():            # written by the Spark fallback
        parts = sorted(s.getPath() for s in fs.listStatus(p)
                       if s.getPath().getName().startswith("part-"))
        return "\n".join(_read_file(jvm, fs, x).rstrip("\n") for x in parts) or None
    return _read_file(jvm, fs, p)


def _read_file(jvm, fs, p) -> str:
    s = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(s, "UTF-8")
    finally:
        s.close()


def list_numbered(spark: SparkSession, directory: str, pattern: str,
                  require: str | None = None) -> list[int] | None:
    """Sorted integers ``n`` of the entries of ``directory`` whose name matches
    ``pattern`` (one ``(\\d+)`` group); with ``require``, only entries holding
    that child (e.g. ``_SUCCESS`` of a finished Spark write).  An empty list
    when the directory does not exist; None when listing is not possible (no
    JVM gateway)."""
    h = _fs(spark, directory)
    if h is None:
        return None
    jvm, fs, p = h
    if not fs.exists(p):
        return []
    rx = re.compile(pattern)
    out = []
    for st in fs.listStatus(p):
        m = rx.fullmatch(st.getPath().getName())
        if not m:
            continue
        if require and not fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), require)):
            continue
        out.append(int(m.group(1)))
    return sorted(out)


def newest_numbered(spark: SparkSession, directory: str, pattern: str,
                    require: str | None = None) -> int | None:
    """Largest number ``list_numbered`` finds; None when there is none or
    listing is not possible."""
    found = list_numbered(spark, directory, pattern, require)
    return found[-1] if found else None


def read_numbered(spark: SparkSession, directory: str, name: str) -> list[str]:
    """Contents of the files ``<name>-<n>`` of ``directory`` in the order of n."""
    found = list_numbered(spark, directory, rf"{name}-(\d+)")
    if found is not None:
        return [read_text(spark, f"{directory}/{name}-{n}") for n in found]
    rows = spark.read.text(f"{directory}/{name}-*").select("value", "_metadata.file_path").collect()   # small control files
    number = re.compile(rf"{name}-(\d+)/")
    return [r["value"] for r in sorted(rows, key=lambda r: int(number.search(r["file_path"])[1]))]
