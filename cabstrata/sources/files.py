"""Files on any file system that Spark reaches: presence, copies, fingerprints."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from cabstrata.sources.months import Month


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def is_published(spark: SparkSession, origin: str, month: Month) -> bool:
    """Whether the origin has the month's file; a missing one isn't an error."""
    return exists(spark, f"{origin}/{month.filename}")


def copy(spark: SparkSession, src: str, dst: str, tries: int = 3, wait: float = 1.0) -> int:
    """Copies a file beside its target and renames it, so that no reader sees part of it. Returns its
    size. Failures are tried again after a wait that doubles."""
    for attempt in range(tries):
        try:
            (sfs, sp), (dfs, dp), (_, tmp) = _at(spark, src), _at(spark, dst), _at(spark, f"{dst}._part")
            spark._jvm.org.apache.hadoop.fs.FileUtil.copy(sfs, sp, dfs, tmp, False, True, spark._jsc.hadoopConfiguration())
            dfs.delete(dp, False)
            if not dfs.rename(tmp, dp):
                raise OSError(f"can't rename to {dst}")
            return dfs.getFileStatus(dp).getLen()
        except Exception:
            if attempt == tries - 1:
                raise
            time.sleep(wait * 2**attempt)
    raise AssertionError


def ingest_missing(spark: SparkSession, months: list[Month], origin: str, mirror: str, force: bool = False, at_once: int = 8) -> list[str]:
    """Mirrors the months' files that aren't there yet (all of them with force), several at once. Returns
    the new paths in the order of the months; months that aren't published are passed over."""

    def one(m: Month) -> str | None:
        target = f"{mirror}/{m.filename}"
        if (force or not exists(spark, target)) and is_published(spark, origin, m):
            copy(spark, f"{origin}/{m.filename}", target)
            return target
        return None

    with ThreadPoolExecutor(at_once) as pool:
        return [p for p in pool.map(one, months) if p]


def fingerprint(spark: SparkSession, path: str) -> tuple[str, str, int] | None:
    """(etag, last modified, length) of a file, None if it isn't there. The etag is the file system's
    checksum, or its time and length where there is none."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return None
    s = fs.getFileStatus(p)
    c = fs.getFileChecksum(p)
    return (c.toString() if c is not None else f"{s.getModificationTime()}-{s.getLen()}"), str(s.getModificationTime()), s.getLen()


def drift_status(now: tuple | None, stored_etag: str | None) -> str:
    """not_published, new, unchanged or drifted."""
    if now is None:
        return "not_published"
    return "new" if stored_etag is None else "unchanged" if now[0] == stored_etag else "drifted"
