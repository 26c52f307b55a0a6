"""Single files and folders in whatever store Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    place, store = _store(spark, path)
    return store.exists(place)


def removed(spark: SparkSession, path: str) -> bool:
    """Delete a file or a folder with all that is in it; whether there was one."""
    place, store = _store(spark, path)
    return store.delete(place, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    place, store = _store(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(place)) if store.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """The one line of a small file; None if there is no such file."""
    place, store = _store(spark, path)
    if not store.exists(place):
        return None
    stream = store.open(place)
    try:
        return stream.readLine()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, line: str, *, part: str) -> None:
    """Put one line into a file in one step: readers find the old line or the new one. `part` names the temporary file beside it."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    temporary, store = _store(spark, f"{path}.{part}")
    stream = store.create(temporary, True)
    stream.write(bytearray(line.encode()))
    stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    choice = spark.sparkContext._gateway.new_array(rename, 1)
    choice[0] = rename.OVERWRITE
    target = jvm.org.apache.hadoop.fs.Path(path)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(temporary, target, choice)
