"""Intermediate results kept as files."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame

from ..session import work_dir


def stage(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared working folder and read it back.

    For results that several later steps read: they are computed once, and after the loss of an
    executor the files are read again instead of repeating the work before them.
    """
    path = f"{work_dir(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*staged: DataFrame) -> None:
    """Delete the files of staged results that no later result reads any more.

    What was computed from them has to be staged itself, or a lost executor's part of it could not
    be computed again.
    """
    for df in staged:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
