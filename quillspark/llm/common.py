"""What several operators share: the word rule, intermediate tables, broadcast files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"

#: A file that is sent to every executor may not be larger.
MOST_SHIPPED_BYTES = 64 << 20


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def words_of(text: Column) -> Column:
    """The words of a text without nulls, in order."""
    return F.filter(F.split(text, f"{SPACE}+", -1), lambda w: w != "")


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where higher-order functions repeat their bodies."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, from ``spark.checkpoint.dir``.

    Only a session that runs in one process may go without the setting; it then gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        jsc = spark.sparkContext._jsc.sc()
        if jsc.getCheckpointDir().isDefined():
            folder = jsc.getCheckpointDir().get()
        elif spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
            folder = tempfile.mkdtemp(prefix="quillspark-")
            spark.sparkContext.setCheckpointDir(folder)
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return str(folder).rstrip("/")


def written(frame: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder: computed once, and safe from lost executors."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    spark.sparkContext._jvm.System.gc()  # lets go of the shuffle files of steps that are done
    return spark.read.schema(frame.schema).parquet(path)


def shipped_file(spark: SparkSession, path: str):
    """A broadcast of a small file's bytes, read on the driver."""
    with open(path, "rb") as f:
        data = f.read(MOST_SHIPPED_BYTES + 1)
    if len(data) > MOST_SHIPPED_BYTES:
        raise ValueError(f"{path} is larger than {MOST_SHIPPED_BYTES} bytes")
    return spark.sparkContext.broadcast(data)
