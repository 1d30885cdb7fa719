"""Tables that cut lineage, in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's `spark.checkpoint.dir`. Only a local session without one gets a temporary folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="spark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Writer's options for rows of many MB: the sizes of page and row group are looked at after each row, not only after 100, and no statistics
#: keep the least and greatest value of each row group until the file ends. So a task that writes or reads such rows holds a row or two at a
#: time, however many its file has.
LARGE_ROWS = {"parquet.block.size": 8 << 20, "parquet.enable.dictionary": "false", "parquet.column.statistics.enabled": "false"} | {
    f"parquet.{part}.size.row.check.{end}": 1 for part in ("block", "page") for end in ("min", "max")
}


def materialise(frame: DataFrame, label: str, **options: int | str) -> DataFrame:
    """`frame`, written once as Parquet under the shared folder and read again: lost executors do not lose it. `options` are those of the writer."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    frame.write.options(**options).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def free_name(wanted: str, *frames: DataFrame) -> str:
    """`wanted`, with underscores added until none of the frames has such a column."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
