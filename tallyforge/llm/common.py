"""What several operators of this subpackage share: row identities and written intermediate tables."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.session import fresh_path
from tallyforge.sources import folders

UID = "__llm_uid"

#: The white space that separates words, as text and as a regular expression class.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def utf8(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: a lost executor or a second reader finds the very same rows."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Remove the files of a table of :func:`written` that nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        folders.drop(df.sparkSession, folder)


def bucketed(df: DataFrame, label: str, chunks: int = 0) -> DataFrame:
    """``df`` as a table in the shared folder that is read by chunk without a shuffle.

    With fewer buckets than a shuffle has partitions, a grouping by chunk would deal the rows anew. Above the most buckets that
    Spark allows, or than ``chunks``, a bucket holds several chunks, one after the other. Only the catalog's entry goes again, not the files.
    """
    spark, name = df.sparkSession, f"llm_{uuid.uuid4().hex}"
    least, most = (int(spark.conf.get(f"spark.sql.{key}")) for key in ("shuffle.partitions", "sources.bucketing.maxBuckets"))
    df.write.format("parquet").option("compression", "zstd").option("path", fresh_path(spark, label)).bucketBy(
        min(max(chunks, least), most), "chunk").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def with_uid(df: DataFrame) -> DataFrame:
    """Rows with a number that is theirs alone. Repeated rows and missing ids stay distinct rows.

    The number depends on the partitions of ``df``: write the result before reading it twice.
    """
    return df.withColumn(UID, F.monotonically_increasing_id())


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into runs of about ``most_bytes`` of text (one row at least), to bound a task's memory."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        begin, held = 0, 0
        for at, size in enumerate(sizes):
            if held and held + size > most_bytes:
                yield batch.slice(begin, at - begin)
                begin, held = at, 0
            held += size
        if begin < batch.num_rows:
            yield batch.slice(begin)


def give_back() -> None:
    """Return freed memory to the system: more workers live than tasks run, and each would keep the most it ever held."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim:
        trim(0)


def lean(function):
    """A function of a group that gives memory back once its own variables are gone."""

    def run(group: pa.Table) -> pa.Table:
        out = function(group)
        give_back()
        return out

    return run


def lean_pair(function):
    """The same for two groups of one key."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = function(left, right)
        give_back()
        return out

    return run


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not find it where the driver does."""
    _ship(spark.sparkContext.applicationId, spark.sparkContext)


@cache
def _ship(application: str, context) -> None:
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="tallyforge-py-"), "tallyforge.zip")
    with zipfile.ZipFile(target, "w") as bundle:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    bundle.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(target)
