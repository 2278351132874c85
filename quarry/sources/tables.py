"""Parquet tables of a scale-factor directory.

Reads are lazy: a ``Tables`` object only resolves paths, and Catalyst prunes
the columns each query uses and pushes its filters into the parquet scan.

A table's schema is resolved once in an application: later reads pass it to
the reader, which then plans without the footer-reading job that schema
inference starts.  A ``Tables`` object keeps its schemas; a new one asks for
the file's time of change and length, and resolves the schema anew where these
differ, for folders, and where the store gives no time of change.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_RESOLVED: dict[tuple, StructType] = {}  # by application, path, its time of change and length
_MOST_RESOLVED = 10_000


class Tables:
    """``Tables(spark, "/data/sf0.1").orders`` -> DataFrame of orders.parquet.

    ``pattern`` places each table under ``root``; the default is one parquet
    file or folder per table named ``<table>.parquet``.  A cluster layout of
    one folder per table is ``Tables(spark, "s3a://bucket/tpch", "{name}/")``.

    A root ``table:<prefix>`` stands for catalog tables ``<prefix>_<table>``, such
    as those of ``write_bucketed``: joins and groups on the key they are
    bucketed by then need no exchange of them.
    """

    def __init__(self, spark: SparkSession, root: str, pattern: str = "{name}.parquet"):
        self.spark = spark
        self.root = root
        self.pattern = pattern
        self._schemas: dict[str, StructType] = {}

    def path(self, name: str) -> str:
        return os.path.join(self.root, self.pattern.format(name=name))

    def load(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(f"unknown table {name!r}")
        if self.root.startswith("table:"):
            return self.spark.table(f"{self.root[6:]}_{name}")
        path = self.path(name)
        if name not in self._schemas:
            key = _state(self.spark, path)
            if key not in _RESOLVED:
                df = self.spark.read.parquet(path)
                self._schemas[name] = df.schema
                if key is not None:
                    if len(_RESOLVED) >= _MOST_RESOLVED:
                        _RESOLVED.clear()
                    _RESOLVED[key] = df.schema
                return df
            self._schemas[name] = _RESOLVED[key]
        return self.spark.read.schema(self._schemas[name]).parquet(path)

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.load(name)
        raise AttributeError(name)


#: The key that most joins of a table use.
BUCKET_KEYS = {"lineitem": "l_orderkey", "orders": "o_orderkey", "events": "user_id"}


def write_bucketed(tables: Tables, prefix: str, buckets: int = 64, keys: dict[str, str] = BUCKET_KEYS) -> Tables:
    """Write all of ``tables``' tables as ``<prefix>_<table>`` into the session's warehouse and return them.

    Tables in ``keys`` are bucketed and sorted by their key, with the same
    number of buckets, so that two of them are joined, and one is grouped, on
    that key without an exchange.  Rows are dealt to buckets before writing,
    so a bucket is one file.  Choose ``buckets`` for files of some hundred MB.
    Existing tables of these names are replaced.
    """
    for name in TABLES:
        path = tables.path(name)
        if not _exists(tables.spark, path):
            continue
        df = tables.load(name)
        writer = df.write
        if name in keys:
            writer = df.repartition(buckets, keys[name]).write.bucketBy(buckets, keys[name]).sortBy(keys[name])
        writer.mode("overwrite").format("parquet").saveAsTable(f"{prefix}_{name}")
    return Tables(tables.spark, f"table:{prefix}")


def _store(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _exists(spark: SparkSession, path: str) -> bool:
    store, where = _store(spark, path)
    return store.exists(where)


def _state(spark: SparkSession, path: str) -> tuple | None:
    """What tells a file as it is from one changed later; None for a folder (changes deep inside it may not show) or without a time of change."""
    store, where = _store(spark, path)
    if not store.exists(where):
        return None
    status = store.getFileStatus(where)
    changed = status.getModificationTime()
    if status.isDirectory() or not changed:
        return None
    return spark.sparkContext.applicationId, path, changed, status.getLen()
