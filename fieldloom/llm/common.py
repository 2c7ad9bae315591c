"""Helpers the training-data operators share."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

WORD = re.compile(r"[^\x20\x09-\x0D]+")
JAVA_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(df: DataFrame, fn: Callable[[dict], dict], ddl: str) -> DataFrame:
    """``mapInArrow`` on dictionaries: ``fn`` gets the columns of a batch as Arrow
    arrays and returns the columns of ``ddl`` as lists or arrays."""
    schema = T.StructType.fromDDL(ddl) if isinstance(ddl, str) else ddl
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            got = fn(dict(zip(batch.schema.names, batch.columns)))
            yield pa.RecordBatch.from_pydict({f.name: got[f.name] for f in arrow}, schema=arrow)

    return df.mapInArrow(run, schema)


def broadcast_tables(spark: SparkSession, tables):
    """Broadcast what an object holds (arrays, dictionaries): a broadcast is pickled by
    reference to its class, which executors without the package could not find."""
    return spark.sparkContext.broadcast(vars(tables))


def revived(kind: type, shared):
    """The object again, in a task; it shares what it holds with the broadcast."""
    tables = object.__new__(kind)
    tables.__dict__.update(shared.value)
    return tables


def text_hash(text: Column) -> Column:
    """Tells rows of one id apart that differ in text."""
    return F.xxhash64(text)


def document_key(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the text's hash, whatever else ``docs`` holds."""
    return docs.select("doc_id", "text", text_hash(F.col("text")).alias("text_key"))


def keyed_rows(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs`` in one struct), doc_id and row_key, the text's hash."""
    return docs.select(F.struct("*").alias("row"), "doc_id", text_hash(F.col("text")).alias("row_key"))


def same_document(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_key"] == b["text_key"])
