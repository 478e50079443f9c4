"""What there is: segments of streams, indices, samples of documents, mappings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import jsonnorm
from .ranges import TS
from .retention import is_system

SAMPLE_DOCS = 100


def segments(rows: DataFrame) -> DataFrame:
    """(stream, segment, seq): the segments of each stream in order; the last is written to."""
    first = rows.groupBy("stream", "segment").agg(F.min(TS).alias("first_ms"))
    return first.withColumn("seq", F.row_number().over(Window.partitionBy("stream").orderBy("first_ms", "segment"))).drop("first_ms")


def segment_lists(rows: DataFrame) -> DataFrame:
    """(stream, segments): the names in order, as an array; one a period, so few a stream."""
    named = segments(rows).groupBy("stream").agg(F.array_sort(F.collect_list(F.struct("seq", "segment"))).alias("x"))
    return named.select("stream", F.transform("x", lambda x: x["segment"]).alias("segments"))


def joined_lists(lists: DataFrame) -> DataFrame:
    """(segment): all lists one after the other."""
    return lists.select(F.explode("segments").alias("segment"))


def indices(rows: DataFrame) -> DataFrame:
    """(index, docs, first_ms, last_ms): the catalogue of all indices that hold documents."""
    return rows.groupBy("index").agg(F.count("*").alias("docs"), F.min(TS).alias("first_ms"), F.max(TS).alias("last_ms"))


def user_indices(catalogue: DataFrame) -> DataFrame:
    return catalogue.where(~is_system(F.col("index")))


def sample_documents(rows: DataFrame, n: int = SAMPLE_DOCS) -> DataFrame:
    """The first ``n`` documents of each index by (timestamp_ms, id); Spark cuts each index to n before it shuffles."""
    w = Window.partitionBy("index").orderBy(TS, "id")
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def mapping_types(mappings: DataFrame) -> DataFrame:
    """(index, path, es_type) of every typed field of ``mappings`` (index, json); objects without a type give only their
    children."""
    return mappings.select("index", F.explode(jsonnorm.mapping_leaves(F.col("json"))).alias("x")).select("index", "x.path", F.col("x.type").alias("es_type"))


def field_type(mapping: DataFrame, path: str) -> DataFrame:
    """(index, es_type) of one field, null in an index that has not got it."""
    own = mapping.where(F.col("path") == path).select("index", "es_type")
    return mapping.select("index").distinct().join(own, "index", "left")


def mapping_json(fields: Column) -> Column:
    """A mapping of plain ``fields``, an array of struct<path, es_type>, as JSON text."""
    each = F.transform(fields, lambda x: F.concat(F.lit('"'), x["path"], F.lit('":{"type":"'), x["es_type"], F.lit('"}')))
    return F.concat(F.lit('{"properties":{'), F.array_join(each, ","), F.lit("}}"))
