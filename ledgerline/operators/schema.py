"""Field types by consensus: within an index against its mapping, and between the indices of a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import jsonnorm

#: Store type to field type.
STORE_TYPES = {
    "long": "Number", "integer": "Number", "short": "Number", "byte": "Number", "double": "Number", "float": "Number", "half_float": "Number", "scaled_float": "Number",
    "text": "String", "keyword": "String", "date": "Date", "date_nanos": "Date", "boolean": "Boolean", "object": "Object", "nested": "Object",
}


def store_type(t: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in STORE_TYPES.items() for x in kv])
    return F.coalesce(m[t], F.lit("Unknown"))


def compatible(data: Column, store: Column) -> Column:
    return (data == store) | ((data == "String") & (store == "Date")) | ((data == "Date") & (store == "String")) | ((data == "Array") & store.isin("String", "Number", "Boolean", "Date"))


def field_types(docs: DataFrame) -> DataFrame:
    """(index, path, type) of every leaf of ``docs`` (index, json)."""
    return docs.select("index", F.explode(jsonnorm.leaf_types(F.col("json"))).alias("x")).select("index", "x.path", "x.type")


def consensus(types: DataFrame) -> DataFrame:
    """(index, path, type): the most frequent type but Null, the first by name on ties; Unknown if there is none."""
    counts = types.groupBy("index", "path", "type").agg(F.count("*").alias("n"))
    w = Window.partitionBy("index", "path").orderBy((F.col("type") == "Null").asc(), F.desc("n"), "type")
    best = counts.withColumn("rn", F.row_number().over(w)).where("rn = 1")
    return best.select("index", "path", F.when(F.col("type") == "Null", "Unknown").otherwise(F.col("type")).alias("type"))


def mismatches(types: DataFrame, mapping: DataFrame) -> DataFrame:
    """(index, path, type, store) where the data's consensus contradicts ``mapping`` (index, path, es_type)."""
    m = mapping.select("index", "path", store_type(F.col("es_type")).alias("store"))
    return consensus(types).where("type not in ('Unknown', 'Null')").join(m, ["index", "path"]).where(~compatible(F.col("type"), F.col("store")))


def _stream(index: Column) -> Column:
    """The stream of a segment: its name without date and number."""
    return F.regexp_replace(F.regexp_replace(index, r"^\.ds-", ""), r"-\d{4}\.\d{2}\.\d{2}-\d+$|-[^-]*$", "")


def minority(mapping: DataFrame) -> DataFrame:
    """(stream, path, index, es_type) of the indices whose type strictly fewer indices of the stream share."""
    counts = mapping.withColumn("stream", _stream(F.col("index"))).groupBy("stream", "path", "es_type").agg(F.count_distinct("index").alias("n"), F.collect_set("index").alias("who"))
    top = counts.withColumn("mx", F.max("n").over(Window.partitionBy("stream", "path"))).where("n < mx")
    return top.select("stream", "path", F.explode("who").alias("index"), "es_type")


def caps_conflicts(mapping: DataFrame) -> DataFrame:
    """(path, index): every index of a path that has more than one type."""
    many = mapping.groupBy("path").agg(F.count_distinct("es_type").alias("n")).where("n > 1")
    return mapping.join(many.select("path"), "path", "left_semi").select("path", "index").distinct()


def resolve_alias(aliases: DataFrame) -> DataFrame:
    """(alias, index) of the aliases with exactly one target."""
    return aliases.groupBy("alias").agg(F.count("*").alias("n"), F.first("index").alias("index")).where("n = 1").select("alias", "index")


def cutover(old: DataFrame, repaired: DataFrame, start: int, end: int) -> DataFrame:
    """The next version: the old one outside the window, the repaired rows inside."""
    inside = (F.col("timestamp_ms") >= start) & (F.col("timestamp_ms") < end)
    return old.where(~inside).unionByName(repaired.where(inside))
