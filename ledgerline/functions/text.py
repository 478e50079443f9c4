"""Text and name expressions, all JVM side.  Column in, column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000


def rfc3339(ms: Column) -> Column:
    """Milliseconds since the epoch as RFC 3339 in UTC; the fraction appears only if it is not zero.
    Years of more than four digits have a sign.

    Instants outside the years -262143 to 262142 give the epoch.
    """
    ms = F.when(ms.between(-8_334_601_228_800_000, 8_210_266_876_799_999), ms).otherwise(F.lit(0))
    t = F.timestamp_millis(ms)
    utc = F.to_utc_timestamp(t, "UTC")
    return F.when(ms % 1000 == 0, F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).otherwise(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'"))


def clean_message(m: Column) -> Column:
    """Without carriage returns, and trimmed of Unicode white space."""
    return F.regexp_replace(F.replace(m, F.lit("\r"), F.lit("")), r"(?U)^\s+|\s+\z", "")


def sanitize_key(k: Column) -> Column:
    """A field name of lower-case ASCII letters, digits and single underscores that does not start with a digit."""
    x = F.lower(F.btrim(F.regexp_replace(F.left(k, F.lit(256)), r"[^A-Za-z0-9]+", "_"), F.lit("_")))
    return F.when((x == "") | x.rlike("^[0-9]"), F.concat(F.lit("field_"), x)).otherwise(x)


def group_slug(g: Column) -> Column:
    """A log group as part of an index name."""
    x = F.btrim(F.lower(F.regexp_replace(g, "[^A-Za-z0-9]", "-")), F.lit("-"))
    return F.when(x == "", F.lit("log-group")).otherwise(x)


def checkpoint_slug(g: Column) -> Column:
    return F.regexp_replace(g, "[^A-Za-z0-9]", "-")


def checkpoint_file(g: Column) -> Column:
    return F.concat(F.lit("checkpoints-"), checkpoint_slug(g), F.lit(".json"))


def is_checkpoint(f: Column) -> Column:
    """Whether a path ends in a checkpoint's file name; a filter on a listing of paths lists them."""
    return f.rlike(r"(^|/)checkpoints-[^/]*\.json$")


def checkpoint_group(f: Column) -> Column:
    """The slug in a checkpoint's file name, or null."""
    x = F.regexp_extract(f, r"^checkpoints-(.*)\.json$", 1)
    return F.when(x == "", F.lit(None)).otherwise(x)


def target_index(prefix: str, group: Column) -> Column:
    return F.concat(F.lit(prefix + "-"), group_slug(group))


def stable_alias(prefix: str, group: Column) -> Column:
    """The name under which readers find a group's stream, whatever its version."""
    return target_index(prefix, group)


def version_of(alias: Column, version: str) -> Column:
    return F.concat(alias, F.lit(f"-{version}"))


def other_version(name: Column, alias: Column | None = None) -> Column:
    """The other of a stream's two versions; the alias's -v2 if the name has none."""
    return F.when(name.endswith("-v1"), F.regexp_replace(name, "-v1$", "-v2")).when(name.endswith("-v2"), F.regexp_replace(name, "-v2$", "-v1")).otherwise(version_of(name if alias is None else alias, "v2"))


def segment_date_ms(name: Column) -> Column:
    """UTC midnight of the date in a segment's name ``...-yyyy.MM.dd-NNNNNN``, or null."""
    d = F.try_to_timestamp(F.regexp_extract(name, r"-(\d{4}\.\d{2}\.\d{2})-\d+$", 1), F.lit("yyyy.MM.dd"))
    return F.unix_millis(d)


def index_date_ms(name: Column, prefix: str) -> Column:
    """UTC midnight of the date in an index's name ``prefix-yyyy.MM.dd``, or null."""
    d = F.regexp_extract(F.when(name.startswith(prefix + "-"), F.substr(name, F.lit(len(prefix) + 2))), r"^(\d{4}\.\d{2}\.\d{2})$", 1)
    return F.unix_millis(F.try_to_timestamp(d, F.lit("yyyy.MM.dd")))


#: Field names of the store.
RESERVED = ("_id", "_index", "_type", "_source", "_score", "_routing", "_version", "_seq_no", "_primary_term")


def is_reserved(key: Column) -> Column:
    return key.isin(*RESERVED)


def name_before_dash(name: Column) -> Column:
    """A name without what follows its last dash."""
    return F.regexp_replace(name, "-[^-]*$", "")


def url_base(u: Column) -> Column:
    return F.regexp_replace(u, "/+$", "")


def snippet(body: Column, n: int = 500) -> Column:
    return F.left(body, F.lit(n))


def day_start(ms: Column) -> Column:
    return ms - F.pmod(ms, F.lit(DAY_MS))


def previous_day(ms: Column) -> tuple[Column, Column]:
    """The UTC day before that of ``ms``, as a half-open range."""
    return day_start(ms) - DAY_MS, day_start(ms)


def day_range(now_ms: Column, days_ago: Column) -> tuple[Column, Column]:
    """The UTC day so many days before that of ``now_ms``, as a half-open range."""
    start = day_start(now_ms) - days_ago * F.lit(DAY_MS)
    return start, start + DAY_MS


def events_per_second(n: Column, ms: Column) -> Column:
    """Whole events a second; 0 for no time."""
    return F.when(ms == 0, F.lit(0).cast("long")).otherwise(F.floor(n * 1000 / ms))
