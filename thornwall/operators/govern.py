"""Retention, and protection of columns and rows by plain projections."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thornwall.sources.files import file_system, hadoop_path, subdirectories

RETENTION_DAYS = 90
_DAY = re.compile(r"^day=\d{4}-\d{2}-\d{2}$")

# Column tags.
PII, SENSITIVE, PUBLIC = "pii", "sensitive", "public"


def retained(df: DataFrame, as_of: datetime.date | str | None = None, days: int = RETENTION_DAYS, ts: str = "_ingest_ts") -> DataFrame:
    """Rows not older than ``days``, counted from midnight. The bound is a constant and reaches the scan."""
    day = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return df.where(F.col(ts) >= F.date_sub(day, days))


def store_by_day(df: DataFrame, path: str, ts: str = "timestamp", mode: str = "append") -> None:
    """Write one directory per UTC day, in files of even size.

    Rows are brought together by day first, or every task would write a small
    file for every day. Adaptive execution splits a day that is too large for
    one task and merges small ones.
    """
    by_day = df.withColumn("day", F.to_date(ts)).hint("rebalance", "day")
    by_day.write.mode(mode).partitionBy("day").parquet(path)


def drop_expired(
    spark: SparkSession, path: str, as_of: datetime.date | str | None = None, days: int = RETENTION_DAYS
) -> list[str]:
    """Delete the day directories older than the retention, without reading or rewriting any row."""
    today = datetime.date.fromisoformat(str(as_of)) if as_of else datetime.datetime.now(datetime.timezone.utc).date()
    oldest = (today - datetime.timedelta(days=days)).isoformat()
    gone = [name for name in subdirectories(spark, path) if _DAY.match(name) and name[len("day=") :] < oldest]
    for name in gone:
        file_system(spark, path).delete(hadoop_path(spark, f"{path}/{name}"), True)
    return gone


def _shown(name: str, tag: str, salt: str) -> Column:
    column = F.col(f"`{name}`")
    if tag == PUBLIC:
        return column
    if tag == PII:
        # Still joins and counts, but does not tell who it is.
        return F.sha2(F.concat(F.lit(salt), column.cast("string")), 256).alias(name)
    if tag == SENSITIVE:
        return F.lit(None).alias(name)
    raise ValueError(f"unknown tag: {tag}")


def masked_view(df: DataFrame, tags: dict[str, str], row_filter: str | None = None, *, salt: str) -> DataFrame:
    """Public columns as they are, personal ones hashed, sensitive ones blank.

    A column without a tag is treated as sensitive. ``row_filter`` is applied to
    the unmasked rows. ``salt`` is a secret and never empty: without one, hashes
    of values from a small range can be found out by trying.
    """
    if not salt:
        raise ValueError("hashed columns need a salt")
    visible = df if row_filter is None else df.where(row_filter)
    shown = []
    for field in df.schema:
        column = _shown(field.name, tags.get(field.name, SENSITIVE), salt)
        if tags.get(field.name, SENSITIVE) == SENSITIVE:
            column = column.cast(field.dataType).alias(field.name)
        shown.append(column)
    return visible.select(*shown)


# --- views by entitlement ---------------------------------------------------------

TAG = "tag"


def tagged(df: DataFrame, tags: dict[str, str]) -> DataFrame:
    """``df`` with its columns' tags in their metadata, which a table keeps."""
    for name, tag in tags.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, TAG: tag})
    return df


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def secured_sql(spark: SparkSession, table: str, entitlements: str, scope: str, salt: str, user: str | None = None) -> str:
    """A SELECT of the rows whose ``scope`` the user may see, columns shown by the tags in the table.

    ``entitlements``: a table (user_name, scope). The user is whoever asks, or
    the one given. Entitlements are met by a semi join, so one listed twice shows
    no row twice, and a null scope is nobody's. Columns without a tag stay blank.
    """
    if not salt:
        raise ValueError("hashed columns need a salt")
    shown = []
    for field in spark.table(table).schema:
        name = "`" + field.name.replace("`", "``") + "`"
        tag = field.metadata.get(TAG, SENSITIVE)
        if tag == PUBLIC:
            shown.append(f"t.{name}")
        elif tag == PII:
            shown.append(f"sha2(concat({_quoted(salt)}, CAST(t.{name} AS STRING)), 256) AS {name}")
        elif tag == SENSITIVE:
            shown.append(f"CAST(NULL AS {field.dataType.simpleString()}) AS {name}")
        else:
            raise ValueError(f"unknown tag: {tag}")
    who = "current_user()" if user is None else _quoted(user)
    return f"SELECT {', '.join(shown)} FROM {table} t LEFT SEMI JOIN {entitlements} e ON e.user_name = {who} AND e.scope = t.`{scope}`"


def secured_view(spark: SparkSession, view: str, table: str, entitlements: str, scope: str, salt: str) -> None:
    """``secured_sql`` as a view in the catalog: one for all users, each sees their own rows."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {secured_sql(spark, table, entitlements, scope, salt)}")
