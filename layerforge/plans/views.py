"""Derived views by entitlement (X7): one view, other rows and masks for each
reader.

Who may see what is data: a table of (reader, tenant, clear, mask_key). The view
joins its source with the reader's own entitlements, reduced to one row a tenant,
so the join filters the rows and decides on the masks at once. A tenant without
an entitlement is not seen, nor are rows without a tenant. Masked columns are
shown to a reader who is ``clear`` for the row's tenant; to others they are NULL,
or a digest under the reader's own key, by which the reader can join and count but
not compare with another reader.

The reader is ``current_user()`` unless told otherwise, so whoever queries the
view cannot choose. A permanent view needs a source and an entitlement table of
the catalog; a temporary one may read temporary views, too.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

ENTITLEMENTS = "reader string, tenant string, clear boolean, mask_key string"


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def view_sql(spark: SparkSession, source: str, entitlements: str, tenant_col: str, masks: Mapping[str, str],
             reader: str = "current_user()") -> str:
    """The query of the view. ``masks`` maps columns to ``null`` or ``hash``."""
    unknown = set(masks.values()) - {"null", "hash"}
    if unknown or tenant_col in masks:
        raise ValueError(f"cannot mask {tenant_col}" if not unknown else f"no such mask: {sorted(unknown)}")
    cols = []
    for f in spark.table(source).schema.fields:
        c = f"s.{_quoted(f.name)}"
        kind = masks.get(f.name)
        if kind == "null":
            cols.append(f"CASE WHEN e.clear THEN {c} END AS {_quoted(f.name)}")
        elif kind == "hash":
            cols.append(f"CASE WHEN e.clear THEN CAST({c} AS STRING) ELSE sha2(concat(e.mask_key, ':', CAST({c} AS STRING)), 256) END "
                        f"AS {_quoted(f.name)}")
        else:
            cols.append(c)
    own = (f"SELECT tenant, coalesce(bool_or(clear), false) AS clear, min(mask_key) AS mask_key FROM {_quoted(entitlements)} "
           f"WHERE reader = {reader} GROUP BY tenant")
    return (f"SELECT {', '.join(cols)} FROM {_quoted(source)} s JOIN ({own}) e "
            f"ON CAST(s.{_quoted(tenant_col)} AS STRING) = e.tenant")


def create_view(spark: SparkSession, name: str, source: str, entitlements: str, tenant_col: str, masks: Mapping[str, str],
                reader: str = "current_user()", temporary: bool = False) -> None:
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {_quoted(name)} AS {view_sql(spark, source, entitlements, tenant_col, masks, reader)}")
