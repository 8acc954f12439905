"""Tables by name, in three namespaces, replaced without a gap.

A published table is a view on one stored version. A new version is written whole to
a location of its own; one change of the catalog then puts it in the place of the old
one. A reader sees the old version or the new, and one that began with the old
version finishes with it, as its files stay until later versions have replaced it.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark import files

RAW, STAGING, ANALYTICS = NAMESPACES = ("raw", "staging", "analytics")
_AT = "tidemark.location"


class Publisher:
    """Writes tables under ``root`` and names them in the session's catalog."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 2) -> None:
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep
        for namespace in NAMESPACES:
            at = f"{self.root}/{namespace}"
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace} LOCATION '{at}'")

    def publish(self, df: DataFrame, namespace: str, name: str) -> DataFrame:
        """Replace ``namespace.name`` by ``df``, which may read it; returns the new table.

        A write that fails leaves the table as it was. One writer at a time a table.
        """
        if namespace not in NAMESPACES:
            raise ValueError(f"{namespace} is none of {', '.join(NAMESPACES)}")
        folder = f"{self.root}/{namespace}/{name}"
        location = f"{folder}/{uuid.uuid4().hex}"
        df.write.parquet(location)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {namespace}.`{name}` "
            f"TBLPROPERTIES ('{_AT}' = '{location}') AS SELECT * FROM parquet.`{location}`"
        )
        self._drop_old(folder, location)
        return self.spark.table(f"{namespace}.{name}")

    def location(self, namespace: str, name: str) -> str | None:
        """Where the version in force is stored; None for a table not published here."""
        if not self.spark.catalog.tableExists(f"{namespace}.{name}"):
            return None
        told = self.spark.sql(f"SHOW TBLPROPERTIES {namespace}.`{name}`").collect()
        return {r["key"]: r["value"] for r in told}.get(_AT)

    def tables(self) -> Mapping[str, DataFrame]:
        """All published tables by their full name."""
        return {
            f"{namespace}.{t.name}": self.spark.table(f"{namespace}.{t.name}")
            for namespace in NAMESPACES
            for t in self.spark.catalog.listTables(namespace)
            if t.namespace == [namespace]
        }

    def _drop_old(self, folder: str, location: str) -> None:
        """Remove versions beyond the last ``keep``, never the one in force."""
        at = files.folder(self.spark, folder)
        entries = [(e.getModificationTime(), e.getPath()) for e in at.system.listStatus(at.path)]
        entries = sorted(
            (e for e in entries if e[1].getName() != location.rpartition("/")[2]),
            key=lambda e: e[0],
            reverse=True,
        )
        for _, path in entries[max(0, self.keep - 1) :]:
            files.remove(files.Folder(at.system, path))
