"""Periodic refresh of decisions: every new file is taken in once, the newest version of a number wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def latest(versions: DataFrame, key: str = "application_number") -> DataFrame:
    """The newest version of each number, the last row among equals. Versions are combined on the map side."""
    rest = [c for c in versions.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct("published_at", "row_idx"))
    return versions.groupBy(key).agg(newest.alias("v")).select(key, "v.*")


def refresh(incoming: DataFrame, table_path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append incoming versions to the table of versions, exactly once.

    Without ``every`` the query takes in what is there and ends; with it (``1 hour``) it keeps looking for new
    files. Readers apply ``latest`` to the table, so no version is rewritten in place.
    """
    writer = incoming.writeStream.format("parquet").option("path", table_path).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.outputMode("append").trigger(**trigger).start()
