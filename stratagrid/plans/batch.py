"""Plan the next batch of points against the ledger and the tile index."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stratagrid.operators.joins import locate
from stratagrid.operators.ledger import next_batch, pending, status_rows
from stratagrid.scratch import materialize


def plan_batch(candidates: DataFrame, ledger: DataFrame, tiles: DataFrame, batch_size: int,
               size: float, store: str = "store", shade_folder: str = "shade") -> DataFrame:
    """Ledger rows of the next ``batch_size`` unused candidates, each with its tile or out of bounds."""
    candidates = materialize(candidates)  # paging reads the list more than once
    batch = pending(next_batch(candidates, ledger, batch_size), ledger)
    return status_rows(batch, locate(batch, tiles, size), store, shade_folder)
