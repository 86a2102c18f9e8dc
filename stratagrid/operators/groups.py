"""Running small numpy steps on whole groups of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by ``keys`` over all shuffle partitions.

    Python steps are bound by CPU, not by bytes; a stated partition count keeps adaptive
    execution from merging them into few tasks, and the grouping that follows reuses it.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Re-cut batches of rows sorted by ``keys`` so that no group is split."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        last = batch[keys].iloc[-1]
        if held and not (held[-1][keys].iloc[-1] == batch[keys].iloc[0]).all():
            yield pd.concat(held, ignore_index=True)
            held = []
        open_group = (batch[keys] == last).all(axis=1)
        if open_group.all():
            held.append(batch)
        else:
            yield pd.concat(held + [batch[~open_group]], ignore_index=True)
            held = [batch[open_group]]
    if held:
        yield pd.concat(held, ignore_index=True)


def map_groups(df: DataFrame, keys: list[str], step: Callable[[pd.DataFrame], pd.DataFrame],
               schema, is_spread: bool = False) -> DataFrame:
    """Apply ``step`` to batches that hold one or more whole groups.

    For many small groups this costs one vectorised call per Arrow batch instead of one call
    per group; no task holds more than one batch and one group.  ``is_spread`` says that ``df``
    already is partitioned by ``keys``.
    """
    def run(batches):
        for cells in whole_groups(batches, keys):
            yield step(cells)

    return (df if is_spread else spread(df, *keys)).sortWithinPartitions(*keys).mapInPandas(run, schema)
