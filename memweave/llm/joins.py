"""Anti-join on ids that broadcasts only a counted, bounded id table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ids are broadcast up to this many (8 bytes each); beyond it the join shuffles.
BROADCAST_IDS = 2_000_000


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is not in ``ids`` (one column; should be a written table, it is counted first). Rows with a null id stay."""
    own = ids.toDF("_gone").distinct()
    small = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(own) if small else own, F.col(f"`{id_col}`") == F.col("_gone"), "left_anti")
