"""Connected components of an edge table by alternating star contractions.

The two contractions are those of Kiveris et al., "Connected Components in
MapReduce and Beyond" (2014). Each round is two joins with small rows; the
number of rounds grows with the logarithm of the longest path. A table of few edges
is solved by one task, whose memory that bound limits, without any rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from claimforge.session import materialize


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Link the neighbours of each node to the least node among them and itself.

    ``larger_only`` rewires neighbours above the node (large star), else those
    below it and the node itself (small star).
    """
    if larger_only:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if larger_only:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where(F.col("u") != F.col("v")).distinct()


def _of_few(edges: DataFrame) -> DataFrame:
    """The components of an edge table ``(u, v)`` that one task can hold."""
    kind = edges.schema["u"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict = {}

        def root(x):
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(up.setdefault(u, u)), root(up.setdefault(v, v))
                up[max(a, b)] = min(a, b)
        nodes, of = list(up), to_arrow_type(kind)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, of), pa.array(map(root, nodes), of)], ["node", "component"])

    return edges.coalesce(1).mapInArrow(run, T.StructType([T.StructField("node", kind), T.StructField("component", kind)]))


def connected_components(edges: DataFrame, left: str = "u", right: str = "v", max_rounds: int = 50, few: int = 20_000) -> DataFrame:
    """Rows ``(node, component)`` for every node that has an edge to another node.

    ``component`` is the least node of the connected component. Self loops and
    rows with a null end are ignored, repeated edges count once; an empty table
    gives an empty result. Each round's edges are written to the shared folder; up to ``few``
    edges need no rounds.
    """
    now = materialize(
        edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("u") != F.col("v")))
        .distinct(),
        "edges",
    )
    if now.count() <= few:
        return _of_few(now)
    was = None
    for _ in range(max_rounds):
        now = materialize(_star(_star(now, True), False), "edges")
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == was:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v"), F.col("v")).distinct()
            )
        was = mark
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
