"""Connected components of a table of links, in chunks and by alternating stars.

Links are dealt into chunks of a bounded number, and each chunk is contracted
where it lies: of every group of nodes it connects, each node is linked with the
smallest.  That leaves at most one link per node and chunk.  A table of one
chunk is solved by then; otherwise rounds of stars follow.  Each round points the larger neighbours of a node at its smallest neighbour
(large star), then the node and its smaller neighbours at the smallest of them
(small star).  The number of rounds grows with the logarithm of the links; a
node's neighbours are never listed, only their minimum is aggregated.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import column, materialise, release_state

#: Links of a chunk.
CHUNK = 250_000


def contracted(links: Iterator[tuple]) -> Iterator[tuple]:
    """(node, smallest node it is connected with) of every node but the smallest ones."""
    above: dict = {}

    def top(x):
        while (y := above.get(x, x)) != x:
            above[x] = x = above.get(y, y)
        return x

    for a, b in links:
        a, b = top(a), top(b)
        if a != b:
            above[max(a, b)] = min(a, b)
    for x in list(above):
        yield x, top(x)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a partition contracted, ``CHUNK`` at a time."""
    release_state()
    held: list[tuple] = []
    kind = None

    def out() -> pa.RecordBatch:
        found = list(contracted(iter(held)))
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], kind) for i in range(2)], ["a", "b"])

    for batch in batches:
        kind = batch.schema.field("a").type
        held += zip(column(batch, "a").to_pylist(), column(batch, "b").to_pylist())
        if len(held) >= CHUNK:
            yield out()
            held = []
    if held:
        yield out()


def _star(links: DataFrame, large: bool) -> DataFrame:
    both = links.select("a", "b")
    if large:
        both = both.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # small star: links point from the larger node to smaller ones already
    lowest = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(lowest, "a")
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            lowest.select("a", F.col("m").alias("b"))
        )
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; component: its smallest node.

    ``links``: columns ``a`` and ``b`` of one orderable type, any direction,
    repeats and loops allowed.
    """
    links = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = materialise(links, "links")
    chunks = max(1, -(-links.count() // CHUNK))
    links = materialise(links.coalesce(chunks).mapInArrow(_chunks, links.schema), "links")
    state = None
    while chunks > 1:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
        links = materialise(_star(_star(links, large=True), large=False), "links")
    roots = links.select(F.col("b").alias("a")).distinct()
    return links.unionByName(roots.select("a", F.col("a").alias("b"))).select(
        F.col("a").alias("node"), F.col("b").alias("component")
    )
