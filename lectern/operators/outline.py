"""Course outlines: blocks in reading order with parent and path, orphans and blocks with several parents marked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.sinks import written


def edges_of(courses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """blocks (course_id, block_id, block_type, display_name, is_root) and edges (course_id, parent, child, at)."""
    b = courses.select("course_id", "root", F.explode("blocks").alias("block_id", "b"))
    blocks = b.select("course_id", "block_id", F.col("b.type").alias("block_type"), F.col("b.display_name").alias("display_name"), (F.col("block_id") == F.col("root")).alias("is_root"))
    return blocks, b.select("course_id", F.col("block_id").alias("parent"), F.posexplode("b.children").alias("at", "child"))


#: What stands between the names of a path, and what marks blocks without a way from the root.
DELIMITER, DELETED = " / ", "(Deleted block :)"


def course_outline(blocks: DataFrame, edges: DataFrame, orphans_first: bool = False) -> DataFrame:
    """sort_idx (pre-order from 0), parent, course_path, is_root, is_orphan, is_dag for each block.

    The path is the names of the blocks above, from the root; the root's is empty. A block is a dag block if more than
    one way leads to it from blocks that are reached, the root's own place counted. One join a level, until no block is
    left below; of several ways to a block on a level the first in reading order is kept, so shared parts of the tree
    do not multiply, and a way that comes back to itself ends. Orphans stand after all blocks, or before them at -1.
    """
    names = blocks.select("course_id", F.col("block_id").alias("child"), "display_name")
    front = blocks.where("is_root").select("course_id", "block_id", F.array().cast("array<int>").alias("place"), F.lit(None).cast("string").alias("parent"), F.array().cast("array<string>").alias("names"), F.array("block_id").alias("way"), F.col("display_name").alias("name"))
    seen = front
    steps = edges.join(names, ["course_id", "child"]).select("course_id", F.col("parent").alias("_p"), "child", "at", F.col("display_name").alias("_name"))
    while True:
        to = front.withColumnRenamed("course_id", "_c").join(steps, (F.col("_c") == F.col("course_id")) & (F.col("block_id") == F.col("_p"))).where(~F.array_contains("way", F.col("child")))
        to = to.select("course_id", "child", F.struct(F.array_append("place", F.col("at")).alias("place"), F.col("_p").alias("parent"), F.array_append("names", F.col("name")).alias("names"), F.array_append("way", F.col("child")).alias("way"), F.col("_name").alias("name")).alias("x"))
        front = written(to.groupBy("course_id", "child").agg(F.min("x").alias("x")).select("course_id", F.col("child").alias("block_id"), "x.*"))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    first = seen.groupBy("course_id", "block_id").agg(F.min(F.struct("place", "parent", "names")).alias("x"))
    visits = edges.join(first.select("course_id", F.col("block_id").alias("parent")), ["course_id", "parent"]).groupBy("course_id", F.col("child").alias("block_id")).agg(F.count("*").alias("visits"))
    df = blocks.join(first, ["course_id", "block_id"], "left").join(visits, ["course_id", "block_id"], "left")
    orphan = F.col("x").isNull()
    order = F.row_number().over(W.partitionBy("course_id").orderBy(F.col("x").isNull(), F.col("x.place"))) - 1
    count = F.sum(F.lit(1)).over(W.partitionBy("course_id"))
    return df.select(
        "course_id", "block_id", "block_type", "display_name", F.col("x.parent").alias("parent_block_id"), F.when(orphan, F.lit(-1) if orphans_first else count.cast("int")).otherwise(order).alias("sort_idx"),
        F.when(orphan, DELETED).otherwise(F.array_join("x.names", DELIMITER)).alias("course_path"), "is_root", orphan.alias("is_orphan"), (~orphan & (F.coalesce("visits", F.lit(0)) + F.col("is_root").cast("int") > 1)).alias("is_dag"),
    )
