"""Connected components of a table of links, by contraction; nothing but a flag reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, written


def components(links: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) of every id in links (a, b).

    In each round every node joins its smallest neighbour, if that is smaller, and the links are mapped to the nodes
    joined; rounds are logarithmic in the longest path in practice. A hub with very many links is summed by partial
    minima, and its rows in the joins stand in plain exchanges, which Spark may split. Rounds are written tables."""
    spark = links.sparkSession
    both = links.where("a <> b")
    with Scratch(spark) as rounds:
        edges = written(both.select("a", "b").union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
        labels = None
        while not edges.isEmpty():
            with Scratch(spark) as scratch:
                step = written(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")), "cc-step")
                if labels is None:
                    new = step.select(F.col("a").alias("id"), F.col("to").alias("component"))
                else:
                    moved = labels.join(step, labels["component"] == step["a"], "left")
                    new = moved.select("id", F.coalesce("to", "component").alias("component"))
                left, right = step.select(F.col("a"), F.col("to").alias("ta")), step.select(F.col("a").alias("b"), F.col("to").alias("tb"))
                mapped = edges.join(left, "a").join(right, "b").where("ta <> tb").select(F.col("ta").alias("a"), F.col("tb").alias("b")).distinct()
                labels, edges = scratch.keep(written(new, "cc-labels")), scratch.keep(written(mapped, "cc-edges"))
        if labels is None:
            kind = links.schema["a"].dataType
            return spark.createDataFrame([], "id long, component long").select(F.col("id").cast(kind).alias("id"), F.col("component").cast(kind).alias("component"))
        return rounds.keep(labels)
