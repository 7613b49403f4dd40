"""Connected components of a link table, by smallest labels that spread along links and jump along themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``id, label`` for every end of a link ``a, b`` (long): the smallest id that it reaches.

    Each round takes the least label of a node's neighbours, then the label of its label, and is written to shared storage.
    A node with very many links is combined before each shuffle. No links give no rows.
    """
    both = scratch.keep(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{name}-links")
    labels = scratch.keep(both.groupBy("a").agg(F.min("b").alias("least")).select(
        F.col("a").alias("id"), F.least("a", "least").alias("label")
    ), f"{name}-0")
    step = 0
    while True:
        step += 1
        heard = (
            both.join(labels.select(F.col("id").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("label").alias("heard"))
        )
        spread = labels.join(heard, "id").select("id", F.col("label").alias("old"), F.least("label", "heard").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("label").alias("further"))
        new = scratch.keep(
            spread.join(jump, "next").select("id", "old", F.least("next", "further").alias("label")), f"{name}-{step}"
        )
        scratch.drop(f"{name}-{step - 1}")
        labels = new.select("id", "label")
        if new.where("label != old").isEmpty():
            scratch.drop(f"{name}-links")
            return labels
