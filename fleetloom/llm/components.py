"""Connected components of a table of links, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, materialise


def connected_components(links: DataFrame) -> DataFrame:
    """links(a, b) of long ids -> id, component for every id in a link; component is the smallest id reachable.

    In each round every vertex hooks to its smallest neighbour if that is smaller, trees are shortened by one jump, and
    links are renamed to what their ends hooked to; self-links and repeats go. Hooks only lead to smaller ids, so there are no
    cycles, a merged vertex bears the smallest id of those in it, and at least half of the vertices that still have links
    vanish in a round. Each round is a written table: a lost executor repeats one round at most. Empty links give no row.
    """
    links = materialise(links.select("a", "b").filter("a <> b").distinct(), "links")
    rounds: list[DataFrame] = []
    while not links.isEmpty():
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("to"))
        next_up = hooks.select(F.col("id").alias("to"), F.col("to").alias("up"))
        jumped = materialise(hooks.join(next_up, "to").select("id", F.col("up").alias("to")), "jumped")
        rounds.append(jumped)
        end = lambda c: jumped.select(F.col("id").alias(c), F.col("to").alias(f"{c}_to"))  # noqa: E731, B023
        left = links.join(end("a"), "a").join(end("b"), "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
        fewer = materialise(left.filter("a <> b").distinct(), "links")
        drop_table(links)
        links = fewer
    drop_table(links)
    if not rounds:
        return links.sparkSession.createDataFrame([], "id long, component long")
    # What a vertex of the first round was called after the last: the rounds' tables shrink by half at least, and there are few.
    names = rounds[0].select("id", F.col("to").alias("component"))
    for jumped in rounds[1:]:
        up = jumped.select(F.col("id").alias("component"), F.col("to").alias("up"))
        names = names.join(up, "component", "left").select("id", F.coalesce("up", "component").alias("component"))
    names = materialise(names, "components")
    for jumped in rounds:
        drop_table(jumped)
    return names
