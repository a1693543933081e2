"""Comparing directories, snapshots and nested records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Verdicts on two directories.
DIFFERENT, FIRST_MORE, SECOND_MORE, EQUIVALENT = "different", "first_more_complete", "second_more_complete", "equivalent"


def partition_entries(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """key and place (common, only1, only2) of the entries of two listings."""
    a, b = first.select(key).withColumn("_1", F.lit(True)), second.select(key).withColumn("_2", F.lit(True))
    place = F.when(F.col("_2").isNull(), "only1").when(F.col("_1").isNull(), "only2").otherwise("common")
    return a.join(b, key, "full_outer").select(key, place.alias("place"))


def verdict(differing: Column, only_first: Column, only_second: Column) -> Column:
    return F.when((differing > 0) | (only_first > 0) & (only_second > 0), DIFFERENT).when(only_first > 0, FIRST_MORE).when(only_second > 0, SECOND_MORE).otherwise(EQUIVALENT)


def directory_verdicts(files: DataFrame, directory: str, name: str, content: str) -> DataFrame:
    """first, second, verdict for each two directories that follow each other in the order of their names.

    A file takes part as one of the first and as one of the second directory of a pair, so files meet by pair and name in
    one shuffle and nothing is joined with itself. Directories, unlike files, are few: their order is one window.
    """
    f = files.select(F.col(directory).alias("_d"), F.col(name).alias("_n"), F.col(content).alias("_c"))
    order = Window.orderBy("_d")
    listed = f.select("_d").distinct().select("_d", F.lag("_d").over(order).alias("_before"), F.lead("_d").over(order).alias("_after"))
    roles = F.array(F.struct(F.col("_d").alias("first"), F.col("_after").alias("second")), F.struct(F.col("_before").alias("first"), F.col("_d").alias("second")))
    dealt = f.join(listed, "_d").select(F.col("_d"), "_n", "_c", F.explode(roles).alias("_p")).filter("_p.first IS NOT NULL AND _p.second IS NOT NULL")
    mine, theirs = F.col("_d") == F.col("_p.first"), F.col("_d") == F.col("_p.second")
    met = dealt.groupBy(F.col("_p.first").alias("first"), F.col("_p.second").alias("second"), "_n").agg(
        F.count(F.when(mine, 1)).alias("n1"), F.count(F.when(theirs, 1)).alias("n2"), F.max(F.when(mine, F.col("_c"))).alias("c1"), F.max(F.when(theirs, F.col("_c"))).alias("c2")
    )
    both = (F.col("n1") > 0) & (F.col("n2") > 0)
    counts = met.groupBy("first", "second").agg(F.count(F.when(both & ~F.col("c1").eqNullSafe(F.col("c2")), 1)).alias("differing"), F.count(F.when(F.col("n2") == 0, 1)).alias("only1"), F.count(F.when(F.col("n1") == 0, 1)).alias("only2"))
    return counts.select("first", "second", verdict(F.col("differing"), F.col("only1"), F.col("only2")).alias("verdict"))


def pending(available: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Keys without an output yet; the newest is held back, as it may still grow."""
    newest = available.agg(F.max(key).alias("_newest"))
    return available.select(key).distinct().join(done.select(key).distinct(), key, "left_anti").join(newest, F.col(key) < F.col("_newest")).select(key)


def cull_runs(snapshots: DataFrame, keys: list[str], order: str, content: str) -> DataFrame:
    """With `kept`: of each run of equal consecutive snapshots the first and the last stay, those between go."""
    w = Window.partitionBy(*keys).orderBy(order)
    before, after = F.lag(content).over(w), F.lead(content).over(w)
    same = lambda x: x.isNotNull() & (x == F.col(content))
    return snapshots.withColumn("kept", ~(same(before) & same(after)))


def cull_fold(steps: Column) -> Column:
    """Which snapshots of an ordered array of (id, verdict on the previous one) go: an array of ids.

    equivalent: of the run the middle goes; first_more_complete (the previous one has more): the current one goes;
    second_more_complete: the previous one, and the run's first, go; different: a new run begins.
    """
    start = F.struct(F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("prev"), F.array().cast("array<long>").alias("gone"))

    def step(s: Column, x: Column) -> Column:
        new = lambda first, prev, gone: F.struct(first.alias("first"), prev.alias("prev"), gone.alias("gone"))
        middle = F.when(s["prev"].isNotNull() & (s["prev"] != s["first"]), F.array_append(s["gone"], s["prev"])).otherwise(s["gone"])
        return (
            F.when(s["first"].isNull() | (x["verdict"] == DIFFERENT), new(x["id"], x["id"], s["gone"]))
            .when(x["verdict"] == EQUIVALENT, new(s["first"], x["id"], middle))
            .when(x["verdict"] == FIRST_MORE, new(s["first"], s["prev"], F.array_append(s["gone"], x["id"])))
            .otherwise(new(x["id"], x["id"], F.array_union(F.array_append(s["gone"], s["prev"]), F.array(s["first"]))))
        )

    return F.aggregate(steps, start, step, lambda s: s["gone"])


_ENTRY = "struct<path:string,value:string,kind:string>"


def _leaves(kind: T.DataType, column: Column, path: Column) -> list[Column]:
    """Arrays of (path, value, kind) of every field below, whatever structs, arrays and maps it lies in."""
    entry = lambda p, v, k: F.struct(p.alias("path"), v.cast("string").alias("value"), F.lit(k).alias("kind"))
    null = F.array(entry(path, F.lit(None), "null"))
    within = lambda of, value, name: F.concat(*_leaves(of, value, F.concat(path, F.lit("["), name.cast("string"), F.lit("]"))))
    if isinstance(kind, T.StructType):
        own = F.when(column.isNull(), null).otherwise(F.array().cast(f"array<{_ENTRY}>"))
        return [own, *(x for f in kind.fields for x in _leaves(f.dataType, column[f.name], F.concat(path, F.lit(f".{f.name}"))))]
    if isinstance(kind, T.ArrayType | T.MapType):
        own = F.when(column.isNull(), null).otherwise(F.array(entry(F.concat(path, F.lit(".length")), F.size(column), "length")))
        if isinstance(kind, T.ArrayType):
            return [own, F.flatten(F.transform(F.coalesce(column, F.array().cast(kind)), lambda v, i: within(kind.elementType, v, i)))]
        return [own, F.flatten(F.transform(F.map_entries(F.coalesce(column, F.create_map().cast(kind))), lambda e: within(kind.valueType, e["value"], e["key"])))]
    return [F.array(entry(path, column, "value"))]


def flatten(df: DataFrame, key: str) -> DataFrame:
    """key, path, value, kind: a row for each field below the other columns; a null container differs from an empty one."""
    parts = [x for f in df.schema.fields if f.name != key for x in _leaves(f.dataType, F.col(f.name), F.lit(f.name))]
    return df.select(key, F.explode(F.concat(*parts)).alias("_e")).select(key, "_e.*")


def deep_diff(first: DataFrame, second: DataFrame, key: str, ignore: Sequence[str] = ()) -> DataFrame:
    """key, path, kind (missing, extra, length, value), v1, v2: where records of the same key differ, field by field.

    ignore: regular expressions of whole paths that may differ, as in `stops\\[\\d+\\]\\.title`.
    """
    a = flatten(first, key).select(key, "path", F.col("value").alias("v1"), F.col("kind").alias("k1"))
    b = flatten(second, key).select(key, "path", F.col("value").alias("v2"), F.col("kind").alias("k2"))
    kind = F.when(F.col("k1").isNull(), "extra").when(F.col("k2").isNull(), "missing").when(F.col("k1") == "length", "length").otherwise("value")
    both = a.join(b, [key, "path"], "full_outer").filter(F.col("k1").isNull() | F.col("k2").isNull() | ~F.col("v1").eqNullSafe(F.col("v2")))
    if ignore:
        both = both.filter(~F.col("path").rlike("|".join(f"^(?:{p})$" for p in ignore)))
    return both.select(key, "path", kind.alias("kind"), "v1", "v2")
