"""I-Match fingerprints over randomised lexicon subsets, with DataFrame operations only.

A text's terms are its distinct lower-case words. The lexicon has the terms within a band of inverse document frequency, counted over all
documents; terms are counted by hash slot, so the lexicon is a bitmap of fixed size whatever the vocabulary, and the band's lower document share
stands far above what rare terms add to a slot. The sorted in-band terms are hashed as a whole and for several randomised subsets of the lexicon, at a few
rates: a subset of rate p holds each term with probability p. A changed term changes the hashes of the subsets that hold it; the
rates let texts of ten and of ten thousand terms both have subsets with a term or two, of which an edit leaves its share alone.

The likeness of two fingerprints is 1 where the whole hashes agree, else the share of equal hashes among the subsets that are not empty on both sides, at
the sparsest rate that has enough of them.

Defined results: null text is the empty text; a text without in-band terms uses all its terms, one without terms has the fingerprint of nothing, which is
like itself only; rows of a repeated id follow each other in the order of a text hash; null ids come last; a single row is its own next;
an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions

#: Band of the inverse document frequency, ln(documents / documents with the term).
IDF_BAND = (math.log(8), math.log(1000))
SLOTS = 1 << 20
#: Rates of the subsets are 1/16, 1/64, 1/256 and 1/1024, with sixteen subsets each.
LEVELS, SUBSETS = 4, 16
#: Bytes of text in a bucket of neighbours, about; rows from which on one id may be cut into several buckets.
BUCKET_BYTES, HOT_ROWS = 4 << 20, 1_000
#: Subsets of a rate that must not be empty for the rate to judge.
ENOUGH = 8


def _terms(text: Column) -> Column:
    """Hashes of the distinct words."""
    words = F.split(F.replace(F.lower(text), F.lit("\n"), F.lit(" ")), " ")
    return F.transform(F.array_except(F.array_distinct(words), F.array(F.lit(""))), lambda w: F.xxhash64(w))


def _slot(term: Column) -> Column:
    return F.pmod(term, F.lit(SLOTS)).cast("int")


def lexicon(docs: DataFrame, idf_band: tuple[float, float] = IDF_BAND) -> list[int]:
    """The in-band slots as a bitmap of SLOTS bits in 64-bit numbers; from all rows of docs(text)."""
    n = docs.count()
    slots = docs.select(F.explode(F.array_distinct(F.transform(_terms(F.coalesce("text", F.lit(""))), _slot))).alias("slot"))
    low, high = n * math.exp(-idf_band[1]), n * math.exp(-idf_band[0])
    held = slots.groupBy("slot").count().filter((F.col("count") >= low) & (F.col("count") <= high))
    # SLOTS / 64 numbers at most, whatever the documents.
    words = held.groupBy(F.shiftright("slot", 6).alias("number")).agg(F.bit_or(F.expr("shiftleft(1L, slot & 63)")).alias("bits")).collect()
    out = [0] * (SLOTS // 64)
    for r in words:
        out[r.number] = r.bits
    return out


def _fingerprint(df: DataFrame, sources: dict[str, str], bitmap: list[int]) -> DataFrame:
    """df with, for each name: text column of sources, the array of hashes; the text columns go."""
    # A constant of fixed size.
    bits = F.split(F.lit(",".join(map(str, bitmap))), ",").cast("array<bigint>")
    kept = [c for c in df.columns if c not in sources.values()]
    step = df.select(*kept, *(_terms(F.col(c)).alias(f"{name}_all") for name, c in sources.items()))

    def banded(c: str) -> Column:
        return F.filter(c, lambda t: F.getbit(F.get(bits, F.shiftright(_slot(t), 6)), _slot(t).bitwiseAND(63)) == 1)

    step = step.select(*kept, *(f"{n}_all" for n in sources), *(banded(f"{n}_all").alias(f"{n}_band") for n in sources))
    step = step.select(*kept, *(F.sort_array(F.when(F.size(f"{n}_band") > 0, F.col(f"{n}_band")).otherwise(F.col(f"{n}_all"))).alias(f"{n}_l0") for n in sources))
    # Bits above the slot's decide: two for whether a level holds the term.
    low = SLOTS.bit_length() - 1
    mix = lambda t: F.xxhash64(t, F.lit(3))
    bits_are = lambda at, mask, value: lambda t: F.shiftright(mix(t), at).bitwiseAND(mask) == value
    for level in range(1, LEVELS):
        step = step.select("*", *(F.filter(f"{n}_l{level - 1}", bits_are(low + 2 * (level - 1), 3, 0)).alias(f"{n}_l{level}") for n in sources))

    def hashed(c: Column) -> Column:
        return F.when(F.size(c) > 0, F.xxhash64(c))

    def parts(n: str) -> list[Column]:
        out = [hashed(F.col(f"{n}_l0"))]
        for level in range(LEVELS):
            for k in range(SUBSETS):
                # A level's own bits, so that its subsets don't follow those of another.
                out.append(hashed(F.filter(f"{n}_l{level}", bits_are(4 * level, SUBSETS - 1, k))))
        return out

    return step.select(*kept, *(F.array(*parts(n)).alias(n) for n in sources))


def likeness(a: str, b: str) -> Column:
    """Likeness of two arrays of hashes."""
    at = lambda c, i: F.get(F.col(c), F.lit(i))
    same = at(a, 0).eqNullSafe(at(b, 0))
    result = F.lit(None).cast("double")
    for level in range(LEVELS):  # the sparsest that has enough decides
        places = range(1 + level * SUBSETS, 1 + (level + 1) * SUBSETS)
        any_ = sum(F.when(at(a, i).isNotNull() | at(b, i).isNotNull(), 1).otherwise(0) for i in places)
        both = sum(F.when(at(a, i) == at(b, i), 1).otherwise(0) for i in places)
        enough = ENOUGH if level else 1
        result = F.when(any_ >= enough, both / any_).otherwise(result)
    return F.when(same, 1.0).otherwise(F.coalesce(result, F.lit(0.0)))


def as_text(c: str) -> Column:
    """A fingerprint as text: the hashes in hex, a dash for an empty subset."""
    return F.array_join(F.transform(c, lambda x: F.coalesce(F.lower(F.hex(x)), F.lit("-"))), " ")


def fingerprints(docs: DataFrame, bitmap: list[int] | None = None) -> DataFrame:
    """docs(doc_id, text) -> doc_id, fingerprint: one row each."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return _fingerprint(rows, {"hashes": "text"}, bitmap or lexicon(rows)).select("doc_id", as_text("hashes").alias("fingerprint"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bitmap = lexicon(rows)
    # Neighbours by id without one global order: ids are cut into buckets at quantiles, and the first row of each bucket is also dealt to the bucket before it.
    # There are as many buckets as keep their texts near BUCKET_BYTES; an id, or no id, with more rows than two buckets should have is cut by the hash that orders its rows.
    rows = rows.withColumn("h", F.xxhash64("text"))
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    n = max(8 * shuffle_partitions(spark), size.bytes // BUCKET_BYTES + 1)
    cuts = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n)).first()[0] or []
    many = max(HOT_ROWS, 2 * size.n // n)
    # At most n / 2 ids have that many rows. Each gets a place of its own.
    hot = {r.doc_id: -(-r.n // many) for r in rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter(F.col("n") > many).collect()}
    cuts = sorted({*cuts, *(c for i in hot if i is not None for c in (i - 1, i) if c >= -(1 << 63))})
    parts = [hot.get(None, 1), *(hot.get(c, 1) for c in cuts), 1]  # of each place: no id, up to each cut, beyond
    first = [sum(parts[:i]) for i in range(len(parts))]

    def pick(values: list[int | None], at: Column) -> Column:
        """The value of this number; no value is null."""
        return F.get(F.split(F.lit(",".join("x" if v is None else str(v) for v in values)), ","), at).try_cast("bigint")

    # Found in two steps of about the square root of the cuts: which run of them, then where in it.
    m = math.isqrt(len(cuts)) + 1
    runs = [cuts[i : i + m] for i in range(0, len(cuts), m)]
    below = lambda a: F.size(F.filter(a, lambda b: b < F.col("doc_id")))
    longs = lambda x, kind: F.from_json(F.lit(json.dumps(x)), kind)
    run = below(longs([r[-1] for r in runs], "array<bigint>"))
    place = F.when(F.col("doc_id").isNull(), 0).otherwise(F.least(run * m + F.coalesce(below(F.get(longs(runs, "array<array<bigint>>"), run)), F.lit(0)), F.lit(len(cuts))) + 1)
    # The hash as a share of its range: greater hashes are in later parts.
    share = (F.col("h").cast("double") + float(1 << 63)) / float(1 << 64)
    k = pick(parts, place)
    rows = rows.withColumn("bucket", (pick(first, place) + F.least(F.floor(share * k), k - 1)).cast("int"))
    # A row for each bucket; rows that agree in id and hash are equal.
    heads = rows.groupBy("bucket").agg(F.max(F.struct("doc_id", "h")).alias("head")).orderBy(F.desc("bucket")).collect()
    to = {r.bucket: heads[i - 1].bucket for i, r in enumerate(heads)}
    head = {r.bucket: r.head for r in heads}
    span = range(sum(parts))
    of = lambda name: pick([head[b][name] if b in head else None for b in span], F.col("bucket"))
    is_head = F.col("doc_id").eqNullSafe(of("doc_id")) & (F.col("h") == of("h"))
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("extra"))
    also = F.struct(pick([to.get(b, b) for b in span], F.col("bucket")).cast("int").alias("bucket"), F.lit(True).alias("extra"))
    dealt = rows.withColumn("place", F.explode(F.when(is_head, F.array(own, also)).otherwise(F.array(own)))).select("place.*", "doc_id", "text", "h")
    order = Window.partitionBy("bucket").orderBy("extra", F.col("doc_id").desc_nulls_last(), F.desc("h"))
    dealt = dealt.withColumn("next", F.lead("text").over(order))
    n_chars = F.length("text")
    third = F.floor(n_chars / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n_chars - third), F.substring(F.coalesce("next", F.lit("")), F.lit(1), third))
    dealt = dealt.select("bucket", "extra", "doc_id", "h", n_chars.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    dealt = dealt.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    dealt = _fingerprint(dealt, {"own": "text", "changed": "edited"}, bitmap)
    dealt = dealt.withColumn("following", F.lead("own").over(order)).filter("NOT extra")
    return dealt.select(
        "doc_id", "n_chars", "edited_sha256", as_text("own").alias("fingerprint"), as_text("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"), likeness("own", "following").alias("near_next"),
    )
