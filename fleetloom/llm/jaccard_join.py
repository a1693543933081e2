"""Exact n-gram Jaccard self-join by T-occurrence search (DivideSkip), and the classes it links.

A document's set holds its distinct five-word shingles as 64-bit hashes. The join is exact up to collisions of these hashes:

1. Documents with equal sets form one class, known by a hash of the set; what follows works on classes.
2. A set in hash order shows its first P elements. Two sets of n and m elements that reach the threshold share at least
   L(n, m) of them (prefix filter), so elements that no other set shows fall away, and with them every set that has fewer
   than L left. That leaves near copies; a passage that many documents share doesn't suffice.
3. The remaining elements of a set, rarest first, give s - L + 1 keys, of which two linked sets share one.
4. Under each key the others are compared to a leader, the smallest class. A group of copies mostly links with it, so this costs a comparison
   for each copy, not for each pair. Keys whose sets are now in one component are done.
5. What is still open meets under the leaders: any two sets that share an open key share its leader a. With D = x xor a and A = a - x, two sets overlap by
   |a| - |A_x| - |A_y| + |D_x ∩ D_y|, so only the short differences have to be searched, by those sets that the leader's component doesn't hold yet.
6. Both searches are T-occurrence searches: inverted lists of elements are divided by DivideSkip, the short ones merged by a heap, the long ones probed by
   binary search, and candidates stay that reach the number of common elements that the threshold asks of them.

Defined results: null text is the empty text; a text of fewer than five words has its word sequence as one shingle; a text without words
has an empty set and links with nothing; repeated rows and ids give a row each; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_table, forget, fresh_names, materialise, materialise_bucketed, ship, shuffle_partitions, worker_memory
from .components import connected_components

WORDS = 5
#: Similarity 3/4: 100 |A∩B| >= 75 |A∪B|, which is 7 |A∩B| >= 3 (|A| + |B|).
NUM, DEN = 3, 4
#: Elements shown: all of a set of MIN_SHOWN, else a share of SHOWN.
MIN_SHOWN, SHOWN = 128, 0.33
#: Candidates that one search against a leader compares; members and queries of a block of differences.
CHUNK, MEMBERS, QUERIES = 256, 2_048, 1_024
#: Shares of the rows that show a hot key, in all and in one task; rows at least.
HOT, HOT_HERE, HOT_LEAST = 0.002, 0.01, 64
#: Bits of the fixed-size filter that spares unconcerned documents from being cut into shingles again.
FILTER_BITS = 1 << 24
DROP_BITS = 1 << 22
#: DivideSkip's tuning constant for the number of long lists.
MU = 0.01
MAX_WORDS = 150_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Shingler:
    """Sorted 64-bit shingle sets of texts; distinct words are hashed once."""

    def __init__(self) -> None:
        from xxhash import xxh3_64_intdigest

        self.known: dict[bytes, int] = {}
        self.hash = xxh3_64_intdigest

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        # bytes.lower() and bytes.split() mean A-Z and the white space \x20 \x09-\x0D.
        split = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
        if len(self.known) > MAX_WORDS:
            self.known.clear()
        known, digest = self.known, self.hash
        for w in set().union(*split) - known.keys():
            known[w] = digest(w)
        counts = [len(s) for s in split]
        words = np.fromiter((known[w] for s in split for w in s), np.uint64, sum(counts))
        out, at = [], 0
        if len(words) >= WORDS:
            rolled = words[: len(words) - WORDS + 1].copy()
            for k in range(1, WORDS):
                rolled = rolled * _ODD + words[k : len(words) - WORDS + 1 + k]
            rolled = _mix(rolled)
        for n in counts:
            if n >= WORDS:
                out.append(np.unique(rolled[at : at + n - WORDS + 1]))
            elif n:
                h = np.uint64(n)
                with np.errstate(over="ignore"):
                    for w in words[at : at + n]:
                        h = h * _ODD + w
                    out.append(_mix(np.array([h * _ODD], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
            at += n
        return out


def _shingler() -> Shingler:
    return worker_memory("shingler", Shingler)


def shown(n: int) -> int:
    """How many elements a set of n shows."""
    return min(n, max(MIN_SHOWN, -int(-n * SHOWN // 1)))


def _sure(n: int) -> int:
    """What it surely shares within its shown elements, if its partner shows as deep: P - (n - least overlap)."""
    return shown(n) - (n - -(-n * NUM // DEN))


@lru_cache(1 << 16)
def needed(n: int) -> int:
    """The least that a set of n shares with any linked set among the shown elements of both."""
    low, high = -(-n * NUM // DEN), n * DEN // NUM
    turn = int(MIN_SHOWN / SHOWN)
    return max(1, min(_sure(m) for m in {low, n, high, *(min(max(t, low), high) for t in (MIN_SHOWN, MIN_SHOWN + 1, turn - 1, turn, turn + 1))}) - 1)


def _runs(texts: list[str], most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, len(texts)


def _signature(s: np.ndarray) -> int:
    return int(np.array([_shingler().hash(s.tobytes())], np.uint64).view(np.int64)[0])


def _keyed(docs: DataFrame) -> DataFrame:
    """text (null as empty), ref, which is never null (the id or, without one, a hash of the text), and has_id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.select("text", F.coalesce("doc_id", F.xxhash64("text")).alias("ref"), F.col("doc_id").isNotNull().alias("has_id"))


def signatures(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n (set size), sig (hash of the set), keys (its shown elements, in hash order), text_key (hash of a text without an id)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = f["text"].tolist()
            for a, b in _runs(texts):
                sets = _shingler().sets(texts[a:b])
                yield pd.DataFrame(
                    {
                        "ref": f["ref"].iloc[a:b],
                        "has_id": f["has_id"].iloc[a:b],
                        "n": [len(s) for s in sets],
                        "sig": [_signature(s) for s in sets],
                        "keys": [s[: shown(len(s))].view(np.int64) for s in sets],
                        "need": [needed(len(s)) if len(s) else 0 for s in sets],
                    }
                )

    # pandas would turn longs with nulls among them into floats, so the nulls are put back outside.
    cut = _keyed(docs).mapInPandas(run, "ref long, has_id boolean, n int, sig long, keys array<long>, need int")
    return cut.select(F.expr("CASE WHEN has_id THEN ref END").alias("doc_id"), "n", "sig", "keys", "need", F.expr("CASE WHEN NOT has_id THEN ref END").alias("text_key"))


def divide_skip(lists: list[list[int]], least: int) -> dict[int, int]:
    """Ids that are in at least `least` of the sorted lists, with their counts there.

    The L longest lists are set apart; an id in `least` lists is in least - L of the others at least. Those are merged by a
    heap, and ids with that count are looked up in the long lists by binary search, as long as they can still reach the bound.
    """
    lists = sorted((x for x in lists if x), key=len)
    if len(lists) < least:
        return {}
    longest = len(lists[-1]) if lists else 0
    n_long = min(len(lists), least - 1, int(least / (MU * np.log2(max(longest, 2)) + 1)))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :][::-1]
    found: dict[int, int] = {}
    for i, same in groupby(heapq.merge(*short)):
        count = sum(1 for _ in same)
        if count < least - n_long:
            continue
        for k, x in enumerate(long):
            if count + n_long - k < least:
                break
            at = bisect_left(x, i)
            count += at < len(x) and x[at] == i
        if count >= least:
            found[i] = count
    return found


def linked(query: np.ndarray, candidates: list[np.ndarray]) -> list[int]:
    """Numbers of the candidates whose Jaccard similarity with the query reaches the threshold."""
    sizes = [len(c) for c in candidates]
    asked = [-(-NUM * (len(query) + n) // (NUM + DEN)) for n in sizes]
    if not candidates:
        return []
    # Inverted lists of the query's elements: the candidates that hold each, in order.
    joined, owner = np.concatenate(candidates), np.repeat(np.arange(len(candidates)), sizes)
    at = np.searchsorted(query, joined)
    at[at == len(query)] = 0
    held = query[at] == joined
    at, owner = at[held], owner[held]
    order = np.argsort(at, kind="stable")
    cuts = np.flatnonzero(np.diff(at[order])) + 1
    lists = [x.tolist() for x in np.split(owner[order], cuts)]
    return sorted(i for i, n in divide_skip(lists, max(1, min(asked))).items() if n >= asked[i])


def _groups(frames: Iterator[pd.DataFrame], columns: list[str], n_keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of sorted frames in groups that agree in the first n_keys columns."""
    forget()
    key, held = None, []
    for f in frames:
        for r in zip(*(f[c] for c in columns), strict=True):
            if r[:n_keys] != key:
                if held:
                    yield key, held
                key, held = r[:n_keys], []
            held.append(r[n_keys:])
    if held:
        yield key, held


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.repartition(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys, F.desc("is_query"))


def _unsigned(x) -> np.ndarray:
    return np.asarray(x, np.int64).view(np.uint64)


def _beside_leaders(pairs: DataFrame, sets: DataFrame, *more: str) -> DataFrame:
    """leader, chunk, is_query, sig, more.., elements: of each chunk of a leader's candidates the leader's set, then theirs.

    pairs(leader, sig, more..) has a row for the leader itself where more columns are asked for. A leader with many candidates is met
    in several chunks.
    """
    # Written, so that the joins below meet a table: nothing above them needs a leader's rows together, so Spark may split a leader that many sets share.
    counts = materialise(pairs.groupBy("leader").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("n_chunks")), "leaders")
    candidates = pairs.join(counts, "leader").select("leader", F.pmod(F.xxhash64("sig"), F.col("n_chunks")).cast("int").alias("chunk"), F.lit(False).alias("is_query"), "sig", *more)
    own = pairs.filter("leader = sig").join(counts, "leader") if more else counts.withColumn("sig", F.col("leader"))
    heads = own.select("leader", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)).alias("chunk"), F.lit(True).alias("is_query"), "sig", *more)
    return _dealt(heads.union(candidates).join(sets, "sig").select("leader", "chunk", "is_query", "sig", *more, "elements"), "leader", "chunk")


def _linked_to_leaders(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs(leader, sig) those that are linked, as a, b."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (leader, _), rows in _groups(frames, ["leader", "chunk", "is_query", "sig", "elements"], 2):
            query = next(_unsigned(e) for is_query, _, e in rows if is_query)
            others = [(sig, _unsigned(e)) for is_query, sig, e in rows if not is_query]
            hits = linked(query, [e for _, e in others]) if others else []
            yield pd.DataFrame({"a": [leader] * len(hits), "b": [others[i][0] for i in hits]}, dtype="int64")

    return _beside_leaders(pairs, sets).mapInPandas(run, "a long, b long")


def _differences(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """groups(leader, sig, component, n_mb, n_qb) with home (the leader's component), n, base (size of the leader's set), missing (of it) and diff
    (symmetric difference with it)."""
    given = ["leader", "chunk", "is_query", "sig", "component", "n_mb", "n_qb", "elements"]
    names = ["leader", "sig", "component", "home", "n_mb", "n_qb", "n", "base", "missing", "diff"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (leader, _), rows in _groups(frames, given, 2):
            home, base = next((r[2], _unsigned(r[5])) for r in rows if r[0])
            out = []
            for is_query, sig, component, n_mb, n_qb, e in rows:
                if not is_query:
                    own = _unsigned(e)
                    diff = np.setxor1d(own, base, assume_unique=True)
                    # |own xor base| = |own| + |base| - 2 |both|
                    out.append((leader, sig, component, home, n_mb, n_qb, len(own), len(base), len(base) - (len(own) + len(base) - len(diff)) // 2, diff.view(np.int64)))
            if out:
                yield pd.DataFrame(out, columns=names)

    schema = "leader long, sig long, component long, home long, n_mb int, n_qb int, n int, base int, missing int, diff array<long>"
    return _beside_leaders(groups, sets, "component", "n_mb", "n_qb").mapInPandas(run, schema)


def linked_by_differences(queries: list[tuple[int, int, np.ndarray]], members: list[tuple[int, int, np.ndarray]], base: int) -> list[tuple[int, int]]:
    """(query, member) numbers of linked sets; each is (size, missing, difference) against the same set of `base` elements."""
    if not members:
        return []
    n, missing = np.array([m[0] for m in members]), np.array([m[1] for m in members])
    extra = n - (base - missing)
    joined = np.concatenate([m[2] for m in members])
    owner = np.repeat(np.arange(len(members)), [len(m[2]) for m in members])
    order = np.argsort(joined, kind="stable")
    joined, owner = joined[order], owner[order]
    out = []
    for q, (size, gone, diff) in enumerate(queries):
        # How many elements the two differences must have in common, and how many they can have.
        asked = -(-NUM * (n + size) // (NUM + DEN)) - base + gone + missing
        fits = DEN * np.minimum(n, size) >= NUM * np.maximum(n, size)
        can = np.minimum(missing, gone) + np.minimum(extra, size - (base - gone))
        out += [(q, int(i)) for i in np.flatnonzero(fits & (asked <= 0))]
        open_ = fits & (asked > 0) & (asked <= can)
        if not open_.any():
            continue
        least = int(asked[open_].min())
        lo, hi = np.searchsorted(joined, diff, "left"), np.searchsorted(joined, diff, "right")
        if (hi > lo).sum() < least:
            continue
        lists = [owner[a:b].tolist() for a, b in zip(lo.tolist(), hi.tolist(), strict=True) if b > a]
        out += [(q, i) for i, k in divide_skip(lists, least).items() if open_[i] and k >= asked[i]]
    return out


def _linked_under_leaders(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Links a, b between the sets under each leader; groups(leader, sig, component). Sets in the leader's own component don't ask."""
    homes = groups.filter("leader = sig").select("leader", F.col("component").alias("home"))
    # Counted by component first, so that a leader's many rows are few before they meet.
    parts = groups.groupBy("leader", "component").agg(F.count("*").alias("rows")).join(homes, "leader")
    asks = F.sum(F.when(F.col("component") != F.col("home"), F.col("rows")).otherwise(0))
    sizes = parts.groupBy("leader").agg(F.ceil(F.sum("rows") / MEMBERS).cast("int").alias("n_mb"), F.ceil(asks / QUERIES).cast("int").alias("n_qb"))
    sizes = materialise(sizes.filter("n_qb > 0"), "leader-sizes")
    groups = materialise(groups.join(sizes, "leader"), "dealt-groups")
    placed = materialise(_differences(groups, sets), "differences")
    mine, theirs = F.pmod(F.xxhash64("sig", F.lit(1)), F.col("n_mb")).cast("int"), F.pmod(F.xxhash64("sig", F.lit(2)), F.col("n_qb")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rest = ("sig", "component", "n", "missing", "base", "diff")
    members = placed.select("leader", mine.alias("mb"), every("n_qb").alias("qb"), F.lit(False).alias("is_query"), *rest)
    queries = placed.filter("component <> home").select("leader", every("n_mb").alias("mb"), theirs.alias("qb"), F.lit(True).alias("is_query"), *rest)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, rows in _groups(frames, ["leader", "mb", "qb", "is_query", *rest], 3):
            q, m = [r for r in rows if r[0]], [r for r in rows if not r[0]]
            if not q or not m:
                continue
            cut = lambda side: [(r[3], r[4], _unsigned(r[6])) for r in side]
            # One link to each component that a query meets says as much as all of them.
            hits = {(q[i][1], m[j][2]): m[j][1] for i, j in linked_by_differences(cut(q), cut(m), q[0][5]) if q[i][2] != m[j][2]}
            yield pd.DataFrame([(a, b) for (a, _), b in hits.items()], columns=["a", "b"], dtype="int64")

    return _dealt(members.union(queries), "leader", "mb", "qb").mapInPandas(run, "a long, b long")


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The whole sets of the classes in wanted(sig, ref, has_id): sig, elements."""
    # A bitmap of fixed size says which documents may be wanted; the join after it decides.
    slot = F.pmod(F.xxhash64("ref"), F.lit(FILTER_BITS)) + 1
    bits = (
        wanted.select(slot.alias("slot")).groupBy(F.expr("bitmap_bucket_number(slot)").alias("part"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits")).collect()
    )
    parts = {r.part: bytes(r.bits) for r in bits}
    width = 4096 * 8

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: set[int] = set()  # texts without an id give their set once in a task
        for f in frames:
            slots = f["slot"].to_numpy()
            part, pos = (slots - 1) // width + 1, (slots - 1) % width
            keep = [bool((b := parts.get(int(p))) and b[q >> 3] >> (q & 7) & 1) for p, q in zip(part, pos.tolist(), strict=True)]
            f = f[keep]
            nameless = ~f["has_id"].to_numpy(dtype=bool)
            if nameless.any():
                f = f[~(nameless & (f["ref"].isin(met) | f["ref"].duplicated()).to_numpy(dtype=bool))]
                met.update(f["ref"][~f["has_id"].astype(bool)].tolist())
            texts = f["text"].tolist()
            for a, b in _runs(texts):
                sets = _shingler().sets(texts[a:b])
                yield pd.DataFrame({"ref": f["ref"].iloc[a:b], "has_id": f["has_id"].iloc[a:b], "sig": [_signature(s) for s in sets], "elements": [s.view(np.int64) for s in sets]})

    n = shuffle_partitions(docs.sparkSession)
    cut = _keyed(docs).withColumn("slot", slot).mapInPandas(run, "ref long, has_id boolean, sig long, elements array<long>").repartition(n, "sig")
    first = wanted.select("sig", F.col("ref").alias("first_ref"), F.col("has_id").alias("first_has_id"))
    # Written as differences, since equalities would join the key and deal the rows anew by all of it, away from their buckets.
    same = "(ref ^ first_ref) = 0 AND (CAST(has_id AS INT) ^ CAST(first_has_id AS INT)) = 0"
    return cut.join(first, "sig").filter(same).select("sig", "elements")


def _hot_keys(shown_rows: DataFrame, n_rows: int) -> DataFrame:
    """key, df: keys that a large share of the sets show. Which keys count as hot decides only how they are counted, not what is found.

    A task names the keys that HOT_HERE of its rows show; those that make up HOT of all rows stay, so with the rows' bounded
    number of shown elements there are at most 1 / HOT times that number.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        keys, counts, rows = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for f in frames:
            rows += len(f)
            one, many = np.unique(np.concatenate([np.zeros(0, np.int64), *f["keys"]]), return_counts=True)
            both = np.concatenate([keys, one])
            keys, at = np.unique(both, return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, many])).astype(np.int64)
            # What is rarer than this cannot be hot here any more unless it comes again as often; that is counted from then on.
            keep = counts >= HOT_HERE / 4 * rows
            keys, counts = keys[keep], counts[keep]
        keep = counts >= max(HOT_LEAST, HOT_HERE / 2 * rows)
        yield pd.DataFrame({"key": keys[keep], "n": counts[keep]})

    found = shown_rows.select("keys").filter("size(keys) > 0").mapInPandas(run, "key long, n long")
    return found.groupBy("key").agg(F.sum("n").alias("df")).filter(F.col("df") >= max(HOT_LEAST, int(HOT * n_rows)))


def _apart(hot: Column) -> Column:
    """A number that deals the rows of a hot key to many tasks, 0 for other keys."""
    return F.when(hot, F.pmod(F.xxhash64("sig"), F.lit(1 << 16))).otherwise(0)


def _over_keys(rows: DataFrame, **sums: Column) -> DataFrame:
    """rows(key, hot, sig, ..) with aggregates over their key. Rows of a hot key stay apart and meet partial aggregates instead of each other."""
    # Hot keys are bounded in number, see _hot_keys().
    of_hot = rows.filter("hot").groupBy("key").agg(*(x.alias(f"{n}_of_hot") for n, x in sums.items()))
    own = Window.partitionBy("key", "apart")
    met = rows.join(F.broadcast(of_hot), "key", "left").withColumn("apart", _apart(F.col("hot")))
    return met.select(*rows.columns, *(F.when(F.col("hot"), F.col(f"{n}_of_hot")).otherwise(x.over(own)).alias(n) for n, x in sums.items()))


def similar_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of doc_id, n, sig; sig, component of the classes of equal sets that link with others)."""
    spark = docs.sparkSession
    ship(spark)
    shown_rows = materialise(signatures(docs), "signatures")
    hot = materialise(_hot_keys(shown_rows, shown_rows.count()), "hot-keys")
    # Of all that is dealt this is the most, so its rows are short: n and need in one number, and a mark, which is 0 but for hot keys; theirs is df and a number apart.
    rows = shown_rows.filter("n > 0").select(F.explode("keys").alias("key"), "sig", (F.shiftleft(F.col("n").cast("long"), 32) + F.col("need")).alias("sizes"))
    rows = rows.join(F.broadcast(hot), "key", "left")
    rows = rows.select("key", "sig", "sizes", F.coalesce(F.shiftleft("df", 16) + _apart(F.lit(True)), F.lit(0)).cast("long").alias("mark"))
    # A hot key counts as shared; that holds back nothing, as any order of the keys that is the same for all sets will do.
    key, own = Window.partitionBy("key", "mark"), Window.partitionBy("sig")
    is_hot = F.col("mark") != 0
    shared = is_hot | (F.min("sig").over(key) != F.max("sig").over(key))
    rows = rows.select("*", F.when(is_hot, F.shiftright("mark", 16)).otherwise(F.count("*").over(key)).alias("df"), shared.alias("shared"))
    # A key and a set have one mark; with it among the columns the rows are told apart where they are.
    rows = rows.filter("shared").select("key", "mark", "sig", "sizes", "df").distinct()
    rows = rows.select("key", is_hot.alias("hot"), "sig", F.shiftright("sizes", 32).cast("int").alias("n"), F.col("sizes").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("need"), "df")
    rows = rows.repartition(shuffle_partitions(spark), "sig")
    rows = rows.select("*", F.count("*").over(own).alias("s"), F.row_number().over(own.orderBy("df", "key")).alias("r"))
    rows = rows.filter("s >= need AND r <= s - need + 1").select("key", "hot", "sig", "n", (F.col("s") - F.col("need") + 1).alias("held"))
    rows = materialise_bucketed(rows, "join-keys", "sig")
    # Three short columns beside the shown elements: an eighth of the files will do.
    all_rows = materialise(shown_rows.select("doc_id", "n", "sig", "text_key").coalesce(max(1, shuffle_partitions(spark) // 8)), "classes")
    drop_table(shown_rows)
    drop_table(hot)
    # One document stands for each class, by its text where no row of the class has an id; a class may have several rows with its smallest id.
    concerned = rows.select("sig").distinct()
    stands = all_rows.filter("n > 0").groupBy("sig").agg(F.min("doc_id").alias("first_id"), F.min("text_key").alias("first_key"))
    wanted = stands.select("sig", F.coalesce("first_id", "first_key").alias("ref"), F.col("first_id").isNotNull().alias("has_id")).join(concerned, "sig")
    wanted = materialise(wanted.hint("rebalance"), "wanted")
    # A repeated row of a class's document gives its set twice, which costs a comparison and changes no result.
    sets = materialise_bucketed(_sets_of(docs, wanted), "sets", "sig")
    drop_table(wanted)
    led = _over_keys(rows.select("key", "hot", "sig", "n"), lead=F.min(F.struct("sig", "n"))).select("sig", "n", F.col("lead.sig").alias("leader"), F.col("lead.n").alias("leader_n"))
    pairs = led.filter(f"sig <> leader AND {DEN} * least(n, leader_n) >= {NUM} * greatest(n, leader_n)").select("leader", "sig").distinct()
    pairs = materialise(pairs, "pairs")
    components = connected_components(_linked_to_leaders(pairs, sets))
    drop_table(pairs)
    named = rows.join(components.withColumnRenamed("id", "sig"), "sig", "left").select("key", "hot", "sig", "held", F.coalesce("component", "sig").alias("component"))
    # A key whose sets are not all in one component is open. The set that is under most keys leads all its keys, and a leader's sets go to the
    # busiest leader that it has itself: so sets of one family meet under few leaders.
    busy = _over_keys(named, lo=F.min("component"), hi=F.max("component"), lead=F.max(F.struct("held", "sig"))).filter("lo <> hi")
    led = materialise(busy.select(F.col("lead.held").alias("held"), F.col("lead.sig").alias("leader"), "sig", "component").distinct(), "led")
    tops = materialise(led.groupBy(F.col("sig").alias("leader")).agg(F.max(F.struct("held", "leader")).alias("top")), "tops")
    moved = led.join(tops, "leader").select(F.col("top.leader").alias("leader"), "sig", "component")
    heads = led.filter("leader = sig").select("leader", "sig", "component").join(moved.select("leader").distinct(), "leader", "left_semi")
    groups = materialise(moved.union(heads).distinct(), "groups")
    drop_table(led)
    drop_table(tops)
    if not groups.isEmpty():
        # A class and its component are a link that says as much as all that were found before.
        before, components = components, connected_components(components.toDF("a", "b").union(_linked_under_leaders(groups, sets)))
        drop_table(before)
    for done in (groups, sets, rows):
        drop_table(done)
    return all_rows.select("doc_id", "n", "sig"), components.select(F.col("id").alias("sig"), "component")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_shingles, component_id (the smallest doc_id that links reach)."""
    rows, classes = similar_classes(docs)
    named = rows.join(classes, "sig", "left").select("doc_id", "n", F.coalesce("component", "sig").alias("component"))
    # Written, so that the join below meets a table and may split a component that holds many rows.
    first = materialise(named.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("first_id")), "first-ids")
    out = named.join(first, "component", "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("first_id")).otherwise(F.col("doc_id")).alias("component_id"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each group of linked ones, that of the smallest doc_id, with all columns.

    Rows without an id stay. Of rows that repeat a kept id, equal texts stay once.
    """
    groups = jaccard_components(docs).filter("doc_id IS NOT NULL")
    key, stays, many = fresh_names(docs, "id", "stays", "rows")
    kept = groups.groupBy(F.col("doc_id").alias(key)).agg(F.max(F.col("doc_id") == F.col("component_id")).alias(stays), F.count("*").alias(many))
    kept = materialise(kept, "kept-ids")
    # Documents whose slot in a bitmap of fixed size holds no dropped or repeated id stay without a join, so only the others' texts move.
    slot = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(DROP_BITS))
    doubt = kept.filter(~F.col(stays) | (F.col(many) > 1)).select(slot(key).alias("slot"))
    words = doubt.groupBy(F.shiftright("slot", 6).cast("int").alias("number")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits")).collect()
    if not words:
        return docs
    bitmap = [0] * (DROP_BITS // 64)
    for r in words:
        bitmap[r.number] = r.bits
    bits = F.split(F.lit(",".join(map(str, bitmap))), ",").cast("array<bigint>")
    mine = slot("doc_id")
    held = F.coalesce(F.getbit(F.get(bits, F.shiftright(mine, 6).cast("int")), mine.bitwiseAND(63).cast("int")) == 1, F.lit(False))
    rows = docs.filter(held).join(kept.filter(stays), F.col("doc_id").cast("long") == F.col(key)).select(*docs.columns, many)
    once = rows.filter(F.col(many) == 1).drop(many)
    if not kept.filter(F.col(stays) & (F.col(many) > 1)).isEmpty():
        once = once.union(rows.filter(F.col(many) > 1).drop(many).dropDuplicates(["doc_id", "text"]))
    return docs.filter(~held).union(once)
