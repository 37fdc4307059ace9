"""Similarity join on word n-gram sets: rare-first prefix filtering, verified once per pair.

A document's set holds the hashes of its distinct word n-grams; with fewer words the whole
sequence is its one n-gram, without words the set is empty and links with nothing. Documents with
equal sets form a class, and only classes are joined, so copies are never paired with each other.

1. A first thinning: a fixed-size table of counters over all documents' n-grams puts those that are
   certainly frequent last, and each class shows a pool, the first n-grams of that order. A set
   with a link has less than ``lone_bar`` n-grams in its pool that no other pool shows; a class with
   more links with nothing and is done. The n-grams are counted exactly but for one in some thousands:
   32 bits of each travel, packed and only once, and two that agree in them count as shown by another
   pool, which keeps a class too many but drops none. Any order is right here; a good one lets more
   classes go.
2. Of the classes left, every n-gram is counted exactly, and each set is ordered rare first by these
   counts. The prefix is the first ``n - ceil(t n) + 1`` n-grams: two linked sets share one of them.
   N-grams of one class alone come first and meet nothing, so only shared ones are kept, with
   their positions among the shared ones of the set.
3. In a few rounds each shared n-gram names some hubs, and each holder is paired with one hub of
   another component, the one it shares most prefix n-grams with: at most a pair a holder and round,
   which joins most of any dense group. Then all holders of an n-gram whose components still
   differ are paired; pairs within a component cannot change it and are left out. Each holder
   brings the ``BEFORE`` n-grams before this one, and a pair that shares one of these is not listed
   again; at its first shared n-gram it always is.
4. Pairs pass the length, positional and (hubs: right after) suffix filters, upper bounds of the
   overlap, while they are joined, before the sets themselves are compared, once per pair and in
   whole numbers.

The result names components, so links inside a component need not all be listed; none between
different components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe import slices
from .common import components, land, maybe_in, release, text_or_empty

#: Counters of the frequency table (4 bytes each): a fixed size, whatever the corpus.
COUNTERS = 1 << 20
_BLOCKS = 64
#: Per cent of its n-grams that a set shows beyond its prefix.
POOL_MORE = 12
#: Shown n-grams that a task holds before it deals them, and that one task looks through (sizing
#: targets: any numbers work).
POOL_FLUSH, POOL_ROWS = 1 << 21, 1 << 20
#: Hubs that a shared n-gram names in a round, and rounds of them before all pairs are left.
HUBS, HUB_ROUNDS = 8, 3
#: N-grams before its own that a row of the last join on n-grams brings along.
BEFORE = 16
#: Classes of the suffix filter: shared n-grams of a set are counted by this many hash classes.
RANGES = 16

_LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """Runs of bytes other than ASCII white space, A-Z lower-cased (bytes.split cuts at exactly
    0x20 and 0x09-0x0D)."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def ngrams(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a whole text."""
    import xxhash

    w = words(text)
    if not w:
        return np.empty(0, np.uint64)
    if len(w) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(w), seed=len(w))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    out = np.zeros(len(w) - n + 1, np.uint64)
    for j in range(n):
        out = (out ^ h[j:len(w) - n + 1 + j]) * _MIX
        out ^= out >> np.uint64(32)
    return np.unique(out)


def _key(s: np.ndarray) -> int:
    """64 bits of a set; with its size it names the class of equal sets."""
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def _sets(rows: pa.RecordBatch, n: int) -> Iterator[list[np.ndarray]]:
    for part in slices(rows.column(1).to_pylist()):
        yield [ngrams(t, n) for t in part]


def _text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))


def profile(docs: DataFrame, n: int) -> DataFrame:
    """One pass over all texts: a row (doc_id, n, key) per document, and the task's counters as
    rows (block, counts)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(COUNTERS, np.uint32)
        names = ["doc_id", "n", "key", "block", "counts"]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
        for rows in batches:
            sizes, keys = [], []
            for sets in _sets(rows, n):
                if sets:
                    table += np.bincount(np.concatenate(sets) % np.uint64(COUNTERS),
                                         minlength=COUNTERS).astype(np.uint32)
                sizes += [len(s) for s in sets]
                keys += [_key(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(sizes, types[1]), pa.array(keys, types[2]),
                 pa.nulls(len(sizes), types[3]), pa.nulls(len(sizes), types[4])], names=names)
        blocks = [(b, part.tobytes()) for b, part in enumerate(np.split(table, _BLOCKS)) if part.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(blocks), t) for t in types[:3]]
            + [pa.array([b for b, _ in blocks], types[3]), pa.array([c for _, c in blocks], types[4])],
            names=names)

    return docs.mapInArrow(run, "doc_id long, n int, key long, block int, counts binary")


def frequencies(profiled: DataFrame) -> np.ndarray:
    """The counters of all tasks, summed block by block on the executors, level by level; the
    driver gets one table of the fixed size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for rows in batches:
            for b, c in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                add = np.frombuffer(c, np.uint32).astype(np.uint64)
                sums[b] = sums[b] + add if b in sums else add
        for b, s in sums.items():
            low = np.minimum(s, 0xFFFFFFFF).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([low.tobytes()])],
                                             names=["block", "counts"])

    parts = profiled.filter("block is not null").select("block", "counts")
    table = np.zeros((_BLOCKS, COUNTERS // _BLOCKS), np.uint32)
    for b, c in parts.repartition(_BLOCKS, "block").mapInArrow(run, parts.schema).collect():
        table[b] = np.frombuffer(c, np.uint32)
    return table.reshape(-1)


def prefix_length(n, percent: int):
    """First n-grams of the order, so many that sets of similarity >= percent share one."""
    return n - (percent * n + 99) // 100 + 1


def pool_length(n, percent: int):
    """Prefix and some more: what a set shows of itself before any join of sets."""
    return min(n, prefix_length(n, percent) + n * POOL_MORE // 100 + 1)


def lone_bar(n, percent: int):
    """So many n-grams of a pool that no other pool shows prove that the set has no link.

    Let B be linked with A. At most ``prefix - 1`` n-grams of A are not in B. The i-th shared one has
    at most |B| - overlap others of B before it, so B's pool shows all shared ones of A's pool but, at
    most, as many as A's pool is longer beyond its prefix than B's. B is no smaller than
    ``ceil(percent n)``, whose pool is the shortest in question."""
    more = [k * POOL_MORE // 100 for k in (n, -(-percent * n // 100))]
    return prefix_length(n, percent) + more[0] - more[1]


def _columns(n: Column, percent: int) -> tuple[Column, Column]:
    """prefix_length and pool_length of a column of sizes."""
    n = n.cast("long")
    p = n - F.ceil(n * F.lit(percent) / F.lit(100)) + F.lit(1)
    return p, F.least(n, p + F.floor(n * F.lit(POOL_MORE) / F.lit(100)) + F.lit(1))


def frequent_bar(table: np.ndarray) -> float:
    """A count that a counter of rare n-grams does not reach by chance."""
    return float(table.mean() + 6 * np.sqrt(table.mean() + 1))


def ordered(s: np.ndarray, table: np.ndarray, bar: float) -> np.ndarray:
    """A set in the global order: rare n-grams by hash, then frequent ones by count."""
    c = table[s % np.uint64(COUNTERS)]
    return s[np.argsort(np.where(c > bar, c, 0), kind="stable")]   # s is sorted by hash


def pools(docs: DataFrame, n: int, percent: int, table: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, grams, keys): the pool of each non-empty set, dealt to buckets by a hash of the
    n-gram; other 32 bits of it and the name of the set's class, packed."""
    shared = docs.sparkSession.sparkContext.broadcast(table)   # COUNTERS x 4 bytes
    bar = frequent_bar(table)

    def dealt(shown: list[np.ndarray], keys: list[int]) -> pa.RecordBatch:
        each = np.repeat(np.array(keys, np.int64), [len(g) for g in shown])
        grams = np.concatenate(shown)
        bucket = ((grams >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        names, first = np.unique(bucket[order], return_index=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(names)] + [pa.array([x.tobytes() for x in np.split(c[order], first[1:])], pa.binary())
                                 for c in (grams.astype(np.uint32), each)], names=["bucket", "grams", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown, keys, held = [], [], 0
        for rows in batches:
            for sets in _sets(rows, n):
                for s in filter(len, sets):
                    shown.append(ordered(s, shared.value, bar)[:pool_length(len(s), percent)])
                    keys.append(_key(s))
                    held += len(shown[-1])
                    if held >= POOL_FLUSH:
                        yield dealt(shown, keys)
                        shown, keys, held = [], [], 0
        if held:
            yield dealt(shown, keys)

    return docs.mapInArrow(run, "bucket int, grams binary, keys binary")


def shown_by_others(pool: DataFrame, buckets: int) -> DataFrame:
    """(key, rows): of each class, the number of n-grams of its pool that another class's pool shows
    too, summed over its copies. A task holds the n-grams of its buckets, 12 bytes each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[tuple[bytes, bytes]]] = {}
        for rows in batches:
            for b, *packed in zip(*[c.to_pylist() for c in rows.columns]):
                parts.setdefault(b, []).append(tuple(packed))
        while parts:
            grams, keys = (np.frombuffer(b"".join(c), t) for c, t in zip(
                zip(*parts.popitem()[1]), (np.uint32, np.int64)))
            order = np.lexsort((keys, grams))
            grams, keys = grams[order], keys[order]
            first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            runs = np.diff(np.append(first, len(grams)))
            several = np.repeat(keys[first] != keys[first + runs - 1], runs)
            names, counts = np.unique(keys[several], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts, pa.int64())],
                                             names=["key", "rows"])

    return (pool.repartition(buckets, "bucket").mapInArrow(run, "key long, rows long")
            .groupBy("key").agg(F.sum("rows").alias("rows")))


def class_sets(docs: DataFrame, n: int) -> DataFrame:
    """(id, key, n, grams) of given representatives: the whole set as packed sorted hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids, at = rows.column(0).to_pylist(), 0
            for sets in _sets(rows, n):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at:at + len(sets)], pa.int64()),
                     pa.array([_key(s) for s in sets], pa.int64()),
                     pa.array([len(s) for s in sets], pa.int32()),
                     pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["id", "key", "n", "grams"])
                at += len(sets)

    return docs.mapInArrow(run, "id long, key long, n int, grams binary")


def single_grams(sets: DataFrame) -> DataFrame:
    """(id, key, n, gram): a row per n-gram of each set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, 1024):
                part = rows.slice(at, 1024)
                sizes = part.column(2).to_numpy()
                grams = np.concatenate([np.frombuffer(g.as_buffer(), np.int64) for g in part.column(3)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.column(k).to_numpy(), sizes)) for k in range(3)]
                    + [pa.array(grams)], names=["id", "key", "n", "gram"])

    return sets.mapInArrow(run, "id long, key long, n int, gram long")


def rare_first(sets: DataFrame) -> DataFrame:
    """(id, key, n, gram, s, r): the n-grams that several sets hold, each with its rank r among the
    s such n-grams of its set, in the order of the exact number of sets that hold it."""
    whole = single_grams(sets)
    shared = whole.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    own = Window.partitionBy("id", "key", "n")
    return (whole.join(shared, "gram")
            .withColumn("r", F.dense_rank().over(own.orderBy("df", "gram")) - F.lit(1))
            .withColumn("s", F.count(F.lit(1)).over(own).cast("int"))
            .select("id", "key", "n", "gram", "s", "r"))


def hash_classes(placed: DataFrame) -> DataFrame:
    """(id, key, ranges): the shared n-grams of each set counted by hash class."""
    at = F.col("gram").bitwiseAND(F.lit(RANGES - 1))
    return placed.groupBy("id", "key", "n").agg(
        *[F.count_if(at == F.lit(k)).cast("int").alias(f"r{k}") for k in range(RANGES)]) \
        .select("id", "key", F.array(*[f"r{k}" for k in range(RANGES)]).alias("ranges"))


def _overlap_needed(na: Column, nb: Column, percent: int) -> Column:
    """Smallest overlap of sets of these sizes with 100 * overlap >= percent * union."""
    return F.ceil((F.lit(percent) * (na + nb).cast("long")) / F.lit(100 + percent))


def _long_enough(na: Column, nb: Column, percent: int) -> Column:
    return F.least(na, nb).cast("long") * F.lit(100) >= F.greatest(na, nb).cast("long") * F.lit(percent)


def _can_reach(x: str, y: str, percent: int) -> Column:
    """The positional filter on rows of sets x and y that meet at an n-gram: what both hold before
    it and from it on suffices for a link."""
    r, rest = [F.least(F.col(f"{c}{x}"), F.col(f"{c}{y}")) for c in ("r", "t")]
    return r + rest >= _overlap_needed(F.col(f"n{x}"), F.col(f"n{y}"), percent)


def _filtered(met: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of rows (a, ka, na, ta and the same of b) that pass the positional filter
    at their first shared n-gram, which is among the rows: nothing shared lies before it."""
    pairs = met.groupBy("a", "b", "ka", "kb", "na", "nb").agg(F.max("ta").alias("ta"), F.max("tb").alias("tb"))
    return pairs.filter(F.least("ta", "tb") >= _overlap_needed(F.col("na"), F.col("nb"), percent)) \
        .select("a", "b").distinct()


def _in_classes(percent: int) -> Column:
    """The suffix filter on columns (na, ha, nb, hb): sets can share in each hash class at most the
    smaller count. Whole sets are counted, because an n-gram of one prefix may lie in the suffix of
    the other."""
    most = reduce(lambda x, y: x + y, [F.least(F.col("ha")[i], F.col("hb")[i]) for i in range(RANGES)])
    return most >= _overlap_needed(F.col("na"), F.col("nb"), percent)


def _suffix_passed(pairs: DataFrame, ranges: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs (a, b) that pass the suffix filter."""
    left = ranges.select(F.col("id").alias("a"), F.col("ranges").alias("ha"))
    right = ranges.select(F.col("id").alias("b"), F.col("ranges").alias("hb"))
    return pairs.join(left, "a").join(right, "b").filter(_in_classes(percent)).select("a", "b").distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets satisfy 100 * intersection >= percent * union."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keep = []
            for x, y in zip(rows.column(2), rows.column(3)):
                s, t = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(s) + len(t) - len(np.union1d(s, t))
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays(rows.columns[:2], names=["a", "b"]) \
                .filter(pa.array(keep, pa.bool_()))

    met = (pairs.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("ga")), "a")
           .join(sets.select(F.col("id").alias("b"), F.col("grams").alias("gb")), "b"))
    return met.select("a", "b", "ga", "gb").mapInArrow(run, "a long, b long")


def _hub_pairs(rows: DataFrame, tried: DataFrame | None, seed: int, percent: int) -> DataFrame:
    """Distinct pairs (a, b, na, nb), a < b: each holder of a shared n-gram with one hub of another
    component ``c``, not tried before, that shares most prefix n-grams with it. An n-gram names HUBS
    hubs at most, other ones for another seed."""
    hub = (rows.groupBy("gram", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(HUBS)).alias("salt"))
           .agg(F.min(F.struct(F.xxhash64(F.lit(seed), "id").alias("h"), "id", "n", "c", "r", "t")).alias("hub"))
           .select("gram", *[F.col(f"hub.{x}").alias(y) for x, y in (
               ("id", "i"), ("n", "ni"), ("c", "ci"), ("r", "ri"), ("t", "ti"))]))
    right = rows.select("gram", *[F.col(x).alias(y) for x, y in (
        ("id", "j"), ("n", "nj"), ("c", "cj"), ("r", "rj"), ("t", "tj"))])
    met = hub.join(right, "gram").filter(
        (F.col("ci") != F.col("cj")) & _long_enough(F.col("ni"), F.col("nj"), percent)
        & _can_reach("i", "j", percent))
    lower = F.col("i") < F.col("j")
    pairs = met.groupBy("i", "j", "ni", "nj").agg(F.count(F.lit(1)).alias("shared")).select(
        "j", "shared", *[F.when(lower, F.col(x)).otherwise(F.col(y)).alias(c) for x, y, c in (
            ("i", "j", "a"), ("j", "i", "b"), ("ni", "nj", "na"), ("nj", "ni", "nb"))])
    if tried is not None:
        pairs = pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti")
    best = F.max(F.struct("shared", F.xxhash64("a", "b", F.lit(seed)).alias("h"), "a", "b", "na", "nb"))
    return pairs.groupBy("j").agg(best.alias("p")).select("p.a", "p.b", "p.na", "p.nb").distinct()


def _ties(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct (a, b): the representative of a class and the id of a member that is in other
    classes too, so that all rows of an id are in one component."""
    each = F.struct("key", "n")
    several = members.filter("doc_id is not null").groupBy("doc_id").agg(
        F.min(each).alias("c0"), F.max(each).alias("c1")).filter("c0 <> c1").select("doc_id")
    return members.filter("n > 0").join(several, "doc_id", "left_semi").join(classes, ["key", "n"]) \
        .filter("rep <> doc_id").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct()


def near_components(docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest linked doc_id).

    A null text counts as empty. Rows that repeat an id are one node of the graph, linked with
    whatever any of their texts links with; a row without an id takes the component of its class,
    or null when no row with an id has the same set.
    """
    texts = _text_rows(docs, id_col, text_col)
    profiled = land(profile(texts, n), "profile")
    table = frequencies(profiled)
    members = land(profiled.filter("block is null").select("doc_id", "n", "key"), "members")
    release(profiled)
    classes = land(members.filter("n > 0").groupBy("key", "n").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")

    prefix_n, pool_n = _columns(F.col("n"), percent)
    shows = members.agg(F.sum(pool_n)).first()[0] or 0
    buckets = max(texts.sparkSession.sparkContext.defaultParallelism, int(shows) // POOL_ROWS + 1)
    found = shown_by_others(pools(texts, n, percent, table, buckets), buckets)
    fewest = F.ceil(F.col("n").cast("long") * F.lit(percent) / F.lit(100))
    bar = prefix_n + F.floor(F.col("n").cast("long") * F.lit(POOL_MORE) / F.lit(100)) \
        - F.floor(fewest * F.lit(POOL_MORE) / F.lit(100))       # ``lone_bar`` of a column
    alone = pool_n - F.col("rows") / F.col("copies")            # n-grams that no other pool shows
    wanted = land(classes.join(found, "key").filter((alone < bar) & F.col("rep").isNotNull())
                  .select(F.col("rep").alias("id")).distinct(), "wanted")

    near = texts.filter(maybe_in(wanted, "id")(F.col("doc_id")))   # few others' texts are dealt
    sets = land(class_sets(near.join(wanted, near.doc_id == wanted.id, "left_semi"), n)
                .filter("n > 0"), "sets")
    placed = land(rare_first(sets), "placed")
    ranges = land(hash_classes(placed), "ranges")
    # rank r among the s shared n-grams, t of them from it on; the n - s others come first
    shown = placed.filter(F.col("n") - F.col("s") + F.col("r") < prefix_n) \
        .withColumn("t", F.col("s") - F.col("r"))
    twice = shown.groupBy("gram").agg(F.min("id").alias("i0"), F.max("id").alias("i1")) \
        .filter("i0 <> i1").select("gram")
    held = land(shown.join(twice, "gram").select("gram", "id", "key", "n", "r", "t").distinct(), "held")
    release(placed)

    tried, links, joined = None, None, None
    for seed in range(HUB_ROUNDS):
        rows = held.withColumn("c", F.col("id")) if joined is None else \
            held.join(joined, "id", "left").withColumn("c", F.coalesce("component", "id"))
        pairs = land(_hub_pairs(rows, tried, seed, percent), "pairs")
        new = land(verified(_suffix_passed(pairs, ranges, percent), sets, percent), "links")
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = new if links is None else links.unionByName(new)
        if joined is None or not new.isEmpty():
            joined = land(components(links), "joined")

    whole = held.join(joined, "id", "left").withColumn("c", F.coalesce("component", "id"))
    open_grams = whole.groupBy("gram").agg(F.min("c").alias("c0"), F.max("c").alias("c1")) \
        .filter("c0 <> c1").select("gram")
    own = Window.partitionBy("id", "key", "n").orderBy("r").rowsBetween(-BEFORE, -1)
    rows = land(whole.join(open_grams, "gram").withColumn("e", F.collect_list("gram").over(own))
                .join(ranges.withColumnRenamed("ranges", "h").distinct(), ["id", "key"])
                .select("gram", "id", "key", "n", "r", "t", "c", "e", "h"), "open")

    def side(x: str) -> DataFrame:
        return rows.select("gram", F.col("id").alias(x), F.col("key").alias(f"k{x}"),
                           *[F.col(c).alias(f"{c}{x}") for c in ("n", "r", "t", "c", "e", "h")])

    met = side("a").join(side("b"), "gram").filter(
        (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb"))
        & _long_enough(F.col("na"), F.col("nb"), percent) & _can_reach("a", "b", percent)
        & ~F.arrays_overlap("ea", "eb") & _in_classes(percent))
    rest = _filtered(met, percent).join(tried.select("a", "b"), ["a", "b"], "left_anti")
    more = land(verified(rest, sets, percent)
                .unionByName(_ties(members, classes)), "links")
    found = land(components(links.union(more)) if not more.isEmpty() else joined, "joined")

    rep = classes.join(found, classes.rep == found.id, "left") \
        .select("key", "n", F.coalesce("component", "rep").alias("component_id"))
    out = ["doc_id", F.col("n").cast("long").alias("n_shingles"),
           F.coalesce("component_id", "doc_id").alias("component_id")]
    named = found.select(F.col("id").alias("doc_id"), F.col("component").alias("component_id"))
    return members.filter("n > 0").join(rep, ["key", "n"], "left").select(*out) \
        .unionByName(members.filter("n = 0").join(named, "doc_id", "left").select(*out))
