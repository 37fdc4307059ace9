"""Near-duplicate embeddings by robust-pruned flat graphs on overlapping cluster shards.

Vectors are compared only inside one label (and one dimension). Equal vectors form a class and
only classes are searched. Shards: a group above ``SHARD`` vectors is split by centroids fitted on
a bounded hash sample of it (``SAMPLE`` rows, spherical k-means; centroids closer than cosine 0.9
are one, so a dense clump is not torn); every vector has a home, the nearest centroid, and a copy
at the next nearest. This repeats until shards are small; a clump that no centroids split is dealt
into blocks and searched by pairs of blocks.

Per shard, each vector gets the robust-pruned nearest, random and medoid candidates as neighbours,
with reverse edges; the adjacency lists of a vector from all its shards are then united. Search:
a greedy beam from the shard's medoid for every vector at home there; a beam that does not reach
its own vector is repeated with twice the width. From all it found near the range it then expands
along edges until nothing in range is new. Links are verified in double precision. A link between
two homes of one shard is counted there; others travel as pairs, so both ends count it once.

Recall is audited against brute force on a bounded query set (``AUDIT`` vectors chosen by a hash
against all vectors of their labels); below ``RECALL`` the search is repeated with one more copy
per vector and twice the beam; the figure is logged, and one below ``LEAST_RECALL`` after the third
search is an error. Null, zero or non-finite vectors and null labels link with nothing.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, land

log = logging.getLogger(__name__)

SHARD, SAMPLE, SPLIT = 3000, 1024, 16
DEGREE, ALPHA, NEAREST, RANDOM, BEAM = 24, 1.2, 48, 16, 32
#: How far below the threshold range expansion still walks.
SLACK = 0.03
AUDIT, RECALL = 400, 0.97
#: A result whose audit is still below this after the widest search is an error.
LEAST_RECALL = 0.9


# --- one shard, in numpy ------------------------------------------------------------------

def unit(rows: np.ndarray) -> np.ndarray:
    x = rows.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)   # first: squares of large or tiny values are lost
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def medoid(x: np.ndarray) -> int:
    return int(np.argmax(x @ x.mean(0)))


def robust_prune(x: np.ndarray, node: np.ndarray, cand: np.ndarray) -> np.ndarray:
    """Neighbours of each node: the nearest candidate stays and hides those that it is, by the
    factor ALPHA, closer to than the node is; padded with -1."""
    near = np.einsum("bd,bcd->bc", x[node], x[cand])
    near[cand == node[:, None]] = -2
    order = np.argsort(-near, axis=1, kind="stable")
    cand, near = np.take_along_axis(cand, order, 1), np.take_along_axis(near, order, 1)
    twice = np.zeros_like(cand, bool)                       # a candidate named more than once
    by = np.argsort(cand, axis=1, kind="stable")
    ids = np.take_along_axis(cand, by, 1)
    np.put_along_axis(twice, by[:, 1:], ids[:, 1:] == ids[:, :-1], 1)
    alive = (near > -2) & ~twice
    far = np.sqrt(np.maximum(0, 2 - 2 * near))
    v = x[cand]
    between = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("bcd,bed->bce", v, v)))
    out, taken = np.full((len(node), DEGREE), -1, np.int32), np.zeros(len(node), int)
    for c in range(cand.shape[1]):
        pick = np.flatnonzero(alive[:, c] & (taken < DEGREE))
        out[pick, taken[pick]] = cand[pick, c]
        taken[pick] += 1
        alive[pick] &= ALPHA * between[pick, c] > far[pick]
    return out


def build(x: np.ndarray, seed: int = 0) -> list[np.ndarray]:
    """Adjacency lists of one shard."""
    n, rng = len(x), np.random.default_rng(seed)
    x32, mid = x.astype(np.float32), medoid(x)
    edges, k = np.full((n, DEGREE), -1, np.int32), min(NEAREST, n - 1)
    for i in range(0, n if k > 0 else 0, 256):
        node = np.arange(i, min(n, i + 256))
        near = x32[node] @ x32.T
        near[np.arange(len(node)), node] = -2
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        cand = np.concatenate([best, rng.integers(0, n, (len(node), RANDOM)),
                               np.full((len(node), 1), mid)], 1).astype(np.int32)
        edges[node] = robust_prune(x32, node, cand)
    a, b = np.repeat(np.arange(n, dtype=np.int64), DEGREE), edges.reshape(-1)
    a, b = a[b >= 0], b[b >= 0]
    both = np.unique(np.concatenate([a * n + b, b.astype(np.int64) * n + a]))
    lists = np.split((both % n).astype(np.int32), np.searchsorted(both // n, np.arange(1, n)))
    for i, ids in enumerate(lists):
        if len(ids) > 6 * DEGREE:                           # many name it: prune its list again
            cut = robust_prune(x32, np.array([i]), ids[None])[0]
            lists[i] = np.union1d(cut[cut >= 0], edges[i][edges[i] >= 0]).astype(np.int32)
    return lists


def padded(lists: list[np.ndarray]) -> np.ndarray:
    width = max([1, *map(len, lists)])
    out = np.full((len(lists), width), -1, np.int32)
    for row, ids in zip(out, lists):
        row[:len(ids)] = ids
    return out


def beam_search(x: np.ndarray, adj: np.ndarray, start: int, queries: np.ndarray, beam: int) -> np.ndarray:
    """Seen-mask (queries x nodes) of greedy beams from ``start`` towards each query node."""
    n, m = len(x), len(queries)
    q = x[queries]
    seen = np.zeros((m, n), bool)
    seen[:, start] = True
    ids = np.full((m, beam), -1, np.int32)
    sims = np.full((m, beam), -4, np.float32)
    done = np.ones((m, beam), bool)
    ids[:, 0], sims[:, 0], done[:, 0] = start, q @ x[start], False
    rows = np.arange(m)
    while len(rows):
        at = np.argmax(np.where(done[rows], -9, sims[rows]), axis=1)
        done[rows, at] = True
        nbr = adj[ids[rows, at]]
        fresh = nbr >= 0
        fresh &= ~seen[rows[:, None], np.where(fresh, nbr, 0)]
        r, c = np.nonzero(fresh)
        new = nbr[r, c]
        seen[rows[r], new] = True
        got = np.full(nbr.shape, -4, np.float32)
        got[r, c] = np.einsum("ij,ij->i", q[rows[r]], x[new])
        all_s = np.concatenate([sims[rows], got], 1)
        all_i = np.concatenate([ids[rows], np.where(fresh, nbr, -1)], 1)
        all_d = np.concatenate([done[rows], ~fresh], 1)
        top = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
        sims[rows], ids[rows], done[rows] = (np.take_along_axis(t, top, 1) for t in (all_s, all_i, all_d))
        rows = rows[~done[rows].all(1)]
    return seen


def range_search(x: np.ndarray, adj: np.ndarray, queries: np.ndarray, threshold: float,
                 beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (position in ``queries``, node) with cosine >= threshold, the query itself left out."""
    x32, start = x.astype(np.float32), medoid(x)
    out_q, out_n = [], []
    for i in range(0, len(queries), 256):
        part = queries[i:i + 256]
        seen, missed, width = beam_search(x32, adj, start, part, beam), None, beam
        while width < len(x):                               # a beam has to reach its own vector
            missed = np.flatnonzero(~seen[np.arange(len(part)), part])
            if not len(missed):
                break
            width = min(2 * width, len(x))
            seen[missed] |= beam_search(x32, adj, start, part[missed], width)
        seen[np.arange(len(part)), part] = True
        r, c = np.nonzero(seen)
        near = np.einsum("ij,ij->i", x32[part[r]], x32[c]) >= threshold - SLACK
        r, c = r[near], c[near]
        found_r, found_c = [r], [c]
        while len(r):                                       # expand along edges within the range
            new_r, new_c = [], []
            for j in range(0, len(r), 20_000):
                nbr = adj[c[j:j + 20_000]]
                k, e = np.nonzero(nbr >= 0)
                code = np.unique(r[j:j + 20_000][k].astype(np.int64) * len(x) + nbr[k, e])
                rr, cc = code // len(x), code % len(x)
                fresh = ~seen[rr, cc]
                rr, cc = rr[fresh], cc[fresh]
                seen[rr, cc] = True
                ok = np.einsum("ij,ij->i", x32[part[rr]], x32[cc]) >= threshold - SLACK
                new_r.append(rr[ok])
                new_c.append(cc[ok])
            r, c = np.concatenate(new_r), np.concatenate(new_c)
            found_r.append(r)
            found_c.append(c)
        r, c = np.concatenate(found_r), np.concatenate(found_c)
        for j in range(0, len(r), 100_000):                 # verified in double precision
            rr, cc = r[j:j + 100_000], c[j:j + 100_000]
            ok = (np.einsum("ij,ij->i", x[part[rr]], x[cc]) >= threshold) & (part[rr] != cc)
            out_q.append(i + rr[ok])
            out_n.append(cc[ok])
    none = [np.empty(0, np.int64)]
    return np.concatenate(out_q or none), np.concatenate(out_n or none)


def kmeans(x: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Unit centroids; those closer than cosine 0.9 to an earlier one are left out."""
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:k]]
    for _ in range(8):
        at = np.argmax(x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        size = np.linalg.norm(sums, axis=1)
        c = c.copy()
        c[size > 1e-9] = sums[size > 1e-9] / size[size > 1e-9, None]
    kept: list[np.ndarray] = []
    for row in c:
        if all(row @ other < 0.9 for other in kept):
            kept.append(row)
    return np.array(kept)


# --- shards -------------------------------------------------------------------------------

def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


ROWS = "path string, rep long, vec {}, size long, home boolean, side int"


def split_shards(classes: DataFrame, copies: int, shard: int = SHARD) -> DataFrame:
    """Rows (path, rep, vec, size, home, side) in which no path is above SHARD homes and copies;
    side is -1, or the block of a row in a pair of blocks."""
    rows = land(classes.select(F.concat_ws("|", "label", F.size("vec")).alias("path"), "rep", "vec",
                               "size", F.lit(True).alias("home"), F.lit(-1).alias("side")), "shards")
    while True:
        counts = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")) \
            .filter((F.col("n") > shard) & ~F.col("path").endswith("!"))
        counts = land(counts, "large")
        if counts.isEmpty():
            break
        rows = land(_split(rows, counts, copies, shard), "shards")
    blocks = land(rows.filter(F.col("path").endswith("!")).groupBy("path")
                  .agg(F.ceil(F.count(F.lit(1)) / F.lit(shard / 2)).alias("b")), "blocks")
    if blocks.isEmpty():
        return rows
    own = F.pmod(F.xxhash64("rep"), F.col("b"))
    pairs = (rows.join(blocks, "path").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("b") - 1)))
             .select(F.concat("path", F.least("own", "other").cast("string"), F.lit("-"),
                              F.greatest("own", "other").cast("string")).alias("path"),
                     "rep", "vec", "size", "home", F.col("own").cast("int").alias("side")))
    return rows.filter(~F.col("path").endswith("!")).unionByName(pairs)


def _split(rows: DataFrame, counts: DataFrame, copies: int, shard: int) -> DataFrame:
    share = F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < F.lit(1 << 20) * F.lit(SAMPLE) / F.col("n")
    sample = rows.filter("home").join(counts, "path").filter(share).select("path", "n", "vec")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:              # about SAMPLE rows
        x = unit(np.stack(pdf["vec"]))
        k = int(min(SPLIT, max(2, -(-2 * int(pdf["n"].iloc[0]) // shard))))
        c = kmeans(x, k)
        return pd.DataFrame({"path": [pdf["path"].iloc[0]], "centres": [c.reshape(-1).tolist()]})

    centres = sample.groupBy("path").applyInPandas(fit, "path string, centres array<double>")
    known = rows.join(counts.select("path", F.lit(True).alias("large")), "path", "left") \
        .join(centres, "path", "left")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            vecs = b.column(2)
            cols = [b.column(i).to_pylist() for i in (0, 1, 3, 4, 6, 7)]
            fitted: dict[str, np.ndarray] = {}
            for i, (path, rep, size, home, large, centre) in enumerate(zip(*cols)):
                if not large:
                    out.append((path, rep, i, size, home))
                    continue
                x = unit(np.asarray(vecs[i].as_py())[None])[0]
                if path not in fitted:
                    fitted[path] = np.array(centre or []).reshape(-1, len(x))
                c = fitted[path]
                if len(c) < 2:                               # one clump: dealt into blocks
                    out.append((path + "!", rep, i, size, home))
                    continue
                order = np.argsort(-(c @ x), kind="stable")[:1 + copies if home else 1].tolist()
                out += [(f"{path}/{j}", rep, i, size, home and not k) for k, j in enumerate(order)]
            take = pa.array([o[2] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int64()),
                 vecs.take(take), pa.array([o[3] for o in out], pa.int64()),
                 pa.array([o[4] for o in out], pa.bool_()), pa.array([-1] * len(out), pa.int32())],
                names=["path", "rep", "vec", "size", "home", "side"])

    return known.select("path", "rep", "vec", "size", "home", "side", "large", "centres") \
        .mapInArrow(deal, ROWS.format(rows.schema["vec"].dataType.simpleString())).distinct()


def united_graph(rows: DataFrame) -> DataFrame:
    """(rep, links): the adjacency lists of every shard, united per vector."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        reps = pdf["rep"].to_numpy()
        lists = build(unit(np.stack(pdf["vec"])))
        return pd.DataFrame({"rep": reps, "links": [reps[ids].tolist() for ids in lists]})

    each = rows.groupBy("path").applyInPandas(run, "rep long, links array<long>")
    return each.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("links"))).alias("links"))


def search_shards(rows: DataFrame, graph: DataFrame, threshold: float, beam: int) -> DataFrame:
    """(a, b, n): b null: n vectors that a links with inside its home; else a pair whose other
    end is at home elsewhere (n: the size of b's class) or an edge of a shard's forest (n null)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep", kind="stable").reset_index(drop=True)
        x, reps, size = unit(np.stack(pdf["vec"])), pdf["rep"].to_numpy(), pdf["size"].to_numpy()
        home, side = pdf["home"].to_numpy(bool), pdf["side"].to_numpy()
        lists = []
        for ids in pdf["links"]:                             # neighbours that are in this shard
            at = np.searchsorted(reps, ids).clip(0, len(reps) - 1)
            lists.append(at[reps[at] == ids].astype(np.int32))
        queries = np.flatnonzero(home)
        q, node = range_search(x, padded(lists), queries, threshold, beam)
        a, b = queries[q], node
        if len(np.unique(side)) > 1:                         # a pair of blocks: links across only
            a, b = a[side[a] != side[b]], b[side[a] != side[b]]
        inside = home[b]
        code = np.unique(np.concatenate([a[inside] * len(x) + b[inside], b[inside] * len(x) + a[inside]]))
        a1, b1 = code // len(x), code % len(x)               # both directions, once
        count = np.bincount(a1, weights=size[b1], minlength=len(x)).astype(np.int64)
        root = np.arange(len(x))
        changed = True
        while changed:                                       # smallest position by links at home
            low = root.copy()
            np.minimum.at(low, a1, root[b1])
            low = low[low]
            changed, root = bool((low != root).any()), low
        tied = np.flatnonzero(root != np.arange(len(x)))
        some = np.flatnonzero(count)
        return pd.DataFrame({
            "a": np.concatenate([reps[some], reps[tied], reps[a[~inside]]]),
            "b": pd.array(np.concatenate([np.zeros(len(some), np.int64), reps[root[tied]], reps[b[~inside]]]),
                          dtype="Int64"),
            "n": np.concatenate([count[some], np.zeros(len(tied), np.int64), size[b[~inside]]]),
            "kind": np.repeat([0, 1, 2], [len(some), len(tied), int((~inside).sum())])})

    both = rows.join(graph, "rep")
    return both.groupBy("path").applyInPandas(run, "a long, b long, n long, kind long")


# --- the operator -------------------------------------------------------------------------

def _valid(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    kind = vectors.schema[vec_col].dataType.simpleString()   # floats stay floats, all else is double
    kind = kind if kind == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vec_col).cast(kind).alias("vec"))
    odd = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    some = F.exists("vec", lambda v: v != 0)
    return rows.filter("vec_id is not null and label is not null and vec is not null").filter(~odd & some)


def link_counts(classes: DataFrame, threshold: float, copies: int, beam: int,
                shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """(rep, linked): vectors of other classes linked with each class; and edges (a, b)."""
    rows = land(split_shards(classes, copies, shard), "sharded")
    graph = land(united_graph(rows), "graph")
    found = land(search_shards(rows, graph, threshold, beam), "found")
    low, high = F.least("a", "b"), F.greatest("a", "b")
    cross = land(found.filter("kind = 2").select(low.alias("a"), high.alias("b")).distinct(), "cross")
    sizes = classes.select(F.col("rep").alias("b"), "size")
    ends = cross.union(cross.select("b", "a")).join(sizes, "b").select("a", F.col("size").alias("n"))
    linked = found.filter("kind = 0").select("a", "n").union(ends) \
        .groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("linked"))
    return land(linked, "linked"), found.filter("kind = 1").select("a", "b").union(cross)


def audit_recall(classes: DataFrame, linked: DataFrame, threshold: float, audit: int = AUDIT) -> float:
    """Share of the links of a bounded query set, counted by brute force, that were found."""
    n = max(1, classes.count())
    cut = int((1 << 20) * min(1.0, audit / n)) + 1
    picked = classes.filter(F.pmod(F.xxhash64("rep", F.lit(5)), F.lit(1 << 20)) < cut) \
        .select("rep", "label", "vec").collect()             # about ``audit`` rows
    shared = classes.sparkSession.sparkContext.broadcast([tuple(r) for r in picked])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict = {}
        for rep, label, vec in shared.value:
            groups.setdefault((label, len(vec)), []).append((rep, vec))
        ready = {k: (np.array([r for r, _ in g]), unit(np.array([v for _, v in g]))) for k, g in groups.items()}
        total: dict[int, int] = {}
        for b in batches:
            labels, vecs = b.column(1).to_pylist(), b.column(2).to_pylist()
            size = b.column(3).to_numpy()
            where: dict = {}
            for i, (label, v) in enumerate(zip(labels, vecs)):
                where.setdefault((label, len(v)), []).append(i)
            for key, at in where.items():
                if key in ready:
                    reps, q = ready[key]
                    hit = q @ unit(np.array([vecs[i] for i in at])).T >= threshold
                    own = reps[:, None] == b.column(0).to_numpy()[at][None]
                    for r, s in zip(reps.tolist(), ((hit & ~own) * size[at]).sum(1).tolist()):
                        total[r] = total.get(r, 0) + s
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()),
                                          pa.array(list(total.values()), pa.int64())], names=["rep", "n"])

    true = classes.select("rep", "label", "vec", "size").mapInArrow(run, "rep long, n long") \
        .groupBy("rep").agg(F.sum("n").alias("n")).filter("n > 0")
    row = true.join(linked, "rep", "left").agg(
        F.sum("n").alias("all"), F.sum(F.least("n", F.coalesce("linked", F.lit(0)))).alias("got")).first()
    return 1.0 if not row["all"] else row["got"] / row["all"]


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id",
                    vec_col: str = "embedding", label_col: str = "label", copies: int = 1,
                    beam: int = BEAM, shard: int = SHARD) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept (vec_id = component_id).

    Rows that repeat an id are vectors of their own in n_links; a row without an id links with
    nothing and is kept under a null component.
    """
    valid = _valid(vectors, id_col, vec_col, label_col)
    classes = land(valid.groupBy("label", "vec").agg(F.min("vec_id").alias("rep"),
                                                     F.count(F.lit(1)).alias("size"))
                   .select("rep", "label", "vec", "size"), "classes")
    # one id may stand for several classes: they get ids of their own until the end
    classes = land(classes.withColumn("id", F.col("rep"))
                   .withColumn("rep", F.monotonically_increasing_id()), "numbered")
    for attempt in range(3):
        linked, edges = link_counts(classes, threshold, copies + attempt, beam << attempt, shard)
        recall = audit_recall(classes, linked, threshold)
        log.info("recall %.4f of the audited links with %d copies and beam %d", recall, copies + attempt,
                 beam << attempt)
        if recall >= RECALL:
            break
    if recall < LEAST_RECALL:
        raise RuntimeError(f"only {recall:.3f} of the audited links were found, also with beam {beam << 2}")
    joined = components(edges)
    named = classes.select("rep", "id", "label", "vec", "size").join(linked, "rep", "left") \
        .join(joined.withColumnRenamed("id", "rep"), "rep", "left") \
        .withColumn("component", F.coalesce("component", "rep"))
    lowest = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = named.join(lowest, "component").select(
        "label", "vec", (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    known = land(valid.join(named, ["label", "vec"]).select("vec_id", "n_links", "component_id"), "known")
    rest = vectors.select(F.col(id_col).alias("vec_id"))
    ids = F.col("vec_id")
    known = known.groupBy("vec_id").agg(F.max("n_links").alias("n_links"),
                                        F.min("component_id").alias("component_id"))
    out = rest.join(known, "vec_id", "left")
    return out.select(ids, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", ids).alias("component_id"),
                      ids.eqNullSafe(F.coalesce("component_id", ids)).alias("kept"))
