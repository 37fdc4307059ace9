"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors are quantised (each component x becomes floor(256 x)), ordered along a Hilbert curve through
all their dimensions, and written as Parquet blocks of ``BLOCK_ROWS`` rows with a zone map: the least
and the largest value in each dimension, and the label if the block has only one. An anchor's inner
product with any row of a block lies between two sums that interval arithmetic gives from the zone
map, so a block is read for an anchor only if that interval meets one of the anchor's score windows.

A search first reads the anchor's home block, the one that the curve put it into. If that already
holds enough rows for a window, the last of them is a floor that other blocks must reach. Then
every anchor group meets every page of zone maps (a stated set of queries against all rows, in
blocks), and the blocks whose bounds pass are read and scored. One search among rows of the anchor's
own label gives its positives; a second one among the other labels has a window for each positive:
scores from ``low_percent`` of the positive's score up to that score. The result is exact: bounds
only decide what need not be read.

Defined results: rows with a NULL id, label or vector, or with a NULL or non-finite component, take no
part; equal rows (id, label and vector) count once, other rows with a repeated id are rows of their own,
and no row with the anchor's id is a candidate of that anchor; only vectors of the same length are
compared (empty vectors score 0 with each other); quantised components saturate at +-2^26, so that no
score leaves the long range below 2^10 dimensions; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import land

BLOCK_ROWS = 1024
#: Blocks of a page of zone maps (about half a MB at 64 dimensions).
PAGE_BLOCKS = 1024
#: Bits a dimension of the curve, and the quantised values between which it tells places apart.
CURVE_BITS, CURVE_REACH = 4, 128
MOST = 1 << 26
LEAST_SCORE, MOST_SCORE = -(1 << 62), 1 << 62

VECTORS = "dim int, key binary, id long, label long, q binary"
BLOCKS = ("block long, dim int, ids binary, labels binary, q binary, least binary, most binary, "
          "label long")
#: Anchors of one home block: ``pos`` places there; ``low``, ``high``, ``floor`` windows by anchor.
PACK = ("home long, dim int, pos binary, ids binary, labels binary, q binary, low binary, "
        "high binary, floor binary")
HITS = "home long, pos int, slot int, anchor_id long, id long, score long"
_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, (_, t) in zip(columns, fields)],
                                      names=[n for n, _ in fields])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for k in range(b.num_rows):   # a row at a time: packed rows are large
            yield {name: b.column(c)[k].as_py() for c, name in enumerate(b.schema.names)}


def _ints(raw: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(raw, kind)


# --- vectors, curve, blocks ----------------------------------------------------------------------

def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places along the Hilbert curve of rows of integer coordinates below 2^bits (the usual
    transposed form: undo the rotations from the high bit down, Gray code, interleave)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    if not dims:
        return [b""] * cells.shape[0]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for k in range(dims):
            set_ = (x[k] >> bit & 1).astype(bool)
            swap = np.where(set_, 0, (x[0] ^ x[k]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[k] ^= swap if k else 0
    for k in range(1, dims):
        x[k] ^= x[k - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= turn
    planes = [x >> bit & 1 for bit in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, vector) to ``VECTORS``, without the rows that take no part."""
    for b in batches:
        by_dim: dict[int, list] = {}
        for k, (i, label) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
            vector = b.column(2)[k]
            if i is None or label is None or not vector.is_valid:
                continue
            values = vector.values
            if values.null_count:
                continue
            x = np.asarray(values.to_numpy(zero_copy_only=False), np.float64)
            if np.isfinite(x).all():
                by_dim.setdefault(len(x), []).append((i, label, x))
        for dim, rows in by_dim.items():
            x = np.array([r[2] for r in rows]).reshape(len(rows), dim)
            with np.errstate(over="ignore"):
                q = np.clip(np.floor(256 * x), -MOST, MOST).astype(np.int32)
            cells = (np.clip(q, -CURVE_REACH, CURVE_REACH - 1) + CURVE_REACH) \
                * (1 << CURVE_BITS) // (2 * CURVE_REACH)
            keys = hilbert_keys(cells, CURVE_BITS)
            yield _batch(VECTORS, [(dim, key, i, label, row.tobytes())
                                   for key, (i, label, _), row in zip(keys, rows, q)])


def _pack_blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows in curve order to blocks; inside a block rows stand by id."""
    first, made = TaskContext.get().partitionId() << 32, 0
    rows: list[dict] = []

    def block() -> pa.RecordBatch:
        nonlocal made
        rows.sort(key=lambda r: r["id"])
        dim = rows[0]["dim"]
        q = np.array([_ints(r["q"], np.int32) for r in rows], np.int32).reshape(len(rows), dim)
        labels = {r["label"] for r in rows}
        made += 1
        return _batch(BLOCKS, [(
            first + made - 1, dim, np.array([r["id"] for r in rows], np.int64).tobytes(),
            np.array([r["label"] for r in rows], np.int64).tobytes(), q.tobytes(),
            q.min(0).tobytes(), q.max(0).tobytes(), labels.pop() if len(labels) == 1 else None)])

    for r in _rows(batches):
        if rows and (len(rows) == size or rows[0]["dim"] != r["dim"]):
            yield block()
            rows = []
        rows.append(r)
    if rows:
        yield block()


def write_blocks(vectors: DataFrame, id_col: str, label: Column, vector_col: str,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The candidate blocks (``BLOCKS``) as a landed Parquet table."""
    rows = vectors.select(F.col(id_col).cast("long"), label.cast("long"), F.col(vector_col)) \
        .mapInArrow(quantise, VECTORS).distinct()   # repeated rows meet before the exchange
    order = ["dim", "key", "id"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return land(ranged.mapInArrow(partial(_pack_blocks, size=block_rows), BLOCKS), "blocks")


def zone_pages(blocks: DataFrame, page_blocks: int = PAGE_BLOCKS) -> tuple[DataFrame, int]:
    """Zone maps by pages (page, zones), and the number of pages."""
    n = max(1, -(-blocks.count() // page_blocks))
    page = F.pmod(F.xxhash64("block"), F.lit(n))
    zones = F.collect_list(F.struct("block", "dim", "least", "most", "label")).alias("zones")
    return land(blocks.groupBy(page.alias("page")).agg(zones), "zones"), n


def _anchors(every: int):
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            ids = _ints(r["ids"])
            pos = np.flatnonzero(ids % every == 0).astype(np.int32)
            if len(pos):
                q = _ints(r["q"], np.int32).reshape(len(ids), r["dim"])[pos]
                low, high = (np.full(len(pos), v, np.int64) for v in (LEAST_SCORE, MOST_SCORE))
                yield _batch(PACK, [(r["block"], r["dim"], pos.tobytes(), ids[pos].tobytes(),
                                     _ints(r["labels"])[pos].tobytes(), q.tobytes(),
                                     low.tobytes(), high.tobytes(), low.tobytes())])
    return pick


# --- search --------------------------------------------------------------------------------------

def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: in double where no sum can reach 2^53."""
    top = (int(np.abs(a).max(initial=0)) + 1) * (int(np.abs(b).max(initial=0)) + 1) * max(1, a.shape[1])
    kind = np.float64 if top < 1 << 53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def score_bounds(q: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest possible inner product of each row of ``q`` with rows in each zone."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return products(up, least) + products(down, most), products(up, most) + products(down, least)


class Pack:
    """The arrays of one row of packed anchors."""

    def __init__(self, row: dict):
        self.home, self.dim = row["home"], row["dim"]
        self.pos, self.ids, self.labels = _ints(row["pos"], np.int32), _ints(row["ids"]), _ints(row["labels"])
        m = len(self.ids)
        self.q = _ints(row["q"], np.int32).reshape(m, self.dim)
        self.low, self.high, self.floor = (_ints(row[c]).reshape(m, -1) for c in ("low", "high", "floor"))

    def some(self, at: np.ndarray) -> tuple:
        """The chosen anchors as a row of ``PACK``."""
        return (self.home, self.dim, *(np.ascontiguousarray(x[at]).tobytes() for x in (
            self.pos, self.ids, self.labels, self.q, self.low, self.high, self.floor)))


def _choose(same: bool):
    """(pack, page of zones) rows to (block, pack of the anchors that must read it) rows."""
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            pack = Pack(r)
            zones = [z for z in r["zones"] if z["dim"] == pack.dim and z["block"] != pack.home]
            if not zones:
                continue
            least, most = (np.array([_ints(z[c], np.int32) for z in zones]).reshape(len(zones), pack.dim)
                           for c in ("least", "most"))
            down, up = (x[:, :, None] for x in score_bounds(pack.q, least, most))
            low = np.maximum(pack.low, pack.floor)[:, None, :]
            high = pack.high[:, None, :]
            need = ((up >= low) & (down <= high) & (low <= high)).any(2)
            for k, z in enumerate(zones):
                if z["label"] is not None:   # a block of one label
                    need[:, k] &= (pack.labels == z["label"]) == same
            out = [(zones[k]["block"], *pack.some(need[:, k])) for k in np.flatnonzero(need.any(0)).tolist()]
            for start in range(0, len(out), 256):
                yield _batch("block long, " + PACK, out[start:start + 256])
    return choose


def _score(same: bool, top: int):
    """(pack, block) rows to the best ``top`` rows of each window in that block."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            pack = Pack(r)
            ids, labels = _ints(r["block_ids"]), _ints(r["block_labels"])
            s = products(pack.q, _ints(r["block_q"], np.int32).reshape(len(ids), pack.dim))
            may = ((pack.labels[:, None] == labels) == same) & (pack.ids[:, None] != ids)
            for slot in range(pack.low.shape[1]):
                low = np.maximum(pack.low[:, slot], pack.floor[:, slot])[:, None]
                a, b = np.nonzero(may & (s >= low) & (s <= pack.high[:, slot, None]))
                if not len(a):
                    continue
                order = np.lexsort((b, -s[a, b], a))   # rows of a block stand by id
                a, b = a[order], b[order]
                rank = np.arange(len(a)) - np.searchsorted(a, a)
                a, b = a[rank < top], b[rank < top]
                n = len(a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, pack.home)), pa.array(pack.pos[a]),
                     pa.array(np.full(n, slot, np.int32)), pa.array(pack.ids[a]), pa.array(ids[b]),
                     pa.array(s[a, b])], names=[f.split()[0] for f in HITS.split(", ")])
    return score


def _read(pairs: DataFrame, blocks: DataFrame, same: bool, top: int) -> DataFrame:
    columns = blocks.select("block", F.col("ids").alias("block_ids"), F.col("labels").alias("block_labels"),
                            F.col("q").alias("block_q"))
    return pairs.join(columns, "block").mapInArrow(_score(same, top), HITS)


def _raise_floors(top: int):
    """Windows that already have ``top`` hits need no score below the last of them."""
    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            pack = Pack(r)
            floor, at = pack.floor.copy(), {p: k for k, p in enumerate(pack.pos.tolist())}
            for w in r["full"] or ():
                floor[at[w["pos"]], w["slot"]] = max(w["least"], floor[at[w["pos"]], w["slot"]])
            pack.floor = floor
            yield _batch(PACK, [pack.some(np.arange(len(pack.ids)))])
    return update


def best(hits: DataFrame, top: int) -> DataFrame:
    """The first ``top`` hits of each window, with their ``rank``."""
    order = Window.partitionBy("home", "pos", "slot").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(packs: DataFrame, blocks: DataFrame, pages: DataFrame, n_pages: int, same: bool,
           top: int) -> DataFrame:
    """The best ``top`` rows of every window of every anchor, over all blocks."""
    seeds = land(_read(packs.withColumn("block", F.col("home")), blocks, same, top), "seeds")
    full = seeds.groupBy("home", "pos", "slot").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")) \
        .filter(F.col("n") >= top).groupBy("home").agg(   # at most a block's rows times its windows
            F.collect_list(F.struct("pos", "slot", "least")).alias("full"))
    aimed = land(packs.join(full, "home", "left").mapInArrow(_raise_floors(top), PACK), "aimed")
    meet = aimed.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(n_pages - 1)))).join(pages, "page")
    pairs = meet.mapInArrow(_choose(same), "block long, " + PACK)
    return land(best(seeds.unionByName(_read(pairs, blocks, same, top)), top), "hits")


def _windows(low_percent: int, slots: int):
    """Packs with their positives to packs with a window for each positive."""
    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            pack = Pack(r)
            at = {p: k for k, p in enumerate(pack.pos.tolist())}
            low = np.ones((len(at), slots), np.int64)     # from 1 to 0: nothing
            high = np.zeros((len(at), slots), np.int64)
            for p in r["found"] or ():
                score = p["score"]
                low[at[p["pos"]], p["rank"] - 1] = -(-low_percent * score // 100)
                high[at[p["pos"]], p["rank"] - 1] = score
            pack.low, pack.high, pack.floor = low, high, np.full_like(low, LEAST_SCORE)
            yield _batch(PACK, [pack.some(np.arange(len(at)))])
    return update


def mine(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
         label: Column | None = None, every: int = 100, positives: int = 5, negatives: int = 5,
         low_percent: int = 80, block_rows: int = BLOCK_ROWS, page_blocks: int = PAGE_BLOCKS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors,
    the rows whose id is divisible by ``every``."""
    blocks = write_blocks(vectors, id_col, F.col("label") if label is None else label, vector_col,
                          block_rows)
    pages, n_pages = zone_pages(blocks, page_blocks)
    packs = land(blocks.mapInArrow(_anchors(every), PACK), "anchors")
    good = search(packs, blocks, pages, n_pages, True, positives)
    found = good.groupBy("home").agg(F.collect_list(F.struct("pos", "rank", "score")).alias("found"))
    aimed = land(packs.join(found, "home", "left").mapInArrow(_windows(low_percent, positives), PACK),
                 "windows")
    bad = search(aimed, blocks, pages, n_pages, False, negatives)
    good = good.select("home", "pos", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"),
                       F.col("score").alias("positive_score"))
    return bad.join(good, ["home", "pos", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
