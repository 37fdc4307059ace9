"""Bounded-space online best-fit packing of documents into token sequences.

Documents become pieces: the ids of the text and one closing id; only documents longer than a
sequence are cut, into full sequences, and the first piece takes the remainder. A task packs its
pieces online, longest first: a fixed number of bins is open, kept in a bitset
keyed by free space, a piece goes into the open bin with the least space that holds it, and when
a bin must be opened beyond the limit the fullest one closes. Bins that are still open when a
task ends are packed again as single items, so that the ends of many tasks share sequences.

A null text is an empty one: its piece is the closing id alone. Repeated ids give repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import CACHE_ENTRIES, ChunkCache, slices
from .common import kept_in_worker, land

CLOSING_ID = 0
#: Open bins of a task. More bins mean fuller sequences; memory is a few words for each.
OPEN_BINS = 65_536
#: Pieces packed by one task (a sizing target: any number works).
TASK_PIECES = 60_000
#: New words that the library encodes as one string: few calls, and short strings cost least a word.
WORDS_A_CALL = 64


class _Tokenizer:
    """The vocabulary's own library behind a chunk cache; built once per Python worker."""

    def __init__(self, path: str, pattern: str, entries: int = CACHE_ENTRIES):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # one core a task
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.line = self.model.encode("\n", add_special_tokens=False).ids
        self.cache = ChunkCache(pattern, self._new, entries)
        self.added = [t.content for t in self.model.get_added_tokens_decoder().values()]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids as the library's own call gives them. A text that holds the string of an added
        token, which is one id there, is encoded whole."""
        out = self.cache.encode(texts)
        for k, t in enumerate(texts):
            if t and any(a in t for a in self.added):
                self.model.encode_special_tokens = False
                out[k] = np.asarray(self.model.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
                self.model.encode_special_tokens = True
        return out

    @classmethod
    def of(cls, path: str, pattern: str, entries: int = CACHE_ENTRIES) -> "_Tokenizer":
        return kept_in_worker(("packing", path, pattern, entries), lambda: cls(path, pattern, entries))

    def _new(self, pre_tokens: list[str]) -> list[bytes]:
        """Words of letters, after a space or not, are encoded many at a time, each followed by a
        line end, whose id then separates them; all else is encoded by itself."""
        words = [(p[1:] if p[:1] == " " else p).isalpha() for p in pre_tokens]
        together = iter(self._words(list(compress(pre_tokens, words))))
        alone = iter(self._singly([p for p, word in zip(pre_tokens, words) if not word]))
        return [next(together if word else alone) for word in words]

    def _words(self, words: list[str]) -> list[bytes]:
        groups = [words[i:i + WORDS_A_CALL] for i in range(0, len(words), WORDS_A_CALL)]
        out: list[bytes] = []
        for g, e in zip(groups, self.model.encode_batch_fast(["\n".join([*g, ""]) for g in groups],
                                                             add_special_tokens=False)):
            ids = np.asarray(e.ids, dtype="<u4")
            ends = np.flatnonzero(ids == self.line[0])
            if len(self.line) == 1 and len(ends) == len(g):
                raw, ends = ids.tobytes(), (4 * ends).tolist()
                out += [raw[i:j] for i, j in zip([0, *[4 + j for j in ends]], ends)]
            else:
                out += self._singly(g)
        return out

    def _singly(self, pre_tokens: list[str]) -> list[bytes]:
        done = self.model.encode_batch_fast(pre_tokens, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in done]


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; the first one takes the remainder."""
    first = n % size or min(n, size)
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


PIECES = "doc_id long, piece int, start long, length long, ids binary"


def pieces(docs: DataFrame, path: str, pattern: str, size: int = 2048, id_col: str = "doc_id",
           text_col: str = "text", cache_entries: int = CACHE_ENTRIES) -> DataFrame:
    """One row per piece with its ids (little-endian unsigned 32-bit integers). A worker remembers up
    to ``cache_entries`` chunks of text; fewer cost time, not results."""
    closing = np.asarray([CLOSING_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _Tokenizer.of(path, pattern, cache_entries)
        for rows in batches:
            docs, at = rows.column(0).to_pylist(), 0
            for part in slices(rows.column(1).to_pylist()):
                out = []
                for doc, ids in zip(docs[at:at + len(part)], tokenizer.encode(part)):
                    ids += closing
                    out += [(doc, k, s, n, ids[4 * s:4 * (s + n)])
                            for k, (s, n) in enumerate(cut(len(ids) // 4, size))]
                at += len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (
                        pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                    names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")) \
        .mapInArrow(run, PIECES)


class BestFit:
    """Online best fit with at most ``limit`` open bins of ``size`` tokens.

    Bit f of ``mask`` is set when some open bin has f tokens free; the lowest set bit at or above
    a piece's length is the best fit, the lowest set bit of all is the fullest bin.
    """

    def __init__(self, size: int, limit: int, first_bin: int = 0):
        self.size, self.limit, self.next = size, limit, first_bin
        self.mask, self.free, self.open = 0, [[] for _ in range(size + 1)], 0

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece of ``length`` tokens, 1 <= length <= size."""
        fits = self.mask >> length
        if fits:
            f = length + (fits & -fits).bit_length() - 1
            b = self._take(f)
        else:
            if self.open >= self.limit:
                self._take((self.mask & -self.mask).bit_length() - 1)   # the fullest closes
            f, b = self.size, self.next
            self.next += 1
        if f > length:
            self._put(b, f - length)
        return b, self.size - f

    def _take(self, f: int) -> int:
        b = self.free[f].pop()
        self.open -= 1
        if not self.free[f]:
            self.mask &= ~(1 << f)
        return b

    def _put(self, b: int, f: int) -> None:
        self.free[f].append(b)
        self.open += 1
        self.mask |= 1 << f

    def still_open(self) -> set[int]:
        return {b for bins in self.free for b in bins}


def _pack(items: DataFrame, size: int, limit: int, tasks: int, lane: int) -> DataFrame:
    """Every column of ``items`` plus bin, offset and whether the bin was open at the end.

    Pieces are dealt to tasks by a hash and arrive longest first, so large pieces open bins and
    small ones fill them; equal rows are interchangeable, so a retried task packs the same way.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema) \
        + ", bin long, offset long, open boolean"
    at_length = items.columns.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = (lane << 60) + (TaskContext.get().partitionId() << 36)
        fit, done = BestFit(size, limit, first), []
        for rows in batches:
            done.append((rows, [fit.place(n) for n in rows.column(at_length).to_pylist()]))
        last = fit.still_open()
        for rows, at in done:   # some tens of bytes a piece; a task has TASK_PIECES or so
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array([b for b, _ in at], pa.int64()),
                 pa.array([o for _, o in at], pa.int64()),
                 pa.array([b in last for b, _ in at], pa.bool_())],
                names=[*rows.schema.names, "bin", "offset", "open"])

    return (items.withColumn("__order", F.xxhash64(*items.columns))
            .repartition(tasks, "__order").sortWithinPartitions(F.desc("length"), "__order")
            .drop("__order").mapInArrow(run, schema))


def pack(items: DataFrame, size: int = 2048, open_bins: int = OPEN_BINS,
         task_pieces: int = TASK_PIECES) -> DataFrame:
    """Items (any narrow columns with a long ``length`` of 1 ... size) plus sequence_id and
    offset: gapless places in sequences.

    Ids are not meant to be shuffled here, only their keys and lengths. The first round is
    landed, because its bins are read twice.
    """
    n = max(1, items.count())
    tasks = -(-n // task_pieces)
    one = land(_pack(items, size, open_bins, tasks, 0), "pack")
    ends = one.filter("open").groupBy(F.col("bin").alias("was")).agg(F.sum("length").alias("length"))
    again = -(-min(tasks * open_bins, n) // task_pieces)
    two = _pack(ends, size, open_bins, again, 1).select(
        F.col("was").alias("bin"), F.col("bin").alias("joined"), F.col("offset").alias("base"))
    return (one.join(two, "bin", "left")
            .withColumn("sequence_id", F.coalesce("joined", "bin"))
            .withColumn("offset", F.col("offset") + F.coalesce("base", F.lit(0)))
            .drop("bin", "open", "joined", "base"))


def sequences(piece_rows: DataFrame, packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed training rows, ids joined in offset order.

    ``piece_rows`` needs unique (doc_id, piece). At most ``size`` one-token pieces meet in a
    sequence, so a group is bounded by design."""
    placed = piece_rows.select("doc_id", "piece", "ids").join(packed, ["doc_id", "piece"])
    return (placed.groupBy("sequence_id")
            .agg(F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids")))).alias("p"),
                 F.sum("length").alias("n_tokens"))
            .select("sequence_id", "n_tokens",
                    F.unhex(F.array_join(F.col("p.ids"), "")).alias("ids")))


def pack_documents(docs: DataFrame, path: str, pattern: str, size: int = 2048,
                   open_bins: int = OPEN_BINS, id_col: str = "doc_id",
                   text_col: str = "text", cache_entries: int = CACHE_ENTRIES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut_up = land(pieces(docs, path, pattern, size, id_col, text_col, cache_entries)
                  .withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return pack(cut_up, size, open_bins).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
