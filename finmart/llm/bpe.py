"""Byte-level BPE through a sentencepiece model that is serialised from a rank file.

Every byte is written as one printable character (the usual byte-level alphabet), every
vocabulary entry becomes a piece scored by its negative rank, and normalisation is the identity:
sentencepiece then merges exactly the pair that the rank order would merge first. Texts are cut
by the published pattern before any merge; pieces never cross a cut. Decoding maps ids back to
their bytes. Ids travel as binary columns of little-endian unsigned 32-bit integers
(``ids_to_array`` unpacks them). A null text is an empty one: no ids, no bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import filterfalse, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept_in_worker

#: Distinct chunks and pre-tokens that a Python worker remembers (some 200 bytes each).
CACHE_ENTRIES = 500_000


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 as itself, others from 256 up."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Token bytes in rank order; ranks must be 0, 1, 2 ... without gaps."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks are not 0 ... n-1")
    return [ranks[r] for r in range(len(ranks))]


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece i is token i; the unknown piece comes last."""
    from sentencepiece import sentencepiece_model_pb2 as spm

    sign = byte_alphabet()
    model = spm.ModelProto()
    for rank, token in enumerate(tokens):
        piece = model.pieces.add()
        piece.piece, piece.score = "".join(sign[b] for b in token), -float(rank)
        piece.type = spm.ModelProto.SentencePiece.NORMAL
    unknown = model.pieces.add()
    unknown.piece, unknown.type = "<unk>", spm.ModelProto.SentencePiece.UNKNOWN
    spec = model.trainer_spec
    spec.model_type, spec.vocab_size, spec.unk_id = 2, len(tokens) + 1, len(tokens)
    spec.bos_id = spec.eos_id = spec.pad_id = -1
    norm = model.normalizer_spec
    norm.name, norm.add_dummy_prefix = "identity", False
    norm.remove_extra_whitespaces, norm.escape_whitespaces = False, False
    return model.SerializeToString()


class ChunkCache(dict):
    """Ids (packed bytes) of text chunks.

    A text is first cut at its single spaces. Between two other characters no match of the
    pattern crosses such a cut, so one look-up serves a whole word with its punctuation; the key
    of a chunk is the text after the space (the first chunk of a text, which has none, is encoded
    by itself). An empty chunk or one that begins or ends with white space lay beside a longer
    run: it is remembered as None, and its text is cut by the pattern as a whole.
    """

    def __init__(self, pattern: str, encode_new, entries: int = CACHE_ENTRIES):
        import regex

        super().__init__()
        self.entries = entries
        self.find = regex.compile(pattern).findall
        self.encode_new = encode_new        # list of pre-tokens -> list of packed ids
        self.pieces: dict[str, bytes] = {}  # pre-tokens that are no word after a space

    def _learn(self, chunks: set[str]) -> None:
        """Encode new chunks. A word before one stop or comma shares the entry of the bare word."""
        bare, stopped, other = list(filter(str.isalpha, chunks)), [], []
        for c in chunks.difference(bare):
            if not c or c[0].isspace() or c[-1].isspace():
                self[c] = None
            elif c[-1] in ".," and c[:-1].isalpha():
                stopped.append((c, c[:-1]))
            else:
                other.append((c, self.find(" " + c)))
        bare += {w for _, w in stopped if w not in self}.difference(bare)
        self.update(zip(bare, self.encode_new([" " + w for w in bare])))
        self._learn_pieces({".", ",", *(p for _, ps in other for p in ps)})
        at = self.pieces.__getitem__
        self.update((c, self[w] + at(c[-1])) for c, w in stopped)
        self.update((c, b"".join(map(at, ps))) for c, ps in other)

    def _learn_pieces(self, wanted: set[str]) -> None:
        new = [p for p in wanted if p not in self.pieces]
        if new:
            self.pieces.update(zip(new, self.encode_new(new)))

    def _shrink(self) -> None:
        """Keep the entries that came first: frequent words come early."""
        for cache in (self, self.pieces):
            if len(cache) > self.entries:
                old = dict(islice(cache.items(), self.entries // 2))
                cache.clear()
                cache.update(old)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        self._shrink()
        cut = [t.split(" ") if t else [] for t in texts]
        new: set[str] = set()   # one look-up a chunk; ``difference`` would go through all entries
        for chunks in cut:
            new.update(filterfalse(self.__contains__, chunks))
        self._learn(new)
        out, at = [], self.__getitem__
        for t, chunks in zip(texts, cut):
            try:
                rest = b"".join(map(at, chunks[1:]))
                if not chunks or at(chunks[0]) is None:
                    raise TypeError
                out.append(self._whole(chunks[0]) + rest)
            except TypeError:   # nothing, or an unsafe chunk
                out.append(self._whole(t) if t else b"")
        return out

    def _whole(self, text: str) -> bytes:
        found = self.find(text)
        self._learn_pieces(set(found))
        return b"".join(map(self.pieces.__getitem__, found))


class Codec:
    """Encoder and decoder of one rank file; built once per Python worker."""

    def __init__(self, path: str, pattern: str):
        import sentencepiece

        self.tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(
            model_proto=serialise_model(self.tokens))
        self.sign = dict(enumerate(byte_alphabet()))
        self.decimal = [str(i) for i in range(len(self.tokens))]
        self.cache = ChunkCache(pattern, self._merge)

    @classmethod
    def of(cls, path: str, pattern: str) -> "Codec":
        return kept_in_worker(("bpe", path, pattern), lambda: cls(path, pattern))

    def _merge(self, pre_tokens: list[str]) -> list[bytes]:
        mapped = [p.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.sign)
                  for p in pre_tokens]
        return [np.asarray(ids, dtype="<u4").tobytes()
                for ids in self.model.encode(mapped, num_threads=1)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return self.cache.encode(texts)

    def decode(self, packed: bytes | None) -> bytes:
        return b"".join(map(self.tokens.__getitem__, _ids(packed)))

    def decimals(self, packed: bytes | None) -> str:
        return " ".join(map(self.decimal.__getitem__, _ids(packed)))


def _ids(packed: bytes | None) -> list[int]:
    return np.frombuffer(packed or b"", dtype="<u4").tolist()


#: Texts are worked on in slices of about this many characters, whatever Arrow's batch holds.
SLICE_CHARS = 2_000_000


def slices(texts: list) -> Iterator[list]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t) if t else 0
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode(text: Column, path: str, pattern: str) -> Column:
    """Packed ids of a text column."""
    @F.pandas_udf("binary")
    def bpe_encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec.of(path, pattern)
        for s in batches:
            yield pd.Series([ids for part in slices(s.tolist()) for ids in codec.encode(part)],
                            dtype=object)
    return bpe_encode(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """Bytes of packed ids: UTF-8 again for any text that was encoded."""
    @F.pandas_udf("binary")
    def bpe_decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec.of(path, pattern)
        for s in batches:
            yield pd.Series([codec.decode(x) for x in s], dtype=object)
    return bpe_decode(ids)


def decimal_text(ids: Column, path: str, pattern: str) -> Column:
    """The ids in decimal, joined by one space."""
    @F.pandas_udf("string")
    def bpe_decimal(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec.of(path, pattern)
        for s in batches:
            yield pd.Series([codec.decimals(x) for x in s], dtype=object)
    return bpe_decimal(ids)


def ids_to_array(ids: Column) -> Column:
    """Packed ids as array<long>."""
    @F.pandas_udf("array<long>")
    def bpe_unpack(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([_ids(x) for x in s], dtype=object)
    return bpe_unpack(ids)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, decimals, decoded): every text encoded, its ids in decimal joined by one
    space, and the bytes that the ids decode to; one pass in one Python worker a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path, pattern)
        for rows in batches:
            at = 0
            for part in slices(rows.column(1).to_pylist()):
                ids = codec.encode(part)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).slice(at, len(part)), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array([codec.decimals(x) for x in ids], pa.string()),
                     pa.array([codec.decode(x) for x in ids], pa.binary())],
                    names=["doc_id", "n_tokens", "decimals", "decoded"])
                at += len(part)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")) \
        .mapInArrow(run, "doc_id long, n_tokens long, decimals string, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Encode every text, decode the ids again: id, n_tokens, ids_sha256, decoded_sha256."""
    return round_trip(docs, path, pattern, id_col, text_col).select(
        "doc_id", "n_tokens", F.sha2("decimals", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
