"""SentencePiece encoding and decoding for merge-type (BPE) models.

A text is normalised (spaces become U+2581, one is put in front) and cut into symbols of one
character. Adjacent symbols whose union is a piece of the vocabulary wait in an agenda ordered by
piece score, ties from the left; the best pair is merged and its new neighbours join the agenda
until it is empty. Symbols that are no piece fall back to their UTF-8 bytes, or to the unknown id.
Pieces of type "unused" steer merges and are split again at the end; user-defined pieces are
symbols from the start and never merge.

No piece of the usual vocabularies holds a space mark after another character, so a text may be cut
before such marks and every cut part (a word with the spaces before it) is merged once and
remembered. A vocabulary with such pieces, or with user-defined ones, is merged over whole texts.
In every Arrow batch the parts that are new are also encoded by the sentencepiece library, and a
difference stops the job (``check=False`` leaves the comparison out).

A null text is an empty one: no ids, an empty decoded text. Repeated rows, rows without an id and
extra columns are fine: there is one output row for each input row. Ids travel as binary columns of
little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import heapq
import re
import sys
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import slices
from .common import kept_in_worker

SPACE = "▁"
#: Parts that a Python worker remembers, and the longest part that it remembers.
CACHE_ENTRIES, CACHE_CHARS = 800_000, 64
#: Parts of up to so many characters, mark included, are merged side by side, in blocks of rows.
WIDTHS, BLOCK_ROWS = (8, 16, 32), 20_000
#: Piece types of the public model format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class Vocabulary:
    """Pieces, scores and rules of one model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as spm

        model = spm.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        if model.trainer_spec.model_type != 2 or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError(f"{path}: not a merge-type model with leading space marks")
        norm = model.normalizer_spec
        self.prefix = norm.add_dummy_prefix
        self.squeeze = norm.remove_extra_whitespaces
        self.plain = not norm.precompiled_charsmap and not self.squeeze and norm.escape_whitespaces
        self.pieces = [p.piece for p in model.pieces]
        self.kinds = [p.type for p in model.pieces]
        self.unknown = self.kinds.index(UNKNOWN)
        self.unknown_text = model.trainer_spec.unk_surface
        self.merged = {p.piece: (k, p.score) for k, p in enumerate(model.pieces)
                       if p.type in (NORMAL, USER_DEFINED, UNUSED)}
        self.bytes = {p.piece: k for k, p in enumerate(model.pieces) if p.type == BYTE}
        self.byte_ids = [self.bytes[f"<0x{b:02X}>"] for b in range(256)] if self.bytes else None
        self.byte_of = {k: b for b, k in enumerate(self.byte_ids)} if self.bytes else {}
        own = sorted((p for p, k in zip(self.pieces, self.kinds) if k == USER_DEFINED), key=len)
        self.own = re.compile("|".join(map(re.escape, reversed(own)))) if own else None
        self.cuttable = (self.plain and self.prefix and not own and (SPACE in self.merged or self.bytes)
                         and not any(SPACE in p.lstrip(SPACE) for p in self.merged))
        self.odd = {k for k, kind in enumerate(self.kinds) if kind in (UNKNOWN, CONTROL)}
        self.last_odd = max(self.odd)

    # --- encoding -------------------------------------------------------------------------

    def symbols(self, text: str) -> list[tuple[str, bool]]:
        """(symbol, may it merge) for a normalised text."""
        if not self.own:
            return [(c, True) for c in text]
        out, at = [], 0
        for m in self.own.finditer(text):
            out += [(c, True) for c in text[at:m.start()]]
            out.append((m.group(), False))
            at = m.end()
        return out + [(c, True) for c in text[at:]]

    def merge(self, text: str) -> list[str]:
        """The pieces of a normalised text after all merges of the agenda."""
        first = self.symbols(text)
        part, free = [s for s, _ in first], [f for _, f in first]
        n = len(part)
        left_of, right_of = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[float, int, int, str]] = []
        merged, unused = self.merged, {}

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and free[a] and free[b]:
                union = part[a] + part[b]
                hit = merged.get(union)
                if hit:
                    heapq.heappush(agenda, (-hit[1], a, b, union))
                    if self.kinds[hit[0]] == UNUSED:
                        unused[union] = part[a], part[b]

        for k in range(n - 1):
            offer(k, k + 1)
        while agenda:
            _, a, b, union = heapq.heappop(agenda)
            if not part[a] or not part[b] or len(part[a]) + len(part[b]) != len(union):
                continue   # one of the two has been merged with another since
            part[a], part[b] = union, ""
            right_of[a] = after = right_of[b]
            if after >= 0:
                left_of[after] = a
            offer(left_of[a], a)
            offer(a, after)
        out = [p for p in part if p]
        return [q for p in out for q in _split(p, unused)] if unused else out

    def ids(self, text: str) -> list[int]:
        """Ids of a normalised text."""
        out: list[int] = []
        lost = False   # the symbol before was unknown: a run of such shares one id
        for p in self.merge(text):
            hit = self.merged.get(p)
            if hit:
                out.append(hit[0])
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in p.encode("utf-8", "surrogatepass")]
            elif not lost:
                out.append(self.unknown)
            lost = not hit
        return out

    # --- decoding -------------------------------------------------------------------------

    def odd_in(self, packed: bytes | None) -> bool:
        """Whether packed ids hold control or unknown ids."""
        ids = np.frombuffer(packed or b"", "<u4")
        return bool((ids <= self.last_odd).any()) and not self.odd.isdisjoint(ids.tolist())

    def decode(self, ids: list[int]) -> str:
        """The text of ids. The space mark in front of the first piece is the one that encoding
        put there; bytes that are no UTF-8 become one U+FFFD each."""
        out: list[str] = []
        run, started, mark_seen = bytearray(), False, False
        for k in ids:
            if k in self.byte_of:
                run.append(self.byte_of[k])
                continue
            if run:
                out.append(_utf8(run))
                run, started = bytearray(), True
            start = not started and not mark_seen
            mark_seen = False
            if self.kinds[k] == CONTROL:
                continue
            p = self.unknown_text if k == self.unknown else self.pieces[k]
            if k != self.unknown and start and (self.prefix or self.squeeze) and p.startswith(SPACE):
                p, mark_seen = p[1:], not self.squeeze
            started = started or bool(p)
            out.append(p if k == self.unknown else p.replace(SPACE, " "))
        if run:
            out.append(_utf8(run))
        return "".join(out)


class Rows:
    """The agendas of many short parts side by side: each part is a row of symbols with the score of
    every adjacent pair; in a step all rows merge their best pair, the leftmost of equal ones."""

    def __init__(self, words: Vocabulary):
        self.words = words
        self.size = len(words.pieces)           # symbols from here on: characters that are no piece
        self.stride = self.size + sys.maxunicode + 1
        symbol = {p: k for p, (k, _) in words.merged.items()}
        pairs = {}
        for p, k in symbol.items():
            for cut in range(1, len(p)):
                a, b = (symbol.get(x, self.size + ord(x) if len(x) == 1 else None)
                        for x in (p[:cut], p[cut:]))
                if a is not None and b is not None:
                    pairs[a * self.stride + b] = k
        self.keys = np.array(sorted(pairs), np.int64)
        self.union = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        self.score = np.full(self.size + 1, -np.inf, np.float32)   # the last one: no union
        self.score[list(symbol.values())] = [score for _, score in words.merged.values()]
        self.of_char = np.arange(sys.maxunicode + 1, dtype=np.int32) + self.size
        for p, k in symbol.items():
            if len(p) == 1:
                self.of_char[ord(p)] = k

    def _unions(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece of each pair of symbols, or ``size`` where there is none."""
        key = a.astype(np.int64) * self.stride + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (b >= 0) & (a >= 0), self.union[at], self.size)

    def _symbols(self, parts: list[str], width: int) -> np.ndarray:
        """Symbols of the marked parts, one row a part, filled up with -1."""
        text = SPACE + SPACE.join(parts)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        lengths = np.array([len(p) + 1 for p in parts])
        out = np.full((len(parts), width), -1, np.int32)
        out[np.arange(width) < lengths[:, None]] = self.of_char[codes]
        return out

    def _merge(self, rows: np.ndarray) -> np.ndarray:
        done, place = rows.copy(), np.arange(len(rows))
        union = self._unions(rows[:, :-1], rows[:, 1:])
        column = np.arange(rows.shape[1])
        while len(place):
            score = self.score[union]
            at = score.argmax(1)
            every = np.arange(len(rows))
            live = np.isfinite(score[every, at])
            if not live.all():   # rows with an empty agenda are finished
                done[place[~live]] = rows[~live]
                rows, union, place, at = rows[live], union[live], place[live], at[live]
                every = every[:len(rows)]
            if not len(rows):
                break
            made = union[every, at]
            later = column > at[:, None]   # what stands behind the pair moves up by one
            rows[:, :-1] = np.where(later[:, :-1], rows[:, 1:], rows[:, :-1])
            rows[:, -1] = -1
            rows[every, at] = made
            union[:, :-1] = np.where(later[:, :-2], union[:, 1:], union[:, :-1])
            union[:, -1] = self.size
            union[every, at] = self.size   # nothing follows the last symbol
            inner = at < union.shape[1]
            e, j = every[inner], at[inner]
            union[e, j] = self._unions(rows[e, j], rows[e, j + 1])
            inner = at > 0
            e, j = every[inner], at[inner]
            union[e, j - 1] = self._unions(rows[e, j - 1], rows[e, j])
        return done

    def ids(self, parts: list[str]) -> list[bytes]:
        """Packed ids of parts shorter than the last of ``WIDTHS``, given without their mark."""
        out: list[bytes] = [b""] * len(parts)
        low = 0
        lengths = np.array([len(p) + 1 for p in parts])
        for width in WIDTHS:
            chosen = np.flatnonzero((lengths > low) & (lengths <= width))
            low = width
            for start in range(0, len(chosen), BLOCK_ROWS):
                block = chosen[start:start + BLOCK_ROWS].tolist()
                self._pack(self._merge(self._symbols([parts[k] for k in block], width)), block, out)
        return out

    def _pack(self, rows: np.ndarray, block: list[int], out: list[bytes]) -> None:
        words = self.words
        if words.byte_ids:   # a lost ASCII character is one byte
            single = (rows >= self.size) & (rows < self.size + 128)
            rows[single] = np.array(words.byte_ids)[rows[single] - self.size]
        lost = (rows >= self.size).any(1)
        flat = rows[rows >= 0].astype("<u4").tobytes()
        ends = (4 * (rows >= 0).sum(1).cumsum()).tolist()
        at = 0
        for k, end in zip(block, ends):
            out[k] = flat[at:end]
            at = end
        for k in np.flatnonzero(lost).tolist():
            ids: list[int] = []
            for s in rows[k][rows[k] >= 0].tolist():
                if s < self.size:
                    ids.append(s)
                elif words.byte_ids:
                    ids += [words.byte_ids[b] for b in chr(s - self.size).encode("utf-8", "surrogatepass")]
                elif not ids or ids[-1] != words.unknown:
                    ids.append(words.unknown)
            out[block[k]] = np.asarray(ids, "<u4").tobytes()




def _split(piece: str, unused: dict[str, tuple[str, str]]) -> list[str]:
    """Undo the merges that made a piece of type "unused"."""
    out, todo = [], [piece]
    while todo:
        p = todo.pop()
        if p in unused:
            todo += reversed(unused[p])
        else:
            out.append(p)
    return out


def _utf8(run: bytearray) -> str:
    """Text of a run of bytes, one U+FFFD for each byte that begins no whole character."""
    raw, at, out = bytes(run), 0, []
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at:at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            at += 1
    return "".join(out)


class Codec:
    """Encoder and decoder of one model file with a memory of parts; one a Python worker."""

    def __init__(self, path: str, check: bool = True):
        import sentencepiece

        self.words = Vocabulary(path)
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.check = check
        self.memory: dict[str, bytes] = {}
        self.rows = Rows(self.words) if self.words.cuttable and UNUSED not in self.words.kinds else None
        self.decimal = Strings([b"%d," % k for k in range(len(self.words.pieces))])
        raw = [p.replace(SPACE, " ").encode("utf-8", "surrogatepass") for p in self.words.pieces]
        for k, b in self.words.byte_of.items():
            raw[k] = bytes([b])
        self.raw = Strings(raw)
        self.parts_of = re.compile(f"{SPACE}+[^{SPACE}]*").findall

    @classmethod
    def of(cls, path: str, check: bool = True) -> "Codec":
        return kept_in_worker(("pieces", path, check), lambda: cls(path, check))

    def normalise(self, text: str) -> str:
        if not text:
            return ""
        if not self.words.plain:   # character maps are applied by the library
            return self.library.normalize(text)
        return (SPACE if self.words.prefix else "") + text.replace(" ", SPACE)

    def parts(self, text: str) -> list[str]:
        """The parts of a text, without the space mark that each of them begins with."""
        if "  " not in text and SPACE not in text and text[0] != " ":
            cut = text.split(" ")
            if cut[-1]:
                return cut
        return [p[1:] for p in self.parts_of(SPACE + text.replace(" ", SPACE))]

    def _learn(self, new: list[str]) -> None:
        """Merge new parts; the library encodes the same parts (it puts the mark in front)."""
        short = [p for p in new if len(p) < WIDTHS[-1]] if self.rows else []
        long = [p for p in new if len(p) >= WIDTHS[-1]] if self.rows else new
        found = self.rows.ids(short) if short else []
        found += [np.asarray(self.words.ids(SPACE + p), "<u4").tobytes() for p in long]
        if self.check:
            self._compare([p.replace(SPACE, " ") for p in chain(short, long)], found)
        self.memory.update(zip(chain(short, long), found))

    def _compare(self, texts: list[str], found: list[bytes]) -> None:
        asked = [k for k, t in enumerate(texts) if t]   # the library adds no mark to nothing
        theirs = self.library.encode([texts[k] for k in asked], num_threads=1)
        flat = np.fromiter(chain.from_iterable(theirs), "<u4").tobytes()
        if (flat == b"".join([found[k] for k in asked])
                and [4 * len(ids) for ids in theirs] == [len(found[k]) for k in asked]):
            return
        for k, ids in zip(asked, theirs):
            if ids != _ids(found[k]):
                raise ValueError(f"the library encodes {texts[k][:200]!r} as {ids[:50]}, "
                                 f"the agenda as {_ids(found[k])[:50]}")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        words = self.words
        if not words.cuttable:
            found = [np.asarray(words.ids(self.normalise(t or "")), "<u4").tobytes() for t in texts]
            if self.check:
                self._compare([t or "" for t in texts], found)
            return found
        if len(self.memory) > CACHE_ENTRIES:   # frequent parts come early: keep the first half
            self.memory = dict(islice(self.memory.items(), CACHE_ENTRIES // 2))
        cut = [self.parts(t) if t else [] for t in texts]
        new: set[str] = set()
        for parts in cut:
            new.update(parts)
        self._learn(list(new.difference(self.memory)))
        at = self.memory.__getitem__
        out = [b"".join(map(at, parts)) for parts in cut]
        for p in new:
            if len(p) > CACHE_CHARS:
                del self.memory[p]
        return out

    def decode(self, packed: list[bytes | None]) -> list[str]:
        """The texts of packed ids. Bytes of pieces are laid side by side; ids that mean more than
        their bytes, and bytes that are no UTF-8, are decoded one by one."""
        words, out = self.words, []
        for ids, raw in zip(packed, self.raw.join(packed)):
            first = _ids(ids[:4])[:1] if ids else []
            if first and words.prefix and words.pieces[first[0]].startswith(SPACE):
                raw = raw[1:]
            try:
                text = raw.decode()
            except UnicodeDecodeError:
                text = None
            if text is None or words.squeeze or words.odd_in(ids):
                text = words.decode(_ids(ids))
            out.append(text)
        return out

    def decimals(self, packed: list[bytes | None]) -> list[str]:
        """Ids in decimal, joined by commas."""
        return [raw[:-1].decode() for raw in self.decimal.join(packed)]


class Strings:
    """Byte strings side by side in one array, for joining many of them at once."""

    def __init__(self, strings: list[bytes]):
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        self.length = np.array([len(x) for x in strings], np.int64)
        self.start = self.length.cumsum() - self.length

    def join(self, packed: list[bytes | None]) -> list[bytes]:
        """The joined strings of each list of packed ids."""
        ids = np.frombuffer(b"".join(x or b"" for x in packed), "<u4")
        n = self.length[ids]
        ends = n.cumsum()
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[ids] - ends + n, n)
        joined = self.flat[at].tobytes()
        last = np.cumsum(np.array([len(x or b"") // 4 for x in packed], np.int64))
        cut = [0, *np.concatenate([[0], ends])[last].tolist()]
        return [joined[a:b] for a, b in zip(cut, cut[1:])]


def _ids(packed: bytes | None) -> list[int]:
    return np.frombuffer(packed or b"", dtype="<u4").tolist()


def encode(text: Column, path: str, check: bool = True) -> Column:
    """Packed ids of a text column."""
    @F.pandas_udf("binary")
    def piece_encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec.of(path, check)
        for s in batches:
            yield pd.Series([x for part in slices(s.tolist()) for x in codec.encode(part)],
                            dtype=object)
    return piece_encode(text)


def decode(ids: Column, path: str) -> Column:
    """Text of packed ids."""
    @F.pandas_udf("string")
    def piece_decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec.of(path)
        for s in batches:
            yield pd.Series(codec.decode(s.tolist()), dtype=object)
    return piece_decode(ids)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
               check: bool = True) -> DataFrame:
    """(doc_id, n_tokens, decimals, decoded): every text encoded, its ids in decimal joined by
    commas, and the text that the ids decode to; one pass in one Python worker a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path, check)
        for rows in batches:
            at = 0
            for part in slices(rows.column(1).to_pylist()):
                ids = codec.encode(part)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).slice(at, len(part)),
                     pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(codec.decimals(ids), pa.string()),
                     pa.array(codec.decode(ids), pa.string())],
                    names=["doc_id", "n_tokens", "decimals", "decoded"])
                at += len(part)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")) \
        .mapInArrow(run, "doc_id long, n_tokens long, decimals string, decoded string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, decode the ids again: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return round_trip(docs, path, id_col, text_col).select(
        "doc_id", "n_tokens", F.sha2("decimals", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
