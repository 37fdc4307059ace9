"""Merkle manifest, hard negatives and SentencePiece agenda against brute force and the library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from finmart.llm import hard_negatives as hn
from finmart.llm import merkle, pieces, queries

SF = "/root/testdata/sf0.01"


# --- Merkle manifest ----------------------------------------------------------------------

def _postorder(n):
    """(level, node) in completion order, by building level by level."""
    order, pending = [], {}
    top = merkle.height(n)

    def done(level, node):
        order.append((level, node))
        last = node + 1 == merkle.nodes_at(n, level)
        if level < top and ((node + 1) % 8 == 0 or last):
            done(level + 1, node // 8)
    for k in range(n):
        done(0, k)
    return order


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 72, 73, 511, 512, 513, 600, 4097])
def test_places_are_the_completion_order(n):
    order = _postorder(n)
    assert [merkle.place(n, *x) for x in order] == list(range(len(order)))


def _sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def _leaf(row, text):
    return _sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}"
                        for v in (row.doc_id, row.source, row.lang, row.n_chars, text)))


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_sha("".join(out[-1][k:k + 8])) for k in range(0, len(out[-1]), 8)])
    return out


def _path(levels, i):
    """(before, after) digests of each level below the top."""
    out = []
    for row in levels[:-1]:
        first = i - i % 8
        run = row[first:first + 8]
        out.append(("".join(run[:i - first]), "".join(run[i - first + 1:])))
        i //= 8
    return out


def _brute_manifest(rows):
    """Rows as (doc_id, leaf, subroot, root, proof, folded, verified), sorted."""
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append((-1 if r.doc_id is None else r.doc_id, _leaf(r, r.text), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: _levels([leaf for _, leaf, _ in sorted(groups[g], key=lambda x: x[:2])]) for g in names}
    above = _levels([trees[g][-1][0] for g in names])
    out = []
    for rank, g in enumerate(names):
        for i, (_, leaf, r) in enumerate(sorted(groups[g], key=lambda x: x[:2])):
            path = _path(trees[g], i) + _path(above, rank)
            at = leaf
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0:
                low = None if r.text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text)
                at = _leaf(r, low)
            for before, after in path:
                at = _sha(before + at + after)
            root = above[-1][0]
            out.append((r.doc_id, leaf, trees[g][-1][0], root, _sha("".join(a + b for a, b in path)), at, at == root))
    return sorted(out, key=str)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_manifest_edges(sp, edge, no_docs):
    assert _rows(merkle.prove_documents(edge)) == _brute_manifest(edge.collect())
    out = merkle.prove_documents(no_docs)
    assert out.count() == 0 and out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256",
                                                "folded_root", "verified"]
    one = edge.filter("doc_id = 8")
    (row,) = merkle.prove_documents(one).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == _sha("")


def test_manifest_many_groups_and_builders(sp):
    """One language with two builders' worth of leaves, many with one or two."""
    docs = sp.range(9000).selectExpr(
        "id as doc_id", "if(id % 7 = 0, concat('Text ', id), cast(null as string)) as text",
        "case when id < 4500 then 'en' when id < 8900 then null else concat('l', id % 90) end as lang",
        "'s' as source", "id as n_chars")
    docs = docs.unionByName(docs.filter("doc_id < 20")).repartition(5)
    assert _rows(merkle.prove_documents(docs)) == _brute_manifest(docs.collect())


def test_log_holds_every_node_at_its_place(sp):
    docs = sp.range(5000).selectExpr("id as doc_id", "'t' as text", "'en' as lang", "'s' as source", "1L as n_chars")
    made = merkle.build(docs, F.lit(False))
    log = sorted((r.place, r.level, r.node) for r in made.log.filter("tree = '1en'").collect())
    assert [x[1:] for x in log] == _postorder(5000) and [x[0] for x in log] == list(range(len(log)))
    some = merkle.proofs(made, made.members.filter("id % 1000 = 7"))
    assert {r[0] for r in some.select(merkle.fold(F.col("leaf"), F.col("path"))).collect()} == {made.root}


# --- hard negatives -----------------------------------------------------------------------

def _brute_negatives(rows, every=100, positives=5, negatives=5, low=80):
    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    rows = list(dict.fromkeys(rows))
    out = []
    for i, label, q in rows:
        if i % every:
            continue
        others = [(-score(q, p), j, m) for j, m, p in rows if j != i and len(p) == len(q)]
        near = sorted((s, j) for s, j, m in others if m == label)[:positives]
        for s, j in near:
            hard = sorted((t, k) for t, k, m in others if m != label and low * -s <= 100 * -t <= 100 * -s)
            out += [(i, j, rank + 1, k, -s, -t) for rank, (t, k) in enumerate(hard[:negatives])]
    return sorted(out)


def _quantised(rows):
    out = []
    for i, label, v in rows:
        if None in (i, label) or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        out.append((i, label, tuple(int(np.clip(np.floor(256.0 * x), -hn.MOST, hn.MOST)) for x in v)))
    return out


@pytest.mark.parametrize("dims", [3, 16])
def test_negatives_of_clustered_vectors(sp, dims):
    rng = np.random.default_rng(dims)
    centres = rng.normal(size=(12, dims))
    which = rng.integers(0, 12, 900)
    x = centres[which] + rng.normal(scale=0.05, size=(900, dims)) * rng.integers(0, 2, 900)[:, None]
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(k, int(rng.integers(0, 3)), [float(v) for v in x[k]]) for k in range(900)]
    df = sp.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(4)
    got = hn.mine(df, every=20, block_rows=32, page_blocks=5)
    assert sorted(tuple(r) for r in got.collect()) == _brute_negatives(_quantised(rows), every=20)


def test_negative_edges(sp):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (1, 1, [0.9, 0.1]), (2, 2, [0.9, 0.0]), (3, 2, [0.9, 0.0]),
            (4, None, [1.0, 0.0]), (5, 2, None), (6, 2, [1.0, None]), (7, 2, [nan, 1.0]), (8, 2, [inf, 1.0]),
            (None, 2, [1.0, 0.0]), (9, 2, [1.0, 0.0, 0.0]), (10, 3, []), (11, 2, [0.0, 0.0]),
            (12, 2, [1e300, -1e300]), (100, 1, [-1.0, 0.0]), (200, 3, []), (300, 7, [1e300, 0.0]),
            (301, 7, [1e300, 0.0]), (302, 8, [1e300, 0.0]), (2, 2, [0.8, 0.0])]
    df = sp.createDataFrame(rows, "vec_id long, label int, embedding array<double>") \
        .selectExpr("*", "1 as block", "2 as home", "'k' as key", "3 as dim", "4 as id", "5 as score")
    got = sorted(tuple(r) for r in hn.mine(df, block_rows=4).collect())
    assert got == _brute_negatives(_quantised(rows)) and got
    assert hn.mine(df.limit(0)).count() == 0


def test_hilbert_neighbours_differ_by_one():
    cells = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    walk = cells[np.argsort(np.array([int.from_bytes(k, "big") for k in hn.hilbert_keys(cells, 3)]))]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_score_bounds_hold_every_row():
    rng = np.random.default_rng(2)
    q, rows = rng.integers(-300, 300, (5, 9)), rng.integers(-300, 300, (40, 9))
    down, up = hn.score_bounds(q, rows.min(0)[None], rows.max(0)[None])
    s = hn.products(q, rows)
    assert (down <= s.min(1)[:, None]).all() and (up >= s.max(1)[:, None]).all()
    big = np.full((1, 64), 1 << 26)
    assert hn.products(big, big)[0, 0] == 64 << 52


# --- SentencePiece ------------------------------------------------------------------------

def _file():
    return queries.tokenizer_file("piece_bpe_32k.model")


def _library(path):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


def test_pieces_every_document_equals_the_library(sp, docs_pdf):
    ref = _library(_file())
    got = {r.doc_id: r for r in queries.op13_score_agenda(sp, SF).collect()}
    assert len(got) == len(docs_pdf)
    for doc, ids in zip(docs_pdf.doc_id, ref.encode(docs_pdf.text.tolist())):
        r = got[doc]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(ref.decode(ids).encode()).hexdigest()


def _same(codec, ref, texts):
    for text, packed in zip(texts, codec.encode(texts)):
        ids = ref.encode(text)
        assert pieces._ids(packed) == ids, text
        assert codec.decode([packed]) == [ref.decode(ids)], text


def test_pieces_special_texts():
    codec, ref, rng = pieces.Codec(_file()), _library(_file()), random.Random(4)
    signs = "  ab cde\n\t▁éß漢🙂0129.,<>x'\x00　\xa0İ"
    _same(codec, ref, ["".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(3000)])
    _same(codec, ref, ["", " ", "  ", "a  b", " a", "a ", "x" * 50_000, "▁▁▁a", " ab" * 40, "<s> </s> <0x41>"])
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(260), 29871]) for _ in range(rng.randrange(8))]
        assert codec.decode([np.asarray(ids, "<u4").tobytes()]) == [ref.decode(ids)], ids


@pytest.mark.parametrize("prefix, bytes_, odd", [(True, False, False), (False, False, False), (True, True, True),
                                                 (True, False, True)])
def test_pieces_small_models(tmp_path, prefix, bytes_, odd):
    """Unknown characters, no space put in front, unused and user-defined pieces, equal scores."""
    from sentencepiece import sentencepiece_model_pb2 as spm
    model, rng = spm.ModelProto(), random.Random(7)

    def add(piece, score, kind=pieces.NORMAL):
        p = model.pieces.add()
        p.piece, p.score, p.type = piece, score, kind
    add("<unk>", 0, pieces.UNKNOWN)
    add("<s>", 0, pieces.CONTROL)
    for b in range(256 if bytes_ else 0):
        add(f"<0x{b:02X}>", 0, pieces.BYTE)
    words = {"".join(rng.choices("abc▁", k=n)) for n in (2, 2, 3, 3, 4, 4, 5) for _ in range(6)}
    words = {w for w in words if pieces.SPACE not in w.lstrip(pieces.SPACE)} | {"ab", "bc", "abc"}
    for k, w in enumerate(sorted(words)):
        add(w, -float(k // 3), pieces.UNUSED if odd and k % 5 == 0 else pieces.NORMAL)
    for c in "abc▁":
        add(c, -100.0)
    if odd:
        add("<x>", 0, pieces.USER_DEFINED)
    model.trainer_spec.model_type, model.trainer_spec.byte_fallback = 2, bytes_
    model.trainer_spec.vocab_size = len(model.pieces)
    norm = model.normalizer_spec
    norm.name, norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces = "identity", prefix, False, True
    path = tmp_path / "m.model"
    path.write_bytes(model.SerializeToString())
    codec, ref = pieces.Codec(str(path)), _library(str(path))
    _same(codec, ref, ["".join(rng.choices(["a", "b", "c", " ", "é", "d", "<x>"], k=rng.randrange(20))) for _ in range(2000)])


def test_pieces_edges(edge, no_docs):
    by = {r.doc_id: r for r in pieces.digests(edge, _file()).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert len(by) == 10 and by[3].n_tokens == 0 and by[3].ids_sha256 == by[4].decoded_sha256 == nothing
    assert by[6].decoded_sha256 == hashlib.sha256(b"x" * 50_000).hexdigest()
    assert pieces.digests(edge, _file()).count() == 11 and pieces.digests(no_docs, _file()).count() == 0
    back = edge.select("text", pieces.decode(pieces.encode(F.col("text"), _file()), _file()).alias("t"))
    assert all(r.t == (r.text or "") for r in back.collect())


def test_a_difference_from_the_library_stops():
    codec = pieces.Codec(_file())
    with pytest.raises(ValueError, match="the library encodes"):
        codec._compare(["abc"], [np.asarray([5], "<u4").tobytes()])
