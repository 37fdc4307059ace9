"""BPE, packing, sharding, exact dedup and the n-gram join against brute force."""

import hashlib
import math
import zlib

import pytest
from pyspark.sql import functions as F

from finmart.llm import bpe, exact_dedup, jaccard, packing, queries, sharding

SF = "/root/testdata/sf0.01"


def _reference():
    import base64

    import public_tokenizers as P
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in
             map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _file():
    return queries.tokenizer_file("byte_bpe_50k.tiktoken")


# --- byte-level BPE -----------------------------------------------------------------------

def test_bpe_every_document_equals_the_reference_library(sp, docs_pdf):
    ref = _reference()
    got = {r.doc_id: r for r in queries.op3_bpe(sp, SF).collect()}
    assert len(got) == len(docs_pdf)
    for doc, text in zip(docs_pdf.doc_id, docs_pdf.text):
        ids = ref.encode_ordinary(text)
        r = got[doc]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("text", ["", " ", "  ", "a  b", "a \n b", "\n\n x", "it's we'll 'S ''s", "x\ty z",
                                  "été naïve z   q", "漢字 🙂🙂 12 34a a_b", "<|endoftext|> a", "a" * 5000,
                                  " lead", "trail ", "\r\n a\x85b\x1cc", "ſ ǅ ʰ ² ½ Ⅷ"])
def test_bpe_special_texts(text):
    codec = bpe.Codec.of(_file(), queries.pattern())
    packed, = codec.encode([text])
    assert codec.decimals(packed) == " ".join(map(str, _reference().encode_ordinary(text)))
    assert codec.decode(packed) == text.encode()


def test_bpe_edges(edge, no_docs):
    out = bpe.digests(edge, _file(), queries.pattern()).collect()
    assert len(out) == 11
    nothing = hashlib.sha256(b"").hexdigest()
    by = {r.doc_id: r for r in out}
    assert by[3].n_tokens == 0 and by[3].ids_sha256 == by[4].decoded_sha256 == nothing
    assert bpe.digests(no_docs, _file(), queries.pattern()).count() == 0
    arr = edge.filter("doc_id = 1").select(
        bpe.ids_to_array(bpe.encode(F.col("text"), _file(), queries.pattern())).alias("a")).first().a
    assert arr == _reference().encode_ordinary("a b c d e f g. The end!")


# --- packing ------------------------------------------------------------------------------

def _check_packing(rows, texts, size):
    from tokenizers import Tokenizer
    import numpy as np
    model = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    total = 0
    for doc, ps in by_doc.items():
        ids = model.encode(texts[doc] or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        ps.sort(key=lambda r: r.piece)
        assert [r.piece for r in ps] == list(range(len(ps)))
        assert sum(r.length for r in ps) == len(ids)
        assert len(ps) == -(-len(ids) // size) and all(r.length == size for r in ps[1:])
        at = 0
        for r in ps:
            assert r.start == at
            part = np.asarray(ids[at:at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
    for ps in by_seq.values():
        at = 0
        for r in sorted(ps, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(by_seq), total


def test_packing_whole_table(sp, docs_pdf):
    rows = queries.op9_best_fit(sp, SF).collect()
    made, total = _check_packing(rows, dict(zip(docs_pdf.doc_id, docs_pdf.text)), 2048)
    assert made <= math.ceil(1.005 * total / 2048) + 1


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "<|endof"])
def test_packing_uses_the_librarys_ids_for_added_tokens(text):
    import numpy as np
    from tokenizers import Tokenizer
    path = queries.tokenizer_file("byte_bpe_50k.json")
    packed, = packing._Tokenizer(path, queries.pattern(), 10).encode([text])
    assert np.frombuffer(packed, "<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_chunk_cache_never_goes_through_its_entries():
    """What is known is looked up; an entry costs nothing when a later text brings new words."""
    class Cache(bpe.ChunkCache):
        def __iter__(self):
            raise AssertionError("went through all entries")

    cache = Cache(queries.pattern(), lambda ps: [f"<{p}>".encode() for p in ps])
    assert cache.encode(["one two, three"]) == [b"<one>< two><,>< three>"]
    assert cache.encode(["a two. four, x9", "two"]) == [b"<a>< two><.>< four><,>< x><9>", b"<two>"]


def test_packing_encodes_words_together_as_alone(monkeypatch):
    import numpy as np
    from tokenizers import Tokenizer
    path = queries.tokenizer_file("byte_bpe_50k.json")
    words = [" the", "The", " \u00e9t\u00e9", "\u6f22\u5b57", " x", "1", " 12", "!!", "\n", " don", "'t", "\u01c5"] * 3
    model = Tokenizer.from_file(path)
    alone = [model.encode(w, add_special_tokens=False).ids for w in words]
    for size in (1, 4, 64):
        monkeypatch.setattr(packing, "WORDS_A_CALL", size)
        got = packing._Tokenizer(path, queries.pattern(), 10)._new(words)
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == alone


def test_packing_many_tasks_share_their_ends(sp):
    items = sp.range(5000).selectExpr("id", "1 + pmod(xxhash64(id), 100) as length")
    out = packing.pack(items, size=100, open_bins=16, task_pieces=300).collect()
    seqs = {}
    for r in out:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for ps in seqs.values():
        ps.sort()
        assert all(o == sum(n for _, n in ps[:k]) for k, (o, _) in enumerate(ps))
        assert sum(n for _, n in ps) <= 100
    assert len(out) == 5000


def test_best_fit_closes_the_fullest():
    fit = packing.BestFit(10, 2)
    assert fit.place(6) == (0, 0) and fit.place(7) == (1, 0)
    assert fit.place(3) == (1, 7)          # the least room that holds it: bin 1 is full now
    assert fit.place(8) == (2, 0)
    assert fit.place(5) == (3, 0)          # bins 0 and 2 open: 2 is the fullest and closes
    assert fit.place(2) == (0, 6) and fit.still_open() == {0, 3}
    assert packing.cut(5, 4) == [(0, 1), (1, 4)] and packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(4, 4) == [(0, 4)] and packing.cut(1, 4) == [(0, 1)]


def test_packing_edges(edge, no_docs):
    path, pat = queries.tokenizer_file("byte_bpe_50k.json"), queries.pattern()
    rows = packing.pack_documents(edge, path, pat, size=64).collect()
    assert sum(r.doc_id == 9 for r in rows) >= 2
    only = [r for r in rows if r.doc_id == 3]
    assert len(only) == 1 and only[0].length == 1 and only[0].ids_crc32 == zlib.crc32(b"\0\0\0\0")
    assert packing.pack_documents(no_docs, path, pat).count() == 0


def test_sequences_hold_the_ids(sp, docs_pdf):
    docs = sp.createDataFrame(docs_pdf[["doc_id", "text"]].head(40))
    path, pat = queries.tokenizer_file("byte_bpe_50k.json"), queries.pattern()
    parts = packing.pieces(docs, path, pat, 256)
    packed = packing.pack(parts.drop("ids"), 256)
    seqs = packing.sequences(parts, packed.drop("start")).collect()
    assert all(len(r.ids) == 4 * r.n_tokens and r.n_tokens <= 256 for r in seqs)
    assert sum(r.n_tokens for r in seqs) == parts.agg(F.sum("length")).first()[0]


# --- sharding -----------------------------------------------------------------------------

def _rendezvous(doc, n):
    def u(s):
        return (int(hashlib.md5(f"{doc}|{s}".encode()).hexdigest()[:13], 16) + 1) / (2 ** 52 + 1)
    return max(range(n), key=lambda s: -1.0 / math.log(u(s)))


def test_sharding_whole_table(sp, docs_pdf):
    rows = queries.op7_rendezvous(sp, SF).collect()
    text = dict(zip(docs_pdf.doc_id, docs_pdf.text))
    assert len(rows) == len(text)
    slots = {}
    for r in rows:
        raw = text[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert r.shard == _rendezvous(r.doc_id, 24) and r.grown_shard == _rendezvous(r.doc_id, 25)
        assert r.grown_shard in (r.shard, 24)
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_weights_and_edges(sp, edge, no_docs):
    keys = sp.range(20000).withColumnRenamed("id", "doc_id")
    got = {r.shard: r["count"] for r in sharding.rendezvous(keys, [1.0, 3.0]).groupBy("shard").count().collect()}
    assert 0.72 < got[1] / 20000 < 0.78
    rows = sharding.shard_documents(edge, 3).collect()
    assert len(rows) == 11 and {r.size for r in rows if r.doc_id in (3, 4)} == {8}
    twins = [r for r in rows if r.doc_id == 9]
    assert len({r.shard for r in twins}) == 1 and len({r.slot for r in twins}) == 2
    assert sharding.shard_documents(no_docs).count() == 0
    assert "Python" not in sharding.shard_documents(edge)._jdf.queryExecution().toString()


# --- exact dedup --------------------------------------------------------------------------

def _groups(pairs):
    by = {}
    for doc, text in pairs:
        by.setdefault(text or "", []).append(doc)
    return by


def test_exact_dedup_whole_table(sp, docs_pdf):
    rows = queries.op8_exact_dedup(sp, SF).collect()
    by = _groups(zip(docs_pdf.doc_id, docs_pdf.text))
    want = {(d, max(g), len(g), d == max(g), hashlib.sha256(t.encode()).hexdigest())
            for t, g in by.items() for d in g}
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows} == want


def test_exact_dedup_many_batches_and_weak_digest(sp):
    rows = [(i, f"text {i % 37}") for i in range(400)]
    docs = sp.createDataFrame(rows, "doc_id long, text string").repartition(7)
    weak = F.substring(F.sha2(F.col("text"), 256), 1, 1)   # collides on purpose
    for digest in (None, weak):
        got = exact_dedup.dedup(docs, digest=digest, files_per_batch=2).collect()
        assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {
            (d, max(g), len(g)) for g in _groups(rows).values() for d in g}


def test_exact_dedup_edges(edge, no_docs):
    rows = exact_dedup.dedup(edge).collect()
    assert len(rows) == 11
    by = {r.doc_id: r for r in rows}
    assert by[3].keep_id == by[4].keep_id == 4 and by[3].group_size == 2 and not by[3].kept
    assert by[1].keep_id == 2 and by[8].group_size == 1      # case matters
    assert [r.kept for r in rows if r.doc_id == 9] == [True, True]
    assert exact_dedup.dedup(no_docs).count() == 0


# --- n-gram join --------------------------------------------------------------------------

def _brute(pairs, n, percent):
    sets = {}
    for doc, text in pairs:
        w = jaccard.words(text)
        sets[doc] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    up = {d: d for d in sets}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d
    ids = sorted(d for d in sets if sets[d])
    holders = {}
    for d in ids:
        for g in sets[d]:
            holders.setdefault(g, []).append(d)
    seen = set()
    for group in holders.values():
        for i, a in enumerate(group):
            for b in group[i + 1:]:
                if (a, b) in seen:
                    continue
                seen.add((a, b))
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((top(a), top(b)))
                    up[y] = x
    return {(d, len(sets[d]), top(d)) for d in sets}


def test_ngram_join_whole_table(sp, docs_pdf):
    rows = queries.op10_ngram_jaccard(sp, SF).collect()
    assert {tuple(r) for r in rows} == _brute(zip(docs_pdf.doc_id, docs_pdf.text), 3, 90)


def test_ngram_join_dense_groups(sp):
    import random
    rnd = random.Random(5)
    rows = []
    for g in range(4):
        base = [f"w{rnd.randrange(400)}" for _ in range(120)]
        for k in range(40):
            w = list(base)
            for _ in range(rnd.randrange(9)):
                w[rnd.randrange(len(w))] = f"x{rnd.randrange(99)}"
            rows.append((g * 100 + k, " ".join(w[:len(w) - rnd.randrange(12)])))
    docs = sp.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for n, percent in ((3, 90), (5, 80)):
        got = {tuple(r) for r in jaccard.near_components(docs, n, percent).collect()}
        assert got == _brute(rows, n, percent)


def test_ngram_join_last_join_lists_first_shared_ngrams(sp, monkeypatch):
    """One hub and no useful round: nearly all links come from the last join, whatever it brings along."""
    import random
    rnd = random.Random(11)
    monkeypatch.setattr(jaccard, "HUB_ROUNDS", 1)
    monkeypatch.setattr(jaccard, "HUBS", 1)
    rows = []
    for g in range(12):
        base = [f"v{rnd.randrange(60)}" for _ in range(rnd.choice((20, 50, 90)))]
        for k in range(12):
            w = list(base)
            for _ in range(rnd.randrange(6)):
                w[rnd.randrange(len(w))] = f"v{rnd.randrange(60)}"
            rows.append((g * 100 + k, " ".join(w)))
    docs = sp.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for before, n, percent in ((1, 1, 70), (16, 3, 80)):
        monkeypatch.setattr(jaccard, "BEFORE", before)
        got = {tuple(r) for r in jaccard.near_components(docs, n, percent).collect()}
        assert got == _brute(rows, n, percent)


def test_ngram_join_pools_travel_packed_and_count_what_others_show(sp, monkeypatch):
    """A row a task and bucket, not one an n-gram; copies of a class show nothing to each other."""
    import random

    import numpy as np
    rnd = random.Random(3)
    rows = [(k, " ".join(f"w{rnd.randrange(300)}" for _ in range(150))) for k in range(40)]
    rows += [(100 + k, rows[k][1].upper()) for k in range(5)] + [(200, ""), (201, None), (202, "alone")]
    texts = jaccard._text_rows(sp.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", "text")
    table = np.zeros(jaccard.COUNTERS, np.uint32)
    sets = {d: jaccard.ngrams(t, 2) for d, t in rows}
    holders = {}
    for s in filter(len, sets.values()):
        for g in jaccard.ordered(s, table, jaccard.frequent_bar(table))[:jaccard.pool_length(len(s), 80)].tolist():
            holders.setdefault(g, []).append(jaccard._key(s))
    want = {}
    for keys in holders.values():
        for k in keys if len(set(keys)) > 1 else ():
            want[k] = want.get(k, 0) + 1
    for flush, buckets in ((1 << 21, 4), (50, 7)):
        monkeypatch.setattr(jaccard, "POOL_FLUSH", flush)
        pool = jaccard.pools(texts, 2, 80, table, buckets)
        got = {r.key: r.rows for r in jaccard.shown_by_others(pool, buckets).collect()}
        assert got == want and len(want) >= 30
        assert flush < 100 or pool.count() <= 3 * buckets


def test_ngram_join_edges(edge, no_docs):
    rows = jaccard.near_components(edge).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 11
    assert by[1].component_id == by[2].component_id == by[8].component_id == 1
    assert all(by[d].n_shingles == 0 and by[d].component_id == d for d in (3, 4, 5))
    assert by[6].n_shingles == 1 and by[7].n_shingles == 1 and by[None].n_shingles == 1
    assert jaccard.near_components(no_docs).count() == 0


def test_ngram_join_ids_that_repeat_with_other_texts(sp):
    import corpus_pipeline as P
    t, u, v = (" ".join(f"{c}{k}" for k in range(60)) for c in "tuv")
    near = u.replace("u59", "end")
    rows = [(3, t), (5, t), (5, u), (8, near), (4, u), (6, v), (7, v), (7, ""), (10, "")]
    docs = sp.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_components(docs, 5, 80).collect()}
    assert got == {(3, 56, 3), (5, 56, 3), (8, 56, 3), (4, 56, 3), (6, 56, 6), (7, 56, 6), (7, 0, 6), (10, 0, 10)}
    assert {r.doc_id for r in P.drop_near_copies(sp, docs, SF).collect()} == {3, 6, 10}
