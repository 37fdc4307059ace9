"""Embedding near-dedup on planted links, with shards so small that every path of it runs."""

import numpy as np
import pytest

from finmart.llm import graph_dedup as G
from finmart.llm import jaccard

VEC = "vec_id long, embedding array<float>, label int"


def _brute(rows, threshold=0.98):
    """{vec_id: (n_links, component_id)} for unique ids."""
    ok = [(i, np.asarray(v, float), y) for i, v, y in rows
          if i is not None and v is not None and y is not None and None not in v and np.isfinite(v).all() and any(v)]
    unit = [(i, v / np.abs(v).max(), y) for i, v, y in ok]
    unit = [(i, v / np.linalg.norm(v), y) for i, v, y in unit]
    root, links = {i: i for i, _, _ in rows}, {i: 0 for i, _, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for k, (i, v, y) in enumerate(unit):
        for j, w, z in unit[:k]:
            if y == z and len(v) == len(w) and v @ w >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {i: (links[i], top(i)) for i, _, _ in rows}


def _got(df, **args):
    out = G.near_duplicates(df, **args).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out if r.vec_id is not None)
    return {r.vec_id: (r.n_links, r.component_id) for r in out}, len(out)


def _planted(rng, n, dims, scale):
    """Half the rows are near copies of others, at cosines on both sides of the threshold."""
    x = rng.normal(size=(n, dims))
    for k in range(n // 2, n):
        base = x[rng.integers(0, n // 2)]
        x[k] = base + rng.normal(scale=scale * rng.uniform(0.3, 1.5), size=dims) * np.linalg.norm(base) / dims ** 0.5
    return x.astype(np.float32)


def test_planted_links_across_shards_and_labels(sp):
    rng = np.random.default_rng(3)
    x = _planted(rng, 700, 16, 0.15)
    x[650:] = x[:50]                                   # equal vectors
    rows = [(int(i), [float(v) for v in x[k]], int(k % 5 == 0)) for k, i in enumerate(rng.permutation(700))]
    got, n = _got(sp.createDataFrame(rows, VEC).repartition(3), shard=80)
    assert n == 700 and got == _brute(rows) and max(v[0] for v in got.values()) > 1


def test_a_clump_is_searched_by_pairs_of_blocks(sp):
    rng = np.random.default_rng(4)
    x = rng.normal(size=12) + rng.normal(scale=0.12, size=(260, 12))   # no centroids split it
    rows = [(k, [float(v) for v in x[k].astype(np.float32)], 1) for k in range(260)]
    df = sp.createDataFrame(rows, VEC)
    got, _ = _got(df, shard=60)
    assert got == _brute(rows)
    valid = G._valid(df, "vec_id", "embedding", "label").selectExpr("vec_id as rep", "label", "vec", "1L as size")
    paths = {r.path for r in G.split_shards(valid, 1, 60).select("path").collect()}
    assert any("!" in p for p in paths) and len(paths) > 6


def test_vectors_that_link_with_nothing_and_wide_ranges(sp, caplog):
    nan = float("nan")
    rows = [(1, [1e300, 1e300], 1), (2, [1.0, 1.0], 1), (3, [1e-60, 1.01e-60], 1), (4, [1.0, -1.0], 1), (5, None, 1),
            (6, [1.0, None], 1), (7, [nan, 1.0], 1), (8, [0.0, 0.0], 1), (9, [1.0, 1.0], None), (10, [1.0, 1.0, 0.0], 1),
            (11, [1.0, 1.0], 2), (12, [], 1)]
    df = sp.createDataFrame(rows, "vec_id long, embedding array<double>, label int") \
        .selectExpr("*", "1 as rep", "2 as size", "'p' as path", "true as home", "3 as id", "4 as n_links")
    with caplog.at_level("INFO", logger=G.__name__):
        got, n = _got(df)
    assert n == 12 and got == _brute([(i, v, y) for i, v, y in rows])
    assert [got[i][1] for i in (1, 2, 3)] == [1, 1, 1] and "recall 1.0" in caplog.text
    assert G.near_duplicates(df.limit(0)).count() == 0


def test_too_low_a_recall_is_an_error(sp, monkeypatch):
    monkeypatch.setattr(G, "audit_recall", lambda *a: 0.5)
    with pytest.raises(RuntimeError, match="0.500"):
        G.near_duplicates(sp.createDataFrame([(1, [1.0, 1.0], 1), (2, [1.0, 1.0], 1)], VEC))


# --- the n-gram join's early exit ---------------------------------------------------------

def _lone(own, others, percent):
    """N-grams of a set's pool that no other pool shows; sets are sorted by the global order."""
    shown = {g for s in others for g in s[:jaccard.pool_length(len(s), percent)]}
    return sum(g not in shown for g in own[:jaccard.pool_length(len(own), percent)])


@pytest.mark.parametrize("percent", [50, 66, 75, 80, 88, 90, 94, 96, 97, 98, 99])
def test_no_linked_set_is_done_early(percent):
    """All positions of the n-grams that two linked sets do not share, at random and at the ends."""
    rng = np.random.default_rng(percent)
    for n in range(1, 101):
        for m in range(-(-percent * n // 100), n + 1):
            overlap = -(-percent * (n + m) // (100 + percent))
            if overlap > m:
                continue
            for trial in range(3):
                total = n + m - overlap
                order = np.arange(total) if trial == 0 else rng.permutation(total)
                a, b = sorted(order[:n].tolist()), sorted(order[n - overlap:].tolist())
                assert _lone(a, [b], percent) < jaccard.lone_bar(n, percent), (n, m)
                assert _lone(b, [a], percent) < jaccard.lone_bar(m, percent), (n, m)


def test_links_at_high_thresholds_are_kept(sp):
    import itertools
    words = [f"w{k}" for k in range(400)]
    rows, it = [], itertools.count()
    for n in (9, 17, 25, 34, 50):
        start = 60 * len(rows) // 2
        text = words[start:start + n]
        rows += [(next(it), " ".join(text)), (next(it), " ".join(text[:-1]))]
    docs = sp.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.component_id for r in jaccard.near_components(docs, n=1, percent=88).collect()}
    assert out == {k: k - k % 2 for k in range(10)}
