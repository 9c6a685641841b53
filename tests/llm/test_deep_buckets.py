import numpy as np
import pyarrow as pa

from vellum.llm import nearjoin


def test_pairs_meet_in_buckets_that_are_split_to_the_last_depth(spark, monkeypatch):
    # isolated pairs whose signatures agree in 0.8 of the places on average; no bucket counts as small
    monkeypatch.setattr(nearjoin, "BUCKET_ROWS", 1)
    rng = np.random.default_rng(11)
    n, places = 4000, nearjoin.PLACES
    a = rng.integers(0, 65536, (n, places)).astype(np.uint16)
    b = np.where(rng.random((n, places)) < 0.8, a, rng.integers(0, 65536, (n, places)).astype(np.uint16))
    rows = [(2 * i + k, 1000, bytearray(s[i].tobytes())) for k, s in enumerate((a, b)) for i in range(n)]
    sets = spark.createDataFrame(rows, "v long, size int, sig binary")
    edges = nearjoin._candidate_edges(sets, 0.8, nearjoin.TARGET_RECALL).collect()
    met = {e["a"] // 2 for e in edges if e["a"] // 2 == e["b"] // 2}
    assert n - len(met) <= 4  # 0.4 expected


def test_runs_are_reckoned_for_the_depth():
    for depth in (2, 4, 6):
        runs = nearjoin.runs_for(0.9999, depth=depth)
        assert nearjoin.missed(runs, depth=depth) <= 1e-4 < nearjoin.missed(runs - 1, depth=depth)


def test_blocks_of_a_bucket_tell_their_links_once():
    # 40 like sets in 4 blocks, and one unlike the rest: a forest and a link for each two blocks, not one for each row met
    rng = np.random.default_rng(5)
    like, other = (rng.integers(0, 65536, nearjoin.PLACES).astype(np.uint16).tobytes() for _ in range(2))
    sets = [(v, v % 4, other if v == 17 else like) for v in range(40)]
    rows = [
        (1, b1, b2, v, 1000, sig, own)
        for b1 in range(4)
        for b2 in range(b1, 4)
        for v, own, sig in sets
        if own in (b1, b2)
    ]
    batch = pa.table(dict(zip(("path", "b1", "b2", "v", "size", "sig", "own"), map(list, zip(*rows))))).to_batches()
    edges = [e for b in nearjoin._alike(0.8)(iter(batch)) for e in zip(b["a"].to_pylist(), b["b"].to_pylist())]
    root = nearjoin._components(40, *(np.array(side) for side in zip(*edges)))
    assert set(root[[v for v in range(40) if v != 17]]) == {0} and root[17] == 17
    assert len(edges) <= 36 + 6
