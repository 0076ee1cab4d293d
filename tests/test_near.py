"""Near fingerprints: few keys a value, crowded keys, links in place of pairs, the pass over their edges."""

import random

import numpy as np
import pytest

from gristlane.operators import dedup, graph, similarity
from gristlane.plans import curation, provenance
from gristlane.session import materialize

SF = "/root/testdata/sf0.001"


def _signed(v):
    return v - (1 << 64) if v >> 63 else v


def _clustered(n, seed=5):
    """Values around a few centres that share most of their bits, with repeats and both ends of the range."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(24) << 20 for _ in range(40)]
    out = [rng.choice(centres) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for _ in range(n)]
    return [*out, *out[:20], 0, (1 << 64) - 1, 1 << 63]


def _brute(values, distance):
    v = np.array(values, np.uint64)
    i, j = np.nonzero(np.triu(np.bitwise_count(v[:, None] ^ v[None, :]) <= distance, 1))
    return {(a, b, int(v[a] ^ v[b]).bit_count()) for a, b in zip(i.tolist(), j.tolist())}


@pytest.mark.parametrize("size, agree", [(0, 1), (1 << 19, 2), (1 << 24, 3)])
@pytest.mark.parametrize("crowd", [30, 4096])
def test_hamming_keys_and_crowds(size, agree, crowd, monkeypatch):
    """Every way to cut finds each near pair once, also where keys are crowded and batches end within a key."""
    monkeypatch.setattr(similarity, "_CROWD", crowd)
    monkeypatch.setattr(similarity, "_AT_ONCE", 700)
    import pyarrow as pa

    values = sorted(set(_clustered(200)))
    v = pa.array([_signed(x) for x in values], pa.int64())
    keyed = pa.Table.from_batches(list(similarity._keyed(7, agree)([pa.RecordBatch.from_arrays([v], ["v"])])))
    assert len(keyed) <= {1: 8, 2: 36, 3: 120}[agree] * len(values)
    found = [tuple(r.values()) for b in similarity._met(7, agree)(keyed.sort_by("key").to_batches(97)) for r in b.to_pylist()]
    assert len(found) == len(set(found))
    assert set(found) == {tuple(sorted((_signed(values[i]), _signed(values[j])))) for i, j, _ in _brute(values, 7)}


def test_hamming_join_of_repeats(spark):
    values = _clustered(300)
    df = spark.createDataFrame([*((i, _signed(v)) for i, v in enumerate(values)), (None, 0), (10**6, None)], "k long, v long")
    got = [tuple(r) for r in similarity.hamming_join(df, "k", "v", 7).collect()]
    assert len(got) == len(set(got)) and set(got) == _brute(values, 7)


def test_hamming_links(spark):
    """A thousand equal values take a link each, and components are those of all pairs."""
    values = _clustered(300) + [77] * 1000
    df = spark.createDataFrame([(i, _signed(v)) for i, v in enumerate(values)], "k long, v long")
    links = materialize(similarity.hamming_links(df, "k", "v", 7))
    assert links.where("left >= 323").count() + links.where("right > 323").count() < 2000
    want = graph.connected_components(spark.createDataFrame([p[:2] for p in _brute(values, 7)], "src long, dst long"))
    assert {tuple(r) for r in graph.connected_components(links, "left", "right").collect()} == {tuple(r) for r in want.collect()}


def test_components_by_parts(spark, monkeypatch):
    """Dense edges beyond one task are cut to a tree of each part; no round of stars is left."""
    monkeypatch.setattr(graph, "_star", None)
    edges = [(c * 100 + i, c * 100 + j) for c in range(5) for i in range(40) for j in range(i)] + [(5, 5), (1000, 1000)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "src long, dst long"), one_task=1000).collect()}
    assert got == {**{c * 100 + i: c * 100 for c in range(5) for i in range(40)}, 1000: 1000}


@pytest.mark.parametrize("query", [curation.near_dup_clusters, curation.component_winners, provenance.separation_report])
def test_components_list_no_pairs(spark, query, monkeypatch):
    monkeypatch.setattr(similarity, "hamming_join", None)
    assert query(spark, SF).count()


def test_graph_is_built_once(spark):
    plan = provenance.graph_rebuild(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "embedding" not in plan


@pytest.mark.parametrize("one_task", [20, 10**6])
def test_greedy_resolution_in_one_task(spark, one_task, monkeypatch):
    rng = random.Random(3)
    edges = sorted({(rng.randint(0, 3), a, b) for a, b in (sorted(rng.sample(range(60), 2)) for _ in range(70))})
    edges = list({(a, b): (d, a, b) for d, a, b in edges}.values())
    df = spark.createDataFrame([(d, a, b, rng.choice((a, b))) for d, a, b in edges], "d int, l long, r long, w long")
    gone, want = set(), set()
    for d, a, b, w in sorted(tuple(r) for r in df.collect()):
        if not {a, b} & gone:
            gone.add(a + b - w)
            want.add((a, b, a + b - w))
    if one_task == 10**6:
        monkeypatch.setattr(dedup.F, "explode", None)  # no round
    assert {(r.l, r.r, r.loser) for r in dedup.greedy_resolution(df, "l", "r", "w", "d", "l", "r", one_task=one_task).collect()} == want
