import random

import numpy as np
import pytest

from topicloom.operators import cluster
from topicloom.operators.similarity import best_partner, cosine_self_join
from topicloom.session import cut_lineage


def cloud(seed: int, n: int = 180, d: int = 6) -> list[tuple[str, list[float]]]:
    """Clustered vectors, a third of them copies of one, with ids of mixed length."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, d))
    rows = [centres[i % 5] + 0.25 * rng.normal(size=d) for i in range(n)]
    for i in range(0, n, 3):
        rows[i] = rows[0]
    rows[1] = np.zeros(d)
    ids = [str(i) for i in rng.permutation(n)]
    return list(zip(ids, [r.tolist() for r in rows], strict=True))


def brute(rows, thres, pick=None, dot=False):
    rows = sorted(rows)
    v = np.array([r[1] for r in rows])
    norm = np.linalg.norm(v, axis=1)
    scale = np.outer(norm, norm)
    sims = v @ v.T if dot else np.divide(v @ v.T, scale, out=np.zeros_like(scale), where=scale > 0)
    sims = np.round(sims, 12)
    out = {}
    for i in range(len(rows)):
        hits = [j for j in range(i + 1, len(rows)) if sims[i, j] > thres]
        if pick is None:
            out.update({(rows[i][0], rows[j][0]): sims[i, j] for j in hits})
        elif hits:
            j = hits[0] if pick == "first" else max(hits, key=lambda j: (sims[i, j], -j))
            out[rows[i][0]] = rows[j][0]
    return out


@pytest.mark.parametrize("thres", [0.5, 0.95])
def test_self_join(spark, thres):
    rows = cloud(1)
    got = cosine_self_join(spark.createDataFrame(rows, "id string, vec array<double>"), thres, block_rows=20).collect()
    assert {(r.id, r.partner) for r in got} == set(brute(rows, thres))
    assert len(got) == len({(r.id, r.partner) for r in got})


@pytest.mark.parametrize("thres", [0.4, 0.97])
@pytest.mark.parametrize("pick", ["max", "first"])
def test_best_partner(spark, thres, pick):
    rows = cloud(2)
    docs = spark.createDataFrame(rows, "id string, vec array<double>")
    got = best_partner(docs, thres, pick, block_rows=20).collect()
    assert {r.id: r.partner for r in got} == brute(rows, thres, pick)


def test_best_partner_dot(spark):
    rows = cloud(3)
    docs = spark.createDataFrame(rows, "id string, vec array<double>")
    got = best_partner(docs, 0.8, "first", "dot", block_rows=20).collect()
    assert {r.id: r.partner for r in got} == brute(rows, 0.8, "first", dot=True)


def test_threshold_is_strict(spark):
    docs = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.6, 0.8]), ("c", [0.0, 0.0])], "id string, vec array<double>")
    assert best_partner(docs, 0.6).count() == 0
    assert [(r.id, r.partner) for r in best_partner(docs, 0.59).collect()] == [("a", "b")]
    with pytest.raises(ValueError):
        best_partner(docs, -0.1)


def scan(pairs):
    used, out = set(), set()
    for a, b in sorted(pairs):
        if a not in used and b not in used:
            out.add((a, b))
            used |= {a, b}
    return out


def check_matching(spark, pairs):
    got = cluster.greedy_matching(spark.createDataFrame(pairs, "id string, partner string")).collect()
    assert {(r.id, r.partner) for r in got} == scan(pairs)


def test_matching_small(spark):
    check_matching(spark, [("a", "b"), ("b", "c"), ("c", "d")])
    check_matching(spark, [("a", "c"), ("b", "c")])


def test_matching_chain_and_forest(spark):
    chain = [(f"{i:04d}", f"{i + 1:04d}") for i in range(120)]
    random.seed(5)
    forest = [(f"f{i:04d}", f"f{min(i + 1 + int(random.expovariate(0.15)), 150):04d}") for i in range(150)]
    star = [(f"s{i:03d}", "s999") for i in range(50)] + [("s999", "t")]
    check_matching(spark, chain + forest + star)


def simulate(rows, thres, rounds):
    """Merging rounds on joined id texts, by the letter."""
    docs = {i: np.array(v) for i, v in rows}
    for _ in range(rounds):
        best = brute([(i, v.tolist()) for i, v in docs.items()], thres, "max")
        kept = scan(best.items())
        if not kept:
            break
        for a, b in kept:
            docs[f"{a}|{b}"] = docs.pop(a) + docs.pop(b)
    return docs


@pytest.mark.parametrize("rounds", [1, 3])
def test_clusters(spark, rounds):
    rows = cloud(4, n=45)
    found = cluster.subject_clusters(spark.createDataFrame(rows, "id string, vec array<double>"), 0.9, rounds)
    want = simulate(rows, 0.9, rounds)
    text = cluster.cluster_ids_text(found.members(), "cid").collect()
    assert sorted(r.ids for r in text) == sorted(want)
    by_cid = {r.cid: r.ids for r in text}
    for r in found.table.collect():
        assert np.allclose(r.vec, want[by_cid[r.id]])
        assert r.size == len(by_cid[r.id].split("|"))


def test_unit_clusters_have_unit_length(spark):
    rows = [(i, (np.array(v) / np.linalg.norm(v)).tolist()) for i, v in cloud(5, n=30) if any(v)]
    found = cluster.subject_clusters(spark.createDataFrame(rows, "id string, vec array<double>"), 0.8, 2, "unit")
    assert all(abs(r.norm - 1) < 1e-4 for r in found.table.collect())
    assert found.members().count() == len(rows)


def test_waiting_nodes_do_not_share_a_key(spark):
    """Before any link is known, no row of a matching round joins on a null key."""
    schema = "id string, parent string, ref string, odd boolean, taken boolean"
    state = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}", None, False, None) for i in range(50)], schema)
    plan = cluster._decide(state, None)._jdf.queryExecution().optimizedPlan().toString()
    assert "coalesce(ref" in plan
    pairs = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(200)], "id string, partner string")
    assert {tuple(r) for r in cluster.greedy_matching(pairs).collect()} == {(f"{i:03d}", f"{i + 1:03d}") for i in range(0, 200, 2)}


def test_two_level_routing_is_exact_beyond_a_thousand_cells():
    from topicloom.operators.similarity import _Cells

    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 8))
    points = centres[rng.integers(0, 40, 6000)] + 0.4 * rng.normal(size=(6000, 8))
    units = points / np.linalg.norm(points, axis=1, keepdims=True)
    pivots = units[rng.permutation(6000)[:1500]]
    pivots = np.unique(pivots, axis=0)
    thres = 0.9
    cells = _Cells(pivots, thres)
    assert len(pivots) > 1024 and len(cells.upper) < 60
    cell, near, group, unear = cells.home(units)
    radius = np.full(len(pivots), -np.inf)
    group_radius = np.full(len(cells.upper), -np.inf)
    for c, s in zip(cell, near):
        radius[c] = max(radius[c], np.arccos(np.clip(s, -1, 1)))
    for g, s in zip(group, unear):
        group_radius[g] = max(group_radius[g], np.arccos(np.clip(s, -1, 1)))
    sample = rng.permutation(6000)[:400]
    visits = cells.visits(units[sample], radius, group_radius)
    sims = units[sample] @ units.T
    for i, row in enumerate(sample):
        needed = set(cell[np.flatnonzero(sims[i] > thres)].tolist())
        assert needed <= set(visits[i].tolist())
    assert np.mean([len(v) for v in visits]) < len(pivots) / 4  # routing prunes


def test_range_blocks_deal_half_the_pairs(spark):
    from topicloom.operators.similarity import _range_blocks

    rows = [(f"{i:04d}", [1.0, 0.0], 0) for i in range(400)]
    homes = spark.createDataFrame(rows, "id string, u array<double>, cell int")
    lefts, rights = _range_blocks(homes, homes, 20)
    pairs = {(r.lb, r.rb) for r in lefts.select("lb", "rb").distinct().collect()}
    assert pairs == {(a, b) for a in range(20) for b in range(a, 20)}  # 210 of 400 block pairs
    assert pairs == {(r.rlb, r.rrb) for r in rights.select("rlb", "rrb").distinct().collect()}


@pytest.mark.parametrize("thres", [0.5, 0.9])
def test_approximate_join_finds_true_pairs_with_high_recall(spark, thres):
    from topicloom.operators.similarity import approx_self_join, lsh_recall

    rows = cloud(4, n=300)
    docs = spark.createDataFrame(rows, "id string, vec array<double>")
    exact = brute(rows, thres)
    got = {(r.id, r.partner) for r in approx_self_join(docs, thres).collect()}
    assert got <= set(exact)
    assert len(got) >= 0.9 * len(exact)
    report = lsh_recall(docs, thres).first()
    assert report.exact_pairs == len(exact) and report.recall >= 0.9


def test_a_vector_travels_once_per_block_however_small_the_cells(spark, monkeypatch):
    """Cells of 2 rows: the group of each pair of blocks finds all pairs, and no vector is dealt to every cell."""
    from topicloom.operators import similarity

    dealt = []
    inner = similarity._range_blocks

    def watched(*args):
        lefts, rights = inner(*args)
        dealt.append((lefts.groupBy("id").count().agg({"count": "max"}).first()[0], lefts.count()))
        return lefts, rights

    monkeypatch.setattr(similarity, "_range_blocks", watched)
    rows = cloud(6, n=170)
    got = cosine_self_join(spark.createDataFrame(rows, "id string, vec array<double>"), 0.5, block_rows=2).collect()
    assert {(r.id, r.partner) for r in got} == set(brute(rows, 0.5)) and len(got) == len(set(brute(rows, 0.5)))
    assert dealt[0][0] <= similarity.BLOCKS and dealt[0][1] <= len(rows) * (similarity.BLOCKS + 3) / 2


def test_approximate_join_deals_rows_to_blocks_only(spark):
    """Pairs come from the groups as they are: one row per pair, also for repeated rows, nothing made distinct afterwards."""
    from topicloom.operators.similarity import approx_self_join, lsh_recall

    rows = cloud(7, n=60) + cloud(7, n=60)[:9]
    docs = spark.createDataFrame(rows, "id string, vec array<double>")
    found = approx_self_join(docs, 0.5)
    got = [(r.id, r.partner) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) <= set(brute(cloud(7, n=60), 0.5))
    assert "FlatMapCoGroupsInPandas" in found._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
    times = {i: [r[0] for r in rows].count(i) for i, _ in rows}
    assert lsh_recall(docs, 0.5).first().exact_pairs == sum(times[a] * times[b] for a, b in brute(cloud(7, n=60), 0.5))


def test_matching_rounds_have_plans_of_one_size(spark, monkeypatch):
    """A round reads all earlier rounds as one table, so plans do not grow with the number of rounds."""
    leaves, decide = [], cluster._decide

    def noted(state, settled):
        if settled is not None:
            leaves.append(settled._jdf.queryExecution().analyzed().collectLeaves().size())
        return decide(state, settled)

    monkeypatch.setattr(cluster, "_decide", noted)
    chain = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(40)], "id string, partner string")
    kept = {(r.id, r.partner) for r in cluster.greedy_matching(chain).collect()}
    assert kept == {(f"{i:03d}", f"{i + 1:03d}") for i in range(0, 40, 2)}
    assert len(leaves) > 4 and set(leaves) == {1}


def test_matching_of_no_or_repeated_pairs(spark):
    none = spark.createDataFrame([], "id string, partner string")
    for pairs in (none, cut_lineage(none), none.where("false")):
        assert cluster.greedy_matching(pairs).collect() == []
    twice = spark.createDataFrame([("1", "2"), ("1", "2"), ("2", "3"), ("2", "3"), ("4", "5")], "id string, partner string")
    assert sorted(map(tuple, cluster.greedy_matching(twice).collect())) == [("1", "2"), ("4", "5")]


def test_copies_of_a_vector_do_not_grow_with_the_vectors():
    from topicloom.operators import similarity

    blocks = [-(-n // similarity._block_size(n, similarity.BLOCK_ROWS)) for n in (10_256, 51_282, 102_564, 393_216)]
    assert len(set(blocks)) == 1
    assert -(-615_384 // similarity._block_size(615_384, similarity.BLOCK_ROWS)) <= 2 * blocks[0]


@pytest.mark.parametrize("block_rows", [2, 20, 2048])
def test_matches_leave_in_pieces_however_many_they_are(spark, monkeypatch, block_rows):
    """Dense vectors: almost every pair matches, no group is returned as a whole, and all pairs are there with their similarity."""
    from topicloom.operators import similarity

    monkeypatch.setattr(similarity, "PIECE_ROWS", 7)
    rng = np.random.default_rng(4)
    rows = [(f"{i:03d}", (np.ones(6) + 0.3 * rng.normal(size=6)).tolist()) for i in range(90)] + [("zero", [0.0] * 6)]
    found = cosine_self_join(spark.createDataFrame(rows, "id string, vec array<double>"), 0.5, block_rows=block_rows)
    units = {i: np.array(v) / np.linalg.norm(v) for i, v in rows[:-1]}
    want = {(a, b): units[a] @ units[b] for a in units for b in units if a < b and units[a] @ units[b] > 0.5}
    got = {(r.id, r.partner): r.sim for r in found.collect()}
    assert len(want) > 3000 and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want) and found.count() == len(want)
    assert "FlatMapCoGroups" not in found._jdf.queryExecution().optimizedPlan().toString()
