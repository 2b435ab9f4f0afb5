"""The audit of a shard's searches: only links to others count."""

import numpy as np

import ringwatch.llm.embedding_dups as dups
from ringwatch.llm.hnsw import Hnsw


class Finds:
    """A search that finds the true neighbours of the rows in ``able``, of others the nearest row alone."""

    def __init__(self, units, able):
        self.vectors, self.able = units.astype(np.float32), able

    def within(self, query, radius, beam):
        similar = self.vectors @ query
        at = int(similar.argmax())
        if at in self.able:
            return np.flatnonzero(similar >= radius).tolist()
        return [at] if similar[at] >= radius else []


def units(seed, alone, pairs, dense=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(alone + pairs, 64))
    twins = base[:pairs] + 0.01 * rng.normal(size=(pairs, 64))
    group = rng.normal(size=64) + 0.01 * rng.normal(size=(dense, 64))
    return dups._unit(np.concatenate([base, twins, group]))


def test_a_vector_is_no_partner_of_itself():
    # A search that finds the nearest vector alone meets every probe, but no partner.
    for pairs in (5, 100):
        vectors = units(1, 20_000 // 40 * pairs // 5, pairs)
        assert dups.audited_beam(Finds(vectors, set()), vectors, 0.98) == (0, 1.0)


def test_sparse_vectors_are_audited_by_probes():
    rng = np.random.default_rng(5)
    vectors = dups._unit(rng.normal(size=(3000, 32)))
    probes = dups._probes(vectors, 0.98)
    nearest = (probes @ vectors.T).max(axis=1)
    assert len(probes) == dups.PROBES and ((nearest >= 0.98) & (nearest < 1)).all()
    graph = Hnsw(vectors, range(len(vectors)))
    beam, recall = dups.audited_beam(graph, vectors, 0.98)
    assert 0 < beam < len(vectors) and recall >= dups.AUDIT_RECALL
    # The beam holds for probes that the audit has not seen, too.
    more = dups._unit(vectors + 0.02 * rng.normal(size=vectors.shape))
    truth = [set(np.flatnonzero(vectors @ q >= 0.98).tolist()) for q in more[:400]]
    met = [len(t & set(graph.within(q.astype(np.float32), 0.98 - dups.SLACK, beam))) for t, q in zip(truth, more)]
    assert sum(met) >= 0.95 * sum(map(len, truth)) > 300


def test_a_dense_group_does_not_outweigh_pairs():
    vectors = units(2, 100, 50, dense=400)
    dense = set(range(200, 600))
    assert dups.audited_beam(Finds(vectors, dense), vectors, 0.98) == (0, 1.0)
    assert dups.audited_beam(Finds(vectors, set(range(600))), vectors, 0.98) == (dups.FIRST_BEAM, 1.0)


def test_vectors_of_other_shards_are_audited():
    vectors = units(3, 0, 100)
    graph = Finds(vectors, set(range(200)))
    others = dups._unit(vectors[:60] + 0.003 * np.random.default_rng(4).normal(size=(60, 64)))
    assert dups.audited_beam(graph, vectors, 0.98, others) == (dups.FIRST_BEAM, 1.0)
    met = graph.within
    blind = [q.astype(np.float32) for q in others]
    graph.within = lambda q, radius, beam: [] if any(np.array_equal(q, b) for b in blind) else met(q, radius, beam)
    assert dups.audited_beam(graph, vectors, 0.98) == (dups.FIRST_BEAM, 1.0)
    assert dups.audited_beam(graph, vectors, 0.98, others) == (0, 1.0)
