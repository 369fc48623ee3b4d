import itertools

import numpy as np

from ledgerloom.llm.chain import Chain, forward_backward, label_changes


def brute(emissions, chain):
    n, k = emissions.shape
    marginals, changes, total = np.zeros((n, k)), np.zeros((k + 1, k)), 0.0
    for path in itertools.product(range(k), repeat=n):
        weight = np.exp(
            chain.start[path[0]] + sum(emissions[i, x] for i, x in enumerate(path)) + sum(chain.step[a, b] for a, b in zip(path, path[1:]))
        )
        total += weight
        for i, x in enumerate(path):
            marginals[i, x] += weight
        changes += weight * label_changes(np.array(path), np.array([n]), k)
    return marginals / total, changes / total


def test_marginals_and_changes_equal_the_sum_over_all_paths():
    rng = np.random.default_rng(1)
    chain = Chain(rng.normal(size=3), rng.normal(size=(3, 3)))
    lengths = [4, 1, 0, 5, 2]
    emissions = rng.normal(size=(sum(lengths), 3))
    marginals, changes = forward_backward(emissions, np.array(lengths), chain, count=True)
    at, wanted = 0, np.zeros((4, 3))
    for n in lengths:
        if n:
            expected, counts = brute(emissions[at : at + n], chain)
            np.testing.assert_allclose(marginals[at : at + n], expected, atol=1e-9)
            wanted += counts
        at += n
    np.testing.assert_allclose(changes, wanted, atol=1e-9)


def test_no_rows():
    marginals, _ = forward_backward(np.zeros((0, 2)), np.zeros(0, np.int64), Chain(np.zeros(2), np.zeros((2, 2))))
    assert marginals.shape == (0, 2)
