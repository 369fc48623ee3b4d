"""Linear-chain conditional random fields over many sequences at once, in numpy.

Rows of all sequences lie one after another; ``lengths`` cuts them. Sequences advance together, longest first,
so a step costs one small matrix product however many sequences there are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Chain:
    """Learned log weights: of a label at the start, and of a label after a label."""

    start: np.ndarray
    step: np.ndarray


def _by_step(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each row goes if rows are dealt by their place in the sequence, longest sequence first; and how many
    sequences have each place."""
    order = np.argsort(-lengths, kind="stable")
    rank = np.empty(len(lengths), np.int64)
    rank[order] = np.arange(len(lengths))
    active = np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), side="left")
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    before = np.concatenate(([0], np.cumsum(active)))
    return before[place] + np.repeat(rank, lengths), active


def forward_backward(
    emissions: np.ndarray, lengths: np.ndarray, chain: Chain, count: bool = False
) -> tuple[np.ndarray, np.ndarray | None]:
    """Marginals of each row and, if asked for, expected label changes (with the start as last row)."""
    n, k = emissions.shape
    to, active = _by_step(np.asarray(lengths, np.int64))
    local = np.empty((n, k), emissions.dtype)
    if n:
        local[to] = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    step = np.exp(chain.step - chain.step.max()).astype(emissions.dtype)
    start = np.exp(chain.start - chain.start.max()).astype(emissions.dtype)
    ends = np.cumsum(active)
    ahead = np.empty_like(local)
    for t, (m, end) in enumerate(zip(active, ends)):
        now = ahead[end - m : end]
        reach = start if t == 0 else before[:m] @ step
        np.multiply(local[end - m : end], reach, out=now)
        norm = now.sum(axis=1, keepdims=True)
        now /= norm
        local[end - m : end] /= norm
        before = now
    changes = np.zeros((k + 1, k)) if count else None
    behind = np.ones_like(local)
    for t in range(len(active) - 1, 0, -1):
        m, end = active[t], ends[t]
        pull = local[end - m : end] * behind[end - m : end]
        prior = end - m - active[t - 1]
        behind[prior : prior + m] = pull @ step.T
        if count:
            changes[:k] += (ahead[prior : prior + m].T @ pull) * step
    marginals = ahead * behind
    marginals /= marginals.sum(axis=1, keepdims=True)
    if count and n:
        changes[k] = marginals[: active[0]].sum(axis=0)
    return marginals[to], changes


def label_changes(labels: np.ndarray, lengths: np.ndarray, k: int) -> np.ndarray:
    """Observed label changes in the layout of ``forward_backward``."""
    ends = np.cumsum(lengths)
    firsts = (ends - lengths)[np.asarray(lengths) > 0]
    seen = np.zeros((k + 1, k))
    inside = np.ones(len(labels), bool)
    inside[firsts] = False
    at = np.flatnonzero(inside)
    np.add.at(seen, (labels[at - 1], labels[at]), 1)
    np.add.at(seen[k], labels[firsts], 1)
    return seen


class Adagrad:
    """Step sizes that shrink with the gradients seen, one for each weight."""

    def __init__(self, shape: tuple[int, ...], rate: float):
        self.rate, self.squares = rate, np.full(shape, 1e-8)

    def move(self, gradient: np.ndarray) -> np.ndarray:
        self.squares += gradient * gradient
        return self.rate * gradient / np.sqrt(self.squares)
