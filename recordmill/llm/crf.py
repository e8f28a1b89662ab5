"""A linear-chain conditional random field in numpy: likelihood, gradient and Viterbi for padded batches."""

from __future__ import annotations

import numpy as np


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def gradients(emit: np.ndarray, mask: np.ndarray, tags: np.ndarray, trans: np.ndarray, start: np.ndarray):
    """Gradients of the mean log-likelihood by the emissions, transitions and start scores.

    ``emit`` is (batch, steps, tags); ``mask`` marks real steps, which come first in every row.
    """
    n, steps, k = emit.shape
    alpha, beta = np.empty_like(emit), np.zeros_like(emit)
    alpha[:, 0] = emit[:, 0] + start
    for t in range(1, steps):
        new = emit[:, t] + _logsumexp(alpha[:, t - 1, :, None] + trans, 1)
        alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
    for t in range(steps - 2, -1, -1):
        new = _logsumexp(trans + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        beta[:, t] = np.where(mask[:, t + 1, None], new, 0.0)
    log_z = _logsumexp(alpha[:, -1], 1)
    prob = np.exp(alpha + beta - log_z[:, None, None]) * mask[:, :, None]
    gold = np.eye(k)[tags] * mask[:, :, None]
    d_emit = (gold - prob) / n
    d_trans = np.zeros_like(trans)
    for t in range(1, steps):
        live = mask[:, t]
        pair = alpha[live, t - 1, :, None] + trans + (emit[live, t] + beta[live, t])[:, None, :] - log_z[live, None, None]
        d_trans += np.einsum("bi,bj->ij", gold[live, t - 1], gold[live, t]) - np.exp(pair).sum(0)
    return d_emit, d_trans / n, d_emit[:, 0].sum(0)


def viterbi(emit: np.ndarray, sizes: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Best tags of many sequences laid end to end in ``emit`` (rows, tags), ``sizes`` rows each.

    All sequences advance together, the longest first, so that the running ones are a prefix.
    """
    tags = np.zeros(len(emit), dtype=np.int64)
    if not len(emit):
        return tags
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    first, sizes = first[order], sizes[order]
    running = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")  # sequences longer than t
    back = np.zeros(emit.shape, dtype=np.int8)
    score = emit[first] + start
    for t in range(1, sizes[0]):
        n = running[t]
        every = score[:n, :, None] + trans
        back[first[:n] + t] = every.argmax(1)
        score[:n] = every.max(1) + emit[first[:n] + t]
    best = score.argmax(1)
    tags[first + sizes - 1] = best
    for t in range(sizes[0] - 1, 0, -1):
        n = running[t]
        here = first[:n] + t
        tags[here - 1] = back[here, tags[here]]
    return tags
