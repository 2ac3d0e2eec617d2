"""Gated recurrent layers in numpy, with their gradients.

Arrays are (steps, directions, lanes, features), so that two directions advance in one loop.
"""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def forward(
    inputs: np.ndarray, weights: np.ndarray, state: np.ndarray, keep: np.ndarray | None = None, tape: bool = False
) -> tuple[np.ndarray, list | None]:
    """States after each step.

    ``inputs``: projected inputs with bias, three gates wide (update, reset, candidate).
    ``weights``: (directions, hidden, 3 * hidden). ``state``: the state before the first step.
    ``keep``: (steps, directions, lanes), 0 where the state before the step counts as zero.
    With ``tape`` what the gradient needs is kept.
    """
    hidden = weights.shape[1]
    out = np.empty((*inputs.shape[:3], hidden), dtype=np.float32)
    kept = [] if tape else None
    # each gate is an array of its own: (directions, gates, lanes, features)
    apart = np.ascontiguousarray(weights.reshape(len(weights), hidden, 3, hidden).swapaxes(1, 2))
    given = inputs.reshape(*inputs.shape[:3], 3, hidden).swapaxes(2, 3)
    for step, begins in enumerate(_begun(keep, len(inputs))):
        if begins:
            state = state * keep[step][..., None]
        ours = np.matmul(state[:, None], apart)
        gates, recur = ours[:, :2], ours[:, 2]
        gates += given[step, :, :2]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        update, reset = gates[:, 0], gates[:, 1]
        candidate = reset * recur
        candidate += given[step, :, 2]
        np.tanh(candidate, out=candidate)
        if tape:
            kept.append((state, update, reset, candidate, recur))
        state = state - candidate
        state *= update
        state += candidate
        out[step] = state
    return out, kept


def _begun(keep: np.ndarray | None, steps: int) -> list[bool]:
    """Whether any state counts as zero before each step."""
    return [False] * steps if keep is None else (keep == 0).any(axis=(1, 2)).tolist()


def backward(
    grads: np.ndarray, weights: np.ndarray, tape: list, keep: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the projected inputs and of the weights, from those of the states."""
    hidden = weights.shape[1]
    d_inputs = np.empty((*grads.shape[:3], 3 * hidden), dtype=np.float32)
    d_weights = np.zeros_like(weights)
    carried = np.zeros_like(grads[0])
    turned = np.swapaxes(weights, 1, 2)
    begun = _begun(keep, len(grads))
    for step in range(len(grads) - 1, -1, -1):
        state, update, reset, candidate, recur = tape[step]
        d_state = grads[step] + carried
        d_candidate = d_state * (1 - update)
        d_candidate *= 1 - candidate * candidate
        d_update = state - candidate
        d_update *= d_state
        d_update *= update
        d_update *= 1 - update
        d_reset = d_candidate * recur
        d_reset *= reset
        d_reset *= 1 - reset
        ours = d_inputs[step]
        ours[..., :hidden] = d_update
        ours[..., hidden : 2 * hidden] = d_reset
        ours[..., 2 * hidden :] = d_candidate
        ours = ours.copy()
        ours[..., 2 * hidden :] *= reset
        d_weights += np.matmul(np.swapaxes(state, 1, 2), ours)
        carried = np.matmul(ours, turned)
        d_state *= update
        carried += d_state
        if begun[step]:
            carried *= keep[step][..., None]
    return d_inputs, d_weights


def row_sums(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows and the sum of the values of each."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])) if len(rows) else rows
    sums = np.add.reduceat(values[order], first, axis=0) if len(rows) else values
    return rows[first], sums


class Adam:
    """Steps from running means of gradients and their squares; of a table only given rows move."""

    def __init__(self, params: dict[str, np.ndarray], rate: float, first: float = 0.9, second: float = 0.99):
        self.params, self.rate, self.first, self.second = params, rate, first, second
        self.mean = {k: np.zeros_like(v) for k, v in params.items()}
        self.square = {k: np.zeros_like(v) for k, v in params.items()}
        self.steps = 0

    def step(self, grads: dict[str, np.ndarray | tuple[np.ndarray, np.ndarray]], share: float = 1.0) -> None:
        self.steps += 1
        rate = share * self.rate * (1 - self.second**self.steps) ** 0.5 / (1 - self.first**self.steps)
        for name, grad in grads.items():
            rows, grad = row_sums(*grad) if isinstance(grad, tuple) else (slice(None), grad)
            mean, square = self.mean[name][rows], self.square[name][rows]  # whole tables are changed in place
            mean *= self.first
            mean += grad * (1 - self.first)
            square *= self.second
            part = grad * grad
            part *= 1 - self.second
            square += part
            if not isinstance(rows, slice):
                self.mean[name][rows], self.square[name][rows] = mean, square
            spread = np.sqrt(square, out=part)
            spread += 1e-8
            self.params[name][rows] -= rate * mean / spread
