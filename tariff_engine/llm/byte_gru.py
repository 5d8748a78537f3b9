"""A bidirectional gated recurrent network over bytes, in numpy: inference in batches, training by BPTT.

Texts are cut into windows of `WINDOW` bytes; all windows of a batch step through the network together, forward and
backward. Arrays are laid out (units, windows), so that every operation runs over contiguous memory. The gates'
weights are kept at half scale, as a logistic function is a hyperbolic tangent of half its argument.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WINDOW = 96
#: Symbol that fills up a text's last window.
PAD = 256
#: Windows that step together.
LANES = 2048


def windows(raw: bytes) -> np.ndarray:
    """The bytes of a text as rows of `WINDOW` symbols."""
    n = -(-len(raw) // WINDOW)
    out = np.full(n * WINDOW, PAD, dtype=np.int16)
    out[:len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    return out.reshape(n, WINDOW)


@dataclass
class ByteGru:
    """Weights by direction: symbols (2, 3H, 257), states (2, 3H, H), outputs (2, C, H), bias (C, 1)."""

    symbols: np.ndarray
    states: np.ndarray
    outputs: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, classes: int, hidden: int, seed: int = 0) -> ByteGru:
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        return cls(
            normal(2, 3 * hidden, PAD + 1, scale=0.3), normal(2, 3 * hidden, hidden, scale=0.6 / np.sqrt(hidden)),
            normal(2, classes, hidden, scale=1 / np.sqrt(hidden)), np.zeros((classes, 1), dtype=np.float32),
        )

    @property
    def hidden(self) -> int:
        return self.states.shape[2]

    def parameters(self) -> list[np.ndarray]:
        return [self.symbols, self.states, self.outputs, self.bias]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(positions, classes, lanes) for symbols (lanes, positions)."""
        steps = np.ascontiguousarray(x.T)
        length, lanes = steps.shape
        hid = self.hidden
        logits = np.empty((length, len(self.bias), lanes), dtype=np.float32)
        given, asked = np.empty((3 * hid, lanes), dtype=np.float32), np.empty((3 * hid, lanes), dtype=np.float32)
        for way in range(2):
            state = np.zeros((hid, lanes), dtype=np.float32)
            for t in range(length) if way == 0 else range(length - 1, -1, -1):
                np.take(self.symbols[way], steps[t], axis=1, out=given, mode="clip")
                np.matmul(self.states[way], state, out=asked)
                gates = given[:2 * hid]
                gates += asked[:2 * hid]
                np.tanh(gates, out=gates)
                gates *= 0.5
                gates += 0.5
                new, candidate = given[2 * hid:], asked[2 * hid:]
                candidate *= gates[hid:]
                new += candidate
                np.tanh(new, out=new)
                state -= new
                state *= gates[:hid]
                state += new
                if way == 0:
                    np.matmul(self.outputs[0], state, out=logits[t])
                else:
                    logits[t] += self.outputs[1] @ state
        logits += self.bias
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over the positions that are not padding, and its gradients, by BPTT."""
        steps = np.ascontiguousarray(x.T)
        length, lanes = steps.shape
        hid = self.hidden
        kept = []  # by direction: for each position the gates, candidate, states before and after, asked candidate
        logits = np.zeros((length, len(self.bias), lanes), dtype=np.float32)
        for way in range(2):
            state = np.zeros((hid, lanes), dtype=np.float32)
            rows: list = [None] * length
            for t in range(length) if way == 0 else range(length - 1, -1, -1):
                given, asked = self.symbols[way][:, steps[t]], self.states[way] @ state
                gates = 0.5 * np.tanh(given[:2 * hid] + asked[:2 * hid]) + 0.5
                new = np.tanh(given[2 * hid:] + gates[hid:] * asked[2 * hid:])
                after = new + gates[:hid] * (state - new)
                rows[t] = (gates, new, state, after, asked[2 * hid:])
                state = after
                logits[t] += self.outputs[way] @ state
            kept.append(rows)
        logits += self.bias
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        p = logits / logits.sum(axis=1, keepdims=True)
        real = (steps != PAD).astype(np.float32)
        n = max(1.0, float(real.sum()))
        truth = np.take_along_axis(p, np.broadcast_to(y[None, None, :], (length, 1, lanes)), axis=1)[:, 0]
        loss = float(-(np.log(np.maximum(truth, 1e-9)) * real).sum() / n)
        delta = p.copy()
        np.put_along_axis(delta, np.broadcast_to(y[None, None, :], (length, 1, lanes)), truth[:, None] - 1, axis=1)
        delta *= real[:, None] / n
        out = [np.zeros_like(w) for w in self.parameters()]
        out[3][:, 0] = delta.sum(axis=(0, 2))
        for way in range(2):
            back = np.zeros((hid, lanes), dtype=np.float32)
            for t in range(length - 1, -1, -1) if way == 0 else range(length):
                gates, new, before, after, asked_new = kept[way][t]
                z, r = gates[:hid], gates[hid:]
                out[2][way] += delta[t] @ after.T
                back = back + self.outputs[way].T @ delta[t]
                d_new = back * (1 - z) * (1 - new * new)
                # the gates' weights are at half scale: d logistic(2a) / da = 2 s (1 - s)
                d_z = back * (before - new) * 2 * z * (1 - z)
                d_r = d_new * asked_new * 2 * r * (1 - r)
                d_given = np.concatenate([d_z, d_r, d_new])
                d_asked = np.concatenate([d_z, d_r, d_new * r])
                one_hot = np.zeros((lanes, PAD + 1), dtype=np.float32)
                one_hot[np.arange(lanes), steps[t]] = 1
                out[0][way] += d_given @ one_hot
                out[1][way] += d_asked @ before.T
                back = back * z + self.states[way].T @ d_asked
        return loss, out


def train(x: np.ndarray, y: np.ndarray, classes: int, hidden: int = 8, steps: int = 240, lanes: int = 192, rate: float = 0.02, seed: int = 0) -> ByteGru:
    """Fit by Adam on windows ``x`` with one class for all positions of a window."""
    rng = np.random.default_rng(seed)
    net = ByteGru.fresh(classes, hidden, seed)
    first = [np.zeros_like(w) for w in net.parameters()]
    second = [np.zeros_like(w) for w in net.parameters()]
    for step in range(1, steps + 1):
        at = rng.integers(0, len(x), lanes)
        part = x[at]
        # a third of the windows end early, as short texts do
        ends = np.where(rng.random(lanes) < 1 / 3, rng.integers(4, x.shape[1] + 1, lanes), x.shape[1])
        part[np.arange(x.shape[1])[None, :] >= ends[:, None]] = PAD
        _, grads = net.gradients(part, y[at])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        speed = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for w, g, m, v in zip(net.parameters(), grads, first, second):
            g = g / max(1.0, norm)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= speed * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net
