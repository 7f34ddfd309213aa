"""Gated recurrent layers in numpy: batched steps, and gradients by backpropagation through time."""

from __future__ import annotations

import numpy as np

F32 = np.float32


def sigmoid(x: np.ndarray) -> np.ndarray:
    return F32(1) / (F32(1) + np.exp(-x))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Gru:
    """One layer over symbols: ``inputs`` holds what each symbol adds to the gates, ``state`` what the last state adds."""

    def __init__(self, symbols: int, hidden: int, rng: np.random.Generator):
        self.hidden = hidden
        self.inputs = rng.normal(0, 0.3, (symbols, 3 * hidden)).astype(F32)
        self.inputs[:, :hidden] += 1  # begin with slow gates
        self.state = (rng.normal(0, 1, (hidden, 3 * hidden)) / np.sqrt(hidden)).astype(F32)

    def step(self, symbols: np.ndarray, h: np.ndarray) -> np.ndarray:
        n = self.hidden
        x, u = self.inputs[symbols], h @ self.state
        gates = sigmoid(x[:, : 2 * n] + u[:, : 2 * n])
        new = np.tanh(x[:, 2 * n :] + gates[:, n:] * u[:, 2 * n :])
        return new + gates[:, :n] * (h - new)

    def run(self, symbols: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        """States (T, B, H) after each column of ``symbols`` (B, T), and what the gradient needs."""
        n = self.hidden
        x = self.inputs[symbols.T]
        steps, rows, _ = x.shape
        states = np.empty((steps + 1, rows, n), F32)
        un = np.empty((steps, rows, n), F32)
        gates, new = x[:, :, : 2 * n], x[:, :, 2 * n :]
        states[0] = h
        for t in range(steps):
            u = states[t] @ self.state
            gate, now = gates[t], new[t]
            gate += u[:, : 2 * n]
            np.negative(gate, out=gate)
            np.exp(gate, out=gate)
            gate += 1
            np.reciprocal(gate, out=gate)
            un[t] = u[:, 2 * n :]
            now += gate[:, n:] * un[t]
            np.tanh(now, out=now)
            np.subtract(states[t], now, out=states[t + 1])
            states[t + 1] *= gate[:, :n]
            states[t + 1] += now
        return states[1:], (states, gates, new, un)

    def gradient(self, symbols: np.ndarray, kept: tuple[np.ndarray, ...], d_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of ``inputs`` and ``state`` from those of the states, back through time."""
        n = self.hidden
        states, gates, new, un = kept
        steps, rows = new.shape[:2]
        z, r = gates[:, :, :n], gates[:, :, n:]
        # what does not depend on the gradient that comes back
        slope_new = (1 - z) * (1 - new * new)
        slope_z = (states[:-1] - new) * z * (1 - z)
        slope_r = slope_new * un * r * (1 - r)
        d_pre = np.empty((steps, rows, 3 * n), F32)
        d_u = np.empty((steps, rows, 3 * n), F32)
        d_h = np.zeros((rows, n), F32)
        back = np.ascontiguousarray(self.state.T)
        for t in range(steps - 1, -1, -1):
            d_h = d_h + d_states[t]
            here = d_u[t]
            np.multiply(d_h, slope_z[t], out=here[:, :n])
            np.multiply(d_h, slope_r[t], out=here[:, n : 2 * n])
            np.multiply(d_h, slope_new[t], out=d_pre[t, :, 2 * n :])
            np.multiply(d_pre[t, :, 2 * n :], r[t], out=here[:, 2 * n :])
            d_h *= z[t]
            d_h += here @ back
        d_pre[:, :, : 2 * n] = d_u[:, :, : 2 * n]
        d_state = states[:-1].reshape(-1, n).T @ d_u.reshape(-1, 3 * n)
        return self._by_symbol(symbols, d_pre.reshape(-1, 3 * n)), d_state

    def _by_symbol(self, symbols: np.ndarray, d_pre: np.ndarray) -> np.ndarray:
        """Gradient of ``inputs``: rows of one symbol are added up where they stand together."""
        flat = symbols.T.ravel()
        if len(self.inputs) <= 1 << 16:
            flat = flat.astype(np.uint16)  # sorted by radix
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        begin = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, np.int64)
        d_inputs = np.zeros_like(self.inputs)
        if len(begin):
            d_inputs[flat[begin]] = np.add.reduceat(d_pre[order], begin, axis=0)
        return d_inputs


class ColumnGru(Gru):
    """The same layer with texts as columns: states are (H, B), so each gate of a step is one block of memory."""

    def column_step(self, symbols: np.ndarray, h: np.ndarray) -> np.ndarray:
        n = self.hidden
        x, u = self.inputs[symbols].T.copy(), self.state.T @ h
        gates, new = x[: 2 * n], x[2 * n :]
        gates += u[: 2 * n]
        self._sigmoid(gates)
        new += np.multiply(gates[n:], u[2 * n :], out=u[2 * n :])
        np.tanh(new, out=new)
        out = np.subtract(h, new, out=u[:n])
        out *= gates[:n]
        out += new
        return out

    @staticmethod
    def _sigmoid(x: np.ndarray) -> None:
        np.negative(x, out=x)
        np.exp(x, out=x)
        x += 1
        np.reciprocal(x, out=x)

    def run(self, symbols: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        """States (T, H, B) after each column of ``symbols`` (B, T), and what the gradient needs."""
        n = self.hidden
        x = np.ascontiguousarray(self.inputs[symbols.T].transpose(0, 2, 1))
        steps, _, rows = x.shape
        states = np.empty((steps + 1, n, rows), F32)
        u = np.empty((steps, 3 * n, rows), F32)
        gates, new = x[:, : 2 * n], x[:, 2 * n :]
        states[0] = h
        ahead = np.ascontiguousarray(self.state.T)
        part = np.empty((n, rows), F32)
        for t in range(steps):
            add = np.matmul(ahead, states[t], out=u[t])
            gate, now = gates[t], new[t]
            gate += add[: 2 * n]
            self._sigmoid(gate)
            now += np.multiply(gate[n:], add[2 * n :], out=part)
            np.tanh(now, out=now)
            out = np.subtract(states[t], now, out=states[t + 1])
            out *= gate[:n]
            out += now
        return states[1:], (states, gates, new, u[:, 2 * n :])

    def gradient(self, symbols: np.ndarray, kept: tuple[np.ndarray, ...], d_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = self.hidden
        states, gates, new, un = kept
        steps, _, rows = new.shape
        z, r = gates[:, :n], gates[:, n:]
        slope_new = (1 - z) * (1 - new * new)
        slope_z = (states[:-1] - new) * z * (1 - z)
        slope_r = slope_new * un * r * (1 - r)
        d_new = np.empty((steps, n, rows), F32)
        d_u = np.empty((steps, 3 * n, rows), F32)
        d_h, part = np.zeros((n, rows), F32), np.empty((n, rows), F32)
        for t in range(steps - 1, -1, -1):
            d_h += d_states[t]
            here = d_u[t]
            np.multiply(d_h, slope_z[t], out=here[:n])
            np.multiply(d_h, slope_r[t], out=here[n : 2 * n])
            np.multiply(d_h, slope_new[t], out=d_new[t])
            np.multiply(d_new[t], r[t], out=here[2 * n :])
            d_h *= z[t]
            d_h += np.matmul(self.state, here, out=part)
        d_state = np.matmul(states[:-1], d_u.transpose(0, 2, 1)).sum(0)
        d_u[:, 2 * n :] = d_new
        d_pre = np.ascontiguousarray(d_u.transpose(0, 2, 1)).reshape(-1, 3 * n)
        return self._by_symbol(symbols, d_pre), d_state


class Adam:
    def __init__(self, values: list[np.ndarray], rate: float):
        self.values, self.rate, self.turn = values, rate, 0
        self.first = [np.zeros_like(v) for v in values]
        self.second = [np.zeros_like(v) for v in values]

    def update(self, gradients: list[np.ndarray], limit: float = 1.0) -> None:
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in gradients)))
        scale = min(1.0, limit / (norm + 1e-12))
        self.turn += 1
        rate = self.rate * np.sqrt(1 - 0.999**self.turn) / (1 - 0.9**self.turn)
        for value, g, a, b in zip(self.values, gradients, self.first, self.second):
            g = g * F32(scale)
            a += F32(0.1) * (g - a)
            b += F32(0.001) * (g * g - b)
            value -= F32(rate) * a / (np.sqrt(b) + F32(1e-8))
