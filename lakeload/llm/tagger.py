"""A character tagger in numpy: bidirectional LSTM, linear layer, CRF over the tags."""

from __future__ import annotations

import numpy as np

Params = dict[str, np.ndarray]


def encode(texts: list[str], length: int) -> np.ndarray:
    """ASCII as it is, other letters 1, anything else 2, padding 0."""
    codes = np.zeros((len(texts), length), np.int64)
    for row, text in zip(codes, texts):
        row[: len(text)] = [o if (o := ord(c)) < 128 else 1 + (not c.isalpha()) for c in text]
    return codes


def new(tags: int, size: int = 12, hidden: int = 20, seed: int = 3) -> Params:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {"chars": draw(128, size) * 3, "out": draw(2 * hidden, tags), "out_b": np.zeros(tags, np.float32)}
    for d in ("f", "b"):
        p |= {f"in_{d}": draw(size, 4 * hidden), f"on_{d}": draw(hidden, 4 * hidden), f"bias_{d}": np.zeros(4 * hidden, np.float32)}
        p[f"bias_{d}"][hidden : 2 * hidden] = 1  # remember at first
    return p | {"move": np.zeros((tags, tags), np.float32), "begin": np.zeros(tags, np.float32)}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _lstm(p: Params, d: str, codes: np.ndarray, trace: list | None = None) -> np.ndarray:
    """Hidden states (steps, rows, hidden) of one direction."""
    h = p[f"on_{d}"].shape[0]
    table = p["chars"] @ p[f"in_{d}"] + p[f"bias_{d}"]
    rows, steps = codes.shape
    out = np.empty((steps, rows, h), np.float32)
    state = cell = np.zeros((rows, h), np.float32)
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        z = table[codes[:, t]] + state @ p[f"on_{d}"]
        gates = _sigmoid(z[:, : 3 * h])  # in, forget, out
        new_value, old, before = np.tanh(z[:, 3 * h :]), cell, state
        cell = gates[:, h : 2 * h] * cell + gates[:, :h] * new_value
        shown = np.tanh(cell)
        state = gates[:, 2 * h :] * shown
        out[t] = state
        if trace is not None:
            trace.append((t, gates, new_value, old, shown, before))
    return out


def emissions(p: Params, codes: np.ndarray) -> np.ndarray:
    """(steps, rows, tags)."""
    states = np.concatenate([_lstm(p, "f", codes), _lstm(p, "b", codes)], axis=2)
    return states @ p["out"] + p["out_b"]


def decode(p: Params, codes: np.ndarray) -> np.ndarray:
    """The best tags of each row (rows, steps), by Viterbi."""
    e = emissions(p, codes)
    steps, rows, tags = e.shape
    best, back = e[0] + p["begin"], np.empty((steps, rows, tags), np.int8)
    for t in range(1, steps):
        through = best[:, :, None] + p["move"]
        back[t] = through.argmax(1)
        best = through.max(1) + e[t]
    out = np.empty((rows, steps), np.int8)
    out[:, -1] = best.argmax(1)
    for t in range(steps - 1, 0, -1):
        out[:, t - 1] = back[t][np.arange(rows), out[:, t]]
    return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def _crf(p: Params, e: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Mean negative log likelihood and its slopes by emissions, moves and beginnings."""
    steps, rows, k = e.shape
    ahead, behind = np.empty_like(e), np.zeros_like(e)
    ahead[0] = e[0] + p["begin"]
    for t in range(1, steps):
        ahead[t] = _log_sum(ahead[t - 1][:, :, None] + p["move"], 1) + e[t]
    for t in range(steps - 2, -1, -1):
        behind[t] = _log_sum(p["move"] + (e[t + 1] + behind[t + 1])[:, None, :], 2)
    total = _log_sum(ahead[-1], 1)
    slope = np.exp(ahead + behind - total[:, None])
    moves = np.zeros_like(p["move"])
    every, at = np.arange(rows), tags.T
    gold = p["begin"][at[0]] + e[0][every, at[0]]
    for t in range(1, steps):
        both = ahead[t - 1][:, :, None] + p["move"] + (e[t] + behind[t])[:, None, :] - total[:, None, None]
        moves += np.exp(both).sum(0)
        np.add.at(moves, (at[t - 1], at[t]), -1)
        gold = gold + p["move"][at[t - 1], at[t]] + e[t][every, at[t]]
    for t in range(steps):
        slope[t][every, at[t]] -= 1
    return float((total - gold).mean()), slope / rows, moves / rows, slope[0].sum(0) / rows


def slopes(p: Params, codes: np.ndarray, tags: np.ndarray) -> tuple[float, Params]:
    traces: dict[str, list] = {"f": [], "b": []}
    states = np.concatenate([_lstm(p, d, codes, traces[d]) for d in "fb"], axis=2)
    loss, by_e, moves, begin = _crf(p, states @ p["out"] + p["out_b"], tags)
    g = {"move": moves, "begin": begin, "out_b": by_e.sum((0, 1)), "chars": np.zeros_like(p["chars"])}
    g["out"] = np.einsum("tbh,tbk->hk", states, by_e)
    by_state = by_e @ p["out"].T
    h = by_state.shape[2] // 2
    for d, part in (("f", by_state[:, :, :h]), ("b", by_state[:, :, h:])):
        on = p[f"on_{d}"]
        by_table, by_on = np.zeros((128, 4 * h), np.float32), np.zeros_like(on)
        carry, by_cell = np.zeros((codes.shape[0], h), np.float32), np.zeros((codes.shape[0], h), np.float32)
        for t, gates, value, old, shown, before in reversed(traces[d]):
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            s = part[t] + carry
            by_cell = by_cell + s * o * (1 - shown * shown)
            z = np.concatenate(
                [by_cell * value * i * (1 - i), by_cell * old * f * (1 - f), s * shown * o * (1 - o), by_cell * i * (1 - value * value)],
                axis=1,
            )
            by_cell = by_cell * f
            carry = z @ on.T
            by_on += before.T @ z
            np.add.at(by_table, codes[:, t], z)
        g[f"on_{d}"], g[f"bias_{d}"] = by_on, by_table.sum(0)
        g[f"in_{d}"] = p["chars"].T @ by_table
        g["chars"] += by_table @ p[f"in_{d}"].T
    return loss, g


def train(codes: np.ndarray, tags: np.ndarray, count: int, rounds: int = 500, batch: int = 48, rate: float = 0.02, seed: int = 3) -> Params:
    """Adam over random batches; the rate falls to a tenth."""
    p, rng = new(count, seed=seed), np.random.default_rng(seed)
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    for t in range(1, rounds + 1):
        rows = rng.integers(0, len(codes), batch)
        _, g = slopes(p, codes[rows], tags[rows])
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        now = rate * (1 - 0.9 * t / rounds) * min(1.0, 5 / max(norm, 1e-9))
        for k in p:
            m[k], v[k] = 0.9 * m[k] + 0.1 * g[k], 0.99 * v[k] + 0.01 * g[k] * g[k]
            p[k] = (p[k] - now * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-6)).astype(np.float32)
    return p
