"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Characters are reduced to classes, so the model sees shapes rather than words; only the letters of
"at" and "dot", which stand for marks in spelled-out addresses, are classes of their own. Training maximizes
the likelihood of the labelled tag sequences: forward and backward passes of both directions, the
sums of the CRF by the forward-backward recursion, Adam steps.
"""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
# Tags: 0 outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
MARKS = "@.+-_%()[]{}<>/:;,#=*&|!?'\" \n"
PAD, DIGIT, LOWER, UPPER, OTHER = 0, 1, 2, 3, 4
LETTERS = "atdo"
CLASSES = 5 + len(MARKS) + len(LETTERS)
EMBED, HIDDEN = 10, 20


def class_table() -> np.ndarray:
    table = np.full(128, OTHER, np.uint8)
    table[48:58], table[97:123], table[65:91] = DIGIT, LOWER, UPPER
    for i, c in enumerate(MARKS):
        table[ord(c)] = 5 + i
    table[[9, 11, 12, 13]] = 5 + MARKS.index(" ")
    for i, c in enumerate(LETTERS):
        table[[ord(c), ord(c.upper())]] = 5 + len(MARKS) + i
    return table


TABLE = class_table()


def classes(points: np.ndarray) -> np.ndarray:
    """Class of each code point; letters beyond ASCII count as lower case."""
    return np.where(points < 128, TABLE[np.minimum(points, 127)], LOWER).astype(np.uint8)


def allowed() -> np.ndarray:
    """0 where a tag may follow another, a large negative number where not."""
    out = np.zeros((TAGS, TAGS), np.float32)
    for before in range(TAGS):
        for after in range(2, TAGS, 2):
            if before not in (after, after - 1):
                out[before, after] = -1e4
    return out


BARRED = allowed()
FIRST = np.where((np.arange(TAGS) > 0) & (np.arange(TAGS) % 2 == 0), np.float32(-1e4), np.float32(0))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def initial(seed: int) -> dict[str, np.ndarray]:
    chance = np.random.default_rng(seed)
    draw = lambda *shape: (chance.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    model = {"embed": draw(CLASSES, EMBED), "out": draw(2 * HIDDEN, TAGS), "out_bias": np.zeros(TAGS, np.float32)}
    model["moves"] = np.zeros((TAGS, TAGS), np.float32)
    for side in ("f", "b"):
        model[f"{side}_in"], model[f"{side}_rec"] = draw(EMBED, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN)
        model[f"{side}_bias"] = np.zeros(4 * HIDDEN, np.float32)
        model[f"{side}_bias"][HIDDEN : 2 * HIDDEN] = 1
    return model


def lstm(model: dict, side: str, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """Hidden states (time, row, HIDDEN) of one direction; ``x`` holds classes (row, time)."""
    table = model["embed"] @ model[f"{side}_in"] + model[f"{side}_bias"]
    rows, steps = x.shape
    h, c = np.zeros((rows, HIDDEN), np.float32), np.zeros((rows, HIDDEN), np.float32)
    out, past = np.empty((steps, rows, HIDDEN), np.float32), []
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        gates = table[x[:, t]]
        gates += h @ model[f"{side}_rec"]
        i, f, o = (sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in (0, 1, 2))
        g = np.tanh(gates[:, 3 * HIDDEN :])
        before, last = c, h
        c = f * c + i * g
        squashed = np.tanh(c)
        h = o * squashed
        out[t] = h
        if keep:
            past.append((t, i, f, o, g, before, last, squashed))
    return out, past


def lstm_back(model: dict, side: str, x: np.ndarray, past: list, d_out: np.ndarray, grads: dict) -> None:
    rows = x.shape[0]
    dh, dc = np.zeros((rows, HIDDEN), np.float32), np.zeros((rows, HIDDEN), np.float32)
    d_all = np.empty((x.shape[1], rows, 4 * HIDDEN), np.float32)
    d_rec = np.zeros_like(model[f"{side}_rec"])
    for t, i, f, o, g, before, last, squashed in reversed(past):
        dh = dh + d_out[t]
        dc = dc + dh * o * (1 - squashed * squashed)
        d_gates = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g * g)], 1)
        d_all[t] = d_gates
        d_rec += last.T @ d_gates
        dh, dc = d_gates @ model[f"{side}_rec"].T, dc * f
    shown = (x.T[:, :, None] == np.arange(CLASSES)).reshape(-1, CLASSES).astype(np.float32)
    d_table = shown.T @ d_all.reshape(-1, 4 * HIDDEN)
    grads[f"{side}_rec"] = d_rec
    grads[f"{side}_bias"] = d_table.sum(0)
    grads[f"{side}_in"] = model["embed"].T @ d_table
    grads["embed"] = grads.get("embed", 0) + d_table @ model[f"{side}_in"].T


def emissions(model: dict, x: np.ndarray) -> np.ndarray:
    states = np.concatenate([lstm(model, "f", x)[0], lstm(model, "b", x)[0]], 2)
    return states @ model["out"] + model["out_bias"]


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def loss_and_grads(model: dict, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Mean negative log-likelihood of the tags ``y`` (row, time) and its gradients."""
    rows, steps = x.shape
    ahead, past_f = lstm(model, "f", x, True)
    back, past_b = lstm(model, "b", x, True)
    states = np.concatenate([ahead, back], 2)
    score = states @ model["out"] + model["out_bias"]
    moves = model["moves"] + BARRED
    alpha, beta = np.empty((steps, rows, TAGS), np.float32), np.zeros((steps, rows, TAGS), np.float32)
    alpha[0] = score[0] + FIRST
    for t in range(1, steps):
        alpha[t] = log_sum(alpha[t - 1][:, :, None] + moves, 1) + score[t]
    for t in range(steps - 2, -1, -1):
        beta[t] = log_sum(moves + (score[t + 1] + beta[t + 1])[:, None, :], 2)
    whole = log_sum(alpha[-1], 1)
    at = np.arange(rows)
    gold = (FIRST[y[:, 0]] + score[0, at, y[:, 0]]).astype(np.float64)
    d_score = np.exp(alpha + beta - whole[:, None])
    d_moves = np.zeros((TAGS, TAGS), np.float32)
    for t in range(steps):
        d_score[t, at, y[:, t]] -= 1
        if t:
            gold += moves[y[:, t - 1], y[:, t]] + score[t, at, y[:, t]]
            pair = alpha[t - 1][:, :, None] + moves + (score[t] + beta[t])[:, None, :] - whole[:, None, None]
            d_moves += np.exp(pair).sum(0)
            np.add.at(d_moves, (y[:, t - 1], y[:, t]), -1)
    d_score /= rows
    flat = d_score.reshape(-1, TAGS)
    grads = {"out": states.reshape(-1, 2 * HIDDEN).T @ flat, "out_bias": flat.sum(0), "moves": d_moves / rows}
    d_states = d_score @ model["out"].T
    lstm_back(model, "f", x, past_f, d_states[:, :, :HIDDEN], grads)
    lstm_back(model, "b", x, past_b, d_states[:, :, HIDDEN:], grads)
    return float((whole - gold).mean()), grads


def trained(x: np.ndarray, y: np.ndarray, steps: int, batch: int, rate: float, seed: int) -> dict[str, np.ndarray]:
    """Adam over random batches; the rate falls linearly."""
    model, chance = initial(seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    for step in range(1, steps + 1):
        rows = chance.integers(0, len(x), batch)
        _, grads = loss_and_grads(model, x[rows], y[rows])
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        pace, clip = rate * (1 - 0.9 * step / steps), min(1.0, 5.0 / max(size, 1e-9))
        for name, grad in grads.items():
            grad = grad * np.float32(clip)
            first[name] += 0.1 * (grad - first[name])
            second[name] += 0.001 * (grad * grad - second[name])
            model[name] -= pace * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    return model


def decoded(model: dict, x: np.ndarray) -> np.ndarray:
    """Most likely tags (row, time) of class sequences ``x``."""
    score = emissions(model, x)
    moves = model["moves"] + BARRED
    steps, rows = score.shape[:2]
    best, back = score[0] + FIRST, np.zeros((steps, rows, TAGS), np.uint8)
    for t in range(1, steps):
        paths = best[:, :, None] + moves
        back[t] = paths.argmax(1)
        best = np.take_along_axis(paths, back[t][:, None, :].astype(np.int64), 1)[:, 0] + score[t]
    tags = np.zeros((rows, steps), np.uint8)
    tags[:, -1] = best.argmax(1)
    at = np.arange(rows)
    for t in range(steps - 1, 0, -1):
        tags[:, t - 1] = back[t][at, tags[:, t]]
    return tags


def spans_of(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the marked spans of one sequence."""
    out, t = [], 0
    while t < len(tags):
        if tags[t] % 2 == 1:
            end = t + 1
            while end < len(tags) and tags[end] == tags[t] + 1:
                end += 1
            out.append(((int(tags[t]) - 1) // 2, t, end))
            t = end
        else:
            t += 1
    return out
