"""A gated recurrent language model in numpy: GRU cell, class-factored softmax, truncated backpropagation.

The next token is predicted as P(class | state) * P(token | class, state) for
the tokens of the leading classes, whose members have output weights of their
own, and as P(class | state) alone for the trailing classes, whose members are
parted by fixed counts elsewhere. Texts run side by side in lanes; the state of
a lane is carried from window to window and cleared where a text begins, so the
likelihood of a text is that of the whole text however long it is. Gradients
stop at the border of a window.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

HIDDEN = 16
MEMBERS = 64  # tokens of a leading class
LANES = 512
WINDOW = 16
RATE = 0.1
CLIP = 5.0


@dataclass(frozen=True)
class Shape:
    """Token ids are numbered by class: MEMBERS of each leading class, then one id per trailing class."""

    inputs: int  # input ids; the last one is the start of a text
    leading: int  # classes of MEMBERS tokens with output weights of their own
    classes: int  # all classes, the leading ones first
    hidden: int = HIDDEN

    def split(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each token, and its place in a leading class, else -1."""
        ids = ids.astype(np.int32)
        lead = self.leading * MEMBERS
        first = ids < lead
        return np.where(first, ids // MEMBERS, ids - lead + self.leading), np.where(first, ids % MEMBERS, -1)

    def parts(self) -> list[tuple[str, tuple[int, ...]]]:
        h = self.hidden
        return [
            ("embed", (self.inputs, 3 * h)),
            ("recur", (h, 3 * h)),
            ("to_class", (h, self.classes)),
            ("class_bias", (self.classes,)),
            ("to_member", (self.leading, h, MEMBERS)),
            ("member_bias", (self.leading, MEMBERS)),
        ]

    def size(self) -> int:
        return sum(int(np.prod(s)) for _, s in self.parts())

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.parts():
            n = int(np.prod(shape))
            out[name] = flat[at : at + n].reshape(shape)
            at += n
        return out


def first_weights(shape: Shape, class_log: np.ndarray, member_log: np.ndarray, seed: int = 7) -> np.ndarray:
    """Small random weights, with biases that make the first model the count model."""
    rng = np.random.default_rng(seed)
    flat = (rng.standard_normal(shape.size()) * 0.1).astype(np.float32)
    v = shape.views(flat)
    v["recur"][:] = rng.standard_normal(v["recur"].shape) / np.sqrt(shape.hidden)
    v["to_class"][:] = 0
    v["to_member"][:] = 0
    v["class_bias"][:] = class_log
    v["member_bias"][:] = member_log
    return flat


def _sigmoid(x: np.ndarray) -> None:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5


@dataclass
class Lanes:
    """Texts packed side by side: row t holds the t-th token of every lane, longest lanes first."""

    x: np.ndarray  # input id
    y: np.ndarray  # id of the token to predict
    fresh: np.ndarray  # a text begins here
    text: np.ndarray  # which text the token is of
    length: np.ndarray  # tokens of each lane


def pack(texts: list[np.ndarray], start: int, lanes: int = LANES) -> Lanes:
    """Deal id sequences to lanes of about equal length, the longest texts first."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    n = max(1, min(lanes, len(texts)))
    heap, dealt = [(0, k) for k in range(n)], [[] for _ in range(n)]
    for i in order:
        used, k = heapq.heappop(heap)
        dealt[k].append(i)
        heapq.heappush(heap, (used + len(texts[i]), k))
    sizes = np.array([sum(len(texts[i]) for i in d) for d in dealt])
    by = np.argsort(-sizes, kind="stable")
    total = int(sizes.max()) if len(sizes) else 0
    made = Lanes(
        np.zeros((total, n), np.int16),
        np.zeros((total, n), np.int16),
        np.zeros((total, n), bool),
        np.zeros((total, n), np.int32),
        sizes[by],
    )
    for lane, k in enumerate(by):
        at = 0
        for i in dealt[k]:
            end = at + len(texts[i])
            made.x[at, lane] = start
            made.x[at + 1 : end, lane] = texts[i][:-1]
            made.y[at:end, lane] = texts[i]
            made.fresh[at, lane] = True
            made.text[at:end, lane] = i
            at = end
    return made


class _Alive:
    """Picks the tokens of a window that exist; all of them while no lane has ended."""

    def __init__(self, lanes: Lanes, lo: int, hi: int, active: int):
        whole = lanes.length[active - 1] >= hi if active else True
        self.mask = None if whole else np.arange(lo, hi)[:, None] < lanes.length[None, :active]

    def __call__(self, values: np.ndarray) -> np.ndarray:
        return values.reshape(-1, *values.shape[2:]) if self.mask is None else values[self.mask]

    def back(self, picked: np.ndarray, shape: tuple) -> np.ndarray:
        if self.mask is None:
            return picked.reshape(shape)
        out = np.zeros(shape, picked.dtype)
        out[self.mask] = picked
        return out


class Model:
    def __init__(self, shape: Shape, flat: np.ndarray):
        self.shape, self.flat = shape, flat
        self.w = shape.views(flat)

    def _run(self, x: np.ndarray, fresh: np.ndarray, h: np.ndarray) -> tuple[list, np.ndarray]:
        """States before each step of a window, with what the backward pass needs."""
        embed, recur = self._gates("embed"), self._gates("recur")
        steps = []
        began = fresh.any(axis=1)
        for t in range(len(x)):
            keep = ~fresh[t][:, None] if began[t] else None
            if keep is not None:
                h = h * keep
            a = embed.take(x[t], axis=1)
            g = np.matmul(h, recur)
            zr = a[:2]
            zr += g[:2]
            _sigmoid(zr)
            z, r = zr
            c = r * g[2]
            c += a[2]
            np.tanh(c, out=c)
            after = h - c
            after *= z
            after += c
            steps.append((h, zr, c, g[2], keep, after))
            h = after
        return steps, h

    def _gates(self, name: str) -> np.ndarray:
        """The weights of a matrix, gate by gate: each gate's in one piece."""
        matrix = self.w[name]
        return np.ascontiguousarray(matrix.reshape(len(matrix), 3, self.shape.hidden).transpose(1, 0, 2))

    def _windows(self, lanes: Lanes, window: int):
        """(rows, active lanes) of each window; lanes that have ended fall away from the right."""
        for lo in range(0, len(lanes.x), window):
            active = int((lanes.length > lo).sum())
            yield lo, min(lo + window, len(lanes.x)), active

    def _outputs(self, hs, y, m):
        """Log-probability of the class and of the member, with what the backward pass needs.

        Logits are small (biases of log counts, states within -1 and 1), so the
        exponentials of single precision need no shift.
        """
        w = self.w
        e = hs @ w["to_class"]
        e += w["class_bias"]
        log_p = e[np.arange(len(y)), y]
        np.exp(e, out=e)
        total = e @ np.ones(e.shape[1], np.float32)
        log_p -= np.log(total)
        order = np.flatnonzero(m >= 0)
        order = order[np.argsort(y[order], kind="stable")]
        groups = []
        if len(order):
            cls = y[order]
            edges = np.concatenate(([0], np.flatnonzero(np.diff(cls)) + 1, [len(cls)])).tolist()
            states = hs[order]
            member_log = np.empty(len(order), np.float32)
            ones = np.ones(MEMBERS, np.float32)
            for lo, hi in zip(edges[:-1], edges[1:]):
                k = int(cls[lo])
                f = states[lo:hi] @ w["to_member"][k]
                f += w["member_bias"][k]
                at = np.arange(hi - lo), m[order[lo:hi]]
                own = f[at]
                np.exp(f, out=f)
                s = f @ ones
                member_log[lo:hi] = own - np.log(s)
                groups.append((k, lo, hi, f, s, at))
            log_p[order] += member_log
            groups = (order, states, groups)
        return log_p, e, total, groups

    def log_likelihoods(self, lanes: Lanes, n_texts: int, window: int = 4 * WINDOW) -> np.ndarray:
        """Natural log-probability of each whole text under classes and leading members."""
        out = np.zeros(n_texts)
        h = np.zeros((lanes.x.shape[1], self.shape.hidden), np.float32)
        for lo, hi, active in self._windows(lanes, window):
            steps, last = self._run(lanes.x[lo:hi, :active], lanes.fresh[lo:hi, :active], h[:active])
            h = last
            alive = _Alive(lanes, lo, hi, active)
            hs = alive(np.stack([s[5] for s in steps]))
            log_p = self._outputs(hs, *self.shape.split(alive(lanes.y[lo:hi, :active])))[0]
            out += np.bincount(alive(lanes.text[lo:hi, :active]), weights=log_p, minlength=n_texts)
        return out

    def train(self, lanes: Lanes, squares: np.ndarray, rate: float = RATE, window: int = WINDOW) -> float:
        """One pass over the lanes, a step of Adagrad per window; the mean loss in nats."""
        h = np.zeros((lanes.x.shape[1], self.shape.hidden), np.float32)
        loss = count = 0.0
        sums = self.shape.views(squares)
        for lo, hi, active in self._windows(lanes, window):
            x, fresh = lanes.x[lo:hi, :active], lanes.fresh[lo:hi, :active]
            steps, h = self._run(x, fresh, h[:active])
            alive = _Alive(lanes, lo, hi, active)
            grads, lost, n = self._gradients(steps, x, lanes.y[lo:hi, :active], alive)
            self._step(grads, sums, rate)
            loss += lost
            count += n
        return loss / max(1.0, count)

    def _gradients(self, steps, x, y, alive):
        k, w = self.shape.hidden, self.w
        all_states = np.stack([s[5] for s in steps])
        hs, (ya, ma) = alive(all_states), self.shape.split(alive(y))
        n = len(ya)
        log_p, e, total, members = self._outputs(hs, ya, ma)
        scale = np.float32(1.0 / LANES)
        e *= (scale / total)[:, None]
        e[np.arange(n), ya] -= scale
        g = {"to_class": hs.T @ e, "class_bias": e.sum(axis=0)}
        d_hs = e @ w["to_class"].T
        g["to_member"], g["member_bias"] = np.zeros_like(w["to_member"]), np.zeros_like(w["member_bias"])
        g["members"] = [c for c, *_ in members[2]] if members else []
        if members:
            order, states, groups = members
            d_states = np.empty_like(states)
            for c, lo, hi, f, s, at in groups:
                f *= (scale / s)[:, None]
                f[at] -= scale
                np.matmul(states[lo:hi].T, f, out=g["to_member"][c])
                g["member_bias"][c] = np.ones(hi - lo, np.float32) @ f
                np.matmul(f, w["to_member"][c].T, out=d_states[lo:hi])
            d_hs[order] += d_states
        d_all = alive.back(d_hs, all_states.shape)
        d_recur = np.zeros_like(w["recur"])
        d_embed = np.zeros((len(steps), all_states.shape[1], 3 * k), np.float32)
        d_h = np.zeros_like(all_states[0])
        recur_t = np.ascontiguousarray(w["recur"].T)
        d_g = np.empty_like(d_embed[0])
        for t in range(len(steps) - 1, -1, -1):
            before, (z, r), c, gc, keep, _ = steps[t]
            d = d_all[t]
            d += d_h
            rest = 1 - z
            d_c = d * rest
            flat = c * c
            np.subtract(1, flat, out=flat)
            d_c *= flat
            d_z = before - c
            d_z *= d
            d_z *= z
            d_z *= rest
            d_r = d_c * gc
            d_r *= r
            d_r *= 1 - r
            d_g[:, :k], d_g[:, k : 2 * k] = d_z, d_r
            d_embed[t] = d_g
            d_embed[t, :, 2 * k :] = d_c
            np.multiply(d_c, r, out=d_g[:, 2 * k :])
            d_recur += before.T @ d_g
            d_h = d_g @ recur_t
            d *= z
            d_h += d
            if keep is not None:
                d_h *= keep
        g["recur"] = d_recur
        ids = x.ravel()
        order = np.argsort(ids, kind="stable")
        own = ids[order]
        starts = np.concatenate(([0], np.flatnonzero(np.diff(own)) + 1))
        g["embed"] = (own[starts], np.add.reduceat(d_embed.reshape(-1, 3 * k)[order], starts, axis=0))
        return g, -float(log_p.sum()), n

    def _step(self, g: dict, s: dict, rate: float) -> None:
        def adagrad(weight, square, grad):
            np.clip(grad, -CLIP, CLIP, out=grad)
            square += grad * grad
            weight -= rate * grad / np.sqrt(square + 1e-6)

        for name in ("recur", "to_class", "class_bias"):
            adagrad(self.w[name], s[name], g[name])
        for name in ("to_member", "member_bias"):
            if 2 * len(g["members"]) > self.shape.leading:
                adagrad(self.w[name], s[name], g[name])
            else:
                for c in g["members"]:  # the gradients of the others are zero
                    adagrad(self.w[name][c], s[name][c], g[name][c])
        ids, grad = g["embed"]
        np.clip(grad, -CLIP, CLIP, out=grad)
        s["embed"][ids] += grad * grad
        self.w["embed"][ids] -= rate * grad / np.sqrt(s["embed"][ids] + 1e-6)
