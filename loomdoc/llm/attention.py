"""A small causal self-attention language model over class-coded subwords, in numpy.

The next subword is coded in three steps: its group, its class in the group, and for rare subwords
its share of the class.  The logits of either of the first steps are a row of bigram log probabilities
of the current subword's unit, from counts, plus a trained product with the state  e Wr + a Wo : the
unit's embedding and one attention head over the units before it, with a bias per distance.
"""

from __future__ import annotations

import numpy as np

OVERLAP, STEP, DIM = 8, 16, 16
SPAN = OVERLAP + STEP
F32 = np.float32
_FAR = OVERLAP + np.arange(STEP)[None, :] - np.arange(SPAN)[:, None]  # of a query (column) from a key (row)
_CAUSAL, _FAR = _FAR >= 0, np.maximum(_FAR, 0)


class Model:
    """Trained: E units x d, G groups x d, U classes x d, Wq Wk Wv Wo Wr d x d, R distances.
    From counts: first (units x groups) and then (units x classes), bigram log probabilities of a group
    and of a class in its group."""

    def __init__(self, first: np.ndarray, then: np.ndarray, seed: int = 11):
        r = np.random.default_rng(seed)
        w = lambda *s, scale: (r.standard_normal(s) * scale).astype(F32)
        self.first, self.then = first.astype(F32), then.astype(F32)
        self.groups, self.classes = first.shape[1], then.shape[1]
        self.size = self.classes // self.groups
        self.by_group = self.then.reshape(-1, self.size)
        self.p = {"E": w(len(first), DIM, scale=0.5), "G": w(self.groups, DIM, scale=0.1), "U": w(self.classes, DIM, scale=0.1)}
        for name in ("Wq", "Wk", "Wv", "Wo", "Wr"):
            self.p[name] = w(DIM, DIM, scale=DIM**-0.5)
        self.p["Wo"] *= F32(0.5)
        self.p["Wr"] *= F32(0.1)
        self.p["R"] = (-0.3 * np.arange(SPAN)).astype(F32)

    def tables(self) -> tuple:
        """Everything about a unit that does not depend on its context: query, key, value,
        logits of groups and classes; the bias of distances; computed once for scoring."""
        p = self.p
        q, k = p["E"] @ (p["Wq"] * F32(DIM**-0.5)), p["E"] @ p["Wk"]
        top = float((q @ k.T).max() + p["R"].max())
        bias = np.where(_CAUSAL, p["R"][_FAR] - F32(max(0.0, top - 60)), F32(-1e9)).astype(F32)  # exp stays finite
        own = p["E"] @ p["Wr"]
        return q, k, p["E"] @ (p["Wv"] @ p["Wo"]), own @ p["G"].T + self.first, (own @ p["U"].T + self.then).reshape(-1, self.size), bias

    def _by_group(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, slice]]]:
        """The order of the targets' groups, groups and places in that order, and each group's rows in it."""
        target = target.ravel().astype(np.int32)
        group = target // np.int32(self.size)
        place = target - group * np.int32(self.size)
        cuts = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=self.groups))]).tolist()
        order = np.argsort(group.astype(np.uint8 if self.groups <= 256 else np.uint16), kind="stable")  # by radix
        rows = [(i, slice(cuts[i], cuts[i + 1])) for i in range(self.groups) if cuts[i] < cuts[i + 1]]
        return order, np.take(group, order), np.take(place, order), rows

    def _logits(self, h: np.ndarray, unit: np.ndarray, group: np.ndarray, rows: list, then: np.ndarray) -> np.ndarray:
        """Logits of the classes in each row's group, the rows in order of groups."""
        z, each = np.take(then, unit * self.groups + group, axis=0), self.p["U"].reshape(self.groups, self.size, -1)
        each, more = np.ascontiguousarray(each.transpose(0, 2, 1)), np.empty_like(z)
        for i, its in rows:
            np.matmul(h[its], each[i], out=more[its])
        z += more
        return z

    def logprob(self, x: np.ndarray, valid: np.ndarray, target: np.ndarray, tables: tuple) -> np.ndarray:
        """Natural log probability of the target classes (batch, STEP); tables: of tables()."""
        q, k, v, first, then, bias = tables
        s = np.take(k, x, axis=0) @ np.ascontiguousarray(np.take(q, x[:, OVERLAP:], axis=0).transpose(0, 2, 1))
        s += bias
        if len(cut := np.unique(np.flatnonzero(~valid) // SPAN)):
            s[cut] += np.where(valid[cut], F32(0), F32(-1e9))[:, :, None]
        np.exp(s, out=s)
        s *= 1 / (np.ones((1, SPAN), F32) @ s)
        h = s.transpose(0, 2, 1) @ np.take(v, x, axis=0)
        order, group, place, cuts = self._by_group(target)
        h, unit, rows = np.take(h.reshape(-1, DIM), order, axis=0), np.take(x[:, OVERLAP:].ravel(), order), np.arange(len(order))
        z = h @ self.p["G"].T
        z += np.take(first, unit, axis=0)
        told = np.take(z, rows * self.groups + group)
        told -= np.log(np.exp(z, out=z) @ np.ones(self.groups, F32))
        z = self._logits(h, unit, group, cuts, then)
        told += np.take(z, rows * self.size + place)
        told -= np.log(np.exp(z, out=z) @ np.ones(self.size, F32))
        out = np.empty_like(told)
        out[order] = told
        return out.reshape(target.shape)

    def gradients(self, x: np.ndarray, valid: np.ndarray, target: np.ndarray, scored: np.ndarray) -> tuple[float, dict]:
        """Mean loss of the scored places and its gradients.  All that depends on one unit only is made once a unit; what
        flows back to embeddings is one row a place, summed by unit at the end.  Attention is kept as (window, key, query);
        rows are in order of groups from the state to its gradient."""
        p, near = self.p, DIM**-0.5
        e, own = p["E"], x[:, OVERLAP:]
        left, right = e @ (p["Wq"] * F32(near)), e @ np.concatenate([p["Wk"], p["Wv"]], axis=1)
        q, both = np.take(left, own, axis=0), np.take(right, x, axis=0)
        k, v = both[..., :DIM], both[..., DIM:]
        a = k @ np.ascontiguousarray(q.transpose(0, 2, 1))
        a += np.where(_CAUSAL, p["R"][_FAR], F32(-1e9))
        if len(cut := np.unique(np.flatnonzero(~valid) // SPAN)):
            a[cut] += np.where(valid[cut], F32(0), F32(-1e9))[:, :, None]
        largest = [np.einsum("ij,ij->i", m, m).max() for m in (left, right[:, :DIM])]
        if not largest[0] * largest[1] < max(0.0, 60 - p["R"].max()) ** 2:
            np.minimum(a, F32(60), out=a)  # exp stays finite
        np.exp(a, out=a)
        a *= 1 / (np.ones((1, SPAN), a.dtype) @ a)
        o = (a.transpose(0, 2, 1) @ v).reshape(-1, DIM)
        order, group, place, cuts = self._by_group(target)
        unit, hit, count = np.take(own.ravel(), order), np.take(scored.ravel(), order), max(1, int(scored.sum()))
        h = np.take(o @ p["Wo"], order, axis=0)
        h += np.take(e @ p["Wr"], unit, axis=0)
        at, unreal = np.arange(len(h)), np.flatnonzero(~hit)

        def part(z, told_at):
            told_at = at * z.shape[1] + told_at
            told = np.take(z, told_at)
            np.exp(z, out=z)
            total = z @ np.ones(z.shape[1], z.dtype)
            z *= (1 / (count * total))[:, None]
            told -= np.log(total)
            z.reshape(-1)[told_at] = np.expm1(told) / z.dtype.type(count)
            z[unreal], told[unreal] = 0, 0
            return float(told.sum()), z

        z = h @ p["G"].T
        z += np.take(self.first, unit, axis=0)
        log, dz = part(z, group)
        g = {"G": _tall(h, dz).T}
        dh = dz @ p["G"]
        more, dz = part(self._logits(h, unit, group, cuts, self.by_group), place)
        to, each, back = np.zeros((self.groups, DIM, self.size), h.dtype), p["U"].reshape(self.groups, self.size, -1), np.empty_like(dh)
        for i, rows in cuts:
            its = dz[rows]
            np.matmul(h[rows].T, its, out=to[i])
            np.matmul(its, each[i], out=back[rows])
        dh += back
        g["U"] = to.transpose(0, 2, 1).reshape(-1, DIM)
        again = np.empty_like(order)
        again[order] = at
        dh = np.take(dh, again, axis=0)
        g["Wo"] = _tall(o, dh)
        do, over = (dh @ p["Wo"].T).reshape(q.shape), (p["Wo"] @ dh.T).reshape(DIM, -1, STEP).transpose(1, 0, 2)
        da = v @ over
        front, back = np.empty((*own.shape, 2 * DIM), a.dtype), np.empty(both.shape, a.dtype)
        np.matmul(a, do, out=back[..., DIM:])
        da *= a
        a *= np.ones((1, SPAN), a.dtype) @ da
        da -= a
        np.matmul(da, q, out=back[..., :DIM])
        np.matmul(da.transpose(0, 2, 1), k, out=front[..., :DIM])
        front[..., DIM:] = dh.reshape(q.shape)
        g["R"] = np.bincount(_FAR[_CAUSAL], weights=da.sum(0)[_CAUSAL], minlength=SPAN).astype(F32)
        front, back, its = front.reshape(-1, 2 * DIM), back.reshape(-1, 2 * DIM), np.take(e, x, axis=0)
        dq, g["Wr"] = np.split(_tall(its[:, OVERLAP:].reshape(-1, DIM), front), 2, axis=1)
        g["Wq"], (g["Wk"], g["Wv"]) = dq * F32(near), np.split(_tall(its.reshape(-1, DIM), back), 2, axis=1)
        de = (back @ np.concatenate([p["Wk"], p["Wv"]], axis=1).T).reshape(its.shape)
        de[:, OVERLAP:] += (front @ np.concatenate([p["Wq"] * F32(near), p["Wr"]], axis=1).T).reshape(q.shape)
        g["E"] = _summed(x, de, len(e))
        return -(log + more) / count, g

    def fit(self, batches, rate: float = 0.005, decay: float = 0.002) -> list[float]:
        """One step of Adam per batch (x, valid, target, scored); the losses.  The parameters lie end to end in one array."""
        names, sizes = list(self.p), [v.size for v in self.p.values()]
        flat, cuts = np.concatenate([v.ravel() for v in self.p.values()]), np.cumsum([0, *sizes])
        self.p = {k: flat[a:b].reshape(self.p[k].shape) for k, a, b in zip(names, cuts[:-1], cuts[1:], strict=True)}
        first, second = np.zeros_like(flat), np.zeros_like(flat)
        losses = []
        for t, batch in enumerate(batches, 1):
            loss, g = self.gradients(*batch)
            losses.append(loss)
            g = np.concatenate([g[k].ravel() for k in names])
            first *= F32(0.9)
            first += F32(0.1) * g
            second *= F32(0.99)
            g *= g
            g *= F32(0.01)
            second += g
            np.divide(second, F32(1 - 0.99**t), out=g)
            np.sqrt(g, out=g)
            g += F32(1e-7)
            np.divide(first, g, out=g)
            g *= F32(rate / (1 + decay * t) / (1 - 0.9**t))
            flat -= g
        return losses


def _tall(a: np.ndarray, b: np.ndarray, rows: int = 256) -> np.ndarray:
    """a.T @ b of many rows and few columns, summed over blocks of rows: a third of the time of one product."""
    n = len(a) // rows * rows
    out = a[n:].T @ b[n:]
    if n:
        out += (a[:n].reshape(-1, rows, a.shape[1]).transpose(0, 2, 1) @ b[:n].reshape(-1, rows, b.shape[1])).sum(0)
    return out


def _summed(units: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by unit (n units), sorted by radix; two neighbouring columns are added as one complex number."""
    units = units.ravel().astype(np.uint16)
    order = np.argsort(units, kind="stable")
    units = np.take(units, order)
    first = np.flatnonzero(np.concatenate([[True], units[1:] != units[:-1]]))
    out = np.zeros((n, rows.shape[-1]), rows.dtype)
    rows = np.take(rows.reshape(-1, rows.shape[-1]), order, axis=0)
    if rows.shape[1] % 2 == 0:
        rows = rows.view(np.result_type(rows.dtype, np.complex64))
    out[units[first]] = np.add.reduceat(rows, first, axis=0).view(out.dtype)
    return out


def windows(x: np.ndarray, target: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(units, valid, targets, places) of the overlapping windows of documents laid end to end in x and
    target with bounds: every place is scored in one window, with OVERLAP units or more before it where there
    are; places (batch, STEP) are positions in target, -1 past a document's end."""
    n = np.diff(bounds)
    blocks = -(-n // STEP)
    first = np.repeat(bounds[:-1], blocks)
    end = np.repeat(bounds[1:], blocks)
    start = first + (np.arange(len(first)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * STEP
    at = start[:, None] - OVERLAP + np.arange(SPAN)[None, :]
    valid = (at >= first[:, None]) & (at < end[:, None])
    at = np.where(valid, at, first[:, None])
    places = np.where(valid[:, OVERLAP:], at[:, OVERLAP:], -1)
    return x[at], valid, target[np.maximum(places, 0)], places
