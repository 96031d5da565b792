"""A small causal self-attention model over subword ids, trained and applied in numpy.

Output is in two steps: a class, which attention predicts, and the id in its class by its share in the
corpus. The most frequent ids are classes of their own; the rest is cut into classes of about equal
weight. Texts are scored in overlapping windows; a token is scored once, where it is in the last part
of a window, and the first part is context.
"""

from __future__ import annotations

import copy
from dataclasses import dataclass

import numpy as np


#: Windows whose numbers are worked on together, so that they stay in a core's cache.
PIECE = 64


@dataclass(frozen=True)
class Shape:
    """Sizes of the model and its fit."""

    own_classes: int = 80  # ids that are classes of their own
    shared_classes: int = 16  # classes for the rest
    own_inputs: int = 2047  # ids with an embedding of their own; the others have one together
    dims: int = 12
    window: int = 24
    step: int = 16  # places scored in a window, its last
    batch: int = 256  # windows
    updates: int = 1500
    rate: float = 0.01
    refine_rate: float = 0.002  # in passes over all training texts
    seed: int = 8


@dataclass
class Vocabulary:
    """What the counts of ids over the corpus say."""

    class_of: np.ndarray  # class of an id
    log_share: np.ndarray  # log of the share of an id in its class
    input_of: np.ndarray  # row of an id in the embeddings
    prior: np.ndarray  # log of the share of each class


def vocabulary(counts: np.ndarray, shape: Shape) -> Vocabulary:
    """Every id gets half a count more than it has, so that none is impossible."""
    mass = counts + 0.5
    order = np.argsort(-mass, kind="stable")
    class_of = np.zeros(len(mass), dtype=np.int32)
    own = min(shape.own_classes, len(mass))
    class_of[order[:own]] = np.arange(own)
    rest = order[own:]
    if len(rest):
        before = np.cumsum(mass[rest]) - mass[rest]
        class_of[rest] = own + np.minimum(before / mass[rest].sum() * shape.shared_classes, shape.shared_classes - 1).astype(np.int32)
    total = np.bincount(class_of, weights=mass, minlength=shape.own_classes + shape.shared_classes)
    input_of = np.full(len(mass), shape.own_inputs, dtype=np.int32)
    input_of[order[: shape.own_inputs]] = np.arange(min(shape.own_inputs, len(mass)))
    share = np.log(mass) - np.log(total[class_of])
    prior = np.log(np.maximum(total, 1e-9) / total.sum()).astype(np.float32)
    return Vocabulary(class_of, share.astype(np.float32), input_of, prior)


def windows(lengths: np.ndarray, shape: Shape) -> np.ndarray:
    """Places of all windows over texts that lie one behind the other, -1 outside of the text.

    ``lengths`` are numbers of inputs. The last ``step`` places of the windows of a text are all its places.
    """
    count = -(-lengths // shape.step)
    text = np.repeat(np.arange(len(lengths)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    inside = number[:, None] * shape.step + np.arange(shape.step - shape.window, shape.step)
    begin = (np.cumsum(lengths) - lengths)[text][:, None]
    return np.where((inside >= 0) & (inside < lengths[text][:, None]), begin + inside, -1)


class Attention:
    #: Exponents are cut here instead of being shifted by their maximum.
    MOST = np.float32(60)

    def __init__(self, shape: Shape, prior: np.ndarray):
        random = np.random.default_rng(shape.seed)
        d = shape.dims
        draw = lambda *size: (random.standard_normal(size) / np.sqrt(d)).astype(np.float32)
        self.shape = shape
        self.p = {
            "embed": draw(shape.own_inputs + 1, d), "place": draw(shape.window, d) * 0.3,
            "q": draw(d, d) / np.float32(np.sqrt(d)), "k": draw(d, d), "v": draw(d, d), "o": draw(d, d) * 0.3,
            "out": draw(d, len(prior)) * 0.3, "bias": prior.copy(),
        }
        self.sees = np.tri(shape.window, dtype=np.float32)[-shape.step :]

    def hidden(self, inputs: np.ndarray, exists: np.ndarray):
        """Vectors behind the last ``step`` inputs of each window, and what the fit needs of the way."""
        p, d, step = self.p, self.shape.dims, self.shape.step
        x = p["embed"].take(inputs, axis=0)
        x += p["place"]
        flat = x.reshape(-1, d)
        k, v = ((flat @ p[n]).reshape(x.shape) for n in "kv")
        last = np.ascontiguousarray(x[:, -step:])
        q = (last.reshape(-1, d) @ p["q"]).reshape(last.shape)
        a = q @ k.transpose(0, 2, 1)
        self._capped(a)
        np.exp(a, out=a)
        a *= self.sees
        a *= exists.astype(np.float32)[:, None, :]
        a *= 1 / (a @ np.ones((a.shape[2], 1), dtype=a.dtype) + np.float32(1e-30))
        c = a @ v
        return last + (c.reshape(-1, d) @ p["o"]).reshape(c.shape), (x, last, q, k, v, a, c)

    def _capped(self, exponents: np.ndarray) -> None:
        if exponents.max(initial=0) > self.MOST:
            np.minimum(exponents, self.MOST, out=exponents)

    def _exponents(self, hidden: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight of each class behind each vector, not shared out to 1; the vectors with a 1 for the bias."""
        more = np.ones((len(hidden), hidden.shape[1] + 1), dtype=hidden.dtype)
        more[:, :-1] = hidden
        z = more @ np.vstack([self.p["out"], self.p["bias"]])
        self._capped(z)
        return np.exp(z, out=z), more

    def class_logs(self, hidden: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Log probability of each class behind each vector."""
        e, _ = self._exponents(hidden)
        chosen = np.einsum("ij,ij->i", hidden, self.p["out"].T[classes]) + self.p["bias"][classes]
        return np.minimum(chosen, self.MOST) - np.log(e @ np.ones(e.shape[1], dtype=e.dtype))

    def gradients(self, inputs: np.ndarray, exists: np.ndarray, targets: np.ndarray, use: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss in nats over the used places, and its gradients, summed up over pieces of ``PIECE`` windows."""
        n = max(int(use.sum()), 1)
        loss, g, dx = 0.0, {}, np.empty((*inputs.shape, self.shape.dims), dtype=np.float32)
        for at in range(0, len(inputs), PIECE):
            piece = slice(at, at + PIECE)
            own_loss, own = self._piece(inputs[piece], exists[piece], targets[piece].reshape(-1), use[piece].reshape(-1), n, dx[piece])
            loss += own_loss
            g = {name: g[name] + part for name, part in own.items()} if g else own
        g["place"] = dx.sum(axis=0)
        rows_in = inputs.reshape(-1).astype(np.uint16 if self.shape.own_inputs < 1 << 16 else np.int64)  # short numbers sort faster
        order = np.argsort(rows_in, kind="stable")
        sorted_rows = rows_in[order]
        begin = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]]))
        embed = np.zeros_like(self.p["embed"])
        embed[sorted_rows[begin]] = np.add.reduceat(dx.reshape(-1, self.shape.dims)[order], begin)
        g["embed"] = embed
        return float(loss), g

    def _piece(self, inputs: np.ndarray, exists: np.ndarray, targets: np.ndarray, use: np.ndarray, n: int, dx: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients of some windows, those of the inputs' vectors in ``dx``."""
        p, d, step = self.p, self.shape.dims, self.shape.step
        h, (x, last, q, k, v, a, c) = self.hidden(inputs, exists)
        flat = lambda y: y.reshape(-1, d)
        e, more = self._exponents(flat(h))
        total = e @ np.ones(e.shape[1], dtype=e.dtype)
        rows = np.flatnonzero(use)
        hit = targets[rows]
        loss = -np.log(np.maximum(e[rows, hit] / total[rows], 1e-12)).sum() / n
        e[rows, hit] -= total[rows]
        # Shares and means by way of the vectors, which are shorter than the rows of classes.
        weight = (use / (n * total)).astype(np.float32)[:, None]
        out = (more * weight).T @ e
        g = {"out": out[:-1], "bias": out[-1]}
        dh = e @ p["out"].T
        dh *= weight
        g["o"] = flat(c).T @ dh
        dc = (dh @ p["o"].T).reshape(c.shape)
        dv = a.transpose(0, 2, 1) @ dc
        ds = dc @ v.transpose(0, 2, 1)
        ds -= np.einsum("bij,bij->bi", ds, a)[:, :, None]
        ds *= a
        dq, dk = ds @ k, ds.transpose(0, 2, 1) @ q
        np.add((flat(dk) @ p["k"].T).reshape(dx.shape), (flat(dv) @ p["v"].T).reshape(dx.shape), out=dx)
        dh += flat(dq) @ p["q"].T
        dx[:, -step:] += dh.reshape(h.shape)
        g["q"] = flat(last).T @ flat(dq)
        for name, part in (("k", dk), ("v", dv)):
            g[name] = flat(x).T @ flat(part)
        return loss, g

    def fit(self, inputs: np.ndarray, targets: np.ndarray, places: np.ndarray) -> list[float]:
        """Adam over random batches of windows, the pace falling to zero."""
        shape = self.shape
        random = np.random.default_rng(shape.seed)
        adam = Adam(self.p)
        losses = []
        for t in range(shape.updates):
            place = places[random.integers(0, len(places), min(shape.batch, len(places)))]
            losses.append(self.update(adam, inputs, targets, place, shape.rate * (1 - t / shape.updates)))
        return losses

    def update(self, adam: Adam, inputs: np.ndarray, targets: np.ndarray, place: np.ndarray, rate: float) -> float:
        """One step of Adam on a batch of windows; the loss before it."""
        at, scored = np.maximum(place, 0), place[:, -self.shape.step :]
        loss, g = self.gradients(inputs[at], place >= 0, targets[at[:, -self.shape.step :]], scored >= 0)
        adam.step(self.p, g, rate)
        return loss


class Adam:
    def __init__(self, p: dict[str, np.ndarray]):
        self.first = {n: np.zeros_like(x) for n, x in p.items()}
        self.second = {n: np.zeros_like(x) for n, x in p.items()}
        self.steps = 0

    def step(self, p: dict[str, np.ndarray], g: dict[str, np.ndarray], rate: float) -> None:
        self.steps += 1
        t = self.steps
        for n in p:
            self.first[n] += 0.1 * (g[n] - self.first[n])
            self.second[n] += 0.01 * (g[n] ** 2 - self.second[n])
            p[n] -= (rate * (self.first[n] / (1 - 0.9**t)) / (np.sqrt(self.second[n] / (1 - 0.99**t)) + 1e-6)).astype(np.float32)


def sequences(texts: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs and targets of all texts, one behind the other, and the inputs of each.

    A text begins after an end, and its own end is its last target.
    """
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    stop = np.array([end], dtype=np.int64)
    inputs = np.concatenate([x for t in texts for x in (stop, t)]) if texts else stop[:0]
    targets = np.concatenate([x for t in texts for x in (t, stop)]) if texts else stop[:0]
    return inputs.astype(np.int64), targets.astype(np.int64), lengths


@dataclass
class Scorer:
    words: Vocabulary
    model: Attention
    end: int

    def scores(self, texts: list[np.ndarray], together: int = PIECE) -> np.ndarray:
        """log10 probability of each text, its end included."""
        inputs, targets, lengths = sequences(texts, self.end)
        places, step = windows(lengths, self.model.shape), self.model.shape.step
        rows = self.words.input_of[inputs]
        classes = self.words.class_of[targets]
        logs = self.words.log_share[targets].astype(np.float64)
        for at in range(0, len(places), together):
            place = places[at : at + together]
            hidden, _ = self.model.hidden(rows[np.maximum(place, 0)], place >= 0)
            mine = place[:, -step:]
            use = mine >= 0
            mine = mine[use]
            logs[mine] += self.model.class_logs(hidden[use], classes[mine])
        return np.add.reduceat(logs, np.cumsum(lengths) - lengths) / np.log(10) if len(texts) else np.zeros(0)


class Pass:
    """A model's copy that goes once over all windows of the texts it is shown; many are averaged."""

    def __init__(self, scorer: Scorer):
        self.scorer, self.model = scorer, copy.deepcopy(scorer.model)
        self.adam = Adam(self.model.p)
        self.random = np.random.default_rng(self.model.shape.seed)
        self.windows = 0
        self.met = np.zeros(len(self.model.p["embed"]))

    def learn(self, texts: list[np.ndarray]) -> None:
        inputs, targets, lengths = sequences(texts, self.scorer.end)
        rows, classes = self.scorer.words.input_of[inputs], self.scorer.words.class_of[targets]
        shape = self.model.shape
        places = self.random.permutation(windows(lengths, shape))
        for at in range(0, len(places), shape.batch):
            self.model.update(self.adam, rows, classes, places[at : at + shape.batch], shape.refine_rate)
        self.windows += len(places)
        self.met += np.bincount(rows, minlength=len(self.met))

    def weighted(self) -> np.ndarray:
        """Weights and weighted parameters; sums of these over passes make an average.

        A row of the embeddings has as much weight as the pass met it, all else as it had windows.
        """
        p = self.model.p
        rest = [p[n].ravel() * float(self.windows) for n in p if n != "embed"]
        return np.concatenate([[self.windows], self.met, (p["embed"] * self.met[:, None]).ravel(), *rest]).astype(np.float64)


def averaged(scorer: Scorer, total: np.ndarray) -> Scorer:
    """The scorer with the average of passes, from the sum of their ``weighted``; what none met stays."""
    model = copy.deepcopy(scorer.model)
    if not total[0]:
        return scorer
    embed = model.p["embed"]
    met, at = total[1 : 1 + len(embed)], 1 + len(embed)
    sums = total[at : at + embed.size].reshape(embed.shape)
    model.p["embed"] = np.where(met[:, None] > 0, sums / np.maximum(met, 1)[:, None], embed).astype(np.float32)
    at += embed.size
    for n in [n for n in model.p if n != "embed"]:
        size = model.p[n].size
        model.p[n] = (total[at : at + size] / total[0]).reshape(model.p[n].shape).astype(np.float32)
        at += size
    return Scorer(scorer.words, model, scorer.end)


def train_scorer(texts: list[np.ndarray], counts: np.ndarray, end: int, shape: Shape | None = None) -> Scorer:
    shape = shape or Shape()
    words = vocabulary(counts, shape)
    model = Attention(shape, words.prior)
    if texts:
        inputs, targets, lengths = sequences(texts, end)
        model.fit(words.input_of[inputs], words.class_of[targets], windows(lengths, shape))
    return Scorer(words, model, end)
