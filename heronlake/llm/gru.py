"""A small gated recurrent network over tokens with a softmax in two steps, in numpy."""

from __future__ import annotations

import heapq

import numpy as np

# Size of the state, most streams side by side, steps that gradients go
# back, words of a class, fewest streams, and steps aimed at where tokens are few.
HIDDEN, STREAMS, WINDOW, SIZE, LEAST, STEPS = 16, 512, 64, 64, 8, 100


class Layout:
    """Tokens as symbols: ``words`` words in classes of ``SIZE``, then ``others`` symbols that are classes of their own."""

    def __init__(self, words: int, others: int):
        self.words, self.others = words, others
        self.groups = -(-words // SIZE)
        self.symbols, self.classes = words + others, self.groups + others
        self.class_of = np.concatenate([np.arange(words) // SIZE, self.groups + np.arange(others)]).astype(np.int16)
        self.shapes = {
            "inp": (self.symbols, 3 * HIDDEN), "rec": (HIDDEN, 3 * HIDDEN), "bias": (3 * HIDDEN,),
            "out": (HIDDEN, self.classes), "prior": (self.classes,), "word": (self.groups, HIDDEN, SIZE), "word_prior": (self.groups, SIZE),
        }

    def unpack(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.shapes.items():
            size = int(np.prod(shape))
            out[name] = flat[at:at + size].reshape(shape)
            at += size
        return out

    def start(self, counts: np.ndarray, seed: int = 7) -> np.ndarray:
        """First parameters as one vector: classes and words have their own shares whatever the state is."""
        rng, flat = np.random.default_rng(seed), np.zeros(sum(int(np.prod(s)) for s in self.shapes.values()), dtype=np.float32)
        p, mass = self.unpack(flat), np.maximum(counts.astype(float), 0.1)
        p["inp"][:] = rng.normal(0, 0.1, p["inp"].shape)
        p["rec"][:] = rng.normal(0, 0.1, p["rec"].shape)
        per = np.bincount(self.class_of, weights=mass, minlength=self.classes)
        p["prior"][:] = np.log(per / per.sum())
        # places that no word has are out of reach
        p["word_prior"][:] = -1e4
        p["word_prior"].reshape(-1)[:self.words] = np.log(mass[:self.words] / per[self.class_of[:self.words]])
        return flat


def streams(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents side by side: targets, documents and lengths of up to ``STREAMS`` streams.

    Each document goes whole into the shortest stream; streams are ordered by
    length, longest first, so those that still run are always the first ones.
    Beside a very long document there are fewer streams, so the arrays hold
    at most twice the tokens; with few tokens there are fewer, so that training
    takes about ``STEPS`` steps.
    """
    order = sorted(range(len(docs)), key=lambda i: (-len(docs[i]), i))
    tokens = sum(map(len, docs))
    width = min(2 * tokens // len(docs[order[0]]), max(LEAST, tokens // (WINDOW * STEPS)))
    heap = [(0, s, []) for s in range(min(STREAMS, len(docs), width))]
    for i in order:
        size, s, own = heap[0]
        own.append(i)
        heapq.heapreplace(heap, (size + len(docs[i]), s, own))
    heap.sort(key=lambda x: (-x[0], x[1]))
    lengths = np.array([size for size, _, _ in heap])
    steps = int(lengths.max())
    target = np.zeros((steps, len(heap)), dtype=np.int16)
    doc = np.full((steps, len(heap)), -1, dtype=np.int32)
    for s, (size, _, own) in enumerate(heap):
        if size:
            target[:size, s] = np.concatenate([docs[i] for i in own])
            doc[:size, s] = np.repeat(own, [len(docs[i]) for i in own])
    return target, doc, lengths


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place; an exponential beyond the range is infinite, and its share zero."""
    np.exp(np.negative(x, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


def runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts small integers, where each run of one value starts, and these values."""
    order = np.argsort(values, kind="stable")
    own = values[order]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, dtype=np.int64)
    return order, first, own[first]


class Model:
    def __init__(self, flat: np.ndarray, layout: Layout):
        self.flat, self.layout = flat.astype(np.float32).copy(), layout
        self.p = layout.unpack(self.flat)

    @staticmethod
    def gates(table: np.ndarray) -> np.ndarray:
        """Columns of the three gates as three tables."""
        return table.reshape(len(table), 3, HIDDEN).transpose(1, 0, 2).copy()

    def forward(self, h: np.ndarray, inputs: np.ndarray, fresh: np.ndarray, keep: bool = True):
        """States along a window; the state is zero where a document starts."""
        p, size = self.p, (len(inputs), *h.shape)
        # one table per gate, so that every step works on whole blocks of memory
        given = np.stack([own[inputs] for own in self.gates(p["inp"] + p["bias"])])
        rec = self.gates(p["rec"])
        starts, lives = fresh.any(axis=1), (~fresh).astype(np.float32)[:, :, None]
        states = np.empty(size, dtype=np.float32)
        kept = [np.empty(size, dtype=np.float32) for _ in range(5)] if keep else None
        with np.errstate(over="ignore"):
            for t in range(len(inputs)):
                if starts[t]:
                    h = h * lives[t]
                r = np.matmul(h, rec)
                r[:2] += given[:2, t]
                z, g = sigmoid(r[:2])
                new = g * r[2]
                new += given[2, t]
                np.tanh(new, out=new)
                if keep:
                    for all_steps, now in zip(kept, (h, z, g, new, r[2])):
                        all_steps[t] = now
                h = np.subtract(h, new, out=states[t])
                h *= z
                h += new
        return states, kept, h

    def weights(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class weights of each state and their sum.  States lie in -1..1 and the
        gradient is clipped, so the exponents stay far from overflow."""
        logits = states @ self.p["out"]
        logits += self.p["prior"]
        weight = np.exp(logits, out=logits)
        return weight, weight.sum(axis=1)

    def word_groups(self, targets: np.ndarray):
        """Per class of words that occurs: the class, the places of its tokens, and the words' places in it."""
        words = np.flatnonzero(targets < self.layout.words)
        order, first, values = runs_of(self.layout.class_of[targets[words]])
        for c, low, high in zip(values, first, [*first[1:], len(order)]):
            at = words[order[low:high]]
            yield int(c), at, targets[at] - c * SIZE

    def word_weights(self, c: int, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        logits = states @ self.p["word"][c]
        logits += self.p["word_prior"][c]
        weight = np.exp(logits, out=logits)
        return weight, weight.sum(axis=1)

    def log_shares(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log of each target's share: its class's, and the word's within the class."""
        flat, own = states.reshape(-1, HIDDEN), targets.ravel()
        weight, whole = self.weights(flat)
        total = np.log(weight[np.arange(len(own)), self.layout.class_of[own]] / whole)
        for c, at, place in self.word_groups(own):
            weight, whole = self.word_weights(c, flat[at])
            total[at] += np.log(weight[np.arange(len(at)), place] / whole)
        return total.reshape(targets.shape).astype(np.float64)

    def gradient(self, inputs, targets, fresh, live, states, kept) -> np.ndarray:
        """Of the mean loss over the window's tokens, back to its first step."""
        flat = np.zeros_like(self.flat)
        d, p, own = self.layout.unpack(flat), self.p, targets.ravel()
        seen = states.reshape(-1, HIDDEN)
        share, whole = self.weights(seen)
        part = (live.ravel() / max(1, live.sum())).astype(np.float32)
        share *= (part / whole)[:, None]
        share[np.arange(len(share)), self.layout.class_of[own]] -= part
        d["out"] += seen.T @ share
        d["prior"] += share.sum(axis=0)
        back = share @ p["out"].T
        for c, at, place in self.word_groups(own):
            mine = seen[at]
            share, whole = self.word_weights(c, mine)
            share *= (part[at] / whole)[:, None]
            share[np.arange(len(at)), place] -= part[at]
            d["word"][c] += mine.T @ share
            d["word_prior"][c] += share.sum(axis=0)
            back[at] += share @ p["word"][c].T
        back = back.reshape(states.shape)
        later = np.zeros_like(states[0])
        # all factors that do not depend on later steps, for the whole window
        h, z, g, new, r = kept
        shut = 1 - z
        by_new, by_z, by_g = shut * (1 - new * new), (h - new) * z * shut, r * g * (1 - g)
        lives = (~fresh).astype(np.float32)[:, :, None]
        into, d_new, back_rec = np.empty((3, *states.shape), dtype=np.float32), np.empty_like(states), self.gates(p["rec"]).transpose(0, 2, 1).copy()
        for t in range(len(inputs) - 1, -1, -1):
            grad = back[t]
            grad += later
            np.multiply(grad, by_new[t], out=d_new[t])
            np.multiply(grad, by_z[t], out=into[0, t])
            np.multiply(d_new[t], by_g[t], out=into[1, t])
            np.multiply(d_new[t], g[t], out=into[2, t])
            later = np.matmul(into[:, t], back_rec).sum(axis=0)
            grad *= z[t]
            later += grad
            later *= lives[t]
        into = into.reshape(3, -1, HIDDEN)
        before = h.reshape(-1, HIDDEN).T
        order, first, values = runs_of(inputs.ravel())
        for k, own in enumerate((into[0], into[1], d_new.reshape(-1, HIDDEN))):
            at = slice(k * HIDDEN, (k + 1) * HIDDEN)
            d["rec"][:, at] += before @ into[k]
            d["bias"][at] += own.sum(axis=0)
            d["inp"][values, at] += np.add.reduceat(own[order], first)
        return flat


def windows(docs: list[np.ndarray], end: int):
    """Windows over the streams: inputs, targets, starts, documents and running mask.

    The input is the token before the target, or the end token at the start of
    a document.
    """
    target, doc, lengths = streams(docs)
    for at in range(0, len(target), WINDOW):
        width = int((lengths > at).sum())
        y, own = target[at:at + WINDOW, :width], doc[at:at + WINDOW, :width]
        if at:
            before, other = target[at - 1:at, :width], doc[at - 1:at, :width]
        else:
            before, other = np.zeros((1, width), dtype=np.int16), np.full((1, width), -2, dtype=np.int32)
        fresh = np.concatenate([other, own[:-1]]) != own
        x = np.where(fresh, end, np.concatenate([before, y[:-1]])).astype(np.int16)
        yield x, y, fresh, own, own >= 0


def train(flat: np.ndarray, layout: Layout, docs: list[np.ndarray], moments: dict | None = None, rate: float = 0.02) -> tuple[np.ndarray, dict]:
    """One pass of truncated backpropagation over whole documents, all windows.

    A step is as long as its window has live tokens, so the last windows,
    where few long documents still run, do not pull the model to them; and
    steps get shorter with their number.
    """
    model = Model(flat, layout)
    moments = moments or {"m": np.zeros_like(model.flat), "v": np.zeros_like(model.flat), "t": 0}
    h, most = None, 1
    for x, y, fresh, _, live in windows(docs, layout.symbols - 1) if docs else ():
        h = np.zeros((x.shape[1], HIDDEN), dtype=np.float32) if h is None else h[:x.shape[1]]
        states, kept, h = model.forward(h, x, fresh)
        grad = model.gradient(x, y, fresh, live, states, kept)
        grad *= min(1.0, 1.0 / (float(np.sqrt((grad * grad).sum())) + 1e-9))
        moments["t"] += 1
        t, alive = moments["t"], int(live.sum())
        most = max(most, alive)
        moments["m"] += (grad - moments["m"]) * np.float32(0.1)
        moments["v"] += (grad * grad - moments["v"]) * np.float32(0.01)
        step = moments["m"] / (1 - 0.9**t) / (np.sqrt(moments["v"] / (1 - 0.99**t)) + 1e-6)
        model.flat -= (rate * alive / most / np.sqrt(1 + t / 100) * step).astype(np.float32)
    return model.flat, moments


def score(flat: np.ndarray, layout: Layout, docs: list[np.ndarray]) -> np.ndarray:
    """log10 probability of the symbols of each whole document, the state carried along."""
    model, total, h = Model(flat, layout), np.zeros(len(docs)), None
    for x, y, fresh, own, live in windows(docs, layout.symbols - 1) if docs else ():
        h = np.zeros((x.shape[1], HIDDEN), dtype=np.float32) if h is None else h[:x.shape[1]]
        states, _, h = model.forward(h, x, fresh, keep=False)
        share = model.log_shares(states, y)
        total += np.bincount(own[live], weights=share[live], minlength=len(docs))
    return total / np.log(10)
