"""A bidirectional gated recurrent network with attention pooling, in numpy.

Inputs are words.  A word's vector joins an embedding of the word itself and
the mean of the embeddings of its character n-grams, both found by hashing, so
unseen words have vectors too.  ``Words`` keeps, for the distinct words of a
task, the vector already multiplied by the input weights of both directions;
``Network`` runs the recurrences over windows of word numbers, pools the
states by learned attention and returns a logit per window.  ``Network.learn``
is backpropagation through time with Adam.
"""

from __future__ import annotations

import numpy as np

WORD_BUCKETS, GRAM_BUCKETS = 1 << 15, 1 << 15
WORD_SIZE, GRAM_SIZE, HIDDEN, ATTENTION = 8, 16, 10, 10
GRAMS = (2, 3, 4)
MIX = np.uint64(0x9E3779B97F4A7C15)


def hashed(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word buckets, gram buckets, number of grams per word) of non-empty
    words; grams run over the word between two border marks."""
    joined = "".join(f"\x02{w}\x03" for w in words)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    starts = ends - sizes
    word_at = np.repeat(np.arange(len(words)), sizes)
    offset = np.arange(len(points)) - starts[word_at]
    left = ends[word_at] - np.arange(len(points))
    with np.errstate(over="ignore"):
        spread = (points + np.uint64(1)) * MIX
        spread ^= spread >> np.uint64(29)
        powers = (offset.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * MIX
        whole = np.add.reduceat(spread * powers, starts) if len(words) else np.zeros(0, np.uint64)
        whole = ((whole ^ (whole >> np.uint64(32))) * MIX) >> np.uint64(40)
        owners, grams = [], []
        code = np.zeros(len(points), np.uint64)
        for n in range(1, max(GRAMS) + 1):
            ahead = np.zeros(len(points), np.uint64)
            ahead[:len(points) - n + 1] = spread[n - 1:]
            code = (code ^ ahead) * MIX
            code ^= code >> np.uint64(31)
            if n in GRAMS:
                inside = left >= n
                owners.append(word_at[inside])
                grams.append((code[inside] >> np.uint64(20)) % np.uint64(GRAM_BUCKETS))
    owner, gram = np.concatenate(owners), np.concatenate(grams).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return ((whole % np.uint64(WORD_BUCKETS)).astype(np.int64), gram[order],
            np.bincount(owner, minlength=len(words)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Weights, forward pass and learning."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        size, h = WORD_SIZE + GRAM_SIZE, HIDDEN
        self.weights = {
            "word": normal(WORD_BUCKETS, WORD_SIZE, scale=0.1), "gram": normal(GRAM_BUCKETS, GRAM_SIZE, scale=0.2),
            "inputs": normal(size, 6 * h, scale=size ** -0.5), "bias": np.zeros(6 * h, np.float32),
            "forward": normal(h, 3 * h, scale=h ** -0.5), "backward": normal(h, 3 * h, scale=h ** -0.5),
            "attend": normal(2 * h, ATTENTION, scale=(2 * h) ** -0.5), "attend_bias": np.zeros(ATTENTION, np.float32),
            "attention": normal(ATTENTION, scale=0.3),
            "out": normal(2 * h, scale=0.3), "out_bias": np.zeros(1, np.float32)}
        self.step, self.moments, self.known = 0, {}, {}

    def restrict(self, word: np.ndarray, gram: np.ndarray) -> None:
        """Embeddings outside these buckets are zero and stay so: what occurs
        in few training texts could only be learned by heart."""
        for name, buckets in (("word", word), ("gram", gram)):
            mask = np.zeros((len(self.weights[name]), 1), np.float32)
            mask[buckets] = 1
            self.known[name] = mask
            self.weights[name] *= mask

    def copy(self) -> Network:
        """The weights alone, for scoring."""
        out = Network.__new__(Network)
        out.weights = {name: w.copy() for name, w in self.weights.items()}
        out.step, out.moments, out.known = self.step, {}, {}
        return out

    # --- inputs ---------------------------------------------------------

    def vectors(self, word: np.ndarray, gram: np.ndarray, counts: np.ndarray) -> np.ndarray:
        sums = np.add.reduceat(self.weights["gram"][gram], np.cumsum(counts) - counts)
        return np.hstack([self.weights["word"][word], sums / counts[:, None].astype(np.float32)])

    def projected(self, words: list[str]) -> np.ndarray:
        """What the words add to the gates of both directions."""
        if not words:
            return np.zeros((0, 6 * HIDDEN), np.float32)
        return self.vectors(*hashed(words)) @ self.weights["inputs"] + self.weights["bias"]

    # --- recurrence -----------------------------------------------------

    def run(self, table: np.ndarray, windows: np.ndarray, sizes: np.ndarray, trace: list | None = None):
        """Logits of ``windows`` (one row of word numbers each, ``sizes`` words
        long); ``table`` has the projected words."""
        n, length = windows.shape
        present = (np.arange(length)[:, None] < sizes[None, :]).astype(np.float32)[:, :, None]
        states = np.empty((length, n, 2 * HIDDEN), np.float32)
        for d, (name, order) in enumerate((("forward", range(length)), ("backward", range(length - 1, -1, -1)))):
            u, h = self.weights[name], np.zeros((n, HIDDEN), np.float32)
            columns = slice(3 * HIDDEN * d, 3 * HIDDEN * (d + 1))
            part = np.ascontiguousarray(table[:, columns])
            for t in order:
                x, g = part[windows[:, t]], h @ u
                gates = sigmoid(x[:, :2 * HIDDEN] + g[:, :2 * HIDDEN])
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                inner = g[:, 2 * HIDDEN:]
                c = np.tanh(x[:, 2 * HIDDEN:] + r * inner)
                after = (h + z * (c - h)) * present[t]
                if trace is not None:
                    trace.append((d, t, h, z, r, c, inner))
                h = after
                states[t, :, d * HIDDEN:(d + 1) * HIDDEN] = h
        hidden = np.tanh(states @ self.weights["attend"] + self.weights["attend_bias"])
        energy = np.where(present[:, :, 0] > 0, hidden @ self.weights["attention"], np.float32(-1e9))
        weight = np.exp(energy - energy.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        logits = pooled @ self.weights["out"] + self.weights["out_bias"][0]
        return (logits, present, states, hidden, weight, pooled) if trace is not None else logits

    def gradients(self, words, windows: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> dict:
        """Gradients of the mean logistic loss; ``words`` has the buckets and
        grams of the windows' words."""
        w, h = self.weights, HIDDEN
        word, gram, counts = words
        vectors = self.vectors(word, gram, counts)
        table, trace = vectors @ w["inputs"] + w["bias"], []
        logits, present, states, hidden, weight, pooled = self.run(table, windows, sizes, trace)
        d_logit = ((sigmoid(logits) - labels) / len(labels)).astype(np.float32)
        grad = {"out": pooled.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * w["out"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = np.einsum("nh,tnh->tn", d_pooled, states)
        d_energy = weight * (d_weight - (weight * d_weight).sum(axis=0))
        grad["attention"] = np.einsum("tn,tna->a", d_energy, hidden)
        d_hidden = d_energy[:, :, None] * w["attention"] * (1 - hidden * hidden)
        grad["attend_bias"] = d_hidden.sum(axis=(0, 1))
        grad["attend"] = np.einsum("tnh,tna->ha", states, d_hidden)
        d_states += d_hidden @ w["attend"].T

        d_inputs = np.zeros((windows.shape[1], len(windows), 6 * h), np.float32)
        for d, name in ((1, "backward"), (0, "forward")):
            u, carried = w[name], np.zeros((len(windows), h), np.float32)
            grad[name] = np.zeros_like(u)
            for _, t, before, z, r, c, inner in [s for s in reversed(trace) if s[0] == d]:
                dh = (d_states[t, :, d * h:(d + 1) * h] + carried) * present[t]
                d_c = dh * z * (1 - c * c)
                d_z = dh * (c - before) * z * (1 - z)
                d_r = d_c * inner * r * (1 - r)
                back = np.hstack([d_z, d_r, d_c * r])
                grad[name] += before.T @ back
                carried = dh * (1 - z) + back @ u.T
                d_inputs[t, :, 3 * h * d:3 * h * (d + 1)] = np.hstack([d_z, d_r, d_c])

        flat = windows.T.ravel()
        order = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.diff(flat[order], prepend=-1))
        d_table = np.zeros_like(table)
        d_table[flat[order][first]] = np.add.reduceat(d_inputs.reshape(-1, 6 * h)[order], first)
        grad["inputs"], grad["bias"] = vectors.T @ d_table, d_table.sum(axis=0)
        d_vectors = d_table @ w["inputs"].T
        grad["word"], grad["gram"] = np.zeros_like(w["word"]), np.zeros_like(w["gram"])
        np.add.at(grad["word"], word, d_vectors[:, :WORD_SIZE])
        np.add.at(grad["gram"], gram, np.repeat(d_vectors[:, WORD_SIZE:] / counts[:, None].astype(np.float32),
                                                counts, axis=0))
        return grad

    def learn(self, words, windows, sizes, labels, rate: float, decay: float = 1e-3) -> None:
        """One Adam step; ``decay`` shrinks the embeddings."""
        self.step += 1
        for name, g in self.gradients(words, windows, sizes, labels).items():
            m, v = self.moments.setdefault(name, (np.zeros_like(g), np.zeros_like(g)))
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            change = m / (1 - 0.9 ** self.step) / (np.sqrt(v / (1 - 0.999 ** self.step)) + 1e-8)
            if name in self.known:
                change = change * self.known[name] + decay * self.weights[name]
            self.weights[name] -= (rate * change).astype(np.float32)


class Words:
    """Projected words of a task; begun again beyond ``kept`` words.  Word
    number 0 stands for no word."""

    def __init__(self, network: Network, kept: int = 200_000):
        self.network, self.kept = network, kept
        self._begin()

    def _begin(self) -> None:
        self.row, self.parts, self.table = {}, [], np.zeros((1, 6 * HIDDEN), np.float32)

    def numbers(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self.row) > self.kept:
            self._begin()
        new = sorted(set().union(*texts).difference(self.row))
        if new:
            self.row.update(zip(new, range(len(self.row) + 1, len(self.row) + len(new) + 1)))
            self.table = np.concatenate([self.table, *(self.network.projected(new[i:i + 20_000])
                                                       for i in range(0, len(new), 20_000))])
        at = self.row.__getitem__
        return [np.fromiter(map(at, words), np.int64, len(words)) for words in texts]
