"""A linear-chain conditional random field on dense and hashed features, trained and decoded with numpy."""

from __future__ import annotations

import numpy as np

#: Hashed features of one sequence: (bucket, value, how many each place has).
Sparse = tuple[np.ndarray, np.ndarray, np.ndarray]


def stretch_sums(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of x along its last axis; a stretch may be empty."""
    out, full = np.zeros((*x.shape[:-1], len(counts))), counts > 0
    if full.any():
        out[..., full] = np.add.reduceat(x, (np.cumsum(counts) - counts)[full], axis=-1)
    return out


class Batch:
    """Sequences with their tags, laid out for the gradient of their likelihood.

    Places lie by their number in the sequence, then by sequence, longest first: those of one
    number are a stretch, and its first so many go on. Equal hashed features are held once.
    """

    def __init__(self, sequences: list[np.ndarray], tags: list[np.ndarray], n_tags: int, sparse: list[Sparse] | None = None, size: int = 0):
        longest_first = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
        lengths = np.array([len(sequences[i]) for i in longest_first])
        self.n_tags, self.size, self.sparse, self.n = n_tags, size, bool(sparse), len(sequences)
        number = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        order = np.argsort(number, kind="stable")
        self.live = np.bincount(number, minlength=lengths[0]).tolist()  # sequences that reach place k: the first so many
        self.at = np.concatenate([[0], np.cumsum(self.live)]).tolist()
        self.x = np.concatenate([sequences[i] for i in longest_first])[order]
        self.across = np.ascontiguousarray(self.x.T)
        self.gold = np.ascontiguousarray(np.eye(n_tags)[np.concatenate([tags[i] for i in longest_first])[order]].T)
        self.pair_gold = np.zeros((n_tags, n_tags))
        for k, n in enumerate(self.live[1:]):
            p, q = self.at[k], self.at[k + 1]
            self.pair_gold += self.gold[:, p : p + n] @ self.gold[:, q : q + n].T
        if sparse:
            index, value, counts = (np.concatenate([sparse[i][k] for i in longest_first]) for k in range(3))
            ends, kinds = np.cumsum(counts), {}
            buckets, values = index.tobytes(), value.tobytes()
            i, v = index.itemsize, value.itemsize
            kind = np.array([kinds.setdefault((buckets[a * i : b * i], values[a * v : b * v]), len(kinds)) for a, b in zip((ends - counts).tolist(), ends.tolist())])
            first = np.unique(kind, return_index=True)[1]
            self.kind, self.counts = kind[order], counts[first]
            held = np.repeat((ends - counts)[first] - np.cumsum(self.counts) + self.counts, self.counts) + np.arange(self.counts.sum())
            self.index, self.value, self.row = index[held], value[held], np.repeat(np.arange(len(first)), self.counts)

    def gradient(self, emission: np.ndarray, transition: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
        """Of the mean log likelihood, by the dense and transition weights and by the hashed ones."""
        live, at = self.live, self.at
        score = emission.T @ self.across
        if self.sparse:
            for k, w in enumerate(h):
                score[k] += stretch_sums(w[self.index] * self.value, self.counts)[self.kind]
        # exponentials are taken against the best tag of each place, so that they stay in range
        local, step_to = np.exp(score - score.max(0)), np.exp(transition - transition.max())
        alpha, beta = np.empty_like(local), np.ones_like(local)
        alpha[:, : live[0]] = local[:, : live[0]] / local[:, : live[0]].sum(0)
        for k in range(1, len(live)):
            p, q, n = at[k - 1], at[k], live[k]
            a = (step_to.T @ alpha[:, p : p + n]) * local[:, q : q + n]
            alpha[:, q : q + n] = a / a.sum(0)
        pair = np.zeros_like(step_to)
        for k in range(len(live) - 2, -1, -1):
            p, q, n = at[k], at[k + 1], live[k + 1]
            ahead, here = local[:, q : q + n] * beta[:, q : q + n], alpha[:, p : p + n]
            back = step_to @ ahead
            pair += step_to * ((here / (here * back).sum(0)) @ ahead.T)
            beta[:, p : p + n] = back / back.sum(0)
        node = alpha * beta
        miss = self.gold - node / node.sum(0)
        dense = np.concatenate([(miss @ self.x).T.ravel(), (self.pair_gold - pair).ravel()]) / self.n
        if not self.sparse:
            return [dense, np.zeros_like(h)]
        by_kind = [np.bincount(self.kind, weights=m, minlength=len(self.counts)) for m in miss]
        return [dense, np.stack([np.bincount(self.index, weights=m[self.row] * self.value, minlength=self.size) for m in by_kind]) / self.n]


class ChainCRF:
    """Scores a tag sequence by x·W and its hashed features per place plus a weight per pair of neighbouring tags."""

    def __init__(self, emission: np.ndarray, transition: np.ndarray, hashed: np.ndarray | None = None):
        self.emission, self.transition, self.hashed = emission, transition, hashed

    @classmethod
    def fit(cls, sequences: list[np.ndarray], tags: list[np.ndarray], n_tags: int, steps: int = 250, rate: float = 0.15, l2: float = 1e-3, sparse: list[Sparse] | None = None, size: int = 0) -> ChainCRF:
        """Maximum likelihood with Adam; scaled forward-backward gives the expectations."""
        return cls.fit_batches([Batch(sequences, tags, n_tags, sparse, size)], steps, rate, l2)

    @classmethod
    def fit_batches(cls, batches: list[Batch], steps: int = 250, rate: float = 0.15, l2: float = 1e-3) -> ChainCRF:
        """Adam on one batch after the other, again and again for at least *steps* steps and whole rounds; the weights are the mean over the last round."""
        rounds, first = -(-steps // len(batches)), batches[0]
        d, n_tags, size = first.x.shape[1], first.n_tags, first.size
        n_dense = d * n_tags
        w = np.zeros(n_dense + n_tags * n_tags)
        h = np.zeros((n_tags, size))
        moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, h)]
        mean = [np.zeros_like(p) for p in (w, h)]
        for step in range(1, rounds * len(batches) + 1):
            grads = batches[(step - 1) % len(batches)].gradient(w[:n_dense].reshape(d, n_tags), w[n_dense:].reshape(n_tags, n_tags), h)
            for p, g, (m, v) in zip((w, h), grads, moments):
                m += 0.1 * (g - l2 * p - m)
                v += 0.001 * ((g - l2 * p) ** 2 - v)
                p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            if step > (rounds - 1) * len(batches):
                for total, p in zip(mean, (w, h)):
                    total += p / len(batches)
        w, h = mean
        return cls(w[:n_dense].reshape(d, n_tags), w[n_dense:].reshape(n_tags, n_tags), np.ascontiguousarray(h.T) if first.sparse else None)

    def weights(self) -> np.ndarray:
        """All weights in one row, as from_weights takes them."""
        return np.concatenate([self.emission.ravel(), self.transition.ravel(), self.hashed.ravel()])

    @classmethod
    def from_weights(cls, weights: np.ndarray, d: int, n_tags: int) -> ChainCRF:
        emission, transition, hashed = np.split(weights, [d * n_tags, d * n_tags + n_tags * n_tags])
        return cls(emission.reshape(d, n_tags), transition.reshape(n_tags, n_tags), hashed.reshape(-1, n_tags))

    def decode(self, sequences: list[np.ndarray], sparse: list[Sparse] | None = None) -> list[np.ndarray]:
        """Best tag sequence of each (Viterbi, all sequences of a place at once, longest first)."""
        order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
        lengths = np.array([len(sequences[i]) for i in order])
        out: list[np.ndarray] = [np.zeros(0, dtype=int)] * len(sequences)
        if not len(order) or not lengths[0]:
            return out
        starts = np.cumsum(lengths) - lengths
        score = np.concatenate([sequences[i] for i in order]) @ self.emission
        if sparse and self.hashed is not None:
            index, value, counts = (np.concatenate([sparse[i][k] for i in order]) for k in range(3))
            found = self.hashed[index] * value[:, None]
            score += stretch_sums(np.ascontiguousarray(found.T), counts).T
        best, back = [score[starts[lengths > 0]]], []
        for k in range(1, lengths[0]):
            live = int((lengths > k).sum())
            step = best[-1][:live, :, None] + self.transition
            back.append(step.argmax(1))
            best.append(step.max(1) + score[starts[:live] + k])
        for r, i in enumerate(order):
            n = lengths[r]
            if n:
                path = np.zeros(n, dtype=int)
                path[-1] = best[n - 1][r].argmax()
                for k in range(n - 2, -1, -1):
                    path[k] = back[k][r, path[k + 1]]
                out[i] = path
        return out
