import itertools
import random

import numpy as np

from glosswright.llm import lang, pairs
from glosswright.llm.crf import Batch

EN = "The old mill stood by the river for many years. Nobody knew why the baker left the town. In the end, it was sold to a painter who lived there."
FR = "Le vieux moulin était au bord de la rivière. Personne ne sait pourquoi le boulanger est parti. Il y avait une petite maison dans le village."
PROMPTS = [(EN, "Shorten it."), (FR, "Make it longer.")] * 10


def test_made_pairs_are_described_in_bulk(monkeypatch):
    letters, calls = lang.CharacterModel([EN, FR]), []
    numbers = lang.CharacterModel.numbers
    monkeypatch.setattr(lang.CharacterModel, "numbers", lambda self, words: calls.append(1) or numbers(self, words))
    made = pairs.training_pairs(PROMPTS, letters)
    assert len(made) > 20 * len(PROMPTS)
    assert len(calls) <= len(PROMPTS) + 5  # one for each pair before, beside two for each prompt
    # a prompt's clauses stand in many of its pairs: their hashed features are summed once
    batch = pairs._batch(PROMPTS, letters, 7)
    assert len(batch.x) == sum(len(t) for _, t in made) and len(batch.counts) < len(batch.x) / 2


def test_a_pair_does_not_depend_on_those_beside_it(monkeypatch):
    letters = lang.CharacterModel([EN, FR])
    texts = ["", "²", "_", "İt. ΣΑΣ", "これは。それは", "wo rd " * 90, EN, EN.upper(), FR, EN[:40], "\n\n.\n\n", "I can't help. Sorry!"]
    rows = [(source, request, text) for source in (None, "", "a", EN, FR) for request in (None, "Reply in French.", "Write in Italian!") for text in texts]
    alone = [pairs.Pair(*row, letters) for row in rows]
    for bulk in (pairs.BULK, 900, 1):
        monkeypatch.setattr(pairs, "BULK", bulk)
        for p, q in zip(alone, pairs.Pair.many(rows, letters), strict=True):
            assert np.array_equal(p.features, q.features) and all(map(np.array_equal, p.sparse, q.sparse)) and np.array_equal(p.sizes, q.sizes)
            assert (p.texts, p.expected, p.spoken, p.source_words, p.request_words) == (q.texts, q.expected, q.spoken, q.source_words, q.request_words)
    assert pairs.Pair.many([], letters) == []


def test_gradient_is_that_of_the_likelihood_over_all_tag_sequences():
    rng = np.random.default_rng(3)
    n_tags, size, d = 3, 8, 2
    lengths = [1, 4, 2, 4, 3]
    xs, tags = [rng.normal(size=(n, d)) for n in lengths], [rng.integers(0, n_tags, n) for n in lengths]
    # places without hashed features, and some that repeat
    kinds = [([], []), ([1, 5, 5], [0.5, 1.0, 2.0]), ([7], [1.0]), ([1, 5, 5], [0.5, 1.0, 2.5])]
    picked = [rng.integers(0, len(kinds), n) for n in lengths]
    sparse = [(np.array([i for k in ks for i in kinds[k][0]], dtype=np.int64), np.array([v for k in ks for v in kinds[k][1]]), np.array([len(kinds[k][0]) for k in ks])) for ks in picked]
    w = [rng.normal(size=s) for s in ((d, n_tags), (n_tags, n_tags), (n_tags, size))]

    def likelihood(flat):
        e, t, h = (p.reshape(s.shape) for p, s in zip(np.split(flat, [d * n_tags, d * n_tags + n_tags**2]), w))
        total = 0.0
        for x, y, ks in zip(xs, tags, picked):
            score = x @ e + np.array([sum((v * h[:, i] for i, v in zip(*kinds[k])), np.zeros(n_tags)) for k in ks])
            of = lambda path: sum(score[i, k] for i, k in enumerate(path)) + sum(t[a, b] for a, b in itertools.pairwise(path))  # noqa: B023, E731
            total += of(y) - np.log(sum(np.exp(of(p)) for p in itertools.product(range(n_tags), repeat=len(x))))
        return total / len(xs)

    flat = np.concatenate([p.ravel() for p in w])
    step = np.eye(len(flat)) * 1e-5
    want = np.array([(likelihood(flat + s) - likelihood(flat - s)) / 2e-5 for s in step])
    dense, hashed = Batch(xs, tags, n_tags, sparse, size).gradient(*w)
    assert np.allclose(np.concatenate([dense, hashed.ravel()]), want, atol=1e-7)


def test_half_breaks_are_breaks():
    rng = random.Random(5)
    for _ in range(20_000):
        text = "".join(rng.choice("ab .!?…\"'”’»):;]\n\t") for _ in range(rng.randrange(1, 14)))
        assert pairs.HALF_BREAK.split(text) == pairs.BREAK.split(text), text


def test_gaps_are_those_of_choice():
    one, other = random.Random(2), random.Random(2)
    assert pairs.gaps(one, 500) == [other.choice(pairs.GAPS) for _ in range(500)] and one.random() == other.random()
