import numpy as np
import pytest

from glosswright.llm import toxicity
from glosswright.llm.ordinal import OrdinalModel, Rows, fit
from tests.llm import held_out_toxic


@pytest.fixture(scope="module")
def seeds():
    return toxicity.Scorer(toxicity.seed_model())


def kinds(scorer, text):
    return {c for c, s in zip(toxicity.CATEGORIES, scorer.severities([text])[0]) if s >= toxicity.SEVERE}


def test_ordinal_fit_orders_thresholds_and_learns():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (600, 2))
    eta = 3 * x[:, 0] - 2 * x[:, 1] + rng.logistic(size=600)
    grade = ((eta > -0.5).astype(int) + (eta > 1.5))[:, None]
    rows = Rows(np.tile([0, 1, 2], 600), np.column_stack([x, np.ones(600)]).ravel().astype(float), np.arange(0, 1800, 3), grade, grade, np.zeros(600))
    m = fit(rows, OrdinalModel(np.zeros((4, 1)), np.array([[0.0, 1.0]])), strength=0.1, steps=300)
    assert m.thresholds[0, 0] < m.thresholds[0, 1] and m.weights[0, 0] > 1 and m.weights[1, 0] < -0.7 and m.weights[3, 0] == 0
    assert m.severity(m.weights[[0]])[0, 0] > 1.2 > m.severity(m.weights[[1]])[0, 0]


def test_disguise_is_lifted():
    units = toxicity._Units()
    for text, word in (("m-o-r-o-n", "moron"), ("B.A.S.T.A.R.D", "bastard"), ("s u b h u m a n", "subhuman"), ("cre7in", "cretin"), ("pusssies", "pussies"), ("v3rmin", "vermin"), ("svbhuman", "subhuman"), ("cоnnard", "connard"), ("4$$h0l3", "asshole")):
        words = toxicity.words_of(f"you {text} there", units)
        assert word in [w.rstrip(toxicity.HIDDEN) for w in words], (text, words)
    assert toxicity.words_of("the year 1901 was good", units) == ["the", "year", "1901", "was", "good"]


def test_sentences_kept_out_of_the_made_ones(seeds):
    lists = toxicity.LEXICON
    for c, texts in held_out_toxic.SEVERE.items():
        assert not any(w.strip(",.").lower() in lists for t in texts for w in t.split()), c
    found = {c: np.mean([bool(kinds(seeds, t)) for t in texts]) for c, texts in held_out_toxic.SEVERE.items()}
    assert found["abuse"] >= 0.8 and found["hate"] >= 0.8 and found["sexual"] >= 0.5, found
    assert np.mean([bool(kinds(seeds, t)) for t in held_out_toxic.HARMLESS]) <= 0.25


def test_pieces_do_not_change_results(seeds, monkeypatch):
    text = "the old mill stood by the river " * 30 + "you stupid bastard , I will kill you " + "and the market was calm again " * 30
    texts = [text, None, "", "fuck you", text * 2, "word"]
    whole = seeds.severities(texts)
    monkeypatch.setattr(toxicity, "PIECE", 37)
    assert np.allclose(seeds.severities(texts), whole) and (whole[1:3] == 0).all()
    assert all(np.allclose(seeds.severities([t])[0], w) for t, w in zip(texts, whole))


def test_training_and_scores(spark):
    docs = spark.createDataFrame([(i, f"On day {i} we met. You gruzzle, you are a blorf. The road was long." if i % 2 else f"On day {i} we met. The old mill was sold to a clown. The road was long.", "s", "x") for i in range(60)] + [(90, None, None, "x"), (91, "", "s", "x"), (92, "word " * 60000 + "fuck off you cretin", "s", "x")], "doc_id bigint, text string, source string, abuse string")
    labels = spark.createDataFrame([(i, (i % 2) if i else 1) for i in range(60)] + [(3, None), (5, 0), (5, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == 63 and got[90].abuse == got[91].abuse == 0.0 and got[92].abuse >= toxicity.SEVERE
    worst = {i: max(got[i][c] for c in toxicity.CATEGORIES) for i in range(60)}
    assert toxicity.SEVERE <= min(worst[i] for i in range(1, 60, 2)) and max(worst[i] for i in range(2, 60, 2)) < toxicity.SEVERE
    # words that no list and no made sentence holds are learned from the labels alone
    alone = ["we met the gruzzle and the blorf"]
    assert toxicity.Scorer(model).severities(alone)[0, 0] > 2 * toxicity.Scorer(toxicity.seed_model()).severities(alone)[0, 0]
    none = toxicity.train(docs, labels.limit(0))
    assert np.array_equal(none.weights, toxicity.seed_model().weights) and toxicity.score(docs.limit(0), none).count() == 0
