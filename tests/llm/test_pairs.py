import numpy as np

from glosswright.llm import pairs
from glosswright.llm.crf import ChainCRF
from tests.llm import held_out_pairs

EN = "The old mill stood by the river for many years. Nobody knew why the baker left the town. In the end, it was sold to a painter who lived there."
FR = "Le vieux moulin était au bord de la rivière. Personne ne sait pourquoi le boulanger est parti. Il y avait une petite maison dans le village."


def test_crf_learns_a_rule_and_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    xs, ys = [], []
    for _ in range(80):
        n = rng.integers(1, 7)
        x = np.column_stack([np.ones(n), rng.integers(0, 2, n)])
        xs.append(x)
        ys.append(np.maximum.accumulate(x[:, 1]).astype(int))  # once on, stays on: needs transitions
    crf = ChainCRF.fit(xs, ys, 2, steps=300)
    assert sum((a == b).all() for a, b in zip(crf.decode(xs), ys)) > 76
    import itertools

    for x in xs[:10]:
        best = max(itertools.product(range(2), repeat=len(x)), key=lambda t: sum(x[i] @ crf.emission[:, k] for i, k in enumerate(t)) + sum(crf.transition[a, b] for a, b in zip(t, t[1:])))
        assert tuple(crf.decode([x])[0]) == best
    assert crf.decode([]) == [] and len(crf.decode([np.zeros((0, 2))])[0]) == 0


def test_empty_and_ended():
    assert all(pairs.is_empty(t) for t in (None, "", " \n", "​", "N/A", "[empty]", "(no output)", "...", '""', "<<<EDIT_OUTPUT_START>>>\n<<<EDIT_OUTPUT_END>>>", "NARRATOR: [Pause]", "—"))
    assert not any(pairs.is_empty(t) for t in ("No.", "I cannot.", "x" * 100))
    for t in ("It was late. (laughs)", 'He called it "the last good one"', "Done. 🙂", "It went on. See https://x.example/a", "So it was.\n[Pause]\n[Music]", "Why?", "On and on..."):
        assert pairs.ended(t), t
    for t in ("It was the", "It was late,", "They saw the cathedr", "It was (because"):
        assert not pairs.ended(t), t


def test_defects(spark):
    r = "Make it shorter."
    rows = [
        (1, r, EN, "The old mill stood by the river for many years. In the end, it was sold to a painter who lived there.", None),
        (2, r, EN, None, "empty"), (3, r, EN, "I'm sorry, but I can't help with this request.", "refusal"), (4, r, EN, EN.lower(), "copy"), (5, r, EN, "Sure! " + EN, "copy"), (6, r, EN, r, "copy"),
        (7, r, EN, FR, "language"), (8, r + " Reply in French, please.", EN, FR, None), (9, r, EN, "The old mill stood by the river for many years. Nobody knew why the bak", "truncated"),
        (10, None, FR, FR.replace(" une petite maison", " beaucoup"), None), (11, r, None, "A whole sentence about something else.", None), (12, r, FR, "Je regrette, je ne peux pas modifier ce texte.", "refusal"), (2, r, EN, None, "empty"),
        (13, r, EN, EN + " " + " ".join(["And so it was that they went to the house again."] * 3000), None),
    ]
    base = [(100 + i, r, t, t[: len(t) // 2] + ".", None) for i, t in enumerate([EN, FR] * 10)]
    german = "Die alte Mühle stand viele Jahre am Fluss. Niemand weiß, warum der Bäcker die Stadt verließ. Hier ist die Geschichte ganz einfach."
    base += [(200 + i, r, german, german, "copy") for i in range(5)]
    df = spark.createDataFrame([(a, b, c, d, "x") for a, b, c, d, _ in [*rows, *base]], "entry_id bigint, instruction string, input_text string, output_text string, defect string")
    got = {x.entry_id: x.defect for x in pairs.defects(df, pairs.fit(df)).collect()}
    assert len(got) == 13 + 25
    assert {k: got[k] for k, *_ in rows} == {k: want for k, *_, want in rows}


def test_empty_table(spark):
    df = spark.createDataFrame([], "entry_id bigint, instruction string, input_text string, output_text string")
    assert pairs.fit(df) is None and pairs.defects(df, None).count() == 0


PROMPTS = [(EN, "Shorten it."), (FR, "Make it longer.")] * 30


def decode(field, pair):
    return field.crf.decode([pair.features], [pair.sparse])[0]


def test_held_out_accuracy():
    field = pairs.train(PROMPTS)
    fresh = pairs.training_pairs([(EN.replace("river", "lake"), "Cut it."), (FR.replace("moulin", "train"), "Clean it.")] * 15, field.letters, seed=9)
    right = sum((decode(field, p) == np.array(t)).all() for p, t in fresh)
    assert right / len(fresh) > 0.93


def test_refusals_and_languages_kept_out_of_the_made_pairs():
    field = pairs.train(PROMPTS)
    told = lambda text: (p := pairs.Pair(EN, "Cut it down.", text, field.letters)).defect(decode(field, p))
    made = {w for v in pairs.made_pairs.REFUSAL.values() for x in v.values() for w in x.split("|")}
    assert not made & set(held_out_pairs.REFUSALS)
    assert np.mean([told(t) == "language" for t in held_out_pairs.LANGUAGES.values()]) >= 0.8
    assert np.mean([told(t) in ("refusal", "language") for t in held_out_pairs.REFUSALS]) >= 0.6


def test_field_can_be_stored():
    import pickle

    field = pairs.train(PROMPTS[:10])
    again = pickle.loads(pickle.dumps(field))
    p = pairs.Pair(EN, "Cut.", "I won't do that. It goes against my rules.", again.letters)
    assert (decode(field, p) == decode(again, p)).all()


def test_length_does_not_decide():
    # on either side of bounds that were once there
    for n in (20, 200, 700):
        ruling = "-" * n
        assert not pairs.is_empty(f"{ruling}\nHere is what you asked for.\n{ruling}") and pairs.is_empty(f"{ruling} n/a {ruling}"), n
        assert pairs.is_empty("<<<" + "MARK " * n + ">>>"), n
        for tail in (f"[{'a long pause ' * n}]", f"({'he laughs ' * n})", f"“{'and so it went ' * n}”", f"See https://x.example/{'a' * n}", "🙂" * n):
            assert pairs.ended(f"It was over. {tail}"), (n, tail[:20])
            assert not pairs.ended(f"It was over. {tail} and then"), (n, tail[:20])
    assert pairs.ended("水車小屋は川のそばに立っていた。") and not pairs.ended("水車小屋は川のそばに")
    assert len(pairs.clauses("これは一つ。それは二つ。")) == 2


def test_long_chains_train_in_stretches():
    long = " ".join(f"Sentence number {i} tells of a mill." for i in range(130))
    field = pairs.train([(long, "Cut it.")] * 3)
    p = pairs.Pair(long, "Cut it.", long, field.letters)
    assert len(decode(field, p)) == 130
