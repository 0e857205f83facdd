import random

from glosswright.llm import leaks

ITEM = "In the spring the old miller carried seven sacks of barley across the wooden bridge because his cart had broken near the quiet village and nobody wanted to wait for the blacksmith any longer"
WORDS = ITEM.split()


def found(text, items=((1, ITEM),)):
    return leaks.LeakFinder(list(items)).find(text)


def test_suffix_automaton_finds_every_place():
    rng = random.Random(0)
    seqs = [[rng.randint(0, 3) for _ in range(rng.randint(1, 14))] for _ in range(12)]
    a = leaks.SuffixAutomaton(seqs)
    for n in (1, 2, 3, 5):
        for s in seqs:
            for k in range(len(s) - n + 1):
                state = 0
                for w in s[k : k + n]:
                    state = a.next[state][w]
                want = sorted((i, j + n - 1) for i, t in enumerate(seqs) for j in range(len(t) - n + 1) if t[j : j + n] == s[k : k + n])
                assert sorted(a.places(state)) == want and a.count[state] == len(want)


def test_anchors_are_the_longest_matches():
    rng = random.Random(2)
    words = [rng.choice("abcdef") for _ in range(60)]
    finder = leaks.LeakFinder([(1, " ".join(words))], 10)
    doc = [rng.choice("abcdefg") for _ in range(300)] + words[10:40] + ["zzz"] + words[5:30]
    text = " ".join(words)
    for end, size, _ in finder.anchors(doc):
        assert " ".join(doc[end - size + 1 : end + 1]) in text
    assert max(size for _, size, _ in finder.anchors(doc)) >= 30


def test_passages_with_slips():
    other = "Something else entirely was said here before. "
    assert found(other + ITEM)[1] == len(WORDS)
    assert found(other + " ".join(WORDS[3:23]))[1] == 20
    assert found(other + " ".join(WORDS[3:22])) == {}
    disguises = [
        ITEM.upper(), ITEM.replace(" ", "  ").replace("village", "vil-\nlage"), "<p>" + ITEM.replace("bridge", "<b>bridge</b>") + "&nbsp;</p>", ITEM.replace("o", "о").replace("a", "а"),
        "\n".join(f"[0{i}:15] {' '.join(WORDS[i * 6 : i * 6 + 6])}" for i in range(6)), ITEM.replace("miller", "milelr").replace("quiet", "quuiet"), ITEM.replace("wooden ", ""), ITEM.replace("barley", "golden barley"),
    ]
    for text in disguises:
        assert found(other + text + " " + other).get(1, 0) >= 20, text
    # one pattern with other words is no leak
    assert found("In the spring the tall baker carried nine sacks of flour across the stone bridge because his horse had stumbled near the busy village and nobody wanted to pay for the doctor any longer") == {}


def test_short_null_and_shared_items(spark):
    assert found(ITEM, [(1, ITEM), (2, "What happened next?"), (3, None), (4, ITEM)]) == {1: len(WORDS), 4: len(WORDS)}
    docs = spark.createDataFrame([(1, "x " + ITEM, "k"), (1, "x " + ITEM, "k"), (2, None, "k"), (3, "", "k"), (4, ("word " * 50000) + ITEM, "k")], "doc_id bigint, text string, item_id string")
    items = spark.createDataFrame([(7, ITEM), (8, None), (9, "short one")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.leaks(docs, items).collect()}
    assert got == {(1, 7), (4, 7)} and leaks.leaks(docs, items).count() == 2
    assert leaks.leaks(docs.limit(0), items).count() == 0 and leaks.leaks(docs, items.limit(0)).count() == 0


def test_items_in_slices(spark, monkeypatch):
    monkeypatch.setattr(leaks, "MAX_ITEM_CHARS", 100)
    docs = spark.createDataFrame([(1, ITEM)], "doc_id bigint, text string")
    items = spark.createDataFrame([(i, ITEM) for i in range(5)], "item_id bigint, text string")
    assert leaks.leaks(docs, items).count() == 5


HELD = "the quick brown fox jumps over a lazy dog near the old stone bridge while seven red kites turn slowly above the green valley"


def test_spans_are_removed_or_the_document_is_dropped(spark):
    rest = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"Before it.\n{HELD.upper()}, <b>and</b> after\n{rest}", "x"), (2, HELD, "x"), (3, rest, "x"), (4, None, "x"), (5, f"{rest} {HELD} {rest} {HELD}", "x")], "doc_id bigint, text string, spans string")
    items = spark.createDataFrame([(7, HELD), (8, None)], "item_id bigint, text string")
    got = {r.doc_id: r for r in leaks.cleaned(docs, leaks.spans(docs, items)).collect()}
    n = len(HELD.split())
    assert set(got) == {1, 2, 5} and got[2].dropped and got[2].text is None and got[2].share == 1.0
    assert not got[1].dropped and got[1].leaked_words == n and got[1].text.split() == f"Before it. and after {rest}".split()
    assert got[5].leaked_words == 2 * n and got[5].text.split() == f"{rest} {rest}".split()
    whole = {r.doc_id: r.text for r in leaks.cleaned(docs, leaks.spans(docs, items), longest=1000).collect()}
    assert "QUICK" in whole[1]  # under the length limit nothing is cut
    assert leaks.cleaned(docs, leaks.spans(docs, items.limit(0))).count() == 0


def test_slices_of_items_give_the_same(spark, monkeypatch):
    import random

    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    texts = ["once upon a time there " + " ".join(rng.choice(words) for _ in range(40)) for _ in range(30)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    docs = spark.createDataFrame([(i, " ".join([*rng.sample(words, 9), *t.split()[2:25], *rng.sample(words, 9)])) for i, t in enumerate(texts)], "doc_id bigint, text string")
    whole = sorted(map(tuple, leaks.leaks(docs, items).collect()))
    monkeypatch.setattr(leaks, "MAX_ITEM_CHARS", 900)
    assert len(whole) >= 30 and sorted(map(tuple, leaks.leaks(docs, items).collect())) == whole


def test_tags_of_any_length_go():
    for n in (5, 299, 301, 5000):
        tag = f'<span title="{"a" * n}">'
        assert leaks.normal_words(f"one {tag}two</span> three") == ["one", "two", "three"], n
    assert leaks.normal_words("if 3 < 5 and 7 > 2 then") == ["if", "3", "5", "and", "7", "2", "then"]
