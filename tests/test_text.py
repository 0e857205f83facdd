import difflib
import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from glosswright.functions import text

SAMPLES = ["", "   ", "Hello world. Hello again!", "it's rock 'n' roll", "a''b x_1 École", "No end", "?!... What?! Yes.", "ein Haus und der Garten mit dem Tor", "le chat est sur la table avec une souris", "One1 two22 three333.", "tab\tand\nline\x0bfeed  end ", "The Big Apple is in New York. NASA went."]


def table(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(SAMPLES)], "id int, t string")


def py_words(t):
    return [w.lower() for w in re.findall(r"\b[\w']+\b", t)]


def test_counts_equal_plain_python(spark):
    t = F.col("t")
    rows = table(spark).select("id", text.words(t).alias("ws"), text.word_count(t).alias("n"), text.sentence_count(t).alias("s"), text.squeeze_spaces(t).alias("q"), text.topic_hint(t).alias("h")).collect()
    for r in rows:
        s = SAMPLES[r.id]
        assert r.n == len(r.ws) == len(py_words(s)), s
        assert [w.strip("'") for w in r.ws] == [w.strip("'") for w in py_words(s)], s
        assert r.s == len(re.findall(r"[.!?]+", s)) and r.q == " ".join(s.split())
        assert r.h == (" ".join(s.split()[:16]) or "general discussion")


def test_lexical_fold_equals_counter(spark):
    rng = random.Random(0)
    texts = [" ".join(rng.choice(["ab", "cd", "efghijkl", "x", "longerword"]) for _ in range(rng.randint(0, 30))) for _ in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    for r in text.with_sums(df, "t").select("id", text.lexical(F.col("__sums")).alias("m")).collect():
        ws = texts[r.id].split()
        c, n = Counter(ws), len(ws)
        want = (n, len(c), len(c) / n, sum(v == 1 for v in c.values()) / n, sum(map(len, ws)) / n, sum(len(w) >= 7 for w in ws) / n) if n else (0, 0, 0, 0, 0, 0)
        assert all(math.isclose(a, b) for a, b in zip(tuple(r.m), want))


def test_profile_of_odd_texts(spark):
    rows = {r.id: r for r in text.with_profile(table(spark), "t").collect()}
    assert rows[0].quality_score == 0.0 and rows[0].flesch_reading_ease is None and rows[0].language == "unknown"
    assert rows[7].language == "de" and rows[8].language == "fr"
    assert all(0 <= r.quality_score <= 1 for r in rows.values())
    null = text.with_profile(spark.createDataFrame([(1, None)], "id int, t string"), "t").first()
    assert null.word_count is None and null.sentence_count is None


def test_similarity_is_the_library_ratio(spark):
    pairs = [("abc def", "abc  def"), ("", ""), ("a", ""), ("the cat sat", "the dog sat on it"), (None, "x")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r.s for r in df.select(text.sequence_similarity("a", "b").alias("s")).collect()]
    assert got[:3] == [1.0, 1.0, 0.0] and got[4] is None
    assert math.isclose(got[3], difflib.SequenceMatcher(None, *pairs[3]).ratio())


def test_entities_and_novelty(spark):
    r = table(spark).where("id = 11").select(text.entities(F.col("t")).alias("e"), text.new_entities(F.lit("The Big Apple"), F.col("t")).alias("n"), text.novel_ratio(F.lit("new word the"), F.lit("The word")).alias("v")).first()
    assert set(r.e) == {"The Big Apple", "New York", "NASA"} and r.n == 2 and math.isclose(r.v, 1 / 3)
