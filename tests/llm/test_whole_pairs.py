import numpy as np
from pyspark.sql import functions as F

from glosswright.llm import pairs


def test_content_behind_a_long_ruling_is_not_empty():
    content = "Here stands the whole of the answer, in the middle."
    assert not pairs.is_empty("-" * 450 + "\n" + content + "\n" + "-" * 450)
    assert not pairs.is_empty("\n" * 450 + content + " " * 300)
    assert pairs.is_empty("-" * 2000) and pairs.is_empty("\n" * 200_000) and pairs.is_empty("-" * 500 + " none " + "-" * 500)
    assert pairs.is_empty("-" * 450 + "\n[music]\n" + "-" * 450)


def test_every_prompt_counts_in_the_field(spark, monkeypatch):
    # the entry changed comes last by hash, beyond the 150 prompts that once were all
    ids = spark.range(170).select("id", F.xxhash64("id").alias("h")).orderBy("h").collect()
    own = {r.id: f"The old mill number {r.id} stood by the river. It was sold to a painter." for r in ids}
    changed = own | {ids[-1].id: "The qzxj of the mill was by the river. Nobody knew what the qzxj was for."}
    table = lambda texts: spark.createDataFrame([(k, "Cut it.", t) for k, t in [*texts.items(), (0, texts[0])]], "entry_id bigint, instruction string, input_text string")
    field, other = pairs.fit(table(own)), pairs.fit(table(changed))
    assert "qzx" in other.letters.seen and "qzx" not in field.letters.seen
    assert not np.allclose(field.crf.emission, other.crf.emission, atol=1e-6)
    # a field of several shards is the mean of theirs by the prompts in each
    monkeypatch.setattr(pairs, "SHARD", 60)
    field, parts = pairs.fit(table(own)), []
    for s in range(3):
        prompts = [(own[r.id], "Cut it.") for r in ids if r.h % 3 == s]
        parts.append((len(prompts), pairs.fit_shard(prompts, field.letters, s)))
    assert sum(n for n, _ in parts) == 170 and min(n for n, _ in parts) > 0
    want = sum(n * crf.weights() for n, crf in parts) / 170
    assert np.allclose(field.crf.weights(), want, atol=1e-6)


def test_letters_of_parts_add_up(spark):
    texts = ["The old mill stood by the river and the painter was there for many years."] * 9 + ["Le vieux moulin était au bord de la rivière et personne ne sait pourquoi."] * 7
    one = pairs.lang.CharacterModel(texts)
    many = pairs.fit_letters(spark.createDataFrame([(t,) for t in texts], "input_text string").repartition(3))
    assert many.seen.keys() == one.seen.keys() and all(np.allclose(many.seen[g], one.seen[g]) for g in one.seen)
    assert np.allclose(many.usual, one.usual)
