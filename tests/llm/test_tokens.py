import random

import pytest

from glosswright.llm import bpe, tokens

tokenizers = pytest.importorskip("tokenizers")
PATH = "/opt/tokenizers/byte_bpe_50k.json"


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def texts():
    rng = random.Random(3)
    pool = [chr(c) for c in [*range(300), 0x2003, 0x3000, 0x200B, 0x1F600, 0x4E2D, 0x301, 0x661, 0xBD, 0x10330]]
    made = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 50))) for _ in range(800)]
    return [*made, "", " ", "\n\n", "a" * 5000, " " * 70 + "x", "aaaaab" * 300, "<|endoftext|>hi", "don't we'll I'M 12345 Straße", "! ! !?" * 50]


def test_both_encoders_agree_with_the_library(library):
    back, heap = bpe.BacktrackEncoder(), bpe.HeapEncoder()
    for t in texts():
        want = library(t)
        assert back.ids(t) == want
        assert heap.count(t) == len(want)


def test_encode_gives_a_list_for_every_row(spark, library):
    rows = [(1, "Hello there."), (2, ""), (3, None), (None, "x"), (4, "Hello there."), (5, "long " * 20000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, text string, ids string")
    got = {(r.doc_id, i): r.ids for i, r in enumerate(sorted(tokens.encode(df).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0)))}
    assert sorted(map(len, got.values())) == sorted(len(library(t or "")) for _, t in rows)
    assert [r.ids for r in tokens.encode(df).where("doc_id = 1").collect()] == [library("Hello there.")]
    assert tokens.encode(df.limit(0)).count() == 0


def test_text_tokens_equal_the_joined_text(spark, library):
    chunks = [("a", 0, "One two."), ("a", 1, "Three!"), ("a", 1, "Three!"), ("b", 0, " lead"), ("b", 1, "trail \n"), ("b", 2, "  "), ("b", 3, "x"), ("c", 0, None), ("d", 2, "end\n"), ("d", 1, "start"), ("e", 0, "")]
    df = spark.createDataFrame([(*c, "k") for c in chunks], "video_id string, chunk_index bigint, t string, tokens string")
    got = {r.video_id: r.tokens for r in tokens.text_tokens(df, "video_id", "chunk_index", "t").collect()}
    for v in "abde":
        parts = [t for _, t in sorted({(i, t) for x, i, t in chunks if x == v and t is not None})]
        assert got[v] == len(library("\n\n".join(parts))), v
    assert "c" not in got


def test_untrusted_counts(spark):
    m = spark.createDataFrame([("a", None), ("b", 0), ("c", 301), ("d", 300), ("e", 33), ("f", 34), ("g", 5)], "video_id string, token_count bigint")
    t = spark.createDataFrame([(v, 100) for v in "abcdef"], "video_id string, tokens bigint")
    assert {r.video_id for r in tokens.untrusted_counts(m, t).collect()} == {"a", "b", "c", "e", "g"}
