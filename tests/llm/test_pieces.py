from hypothesis import given, settings
from hypothesis import strategies as st

from glosswright.llm import pieces

TEXT = st.text(alphabet="ab. !?\n …", min_size=0, max_size=400)


@settings(max_examples=150, deadline=None)
@given(TEXT, st.integers(12, 60), st.integers(0, 10))
def test_pieces_cover_the_text_with_overlap(text, limit, overlap):
    cuts = pieces.cut_text(text, None, limit, overlap)
    assert cuts[0][0] == 0 and cuts[-1][1] == len(text)
    for (a, b, _), (c, d, _) in zip(cuts, cuts[1:]):
        assert b - a <= limit and c == b - overlap and d > b
    assert cuts[-1][1] - cuts[-1][0] <= limit


def test_boundary_needed():
    assert pieces.boundary_needed("a" * 10 + " " + "b" * 10, [10, 10], 12) == "segment"
    assert pieces.boundary_needed("aaa bbb. ccc ddd.", None, 9) == "sentence"
    assert pieces.boundary_needed("aaa bbb ccc", None, 5) == "word"
    assert pieces.boundary_needed("a" * 20, None, 5) == "none"
    assert pieces.boundary_needed("aaaa bbb\n\nccc ddd", None, 9) == "word"  # a paragraph may end inside a sentence
    assert pieces.boundary_needed("aaa bbb", [99], 5) == "word"  # lengths that do not fit are not used


def test_natural_cuts_are_preferred():
    text = "First sentence here. Second one is longer here. Third."
    assert [text[a:b] for a, b, _ in pieces.cut_text(text, None, 30, 0)][0] == "First sentence here. "


def test_items_with_their_segments(spark):
    items = spark.createDataFrame([("v", 0, 0, 1, "x" * 9 + " " + "y" * 9, 1), ("v", 0, 0, 1, "x" * 9 + " " + "y" * 9, 1), ("v", 1, 2, 2, "short", 1), ("v", 2, None, None, "z" * 30, 1), ("v", 3, 0, 0, None, 1), ("v", 4, 5, 1, "w w " * 9, 1)], "video_id string, chunk_index bigint, start_segment_index bigint, end_segment_index bigint, text string, needed int")
    segs = spark.createDataFrame([("v", 0, " " + "x" * 9), ("v", 0, " " + "x" * 9), ("v", 1, "y" * 9 + "\n"), ("v", 2, None)], "video_id string, segment_index bigint, text string")
    out = {r.chunk_index: r for r in pieces.cut_items(pieces.oversized(items, segs, 12), 12, 3).collect()}
    assert {k: r.needed for k, r in out.items()} == {0: "segment", 2: "none", 4: "word"}
    assert out[0].pieces[0].text == "x" * 9 + " "
    assert pieces.cut_items(pieces.oversized(items.limit(0), segs, 12)).count() == 0
