from glosswright.llm import pieces


def test_segments_of_items_that_span_many_indexes(spark):
    far = 250_000
    items = spark.createDataFrame([("v", 0, 0, far, "x" * 9 + " " + "y" * 9), ("v", 1, 0, 10**15, "z" * 20)], "video_id string, chunk_index bigint, start_segment_index bigint, end_segment_index bigint, text string")
    segs = spark.createDataFrame([("v", 0, "x" * 9), ("v", far, "y" * 9), ("v", far + 1, "not of it"), ("v", 10_000, None), ("w", 5, "other")], "video_id string, segment_index bigint, text string")
    got = {r.chunk_index: r for r in pieces.oversized(items, segs, 12).collect()}
    assert got[0].lengths == [9, 9]
    out = {r.chunk_index: r.needed for r in pieces.cut_items(pieces.oversized(items, segs, 12), 12, 3).collect()}
    assert out == {0: "segment", 1: "none"}
    many = spark.createDataFrame([("v", i * pieces.BLOCK, "word of a long stream") for i in range(40)], "video_id string, segment_index bigint, text string")
    assert {r.chunk_index: r.lengths for r in pieces.oversized(items, many, 12).collect()} == {0: None, 1: None}
