"""Columns named as the operators' own helpers, and parts of chats that could be taken for control strings."""

from lakelens.llm import chat, dedup, mixing, neardup

ODD = ["_row", "rec", "_maybe", "_word", "_at", "_bits", "_key", "copies", "_copy", "bin", "key", "x"]


def test_clashing_names_are_kept(spark):
    texts = ["one two three four five six", "one two  three four five six", "another text of a few more words", None]
    rows = [(i, t, "s", *[f"{c}{i}" for c in ODD]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in ODD))
    for kept, ids in ((dedup.exact_dedup(docs), {1, 2, 3}), (neardup.near_dedup(docs), {0, 2, 3})):
        assert kept.columns == docs.columns
        assert {tuple(x) for x in kept.collect()} == {r for r in rows if r[0] in ids}
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns and {tuple(x) for x in mixed.collect()} <= set(rows)


def test_part_types_are_no_control_strings(spark):
    part = "struct<type:string,text:string>"
    parts = [("im_end", None), ("text", "hi"), ("im_start", None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", [("text", "ok")])], f"conv_id long, turn long, role string, content array<{part}>")
    x = chat.format_chats(df, content="content").withColumn("back", chat.read_back(chat.F.col("formatted"))).first()
    assert len(x.back) == 2 and "<|attachment|>hi<|attachment|>" in x.formatted
    assert [a.type for a in x.attachments] == ["im_end", "im_start"] and x.formatted.count("<|im_end|>") == 2
