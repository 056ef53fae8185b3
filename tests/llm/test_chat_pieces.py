"""Examples written out a turn at a time."""

from pyspark.sql import functions as F

from tillroll.llm import chat


def test_pieces_joined_are_the_expanded_texts(spark):
    rows = [(c, t, ["user", "assistant", "tool"][(c + t) % 3], f"say {c} {t}") for c in range(6) for t in range(9)] + [(None, 0, "assistant", "alone"), (7, 0, "user", "no reply")]
    seg = chat.segments(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    want = {(r.conv_id, r.target_turn): r.text for r in chat.expanded(seg).collect()}
    got = {}
    for r in sorted(chat.pieces(seg).collect(), key=lambda r: r.at):
        got[r.conv_id, r.target_turn] = got.get((r.conv_id, r.target_turn), "") + r.segment
        assert r.trained == (r.at == r.target_at) and (not r.trained or r.segment.startswith("<s>"))
    assert got == want and len(want) > 12
    last = chat.examples(seg).where("conv_id = 2").orderBy(F.desc("target_turn")).limit(1)
    assert {r.target_turn for r in chat.pieces(seg, last).collect()} == {last.first().target_turn}
    assert chat.pieces(seg.limit(0)).count() == 0
