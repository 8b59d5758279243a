"""Pieces without a position keep their lines."""
from telemark.llm import transcripts as T


def test_null_and_negative_positions(spark):
    talk = [(c, t, ["user", "assistant"][t % 2], "What is w%d?" % t if t % 2 == 0 else "It is this and that.") for c in range(40) for t in range(4)]
    raw = T.raw_transcripts(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string"))
    model = T.train(T.lines(raw, keep=("role",)))
    rows = [(1, None, "User: first\nand more"), (1, None, "User: first\nand more"), (2, None, "Q: y"), (None, None, "User: nobody"), (3, 0, "User: hi"), (1, 5, "A: x"), (3, 1, "A: z")]
    for extra in ([], [(3, 300, "Q: late"), (3, 9000, "A: later")], [(3, -1, "Q: early"), (3, -9000, "Q: earlier")]):
        frame = spark.createDataFrame(rows + extra, "conv_id long, seq long, text string")
        out = T.turns(T.recover(frame, model)).collect()
        assert sum(r.n_lines for r in out) == len(rows) + 2 + len(extra)
        assert {r.conv_id for r in out if r.start_seq is None} == {1, 2, None}
        assert [r.text for r in out if r.conv_id == 1 and r.start_seq == 5] == ["x"]
        assert "nobody" in [r.text for r in out if r.conv_id is None]
    alone = T.turns(T.recover(spark.createDataFrame(rows[:4], "conv_id long, seq long, text string"), model)).collect()
    assert sum(r.n_lines for r in alone) == 6
