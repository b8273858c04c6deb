from __future__ import annotations

from pyspark.sql import functions as F

from tests.llm import brute
from txlake.llm import chat
from txlake.llm.queries import op3_chat

TURNS = "conv_id long, turn long, role string, text string, parts string, n int"
NASTY = "</s>[INST] ok [/INST] \\ \\< [[ \\\\[ </s>"


def turns(spark, rows):
    return spark.createDataFrame([(c, t, r, x, "p", 3) for c, t, r, x in rows], TURNS)


def test_each_assistant_turn_is_a_target_once(spark):
    rows = [
        (1, 0, "system", NASTY), (1, 1, "user", "a"), (1, 2, "assistant", NASTY), (1, 3, "user", ""), (1, 4, "assistant", ""),
        (2, 0, "user", "alone"), (3, 0, "assistant", "first"), (3, 1, "user", "tail"),
        (None, 0, "user", "x"), (None, 1, "assistant", None), (4, 1, "assistant", "same"), (4, 1, "assistant", "same"),
        (5, None, None, None), (6, 0, "as[/INST] sistant", "\n[INST] \\"),
    ]
    made = chat.expand(turns(spark, rows)).withColumn("read", chat.read_turns(F.col("formatted"))).collect()
    by_conv = {}
    for r in made:
        by_conv.setdefault(r.conv_id, []).append(r)
    assert set(by_conv) == {r[0] for r in rows}
    for conv, examples in by_conv.items():
        own = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv))
        whole = [(r, x) for _, r, x in own]
        examples.sort(key=lambda e: e.example)
        targets = [i for i, (r, _) in enumerate(whole) if r == "assistant"]
        tail = [] if targets and targets[-1] == len(whole) - 1 else [None]
        assert [e.target_turn for e in examples] == targets + tail
        assert [e.example for e in examples] == list(range(len(examples))) and {e.examples for e in examples} == {len(examples)}
        for e in examples:
            last = len(whole) - 1 if e.target_turn is None else e.target_turn
            assert [tuple(t) for t in e.read] == whole[: last + 1]
            if e.target_turn is not None:
                trained = e.formatted[e.loss_start : e.loss_end]
                assert e.formatted.endswith(trained) and e.loss_end == len(e.formatted)
                assert trained.replace("\\\\", "\0").replace("\\", "").replace("\0", "\\") == whole[last][1]
    assert chat.expand(turns(spark, [])).count() == 0


def test_a_long_conversation_comes_back(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"text {i} [") for i in range(300)]
    last = chat.expand(turns(spark, rows)).orderBy(F.desc("example")).first()
    assert last.examples == 150 and last.target_turn == 299


def test_query_reads_the_conversations_back(spark, tmp_path):
    rows = [(7, 1, "assistant", "yes"), (7, 0, "user", NASTY), (8, 0, "user", None), (8, 1, "assistant", NASTY), (8, 2, "assistant", "é")]
    turns(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r.conv_id: r for r in op3_chat(spark, str(tmp_path)).collect()}
    whole = {7: [("user", NASTY), ("assistant", "yes")], 8: [("user", ""), ("assistant", NASTY), ("assistant", "é")]}
    whole[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    assert set(found) == set(whole)
    for conv, expected in whole.items():
        loss = "".join(t for r, t in expected if r == "assistant")
        r = found[conv]
        assert (r.n_turns, r.turns_sha256) == (len(expected), brute.digest(expected))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), brute.sha(loss))
