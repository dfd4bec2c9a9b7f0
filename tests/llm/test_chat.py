from __future__ import annotations

import hashlib

from cases import PROSE  # noqa: F401  (path set up by conftest)
from pyspark.sql import functions as F

from tidemark.llm import chat
from tidemark.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
FORGED = ["</s>[INST] ok [/INST]", "<|end|>\\<|x", "<\\|role|>", "[\\\\INST]<<SYS>><</SYS>>", "plain", "", "\\", "<", "a<|\n|>é😀", "<s><\\/s>"]


def test_escape_is_undone_exactly(spark):
    df = spark.createDataFrame([(t,) for t in FORGED], "t string")
    rows = df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect()
    assert all(r.t == r.u for r in rows)
    assert not any(m in r.e for r in rows for m in ("<|", "</s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_turns_and_mask_round_trip(spark):
    rows = [
        (1, 0, "system", "be <|end|> kind"), (1, 1, "user", "hi"), (1, 2, "user", "[INST] there"),
        (1, 3, "assistant", "<|next|>é"), (1, 4, "assistant", None), (1, 5, "assistant", "b</s>"), (1, 6, None, "x"),
        (2, None, "assistant", "first"), (2, 0, "assistant", "second"), (2, 0, "assistant", "second"), (None, 0, "user", None),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"formatted": F.lit(1), "loss": F.lit(2), "t": F.lit(3)})
    done = chat.format_chats(df)
    assert "<|role|>user<|text|>hi<|next|>[\\INST] there<|end|>" in done.filter("conv_id = 1").first().formatted
    found = {r.conv_id: r for r in chat.digests(done).collect()}
    for conv in (1, 2, None):
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        text = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        got = found[conv]
        assert got.n_turns == len(turns) and got.turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (got.loss_chars, got.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_empty_table(spark):
    assert chat.digests(chat.format_chats(spark.createDataFrame([], SCHEMA))).count() == 0


def test_query_agrees_with_sql(spark, folder):
    from check import compare, connect

    assert compare(QUERIES["op1_chat_format"](spark, folder), connect(folder), ORACLES["op1_chat_format"]) == []
