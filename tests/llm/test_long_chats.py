import time

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat

N = 100_000


@pytest.mark.parametrize("roles", [("user", "assistant"), ("assistant",), ("user", "user", "assistant", "assistant", "tool")])
def test_many_turns_in_one_conversation(spark, roles):
    role = F.element_at(F.array(*map(F.lit, roles)), (F.col("id") % len(roles) + 1).cast("int"))
    rows = spark.range(N).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.concat(F.lit("é<| text \\ "), F.col("id").cast("string")).alias("text"))
    began = time.perf_counter()
    got = chat.read_chats(chat.format_chats(rows)).select(F.size("turns").alias("n"), F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("/"), t["text"])), "\n"), 256).alias("turns"), F.sha2(F.array_join("loss_texts", "\n"), 256).alias("loss")).first()
    assert time.perf_counter() - began < 20
    from hashlib import sha256

    texts = [(roles[i % len(roles)], f"é<| text \\ {i}") for i in range(N)]
    assert got.n == N and got.turns == sha256("\n".join(f"{r}/{t}" for r, t in texts).encode()).hexdigest()
    assert got.loss == sha256("\n".join(t for r, t in texts if r == "assistant").encode()).hexdigest()
