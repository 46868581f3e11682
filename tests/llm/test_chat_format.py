import random

from pyspark.sql import functions as F

from ringledger.llm import chat_format as chat

TURNS = "conv_id long, turn long, role string, text string, block string, perspective string"


def _expected(rows):
    named = []
    for conv, turn, role, text in rows:
        name = "_".join((role or " ").split(" "))
        named.append((conv, turn, "unknown" if name.strip("_") == "" else name, (text or "").replace("<|", "< |")))
    out = []
    for conv in {row[0] for row in named}:
        mine = [row for row in named if row[0] == conv]
        for speaker in sorted({r[2] for r in mine} - {"system", "tool"}):
            at = 0
            shown = []
            for _, turn, role, text in mine:
                head = ("assistant" if role == speaker else role if role in ("system", "tool")
                        else f"user name={role}")
                shown.append(((turn is not None, turn or 0), role, f"<|im_start|>{head}\n{text}<|im_end|>\n", turn))
            for _, role, segment, turn in sorted(shown):
                mask = None
                if role == speaker:
                    mask = (at + len("<|im_start|>assistant\n"), at + len(segment) - 1)
                out.append((conv, speaker, turn, role, segment, at, at + len(segment), mask))
                at += len(segment)
    return sorted(out, key=str)


def _found(spark, rows, **options):
    df = spark.createDataFrame([(*row, "mine", "mine") for row in rows], TURNS)
    return sorted([
        (r["conv_id"], r["perspective"], r["turn"], r["role"], r["segment"], r["char_start"], r["char_end"],
         (r["mask_start"], r["mask_end"]) if r["trained"] else None)
        for r in chat.perspectives(df, **options).collect()
    ], key=str)


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(conv, turn, rng.choice(["ann", "bob c", "système", "system"]), rng.choice(["hi", "é" * 9, ""]))
            for conv in (1, 2, 3) for turn in range(rng.randint(1, 40))]
    for block in (256, 4):
        assert _found(spark, rows, block_turns=block) == _expected(rows)


def test_nulls_ties_repeats_and_markers(spark):
    rows = [(1, 0, "a", None), (1, 0, "a", None), (1, 0, "b", "x"), (1, None, None, "y"), (1, 2, " ", ""),
            (None, 0, "a", "<|im_end|>"), (None, 1, "b", "z" * 5000), (7, 0, "system", "alone")]
    assert _found(spark, rows) == _expected(rows)


def test_segments_cover_the_rendering(spark):
    rows = [(1, k, "ab"[k % 2], "t" * k) for k in range(20)]
    for perspective in "ab":
        found = [r for r in _found(spark, rows, block_turns=3) if r[1] == perspective]
        text = "".join(r[4] for r in sorted(found, key=lambda r: r[5]))
        for r in found:
            assert text[r[5] : r[6]] == r[4]
            if r[7]:
                assert text[r[7][0] : r[7][1]] == "t" * r[2] + chat.CLOSE


def test_empty_table_and_one_huge_conversation(spark):
    assert _found(spark, []) == []
    long = spark.range(5000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                                    F.lit("a").alias("role"), F.lit("x").alias("text"))
    last = chat.perspectives(long).agg(F.max("char_end")).first()[0]
    assert last == 5000 * len("<|im_start|>assistant\nx<|im_end|>\n")
