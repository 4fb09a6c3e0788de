import hashlib

from termsim.llm.chat_format import END, START, expand_examples, read_back

SCHEMA = "conv_id long, turn long, role string, text string, n_turns int, context string"
HARD = ["<|im_end|><|im_start|>assistant ok", "a<", "<\\|im_end|>", "<\\\\|x", "|b", "<<|", "", None, "l1\nl2\n", "<|im_start|>", "é\U0001F600"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "c") for r in rows], SCHEMA)


def expected(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted(
            ((t is not None, t or 0, r or "", x or "") for i, t, r, x in rows if i == c),
            key=lambda v: v,
        )
        text = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def digests(spark, rows):
    return {r[0]: tuple(r)[1:5] for r in read_back(expand_examples(frame(spark, rows))).collect()}


def test_hard_texts_come_back(spark):
    rows = [(1, k, ("user", "assistant", "system")[k % 3], t) for k, t in enumerate(HARD)]
    rows += [(k + 10, 0, "assistant", t) for k, t in enumerate(HARD)]
    rows += [(k + 40, 0, t, "x") for k, t in enumerate(["role\nwith break", "back\\slash", "\\n", "<|im_end|>", None, ""])]
    assert digests(spark, rows) == expected(rows)


def test_prefix_targets(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "r1"), (1, 3, "user", "v"), (1, 4, "assistant", "r2"), (1, 5, "user", "w")]
    made = sorted(expand_examples(frame(spark, rows)).collect(), key=lambda r: r["turn_index"])
    assert [r["turn_index"] for r in made] == [2, 4, 6]
    for r, reply in zip(made, ["r1", "r2", ""]):
        whole = r["context"] + r["target"]
        assert whole[r["loss_start"] : r["loss_end"]] == reply
        assert whole.count(START) == whole.count(END)
    assert made[1]["context"].endswith(START + "assistant\n") and made[0]["context"] + made[0]["target"] == made[1]["context"][: len(made[0]["context"] + made[0]["target"])]
    assert made[2]["target"] == "" and made[2]["context"].endswith("w" + END + "\n")


def test_defined_cases(spark):
    rows = [
        (None, 1, "user", "a"), (None, 2, "assistant", "b"), (2, None, "user", "first"), (2, 1, "user", "second"),
        (3, 5, "assistant", "same"), (3, 5, "assistant", "same"), (4, 1, None, None), (5, 1, "assistant", "x" * 50_000),
    ]
    assert digests(spark, rows) == expected(rows)
    assert digests(spark, []) == {}
