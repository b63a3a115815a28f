"""Chat: round trip over hostile texts, the machine, loss flags, templates that are refused."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tablesync.llm import chat
from tests.compare import differences, open_tables

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for *_, r, t in turns)), len(loss), sha(loss))
    return out


def run(spark, rows, n=3):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"seq": F.lit("s"), "loss": F.lit(1), "plain": F.lit(None)})
    segments = chat.formatted(df.repartition(n)).cache()
    got = {r["conv_id"]: r for r in chat.read_back(segments).collect()}
    return got, segments


def test_formatting_matches_sql(spark):
    assert differences(chat.op12(spark, SF), open_tables(SF), chat.ORACLE) is None


def test_hostile_texts_come_back(spark):
    rng = random.Random(5)
    alphabet = ["\\", "<", ">", "/", "s", "[", "]", "INST", "é", "\n", "😀", " ", "$0", "SYS", *chat.INSTRUCT.marks]
    rows = []
    for conv in range(200):
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["system", "user", "assistant", "assistant", "user", "tool", "[TEXT]\\", "", None])
            text = rng.choice([None, "", "".join(rng.choices(alphabet, k=rng.randint(0, 12)))])
            rows.append((conv, turn, role, text))
    rng.shuffle(rows)
    got, segments = run(spark, rows)
    want = brute(rows)
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == want
    whole = {r["conv_id"]: r for r in segments.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("s")).collect()}
    for conv, row in whole.items():
        text = "".join(s["text"] for s in row["s"])
        assert len(text) == got[conv]["formatted_chars"]
        assert text.count("<s>") == 1  # no text could write one


def test_ties_nulls_and_repeated_rows(spark):
    rows = [(1, None, "user", "late"), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"),
            (None, 1, "user", "n"), (None, 2, "assistant", "m"), (2, 5, None, None)]
    got, _ = run(spark, rows)
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == brute(rows)


def test_the_machine(spark):
    turns = {1: "su a", 2: "ua", 3: "u", 4: "ss", 5: "au", 6: "uaas", 7: "x"}
    names = {"s": "system", "u": "user", "a": "assistant", "x": "x"}
    rows = [(c, i, names[r], "t") for c, roles in turns.items() for i, r in enumerate(roles.replace(" ", ""))]
    got, _ = run(spark, rows)
    assert {c: (r["violations"], r["complete"]) for c, r in got.items()} == {
        1: (0, True), 2: (0, True), 3: (0, False), 4: (1, False), 5: (1, False), 6: (2, False), 7: (1, False)}


def test_a_long_text_and_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(chat, "BATCH_ROWS", 100)
    rows = [(1, 0, "user", "<s>" * 400_000), (1, 1, "assistant", "\\" * 1_000_000)]
    rows += [(2, i, ("user", "assistant")[i % 2], f"[INST]{i}") for i in range(5000)]
    got, _ = run(spark, rows)
    want = brute(rows)
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == want
    assert got[2]["violations"] == 0


def test_segments_carry_the_loss(spark):
    _, segments = run(spark, [(1, 0, "system", "be </s>"), (1, 1, "user", "hi"), (1, 2, "assistant", "yo")])
    got = [(r["text"], r["loss"]) for r in segments.orderBy("seq").collect()]
    assert got == [("<s>", False), ("<<SYS>>", False), ("be <\\/s>", False), ("<</SYS>>", False), ("[INST]", False),
                   ("hi", False), ("[/INST]", False), ("", False), ("yo", True), ("</s>", False), ("", False)]


def test_empty_table(spark):
    assert run(spark, [])[0] == {}


@pytest.mark.parametrize("begin, close", [("<s>", "<s>x"), ("<s>", "><"), ("<s>", ""), ("<\\s>", "</s>"), ("aba", "b|")])
def test_ambiguous_templates_are_refused(begin, close):
    with pytest.raises(ValueError):
        chat.Template(begin, {"user": chat.Turn("[U]", close)}, {}, frozenset(), ("[R]", "[T]", "[E]"))
