"""Alignment: against a plain version with the files' own libraries, token by token."""

import hashlib
import random
import time
from collections import Counter
from pathlib import Path

import numpy as np
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablesync.llm import align as al

SF = "/root/testdata/sf0.001"
A, B = (Path(al.TOKENIZERS) / name for name in (al.FILE_A, al.FILE_B))


def plain_tokens(text):
    """(id, bytes) of both sides, or none."""
    own, sign = Tokenizer.from_file(str(A)), al.byte_of_sign()
    own.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=str(B))

    def run(text):
        if not text:
            return [], []
        a = [(i, bytes(sign[c] for c in own.id_to_token(i))) for i in own.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in model.encode(text):
            piece = model.id_to_piece(i)
            b.append((i, bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
        wanted = b" " + text.encode()
        return (a, b) if all(b"".join(x for _, x in side) == wanted for side in (a, b)) else ([], [])

    return run(text) if isinstance(text, str) or text is None else [run(t) for t in text]


def spans(tokens):
    at, out = 0, []
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def brute(rows):
    docs, counts = [], Counter()
    for (doc_id, _), (a, b) in zip(rows, plain_tokens([t for _, t in rows])):
        a, b = spans(a), spans(b)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for cut in cuts:
            inside = [",".join(str(i) for i, s, e in side if low <= s and e <= cut) for side in (a, b)]
            groups.append("|".join(inside))
            low = cut
        links = [(i, j) for i, _, e in a for j, _, f in b if e == f] if len(a) < 3000 else [
            (i, j) for e, i in {e: i for i, _, e in a}.items() for j in [{f: j for j, _, f in b}.get(e)] if j is not None]
        counts.update(links)
        docs.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return sorted([(d, a, b, g, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(shown.encode()).hexdigest() if a else "") for d, a, b, g, links, shown in docs], key=repr)


def run(spark, rows, n=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"chunk": F.lit(1), "pairs": F.lit("x")})
    got = al.aligned(df.repartition(n), A.read_bytes(), B.read_bytes())
    return sorted((tuple(r[c] for c in al.RESULT) for r in got.collect()), key=repr)


def test_documents_equal_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = al.op13(spark, SF)
    assert sorted((tuple(r[c] for c in al.RESULT) for r in got.collect()), key=repr) == brute(rows)


def test_hostile_texts(spark, monkeypatch):
    monkeypatch.setattr(al, "BLOCK_CHARS", 50)
    monkeypatch.setattr(al, "CHUNK_CHARS", 200)
    texts = [None, "", " ", "  a", "<|endoftext|> <s>x</s> <unk>", "▁x", "a▁", "\x00", "😀😀é́", "\r\n\t x  ",
             "<0x41>", "日本語 текст עברית ไทย", "　x", "'s'll DON'T", "1234567", "﻿", "the the the", "a" * 5000,
             "the\n\n\nthe", " " * 300]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "the same"), (None, "the same"), (3, "the other"), (3, None)]
    assert run(spark, rows) == brute(rows)


def test_random_texts(spark, monkeypatch):
    monkeypatch.setattr(al, "CHUNK_DOCS", 7)
    rng = random.Random(2)
    alphabet = ["a", "the ", "é", "  ", "\n", "9", "'", "😀", "ing", "▁", "Ж", "<", "."]
    rows = [(rng.choice([None, 1, 2, i]), "".join(rng.choices(alphabet, k=rng.randint(0, 40)))) for i in range(150)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_groups_break_where_a_start_reaches_the_maximum():
    start, end = np.array([0, 5, 2, 9, 7, 9]), np.array([5, 7, 6, 12, 9, 10])
    assert al.groups(start, end).tolist() == [0, 0, 0, 2, 1, 2]
    a, b = al.overlaps(np.array([0, 3]), np.array([3, 6]), np.array([0, 2, 4]), np.array([2, 4, 6]))
    assert list(zip(a.tolist(), b.tolist())) == [(0, 0), (0, 1), (1, 1), (1, 2)]


def test_long_words_take_linear_time():
    one, other = al.byte_level(A.read_bytes()), al.pieces(B.read_bytes())
    signs = [f"{i}{end}" for i in range(60_000) for end in ",|;"]
    for text in ("z1" * 250_000, "z" * 500_000, "<a " * 150_000, " " * 300_000):
        start = time.perf_counter()
        found = al.align([text], one, other, signs)
        assert found.n_a[0] and time.perf_counter() - start < 10
