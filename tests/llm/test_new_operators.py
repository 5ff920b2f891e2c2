"""Hard negatives, alignment of tokenizers and planes of ids, against brute force and round trips."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from matchlake.llm import alignment, negatives, planes, tokens
from tests.llm.conftest import rows

ODD = ["", "a ", " ", "  a  b  ", "don't you'LL  'S 's <|endoftext|> x<|y", "É́ é ß İ ſ ŉ x²½ ªº µ", "tab\tnew\n\n line \r\n",
       "a b c d 漢字 12345 ~~~ --'s", "▁ x ▁▁y", "<s></s><unk>", "x\x00y\x85z", "ends  ", "Σας ΟΔΟΣ", "1234 567 a1b2 'tis 'twas",
       "​﻿ a", "can'tt'res 'vein", "“quoted” – dash … ‘x’", "\n", " \n b \n\n c\n d \t\te", "<0x41> < 0x41>"]


def odd_texts():
    rnd = random.Random(1)
    marks = [" ", "a", "b", "'s", "é", "Ü", "1", "\n", ".", "!", "漢", "  ", "\t", "don't", "’", "<|"]
    return ODD + ["".join(rnd.choice(marks) for _ in range(40)) for _ in range(300)]


# Tokens -----------------------------------------------------------------------------------------

@pytest.mark.parametrize("short", [False, True])
def test_ids_equal_the_tokenizers(given, monkeypatch, short):
    if short:  # stretches and batches of a few words, and forgetful caches
        for name in ("STRETCH", "BATCH", "REMEMBERED"):
            monkeypatch.setattr(tokens, name, 50)
        monkeypatch.setattr(tokens.stretches, "__defaults__", (50,))
    texts = odd_texts() + [r["text"] for r in rows(given.select("text")) if r["text"]][:100]

    def ids(kind, name):
        out = []
        for ids, n in kind(tokens.tokenizer_path(name)).encode([*texts, None]):
            out += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
        return out[:-1]

    plain = Tokenizer.from_file(tokens.tokenizer_path(tokens.WORD_BPE))
    assert ids(tokens.WordIds, tokens.WORD_BPE) == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    plain = Tokenizer.from_file(tokens.tokenizer_path(tokens.BYTE_BPE))
    plain.encode_special_tokens = True
    assert ids(tokens.ByteIds, tokens.BYTE_BPE) == [plain.encode(" " + t, add_special_tokens=False).ids for t in texts]
    plain = SentencePieceProcessor(model_file=tokens.tokenizer_path(tokens.PIECE_BPE))
    assert [i for i, t in zip(ids(tokens.PieceIds, tokens.PIECE_BPE), texts) if t] == [plain.encode(t) for t in texts if t]


# Hard negatives ---------------------------------------------------------------------------------

def brute_negatives(data, is_anchor, n_pos=5, n_neg=3):
    used = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in data
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, label, v in used:
        if not is_anchor(i):
            continue
        ranked = sorted((-sum(x * y for x, y in zip(v, w)), j, other) for j, other, w in used if j != i)
        for s, j, _ in [r for r in ranked if r[2] == label][:n_pos]:
            fit = [r for r in ranked if r[2] != label and 50 * -s <= 100 * -r[0] <= 95 * -s]
            out += [(i, j, k + 1, r[1], -s, -r[0]) for k, r in enumerate(fit[:n_neg])]
    return sorted(out)


def vector_rows(n, seed, labels=3, big=False):
    rnd = random.Random(seed)
    scale = 1e6 if big else 1
    return [(i, rnd.randrange(labels), [scale * rnd.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(3)]) for i in range(n)]


@pytest.mark.parametrize(("sizes", "big"), [({"block": 20, "anchor_block": 8, "round_bytes": 1500}, False), ({}, False), ({}, True)])
def test_hard_negatives(spark, sizes, big):
    data = vector_rows(90, 5, big=big)
    data += [(91, 0, None), (92, 0, [1.0, None, 0.0]), (93, 0, [float("nan"), 0.0, 0.0]), (94, 1, [float("inf"), 0.0, 0.0]), (95, None, [1.0, 0.0, 0.0]),
             (None, 1, [1.0, 1.0, 1.0]), (96, 1, []), (98, 2, [1.0]), (3, 1, [0.25, 0.25, 0.25]), (10, 1, [1.0, 1.0, 1.0]), (10, 1, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(data, "id long, label int, v array<double>").selectExpr("*", "1 as score", "'x' as row", "2 as anchor").repartition(4)
    got = [tuple(r) for r in negatives.mine(df, F.col("id") % 5 == 0, **sizes).collect()]
    assert sorted(got) == brute_negatives(data, lambda i: i % 5 == 0)
    assert len(got) > 50


def test_hard_negatives_of_few_rows(spark):
    kind = "id long, label int, v array<double>"
    assert negatives.mine(spark.createDataFrame([], kind), F.col("id") % 5 == 0).collect() == []
    assert negatives.mine(spark.createDataFrame([(1, 1, [1.0])], kind), F.col("id") % 5 == 0).collect() == []
    # Scores of zero: a negative may come before its positive by id, but not by key.
    data = [(0, 1, [0.0]), (1, 2, [1.0]), (2, 1, [1.0])]
    got = [tuple(r) for r in negatives.mine(spark.createDataFrame(data, kind), F.col("id") == 0).collect()]
    assert got == brute_negatives(data, lambda i: i == 0) == [(0, 2, 1, 1, 0, 0)]


def test_keys_sort_by_anchor_score_and_id():
    rnd, n = random.Random(2), 500
    part = [(rnd.choice([0, 1, 2 ** 40]), rnd.choice([-2 ** 63, -5, 0, 7, 2 ** 63 - 1]), rnd.randrange(2), rnd.choice([-9, 0, 3, 2 ** 62])) for _ in range(n)]
    made = [negatives.keys(np.array([a]), np.array([a]), np.array([s]), k, np.array([i]))[0] for a, s, k, i in part]
    by_key = [negatives.unpacked(k)[1:4] for k in sorted(made)]
    assert by_key == [(s, k, i) for a, s, k, i in sorted(part, key=lambda x: (x[0], -x[1], x[2], x[3]))]


# Alignment --------------------------------------------------------------------------------------

def brute_alignment(docs):
    a_side = Tokenizer.from_file(tokens.tokenizer_path(tokens.BYTE_BPE))
    a_side.encode_special_tokens = True
    shown = {c: b for b, c in enumerate(tokens.BYTE_CHARS)}
    b_side = SentencePieceProcessor(model_file=tokens.tokenizer_path(tokens.PIECE_BPE))

    def b_bytes(i):
        p = b_side.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode()

    linked, held = [], Counter()
    for doc, text in docs:
        groups, pairs = [], []
        if text:
            found = a_side.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(shown[c] for c in t)) for i, t in zip(found.ids, found.tokens)]
            b = [(i, b_bytes(i)) for i in b_side.encode(text)]
            if b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
                spans = []
                for side in (a, b):
                    at, own = 0, []
                    for i, x in side:
                        own.append((at, at + len(x), i))
                        at += len(x)
                    spans.append(own)
                common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
                start = 0
                for end in common:
                    groups.append([[i for s, e, i in side if start < e <= end] for side in spans])
                    start = end
                pairs = [(i, j) for s, e, i in spans[0] for t, f, j in spans[1] if s < f and t < e]
        linked.append((doc, groups, pairs))
        held.update(set(pairs))
    highest = defaultdict(int)
    for (i, _), n in held.items():
        highest[i] = max(highest[i], n)
    out = []
    for doc, groups, pairs in linked:
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((doc, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(pairs),
                    sum(held[p] == highest[p[0]] for p in pairs), sum(held[p] for p in pairs),
                    hashlib.sha256(text.encode()).hexdigest() if groups else "", text))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[1:])


@pytest.mark.parametrize("small", [False, True])
def test_alignment(spark, pair, planted, monkeypatch, small):
    docs = [(r["doc_id"], r["text"]) for r in rows(pair.select("doc_id", "text")) if len(r["text"] or "") < 3000]
    docs += [(2000 + i, t) for i, t in enumerate(odd_texts())]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as slice", "2 as pair", "'x' as n").repartition(3)
    options = {}
    if small:
        for name in ("STRETCH", "BATCH"):
            monkeypatch.setattr(tokens, name, 60)
        monkeypatch.setattr(tokens.stretches, "__defaults__", (60,))
        monkeypatch.setattr(alignment, "UNIT_TOKENS", 30)
        options = {"slice_bytes": 500}
    got = sorted((tuple(r) for r in alignment.align(df, keep_groups=True, **options).collect()), key=key)
    assert got == sorted(brute_alignment(docs), key=key)
    assert sum(r[1] > 0 for r in got) > 200


def test_groups_by_diagonals():
    rnd = random.Random(3)
    for _ in range(300):
        n = rnd.randrange(1, 60)
        ends = [sorted({*rnd.sample(range(1, n + 1), rnd.randrange(n // 2 if rnd.random() < 0.5 else 0, n)), n}) for _ in range(2)]
        a, b = (np.array(e) for e in ends)
        common = sorted(set(ends[0]) & set(ends[1]))
        at_a, at_b = alignment.groups(a, b)
        assert at_a.tolist() == [ends[0].index(e) + 1 for e in common]
        assert at_b.tolist() == [ends[1].index(e) + 1 for e in common]


def test_alignment_of_no_rows(empty):
    assert rows(alignment.align(empty)) == []


# Planes -----------------------------------------------------------------------------------------

@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    rnd = np.random.default_rng(4)
    for n in (1, 7, 8, 1000):
        ids = rnd.integers(0, 2 ** 32, n, dtype=np.uint32)
        assert planes.restored(planes.transposed(ids, bits), n).tolist() == ids.tolist()


def brute_planes(docs):
    tokenizer = Tokenizer.from_file(tokens.tokenizer_path())
    out = [(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, planes.END_ID]) for d, t in docs]
    return [(d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, ids in out]


@pytest.mark.parametrize("options", [{}, {"bits": True, "chunk": 100, "file_bytes": 20_000}])
def test_token_planes(pair, planted, tmp_path, options):
    docs = pair.selectExpr("*", "1 as row", "'x' as number")
    index = planes.write(docs, str(tmp_path / "ids"), **options)
    got = rows(planes.read(index).withColumn("crc", F.crc32("ids")))
    want = brute_planes([(r["doc_id"], r["text"]) for r in rows(pair)])
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(((r["doc_id"], r["n_tokens"], r["crc"]) for r in got), key=key) == sorted(want, key=key)
    by_start = sorted(got, key=lambda r: r["start"])
    ids = [math.inf if r["doc_id"] is None else r["doc_id"] for r in by_start]
    assert ids == sorted(ids)
    assert [r["start"] for r in by_start] == [0, *np.cumsum([r["n_tokens"] for r in by_start]).tolist()[:-1]]
    assert sum(r["n_ids"] for r in rows(index)) == sum(r["n_tokens"] for r in got)
    # Any stretch of a file's ids, by the chunk index.
    one = max(rows(index), key=lambda r: r["n_ids"])
    reader = planes.Reader(one["file"])
    whole = reader.ids(0, one["n_ids"])
    for a, z in ((0, 1), (one["n_ids"] - 1, one["n_ids"]), (90, 215), (100, 200), (5, 5)):
        assert reader.ids(a, z).tolist() == whole[a:z].tolist()


def test_one_id_in_many_files(spark, tmp_path):
    df = spark.range(3000).selectExpr("7L as doc_id", "concat('same word ', if(id % 3 = 0, 'x', string(id))) as text")
    index = planes.write(df, str(tmp_path / "ids"), file_bytes=1000)
    assert max(r["n_docs"] for r in rows(index)) < 1500
    assert planes.read(index).count() == 3000


def test_planes_of_no_rows_and_broken_files(empty, tmp_path):
    assert rows(planes.read(planes.write(empty, str(tmp_path / "none")))) == []
    (tmp_path / "cut.ids").write_bytes(planes.MAGIC * 10 + b"12345678")
    with pytest.raises(ValueError):
        planes.Reader(str(tmp_path / "cut.ids"))
