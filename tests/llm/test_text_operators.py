"""SimHash, substring dedup, suffix dedup and packing against brute force."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash

from matchlake.llm import packing, simhash, substrings, suffixes
from matchlake.llm import slices as S
from matchlake.llm.simhash import bucket_links, covering_masks, components
from tests.llm.conftest import rows

WORD = re.compile("[^\x20\x09-\x0d]+")


def texts(df):
    return [(r["doc_id"], r["text"]) for r in rows(df.select("doc_id", "text"))]


# SimHash ----------------------------------------------------------------------------------------

def brute_fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(docs):
    fps = [brute_fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        least[find(i)].append(d)
    return [(d, f"{f:016x}", min((x for x in least[find(i)] if x is not None), default=None)) for i, ((d, _), f) in enumerate(zip(docs, fps))]


def key(x):
    return tuple((v is None, v) for v in x)


@pytest.mark.parametrize("hot", [simhash.HOT, 1])
def test_simhash_equals_brute_force(pair, hot):
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows(simhash.near_duplicates(pair, hot=hot))]
    assert sorted(got, key=key) == sorted(brute_components(texts(pair)), key=key)


def test_simhash_of_no_rows(empty):
    assert rows(simhash.near_duplicates(empty)) == []


def test_every_near_pair_shares_a_table():
    masks, r = covering_masks(2), np.random.default_rng(1)
    for i in range(64):
        for j in range(i, 64):
            diff = 1 << i | 1 << j
            assert any(diff & m == 0 for m in masks)
    assert len(masks) == 7 and all(20 < bin(m).count("1") < 44 for m in masks)
    # Large buckets look up flipped bits; the links are the same as by comparing all.
    free = [i for i in range(64) if not masks[0] >> i & 1]
    base = int(r.integers(1 << 62)) & masks[0]
    fps = np.array(sorted({base | sum(1 << int(b) for b in r.choice(free[:9], 3, replace=False)) for _ in range(300)}), np.uint64)
    assert len(fps) > simhash.SMALL
    flips = np.array([1 << i for i in free] + [1 << i | 1 << j for i in free for j in free if i < j], np.uint64)
    a, b = bucket_links(np.zeros(len(fps), int), fps, flips, 2)
    want = {(i, j) for i in range(len(fps)) for j in range(i) if bin(int(fps[i]) ^ int(fps[j])).count("1") <= 2}
    assert {(max(x), min(x)) for x in zip(a.tolist(), b.tolist())} == want


def test_components_of_chains(spark):
    r = np.random.default_rng(3)
    a, b = r.integers(0, 400, 300), r.integers(0, 400, 300)
    label = components(400, a, b)
    edges = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)] + [(1000 + i, 1001 + i) for i in range(40)], "a long, b long")
    got = {x["node"]: x["root"] for x in rows(simhash.connected(edges))}
    for x in set(a[a != b].tolist()) | set(b[a != b].tolist()):
        assert got[x] == min(i for i in set(a.tolist()) | set(b.tolist()) if label[i] == label[x])
    assert {got[1000 + i] for i in range(41)} == {1000}


# Substrings -------------------------------------------------------------------------------------

def brute_windows(docs, window=35):
    split, seen = [(d, WORD.findall(t or "")) for d, t in docs], defaultdict(int)
    for _, w in split:
        for i in range(len(w) - window + 1):
            seen[tuple(w[i:i + window])] += 1
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        yield d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()


def test_substrings_equal_brute_force(pair):
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows(substrings.dedup(pair))]
    want = list(brute_windows(texts(pair)))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(w[2] for w in want) > 1000


def test_cover_holds_every_difference():
    p, cover = substrings.PERIOD, substrings.COVER
    assert {(a - b) % p for a in cover for b in cover} == set(range(p))


# Suffixes ---------------------------------------------------------------------------------------

def brute_bytes(docs, length=50):
    first, top = {}, 1 << 63
    raw = [(top if d is None else d, (t or "").encode()) for d, t in docs]
    for d, b in raw:
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            first[s] = min(d, first.get(s, top))
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < d:
                gone[i:i + length] = b"\1" * length
        rest = bytes(x for x, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        yield None if d == top else d, len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest()


def test_suffixes_equal_brute_force(pair):
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows(suffixes.dedup(pair))]
    want = list(brute_bytes(texts(pair)))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(w[2] for w in want) > 1000


def test_runs_that_agree_in_forty_bits_are_told_apart(spark):
    phrase = "wqlctjerxbotdtgcuqpuvzdmin a different"  # its first 24 bytes are the anchor of all four texts
    ends = ["selvoftjgznu", "darfphwwjkdz", "fcqqjsmcvxie", "qfetudhlwogl"]
    docs = spark.createDataFrame([(i, phrase + e) for i, e in enumerate(ends)], "doc_id long, text string")
    prefixes = [S.prefix_hash(S.BYTE_VALUES[np.frombuffer((phrase + e).encode(), np.uint8)]) for e in ends]
    top = [int(S.stretch_hash(p, np.array([0]), np.array([50]))[0]) >> 24 for p in prefixes]
    assert top[0] == top[1] and top[2] == top[3]
    assert [r["n_removed"] for r in rows(suffixes.dedup(docs))] == [0] * 4


@pytest.mark.parametrize("hot", [1, 100])
def test_suffixes_of_crowded_anchors_taken_apart(pair, hot):
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows(suffixes.dedup(pair, hot=hot))]
    assert sorted(got, key=key) == sorted(brute_bytes(texts(pair)), key=key)


def test_one_phrase_in_many_contexts_is_dealt_to_many_buckets():
    phrase, r = b"wqlctjerxbotdtgcuqpuvzdm", np.random.default_rng(2)
    around = r.integers(97, 123, (3000, 60)).astype(np.uint8)
    texts_ = [a[:30].tobytes() + phrase + a[30:].tobytes() for a in around]
    s = S.Slice(range(len(texts_)), [len(t) for t in texts_], S.zipped(b"".join(texts_)))
    own = suffixes.Runs(s, 50, 24)
    n = len(own.entries(s.ids)[0][0])
    codes = pd.DataFrame({"step": [1], "bucket": [0], "codes": [S.compressed(np.zeros(n, np.uint8))]})
    anchors = suffixes.Pieces(s, own, codes, 50, 1000).anchors
    total = suffixes.compare_anchors(*anchors[:4], None)
    assert total.max() > 50_000  # windows of one anchor, which went to one bucket
    codes.loc[1] = [2, 0, S.compressed(total)]
    pieces = suffixes.Pieces(s, own, codes, 50, 1000)
    sizes = np.diff(np.r_[S.group_starts(pieces.key), len(pieces.key)])
    assert pieces.size.sum() > 50_000 and sizes.max() < 2000


def test_dedups_of_no_rows(empty):
    assert rows(suffixes.dedup(empty)) == [] and rows(substrings.dedup(empty)) == []


def test_sorted_groups_are_equal_suffixes():
    r = np.random.default_rng(5)
    text = r.integers(97, 99, 4000).astype(np.uint8)
    text[1000:1400] = text[100:500]
    text[2000:2080] = 97
    at = r.permutation(3900)
    groups = suffixes.sorted_groups(text, at, 50)
    raw, want = text.tobytes(), defaultdict(set)
    for i, p in enumerate(at.tolist()):
        want[raw[p:p + 50]].add(i)
    assert sorted(map(sorted, (g.tolist() for g in groups))) == sorted(sorted(v) for v in want.values() if len(v) > 1)
    order, starts = suffixes.multikey_order(r.integers(0, 4, (500, 3)).astype(np.uint64))
    assert len(order) == 500 and starts[0] == 0


def test_multikey_order_sorts():
    r = np.random.default_rng(6)
    rows_ = r.integers(0, 3, (700, 3)).astype(np.uint64)
    order, starts = suffixes.multikey_order(rows_)
    assert [tuple(x) for x in rows_[order]] == sorted(map(tuple, rows_))
    assert len(starts) == len({tuple(x) for x in rows_})


def test_runs_across_stretches(monkeypatch):
    """Windows go to the leftmost of the anchors with the least upper half of the hash, wherever a stretch ends."""
    monkeypatch.setattr(suffixes, "STRETCH", 37)
    rng = np.random.default_rng(4)
    sizes = [0, 49, 50, 400, 3, 51, 120]
    s = S.Slice(list(range(len(sizes))), sizes, S.zipped(rng.integers(97, 99, sum(sizes)).astype(np.uint8).tobytes()))
    upper = S.fixed_hash(S.prefix_hash(S.BYTE_VALUES[s.bytes]), 24) >> np.uint64(32)
    wanted = []
    for d, (a, z) in enumerate(zip(s.bounds[:-1].tolist(), s.bounds[1:].tolist())):
        at = [w + int(np.argmin(upper[w:w + 27])) for w in range(a, z - 49)]
        cuts = [i for i in range(len(at)) if i == 0 or at[i] != at[i - 1]]
        wanted += [(a + i, a + j, d) for i, j in zip(cuts, [*cuts[1:], len(at)])]
    found = suffixes.Runs(s, 50, 24)
    assert list(zip(found.start.tolist(), found.stop.tolist(), found.document.tolist())) == wanted


# Packing ----------------------------------------------------------------------------------------

def check_packing(got, docs, capacity):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    want = []
    for d, text in docs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), capacity):
            part = ids[k:k + capacity]
            want.append((d, k // capacity, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=key) == sorted(want, key=key)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= capacity
    return len(sequences), sum(w[3] for w in want) / capacity


@pytest.mark.parametrize(("capacity", "share_bins"), [(4096, 2000), (512, 20)])
def test_packing_equals_brute_force(pair, capacity, share_bins):
    got = rows(packing.pack(pair, capacity=capacity, share_bins=share_bins))
    n, least = check_packing(got, texts(pair), capacity)
    assert n <= 1.02 * least + 1


def test_packing_of_no_rows(empty):
    assert rows(packing.pack(empty)) == []


def test_best_fit_prefers_the_fullest_bin_that_fits():
    assert packing.best_fit([60, 30, 40, 10, 70], 100, 8)[:2] == ([0, 0, 1, 0, 2], [0, 60, 0, 90, 0])
    # With one open bin, the fullest closes when none fits.
    bins, _, still = packing.best_fit([60, 70, 30], 100, 1)
    assert bins == [0, 1, 1] and still == set()


def test_word_ids_are_those_of_whole_texts():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    odd = ["It's 1,234  <|endoftext|>x y z é ́a don't''s\x1c\x1dq\x85r\n\n\tÇ ﬁ Σας", "", "   ", "a" * 5000]
    for text in odd:
        (ids, n), = packing.WordIds(packing.tokenizer_path()).encode([text])
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids and n.tolist() == [len(ids)]


def test_many_short_documents_fill_several_shares(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARE_PIECES", 500)
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, null, '') as text")
    got = rows(packing.pack(docs))
    assert check_packing(got, [(i, "") for i in range(3000)], 4096)[0] == 1


@pytest.mark.parametrize("gb", [1, 6, 16])
def test_blobs_keep_their_entries_in_a_large_corpus(monkeypatch, spark, gb):
    """Of 6 GB a slice of 2 MB had 33 entries for a bucket of 100,000; there were 14 million such blobs."""
    monkeypatch.setattr(S, "SLICE_BYTES", 2 << 10)  # a thousandth of all sizes
    monkeypatch.setattr(S, "SLICE_MOST", 8 << 10)
    docs = spark.createDataFrame([("x" * 1024,)], "text string").selectExpr(f"explode(array_repeat(text, {gb << 10})) as text")
    slices = (gb << 20) // S.slice_size(docs, "text")
    assert S.bucket_size(slices) / slices >= S.BLOB_ENTRIES
    assert S.slice_size(docs.limit(0), "text") == S.SLICE_BYTES


def test_runs_of_a_slice_do_not_depend_on_its_parts(monkeypatch):
    r = np.random.default_rng(4)
    texts = [bytes(r.choice(list(b"ab c"), n)) for n in (0, 10, 49, 50, 300, 0, 700, 51, 2000, 64)]
    texts += [texts[6] + b"x" + texts[4], texts[8][100:900]]
    s = S.Slice(range(len(texts)), [len(x) for x in texts], S.zipped(b"".join(texts)))
    whole = suffixes.Runs(s, 50, 24)
    at = np.flatnonzero(np.concatenate([np.arange(len(x)) + 50 <= len(x) for x in texts]))
    doc = s.document_at(at)
    first, number, _ = suffixes.distinct_by_part(s, at, doc, 50)
    assert len(first) == len({s.raw[p:p + 50] for p in at.tolist()})
    monkeypatch.setattr(S, "SLICE_BYTES", 400)
    assert len(list(s.parts())) > 3
    parts = suffixes.Runs(s, 50, 24)
    for c in ("start", "stop", "document", "h", "r", "second"):
        assert getattr(whole, c).tolist() == getattr(parts, c).tolist(), c
    first, number, content = suffixes.distinct_by_part(s, at, doc, 50)
    assert [s.raw[p:p + 50] for p in at[first][number].tolist()] == [s.raw[p:p + 50] for p in at.tolist()]
    assert len(content) == len(first) and len(set(content.tolist())) == len({s.raw[p:p + 50] for p in at[first].tolist()})


def test_dedup_in_slices_of_several_parts(spark, pair, monkeypatch):
    want = rows(suffixes.dedup(pair))
    monkeypatch.setattr(S, "SLICE_BYTES", 700)
    monkeypatch.setattr(S, "slice_size", lambda docs, text: 5000)
    monkeypatch.setattr(S, "bucket_size", lambda slices: 300)
    monkeypatch.setattr(suffixes, "SORTED", 500)
    key = lambda x: repr(sorted(x.items()))
    assert sorted(rows(suffixes.dedup(pair, hot=50)), key=key) == sorted(want, key=key)
