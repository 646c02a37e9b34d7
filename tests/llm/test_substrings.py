import random

import numpy as np
import pytest

from loanfold.llm import bwt, substrings
from tests.llm.helpers import documents


def plain(rows, window=50):
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in texts:
        own = substrings.LAST if i is None else i
        for p in range(len(t) - window + 1):
            s = t[p:p + window]
            first[s] = min(first.get(s, own), own)
    out = []
    for i, t in texts:
        own = substrings.LAST if i is None else i
        gone = bytearray(len(t))
        for p in range(len(t) - window + 1):
            if first[t[p:p + window]] < own:
                gone[p:p + window] = b"\x01" * window
        spans, p = [], 0
        while p < len(t):
            if gone[p]:
                q = p
                while q < len(t) and gone[q]:
                    q += 1
                spans.append((p, q))
                p = q
            else:
                p += 1
        out.append((i, len(t), spans, bytes(c for c, g in zip(t, gone) if not g)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, list(zip(r.starts, r.ends)), bytes(r.kept)) for r in df.collect()), key=repr)


def corpus(seed=6):
    rng = random.Random(seed)
    base = "".join(rng.choices("abcdefgh é\n", k=900))
    rows = []
    for i in range(60):
        parts = ["".join(rng.choices("abcdefgh ü\x00", k=rng.randrange(0, 90)))]
        for _ in range(rng.randrange(0, 4)):
            a = rng.randrange(0, 850)
            piece = list(base[a:a + rng.randrange(30, 200)])
            if rng.random() < 0.5 and piece:
                piece[rng.randrange(len(piece))] = "X"
            parts += ["".join(piece), "".join(rng.choices("xyz", k=rng.randrange(0, 5)))]
        rows.append((i, "".join(parts)))
    rng.shuffle(rows)
    odd = [(100, None), (101, ""), (102, "short"), (None, base[:120]), (None, base[:120]), (3, base[300:420]), (3, base[300:420]),
           (103, "a" * 400), (104, "a" * 300 + "b"), (105, "ab" * 200), (106, "ba" * 100), (107, base[:50]), (108, base[:49]), (-5, base[10:70])]
    return rows + odd


@pytest.mark.parametrize("block,chunk", [(16 << 20, 1 << 18), (700, 64)])
def test_as_by_brute_force(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(substrings, "CHUNK", chunk)
    rows = corpus()
    assert result(substrings.repeated_substrings(documents(spark, rows, extra=True), block_bytes=block)) == plain(rows)


def test_one_passage_in_most_documents(spark):
    rng = random.Random(12)
    passage = "".join(rng.choices("klmnop ", k=180))
    rows = []
    for i in range(150):
        own = "".join(rng.choices("abcdefghij", k=rng.randrange(0, 80)))
        cut = rng.randrange(0, 60) if i % 3 else 0
        rows.append((i, own + passage[cut:] + own[::-1]))
    assert result(substrings.repeated_substrings(documents(spark, rows), block_bytes=4000)) == plain(rows)


@pytest.mark.parametrize("split,block", [(1, 3000), (16, 9000), (16, 8 << 20)])
def test_hot_anchors_are_split(spark, split, block):
    rng = random.Random(3)
    passage = "".join(rng.choices("klmnop ", k=140))
    rows = []
    for i in range(240):
        own = "".join(rng.choices("abcdefghij", k=rng.randrange(30, 60)))
        rows.append((i, own + passage[rng.choice([0, 0, 7]):] + (own[::-1] if i % 5 else own[:9])))
    rows += [(300, rows[3][1]), (300, rows[4][1]), (None, rows[5][1]), (None, passage), (301, None)]
    found = result(substrings.repeated_substrings(documents(spark, rows), block_bytes=block, split=split))
    assert found == plain(rows)


def test_windows_of_a_hot_anchor_go_to_many_keys():
    rng = random.Random(4)
    passage = "".join(rng.choices("klmnop ", k=120)).encode()
    texts = ["".join(rng.choices("abcdefghij", k=40)).encode() + passage for _ in range(5000)]
    data = substrings.packed(np.arange(5000), np.array([len(t) for t in texts]), np.frombuffer(b"".join(texts), np.uint8))
    block = substrings.Block(data, 40, 50)
    most, hot, masks = 0, 0, {}
    for bucket, row in block.prints():
        _, several, kinds = substrings.unpacked(row, np.uint32, np.bool_, np.uint32)
        most, hot = max(most, int(kinds.max())), hot + int((kinds > 256).sum())
        parts = np.where(kinds > 256, np.ceil(np.log2(kinds * 27 / 256)), 0)
        masks[bucket] = substrings.packed(np.where(several, 1 + parts, 0).astype(np.uint8))
    assert 4000 < most <= 5000 and hot < 20  # only anchors at the passage's edge
    block.keep_repeated(masks)
    pieces, number = block.pieces()
    _, counts = np.unique((pieces.bucket << 32) | pieces.key, return_counts=True)
    assert counts.max() < 600 and len(set(pieces.bucket.tolist())) == 40
    assert len(number) == len(block.run_first)


def test_long_text_and_shorter_window(spark):
    rows = [(1, "no repeats here at all, just text that goes on for a while 0123456789"), (2, "xy" * 150_000), (3, "z" + "xy" * 100)]
    found = result(substrings.repeated_substrings(documents(spark, rows)))
    assert [r[2] for r in found] == [[], [], [(1, 201)]]
    rows = corpus(9)[:30]
    assert result(substrings.repeated_substrings(documents(spark, rows), window=31)) == plain(rows, 31)


def test_empty_table(spark):
    assert substrings.repeated_substrings(documents(spark, []).filter("false")).collect() == []


def test_refined_interleave_groups_equal_prefixes():
    rng = np.random.default_rng(1)
    sizes = rng.integers(6, 12, 80)
    strings = rng.integers(97, 99, int(sizes.sum())).astype(np.uint8)
    owner, shard = rng.integers(0, 1000, 80), rng.integers(0, 5, 80)
    found = bwt.least_owners(strings, sizes, shard, owner, 5)
    least, each = {}, []
    for s, n, o in zip(np.split(strings, np.cumsum(sizes)[:-1]), sizes, owner):
        for p in range(n - 4):
            w = s[p:p + 5].tobytes()
            each.append(w)
            least[w] = min(least.get(w, 1 << 60), o)
    assert found.tolist() == [least[w] for w in each]


def test_interleave_of_whole_suffixes_is_their_sorted_order():
    parts = [[b"banana", b"ananas"], [b"bandana", b"nab"], [b"an"]]
    shards = [bwt.ShardTransform(np.frombuffer(b"".join(p), np.uint8), np.array([len(x) for x in p])) for p in parts]
    rows, group = bwt.merge(shards, 8)
    suffixes = [p[t.string[i]][t.offset[i]:] for t, p in zip(shards, parts) for i in range(len(t.symbols))]
    order = [suffixes[r] for r in rows]
    assert order == sorted(order)
    assert [a == b for a, b in zip(order, order[1:])] == [a == b for a, b in zip(group, group[1:])]
