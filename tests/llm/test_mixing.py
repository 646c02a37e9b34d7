import hashlib
import math
import re

import pytest

from loanfold.llm import mixing
from tests.llm.helpers import documents


def plain(rows, weights=(5, 2, 1), most=3):
    digest = lambda x: hashlib.md5(x.encode()).hexdigest()
    sized = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), digest(t or "")) for i, t, s in rows]
    names = sorted({r[1] for r in sized if r[1] is not None}) + [None] * any(r[1] is None for r in sized)
    size = {s: sum(r[2] for r in sized if r[1] == s) for s in names}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = sum(size.values()), set()
    while True:
        rest = total - sum(most * size[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        target = {s: float(most * size[s]) if s in full else rest * weight[s] / share for s in names}
        over = {s for s in names if s not in full and target[s] >= most * size[s]}
        if not over or share == 0 or over | full == set(names):
            target = {s: min(target[s], float(most * size[s])) for s in names}
            break
        full |= over
    out = []
    for s in names:
        left = math.floor(target[s] + 0.5)
        whole = left // size[s] if size[s] else 0
        left -= whole * size[s]
        key = lambda r: (digest(f"mix:{'' if r[0] is None else r[0]}:{r[3]}")[:15], r[0] or 0, r[2])
        for i, _, n, _ in sorted((r for r in sized if r[1] == s), key=key):
            out.append((i, s, n, size[s], target[s], whole * n + max(0, min(left, n))))
            left -= n
    return sorted(out, key=repr)


ROWS = [(i, "w " * (i * 7 % 23), f"s{i % 3}") for i in range(90)]
ODD = [(91, None, "s0"), (92, "", None), (93, "a b\x0bc d", None), (None, "x y", "s1"), (None, None, None), (5, "again " * 4, "s2"),
       (94, "big " * 60_000, "ä"), (95, "", "empty source"), (96, "z", "Z")]


HOT = [(i, "w " * (i % 9), "hot" if i % 3 else f"s{i % 7}") for i in range(240)]  # one source holds most rows


@pytest.mark.parametrize("rows", [ROWS, ROWS + ODD, HOT, [(1, "", "a")], [(1, "one", "a"), (2, "two 2", "b")]])
def test_as_by_brute_force(spark, rows):
    found = mixing.mix(documents(spark, rows, extra=True)).collect()
    mine = sorted(((r.doc_id, r.source, r.size, r.source_size, r.target, r.taken) for r in found), key=repr)
    expected = plain(rows)
    assert [x[:4] + x[5:] for x in mine] == [x[:4] + x[5:] for x in expected]
    assert [x[4] for x in mine] == pytest.approx([x[4] for x in expected])
    assert all(0 <= r.taken <= 3 * r.size for r in found)
    assert sum(r.target for r in {r.source: r for r in found}.values()) == pytest.approx(sum(r.size for r in found))


def test_epochs_add_up(spark):
    mixed = mixing.mix(documents(spark, ROWS + ODD))
    words = {r.doc_id: r.n for r in mixing.epochs_of(mixed).groupBy("doc_id").sum("words").toDF("doc_id", "n").collect()}
    assert words == {r.doc_id: r.n for r in mixed.groupBy("doc_id").sum("taken").toDF("doc_id", "n").filter("n > 0").collect()}


def test_empty_table(spark):
    assert mixing.mix(documents(spark, []).filter("false")).collect() == []


def test_rows_of_one_or_no_doc_id_lie_apart(spark):
    rows = [(None if i % 3 else 7, f"w{i} " * (i % 5) + str(i), "hot") for i in range(900)]
    docs = documents(spark, rows)
    places = [r.at for r in docs.select(mixing.hash_order("doc_id", "text", "mix").alias("at")).collect()]
    slices = [p * 30 >> 60 for p in places]
    assert len(set(places)) == 900 and max(slices.count(k) for k in range(30)) < 60
    found = mixing.mix(docs).collect()
    assert sorted(((r.doc_id, r.source, r.size, r.source_size, r.target, r.taken) for r in found), key=repr) == plain(rows)
