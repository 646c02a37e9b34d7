import random
import re

import pytest
from pyspark.sql import functions as F

from loanfold.llm import quotes

TABLE = "conv_id long, turn long, role string, text string, level string, hash string, root string, lines string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], TABLE).repartition(3)


def lines(text):
    out = []
    for line in re.split("\r?\n", text or ""):
        m = re.match(r"(?:[ \t]{0,3}>)+", line)
        out.append((m[0].count(">") if m else 0, re.sub(r"^(?:[ \t]{0,3}>)+[ \t]?", "", line)))
    return out


def plain(rows):
    norm = lambda s: " ".join(re.findall(r"[^\W_]+", s.lower()))
    first = {}
    for c, t, _, text in rows:
        for level, body in lines(text):
            if level == 0 and norm(body) and c is not None and t is not None:
                key = c, norm(body)
                first[key] = min(first.get(key, t), t)
    votes = {}
    for c, t, _, text in rows:
        for level, body in lines(text):
            o = first.get((c, norm(body)))
            if level and o is not None and t is not None and o < t:
                votes.setdefault((c, t), {}).setdefault(o, 0)
                votes[c, t][o] += level == 1
    parent = {k: max((n, o) for o, n in v.items())[1] for k, v in votes.items() if any(v.values())}
    out = []
    for c, t, role, text in rows:
        root, depth = t, 0
        while (c, root) in parent:
            root, depth = parent[c, root], depth + 1
        split = lines(text)
        own = [b for k, (level, b) in enumerate(split) if level == 0 and not (
            k + 1 < len(split) and split[k + 1][0] > 0 and re.search(quotes.SAYS, b))]
        out.append((c, t, role, parent.get((c, t)), sorted(votes.get((c, t), {})), root, depth, "\n".join(own).strip()))
    return sorted(out, key=repr)


def talk(n, seed=3):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        said = []
        for t in range(rng.randrange(1, 9)):
            text = [f"Line {rng.randrange(50)} of talk, number {rng.randrange(9)}." for _ in range(rng.randrange(1, 4))]
            if said and rng.random() < 0.7:
                old = rng.choice(said)
                mark = rng.choice(["> ", ">", " > "])
                text = ["On Monday, Ann wrote:"] * rng.randrange(2) + [mark + x.upper() for x in old.split("\n")] + [""] + text
            said.append("\n".join(text))
            rows.append((c, t, "user", said[-1]))
    return rows


def test_as_by_brute_force(spark):
    rows = talk(40) + [(90, 1, "user", None), (90, 2, None, ""), (None, 1, "user", "hello there"), (None, 2, "user", "> hello there"),
                       (91, None, "user", "alone here"), (91, 3, "user", "> alone here\nsure"), (92, 1, "a", "same"), (92, 1, "a", "same"),
                       (92, 2, "b", "> same\r\n>> same\n> > older\nyes"), (93, 0, "a", "word " * 50_000), (93, 1, "b", "> " + "word " * 50_000)]
    found = quotes.link(frame(spark, rows)).collect()
    mine = sorted(((r.conv_id, r.turn, r.role, r.reply_to, list(r.quoted), r.root, r.depth, r.text) for r in found), key=repr)
    assert mine == plain(rows)
    for conv in {r.conv_id for r in found}:
        in_order = sorted((r for r in found if r.conv_id == conv), key=lambda r: r.position)
        assert [r.position for r in in_order] == list(range(1, len(in_order) + 1))
        key = [(r.root is not None, r.root or 0, r.turn is not None, r.turn or 0) for r in in_order]
        assert key == sorted(key)


@pytest.mark.parametrize("rows", [[], talk(3)])
def test_long_chain_and_empty_table(spark, rows):
    chain = [(500, t, "u", f"message {t}" + (f"\n> message {t - 1}" if t else "")) for t in range(70)]
    found = {(r.conv_id, r.turn): r for r in quotes.link(frame(spark, chain + rows)).collect()}
    assert all(found[500, t].depth == t and found[500, t].root == 0 for t in range(70))
    assert quotes.link(frame(spark, chain).filter("false")).collect() == []


def test_long_lines_and_marks(spark):
    """A line of a million marks, one of a million spaces, and one that a long run of spaces ends."""
    million = 10 ** 6
    rows = [(1, 0, "a", "first words"), (1, 1, "b", ">" * million + " first words\nmine"), (1, 2, "c", " " * million), (1, 3, "d", "x" + " " * million + "y"),
            (1, 4, "e", "> first words\n" + " \t" * (million // 2) + "end" + " \n" * (million // 2)), (1, 5, "f", "wrote " * (million // 6))]
    found = {r.turn: r for r in quotes.link(frame(spark, rows)).collect()}
    assert found[1].text == "mine" and list(found[1].quoted) == [0] and found[2].text == "" and found[4].text == "end"
    assert len(found[3].text) == million + 2 and found[4].reply_to == 0 and found[5].text == ("wrote " * (million // 6)).strip()


def test_one_conversation_holds_most_rows(spark):
    """Everybody in one large conversation quotes the same message; no task gets all of it."""
    rows = [(7, 0, "u", "the first message of all")] + [(7, t, "u", f"> the first message of all\nanswer {t}") for t in range(1, 3001)]
    rows += [(c, t, "u", f"hello {c}") for c in range(100, 1100) for t in range(3)]
    for setting in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(setting, "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = quotes.link(frame(spark, rows))
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) < 2400 and sum(sizes) == len(rows)
        large = found.filter("conv_id = 7").collect()
        assert sorted(r.position for r in large) == list(range(1, 3002)) and all(r.reply_to == 0 and r.depth == 1 for r in large if r.turn)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_rewrapped_and_partial_quotes(spark):
    first = ("The river rose over night and took the old bridge with it. Nobody was hurt. "
             "We will need a boat for the rest of the week, and somebody who can row it.")
    wrapped = "The river rose over night\nand took the old bridge with it. Nobody\nwas hurt. We will need a boat for\nthe rest of the week, and somebody\nwho can row it."
    rows = [(1, 0, "a", first), (1, 1, "b", "Something else was said here.\nNo mark at the end"),
            (1, 2, "c", "".join(f"> {x}\n" for x in wrapped.split("\n")) + "I can row."),
            (1, 3, "d", "> Nobody was hurt.\nGood."),
            (1, 4, "e", "> No mark at the end\nIndeed."),
            (1, 5, "f", ">> Nobody\n>> was hurt.\n> Good.\nYes."),
            (2, 0, "a", wrapped), (2, 1, "b", "> " + first), (2, 2, "c", "> never written\nno")]
    found = {(r.conv_id, r.turn): (r.reply_to, list(r.quoted), r.root, r.depth) for r in quotes.link(frame(spark, rows)).collect()}
    assert found == {(1, 0): (None, [], 0, 0), (1, 1): (None, [], 1, 0), (1, 2): (0, [0], 0, 1), (1, 3): (0, [0], 0, 1),
                     (1, 4): (1, [1], 1, 1), (1, 5): (3, [0, 3], 0, 2),
                     (2, 0): (None, [], 0, 0), (2, 1): (0, [0], 0, 1), (2, 2): (None, [], 2, 0)}
