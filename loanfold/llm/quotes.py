"""Quotation linking: quoted lines joined to the messages that first wrote them, conversations in reply order."""

from pyspark.sql import DataFrame, functions as F

from ..operators.sequence import global_sequence
from ..operators.skew import join_to_unique
from .common import saved

#: Up to three spaces before a quote mark, as often as there are levels. Possessive: it takes no stack, however many there are.
MARKS = r"^(?:[ \t]{0,3}+>)++"
#: A line such as "On Monday, Ann wrote:", which goes with the quote below it.
SAYS = r"(?i)(wrote|writes|said|schrieb|écrit|escribió)\s*:\s*$"

#: Where a sentence ends: after its mark and before white space, or after a wide mark.
SENTENCE_END = r"(?<=[.!?…])\s+|(?<=[。！？])"
#: Before each block of lines, and between its level and its lines; texts lose these signs.
BLOCK, LEVEL = "\x01", "\x02"


def normalised(line):
    """Lower-case words of a line, one space between them."""
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def parsed(messages: DataFrame) -> DataFrame:
    """Messages with lines, an array of (level, body): level 0 is own text, 1 a quote, 2 a quote in a quote."""
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\r?\n"), lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]", "")).alias("level"),
        F.regexp_replace(x, MARKS + "[ \t]?", "").alias("body")))
    return messages.withColumn("lines", lines)


def blocks(lines):
    """Adjacent lines of one level without a blank line between them, as (level, body): lines and joined text of a passage."""
    def marked(x, i):
        body = F.translate(x["body"], BLOCK + LEVEL, "  ")
        before = F.get(lines, i - 1)
        goes_on = (i > 0) & (before["level"] == x["level"]) & (F.trim(before["body"]) != "") & (F.trim(x["body"]) != "")
        return F.when(goes_on, F.concat(F.lit("\n"), body)).otherwise(
            F.concat(F.lit(BLOCK), x["level"].cast("string"), F.lit(LEVEL), body))

    return F.transform(F.split(F.array_join(F.transform(lines, marked), ""), BLOCK), lambda b: F.struct(
        F.substring_index(b, LEVEL, 1).try_cast("int").alias("level"), F.substring_index(b, LEVEL, -1).alias("body")))


def units(body):
    """Normalised lines of a block, and its sentences that are no line, so that breaking lines anew leaves the sentences."""
    whole = F.filter(F.transform(F.split(body, "\n"), normalised), lambda x: x != "")
    sentences = F.filter(F.transform(F.split(body, SENTENCE_END), normalised), lambda x: x != "")
    return F.concat(whole, F.array_except(sentences, whole))


def link(messages: DataFrame) -> DataFrame:
    """Conversations in reply order, without quotes.

    Per message: conv_id, turn, role, reply_to, quoted (turns of all messages it quotes, ascending), root (first turn of
    its thread), depth (replies from the root), position (from 1 in the conversation: threads by their roots, messages
    of a thread by turn) and text (its own lines, trimmed).

    A passage is a line, or a sentence of adjacent lines of one level joined; its hash is that of its normalised words. So a
    quote that is broken into other lines, or takes whole sentences out of a longer line, shares its sentences with its
    original; a part of a sentence is a passage only where it is a line of both. The original of a passage is the first
    message of the conversation that wrote it unquoted, and has to come before the quote. reply_to is the original of most passages quoted
    at level 1, the latest of equal ones. A line that announces a quote right below it belongs to the quote.

    Rows without conv_id or turn link to nothing; rows without conv_id are ordered as one conversation, rows without
    turn come first. Rows that repeat conv_id and turn share their links and stay rows of their own. NULL text is
    empty. Other columns are ignored. An empty table gives no rows.

    Originals are counted per passage before the join, so a line that everybody writes is one row per conversation, and no pairs
    of messages are formed. A conversation of any size is spread by passage, and by range for its order; a passage, a thread or a
    conversation that holds a large share of the rows is spread over several tasks where it is joined.
    """
    lined = saved(parsed(messages.select("conv_id", "turn", "role", "text")), "lines")
    each = lined.filter("conv_id IS NOT NULL AND turn IS NOT NULL").select(
        "conv_id", "turn", F.explode(blocks(F.col("lines"))).alias("block")).filter("block.level IS NOT NULL")
    passages = each.select("conv_id", "turn", "block.level", F.explode(units(F.col("block.body"))).alias("words"))
    passages = passages.select("conv_id", "turn", "level", F.md5("words").alias("hash"))
    written = passages.filter("level = 0").groupBy("conv_id", "hash").agg(F.min("turn").alias("original"))
    cited = saved(passages.filter("level > 0"), "quoted-passages")
    quoted = join_to_unique(cited, written, ["conv_id", "hash"], "inner").filter("original < turn")
    votes = quoted.groupBy("conv_id", "turn", "original").agg(F.count(F.when(F.col("level") == 1, 1)).alias("votes"))
    links = saved(votes.groupBy("conv_id", "turn").agg(
        F.max(F.when(F.col("votes") > 0, F.struct("votes", "original")))["original"].alias("reply_to"),
        F.sort_array(F.collect_set("original")).alias("quoted")), "links")
    threads = roots(links.filter("reply_to IS NOT NULL").select("conv_id", "turn", "reply_to"))

    last = F.size("lines")
    own = F.filter(F.transform("lines", lambda x, i: F.struct(
        x["level"].alias("level"), x["body"].alias("body"),
        ((i + 1 < last) & (F.get("lines", i + 1)["level"] > 0) & x["body"].rlike(SAYS)).alias("says"))),
        lambda x: (x["level"] == 0) & ~x["says"])
    text = F.trim(F.array_join(F.transform(own, lambda x: x["body"]), "\n"), F.lit(" \t\n\x0b\f\r"))
    joined = lined.select("conv_id", "turn", "role", text.alias("text")).join(links, ["conv_id", "turn"], "left").join(
        threads, ["conv_id", "turn"], "left")
    placed = joined.select("conv_id", "turn", "role", "reply_to", F.coalesce("quoted", F.array().cast("array<long>")).alias("quoted"),
                           F.coalesce("root", "turn").alias("root"), F.coalesce("depth", F.lit(0)).alias("depth"), "text")
    numbered = global_sequence(placed, ["conv_id", "root", "turn", "role", "text"], "nth")
    named = numbered.withColumns({"none": F.col("conv_id").isNull(), "of": F.coalesce("conv_id", F.lit(0))})
    out = join_to_unique(named, named.groupBy("none", "of").agg(F.min("nth").alias("begin")), ["none", "of"])
    return out.select("conv_id", "turn", "role", "reply_to", "quoted", "root", "depth", (F.col("nth") - F.col("begin") + 1).alias("position"), "text")


def roots(replies: DataFrame) -> DataFrame:
    """First message and depth of each reply's thread: conv_id, turn, root, depth.

    Each round every message jumps to where the message it points at pointed, so the rounds grow with the logarithm of
    the longest chain of replies.
    """
    at = replies.select("conv_id", "turn", F.col("reply_to").alias("root"), F.lit(1).alias("depth"))
    while True:
        at = saved(at, "threads")
        next_ = at.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("above"), F.col("depth").alias("more"))
        if at.join(next_, ["conv_id", "root"], "left_semi").isEmpty():
            return at
        at = join_to_unique(at, next_, ["conv_id", "root"]).select(
            "conv_id", "turn", F.coalesce("above", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
