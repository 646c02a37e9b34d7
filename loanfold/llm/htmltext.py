"""Main text of web pages by two passes of block rules: density of stop words, length and density of links."""

import html
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Frequent function words of the languages.
STOP_WORDS = {
    "en": "a about after all also an and are as at be been but by can for from had has have he her his if in into is it its more "
          "no not of on one or other our she so some such than that the their them there they this to up was we were what when "
          "which who will with would you",
    "de": "aber als am an auch auf aus bei bin bis da das dass dem den der des die durch ein eine einem einen einer es für hat "
          "ich ihr im in ist ja kann mit nach nicht noch nur oder sich sie sind so über um und uns vom von vor war was wenn wie "
          "wir wird zu zum zur",
    "fr": "au aux avec ce ces cette comme dans de des du elle en est et eu il ils je la le les leur lui mais me même ne nous on "
          "ont ou par pas plus pour qu que qui sa sans se ses son sont sur un une vous y à été",
    "es": "a al como con de del desde donde el ella en entre era es esta este ha hay la las le lo los más me muy no nos o para "
          "pero por que se ser si sin sobre son su sus también un una y ya",
}
STOPS = [frozenset(words.split()) for words in STOP_WORDS.values()]

# Elements by their part in a page.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center datalist dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead title tr ul".split())
RAW = frozenset("script style textarea title template iframe noframes noembed xmp svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset("article main".split())
ASIDE = frozenset("nav footer aside form menu dialog select button fieldset head noscript datalist".split())
#: Words in class, id or role that mark what surrounds an article.
AROUND = re.compile(
    r"(?:^|[\s_-])(?:ads?|adsbygoogle|adslot|adunit|advert\w*|alert|banner|breadcrumbs?|comments?|commentlist|consent|cookies?|"
    r"complementary|contentinfo|disclaimer|discussion|disqus\w*|footer|gdpr|menu|modal|nav|navbar|navigation|newsletter|notices?|"
    r"notification|outbrain|overlay|paywall|popover|popup|privacy|promo\w*|related|replies|respond|responses?|search|share|"
    r"sharing|sidebar|social|sponsor\w*|subscribe|taboola|toast|toolbar|widget)(?:$|[\s_-])", re.I)
#: Inside an article most such words may be its subject. There only a whole name of a container says that it is no part of it.
APART = re.compile(
    r"(?:^|\s)(?:(?:\w+[_-])?comments?(?:[_-]?(?:area|box|form|list|section|thread|wrap\w*))?|commentlist|disqus\w*|respond|replies|"
    r"ads?|adsbygoogle|ad[_-]?(?:box|slot|unit|wrap\w*)|advert\w*|sponsored|promo|newsletter(?:[_-]\w+)?|outbrain|taboola|paywall|"
    r"related(?:[_-](?:articles|content|links|posts|stories))?|(?:social[_-])?(?:share|sharing)(?:[_-](?:bar|buttons|links|this))?|"
    r"social[_-](?:bar|buttons|icons|links|media)|cookie[_-]\w+|consent|gdpr|sidebar|breadcrumbs?|toolbar|nav|navbar|navigation|"
    r"pagination)(?:$|\s)", re.I)
#: Elements that hold text of an article whatever their names say.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote td th dd dt figcaption caption hgroup".split())
#: The same as AROUND for what only counts outside an article, where it is the page's own.
TOP = re.compile(r"(?:^|[\s_-])(?:header|masthead|topbar)(?:$|[\s_-])", re.I)
#: Names of elements that stand for an article element.
MAIN_NAMED = re.compile(r"(?:^|\s)(?:main|(?:article|entry|main|page|post|story)[_-]?(?:body|content|text))(?:$|\s)", re.I)
NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none""", re.I)
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/<>]*)((?>[^<>"']+|"[^"]*"|'[^']*'){0,200}+)>|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)>""", re.S)

SHORT, LONG = 70, 200
FEW_STOPS, MANY_STOPS = 0.12, 0.2
MANY_LINKS, FEW_LINKS = 0.5, 0.2
#: Signs that stand for a word or a good part of one; they count three times where lengths are compared.
WIDE = re.compile("[\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]")
GOOD, NEAR, SMALL, BAD = "good", "near", "short", "bad"


@dataclass
class Block:
    """A run of text without a block element inside: its text, share of linked characters and place in the page."""

    text: str
    links: float
    around: bool
    main: int  # number of the article it stands in, 0 for none
    heading: bool
    code: bool = False  # keeps its lines: code, tables of figures, verse

    @property
    def size(self) -> int:
        return len(self.text) + 2 * len(WIDE.findall(self.text))


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order, character references decoded and white space made single spaces."""
    found: list[Block] = []
    stack: list[tuple[str, bool, int]] = []  # open block elements: name, around the article, article number
    open_names: Counter[str] = Counter()  # of the stack, so that an end without a beginning costs nothing
    parts: list[str] = []
    linked: list[str] = []
    links = mains = at = 0

    def end_block() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            in_links = len(" ".join(html.unescape("".join(linked)).split()))
            _, around, main = stack[-1] if stack else ("", False, 0)
            heading = bool(stack) and stack[-1][0] in ("h1", "h2", "h3", "h4", "h5", "h6")
            found.append(Block(text, in_links / len(text), around, main, heading, open_names["pre"] > 0))
        parts.clear()
        linked.clear()

    def add(text: str) -> None:
        parts.append(text)
        if links:
            linked.append(text)

    while m := TAG.search(page, at):
        add(page[at:m.start()])
        at = m.end()
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if name == "a":
            links = 0 if closing else 1
        elif name == "br":
            add(" ")
        elif name in RAW and not closing and not attributes.endswith("/"):
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
        elif name in BLOCKS:
            end_block()
            links = 0
            if closing:
                while open_names[name]:
                    last = stack.pop()[0]
                    open_names[last] -= 1
                    if last == name:
                        break
            elif name not in VOID:
                if stack and stack[-1][0] in ("p", "h1", "h2", "h3", "h4", "h5", "h6") or stack and stack[-1][0] == name == "li":
                    open_names[stack.pop()[0]] -= 1
                _, around, main = stack[-1] if stack else ("", False, 0)
                names = " ".join(x[1] or x[2] or x[3] or "" for x in NAMED.finditer(attributes)) if attributes else ""
                if name in ("html", "body"):
                    names = ""
                if not main and (name in MAIN or (not around and MAIN_NAMED.search(names))):
                    mains += 1
                    around, main = False, mains
                named = name not in TEXTUAL and APART.search(names) if main else AROUND.search(names)
                around = bool(around or name in ASIDE or named or (attributes and HIDDEN.search(attributes))
                              or (not main and (name == "header" or TOP.search(names))))
                stack.append((name, around, main))
                open_names[name] += 1
    add(page[at:])
    end_block()
    return found


def stop_share(text: str) -> float:
    """Share of stop words, in the language that has most of them."""
    words = [w.strip(".,;:!?\"'()[]«»„“”…-") for w in text.lower().split()]
    return max(sum(w in stops for w in words) for stops in STOPS) / len(words)


def language_fits(found: list[Block]) -> bool:
    """Whether the page's running text is in a listed language, so that stop words can tell it from the rest."""
    running = " ".join(b.text for b in found if b.size >= SHORT and b.links <= MANY_LINKS and not b.around)
    return bool(running) and stop_share(running) >= MANY_STOPS


def first_pass(block: Block, listed: bool) -> str:
    """The label of a block by itself. listed: stop words count; in other languages length and links alone decide."""
    if block.around or "\N{COPYRIGHT SIGN}" in block.text[:40] and len(block.text) < LONG and not block.main:
        return BAD
    if block.size < SHORT:
        return BAD if block.links >= 1 else SMALL
    if block.links > MANY_LINKS:
        return BAD
    if block.code:
        return SMALL
    if not listed:
        return GOOD if block.size > LONG else NEAR
    share = stop_share(block.text)
    if share >= MANY_STOPS:
        return GOOD if block.size > LONG else NEAR
    return NEAR if share >= FEW_STOPS else SMALL if block.main or block.links < FEW_LINKS else BAD


def classified(found: list[Block]) -> list[bool]:
    """Second pass: whether each block is main text; undecided blocks take the label of their nearest decided neighbours.

    The nearest decided block before and after count; of two that differ, a near-good block takes the good one, a heading the
    one after it, and any other the nearer one, bad if equally far. The edge of a page counts as bad, but says nothing about a
    near-good block; in a page without a good block near-good ones are the text. Inside an article only blocks of the same
    article count, and its edge counts as good: what surrounds it says nothing about it.
    """
    listed = language_fits(found)
    first = [first_pass(b, listed) for b in found]
    if GOOD not in first and not any(b.main for b in found):
        first = [GOOD if label == NEAR else label for label in first]
    n = len(found)
    before, after = [(None, i + 1) for i in range(n)], [(None, n - i) for i in range(n)]

    def sweep(order, near) -> None:
        last = None
        for i in order:
            main = found[i].main
            if last is not None and last[2] == main:
                near[i] = (last[0], abs(i - last[1]))
            elif main:
                near[i] = (True, n)
            # What is set apart inside an article decides nothing about the rest of it.
            if first[i] in (GOOD, BAD) and not (main and found[i].around):
                last = (first[i] == GOOD, i, main)
            elif last is not None and last[2] != main:
                last = None if main else last

    sweep(range(n), before)
    sweep(range(n - 1, -1, -1), after)
    out = []
    for block, label, (left, to_left), (right, to_right) in zip(found, first, before, after):
        if label in (GOOD, BAD):
            out.append(label == GOOD)
        elif label == NEAR:
            out.append(bool(left or right) or left is None and right is None)
        elif bool(left) == bool(right):
            out.append(bool(left))
        elif block.heading:
            out.append(bool(right))
        elif block.main:
            out.append(bool(left or right))
        else:
            out.append(bool(left if to_left < to_right else right if to_right < to_left else False))
    return out


def main_text(page: str | None) -> str:
    """The main text of a page: its good blocks in order, one to a line. Linear in the page, whatever is open or unclosed in it."""
    found = blocks(page or "")
    return "\n".join(b.text for b, good in zip(found, classified(found)) if good)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each page; the whole html is read.

    NULL or empty html, and pages without main text, give an empty text. Every page is read by itself: repeated and NULL
    page_ids and urls stay rows of their own. Other columns are ignored. An empty table gives no rows.
    """

    @F.arrow_udf("string")
    def text_of(htmls: pa.Array) -> pa.Array:
        return pa.array([main_text(h) for h in htmls.to_pylist()], pa.string())

    read = pages.select("page_id", "url", text_of("html").alias("text"))
    return read.withColumn("n_chars", F.length("text").cast("long"))
