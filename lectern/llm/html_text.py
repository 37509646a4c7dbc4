"""Main text of web pages by two passes of block rules.

A page is cut into blocks at its block tags. The first pass decides blocks by where they
stand (menus, headers, footers, sidebars, notices, adverts, forms and reader comments go,
and so does what lies beside an article where the page marks one), by the share of text
in links, by length, and by the share of stop words of the page's own language. The
second pass gives each block left open, mostly a short one, the label of the decided
neighbours: theirs if both agree, else the nearer one's. Inside a marked article only
neighbours of the same article count, and with none decided the article stays.

Kept blocks have their character references decoded and white space turned into single
spaces, and are joined in page order. The whole page is read, in time linear in its
length; pages are independent, so nothing is shuffled.

Defined cases: null or empty html, and a page without a kept block, give empty text;
unclosed tags, comments and quotes end where the page ends; repeated rows are repeated;
an empty table stays empty; added columns (text, n_chars) replace columns of the same
names.
"""

from __future__ import annotations

import html as references
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Common words by language.
STOP_WORDS = {
    "en": "a an and are as at be but by for from had has have he her his i in is it its not of on or "
    "she that the their they this to was were which who will with you".split(),
    "de": "als am an auch auf aus bei das dem den der des die ein eine einer er es für hat ich im in ist "
    "mit nach nicht noch sich sie sind so über um und von war wie wird zu zum zur".split(),
    "fr": "à au aux avec ce ces cette dans de des du elle en est et il ils la le les leur mais ne nous ou "
    "par pas plus pour qu que qui sa se ses son sur un une vous".split(),
    "es": "a al como con de del el ella en entre es esta este está fue ha la las le lo los más no o para "
    "pero por que se sin sobre son su sus un una y ya".split(),
}
# Tags.
BLOCK_TAGS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option "
    "p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
SKIPPED_TAGS = set(
    "script style title noscript template textarea iframe svg math object select button canvas audio video "
    "noembed noframes".split()
)
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "head"}
ARTICLE_TAGS = {"article", "main"}
HELD_TAGS = BLOCK_TAGS - {"br", "hr", "p", "li", "dd", "dt", "option"} | {"span", "a"}
# Words of class, id and role attributes.
BOILERPLATE_NAMES = set(
    "ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs bylinks comment "
    "comments complementary consent contentinfo cookie cookies copyright dialog disclaimer discussion "
    "disqus feedback foot footer gdpr legal login masthead menu modal nav navbar navigation newsletter "
    "notice notification pager pagination popup promo promoted promotion recommended related replies reply "
    "respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar "
    "topbar tracking warning widget".split()
)
HEADER_NAMES = {"header", "site-header", "page-header"}
ARTICLE_NAMES = set(
    "article articlebody article-body article-content content entry entry-content main main-content "
    "page-content post post-body post-content story story-body".split()
)

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attributes2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
HIDDEN = re.compile(
    r"""(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE
)
WORDS = re.compile(r"[^\W\d_]+")


@dataclass
class Rules:
    """Thresholds; lengths in characters, the rest in shares."""

    short: int = 70
    long: int = 200
    link_share: float = 0.33
    article_link_share: float = 0.6
    few_stops: float = 0.12
    many_stops: float = 0.2


@dataclass
class Block:
    text: str
    links: int
    boilerplate: bool
    article: int
    label: str = ""


def blocks_of(page: str) -> list[Block]:
    """The page's blocks of text, in order. `article` numbers the marked article, 0 is none."""
    found: list[Block] = []
    parts: list[str] = []
    links = 0
    open_tags: list[tuple[str, bool, int]] = []
    n_open: dict[str, int] = {}
    boilerplate, article, in_link, articles = False, 0, 0, 0

    def close_block():
        nonlocal links
        if parts:
            text = " ".join(references.unescape("".join(parts)).split())
            if text:
                found.append(Block(text, min(links, len(text)), boilerplate, article))
            parts.clear()
        links = 0

    def add(text: str):
        nonlocal links
        if text:
            parts.append(text)
            if in_link:
                links += len(text)

    at = 0
    for mark in iter_markup(page):
        start, stop, tag, ends, attributes = mark
        add(page[at:start])
        at = stop
        if tag is None:
            continue
        if tag in BLOCK_TAGS:
            close_block()
        if tag not in HELD_TAGS:
            continue
        if ends:
            if n_open.get(tag):
                while True:
                    name, boilerplate, article = open_tags.pop()
                    n_open[name] -= 1
                    if name == "a":
                        in_link -= 1
                    if name == tag:
                        break
        elif not attributes.rstrip().endswith("/") or tag in ("a", "span", "div"):
            open_tags.append((tag, boilerplate, article))
            n_open[tag] = n_open.get(tag, 0) + 1
            if tag == "a":
                in_link += 1
            names = _names(attributes)
            words = {w for n in names for w in re.split(r"[^a-z0-9]+", n)}
            inside = article or tag in ARTICLE_TAGS
            goes = (
                tag in BOILERPLATE_TAGS
                or bool(words & BOILERPLATE_NAMES)
                or (not inside and (tag == "header" or bool(names & HEADER_NAMES)))
                or bool(attributes and HIDDEN.search(attributes))
            )
            if goes and tag not in ("body", "html"):
                if tag in ("span", "a"):
                    continue
                boilerplate = True
            elif not article and (tag in ARTICLE_TAGS or names & ARTICLE_NAMES):
                articles += 1
                article = articles if tag in ARTICLE_TAGS else -articles
    add(page[at:])
    close_block()
    return found


def _names(attributes: str) -> set[str]:
    if not attributes:
        return set()
    return {n for m in NAMES.finditer(attributes) for n in (m[1] or m[2] or m[3] or "").lower().split()}


def iter_markup(page: str):
    """(start, end, tag or None, is an end tag, attributes); skipped elements as one mark."""
    at = 0
    while mark := MARKUP.search(page, at):
        start, at = mark.span()
        tag = (mark["tag"] or mark["tag2"] or "").lower() or None
        ends = bool(mark["end"] or mark["end2"])
        if tag in SKIPPED_TAGS and not ends:
            close = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = close.end() if close else len(page)
            ends = True
        yield start, at, tag, ends, mark["attributes"] or mark["attributes2"] or ""


def stop_share(words: list[str], stops: frozenset[str]) -> float:
    return sum(w in stops for w in words) / len(words) if words else 0.0


STOPS = {language: frozenset(words) for language, words in STOP_WORDS.items()}


def first_pass(blocks: list[Block], rules: Rules) -> None:
    """Sets labels: good, bad, near (good if a neighbour is), or short."""
    marked = {b.article for b in blocks if b.article > 0 and not b.boilerplate} or {
        b.article for b in blocks if b.article < 0 and not b.boilerplate
    }
    words = [WORDS.findall(b.text.lower()) for b in blocks]
    open_words = [w for b, ws in zip(blocks, words) if not b.boilerplate for w in ws]
    stops = max(STOPS.values(), key=lambda s: stop_share(open_words, s))
    for block, own in zip(blocks, words):
        inside = block.article in marked
        share = block.links / len(block.text)
        density = stop_share(own, stops)
        if block.boilerplate or (marked and not inside):
            block.label = "bad"
        elif share > (rules.article_link_share if inside else rules.link_share):
            block.label = "bad"
        elif len(block.text) < rules.short:
            block.label = "bad" if share and not inside else "short"
        elif inside:
            block.label = "good"
        elif density >= rules.many_stops:
            block.label = "good" if len(block.text) > rules.long else "near"
        else:
            block.label = "near" if density >= rules.few_stops else "bad"
        if not inside:
            block.article = 0


def second_pass(blocks: list[Block]) -> list[bool]:
    """Whether each block stays."""
    decided = [b.label in ("good", "bad") for b in blocks]
    before, after = [-1] * len(blocks), [-1] * len(blocks)
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        before[i] = last.get(b.article, -1)
        if decided[i]:
            last[b.article] = i
    last = {}
    for i in range(len(blocks) - 1, -1, -1):
        after[i] = last.get(blocks[i].article, -1)
        if decided[i]:
            last[blocks[i].article] = i
    keep = []
    for i, b in enumerate(blocks):
        around = [(abs(j - i), j) for j in (before[i], after[i]) if j >= 0]
        labels = {blocks[j].label for _, j in around}
        if decided[i]:
            keep.append(b.label == "good")
        elif not labels or (b.article and "good" not in labels):
            keep.append(bool(b.article) or b.label == "near")
        elif len(labels) == 1:
            keep.append("good" in labels)
        else:
            keep.append(b.label == "near" or blocks[min(around)[1]].label == "good")
    return keep


def main_text(page: str | None, rules: Rules = Rules()) -> str:
    if not page:
        return ""
    blocks = blocks_of(page)
    first_pass(blocks, rules)
    return " ".join(b.text for b, keep in zip(blocks, second_pass(blocks)) if keep)


def extract(pages: DataFrame, column: str = "html", rules: Rules = Rules()) -> DataFrame:
    """All rows and columns of `pages`, with text and n_chars."""

    @F.pandas_udf("string")
    def texts(batch: pd.Series) -> pd.Series:
        return pd.Series([main_text(page, rules) for page in batch], dtype=object)

    kept = [c for c in pages.columns if c not in ("text", "n_chars")]
    made = pages.withColumn("_text", texts(F.col(f"`{column}`")))
    return made.select(
        *[f"`{c}`" for c in kept], F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", "n_chars")
