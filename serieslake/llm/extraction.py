"""Main text of web pages by two passes of block rules.

The markup is cut into blocks.  Pass one decides by what is measurable: blocks in menus, footers,
forms, adverts and the like, or outside of the article where one is marked, and blocks made of links
are boilerplate; long blocks with their share of stop words are text, all long ones where the page's text
holds next to none of the stop words known (another language).  The rest, mostly short, is
ambiguous: pass two gives each such block the label of its nearest decided neighbour, a heading that
of what follows if both are as near.  Links within a marked article drop only themselves, and a single link that reads like a
sentence not even itself, so an article without a decided block is text as a whole.

A class or id marks an element if it is made of known parts alone: ``sidebar-left`` does, ``content-with-sidebar``
does not.  An article within a sidebar, banner or form is the article all the same; within an aside, a related box or the
like it is not.  A form that holds most of the page is no form.

Null and empty pages give the empty text.  Unclosed and cut-off markup is read as far as it goes.
Repeated pages are extracted each.  Other columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from serieslake.llm.common import on_batches, texts_of

# Common function words of the languages served.
STOP_WORDS = frozenset("""
a about an and are as at be been but by can for from had has have he her his i if in is it its more no not of on one or our out she so some than that the their them there they this to up was we were what when which who will with would you
aber als am an auch auf aus bei bin bis da das dass dem den der des die doch du durch ein eine einem einen einer eines er es für gegen hat hatte ich ihr im in ist ja kann mehr mit nach nicht noch nur oder ohne sein sich sie sind so über um und uns unter vom von vor war was wenn werden wie wir wird zu zum zur
au aux avec ce ces cette comme dans de des du elle en est et eux il ils je la le les leur lui ma mais me même mes moi mon ne nos notre nous on ont ou par pas plus pour qu que qui sa sans se ses son sont sur ta te tes tu un une vos votre vous y à été être
al algo ante como con contra cual cuando de del desde donde dos durante e el ella ellas ellos en entre era es esa ese eso esta este esto está fue ha hasta hay la las le les lo los más me mi muy nada ni no nos o para pero por porque que quien se ser si sin sobre son su sus también te todo un una uno unos y ya yo
""".split())

# Elements and name parts that mark boilerplate.
DROPPED = frozenset("head title script style noscript template iframe object svg math canvas select button textarea nav footer aside menu dialog".split())
RAW = frozenset("script style noscript template iframe textarea title".split())
MARKS = frozenset("""
ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion teaser cookie cookies consent gdpr notice notices alert banner
menu nav navbar navigation topbar sidebar aside footer masthead breadcrumb breadcrumbs pagination pager widget toolbar share sharing social
related recommended newsletter subscribe subscription signup login popup modal overlay skip hidden
""".split())
# Of these, places that may hold the article itself; and parts of names that go with either.
PLACES = frozenset("banner topbar sidebar masthead widget toolbar skip".split())
NEUTRAL = frozenset("""
area bar block bottom box button buttons center col column container content desktop fixed footer grid group header icon icons inner item items left link links
list main mobile outer page panel primary right row secondary section site slot small sticky text title top unit wrap wrapper zone
""".split())
REMARKS = frozenset("comment comments reply replies disqus respond discussion".split())
ARTICLES = frozenset(("article", "main"))
BLOCKS = frozenset("""
address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6
head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre section summary table tbody td template tfoot th thead title tr ul
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
SELF_CLOSING = frozenset(("p", "li", "dd", "dt", "td", "th", "tr", "option"))

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
_PARTS = re.compile(r"[a-z]+")
_WORD = re.compile(r"[^\W\d_]+")

TEXT, BOILERPLATE, AMBIGUOUS = 1, -1, 0
LINKS = -2  # boilerplate that says nothing of its neighbours


class Rules(NamedTuple):
    link_share: float = 0.5  # of a block's characters: above it is a list of links
    least_length: int = 70  # characters below which a block is ambiguous
    stop_share: float = 0.15  # of a block's words: from here on a block of that length is text
    form_share: float = 0.75  # of the text that is not dropped otherwise: from here on a form wraps the page
    foreign_share: float = 0.075  # of the words of all blocks in question: below it length alone decides


class Block(NamedTuple):
    text: str
    linked: int  # characters within links
    heading: bool
    dropped: bool
    article: bool
    links: int = 0
    form: bool = False


class Scope(NamedTuple):
    """What holds within an open element."""

    name: str
    dropped: int  # ``PLACE`` or ``ALWAYS``
    remark: bool
    article: bool
    form: bool


PLACE, ALWAYS = 1, 2  # dropped unless an article follows within; dropped with all that is within
_PLAIN_SCOPE = Scope("", 0, False, False, False)


def _marks(attributes: str) -> tuple[int, bool]:
    """How far the element's names drop it, and whether they speak of readers' remarks."""
    dropped, remark = 0, False
    for kind, *values in _NAMES.findall(attributes):
        value = "".join(values).lower()
        if kind.lower() == "role":
            if value in ("navigation", "contentinfo", "complementary", "search", "dialog", "alert"):
                dropped = ALWAYS
            elif value == "banner":
                dropped = max(dropped, PLACE)
            continue
        for token in value.split():
            parts = _PARTS.findall(token)
            known = [part for part in parts if part in MARKS]
            remark |= any(part in REMARKS for part in parts)
            if known and all(part in MARKS or part in NEUTRAL for part in parts):
                dropped = max(dropped, PLACE if all(part in PLACES for part in known) else ALWAYS)
    return dropped, remark


def _enter(name: str, attributes: str, around: Scope) -> Scope:
    marked, remark = _marks(attributes) if "=" in attributes else (0, False)
    remark |= around.remark
    if name in ARTICLES and not remark and around.dropped != ALWAYS:
        return Scope(name, 0, False, True, False)
    dropped = ALWAYS if remark or name in DROPPED else PLACE if name == "header" and not around.article else 0
    if name not in ("body", "html"):
        dropped = max(dropped, marked, ALWAYS if attributes and _HIDDEN.search(attributes) else 0)
    return Scope(name, max(dropped, around.dropped), remark, around.article, around.form or name == "form")


def blocks(page: str) -> list[Block]:
    """The page's blocks that hold text, in page order."""
    made: list[Block] = []
    scopes = [_PLAIN_SCOPE]
    parts: list[str] = []
    linked = links = anchors = 0
    heading = False

    def close() -> None:
        nonlocal linked, anchors
        text = " ".join("".join(parts).split())
        if text:
            here = scopes[-1]
            made.append(Block(text, min(linked, len(text)), heading, here.dropped > 0, here.article, anchors, here.form))
        parts.clear()
        linked = anchors = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if links:
                linked += len(text.strip())

    at, size = 0, len(page)
    while at < size:
        tag = _TAG.search(page, at)
        if tag is None:
            add(page[at:])
            break
        add(page[at : tag.start()])
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        ending, attributes = tag[1] or tag[4], tag[3] or tag[6] or ""
        if tag[5] and not page.endswith(">", 0, at):
            break  # cut off within a tag
        if name == "a":
            links = 0 if ending else 1
            anchors += links
            continue
        block = name in BLOCKS
        if ending:
            depth = next((i for i in range(len(scopes) - 1, 0, -1) if scopes[i].name == name), 0)
            if block or depth:
                close()
            if depth:
                del scopes[depth:]
            if block:
                links, heading = 0, False
            continue
        if name in RAW:
            end = re.compile(f"</{name}[^>]*(?:>|\\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else size
            continue
        scope = _enter(name, attributes, scopes[-1])
        if block or scope.dropped != scopes[-1].dropped:
            close()
            links = 0
            if block and name in SELF_CLOSING and scopes[-1].name == name:
                scopes.pop()
                scope = _enter(name, attributes, scopes[-1])
            elif block and scopes[-1].name == "p":
                scopes.pop()
                scope = _enter(name, attributes, scopes[-1])
            heading = name in HEADINGS if block and name != "br" else heading
        if name in VOID or attributes.endswith("/") and not block:
            continue
        if block and name != "p" or scope.dropped != scopes[-1].dropped:
            scopes.append(scope)
    close()
    return made


def decide(found: list[Block], rules: Rules = Rules()) -> list[int]:
    """Pass one: text, boilerplate or ambiguous."""
    marked = any(b.article and not b.dropped for b in found)
    labels, counts = [], []
    for b in found:
        words = _WORD.findall(b.text.lower())
        stops = sum(w in STOP_WORDS for w in words)
        inside = marked and b.article and not b.dropped
        sentence = inside and b.links == 1 and len(words) > 3 and stops >= rules.stop_share * len(words)
        listed = b.linked > rules.link_share * len(b.text) and not sentence
        if b.dropped or (marked and not b.article) or listed:
            labels.append(LINKS if listed and inside else BOILERPLATE)
            counts.append((0, 0))
            continue
        counts.append((len(words), stops))
        enough = len(b.text) >= rules.least_length and not b.heading and words and stops >= rules.stop_share * len(words)
        labels.append(TEXT if enough else AMBIGUOUS)
    if sum(stops for _, stops in counts) < rules.foreign_share * sum(n for n, _ in counts):
        for i, (b, (n, _)) in enumerate(zip(found, counts, strict=True)):
            if n and len(b.text) >= rules.least_length and not b.heading:
                labels[i] = TEXT
    return labels


def settle(found: list[Block], labels: list[int]) -> list[bool]:
    """Pass two: ambiguous blocks take the label of the nearest decided neighbour.

    Neighbours are blocks of the same kind of place (in or out of an article); menus and the like are none.
    """
    settled = [label == TEXT for label in labels]
    for place in (True, False):
        rows = [i for i, b in enumerate(found) if b.article == place and not b.dropped]
        far = len(rows) + 1
        before, last = [], (far, AMBIGUOUS)
        for i in rows:
            last = (0, labels[i]) if labels[i] in (TEXT, BOILERPLATE) else (last[0] + 1, last[1])
            before.append(last)
        after, last = [], (far, AMBIGUOUS)
        for i in reversed(rows):
            last = (0, labels[i]) if labels[i] in (TEXT, BOILERPLATE) else (last[0] + 1, last[1])
            after.append(last)
        for i, b, a in zip(rows, before, reversed(after), strict=True):
            if labels[i] == AMBIGUOUS:
                ahead = a[1] and (not b[1] or a[0] < b[0] or a[0] == b[0] and found[i].heading)
                settled[i] = ((a if ahead else b)[1] or TEXT) == TEXT
    return settled


def without_forms(found: list[Block], rules: Rules) -> list[Block]:
    """Blocks within forms count as dropped, unless those outside an article are most of the page."""
    size = {form: sum(len(b.text) for b in found if b.form == form and not b.dropped and not b.article) for form in (True, False)}
    wraps = not any(b.article and not b.dropped for b in found) and size[True] >= rules.form_share * (size[True] + size[False])
    return [b._replace(dropped=b.dropped or b.form and (b.article or not wraps)) for b in found]


def main_text(page: str, rules: Rules = Rules()) -> str:
    found = without_forms(blocks(page), rules)
    keep = settle(found, decide(found, rules))
    return " ".join(b.text for b, kept in zip(found, keep, strict=True) if kept)


def extract(pages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages(page_id, url, html)``."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(page, rules) for page in texts_of(batch, "html")]
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return on_batches(pages.select("page_id", "url", "html"), make, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
