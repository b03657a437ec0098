"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Pass 1 decides each block from its
length, its share of stop words and its share of text in links: long with many
stop words is good, mostly links is bad, long without stop words is bad; short
blocks and those in between stay open. Pass 2 gives open blocks the label of the
nearest decided neighbours (both alike: that; else the nearer one, good if equally
near; blocks with enough stop words are bad only between bad ones).

Menus, headers, footers, sidebars, notices, adverts, forms and reader comments, by
element, role, class or id, are bad as a whole. A class or id that only contains such
a word ("related-work", "banner-text", "legal") is a hint: the element is bad unless one
of its blocks is good by its text and a third of its text at most is linked; outside
the article of a page that marks one it is bad. Where a page marks its article, the
mark settles what the text leaves open: inside it, blocks without stop words or with
some links stay open, open blocks see only the article's own neighbours and are good
unless those are bad (a page whose article has no block that is good by its text says
nothing by neighbours: there they are good); outside it, open blocks are bad unless
good ones lie on both sides (with some stop words, on one side). Blocks good by their
text are good outside, too; outside a main element, which a page has once, it takes
two. A mark with less text than the good blocks outside it is a teaser card: outside
it the text alone decides, its own open blocks are bad but for a heading right before
a good block.

Scripts written without blanks (Chinese, Japanese, Thai) are measured by their stop
strings, and a character of theirs counts as three letters.

Defined results: null and empty html give the empty text; a page without good
blocks too; a quoted attribute value may be of any length, one without its end
quote ends with its tag; broken markup is read as far as it goes (unclosed elements end with
their parent; players, drawings, buttons and the like, which are skipped, also
where a block starts); repeated pages give a row each; an empty table gives no rows;
other columns are ignored. The work on a page is linear in its length."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset("""
the of and to a in is it that for with on be by an this was are as from at or have not but they his her he she we you
der die das den dem des ein eine einer eines und oder ist nicht mit von für im in zu auf sich als auch es an werden aus
le la les de des du un une et est en que qui dans pour par sur au aux ce il elle ne pas plus avec sont se
el los las del y es en un una por para con no lo su al como más o pero sus fue ha
""".split())
#: Frequent particles and function words of Chinese, Japanese and Thai.
STOP_STRINGS = re.compile("的|了|是|在|和|有|不|他|她|我|这|這|那|也|就|与|與|为|為|对|對|被|把|から|まで|です|ます|した|して|する|ある|いる|の|に|は|を|が|と|で|も|"
                          "และ|ที่|ของ|ใน|เป็น|ได้|ให้|ว่า|มี|ไม่|จะ|กับ|จาก|การ")
#: Letters of scripts that put no blanks between words, by letters a word.
UNSPACED = ((re.compile("[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]"), 2), (re.compile("[\u0e00-\u0e7f]"), 4))

RAW = "script|style|iframe|textarea|title"  # no markup inside: these end at their end tag alone
SKIPPED = frozenset("noscript template svg math object canvas video audio select button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section
summary table tbody td tfoot th thead tr ul head""".split())
BAD_TAGS = frozenset("nav footer aside form menu dialog head".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
GOOD_NAMES = frozenset("article article-body article-content articlebody post-body post-content entry-content story-body".split())
BAD_NAMES = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar
navigation menu breadcrumb breadcrumbs sidebar footer masthead topbar toolbar cookie cookies consent gdpr notice alert popup
modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations trending
pagination pager widget comment comments respond reply replies disqus discussion copyright legal disclaimer skip search""".split())
MARKS = ("article", "main")
#: Names that an article's own parts bear as well: alone, too, they are only a hint.
SOFT_NAMES = frozenset("banner legal navigation promotion related recommended search sharing skip social subscription trending".split())
#: Parts of a name that say how an element is laid out, not what it holds.
LAYOUT = frozenset("""area bar block body bottom box button buttons card cards center col column container content group header
holder icon icons inner item items left link links list main module outer page panel post posts primary region right row secondary
site slot stories thread top unit wrap wrapper zone articles""".split())
COMMENTS = frozenset("comment comments respond reply replies disqus discussion".split())
NOT_A_NAME = frozenset("has no with without is not non".split())
CLOSES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
          "option": ("select",)}

START = re.compile(rf"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-z][^\s/<>]*)|<[!?][^<>]*>|</>", re.S | re.I)
RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW.split("|")}
#: Of a tag's attributes: what is not quoted, then one quoted value, which may hold anything.
STEP = re.compile(r"""[^'"<>]*+("[^"]*+"|'[^']*+'|)""")
TO_CLOSE = re.compile(r"[^<>]*+>")
ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*+"|'[^']*+'|[^\s"'>]+))?""")

LONG, VERY_LONG = 70, 200
SOME_STOPS, MANY_STOPS = 0.10, 0.20
LINKS, ARTICLE_LINKS = 0.33, 0.66


@dataclass
class Block:
    context: str  # "bad", "article", "main" or ""
    hint: int = 0  # the number of the element whose name hints at boilerplate
    heading: bool = False
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    label: str = ""


class Tag(NamedTuple):
    start: int
    end: int
    name: str
    closing: bool
    attr: str


def _tags(page: str) -> list[Tag]:
    """All tags; comments, declarations and raw elements are tags without a name."""
    out, at, stuck = [], 0, set()  # stuck: from these places the quotes lead to no end of a tag
    while m := START.search(page, at):
        at, name = m.end(), (m["tag"] or "").lower()
        if name:
            i, tried = at, []
            while i not in stuck:
                tried.append(i)
                step = STEP.match(page, i)
                i = step.end()
                if not step[1]:
                    break
            if page[i:i + 1] == ">" and i not in stuck:
                end = i + 1
            else:  # a quote without its end, or a "<" before the tag's: it ends at its first ">" and holds no "<"
                stuck.update(tried)
                rest = TO_CLOSE.match(page, at)
                if not rest:
                    continue
                end = rest.end()
            attr, closing, at = page[at:end - 1], bool(m["end"]), end
            if name in RAW_END and not closing:
                last = RAW_END[name].search(page, at)
                name, at = "", last.end() if last else len(page)
            out.append(Tag(m.start(), at, name, closing, attr))
        else:
            out.append(Tag(m.start(), at, "", False, ""))
    return out


def _named(name: str) -> str:
    """What a class or id says: "bad" (a name of boilerplate), "hint" (it contains
    one) or "". The last part that is not layout says what the element is."""
    parts = [p for p in re.split(r"[^a-z]+", name) if p]
    if NOT_A_NAME.intersection(parts) or not BAD_NAMES.intersection(parts):
        return ""
    kind = [p for p in parts if p not in LAYOUT] or parts
    if kind[-1] not in BAD_NAMES:
        return "hint"
    if kind[-1] not in SOFT_NAMES or len(kind) < len(parts) or any(p in BAD_NAMES - SOFT_NAMES for p in kind):
        return "bad"
    return "hint"


def _context(tag: str, attr: str, outer: str, comments: bool) -> tuple[str, bool, bool]:
    """The context inside an element, whether it holds reader comments, and
    whether its name hints at boilerplate."""
    names, role, hidden, good = set(), "", False, False
    for m in ATTR.finditer(attr) if attr else ():
        key = m[1].lower()
        if key in ("class", "id"):
            names.update((m[2] or "").lower().strip("\"'").split())
        elif key == "role":
            role = (m[2] or "").strip("\"'").lower()
        elif key == "itemprop":
            good |= (m[2] or "").strip("\"'").lower() == "articlebody"
        elif key == "style":
            hidden |= "display:none" in (m[2] or "").lower().replace(" ", "")
        elif key in ("hidden", "aria-hidden"):
            hidden |= key == "hidden" or (m[2] or "").strip("\"'").lower() == "true"
    page = tag in ("html", "body", "article", "main")
    said = {n: _named(n) for n in names}
    talk = comments or any(v == "bad" and COMMENTS.intersection(re.split(r"[^a-z]+", n)) for n, v in said.items())
    if hidden or talk or tag in BAD_TAGS or role in BAD_ROLES or (not page and "bad" in said.values()):
        return "bad", talk, False
    if tag == "header" and outer not in MARKS:
        return "bad", False, False
    hint = not page and "hint" in said.values()
    if tag == "main" or role == "main":
        return "main", False, hint
    if tag == "article" or good or role == "article" or names & GOOD_NAMES:
        return outer if outer == "main" else "article", False, hint
    return outer, False, hint


def _ends(tags: list[Tag]) -> dict[int, int]:
    """Where the skipped elements that have an end tag end, by tag."""
    out: dict[int, int] = {}
    started: dict[str, list[int]] = {}
    for i, t in enumerate(tags):
        if t.name not in SKIPPED:
            continue
        if not t.closing:
            if not _empty(t):
                started.setdefault(t.name, []).append(i)
        elif started.get(t.name):
            out[started[t.name].pop()] = i
    return out


def _empty(t: Tag) -> bool:
    return t.name in ("svg", "math") and t.attr.endswith("/")


def blocks(page: str | None) -> list[Block]:
    out: list[Block] = []
    stack: list[tuple[str, str, bool, int]] = [("", "", False, 0)]
    opened = Counter()  # tags on the stack
    current = Block("")
    links = 0
    unended, inner = "", Counter()  # a skipped element without an end tag, and what is open in it

    def text(raw: str) -> None:
        if raw and not unended:
            t = html.unescape(raw) if "&" in raw else raw
            current.parts.append(t)
            if links:
                current.linked += len("".join(t.split()))

    def cut(heading: bool = False) -> None:
        nonlocal current
        if current.parts:
            out.append(current)
        current = Block(stack[-1][1], stack[-1][3], heading)

    at, page = 0, page or ""
    tags = _tags(page)
    ends = _ends(tags)
    for i, t in enumerate(tags):
        if t.start < at:
            continue
        text(page[at:t.start])
        at, tag, closing = t.end, t.name, t.closing
        if not tag:
            continue
        if i in ends:
            at = tags[ends[i]].end
            continue
        if unended:  # it ends with its parent, or where a block starts
            if (tag not in BLOCK or unended == "select" and tag in ("option", "optgroup")) and not (closing and not inner[tag]):
                if tag not in VOID:
                    inner[tag] += -1 if closing else 1
                continue
            unended = ""
        if tag in SKIPPED:
            if not closing and not _empty(t):
                unended, inner = tag, Counter()
        elif tag == "a":
            links = 0 if closing else 1
        elif tag == "br":
            text(" ")
        elif tag not in BLOCK:
            continue
        elif closing:
            while opened[tag]:
                last = stack.pop()[0]
                opened[last] -= 1
                if last == tag:
                    break
            links = 0
            cut()
        else:
            if stack[-1][0] == "p":
                stack.pop()
                opened["p"] -= 1
            if opened[tag] and tag in CLOSES:  # an open sibling ends here
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in CLOSES[tag]:
                        break
                    if stack[k][0] == tag:
                        opened.subtract(x[0] for x in stack[k:])
                        del stack[k:]
                        break
            if tag not in VOID:
                _, outer, talk, hint = stack[-1]
                inside, talk, hinted = _context(tag, t.attr, outer, talk)
                if outer == "bad" and not (inside in MARKS and tag in ("article", "main")
                                           and not any(opened[x] for x in BAD_TAGS)):
                    inside = "bad"
                stack.append((tag, inside, talk, hint or (i + 1 if hinted else 0)))
                opened[tag] += 1
            links = 0
            cut(tag in ("h1", "h2", "h3", "h4", "h5", "h6"))
    text(page[at:])
    cut()
    for b in out:
        b.text = " ".join("".join(b.parts).split())
        b.parts = []
    return [b for b in out if b.text]


def _letters(text: str) -> tuple[int, int]:
    """Letters of unspaced scripts, and the words that they make."""
    if text.isascii():
        return 0, 0
    n = [(len(p.findall(text)), size) for p, size in UNSPACED]
    return sum(k for k, _ in n), sum(k // size for k, size in n)


def _by_text(b: Block, marked: bool) -> str:
    """Pass 1: "good", "bad", "near" or "short" (open)."""
    links = b.linked / (len(b.text.replace(" ", "")) or 1)
    unspaced, n_words = _letters(b.text)
    size = len(b.text) + 2 * unspaced
    if b.context == "bad" or links > (ARTICLE_LINKS if marked else LINKS) or b.text.startswith("©") and size <= VERY_LONG:
        return "bad"
    if size < LONG or b.heading or links > LINKS:
        return "short"
    words = b.text.lower().split()
    if 2 * unspaced > len(b.text):
        stops = len(STOP_STRINGS.findall(b.text)) / max(n_words, 1)
    else:
        stops = sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)
    if stops < SOME_STOPS:
        return "short" if marked else "bad"
    return "good" if stops >= MANY_STOPS and size > VERY_LONG else "near"


def _settle_hints(found: list[Block]) -> None:
    """Elements whose name hints at boilerplate: bad as a whole without a block that
    is good by its text, or with many links."""
    marked = any(b.context in MARKS for b in found)
    of: dict[int, list[Block]] = {}
    for b in found:
        if b.hint and b.context != "bad":
            of.setdefault(b.hint, []).append(b)
    for part in of.values():
        linked, chars = sum(b.linked for b in part), sum(len(b.text.replace(" ", "")) for b in part)
        outside = marked and part[0].context not in MARKS
        if outside or linked > LINKS * chars or all(_by_text(b, False) != "good" for b in part):
            for b in part:
                b.context = "bad"


def _spread(found: list[Block], prior: str = "") -> None:
    """Pass 2: open blocks by their nearest decided neighbours, and by ``prior``
    where these do not agree."""
    before: list[tuple[str, int]] = []
    last = ("", 1 << 30)
    for i, b in enumerate(found):
        before.append((last[0], i - last[1]))
        if b.label in ("good", "bad"):
            last = (b.label, i)
    last = ("", 1 << 30)
    decided = [b.label for b in found]
    blind = prior == "good" and "good" not in decided
    for i in range(len(found) - 1, -1, -1):
        if decided[i] in ("good", "bad"):
            last = (decided[i], i)
            continue
        (p, far_p), (n, far_n) = before[i], (last[0], last[1] - i)
        if blind:
            found[i].label = "good"
        elif not p and not n:
            found[i].label = prior or ("good" if decided[i] == "near" else "bad")
        elif decided[i] == "near":
            found[i].label = "good" if "good" in (p, n) else "bad"
        elif prior and p != n:
            found[i].label = prior if p and n or prior == "bad" else p or n
        elif p and n and p != n:
            nearer = p if far_p < far_n else n if far_n < far_p else "good"
            found[i].label = "good" if found[i].heading and n == "good" else nearer
        else:
            found[i].label = p or n


def classify(found: list[Block]) -> list[Block]:
    """Both passes; sets each block's label to "good" or "bad"."""
    _settle_hints(found)
    inside = [b for b in found if b.context in MARKS]
    outside = [b for b in found if b.context not in MARKS]
    for b in found:
        b.label = _by_text(b, b.context in MARKS)
    body = [b for b in outside if b.label == "good"]
    if len(body) == 1 and any(b.context == "main" for b in inside):
        body.pop().label = "short"
    if sum(len(b.text) for b in inside if b.label != "bad") >= sum(len(b.text) for b in body) and inside:
        _spread(inside, "good")
        _spread(outside, "bad")
    else:  # no mark, or one beside the text
        for b in inside:
            b.label = _by_text(b, False)
        titles = [b.heading and b.context in MARKS and b.label == "short" for b in found]
        _spread(inside, "bad")
        _spread(outside)
        for title, b, after in zip(titles, found, found[1:]):
            if title and after.label == "good":
                b.label = "good"
    return found


def main_text(page: str | None) -> str:
    return "\n\n".join(b.text for b in classify(blocks(page)) if b.label == "good")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            text = [main_text(x) for x in pdf.html]
            yield pd.DataFrame({"page_id": pdf.page_id, "url": pdf.url, "text": text, "n_chars": [len(t) for t in text]})

    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id long, url string, text string, n_chars long")
