"""Main text of web pages by the maximum-scoring subsequence.

A page becomes a sequence of tags and of text between tags. Words score positive and tags negative; one linear scan finds
the contiguous region with the largest sum. The weights are log odds of lying inside or outside the main content, counted on
labelled pages: those that mark it themselves with ``<article>`` or ``<main>``. Tags that main text is made of cost next to
nothing. Words count by their surroundings: plain, in a link, or in an element that is boilerplate by its name, role, class
or id. What is in such an element is left out in any case, so it scores nothing but for the element's own two tags.

On a page that marks its content words inside count for it and words outside against it, whatever their number; tags
inside score nothing, the outermost marking tags part regions.

From the region, text of boilerplate elements is left out, character references are decoded, white space inside a block
becomes one space, blocks are trimmed, and blocks that aren't empty are joined by a newline. A ``<br>`` ends a block.

Defined results: a null, empty or wordless page has an empty text; a page of any length is scanned whole; markup may be
unclosed, cut off or malformed; repeated rows give repeated results; an empty table gives an empty table, by ``PRIOR``
weights alone. Input columns named like an output column are replaced, all others are kept.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import add_columns

# Element names of the HTML standard, by what they mean for the main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
NOT_TEXT = frozenset(
    "script style noscript template iframe object svg canvas audio video head title form button select textarea nav aside"
    " footer menu dialog option datalist math map".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
MARKERS = ("article", "main")
# Words in a class, id or role that mark boilerplate, and those that speak for content.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar nav navbar"
    " navigation menu breadcrumb breadcrumbs footer header masthead topbar cookie cookies consent gdpr notice notices alert"
    " popup modal overlay newsletter subscribe subscription signup login comment comments respond disqus reply replies share"
    " sharing social related recommended recommendations widget search pagination pager toolbar complementary contentinfo"
    " skip hidden".split()
)
CONTENT = frozenset("article content entry post story main".split())
#: Of the boilerplate words, those that hold beside a content word too, as in post-comments.
ALWAYS = BOILERPLATE - frozenset("header banner notice alert hidden search".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:_-]*)(?P<attrs>[^<>\"']*(?:\"[^\"]*\"[^<>\"']*|'[^']*'[^<>\"']*)*)>"
    r"|<(?P<close2>/?)(?P<name2>[A-Za-z][A-Za-z0-9:_-]*)(?P<attrs2>[^<>]*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.S,
)
MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
PARTS = re.compile(r"[a-z]+")
SPACES = re.compile(r"\s+")

#: Elements that show nothing and stand anywhere; their tags have one key, and no weight is learned for it.
SILENT = ("script", "style", "noscript", "template")
UNSEEN = "unseen"

SKIPPED = "skipped"

#: Pages read to fit the weights: different ones, those with the smallest hash of their markup, and the longest of them.
SAMPLE_PAGES, SAMPLE_CHARS = 1000, 1_000_000
#: What words score that no labelled page has shown.
PRIOR = {"word": 1.0, "link word": 0.3, "boilerplate word": 0.0, SKIPPED: 0.0, UNSEEN: -0.02}
#: What words inside and outside score on pages that mark their content, and the marking tags.
MARKED, OUTSIDE, MARKER = 1.0, -1.0, -8.0


def _boilerplate(name: str, attrs: str, in_content: bool) -> bool:
    if name in NOT_TEXT or (name == "header" and not in_content):
        return True
    if "=" not in attrs:
        return bool(HIDDEN.search(attrs)) if attrs else False
    if HIDDEN.search(attrs):
        return True
    for m in MARKS.finditer(attrs):
        words = set(PARTS.findall((m[1] or m[2] or m[3] or "").lower()))
        if words & ALWAYS or (words & BOILERPLATE and not words & CONTENT):
            return name not in ("html", "body", *MARKERS) or bool(words & {"comment", "comments", "reply"})
    return False


def tokens(page: str) -> Iterator[tuple[str, str, bool, int]]:
    """``key, text, block, depth in content markers`` of every tag and text; key names what its weight goes by.

    Text has one of the word keys, a tag its name with a slash if it closes, with a note if it begins or ends an element that
    is left out; tags inside such an element are skipped. Block tells whether a tag ends a block.
    """
    stack: list[tuple[str, bool]] = []  # open elements that matter: name, whether text in them is left out
    open_: Counter = Counter()  # how many of each name
    out_depth = link_depth = marked = 0
    at = 0
    lower: str | None = None

    def text(a: int, b: int) -> tuple[str, str, bool, int]:
        key = "boilerplate word" if out_depth else "link word" if link_depth else "word"
        return key, page[a:b], False, marked

    while True:
        m = TOKEN.search(page, at)
        if not m:
            break
        if m.start() > at:
            yield text(at, m.start())
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        block = name in BLOCKS
        if m["close"] or m["close2"]:
            was_out, was_marked = out_depth, marked
            if open_[name]:
                while stack:
                    n, left_out = stack.pop()
                    open_[n] -= 1
                    out_depth -= left_out
                    link_depth -= n == "a"
                    marked -= n in MARKERS
                    if n == name:
                        break
            key = "/" + name + (" boilerplate" if was_out and not out_depth else "")
            yield UNSEEN if name in SILENT else SKIPPED if was_out and out_depth else key, "", block, was_marked
            continue
        left_out = _boilerplate(name, attrs, marked > 0)
        key = SKIPPED if out_depth else name + (" boilerplate" if left_out else "")
        yield UNSEEN if name in SILENT else key, "", block, marked
        if name in RAW:
            # Its text ends at its own closing tag only.
            if lower is None:
                lower = page.lower()
            end = lower.find("</" + name, at)
            at = len(page) if end < 0 else end
            continue
        if name in VOID or attrs.endswith("/"):
            continue
        if left_out or name == "a" or name in MARKERS or name in ("div", "section", "span", "ul", "ol", "p", "li", "table"):
            if name == "p" and stack and stack[-1][0] == "p":
                out_depth -= stack.pop()[1]  # a paragraph ends the one before
                open_["p"] -= 1
            stack.append((name, left_out))
            open_[name] += 1
            out_depth += left_out
            link_depth += name == "a"
            marked += name in MARKERS
    if at < len(page):
        yield text(at, len(page))


def count(pages: Iterable[str]) -> Counter:
    """How often each key lies inside and outside the marked content of the pages that mark it."""
    found: Counter = Counter()
    for page in pages:
        if not re.search(r"<(?:article|main)\b", page, re.I):
            continue
        for key, text, _, marked in tokens(page):
            n = len(text.split()) if text else 1
            name = key.lstrip("/").split(" ")[0]
            inside = marked > 0 and name not in MARKERS
            found[key, inside] += n
    return found


def weigh(found: Counter) -> dict[str, float]:
    """Word weights, positive unless in links or boilerplate, and tag weights, never positive, from the counts."""
    out = dict(PRIOR)
    for key in {k for k, _ in found}:
        odds = math.log((found[key, True] + 0.5) / (found[key, False] + 0.5))
        if key == "word":
            out[key] = min(1.0, max(0.5, odds))
        elif key == "link word":
            out[key] = min(1.0, max(-1.0, odds / 4))
        elif key not in PRIOR:
            out[key] = -min(2.0 if key.endswith("boilerplate") else 8.0, max(0.02, -odds))
    return out


def default_weight(key: str) -> float:
    """Of words without weights, or a tag that no labelled page has shown: small for the blocks text is made of, large for boilerplate."""
    if key in PRIOR:
        return PRIOR[key]
    return -2.0 if key.endswith("boilerplate") else -0.05


def score(items: list[tuple[str, str, bool, int]], weights: dict[str, float]) -> list[float]:
    """What every tag and text of a page adds to a region."""
    marks = any(marked for *_, marked in items)
    out = []
    for key, text, _, marked in items:
        if text:
            w = 0.0 if key == "boilerplate word" else MARKED if marked else OUTSIDE if marks else weights.get(key, PRIOR[key])
            out.append(w * len(text.split()))
        elif key.lstrip("/") in MARKERS and marked <= (key[0] == "/"):
            out.append(MARKER)
        else:
            out.append(0.0 if marked else weights[key] if key in weights else default_weight(key))
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and past-the-end place of the contiguous run with the largest sum; the first longest one of equal sums."""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0.0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, best_at = total, (start, i + 1)
    return best_at


def extract_text(page: str, weights: dict[str, float]) -> str:
    items = list(tokens(page))
    a, b = best_region(score(items, weights))
    blocks: list[str] = []
    parts: list[str] = []

    def close() -> None:
        if parts:
            block = SPACES.sub(" ", html.unescape("".join(parts))).strip()
            if block:
                blocks.append(block)
            parts.clear()

    for key, text, block, _ in items[a:b]:
        if text:
            if key in ("word", "link word"):
                parts.append(text)
        elif block:
            close()
    close()
    return "\n".join(blocks)


def fit(pages: DataFrame, column: str = "html", sample: int = SAMPLE_PAGES) -> dict[str, float]:
    """Weights from at most ``sample`` different labelled pages, chosen by the hash of their markup."""
    labelled = pages.select(F.col(column).alias("html"))
    labelled = labelled.filter(F.col("html").rlike(r"(?i)<(article|main)\b") & (F.length("html") <= SAMPLE_CHARS))
    hashed = F.xxhash64("html")
    # Hashes alone are sorted, so that tasks send no pages but the chosen ones, each once; those are counted where they are.
    cut = labelled.select(hashed.alias("h")).distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if cut is None:
        return weigh(Counter())
    chosen = labelled.filter(hashed <= cut).groupBy(hashed.alias("h")).agg(F.min("html").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = count(b.column("html").to_pylist())
            keys = [k for k, _ in found]
            inside = [i for _, i in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(inside, pa.bool_()), pa.array(found.values(), pa.int64())], names=["key", "inside", "n"]
            )

    rows = chosen.select("html").mapInArrow(run, "key string, inside boolean, n long").groupBy("key", "inside").agg(F.sum("n").alias("n"))
    return weigh(Counter({(r["key"], r["inside"]): r["n"] for r in rows.collect()}))


def extract(df: DataFrame, weights: dict[str, float] | None = None, column: str = "html") -> DataFrame:
    """``df`` with ``text`` and ``n_chars`` of its pages; weights are fitted on ``df`` itself if none are given."""
    weights = fit(df, column) if weights is None else weights

    def compute(pages: pa.Array) -> list:
        texts = [extract_text(p, weights) for p in pages.to_pylist()]
        return [texts, [len(t) for t in texts]]

    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return add_columns(df, column, fields, compute)
