"""Main text of web pages by the maximum-scoring run of tokens.

A page is a sequence of words and tags. A word scores by the element it stands in, and a tag by its
name; both weights are learned from labelled pages as the logarithm of how much more often such a token
stands in the main text than outside. Pages that mark their main text by ``article``, ``main`` or a
role of that name are the labels. Words of elements never seen in training score 1, tags of unknown
names -1. One linear scan finds the run with the largest sum; its words are the text, without those in
elements that a reader takes for page furniture. Words and tags of furniture score 0, so a run goes on
behind it. Furniture is known by its tag or by its class or id: a word as ``sidebar``, a name that ends in one
(``site-footer``) or one of a list of them (``comment-list``), but no name of a state (``has-sidebar``). ``html``, ``body``, main
text and what it stands in never are furniture.

Tags are read forwards, a page of any size once: quotes count in a value only where they begin it, a quote or tag without an
end is text or ends at the next ``>``, a head ends at the first tag that can't stand in it. Comments, scripts, styles and
other raw elements are no tokens; a raw element that isn't closed goes on to the end, a control or picture that isn't closed is
left out alone. Character references are decoded,
white space in a block becomes one blank, and blocks are joined by one blank; inline tags don't part a
word. A null page is an empty one; a page without a positive run has an empty text; pages are read whole;
equal pages get equal texts; an empty table gives an empty table.
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

from corpusloom.llm.common import in_pieces, table

#: Bounds of the training sample: pages, and characters of a page to be in it.
TRAIN_PAGES = 600
TRAIN_CHARS = 100_000

#: Fixed values of HTML: elements whose content is no text, elements without an end, and inline elements.
RAW = "script|style|noscript|template|textarea|svg|iframe|object|math|select|button"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that give their words a context of its own.
CONTAINERS = frozenset(
    "html head title body article main section div nav header footer aside form ul ol table figure figcaption details dialog menu address fieldset".split()
)
#: Elements and whole class words that mark page furniture.
FURNITURE_TAGS = frozenset("head title nav footer aside form menu dialog fieldset".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo sidebar comment comments disqus menu navbar nav navigation breadcrumb "
    "breadcrumbs cookie cookies consent notice notices popup modal newsletter subscribe share sharing social related footer header masthead pagination pager".split()
)
MAIN = ("article", "main")

#: Parts of names made of several words: what tells of a state, what holds main text, and what holds several of its kind.
STATE_PARTS = frozenset("has have with no not without is hide hides hidden show shows open opened closed enabled disabled".split())
TEXT_PARTS = frozenset("article post entry content main story text".split())
TOP_PARTS = frozenset("header masthead banner notice notices related".split())
LIST_PARTS = frozenset(
    "list lists box bar section sections area wrap wrapper container block widget widgets form thread item items link links buttons button panel overlay posts icons inner body".split()
)
#: Tags that a head may hold, and those that end an open one of their kind.
HEAD_TAGS = frozenset("title meta link base script style noscript template".split())
ENDS_ITSELF = frozenset("p li td th tr dt dd option".split())
#: Raw elements whose end is always looked for; the others are left out alone if they have none.
TO_THE_END = frozenset("script style noscript template textarea iframe".split())
RAW_NAMES = frozenset(RAW.split("|"))

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE_NAME = re.compile(r"[\s/]*([^\s/>=]*)")
EQUALS = re.compile(r"\s*=\s*")
BARE = re.compile(r"[^\s>]*")


class Scanner:
    """Tokens of a page, read once from its begin to its end: ("text", text, None), ("start", name, marks) and ("end", name, None).

    marks: values of class, id and role.
    """

    def __init__(self, source: str):
        self.source = source
        self.last = source.rfind(">")
        self.gone: set[str] = set()  # what is known not to come any more

    def _find(self, what: str, at: int) -> int:
        if what in self.gone:
            return -1
        found = self.source.find(what, at)
        if found < 0:
            self.gone.add(what)
        return found

    def _attributes(self, at: int) -> tuple[int, list[tuple[str, str]], bool]:
        """The place behind the tag, the marks, and whether it closes itself."""
        source, n, marks, begin = self.source, len(self.source), [], at
        while at < n:
            m = ATTRIBUTE_NAME.match(source, at)
            at = m.end()
            if at < n and source[at] == ">":
                return at + 1, marks, source[at - 1] == "/"
            equals = EQUALS.match(source, at)
            if not equals:
                at += at == m.start()
                continue
            at = equals.end()
            quote = source[at : at + 1]
            end = self._find(quote, at + 1) if quote in ("'", '"') else -1
            if end < 0:
                end = BARE.match(source, at).end()
                value, at = source[at:end], end
            else:
                value, at = source[at + 1 : end], end + 1
            if m.group(1).lower() in ("class", "id", "role"):
                marks.append((m.group(1).lower(), value.lower()))
        # Quotes led to the end of the page: the tag ends at the next bracket, and they count no more.
        self.gone |= {"'", '"'}
        return source.index(">", begin) + 1, marks, False

    def _raw_end(self, name: str, at: int) -> int:
        """The place behind the end tag of a raw element, -1 if there is none."""
        if f"</{name}" in self.gone:
            return -1
        m = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(self.source, at)
        if m:
            return m.end()
        self.gone.add(f"</{name}")
        return -1

    def tokens(self) -> Iterator[tuple[str, str, list[tuple[str, str]] | None]]:
        source, n, at, begin = self.source, len(self.source), 0, 0
        while (at := source.find("<", at)) >= 0:
            found = self._tag(at)
            if found is None:  # a bracket that begins no tag
                at += 1
                continue
            if at > begin:
                yield "text", source[begin:at], None
            kind, name, marks, begin = found
            at = begin
            if kind:
                yield kind, name, marks
        if begin < n:
            yield "text", source[begin:], None

    def _tag(self, at: int) -> tuple[str, str, list[tuple[str, str]] | None, int] | None:
        source, n = self.source, len(self.source)
        if source.startswith("<!--", at):
            if source.startswith(("<!-->", "<!--->"), at):
                return "", "", None, source.index(">", at) + 1
            end = self._find("-->", at + 4)
            return "", "", None, end + 3 if end >= 0 else n
        if source.startswith(("<!", "<?"), at):
            end = self._find(">", at)
            return "", "", None, end + 1 if end >= 0 else n
        closing = source.startswith("/", at + 1)
        m = NAME.match(source, at + 1 + closing)
        if not m or at > self.last:
            return None
        name = m.group().lower()
        if closing:
            return "end", name, None, source.index(">", m.end()) + 1
        end, marks, itself = self._attributes(m.end())
        if name not in RAW_NAMES:
            return "start", name, marks, end
        if itself and name in ("svg", "math"):
            return "", "", None, end
        behind = self._raw_end(name, end)
        return "", "", None, behind if behind >= 0 else n if name in TO_THE_END else end


def is_furniture(token: str) -> bool:
    """Whether a class or id names page furniture."""
    if token in FURNITURE_WORDS:
        return True
    parts = re.split(r"[-_]+", token)
    if len(parts) < 2 or not STATE_PARTS.isdisjoint(parts):
        return False
    if parts[-1] in FURNITURE_WORDS:
        return not (parts[-1] in TOP_PARTS and parts[0] in TEXT_PARTS)
    return parts[0] in FURNITURE_WORDS and parts[0] not in TOP_PARTS and all(p in LIST_PARTS or p in FURNITURE_WORDS for p in parts[1:]) or (
        parts[0] in TOP_PARTS and len(parts) == 2 and parts[1] in ("bar", "box", "links", "posts", "items", "list", "inner")
    )


class Page:
    """Tokens of a page: kind, key, text, and whether the word is in furniture or in the marked main text."""

    __slots__ = ("tokens",)

    def __init__(self, source: str):
        found: list[tuple[bool, str, str, int, bool]] = []
        # Elements marked as furniture: the one around each (-1: none), and whether main text stands in it.
        around: list[int] = []
        holds: list[bool] = []
        stack: list[tuple[str, str, int, bool, bool]] = []  # name, context, furniture, main, article
        context, furniture, main, article = "page", -1, False, False
        opened: Counter = Counter()

        def close(name: str) -> None:
            nonlocal context, furniture, main, article
            while True:
                top, *state = stack.pop()
                opened[top] -= 1
                if top == name:
                    context, furniture, main, article = state
                    return

        for kind, name, marks in Scanner(source).tokens():
            if kind == "text":
                if opened["head"] and stack[-1][0] == "head" and name.strip():
                    close("head")
                found.append((True, context, name, furniture, main))
            elif kind == "end":
                found.append((False, "/" + name, "", furniture, main))
                if opened[name]:
                    close(name)
            else:
                if opened["head"] and name not in HEAD_TAGS:
                    close("head")
                if name in ENDS_ITSELF and stack and stack[-1][0] == name:
                    close(name)
                if name not in VOID:
                    stack.append((name, context, furniture, main, article))
                    opened[name] += 1
                if name in CONTAINERS or name == "a":
                    words, tokens, role = _marks(marks)
                    key = name if not words else f"{name}.{words[0]}"
                    context = f"{context}>a" if name == "a" else key
                    inside = main
                    if name in MAIN or role in MAIN:
                        # What holds main text is no furniture; articles in an article, as comments are, leave that open.
                        if not article or "main" in (name, role):
                            at = furniture
                            while at >= 0 and not holds[at]:
                                holds[at], at = True, around[at]
                        main, article = True, article or "article" in (name, role)
                    elif name in ("html", "body"):
                        furniture = -1  # of a head without an end
                    # An article's own header is part of it.
                    elif name in FURNITURE_TAGS or (name == "header" and not inside) or any(map(is_furniture, tokens)):
                        around.append(furniture)
                        holds.append(False)
                        furniture = len(around) - 1
                found.append((False, name, "", furniture, main))
        marked: list[bool] = []
        for at, held in zip(around, holds):
            marked.append(not held or (at >= 0 and marked[at]))
        marked.append(False)  # for -1
        self.tokens: list[tuple[bool, str, str, bool, bool]] = [(t, k, x, marked[f], i) for t, k, x, f, i in found]


def _marks(marks: list[tuple[str, str]]) -> tuple[list[str], list[str], str]:
    """Words in the class and id, both as a whole, and the role."""
    words: list[str] = []
    tokens: list[str] = []
    role = ""
    for name, value in marks:
        if name == "role":
            role = role or value
        else:
            words += re.findall(r"[a-z]+", value)
            tokens += value.split()
    return words, tokens, role


Weights = tuple[dict[str, float], dict[str, float]]


def learn(pages: Iterable[str]) -> Weights:
    """Weights of words by context and of tags by name, from pages that mark their main text."""
    words: dict[bool, Counter] = {True: Counter(), False: Counter()}
    tags: dict[bool, Counter] = {True: Counter(), False: Counter()}
    for source in pages:
        tokens = Page(source).tokens
        if not any(main and not furniture for _, _, _, furniture, main in tokens):
            continue
        for is_text, key, text, furniture, main in tokens:
            inside = main and not furniture
            if is_text:
                words[inside][key] += len(text.split())
            else:
                tags[inside][key] += 1
    out_words = {k: _weight(words[True][k], words[False][k]) for k in {*words[True], *words[False]}}
    out_tags = {k: min(-0.05, _weight(tags[True][k], tags[False][k], 1.0 if k.lstrip("/") in INLINE else 8.0)) for k in {*tags[True], *tags[False]}}
    return out_words, out_tags


def _weight(inside: int, outside: int, most: float = 2.0) -> float:
    """Log odds of standing in the main text; little seen tokens weigh little."""
    return max(-most, min(1.0, math.log((inside + 0.5) / (outside + 0.5)) * min(1.0, (inside + outside) / 20)))


def main_run(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the run with the largest positive sum, the first of equals; (0, 0) if there is none."""
    best, begin, end = 0.0, 0, 0
    total, start = 0.0, 0
    for i, x in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += x
        if total > best:
            best, begin, end = total, start, i + 1
    return begin, end


def extract(source: str | None, weights: Weights) -> str:
    """The main text of a page."""
    words, tags = weights
    tokens = Page(source or "").tokens
    scores = []
    for is_text, key, text, furniture, _ in tokens:
        if furniture:  # left out below; it must not end a run that goes on behind it
            scores.append(0.0)
        elif is_text:
            n = len(text.split())
            w = words.get(key)
            if w is None:
                w = words.get(key.split(".")[0].split(">")[0], 1.0)
            scores.append(n * w)
        else:
            scores.append(tags.get(key, -1.0))
    begin, end = main_run(scores)
    parts = []
    for is_text, key, text, furniture, _ in tokens[begin:end]:
        if is_text:
            if not furniture:
                parts.append(text)
        elif key.lstrip("/") not in INLINE:
            parts.append(" ")
    return " ".join(html.unescape("".join(parts)).split())


def fit(pages: DataFrame, most: int = TRAIN_PAGES, chars: int = TRAIN_CHARS) -> Weights:
    """Weights from about ``most`` pages of at most ``chars`` characters, drawn by a hash of the page.

    They come to the driver, which the bounds allow.
    """
    known = pages.where(F.col("html").isNotNull() & (F.length("html") <= chars)).select("html")
    n = known.count()
    if not n:
        return {}, {}
    scale = 1 << 30
    drawn = known.where(F.pmod(F.xxhash64(F.lit("pages"), "html"), F.lit(scale)) < min(scale, most * scale // n))
    return learn(sorted(r["html"] for r in drawn.distinct().collect()))


def main_text(df: DataFrame, weights: Weights, column: str = "html", to: str = "text") -> DataFrame:
    """Adds the main text; an input column of that name is replaced."""
    fields = [f for f in df.schema if f.name != to]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            columns = {f.name: batch.column(f.name) for f in fields}
            columns[to] = pa.array([extract(x.as_py(), weights) for x in batch.column(column)], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return df.select(*(F.col(f"`{f.name}`") for f in fields)).mapInArrow(run, T.StructType([*fields, T.StructField(to, T.StringType())]))


def op10_html_text(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = main_text(pages, fit(pages))
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
