"""Main text of web pages: a recurrent labeller over the page's text blocks.

A page is read as a sequence of leaf blocks (runs of text inside one block
element) with their tag paths. A bidirectional LSTM in numpy reads the whole
sequence, each block as the mean of its path's hashed vectors (tags, classes,
ids), the mean of its words' hashed vectors, and a few lengths, and labels
every block as main text or not.

The labeller is trained here, on the driver, on at most ``TRAIN_PAGES`` pages
in hash order. Their blocks are labelled by the names on their paths
(``BOILERPLATE``); copies of the pages get further blocks under such names and
other names for the article's element, so that templates which the sample
lacks are learned too.

Defined results: null or empty html gives an empty text with 0 characters;
markup that never closes is closed by the end of the page, a tag without its end or
with a quote that never closes is text; an unknown reference
stays as it is; scripts, styles, titles, form texts, closed templates and the
content of ``noscript`` and frames are no text of the page, while ``svg``, ``math``
and ``object`` are read like other markup and ``xmp`` as it stands; repeated rows are extracted each on its own; an empty table
gives an empty table; other columns are ignored. White space inside a block
becomes one blank, and ``<br>`` counts as white space. Text of an inline
element with a boilerplate name is a block of its own.
"""

from __future__ import annotations

import html as html_lib
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripyard.llm import _words
from tripyard.llm._tables import ship, text_column

TRAIN_PAGES, TRAIN_BLOCKS = 240, 120
PATH_BUCKETS, WORD_BUCKETS, VECTOR, HIDDEN = 1 << 15, 1024, 16, 16
#: Stands in the training pages for the names that they lack.
UNSEEN = "unseen"
STEPS, BATCH, RATE, PAGE_BATCH = 160, 24, 0.02, 256

#: Elements that start and end blocks of text (fixed values of the language).
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody td tfoot th thead title tr ul xmp".split())
#: Elements without content, and those whose content is not markup.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe noembed noframes".split())
#: Elements of other vocabularies, those of their elements that hold HTML again,
#: those whose text stands apart, and the start tags that end a drawing or formula.
FOREIGN = frozenset("svg math".split())
HTML_INSIDE = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
FOREIGN_LINES = frozenset("text annotation annotation-xml".split())
BREAKS_OUT = (BLOCK_TAGS - {"title"}) | frozenset("b big br code em embed i img listing meta nobr ruby s small span strong strike sub sup tt u var".split())
#: A start tag ends an open element of these (no nesting without a container).
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "option": ("option",), "optgroup": ("option", "optgroup")}
CLOSABLE = frozenset(("p", *(t for tags in CLOSED_BY.values() for t in tags)))
CONTAINERS = frozenset("ul ol menu dl table select body html article section div".split())

#: Names on a path whose blocks are not the article.
BOILERPLATE = frozenset(
    "nav menu header footer aside sidebar ad ads advert advertisement sponsor promo banner notice cookie consent form button "
    "select option input comment comments reply breadcrumb share social recommended subscribe newsletter "
    "login signup search pagination copyright modal toolbar widget topbar masthead navbar".split())
#: Elements whose classes and ids say nothing of the text (page states, kinds of
#: article, anchors), and elements inside which names are those of code.
UNNAMED = frozenset("html body main h1 h2 h3 h4 h5 h6".split())
CODE = frozenset("pre code samp kbd".split())
#: First parts of a name that make it a state of something else, and last parts that only say box.
STATES = frozenset("no not non has have with without is hide hidden toggle".split())
BOXES = frozenset("area bar block bottom box container group holder inner item items left link links list outer panel right section slot top "
                  "unit wrap wrapper".split())

_COMMENT = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))", re.S)
_ATTRIBUTES = re.compile(r"(?:[^\"'>]+|\"[^\"]*\"|'[^']*')*+>")
_NAME_END, _DELIMITER = re.compile(r"[\s/>]"), re.compile(r"[\"'>]")
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[a-z]+|[0-9]+")
_TEMPLATE = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)(?=[\s/>]).*?(?:</\1(?=[\s/>])|\Z)|<(/?)template(?=[\s/>])[^>]*>", re.S | re.I)


class Path:
    """An open element with a link to the one around it, so that deep pages share
    their paths. ``near``: places in the stack of the outermost open elements that
    no container shields. ``adds``, ``forms``: what it adds to ``path_names``, and
    how often "form" is among them; ``fresh``: names around it do not count;
    ``unformed``: the "form" entries around it that it takes away."""

    __slots__ = ("parent", "tag", "own", "foreign", "inline", "near", "adds", "fresh", "unformed", "forms", "in_article", "code", "total")

    def __init__(self, parent: Path | None, tag: str, own: tuple[str, ...], foreign: bool, inline: bool, place: int):
        self.parent, self.tag, self.own, self.foreign, self.inline = parent, tag, own, foreign, inline
        around = parent.near if parent else {}
        self.near = {} if tag in CONTAINERS else {**around, tag: place} if tag in CLOSABLE and tag not in around else around
        self.total: tuple[np.ndarray, int] | None = None
        self.fresh = parent is None or tag == "main"
        forms, code = (0, False) if self.fresh else (parent.forms, parent.code)
        self.in_article = parent is not None and parent.in_article
        self.unformed, told = 0, tag not in UNNAMED
        if tag == "article" and not self.in_article:
            self.unformed, forms, self.in_article, told = forms, 0, True, False
        self.adds = [tag]
        code = code or tag in CODE
        for name in own[1:]:
            if name[:1] == "=" and told and not code:
                self.adds += [x for n in map(_meaning, name[1:].split()) if n for x in (f"={n}", n)]
                code = not CODE.isdisjoint(self.adds)
        self.forms, self.code = forms + self.adds.count("form"), code

    def names(self) -> tuple[str, ...]:
        """Tags, classes, ids and roles from the outermost element on."""
        chain, node = [], self
        while node is not None:
            chain.append(node.own)
            node = node.parent
        return tuple(n for own in reversed(chain) for n in own)

    def vector(self, table: np.ndarray, paths: Buckets) -> np.ndarray:
        """Mean of the vectors of ``path_names``, each element's sum kept for those inside it."""
        chain, node = [], self
        while node is not None and node.total is None:
            chain.append(node)
            node = None if node.fresh else node.parent
        for node in reversed(chain):
            total, n = (0.0, 0) if node.fresh else node.parent.total
            if node.unformed:
                total, n = total - node.unformed * table[paths["form"]].astype(np.float64), n - node.unformed
            index = [paths[x] for x in node.adds]
            node.total = total + table[index].sum(axis=0, dtype=np.float64), n + len(index)
        total, n = self.total
        return total / n


class _Tags:
    """Ends of tags, each in time that adds up to the length of the page: where
    a quote or tag that never ends was met, no later tag runs through it again."""

    def __init__(self, html: str):
        self.html, self.last = html, html.rfind(">")
        self.delimiters: list[int] | None = None
        self.dead: set[int] = set()  # delimiters after which no tag ends
        self.name_end = -1

    def _end(self, at: int) -> int:
        """Place after the ``>`` that ends attributes begun at ``at``, or -1."""
        if self.delimiters is None:
            m = _ATTRIBUTES.match(self.html, at)
            if m:
                return m.end()
            self.delimiters = [m.start() for m in _DELIMITER.finditer(self.html)]
        met = []
        while (i := bisect_left(self.delimiters, at)) < len(self.delimiters):
            place = self.delimiters[i]
            if place in self.dead:
                break
            if self.html[place] == ">":
                return place + 1
            met.append(place)
            at = self.html.find(self.html[place], place + 1) + 1
            if not at:
                break
        self.dead.update(met)
        return -1

    def tag(self, at: int, begin: int) -> tuple[str, str, int] | None:
        """(name, attributes, end) of the tag whose name begins at ``begin``; None if it never ends."""
        if begin > self.last:
            return None
        if self.name_end < begin:
            self.name_end = _NAME_END.search(self.html, begin).start()
        name_end = self.name_end
        end = self._end(name_end)
        if end < 0:  # a quote in the name: it begins the attributes
            quote = self.delimiters[bisect_left(self.delimiters, begin)]
            if quote >= name_end or (end := self._end(quote)) < 0:
                return None
            name_end = quote
        return self.html[begin:name_end].lower(), self.html[name_end:end - 1], end

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """(start, end, whether an end tag, name, attributes) of the next markup;
        comments and the like have no name."""
        html = self.html
        while (at := html.find("<", at)) >= 0:
            if html.startswith("<!--", at):
                return at, _COMMENT.match(html, at).end(), False, "", ""
            after = html[at + 1:at + 2]
            begin = at + 2 if after == "/" else at + 1
            first = html[begin:begin + 1]
            if first.isascii() and first.isalpha() and (found := self.tag(at, begin)):
                return at, found[2], begin > at + 1, found[0], found[1]
            if after in ("!", "?", "/") and after and at < self.last:
                return at, html.find(">", at) + 1, False, "", ""
            at += 1
        return None


def blocks_of(html: str) -> list[tuple[str, tuple[str, ...], float]]:
    """(text, path names, share of linked characters) of the leaf blocks."""
    return [(text, path.names() if path else (), share) for text, path, share in linked_blocks(html)]


def linked_blocks(html: str) -> list[tuple[str, Path | None, float]]:
    """(text, path, share of linked characters) of the leaf blocks."""
    found: list[tuple[str, Path | None, float]] = []
    open_tags: list[Path] = []
    held: Counter[str] = Counter()  # open elements by tag
    parts: list[str] = []
    linked = total = 0
    path: Path | None = None
    begun = apart = False
    at, tags = 0, _Tags(html)
    templates: dict[int, int] | None = None
    data_ends = True

    def flush() -> None:
        nonlocal parts, linked, total, path, begun
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                found.append((text, path, linked / max(1, total)))
        parts, linked, total, path, begun = [], 0, 0, None, False

    def add(raw: str, literal: bool = False) -> None:
        nonlocal linked, total, path, begun, apart
        if not raw or open_tags and open_tags[-1].tag in RAW_TAGS:  # open only inside svg and math
            return
        text = html_lib.unescape(raw) if "&" in raw and not literal else raw
        if not text.isspace():
            inside = bool(open_tags) and open_tags[-1].inline
            if begun and inside != apart:
                flush()
            if not begun:
                path, begun, apart = open_tags[-1] if open_tags else None, True, inside
        parts.append(text)
        total += len(text)
        if held["a"]:
            linked += len(text)

    def cut(place: int) -> None:
        while len(open_tags) > place:
            held[open_tags.pop().tag] -= 1

    def close(kinds: tuple[str, ...]) -> None:
        """Ends the open elements of ``kinds`` that no container shields."""
        near = open_tags[-1].near if open_tags else {}
        cut(min((near[k] for k in kinds if k in near), default=len(open_tags)))

    while at < len(html):
        m = tags.next(at)
        if not m:
            add(html[at:])
            break
        start, end, ends, tag, attributes = m
        add(html[at:start])
        at = end
        foreign = bool(open_tags) and open_tags[-1].foreign
        if not tag:
            if foreign and data_ends and html.startswith("<![CDATA[", start):
                if (end := html.find("]]>", start)) >= 0:
                    add(html[start + 9:end], literal=True)
                    at = end + 3
                data_ends = end >= 0
            continue
        if foreign and not ends and tag in BREAKS_OUT:
            while open_tags and open_tags[-1].foreign:
                cut(len(open_tags) - 1)
            foreign = False
        if tag == "br" or foreign and tag in FOREIGN_LINES:
            parts.append(" ")
        if tag == "br":
            continue
        block = tag in BLOCK_TAGS and not (foreign and tag == "title")
        if block:
            flush()
        if ends:
            if held[tag]:  # a stray </p> only ends the block
                while open_tags[-1].tag != tag:
                    cut(len(open_tags) - 1)
                cut(len(open_tags) - 1)
            continue
        if tag in RAW_TAGS and not foreign:
            at = _end_of(tag, html, at)[1]
            continue
        empty = attributes.endswith("/")
        if tag == "template" and not empty:
            if templates is None:
                templates = _template_ends(html, tags.last + 1)
            at = templates.get(at, at)  # one that never closes hides nothing
            continue
        if block and tag not in ("html", "body"):
            close(("p",))
        if tag in CLOSED_BY:
            close(CLOSED_BY[tag])
        if tag not in VOID_TAGS and not empty:
            own = (tag, *_own_names(attributes))
            inline = tag not in BLOCK_TAGS and (bool(open_tags) and open_tags[-1].inline or len(own) > 1 and not name_label(own)
                                                and not any(held[t] for t in CODE))
            open_tags.append(Path(open_tags[-1] if open_tags else None, tag, own, tag in FOREIGN or foreign and tag not in HTML_INSIDE, inline, len(open_tags)))
            held[tag] += 1
        if tag == "xmp" and not empty:
            stop, at = _end_of(tag, html, at)
            add(html[end:stop], literal=True)
            flush()
            cut(len(open_tags) - 1)
    flush()
    return found


def _end_of(tag: str, html: str, at: int) -> tuple[int, int]:
    """Start and end of the next end tag, or the end of the page twice."""
    end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
    return end.span() if end else (len(html), len(html))


def _template_ends(html: str, size: int) -> dict[int, int]:
    """End of a template's start tag -> end of its end tag, of those that close
    before ``size``, the end of the last tag."""
    found, begun = {}, []
    for m in _TEMPLATE.finditer(html, 0, size):
        if m[2] is None:  # a comment or script
            continue
        if not m[2]:
            if not m[0].endswith("/>"):
                begun.append(m.end())
        elif begun:
            found[begun.pop()] = m.end()
    return found


def _own_names(attributes: str) -> list[str]:
    if "=" not in attributes:
        return []
    return [part for m in _NAMES.finditer(attributes) for value in [(m[2] or m[3] or m[4] or "").lower()]
            for part in (f"={value}", *_PART.findall(value))]


@lru_cache(65_536)
def _meaning(name: str) -> str:
    """What one class, id or role names: its last part that is more than a box, or ''."""
    parts = [p for p in _PART.findall(name) if not p.isdigit()]
    if not parts or parts[0] in STATES:
        return ""
    while len(parts) > 1 and parts[-1] in BOXES:
        parts.pop()
    last = parts[-1]
    return last[:-1] if last not in BOILERPLATE and last[:-1] in BOILERPLATE and last[-1] == "s" else last


@lru_cache(65_536)
def path_names(names: tuple[str, ...]) -> tuple[str, ...]:
    """The names on a path that say what its text is: the tags, and the meaning
    of each class, id and role. What is around ``main`` says nothing of it, nor
    does a form around an article; the names of the outermost article are its kind."""
    found: list[str] = []
    at, tag, told, in_article = 0, "", True, False
    while at < len(names):
        name = names[at]
        at += 1
        if name[:1] != "=":
            tag = name
            if tag == "main":
                found.clear()
            if tag == "article" and not in_article:
                found = [n for n in found if n != "form"]
                in_article, told = True, False
            else:
                told = tag not in UNNAMED
            found.append(tag)
            continue
        at += len(_PART.findall(name))  # the parts of the value follow it
        if told and not CODE.intersection(found):
            found += [x for n in map(_meaning, name[1:].split()) if n for x in (f"={n}", n)]
    return tuple(found)


class Buckets(dict):
    """Hash buckets of names, kept for reuse up to a bound; each boilerplate
    name has one of its own."""

    OWN = {x: i for i, x in enumerate(x for n in sorted(BOILERPLATE) for x in (n, f"={n}"))}

    def __init__(self, size: int):
        self.size = size

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        own = len(self.OWN)
        found = self.OWN.get(word, -1)
        if found < 0:
            found = own + zlib.crc32(word.encode("utf-8", "replace")) % (self.size - own)
        self[word] = found
        return found


@dataclass
class Sequences:
    """Blocks of a batch of pages, flat: bucket lists with their starts, extra
    numbers, and the first block of each page."""

    path: np.ndarray
    path_at: np.ndarray
    word: np.ndarray
    word_at: np.ndarray
    extra: np.ndarray
    page_at: np.ndarray
    path_mean: np.ndarray | None = None

    @classmethod
    def of(cls, pages: list, paths: Buckets, table: np.ndarray | None = None) -> Sequences:
        """Of blocks with path names or, where ``table`` has the vectors, with a Path."""
        path, path_at, texts, linked, sizes, means = [], [], [], [], [0], []
        for blocks in pages:
            for text, names, share in blocks:
                path_at.append(len(path))
                if table is None:
                    path += map(paths.__getitem__, path_names(names) or ("",))
                else:
                    means.append(names.vector(table, paths) if names else table[paths[""]])
                texts.append(text)
                linked.append(share)
            sizes.append(len(texts))
        raw = [t.encode("utf-8", "replace") for t in texts]
        offsets = np.cumsum([0, *map(len, raw)])
        words = _words.Words(np.frombuffer(b"".join(raw), np.uint8), offsets, _words.SPACE)
        extra = np.stack([np.array(linked, np.float32), np.log1p(np.diff(words.first)) / 5, np.log1p(np.diff(offsets)) / 8,
                          np.array([t[-1] in ".!?\u2026" for t in texts], np.float32)], axis=1).astype(np.float32)
        buckets = (words.hashes() % np.uint64(WORD_BUCKETS)).astype(np.int64)
        return cls(np.array(path, np.int64), np.array(path_at, np.int64), buckets, words.first[:-1], extra, np.array(sizes, np.int64),
                   None if table is None else np.array(means, np.float32).reshape(len(texts), VECTOR))


def _means(table: np.ndarray, index: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(np.append(at, len(index))).astype(np.float32)[:, None]
    return np.add.reduceat(table[index], at) / n, n


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockTagger:
    """Vectors, two LSTM directions and a logistic output, with training by
    back-propagation through time (Adam)."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        inputs = 2 * VECTOR + 4
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.p = {"path": draw(PATH_BUCKETS, VECTOR, scale=0.5), "word": draw(WORD_BUCKETS, VECTOR, scale=0.1),
                  "out": draw(2 * HIDDEN + inputs, scale=0.2), "bias": np.zeros(1, np.float32)}
        for side in ("f", "b"):
            self.p[side] = draw(inputs + HIDDEN, 4 * HIDDEN, scale=0.2)
            gate = np.zeros(4 * HIDDEN, np.float32)
            gate[HIDDEN:2 * HIDDEN] = 1  # keep by default
            self.p[f"{side}0"] = gate

    def _inputs(self, s: Sequences) -> tuple[np.ndarray, list]:
        path, n_path = _means(self.p["path"], s.path, s.path_at) if s.path_mean is None else (s.path_mean, None)
        word, n_word = _means(self.p["word"], s.word, s.word_at)
        return np.concatenate([path, word, s.extra], axis=1), [n_path, n_word]

    @staticmethod
    def _grid(s: Sequences) -> tuple[np.ndarray, np.ndarray]:
        """(time, page) -> block number, and where there is one."""
        n = np.diff(s.page_at)
        steps = np.arange(n.max(initial=0))[:, None]
        return np.minimum(s.page_at[:-1] + steps, max(0, s.page_at[-1] - 1)), steps < n

    def _run(self, side: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        """Hidden states over time; a page's state is held where it has no block."""
        w, b = self.p[side], self.p[f"{side}0"]
        h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
        out, tape = np.empty((*x.shape[:2], HIDDEN), np.float32), []
        for t in range(len(x)) if side == "f" else range(len(x) - 1, -1, -1):
            joined = np.concatenate([x[t], h], axis=1)
            z = joined @ w + b
            i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            live = mask[t][:, None]
            before, c = c, np.where(live, f * c + i * g, c)
            th = np.tanh(c)
            h = np.where(live, o * th, h)
            out[t] = h
            if keep:
                tape.append((t, joined, i, f, o, g, before, th, live))
        return out, tape

    def probabilities(self, s: Sequences) -> np.ndarray:
        if not len(s.path_at):
            return np.zeros(0)
        x, _ = self._inputs(s)
        at, mask = self._grid(s)
        grid = x[at]
        features = np.concatenate([self._run("f", grid, mask, False)[0], self._run("b", grid, mask, False)[0], grid], axis=2)
        score = np.empty(len(x), np.float32)
        score[at[mask]] = (features @ self.p["out"] + self.p["bias"])[mask]
        return _sigmoid(score)

    def _gradients(self, s: Sequences, y: np.ndarray) -> dict:
        x, (n_path, n_word) = self._inputs(s)
        at, mask = self._grid(s)
        grid = x[at]
        runs = {side: self._run(side, grid, mask, True) for side in ("f", "b")}
        features = np.concatenate([runs["f"][0], runs["b"][0], grid], axis=2)
        error = np.where(mask, _sigmoid(features @ self.p["out"] + self.p["bias"]) - y[at], 0).astype(np.float32) / len(y)
        g = {"out": np.einsum("tp,tpf->f", error, features), "bias": error.sum().reshape(1)}
        back = error[:, :, None] * self.p["out"]
        d_grid = back[:, :, 2 * HIDDEN:].copy()
        for k, side in enumerate(("f", "b")):
            w = self.p[side]
            gw, gb = np.zeros_like(w), np.zeros_like(self.p[f"{side}0"])
            dh = dc = np.zeros((grid.shape[1], HIDDEN), np.float32)
            for t, joined, i, f, o, gg, before, th, live in reversed(runs[side][1]):
                total = dh + back[t][:, k * HIDDEN:(k + 1) * HIDDEN]
                own = np.where(live, total, 0)
                dcell = np.where(live, dc, 0) + own * o * (1 - th * th)
                z = np.concatenate([dcell * gg * i * (1 - i), dcell * before * f * (1 - f), own * th * o * (1 - o), dcell * i * (1 - gg * gg)], axis=1)
                gw += joined.T @ z
                gb += z.sum(0)
                dj = z @ w.T
                d_grid[t] += dj[:, :-HIDDEN]
                dh = np.where(live, dj[:, -HIDDEN:], total)
                dc = np.where(live, dcell * f, dc)
            g[side], g[f"{side}0"] = gw, gb
        dx = np.zeros_like(x)
        np.add.at(dx, at[mask], d_grid[mask])
        for name, index, starts, n, columns in (("path", s.path, s.path_at, n_path, slice(0, VECTOR)), ("word", s.word, s.word_at, n_word, slice(VECTOR, 2 * VECTOR))):
            g[name] = np.zeros_like(self.p[name])
            np.add.at(g[name], index, np.repeat(dx[:, columns] / n, np.diff(np.append(starts, len(index))), axis=0))
        return g

    def fit(self, pages: list, seed: int = 3) -> None:
        """``pages``: lists of (block, label)."""
        rng = np.random.default_rng(seed)
        paths = Buckets(PATH_BUCKETS)
        state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        for step in range(1, STEPS + 1):
            picked = [pages[i] for i in rng.choice(len(pages), min(BATCH, len(pages)), replace=False)]
            s = Sequences.of([[b for b, _ in page] for page in picked], paths)
            y = np.array([label for page in picked for _, label in page], np.float32)
            for k, g in self._gradients(s, y).items():
                m, v = state[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                self.p[k] -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        # names that no page of the training has are told by nothing but that
        self.p["path"][~state["path"][1].any(axis=1)] = self.p["path"][paths[UNSEEN]]


def name_label(names: tuple[str, ...]) -> float:
    """1 for a block with no boilerplate name on its path."""
    return float(BOILERPLATE.isdisjoint(path_names(names)))


_ARTICLE_NAMES = [("main",), ("div", "=content", "content"), ("section", "=post", "post"), ("div", "=main", "main"),
                  ("td",), ("div", "=entry", "entry"), ("div", "=article", "article", "=body", "body"), ("div",)]
_INLINE = [("p", "span"), ("p", "a"), ("li", "span")]
_INSIDE = [("p",), ("h2",), ("h3",), ("blockquote",), ("ul", "li"), ("ol", "li"), ("pre",), ("table", "tr", "td"), ("figure", "figcaption"),
           ("dl", "dd"), ("div",), ("p", "b"), ("p", "em"), ("p", "a"), ("section", "p"), ("div", "p")]


def training_pages(pages: list[str], seed: int = 17) -> list:
    """Labelled block sequences: the sampled pages and changed copies."""
    rng = np.random.default_rng(seed)
    bad = sorted(BOILERPLATE)
    tags = {"nav", "header", "footer", "aside", "form", "button", "select", "option", "menu", "search"}
    made = []
    for page in pages:
        blocks = linked_blocks(page)
        lo = int(rng.integers(0, max(1, len(blocks) - TRAIN_BLOCKS + 1)))  # a long page gives a stretch of it
        own = [((t, n, a), name_label(n)) for t, p, a in blocks[lo:lo + TRAIN_BLOCKS] for n in [p.names() if p else ()]]
        if not own:
            continue
        made.append(own)
        words = [w for (t, _, _), _ in own for w in t.split()]
        some = lambda k: " ".join(words[i] for i in rng.integers(0, len(words), k))

        def plain() -> tuple[str, ...]:
            return (("div", "section", "span", "p", UNSEEN)[rng.integers(5)], f"={UNSEEN}", UNSEEN) if rng.random() < 0.3 else ()

        for _ in range(2):
            article = _ARTICLE_NAMES[rng.integers(len(_ARTICLE_NAMES))]
            changed = []
            for (text, names, linked), label in own:
                if label and rng.random() < 0.3:
                    changed.append(((some(int(rng.integers(1, 60))), ("html", "body", *article, *plain(), *_INSIDE[rng.integers(len(_INSIDE))], *plain()), float(rng.random() < 0.05)), 1.0))
                if rng.random() < 0.35:
                    name = bad[rng.integers(len(bad))]
                    inline = rng.random() < 0.3  # inside a paragraph
                    around = _INLINE[rng.integers(len(_INLINE))] if inline else (("div", "section", "p", "ul")[rng.integers(4)],)
                    lead = (name,) if name in tags and not inline else (*around, f"={name}", name)
                    outer = ("html", "body", *(article if rng.random() < (0.8 if inline else 0.4) else ()))
                    inner = _INSIDE[rng.integers(len(_INSIDE))] if rng.random() < 0.6 and not inline else ()
                    for _ in range(int(rng.integers(1, 4))):
                        changed.append(((some(int(rng.integers(1, 40))), (*outer, *plain(), *lead, *inner), float(rng.random() < 0.4)), 0.0))
                new = tuple(x for n in names for x in (article if n == "article" else (n,)))
                changed.append(((text, new, linked), label))
            made.append(changed)
    return made


def train(pages: DataFrame, html_col: str = "html") -> BlockTagger | None:
    """A labeller from at most TRAIN_PAGES pages; None without any text."""
    rows = pages.select(text_column(pages, html_col).alias("html")).withColumn("h", F.xxhash64("html"))
    least = [r["h"] for r in rows.select("h").distinct().orderBy("h").limit(TRAIN_PAGES).collect()]
    # equal pages are one row of the sample, however many there are
    sample = rows.where(F.col("h") <= max(least)).groupBy("h").agg(F.min("html").alias("html")).orderBy("h").collect() if least else []
    made = training_pages([r["html"] for r in sample])
    if not made:
        return None
    tagger = BlockTagger()
    tagger.fit(made)
    return tagger


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            tagger: BlockTagger | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row."""
    spark = pages.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(tagger or train(pages, html_col) or BlockTagger())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, paths = shared.value, Buckets(PATH_BUCKETS)
        for batch in batches:
            texts: list[str] = []
            for lo in range(0, len(batch), PAGE_BATCH):
                html = batch.column("html").slice(lo, PAGE_BATCH).to_pylist()
                blocks = [linked_blocks(h) for h in html]
                texts += _main_texts(own, blocks, paths)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    source = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), text_column(pages, html_col).alias("html"))
    return source.mapInArrow(rows, "page_id long, url string, text string, n_chars long")


def _main_texts(tagger: BlockTagger, pages: list, paths: Buckets) -> list[str]:
    """Texts of pages, labelled in groups of similar length (less padding)."""
    out = [""] * len(pages)
    order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
    while order:
        most = max(1, 40_000 // max(1, len(pages[order[-1]])))  # blocks of a group, padded
        group, order = order[-most:], order[:-most]
        chance = tagger.probabilities(s := Sequences.of([pages[i] for i in group], paths, tagger.p["path"]))
        for k, i in enumerate(group):
            keep = chance[s.page_at[k]:s.page_at[k + 1]] >= 0.5
            out[i] = "\n".join(b[0] for b, on in zip(pages[i], keep, strict=True) if on)
    return out
