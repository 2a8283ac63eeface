"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the page tree.

A page is cut into leaf blocks (runs of text between block-level tags).  Each
block has features from its ancestors (tag names, words of class, id and role)
and from its text; the chain has two states, main text and the rest, and is
decoded by Viterbi.  The model is trained on a bounded sample of labelled pages
and is a table of weights, so extraction is one pass over the pages without a
shuffle, a page at a time.

Pages label themselves where they mark their article element.  Since other
sites mark it otherwise or not at all, every sampled page is also dressed anew
in drawn layouts: its own blocks inside other containers, with headers, menus,
sidebars, notices, adverts, forms, reader comments and footers around and in
between.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES = 200          # bound of the labelled sample
TRAIN_CHARS = 60_000       # longer pages are not in the sample (they are extracted whole like all others)
LAYOUTS = 4                # drawn layouts per sampled page
STEPS = 120
DECAY = 0.003

# HTML elements by how they are read.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre "
    "section select summary table tbody td tfoot th thead tr ul".split())
HIDDEN_TAGS = frozenset("script style title template noscript iframe textarea svg object noframes math".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An opening tag of the key closes an open element of the values, up to the nearest of the stoppers.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"},
          "tr": {"tr"}, "option": {"option"}}
STOPPERS = frozenset("ul ol dl table select menu".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>"""
                  r"""|<(/?)([A-Za-z][^\s/>]*)([^>]*)>""", re.S)
_MARKED = re.compile(r"""\b(class|id|role|data-main)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_TOKEN = re.compile(r"[a-z]+")
_ARTICLE = re.compile(r"<(article|main)\b(?![^>]*(?:data-main|comment))", re.I)


class _Node:
    """An open element: its tag, the features it hands down, whether it is in a link, its label."""
    __slots__ = ("tag", "features", "link", "label")

    def __init__(self, tag, features, link, label):
        self.tag, self.features, self.link, self.label = tag, features, link, label


class Block:
    """A leaf block: its pieces of text, the features of its ancestors, its characters in links, its label."""
    __slots__ = ("pieces", "tag", "features", "linked", "label")

    def __init__(self, tag, features, label):
        self.pieces, self.tag, self.features, self.linked, self.label = [], tag, features, 0, label


def leaf_blocks(page: str) -> list[tuple[str, Block]]:
    """(text, block) of every leaf block with text, in page order.

    Character references are decoded, white space becomes single spaces, ends are trimmed.  Missing and stray end tags
    are forgiven the way browsers do it; a tag that the page breaks off is dropped."""
    root = _Node("", frozenset(), False, None)
    stack, open_tags, out, current = [root], {}, [], None
    at, end = 0, page.rfind(">") + 1

    def pop_to(depth: int) -> None:
        for node in stack[depth:]:
            open_tags[node.tag] -= 1
        del stack[depth:]

    def add(raw: str) -> None:
        nonlocal current
        node = stack[-1]
        if current is None:
            if not raw.strip():
                return
            owner = next((n for n in reversed(stack) if n.tag in BLOCK_TAGS), root)
            current = Block(owner.tag, node.features, node.label)
            out.append(current)
        text = entities.unescape(raw) if "&" in raw else raw
        current.pieces.append(text)
        if node.link:
            current.linked += len(text)

    while at < end:
        m = _TAG.search(page, at, end)
        if m is None:
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        tag = m.group(2) or m.group(5)
        if tag is None:
            continue
        tag, closing, attributes = tag.lower(), m.group(1) or m.group(4), m.group(3) or m.group(6) or ""
        if tag in BLOCK_TAGS:
            current = None
        if closing:
            if open_tags.get(tag):
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                pop_to(depth)
            continue
        if tag in HIDDEN_TAGS:
            if attributes.endswith("/") and tag in ("svg", "math", "object"):
                continue
            stop = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = stop.end() if stop else len(page)
            continue
        if tag == "br":
            if current is not None:
                current.pieces.append(" ")
            continue
        if tag in VOID_TAGS:
            continue
        if tag in BLOCK_TAGS and open_tags.get("p"):  # a paragraph ends where a block begins
            depth = len(stack) - 1
            while stack[depth].tag not in BLOCK_TAGS:
                depth -= 1
            if stack[depth].tag == "p":
                pop_to(depth)
        for depth in range(len(stack) - 1, 0, -1) if tag in CLOSES else ():
            if stack[depth].tag in CLOSES[tag]:
                pop_to(depth)
                break
            if stack[depth].tag in STOPPERS:
                break
        parent, new, label = stack[-1], {f"in:{tag}"} if tag in BLOCK_TAGS else set(), stack[-1].label
        if attributes:
            for name, value in _MARKED.findall(attributes):
                value = value.strip("\"'")
                if name.lower() == "data-main":
                    label = value == "1"
                else:
                    new.update(f"at:{w}" for w in _TOKEN.findall(value.lower()))
        features = parent.features if new <= parent.features else parent.features | new
        stack.append(_Node(tag, features, parent.link or tag == "a", label))
        open_tags[tag] = open_tags.get(tag, 0) + 1
    if at < len(page):
        add(re.sub(r"<[A-Za-z/!?][^>]*\Z", "", page[at:], flags=re.S))
    found = ((" ".join("".join(b.pieces).split()), b) for b in out)
    return [(text, b) for text, b in found if text]


def _size_class(text: str) -> str:
    return str(min(7, (text.count(" ") + 1).bit_length()))


def block_features(blocks: list[tuple[str, Block]]) -> list[list[str]]:
    """Names of the features of every block: ancestors, own tag, text, neighbours."""
    out, headed = [], False
    sizes = [_size_class(text) for text, _ in blocks]
    for i, (text, b) in enumerate(blocks):
        headed = headed or b.tag == "h1"
        names = ["one", *b.features, f"tag:{b.tag}", f"size:{sizes[i]}", f"tagsize:{b.tag}:{sizes[i]}"]
        names.append(f"link:{min(2, 3 * b.linked // max(1, len(text)))}")
        names.append("ends" if text[-1] in ".!?…:;\"'”»)" else "open")
        names.append("headed" if headed else "unheaded")
        if "©" in text or "copyright" in text[:200].lower():
            names.append("rights")
        names.append(f"before:{blocks[i - 1][1].tag}:{sizes[i - 1]}" if i else "first")
        names.append(f"after:{blocks[i + 1][1].tag}:{sizes[i + 1]}" if i + 1 < len(blocks) else "last")
        out.append(names)
    return out


class Model:
    """Weights of the chain: a score for main text per feature, and between neighbouring states (0 rest, 1 main)."""

    def __init__(self, weight: dict[str, float], step: list[list[float]], first: list[float]):
        self.weight, self.step, self.first = weight, step, first

    def decode(self, features: list[list[str]]) -> list[bool]:
        """The likeliest states (Viterbi); unknown features count nothing, ties go to the rest."""
        if not features:
            return []
        back, (rest, main) = [], self.first
        step, get = self.step, self.weight.get
        for i, names in enumerate(features):
            if i:
                stay, leave = rest + step[0][0], main + step[1][0]
                enter, keep = rest + step[0][1], main + step[1][1]
                back.append((leave > stay, keep > enter))
                rest, main = max(stay, leave), max(enter, keep)
            main += sum(get(n, 0.0) for n in names)
        state, out = main > rest, []
        for from_rest, from_main in reversed(back):
            out.append(state)
            state = from_main if state else from_rest
        out.append(state)
        return out[::-1]


def train(pages: list[str], steps: int = STEPS, decay: float = DECAY) -> Model:
    """Fit the chain to labelled pages: elements marked data-main="1" hold main text, all else does not.

    Maximises the conditional likelihood (forward and backward sums over all pages at once) with a quadratic penalty,
    by gradient steps of adapted size.  The result depends on the pages alone.  Without pages every score is 0."""
    number: dict[str, int] = {}
    flat, count, labels, lengths = [], [], [], []
    for page in pages:
        blocks = leaf_blocks(page)
        if not blocks:
            continue
        lengths.append(len(blocks))
        for names, (_, b) in zip(block_features(blocks), blocks):
            flat.extend(number.setdefault(n, len(number)) for n in names)
            count.append(len(names))
            labels.append(1 if b.label else 0)
    if not lengths:
        return Model({}, [[0.0, 0.0], [0.0, 0.0]], [0.0, 0.0])
    order = np.argsort(-np.array(lengths), kind="stable")  # longest first: step t works on a head of the pages
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])[order]
    lengths = np.array(lengths)[order]
    flat, owner, y = np.array(flat), np.repeat(np.arange(len(count)), count), np.array(labels)
    at = [starts[lengths > t] + t for t in range(int(lengths[0]))]  # the t-th block of every page that has one
    theta = np.zeros(len(number) + 6)  # features, four steps, two first states
    moment, square = np.zeros_like(theta), np.zeros_like(theta)
    seen_step = np.zeros((2, 2))
    for a, b in zip(at, at[1:]):
        np.add.at(seen_step, (y[a[:len(b)]], y[b]), 1)
    seen_first = np.bincount(y[at[0]], minlength=2).astype(float)
    blocks, n_features = len(count), len(number)
    for it in range(1, steps + 1):
        score = np.zeros((blocks, 2))
        score[:, 1] = np.bincount(owner, theta[flat], blocks)
        step, first = theta[n_features:n_features + 4].reshape(2, 2), theta[n_features + 4:]
        forward, backward = np.zeros((blocks, 2)), np.zeros((blocks, 2))
        forward[at[0]] = first + score[at[0]]
        for a, b in zip(at, at[1:]):
            before = forward[a[:len(b)]][:, :, None] + step
            forward[b] = np.logaddexp(before[:, 0], before[:, 1]) + score[b]
        expected = np.zeros((2, 2))
        for a, b in zip(at[-2::-1], at[:0:-1]):
            a = a[:len(b)]
            after = step + (score[b] + backward[b])[:, None, :]
            backward[a] = np.logaddexp(after[:, :, 0], after[:, :, 1])
            joint = forward[a][:, :, None] + after
            whole = np.logaddexp(forward[a][:, 0] + backward[a][:, 0], forward[a][:, 1] + backward[a][:, 1])
            expected += np.exp(joint - whole[:, None, None]).sum(0)
        main = 1 / (1 + np.exp((forward + backward)[:, 0] - (forward + backward)[:, 1]))
        grad = np.zeros_like(theta)
        grad[:n_features] = np.bincount(flat, (y - main)[owner], n_features)
        grad[n_features:n_features + 4] = (seen_step - expected).ravel()
        p = main[at[0]].sum()
        grad[n_features + 4:] = seen_first - np.array([len(at[0]) - p, p])
        grad = grad / len(lengths) - decay * theta
        moment, square = 0.9 * moment + 0.1 * grad, 0.99 * square + 0.01 * grad * grad
        theta += 0.15 * (moment / (1 - 0.9 ** it)) / (np.sqrt(square / (1 - 0.99 ** it)) + 1e-8)
    return Model({n: float(theta[i]) for n, i in number.items()}, theta[n_features:n_features + 4].reshape(2, 2).tolist(),
                 theta[n_features + 4:].tolist())


def mark_articles(page: str) -> str:
    """The page with its article and main elements marked as main text."""
    return _ARTICLE.sub(r'<\1 data-main="1"', page)


# Container tags and class words of the drawn layouts, by part of a page.
MAIN_PARTS = (
    "article", "main", "article class=post", "div class=content", "div id=main-content", "section class=entry-content",
    "div class=article-body", "div class=post-body", "div itemprop=articleBody", "div id=story", "td class=text",
    "div class=page", "div role=main", "section", "div")
OTHER_PARTS = {
    "header": ("header", "div class=header", "div id=masthead", "div class=site-header", "header class=top banner",
               "div role=banner"),
    "menu": ("nav", "ul class=menu", "div class=nav", "div id=navigation", "ul class=breadcrumb", "div class=toolbar",
             "nav class=navbar", "menu"),
    "sidebar": ("aside", "div class=sidebar", "div id=sidebar", "aside class=related", "div class=widget",
                "section class=recommended", "div class=popular", "div role=complementary"),
    "notice": ("div class=notice", "div class=cookie-banner", "div id=cookie-consent", "div class=alert",
               "section class=disclaimer", "div class=popup modal", "p class=notice", "div class=newsletter",
               "div class=subscribe", "div role=alert", "aside class=notice"),
    "advert": ("div class=ad", "div class=ads", "div class=advert", "div class=advertisement", "aside class=sponsored",
               "div id=ad-slot", "div class=promo", "section class=sponsor", "p class=ad"),
    "form": ("form", "form class=search", "form id=login", "form class=signup", "div class=form"),
    "comments": ("section class=comments", "div id=comments", "div class=comment", "ol class=comment-list",
                 "div class=discussion replies", "section id=comments", "ul class=comments", "div class=reader-comments",
                 "article class=comment"),
    "footer": ("footer", "div class=footer", "div id=footer", "footer class=site-footer", "div role=contentinfo",
               "div class=copyright"),
}


def _open(part: str) -> tuple[str, str]:
    tag, _, attribute = part.partition(" ")
    name, _, value = attribute.partition("=")
    return (f'<{tag} {name}="{value}"' if attribute else f"<{tag}"), tag


def dressed(blocks: list[str], seed) -> str:
    """A labelled page in a drawn layout: ``blocks`` are its main text, stretches of them fill the other parts."""
    draw = random.Random(seed)
    words = " ".join(blocks).split() or ["text"]

    def some(least: int, most: int) -> str:
        n, i = draw.randint(least, most), draw.randrange(len(words))
        return entities.escape(" ".join(words[i:i + n]))

    def inside(kind: str) -> str:
        if kind in ("header", "footer"):
            note = draw.choice(["", "&copy; 2020 ", "Copyright ", "&copy; "]) if kind == "footer" else ""
            return draw.choice([f"{note}{some(1, 12)}", f"<p>{note}{some(1, 10)}</p>", f"<div>{note}{some(1, 5)}</div>",
                                f"<h1>{some(1, 4)}</h1><p>{some(2, 8)}</p>" if kind == "header" else
                                f"<p>{some(3, 40)}</p>{note}{some(2, 6)}"])
        if kind == "menu":
            item = draw.choice(["<li><a href='/x'>{}</a></li>", "<a href='/x'>{}</a> ", "<li>{}</li>"])
            return "".join(item.format(some(1, 3)) for _ in range(draw.randint(2, 8)))
        if kind == "form":
            return (f"<label>{some(1, 5)}</label><input name=q><p>{some(1, 12)}</p>"
                    f"<select><option>{some(1, 2)}<option>{some(1, 2)}</select><button>{some(1, 3)}</button>")
        if kind == "sidebar" and draw.random() < 0.5:
            return f"<h3>{some(1, 4)}</h3><ul>" + "".join(
                f"<li><a href='/y'>{some(2, 9)}</a></li>" for _ in range(draw.randint(2, 6))) + "</ul>"
        wrap = draw.choice(["<p>{}</p>", "<div>{}</div>", "{}", "<li>{}</li>" if kind == "comments" else "<p>{}</p>"])
        body = "".join(wrap.format(some(2, draw.choice([8, 30, 120])))
                       for _ in range(draw.randint(1, 5 if kind == "comments" else 2)))
        return (f"<h{draw.randint(2, 4)}>{some(1, 3)}</h3>" if draw.random() < 0.3 else "") + body

    def other(kind: str) -> str:
        opening, tag = _open(draw.choice(OTHER_PARTS[kind]))
        return f'{opening} data-main="0">{inside(kind)}</{tag}>'

    def maybe(kind: str, chance: float) -> str:
        return other(kind) if draw.random() < chance else ""

    opening, tag = _open(draw.choice(MAIN_PARTS))
    main = []
    for i, text in enumerate(blocks):
        text = entities.escape(text)
        if i == 0 and draw.random() < 0.7:
            main.append(f"<h1>{some(2, 12)}</h1>")
        elif draw.random() < 0.08:
            main.append(f"<h{draw.randint(2, 3)}>{some(1, 8)}</h2>")
        shape = draw.random()
        main.append(f"<p>{text}" + draw.choice(["</p>", "</p>", "", "<br>"]) if shape < 0.85 else
                    f"<blockquote><p>{text}</p></blockquote>" if shape < 0.9 else
                    f"<ul><li>{text}</li><li>{some(3, 20)}</li></ul>" if shape < 0.96 else f"<div>{text}</div>")
        for kind in ("advert", "notice", "sidebar", "form"):
            main.append(maybe(kind, 0.04))
    body = f'{opening} data-main="1">{"".join(main)}{maybe("comments", 0.15)}</{tag}>'
    before = "".join(maybe(k, c) for k, c in (("notice", 0.3), ("header", 0.5), ("menu", 0.6), ("advert", 0.4),
                                              ("form", 0.2), ("sidebar", 0.3)))
    after = "".join(maybe(k, c) for k, c in (("advert", 0.3), ("comments", 0.45), ("sidebar", 0.4), ("form", 0.25),
                                             ("notice", 0.25), ("menu", 0.25), ("footer", 0.8)))
    body = before + body + after
    if draw.random() < 0.3:
        body = f'<div class="{draw.choice(["wrapper", "container", "page", "layout"])}">{body}</div>'
    return f"<html><head><title>{some(1, 5)}</title></head><body>{body}</body></html>"


def labelled_sample(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", n: int = TRAIN_PAGES,
                    most_chars: int = TRAIN_CHARS, layouts: int = LAYOUTS) -> list[str]:
    """At most ``n`` pages of at most ``most_chars`` characters that mark their article (first by hash of the id, then
    of the page), labelled, and ``layouts`` drawn layouts of each."""
    marked = pages.where(F.col(html_col).rlike("(?i)<(article|main)[\\s>]") & (F.length(html_col) <= most_chars)).select(
        F.xxhash64(F.col(id_col).cast("string")).alias("h"), F.xxhash64(html_col).alias("g"),
        F.col(html_col).alias("html"))
    # the hashes are chosen first, so that no page but the sample's leaves its task; equal pages count once
    chosen = marked.select("h", "g").orderBy("h", "g").limit(n).collect()
    if not chosen:
        return []
    h, g = chosen[-1]
    rows = (marked.where((F.col("h") < h) | ((F.col("h") == h) & (F.col("g") <= g)))
            .groupBy("h", "g").agg(F.first("html").alias("html")).orderBy("h", "g").collect())
    out = []
    for r in rows:
        page = mark_articles(r["html"])
        main = [text for text, b in leaf_blocks(page) if b.label]
        out.append(page)
        out.extend(dressed(main[:30], f"{r['h']}:{i}") for i in range(layouts if main else 0))
    return out


def main_text(page: str | None, model: Model) -> str:
    """The blocks of the page that the model calls main text, joined by newlines (null or empty page: empty)."""
    blocks = leaf_blocks(page or "")
    return "\n".join(text for (text, _), main in zip(blocks, model.decode(block_features(blocks))) if main)


def extract(pages: DataFrame, model: Model, html_col: str = "html", text_col: str = "main_text") -> DataFrame:
    """``pages`` with the main text of every page as ``text_col`` (a column of that name is replaced).

    A null or empty page has an empty text.  Repeated rows are each extracted; other columns, whatever their names, are
    carried along.  An empty table gives no rows.  A very long page is worked on whole, in memory proportional to it."""
    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages_in in batches:
            yield pages_in.map(lambda page: main_text(page, model), na_action=None).astype(object)

    return pages.withColumn(text_col, text_of(F.col(html_col)))


def op11_html_extraction(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    model = train(labelled_sample(pages))
    return extract(pages, model, text_col="text").select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op11_html_extraction": op11_html_extraction}
ORACLE: dict[str, str] = {}
