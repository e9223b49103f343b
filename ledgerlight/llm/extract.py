"""Main text of web pages (operator 8): a tree-structured graphical model over the DOM.

Every block element of a page is a variable with four states: all of its text is main text, none is, some (a scaffold
around it), or most (main text with other parts inside). Runs of text have the first two. A node's features (tag, words in class, id and role, length, links, sentence
ends) give its own potential, and each parent-child pair has one. Sum-product messages go from the leaves up and from the
root down, and a run is kept if its marginal for main text is above a half. The tree has no cycles, so marginals are exact.

Potentials are counted on labelled pages: html in which ``data-main`` on an element says whether it is main text. The
production model is trained on pages that labelled_pages() writes from a seed: many layouts, long and short prose, with
and without telling names. Nodes of a batch of pages are worked level by level in arrays.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import dom
from .common import arrow_map, in_chunks, table

MAIN, REST, SOME, MOST = 0, 1, 2, 3
STATES = 4
TRAINING_PAGES, SEED = 1500, 8

TAGS = {t: i + 1 for i, t in enumerate("#root html body div section article main header footer nav aside form ul ol li p h1 h2 h3 h4 h5 h6 blockquote pre table tbody tr td th dl dt dd figure figcaption details summary address center fieldset menu # a span".split())}
N_TAGS = len(TAGS) + 1
_SENTENCE = re.compile(r"[.!?。…:;]\W*$")
#: Feature of a node -> number of values, and the weight of its log-probability (they overlap).
FEATURES = {"length": (6, 0.3), "links": (4, 0.5), "sentence": (3, 0.3)}
#: Feature of an edge: what the child is called depends on the states of both ends.
EDGES = {"tag": N_TAGS, "hint": len(dom.KINDS)}


def arrays(pages: list[dom.Page]) -> dict[str, np.ndarray]:
    """Nodes of all pages one after the other: parent, depth and features."""
    sizes = np.array([len(p.tag) for p in pages], np.int64)
    base = np.repeat(np.cumsum(sizes) - sizes, sizes)
    flat = lambda name: [x for p in pages for x in getattr(p, name)]
    parent = np.array(flat("parent"), np.int64)
    parent = np.where(parent < 0, -1, parent + base)
    depth = np.array(flat("depth"), np.int64)
    text = flat("text")
    own = np.array([len(t) if t else 0 for t in text], np.int64)
    linked = np.array(flat("linked"), np.int64)
    leaf = np.array([t is not None for t in text], np.bool_)
    ends = np.array([1 if t and _SENTENCE.search(t[-8:]) else 0 for t in text], np.int64)
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(order) else []
    total, in_links = own.copy(), linked.copy()
    for level in reversed(levels):
        at = level[parent[level] >= 0]
        np.add.at(total, parent[at], total[at])
        np.add.at(in_links, parent[at], in_links[at])
    share = in_links / np.maximum(total, 1)
    return {
        "parent": parent, "depth": depth, "leaf": leaf, "levels": levels, "total": total,
        "tag": np.array([TAGS.get(t, 0) for t in flat("tag")], np.int64),
        "hint": np.array(flat("hint"), np.int64),
        "length": np.searchsorted([1, 20, 60, 200, 800], total, side="right"),
        "links": np.searchsorted([0.01, 0.4, 0.8], share, side="right"),
        "sentence": np.where(leaf, ends, 2),
    }


class Model:
    """Log potentials: own[feature][state, value], pair[leaf, parent state, state], named[feature][value, parent state,
    state], root[state]."""

    def __init__(self, own: dict[str, np.ndarray], pair: np.ndarray, named: dict[str, np.ndarray], root: np.ndarray):
        self.own, self.pair, self.named, self.root = own, pair, named, root

    def edges(self, a: dict[str, np.ndarray]) -> np.ndarray:
        """Potential of every node's edge to its parent: (node, parent state, state)."""
        return self.pair[a["leaf"].astype(np.int64)] + sum(self.named[f][a[f]] for f in EDGES)

    def marginals(self, a: dict[str, np.ndarray]) -> np.ndarray:
        """P(state) of every node, by one pass of messages up and one down."""
        n = len(a["parent"])
        score = np.zeros((n, STATES))
        for f, (_, weight) in FEATURES.items():
            score += weight * self.own[f][:, a[f]].T
        score[a["leaf"], SOME:] = -np.inf
        parent, edge = a["parent"], self.edges(a)
        sent = np.zeros((n, STATES))
        gathered = score.copy()
        for level in reversed(a["levels"]):
            at = level[parent[level] >= 0]
            if len(at):
                sent[at] = _log_sum(edge[at] + gathered[at][:, None, :], 2)
                np.add.at(gathered, parent[at], sent[at])
        belief = gathered.copy()
        for level in a["levels"]:
            top = level[parent[level] < 0]
            belief[top] = gathered[top] + self.root
            at = level[parent[level] >= 0]
            if len(at):
                without = belief[parent[at]] - sent[at]
                without -= without.max(axis=1, keepdims=True)
                belief[at] = gathered[at] + _log_sum(edge[at] + without[:, :, None], 1)
        belief -= belief.max(axis=1, keepdims=True)
        p = np.exp(belief)
        return p / p.sum(axis=1, keepdims=True)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def fit(labelled: Iterable[str], smooth: float = 0.5) -> Model:
    """Count potentials on labelled html. Elements without text take no part."""
    pages = [dom.read(x) for x in labelled]
    a = arrays(pages)
    label = np.array([x == "1" for p in pages for x in p.label], np.bool_)
    main = np.where(a["leaf"] & label, a["total"], 0)
    parent = a["parent"]
    for level in reversed(a["levels"]):
        at = level[(parent[level] >= 0)]
        np.add.at(main, parent[at], main[at])
    state = np.where(main == a["total"], MAIN, np.where(main == 0, REST, np.where(label, MOST, SOME)))
    used = a["total"] > 0
    own = {}
    for f, (size, _) in FEATURES.items():
        counts = np.full((STATES, size), smooth)
        np.add.at(counts, (state[used], a[f][used]), 1)
        own[f] = np.log(counts / counts.sum(axis=1, keepdims=True))
    pair = np.full((2, STATES, STATES), smooth)
    pair[1, :, SOME:] = 1e-9
    at = np.flatnonzero(used & (parent >= 0))
    np.add.at(pair, (a["leaf"][at].astype(np.int64), state[parent[at]], state[at]), 1)
    # what holds all or none of the main text holds nothing of the other kind below it
    pair[:, MAIN, 1:] = smooth / 10
    pair[:, REST, [MAIN, SOME, MOST]] = smooth / 10
    named = {}
    for f, size in EDGES.items():
        counts = np.full((size, STATES, STATES), smooth / 10)
        np.add.at(counts, (a[f][at], state[parent[at]], state[at]), 1)
        named[f] = np.log(counts / counts.sum(axis=0))
    root = np.full(STATES, smooth)
    np.add.at(root, state[used & (parent < 0)], 1)
    return Model(own, np.log(pair / pair.sum(axis=2, keepdims=True)), named, np.log(root / root.sum()))


_SYLLABLES = "ba de fi go lu ma ne pi ro su ta ve wi xo ya zu ker lan mor tis".split()


def _words(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n))


def _prose(r: random.Random) -> str:
    return " ".join(_words(r, r.choice((1, 3, 8, 15))).capitalize() + r.choice((".", ".", ".", "!", "?", "")) for _ in range(r.choice((1, 1, 2, 4, 9))))


def _links(r: random.Random, n: int) -> str:
    items = [f'<a href="/{i}">{_words(r, r.randint(1, 4))}</a>' for i in range(n)]
    kind = r.randint(0, 5)
    if kind == 4:
        return "<table><tr>" + "".join(f"<td>{x}</td>" for x in items) + "</tr></table>"
    if kind == 5:
        return "<dl>" + "".join(f"<dt>{x}</dt>" for x in items) + "</dl>"
    return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if kind < 2 else " | ".join(items) if kind == 2 else "".join(f"<p>{x}</p>" for x in items)


def _named(r: random.Random, tags: str, hint: str, plain: float = 0.15) -> tuple[str, str]:
    """Start and end tag of a part, with a telling class or id, mostly."""
    tag = r.choice(tags.split())
    bare = {"div", "section", "p", "ul", "span"}
    if plain >= 1:  # an anonymous page
        tag = r.choice(("div", "div", "div", "td", "section", "center", "p" if hint != "main" else "div"))
        return f"<{tag}" + (f' class="{_words(r, 1)}"' if r.random() < 0.5 else ""), f"</{tag}>"
    if tag not in bare and r.random() < 0.6 or r.random() < plain:
        return f"<{tag}", f"</{tag}>"
    name = r.choice(dom.HINTS[hint].split()) if r.random() < 0.95 else _words(r, 1)
    return f'<{tag} {r.choice(("class", "class", "id"))}="{r.choice(("", "site-", "page-"))}{name}"', f"</{tag}>"


def _misnamed(r: random.Random, share: float) -> str:
    """A class on a piece of prose that would hint at something else, or at nothing, for a share of pieces."""
    if r.random() >= share:
        return ""
    return f' class="{r.choice(dom.HINTS[r.choice(dom.KINDS[1:])].split()) if r.random() < 0.7 else _words(r, 1)}"'


def _boilerplate(r: random.Random, kind: str, anonymous: bool = False) -> str:
    if anonymous:  # nothing but links and words tells what it is
        a, b = _named(r, "div", "menu", 1.0)
        body = _links(r, r.randint(3, 9)) if kind in ("menu", "side", "share", "header") else f"{r.choice(('&copy; ', ''))}{_words(r, r.randint(1, 4))} {' '.join([_links(r, r.randint(1, 4))])}"
        return f'{a} data-main="0">{body}{b}'
    text = lambda: f"<{t}>{_prose(r)}</{t}>" if (t := r.choice(("p", "p", "div", "span", ""))) else _prose(r)
    if kind == "menu":
        (a, b), body = _named(r, "nav nav div ul", "menu", 0.1), _links(r, r.randint(2, 9))
    elif kind == "header":
        (a, b), body = _named(r, "header header div", "header", 0.05), f"<{(t := r.choice(('h1', 'h2', 'div', 'p')))}>{_words(r, r.randint(1, 5))}</{t}>" + (_links(r, 4) if r.random() < 0.4 else "")
    elif kind == "footer":
        (a, b), body = _named(r, "footer footer div", "footer", 0.05), r.choice(("&copy; ", "Copyright ", "")) + text() + (_links(r, 3) if r.random() < 0.4 else "")
    elif kind == "side":
        (a, b), body = _named(r, "aside aside div section", "side", 0.05), f"<h3>{_words(r, 2)}</h3>" * r.randint(0, 1) + r.choice((_links(r, 5), text(), text() + _links(r, 3)))
    elif kind == "notice":
        (a, b), body = _named(r, "div div section p", "notice", 0.0), text()
    elif kind == "advert":
        (a, b), body = _named(r, "div div aside p section", "advert", 0.0), r.choice((text(), text() + text(), _links(r, 1)))
    elif kind == "form":
        (a, b), body = _named(r, "form form form div", "form", 0.0), f"<p>{_words(r, 3)}</p><label>{_words(r, 2)}<input name=q></label><button>{_words(r, 1)}</button>" + (text() if r.random() < 0.5 else "")
    elif kind == "comment":
        (a, b), item = _named(r, "section div ol ul", "comment", 0.0), r.choice(("li", "div", "article"))
        body = f"<h2>{_words(r, 2)}</h2>" * r.randint(0, 1) + "".join(f"<{item}{r.choice(('', ' class=comment'))}><b>{_words(r, 2)}</b> <p>{_prose(r)}</p></{item}>" for _ in range(r.randint(1, 5)))
    else:
        (a, b), body = _named(r, "div p ul", "share", 0.0), _links(r, 3)
    return f'{a} data-main="0">{body}{b}'


def _article(r: random.Random, anonymous: bool = False) -> str:
    inner = []
    make = r.choice(("p", "p", "div", "br", "section", "span")) if anonymous else "p"
    odd = r.choice((0.0, 0.0, 0.0, 0.0, 0.0, 0.1, 0.9))  # some pages give their paragraphs names of their own
    if r.random() < 0.8:
        head = f"<h1>{_words(r, r.randint(1, 9))}</h1>"
        inner.append(f"<header>{head}</header>" if r.random() < 0.1 else head)
    for _ in range(r.choice((1, 2, 3, 6, 12, 25))):
        k = r.random()
        if make != "p" and k < 0.9:
            prose = _prose(r)
            inner.append({"div": f"<div>{prose}</div>", "br": f"{prose}<br><br>", "section": f"<section><h3>{_words(r, 3)}</h3><p>{prose}</p></section>", "span": f"<p><span>{prose}</span></p>"}[make])
        elif k < 0.68:
            inner.append(f"<p{_misnamed(r, odd)}>{_prose(r)}" + r.choice(("</p>", "</p>", "")))
        elif k < 0.74:
            inner.append(f"<h{(n := r.randint(2, 4))}{_misnamed(r, odd)}>{_words(r, 3)}</h{n}>")
        elif k < 0.80:
            inner.append(f"<{(t := r.choice(('ul', 'ol')))}>" + "".join(f"<li>{_prose(r)}</li>" for _ in range(r.randint(1, 5))) + f"</{t}>")
        elif k < 0.84:
            inner.append(f"<blockquote><p>{_prose(r)}</p></blockquote>")
        elif k < 0.87:
            inner.append(f"<pre>{_words(r, 9)}</pre>")
        elif k < 0.90:
            inner.append("<table>" + "".join(f"<tr><td>{_words(r, 2)}</td><td>{_prose(r)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>")
        elif k < 0.92:
            inner.append(f"<figure><img src=x><figcaption>{_prose(r)}</figcaption></figure>")
        elif k < 0.94:
            inner.append(f"<div{_misnamed(r, odd)}>{_prose(r)}</div>")
        elif k < 0.96:
            inner.append(f'<p>{_words(r, 5)} <a href="/x">{_words(r, r.randint(2, 20))}</a> {_prose(r)}</p>')
        else:
            inner.append(_boilerplate(r, r.choice(("advert", "share", "side", "notice", "form"))) if not anonymous else "")
    if r.random() < 0.1 and not anonymous:
        inner.append(_boilerplate(r, "comment"))
    a, b = _named(r, "article article article main main div div section", "main", 1.0 if anonymous else 0.25)
    out = f'{a} data-main="1">' + "".join(inner) + b
    return f'<main data-main="1">{out}</main>' if r.random() < 0.15 else out


def labelled_pages(n: int = TRAINING_PAGES, seed: int = SEED) -> list[str]:
    """Invented pages whose parts are labelled by data-main."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        anonymous = r.random() < 0.2
        before = [_boilerplate(r, k, anonymous) for k in ("notice", "header", "menu", "advert", "form") if r.random() < 0.5]
        after = [_boilerplate(r, k, anonymous) for k in ("share", "comment", "side", "advert", "notice", "form", "footer") if r.random() < 0.5]
        if r.random() < 0.1:
            before, after = [], []
        r.shuffle(before)
        middle = _article(r, anonymous)
        if r.random() < 0.4:
            side = _boilerplate(r, "side", anonymous)
            middle = f"<div>{r.choice((middle + side, side + middle))}</div>"
        if anonymous and r.random() < 0.4:
            body = "<table>" + "".join(f"<tr><td>{x}</td></tr>" for x in (*before, middle, *after)) + "</table>"
        else:
            body = "".join([*before, middle, *after])
        for _ in range(r.choice((0, 0, 1, 2))):
            body = f"<div{r.choice(('', ' class=wrapper', ' id=container'))}>{body}</div>"
        out.append(f"<html><body>{body}</body></html>")
    return out


@lru_cache(1)
def production_model() -> Model:
    return fit(labelled_pages())


def main_text(pages: list[str], model: Model) -> list[str]:
    """Main text of each page: runs with a marginal above a half, by block, white space folded, a line per block."""
    read = [dom.read(x) for x in pages]
    p = model.marginals(arrays(read))[:, MAIN]
    out, at = [], 0
    for page in read:
        blocks: list[list[str]] = []
        last = None
        for i, text in enumerate(page.text):
            if text is not None and p[at + i] > 0.5:
                if page.block[i] != last:
                    blocks.append([])
                    last = page.block[i]
                blocks[-1].append(text)
        at += len(page.tag)
        lines = (" ".join("".join(b).split()) for b in blocks)
        out.append("\n".join(x for x in lines if x))
    return out


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row.

    Null or empty html has the text ''; broken or cut markup is read as far as it goes, and a tag that the end cuts off
    is dropped; repeated rows are worked row by row; extra columns are ignored; an empty table gives no rows. Pages are
    read whole; memory holds one slice of about 2 MB of html and its nodes.
    """
    model = model or production_model()  # some hundred numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "html", 2 << 20):
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                text = main_text([x or "" for x in part.column(2).to_pylist()], model)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string()), pa.array([len(x) for x in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

    chosen = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return arrow_map(chosen, run, "page_id long, url string, text string, n_chars long")


def op8_extract(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op8_extract": op8_extract}
ORACLE_SQL: dict[str, str] = {}
