"""Main-text extraction with a linear-chain CRF over DOM leaf blocks.

A page is cut into leaf blocks: runs of inline content between block-level tags,
with the elements that enclose them. Each block gets features of its ancestors (tags,
class and id words) and of its text (length, share of links, ending, place on the
page); the CRF labels the sequence as main text or not, by Viterbi.

The CRF is trained by gradient on its log-likelihood. Its labelled pages are a bounded
sample of the table's pages that mark their article themselves (``article`` or
``main``), of each its first ``PAGE_BLOCKS`` blocks, and, so that it knows pages that don't, the sampled texts set again into
generated templates: plain ``div`` layouts, menus, headers, sidebars, notices, adverts,
forms, footers and reader comments, each with its label by construction.

Defined results: null and empty pages have an empty text; scripts, styles,
comments and the document head never are text; character references are decoded;
white space in a block (``br`` included) becomes one space; blocks are joined by a line
feed; formulas, drawings, listings (``xmp``, as they are written), ``object`` and
``noscript`` content are text like any other; repeated rows get equal results; without a usable training page the generated
templates are filled with placeholder words.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import arrow_column, prepare

SAMPLE_PAGES = 200
GENERATED = 500
PAGE_BLOCKS, RUN_BLOCKS = 1024, 128     # of a labelled page that training looks at, and at once
STEPS, RATE, DECAY = 120, 0.15, 1e-3
_CACHED_PATHS = 20_000

# HTML element names (fixed values).
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre search section select summary table tbody "
    "td tfoot th thead tr ul xmp".split())
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
# Content up to the end tag is no markup; without one it is the rest of the page, as in browsers.
RAW_TAGS = frozenset("script style textarea title iframe".split())
# Skipped to the end tag if there is one.
SKIPPED_TAGS = RAW_TAGS | {"template"}
_END_OF = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE | re.ASCII) for tag in SKIPPED_TAGS | {"xmp"}}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)>?", re.DOTALL)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|data-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_NAME = re.compile(r"[a-z]+")
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
           "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("ul ol dl table div article section body select".split())


@dataclass
class Block:
    text: str
    path: tuple[str, ...]     # enclosing elements as "tag" or "tag name name"
    words: int
    linked: int               # words inside links
    label: int | None = None  # from a data-label attribute


def _element(tag: str, attributes: str) -> tuple[str, str | None]:
    names, label = [], None
    if "=" in attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            value = m[2] or m[3] or m[4] or ""
            if m[1].lower() == "data-label":
                label = value
            else:
                names += _NAME.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower())[:8]
    return " ".join([tag, *dict.fromkeys(names)]), label


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in page order."""
    found: list[Block] = []
    tags: list[str] = []
    elements: list[str] = []
    labels: list[str | None] = []
    pieces: list[str] = []
    linked: list[str] = []
    anchor = False

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                label = next((x for x in reversed(labels) if x is not None), None)
                found.append(Block(text, tuple(elements), text.count(" ") + 1,
                                   len(" ".join(linked).split()), None if label is None else int(label)))
            pieces.clear()
        linked.clear()

    def close(at: int) -> None:
        del tags[at:], elements[at:], labels[at:]

    position = 0
    size = len(page)
    while position < size:
        match = _TOKEN.search(page, position)
        begin = match.start() if match else size
        if begin > position:
            piece = page[position:begin]
            pieces.append(piece)
            if anchor:
                linked.append(piece)
        if not match:
            break
        position = match.end()
        tag = match[2]
        if tag is None:
            continue
        tag = tag.lower()
        if match[1]:
            if tag == "a":
                anchor = False
            if tag in BLOCK_TAGS:
                flush()
                anchor = False
                if tag in tags:
                    close(len(tags) - 1 - tags[::-1].index(tag))
            continue
        attributes = match[3] or ""
        if (tag in SKIPPED_TAGS or tag == "head") and not attributes.endswith("/"):
            if tag != "head":
                end = _END_OF[tag].search(page, position)
                if end or tag in RAW_TAGS:
                    position = end.start() if end else size
            continue
        if tag == "br":
            pieces.append(" ")
        elif tag == "a":
            anchor = True
        elif tag in BLOCK_TAGS:
            flush()
            anchor = False
            if tag == "body":
                close(0)
            elif "p" in tags and tag not in ("button", "option", "select"):
                last = len(tags) - 1 - tags[::-1].index("p")
                if not _SCOPE.intersection(tags[last + 1:]):
                    close(last)
            for other in _CLOSES.get(tag, ()):
                for at in range(len(tags) - 1, -1, -1):
                    if tags[at] == other:
                        close(at)
                        break
                    if tags[at] in _SCOPE and not (tag in ("td", "th", "tr") and tags[at] == "div"):
                        break
            if tag not in VOID_TAGS:
                element, label = _element(tag, attributes)
                tags.append(tag)
                elements.append(element)
                labels.append(label)
            if tag == "xmp" and (end := _END_OF[tag].search(page, position)):
                pieces.append(html.escape(page[position:end.start()], False))
                position = end.start()
        elif tag in VOID_TAGS and tag != "wbr":
            pass
    flush()
    return found


def path_features(path: tuple[str, ...]) -> list[str]:
    names = ["bias"]
    for element in path:
        tag, *words = element.split(" ")
        names.append(f"in {tag}")
        names += [f"named {w}" for w in words]
    if path:
        names += [f"parent {path[-1].split(' ')[0]}", f"depth {min(len(path), 6)}"]
    return list(dict.fromkeys(names))


def text_features(block: Block, index: int, count: int, after_heading: bool) -> list[str]:
    text = block.text
    return [
        f"words {min(block.words.bit_length(), 8)}",
        f"links {-(-4 * min(block.linked, block.words) // block.words)}",
        f"ends {text[-1] if text[-1] in '.!?:' else 'other'}",
        f"place {4 * index // count}", f"after heading {after_heading}",
        f"copyright {'©' in text}", f"commas {min(text.count(','), 3)}"]


def _is_heading(block: Block) -> bool:
    return bool(block.path) and block.path[-1].split(" ")[0] in ("h1", "h2")


# Words by which a heading announces reader comments (fixed values).
_COMMENTS = re.compile(r"\b(comments?|responses|replies|discussion|kommentare?|antworten|commentaires?|réponses|"
                       r"comentarios?|respuestas)\b", re.IGNORECASE)


def page_features(found: list[Block]) -> Iterator[tuple[tuple[str, ...], list[str]]]:
    heading, comments = False, False
    for i, block in enumerate(found):
        heading = heading or _is_heading(block)
        comments = comments or block.words <= 4 and _COMMENTS.search(block.text) is not None
        yield block.path, text_features(block, i, len(found), heading) + [f"after comments {comments}"]


class Crf:
    """Two labels (0 other, 1 main text): weights by feature, and transitions."""

    def __init__(self, weights: dict[str, tuple[float, float]], start: np.ndarray, step: np.ndarray):
        self.weights, self.start, self.step = weights, start, step
        self.paths: dict[tuple[str, ...], tuple[float, float]] = {}

    def _sum(self, names: list[str]) -> tuple[float, float]:
        known = [self.weights[n] for n in names if n in self.weights]
        return sum(a for a, _ in known), sum(b for _, b in known)

    def _path(self, path: tuple[str, ...]) -> tuple[float, float]:
        score = self.paths.get(path)
        if score is None:
            if len(self.paths) >= _CACHED_PATHS:
                self.paths.clear()
            score = self.paths[path] = self._sum(path_features(path))
        return score

    def decode(self, found: list[Block]) -> list[int]:
        """The most likely labels, by Viterbi; ties go to 0."""
        if not found:
            return []
        (s0, s1), ((t00, t01), (t10, t11)) = self.start.tolist(), self.step.tolist()
        back, v0, v1 = [], s0, s1
        for i, (path, names) in enumerate(page_features(found)):
            p, t = self._path(path), self._sum(names)
            e0, e1 = p[0] + t[0], p[1] + t[1]
            if i:
                from0, from1 = (v0 + t00 < v1 + t10), (v0 + t01 < v1 + t11)
                back.append((from0, from1))
                v0, v1 = (v1 + t10 if from0 else v0 + t00), (v1 + t11 if from1 else v0 + t01)
            v0, v1 = v0 + e0, v1 + e1
        labels = [int(v1 > v0)]
        for pair in reversed(back):
            labels.append(int(pair[labels[-1]]))
        return labels[::-1]

    def extract(self, page: str | None) -> str:
        found = blocks(page) if page else []
        return "\n".join(b.text for b, y in zip(found, self.decode(found)) if y)


def _sequences(pages: list[list[Block]]) -> list[tuple[list, list[int], bool]]:
    """Training sequences (features, labels, whether the page starts here): the first
    ``PAGE_BLOCKS`` blocks of each page, in runs of at most ``RUN_BLOCKS``."""
    out = []
    for page in pages:
        known = list(islice(page_features(page), PAGE_BLOCKS))
        for at in range(0, len(known), RUN_BLOCKS):
            some = known[at:at + RUN_BLOCKS]
            out.append((some, [b.label or 0 for b in page[at:at + len(some)]], at == 0))
    return out


def fit(pages: list[list[Block]], *, steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> Crf:
    """Maximum likelihood by Adam, all sequences at once. Beyond a sequence's end the forward
    scores stay and the backward scores are zero."""
    runs = _sequences([p for p in pages if p])
    number: dict[str, int] = {}
    run_of, slot, ids, length = [], [], [], np.array([len(r) for r, _, _ in runs])
    for i, (run, _, _) in enumerate(runs):
        for j, (path, names) in enumerate(run):
            index = [number.setdefault(n, len(number)) for n in path_features(path) + names]
            ids += index
            run_of += [i] * len(index)
            slot += [j] * len(index)
    n, longest = len(runs), int(length.max())
    cell, ids = np.array(run_of) * longest + np.array(slot), np.array(ids)
    gold = np.zeros((n, longest), np.int64)
    live = np.arange(longest) < length[:, None]
    first = np.array([f for _, _, f in runs])[:, None]
    for i, (run, labels, _) in enumerate(runs):
        gold[i, :len(run)] = labels
    hot = np.eye(2)[gold] * live[..., None]
    both = live[:, 1:]
    gold_steps = np.einsum("nta,ntb->ab", hot[:, :-1] * both[..., None], hot[:, 1:])
    size = 2 * len(number) + 6
    theta, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    lse = lambda x, axis: np.logaddexp.reduce(x, axis=axis)
    for it in range(1, steps + 1):
        w, start, step = theta[:-6].reshape(-1, 2), theta[-6:-4], theta[-4:].reshape(2, 2)
        emit = np.stack([np.bincount(cell, w[ids, y], n * longest) for y in (0, 1)], 1).reshape(n, longest, 2)
        forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        forward[:, 0] = start * first + emit[:, 0]
        for t in range(1, longest):
            before = forward[:, t - 1]
            forward[:, t] = np.where(live[:, t, None], lse(before[:, :, None] + step, 1) + emit[:, t], before)
        for t in range(longest - 2, -1, -1):
            ahead = lse(step + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(both[:, t, None], ahead, 0)
        total = lse(forward[:, -1], 1)[:, None, None]
        p = np.exp(np.minimum(forward + backward - total, 0)) * live[..., None]
        pair = forward[:, :-1, :, None] + step + (emit + backward)[:, 1:, None, :] - total[..., None]
        expected = (np.exp(np.minimum(pair, 0)) * both[..., None, None]).sum((0, 1))
        error = (p - hot).reshape(-1, 2)
        gradient = np.concatenate([
            np.stack([np.bincount(ids, error[cell, y], len(number)) for y in (0, 1)], 1).ravel(),
            ((p[:, 0] - hot[:, 0]) * first).sum(0), (expected - gold_steps).ravel()]) / n + decay * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient ** 2
        theta = theta - rate * (m / (1 - 0.9 ** it)) / (np.sqrt(v / (1 - 0.99 ** it)) + 1e-8)
    if not np.isfinite(theta).all():
        raise FloatingPointError("weights of the page model are not finite")
    w = theta[:-6].reshape(-1, 2)
    return Crf({name: (float(w[i, 0]), float(w[i, 1])) for name, i in number.items()},
               theta[-6:-4], theta[-4:].reshape(2, 2))


# Class names that pages use for their parts (fixed values).
_CONTENT = "content post entry story article body text main page blog-post article-body post-content entry-content".split()
_OTHER = {
    "menu": "nav menu navigation navbar topnav breadcrumb".split(),
    "header": "header masthead site-header top banner".split(),
    "footer": "footer site-footer bottom copyright legal".split(),
    "sidebar": "sidebar aside related widget recommended popular".split(),
    "notice": "notice cookie cookie-banner consent alert gdpr popup message".split(),
    "advert": "ad ads advert advertisement sponsored promo promotion adsense".split(),
    "form": "form newsletter subscribe signup search login".split(),
    "comments": "comments comment-list responses discussion replies reader-comments".split(),
    "share": "share social sharing tags".split(),
}


def generated_page(rng: random.Random, texts: list[str]) -> str:
    """A page in a random template, with data-label attributes."""
    text = lambda: html.escape(rng.choice(texts), False)
    short = lambda: html.escape(" ".join(rng.choice(texts).split()[:rng.randint(1, 6)]), False)
    some = lambda: text() if rng.random() < 0.6 else short()
    link = lambda: f'<a href="/{rng.randint(1, 99)}">{short()}</a>'
    listed = lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 8))) + "</ul>"

    def other(kind: str) -> str:
        name = rng.choice(_OTHER.get(kind, [""]))
        tags = {"menu": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"],
                "sidebar": ["aside", "div", "section"], "form": ["form"], "comments": ["section", "div", "ol"],
                }.get(kind, ["div", "section", "p", "aside"])
        tag = rng.choice(tags)
        mark = rng.choice([f'class="{name}"', f'id="{name}"', f'class="{name} box"'])
        if tag in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.5:
            mark = ""
        if kind == "menu":
            inside = listed() if tag != "ul" else "".join(f"<li>{link()}</li>" for _ in range(5))
        elif kind == "header":
            inside = rng.choice([f"<div>{short()}</div>", f"<p>{short()}</p>{listed()}", short()])
        elif kind == "footer":
            inside = rng.choice(["&copy; " + some(), f"<p>{some()}</p>", f"<p>&copy; {short()}</p>{listed()}", some()])
        elif kind == "sidebar":
            inside = f"<h3>{short()}</h3>" + rng.choice([listed(), f"<p>{text()}</p>", f"<div>{some()}</div>"])
        elif kind == "form":
            inside = f"<label>{short()}</label><input><button>{short()}</button>" + rng.choice(["", f"<p>{some()}</p>"])
        elif kind == "comments":
            row = rng.choice(["li", "div", "article"]) if tag != "ol" else "li"
            inside = rng.choice(["", f"<h3>{short()}</h3>"]) + "".join(
                f'<{row} class="comment"><b>{short()}</b> <p>{some()}</p></{row}>' for _ in range(rng.randint(1, 4)))
        elif kind == "readers":           # comments without a name, under a heading
            said = rng.choice(["Comments", "3 comments", "Kommentare", "Commentaires", "Comentarios", "Responses"])
            row = rng.choice(["li", "div", "p"])
            inside = f"<{rng.choice(['h2', 'h3', 'h4', 'p'])}>{said}</h4></h3></h2>" + "".join(
                f"<{row}>{rng.choice(['', f'<b>{short()}</b> '])}{some()}</{row}>" for _ in range(rng.randint(1, 4)))
            mark = ""
        elif kind == "share":
            inside = " ".join(link() for _ in range(3))
        else:
            inside = rng.choice([some(), some()] + ([f"<p>{some()}</p>"] if tag != "p" else []))
        return f'<{tag} {mark} data-label="0">{inside}</{tag}>'

    def body() -> list[str]:
        parts = [f"<h1>{short()}</h1>"] if rng.random() < 0.9 else []
        for _ in range(rng.randint(1, 9)):
            kind = rng.random()
            if kind < 0.75:
                parts.append(f"<p>{text() if rng.random() < 0.85 else short()}</p>")
            elif kind < 0.82:
                parts.append(f"<h2>{short()}</h2>")
            elif kind < 0.88:
                parts.append("<ul>" + "".join(f"<li>{some()}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.92:
                parts.append(f"<blockquote>{text()}</blockquote>")
            elif kind < 0.95:
                parts.append(f"<div>{text()}</div>")
            else:
                parts.append(other(rng.choice(["advert", "share", "sidebar", "form", "notice"])))
        if rng.random() < 0.15:
            parts.append(other("readers"))
        return parts

    wrap = rng.choice(["article", "article", "main", "section", "div", "div", "td", ""])
    mark = f'class="{rng.choice(_CONTENT)}"' if wrap in ("div", "td") or rng.random() < 0.4 else ""
    if wrap:
        main = f'<{wrap} {mark} data-label="1">{"".join(body())}</{wrap}>'
    else:                                 # the article's blocks stand in the body
        main = "".join(p if "data-label" in p else re.sub(r"^<(\w+)", r'<\1 data-label="1"', p) for p in body())
    if wrap == "td":
        main = f"<table><tr>{main}</tr></table>"
    elif wrap and rng.random() < 0.3:
        main = f'<{rng.choice(["main", "div"])}>{main}</div></main>'
    before = [other(k) for k in ("notice", "header", "menu", "advert", "form") if rng.random() < 0.5]
    after = [other(k) for k in ("share", "comments", "readers", "sidebar", "advert", "form", "notice", "footer") if rng.random() < 0.5]
    rng.shuffle(before)
    return f'<html><body data-label="0">{"".join(before)}{main}{"".join(after)}</body></html>'


def _marked(found: list[Block]) -> list[Block] | None:
    """Blocks labelled by the page's own article, if it marks one."""
    for block in found:
        tags = [e.split(" ")[0] for e in block.path]
        at = min((tags.index(t) for t in ("article", "main") if t in tags), default=None)
        inside = set(tags[at + 1:]) if at is not None else set()
        named = {w for e in block.path for w in e.split(" ")[1:]}
        block.label = int(at is not None and not inside & {"nav", "aside", "footer", "form", "article"}
                          and not named & {"comment", "comments", "ad", "advert", "sidebar"})
    return found if any(b.label for b in found) else None


def train(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html",
          sample_pages: int = SAMPLE_PAGES, generated: int = GENERATED) -> Crf:
    """Fit on at most ``sample_pages`` pages (the least by a hash of the id) and
    ``generated`` pages made of their texts."""
    rows = pages.select(pages[id_col].cast("string").alias("id"), F.col(f"`{html_col}`").cast("string").alias("page")) \
        .where("page is not null").orderBy(F.xxhash64("id"), F.xxhash64("page")).limit(sample_pages).collect()
    found = [f for r in rows if (f := _marked(blocks(r.page)))]
    texts = sorted({b.text for f in found for b in f if b.words > 3})[:5000] or ["some words of a text, and more."]
    rng = random.Random(7)
    return fit(found + [blocks(generated_page(rng, texts)) for _ in range(generated)])


def extract(pages: DataFrame, model: Crf, *, html_col: str = "html") -> Column:
    """String column with the main text of each page."""
    prepare(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(page: pa.Array) -> pa.Array:
        one = shared.value.extract
        return pa.array([one(p) for p in page.to_pylist()], pa.string())

    return arrow_column(run, "string")(F.col(f"`{html_col}`").cast("string"))
