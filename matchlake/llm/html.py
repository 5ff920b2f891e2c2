"""Main text of web pages by a recurrent block labeller.

A page's leaf blocks are read in order: each has the path of open tags above it and its text. A bidirectional LSTM in
numpy reads, per block, a vector of hashed tag-path tokens, hashed words and a few counts, so the label of a block
follows from the whole document before and after it. Blocks labelled as main text are joined by line breaks.

The model is trained where it is used, on a bounded sample of pages (TRAIN_PAGES, by hash): blocks inside an
article or main element and outside of menus, forms, asides and the like are positive. Each training page is also read
in disguise: its elements renamed to plain `div`s with usual class names, with further menus, notices, adverts, forms
and reader comments around and inside the article, so that the labels do not hang on one template.

A block refers to the element it is in, which holds the sums over the elements above it, so a page takes memory in proportion
to its length however deep it nests; pages are labelled in batches of bounded characters and blocks.

Defined cases: null, empty or broken html is read as far as it goes and may have no blocks, then the text is empty;
very long pages are read whole; unclosed elements end with their parents or where HTML lets their end tag out; other columns
of the table, whatever their names, play no part; a null page_id or url is kept; repeated rows are labelled alike; without
sample pages nothing is labelled main text.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.shared import bounded_sample, ship

TRAIN_PAGES = 320  # pages that the labeller is fitted on, at most
TRAIN_CHARS = 60_000  # longer pages are not fitted on; all pages are labelled whole
HIDDEN, EPOCHS, BATCH, RATE, SEED = 12, 14, 16, 0.02, 5
PATH_DIMS, WORD_DIMS, COUNTS = 48, 24, 6
BATCH_CHARS = 8_000_000  # pages are read together up to this many characters of html, longer ones alone
BATCH_BLOCKS = 65_536  # and labelled together up to this many blocks, padding included
DIMS = PATH_DIMS + WORD_DIMS + COUNTS
RESULT = "page_id long, url string, text string, n_chars long"

# Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea iframe svg".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
             "strike strong sub sup time tt u var wbr".split())
MAIN = {"article", "main"}
ASIDE = set("nav header footer aside form head button select".split())
ASIDE_WORDS = set("nav menu footer sidebar ad ads advert advertisement banner cookie notice comment comments share social form login "
                  "newsletter breadcrumb promo related".split())

# Elements that an opening tag ends where their end tag is left out, and those beyond which it ends none.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"},
        "tr": {"td", "th", "tr", "caption", "colgroup"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
        **{t: {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"} for t in ("tbody", "thead", "tfoot")}}
BOUNDS = set("table ul ol menu dl select".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
_CLASS = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z0-9]+")


class Path(NamedTuple):
    """An open element with what the labeller needs of the elements above it."""
    rejected: bool      # it or one above is a menu, form, aside or the like
    inside: bool        # it or one above is an article or main element
    sums: np.ndarray    # hashed tokens of it and all above
    element: tuple      # tag, class words


def _bucket(token: str, dims: int) -> tuple[int, float]:
    h = zlib.crc32(token.encode())
    return h % dims, 1.0 if h >> 31 else -1.0


def _hashed(*said: str) -> np.ndarray:
    v = np.zeros(PATH_DIMS, np.float32)
    for token in said:
        i, sign = _bucket(token, PATH_DIMS)
        v[i] += sign
    return v


ROOT = Path(False, False, np.zeros(PATH_DIMS, np.float32), ("", ()))
_elements: dict = {}


def below(path: Path, *elements: tuple) -> Path:
    """The path with further (tag, class words) elements below it. Classes of html and body describe the page, not a part."""
    for tag, words in elements:
        element = (tag, () if tag in ("html", "body") else words)
        v = _elements.get(element)
        if v is None:
            v = _hashed(tag, *element[1])
            if len(_elements) < 100_000:
                _elements[element] = v
        aside = tag in ASIDE or not ASIDE_WORDS.isdisjoint(element[1])
        path = Path(path.rejected or aside, path.inside or tag in MAIN, path.sums + v, element)
    return path


def blocks(source: str | None) -> list[tuple[Path, str, int]]:
    """Leaf blocks in order: path, text, and characters of it inside links."""
    s, out, stack, parts, linked, links = source or "", [], [ROOT], [], 0, 0
    opened: Counter = Counter()  # open elements by tag

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append((stack[-1], text, linked))
            parts.clear()
            linked = 0

    def said(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            linked += len(text) if links else 0

    def end(tags: set, bounds: set, outermost: bool) -> None:
        """Ends the innermost element of `tags` that is not beyond one of `bounds`, or the outermost such one."""
        if not any(opened[t] for t in tags):
            return
        last = None
        for i in range(len(stack) - 1, 0, -1):
            tag = stack[i].element[0]
            if tag in tags:
                last = i
                if not outermost:
                    break
            elif tag in bounds:
                break
        if last is not None:
            opened.subtract(x.element[0] for x in stack[last:])
            del stack[last:]

    at, n = 0, len(s)
    while at < n:
        m = _TOKEN.search(s, at)
        if m is None:
            said(s[at:])
            break
        said(s[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), m[1] == "/"
        if tag in RAW and not closing:
            if not m[3].endswith("/"):
                closed = re.compile(rf"</{tag}\s*>", re.I).search(s, at)
                at = closed.end() if closed else n
            continue
        if tag in INLINE:
            if tag == "br":
                said(" ")
            elif tag == "a":
                links = max(0, links + (-1 if closing else 1))
            continue
        close()
        links = 0
        if closing:
            end({tag}, set(), False)
        else:
            if stack[-1].element[0] == "p":
                end({"p"}, set(), False)
            if tag in ENDS:
                end(ENDS[tag], BOUNDS, True)
            if tag not in VOID and not m[3].endswith("/"):
                words = tuple(w for x in _CLASS.findall(m[3]) for w in _WORD.findall("".join(x).lower()))
                stack.append(below(stack[-1], (tag, words)))
                opened[tag] += 1
    close()
    return out


def is_main(path: Path) -> bool:
    """The label of a training block."""
    return path.inside and not path.rejected


_leaves: dict = {}
_words: dict = {}


def _word_place(word: str) -> int:
    """A bucket for the word's hash, in the first half for a positive sign."""
    hit = _words.get(word)
    if hit is None:
        i, sign = _bucket(word.lower(), WORD_DIMS)
        hit = i if sign > 0 else i + WORD_DIMS
        if len(_words) < 200_000:
            _words[word] = hit
    return hit


def _leaf(tag: str) -> np.ndarray:
    v = _leaves.get(tag)
    if v is None:
        v = _hashed(f"{tag}|leaf") if tag else ROOT.sums
        if len(_leaves) < 10_000:
            _leaves[tag] = v
    return v


def vectors(page: list) -> np.ndarray:
    """A row per block."""
    x = np.zeros((len(page), DIMS), np.float32)
    for k, (path, text, linked) in enumerate(page):
        x[k, :PATH_DIMS] = path.sums + _leaf(path.element[0])
        words = text.split(" ")
        own = np.bincount([_word_place(w) for w in words], minlength=2 * WORD_DIMS)
        own = own[:WORD_DIMS] - own[WORD_DIMS:]
        x[k, PATH_DIMS:PATH_DIMS + WORD_DIMS] = own / (1 + float(own @ own) ** 0.5)
        n = len(text)
        x[k, -COUNTS:] = (np.log1p(n) / 5, linked / n, (text.count(".") + text.count(",")) / len(words),
                          text[-1] in ".!?", k / len(page), 1 / (1 + len(words)))
    return x


# The labeller -----------------------------------------------------------------------------------

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_model(seed: int = SEED) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    model = {}
    for way in "fb":
        model[f"W{way}"] = r.normal(0, 0.15, (DIMS, 4 * HIDDEN)).astype(np.float32)
        model[f"U{way}"] = r.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        model[f"b{way}"] = np.zeros(4 * HIDDEN, np.float32)
        model[f"b{way}"][HIDDEN:2 * HIDDEN] = 1
    model["V"] = r.normal(0, 0.3, 2 * HIDDEN).astype(np.float32)
    model["c"] = np.zeros(1, np.float32)
    return model


def _run(model: dict, way: str, x: np.ndarray, live: np.ndarray, keep: bool = False):
    """Hidden states of one direction. x: steps, pages, dims; live: which pages have that step."""
    steps, pages, _ = x.shape
    z_all = x @ model[f"W{way}"] + model[f"b{way}"]
    h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
    out, saved = np.zeros((steps, pages, HIDDEN), np.float32), []
    for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
        z = z_all[t] + h @ model[f"U{way}"]
        i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN:])
        on = live[t][:, None]
        c2 = np.where(on, f * c + i * g, c)
        tc = np.tanh(c2)
        h2 = np.where(on, o * tc, h)
        if keep:
            saved.append((t, i, f, o, g, c, tc, h))
        h, c = h2, c2
        out[t] = h
    return out, saved


def _backward(model: dict, way: str, x: np.ndarray, live: np.ndarray, saved: list, d_out: np.ndarray, grads: dict) -> None:
    _, pages, _ = x.shape
    dh, dc = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
    dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
    for t, i, f, o, g, c, tc, h in reversed(saved):
        on = live[t][:, None]
        own = np.where(on, dh + d_out[t], 0)
        d = np.where(on, dc, 0) + own * o * (1 - tc * tc)
        dz = np.concatenate([d * g * i * (1 - i), d * c * f * (1 - f), own * tc * o * (1 - o), d * i * (1 - g * g)], 1)
        dz_all[t] = dz
        grads[f"U{way}"] += h.T @ dz
        dh = np.where(on, dz @ model[f"U{way}"].T, dh + d_out[t])
        dc = np.where(on, d * f, dc)
    grads[f"W{way}"] += x.reshape(-1, x.shape[2]).T @ dz_all.reshape(-1, 4 * HIDDEN)
    grads[f"b{way}"] += dz_all.sum((0, 1))


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max((len(p) for p in pages), default=0)
    x, live = np.zeros((steps, len(pages), DIMS), np.float32), np.zeros((steps, len(pages)), bool)
    for k, p in enumerate(pages):
        x[:len(p), k], live[:len(p), k] = p, True
    return x, live


def label(model: dict, pages: list[np.ndarray]) -> list[np.ndarray]:
    """For each page, whether its blocks are main text. Pages of like length are read together."""
    out: list = [np.zeros(0, bool)] * len(pages)
    order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
    while order:
        steps = len(pages[order[0]])
        take = 1
        while (take < min(len(order), 256) and len(pages[order[take]]) <= steps * 1.3 + 4
               and (take + 1) * len(pages[order[take]]) <= BATCH_BLOCKS):
            take += 1
        own, order = order[:take], order[take:]
        x, live = padded([pages[k] for k in own])
        both = np.concatenate([_run(model, way, x, live)[0] for way in "fb"], 2)
        hit = both @ model["V"] + model["c"] > 0
        for j, k in enumerate(own):
            out[k] = hit[:len(pages[k]), j]
    return out


def train(pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Backpropagation through time with Adam."""
    model, r = new_model(seed), np.random.default_rng(seed)
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = sorted(range(len(pages)), key=lambda k: len(pages[k]) + r.random() * 8)
        chunks = [order[i:i + BATCH] for i in range(0, len(order), BATCH)]
        for own in r.permutation(len(chunks)):
            own = chunks[own]
            x, live = padded([pages[k] for k in own])
            y = np.zeros(live.shape, np.float32)
            for j, k in enumerate(own):
                y[:len(labels[k]), j] = labels[k]
            (hf, sf), (hb, sb) = (_run(model, way, x, live, True) for way in "fb")
            both = np.concatenate([hf, hb], 2)
            d = np.where(live, _sigmoid(both @ model["V"] + model["c"]) - y, 0).astype(np.float32) / live.sum()
            grads = {k: np.zeros_like(v) for k, v in model.items()}
            grads["V"] += np.einsum("tph,tp->h", both, d)
            grads["c"] += d.sum()
            d_both = d[:, :, None] * model["V"]
            _backward(model, "f", x, live, sf, d_both[:, :, :HIDDEN], grads)
            _backward(model, "b", x, live, sb, d_both[:, :, HIDDEN:], grads)
            step += 1
            rate = RATE * (1 - epoch / epochs)
            for k, g in grads.items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                model[k] = model[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)
    return model


def disguised(page: list, r: random.Random) -> tuple[list, list[bool]]:
    """A training page under another template: the same article, other names, more around and inside it."""
    main = [b for b in page if is_main(b[0])]
    rest = [b for b in page if not is_main(b[0])]
    words = " ".join(b[1] for b in page).split() or ["text"]
    some = lambda n: " ".join(r.choice(words) for _ in range(n))
    page_top = below(ROOT, ("html", ()))
    root = below(page_top, ("body", ()))
    if r.random() < 0.5:
        root = below(root, ("div", (r.choice(["page", "wrapper", "container", "site"]),)))
    holder = r.choice([("article", ()), ("main", ()), ("div", ("content",)), ("div", ("post", "content")), ("section", ("entry",)),
                       ("div", ("article", "body")), ("article", ("post",))])
    inside = below(root, ("main", ()), holder) if r.random() < 0.4 else below(root, holder)

    def extra(kind: str, path: Path) -> list:
        if kind == "menu":
            box = r.choice([("nav", ()), ("div", ("menu",)), ("ul", ("nav",)), ("div", ("breadcrumb",))])
            return [(below(path, box, ("ul", ()), ("li", ())), t, len(t)) for t in (some(r.randint(1, 3)) for _ in range(r.randint(2, 8)))]
        box = {"ad": [("div", ("ad",)), ("div", ("advert",)), ("aside", ("promo",)), ("div", ("sponsored",))],
               "notice": [("div", ("cookie", "notice")), ("div", ("banner",)), ("div", ("notice",))],
               "side": [("aside", ()), ("div", ("sidebar",)), ("aside", ("related",))],
               "form": [("form", ()), ("form", ("newsletter",)), ("div", ("login",))],
               "comment": [("div", ("comments",)), ("section", ("comments",)), ("div", ("comment",)), ("ol", ("comment", "list"))],
               "header": [("header", ()), ("div", ("header",))], "footer": [("footer", ()), ("div", ("footer",))]}[kind]
        box, leaf = r.choice(box), r.choice([(), (("p", ()),), (("div", ()),), (("li", ()),), (("h2", ()),), (("h3", ()),)])
        return [(below(path, box, *leaf), t, 0) for t in (some(r.randint(2, 40)) for _ in range(r.randint(1, 4)))]

    out, labels = [], []

    def put(rows: list, good: bool) -> None:
        out.extend(rows)
        labels.extend([good] * len(rows))

    put([(below(page_top, ("head", ()), ("title", ())), main[0][1] if main else some(4), 0)], False)
    for kind in ("notice", "header", "menu", "ad"):
        if r.random() < 0.5:
            put(extra(kind, root), False)
    put([b for b in rest if b[0].element != ("title", ())][:r.randint(0, 8)], False)
    for b in main:
        leaf = b[0].element if b[0].element[0] else ("p", ())
        if r.random() < 0.1:
            leaf = r.choice([("li", ()), ("blockquote", ()), ("div", ()), ("h2", ()), ("td", ()), ("pre", ())])
        put([(below(inside, leaf), b[1], b[2])], True)
        if r.random() < 0.08:
            put(extra(r.choice(["ad", "side", "form"]), inside), False)
    for kind in ("comment", "side", "form", "ad", "menu", "footer"):
        if r.random() < 0.4:
            put(extra(kind, inside if kind == "comment" and r.random() < 0.5 else root), False)
    return out, labels


def fit(sources: list[str], seed: int = SEED) -> dict[str, np.ndarray] | None:
    """The model, or None without training blocks."""
    r, pages, labels = random.Random(seed), [], []
    for s in sources:
        own = blocks(s)
        if own:
            pages.append(vectors(own))
            labels.append(np.array([is_main(b[0]) for b in own]))
            other, said = disguised(own, r)
            pages.append(vectors(other))
            labels.append(np.array(said))
    return train(pages, labels, seed=seed) if pages else None


def training_pages(pages: DataFrame, page_id: str, html: str, n: int = TRAIN_PAGES) -> list[str]:
    """At most n pages' html, of TRAIN_CHARS characters at most each: the least by hash."""
    fitting = pages.select(F.col(page_id).alias("page_id"), F.col(html).alias("html")).filter(
        F.length("html").between(1, TRAIN_CHARS))
    return [r.html for r in bounded_sample(fitting, n, "page_id", "html").collect()]


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", model: dict | None = None,
            joint: str = "\n") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    ship(pages.sparkSession)
    model = model or fit(training_pages(pages, page_id, html))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = pc.fill_null(pc.utf8_length(whole.column(2)), 0).to_pylist()
            at = 0
            while at < whole.num_rows:
                upto, chars = at + 1, sizes[at]
                while upto < min(whole.num_rows, at + 256) and chars + sizes[upto] <= BATCH_CHARS:
                    chars += sizes[upto]
                    upto += 1
                b, at = whole.slice(at, upto - at), upto
                read = [blocks(s) for s in b.column(2).to_pylist()]
                hits = label(model, [vectors(p) for p in read]) if model else [[]] * len(read)
                texts = [joint.join(x[1] for x, hit in zip(p, h) if hit) for p, h in zip(read, hits)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    given = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))
    return given.mapInArrow(run, RESULT)
