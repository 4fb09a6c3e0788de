"""HTML main text by a recurrent block labeller.

1. Blocks. A page is read tag by tag into its leaf sequence: the text between two
   block-level borders is a block, with the path of open elements (and their class,
   id and role words). ``script``, ``style``, ``head`` and the like give no text.
2. Vectors. A block's input is two hashed vectors: its tag path (with depth from the
   leaf, and the words of classes and ids) and its words, plus its size and link
   share.
3. Labeller. A bidirectional LSTM in numpy reads a page's whole sequence of blocks
   and gives each the probability of being main text, so that every block is judged
   in the context of the document. Pages of like length run side by side.
4. Training. No page is labelled by hand. The labels come from what the pages
   themselves say by standard HTML roles (article and main against nav, header,
   footer, aside, form, and the usual class words). The training pages are a bounded
   sample of ``SAMPLE`` pages by hash, once as they are and ``VARIANTS`` times
   rebuilt: containers renamed, boilerplate blocks of all kinds put in around and
   inside the article. A few hundred steps of Adam run on the driver; the pages
   that are collected for it are bounded in number and in bytes.

Scale: one pass over the pages, no shuffle; the weights (some 100 kB) go with the
task. Whole pages are read; nothing is cut.

Defined cases: NULL, empty or text-free html gives the empty text; broken markup is
read as far as it goes (an unclosed element ends with its parent); ties and repeated
rows get equal results; a NULL id or url is carried; further columns are ignored;
without any page to learn from the labeller falls back to the roles.
"""

from __future__ import annotations

import html
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termsim.llm.storage import smallest, table

SAMPLE = 256
SAMPLE_CHARS = 20_000
VARIANTS = 3
PATH_SIZE, WORD_SIZE, HIDDEN = 96, 32, 24
STEPS, RATE, BATCH = 220, 0.02, 24

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rb rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
SILENT = frozenset("head script style noscript template svg math iframe object canvas audio video select textarea title".split())
#: Elements without shown text that do not end the block they stand in.
UNSEEN = frozenset("script style noscript template svg math iframe object canvas audio video".split())
RAW = frozenset("script style textarea title noscript iframe".split())
# Words by which pages name the parts that are not main text.
ASIDE_TAGS = frozenset("nav header footer aside form menu dialog button fieldset".split())
ASIDE_WORDS = re.compile(
    r"(^|[^a-z])(ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|header|menu|modal|nav\w*|newsletter|"
    r"notice|popup|promo\w*|related|replies|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget)([^a-z]|$)"
)
MAIN_TAGS = frozenset(("article", "main"))

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_SPACE = re.compile(r"\s+")


class Block:
    """One leaf: its text, the open elements (name, words) and the linked part."""

    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple, linked: int):
        self.text, self.path, self.linked = text, path, linked


def _implied_end(stack: list, name: str) -> None:
    """Elements that a start tag closes: a paragraph by any block, items by their
    like. Open inline elements inside them end too."""
    for k in range(len(stack) - 1, -1, -1):
        at = stack[k][0]
        if at == "p" and name not in INLINE or at == name and name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            del stack[k:]
            return
        if at not in INLINE:
            return


def blocks(page: str) -> list[Block]:
    """The leaf sequence of a page."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked = 0
    silent = 0

    def close():
        nonlocal parts, linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                out.append(Block(text, tuple(x for x in stack if x[0] not in INLINE), linked))
            parts, linked = [], 0

    def put(raw: str):
        nonlocal linked
        if raw and not silent:
            text = html.unescape(raw)
            parts.append(text)
            if any(x[0] == "a" for x in stack):
                linked += len(text.strip())

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            put(page[at:])
            break
        put(page[at : m.start()])
        at = m.end()
        name = (m.group(1) or "").lower()
        if not name:
            continue
        if page[m.start() + 1] == "/":
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if name not in INLINE and name not in UNSEEN and not silent:
                        close()
                    silent -= sum(x[0] in SILENT or "\x00" in x[1] for x in stack[k:])
                    del stack[k:]
                    break
            continue
        if name not in INLINE and name not in UNSEEN and not silent:
            close()
            before = len(stack)
            _implied_end(stack, name)
            if len(stack) < before:
                silent = sum(x[0] in SILENT or "\x00" in x[1] for x in stack)
        elif name == "br":
            put(" ")
        if name in VOID:
            continue
        words = []
        for a in _ATTRIBUTE.finditer(m.group(2) or ""):
            key = a.group(1).lower()
            value = (a.group(2) or a.group(3) or a.group(4) or "").lower()
            if key == "hidden" or key == "aria-hidden" and value == "true":
                words.append("\x00")  # not shown
            elif key != "hidden" and key != "aria-hidden":
                words.append(value)
        stack.append((name, " ".join(words)))
        if name in SILENT or "\x00" in stack[-1][1]:
            silent += 1
        if name in RAW:  # its content is no markup
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            put(page[at : end.start()] if end else page[at:])
            at = end.end() if end else size
            if name not in UNSEEN:
                close()
            silent -= 1 if name in SILENT or "\x00" in stack[-1][1] else 0
            stack.pop()
    close()
    return out


def role_label(block: Block) -> int:
    """What the page itself says: 1 in an article or main element and in no part
    that is named as something else."""
    main = False
    for name, words in block.path:
        if name in MAIN_TAGS:
            main = True
        elif name in ASIDE_TAGS or words and ASIDE_WORDS.search(words):
            return 0
    return int(main)


# --------------------------------------------------------------------------
# vectors
# --------------------------------------------------------------------------

_hashes: dict[str, tuple[int, float]] = {}


def _place(key: str, size: int) -> tuple[int, float]:
    found = _hashes.get(key)
    if found is None:
        h = zlib.crc32(key.encode())
        if len(_hashes) > 300_000:
            _hashes.clear()
        found = _hashes[key] = (h >> 1, 1.0 if h & 1 else -1.0)
    return found[0] % size, found[1]


_paths: dict[tuple, np.ndarray] = {}


def _path_vector(path: tuple) -> np.ndarray:
    v = _paths.get(path)
    if v is None:
        v = np.zeros(PATH_SIZE, np.float32)
        for depth, (name, words) in enumerate(reversed(path)):
            keys = ["t:" + name, *(["leaf:" + name] if depth == 0 else [])]
            keys += ["w:" + w for w in re.split(r"[^a-z0-9]+", words) if w]
            for key in keys:
                k, sign = _place(key, PATH_SIZE)
                v[k] = sign
        if len(_paths) > 50_000:
            _paths.clear()
        _paths[path] = v
    return v


INPUT = PATH_SIZE + WORD_SIZE + 4


def vectors(page: list[Block]) -> np.ndarray:
    """One input vector per block."""
    x = np.zeros((len(page), INPUT), np.float32)
    for k, b in enumerate(page):
        x[k, :PATH_SIZE] = _path_vector(b.path)
        words = b.text.lower().split()
        w = x[k, PATH_SIZE : PATH_SIZE + WORD_SIZE]
        for word in words:
            i, sign = _place(word, WORD_SIZE)
            w[i] += sign
        w /= len(words)
        x[k, -4:] = np.log1p(len(words)) / 5, b.linked / max(1, len(b.text)), len(b.path) / 10, 1.0
    return x


# --------------------------------------------------------------------------
# the network
# --------------------------------------------------------------------------


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def new_weights(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = {}
    for side in "fb":
        w["x" + side] = rng.normal(0, 1 / np.sqrt(INPUT / 8), (INPUT, 4 * HIDDEN)).astype(np.float32)
        w["h" + side] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        w["c" + side] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32)
    w["o"] = rng.normal(0, 0.3, (2 * HIDDEN, 1)).astype(np.float32)
    w["q"] = np.zeros(1, np.float32)
    return w


def _lstm(x: np.ndarray, mask: np.ndarray, wx, wh, c):
    """Hidden states ``(page, step, HIDDEN)`` and what the way back needs. Steps beyond a
    page's end (mask 0) keep the state."""
    n, steps, _ = x.shape
    given = x @ wx + c
    h, s = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    out, kept = np.empty((n, steps, HIDDEN), np.float32), []
    for t in range(steps):
        g = given[:, t] + h @ wh
        i, f, o = (_sigmoid(g[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        u = np.tanh(g[:, 3 * HIDDEN :])
        m = mask[:, t : t + 1]
        s_new = f * s + i * u
        tanh = np.tanh(s_new)
        kept.append((h, s, i, f, o, u, tanh, m))
        s = np.where(m > 0, s_new, s)
        h = np.where(m > 0, o * tanh, h)
        out[:, t] = h
    return out, kept


def _lstm_back(d_out: np.ndarray, x: np.ndarray, kept, wx, wh):
    n, steps, _ = x.shape
    dh, ds = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    dg_all = np.empty((n, steps, 4 * HIDDEN), np.float32)
    d_wh = np.zeros_like(wh)
    for t in reversed(range(steps)):
        h, s, i, f, o, u, tanh, m = kept[t]
        dh = dh + d_out[:, t]
        a = dh * m
        d_s = ds * m + a * o * (1 - tanh * tanh)
        dg = np.concatenate([d_s * u * i * (1 - i), d_s * s * f * (1 - f), a * tanh * o * (1 - o), d_s * i * (1 - u * u)], axis=1)
        dg_all[:, t] = dg
        d_wh += h.T @ dg
        dh = dh * (1 - m) + dg @ wh.T
        ds = ds * (1 - m) + d_s * f
    flat = dg_all.reshape(-1, 4 * HIDDEN)
    return x.reshape(-1, x.shape[2]).T @ flat, d_wh, flat.sum(0)


def _padded(pages: list[np.ndarray]):
    steps = max(len(p) for p in pages)
    x = np.zeros((len(pages), steps, INPUT), np.float32)
    mask = np.zeros((len(pages), steps), np.float32)
    for k, p in enumerate(pages):
        x[k, : len(p)] = p
        mask[k, : len(p)] = 1
    return x, mask


def _forward(w: dict, x: np.ndarray, mask: np.ndarray):
    f, kept_f = _lstm(x, mask, w["xf"], w["hf"], w["cf"])
    # from behind: padding comes first then, and keeps the empty state
    b, kept_b = _lstm(x[:, ::-1], mask[:, ::-1], w["xb"], w["hb"], w["cb"])
    both = np.concatenate([f, b[:, ::-1]], axis=2)
    return _sigmoid(both @ w["o"] + w["q"])[:, :, 0], both, kept_f, kept_b


def train(pages: list[np.ndarray], labels: list[np.ndarray], steps: int = STEPS, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights fitted by Adam on the mean cross entropy of the blocks."""
    w, rng = new_weights(seed), np.random.default_rng(seed)
    m1 = {k: np.zeros_like(v) for k, v in w.items()}
    m2 = {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, steps + 1):
        some = rng.choice(len(pages), min(BATCH, len(pages)), replace=False)
        x, mask = _padded([pages[k] for k in some])
        y = np.zeros(mask.shape, np.float32)
        for r, k in enumerate(some):
            y[r, : len(labels[k])] = labels[k]
        p, both, kept_f, kept_b = _forward(w, x, mask)
        dz = ((p - y) * mask / mask.sum())[:, :, None]
        grad = {"o": both.reshape(-1, 2 * HIDDEN).T @ dz.reshape(-1, 1), "q": dz.sum((0, 1))}
        d = dz @ w["o"].T
        grad["xf"], grad["hf"], grad["cf"] = _lstm_back(d[:, :, :HIDDEN], x, kept_f, w["xf"], w["hf"])
        grad["xb"], grad["hb"], grad["cb"] = _lstm_back(d[:, ::-1, HIDDEN:], x[:, ::-1], kept_b, w["xb"], w["hb"])
        size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        rate = RATE * (1 if step < steps * 0.7 else 0.2)
        for k, g in grad.items():
            g = g * min(1.0, 1.0 / (size + 1e-9))
            m1[k] = 0.9 * m1[k] + 0.1 * g
            m2[k] = 0.99 * m2[k] + 0.01 * g * g
            w[k] -= (rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return w


def label_pages(w: dict | None, pages: list[list[Block]]) -> list[np.ndarray]:
    """Probability of main text for every block of every page."""
    if w is None:
        return [np.array([float(role_label(b)) for b in p]) for p in pages]
    out: list[np.ndarray] = [np.zeros(0)] * len(pages)
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    at = 0
    while at < len(order):
        # pages side by side: like lengths, a bounded number of blocks
        end = at + 1
        while end < len(order) and (end - at + 1) * len(pages[order[end]]) <= 8192:
            end += 1
        group = order[at:end]
        x, mask = _padded([vectors(pages[k]) for k in group])
        p = _forward(w, x, mask)[0]
        for r, k in enumerate(group):
            out[k] = p[r, : len(pages[k])]
        at = end
    return out


# --------------------------------------------------------------------------
# training pages
# --------------------------------------------------------------------------

_ASIDES = [
    ("nav", ""), ("header", ""), ("footer", ""), ("aside", ""), ("form", ""), ("div", "ad"), ("div", "ads"), ("div", "advert"),
    ("div", "banner"), ("div", "sidebar"), ("div", "menu"), ("div", "nav"), ("div", "header"), ("div", "footer"),
    ("div", "cookie notice"), ("div", "cookie-banner"), ("div", "notice"), ("div", "newsletter"), ("div", "popup"),
    ("section", "comments"), ("div", "comments"), ("div", "comment"), ("div", "related"), ("div", "share"), ("ul", "menu"),
    ("div", "promo"), ("div", "sponsored"), ("div", "widget"), ("div", "breadcrumb"), ("section", "related"),
]
_MAINS = [("article", ""), ("main", ""), ("div", "content"), ("div", "article"), ("div", "post"), ("div", "entry-content"), ("section", "article-body"), ("div", "main")]
_LEAVES = [("p", ""), ("p", ""), ("p", ""), ("li", ""), ("h2", ""), ("h3", ""), ("blockquote", ""), ("td", ""), ("pre", ""), ("div", "")]


def variant(page: list[Block], rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    """A rebuilt page: its main blocks in a container of some name, boilerplate blocks
    of some kinds before, after and within."""
    texts = [b.text for b in page]
    main = [b for b in page if role_label(b)] or page
    root = (("html", ""), ("body", ""))
    if rng.random() < 0.4:
        root = (*root, ("div", str(rng.choice(["", "wrapper", "page", "container", "site"]))))
    holder = _MAINS[rng.integers(len(_MAINS))]
    inner = (("div", str(rng.choice(["", "body", "text"]))),) if rng.random() < 0.25 else ()

    def other(prefix: tuple) -> tuple[list[Block], list[int]]:
        kind = _ASIDES[rng.integers(len(_ASIDES))]
        made = []
        for _ in range(int(rng.integers(1, 6))):
            text = texts[rng.integers(len(texts))]
            if rng.random() < 0.6:
                text = " ".join(text.split()[: int(rng.integers(1, 12))])
            leaf = ("ul", ""), ("li", "")
            path = (*prefix, kind, *(leaf if rng.random() < 0.5 else (("p", ""),) if rng.random() < 0.6 else ()))
            linked = len(text) if kind[0] in ("nav", "ul") or rng.random() < 0.3 else 0
            made.append(Block(text, path, linked))
        return made, [0] * len(made)

    out, labels = [], []

    def add(found):
        out.extend(found[0])
        labels.extend(found[1])

    for _ in range(int(rng.integers(1, 4))):
        add(other(root))
    inside = (*root, holder, *inner)
    add(([Block(main[0].text, (*inside, ("h1", "")), 0)], [1]))
    for b in main[1:]:
        leaf = ("p", "") if rng.random() < 0.8 else _LEAVES[rng.integers(len(_LEAVES))]
        add(([Block(b.text, (*inside, leaf), 0)], [1]))
        if rng.random() < 0.06:
            add(other(inside))
    for _ in range(int(rng.integers(1, 4))):
        add(other(root))
    return out, labels


def training_pages(sample: list[str], variants: int = VARIANTS, seed: int = 11):
    """``(vectors, labels)`` of the sampled pages and their variants."""
    rng = np.random.default_rng(seed)
    x, y = [], []
    for text in sample:
        page = blocks(text)
        if not page:
            continue
        page = page[:400]
        x.append(vectors(page))
        y.append(np.array([role_label(b) for b in page], np.float32))
        for _ in range(variants):
            made, labels = variant(page[:60], rng)
            x.append(vectors(made))
            y.append(np.array(labels, np.float32))
    return x, y


def fit(pages: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray] | None:
    """The labeller, learnt from a bounded sample of pages of up to ``SAMPLE_CHARS``."""
    size = F.char_length("html")
    rows = pages.where((size > 0) & (size <= SAMPLE_CHARS)).select("html")
    chosen = [r["html"] for r in smallest(rows, F.xxhash64("html"), sample, "html").collect()]
    x, y = training_pages(chosen)
    return train(x, y) if x else None


def extract(pages: DataFrame, weights: dict | None) -> DataFrame:
    """``(page_id, url, text, n_blocks, n_main)``: the main text of every page."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [blocks(t) if t else [] for t in part.column(2).to_pylist()]
                texts, main = [], []
                for page, p in zip(found, label_pages(weights, found), strict=True):
                    kept = [b.text for b, q in zip(page, p, strict=True) if q >= 0.5]
                    texts.append("\n".join(kept))
                    main.append(len(kept))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:2], pa.array(texts, pa.string()), pa.array([len(p) for p in found], pa.int64()), pa.array(main, pa.int64())],
                    names=["page_id", "url", "text", "n_blocks", "n_main"],
                )

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_blocks long, n_main long"
    )


def op8_html_extract(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = extract(pages, fit(pages))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
