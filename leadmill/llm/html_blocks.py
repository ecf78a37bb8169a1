"""Main-text extraction with a recurrent block labeller.

A page is read into its sequence of leaf blocks: stretches of text between block-level tags, each with the path of tags
and class words above it. A bidirectional LSTM in numpy reads the sequence, a vector of the path and one of the hashed
words per block, and decides for every block, seeing the whole page in both directions, whether it is main text.

The network is trained on a bounded sample of pages that mark their article by a tag, together with made-up layouts of
the same texts under other tags and class names, so that it does not hang on one template.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pages that the network is trained on, chosen by hash; as many made-up layouts are added.
SAMPLE = 400
#: Pages of more bytes are not learnt from, so that the sample's size is bounded; they are extracted like all others.
SAMPLE_BYTES = 1 << 18
EPOCHS = 15
HIDDEN = 16
PATH_SIZE, WORD_SIZE, NUMBERS = 256, 64, 6
#: Pages that are labelled at once.
PAGES = 500

# What the tags of HTML mean for reading, and words that name page furniture.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("iframe math noembed noframes noscript object script style svg template title".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
#: An open paragraph ends where one of these begins.
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                   "main menu nav ol p pre section table ul".split())
SCOPES = frozenset("article aside body div fieldset footer form header main nav ol section table td th ul".split())
FURNITURE_TAGS = frozenset("aside button footer form header menu nav select textarea".split())
FURNITURE_WORDS = frozenset("ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent "
                            "footer form header login menu nav navbar navigation newsletter notice popup promo related reply "
                            "respond search share sidebar signup social sponsor sponsored subscribe toolbar widget".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[!?][^>]*>""", re.S)
NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORDS = re.compile(r"[a-z0-9]+")
#: A value without quotes at the end of a tag; a slash there belongs to it and does not close the tag.
BARE_VALUE = re.compile(r"""=\s*[^\s"'][^\s"']*\Z""")

Block = tuple[tuple[str, ...], str, int]


def read_blocks(page: str | None) -> list[Block]:
    """(path, text, linked characters) of each leaf block with text, in page order.

    Character references are decoded, white space becomes one space; scripts, styles and what else is not shown have no
    block. Broken markup is read as far as it goes: unclosed paragraphs and list items end where the next begins."""
    page = page or ""
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    texts: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(texts)).split())
        if text:
            path = tuple(w for tag, names in stack if tag not in INLINE for w in (tag, *names))
            blocks.append((path, text, min(linked, len(text))))
        texts.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        texts.append(text)
        if links:
            linked += len(text)

    at = 0
    while True:
        m = TAG.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if m[1] else links + 1
            elif tag in ("br", "wbr", "img"):
                texts.append(" " if tag == "br" else "")
            continue
        flush()
        links = 0
        if tag in UNSEEN and not m[1] and not (tag in ("svg", "math") and m[3].endswith("/") and not BARE_VALUE.search(m[3])):
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if m[1]:
            for n in range(len(stack) - 1, -1, -1):
                if stack[n][0] == tag:
                    del stack[n:]
                    break
                if stack[n][0] in SCOPES and tag in ("p", "li", "dt", "dd"):
                    break
            continue
        closing = CLOSES.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
        for n in range(len(stack) - 1, -1, -1):
            if stack[n][0] in closing:
                del stack[n:]
                break
            if stack[n][0] in SCOPES:
                break
        if tag not in VOID and not m[3].endswith("/"):
            names = tuple(f".{w}" for got in NAMES.findall(m[3]) for w in WORDS.findall("".join(got).lower()))
            stack.append((tag, names))
    flush()
    return blocks


def silver(path: tuple[str, ...]) -> bool | None:
    """Main text by the page's own tags; None outside any article of a page."""
    tags = [n for n, w in enumerate(path) if w in ("article", "main")]
    if not tags:
        return False
    return not any(w in FURNITURE_TAGS or w[1:] in FURNITURE_WORDS and w[0] == "." for w in path[tags[0]:])


def made_up(texts: list[list[str]], rng: random.Random) -> list[tuple[Block, bool]]:
    """A page of another layout: one page's main texts in some container, furniture of other texts around and inside."""
    words = [w for t in texts for x in t[:3] for w in x.split()[:40]] or ["text"]
    phrase = lambda a, b: " ".join(rng.choice(words) for _ in range(rng.randint(a, b)))
    frame = rng.choice([(), ("div", ".wrapper"), ("div", ".page"), ("div", ".container"), ("table", "tr", "td")])
    body = ("html", "body", *frame)
    box = rng.choice([("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".article", ".body"), ("div", ".post"),
                      ("div", ".entry", ".content"), ("section", ".story"), ("div", ".main"), ("div", ".text"), ("div", "article")])
    main = [((*body, *box, rng.choice(["p"] * 8 + ["h2", "blockquote", "li", "pre", "td"])), t, 0) for t in rng.choice(texts or [["text"]])]
    if rng.random() < 0.7:
        main.insert(0, ((*body, *box, "h1"), phrase(2, 10), 0))

    def menu(path, n, item=("ul", "li")):
        return [((*body, *path, *item), t := phrase(1, 4), len(t)) for _ in range(n)]

    def prose(path, n, long=60):
        return [((*body, *path, *rng.choice([(), ("p",), ("div",), ("div", "p")])), phrase(3, long), 0) for _ in range(n)]

    name = lambda *options: ("div" if rng.random() < 0.7 else rng.choice(["section", "p", "ul"]), "." + rng.choice(options))
    before = [lambda: menu(("nav",), rng.randint(2, 9)), lambda: menu(name("menu", "nav", "navbar", "navigation"), rng.randint(2, 9)),
              lambda: prose(("header",), 2, 12), lambda: prose(name("header", "banner"), 2, 12), lambda: prose(name("ad", "ads", "advert"), 1, 30),
              lambda: prose(name("cookie", "notice", "consent", "popup"), 2, 40), lambda: menu(name("breadcrumb", "breadcrumbs"), 3),
              lambda: prose(("form",), 2, 6)]
    after = [lambda: prose(("footer",), rng.randint(1, 3), 30), lambda: prose(name("footer"), 2, 30), lambda: prose(("aside",), rng.randint(1, 4), 50),
             lambda: prose(name("sidebar", "widget"), rng.randint(1, 4), 50), lambda: menu(name("related", "social", "share"), rng.randint(2, 6)),
             lambda: prose(name("comments", "comment", "respond"), rng.randint(1, 8), 90),
             lambda: prose(("section", ".comments", "div", ".comment"), rng.randint(1, 8), 90),
             lambda: prose(("form",), rng.randint(1, 4), 8), lambda: prose(name("newsletter", "subscribe", "signup"), 2, 25),
             lambda: prose(name("ad", "advert", "sponsor", "promo"), 1, 40)]
    inside = [lambda: prose((*box, *name("ad", "advert", "sponsored", "promo")), 1, 40), lambda: prose((*box, "aside"), 1, 40),
              lambda: menu((*box, *name("share", "social", "related")), rng.randint(1, 5)), lambda: prose((*box, *name("comments", "comment")), 3, 90),
              lambda: prose((*box, "form"), 1, 6), lambda: prose((*box, *name("newsletter", "notice")), 1, 25), lambda: prose((*box, "footer"), 1, 20)]
    page = [(b, True) for b in main]
    for make in rng.sample(inside, rng.choice([0, 0, 1, 2, 3])):
        spot = rng.randint(0, len(page))
        page[spot:spot] = [(b, False) for b in make()]
    head = [(b, False) for make in rng.sample(before, rng.randint(0, 4)) for b in make()]
    tail = [(b, False) for make in rng.sample(after, rng.randint(0, 5)) for b in make()]
    return head + page + tail


def path_vector(path: tuple[str, ...]) -> np.ndarray:
    out = np.zeros(PATH_SIZE, np.float32)
    for word in path:
        out[zlib.crc32(word.encode()) % PATH_SIZE] = 1
    out[zlib.crc32(b"leaf " + (path[-1] if path else "").encode()) % PATH_SIZE] = 1
    return out


def text_vectors(pages: list[list[Block]]) -> np.ndarray:
    """For all blocks of the pages: shares of hashed words, then length, links, marks, depth and place in the page."""
    hashes, sizes, rest = [], [], []
    for blocks in pages:
        for n, (path, text, linked) in enumerate(blocks):
            words = text.lower().encode().split()
            hashes.extend(map(zlib.crc32, words))
            sizes.append(len(words))
            rest.append((len(text), linked / len(text), sum(map(text.count, ".,!?:;")) / len(words), len(path) / 10, n / len(blocks)))
    size = np.array(sizes, np.int64)
    spots = np.repeat(np.arange(len(size)) * WORD_SIZE, size) + np.fromiter(hashes, np.int64, len(hashes)) % WORD_SIZE
    words = np.bincount(spots, minlength=len(size) * WORD_SIZE).reshape(-1, WORD_SIZE) / size[:, None]
    numbers = np.array(rest).reshape(-1, 5)
    return np.concatenate([words, np.log1p(numbers[:, :1]) / 8, np.log1p(size)[:, None] / 6, numbers[:, 1:]], 1).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Two LSTM directions over (path vector, text vector) and a logistic output."""

    def __init__(self, seed: int = 7, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        size = PATH_SIZE + WORD_SIZE + NUMBERS
        self.hidden = hidden
        self.w = {f"x{d}": rng.normal(0, 0.1, (size, 4 * hidden)).astype(np.float32) for d in "fb"}
        self.w |= {f"h{d}": rng.normal(0, 0.1, (hidden, 4 * hidden)).astype(np.float32) for d in "fb"}
        self.w |= {f"b{d}": np.repeat(np.array([0, 1, 0, 0], np.float32), hidden) for d in "fb"}
        self.w |= {"o": rng.normal(0, 0.1, 2 * hidden).astype(np.float32), "c": np.zeros(1, np.float32)}

    def run(self, inputs: np.ndarray, d: str):
        """Hidden states (steps, pages, hidden) for projected ``inputs`` (steps, pages, 4 hidden), and what led to them."""
        steps, pages, _ = inputs.shape
        h = c = np.zeros((pages, self.hidden), np.float32)
        out, cache, n = np.empty((steps, pages, self.hidden), np.float32), [], self.hidden
        for t in range(steps):
            z = inputs[t] + h @ self.w[f"h{d}"]
            s, g = sigmoid(z[:, :3 * n]), np.tanh(z[:, 3 * n:])
            i, f, o = s[:, :n], s[:, n:2 * n], s[:, 2 * n:]
            before, c = c, f * c + i * g
            tc = np.tanh(c)
            cache.append((i, f, o, g, before, tc, h))
            h = o * tc
            out[t] = h
        return out, cache

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = 0.01, batch: int = 32, seed: int = 7) -> None:
        """``pages``: (vectors, labels). Adam on the mean log loss of the blocks."""
        rng, order = np.random.default_rng(seed), sorted(range(len(pages)), key=lambda n: len(pages[n][1]))
        batches = [order[a:a + batch] for a in range(0, len(order), batch)]
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v, step = {k: np.zeros_like(x) for k, x in self.w.items()}, 0
        for _ in range(epochs):
            for n in rng.permutation(len(batches)):
                grads, step = self.gradient([pages[k] for k in batches[n]]), step + 1
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                for k, g in grads.items():
                    g = g / max(1.0, norm)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.w[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)

    def gradient(self, pages: list[tuple[np.ndarray, np.ndarray]]) -> dict[str, np.ndarray]:
        sizes = np.array([len(y) for _, y in pages])
        steps, n = sizes.max(), self.hidden
        x = np.zeros((steps, len(pages), pages[0][0].shape[1]), np.float32)
        y, mask = np.zeros((steps, len(pages)), np.float32), np.arange(steps)[:, None] < sizes
        for k, (vectors, labels) in enumerate(pages):
            x[:len(labels), k], y[:len(labels), k] = vectors, labels
        turn = turned(sizes, steps)
        xs = {"f": x, "b": np.take_along_axis(x, turn[:, :, None], 0)}
        ran = {d: self.run(xs[d] @ self.w[f"x{d}"] + self.w[f"b{d}"], d) for d in "fb"}
        states = np.concatenate([ran["f"][0], np.take_along_axis(ran["b"][0], turn[:, :, None], 0)], 2)
        error = (sigmoid(states @ self.w["o"] + self.w["c"]) - y) * mask / mask.sum()
        grads = {"o": (error[:, :, None] * states).sum((0, 1)), "c": error.sum(keepdims=True).reshape(1)}
        for k, d in enumerate("fb"):
            up = error[:, :, None] * self.w["o"][k * n:(k + 1) * n]
            if d == "b":
                up = np.take_along_axis(up, turn[:, :, None], 0)
            dz, dh, dc = np.empty((steps, len(pages), 4 * n), np.float32), 0, 0
            gh = np.zeros_like(self.w[f"h{d}"])
            for t in range(steps - 1, -1, -1):
                i, f, o, g, before, tc, h = ran[d][1][t]
                dh = up[t] + dh
                dc = dc + dh * o * (1 - tc * tc)
                dz[t] = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
                gh += h.T @ dz[t]
                dh, dc = dz[t] @ self.w[f"h{d}"].T, dc * f
            grads |= {f"h{d}": gh, f"b{d}": dz.sum((0, 1)), f"x{d}": xs[d].reshape(-1, x.shape[2]).T @ dz.reshape(-1, 4 * n)}
        return grads

    def project(self, pages: list[list[Block]]) -> np.ndarray:
        """Both directions' inputs of all blocks; the part of a path is computed once."""
        w = np.concatenate([self.w["xf"], self.w["xb"]], 1)
        own = {path for blocks in pages for path, _, _ in blocks}
        place = {path: n for n, path in enumerate(own)}
        paths = np.array([path_vector(path) for path in place], np.float32).reshape(-1, PATH_SIZE) @ w[:PATH_SIZE]
        out = text_vectors(pages) @ w[PATH_SIZE:] + np.concatenate([self.w["bf"], self.w["bb"]])
        return out + paths[np.array([place[path] for blocks in pages for path, _, _ in blocks], np.int64)]

    def states(self, inputs: np.ndarray, starts: np.ndarray, sizes: np.ndarray, d: str) -> np.ndarray:
        """Hidden states of all blocks of pages sorted by falling size; a step runs over the pages that still have one."""
        n = self.hidden
        h = c = np.zeros((len(sizes), n), np.float32)
        out = np.empty((len(inputs), n), np.float32)
        for t in range(int(sizes[0])):
            alive = int(np.searchsorted(-sizes, -t))
            rows = starts[:alive] + (t if d == "f" else sizes[:alive] - 1 - t)
            z = inputs[rows] + h[:alive] @ self.w[f"h{d}"]
            s, g = sigmoid(z[:, :3 * n]), np.tanh(z[:, 3 * n:])
            c = s[:, n:2 * n] * c[:alive] + s[:, :n] * g
            h = s[:, 2 * n:] * np.tanh(c)
            out[rows] = h
        return out

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each page, which of its blocks are main text."""
        found: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((n for n in range(len(pages)) if pages[n]), key=lambda n: -len(pages[n]))
        if order:
            sizes = np.array([len(pages[n]) for n in order])
            starts, h4 = np.concatenate(([0], np.cumsum(sizes)[:-1])), 4 * self.hidden
            x = self.project([pages[n] for n in order])
            score = (self.states(x[:, :h4], starts, sizes, "f") @ self.w["o"][:self.hidden]
                     + self.states(x[:, h4:], starts, sizes, "b") @ self.w["o"][self.hidden:] + self.w["c"])
            for n, a, size in zip(order, starts, sizes):
                found[n] = score[a:a + size] > 0
        return found


def turned(sizes: np.ndarray, steps: int) -> np.ndarray:
    """Indexes that turn each page's steps around and leave the padding behind in place."""
    t = np.arange(steps)[:, None]
    return np.where(t < sizes, sizes - 1 - t, t)


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE, epochs: int = EPOCHS, seed: int = 7) -> Labeller:
    """A labeller from at most ``sample`` pages, those with the smallest hashes among pages of at most SAMPLE_BYTES, and as
    many made-up ones."""
    spot = F.xxhash64(F.lit(seed), F.col(id_col), F.length(html_col))
    got = pages.where(F.octet_length(html_col) <= SAMPLE_BYTES).select(spot.alias("spot"), F.col(html_col).alias("html")).orderBy("spot").limit(sample)
    real = [blocks for row in got.toArrow().column("html").to_pylist() if (blocks := read_blocks(row))]
    marked = [[(b, silver(b[0])) for b in blocks] for blocks in real]
    marked = [page for page in marked if any(good for _, good in page)]
    rng = random.Random(seed)
    texts = [[b[1] for b, good in page if good][:30] for page in marked]
    data = marked + [made_up(texts, rng) for _ in range(sample)]
    vectors = []
    for page in data:
        blocks = [b for b, _ in page]
        paths = np.array([path_vector(b[0]) for b in blocks], np.float32)
        vectors.append((np.concatenate([paths, text_vectors([blocks])], 1), np.array([good for _, good in page], np.float32)))
    labeller = Labeller(seed)
    labeller.train(vectors, epochs, seed=seed)
    return labeller


def main_text(blocks: list[Block], main: np.ndarray) -> str:
    return "\n".join(b[1] for b, good in zip(blocks, main) if good)


def extract(pages: DataFrame, labeller: Labeller, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``pages`` (default: all but the html) with ``text``, the main text or an empty string.

    Null and empty pages, and pages whose blocks are all furniture, have an empty text; repeated rows are extracted each;
    an empty table gives no rows; a kept column called ``text`` is replaced; pages of any length are read whole."""
    names = [c for c in (pages.columns if keep is None else keep) if c not in (html_col, "text")]
    schema = T.StructType([pages.schema[c] for c in names] + [T.StructField("text", T.StringType())])
    shared = pages.sparkSession.sparkContext.broadcast(labeller)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES):
                part = batch.slice(at, PAGES)
                read = [read_blocks(p) for p in part.column(len(names)).to_pylist()]
                texts = [main_text(b, m) for b, m in zip(read, shared.value.label(read))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    return pages.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{html_col}`").cast("string").alias("read_html")).mapInArrow(run, schema)
