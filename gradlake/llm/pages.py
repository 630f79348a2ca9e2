"""Main text of web pages by a recurrent block labeller.

A page is cut into leaves: runs of text between the borders of block elements. Each leaf is a vector: its path of tags, classes and ids,
its words, both hashed, and a few figures. A bidirectional LSTM reads the leaves of a page in order and back and labels every one, so
a label depends on the whole page. The text is that of the leaves labelled content.

The model is trained on a bounded sample of pages (``SAMPLE_PAGES``) twice over: as they are, labelled where their markup says plainly
what is content, and with the same texts dressed in page frames of many kinds, where the labels are known.
"""

from __future__ import annotations

import html as entities
import random
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradlake.llm.common import pick, table

BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html iframe legend li main menu nav ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup, up to their own end tag, and no text of the page.
RAW = frozenset("script style iframe textarea".split())
#: Elements with markup inside, of which nothing is text of the page.
SILENT = frozenset("noscript template svg select".split())
#: Block elements that may stand inside; another one shows that the end tag is missing.
INSIDE = {"svg": frozenset(("title",)), "math": frozenset(), "select": frozenset("button div hr legend optgroup option".split())}
#: What may stand in a head; another start tag ends it.
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript object script style template title".split())
#: What a start tag closes if it is open, unless one of the named elements lies between.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "option": ({"option"}, {"select"})}
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+\"[^\"]*\"|=\s*+'[^']*'|=)*+)>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in RAW}
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
MARK = re.compile(r"""\bdata-mark=(\w+)""")
SPACE = re.compile(r"\s+")

PATH, WORDS, FIGURES = 64, 32, 6
INPUT = PATH + WORDS + FIGURES
HIDDEN = 16
SAMPLE_PAGES, FRAMES, TRAIN_LEAVES = 200, 600, 64
EPOCHS, BATCH, RATE = 6, 16, 0.01


class Leaf:
    """A run of text with the names on its path, how much of it is linked, and marks of the training frames."""

    __slots__ = ("linked", "marks", "names", "text")

    def __init__(self, text: str, names: list[str], linked: float, marks: list[str]):
        self.text, self.names, self.linked, self.marks = text, names, linked, marks


def leaves(page: str) -> list[Leaf]:
    """The leaves of a page in order, with character references decoded and white space runs turned into one space."""
    found: list[Leaf] = []
    stack: list[tuple[str, list[str], str]] = []
    pieces: list[str] = []
    linked = 0
    links = 0
    silent = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = SPACE.sub(" ", "".join(pieces)).strip(" ")
            # what the head holds is no text of the page; classes and ids are for the labeller to judge
            if text and not any(tag in ("head", "title") for tag, *_ in stack):
                names = [n for tag, more, _ in stack for n in (tag, *more)]
                found.append(Leaf(text, names, min(1.0, linked / len(text)), [m for *_, m in stack if m]))
            pieces.clear()
            linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw and not silent:
            text = entities.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if links:
                linked += len(text.strip())

    def close(k: int) -> None:
        nonlocal links, silent
        for tag, *_ in stack[k:]:
            links -= tag == "a"
            silent -= tag in SILENT
        del stack[k:]

    def speak() -> None:
        """Close what is silent, so the text before it keeps its own path."""
        if silent:
            close(next(i for i, (t, *_) in enumerate(stack) if t in SILENT))

    at = 0
    while at < len(page):
        m = MARKUP.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, rest = tag.lower(), m[3] if m[2] else m[6]
        if m[1] or m[4]:
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if silent:
                if k is None or any(t in SILENT for t, *_ in stack[:k]):
                    if k is not None:
                        close(k)
                    continue
                own = tag in SILENT
                speak()
                if own:
                    if tag in BLOCKS:
                        flush()
                    continue
            if tag in BLOCKS:
                flush()
            if k is not None:
                close(k)
            continue
        if tag in BLOCKS:
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in INSIDE or stack[i][0] == "foreignobject"), None)
            if k is not None and tag not in INSIDE.get(stack[k][0], BLOCKS):
                close(k)
        if silent:
            if tag in RAW:
                end = END[tag].search(page, at)
                at = end.end() if end else len(page)
            elif tag not in VOID and not rest.endswith("/"):
                stack.append((tag, [], ""))
                silent += tag in SILENT
            continue
        if tag not in IN_HEAD:
            k = next((i for i, (t, *_) in enumerate(stack) if t == "head"), None)
            if k is not None:
                flush()
                close(k)
        if tag in BLOCKS:
            flush()
            if stack and stack[-1][0] not in BLOCKS or any(t == "p" for t, *_ in stack):
                k = next((i for i, (t, *_) in enumerate(stack) if t == "p"), None)
                if k is not None and not any(t in BLOCKS for t, *_ in stack[k + 1 :]):
                    close(k)
            ends, stops = CLOSES.get(tag, ((), ()))
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in stops:
                    break
                if stack[k][0] in ends:
                    close(k)
        elif tag == "br":
            pieces.append(" ")
        if tag in RAW:
            end = END[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID or rest.endswith("/"):
            continue
        names = [w for groups in NAMES.findall(rest) for w in re.findall(r"[a-z]+", "".join(groups).lower())] if rest else []
        mark = MARK.search(rest) if rest else None
        stack.append((tag, names, mark[1] if mark else ""))
        links += tag == "a"
        silent += tag in SILENT
    speak()
    flush()
    return found


_hashes: dict[tuple[str, int], int] = {}


def bucket(word: str, size: int) -> int:
    value = _hashes.get((word, size))
    if value is None:
        if len(_hashes) >= 1 << 17:
            _hashes.clear()
        value = _hashes[word, size] = xxhash.xxh32_intdigest(word) % size
    return value


def vectors(page: list[Leaf]) -> np.ndarray:
    """One row per leaf."""
    out = np.zeros((len(page), INPUT), np.float32)
    for i, leaf in enumerate(page):
        row, words = out[i], leaf.text.split(" ")
        for name in leaf.names:
            row[bucket(name, PATH)] = 1
        if leaf.names:
            row[bucket("last " + leaf.names[-1], PATH)] = 1
        row[PATH : PATH + WORDS] = np.bincount([bucket(word, WORDS) for word in words], minlength=WORDS) / len(words)
        row[-FIGURES:] = (np.log1p(len(words)) / 5, leaf.linked, leaf.text[-1] in ".!?", leaf.text.count(",") / len(words), i / len(page), min(len(leaf.names), 20) / 20)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def lstm(x: np.ndarray, real: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list]:
    """States of all steps of a batch (pages, steps, inputs); past the end of a page the state is zero."""
    n, steps, _ = x.shape
    size = len(u)
    h, c = np.zeros((n, size)), np.zeros((n, size))
    given = x @ w + b
    states, kept = np.zeros((n, steps, size)), []
    for t in range(steps):
        z = given[:, t] + h @ u
        gates, new = sigmoid(z[:, : 3 * size]), np.tanh(z[:, 3 * size :])
        i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
        m = real[:, t, None]
        before, c = c, m * (f * c + i * new)
        tanh = np.tanh(c)
        kept.append((h, before, i, f, o, new, tanh, m))
        h = m * o * tanh
        states[:, t] = h
    return states, kept


def lstm_back(x: np.ndarray, d_states: np.ndarray, kept: list, w: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of the weights of :func:`lstm`."""
    n, steps, _ = x.shape
    size = len(u)
    d_w, d_u, d_b = np.zeros_like(w), np.zeros_like(u), np.zeros(4 * size)
    d_h, d_c = np.zeros((n, size)), np.zeros((n, size))
    for t in range(steps - 1, -1, -1):
        h, before, i, f, o, new, tanh, m = kept[t]
        d = (d_states[:, t] + d_h) * m
        d_c = (d_c + d * o * (1 - tanh**2)) * m
        d_z = np.concatenate([d_c * new * i * (1 - i), d_c * before * f * (1 - f), d * tanh * o * (1 - o), d_c * i * (1 - new**2)], 1)
        d_w += x[:, t].T @ d_z
        d_u += h.T @ d_z
        d_b += d_z.sum(0)
        d_h, d_c = d_z @ u.T, d_c * f
    return d_w, d_u, d_b


class Labeller:
    """Two LSTMs and a logistic unit over their states."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.w = {}
        for side in ("f", "b"):
            self.w["w" + side] = rng.normal(0, INPUT**-0.5, (INPUT, 4 * HIDDEN))
            self.w["u" + side] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
            self.w["b" + side] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        self.w["out"], self.w["out0"] = rng.normal(0, HIDDEN**-0.5, 2 * HIDDEN), np.zeros(1)

    @staticmethod
    def pad(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A batch, which steps are real, and for every page the order that turns its steps round."""
        steps = max(len(p) for p in pages)
        x, real = np.zeros((len(pages), steps, INPUT)), np.zeros((len(pages), steps))
        turned = np.tile(np.arange(steps), (len(pages), 1))
        for i, p in enumerate(pages):
            x[i, : len(p)], real[i, : len(p)] = p, 1
            turned[i, : len(p)] = np.arange(len(p))[::-1]
        return x, real, turned

    def forward(self, x, real, turned):
        rows = np.arange(len(x))[:, None]
        back = x[rows, turned]
        f, kept_f = lstm(x, real, self.w["wf"], self.w["uf"], self.w["bf"])
        b, kept_b = lstm(back, real, self.w["wb"], self.w["ub"], self.w["bb"])
        states = np.concatenate([f, b[rows, turned]], 2)
        return sigmoid(states @ self.w["out"] + self.w["out0"]), states, back, kept_f, kept_b

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Which leaves of each page are content."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
        start = 0
        while start < len(order):
            # pages of about the same length share a batch of bounded size
            end = start + 1
            while end < len(order) and (end - start + 1) * len(pages[order[end]]) <= 1 << 13:
                end += 1
            chosen = order[start:end]
            p = self.forward(*self.pad([pages[i] for i in chosen]))[0]
            for row, i in enumerate(chosen):
                out[i] = p[row, : len(pages[i])] > 0.5
            start = end
        return out

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], seed: int = 5) -> None:
        """Adam on the log loss per leaf; deterministic for a seed."""
        rng = np.random.default_rng(seed)
        w = self.w
        first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), BATCH):
                chosen = order[at : at + BATCH]
                x, real, turned = self.pad([pages[i] for i in chosen])
                y = np.zeros_like(real)
                for row, i in enumerate(chosen):
                    y[row, : len(labels[i])] = labels[i]
                p, states, back, kept_f, kept_b = self.forward(x, real, turned)
                d = (p - y) * real / real.sum()
                d_states = d[..., None] * w["out"]
                rows = np.arange(len(x))[:, None]
                grad = {"out": np.einsum("nts,nt->s", states, d), "out0": np.array([d.sum()])}
                for side, given, kept, part in (("f", x, kept_f, d_states[..., :HIDDEN]), ("b", back, kept_b, d_states[..., HIDDEN:][rows, turned])):
                    grad["w" + side], grad["u" + side], grad["b" + side] = lstm_back(given, part, kept, w["w" + side], w["u" + side])
                step += 1
                for k, value in grad.items():
                    first[k] = 0.9 * first[k] + 0.1 * value
                    second[k] = 0.999 * second[k] + 0.001 * value**2
                    w[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)


#: What frames surround a text with: kind, containers (tag and names), and how the texts inside are written.
FURNITURE = (
    ("menu", ("nav", 'ul class="menu"', 'div id="navigation"', 'div class="breadcrumb"', 'div class="topbar"'), "links"),
    ("header", ("header", 'div class="header"', 'div id="masthead"', 'div class="banner"'), "line"),
    ("footer", ("footer", 'div class="footer"', 'div id="colophon"', 'div class="copyright"'), "line"),
    ("sidebar", ("aside", 'div class="sidebar"', 'div id="secondary"', 'div class="widget related"'), "links"),
    ("notice", ('div class="notice"', 'div class="cookie consent"', 'div role="alert"', 'div id="newsletter"', 'dialog class="popup"'), "prose"),
    ("advert", ('div class="ad"', 'div class="advert sponsored"', 'aside class="promo"', 'div id="ads"'), "prose"),
    ("form", ("form", 'form class="search"', 'div class="subscribe form"'), "line"),
    ("comments", ('section class="comments"', 'div id="comments"', 'ol class="comment list"', 'div class="replies discussion"'), "prose"),
)
CONTENT = ("article", "main", 'div class="content"', 'div class="post entry"', 'div id="article body"', 'section class="story"', 'div role="main"')


def frame(texts: list[str], rng: random.Random) -> str:
    """A page whose content and furniture carry marks, made of ``texts``."""
    take = lambda: entities.escape(rng.choice(texts))

    def piece(container: str, style: str, mark: str) -> str:
        tag = container.split()[0]
        words = take().split()
        if style == "links":
            body = "<ul>" + "".join(f"<li><a href='/'>{w}</a></li>" for w in words[: rng.randint(2, 7)]) + "</ul>"
        elif style == "line":
            body = " ".join(words[: rng.randint(1, 12)])
        else:
            body = "".join(rng.choice(("<p>{}</p>", "<div>{}</div>", "{}")).format(take()) for _ in range(rng.randint(1, 3)))
        return f"<{container} data-mark={mark}>{body}</{tag}>"

    around = [piece(rng.choice(containers), style, "other") for _, containers, style in FURNITURE if rng.random() < 0.6]
    rng.shuffle(around)
    parts = [f"<h1>{' '.join(take().split()[: rng.randint(2, 12)])}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.randint(1, 12)):
        parts.append(rng.choice(("<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<h2>{}</h2>", "<blockquote>{}</blockquote>", "<ul><li>{}</li></ul>", "<pre>{}</pre>")).format(take()))
    if rng.random() < 0.4:
        _, containers, style = rng.choice(FURNITURE[3:])
        parts.insert(rng.randint(0, len(parts)), piece(rng.choice(containers), style, "other"))
    container = rng.choice(CONTENT)
    content = f"<{container} data-mark=content>{''.join(parts)}</{container.split()[0]}>"
    cut = rng.randint(0, len(around))
    body = "".join(around[:cut]) + content + "".join(around[cut:])
    return f"<html><body>{rng.choice(('', '<div id=page>', '<div class=wrapper>'))}{body}</body></html>"


OTHER = frozenset("nav header footer aside form menu dialog ad ads advert sidebar comment comments".split())


def plain_labels(page: list[Leaf]) -> np.ndarray | None:
    """Labels of a page that says what is content: what stands in one of its article or main elements and in no furniture."""
    if not any(n in ("article", "main") for leaf in page for n in leaf.names):
        return None
    return np.array([bool({"article", "main"} & set(leaf.names)) and not OTHER & set(leaf.names) for leaf in page], float)


def windows(items, size: int = TRAIN_LEAVES) -> list:
    """All of a page in runs of consecutive leaves."""
    return [items[i : i + size] for i in range(0, len(items), size)]


def train(pages: list[str], seed: int = 5) -> Labeller:
    """Learn from sampled pages and from frames of their texts."""
    rng, model = random.Random(seed), Labeller(seed)
    texts, x, y = [], [], []
    for page in pages:
        own = leaves(page)
        texts += [leaf.text for leaf in own]
        labels = plain_labels(own)
        if labels is not None and len(own):
            x += windows(vectors(own))
            y += windows(labels)
    # frames need some texts, be the table empty
    texts = texts or ["a line of text", "another, longer line of text that ends in a full stop."]
    for _ in range(FRAMES):
        own = leaves(frame(texts, rng))
        x += windows(vectors(own))
        y += windows(np.array([bool(leaf.marks) and leaf.marks[-1] == "content" for leaf in own], float))
    model.fit(x, y, seed)
    return model


def fit_pages(df: DataFrame, id_column: str = "page_id", html: str = "html", sample: int = SAMPLE_PAGES, most_chars: int = 20_000) -> Labeller:
    """A labeller learned from ``sample`` pages at most, those with the smallest hashes among pages of up to ``most_chars``."""
    rows = pick(df, id=id_column, html=html)
    # some eight times as many pages as wanted are sorted, however many there are
    bound = -(1 << 63) + int((1 << 64) * min(1, 8 * sample / max(1, rows.count())))
    few = rows.select(F.xxhash64("id", "html").alias("h"), "html").filter(F.col("h") <= min(bound, (1 << 63) - 1)).filter(F.length("html").between(1, most_chars))
    chosen = few.orderBy("h", "html").limit(sample).collect()
    return train([r["html"] for r in chosen])


def extract_text(df: DataFrame, model: Labeller, id_column: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The id, URL, ``text`` and ``n_chars`` (code points) of every page.

    The text holds the leaves labelled content, in page order, one per line. A null or empty page has an empty text; ids and URLs are passed on as they
    are, null and repeated ones too; other columns are left out.
    """
    rows = pick(df, id=id_column, url=url, html=html)
    kind = rows.schema["id"].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            pages = [leaves(v or "") for v in batch.column(2).to_pylist()]
            texts = []
            for start in range(0, len(pages), 1024):
                part = pages[start : start + 1024]
                for page, keep in zip(part, shared.value.label([vectors(p) for p in part]), strict=True):
                    texts.append("\n".join(leaf.text for leaf, k in zip(page, keep, strict=True) if k))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [id_column, url, "text", "n_chars"])

    return rows.mapInArrow(run, f"`{id_column}` {kind}, `{url}` string, text string, n_chars bigint")


def op4_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return extract_text(pages, fit_pages(pages))
