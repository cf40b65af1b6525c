"""Main text of web pages: a recurrent labeller over the blocks of a page."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATH, WORDS, COUNTS = 160, 88, 8
INPUT = PATH + WORDS + COUNTS
HIDDEN = 24
PAGES = 250

# Names of elements and of common page parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
CLOSES_NO_P = INLINE | {"li", "dt", "dd", "tr", "td", "th", "option"}
SCOPES = frozenset("table ul ol dl select article section div body".split())
PAGE_PARTS = frozenset("nav header footer aside form button select menu dialog head title noscript template iframe svg textarea fieldset".split())
PART_NAMES = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo cookie cookies consent notice banner sidebar side widget comment "
    "comments reply replies respond discussion share social related newsletter subscribe signup popup modal breadcrumb breadcrumbs "
    "pagination pager menu nav navbar navigation footer header masthead toolbar login search disclaimer alert".split())

# A quote counts only where a value begins, right after an equals sign.
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_NAME = re.compile(r"[A-Za-z][a-z0-9]*")


_elements: dict[str, tuple[int, bool, bool]] = {}


def _element(element: str) -> tuple[int, bool, bool]:
    """(bits of its hashed words, whether it is a part of the page's frame, whether an article)."""
    found = _elements.get(element)
    if found is None:
        if len(_elements) > 20_000:
            _elements.clear()
        tag, *names = element.split()
        bits = 0
        for k, token in enumerate(element.split()):
            bits |= 1 << zlib.crc32(f"{'tag' if k == 0 else 'name'} {token}".encode()) % PATH
        found = _elements[element] = bits, tag in PAGE_PARTS or bool(PART_NAMES.intersection(names)), tag in ("article", "main")
    return found


class Path:
    """The elements around a block, from the root down; a path shares all of the one above.

    What is asked of a whole path is kept with each step, so a page's time and
    memory do not grow with its depth.
    """

    __slots__ = ("above", "element", "bits", "framed", "article")

    def __init__(self, above: "Path | None" = None, element: str = ""):
        self.above, self.element = above, element
        if above is None:
            self.bits, self.framed, self.article = 0, False, False
        else:
            bits, framed, article = _element(element)
            self.bits, self.framed, self.article = above.bits | bits, above.framed or framed, above.article or article

    def __iter__(self) -> Iterator[str]:
        out, at = [], self
        while at.above is not None:
            out.append(at.element)
            at = at.above
        return reversed(out)


ROOT = Path()


def path_of(elements) -> Path:
    path = ROOT
    for element in elements:
        path = Path(path, element)
    return path


@dataclass
class Block:
    path: Path
    text: str
    linked: int


def blocks(html: str | None) -> list[Block]:
    """Runs of text between block-level tags, in page order, character references decoded.

    Scripts, styles and comments go; unclosed and stray tags are taken as a browser
    takes the common cases. A path element is a tag and the words of its class, id
    and role.
    """
    html = html or ""
    out: list[Block] = []
    stack: list[tuple[str, Path]] = []
    opened: Counter = Counter()
    held: list[str] = []
    path, linked = ROOT, 0

    def flush() -> None:
        nonlocal linked, path
        text = " ".join("".join(held).split())
        if text:
            out.append(Block(path, text, min(linked, len(text))))
        held.clear()
        linked, path = 0, None

    def add(raw: str) -> None:
        nonlocal path, linked
        if not raw:
            return
        text = unescape(raw)
        if text.strip():
            if path is None:
                path = stack[-1][1] if stack else ROOT
            if opened["a"]:
                linked += len(text.strip())
        held.append(text)

    def push(tag: str, element: str) -> None:
        stack.append((tag, Path(stack[-1][1] if stack else ROOT, element)))
        opened[tag] += 1

    def close(at: int) -> None:
        for tag, _ in stack[at:]:
            opened[tag] -= 1
        del stack[at:]

    path = None
    at, end = 0, len(html)
    while at < end:
        lt = html.find("<", at)
        if lt < 0:
            add(html[at:])
            break
        add(html[at:lt])
        if html.startswith("<!--", lt):
            stop = html.find("-->", lt + 2)
            at = end if stop < 0 else stop + 3
            continue
        follows = html[lt + 1:lt + 2]
        if follows in ("!", "?"):
            stop = html.find(">", lt)
            at = end if stop < 0 else stop + 1
            continue
        letter = html[lt + 2:lt + 3] if follows == "/" else follows
        if not (letter.isascii() and letter.isalpha()):
            add("<")
            at = lt + 1
            continue
        m = _TAG.match(html, lt)
        if m:
            closing, tag, attributes, at = bool(m[1]), m[2].lower(), m[3], m.end()
        else:
            stop = html.find(">", lt)
            if stop < 0:
                break
            name = re.match(r"</?([A-Za-z][^\s/>]*)", html[lt:stop])
            closing, tag, attributes, at = follows == "/", name[1].lower(), "", stop + 1
        if tag == "br":
            add(" ")
            continue
        if tag not in INLINE:
            flush()
        if closing:
            if opened[tag]:
                close(max(k for k in range(len(stack)) if stack[k][0] == tag) if stack[-1][0] != tag else len(stack) - 1)
            continue
        if tag in RAW or tag == "title":
            stop = re.compile(f"</{tag}", re.I).search(html, at)
            if tag == "title":
                push(tag, tag)
                add(html[at:stop.start() if stop else end])
                flush()
                close(len(stack) - 1)
            after = html.find(">", stop.start()) if stop else -1
            at = end if after < 0 else after + 1
            continue
        ends = CLOSES.get(tag, frozenset()) | (frozenset() if tag in CLOSES_NO_P else frozenset({"p"}))
        if any(opened[t] for t in ends):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    close(k)
                    break
                if stack[k][0] in SCOPES:
                    break
        if tag not in VOID:
            names = " ".join(v.strip("\"'") for v in _NAMED.findall(attributes)) if attributes else ""
            push(tag, f"{tag} {' '.join(n.lower() for n in _NAME.findall(names))}".strip())
    flush()
    return out


def taught_label(path: Path, has_article: bool) -> int:
    """Label that a page's own marking gives: in an article and in no part of the page's frame."""
    return int(not path.framed and (path.article or not has_article))


_paths: dict[int, np.ndarray] = {}
_words: dict[str, int] = {}


def _path_vector(path: Path) -> np.ndarray:
    found = _paths.get(path.bits)
    if found is None:
        if len(_paths) > 20_000:
            _paths.clear()
        packed = np.frombuffer(path.bits.to_bytes(PATH // 8, "little"), np.uint8)
        found = _paths[path.bits] = np.unpackbits(packed, bitorder="little").astype(np.float32)
    return found


def _word_slot(word: str) -> int:
    found = _words.get(word)
    if found is None:
        if len(_words) > 300_000:
            _words.clear()
        found = _words[word] = zlib.crc32(word.encode()) % WORDS
    return found


def vectors(page: list[Block]) -> np.ndarray:
    """Tag-path, hashed-word and count features of each block."""
    out = np.zeros((len(page), INPUT), np.float32)
    for k, block in enumerate(page):
        out[k, :PATH] = _path_vector(block.path)
        words = block.text.split(" ")
        out[k, PATH:PATH + WORDS] = np.sqrt(np.bincount([_word_slot(w) for w in words], minlength=WORDS) / len(words)) * 0.3
        n = len(block.text)
        out[k, PATH + WORDS:] = (
            np.log1p(len(words)) / 6, np.log1p(n) / 8, block.linked / n, block.text[-1] in ".!?", block.text[0].isupper(),
            k == 0, k == len(page) - 1, 1)
    return out


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Lstm:
    """One direction; arrays are (step, page, value) and mask tells real steps."""

    def __init__(self, rng, inputs: int, hidden: int):
        self.w = (rng.standard_normal((inputs, 4 * hidden)) * 0.15).astype(np.float32)
        self.r = (rng.standard_normal((hidden, 4 * hidden)) / np.sqrt(hidden)).astype(np.float32)
        self.b = np.zeros(4 * hidden, np.float32)
        self.b[hidden:2 * hidden] = 1
        self.hidden = hidden

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        steps, pages, _ = x.shape
        drive = x @ self.w + self.b
        h = np.zeros((pages, self.hidden), np.float32)
        c = np.zeros_like(h)
        out, kept = np.zeros((steps, pages, self.hidden), np.float32), []
        n = self.hidden
        for t in range(steps):
            z = drive[t] + h @ self.r
            i, f, o = _sigmoid(z[:, :n]), _sigmoid(z[:, n:2 * n]), _sigmoid(z[:, 2 * n:3 * n])
            g = np.tanh(z[:, 3 * n:])
            on = mask[t][:, None]
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            if keep:
                kept.append((h, c, i, f, o, g, tanh_c))
            h = on * (o * tanh_c) + (1 - on) * h
            c = on * new_c + (1 - on) * c
            out[t] = h
        return out, kept

    def backward(self, x: np.ndarray, mask: np.ndarray, kept: list, grad: np.ndarray) -> list[np.ndarray]:
        steps, pages, _ = x.shape
        dh, dc = np.zeros((pages, self.hidden), np.float32), np.zeros((pages, self.hidden), np.float32)
        dz = np.zeros((steps, pages, 4 * self.hidden), np.float32)
        dr = np.zeros_like(self.r)
        for t in range(steps - 1, -1, -1):
            h, c, i, f, o, g, tanh_c = kept[t]
            on = mask[t][:, None]
            dh = dh + grad[t]
            through_h, through_c = dh * on, dc * on
            cell = through_c + through_h * o * (1 - tanh_c * tanh_c)
            dz[t] = np.concatenate(
                [cell * g * i * (1 - i), cell * c * f * (1 - f), through_h * tanh_c * o * (1 - o), cell * i * (1 - g * g)], axis=1)
            dr += h.T @ dz[t]
            dh = dh * (1 - on) + dz[t] @ self.r.T
            dc = dc * (1 - on) + cell * f
        flat = dz.reshape(-1, dz.shape[-1])
        return [x.reshape(-1, x.shape[-1]).T @ flat, dr, flat.sum(axis=0)]


class Labeller:
    """Bidirectional LSTM: a page's blocks are read both ways, each is classified by both states."""

    def __init__(self, seed: int = 7, inputs: int = INPUT, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        self.sides = [Lstm(rng, inputs, hidden), Lstm(rng, inputs, hidden)]
        self.v = (rng.standard_normal(2 * hidden) * 0.2).astype(np.float32)
        self.c = np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [p for s in self.sides for p in (s.w, s.r, s.b)] + [self.v, self.c]

    def _states(self, x, mask, keep=False):
        ahead, kept_a = self.sides[0].forward(x, mask, keep)
        back, kept_b = self.sides[1].forward(x[::-1], mask[::-1], keep)
        return np.concatenate([ahead, back[::-1]], axis=2), (kept_a, kept_b)

    def probabilities(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return _sigmoid(self._states(x, mask)[0] @ self.v + self.c)

    def gradients(self, x, mask, y) -> tuple[float, list[np.ndarray]]:
        states, (kept_a, kept_b) = self._states(x, mask, True)
        p = _sigmoid(states @ self.v + self.c)
        total = mask.sum()
        loss = -(mask * np.log(np.where(y > 0, p, 1 - p) + 1e-9)).sum() / total
        d = ((p - y) * mask / total).astype(np.float32)
        ds = d[:, :, None] * self.v
        n = self.sides[0].hidden
        ahead = self.sides[0].backward(x, mask, kept_a, ds[:, :, :n])
        back = self.sides[1].backward(x[::-1], mask[::-1], kept_b, ds[::-1, :, n:])
        return float(loss), ahead + back + [np.einsum("tp,tph->h", d, states), np.array([d.sum()], np.float32)]


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((steps, len(pages), INPUT), np.float32), np.zeros((steps, len(pages)), np.float32)
    for k, page in enumerate(pages):
        x[:len(page), k], mask[:len(page), k] = page, 1
    return x, mask


# Page parts that the pages at hand may lack: (markup around a borrowed text).
EXTRA_PARTS = (
    '<aside class="sidebar"><p>{}</p></aside>', '<div class="sidebar widget"><ul><li>{}</li></ul></div>',
    '<div id="cookie-notice"><p>{}</p></div>', '<section class="comments"><div class="comment"><p>{}</p></div></section>',
    '<div class="comment-list"><p>{}</p></div>', '<form class="newsletter"><label>{}</label><button>{}</button></form>',
    '<header><div>{}</div></header>', '<div class="banner promo">{}</div>', '<div class="related"><a href="/x">{}</a></div>',
    '<div class="share social"><a href="/y">{}</a></div>',
)
BODIES = ("article", "main", 'div class="content"', 'div class="post entry"', 'section class="article body"', "div")


def training_pages(pages: list[str], seed: int = 11) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages: as they are, by their own marking, and with parts put in or the article renamed."""
    rng = np.random.default_rng(seed)
    out = []
    for html in pages:
        page = blocks(html)
        if not page:
            continue
        article = any(b.path.article for b in page)
        label = [taught_label(b.path, article) for b in page]
        out.append((page, label))
        body = BODIES[rng.integers(len(BODIES))]
        name, *rest = body.split(" ", 1)
        names = " ".join(_NAME.findall(rest[0].split("=")[1])).lower() if rest else ""
        element = f"{name} {names}".strip()
        renamed = [Block(path_of(element if e.split()[0] in ("article", "main") else e for e in b.path), b.text, b.linked) for b in page]
        varied, kept = list(renamed), list(label)
        for _ in range(int(rng.integers(1, 4))):
            borrowed = page[rng.integers(len(page))].text
            extra = blocks("<html><body>" + EXTRA_PARTS[rng.integers(len(EXTRA_PARTS))].replace("{}", borrowed.replace("<", "")))
            spots = [k for k in range(len(kept) + 1) if k == len(kept) or k == 0 or not (kept[k - 1] and kept[k])]
            spot = spots[rng.integers(len(spots))]
            varied[spot:spot], kept[spot:spot] = extra, [0] * len(extra)
        out.append((varied, kept))
    return out


def train(pages: list[str], epochs: int = 12, batch: int = 32, rate: float = 0.01, seed: int = 5) -> Labeller:
    model = Labeller()
    taught = [(vectors(p), np.array(y, np.float32)) for p, y in training_pages(pages)]
    if not taught:
        return model
    rng = np.random.default_rng(seed)
    taught.sort(key=lambda t: len(t[1]))
    groups = [taught[k:k + batch] for k in range(0, len(taught), batch)]
    values = model.parameters()
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for epoch in range(epochs):
        for k in rng.permutation(len(groups)):
            x, mask = padded([t[0] for t in groups[k]])
            y = np.zeros_like(mask)
            for j, (_, label) in enumerate(groups[k]):
                y[:len(label), j] = label
            _, gradients = model.gradients(x, mask, y)
            norm = np.sqrt(sum(float((g * g).sum()) for g in gradients))
            step += 1
            slow = rate * (1 if epoch < epochs * 2 // 3 else 0.2)
            for v, g, m, s in zip(values, gradients, first, second):
                g = g * min(1.0, 5 / (norm + 1e-9))
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                v -= slow * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)
    return model


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = PAGES) -> Labeller:
    """Trains on at most `sample` pages, those of the smallest hashes of id, by their own marking."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).where("html IS NOT NULL")
    chosen = rows.select("id").where("id IS NOT NULL").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    return train([r["html"] for r in rows.join(F.broadcast(chosen), "id", "left_semi").orderBy("id", "html").limit(sample).collect()])


def main_texts(model: Labeller, pages: list[str | None]) -> list[str]:
    """Main text of each page: the blocks labelled so, one to a line."""
    found = [blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((k for k in range(len(pages)) if found[k]), key=lambda k: len(found[k]))
    while order:
        group = [order.pop()]
        longest = len(found[group[0]])
        while order and (len(group) + 1) * longest <= 8192:
            group.append(order.pop())
        p = model.probabilities(*padded([vectors(found[k]) for k in group]))
        for j, k in enumerate(group):
            out[k] = "\n".join(b.text for b, keep in zip(found[k], p[:len(found[k]), j] >= 0.5) if keep)
    return out


def extract(df: DataFrame, model: Labeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows page_id, url, text, n_chars for every whole page.

    A null page counts as empty; text is empty where no block is main text. Rows are
    independent, so repeated rows repeat; other columns are not read. No shuffle;
    the model, of fixed size, goes to the tasks.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = main_texts(sent.value, part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    rows = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
