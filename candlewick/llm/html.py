"""Main text of web pages: a bidirectional LSTM reads the leaf blocks of a page in order and classifies each."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Sizes of the hashed tag path, the hashed words and the plain figures of a block; units of each direction.
PATH, WORDS, FIGURES, UNITS = 64, 32, 8, 16

#: Elements that end a block of text, elements without content, elements whose content is no text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody "
    "td tfoot th thead tr ul button textarea label iframe noscript object".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<svg(?=[\s/>])(?:[^>"'/]++|/(?!>)|"[^"]*+"|'[^']*+')*+/>"""
    r"|<(script|style|template|svg|title)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"""(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_PARTS = re.compile("[a-z]+")
#: A start tag of the key closes an open element of the value's names.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int  # characters inside links


def blocks(html: str | None) -> list[Block]:
    """Leaf blocks of a page in order, with the tags, classes and ids above them. Unclosed, crossed and stray tags are tolerated."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    links = linked = 0

    def end_block() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(pieces)).split())
        if text:
            out.append(Block(tuple(n for _, names in stack for n in names), text, min(linked, len(text))))
        pieces.clear()
        linked = 0

    at = 0
    source = html or ""
    for m in _TOKEN.finditer(source):
        if m.start() > at:
            pieces.append(source[at : m.start()])
            linked += (m.start() - at) * (links > 0)
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            continue
        closing, attributes = bool(m[2] or m[5]), m[4] or m[7] or ""
        if tag == "a":
            links = 0 if closing else 1
        if tag == "br":
            pieces.append(" ")
        if tag not in BLOCKS:
            continue
        end_block()
        links = 0
        if closing:
            places = [i for i, (t, _) in enumerate(stack) if t == tag]
            if places:
                del stack[places[-1] :]
            continue
        if stack and stack[-1][0] == "p":
            stack.pop()
        while stack and stack[-1][0] in _CLOSES.get(tag, ()):
            stack.pop()
        if tag not in VOID and not attributes.endswith("/"):
            marks = [p for _, value in _NAMES.findall(attributes) for p in _PARTS.findall(value.lower())]
            stack.append((tag, (tag, *("." + p for p in marks))))
    if len(source) > at:
        pieces.append(source[at:])
    end_block()
    return out


class _Known(dict):
    """What ``make`` gives for each key. Long keys are not kept, and a full store is emptied, so that a worker's memory is bounded."""

    def __init__(self, make: Callable, longest: int, most: int) -> None:
        self.make, self.longest, self.most = make, longest, most

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


def _path_row(path: tuple[str, ...]) -> np.ndarray:
    """Hashed names of a path, each once; the last ones count most."""
    row = np.zeros(PATH, np.float32)
    for k, name in enumerate(dict.fromkeys(reversed(path))):
        h = crc32(name.encode())
        row[h % PATH] += (1.0 if h & 0x10000 else -1.0) / (1 + 0.1 * min(k, 16))  # far ancestors still count
    return row


def _word_code(word: str) -> int:
    """Slot of a word, whether it counts there negatively, and whether a stop ends it, in one number below 256."""
    h = crc32(word.strip(".,:;!?()©").encode())
    return 4 * (h % WORDS) + (0 if h & 0x10000 else 2) + (word[-1] in ".!?,;:")


_PATHS = _Known(_path_row, 32, 5_000)
_CODES = _Known(_word_code, 64, 100_000)

#: Blocks of a page whose words are counted at once.
RUN = 4_096


def block_features(page: list[Block]) -> np.ndarray:
    """A row for each block: hashed names of the whole path (each once, the last ones count most), hashed words, figures of shape and place."""
    x = np.zeros((len(page), PATH + WORDS + FIGURES), np.float32)
    for at in range(0, len(page), RUN):
        run = page[at : at + RUN]
        n, rows = len(run), x[at : at + RUN]
        for row, b in zip(rows, run, strict=True):
            row[:PATH] = _PATHS[b.path]
        codes = [bytes(map(_CODES.__getitem__, b.text.lower().split())) for b in run]
        counts = np.fromiter(map(len, codes), np.int64, n)
        places = np.repeat(np.arange(n) * 4 * WORDS, counts) + np.frombuffer(b"".join(codes), np.uint8)
        tally = np.bincount(places, minlength=n * 4 * WORDS).reshape(n, WORDS, 2, 2)
        signed = tally[:, :, 0].sum(2) - tally[:, :, 1].sum(2)
        norms = np.maximum(1.0, np.sqrt((signed * signed).sum(1))).astype(np.float32)  # long and repetitive blocks weigh no more
        rows[:, PATH : PATH + WORDS] = signed.astype(np.float32) / norms[:, None]
        lengths = np.fromiter((len(b.text) for b in run), np.int64, n)
        rows[:, PATH + WORDS :] = np.stack((
            np.minimum(counts, 100) / 50, np.minimum(np.log1p(lengths), 8) / 4, [b.linked for b in run] / lengths, tally[..., 1].sum((1, 2)) / counts,
            np.arange(at, at + n) / len(page), [b.text[0].isupper() for b in run], [b.text[0] == "©" for b in run], np.full(n, min(len(page), 200) / 100),
        ), 1)
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Two LSTMs, one for each direction, and a logistic layer over both. Sequences come padded, with a mask."""

    def __init__(self, inputs: int, units: int = UNITS, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        scale = 1 / np.sqrt(inputs + units)
        self.units = units
        self.p = {}
        for d in "fb":
            self.p["w" + d] = rng.normal(0, scale, (inputs + units, 4 * units))
            self.p["c" + d] = np.concatenate([np.zeros(units), np.ones(units), np.zeros(2 * units)])  # open forget gates
        self.p["o"] = rng.normal(0, scale, 2 * units)
        self.p["z"] = np.zeros(1)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States for each step; ``keep`` gathers what the way back needs."""
        n, steps, units = len(x), x.shape[1], self.units
        w, c = self.p["w" + d], self.p["c" + d]
        out = np.zeros((n, steps, units))
        inner = x @ w[: x.shape[2]] + c
        h, s = np.zeros((n, units)), np.zeros((n, units))
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            gates = inner[:, t] + h @ w[x.shape[2] :]
            i, f, o = (_sigmoid(gates[:, k * units : (k + 1) * units]) for k in range(3))
            g = np.tanh(gates[:, 3 * units :])
            m = mask[:, t, None]
            new = f * s + i * g
            tanh = np.tanh(new)
            if keep is not None:
                keep.append((t, i, f, o, g, s, tanh, h, m))
            s = m * new + (1 - m) * s
            h = m * o * tanh + (1 - m) * h
            out[:, t] = h
        return out

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, mask, "f", None), self._run(x, mask, "b", None)], 2)
        return _sigmoid(both @ self.p["o"] + self.p["z"])

    def gradients(self, x: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean logistic loss over all blocks, back through time in both directions."""
        keeps: dict[str, list] = {"f": [], "b": []}
        both = np.concatenate([self._run(x, mask, d, keeps[d]) for d in "fb"], 2)
        error = (_sigmoid(both @ self.p["o"] + self.p["z"]) - labels) * mask / mask.sum()
        out = {"o": np.einsum("nt,ntu->u", error, both), "z": np.array([error.sum()])}
        units, inputs = self.units, x.shape[2]
        for k, d in enumerate("fb"):
            w = self.p["w" + d]
            dw, dc = np.zeros_like(w), np.zeros_like(self.p["c" + d])
            dh, ds = np.zeros((len(x), units)), np.zeros((len(x), units))
            for t, i, f, o, g, s, tanh, h, m in reversed(keeps[d]):
                dh = dh + error[:, t, None] * self.p["o"][k * units : (k + 1) * units]
                inner = m * dh
                dnew = m * ds + inner * o * (1 - tanh**2)
                gates = np.concatenate([dnew * g * i * (1 - i), dnew * s * f * (1 - f), inner * tanh * o * (1 - o), dnew * i * (1 - g**2)], 1)
                dw[:inputs] += x[:, t].T @ gates
                dw[inputs:] += h.T @ gates
                dc += gates.sum(0)
                ds = dnew * f + (1 - m) * ds
                dh = gates @ w[inputs:].T + (1 - m) * dh
            out["w" + d], out["c" + d] = dw, dc
        return out


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, rows))
    x, mask = np.zeros((len(rows), steps, rows[0].shape[1])), np.zeros((len(rows), steps))
    for i, r in enumerate(rows):
        x[i, : len(r)], mask[i, : len(r)] = r, 1
    return x, mask


# --- pages to learn from ---------------------------------------------------------------------------------

MAIN = "\ue000"  # marks main text in made pages
_MENU = "Home About Contact News Products Services Login Register Blog Shop Help Search Archive Support Careers Accueil Kontakt Inicio Produkte".split()
_NOTICES = ("We use cookies to improve your experience.", "Accept all cookies", "Subscribe to our newsletter", "Sign up for free", "Please enable JavaScript.", "Share this page", "Advertisement", "Sponsored content", "Related articles", "Read more", "All rights reserved.")
_ASIDES = ("sidebar", "widget", "related", "promo", "ad", "ads", "advert", "banner", "sponsor", "cookie", "notice", "popup", "newsletter", "share", "social", "breadcrumb", "breadcrumbs", "pagination", "tags", "toolbar")


def made_page(rng: np.random.Generator) -> str:
    """A page of random words in one of many layouts; main text is marked."""
    letters = np.array(list("etaoinshrdlucmfwypvbgkàéüñö"))
    vocabulary = ["".join(rng.choice(letters[:20] if rng.random() < 0.7 else letters, rng.integers(1, 10))) for _ in range(60)]

    def words(low: int, high: int) -> str:
        made = [str(w) for w in rng.choice(vocabulary, int(rng.integers(low, high)))]
        if rng.random() < 0.12:
            made = [w + str(rng.choice(["%%%", "&amp;&amp;", "***", "!!", "###", " |"])) for w in made]
        return " ".join(made).capitalize()

    def sentences(most: int = 8) -> str:
        return " ".join(words(1, 18) + "." for _ in range(int(rng.integers(1, most))))

    pick = lambda *x: str(x[rng.integers(len(x))])
    some = lambda share: rng.random() < share

    def paragraph() -> str:
        kind = rng.random()
        body = MAIN + (sentences() if some(0.85) else words(1, 5) + ".")
        if kind < 0.6:
            return f"<p>{body}</p>" if some(0.8) else f"<p>{body}"
        if kind < 0.75:
            return f"<p><b>{body}<br>" if some(0.5) else f"<p>{body} <a href='/x'>{words(1, 4)}</a> {words(2, 9)}.</p>"
        if kind < 0.82:
            return f"<h{pick(2, 3)}>{MAIN}{words(2, 7)}</h{pick(2, 3)}>"
        if kind < 0.9:
            return "<ul>" + "".join(f"<li>{MAIN}{words(3, 14)}</li>" for _ in range(int(rng.integers(2, 5)))) + "</ul>"
        if kind < 0.95:
            return f"<blockquote>{body}</blockquote>"
        return f"<div>{body}</div>"

    def menu(tag: str) -> str:
        items = "".join(f'<li><a href="/{k}">{pick(*_MENU) if some(0.5) else words(1, 3)}</a></li>' for k in range(int(rng.integers(2, 9))))
        return f"<{tag}><ul>{items}</ul></{tag.split()[0]}>"

    def aside() -> str:
        tag = pick("aside", "div", "section")
        name = pick(*_ASIDES)
        body = pick(*_NOTICES) if some(0.35) else sentences(4)
        inner = f"<p>{body}</p>" if some(0.5) else body
        return f'<{tag} {pick("class", "id")}="{name}{pick("", "-box", " left", "-1")}">{inner}</{tag}>' if tag != "aside" or some(0.5) else f"<aside>{inner}</aside>"

    def remarks() -> str:
        each = "".join(f'<{pick("div", "li")} class="{pick("comment", "reply", "comment-body")}"><p>{sentences(4)}</p></div>' for _ in range(int(rng.integers(1, 5))))
        return f'<{pick("section", "div")} {pick("id", "class")}="{pick("comments", "comment-list", "replies", "discussion")}"><h3>{pick("Comments", "Kommentare", "Commentaires", words(1, 3))}</h3>{each}</section></div>'

    def form() -> str:
        return f'<form action="/s"><label>{words(1, 3)}</label><input name="q"><button>{pick("Send", "Search", "OK", words(1, 2))}</button></form>'

    title = MAIN + words(2, 10)
    heading = f"<h1>{title}</h1>" if some(0.9) else ""
    main = heading + "".join(paragraph() + (aside() if some(0.04) else "") for _ in range(int(rng.integers(1, 14))))
    wrap = pick("article", "article", "main", 'div class="content"', 'div class="post-body"', 'div id="main"', 'section class="article"', 'div class="entry"')
    top = menu("nav") if some(0.75) else menu(pick('div class="menu"', 'div id="navigation"', "header", 'ul class="nav"', 'div class="topbar"'))
    if some(0.25):
        top = f"<header><div>{words(1, 4)}</div>{top}</header>"
    parts = [top, *(aside() for _ in range(int(rng.integers(0, 3)))), form() if some(0.15) else "", f"<{wrap}>{main}</{wrap.split()[0]}>"]
    parts += [aside() if some(0.3) else "", remarks() if some(0.3) else "", form() if some(0.15) else "", menu(pick("nav", 'div class="links"')) if some(0.1) else ""]
    foot = pick(f"&copy; example.com &middot; {sentences(3)}", sentences(3), f"Copyright {words(1, 4)}", pick(*_NOTICES))
    parts.append(pick(f"<footer>{foot}</footer>", f"<footer><p>{foot}</p></footer>", f'<div class="footer">{foot}</div>', f'<div id="{pick("footer", "bottom", "copyright")}"><p>{foot}</p></div>'))
    return f"<html><head><title>{words(2, 6)}</title></head><body>{''.join(parts)}" + pick("</body></html>", "")


def fit_labeller(pages: int = 1_600, passes: int = 4, batch: int = 32, rate: float = 0.02, seed: int = 11) -> Labeller:
    """Learn from made pages only, so that the model is the same for any input."""
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for _ in range(pages):
        page = blocks(made_page(rng))
        marks = np.array([b.text.startswith(MAIN) for b in page], float)
        plain = [Block(b.path, b.text.replace(MAIN, "").strip(), b.linked) for b in page]
        usable = [i for i, b in enumerate(plain) if b.text]
        rows.append(block_features([plain[i] for i in usable]))
        labels.append(marks[usable])
    model = Labeller(PATH + WORDS + FIGURES)
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    step = 0
    for _ in range(passes):
        order = sorted(rng.permutation(len(rows)).tolist(), key=lambda i: len(rows[i]) // 6)
        starts = rng.permutation(range(0, len(order), batch))
        for at in starts.tolist():
            chosen = order[at : at + batch]
            x, mask = padded([rows[i] for i in chosen])
            target = padded([labels[i][:, None] for i in chosen])[0][:, :, 0]
            step += 1
            slow = rate * (1 - 0.9 * step / (passes * len(starts)))
            for k, g in model.gradients(x, mask, target).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model.p[k] -= slow * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


@lru_cache(maxsize=1)
def standard_labeller() -> Labeller:
    return fit_labeller()


#: Steps times pages of one batch through the model.
BATCH_STEPS = 16_384


def main_texts(model: Labeller, pages: list[str | None], least: float = 0.5) -> list[str]:
    """Main blocks of each page, joined by an empty line."""
    parsed = [blocks(p) for p in pages]
    order = sorted((i for i, p in enumerate(parsed) if p), key=lambda i: len(parsed[i]))
    out = [""] * len(pages)
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and len(parsed[order[to]]) * (to - at + 1) <= BATCH_STEPS:
            to += 1
        chosen = order[at:to]
        x, mask = padded([block_features(parsed[i]) for i in chosen])
        for i, scores in zip(chosen, model.scores(x, mask), strict=True):
            out[i] = "\n\n".join(b.text for b, s in zip(parsed[i], scores, strict=False) if s >= least)
        at = to
    return out


def extracted(pages: DataFrame, html: str = "html", model: Labeller | None = None, out: str = "main_text") -> DataFrame:
    """``pages`` with the main text of each: blocks that the model holds for main text, in order, joined by two newlines.

    Null and empty pages, and pages without main text, give the empty string. A column of the same name as the result is
    replaced. The model is fitted once per process on made pages.
    """
    model = model or standard_labeller()
    columns = [c for c in pages.columns if c != out]
    schema = pages.select(*columns).schema.add(out, "string")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{out: main_texts(model, pdf[html].tolist())})

    return pages.select(*columns).mapInPandas(scan, schema)
