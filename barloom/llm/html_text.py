"""Main text of web pages: a bidirectional LSTM labels every leaf block in the context of its whole page.

A block is a vector made of its tag path (hashed elements and their class names), its words (hashed) and a
few counts. The network (numpy, trained here) is fitted on a bounded sample of the given pages: their blocks
are labelled by the elements they stand in, and their texts are also set into many other layouts, with menus,
notices, adverts, forms and comments around them, in which the labels are known by construction.
"""

from __future__ import annotations

import random
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.sampling import least_hashes
from barloom.llm.arrow import batch_limit, with_columns
from barloom.llm.html_blocks import Block, blocks

#: Pages that the network is fitted on, those with the least hash of their id, and their length at most.
SAMPLE_PAGES, SAMPLE_CHARS = 160, 100_000
LAYOUTS = 1280
PATH_DIMS, WORD_DIMS, COUNTS = 96, 24, 7
INPUTS = PATH_DIMS + WORD_DIMS + COUNTS
HIDDEN = 16
EPOCHS, BATCH, RATE = 24, 32, 0.012
#: Pages run together, places for blocks in such a run (longest page x pages), and blocks of a longer page alone at a time.
PAGES_AT_ONCE, PLACES = 128, 1 << 15
STRETCH = 4096
SEED = 7
MARK = "\ue000"
WORDS = "the of and a to in is it for on with as at by an be this that from or"

#: Elements whose blocks are main text, and those that never are, in the sampled pages.
MAIN = {"article", "main"}
ASIDE = {"nav", "aside", "footer", "form", "head", "menu", "button", "select", "dialog"}
MAIN_NAMES = ["content", "post", "entry", "article body", "story", "main", "text", "post content", "page"]
OTHER_NAMES = {
    "menu": ["menu", "navbar", "navigation", "breadcrumb", "links", "nav"],
    "header": ["header", "masthead", "top", "site header", "logo"],
    "footer": ["footer", "site footer", "bottom", "copyright", "legal"],
    "sidebar": ["sidebar", "related", "widget", "popular", "share", "tags"],
    "ad": ["ad", "ads", "advert", "sponsored", "promo", "banner"],
    "notice": ["cookie", "notice", "consent", "gdpr", "alert", "popup", "subscribe"],
    "comments": ["comments", "comment", "comment list", "responses", "discussion", "replies"],
}


@lru_cache(maxsize=50_000)
def _hashed(token: str, dims: int) -> np.ndarray:
    """A fixed random vector of a token."""
    return np.random.default_rng(zlib.crc32(token.encode("utf-8", "surrogatepass"))).standard_normal(dims) / np.sqrt(dims)


@lru_cache(maxsize=50_000)
def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    out = np.zeros(PATH_DIMS)
    for token in dict.fromkeys(path):
        out += _hashed(token, PATH_DIMS)
    for token in path[-2:]:
        out += 0.5 * _hashed("last " + token, PATH_DIMS)
    return out


def features(page: list[Block], start: int = 0, end: int | None = None) -> np.ndarray:
    """One row for each block, or for those from ``start`` to ``end``."""
    end = len(page) if end is None else min(end, len(page))
    out = np.zeros((end - start, INPUTS))
    for i in range(start, end):
        block = page[i]
        words = block.text.split()
        row = out[i - start]
        row[:PATH_DIMS] = _path_vector(block.path)
        buckets = np.bincount([zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORD_DIMS for w in words], minlength=WORD_DIMS)
        row[PATH_DIMS : PATH_DIMS + WORD_DIMS] = buckets / max(len(words), 1)
        text = block.text
        row[PATH_DIMS + WORD_DIMS :] = (
            np.log1p(len(words)) / 4,
            block.linked / max(len(words), 1),
            i / len(page),
            min(text.count(".") + text.count(","), 40) / 20,
            text[-1] in ".!?:;\"'",
            min(len(text) / len(words), 20) / 10,
            1.0,
        )
    return out


@dataclass
class Network:
    """Weights of the two directions (input, gates of hidden; gates in the order in, forget, out, new) and the output."""

    forward: np.ndarray
    backward: np.ndarray
    out: np.ndarray

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Network:
        scale = 1 / np.sqrt(INPUTS + HIDDEN)
        made = [rng.standard_normal((INPUTS + HIDDEN, 4 * HIDDEN)) * scale for _ in range(2)]
        return cls(*made, rng.standard_normal(2 * HIDDEN + 1) * 0.1)

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of each block to be main text; pages of like length are run together."""
        results: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        start = 0
        while start < len(order):
            end = start + 1
            while end < len(order) and end - start < PAGES_AT_ONCE and len(pages[order[end]]) * (end - start + 1) <= PLACES:
                end += 1
            chosen = order[start:end]
            x, mask = _padded([pages[i] for i in chosen])
            ahead = _run(self.forward, x, mask)[0]
            back = _run(self.backward, x[::-1], mask[::-1])[0][::-1]
            z = ahead @ self.out[:HIDDEN] + back @ self.out[HIDDEN:-1] + self.out[-1]
            for column, i in enumerate(chosen):
                results[i] = _sigmoid(z[: len(pages[i]), column])
            start = end
        return results

    def label_long(self, page: list[Block]) -> np.ndarray:
        """The same for a page of any number of blocks: its vectors are made and read a stretch at a time, in both directions."""
        z = np.full(len(page), self.out[-1])
        starts = range(0, len(page), STRETCH)
        for weights, out, turned in ((self.forward, self.out[:HIDDEN], False), (self.backward, self.out[HIDDEN:-1], True)):
            h, c = np.zeros((1, HIDDEN)), np.zeros((1, HIDDEN))
            for start in reversed(starts) if turned else starts:
                x = features(page, start, start + STRETCH)
                from_x = (x[::-1] if turned else x) @ weights[:INPUTS]
                part = np.zeros(len(x))
                for t in range(len(x)):
                    h, c = _cell(from_x[t] + h @ weights[INPUTS:], c)[:2]
                    part[t] = (h @ out)[0]
                z[start : start + len(x)] += part[::-1] if turned else part
        return _sigmoid(z)

    def label_blocks(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Probabilities for pages of any length: the longer ones one by one, the others together."""
        results = [self.label_long(p) if len(p) > STRETCH else np.zeros(0) for p in pages]
        short = [i for i, p in enumerate(pages) if len(p) <= STRETCH]
        held: list[int] = []

        def run() -> None:
            for i, found in zip(held, self.label([features(pages[i]) for i in held]), strict=True):
                results[i] = found
            held.clear()

        blocks_held = 0
        for i in short:
            if held and blocks_held + len(pages[i]) > PLACES:
                run()
                blocks_held = 0
            held.append(i)
            blocks_held += len(pages[i])
        run()
        return results


def _cell(z: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
    """New hidden and cell state, and the gates."""
    i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN] + (k == 1)) for k in range(3))
    g = np.tanh(z[:, 3 * HIDDEN :])
    c_new = f * c + i * g
    return o * np.tanh(c_new), c_new, i, f, o, g


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Blocks by place and page, and where there is one."""
    longest = max(map(len, pages))
    x, mask = np.zeros((longest, len(pages), INPUTS)), np.zeros((longest, len(pages), 1))
    for i, page in enumerate(pages):
        x[: len(page), i], mask[: len(page), i] = page, 1
    return x, mask


def _run(weights: np.ndarray, x: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Hidden states of one direction; ``keep`` returns what the way back needs. Padding leaves the state as it is."""
    steps, pages, _ = x.shape
    h, c = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
    states, held = np.zeros((steps, pages, HIDDEN)), []
    from_x = x @ weights[:INPUTS]
    for t in range(steps):
        h_new, c_new, i, f, o, g = _cell(from_x[t] + h @ weights[INPUTS:], c)
        if keep:
            held.append((h, c, i, f, o, g, c_new))
        h, c = mask[t] * h_new + (1 - mask[t]) * h, mask[t] * c_new + (1 - mask[t]) * c
        states[t] = h
    return states, held


def _way_back(weights: np.ndarray, x: np.ndarray, mask: np.ndarray, held: list, above: np.ndarray) -> np.ndarray:
    """Gradient of the weights of one direction, given that of its hidden states."""
    steps, pages, _ = x.shape
    dh, dc = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
    dz_all = np.zeros((steps, pages, 4 * HIDDEN))
    before = np.zeros((steps, pages, HIDDEN))
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, g, c_new = held[t]
        dh = dh + above[t]
        here, past = dh * mask[t], dh * (1 - mask[t])
        tanh = np.tanh(c_new)
        d_new = dc * mask[t] + here * o * (1 - tanh * tanh)
        dz = np.concatenate([d_new * g * i * (1 - i), d_new * c * f * (1 - f), here * tanh * o * (1 - o), d_new * i * (1 - g * g)], 1)
        dz_all[t], before[t] = dz, h
        dh = past + dz @ weights[INPUTS:].T
        dc = dc * (1 - mask[t]) + d_new * f
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    return np.concatenate([x.reshape(-1, INPUTS).T @ flat, before.reshape(-1, HIDDEN).T @ flat])


def _gradients(net: Network, pages: list[np.ndarray], labels: list[np.ndarray]) -> tuple[list[np.ndarray], float]:
    x, mask = _padded(pages)
    y = np.zeros(mask.shape[:2])
    for i, label in enumerate(labels):
        y[: len(label), i] = label
    ahead, held_a = _run(net.forward, x, mask, True)
    back, held_b = _run(net.backward, x[::-1], mask[::-1], True)
    both = np.concatenate([ahead, back[::-1]], 2)
    p = _sigmoid(both @ net.out[:-1] + net.out[-1])
    there = mask[:, :, 0]
    d = (p - y) * there / there.sum()
    loss = float(-np.sum(there * np.log(np.where(y > 0, p, 1 - p) + 1e-12)) / there.sum())
    d_out = np.append(np.einsum("tb,tbh->h", d, both), d.sum())
    above = d[:, :, None] * net.out[:-1]
    return [
        _way_back(net.forward, x, mask, held_a, above[:, :, :HIDDEN]),
        _way_back(net.backward, x[::-1], mask[::-1], held_b, above[::-1, :, HIDDEN:]),
        d_out,
    ], loss


def train(pages: list[tuple[np.ndarray, np.ndarray]]) -> Network:
    """Adam over batches of pages of like length; the same pages give the same network."""
    rng = np.random.default_rng(SEED)
    net = Network.fresh(rng)
    weights = [net.forward, net.backward, net.out]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    pages = sorted((p for p in pages if len(p[0])), key=lambda p: len(p[0]))
    step = 0
    for _ in range(EPOCHS):
        for start in rng.permutation(range(0, len(pages), BATCH)):
            chosen = pages[start : start + BATCH]
            gradients, _ = _gradients(net, [p[0] for p in chosen], [p[1] for p in chosen])
            step += 1
            for w, g, m, v in zip(weights, gradients, first, second, strict=True):
                g = np.clip(g, -1, 1)
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def by_elements(block: Block) -> float:
    """Label of a block in a sampled page: inside an article and in nothing that is set apart there."""
    names = set(block.path)
    apart = names & ASIDE or any("." + part in names for kind in OTHER_NAMES.values() for n in kind for part in n.split()[:1])
    return float(bool(names & MAIN) and not apart)


def layout(rng: random.Random, main: list[str], others: list[str]) -> str:
    """A page around the given main texts, which are marked."""

    def words(n: int) -> str:
        return " ".join(rng.choice(others).split()[:n]) or "text"

    def other(kind: str) -> str:
        name = rng.choice(OTHER_NAMES[kind])
        tag = rng.choice({"menu": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "comments": ["section", "div", "ol"], "sidebar": ["aside", "div"]}.get(kind, ["div", "section", "p"]))
        named = rng.random() < 0.85 or tag in ("div", "section", "p", "ul", "ol")
        attribute = f' {rng.choice(["class", "class", "id"])}="{name.replace(" ", rng.choice(["-", " ", "_"]))}"' if named else ""
        if rng.random() < 0.05:
            inner = f"<p>{' '.join(words(60) for _ in range(rng.randint(4, 12)))}</p>"
        elif kind in ("menu", "sidebar") and rng.random() < 0.8:
            inner = "".join(f"<li><a href='/x'>{words(rng.randint(1, 3))}</a></li>" for _ in range(rng.randint(2, 8)))
            inner = inner if tag == "ul" else f"<ul>{inner}</ul>"
        elif kind == "comments":
            inner = "".join(f"<{t}>{words(rng.randint(3, 60))}</{t}>" for t in rng.choices(["p", "div", "li"], k=rng.randint(1, 4)))
        elif kind == "notice" and rng.random() < 0.5:
            inner = f"<p>{words(rng.randint(3, 25))}</p><button>{words(1)}</button>"
        else:
            inner = rng.choice(["{}", "<p>{}</p>", "<span>{}</span>", "<a href='/y'>{}</a>"]).format(words(rng.randint(2, 40)))
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def form() -> str:
        return f"<form><label>{words(2)}</label><input><button>{words(1)}</button></form>"

    def without_scripts() -> str:
        return f"<noscript>{words(rng.randint(3, 15))}</noscript>"

    body = [f"<h1>{MARK}{main[0][:80]}</h1>"] if rng.random() < 0.8 else []
    listed = rng.random() < 0.2
    if rng.random() < 0.1:
        main = [" ".join(rng.choices(main, k=rng.randint(4, 20)))]
    for text in main:
        tag = rng.choice(["p", "p", "p", "p", "h2", "blockquote", "div"]) if len(text) > 60 else "p"
        broken = rng.random() < 0.25
        if rng.random() < 0.04:
            body.append(f"<noscript>{MARK}{text}</noscript>")
            continue
        body.append(f"<{tag}>{'<b>' if broken else ''}{MARK}{text}{'' if broken and tag == 'p' else f'</{tag}>'}")
        if listed and rng.random() < 0.3:
            body.append(f"<ul><li>{MARK}{words(8)}</li><li>{MARK}{words(6)}</li></ul>")
        if rng.random() < 0.08:
            body.append(other(rng.choice(["ad", "sidebar", "notice"])))
    if rng.random() < 0.25:
        body.append(other("comments"))
    if rng.random() < 0.1:
        body.append(form())
    tag = rng.choice(["article", "article", "main", "div", "section"])
    name = f' class="{rng.choice(MAIN_NAMES).replace(" ", "-")}"' if tag not in ("article", "main") or rng.random() < 0.3 else ""
    whole = [f"<{tag}{name}>", *body, f"</{tag}>"]
    before = [other(k) for k in ("menu", "header", "notice", "ad", "sidebar") if rng.random() < 0.5]
    after = [other(k) for k in ("comments", "sidebar", "ad", "notice", "footer") if rng.random() < 0.45]
    if rng.random() < 0.3:
        rng.choice([before, after]).append(form())
    if rng.random() < 0.15:
        rng.choice([before, after]).append(without_scripts())
    rng.shuffle(before)
    end = rng.choice(["</body></html>", ""])
    return f"<html><head><title>{main[0][:60]}</title></head><body>{''.join(before)}{''.join(whole)}{''.join(after)}{end}"


def examples(sampled: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sampled pages with labels by element, and their texts in other layouts."""
    rng = random.Random(SEED)
    made, mains, others = [], [], [WORDS]
    for page in sampled:
        found = blocks(page)
        labels = np.array([by_elements(b) for b in found])
        if not len(found):
            continue
        if labels.any():
            made.append((features(found), labels))
            mains.append([b.text for b, y in zip(found, labels, strict=True) if y][:30])
        others.extend(b.text for b in found)
    mains = mains or [[WORDS + "."]]
    for _ in range(LAYOUTS):
        texts = rng.choice(mains)
        found = blocks(layout(rng, [t for t in rng.sample(texts, min(len(texts), rng.randint(1, 12)))], others))
        labels = np.array([float(MARK in b.text) for b in found])
        for b in found:
            b.text = b.text.replace(MARK, "") or "text"
        made.append((features(found), labels))
    return made


def fit(pages: DataFrame) -> Network:
    """Train on a bounded sample of pages (``page_id, html``); other layouts of their texts make up the rest."""
    batch_limit(pages.sparkSession)
    short = pages.where(F.length("html") <= SAMPLE_CHARS).select("page_id", "html")
    rows = least_hashes(short, ["page_id"], SAMPLE_PAGES, pages.count()).collect()
    return train(examples([r.html for r in rows]))


def extract(df: DataFrame, net: Network, page: str = "html", text: str = "text") -> DataFrame:
    """Add the main text of every whole page, blocks in page order joined by one space, and ``n_chars``.

    Null and empty pages, and those without a block of main text, give an empty text. Repeated rows stay;
    columns of the same names are replaced.
    """

    def make(pages: list[str | None]) -> list[list]:
        found = [blocks(p) for p in pages]
        chances = net.label_blocks(found)
        texts = [" ".join(b.text for b, p in zip(f, c, strict=True) if p >= 0.5) for f, c in zip(found, chances, strict=True)]
        return [texts, list(map(len, texts))]

    return with_columns(df, page, [T.StructField(text, T.StringType()), T.StructField("n_chars", T.LongType())], make)
