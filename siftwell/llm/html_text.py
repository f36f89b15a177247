"""HTML main-text extraction: a bidirectional LSTM labels every block of a page by its tag path and words."""

from __future__ import annotations

import html as html_lib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import hash_spans, runs, table

_NAME = re.compile(r"/?[a-zA-Z][a-zA-Z0-9-]*")
_STOP = re.compile("[>\"']")
_NAMES = re.compile(r"""\b(?:class|id|role|hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]{2,}")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var br wbr img".split())
SKIP = frozenset("script style noscript template svg iframe textarea select title head".split())
#: Elements whose content is no markup of the page: all up to their end tag is passed over.
RAW = frozenset("script style noscript template svg iframe textarea select title".split())
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s>/])[^>]*>", re.IGNORECASE) for tag in RAW}
#: Elements that are nested deeper lie flat at this depth.
DEEPEST = 200
#: Open tags that a new one of the same kind ends.
CLOSES = {"p": ("p",), "li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "option": ("option",)}
BOX = frozenset("body html article main section div nav aside header footer table ul ol dl form blockquote".split())


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # tags, and words of their class, id and role, from the outermost
    linked: int  # characters inside links


def markup(page: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, name, attributes) of a page's tags in order; names are lower-case and begin with / for end tags, and
    are empty for comments, declarations and elements that are passed over whole.

    Quoted attribute values may hold >. No position is looked at more than a few times, however the page is broken:
    what is found missing once (an end tag, a quote, a >) is not searched for again.
    """
    at, size = 0, len(page)
    missing: set[str] = set()  # raw elements without a further end tag
    dead: set[int] = set()  # quotes from which on no > follows outside quotes

    def tag_end(start: int) -> int:
        """Where the tag ends that goes on at start; at the next > if its quotes never close; -1 without any."""
        i, passed = start, []
        while (m := _STOP.search(page, i)) and m.start() not in dead:
            if m[0] == ">":
                return m.end()
            passed.append(m.start())
            close = page.find(m[0], m.end())
            if close < 0:
                break
            i = close + 1
        dead.update(passed)
        return page.find(">", start) + 1 or -1

    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = size if end < 0 else end + 3
            yield at, end, "", ""
        elif page.startswith(("<!", "<?"), at):
            end = page.find(">", at) + 1
            if not end:
                return
            yield at, end, "", ""
        elif m := _NAME.match(page, at + 1):
            end = tag_end(m.end())
            if end < 0:
                return
            name = m[0].lower()
            if name in RAW and name not in missing:
                if closing := _RAW_END[name].search(page, end):
                    end, name = closing.end(), ""
                else:
                    missing.add(name)
            if name in missing and name not in ("script", "style"):
                name = ""  # without an end tag only code is passed over
            yield at, end, name, page[m.end() : end - 1] if name else ""
        else:
            end = at + 1
        at = end


def blocks(page: str) -> list[Block]:
    """A page's blocks: texts between tags that are not inline, with references decoded and white space made single."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    open_: Counter[str] = Counter()
    parts: list[str] = []
    linked = skipped = 0
    at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, tuple(w for tag, names in stack for w in (tag, *names)), linked))
            parts.clear()
        linked = 0

    def text_to(end: int) -> None:
        nonlocal linked
        if end > at and not skipped:
            parts.append(page[at:end])
            if open_["a"]:
                linked += end - at

    def pop(k: int) -> None:
        nonlocal skipped
        for tag, _ in stack[k:]:
            skipped -= tag in SKIP
            open_[tag] -= 1
        del stack[k:]

    for start, end, name, attributes in markup(page):
        text_to(start)
        at = end
        tag = name.lstrip("/")
        if not tag:
            continue
        if tag in VOID:
            if tag in INLINE:
                parts.append(" ")
            else:
                flush()
            continue
        if tag not in INLINE:
            flush()
        if name != tag:
            for k in range(len(stack) - 1, -1, -1) if open_[tag] else ():
                if stack[k][0] == tag:
                    pop(k)
                    break
                if tag in INLINE and stack[k][0] not in INLINE:
                    break
            continue
        if tag == "body" and open_["head"]:  # ends an open head
            pop(next(k for k, (t, _) in enumerate(stack) if t == "head"))
        if tag not in INLINE:
            ends = CLOSES.get(tag, ("p",))
            for k in range(len(stack) - 1, -1, -1) if any(open_[t] for t in ends) else ():
                if stack[k][0] in ends:
                    pop(k)
                    break
                if stack[k][0] in BOX:
                    break
        names = ()
        if "=" in attributes:
            names = tuple(f".{w}" for a in _NAMES.findall(attributes) for w in _WORDS.findall("".join(a).lower()))
        if not attributes.endswith("/") and len(stack) < DEEPEST:
            stack.append((tag, names))
            skipped += tag in SKIP
            open_[tag] += 1
    text_to(len(page))
    flush()
    return out


PATHS, WORDS, NUMBERS = 1024, 1024, 8
PATH_DIM, WORD_DIM, HIDDEN = 16, 8, 16
INPUT = PATH_DIM + WORD_DIM + NUMBERS


@lru_cache(maxsize=100_000)
def _path_ids(path: tuple[str, ...]) -> tuple[int, ...]:
    """Hashed parts of a tag path: each tag or name, and the innermost tags with how deep they are."""
    tags = [w for w in path if w[0] != "."]
    parts = [*path, *[f"{k}{t}" for k, t in enumerate(tags[:-4:-1])]]
    return tuple(zlib.crc32(p.encode()) % PATHS for p in parts)


@dataclass
class Features:
    paths: np.ndarray  # hashed path parts of all blocks
    path_at: np.ndarray
    words: np.ndarray  # hashed words of all blocks
    word_at: np.ndarray
    numbers: np.ndarray
    sizes: np.ndarray  # blocks of each page


_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = _LETTER[48:58] = _LETTER[128:] = True


def features(pages: list[list[Block]]) -> Features:
    flat = [b for p in pages for b in p]
    ids = [_path_ids(b.path) for b in flat]
    texts = [b.text.encode("utf-8", "replace") for b in flat]
    data = np.frombuffer((b" ".join(texts) + b" ").lower(), dtype=np.uint8)
    at = np.cumsum([0, *[len(x) + 1 for x in texts]])
    starts, ends = runs(_LETTER[data])
    words = (hash_spans(data, starts, ends) >> np.uint64(54)).astype(np.int64) % WORDS if len(starts) else np.zeros(0, np.int64)
    word_at = np.searchsorted(starts, at)
    count = np.diff(word_at)
    chars = np.array([len(b.text) for b in flat], dtype=float)
    sizes = np.array([len(p) for p in pages])
    order = np.concatenate([np.arange(n) for n in sizes]) if flat else np.zeros(0)
    total = np.repeat(sizes, sizes)
    marks = np.array([b.text.count(".") + b.text.count(",") + b.text.count("!") + b.text.count("?") for b in flat], dtype=float)
    numbers = np.column_stack([
        np.log1p(chars) / 8, np.log1p(count) / 6, np.array([b.linked for b in flat], dtype=float) / np.maximum(chars, 1), np.minimum(marks / np.maximum(count, 1), 2),
        order / np.maximum(total, 1), np.minimum(total, 100) / 100, np.array([len(i) for i in ids], dtype=float) / 20, np.ones(len(flat)),
    ]) if flat else np.zeros((0, NUMBERS))
    return Features(np.array([x for i in ids for x in i], dtype=np.int64), np.cumsum([0, *map(len, ids)]), words, word_at, numbers, sizes)


def _means(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.add.reduceat(np.concatenate([rows, np.zeros((1, rows.shape[1]))]), np.minimum(at[:-1], len(rows)), axis=0) if len(at) > 1 else np.zeros((0, rows.shape[1]))
    n = np.diff(at)
    total[n == 0] = 0
    return total / np.maximum(n, 1)[:, None]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class BlockLabeller:
    """The recurrent network: embeddings of path parts and words, an LSTM each way, a logistic output."""

    def __init__(self, seed: int = 3):
        draw = np.random.default_rng(seed)
        self.p = {
            "path": draw.normal(0, 0.3, (PATHS, PATH_DIM)), "word": draw.normal(0, 0.1, (WORDS, WORD_DIM)),
            **{f"{k}{d}": draw.normal(0, 0.2, (n, 4 * HIDDEN)) for d in "fb" for k, n in (("x", INPUT), ("h", HIDDEN))},
            **{f"o{d}": draw.normal(0, 0.2, HIDDEN) for d in "fb"}, "ox": draw.normal(0, 0.1, INPUT), "bias": np.zeros(1),
        }

    def inputs(self, f: Features) -> np.ndarray:
        return np.column_stack([_means(self.p["path"][f.paths], f.path_at), _means(self.p["word"][f.words], f.word_at), f.numbers])

    def _run(self, x: np.ndarray, on: np.ndarray, d: str, keep: bool):
        """x: steps x pages x INPUT, on: steps x pages; a page that has ended keeps its state."""
        steps, n, _ = x.shape
        h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        hs, saved = np.zeros((steps, n, HIDDEN)), []
        order = range(steps) if d == "f" else range(steps - 1, -1, -1)
        xw = x @ self.p[f"x{d}"]
        for t in order:
            z = xw[t] + h @ self.p[f"h{d}"]
            i, fo, o = _sigmoid(z[:, :HIDDEN]), _sigmoid(z[:, HIDDEN : 2 * HIDDEN] + 1), _sigmoid(z[:, 2 * HIDDEN : 3 * HIDDEN])
            g = np.tanh(z[:, 3 * HIDDEN :])
            live = on[t][:, None]
            c2 = np.where(live, fo * c + i * g, c)
            tc = np.tanh(c2)
            h2 = np.where(live, o * tc, h)
            if keep:
                saved.append((t, i, fo, o, g, c, h, tc))
            h, c = h2, c2
            hs[t] = h
        return hs, saved

    def _padded(self, x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        steps, first = int(sizes.max()), np.cumsum(sizes) - sizes
        index = first[None, :] + np.arange(steps)[:, None]
        on = np.arange(steps)[:, None] < sizes[None, :]
        index = np.where(on, index, 0)
        return x[index], on, index

    def scores(self, f: Features) -> np.ndarray:
        """The logit of each block; pages of like length are run together."""
        x, out = self.inputs(f), np.zeros(len(f.numbers))
        first = np.cumsum(f.sizes) - f.sizes
        order = np.argsort(f.sizes, kind="stable")
        order = order[f.sizes[order] > 0]
        s = 0
        while s < len(order):
            e = s + 1
            while e < len(order) and (e + 1 - s) * f.sizes[order[e]] <= 20_000 and f.sizes[order[e]] <= 1.5 * f.sizes[order[s]] + 4:
                e += 1
            part, sizes = order[s:e], f.sizes[order[s:e]]
            steps = int(sizes.max())
            on = np.arange(steps)[:, None] < sizes[None, :]
            index = np.where(on, first[part][None, :] + np.arange(steps)[:, None], 0)
            xs = x[index]
            y = self._run(xs, on, "f", False)[0] @ self.p["of"] + self._run(xs, on, "b", False)[0] @ self.p["ob"] + xs @ self.p["ox"] + self.p["bias"]
            out[index[on]] = y[on]
            s = e
        return out

    def gradients(self, f: Features, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        x = self.inputs(f)
        xs, on, index = self._padded(x, f.sizes)
        runs_ = {d: self._run(xs, on, d, True) for d in "fb"}
        y = sum(runs_[d][0] @ self.p[f"o{d}"] for d in "fb") + xs @ self.p["ox"] + self.p["bias"]
        p, t = _sigmoid(y), target[index]
        n = on.sum()
        dy = np.where(on, p - t, 0) / n
        loss = -np.where(on, t * np.log(p + 1e-12) + (1 - t) * np.log(1 - p + 1e-12), 0).sum() / n
        g = {"bias": np.array([dy.sum()]), "ox": np.tensordot(dy, xs, 2)}
        dx = dy[:, :, None] * self.p["ox"]
        for d in "fb":
            hs, saved = runs_[d]
            g[f"o{d}"] = np.tensordot(dy, hs, 2)
            dh, dc = np.zeros_like(hs[0]), np.zeros_like(hs[0])
            gx, gh = np.zeros_like(self.p[f"x{d}"]), np.zeros_like(self.p[f"h{d}"])
            for t_, i, fo, o, gg, c, h, tc in reversed(saved):
                live = on[t_][:, None]
                dh = dh + dy[t_][:, None] * self.p[f"o{d}"]
                dc2 = np.where(live, dc + dh * o * (1 - tc * tc), dc)
                dz = np.where(live, np.concatenate([dc2 * gg * i * (1 - i), dc2 * c * fo * (1 - fo), dh * tc * o * (1 - o), dc2 * i * (1 - gg * gg)], axis=1), 0)
                gx += xs[t_].T @ dz
                gh += h.T @ dz
                dx[t_] += dz @ self.p[f"x{d}"].T
                dh = np.where(live, dz @ self.p[f"h{d}"].T, dh)
                dc = np.where(live, dc2 * fo, dc)
            g[f"x{d}"], g[f"h{d}"] = gx, gh
        flat = np.zeros((len(x), INPUT))
        flat[index[on]] = dx[on]
        for name, ids, at, a, b in (("path", f.paths, f.path_at, 0, PATH_DIM), ("word", f.words, f.word_at, PATH_DIM, PATH_DIM + WORD_DIM)):
            count = np.diff(at)
            each = np.repeat(flat[:, a:b] / np.maximum(count, 1)[:, None], count, axis=0)
            g[name] = np.zeros_like(self.p[name])
            np.add.at(g[name], ids[at[0] : at[-1]], each)
        return float(loss), g

    def main_text(self, pages: list[str]) -> list[str]:
        """Each page's main text."""
        found = [blocks(p) for p in pages]
        score = self.scores(features(found))
        out, at = [], 0
        for p in found:
            out.append("\n".join(b.text for b, s in zip(p, score[at : at + len(p)].tolist(), strict=True) if s > 0))
            at += len(p)
        return out


# Made-up pages to train on: words of what surrounds articles, and names that sites give their parts.
_CHROME = "home menu login register search contact about privacy terms cookies share follow subscribe newsletter advertisement sponsored related popular tags categories previous next archive sitemap copyright rights reserved accept settings help shop account impressum accueil inicio startseite".split()
_CONTENT_BOX = (("article", ""), ("main", ""), ("div", "content"), ("div", "post entry"), ("div", "story body"), ("section", "article text"), ("div", "main"), ("article", "post"))
_NOISE_BOX = (
    ("nav", ""), ("nav", "menu main"), ("header", ""), ("header", "site top"), ("footer", ""), ("footer", "site bottom"), ("aside", ""), ("aside", "sidebar"), ("div", "ad"), ("div", "ads banner"), ("div", "advert"), ("div", "sponsored promo"),
    ("div", "cookie notice"), ("div", "notice banner"), ("div", "sidebar"), ("div", "menu nav"), ("ul", "breadcrumb"), ("div", "related posts"), ("div", "share social"), ("form", ""), ("form", "search"), ("form", "newsletter"),
    ("section", "comments"), ("div", "comments comment"), ("ol", "comment list"), ("div", "footer"), ("div", "header"), ("div", "popup modal"), ("section", "widget"), ("div", "alert"),
)


def made_page(draw: np.random.Generator) -> tuple[str, list[str]]:
    """(html, the article's blocks) of a page with parts around and sometimes inside its article."""
    syllables = ["".join(x) for x in zip(*[draw.choice(list("abcdefghijklmnopqrstuvwxyzéüñ"), 40) for _ in range(int(draw.integers(2, 4)))], strict=True)]
    pick = lambda xs: xs[draw.integers(len(xs))]
    serial = iter(range(10**6))

    def words(n: int, chrome: float = 0.0) -> str:
        shout, stop = draw.random() < 0.05, "." if draw.random() < 0.4 else ""
        out = [pick(_CHROME) if draw.random() < chrome else "".join(pick(syllables) for _ in range(draw.integers(1, 4))) for _ in range(n)]
        for k in range(7, n, int(draw.integers(6, 14))):
            out[k] += pick([",", ".", "."])
        text = " ".join(out).capitalize()
        return text.upper() + "!!" if shout else text + stop

    def box(kind: tuple[str, str], inner: str) -> str:
        tag, names = kind
        attribute = f' {pick(["class", "id", "class"])}="{names}"' if names else ""
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def noise(kind: tuple[str, str]) -> str:
        text = lambda: words(int(draw.integers(1, 5)), 0.4)
        what = draw.random()
        if kind[0] == "nav" or what < 0.3:
            inner = "<ul>" + "".join(f'<li><a href="/{next(serial)}">{text()}</a></li>' for _ in range(draw.integers(2, 9))) + "</ul>"
        elif what < 0.6:
            inner = words(int(draw.integers(3, 30)), 0.2) + ("." if draw.random() < 0.5 else "")
            inner = f"&copy; {inner}" if kind[0] == "footer" and draw.random() < 0.6 else inner
        elif what < 0.85:
            inner = "".join(f"<p>{words(int(draw.integers(3, 40)), 0.1)}.</p>" for _ in range(draw.integers(1, 5)))
        else:
            inner = f"<h3>{text()}</h3><div>{text()}</div>" + "".join(f"<p>{words(int(draw.integers(4, 25)))}</p>" for _ in range(draw.integers(0, 4)))
        if kind[0] == "form":
            inner = f"<label>{text()}</label><input name=q><button>{text()}</button>" + (f"<p>{words(8, 0.3)}</p>" if draw.random() < 0.5 else "")
        return box(kind, inner)

    truth: list[str] = []

    def content() -> str:
        out = []
        for k in range(draw.integers(1, 12)):
            kind = "h1" if k == 0 and draw.random() < 0.8 else pick(["p"] * 8 + ["h2", "li", "blockquote", "pre", "td"])
            text = words(int(draw.integers(1, 4) if draw.random() < 0.25 else draw.integers(2, 12) if kind in ("h1", "h2", "li", "td") else draw.integers(3, 90)))
            truth.append(text)
            mark = draw.random()
            body = f"<b>{text}" + ("</b>" if mark < 0.1 else "<br>") if mark < 0.2 else text.replace(" ", " <em></em>", 1) if mark < 0.3 else text
            end = "" if kind == "p" and draw.random() < 0.2 else f"</{kind}>"
            out.append({"li": f"<ul><li>{body}</li></ul>", "td": f"<table><tr><td>{body}</td></tr></table>"}.get(kind, f"<{kind}>{body}{end}"))
            if draw.random() < 0.05:
                out.append(noise(pick([k for k in _NOISE_BOX if k[1]])))
        return "".join(out)

    title = words(5)
    plain = draw.random()
    if plain < 0.12:  # nothing but an article, with as little around it as can be
        if draw.random() < 0.3:
            text = words(int(draw.integers(1, 60)))
            truth.append(text)
            inner = text
        elif draw.random() < 0.5:
            text = words(int(draw.choice([1, 1, 2, 4, 9, 18, 30, 80])))
            truth.append(text)
            inner = f"<p>{text}</p>"
        else:
            inner = content()
        return pick([inner, f"<body>{inner}</body>", f"<html><body>{inner}</body></html>", f"<html><head><title>{title}</title></head><body><div>{inner}</div></body></html>"]), truth
    parts = [noise(pick(_NOISE_BOX)) for _ in range(draw.integers(0, 4))]
    inner = content()
    wrapped = inner if plain < 0.25 else box(pick(_CONTENT_BOX), inner)
    if draw.random() < 0.3:
        wrapped = box(("div", pick(["", "wrapper", "container", "page"])), wrapped)
    parts.append(wrapped)
    parts += [noise(pick(_NOISE_BOX)) for _ in range(draw.integers(0, 4))]
    page = f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body>{''.join(parts)}</body></html>"
    return page, truth


@lru_cache(maxsize=2)
def trained(pages: int = 1500, epochs: int = 6, seed: int = 11) -> BlockLabeller:
    """A labeller fitted by Adam to made-up pages; the same arguments give the same weights."""
    draw, model = np.random.default_rng(seed), BlockLabeller()
    data = []
    for _ in range(pages):
        page, truth = made_page(draw)
        found, left = blocks(page), list(truth)
        marks = []
        for b in found:
            hit = bool(left) and b.text == " ".join(left[0].split())
            marks.append(hit)
            if hit:
                left.pop(0)
        if found:
            data.append((found, marks))
    data.sort(key=lambda x: len(x[0]))
    groups = [data[i : i + 30] for i in range(0, len(data), 30)]
    ready = [(features([f for f, _ in g]), np.array([m for _, ms in g for m in ms], dtype=float)) for g in groups]
    first, second, step = {k: np.zeros_like(v) for k, v in model.p.items()}, {k: np.zeros_like(v) for k, v in model.p.items()}, 0
    for epoch in range(epochs):
        for i in draw.permutation(len(ready)):
            _, g = model.gradients(*ready[i])
            step += 1
            for k, v in g.items():
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.999 * second[k] + 0.001 * v * v
                model.p[k] -= 0.02 * 0.6**epoch * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def extracted(pages: DataFrame, model: BlockLabeller, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns keep and text of every row: the article's blocks, joined by a line feed.

    A null or empty page, and one without a block of an article, has an empty text. Pages are read
    whole, unclosed and stray tags included. Rows with equal or null keys are extracted like any other;
    columns other than keep are ignored.
    """
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            pages = [x or "" for x in batch.column(batch.num_columns - 1).to_pylist()]
            texts, s, size = [], 0, 0
            for i, p in enumerate(pages):
                size += len(p)
                if size > 1 << 20 or i == len(pages) - 1:
                    texts += model.main_text(pages[s : i + 1])
                    s, size = i + 1, 0
            yield pa.record_batch([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*keep, "text"])

    rows = pages.select(*keep, F.col(html_col).cast("string").alias("html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{schema}, text string")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extracted(table(spark, sf_dir, "pages"), trained())
    return out.withColumn("n_chars", F.length("text").cast("long"))
