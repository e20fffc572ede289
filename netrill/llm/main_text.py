"""Main text of HTML pages by a recurrent block labeller.

A page is cut into leaf blocks (`html_blocks`). Each block is a vector of its tag path
(element, class and id names, hashed), its different words (hashed, by share) and a few measures;
a bidirectional LSTM reads the page's whole sequence of blocks and decides for every block,
with all blocks before and after it as context, whether it belongs to the article. The
article's blocks are joined by line feeds; nothing is capped.

The labeller is trained in numpy, once a run, on the driver, at a fixed cost: on PAGES
made-up pages with known main text (`html_samples`) and on at most OWN_PAGES pages of the
table, of at most OWN_CHARS characters, that say themselves what their article is (an
`article` or `main` element; menus, forms and the like within it don't count). Pages are
labelled in Arrow batches on the executors; features of long pages are made in parts.

A null or empty html, or a page without an article, gives an empty text. Repeated rows are
kept as they are. Only page_id, url and html are read, so further columns can't clash.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netrill.llm.common import table
from netrill.llm.html_blocks import Block, blocks_of
from netrill.llm.html_samples import NAMED, Maker

#: Pages of the table to train on at most, and their longest.
OWN_PAGES, OWN_CHARS = 300, 20_000
SECTIONS = frozenset({"article", "main"})
OTHERS = frozenset("nav aside footer header form button label menu".split()) | {
    "." + name for kind, names in NAMED.items() if kind not in ("article", "header") for name in names.split()
}
#: Made-up pages to train on, passes over all, pages of a training step.
PAGES, PASSES, STEP = 900, 12, 20
SEED = 7
PATHS, WORDS, MEASURES = 1024, 512, 8
WIDTH = PATHS + WORDS + MEASURES
#: Width of a block's embedding, cells of each direction.
INNER, CELLS = 32, 24
#: Blocks whose features are held at a time; blocks of pages read side by side.
PART, TOGETHER = 1024, 8192
#: Words whose hashes a worker remembers.
REMEMBERED = 1 << 18
RATE = 4e-3

_HASHES: dict[str, int] = {}


def _hash(word: str, size: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % size


def _word(word: str) -> int:
    found = _HASHES.get(word)
    if found is None:
        if len(_HASHES) >= REMEMBERED:
            _HASHES.clear()
        found = _HASHES[word] = PATHS + _hash("w" + word.lower(), WORDS)
    return found


def entries(blocks: Sequence[Block]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and value of what isn't 0 in the blocks' vectors; a place may come up again."""
    rows, places, values = [], [], []
    for number, block in enumerate(blocks):
        path = {_hash("cl" + name, PATHS) for name in block.path[-24:]}
        words = {_word(w) for w in set(block.words)}
        chars = len(block.text)
        measures = (
            min(1.0, block.linked / chars),
            math.log1p(chars) / 6,
            math.log1p(len(block.words)) / 4,
            block.text[-1] in ".!?…\"'",
            min(1.0, 10 * sum(map(block.text.count, ".,;")) / chars),
            len(block.words) < 4,
            len(block.path) / 8,
            1.0,
        )
        places += path
        places += words
        places += range(PATHS + WORDS, WIDTH)
        values += [1.0] * len(path)
        values += [1.5 / max(3, len(words))] * len(words)
        values += measures
        rows += [number] * (len(path) + len(words) + MEASURES)
    return np.array(rows, np.int32), np.array(places, np.int16), np.array(values, np.float32)


def dense(found: tuple[np.ndarray, np.ndarray, np.ndarray], size: int) -> np.ndarray:
    rows, places, values = found
    flat = np.bincount(rows.astype(np.int64) * WIDTH + places, values, size * WIDTH)
    return flat.reshape(size, WIDTH)


def features(blocks: Sequence[Block]) -> np.ndarray:
    """A row of WIDTH values for each block."""
    return dense(entries(blocks), len(blocks))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Direction:
    """One direction of the LSTM over (step, page, value) arrays; masked steps keep the state."""

    def __init__(self, weights: dict[str, np.ndarray], name: str) -> None:
        self.w, self.u, self.b = (weights[f"{name}_{part}"] for part in ("w", "u", "b"))

    def forward(self, x: np.ndarray, mask: np.ndarray, order: Sequence[int]) -> tuple[np.ndarray, dict]:
        steps, pages = x.shape[:2]
        h, c = np.zeros((pages, CELLS)), np.zeros((pages, CELLS))
        out, kept = np.zeros((steps, pages, CELLS)), {}
        fed = x @ self.w + self.b
        for t in order:
            gates = fed[t] + h @ self.u
            i, f, o = (_sigmoid(gates[:, k * CELLS : (k + 1) * CELLS]) for k in range(3))
            g = np.tanh(gates[:, 3 * CELLS :])
            m = mask[t][:, None]
            fresh = f * c + i * g
            tanh = np.tanh(fresh)
            kept[t] = (h, c, i, f, o, g, tanh, m)
            c = m * fresh + (1 - m) * c
            h = m * o * tanh + (1 - m) * h
            out[t] = h
        return out, kept

    def run(self, x: np.ndarray, mask: np.ndarray, order: Sequence[int]) -> np.ndarray:
        """As forward, without what training needs."""
        steps, pages = x.shape[:2]
        h, c = np.zeros((pages, CELLS)), np.zeros((pages, CELLS))
        out = np.zeros((steps, pages, CELLS))
        for t in order:
            gates = x[t] @ self.w + self.b + h @ self.u
            ifo = _sigmoid(gates[:, : 3 * CELLS])
            m = mask[t][:, None]
            fresh = ifo[:, CELLS : 2 * CELLS] * c + ifo[:, :CELLS] * np.tanh(gates[:, 3 * CELLS :])
            h = np.where(m, ifo[:, 2 * CELLS :] * np.tanh(fresh), h)
            c = np.where(m, fresh, c)
            out[t] = h
        return out

    def backward(self, x, order, kept, d_out) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        d_x = np.zeros_like(x)
        d_w, d_u, d_b = np.zeros_like(self.w), np.zeros_like(self.u), np.zeros_like(self.b)
        d_h = np.zeros(d_out.shape[1:])
        d_c = np.zeros_like(d_h)
        for t in reversed(order):
            h, c, i, f, o, g, tanh, m = kept[t]
            d_h = d_h + d_out[t]
            d_fresh = m * (d_c + d_h * o * (1 - tanh**2))
            gates = np.concatenate(
                [
                    d_fresh * g * i * (1 - i),
                    d_fresh * c * f * (1 - f),
                    m * d_h * tanh * o * (1 - o),
                    d_fresh * i * (1 - g**2),
                ],
                axis=1,
            )
            d_w += x[t].T @ gates
            d_u += h.T @ gates
            d_b += gates.sum(axis=0)
            d_x[t] = gates @ self.w.T
            d_c = d_fresh * f + (1 - m) * d_c
            d_h = gates @ self.u.T + (1 - m) * d_h
        return d_x, {"w": d_w, "u": d_u, "b": d_b}


class Labeller:
    """Embedding, two directions, one output; `weights` is all there is to it."""

    def __init__(self, weights: dict[str, np.ndarray]) -> None:
        self.weights = weights
        self.there, self.back = Direction(weights, "there"), Direction(weights, "back")

    @staticmethod
    def fresh(seed: int) -> Labeller:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        weights = {"embed": rng.normal(0, 0.15, (WIDTH, INNER)), "out": draw(2 * CELLS), "bias": np.zeros(1)}
        for name in ("there", "back"):
            weights |= {f"{name}_w": draw(INNER, 4 * CELLS), f"{name}_u": draw(CELLS, 4 * CELLS)}
            weights[f"{name}_b"] = np.concatenate([np.zeros(CELLS), np.ones(CELLS), np.zeros(2 * CELLS)])
        return Labeller(weights)

    def embedded(self, blocks: Sequence[Block]) -> np.ndarray:
        parts = [features(blocks[i : i + PART]) @ self.weights["embed"] for i in range(0, len(blocks), PART)]
        return np.tanh(np.concatenate(parts)) if parts else np.zeros((0, INNER))

    def labels(self, pages: Sequence[np.ndarray]) -> list[np.ndarray]:
        """For each page's embedded blocks the probability of being main text."""
        found: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        group: list[int] = []
        for place, i in enumerate(order):
            group.append(i)
            after = len(pages[order[place + 1]]) if place + 1 < len(order) else 0
            if not after or (len(group) + 1) * after > TOGETHER:
                x, mask = side_by_side([pages[j] for j in group])
                steps = range(len(x))
                held = mask > 0
                hidden = np.concatenate(
                    [self.there.run(x, held, steps), self.back.run(x, held, steps[::-1])], axis=2
                )
                chance = _sigmoid(hidden @ self.weights["out"] + self.weights["bias"])
                for column, j in enumerate(group):
                    found[j] = chance[: len(pages[j]), column]
                group = []
        return found


def side_by_side(pages: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x = np.zeros((steps, len(pages), pages[0].shape[1]))
    mask = np.zeros((steps, len(pages)))
    for number, page in enumerate(pages):
        x[: len(page), number] = page
        mask[: len(page), number] = 1
    return x, mask


def gradients(model: Labeller, pages: Sequence[np.ndarray], wanted: Sequence[np.ndarray]):
    """Loss and its derivatives for the features and labels of some pages."""
    weights = model.weights
    raw, mask = side_by_side(pages)
    goal, _ = side_by_side([y[:, None] for y in wanted])
    x = np.tanh(raw @ weights["embed"])
    there, back = range(len(x)), range(len(x))[::-1]
    one, kept_one = model.there.forward(x, mask, there)
    two, kept_two = model.back.forward(x, mask, back)
    hidden = np.concatenate([one, two], axis=2)
    chance = _sigmoid(hidden @ weights["out"] + weights["bias"])
    size = mask.sum()
    clipped = np.clip(np.where(goal[..., 0] > 0, chance, 1 - chance), 1e-12, 1)
    loss = -(np.log(clipped) * mask).sum() / size
    d_score = (chance - goal[..., 0]) * mask / size
    d_hidden = d_score[..., None] * weights["out"]
    found = {"out": np.einsum("tp,tpc->c", d_score, hidden), "bias": np.array([d_score.sum()])}
    d_one, of_one = model.there.backward(x, there, kept_one, d_hidden[..., :CELLS])
    d_two, of_two = model.back.backward(x, back, kept_two, d_hidden[..., CELLS:])
    found |= {f"there_{k}": v for k, v in of_one.items()} | {f"back_{k}": v for k, v in of_two.items()}
    d_x = (d_one + d_two) * (1 - x**2)
    found["embed"] = np.tensordot(raw, d_x, axes=([0, 1], [0, 1]))
    return loss, found


#: Marks main text in made-up pages; taken off again.
MARK = "\ue000"


def sample(seed: int, size: int) -> list[tuple[list[Block], np.ndarray]]:
    """Blocks and labels of made-up pages."""
    maker, made = Maker(seed), []
    for _ in range(size):
        pieces = maker.page()
        blocks = blocks_of("".join(_marked(piece) if main else piece for piece, main in pieces))
        labels = []
        for block in blocks:
            labels.append(float(MARK in block.text))
            block.text = block.text.replace(MARK, "").strip()
            block.words = block.text.split()
        kept = [n for n, block in enumerate(blocks) if block.words]
        made.append(([blocks[n] for n in kept], np.array([labels[n] for n in kept])))
    return made


def own_labels(page: str) -> tuple[list[Block], np.ndarray] | None:
    """Blocks of a page by its own sectioning elements; None if it has no article or none apart from it."""
    blocks = blocks_of(page)
    inside = [not SECTIONS.isdisjoint(block.path) for block in blocks]
    labels = np.array([float(i and OTHERS.isdisjoint(b.path)) for i, b in zip(inside, blocks, strict=True)])
    return (blocks, labels) if labels.any() and not labels.all() else None


def own_sample(pages: DataFrame) -> list[tuple[list[Block], np.ndarray]]:
    """At most OWN_PAGES pages, the same ones for the same table."""
    short = pages.where(F.length("html") <= OWN_CHARS).select("html").distinct()
    rows = short.orderBy(F.xxhash64("html"), "html").limit(OWN_PAGES).toLocalIterator()
    found = (own_labels(row["html"]) for row in rows)
    return [page for page in found if page]


def _marked(piece: str) -> str:
    """The piece with the mark after each start tag."""
    return re.sub(r"(<[a-z][^>]*>)", rf"\1{MARK}", piece)


def train(own: Sequence = (), seed: int = SEED, pages: int = PAGES, passes: int = PASSES) -> Labeller:
    """The labeller, by Adam over pages of similar lengths at a time; `own` are more (blocks, labels)."""
    rng = np.random.default_rng(seed)
    made = [(entries(blocks), labels) for blocks, labels in [*sample(seed, pages), *own]]
    made.sort(key=lambda page: len(page[1]))
    model = Labeller.fresh(seed)
    mean = {k: np.zeros_like(v) for k, v in model.weights.items()}
    square = {k: np.zeros_like(v) for k, v in model.weights.items()}
    steps, total = 0, passes * -(-len(made) // STEP)
    for _ in range(passes):
        starts = np.arange(0, len(made), STEP)
        rng.shuffle(starts)
        for start in starts:
            part = made[start : start + STEP]
            _, slopes = gradients(model, [dense(x, len(y)) for x, y in part], [y for _, y in part])
            scale = min(1.0, 1 / np.sqrt(sum((slope**2).sum() for slope in slopes.values())))
            steps += 1
            rate = RATE * (1 - steps / (total + 1))
            for name, slope in slopes.items():
                slope *= scale
                mean[name] += 0.1 * (slope - mean[name])
                square[name] += 0.005 * (slope**2 - square[name])
                change = mean[name] / (1 - 0.9**steps) / (np.sqrt(square[name] / (1 - 0.995**steps)) + 1e-8)
                model.weights[name] -= rate * change
    return model


def _labelling(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Labeller(shared.value)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                pages = [blocks_of(page.as_py()) for page in part.column("html")]
                labels = model.labels([model.embedded(blocks) for blocks in pages])
                texts = [
                    "\n".join(block.text for block, chance in zip(blocks, found, strict=True) if chance >= 0.5)
                    for blocks, found in zip(pages, labels, strict=True)
                ]
                columns = [
                    part.column("page_id"),
                    part.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return run


def extracted(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast((model or train(own_sample(pages))).weights)
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return slim.mapInArrow(_labelling(shared), "page_id bigint, url string, text string, n_chars bigint")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return extracted(table(spark, folder, "pages"))
