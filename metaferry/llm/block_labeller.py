"""Main text of web pages: a bidirectional LSTM over the blocks of a page, in numpy.

A page is a sequence of blocks. A block's vector holds hashed names of the
elements above it (with words of class, id and role), hashed words of its text,
and a few lengths. One LSTM reads the sequence forwards, one backwards, and a
logistic unit decides on each block from both, so what stands anywhere on the
page can count. Blocks that are kept are joined by empty lines.

The labeller is trained in the job, on a bounded sample: the ``SAMPLE_PAGES``
pages of at most ``PAGE_CHARS`` characters that come first in the order of a
hash. No page is labelled, so labels come from the meaning of elements
(``REST``, ``MAIN``), and every sampled page is also rearranged several times
into other layouts, in which the place of the main text is known. Only the
sample passes the driver; the weights, some 100 kB, go to all tasks. Every whole
page is then read in a task of its partition, and nothing is shuffled.

Defined results: a null or empty page has an empty text. A page whose blocks are
all left out has an empty text. Rows are independent; repeated ids give repeated
rows; other columns may have any name. Without a page to learn from, labels come
from rearranged placeholder text alone; an empty table gives an empty one.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaferry.llm.html_blocks import Block, blocks
from metaferry.llm.parts import parts

SAMPLE_PAGES, PAGE_CHARS = 120, 50_000
LAYOUTS, LONGEST = 8, 30
PATH_CELLS, WORD_CELLS, EXTRA = 768, 32, 6
WIDTH = PATH_CELLS + WORD_CELLS + EXTRA
_SLICE = 2048
LEAST_EXAMPLES = 5
HIDDEN, EPOCHS, RATE, GROUP = 12, 20, 0.02, 64

# Names in a path that mark what is not main text, and what is.
REST = frozenset(
    "nav footer aside form button select option dialog menu .ad .ads .advert .advertisement .banner .sponsor .sponsored .promo "
    ".sidebar .widget .nav .navbar .navigation .menu .breadcrumb .breadcrumbs .footer .header .masthead .topbar .cookie "
    ".cookies .consent .notice .alert .popup .modal .newsletter .subscribe .signup .comment .comments .commentlist .replies "
    ".disqus .respond .related .recommended .share .social .tags .pagination .pager .search .login .toolbar .copyright "
    ".complementary .contentinfo .form".split()
)
MAIN = frozenset(
    "article main .article .main .content .post .entry .story .text .body .page-content .articlebody .postbody".split()
)
_MAIN_PLACES = (
    ("article",), ("main",), ("div", ".content"), ("div", ".article", ".body"), ("div", ".post"), ("section", ".entry"),
    ("div", ".main"), ("div", ".story", ".text"), ("main", ".content"), ("article", ".post"), ("td", ".content"), ("div", ".text"),
    ("div", ".body", ".content"), ("div", ".page", ".content"), ("div", ".article"), ("div", ".entry", ".content"),
)
# Elements around both kinds; some have a name that elsewhere marks main text.
_OUTER = (
    ("div", ".page"), ("div", ".wrapper"), ("div", ".container"), ("section",), ("div",), ("div", ".row"), ("table",),
    ("div", ".content"), ("div", ".main"), ("div", ".site"), ("div", ".body"),
)
_REST_PLACES = tuple(
    (element, name) if name.startswith(".") else (name,) for name in sorted(REST) for element in ("div", "section", "ul")
) + tuple((name,) for name in sorted(REST) if not name.startswith(".")) * 5
_LIST, _CELL = (("ul",), ("li",)), (("table",), ("tr",), ("td",))
_MAIN_LEAVES = ((("p",),), (("p",),), (("p",),), (("h1",),), (("h2",),), (("h3",),), _LIST, (("ol",), ("li",)), _CELL, (("blockquote",),), (("blockquote",), ("p",)), (("pre",),), (("div",),), ())
_REST_LEAVES = ((("p",),), (("p",),), _LIST, _LIST, (("div",),), (("h3",),), (("h4",),), _CELL, ())
# What may stand between a place of other text and its leaves, as a reader's comment may be an article of its own.
_REST_INNER = ((), (), (), (("article",),), (("div", ".text"),), (("div", ".body"),), (("div", ".content"),), (("ol",), ("li",)), (("div",),))


def _is_main(block: Block) -> bool:
    names = {name for element in block.path for name in element}
    header = any(element[0] == "header" for element in block.path) and not any(e[0] in ("article", "main") for e in block.path)
    return bool(names & MAIN) and not names & REST and not header


def _cells(name: str) -> tuple[int, int]:
    code = zlib.crc32(name.encode())
    return code % PATH_CELLS, (code >> 16) % PATH_CELLS


class Vectors:
    """Turns blocks into rows of numbers. Names in paths beyond ``known`` ones, if given, say nothing."""

    def __init__(self, known: frozenset[str] | None = None) -> None:
        self.known = known
        self.paths: dict[tuple, np.ndarray] = {}
        self.words: dict[str, int] = {}

    def of(self, everything: Sequence[Block]) -> np.ndarray:
        rows = np.zeros((len(everything), WIDTH), np.float32)
        owners, cells = [], []
        for k, block in enumerate(everything):
            rows[k, self._path(block.path)] = 1
            found = self._words(block.text)
            owners.append(len(found))
            cells.extend(found)
            size = len(block.text)
            marks = block.text.count(".") + block.text.count(",")
            rows[k, PATH_CELLS + WORD_CELLS :] = (
                1, np.log1p(size) / 8, np.log1p(len(found)) / 6, block.linked, min(1.0, marks / (len(found) + 1)), len(block.path) / 10
            )
        owners = np.array(owners, np.int64)
        flat = np.repeat(np.arange(len(everything)), owners) * WORD_CELLS + np.array(cells, np.int64)
        counts = np.bincount(flat, minlength=len(everything) * WORD_CELLS).reshape(-1, WORD_CELLS)
        rows[:, PATH_CELLS : PATH_CELLS + WORD_CELLS] = 0.3 * counts / np.maximum(np.sqrt(owners), 1)[:, None]
        return rows

    def _path(self, path: tuple) -> np.ndarray:
        if path not in self.paths:
            if len(self.paths) > 50_000:
                self.paths.clear()
            names = {name for element in path for name in element if self.known is None or name in self.known}
            names.add("leaf:" + path[-1][0] if path else "leaf")
            self.paths[path] = np.array(sorted({cell for name in names for cell in _cells(name)}), np.int64)
        return self.paths[path]

    def _words(self, text: str) -> list[int]:
        known = self.words
        if len(known) > 500_000:
            known.clear()
        found = text.split()
        for word in found:
            if word not in known:
                known[word] = zlib.crc32(word.encode()) % WORD_CELLS
        return [known[word] for word in found]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Weights: per direction the input, the state and the bias of four gates; then the logistic unit."""

    def __init__(self, seed: int = 1):
        random = np.random.default_rng(seed)
        self.known: frozenset[str] | None = None
        self.weights = {}
        for side in "fb":
            self.weights[f"x{side}"] = random.normal(0, 0.08, (WIDTH, 4 * HIDDEN)).astype(np.float32)
            self.weights[f"h{side}"] = random.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
            self.weights[f"b{side}"] = bias
        self.weights["out"] = random.normal(0, 0.15, 2 * HIDDEN).astype(np.float32)
        self.weights["bias"] = np.zeros(1, np.float32)

    def inputs(self, rows: np.ndarray) -> np.ndarray:
        """What rows give to the gates of both directions."""
        return np.concatenate([rows @ self.weights[f"x{side}"] + self.weights[f"b{side}"] for side in "fb"], axis=-1)

    def _read(self, side: str, inputs: np.ndarray, active: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States of one direction for inputs (step, lane, gates); lanes are sorted, the longest first."""
        steps, lanes, _ = inputs.shape
        inputs = inputs[..., : 4 * HIDDEN] if side == "f" else inputs[..., 4 * HIDDEN :]
        state, memory = np.zeros((lanes, HIDDEN), np.float32), np.zeros((lanes, HIDDEN), np.float32)
        states = np.zeros((steps, lanes, HIDDEN), np.float32)
        order = range(steps) if side == "f" else range(steps - 1, -1, -1)
        for step in order:
            n = active[step]
            gates = inputs[step, :n] + state[:n] @ self.weights[f"h{side}"]
            opened = _sigmoid(gates[:, : 3 * HIDDEN])
            take, hold, show = opened[:, :HIDDEN], opened[:, HIDDEN : 2 * HIDDEN], opened[:, 2 * HIDDEN :]
            new = np.tanh(gates[:, 3 * HIDDEN :])
            earlier, before = memory[:n].copy(), state[:n].copy()
            memory[:n] = hold * earlier + take * new
            shown = np.tanh(memory[:n])
            state[:n] = show * shown
            states[step, :n] = state[:n]
            if keep is not None:
                keep.append((step, n, take, hold, show, new, earlier, before, shown))
        return states

    def chances(self, pages: Sequence[np.ndarray]) -> list[np.ndarray]:
        """For each page (the inputs of its blocks) the chance of each block to be main text."""
        results: list = [np.zeros(0)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: -len(pages[k]))
        start = 0
        while start < len(order):
            # As many pages as fill a bounded table.
            lanes = max(1, min(256, 100_000 // len(pages[order[start]])))
            chosen = order[start : start + lanes]
            start += lanes
            inputs, active = _grid([pages[k] for k in chosen])
            states = np.concatenate([self._read(side, inputs, active) for side in "fb"], axis=2)
            chance = _sigmoid(states @ self.weights["out"] + self.weights["bias"])
            for lane, k in enumerate(chosen):
                results[k] = chance[: len(pages[k]), lane]
        return results

    def train(self, pages: Sequence[np.ndarray], labels: Sequence[np.ndarray], seed: int = 1) -> None:
        """Adam on the log loss of all blocks, by back-propagation through time."""
        random = np.random.default_rng(seed)
        first = {name: np.zeros_like(value) for name, value in self.weights.items()}
        second = {name: np.zeros_like(value) for name, value in self.weights.items()}
        count = 0
        for epoch in range(EPOCHS):
            shuffled = random.permutation(len(pages))
            for start in range(0, len(shuffled), GROUP):
                chosen = sorted(shuffled[start : start + GROUP], key=lambda k: -len(pages[k]))
                slopes = self._slopes([pages[k] for k in chosen], [labels[k] for k in chosen])
                count += 1
                rate = RATE * (1 - epoch / EPOCHS)
                for name, slope in slopes.items():
                    slope = np.clip(slope, -1, 1)
                    first[name] = 0.9 * first[name] + 0.1 * slope
                    second[name] = 0.99 * second[name] + 0.01 * slope**2
                    step = first[name] / (1 - 0.9**count) / (np.sqrt(second[name] / (1 - 0.99**count)) + 1e-6)
                    self.weights[name] = (self.weights[name] - rate * step).astype(np.float32)

    def _slopes(self, pages: list[np.ndarray], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        rows, active = _grid(pages)
        inputs = self.inputs(rows)
        wanted, mask = np.zeros(rows.shape[:2], np.float32), np.zeros(rows.shape[:2], np.float32)
        for lane, label in enumerate(labels):
            wanted[: len(label), lane], mask[: len(label), lane] = label, 1
        kept: dict[str, list] = {"f": [], "b": []}
        sides = {side: self._read(side, inputs, active, kept[side]) for side in "fb"}
        states = np.concatenate([sides["f"], sides["b"]], axis=2)
        error = (_sigmoid(states @ self.weights["out"] + self.weights["bias"]) - wanted) * mask / mask.sum()
        slopes = {"out": np.tensordot(error, states, ([0, 1], [0, 1])), "bias": np.array([error.sum()], np.float32)}
        for side, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            from_above = error[:, :, None] * self.weights["out"][part]
            lanes = rows.shape[1]
            of_state, of_memory = np.zeros((lanes, HIDDEN), np.float32), np.zeros((lanes, HIDDEN), np.float32)
            of_gates = np.zeros((*rows.shape[:2], 4 * HIDDEN), np.float32)
            of_weights = np.zeros_like(self.weights[f"h{side}"])
            for step, n, take, hold, show, new, earlier, before, shown in reversed(kept[side]):
                arriving = of_state[:n] + from_above[step, :n]
                memory = of_memory[:n] + arriving * show * (1 - shown**2)
                gates = np.concatenate(
                    [
                        memory * new * take * (1 - take),
                        memory * earlier * hold * (1 - hold),
                        arriving * shown * show * (1 - show),
                        memory * take * (1 - new**2),
                    ],
                    axis=1,
                )
                of_gates[step, :n] = gates
                of_weights += before.T @ gates
                of_state[:n], of_memory[:n] = gates @ self.weights[f"h{side}"].T, memory * hold
            flat = of_gates.reshape(-1, 4 * HIDDEN)
            slopes[f"x{side}"] = rows.reshape(-1, WIDTH).T @ flat
            slopes[f"h{side}"], slopes[f"b{side}"] = of_weights, flat.sum(axis=0)
        return slopes


def _grid(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pages, the longest first, as (step, lane, width), and how many lanes reach each step."""
    lengths = np.array([len(page) for page in pages])
    rows = np.zeros((lengths[0], len(pages), pages[0].shape[1]), np.float32)
    for lane, page in enumerate(pages):
        rows[: len(page), lane] = page
    return rows, np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")


def _rearranged(main: list[str], rest: list[str], random: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """A page of other layout from given texts, with its labels."""

    def pick(choices: Sequence):
        return choices[int(random.integers(len(choices)))]

    def named(element: tuple[str, ...]) -> tuple[str, ...]:
        odd = tuple("." + "".join(pick("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) for _ in range(int(random.integers(3))))
        return element + odd if random.random() < 0.4 else element

    root = (("html",), ("body",), *[named(pick(_OUTER)) for _ in range(int(random.integers(3)))])
    found: list[Block] = []
    labels: list[bool] = []

    def add(path: tuple, texts: list[str], leaves: Sequence, is_main: bool) -> None:
        leaf = pick(leaves)
        for text in texts:
            leaf = leaf if not is_main and random.random() < 0.8 else pick(leaves)
            linked = float(random.random() < (0.05 if is_main else 0.5))
            found.append(Block((*path, *leaf), text, linked))
            labels.append(is_main)

    def add_rest(path: tuple) -> None:
        # Readers' comments and adverts can be as long as main text.
        pool = rest if random.random() < 0.6 or not main else main
        place = (*path, named(pick(_REST_PLACES)), *pick(_REST_INNER))
        add(place, [pick(pool) for _ in range(int(random.integers(1, 5)))], _REST_LEAVES, False)

    for _ in range(int(random.integers(0, 4))):
        add_rest(root)
    if random.random() < 0.3:
        add((*root, ("header",)), [pick(rest)], _REST_LEAVES, False)
    inside = (*root, *[named(pick(_OUTER)) for _ in range(int(random.integers(2)))], named(pick(_MAIN_PLACES)))
    if random.random() < 0.2:
        inside = (*inside, named(pick(_OUTER)))
    for text in main:
        add(inside, [text], _MAIN_LEAVES, True)
        if random.random() < 0.2:
            add_rest(inside)
    for _ in range(int(random.integers(0, 3))):
        add_rest(inside)
    for _ in range(int(random.integers(0, 4))):
        add_rest(root)
    return found[:LONGEST], labels[:LONGEST]


def trained(pages: Sequence[str | None], seed: int = 1) -> Labeller:
    """A labeller from a bounded list of pages."""
    random = np.random.default_rng(seed)
    examples: list[tuple[list[Block], list[bool]]] = []
    for page in pages:
        found = blocks(page)
        labels = [_is_main(block) for block in found]
        main = [block.text for block, label in zip(found, labels) if label]
        rest = [block.text for block, label in zip(found, labels) if not label] or ["x"]
        if main:
            examples.extend([(found[:LONGEST], labels[:LONGEST]), (found[-LONGEST:], labels[-LONGEST:])])
        for _ in range(LAYOUTS):
            first = int(random.integers(max(1, len(main))))
            examples.append(_rearranged(main[first : first + int(random.integers(1, 12))], rest, random))
    if not examples:
        examples = [_rearranged(["main text"] * 5, ["x"], random) for _ in range(GROUP)]
    examples = [example for example in examples if example[0]]
    # A name that few examples have would only collide with others.
    held = Counter(name for found, _ in examples for name in {name for block in found for element in block.path for name in element})
    labeller = Labeller(seed)
    labeller.known = frozenset(name for name, count in held.items() if count >= LEAST_EXAMPLES)
    vectors = Vectors(labeller.known)
    labeller.train(
        [vectors.of(found) for found, _ in examples], [np.array(labels, np.float32) for _, labels in examples], seed
    )
    return labeller


def sample(pages: DataFrame, key: str = "page_id", html: str = "html") -> list[str]:
    """The pages to learn from. Runs a job; its result is bounded by the sample's parameters."""
    order = F.pmod(F.xxhash64(F.col(key).cast("string"), F.length(html)), F.lit(1 << 30))
    # Few more pages than wanted are compared, so that not every task sends as many.
    share = min(1.0, 3 * SAMPLE_PAGES / max(1, pages.count()))
    usable = pages.filter(order < math.ceil(share * (1 << 30))).filter(F.length(html).between(1, PAGE_CHARS))
    return [row[0] for row in usable.orderBy(order, F.md5(html)).select(html).limit(SAMPLE_PAGES).collect()]


def extract(
    pages: DataFrame, labeller: Labeller, html: str = "html", keep: Sequence[str] = ("page_id", "url"), text: str = "text"
) -> DataFrame:
    """The columns ``keep`` and the main text of every row."""
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors(labeller.known)
        for batch in parts(batches, html):
            found = [blocks(value.as_py()) for value in batch.column(len(keep))]
            everything = [block for page in found for block in page]
            inputs = [
                labeller.inputs(vectors.of(everything[start : start + _SLICE])) for start in range(0, len(everything), _SLICE)
            ] or [np.zeros((0, 8 * HIDDEN), np.float32)]
            ends = np.cumsum([len(page) for page in found])
            chances = labeller.chances(np.split(np.concatenate(inputs), ends[:-1]))
            texts = [
                "\n\n".join([block.text for block, chance in zip(page, of_page) if chance > 0.5])
                for page, of_page in zip(found, chances)
            ]
            columns = [batch.column(k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*keep, text])

    schema = ", ".join([f"`{name}` {kinds[name]}" for name in keep] + [f"`{text}` string"])
    return pages.select(*keep, html).mapInArrow(run, schema)


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text) of every page, with a labeller trained on a sample of them. Runs a job for the sample."""
    return extract(pages, trained(sample(pages, key, html)), html, (key, url))
