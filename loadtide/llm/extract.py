"""Main text of HTML pages: boosted trees over DOM nodes, then one consistent choice per tree.

Each node has features of its own and of the subtree below it. Boosted trees give the chance that it belongs to the
article. Pages that name their parts by known class words have trees of their own; pages without a single one go by trees that have
seen invented names only, so that these lean on tags, links, density and place. Decoding picks keep or drop for all nodes at once: a node may be kept only if its parent is, so an
ancestor that is dropped takes everything below with it, and the sum of log chances is the highest possible.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadtide.llm.dom import Page, blocks
from loadtide.llm.domtrain import WORDS, pages
from loadtide.llm.words import as_bytes

TRAIN_PAGES = 500
TREES = 40
TAGS = (
    "p h1 h2 h3 h4 li ul ol a span b div section article main header footer nav aside form button label select option textarea table tr td "
    "blockquote pre code figure figcaption body html #page ins dialog small strong em i dl dt dd details address"
).split()
TAG_OF = {t: k + 1 for k, t in enumerate(TAGS)}
#: tags whose presence on the path to a node is a feature
PATH_TAGS = "article main header footer nav aside form button p table li".split()
GROUPS = list(WORDS)
GROUP_OF: dict[str, int] = {}
for _k, _g in enumerate(GROUPS):
    for _w in WORDS[_g].split():
        GROUP_OF[_w] = GROUP_OF.get(_w, 0) | 1 << _k
#: text-level tags; without class words they go with the block around them
INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
PUNCTUATION = re.compile(r"[.,;:!?]")


def _mask(marks: list[str]) -> int:
    out = 0
    for m in marks:
        out |= GROUP_OF.get(m, 0) or GROUP_OF.get(m.removesuffix("s"), 0)
    return out


def node_features(found: list[Page]) -> np.ndarray:
    """(nodes of all pages, features), pages one after the other."""
    base = np.cumsum([0] + [len(p.tag) for p in found])
    n = int(base[-1])
    tag = np.array([TAG_OF.get(t, 0) for p in found for t in p.tag])
    up = np.concatenate([np.array(p.parent) + np.where(np.array(p.parent) < 0, 0, b) for p, b in zip(found, base)])
    root = np.concatenate([np.full(len(p.tag), b) for p, b in zip(found, base)])
    up = np.where(up < 0, np.arange(n), up)
    end = np.concatenate([np.array(p.end) + b for p, b in zip(found, base)])
    depth = np.array([d for p in found for d in p.depth])
    marks = np.array([_mask(m) for p in found for m in p.marks])
    hidden = np.array([h for p in found for h in p.hidden])
    chars, words, points = np.zeros(n), np.zeros(n), np.zeros(n)
    for p, b in zip(found, base):
        for node, _, text in p.texts:
            k = node + b
            chars[k] += len(text)
            words[k] += text.count(" ") + 1
            points[k] += len(PUNCTUATION.findall(text))

    def below(x):
        sums = np.concatenate(([0.0], np.cumsum(x)))
        return sums[end] - sums[np.arange(n)]

    # what a node inherits along its path, level by level
    path = np.zeros((n, len(PATH_TAGS)), bool)
    for k, t in enumerate(PATH_TAGS):
        path[:, k] = tag == TAG_OF[t]
    in_link = tag == TAG_OF["a"]
    above_marks = np.zeros(n, np.int64)
    off = hidden.copy()
    for d in range(1, int(depth.max()) + 1 if n else 0):
        at = np.flatnonzero(depth == d)
        path[at] |= path[up[at]]
        in_link[at] |= in_link[up[at]]
        above_marks[at] = above_marks[up[at]] | marks[up[at]]
        off[at] |= off[up[at]]
    first = np.concatenate(([0.0], np.cumsum(chars)))[:-1]
    total = below(chars)
    page_chars = np.maximum(total[root], 1)
    tags = end - np.arange(n)
    linked = below(np.where(in_link, chars, 0))
    kids = np.bincount(up, minlength=n) - (up == np.arange(n))[np.arange(n)]
    order = np.zeros(n)
    seen = np.zeros(n, np.int64)
    for k in range(n):
        order[k] = seen[up[k]]
        seen[up[k]] += 1
    p_chars = below(np.where(tag == TAG_OF["p"], total, 0))
    parent_chars = total[up]
    _, pair, alike = np.unique(up * (len(TAGS) + 1) + tag, return_inverse=True, return_counts=True)
    alike = np.log1p(alike[pair])  # siblings of the same tag
    lists = [
        alike, alike[up], parent_chars / page_chars, total[up[up]] / page_chars, linked[up[up]] / np.maximum(total[up[up]], 1),
        depth, tags, np.log1p(total), np.log1p(chars), total / tags, linked / np.maximum(total, 1), total / page_chars,
        (first - first[root]) / page_chars, below(points) / np.maximum(below(words), 1), below(words) / tags,
        np.log1p(kids), np.log1p(kids[up]), order / np.maximum(kids[up], 1), total / np.maximum(parent_chars, 1),
        linked[up] / np.maximum(parent_chars, 1), np.log1p(below(tag == TAG_OF["p"])), np.log1p(below(tag == TAG_OF["li"])),
        np.log1p(below((tag == TAG_OF["button"]) | (tag == TAG_OF["label"]) | (tag == TAG_OF["form"]))),
        np.log1p(p_chars), below(tag == TAG_OF["article"]) > 0, off, in_link, tag, tag[up],
    ]
    lists += [marks >> k & 1 for k in range(len(GROUPS))]
    lists += [above_marks >> k & 1 for k in range(len(GROUPS))]
    lists += [path[:, k] for k in range(len(PATH_TAGS))]
    lists += [tag == TAG_OF[t] for t in ("div", "section", "p", "h1", "ul", "body", "ins", "dialog")]
    return np.stack([np.asarray(x, np.float64) for x in lists], axis=1)


class Trees:
    """Boosted trees as arrays: a node goes left where its feature is at most the threshold."""

    def __init__(self, trees: list[list[tuple]], weights: list[float]):
        self.trees = [tuple(np.array(col) for col in zip(*t)) for t in trees]
        self.weights = weights

    def chance(self, x: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(x))
        rows = np.arange(len(x))
        for (feature, threshold, left, right, value), w in zip(self.trees, self.weights):
            at = np.zeros(len(x), np.int64)
            while True:
                inner = left[at] >= 0
                if not inner.any():
                    break
                goes = x[rows, np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(goes, left[at], right[at]), at)
            margin += w * value[at]
        return 1 / (1 + np.exp(-2 * np.clip(margin, -15, 15)))


def _labelled(count: int, seed: int, invented: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    sources = pages(count, seed, invented)
    found = [Page(s) for s in sources]
    ys = []
    for s, p in zip(sources, found):
        given = iter(re.findall(r"<\w+[^>]*>", s))
        own: list[int] = []
        for t, parent in zip(p.tag[1:], p.parent[1:]):
            for raw in given:  # void tags have no node
                if raw[1:].split()[0].rstrip(">").lower() == t:
                    break
            stated = re.search(r"data-y=[\"'](\d)", raw)
            up = own[parent - 1] if parent > 0 else 1
            own.append(int(stated[1]) if stated else up)
        ys += [1, *own]
    return node_features(found), np.array(ys, np.float64)


def train(spark: SparkSession, count: int = TRAIN_PAGES, trees: int = TREES, seed: int = 5, invented: float = 0.0) -> Trees:
    """Fit Spark's boosted trees on ``count`` generated pages; the model doesn't depend on the input pages."""
    x, y = _labelled(count, seed, invented)
    lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel())
    rows = spark.createDataFrame(pa.table({"label": y, "x": lists}))
    data = rows.select("label", array_to_vector("x").alias("features")).repartition(4).cache()
    model = GBTClassifier(maxIter=trees, maxDepth=5, stepSize=0.3, minInstancesPerNode=5, subsamplingRate=1.0, seed=seed).fit(data)
    data.unpersist()

    def flat(tree) -> list[tuple]:
        out: list = []

        def walk(node) -> int:
            k = len(out)
            out.append(None)
            if node.subtreeDepth() == 0:
                out[k] = (-1, 0.0, -1, -1, node.prediction())
            else:
                split = node.split()
                a = walk(node.leftChild())
                b = walk(node.rightChild())
                out[k] = (split.featureIndex(), split.threshold(), a, b, 0.0)
            return k

        walk(tree._call_java("rootNode"))
        return out

    return Trees([flat(t) for t in model.trees], list(model.treeWeights))


@lru_cache(maxsize=4)
def _model(app: str, count: int, trees: int, seed: int, invented: float = 0.0) -> Trees:
    return train(SparkSession.getActiveSession(), count, trees, seed, invented)


def chances(named: Trees, unnamed: Trees, found: list[Page]) -> np.ndarray:
    """Chance of every node of all pages, by the trees that fit the page."""
    x = node_features(found)
    known = np.concatenate([np.full(len(p.tag), any(_mask(m) for m in p.marks)) for p in found])
    out = np.empty(len(x))
    out[known], out[~known] = named.chance(x[known]), unnamed.chance(x[~known])
    return out


def decode(page: Page, chance: np.ndarray) -> np.ndarray:
    """Keep or drop for every node: the most likely choice in which kept nodes have kept parents.

    Text-level nodes without class words have no say and follow their block.
    """
    n = len(page.tag)
    plain = np.array([t in INLINE and not m for t, m in zip(page.tag, page.marks)])
    chance = np.where(plain, 0.5, np.clip(chance, 1e-6, 1 - 1e-6))
    yes, no = np.log(chance), np.log(1 - chance)
    drop = no.copy()
    keep = yes.copy()
    for k in range(n - 1, 0, -1):
        drop[page.parent[k]] += drop[k]
        keep[page.parent[k]] += max(keep[k], drop[k])
    out = np.zeros(n, bool)
    for k in range(n):
        out[k] = (k == 0 or out[page.parent[k]]) and keep[k] >= drop[k]
    return out


def extract(table: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"), count: int = TRAIN_PAGES, trees: int = TREES, seed: int = 5) -> DataFrame:
    """The ``keep`` columns, text (main text, empty if none) and n_chars (its code points) of every row.

    Blocks are joined by an empty line in page order; white space inside a block is one blank. Null, empty and
    tagless sources are pages like any other: a null source has an empty text. Repeated rows keep their
    rows; other columns are left out, and a kept column named text or n_chars is replaced.
    """
    spark = table.sparkSession
    app = spark.sparkContext.applicationId
    model = spark.sparkContext.broadcast([_model(app, count, trees, seed, invented) for invented in (0.0, 1.0)])
    keep = tuple(c for c in keep if c not in ("text", "n_chars"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = [s.decode() for s in as_bytes(batch.column(len(keep)))]
            texts = []
            for lo in range(0, len(sources), 100):
                found = [Page(s) for s in sources[lo : lo + 100]]
                chance = chances(*model.value, found)
                at = 0
                for p in found:
                    texts.append(blocks(p, decode(p, chance[at : at + len(p.tag)])))
                    at += len(p.tag)
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string()), sizes], names=[*keep, "text", "n_chars"])

    picked = table.select(*[F.col(f"`{c}`") for c in keep], F.col(html_col).cast("string").alias("_html"))
    schema = picked.select(*picked.columns[: len(keep)], F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return picked.mapInArrow(run, schema)
