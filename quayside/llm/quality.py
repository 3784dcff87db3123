"""Quality classifier by co-training of two views: the text's content, and the page's metadata and layout.

Each view has a logistic regression of its own. Starting from labelled documents, every round each classifier names the unlabelled
documents that it is surest of, and the other one learns from these pseudo-labels too. On labelled documents kept aside each view is
calibrated, and a last regression weighs the two calibrated views against each other. Models are fitted on bounded samples, chosen by a hash of
doc_id; all documents are scored in one pass over the texts, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.logistic import Logistic, fit
from quayside.llm.tables import bounded_batches, unused, written
from quayside.llm.words import hashed_words, joined_hashes, sliced

#: Most labelled and most unlabelled documents that models are fitted on.
LABELLED, UNLABELLED = 20_000, 20_000
ROUNDS = 4
#: Share of the unlabelled documents that a view labels for the other in a round, and how sure it has to be.
CONFIDENT_SHARE, CONFIDENT = 0.1, 0.95
KEEP = 0.5
#: Slots of the hashed values of a categorical column.
SLOTS = 16
CONTENT = ["words", "distinct words", "distinct trigrams", "commonest word", "repeated words", "word length", "upper", "digits", "stops", "marks", "symbols", "lone symbols", "other letters"]
LAYOUT = ["declared length", "lines", "line length", "longest line", "short lines", "blank lines"]
#: Classes of ASCII characters whose shares are content.
KINDS = {"upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": "0123456789", "stops": ".,;:", "marks": "!?", "symbols": "#$%&*|~^<>=+@\\{}[]_"}


def content(texts: pa.Array) -> np.ndarray:
    """A row of ``CONTENT`` for each text; all 0 for null and blank ones."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    out = np.zeros((len(texts), len(CONTENT)))
    words, offsets = hashed_words(texts.cast(pa.string()))
    trigrams = joined_hashes(words, 3)
    repeated = np.concatenate([[False], words[1:] == words[:-1]]) if len(words) else np.zeros(0, bool)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    kind = np.zeros(256, np.uint8)
    for i, chars in enumerate(KINDS.values(), 1):
        kind[[ord(c) for c in chars]] = i
    kind[[32, 9, 10, 11, 12, 13]] = 7
    kind[128:] = 8
    kinds = kind[raw]
    for i, (start, stop) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        n = stop - start
        if not n:
            continue
        _, counts = np.unique(words[start:stop], return_counts=True)
        third = trigrams[start : max(start, stop - 2)]
        share = np.bincount(kinds[at[i] : at[i + 1]], minlength=9) / max(1, at[i + 1] - at[i])
        own = kinds[at[i] : at[i + 1]]
        lone = ((own[1:-1] == 5) & (own[:-2] == 7) & (own[2:] == 7)).sum() if len(own) > 2 else 0
        out[i] = [
            np.log1p(n), len(counts) / n, len(np.unique(third)) / max(1, len(third)), counts.max() / n, repeated[start + 1 : stop].mean() if n > 1 else 0,
            (at[i + 1] - at[i]) / n / 10, share[1], share[2], share[3], share[4], share[5], lone / n, share[8],
        ]
    # Small shares tell more than large ones differ.
    out[:, 6:] = np.sqrt(out[:, 6:])
    return out


def layout(texts: pa.Array, lengths: pa.Array) -> np.ndarray:
    """A row of ``LAYOUT`` for each text."""
    lines = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    sizes = pc.binary_length(lines.flatten()).to_numpy(zero_copy_only=False)
    counts = pc.list_value_length(lines).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(counts)])[:-1].astype(np.int64)
    out = np.zeros((len(texts), len(LAYOUT)))
    if len(texts):
        declared = np.nan_to_num(pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False).astype(float))
        out[:, 0] = np.log1p(np.clip(declared, 0, None))
        out[:, 1] = np.log1p(counts)
        out[:, 2] = np.log1p(np.add.reduceat(sizes, starts) / counts)
        out[:, 3] = np.log1p(np.maximum.reduceat(sizes, starts))
        out[:, 4] = np.add.reduceat((sizes < 40).astype(float), starts) / counts
        out[:, 5] = np.add.reduceat((sizes == 0).astype(float), starts) / counts
    return out


def slots(values: pa.Array) -> np.ndarray:
    """A one-hot row for each value; null is a value of its own."""
    coded = pc.fill_null(values.cast(pa.string()), "\0").dictionary_encode()
    out = np.zeros((len(values), SLOTS))
    if len(values):
        hashes = [sum((i + 1) * b for i, b in enumerate(str(v).encode())) % SLOTS for v in coded.dictionary.to_pylist()]
        out[np.arange(len(values)), np.array(hashes)[coded.indices.to_numpy()]] = 1
    return out


def metadata(texts: pa.Array, lengths: pa.Array, lang: pa.Array, source: pa.Array) -> np.ndarray:
    return np.hstack([layout(texts, lengths), slots(lang), slots(source)])


@dataclass(frozen=True)
class CoTrained:
    content: Logistic
    metadata: Logistic
    combined: Logistic

    def views(self, content_rows: np.ndarray, metadata_rows: np.ndarray) -> np.ndarray:
        """Log-odds of both views."""
        both = [self.content.scores(content_rows), self.metadata.scores(metadata_rows)]
        return np.column_stack([np.log(np.clip(p, 1e-6, 1) / np.clip(1 - p, 1e-6, 1)) for p in both])

    def scores(self, content_rows: np.ndarray, metadata_rows: np.ndarray) -> np.ndarray:
        return self.combined.scores(self.views(content_rows, metadata_rows))


def co_train(views: tuple[np.ndarray, np.ndarray], labels: np.ndarray, others: tuple[np.ndarray, np.ndarray], rounds: int = ROUNDS) -> CoTrained:
    """``views`` are rows of labelled documents, ``others`` those of unlabelled ones. Every fourth labelled row calibrates."""
    aside = np.arange(len(labels)) % 4 == 3
    if not aside.any():
        aside[:] = True
    learn = ~aside if (~aside).any() else aside
    pseudo: list[dict[int, float]] = [{}, {}]  # for each view, what the other one has labelled

    def train(view: int) -> Logistic:
        rows, marks = list(pseudo[view]), list(pseudo[view].values())
        inputs = np.vstack([views[view][learn], others[view][rows]]) if rows else views[view][learn]
        weights = np.concatenate([np.ones(learn.sum()), np.full(len(rows), 0.5)])
        return fit(inputs, np.concatenate([labels[learn], marks]), weights)

    models = [train(0), train(1)]
    for _ in range(rounds):
        for view in (0, 1):
            if len(others[view]):
                p = models[view].scores(others[view])
                fresh = [i for i in np.argsort(-np.abs(p - 0.5), kind="stable") if i not in pseudo[1 - view] and max(p[i], 1 - p[i]) >= CONFIDENT]
                pseudo[1 - view].update({int(i): float(p[i] >= 0.5) for i in fresh[: int(CONFIDENT_SHARE * len(p))]})
        models = [train(0), train(1)]
    half = CoTrained(models[0], models[1], Logistic(np.ones(2), 0.0))
    return CoTrained(models[0], models[1], fit(half.views(views[0][aside], views[1][aside]), labels[aside]))


COLUMNS = ("text", "n_chars", "lang", "source")


def _sampled(docs: DataFrame, ids: DataFrame) -> tuple[list, tuple[np.ndarray, np.ndarray]]:
    """Ids and views of the documents in ``ids``, which are few; one row for each id."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, ids, *rest in sliced(b.column("text"), b.column("doc_id"), *(b.column(c) for c in COLUMNS[1:])):
                rows = (content(text), metadata(text, *rest))
                yield pa.record_batch([ids, *(pa.array(list(r), pa.list_(pa.float64())) for r in rows)], ["doc_id", "content", "metadata"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs.select("doc_id", *COLUMNS).join(F.broadcast(ids), "doc_id", "left_semi")
    rows = chosen.mapInArrow(scan, f"doc_id {kind}, content array<double>, metadata array<double>")
    # An id may have any number of rows; the driver gets one.
    one = rows.groupBy("doc_id").agg(F.min(F.struct("content", "metadata")).alias("row")).select("doc_id", "row.*")
    found = one.toArrow().sort_by("doc_id")
    widths = {"content": len(CONTENT), "metadata": len(LAYOUT) + 2 * SLOTS}
    views = tuple(np.array(found.column(c).to_pylist(), float).reshape(found.num_rows, width) for c, width in widths.items())
    return found.column("doc_id").to_pylist(), views


def train(docs: DataFrame, labels: DataFrame) -> CoTrained:
    """``labels`` has ``doc_id, quality``; null labels and ids are none, and of several for a doc_id the lowest counts."""
    bounded_batches(docs.sparkSession)
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = (F.xxhash64(F.lit(6), "doc_id"), F.col("doc_id"))
    marked = written(known.orderBy(*order).limit(LABELLED), "labelled")
    marks = {r["doc_id"]: float(r["quality"] > 0) for r in marked.toArrow().to_pylist()}
    pool = docs.where(F.col("doc_id").isNotNull()).select("doc_id").join(F.broadcast(marked), "doc_id", "left_anti")
    pool = written(pool.orderBy(*order).limit(UNLABELLED), "unlabelled")
    ids, views = _sampled(docs, marked)
    # Equal hashes order rows that are split by position below, so that the parts don't follow doc_id.
    _, others = _sampled(docs, pool)
    mix = np.random.default_rng(6).permutation(len(ids))
    return co_train(tuple(v[mix] for v in views), np.array([marks[i] for i in ids], float)[mix], others)


def score(docs: DataFrame, model: CoTrained) -> Column:
    """Column with the probability of good quality; a null or blank text is scored by its metadata and empty content."""

    @F.arrow_udf("double")
    def rate(text: pa.Array, n_chars: pa.Array, lang: pa.Array, source: pa.Array) -> pa.Array:
        scores = [model.scores(content(t), metadata(t, *rest)) for t, *rest in sliced(text, n_chars, lang, source)]
        return pa.array(np.concatenate([np.zeros(0), *scores]))

    return rate(*(F.col(c) for c in COLUMNS))


def classify(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """``docs`` (doc_id, text, lang, source, n_chars and any others) with ``quality_score`` and ``keep`` added, columns of these names replaced.

    Without labels of both classes all documents score alike: 1 if there are only good ones, else 0.
    """
    own = [c for c in docs.columns if c.lower() not in ("quality_score", "keep")]
    scored = docs.select(*own).withColumn("quality_score", score(docs, train(docs, labels)))
    return scored.withColumn("keep", F.col("quality_score") >= keep)


def kept(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """The documents that are kept, with all their columns."""
    name = unused(docs, "quality")
    return docs.withColumn(name, score(docs, train(docs, labels))).where(F.col(name) >= keep).drop(name)
