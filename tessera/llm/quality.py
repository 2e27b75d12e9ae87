"""Quality classifier by co-training two views of a document.

*Text view*: distinct words (A-Z lower-cased), their 4- and 5-byte prefixes and
binned shape statistics; features are weighted by their log-odds ratio between
good and other documents, and those near 0 are left out. *Metadata view*: source, language and binned length.
Each view is a logistic regression on binary features. In every round each
view scores a pool of unlabelled documents and hands those it is confident of
(calibrated on held-out labels) to the *other* view as pseudo-labels; both are
fitted again. In the end the views' calibrated log-odds are combined by a
small logistic model fitted on held-out labels, and every document is
scored.

A document is good if it is labelled quality 1 and not toxic. Only fitting
uses a sample: at most ``LABELLED`` labelled and ``POOL`` unlabelled documents,
those with the smallest seeded hash of the id. Their features are counted in
Spark; only those that a view uses come to the driver, as numbers. Text
statistics are of whole texts, and scoring reads every document in one pass
without a shuffle.

Defined results: null text has no words; null metadata is a value of its own;
null or repeated ids are scored like any other row, rows whose label is null
do not train; without labels of both kinds every document is accepted with the
share of good labels (1 if none); empty tables give empty results; extra
columns are carried through.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import scratch
from tessera.llm._tokens import Memo, mix, slices, texts_of, word_and_head_hashes

LABELLED = 6000
POOL = 3000
ROUNDS = 2
CONFIDENT = 0.98
MIN_DF = 5
ACCEPT = 0.5
MIN_RATIO = 0.5
L2 = 1e-4
STEPS = 80
META = ("source", "lang", "n_chars")
_LOW = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_KIND = np.zeros(256, np.int8)  # 1 upper, 2 digit, 3 other ASCII mark
for _b in range(0x21, 0x7F):
    _KIND[_b] = 1 if 65 <= _b <= 90 else 2 if 48 <= _b <= 57 else 0 if 97 <= _b <= 122 else 3
_BINS = np.array([0.0, 0.005, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5, 0.8, 1.01])


_NAMES: dict = Memo()


def _named(*parts) -> int:
    """FNV-1a of the parts."""
    if parts not in _NAMES:
        if len(_NAMES) > 5000:
            _NAMES.clear()
        h = 0xCBF29CE484222325
        for b in "\x1f".join(map(str, parts)).encode():
            h = ((h ^ b) * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
        _NAMES[parts] = h
    return _NAMES[parts]


def _shape(text: bytes, n_words: int, n_distinct: int) -> list[int]:
    kinds = np.zeros(4, np.int64)
    for at in range(0, len(text), 1 << 20):
        kinds += np.bincount(_KIND[np.frombuffer(text, np.uint8, min(1 << 20, len(text) - at), at)], minlength=4)
    size = max(1, len(text))
    shares = np.array([kinds[1], kinds[2], kinds[3], text.count(b"\n")]) / size
    shares = np.append(shares, 1 - n_distinct / max(1, n_words))
    out = [_named("shape", i, b) for i, b in enumerate(np.searchsorted(_BINS, shares, "right").tolist())]
    out.append(_named("words", n_words.bit_length()))
    out.append(_named("length", min(20, len(text) // max(1, n_words))))
    return out


def text_features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit features of the texts and the text that each belongs to; a
    feature comes once per occurrence."""
    raw = [t or b"" for t in texts]
    hashes, at = word_and_head_hashes([t.translate(_LOW) for t in raw], (5, 4))
    n_words = np.diff(at)
    owner = np.repeat(np.arange(len(raw)), n_words)
    distinct = np.unique(mix(hashes[0] + owner.astype(np.uint64)), return_index=True)[1]
    n_distinct = np.bincount(owner[distinct], minlength=len(raw))
    shapes = [_shape(t, n, d) for t, n, d in zip(raw, n_words.tolist(), n_distinct.tolist())]
    keys = [mix(h + np.uint64(i)) for i, h in enumerate(hashes)] + [np.array([x for s in shapes for x in s], np.uint64)]
    owners = [owner] * len(hashes) + [np.repeat(np.arange(len(raw)), [len(s) for s in shapes])]
    return np.concatenate(keys), np.concatenate(owners)


def meta_features(columns: list[list]) -> tuple[np.ndarray, np.ndarray]:
    """Features of the metadata values (one list per column of META)."""
    source, lang, n_chars = columns
    out = []
    for s, g, n in zip(source, lang, n_chars):
        size = -1 if n is None else int(2 * math.log2(max(1, n)))
        out += [_named("source", s), _named("lang", g), _named("n_chars", size)]
    return np.array(out, np.uint64), np.repeat(np.arange(len(source)), 3)


def by_text(key: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text, and the texts' offsets."""
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    key, owner = key[new], owner[new]
    return key, np.searchsorted(owner, np.arange(n + 1))


def _take(ids: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of some rows, and which of them each belongs to."""
    n = at[rows + 1] - at[rows]
    first = np.concatenate([[0], np.cumsum(n)])
    return ids[np.arange(first[-1]) + np.repeat(at[rows] - first[:-1], n)], np.repeat(np.arange(len(rows)), n)


class View:
    """Logistic regression on sets of 64-bit features."""

    def __init__(self, keys: np.ndarray, lift: np.ndarray):
        """The features used, and the sizes of their log-odds ratios."""
        order = np.argsort(keys)
        self.keys, self.lift = keys[order], lift[order]
        self.weights, self.bias, self.scale = np.zeros(len(keys)), 0.0, (1.0, 0.0)
        # Where the keys with the same leading bits begin, to find a key in
        # few steps: keys are sorted and spread evenly.
        self.shift = np.uint64(64 - max(1, int(len(keys)).bit_length()))
        heads = self.keys >> self.shift
        self.first = np.searchsorted(heads, np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64))
        self.most = int(np.diff(self.first).max(initial=0))

    def ids(self, key: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Known features as numbers, once per owner, by owner."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = self.first[(key >> self.shift).astype(np.int64)]
        for _ in range(self.most - 1):
            at = at + (self.keys[np.minimum(at, len(self.keys) - 1)] < key)
        at = np.minimum(at, len(self.keys) - 1)
        known = self.keys[at] == key
        pairs = np.unique(owner[known].astype(np.int64) * len(self.keys) + at[known])
        return pairs % len(self.keys), pairs // len(self.keys)

    def _scaled(self, ids: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        a, b = self.scale
        return a * (np.bincount(owner, self.weights[ids], n) + self.bias) + b

    def log_odds(self, key: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Calibrated log-odds that a document is good."""
        return self._scaled(*self.ids(key, owner), n)

    def sample_log_odds(self, ids: np.ndarray, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self._scaled(*_take(ids, at, rows), len(rows))

    def fit(self, ids: np.ndarray, at: np.ndarray, rows: np.ndarray, good: np.ndarray) -> None:
        ids, owner = _take(ids, at, rows)
        x, k = self.lift[ids], len(self.keys)
        w = np.zeros(k + 1)  # the last one is the bias
        m, v = np.zeros_like(w), np.zeros_like(w)
        for step in range(1, STEPS + 1):  # Adam on the whole sample
            z = np.bincount(owner, w[ids] * x, len(rows)) + w[-1]
            r = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - good) / len(rows)
            g = np.append(np.bincount(ids, r[owner] * x, k), r.sum()) + L2 * np.append(w[:-1], 0.0)
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            w -= 0.08 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        self.weights, self.bias, self.scale = w[:-1] * self.lift, float(w[-1]), (1.0, 0.0)

    def calibrate(self, ids: np.ndarray, at: np.ndarray, rows: np.ndarray, good: np.ndarray) -> None:
        a, b = platt(self.sample_log_odds(ids, at, rows)[:, None], good)
        self.scale = (float(a), float(b))


def platt(z: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Weights and bias of a small ridge logistic model (Newton)."""
    x = np.column_stack([z, np.ones(len(z))])
    target = np.where(good > 0, (good.sum() + 1) / (good.sum() + 2), 1 / ((1 - good).sum() + 2))
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        w -= np.linalg.solve(h, x.T @ (p - target) + 1e-3 * w)
    return w


class Classifier:
    """The two views and how they combine; small enough to travel with a task."""

    def __init__(self, share: float):
        self.share, self.text, self.meta, self.blend = share, None, None, None

    def scores(self, texts: list, meta: list[list]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of the text view, the metadata view and both."""
        if self.blend is None:
            flat = np.full(len(texts), self.share)
            return flat, flat, np.maximum(flat, ACCEPT)
        out_t, out_m = [], []
        for lo in range(0, len(texts), 256):
            some = texts[lo : lo + 256]
            out_t.append(self.text.log_odds(*text_features(some), len(some)))
            out_m.append(self.meta.log_odds(*meta_features([c[lo : lo + 256] for c in meta]), len(some)))
        t, m = (np.concatenate(x) if x else np.zeros(0) for x in (out_t, out_m))
        both = np.column_stack([t, m, np.ones(len(t))]) @ self.blend
        return tuple(1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (t, m, both))


def fit_views(views: list[View], samples: list, good: np.ndarray, test: np.ndarray) -> Classifier:
    """samples: (feature ids, offsets) of the sample for each view; good: 1, 0
    or -1 (not labelled); test: marks held-out rows, for calibration only."""
    known = good >= 0
    train, held, pool = (np.flatnonzero(x) for x in (known & ~test, known & test, ~known))
    model = Classifier(float(good[known].mean()) if known.any() else 1.0)
    if len(np.unique(good[train])) < 2 or len(np.unique(good[held])) < 2:
        return model
    label = good.astype(float)
    extra = [np.zeros(len(good), bool), np.zeros(len(good), bool)]
    pseudo = [label.copy(), label.copy()]
    for done in range(ROUNDS + 1):
        for i, (view, sample) in enumerate(zip(views, samples)):
            rows = np.concatenate([train, np.flatnonzero(extra[i])])
            view.fit(*sample, rows, pseudo[i][rows])
            view.calibrate(*sample, held, label[held])
        if done == ROUNDS:
            break
        for i, (view, sample) in enumerate(zip(views, samples)):
            p = 1 / (1 + np.exp(-np.clip(view.sample_log_odds(*sample, pool), -30, 30)))
            sure = pool[(p >= CONFIDENT) | (p <= 1 - CONFIDENT)]
            extra[1 - i][sure] = True
            pseudo[1 - i][pool] = (p >= 0.5).astype(float)
    model.text, model.meta = views
    z = np.column_stack([view.sample_log_odds(*sample, held) for view, sample in zip(views, samples)])
    model.blend = platt(z, label[held])
    return model


def _lists(batch: pa.RecordBatch, text: str, meta) -> tuple[list, list[list]]:
    return texts_of(batch, text), [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in meta]


def _feature_rows(text: str, meta):
    """(ord, good) and the distinct features of both views, as longs."""

    def run(batches):
        for batch in slices(batches, text):
            texts, columns = _lists(batch, text, meta)
            views = []
            for features in (text_features(texts), meta_features(columns)):
                key, at = by_text(*features, len(texts))
                views.append(pa.LargeListArray.from_arrays(pa.array(at), pa.array(key.view(np.int64))).cast(pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *views], names=["ord", "good", "t", "m"])

    return run


def _id_rows(views: list[View]):
    """The same rows with the numbers of the features that the views use."""

    def run(batches):
        for batch in batches:
            columns = []
            for i, view in enumerate(views):
                lists = batch.column(2 + i)
                owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                ids, owner = view.ids(lists.flatten().to_numpy().view(np.uint64), owner)
                at = np.searchsorted(owner, np.arange(len(lists) + 1)).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(at), pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["ord", "good", "t", "m"])

    return run


def _view(sample: DataFrame, column: str) -> View:
    """Features of at least MIN_DF training rows that tell good ones from
    others, counted in Spark; the rest of the vocabulary stays there."""
    rows = sample.where(F.col("good") >= 0).where(~_held_out())
    n, n_good = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("good"), F.lit(0))).first()
    lift = F.abs(
        F.ln((F.col("g") + 0.5) / (n_good + 1)) - F.ln((F.col("df") - F.col("g") + 0.5) / (n - n_good + 1))
    )
    kept = (
        rows.select("good", F.explode(column).alias("f"))
        .groupBy("f")
        .agg(F.sum("good").alias("g"), F.count(F.lit(1)).alias("df"))
        .where(F.col("df") >= min(MIN_DF, max(1, n // 20)))
        .select("f", lift.alias("lift"))
        .where(F.col("lift") >= MIN_RATIO)
        .toPandas()
    )
    return View(kept["f"].to_numpy(np.int64).view(np.uint64), kept["lift"].to_numpy(float))


def _held_out():
    return F.pmod(F.xxhash64("ord"), F.lit(5)) == 0


def _order(doc_id: str):
    return F.xxhash64(F.lit("quality-1"), F.col(doc_id))


def _smallest(rows: DataFrame, bound: int, doc_id: str) -> DataFrame:
    """About the ``bound`` rows with the smallest hash: a hash threshold leaves
    few rows per task before the exact limit."""
    n = rows.count()
    part = min(1.0, 1.3 * bound / max(1, n) + 1e-9)
    low = F.lit(int(-(2**63) + part * (2**64 - 1))) if part < 1 else F.lit(2**63 - 1)
    return rows.withColumn("ord", _order(doc_id)).where(F.col("ord") <= low).orderBy("ord").limit(bound)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", meta=META) -> Classifier:
    """Fit on at most LABELLED labelled and POOL unlabelled documents."""
    marked = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(((F.min("quality") == 1) & (F.max("toxic") == 0)).cast("int").alias("good"))
    )
    chosen = _smallest(marked, LABELLED, "doc_id").select(F.col("doc_id").alias("l_id"), "ord", "good")
    ids = docs.select(F.col(doc_id).alias("l_id")).where("l_id IS NOT NULL")
    pool = (
        _smallest(ids, POOL + LABELLED, "l_id")
        .join(marked, F.col("l_id") == F.col("doc_id"), "left_anti")
        .orderBy("ord")
        .limit(POOL)
        .select("l_id", "ord", F.lit(-1).alias("good"))
        .distinct()
    )
    # Bounded by LABELLED + POOL rows of three numbers, so safe to broadcast.
    wanted = F.broadcast(chosen.union(pool))
    # Only the columns used, under names of their own: others may clash.
    named = [f"meta_{i}" for i in range(len(meta))]
    used = docs.select(F.col(doc_id).alias("d_id"), F.col(text).alias("text"), *[F.col(c).alias(n) for c, n in zip(meta, named)])
    sample = scratch(
        used.join(wanted, F.col("d_id") == F.col("l_id"))
        .select("ord", "good", "text", *named)
        .mapInArrow(_feature_rows("text", named), "ord bigint, good int, t array<bigint>, m array<bigint>"),
        "qc-sample",
    )
    views = [_view(sample, c) for c in ("t", "m")]
    rows = (
        sample.mapInArrow(_id_rows(views), "ord bigint, good int, t array<int>, m array<int>")
        .withColumn("test", _held_out())
        .orderBy("ord", "good", "t", "m")
        .toPandas()
    )
    samples = [
        (
            np.concatenate([np.zeros(0, np.int64), *rows[c]]).astype(np.int64),
            np.concatenate([[0], np.cumsum(rows[c].map(len).to_numpy(np.int64))]),
        )
        for c in ("t", "m")
    ]
    return fit_views(views, samples, rows["good"].to_numpy(np.int64), rows["test"].to_numpy(bool))


def score(docs: DataFrame, model: Classifier, doc_id: str = "doc_id", text: str = "text", meta=META) -> DataFrame:
    """doc_id, p_text, p_meta, p_good and accepted for every document."""

    def run(batches):
        for batch in slices(batches, text):
            t, m, p = model.scores(*_lists(batch, text, meta))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(t), pa.array(m), pa.array(p), pa.array(p >= ACCEPT)],
                names=[doc_id, "p_text", "p_meta", "p_good", "accepted"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text, *meta).mapInArrow(
        run, f"`{doc_id}` {kind}, p_text double, p_meta double, p_good double, accepted boolean"
    )


def keep_accepted(docs: DataFrame, model: Classifier, text: str = "text", meta=META) -> DataFrame:
    """The accepted documents, all columns untouched."""

    def run(batches):
        for batch in slices(batches, text):
            yield batch.filter(pa.array(model.scores(*_lists(batch, text, meta))[2] >= ACCEPT))

    return docs.mapInArrow(run, docs.schema)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
