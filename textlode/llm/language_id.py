"""Language identification by sparse multinomial logistic regression.

Features are the hashed character n-grams (1 to 3 code points) of the
lower-cased text in which every run of other characters than letters and
their marks is one space.  Their values are log(1 + count) * idf, scaled to unit length; document
frequencies are counted over all documents learned from.  The weights are fitted by
follow-the-regularised-leader with elastic-net penalties on a sample of at most
``per_label`` documents of each label, those of the smallest hash; a fifth of
it is held back to calibrate the temperature of the softmax.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _kernels as K
from ._columns import packed_rows, with_results
from ._ftrl import Ftrl, Rows, smallest_by_hash, softmax, temperature
from ..sources.staging import small_batches

FEATURES = 1 << 15
ORDERS = 3
#: Most documents of one label that are fitted.
PER_LABEL = 600
EPOCHS, BATCH = 4, 32
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-3
UNDETERMINED = "und"
RESULTS = ("lang_pred", "score")


def id_remainder(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids give null."""
    return F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % modulus


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Per code point 2 for letters, 1 for marks, which stay with their letters, else 0."""
    table = np.zeros(sys.maxunicode + 2, dtype=np.uint8)
    for c in range(sys.maxunicode + 1):
        if c >= 0x32400 and c < 0xE0000:  # no character is assigned here
            continue
        table[c] = {"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0)
    return table


def slice_grams(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per order the hashed n-grams of all texts, one per place, and each text's first (n+1); texts without letters have none."""
    low = [t.lower() for t in texts]
    code = np.frombuffer(" ".join(["", *low, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    edge = np.concatenate(([0], np.cumsum([len(t) + 1 for t in low]))).astype(np.int64)  # the space before each text, and the last
    kind = _letters()[code]
    letter = kind > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[edge] = True
    place = np.concatenate(([0], np.cumsum(keep)))
    kept = np.where(letter, code, np.uint32(32))[keep]
    first = place[edge]  # of the space before each text, and of the last
    has = np.add.reduceat(kind[:-1] == 2, edge[:-1], dtype=np.int64) > 0 if len(low) else np.zeros(0, dtype=bool)
    out, run = [], np.zeros(len(kept), dtype=np.uint32)
    with np.errstate(over="ignore"):
        for order in range(1, ORDERS + 1):
            run = run[: len(kept) - order + 1] * np.uint32(0x01000193) + kept[order - 1 :]
            mixed = (run ^ (run >> np.uint32(15)) ^ np.uint32(order * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            mixed = (mixed ^ (mixed >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> np.uint32(32 - 15)
            # single places leave out the last space, longer runs end with it at the latest
            begin, end = first[:-1], np.where(has, np.maximum(first[1:] - max(order - 2, 0), first[:-1]), first[:-1])
            out.append((mixed, np.stack((begin, end), axis=1)))
    return out


def counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, count) of a slice of texts, ascending."""
    found = slice_grams(texts)
    features, counts = [], []
    for k in range(len(texts)):
        own = np.concatenate([mixed[span[k, 0] : span[k, 1]] for mixed, span in found])
        if len(own) < 2000:
            feature, n = np.unique(own, return_counts=True)
        else:
            n = np.bincount(own, minlength=FEATURES)
            feature = np.flatnonzero(n)
            n = n[feature]
        features.append(feature)
        counts.append(n)
    owner = np.repeat(np.arange(len(texts)), [len(f) for f in features])
    cat = lambda x: np.concatenate(x or [np.zeros(0)]).astype(np.int64)
    return owner, cat(features), cat(counts)


def text_slices(column: pa.Array, limit: int = K.SLICE_BYTES // 4):
    """Lists of texts of bounded total length (or of one text); null reads as empty."""
    some, size = [], 0
    for value in column:
        text = value.as_py() or ""
        if some and size + len(text) > limit:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some


def _frequencies(batches):
    total, docs = np.zeros(FEATURES + 1, dtype=np.int64), 0
    for batch in batches:
        for texts in text_slices(batch.column(0)):
            total[:FEATURES] += np.bincount(counted(texts)[1], minlength=FEATURES)
            docs += len(texts)
    total[FEATURES] = docs
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["feature", "df"])


def _count_rows(batches):
    for batch in batches:
        rows = []
        for texts in text_slices(batch.column(1)):
            owner, feature, n = counted(texts)
            cut = np.searchsorted(owner, np.arange(1, len(texts)))
            rows += [*zip(np.split(feature, cut), np.split(n, cut), strict=True)]
        lists = [pa.array([r[k] for r in rows], pa.list_(pa.int32())) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *lists], ["label", "fold", "features", "counts"])


class Model:
    """Labels, idf, weights and temperature; small enough to go with every task."""

    def __init__(self, labels: list[str], idf: np.ndarray, weights: np.ndarray, bias: np.ndarray, temp: float):
        self.labels, self.idf, self.weights, self.bias, self.temp = labels, idf, weights, bias, temp

    def values(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf[features]
        return x / np.sqrt((x * x).sum()) if len(x) else x

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Label and score of each text; ties go to the label that sorts first."""
        owner, feature, n = counted(texts)
        value = np.log1p(n) * self.idf[feature]
        length = np.sqrt(np.bincount(owner, weights=value * value, minlength=len(texts)))
        known = length > 0
        if not self.labels or not known.any():
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        value /= length[owner]
        logits = np.stack([np.bincount(owner, weights=value * self.weights[feature, k], minlength=len(texts)) for k in range(len(self.labels))], axis=1) + self.bias
        p = softmax(logits / self.temp)
        best = p.argmax(axis=1)
        return [self.labels[b] if ok else UNDETERMINED for b, ok in zip(best, known, strict=True)], np.where(known, p[np.arange(len(texts)), best], 0.0)


def fit(docs: DataFrame, label_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", per_label: int = PER_LABEL) -> Model:
    """Fit on the rows of ``docs`` with a label; all of them count in the document frequencies.

    Rows without a text or a label are left out; without any, the model knows
    no label.  The sample is ordered by a hash of id and text, then by the
    text; repeated rows are fitted as often as they are chosen.  Other columns
    are ignored.
    """
    small_batches(docs.sparkSession)
    text, label = F.col(f"`{text_col}`").alias("text"), F.col(f"`{label_col}`").alias("label")
    rows = docs.select(text, label, F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("h")).where("label is not null and text is not null")
    df = np.zeros(FEATURES + 1, dtype=np.float64)
    for r in rows.select("text").mapInArrow(_frequencies, "feature bigint, df bigint").groupBy("feature").agg(F.sum("df").alias("df")).collect():
        df[r.feature] = r.df
    idf = np.log((df[FEATURES] + 1) / (df[:FEATURES] + 1)) + 1
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}  # one row per label, as the model has one
    sample = smallest_by_hash(rows, "label", sizes, per_label, F.col("text")).select("label", "text", F.col("rank").cast("int").alias("fold"))
    got = sample.mapInArrow(_count_rows, "label string, fold int, features array<int>, counts array<int>").toArrow()
    if not got.num_rows:
        return Model([], idf, np.zeros((FEATURES, 0)), np.zeros(0), 1.0)
    labels = sorted(set(got.column("label").to_pylist()))
    blank = Model(labels, idf, np.zeros((FEATURES, len(labels))), np.zeros(len(labels)), 1.0)
    order = np.lexsort((got.column("label").to_numpy(), got.column("fold").to_numpy()))
    bias = FEATURES  # one more feature, always 1
    pairs = [(got.column("features")[int(i)].values.to_numpy(), got.column("counts")[int(i)].values.to_numpy()) for i in order]
    data = Rows([np.append(f, np.int32(bias)) for f, _ in pairs], [np.append(blank.values(f, c), 1.0).astype(np.float32) for f, c in pairs])
    names = got.column("label").to_pylist()
    target = np.array([labels.index(names[int(i)]) for i in order])
    held = (got.column("fold").to_numpy()[order] % 5) == 0
    del pairs, got
    learner = Ftrl(FEATURES + 1, len(labels), ALPHA, BETA, L1, L2)
    rng = np.random.default_rng(17)
    train = np.flatnonzero(~held)
    for _ in range(EPOCHS):
        rng.shuffle(train)
        for s in range(0, len(train), BATCH):
            rows_ = train[s : s + BATCH]
            batch = data.batch(rows_)
            w = learner.weights(batch.used)
            error = softmax(batch.scores(w))
            error[np.arange(len(rows_)), target[rows_]] -= 1
            learner.step(batch.used, w, batch.gradient(error) / len(rows_))
    weights = learner.weights()
    back = np.flatnonzero(held)
    logits = np.zeros((len(back), len(labels)))
    for s in range(0, len(back), 64):
        batch = data.batch(back[s : s + 64])
        logits[s : s + 64] = batch.scores(weights[batch.used])
    return Model(labels, idf, weights[:FEATURES].astype(np.float32), weights[bias], temperature(logits, target[back]))


def _predict(model: Model):
    def run(batches):
        for batch in batches:
            labels, scores = [], []
            for texts in text_slices(batch.column(0)):
                found, score = model.predict(texts)
                labels += found
                scores.append(score)
            rows = [batch.column(c) for c in range(1, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*rows, pa.array(labels, pa.string()), pa.array(np.concatenate(scores or [np.zeros(0)]))], [*batch.schema.names[1:], *RESULTS])

    return run


def identify(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (all if None) and lang_pred, score of every whole text.

    A null text, or one without letters (marks alone are none), is ``und`` with
    score 0, as is every text if nothing could be learned.  Ties go to the
    label that sorts first.  Repeated rows get the same result, an empty table
    gives an empty one.  Input columns named like results, in any case, are
    replaced by them.
    """
    small_batches(docs.sparkSession)
    rows = packed_rows(docs, text_col, RESULTS, carry)
    return rows.mapInArrow(_predict(model), with_results(rows, lang_pred="string", score="double")).select("_row.*", *RESULTS)
