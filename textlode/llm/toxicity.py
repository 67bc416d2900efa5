"""Toxicity by a counterfactually regularised classifier.

A logistic regression over the words of a text (letters and digits, ASCII
lower-cased, hashed) and their beginnings, which stand for inflected and
compound forms, each with the value log(1 + count), fitted by
follow-the-regularised-leader with L1, so that words without evidence get no
weight.  Every labelled text that names an identity term has a counterfactual
in which the term is replaced by another of its language; the squared change of
the logit is added to the loss.  So a term that often
stands near abuse gets no weight of its own, and neutral mentions of a group
stay neutral.  Fitted on a sample of at most ``per_class`` labelled documents
of each class, those of the smallest hash, with weights that restore the share
of each class among all labelled rows.  The terms are a parameter, by language;
the fitted model says in how many of its rows one was found (``swapped``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _kernels as K
from ._columns import packed_rows, with_results
from ._ftrl import Ftrl, Rows, smallest_by_hash
from ..sources.staging import small_batches

FEATURES = 1 << 18
#: Most documents of one class that are fitted.
PER_CLASS = 2000
#: Lengths in bytes of the word beginnings that are features too.
PREFIXES = (3, 4, 5, 6, 7, 8)
EPOCHS, BATCH = 6, 32
ALPHA, BETA, L1, L2 = 0.5, 1.0, 4.0, 1e-3
#: Weight of the squared change of a logit under a swap.
COUNTERFACTUAL = 1.0
#: Terms that name groups of people, by language (fixed values), each swapped for the others of its language.
IDENTITY_TERMS = {
    "en": (
        "african", "american", "arab", "asian", "atheist", "black", "blind", "buddhist", "catholic", "chinese", "christian", "deaf",
        "disabled", "elderly", "european", "female", "feminist", "gay", "german", "heterosexual", "hindu", "hispanic", "homosexual",
        "immigrant", "immigrants", "indian", "japanese", "jew", "jewish", "jews", "latina", "latino", "lesbian", "lgbt", "male", "man",
        "men", "mexican", "migrant", "migrants", "muslim", "muslims", "old", "protestant", "queer", "refugee", "refugees", "sikh",
        "straight", "trans", "transgender", "white", "woman", "women", "young",
    ),
    "es": ("africano", "africana", "árabe", "asiático", "ateo", "budista", "católico", "chino", "cristiano", "extranjero", "feminista", "gitano", "hindú", "hombre", "homosexual", "inmigrante", "inmigrantes", "judío", "judíos", "lesbiana", "migrante", "mujer", "mujeres", "musulmán", "musulmanes", "negro", "refugiado", "refugiados", "transexual"),
    "fr": ("africain", "africaine", "arabe", "asiatique", "athée", "bouddhiste", "catholique", "chinois", "chrétien", "étranger", "féministe", "femme", "femmes", "gitan", "hindou", "homme", "homosexuel", "immigré", "immigrés", "juif", "juifs", "lesbienne", "migrant", "musulman", "musulmans", "noir", "réfugié", "réfugiés", "transsexuel"),
    "de": ("afrikaner", "araber", "asiate", "atheist", "ausländer", "behinderte", "buddhist", "chinese", "christ", "christen", "feministin", "flüchtling", "flüchtlinge", "frau", "frauen", "hindu", "homosexueller", "jude", "juden", "katholik", "lesbe", "mann", "männer", "migrant", "migranten", "moslem", "muslim", "muslime", "türke"),
    "pt": ("africano", "africana", "árabe", "asiático", "ateu", "budista", "católico", "chinês", "cigano", "cristão", "estrangeiro", "feminista", "hindu", "homem", "homossexual", "imigrante", "imigrantes", "judeu", "judeus", "lésbica", "migrante", "muçulmano", "muçulmanos", "mulher", "mulheres", "negro", "refugiado", "refugiados", "transexual"),
}
RESULTS = ("score", "predicted")


def token_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all tokens, one row per token (-1: none), and the first-token index of each text (n+1)."""
    low = K.lower_ascii(data)
    solid = (low >= 128) | ((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57))
    starts, ends, first = K.word_spans(np.where(solid, low, np.uint8(32)), offsets)
    pre = K.prefix(low.astype(K.U64) + K.U64(1), K.BYTE_BASE)
    out = np.full((len(starts), 1 + len(PREFIXES)), -1, dtype=np.int32)
    for c, size in enumerate((0, *PREFIXES)):
        some = np.flatnonzero(ends - starts > size)
        stop = starts[some] + size if size else ends
        out[some, c] = (K.mix64(K.span_hash(pre, starts[some], stop, K.BYTE_BASE), c) & K.U64(FEATURES - 1)).astype(np.int32)
    return out, first


def counted(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of some tokens and their counts."""
    out, n = np.unique(found, return_counts=True)
    return out[out >= 0].astype(np.int64), n[out >= 0]


def features_of(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features of each text and their counts."""
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    found, first = token_features(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)
    return [counted(found[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]


def _feature_rows(batches):
    for batch in batches:
        data, offsets = K.buffers(batch.column(1))
        pairs = []
        for i, j in K.slices(offsets):
            found, first = token_features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            pairs += [counted(found[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
        lists = [pa.array([p[k].astype(np.int32) for p in pairs], pa.list_(pa.int32())) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *lists], ["toxic", "features", "counts"])


class Model:
    """Weights of features and the bias; numbers of fitted rows and of those with a counterfactual."""

    def __init__(self, weights: np.ndarray, bias: float, fitted: int = 0, swapped: int = 0):
        self.fitted, self.swapped = fitted, swapped
        self.at = np.flatnonzero(weights)
        self.values = weights[self.at].astype(np.float64)
        self.bias = bias

    def dense(self) -> np.ndarray:
        out = np.zeros(FEATURES)
        out[self.at] = self.values
        return out


Features = tuple[np.ndarray, np.ndarray]


Terms = dict[str, tuple[str, ...]]


class Swaps:
    """Identity terms as features: the word itself and its beginnings, and the group of terms that may replace it."""

    def __init__(self, terms: Terms | None = None):
        groups = [tuple(dict.fromkeys(g)) for g in (IDENTITY_TERMS if terms is None else terms).values()]
        groups = [g for g in groups if len(g) > 1]
        raw = [t.encode() for g in groups for t in g]
        self.all = [r[r >= 0].astype(np.int64) for r in (token_features(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0][0] for t in raw)]
        word = np.array([r[0] for r in self.all], dtype=np.int64)
        self.group = [(sum(map(len, groups[:i])), len(g)) for i, g in enumerate(groups) for _ in g]
        self.words, self.term = np.unique(word, return_index=True)  # a term of two languages is one of the first

    def swap(self, features: np.ndarray, counts: np.ndarray, rng: np.random.Generator) -> Features | None:
        """The features with every identity term replaced by another one, or None if there is none."""
        at = np.flatnonzero(np.isin(features, self.words))
        if not len(at):
            return None
        ids, change = [features], [counts.astype(np.float64)]
        for k in at:
            old = int(self.term[np.searchsorted(self.words, features[k])])
            start, size = self.group[old]
            new = start + (old - start + int(rng.integers(1, size))) % size
            for term, sign in ((old, -1.0), (new, 1.0)):
                ids.append(self.all[term])
                change.append(np.full(len(self.all[term]), sign * counts[k]))
        every, place = np.unique(np.concatenate(ids), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(change))
        return every[total > 0], total[total > 0]


def _rows(pairs: list[Features]) -> Rows:
    """Rows of log counts and a bias."""
    return Rows([np.append(f, FEATURES) for f, _ in pairs], [np.append(np.log1p(n), 1.0) for _, n in pairs])


def fit_rows(features: list[Features], toxic: np.ndarray, weight: np.ndarray, counterfactual: float = COUNTERFACTUAL, terms: Terms | None = None) -> Model:
    """Fit on features with counts, 0/1 labels and row weights."""
    swaps = Swaps(terms)
    named = np.array([bool(np.isin(f, swaps.words).any()) for f, _ in features], dtype=bool)
    rng = np.random.default_rng(23)
    bias = FEATURES
    data = _rows(features)
    learner = Ftrl(FEATURES + 1, 1, ALPHA, BETA, L1, L2)
    order = np.arange(len(features))
    for _ in range(EPOCHS):
        rng.shuffle(order)
        for s in range(0, len(order), BATCH):
            rows = order[s : s + BATCH]
            other = [swaps.swap(*features[r], rng) if named[r] else None for r in rows]
            pair = np.array([k for k, o in enumerate(other) if o is not None], dtype=np.int64)
            batch = data.batch(rows, _rows([other[k] for k in pair]) if len(pair) else None)
            free = (batch.used == bias)[:, None]
            w = np.where(free, learner.weights(batch.used, l1=0.0), learner.weights(batch.used))
            logit = batch.scores(w)[:, 0]
            error = np.zeros(batch.n)
            error[: len(rows)] = weight[rows] * (1 / (1 + np.exp(-np.clip(logit[: len(rows)], -40, 40))) - toxic[rows])
            change = 2 * counterfactual * (logit[pair] - logit[len(rows) :])
            error[pair] += change
            error[len(rows) :] = -change
            learner.step(batch.used, w, batch.gradient(error[:, None]))
    weights = learner.weights()[:, 0]
    return Model(weights[:bias], float(learner.weights(np.array([bias]), l1=0.0)[0, 0]), len(features), int(named.sum()))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS, terms: Terms | None = None) -> Model:
    """Fit on the documents that ``labels`` marks; repeated labels of an id count as toxic if one is.

    Only ids chosen from the labels (at most ``per_class`` of each class) are
    sent to the documents, so this broadcast has a fixed bound, and one row per
    id comes back: of rows that repeat an id the one of the least text.  Null
    ids and labels are left out, null texts are empty, other columns are
    ignored; without labelled documents nothing is learned.
    """
    spark = docs.sparkSession
    small_batches(spark)
    key, mark = F.col(f"`{id_col}`"), F.col(f"`{label_col}`")
    marks = labels.where(mark.isNotNull() & key.isNotNull()).groupBy(key.alias("id")).agg(F.max(mark.cast("int")).alias("toxic"))
    share = {r.toxic: r["count"] for r in marks.groupBy("toxic").count().collect()}
    chosen = smallest_by_hash(marks.withColumn("h", F.xxhash64("id")), "toxic", share, per_class, F.col("id")).select("id", "toxic")
    texts = docs.select(key.alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    one = texts.join(F.broadcast(chosen), "id").groupBy("id", "toxic").agg(F.min("text").alias("text"))
    got = one.select("toxic", "text").mapInArrow(_feature_rows, "toxic int, features array<int>, counts array<int>").toArrow()
    if not got.num_rows:
        return Model(np.zeros(FEATURES), 0.0)
    features = [(f.values.to_numpy(), n.values.to_numpy()) for f, n in zip(got.column("features"), got.column("counts"), strict=True)]
    toxic = got.column("toxic").to_numpy().astype(np.float64)
    order = np.array(sorted(range(len(features)), key=lambda r: (toxic[r], features[r][0].tobytes(), features[r][1].tobytes())))
    features, toxic = [features[r] for r in order], toxic[order]
    seen = {c: max(1.0, float((toxic == c).sum())) for c in (0, 1)}
    total = sum(share.values())
    weight = np.array([share.get(int(c), 0) / total * len(toxic) / seen[int(c)] for c in toxic])
    return fit_rows(features, toxic, weight, terms=terms)


def _score(model: Model):
    def run(batches):
        dense = model.dense()
        live = np.append(dense != 0, False)  # the last place, read as -1, is no feature
        for batch in batches:
            data, offsets = K.buffers(batch.column(0))
            out = []
            for i, j in K.slices(offsets):
                found, first = token_features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                token, column = np.nonzero(live[found])
                doc = np.searchsorted(first, token, side="right") - 1
                both, n = np.unique(doc * FEATURES + found[token, column], return_counts=True)
                logit = np.bincount(both // FEATURES, weights=dense[both % FEATURES] * np.log1p(n), minlength=j - i) + model.bias
                out.append(1 / (1 + np.exp(-np.clip(logit, -40, 40))))
            score = np.concatenate(out or [np.zeros(0)])
            rows = [batch.column(c) for c in range(1, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*rows, pa.array(score), pa.array((score >= 0.5).astype(np.int32))], [*batch.schema.names[1:], *RESULTS])

    return run


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (all if None), score (0 to 1) and predicted (1 from 0.5 on) of every whole text.

    Null and empty texts get the score of no words, repeated rows the same
    score.  A model fitted on no labels scores 0.5 for all.  An empty table gives
    an empty one.  Input columns named like results, in any case, are replaced.
    """
    small_batches(docs.sparkSession)
    rows = packed_rows(docs, text_col, RESULTS, carry)
    return rows.mapInArrow(_score(model), with_results(rows, score="double", predicted="integer")).select("_row.*", *RESULTS)
