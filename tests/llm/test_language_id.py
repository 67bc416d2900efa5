import zlib

import numpy as np
import pytest

from textlode.llm import language_id as L


def test_query_learns_and_holds_out(spark):
    from textlode.llm.queries import op4_language_id

    d = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang").collect()}
    got = op4_language_id(spark, d).collect()
    assert sorted(r.doc_id for r in got) == sorted(truth)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out]
    assert np.mean(held) > 0.98
    assert sorted(map(tuple, op4_language_id(spark, d).collect())) == sorted(map(tuple, got))


def test_edge_cases(spark):
    train = [(k, "the cat and the dog " * 3 if k % 2 else "le chat et le chien ", ["fr", "en"][k % 2]) for k in range(40)]
    model = L.fit(spark.createDataFrame([*train, (99, None, "fr"), (98, "xx", None)], "doc_id long, text string, lang string"))
    rows = [(1, None, "a"), (2, "", "b"), (3, "12 % \n 3", None), (4, "THE DOG", "z"), (4, "THE DOG", "z"), (None, "le chien " * 20000, "q"), (5, "日本語", "q")]
    out = L.identify(spark.createDataFrame(rows, "doc_id long, text string, score string"), model)
    assert out.columns == ["doc_id", "text", "lang_pred", "score"]
    got = [r.lang_pred for r in out.collect()]
    assert got[:6] == ["und", "und", "und", "en", "en", "fr"] and got[6] in ("en", "fr")
    assert [r.score for r in out.collect()][:3] == [0, 0, 0]


def test_nothing_to_learn_and_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = L.fit(empty)
    assert L.identify(empty, model).count() == 0
    assert L.identify(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), model).first().lang_pred == "und"


def test_the_sample_is_bounded_and_the_statistics_are_not(spark):
    rows = [(k, f"word{k % 7} " + "ab " * (k % 3), "en" if k % 5 else "fr") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    a, b = L.fit(df, per_label=5), L.fit(df, per_label=50)
    assert np.array_equal(a.idf, b.idf)


@pytest.mark.parametrize("t", [0.3, 1.0, 4.0])
def test_temperature_is_found(t):
    rng = np.random.default_rng(0)
    logits = rng.normal(0, 2, (4000, 3))
    p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    labels = np.array([rng.choice(3, p=q) for q in p])
    from textlode.llm._ftrl import temperature

    assert abs(np.log(temperature(logits * t, labels) / t)) < 0.15


def plain_grams(text):
    """n-grams of 1 to 3 letters or spaces of the lower-cased text, with counts."""
    import unicodedata

    out, code, space = {}, [" "], True
    for c in text.lower():
        if unicodedata.category(c)[0] in "LM":
            code.append(c)
            space = False
        elif not space:
            code.append(" ")
            space = True
    if not any(unicodedata.category(c)[0] == "L" for c in text.lower()):
        return {}
    code.append(" ")
    for order in (1, 2, 3):
        for i in range(len(code) - order + 1):
            if order == 1 and i == len(code) - 1:
                continue
            gram = "".join(code[i : i + order])
            out[gram] = out.get(gram, 0) + 1
    return out


TEXTS = ["", "12 % \n 3", "a", "The  Dog, 12 cats!", "İstanbul'da ɐʇ", "日本語 と 中文", "́̂", "x́y", "é" * 30, "ab " * 500, " lead", "𝒳 math", "नमस्ते दुनिया"]


def test_counts_of_slices_equal_a_plain_version():
    owner, feature, n = L.counted(TEXTS)
    for k, t in enumerate(TEXTS):
        want = plain_grams(t)
        assert n[owner == k].sum() == sum(want.values()), t
        alone = L.counted([t])
        assert np.array_equal(alone[1], feature[owner == k]) and np.array_equal(alone[2], n[owner == k]), t
        assert len(feature[owner == k]) <= len(want) and len(feature[owner == k]) >= 0.98 * len(want), t  # two n-grams may share a feature


def test_letters_are_what_unicode_calls_letters(spark):
    train = spark.createDataFrame([(k, ["the cat", "le chat"][k % 2], ["en", "fr"][k % 2]) for k in range(20)], "doc_id long, text string, lang string")
    model = L.fit(train)
    for text, known in (("́̂", False), ("⃝", False), ("̀a", True), ("\U0002fa1e", False), ("\U00020000", True), ("ª", True), ("٣", False)):
        assert (model.predict([text])[0][0] != "und") == known, hex(ord(text[0]))


def plain_fit(rows, labels, target, held):
    """Follow-the-regularised-leader on rows of {feature: value}, one coordinate and class at a time."""
    z, n = {}, {}

    def value(f, c):
        a = z.get((f, c), 0.0)
        return 0.0 if abs(a) <= L.L1 else -(a - np.sign(a) * L.L1) / ((L.BETA + n.get((f, c), 0.0) ** 0.5) / L.ALPHA + L.L2)

    def probability(x, t=1.0):
        s = np.array([sum(v * value(f, c) for f, v in x.items()) for c in range(len(labels))]) / t
        e = np.exp(s - s.max())
        return e / e.sum()

    rng, train = np.random.default_rng(17), np.flatnonzero(~held)
    for _ in range(L.EPOCHS):
        rng.shuffle(train)
        for s in range(0, len(train), L.BATCH):
            batch, g = train[s : s + L.BATCH], {}
            for r in batch:
                error = probability(rows[r]) - (np.arange(len(labels)) == target[r])
                for f, v in rows[r].items():
                    for c in range(len(labels)):
                        g[f, c] = g.get((f, c), 0.0) + v * error[c] / len(batch)
            old = {k: value(*k) for k in g}
            for k, d in g.items():
                m = n.get(k, 0.0)
                z[k] = z.get(k, 0.0) + d - ((m + d * d) ** 0.5 - m**0.5) / L.ALPHA * old[k]
                n[k] = m + d * d
    grid = np.exp(np.linspace(np.log(0.02), np.log(20.0), 120))
    back = np.flatnonzero(held)
    temp = min(grid, key=lambda t: -np.mean([np.log(max(probability(rows[r], t)[target[r]], 1e-12)) for r in back]))
    return lambda x: probability(x, temp)


def test_fit_and_scores_equal_a_plain_version(spark):
    words = {"en": "the cat and dog sat on it".split(), "es": "el gato y perro en la casa".split(), "fr": "le chat et chien dans une maison".split()}
    rng = np.random.default_rng(3)
    docs = [(k, " ".join(rng.choice(words[lang], 6)), lang) for k in range(45) for lang in [sorted(words)[k % 3]]]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = L.fit(df)
    from pyspark.sql import functions as F

    hashes = {r.doc_id: r.h for r in df.select("doc_id", F.xxhash64("doc_id", "text").alias("h")).collect()}
    rank = {k: 1 + sum((hashes[j], t2) < (hashes[k], t) and l2 == lang for j, t2, l2 in docs) for k, t, lang in docs}
    order = sorted(docs, key=lambda d: (rank[d[0]], d[2]))
    frequency = {}
    counts = {t: dict(zip(*L.counted([t])[1:], strict=True)) for _, t, _ in docs}
    for _, t, _ in docs:
        for f in counts[t]:
            frequency[f] = frequency.get(f, 0) + 1

    def vector(c):
        x = {f: np.log1p(n) * (np.log((len(docs) + 1) / (frequency.get(f, 0) + 1)) + 1) for f, n in c.items()}
        size = sum(v * v for v in x.values()) ** 0.5
        return {f: v / size for f, v in x.items()} | {"bias": 1.0}

    labels = sorted(words)
    score = plain_fit([vector(counts[t]) for _, t, _ in order], labels, [labels.index(lang) for *_, lang in order], np.array([rank[k] % 5 == 0 for k, *_ in order]))
    for text in ["the cat", "una casa et le chien", "dog", *[t for _, t, _ in docs[:6]]]:
        p = score(vector(dict(zip(*L.counted([text])[1:], strict=True))))
        got, value = model.predict([text])
        assert got[0] == labels[int(p.argmax())] and abs(value[0] - p.max()) < 1e-3
