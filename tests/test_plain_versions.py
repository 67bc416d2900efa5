"""Queries without SQL against plain Python versions over the whole smallest table."""

import hashlib
import re
from collections import Counter, defaultdict
from html.parser import HTMLParser

import pytest

from textlode.functions import text as T
from textlode.functions import unicode as U
from textlode.operators import packing as P
from textlode.operators import segmentation as S
from textlode.plans import catalog

from .test_hard_limit import plain as plain_splits
from .test_packing import additive
from .test_relations_and_quality import brute_matches

D = "/root/testdata/sf0.001"


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def run(spark, name):
    return sorted((tuple(r) for r in catalog.queries()[name](spark, D).collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]


def units_of(text):
    return [u for u in (x.strip() for x in re.split(r"(?<=[.!?…])\s+", text)) if u]


@pytest.fixture(scope="module")
def chunks(docs):
    """(doc_id, lang, position, text, tokens) of additive packing."""
    return [(k, lang, i, t, n) for k, text, lang, _ in docs if text is not None for i, (t, n) in enumerate(additive(units_of(text), 256, 32, 0))]


def named(k, i):
    return f"{k}-chunk-{i:04d}"


def test_packers(spark, docs, chunks):
    assert run(spark, "pack_additive") == sorted(((k, named(k, i), i, n, md5(t)) for k, _, i, t, n in chunks), key=str)
    count = lambda t: len(t.split())
    want = [(k, named(k, i), i, count(t), md5(t)) for k, text, *_ in docs if text is not None for i, t in enumerate(P.pack_with_counter(units_of(text), count, 256, 32))]
    assert run(spark, "pack_scalar") == sorted(want, key=str)


def test_statistics_of_chunks(spark, chunks):
    by = defaultdict(list)
    for _, lang, _, _, n in chunks:
        by[lang].append(n)
    want = [(g, len(v), min(v), round(sum(v) / len(v), 6), sum(v), sum(n <= 256 for n in v), sum(256 < n <= 510 for n in v), sum(n > 510 for n in v), max(v)) for g, v in by.items()]
    assert run(spark, "chunk_summary") == sorted(want, key=str)
    want = [(g, sum(n / 256 < 0.25 for n in v), sum(n / 256 < 0.5 for n in v), sum(0.9 < n / 256 <= 1 for n in v)) for g, v in by.items()]
    assert run(spark, "util_bands") == sorted(want, key=str)
    want = [(named(k, i), "over_limit") for k, _, i, _, n in chunks if n > 510] + [(named(k, i), "no_tokens") for k, _, i, _, n in chunks if n <= 0]
    assert run(spark, "chunk_violations") == sorted(want, key=str)


def alpha(word):
    return any(c.isalpha() for c in word)


def upper_share(words):
    lettered = [w for w in words if alpha(w)]
    return sum(w.strip(".,:;()[]").isupper() for w in lettered) / len(lettered) if lettered else 0.0


def shared_words(a, b):
    return next((n for n in range(min(len(a), len(b), 80), 0, -1) if a[-n:] == b[:n]), 0)


def cuts_sentence(left, right):
    a = left.split()
    fresh = " ".join(right.split()[shared_words(a, right.split()) :])
    prose = len(a) >= 8 and sum(map(alpha, a)) / len(a) >= 0.6
    structural = len(a) <= 12 or (len(a) <= 40 and any(map(alpha, a)) and upper_share(a) >= 0.7)
    first = next((c for c in fresh if c.isalpha()), "")
    goes_on = first.islower() or (a and a[-1].casefold().strip(".,;:!?…()[]{}\"'”’»-") in T.CONNECTORS) or left.rstrip().endswith((",", "-", "–"))
    return bool(prose and fresh and not structural and not re.search(r"[.!?…][\"'”’»)\]}]*$", left.rstrip()) and goes_on)


def test_audits_of_neighbours(spark, chunks):
    pairs = [(k, i, shared_words(a.split(), t.split()), cuts_sentence(a, t)) for (j, _, _, a, _), (k, _, i, t, _) in zip(chunks, chunks[1:], strict=False) if j == k]
    assert run(spark, "adjacent_audit") == sorted(pairs, key=str)
    shared, words = [p[2] for p in pairs], sum(len(c[3].split()) for c in chunks)
    want = (len(pairs), sum(n > 0 for n in shared), round(sum(shared) / len(shared), 6), sum(p[3] for p in pairs), round(sum(shared) / words, 6))
    assert run(spark, "overlap_report") == [want]


def test_sentences_are_not_lost(spark, docs, chunks):
    said = Counter((k, u) for k, text, *_ in docs if text is not None for u in units_of(text))
    kept = Counter((k, u) for k, _, _, t, _ in chunks for u in units_of(t))
    assert run(spark, "sentence_loss") == [(sum(kept[x] < n for x, n in said.items()), sum(said.values()))]


def is_structural(text):
    """Each reason by itself, in Python's regular expressions."""
    count = lambda p, flags=0: len(re.findall(p, text, flags))
    words = text.split()
    bullets = count(r"(?:^|\s)[•▪◦●]\s*")
    blob = "".join(re.findall(r"[A-Za-z0-9_%!+=/-]{40,}", text))
    return (
        count(r"\b(?:SELECT|FROM|JOIN|WHERE|GROUP\s+BY|ORDER\s+BY|UNION|ON)\b", re.I) >= 4
        or count(r"(?:^|\s)(?:\(?[a-zivx]+\)|\(\d+\))(?=\s|[,;:])", re.I) >= 8
        or bullets >= 4
        or (bullets >= 1 and re.search(r"\[Pagina\s+\d+\]", text, re.I) and len(words) >= 100)
        or count(r"\b(?:AND|OR|NOT)\b|\[[^\]]{1,80}\]", re.I) >= 12
        or count(r"(?:https?://|www\.)", re.I) >= 4
        or (len(blob) >= 400 and re.search(r"\d", blob) and re.search("[_%!+=/-]", blob))
        or (len(words) >= 100 and (text.count(",") >= 20 or text.count(";") >= 8))
        or (sum(map(alpha, words)) >= 40 and upper_share(words) >= 0.7)
    )


def test_structural_texts_and_long_units(spark, docs):
    assert run(spark, "structural_oversize") == sorted(((k, bool(is_structural(t))) for k, t, *_ in docs if t is not None), key=str) + [(k, None) for k, t, *_ in docs if t is None]
    long = [(k, len(u.split()), "STRUCTURAL_MULTI_UNIT" if is_structural(u) else "AMBIGUOUS") for k, t, *_ in docs if t is not None for u in units_of(t) if len(u.split()) > 510]
    assert run(spark, "preflight_units") == sorted(long, key=str)


def test_splits_and_sentences(spark, docs):
    from textlode.operators.hard_limit import WhitespaceCounter

    got = defaultdict(list)
    for k, strategy, i, n, tokens, start, end, emitted, digest in run(spark, "hard_splits"):
        got[k].append((i, strategy, n, tokens, start, end, emitted, digest))
    for k, text, *_ in docs:
        if not text or len(text) > 30_000:  # the plain version tries every place
            continue
        name, parts = plain_splits(text, "txt", WhitespaceCounter(), 510, 32) if len(text.split()) > 510 else ("unchanged", [(0, len(text), 0)])
        assert sorted(got[k]) == [(i, name, len(parts), len(text[e:b].split()), a, b, e, md5(text[e:b])) for i, (a, b, e) in enumerate(parts)], k
    want = [(k, i, len(s), md5(s)) for k, text, *_ in docs if text is not None for i, s in enumerate(S.split_document(text, "txt", len(text) + 1, len(text) + 2))]
    assert run(spark, "prose_sentences") == sorted(want, key=str)  # block by block as in one block


def detected(text):
    """(language, confidence, margin, whether it is ambiguous) by weighted markers."""
    markers, n = T.default_markers(), len(text or "")
    some = (text or "") if n <= 6000 else "\n".join((text[:2000], text[(n - 2000) // 2 : (n - 2000) // 2 + 2000], text[n - 1998 :]))
    plain = " ".join(some.lower().split())
    words = re.findall(r"[^\W\d_]+(?:['’][^\W\d_]+)?", plain)
    score = {k: sum(w in m["common_words"] for w in words) * 0.5 + sum(w in m["distinctive_words"] for w in words) * 2 + sum(min(plain.count(p), 3) for p in m["patterns"]) * 1.5 for k, m in markers.items()}
    first, second, _ = sorted(score.values(), reverse=True)
    confidence = first / sum(score.values()) if sum(score.values()) else 0.0
    vague = first < 3 or confidence < 0.5 or first - second < 1.5
    return "es" if vague else max(score, key=score.get), confidence, first - second, vague


def mean(values):
    return sum(values) / len(values)


def test_language_report(spark, docs):
    by = defaultdict(list)
    for _, text, *_ in docs:
        language, *rest = detected(text)
        by[language].append(rest)
    want = [(k, len(v), round(mean([x[0] for x in v]), 5), round(mean([x[1] for x in v]), 5), sum(x[2] for x in v), round(100 * len(v) / len(docs), 5)) for k, v in by.items()]
    got = [(a, b, round(c, 5), round(d, 5), e, round(f, 5)) for a, b, c, d, e, f in run(spark, "language_report")]
    assert got == sorted(want, key=str)


def test_corpus_quality(spark, docs, chunks):
    own = defaultdict(list)
    for k, _, _, t, n in chunks:
        own[k].append((t, n))
    groups = defaultdict(list)
    for k, text, lang, _ in docs:
        language, confidence, margin, vague = detected(text)
        pairs = [(shared_words(a.split(), b.split()), cuts_sentence(a, b)) for (a, _), (b, _) in zip(own[k], own[k][1:], strict=False)]
        held = Counter(u for t, _ in own[k] for u in units_of(t))
        missing = sum(max(0, n - held[u]) for u, n in Counter(units_of(text or "")).items())
        fact = (len(units_of(text or "")), None if lang is None else lang == language, confidence, margin, vague, own[k], sum(n for n, _ in pairs), sum(c for _, c in pairs), missing)
        for g in (language, None):
            groups[g].append(fact)
    for r in catalog.queries()["corpus_quality"](spark, D).collect():
        v = groups.pop(r.language)
        sizes, right = [n for x in v for _, n in x[5]], [x[1] for x in v if x[1] is not None]
        share = lambda keep: round(sum(map(keep, sizes)) / len(sizes), 6)
        assert (r.documents, r.no_sentence, r.one_sentence, r.labelled, r.ambiguous) == (len(v), sum(x[0] == 0 for x in v), sum(x[0] == 1 for x in v), len(right), sum(x[4] for x in v))
        assert abs(r.accuracy - mean(right)) < 1e-5 and abs(r.mean_confidence - mean([x[2] for x in v])) < 1e-5 and abs(r.mean_margin - mean([x[3] for x in v])) < 1e-5
        assert (r.chunks, r.tokens, r.longest, r.over_limit) == (len(sizes), sum(sizes), max(sizes), sum(n > 510 for n in sizes))
        assert (r.under_25, r.under_50, r.over_90) == (share(lambda n: n < 64), share(lambda n: n < 128), share(lambda n: 230.4 < n <= 256))
        words = sum(len(t.split()) for x in v for t, _ in x[5])
        assert abs(r.repeated_words - sum(x[6] for x in v) / words) < 1e-5 and (r.cut_sentences, r.missing_sentences) == (sum(x[7] for x in v), sum(x[8] for x in v))
    assert not groups


def test_bank_matches(spark, docs):
    bank = [tuple(r) for r in spark.read.parquet(f"{D}/benchmark.parquet").select("item_id", "text").collect()]
    known = {}
    for f in (U.strict, U.loose):  # each text once, as the plain version would for every pair
        known[f] = {t: f(t) for t in {t for _, t in bank} | {t for _, t, *_ in docs} if t is not None}
    want = []
    for k, x, *_ in docs:
        for i, q in bank:
            if x is not None and (known[U.strict][q] in known[U.strict][x] or known[U.loose][q] in known[U.loose][x]):
                want.append((k, i, "exact"))
            elif x is not None and len(known[U.loose][q]) >= 60 and known[U.loose][q][:80] in known[U.loose][x]:
                want.append((k, i, "prefix"))
    assert run(spark, "bank_matches") == sorted(want, key=str)
    few = [(k, x) for k, x, *_ in docs[:20]]
    assert sorted((w for w in want if w[0] in {k for k, _ in few}), key=str) == brute_matches(few, bank)


class Runs(HTMLParser):
    """Text runs with the tags that are open around them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.runs = [], []

    def handle_starttag(self, tag, attrs):
        if tag not in {"br", "img", "meta", "link", "input", "hr"}:
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_data(self, data):
        if data.strip():
            self.runs.append((tuple(self.open), data.strip()))


def test_pages_keep_what_stands_in_their_main_part(spark):
    pages = spark.read.parquet(f"{D}/pages.parquet").select("page_id", "html").collect()
    got = dict(run(spark, "html_text"))
    assert set(got) == {p.page_id for p in pages}
    for p in pages:
        reader = Runs()
        reader.feed(p.html or "")
        reader.close()
        lines = Counter((got[p.page_id] or "").split("\n"))
        hidden = [t for tags, t in reader.runs if {"script", "style"} & set(tags)]
        assert not any(t in lines for t in hidden)
        for tag in ("main", "article", "body"):
            inside = [t for tags, t in reader.runs if tag in tags and not {"script", "style", "nav", "header", "footer", "aside", "noscript", "template", "form", "svg"} & set(tags)]
            if any(tag in tags for tags, _ in reader.runs):
                shown = "\n".join(got[p.page_id].split("\n"))
                assert all(line in shown for t in inside for line in t.split("\n")), (p.page_id, inside[:3])
                break
