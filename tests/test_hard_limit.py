import random

import pytest

from textlode.operators import hard_limit as H
from textlode.operators import quality as Q


class Characters:
    """One token per sign that is no space; two more for a document."""

    def count(self, text):
        return 2 + self.bare(text)

    def bare(self, text):
        return sum(not c.isspace() for c in text)

    def offsets(self, text):
        return [(i, i + 1) for i, c in enumerate(text) if not c.isspace()]


@pytest.mark.parametrize("fmt,text,strategy", [
    ("csv", "aaaa,bbbb,cccc,dddd", "tabular_cell"), ("json", '{"a":"x","b":"zz"}', "json_structure"), ("txt", "aaaaaa\nbbbbbb", "newline"), ("txt", "aaaaaa;bbbbbb", "semicolon"),
    ("txt", "aaaaaa:bbbbbb", "colon"), ("txt", "aaaaaa,bbbbbb", "comma"), ("txt", "aaaaaa.bbbbbb", "punctuation"), ("txt", "aaaaaa bbbbbb", "whitespace"), ("txt", "a" * 25, "token_offsets"),
    ("csv", '"aa,aa,aa,aa,aa,aa"', "comma"), ("txt", "short", "unchanged"),
])
def test_strategies(fmt, text, strategy):
    found, parts = H.split_hard(text, fmt, Characters(), 12, 2)
    assert found == strategy
    check(text, parts, Characters(), 12, 2)


def check(text, parts, counter, limit, overlap):
    assert "".join(text[p.coverage_start : p.coverage_end] for p in parts) == text
    for p in parts:
        assert p.text == text[p.emitted_start : p.coverage_end] and p.token_count == counter.count(p.text) <= limit
        assert p.overlap_tokens == counter.bare(text[p.emitted_start : p.coverage_start]) <= overlap


def test_random_texts_are_covered():
    rng = random.Random(4)
    for fmt in ("txt", "csv", "json", "pdf"):
        for _ in range(120):
            text = "".join(rng.choice('abcd ,;:.\n"|{}\\') for _ in range(rng.randrange(1, 120)))
            for counter in (Characters(), H.WhitespaceCounter(1)):
                _, parts = H.split_hard(text, fmt, counter, 9, 3)
                check(text, parts, counter, 9, 3)


def test_errors():
    for args in (("", 5, 1), ("a", 0, 0), ("a", 5, 5)):
        with pytest.raises(ValueError):
            H.split_hard(args[0], "txt", Characters(), args[1], args[2])
    with pytest.raises(ValueError):
        H.split_hard("abc", "txt", Characters(), 2, 0)


def test_rows_and_contiguity_audit(spark):
    chunks = spark.createDataFrame([("a", "txt", "w " * 1300), ("b", "csv", "x, " * 40), ("c", None, None), ("d", "txt", "")], "chunk_id string, formato string, texto string")
    parts = H.split_chunks(chunks)
    assert {r.chunk_id: r.part_count for r in parts.collect()} == {"a": 3, "b": 1}
    assert Q.split_contiguity(parts).count() == 0
    assert Q.split_contiguity(parts.where("part_index <> 1")).count() == 2


def plain(text, fmt, counter, limit, overlap):
    """Every place tried in order from the far end, every overlap from the first character on."""
    import re

    if counter.count(text) <= limit:
        return "unchanged", [(0, len(text), 0)]
    kinds = [("tabular_cell", H.CELL)] if fmt == "csv" else [("json_structure", H.STRUCTURE)] if fmt == "json" else []
    kinds += [(n, re.compile(p)) for n, p in H.PLACES]
    ends = {len(text)}

    def cut(places, last):
        start, out = 0, []
        while start < len(text):
            near = [e for e in places if e > start and counter.count(text[start:e]) <= limit] or [e for e in range(start + 1, len(text) + 1) if last and counter.count(text[start:e]) <= limit]
            if not near:
                return None
            out.append((start, max(near)))
            start = max(near)
        return out

    for name, pattern in kinds:
        ends |= {m.end() for m in pattern.finditer(text) if m.lastindex or not pattern.groups}
        if found := cut(ends, False):
            break
    else:
        name, found = "token_offsets", cut({e for _, e in counter.offsets(text)} | {len(text)}, True)
    parts = []
    for a, b in found:
        begins = [x for x, _ in counter.offsets(text) if x < a][-overlap:] if a and overlap else []
        parts.append((a, b, next((x for x in range(begins[0], a) if counter.bare(text[x:a]) <= overlap and counter.count(text[x:b]) <= limit), a) if begins else a))
    return name, parts


def test_parts_equal_the_plain_version():
    rng = random.Random(11)
    for fmt in ("txt", "csv", "json"):
        for _ in range(150):
            text = "".join(rng.choice('abcd ,;:.\n"|{}') for _ in range(rng.randrange(1, 90)))
            for counter in (Characters(), H.WhitespaceCounter(1)):
                name, parts = H.split_hard(text, fmt, counter, 9, 3)
                assert (name, [(p.coverage_start, p.coverage_end, p.emitted_start) for p in parts]) == plain(text, fmt, counter, 9, 3)


def test_long_texts_take_time_in_proportion():
    class Counting(H.WhitespaceCounter):
        seen = 0

        def count(self, text):
            Counting.seen += len(text)
            return super().count(text)

    costs = []
    for n in (20_000, 80_000):
        Counting.seen = 0
        H.split_hard("palabra " * n, "txt", Counting(), 510, 32)
        costs.append(Counting.seen)
    assert costs[1] < 5 * costs[0]
