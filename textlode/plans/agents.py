"""Answering one question from retrieved evidence: a bounded loop on the driver.

The three parts are plain callables, so any backend fits:

* ``search(text, k)`` -> evidence in rank order
* ``draft(question, evidence, feedback)`` -> a text and the chunk ids it cites
* ``judge(question, evidence, draft)`` -> a verdict

Evidence of all cycles is kept, the first of each chunk.  A draft may cite only
what it was given.  A verdict of RETRY searches again, with the verdict's focus
where it names one; after the last cycle there is no answer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from enum import StrEnum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Verdict(StrEnum):
    PASS = "PASS"
    RETRY = "RETRY_RETRIEVAL"
    INSUFFICIENT = "INSUFFICIENT_EVIDENCE"


class GroundingError(ValueError):
    """A citation of evidence that was not given."""


@dataclass(frozen=True)
class Evidence:
    chunk_id: str
    doc_id: str
    source: str
    text: str
    rank: int
    score: float | None = None

    def __post_init__(self):
        if self.rank <= 0 or not all(x.strip() for x in (self.chunk_id, self.doc_id, self.source, self.text)):
            raise ValueError("evidence needs ids, source, text and a positive rank")


@dataclass(frozen=True)
class Draft:
    text: str
    cites: tuple[str, ...]

    def __post_init__(self):
        if not self.text.strip() or not self.cites or len(set(self.cites)) != len(self.cites):
            raise ValueError("a draft needs text and distinct citations")


@dataclass(frozen=True)
class Judgement:
    verdict: Verdict
    unsupported: tuple[str, ...] = ()
    missing: tuple[str, ...] = ()
    focus: str | None = None

    def __post_init__(self):
        if self.verdict is Verdict.PASS and (self.unsupported or self.missing or self.focus):
            raise ValueError("what passes has nothing unsupported or missing")


@dataclass
class Answer:
    query_id: str
    text: str | None = None
    evidence: tuple[Evidence, ...] = ()
    verdict: Verdict = Verdict.INSUFFICIENT
    cycles: int = 0
    states: list[str] = field(default_factory=lambda: ["QUERY"])
    requests: list[str] = field(default_factory=list)
    seen: list[tuple[str, ...]] = field(default_factory=list)
    judgements: list[Judgement] = field(default_factory=list)


def first_of_each(items: Sequence[Evidence]) -> list[Evidence]:
    """Evidence without repeated chunks, in order."""
    out: dict[str, Evidence] = {}
    for e in items:
        out.setdefault(e.chunk_id, e)
    return list(out.values())


def ask(query_id: str, question: str, search: Callable[[str, int], Sequence[Evidence]], draft: Callable[..., Draft], judge: Callable[..., Judgement], k: int = 10, cycles: int = 2) -> Answer:
    """Search, draft and judge, at most ``cycles`` times."""
    if not question.strip() or k <= 0 or cycles <= 0:
        raise ValueError("need a question and positive bounds")
    out, pool, text, feedback = Answer(query_id), [], question, None
    while out.cycles < cycles:
        out.cycles += 1
        found = first_of_each(search(text, k))
        out.states.append("RETRIEVE")
        out.requests.append(text)
        out.seen.append(tuple(e.chunk_id for e in found))
        pool = first_of_each([*pool, *found])
        if not pool:
            break
        made = draft(question, tuple(pool), feedback)
        known = {e.chunk_id: e for e in pool}
        if unknown := sorted(set(made.cites) - set(known)):
            raise GroundingError("cites evidence that was not given: " + ", ".join(unknown))
        feedback = judge(question, tuple(pool), made)
        out.states += ["ANALYZE", "VERIFY"]
        out.judgements.append(feedback)
        if feedback.verdict is Verdict.PASS:
            out.text, out.verdict, out.evidence = made.text, Verdict.PASS, tuple(known[c] for c in made.cites)
            break
        if feedback.verdict is not Verdict.RETRY:
            break
        text = feedback.focus or question
    out.states.append("FINAL")
    return out


def unknown_citations(citations: DataFrame, evidence: DataFrame) -> DataFrame:
    """(query_id, chunk_id) cited without being among the evidence: must be empty."""
    return citations.join(evidence.select("query_id", "chunk_id").distinct(), ["query_id", "chunk_id"], "left_anti")


def evidence_of(results: DataFrame, query_id: str) -> list[Evidence]:
    """Evidence of one query from a result table, at most as many rows as a result has fragments."""
    rows = results.where(F.col("query_id") == query_id).select(F.explode("fragments").alias("f")).select("f.*").orderBy("rank").collect()
    return [Evidence(r.chunk_id, str(r.doc_id), str(r.doc_id), r.text, r["rank"]) for r in rows]
