"""Runs over the stages: modes, what a run may reuse, locks, and the command line.

    python -m textlode.plans.runs run --mode full --corpus raw --queries q.jsonl --folder out
    python -m textlode.plans.runs produce|validate|benchmark ...
"""

from __future__ import annotations

import argparse
import hashlib
import importlib.metadata
import json
import time
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..sources import artifacts as A
from . import config, stages
from .stages import STAGES, Run, Settings

MODES = ("quick", "full", "fresh", "resume-fresh", "custom")
#: The stages that a resumed run takes from its parent.
INHERITED = ("ingestion", "chunking")


@dataclass(frozen=True)
class Plan:
    """Which stages a run goes through and whether it may reuse what is there."""

    mode: str = "custom"
    first: str = "ingestion"
    last: str = "validation"
    reuse: bool = True
    forced: frozenset[str] = frozenset()

    def __post_init__(self):
        a, b = STAGES.index(self.first), STAGES.index(self.last)
        whole = (self.first, self.last) == ("ingestion", "validation")
        wrong = {
            "unknown mode": self.mode not in MODES,
            "the first stage comes after the last": a > b,
            "results alone have no identity to validate": a > STAGES.index("retrieval"),
            "forced stages lie outside the range": any(not a <= STAGES.index(s) <= b for s in self.forced),
            "a fresh run goes through all stages, reusing none": self.mode == "fresh" and (not whole or self.reuse or self.forced),
            "a resumed run goes from embeddings to validation, reusing nothing of its own": self.mode == "resume-fresh" and ((self.first, self.last) != ("embeddings", "validation") or self.reuse or self.forced),
            "a full run goes through all stages": self.mode == "full" and not whole,
        }
        if found := [name for name, bad in wrong.items() if bad]:
            raise ValueError("; ".join(found))

    @classmethod
    def of(cls, mode: str, first: str | None = None, last: str | None = None, reuse: bool | None = None, forced=()) -> Plan:
        """The plan of a mode, with its own range and reuse where none is given: quick stops at retrieval and reuses all."""
        a, b, again = {"quick": ("ingestion", "retrieval", True), "fresh": ("ingestion", "validation", False), "resume-fresh": ("embeddings", "validation", False)}.get(mode, ("ingestion", "validation", True))
        return cls(mode, first or a, last or b, again if reuse is None else reuse, frozenset(forced))


def chunk_policy(documents: dict, chunks: dict, before: dict | None) -> dict:
    """What a former run (its manifests of ingestion and chunking) demands of this one's chunks.

    Equal documents must give equal chunks; else the former run is only compared with.
    """
    before = before or {}
    old_documents, old_chunks = before.get("ingestion"), before.get("chunking")
    same = bool(old_documents) and old_documents["sha256"] == documents["sha256"]
    evidence = {
        "policy": "STRICT_HISTORICAL_IDENTITY" if same else "COMPARISON_ONLY_UPSTREAM_CHANGED",
        "documents_match": same,
        "rows_match": old_chunks is None or old_chunks["rows"] == chunks["rows"],
        "sha256_match": old_chunks is None or old_chunks["sha256"] == chunks["sha256"],
    }
    if same and not (evidence["rows_match"] and evidence["sha256_match"]):
        raise A.ContractError("equal documents gave other chunks than before")
    return evidence


def approve(spark: SparkSession, parent: str) -> dict:
    """What a reviewer signs of a fresh run: rows and identity of documents and chunks, and the settings."""
    done = json.loads(A.read_text(spark, f"{parent}/run.json"))
    return {"mode": done["mode"], "settings": json.loads(A.read_text(spark, f"{parent}/chunking.json"))["sha256"], **{s: {k: done[s][k] for k in ("rows", "sha256")} for s in INHERITED}}


def inherited(spark: SparkSession, parent: str, approval: dict, settings: Settings) -> dict[str, str]:
    """Places of the parent's documents and chunks, if it was fresh, executed both and is what was approved."""
    done = json.loads(A.read_text(spark, f"{parent}/run.json"))
    if done.get("mode") != "fresh" or any(done.get(s, {}).get("reused", True) for s in INHERITED):
        raise A.ContractError(f"{parent} is no fresh run that executed ingestion and chunking")
    if approve(spark, parent) != approval or approval["settings"] != settings.fingerprint():
        raise A.ContractError(f"{parent} is not what was approved, or of other settings")
    for s in INHERITED:
        found = A.load(spark, f"{parent}/{s}")[1]
        if {k: found[k] for k in ("rows", "sha256")} != approval[s]:
            raise A.ContractError(f"the {s} of {parent} changed after approval")
    return {s: f"{parent}/{s}" for s in INHERITED}


def execute(run: Run, plan: Plan, corpus: str, queries: DataFrame, parent: str | None = None, approval: dict | None = None, before: dict | None = None) -> DataFrame | None:
    """Results of a run by its plan; run.json says how it was made."""
    if plan.mode == "fresh" and A.exists(run.spark, f"{run.folder}/run.json"):
        raise FileExistsError(f"{run.folder} already holds a run")
    if plan.mode == "resume-fresh":
        if not parent or not approval:
            raise ValueError("a resumed run needs its parent and the approval of it")
        run.inherited = inherited(run.spark, parent, approval, run.settings)
    run.done["mode"] = plan.mode
    # from the earliest forced stage on all is made anew, since each stage rests on the one before
    first = min(plan.forced, key=STAGES.index) if plan.forced else plan.first
    try:
        results = run.run(corpus, queries, first, plan.last, plan.reuse and not plan.forced)
        if "ingestion" in run.done and "chunking" in run.done:
            run.done["chunk_policy"] = chunk_policy(run.done["ingestion"], run.done["chunking"], before)
    finally:
        A.write_text(run.spark, f"{run.folder}/run.json", json.dumps(run.done, sort_keys=True, default=str, indent=1))
        A.write_text(run.spark, f"{run.folder}/report.md", report(run.done))
    return results


def compatibility(settings: Settings, source: str, *more: str) -> dict:
    """What two measurements must share to be compared: settings, source identity, this package's code, versions."""
    code = hashlib.sha256()
    for f in sorted(Path(__file__).parents[1].rglob("*.py")):
        code.update(f.read_bytes())
    versions = {p: importlib.metadata.version(p) for p in ("pyspark", "numpy", "pyarrow", "pandas")}
    return {"settings": settings.fingerprint(), "source": source, "code": code.hexdigest(), "versions": versions, "more": list(more)}


def report(done: dict) -> str:
    """A run in Markdown: its mode, and per stage how it came about, rows, seconds, rate and share of the time."""
    lines = [f"# Run ({done.get('mode', 'custom')})", "", "| stage | how | rows | seconds | rows a second | % |", "|---|---|---|---|---|---|"]
    for name in STAGES:
        if isinstance(s := done.get(name), dict) and "seconds" in s:
            how = "inherited" if s.get("inherited") else "reused" if s.get("reused") else "executed"
            lines.append(f"| {name} | {how} | {s.get('rows', '')} | {s['seconds']:.3f} | {s.get('rows_per_second') or ''} | {s.get('percent', '')} |")
    if "failed" in done:
        lines += ["", f"Failed: {done['failed']}"]
    if policy := done.get("chunk_policy"):
        lines += ["", f"Chunks: {policy['policy']}"]
    return "\n".join(lines) + "\n"


class Lock:
    """A file that only one process makes; it is removed at the end."""

    def __init__(self, spark: SparkSession, path: str):
        self.fs, self.path = A._fs(spark, path)
        self.name = path

    def __enter__(self) -> Lock:
        try:
            self.fs.create(self.path, False).close()
        except Exception as e:
            raise RuntimeError(f"{self.name} is held by another run") from e
        return self

    def __exit__(self, *_) -> None:
        self.fs.delete(self.path, False)


def benchmark(spark: SparkSession, folder: str, work: Callable[[], str], fits: dict, repetitions: int) -> dict:
    """Seconds and digest of repeated work, resumed where an equal measurement was interrupted.

    ``work`` returns a digest of what it made; ``fits`` says what an earlier
    measurement must share to be gone on with.
    """
    path = f"{folder}/benchmark.json"
    with Lock(spark, f"{folder}/benchmark.lock"):
        known = json.loads(A.read_text(spark, path)) if A.exists(spark, path) else {}
        done = known["repetitions"] if known.get("compatibility") == fits else []
        resumed = len(done)
        while len(done) < repetitions:
            started = time.perf_counter()
            digest = work()
            done.append({"seconds": round(time.perf_counter() - started, 6), "sha256": digest})
            A.write_text(spark, path, json.dumps({"compatibility": fits, "repetitions": done}, sort_keys=True, indent=1))
    return {"repetitions": len(done), "resumed_from": resumed, "deterministic": len({d["sha256"] for d in done}) == 1, "seconds": [d["seconds"] for d in done]}


def produce(spark: SparkSession, documents: str, folder: str, settings: Settings) -> dict:
    """Chunks of a file of documents as an artifact; what was made before from the same input and settings is kept."""
    docs = A.scan_jsonl(spark, documents, A.DOCUMENT, ["doc_id", "fuente", "formato", "fenomeno", "texto"])
    source = A.identity_hash(docs, "doc_id", "doc_id").first().sha256
    mark = hashlib.sha256(f"{settings.fingerprint()} {source}".encode()).hexdigest()
    if A.exists(spark, f"{folder}/manifest.json") and A.load(spark, folder)[1].get("fingerprint") == mark:
        return A.load(spark, folder, verify=False)[1] | {"reused": True}
    return A.publish(stages.chunk_documents(docs, settings), folder, "chunk_id", "chunk_id", fingerprint=mark, source=source) | {"reused": False}


def validate(spark: SparkSession, folder: str, settings: Settings, bank: DataFrame | None = None) -> dict:
    """State (PASS, NEEDS_REVIEW, FAIL) of a chunk artifact, and how often each check failed."""
    chunks, manifest = A.load(spark, folder)
    failed = Q.failures(chunks, ["chunk_id"], Q.chunk_checks(settings.capacity)).unionByName(Q.position_gaps(chunks).select("chunk_id", F.lit("position").alias("category")))
    counts = {r.category: r.n for r in failed.groupBy("category").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per check
    states = ["FAIL" if counts else "PASS", "NEEDS_REVIEW" if stages.boundary_gate(chunks)[0] == "FAIL" else "PASS"]
    if bank is not None:
        states.append(stages.clean_gate(chunks, bank, settings)[0])
    worst = max(states, key=("PASS", "NEEDS_REVIEW", "FAIL").index)
    return {"state": worst, "failures": counts, "rows": manifest["rows"], "sha256": manifest["sha256"]}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="textlode", description="Stages from files to validated results.")
    commands = out.add_subparsers(dest="command", required=True)
    for name in ("run", "produce", "validate", "benchmark"):
        c = commands.add_parser(name)
        c.add_argument("--folder", required=True)
        c.add_argument("--config", help="YAML or JSON with a section 'chunking'")
        c.add_argument("--queries", required=name == "run")
        c.add_argument("--documents", required=name in ("produce", "benchmark"))
    run = commands.choices["run"]
    run.add_argument("--corpus", required=True)
    run.add_argument("--mode", choices=MODES, default="custom")
    run.add_argument("--from-stage", choices=STAGES)
    run.add_argument("--to-stage", choices=STAGES)
    run.add_argument("--no-reuse", action="store_true")
    run.add_argument("--force-stage", choices=STAGES, action="append", default=[])
    run.add_argument("--parent")
    run.add_argument("--approval", help="JSON file made by approve()")
    commands.choices["benchmark"].add_argument("--repetitions", type=int, default=3)
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    """Run one command and print what came of it as JSON."""
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("textlode").getOrCreate()
    settings = config.settings(config.load(args.config)["chunking"]) if args.config else Settings()
    bank = A.scan_queries(spark, args.queries) if args.queries else None
    if args.command == "run":
        plan = Plan.of(args.mode, args.from_stage, args.to_stage, False if args.no_reuse else None, args.force_stage)
        run = Run(spark, args.folder, settings)
        approval = json.loads(A.read_text(spark, args.approval)) if args.approval else None
        results = execute(run, plan, args.corpus, bank, args.parent, approval)
        if results is not None:
            A.write_jsonl(results, f"{args.folder}/results-{time.time_ns()}")
        out = run.done
    elif args.command == "produce":
        out = produce(spark, args.documents, args.folder, settings)
    elif args.command == "validate":
        out = validate(spark, args.folder, settings, bank)
    else:
        docs = A.scan_jsonl(spark, args.documents, A.DOCUMENT, ["doc_id", "texto"])
        source = A.identity_hash(docs, "doc_id", "doc_id").first().sha256
        work = lambda: A.identity_hash(stages.chunk_documents(docs, settings), "chunk_id", "texto").first().sha256
        out = benchmark(spark, args.folder, work, compatibility(settings, source), args.repetitions)
    print(json.dumps(out, sort_keys=True, default=str))
    return out


if __name__ == "__main__":
    main()
