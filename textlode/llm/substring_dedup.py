"""Substring dedup by level-wise doubling.

A window of ``window`` words is removed when the same word sequence starts
anywhere else.  Windows are not compared at full length at once: a short
length L0 (a quarter of the window for 16 to 63 words, an eighth for 64 to 127,
and so on) is tried first, what repeats there is extended to 2 * L0, what still
repeats to 4 * L0, and only what is left to the full length.  Each level counts
only what the level before left over, until no candidates survive.

Level 1 does not even send every short window.  Each full window is
represented by the smallest-hashing L0-window inside it; equal full windows
have equal representatives at equal offsets, so a full window can repeat only
if its representative does.  Neighbouring windows share representatives, which
leaves about 2 / (window - L0 + 2) of all short windows: 7 % for 35 words.
A full window holds its representative's extension of length l to the left or
to the right, as long as l is at most half of window + L0 + 1; so one of the
two must repeat at every level.

At the last level, windows in a row that share a representative form a span.
Equal spans are compared as one row; the windows of one span per group of
equals, and of spans that are alone, are then compared one by one.  So copies
of a long passage cost one row per span, not one per word, and a passage that
a third of all documents hold is counted by partial aggregation.  Repeated
hashes are written as tables before they are joined, so that Spark may split
the rows of a hot one.

Rows travel as (two 64-bit document keys, word position, 64-bit hashes).
Windows are compared by hashes whose seed is drawn for each run: of n
candidate windows about n**2 / 2**65 are taken for repeated wrongly, and no
text can be written to bring that about.
"""

from __future__ import annotations

import secrets

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _kernels as K
from ._columns import kept_names, with_results
from ..sources.staging import Scratch

DEFAULT_WINDOW = 35
RESULTS = ("n_words", "n_removed", "kept_text")


def levels(window: int) -> list[int]:
    """Lengths of the levels: a part of the window, its doublings, and the whole."""
    parts = max(4, 1 << max(0, (window // 8).bit_length() - 1))
    lengths = [max(1, -(-window // parts))]
    while 4 * lengths[-1] <= window + lengths[0] + 1 and 2 * lengths[-1] < window:
        lengths.append(2 * lengths[-1])
    return lengths if lengths[-1] == window else [*lengths, window]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k1, k2, text): a 128-bit key of id and text.  Repeated rows share it, and its fate."""
    i, t = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return docs.select(F.xxhash64(i, t).alias("k1"), F.xxhash64(t, i, F.lit(1)).alias("k2"), t.alias("text"))


def _anchors(words: np.ndarray, first: np.ndarray, window: int):
    """Representative of every full window: (its text, its start, representative position)."""
    short = levels(window)[0]
    n = len(words) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, K.U64)
    own = K.owners(first)
    hashes = K.window_hashes(words, short)
    at = K.sliding_argmin(hashes, window - short + 1)[:n]
    inside = np.flatnonzero(own[:n] == own[window - 1 :])
    return own[inside], inside, at[inside], hashes


def _scan(batch: pa.RecordBatch, seed: int, text: int = 2):
    data, offsets = K.buffers(batch.column(text))
    for i, j in K.slices(offsets):
        off = offsets[i : j + 1] - offsets[i]
        part = data[offsets[i] : offsets[j]]
        starts, ends, first = K.word_spans(part, off)
        yield i, j, part, starts, ends, first, K.word_hashes(part, starts, ends, seed)


def _long(a: np.ndarray, null: np.ndarray | None = None) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64) if a.dtype == K.U64 else a.astype(np.int64), mask=null)


ANCHORS = "k1 bigint, k2 bigint, pos int, h bigint, wide array<bigint>"


def anchor_rows(window: int, seed: int):
    """Level 1 rows: one per representative, with its extensions to the left and to the right at each middle level."""
    short, *middle = levels(window)[:-1] or [window]

    def run(batches):
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            for i, _, _, _, _, first, words in _scan(batch, seed):
                own, _, at, h = _anchors(words, first, window)
                keep = np.flatnonzero(np.diff(at, prepend=-1))
                own, at = own[keep], at[keep]
                if not len(at):
                    continue
                lo, hi = first[own], first[own + 1]
                wide, inside = [], []
                grown, size = h, short
                for length in middle:
                    grown, size = K.wider(grown, size, length), length
                    for start in (at + short - length, at):
                        fits = (start >= lo) & (start + length <= hi)
                        wide.append(grown[np.clip(start, 0, len(grown) - 1)] if len(grown) else np.zeros(len(at), K.U64))
                        inside.append(fits)
                doc = own + i
                flat = _long(np.stack(wide, axis=1).reshape(-1), ~np.stack(inside, axis=1).reshape(-1)) if wide else pa.array([], pa.int64())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * len(wide)), flat)
                yield pa.RecordBatch.from_arrays([pa.array(k1[doc]), pa.array(k2[doc]), pa.array((at - lo).astype(np.int32)), _long(h[at]), lists], ["k1", "k2", "pos", "h", "wide"])

    return run


SPANS = "rid bigint, start int, span bigint, wins array<bigint>"


def span_rows(window: int, seed: int):
    """Last level rows: one per run of windows with a surviving representative, with the hashes of its full windows."""

    def run(batches):
        for batch in batches:
            rid = batch.column(0).to_numpy(zero_copy_only=False)
            alive = batch.column(1)
            live_off = alive.offsets.to_numpy()
            live = alive.values.to_numpy(zero_copy_only=False)
            for i, j, _, _, _, first, words in _scan(batch, seed):
                own, start, at, _ = _anchors(words, first, window)
                if not len(at):
                    continue
                full = K.window_hashes(words, window)
                marked = np.zeros(len(words) + 1, dtype=bool)
                marked[live[live_off[i] : live_off[j]] + np.repeat(first[:-1], np.diff(live_off[i : j + 1]))] = True
                ok = np.flatnonzero(marked[at])
                own, start, at = own[ok], start[ok], at[ok]
                if not len(at):
                    continue
                new = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(start, prepend=-9) != 1))
                wins = full[start]
                span = K.run_hashes(wins, new, seed)
                doc = own[new]
                lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(at)).astype(np.int32)), _long(wins))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[doc + i]), pa.array((start[new] - first[doc]).astype(np.int32)), _long(span), lists],
                    ["rid", "start", "span", "wins"],
                )

    return run


def cut_rows(window: int):
    """Final pass: drop covered words and join what is left by one space."""

    def run(batches):
        for batch in batches:
            hits = batch.column(1)
            hit_off = hits.offsets.to_numpy()
            hit = hits.values
            at, runs = (hit.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            extra = [batch.column(c) for c in range(2, batch.num_columns)]
            data, offsets = K.buffers(batch.column(0))
            n_words, n_removed, kept = [], [], []
            for i, j in K.slices(offsets):
                off = offsets[i : j + 1] - offsets[i]
                part = data[offsets[i] : offsets[j]]
                starts, ends, first = K.word_spans(part, off)
                a, b, each = hit_off[i], hit_off[j], np.diff(hit_off[i : j + 1])
                s = at[a:b] + np.repeat(first[:-1], each)
                e = np.minimum(s + runs[a:b] - 1 + window, np.repeat(first[1:], each))
                n = len(starts) + 1
                gone = np.cumsum(np.bincount(s, minlength=n) - np.bincount(e, minlength=n))[:-1] > 0
                left = ~gone
                s, e = starts[left], ends[left]
                n_kept = np.concatenate(([0], np.cumsum(left)))[first]
                n_words.append(np.diff(first))
                n_removed.append(np.diff(first) - np.diff(n_kept))
                # every kept word is copied with one space after it; a text's last space is left out
                size = e - s + 1
                ends_at = np.cumsum(size)
                text_end = np.concatenate(([0], ends_at))[n_kept]
                out = np.full(int(ends_at[-1]) if len(size) else 0, 32, dtype=np.uint8)
                body = np.ones(len(out), dtype=bool)
                body[ends_at - 1] = False
                mark = np.zeros(len(part) + 1, dtype=np.int8)
                mark[s] += 1
                mark[e] -= 1
                out[body] = part[np.cumsum(mark[:-1], dtype=np.int8) > 0]
                raw = out.tobytes()
                kept += [raw[a : max(a, b - 1)].decode("utf-8", "replace") for a, b in zip(text_end[:-1], text_end[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*extra, pa.array(np.concatenate(n_words or [np.zeros(0, np.int64)])), pa.array(np.concatenate(n_removed or [np.zeros(0, np.int64)])), pa.array(kept, pa.string())],
                [*batch.schema.names[2:], "n_words", "n_removed", "kept_text"],
            )

    return run


def repeated_runs(docs: DataFrame, id_col: str, text_col: str, window: int, work: Scratch, seed: int) -> DataFrame:
    """(k1, k2, hits array<struct<start, n>>): runs of n repeated windows from word ``start`` on."""
    text = keyed(docs, id_col, text_col)

    def repeated(hashes: DataFrame, name: str) -> DataFrame:
        return work.keep(hashes.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h"), name)

    # level 1: representatives of the shortest length
    left = work.keep(text.mapInArrow(anchor_rows(window, seed), ANCHORS), "level1")
    again = repeated(left.select("h", F.lit(1).alias("n")), "again1")
    survivors = left.join(again, "h", "left_semi").select("k1", "k2", "pos", "wide")

    # middle levels: of the extensions to double the length, one must repeat
    middle = levels(window)[1:-1]
    for k, _ in enumerate(middle):
        left, seen = work.keep_observed(survivors, f"level{k + 2}", n=F.count(F.lit(1)))
        work.drop(f"level{k + 1}", f"again{k + 1}")
        survivors = left.select("k1", "k2", "pos", "wide")
        if not seen["n"]:
            break
        sides = left.select("k1", "k2", "pos", "wide", F.explode(F.slice("wide", 2 * k + 1, 2)).alias("h")).where("h is not null")
        again = repeated(sides.select("h", F.lit(1).alias("n")), f"again{k + 2}")
        survivors = sides.join(again, "h", "left_semi").select("k1", "k2", "pos", "wide")
    alive = survivors.groupBy("k1", "k2").agg(F.collect_set("pos").alias("alive"))
    alive = work.keep(alive.withColumn("rid", F.monotonically_increasing_id()), "alive")
    work.drop(*[f"{n}{k + 1}" for k in range(len(middle) + 1) for n in ("level", "again")])

    # last level: spans of full windows, equal spans as one
    third = text.join(alive, ["k1", "k2"])
    spans = work.keep(third.select("rid", "alive", "text").mapInArrow(span_rows(window, seed), SPANS), "spans")
    groups = work.keep(spans.groupBy("span").agg(F.count(F.lit(1)).alias("n"), F.first("wins").alias("wins")), "groups")
    single = groups.select("span", "n", F.posexplode("wins").alias("i", "h"))
    again = repeated(single, "again")
    lone = single.where("n = 1").join(again, "h", "left_semi").select("span", "i", F.lit(1).alias("len"))
    whole = groups.where("n > 1").select("span", F.lit(0).alias("i"), F.size("wins").alias("len"))
    found = work.keep(lone.union(whole), "found")
    hits = spans.select("rid", "start", "span").join(found, "span").select("rid", F.struct((F.col("start") + F.col("i")).alias("start"), F.col("len").alias("n")).alias("hit"))
    runs = hits.groupBy("rid").agg(F.collect_list("hit").alias("hits"))
    out = work.keep(alive.select("rid", "k1", "k2").join(runs, "rid").drop("rid"), "hits")
    work.drop("spans", "groups", "alive", "again", "found")
    return out


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = DEFAULT_WINDOW, carry: list[str] | None = None, seed: int | None = None) -> DataFrame:
    """Remove every word covered by a repeated window of ``window`` words.

    Returns the rows and columns of ``docs`` (or those named in ``carry``) and n_words (long), n_removed
    (long), kept_text (words that stay, joined by one space).  A null or empty
    text has no words: 0, 0 and "".  Texts shorter than the window lose
    nothing.  Repeated rows are copies of each other like any other rows, so a
    text that occurs twice loses all windows.  Ids may be null or repeated.  An
    empty table gives an empty table.  Input columns named like the three
    results, in any case, are replaced by them.  ``seed`` of the hashes is
    random if None; it does not change the result.
    """
    spark = docs.sparkSession
    work = Scratch(spark, "substring")
    extra = kept_names(docs, RESULTS, carry)
    hits = repeated_runs(docs, id_col, text_col, window, work, secrets.randbits(63) if seed is None else seed)
    i, t = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    packed = docs.select(F.xxhash64(i, t).alias("k1"), F.xxhash64(t, i, F.lit(1)).alias("k2"), t.alias("_text"), F.struct(*[F.col(f"`{c}`") for c in extra]).alias("_row"))
    none = F.array().cast("array<struct<start:int,n:int>>")
    joined = packed.join(hits, ["k1", "k2"], "left").select("_text", F.coalesce("hits", none).alias("_hits"), "_row")
    done = joined.mapInArrow(cut_rows(window), with_results(joined, n_words="long", n_removed="long", kept_text="string"))
    return done.select("_row.*", "n_words", "n_removed", "kept_text")
