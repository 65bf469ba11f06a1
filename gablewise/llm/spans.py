"""Substring dedup with sliding sentence spans.

A text falls into sentences: up to a full stop, exclamation or question mark before white space, or to the end of a line. Every
run of SPAN consecutive sentences is hashed, and the hashes are joined over all documents. A run of fewer than MIN_WORDS words
("Yes. No. Maybe.") would be no evidence of a copy, so it is hashed together with as many of the sentences after it, and once
more of those before it, as bring it to MIN_WORDS; no run is left out. Of a text with fewer sentences or words, the one run is
all of it. A sentence goes if a span that covers it stood before: in a document with a smaller doc_id, or earlier in its own.

A passage that begins and ends inside sentences may hold too few whole ones. For those, with runs, RUN words are hashed as well
from the places where a pair of words has the least hash of WINDOW places in a row: of every RUN + WINDOW words that two texts
share, at least one such run begins at the same word of both. Its words go if they stood in a document before and no sentence
that they touch goes as a whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gablewise.llm.common import id_columns, mix, packed, run_hashes, small_batches, tidied, word_hashes

SPAN = 3
MIN_WORDS = 10
RUN = 24
WINDOW = 14
STOP = re.compile(r"(?:[.!?]+(?=\s)|\n)\s*")
WORD = re.compile(r"\S+\s*")
ODD = np.cumprod(np.full((2, RUN), [[0x9E3779B97F4A7C15], [0xD6E8FEB86659FD93]], np.uint64), axis=1)
FOUND = "a long, b int, id long, no_id boolean, mark long, at int, n int, sure boolean"


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences of a text, with the white space after them; together they are the whole text."""
    ends = [m.end() for m in STOP.finditer(text)]
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    return list(zip([0, *ends], ends, strict=False))


def span_places(sizes: np.ndarray, span: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First sentences and numbers of sentences of the spans to hash; sizes are the words of each sentence."""
    n = len(sizes) - span + 1
    total = np.cumsum([0, *sizes])
    if not total[-1]:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if n <= 0 or total[-1] < min_words:
        return np.zeros(1, np.int64), np.full(1, len(sizes))
    enough = total[span:] - total[:n] >= min_words
    at, many = np.flatnonzero(enough), np.full(int(enough.sum()), span)
    if enough.all():
        return at, many
    short = np.flatnonzero(~enough)
    ends = np.searchsorted(total, total[short] + min_words)  # on through the sentences that follow
    on = ends <= len(sizes)
    starts = np.searchsorted(total, total[short + span] - min_words, "right") - 1  # back through those before
    back = total[short + span] >= min_words
    first, last = np.concatenate([at, short[on], starts[back]]), np.concatenate([at + span, ends[on], short[back] + span])
    places = np.unique(np.stack([first, last - first]), axis=1)
    return places[0], places[1]


def word_runs(ws: list[str]) -> tuple[np.ndarray, ...]:
    """Positions of the runs of words to hash, and two hashes of each; none of fewer than RUN words.

    A run of less than half as many different words ("the the the") is no evidence of a copy.
    """
    n = len(ws) - RUN + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    h = word_hashes(" ".join(ws).encode("utf-8", "replace").split(b" "))
    v = mix(h[:n] + h[1 : n + 1] * ODD[0, 0])
    windows = np.lib.stride_tricks.sliding_window_view(v, min(WINDOW, n))
    at = np.unique(windows.argmin(axis=1) + np.arange(len(windows)))
    run = h[at[:, None] + np.arange(RUN)]
    plain = (np.diff(np.sort(run, axis=1), axis=1) != 0).sum(axis=1) + 1 >= RUN // 2
    at, run = at[plain], run[plain]
    return at, mix((run * ODD[0]).sum(axis=1, dtype=np.uint64)), mix((run * ODD[1]).sum(axis=1, dtype=np.uint64))


def span_hashes(text: str, span: int = SPAN, min_words: int = MIN_WORDS, runs: bool = False) -> tuple[np.ndarray, ...]:
    """Positions of the spans of a text, their numbers of sentences, and 96 bits of hash of each (of the words, in lower case).

    A run of words has the position -1 - its first word, and its number of words.
    """
    ws = [text[a:b].lower().split() for a, b in sentences(text)]
    at, many = span_places(np.fromiter(map(len, ws), np.int64, len(ws)), span, min_words)
    a, b = np.empty(len(at), np.uint64), np.empty(len(at), np.uint64)
    if len(at):
        h = np.fromiter((xxhash.xxh3_64_intdigest(" ".join(w).encode("utf-8", "replace")) for w in ws), np.uint64, len(ws))
        for k in np.unique(many).tolist():
            those = many == k
            a[those] = run_hashes(h, k)[at[those]]
            b[those] = run_hashes(h ^ np.uint64(0xC2B2AE3D27D4EB4F), k)[at[those]]
    if runs:
        first, c, d = word_runs([w for x in ws for w in x])
        at, many, a, b = np.append(at, -1 - first), np.append(many, np.full(len(first), RUN)), np.append(a, c), np.append(b, d)
    return at, many, a.view(np.int64), (b >> np.uint64(32)).astype(np.uint32).view(np.int32)


def mark_later(x: pd.DataFrame) -> pd.DataFrame:
    """sure: another row of this batch has the same span at an earlier place. Such rows need not meet the others of their hash.

    They get a hash of their own, so that a span that very many documents share costs the shuffle one row a batch. Runs of words
    (at below 0) of one document have one place, as they don't count within it.
    """
    if not len(x):
        return x.assign(sure=pd.Series(dtype=bool))
    a, b, place = x.a.to_numpy(), x.b.to_numpy(), np.stack([x.no_id.to_numpy(np.int64), x.id.to_numpy(), x.mark.to_numpy(), np.maximum(x["at"].to_numpy(np.int64), -1)])
    order = np.lexsort((*place[::-1], b, a))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    sure = np.empty(len(order), bool)
    sure[order] = (place[:, order] != place[:, first]).any(0)
    own = mix((x.mark.to_numpy() + x["at"].to_numpy(np.int64)).view(np.uint64)).view(np.int64)
    return x.assign(a=np.where(sure, own, a), sure=sure)


def repeated_positions(docs: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS, runs: bool = False) -> DataFrame:
    """(id, no_id, mark, positions): for rows with spans that stood before, these as (at, n). mark is a hash of the text.

    The first of a span is that with the smallest doc_id, then hash of its text, then position; null doc_ids come last. Rows
    alike in doc_id and text count as one document. The spans are shuffled once, by their hash, and ranked where they land.
    """

    small_batches(docs.sparkSession)

    @tidied
    def spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            got = [span_hashes(t, span, min_words, runs) for t in x.text]
            sizes = [len(g[0]) for g in got]
            cat = lambda i, kind, got=got: np.concatenate([g[i] for g in got] or [[]]).astype(kind)
            of = np.repeat(np.arange(len(got)), sizes)
            yield mark_later(pd.DataFrame({
                "a": cat(2, np.int64), "b": cat(3, np.int32), "id": x.id.to_numpy(np.int64)[of], "no_id": x.no_id.to_numpy(bool)[of],
                "mark": x.mark.to_numpy(np.int64)[of], "at": cat(0, np.int32), "n": cat(1, np.int32),
            }))

    rows = docs.select(*id_columns(F.col("doc_id")), F.xxhash64("text").alias("mark"), "text").where("text IS NOT NULL")
    found = rows.mapInPandas(spans, FOUND)
    place = W.partitionBy("a", "b").orderBy("no_id", "id", "mark", F.greatest("at", F.lit(-1)))
    later = found.withColumn("rank", F.rank().over(place)).where("sure OR rank > 1")
    return later.groupBy("id", "no_id", "mark").agg(F.collect_set(F.struct("at", "n")).alias("positions"))


def drop_repeated_spans(docs: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS, runs: bool = False) -> DataFrame:
    """(row, text, n_removed, removed) for every row of docs (doc_id, text, any others).

    row is the row itself as a struct, so that no column of docs can clash; text what is left of its text, removed the (start,
    end) of what went, in characters of the text. A null text stays null; an empty one, or one without a repeated span, stays
    as it is, and one that consists of such spans becomes empty. Texts of any length are taken whole. No rows give no rows.
    With runs, words that stood in a document before go as well, and n_removed counts each sentence of which something went.
    Rows and positions meet by shuffle at every size; each text is in it once.
    """
    gone = repeated_positions(docs.select("doc_id", "text"), span, min_words, runs)
    rows = docs.select(packed(docs), *id_columns(F.col("doc_id")), F.xxhash64("text").alias("mark"))
    rows = rows.join(gone.hint("merge"), ["id", "no_id", "mark"], "left").select("row", "positions")

    @tidied
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts, starts, numbers in batches:
            yield pd.DataFrame([without(*x) for x in zip(texts, starts, numbers, strict=True)], columns=["text", "n_removed", "removed"])

    cut = F.pandas_udf(cut, "text string, n_removed int, removed array<struct<start int, end int>>")
    plain = F.struct(F.col("row.text").alias("text"), F.lit(0).alias("n_removed"), F.expr("cast(array() as array<struct<start int, end int>>)").alias("removed"))
    # rows without positions send no text to Python
    done = rows.withColumn("x", cut(F.when(F.col("positions").isNotNull(), F.col("row.text")), "positions.at", "positions.n"))
    return done.withColumn("x", F.when(F.col("positions").isNull(), plain).otherwise(F.col("x"))).select("row", "x.*")


def without(text: str | None, at: np.ndarray | None, many: np.ndarray | None) -> tuple[str | None, int, list[dict]]:
    """What is left of a text without some spans, of how many sentences something went, and where that was."""
    if at is None or text is None:
        return text, 0, []
    found = sentences(text)
    covered = {i for p, n in zip(at, many, strict=True) if p >= 0 for i in range(p, p + n)}
    pieces = [found[i] for i in covered]
    runs = [(-1 - p, n) for p, n in zip(at, many, strict=True) if p < 0]
    if runs:
        ws = [m.span() for m in WORD.finditer(text)]
        starts = [a for a, _ in found]
        whole = np.zeros(len(found) + 1, bool)
        whole[list(covered)] = True
        for p, n in runs:
            a, b = ws[p][0], ws[p + n - 1][1]
            if not whole[bisect_right(starts, a) - 1 : bisect_left(starts, b)].any():
                pieces.append((a, b))
        for a, b in pieces[whole.sum() :]:
            covered.update(range(bisect_right(starts, a) - 1, bisect_left(starts, b)))
    ranges: list[list[int]] = []
    for a, b in sorted(pieces):
        if ranges and ranges[-1][1] >= a:
            ranges[-1][1] = max(b, ranges[-1][1])
        else:
            ranges.append([a, b])
    kept, last = [], 0
    for a, b in ranges:
        kept.append(text[last:a])
        last = b
    return "".join([*kept, text[last:]]), len(covered), [{"start": a, "end": b} for a, b in ranges]


def dedup_documents(docs: DataFrame) -> DataFrame:
    """docs with what is left of their texts, n_chars following it; rows of which nothing but white space is left go.

    Rows without any text before stay as they are. Rows, nulls and clashing names: as drop_repeated_spans has them.
    """
    x = drop_repeated_spans(docs, runs=True)
    x = x.where(~((F.col("n_removed") > 0) & (F.trim("text") == "")))
    for name, value in (("text", F.col("text")), ("n_chars", F.length("text").cast("long"))):
        if name in docs.columns:
            changed = F.when(F.col("n_removed") > 0, value).otherwise(F.col("row")[name])
            x = x.withColumn("row", F.col("row").withField(name, changed.cast(docs.schema[name].dataType)))
    return x.select("row.*")
