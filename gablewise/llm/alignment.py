"""Alignment of two tokenizers: which tokens of one stand where tokens of the other stand, and how often over a corpus.

Two token sequences of the same bytes are read by a transducer. Its state is the dangling suffix: which side is ahead, and the bytes
by which it is. The side behind reads its next token; where the suffix becomes empty both sides end in the same byte, and a group
of tokens closes. Transitions depend on the state and the next token alone and are remembered. There are no more states than tokens
have suffixes.

Both vocabularies here never join what stands on two sides of a space or a line feed that follows another character than white space (the
constructor verifies it), so a text falls into units there. A unit's ids and groups are remembered too, if it is short; a text is the sum of its
units. With other vocabularies a text is one unit. Units of plain characters are encoded by another library with the ranks of the same
vocabulary, if its merges are ranked as its ids are, which is faster; all others by the vocabulary's own.

Counts over the corpus: a document yields each of its id pairs once, with how often it links them. Blocks of documents sum up their pairs before
anything is shuffled, totals go back to the blocks, and the documents of a block look their pairs up there; so a pair that all
documents hold travels once a block.
"""

from __future__ import annotations

import os
import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablewise.llm.common import id_again, id_columns, save, small_batches, tidied
from gablewise.llm.tokens import byte_alphabet, ranked

#: Units that a task remembers, twice, the characters of each at most, and transitions.
UNITS, UNIT_SIZE, TRANSITIONS = 100_000, 40, 500_000
#: Links of a unit that are listed one by one; a unit of more gives its pairs with their numbers.
LISTED = 4096
#: Bytes of text whose documents sum up their pairs together.
BLOCK = 16 << 20
SPACE = "▁"
PLAIN = re.compile(r"[\x00-\u024f‐-‧]*")


class Transducer:
    """Reads token ids of two sides, given the bytes of all tokens of each. State 0: nothing dangles, and side 0 reads next."""

    def __init__(self, a: list[bytes], b: list[bytes]):
        self.bytes = a, b
        self.forget()

    def forget(self) -> None:
        self.states, self.numbers = [(0, b"")], {(0, b""): 0}  # which side is behind, and by what
        self.behind, self.moves, self.size = [0], [{}], 0

    def step(self, state: int, token: int) -> int:
        """The state after the side behind has read a token; -1 if the bytes differ."""
        behind, rest = self.states[state]
        read = self.bytes[behind][token]
        if rest.startswith(read):
            after = (behind, rest[len(read) :])
        elif read.startswith(rest):
            after = (1 - behind, read[len(rest) :])
        else:
            return -1
        if not after[1]:
            after = (0, b"")
        if after not in self.numbers:
            self.numbers[after] = len(self.states)
            self.states.append(after)
            self.behind.append(after[0])
            self.moves.append({})
        self.moves[state][token] = self.numbers[after]
        self.size += 1
        return self.numbers[after]

    def group(self, a: list[int], i: int, b: list[int], j: int) -> tuple[int, int] | None:
        """Where the group ends that starts at a[i] and b[j]; None if it doesn't, or the bytes differ."""
        if self.size > TRANSITIONS:
            self.forget()
        n, m, behind, moves, state = len(a), len(b), self.behind, self.moves, 0
        while True:
            if behind[state]:
                if j == m:
                    return None
                token = b[j]
                j += 1
            else:
                if i == n:
                    return None
                token = a[i]
                i += 1
            after = moves[state].get(token)
            if after is None:
                after = self.step(state, token)
                if after < 0:
                    return None
            if not after:
                return i, j
            state = after


class Aligner:
    """Texts to groups of the ids of a byte-level vocabulary (a, of the whole text behind a space) and of a piece vocabulary (b)."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a), SentencePieceProcessor(model_file=b)
        self.a.encode_special_tokens = True
        to_byte = {c: n for n, c in byte_alphabet().items()}
        spelled = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        of_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.size_b = len(pieces)
        self.transducer = Transducer([bytes(to_byte.get(c, 0) for c in t) for t in spelled], of_b)
        self.mark = pieces.index(SPACE) if SPACE in pieces else -1
        across = re.compile(rf"[^{SPACE}]{SPACE}|.\n|\n.", re.S)
        apart = self.mark >= 0 and str(type(self.a.pre_tokenizer).__name__) == "ByteLevel" and self.a.normalizer is None
        self.apart = apart and not any(across.search(p) for p in pieces) and self.b.encode(" a  b") == self.b.encode(" a") + self.b.encode(" b")
        self.cut = re.compile(r"(?<=\S)(?=[ \n])")
        self.fast = plain.encode_ordinary if apart and (plain := ranked(a, self.transducer.bytes[0])) else None
        self.lengths = [np.array(list(map(len, x)), np.int64) for x in self.transducer.bytes]
        self.pairs: dict[int, str] = {}  # of groups of one token each: how they are written; others have ""
        self.known: dict[str, tuple | bool] = {}
        self.before: dict[str, tuple | bool] = {}  # known before the last were too many

    def ids_a(self, text: str) -> list[int]:
        return self.fast(text) if self.fast and PLAIN.fullmatch(text) else self.a.encode(text, add_special_tokens=False).ids

    def ids_b(self, text: str) -> list[int]:
        """The ids of a text that starts with a space, which the library adds, or with a line feed, before which it adds one too."""
        return (self.b.encode(text[1:]) or [self.mark]) if text[0] == " " else self.b.encode(text)[1:]

    def ids(self, units: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """The ids of a and b of each unit, from those of all of them in a row, which end where units do."""
        text = "".join(units)
        ends, parts = np.cumsum([len(u.encode()) for u in units]), []
        for encode, lengths in ((self.ids_a, self.lengths[0]), (self.ids_b, self.lengths[1])):
            ids = encode(text)
            upto = np.cumsum(lengths[ids])
            at = np.searchsorted(upto, ends)
            if not len(upto) or at[-1] >= len(upto) or (upto[at] != ends).any():  # not these bytes, or not these units
                return ((self.ids_a(u), self.ids_b(u)) for u in units)
            stops = (at + 1).tolist()
            parts.append([ids[i:j] for i, j in zip([0, *stops], stops, strict=False)])
        return zip(*parts, strict=True)

    def align(self, units: list[str]) -> list[tuple | bool]:
        """(tokens of a, of b and groups in one number, groups written, codes of all links, codes with their numbers if many) of units; False where the bytes differ."""
        out, width, of_a, group, pairs = [], self.size_b, self.transducer.bytes[0], self.transducer.group, self.pairs
        for u, (a, b) in zip(units, self.ids(units), strict=True):
            i = j = links = 0
            n, m, written, codes, large = len(a), len(b), [], [], []
            while i < n and j < m:
                code = a[i] * width + b[j]
                pair = pairs.get(code)
                if pair:
                    written.append(pair)
                    codes.append(code)
                    i += 1
                    j += 1
                    continue
                end = group(a, i, b, j)
                if end is None:
                    break
                k, l = end  # noqa: E741
                p, q = a[i:k], b[j:l]
                written.append(f"{','.join(map(str, p))}|{','.join(map(str, q))}")
                if pair is None:
                    pairs[code] = written[-1] if k - i == l - j == 1 else ""
                if len(p) * len(q) > LISTED:
                    large.append((p, q))
                else:
                    codes += [x * width + y for x in p for y in q]
                links += len(p) * len(q)
                i, j = k, l
            if i < n or j < m or b"".join([of_a[x] for x in a]) != u.encode():
                out.append(False)
                continue
            times = None
            if large or links > LISTED:
                times = Counter(codes)
                for p, q in large:
                    of_q = Counter(q).items()
                    for x, c in Counter(p).items():
                        for y, d in of_q:
                            times[x * width + y] += c * d
                codes = ()
            out.append(((n << 80) + (m << 40) + len(written), ";".join(written), array("q", codes).tobytes(), times))
        if len(pairs) > TRANSITIONS:
            pairs.clear()
        return out

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        return self.cut.split(" " + text) if self.apart else [" " + text]

    def of_units(self, units: list[str]) -> list[tuple | bool]:
        got = list(map(self.known.get, units))
        if None not in got:
            return got
        missing = {u for u, x in zip(units, got, strict=True) if x is None}
        if len(self.known) + len(missing) > UNITS:
            self.known, self.before = {}, self.known
        new, before = [u for u in missing if u not in self.before], self.before
        found = {u: before[u] for u in missing if u in before}
        if new:
            found.update(zip(new, self.align(new), strict=True))
        self.known.update((u, x) for u, x in found.items() if len(u) <= UNIT_SIZE)
        return [found[u] if x is None else x for u, x in zip(units, got, strict=True)]

    def __call__(self, texts: list[str]) -> Iterator[tuple]:
        """(n_a, n_b, n_groups, groups written, codes, times) for each text; without tokens where the bytes differ."""
        nothing = (0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))
        low = (1 << 40) - 1
        for text in texts:
            got = self.of_units(self.units(text))
            if not got or False in got:
                yield nothing
                continue
            numbers, written, listed, counted = zip(*got, strict=True)
            codes, times = np.unique(np.frombuffer(b"".join(listed), np.int64), return_counts=True)
            if any(counted):
                every = Counter(dict(zip(codes.tolist(), times.tolist(), strict=True)))
                for c in filter(None, counted):
                    every.update(c)
                codes = np.array(sorted(every), np.int64)
                times = np.array([every[c] for c in codes.tolist()], np.int64)
            n = sum(numbers)
            yield n >> 80, n >> 40 & low, n & low, ";".join(written), codes, times


def align_documents(docs: DataFrame, a: str, b: str, block: int = BLOCK) -> DataFrame:
    """A row (of_block false) for every row of docs (doc_id, text), and one (of_block true) for each block of them.

    A document's: id, no_id, n_a, n_b, n_groups, the groups as `a1,a2|b1;a3|b2,b3`, the codes of its linked pairs and how often it links
    each. A block's: the codes of the pairs of its documents, and how many of them hold each. A code is a's id times b's number of ids, plus b's id.
    """
    small_batches(docs.sparkSession)

    @tidied
    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner, part = Aligner(a, b), TaskContext.get().partitionId() << 33
        number, room, held = 0, block, []
        counts = ["n_a", "n_b", "n_groups"]

        def of_block() -> pd.DataFrame:
            codes, times = np.unique(np.concatenate([np.empty(0, np.int64), *held]), return_counts=True)
            return pd.DataFrame({"block": [part + number], "of_block": True, "id": 0, "no_id": True, **dict.fromkeys(counts, 0), "groups": "", "codes": [codes], "times": [times]})

        for x in batches:
            size = int(x["size"].sum())
            texts = x.pop("text").tolist()
            x = x.drop(columns="size").assign(block=part + number, of_block=False)
            x["n_a"], x["n_b"], x["n_groups"], x["groups"], x["codes"], x["times"] = zip(*aligner(texts), strict=True) if texts else [[]] * 6
            held += x["codes"].tolist()
            yield x[["block", "of_block", "id", "no_id", *counts, "groups", "codes", "times"]]
            room -= size
            if room <= 0:
                yield of_block()
                number, room, held = number + 1, block, []
        if held:
            yield of_block()

    rows = docs.select(*id_columns(F.col("doc_id")), F.coalesce("text", F.lit("")).alias("text")).select("id", "no_id", F.octet_length("text").cast("long").alias("size"), "text")
    return rows.mapInPandas(align, "block long, of_block boolean, id long, no_id boolean, n_a long, n_b long, n_groups long, groups string, codes array<long>, times array<long>")


def link_digests(docs: DataFrame, a: str, b: str, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of docs (doc_id, text).

    A pair's count: the rows of docs that hold it linked. n_best: links whose count is the highest of their id of a, ties included; count_sum: the counts
    summed over links. A null or empty text, and one that the tokens don't give back byte by byte, has no tokens: zeros, and an
    empty groups_sha256. Null and repeated doc_ids give a row each; other columns of docs don't matter; no rows give no rows. A very
    long text is one task's work; what it leaves are its distinct pairs.
    """
    from sentencepiece import SentencePieceProcessor

    size_b = SentencePieceProcessor(model_file=b).get_piece_size()
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    found = save(align_documents(docs, a, b, block).withColumn("groups_sha256", digest).drop("groups"), "alignments")
    pairs = found.where("of_block").select(F.col("block").alias("at"), F.explode(F.arrays_zip("codes", "times")).alias("x"))
    pairs = pairs.select("at", F.col("x.codes").alias("code"), "x.times")
    # at most as many rows as there are pairs of ids, whatever the number of documents
    counts = pairs.groupBy("code").agg(F.sum("times").alias("count")).withColumn("a", F.floor(F.col("code") / size_b))
    counts = save(counts, "alignment-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    counts = counts.join(most, "a").select("code", "count", (F.col("count") == F.col("most")).alias("best"))
    table = pairs.select("at", "code").join(counts, "code")

    def look_up(docs: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("code")
        code, count, best = (table[c].to_numpy() for c in ("code", "count", "best"))
        got = []
        for codes, times in zip(docs["codes"], docs["times"], strict=True):
            at, times = np.searchsorted(code, codes), np.asarray(times, np.int64)
            got.append((int(times.sum()), int(times[best[at]].sum()), int((times * count[at]).sum())) if len(times) else (0, 0, 0))
        out = docs.drop(columns=["block", "codes", "times"])
        out["n_links"], out["n_best"], out["count_sum"] = zip(*got, strict=True) if got else [[]] * 3
        return out

    columns = "id long, no_id boolean, n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, n_best long, count_sum long"
    rows = found.where("NOT of_block").drop("of_block")
    out = rows.groupBy("block").cogroup(table.groupBy("at")).applyInPandas(look_up, columns)
    return out.select(id_again().alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
