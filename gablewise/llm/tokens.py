"""Token counts of whole texts, with huge documents encoded in overlapping chunks.

Byte-level BPE merges within words of a split pattern. A chunk that starts at an arbitrary place may split its first
characters otherwise than the whole text does; but as soon as both have a word boundary in the same place they agree from
there on, as the pattern looks at nothing before a match. A chunk's last words may be wrong too, as the pattern looks ahead:
past a run of white space, or to the rest of the word; and a special token may be cut. So the place where two chunks are spliced
is a boundary of both that is followed, in the first, by two whole words and as many characters as the longest special token
has. Without one, the overlap is widened, up to the whole document.

A plain text is encoded by the ranks of the same vocabulary (another library, twice as fast) if its merges are ranked as its ids are. Where words count,
or with other vocabularies, the library's model encodes each distinct word of the pattern once per task, which a table of bounded size remembers. Texts of
one chunk with special tokens in them, or characters outside the plain range, go to the library whole; chunks of such texts
have the boundaries that the library's own splitting gives, so that huge texts of any script are spliced alike.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablewise.llm.common import id_again, id_columns, save, small_batches, tidied

OVER = 512
#: Characters of a chunk, and of the overlap of two at first. Texts of at most one chunk are encoded at once.
CHUNK, OVERLAP = 20_000, 200
#: Words that a task remembers.
KNOWN = 100_000
#: The range in which character classes are taken from a table; texts with others go to the library.
PLAIN = 0x250
#: Characters that are encoded at once by ranks, and where longer texts are cut.
PIECE, CUT = 20_000, re.compile("[A-Za-z](?= [A-Za-z])")


def _class(*kinds: str) -> str:
    return "".join(re.escape(chr(i)) for i in range(PLAIN) if unicodedata.category(chr(i))[0] in kinds)


def word_pattern() -> re.Pattern:
    """The split pattern of the byte-level vocabularies, for texts of plain characters."""
    space = re.escape("\t\n\x0b\x0c\r \x85\xa0")
    letter, number = _class("L"), _class("N")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


def byte_alphabet() -> dict[int, str]:
    """How byte-level vocabularies write each byte: visible Latin-1 characters as themselves, the others from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(256, 512))
    return {b: chr(b if b in shown else next(other)) for b in range(256)}


def ranked(vocabulary: str, of: list[bytes]):
    """The encoder that takes a vocabulary's ids as ranks of its merges, given the bytes of each token; None if they aren't."""
    import public_tokenizers
    import tiktoken

    with open(vocabulary, encoding="utf-8") as f:
        model = json.load(f)["model"]
    if model.get("type", "BPE") != "BPE" or len(of) < 256 or any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")):
        return None
    ids, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    order = [ids.get(x + y, -1) for x, y in merges]
    known = set(ids.values())
    if order != list(range(256, 256 + len(order))) or any(len(of[i]) != 1 for i in range(256)) or not known.issuperset(range(256 + len(order))):
        return None
    ranks = {of[i]: i for i in range(256 + len(order))}
    if len(ranks) != 256 + len(order):
        return None
    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Texts to token ids (32-bit little-endian, joined), as the library's encode gives them without special tokens added."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.guard = max(map(len, added), default=0)
        byte_level = str(type(self.library.pre_tokenizer).__name__) == "ByteLevel" and self.library.normalizer is None
        self.words = word_pattern() if byte_level else None
        # the model itself takes a word as the library's byte alphabet writes it
        self.model, self.bytes = self.library.model, byte_alphabet()
        self.strange = re.compile(f"[^\\x00-{re.escape(chr(PLAIN - 1))}‐-‧‰-⁞]")
        self.known: dict[str, bytes] = {}
        self.fast = ranked(vocabulary, self.token_bytes()) if byte_level else None

    def token_bytes(self) -> list[bytes]:
        """The bytes of each token of a byte-level vocabulary; of a special token none."""
        back, ids = {c: bytes([b]) for b, c in self.bytes.items()}, self.library.get_vocab(with_added_tokens=False)
        of = [b""] * (max(ids.values(), default=-1) + 1)
        for token, i in ids.items():
            of[i] = b"".join(back.get(c, b"") for c in token)
        return of

    def pieces(self, text: str) -> list[str] | None:
        """A plain text cut where a letter is followed by one space and a letter, which is an end of words in any context; None if there is no such place far on."""
        if len(text) <= PIECE:
            return [text]
        out, at = [], 0
        while len(text) - at > PIECE:
            m = CUT.search(text, at + PIECE // 2, at + PIECE)
            if not m:
                return None
            out.append(text[at : m.start() + 1])
            at = m.start() + 1
        return [*out, text[at:]]

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def plain(self, text: str) -> bool:
        """Has a text only characters whose words the pattern finds, and no special tokens?"""
        return not (self.words is None or self.strange.search(text) or self.special and self.special.search(text))

    def split(self, text: str) -> list[str] | None:
        """The words that merges stay within; None for a text that only the library can split."""
        return self.words.findall(text) if self.plain(text) else None

    def library_words(self, text: str) -> tuple[list[int], list[int]]:
        """The ends of the library's words in characters, and the tokens of each; a special token is a word."""
        ends, tokens, at = [], [], 0
        for m in [*(self.special.finditer(text) if self.special else ()), None]:
            for w, (_, end) in self.library.pre_tokenizer.pre_tokenize_str(text[at : m.start() if m else len(text)]):
                ends.append(at + end)
                tokens.append(len(self.model.tokenize(w)))
            if m:
                at = m.end()
                ends.append(at)
                tokens.append(1)
        return ends, tokens

    def of_words(self, ws: list[str]) -> list[bytes]:
        known = self.known
        try:
            return [known[w] for w in ws]
        except KeyError:
            pass
        if len(known) > KNOWN:
            known.clear()
        for w in ws:
            if w not in known:
                written = w.encode("utf-8").decode("latin-1").translate(self.bytes)
                known[w] = array("I", [t.id for t in self.model.tokenize(written)]).tobytes()
        return [known[w] for w in ws]

    def __call__(self, text: str) -> bytes:
        if not self.plain(text):
            return self.whole(text)
        pieces = self.pieces(text) if self.fast else None
        if pieces is None:
            return b"".join(self.of_words(self.words.findall(text)))
        return b"".join(self.fast.encode_to_numpy(p, disallowed_special=()).astype("<u4", copy=False).tobytes() for p in pieces)


def cached_encoder(vocabulary: str) -> Encoder:
    """The process's encoder of a vocabulary, with nothing remembered: Python workers are used again by later tasks."""
    home = sys.modules.setdefault("_gablewise_encoders", type(sys)("_gablewise_encoders")).__dict__
    if vocabulary not in home:
        home[vocabulary] = Encoder(vocabulary)
    home[vocabulary].known.clear()
    return home[vocabulary]


def chunks_of(n: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of chunks of a text of n characters; each overlaps the next."""
    starts = range(0, max(1, n - overlap), chunk)
    return [(a, min(n, a + chunk + overlap)) for a in starts]


def boundaries(encoder: Encoder, text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """The ends of a chunk's words in characters, and the tokens up to each; None if the vocabulary isn't byte-level."""
    ws = encoder.split(text)
    if ws is None:
        if encoder.words is None:
            return None
        ends, tokens = encoder.library_words(text)
        return np.array(ends, np.int64), np.cumsum(np.array(tokens, np.int64))
    tokens = np.fromiter((len(x) // 4 for x in encoder.of_words(ws)), np.int64, len(ws))
    return np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws))), np.cumsum(tokens)


def splice(parts: list[tuple[int, int, np.ndarray, np.ndarray, int]], guard: int = 0) -> int | None:
    """The tokens of a document from its chunks (start, end, boundaries, tokens up to them, all its tokens), or None.

    Boundaries are in characters of the document and hold, of each chunk, those in its overlaps with the neighbours. guard:
    the characters of the longest special token.
    """
    total, before = 0, 0  # before: tokens of the chunk that precede the last splice
    for i, (_, end, at, upto, every) in enumerate(parts):
        if i + 1 == len(parts):
            return total + every - before
        _, _, there, upto2, _ = parts[i + 1]
        stable = at[:-2]  # two whole words follow
        stable = stable[stable <= end - guard]
        common, x, y = np.intersect1d(stable, there, return_indices=True)
        if not len(common) or upto[x[-1]] < before:
            return None
        total += int(upto[x[-1]]) - before
        before = int(upto2[y[-1]])
    return total


def token_counts(docs: DataFrame, vocabulary: str, chunk: int = CHUNK, overlap: int = OVERLAP, over: int = OVER) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of docs (doc_id, text).

    The counts are those of the library on the whole text, with nothing added. A null text counts as an empty one. Null and
    repeated doc_ids give a row each; other columns of docs don't matter. No rows give no rows. Only a text that has no common
    boundary in overlaps as long as a chunk, like one word of that length, is encoded in one piece.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(*id_columns(F.col("doc_id")), F.coalesce("text", F.lit("")).alias("text"))

    @tidied
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = cached_encoder(vocabulary)
        for x in batches:
            x["n_tokens"] = [len(encoder(t)) // 4 for t in x.pop("text")]
            yield x
        encoder.known.clear()

    counted = "id long, no_id boolean, n_bytes long, n_tokens long"
    rows = rows.select("id", "no_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    size = F.length("text")
    short = rows.where(size <= chunk).mapInPandas(count, counted)
    # a huge text is one row a chunk; its own hash and number tell it from others with the same doc_id
    todo = rows.where(size > chunk).withColumn("mark", F.monotonically_increasing_id()).select("id", "no_id", "n_bytes", "mark", "text")
    todo = save(todo, "huge-texts")
    out, guard = [short], Encoder(vocabulary).guard
    while todo.take(1):
        step, back = chunk, overlap

        @tidied
        def to_chunks(batches: Iterator[pd.DataFrame], step: int = step, back: int = back) -> Iterator[pd.DataFrame]:
            for x in batches:
                for doc, none, n, mark, text in x.itertuples(index=False):
                    spans = chunks_of(len(text), step, back)
                    yield pd.DataFrame({"id": doc, "no_id": none, "n_bytes": n, "mark": mark, "start": [a for a, _ in spans], "end": [b for _, b in spans], "text": [text[a:b] for a, b in spans]})

        @tidied
        def encode(batches: Iterator[pd.DataFrame], step: int = step, back: int = back) -> Iterator[pd.DataFrame]:
            encoder = cached_encoder(vocabulary)
            for x in batches:
                got = []
                for a, b, t in zip(x.start, x.end, x.text, strict=True):
                    found = boundaries(encoder, t)
                    if found is None:
                        got.append(([], [], -1))
                        continue
                    at, upto = found
                    near = (at <= back + 1) | (at >= b - a - back)
                    got.append((at[near] + a, upto[near], int(upto[-1]) if len(upto) else 0))
                x["at"], x["upto"], x["every"] = zip(*got, strict=True) if got else ([], [], [])
                yield x.drop(columns="text")
            encoder.known.clear()

        def join(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("start")
            bad = (pdf.every < 0).any()
            n = None if bad else splice([(a, b, np.asarray(p), np.asarray(u), e) for a, b, p, u, e in zip(pdf.start, pdf.end, pdf["at"], pdf.upto, pdf.every, strict=True)], guard)
            one = pdf.iloc[:1]
            return one[["id", "no_id", "n_bytes", "mark"]].assign(n_tokens=pd.array([n], "Int64"))

        spread = todo.mapInPandas(to_chunks, "id long, no_id boolean, n_bytes long, mark long, start long, end long, text string")
        encoded = spread.repartition("mark", "start").mapInPandas(encode, "id long, no_id boolean, n_bytes long, mark long, start long, end long, at array<long>, upto array<long>, every long")
        joined = save(encoded.groupBy("mark").applyInPandas(join, "id long, no_id boolean, n_bytes long, mark long, n_tokens long"), "huge-counts")
        out.append(joined.where("n_tokens IS NOT NULL").select("id", "no_id", "n_bytes", "n_tokens"))
        todo = save(todo.join(joined.where("n_tokens IS NULL").select("mark"), "mark").select("id", "no_id", "n_bytes", "mark", "text"), "huge-texts")
        if overlap >= chunk:  # the chunks were mostly overlap: the library takes these texts whole
            out.append(todo.select("id", "no_id", "n_bytes", "text").mapInPandas(count, counted))
            break
        overlap *= 16
    result = out[0]
    for x in out[1:]:
        result = result.unionByName(x)
    return result.select(id_again().alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > over).alias("over_limit"))
