"""Alignment, chat formatting and periodic runs against plain Python, and their defined results at the edges."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gablewise.llm import alignment, chat, runs
from gablewise.llm.tokens import byte_alphabet

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, code long, size long, row string, block long, runs string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "r", 3, "x") for i, t in rows], DOCS)


def by_value(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is None, v) for v in r])


# ---------------------------------------------------------------------------------------------- 11: alignment


def alignments(rows):
    """link_digests by comparing the sets of byte offsets, over whole texts encoded by the libraries."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    ta, tb, inverse = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B), {c: n for n, c in byte_alphabet().items()}
    ta.encode_special_tokens = True
    found, held = [], Counter()
    for i, t in rows:
        a, b = (ta.encode(" " + t, add_special_tokens=False).ids, tb.encode(t)) if t else ([], [])
        of_a = [bytes(inverse[c] for c in ta.id_to_token(x)) for x in a]
        of_b = [bytes([int(tb.id_to_piece(x)[3:5], 16)]) if tb.is_byte(x) else tb.id_to_piece(x).replace("▁", " ").encode() for x in b]
        groups = []
        if b"".join(of_a) == b"".join(of_b) == f" {t}".encode():
            ends = [{len(b"".join(x[: k + 1])): k + 1 for k in range(len(x))} for x in (of_a, of_b)] if len(a) < 3000 else []
            at = (0, 0)
            for end in sorted(ends[0].keys() & ends[1].keys()):
                groups.append((a[at[0] : ends[0][end]], b[at[1] : ends[1][end]]))
                at = ends[0][end], ends[1][end]
        else:
            a = b = []
        links = Counter((x, y) for p, q in groups for x in p for y in q)
        held.update(links.keys())
        found.append((i, a, b, groups, links))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    for i, a, b, groups, links in found:
        said = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)
        best, total = sum(m for k, m in links.items() if held[k] == most[k[0]]), sum(m * held[k] for k, m in links.items())
        yield i, len(a), len(b), len(groups), sum(links.values()), best, total, hashlib.sha256(said.encode()).hexdigest() if a else ""


PARTS = ["foo", " ", "  ", "\n", "bar", " the", "<|endoftext|>", "<s>", "é", "漢字", "🙂", "\t", "\r\n", "'s", " \n", "1234", "\x1c", "\x85", "　", "<0x0A>", "don't", "!!", "x" * 50, "\x00", "ﬁ", "a"]


@pytest.mark.parametrize("block", [alignment.BLOCK, 1])
def test_alignment(spark, block):
    r = random.Random(3)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randrange(25))) for _ in range(400)] + [None, "", " ", "▁", "a▁b", "w " * 900, " \n \n ", "w " * 900]
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts)] + [(7, "the same id"), (7, "the same id")]
    got = alignment.link_digests(docs(spark, rows).repartition(3), A, B, block).collect()
    assert by_value(got) == by_value(alignments(rows))
    assert alignment.link_digests(docs(spark, []), A, B).count() == 0


def test_alignment_of_a_table(spark, small):
    d = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in d.where("length(text) < 4000").collect()]
    assert by_value(alignment.link_digests(d.where("length(text) < 4000"), A, B).collect()) == by_value(alignments(rows))


def test_one_huge_word(spark):
    (one,) = alignment.link_digests(docs(spark, [(1, "x" * 70_000)]), A, B).collect()
    assert one.n_groups > 1 and one.n_links == one.n_best == one.count_sum


def test_transducer_states():
    t = alignment.Transducer([b"ab", b"c", b"abc"], [b"a", b"bc", b"b"])

    def groups(a, b):
        ends = [(0, 0)]
        while ends[-1][0] < len(a) or ends[-1][1] < len(b):
            end = t.group(a, ends[-1][0], b, ends[-1][1])
            if end is None:
                return None
            ends.append(end)
        return ends[1:]

    assert groups([0, 1], [0, 1]) == [(2, 2)]
    assert groups([0, 1], [0, 2]) is None and groups([0], [0, 1]) is None and groups([1], [0]) is None
    assert groups([0, 2], [0, 2, 0, 1]) == [(1, 2), (2, 4)]
    assert groups([], []) == [] and groups([], [0]) is None
    assert t.states[t.moves[0][0]] == (1, b"ab") and t.states[t.moves[t.moves[0][0]][0]] == (1, b"b")


# ---------------------------------------------------------------------------------------------- 12: chat


CHAT = "conv_id long, turn long, role string, text string, conv string, part int, formatted string"
EXAMPLE = [(-1, k, r, "</s>[INST] ok [/INST]") for k, r in enumerate(("user", "assistant"))]


def chats(rows):
    found = defaultdict(list)
    for c, t, r, x in rows:
        found[c].append((t is not None, t or 0, r or "", x or ""))
    for c, turns in found.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        yield c, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("segment", [chat.SEGMENT, 4, 1])
def test_chat_round_trip(spark, segment):
    r = random.Random(2)
    bits = ["[INST]", "[/INST]", "</s>", "<s>", "\\", "[", "<", "[\\INST]", "[\\\\NEXT]", "[NEXT]", "[TEXT]", "[/ROLE]", "a", "\n", " ", "é🙂", "$1", "[ROLE]", "/s>", "INST]"]
    text = lambda: r.choice([None, "", *("".join(r.choice(bits) for _ in range(r.randrange(9))) for _ in range(6))])
    rows = [
        (c or None, r.choice([t, t, t, None]), r.choice(["user", "assistant", "system", None, "[TEXT]x</s>", "assistant"]), text())
        for c in range(40) for t in range(r.choice([1, 2, 5, 9, 30]))
    ]
    rows += [(3, 1, "user", "long " * 40_000), (5, 2, "user", "twice"), (5, 2, "user", "twice")]
    got = chat.formatted_conversations(spark.createDataFrame([(*x, "c", 1, "f") for x in rows], CHAT), segment).drop("formatted_chars").collect()
    assert by_value(got) == by_value(chats(rows + EXAMPLE))


def test_parts_are_one_text(spark):
    rows = [(c, t, "assistant" if t // 3 % 2 else "user", f"<s> {t}", "c", 1, "f") for c in (1, 2) for t in range(40 * c)]
    turns = chat.with_example(spark.createDataFrame(rows, CHAT))
    texts = {s: {x.conv.conv_id: (x.formatted, x.under) for x in chat.conversation_texts(turns, s).collect()} for s in (256, 7, 40)}
    assert texts[7] == texts[256] == texts[40]
    assert chat.format_parts(turns, 7).where("part > 0").count() == 5 + 11
    assert texts[7][1][0].startswith("<s>[INST] <\\s> 0[NEXT]<\\s> 1[NEXT]<\\s> 2 [/INST]<\\s> 3[NEXT]")
    assert texts[7][-1][0] == "<s>[INST] <\\/s>[\\INST] ok [\\/INST] [/INST]<\\/s>[\\INST] ok [\\/INST]</s>"


def test_no_conversations_and_the_same_id(spark):
    empty = spark.createDataFrame([], CHAT)
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in chat.formatted_conversations(empty).collect()] == [(-1, 2, 21)]
    own = spark.createDataFrame([(-1, 0, "user", "x", None, None, None)], CHAT)
    assert sorted(r.n_turns for r in chat.formatted_conversations(own).collect()) == [1, 2]


# ---------------------------------------------------------------------------------------------- 13: runs


def plain_runs(ids, least=24, times=3):
    """All stretches of equal words q apart, for every q that is their smallest period."""
    found, n = [], len(ids)
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            start = i
            while i < n - q and ids[i] == ids[i + q]:
                i += 1
            if i > start and i - start + q >= max(least, times * q) and runs.smallest_period(ids[start : i + q]) == q:
                found.append((start, q, i - start + q))
            i += i == start
    return sorted(found)


def test_runs_of_sequences():
    r, total = random.Random(1), 0
    for _ in range(2500):
        k = r.choice([1, 2, 2, 3, 5])
        ids = [r.randrange(k) for _ in range(r.randrange(80))]
        if r.random() < 0.5 and len(ids) > 3:
            part, at = [r.randrange(k) for _ in range(r.randrange(1, 9))], r.randrange(len(ids))
            ids = ids[:at] + part * r.randrange(1, 12) + part[: r.randrange(len(part))] + ids[at:]
        least, times = r.choice([2, 6, 24]), r.choice([2, 3])
        want = plain_runs(ids, least, times)
        total += len(want)
        assert runs.find_runs(ids, least, times) == want
    assert total > 3000


def test_runs_of_long_words_and_bad_hashes(monkeypatch):
    fibonacci, last = [0, 1], [0]
    while len(fibonacci) < 1500:
        fibonacci, last = fibonacci + last, fibonacci
    assert runs.find_runs(fibonacci) == plain_runs(fibonacci)
    assert runs.find_runs([0] * 60_000) == [(0, 1, 60_000)]
    # hashes that collide all the time cost time, but change nothing
    monkeypatch.setattr(runs, "PRIME", 3)
    r = random.Random(4)
    for _ in range(300):
        ids = [r.randrange(2) for _ in range(r.randrange(120))] + [0, 1, 1] * r.randrange(12)
        assert runs.find_runs(ids, 6, 2) == plain_runs(ids, 6, 2)
        assert runs.find_runs(ids) == plain_runs(ids)


def run_rows(rows):
    for i, t in rows:
        ws, h = (t or "").encode().split(), 1 if i is None else zlib.crc32(str(i).encode())
        n, g = len(ws), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [ws[k] if k < a else ws[a + (k - a) % p] for k in range(n)]
        numbers = {}
        found = [(s, m, q) for s, q, m in plain_runs([numbers.setdefault(w, len(numbers)) for w in ws])]
        drop = {k for s, m, q in found for k in range(s + q, s + m)}
        best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if found else (None,) * 3
        said, kept = "".join(f"{s},{m},{q}\n" for s, m, q in found), b" ".join(w for k, w in enumerate(ws) if k not in drop)
        yield i, len(found), *best, 1000 * best[1] // best[2] if found else None, hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def test_run_digests(spark, small):
    d = spark.read.parquet(f"{small}/documents.parquet").where("length(text) < 5000")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    odd = [(None, "a b " * 30), (-5, None), (-6, ""), (-7, " \t\n"), (-8, "w " * 9000), (-8, "w " * 9000), (-9, "é\x85漢 " * 40), (-10, "A a " * 12 + "b"), (-11, "one")]
    odd += [(10_000 + i, f"{i} word") for i in range(60)]
    got = runs.run_digests(d.select("doc_id", "text").union(docs(spark, odd).select("doc_id", "text"))).collect()
    want = by_value(run_rows(rows + odd))
    assert by_value(got) == want and sum(w[1] > 0 for w in want) > 15
    assert runs.run_digests(docs(spark, [])).count() == 0


def test_runs_and_what_they_leave(spark):
    text = "start " + "x y z " * 9 + "end"
    (one,) = runs.periodic_runs(docs(spark, [(1, text)])).collect()
    assert [tuple(r) for r in one.runs] == [(1, 3, 27)] and one.collapsed == "start x y z end"
    assert runs.periodic_runs(docs(spark, [(1, text)]), 30).select(F.size("runs")).first()[0] == 0
