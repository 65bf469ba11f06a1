"""The corpus operators against brute force, exact round trips and held-out accuracy; and their defined results at the edges."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gablewise.llm import fingerprints, jaccard, mixing, packing, quality, spans, tokens, topk, urls, warc
from gablewise.llm.common import mix, shingle_set
from gablewise.llm.components import connected_components

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, row string"
ODD = ["", None, " ", "one", "two words", "A b C d e f g", "x" * 70_000, "a<|endoftext|>b", "it's\x1c \x85\xa0ok 漢字 🙂", "w " * 9000]


def docs(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", None if i % 7 == 3 else f"s{i % 3}", len(t or ""), 5, "k", "r") for i, t in enumerate(texts)], DOCS)


def prose(r, n, words=400):
    return " ".join(r.choice("abcdefghij") * (k % 3 + 1) + str(r.randrange(words)) + ("." if k % 9 == 8 else "") for k in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, repeated rows, rows that share an id, and rows without one."""
    d = docs(spark, ODD)
    big = (1 << 53) + 1  # an id that floats don't hold
    extra = [(big, "a text with a large id", None, None, None, None, None, None), (2, " ", "en", "s2", 1, 5, "k", "r"), (4, "another text of the same id", "en", "s1", 1, 5, "k", "r"), (None, None, None, None, None, None, None, None), (None, "no id at all", None, None, None, None, None, None)]
    return d.unionByName(d.where("doc_id = 4")).unionByName(spark.createDataFrame(extra, DOCS))


# ---------------------------------------------------------------------------------------------- 1: WARC

PAGES = "page_id long, url string, html string, payload string, visit int"


def test_warc_round_trip(spark):
    nasty = "é\r\n\r\nWARC/1.1\r\nWARC-Type: x\r\n\r\n" * 3
    rows = [(1, "http://a", "x" * 200_000), (2, "http://b", "x" * 200_000), (3, None, None), (4, "u", ""), (None, "n", nasty), (6, "z", nasty), (7, "q", "é" * 9001), (7, "q", "é" * 9001), (8, "q", "é" * 9001), (None, "n", "only"), (9, "a\nb", "a\r\n\r\nWARC/1.1\n")]
    rows += [(100 + i, "http://x", chr(97 + i % 26) * (i * 37 % 3000)) for i in range(3000)]
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], PAGES)
    got = warc.archive_round_trip(df, 5000).collect()
    assert len(got) == len(rows)
    least = {}
    for p, _, h in rows:
        least[h or ""] = min(least.get(h or "", 1 << 60), 1 << 60 if p is None else p)
    want = sorted(repr((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), *(("response", None) if p == m or m == 1 << 60 else ("revisit", m)), True)) for p, _, h in rows for b, m in [((h or "").encode(), least[h or ""])])
    assert sorted(repr(tuple(r)) for r in got) == want
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_common_pages_have_segments(spark, small):
    pages = [r.html.encode() for r in spark.read.parquet(f"{small}/pages.parquet").where("html is not null").collect()]
    several = [len(warc.segments("urn:uuid:x", warc.chunked(p), warc.SEGMENT, Content_Type="text/html")) > 1 for p in pages]
    assert sum(several) > len(pages) / 4


def test_warc_broken_segments(spark):
    def rec(origin, n, block, total=None, length=None):
        return ("response" if n == 1 else "continuation", f"<{origin}:{n}>" if n > 1 else f"<{origin}>", 1, None, "d", n, None if n == 1 else f"<{origin}>", total, bytearray(block), True)

    rows = [rec("a", 1, b"ab"), rec("a", 3, b"ef", 6), rec("a", 2, b"cd"), rec("b", 1, b"ab"), rec("b", 3, b"ef", 6), rec("c", 1, b"ab"), rec("c", 2, b"cd", 9), rec("d", 1, b"ab"), rec("d", 2, b"cd", 4), rec("d", 2, b"cd", 4)]
    got = {r.record_id: (bytes(r.block), r.whole) for r in warc.reassemble(spark.createDataFrame(rows, warc.RECORD)).collect()}
    assert got["<a>"] == (b"abcdef", True) and got["<d>"] == (b"abcd", True)
    assert not got["<b>"][1] and not got["<c>"][1]


def test_warc_of_others(spark, tmp_path):
    """Records by Content-Length: blocks that hold version lines, several versions, gzip members, malformed headers."""
    import gzip

    http = b"HTTP/1.1 200 OK\r\n\r\n"
    rec = lambda n, body, version=b"1.0", length=None, more=b"": b"WARC/%s\r\nWARC-Type: response\r\nWARC-Record-ID: <r%d>\r\n%sContent-Length: %s\r\n\r\n%s\r\n\r\n" % (version, n, more, str(len(body)).encode() if length is None else length, body)
    bodies = [http + b"plain", http + b"a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", b"", http + b"\r\n\r\nWARC/ and WARC/1.0\r\n", http + bytes(range(256)) * 20]
    good = [rec(i, b, b"1.1" if i % 2 else b"1.0") for i, b in enumerate(bodies)] + [rec(5, b"x", more=b"WARC-Target-URI: http://h/WARC/1\r\n")]
    bad = [rec(10, b"abc", length=b"999999"), rec(11, b"abc", length=b"x"), rec(12, b"abc", length=b""), rec(13, b"abc", more=b"WARC-Segment-Number: two\r\n"), rec(14, b"abc", length=b"1"), b"WARC/1.0\r\nWARC-Type: response\r\nno end\r\n", b"WARC/1.0\r\n\r\n\r\n\r\n"]
    (tmp_path / "a.warc").write_bytes(b"junk" + b"".join(good))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, [good[0], bad[1], good[1], *bad[2:], *good[2:], bad[0]])))
    for name, many in (("a.warc", 0), ("b.warc.gz", 6)):
        rows = warc.read_records(spark, str(tmp_path / name)).collect()
        got = {r.record_id: (bytes(r.block), r.whole) for r in rows if r.record_id and int(r.record_id[2:-1]) < 10}
        assert got == {f"<r{i}>": (b, True) for i, b in enumerate([*bodies, b"x"])}
        assert sum(not r.whole or bytes(r.block) == b"a" for r in rows) == many
    assert warc.reassemble(warc.read_records(spark, str(tmp_path))).count() > 0


def test_own_archives_are_gzip_members(spark, tmp_path):
    import gzip

    df = spark.createDataFrame([(i, "u", "WARC/1.1\r\n" * i) for i in range(20)], "page_id long, url string, html string")
    warc.write_warc(df, str(tmp_path / "w"), 50)
    raw = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / "w").glob("part*")))
    rows = [r for r in map(warc.parse, (b"WARC/" + x for x in warc.glued(("f", x) for x in raw.split(b"WARC/")))) if r]
    own = warc.read_records(spark, str(tmp_path / "w"), own=True).collect()
    assert sorted(r[1] for r in rows) == sorted(r.record_id for r in own) and all(r.whole for r in own) and len(own) > 40


def test_chunked_framing():
    for p in (b"", b"x", b"ab" * 50_000, warc.VERSION * 4, b"\r\n0\r\n\r\n"):
        assert warc.dechunked(warc.chunked(p, 1000)) == p
    assert warc.dechunked(b"5;x=1\r\nhello\r\n0\r\nTrailer: x\r\n\r\n") == b"hello"
    for broken in (b"", b"5\r\nhel", b"zz\r\nhello\r\n0\r\n\r\n", b"5\r\nhelloXX0\r\n\r\n", b"-5\r\nhello\r\n0\r\n\r\n"):
        assert warc.dechunked(broken) is None


# ---------------------------------------------------------------------------------------------- 2: mixing


def test_mix_follows_targets(spark, odd):
    r = random.Random(1)
    d = docs(spark, [prose(r, r.randrange(1, 60)) for _ in range(300)], 100).unionByName(odd)
    got = mixing.mix_decisions(d).collect()
    again = mixing.mix_decisions(d.repartition(7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again)) and len(got) == d.count()
    source = {x.doc_id: x.source for x in d.collect()}
    taken, target, size = defaultdict(int), {}, defaultdict(int)
    for x in got:
        s = source[x.doc_id]
        taken[s] += x.taken
        size[s] += x.size
        target[s] = x.target
        assert 0 <= x.taken <= 2 * x.size
    total = sum(size.values())
    assert sum(target.values()) == pytest.approx(1.5 * total)
    left = {s: w for s, w in zip(sorted(size, key=lambda s: (s is None, s)), [3, 1, 2] * 9)}
    want, rest, open_ = {}, 1.5 * total, dict(left)
    while True:
        share = {s: rest * w / sum(open_.values()) for s, w in open_.items()}
        full = [s for s in open_ if share[s] > 2 * size[s]]
        if not full:
            want |= share
            break
        for s in full:
            want[s] = 2 * size[s]
            rest -= want[s]
            del open_[s]
    for s in size:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 3
    assert mixing.mix_decisions(d.limit(0)).count() == 0
    mixed = mixing.mix_documents(d)
    assert mixed.columns == d.columns
    assert mixed.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == pytest.approx(1.5 * total, rel=0.2)


# ---------------------------------------------------------------------------------------------- 3: sentence spans


def test_repeated_passages_go(spark):
    r = random.Random(2)
    passage = " ".join(f"Sentence {i} of the shared passage has {'several ' * 6}words." for i in range(6))
    own = [prose(r, 80) + "." for _ in range(6)]
    alone = "One sentence of its own that makes up all of two texts, word for word, and has no stop"
    texts = [own[0] + " " + passage + " " + own[1], own[2] + "\n" + passage + "\n" + own[3], passage, own[4], alone, alone, own[5]]
    d = docs(spark, texts)
    got = {x.row.doc_id: x for x in spans.drop_repeated_spans(d).collect()}
    assert [got[i].text for i in (0, 3, 4, 6)] == [texts[i] for i in (0, 3, 4, 6)]
    assert "shared passage" not in got[1].text and own[2] in got[1].text and own[3] in got[1].text
    assert got[2].text == "" and got[5].text == ""
    assert "".join(texts[1][a:b] for a, b in [(0, got[1].removed[0].start), (got[1].removed[-1].end, len(texts[1]))]) == got[1].text
    kept = spans.dedup_documents(d)
    assert kept.columns == d.columns and {x.doc_id for x in kept.collect()} == {0, 1, 3, 4, 6}
    assert all(x.n_chars == len(x.text) for x in kept.collect())


def test_passages_of_short_lines_go(spark):
    lines = [f"menu item {i}" for i in range(20)]
    words = "one\nA line of eight words is standing here.\n" + "\n".join("abcd")
    passages = ["\n".join(lines) + "\n", words + "\n", "Yes!\nNo.\nMaybe so.\n"]
    own = [f"Own beginning of text {i} which is in none of the other ones.\n" for i in range(9)]
    texts = [own[i] + p + own[i + 1] for i, p in enumerate(passages[:2])] + [own[4 + i] + p + own[6 + i] for i, p in enumerate(passages[:2])] + [passages[2]] * 2
    d = docs(spark, [*texts, own[8] + passages[2] + "Other lines follow it in this text only."])
    got = {x.row.doc_id: x for x in spans.drop_repeated_spans(d).collect()}
    assert [got[i].text for i in (0, 1, 4, 6)] == [texts[0], texts[1], texts[4], got[6].row.text]
    assert [got[i].text for i in (2, 3, 5)] == [own[4] + own[6], own[5] + own[7], ""]
    kept = {x.doc_id: x.text for x in spans.dedup_documents(d).collect()}
    assert kept[2] == own[4] + own[6] and 5 not in kept
    # spans of every place, by their rule
    r = random.Random(33)
    for _ in range(400):
        sizes = np.array([r.choice([0, 1, 1, 2, 3, 9, 15]) for _ in range(r.randrange(3, 14))])
        total, want = sizes.sum(), set()
        for i in range(len(sizes)):
            for j in range(i + 3, len(sizes) + 1):
                fits = sizes[i:j].sum() >= 10
                if fits and (j - i == 3 or sizes[i : j - 1].sum() < 10 or sizes[i + 1 : j].sum() < 10):
                    want.add((i, j - i))
        at, n = spans.span_places(sizes, 3, 10)
        got = set(zip(at.tolist(), n.tolist(), strict=True))
        assert got <= want if total >= 10 else got == ({(0, len(sizes))} if total else set())
        assert {k for i, m in got for k in range(i, i + m)} == (set(range(len(sizes))) if total else set())


def brute_spans(sizes):
    """(first, last + 1) of the runs to hash, run by run: three sentences, or on to ten words, forwards and backwards."""
    n = len(sizes)
    if n < spans.SPAN or sum(sizes) < spans.MIN_WORDS:
        return {(0, n)} if sum(sizes) else set()
    out = set()
    for i in range(n - spans.SPAN + 1):
        j, k = i + spans.SPAN, i
        while j <= n and sum(sizes[i:j]) < spans.MIN_WORDS:
            j += 1
        while k >= 0 and sum(sizes[k : i + spans.SPAN]) < spans.MIN_WORDS:
            k -= 1
        out |= ({(i, j)} if j <= n else set()) | ({(k, i + spans.SPAN)} if k >= 0 else set())
    return out


def test_spans_equal_brute_force(spark, small, odd):
    d = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = sorted({(x.doc_id is None, x.doc_id or 0, x.text) for x in d.collect() if x.text is not None})
    seen, gone = set(), defaultdict(set)
    for k in rows:
        found = spans.sentences(k[2])
        assert "".join(k[2][a:b] for a, b in found) == k[2]
        keys = [" ".join(k[2][a:b].lower().split()) for a, b in found]
        for i, j in sorted(brute_spans([len(x.split()) for x in keys])):
            key = (j - i, " | ".join(keys[i:j]))
            if key in seen:
                gone[k] |= set(range(i, j))
            seen.add(key)
    got = {(x.row.doc_id is None, x.row.doc_id or 0, x.row.text): x.n_removed for x in spans.drop_repeated_spans(d).collect() if x.row.text is not None}
    # rows of one id stand in the order of a hash of their texts, so only ids of one text are compared
    single = [k for k in rows if sum(o[:2] == k[:2] for o in rows) == 1]
    assert {k: got[k] for k in single} == {k: len(gone[k]) for k in single}
    again = spans.drop_repeated_spans(d.repartition(5)).collect()
    assert sorted(x.n_removed for x in again) == sorted(x.n_removed for x in spans.drop_repeated_spans(d).collect())
    assert spans.drop_repeated_spans(d.limit(0)).count() == 0


def test_passages_inside_sentences_go(spark):
    r = random.Random(51)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    some = lambda n: " ".join(word() for _ in range(n))
    texts, passages = [], [f"{some(24)}. {some(27)}" if i % 2 else some(51) for i in range(20)]
    for p in passages:  # begins and ends inside sentences, and holds no three whole ones
        texts += [f"{some(9)} {p} {some(9)}. {some(8)}." for _ in range(2)]
    alone = f"{some(30)} " * 2 + some(5)  # repeats itself only
    d = docs(spark, [*texts, alone, f"{some(30)}. {' '.join(passages[0].split()[:12])} {some(30)}.", *[f"{some(5)} {'the ' * 60}{some(5)}" for _ in range(2)]])
    got = {x.row.doc_id: x for x in spans.drop_repeated_spans(d, runs=True).collect()}
    assert all(got[i].text == texts[i] and not got[i].n_removed for i in range(0, 40, 2)) and got[40].text == alone and not any(got[i].n_removed for i in (41, 42, 43))
    for i in range(1, 40, 2):
        x = got[i]
        own = set(texts[i].split()) - set(passages[i // 2].split())
        assert x.n_removed >= 1 and own <= set(x.text.split()) and len(x.text.split()) <= len(texts[i].split()) - spans.RUN
        assert texts[i] == "".join(texts[i][a:b] for a, b in zip([0, *(y.start for y in x.removed)], [x.removed[0].start, *(y.end for y in x.removed)], strict=True)) + texts[i][x.removed[-1].end :]
    assert sum(len(got[i].text.split()) for i in range(1, 40, 2)) < 20 * (18 + 20)
    left = {x.doc_id: x.text for x in spans.dedup_documents(d).collect()}
    assert {i: x.text for i, x in got.items()} == left


# ---------------------------------------------------------------------------------------------- 4: quality


def test_quality_held_out(spark, odd):
    r = random.Random(5)
    good = [prose(r, r.randrange(5, 80)) for _ in range(240)]
    bad = [" | ".join(r.choice(["buy", "now", "###", "$$$"]) + str(r.randrange(9)) for _ in range(30)) for _ in range(80)] + [" ".join([w] * 40) for w in ("alpha", "beta", "gamma", "delta")] * 10
    d = docs(spark, good + bad, 100).unionByName(odd)
    labels = spark.createDataFrame([(100 + i, int(i < 240), 0) for i in range(360)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    s = quality.Settings(buckets=1 << 12, epochs=12)
    got = quality.quality_scores(d, labels, s).collect()
    assert len(got) == d.count()
    held = [x for x in got if x.held_out and x.doc_id and x.doc_id >= 100]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in got if x.doc_id is not None)
    assert len(held) > 40 and np.mean([x.predicted == int(x.doc_id < 340) for x in held]) > 0.95
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.7) for x in got)
    kept = quality.keep_good(d, labels, s)
    assert kept.columns == d.columns and kept.count() == sum(x.predicted for x in got)
    flat = quality.quality_scores(d, labels.limit(0), s).collect()
    assert {x.score for x in flat} == {0.5}
    assert quality.quality_scores(d.limit(0), labels, s).count() == 0


def plain_features(text, s):
    """The buckets of a text with their counts, one word, n-gram and bigram at a time."""
    m = (1 << 64) - 1
    mix1 = lambda h: int(mix(np.array([h & m], np.uint64))[0])
    odd = [mix1(i) | 1 for i in range(1, 257)]
    ws, out, own = text.split(), defaultdict(int), []
    for w in ws:
        codes = [ord(c) for c in f"<{w}>"]
        own.append(mix1(sum(c * odd[i % 256] for i, c in enumerate(codes))))
        out[own[-1] % s.buckets] += 1
        for k in s.ngrams:
            for i in range(len(codes) - k + 1 if len(codes) > k else 0):
                h = k
                for c in codes[i : i + k]:
                    h = h * odd[0] + c
                out[mix1(h) % s.buckets] += 1
    for a, b in zip(own, own[1:]):
        out[mix1((a ^ b) + 0x2545F4914F6CDD1D) % s.buckets] += 1
    return dict(out)


def test_quality_equals_brute_force():
    """Features, a training step and scores against versions that go feature by feature."""
    s = quality.Settings(buckets=512, dim=3, ngrams=(2, 3))
    texts = ["the cat sat on the mat", "no no no", "Ünïcode 🙂 words", "a", "x" * 300 + " y", ""]
    r = np.random.default_rng(0)
    table, out, bias = r.normal(size=(512, 3)).astype(np.float32), r.normal(size=(3, 2)).astype(np.float32), r.normal(size=2).astype(np.float32)
    plain = [plain_features(t, s) for t in texts]
    for t, want in zip(texts, plain):
        f, c = quality.text_features(t, s)
        assert dict(zip(f.tolist(), c.tolist())) == pytest.approx({k: v / sum(want.values()) for k, v in want.items()})
    w, b = table @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0])
    for most in (1 << 16, 8):
        one = quality.Scorer(w, b, s, most)
        for t, want in [*zip(texts, plain)] * 2:
            z = b + sum(v * float(w[k]) for k, v in want.items()) / max(1, sum(want.values()))
            assert one(t) == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-5)
    assert quality.Scorer(w, b, s)(None) == pytest.approx(1 / (1 + np.exp(-b)))
    batch, labels, rate = [0, 1, 2], np.array([1, 0, 1]), 0.3
    t2, o2, b2 = table.astype(float).copy(), out.astype(float).copy(), bias.astype(float).copy()
    dt, do, db = np.zeros_like(t2), np.zeros_like(o2), np.zeros_like(b2)
    for i in batch:
        n = sum(plain[i].values())
        h = sum(v / n * t2[k] for k, v in plain[i].items())
        z = h @ o2 + b2
        p = np.exp(z) / np.exp(z).sum()
        g = p - np.eye(2)[labels[i]]
        for k, v in plain[i].items():
            dt[k] += v / n * (o2 @ g)
        do += np.outer(h, g)
        db += g / len(batch)
    quality.sgd_step(table, out, bias, [quality.text_features(texts[i], s) for i in batch], labels, rate)
    assert np.allclose(table, t2 - rate * dt, atol=1e-5) and np.allclose(out, o2 - rate * do, atol=1e-5) and np.allclose(bias, b2 - rate * db, atol=1e-5)


def test_quality_keeps_large_ids_beside_nulls(spark):
    big = (1 << 53) + 1
    d = spark.createDataFrame([(big, "good words here", "r"), (None, "good words here", "r"), (big + 2, None, None)], "doc_id long, text string, row string")
    labels = spark.createDataFrame([(big, 1), (big + 2, 1)], "doc_id long, quality int")
    assert {x.doc_id for x in quality.quality_scores(d, labels).collect()} == {big, None, big + 2}
    kept = quality.keep_good(d, labels).collect()
    assert kept and {tuple(x) for x in kept} <= {tuple(x) for x in d.collect()}


def test_quality_on_the_given_tables(spark, small):
    at = small.replace("sf0.001", "sf0.01")
    d, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    y = {x.doc_id: x.quality for x in labels.collect()}
    got = [x for x in quality.quality_scores(d, labels).collect() if x.held_out and y.get(x.doc_id) is not None]
    assert len(got) > 50 and np.mean([x.predicted == y[x.doc_id] for x in got]) > 0.95


# ---------------------------------------------------------------------------------------------- 5: Jaccard join


def brute_components(rows, s):
    sets = defaultdict(list)
    for i, t in rows:
        sets[i].append(set(shingle_set(t, s.k).tolist()))
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    flat = [(i, x) for i, v in sets.items() for x in v if x]
    for a, x in flat:
        for b, y in flat:
            if a < b and 100 * len(x & y) >= s.percent * len(x | y):
                i, j = top(a), top(b)
                up[max(i, j)] = min(i, j)
    return {i: top(i) for i in sets}


@pytest.mark.parametrize("settings", [jaccard.Settings(), jaccard.Settings(region=40, pivots=3, depth=2), jaccard.Settings(region=10, pivots=3, depth=1, leaf=2)])
def test_components_equal_brute_force(spark, odd, settings):
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(900)]
    rows = []
    for n, copies in [(1, 3), (2, 2), (9, 4), (12, 6), (25, 8), (40, 6), (120, 8), (300, 90)] + [(r.randrange(3, 90), 2) for _ in range(20)]:
        base = [r.choice(vocabulary) for _ in range(n)]
        for _ in range(copies):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5, 9]) if n > 8 else 0):
                w[r.randrange(n)] = r.choice(vocabulary)
            rows.append((r.randrange(1 << 30), " ".join(w + [r.choice(vocabulary)] * r.choice([0, 0, 0, 1]))))
    d = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    every = [(x.doc_id, x.text) for x in d.collect()]
    want = brute_components([x for x in every if x[0] is not None], settings)
    got = jaccard.jaccard_components(d, settings).collect()
    assert len(got) == len(every)
    assert {x.doc_id: x.component_id for x in got if x.doc_id is not None} == want
    assert sorted(x.n_shingles for x in got) == sorted(len(shingle_set(t, 3)) for _, t in every)
    assert all(x.component_id is None for x in got if x.doc_id is None)


def test_regions_form_cells_and_windows(spark, small):
    """The links of the given table come from Voronoi cells: its regions are split, and windows copy documents."""
    s = jaccard.Settings(k=5, percent=80)
    d = spark.read.parquet(small.replace("sf0.001", "sf0.01") + "/documents.parquet").select("doc_id", "text")
    regions = defaultdict(list)
    text = {x.doc_id: x.text for x in d.collect()}
    for x in jaccard.coarse_regions(d, s).collect():
        regions[x.component].append(x.id)
    cells = copies = 0
    up = jaccard.Unions(max(text) + 1)
    for ids in regions.values():
        r = jaccard.Region(sorted(ids), [shingle_set(text[i], s.k) for i in sorted(ids)], [-1] * len(ids), s)
        r.split(np.arange(len(ids)))
        cells, copies = cells + r.cells, copies + r.copies
        for a, b in r.links:
            up.join(a, b)
    assert cells > 10, sorted(map(len, regions.values()))[-5:]
    want = brute_components([(i, t) for i, t in text.items() if i in {j for v in regions.values() for j in v}], s)
    assert {i: up.top(i) for i in want} == want


def test_windows_copy_what_cells_share():
    """Chains of sets: neighbours are linked, ends aren't; cells cut the chain, and windows keep every link."""
    s = jaccard.Settings(pivots=3)
    chain = [np.arange(i * 5, i * 5 + 100, dtype=np.uint64) for i in range(60)]
    r = jaccard.Region(list(range(60)), chain, [-1] * 60, s)
    r.split(np.arange(60))
    assert {r.u.top(i) for i in range(60)} == {0} and r.cells > 3 and r.copies > 0


def test_one_of_each_group(spark, odd):
    kept = jaccard.one_of_each(odd.unionByName(docs(spark, ["a b c d e f", "A B c d e f", "other words are here"], 50)))
    ids = [x.doc_id for x in kept.collect()]
    assert 50 in ids and 51 not in ids and 52 in ids and ids.count(None) == 2
    assert jaccard.jaccard_components(odd.limit(0)).count() == 0


@pytest.mark.parametrize("s", [jaccard.Settings(), jaccard.Settings(k=5, percent=80)])
def test_linked_sets_share_a_slice(s):
    """Whatever shingles count as frequent."""
    r = np.random.default_rng(3)
    passage = r.integers(0, 1 << 62, 60).astype(np.uint64)
    few = []
    for i in range(2500):
        n = int(r.integers(1, 160))
        x = np.concatenate([r.integers(0, 1 << 62, n).astype(np.uint64), passage[: int(r.integers(0, 60))]])
        edits = max(1, len(x) * (100 - s.percent) // 100 + 1)
        y = np.concatenate([x[int(r.integers(0, edits)) :], r.integers(0, 1 << 62, int(r.integers(0, edits))).astype(np.uint64)])
        a, b = np.unique(x), np.unique(y)
        if len(b) and not np.array_equal(a, b) and jaccard.linked(jaccard.overlap(a, b), len(a), len(b), s.percent):
            for frequent in (None, np.sort(passage), np.unique(np.concatenate([passage, a[:: 1 + i % 5]])), a):
                p, q = jaccard.signatures(a, s, frequent), jaccard.signatures(b, s, frequent)
                few.append(len(p))
                assert np.intersect1d(p, q).size
    assert len(few) > 1000


def test_slices_left_out_lose_no_link():
    """Whatever the order in which slices are left out, if it is one for all."""
    s, r, tried = jaccard.Settings(k=5, percent=80), np.random.default_rng(4), 0

    def kept(slices, late):
        for g in np.unique(slices[1]).tolist():
            v, n = slices[0][slices[1] == g], int(slices[2][slices[1] == g][0])
            v = v[np.lexsort((v, np.isin(v, late)))]
            yield from v[: len(v) - n].tolist()

    for _ in range(800):
        x = r.integers(0, 1 << 62, int(r.integers(1, 160))).astype(np.uint64)
        edits = len(x) // 5 + 1
        y = np.concatenate([x[int(r.integers(0, edits)) :], r.integers(0, 1 << 62, int(r.integers(0, edits))).astype(np.uint64)])
        a, b = np.unique(x), np.unique(y)
        if len(b) and not np.array_equal(a, b) and jaccard.linked(jaccard.overlap(a, b), len(a), len(b), s.percent):
            p, q = jaccard.counted_slices(a, s), jaccard.counted_slices(b, s)
            tried += 1
            for late in (np.empty(0, np.uint64), np.intersect1d(p[0], q[0])):
                assert set(kept(p, late)) & set(kept(q, late))
    assert tried > 300


def test_a_phrase_in_common_makes_no_region(spark):
    """Of texts that have a phrase in common with two others few are compared; near copies all."""
    r = random.Random(9)
    phrases = [[f"p{i}x{j}" for j in range(14)] for i in range(300)]
    texts = [[*(f"w{r.randrange(1 << 40)}" for _ in range(12)), *phrases[i // 3], *(f"w{r.randrange(1 << 40)}" for _ in range(12))] for i in range(900)]
    texts += [[*texts[i][:-1], "other"] for i in range(0, 900, 90)]
    got = {x.id: x.component for x in jaccard.coarse_regions(docs(spark, [" ".join(t) for t in texts]), jaccard.Settings(k=5, percent=80)).collect()}
    assert all(got[i] == got[900 + i // 90] for i in range(0, 900, 90))
    assert len(got) <= 100


def test_block_links_find_every_component(spark):
    s = jaccard.Settings(region=20)
    r = random.Random(1)
    base = list(range(1000, 1200))
    rows = []
    for i in range(90):
        x = [v if r.random() > 0.03 else r.randrange(1 << 40) for v in base]
        rows.append((1, i, bytearray(np.unique(np.array(x, np.uint64)).tobytes()), -1, 5))
    got = jaccard.block_links(spark.createDataFrame(rows, "region long, id long, set binary, ball long, parts int"), s)
    pairs = [(x.a, x.b) for x in got.collect()]
    sets = [set(np.frombuffer(bytes(x[2]), np.uint64).tolist()) for x in rows]
    u, v = jaccard.Unions(90), jaccard.Unions(90)
    for i in range(90):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                u.join(i, j)
    for a, b in pairs:
        assert 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
        v.join(a, b)
    assert [u.top(i) for i in range(90)] == [v.top(i) for i in range(90)]


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (7, None), (1200, 61)]
    got = {x.id: x.component for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in range(1000, 1300)} == {61} and 7 in got
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------------------------------------- 6: token counts


def test_token_counts_equal_the_library(spark, small, odd):
    r = random.Random(6)
    long = [" ".join(r.choice(["word", "Wörter", "12", "it's", "--", "\n\n"]) for _ in range(4000)), "y" * 3000 + " z", " " * 2500 + "q", "汉" * 3000]
    d = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(docs(spark, long, 500).select("doc_id", "text"))
    library = tokens.Encoder(VOCABULARY).library
    want = sorted(repr((x.doc_id, len((x.text or "").encode()), n := len(library.encode(x.text or "", add_special_tokens=False).ids), n > 512)) for x in d.collect())
    for chunk, overlap in ((20_000, 200), (300, 10)):
        got = tokens.token_counts(d, VOCABULARY, chunk, overlap).collect()
        assert sorted(repr(tuple(x)) for x in got) == want
    assert tokens.token_counts(d.limit(0), VOCABULARY).count() == 0


def test_plain_texts_are_encoded_by_ranks():
    """Without a table of their words; the ids are the library's, also where long texts are cut or can't be."""
    e, r = tokens.Encoder(VOCABULARY), random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyzé'  1-\n"
    long = ["".join(r.choice(letters) for _ in range(n)) for n in (0, 1, 300, 19_999, 20_001, 70_000)]
    for text in [*long, "it's we'll  x\n\n y", "word " * 9000, "a" * 19_000, " " * 19_000 + "x"]:
        assert e(text) == e.whole(text)
        assert not e.known
    for text in ("a" * 30_000, "1 2 " * 9000, " " * 50_000 + "q", "x<|endoftext|>y", "汉 b"):
        assert e(text) == e.whole(text)


@pytest.mark.parametrize("alphabet", ["абвгд еёж, ", "αβγ δέ. ", "汉字，文 本。", "🙂👍🏽 ok ", "नमस्ते दुनिया ", "ab <|endoftext|> c"])
def test_huge_texts_of_all_scripts_are_spliced(alphabet):
    """At the first overlap, without the whole text."""
    e = tokens.Encoder(VOCABULARY)
    r = random.Random(len(alphabet))
    parts = ["<|endoftext|>", "ab ", "c "] if "<" in alphabet else list(alphabet)
    text = "".join(r.choice(parts) for _ in range(60_000))
    got = []
    for a, b in tokens.chunks_of(len(text), tokens.CHUNK, tokens.OVERLAP):
        at, upto = tokens.boundaries(e, text[a:b])
        assert at[-1] == b - a
        near = (at <= tokens.OVERLAP + 1) | (at >= b - a - tokens.OVERLAP)
        got.append((a, b, at[near] + a, upto[near], int(upto[-1])))
    assert len(got) > 2 and tokens.splice(got, e.guard) == len(e.whole(text)) // 4


def test_splicing_is_exact_or_refused():
    e = tokens.Encoder(VOCABULARY)
    r = random.Random(7)
    refused = 0
    for _ in range(400):
        some = [*"ab Zé1² \t\n\r\x0b\x85\xa0'_-.s tre ll", *(["<|endoftext|>", "<|endof", "汉", "ж"] if r.random() < 0.3 else [])]
        text = "".join(r.choice(some) for _ in range(r.randrange(40, 400)))
        for step, back in ((50, 30), (37, 20)):
            parts = []
            for a, b in tokens.chunks_of(len(text), step, back):
                at, upto = tokens.boundaries(e, text[a:b])
                near = (at <= back + 1) | (at >= b - a - back)
                parts.append((a, b, at[near] + a, upto[near], int(upto[-1]) if len(upto) else 0))
            n = tokens.splice(parts, e.guard)
            refused += n is None
            assert n is None or n == len(e.whole(text)) // 4
    assert refused < 200


# ---------------------------------------------------------------------------------------------- 7: fingerprints


def test_fingerprints_of_neighbours(spark, small, odd):
    d = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").where("doc_id > 20")
    rows = sorted(((x.doc_id, x.text or "") for x in d.collect()), reverse=True)
    got = {x.doc_id: x for x in fingerprints.fingerprint_neighbours(d).collect()}
    assert len(got) == len(rows)
    errors = []
    for i, (k, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        e = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        x = got[k]
        assert x.n_chars == len(t) and x.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert x.fingerprint == fingerprints.fingerprint(t) and x.edited_fingerprint == fingerprints.fingerprint(e)
        a, b = (set(shingle_set(v, 5).tolist()) for v in (t, e))
        errors.append(x.near_edited - (len(a & b) / len(a | b) if a | b else 1.0))
    assert np.sqrt(np.mean(np.square(errors))) < 0.06
    every = fingerprints.fingerprint_neighbours(odd).collect()
    assert len(every) == odd.count() and all(0 <= x.near_next <= 1 for x in every)
    one = fingerprints.fingerprint_neighbours(odd.where("doc_id = 5")).first()
    assert one.near_next == 1.0
    assert fingerprints.fingerprint_neighbours(odd.limit(0)).count() == 0


def test_neighbours_across_ranges_and_shared_ids(spark, monkeypatch):
    """Many ranges, more than one block of them, ids that a third of the rows share: as in one sorted list."""
    monkeypatch.setattr(fingerprints, "WIDE", 4)
    r = random.Random(4)
    ids = [r.choice([None, 7, 7, i, i * 1000]) for i in range(400)] + [-(1 << 63) + 1, (1 << 63) - 1]
    d = spark.createDataFrame([(i, f"text {k} of words {r.random()}", "x") for k, i in enumerate(ids)], "doc_id long, text string, key string")
    hashed = d.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    rows = sorted(hashed, key=lambda x: (-(x.doc_id if x.doc_id is not None else -(1 << 63)), x.h, x.text))
    want = sorted(hashlib.sha256(fingerprints.edited(x.text, y.text).encode()).hexdigest() for x, y in zip(rows, rows[1:] + rows[:1]))
    for parts in (1, 2, 40):
        got = fingerprints.fingerprint_neighbours(d, parts).collect()
        assert sorted(x.edited_sha256 for x in got) == want
    ranges = fingerprints.even_ranges(d.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key"), F.xxhash64("text").alias("h")), 40)
    assert len(ranges.splits) == 2
    dealt = ranges.deal(d.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key"), F.xxhash64("text").alias("h"))).groupBy("range").count()
    assert dealt.agg(F.max("count")).first()[0] < 40 and dealt.agg(F.max("range")).first()[0] < ranges.count()


def test_likeness_is_unbiased():
    r = random.Random(9)
    miss = []
    for _ in range(60):
        words = [str(r.randrange(10**6)) for _ in range(400)]
        other = words[: r.randrange(400)] + [str(r.randrange(10**6)) for _ in range(100)]
        a, b = (set(shingle_set(" ".join(w), 5).tolist()) for w in (words, other))
        miss.append(fingerprints.likeness(fingerprints.fingerprint(" ".join(words)), fingerprints.fingerprint(" ".join(other))) - len(a & b) / len(a | b))
    assert abs(np.mean(miss)) < 0.02 and np.sqrt(np.mean(np.square(miss))) < 0.06


# ---------------------------------------------------------------------------------------------- 8: packing


def test_packing_is_whole_and_tight(spark, odd):
    r = random.Random(10)
    d = docs(spark, [prose(r, r.randrange(1, 900)) for _ in range(120)], 100).unionByName(odd)
    got = packing.pack_documents(d, VOCABULARY).collect()
    e = tokens.Encoder(VOCABULARY)
    want = []
    for x in d.collect():
        ids = e.whole(x.text or "") + (2).to_bytes(4, "little")
        n, at = len(ids) // 4, 0
        for k, m in enumerate([n % 1024 or 1024] + [1024] * ((n - 1) // 1024)):
            want.append(repr((x.doc_id, k, at, m, zlib.crc32(ids[4 * at : 4 * (at + m)]))))
            at += m
        assert at == n
    assert sorted(repr((x.doc_id, x.piece, x.start, x.length, x.ids_crc32)) for x in got) == sorted(want)
    bins = defaultdict(list)
    for x in got:
        bins[x.sequence_id].append((x.offset, x.length))
    for v in bins.values():
        end = 0
        for o, n in sorted(v):
            assert o == end
            end += n
        assert end <= 1024
    assert len(bins) <= 1.06 * sum(x.length for x in got) / 1024 + 1
    assert packing.pack_documents(d.limit(0), VOCABULARY).count() == 0


def test_fullest_is_optimal():
    r = random.Random(11)
    for _ in range(150):
        counts = {r.randrange(1, 40): r.randrange(1, 4) for _ in range(r.randrange(1, 7))}
        room = r.randrange(1, 90)
        sums = {0}
        for k, n in counts.items():
            sums |= {s + k * j for s in sums for j in range(1, n + 1) if s + k * j <= room}
        got = packing.fullest(counts, room)
        assert sum(k * n for k, n in got) == max(sums) and all(n <= counts[k] for k, n in got)


# ---------------------------------------------------------------------------------------------- 9: top-k


@pytest.mark.parametrize("block", [8192, 60])
def test_top_k_equals_brute_force(spark, monkeypatch, block):
    """One block, and many cells and blocks; repeated ids, rows that take no part, extra columns, components of any size."""
    monkeypatch.setattr(topk, "DATA_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    r = np.random.default_rng(12)
    rows = [(i, [float(v) for v in r.normal(size=8) * r.choice([0.1, 1, 3])]) for i in range(400)]
    rows += [(2000 + i, [0.5] * 8) for i in range(120)] + [(100, [0.25] * 8), (100, [0.25] * 8), (200, [0.5] * 8)]
    rows += [(3000, None), (3100, [float("nan")] * 8), (3200, [None] * 8), (3300, []), (None, [1.0] * 8), (4000, [1.0, 2.0]), (4001, [3.0, 4.0])]
    rows += [(5000, [1e9, 1.0, 3.0]), (5001, [1e9 + 1, 1.0, 1.0]), (5002, [1e9, 1.5, 3.0]), (5100, [1e15, 0.0, 0.0])]
    df = spark.createDataFrame([(*x, 1, 2) for x in rows], "vec_id long, embedding array<double>, row int, cell int")
    got = sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in topk.exact_top_k(df).collect())
    fine = [(i, [int(np.floor(c * 1024)) for c in v]) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    want = []
    for n, (q, v) in enumerate(fine):
        if q % 100 == 0:
            score = lambda x: max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(v, x))))  # noqa: E731, B023
            best = sorted((-score(x), i) for m, (i, x) in enumerate(fine) if m != n and len(x) == len(v))[:10]
            want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert got == sorted(want)
    assert topk.exact_top_k(df.limit(0)).count() == 0


def test_cover_trees_cover_and_separate():
    r = np.random.default_rng(14)
    x = np.repeat(r.normal(size=(12, 5)) * 1000, 50, 0) + r.normal(size=(600, 5)) * np.repeat([1, 30], 300)[:, None]
    seen, inner = [], 0

    def check(node):
        nonlocal inner
        d = topk.distances(x[node.points], node.centre)
        assert d.max() <= 2.0**node.level and node.radius == pytest.approx(d.max())
        if not node.children:
            seen.extend(node.points.tolist())
            return
        inner += 1
        for i, c in enumerate(node.children):
            assert c.level < node.level and topk.distances(x[c.points], c.centre).max() <= 2.0 ** (node.level - 1)
            for other in node.children[:i]:
                assert np.linalg.norm(c.centre - other.centre) > 2.0 ** (node.level - 1)
            check(c)

    check(topk.cover_tree(x, np.arange(600), 10))
    assert sorted(seen) == list(range(600)) and inner > 3


def test_search_prunes_and_stays_exact(monkeypatch):
    r = np.random.default_rng(13)
    centres = r.normal(size=(40, 16)) * 2000
    x = np.floor(np.repeat(centres, 60, 0) + r.normal(size=(2400, 16)) * 20)
    q = np.floor(np.repeat(centres[:20], 3, 0) + r.normal(size=(60, 16)))
    monkeypatch.setattr(topk, "QUERY_LEAF", 4)
    ids, s = np.arange(2400), q @ x.T
    for floor in (-np.inf, np.sort(s, 1)[:, -10].min()):
        got = topk.Search(x, ids, ids, q, np.arange(5000, 5060), np.full(60, floor), 10)
        for i in range(60):
            assert got.found[i].tolist() == np.lexsort((ids, -s[i]))[:10].tolist()
        assert got.compared < 0.7 * s.size


# ---------------------------------------------------------------------------------------------- 10: URLs


def test_urls(spark):
    r = random.Random(14)
    rows = [(i, f"http://h{r.randrange(5)}.example.{t}/{p}/{n}{r.randrange(99)}?q") for i, (t, p, n) in enumerate((r.choice(["com", "net", "org"]), r.choice(["en", "de", "fr", "es"]), r.choice(["7", "8", "1"])) for _ in range(400))]
    rows += [(900, None), (901, "no scheme"), (902, "HTTP://WWW.Example.COM/en/7x#f"), (903, "x://y://z/a"), (904, "ftp://ÉXAMPLE.net/de/8"), (None, "http://a.com/en/1"), (905, "http://com/en/"), (906, "http://notexample.com/en/7"), (907, "http://com"), (907, "http://com")]
    df = spark.createDataFrame([(*x, "h", "p") for x in rows], "page_id long, url string, host string, path string")
    got = urls.judge_urls(df).collect()
    assert len(got) == len(rows)
    by = {x.page_id: x for x in got}
    assert (by[900].host, by[900].path, by[901].host) == ("", "", "")
    assert (by[902].host, by[902].path, by[902].rule, by[902].verdict) == ("www.example.com", "/en/7x", "example.com/en/7", "allow")
    assert by[903].host == "y:" and by[904].host == "Éxample.net" and by[904].rule == "net/de/"
    assert (by[905].rule, by[905].verdict) == ("com/en/", "block") and by[906].rule == "com/en/" and by[907].rule is None
    assert all(x.verdict in ("allow", "block") for x in got)
    assert urls.judge_urls(df.limit(0)).count() == 0
    assert {x.verdict for x in urls.judge_urls(df.where("page_id in (900, 901, 907)")).collect()} == {"allow"}


def test_url_rules_say_what_the_contract_says(spark):
    said = {("com", "/en/"): "block", ("example.com", "/en/7"): "allow", ("net", "/de/"): "allow", ("example.net", "/de/8"): "block", ("org", "/es/"): "block"}
    assert {(h, p): v for h, p, v in urls.RULES} == said
    df = spark.createDataFrame([(i, f"http://{h}{p}x") for i, (h, p) in enumerate(said)], "page_id long, url string")
    got = {(x.host, x.path): (x.rule, x.verdict) for x in urls.judge_urls(df).collect()}
    assert got == {(h, p + "x"): (h + p, v) for (h, p), v in said.items()}


def test_log_ratios_equal_plain_python(spark):
    good, bad, other = ["abca", "abcb"], ["xyzx", "xaz"], ["abz"]
    counts = defaultdict(lambda: [0, 0])
    for words, k in ((good, 0), (bad, 1), (other, None)):
        for w in words:
            t = urls.START * 3 + w + urls.END
            for i in range(len(t) - 3):
                counts[t[i : i + 3], t[i + 3]][k or 0] += 0 if k is None else 1

    def chance(ctx, c, k):
        part = defaultdict(int)
        for (x, d), n in counts.items():
            if x[3 - len(ctx) :] == ctx:
                part[d] += n[k]
        if not ctx:
            return (part[c] + 1) / (sum(part.values()) + len(part))
        n, t = sum(part.values()), sum(v > 0 for v in part.values())
        low = chance(ctx[1:], c, k)
        return (part[c] + t * low) / (n + t) if n else low

    df = spark.createDataFrame([(x, c, g, b) for (x, c), (g, b) in counts.items()], "ctx string, c string, good long, bad long")
    got = {(x.ctx, x.c): x.ratio for x in urls.log_ratios(df).collect()}
    assert len(got) == len(counts)
    for x, c in counts:
        assert got[x, c] == pytest.approx(1e6 * np.log(chance(x, c, 0) / chance(x, c, 1)), abs=2)


# ---------------------------------------------------------------------------------------------- the pipeline


def test_pipeline_runs_and_keeps_columns(spark, small):
    pipeline = pytest.importorskip("corpus_pipeline")
    d = spark.read.parquet(f"{small}/documents.parquet")
    columns, before = d.columns, d.count()
    for name, stage in pipeline.STAGES[:-1]:
        d = stage(spark, d, small)
        assert d.columns == columns, name
        n = d.count()
        assert name == "source_mix" or n <= before
        before = n
    packed = pipeline.STAGES[-1][1](spark, d, small)
    assert {x.doc_id for x in packed.select("doc_id").distinct().collect()} == {x.doc_id for x in d.select("doc_id").distinct().collect()}


def test_pipeline_stages_at_the_edges(spark, small, odd):
    """Nulls in any column, empty and long texts, repeated rows and ids, clashing names; and no rows."""
    pipeline = pytest.importorskip("corpus_pipeline")
    given = [tuple(x) for x in odd.collect()]
    for name, stage in pipeline.STAGES:
        out = stage(spark, odd, small)
        rows = [tuple(x) for x in out.collect()]
        if name == "best_fit_packing":
            assert len(rows) >= len(given)
        else:
            assert out.columns == odd.columns, name
            assert rows and (set(rows) <= set(given) or name == "substring_dedup"), name
        assert stage(spark, odd.limit(0), small).count() == 0, name
    assert len(pipeline.substring_dedup(spark, odd, small).where("text is null").collect()) == sum(x[1] is None for x in given)


def test_near_copies_of_five_words(spark, small):
    pipeline = pytest.importorskip("corpus_pipeline")
    r = random.Random(31)
    w = [f"w{i}" for i in range(200)]
    edited = list(w)
    for i in (40, 90, 140, 190):
        edited[i] = "other"
    texts = [" ".join(x) for x in (w, w + [f"v{i}" for i in range(30)], w[:172], edited, w[:120] + [f"u{i}" for i in range(80)])]
    d = docs(spark, [*texts, prose(r, 200)])
    sets = {(k, i): set(shingle_set(texts[i], k).tolist()) for k in (3, 5) for i in range(5)}
    for i in (1, 2, 3):
        like = {k: len(sets[k, 0] & sets[k, i]) / len(sets[k, 0] | sets[k, i]) for k in (3, 5)}
        assert like[3] < 0.9 and like[5] >= 0.8
    assert {x.doc_id for x in pipeline.ngram_jaccard_join(spark, d, small).collect()} == {0, 4, 5}


def test_five_word_links_equal_brute_force(spark):
    """The windows and slices follow the settings: components of near copies are those of all pairs."""
    r = random.Random(32)
    s = jaccard.Settings(k=5, percent=80, region=40, pivots=3, depth=2)
    rows = []
    for n, copies in [(6, 4), (12, 6), (40, 8), (120, 60)] + [(r.randrange(5, 90), 3) for _ in range(20)]:
        base = [f"w{r.randrange(900)}" for _ in range(n)]
        for _ in range(copies):
            w = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 4])):
                w[r.randrange(n)] = f"w{r.randrange(900)}"
            rows.append((len(rows), " ".join(w + [f"w{r.randrange(900)}" for _ in range(r.choice([0, 0, n // 7]))])))
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), s).collect()
    assert {x.doc_id: x.component_id for x in got} == brute_components(rows, s)


def test_queries_with_sql(spark, small):
    import duckdb

    from gablewise.llm import queries

    for name, sql in queries.oracle_sql().items():
        c = duckdb.connect()
        for t in ("documents", "embeddings", "pages", "conversations"):
            c.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
        r = c.execute(sql)
        names = [x[0] for x in r.description]
        df = queries.queries()[name](spark, small).select(*names)
        assert sorted(repr(tuple(x)) for x in df.collect()) == sorted(repr(x) for x in r.fetchall())
