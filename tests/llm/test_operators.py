"""The ten operators on awkward rows, against plain restatements of their rules."""

import base64
import collections
import hashlib
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

pt = pytest.importorskip("public_tokenizers")
tiktoken, tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("tokenizers")

from cellweave.llm import bpe, op1_bpe, op2_jaccard, op3_licenses, op4_merkle, op5_ppm, op6_counts, op7_shards, op8_repeats, op9_quality, op10_tiling  # noqa: E402

WORDS = [f"w{k * 7919 % 997}" for k in range(400)]
LONG = " ".join(WORDS)
TEXTS = [
    (1, LONG), (2, LONG), (2, LONG), (3, LONG.replace("w0 ", "zz ", 1) + " end"), (4, None), (5, ""), (6, "one two"), (7, "One\ttwo "), (None, "lone text here"),
    (8, "CC BY-NC 4.0 all rights reserved"), (9, "é日本 😀 don't  stop\n\n\nnow <|endoftext|> x"), (10, "For " * 500), (11, "x" + "For " * 130), (12, " ".join(WORDS[:80]) + " own tail of text"),
    (13, "Licensed under the Apache License, Version 2.0. " + "general public license " * 2), (14, "word " * 30_000),
]
SCHEMA = "bucket int, doc_id long, text string, `set` string, n int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(0, i, t, None, 1) for i, t in TEXTS], SCHEMA).repartition(3, "text")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


def ordered(x):
    return sorted(x, key=lambda r: tuple((v is None, v) for v in r))


MULTI, JSON = pt.path("byte_bpe_multi_50k.tiktoken"), pt.path("byte_bpe_50k.json")


def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI, "rb"))}
    return tiktoken.Encoding("own", pat_str=pt.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_op1(docs, none):
    t = tik()
    want = []
    for i, x in TEXTS:
        ids = t.encode_ordinary(x or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((x or "").encode()).hexdigest()))
    assert rows(op1_bpe.round_trip(docs, MULTI, pt.PATTERN)) == ordered(want)
    assert rows(op1_bpe.decode(op1_bpe.encode(docs, MULTI, pt.PATTERN), MULTI, pt.PATTERN, 1)) == ordered((i, x or "") for i, x in TEXTS)
    assert op1_bpe.round_trip(none, MULTI, pt.PATTERN).count() == 0


def test_stream_decoder_on_broken_bytes():
    for data in (b"\xf0\x9f", b"a\xc3(", b"\xe2\x82\xac\xff", "😀".encode()[:3] + b"x"):
        d = bpe.StreamDecoder([bytes([k]) for k in range(256)])
        assert "".join(d.feed([b]) for b in data) + d.close() == data.decode("utf-8", "replace")


def plain_components(texts):
    low = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})
    sets = []
    for _, x in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (x or "").translate(low))
        sets.append({tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))
    find = lambda k: k if root[k] == k else find(root[k])
    for a in range(len(sets)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(texts):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, len(s), least.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(texts, sets))]


def test_op2(docs, none):
    assert rows(op2_jaccard.components(docs)) == ordered(plain_components(TEXTS))
    assert op2_jaccard.components(none).count() == 0
    kept = collections.Counter(r["doc_id"] for r in op2_jaccard.keep_one(docs).collect())
    assert kept[1] == 1 and kept[2] == kept[3] == 0 and kept[4] == kept[5] == 1


def test_op2_near_threshold(spark):
    import random

    r = random.Random(5)
    base = [str(r.randrange(10**6)) for _ in range(60)]
    texts = []
    for i in range(120):
        w = list(base)
        for _ in range(r.randrange(4)):
            w[r.randrange(60)] = str(r.randrange(10**6))
        texts.append((i, " ".join(w[: 60 - r.randrange(12)])))
    d = spark.createDataFrame(texts, "doc_id long, text string")
    assert rows(op2_jaccard.components(d)) == ordered(plain_components(texts))


def test_trie_prunes_nothing_that_links():
    t = op2_jaccard.Trie()
    for name, n, tokens in [(7, 4, [1, 2, 3, 4]), (8, 5, [1, 2, 3, 4]), (9, 4, [1, 2]), (10, 4, [5, 6])]:
        t.up[name] = name
        t.insert(name, n, tokens)
    t.up[1] = 1
    assert sorted(t.links(1, 4, [1, 2, 3, 4])) == [7, 8]
    assert t.links(1, 4, [1, 2, 3, 4]) == []  # all in its component now


def test_op2_in_many_blocks(spark, monkeypatch):
    """Families whose members mostly miss the centre, common shingles that skip the buckets, blocks of a few sets."""
    import random

    r = random.Random(11)
    texts = []
    for f in range(3):
        base = [f"b{f}x{r.randrange(10**6)}" for _ in range(40)]
        for _ in range(60):
            w = list(base)
            for _ in range(r.randrange(3)):
                w[r.randrange(40)] = str(r.randrange(10**6))
            texts.append((len(texts), " ".join(w[r.randrange(3) : 40 - r.randrange(6)] + ["the", "common", "closing", "line", "of", "all"])))
    d = spark.createDataFrame(texts, "doc_id long, text string")
    want = ordered(plain_components(texts))
    for name, v in (("BLOCK", 200), ("HOT", 20), ("OFTEN", 2), ("BUCKET", 500), ("FLUSH", 700)):
        monkeypatch.setattr(op2_jaccard, name, v)
    assert rows(op2_jaccard.components(d)) == want


def test_op2_shared_passage(spark, monkeypatch):
    """Texts with one passage in common and more of their own go to no other block; real links between blocks are found."""
    import random

    r = random.Random(7)
    passage = " ".join(f"p{k}" for k in range(61))
    own = lambda n: " ".join(str(r.randrange(10**7)) for _ in range(n))
    apart = [(k, f"{own(9)} {passage} {own(9)}") for k in range(300)]
    mixed = [(300 + k, f"{own(r.randrange(12))} {passage} {own(r.randrange(40))}") for k in range(150)]
    mixed += [(450 + k, mixed[k * 5][1] + " one more word") for k in range(20)]
    walked = []
    plain = op2_jaccard.open_walks
    monkeypatch.setattr(op2_jaccard, "open_walks", lambda *a: walked.append(plain(*a)) or walked[-1])
    monkeypatch.setattr(op2_jaccard, "BLOCK", 2_000)
    discarded = []
    monkeypatch.setattr(op2_jaccard, "discard", lambda *a: discarded.extend(a))
    d = spark.createDataFrame(apart, "doc_id long, text string")
    assert rows(op2_jaccard.components(d)) == [(i, 75, i) for i, _ in apart]
    assert walked.pop().count() == 0
    d = spark.createDataFrame(apart + mixed, "doc_id long, text string")
    assert rows(op2_jaccard.components(d)) == ordered(plain_components(apart + mixed))
    assert walked.pop().count() < 3 * len(apart + mixed)


def test_keep_one_rows(spark):
    w = " ".join(WORDS[:60])
    texts = [(1, w), (1, w), (1, w + " x"), (2, w + " y"), (4, ""), (4, ""), (None, "lone one"), (None, "lone one"), (5, None), (5, "five"), (5, "another text of five or more words"), (None, w)]
    d = spark.createDataFrame([(t, i, 9, 8) for i, t in texts], "text string, doc_id long, `__id` int, `first` int")
    kept = op2_jaccard.keep_one(d)
    assert kept.columns == d.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert [g for g in got if g[1] and g[1].startswith(w)] in ([(1, w)], [(1, w + " x")])
    assert [g for g in got if not (g[1] and g[1].startswith(w))] == sorted([(4, ""), (4, ""), (None, "lone one"), (5, None), (5, "five"), (5, "another text of five or more words")], key=str)


def plain_licences(x):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x or ""))
    at = [(k, label) for p, label in op3_licenses.BASE.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    return len(w), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def plain_notices(x):
    """labels and score by trying every notice at every place."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x or ""))
    base = {label for p, label in op3_licenses.BASE.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()}
    own, best = set(), 0.0
    for (label, notice, phrase), posts in zip(op3_licenses.TEMPLATES, op3_licenses.postings()):
        words, p = notice.split(), phrase.split()
        at = next(k for k in range(len(words)) if words[k : k + len(p)] == p)
        for first in range(len(w)):
            if w[first] == p[0] and w[first : first + len(p)] == p:
                weight = 0.0
                for word, k, x in posts:
                    here = first - at + k
                    weight += x if 0 <= here < len(w) and w[here] == word else 0.0
                share = weight / sum(x for _, _, x in posts)
                if share >= op3_licenses.SHARE:
                    own.add(label)
                    best = max(best, share)
    return ",".join(sorted(base | own)), 1.0 if base else min(1.0, best)


def test_op3_placings(spark):
    """Whole notices, notices cut short, changed or out of place, against every notice at every place."""
    import random

    r = random.Random(3)
    texts = [
        "released under the mit terms and so on. see also mit license elsewhere", "Released under the MIT License.", "the mit license", "license " * 500 + "released under the mit license",
        "apache license version 2 applies", "mit license released under the mit license under the", None, "", "no notice here at all", "in no event will the authors be held liable for any damages",
    ]
    for _, notice, _ in op3_licenses.TEMPLATES:
        words = notice.split()
        for _ in range(3):
            w = list(words)
            for _ in range(r.randrange(4)):
                w[r.randrange(len(w))] = r.choice(["Under", "the", "license", "xyz", "mit"])
            if r.random() < 0.3:
                w.insert(r.randrange(len(w)), "extra")
            lead = [r.choice(words) for _ in range(r.randrange(6))]
            texts.append(", ".join(lead + w[r.choice([0, 0, 1, 3]) :]))
        texts.append(notice.title())
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {x["doc_id"]: (x["labels"], x["score"]) for x in op3_licenses.scan(d).collect()}
    for k, x in enumerate(texts):
        labels, score = plain_notices(x)
        assert got[k][0] == labels and abs(got[k][1] - score) < 1e-12, x
    assert got[0] == ("", 0.0) and got[1] == ("mit", 1.0) and got[3][0] == "mit"


def test_op3(docs, none):
    got = op3_licenses.scan(docs)
    assert rows(got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")) == ordered((i, *plain_licences(x)) for i, x in TEXTS)
    labels = {r["doc_id"]: r["labels"] for r in got.collect()}
    assert labels[8] == "cc-by,cc-by-nc,reserved" and labels[13] == "apache-2.0,gpl" and labels[4] == ""
    assert op3_licenses.scan(none).count() == 0


def test_op4(docs, none):
    seq = sorted(((i, x or "") for i, x in TEXTS), key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = collections.defaultdict(list)
    for r in op4_merkle.neighbours_compared(docs).collect():
        got[r["doc_id"]].append(r)
    for k, (i, x) in enumerate(seq):
        nxt = seq[(k + 1) % len(seq)][1]
        edited = x[: len(x) - len(x) // 3] + nxt[: len(x) // 3]
        assert hashlib.sha256(edited.encode()).hexdigest() in [r["edited_sha256"] for r in got[i]]
        assert all(r["fingerprint"] == op4_merkle.fingerprint(x) and r["n_chars"] == len(x) for r in got[i])
    assert sum(map(len, got.values())) == len(TEXTS)
    assert op4_merkle.neighbours_compared(none).count() == 0


def plain_likeness(a, b):
    """Twice the common leaves over all leaves, by the leaves' own texts."""
    x, y = (collections.Counter(re.findall(r"[^\n.!?]{1,160}[\n.!?]*|[\n.!?]+", t)) for t in (a, b))
    return 1.0 if a == b else 2 * (x & y).total() / (x.total() + y.total())


@pytest.mark.parametrize("kind", ["long", "string", "date", "decimal(20,0)"])
def test_op4_ids_and_likeness(spark, kind):
    """Ids of any type, the lowest number, many rows without id or with one id; both likeness columns by the leaves themselves."""
    import random

    r = random.Random(13)
    texts = []
    for k in range(160):
        i = None if k % 3 == 0 else -(2**63) if kind == "long" and k == 1 else 7 if k % 5 == 0 else r.randrange(10**6)
        texts.append((i, ". ".join(f"sentence {r.randrange(6)}" for _ in range(r.randrange(30))) if k % 40 else None))
    texts += texts[:9]
    d = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    as_kind = {"string": "concat('id ', doc_id)", "date": "date_add(date'1970-01-01', cast(doc_id as int))"}.get(kind, f"cast(doc_id as {kind})")
    d = d.select(F.expr(as_kind).alias("doc_id"), "text", F.lit(1).alias("bucket"), F.lit("x").alias("mix"))
    seq = d.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).orderBy(F.desc("doc_id"), F.desc(F.xxhash64("text")), F.desc("text")).collect()
    want = []
    for k, (i, x) in enumerate(seq):
        nxt = seq[(k + 1) % len(seq)][1]
        e = x[: len(x) - len(x) // 3] + nxt[: len(x) // 3]
        want.append((i, len(x), hashlib.sha256(e.encode()).hexdigest(), round(plain_likeness(x, e), 9), round(plain_likeness(x, nxt), 9)))
    got = op4_merkle.neighbours_compared(d).select("doc_id", "n_chars", "edited_sha256", F.round("near_edited", 9), F.round("near_next", 9))
    assert rows(got) == ordered(want)


def test_merkle_locates_edits():
    a = ". ".join(f"sentence number {k}" for k in range(200))
    b = a.replace("number 77", "number 7x7")
    x, y = op4_merkle.fingerprint(a), op4_merkle.fingerprint(b)
    assert x != y and 0.97 < op4_merkle.likeness(x, y) < 1 and len(op4_merkle.edits(x, y)) == 1
    assert op4_merkle.likeness(x, x) == 1 and op4_merkle.edits(x, x) == []


def test_op5(docs, none):
    low = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in TEXTS]
    toks = [[*re.findall(r"[^\x20\x09-\x0D]+", (x or "").translate(low)), None] for _, x in TEXTS]
    c = collections.Counter(w for t, h in zip(toks, held) if not h for w in t)
    n, v = c.total(), len(c)
    want = ordered((i, h, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)) for (i, _), h, t in zip(TEXTS, held, toks))
    got = rows(op5_ppm.score(docs))
    assert [r[:5] for r in got] == [w[:5] for w in want]
    assert all(abs(r[5] - w[5]) < 1e-6 * max(1, abs(w[5])) and r[6] < 0 for r, w in zip(got, want))
    assert op5_ppm.score(none).count() == 0


def test_op5_is_a_distribution():
    import numpy as np

    data = np.frombuffer(b"abracadabra abracadabra", np.uint8)
    g, _ = op5_ppm.grams(np.array([0, len(data)]), data)
    u, n = np.unique(g, return_counts=True)
    trie = op5_ppm.Trie(u, n.astype(float), 4)
    for context in (b"abra", b"brac", b"zzzz", b"zzra", b"\xfe\xfe\xfe\xfe"):
        code = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], np.uint64)
        assert abs((10 ** trie.log10(code)).sum() - 1) < 1e-9


def test_op6(docs, none):
    t = tokenizers.Tokenizer.from_file(JSON)
    n = [len(e.ids) for e in t.encode_batch([x or "" for _, x in TEXTS], add_special_tokens=False)]
    assert rows(op6_counts.counts(docs, JSON, pt.PATTERN)) == ordered((i, len((x or "").encode()), k, k > 512) for (i, x), k in zip(TEXTS, n))
    assert op6_counts.counts(none, JSON, pt.PATTERN).count() == 0
    for _, x in TEXTS[:13]:
        x = (x or "")[:250]
        assert op6_counts.prefix_table(x, JSON, pt.PATTERN) == [len(e.ids) for e in t.encode_batch([x[:k] for k in range(1, len(x) + 1)], add_special_tokens=False)]
    cut = op6_counts.truncate(docs, JSON, pt.PATTERN, 20).collect()
    assert all(len(t.encode(r["text"], add_special_tokens=False).ids) == r["n_tokens"] <= 20 for r in cut)


def test_op7(docs, none):
    got = op7_shards.shard(docs, 5).collect()
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted((len((x or "").encode()) + 16, zlib.crc32((x or "").encode())) for _, x in TEXTS)
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert op7_shards.shard(none).count() == 0


def test_op7_splits_a_hot_group(spark):
    d = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text " * 20).otherwise(F.concat(F.lit("t"), F.col("id"), F.repeat(F.lit(" x"), (F.col("id") % 90).cast("int")))).alias("text"))
    sizes = [r["s"] for r in op7_shards.shard(d).groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 40 and max(sizes) < 1.02 * min(sizes)


def plain_repeats(texts, span=400):
    data = [(x or "").encode() for _, x in texts]
    seen = collections.Counter(d[k : k + span] for d in data for k in range(len(d) - span + 1))
    out = []
    for (i, _), d in zip(texts, data):
        gone = bytearray(len(d))
        for k in range(len(d) - span + 1):
            if seen[d[k : k + span]] > 1:
                gone[k : k + span] = b"\1" * span
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [50_000, 1])
def test_op8(docs, none, hot, monkeypatch):
    few = [r for r in TEXTS if r[0] != 14] + [(20, "A" * 399), (21, "A" * 400), (22, "B" * 401), (23, "pre " + LONG[300:900] + " post"), (24, "C" * 500 + LONG[:350])]
    d = docs.sparkSession.createDataFrame([(0, i, t, None, 1) for i, t in few], SCHEMA)
    monkeypatch.setattr(op8_repeats.spans, "__defaults__", ("doc_id", "text", hot))
    assert rows(op8_repeats.removed(d).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == ordered(plain_repeats(few))
    assert op8_repeats.removed(none).count() == 0
    assert op8_repeats.strip(d).columns == d.columns


def plain_word_repeats(texts, words):
    """Texts without the words that lie in runs of so many words that stand at two places."""
    runs = [[(m.start(), m.end(), m.group()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", x.encode())] for x in texts]
    seen = collections.Counter(tuple(w[2] for w in r[k : k + words]) for r in runs for k in range(len(r) - words + 1))
    out = []
    for x, r in zip(texts, runs):
        gone = set()
        for k in range(len(r) - words + 1):
            if seen[tuple(w[2] for w in r[k : k + words])] > 1:
                gone |= set(range(r[k][0], r[k + words - 1][1]))
        out.append(bytes(c for k, c in enumerate(x.encode()) if k not in gone).decode())
    return out


@pytest.mark.parametrize("hot", [op8_repeats.HOT, 1])
def test_repeats_stage_judges_by_words(spark, hot, monkeypatch):
    import random

    import corpus_pipeline

    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(2, 9)))
    own = lambda n: " ".join(word() for _ in range(n))
    p51, p50, long, four = own(51), own(50), own(90), own(20)
    texts = [own(30) + " " + p51 + " " + own(9), p51.replace(" ", "\n") + "  " + own(40), own(20) + " " + p50 + " x" + own(3), own(7) + " " + p50 + " y" + own(12)]
    texts += [long, own(3) + " " + long[long.index(" ") + 1 :] + " tail", " ".join([four] * 6), "z " * 200, "", own(3)]
    assert len(p51.encode()) < 400
    monkeypatch.setattr(op8_repeats.spans, "__defaults__", ("doc_id", "text", hot))
    d = spark.createDataFrame([(k, t, len(t)) for k, t in enumerate(texts)] + [(None, None, 0)], "doc_id long, text string, n_chars long")
    got = {x["doc_id"]: x["text"] for x in corpus_pipeline.repeats(spark, d, "").collect()}
    assert got == dict(enumerate(plain_word_repeats(texts, 51))) | {None: None}
    assert p51 not in got[0] and p50 in got[2]


def test_repeats_stage_in_text_without_spaces(spark):
    import random

    import corpus_pipeline

    r = random.Random(4)
    run = lambda n: "".join(chr(r.randint(0x4E00, 0x9FA5)) for _ in range(n))
    same = run(150)
    d = spark.createDataFrame([(1, run(80) + same + run(70), 300), (2, run(31) + same + run(40), 221)], "doc_id long, text string, n_chars long")
    got = {x["doc_id"]: x["text"] for x in corpus_pipeline.repeats(spark, d, "").collect()}
    assert len(got[1]) == 150 and len(got[2]) == 71


def test_op9(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    got = op9_quality.score(docs, labels).collect()
    assert len(got) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in got)
    assert op9_quality.score(none, labels).count() == 0
    assert op9_quality.keep(docs, labels).columns == docs.columns


def test_op9_learns(spark):
    from cellweave.session import table

    sf = "/root/testdata/sf0.1"
    got = op9_quality.score(table(spark, sf, "documents"), table(spark, sf, "labels")).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id").filter("held_out")
    assert got.filter("predicted = quality").count() > 0.97 * got.count()


def test_op10(spark, docs, none):
    bench = spark.createDataFrame([(1, " ".join(WORDS[20:60])), (2, " ".join(WORDS[50:60] + WORDS[20:50])), (3, "never seen words in any of these texts"), (4, None), (5, ""), (6, "one two")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["covered"], r["n_tiles"]) for r in op10_tiling.leaks(docs, bench).collect()}
    assert got[1, 1] == (40, 1) and got[12, 2] == (40, 2) and got[6, 6] == got[7, 6] == (2, 1) and not any(k[1] in (3, 4, 5) for k in got)
    assert op10_tiling.leaks(none, bench).count() == 0 and op10_tiling.leaks(docs, bench.limit(0)).count() == 0
    kept = {r["doc_id"] for r in op10_tiling.clean(docs, bench).collect()}
    assert kept == {4, 5, 8, 9, 10, 11, 13, 14, None}


def test_op10_in_blocks(docs, spark, monkeypatch):
    monkeypatch.setattr(op10_tiling, "BLOCK_WORDS", 10)
    bench = spark.createDataFrame([(1, " ".join(WORDS[20:60])), (6, "one two")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in op10_tiling.leaks(docs, bench).collect()} >= {(1, 1), (6, 6), (7, 6)}


def test_pipeline_stages(spark):
    import corpus_pipeline as p
    from cellweave.session import cut, table

    d = table(spark, "/root/testdata/sf0.001", "documents")
    names = d.columns
    for _, stage in p.STAGES[:-1]:
        d = cut(stage(spark, d, "/root/testdata/sf0.001"))
        assert d.columns == names and d.count() > 100
    ids = p.STAGES[-1][1](spark, d, "/root/testdata/sf0.001").join(d.select("doc_id", "text"), "doc_id").collect()
    t = tik()
    assert all(list(r["ids"]) == t.encode_ordinary(r["text"]) for r in ids)


def test_op8_passages_and_clashing_names(spark):
    import random

    r = random.Random(8)
    own = lambda n: " ".join("".join(r.choice("abcde") for _ in range(r.randint(2, 7))) for _ in range(n))
    p51, p50 = own(51), own(50)
    texts = [own(30) + " " + p51 + " " + own(9), p51.replace(" ", "\n") + "  " + own(40), own(20) + " " + p50 + " x", p50 + " y"]
    assert len(p51) < 400
    d = spark.createDataFrame([(k, t, 1, 2, 3, 4) for k, t in enumerate(texts)], "doc_id long, text string, _0 int, _id int, _spans int, _KEY int")
    got = {x["doc_id"]: (x["n_removed"], x["passages"], x["passage_words"]) for x in op8_repeats.removed(d).collect()}
    assert got == {0: (0, 1, 51), 1: (0, 1, 51), 2: (0, 0, 0), 3: (0, 0, 0)}
    out = op8_repeats.strip(d, words=51)
    assert out.columns == d.columns and {x["doc_id"]: x["text"] for x in out.collect()} == dict(enumerate(plain_word_repeats(texts, 51)))


def plain_tiles(text, item, least):
    used_t, used_i, out = set(), set(), []
    while True:
        best = None
        for t in range(len(text)):
            for i in range(len(item)):
                k = 0
                while t + k < len(text) and i + k < len(item) and text[t + k] == item[i + k] and t + k not in used_t and i + k not in used_i:
                    k += 1
                if k >= least and (best is None or k > best[2]):
                    best = t, i, k
        if not best:
            return out
        t, i, k = best
        out.append(best)
        used_t |= set(range(t, t + k))
        used_i |= set(range(i, i + k))


def test_tiles_are_those_of_plain_greedy_tiling():
    import random

    import numpy as np

    r = random.Random(3)
    for _ in range(200):
        a = r.choice([2, 3, 6])
        text, item = (np.array([r.randrange(a) for _ in range(r.randrange(1, n))], np.uint64) for n in (50, 30))
        least = min(r.choice([2, 3, 5]), len(item))
        grams = {tuple(item[k : k + least].tolist()) for k in range(len(item) - least + 1)}
        seeds = np.array([k for k in range(len(text) - least + 1) if tuple(text[k : k + least].tolist()) in grams], np.int64)
        assert sorted(op10_tiling.tiles(text, item, seeds, least)) == sorted(plain_tiles(text.tolist(), item.tolist(), least))


def test_op10_on_one_word_again_and_again(spark):
    docs = spark.createDataFrame([("x", "word " * 50_000), ("y", "other")], "doc_id string, text string")
    bench = spark.createDataFrame([("1", "word " * 5_000), (None, "word other word")], "item_id string, text string")
    assert [(r["doc_id"], r["item_id"], r["covered"], r["n_tiles"]) for r in op10_tiling.leaks(docs, bench).collect()] == [("x", "1", 5_000, 1)]


def test_op6_on_runs(spark):
    t = tokenizers.Tokenizer.from_file(JSON)
    texts = ["'" * 200_000, " " * 200_000, "a" * 200_000, "<|endoftext|>" * 2_000, "''''s 'll''ve '"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert rows(op6_counts.counts(d, JSON, pt.PATTERN).select("doc_id", "n_tokens")) == [(k, len(t.encode(x, add_special_tokens=False).ids)) for k, x in enumerate(texts)]
    x = "don't ''ll 'LL x're <|endoftext|> a  <|endoftext|>'ll  \n x'v"
    assert op6_counts.prefix_table(x, JSON, pt.PATTERN) == [len(e.ids) for e in t.encode_batch([x[:k] for k in range(1, len(x) + 1)], add_special_tokens=False)]


def test_op7_keeps_groups_whole(spark):
    """Equal texts in one shard, unless they are more than a shard's share; sizes near equal."""
    d = spark.range(6_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.when(F.col("id") % 2 == 0, F.col("id") % 600).otherwise(F.col("id")).cast("string"), F.repeat(F.lit(" x"), (F.col("id") % 97 % 40).cast("int"))).alias("text"))
    d = d.unionAll(spark.range(6_000, 6_050).select("id", F.lit("tied")))
    got = op7_shards.shard(d).join(d, "doc_id")
    assert got.groupBy("text").agg(F.count_distinct("shard").alias("n")).filter("n > 1").isEmpty()
    sizes = [r["s"] for r in got.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 40 and max(sizes) < 1.01 * min(sizes)


def test_op7_places_as_plain_packing():
    import numpy as np

    r = np.random.default_rng(2)
    v = r.integers(1, 1000, (300, 3)).astype(float)
    got = op7_shards.place(v, 7)
    share, rest, want = v / v.sum(0) * 7, [[1.0] * 3 for _ in range(7)], {}
    for k in sorted(range(300), key=lambda k: (-share[k][0], -max(share[k]), k)):
        room = [s for s in range(7) if rest[s][0] - share[k][0] >= -1e-12]
        dot = lambda s: sum(a * b for a, b in zip(rest[s], share[k]))
        s = max(room, key=lambda s: (dot(s), -s)) if room else max(range(7), key=lambda s: (rest[s][0] - share[k][0], -s))
        want[k] = s
        rest[s] = [a - b for a, b in zip(rest[s], share[k])]
    assert got.tolist() == [want[k] for k in range(300)]


def plain_ppm(train, texts, order=4):
    """log10 probabilities by counting every context of every text."""
    low = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})
    code = lambda x: [0xFE] * order + list((x or "").translate(low).encode()) + [0xFF]
    seen = collections.defaultdict(collections.Counter)
    for x in train:
        s = code(x)
        for p in range(order, len(s)):
            for k in range(order + 1):
                seen[tuple(s[p - k : p])][s[p]] += 1
    out = []
    for x in texts:
        s, total = code(x), 0.0
        for p in range(order, len(s)):
            gone = set()
            for k in range(order, -1, -1):
                here = {y: c for y, c in seen[tuple(s[p - k : p])].items() if y not in gone}
                whole = sum(here.values()) + len(here)
                if s[p] in here:
                    total += math.log10(here[s[p]] / whole)
                    break
                if here:
                    total += math.log10(len(here) / whole)
                gone |= set(here)
            else:
                total -= math.log10(256 - len(gone))
        out.append(total)
    return out


@pytest.mark.parametrize("common", [1 << 18, 4])
def test_op5_score_is_that_of_a_plain_model(spark, common, monkeypatch):
    import random

    r = random.Random(1)
    texts = ["".join(r.choice("abBé  ") for _ in range(r.randrange(60))) for _ in range(60)] + ["", None, "zzzz", "~" * 9]
    held = [zlib.crc32(f"k{k}".encode()) % 7 == 2 for k in range(len(texts))]
    want = plain_ppm([x for x, h in zip(texts, held) if not h], texts)
    monkeypatch.setattr(op5_ppm, "COMMON", common)
    got = {x["doc_id"]: x["score"] for x in op5_ppm.score(spark.createDataFrame([(f"k{k}", x) for k, x in enumerate(texts)], "doc_id string, text string")).collect()}
    assert all(abs(got[f"k{k}"] - w) < 1e-9 * max(1, abs(w)) for k, w in enumerate(want))
