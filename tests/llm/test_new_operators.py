"""Operators 11 to 13 against plain restatements of their rules, on awkward rows too."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

pt = pytest.importorskip("public_tokenizers")
pytest.importorskip("tokenizers"), pytest.importorskip("sentencepiece")

from cellweave.llm import op11_near, op12_repair, op13_align  # noqa: E402


def ordered(x):
    return sorted((tuple(r) for r in x), key=lambda r: tuple((v is None, v) for v in r))


def rows(df):
    return ordered(df.collect())


# --- 11


def plain_near(vectors, least):
    """Every pair of a label by cosine in doubles."""
    n = len(vectors)
    good, root, count, by = [None] * n, list(range(n)), [0] * n, collections.defaultdict(list)
    for k, (i, v, label) in enumerate(vectors):
        if i is not None and label is not None and v and None not in v and np.isfinite(v).all() and any(v):
            good[k] = np.array(v, float)
            by[label, len(v)].append(k)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for g in by.values():
        for a in range(len(g)):
            for b in range(a):
                x, y = (good[g[k]] / np.abs(good[g[k]]).max() for k in (a, b))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    count[g[a]] += 1
                    count[g[b]] += 1
                    root[find(g[a])] = find(g[b])
    low = {}
    for k, (i, _, _) in enumerate(vectors):
        if i is not None:
            low[find(k)] = min(i, low.get(find(k), i))
    return ordered((i, count[k], low[find(k)] if i is not None else None, i is not None and low[find(k)] == i) for k, (i, _, _) in enumerate(vectors))


VECTORS = "vec_id long, embedding array<double>, label int, n_links string, lo int, v string"


def near_vectors(seed, dims=20):
    r = np.random.default_rng(seed)
    out, base = [], r.normal(size=(6, dims))
    for k in range(160):
        v = base[k % 6] + r.normal(size=dims) * [0.05, 0.2, 0.5, 2.0][k % 4]
        out.append((k, v.tolist(), k % 3))
    out += [(200 + k, base[0].tolist(), 0) for k in range(30)]  # copies
    out += [(300, (base[0] * 7).tolist(), 0), (301, (base[0] * -1).tolist(), 0), (302, (base[0] * 1e200).tolist(), 0), (303, (base[0] * 1e-200).tolist(), 0)]
    nan, inf = float("nan"), float("inf")
    out += [(400, None, 0), (401, [], 0), (402, [0.0] * dims, 0), (403, [nan] + [1.0] * (dims - 1), 0), (404, [inf] * dims, 0), (405, [None] + [1.0] * (dims - 1), 0), (406, base[0].tolist(), None), (None, base[0].tolist(), 0)]
    out += [(407, [1.0], 0), (408, [2.0], 0), (409, [-1.0], 0), (200, base[0].tolist(), 0), (5, base[3].tolist(), 1)]
    return out


@pytest.mark.parametrize("sizes", [(4096, 512), (16, 5)])
def test_near_equals_all_pairs(spark, monkeypatch, sizes):
    monkeypatch.setattr(op11_near, "BLOCK", sizes[0])
    monkeypatch.setattr(op11_near, "TILE", sizes[1])
    vectors = near_vectors(3)
    df = spark.createDataFrame([(*v, None, 1, "x") for v in vectors], VECTORS).repartition(3)
    assert rows(op11_near.score(df)) == plain_near(vectors, 0.93)
    assert any(r[1] for r in plain_near(vectors, 0.93))


def test_near_of_nothing(spark):
    assert op11_near.score(spark.createDataFrame([], VECTORS)).count() == 0
    one = spark.createDataFrame([(1, None, 0, None, 1, "x")], VECTORS)
    assert rows(op11_near.score(one)) == [(1, 0, 1, True)]


def test_tiles_leave_no_link_out():
    r = np.random.default_rng(1)
    x = r.normal(size=(40, 30))
    x[20:] = x[:20] + r.normal(size=(20, 30)) * np.linspace(0.01, 0.6, 20)[:, None]
    y = x / np.sqrt((x * x).sum(1, keepdims=True))
    q = np.linalg.svd(y)[2].T
    i, j = op11_near.tile_links(x, x, y @ q, y @ q, 0.9)
    assert set(zip(i.tolist(), j.tolist())) == {(a, b) for a in range(40) for b in range(40) if y[a] @ y[b] >= 0.9}


def test_pieces_keep_components():
    i, j = np.array([0, 1, 5, 7, 9]), np.array([1, 2, 6, 5, 9])
    a, b = op11_near.forest(i, j)
    assert dict(zip(a.tolist(), b.tolist())) == {0: 0, 1: 0, 2: 0, 5: 5, 6: 5, 7: 5, 9: 9}


# --- 12


def damaged(conversation):
    out = []
    for i, t, role, text in conversation:
        k = zlib.crc32(f"{' ' if i is None else i}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k:
            row = (t, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)
            out += [row] * (2 if k == 3 else 1)
    return out


def plain_repair(table, order):
    """Least (cost, audit) by a search over strings, for each conversation."""
    by = collections.defaultdict(list)
    for r in table:
        by[r[0]].append(r)
    out = []
    for i, conversation in by.items():
        rs = sorted(damaged(conversation), key=order)
        faults, seen = [], set()
        for t, role, text in rs:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in rs if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rs, rs[1:]))
        nxt = {0: "user", 1: "user", 2: "assistant", 3: "user"}
        code = {"user": 2, "assistant": 3}
        best = {0: (0, "", [])}
        for k in range(len(rs) + 1):
            for _ in range(3):  # inserts; each pass may lengthen
                for s, (c, a, text) in list(best.items()):
                    role = nxt[s]
                    new = (c + 2, a + "I", text + [role + ":"])
                    if len(a) - len(a.rstrip("I")) < 3 and (code[role] not in best or new[:2] < best[code[role]][:2]):
                        best[code[role]] = new
            if k == len(rs):
                break
            (t, role, text), f, new = rs[k], faults[k], {}

            def offer(s, v):
                if s not in new or v[:2] < new[s][:2]:
                    new[s] = v

            for s, (c, a, got) in best.items():
                offer(s, (c + 3, a + "D", got))
                if f not in ("b", "d"):
                    keep = {"s": 1 if s == 0 else 0, "u": 2 if s != 2 else 0, "a": 3 if s == 2 else 0}.get(role[:1], 0)
                    if keep:
                        offer(keep, (c + (f == "t"), a + "K", got + [f"{role}:{text}"]))
                    offer(code[nxt[s]], (c + 2 + (f == "t"), a + "R", got + [f"{nxt[s]}:{text}"]))
            best = new
        c, a, text = min((best[s] for s in (0, 3) if s in best), key=lambda v: v[:2])
        out.append((i, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, c, a, hashlib.sha256("\n".join(text).encode()).hexdigest()))
    return ordered(out)


TURNS = "conv_id long, turn long, role string, text string, unit int, n string"


def by_turn(r):
    return (r[0] is not None, r[0] or 0)


def conversations(seed, n, length):
    r = random.Random(seed)
    out = []
    for i in range(n):
        for t in range(r.randrange(1, length)):
            if r.random() < 0.9:
                out.append((i, t * r.choice([1, 1, 1, 3]) if seed % 2 else t, r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), r.choice(["a.", "b!", "c", " ", None, "q? ", "é。", f"{t}."])))
    return out


@pytest.mark.parametrize("seed,n,length", [(2, 150, 9), (4, 6, 400)])
def test_repair_equals_string_search(spark, seed, n, length):
    table = conversations(seed, n, length)
    df = spark.createDataFrame([(*r, 1, "x") for r in table], TURNS).repartition(3)
    assert rows(op12_repair.repair(df)) == plain_repair(table, by_turn)


def test_repair_by_all_edits():
    """The least weight of a unit is the least of all edit strings."""
    import itertools

    def run(edits, codes):
        at, k, cost = 0, 0, 0
        for e in edits:
            if e == "I":
                at, cost = op12_repair.ON[at], cost + 2
                continue
            if k == len(codes):
                return None
            code, k = codes[k], k + 1
            if e == "D":
                cost += 3
                continue
            if code == "D":
                return None
            cost += code[0] == "T"
            if e == "R":
                at, cost = op12_repair.ON[at], cost + 2
            else:
                to = {"s": 1, "u": 2, "a": 3}.get(code[1:])
                if to is None or (to == 1 and at) or (to == 2 and at == 2) or (to == 3 and at != 2):
                    return None
                at = to
        return (cost, edits) if k == len(codes) and at in (0, 3) else None

    for codes in itertools.product(["D", "-s", "-u", "Ta", "-x"], repeat=3):
        want = min(x for n in range(3, 7) for s in itertools.product("DIKR", repeat=n) if (x := run("".join(s), codes)))
        paths, got = op12_repair.unit_paths(codes), []
        for q, extra in op12_repair.END.items():
            if (0, q) in paths:
                w = paths[0, q]
                got.append(((w >> 27) + 2 * extra, "".join(op12_repair.letters(w, 3)) + "I" * extra))
        assert min(got) == want, codes


def test_repair_of_awkward_rows(spark):
    nulls = [(None, None, None, None), (None, 1, "user", "x."), (1, None, "user", "a."), (1, 0, "assistant", "b."), (2, None, None, None)]
    nulls += [(3, 7, "user", "same.")] * 130 + [(3, 8, "assistant", "long " * 20_000 + ".")]
    df = spark.createDataFrame([(*r, 1, "x") for r in nulls], TURNS)
    assert rows(op12_repair.repair(df)) == plain_repair(nulls, by_turn)
    assert op12_repair.repair(spark.createDataFrame([], TURNS)).count() == 0
    gone = next(i for i in range(10_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(gone, 0, "user", "a.", 1, "x")], TURNS)
    assert rows(op12_repair.repair(one)) == [(gone, 0, 0, 0, 0, 0, 0, "", op12_repair.EMPTY)]


# --- 13

JSON, PIECES = pt.path("byte_bpe_50k.json"), pt.path("piece_bpe_32k.model")


def plain_aligned(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    tok, sp = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    tok.encode_special_tokens = True
    back = op13_align.unmap()
    per, held = [], collections.Counter()
    for i, t in texts:
        a = tok.encode(" " + (t or ""), add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        ba = [bytes(back[c] for c in tok.id_to_token(k)) for k in a]
        bb = [bytes([int(sp.id_to_piece(k)[3:5], 16)]) if sp.is_byte(k) else sp.id_to_piece(k).replace("▁", " ").encode() for k in b]
        raw = (" " + t).encode() if t else b""
        groups = []
        if t and b"".join(ba) == raw == b"".join(bb):
            ea, eb = {int(e): k + 1 for k, e in enumerate(np.cumsum([len(x) for x in ba]))}, {int(e): k + 1 for k, e in enumerate(np.cumsum([len(x) for x in bb]))}
            la = lb = 0
            for e in sorted(set(ea) & set(eb)):
                groups.append((a[la : ea[e]], b[lb : eb[e]]))
                la, lb = ea[e], eb[e]
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        held.update(set(links))
        per.append((i, groups, links))
    top = collections.defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for i, groups, links in per:
        s = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(s.encode()).hexdigest() if groups else ""))
    return ordered(out)


TEXTS = [
    None, "", " ", "a", "  a  b", "x\x1cy \x85z q", "é日本 😀 don't  stop\n\n\nnow <|endoftext|> x <s> </s> <unk> <0x41>", "▁x", "a\x00b", "a\x01 b", " lead", "trail  ", "\tq\r\n", "ﬁ Å é", "The cat sat. The cat sat.", "The cat sat. The cat sat.",
    "x" * 5000, "for " * 3000, "日本語" * 200, "a　b  c\xa0d", "''s 's 't don'T I'LL we'll ''ll",
]


@pytest.mark.parametrize("sent,size", [(1 << 19, 2 << 20), (7, 50), (0, 2 << 20)])
def test_aligned_equals_plain(spark, monkeypatch, sent, size):
    monkeypatch.setattr(op13_align, "SENT", sent)
    monkeypatch.setattr(op13_align, "SLICE", size)
    texts = [(k % 19 or None, t) for k, t in enumerate(TEXTS)]
    df = spark.createDataFrame([(i, t, 1, "x", None) for i, t in texts], "doc_id long, text string, pair int, n_a string, rid string").repartition(3, "text")
    assert rows(op13_align.score(df, JSON, pt.PATTERN, PIECES)) == plain_aligned(texts)


def test_aligned_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert op13_align.score(df, JSON, pt.PATTERN, PIECES).count() == 0
