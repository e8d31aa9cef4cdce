"""Lexical search, learned-partition search and conversation repair: odd tables, and brute force on small ones."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from ledgerlake.llm import learned_ann as ann
from ledgerlake.llm import lexical_search as lex
from ledgerlake.llm import turn_repair as fix

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


# --- lexical search ------------------------------------------------------------------------------------------------------


def ranked(docs, items, top=10):
    per = [(i, Counter(TERM.findall(low(t)))) for i, t in docs]
    per = [(i, c) for i, c in per if c]
    n_docs, n_words = len(per), sum(sum(c.values()) for _, c in per)
    df = Counter(t for _, c in per for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall(low(t)))
    out = []
    for item, ts in asked.items():
        rows = []
        for i, c in per:
            m = 10 + (90 * sum(c.values()) * n_docs) // n_words
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            if s > 0:
                rows.append((-s, i is not None, i or 0, i))
        rows.sort()
        out += [(item, k, r[3], -r[0]) for k, r in enumerate(rows[:top], 1)]
    return out


@pytest.fixture(scope="module")
def texts():
    r = random.Random(11)
    vocabulary = ["the", "of", "AND", "in"] * 8 + ["".join(r.choice("abcdé9") for _ in range(r.randint(1, 4))) for _ in range(200)]
    docs = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 60)))) for i in range(900)]
    docs += [(i + 2000, docs[i][1]) for i in range(40)]  # ties
    docs += [(5, "the cab"), (None, docs[7][1]), (None, "cab cab"), (3000, None), (3001, ""), (3002, " -_ \n"), (3003, "x" * 300_000 + " cab"), (3004, "the cab of " * 40_000)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 12)))) for i in range(25)]
    items += [(3, "cab É"), (None, "cab"), (80, None), (81, "nowhere-to-be-found"), (82, "The THE the")]
    return docs, items


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, 0, "s", 1) for i, t in docs], "doc_id long, text string, score long, term string, item_id long").repartition(6)
    return d, spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, doc_id long")


def test_lexical_search_equals_brute_force(spark, texts, monkeypatch):
    for name, value in (("BLOCK", 8), ("WINDOW", 32), ("SHARD_DOCS", 150)):  # many blocks, windows and shards on little text
        monkeypatch.setattr(lex, name, value)
    d, i = frames(spark, *texts)
    got = [tuple(r) for r in lex.lexical_search(d, i).collect()]
    assert sorted(got, key=repr) == sorted(ranked(*texts), key=repr)
    monkeypatch.setattr(lex, "ITEM_BYTES", 200)  # items in several blocks
    assert sorted((tuple(r) for r in lex.lexical_search(d, i).collect()), key=repr) == sorted(got, key=repr)


def test_lexical_blocks_are_rejected_before_decompression(texts, monkeypatch):
    monkeypatch.setattr(lex, "BLOCK", 8)
    monkeypatch.setattr(lex, "WINDOW", 32)
    docs = [(k, c, sum(c.values())) for k, t in texts[0] if k is not None and (c := Counter(lex.terms((t or "").encode())))]
    n, words = len(docs), sum(x[2] for x in docs)
    batch = lex._lists(0, docs, n, words)
    lists = {}
    for r in batch.to_pylist():
        if r["term"] is not None:
            lists[r["term"]] = lex._List(r["df"], *(np.array(r[c], np.int64) for c in ("first", "last", "top", "width")), r["data"])
    rare = min((t for t in lists if lists[t].df > 30), key=lambda t: lists[t].df)
    found, scores = lex.best([(lex.weight(x.df, n), x) for x in (lists[rare], lists[b"the"])], n)
    assert len(found) == 10 and (np.diff(scores) <= 0).all()
    assert len(lists[b"the"].open) < len(lists[b"the"].last)


def test_lexical_search_of_nothing(spark):
    d, i = frames(spark, [], [(1, "a")])
    assert lex.lexical_search(d, i).collect() == []
    d, i = frames(spark, [(1, "a b"), (2, None)], [])
    assert lex.lexical_search(d, i).collect() == []
    d, i = frames(spark, [(1, None), (2, " ")], [(1, "a")])
    assert lex.lexical_search(d, i).collect() == []


def test_lexical_search_equals_sql(spark, texts):
    docs = [(i, t[:20_000] if t else t) for i, t in texts[0]]
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    con.execute("create table benchmark(item_id bigint, text varchar)")
    con.executemany("insert into benchmark values (?, ?)", texts[1])
    assert sorted(con.execute(lex.OP11_SQL).fetchall(), key=repr) == sorted(ranked(docs, texts[1]), key=repr)


# --- nearest neighbours ---------------------------------------------------------------------------------------------------


def exact(rows, every=20, top=20):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    d = Counter(len(v) for _, v in good).most_common(1)[0][0]
    good = [(i, v) for i, v in good if len(v) == d]
    asked = {}
    for i, v in good:
        if i % every == 0:
            asked[i] = min([asked[i], tuple(v)] if i in asked else [tuple(v)])
    out = {}
    for q, v in asked.items():
        out[q] = sorted({(-float((w * np.array(v)).sum()), i) for i, w in good if i != q})[:top]
    return out


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(4)
    centres = r.normal(size=(24, 16)) * 1.5
    rows = [(i, (centres[i % 24] + r.normal(size=16) * 0.5).astype(np.float32) * np.float32(0.5 + (i % 7) / 4)) for i in range(3000)]
    rows += [(4000 + i, rows[11][1]) for i in range(900)]  # copies of one vector
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    inf, nan = float("inf"), float("nan")
    odd = [None, [], [0.0] * 16, [1.0] * 15 + [None], [1.0] * 15 + [nan], [inf] + [1.0] * 15, [1.0] * 3]
    return rows + [(5000 + 20 * i, v) for i, v in enumerate(odd)] + [(None, [1.0] * 16), (40, rows[7][1]), (-20, rows[9][1]), (40, rows[40][1])]


def test_learned_ann_finds_the_neighbours(spark, vectors):
    df = spark.createDataFrame([(i, v, 1.0, 2) for i, v in vectors], "vec_id long, embedding array<float>, score double, part int").repartition(7)
    want = exact(vectors)
    for part_rows, least in ((10_000, 1.0), (128, 0.9)):  # one part is exact search
        got = {}
        for q, rank, v, s in ann.learned_ann(df, part_rows=part_rows).collect():
            got.setdefault(q, []).append((rank, v, s))
        assert set(got) == set(want)
        hit = total = 0
        for q, rows in got.items():
            rows.sort()
            assert len(rows) == len(want[q])
            assert [x[0] for x in rows] == list(range(1, len(rows) + 1))
            assert [(-s, v) for _, v, s in rows] == sorted((-s, v) for _, v, s in rows)
            hit += sum(((Counter(v for _, v, _ in rows)) & Counter(v for _, v in want[q])).values())
            total += len(want[q])
            if least == 1:
                assert np.allclose([s for *_, s in rows], [-s for s, _ in want[q]], atol=1e-9)
        assert hit / total >= least


def test_learned_parts_are_balanced_and_searched_in_part(vectors):
    x = np.array([v for i, v in vectors[:3000]])
    x = x[np.random.default_rng(1).permutation(len(x))]
    longest = np.linalg.norm(x, axis=1).max()
    near = ann.nearest(ann._forms(x, longest)[1], ann._forms(x, longest)[0], 10, own=True)
    part = ann.balanced_parts(near, 16)
    size = np.bincount(part, minlength=16)
    assert size.max() - size.min() <= 4
    assert (part[:, None] == part[near]).mean() > 0.5
    router, least = ann.fit_router(x, longest, 16)
    assert ann.reach(router(ann._forms(x, longest)[1]), least).mean() < 0.6


def test_learned_ann_of_little(spark):
    kind = "vec_id long, embedding array<double>"
    assert ann.learned_ann(spark.createDataFrame([], kind)).collect() == []
    assert ann.learned_ann(spark.createDataFrame([(20, None), (0, [0.0])], kind)).collect() == []
    assert ann.learned_ann(spark.createDataFrame([(20, [1.0])], kind)).collect() == []
    few = spark.createDataFrame([(i % 3, [1.0, float(i % 5)]) for i in range(600)], kind)  # many rows, few ids
    assert {r.vec_id for r in ann.learned_ann(few, part_rows=64).collect()} == {1, 2}
    got = ann.learned_ann(spark.createDataFrame([(20, [1e200, 1.0]), (21, [2.0, 1.0]), (22, [2.0, 1.0]), (23, [-1.0, 0.0])], kind))
    assert [(r.query_id, r["rank"], r.vec_id) for r in got.collect()] == [(20, 1, 21), (20, 2, 22), (20, 3, 23)]


# --- conversation repair --------------------------------------------------------------------------------------------------


def cheapest(letters):
    """All edit strings in order of cost, then ASCII: the first that ends well."""
    queue, seen = [(0, "", 0, fix.START)], set()
    while queue:
        cost, audit, i, q = heapq.heappop(queue)
        if (i, q) in seen:
            continue
        seen.add((i, q))
        if i == len(letters) and q in (fix.START, fix.ASSISTANT):
            return cost, audit
        nxt = {fix.START: fix.USER, fix.SYSTEM: fix.USER, fix.USER: fix.ASSISTANT, fix.ASSISTANT: fix.USER}[q]
        heapq.heappush(queue, (cost + 5, audit + "I", i, nxt))
        if i < len(letters):
            c = letters[i]
            heapq.heappush(queue, (cost + 2, audit + "D", i + 1, q))
            if c != "D":
                cut = 5 * c.isupper()
                heapq.heappush(queue, (cost + 1 + cut, audit + "R", i + 1, nxt))
                to = {"s": fix.SYSTEM if q == fix.START else None, "u": fix.USER if q != fix.USER else None, "a": fix.ASSISTANT if q == fix.USER else None}.get(c.lower())
                if to is not None:
                    heapq.heappush(queue, (cost + cut, audit + "K", i + 1, to))
    raise AssertionError(letters)


def by_blocks(letters):
    """The audit by the operator's own steps, blocks included."""
    size = lambda b: slice(b * b, (b + 1) * (b + 1))
    after, ends = fix.END, []
    for b in range(math.isqrt(len(letters)), -1, -1):
        ends.append(after)
        for c in reversed(letters[size(b)]):
            after = fix.before(c, after)
    q, audit, cost = fix.START, "", after[fix.START]
    for b, end in enumerate(reversed(ends)):
        done, q = fix.walk(letters[size(b)], end, q)
        audit += "".join("I" * len(put) + e for put, e, _ in done)
    return cost, audit + "I" * len(list(fix._closing(None, q)))


def test_edits_are_the_cheapest_and_least():
    for n in range(4):
        for letters in itertools.product("suaxDSUAX", repeat=n):
            assert by_blocks("".join(letters)) == cheapest("".join(letters)), letters
    r = random.Random(3)
    for _ in range(300):
        letters = "".join(r.choice("suuaaxDSUAX") for _ in range(r.randint(5, 30)))
        assert by_blocks(letters) == cheapest(letters), letters


def repaired(rows):
    """The contract, conversation by conversation."""
    out = []
    solid = re.compile(r"[^\x20\x09-\x0D]")
    for conv in {r[0] for r in rows}:
        mine = []
        for _, turn, role, text in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", r[3] or " ")):
            role, text = " " if role is None else role, " " if text is None else text
            k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if k:
                text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
                mine += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
        seen, faults = set(), []
        for _, role, text in mine:
            s = solid.findall(text)
            faults.append("b" if not s else "d" if (role, text) in seen else "t" if s[-1] not in ".!?" else "")
            seen.add((role, text))
        letters = "".join("D" if f in ("b", "d") and f else (c.upper() if f == "t" else c) for f, c in zip(faults, (r[:1] if r[:1] in ("s", "u", "a") else "x" for _, r, _ in mine), strict=True))
        cost, audit = cheapest(letters)
        told, at, last = [], iter(mine), ""
        for e in audit:
            turn, role, text = (None, None, "") if e == "I" else next(at)
            if e in "IR":
                role = "assistant" if last == "u" else "user"
            if e != "D":
                told.append(f"{role}:{text}")
                last = role[:1]
        turns = [t for t, *_ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        out.append((conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(told).encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def talks():
    r = random.Random(8)
    roles = ["user", "assistant", "system", "tool", "", None, "uncle"]
    rows = []
    for conv in range(60):
        for turn in range(r.randint(1, 12)):
            role = r.choice(roles) if r.random() < 0.2 else ("user", "assistant")[turn % 2]
            rows.append((conv, None if r.random() < 0.05 else turn, role, r.choice(["Yes.", "No!", "cut", " ", "", None, "a .", f"Text {turn}. \n", "ends?"])))
    rows += [(100, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(2000)]  # several blocks
    rows += [(101, t // 3, "user", "Same.") for t in range(200)] + rows[:30]
    rows += [(None, 0, "user", "Who."), (None, None, "assistant", "Me."), (102, 1, "user", "x" * 300_000), (102, 2, "assistant", "é. " * 90_000)]
    rows += [(103, -(2**63), "user", "a."), (103, 2**63 - 1, "assistant", "b.")]
    return rows


def test_repair_equals_brute_force(spark, talks):
    df = spark.createDataFrame([(*r, 1, "x") for r in talks], "conv_id long, turn long, role string, text string, pos long, letter string").repartition(5)
    conv = df.select("conv_id", "turn", "role", "text")
    got = [tuple(r) for r in fix.report(fix.repair(fix.damaged(df), conv)).collect()]
    want = [(c, min(g, 2**63 - 1), *rest) for c, g, *rest in repaired(talks)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_repair_equals_sql(spark, talks):
    small = [r for r in talks if r[0] != 103]
    con = duckdb.connect()
    con.execute("create table conversations(conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", small)
    assert sorted(con.execute(fix.OP13_SQL).fetchall(), key=repr) == sorted(repaired(small), key=repr)


def test_repaired_turns_and_dropped_conversations(spark):
    gone = next(i for i in range(10**6) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    conv = spark.createDataFrame([(gone, 0, "user", "Hm.")], "conv_id long, turn long, role string, text string")
    row = fix.report(fix.repair(fix.damaged(conv), conv)).collect()
    assert [tuple(r) for r in row] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert fix.report(fix.repair(fix.damaged(conv.limit(0)), conv.limit(0))).collect() == []
    rows = spark.createDataFrame([(1, 0, "user", "Hm.", 0), (1, 1, "user", "Oh.", 1), (1, 2, "tool", "Ah.", 2)], "conv_id long, turn long, role string, text string, place int")
    turns = fix.repair(rows, rows).collect()
    assert [(r.edit, r.role, r.text) for r in turns][1:] in ([("D", None, None), ("K", "user", "Oh."), ("R", "assistant", "Ah.")],)


# --- white space that only str.split knows -------------------------------------------------------------------------------


def test_bpe_pieces_equal_the_library():
    import tokenizers

    from ledgerlake.llm import bpe_automaton as B

    lib = tokenizers.Tokenizer.from_file(B.default_path())
    lib.no_truncation(), lib.no_padding()
    e = B.Encoder(B.compile_automaton(B.default_path()))
    r = random.Random(2)
    texts = ["a\x1cb c\x1f 's", "<|endoftext|>x<|startoftext|> y", "it's  IT'S Σας x y\x85z\xa0'll", "é ́e", "\x1c", "", "x" * 2000, "ab " * 5000]
    texts += ["".join(r.choice(" \n\tabcXYZ'sΣéß1٣,.! \x1d 中あ🙂<|>") for _ in range(r.randint(0, 40))) for _ in range(1500)]
    for t in texts:
        ids = lib.encode(t, add_special_tokens=False).ids
        got, text = e.both(t)
        assert got == np.array(ids, "<u4").tobytes(), repr(t)
        assert text == lib.decode(ids, skip_special_tokens=False) == e.decode(got)


def test_the_memory_of_pieces_forgets_only_what_is_old(monkeypatch):
    from ledgerlake.llm import bpe_automaton as B

    monkeypatch.setattr(B, "WORDS_KEPT", 3)
    m = B._Memory()
    for k in "abcdefgh":
        m.keep(k, k * 2)
        assert (m.young.get("a") or m.older("a")) == "aa"
    assert len(m.young) <= 3 and len(m.old) <= 3
    m.keep("x" * 65, 1)
    assert "x" * 65 not in m.young
