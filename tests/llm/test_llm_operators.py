"""The language-model data operators on small hand-made tables, against brute force and exact round trips."""

from __future__ import annotations

import collections
import hashlib
import pathlib
import random
import re
import time

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import bpe_automaton, chat_format, decontaminate, latent, packing, page_text, ppm
from ledgerlake.llm import words as W
from ledgerlake.llm.decontaminate import lcs, leaks
from ledgerlake.llm.line_dedup import line_dedup
from ledgerlake.llm.neighbour_quality import neighbour_quality
from ledgerlake.llm.ngram_join import ngram_join
from ledgerlake.llm.ppm import ppm_scores
from ledgerlake.llm.quality_rules import quality_rules
from ledgerlake.llm.tables import CLEAN_UP, components, intermediates, written

DOCS = "doc_id long, text string, lang string, n long, tok string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(r: random.Random, n: int) -> str:
    vocabulary = ["the", "of", "and", "in"] * 5 + ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(60)]
    return " ".join(r.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    out = []
    for i in range(60):
        out.append((i, "\n".join(prose(r, r.randint(3, 30)) for _ in range(r.randint(1, 6)))))
    base = prose(r, 120)
    for i in range(60, 90):  # near copies around the threshold
        w = base.split()
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = "zz" + str(r.randrange(999))
        out.append((i, " ".join(w) + "\n" + prose(r, 4)))
    out += [(90, None), (91, ""), (92, " \n\t"), (93, "one"), (94, "two words"), (95, "one"), (96, "ÉÀ ß İ 日本 " * 9), (97, "x" * 5000), (3, out[3][1]), (None, base), (None, None)]
    return [(i, t, "en" if i is None or i % 2 else None, 7, "clash") for i, t in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def low(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})


def grams(t, n):
    w = WORD.findall(low(t))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("n,num,den", [(3, 9, 10), (5, 4, 5)])
def test_ngram_join_equals_brute_force(docs, rows, n, num, den):
    sets = [grams(r[1], n) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    members = collections.defaultdict(list)
    for k, r in enumerate(rows):
        members[find(k)].append(r[0])
    least = {k: min((i for i in m if i is not None), default=None) for k, m in members.items()}
    want = collections.Counter((r[0], len(s), least[find(k)]) for k, (r, s) in enumerate(zip(rows, sets, strict=True)))
    assert collections.Counter(map(tuple, ngram_join(docs, n, num, den).collect())) == want


def test_ngram_join_of_empty_table(empty):
    assert ngram_join(empty).count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_line_dedup_equals_brute_force(docs, rows):
    seen, want = [], {}
    for i, t in sorted({(r[0], r[1]) for r in rows if r[0] is not None and r[1] is not None}):
        gone = []
        for k, line in enumerate(t.split("\n")):
            s = grams(line, 5)
            if s and any(5 * len(s & x) >= 4 * len(s | x) for x in seen):
                gone.append(k)
            if s:
                seen.append(s)
        want[i] = (gone, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone))
    out = line_dedup(docs, key_cols=["n"]).collect()
    assert len(out) == len(rows)
    for r in out:
        if r["doc_id"] in want:
            assert (r["removed"], r["text"]) == want[r["doc_id"]]
            assert r["n"] == 7
        elif r["doc_id"] == 90:
            assert r["text"] is None and r["n_lines"] == 0


def longer_copies(spark, n, size, extra, triples=16):
    """Triples C, A, B, one row each, by id: B is A behind rare words, and C has the first tokens of A, so that A and B meet C first."""
    r = random.Random(n)
    word = lambda: "w" + str(r.randrange(10**9))
    rows = []
    for k in range(triples):
        a = [word() for _ in range(size + n - 1)]
        b = [word() for _ in range(extra)] + a
        order = np.argsort(W.ngrams(W.words(next(W.blocks(pa.array([" ".join(a)]))), True)[0], n))
        c = [x for at in order[: (extra + size) // n // 2] for x in a[at : at + n]]
        c += [word() for _ in range(extra + size + n - 1 - len(c))]
        rows += [(3 * k, " ".join(c)), (3 * k + 1, " ".join(a)), (3 * k + 2, " ".join(b))]
    # a task for each row: no token is counted twice in one, and all are ordered by hash
    return rows, spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "doc_id long, text string")


def test_ngram_join_links_longer_copies(spark):
    rows, table = longer_copies(spark, 3, 90, 10)
    got = {x["doc_id"]: x["component_id"] for x in ngram_join(table, 3, 9, 10).collect()}
    assert got == {i: i - (i % 3 == 2) for i, _ in rows}


def test_line_dedup_removes_longer_copies(spark):
    rows, table = longer_copies(spark, 5, 80, 20)
    got = {x["doc_id"]: x["removed"] for x in line_dedup(table).collect()}
    assert got == {i: [0] if i % 3 == 2 else [] for i, _ in rows}


def test_line_dedup_of_empty_table(empty):
    assert line_dedup(empty).count() == 0


def test_quality_counts_equal_brute_force(docs, rows):
    out, p = quality_rules(docs)
    assert set(docs.columns) <= set(out.columns)
    got = {r["doc_id"]: r for r in out.collect()}
    for i, t, *_ in rows:
        if i is None:
            continue
        t = t or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        c = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if c[tuple(w[k : k + 5])] > 1 for j in range(5)}
        r = got[i]
        assert [r[p + f] for f in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] == [
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)
        ]
        assert r[p + "base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert not (r[p + "base_failed"] and r[p + "kept"])


def test_quality_rules_of_empty_table(empty):
    assert quality_rules(empty)[0].count() == 0


def test_quality_rules_reject_odd_perplexity(spark):
    r = random.Random(1)
    good = [(i, prose(r, 80), "en", 0, "") for i in range(150)]
    odd = [(900 + i, " ".join("".join(r.choice("qxzj#$%") for _ in range(9)) for _ in range(60)), "en", 0, "") for i in range(3)]
    out, p = quality_rules(spark.createDataFrame(good + odd, DOCS))
    kept = {x["doc_id"] for x in out.filter(p + "kept").collect()}
    assert kept == set(range(150))


def test_bpe_equals_the_library(docs, rows):
    from tokenizers import Tokenizer

    path = bpe_automaton.default_path()
    lib = Tokenizer.from_file(path)
    e = bpe_automaton.Encoder(bpe_automaton.compile_automaton(path))
    r = random.Random(2)
    texts = ["".join(r.choice("aabcdeehlorstn'0! ÉΣ🙂") for _ in range(r.randint(0, 40))) for _ in range(3000)]
    texts += ["<|endoftext|> a<|startoftext|>", "<|endoftext", "aaaaaaa", "ΑΣ ΣΑΣ", "é", "\x1c\x85\xa0", "½²", "WE'LL don't"]
    for t in texts:
        ids = lib.encode(t, add_special_tokens=False).ids
        got = e.encode(t)
        assert np.frombuffer(got, "<u4").tolist() == ids
        assert e.decode(got) == lib.decode(ids, skip_special_tokens=False)
    out = bpe_automaton.bpe(docs, path).collect()
    assert len(out) == len(rows)
    by = {x["doc_id"]: x for x in out}
    assert by[90]["n_tokens"] == 0 and by[90]["decoded"] == "" and by[90]["ids_sha256"] == hashlib.sha256(b"").hexdigest()


def test_bpe_of_empty_table(empty):
    assert bpe_automaton.bpe(empty, bpe_automaton.default_path()).count() == 0


def test_ppm_is_a_distribution_and_counts_are_exact(docs, rows):
    out = ppm_scores(docs, "d % 5 <> 1").collect()
    assert len(out) == len(rows)
    tokens = [(i, [*low(t).encode().split(), b"\n"]) for i, t, *_ in rows]
    c = collections.Counter(w for i, ws in tokens if i is None or i % 5 != 1 for w in ws)
    total, kinds = sum(c.values()), len(c)
    want = {i: (len(ws), sum(c[w] > 0 for w in ws), sum(np.log10((c[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in ws)) for i, ws in tokens if i is not None}
    for r in out:
        assert r["train_tokens"] == total or r["doc_id"] is None
        if r["doc_id"] in want:
            n, known, base = want[r["doc_id"]]
            assert (r["n_tokens"], r["n_known"], r["held_out"]) == (n, known, r["doc_id"] % 5 == 1)
            assert r["base_score"] == pytest.approx(base) and r["score"] < 0


def test_ppm_pairs_sum_to_one(spark):
    """Over all symbols, the probabilities after a context add up to 1 (escapes and exclusion lose nothing)."""
    seen = {b" ab": 3, b" a ": 1, b" b ": 2, b"ab ": 3, b" \n": 4, b" a": 4, b" b": 2}
    pairs = collections.Counter()
    for word, n in ((b"ab", 3), (b"a", 1), (b"b", 2), (ppm.END, 4)):
        s = ppm.spelled(word)
        for i in range(1, len(s)):
            pairs[s[max(0, i - 2) : i + 1]] += n
    assert seen
    inner = [bytes([b]) for b in range(256) if b not in b" \t\n\x0b\x0c\r"] + [b" ", b"\n"]
    for context in (b" a", b"ab", b"zz", b" "):
        rows = dict(pairs)
        for s in inner:
            rows.setdefault(context + s, 0)
        df = spark.createDataFrame([(bytearray(k), v) for k, v in rows.items()], "pair binary, n long")
        got = {bytes(r["pair"]): r["lp"] for r in ppm.pair_scores(df, 2).collect()}
        assert sum(10 ** got[context + s] for s in inner) == pytest.approx(1.0)


def test_ppm_pairs_are_joined_as_integers(spark):
    """A packed pair keeps its length and zero bytes, scores as the binary one, and no shuffle carries bytes."""
    pairs = [(b"a", 2), (b"\0a", 3), (b"\0\0a", 1), (b"ab", 0), (b"xab", 4), (b"zab", 0), (b"", 0)]
    df = spark.createDataFrame([(bytearray(k), n) for k, n in pairs], "pair binary, n long").withColumn("key", ppm.packed("pair"))
    keys = {bytes(r["pair"]): r["key"] for r in df.collect()}
    assert keys == {k: int.from_bytes(b"\1" + k, "big") for k, _ in pairs}
    top = spark.createDataFrame([(bytearray(b"abcdef\xff"),)], "pair binary").select(ppm.packed("pair").alias("key")).first()["key"]
    assert top == int.from_bytes(b"\1abcdef\xff", "big") < 1 << 63
    df = df.filter("length(pair) > 0")
    by_key = ppm.key_scores(df.select("key", "n"), 2)
    assert [x.dataType.simpleString() for x in by_key.schema] == ["bigint", "double"]
    want = {bytes(r["pair"]): r["lp"] for r in ppm.pair_scores(df.select("pair", "n"), 2).collect()}
    assert {r["key"]: r["lp"] for r in by_key.collect()} == {keys[k]: lp for k, lp in want.items()}
    plan = by_key._jdf.queryExecution().executedPlan().toString()
    assert "substring" not in plan and "unhex" not in plan


def test_ppm_words_of_other_rows_count_zero(monkeypatch):
    texts, train = ["a b A", "b c c", None, "a d"], [True, False, True, False]
    for held in (200_000, 1):
        monkeypatch.setattr(ppm, "HELD", held)
        got = collections.Counter()
        for out in ppm._count_words([pa.RecordBatch.from_arrays([pa.array(texts), pa.array(train)], ["text", "train"])]):
            for w, c in zip(*(x.to_pylist() for x in out.columns), strict=True):
                got[w] += c
        assert dict(got) == {b"a": 2, b"b": 1, ppm.END: 2, b"c": 0, b"d": 0}


def test_ppm_frequent_pairs_stay_in_the_task(monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(["again and again", *("".join(rng.choices("abcdefgh", k=5)) for _ in range(60))]) for _ in range(60)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[k : k + 2]), pa.array([k % 3 > 0, True])], ["text", "train"]) for k in range(0, 60, 2)]
    total, sent = [collections.Counter(), collections.Counter()], []
    for held in (1 << 21, 4_000):  # in one part, and in several
        monkeypatch.setattr(ppm, "HELD_PAIRS", held)
        sent.append(collections.Counter())
        for out in ppm._count_pairs(6)(batches):
            k, n, m = (c.to_pylist() for c in out.columns)
            sent[-1].update(k)
            for key, x, y in zip(k, n, m, strict=True):
                total[0 if held == 1 << 21 else 1][key] += x + (y << 32)
    assert total[0] == total[1]
    often = [k for k, _ in sorted(total[0].items(), key=lambda x: -(x[1] >> 32))[:10]]
    assert max(sent[1].values()) > 1  # rare ones went in several parts
    assert all(sent[1][k] == 1 for k in often)


def plain_ppm(texts, learn, order):
    """log10 probability of each text under the method of `ppm`, from counts kept in dictionaries."""
    stream = lambda t: b"\n" * (order - 1) + ppm.spelled(*low(t).encode().split(), ppm.END)
    tries = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
    for t in learn:
        s = stream(t)
        for i in range(order, len(s)):
            for o in range(order + 1):
                tries[o][s[i - o : i]][s[i]] += 1
    out = []
    for t in texts:
        s, total = stream(t), 0.0
        for i in range(order, len(s)):
            gone = set()
            for o in range(order, -1, -1):
                kinds = {k: n for k, n in tries[o].get(s[i - o : i], {}).items() if k not in gone}
                if s[i] in kinds:
                    total += np.log10((kinds[s[i]] - 0.5) / sum(kinds.values()))
                    break
                if kinds:
                    total += np.log10(0.5 * len(kinds) / sum(kinds.values()))
                gone |= set(kinds)
            else:
                total -= np.log10(max(252 - len(gone), 1))
        out.append(total)
    return out


@pytest.mark.parametrize(("order", "frequent"), [(6, 1 << 21), (6, 40), (2, 1 << 21)])
def test_ppm_contexts_run_across_words(docs, rows, order, frequent):
    got = {r["doc_id"]: r["score"] for r in ppm_scores(docs, "d % 5 <> 1", order=order, frequent=frequent).collect() if r["doc_id"] is not None}
    texts = {i: t or "" for i, t, *_ in rows if i is not None}
    want = plain_ppm(texts.values(), [t or "" for i, t, *_ in rows if i is None or i % 5 != 1], order)
    for i, w in zip(texts, want, strict=True):
        assert got[i] == pytest.approx(w), i


def test_ppm_tells_word_order_apart(spark):
    """The same words in the order of the training texts are likelier than in another order."""
    r = random.Random(2)
    vocabulary = [prose(r, 1) for _ in range(12)]
    learn = [(5 * i, " ".join(vocabulary)) for i in range(20)]
    docs = spark.createDataFrame([*learn, (1, " ".join(vocabulary)), (6, " ".join(vocabulary[::-1]))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in ppm_scores(docs, "d % 5 <> 1").collect()}
    assert got[1]["base_score"] == pytest.approx(got[6]["base_score"]) and got[1]["score"] > got[6]["score"] + 1


def test_ppm_of_empty_table(empty):
    assert ppm_scores(empty, "d % 5 <> 1").count() == 0


def test_neighbour_quality_separates_and_handles_odd_rows(spark, docs, empty):
    r = random.Random(4)
    good = [(i, prose(r, 60)) for i in range(200)]
    bad = [(i, " ".join(w + r.choice(["***", "$$$"]) for w in prose(r, 60).split())) for i in range(200, 260)]
    table = spark.createDataFrame([(i, t, "en", 0, "x") for i, t in good + bad] + [(999, None, None, None, None)], DOCS)
    labels = spark.createDataFrame([(i, int(i < 200)) for i in range(260) if i % 3] + [(None, 1), (5, None)], "doc_id long, quality int")
    got = {x["doc_id"]: x["score"] for x in neighbour_quality(table, labels).collect()}
    assert all((got[i] >= 0.3) == (i < 200) for i in range(0, 260, 3)) and 0 <= got[999] <= 1
    assert neighbour_quality(empty, labels).count() == 0
    assert {x["score"] for x in neighbour_quality(docs, labels.limit(0)).collect()} == {0.5}


def test_leaks_finds_copies_and_paraphrases_only(spark, empty):
    r = random.Random(6)
    items = [(i, " ".join("w" + str(r.randrange(4000)) for _ in range(r.randint(16, 50)))) for i in range(20)]
    clean = [(i, " ".join("w" + str(r.randrange(4000)) for _ in range(200))) for i in range(100)]
    leaked = []
    for i, t in items:
        w = t.split()
        if i % 2:
            w[len(w) // 2] = "other"
        leaked.append((1000 + i, f"{clean[i][1]} {' '.join(w)} {clean[i + 1][1]}"))
    rows = [(i, t, "en", 0, "") for i, t in clean + leaked] + [(None, None, None, None, None), (5000, "", "", 0, "")]
    bench = spark.createDataFrame([*items, (77, None), (78, "")], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]) for x in leaks(spark.createDataFrame(rows, DOCS), bench).collect()}
    assert got == {(1000 + i, i) for i, _ in items}
    assert leaks(empty, bench).count() == 0
    assert leaks(spark.createDataFrame(rows[:3], DOCS), bench.limit(0)).count() == 0


def test_a_written_table_leaves_no_shuffle_files(spark):
    """The blocks of a shuffle go with the write that it was for; the session's own setting stays as it was."""
    dirs = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def files():
        return {str(f) for d in dirs for f in pathlib.Path(d).rglob("shuffle_*")}

    before = spark.conf.get(CLEAN_UP, None)
    old = files()
    out = written(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "t")
    for _ in range(100):  # the executors delete them on their own time
        if files() - old:
            time.sleep(0.1)
    assert not files() - old and sorted(out.collect()) == [(k, 100) for k in range(10)]
    assert spark.conf.get(CLEAN_UP, None) == before


def test_lcs():
    r = random.Random(7)
    for _ in range(200):
        a, b = [[r.randrange(5) for _ in range(r.randint(0, 12))] for _ in range(2)]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert lcs(a, b) == t[-1][-1]


def test_lcs_only_where_enough_words_are_shared(monkeypatch):
    """A window of an item's words in a text that has none of its others is near, but can't be a leak: no LCS is worked out."""
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    items = [[word() for _ in range(40)] for _ in range(30)]
    vectors = np.random.Generator(np.random.PCG64(1)).standard_normal((latent.TERMS, decontaminate.RANK)).astype(np.float32)
    table = type("Table", (), {"value": None})
    space = latent.Space(np.ones(latent.TERMS, np.float32), vectors)
    table.value = space, decontaminate.Items(space, list(range(30)), [" ".join(x) for x in items])
    around = lambda n: [word() for _ in range(n)]
    near = [(k, " ".join(around(8) + x[8:20] + around(60))) for k, x in enumerate(items)]
    whole = [(100 + k, " ".join(around(8) + x + around(20))) for k, x in enumerate(items)]
    batch = pa.RecordBatch.from_arrays([pa.array([k for k, _ in near + whole]), pa.array([t for _, t in near + whole])], ["d", "text"])
    calls = []
    real = decontaminate.lcs_at
    monkeypatch.setattr(decontaminate, "lcs_at", lambda *a: calls.append(1) or real(*a))
    got = pa.Table.from_batches(decontaminate._search(table)([batch])).to_pylist()
    assert {(x["d"], x["i"], x["lcs"], x["answer"]) for x in got} == {(100 + k, k, 1.0, 1.0) for k in range(30)} and len(got) == 30
    assert len(calls) == 2 * 30  # a whole item's words and its answer's


def test_latent_rows_are_packed_and_summed():
    r = np.random.Generator(np.random.PCG64(3))
    row = np.sort(r.integers(0, 9000, 20_000))
    row = row[row % 5 != 0]  # some rows have no terms
    m = latent.counted_rows(row, r.integers(0, latent.TERMS, len(row)), 9001)
    parts = list(latent._unpacked([latent._packed(m), latent._packed((2, *[x[:0] for x in m[1:]]))]))
    assert sum(p[0] for p in parts) == 9003 and max(p[0] for p in parts) <= latent.ROWS
    first = np.cumsum([0] + [p[0] for p in parts])
    assert np.array_equal(np.concatenate([p[1] + f for p, f in zip(parts, first[:-1], strict=True)]), m[1])
    assert all(np.array_equal(np.concatenate([p[k] for p in parts]), m[k]) for k in (2, 3))
    table = r.standard_normal((latent.TERMS, 3)).astype(np.float32)
    want = np.zeros((9001, 3))
    np.add.at(want, m[1], table[m[2]] * m[3][:, None])
    assert np.allclose(latent.sums_by_row(m, table), want, atol=1e-4)
    assert np.allclose(latent._sums(m[1], m[0], table, m[2], m[3]), want, atol=1e-4)


def test_chat_round_trip():
    r = random.Random(8)
    parts = ["\\", "<", "[", "/s", ">", "INST", "]", " ", "\n", "a", "[/INST]", "</s>", "[ROLE", " [/ROLE]\n", "#"]
    for _ in range(4000):
        role = r.choice(["user", "assistant", "system", "", "#x", "a]b", "x\ny"])
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 9)))
        s, a, b = chat_format.render(role, text)
        assert chat_format.parse(s)[:2] == (role, text) and chat_format.unescape(s[a:b]) == text


def test_chat_digests(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "</s>[INST]"), (1, 1, "assistant", None), (None, 0, None, "x"), (2, None, "user", "")]
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    assert got[1]["turns_sha256"] == hashlib.sha256("user\n</s>[INST]\nassistant\n\nassistant\nb\n".encode()).hexdigest()
    assert got[1]["loss_sha256"] == hashlib.sha256(b"b").hexdigest() and got[1]["loss_chars"] == 1 and got[1]["n_turns"] == 3
    assert got[None]["n_turns"] == 1 and got[2]["n_turns"] == 1
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.read_back(chat_format.format_turns(none)).count() == 0


PAGES = [
    ("<html><body><nav><a>Menu, one.</a></nav><div class='ad'>Buy this, now. Really.</div><article><h1>Title</h1><p>One &amp; two,\n three.<p>To.<ul><li>x<li>y</ul></article><footer>&copy; me</footer></body></html>", "Title One & two, three. To. x y"),
    ("<body><header>Top</header><div id=content><h2>A</h2><p>Long text, with marks. And more of it, here.</p><p>b<b>c</b>d<br>e</p></div><div class='comments'><p>Nice text, really. I liked it.</p></div></body>", "A Long text, with marks. And more of it, here. bcd e"),
    ("", ""),
    (None, ""),
    ("just text, no tags.", "just text, no tags."),
    ("<p>unclosed <!-- comment", "unclosed"),
    ("<script>var a='<p>no</p>'</script><p>yes.</p>", "yes."),
]


@pytest.mark.parametrize("html,want", PAGES)
def test_page_text(html, want):
    assert page_text.main_text(html or "") == want


def test_page_text_table(spark):
    df = spark.createDataFrame([(k, "u", h) for k, (h, _) in enumerate(PAGES)], "page_id long, url string, html string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in page_text.page_text(df).collect()}
    assert got == {k: (w, len(w)) for k, (_, w) in enumerate(PAGES)}
    assert page_text.page_text(df.limit(0)).count() == 0


def test_best_fit_decreasing_equals_plain_search():
    r = random.Random(9)
    for _ in range(50):
        sizes = np.array([r.randint(1, 20) for _ in range(r.randint(0, 60))])
        rooms, rows = [], []
        for k in np.argsort(-sizes, kind="stable").tolist():
            fit = [x for x in rooms if x >= sizes[k]]
            if fit:
                rooms.remove(min(fit))
                rooms.append(min(fit) - sizes[k])
            else:
                rooms.append(20 - sizes[k])
        rows = packing.best_fit_decreasing(sizes, 20)
        assert sorted(k for row in rows for k in row) == list(range(len(sizes)))
        assert sorted(20 - sum(sizes[row]) for row in rows) == sorted(rooms)


def test_packing_is_lossless(docs, rows):
    import tiktoken

    path, pattern = packing.default_tokenizer()
    out = packing.pack(docs, path, pattern, length=64, shard_tokens=500).collect()
    import base64

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    pieces = collections.defaultdict(list)
    for r in out:
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == 64 and r["cu_seqlens"][-1] == r["n_tokens"] <= 64
        for d, p, a, b in zip(r["docs"], r["pieces"], r["cu_seqlens"], r["cu_seqlens"][1:], strict=False):
            pieces[d].append((p, ids[a:b].tolist()))
        pos = packing.positions(np.array(r["cu_seqlens"]), 64)
        assert all(pos[a] == 0 for a in r["cu_seqlens"] if a < 64)
    for i, t, *_ in rows:
        if i not in (None, 3):
            assert [x for _, ids in sorted(pieces[i]) for x in ids] == [*enc.encode_ordinary(t or ""), len(ranks)]


def test_packing_of_empty_table(empty):
    assert packing.pack(empty, *packing.default_tokenizer()).count() == 0


def test_pipeline_on_odd_rows(spark, docs, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, "no such words here at all, none whatever, never ever")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        kept = stage(spark, before, str(tmp_path)).cache()
        if name != "encode":
            assert kept.columns == before.columns
        assert kept.count() <= before.count()


def test_pipeline_quality_keeps_no_text_aside(spark):
    from corpus_pipeline import quality

    rng = random.Random(2)
    good = [" ".join("".join(rng.choices("abcde", k=rng.randint(2, 6))) for _ in range(60)) for _ in range(40)]
    rows = [(i, t, "en", 1) for i, t in enumerate(good)] + [(100, None, "en", 2), (101, "", None, 3), (102, "too short", None, 4), (None, good[0], "en", 5), (3, good[3], "en", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    with intermediates() as made:
        out = quality(spark, df, "")
    judged, p = quality_rules(df)
    assert sorted(map(str, out.collect())) == sorted(map(str, judged.filter(p + "kept").select(*df.columns).collect()))
    assert out.columns == df.columns and out.count() > 30
    assert [t.columns for t in made] == [["k", "k2"]]


def test_oracles_of_the_whole_tables(spark):
    from ledgerlake.llm.queries import ORACLE, QUERIES

    d = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for t in ("pages", "conversations", "documents", "benchmark"):
        c.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    for name, sql in ORACLE.items():
        got = QUERIES[name](spark, d)
        want = c.execute(f"select {', '.join(sorted(got.columns))} from ({sql})").fetchall()
        assert collections.Counter(map(tuple, got.select(*sorted(got.columns)).collect())) == collections.Counter(want)


