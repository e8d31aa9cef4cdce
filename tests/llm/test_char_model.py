"""Perplexities of the quality rules against a plain model kept in dictionaries, and the share of spoiled texts they reject."""

from __future__ import annotations

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import char_model
from ledgerlake.llm import words as W
from ledgerlake.llm.quality_rules import quality_rules

SF = "/root/testdata/sf0.01"


def halves(texts):
    return [int(char_model.half(b)[i]) for b in W.blocks(pa.array(texts, pa.string())) for i in range(b.rows)]


class Plain:
    """Modified Kneser-Ney over the 5-grams of some texts; `alphabet` counts the characters of all texts of the language."""

    def __init__(self, texts, alphabet):
        self.n = {5: collections.Counter(g for t in texts for g in self.grams(t))}
        for o in range(4, 0, -1):
            self.n[o] = collections.Counter(g[1:] for g in self.n[o + 1])
        self.zero, self.d, self.follow = 1 / (alphabet + 1), {}, {}
        for o, n in self.n.items():
            k = collections.Counter(n.values())
            n1, n2, n3, n4 = (max(1, k[i]) for i in (1, 2, 3, 4))
            y = n1 / (n1 + 2 * n2)
            raw = [(1 - 2 * y * n2 / n1, 0.9), (2 - 3 * y * n3 / n2, 1.9), (3 - 4 * y * n4 / n3, 2.9)]
            self.d[o] = [0.0] + [min(max(a, 0.1), b) for a, b in raw]
            self.follow[o] = collections.defaultdict(list)
            for g, c in n.items():
                self.follow[o][g[:-1]].append(c)

    @staticmethod
    def grams(t):
        t = "\n\n\n\n" + t
        return [t[i : i + 5] for i in range(len(t) - 4)]

    def p(self, g):
        if not g:
            return self.zero
        o, lower = len(g), self.p(g[1:])
        after = self.follow[o].get(g[:-1])
        if not after:
            return lower
        d, c = self.d[o], self.n[o][g]
        return (c - d[min(c, 3)] + sum(d[min(x, 3)] for x in after) * lower) / sum(after)


@pytest.mark.parametrize("frequent", [char_model.FREQUENT, 40])
def test_perplexity_equals_a_plain_model(spark, frequent):
    r = random.Random(11)
    texts = [("".join(r.choice("abcde é日🙂\n.") for _ in range(r.randint(1, 60))), r.choice(["x", "y", None])) for _ in range(50)]
    texts += [("", "x"), (None, "y"), ("alone", "z"), texts[0], ("ab" * 3000, "x")]
    out, p = quality_rules(spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(texts)], "doc_id long, text string, lang string"), frequent=frequent)
    got = {x["doc_id"]: x for x in out.collect()}
    side = halves([t for t, _ in texts])
    model = {}
    for lang in {g for _, g in texts}:
        alphabet = len(set("".join(t or "" for t, g in texts if g == lang)))
        for f in (0, 1):
            model[lang, f] = Plain([t or "" for (t, g), s in zip(texts, side, strict=True) if g == lang and s == f], alphabet)
    for i, (t, g) in enumerate(texts):
        x = got[i]
        assert x[p + "chars"] == len(t or "")
        if not t:
            assert x[p + "log_ppl"] is None and not x[p + "kept"]
            continue
        want = -sum(math.log10(model[g, 1 - side[i]].p(k)) for k in Plain.grams(t)) / len(t)
        assert x[p + "log_ppl"] == pytest.approx(want, abs=2e-6)


def test_a_model_sums_to_one():
    m = Plain(["abracadabra abba", "cadabra"], 6)
    for context in ("", "a", "ab", "abra", "zzzz", "abr"):
        known = sum(m.p(context + c) for c in "abrcd ")
        assert known == pytest.approx(1 - m.p(context + "?"))


def test_characters_and_rows():
    texts = ["aé日🙂", "", "🙂\n", None, "z" * 10]
    for b in W.blocks(pa.array(texts, pa.string())):
        c, offsets = char_model.characters(b)
        assert ["".join(map(chr, c[i:j])) for i, j in zip(offsets[:-1], offsets[1:], strict=True)] == [t or "" for t in texts]


def test_tasks_fold_what_they_hold(monkeypatch):
    monkeypatch.setattr(char_model, "HELD", 20)
    batch = pa.RecordBatch.from_arrays([pa.array(["abcdefgh" * 9, "xyz", None, "q" * 50]), pa.array(np.array([1, 2, 3, 1]))], ["text", "l"])
    total = collections.Counter()
    for out in char_model._count([batch, batch]):
        for l, hi, lo, a, b in zip(*(x.to_pylist() for x in out.columns), strict=True):
            total[l, hi, lo] += a + b
    assert sum(total.values()) == 2 * (72 + 3 + 50)


def test_spoiled_texts_are_rejected_and_clean_ones_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    rows = docs.collect()
    r = random.Random(3)
    long = [x for x in rows if len(x.text) > 200]
    spoil = {
        1: lambda s: "".join(c.upper() if r.random() < 0.5 else c.lower() for c in s),
        2: lambda s: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") if c.isalpha() else c for c in s),
        3: lambda s: "".join(chr(r.randint(0x400, 0x4FF)) if ord(c) > 127 else c for c in s),
    }
    extra = []
    for k, f in spoil.items():
        pick = [x for x in long if k != 3 or sum(ord(c) > 127 for c in x.text) > 0.05 * len(x.text)]
        extra += [(k * 10**6 + x.doc_id, x.lang, f(x.text)) for x in r.sample(pick, 20)]
    out, p = quality_rules(docs.unionByName(spark.createDataFrame(extra, docs.schema)))
    judged = out.filter(~F.col(p + "base_failed")).groupBy(F.expr("doc_id div 1000000").alias("k")).agg(F.avg(F.col(p + "kept").cast("int")).alias("kept"))
    kept = {x["k"]: x["kept"] for x in judged.collect()}
    assert kept[0] > 0.95
    assert kept[1] == 0 and kept[2] == 0
    assert kept[3] < 0.5


def test_counting_takes_little_memory():
    import tracemalloc

    rng = np.random.default_rng(3)
    texts = ["".join(map(chr, rng.integers(97, 123, 20_000))) for _ in range(250)]  # 5 MB, hardly a 5-gram twice
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([1] * len(texts))], ["text", "l"])
    tracemalloc.start()
    try:
        n = sum(out.num_rows for out in char_model._count([batch]))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n > 3_000_000
    assert most < 200e6, most
