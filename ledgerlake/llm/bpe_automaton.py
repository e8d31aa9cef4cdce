"""BPE encoding by a tokenization automaton, and decoding by its arc labels.

Compile. The automaton reads tokens; its state is the last token read. It begins with one state that has an arc for
every base symbol. Each merge (u, v) -> c, in rank order, applies one gadget: every state with an arc u gets an arc c;
the state behind c is a copy of the state behind v as it was then; the state behind u loses its arc v. What is left
after the last merge accepts exactly the BPE segmentation of each string. Copies are not stored arc by arc (that would
be vocabulary squared): a state holds which state it copies and when, a merged arc which arc it follows, and a lost arc
when it was lost. Looked-up arcs are kept in the transition table.

Encode. Words come pre-split. From each position the trie of the tokens' symbols is walked; a token leads to its end
position if the automaton has its arc from the state at the position. As the automaton is deterministic, each position
has one state only, and the path that ends at the word's end is the encoding. Decoding writes the arcs' labels.

Defined cases. Null and empty texts have no tokens and decode to the empty string. Strings of the file's added tokens
inside a text become these tokens. Null ids and repeated rows are kept as they are. An empty table gives an empty table. Only
the id and text columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
import uuid
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS_KEPT = 150_000  # in each of two generations
ARCS_KEPT = 1 << 20
TOKEN = -1
_CUT_ONLY_HERE = "\x1c\x1d\x1e\x1f"  # white space to str.split, but not to the pattern
_SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100 on."""
    plain = set(range(0x21, 0x7F)) | set(range(0xA1, 0xAD)) | set(range(0xAE, 0x100))
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


@dataclass
class Automaton:
    labels: list[str]
    left: list[int]
    right: list[int]
    born: list[int]
    merged: dict[int, int]
    trie: dict  # by symbol, nested; TOKEN: the token whose symbols lead here
    symbol: dict[str, int]
    suffix: str
    pattern: str
    special: dict[str, int]
    arcs: dict[int, bool] = field(default_factory=dict)

    def has_arc(self, state: int, token: int) -> bool:
        """Whether the state has the arc, from the transition table or, at first, from the gadgets."""
        key = state << 20 | token
        known = self.arcs.get(key)
        if known is None:
            known = self.arcs[key] = self._made(state, token)
        return known

    def _made(self, state: int, token: int) -> bool:
        until = 1 << 40
        while True:
            lost = self.merged.get(state << 20 | token)
            if lost is not None and lost < until:
                return False
            s, t = self.born[state], self.born[token]
            if s < 0 and t < 0:
                return True
            if s == t:  # the arc of a merged token behind itself
                state, token, until = self.right[state], self.left[token], s
            elif t > s:  # a merged arc follows the arc of its first part, after that gadget's losses
                token, until = self.left[token], t + 1
            else:  # a copied state, as it was when it was copied
                state, until = self.right[state], s

    def word(self, symbols: list[int]) -> list[int]:
        n = len(symbols)
        state, back = [-1] * (n + 1), [0] * (n + 1)
        trie, arcs = self.trie, self.arcs
        for i in range(n):
            s, node, j = state[i] << 20, trie, i
            while j < n and (node := node.get(symbols[j])) is not None:
                j += 1
                t = node.get(TOKEN)
                if t is not None:
                    if i:
                        ok = arcs.get(s | t)
                        if ok is None:
                            ok = self.has_arc(s >> 20, t)
                        if not ok:
                            continue
                    state[j], back[j] = t, i
        out, i = [], n
        while i:
            out.append(state[i])
            i = back[i]
        return out[::-1]


def compile_automaton(path: str) -> Automaton:
    """From a tokenizer file of byte symbols with a word-end suffix (see the module's text)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    suffix = model["end_of_word_suffix"]
    vocab = model["vocab"]
    labels = [""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
    for s, i in vocab.items():
        labels[i] = s
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    for s, i in special.items():
        labels[i] = s
    left, right, born = [-1] * len(labels), [-1] * len(labels), [-1] * len(labels)
    merged: dict[int, int] = {}
    for rank, (u, v) in enumerate(model["merges"]):
        a, b, c = vocab[u], vocab[v], vocab[u + v]
        if born[c] >= 0 or max(born[a], born[b]) >= rank:
            raise ValueError(f"merge {rank} does not make a new token of older ones")
        left[c], right[c], born[c] = a, b, rank
        merged[a << 20 | b] = rank
    symbol = {}
    for s in byte_symbols():
        symbol[s] = vocab[s]
        symbol[s + suffix] = vocab[s + suffix]
    base = {i: k for k, i in enumerate(sorted(set(symbol.values())))}
    spelled: dict[int, list[int]] = {i: [k] for i, k in base.items()}
    trie: dict = {}
    for t in sorted((i for i in vocab.values() if born[i] >= 0 or i in base), key=lambda i: born[i]):
        if t not in spelled:
            spelled[t] = spelled[left[t]] + spelled[right[t]]
        node = trie
        for k in spelled[t]:
            node = node.setdefault(k, {})
        node[TOKEN] = t
    pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace("[^\\s", f"[^{_SPACE}")
    return Automaton(labels, left, right, born, merged, trie, {s: base[i] for s, i in symbol.items()}, suffix, pattern, special)


@lru_cache(maxsize=256)
def _packer(n: int):
    return struct.Struct(f"<{n}I").pack


class _Memory:
    """Short strings met lately: two generations of bounded size, so that what recurs is not forgotten."""

    def __init__(self):
        self.young: dict = {}
        self.old: dict = {}

    def older(self, key: str):
        """A value of the older generation, which then is young again."""
        value = self.old.get(key)
        if value is not None:
            self.keep(key, value)
        return value

    def keep(self, key: str, value) -> None:
        if len(key) <= 64:
            if len(self.young) >= WORDS_KEPT:
                self.old = dict(self.young)
                self.young.clear()  # in place: callers hold its methods
            self.young[key] = value


class Encoder:
    """An automaton with the text rules around it, and bounded memories of what it has encoded and decoded.

    No word of the pattern holds white space, so a text is cut there first and a piece that was met before is looked up
    with its ids and their labels as a whole.
    """

    def __init__(self, automaton: Automaton):
        self.a = automaton
        self.words = regex.compile(automaton.pattern).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, automaton.special)) + ")") if automaton.special else None
        self.plain = [automaton.symbol[s] for s in byte_symbols()]
        self.last = [automaton.symbol[s + automaton.suffix] for s in byte_symbols()]
        self.known, self.pieces = _Memory(), _Memory()

    def _word(self, w: str) -> tuple[bytes, str]:
        b = w.encode("utf-8")
        symbols = [self.plain[x] for x in b]
        symbols[-1] = self.last[b[-1]]
        tokens = self.a.word(symbols)
        if len(self.a.arcs) >= ARCS_KEPT:
            self.a.arcs.clear()
        both = _packer(len(tokens))(*tokens), " ".join([self.a.labels[t] for t in tokens])
        self.known.keep(w, both)
        return both

    def _piece(self, piece: str) -> tuple[bytes, str]:
        known = self.pieces.older(piece)
        if known is None:
            get, older, new = self.known.young.get, self.known.older, self._word
            found = [get(w) or older(w) or new(w) for w in self.words(piece)]
            known = found[0] if len(found) == 1 else (b"".join([i for i, _ in found]), " ".join([t for _, t in found]))
            self.pieces.keep(piece, known)
        return known

    def _plain(self, text: str) -> list[tuple[bytes, str]]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # letters are lowered one by one
        text = text.lower()
        if any(c in text for c in _CUT_ONLY_HERE):
            return [self._piece(text)]
        get, new = self.pieces.young.get, self._piece
        return [get(w) or new(w) for w in text.split()]

    def both(self, text: str) -> tuple[bytes, str]:
        """The ids, as little-endian unsigned 32-bit integers, and what they decode to."""
        if not any(s in text for s in self.a.special):
            found = self._plain(text)
        else:
            found = []
            for k, p in enumerate(self.special.split(text)):
                if k % 2:
                    ids = np.uint32(self.a.special[p]).tobytes()
                    found.append((ids, self.decode(ids)))
                else:
                    found += self._plain(p)
        return b"".join([ids for ids, _ in found]), " ".join([label for ids, label in found if ids])

    def encode(self, text: str) -> bytes:
        return self.both(text)[0]

    def decode(self, ids: bytes) -> str:
        label = self.a.labels.__getitem__
        return " ".join(map(label, np.frombuffer(ids, "<u4").tolist()))


_ENCODERS: dict[str, Encoder] = {}


def _encoder(table, key: str) -> Encoder:
    """One encoder for all tasks of a call in a Python worker."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(table.value)
    return _ENCODERS[key]


def bpe(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Returns (doc_id, n_tokens, ids_sha256, decoded_sha256) of each row, and with keep_ids the ids and decoded text."""
    table, key = docs.sparkSession.sparkContext.broadcast(compile_automaton(path)), uuid.uuid4().hex

    def run(batches):
        e = _encoder(table, key)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                found = [e.both(t.as_py() or "") for t in part.column(1)]
                ids, texts = [i for i, _ in found], [t for _, t in found]
                cols = [
                    part.column(0),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
                ]
                if keep_ids:
                    cols += [pa.array(ids, pa.binary()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["d", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: len(cols)])

    schema = "d long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids binary, decoded string" if keep_ids else "")
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("d", id_col)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_bpe_automaton(spark, sf_dir):
    """Registered query: every whole text of documents, with the 49k vocabulary of words."""
    return bpe(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_path(), keep_ids=False)
