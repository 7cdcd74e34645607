"""BPE encoding and decoding with a tokenization automaton.

The automaton reads token labels; a path from the start spells exactly one text
and is accepted exactly if it is the tokenization that the ordered merges give.
It starts as one state with a loop for every base symbol.  For each merge
(u, v) -> w, in order, the merge gadget

* splits the state that u-arcs lead to: the new copy, reached by u only, loses
  its v-arc (u followed by v is no longer a tokenization);
* adds a w-arc beside every u-arc that is left; it leads where v-arcs lead.

All arcs of one label lead to one state, so a state is named by the label that
leads to it.  A state inherits the arcs of the state that it was split from, and
a w-arc stands wherever its u-arc stood when w was made.  The automaton is
therefore kept as what each gadget changed (the split and the cut arc with its
time) and an arc (label, next) is resolved over those records once, then read
from the transition table.

Encoding walks pre-split words through the table, longest arc first; a text
position from which no accepted path goes on is left and not tried again (each
prefix has one accepted path, so this is linear in arcs).  Decoding emits the
arc labels of the ids.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from segflow.llm.common import arrow_map, texts, worker_models

END = "</w>"
CACHED_WORDS = 600_000     # words kept per Python worker
CACHED_LENGTH = 64         # longer words are encoded anew each time
TABLE_ARCS = 1_000_000     # resolved arcs kept per Python worker
NEVER = 1 << 30


def _byte_alphabet() -> list[str]:
    """Printable stand-ins of the 256 bytes: visible Latin-1 stands for itself,
    the others follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    table = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


def _unsettled() -> str:
    """Regex class of the code points that are no characters yet for unicodedata
    but letters or numbers for the regex module: Unicode versions differ there."""
    import regex

    known = regex.compile(r"[\p{L}\p{N}]").match
    new = [c for c in range(0x300, 0x110000) if unicodedata.category(chr(c)) == "Cn" and known(chr(c))]
    return "[" + "".join(f"\\U{c:08x}" if i and new[i - 1] != c - 1 or not i else
                         ("" if i + 1 < len(new) and new[i + 1] == c + 1 else f"-\\U{c:08x}")
                         for i, c in enumerate(new)) + "]"


class TokenizationAutomaton:
    """Compiled merges: transitions, word encoding and decoding."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.label = {i: s for s, i in vocab.items()}
        self.made: dict[int, int] = {}                  # label -> time of its gadget
        self.halves: dict[int, tuple[int, int]] = {}    # label -> (u, v)
        self.cut: dict[tuple[int, int], int] = {}       # (u, v) -> time the v-arc after u went
        self.table: dict[int, bool] = {}
        live = {s: i for s, i in vocab.items() if len(s) == 1 or (s.endswith(END) and len(s) == 1 + len(END))}
        for time, (a, b) in enumerate(merges):
            u, v = vocab[a], vocab[b]
            if a not in live or b not in live or not self._arc(u, v):
                continue                                # this merge can never apply
            w = vocab[a + b]
            self.cut[u, v] = time
            self.made[w], self.halves[w] = time, (u, v)
            live[a + b] = w
        self.table.clear()
        self.inner = {s: i for s, i in live.items() if not s.endswith(END)}
        self.final = {s[: -len(END)]: i for s, i in live.items() if s.endswith(END)}
        self.longest = max(map(len, [*self.inner, *self.final]))

    def _arc(self, t: int, x: int) -> bool:
        """Whether the state reached by t has an x-arc, from the gadgets' records.

        The state of t goes back over t's right halves (each up to the time the
        next larger one was made), the arc x over its left halves.  A cut kills
        the arc if it fell while both stood for this state and this arc.
        """
        spine, until = [], NEVER
        y = x
        while True:
            spine.append((y, until))
            if y not in self.halves:
                break
            until, y = self.made[y], self.halves[y][0]
        r, until = t, NEVER
        while True:
            for y, most in spine:
                time = self.cut.get((r, y))
                if time is not None and time < until and time <= most:
                    return False
            if r not in self.halves:
                return True
            until, r = self.made[r], self.halves[r][1]

    def step(self, t: int, x: int) -> bool:
        """Transition table look-up; an arc not asked for before is resolved."""
        key = t << 32 | x
        known = self.table.get(key)
        if known is None:
            if len(self.table) >= TABLE_ARCS:
                self.table.clear()
            known = self.table[key] = self._arc(t, x)
        return known

    def encode_word(self, s: str) -> list[int]:
        """Ids of one pre-split word given in the byte alphabet."""
        n, pos, prev, dead = len(s), 0, -1, set()
        path: list[tuple[int, int]] = []
        inner, final, step, longest = self.inner.get, self.final.get, self.step, self.longest
        j = min(n, longest)
        while pos < n:
            while j > pos:
                if j not in dead:
                    x = final(s[pos:]) if j == n else inner(s[pos:j])
                    if x is not None and (prev < 0 or step(prev, x)):
                        break
                j -= 1
            if j > pos:
                path.append((pos, x))
                pos, prev = j, x
                j = min(n, pos + longest)
            elif path:
                dead.add(pos)
                j = pos - 1
                pos, _ = path.pop()
                prev = path[-1][1] if path else -1
            else:
                raise ValueError(f"no token path spells {s[:50]!r}")
        return [x for _, x in path]


class WordBpe:
    """Encoder and decoder for a word-level BPE file (lower-case, end-of-word marks).

    The file's normaliser, split pattern and special tokens are followed as its
    own library does by default: special strings inside texts become their ids.
    """

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END:
            raise ValueError("not a BPE file with end-of-word marks")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = TokenizationAutomaton(model["vocab"], merges)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.find = regex.compile(split["pattern"]["Regex"]).findall
        # Characters on which Unicode versions differ: a text that holds one is
        # pre-split by the file's own library.
        unsettled = _unsettled()
        self.late = re.compile("[\u0530-\U0010ffff]").search
        self.unsettled = re.compile(unsettled).search
        self.path, self.library = path, None
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
        label = self.automaton.label | {i: s for s, i in self.special.items()}
        self.labels = [label.get(i, "") for i in range(max(label) + 1)]
        self.alphabet = _byte_alphabet()
        self.cache: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        s = "".join(map(self.alphabet.__getitem__, word.encode("utf-8")))
        return np.array(self.automaton.encode_word(s), "<u4").tobytes()

    def _by_library(self, text: str) -> bytes:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return b"".join(np.array(self.automaton.encode_word(w), "<u4").tobytes() for w, _ in words)

    def _plain(self, text: str) -> bytes:
        if not text.isascii() and self.late(text) and self.unsettled(text):
            return self._by_library(text)
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # White space of any kind only divides words, so it need not be unified
        # first.  Letter by letter, as the file's library does: no final-sigma rule.
        text = text.replace("Σ", "σ").lower()
        words = self.find(text)
        cache = self.cache
        try:
            return b"".join(map(cache.__getitem__, words))
        except KeyError:
            pass
        if len(cache) > CACHED_WORDS:
            cache.clear()
        fresh = {}
        for w in words:
            if w not in cache and w not in fresh:
                known = self._word(w)
                (cache if len(w) <= CACHED_LENGTH and len(cache) <= CACHED_WORDS else fresh)[w] = known
        return b"".join([cache[w] if w in cache else fresh[w] for w in words])

    def encode_bytes(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if "<|" not in text:
            return self._plain(text)
        return b"".join(np.uint32(self.special[p]).tobytes() if p in self.special else self._plain(p)
                        for p in self.cut_special(text))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """Arc labels in order; the file names no decoder, so a space joins them."""
        return " ".join(map(self.labels.__getitem__, ids))


def word_bpe(path: str) -> WordBpe:
    models = worker_models("bpe")
    if path not in models:
        models[path] = WordBpe(path)
    return models[path]


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    With `with_ids` also ids (array of int), with `with_text` decoded (string).
    Defined cases: null text counts as empty (no ids, empty decoded text); repeated rows
    are encoded each; a null id is passed on; whole texts of any length are
    encoded, never cut; an empty table gives no rows; extra columns are not
    read.  No shuffle; the word cache and the transition table are bounded.
    """
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for b in batches:
            n, ids_sha, out_sha, all_ids, all_out = [], [], [], [np.zeros(0, "<u4")], []
            for value in b.column("text"):
                raw = bpe.encode_bytes(value.as_py())
                ids = np.frombuffer(raw, "<u4").tolist()
                out = bpe.decode(ids)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(raw).hexdigest())
                out_sha.append(hashlib.sha256(out.encode("utf-8")).hexdigest())
                if with_ids:
                    all_ids.append(np.frombuffer(raw, "<u4"))
                if with_text:
                    all_out.append(out)
            cols = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                    pa.array(out_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                offs = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate(all_ids).astype(np.int32))))
                names.append("ids")
            if with_text:
                cols.append(pa.array(all_out, pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_map(
        texts(docs, id_col, text_col), "bpe", run,
        schema + ", ids array<int>" * with_ids + ", decoded string" * with_text)
