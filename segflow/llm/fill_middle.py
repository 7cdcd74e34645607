"""Fill-in-middle transformation: rank and select of code points by SWAR words.

A batch's UTF-8 bytes are viewed as 64-bit words.  The byte after each byte is laid
beside it by one shift, and the continuation bytes (10xxxxxx) among these are found
for all eight at once; a byte whose next one is none of them ends a code point and
is marked by its top bit.  `bitwise_count` of the marks, summed over the words, gives
the code points before any byte; the k-th code point's word is found by binary search
in these sums, and its byte inside the word by a multiplication that adds up the
marks byte by byte.  No text is decoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segflow.llm.common import arrow_map, sha_hex, texts

CHUNK_BYTES = 4 << 20
U = np.uint64
_TOP, _ONES = U(0x8080808080808080), U(0x0101010101010101)

# Sentinels of the prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class Units:
    """Code points of one byte buffer that holds whole UTF-8 texts end to end."""

    def __init__(self, data: np.ndarray):
        words = np.zeros(len(data) // 8 + 2, U)
        words.view(np.uint8)[: len(data)] = data
        following = (words[:-1] >> U(8)) | (words[1:] << U(56))
        inside = following & ~(following << U(1)) & _TOP       # the next byte is 10xxxxxx
        self.marks = ~inside & _TOP
        self.sums = np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Code points that end before byte offset `at`."""
        word, rest = at >> 3, (at & 7).astype(U)
        below = (U(1) << (rest * U(8))) - U(1)
        before = np.where(word > 0, self.sums[np.maximum(word - 1, 0)], 0)
        return before + np.bitwise_count(self.marks[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Byte offset just behind the k-th code point (1-based); 0 for k = 0."""
        word = np.searchsorted(self.sums, k)
        inner = k - np.where(word > 0, self.sums[np.maximum(word - 1, 0)], 0)
        upto = (self.marks[word] >> U(7)) * _ONES              # marks up to each byte
        need = np.maximum(inner, 1).astype(U) * _ONES
        earlier = np.bitwise_count(((need - _ONES) | _TOP) - upto & _TOP)
        return np.where(k > 0, word * 8 + earlier + 1, 0)


def _forms(b: pa.RecordBatch, n: np.ndarray, col: pa.Array, plain_from: int, spm_below: int) -> np.ndarray:
    """0 plain, 1 psm, 2 spm."""
    marked = np.zeros(len(n), bool)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        marked |= pc.match_substring(col, sentinel).to_numpy(zero_copy_only=False)
    h3, h4 = (b.column(c).to_numpy() for c in ("h3", "h4"))
    plain = (n == 0) | marked | (h3 % 100 >= plain_from)
    return np.where(plain, 0, np.where(h4 % 100 < spm_below, 2, 1))


def _chunk(b: pa.RecordBatch, plain_from: int, spm_below: int) -> pa.RecordBatch:
    col = b.column("text").cast(pa.large_string())
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, np.int64, len(col) + 1, col.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    raw, offs = raw[offs[0]: offs[-1]], offs - offs[0]
    units = Units(raw)
    begun = units.rank(offs)
    n = np.diff(begun)
    form = _forms(b, n, col, plain_from, spm_below)
    cuts = np.sort(np.stack([b.column("h1").to_numpy() % (n + 1), b.column("h2").to_numpy() % (n + 1)]), axis=0)
    first, second = (np.where(c > 0, units.select(begun[:-1] + c), offs[:-1]) for c in cuts)
    view, out = raw.tobytes(), []
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    for a, x, y, z, f in zip(offs[:-1].tolist(), first.tolist(), second.tolist(), offs[1:].tolist(), form.tolist()):
        if f == 0:
            out.append(view[a:z])
        elif f == 1:
            out.append(b"".join((p, view[a:x], s, view[y:z], m, view[x:y])))
        else:
            out.append(b"".join((s, view[y:z], p, view[a:x], m, view[x:y])))
    plain = form == 0
    return pa.RecordBatch.from_arrays(
        [b.column("doc_id"), pa.array(n), pa.array(np.array(["plain", "psm", "spm"])[form], pa.string()),
         pa.array(cuts[0], mask=plain), pa.array(cuts[1] - cuts[0], mask=plain), pa.array(out, pa.string())],
        names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def _slices(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about CHUNK_BYTES of text; a longer text is one by itself."""
    sizes = np.cumsum(pc.binary_length(b.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < b.num_rows:
        done = sizes[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sizes, done + CHUNK_BYTES, "right")))
        yield b.slice(lo, hi - lo)
        lo = hi


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salt: str = "1",
                   plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """One row per document: doc_id, n (code points), form, prefix_chars, middle_chars, output.

    The two cuts and the form follow the SHA-256 of `salt`:doc_id alone, so a rerun
    or a lost task gives the same rows.  psm is <P>prefix<S>suffix<M>middle, spm
    <S>suffix<P>prefix<M>middle; `plain_percent` of the texts stay as they are, and so
    do empty texts and those that hold a sentinel.  Defined cases: null text counts as
    empty; a null id hashes as an empty one; repeated rows get the same cuts; a text is
    never divided, whatever its length; an empty table gives no rows; extra columns are
    not read.  No shuffle.
    """
    src = texts(docs, id_col, text_col)
    digest = sha_hex(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    heads = [F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = src.withColumn("digest", digest).select("doc_id", "text", *heads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _slices(b):
                yield _chunk(part, 100 - plain_percent, spm_percent)

    return arrow_map(rows, "fill_in_middle", run,
                     "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of.

    A text in psm or spm form holds no sentinel, and none can arise across a seam
    (each begins with < and ends with >), so the parts are cut at them.
    """
    def parts(second: str) -> tuple[Column, Column, Column]:
        head, middle = (F.split_part(output, F.lit(MIDDLE), F.lit(k)) for k in (1, 2))
        one, two = (F.split_part(head, F.lit(second), F.lit(k)) for k in (1, 2))
        return F.substr(one, F.lit(len(PREFIX) + 1)), two, middle

    prefix, suffix, middle = parts(SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(PREFIX)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
