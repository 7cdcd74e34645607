"""Token counts: batch encoding inside Arrow functions, only lengths come back.

Texts of an Arrow batch are cut into pieces at safe boundaries, pieces are
packed into groups of about equal bytes, every group is encoded in one library
call, and the piece lengths are summed per text.

Safe boundary: a single space (dropped) whose left neighbour is a letter or
digit.  The model writes a space as U+2581 and puts one before every text, so a
piece that starts after the dropped space begins with the same symbol as before.
No vocabulary entry holds U+2581 after another character (checked when the model
is loaded; otherwise texts are never cut), so no token spans the boundary.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.llm.common import arrow_map, texts, worker_models

MARK = "▁"
PIECE_CHARS = 20_000       # texts longer than this are cut
GROUP_BYTES = 400_000      # bytes handed to the library at once

def _model(path: str):
    models = worker_models("pieces")
    if path not in models:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        clean = all(MARK not in m.id_to_piece(i).lstrip(MARK) for i in range(m.get_piece_size()))
        # Cutting also relies on white space reaching the model unchanged.
        plain = m.encode(f"a  b {MARK}c\n d", out_type=str) and m.decode(m.encode("a  b\n c")) == "a  b\n c"
        models[path] = (m, bool(clean and plain))
    return models[path]


def safe_pieces(text: str, size: int = PIECE_CHARS) -> list[str]:
    """Cut `text` at safe boundaries into pieces of about `size` characters.

    The dropped spaces are the ones the model adds back before each piece.  A
    text with no safe boundary stays whole.
    """
    out, at, n = [], 0, len(text)
    while n - at > size:
        k = text.find(" ", at + size)
        while k != -1 and not (text[k - 1].isascii() and text[k - 1].isalnum() and k + 1 < n):
            k = text.find(" ", k + 1)
        if k == -1:
            break
        out.append(text[at:k])
        at = k + 1
    out.append(text[at:])
    return out


def count_tokens(values: list[str], sizes: list[int], path: str) -> list[int]:
    """Tokens of each text, as the library gives for the whole text; sizes: their bytes."""
    model, may_cut = _model(path)
    counts = [0] * len(values)
    group, owners, held = [], [], 0

    def flush() -> None:
        nonlocal held
        if group:
            for i, ids in zip(owners, model.encode(group, num_threads=1)):
                counts[i] += len(ids)
        group.clear()
        owners.clear()
        held = 0

    for i, (text, size) in enumerate(zip(values, sizes)):
        pieces = safe_pieces(text) if may_cut else [text]
        for piece in pieces:
            group.append(piece)
            owners.append(i)
            held += size if len(pieces) == 1 else len(piece.encode())
            if held >= GROUP_BYTES:
                flush()
    flush()
    return counts


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    Defined cases: null text counts as empty (0 bytes, 0 tokens); repeated rows
    are counted each; a null id is passed on; very long texts are cut only at
    safe boundaries and never truncated; an empty table gives no rows; extra
    columns are not read.  No shuffle.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = count_tokens(b.column("text").to_pylist(), b.column("n_bytes").to_pylist(), model_path)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_bytes"), pa.array(n, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    src = texts(docs, id_col, text_col).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    out = arrow_map(src, "pieces", encode, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
