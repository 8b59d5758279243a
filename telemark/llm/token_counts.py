"""Token counts by batch encoding in Arrow functions that return lengths only.

Each Arrow batch is cut into segments, segments into batches of about equal bytes,
and only the lengths of the encodings leave the function. A long text is split at
safe boundaries: a single blank between two other characters. No piece of the
vocabulary holds its word-start mark behind another character (checked when the
model is loaded), so no piece reaches over such a blank, and the parts have as many
tokens together as the whole. A text without safe boundary is encoded whole.

Null and empty texts have 0 bytes and 0 tokens. Repeated rows are counted each.
Other columns are not read; columns of the same name as a result are replaced.
"""
from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
SPLIT_CHARS = 1000       # a long text is split at the first safe boundary after so many characters
BATCH_BYTES = 1 << 18    # one call of the encoder gets about so many bytes
# One part: so many characters and more, up to a safe boundary or the end.
_SAFE = rf"(?<=[^ {MARK}]) (?=[^ {MARK}])"


@functools.lru_cache(maxsize=2)
def _load(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.vocab_size()))
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError(f"{path}: pieces reach over word starts, texts cannot be split")
    for probe in ("a  b", "a b ", " a b", "a\nb c"):
        parts = split_text(probe, 1)
        if len(model.encode(probe)) != sum(len(model.encode(p)) for p in parts):
            raise ValueError(f"{path}: the model changes blanks, texts cannot be split")
    return model


@functools.lru_cache(maxsize=8)
def _part(size: int):
    return re.compile(rf".{{{size}}}.*?{_SAFE}", re.S)


def split_text(text: str, size: int = SPLIT_CHARS) -> list[str]:
    """Parts of a text that together have its tokens; the blank at a cut is dropped,
    as the encoder puts one before every text."""
    if len(text) <= size:
        return [text]
    parts, at, pattern = [], 0, _part(size)
    while found := pattern.match(text, at):
        parts.append(text[at: found.end() - 1])
        at = found.end()
    parts.append(text[at:])
    return parts


def _lengths(model, texts: list[str | None]) -> list[int]:
    counts = [0] * len(texts)
    batch: list[str] = []
    owner: list[int] = []
    size = 0

    def flush():
        nonlocal size
        for row, ids in zip(owner, model.encode(batch, num_threads=1)):
            counts[row] += len(ids)
        batch.clear(), owner.clear()
        size = 0

    for row, text in enumerate(texts):
        for part in split_text(text) if text else ():
            batch.append(part)
            owner.append(row)
            size += len(part.encode())
            if size >= BATCH_BYTES:
                flush()
    if batch:
        flush()
    return counts


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """One row per row of `docs`: id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _load(model_path)
        for batch in batches:
            counts = _lengths(model, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())],
                ["id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"),
                       text.alias("body"))
    kind = slim.schema["id"].dataType.simpleString()
    counted = slim.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
