"""Alignment of two tokenizers' tokens by their common byte boundaries, in Arrow.

Texts are encoded by A (byte-level pairs; a space is put before the text) and B (pieces,
which puts the space itself). Both token lists are flattened; each token keeps its parent
row, and segmented running sums of token bytes give its end within the document. A hash
join of both sides on (document, end) finds the ends that A and B share; they cut the
tokens into groups. Every A token of a group is linked with every B token of it.

Distribution. A task cuts its rows into shards of bounded bytes. Inside a shard the links
are tallied by Table.group_by: per (document, a, b), and from that per (a, b) the documents
that hold the pair. Only these partial counts go to Spark, which sums them over all shards.
The totals return to a shard for its own distinct pairs, once per shard and not per
document, and each document then reads its pairs' totals there. No key gathers rows: the
shuffles hold one row per pair and shard, and partial sums are taken before them. Totals and
shards meet as a cogroup, one shard at a time, and the shards' table has small row groups, so
memory does not grow with the shards of a task or file.

Encoding. Texts are cut into units at single blanks between two characters that are neither
blank nor the word mark, where neither tokenizer has a token reaching over (for B checked
when it is loaded; A starts a new word there). A task encodes each unit once, in batches of
bounded bytes, and forgets all when its store is full. Links are made in slices of at most
SLICE_LINKS, so a group with many tokens on both sides is never expanded at once; what stays
is one row per distinct pair of a document.

Null and empty texts, and those whose joined token bytes differ from space+text (a text that
holds U+2581, or characters the model changes), have no tokens: zeros and an empty digest.
Special tokens' strings inside texts are plain text. Repeated rows and rows that share an id
are rows of their own, and each counts as a document. A null id is kept. Other columns are
not read; columns of the same name as a result do not matter.
"""
from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemark.llm import bytewords as BW
from telemark.llm.tables import stored
from telemark.llm.token_counts import MARK, _load
from telemark.operators.joins import attach

SHARD_BYTES = 1 << 20    # text bytes tallied together
ENCODE_BYTES = 1 << 16   # text in one call of an encoder
CACHE_BYTES = 1 << 22    # unit text whose encodings are kept
SLICE_LINKS = 1 << 22    # links expanded at once
GROUP_SHARDS = 8         # shards in a row group of their table, which a task decodes at once
_SAFE = re.compile(rf"(?<=[^\s{MARK}]) (?=[^\s{MARK}])")
_HEX = re.compile(r"<0x([0-9A-F]{2})>\Z")


# -- vocabularies --------------------------------------------------------------------------

def byte_level() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the other bytes for characters from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


@functools.lru_cache(maxsize=2)
def _model_a(path: str):
    """(encoder, bytes of each id)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    model.no_truncation()
    model.no_padding()
    table, known = byte_level(), model.get_vocab(with_added_tokens=True)
    entries = [b""] * (max(known.values()) + 1)
    for token, i in known.items():
        entries[i] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
    return model, pa.array(entries, pa.large_binary())


@functools.lru_cache(maxsize=2)
def _model_b(path: str):
    model = _load(path)
    entries = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        found = _HEX.match(piece) if model.is_byte(i) else None
        entries.append(bytes([int(found[1], 16)]) if found else piece.replace(MARK, " ").encode())
    return model, pa.array(entries, pa.large_binary())


def units_of(text: str) -> list[str]:
    """Parts whose encodings together are that of the text; the blank at a cut is dropped,
    as a space comes before every part again."""
    return _SAFE.split(text)


def _flat(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.array(list(chain.from_iterable(found)), dtype=np.int32), np.array([len(x) for x in found], dtype=np.int64)


class Units:
    """Token ids of text units under both tokenizers; what has been encoded is kept, up to
    CACHE_BYTES of unit text, and then forgotten."""

    def __init__(self, path_a: str, path_b: str):
        (self.a, entries), self.b = _model_a(path_a), _model_b(path_b)[0]
        self.sizes = pc.binary_length(entries).to_numpy()
        self.known: dict[str, int] = {}
        self.size = 0
        self._forget()

    def _forget(self) -> None:
        self.known.clear()
        self.size = 0
        self.ids = [[np.zeros(0, np.int32)], [np.zeros(0, np.int32)]]
        self.lengths = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]

    def _learn(self, fresh: list[str]) -> None:
        begin = 0
        while begin < len(fresh):
            end, size = begin, 0
            while end < len(fresh) and size < ENCODE_BYTES:
                size += len(fresh[end])
                end += 1
            batch = fresh[begin: end]
            for side, (ids, lengths) in enumerate((self._encode_a(batch), _flat(self.b.encode(batch, num_threads=1)))):
                self.ids[side].append(ids)
                self.lengths[side].append(lengths)
            self.size += size
            begin = end

    def _encode_a(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units, tokens of each). Units are encoded as one text with blanks between,
        which has their tokens, and cut apart by bytes; if the bytes do not fit, one by one."""
        spaced = [" " + u for u in batch]
        ids, _ = _flat([e.ids for e in self.a.encode_batch(["".join(spaced)], add_special_tokens=False)])
        ends = np.cumsum(self.sizes[ids])
        wanted = np.cumsum([len(u.encode()) for u in spaced])
        place = np.searchsorted(ends, wanted)
        if len(ends) and ends[-1] == wanted[-1] and (ends[place] == wanted).all():
            return ids, np.diff(place, prepend=-1)
        return _flat([e.ids for e in self.a.encode_batch(spaced, add_special_tokens=False)])

    def encode(self, texts: list[str | None]) -> tuple[pa.ListArray, pa.ListArray]:
        if self.size > CACHE_BYTES:
            self._forget()
        parts = [units_of(t) if t else [] for t in texts]
        known, fresh, place = self.known, [], []
        for units in parts:
            for u in units:
                at = known.get(u)
                if at is None:
                    at = known[u] = len(known)
                    fresh.append(u)
                place.append(at)
        self._learn(fresh)
        row = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
        at = np.array(place, dtype=np.int64)
        out = []
        for side in (0, 1):
            for store in (self.ids, self.lengths):
                store[side] = [np.concatenate(store[side])]
            lengths = self.lengths[side][0]
            begin = np.cumsum(lengths) - lengths
            n = lengths[at]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            ids = self.ids[side][0][np.repeat(begin[at], n) + inside]
            count = np.bincount(row, weights=n, minlength=len(texts)).astype(np.int64)
            cuts = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
            out.append(pa.ListArray.from_arrays(pa.array(cuts), pa.array(ids)))
        return out[0], out[1]


@functools.lru_cache(maxsize=1)
def _units(path_a: str, path_b: str) -> Units:
    return Units(path_a, path_b)


def encoded(texts: list[str | None], path_a: str, path_b: str) -> tuple[pa.ListArray, pa.ListArray]:
    """Token ids of both tokenizers, a list per text."""
    return _units(path_a, path_b).encode(texts)


# -- one shard, in Arrow -------------------------------------------------------------------

def _ends(tokens: pa.ListArray, entries: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(bytes of every token, its end within its document): the running sum of the lengths
    less what came before the document."""
    bodies = entries.take(tokens.flatten())
    total = pc.cumulative_sum(pc.cast(pc.binary_length(bodies), pa.int64())).to_numpy(zero_copy_only=False)
    parents = pc.list_parent_indices(tokens).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], total])[tokens.offsets.to_numpy()[:-1]]
    return bodies, total - before[parents]


def _joined(bodies: pa.Array, tokens: pa.ListArray) -> list[memoryview]:
    """The bytes of each document's tokens, one after another."""
    bodies = bodies.combine_chunks() if isinstance(bodies, pa.ChunkedArray) else bodies
    _, offsets, data = bodies.buffers()
    at = np.frombuffer(offsets, np.int64)[: len(bodies) + 1] if len(bodies) else np.zeros(1, np.int64)
    view = memoryview(data).cast("B") if data is not None else memoryview(b"")
    cut = at[tokens.offsets.to_numpy()].tolist()
    return [view[x: y] for x, y in zip(cut[:-1], cut[1:])]


@dataclass
class Shard:
    """Per document: token and group counts, links, the groups in writing. Per (document, a, b):
    `pairs` with columns doc, a, b, times."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    pairs: pa.Table


def _lists(cuts: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values)


def align(texts: list[str | None], path_a: str, path_b: str) -> Shard:
    tok_a, tok_b = encoded(texts, path_a, path_b)
    bytes_a, bytes_b = _model_a(path_a)[1], _model_b(path_b)[1]
    one, two = _joined(_ends(tok_a, bytes_a)[0], tok_a), _joined(_ends(tok_b, bytes_b)[0], tok_b)
    whole = [(" " + t).encode() if t else b"" for t in texts]
    good = np.array([x == w and y == w for x, y, w in zip(one, two, whole)], dtype=bool)
    if not good.all():   # their tokens do not count
        tok_a, tok_b = (pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(np.diff(t.offsets.to_numpy()) * good)]).astype(np.int32)),
            t.flatten().filter(pa.array(np.repeat(good, np.diff(t.offsets.to_numpy()))))) for t in (tok_a, tok_b))
    side = {}
    for name, tokens, entries in (("a", tok_a, bytes_a), ("b", tok_b, bytes_b)):
        parent = pc.cast(pc.list_parent_indices(tokens), pa.int64())
        end = pa.array(_ends(tokens, entries)[1], pa.int64())
        side[name] = pa.table({"doc": parent, "end": end, "row": pa.array(np.arange(len(end))), name: tokens.flatten()})
    shared = side["a"].select(["doc", "end", "row"]).join(
        side["b"].select(["doc", "end", "row"]), ["doc", "end"], join_type="inner", right_suffix="_b")
    cut_a, cut_b = (np.zeros(len(side[x]), dtype=np.int64) for x in "ab")
    cut_a[shared["row"].to_numpy()] = 1
    cut_b[shared["row_b"].to_numpy()] = 1
    # A document's last ends are shared, so groups never reach over documents.
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    groups = int(cut_a.sum())
    per_a, per_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    doc_of = side["a"]["doc"].to_numpy()[np.flatnonzero(cut_a)]
    n = len(texts)
    n_groups = np.bincount(doc_of, minlength=n)
    n_links = np.zeros(n, dtype=np.int64)
    np.add.at(n_links, doc_of, per_a * per_b)
    return Shard(np.diff(tok_a.offsets.to_numpy()).astype(np.int64), np.diff(tok_b.offsets.to_numpy()).astype(np.int64),
                 n_groups.astype(np.int64), n_links, _written(tok_a, tok_b, per_a, per_b, n_groups),
                 _tally(side["a"]["a"], side["b"]["b"], group_a, group_b, doc_of))


def _written(tok_a: pa.ListArray, tok_b: pa.ListArray, per_a: np.ndarray, per_b: np.ndarray, n_groups: np.ndarray) -> list[str]:
    """`a1,a2|b1;a3|b2,b3` of each document."""
    texts = [pc.binary_join(_lists(np.concatenate([[0], np.cumsum(per)]), pc.cast(tokens.flatten(), pa.string())), ",")
             for tokens, per in ((tok_a, per_a), (tok_b, per_b))]
    both = pc.binary_join_element_wise(*texts, "|")
    return pc.binary_join(_lists(np.concatenate([[0], np.cumsum(n_groups)]), both), ";").to_pylist()


def _tally(ids_a: pa.ChunkedArray, ids_b: pa.ChunkedArray, group_a: np.ndarray, group_b: np.ndarray, doc_of: np.ndarray) -> pa.Table:
    """(doc, a, b, times): how often each pair of ids is linked in each document."""
    one = pa.table({"group": group_a, "a": ids_a}).group_by(["group", "a"]).aggregate([([], "count_all")]).rename_columns(["group", "a", "x"])
    two = pa.table({"group": group_b, "b": ids_b}).group_by(["group", "b"]).aggregate([([], "count_all")]).rename_columns(["group", "b", "y"])
    one, two = one.sort_by("group"), two.sort_by("group")
    wide = np.bincount(two["group"].to_numpy(), minlength=len(doc_of))
    reach = np.cumsum(wide[one["group"].to_numpy()])
    first_b = np.searchsorted(two["group"].to_numpy(), np.arange(len(doc_of) + 1))
    parts, begin = [], 0
    while begin < len(one):
        done = int(reach[begin - 1]) if begin else 0
        end = max(int(np.searchsorted(reach, done + SLICE_LINKS, "right")), begin + 1)
        some = one.slice(begin, end - begin)
        low, high = int(some["group"][0].as_py()), int(some["group"][-1].as_py())
        met = some.join(two.slice(first_b[low], first_b[high + 1] - first_b[low]), "group", join_type="inner")
        met = pa.table({"doc": pa.array(doc_of[met["group"].to_numpy()]), "a": met["a"], "b": met["b"],
                        "times": pc.multiply(met["x"], met["y"])})
        parts.append(met.group_by(["doc", "a", "b"]).aggregate([("times", "sum")]))
        begin = end
    if not parts:
        return pa.table({"doc": pa.array([], pa.int64()), "a": pa.array([], pa.int32()), "b": pa.array([], pa.int32()), "times": pa.array([], pa.int64())})
    every = pa.concat_tables(parts).rename_columns(["doc", "a", "b", "times"])
    return every if len(parts) == 1 else every.group_by(["doc", "a", "b"]).aggregate([("times", "sum")]).rename_columns(["doc", "a", "b", "times"])


def _packed(found: Shard) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The shard's distinct pairs (a, b, documents), and per document its pairs as numbers
    of these with their times; bounds per document."""
    pairs = found.pairs
    code = (pairs["a"].to_numpy().astype(np.int64) << 32) | pairs["b"].to_numpy().astype(np.int64)
    known, number, docs = np.unique(code, return_inverse=True, return_counts=True)
    doc = pairs["doc"].to_numpy()
    order = np.argsort(doc, kind="stable")
    bounds = np.searchsorted(doc[order], np.arange(len(found.n_a) + 1))
    return known >> 32, known & 0xFFFFFFFF, docs, number[order], pairs["times"].to_numpy()[order], bounds


# -- Spark ---------------------------------------------------------------------------------

_SHARD = ("shard string, stats array<struct<id: {kind}, n_a: long, n_b: long, n_groups: long, n_links: long, groups_sha256: string>>, "
          "a array<int>, b array<int>, docs array<int>, bounds array<int>, pair array<int>, times array<int>")


def _list(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values.astype(np.int32)))


def shard_table(docs: DataFrame, path_a: str, path_b: str, digest=None) -> DataFrame:
    """One row per shard of `docs` (id, text): its documents' figures and its tallied pairs.
    `groups_sha256` holds digest(groups) if a digest is given, else the groups themselves."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for part in BW.shards(batches, "text", SHARD_BYTES):
            found = align(part.column(1).to_pylist(), path_a, path_b)
            a, b, seen, pair, times, bounds = _packed(found)
            written = [(digest(g) if digest else g) if x else "" for g, x in zip(found.groups, found.n_a)]
            stats = pa.StructArray.from_arrays(
                [part.column(0), *map(pa.array, (found.n_a, found.n_b, found.n_groups, found.n_links)), pa.array(written, pa.string())],
                ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{TaskContext.get().partitionId()}-{number}"]),
                 pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), stats),
                 *map(_list, (a, b, seen, bounds, pair, times))],
                ["shard", "stats", "a", "b", "docs", "bounds", "pair", "times"])
            number += 1

    return docs.mapInArrow(run, _SHARD.format(kind=kind))


def pair_counts(shards: DataFrame) -> DataFrame:
    """(a, b, held, best): in how many documents each linked pair of ids occurs, and whether
    that is the most of its A id. The partial counts of the shards are summed."""
    found = stored(shards.select(F.explode(F.arrays_zip("a", "b", "docs")).alias("p")).groupBy(
        F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.sum("p.docs").alias("held")), "pairs")
    most = found.groupBy("a").agg(F.max("held").alias("most"))   # at most one row per A id
    return found.join(F.broadcast(most), "a").select("a", "b", "held", (F.col("held") == F.col("most")).alias("best"))


def measure(shards: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per document of the shards: its figures with n_best and count_sum. A Python
    worker is given one shard and the counts of its pairs at a time."""
    asked = shards.select("shard", F.posexplode(F.arrays_zip("a", "b"))).select("shard", "pos", "col.a", "col.b")
    told = attach(asked, counts, ["a", "b"], "inner", salts=1).select(F.col("shard").alias("of"), "pos", "held", "best")

    def run(shard: pa.Table, told: pa.Table) -> pa.Table:
        body = shard["stats"].combine_chunks().flatten()
        bounds, pair, times = (shard[c].combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("bounds", "pair", "times"))
        held, best = (np.zeros(len(told), dtype=np.int64) for _ in range(2))
        pos = told["pos"].to_numpy()
        held[pos], best[pos] = told["held"].to_numpy(), told["best"].to_numpy()
        sums = [np.diff(np.concatenate([[0], np.cumsum(times * x[pair])])[bounds]) for x in (best, held)]
        fields = dict(zip((f.name for f in body.type), body.flatten()))
        return pa.table(
            [fields["id"], *(fields[c] for c in ("n_a", "n_b", "n_groups", "n_links")), *map(pa.array, sums), fields["groups_sha256"]],
            ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    kind = shards.schema["stats"].dataType.elementType["id"].dataType.simpleString()
    return shards.select("shard", "stats", "bounds", "pair", "times").groupBy("shard").cogroup(told.groupBy("of")).applyInArrow(
        run, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                    hashed: bool = False) -> DataFrame:
    """One row per row of `docs`: id, n_a, n_b, n_groups, n_links, n_best, count_sum and the
    groups in writing (`groups`), or with `hashed` their SHA-256 (`groups_sha256`)."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shards = stored(shard_table(slim, path_a, path_b, _sha256 if hashed else None), "aligned", GROUP_SHARDS)
    done = measure(shards, stored(pair_counts(shards), "pair-counts"))
    return done.withColumnsRenamed({"id": id_col} if hashed else {"id": id_col, "groups_sha256": "groups"})
