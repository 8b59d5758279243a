"""Benchmark decontamination with suffix arrays over the training texts.

Training texts are cut into shards of whole documents. Each task turns a shard into
word hashes, sorts all its suffixes (a suffix array over words: first by three words
packed in one number, then by doubling among those still equal), and searches every
suffix of the test set in it by bisection. That gives each test suffix's longest
verbatim match and all its locations. A shard lives only as long as its task, so no
array crosses the network, nothing is shuffled, and a lost task starts over.

Words are runs of a-z (A-Z lower-cased), 0-9 and all characters beyond ASCII. A window
is `width` consecutive words of an item; an item of fewer words, but not none, is one
window. A word inside any occurrence of a window is hit.

The test set reaches the tasks in blocks of at most BLOCK_BYTES of text; beyond one
block the documents pass through one search per block and carry their hit words along.

Null and empty texts have no words and match nothing. Items with null or empty text
are no windows; null item ids count as one item "null". Repeated documents are each
reported, repeated items once per id. Columns of `docs` that bear the name of a result
are replaced, all others are kept on request (`keep`).
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemark.llm import bytewords as BW

WIDTH = 10
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 2 << 20


# -- suffix array ----------------------------------------------------------------------

def _codes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense numbers from 1 for word hashes in the order of the hash, and the sorted distinct hashes."""
    first = pa.array(hashes).dictionary_encode()
    values = first.dictionary.to_numpy(zero_copy_only=False)
    order = np.argsort(values)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    return rank[first.indices.to_numpy(zero_copy_only=False)], values[order]


def suffix_array(codes: np.ndarray, bounds: np.ndarray, depth: int) -> np.ndarray:
    """Positions of all words, sorted by the words from there to the end of their text,
    as far as the first `depth` words decide (no test suffix is longer). Codes from 1; a
    text's end is 0."""
    n = len(codes)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    at = np.arange(n)

    def ahead(values: np.ndarray, where: np.ndarray, step: int) -> np.ndarray:
        there = where + step
        return np.where(there < ends[where], values[np.minimum(there, n - 1)], 0)

    bits = int(codes.max()).bit_length()
    pack = max(1, 62 // bits)
    key = codes.astype(np.int64)
    for j in range(1, pack):
        key = (key << bits) | ahead(codes, at, j)
    order = np.argsort(key)
    ordered = key[order]
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, at, 0)) + 1
    reach = pack
    while reach < depth:
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        where = np.flatnonzero(tied)
        if len(where) == 0:
            break
        some = order[where]
        low, high = rank[some], ahead(rank, some, reach)
        again = np.lexsort((high, low))
        order[where] = some[again]
        low, high = low[again], high[again]
        new = np.ones(len(where), dtype=bool)
        new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        fresh[where] = new
        first = np.maximum.accumulate(np.where(new, where, 0))
        rank[order[where]] = first + 1
        reach *= 2
    return order


def _compare(text: np.ndarray, ends: np.ndarray, where: np.ndarray, queries: np.ndarray,
             lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(common prefix length, sign of text suffix minus query) for pairs of a suffix and a
    query row; only the first min(length, width) words of a query count."""
    m = len(where)
    common = np.zeros(m, dtype=np.int64)
    sign = np.zeros(m, dtype=np.int8)
    limit = np.minimum(lengths, width)
    live = np.arange(m)
    j = 0
    while len(live):
        live = live[limit[live] > j]
        if not len(live):
            break
        there = where[live] + j
        inside = there < ends[where[live]]
        word = np.where(inside, text[np.minimum(there, len(text) - 1)], 0)
        other = queries[live, j]
        same = word == other
        common[live[same]] = j + 1
        sign[live[~same]] = np.where(word[~same] < other[~same], -1, 1)
        live = live[same]
        j += 1
    return common, sign


def search(codes: np.ndarray, bounds: np.ndarray, order: np.ndarray, queries: np.ndarray,
           lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bisect for every query suffix: the range of the suffix array whose suffixes start
    with its first `width` words (all of them, if fewer)."""
    ends = np.repeat(bounds[1:], np.diff(bounds))
    sides = []
    for side in (0, 1):
        low = np.zeros(len(queries), dtype=np.int64)
        high = np.full(len(queries), len(order), dtype=np.int64)
        while len(live := np.flatnonzero(low < high)):
            mid = (low[live] + high[live]) // 2
            _, sign = _compare(codes, ends, order[mid], queries[live], lengths[live], width)
            right = sign < side
            low[live[right]] = mid[right] + 1
            high[live[~right]] = mid[~right]
        sides.append(low)
    return sides[0], sides[1]


# -- test set ----------------------------------------------------------------------------

class TestSet:
    """Suffixes of one block of test items as arrays, small enough to send to tasks."""

    def __init__(self, ids: Sequence[str], texts: Sequence[str | None], width: int):
        found = BW.words(pa.array(texts, pa.string()), BW.ALNUM)
        self.ids = [i if i is not None else "null" for i in ids]
        counts = np.diff(found.bounds)
        rows = found.rows()
        pos = np.arange(len(found.hashes)) - found.bounds[:-1][rows]
        left = counts[rows] - pos
        start = np.flatnonzero((left >= width) | (pos == 0))
        self.item, self.pos, self.length = rows[start], pos[start], left[start]
        self.hashes, self.begin, self.width = found.hashes, start, width
        # A suffix that is a window of an earlier one word for word is searched once.
        span = int(self.length.max(initial=0))
        grid = start[:, None] + np.arange(min(span, width))[None, :]
        inside = np.arange(min(span, width))[None, :] < self.length[:, None]
        words = np.where(inside, found.hashes[np.minimum(grid, max(len(found.hashes) - 1, 0))], 0) \
            if len(start) else np.zeros((0, 0), np.uint64)
        _, self.window = np.unique(words, axis=0, return_inverse=True) if len(start) else (None, np.zeros(0, np.int64))
        self.window = self.window.reshape(-1)
        self.depth = span

    def encoded(self, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes as rows of codes for one shard's words (-1: no such word there), and
        the suffixes whose first window has only known words."""
        place = np.searchsorted(known, self.hashes)
        code = np.where((place < len(known)) & (known[np.minimum(place, len(known) - 1)] == self.hashes), place + 1, -1)
        need = np.minimum(self.length, self.width)
        bad = np.concatenate([[0], np.cumsum(code < 0)])
        live = np.flatnonzero(bad[self.begin + need] == bad[self.begin])
        span = int(self.length[live].max(initial=0))
        grid = self.begin[live][:, None] + np.arange(span)[None, :]
        inside = np.arange(span)[None, :] < self.length[live][:, None]
        return np.where(inside, code[np.minimum(grid, len(code) - 1)], -1), live


def search_shard(column, tests: TestSet) -> tuple[np.ndarray, list[np.ndarray], list[dict]]:
    """Per text: number of words, which words are hit, and for every item with a hit
    its longest match there (start in the item, start in the text, words)."""
    found = BW.words(column, BW.ALNUM)
    bounds, n = found.bounds, len(found.hashes)
    hit = np.zeros(n + 1, dtype=np.int64)
    best: list[dict] = [{} for _ in range(len(bounds) - 1)]
    if n and len(tests.begin):
        codes, known = _codes(found.hashes)
        queries, live = tests.encoded(known)
        if len(live):
            order = suffix_array(codes, bounds, tests.depth)
            low, high = search(codes, bounds, order, queries, tests.length[live], tests.width)
            size = high - low
            which = np.repeat(np.arange(len(live)), size)
            place = order[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + low[which]]
            need = np.minimum(tests.length[live], tests.width)[which]
            np.add.at(hit, place, 1)
            np.add.at(hit, place + need, -1)
            ends = np.repeat(bounds[1:], np.diff(bounds))
            row = np.searchsorted(bounds, place, "right") - 1
            # The longest match of a (text, item) starts at one of these places.
            step = 1 << 16
            for a in range(0, len(place), step):
                part = slice(a, a + step)
                q = which[part]
                length, _ = _compare(codes, ends, place[part], queries[q], tests.length[live][q], 1 << 30)
                for r, s, p, size_ in zip(row[part].tolist(), live[q].tolist(), place[part].tolist(), length.tolist()):
                    item = tests.ids[tests.item[s]]
                    old = best[r].get(item)
                    if old is None or size_ > old[2]:
                        best[r][item] = (int(tests.pos[s]), int(p - bounds[r]), size_)
    inside = np.cumsum(hit[:-1]) > 0
    return np.diff(bounds), [inside[bounds[r]: bounds[r + 1]] for r in range(len(bounds) - 1)], best


# -- Spark --------------------------------------------------------------------------------

_MATCH = T.ArrayType(T.StructType([
    T.StructField("item_id", T.StringType()), T.StructField("item_start", T.LongType()),
    T.StructField("start", T.LongType()), T.StructField("words", T.LongType())]))
_MATCH_ARROW = pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int64()), ("start", pa.int64()), ("words", pa.int64())]))
RESULTS = ("n_words", "n_hit", "matches", "contaminated")
_STATE = "_tm_mask"


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[list, list]]:
    """The test set in blocks of at most about BLOCK_BYTES; a block is read only in its turn."""
    slim = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"))
    total = slim.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = total // BLOCK_BYTES + 1
    for p in range(parts):
        rows = slim.filter(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == p).collect() if parts > 1 else slim.collect()
        yield [r.i for r in rows], [r.t for r in rows]


def find_matches(docs: DataFrame, benchmark: DataFrame, keep: Sequence[str], text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", width: int = WIDTH) -> DataFrame:
    """The columns `keep` of every document with n_words, n_hit, contaminated (n_hit > 0)
    and matches: per item with a hit, its longest verbatim match (item_start, start, words)."""
    spark = docs.sparkSession
    keep = [c for c in keep if c not in RESULTS]
    carry = docs.select(*keep, F.col(text_col).alias("_tm_text"))
    fields = carry.schema.fields[:-1]
    out = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                        T.StructField("matches", _MATCH)])
    middle = T.StructType([*carry.schema.fields, T.StructField(_STATE, T.BinaryType()), T.StructField("matches", _MATCH)])
    blocks = [spark.sparkContext.broadcast(TestSet(i, t, width)) for i, t in _blocks(benchmark, item_col, item_text)]

    def step(tests, begin: bool, end: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in BW.shards(batches, "_tm_text", SHARD_BYTES):
                at = part.schema.get_field_index("_tm_text")
                counts, masks, best = search_shard(part.column(at), tests.value)
                rows = [[{"item_id": i, "item_start": a, "start": b, "words": c} for i, (a, b, c) in x.items()] for x in best]
                if not begin:
                    for r, (mask, old) in enumerate(zip(part.column(at + 1).to_pylist(), part.column(at + 2).to_pylist())):
                        masks[r] = masks[r] | np.unpackbits(np.frombuffer(mask, np.uint8))[: len(masks[r])].astype(bool)
                        longest = {m["item_id"]: m for m in old}
                        for m in rows[r]:
                            if m["item_id"] not in longest or m["words"] > longest[m["item_id"]]["words"]:
                                longest[m["item_id"]] = m
                        rows[r] = list(longest.values())
                found = pa.array(rows, _MATCH_ARROW)
                if end:
                    hits = pa.array([int(x.sum()) for x in masks], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[:at], pa.array(counts, pa.int64()), hits, found], [f.name for f in out])
                else:
                    packed = pa.array([np.packbits(x).tobytes() for x in masks], pa.binary())
                    yield pa.RecordBatch.from_arrays([*part.columns[: at + 1], packed, found], [f.name for f in middle])
        return run

    for n, tests in enumerate(blocks):
        last = n == len(blocks) - 1
        carry = carry.mapInArrow(step(tests, n == 0, last), out if last else middle)
    return carry.withColumn("contaminated", F.col("n_hit") > 0)


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, **names) -> DataFrame:
    """`docs` without the documents that hold a window of the test set; columns as before."""
    spare = {c: f"_tm_own_{i}" for i, c in enumerate(docs.columns)}
    text = names.pop("text_col", "text")
    renamed = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in spare.items()))
    found = find_matches(renamed, benchmark, list(spare.values()), text_col=spare[text], width=width, **names)
    return found.filter("NOT contaminated").select(*(F.col(n).alias(c) for c, n in spare.items()))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    return found.select(
        id_col, "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"), "contaminated")
