"""Conflict-constrained best-fit packing of documents into training sequences.

A bin (sequence) holds `capacity` words, at most one document of a source and at most
one of a duplicate cluster: a group of near copies (ngram_join.link: five-word shingles,
similarity 0.8 or more, linked directly or through others). Bins are kept ordered by the room they have left and carry a
bitmap of their sources and one of their clusters. A piece goes to the tightest bin that
takes it: the search starts at the least room that suffices and goes on to the next bin
in order until one has neither the piece's source nor its cluster; only if there is none
a new bin is opened. Pieces are packed longest first.

Documents longer than a bin are cut into whole bins and a rest; no word is dropped.

Distribution: pieces are dealt into groups of about GROUP_PIECES and every group is
packed by one task. The bound is on rows, so a source with a third of all documents is
spread over all groups; groups share nothing, and a lost task packs its group again to
the same result. Only ids, lengths and keys move, never texts.

Near copies are sought among the texts of all rows, whatever their ids: a row is known by a
hash of its id and text, so rows that share an id but not the text have their own clusters.

Null source or cluster conflicts with nothing. Null, empty and blank texts have no words:
one row with piece 0, n_words 0 and no bin. Repeated rows are packed each (their clusters
keep them apart). Ties: longer first, then smaller id, then smaller piece; among bins of
equal room the older one.
"""
from __future__ import annotations

from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemark.llm import bytewords as BW
from telemark.llm.ngram_join import link
from telemark.llm.tables import stored
from telemark.operators.joins import attach

CAPACITY = 2048
GROUP_PIECES = 1 << 14
SHINGLE, PERCENT = 5, 80   # of near copies


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, n_words, cluster) per row: words between blanks, and the cluster of near
    copies, null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in BW.shards(batches, "text"):
            found = BW.words(part.column(2), BW.NONBLANK)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(3), pa.array(np.diff(found.bounds))],
                ["id", "source", "row", "n_words"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    slim = slim.withColumn("row", F.xxhash64("id", "text"))
    sized = slim.mapInArrow(run, f"id {slim.schema['id'].dataType.simpleString()}, source string, row long, n_words long")
    # Rows that are their own cluster's first need no entry.
    linked = stored(link(slim.filter("text IS NOT NULL"), "row", "text", SHINGLE, PERCENT).filter(
        "component_id <> row").groupBy("row").agg(F.min("component_id").alias("near")), "near-copies")
    return attach(sized, linked, "row", "left").select(
        "id", "source", "n_words", F.when(F.col("n_words") > 0, F.coalesce("near", "row")).alias("cluster"))


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of every piece, in the order given."""
    source_bit: dict = {}
    seen: dict = {}
    for c in clusters:
        seen[c] = seen.get(c, 0) + 1
    cluster_bit: dict = {}
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]   # bins by room left, oldest first
    open_rooms = 0                                               # bit r: some bin has room r
    source_at: list[dict] = [{} for _ in range(capacity + 1)]    # source bit number -> bins of that room with it
    bin_sources: list[int] = []
    bin_list: list[list[int]] = []
    bin_clusters: list[int] = []
    out = []
    for size, source, cluster in zip(sizes, sources, clusters):
        s = -1 if source is None else source_bit.setdefault(source, len(source_bit))
        c = 0
        if cluster is not None and seen[cluster] > 1:
            c = 1 << cluster_bit.setdefault(cluster, len(cluster_bit))
        left = open_rooms >> size
        room, chosen = size - 1, -1
        while left:
            step = (left & -left).bit_length()
            room += step
            left >>= step
            bins = rooms[room]
            if s >= 0 and source_at[room].get(s, 0) == len(bins):
                continue            # every bin of this room has the source
            for b in bins:
                if not (s >= 0 and bin_sources[b] >> s & 1) and not bin_clusters[b] & c:
                    chosen = b
                    break
            if chosen >= 0:
                break
        if chosen < 0:
            chosen, room = len(bin_sources), capacity
            bin_sources.append(0)
            bin_list.append([])
            bin_clusters.append(0)
        else:
            rooms[room].remove(chosen)
            for x in bin_list[chosen]:
                source_at[room][x] -= 1
            if not rooms[room]:
                open_rooms &= ~(1 << room)
        out.append((chosen, capacity - room))
        if s >= 0:
            bin_sources[chosen] |= 1 << s
            bin_list[chosen].append(s)
        bin_clusters[chosen] |= c
        room -= size
        if room:
            insort(rooms[room], chosen)
            open_rooms |= 1 << room
            there = source_at[room]
            for x in bin_list[chosen]:
                there[x] = there.get(x, 0) + 1
    return out


def pack(items: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """(id, piece, first_word, n_words, bin_id, bin_offset) for items (id, source, n_words, cluster)."""
    kind = items.schema["id"].dataType.simpleString()
    whole = F.greatest(F.lit(1), F.ceil(F.col("n_words") / capacity)).cast("int")
    pieces = stored(items.select(
        "id", "source", "n_words", "cluster", F.posexplode(F.sequence(F.lit(0), whole - 1)).alias("piece", "p")).select(
        "id", "source", "cluster", "piece", (F.col("piece") * F.lit(capacity)).cast("long").alias("first_word"),
        F.least(F.lit(capacity), F.col("n_words") - F.col("piece") * capacity).cast("long").alias("n_words")), "pieces")
    none = pieces.filter("n_words <= 0").select(
        "id", "piece", "first_word", "n_words", F.lit(None).cast("long").alias("bin_id"), F.lit(None).cast("long").alias("bin_offset"))
    groups = pieces.filter("n_words > 0").count() // group_pieces + 1
    # Row numbers of a stored table are the same when a task is run again.
    dealt = pieces.filter("n_words > 0").withColumn(
        "bin_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def run(key, group):
        group = group.sort_by([("n_words", "descending"), ("id", "ascending"), ("piece", "ascending")])
        placed = best_fit(*(group[c].to_pylist() for c in ("n_words", "source", "cluster")), capacity)
        first = key[0].as_py() << 32
        return group.select(["id", "piece", "first_word", "n_words"]).append_column(
            "bin_id", pa.array([first + b for b, _ in placed], pa.int64())).append_column(
            "bin_offset", pa.array([o for _, o in placed], pa.int64()))

    packed = dealt.groupBy("bin_group").applyInArrow(
        run, f"id {kind}, piece int, first_word long, n_words long, bin_id long, bin_offset long")
    return packed.unionByName(none)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source") -> DataFrame:
    return pack(measure(docs, id_col, text_col, source_col), capacity).withColumnRenamed("id", id_col)
