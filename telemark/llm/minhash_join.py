"""MinHash near-duplicates by an inverted join over signature coordinates.

A document is the set of its k-word shingles. Its signature has COORDINATES values, each the
least of the set's shingles under another hash; two sets of Jaccard similarity s agree in a
coordinate with probability s. Equal sets are one node.

Posting. Every node is posted under each of its (coordinate, value) pairs. A pair that one
node alone has can collide with nothing and is dropped. Two nodes are of interest if they
collide in MATCHES coordinates or more.

Prefix. The pairs have one order, the rarest first. Nodes that collide MATCHES times share
one of their first COORDINATES - MATCHES + 1 pairs each, so only those are merged. A node
with fewer than MATCHES shared pairs is out. The long lists of frequent pairs (a line or
passage that many documents have) come last and are skipped: the collisions in them are
counted by probing the two signatures, not by merging lists.

Links. Where collisions reach MATCHES, the full sets are compared, and 100 * common >=
percent * union decides. In each list all nodes are probed against its likeliest centre, the
node with most entries in prefixes; a list within one component is done. What is left is
put together by centre, dealt into blocks, and counted in small matrices, where only nodes
that collide MATCHES times with one of another component go on to their full sets. No pairs
of a group are listed and no link between components is dropped.

Chance. A pair of similarity 0.8 exactly collides in fewer than 37 of 64 coordinates with a
probability of 1.4e-5, and a pair of more similarity less often; nothing else is lost.

Words are runs of anything but blanks (0x20, 0x09-0x0D), A-Z lower-cased. A text with fewer
than k words has its whole sequence as its only shingle; null, empty and blank texts have
none and are linked with nothing. Rows with a null id have a null component, link nothing
and are kept. Rows that share an id are one document and share a component. Repeated rows
are reported each. Column names of the input other than the two named do not matter.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemark.llm import bytewords as BW
from telemark.llm import ngram_join as N
from telemark.llm.tables import stored
from telemark.operators.joins import attach

COORDINATES, MATCHES = 64, 37
_RANDOM = np.random.Generator(np.random.PCG64(64_37))
_TIMES = _RANDOM.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _RANDOM.integers(1, 1 << 63, COORDINATES, dtype=np.uint64)


# -- signatures (inside tasks) -------------------------------------------------------------

def signatures(values: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """A row of COORDINATES values per set that is not empty. A coordinate's values are mixed
    with its own number, so those of different coordinates never stand for each other."""
    filled = np.flatnonzero(np.diff(cut))
    out = np.empty((len(filled), COORDINATES), dtype=np.uint64)
    if len(filled):
        begin = cut[:-1][filled]
        for c in range(COORDINATES):
            h = (values ^ _FLIP[c]) * _TIMES[c]
            h ^= h >> np.uint64(31)
            out[:, c] = BW.mix(np.minimum.reduceat(h, begin) + _FLIP[c])
    return out


def alive_rows(sig: np.ndarray, part: np.ndarray, n: np.ndarray, comp: np.ndarray, percent: int) -> np.ndarray:
    """Which nodes of two blocks (or one) collide MATCHES times with one of another component."""
    alive = np.zeros(len(n), dtype=bool)
    left = np.flatnonzero(part == 0)
    right = np.flatnonzero(part == 1) if part.any() else left
    short = np.ascontiguousarray(sig.astype(np.uint32).T)      # enough: it can only add collisions
    for begin in range(0, len(left), 128):
        some = left[begin: begin + 128]
        hits = np.zeros((len(some), len(right)), dtype=np.uint8)
        for c in range(COORDINATES):
            hits += short[c, some][:, None] == short[c, right][None, :]
        small, large = np.minimum(n[some][:, None], n[right][None, :]), np.maximum(n[some][:, None], n[right][None, :])
        able = (hits >= MATCHES) & (100 * small >= percent * large) & (comp[some][:, None] != comp[right][None, :])
        alive[some] |= able.any(axis=1)
        alive[right] |= able.any(axis=0)
    return alive


# -- Spark ---------------------------------------------------------------------------------

def signature_table(docs: DataFrame, k: int) -> DataFrame:
    """(id, n, key, sig) per row of `docs` (id, text); `sig` is empty where the set is."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in BW.shards(batches, "text", N.SHARD_BYTES):
            values, cut = BW.shingle_sets(BW.words(part.column(1), BW.NONBLANK), k)
            sizes = np.diff(cut)
            width = np.concatenate([[0], np.cumsum(np.where(sizes > 0, COORDINATES, 0))]).astype(np.int32)
            sig = pa.ListArray.from_arrays(pa.array(width), pa.array(signatures(values, cut).ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes), pa.array(N.set_keys(values, cut).view(np.int64)), sig], ["id", "n", "key", "sig"])

    return docs.mapInArrow(run, f"id {kind}, n long, key long, sig array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(key, items): the whole sets of the wanted nodes (id, key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in BW.shards(batches, "text", N.SHARD_BYTES):
            values, cut = BW.shingle_sets(BW.words(part.column(1), BW.NONBLANK), k)
            keys = N.set_keys(values, cut).view(np.int64)
            right = np.flatnonzero(keys == part.column(2).to_numpy())     # another text of the id is left out
            sizes = np.diff(cut)[right]
            items = [values[cut[r]: cut[r + 1]].view(np.int64) for r in right]
            bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[right]), pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(items) if items else np.zeros(0, np.int64)))],
                ["key", "items"])

    chosen = attach(docs, wanted, "id", "inner", salts=1).select("id", "text", "key")
    return chosen.mapInArrow(run, "key long, items array<long>").groupBy("key").agg(F.first("items").alias("items"))


def prefix_lists(nodes: DataFrame) -> DataFrame:
    """(sig, key): the nodes under each of the pairs in their prefixes."""
    posted = nodes.select("key", F.explode("sig").alias("pair"))
    often = stored(posted.groupBy("pair").agg(F.count("*").alias("often")).filter("often > 1"), "often")
    shared = attach(posted, often, "pair", "inner", salts=1)
    listed = shared.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("often", "pair"))).alias("pairs"))
    # Pairs of one node alone are before all others; they take their places of the prefix.
    first = listed.filter(F.size("pairs") >= MATCHES).withColumn("pairs", F.slice("pairs", 1, F.size("pairs") - (MATCHES - 1)))
    return first.select(F.explode("pairs.pair").alias("sig"), "key")


def collisions(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b, n_a, n_b) of the pairs that collide MATCHES times, by probing both signatures."""
    one, two = (nodes.select(F.col("key").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}")) for x in "ab")
    return pairs.join(one, "a").join(two, "b").filter(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)").filter(
        F.size(F.array_intersect("sig_a", "sig_b")) >= MATCHES).select("a", "b", "n_a", "n_b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs that are similar enough on their full sets."""
    one, two = (sets.select(F.col("key").alias(x), F.col("items").alias(f"items_{x}")) for x in "ab")
    common = F.size(F.array_intersect("items_a", "items_b")).cast("long")
    both = pairs.join(one, "a").join(two, "b").withColumn("common", common)
    return both.filter(f"100 * common >= {percent} * (n_a + n_b - common)").select("a", "b")


def alive(known: DataFrame, percent: int) -> DataFrame:
    """(cluster, key) of (cluster, key, n, sig, comp) that may link to another component."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cluster", "ascending"), ("key", "ascending")])
        cluster, part, n, comp = (table[c].to_numpy() for c in ("cluster", "part", "n", "comp"))
        sig = table["sig"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, COORDINATES)
        found = np.zeros(len(cluster), dtype=bool)
        for g in N._groups(cluster):
            found[g] = alive_rows(sig[g], part[g], n[g], comp[g], percent)
        return table.select(["cluster", "key"]).filter(pa.array(found))

    return N._cells(known).groupBy("cell", "i", "j").applyInArrow(run, "cluster long, key long").distinct()


def _components(docs: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame | None:
    """(key, comp) of the nodes that have links."""
    members = stored(prefix_lists(nodes), "members")
    if members.isEmpty():
        return None

    def sets_of(keys: DataFrame) -> DataFrame:
        return stored(full_sets(docs, stored(nodes.join(keys.distinct(), "key").select("id", "key"), "wanted"), k), "full")

    led = N.centres(members)
    star = led.filter("key <> lead").select(F.least("key", "lead").alias("a"), F.greatest("key", "lead").alias("b")).distinct()
    pairs = stored(collisions(star, nodes, percent), "pairs")
    edges = stored(confirmed(pairs, sets_of(pairs.select(F.col("a").alias("key")).union(pairs.select("b"))), percent), "links")
    comps = None if edges.isEmpty() else N.components(edges)
    known = stored(N.unsettled(led, comps).join(nodes.select("key", "n", "sig"), "key"), "clusters")
    live = stored(alive(known, percent), "live")
    if live.isEmpty():
        return comps
    sized = stored(live.join(nodes.select("key", "n"), "key"), "sized")
    more = stored(N.dense_links(sized, sets_of(live.select("key")).withColumn("frag", F.lit(0)), percent), "dense")
    return comps if more.isEmpty() else N.components(edges.union(more))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row: component_id is the smallest id reachable
    by links, the own one included; `kept` marks the document that stays for its component."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    table = stored(signature_table(slim, k), "signatures")
    nodes = stored(table.filter("n > 0 AND id IS NOT NULL").groupBy("key").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig")), "nodes")
    done = N.with_least_id(table.drop("sig"), _components(slim, nodes, k, percent))
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(True))
    return done.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), kept.alias("kept"))
