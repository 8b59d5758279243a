"""Exact n-gram Jaccard self-join by vertical partitioning.

Every document is the set of its k-word shingles. All shingles have one global order,
that of a 64-bit hash, and the order is cut into fragments of equal width.

Candidates. Two sets of similarity t differ in at most D = n(1 - t)/t shingles, n being
the smaller size. Cut into more than D fragments, at least one fragment must be the same
on both sides. So each set sends one signature per fragment (the hash of its shingles
there), cut as finely as its size class asks for, and only sets that share a signature
are compared. A passage or shingle that many documents share makes no candidates: the
other shingles of the fragment differ. Empty fragments say nothing and are not sent, but for
sets that have too few filled ones.

Overlaps. Sets in candidate pairs are cut into FRAGMENTS fragments; each pair's overlap
is counted fragment by fragment and summed per pair.

Groups. Equal sets are one node. In every bucket (one signature) all sets are compared
with its likeliest centre; a bucket within one component is done. What is left (groups
whose members are similar, yet not all linked to one centre) is put together by centre and
dealt into blocks; every two blocks of such a cluster meet in one task, which counts
overlaps in small matrices and returns a spanning forest of the links. So no pairs of a
group are ever listed and no link between different components is lost; the cost of such a
cluster is quadratic in arithmetic only.

Skew. A task sends one entry per signature and shard however many sets share it there,
the other members bypass that shuffle; joins on hot signatures are plain equi-joins,
which adaptive execution splits.

Words are runs of anything but blanks (0x20, 0x09-0x0D), A-Z lower-cased. A text with
fewer than k words has its whole sequence as its only shingle; null, empty and blank
texts have none and are linked with nothing. Rows with a null id are reported with a
null component and link nothing. `id_col` identifies a document: rows that share an id
share its component. Column names of the input other than the two named do not matter.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemark.llm import bytewords as BW
from telemark.llm.tables import stored
from telemark.operators.joins import attach

FRAGMENTS = 8            # of the overlap count
PART_SHINGLES = 1 << 20  # shingles per partition of the signature shuffle
SHARD_BYTES = 2 << 20
BLOCK_SETS, BLOCK_SHINGLES = 2048, 1 << 20  # of a block of a cluster
WIDTH = 1024             # shingles per fragment in a block
_ENTRY = np.dtype([("sig", "<u8"), ("key", "<u8")])


# -- sets and signatures (inside tasks) ----------------------------------------------------

def set_keys(values: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """One even 63-bit number per set, whatever the order; 0 for the empty set."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(BW.mix(values + np.uint64(0x632BE59BD9B4E019)), out=total[1:])
    size = np.diff(cut).astype(np.uint64)
    key = BW.mix(total[cut[1:]] - total[cut[:-1]] + size) & np.uint64(0x7FFFFFFFFFFFFFFE)
    return np.where(size > 0, np.maximum(key, np.uint64(2)), np.uint64(0))


def parity_bits(values: np.ndarray, cut: np.ndarray) -> list[np.ndarray]:
    """Per set a row of bits, one for each value of the shingles' lowest bits, telling whether
    an odd number of its shingles fall there; as many 64-bit words as needed for a bit per
    shingle, a power of two. Two sets differ in at least as many shingles as bits."""
    out = []
    for r in range(len(cut) - 1):
        own = values[cut[r]: cut[r + 1]]
        size = 64 << max(0, (max(len(own), 1) - 1).bit_length() - 6)
        odd = np.bincount((own & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
        out.append(np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64))
    return out


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Rows of parity bits for fewer of the lowest bits."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _bit_count(words: np.ndarray) -> np.ndarray:
    """Bits set in each 64-bit word; of signed ones numpy would count the absolute value."""
    return np.bitwise_count(words.view(np.uint64))


def may_link(n_a, n_b, apart, percent: int):
    """Whether sets of these sizes that differ in `apart` shingles at least may be similar."""
    both = (n_a + n_b - apart) / 2
    return 100 * both >= percent * (n_a + n_b - both)


def allowed(n: int, percent: int) -> int:
    """Most shingles in which a set of n and a larger one of enough similarity differ."""
    return n * (100 - percent) // percent


def fragments_of(level: int, percent: int) -> int:
    """Fragments for smaller sets of 2**level to 2**(level+1) - 1 shingles: more than may differ."""
    most = allowed((2 << level) - 1, percent)
    return most + 2 + most // 16


def signatures(values: np.ndarray, cut: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(set number, signature) of all fragments that candidates must be sought by: of a set
    that may differ in D shingles its first D + 1 filled fragments in global order. Of two
    similar sets take the shorter of the two runs: it has D + 1 filled fragments of its owner,
    of which at most D differ, so one filled fragment is equal on both sides and in both runs.
    A set with no D + 1 filled fragments sends its empty ones too."""
    sizes = np.diff(cut)
    out_rows, out = [], []
    top = int(sizes.max(initial=0)).bit_length()
    for level in range(top):
        low, high = 1 << level, (2 << level) - 1
        rows = np.flatnonzero((sizes >= low) & (sizes * percent <= high * 100))
        if not len(rows):
            continue
        parts = fragments_of(level, percent)
        size = sizes[rows]
        wanted = np.minimum(size, high) * (100 - percent) // percent + 1
        owner = np.repeat(np.arange(len(rows)), size)
        value = values[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + cut[rows][owner]]
        # Equal widths of the upper 32 bits: the order inside a set is kept.
        part = ((value >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        group = owner.astype(np.uint64) * np.uint64(parts) + part
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        total = np.zeros(len(value) + 1, dtype=np.uint64)
        np.cumsum(BW.mix(value ^ np.uint64(0x5851F42D4C957F2D)), out=total[1:])
        body = np.diff(total[np.concatenate([first, [len(value)]]).astype(np.int64)])
        which, part = owner[first], part[first]
        filled = np.bincount(which, minlength=len(rows))
        turn = np.arange(len(which)) - np.repeat(np.cumsum(filled) - filled, filled)
        goes = turn < wanted[which]
        salt = np.uint64((level + 1) * 0x9FB21C651E98DF25 & 0xFFFFFFFFFFFFFFFF)
        place = np.uint64(0xD1342543DE82EF95)
        out_rows.append(rows[which[goes]])
        out.append(BW.mix(body[goes] + (part[goes] + np.uint64(1)) * place + salt))
        for r in np.flatnonzero(filled < wanted):
            empty = np.setdiff1d(np.arange(parts), part[which == r].astype(np.int64)).astype(np.uint64)
            out_rows.append(np.full(len(empty), rows[r]))
            out.append(BW.mix((empty + np.uint64(1)) * place + salt))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(out_rows), np.concatenate(out)


def _sets(column, k: int) -> tuple[np.ndarray, np.ndarray]:
    return BW.shingle_sets(BW.words(column, BW.NONBLANK), k)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    cuts = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64)))


def _split(column) -> list[np.ndarray]:
    """The rows of a list column as arrays."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.split(flat, np.cumsum(column.value_lengths().to_numpy())[:-1]) if len(column) else []


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


# -- Spark ---------------------------------------------------------------------------------

def shingle_table(docs: DataFrame, k: int) -> DataFrame:
    """(id, n, key, bits) per row of `docs` (id, text), and its other columns."""
    kind = docs.schema["id"].dataType.simpleString()
    other = docs.columns[2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in BW.shards(batches, "text", SHARD_BYTES):
            values, cut = _sets(part.column(1), k)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(cut)), _long(set_keys(values, cut)), _lists(parity_bits(values, cut)), *part.columns[2:]],
                ["id", "n", "key", "bits", *other])

    return docs.mapInArrow(run, ", ".join([f"id {kind}, n long, key long, bits array<long>", *(
        f"{c} {docs.schema[c].dataType.simpleString()}" for c in other)]))


def bucket_members(docs: DataFrame, k: int, percent: int, parts: int) -> DataFrame:
    """(sig, key): every signature that two different sets share, with all its sets."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for shard in BW.shards(batches, "text", SHARD_BYTES):
            values, cut = _sets(shard.column(1), k)
            keys = set_keys(values, cut)
            rows, sig = signatures(values, cut, percent)
            both = np.empty(len(sig), dtype=_ENTRY)
            both["sig"], both["key"] = sig, keys[rows]
            both = both[np.lexsort((both["key"], both["sig"]))]
            keep = np.ones(len(both), dtype=bool)
            keep[1:] = both[1:] != both[:-1]
            both = both[keep]
            first = np.ones(len(both), dtype=bool)
            first[1:] = both["sig"][1:] != both["sig"][:-1]
            again = np.zeros(len(both), dtype=bool)
            again[:-1] = first[:-1] & ~first[1:]
            lead = both[first]
            lead["key"] |= again[first]        # odd: the shard has more members
            part = ((lead["sig"] >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            edge = np.searchsorted(part, np.arange(parts + 1))  # sorted by sig, so by part
            out = [(p, lead[edge[p]: edge[p + 1]].tobytes(), True) for p in np.flatnonzero(np.diff(edge)).tolist()]
            if not first.all():
                out.append((turn % parts, both[~first].tobytes(), False))
                turn += 1
            for i in range(0, len(out), 64):
                p, body, goes = zip(*out[i: i + 64])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p, pa.int32()), pa.array(body, pa.binary()), pa.array(goes, pa.bool_())],
                    ["part", "body", "lead"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leads = []
        for batch in batches:
            for body, lead in zip(batch.column(1), batch.column(2).to_pylist()):
                found = np.frombuffer(body.as_buffer(), dtype=_ENTRY)
                if lead:
                    leads.append(found)
                else:
                    yield pa.RecordBatch.from_arrays([_long(found["sig"]), _long(found["key"])], ["sig", "key"])
        if not leads:
            return
        every = np.concatenate(leads)
        leads.clear()
        more = (every["key"] & np.uint64(1)).astype(bool)
        every["key"] &= ~np.uint64(1)
        order = np.lexsort((every["key"], every["sig"]))
        every, more = every[order], more[order]
        head = np.ones(len(every), dtype=bool)
        head[1:] = every["sig"][1:] != every["sig"][:-1]
        fresh = head.copy()
        fresh[1:] |= every["key"][1:] != every["key"][:-1]
        group = np.cumsum(head) - 1
        wanted = np.bincount(group, weights=fresh + 2 * more) > 1 if len(every) else np.zeros(0, bool)
        keep = every[fresh & wanted[group]]
        yield pa.RecordBatch.from_arrays([_long(keep["sig"]), _long(keep["key"])], ["sig", "key"])

    sent = docs.mapInArrow(send, "part int, body binary, lead boolean")
    met = sent.repartition(parts, "part").mapInArrow(meet, "sig long, key long")
    return met


def fragment_table(docs: DataFrame, wanted: DataFrame, k: int, unique: bool) -> DataFrame:
    """(key, frag, items): the sets of the wanted (id, key) rows, cut into fragments.
    `unique`: no id occurs twice, so no set can come twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in BW.shards(batches, "text", SHARD_BYTES):
            values, cut = _sets(part.column(1), k)
            keys = set_keys(values, cut)
            right = np.flatnonzero(keys.view(np.int64) == np.asarray(part.column(2)))
            key, frag, items = [], [], []
            for r in right.tolist():
                own = values[cut[r]: cut[r + 1]]
                edge = np.searchsorted(own >> np.uint64(32), (np.arange(FRAGMENTS + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(FRAGMENTS))
                for f in range(FRAGMENTS):
                    if edge[f] < edge[f + 1]:
                        key.append(int(keys[r]))
                        frag.append(f)
                        items.append(own[edge[f]: edge[f + 1]].view(np.int64))
            lengths = np.concatenate([[0], np.cumsum([len(x) for x in items])]).astype(np.int32) if items else np.zeros(1, np.int32)
            body = pa.array(np.concatenate(items) if items else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array(frag, pa.int32()), pa.ListArray.from_arrays(pa.array(lengths), body)],
                ["key", "frag", "items"])

    chosen = attach(docs, wanted, "id", "inner", salts=1).select("id", "text", "key")
    cut = chosen.mapInArrow(run, "key long, frag int, items array<long>")
    return cut if unique else cut.dropDuplicates(["key", "frag"])


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, common) per pair (a, b, n_a, n_b): partial overlaps by fragment,
    summed. A fragment that only one side has adds nothing."""
    one = sets.select(F.col("key").alias("a"), "frag", F.col("items").alias("x"))
    two = sets.select(F.col("key").alias("b"), "frag", F.col("items").alias("y"))
    partial = pairs.join(one, "a").join(two, ["b", "frag"]).select(
        "a", "b", "n_a", "n_b", F.size(F.array_intersect("x", "y")).cast("long").alias("common"))
    return partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("common").alias("common"))


def components(edges: DataFrame) -> DataFrame:
    """(key, comp) for all keys on edges (a, b): the smallest key reachable. Every node
    points to its smallest neighbour and on to where that points; edges are contracted to
    what their ends point to and vanish inside a component, until none is left."""
    edges = stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = edges.select(F.col("a").alias("key")).union(edges.select("b")).distinct().withColumn("comp", F.col("key"))
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(edges.select("b", "a"))
        point = stored(both.groupBy("node").agg(F.least(F.min("near"), F.first("node")).alias("to")), "pointers")
        onward = stored(point.join(point.toDF("to", "far"), "to").select("node", F.col("far").alias("to")), "pointers")
        labels = stored(labels.join(onward.toDF("comp", "to"), "comp", "left").select("key", F.coalesce("to", "comp").alias("comp")), "labels")
        moved = edges.join(onward.toDF("a", "to_a"), "a").join(onward.toDF("b", "to_b"), "b").filter("to_a <> to_b")
        edges = stored(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
    return labels


def _with_comps(members: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return members.withColumn("comp", F.col("key"))
    return members.join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))


def centres(members: DataFrame) -> DataFrame:
    """(sig, key, lead): every bucket's member that has most shared signatures, the likeliest
    centre of its group. Buckets of one group mostly have the same."""
    degree = members.groupBy("key").agg(F.count("*").alias("degree"))
    ranked = stored(members.join(degree, "key"), "ranked")
    led = ranked.groupBy("sig").agg(F.max(F.struct("degree", "key"))["key"].alias("lead"))
    return stored(ranked.join(led, "sig").select("sig", "key", "lead"), "led")


def _spanning(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> list[tuple[int, int]]:
    """Links (row key, column key) enough to connect whatever the boolean matrix connects."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(linked))):
        a, b = find(int(rows[i])), find(int(columns[j]))
        if a != b:
            root[a] = b
            out.append((int(rows[i]), int(columns[j])))
    return out


def block_links(keys: np.ndarray, part: np.ndarray, items: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between the sets of two blocks (part 0 and 1), or within one (all part 0). The
    order of shingles is cut into fragments of WIDTH; overlaps are counted per fragment and
    summed per pair."""
    sizes = np.array([len(x) for x in items], dtype=np.int64)
    flat = np.concatenate(items)
    _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(items)), sizes)
    shared = times[code] > 1
    number = np.cumsum(times > 1) - 1
    code, owner = number[code[shared]], owner[shared]
    left = np.flatnonzero(part == 0)
    right = np.flatnonzero(part == 1) if part.any() else left
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    edges = np.searchsorted(code, np.arange(0, (int(code[-1]) if len(code) else 0) + WIDTH + 1, WIDTH))
    for f in range(len(edges) - 1):
        piece = slice(edges[f], edges[f + 1])
        grid = np.zeros((len(items), WIDTH), dtype=np.float32)
        grid[owner[piece], code[piece] - f * WIDTH] = 1
        common += grid[left] @ grid[right].T
    union = sizes[left][:, None] + sizes[right][None, :] - common
    linked = 100 * common.astype(np.float64) >= percent * union
    linked &= keys[left][:, None] < keys[right][None, :] if right is left else keys[left][:, None] != keys[right][None, :]
    return _spanning(linked, keys[left], keys[right])


def near_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b, n_a, n_b): the pairs whose sizes and parity bits leave similarity possible."""
    one, two = (nodes.select(F.col("key").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}")) for x in "ab")
    sized = pairs.join(one, "a").join(two, "b").filter(
        f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = _split(batch.column(4)), _split(batch.column(5))
            apart = np.zeros(batch.num_rows)
            for r, (x, y) in enumerate(zip(one, two)):
                words = min(len(x), len(y))
                apart[r] = _bit_count(folded(x[None], words) ^ folded(y[None], words)).sum()
            keep = may_link(batch.column(2).to_numpy(), batch.column(3).to_numpy(), apart, percent)
            yield pa.RecordBatch.from_arrays(batch.columns[:4], ["a", "b", "n_a", "n_b"]).filter(pa.array(keep))

    return sized.mapInArrow(run, "a long, b long, n_a long, n_b long")


def survivors(keys: np.ndarray, part: np.ndarray, sizes: np.ndarray, comps: np.ndarray, bits: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of two blocks (or one) may link to one of another component."""
    alive = np.zeros(len(keys), dtype=bool)
    right = np.flatnonzero(part == 1) if part.any() else np.arange(len(keys))
    width = np.array([len(x) for x in bits])
    grids = {w: np.stack([bits[i] for i in np.flatnonzero(width == w)]) for w in np.unique(width).tolist()}
    owners = {w: np.flatnonzero(width == w) for w in grids}
    for w, mine in owners.items():
        for v, others in owners.items():
            if v > 2 * w or w > 2 * v:
                continue      # sizes too far apart
            others = others[np.isin(others, right)]
            words = min(w, v)
            rows, columns = folded(grids[w], words), folded(grids[v], words)[np.isin(owners[v], others)]
            for begin in range(0, len(mine), 64):
                some = mine[begin: begin + 64]
                if part.any():
                    some = some[part[some] == 0]
                if not len(some) or not len(others):
                    continue
                chunk = rows[np.searchsorted(mine, some)]
                apart = np.zeros((len(some), len(others)), dtype=np.int32)
                for c in range(words):
                    apart += _bit_count(chunk[:, c, None] ^ columns[None, :, c])
                able = may_link(sizes[some][:, None], sizes[others][None, :], apart, percent)
                able &= comps[some][:, None] != comps[others][None, :]
                alive[some] |= able.any(axis=1)
                alive[others] |= able.any(axis=0)
    return alive


def _cells(known: DataFrame) -> DataFrame:
    """(cell, i, j, cluster, part, key, ...) for (cluster, key, n, ...): clusters dealt into
    blocks, a row for every pair of blocks; small clusters share cells."""
    parts = stored(known.groupBy("cluster").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")), "blocks")
    sets, shingles = known.agg(F.count("*"), F.sum("n")).first()
    few = int(max(sets // BLOCK_SETS, (shingles or 0) // BLOCK_SHINGLES)) + 1
    placed = attach(known, parts, "cluster", "inner", salts=1).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({
        "i": F.least("block", "other"), "j": F.greatest("block", "other"), "part": (F.col("block") > F.col("other")).cast("int"),
        "cell": F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(few))).otherwise(F.col("cluster"))}).drop(
        "blocks", "block", "other")


def _groups(cluster: np.ndarray) -> Iterator[slice]:
    """Runs of equal values."""
    edge = np.flatnonzero(np.concatenate([[True], cluster[1:] != cluster[:-1], [True]])) if len(cluster) else np.zeros(0, np.int64)
    for begin, end in zip(edge[:-1].tolist(), edge[1:].tolist()):
        yield slice(begin, end)


def likely_members(known: DataFrame, percent: int) -> DataFrame:
    """(cluster, key) of the sets whose parity bits let them link to another component."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cluster", "ascending"), ("key", "ascending")])
        cluster, key, part, n, comp = (table[c].to_numpy() for c in ("cluster", "key", "part", "n", "comp"))
        bits, alive = _split(table["bits"]), np.zeros(len(key), dtype=bool)
        for g in _groups(cluster):
            if g.stop - g.start > 1:
                alive[g] = survivors(key[g], part[g], n[g], comp[g], bits[g], percent)
        return table.select(["cluster", "key"]).filter(pa.array(alive))

    return _cells(known).groupBy("cell", "i", "j").applyInArrow(run, "cluster long, key long").distinct()


def dense_links(known: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect all that is linked within clusters (cluster, key, n). Every
    two blocks of a cluster meet in one task, which counts overlaps in small matrices and
    returns a spanning forest only."""
    met = _cells(known).join(sets, "key").select("cell", "i", "j", "cluster", "part", "key", "frag", "items")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cluster", "ascending"), ("key", "ascending"), ("frag", "ascending")])
        cluster, key, part = (table[c].to_numpy() for c in ("cluster", "key", "part"))
        items, out = _split(table["items"]), []
        for g in _groups(cluster):
            sets_at = [slice(g.start + x.start, g.start + x.stop) for x in _groups(key[g])]
            head = np.array([x.start for x in sets_at])
            out += block_links(key[head], part[head], [np.concatenate(items[x]) for x in sets_at], percent)
        a, b = zip(*out) if out else ((), ())
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return met.groupBy("cell", "i", "j").applyInArrow(run, "a long, b long")


def unsettled(led: DataFrame, comps: DataFrame | None) -> DataFrame:
    """(cluster, key, comp): the members of buckets of more than two that lie in several
    components, put together by their buckets' centres."""
    left = _with_comps(led, comps)
    spread = left.groupBy("sig").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("c")).filter(
        "x <> y AND c > 2").select("sig")
    return left.join(spread, "sig", "left_semi").select(F.col("lead").alias("cluster"), "key", "comp").distinct()


def _text_components(slim: DataFrame, nodes: DataFrame, unique: bool, k: int, percent: int) -> DataFrame | None:
    """(key, comp) of the different texts that have links; nodes of null ids have none."""
    total = nodes.agg(F.sum("n")).first()[0] or 0
    members = stored(bucket_members(slim, k, percent, int(total // PART_SHINGLES) + 1).distinct(), "members")
    return None if members.isEmpty() else _grow(slim, nodes.filter("id IS NOT NULL"), members, k, percent, unique)


def with_least_id(table: DataFrame, comps: DataFrame | None) -> DataFrame:
    """(id, n, component) for rows (id, n, key) and the components of keys: the smallest id
    that links and rows of one id reach. Rows of null id, and ids without words, stand alone."""
    named = table.filter("n > 0 AND id IS NOT NULL")
    several = stored(named.groupBy("id").agg(F.min("key").alias("a"), F.max("key").alias("z")).filter("a <> z").select("id", "a"), "several")
    if not several.isEmpty():
        same = named.join(several, "id").select("a", F.col("key").alias("b")).filter("a <> b")
        known = comps.select(F.col("comp").alias("a"), F.col("key").alias("b")) if comps is not None else None
        comps = components(same if known is None else same.union(known))
    joined = _with_comps(table, comps)
    comp = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("comp"))
    joined = joined.withColumn("comp", comp)
    least = joined.filter("comp IS NOT NULL").groupBy("comp").agg(F.min("id").alias("least"))
    return joined.join(least, "comp", "left").select("id", "n", F.coalesce("least", "id").alias("component"))


def _tables(slim: DataFrame, k: int) -> tuple[DataFrame, DataFrame, bool]:
    """The shingle table, its different sets, and whether no id comes twice."""
    table = stored(shingle_table(slim, k), "sets")
    nodes = stored(table.filter("n > 0").groupBy("key").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("bits").alias("bits")), "nodes")
    table = table.drop("bits")
    return table, nodes, table.groupBy("id").count().filter("count > 1 AND id IS NOT NULL").isEmpty()


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
         percent: int = 90) -> DataFrame:
    """(id, n_shingles, component_id) per row: linked where 100 * common >= percent * union.

    component_id is the smallest id reachable by links, the own one included.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    table, nodes, unique = _tables(slim, k)
    done = with_least_id(table, _text_components(slim, nodes, unique, k, percent))
    return done.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def _grow(slim: DataFrame, nodes: DataFrame, members: DataFrame, k: int, percent: int, unique: bool) -> DataFrame | None:
    led = centres(members)
    star = led.filter("key <> lead").select(F.least("key", "lead").alias("a"), F.greatest("key", "lead").alias("b")).distinct()
    pairs = stored(near_pairs(star, nodes, percent), "pairs")

    def sets_of(keys: DataFrame) -> DataFrame:
        return stored(fragment_table(slim, stored(nodes.join(keys.distinct(), "key").select("id", "key"), "wanted"), k, unique), "fragments")

    found = overlaps(pairs, sets_of(pairs.select(F.col("a").alias("key")).union(pairs.select("b"))))
    edges = stored(found.filter(f"100 * common >= {percent} * (n_a + n_b - common)").select("a", "b"), "links")
    comps = None if edges.isEmpty() else components(edges)
    # A bucket within one component is done, and one of two sets, which have been compared.
    known = stored(unsettled(led, comps).join(nodes.select("key", "n", "bits"), "key"), "clusters")
    live = stored(likely_members(known, percent), "live")
    if live.isEmpty():
        return comps
    sized = stored(live.join(nodes.select("key", "n"), "key"), "clusters")
    more = stored(dense_links(sized, sets_of(live.select("key")), percent), "dense")
    return comps if more.isEmpty() else components(edges.union(more))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
             percent: int = 80) -> DataFrame:
    """`docs` with one row of each group of rows whose texts are linked: that of the smallest
    id and, within one id, of the smallest hash of its text; of equal ids and texts the row of
    the smallest hash over all columns. Columns as before. Rows are judged one by one: another
    text of the same id is no reason to go. Rows with null id and rows without words are their
    own groups and stay."""
    hashed = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    keyed = docs.withColumns({"_tm_id": F.col(id_col), "_tm_text": hashed})
    slim = keyed.select(F.col("_tm_id").alias("id"), F.col(text_col).alias("text"), F.col("_tm_text").alias("said"))
    table, nodes, unique = _tables(slim, k)
    comps = _text_components(slim.select("id", "text"), nodes, unique, k, percent)
    rows = stored(_with_comps(table.filter("n > 0 AND id IS NOT NULL"), comps).select("comp", F.struct("id", "said").alias("row")), "rows")
    best = rows.groupBy("comp").agg(F.min("row").alias("best"), F.count("*").alias("c")).filter("c > 1").drop("c")
    names = [F.col("row.id").alias("_tm_id"), F.col("row.said").alias("_tm_text")]
    gone = stored(attach(rows, stored(best, "best"), "comp", "inner", salts=1).filter("row <> best").select(*names).distinct(), "gone")
    left = attach(keyed, gone, ["_tm_id", "_tm_text"], "left_anti", salts=1)
    if not unique:
        twice = stored(rows.groupBy("row").count().filter("count > 1").select(*names), "twice")
        again = attach(left, twice, ["_tm_id", "_tm_text"], "left_semi", salts=1).groupBy("_tm_id", "_tm_text").agg(
            F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row"))
        left = attach(left, twice, ["_tm_id", "_tm_text"], "left_anti", salts=1).select(*docs.columns).unionByName(again.select("row.*"))
    return left.select(*docs.columns)
