"""Roles of raw transcripts by a hidden Markov model, and canonical chat turns.

A transcript is lines of text in which speakers are marked in many ways ("User:",
"### Assistant", "A:"), or not at all. A line's state is (role, first line of a turn or
a later one); what is seen of it is its marker class, its length class, whether it ends
as a question, and whether it opens its piece of text. Transition, start and emission
counts come from labelled transcripts (all of them, by aggregation); Viterbi finds the
likeliest states, and each run from a first line to the next is rendered as one turn.

Long conversations: lines are dealt into chunks of CHUNK pieces. A chunk acts on the
states before it as a matrix of best scores (6 x 6), matrices combine like numbers, and
so one conversation with a third of all lines is solved as a tree: matrices upward, then
the best states at the chunk borders downward, then every chunk by itself. Tasks take
buckets of many short sequences and step them together.

A piece of null position comes before all others of its conversation, in a chunk of its
own; its turn has a null start_seq. Null and empty pieces have no lines. A null conversation id is a conversation of its own.
Pieces of equal position are read in order of their text; repeated rows are repeated
lines. Columns other than the four named are not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemark.llm.tables import stored

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)          # role * 2 + (0 first line, 1 later line)
SYMBOLS = 4 * 4 * 2 * 2
CHUNK = 64                       # pieces per chunk, chunks per node of the tree
BUCKET_LINES = 50_000

# Fixed lists: words by which speakers are marked, by role in the order of ROLES.
MARKS = (
    "system|instructions?|context",
    "user|human|question|q|customer|prompter|me",
    "assistant|ai|bot|answer|a|response|model",
)
_MARK = r"^[^\p{L}\p{N}]*(?:WORDS)[^\p{L}\p{N}]*[:>\]][\s*_#]*"


def lines(pieces: DataFrame, conv: str = "conv_id", seq: str = "seq", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(conv, seq, line, body, seen, *keep): the lines of every piece and what is seen of them."""
    cut = pieces.filter(F.length(text) > 0).select(
        F.col(conv).alias("conv"), F.col(seq).cast("long").alias("seq"), F.xxhash64(text).alias("tie"), *keep,
        F.posexplode(F.split(text, "\n")).alias("line", "body"))
    low = F.lower("body")
    mark = F.coalesce(*(F.when(low.rlike(_MARK.replace("WORDS", words)), F.lit(i + 1)) for i, words in enumerate(MARKS)), F.lit(0))
    size = F.length("body")
    length = F.when(size < 20, 0).when(size < 80, 1).when(size < 300, 2).otherwise(3)
    asks = F.when(F.trim("body").rlike(r"[?？]$"), 1).otherwise(0)
    opens = F.when(F.col("line") == 0, 1).otherwise(0)
    return cut.withColumn("seen", (((mark * 4 + length) * 2 + asks) * 2 + opens).cast("int"))


# -- model -----------------------------------------------------------------------------------

def train(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log probabilities (start, transition, emission) from lines with a `role` column."""
    role = F.coalesce(*(F.when(F.lower("role") == r, F.lit(i)) for i, r in enumerate(ROLES)))
    known = labelled.withColumn("r", role).filter("r IS NOT NULL")
    seen = known.groupBy("r", (F.col("line") > 0).alias("later"), "seen").count().collect()
    pieces = known.groupBy("conv", "seq").agg(F.first("r").alias("r"), F.max("line").alias("last"))
    follow = pieces.select("conv", (F.col("seq") + 1).alias("seq"), F.col("r").alias("p"), F.col("last").alias("p_last"))
    steps = pieces.join(follow, ["conv", "seq"], "left").groupBy(
        "r", "p", (F.col("p_last") > 0).alias("p_later")).agg(
        F.count("*").alias("n"), F.sum((F.col("last") > 0).cast("long")).alias("second"),
        F.sum(F.greatest(F.col("last") - 1, F.lit(0))).alias("third")).collect()
    start, move, emit = np.full(STATES, 0.01), np.full((STATES, STATES), 0.01), np.full((STATES, SYMBOLS), 0.1)
    for r in seen:
        emit[2 * r.r + int(r.later), r.seen] += r["count"]
    for r in steps:
        if r.p is None:
            start[2 * r.r] += r.n
        else:
            move[2 * r.p + int(r.p_later), 2 * r.r] += r.n
        move[2 * r.r, 2 * r.r + 1] += r.second
        move[2 * r.r + 1, 2 * r.r + 1] += r.third
    return np.log(start / start.sum()), np.log(move / move.sum(1, keepdims=True)), np.log(emit / emit.sum(1, keepdims=True))


def best_paths(steps: np.ndarray, lengths: np.ndarray, entry: np.ndarray, leave: np.ndarray) -> np.ndarray:
    """States after every step of many sequences. steps[i] (K, K) scores going from the row
    state to the column state; sequence s owns lengths[s] steps in order. entry (S, K) are
    scores before its first step, leave (S,) its last state, or -1 for the best."""
    total, k = len(steps), entry.shape[1]
    first = np.cumsum(lengths) - lengths
    score, back = entry.copy(), np.zeros((total, k), dtype=np.int8)
    for t in range(int(lengths.max(initial=0))):
        live = np.flatnonzero(lengths > t)
        reach = score[live][:, :, None] + steps[first[live] + t]
        back[first[live] + t] = reach.argmax(axis=1)
        score[live] = reach.max(axis=1)
    state = np.where(leave >= 0, leave, score.argmax(axis=1))
    out = np.zeros(total, dtype=np.int64)
    for t in range(int(lengths.max(initial=0)) - 1, -1, -1):
        live = np.flatnonzero(lengths > t)
        at = first[live] + t
        out[at] = state[live]
        state[live] = back[at, state[live]]
    return out


def combine(steps: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(S, K, K): the best score from each state before a sequence to each state after it."""
    k = steps.shape[1]
    first = np.cumsum(lengths) - lengths
    out = np.where(np.eye(k, dtype=bool), 0.0, -np.inf)[None].repeat(len(lengths), axis=0)
    for t in range(int(lengths.max(initial=0))):
        live = np.flatnonzero(lengths > t)
        out[live] = (out[live][:, :, :, None] + steps[first[live] + t][:, None]).max(axis=2)
    return out


def _runs(table: pa.Table, columns: list[str]) -> np.ndarray:
    """Lengths of the runs of equal values in sorted columns."""
    n = table.num_rows
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    change = np.zeros(n, dtype=bool)
    change[0] = True
    for c in columns:
        code = table[c].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        change[1:] |= code[1:] != code[:-1]
    at = np.flatnonzero(change)
    return np.diff(np.append(at, n))


# -- Spark -----------------------------------------------------------------------------------

_LINE_ORDER = [(c, "ascending") for c in ("conv", "chunk", "seq", "tie", "line")]


def _matrices(table: pa.Table) -> np.ndarray:
    return np.asarray(table["score"].combine_chunks().flatten()).reshape(-1, STATES + 1, STATES + 1)


def _folded(table: pa.Table, group: str, steps: np.ndarray) -> pa.Table:
    """One combined matrix per (conv, group) of a sorted table."""
    lengths = _runs(table, ["conv", group])
    first, out = np.cumsum(lengths) - lengths, combine(steps, lengths)
    cuts = pa.array(np.arange(len(out) + 1) * (STATES + 1) ** 2, pa.int32())
    return pa.table([table["conv"].take(pa.array(first)), table[group].take(pa.array(first)),
                     pa.ListArray.from_arrays(cuts, pa.array(out.ravel()))], names=["conv", "idx", "score"])


def _entering(states: np.ndarray) -> np.ndarray:
    return np.where(np.arange(STATES + 1)[None] == states[:, None], 0.0, -np.inf)


def recover(pieces: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray], conv: str = "conv_id",
            seq: str = "seq", text: str = "text") -> DataFrame:
    """(conv, chunk, seq, tie, line, body, seen, state) for every line."""
    start, move, emit = model
    # One more state stands before the first line of every conversation.
    step = np.full((STATES + 1, STATES + 1), -np.inf)
    step[:STATES, :STATES], step[STATES, :STATES] = move, start
    sees = np.full((STATES + 1, SYMBOLS), -np.inf)
    sees[:STATES] = emit

    read = stored(lines(pieces, conv, seq, text).withColumn("chunk", F.floor(F.col("seq") / CHUNK)), "lines")
    kind = read.schema["conv"].dataType.simpleString()
    low, high, count, placed = read.agg(F.min("chunk"), F.max("chunk"), F.count("*"), F.count("chunk")).first()
    # From 1 on, for a division by CHUNK never brings a negative and a positive number together; null positions at 0.
    base = min(low or 0, 0) - 1
    read = read.withColumn("chunk", F.coalesce(F.col("chunk") - F.lit(base), F.lit(0).cast("long")))
    if placed:
        low, high = low - base if placed == count else 0, high - base
    buckets = int(count // BUCKET_LINES) + 1
    node, border = f"conv {kind}, idx long, score array<double>", f"conv {kind}, idx long, entry int, leave int"

    def bucket(*columns):
        return F.pmod(F.xxhash64(*columns), F.lit(buckets)).alias("bucket")

    def scores(table: pa.Table) -> np.ndarray:
        return step[None] + sees[:, table["seen"].to_numpy()].T[:, None, :]

    def fold(table: pa.Table) -> pa.Table:
        table = table.sort_by(_LINE_ORDER)
        return _folded(table, "chunk", scores(table))

    def refold(table: pa.Table) -> pa.Table:
        table = table.sort_by([("conv", "ascending"), ("up", "ascending"), ("idx", "ascending")])
        return _folded(table, "up", _matrices(table))

    def settle(table: pa.Table) -> pa.Table:
        table = table.sort_by([("conv", "ascending"), ("up", "ascending"), ("idx", "ascending")])
        lengths = _runs(table, ["conv", "up"])
        first = np.cumsum(lengths) - lengths
        entry = table["entry"].to_numpy()[first]
        after = best_paths(_matrices(table), lengths, _entering(entry), table["leave"].to_numpy()[first])
        before = np.concatenate([[0], after[:-1]])
        before[first] = entry
        return pa.table([table["conv"], table["idx"], pa.array(before.astype(np.int32)), pa.array(after.astype(np.int32))],
                        names=["conv", "idx", "entry", "leave"])

    def finish(table: pa.Table) -> pa.Table:
        table = table.sort_by(_LINE_ORDER)
        lengths = _runs(table, ["conv", "chunk"])
        first = np.cumsum(lengths) - lengths
        states = best_paths(scores(table), lengths, _entering(table["entry"].to_numpy()[first]), table["leave"].to_numpy()[first])
        return table.select(["conv", "chunk", "seq", "tie", "line", "body", "seen"]).append_column("state", pa.array(states.astype(np.int32)))

    result = f"conv {kind}, chunk long, seq long, tie long, line int, body string, seen int, state int"
    if low == high:
        alone = read.withColumn("entry", F.lit(STATES)).withColumn("leave", F.lit(-1))
        return alone.groupBy(bucket("conv", "chunk")).applyInArrow(finish, result)

    # Upward: a matrix per chunk, then per CHUNK nodes, until each conversation has one node.
    levels = [stored(read.groupBy(bucket("conv", "chunk")).applyInArrow(fold, node), "level")]
    while low != high:
        low, high = low // CHUNK, high // CHUNK
        below = levels[-1].withColumn("up", F.floor(F.col("idx") / CHUNK))
        levels.append(stored(below.groupBy(bucket("conv", "up")).applyInArrow(refold, node), "level"))
    # Downward: the states before and after every node, from the root to the chunks.
    borders = levels[-1].select("conv", "idx", F.lit(STATES).alias("entry"), F.lit(-1).alias("leave"))
    for level in reversed(levels[:-1]):
        known = borders.select(F.col("conv").alias("c"), F.col("idx").alias("up"), "entry", "leave")
        below = level.withColumn("up", F.floor(F.col("idx") / CHUNK))
        asked = below.join(known, below["conv"].eqNullSafe(known["c"]) & (below["up"] == known["up"])).select(
            below["conv"], below["up"], "idx", "score", "entry", "leave")
        borders = stored(asked.groupBy(bucket("conv", "up")).applyInArrow(settle, border), "borders")
    known = borders.select(F.col("conv").alias("c"), F.col("idx").alias("i"), "entry", "leave")
    joined = read.join(known, read["conv"].eqNullSafe(known["c"]) & (read["chunk"] == known["i"])).drop("c", "i")
    return joined.groupBy(bucket("conv", "chunk")).applyInArrow(finish, result)


def turns(recovered: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, start_seq, start_line, role, n_lines, text, rendered) per turn: the lines from
    a first line to the next, markers taken off, as one canonical block."""
    where = F.struct("chunk", "seq", "tie", "line")
    opens = F.when(F.col("state") % 2 == 0, where)
    # The last first line of every chunk tells the next chunks which turn they go on with.
    ends = stored(recovered.groupBy("conv", "chunk").agg(F.max(opens).alias("last"), F.min(where).alias("first")), "ends")
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(F.col("conv").alias("c"), F.col("chunk").alias("k"), F.coalesce(
        F.last("last", ignorenulls=True).over(earlier), F.first("first").over(earlier), F.col("first")).alias("carried"))
    inside = Window.partitionBy("conv", "chunk").orderBy("seq", "tie", "line").rowsBetween(Window.unboundedPreceding, 0)
    placed = recovered.withColumn("own", F.last(opens, ignorenulls=True).over(inside))
    placed = placed.join(ends, placed["conv"].eqNullSafe(ends["c"]) & (placed["chunk"] == ends["k"])).withColumn(
        "turn", F.coalesce("own", "carried"))
    bare = F.col("body")
    for words in MARKS:
        bare = F.when((F.col("seen") >= 16) & F.lower("body").rlike(_MARK.replace("WORDS", words)),
                      F.regexp_replace("body", "(?i)" + _MARK.replace("WORDS", words), "")).otherwise(bare)
    one = placed.withColumn("bare", F.when(F.col("state") % 2 == 0, bare).otherwise(F.col("body")))
    grouped = one.groupBy("conv", "turn").agg(
        F.min(F.struct(where.alias("at"), "state"))["state"].alias("state"), F.count("*").alias("n_lines"),
        F.array_sort(F.collect_list(F.struct("chunk", "seq", "tie", "line", "bare"))).alias("all"))
    role = F.element_at(F.array(*map(F.lit, ROLES)), (F.floor(F.col("state") / 2) + 1).cast("int"))
    text = F.array_join(F.transform("all", lambda x: x["bare"]), "\n")
    return grouped.select(
        F.col("conv").alias(conv), F.col("turn.seq").alias("start_seq"), F.col("turn.line").alias("start_line"), role.alias("role"),
        "n_lines", text.alias("text"), F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n<|end|>")).alias("rendered"))


# Fixed marker styles in which the raw transcripts are written, in the order of ROLES.
STYLES = (
    ("System: ", "User: ", "Assistant: "),
    ("Instructions: ", "Human: ", "AI: "),
    ("### System: ", "### Question: ", "### Answer: "),
    ("[system] ", "[user] ", "[bot] "),
)


def raw_transcripts(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq, text, role): the conversations written down in one of STYLES each,
    with every tenth turn's marker left out. The role is the truth, for training and tests."""
    role = F.lower("role")
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    mark = F.lit("")
    for i, marks in enumerate(STYLES):
        for r, m in zip(ROLES, marks):
            mark = F.when((style == i) & (role == r), F.lit(m)).otherwise(mark)
    kept = F.pmod(F.xxhash64("conv_id", "turn", F.lit("mark")), F.lit(10)) > 0
    return conversations.select("conv_id", F.col("turn").alias("seq"), F.concat(F.when(kept, mark).otherwise(""), "text").alias("text"), "role")
