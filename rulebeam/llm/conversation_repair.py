"""Conversation structure repair by least-cost edits, ranked by prefix doubling.

A conversation is a sequence of rows (role, text). Edits make its role initials ``(s?(ua)+)?``: Keep costs 0, Rerole (to
user or assistant) 1, Delete 2, Insert (an empty user or assistant row, anywhere) 5; a row that is blank or repeats an
earlier one must be deleted, a truncated row that stays costs 5 more. Of the cheapest lists of
edits (the audit) the least in ASCII order is taken.

How: nodes are (rows used, state), the states being start, after system, after user, after
assistant. A cost pass from the end gives each node the cheapest way to the end; arcs on such ways are optimal. Then
nodes are ranked by the least audit of 1, 2, 4, ... letters: the rank of a
node for 2k letters is that of the pair (its rank for k, the rank for k of the node k letters on), and pointers
double with them. A letter decides the node it leads to, so the least prefix has one pointer. The last ranks select each
node's arc, and the doubled pointers give all places of a path at once.

Conversations are cut into blocks of ``2^BLOCK_BITS`` rows, one letter a row, so none passes through one task. Between
blocks costs go through 4 x 4 min-plus matrices, composed by joins with the block 1, 2, 4, ... further on; inside a
block the passes above run for each of the four states it may be entered with; the states met
are composed by the same doubling forwards. Only the hash of a conversation's repaired text is
sequential by its definition: its lines are streamed in order, never held together.

Defined results: null roles and texts count as one space; a null conversation is one of its own; null turns come
first, rows of equal turn by role and SHA-256 of the text; a role whose first letter is not s, u or a is never
kept; a conversation without rows has zeros, an empty audit and the hash of an empty text; extra
columns pass by unread.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import read_table
from .merkle import CRC32
from .numbering import number_rows

BLOCK_BITS = 10
CHUNK = 1 << 16  # rows ranked at once inside a task
SPACE = " \t\n\x0b\x0c\r"
INF = 1 << 40

# Fixed values of the task: states start, S, U, A; costs of edits.
DELETE, INSERT, KEEP, REROLE = 0, 1, 2, 3  # in ASCII order of their initials
COSTS = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
TRUNCATED = 5
NEXT = np.array([2, 2, 3, 2])  # the state after the row that is due in each state
ACCEPT = np.array([0, INF, INF, 0])
# A row is one of 12 letters: (initial s, u, a, other) x (to be deleted, truncated, sound).
LETTERS = "abcdefghijkl"
KEPT = np.full((4, 4), -1)  # [initial, state]: state after keeping it
KEPT[0, 0] = 1
KEPT[1, [0, 1, 3]] = 2
KEPT[2, 2] = 3
LEGAL = {(0, 1), (1, 2), (2, 1)}


def _arcs(symbol: np.ndarray, after: np.ndarray):
    """(costs, next states) [.., state, D K R] of rows, given the costs after them [.., state]."""
    initial, fault = symbol // 3, symbol % 3
    extra = np.where(fault == 1, TRUNCATED, 0)[:, None]
    kept = KEPT[initial]
    no = (fault == 0)[:, None]
    at = np.arange(len(symbol))[:, None]
    costs = np.stack([after + COSTS[DELETE],
                      np.where(no | (kept < 0), INF, extra + COSTS[KEEP] + after[at, np.maximum(kept, 0)]),
                      np.where(no, INF, extra + COSTS[REROLE] + after[:, NEXT])], axis=2)
    state = np.broadcast_to(np.arange(4), kept.shape)
    return costs, np.stack([state, np.maximum(kept, 0), np.broadcast_to(NEXT, kept.shape)], axis=2)


def _inserted(base: np.ndarray) -> np.ndarray:
    """Cheapest with none, one or two rows inserted first (a third one would repeat a state)."""
    one = base[..., NEXT] + COSTS[INSERT]
    return np.minimum(np.minimum(base, one), one[..., NEXT] + COSTS[INSERT])


def cost_matrix(symbols: str, last: bool) -> np.ndarray:
    """[state before, state after]: cheapest edits of a block. The last block may insert after its rows."""
    found = np.where(np.eye(4, dtype=bool), 0, INF)
    if last:
        found = _inserted(found.T).T
    for symbol in np.frombuffer(symbols.encode(), np.uint8)[::-1] - ord("a"):
        costs, _ = _arcs(np.full(4, symbol), found.T)  # one lane per state after the block
        found = np.minimum(_inserted(costs.min(axis=2)), INF).T
    return found


class Ranked:
    """Blocks of rows with their least audits.

    ``symbols``: letters of all blocks; ``first``: block bounds; ``after``: cost to the end from each
    state after the block; ``last``: whether the block ends its conversation."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray, after: np.ndarray, last: np.ndarray):
        self.blocks = len(first) - 1
        self.lengths = np.diff(first)
        self.place = first[:-1] + np.arange(self.blocks)  # of each block's first node row
        rows = len(symbols) + self.blocks
        self.costs = np.zeros((rows, 4), np.int64)
        self.arc_costs = np.full((rows, 4, 4), INF, np.int64)
        self.arc_next = np.zeros((rows, 4, 4), np.int64)
        self._cost_pass(symbols, first, after, last)
        self._rank()

    def _cost_pass(self, symbols, first, after, last):
        end = self.place + self.lengths
        self.costs[end] = np.where(last[:, None], _inserted(np.broadcast_to(ACCEPT, after.shape)), after)
        closing = end[last]
        self.arc_costs[closing, :, INSERT] = COSTS[INSERT] + self.costs[closing][:, NEXT]
        self.arc_next[closing, :, INSERT] = closing[:, None] * 4 + NEXT
        longest_first = np.argsort(-self.lengths, kind="stable")
        sizes = self.lengths[longest_first]
        for back in range(1, int(sizes[0]) + 1 if len(sizes) else 1):
            some = longest_first[:np.searchsorted(-sizes, -back, side="right")]
            at = end[some] - back
            costs, states = _arcs(symbols[first[:-1][some] + self.lengths[some] - back], self.costs[at + 1])
            here = _inserted(costs.min(axis=2))
            self.costs[at] = here
            for j, edit in enumerate((DELETE, KEEP, REROLE)):
                self.arc_costs[at, :, edit] = costs[:, :, j]
                self.arc_next[at, :, edit] = (at[:, None] + 1) * 4 + states[:, :, j]
            self.arc_costs[at, :, INSERT] = COSTS[INSERT] + here[:, NEXT]
            self.arc_next[at, :, INSERT] = at[:, None] * 4 + NEXT

    def _rank(self):
        nodes = self.costs.size
        optimal = (self.arc_costs == self.costs[:, :, None]).reshape(nodes, 4)
        targets = self.arc_next.reshape(nodes, 4)
        own = np.arange(nodes)
        ends = ~optimal.any(axis=1)

        def select(rank):
            """Each node's least optimal arc by letter, then by the rank of its target."""
            keys = np.where(optimal, np.arange(4) * (nodes + 1) + rank[targets], 4 * (nodes + 1))
            return keys.argmin(axis=1)

        arc = select(np.zeros(nodes, np.int64))
        step = np.where(ends, own, targets[own, arc])
        self.pointers = [step]
        length = np.where(ends, 0, 1)
        rank = np.where(ends, 0, arc + 1)
        while not ends[self.pointers[-1]].all():
            step = self.pointers[-1]
            rank = np.unique(rank * (nodes + 5) + rank[step], return_inverse=True)[1].ravel()
            length = length + length[step]
            self.pointers.append(step[step])
        self.arc, self.length = select(rank), length
        # To be read with the arc: who is due (user or assistant) for Rerole and Insert.
        self.to_assistant = targets[own, self.arc] % 4 == 3

    def path(self, entry: np.ndarray):
        """For nodes ``entry``: (letters of all paths, bounds, node reached by each)."""
        sizes = self.length[entry]
        bounds = np.r_[0, np.cumsum(sizes)]
        at = np.repeat(entry, sizes)
        steps = np.arange(int(bounds[-1])) - np.repeat(bounds[:-1], sizes)
        last = entry.copy()
        for k, pointer in enumerate(self.pointers):
            at = np.where((steps >> k) & 1 == 1, pointer[at], at)
            last = np.where((sizes >> k) & 1 == 1, pointer[last], last)
        # D, I, K, R; a row made or inserted for the assistant: S, J.
        arc = self.arc[at]
        names = np.frombuffer(b"DIKRDJKS", np.uint8)[arc + 4 * self.to_assistant[at]]
        return names.tobytes().decode(), bounds, last


def _illegal(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per block: neighbours inside it whose initials do not follow each other."""
    initial = symbols // 3
    legal = np.zeros((4, 4), bool)
    for pair in LEGAL:
        legal[pair] = True
    bad = np.zeros(len(symbols) + 1, np.int64)
    if len(symbols) > 1:
        pairs = ~legal[initial[:-1], initial[1:]]
        pairs[first[1:-1] - 1] = False
        bad[2:] = np.cumsum(pairs)
    # bad[i]: illegal neighbours among the first i rows
    return bad[first[1:]] - bad[first[:-1]]


def _rank_blocks(batches):
    """(conv, block, blocks, symbols, after) to (conv, block, blocks, illegal, cost, edits, reached)."""
    for batch in batches:
        texts = batch.column(3).to_pylist()
        sizes = np.cumsum([len(t) for t in texts])
        lo = 0
        while lo < len(texts):
            done = sizes[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(sizes, done + CHUNK, side="right")))
            symbols = np.frombuffer("".join(texts[lo:hi]).encode(), np.uint8).astype(np.int64) - ord("a")
            first = np.r_[0, sizes[lo:hi] - done]
            block, blocks = (batch.column(i).slice(lo, hi - lo).to_numpy() for i in (1, 2))
            after = np.array([a or [0] * 4 for a in batch.column(4).slice(lo, hi - lo).to_pylist()], np.int64)
            ranked = Ranked(symbols, first, after, block == blocks - 1)
            # A conversation begins in the start state; other blocks may be entered in any.
            ways = np.where(block == 0, 1, 4)
            owner = np.repeat(np.arange(hi - lo), ways)
            state = np.arange(len(owner)) - np.repeat(np.cumsum(ways) - ways, ways)
            letters, bounds, reached = ranked.path(ranked.place[owner] * 4 + state)
            edits = [letters[s:e] for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            offsets = pa.array(np.r_[0, np.cumsum(ways)].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(block), pa.array(blocks), pa.array(_illegal(symbols, first)),
                 pa.array(ranked.costs[ranked.place, 0]), pa.ListArray.from_arrays(offsets, pa.array(edits, pa.string())),
                 pa.ListArray.from_arrays(offsets, pa.array(reached % 4, pa.int64()))],
                names=["conv", "block", "blocks", "illegal", "cost", "edits", "reached"])
            lo = hi


def _matrices(batches):
    for batch in batches:
        block, blocks = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        found = [cost_matrix(s, last).ravel().tolist() for s, last in zip(batch.column(3).to_pylist(), block == blocks - 1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))],
                                         names=["conv", "block", "value"])


def _doubled(table: DataFrame, blocks: int, forwards: bool, join, name: str) -> DataFrame:
    """(conv, block, value) with the values of all blocks up to (or from) each one composed, by joins with the
    block 1, 2, 4, ... away."""
    step = 1
    while step < blocks:
        other = table.select("conv", (F.col("block") + (step if forwards else -step)).alias("block"),
                             F.col("value").alias("other"))
        table = materialize(table.join(other, ["conv", "block"], "left")
                            .select("conv", "block", F.when(F.col("other").isNull(), F.col("value"))
                                    .otherwise(F.expr(join)).alias("value")), name)
        step *= 2
    return table


_TIMES = """transform(sequence(0, 15), i -> array_min(transform(sequence(0, 3),
    j -> get(value, (i div 4) * 4 + j) + get(other, j * 4 + i % 4))))"""
_THEN = "transform(other, q -> get(value, CAST(q AS INT)))"


def rank_edits(rows: DataFrame, block_bits: int = BLOCK_BITS, scratch: str = "repair") -> DataFrame:
    """``rows`` (conv, pos, n, symbol) to one row per block: conv, block, illegal, cost (of the
    conversation, in its block 0), edits (letters D, I, K, R; J and S where the assistant is due)."""
    size = 1 << block_bits
    letters = F.array_sort(F.collect_list(F.struct("pos", "symbol")))
    blocks = materialize(
        rows.groupBy("conv", F.shiftright("pos", block_bits).alias("block"))
        .agg(F.max(F.shiftright(F.col("n") + (size - 1), block_bits)).alias("blocks"),
             F.array_join(F.transform(letters, lambda s: s["symbol"]), "").alias("symbols")), f"{scratch}-blocks")
    most = blocks.agg(F.max("blocks")).first()[0] or 0
    long = blocks.where("blocks > 1").select("conv", "block", "blocks", "symbols")
    matrix = materialize(long.mapInArrow(_matrices, "conv string, block long, value array<long>"), f"{scratch}-matrices")
    suffix = _doubled(matrix, most, False, _TIMES, f"{scratch}-matrices")
    # From each state after a block: the cheaper end state of the rest.
    after = suffix.select("conv", (F.col("block") - 1).alias("block"),
                          F.expr("transform(sequence(0, 3), q -> least(get(value, q * 4), get(value, q * 4 + 3)))").alias("after"))
    ranked = materialize(
        blocks.join(after, ["conv", "block"], "left").select("conv", "block", "blocks", "symbols", "after")
        .mapInArrow(_rank_blocks, "conv string, block long, blocks long, illegal long, cost long, "
                                  "edits array<string>, reached array<long>"), f"{scratch}-ranked")
    # Block 0 has one way in; as a map of states all four lead where the start state leads.
    way = F.when(F.size("reached") == 1, F.array_repeat(F.get("reached", F.lit(0)), 4)).otherwise(F.col("reached"))
    prefix = _doubled(ranked.where("blocks > 1").select("conv", "block", way.alias("value")), most, True, _THEN,
                      f"{scratch}-states")
    entered = prefix.select("conv", (F.col("block") + 1).alias("block"), F.get("value", F.lit(0)).cast("int").alias("state"))
    # Neighbours across two blocks.
    edge = blocks.where("blocks > 1").select("conv", (F.col("block") - 1).alias("block"),
                                             F.substring("symbols", 1, 1).alias("next"))
    edges = (blocks.where("blocks > 1").select("conv", "block", F.substring("symbols", -1, 1).alias("end"))
             .join(edge, ["conv", "block"]))
    legal = F.lit(False)
    for a, b in sorted(LEGAL):
        legal = legal | (F.col("end").isin(list(LETTERS[3 * a:3 * a + 3])) & F.col("next").isin(list(LETTERS[3 * b:3 * b + 3])))
    edges = edges.select("conv", "block", (~legal).cast("long").alias("edge"))
    return (ranked.join(entered, ["conv", "block"], "left").join(edges, ["conv", "block"], "left")
            .select("conv", "block", (F.col("illegal") + F.coalesce("edge", F.lit(0))).alias("illegal"), "cost",
                    F.get("edits", F.coalesce("state", F.lit(0))).alias("edits")))


def _line_hashes(batches):
    """(conv, line) sorted by conv and place: one hash per conversation, line by line."""
    current, running, names, found = None, None, [], []
    for batch in batches:
        for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if conv != current:
                if running is not None:
                    names.append(current)
                    found.append(running.hexdigest())
                current, running = conv, hashlib.sha256()
            else:
                running.update(b"\n")
            running.update(line.encode())
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.string())],
                                             names=["conv", "repaired_sha256"])
            names, found = [], []
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.string()), pa.array([running.hexdigest()])],
                                         names=["conv", "repaired_sha256"])


def _conv() -> Column:
    return F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))


def place_rows(rows: DataFrame, scratch: str = "repair") -> tuple[DataFrame, DataFrame]:
    """``rows`` (conv_id, turn, role, text) as places and texts. Places: conv, turn, role, row, pos, n
    and the first fault of each row (blank, duplicate, truncated or ''); texts: row, role, text. Only the places are sorted."""
    kept = rows.select(_conv().alias("conv"), "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    texts = materialize(kept, f"{scratch}-texts")
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACE)), -1, 1)
    own = F.when(last == "", "blank").when(~last.isin(".", "!", "?"), "truncated").otherwise("")
    slim = texts.select("conv", "turn", "role", "row", F.unhex(F.sha2("text", 256)).alias("digest"), own.alias("own"))
    placed = materialize(number_rows(slim, "conv", ["turn", "role", "digest"], scratch), f"{scratch}-placed")
    # Where a role and text come first; places are unique, so the join back has no hot key.
    first = (placed.groupBy("conv", "role", "digest").agg(F.min("pos").alias("pos"))
             .select("conv", "pos", F.lit(True).alias("new")))
    fault = F.when((F.col("own") != "blank") & F.col("new").isNull(), "duplicate").otherwise(F.col("own"))
    placed = placed.join(first, ["conv", "pos"], "left").withColumn("fault", fault).drop("new", "own", "digest")
    return placed, texts.select("row", "role", "text")


def repaired_rows(placed: DataFrame, texts: DataFrame, edits: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """(conv, pos, step, role, text) of the repaired conversations, in order of pos and step."""
    # The edits of one row: rows inserted before it, its own; after the last row of all, those at the end.
    runs = F.regexp_extract_all("edits", F.lit("[IJ]*[DKRS](?:[IJ]+$)?"), F.lit(0))
    each = (edits.select("conv", "block", F.posexplode(runs).alias("i", "run"))
            .select("conv", (F.shiftleft("block", block_bits) + F.col("i")).alias("pos"), "run"))
    made = F.expr("""filter(transform(split(run, ''), e -> CASE
        WHEN e = 'K' THEN struct(role, text) WHEN e = 'R' THEN struct('user' AS role, text)
        WHEN e = 'S' THEN struct('assistant' AS role, text) WHEN e = 'I' THEN struct('user' AS role, '' AS text)
        WHEN e = 'J' THEN struct('assistant' AS role, '' AS text) END), r -> r IS NOT NULL)""")
    runs = placed.select("conv", "pos", "row").join(each, ["conv", "pos"])
    return (texts.join(runs, "row")
            .select("conv", "pos", F.posexplode(made).alias("step", "made")).select("conv", "pos", "step", "made.role", "made.text"))


def repair(rows: DataFrame, block_bits: int = BLOCK_BITS, scratch: str = "repair") -> tuple[DataFrame, DataFrame]:
    """``rows`` (conv_id, turn, role, text) to a report per conversation (conv, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256) and its repaired rows."""
    placed, texts = place_rows(rows, scratch)
    placed = materialize(placed, f"{scratch}-faults")
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    state = F.when(F.col("fault").isin("blank", "duplicate"), 0).when(F.col("fault") == "truncated", 1).otherwise(2)
    symbol = F.substring(F.lit(LETTERS), kind * 3 + state + 1, F.lit(1))
    edits = materialize(rank_edits(placed.select("conv", "pos", "n", symbol.alias("symbol")), block_bits, scratch),
                        f"{scratch}-edits")
    lines = repaired_rows(placed, texts, edits, block_bits)
    hashes = (lines.select("conv", F.concat_ws(":", "role", "text").alias("line"), "pos", "step").repartition("conv")
              .sortWithinPartitions("conv", "pos", "step").select("conv", "line")
              .mapInArrow(_line_hashes, "conv string, repaired_sha256 string"))
    faults = placed.groupBy("conv").agg(
        *[F.sum((F.col("fault") == f).cast("long")).alias(f) for f in ("blank", "duplicate", "truncated")])
    turns = (placed.where("turn IS NOT NULL").groupBy("conv", "turn").agg(F.lit(1)).groupBy("conv")
             .agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps")))
    audits = edits.groupBy("conv").agg(
        F.sum("illegal").alias("illegal"), F.max(F.when(F.col("block") == 0, F.col("cost"))).alias("cost"),
        F.array_sort(F.collect_list(F.struct("block", "edits"))).alias("parts"))
    audit = F.translate(F.array_join(F.transform("parts", lambda p: p["edits"]), ""), "JS", "IR")
    report = (faults.join(turns, "conv", "left").join(audits, "conv").join(hashes, "conv", "left")
              .select("conv", F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost",
                      audit.alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))
    return report, lines


def damage(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with the faults the task plants, by a checksum of conversation and turn."""
    def text(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    case = F.crc32(F.concat_ws(":", text("conv_id"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role").alias("role"),
                                text("text").alias("text"), case.alias("case")).where("case <> 0")
    rows = rows.withColumns({
        "role": F.when(F.col("case") == 4, "user").otherwise(F.col("role")),
        "text": F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "copy": F.explode(F.when(F.col("case") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))})
    return rows.select("conv_id", "turn", "role", "text")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and hash of the repaired text of every conversation, after damage."""
    source = read_table(spark, sf_dir, "conversations")
    report, _ = repair(damage(source), scratch="conversations")
    all_of = source.groupBy(_conv().alias("conv")).agg(F.min(F.col("conv_id").cast("long")).alias("conv_id"))
    zero = {c: F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return all_of.join(report, "conv", "left").select(
        "conv_id", *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_sql() -> str:
    """The cheapest audits by a recursion over the rows from the last one, all four states at once. Edits and
    repaired lines are carried with the costs, so equal costs are decided by the audit."""
    names = {2: "user", 3: "assistant"}
    due = NEXT.tolist()

    def insert(value: str, state: int) -> str:
        line = f"{names[due[state]]}:"
        return f"{{'c': {value}.c + {COSTS[INSERT]}, 'e': 'I' || {value}.e, 'l': list_prepend('{line}', {value}.l)}}"

    def closed(base: list[str]) -> list[str]:
        """Least of none, one or two rows inserted."""
        out = []
        for q in range(4):
            one, two = due[q], due[due[q]]
            out.append(f"list_min([{base[q]}, {insert(base[one], q)}, "
                       f"(SELECT {insert('x', q)} FROM (SELECT {insert(base[two], one)} AS x))])")
        return out

    def row_arcs(q: int) -> str:
        stays = "f NOT IN ('blank', 'duplicate')"
        extra = f"CASE WHEN f = 'truncated' THEN {TRUNCATED} ELSE 0 END"
        arcs = [f"{{'c': v{q}.c + {COSTS[DELETE]}, 'e': 'D' || v{q}.e, 'l': v{q}.l}}",
                f"CASE WHEN {stays} THEN {{'c': v{due[q]}.c + {COSTS[REROLE]} + {extra}, 'e': 'R' || v{due[q]}.e, "
                f"'l': list_prepend('{names[due[q]]}:' || text, v{due[q]}.l)}} END"]
        for i, initial in enumerate("sua"):
            to = int(KEPT[i, q])
            if to >= 0:
                arcs.append(f"CASE WHEN {stays} AND role[1] = '{initial}' THEN {{'c': v{to}.c + {extra}, 'e': 'K' || v{to}.e, "
                            f"'l': list_prepend(role || ':' || text, v{to}.l)}} END")
        return f"list_min(list_filter([{', '.join(arcs)}], lambda x: x IS NOT NULL)) AS b{q}"

    none = "{'c': 0, 'e': '', 'l': []::VARCHAR[]}"
    far = f"{{'c': {INF}, 'e': '', 'l': []::VARCHAR[]}}"
    ends = ", ".join(f"{none if ACCEPT[q] == 0 else far} AS b{q}" for q in range(4))
    values = ", ".join(f"{sql} AS v{q}" for q, sql in enumerate(closed([f"b{q}" for q in range(4)])))
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE src AS (
  SELECT row_number() OVER () AS r, CAST(conv_id AS BIGINT) AS conv_id, coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv, turn,
         coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {CRC32.format("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS k
  FROM conversations),
hurt AS (
  SELECT conv, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE k WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM src WHERE k <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         rtrim(text, {space}) AS t FROM hurt),
met AS (SELECT *, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) AS nth,
               lead(role[1]) OVER (PARTITION BY conv ORDER BY i) AS follower FROM placed),
faults AS (
  SELECT *, CASE WHEN t = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN t[-1] NOT IN ('.', '!', '?') THEN 'truncated'
                 ELSE '' END AS f,
         CASE WHEN follower IS NOT NULL AND role[1] || follower NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END AS bad FROM met),
sums AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
         count(*) FILTER (f = 'blank') AS blank, count(*) FILTER (f = 'duplicate') AS duplicate,
         count(*) FILTER (f = 'truncated') AS truncated, sum(bad) AS illegal FROM faults GROUP BY conv),
way AS (
  SELECT conv, n AS i, {values} FROM (SELECT conv, n, {ends} FROM sums)
  UNION ALL
  SELECT conv, i - 1, {values}
  FROM (SELECT conv, i, {', '.join(row_arcs(q) for q in range(4))} FROM way JOIN faults USING (conv, i))),
best AS (SELECT conv, v0 FROM way WHERE i = 0)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
       CAST(coalesce(v0.c, 0) AS BIGINT) AS cost, coalesce(v0.e, '') AS audit,
       sha256(coalesce(array_to_string(v0.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT conv, min(conv_id) AS conv_id FROM src GROUP BY conv) o LEFT JOIN sums USING (conv) LEFT JOIN best USING (conv)
"""
