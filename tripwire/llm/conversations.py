"""Conversation repair at least cost, ties by the least audit, by prefix doubling.

A conversation is a path through a graph: nodes are (row boundary, role state),
arcs are edits. The cost to the end of every node follows by dynamic programming.
Of the arcs on cheapest paths every node keeps that with the least letter (two
arcs of a node never share a letter, since the grammar fixes which role follows).
The nodes are ranked by the first 1, 2, 4, ... letters of their audits: the rank
for twice the length is that of the pair (rank, rank of the node so many letters
on), and the pointers double with it. The path of the least audit is read off the
doubled pointers, all its letters at once.

Rows are cut into segments of a bounded number of rows. A segment acts on the
costs as a 4 x 4 matrix in (min, +), and on the states of the least path as a map
of 4 states, so a conversation of any length is joined from one matrix and one map
a segment; nothing gathers its rows in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.llm.common import drop_path, write_once

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the only role that may follow each state besides a kept system row.
FOLLOWS = np.array([USER, USER, ASSISTANT, USER])
#: Cost from each state at the end of a conversation: legal, or by inserted turns.
AT_END = np.array([0, 10, 5, 0], np.int64)
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
FAR = 1 << 40
#: Rows of a segment, as a power of two: of a shuffle task's sorted rows.
SEGMENT_BITS = 16
WORD = r"[^\x20\x09-\x0D]"
#: An end that is no sentence end, with the white space after it.
UNENDED = r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"
LETTERS = np.array([b"D", b"I", b"K", b"R"])  # in the order of ASCII


def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) after a seeded damage by crc32(``conv_id:turn``) % 20:
    0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the
    row, 4 makes its role user. Null roles, texts and parts of the key are one space."""
    c, t = F.col(conv_col), F.col(turn_col)
    key = F.concat_ws(":", *[F.coalesce(x.cast("string"), F.lit(" ")) for x in (c, t)])
    text, role, kind = (F.coalesce(F.col(text_col).cast("string"), F.lit(" ")), F.coalesce(F.col(role_col).cast("string"), F.lit(" ")),
                        F.crc32(key.cast("binary")) % 20)
    rows = df.select(c.alias("conv_id"), t.alias("turn"), F.when(kind == 4, "user").otherwise(role).alias("role"),
                     F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), kind.alias("kind")).filter("kind <> 0")
    return rows.withColumn("again", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("kind", "again")


# ---- the graph of a block of segments ------------------------------------------------

class Block:
    """Segments one after the other, with their rows in order.

    ``first``: whether a row begins a segment; ``role``: SYSTEM, USER, ASSISTANT or
    0 (any other); ``forced``: blank or duplicate; ``cut``: truncated; ``copies``:
    how often the row occurs in a place (all but the first are duplicates)."""

    def __init__(self, first, role, forced, cut, copies):
        self.start = np.flatnonzero(first)
        self.size = np.diff(np.r_[self.start, len(first)])
        self.segment = np.repeat(np.arange(len(self.start)), self.size)
        self.place = np.arange(len(first)) + self.segment  # each segment has one boundary more than rows
        self.role, self.forced, self.cut, self.copies = role, forced, cut, copies
        self.n = len(first) + len(self.start)
        self.begin = self.start + np.arange(len(self.start))
        self.end = self.begin + self.size

    def moves(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cost of Delete, cost and state of Keep or Rerole per state) of the rows ``i``."""
        drop = DELETE * self.copies[i]
        stay = DELETE * (self.copies[i] - 1) + CUT * self.cut[i] + np.where(self.forced[i], FAR, 0)
        return drop, stay, self.role[i]

    def costs(self, right: np.ndarray) -> np.ndarray:
        """Cost to the end from each boundary and state, for the costs ``right``
        (segment, state, case) at the ends of the segments."""
        c = np.empty((self.n, 4, right.shape[2]), np.int64)
        c[self.end] = right
        order = np.argsort(-self.size, kind="stable")
        longest = self.size[order]
        for back in range(1, int(longest[0]) + 1 if len(longest) else 0):
            s = order[: np.searchsorted(-longest, -back, "right")]
            i, p = self.start[s] + self.size[s] - back, self.end[s] - back
            drop, stay, role = self.moves(i)
            after = c[p + 1]
            best = after + drop[:, None, None]
            for st in range(4):
                nxt = FOLLOWS[st]
                best[:, st] = np.minimum(best[:, st], after[:, nxt] + (stay + np.where(role == nxt, 0, REROLE))[:, None])
                if st == START:
                    system = np.where(role == SYSTEM, stay, FAR)
                    best[:, st] = np.minimum(best[:, st], after[:, SYSTEM] + system[:, None])
            once = np.minimum(best, INSERT + best[:, FOLLOWS])
            c[p] = np.minimum(once, INSERT + once[:, FOLLOWS])
        return np.minimum(c, FAR)

    def arcs(self, right: np.ndarray, closed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(letter, next node) of every node (boundary * 4 + state): of the arcs on
        cheapest paths that with the least letter; -1 and itself where an audit ends:
        at the end of a segment, in a ``closed`` one after its last insertion."""
        c = self.costs(right[:, :, None])[:, :, 0]
        node = np.arange(self.n * 4).reshape(self.n, 4)
        letter, to = np.full((self.n, 4), -1, np.int8), node.copy()
        i = np.arange(len(self.role))
        p = self.place
        drop, stay, role = self.moves(i)
        for st in range(4):
            nxt = FOLLOWS[st]
            here = c[p, st]
            # from the greatest letter to the least, so that the least one stays
            options = [(3, nxt, stay + REROLE), (2, nxt, np.where(role == nxt, stay, FAR))]
            if st == START:
                options.append((2, SYSTEM, np.where(role == SYSTEM, stay, FAR)))
            for code, state, cost in options:
                fits = (here == cost + c[p + 1, state]) & (here < FAR)
                letter[p[fits], st], to[p[fits], st] = code, node[p[fits] + 1, state]
            fits = (here == INSERT + c[p, nxt]) & (here < FAR)
            letter[p[fits], st], to[p[fits], st] = 1, node[p[fits], nxt]
            fits = (here == drop + c[p + 1, st]) & (here < FAR)
            letter[p[fits], st], to[p[fits], st] = 0, node[p[fits] + 1, st]
        e = self.end[closed]
        for st in (SYSTEM, USER):
            letter[e, st], to[e, st] = 1, node[e, FOLLOWS[st]]
        return letter.ravel(), to.ravel()


class Ranks:
    """Doubled pointers and audit lengths of all nodes, with the nodes' ranks by
    their least audits (0: the empty one)."""

    def __init__(self, letter: np.ndarray, to: np.ndarray):
        self.letter = letter
        self.pointers = [to.astype(np.int32)]
        self.length = (letter >= 0).astype(np.int64)
        self.rank = letter.astype(np.int64) + 1
        while True:
            ptr = self.pointers[-1]
            if not (letter[ptr] >= 0).any():
                break
            pair = self.rank * (self.rank.max() + 1) + self.rank[ptr]
            self.rank = np.unique(pair, return_inverse=True)[1]
            self.length = self.length + self.length[ptr]
            self.pointers.append(ptr[ptr])

    def ends(self, nodes: np.ndarray) -> np.ndarray:
        return self.pointers[-1][nodes]

    def paths(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``nodes``, node) of every letter of their least audits, in order:
        step t of a path by the pointers of the binary digits of t."""
        size = self.length[nodes]
        which = np.repeat(np.arange(len(nodes)), size)
        step = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        at = nodes[which]
        for k, ptr in enumerate(self.pointers):
            on = (step >> k & 1).astype(bool)
            at[on] = ptr[at[on]]
        return which, at


def _block(batch: pa.Table) -> Block:
    num = {c: batch.column(c).to_numpy() for c in ("seg", "role_state", "forced", "cut", "copies")}
    conv, first = batch.column("conv_id").combine_chunks(), np.ones(batch.num_rows, bool)
    if batch.num_rows > 1:
        null = conv.is_null().to_numpy(zero_copy_only=False)
        same = pc.fill_null(pc.equal(conv[1:], conv[:-1]), False).to_numpy(zero_copy_only=False) | (null[1:] & null[:-1])
        first[1:] = ~same | (num["seg"][1:] != num["seg"][:-1])
    return Block(first, num["role_state"], num["forced"].astype(bool), num["cut"].astype(np.int64), num["copies"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of whole segments at a time: rows come sorted by segment."""
    held: list[pa.Table] = []
    for batch in batches:
        seg = batch.column("seg").to_numpy()
        if not len(seg):
            continue
        cut = int(np.searchsorted(seg, seg[-1], "left")) if seg[0] != seg[-1] else (0 if not held or held[-1].column("seg")[-1].as_py() == seg[0] else -1)
        table = pa.Table.from_batches([batch])
        if cut == -1:  # the held segment is complete, and the batch is one segment
            yield pa.concat_tables(held)
            held = [table]
        elif cut == 0:
            held.append(table)
        else:
            yield pa.concat_tables([*held, table.slice(0, cut)])
            held = [table.slice(cut)]
    if held:
        yield pa.concat_tables(held)


def _by_segment(rows: DataFrame) -> DataFrame:
    return rows.repartition("seg").sortWithinPartitions("seg", "rid")


def _matrices(rows: DataFrame) -> DataFrame:
    """(conv_id, seg, m, head, tail): the (min, +) matrix of each segment, row by
    row, and the roles of its first and last row."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        for table in _blocks(batches):
            b = _block(table)
            unit = np.where(np.eye(4, dtype=bool), 0, FAR).astype(np.int64)
            m = b.costs(np.broadcast_to(unit, (len(b.start), 4, 4)).copy())[b.begin].reshape(-1, 16)
            yield pa.RecordBatch.from_arrays([table.column("conv_id").combine_chunks().take(pa.array(b.start)), table.column("seg").combine_chunks().take(pa.array(b.start)),
                                              pa.array(list(m), pa.list_(pa.int64())), pa.array(b.role[b.start].astype(np.int32)),
                                              pa.array(b.role[b.start + b.size - 1].astype(np.int32))], ["conv_id", "seg", "m", "head", "tail"])

    return _by_segment(rows).mapInArrow(run, f"conv_id {kind}, seg long, m array<long>, head int, tail int")


SIDE = "seg long, right array<long>, closed boolean, joint long"


def illegal(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Whether a role may not follow another: legal are system-user, user-assistant, assistant-user."""
    return ~(((after == USER) & ((before == SYSTEM) | (before == ASSISTANT))) | ((after == ASSISTANT) & (before == USER)))


def _right(matrices: DataFrame) -> DataFrame:
    """(conv_id, seg, right, closed, joint): the costs at the end of each segment,
    from those of the next one backwards, and whether its first row may not follow
    the row before it; one row a segment, not its rows."""
    def run(_, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seg")
        cost, out = AT_END, []
        for m in pdf["m"].to_numpy()[::-1]:
            out.append(cost)
            cost = np.minimum((np.asarray(m).reshape(4, 4) + cost).min(axis=1), FAR)
        return pd.DataFrame({"conv_id": pdf["conv_id"], "seg": pdf["seg"], "right": out[::-1], "closed": [False] * (len(out) - 1) + [True],
                             "joint": np.r_[False, illegal(pdf["tail"].to_numpy()[:-1], pdf["head"].to_numpy()[1:])].astype(np.int64)})

    return _by_conv(matrices, run, f"{SIDE}")


def _entries(exits: DataFrame) -> DataFrame:
    """(conv_id, seg, right, closed, joint, entry): the state in which the least path enters each segment."""
    def run(_, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seg")
        state, out = START, []
        for to in pdf["exits"]:
            out.append(state)
            state = int(to[state])
        return pdf.drop(columns="exits").assign(entry=out)

    return _by_conv(exits, run, f"{SIDE}, entry int")


def _by_conv(df: DataFrame, run, schema: str) -> DataFrame:
    kind = df.schema["conv_id"].dataType.simpleString()
    return df.groupBy("conv_id").applyInPandas(run, f"conv_id {kind}, {schema}")


def _solve(rows: DataFrame, entries: bool) -> DataFrame:
    """Rows with SIDE (null: the whole conversation is this segment) through the
    graph. With ``entries``, (rid, letters, states, illegal): the letters up to and
    with each row's own (in the last row also what is inserted behind it), the
    initials of the roles that they lead to, '-' for a deletion, and the pairs with
    the row before that are not legal. Without, (conv_id, SIDE, exits): the state
    in which each state leaves the segment."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    side = ["conv_id", "seg", "right", "closed", "joint"]

    def run(batches):
        for table in _blocks(batches):
            b = _block(table)
            lead = table.take(pa.array(b.start))
            right = np.array([AT_END if x is None else x for x in lead.column("right").to_pylist()], np.int64).reshape(-1, 4)
            closed = pc.fill_null(lead.column("closed"), True).to_numpy()
            ranks = Ranks(*b.arcs(right, closed))
            if not entries:
                exits = ranks.ends((b.begin[:, None] * 4 + np.arange(4)).ravel()).reshape(-1, 4) % 4
                yield pa.RecordBatch.from_arrays([lead.column(c).combine_chunks() for c in side]
                                                 + [pa.array(list(exits.astype(np.int32)), pa.list_(pa.int32()))], [*side, "exits"])
                continue
            entry = pc.fill_null(lead.column("entry"), START).to_numpy().astype(np.int64)
            which, at = ranks.paths(b.begin * 4 + entry)
            code = ranks.letter[at]
            state = np.where(code == 0, b"-", np.array([b"-", b"s", b"u", b"a"])[ranks.pointers[0][at] % 4])
            row = np.minimum(at // 4 - which, b.start[which] + b.size[which] - 1)  # of the boundary; behind the last row, the last
            ends = np.searchsorted(row, np.arange(len(b.role) + 1)).tolist()
            letters, states = LETTERS[code].tobytes().decode(), state.astype("S1").tobytes().decode()
            wrong = np.r_[0, illegal(b.role[:-1], b.role[1:])].astype(np.int64)
            wrong[b.start] = pc.fill_null(lead.column("joint"), 0).to_numpy()
            yield pa.RecordBatch.from_arrays([
                table.column("rid").combine_chunks(), pa.array([letters[x:y] for x, y in zip(ends, ends[1:])], pa.string()),
                pa.array([states[x:y] for x, y in zip(ends, ends[1:])], pa.string()), pa.array(wrong + b.copies - 1)], ["rid", "letters", "states", "illegal"])

    schema = "rid long, letters string, states string, illegal long" if entries else f"conv_id {kind}, {SIDE}, exits array<int>"
    return _by_segment(rows).mapInArrow(run, schema)


# ---- the operator --------------------------------------------------------------------

def _key(*cols: str) -> Column:
    """One 128-bit name of a row by the columns given; null has a name of its own."""
    return F.unhex(F.md5(F.concat(*[F.coalesce(F.md5(F.col(c).cast("string").cast("binary")), F.lit("null")) for c in cols])))


def _ordered(turns: DataFrame, segment_bits: int) -> tuple[DataFrame, str]:
    """The different rows of all conversations, without texts, once each with its
    number of copies, written in order: ``rid`` rises with (conversation, turn,
    role, MD5 of the text), nulls first. ``seg``: the segment of a row."""
    state = F.substring("role", 1, 1)
    slim = turns.select("conv_id", "turn", "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("d"), "k", (~F.col("text").rlike(WORD)).alias("blank"),
                        F.col("text").rlike(UNENDED).alias("unended"))
    slim = slim.groupBy("conv_id", "turn", "role", "d", "k", "blank", "unended").agg(F.count("*").alias("copies"))
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    said = slim.filter("NOT blank").groupBy(_key("conv_id", "role").alias("who"), "d").agg(F.min(when).alias("earliest"), F.count("*").alias("n")) \
        .filter("n > 1").select("who", "d", "earliest")
    rows = slim.withColumn("who", _key("conv_id", "role")).join(said, ["who", "d"], "left").select(
        "conv_id", "turn", "role", "d", "k", "blank", (~F.col("blank") & F.coalesce(when > F.col("earliest"), F.lit(False))).alias("repeated"), "unended", "copies")
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "d")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("rid", F.monotonically_increasing_id())
    return write_once(rows.select(
        "conv_id", "turn", "role", "k", "rid", F.shiftright("rid", segment_bits).alias("seg"), "blank", (F.col("blank") | F.col("repeated")).alias("forced"),
        (F.col("unended") & ~F.col("blank") & ~F.col("repeated")).alias("cut"), "copies",
        F.when(state == "s", SYSTEM).when(state == "u", USER).when(state == "a", ASSISTANT).otherwise(0).alias("role_state")), "turns")


def repair(turns: DataFrame, segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """The cheapest repair of each conversation of ``turns(conv_id, turn, role, text)``.

    Rows are taken by turn (nulls first), rows of one turn by role and the MD5 of
    the text, equal rows one after the other. Null roles and texts are one space, a
    null conv_id is a conversation of its own. A row is blank (no word), a duplicate
    (role and text seen earlier) or truncated (its last character but white space is
    not one of ``.!?``), the first of them counts. Edits, in the order of a repaired
    conversation: K(eep) 0, R(erole) to user or assistant 1, D(elete) 2 (required
    for blank and duplicate rows), I(nsert) an empty user or assistant turn 5;
    truncated rows that stay add 5. The result's role initials match
    ``(s?(ua)+)?``, its cost is least, and of the cheapest edits the letters are the
    least in ASCII. The least audit fixes the repair.

    One row per different input row: (conv_id, rid, turn, copies, audit, added,
    blank, duplicate, truncated, illegal, cost). By ``rid``, ``audit`` is the row's
    letters, ``added`` the repaired turns (role, text) that they give, and the
    counts are of its faults, of its pairs with the row before that may not follow
    each other, and its cost. An empty table gives an empty result; other columns
    are not read; a text may be as long as Spark holds.
    """
    turns = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                         F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text")).withColumn("k", _key("conv_id", "turn", "role", "text"))
    rows, rows_path = _ordered(turns, segment_bits)
    spark, old = rows.sparkSession, [rows_path]
    need = rows.select("conv_id", "seg", "rid", "role_state", "forced", "cut", "copies")
    # conversations that reach over a border of segments: at most one per border
    over = rows.groupBy("conv_id").agg(F.min("seg").alias("lo"), F.max("seg").alias("hi")).filter("lo < hi").select(F.col("conv_id").alias("long_id"))
    long_rows = need.join(over, F.col("conv_id").eqNullSafe(F.col("long_id")), "left_semi")
    right, path = write_once(_right(_matrices(long_rows)), "right")
    old.append(path)

    def beside(table: DataFrame, side: DataFrame, how: str) -> DataFrame:
        side = side.withColumnRenamed("conv_id", "side_id").withColumnRenamed("seg", "side_seg")
        return table.join(side, F.col("conv_id").eqNullSafe(F.col("side_id")) & (F.col("seg") == F.col("side_seg")), how).drop("side_id", "side_seg")

    entry, path = write_once(_entries(_solve(beside(long_rows, right, "inner"), entries=False)), "entry")
    old.append(path)
    solved = _solve(beside(need, entry, "left"), entries=True)
    texts = turns.groupBy("k").agg(F.first("text").alias("text"))
    stays = F.col("letters").rlike("[KR]")
    added = F.expr("""filter(transform(sequence(1, length(letters)), i -> CASE WHEN substr(states, i, 1) <> '-' THEN named_struct(
        'role', CASE WHEN substr(letters, i, 1) = 'K' THEN role WHEN substr(states, i, 1) = 'u' THEN 'user' ELSE 'assistant' END,
        'text', CASE WHEN substr(letters, i, 1) = 'I' THEN '' ELSE text END) END), x -> x IS NOT NULL)""")
    count = lambda letter: F.length("letters") - F.length(F.translate("letters", letter, ""))
    out, _ = write_once(rows.join(solved, "rid").join(texts, "k").select(
        "conv_id", "rid", "turn", "copies",
        F.concat(F.expr("substr(letters, 1, length(regexp_extract(letters, '^I*', 0)) + 1)"), F.expr("repeat('D', CAST(copies - 1 AS INT))"),
                 F.expr("substr(letters, length(regexp_extract(letters, '^I*', 0)) + 2)")).alias("audit"), added.alias("added"),
        F.when(F.col("blank"), F.col("copies")).otherwise(0).alias("blank"),
        F.when(F.col("blank"), 0).when(F.col("forced"), F.col("copies")).otherwise(F.col("copies") - 1).alias("duplicate"),
        F.col("cut").cast("long").alias("truncated"), "illegal",
        (REROLE * count("R") + DELETE * (count("D") + F.col("copies") - 1) + INSERT * count("I") + F.when(F.col("cut") & stays, CUT).otherwise(0)).cast("long").alias("cost")), "repaired")
    drop_path(spark, *old)
    return out


def report(repaired: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per conversation of ``ids(conv_id)``, also of those without a row in
    ``repaired`` (zeros, an empty audit, the hash of nothing): (conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256).

    gaps: the turn numbers missing between the least and the greatest. The digest
    of the repaired ``role:text`` lines, newline-joined, can only be computed in
    order: a conversation's rows pass one task as a sorted stream, and nothing but
    its letters is held."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    line = F.array_join(F.transform("added", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")
    rows = repaired.select("conv_id", "rid", F.col("turn").cast("decimal(20,0)").cast("string").alias("turn"), "audit", F.when(F.size("added") > 0, line).alias("lines"),
                           "blank", "duplicate", "truncated", "illegal", "cost")
    marks = ids.select("conv_id").distinct().select("conv_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields[1:]])
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = object(), None

        def row():
            lo, hi, seen = state["turns"]
            return (at, hi - lo + 1 - seen if seen else 0, *state["n"], "".join(state["audit"]), state["sha"].hexdigest())

        def table(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names)

        names = ["conv_id", "gaps", *counts, "audit", "repaired_sha256"]
        types = None
        for batch in batches:
            types = [batch.schema.field("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
            found = []
            cols = {c: batch.column(c).to_pylist() for c in batch.schema.names}
            for i, conv in enumerate(cols["conv_id"]):
                if state is None or conv != at or (conv is None) != (at is None):
                    if state is not None:
                        found.append(row())
                    at, state = conv, {"turns": (0, 0, 0), "n": [0] * 5, "audit": [], "sha": hashlib.sha256(), "any": False}
                if cols["rid"][i] is None:
                    continue
                for j, c in enumerate(counts):
                    state["n"][j] += cols[c][i]
                state["audit"].append(cols["audit"][i])
                if cols["turn"][i] is not None:
                    turn = int(cols["turn"][i])
                    lo, hi, seen = state["turns"]
                    state["turns"] = (lo if seen else turn, turn, seen + (not seen or turn != hi))
                if cols["lines"][i] is not None:
                    state["sha"].update((b"\n" if state["any"] else b"") + cols["lines"][i].encode())
                    state["any"] = True
            if found:
                yield table(found)
        if state is not None:
            yield table([row()])

    fields = ", ".join(f"{c} long" for c in counts)
    return rows.union(marks).repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("rid").asc_nulls_first()) \
        .mapInArrow(run, f"conv_id {kind}, gaps long, {fields}, audit string, repaired_sha256 string")
