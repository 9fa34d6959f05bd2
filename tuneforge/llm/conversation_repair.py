"""Conversation structure repair: the cheapest edits that give a conversation the form (s?(ua)+)?.

A conversation's rows, by turn (nulls first; equal turns by role, then by the text's SHA-256; repeated rows side by
side), are kept (0), given the role the form expects (rerole, 3), deleted (4), or an empty-text row of the expected
role is inserted before them or at the end (3). Blank rows and repeats of an earlier (role, text) must go; a
truncated row that stays costs 3 more. Of equally cheap audits (the edits' initials D, I, K, R in order) the
ASCII-least counts.

A node is (row, state): the state is nothing yet, after s, after u or after a, so each edit leads to one node.

1. *Cost DP.* Costs to go, from the last row to the first; arcs that keep to them are optimal.
2. *Prefix-doubling path ranking.* Nodes of the optimal-arc graph are ranked by the least audits of length 1 that leave
   them, which selects each node's arc; then by lengths 2, 4, 8, ...: a rank of length 2n is that of (rank of
   length n, rank of length n at the doubled pointer). The path from a node is read off the doubled pointers.

No task holds a conversation. Rows are sorted by ranges and cut into pieces of at most ``PIECE`` rows. A piece's costs are
a 4 x 4 (min, +) matrix, its paths a map of 4 states; both are combined over a conversation's pieces by a tree
of ``FAN`` children a node, up and down, so each piece learns the costs after it and the state before it.
Equal rows of a turn are counted before any shuffle: all but the first are deleted in any case. Texts are
shuffled with the count and once more to be hashed; since the repaired text has one SHA-256, its rows pass through one
task as a stream, which holds a batch of rows and the audit, an output value.

Defined cases: a null role or text is one space (``damage`` likewise takes a null id or turn as one); null
conversation ids are one conversation; an empty role has no initial and can only be reroled or deleted; very long
texts pass whole; an empty table gives an empty result; other columns are left out, whatever their names."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_key, written

PIECE_BITS = 10  # rows of a piece: 1,024
FAN_BITS = 10
BATCH_ROWS = 50_000  # rows solved at once
INF = 1 << 50
# States: 0 nothing yet, 1 after s, 2 after u, 3 after a. The state after the row that a state expects:
NEXT = np.array([2, 2, 3, 2])
EXPECTED = ["user", "user", "assistant", "user"]
# The state after a kept row whose role has this initial (s, u, a, other), or -1.
KEPT = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
CLOSING = ["", "II", "I", ""]  # inserts that end a conversation from each state
FINAL = np.array([3 * len(x) for x in CLOSING])
SOUND, TRUNCATED, GONE = 0, 1, 2  # faults; a row's code is 3 x initial + fault
LETTERS = b"\0DIKR"

SPACE = r"[\x20\x09-\x0D]"


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows damaged by crc32(``conv:turn``) mod 20: 0 dropped, 1 text emptied, 2 its [.!?] removed, 3 repeated, 4 role user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(conv), F.lit(":"), space(turn))) % 20
    rows = rows.select(F.col(conv), F.col(turn), space(role).alias(role), space(text).alias(text), kind.alias("_tf_kind")).filter("_tf_kind <> 0")
    k = F.col("_tf_kind")
    return rows.select(
        F.col(conv), F.col(turn), F.when(k == 4, F.lit("user")).otherwise(F.col(role)).alias(role),
        F.when(k == 1, F.lit("")).when(k == 2, F.translate(text, ".!?", "")).otherwise(F.col(text)).alias(text),
        F.explode(F.when(k == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_tf_copy")).drop("_tf_copy")


# ---------------------------------------------------------------- one batch of pieces


class Pieces:
    """Pieces of conversations, solved side by side. ``codes``: those of all rows; ``lens``: rows of each piece."""

    def __init__(self, codes: np.ndarray, lens: np.ndarray):
        self.codes, self.lens = codes, lens
        self.starts = np.cumsum(lens) - lens
        self.base = 4 * (self.starts + np.arange(len(lens)))  # first node of each piece: 4 a row and 4 at its end

    def costs(self, ends: np.ndarray, arcs: bool = False):
        """Costs to go (pieces, 4) at each piece's start, given those after it; with ``arcs`` also each node's
        optimal arc of the least letter: (letter, target)."""
        now = ends.copy()
        if arcs:
            nodes = 4 * (len(self.codes) + len(self.lens))
            letter, target = np.zeros(nodes, np.int64), np.arange(nodes)
        for i in range(int(self.lens.max(initial=0)) - 1, -1, -1):
            at = np.flatnonzero(self.lens > i)
            code = self.codes[self.starts[at] + i]
            gone, extra = (code % 3 == GONE)[:, None], 3 * (code % 3 == TRUNCATED)[:, None]
            after = now[at]
            to = KEPT[:, code // 3].T  # (pieces, 4)
            keep = np.where(gone | (to < 0), INF, extra + np.take_along_axis(after, np.maximum(to, 0), 1))
            rerole = np.where(gone, INF, 3 + extra + after[:, NEXT])
            row = np.minimum(np.minimum(keep, rerole), 4 + after)
            best = np.minimum(row, 3 + np.minimum(row[:, NEXT], 3 + row[:, NEXT[NEXT]]))
            now[at] = best
            if arcs:
                node = self.base[at][:, None] + 4 * i + np.arange(4)
                follow = self.base[at][:, None] + 4 * (i + 1)
                # From the greatest letter to the least, so that the least optimal one stays.
                for k, cost, goal in ((4, rerole, follow + NEXT), (3, keep, follow + np.maximum(to, 0)),
                                      (2, 3 + best[:, NEXT], node - np.arange(4) + NEXT), (1, 4 + after, follow + np.arange(4))):
                    hit = (cost == best) & (cost < INF)
                    letter[node[hit]], target[node[hit]] = k, goal[hit]
        return (now, letter, target) if arcs else now

    def matrices(self) -> np.ndarray:
        """(pieces, 4, 4): cost from each state before a piece to each state after it."""
        out = np.empty((len(self.lens), 4, 4), np.int64)
        for e in range(4):
            ends = np.full((len(self.lens), 4), INF, np.int64)
            ends[:, e] = 0
            out[:, :, e] = np.minimum(self.costs(ends), INF)
        return out

    def ranked(self, ends: np.ndarray):
        """(letters, ranks, pointers of 1, 2, 4, ... letters, letters left) of the nodes, by prefix doubling."""
        _, letter, target = self.costs(ends, arcs=True)
        rank, pointers, left = letter, [target], (letter > 0).astype(np.int64)
        while (letter[pointers[-1]] > 0).any():
            last = pointers[-1]
            _, rank = np.unique(rank * (rank.max() + 1) + rank[last], return_inverse=True)
            left = left + left[last]
            pointers.append(last[last])
        return letter, rank, pointers, left

    def moves(self, ends: np.ndarray) -> np.ndarray:
        """(pieces, 4): the state after each piece, on the least path from each state before it."""
        _, _, pointers, _ = self.ranked(ends)
        return pointers[-1][self.base[:, None] + np.arange(4)] - (self.base + 4 * self.lens)[:, None]

    def audits(self, ends: np.ndarray, entry: np.ndarray) -> list[bytes]:
        letter, _, pointers, left = self.ranked(ends)
        first = self.base + entry
        n = left[first]
        node, step = np.repeat(first, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        for k, jump in enumerate(pointers):
            node = np.where(step >> k & 1, jump[node], node)
        flat = np.frombuffer(LETTERS, np.uint8)[letter[node]].tobytes()
        cut = np.cumsum(n)
        return [flat[e - m:e] for e, m in zip(cut.tolist(), n.tolist())]


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, Pieces]]:
    """Parts of a batch with about ``BATCH_ROWS`` rows in their pieces."""
    lens = np.array([len(x) for x in batch.column("codes").to_pylist()], np.int64) if batch.num_rows else np.zeros(0, np.int64)
    part = np.cumsum(lens) // BATCH_ROWS
    for p in np.unique(part):
        at = np.flatnonzero(part == p)
        some = batch.slice(at[0], len(at))
        yield some, Pieces(np.array(some.column("codes").flatten().to_numpy(zero_copy_only=False), np.int64), lens[at])


def _ends(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(batch.column("ends").flatten().to_numpy(zero_copy_only=False), np.int64).reshape(-1, 4)


def _solved(pieces: DataFrame, solve, schema: str) -> DataFrame:
    """``pieces`` with their column codes replaced by what ``solve(batch, Pieces)`` gives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, p in _batches(batch):
                name, values = solve(some, p)
                kept = [c for c in some.schema.names if c not in ("codes", "ends", name)]
                yield pa.RecordBatch.from_arrays([*[some.column(c) for c in kept], values], names=[*kept, name])

    return pieces.mapInArrow(run, schema)


# ---------------------------------------------------------------- over the pieces of a conversation


def _cheapest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(min, +) product of 4 x 4 matrices: a, then b."""
    a, b = a.reshape(4, 4), b.reshape(4, 4)
    return np.minimum((a[:, :, None] + b[None]).min(1), INF).ravel()


def _onward(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Map a, then map b."""
    return b[a]


UNIT_COSTS = np.where(np.eye(4, dtype=bool), 0, INF).ravel()
UNIT_MOVES = np.arange(4)


def scan(pieces: DataFrame, combine, unit: np.ndarray, backward: bool) -> DataFrame:
    """(c, at, outer): for each piece (c, at, value) the product of its conversation's values after it
    (``backward``) or before it. A tree: ``2^FAN_BITS`` neighbours are one group of a level."""
    schema = "c string, at long, value array<long>"

    def table(c, at, values) -> pa.Table:
        return pa.table({"c": pa.array([c] * len(at), pa.string()), "at": pa.array(at, pa.int64()),
                         "value": pa.array([list(map(int, v)) for v in values], pa.list_(pa.int64()))})

    def rows_of(group: pa.Table, column: str = "value"):
        at = np.array(group["at"].to_pylist(), np.int64)
        order = np.argsort(at)
        return at[order], [np.array(v, np.int64) for v in group.take(order)[column].to_pylist()]

    def up(group: pa.Table) -> pa.Table:
        at, values = rows_of(group)
        total = values[0]
        for v in values[1:]:
            total = combine(total, v)
        return table(group["c"][0].as_py(), at[:1] >> FAN_BITS, [total])

    def down(group: pa.Table) -> pa.Table:
        at, values = rows_of(group)
        outer, out = np.array(group["outer"][0].as_py(), np.int64), [None] * len(at)
        for i in (range(len(at) - 1, -1, -1) if backward else range(len(at))):
            out[i] = outer
            outer = combine(values[i], outer) if backward else combine(outer, values[i])
        return table(group["c"][0].as_py(), at, out)

    parent = F.shiftright("at", FAN_BITS)
    levels = [pieces.select("c", "at", "value")]
    while levels[-1].groupBy("c").count().filter("count > 1").limit(1).count():
        grouped = levels[-1].groupBy("c", parent.alias("_g"))
        levels.append(written(grouped.applyInArrow(up, schema), "repair-up"))
    outer = levels[-1].select("c", "at", F.array(*[F.lit(int(x)).cast("long") for x in unit]).alias("outer"))
    for level in levels[-2::-1]:
        above = outer.select(F.col("c").alias("_c"), F.col("at").alias("_at"), "outer")
        joined = level.join(above, (F.col("c") == F.col("_c")) & (parent == F.col("_at"))).select("c", "at", "value", "outer")
        below = joined.groupBy("c", parent.alias("_g")).applyInArrow(down, schema)
        outer = written(below.withColumnRenamed("value", "outer"), "repair-down")
    return outer


# ---------------------------------------------------------------- Spark


def _rows(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Distinct rows with their copies: c (key of the conversation), t (turn as a sortable struct), role, digest,
    text, n, blank, cut (no sentence end). Written."""
    turn_c = F.col(turn).cast("long")
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select(id_key(F.col(conv)).alias("c"), F.struct(turn_c.isNotNull().alias("known"), F.coalesce(turn_c, F.lit(0)).alias("turn")).alias("t"),
                       space(role).alias("role"), space(text).alias("text"))
    rows = rows.groupBy("c", "t", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    bare = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\f\r"))
    return written(rows.select("c", "t", "role", F.sha2("text", 256).alias("digest"), "text", "n", blank.alias("blank"),
                               (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut")), "repair-rows")


ORDER = ("c", "t", "role", "digest")


def _marked(rows: DataFrame) -> DataFrame:
    """(c, t, role, digest, again): whether (role, text) occurs at an earlier turn of the conversation."""
    narrow = rows.select(*ORDER)
    firsts = narrow.groupBy("c", "role", "digest").agg(F.min("t").alias("t")).withColumn("first", F.lit(True))
    return narrow.join(firsts, list(ORDER), "left").select(*ORDER, F.col("first").isNull().alias("again"))


def _pieces(rows: DataFrame) -> DataFrame:
    """(c, at, codes, key): at most ``2^PIECE_BITS`` neighbouring rows of a conversation; key: its first row's order."""
    marked = rows.select(*ORDER, "blank", "cut").join(_marked(rows), list(ORDER))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(F.col("blank") | F.col("again"), GONE).when(F.col("cut"), TRUNCATED).otherwise(SOUND)
    ordered = marked.select(*ORDER, (kind * 3 + fault).cast("int").alias("code"))
    ordered = ordered.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    ordered = written(ordered.withColumn("pos", F.monotonically_increasing_id()), "repair-order")
    key = F.struct("t", "role", "digest")
    return written(ordered.groupBy("c", F.shiftright("pos", PIECE_BITS).alias("at")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "code")))["code"].alias("codes"), F.min(key).alias("key")), "repair-pieces")


def _audits(pieces: DataFrame) -> DataFrame:
    """(c, key, audit) of each piece."""
    many = written(pieces.groupBy("c").count().filter("count > 1").select("c"), "repair-many")
    parts = written(pieces.join(many, "c", "left_semi"), "repair-parts")
    longs = lambda a: pa.array([list(map(int, x)) for x in a], pa.list_(pa.int64()))

    costs = written(_solved(parts.select("c", "at", "codes"), lambda b, p: ("value", longs(p.matrices().reshape(-1, 16))),
                            "c string, at long, value array<long>"), "repair-costs")
    after = scan(costs, _cheapest, UNIT_COSTS, backward=True)
    ends = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda q: F.array_min(F.transform(
        F.array(*[F.lit(int(x)) for x in FINAL]), lambda x, e: x + F.get("outer", q * 4 + e))))
    parts = written(parts.join(after.select("c", "at", ends.alias("ends")), ["c", "at"]), "repair-ends")
    moves = written(_solved(parts.select("c", "at", "codes", "ends"), lambda b, p: ("value", longs(p.moves(_ends(b)))),
                            "c string, at long, value array<long>"), "repair-moves")
    before = scan(moves, _onward, UNIT_MOVES, backward=False)
    parts = parts.join(before.select("c", "at", F.get("outer", F.lit(0)).alias("entry")), ["c", "at"])
    whole = pieces.join(many, "c", "left_anti").withColumns({
        "ends": F.array(*[F.lit(int(x)).cast("long") for x in FINAL]), "entry": F.lit(0).cast("long")})
    cols = ["c", F.to_json("key").alias("key"), "codes", "ends", "entry"]
    found = _solved(whole.select(*cols).unionByName(parts.select(*cols)),
                    lambda b, p: ("audit", pa.array(p.audits(_ends(b), np.array(b.column("entry"), np.int64)), pa.binary())),
                    "c string, key string, entry long, audit binary")
    key = F.from_json("key", "struct<t: struct<known: boolean, turn: long>, role: string, digest: string>")
    return written(found.select("c", key.alias("key"), F.col("audit").cast("string").alias("audit")), "repair-audits")


RESULT = ("c string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


class _Stream:
    """A conversation's rows in order, after the letters of their piece."""

    def __init__(self, c: str):
        self.c, self.state, self.out, self.hash, self.empty = c, 0, [], hashlib.sha256(), True
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.turns = 0
        self.low = self.high = None
        self.last = None
        self.letters, self.at = "", 0

    def line(self, role: str, text: str) -> None:
        self.hash.update((("" if self.empty else "\n") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.empty = False

    def insert(self) -> None:
        self.line(EXPECTED[self.state], "")
        self.state, self.cost = int(NEXT[self.state]), self.cost + 3

    def row(self, turn, role: str, text: str, n: int, blank: bool, cut: bool, again: bool) -> None:
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        pair = (self.last or "")[:1] + role[:1]
        self.illegal += (self.last is not None and pair not in ("su", "ua", "au")) + n - 1
        self.last = role
        if blank:
            self.blank += n
        else:
            self.duplicate += n - (not again)
            self.truncated += cut and not again
        begin = self.at
        while self.letters[self.at] == "I":
            self.insert()
            self.at += 1
        letter, extra = self.letters[self.at], 3 * (cut and not blank and not again)
        self.at += 1
        if letter == "K":
            self.line(role, text)
            self.state, self.cost = int(KEPT[self.state]["sua".find(role[:1])]), self.cost + extra
        elif letter == "R":
            self.line(EXPECTED[self.state], text)
            self.state, self.cost = int(NEXT[self.state]), self.cost + 3 + extra
        else:
            self.cost += 4
        self.cost += 4 * (n - 1)
        self.out.append(self.letters[begin:self.at] + "D" * (n - 1))

    def result(self) -> tuple:
        while CLOSING[self.state]:
            self.insert()
            self.out.append("I")
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.c, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.out), self.hash.hexdigest())


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]
    names = ["c", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    now, done = None, []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done) if done else [[]] * len(kinds), kinds)], names=names)

    for batch in batches:
        cols = [batch.column(x) for x in ("c", "audit", "turn", "role", "text", "n", "blank", "cut", "again")]
        for i in range(batch.num_rows):
            c, audit, *row = [x[i].as_py() for x in cols]
            if now is None or now.c != c:
                if now:
                    done.append(now.result())
                now = _Stream(c)
            if audit is not None:
                now.letters, now.at = audit, 0
            else:
                now.row(*row)
        yield out()
        done = []
    if now:
        done.append(now.result())
        yield out()


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation of ``rows``: id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    distinct = _rows(rows, conv, turn, role, text)
    audits = _audits(_pieces(distinct))
    again = _marked(distinct)
    lines = distinct.join(again, list(ORDER)).select(
        "c", "t", "role", "digest", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), "text", "n", "blank", "cut", "again")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    heads = audits.select("c", "key.t", "key.role", "key.digest", F.lit(0).alias("kind"), "audit", none("string", "text"), none("long", "n"),
                          none("boolean", "blank"), none("boolean", "cut"), none("boolean", "again"))
    stream = lines.unionByName(heads).repartition("c").sortWithinPartitions(*ORDER, "kind")
    stream = stream.select("c", "audit", F.when(F.col("t.known"), F.col("t.turn")).alias("turn"), "role", "text", "n", "blank", "cut", "again")
    found = written(stream.mapInArrow(_repaired, RESULT), "repair-result")
    ids = rows.select(F.col(conv)).distinct()
    return ids.join(found, id_key(F.col(conv)) == F.col("c")).drop("c")


def repair_all(original: DataFrame, damaged: DataFrame, conv: str = "conv_id", **names) -> DataFrame:
    """``repair(damaged)`` for every conversation of ``original``; one without rows left has zeros and empty texts."""
    found = repair(damaged, conv, **names)
    found = found.withColumnRenamed(conv, "_tf_conv")
    out = original.select(F.col(conv)).distinct().join(found, F.col(conv).eqNullSafe(F.col("_tf_conv")), "left").drop("_tf_conv")
    empty: dict[str, Column] = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    empty |= {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))}
    return out.select(conv, *[v.alias(c) for c, v in empty.items()])
