"""Repair of damaged conversations at least cost, by bidirectional Dijkstra over the edit lattice.

A node of the lattice is (rows consumed, last role given). Its edges are the edits: Keep,
Rerole and Delete consume a row, Insert adds an empty one. Roles given have to read
``(s?(ua)+)?`` by their initials, so an edit and the state before it fix the state after it,
and an audit (the initials of the edits) fixes its path. A forward and a reverse heap meet; both
go on until no crossing of equal cost can be missing, and of the audits that cross at the least
cost the ASCII-least is taken. Both heaps pop by cost and then in row order, so a label is final
when it is popped, ties included.

Spark sorts the rows by ranges of (conversation, turn), so a conversation of any size is spread
over tasks, and each task folds its rows into pieces of at most ``PIECE`` one-byte codes. A
conversation of one piece is solved where it lies. One of several has each piece solved from
every state to every state; those costs (16 numbers for a piece) are chained, and each piece
then spells its own part of the audit. Identical rows of a turn are combined before the shuffle,
and texts travel once: for the hash of the repaired conversation, which is a stream through one
task, held a batch at a time (a hash of a sequence cannot be split).

Results for odd input: a null id, role or text reads as one space for the damage, roles and
texts; a null id is a conversation of its own; a null turn comes first; rows of one turn stand
in the order of the SHA-256 of role and text; a role that begins with neither s, u nor a can only
be changed or deleted; a conversation without rows after damage has zeros, an empty audit and
the hash of nothing; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.llm.common import kept_table
from stackroom.llm.suffix_index import text_key

PIECE = 512

KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 1, 2, 5, 5

# States: nothing given yet, then after a system, a user and an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
_USER_NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
_KEPT = {1: {START: SYSTEM}, 2: {START: USER, SYSTEM: USER, ASSISTANT: USER}, 3: {USER: ASSISTANT}, 0: {}}
ACCEPTED = (START, ASSISTANT)
#: What is inserted after the last row to end in an accepted state.
_TAIL = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

# A code is the row's initial (0 other, 1 system, 2 user, 3 assistant) and, from bit 2, its fault.
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)


def _row_edits(code: int) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, letter) of the edits that consume a row."""
    initial, fault = code & 3, code >> 2
    found = [(state, state, DELETE, "D") for state in STATES]
    if fault in (FINE, TRUNCATED):
        more = UNFINISHED if fault == TRUNCATED else 0
        found += [(x, y, KEEP + more, "K") for x, y in _KEPT[initial].items()]
        found += [(x, y, REROLE + more, "R") for x, y in _USER_NEXT.items()]
    return found


_AHEAD = [[[e[1:] for e in _row_edits(code) if e[0] == s] for s in STATES] for code in range(16)]
_BACK = [[[(e[0], *e[2:]) for e in _row_edits(code) if e[1] == s] for s in STATES] for code in range(16)]
_INSERTED_FROM = [[x for x, y in _USER_NEXT.items() if y == s] for s in STATES]


class _Search:
    """One of the two heaps: labels (cost, audit so far) and the nodes whose label is final."""

    def __init__(self, codes: bytes, nodes: list[tuple[int, int]], ahead: bool, tail: bool):
        self.codes, self.ahead, self.tail = codes, ahead, tail
        self.labels = {node: (0, "") for node in nodes}
        self.heap = [(0, self._rank(i), i, s) for i, s in nodes]
        self.final: set[tuple[int, int]] = set()

    def _rank(self, i: int) -> int:
        return i if self.ahead else -i

    def edges(self, i: int, s: int) -> Iterator[tuple[int, int, int, str]]:
        """Neighbours (rows consumed, state, cost, letter) in the direction of the search."""
        n = len(self.codes)
        if self.ahead:
            if i < n:
                yield from ((i + 1, *e) for e in _AHEAD[self.codes[i]][s])
            if i < n or self.tail:
                yield i, _USER_NEXT[s], INSERT, "I"
        else:
            if i:
                yield from ((i - 1, *e) for e in _BACK[self.codes[i - 1]][s])
            if i < n or self.tail:
                yield from ((i, x, INSERT, "I") for x in _INSERTED_FROM[s])

    def top(self) -> float:
        while self.heap and (self.heap[0][2:] in self.final or self.heap[0][0] > self.labels[self.heap[0][2:]][0]):
            heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def settle(self, other: _Search) -> float:
        """Make the top node final; the least cost at which it crosses the other search."""
        cost, _, i, s = heappop(self.heap)
        self.final.add((i, s))
        audit, met = self.labels[i, s][1], float("inf")
        if (i, s) in other.labels:
            met = cost + other.labels[i, s][0]
        for j, t, more, letter in self.edges(i, s):
            label = (cost + more, audit + letter if self.ahead else letter + audit)
            known = self.labels.get((j, t))
            if known is None or label < known:
                self.labels[j, t] = label
                if known is None or label[0] < known[0]:
                    heappush(self.heap, (label[0], self._rank(j), j, t))
            if (j, t) in other.labels:
                met = min(met, label[0] + other.labels[j, t][0])
        return met


def cheapest(codes: bytes, start: int = START, goals: tuple[int, ...] = ACCEPTED, tail: bool = True) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits from ``start`` to a goal, None if there are none.

    ``tail``: rows may be inserted after the last one.
    """
    n = len(codes)
    forward = _Search(codes, [(0, start)], True, tail)
    reverse = _Search(codes, [(n, goal) for goal in goals], False, tail)
    best = float("inf")
    while (total := forward.top() + reverse.top()) <= best and total < float("inf"):
        side, other = (forward, reverse) if forward.top() <= reverse.top() else (reverse, forward)
        best = min(best, side.settle(other))
    if best == float("inf"):
        return None
    # Either search may have come through alone; else some edge leads from one to the other.
    crossings = [reverse.labels[0, start]] if (0, start) in reverse.final else []
    crossings += [forward.labels[n, goal] for goal in goals if (n, goal) in forward.final]
    for node in forward.final:
        cost, audit = forward.labels[node]
        for i, s, more, letter in forward.edges(*node):
            if (i, s) in reverse.final:
                rest, after = reverse.labels[i, s]
                crossings.append((cost + more + rest, audit + letter + after))
    return min(c for c in crossings if c[0] == best)


def between_states(codes: bytes) -> tuple[list[int], list[int]]:
    """For each pair of states the cost from one to the other over a piece (-1: none), and the
    rank of its audit among those from the same state."""
    costs, ranks = [], []
    for x in STATES:
        found = [cheapest(codes, x, (y,), tail=False) for y in STATES]
        order = sorted(f[1] for f in found if f)
        costs += [f[0] if f else -1 for f in found]
        ranks += [order.index(f[1]) if f else -1 for f in found]
    return costs, ranks


def chained(costs: list[list[int]], ranks: list[list[int]]) -> tuple[int, list[int]]:
    """The least cost over all pieces, and the state before each piece and after the last."""
    inf = float("inf")
    left = [[INSERT * len(_TAIL[s]) for s in STATES]]
    for piece in reversed(costs):
        after = left[-1]
        left.append([min((c + a for c, a in zip(piece[4 * s : 4 * s + 4], after) if c >= 0), default=inf) for s in STATES])
    left.reverse()
    path = [START]
    for k, (piece, rank) in enumerate(zip(costs, ranks)):
        s = path[-1]
        ways = [y for y in STATES if piece[4 * s + y] >= 0 and piece[4 * s + y] + left[k + 1][y] == left[k][s]]
        path.append(min(ways, key=lambda y: rank[4 * s + y]))
    return left[0][START], path


_LEGAL = {(1, 2), (2, 3), (3, 2)}


def illegal_pairs(codes: bytes) -> int:
    """Neighbours whose initials are none of su, ua and au."""
    return sum((x & 3, y & 3) not in _LEGAL for x, y in zip(codes, codes[1:]))


def damaged(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv`` (text), ``turn, role, text`` of the rows after damage by their checksum."""
    space = F.lit(" ")
    named = rows.select(
        F.coalesce(F.col(f"`{conv_col}`").cast("string"), space).alias("conv"),
        F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), space).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), space).alias("text"),
    )
    key = F.concat_ws(":", "conv", F.coalesce(F.col("turn").cast("string"), space))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    times = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    hit = named.withColumn("kind", kind).select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy"),
    )
    return hit.drop("copy")


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with ``k1, k2`` of role and text: their order within a turn, and what makes duplicates."""
    both = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.select("*", *text_key(both.cast("binary")))


def _code(fault: Column) -> Column:
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 1).when(first == "u", 2).when(first == "a", 3).otherwise(0)
    return (initial + 4 * fault).cast("int")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order (``conv, code, n``) to ``conv, task, number, codes``."""
    task, number = TaskContext.get().partitionId(), 0
    conv, held, out = None, bytearray(), []

    def cut(least: int) -> None:
        nonlocal number
        while len(held) >= least and held:
            out.append((conv, task, number, bytes(held[:PIECE])))
            del held[:PIECE]
            number += 1

    def rows() -> Iterator[pa.RecordBatch]:
        if out:
            names = ["conv", "task", "number", "codes"]
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
            out.clear()

    for batch in batches:
        for key, code, n in zip(*(batch.column(c).to_pylist() for c in ("conv", "code", "n"))):
            if key != conv:
                cut(1)
                conv = key
            held.append(code)
            if n > 1:  # further copies: blank as the first is, or duplicates
                again = code if code >> 2 == BLANK else (code & 3) + 4 * DUPLICATE
                for at in range(0, n - 1, PIECE):
                    held.extend([again] * min(PIECE, n - 1 - at))
                    cut(PIECE)
                    if len(out) >= 1024:
                        yield from rows()
            cut(PIECE)
        yield from rows()
    cut(1)
    yield from rows()


_SOLVED = "conv string, cost bigint, audit string, illegal bigint"
_PRICED = "conv string, task int, number bigint, n bigint, first int, last int, illegal bigint, costs array<bigint>, ranks array<bigint>"
_CHOSEN = "conv string, cost bigint, illegal bigint, task int, number bigint, source int, target int, ends int"


def _solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [(conv, *cheapest(codes), illegal_pairs(codes)) for conv, codes in zip(batch["conv"], batch["codes"])]
        yield pd.DataFrame(found, columns=["conv", "cost", "audit", "illegal"])


def _price(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [f.split()[0] for f in _PRICED.split(", ")]
    for batch in batches:
        found = []
        for conv, task, number, codes in zip(*(batch[c] for c in ("conv", "task", "number", "codes"))):
            ends = codes[0] & 3, codes[-1] & 3
            found.append((conv, task, number, len(codes), *ends, illegal_pairs(codes), *between_states(codes)))
        yield pd.DataFrame(found, columns=names)


def _chain(pieces: pd.DataFrame) -> pd.DataFrame:
    """The states between the pieces of one conversation."""
    pieces = pieces.sort_values(["task", "number"])
    cost, path = chained(pieces["costs"].tolist(), pieces["ranks"].tolist())
    joints = zip(pieces["last"].tolist(), pieces["first"].tolist()[1:])
    illegal = int(pieces["illegal"].sum()) + sum(j not in _LEGAL for j in joints)
    chosen = pieces[["conv", "task", "number"]].assign(cost=cost, illegal=illegal, source=path[:-1], target=path[1:], ends=-1)
    chosen.loc[chosen.index[-1], "ends"] = path[-1]
    return chosen[[f.split()[0] for f in _CHOSEN.split(", ")]]


def _spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        parts = [
            cheapest(codes, source, (target,), tail=False)[1] + _TAIL.get(ends, "")
            for codes, source, target, ends in zip(*(batch[c] for c in ("codes", "source", "target", "ends")))
        ]
        yield batch[["conv", "task", "number", "cost", "illegal"]].assign(part=parts)


def _solved(pieces: DataFrame) -> DataFrame:
    """``conv, cost, audit, illegal`` of conversations given in pieces."""
    counted = pieces.groupBy("conv").agg(F.count("*").alias("n_pieces"))
    counted = kept_table(pieces.join(counted, "conv"), "pieces-counted")
    whole = counted.where("n_pieces = 1").select("conv", "codes").mapInPandas(_solve, _SOLVED)
    long = counted.where("n_pieces > 1").drop("n_pieces")
    priced = long.mapInPandas(_price, _PRICED)
    chosen = priced.groupBy("conv").applyInPandas(_chain, _CHOSEN)
    spelt = long.join(chosen, ["conv", "task", "number"]).mapInPandas(
        _spell, "conv string, task int, number bigint, cost bigint, illegal bigint, part string"
    )
    parts = F.sort_array(F.collect_list(F.struct("task", "number", "part")))
    audits = spelt.groupBy("conv", "cost", "illegal").agg(F.array_join(F.transform(parts, lambda p: p["part"]), "").alias("audit"))
    return whole.unionByName(audits)


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each repaired conversation: its audit comes first, then its rows in order."""
    conv, walk, state, digest, n_rows = None, None, START, None, 0
    done: list[tuple[str, str, int]] = []

    def put(role: str, text: str, given: int) -> None:
        nonlocal state, n_rows
        digest.update((("\n" if n_rows else "") + f"{role}:{text}").encode())
        state, n_rows = given, n_rows + 1

    def insert() -> None:
        put("user" if _USER_NEXT[state] == USER else "assistant", "", _USER_NEXT[state])

    def end() -> None:
        if conv is not None:
            for _ in walk:  # only insertions are left
                insert()
            done.append((conv, digest.hexdigest(), n_rows))

    def out() -> Iterator[pa.RecordBatch]:
        if done:
            columns = [pa.array(c, k) for c, k in zip(zip(*done), (pa.string(), pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["conv", "repaired_sha256", "n_repaired"])
            done.clear()

    for batch in batches:
        for key, audit, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "audit", "role", "text"))):
            if audit is not None:
                end()
                conv, walk, state, digest, n_rows = key, iter(audit), START, hashlib.sha256(), 0
                continue
            while (letter := next(walk)) == "I":
                insert()
            if letter == "K":
                put(role, text, {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]])
            elif letter == "R":
                insert_role = _USER_NEXT[state]
                put("user" if insert_role == USER else "assistant", text, insert_role)
        yield from out()
    end()
    yield from out()


def repaired(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256, n_repaired`` (rows after repair)."""
    hit = _keyed(damaged(rows, conv_col, turn_col, role_col, text_col))
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    marked = hit.select("conv", "turn", "k1", "k2", _code(fault).alias("code"))
    runs = kept_table(marked.groupBy("conv", "turn", "k1", "k2", "code").agg(F.count("*").alias("n")), "turns")
    first = runs.groupBy("conv", "k1", "k2").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n_turns"))
    first = kept_table(first.where("n_turns > 1").drop("n_turns"), "first-turns")
    seen = F.col("first").isNotNull() & ~F.struct("turn").eqNullSafe(F.col("first")) & (F.shiftright("code", 2) != BLANK)
    again = F.col("code").bitwiseAND(3) + 4 * DUPLICATE
    coded = runs.join(first, ["conv", "k1", "k2"], "left")
    coded = kept_table(coded.withColumn("code", F.when(seen, again).otherwise(F.col("code")).cast("int")).drop("first"), "codes")

    order = ["conv", "turn", "k1", "k2"]
    sorted_rows = coded.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "code", "n")
    pieces = kept_table(sorted_rows.mapInArrow(_pieces, "conv string, task int, number bigint, codes binary"), "pieces")
    solved = kept_table(_solved(pieces), "audits")

    kind = F.shiftright("code", 2)
    n = F.col("n")
    copies = F.when(kind == BLANK, 0).when(kind == DUPLICATE, n).otherwise(n - 1)
    turns = coded.groupBy("conv", "turn").agg(
        F.sum(F.when(kind == BLANK, n).otherwise(0)).alias("blank"),
        F.sum(copies).alias("duplicate"),
        F.sum(F.when(kind == TRUNCATED, 1).otherwise(0)).alias("truncated"),
    )
    counts = turns.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )

    none = F.lit(None)
    heads = solved.select("conv", "audit", none.cast("bigint").alias("turn"), *[none.cast("bigint").alias(k) for k in ("k1", "k2")],
                          *[none.cast("string").alias(c) for c in ("role", "text")])
    stream = hit.withColumn("audit", none.cast("string")).unionByName(heads)
    stream = stream.withColumn("is_row", F.col("audit").isNull())
    stream = stream.repartition("conv").sortWithinPartitions("conv", "is_row", "turn", "k1", "k2")
    hashes = stream.select("conv", "audit", "role", "text").mapInArrow(_rebuilt, "conv string, repaired_sha256 string, n_repaired bigint")

    ids = rows.select(F.coalesce(F.col(f"`{conv_col}`").cast("string"), F.lit(" ")).alias("conv"), F.col(f"`{conv_col}`").alias("conv_id"))
    ids = ids.distinct()
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    joined = ids.join(counts, "conv", "left").join(solved, "conv", "left").join(hashes, "conv", "left")
    return joined.select(
        "conv_id",
        *zero,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
        F.coalesce("n_repaired", F.lit(0)).cast("bigint").alias("n_repaired"),
    )
