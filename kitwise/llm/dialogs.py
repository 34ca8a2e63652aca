"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation's rows, in order of turn, are edited at least cost into one that
has an optional system row, then user and assistant rows in turn, ending with
an assistant row, or into nothing: the role initials match ``(s?(ua)+)?``.
Edits are Keep (0), Rerole to user or assistant (2), Delete (3) and Insert an
empty user or assistant row anywhere (2); blank and duplicate rows must be
deleted, a truncated row that is not costs 1 more. Among the cheapest edits
those whose initials are ASCII-least are taken (the audit).

Four states say what the rows so far end with: nothing, the system row, a user
row, an assistant row. ``solve`` carries a cost for each state forwards over
the first half of the rows and backwards over the second half; where the two
vectors meet, the cheapest crossing state splits the problem in two, so the
space is linear in the rows. Audits up to a crossing have one non-insert letter
a row and end with one, so none is the beginning of another: with each
state's cost travels the rank of its audit, and of equally cheap crossings the
one of least rank begins the least audit.

The same division spreads long conversations over tasks. Rows are sorted by a
range exchange and numbered; each block of ``1 << block_bits`` numbers is one
group. A conversation that lies inside a block is solved there. A piece at a
block's edge gives its four by four transfer costs and ranks; the pieces'
transfers are multiplied, ``1 << FAN_BITS`` at a time, to find the crossing
states at their borders, and then every piece is solved by itself. Texts are
moved once: repairing streams each conversation's rows past its audit, with
constant memory. That last stream is one task for a conversation, as its
output order and digest are sequential; all else splits a hot one.

Edge cases: a null role or text is one space, a null turn comes before all
others, a null conversation id is a conversation of its own. Rows of one turn
are in order of role, the text's first 32 characters and a digest. Rows that
repeat are duplicates of the first. A role that begins with another letter
than s, u or a can be re-roled or deleted. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kitwise.llm.scratch import Scratch

#: What a row is by its role's initial; a row that must be deleted is GONE; TRUNCATED is added.
SYSTEM, USER, ASSISTANT, OTHER, TRUNCATED, GONE = 0, 1, 2, 3, 4, 8
INSERTED, REROLED, DELETED = 2, 2, 3
#: The state after a row that is made to fit; states: 0 nothing, 1 system, 2 user, 3 assistant.
FITTING = (2, 2, 3, 2)
#: The letters and cost that end a conversation in each state.
ENDING = ("", "II", "I", "")
END_COST = tuple(INSERTED * len(x) for x in ENDING)
NEVER = 1 << 40
#: A state this much dearer than the cheapest can't be on a cheapest path: any other state can be turned into it for 7.
BEYOND = 8
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
FAN_BITS = 12
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


def _moves(code: int) -> list[list[tuple[str, int, int]]]:
    """By state before: (letters, state after, cost) of every way to deal with one row, inserts before it included."""
    out = []
    for state in range(4):
        ways, at = [], state
        for inserts in range(3):
            word, cost = "I" * inserts, INSERTED * inserts
            ways.append((word + "D", at, cost + DELETED))
            if code != GONE:
                cost += code >> 2
                kind = code & 3
                if (kind, at) == (SYSTEM, 0):
                    ways.append((word + "K", 1, cost))
                if kind == (ASSISTANT if at == 2 else USER):
                    ways.append((word + "K", FITTING[at], cost))
                ways.append((word + "R", FITTING[at], cost + REROLED))
            at = FITTING[at]
        out.append(ways)
    return out


MOVES = {code: _moves(code) for code in range(9)}


@lru_cache(maxsize=1 << 16)
def _ahead(costs: tuple, ranks: tuple, code: int) -> tuple[tuple, tuple, int]:
    """Costs and audit ranks of the states one row further, and what was taken off all costs."""
    best: dict[int, tuple] = {}
    for state in range(4):
        if costs[state] < NEVER:
            for word, after, cost in MOVES[code][state]:
                found = (costs[state] + cost, ranks[state], word)
                if after not in best or found < best[after]:
                    best[after] = found
    low = min(b[0] for b in best.values())
    best = {s: b for s, b in best.items() if b[0] < low + BEYOND}
    order = sorted(best, key=lambda s: best[s][1:])
    return tuple(best[s][0] - low if s in best else NEVER for s in range(4)), tuple(order.index(s) if s in best else 4 for s in range(4)), low


@lru_cache(maxsize=1 << 16)
def _back(costs: tuple, code: int) -> tuple:
    """Costs to the end from each state, one row earlier, less the least of them."""
    out = [min(cost + costs[after] for _, after, cost in MOVES[code][state]) for state in range(4)]
    low = min(out)
    return tuple(min(c - low, NEVER) if low < NEVER else NEVER for c in out)


def _only(state: int) -> tuple:
    return tuple(0 if s == state else NEVER for s in range(4))


def forward(codes: bytes, state: int) -> tuple[tuple, tuple, int]:
    costs, ranks, total = _only(state), tuple(0 if s == state else 4 for s in range(4)), 0
    for code in codes:
        costs, ranks, low = _ahead(costs, ranks, code)
        total += low
    return costs, ranks, total


def solve(codes: bytes, state: int, end: int) -> str:
    """The least of the cheapest audits that lead from ``state`` over all rows to ``end``."""
    out, todo = [], [(0, len(codes), state, _only(end))] if codes else []
    while todo:
        lo, hi, state, final = todo.pop()
        if hi - lo == 1:
            out.append(min((cost + final[after], word) for word, after, cost in MOVES[codes[lo]][state])[1])
            continue
        mid = (lo + hi) // 2
        costs, ranks, _ = forward(codes[lo:mid], state)
        back = final
        for code in reversed(codes[mid:hi]):
            back = _back(back, code)
        crossing = min(range(4), key=lambda s: (costs[s] + back[s], ranks[s]))
        todo += [(mid, hi, crossing, final), (lo, mid, state, _only(crossing))]
    return "".join(out)


@lru_cache(maxsize=1 << 15)
def _whole(codes: bytes) -> tuple[str, int]:
    costs, ranks, total = forward(codes, 0)
    end = min(range(4), key=lambda s: (costs[s] + END_COST[s], ranks[s]))
    return solve(codes, 0, end) + ENDING[end], total + costs[end] + END_COST[end]


# Transfers of pieces ---------------------------------------------------------------------------
def transfer(codes: bytes) -> list[int]:
    """For each state before: four costs and four ranks of the states after, as 32 numbers."""
    out: list[int] = []
    for state in range(4):
        costs, ranks, total = forward(codes, state)
        out += [min(c + total, NEVER) for c in costs] + list(ranks)
    return out


def through(front: list[int], piece: list[int]) -> tuple[list[int], list[int]]:
    """``front`` (four costs, four ranks) after a piece, and from which state each state after comes."""
    best: dict[int, tuple] = {}
    for before in range(4):
        for after in range(4):
            cost = front[before] + piece[8 * before + after]
            found = (cost, front[4 + before], piece[8 * before + 4 + after], before)
            if cost < NEVER and (after not in best or found < best[after]):
                best[after] = found
    order = sorted(best, key=lambda s: best[s][1:3])
    costs = [best[s][0] if s in best else NEVER for s in range(4)]
    return costs + [order.index(s) if s in best else 4 for s in range(4)], [best[s][3] if s in best else -1 for s in range(4)]


START = [[*_only(s), *(0 if t == s else 4 for t in range(4))] for s in range(4)]


def _joined(pieces: list[list[int]]) -> list[int]:
    out: list[int] = []
    for front in START:
        for piece in pieces:
            front, _ = through(front, piece)
        out += front
    return out


def _crossings(pieces: list[list[int]], state: int, end: int | None) -> tuple[list[int], int]:
    """The states at all borders of the pieces, first and last included, and the cost."""
    front, origins = START[state], []
    for piece in pieces:
        front, origin = through(front, piece)
        origins.append(origin)
    if end is None:
        end = min(range(4), key=lambda s: (front[s] + END_COST[s], front[4 + s]))
        front = [f + e for f, e in zip(front, END_COST, strict=False)]
    states = [end]
    for origin in reversed(origins):
        states.append(origin[states[-1]])
    return states[::-1], front[end]


# Rows ------------------------------------------------------------------------------------------
def _key(column: str) -> Column:
    """An id as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def _rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, head, digest, text): what orders and tells apart the rows."""
    blank = F.lit(" ")
    out = df.select(
        _key(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), blank).alias("role"),
        F.coalesce(F.col(text), blank).alias("text"),
    )
    own = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return out.withColumn("head", F.substring("text", 1, 32)).withColumn("digest", F.unhex(F.md5(own)))


ORDER = ("conv", "turn", "role", "head", "digest")


def _numbered(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows without their texts, ``pos`` giving their order over all conversations."""
    shown = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    narrow = rows.select(
        *ORDER, kind.cast("int").alias("kind"), (shown == "").alias("blank"),
        (~F.substring(shown, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    narrow = scratch.save(narrow, "narrow")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # of rows that are the same in all respects a range exchange would make one part
    narrow = narrow.withColumn("salt", F.monotonically_increasing_id())
    narrow = narrow.repartitionByRange(n, *ORDER, "salt").sortWithinPartitions(*ORDER, "salt")
    out = scratch.save(narrow.drop("salt").withColumn("pos", F.monotonically_increasing_id()), "numbered")
    scratch.drop("narrow")
    return out


def _later_copies(numbered: DataFrame, scratch: Scratch) -> DataFrame:
    """(pos) of rows whose role and text were seen before in their conversation."""
    seen = numbered.where(~F.col("blank")).groupBy("conv", "digest").agg(F.min("pos").alias("first"), F.count("*").alias("n"))
    seen = scratch.save(seen.where("n > 1").select("conv", "digest", "first"), "copies")
    later = numbered.select("conv", "digest", "pos").join(seen, ["conv", "digest"]).where("pos > first").select("pos")
    return scratch.save(later, "later")


COUNTS = "n long, blank long, duplicate long, truncated long, illegal long"
#: Of a piece of a conversation: its first row's place in the order, counts, turns, kinds at its ends, and its audit or its codes and transfer.
PIECE = (
    f"conv string, block long, turn long, role string, head string, digest binary, {COUNTS}, low long, high long, turns long, "
    "first_kind int, last_kind int, codes binary, moves array<long>, audit string, cost long"
)


def _pieces(rows: pd.DataFrame, copies: pd.DataFrame) -> pd.DataFrame:
    """The pieces of conversations in one block; those inside it are solved."""
    rows = rows.sort_values("pos", kind="stable", ignore_index=True)
    conv = rows["conv"].to_numpy(object)
    kind, blank = rows["kind"].to_numpy(np.int64), rows["blank"].to_numpy(bool)
    copy = np.isin(rows["pos"].to_numpy(np.int64), copies["pos"].to_numpy(np.int64)) & ~blank
    cut_off = rows["truncated"].to_numpy(bool) & ~blank & ~copy
    codes = np.where(blank | copy, GONE, kind + TRUNCATED * cut_off).astype(np.uint8).tobytes()
    turn, has_turn = rows["turn_or_0"].to_numpy(np.int64), rows["has_turn"].to_numpy(bool)
    new = np.append(True, conv[1:] != conv[:-1])
    new_turn = has_turn & (new | np.append(True, (turn[1:] != turn[:-1]) | ~has_turn[:-1]))
    broken = np.append(False, ~np.isin(4 * kind[:-1] + kind[1:], [4 * a + b for a, b in LEGAL])) & ~new
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(rows))
    sums = {c: np.add.reduceat(v.astype(np.int64), starts) for c, v in
            (("blank", blank), ("duplicate", copy), ("truncated", cut_off), ("illegal", broken), ("turns", new_turn))}
    with_turn = np.add.reduceat(has_turn.astype(np.int64), starts)
    out = rows.loc[starts, ["conv", "block", "role", "head", "digest"]].reset_index(drop=True)
    out["turn"] = pd.array(np.where(has_turn[starts], turn[starts], 0), "Int64").copy()
    out.loc[~has_turn[starts], "turn"] = pd.NA
    out["n"] = ends - starts
    for c, v in sums.items():
        out[c] = v
    high = pd.array(turn[ends - 1], "Int64")
    low = pd.array(turn[np.minimum(ends - with_turn, len(rows) - 1)], "Int64")
    high[with_turn == 0] = low[with_turn == 0] = pd.NA
    out["low"], out["high"] = low, high
    out["first_kind"], out["last_kind"] = kind[starts].astype(np.int32), kind[ends - 1].astype(np.int32)
    own = [codes[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    inside = range(1, len(own) - 1)
    solved = [_whole(c) if i in inside else (None, None) for i, c in enumerate(own)]
    out["codes"] = [None if i in inside else c for i, c in enumerate(own)]
    out["moves"] = [None if i in inside else transfer(c) for i, c in enumerate(own)]
    out["audit"] = [s[0] for s in solved]
    out["cost"] = pd.array([s[1] for s in solved], "Int64")
    return out


TOTALS = f"conv string, {COUNTS}, low long, high long, turns long, cost long"
BORDERS = "conv string, block long, start int, end int, last boolean"


def _summed(pieces: pd.DataFrame) -> dict:
    """The counts of neighbouring pieces, pairs and turns over their borders included."""
    kinds = zip(pieces["last_kind"].tolist(), pieces["first_kind"].tolist()[1:], strict=False)
    high, low = pieces["high"].tolist(), pieces["low"].tolist()
    shared = sum(not pd.isna(a) and not pd.isna(b) and a == b for a, b in zip(high, low[1:], strict=False))
    out = {c: int(pieces[c].sum()) for c in ("n", "blank", "duplicate", "truncated", "illegal", "turns")}
    out["illegal"] += sum(pair not in LEGAL for pair in kinds)
    out["turns"] -= shared
    present = [x for x in low if not pd.isna(x)], [x for x in high if not pd.isna(x)]
    return out | {"low": min(present[0], default=None), "high": max(present[1], default=None)}


def _frame(records: list[dict], schema: str) -> pd.DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    frame = pd.DataFrame(records, columns=names)
    for name, kind in (c.split() for c in schema.split(", ")):
        if kind == "long":
            frame[name] = frame[name].astype("Int64")
    return frame


def _parent(pieces: pd.DataFrame) -> pd.DataFrame:
    pieces = pieces.sort_values("block")
    first, last = pieces.iloc[0], pieces.iloc[-1]
    own = {"conv": first["conv"], "block": first["parent"], "first_kind": first["first_kind"], "last_kind": last["last_kind"]}
    return _frame([own | _summed(pieces) | {"moves": _joined([list(m) for m in pieces["moves"]])}], OPEN)


OPEN = f"conv string, block long, {COUNTS}, low long, high long, turns long, first_kind int, last_kind int, moves array<long>"


def _settled(pieces: pd.DataFrame) -> pd.DataFrame:
    """All of a conversation's pieces: the states at their borders, and one row of totals."""
    pieces = pieces.sort_values("block")
    states, cost = _crossings([list(m) for m in pieces["moves"]], 0, None)
    conv, blocks = pieces["conv"].iloc[0], pieces["block"].tolist()
    rows = [{"conv": conv, "block": b, "start": states[i], "end": states[i + 1], "last": i + 1 == len(blocks)} for i, b in enumerate(blocks)]
    return _frame([*rows, {"conv": conv, "cost": cost} | _summed(pieces)], f"{BORDERS}, {TOTALS.removeprefix('conv string, ')}")


def _refined(pieces: pd.DataFrame, borders: pd.DataFrame) -> pd.DataFrame:
    """The states inside a parent whose own borders are known."""
    pieces, own = pieces.sort_values("block"), borders.iloc[0]
    states, _ = _crossings([list(m) for m in pieces["moves"]], int(own["start"]), int(own["end"]))
    last = len(pieces) - 1
    rows = [{"conv": own["conv"], "block": b, "start": states[i], "end": states[i + 1], "last": bool(own["last"]) and i == last}
            for i, b in enumerate(pieces["block"].tolist())]
    return _frame(rows, BORDERS)


def _settle(pieces: DataFrame, scratch: Scratch, fan_bits: int, level: int = 0) -> tuple[DataFrame, DataFrame]:
    """(borders, totals) of the conversations that ``pieces`` make up, each level joining up to ``1 << fan_bits`` of them."""
    most = pieces.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    if most <= 1 << fan_bits:
        both = pieces.groupBy("conv").applyInPandas(_settled, f"{BORDERS}, {TOTALS.removeprefix('conv string, ')}")
        both = scratch.save(both, f"settled-{level}")
        names = [c.split()[0] for c in TOTALS.split(", ")]
        return both.where("block is not null").select("conv", "block", "start", "end", "last"), both.where("block is null").select(*names)
    pieces = pieces.withColumn("parent", F.shiftright("block", fan_bits))
    parents = scratch.save(pieces.groupBy("conv", "parent").applyInPandas(_parent, OPEN), f"parents-{level}")
    borders, totals = _settle(parents, scratch, fan_bits, level + 1)
    known = borders.withColumnRenamed("block", "parent")
    refined = pieces.groupBy("conv", "parent").cogroup(known.groupBy("conv", "parent")).applyInPandas(_refined, BORDERS)
    return scratch.save(refined, f"borders-{level}"), totals


def _solved(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        part["audit"] = [solve(bytes(c), s, e) + (ENDING[e] if last else "") for c, s, e, last in
                         zip(part["codes"], part["start"], part["end"], part["last"], strict=True)]
        yield part.drop(columns=["codes", "start", "end", "last"])


class Repair:
    """The repair of the conversations of a frame with the columns named."""

    def __init__(
        self, df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
        block_bits: int = 14, fan_bits: int = FAN_BITS,
    ):
        self.id_type = df.schema[conv].dataType
        self.rows = _rows(df, conv, turn, role, text)
        scratch = Scratch(df.sparkSession)
        numbered = _numbered(self.rows, scratch)
        block = F.shiftright("pos", block_bits).alias("block")
        later = _later_copies(numbered, scratch).select("pos", block)
        plain = numbered.select(
            "pos", block, "conv", "role", "head", "digest", "kind", "blank", "truncated",
            F.coalesce("turn", F.lit(0).cast("long")).alias("turn_or_0"), F.col("turn").isNotNull().alias("has_turn"),
        )
        columns = [c.split()[0] for c in PIECE.split(", ")]
        found = plain.groupBy("block").cogroup(later.groupBy("block")).applyInPandas(lambda a, b: _pieces(a, b)[columns], PIECE)
        found = scratch.save(found, "pieces")
        inside, edge = found.where("audit is not null"), found.where("audit is null")
        borders, totals = _settle(edge.select(*[c.split()[0] for c in OPEN.split(", ")]), scratch, fan_bits)
        place = ("conv", "block", "turn", "role", "head", "digest")
        edge = edge.select(*place, "codes").join(borders, ["conv", "block"])
        kind = "conv string, block long, turn long, role string, head string, digest binary, audit string"
        # a long column that holds nulls would come to pandas as doubles
        edge = edge.withColumn("turn", F.col("turn").cast("string")).mapInPandas(_solved, kind.replace("turn long", "turn string"))
        solved = scratch.save(edge.withColumn("turn", F.col("turn").cast("long")), "edges")
        self.audits = inside.select(*place, "audit").unionByName(solved.select(*place, "audit"))
        names = [c.split()[0] for c in TOTALS.split(", ")]
        self.totals = inside.select(*names).unionByName(totals)

    def _id(self) -> Column:
        """The conversation id as it was."""
        return F.expr("nullif(conv, '')").substr(F.lit(2), F.length("conv")).cast(self.id_type)

    def summary(self) -> DataFrame:
        """(conv, n, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation with rows."""
        gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long")
        counts = self.totals.select("conv", "n", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost")
        parts = self.audits.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("block", "audit"))).alias("parts"))
        audits = parts.select("conv", F.array_join(F.col("parts.audit"), "").alias("audit"))
        return counts.join(audits, "conv")

    def repaired(self) -> DataFrame:
        """(conv, place, edit, role, text) of the repaired conversations, each one's rows together and in order."""
        rows = self.rows.select(*ORDER, F.lit(1).alias("what"), F.lit(None).cast("long").alias("block"), "text")
        edits = self.audits.select(*ORDER, F.lit(0).alias("what"), "block", F.col("audit").alias("text"))
        n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        both = rows.unionByName(edits).repartition(n, "conv").sortWithinPartitions(*ORDER, "what", "block")
        return both.select("conv", "what", "role", "text").mapInPandas(_edited, "conv string, place long, edit string, role string, text string")

    def rows_repaired(self, conv: str = "conv_id") -> DataFrame:
        """(conversation id, place, edit, role, text)."""
        return self.repaired().select(self._id().alias(conv), "place", "edit", "role", "text")

    def digests(self) -> DataFrame:
        """(conv, repaired_sha256) of the conversations that keep rows: their ``role:text`` joined by line feeds."""
        return self.repaired().mapInPandas(_hashed, "conv string, repaired_sha256 string")


def _edited(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order, each conversation's audit before them (its pieces before their first row at the latest)."""
    conv, state, place = None, 0, 0
    waiting, at = "", 0  # letters of the audit and how many are used
    for part in parts:
        out: list[tuple] = []

        def emit(edit: str, role: str, text: str) -> None:
            nonlocal place
            out.append((conv, place, edit, role, text))  # noqa: B023
            place += 1

        def fitted(edit: str, text: str) -> None:
            nonlocal state
            state = FITTING[state]
            emit(edit, "assistant" if state == 3 else "user", text)  # noqa: B023

        def inserts() -> None:
            nonlocal at
            while at < len(waiting) and waiting[at] == "I":
                fitted("I", "")  # noqa: B023
                at += 1

        for key, what, role, text in part.itertuples(index=False, name=None):
            if key != conv:
                inserts()
                conv, state, place, waiting, at = key, 0, 0, "", 0
            if what == 0:
                waiting, at = waiting[at:] + text, 0
                continue
            inserts()
            letter, at = waiting[at], at + 1
            if letter == "K":
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
                emit("K", role, text)
            elif letter == "R":
                fitted("R", text)
        if len(out):
            yield pd.DataFrame(out, columns=["conv", "place", "edit", "role", "text"])
        out.clear()
    if waiting[at:]:
        last = []
        for letter in waiting[at:]:
            state = FITTING[state]
            last.append((conv, place, letter, "assistant" if state == 3 else "user", ""))
            place += 1
        yield pd.DataFrame(last, columns=["conv", "place", "edit", "role", "text"])


def _hashed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    conv, digest = None, None
    for part in parts:
        done = []
        for key, role, text in zip(part["conv"], part["role"], part["text"], strict=True):
            if key != conv:
                if digest is not None:
                    done.append((conv, digest.hexdigest()))
                conv, digest = key, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if done:
            yield pd.DataFrame(done, columns=["conv", "repaired_sha256"])
    if digest is not None:
        yield pd.DataFrame([(conv, digest.hexdigest())], columns=["conv", "repaired_sha256"])


# The contract's query --------------------------------------------------------------------------
def damaged(df: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of ``conv_id:turn`` modulo 20; nulls are one space in the role, the text and what is hashed."""
    own = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = df.select("conv_id", "turn", own("role").alias("role"), own("text").alias("text"), own("conv_id").alias("a"), own("turn").alias("b"))
    rows = rows.withColumn("harm", F.crc32(F.concat("a", F.lit(":"), "b").cast("binary")) % 20).where("harm <> 0")
    harm = F.col("harm")
    text = F.when(harm == 1, "").when(harm == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = rows.select("conv_id", "turn", F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("copy"))
    return rows.drop("copy")


def repair_damaged(conversations: DataFrame, **sizes: int) -> DataFrame:
    """Every conversation of the table after damage and repair: its faults, audit, cost and digest."""
    fix = Repair(damaged(conversations), **sizes)
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    there = conversations.select(_key("conv_id").alias("conv")).distinct()
    summary = fix.summary().select("conv", *names, "audit")
    # one grouping puts the three together; at most one row a conversation has each value
    union = there.unionByName(summary, allowMissingColumns=True).unionByName(fix.digests(), allowMissingColumns=True)
    largest = [F.max(c).alias(c) for c in (*names, "audit", "repaired_sha256")]
    out = union.groupBy("conv").agg(*largest)
    return out.select(
        fix._id().alias("conv_id"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in names],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
