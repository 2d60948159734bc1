"""Conversation structure repair: the cheapest edits that make roles alternate, by a run-length DP.

A repaired conversation's role initials read (s?(ua)+)?.  A row may be kept (0), given the role user or assistant (1) or
deleted (2); blank and duplicate rows must be deleted, truncated ones that stay cost 5 more; empty user or assistant rows may
be inserted (5).  Over the four states of that pattern a row is a min-plus matrix that depends on its symbol only: its role's
initial and its fault.  Equal symbols that follow each other are one run; a run of n rows is passed by the cached powers
M ** (2 ** k) of its symbol's matrix, one per bit of n.  Then the choices inside each run are unrolled from the front.

Rows are sorted by ranges of (conversation, turn, ...), so a conversation of any size lies in as many partitions as it
needs.  A conversation's rows of one partition are a piece.  Pieces of conversations that cross partitions - at most two
per partition begin or end one - are first passed as a whole, chained in order, and then unrolled each on its own.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from weighlens.llm.common import staged

SPACE = "\x20\t\n\x0b\x0c\r"
_INF = 1 << 60
_S, _U, _A = 1, 2, 3  # initials as numbers (0: any other), and the states after them (0: nothing yet)
_DELETE, _RENAME, _INSERT, _CUT = 2, 1, 5, 5
_FINE, _TRUNCATED, _BLANK, _DUPLICATE = range(4)
_GO = {_S: {0: _S}, _U: {0: _U, _S: _U, _A: _U}, _A: {_U: _A}}  # state after an initial in a state
_ADDED = {0: _U, _S: _U, _U: _A, _A: _U}  # state after a row inserted in a state
_ROLE = {_U: "user", _A: "assistant"}
_END = (0, 2 * _INSERT, _INSERT, 0)  # what is left to pay in a state behind the last row
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[_S, _U, _A], [_U, _A, _U]] = True


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(1), _INF)


def _matrix(symbol: int) -> np.ndarray:
    """Costs from state to state of one row, with what is inserted before it.  Symbol 0 must go; 1 + 2 * initial + truncated."""
    insert = np.full((4, 4), _INF, np.int64)
    row = insert.copy()
    np.fill_diagonal(insert, 0)
    np.fill_diagonal(row, _DELETE)
    for state, to in _ADDED.items():
        insert[state, to] = _INSERT
    insert = _product(insert, _product(insert, insert))
    if symbol:
        initial, extra = (symbol - 1) // 2, (symbol - 1) % 2 * _CUT
        for new in _GO:
            for state, to in _GO[new].items():
                if new == initial:
                    row[state, to] = min(row[state, to], extra)
                elif new != _S:
                    row[state, to] = min(row[state, to], _RENAME + extra)
    return _product(insert, row)


_powers: dict[int, list[np.ndarray]] = {s: [_matrix(s)] for s in range(9)}


def _power(symbol: int, k: int) -> np.ndarray:
    """M ** (2 ** k) of the symbol's matrix M."""
    known = _powers[symbol]
    while len(known) <= k:
        known.append(_product(known[-1], known[-1]))
    return known[k]


def _lowered(costs: tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
    least = min(costs)
    return least, tuple(min(c - least, _INF) for c in costs)


@lru_cache(1 << 16)
def _passed(symbol: int, n: int, after: tuple[int, ...]) -> tuple[int, ...]:
    costs = np.array(after, np.int64)
    for k in range(n.bit_length()):
        if n >> k & 1:
            costs = np.minimum((_power(symbol, k) + costs).min(1), _INF)
    return tuple(costs.tolist())


def run_cost(symbol: int, n: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Cost to go before a run of n rows, from that behind it."""
    base, low = _lowered(after)
    return tuple(min(c + base, _INF) for c in _passed(symbol, n, low))


def _inside(symbol: int, n: int, after: tuple[int, ...]) -> np.ndarray:
    """Cost to go before each of n rows of a run and behind the last: what is known doubles with each power."""
    out = np.empty((n + 1, 4), np.int64)
    out[n] = after
    known, k = 1, 0
    while known <= n:
        take = min(known, n + 1 - known)
        begin = n + 1 - known - take
        out[begin: begin + take] = np.minimum((_power(symbol, k)[None] + out[begin + known: begin + known + take, None, :]).min(2), _INF)
        known, k = known + take, k + 1
    return out


def _choices(symbol: int, n: int, after: tuple[int, ...], state: int) -> tuple[str, int]:
    """Least letters among the cheapest edits of a run of n rows entered in ``state``, and the state behind it."""
    if not symbol:  # nothing is gained by inserting before a row that goes anyway
        return "D" * n, state
    togo = _inside(symbol, n, after).tolist()
    initial, extra = (symbol - 1) // 2, (symbol - 1) % 2 * _CUT
    letters = []
    for here, there in zip(togo, togo[1:]):
        while True:
            left = here[state]
            if left == _DELETE + there[state]:
                letters.append("D")
                break
            if left == _INSERT + here[_ADDED[state]]:
                letters.append("I")
                state = _ADDED[state]
                continue
            kept = _GO.get(initial, {}).get(state)
            if kept is not None and left == extra + there[kept]:
                letters.append("K")
                state = kept
            else:
                letters.append("R")
                state = _ADDED[state]  # a new role is what could be inserted here
            break
    return "".join(letters), state


_choices_of_short_runs = lru_cache(1 << 16)(_choices)


def unrolled(symbol: int, n: int, after: tuple[int, ...], state: int) -> tuple[str, int]:
    low = _lowered(after)[1]
    return _choices_of_short_runs(symbol, n, low, state) if n <= 64 else _choices(symbol, n, low, state)


class _Pieces:
    """The rows of some pieces one after the other; every piece has rows."""

    def __init__(self, rows: pa.ListArray):
        size = np.asarray(pc.list_value_length(rows)).astype(np.int64)
        flat = pc.list_flatten(rows)
        self.begins = np.cumsum(size) - size
        self.piece = np.repeat(np.arange(len(size)), size)
        self.initial, self.fault, self.copies = (np.asarray(flat.field(x)).astype(np.int64) for x in ("initial", "fault", "copies"))
        turn = flat.field("turn")
        self.has_turn, self.turn = np.asarray(turn.is_valid()), np.asarray(turn.fill_null(0))
        self.row = flat.field("row")

    def runs(self) -> list[list[tuple[int, int]]]:
        """(symbol, rows) of the runs of every piece; further copies of a row are rows to delete."""
        symbol = np.where(self.fault >= _BLANK, 0, 1 + 2 * self.initial + (self.fault == _TRUNCATED))
        symbols = np.stack([symbol, np.zeros_like(symbol)], 1).reshape(-1)
        many = np.stack([np.ones_like(symbol), self.copies - 1], 1).reshape(-1)
        piece = np.repeat(self.piece, 2)
        some = many > 0
        symbols, many, piece = symbols[some], many[some], piece[some]
        new = np.ones(len(piece), bool)
        new[1:] = (piece[1:] != piece[:-1]) | (symbols[1:] != symbols[:-1])
        first = np.flatnonzero(new)
        out: list[list[tuple[int, int]]] = [[] for _ in self.begins]
        for p, s, n in zip(piece[first].tolist(), symbols[first].tolist(), np.add.reduceat(many, first).tolist() if len(first) else []):
            out[p].append((s, n))
        return out

    def _sum(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.piece, values, len(self.begins)).astype(np.int64)

    def counts(self) -> dict[str, np.ndarray]:
        """Per piece: faults, adjacent roles that are not legal, distinct turns."""
        later = self.copies * (self.fault != _BLANK) - (self.fault != _BLANK)  # copies behind a row's first
        same = self.piece[1:] == self.piece[:-1]
        step = np.zeros(len(self.piece), np.int64)
        step[1:] = same & ~_LEGAL[self.initial[:-1], self.initial[1:]]
        new = self.has_turn.copy()
        new[1:] &= ~same | (self.turn[1:] != self.turn[:-1]) | ~self.has_turn[:-1]
        return {
            "blank": self._sum(self.copies * (self.fault == _BLANK)), "duplicate": self._sum(later + (self.fault == _DUPLICATE)),
            "truncated": self._sum(self.fault == _TRUNCATED), "illegal": self._sum(step + self.copies - 1), "turns": self._sum(new),
        }

    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last row of every piece."""
        return self.begins, np.append(self.begins[1:], len(self.piece)) - 1


def _list_of(values: list[list[int]]) -> pa.Array:
    return pa.array(values, pa.list_(pa.int64()))


def _as_wholes(batches):
    """Pieces of conversations in several partitions: costs from state to state, and what lies at the edges."""
    for batch in batches:
        if not batch.num_rows:
            continue
        p = _Pieces(batch.column("rows"))
        costs = []
        for runs in p.runs():
            total = np.full((4, 4), _INF, np.int64)
            np.fill_diagonal(total, 0)
            for symbol, n in runs:
                for k in range(n.bit_length()):
                    if n >> k & 1:
                        total = _product(total, _power(symbol, k))
            costs.append(total.reshape(-1).tolist())
        first, last = p.ends()
        some = np.flatnonzero(p.has_turn)  # turns that are not NULL follow those that are
        low = np.searchsorted(some, first)
        low_row = some[np.minimum(low, len(some) - 1)] if len(some) else first
        turned = (low < len(some)) & (low_row <= last)
        yield pa.RecordBatch.from_arrays([
            batch.column("conv_id"), batch.column("piece"), _list_of(costs), pa.array(p.initial[first]), pa.array(p.initial[last]),
            pa.array(p.turn[low_row], mask=~turned), pa.array(p.turn[last], mask=~turned),
        ], names=["conv_id", "piece", "costs", "first", "last", "low", "high"])


def _chained(batches):
    """Per piece of a conversation: the state it is entered in, the cost to go behind it, and corrections at its front edge."""
    for batch in batches:
        out = []
        for conv, pieces in zip(batch.column("conv_id").to_pylist(), batch.column("pieces").to_pylist()):
            after, togo = [], _END
            for p in reversed(pieces):
                after.append(togo)
                m = np.array(p["costs"], np.int64).reshape(4, 4)
                togo = tuple(np.minimum((m + np.array(togo, np.int64)).min(1), _INF).tolist())
            last, high = None, None
            for p, left in zip(pieces, reversed(after)):
                illegal = int(last is not None and not _LEGAL[last, p["first"]])
                again = int(high is not None and p["low"] == high)
                out.append((conv, p["piece"], list(left), last is None, p is pieces[-1], illegal, again))
                last, high = p["last"], p["high"] if p["high"] is not None else high
        columns = list(zip(*out)) or [()] * 7
        types = pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_EDGE)


_EDGE = ["conv_id", "piece", "after", "opens", "closes", "more_illegal", "turns_again"]
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
_ENTRY = pa.struct([("row", pa.binary()), ("role", pa.string()), ("edit", pa.string())])
_SOLVED = (
    "conv_id bigint, piece bigint, opens boolean, whole boolean, low bigint, high bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, turns bigint, choices array<struct<cost: bigint, state: int, audit: string, entries: array<struct<row: binary, role: string, edit: string>>>>"
)


def _unroll(runs, after, rows, initials, state: int, entries: list) -> tuple[str, int]:
    """(audit, state behind the runs) when entered in ``state``; adds (row, new role, edit) of what stays or is inserted.

    ``rows`` and ``initials`` are those of the rows that may stay."""
    audit, at = [], 0
    for (symbol, n), left in zip(runs, after):
        now, (letters, state) = state, unrolled(symbol, n, left, state)
        audit.append(letters)
        if symbol:
            for edit in letters:
                if edit == "I" or edit == "R":
                    now = _ADDED[now]
                    entries.append((None if edit == "I" else rows[at], _ROLE[now], edit))
                elif edit == "K":
                    now = _GO[initials[at]][now]
                    entries.append((rows[at], None, edit))
                at += edit != "I"
    return "".join(audit), state


def _solved(batches):
    """Counts of every piece and its choices: from state 0 for pieces that open a conversation, else from each state."""
    for batch in batches:
        if not batch.num_rows:
            continue
        p = _Pieces(batch.column("rows"))
        counts = p.counts()
        whole = np.asarray(batch.column("after").is_null())
        afters, opens, closes = (batch.column(c).to_pylist() for c in ("after", "opens", "closes"))
        ends = np.append(p.begins[1:], len(p.piece))
        found: list[tuple] = []
        entries: list[tuple] = []
        per_piece, per_choice = [0], [0]
        for i, runs in enumerate(p.runs()):
            left = [_END if whole[i] else tuple(afters[i])]
            for symbol, n in reversed(runs):
                left.append(run_cost(symbol, n, left[-1]))
            left.reverse()
            live = p.begins[i] + np.flatnonzero(p.fault[p.begins[i]: ends[i]] < _BLANK)
            rows, initials = live.tolist(), p.initial[live].tolist()
            for state in [0] if whole[i] or opens[i] else range(4):
                audit, now = _unroll(runs, left[1:], rows, initials, state, entries)
                while (whole[i] or closes[i]) and _END[now]:
                    audit, now = audit + "I", _ADDED[now]
                    entries.append((None, _ROLE[now], "I"))
                per_choice.append(len(entries))
                found.append((left[0][state], now, audit))
            per_piece.append(len(found))
        cost, state, audit = zip(*found)
        row, role, edit = zip(*entries) if entries else ((), (), ())
        inner = pa.StructArray.from_arrays([p.row.take(pa.array(row, pa.int64())), pa.array(role, pa.string()), pa.array(edit, pa.string())], fields=list(_ENTRY))
        choice = pa.StructArray.from_arrays(
            [pa.array(cost, pa.int64()), pa.array(state, pa.int32()), pa.array(audit, pa.string()), pa.ListArray.from_arrays(pa.array(per_choice, pa.int32()), inner)],
            names=["cost", "state", "audit", "entries"])
        turned = np.bincount(p.piece, p.has_turn, len(p.begins)) > 0
        low = np.minimum.reduceat(np.where(p.has_turn, p.turn, np.iinfo(np.int64).max), p.begins)
        high = np.maximum.reduceat(np.where(p.has_turn, p.turn, np.iinfo(np.int64).min), p.begins)
        counts["illegal"] += np.asarray(pc.fill_null(batch.column("more_illegal"), 0))
        counts["turns"] -= np.asarray(pc.fill_null(batch.column("turns_again"), 0))
        yield pa.RecordBatch.from_arrays([
            batch.column("conv_id"), batch.column("piece"), pc.fill_null(batch.column("opens"), True), pa.array(whole), pa.array(low, mask=~turned), pa.array(high, mask=~turned),
            *(pa.array(counts[c]) for c in _COUNTS), pa.ListArray.from_arrays(pa.array(per_piece, pa.int32()), choice),
        ], names=["conv_id", "piece", "opens", "whole", "low", "high", *_COUNTS, "choices"])


def _walked(batches):
    """The state each piece of a conversation is entered in: that in which the piece before it is left."""
    for batch in batches:
        out = []
        for conv, pieces in zip(batch.column("conv_id").to_pylist(), batch.column("pieces").to_pylist()):
            state = 0
            for p in pieces:
                out.append((conv, p["piece"], state))
                state = p["next"][state]
        conv, piece, state = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(piece, pa.int64()), pa.array(state, pa.int32())], names=["conv_id", "piece", "entry"])


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): conversations with every twentieth row dropped, emptied, stripped of its full
    stops, repeated or given to the user, by a hash of conversation and turn; NULL roles and texts are one space."""
    blank = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("bigint").cast("string"), blank) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), blank)
    return conversations.filter(kind != 0).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), blank)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _said() -> Column:
    return F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), F.col("role"), F.col("text")).cast("binary"), 256))


def _row_key() -> Column:
    numbers = (F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in ("conv_id", "turn"))
    return F.unhex(F.sha2(F.concat(F.concat_ws(":", *numbers).cast("binary"), F.lit(b":"), F.col("said")), 256))


def _pieces(turns: DataFrame) -> DataFrame:
    """(conv_id, piece, rows): equal rows of a turn once with their number; texts stay behind, their hashes go."""
    solid = F.rtrim("text", F.lit(SPACE))
    fault = F.when(solid == "", _BLANK).when(F.right(solid, F.lit(1)).isin(".", "!", "?"), _FINE).otherwise(_TRUNCATED)
    first = F.substring("role", 1, 1)
    one = turns.select(
        "conv_id", "turn", "role", _said().alias("said"), "copies", fault.alias("fault"),
        F.when(first == "s", _S).when(first == "u", _U).when(first == "a", _A).otherwise(0).alias("initial"),
    ).groupBy("conv_id", "turn", "role", "said", "fault", "initial").agg(F.sum("copies").alias("copies"))
    one = staged(one.withColumn("row", _row_key()), "turns")
    # the first row with a role and text: its turn is the least, NULL first as in the order of rows
    firsts = one.groupBy("conv_id", "role", "said").agg(F.min(F.struct("turn")).alias("at"))
    firsts = firsts.select("conv_id", F.col("at.turn").alias("turn"), "said").select(_row_key().alias("row"), F.lit(True).alias("is_first"))
    fault = F.when(F.col("is_first").isNull() & (F.col("fault") != _BLANK), _DUPLICATE).otherwise(F.col("fault"))
    rows = one.join(firsts, "row", "left").withColumn("fault", fault).drop("is_first")
    rows = rows.repartitionByRange("conv_id", "turn", "role", "said").sortWithinPartitions("conv_id", "turn", "role", "said")
    rows = staged(rows.select("conv_id", "turn", "initial", "fault", "copies", "row").withColumn("at", F.monotonically_increasing_id()), "sorted-turns")
    item = F.struct("at", "turn", "initial", "fault", "copies", "row")
    return rows.groupBy("conv_id", F.expr("at >> 33").alias("piece")).agg(F.array_sort(F.collect_list(item)).alias("rows"))  # at most a partition's rows


def _on_piece(rows: DataFrame, other: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with columns of the few pieces in ``other``, NULL for all others."""
    other = other.select(F.col("conv_id").alias("__conv"), F.col("piece").alias("__piece"), *columns)
    return rows.join(other, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("piece") == F.col("__piece")), "left").drop("__conv", "__piece")


def plan_repairs(turns: DataFrame) -> DataFrame:
    """What to do with conversations: one row per piece of a conversation.

    ``turns`` has conv_id and turn (bigint), role and text (no NULL) and copies, how often the row stands there.  Rows go by
    turn (NULL first), rows of one turn by role and then by a hash of role and text; equal rows of a turn are neighbours.
    Columns: conv_id, piece (ascending within the conversation), opens, low and high turn, blank, duplicate, truncated,
    illegal and turns (counts that add up over pieces) and choice: cost of the whole conversation (where ``opens``), audit
    and entries.  Use repair_summary and repaired_turns to read it.
    """
    pieces = _pieces(turns)
    several = pieces.groupBy(F.col("conv_id").alias("__conv")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    split = pieces.join(several, F.col("conv_id").eqNullSafe(F.col("__conv")), "left_semi")
    wholes = split.mapInArrow(_as_wholes, "conv_id bigint, piece bigint, costs array<bigint>, first bigint, last bigint, low bigint, high bigint")
    chains = wholes.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("piece", "costs", "first", "last", "low", "high"))).alias("pieces"))
    edges = staged(chains.mapInArrow(_chained, "conv_id bigint, piece bigint, after array<bigint>, opens boolean, closes boolean, more_illegal bigint, turns_again bigint"), "edges")
    rows = _on_piece(pieces, edges, *_EDGE[2:]).select("conv_id", "piece", "rows", *_EDGE[2:])
    solved = staged(rows.mapInArrow(_solved, _SOLVED), "solved")
    exits = solved.filter("not whole").select("conv_id", "piece", F.col("choices.state").alias("next"))
    path = exits.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("piece", "next"))).alias("pieces"))
    path = path.mapInArrow(_walked, "conv_id bigint, piece bigint, entry int")
    entry = F.when(F.col("opens"), 0).otherwise(F.coalesce("entry", F.lit(0)))
    return _on_piece(solved, path, "entry").withColumn("choice", F.element_at("choices", entry + 1)).drop("choices", "entry", "whole")


def repair_summary(plan: DataFrame) -> DataFrame:
    """Per conversation that has rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    audit = F.array_sort(F.collect_list(F.struct("piece", F.col("choice.audit").alias("audit"))))
    sums = [F.sum(c).alias(c) for c in _COUNTS]
    one = plan.groupBy("conv_id").agg(
        *sums, F.min("low").alias("low"), F.max("high").alias("high"), F.sum(F.when(F.col("opens"), F.col("choice.cost"))).alias("cost"), audit.alias("parts")
    )
    return one.select(
        "conv_id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost",
        F.array_join("parts.audit", "").alias("audit"),
    )


def repaired_turns(turns: DataFrame, plan: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit) of the repaired conversations: rows kept (K), renamed (R) or inserted (I, empty
    text); place ascends within a conversation.  ``turns`` is what ``plan`` was made from."""
    stays = plan.select("conv_id", "piece", F.posexplode("choice.entries").alias("pos", "entry"))
    stays = stays.select("conv_id", F.expr("(piece << 33) | pos").alias("place"), F.col("entry.row").alias("row"), F.col("entry.role").alias("new"), F.col("entry.edit").alias("edit"))
    texts = turns.withColumn("said", _said()).select(_row_key().alias("row"), "role", "text").groupBy("row").agg(F.any_value("role").alias("own"), F.any_value("text").alias("text"))
    return stays.join(texts, "row", "left").select(
        "conv_id", "place", F.coalesce("new", "own").alias("role"), F.coalesce("text", F.lit("")).alias("text"), "edit"
    )


def _digests(batches):
    current, whole, seen = None, None, False
    for batch in batches:
        out = []
        rows = zip(batch.column("conv_id").to_pylist(), batch.column("role").to_pylist(), batch.column("text").to_pylist())
        for conv, role, text in rows:
            line = f"{role}:{text}".encode()
            if seen and conv == current:
                whole.update(b"\n")
                whole.update(line)
                continue
            if seen:
                out.append((current, whole.hexdigest()))
            current, whole, seen = conv, hashlib.sha256(line), True
        yield _digest_batch(out)
    if seen:
        yield _digest_batch([(current, whole.hexdigest())])


def _digest_batch(out: list[tuple]) -> pa.RecordBatch:
    conv, digest = zip(*out) if out else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(digest, pa.string())], names=["conv_id", "digest"])


def repair_digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, digest): SHA-256 of each repaired conversation's ``role:text`` lines.

    A SHA-256 has to read its text in order, so the rows of a conversation pass through one task; they are sorted on disk
    and streamed, none are held.  Nothing else here sends a conversation to one task."""
    rows = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "role", "text")
    return rows.mapInArrow(_digests, "conv_id bigint, digest string")


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """Damages ``conversations`` (conv_id, turn, role, text; others are not read) and repairs what is left: one row per
    original conv_id with gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    NULL ids are one conversation, NULL turns come first, NULL roles and texts are one space.  A role that is not empty and
    begins with s, u or a counts as that; an empty one is none of them.  Repeated rows are duplicates, ties of a turn go by
    role and hash (see plan_repairs).  Very long texts are hashed where they are read.  A conversation without rows has zeros, an
    empty audit and the hash of nothing; an empty table gives no rows.
    """
    turns = damage(conversations)
    plan = staged(plan_repairs(turns), "repair-plan")
    found = repair_summary(plan).select(F.col("conv_id").alias("__of"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    digests = repair_digests(repaired_turns(turns, plan)).select(F.col("conv_id").alias("__for"), "digest")
    ids = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    rows = ids.join(found, F.col("conv_id").eqNullSafe(F.col("__of")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("__for")), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return rows.select(
        "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
