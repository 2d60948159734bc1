"""Repairs of conversations against a search over all edits, row by row."""

import hashlib
import random
import re
import zlib

import pytest
from conftest import SMALL

from weighlens.llm import run_length_repair as repair
from weighlens.llm.common import table

FORM = re.compile(r"(s?(ua)+)?")
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def _damaged(rows):
    """Rows (turn, role, text) of one conversation after damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    said = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).digest()
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), said(r)))


def _faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        solid = text.rstrip(BLANK)
        out.append("b" if not solid else "d" if (role, text) in seen else "" if solid[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def _least(rows, faults):
    """(cost, audit, repaired) by keeping, for every place and string of initials' state, the least (cost, audit)."""
    go = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def inserted(states):
        for _ in range(4):
            for state, (cost, audit, text) in list(states.items()):
                for role in ("user", "assistant"):
                    to = go.get((state, role[0]))
                    new = (cost + 5, audit + "I", text + (f"{role}:",))
                    if to and new < states.get(to, (10**9,)):
                        states[to] = new
        return states

    states = inserted({"": (0, "", ())})
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, out) in states.items():
            options = [(state, (cost + 2, audit + "D", out))]
            if fault not in ("b", "d"):
                more = 5 * (fault == "t")
                options += [(go.get((state, role[:1])) if role else None, (cost + more, audit + "K", out + (f"{role}:{text}",)))]
                options += [(go.get((state, n[0])), (cost + 1 + more, audit + "R", out + (f"{n}:{text}",))) for n in ("user", "assistant")]
            for to, new in options:
                if to is not None and new < after.get(to, (10**9,)):
                    after[to] = new
        states = inserted(after)
    return min(v for k, v in states.items() if k in ("", "a"))


def _expected(data):
    out = []
    for conv in {r[0] for r in data}:
        rows = _damaged([r for r in data if r[0] == conv])
        faults = _faults(rows)
        cost, audit, text = _least(rows, faults) if rows else (0, "", ())
        turns = [t for t, _, _ in rows if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                    illegal, cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest()))
    return out


COLUMNS = "conv_id bigint, turn bigint, role string, text string"


def _check(data, found):
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, _expected(data)))


def _some(rng, convs, most):
    texts = ["", " \t", "yes.", "no", "why? ", "stop!\n", "é。", "a.b", ".", None, "more words here.", "\x1c"]
    roles = ["system", "user", "assistant"] * 4 + ["tool", "u", None, "", "Sys"]
    return [(c, rng.choice([t, t, t, rng.randrange(most), None]), rng.choice(roles), rng.choice(texts)) for c in range(convs) for t in range(rng.randrange(most))]


def test_brute_force_agrees_with_all_edits():
    """The search the other tests compare with is right: on short rows, all sequences of edits."""
    def every(rows, faults):
        best = (10**9,)

        def go(at, cost, audit, initials, text, added):
            nonlocal best
            if at == len(rows) and FORM.fullmatch(initials):
                best = min(best, (cost, audit, text))
            if added < 4:
                for r in ("user", "assistant"):
                    go(at, cost + 5, audit + "I", initials + r[0], text + (f"{r}:",), added + 1)
            if at == len(rows):
                return
            (_, role, said), fault = rows[at], faults[at]
            go(at + 1, cost + 2, audit + "D", initials, text, added)
            if fault not in ("b", "d"):
                more = 5 * (fault == "t")
                if role[:1]:
                    go(at + 1, cost + more, audit + "K", initials + role[0], text + (f"{role}:{said}",), added)
                for r in ("user", "assistant"):
                    go(at + 1, cost + more + 1, audit + "R", initials + r[0], text + (f"{r}:{said}",), added)

        go(0, 0, "", "", (), 0)
        return best

    rng = random.Random(1)
    for _ in range(60):
        rows = [(0, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", "", "c."])) for _ in range(rng.randrange(4))]
        assert every(rows, _faults(rows)) == _least(rows, _faults(rows))


def test_random_conversations(rows):
    data = _some(random.Random(4), 300, 14)
    _check(data, repair.repair_conversations(rows(data, COLUMNS)).collect())


@pytest.mark.parametrize("seed", range(2))
def test_a_conversation_in_many_partitions(spark, rows, seed):
    """One conversation has most rows; it crosses partitions, and so do its turns."""
    rng = random.Random(seed)
    data = [(7, t // 2, rng.choice(["user", "assistant", "user", "system"]), rng.choice(["yes.", "no", f"word {t}.", f"word {t}", ""])) for t in range(1500)]
    data += _some(rng, 20, 8)
    docs = rows(data, COLUMNS).repartition(6)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        plan = repair.plan_repairs(repair.damage(docs))
        assert plan.filter("conv_id = 7").count() > 5
        _check(data, repair.repair_conversations(docs).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_runs_by_powers():
    rng = random.Random(8)
    for _ in range(200):
        symbol, n, after = rng.randrange(9), rng.randrange(1, 200), tuple(rng.randrange(40) for _ in range(4))
        costs = repair._inside(symbol, n, after)
        step = list(after)
        for i in range(n, -1, -1):
            assert costs[i].tolist() == list(step) and (i or repair.run_cost(symbol, n, after) == tuple(step))
            step = (repair._matrix(symbol) + step).min(1)
    assert repair.run_cost(0, 10**12, (0, 10, 5, 0))[0] == 2 * 10**12
    assert repair.unrolled(0, 100, (0, 10, 5, 0), 3) == ("D" * 100, 3)


def test_nulls_repeats_long_texts_and_clashing_columns(rows):
    long = "wort " * 200_000 + "."
    data = [(None, None, None, None), (None, 3, "user", "a."), (1, 1, "user", long), (1, 2, "assistant", long), (1, 2, "assistant", long), (2, 5, "user", "hi."),
            (2, 5, "user", "hi."), (2, 5, "assistant", "ho."), (2, 5, "", "x."), (2, 6, "s", "y.")] + [(3, 1, "user", "same.")] * 40
    docs = rows([(*r, 1, "x") for r in data], COLUMNS + ", copies int, piece string")
    _check(data, repair.repair_conversations(docs).collect())
    assert repair.repair_conversations(rows([], COLUMNS)).count() == 0


def test_repaired_turns_alternate(spark):
    turns = repair.damage(table(spark, SMALL, "conversations"))
    plan = repair.plan_repairs(turns)
    kept = {}
    for r in sorted(repair.repaired_turns(turns, plan).collect(), key=lambda r: r["place"]):
        kept.setdefault(r["conv_id"], []).append(r)
        assert (r["edit"] == "I") <= (r["text"] == "")
    assert kept and all(FORM.fullmatch("".join(r["role"][0] for r in c)) for c in kept.values())
    audits = {r["conv_id"]: r["audit"] for r in repair.repair_summary(plan).collect()}
    assert all("".join(r["edit"] for r in c) == audits[i].replace("D", "") for i, c in kept.items())


def test_table(spark):
    data = [tuple(r) for r in table(spark, SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    _check(data, repair.repair_conversations(table(spark, SMALL, "conversations")).collect())
