"""Conversation repair against a plain search over all audits, and the whole query against plain Python and DuckDB."""

import hashlib
import random
import re
import zlib

import pytest

from kitwise.llm import dialogs, oracle, queries

from compare import compare, duck

SF001 = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"


def plain_audit(rows):
    """(cost, audit, repaired lines) of the least cheapest audit; rows: (role, text, must go, cost if kept)."""
    fit = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    def with_inserts(paths):
        out = dict(paths)
        for _ in range(3):
            for state, (cost, audit, lines) in list(out.items()):
                role = fit[state]
                found = (cost + 2, audit + "I", [*lines, f"{role}:"])
                out[role[0]] = min(out.get(role[0], found), found)
        return out

    paths = {"": (0, "", [])}
    for role, text, gone, extra in rows:
        step = {}

        def offer(state, path, step=step):
            step[state] = min(step.get(state, path), path)

        for state, (cost, audit, lines) in with_inserts(paths).items():
            offer(state, (cost + 3, audit + "D", lines))
            if not gone:
                want = fit[state]
                offer(want[0], (cost + 2 + extra, audit + "R", [*lines, f"{want}:{text}"]))
                if role[:1] == want[0] or (state == "" and role[:1] == "s"):
                    offer(role[0], (cost + extra, audit + "K", [*lines, f"{role}:{text}"]))
        paths = step
    return min(p for s, p in with_inserts(paths).items() if s in ("", "a"))


def plain(rows):
    """The contract's result by conversation, from (conv_id, turn, role, text) rows."""
    by_id = {}
    for conv, turn, role, text in rows:
        own = by_id.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if harm == 1 else text.translate({ord(c): None for c in ".!?"}) if harm == 2 else text
        own += [(turn, "user" if harm == 4 else role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    out = {}
    for conv, own in by_id.items():
        digest = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:32].encode(), digest(r)))
        seen, coded, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            shown = text.rstrip(SPACES)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            coded.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit, lines = plain_audit(coded)
        out[conv] = (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(df, **sizes):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = dialogs.repair_damaged(df, **sizes).collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


def some_rows(seed, conversations, longest):
    rnd = random.Random(seed)
    words = ["Yes.", "no", "Why?", "", " \t", "Hm!", "so. ", None, "é."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    rows = []
    for conv in [*range(conversations), None]:
        for turn in range(rnd.randint(1, longest)):
            turn = rnd.choice([turn, turn, turn, turn, turn + 1, None])
            rows.append((conv, turn, rnd.choice(roles), rnd.choice(words) if rnd.random() < 0.4 else f"t{rnd.random()}."))
            if rnd.random() < 0.1:
                rows.append(rows[-1])
    rnd.shuffle(rows)
    return rows


def test_divide_and_conquer_equals_the_plain_search():
    rnd = random.Random(5)
    kinds = {0: "s", 1: "u", 2: "a", 3: "x"}
    for _ in range(4000):
        codes = bytes(rnd.choice((0, 1, 1, 2, 2, 3, 4, 5, 6, 7, 8)) for _ in range(rnd.randint(0, 12)))
        rows = [("x", "", True, 0) if c == dialogs.GONE else (kinds[c & 3], "", False, c >> 2) for c in codes]
        cost, audit, _ = plain_audit(rows)
        assert dialogs._whole(codes) == (audit, cost)
        cut = rnd.randint(0, len(codes))
        pieces = [p for p in (codes[:cut], codes[cut:]) if p]
        states, total = dialogs._crossings([dialogs.transfer(p) for p in pieces], 0, None)
        joined = "".join(dialogs.solve(p, states[i], states[i + 1]) for i, p in enumerate(pieces))
        assert (joined + dialogs.ENDING[states[-1]], total) == (audit, cost)


@pytest.mark.parametrize("sizes", [{}, {"block_bits": 3, "fan_bits": 1}])
def test_query_equals_plain_python(spark, sizes):
    rows = some_rows(7, 8, 14) + [(99, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(60)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{SCHEMA}, pos long, conv string")
    assert got(df, **sizes) == plain(rows)


def test_text_ids_and_empty_table(spark):
    rows = [("a", 0, "user", "x."), ("", 0, "user", "x."), (None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA.replace("conv_id long", "conv_id string"))
    assert got(df) == plain(rows)
    assert got(df.limit(0)) == {}
    assert dialogs.Repair(df.limit(0)).rows_repaired().count() == 0


def test_repaired_rows_alternate(spark):
    rows = [(1, i, r, f"{i}.") for i, r in enumerate(["system", "assistant", "user", "user", "assistant", "user"])]
    fixed = dialogs.Repair(spark.createDataFrame(rows, SCHEMA)).rows_repaired().orderBy("place").collect()
    assert re.fullmatch("s(ua)+", "".join(r["role"][0] for r in fixed))
    assert {r["conv_id"] for r in fixed} == {1} and fixed[0]["text"] == "0."


def test_query_equals_its_sql(spark):
    assert compare(queries.op12_dialogs(spark, SF001), duck(SF001), oracle.DIALOGS) == []
