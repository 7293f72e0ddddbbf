import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from morrowcart.llm import conversation_repair as R

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"
LEGAL = re.compile("(s?(ua)+)?")


def _faults(rows):
    """First fault of each (role, text), by the definition."""
    out = []
    for i, (role, text) in enumerate(rows):
        seen = text.rstrip(SPACES)
        out.append("b" if not seen else "d" if (role, text) in rows[:i] else "t" if seen[-1] not in ".!?" else "k")
    return out


def _every_repair(rows, faults):
    """All repairs with at most two inserts between rows: (cost, audit, repaired rows)."""
    found = []

    def go(i, cost, audit, out):
        for k in range(3):
            for roles in itertools.product(("user", "assistant"), repeat=k):
                now = out + [(r, "") for r in roles]
                c, a = cost + 2 * k, audit + "I" * k
                if i == len(rows):
                    if LEGAL.fullmatch("".join(r[:1] for r, _ in now)):
                        found.append((c, a, now))
                    continue
                role, text = rows[i]
                go(i + 1, c + 3, a + "D", now)
                if faults[i] in "bd":
                    continue
                cut = faults[i] == "t"
                go(i + 1, c + cut, a + "K", now + [(role, text)])
                for new in ("user", "assistant"):
                    go(i + 1, c + 2 + cut, a + "R", now + [(new, text)])

    go(0, 0, "", [])
    return min(found)


def _reference(initials, faults):
    """The same by dynamic programming over whole strings, for longer conversations."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {"": (0, "")}

    def offer(d, q, v):
        if q not in d or v < d[q]:
            d[q] = v

    def with_inserts(d):
        for _ in range(3):
            for q, (c, a) in list(d.items()):
                offer(d, "a" if q == "u" else "u", (c + 2, a + "I"))
        return d

    for x, f in zip(initials, faults):
        new = {}
        for q, (c, a) in with_inserts(dict(best)).items():
            offer(new, q, (c + 3, a + "D"))
            if f not in "bd":
                offer(new, "a" if q == "u" else "u", (c + 2 + (f == "t"), a + "R"))
                if (q, x) in step:
                    offer(new, step[q, x], (c + (f == "t"), a + "K"))
        best = new
    d = with_inserts(best)
    return min(d[q] for q in ("", "a") if q in d)


def test_cheapest_of_all_repairs():
    rnd = random.Random(3)
    for _ in range(60):
        rows = [(rnd.choice(["system", "user", "user", "assistant", "tool"]), rnd.choice(["Yes.", "no", " ", "So it is! ", "ok?"])) for _ in range(rnd.randint(0, 3))]
        faults = _faults(rows)
        cost, audit, out = _every_repair(rows, faults)
        initials = "".join(r[0] if r[0] in "sua" else "x" for r, _ in rows)
        assert R.solve(initials, "".join(faults)) == (cost, audit)
        made = list(R.edits(audit, [(None, x, r, t) for x, (r, t) in zip(initials, rows)]))
        assert [(r, t) for _, _, r, t in made] == out


def test_long_conversations_in_blocks(monkeypatch):
    rnd = random.Random(5)
    for n in (0, 1, 40, 700):
        for _ in range(4):
            initials = "".join(rnd.choice("suuaax") for _ in range(n))
            faults = "".join(rnd.choice("kkktbd") for _ in range(n))
            want = _reference(initials, faults)
            assert R.solve(initials, faults) == want and R.finish(R.table(initials, faults)) == want
            for size in (1, 3, 64):
                monkeypatch.setattr(R, "BLOCK", size)
                assert R.finish(R.table(initials, faults)) == want
            monkeypatch.undo()


def test_agenda_pops_in_rising_order_and_stops_at_the_goal():
    popped = []
    edges = R._edges("xuxa", "ktbk") + [("goal", ((4, q),), (0, "")) for q in R.FINAL]

    def note(item):
        popped.append(item)
        return item == "goal"

    final = R.lightest({(0, R.START): (0, ""), **R._rows(4)}, edges, note)
    assert [final[i] for i in popped] == sorted(final[i] for i in popped)
    assert popped[-1] == "goal" and len(popped) < 4 + 5 * 4 + 1


def _expected(rows):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)} of (conv, turn, role, text) rows."""
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    out = {}
    for c, turns in by.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:R.HEAD], hashlib.sha256(r[2].encode()).hexdigest()))
        own = [(r, x) for _, r, x in turns]
        faults = _faults(own)
        initials = [r[0] if r[:1] in ("s", "u", "a") else "x" for r, _ in own]
        known = [t for t, _, _ in turns if t is not None]
        cost, audit = _reference(initials, faults)
        text = "\n".join(f"{r}:{x}" for _, _, r, x in R.edits(audit, [(None, i, r, x) for i, (r, x) in zip(initials, own)]))
        out[c] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                  sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def _got(df, **how):
    plans = R.repair_plans(df, **how)
    return {r[0]: tuple(r[1:]) for r in R.repaired_digests(df, plans).collect()}


def test_edges(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, None, None, None), (2, None, "user", "Late."), (2, 5, "user", ""), (2, 9, "", "Odd."),
            (None, 1, "assistant", "No one asked."), (None, 1, "assistant", "No one asked."), (3, 0, "user", "a " * 200_000), (3, 0, "user", "é \n"),
            (4, 1, "assistant", "B."), (4, 1, "assistant", "A."), (4, -7, "system", "S!"), (5, 0, "user", "Same."), (5, 1, "user", "Same."), (5, 2, "system", "x")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"audit": F.lit("x"), "conv": F.lit(1), "at": F.lit(2), "digest": F.lit("d"), "plan": F.lit(0)})
    want = _expected(rows)
    assert _got(df) == want
    assert _got(df, ranges=7) == want  # conversations that span ranges
    ids = spark.createDataFrame([(1,), (77,), (77,), (None,)], "conv_id long")
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert _got(df, known=ids) == want | {77: empty}
    none = df.where("false")
    assert _got(none) == {} and _got(none, known=ids) == {1: empty, 77: empty, None: empty}
    assert R.repaired(none, R.repair_plans(none)).count() == 0


def test_repaired_rows(spark):
    rows = [(1, 3, "assistant", "B."), (1, 1, "user", "A."), (1, 7, "assistant", "C."), (2, 0, "tool", "Z.")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in R.repaired(df, R.repair_plans(df)).orderBy("conv_id", "position").collect()]
    assert [g for g in got if g[0] == 1] == [(1, 0, "K", 1, "user", "A."), (1, 1, "K", 3, "assistant", "B."), (1, 2, "I", None, "user", ""), (1, 3, "K", 7, "assistant", "C.")]
    assert [g for g in got if g[0] == 2] == []  # deleting costs 3, rerole and insert 4


@pytest.mark.parametrize("ranges", [None, 16])
def test_one_conversation_holds_most_rows(spark, ranges):
    rnd = random.Random(9)
    rows = [(0, t if rnd.random() < 0.9 else None, rnd.choice(["user", "assistant", "assistant", "bot"]), rnd.choice(["Same.", "cut", "", f"Text {t}.", f"Text {t}"])) for t in range(1500)]
    rows += [(0, 40, "user", "Same.")] * 500  # one row again and again
    rows += [(c, t, rnd.choice(["user", "assistant"]), f"{t}.") for c in range(1, 60) for t in range(rnd.randint(1, 5))]
    rnd.shuffle(rows)
    assert _got(spark.createDataFrame(rows, SCHEMA).repartition(4), ranges=ranges) == _expected(rows)


def test_damage_by_hand(spark):
    import zlib
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(12) for t in (0, 1, 2, None)] + [(None, 3, None, None)]
    got = sorted(map(tuple, R.damaged(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    want = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", x or " "
        row = (c, t, "user" if kind == 4 else r, {1: "", 2: "One Two Three" if len(x) > 1 else x}.get(kind, x))
        want += [] if kind == 0 else [row, row] if kind == 3 else [row]
    assert got == sorted(want, key=str) and len(want) != len(rows)
