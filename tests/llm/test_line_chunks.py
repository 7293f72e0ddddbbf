import random
from collections import defaultdict

import numpy as np

from morrowcart.llm import line_chunks as L
from llm_fixtures import docs_of  # noqa: F401


def _prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


def _spans(text):
    """(bytes compared, lo, hi) of every chunk of one text."""
    raw = text.encode()
    got = L.spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])) if raw else None
    return [] if got is None else [((n, raw[a:b]), lo, hi) for n, scale in enumerate(got) for _, lo, hi, a, b in zip(*(x.tolist() for x in scale))]


def _brute_pairs(rows):
    """The finest scale without the operator's code: lines split at line breaks,
    pairs of neighbours counted by their bytes; the lines that go, by document."""
    import re
    where = defaultdict(list)
    for i, t in rows:
        lines = [(m.group(0), m.start()) for m in re.finditer(r"[^\n]+", t or "") if re.search(r"[^\x20\x09-\x0D]", m.group(0))]
        for (a, pa), (b, pb) in zip(lines, lines[1:]):
            n, k = len(re.findall(r"[^\x20\x09-\x0D]+", a)), len(re.findall(r"[^\x20\x09-\x0D]+", b))
            if min(n, k) < L.WRAP and n + k >= L.MIN_WORDS:
                where[t[pa:pb + len(b)].strip(" \t\n")].append((i, pa, a, pb, b))
    gone = defaultdict(set)
    for places in where.values():
        for i, pa, a, pb, b in sorted(places)[1:]:
            gone[i] |= {pa, pb}
    return gone


def _brute(rows):
    where = defaultdict(list)
    for i, t in rows:
        for body, lo, hi in _spans(t or ""):
            where[body].append((i, lo, hi))
    cut = defaultdict(set)
    for places in where.values():
        for i, lo, hi in sorted(places)[1:]:
            cut[i] |= set(range(lo, hi))
    out = {}
    for i, t in rows:
        out[i] = None if t is None else bytes(b for n, b in enumerate(t.encode()) if n not in cut[i]).decode()
    return out


def _texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_passages_are_kept_once(docs_of):
    rng = random.Random(1)
    passage = _prose(rng, 70)                                      # one paragraph
    poem = "\n".join(_prose(rng, 8) for _ in range(14))            # fourteen short lines
    rows = []
    for i in range(40):
        parts = [_prose(rng, rng.randint(3, 60)) for _ in range(rng.randint(1, 6))]
        if i % 2:
            parts.insert(rng.randint(0, len(parts)), passage)
        if i % 3 == 0:
            parts.insert(rng.randint(0, len(parts)), poem)
        rows.append((i, "\n".join(parts)))
    got = _texts(L.dedup_lines(docs_of(rows)))
    assert got == _brute(rows)
    assert [i for i, t in got.items() if passage in t] == [1]      # the first occurrence stays
    assert sum(poem in t for t in got.values()) == 1
    left = sum(len(set(poem.split("\n")) & set(t.split("\n"))) for i, t in got.items() if i % 3 == 0 and poem not in t)
    assert left == 0                                               # a run of short lines goes whole
    clean = [t for i, t in rows if i % 2 == 0 and i % 3]
    assert all(got[i] == t for i, t in rows if t in clean)


def test_chunks_partition_and_resist_shifts():
    rng = random.Random(2)
    body = "\n".join(_prose(rng, rng.randint(4, 40)) for _ in range(80))
    a, b = ([x for x in _spans(t) if x[0][0] == 0] for t in (body, _prose(rng, 7) + "\n" + _prose(rng, 5) + "\n" + body))
    assert all(x[2] <= y[1] for x, y in zip(a, a[1:]))
    same = {x[0] for x in a} & {x[0] for x in b}
    assert len(same) > 0.9 * len(a)


def test_exact_copies_and_edges(docs_of):
    rng = random.Random(3)
    text = "\n".join(_prose(rng, 30) for _ in range(5))
    long = "\n".join(_prose(rng, 40) for _ in range(9000))         # over 2 MB
    rows = [(5, text), (6, text), (7, text), (1, None), (2, ""), (3, "\n\n \n"), (4, "é ü\n" * 30), (8, long), (9, "x\n" + long)]
    got = _texts(L.dedup_lines(docs_of(rows)))
    assert got == _brute(rows)
    assert got[5] == text and got[8] == long
    assert len(got[6]) < 0.2 * len(text) and got[7] == got[6] and len(got[9]) < 0.2 * len(long)   # chunks of few words stay
    twice = L.dedup_lines(docs_of([(1, text), (1, text), (None, text)])).collect()
    assert [r.text for r in twice if r.doc_id == 1] == [got[6]] * 2 and [r.text for r in twice if r.doc_id is None] == [text]  # null sorts first
    same = L.dedup_lines(docs_of([(1, text), (1, text)])).collect()
    assert [r.text for r in same] == [text, text]                  # equal rows are one document
    assert L.dedup_lines(docs_of(rows).where("false")).count() == 0
    clash = docs_of([(1, text), (2, text)]).selectExpr("*", "7 AS rid", "8 AS k1", "9 AS cuts", "0 AS row")
    assert sorted((r.doc_id, r.text, r.rid, r.k1, r.cuts, r.row) for r in L.dedup_lines(clash).collect()) == [(1, text, 7, 8, 9, 0), (2, got[6], 7, 8, 9, 0)]


def test_short_passages_go_whole(docs_of):
    """Runs of 2 to 20 short lines shared by two documents, between differing
    lines: all of their lines go from the second, none from the first."""
    rng = random.Random(4)
    rows, shared = [], {}
    for k in (2, 3, 4, 5, 6, 8, 12, 20):
        for trial in range(6):
            run = [_prose(rng, rng.randint(10, 20)) for _ in range(k)]
            for _ in range(2):
                rows.append((len(rows), "\n".join([_prose(rng, rng.randint(10, 20)) for _ in range(3)] + run + [_prose(rng, rng.randint(10, 20)) for _ in range(3)])))
            shared[len(rows) - 1] = run
    got = _texts(L.dedup_lines(docs_of(rows)))
    for i, run in shared.items():
        assert not set(run) & set(got[i].split("\n"))
        assert got[i].split("\n") == [x for x in rows[i][1].split("\n") if x not in run]  # the rest keeps its bytes
        assert got[i - 1] == rows[i - 1][1]


def test_pairs_of_lines_match_brute_force(docs_of):
    """Few line texts, blank lines, short and long lines: what goes at the finest
    scale is what a count of neighbouring lines says, and every line stays somewhere."""
    rng = random.Random(6)
    pool = [_prose(rng, n) for n in (1, 3, 4, 5, 6, 9, 12, 23)] + [_prose(rng, 9) for _ in range(30)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 8)))) for i in range(60)]
    out = L.dedup_lines(docs_of(rows)).collect()
    got, gone = {r.doc_id: r.text for r in out}, _brute_pairs(rows)
    for i, t in rows:
        kept, at = [], 0
        for line in t.split("\n"):
            if at not in gone[i]:
                kept.append(line)
            at += len(line) + 1
        assert [x for x in got[i].split("\n") if x] == kept
    assert {x for _, t in rows for x in t.split("\n")} == {x for t in got.values() for x in t.split("\n") if x}
    assert all(r.removed_bytes == len(t) - len(r.text) and (r.removed_chunks > 0) == (r.text != t) for r, (_, t) in zip(sorted(out), rows))


def test_single_lines_stay_and_result_columns_are_replaced(docs_of):
    rng = random.Random(7)
    line, other = _prose(rng, 20), _prose(rng, 2)
    rows = [(i, "\n".join([_prose(rng, 9), line, _prose(rng, 9), other, _prose(rng, 4)])) for i in range(30)]
    assert _texts(L.dedup_lines(docs_of(rows))) == dict(rows)
    named = docs_of([(1, line + "\n" + other), (2, line + "\n" + other)]).selectExpr("*", "'x' AS removed_chunks", "'y' AS removed_bytes", "1 AS row_id", "2 AS row_rid", "3 AS id")
    got = L.dedup_lines(named)
    assert len(got.columns) == len(set(got.columns)) == len(named.columns)
    assert sorted((r.doc_id, r.text, r.removed_chunks, r.row_id, r.row_rid, r.id) for r in got.collect()) == [(1, line + "\n" + other, 0, 1, 2, 3), (2, "", 1, 1, 2, 3)]
