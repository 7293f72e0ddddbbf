from morrowcart.llm import preference as P


def _turns(spark, rows):
    return spark.createDataFrame(rows, "pair_id long, turn long, role string, text string")


def _show(turns):
    return "".join(f"<|{r or ''}|>\n{t or ''}<|end|>\n" for r, t in turns)


def _brute(a, b):
    k = 0
    while k < min(len(a), len(b)) and tuple(x or "" for x in a[k]) == tuple(x or "" for x in b[k]):
        k += 1
    return _show(a[:k]), _show(a[k:]), _show(b[k:]), k


def _trained(text, mask):
    return "".join(text[int(x):int(y)] for x, y in (s.split("-") for s in mask.split(";") if s))


CASES = {
    1: ([("system", "s"), ("user", "q"), ("assistant", "good")], [("system", "s"), ("user", "q"), ("assistant", "bad é\n"), ("user", "?"), ("assistant", "more")]),
    2: ([("user", "q")], [("user", "q")]),
    3: ([("user", "x")], [("user", "y")]),
    4: ([("user", "q"), ("assistant", "a")], [("user", "q")]),
    5: ([(None, None), ("assistant", None)], [("", ""), ("assistant", "t")]),
    6: ([("assistant", "a" * 70_000), ("user", "u")] * 3, [("assistant", "a" * 70_000)]),
    None: ([("user", "n")], [("user", "m")]),
}


def test_prefix_completions_and_masks(spark):
    rows = lambda k: [(p, i, *t) for p, sides in CASES.items() for i, t in reversed(list(enumerate(sides[k])))]
    got = {r.pair_id: r for r in P.format_pairs(_turns(spark, rows(0)), _turns(spark, rows(1))).collect()}
    assert set(got) == set(CASES)
    for p, (a, b) in CASES.items():
        prompt, x, y, k = _brute(a, b)
        r = got[p]
        assert (r.prompt, r.chosen, r.rejected, r.prefix_turns, r.chosen_turns, r.rejected_turns) == (prompt, x, y, k, len(a) - k, len(b) - k)
        for out, mask, side in ((r.chosen, r.chosen_mask, a), (r.rejected, r.rejected_mask, b)):
            assert _trained(out, mask) == "".join(f"{t or ''}<|end|>\n" for q, t in side[k:] if q == "assistant")


def test_one_side_repeats_and_empty(spark):
    a = _turns(spark, [(1, 0, "user", "q"), (1, 0, "user", "q"), (2, 0, "user", "z")])
    b = _turns(spark, [(1, 0, "user", "q"), (3, 0, "assistant", "w")])
    got = {r.pair_id: (r.prompt, r.chosen, r.rejected) for r in P.format_pairs(a, b).collect()}
    q = _show([("user", "q")])
    assert got == {1: (q, q, ""), 2: ("", _show([("user", "z")]), ""), 3: ("", "", _show([("assistant", "w")]))}
    assert P.format_pairs(a.where("false"), b.where("false")).count() == 0
    clash = a.selectExpr("*", "1 AS a", "2 AS x", "3 AS prompt")
    assert P.format_pairs(clash, b).count() == 3


def test_stale_replies(spark):
    c = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "first"), (1, 2, "user", "r"), (1, 3, "assistant", "second"),
                               (2, 0, "user", "q"), (2, 1, "assistant", "only"), (3, 0, "user", "alone")], "conv_id long, turn long, role string, text string")
    got = {r.pair_id: r for r in P.format_pairs(*P.stale_reply_pairs(c)).collect()}
    assert got[1].prefix_turns == 3 and "second" in got[1].chosen and "first" in got[1].rejected
    assert got[2].prefix_turns == 1 and got[2].rejected == "" and "only" in got[2].chosen
    assert (got[3].prefix_turns, got[3].chosen, got[3].rejected) == (1, "", "")
