"""DuckDB SQL for every registered query: the correctness oracle.

Written independently of the Spark plans: each label day's window is a
range join on explicit bounds, counts are ``count(*) FILTER``, distinct
counts are ``count(DISTINCT ...)``, the sample is ``ORDER BY md5 LIMIT n``.
Only the column names (and their order) come from ``functions.names``.
Tables ``events`` and ``part`` are the pre-registered driver views.
"""

from __future__ import annotations

import datetime as dt

from ..config import BEHAVIORS, HOURS, PURCHASE, BoostParams, Calendar, FeatureOptions
from ..functions import names as N
from ..sources.fixture import DAMAGE, EVENT_BEHAVIOR, ITEM_MAX_SIZE, N_CATEGORIES
from . import registry as REG


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


class Oracle:
    def __init__(self, cal: Calendar):
        self.cal = cal
        self.blist = ", ".join(_d(x) for x in cal.blackout_days)

    # ---- base relations -------------------------------------------------
    def base_ctes(self) -> list[str]:
        cal = self.cal
        bt = " ".join(f"WHEN '{k}' THEN {v}" for k, v in EVENT_BEHAVIOR.items())
        item = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
        lb = ", ".join(f"label_day - {k} - shift AS lb_{n}_start"
                       for k, n in zip(cal.lookbacks, N.lookback_labels(cal)))
        lbs = ", ".join(f"score_day - {k} - shift AS lb_{n}_start"
                        for k, n in zip(cal.lookbacks, N.lookback_labels(cal)))
        not_b = lambda c: f"{c} NOT IN ({self.blist})" if cal.blackout_days else "TRUE"
        in_b = lambda c: f"{c} IN ({self.blist})" if cal.blackout_days else "FALSE"
        last_b = _d(cal.last_blackout) if cal.blackout_days else "DATE '9999-12-31'"
        return [
            f"""raw AS (SELECT event_id, user_id, {item} AS item_id,
                   {item} % {N_CATEGORIES} AS item_category,
                   CASE event_type {bt} END AS behavior_type,
                   strftime(ts, '%Y-%m-%d %H') AS time
                FROM events)""",
            f"items AS (SELECT p_partkey AS item_id FROM part WHERE p_size <= {ITEM_MAX_SIZE})",
            f"""clean AS (SELECT event_id, user_id, item_id, item_category, behavior_type,
                   CAST(split_part(time, ' ', 2) AS INTEGER) AS hour,
                   CAST(split_part(time, ' ', 1) AS DATE) AS day
                FROM raw SEMI JOIN items USING (item_id)
                WHERE {not_b("CAST(split_part(time, ' ', 1) AS DATE)")}
                  AND behavior_type IN ({", ".join(map(str, BEHAVIORS))}))""",
            f"""labels AS (SELECT label_day FROM (
                   SELECT CAST({_d(cal.end_label)} - CAST(i AS INTEGER) AS DATE) AS label_day
                   FROM range(0, {cal.search_days}) t(i))
                WHERE {not_b("label_day")} AND {not_b("label_day - 1")}
                ORDER BY label_day DESC LIMIT {cal.n_labels})""",
            f"""spine0 AS (SELECT label_day,
                   label_day - (CASE WHEN label_day >= {last_b} THEN {cal.slot + cal.n_blackout}
                                ELSE {cal.slot} END) + 1 AS win_start,
                   label_day - 1 AS win_end, label_day - 1 AS day1,
                   CASE WHEN {in_b(f"label_day - {cal.lookback_probe}")} THEN {cal.n_blackout}
                        ELSE 0 END AS shift
                FROM labels)""",
            f"spine AS (SELECT *, {lb} FROM spine0)",
            f"""sspine0 AS (SELECT score_day + 1 AS label_day, score_day - {cal.slot - 2} AS win_start,
                   score_day AS win_end, score_day AS day1,
                   CASE WHEN {in_b(f"score_day - {cal.lookback_probe}")} THEN {cal.n_blackout}
                        ELSE 0 END AS shift, score_day
                FROM (SELECT {_d(cal.score_day)} AS score_day))""",
            f"sspine AS (SELECT * EXCLUDE (score_day), {lbs} FROM sspine0)",
            "win AS (SELECT s.*, c.* EXCLUDE (day), c.day FROM spine s "
            "JOIN clean c ON c.day BETWEEN s.win_start AND s.win_end)",
            "swin AS (SELECT s.*, c.* EXCLUDE (day), c.day FROM sspine s "
            "JOIN clean c ON c.day BETWEEN s.win_start AND s.win_end)",
        ]

    def q(self, body: str, extra: list[str] | None = None) -> str:
        ctes = self.base_ctes() + (extra or [])
        return "WITH " + ",\n".join(ctes) + "\n" + body

    # ---- feature fragments ---------------------------------------------
    def count_cols(self, e: N.Entity) -> list[str]:
        cal = self.cal
        conds = {"w": "TRUE", "1d": "day = day1"}
        for n in N.lookback_labels(cal):
            conds[n] = f"day >= lb_{n}_start"
        return [f"count(*) FILTER (WHERE {conds[w]} AND behavior_type = {b}) AS {N.cnt(e, w, b)}"
                for w in ["w", "1d", *N.lookback_labels(cal)] for b in BEHAVIORS]

    def counts(self, e: N.Entity, win: str = "win") -> str:
        keys = ", ".join(e.keys)
        return (f"SELECT label_day, {keys}, {', '.join(self.count_cols(e))} "
                f"FROM {win} GROUP BY label_day, {keys}")

    def avg_exprs(self, e: N.Entity) -> list[str]:
        return [f"CAST({N.cnt(e, 'w', b)} AS DOUBLE) / CAST({self.cal.slot} AS DOUBLE) AS {a}"
                for b, a in zip(BEHAVIORS, N.avg_names(e))]

    def ratio_exprs(self, e: N.Entity, w: str = "w") -> list[str]:
        return [f"COALESCE(CAST({N.cnt(e, w, b)} AS DOUBLE) / NULLIF({N.cnt(e, w, PURCHASE)}, 0), "
                f"CAST(0 AS DOUBLE)) AS {r}"
                for b, r in zip(N.RATIO_BEHAVIORS, N.ratio_names(e, w))]

    def uniq(self, win: str = "win") -> str:
        cols = ", ".join(f"count(DISTINCT user_id) FILTER (WHERE behavior_type = {b}) AS {n}"
                         for b, n in zip(BEHAVIORS, N.uniq_names()))
        return f"SELECT label_day, item_id, {cols} FROM {win} GROUP BY label_day, item_id"

    def active_days(self, win: str = "win") -> str:
        cols = ", ".join(f"count(DISTINCT day) FILTER (WHERE behavior_type = {b}) AS {n}"
                         for b, n in zip(BEHAVIORS, N.active_day_names()))
        return f"SELECT label_day, user_id, {cols} FROM {win} GROUP BY label_day, user_id"

    def hour_bounds(self, e: N.Entity, win: str = "win") -> str:
        keys = ", ".join(e.keys)
        names = N.hour_names(e)
        cols = [f"min(hour) AS {names[0]}", f"max(hour) AS {names[1]}"]
        if e is N.USER:
            cols.append(f"max(hour) - min(hour) AS {names[2]}")
        return (f"SELECT label_day, {keys}, {', '.join(cols)} FROM {win} "
                f"WHERE day = day1 GROUP BY label_day, {keys}")

    def max_behavior(self, e: N.Entity, win: str = "win") -> str:
        keys = ", ".join(e.keys)
        return (f"SELECT label_day, {keys}, max(behavior_type) AS {N.maxbt_name(e)} FROM {win} "
                f"WHERE day = day1 GROUP BY label_day, {keys}")

    def grid(self, e: N.Entity, win: str = "win") -> str:
        keys = ", ".join(e.keys)
        cols = ", ".join(f"count(*) FILTER (WHERE hour = {h} AND behavior_type = {b}) "
                         f"AS {N.grid_name(e, h, b)}" for h in HOURS for b in BEHAVIORS)
        return (f"SELECT label_day, {keys}, {cols} FROM {win} "
                f"WHERE day = day1 GROUP BY label_day, {keys}")

    def family(self, e: N.Entity, win: str = "win") -> str:
        """Family table: counts joined to its derived and last-day columns."""
        cal = self.cal
        keys = list(e.keys)
        on = " AND ".join(f"k.{c} = x.{c}" for c in ["label_day", *keys])
        sel = {c: f"k.{c}" for c in N.count_names(e, cal)}
        joins = []
        if e in (N.USER, N.ITEM, N.CATEGORY):
            for ex in self.avg_exprs(e) + self.ratio_exprs(e):
                expr, name = ex.rsplit(" AS ", 1)
                sel[name] = expr
        if e in (N.USER, N.USER_ITEM, N.USER_CATEGORY):
            joins.append(f"LEFT JOIN ({self.hour_bounds(e, win)}) x ON {on}")
            for n in N.hour_names(e):
                sel[n] = f"COALESCE(x.{n}, 0)"
        if e in (N.USER_ITEM, N.USER_CATEGORY):
            joins.append(f"LEFT JOIN ({self.max_behavior(e, win)}) y ON {on.replace('x.', 'y.')}")
            sel[N.maxbt_name(e)] = f"COALESCE(y.{N.maxbt_name(e)}, 0)"
        if e is N.ITEM:
            joins.append(f"LEFT JOIN ({self.uniq(win)}) z ON {on.replace('x.', 'z.')}")
            for n in N.uniq_names():
                sel[n] = f"COALESCE(z.{n}, 0)"
        cols = ", ".join(f"{sel[n]} AS {n}" for n in N.family_names(e, cal))
        kcols = ", ".join(f"k.{c}" for c in ["label_day", *keys])
        return f"SELECT {kcols}, {cols} FROM ({self.counts(e, win)}) k " + " ".join(joins)

    # ---- samples ----------------------------------------------------------
    def pairs(self, sp: str = "spine") -> str:
        return (f"SELECT s.label_day, c.user_id, c.item_id, min(c.item_category) AS item_category "
                f"FROM {sp} s JOIN clean c ON c.day = s.day1 "
                f"GROUP BY s.label_day, c.user_id, c.item_id")

    def labeled(self) -> str:
        bought = (f"SELECT DISTINCT s.label_day, c.user_id, c.item_id FROM spine s "
                  f"JOIN clean c ON c.day = s.label_day AND c.behavior_type = {PURCHASE}")
        return (f"SELECT p.label_day, p.user_id, p.item_id, p.item_category, "
                f"CASE WHEN b.user_id IS NULL THEN 0 ELSE 1 END AS label "
                f"FROM ({self.pairs('spine')}) p LEFT JOIN ({bought}) b "
                f"ON b.label_day = p.label_day AND b.user_id = p.user_id AND b.item_id = p.item_id")

    def grid_lookback(self, k: int) -> str:
        cells = ", ".join(f"count(*) FILTER (WHERE hour = {h} AND behavior_type = {b}) "
                          f"AS {N.lookback_grid_name(k, h, b)}" for h in HOURS for b in BEHAVIORS)
        return (f"SELECT l.label_day, c.user_id, {cells} FROM labels l JOIN clean c "
                f"ON c.day >= l.label_day - {k} AND c.day < l.label_day GROUP BY l.label_day, c.user_id")

    def span(self, e: N.Entity, win: str = "win") -> str:
        keys = ", ".join(e.keys)
        return (f"SELECT label_day, {keys}, CAST(date_diff('day', min(day), max(day)) AS INTEGER) "
                f"AS {N.span_name(e)} FROM {win} GROUP BY label_day, {keys}")

    def lookback_ratios(self, e: N.Entity, win: str = "win") -> str:
        cols = [x for w in N.lookback_labels(self.cal)[:2] for x in self.ratio_exprs(e, w)]
        return f"SELECT label_day, {', '.join(e.keys)}, {', '.join(cols)} FROM ({self.counts(e, win)})"

    def feature_table(self, split: str, opts: FeatureOptions = FeatureOptions()) -> str:
        """training (split='train') or scoring (split='score') table."""
        cal = self.cal
        win = "win" if split == "train" else "swin"
        sample = self.labeled() if split == "train" else self.pairs("sspine")
        fams = [
            ("fu", self.family(N.USER, win), ["user_id"]),
            ("fi", self.family(N.ITEM, win), ["item_id"]),
            ("fc", self.family(N.CATEGORY, win), ["item_category"]),
            ("fuc", self.family(N.USER_CATEGORY, win), ["user_id", "item_category"]),
            ("fui", self.family(N.USER_ITEM, win), ["user_id", "item_id"]),
            ("gu", self.grid(N.USER, win), ["user_id"]),
            ("gui", self.grid(N.USER_ITEM, win), ["user_id", "item_id"]),
            ("guc", self.grid(N.USER_CATEGORY, win), ["user_id", "item_category"]),
            ("ad", self.active_days(win), ["user_id"]),
        ]
        if opts.lookback_ratios:
            fams += [(f"lr{e.prefix}", self.lookback_ratios(e, win), list(e.keys)) for e in (N.USER, N.ITEM, N.CATEGORY)]
        if opts.span_days:
            fams += [(f"sp{e.prefix}", self.span(e, win), list(e.keys)) for e in (N.USER_ITEM, N.USER_CATEGORY)]
        fams += [(f"gl{k}", self.grid_lookback(k), ["user_id"]) for k in opts.grid_lookbacks]
        joins = []
        for alias, sql, keys in fams:
            on = " AND ".join(f"{alias}.{c} = s.{c}" for c in ["label_day", *keys])
            joins.append(f"LEFT JOIN ({sql}) {alias} ON {on}")
        keys = "s.label_day, s.user_id, s.item_id, s.item_category" + (", s.label" if split == "train" else "")
        feats = ", ".join(f"COALESCE({n}, 0) AS {n}" for n in N.feature_names(cal, opts))
        return f"SELECT {keys}, {feats} FROM ({sample}) s " + " ".join(joins)


def _hash(seed: int) -> str:
    return (f"md5(concat_ws('|', '{seed}', CAST(label_day AS VARCHAR), "
            f"CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR)))")


def _sample(rows: str, seed: int, ratio: int, cols: str) -> str:
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (ORDER BY {_hash(seed)}, "
            f"label_day, user_id, item_id) AS rn FROM ({rows}) r WHERE label = 0) "
            f"WHERE rn <= (SELECT {ratio} * count(*) FROM ({rows}) r WHERE label = 1)")


def _metrics() -> str:
    p = "CAST(tp AS DOUBLE) / NULLIF(CAST(n_predicted AS DOUBLE), 0)"
    r = "CAST(tp AS DOUBLE) / NULLIF(CAST(n_actual AS DOUBLE), 0)"
    return (f"{p} AS precision, {r} AS recall, "
            f"(CAST(2 AS DOUBLE) * ({p}) * ({r})) / NULLIF(({p}) + ({r}), 0) AS f1")


def _sources(q, o: Oracle) -> dict[str, str]:
    """What comes back from files: damage by ``event_id`` as in ``fixture.delivered_lines``."""
    kind = f"event_id % {DAMAGE}"
    reason = (f"CASE WHEN {kind} IN (0, 1) THEN 'malformed' WHEN {kind} = 2 OR user_id IS NULL THEN 'no_user' WHEN {kind} = 3 OR item_id IS NULL THEN 'no_item' "
              f"WHEN {kind} = 4 OR behavior_type IS NULL THEN 'bad_behavior' WHEN {kind} IN (5, 6) THEN 'bad_time' END")
    first, last = (_d(x) for x in REG.RELOADED_DAYS)
    behaviors = ", ".join(map(str, REG.PAIR_BEHAVIORS))
    return {
        "log_from_csv": q(f"SELECT user_id, item_id, behavior_type, item_category, time FROM raw WHERE ({reason}) IS NULL"),
        "csv_rejects": q(f"SELECT {reason} AS reason, count(*) AS n_rows FROM raw WHERE ({reason}) IS NOT NULL GROUP BY 1"),
        "items_from_csv": q("SELECT item_id FROM items"),
        "reloaded_clean_log": q(f"SELECT event_id, user_id, item_id, item_category, behavior_type, hour, day FROM clean WHERE day BETWEEN {first} AND {last}"),
        "train_pairs_behaviors": q(f"SELECT label_day, user_id, item_id, min(item_category) AS item_category FROM spine JOIN clean ON day = day1 "
                                   f"WHERE behavior_type IN ({behaviors}) GROUP BY label_day, user_id, item_id"),
        # sketches list their users as long as these are few, so the estimate is the count
        "item_unique_users_approx": q(o.uniq()),
        "incremental_training_set": q(f"SELECT {', '.join([*N.SAMPLE_KEYS, 'label', *REG.DAILY_FEATURES])} FROM ({o.feature_table('train')})"),
    }


def _boosting(train: str, features: list[str], p: BoostParams) -> tuple[list[str], str]:
    """Exact second-order boosting, level by level: (CTEs, every node of the trees).

    Each level sums gradients and hessians (whole numbers of 2^-32) by node,
    feature and value, and takes the best of all thresholds between values."""
    xs = ", ".join(f"{f}::DOUBLE" for f in features)
    names = ", ".join(f"'{f}'" for f in features)
    one = f"{1 << 32}::DOUBLE"
    ctes = [f"m AS MATERIALIZED (SELECT row_number() OVER (ORDER BY label_day, user_id, item_id) AS id, label AS y, [{xs}] AS x FROM ({train}))",
            f"c AS MATERIALIZED (SELECT id, f, x[f + 1] AS v FROM m, range({len(features)}) t(f))",
            "cut AS MATERIALIZED (SELECT f, v, (v + lead(v) OVER (PARTITION BY f ORDER BY v)) / 2 AS t FROM (SELECT DISTINCT f, v FROM c))",
            "r0 AS (SELECT id, 0::DOUBLE AS margin FROM m)"]
    nodes = []
    for r in range(p.rounds):
        ctes.append(f"""s{r} AS MATERIALIZED (SELECT id, round_even((p - y) * {one}, 0)::BIGINT AS g, round_even(p * (1 - p) * {one}, 0)::BIGINT AS h
            FROM (SELECT id, y, 1 / (1 + exp(-margin)) AS p FROM m JOIN r{r} USING (id)))""")
        ctes.append(f"n{r}_0 AS (SELECT id, 0 AS node FROM m)")
        for lv in range(p.depth):
            ctes.append(f"""u{r}_{lv} AS (SELECT node, f, v, sum(g) OVER (PARTITION BY node, f ORDER BY v) / {one} AS gl, sum(h) OVER (PARTITION BY node, f ORDER BY v) / {one} AS hl,
                sum(g) OVER (PARTITION BY node, f) / {one} AS g, sum(h) OVER (PARTITION BY node, f) / {one} AS h
                FROM (SELECT node, f, v, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h FROM n{r}_{lv} JOIN c USING (id) JOIN s{r} USING (id)
                      WHERE node >= {(1 << lv) - 1} GROUP BY node, f, v))""")
            ctes.append(f"""b{r}_{lv} AS MATERIALIZED (SELECT * FROM (
                SELECT node, f, t, gain, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, t) AS place
                FROM (SELECT node, f, t, gl * gl / (hl + {p.l2}::DOUBLE) + (g - gl) * (g - gl) / (h - hl + {p.l2}::DOUBLE) - g * g / (h + {p.l2}::DOUBLE) AS gain
                      FROM u{r}_{lv} JOIN cut USING (f, v) WHERE t IS NOT NULL AND hl >= {p.child_weight}::DOUBLE AND h - hl >= {p.child_weight}::DOUBLE)
                WHERE gain > {p.min_gain}::DOUBLE) WHERE place = 1)""")
            ctes.append(f"""n{r}_{lv + 1} AS MATERIALIZED (SELECT n.id, CASE WHEN b.node IS NULL THEN n.node ELSE 2 * n.node + 1 + (x[f + 1] >= t)::INTEGER END AS node
                FROM n{r}_{lv} n JOIN m USING (id) LEFT JOIN b{r}_{lv} b ON b.node = n.node)""")
        splits = " UNION ALL ".join(f"SELECT node, f, t, gain FROM b{r}_{lv}" for lv in range(p.depth))
        reached = " UNION ".join(f"SELECT id, node FROM n{r}_{lv}" for lv in range(p.depth + 1))
        ctes.append(f"""t{r} AS MATERIALIZED (SELECT a.node, f, t, gain, a.g, a.h, CASE WHEN b.node IS NULL THEN -{p.step}::DOUBLE * a.g / (a.h + {p.l2}::DOUBLE) END AS leaf
            FROM (SELECT node, sum(g) / {one} AS g, sum(h) / {one} AS h FROM ({reached}) JOIN s{r} USING (id) GROUP BY node) a LEFT JOIN ({splits}) b ON b.node = a.node)""")
        ctes.append(f"r{r + 1} AS (SELECT id, margin + leaf AS margin FROM r{r} JOIN n{r}_{p.depth} USING (id) JOIN t{r} USING (node))")
        nodes.append(f"SELECT {r} AS tree, node::INTEGER AS node, [{names}][f + 1] AS feature, t AS threshold, gain, g AS gradient, h AS hessian, leaf FROM t{r}")
    return ctes, " UNION ALL ".join(nodes)


def _boosted_scores(scoring: str, rounds: list[str], features: list[str], p: BoostParams) -> tuple[str, list[str]]:
    xs = ", ".join(f"{f}::DOUBLE" for f in features)
    ctes = rounds + [f"p0 AS MATERIALIZED (SELECT user_id, item_id, 0::DOUBLE AS margin, [{xs}] AS x FROM ({scoring}))"]
    for r in range(p.rounds):
        at = f"(SELECT *, 0 AS node FROM p{r})"
        for _ in range(p.depth):
            at = f"(SELECT a.* EXCLUDE (node), CASE WHEN t.f IS NULL THEN a.node ELSE 2 * a.node + 1 + (x[f + 1] >= t.t)::INTEGER END AS node FROM {at} a JOIN t{r} t ON t.node = a.node)"
        ctes.append(f"p{r + 1} AS MATERIALIZED (SELECT a.user_id, a.item_id, margin + leaf AS margin, x FROM {at} a JOIN t{r} t ON t.node = a.node)")
    return f"SELECT user_id, item_id, round(1 / (1 + exp(-margin)), 9) AS prob FROM p{p.rounds}", ctes


def build() -> dict[str, str]:
    cal = REG.CAL
    o = Oracle(cal)
    q = o.q
    out: dict[str, str] = {}
    nb = f"NOT IN ({o.blist})"

    # cleaning
    out["clean_log"] = q("SELECT * FROM clean")
    out["split_time"] = q("SELECT event_id, time, split_part(time, ' ', 1) AS days, "
                          "split_part(time, ' ', 2) AS hours FROM raw")
    out["parse_day"] = q("SELECT event_id, CAST(split_part(time, ' ', 1) AS DATE) AS day, "
                         "CAST(split_part(time, ' ', 2) AS INTEGER) AS hour FROM raw")
    out["drop_blackout_days"] = q("SELECT event_id, day FROM (SELECT event_id, "
                                  "CAST(split_part(time, ' ', 1) AS DATE) AS day FROM raw) "
                                  f"WHERE day {nb}")
    out["semi_item_subset"] = q("SELECT event_id, user_id, item_id, behavior_type FROM raw "
                                "WHERE item_id IN (SELECT item_id FROM items)")
    out["purchases"] = q(f"SELECT event_id, user_id, item_id, day, hour FROM clean "
                         f"WHERE behavior_type = {PURCHASE}")

    out["semi_item_subset_filtered"] = out["semi_item_subset"]

    # calendar
    cnt_days = ", ".join(f"count(DISTINCT c.day) FILTER (WHERE c.day >= s.lb_{n}_start) AS n_days_{n}"
                         for n in N.lookback_labels(cal))
    lbs = ", ".join(f"s.lb_{n}_start" for n in N.lookback_labels(cal))
    out["label_spine"] = q(
        f"SELECT s.label_day, count(c.day) FILTER (WHERE c.day = s.label_day - 1) AS n_pair_rows, "
        f"count(c.day) FILTER (WHERE c.day = s.label_day AND c.behavior_type = {PURCHASE}) "
        f"AS n_purchase_rows FROM labels s "
        f"LEFT JOIN clean c ON c.day IN (s.label_day - 1, s.label_day) GROUP BY s.label_day")
    out["window_bounds"] = q(
        "SELECT s.label_day, s.win_start, s.win_end, count(c.day) AS n_window_rows, "
        "count(DISTINCT c.day) AS n_window_days FROM spine s "
        "LEFT JOIN clean c ON c.day BETWEEN s.win_start AND s.win_end "
        "GROUP BY s.label_day, s.win_start, s.win_end")
    out["lookback_bounds"] = q(
        f"SELECT s.label_day, s.shift, {lbs}, {cnt_days} FROM spine s "
        f"LEFT JOIN clean c ON c.day BETWEEN s.win_start AND s.win_end "
        f"GROUP BY s.label_day, s.shift, {lbs}")
    out["score_bounds"] = q(
        f"SELECT s.label_day, s.win_start, s.win_end, s.day1, s.shift, {lbs}, "
        f"count(c.day) AS n_window_rows, count(DISTINCT c.day) AS n_window_days, "
        f"count(c.day) FILTER (WHERE c.day = s.day1) AS n_1d_rows, {cnt_days} FROM sspine s "
        f"LEFT JOIN clean c ON c.day BETWEEN s.win_start AND s.win_end "
        f"GROUP BY s.label_day, s.win_start, s.win_end, s.day1, s.shift, {lbs}")
    out["day_slice"] = q("SELECT s.label_day, c.event_id FROM spine s JOIN clean c ON c.day = s.day1")
    both = ("(SELECT 'train' AS split, * FROM win UNION ALL "
            "SELECT 'score' AS split, * FROM swin)")
    out["window_slice"] = q(f"SELECT split, label_day, event_id, day FROM {both}")
    lk = " UNION ALL ".join(
        f"SELECT split, label_day, event_id, {k} AS lookback_days FROM {both} WHERE day >= lb_{n}_start"
        for k, n in zip(cal.lookbacks, N.lookback_labels(cal)))
    out["lookback_slice"] = q(lk)
    out["snapshot_fanout"] = q(f"SELECT split, label_day, count(*) AS n_window_rows, "
                               f"count(*) FILTER (WHERE day = day1) AS n_1d_rows FROM {both} "
                               f"GROUP BY split, label_day")

    # samples
    out["train_pairs"] = q(o.pairs("spine"))
    out["score_pairs"] = q(o.pairs("sspine"))
    out["train_labels"] = q(o.labeled())
    out["label_day_summary"] = q(f"SELECT label_day, count(*) AS n_pairs, "
                                 f"count(*) FILTER (WHERE label = 1) AS n_positive "
                                 f"FROM ({o.labeled()}) GROUP BY label_day")
    out["class_split"] = q(f"SELECT label, count(*) AS n_rows FROM ({o.labeled()}) GROUP BY label")

    # counts
    for key, e in [("user_counts", N.USER), ("item_counts", N.ITEM),
                   ("category_counts", N.CATEGORY), ("user_item_counts", N.USER_ITEM),
                   ("user_category_counts", N.USER_CATEGORY)]:
        out[key] = q(o.counts(e))
        out[f"{e.name}_counts_cumulative"] = out[key]

    def per_entity(exprs_of) -> str:
        parts = []
        for e in (N.USER, N.ITEM, N.CATEGORY):
            cols = []
            for ex in exprs_of(e):
                expr, name = ex.rsplit(" AS ", 1)
                cols.append(f"{expr} AS {name[len(e.prefix) + 1:]}")
            parts.append(f"SELECT label_day, '{e.name}' AS entity, {e.keys[0]} AS entity_id, "
                         f"{', '.join(cols)} FROM ({o.counts(e)})")
        return q(" UNION ALL ".join(parts))

    out["daily_average"] = per_entity(o.avg_exprs)
    out["action_purchase_ratio"] = per_entity(o.ratio_exprs)
    lbl = N.lookback_labels(cal)[:2]
    out["action_purchase_ratio_lookback"] = per_entity(
        lambda e: [x for w in lbl for x in o.ratio_exprs(e, w)])

    # distinct counts, hours, grids, spans
    out["item_unique_users"] = q(o.uniq())
    out["user_active_days"] = q(o.active_days())
    out["user_hour_span"] = q(o.hour_bounds(N.USER))
    out["user_item_hour_bounds"] = q(o.hour_bounds(N.USER_ITEM))
    out["user_category_hour_bounds"] = q(o.hour_bounds(N.USER_CATEGORY))
    out["user_item_max_behavior"] = q(o.max_behavior(N.USER_ITEM))
    out["user_category_max_behavior"] = q(o.max_behavior(N.USER_CATEGORY))
    out["user_hour_grid"] = q(o.grid(N.USER))
    out["user_item_hour_cells"] = q(f"SELECT label_day, user_id, item_id, CAST(4 * hour + behavior_type - 1 AS INTEGER) AS cell, count(*) AS n "
                                    f"FROM win WHERE day = day1 AND hour IS NOT NULL GROUP BY label_day, user_id, item_id, cell")
    out["user_item_hour_grid"] = q(o.grid(N.USER_ITEM))
    out["user_category_hour_grid"] = q(o.grid(N.USER_CATEGORY))
    cells = ", ".join(f"count(*) FILTER (WHERE hour = {h} AND behavior_type = {b}) "
                      f"AS {N.grid_name(N.USER, h, b)}" for h in HOURS for b in BEHAVIORS)
    out["user_hour_grid_lookback"] = q(
        f"SELECT l.label_day, c.user_id, k.lookback_days, {cells} FROM labels l "
        f"CROSS JOIN (VALUES (2), (5)) k(lookback_days) "
        f"JOIN clean c ON c.day >= l.label_day - k.lookback_days AND c.day < l.label_day "
        f"GROUP BY l.label_day, c.user_id, k.lookback_days")
    for key, e in [("user_item_span_days", N.USER_ITEM), ("user_category_span_days", N.USER_CATEGORY)]:
        out[key] = q(o.span(e))

    # families and tables
    for key, e in [("user_features", N.USER), ("item_features", N.ITEM),
                   ("category_features", N.CATEGORY), ("user_item_features", N.USER_ITEM),
                   ("user_category_features", N.USER_CATEGORY)]:
        out[key] = q(o.family(e))
    out["training_set"] = q(o.feature_table("train"))
    out["training_set_all_options"] = q(o.feature_table("train", FeatureOptions.all()))
    out["scoring_set"] = q(o.feature_table("score"))

    # sampling
    lab_cols = "label_day, user_id, item_id, item_category, label"
    out["negative_sample"] = q(_sample(o.labeled(), REG.SEED, REG.NEG_RATIO, lab_cols))
    ts_cols = "* EXCLUDE (rn)"
    ts = o.feature_table("train")
    out["balanced_training_set"] = q(
        f"SELECT * FROM ({ts}) WHERE label = 1 UNION ALL "
        f"{_sample(ts, REG.SEED, REG.NEG_RATIO, ts_cols)}")

    # ranking on the fixed test score, evaluation calendar
    e_o = Oracle(REG.EVAL_CAL)
    truth_day = REG.EVAL_CAL.score_day + dt.timedelta(days=1)
    scored = ("SELECT user_id, item_id, CAST(8 * ui_cnt_w_4 + 4 * ui_cnt_w_3 + 2 * ui_cnt_w_2 "
              f"+ ui_cnt_w_1 + uc_cnt_w_4 AS DOUBLE) AS prob FROM ({e_o.feature_table('score')})")
    ectes = [f"scored AS ({scored})",
             f"truth AS (SELECT DISTINCT user_id, item_id FROM clean WHERE day = {_d(truth_day)} "
             f"AND behavior_type = {PURCHASE})"]
    for key, k in [("topk_recommendations", REG.TOP_K), ("topk_recommendations_short", REG.SHORT_TOP_K)]:
        out[key] = e_o.q(
            f"SELECT user_id, item_id FROM scored ORDER BY prob DESC, user_id, item_id LIMIT {k}", ectes)
    out["gbt_scores"] = q(f"SELECT user_id, item_id, TRUE AS is_probability FROM ({o.pairs('sspine')})")
    out |= _sources(q, o)
    balanced = f"SELECT * FROM ({ts}) WHERE label = 1 UNION ALL {_sample(ts, REG.SEED, REG.NEG_RATIO, ts_cols)}"
    rounds, trees = _boosting(balanced, N.feature_names(cal), REG.QUERY_BOOST)
    out["boosted_trees"] = q(trees, rounds)
    out["boosted_scores"] = q(*_boosted_scores(o.feature_table("score"), rounds, N.feature_names(cal), REG.QUERY_BOOST))
    out["offline_eval"] = e_o.q(
        "SELECT tp, n_predicted, n_actual, " + _metrics() + " FROM ("
        "SELECT count(*) FILTER (WHERE t.user_id IS NOT NULL) AS tp, count(*) AS n_predicted, "
        "(SELECT count(*) FROM truth) AS n_actual "
        "FROM (SELECT DISTINCT user_id, item_id FROM scored) p "
        "LEFT JOIN truth t ON t.user_id = p.user_id AND t.item_id = p.item_id)", ectes)
    cuts = ", ".join(f"({c})" for c in REG.CUTOFFS)
    out["cutoff_sweep"] = e_o.q(
        "SELECT cutoff, tp, n_predicted, n_actual, " + _metrics() + " FROM ("
        "SELECT c.cutoff, count(*) FILTER (WHERE t.user_id IS NOT NULL) AS tp, "
        "count(*) AS n_predicted, (SELECT count(*) FROM truth) AS n_actual "
        "FROM (SELECT user_id, item_id, row_number() OVER (ORDER BY prob DESC, user_id, item_id) "
        "AS rnk FROM scored) r "
        f"JOIN (VALUES {cuts}) c(cutoff) ON r.rnk <= c.cutoff "
        "LEFT JOIN truth t ON t.user_id = r.user_id AND t.item_id = r.item_id "
        "GROUP BY c.cutoff)", ectes)
    return out
