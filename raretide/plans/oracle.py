"""Independent ANSI-SQL oracles (DuckDB dialect) for the SQL-checkable queries.

Each string starts from the driver tables through the ``entity_features``
CTE (FIXTURES.md section 3) and recomputes the operator with plain SQL:
windows over the whole table, ``quantile_cont``, self-joins.  Column lists
are expanded in Python; the logic is SQL.
"""

from __future__ import annotations

from raretide.spec import FIXTURE, FIXTURE_PRESETS

FEATS = [f"feature_{i}" for i in range(1, 13)]
TE = list(FIXTURE.te_cols)
MODELS = ["m1", "m2", "m3", "m4"]

ENTITY = """entity_features AS (
select o.o_orderkey as id,
  cast(case when o.o_orderpriority in ('1-URGENT','2-HIGH') and o.o_totalprice > 450000
       then case when ((o.o_orderkey * 2654435761 + 7) % 4294967296) // 65536 % 100 >= 25 then 1 else 0 end
       else case when ((o.o_orderkey * 2654435761 + 7) % 4294967296) // 65536 % 100 < 1 then 1 else 0 end end as int) as target,
  o.o_totalprice as feature_1,
  c.c_acctbal as feature_2,
  cast(l.n_items as double) as feature_3,
  l.sum_qty as feature_4,
  l.max_price as feature_5,
  l.min_disc as feature_6,
  l.any_ret as feature_7,
  l.any_open as feature_8,
  cast(case when o.o_orderstatus = 'F' then 1 when o.o_orderstatus = 'O' then 0 end as double) as feature_9,
  cast(case when c.c_mktsegment = 'BUILDING' then 1 else 0 end as double) as feature_10,
  cast(extract(month from o.o_orderdate) as double) as feature_11,
  cast(substr(o.o_orderpriority, 1, 1) as double) as feature_12
from orders o
left join customer c on o.o_custkey = c.c_custkey
left join (
  select l_orderkey, count(*) as n_items, sum(l_quantity) as sum_qty, max(l_extendedprice) as max_price,
    min(l_discount) + cast(0 as double) as min_disc,
    cast(max(case when l_returnflag = 'R' then 1 else 0 end) as double) as any_ret,
    cast(max(case when l_linestatus = 'O' then 1 else 0 end) as double) as any_open
  from lineitem group by l_orderkey) l on o.o_orderkey = l.l_orderkey
)"""

BASE = f"""{ENTITY},
train AS (SELECT * FROM entity_features WHERE id % 5 <> 0),
test AS (SELECT * EXCLUDE (target) FROM entity_features WHERE id % 5 = 0),
folds AS (
  SELECT *, CAST((row_number() OVER (PARTITION BY target ORDER BY (id * 2654435761 + 42) % 4294967296, id) - 1) % 5 AS INTEGER) AS fold
  FROM train),
oofw AS (SELECT id, fold, target, feature_1 / 500000.0 AS m1, feature_12 / 5.0 AS m2,
                coalesce(feature_4, 0.0) / 500.0 AS m3, coalesce(feature_6, 0.0) * 10.0 AS m4 FROM folds),
testw AS (SELECT id, feature_1 / 500000.0 AS m1, feature_12 / 5.0 AS m2,
                 coalesce(feature_4, 0.0) / 500.0 AS m3, coalesce(feature_6, 0.0) * 10.0 AS m4 FROM test),
oof AS ({' UNION ALL '.join(f"SELECT id, fold, target, '{m}' AS model, {m} AS score FROM oofw" for m in MODELS)}),
tst AS ({' UNION ALL '.join(f"SELECT id, '{m}' AS model, {m} AS score FROM testw" for m in MODELS)})"""


def r6(expr: str) -> str:
    """6-decimal rounding; magnitudes of 1e9 and above are kept as they are."""
    x = f"({expr})"
    return (f"(CASE WHEN abs({x}) >= 1e9 THEN {x} WHEN {x} < 0 THEN ceil({x} * 1000000.0 - 0.5) / 1000000.0 "
            f"ELSE floor({x} * 1000000.0 + 0.5) / 1000000.0 END + 0.0)")


def with_base(body: str, extra: str = "") -> str:
    return f"WITH {BASE}{(',' + extra) if extra else ''}\n{body}"


def ap_cte(name: str, src: str, keys: list[str], score: str = "score", label: str = "target") -> str:
    k = ", ".join(keys)
    part = f"PARTITION BY {k}" if keys else ""
    gb = f"GROUP BY {k}" if keys else ""
    return f"""{name}_sc AS (SELECT {k + ',' if keys else ''} {score} AS s, sum({label}) AS pos, count(*) AS n FROM {src} GROUP BY {k + ',' if keys else ''} {score}),
{name}_run AS (SELECT *, sum(pos) OVER ({part} ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cpos,
                        sum(n) OVER ({part} ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn,
                        sum(pos) OVER ({part}) AS tpos FROM {name}_sc),
{name} AS (SELECT {k + ',' if keys else ''} sum(pos * (cpos / cn)) / max(tpos) AS ap FROM {name}_run {gb})"""


def auc_cte(name: str, src: str, keys: list[str], score: str = "score", label: str = "target") -> str:
    k = ", ".join(keys)
    part = f"PARTITION BY {k}" if keys else ""
    gb = f"GROUP BY {k}" if keys else ""
    return f"""{name}_sc AS (SELECT {k + ',' if keys else ''} {score} AS s, sum({label}) AS pos, count(*) - sum({label}) AS neg FROM {src} GROUP BY {k + ',' if keys else ''} {score}),
{name}_run AS (SELECT *, sum(neg) OVER ({part} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS below,
                        sum(pos) OVER ({part}) AS tpos, sum(neg) OVER ({part}) AS tneg FROM {name}_sc),
{name} AS (SELECT {k + ',' if keys else ''} sum(pos * (below + neg / 2.0)) / (max(tpos) * max(tneg)) AS auc FROM {name}_run {gb})"""


# ---------------------------------------------------------------- row-feature SQL
def _sum(terms: list[str]) -> str:
    return "(" + " + ".join(terms) + ")"


def sql_cnt(cols):
    return _sum([f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols])


def sql_nan(cols):
    return _sum([f"CAST({c} IS NULL AS INTEGER)" for c in cols])


def sql_rowsum(cols):
    return _sum([f"coalesce({c}, 0.0)" for c in cols])


def sql_central(cols, mean, p):
    return _sum([f"coalesce(power({c} - {mean}, {p}), 0.0)" if p != 2 else f"coalesce(({c} - {mean}) * ({c} - {mean}), 0.0)"
                 for c in cols])


def _central_exact(cols, mean, p):
    out = []
    for c in cols:
        d = f"({c} - {mean})"
        if p == 2:
            t = f"({d} * {d})"
        elif p == 3:
            t = f"(({d} * {d}) * {d})"
        else:
            t = f"(({d} * {d}) * ({d} * {d}))"
        out.append(f"coalesce({t}, 0.0)")
    return _sum(out)


def fp0(x):
    return f"(CASE WHEN abs({x}) < 1e-14 THEN 0.0 ELSE {x} END)"


def row_feature_sql(cols: list[str]) -> dict[str, str]:
    """Expressions over a subquery that exposes ``__n`` and ``__mean``."""
    n, mean = "__n", "__mean"
    nd = f"CAST({n} AS DOUBLE)"
    m2 = _central_exact(cols, mean, 2)
    m3 = _central_exact(cols, mean, 3)
    m4 = _central_exact(cols, mean, 4)
    skew = (f"(CASE WHEN {n} < 3 THEN NULL WHEN {fp0(m2)} = 0 THEN 0.0 ELSE "
            f"({nd} * sqrt({nd} - 1) / ({nd} - 2)) * ({fp0(m3)} / power({fp0(m2)}, 1.5)) END)")
    num = fp0(f"({nd} * ({nd} + 1) * ({nd} - 1) * {m4})")
    den = fp0(f"(({nd} - 2) * ({nd} - 3) * {m2} * {m2})")
    kurt = (f"(CASE WHEN {n} < 4 THEN NULL WHEN {den} = 0 THEN 0.0 ELSE "
            f"{num} / {den} - 3 * ({nd} - 1) * ({nd} - 1) / (({nd} - 2) * ({nd} - 3)) END)")
    arr = "[" + ", ".join(cols) + "]"
    return {
        "fe_nan_count": f"CAST({sql_nan(cols)} AS DOUBLE)",
        "fe_zero_count": f"CAST({_sum([f'CAST(coalesce({c}, 0.0) = 0 AS INTEGER)' for c in cols])} AS DOUBLE)",
        "fe_row_sum": sql_rowsum(cols),
        "fe_row_mean": mean,
        "fe_row_std": f"(CASE WHEN {n} >= 2 THEN sqrt({m2} / ({n} - 1)) END)",
        "fe_row_max": f"greatest({', '.join(cols)})",
        "fe_row_min": f"least({', '.join(cols)})",
        "fe_row_median": f"list_median(list_filter({arr}, lambda x: x IS NOT NULL))",
        "fe_row_skew": skew,
        "fe_row_kurt": kurt,
    }


def _num(c):
    return c.split("_", 1)[1]


def _auto_sum() -> str:
    """Sum of the columns that the ``bin_auto`` CTE found binary."""
    return _sum([f"CASE WHEN list_contains((SELECT cols FROM bin_auto), '{c}') THEN coalesce({c}, 0.0) ELSE 0.0 END" for c in FEATS])


BIN_AUTO = "bin_auto AS (SELECT list(\"column\") AS cols FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", coalesce(bool_and(coalesce({c} IN (0, 1), true)), true) AS b FROM train" for c in FEATS) + ") WHERE b)"


def engineered_sql(spec=FIXTURE, cols=FEATS) -> dict[str, str]:
    """Every engineered column of a fixture spec as SQL over ``train`` + ``__n``/``__mean``."""
    out: dict[str, str] = {}
    for c in spec.miss_cols:
        out[f"{c}_miss"] = f"CAST({c} IS NULL AS INTEGER)"
    stats = row_feature_sql(cols)
    if spec.version < 2:
        stats["fe_zero_count"] = f"CAST({_sum([f'CAST(coalesce({c} = 0, false) AS INTEGER)' for c in cols])} AS DOUBLE)"
    for name, wanted in (("fe_row_median", spec.row_median), ("fe_row_skew", spec.row_skew), ("fe_row_kurt", spec.row_kurt)):
        if not wanted:
            del stats[name]
    out.update(stats)
    b = list(spec.binary_cols)
    if spec.auto_binary:
        out["fe_binary_sum"] = _auto_sum()
    elif b:
        out["fe_binary_sum"] = sql_rowsum(b)
        if spec.binary_mean:
            out["fe_binary_mean"] = f"({sql_rowsum(b)} / {float(len(b))})"
    if spec.pairwise:
        for i, c1 in enumerate(b[:8]):
            for c2 in b[i + 1:9]:
                out[f"fe_{c1}_{c2}"] = f"CAST(coalesce({c1}, 0.0) * coalesce({c2}, 0.0) AS INTEGER)"
    for a, d, safe in spec.ratios:
        na, nd = (f"coalesce({a}, 0.0)", f"coalesce({d}, 0.0)") if safe else (a, d)
        out[f"fe_ratio_{_num(a)}_{_num(d)}"] = f"(CASE WHEN {nd} + 1 = 0 THEN NULL ELSE {na} / ({nd} + 1) END)"
    for a, d in spec.products:
        out[f"fe_{_num(a)}_x_{_num(d)}"] = f"({a} * {d})"
    for a in spec.squares:
        out[f"fe_{_num(a)}_sq"] = f"({a} * {a})"
    for a, safe in spec.logs:
        x = f"coalesce({a}, 0.0)" if safe else a
        # greatest() skips nulls: a null stays null unless it counts as 0
        out[f"fe_{_num(a)}_log"] = f"ln(1 + greatest({x}, 0.0))" if safe else f"(CASE WHEN {a} IS NOT NULL THEN ln(1 + greatest({a}, 0.0)) END)"
    if spec.dominant:
        d = spec.dominant
        dz = f"coalesce({d}, 0.0)"
        for c, safe in spec.dominant_with:
            out[f"fe_{_num(d)}_x_{_num(c)}"] = f"({dz} * {('coalesce(' + c + ', 0.0)') if safe else c})"
        dv = f"coalesce({spec.dominant_div}, 0.0)"
        out[f"fe_{_num(d)}_div_{_num(spec.dominant_div)}"] = f"(CASE WHEN {dv} + 1 = 0 THEN NULL ELSE {dz} / ({dv} + 1) END)"
        out[f"fe_{_num(d)}_sq"] = f"({dz} * {dz})"
    if spec.miss_pattern_sum and spec.miss_cols:
        out["fe_miss_pattern_sum"] = f"CAST({sql_nan(list(spec.miss_cols))} AS DOUBLE)"
    return out


ENG_SRC = (f"(SELECT *, {sql_cnt(FEATS)} AS __n, "
           f"CASE WHEN {sql_cnt(FEATS)} > 0 THEN {sql_rowsum(FEATS)} / {sql_cnt(FEATS)} END AS __mean FROM train)")

INT_COLS = {"feature_3_miss", "feature_4_miss", "feature_5_miss", "feature_6_miss", "feature_7_miss",
            "feature_8_miss", "feature_9_miss"}


def eng_select(names: list[str]) -> str:
    ex = engineered_sql()
    parts = []
    for nm in names:
        e = ex[nm]
        parts.append(f"{e} AS {nm}" if (nm in INT_COLS or nm.startswith("fe_feature_")) else f"{r6(e)} AS {nm}")
    return with_base(f"SELECT id, {', '.join(parts)} FROM {ENG_SRC} t")


def _eng_all(spec=FIXTURE) -> str:
    ex = engineered_sql(spec)
    base = ["target"] + FEATS
    parts = [f"{c}" if c == "target" else f"{r6(c)} AS {c}" for c in base]
    for nm, e in ex.items():
        parts.append(f"{e} AS {nm}" if (nm in INT_COLS or nm.startswith("fe_feature_")) else f"{r6(e)} AS {nm}")
    return with_base(f"SELECT id, {', '.join(parts)} FROM {ENG_SRC} t", BIN_AUTO if spec.auto_binary else "")


# ---------------------------------------------------------------- target encoding
def _te_long(src: str, cols: list[str], extra: str = "") -> str:
    return " UNION ALL ".join(f"SELECT id, {extra}'{c}' AS col, {c} AS x FROM {src}" for c in cols)


TE_CTE = f"""
both_long AS ({_te_long('(SELECT id, ' + ', '.join(TE) + ' FROM train UNION ALL SELECT id, ' + ', '.join(TE) + ' FROM test)', TE)}),
qs AS (SELECT col, quantile_cont(x, [{', '.join(str(i / 20) for i in range(21))}]) AS q FROM both_long WHERE x IS NOT NULL GROUP BY col),
uq AS (SELECT col, list_sort(list_distinct(q)) AS u FROM qs),
inner_e AS (SELECT col, CASE WHEN len(u) < 2 THEN NULL ELSE u[2:len(u) - 1] END AS e FROM uq),
gm AS (SELECT avg(target) AS g FROM train),
tr_long AS ({_te_long('folds', TE, 'fold, target, ')}),
tr_bins AS (SELECT t.id, t.fold, t.target, t.col, t.x,
              CASE WHEN t.x IS NULL OR i.e IS NULL THEN NULL ELSE len(list_filter(i.e, lambda v: v < t.x)) END AS bin
            FROM tr_long t JOIN inner_e i USING (col)),
te_long AS ({_te_long('test', TE)}),
te_bins AS (SELECT t.id, t.col, CASE WHEN t.x IS NULL OR i.e IS NULL THEN NULL ELSE len(list_filter(i.e, lambda v: v < t.x)) END AS bin
            FROM te_long t JOIN inner_e i USING (col)),
fstat AS (SELECT col, fold, bin, count(*) AS n_fold, sum(target) AS s_fold FROM tr_bins WHERE bin IS NOT NULL GROUP BY col, fold, bin),
bstat AS (SELECT col, bin, sum(n_fold) AS n_all, sum(s_fold) AS s_all FROM fstat GROUP BY col, bin),
ostat AS (SELECT f.col, f.fold, f.bin, b.n_all - f.n_fold AS n_other, b.s_all - f.s_fold AS s_other,
                 (b.s_all - f.s_fold + 30 * (SELECT g FROM gm)) / (b.n_all - f.n_fold + 30) AS enc
          FROM fstat f JOIN bstat b USING (col, bin)),
full_enc AS (SELECT col, bin, (s_all + 30 * (SELECT g FROM gm)) / (n_all + 30) AS enc FROM bstat)"""


# ---------------------------------------------------------------- the oracle map
def _blend_grid(models: list[str], steps: int, metric: str) -> str:
    names = [f"w{j + 1}" for j in range(len(models))]
    gens, used = [], "0"
    for j, nm in enumerate(names[:-1]):
        gens.append(f"range(0, {steps} - ({used}) + 1) t{j}({nm})")
        used = f"{used} + {nm}"
    last = f"{steps} - ({used}) AS {names[-1]}"
    grid = f"grid AS (SELECT {', '.join(names[:-1])}, {last} FROM {', '.join(gens)})" if len(gens) == 1 else None
    if grid is None:
        # nested lateral ranges
        frm = gens[0]
        for g in gens[1:]:
            frm += f", LATERAL (SELECT * FROM {g})"
        grid = f"grid AS (SELECT {', '.join(names[:-1])}, {last} FROM {frm})"
    blend = " + ".join(f"CAST({w} AS DOUBLE) * {m}" for w, m in zip(names, models))
    keys = names
    src = f"bl AS (SELECT {', '.join(names)}, target, {blend} AS score FROM oofw, grid)"
    mcte = ap_cte("met", "bl", keys) if metric == "ap" else auc_cte("met", "bl", keys)
    col = "ap" if metric == "ap" else "auc"
    body = (f"SELECT {', '.join(names)}, {r6(col)} AS metric, "
            f"(row_number() OVER (ORDER BY round({col}, 12) DESC, {', '.join(names)}) = 1) AS is_best FROM met")
    return with_base(body, f"{grid},\n{src},\n{mcte}")


def _hull(src: str) -> str:
    """CTEs of the isotonic fit on ``src(x, target)``: from each corner of the lower hull of the cumulative sums to the
    corner of the least slope; ``nx`` has the fitted function's pieces."""
    return (f"pts AS (SELECT x, sum(n) OVER o AS w, sum(s) OVER o AS s FROM (SELECT x, count(*) AS n, sum(target) AS s FROM {src} GROUP BY x) WINDOW o AS (ORDER BY x ROWS UNBOUNDED PRECEDING)),\n"
            "hull AS (SELECT 0::HUGEINT AS w, 0::HUGEINT AS s, NULL::DOUBLE AS a, NULL::DOUBLE AS x, NULL::DOUBLE AS y UNION ALL "
            "SELECT w, s, a, x, y FROM (SELECT p.w, p.s, min(p.x) OVER () AS a, p.x, (p.s - h.s)::DOUBLE / (p.w - h.w) AS y, "
            "row_number() OVER (ORDER BY (p.s - h.s)::DOUBLE / (p.w - h.w), p.w DESC) AS r FROM hull h JOIN pts p ON p.w > h.w) WHERE r = 1),\n"
            "kn AS (SELECT DISTINCT unnest([a, x]) AS x, y FROM hull WHERE x IS NOT NULL),\n"
            "nx AS (SELECT x AS x0, y AS y0, lead(x) OVER (ORDER BY x) AS x1, lead(y) OVER (ORDER BY x) AS y1 FROM kn)")


def _between(x: str) -> str:
    return (f"CASE WHEN n.x0 IS NULL THEN (SELECT arg_min(y, x) FROM kn) WHEN n.x1 IS NULL OR {x} = n.x0 THEN n.y0 "
            f"ELSE n.y0 + ({x} - n.x0) * (n.y1 - n.y0) / (n.x1 - n.x0) END")


_META = "1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2)))"


def _newton() -> str:
    """CTEs of the stacked regression of m1 and m2: Newton steps on the 3 x 3 normal equations, solved by determinants."""
    det = lambda m: (f"({m[0][0]} * ({m[1][1]} * {m[2][2]} - {m[1][2]} * {m[2][1]}) - {m[0][1]} * ({m[1][0]} * {m[2][2]} - {m[1][2]} * {m[2][0]}) "  # noqa: E731
                     f"+ {m[0][2]} * ({m[1][0]} * {m[2][1]} - {m[1][1]} * {m[2][0]}))")
    h = [["h00", "h01", "h02"], ["h01", "h11", "h12"], ["h02", "h12", "h22"]]
    swap = lambda j: [[f"g{i}" if c == j else h[i][c] for c in range(3)] for i in range(3)]
    steps = ", ".join(f"b{j} + {det(swap(j))} / {det(h)} AS b{j}" for j in range(3))
    return ("st AS (SELECT avg(m1) AS a1, stddev_pop(m1) AS s1, avg(m2) AS a2, stddev_pop(m2) AS s2 FROM oofw),\n"
            "zo AS (SELECT id, target, (m1 - a1) / s1 AS x1, (m2 - a2) / s2 AS x2 FROM oofw, st),\n"
            "zt AS (SELECT id, (m1 - a1) / s1 AS x1, (m2 - a2) / s2 AS x2 FROM testw, st),\n"
            "it AS (SELECT 0 AS k, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2 UNION ALL "
            f"SELECT k + 1, {steps} FROM (SELECT k, b0, b1, b2, sum(w) AS h00, sum(w * x1) AS h01, sum(w * x2) AS h02, sum(w * x1 * x1) + 1 AS h11, "
            "sum(w * x1 * x2) AS h12, sum(w * x2 * x2) + 1 AS h22, sum(target - p) AS g0, sum((target - p) * x1) - b1 AS g1, sum((target - p) * x2) - b2 AS g2 "
            "FROM (SELECT *, p * (1 - p) AS w FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM it, zo)) GROUP BY k, b0, b1, b2) WHERE k < 20),\n"
            "lastit AS (SELECT b0, b1, b2 FROM it ORDER BY k DESC LIMIT 1)")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_entities"] = f"WITH {ENTITY} SELECT * FROM entity_features"
    q["profile_target"] = with_base(
        "SELECT count(*) AS n_rows, CAST(14 AS BIGINT) AS n_cols, count(*) FILTER (WHERE target = 1) AS n_pos, "
        "count(*) FILTER (WHERE target = 0) AS n_neg, " + r6("avg(target)") + " AS pos_rate, "
        + r6("CAST(count(*) FILTER (WHERE target = 0) AS DOUBLE) / count(*) FILTER (WHERE target = 1)")
        + " AS scale_pos_weight FROM train")
    miss = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_missing, count(*) AS n FROM train"
        for c in FEATS)
    q["profile_missing"] = with_base(
        f"SELECT \"column\", n_missing, {r6('n_missing * 100.0 / n')} AS pct_missing FROM ({miss}) WHERE n_missing > 0")
    q["binary_columns"] = with_base(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", coalesce(bool_and(coalesce({c} IN (0, 1), true)), true) AS is_binary FROM train"
        for c in FEATS))
    q["smote_preview"] = with_base(
        "SELECT fold_pos, fold_neg, greatest(CAST(floor(fold_neg * 0.1 / (1 - 0.1)) AS BIGINT) - fold_pos, 0) AS synthetic_share, "
        "greatest(CAST(floor(fold_neg * 0.1) AS BIGINT) - fold_pos, 0) AS synthetic_ratio FROM ("
        "SELECT CAST(floor(count(*) FILTER (WHERE target = 1) * (1 - 0.2)) AS BIGINT) AS fold_pos, "
        "CAST(floor(count(*) FILTER (WHERE target = 0) * (1 - 0.2)) AS BIGINT) AS fold_neg FROM train)")
    q["score_summary"] = with_base(
        f"SELECT model, count(*) AS n, {r6('avg(score)')} AS mean, {r6('stddev_pop(score)')} AS std, "
        f"{r6('min(score)')} AS min, {r6('max(score)')} AS max, count(*) FILTER (WHERE score > 0.5) AS n_over_half, "
        f"{r6('quantile_cont(score, 0.99)')} AS p99 FROM tst GROUP BY model")
    q["score_head"] = with_base(f"SELECT id, {r6('m1')} AS target FROM testw ORDER BY id LIMIT 10")
    q["nulls_after_impute"] = with_base(
        f"SELECT count(*) AS n_rows, CAST({len(FEATS)} AS BIGINT) AS n_cols, CAST(0 AS BIGINT) AS n_null, "
        f"CAST(sum({sql_nan(FEATS)}) AS BIGINT) AS n_null_before FROM train")
    q["metric_report"] = with_base(
        f"SELECT model, count(*) AS n_folds, {r6('avg(ap)')} AS mean, {r6('stddev_pop(ap)')} AS std FROM fap GROUP BY model",
        ap_cte("fap", "oof", ["model", "fold"]))

    # row features
    q["feat_missing_flags"] = eng_select([f"{c}_miss" for c in FIXTURE.miss_cols] + ["fe_miss_pattern_sum"])
    q["feat_row_counts"] = with_base(
        f"SELECT id, {r6('CAST(' + sql_nan(FEATS) + ' AS DOUBLE)')} AS fe_nan_count, "
        f"{r6('CAST(' + _sum([f'CAST(coalesce({c}, 0.0) = 0 AS INTEGER)' for c in FEATS]) + ' AS DOUBLE)')} AS fe_zero_count, "
        f"{r6('CAST(' + _sum([f'CAST(coalesce({c} = 0, false) AS INTEGER)' for c in FEATS]) + ' AS DOUBLE)')} AS fe_zero_count_v1 FROM train")
    q["feat_row_stats"] = eng_select(["fe_row_sum", "fe_row_mean", "fe_row_std", "fe_row_max", "fe_row_min"])
    q["feat_row_shape"] = eng_select(["fe_row_median", "fe_row_skew", "fe_row_kurt"])
    bin_auto = "bin_auto AS (SELECT list(\"column\") AS cols FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", coalesce(bool_and(coalesce({c} IN (0, 1), true)), true) AS b FROM train"
        for c in FEATS) + ") WHERE b)"
    auto_sum = _sum([f"CASE WHEN list_contains((SELECT cols FROM bin_auto), '{c}') THEN coalesce({c}, 0.0) ELSE 0.0 END"
                     for c in FEATS])
    b = list(FIXTURE.binary_cols)
    q["feat_binary_agg"] = with_base(
        f"SELECT id, {r6(sql_rowsum(b))} AS fe_binary_sum, {r6(sql_rowsum(b) + ' / ' + str(float(len(b))))} AS fe_binary_mean, "
        f"{r6(auto_sum)} AS fe_binary_sum_auto FROM train", bin_auto)
    q["feat_pairwise"] = eng_select([f"fe_{c1}_{c2}" for i, c1 in enumerate(b[:8]) for c2 in b[i + 1:9]])
    q["feat_ratios"] = eng_select([f"fe_ratio_{_num(a)}_{_num(d)}" for a, d, _ in FIXTURE.ratios])
    q["feat_poly_log"] = eng_select(["fe_4_x_3", "fe_1_sq", "fe_2_log", "fe_5_log"])
    q["feat_interactions"] = eng_select(["fe_12_x_1", "fe_12_x_7", "fe_12_x_8", "fe_12_x_9", "fe_12_div_9", "fe_12_sq"])
    q["engineer_v4"] = _eng_all()

    # target encoding
    q["te_edges"] = with_base(
        f"SELECT col, CAST(i - 1 AS INTEGER) AS q_idx, {r6('q[i]')} AS edge FROM qs, range(1, 22) r(i)", TE_CTE)
    q["te_bins"] = with_base("SELECT id, col, CAST(bin AS INTEGER) AS bin FROM tr_bins WHERE x IS NOT NULL", TE_CTE)
    q["te_fold_stats"] = with_base(
        f"SELECT col, CAST(fold AS INTEGER) AS fold, CAST(bin AS INTEGER) AS bin, CAST(n_other AS BIGINT) AS n_other, "
        f"CAST(s_other AS BIGINT) AS s_other, {r6('enc')} AS enc FROM ostat", TE_CTE)
    q["te_oof"] = with_base(
        f"SELECT t.id, 'te_' || t.col AS col, {r6('coalesce(o.enc, (SELECT g FROM gm))')} AS te FROM tr_bins t "
        "LEFT JOIN ostat o ON t.col = o.col AND t.fold = o.fold AND t.bin = o.bin", TE_CTE)
    q["te_test"] = with_base(
        f"SELECT t.id, 'te_' || t.col AS col, {r6('coalesce(f.enc, (SELECT g FROM gm))')} AS te FROM te_bins t "
        "LEFT JOIN full_enc f ON t.col = f.col AND t.bin = f.bin", TE_CTE)

    # imputation / folds / weights
    q["impute_median"] = with_base(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {r6(f'quantile_cont({c}, 0.5)')} AS median FROM train" for c in FEATS))
    q["standardise_scores"] = with_base(
        f"SELECT t.id, {r6('(t.m1 - s.a1) / s.s1')} AS z_m1, {r6('(t.m2 - s.a2) / s.s2')} AS z_m2 FROM testw t, "
        "(SELECT avg(m1) AS a1, stddev_pop(m1) AS s1, avg(m2) AS a2, stddev_pop(m2) AS s2 FROM oofw) s")
    q["stratified_folds"] = with_base("SELECT id, target, fold FROM folds")
    q["fold_sizes"] = with_base(
        "SELECT f.fold, f.target, f.n_val, a.n_all - f.n_val AS n_train FROM "
        "(SELECT fold, target, count(*) AS n_val FROM folds GROUP BY fold, target) f "
        "JOIN (SELECT target, count(*) AS n_all FROM folds GROUP BY target) a USING (target)")
    q["class_weights"] = with_base(
        f"SELECT id, target, {r6('CASE WHEN target = 1 THEN s.spw ELSE 1.0 END')} AS weight FROM train, "
        "(SELECT CAST(count(*) FILTER (WHERE target = 0) AS DOUBLE) / count(*) FILTER (WHERE target = 1) AS spw FROM train) s")

    # metrics
    q["roc_auc"] = with_base(f"SELECT model, {r6('auc')} AS auc FROM ma", auc_cte("ma", "oof", ["model"]))
    q["average_precision"] = with_base(f"SELECT model, {r6('ap')} AS ap FROM mp", ap_cte("mp", "oof", ["model"]))
    q["metric_by_fold"] = with_base(
        f"SELECT model, fold, {r6('ap')} AS ap, {r6('auc')} AS auc FROM mp JOIN ma USING (model, fold)",
        ap_cte("mp", "oof", ["model", "fold"]) + ",\n" + auc_cte("ma", "oof", ["model", "fold"]))

    # blending
    for n in (3, 4):
        keys = ", ".join(f"w{j + 1}" for j in range(n))
        q[f"blend_search{n}"] = f"SELECT {keys}, metric FROM ({_blend_grid(MODELS[:n], 20, 'ap')}) WHERE is_best"
    q["scan_csv"] = f"WITH {ENTITY} SELECT * FROM entity_features"
    q["blend2_auc"] = _blend_grid(["m1", "m2"], 100, "auc")
    q["blend3_ap"] = _blend_grid(["m1", "m2", "m3"], 20, "ap")
    q["blend4_ap"] = _blend_grid(MODELS, 20, "ap")
    best3 = _blend_grid(["m1", "m2", "m3"], 20, "ap")
    q["blend_apply"] = (best3.replace(
        "\nSELECT w1, w2, w3,", ",\nbest AS (SELECT w1, w2, w3,", 1)
        + ")\nSELECT id, 'oof' AS split, " + r6("(w1 / 20.0) * m1 + (w2 / 20.0) * m2 + (w3 / 20.0) * m3")
        + " AS blend FROM oofw, best WHERE is_best UNION ALL SELECT id, 'test' AS split, "
        + r6("(w1 / 20.0) * m1 + (w2 / 20.0) * m2 + (w3 / 20.0) * m3") + " AS blend FROM testw, best WHERE is_best")

    # ranking
    knots = ("knots AS (SELECT model, score, ((cum - c) + (c + 1) / 2.0) / (tot + 1) AS rnk FROM ("
             "SELECT model, score, c, sum(c) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum, "
             "sum(c) OVER (PARTITION BY model) AS tot FROM (SELECT model, score, count(*) AS c FROM oof GROUP BY model, score)))")
    q["rank_norm_oof"] = with_base(
        f"SELECT o.model, o.id, {r6('k.rnk')} AS rank_norm FROM oof o JOIN knots k USING (model, score)", knots)
    q["rank_norm_ordinal"] = with_base(
        f"SELECT model, id, {r6('CAST(row_number() OVER (PARTITION BY model ORDER BY score, id) AS DOUBLE) / (count(*) OVER (PARTITION BY model) + 1)')} AS rank_norm FROM oof")
    interp = ("lo AS (SELECT t.model, t.id, t.score, max(k.score) AS s0 FROM tst t LEFT JOIN knots k "
              "ON k.model = t.model AND k.score <= t.score GROUP BY t.model, t.id, t.score),"
              "hi AS (SELECT t.model, t.id, t.score, min(k.score) AS s1 FROM tst t LEFT JOIN knots k "
              "ON k.model = t.model AND k.score > t.score GROUP BY t.model, t.id, t.score)")
    val = ("CASE WHEN lo.s0 IS NULL THEN k1.rnk WHEN hi.s1 IS NULL THEN k0.rnk WHEN lo.score = lo.s0 THEN k0.rnk "
           "ELSE k0.rnk + (lo.score - lo.s0) * (k1.rnk - k0.rnk) / (hi.s1 - lo.s0) END")
    q["rank_norm_test"] = with_base(
        f"SELECT lo.model, lo.id, {r6(val)} AS rank_norm FROM lo JOIN hi USING (model, id) "
        "LEFT JOIN knots k0 ON k0.model = lo.model AND k0.score = lo.s0 "
        "LEFT JOIN knots k1 ON k1.model = hi.model AND k1.score = hi.s1", knots + ",\n" + interp)

    # the tail on stand-in scores: ranks keep the order and the ties, so their AP equals the blend's and they are taken
    w3 = "(w1 / 20.0) * m1 + (w2 / 20.0) * m2 + (w3 / 20.0) * m3"
    tail = (best3.replace("\nSELECT w1, w2, w3,", ",\nbest AS (SELECT w1, w2, w3,", 1)
            + f"),\nob AS (SELECT {w3} AS score FROM oofw, best WHERE is_best),"
            + f"\ntb AS (SELECT id, {w3} AS score FROM testw, best WHERE is_best),"
            + "\nkn AS (SELECT score, ((cum - c) + (c + 1) / 2.0) / (tot + 1) AS rnk FROM (SELECT score, c, "
              "sum(c) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum, sum(c) OVER () AS tot FROM "
              "(SELECT score, count(*) AS c FROM ob GROUP BY score))),"
            + "\nnx AS (SELECT score AS s0, rnk AS r0, lead(score) OVER (ORDER BY score) AS s1, lead(rnk) OVER (ORDER BY score) AS r1 FROM kn),"
            + "\nfin AS (SELECT t.id, CASE WHEN n.s0 IS NULL THEN (SELECT arg_min(rnk, score) FROM kn) "
              "WHEN n.s1 IS NULL OR t.score = n.s0 THEN n.r0 ELSE n.r0 + (t.score - n.s0) * (n.r1 - n.r0) / (n.s1 - n.s0) END AS score "
              "FROM tb t ASOF LEFT JOIN nx n ON t.score >= n.s0)")
    q["final_select"] = tail + f"\nSELECT id, {r6('score')} AS score, 'rank_norm' AS method FROM fin"
    q["submission"] = tail + f"\nSELECT id, {r6('score')} AS target FROM fin"

    # pseudo labels
    q["pseudo_select"] = with_base(
        "SELECT id, CAST(m1 > 0.5 AS INTEGER) AS pseudo_label FROM testw WHERE m1 > 0.85 OR m1 < 0.005")
    q["pseudo_gate"] = with_base(
        "SELECT n_high, n_low, n_high + n_low AS n_pseudo, (n_high + n_low) > 500 AS use_pseudo FROM ("
        "SELECT count(*) FILTER (WHERE m1 > 0.85) AS n_high, count(*) FILTER (WHERE m1 < 0.005) AS n_low FROM testw)")

    # the earlier feature sets, and the nulls of the finished matrix
    for v in (1, 2, 3):
        q[f"engineer_v{v}"] = _eng_all(FIXTURE_PRESETS[v])
    ex = engineered_sql()
    nulls = " + ".join(f"CAST(({e}) IS NULL AS INTEGER)" for e in [*FEATS, *ex.values()])
    q["nulls_finished"] = with_base(
        f"SELECT count(*) AS n_rows, CAST({len(FEATS) + len(ex) + len(TE)} AS BIGINT) AS n_cols, CAST(0 AS BIGINT) AS n_null, "
        f"CAST(sum({nulls}) AS BIGINT) AS n_null_before FROM {ENG_SRC} t")
    q["stage_resume"] = (f"WITH {ENTITY}, c AS (SELECT count(*) AS n FROM entity_features)\nSELECT step, step = 3 AS fingerprint_changed, "
                         "step <> 2 AS rebuilt, n AS n_rows FROM c, (SELECT unnest([1, 2, 3])::INTEGER AS step)")

    q["isotonic"] = "WITH RECURSIVE" + with_base(
        f"SELECT t.id, t.m1 AS score, {r6(_between('t.m1'))} AS calibrated FROM testw t ASOF LEFT JOIN nx n ON t.m1 >= n.x0",
        _hull("(SELECT m1 AS x, target FROM oofw)")).removeprefix("WITH")
    meta = r6(_META)
    q["meta_stack"] = "WITH RECURSIVE" + with_base(
        f"SELECT id, 'oof' AS split, {meta} AS meta FROM zo, lastit UNION ALL SELECT id, 'test' AS split, {meta} AS meta FROM zt, lastit",
        _newton()).removeprefix("WITH")

    # the earlier editions' tails on stand-in scores
    def best(models: list[str], steps: int, metric: str) -> str:
        names = ", ".join(f"w{j + 1}" for j in range(len(models)))
        grid = _blend_grid(models, steps, metric).replace(f"\nSELECT {names},", f",\nbest AS (SELECT {names},", 1)
        total = " + ".join(f"(w{j + 1} / {float(steps)}) * {m}" for j, m in enumerate(models))
        return ("WITH RECURSIVE" + grid.removeprefix("WITH") + f"),\nob AS (SELECT id, target, {total} AS score FROM oofw, best WHERE is_best),"
                f"\ntb AS (SELECT id, {total} AS score FROM testw, best WHERE is_best)")

    q["tail_meta"] = (best(["m1", "m2"], 100, "auc") + ",\n" + _newton() + f",\nmo AS (SELECT target, {_META} AS score FROM zo, lastit),\n"
                      + auc_cte("ma1", "mo", []) + ",\n" + auc_cte("ba1", "ob", []) + f",\npick AS (SELECT (SELECT auc FROM ma1) >= (SELECT auc FROM ba1) AS meta)"
                      f"\nSELECT tb.id, CASE WHEN meta THEN {r6(_META)} ELSE {r6('tb.score')} END AS score, CASE WHEN meta THEN 'meta' ELSE 'blend' END AS method "
                      "FROM tb JOIN zt ON tb.id = zt.id, lastit, pick")
    q["tail_isotonic"] = (best(["m1", "m2"], 200, "auc") + ",\n" + _hull("(SELECT score AS x, target FROM ob)")
                          + f"\nSELECT t.id, {r6(_between('t.score'))} AS score, 'isotonic' AS method FROM tb t ASOF LEFT JOIN nx n ON t.score >= n.x0")
    q["tail_ordinal"] = (best(["m1", "m2", "m3"], 20, "ap") + ",\norr AS (SELECT id, target, ob.score AS raw, CAST(row_number() OVER (ORDER BY ob.score, id) AS DOUBLE) / (count(*) OVER () + 1) AS score FROM ob),\n"
                         + ap_cte("oa", "orr", []) + ",\n" + ap_cte("ra", "ob", []) + ",\npick AS (SELECT (SELECT ap FROM oa) >= (SELECT ap FROM ra) AS norm),\n"
                         "kn AS (SELECT raw AS x, min(score) AS f, max(score) AS l FROM orr GROUP BY raw),\n"
                         "nx AS (SELECT x AS x0, l AS l0, lead(x) OVER (ORDER BY x) AS x1, lead(f) OVER (ORDER BY x) AS f1 FROM kn)\n"
                         "SELECT t.id, CASE WHEN norm THEN " + r6("CASE WHEN n.x0 IS NULL THEN (SELECT arg_min(f, x) FROM kn) WHEN n.x1 IS NULL OR t.score = n.x0 THEN n.l0 "
                         "ELSE n.l0 + (t.score - n.x0) * (n.f1 - n.l0) / (n.x1 - n.x0) END") + " ELSE " + r6("t.score")
                         + " END AS score, CASE WHEN norm THEN 'rank_norm' ELSE 'blend' END AS method FROM tb t ASOF LEFT JOIN nx n ON t.score >= n.x0, pick")

    # stumps: the purest weighted split of every training split
    cells = " UNION ALL ".join(f"SELECT fold, target, {i} AS place, {c} AS x FROM folds" for i, c in enumerate(FEATS))
    pur = lambda a, b: f"((spw * {a}) * (spw * {a}) + {b} * {b}) / (spw * {a} + {b})"
    score = "CASE s.place " + " ".join(f"WHEN {i} THEN CASE WHEN t.{c} <= s.x THEN s.l ELSE s.r END" for i, c in enumerate(FEATS)) + " END"
    stump = (f"cells AS ({cells}),\nsp AS (SELECT CAST(count(*) FILTER (WHERE target = 0) AS DOUBLE) / count(*) FILTER (WHERE target = 1) AS spw FROM train),\n"
             "tfs AS (SELECT unnest([0, 1, 2, 3, 4]) AS tf),\n"
             "tot AS (SELECT tf, count(*) FILTER (WHERE target = 1) AS tp, count(*) FILTER (WHERE target = 0) AS tn FROM tfs JOIN folds ON fold <> tf GROUP BY tf),\n"
             "run AS (SELECT tf, place, x, sum(p) OVER o AS lp, sum(n) OVER o AS ln FROM (SELECT tf, place, x, count(*) FILTER (WHERE target = 1) AS p, "
             "count(*) FILTER (WHERE target = 0) AS n FROM tfs JOIN cells ON fold <> tf WHERE x IS NOT NULL GROUP BY tf, place, x) WINDOW o AS (PARTITION BY tf, place ORDER BY x ROWS UNBOUNDED PRECEDING)),\n"
             f"cand AS (SELECT *, tp - lp AS rp, tn - ln AS rn FROM run JOIN tot USING (tf), sp WHERE lp + ln < tp + tn),\n"
             f"best AS (SELECT tf, place, x, spw * lp / (spw * lp + ln) AS l, spw * rp / (spw * rp + rn) AS r FROM (SELECT *, row_number() OVER (PARTITION BY tf ORDER BY {pur('lp', 'ln')} + {pur('rp', 'rn')} DESC, place, x) AS k FROM cand) WHERE k = 1)")
    q["stump_oof"] = with_base(f"SELECT t.id, t.fold, t.target, {r6(score)} AS score FROM folds t JOIN best s ON s.tf = t.fold", stump)
    q["stump_test_mean"] = with_base(f"SELECT id, {r6('avg(score)')} AS score FROM (SELECT t.id, {score} AS score FROM test t, best s) GROUP BY id", stump)

    # nested encoding: everything about outer fold o comes from the other folds (and the test rows' values)
    q["te_nested"] = with_base(
        "SELECT CAST(b.o AS INTEGER) AS outer_fold, b.id, 'te_' || b.col AS col, " + r6(
            "CASE WHEN b.bin IS NULL OR t.n IS NULL THEN g.g WHEN b.fold = b.o THEN (t.s + 30 * g.g) / (t.n + 30) ELSE (t.s - f.s + 30 * g.g) / (t.n - f.n + 30) END")
        + " AS te FROM nb b JOIN ng g USING (o) LEFT JOIN nt t ON b.o = t.o AND b.col = t.col AND b.bin = t.bin "
        "LEFT JOIN nf f ON b.o = f.o AND b.col = f.col AND b.bin = f.bin AND b.fold = f.fold",
        f"os AS (SELECT unnest([0, 1, 2, 3, 4]) AS o),\ntrl AS ({_te_long('folds', TE, 'fold, target, ')}),\ntel AS ({_te_long('test', TE)}),\n"
        "nl AS (SELECT o, col, x FROM os JOIN trl ON fold <> o UNION ALL SELECT o, col, x FROM os, tel),\n"
        f"nq AS (SELECT o, col, quantile_cont(x, [{', '.join(str(i / 20) for i in range(21))}]) AS q FROM nl WHERE x IS NOT NULL GROUP BY o, col),\n"
        "ne AS (SELECT o, col, CASE WHEN len(u) < 2 THEN NULL ELSE u[2:len(u) - 1] END AS e FROM (SELECT o, col, list_sort(list_distinct(q)) AS u FROM nq)),\n"
        "ng AS (SELECT o, avg(target) AS g FROM os JOIN folds ON fold <> o GROUP BY o),\n"
        "nb AS (SELECT e.o, t.id, t.fold, t.target, t.col, CASE WHEN t.x IS NULL OR e.e IS NULL THEN NULL ELSE len(list_filter(e.e, lambda v: v < t.x)) END AS bin FROM trl t JOIN ne e USING (col)),\n"
        "nf AS (SELECT o, col, bin, fold, count(*) AS n, sum(target) AS s FROM nb WHERE bin IS NOT NULL AND fold <> o GROUP BY o, col, bin, fold),\n"
        "nt AS (SELECT o, col, bin, sum(n) AS n, sum(s) AS s FROM nf GROUP BY o, col, bin)")

    # oversampling
    med = ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in FEATS)
    imp = ", ".join(f"coalesce(f.{c}, m.{c}) AS {c}" for c in FEATS)
    d2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATS)
    knn = (f"meds AS (SELECT {med} FROM train),\n"
           f"mino AS (SELECT f.id, f.fold, {imp} FROM folds f, meds m WHERE f.target = 1),\n"
           "tfs AS (SELECT range AS tf FROM range(0, 5)),\n"
           f"pairs AS (SELECT t.tf, a.id, b.id AS nn_id, {d2} AS d2 FROM tfs t JOIN mino a ON a.fold <> t.tf "
           "JOIN mino b ON b.fold <> t.tf AND b.id <> a.id),\n"
           "ranked AS (SELECT *, row_number() OVER (PARTITION BY tf, id ORDER BY d2, nn_id) AS rnk FROM pairs)")
    q["smote_knn"] = with_base(
        f"SELECT CAST(tf AS INTEGER) AS tf, id, CAST(rnk AS INTEGER) AS rank, nn_id, {r6('sqrt(d2)')} AS dist "
        "FROM ranked WHERE rnk <= 5", knn)
    cnt = ("per AS (SELECT fold, count(*) FILTER (WHERE target = 1) AS p, count(*) FILTER (WHERE target = 0) AS n "
           "FROM folds GROUP BY fold),\n"
           "cnt AS (SELECT fold AS tf, (SELECT sum(p) FROM per) - p AS n_pos, (SELECT sum(n) FROM per) - n AS n_neg FROM per)")
    q["smote_check"] = with_base(
        "SELECT CAST(tf AS INTEGER) AS tf, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg, "
        "CAST(greatest(floor(n_neg * 0.1) - n_pos, 0) AS BIGINT) AS n_syn, "
        + r6("(n_pos + greatest(floor(n_neg * 0.1) - n_pos, 0)) / (n_pos + greatest(floor(n_neg * 0.1) - n_pos, 0) + n_neg)")
        + " AS share_after FROM cnt", cnt)
    draw = lambda j: f"('0x' || substr(md5(concat_ws(':', 42, tf, i, {j})), 1, 13))::BIGINT"
    q["smote_draws"] = with_base(
        "SELECT CAST(d.tf AS INTEGER) AS tf, d.i AS syn_id, b.id AS base_id, r.nn_id, " + r6("d.u") + " AS u, "
        + ", ".join(f"{r6(f'b.{c} + d.u * (n.{c} - b.{c})')} AS {c}" for c in FEATS)
        + " FROM d JOIN mem b ON b.tf = d.tf AND b.idx = d.idx JOIN ranked r ON r.tf = d.tf AND r.id = b.id AND r.rnk = d.rnk JOIN mino n ON n.id = r.nn_id",
        knn + ",\n" + cnt + ",\n"
        "mem AS (SELECT t.tf, m.*, row_number() OVER (PARTITION BY t.tf ORDER BY (m.id * 2654435761 + 42) % 4294967296, m.id) - 1 AS idx FROM tfs t JOIN mino m ON m.fold <> t.tf),\n"
        f"d AS (SELECT tf, i, {draw(1)} % n_pos AS idx, {draw(2)} % least(5, n_pos - 1) + 1 AS rnk, {draw(3)}::DOUBLE / 4503599627370496.0 AS u FROM "
        "(SELECT tf, n_pos, unnest(range(0, CAST(greatest(floor(n_neg * 0.1) - n_pos, 0) AS BIGINT))) AS i FROM cnt))")
    return q
