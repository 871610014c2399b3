"""Independent SQL (DuckDB dialect) for every registered query.

The thinning is written in *exploded* form: every middle point is repeated
once per level (a join with a small VALUES list of levels), anchors are
``last_value/first_value ... IGNORE NULLS`` per (series, level), fits are a
GROUP BY per (series, level) and the chosen level a MIN over the levels that
meet the target.  Nothing is shared with the Spark plan but the definitions.
"""

from __future__ import annotations

from ..config import ThinConfig
from ..sources.fixtures import FIXTURE_TIME, PROCESS_COLUMNS
from . import catalog as C

DEC = "DECIMAL(20,6)"
KEYS = ["remark", "st_business_cycle", "step_id"]
INT_COLS = {"channel_id", "sequence_id", "cycle", "step_id", "step_logic_number",
            "pv_data_flag", "pv_work_type", "st_business_cycle"}
DEC_COLS = {"test_time_duration", "sv_ic_range", "sv_iv_range", "pv_voltage", "pv_current",
            "pv_ir", "pv_temperature", "pv_charge_capacity", "pv_discharge_capacity",
            "pv_charge_energy", "pv_discharge_energy"}
TS_COLS = {"timestamp", "created_date_time", "modified_date_time"}


def _present(c: str, alias: str | None = None) -> str:
    """Same plain types as catalog.present()."""
    a = f'"{alias or c}"'
    q = f'"{c}"'
    if c in INT_COLS or c.endswith("_status") or c in ("row_num", "n", "rn"):
        return f"CAST({q} AS BIGINT) AS {a}"
    if c in DEC_COLS:
        return f"CAST({q} AS DOUBLE) AS {a}"
    if c in TS_COLS:
        return f"strftime({q}, '%Y-%m-%d %H:%M:%S') AS {a}"
    return f"{q} AS {a}"


def _d(v: float) -> str:
    return f"CAST('{float(v)!r}' AS DOUBLE)"


METRICS = {"C": "pv_charge_capacity", "E": "pv_charge_energy", "I": "pv_current", "T": "pv_temperature",
           "V": "pv_voltage"}


# ----------------------------------------------------------- fixture views
PROC = f"""
li AS (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey,
         l_linestatus, l_linenumber, l_partkey, l_extendedprice) AS seq
  FROM lineitem),
proc AS (
  SELECT concat_ws('-', CAST(l_suppkey AS VARCHAR), CAST(CAST(l_linestatus = 'F' AS INTEGER) AS VARCHAR),
                   CAST(l_linenumber AS VARCHAR), CAST(seq AS VARCHAR)) AS handle,
    l_returnflag AS site, CAST(l_suppkey AS VARCHAR) AS remark, CAST(l_orderkey AS VARCHAR) AS sfc,
    CAST(l_partkey AS VARCHAR) AS resource_id, CAST(l_linenumber AS INTEGER) AS channel_id,
    CAST(seq AS INTEGER) AS sequence_id, CAST(year(l_shipdate) AS INTEGER) AS cycle,
    CAST(l_linenumber AS INTEGER) AS step_id, l_linestatus AS step_name,
    CAST(l_linenumber AS INTEGER) AS step_logic_number,
    CAST(l_quantity AS {DEC}) AS test_time_duration, l_shipdate AS "timestamp",
    CAST(l_discount AS {DEC}) AS sv_ic_range, CAST(l_tax AS {DEC}) AS sv_iv_range,
    CAST(l_tax AS {DEC}) AS pv_voltage, CAST(l_quantity AS {DEC}) AS pv_current,
    CAST(l_discount AS {DEC}) AS pv_ir, CAST(l_extendedprice / 1000 AS {DEC}) AS pv_temperature,
    CAST(l_discount AS {DEC}) AS pv_charge_capacity, CAST(l_tax AS {DEC}) AS pv_discharge_capacity,
    CAST(CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE l_extendedprice END AS {DEC}) AS pv_charge_energy,
    CAST(l_extendedprice AS {DEC}) AS pv_discharge_energy,
    CASE WHEN l_linenumber = 1 THEN '' ELSE l_returnflag || l_linestatus END AS pv_sub_channel_1,
    CAST(NULL AS VARCHAR) AS pv_sub_channel_2, CAST(NULL AS VARCHAR) AS pv_sub_channel_3,
    CAST(NULL AS VARCHAR) AS pv_sub_channel_4, CAST(NULL AS VARCHAR) AS pv_sub_channel_5,
    CAST(NULL AS VARCHAR) AS pv_sub_channel_6, 0 AS pv_data_flag,
    CAST(l_linenumber % 2 AS INTEGER) AS pv_work_type, 'N' AS tx_is_exceptional,
    CAST(NULL AS VARCHAR) AS tx_alert_current, CAST(NULL AS VARCHAR) AS tx_alert_voltage,
    CAST(NULL AS VARCHAR) AS tx_alert_temperature, CAST(NULL AS VARCHAR) AS tx_alert_capacity,
    CAST(NULL AS VARCHAR) AS tx_alert_duration, CAST(NULL AS VARCHAR) AS tx_alert_category1,
    CAST(NULL AS VARCHAR) AS tx_alert_category2, CAST(NULL AS VARCHAR) AS tx_root_remark,
    CAST(l_linestatus = 'F' AS INTEGER) AS st_business_cycle, l_shipdate AS created_date_time,
    'gen' AS created_user, l_shipdate AS modified_date_time, 'gen' AS modified_user
  FROM li),
fixed AS MATERIALIZED (
  SELECT * REPLACE (
    CASE WHEN pv_charge_capacity <> 0 THEN pv_charge_capacity ELSE pv_discharge_capacity END AS pv_charge_capacity,
    CASE WHEN pv_charge_energy <> 0 THEN pv_charge_energy ELSE pv_discharge_energy END AS pv_charge_energy)
  FROM proc),
arows AS (
  SELECT *, row_number() OVER (PARTITION BY remark, st_business_cycle, step_id
                               ORDER BY sequence_id, handle) AS row_num,
            count(*) OVER (PARTITION BY remark, st_business_cycle, step_id) AS n
  FROM fixed)"""

STATUS = f"""
skeys AS (
  SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS remark,
         CAST(l_linestatus = 'F' AS INTEGER) AS st_business_cycle,
         CAST(l_linenumber AS INTEGER) AS step_id,
         CAST((l_suppkey + l_linenumber) % 4 AS INTEGER) AS s
  FROM lineitem),
status AS (
  SELECT remark, st_business_cycle, step_id,
    CASE s WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 1 END AS c_status,
    CASE s WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 1 END AS e_status,
    CASE s WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 1 END AS i_status,
    CASE s WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 1 END AS t_status,
    CASE s WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 0 END AS v_status,
    TIMESTAMP '{FIXTURE_TIME}' AS modified_date_time, 'gen' AS modified_user
  FROM skeys)"""


# the batch size of the original job, in key order
FIRST = "ORDER BY remark, st_business_cycle, step_id LIMIT 6000"


def _pending(shard: int, limit: str = "") -> str:
    return f"""pend AS (
  SELECT DISTINCT remark, st_business_cycle, step_id FROM status
  WHERE (c_status = 0 OR e_status = 0 OR i_status = 0 OR t_status = 0 OR v_status = 0)
    AND ((step_id % 2) + 2) % 2 = {shard}
  {limit})"""


# --------------------------------------------------------- thinning stages
def _same(a: str, b: str, cols: list[str]) -> str:
    """Equal columns, null equal to null."""
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


def _levels(cfg: ThinConfig) -> str:
    rows = ", ".join(f"({i}, {_d(p)})" for i, p in enumerate(cfg.levels(), 1))
    return f"lv AS (SELECT * FROM (VALUES {rows}) t(lvl, p))"


def thin_ctes(src: str, keys: list[str], order: list[str], cfg: ThinConfig,
              numbered: bool = False) -> str:
    """CTEs over ``src`` (keys, order cols, y DOUBLE, other cols):
    num, reg, mid, sg, rk, lv, ex, an, er, ft, st, fit, ch, kp.
    ``kp`` = kept rows of ``reg`` (all columns) with ``lvl`` = chosen level."""
    k = ", ".join(keys)
    o = ", ".join(order)
    jk = _same("a", "b", keys)
    prev_ok = "mpos > 1" if cfg.leading_anchor == "origin" else "TRUE"
    px = "coalesce(px, 0.0)" if cfg.leading_anchor == "origin" else "px"
    py = "coalesce(py, 0.0)" if cfg.leading_anchor == "origin" else "py"
    num = f"""num AS (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {o}) AS rn,
                     count(*) OVER (PARTITION BY {k}) AS cnt FROM {src})"""
    if numbered:
        num = f"num AS (SELECT *, row_num AS rn, n AS cnt FROM {src})"
    return f"""{num},
reg AS (SELECT *,
  CASE WHEN cnt <= {cfg.threshold} THEN 'pass'
       WHEN cnt - {cfg.pre} - {cfg.post} <= 0 THEN 'all'
       WHEN rn <= {cfg.pre} THEN 'head'
       WHEN rn > cnt - {cfg.post} THEN 'tail' ELSE 'middle' END AS region,
  cnt - {cfg.pre} - {cfg.post} AS n_mid, rn - {cfg.pre} AS mpos FROM num),
mid AS (SELECT {k}, rn, CAST(rn AS DOUBLE) AS x, CAST(y AS DOUBLE) AS yy, n_mid, mpos
        FROM reg WHERE region = 'middle'),
sg AS (SELECT *, CASE WHEN mpos > 1 AND mpos < n_mid THEN
         abs((lead(x) OVER w - lag(x) OVER w) * (yy - lag(yy) OVER w)
             + (lag(yy) OVER w - lead(yy) OVER w) * (x - lag(x) OVER w)) END AS sig
       FROM mid WINDOW w AS (PARTITION BY {k} ORDER BY rn)),
rk AS (SELECT *, CASE WHEN sig IS NOT NULL THEN
         row_number() OVER (PARTITION BY {k} ORDER BY sig DESC NULLS LAST, rn) END AS rnk FROM sg),
{_levels(cfg)},
ex AS (SELECT rk.*, lv.lvl,
         (mpos = 1 OR mpos = n_mid OR rnk <= floor(CAST(n_mid - 2 AS DOUBLE) * lv.p)) AS kept
       FROM rk JOIN lv ON TRUE),
an AS (SELECT *,
  last_value(CASE WHEN kept AND {prev_ok} THEN x END IGNORE NULLS) OVER wp AS px,
  last_value(CASE WHEN kept AND {prev_ok} THEN yy END IGNORE NULLS) OVER wp AS py,
  first_value(CASE WHEN kept THEN x END IGNORE NULLS) OVER wn AS nx,
  first_value(CASE WHEN kept THEN yy END IGNORE NULLS) OVER wn AS ny
  FROM ex WINDOW
    wp AS (PARTITION BY {k}, lvl ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    wn AS (PARTITION BY {k}, lvl ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
er AS (SELECT *, CASE WHEN kept THEN 0.0 ELSE (yhat - yy) * (yhat - yy) END AS e FROM (
  SELECT *, CASE WHEN ny - {py} = 0 OR nx - {px} = 0 THEN ny
            ELSE ((ny - {py}) / (nx - {px})) * x + (ny - ((ny - {py}) / (nx - {px})) * nx) END AS yhat
  FROM an)),
st AS (SELECT {k}, CASE WHEN min(yy) = max(yy) THEN 0.0 ELSE sum((yy - my) * (yy - my)) END AS sst
       FROM (SELECT *, avg(yy) OVER (PARTITION BY {k}) AS my FROM mid) GROUP BY {k}),
fit AS (SELECT a.*, CASE WHEN a.sse = 0 OR b.sst = 0 THEN 1.0 ELSE 1 - sqrt(a.sse / b.sst) END AS fit
        FROM (SELECT {k}, lvl, sum(e) AS sse FROM er GROUP BY {k}, lvl) a JOIN st b ON {jk}),
ch AS (SELECT {k}, min(lvl) AS lvl FROM fit WHERE fit >= {_d(cfg.target)} OR isnan(fit) GROUP BY {k}),
en AS (SELECT {k}, rn, min(lvl) AS entry FROM ex WHERE kept GROUP BY {k}, rn),
kp AS MATERIALIZED (
  SELECT r.*, c.lvl FROM reg r JOIN ch c ON {_same("r", "c", keys)}
  LEFT JOIN en e ON {_same("e", "r", [*keys, "rn"])}
  WHERE r.region IN ('head', 'tail') OR (r.region = 'middle' AND e.entry <= c.lvl)
  UNION ALL SELECT r.*, NULL AS lvl FROM reg r WHERE r.region IN ('pass', 'all'))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


def _b_src(cfg=None) -> str:
    return "bsrc AS (SELECT user_id, ts, event_id, value AS y FROM events)"


def _c_src() -> str:
    return "csrc AS (SELECT event_type, ts, event_id, value AS y FROM events)"


def _a_metric_src(col: str) -> str:
    return f"msrc AS (SELECT remark, st_business_cycle, step_id, sequence_id, handle, CAST({col} AS DOUBLE) AS y FROM fixed)"


def _a_all_src() -> str:
    parts = [f"SELECT remark, st_business_cycle, step_id, sequence_id, handle, '{t}' AS zip_category, "
             f"CAST({c} AS DOUBLE) AS y FROM fixed" for t, c in METRICS.items()]
    return "allsrc AS (" + " UNION ALL ".join(parts) + ")"


B_ORDER = ["ts", "event_id"]
A_ORDER = ["sequence_id", "handle"]
A_KEYS_CAT = KEYS + ["zip_category"]


def _b_level_ctes(cfg: ThinConfig) -> str:
    """Middle points of B at the fixed level: lvx (with anchors, yhat)."""
    return thin_ctes("bsrc", ["user_id"], B_ORDER, cfg) + f""",
lvx AS (SELECT *, CASE WHEN kept THEN yy WHEN ny - {_py(cfg)} = 0 OR nx - {_px(cfg)} = 0 THEN ny
          ELSE ((ny - {_py(cfg)}) / (nx - {_px(cfg)})) * x + (ny - ((ny - {_py(cfg)}) / (nx - {_px(cfg)})) * nx) END AS yhat2
        FROM an WHERE lvl = {C.LEVEL})"""


def _px(cfg):
    return "coalesce(px, 0.0)" if cfg.leading_anchor == "origin" else "px"


def _py(cfg):
    return "coalesce(py, 0.0)" if cfg.leading_anchor == "origin" else "py"


def _cols(cols):
    return ", ".join(_present(c) for c in cols)


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    allc = [c for c in PROCESS_COLUMNS]
    q["scan_process_rows"] = _with(PROC) + f"\nSELECT {_cols(allc + ['row_num'])} FROM arows"
    q["normalize_blank"] = _with(PROC) + """
SELECT handle, nullif(pv_sub_channel_1, '') AS pv_sub_channel_1, nullif(pv_sub_channel_2, '') AS pv_sub_channel_2,
       coalesce(nullif(pv_sub_channel_1, ''), 'null') AS sub_channel_1_text,
       nullif(pv_sub_channel_1, '') IS NULL AS sub_channel_1_missing FROM proc"""
    a = C.CFG_A
    q["config_broadcast"] = _with(PROC) + f"""
SELECT remark, CAST(st_business_cycle AS BIGINT) AS st_business_cycle, CAST(step_id AS BIGINT) AS step_id,
       CAST(count(*) AS BIGINT) AS n, CAST(any_value(r) * 10 AS BIGINT) AS threshold,
       CAST(any_value(r) * 2 AS BIGINT) AS pre, CAST(any_value(r) * 2 AS BIGINT) AS post, any_value(r) / 10 AS target,
       any_value(r) / 50 AS "start", any_value(r) / 50 AS step, count(*) > any_value(r) * 10 AS thinnable
FROM proc, (SELECT CAST(count(*) AS DOUBLE) AS r FROM region) GROUP BY remark, st_business_cycle, step_id"""
    keys_sel = "remark, CAST(st_business_cycle AS BIGINT) AS st_business_cycle, CAST(step_id AS BIGINT) AS step_id"
    q["pending_keys"] = _with(STATUS, _pending(0, FIRST)) + f"\nSELECT {keys_sel} FROM pend"
    q["shard_odd"] = _with(STATUS, _pending(1, FIRST)) + f"\nSELECT {keys_sel} FROM pend"
    q["load_pending_rows"] = _with(PROC, STATUS, _pending(0)) + """
SELECT handle, remark, CAST(st_business_cycle AS BIGINT) AS st_business_cycle, CAST(step_id AS BIGINT) AS step_id,
  CAST(sequence_id AS BIGINT) AS sequence_id,
  CAST(row_number() OVER (PARTITION BY remark, st_business_cycle, step_id ORDER BY sequence_id, handle) AS BIGINT) AS row_num,
  CAST(pv_charge_capacity AS DOUBLE) AS pv_charge_capacity, CAST(pv_charge_energy AS DOUBLE) AS pv_charge_energy
FROM fixed JOIN pend USING (remark, st_business_cycle, step_id)"""
    for name, (x, y) in {"repair_capacity": ("pv_charge_capacity", "pv_discharge_capacity"),
                         "repair_energy": ("pv_charge_energy", "pv_discharge_energy")}.items():
        q[name] = _with(PROC) + f"""
SELECT handle, CAST({x} AS DOUBLE) AS raw, CAST({y} AS DOUBLE) AS fallback,
       CAST(CASE WHEN {x} <> 0 THEN {x} ELSE {y} END AS DOUBLE) AS repaired FROM proc"""
    q["series_key"] = _with(PROC) + """
SELECT handle, concat_ws('#', remark, CAST(st_business_cycle AS VARCHAR), CAST(step_id AS VARCHAR)) AS series_key FROM proc"""
    q["series_size"] = _with(PROC) + f"""
SELECT {keys_sel}, CAST(count(*) AS BIGINT) AS n FROM proc GROUP BY ALL"""
    q["series_size_events"] = "SELECT user_id, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY user_id"
    q["number_rows"] = _with(PROC) + "\nSELECT handle, CAST(row_num AS BIGINT) AS row_num FROM arows"
    q["passthrough_series"] = _with(PROC) + f"""
SELECT handle, CAST(row_num AS BIGINT) AS row_num, CAST(n AS BIGINT) AS n FROM arows WHERE n <= {a.threshold}"""
    q["thinnable_series"] = _with(PROC) + f"""
SELECT handle, CAST(row_num AS BIGINT) AS row_num, CAST(n AS BIGINT) AS n FROM arows WHERE n > {a.threshold}"""
    b = C.CFG_B
    bnum = """bnum AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
                     count(*) OVER (PARTITION BY user_id) AS cnt FROM events)"""
    for name, cond in {"series_head": f"cnt > {b.threshold} AND cnt - {b.pre + b.post} > 0 AND rn <= {b.pre}",
                       "series_tail": f"cnt > {b.threshold} AND cnt - {b.pre + b.post} > 0 AND rn > {b.pre} AND rn > cnt - {b.post}",
                       "series_middle": f"cnt > {b.threshold} AND rn > {b.pre} AND rn <= cnt - {b.post}"}.items():
        mpos = f"CAST(rn - {b.pre} AS BIGINT)" if name == "series_middle" else "CAST(NULL AS BIGINT)"
        q[name] = _with(bnum) + f"""
SELECT user_id, event_id, CAST(rn AS BIGINT) AS row_num, {mpos} AS mpos FROM bnum WHERE {cond}"""
    q["unpivot_metrics"] = _with(PROC) + "\n" + " UNION ALL ".join(
        f"SELECT remark, CAST(st_business_cycle AS BIGINT) AS st_business_cycle, CAST(step_id AS BIGINT) AS step_id, "
        f"CAST(row_num AS BIGINT) AS row_num, '{t}' AS zip_category, CAST({c} AS DOUBLE) AS y FROM arows"
        for t, c in METRICS.items())

    # ---- thinning steps on B (fixed level)
    blv = _with(_b_src(), _b_level_ctes(b))
    q["neighbours"] = blv + """
SELECT user_id, CAST(rn AS BIGINT) AS row_num, x_prev, y_prev, x_next, y_next FROM (
  SELECT *, lag(x) OVER w AS x_prev, lag(yy) OVER w AS y_prev, lead(x) OVER w AS x_next, lead(yy) OVER w AS y_next
  FROM mid WINDOW w AS (PARTITION BY user_id ORDER BY rn)) WHERE mpos > 1 AND mpos < n_mid"""
    q["point_significance"] = blv + "\nSELECT user_id, CAST(rn AS BIGINT) AS row_num, sig FROM sg WHERE sig IS NOT NULL"
    q["rank_points"] = blv + "\nSELECT user_id, CAST(rn AS BIGINT) AS row_num, CAST(rnk AS BIGINT) AS rnk FROM rk WHERE rnk IS NOT NULL"
    p3 = b.levels()[C.LEVEL - 1]
    q["top_fraction"] = blv + f"""
SELECT user_id, CAST(rn AS BIGINT) AS row_num, CAST(rnk AS BIGINT) AS rnk FROM rk
WHERE rnk <= floor(CAST(n_mid - 2 AS DOUBLE) * {_d(p3)})"""
    kept_sql = "SELECT user_id, CAST(rn AS BIGINT) AS row_num, yy AS y FROM lvx WHERE kept"
    q["kept_points"] = blv + "\n" + kept_sql
    q["dropped_points"] = blv + "\nSELECT user_id, CAST(rn AS BIGINT) AS row_num, yy AS y FROM lvx WHERE NOT kept"
    q["level_flags"] = blv + "\nSELECT user_id, CAST(rn AS BIGINT) AS row_num, yy AS y, CASE WHEN kept THEN 1 ELSE 0 END AS flag FROM lvx"
    anchors = f"""
SELECT user_id, CAST(rn AS BIGINT) AS row_num, {{px}} AS prev_x, {{py}} AS prev_y, nx AS next_x, ny AS next_y
FROM lvx WHERE NOT kept"""
    q["nearest_kept"] = blv + anchors.format(px=_px(b), py=_py(b))
    bf = b.with_(leading_anchor="first")
    q["nearest_kept_first"] = _with(_b_src(), _b_level_ctes(bf)) + anchors.format(px=_px(bf), py=_py(bf))
    q["interpolate"] = blv + "\nSELECT user_id, CAST(rn AS BIGINT) AS row_num, yy AS y, round(yhat2, 6) AS yhat FROM lvx"
    q["fit_quality"] = blv + """
SELECT user_id, round(sum(yy), 3) AS sum_y, CAST(count(yy) AS BIGINT) AS n_points,
  round(sum((yhat2 - yy) * (yhat2 - yy)), 3) AS sse,
  round(max(s.sst), 3) AS sst,
  round(CASE WHEN sum((yhat2 - yy) * (yhat2 - yy)) = 0 OR max(s.sst) = 0 THEN 1.0
             ELSE 1 - sqrt(sum((yhat2 - yy) * (yhat2 - yy)) / max(s.sst)) END, 6) AS fit
FROM lvx JOIN st s USING (user_id) GROUP BY user_id"""

    bth = _with(_b_src(), thin_ctes("bsrc", ["user_id"], B_ORDER, b))
    q["fit_by_level"] = bth + "\nSELECT user_id, CAST(lvl AS BIGINT) AS level, round(fit, 6) AS fit FROM fit"
    q["chosen_level"] = bth + """
SELECT c.user_id, CAST(c.lvl AS BIGINT) AS level, round(f.fit, 6) AS fit FROM ch c JOIN fit f USING (user_id, lvl)"""
    cc = C.CFG_C
    cth = _with(_c_src(), thin_ctes("csrc", ["event_type"], B_ORDER, cc))
    q["chosen_level_by_type"] = cth + """
SELECT c.event_type, CAST(c.lvl AS BIGINT) AS level, round(f.fit, 6) AS fit FROM ch c JOIN fit f USING (event_type, lvl)"""
    q["thin_series"] = bth + "\nSELECT user_id, event_id, CAST(rn AS BIGINT) AS row_num FROM kp"
    q["thin_series_first_anchor"] = _with(_b_src(), thin_ctes("bsrc", ["user_id"], B_ORDER, bf)) + \
        "\nSELECT user_id, event_id, CAST(rn AS BIGINT) AS row_num FROM kp"
    q["thin_series_by_type"] = cth + "\nSELECT event_type, event_id, CAST(rn AS BIGINT) AS row_num FROM kp"
    q["thinned_middle"] = bth + "\nSELECT user_id, event_id, CAST(rn AS BIGINT) AS row_num FROM kp WHERE region = 'middle'"
    q["thinned_rows"] = bth + "\nSELECT user_id, event_id, CAST(rn AS BIGINT) AS row_num, region AS part FROM kp"

    # ---- process rows
    for name, tag in {"thin_capacity": "C", "thin_energy": "E", "thin_current": "I",
                      "thin_temperature": "T", "thin_voltage": "V"}.items():
        q[name] = _with(PROC, _a_metric_src(METRICS[tag]), thin_ctes("msrc", KEYS, A_ORDER, a)) + \
            f"\nSELECT handle, {keys_sel}, CAST(rn AS BIGINT) AS row_num FROM kp"
    ath = _with(PROC, _a_all_src(), thin_ctes("allsrc", A_KEYS_CAT, A_ORDER, a))
    q["thin_all_metrics"] = ath + f"\nSELECT {keys_sel}, CAST(rn AS BIGINT) AS row_num, zip_category FROM kp"
    wide = ["handle", "zip_category", "row_num", "sequence_id", "site", "sfc", "pv_voltage", "pv_current",
            "pv_temperature", "pv_charge_capacity", "pv_charge_energy", "created_date_time"]
    join_back = f"""
wk AS (SELECT f.*, k.zip_category FROM arows f JOIN kp k ON {_same("f", "k", KEYS)} AND f.row_num = k.rn)"""
    q["keep_wide_rows"] = ath + "," + join_back + f"\nSELECT {_cols(wide)} FROM wk"
    # null remark, null handles and repeated rows: numbered once, joined on the number
    odd = """
oddsrc AS (
  SELECT * REPLACE (CASE WHEN remark = '1' THEN NULL ELSE remark END AS remark,
                    CASE WHEN step_id = 2 THEN NULL ELSE handle END AS handle)
  FROM (SELECT * FROM fixed UNION ALL SELECT * FROM fixed WHERE step_id = 3)),
odd AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY remark, st_business_cycle, step_id ORDER BY sequence_id) AS row_num,
         count(*) OVER (PARTITION BY remark, st_business_cycle, step_id) AS n FROM oddsrc),
oddall AS (""" + " UNION ALL ".join(
        f"SELECT remark, st_business_cycle, step_id, row_num, n, '{t}' AS zip_category, CAST({c} AS DOUBLE) AS y FROM odd"
        for t, c in METRICS.items()) + ")"
    q["keep_repeated_rows"] = _with(PROC, odd, thin_ctes("oddall", A_KEYS_CAT, [], a, numbered=True)) + f""",
wk AS (SELECT f.*, k.zip_category FROM odd f JOIN kp k ON {_same("f", "k", [*KEYS, "row_num"])})
SELECT {_cols(["handle", "remark", "zip_category", "row_num", "sequence_id", "site", "pv_voltage", "created_date_time"])} FROM wk"""
    text = """
txt AS (""" + " UNION ALL ".join(
        "SELECT remark, st_business_cycle, step_id, row_num, n, '" + t + "' AS zip_category, TRY_CAST("
        + (f"CASE WHEN sequence_id % 50 = 0 AND step_id IN (1, 2) THEN 'n/a' ELSE CAST({c} AS VARCHAR) END"
           if t == "V" else f"CAST({c} AS VARCHAR)") + " AS DOUBLE) AS y FROM arows"
        for t, c in METRICS.items()) + ")"
    q["string_metrics"] = _with(PROC, text, thin_ctes("txt", A_KEYS_CAT, [], a, numbered=True)) + f""",
bad AS (SELECT {", ".join(A_KEYS_CAT)}, bool_or(region = 'middle' AND y IS NULL) AS failed FROM reg GROUP BY ALL),
kn AS (SELECT {", ".join(A_KEYS_CAT)}, count(*) AS kept FROM kp GROUP BY ALL)
SELECT {keys_sel}, zip_category, failed, CAST(CASE WHEN failed THEN 0 ELSE coalesce(kept, 0) END AS BIGINT) AS rows_kept
FROM bad LEFT JOIN kn USING ({", ".join(A_KEYS_CAT)})"""
    q["typed_sink"] = _with(PROC, _a_metric_src("pv_voltage"), thin_ctes("msrc", KEYS, A_ORDER, a)) + f"""
SELECT concat_ws(',', f.handle, 'V', '{C.RUN_TS[:10]}') AS handle, CAST(f.sequence_id AS BIGINT) AS sequence_id,
       CAST(f.step_id AS BIGINT) AS step_id, CAST(f.pv_voltage AS DOUBLE) AS pv_voltage,
       CAST(f.pv_charge_energy AS DOUBLE) AS pv_charge_energy,
       strftime(f.created_date_time, '%Y-%m-%d %H:%M:%S') AS created_date_time
FROM arows f JOIN kp k ON {_same("f", "k", KEYS)} AND f.row_num = k.rn"""
    # the sink's columns, in its order
    out_cols = ["handle", "site", "remark", "sfc", "resource_id", "channel_id", "sequence_id", "cycle", "step_id",
                "step_name", "test_time_duration", "timestamp", "sv_ic_range", "sv_iv_range", "pv_voltage",
                "pv_current", "pv_ir", "pv_temperature", "pv_charge_capacity", "pv_discharge_capacity",
                "pv_charge_energy", "pv_discharge_energy", "pv_sub_channel_1", "pv_sub_channel_2",
                "pv_sub_channel_3", "pv_sub_channel_4", "pv_sub_channel_5", "pv_sub_channel_6", "pv_data_flag",
                "pv_work_type", "tx_is_exceptional", "tx_alert_current", "tx_alert_voltage",
                "tx_alert_temperature", "tx_alert_capacity", "tx_alert_duration", "tx_alert_category1",
                "tx_alert_category2", "tx_root_remark", "st_business_cycle", "zip_category",
                "created_date_time", "created_user", "modified_date_time", "modified_user"]
    sel = []
    for c in out_cols:
        if c == "handle":
            sel.append(f"concat_ws(',', handle, zip_category, strftime(TIMESTAMP '{C.RUN_TS}', '%Y-%m-%d')) AS handle")
        elif c == "modified_date_time":
            sel.append(f"strftime(TIMESTAMP '{C.RUN_TS}', '%Y-%m-%d %H:%M:%S') AS modified_date_time")
        elif c == "modified_user":
            sel.append("'spark' AS modified_user")
        else:
            sel.append(_present(c))
    q["compressed_output"] = ath + "," + join_back + f"\nSELECT {', '.join(sel)} FROM wk"
    # everything pending, of both shards
    backlog = """pend AS (SELECT DISTINCT remark, st_business_cycle, step_id FROM status
  WHERE c_status = 0 OR e_status = 0 OR i_status = 0 OR t_status = 0 OR v_status = 0)"""
    q["backlog_rows"] = _with(PROC, STATUS, backlog, _a_all_src(), thin_ctes("allsrc", A_KEYS_CAT, A_ORDER, a)) + "," + join_back + f"""
SELECT concat_ws(',', handle, zip_category, '{C.RUN_TS[:10]}') AS handle, zip_category, {_cols(["sequence_id", "pv_voltage", "pv_charge_energy"])}
FROM wk SEMI JOIN pend ON {_same("wk", "pend", KEYS)}"""
    flags = ", ".join(f"CAST(CASE WHEN p.remark IS NOT NULL THEN 1 ELSE s.{f} END AS BIGINT) AS {f}"
                      for f in ["c_status", "e_status", "i_status", "t_status", "v_status"])
    q["backlog_status"] = _with(STATUS, backlog) + f"""
SELECT s.remark, CAST(s.st_business_cycle AS BIGINT) AS st_business_cycle, CAST(s.step_id AS BIGINT) AS step_id, {flags},
  strftime(CASE WHEN p.remark IS NOT NULL THEN TIMESTAMP '{C.RUN_TS}' ELSE s.modified_date_time END, '%Y-%m-%d %H:%M:%S') AS modified_date_time,
  CASE WHEN p.remark IS NOT NULL THEN 'spark' ELSE s.modified_user END AS modified_user
FROM status s LEFT JOIN pend p ON {_same("s", "p", KEYS)}"""
    q["ordered_load"] = _with(PROC) + f"""
SELECT {_cols([*KEYS, "sequence_id", "handle", "pv_voltage"])},
  row_number() OVER (ORDER BY remark, st_business_cycle, step_id, sequence_id, handle) AS position FROM proc"""
    split_cols = [c for c in PROCESS_COLUMNS if c != "step_logic_number"]
    q["split_and_rejoin"] = _with(PROC) + f"\nSELECT {_cols(split_cols)} FROM proc"
    q["split_fields"] = _with(PROC) + """,
t AS (SELECT handle, string_split(concat_ws(';', handle, coalesce(site, 'null'), coalesce(remark, 'null'),
          coalesce(CAST(step_id AS VARCHAR), 'null'), coalesce(pv_sub_channel_2, 'null')), ';') AS parts FROM proc)
SELECT handle, CAST(len(parts) AS BIGINT) AS n_fields, parts[3] AS remark, CAST(parts[4] AS BIGINT) AS step_id,
       parts[5] AS sub_channel_2 FROM t"""
    q["scalar_kit"] = _with(PROC) + f"""
SELECT handle, CAST(((step_id % 2) + 2) % 2 AS BIGINT) AS step_mod,
  CAST(CASE WHEN pv_charge_capacity <> 0 THEN pv_charge_capacity ELSE pv_discharge_capacity END AS DOUBLE) AS repaired,
  concat_ws('#', remark, CAST(st_business_cycle AS VARCHAR), CAST(step_id AS VARCHAR)) AS series_key,
  CAST(len(string_split(handle, '-')) AS BIGINT) AS handle_parts,
  strftime("timestamp", '%Y-%m-%d') AS day,
  CAST(floor(CAST(pv_current AS DOUBLE) * {_d(0.30000000000000004)}) AS BIGINT) AS cut,
  abs(CAST(pv_voltage AS DOUBLE) - {_d(0.05)}) AS dist,
  round(sqrt(CAST(pv_temperature AS DOUBLE)), 6) AS root,
  CAST(sequence_id AS DOUBLE) AS x
FROM proc"""
    for name, v in {"status_after_success": 1, "status_after_failure": 2}.items():
        flags = ", ".join(f"CAST(CASE WHEN p.remark IS NOT NULL THEN {v} ELSE s.{f} END AS BIGINT) AS {f}"
                          for f in ["c_status", "e_status", "i_status", "t_status", "v_status"])
        q[name] = _with(STATUS, _pending(0)) + f"""
SELECT s.remark, CAST(s.st_business_cycle AS BIGINT) AS st_business_cycle, CAST(s.step_id AS BIGINT) AS step_id, {flags},
  strftime(CASE WHEN p.remark IS NOT NULL THEN TIMESTAMP '{C.RUN_TS}' ELSE s.modified_date_time END, '%Y-%m-%d %H:%M:%S') AS modified_date_time,
  CASE WHEN p.remark IS NOT NULL THEN 'spark' ELSE s.modified_user END AS modified_user
FROM status s LEFT JOIN pend p ON s.remark = p.remark AND s.st_business_cycle = p.st_business_cycle AND s.step_id = p.step_id"""
    flags = {"C": "c_status", "E": "e_status", "I": "i_status", "T": "t_status", "V": "v_status"}
    pp = " UNION ALL ".join(
        f"SELECT remark, st_business_cycle, step_id, '{t}' AS zip_category FROM status "
        f"JOIN pend USING (remark, st_business_cycle, step_id) WHERE {c} = 0"
        for t, c in flags.items())
    setf = ", ".join(
        f"CAST(coalesce(max(CASE WHEN o.zip_category = '{t}' THEN o.value END), max(s.{c})) AS BIGINT) AS {c}"
        for t, c in flags.items())
    q["status_per_metric"] = _with(PROC, STATUS, _pending(0), _a_all_src(),
                                   thin_ctes("allsrc", A_KEYS_CAT, A_ORDER, a)) + f""",
pp AS ({pp}),
bad AS (SELECT remark, st_business_cycle, step_id, zip_category,
          max(CASE WHEN region = 'middle' AND (y IS NULL OR isnan(y) OR isinf(y)) THEN 1 ELSE 0 END) AS bad
        FROM reg GROUP BY ALL),
o AS (SELECT pp.*, CASE WHEN bad.bad = 1 THEN 2 ELSE 1 END AS value FROM pp
      LEFT JOIN bad USING (remark, st_business_cycle, step_id, zip_category))
SELECT s.remark, CAST(s.st_business_cycle AS BIGINT) AS st_business_cycle, CAST(s.step_id AS BIGINT) AS step_id, {setf},
  strftime(CASE WHEN count(o.zip_category) > 0 THEN TIMESTAMP '{C.RUN_TS}' ELSE max(s.modified_date_time) END, '%Y-%m-%d %H:%M:%S') AS modified_date_time,
  CASE WHEN count(o.zip_category) > 0 THEN 'spark' ELSE max(s.modified_user) END AS modified_user
FROM status s LEFT JOIN o ON s.remark = o.remark AND s.st_business_cycle = o.st_business_cycle AND s.step_id = o.step_id
GROUP BY s.remark, s.st_business_cycle, s.step_id"""
    report = """
SELECT {ksel}, CAST(count(*) AS BIGINT) AS rows_in, CAST(sum(CASE WHEN k.rn IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows_out,
  round(sum(CASE WHEN k.rn IS NOT NULL THEN 1 ELSE 0 END) / count(*), 6) AS ratio,
  CAST(max(c.lvl) AS BIGINT) AS level, round(max(f.fit), 6) AS fit
FROM reg r LEFT JOIN kp k ON {kj} AND k.rn = r.rn
LEFT JOIN ch c ON {cj} LEFT JOIN fit f ON {fj} AND f.lvl = c.lvl
GROUP BY {kg}"""
    def rep(keys, ksel):
        return report.format(ksel=ksel, kg=", ".join(f"r.{c}" for c in keys),
                             kj=" AND ".join(f"k.{c} = r.{c}" for c in keys),
                             cj=" AND ".join(f"c.{c} = r.{c}" for c in keys),
                             fj=" AND ".join(f"f.{c} = r.{c}" for c in keys))
    q["compression_report"] = ath + rep(A_KEYS_CAT, "r.remark, CAST(r.st_business_cycle AS BIGINT) AS st_business_cycle, "
                                        "CAST(r.step_id AS BIGINT) AS step_id, r.zip_category")
    q["compression_report_events"] = bth + rep(["user_id"], "r.user_id")
    return q
