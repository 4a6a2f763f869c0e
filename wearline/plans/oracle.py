"""DuckDB SQL for each registered query (same names, same columns, rounded alike).

The SQL states each operator the plain way (global windows, self-joins); it is an
independent check of the Spark plans, which avoid single-partition windows and hot tasks.
"""

from __future__ import annotations

from wearline.functions.stats import MASK32, MIX_MULT, REP_MULT, poisson1_cdf
from wearline.constants import ALL_SENSORS, BOOTSTRAP_RESAMPLES, TELEMETRY_COLUMNS
from wearline.operators.kernels import kernel_places

EV = ["sensor_2", "sensor_3"]
PARTS = ["sensor_2", "sensor_3", "sensor_4", "sensor_7"]
SEPARATORS = [" ", "  ", " \t "]


def R(expr: str) -> str:
    return f"round({expr}, 6)"


TE = """te AS (
  SELECT user_id AS unit,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS cycle,
         CAST(518.67 AS DOUBLE) AS sensor_1,
         value AS sensor_2,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS sensor_3
  FROM events)"""

TF = """tf AS (
  SELECT event_type AS dataset, user_id AS unit,
         CAST(row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS BIGINT) AS cycle,
         CAST(518.67 AS DOUBLE) AS sensor_1,
         value AS sensor_2,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS sensor_3
  FROM events)"""

LAB = """lab AS (
  SELECT te.unit, te.cycle, te.sensor_1, te.sensor_2, te.sensor_3, m.max_cycle - te.cycle AS rul
  FROM te JOIN (SELECT unit, max(cycle) AS max_cycle FROM te GROUP BY unit) m ON te.unit = m.unit)"""

TP = """tp AS (
  SELECT l_partkey AS unit,
         CAST(row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS BIGINT) AS cycle,
         l_quantity AS sensor_2, l_extendedprice AS sensor_3, l_discount AS sensor_4, l_tax AS sensor_7
  FROM lineitem),
tpl AS (
  SELECT tp.*, m.max_cycle - tp.cycle AS rul,
         row_number() OVER (PARTITION BY tp.unit ORDER BY tp.cycle) AS idx,
         count(*) OVER (PARTITION BY tp.unit) AS n_rows
  FROM tp JOIN (SELECT unit, max(cycle) AS max_cycle FROM tp GROUP BY unit) m ON tp.unit = m.unit)"""


def unit_hash(cols: list[str], digits: int) -> str:
    parts = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"CAST(('0x' || substr(md5(concat_ws(':', '42', {parts})), 1, {digits})) AS BIGINT)"


def split_cte(name: str, src: str, share: float) -> str:
    return f"""{name}_h AS (SELECT unit, {unit_hash(['unit'], 15)} AS h FROM (SELECT DISTINCT unit FROM {src})),
{name} AS (
  SELECT unit,
         CASE WHEN row_number() OVER (ORDER BY h, unit) <= ceil(CAST({share!r} AS DOUBLE) * count(*) OVER ())
              THEN 'validation' ELSE 'train' END AS split
  FROM {name}_h)"""


SPLIT = f"""{split_cte('us', 'lab', 0.2)},
tr AS (SELECT lab.* FROM lab JOIN us ON lab.unit = us.unit WHERE us.split = 'train'),
va AS (SELECT lab.* FROM lab JOIN us ON lab.unit = us.unit WHERE us.split = 'validation'),
al AS (SELECT avg(mc) AS avg_life FROM (SELECT unit, max(cycle) AS mc FROM tr GROUP BY unit))"""

FP = """fp AS (
  SELECT unit, cycle, rul, (SELECT avg_life FROM al) - cycle AS pred_a, 0.5 * (SELECT avg_life FROM al) AS pred_b FROM va)"""

ER = """er AS (
  SELECT *, abs(rul - pred_a) AS err_a, abs(rul - pred_b) AS err_b, abs(rul - pred_a) - abs(rul - pred_b) AS d FROM fp)"""

CL = """cl AS (
  SELECT unit, cycle, CAST(rul <= 30 AS INTEGER) AS label, least(CAST(1.0 AS DOUBLE), cycle / (SELECT avg_life FROM al)) AS prob
  FROM va)"""

BASE = f"WITH {TE},\n{LAB},\n{SPLIT}"


def rolled_cols(sensors: list[str], window: str = "w", rnd: bool = True, fill_std: bool = False) -> str:
    out = []
    for s in sensors:
        m = f"avg({s}) OVER {window}"
        sd = f"stddev_samp({s}) OVER {window}"
        if fill_std:
            sd = f"coalesce({sd}, 0)"
        out.append(f"{R(m) if rnd else m} AS {s}_rollmean")
        out.append(f"{R(sd) if rnd else sd} AS {s}_rollstd")
    return ", ".join(out)


W5 = "(PARTITION BY unit ORDER BY cycle ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"
EV_COLS = "unit, cycle, round(sensor_1, 6) AS sensor_1, round(sensor_2, 6) AS sensor_2, round(sensor_3, 6) AS sensor_3"


def _text_line() -> str:
    have = {"unit", "cycle", "sensor_1", "sensor_2", "sensor_3"}
    parts = []
    for i, name in enumerate(TELEMETRY_COLUMNS):
        parts.append(f"CAST({name} AS VARCHAR)" if name in have else "'NaN'")
        if i < len(TELEMETRY_COLUMNS) - 1:
            sep = SEPARATORS[i % 3].replace("\t", "' || chr(9) || '")
            parts.append(f"'{sep}'")
    lead = "CASE WHEN cycle % 2 = 0 THEN ' ' ELSE '' END"
    trail = "CASE WHEN cycle % 2 = 1 THEN chr(9) ELSE '' END"
    return " || ".join([lead, *parts, trail])


def _s1() -> str:
    cols = []
    for i, name in enumerate(TELEMETRY_COLUMNS):
        tok = f"t[{i + 1}]"
        if name in ("unit", "cycle"):
            cols.append(f"CASE WHEN TRY_CAST({tok} AS DOUBLE) = floor(TRY_CAST({tok} AS DOUBLE)) THEN CAST(TRY_CAST({tok} AS DOUBLE) AS BIGINT) END AS {name}")
        else:
            cols.append(f"CASE WHEN isnan(TRY_CAST({tok} AS DOUBLE)) THEN NULL ELSE TRY_CAST({tok} AS DOUBLE) END AS {name}")
    return f"""WITH {TE},
txt AS (SELECT {_text_line()} AS value FROM te),
ln AS (SELECT regexp_replace(value, '^\\s+|\\s+$', '', 'g') AS line FROM txt),
tk AS (SELECT regexp_split_to_array(line, '\\s+') AS t FROM ln WHERE line <> '')
SELECT {", ".join(cols)} FROM tk WHERE len(t) = 26"""


def _s9() -> str:
    fields = " || ',' || ".join(f"""'"{s}":' || coalesce(printf('%.6f', {s}), 'null')""" for s in ALL_SENSORS)
    return f"""WITH {TE},
{_request_rows()}
SELECT CAST(unit AS VARCHAR) AS request_id, CAST(count(*) AS INTEGER) AS cycles_used,
       '[' || string_agg('{{' || {fields} || '}}', ',' ORDER BY cycle) || ']' AS body
FROM rq GROUP BY unit"""


def _a16_exact() -> str:
    """Ranks by a window, the null distribution by a recursion over the ranks."""
    return f"""WITH RECURSIVE {BASE[len('WITH '):]},
{FP},
{ER},
pr AS (SELECT unit % 40 AS part, avg(d) AS d FROM er GROUP BY 1),
rk AS (SELECT d, rank() OVER (ORDER BY abs(d)) AS r FROM pr WHERE d <> 0),
st AS (SELECT count(*) AS n, count(DISTINCT abs(d)) AS k, least(coalesce(sum(r) FILTER (WHERE d > 0), 0), coalesce(sum(r) FILTER (WHERE d < 0), 0))::DOUBLE AS w FROM rk JOIN (SELECT 1) ON true),
dist AS (
  SELECT 0 AS m, list_concat([1.0::DOUBLE], list_transform(range(0, CAST(n * (n + 1) / 2 AS BIGINT)), lambda i: 0.0::DOUBLE)) AS c FROM st
  UNION ALL
  SELECT m + 1, list_transform(range(0, len(c)), lambda s: c[s + 1] + CASE WHEN s >= m + 1 THEN c[s - m] ELSE 0 END) FROM dist, st WHERE m < n
)
SELECT n, w, round(CASE WHEN n >= 1 AND n <= 50 AND k = n THEN least(1.0, 2 * list_sum(c[1:CAST(w AS BIGINT) + 1]) / pow(2, n)) END, 6) AS p
FROM st JOIN dist ON dist.m = st.n"""


def _m6_kernels() -> str:
    """Kernels as sums of lagged readings, counted over the window's rows."""
    n, width, places = 30, 9, kernel_places(4)
    lags, flags, counts = set(), [], []
    for s in PARTS:
        for d in (1, 2, 3):
            lag = lambda i, s=s, d=d: s if i == width - 1 else f"l_{s}_{d * (width - 1 - i)}"
            lags |= {(s, d * (width - 1 - i)) for i in range(width - 1)}
            total = " + ".join(lag(i) for i in range(width))
            for j, heavy in enumerate(places):
                name = f"{s}_k{d}_{j}"
                flags.append(f"CASE WHEN 3.0::DOUBLE * ({' + '.join(lag(i) for i in heavy)}) > {total} THEN 1 ELSE 0 END AS {name}")
                counts.append((name, n - 1 - d * (width - 1)))
        flags.append(f"CASE WHEN {s} > (SELECT round(avg({s}), 6) FROM tp) THEN 1 ELSE 0 END AS {s}_over0")
        counts.append((f"{s}_over0", n - 1))
    lagged = ", ".join(f"lag({s}, {k}) OVER u AS l_{s}_{k}" for s, k in sorted(lags))
    summed = ", ".join(f"CAST(sum({c}) OVER (PARTITION BY unit ORDER BY cycle ROWS BETWEEN {b} PRECEDING AND CURRENT ROW) AS INTEGER) AS {c}" for c, b in counts)
    return f"""WITH {TE},
{TP},
lg AS (SELECT *, {lagged} FROM tpl WINDOW u AS (PARTITION BY unit ORDER BY cycle)),
fl AS (SELECT unit, cycle, idx, {", ".join(flags)} FROM lg),
sm AS (SELECT unit, cycle, idx, {summed} FROM fl)
SELECT * EXCLUDE (idx) FROM sm WHERE idx >= 30"""


def _request_rows() -> str:
    sensors = []
    for s in ALL_SENSORS:
        sensors.append(s if s in ("sensor_1", "sensor_2", "sensor_3") else f"CAST(0.0 AS DOUBLE) AS {s}")
    return f"""lk AS (
  SELECT unit, cycle, {", ".join(sensors)},
         row_number() OVER (PARTITION BY unit ORDER BY cycle DESC) AS rd,
         least(5, count(*) OVER (PARTITION BY unit)) AS k
  FROM te),
rq AS (SELECT * FROM lk WHERE rd <= 5)"""


def _s8() -> str:
    return f"""WITH {TE},
{_request_rows()}
SELECT CAST(unit AS VARCHAR) AS request_id, CAST(k - rd + 1 AS BIGINT) AS pos, {", ".join(ALL_SENSORS)} FROM rq"""


def _p17() -> str:
    missing = " OR ".join(f"{s} IS NULL OR isnan({s})" for s in ALL_SENSORS)
    return f"""WITH {TE},
{_request_rows()}
SELECT CAST(unit AS VARCHAR) AS request_id, CAST(count(*) AS BIGINT) AS cycles_used,
       CASE WHEN count(*) < 1 THEN 'empty' WHEN count(*) > 5 THEN 'too_many_readings'
            WHEN bool_or({missing}) THEN 'missing_sensor' END AS error
FROM rq GROUP BY unit"""


def _rolled_lab_split() -> str:
    return f"""{BASE},
rl AS (SELECT lab.*, {rolled_cols(EV, 'w', rnd=False)} FROM lab WINDOW w AS {W5}),
rtr AS (SELECT rl.* FROM rl JOIN us ON rl.unit = us.unit WHERE us.split = 'train'),
rva AS (SELECT rl.* FROM rl JOIN us ON rl.unit = us.unit WHERE us.split = 'validation')"""


def _feats(sensors: list[str]) -> list[str]:
    return sensors + [f"{s}_rollmean" for s in sensors] + [f"{s}_rollstd" for s in sensors]


def _scale_expr(col: str, src: str, fill: bool) -> tuple[str, str]:
    x = f"coalesce({col}, 0)" if fill else col
    mean = f"(SELECT avg({x}) FROM {src})"
    sd = f"(SELECT stddev_pop({x}) FROM {src})"
    scale = f"(CASE WHEN {sd} IS NULL OR {sd} <= 1e-12 * greatest(abs({mean}), 1) THEN 1.0 ELSE {sd} END)"
    return mean, scale


def _m3() -> str:
    cols = []
    for f in _feats(EV):
        mean, scale = _scale_expr(f, "rtr", fill=True)
        cols.append(f"{R(f'(coalesce({f}, 0) - {mean}) / {scale}')} AS {f}")
    return f"""{_rolled_lab_split()}
SELECT unit, cycle, {", ".join(cols)} FROM rva"""


def _a8() -> str:
    parts = []
    for i, f in enumerate(_feats(EV)):
        mean, scale = _scale_expr(f, "rtr2", fill=False)
        parts.append(f"SELECT '{f}' AS feature, {i} AS pos, {R(mean)} AS mean, {R(scale)} AS scale")
    return f"""{BASE},
rtr2 AS (SELECT tr.*, {rolled_cols(EV, 'w', rnd=False)} FROM tr WINDOW w AS {W5})
{" UNION ALL ".join(parts)}"""


def _conf(cut: str) -> str:
    return f"""conf AS (
  SELECT CAST(coalesce(sum(CASE WHEN label = 0 AND prob <  {cut} THEN 1 ELSE 0 END), 0) AS BIGINT) AS tn,
         CAST(coalesce(sum(CASE WHEN label = 0 AND prob >= {cut} THEN 1 ELSE 0 END), 0) AS BIGINT) AS fp,
         CAST(coalesce(sum(CASE WHEN label = 1 AND prob <  {cut} THEN 1 ELSE 0 END), 0) AS BIGINT) AS fn,
         CAST(coalesce(sum(CASE WHEN label = 1 AND prob >= {cut} THEN 1 ELSE 0 END), 0) AS BIGINT) AS tp
  FROM cl)"""


def _rates() -> str:
    return (f"{R('CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END')} AS precision, "
            f"{R('CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END')} AS recall, "
            f"{R('CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END')} AS f1")


def _a13() -> str:
    parts = []
    for c in (0.5, 0.3):
        cut = f"CAST({c!r} AS DOUBLE)"
        parts.append(f"""SELECT {cut} AS cutoff, tp, fp, fn, {_rates()} FROM (
  SELECT CAST(coalesce(sum(CASE WHEN prob >= {cut} AND label = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS tp,
         CAST(coalesce(sum(CASE WHEN prob >= {cut} AND label = 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS fp,
         CAST(coalesce(sum(CASE WHEN prob <  {cut} AND label = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS fn
  FROM cl)""")
    return f"{BASE},\n{CL}\n" + "\nUNION ALL\n".join(parts)


def _auc(src: str, score: str, label: str) -> str:
    return f"""g AS (SELECT {score} AS s, sum(CASE WHEN {label} = 1 THEN 1 ELSE 0 END) AS pos,
                  sum(CASE WHEN {label} = 0 THEN 1 ELSE 0 END) AS neg
           FROM {src} WHERE {score} IS NOT NULL AND {label} IN (0, 1) GROUP BY {score}),
gp AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM g)
SELECT {R('sum(pos * (nb + 0.5 * neg)) / CASE WHEN sum(pos) * sum(neg) > 0 THEN sum(pos) * sum(neg) END')} AS roc_auc FROM gp"""


def _a16_tail() -> str:
    return "WITH " + _a16().split(f"{ER},\n", 1)[1]


def _a16() -> str:
    return f"""{BASE},
{FP},
{ER},
nz AS (SELECT abs(d) AS a, d > 0 AS pos FROM er WHERE d IS NOT NULL AND d <> 0),
g AS (SELECT a, CAST(count(*) AS DOUBLE) AS c, CAST(sum(CASE WHEN pos THEN 1 ELSE 0 END) AS DOUBLE) AS np FROM nz GROUP BY a),
p AS (SELECT *, coalesce(sum(c) OVER (ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (c + 1) / 2 AS mid FROM g),
o AS (SELECT coalesce(sum(c), 0) AS n, coalesce(sum(np * mid), 0) AS w_plus, coalesce(sum((c - np) * mid), 0) AS w_minus,
             coalesce(sum(c * c * c - c), 0) AS tie_term FROM p)
SELECT CAST(n AS BIGINT) AS n, {R('w_plus')} AS w_plus, {R('w_minus')} AS w_minus, {R('least(w_plus, w_minus)')} AS w,
       {R('tie_term')} AS tie_term,
       {R('(least(w_plus, w_minus) - n * (n + 1) / 4) / sqrt(n * (n + 1) * (2 * n + 1) / 24 - tie_term / 48)')} AS z
FROM o"""


def _boot_means() -> str:
    cdf = [c for c in poisson1_cdf() if c < 1.0]
    steps = "CASE " + " ".join(f"WHEN u < CAST('{c!r}' AS DOUBLE) THEN {k}" for k, c in enumerate(cdf)) + f" ELSE {len(cdf)} END"
    return f"""{BASE},
{FP},
{ER},
fx AS (SELECT unit, cycle, CAST(floor(d * CAST(1099511627776 AS DOUBLE)) AS BIGINT) AS f FROM er WHERE d IS NOT NULL),
rw AS (SELECT {unit_hash(['unit', 'cycle'], 8)} AS h, f >> 40 AS l0, (f >> 20) & 1048575 AS l1, f & 1048575 AS l2 FROM fx),
rp AS (SELECT h, l0, l1, l2, CAST(r AS BIGINT) AS rep FROM rw, range(0, {BOOTSTRAP_RESAMPLES}) t(r)),
m0 AS (SELECT rep, l0, l1, l2, xor(h, (rep * {REP_MULT}) & {MASK32}) AS z FROM rp),
m1 AS (SELECT rep, l0, l1, l2, (xor(z, z >> 16) * {MIX_MULT}) & {MASK32} AS z FROM m0),
m2 AS (SELECT rep, l0, l1, l2, (xor(z, z >> 16) * {MIX_MULT}) & {MASK32} AS z FROM m1),
m3 AS (SELECT rep, l0, l1, l2, CAST(xor(z, z >> 16) AS DOUBLE) / CAST(4294967296 AS DOUBLE) AS u FROM m2),
wt AS (SELECT rep, l0, l1, l2, {steps} AS w FROM m3),
bm AS (SELECT rep,
              CAST((CAST(sum(w * l0) AS HUGEINT) * 1048576 + sum(w * l1)) * 1048576 + sum(w * l2) AS DOUBLE)
              / CAST(1099511627776 AS DOUBLE) / CASE WHEN sum(w) <> 0 THEN CAST(sum(w) AS DOUBLE) END AS mean
       FROM wt GROUP BY rep)"""


def _w6_long(pad: bool) -> str:
    sens = ", ".join(f"r.{s}" for s in PARTS)
    row = ", ".join(f"{s} := {s}" for s in PARTS)
    out = ", ".join(f"w[k].{s} AS {s}" for s in PARTS)
    skip = f"""SELECT unit, cycle, rul, CAST(k AS BIGINT) AS step, {out}
FROM (SELECT unit, cycle, rul, idx, w, unnest(range(1, 31)) AS k
      FROM (SELECT unit, cycle, rul, idx, list(struct_pack({row})) OVER (PARTITION BY unit ORDER BY idx ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS w FROM tpl)
      WHERE idx >= 30)"""
    if not pad:
        return f"WITH {TE},\n{TP}\n{skip}"
    first = ", ".join(f"f.{s}" for s in PARTS)
    return f"""WITH {TE},
{TP},
lastrow AS (SELECT * FROM tpl WHERE idx = n_rows AND n_rows < 30)
{skip}
UNION ALL
SELECT e.unit, e.cycle, e.rul, CAST(30 - e.n_rows + r.idx AS BIGINT) AS step, {sens}
FROM lastrow e JOIN tpl r ON r.unit = e.unit
UNION ALL
SELECT e.unit, e.cycle, e.rul, CAST(p.k AS BIGINT) AS step, {first}
FROM lastrow e JOIN tpl f ON f.unit = e.unit AND f.idx = 1, range(1, 31) p(k)
WHERE p.k <= 30 - e.n_rows"""


def _m6_summaries() -> str:
    cols = []
    for s in PARTS:
        cols += [
            f"{R(f'first_value({s}) OVER w')} AS {s}_wfirst",
            f"{R(f'avg({s}) OVER w')} AS {s}_wmean",
            f"{R(f'stddev_samp({s}) OVER w')} AS {s}_wstd",
            f"{R(f'regr_slope({s}, CAST(cycle AS DOUBLE)) OVER w')} AS {s}_wslope",
        ]
    return f"""WITH {TE},
{TP},
ws AS (SELECT unit, cycle, rul, count(*) OVER w AS wn, {", ".join(cols)}
       FROM tpl WINDOW w AS (PARTITION BY unit ORDER BY cycle ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
SELECT unit, cycle, rul, {", ".join(c.split(" AS ")[-1] for c in cols)} FROM ws WHERE wn = 30"""


def _request_features() -> str:
    raw = ", ".join(f"{R(f'max_by({s}, cycle)')} AS {s}" for s in EV)
    means = ", ".join(f"{R(f'avg({s})')} AS {s}_rollmean" for s in EV)
    stds = ", ".join(f"{R(f'stddev_samp({s})')} AS {s}_rollstd" for s in EV)
    return f"""WITH {TE},
{_request_rows()}
SELECT CAST(unit AS VARCHAR) AS request_id, CAST(count(*) AS INTEGER) AS cycles_used, {raw}, {means}, {stds}
FROM rq GROUP BY unit"""


def _trajectories() -> str:
    parts = [f"SELECT unit, cycle, '{s}' AS sensor, {s} AS value FROM te WHERE unit IN (1, 2, 3)" for s in EV]
    return f"WITH {TE}\n" + "\nUNION ALL\n".join(parts)


def _spread(filter_flat: bool) -> str:
    parts = [f"SELECT '{s}' AS sensor, stddev_samp({s}) AS std, avg({s}) AS mean FROM te" for s in ["sensor_1", *EV]]
    body = f"WITH {TE},\nsp AS ({' UNION ALL '.join(parts)})\n"
    if filter_flat:
        return body + "SELECT sensor FROM sp WHERE std IS NULL OR std <= 1e-12 * greatest(abs(mean), 1)"
    return body + f"SELECT sensor, {R('std')} AS std, {R('mean')} AS mean FROM sp"


def oracle_sql() -> dict[str, str]:
    te_rolled = f"SELECT {EV_COLS}, {{cols}} FROM te WINDOW w AS {W5}"
    q: dict[str, str] = {}
    q["s1_parse_telemetry"] = _s1()
    q["s8_explode_requests"] = _s8()
    q["p17_validate_requests"] = _p17()
    q["p3_fleet_key"] = f"""WITH {TF}
SELECT dataset, unit, cycle, concat_ws('_', dataset, CAST(unit AS VARCHAR)) AS fleet_unit FROM tf"""
    q["p2_tag_dataset"] = f"WITH {TE}\nSELECT unit, cycle, sensor_1, sensor_2, sensor_3, 'FD001' AS dataset FROM te"
    q["p6_sensor_columns"] = f"WITH {TE}\nSELECT unit, cycle, sensor_1, sensor_2, sensor_3 FROM te"
    feats = ", ".join(_feats(EV))
    q["p7_feature_projection"] = (f"WITH {TE},\nfr AS (SELECT unit, cycle, sensor_2, sensor_3, {rolled_cols(EV, 'w', rnd=False)} FROM te WINDOW w AS {W5})\n"
                                  f"SELECT unit, cycle, " + ", ".join(f"{R(f)} AS {f}" for f in _feats(EV)) + " FROM fr")
    q["p8_drop_flat"] = f"WITH {TE}\nSELECT unit, cycle, sensor_2, sensor_3 FROM te"
    q["p9_unit_filter"] = f"WITH {TE}\nSELECT * FROM te WHERE unit IN (1, 2, 3)"
    q["p11_fail_label"] = f"WITH {TE},\n{LAB}\nSELECT unit, cycle, rul, CAST(rul <= 30 AS INTEGER) AS fail_within_30 FROM lab"
    q["p12_impute"] = f"WITH {TE}\n" + te_rolled.format(cols=rolled_cols(EV, fill_std=True))
    q["p14_errors"] = f"""{BASE},
{FP},
{ER}
SELECT unit, cycle, rul, {R('pred_a')} AS pred_a, {R('pred_b')} AS pred_b, {R('err_a')} AS err_a, {R('err_b')} AS err_b, {R('d')} AS d FROM er"""
    q["p15_classify"] = f"""{BASE},
{CL}
SELECT unit, cycle, label, {R('prob')} AS prob, CAST(prob >= CAST(0.3 AS DOUBLE) AS INTEGER) AS pred FROM cl"""
    q["p16_preview"] = f"WITH {TE}\n" + te_rolled.format(cols=rolled_cols(EV)) + "\nORDER BY unit, cycle LIMIT 10"
    q["p18_trajectories"] = _trajectories()
    q["j1_label_rul"] = f"WITH {TE},\n{LAB}\nSELECT * FROM lab"
    q["j2_align"] = f"""{BASE},
{FP},
se AS (SELECT unit, cycle, rul AS true_rul,
              count(*) OVER (PARTITION BY unit ORDER BY cycle ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS c FROM va)
SELECT se.unit, se.cycle, se.true_rul, {R('fp.pred_a')} AS pred_a
FROM se JOIN fp ON se.unit = fp.unit AND se.cycle = fp.cycle WHERE se.c = 30"""
    q["j3_by_units"] = f"""WITH {TE},
{split_cte('ut', 'te', 0.2)}
SELECT * FROM te WHERE unit IN (SELECT unit FROM ut WHERE split = 'validation')"""
    q["j4_without_units"] = f"""WITH {TE},
{split_cte('ut', 'te', 0.2)}
SELECT * FROM te WHERE unit NOT IN (SELECT unit FROM ut WHERE split = 'validation')"""
    q["m3_scale_features"] = _m3()
    q["a1_lifetimes"] = f"WITH {TE}\nSELECT unit, max(cycle) AS max_cycle FROM te GROUP BY unit"
    q["a2_split_profile"] = f"""{BASE},
pu AS (SELECT us.split, lab.unit, max(lab.cycle) AS life, count(*) AS n FROM lab JOIN us ON lab.unit = us.unit GROUP BY us.split, lab.unit)
SELECT split, count(*) AS n_units, CAST(sum(n) AS BIGINT) AS n_rows, {R('avg(life)')} AS avg_lifetime FROM pu GROUP BY split"""
    q["a3_profile"] = f"WITH {TE}\nSELECT count(*) AS n_rows, count(DISTINCT unit) AS n_units FROM te"
    q["a4_units"] = f"WITH {TE}\nSELECT DISTINCT unit FROM te"
    q["a6_sensor_spread"] = _spread(False)
    q["a6_flat_sensors"] = _spread(True)
    q["a7_class_balance"] = f"""WITH {TE},
{LAB}
SELECT CAST(rul <= 30 AS INTEGER) AS fail_within_30, count(*) AS n, {R('count(*) / sum(count(*)) OVER ()')} AS share
FROM lab GROUP BY 1"""
    q["a8_fit_scaler"] = _a8()
    q["a9_regression_metrics"] = f"""{BASE},
{FP}
SELECT count(rul - pred_a) AS n, {R('avg(abs(rul - pred_a))')} AS mae, {R('sqrt(avg((rul - pred_a) * (rul - pred_a)))')} AS rmse FROM fp"""
    q["a11_confusion"] = f"""{BASE},
{CL},
{_conf('CAST(0.5 AS DOUBLE)')}
SELECT tn, fp, fn, tp FROM conf"""
    q["a12_classification_metrics"] = f"""{BASE},
{CL},
{_conf('CAST(0.5 AS DOUBLE)')}
SELECT tn, fp, fn, tp, {_rates()} FROM conf"""
    q["a13_threshold_metrics"] = _a13()
    q["a14_roc_auc"] = f"{BASE},\n{CL},\n" + _auc("cl", "prob", "label")
    q["a14_roc_auc_sensor"] = f"WITH {TE},\n{LAB},\nlb AS (SELECT sensor_2, CAST(rul <= 30 AS INTEGER) AS y FROM lab),\n" + _auc("lb", "sensor_2", "y")
    q["a15_paired_t"] = f"""{BASE},
{FP},
{ER}
SELECT count(d) AS n, {R('avg(d)')} AS mean_diff, {R('stddev_samp(d)')} AS sd_diff,
       {R('avg(d) / (stddev_samp(d) / sqrt(count(d)))')} AS t, count(d) - 1 AS dof FROM er"""
    q["a16_wilcoxon"] = _a16()
    q["a17_mean_diff"] = f"{BASE},\n{FP},\n{ER}\nSELECT {R('avg(d)')} AS mean_diff FROM er"
    q["a18_bootstrap_means"] = _boot_means() + f"\nSELECT rep, {R('mean')} AS mean FROM bm"
    q["a19_bootstrap_ci"] = _boot_means() + (
        f"\nSELECT {R('quantile_cont(mean, 0.025)')} AS ci_lower, {R('quantile_cont(mean, 0.975)')} AS ci_upper FROM bm")
    q["w1_rolling_features"] = f"WITH {TE}\n" + te_rolled.format(cols=rolled_cols(EV))
    q["w3_latest_per_unit"] = f"""WITH {TE}
SELECT unit, cycle, sensor_1, sensor_2, sensor_3 FROM (
  SELECT *, row_number() OVER (PARTITION BY unit ORDER BY cycle DESC) AS rd FROM te) WHERE rd = 1"""
    q["w4_last_k"] = f"""WITH {TE}
SELECT unit, cycle, sensor_1, sensor_2, sensor_3 FROM (
  SELECT *, row_number() OVER (PARTITION BY unit ORDER BY cycle DESC) AS rd FROM te) WHERE rd <= 5"""
    q["w5_current_state"] = f"""WITH {TE},
rl AS (SELECT {EV_COLS}, {rolled_cols(EV)}, row_number() OVER (PARTITION BY unit ORDER BY cycle DESC) AS rd
       FROM te WINDOW w AS {W5})
SELECT unit, cycle, sensor_1, sensor_2, sensor_3, {", ".join(c for s in EV for c in (f"{s}_rollmean", f"{s}_rollstd"))}
FROM rl WHERE rd = 1"""
    q["w6_sequences"] = _w6_long(pad=False)
    q["w7_sequences_pad"] = _w6_long(pad=True)
    q["w8_sequence_ids"] = f"WITH {TE},\n{TP}\nSELECT unit, cycle, rul FROM tpl WHERE idx >= 30"
    q["m6_window_summaries"] = _m6_summaries()
    q["u1_union_fleet"] = f"""WITH {TF},
{TE},
{TP}
SELECT dataset, unit, cycle, sensor_1, sensor_2, sensor_3 FROM tf
UNION ALL
SELECT 'parts', unit, cycle, NULL, sensor_2, sensor_3 FROM tpl"""
    q["u2_split_overlap"] = f"""{BASE}
SELECT count(*) AS n_overlap FROM (SELECT unit FROM tr INTERSECT SELECT unit FROM va)"""
    q["d1_split_by_unit"] = f"WITH {TE},\n{split_cte('ut', 'te', 0.2)}\nSELECT unit, split FROM ut"
    q["d1_split_hash"] = f"""WITH {TE}
SELECT unit, CASE WHEN {unit_hash(['unit'], 15)} < {int(0.2 * 2**60)} THEN 'validation' ELSE 'train' END AS split
FROM (SELECT DISTINCT unit FROM te)"""
    q["d2_early_stop_split"] = f"{BASE},\n{split_cte('es', 'tr', 0.15)}\nSELECT unit, split FROM es"
    q["m5_request_features"] = _request_features()
    q["m4_scored_units"] = f"WITH {TF}\nSELECT dataset, unit, max(cycle) AS cycle, true AS is_scored FROM tf GROUP BY ALL"
    q["m5_scored_requests"] = f"""WITH {TE},
{_request_rows()}
SELECT CAST(unit AS VARCHAR) AS request_id, CAST(count(*) AS INTEGER) AS cycles_used, CAST(NULL AS VARCHAR) AS error, true AS is_scored
FROM rq GROUP BY unit"""
    q["m8_keyed_predictions"] = f"{BASE}\nSELECT unit, cycle, true AS is_scored FROM va"
    q["s2_read_fleet"] = f"""WITH {TF}
SELECT dataset, unit, cycle, sensor_2, sensor_3, concat_ws('_', dataset, CAST(unit AS VARCHAR)) AS fleet_unit FROM tf"""
    q["s3_s5_split_csv"] = f"{BASE}\nSELECT unit, cycle, rul, sensor_2, sensor_3 FROM va"
    q["s4_s6_predictions"] = f"{BASE},\n{FP}\nSELECT unit, cycle, {R('pred_a')} AS prediction FROM fp"
    q["s7_scores"] = f"WITH {TF}\nSELECT dataset, unit, max(cycle) AS cycle, max_by(sensor_2, cycle) AS predicted_rul FROM tf GROUP BY dataset, unit"
    q["s10_scaler_table"] = _a8()
    q["m5_stream_scores"] = q["m5_scored_requests"]
    q["m1_compiled_predictions"] = f"{BASE}\nSELECT unit, cycle, true AS same FROM va"
    q["m2_compiled_probabilities"] = q["m1_compiled_predictions"]
    feats = [*EV, *[f"{s}_rollmean" for s in EV], *[f"{s}_rollstd" for s in EV]]
    q["a21_importance_check"] = "SELECT * FROM (VALUES " + ", ".join(f"('{f}', true)" for f in feats) + ") t(feature, same)"
    q["o2_top_order"] = "SELECT * FROM (VALUES (1, true), (2, true), (3, true), (4, true), (5, true)) t(rank, same)"
    q["s11_fingerprint"] = "SELECT * FROM (VALUES ('own scaler', true), ('another scaler', false)) t(scaler, loaded)"
    q["s9_build_requests"] = _s9()
    q["a16_wilcoxon_exact"] = _a16_exact()
    q["m6_kernel_features"] = _m6_kernels()
    q["a20_statistics"] = f"""{_boot_means()},
ci AS (SELECT quantile_cont(mean, 0.025) AS lo, quantile_cont(mean, 0.975) AS hi FROM bm),
tt AS (SELECT avg(err_a) AS mae_a, avg(err_b) AS mae_b, count(*) AS n_rows, avg(d) AS m, count(d) AS k, stddev_samp(d) AS s FROM er),
wx AS ({_a16_tail()})
SELECT {R('mae_a')} AS mae_a, {R('mae_b')} AS mae_b, n_rows, {R('m')} AS mean_diff, {R('m / (s / sqrt(k))')} AS t, k - 1 AS dof,
       w AS wilcoxon_w, z AS wilcoxon_z, {R('lo')} AS ci_lower, {R('hi')} AS ci_upper,
       CASE WHEN m < 0 THEN 'a' WHEN m > 0 THEN 'b' ELSE 'tie' END AS winner
FROM tt, wx, ci"""
    return q
