"""SQL that computes each registered query from the same tables, written for DuckDB.

`u(...)` repeats the keyed uniforms; numbers are rounded as in the queries.
"""

from __future__ import annotations

import math

from .fixtures import (
    CAPPED, CHECKPOINTS, DOMAIN_A, DOMAIN_B, DUMP, GRID, LINES, LOG, NUMERIC, PARTS, TRAIN, tiny_bias, tiny_weight,
)

K = "o_orderkey"
NBOOT = 19


def r(expr: str, name: str | None = None, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0::DOUBLE AS {name or expr}"


def _digest(seed, stream: str, keys) -> str:
    return f"md5(concat_ws('|', '{seed}', {stream}, {', '.join(str(k) for k in keys)}))"


def _word(digest: str, at: int) -> str:
    return f"((('0x' || substr({digest}, {at}, 13))::BIGINT)::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE"


def u(seed, stream: str, *keys) -> str:
    """`stream` is a SQL text expression."""
    return f"({_word(_digest(seed, stream, keys), 1)})"


def z(seed, number: int, *keys) -> str:
    d = _digest(seed, f"'noise:{number // 2}'", keys)
    turn = "cos" if number % 2 == 0 else "sin"
    return f"(sqrt(-2.0::DOUBLE * ln({_word(d, 1)})) * {turn}({2.0 * math.pi!r}::DOUBLE * ({_word(d, 14)})))"


def lit(v: float) -> str:
    return f"({v!r}::DOUBLE)"


def forward(source: str, first_layer: int, inputs: list[str], outputs: list[str], shift: str = "0.0::DOUBLE", tag: str = "h") -> str:
    """`source` plus the outputs of the small net: inputs -> 3 (relu) -> outputs."""
    hidden = [
        f"greatest({' + '.join(f'{c} * {lit(tiny_weight(first_layer, i, j))}' for i, c in enumerate(inputs))} + {lit(tiny_bias(j))}, 0.0::DOUBLE) AS {tag}{j}"
        for j in range(3)
    ]
    out = [
        f"{' + '.join(f'{tag}{i} * {lit(tiny_weight(first_layer + 1, i, j))}' for i in range(3))} + {lit(tiny_bias(j))} + {shift} AS {o}"
        for j, o in enumerate(outputs)
    ]
    return f"SELECT *, {', '.join(out)} FROM (SELECT *, {', '.join(hidden)} FROM ({source}))"


ORACLE: dict[str, str] = {}

# ---- sources -------------------------------------------------------------------------------

ORACLE["read_typed_table"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority, o_totalprice,
  CAST(o_custkey AS DOUBLE) AS o_custkey FROM orders"""
ORACLE["read_columns"] = "SELECT l_quantity, l_extendedprice FROM lineitem"
ORACLE["draw_minibatches"] = f"""
WITH placed AS (SELECT {K}, row_number() OVER (ORDER BY {K}) - 1 AS rn FROM orders),
chunked AS (SELECT {K}, rn // 5000 AS chunk, rn % 5000 AS pos FROM placed),
chunks AS (SELECT chunk, count(*) AS n FROM chunked GROUP BY chunk HAVING count(*) >= 500),
draws AS (SELECT chunk, n, 1 AS pass, unnest(range(1, 2 * (n // 500) + 1)) AS draw,
  CASE WHEN n >= 2000 THEN 1064 ELSE 3064 END AS tries FROM chunks),
tried AS (SELECT *, unnest(range(0, tries + 500)) AS j FROM draws),
proposals AS (SELECT chunk, pass, draw, j, CASE WHEN j < tries
    THEN floor({u(7, "'batch'", 'chunk', 'pass', 'draw', 'j')} * n)
    ELSE (floor({u(7, "'batch'", 'chunk', 'pass', 'draw', "'run'")} * n)::BIGINT + j - tries) % n END::BIGINT AS pos FROM tried),
firsts AS (SELECT chunk, pass, draw, pos, min(j) AS j FROM proposals GROUP BY ALL),
slots AS (SELECT *, row_number() OVER (PARTITION BY chunk, pass, draw ORDER BY j) AS slot FROM firsts)
SELECT pass, chunk, draw, slot, {K} FROM slots JOIN chunked USING (chunk, pos) WHERE slot <= 500"""
ORACLE["sample_rows"] = f"SELECT {K}, o_totalprice FROM orders ORDER BY {u(11, chr(39) + 'sample' + chr(39), K)}, {K} LIMIT 512"
ORACLE["perturb_rows"] = f"""
WITH t AS (SELECT g.*, o_orderstatus FROM ({GRID}) g JOIN orders USING ({K})),
s AS (SELECT o_orderstatus, stddev_pop(v) AS s FROM
  (SELECT o_orderstatus, n1 AS v FROM t UNION ALL SELECT o_orderstatus, n2 FROM t) GROUP BY o_orderstatus)
SELECT {K}, o_orderstatus,
  {r(f"n1 + 0.5 * s * {u(3, chr(39) + 'perturb:n1' + chr(39), K, 'o_orderstatus')}", 'n1')},
  {r(f"n2 + 0.5 * s * {u(3, chr(39) + 'perturb:n2' + chr(39), K, 'o_orderstatus')}", 'n2')}
FROM t JOIN s USING (o_orderstatus)"""
ORACLE["write_shuffled"] = f"""
SELECT {K}, row_number() OVER (ORDER BY {u(5, chr(39) + 'shuffle' + chr(39), K)}, {K}) AS pos FROM orders"""
ORACLE["restore_layout"] = f"""
SELECT 200000000 + row_number() OVER (ORDER BY {K}) - 1 AS unq1, price, status, target FROM ({TRAIN})"""
_PARSED = rf"""
SELECT CAST(nullif(regexp_extract(value, 'Iter:\s(.*?);', 1), '') AS BIGINT) AS iter,
  CAST(nullif(regexp_extract(value, 'G loss:\s(.*?);', 1), '') AS DOUBLE) AS G_loss,
  CAST(nullif(regexp_extract(value, 'D loss:\s(.*?);', 1), '') AS DOUBLE) AS D_loss,
  CAST(nullif(regexp_extract(value, 'similarity:\s(.*?)$', 1), '') AS DOUBLE) AS similarity
FROM ({LOG})"""
# the last loss of a line without similarity is followed by the penalty, as in the log itself
ORACLE["parse_training_log"] = _PARSED
_BEST = rf"""
SELECT l.* FROM ({_PARSED}) l JOIN
  (SELECT CAST(regexp_extract(path, 'check_point_([0-9]+)\.ckpt\.meta$', 1) AS BIGINT) AS iter FROM ({CHECKPOINTS})
   WHERE regexp_extract(path, 'check_point_([0-9]+)\.ckpt\.meta$', 1) <> '') c USING (iter)
ORDER BY similarity NULLS LAST, iter LIMIT 1"""
ORACLE["best_checkpoint"] = _BEST
ORACLE["loss_trace"] = f"""
SELECT {K} // 100 AS block, {r('avg(o_totalprice / 1e6)', 'G_loss', 11)}, {r('avg(o_custkey / 1e3)', 'D_loss', 11)}
FROM orders GROUP BY {K} // 100"""

# ---- categorical ---------------------------------------------------------------------------

_LONG = f"""
SELECT {K}, 'status' AS col, status AS value FROM ({TRAIN})
UNION ALL SELECT {K}, 'segment', coalesce(segment, 'null') FROM ({TRAIN})
UNION ALL SELECT {K}, 'flag01', flag01 FROM ({TRAIN})"""
ORACLE["onehot_fit"] = f"""
WITH seen AS (SELECT col, value, min({K}) AS first FROM ({_LONG}) GROUP BY col, value),
kinds AS (SELECT col, bool_and(value IN ('0', '1')) AS flag FROM seen GROUP BY col)
SELECT col, (row_number() OVER (PARTITION BY col ORDER BY first) - 1)::INT AS pos, value,
  CASE WHEN flag THEN 'indicator' ELSE 'categorical' END AS type
FROM seen JOIN kinds USING (col)"""
_VOCABULARY = """
WITH long AS (SELECT l_orderkey, 'l_partkey' AS col, l_partkey::VARCHAR AS value FROM lineitem
  UNION ALL SELECT l_orderkey, 'l_suppkey', l_suppkey::VARCHAR FROM lineitem),
seen AS (SELECT col, value, min(l_orderkey) AS first, count(*) AS n FROM long GROUP BY col, value),
v AS (SELECT col, value, row_number() OVER (PARTITION BY col ORDER BY first, value) - 1 AS position, n FROM seen)"""
ORACLE["onehot_vocabulary"] = f"{_VOCABULARY} SELECT * FROM v"
ORACLE["onehot_index"] = f"""{_VOCABULARY}
SELECT l_orderkey, l_linenumber, p.position AS l_partkey_index, s.position AS l_suppkey_index FROM lineitem
JOIN v p ON p.col = 'l_partkey' AND p.value = l_partkey::VARCHAR JOIN v s ON s.col = 'l_suppkey' AND s.value = l_suppkey::VARCHAR"""
ORACLE["onehot_index_back"] = """
SELECT l_orderkey, l_linenumber, l_partkey::VARCHAR AS l_partkey, l_suppkey::VARCHAR AS l_suppkey FROM lineitem"""
_STATUS = ["F", "O", "P"]
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "null"]


def _onehot(segment: str) -> str:
    cols = [f"CASE WHEN status = '{v}' THEN 0.5 ELSE -0.5 END::DOUBLE AS \"status_{v}\"" for v in _STATUS]
    cols += [f"CASE WHEN coalesce({segment}, 'null') = '{v}' THEN 0.5 ELSE -0.5 END::DOUBLE AS \"segment_{v}\"" for v in _SEGMENTS]
    return f"CAST(flag01 AS DOUBLE) - 0.5::DOUBLE AS flag01, {', '.join(cols)}"


_OTHER = "CASE WHEN segment = 'BUILDING' THEN 'OTHER' ELSE segment END"
ORACLE["onehot_fit_transform"] = f"SELECT {K}, {_onehot('segment')} FROM ({TRAIN})"
ORACLE["onehot_transform"] = f"SELECT {K}, {_onehot(_OTHER)} FROM ({TRAIN})"
ORACLE["onehot_back"] = f"""
SELECT {K}, CAST(flag01 AS DOUBLE) - 0.5::DOUBLE AS flag01, status, coalesce(segment, '') AS segment FROM ({TRAIN})"""


def _likelihoods(col: str) -> str:
    return f"""SELECT {col} AS value, sum(target) AS s, count(*) AS c,
      (sum(target) + 30.0 * (SELECT avg(target) FROM t)) / (count(*) + 30.0) AS m FROM t WHERE {col} IS NOT NULL GROUP BY {col}"""


ORACLE["laplace_fit"] = f"""
WITH t AS ({TRAIN}), l AS (SELECT 'status' AS col, * FROM ({_likelihoods('status')})
  UNION ALL SELECT 'segment', * FROM ({_likelihoods('segment')}))
SELECT col, value, {r('s', 'sum')}, c AS count, {r('m', 'smoothed_mean')},
  {r('(SELECT avg(target) FROM t)', 'global_avg')} FROM l"""


def _likelihood_join(segment: str, names: tuple[str, str], keep: str) -> str:
    return f"""
WITH t AS ({TRAIN}), a AS ({_likelihoods('status')}), b AS ({_likelihoods('segment')}), v AS (SELECT *, {segment} AS seg FROM t)
SELECT {K}, target, {keep} {r('coalesce(a.m, (SELECT avg(target) FROM t))', names[0])},
  {r('coalesce(b.m, (SELECT avg(target) FROM t))', names[1])}
FROM v LEFT JOIN a ON v.status = a.value LEFT JOIN b ON v.seg = b.value"""


ORACLE["laplace_fit_transform"] = _likelihood_join("segment", ("status", "segment"), "")
ORACLE["laplace_transform"] = _likelihood_join(_OTHER, ("status_likeli", "segment_likeli"), "status, seg AS segment,")
ORACLE["center_target"] = f"SELECT {K}, target - 0.5 AS target FROM ({TRAIN})"
ORACLE["uncenter_target"] = f"SELECT {K}, trunc(price / 250000.0 - 1.0 + 0.5)::INT AS target FROM ({TRAIN})"

# ---- missing and special values --------------------------------------------------------------


def _flag(cond: str, name: str) -> str:
    return f"CASE WHEN {cond} THEN -0.5 ELSE 0.5 END::DOUBLE AS {name}"


_NUM = ", ".join(NUMERIC)
_NUM_NO_BAL = ", ".join(c for c in NUMERIC if c != "bal")
ORACLE["missing_fit_transform"] = f"SELECT {K}, {_NUM}, {_flag('bal IS NULL', 'bal_missing')} FROM ({TRAIN})"
ORACLE["missing_transform"] = f"""
SELECT *, {_flag('bal IS NULL', 'bal_missing')} FROM
  (SELECT {K}, {_NUM_NO_BAL}, CASE WHEN price > 250000 THEN bal END AS bal FROM ({TRAIN}))"""


def _rank(flag: str) -> str:
    return f"row_number() OVER (ORDER BY {u(17, chr(39) + flag + chr(39), K)} - 0.5, {K})"


ORACLE["missing_back"] = f"""
WITH t AS ({TRAIN}), k AS (SELECT round_even(count(*) FILTER (bal IS NULL)::DOUBLE / count(*) * count(*), 0) AS k FROM t)
SELECT {K}, CASE WHEN {_rank('bal_missing')} > k THEN coalesce(bal, 0.0) END AS bal FROM t, k"""
ORACLE["special_fit_transform"] = f"""
SELECT {K}, price, bal, rare_null, nullif(spike, 0) AS spike, few, const,
  {_flag('bal IS NULL', 'bal_missing')}, {_flag('spike = 0', 'spike_highfreq')} FROM ({TRAIN})"""
ORACLE["special_transform"] = f"""
SELECT {K}, price, bal, rare_null, nullif(s, 0) AS spike, few, const,
  {_flag('bal IS NULL', 'bal_missing')}, {_flag('s = 0', 'spike_highfreq')}
FROM (SELECT *, CASE WHEN price > 250000 THEN spike ELSE 0.0 END AS s FROM ({TRAIN}))"""
ORACLE["special_back"] = f"""
WITH t AS ({TRAIN}), k AS (SELECT count(*) AS n, count(*) FILTER (bal IS NULL)::DOUBLE / count(*) AS miss,
  count(*) FILTER (spike = 0)::DOUBLE / count(*) AS freq FROM t)
SELECT {K}, CASE WHEN {_rank('spike_highfreq')} <= round_even(freq * (n - 0.0), 0) THEN 0.0 ELSE price END AS spike,
  CASE WHEN {_rank('bal_missing')} > round_even(miss * n, 0) THEN price END AS bal FROM t, k"""
ORACLE["impute_median"] = f"""
SELECT {K}, {r('coalesce(bal, (SELECT quantile_cont(bal::DOUBLE, 0.5) FROM t))', 'bal')},
  {r('coalesce(rare_null, (SELECT quantile_cont(rare_null::DOUBLE, 0.5) FROM t))', 'rare_null')}
FROM t""".replace("\nSELECT", f"\nWITH t AS ({TRAIN}) SELECT", 1)
ORACLE["impute_zero"] = f"SELECT {K}, coalesce(bal, 0.0) AS bal, coalesce(rare_null, 0.0) AS rare_null FROM ({TRAIN})"


def _drawn(c: str) -> str:
    return f"""o_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY {K}) - 1 AS no FROM t WHERE {c} IS NOT NULL),
w_{c} AS (SELECT {K}, floor({u(13, chr(39) + c + chr(39), K)} * (SELECT count(*) FROM o_{c}))::BIGINT AS no FROM t WHERE {c} IS NULL),
f_{c} AS (SELECT {K}, v FROM w_{c} JOIN o_{c} USING (no))"""


ORACLE["impute_random"] = f"""
WITH t AS ({TRAIN}), {_drawn('bal')}, {_drawn('rare_null')}
SELECT t.{K}, coalesce(t.bal, f_bal.v) AS bal, coalesce(t.rare_null, f_rare_null.v) AS rare_null
FROM t LEFT JOIN f_bal USING ({K}) LEFT JOIN f_rare_null USING ({K})"""

# ---- numeric transforms ----------------------------------------------------------------------

BOXCOX_COLS = ["price", "bal", "rare_null"]


def lambdas(source: str, cols: list[str]) -> str:
    """CTEs s_<col> (low, high, med, std, shift) and l_<col> (lam) over a CTE `source`."""
    parts = []
    for c in cols:
        parts.append(
            f"""s_{c} AS (SELECT min({c}) AS low, max({c}) AS high, quantile_cont({c}::DOUBLE, 0.5) AS med, stddev_samp({c}) AS std,
  CASE WHEN min({c}) <= 0 THEN 1.0 - min({c}) ELSE 0.0 END::DOUBLE AS shift FROM {source}),
g_{c} AS (SELECT ln({c} + shift) - (SELECT avg(ln({c} + shift)) FROM {source}, s_{c}) AS g FROM {source}, s_{c} WHERE {c} IS NOT NULL),
l_{c} AS (SELECT lam FROM (SELECT lam, var_pop(CASE WHEN lam = 0 THEN g ELSE (exp(lam * g) - 1.0) / lam END) AS v FROM g_{c},
  (SELECT unnest(range(-200, 201)) / 100.0::DOUBLE AS lam) GROUP BY lam) ORDER BY v, lam LIMIT 1)"""
        )
    return ",\n".join(parts)


def power(x: str, c: str) -> str:
    shifted = f"({x} + s_{c}.shift)"
    return f"""CASE WHEN {shifted} > 0 THEN CASE WHEN l_{c}.lam = 0 THEN ln(greatest({shifted}, 1e-300))
      ELSE (pow(greatest({shifted}, 1e-300), l_{c}.lam) - 1.0) / nullif(l_{c}.lam, 0) END END"""


def inverse(x: str, c: str) -> str:
    """Clipped to the fitted range, NULL where the base is negative and the exponent fractional."""
    base = f"({x} * l_{c}.lam + 1.0)"
    raw = f"CASE WHEN l_{c}.lam = 0 THEN exp({x}) WHEN {base} > 0 THEN pow(greatest({base}, 1e-300), 1.0 / nullif(l_{c}.lam, 0)) WHEN {base} = 0 THEN 0.0 END - s_{c}.shift"
    return f"CASE WHEN ({raw}) IS NOT NULL THEN least(greatest({raw}, s_{c}.low), s_{c}.high) END"


_FROM = "t, " + ", ".join(f"s_{c}, l_{c}" for c in BOXCOX_COLS)
_FITTED = f"WITH t AS ({TRAIN}), {lambdas('t', BOXCOX_COLS)}"
_DIGITS = {"price": 2}
ORACLE["boxcox_fit"] = (
    _FITTED
    + " UNION ALL ".join(
        f"\nSELECT '{c}' AS col, {r('med', 'median', 5)}, {r('low', 'min', 5)}, {r('high', 'max', 5)}, {r('std', 'std', 5)}, {r('shift', 'shift', 5)}, {r('lam', 'lambd', 5)} FROM s_{c}, l_{c}"
        for c in BOXCOX_COLS
    )
    + "\nUNION ALL SELECT 'const', 1.0, 1.0, 1.0, 0.0, 0.0, NULL"
)
ORACLE["boxcox_fit_transform"] = f"""{_FITTED}
SELECT {K}, {', '.join(r(power(c, c), c, _DIGITS.get(c, 4)) for c in BOXCOX_COLS)}, const FROM {_FROM}"""
ORACLE["boxcox_transform"] = f"""{_FITTED}
SELECT {K}, {', '.join(r(power(f'({c} - 1000.0)', c), c, _DIGITS.get(c, 4)) for c in BOXCOX_COLS)} FROM {_FROM}"""
ORACLE["boxcox_back"] = f"""{_FITTED}
SELECT {K}, {', '.join(r(inverse(f'(({power(c, c)}) * 1.25::DOUBLE)', c), c, _DIGITS.get(c, 5)) for c in BOXCOX_COLS)}, 1.25::DOUBLE AS const FROM {_FROM}"""


def _histogram(c: str, kind: str, value: str) -> str:
    return f"""SELECT '{c}' AS col, '{kind}' AS kind, greatest(least(floor((v - lo) / (hi - lo) * 30.0), 29), 0)::INT AS bin, count(*) AS n FROM
  (SELECT v, min(v) OVER () AS lo, max(v) OVER () AS hi FROM (SELECT {value} AS v FROM {_FROM}) WHERE v IS NOT NULL) GROUP BY ALL"""


ORACLE["boxcox_hist"] = _FITTED + "\n" + "\nUNION ALL ".join(
    _histogram(c, kind, value)
    for c in BOXCOX_COLS
    for kind, value in (("original", c), ("log", f"ln({c} + s_{c}.shift)"), ("boxcox", power(c, c)))
)

SCALE_COLS = ["price", "bal", "rare_null", "few", "const"]


def scale_stats(source: str, cols: list[str]) -> str:
    return ",\n".join(
        f"""z_{c} AS (SELECT avg({c}) AS mean, CASE WHEN min({c}) = max({c}) THEN 0.0 ELSE stddev_samp({c}) END AS std, max({c}) AS high,
  min({c}) AS low, quantile_cont({c}::DOUBLE, 0.5) AS med, CASE WHEN min({c}) = max({c}) THEN 'constant'
  WHEN (max({c}) - avg({c})) / nullif(stddev_samp({c}), 0) > 5 OR (min({c}) - avg({c})) / nullif(stddev_samp({c}), 0) < -5 THEN 'minmax'
  ELSE 'normal' END AS kind FROM {source})"""
        for c in cols
    )


def scaled(x: str, c: str) -> str:
    return f"""CASE z_{c}.kind WHEN 'constant' THEN 0.0 WHEN 'minmax' THEN (2.0 * {x} - (z_{c}.high + z_{c}.low)) / (z_{c}.high - z_{c}.low)
      ELSE ({x} - z_{c}.mean) / z_{c}.std END"""


def _scale_row(c: str) -> str:
    nums = ", ".join(r(a, b, 5) for a, b in (("med", "median"), ("mean", "mean"), ("std", "std"), ("high", "max"), ("low", "min")))
    return f"SELECT '{c}' AS col, kind AS scaling_type, {nums} FROM z_{c}"


ORACLE["scaler_fit"] = f"WITH t AS ({TRAIN}), e AS (SELECT value FROM events), {scale_stats('t', SCALE_COLS)}, {scale_stats('e', ['value'])}\n" + "\nUNION ALL ".join(
    _scale_row(c) for c in [*SCALE_COLS, "value"]
)
ORACLE["scaler_fit_transform"] = f"""WITH t AS ({TRAIN}), {scale_stats('t', SCALE_COLS)}
SELECT {K}, {', '.join(r(scaled(c, c), c) for c in SCALE_COLS)} FROM t, {', '.join(f'z_{c}' for c in SCALE_COLS)}"""
ORACLE["scaler_transform"] = f"""WITH e AS (SELECT event_id, value FROM events), {scale_stats('e', ['value'])}
SELECT event_id, {r(scaled('(value * 2.0)', 'value'), 'value')} FROM e, z_value"""
ORACLE["scaler_back"] = f"SELECT {K}, {', '.join(r(c) for c in SCALE_COLS)} FROM ({TRAIN})"

_SPLITS = rf"""
d AS ({DUMP}),
x AS (SELECT unnest(regexp_extract_all(value, '\[f([0-9]+)<([-+]?[0-9]*\.?[0-9]+)\]', 1)) AS f,
  unnest(regexp_extract_all(value, '\[f([0-9]+)<([-+]?[0-9]*\.?[0-9]+)\]', 2)) AS t FROM d),
cap AS (SELECT CASE f WHEN '0' THEN 'price' WHEN '1' THEN 'bal' WHEN '2' THEN 'rare_null' ELSE 'flag' END AS col,
  min(t::DOUBLE) AS lo, max(t::DOUBLE) AS hi FROM x GROUP BY 1)"""


def _capped(c: str) -> str:
    lo, hi = f"(SELECT lo FROM cap WHERE col = '{c}')", f"(SELECT hi FROM cap WHERE col = '{c}')"
    if c == "flag":
        return f"sign({c} - {lo})::DOUBLE"
    x = f"((2.0 * {c} - ({hi} + {lo})) / ({hi} - {lo}))"
    return f"CASE WHEN {x} > 1 THEN 2.0 WHEN {x} < -1 THEN -2.0 ELSE {x} END"


def _uncapped(c: str) -> str:
    lo, hi = f"(SELECT lo FROM cap WHERE col = '{c}')", f"(SELECT hi FROM cap WHERE col = '{c}')"
    if c == "flag":
        return f"{c} + {lo}"
    return f"0.5 * ({c} * ({hi} - {lo}) + ({hi} + {lo}))"


_CAP_COLS = ["price", "bal", "rare_null", "flag"]
ORACLE["splitcap_fit"] = f"WITH {_SPLITS} SELECT col, {r('lo', 'min_split')}, {r('hi', 'max_split')} FROM cap"
ORACLE["splitcap_fit_transform"] = f"WITH {_SPLITS} SELECT {K}, {', '.join(r(_capped(c), c) for c in _CAP_COLS)} FROM ({CAPPED})"
ORACLE["splitcap_transform"] = f"""WITH {_SPLITS}
SELECT {K}, {r('price')}, {r('bal')}, {r(_capped('rare_null'), 'rare_null')}, {r(_capped('flag'), 'flag')} FROM ({CAPPED})"""
ORACLE["splitcap_back"] = f"""WITH {_SPLITS}, c AS (SELECT {K}, {', '.join(f'{_capped(c)} AS {c}' for c in _CAP_COLS)} FROM ({CAPPED}))
SELECT {K}, {', '.join(r(_uncapped(c), c, 4) for c in _CAP_COLS)} FROM c"""

# ---- generation ------------------------------------------------------------------------------

_IN = ["z0", "z1", "g1", "g2"]


def _noised(source: str, seed: int, key: str) -> str:
    return f"SELECT *, {z(seed, 0, key)} AS z0, {z(seed, 1, key)} AS z1 FROM ({source})"


def _made(conditions: str, seed: int, shift: str = "0.0::DOUBLE") -> str:
    """(id, g1, g2) to generated n1, n2."""
    return forward(_noised(conditions, seed, "id"), 1, _IN, ["n1", "n2"], shift)


_ROWS = "(SELECT count(*) FROM orders)"
_OUT4 = f"id, {r('n1')}, {r('n2')}, {r('g1')}, {r('g2')}"


def _repeated(rows: str, g1: str = "g1") -> str:
    return f"""SELECT i.id, {g1} AS g1, g2 FROM (SELECT unnest(range({rows})) AS id) i
      JOIN (SELECT *, row_number() OVER (ORDER BY {K}) - 1 AS no FROM ({GRID})) c ON i.id % {_ROWS} = c.no"""


ORACLE["sample_noise"] = f"SELECT {K}, {', '.join(r(z(2, j, K), f'z{j}') for j in range(3))} FROM orders"
ORACLE["dense_forward"] = f"SELECT {K}, {r('o1')}, {r('o2')} FROM ({forward(GRID, 1, ['n1', 'n2', 'g1', 'g2'], ['o1', 'o2'])})"
ORACLE["generate_unconditional"] = f"""
WITH m AS (SELECT avg(n1) AS c1, avg(n2) AS c2, var_pop(n1) AS a, var_pop(n2) AS b, covar_pop(n1, n2) AS k FROM ({GRID})),
s AS (SELECT *, sqrt(a * b - k * k) AS s, sqrt(a + b + 2.0 * sqrt(a * b - k * k)) AS t FROM m)
SELECT id, {r('c1 + (z0 * (a + s) + z1 * k) / t', 'n1')}, {r('c2 + (z0 * k + z1 * (b + s)) / t', 'n2')}
FROM ({_noised(f'SELECT unnest(range({_ROWS})) AS id', 21, 'id')}), s"""
ORACLE["generate_conditional"] = f"SELECT {_OUT4} FROM ({_made(_repeated(f'2 * {_ROWS} + 7'), 22)})"
ORACLE["generate_pinned"] = f"SELECT {_OUT4} FROM ({_made(_repeated(f'{_ROWS} + 7', f'(SELECT max(g1) FROM ({GRID}))'), 23)})"
_UNIFORM = f"""
SELECT i.id, g1, g2 FROM (SELECT id, floor({u(24, "'condition'", 'id')} * (SELECT count(*) FROM (SELECT DISTINCT g1, g2 FROM ({GRID}))))::BIGINT AS no
   FROM (SELECT unnest(range({_ROWS})) AS id)) i
  JOIN (SELECT g1, g2, row_number() OVER (ORDER BY g1, g2) - 1 AS no FROM (SELECT DISTINCT g1, g2 FROM ({GRID}))) c USING (no)"""
ORACLE["generate_uniform"] = f"SELECT {_OUT4} FROM ({_made(_UNIFORM, 24)})"
ORACLE["translate_a_to_b"] = f"""
SELECT {K}, {r('b1')}, {r('b2')} FROM ({forward(GRID, 5, ['n1', 'n2'], ['b1', 'b2'])})
QUALIFY row_number() OVER (ORDER BY {K}) <= 5000 * ceil({_ROWS} / 5000.0)"""
_RECON = forward(_noised(f"SELECT {K}, n1, n2, g1, g1 + 0.5 AS lift_ind, (SELECT min(g2) FROM ({GRID})) AS g2 FROM ({GRID})", 25, K), 1, _IN, ["y1", "y2"])
ORACLE["reconstruction_error"] = f"SELECT {K}, {r('lift_ind')}, {r('abs(n1 - y1) + abs(n2 - y2)', 'error')} FROM ({_RECON})"
_SCORED = forward(
    f"""SELECT {K}, 1 AS label, n1, n2, g1, g2 FROM ({GRID})
    UNION ALL SELECT id, 0, n1, n2, g1, g2 FROM ({_made(_repeated(_ROWS), 26)})""",
    3, ["n1", "n2", "g1", "g2"], ["score"], tag="k",
)
ORACLE["score_realness"] = f"SELECT {K}, label, {r('score')} FROM ({_SCORED})"
# rank form of the AUC: tied scores share their average rank
_AUC = """SELECT (sum(CASE WHEN pos = 1 THEN rk END) - p * (p + 1) / 2.0) / (p * n) AS auc FROM
  (SELECT pos, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk,
    (sum(pos) OVER ())::DOUBLE AS p, (count(*) OVER () - sum(pos) OVER ())::DOUBLE AS n FROM ({source})) GROUP BY p, n"""
ORACLE["realness_auc"] = f"SELECT {r('auc')} FROM ({_AUC.format(source=f'SELECT label AS pos, score AS s FROM ({_SCORED})')})"


def _softplus(x: str) -> str:
    return f"(greatest({x}, 0.0) + ln(1.0 + exp(-abs({x}))))"


def _loss(disc: str, gen: str) -> str:
    return f"SELECT {r(disc, 'disc_loss')}, {r(gen, 'gen_loss')} FROM ({_SCORED})"


ORACLE["bce_loss"] = _loss(
    f"avg({_softplus('-score')}) FILTER (label = 1) + avg({_softplus('score')}) FILTER (label = 0)",
    f"avg({_softplus('-score')}) FILTER (label = 0)",
)
ORACLE["lsgan_loss"] = _loss(
    "(avg((score - 1) * (score - 1)) FILTER (label = 1) + avg(score * score) FILTER (label = 0)) / 2.0",
    "avg((score - 1) * (score - 1)) FILTER (label = 0)",
)
ORACLE["critic_gap"] = _loss("avg(score) FILTER (label = 0) - avg(score) FILTER (label = 1)", "-avg(score) FILTER (label = 0)")


def _gap(source: str, cols: list[str], *layers: int) -> str:
    """Mean |x - nets(x)| over all cells of `cols`."""
    names, text = cols, source
    for step, layer in enumerate(layers):
        out = [f"c{step}_{j}" for j in range(2)]
        text, names = forward(text, layer, names, out, tag=f"h{step}_"), out
    return f"(SELECT avg((abs({cols[0]} - {names[0]}) + abs({cols[1]} - {names[1]})) / 2.0) FROM ({text}))"


_A, _B = ["a1", "a2"], ["b1", "b2"]
_CYCLE = f"({_gap(DOMAIN_A, _A, 5, 7)} + {_gap(DOMAIN_B, _B, 7, 5)})"
_IDENTITY = f"({_gap(DOMAIN_A, _A, 7)} + {_gap(DOMAIN_B, _B, 5)})"
_ADVERSARIAL = f"(SELECT avg((score - 1) * (score - 1)) FROM ({forward(forward(DOMAIN_A, 5, _A, _B), 9, _B, ['score'], tag='k')}))"
ORACLE["cycle_error"] = f"SELECT {r(_CYCLE, 'cycle_error')}"
ORACLE["identity_error"] = f"SELECT {r(_IDENTITY, 'identity_error')}"
ORACLE["cycle_total"] = f"SELECT {r(f'{_ADVERSARIAL} + 10.0 * {_CYCLE} + {_IDENTITY}', 'cycle_total')}"
ORACLE["fit_generator"] = f"""
WITH m AS (SELECT regr_slope(n1, g1) AS b, regr_intercept(n1, g1) AS c, var_pop(n1) AS vx, var_pop(g1) AS vy FROM ({GRID}))
SELECT 'output' AS layer, -1 AS in_i, 0 AS out_j, {r('c', 'w')} FROM m
UNION ALL SELECT 'output', 0, 0, {r('sqrt(vx - b * b * vy)', 'w')} FROM m
UNION ALL SELECT 'output', 1, 0, {r('b', 'w')} FROM m"""

# ---- evaluation ------------------------------------------------------------------------------

_SCORES = f"""
SELECT {K}, target, price, price / 5e5::DOUBLE AS pred, floor(price / 5000.0) AS tied, 1.0 + target AS weight,
  coalesce(bal, 0.0) + 1000.0 AS truth FROM ({TRAIN})"""
ORACLE["jsd"] = f"""
WITH b AS (SELECT min(price) AS low, max(price) AS high FROM ({_SCORES})),
h AS (SELECT least(floor((price - low) / (high - low) * 50.0), 49) AS bin, count(*) FILTER (target = 1)::DOUBLE AS p,
  count(*) FILTER (target = 0)::DOUBLE AS q FROM ({_SCORES}), b GROUP BY 1),
s AS (SELECT p / sum(p) OVER () AS p, q / sum(q) OVER () AS q FROM h)
SELECT {r('0.5 * sum(CASE WHEN p > 0 THEN p * ln(2.0 * p / (p + q)) ELSE 0 END) + 0.5 * sum(CASE WHEN q > 0 THEN q * ln(2.0 * q / (p + q)) ELSE 0 END)', 'jsd')} FROM s"""
ORACLE["gini_binary"] = f"SELECT {r('100.0 * (2.0 * auc - 1.0)', 'gini')} FROM ({_AUC.format(source=f'SELECT target AS pos, tied AS s FROM ({_SCORES})')})"


def _lorenz(order: str) -> str:
    return f"""(SELECT sum(i / n - run / total) FROM (SELECT row_number() OVER (ORDER BY {order}) AS i, (count(*) OVER ())::DOUBLE AS n,
      sum(truth) OVER (ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS run, sum(truth) OVER () AS total FROM ({_SCORES})))"""


ORACLE["gini"] = f"SELECT {r(f'{_lorenz(f'tied DESC, {K}')} / {_lorenz(f'truth DESC, {K}')}', 'gini')}"
ORACLE["capture_rate"] = f"""
WITH w AS (SELECT target, row_number() OVER o AS no, sum(w) OVER (ORDER BY tied DESC, {K} ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER () AS total
  FROM (SELECT *, CASE WHEN target = 0 THEN 4.0 ELSE 1.0 END::DOUBLE AS w FROM ({_SCORES})) WINDOW o AS (ORDER BY tied DESC, {K})),
c AS (SELECT no AS cut FROM w ORDER BY abs(run - 0.05 * total), no LIMIT 1)
SELECT {r('100.0 * sum(target) FILTER (no < cut) / sum(target)', 'capture_rate')} FROM w, c"""
ORACLE["tree_importance"] = rf"""
SELECT CASE f WHEN '0' THEN 'price' WHEN '1' THEN 'bal' WHEN '2' THEN 'rare_null' ELSE 'flag' END AS feature, {r('avg(g)', 'gain')} FROM
  (SELECT regexp_extract(value, '\[f([0-9]+)<', 1) AS f, regexp_extract(value, 'gain=([0-9.]+)', 1)::DOUBLE AS g FROM ({DUMP})) GROUP BY 1"""
ORACLE["accuracy_index"] = f"""
WITH w AS (SELECT target * weight AS y, pred * weight AS p, sum(weight) OVER (ORDER BY pred DESC, {K} ROWS UNBOUNDED PRECEDING) AS run,
  sum(weight) OVER () AS total FROM ({_SCORES})),
b AS (SELECT least(floor(run / total * 10.0) + 1, 10) AS bin, sum(y) AS y, sum(p) AS p FROM w GROUP BY 1)
SELECT {r('1.0 - sum(abs(p - y)) / sum(abs(y))', 'accuracy_index')} FROM b"""
ORACLE["diagonal_cmv"] = f"""
WITH t AS ({LINES}), o AS (SELECT DISTINCT opt_line AS line FROM t),
near AS (SELECT f.final_line, (SELECT line FROM o ORDER BY abs(line - f.final_line), line LIMIT 1) AS line FROM (SELECT DISTINCT final_line FROM t) f),
s AS (SELECT line AS final_line, opt_line, cmv FROM t JOIN near USING (final_line) WHERE cmv IS NOT NULL),
q AS (SELECT final_line, opt_line, quantile_cont(cmv::DOUBLE, 0.01) AS lo, quantile_cont(cmv::DOUBLE, 0.99) AS hi FROM s GROUP BY ALL),
k AS (SELECT s.* FROM s JOIN q USING (final_line, opt_line) WHERE cmv > lo AND cmv < hi),
d AS (SELECT opt_line, avg(cmv) AS m FROM k WHERE final_line = opt_line GROUP BY 1),
c AS (SELECT opt_line, count(*) AS n FROM k GROUP BY 1)
SELECT {r('CASE WHEN (SELECT count(*) FROM k) = 0 THEN 0.0 ELSE sum(m * n) / sum(n) END', 'diagonal_cmv')} FROM d JOIN c USING (opt_line)"""


def _quadrants(points: str) -> str:
    """(x, y, w1, w2, a1 .. d2) at every distinct point of the CTE `points` (sample, x, y), by comparing all pairs."""
    share = lambda s, cond: f"count(*) FILTER (q.sample = {s} AND {cond})::DOUBLE / count(*) FILTER (q.sample = {s})"
    cols = []
    for s in (1, 2):
        cols += [
            f"{share(s, 'q.x <= p.x AND q.y <= p.y')} AS a{s}",
            f"{share(s, 'q.x <= p.x AND q.y > p.y')} AS b{s}",
            f"{share(s, 'q.x > p.x AND q.y <= p.y')} AS c{s}",
            f"{share(s, 'q.x > p.x AND q.y > p.y')} AS d{s}",
        ]
    return f"""SELECT p.x, p.y, p.w1, p.w2, {', '.join(cols)} FROM
      (SELECT x, y, count(*) FILTER (sample = 1) AS w1, count(*) FILTER (sample = 2) AS w2 FROM {points} GROUP BY x, y) p,
      {points} q GROUP BY ALL"""


def _dist(own: int, other: int) -> str:
    n = f"(SELECT count(*) FROM t WHERE sample = {own})"
    gaps = [f"{q}{own} - {q}{other}" + (f" - 1.0 / {n}" if q == "a" else "") for q in "abcd"]
    return f"(SELECT greatest(-min(least({', '.join(gaps)})), max(greatest({', '.join(gaps)})) + 1.0 / {n}) FROM q WHERE w{own} > 0)"


_QUAD = f"WITH t AS ({PARTS}), q AS ({_quadrants('t')})"
_D = f"(({_dist(1, 2)} + {_dist(2, 1)}) / 2)"
ORACLE["quadrant_counts"] = f"{_QUAD} SELECT {r('x')}, {r('y')}, {', '.join(r(f'{c}{s}') for s in (1, 2) for c in 'abcd')} FROM q"
ORACLE["maxdist"] = f"{_QUAD} SELECT {r(_dist(1, 2), 'maxdist')}"
ORACLE["avgmaxdist"] = f"{_QUAD} SELECT {r(_D, 'avgmaxdist')}"
_SF = "2.0 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * k * k * d * d)))"
ORACLE["ks2d"] = f"""{_QUAD},
n AS (SELECT count(*) FILTER (sample = 1) AS n1, count(*) FILTER (sample = 2) AS n2, corr(x, y) FILTER (sample = 1) AS r1, corr(x, y) FILTER (sample = 2) AS r2 FROM t),
m AS (SELECT {_D} AS statistic, sqrt(n1 * n2 / (n1 + n2)::DOUBLE) AS root, sqrt(1 - 0.5 * (r1 * r1 + r2 * r2)) AS r FROM n),
e AS (SELECT statistic, statistic * root / (1 + r * (0.25 - 0.75 / root)) AS d FROM m)
SELECT {r('statistic')}, {r(_SF, 'p_value')} FROM e"""
_BOOT = f"""
pool AS (SELECT x, y, row_number() OVER (ORDER BY sample, p_partkey) AS no FROM t),
n AS (SELECT count(*) AS n, count(*) FILTER (sample = 1) AS n1 FROM t),
draws AS (SELECT rep, slot, floor({u(31, "'boot'", 'rep', 'slot')} * n)::BIGINT + 1 AS no, n1
  FROM (SELECT unnest(range(1, {NBOOT + 1})) AS rep, n, n1, unnest(range(0, 1)) AS one FROM n), (SELECT unnest(range(0, n)) AS slot FROM n)),
b AS (SELECT rep, CASE WHEN slot < n1 THEN 1 ELSE 2 END AS sample, x, y FROM draws JOIN pool USING (no)),
w AS (SELECT rep, x, y, count(*) FILTER (sample = 1) AS w1, count(*) FILTER (sample = 2) AS w2 FROM b GROUP BY ALL)"""


def _boot_share(s: int, cond: str) -> str:
    n = "any_value(n1)" if s == 1 else "any_value(n.n - n1)"
    return f"coalesce(sum(q.w{s}) FILTER ({cond}), 0)::DOUBLE / {n}"


_BOOT_QUAD = f"""
bq AS (SELECT p.rep, p.x, p.y, p.w1, p.w2, {', '.join(
    f"{_boot_share(s, cond)} AS {q}{s}"
    for s in (1, 2)
    for q, cond in (('a', 'q.x <= p.x AND q.y <= p.y'), ('b', 'q.x <= p.x AND q.y > p.y'), ('c', 'q.x > p.x AND q.y <= p.y'), ('d', 'q.x > p.x AND q.y > p.y'))
)} FROM w p JOIN w q ON p.rep = q.rep CROSS JOIN n GROUP BY p.rep, p.x, p.y, p.w1, p.w2)"""


def _boot_dist(own: int, other: int) -> str:
    n = f"(SELECT count(*) FROM t WHERE sample = {own})"
    gaps = [f"{q}{own} - {q}{other}" + (f" - 1.0 / {n}" if q == "a" else "") for q in "abcd"]
    return f"greatest(-min(least({', '.join(gaps)})) FILTER (w{own} > 0), max(greatest({', '.join(gaps)})) FILTER (w{own} > 0) + 1.0 / {n})"


ORACLE["ks2d_bootstrap"] = f"""{_QUAD}, {_BOOT}, {_BOOT_QUAD},
s AS (SELECT rep, ({_boot_dist(1, 2)} + {_boot_dist(2, 1)}) / 2 AS d FROM bq GROUP BY rep), o AS (SELECT {_D} AS d)
SELECT {r('any_value(o.d)', 'statistic')}, {r(f'count(*) FILTER (s.d > o.d) / {NBOOT}.0', 'p_value')} FROM s, o"""

_ENERGY = "sum(d) FILTER (a <> b) / (n * m) - coalesce(sum(d) FILTER (a = 1 AND b = 1), 0) / (n * n) - coalesce(sum(d) FILTER (a = 2 AND b = 2), 0) / (m * m)"
_SIZES = "(SELECT count(*) FILTER (sample = 1)::DOUBLE AS n, count(*) FILTER (sample = 2)::DOUBLE AS m FROM t)"
_VECTORS = "SELECT vec_id AS key, CASE WHEN label < 5 THEN 1 ELSE 2 END AS sample, embedding::DOUBLE[] AS v FROM embeddings"
_PAIRS = "SELECT p.key AS k1, q.key AS k2, p.sample AS a, q.sample AS b, {d} AS d FROM t p JOIN t q ON p.key < q.key"
ORACLE["energy"] = f"""
WITH t AS ({_VECTORS}), pairs AS ({_PAIRS.format(d='list_distance(p.v, q.v)')})
SELECT {r('CASE WHEN dup = 0 THEN e END', 'energy')}, dup AS duplicates FROM
  (SELECT {_ENERGY.replace('sum(d)', 'sum(ln(nullif(d, 0)))')} AS e, count(*) FILTER (d = 0) AS dup FROM pairs, {_SIZES} GROUP BY n, m)"""


def _estat(vectors: str, seed: int, distance: str) -> str:
    """Permutation test; replicate 0 is the observed split."""
    return f"""
WITH t0 AS ({vectors}),
long AS (SELECT key, unnest(v) AS v, unnest(range(1, len(v) + 1)) AS i FROM t0),
mom AS (SELECT i, avg(v) AS mu, stddev_pop(v) AS sd FROM long GROUP BY i),
std AS (SELECT key, list((v - mu) / sd ORDER BY i) AS v FROM long JOIN mom USING (i) GROUP BY key),
t AS (SELECT key, sample, std.v FROM t0 JOIN std USING (key)),
pairs AS ({_PAIRS.format(d=distance)}),
parts AS (SELECT rep, key, CASE WHEN row_number() OVER (PARTITION BY rep ORDER BY {u(seed, "'perm:' || rep", 'key')}) <= (SELECT count(*) FROM t WHERE sample = 1)
  THEN 1 ELSE 2 END AS side FROM t, (SELECT unnest(range(1, {NBOOT + 1})) AS rep)),
sides AS (SELECT * FROM parts UNION ALL SELECT 0, key, sample FROM t),
split AS (SELECT x.rep, x.side AS a, y.side AS b, d FROM pairs JOIN sides x ON x.key = k1 JOIN sides y ON y.key = k2 AND y.rep = x.rep),
e AS (SELECT rep, {_ENERGY} AS e FROM split, {_SIZES} GROUP BY rep, n, m)
SELECT {r('any_value(e) FILTER (rep = 0)', 'energy')}, {r(f'count(*) FILTER (rep > 0 AND e >= (SELECT e FROM e WHERE rep = 0)) / {NBOOT}.0', 'p_value')} FROM e"""


ORACLE["estat"] = _estat(_VECTORS, 32, "ln(list_distance(p.v, q.v))")
ORACLE["estat2d"] = _estat(f"SELECT p_partkey AS key, sample, [x, y] AS v FROM ({PARTS})", 33, "list_distance(p.v, q.v)")

# ---- whole jobs ------------------------------------------------------------------------------

_SCALED_COLS = ["price", "bal", "rare_null", "spike", "few"]
_SPECIAL = f"""
t0 AS ({TRAIN}),
t AS (SELECT * REPLACE (nullif(spike, 0) AS spike), {_flag('bal IS NULL', 'bal_missing')}, {_flag('spike = 0', 'spike_highfreq')} FROM t0),
{lambdas('t', _SCALED_COLS)},
p AS (SELECT t.* REPLACE ({', '.join(f'{power(c, c)} AS {c}' for c in _SCALED_COLS)}) FROM t, {', '.join(f's_{c}, l_{c}' for c in _SCALED_COLS)}),
{scale_stats('p', _SCALED_COLS)},
y AS (SELECT p.* REPLACE ({', '.join(f'coalesce({scaled(c, c)}, {scaled(f'z_{c}.med', c)}) AS {c}' for c in _SCALED_COLS)}, 0.0::DOUBLE AS const)
  FROM p, {', '.join(f'z_{c}' for c in _SCALED_COLS)})"""
ORACLE["preprocess_pipeline"] = f"""
WITH {_SPECIAL}
SELECT {K}, {', '.join(r(c) for c in _SCALED_COLS)}, const, bal_missing, spike_highfreq, target - 0.5 AS target, {_onehot('segment')} FROM y"""
ORACLE["generate_pipeline"] = f"""
SELECT {_OUT4} FROM ({_made(_repeated(_ROWS, f'(SELECT max(g1) FROM ({GRID}))'), 27, f'(SELECT iter % 7 / 10.0::DOUBLE FROM ({_BEST}))')})"""


def _unscaled(c: str) -> str:
    return f"""CASE z_{c}.kind WHEN 'minmax' THEN 0.5 * ({c} * (z_{c}.high - z_{c}.low) + (z_{c}.high + z_{c}.low))
      ELSE {c} * z_{c}.std + z_{c}.mean END"""


_ALL_FROM = ", ".join(f"z_{c}, s_{c}, l_{c}" for c in _SCALED_COLS)
_BACK = {c: inverse(f"({_unscaled(c)})", c) for c in _SCALED_COLS}
ORACLE["postprocess_pipeline"] = f"""
WITH {_SPECIAL},
k AS (SELECT count(*) AS n, count(*) FILTER (bal IS NULL)::DOUBLE / count(*) AS miss, count(*) FILTER (spike = 0)::DOUBLE / count(*) AS freq FROM t0),
b AS (SELECT y.* REPLACE ({', '.join(f'{_BACK[c]} AS {c}' for c in _SCALED_COLS)}), k.*,
  row_number() OVER (ORDER BY bal_missing, {K}) AS mr, row_number() OVER (ORDER BY spike_highfreq, {K}) AS hr FROM y, k, {_ALL_FROM})
SELECT 200000000 + row_number() OVER (ORDER BY {K}) - 1 AS unq1, {r('price', 'price', 2)},
  {r('CASE WHEN mr > round_even(miss * n, 0) THEN bal END', 'bal', 2)}, {r('rare_null', 'rare_null', 6)},
  {r('CASE WHEN hr <= round_even(freq * n, 0) THEN 0.0 ELSE spike END', 'spike', 2)}, {r('few', 'few', 4)}, 1.0::DOUBLE AS const,
  status, coalesce(segment, '') AS segment, CAST(flag01 AS DOUBLE) - 0.5::DOUBLE AS flag01, trunc(target)::INT AS target FROM b"""

ORACLE["impute_model_facts"] = " UNION ALL ".join(
    f"SELECT '{c}' AS col, count(*) AS rows, count(*) - count({c}) AS filled, 0::BIGINT AS empty, 0::BIGINT AS changed FROM ({TRAIN})"
    for c in ("bal", "rare_null")
)
ORACLE["preprocess_files"] = ORACLE["preprocess_pipeline"]
ORACLE["postprocess_files"] = ORACLE["postprocess_pipeline"]
ORACLE["whole_chain_facts"] = f"""
SELECT count(*) AS rows, count(*) AS ids, 200000000::BIGINT AS first_id, true AS missing,
  0::BIGINT AS outside, count(*) AS constant, count(DISTINCT coalesce(segment, '')) AS segments, count(DISTINCT status) AS statuses FROM ({TRAIN})"""
_STEP = "CASE WHEN few >= 10 THEN 7.0::DOUBLE ELSE 3.0::DOUBLE END"
ORACLE["impute_model_step"] = f"""
SELECT {K}, round(CASE WHEN {K} % 10 <> 3 THEN {_STEP} ELSE {_STEP} - ({_STEP} - 0.5::DOUBLE) * pow(0.99::DOUBLE, 200) END, 6) AS step FROM ({TRAIN})"""
ORACLE["svd_spectrum"] = f"""
WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(64)) AS i FROM embeddings),
g AS (SELECT a.i AS i, b.i AS j, sum(a.x * b.x) AS v FROM e a JOIN e b USING (vec_id) GROUP BY a.i, b.i),
t AS (SELECT sum(v) AS t FROM g WHERE i = j),
h AS (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM g a JOIN g b ON a.j = b.i GROUP BY a.i, b.j)
SELECT 1::INT AS power, {r('t', 'value')} FROM t
UNION ALL SELECT 2, {r('sum(v * v) / any_value(t * t)', 'value')} FROM g, t
UNION ALL SELECT 3, {r('sum(g.v * h.v) / any_value(t * t * t)', 'value')} FROM g JOIN h USING (i, j), t"""
ORACLE["svd_facts"] = """
SELECT 'svd_' || k AS component, (SELECT count(*) FROM embeddings) AS rows, 0.0::DOUBLE AS mean, 1.0::DOUBLE AS deviation
FROM (SELECT unnest(range(8)) AS k)"""


def _searched(c: str) -> str:
    """The best multiple of 0.0001 next to the best of 0.01."""
    return f"""SELECT '{c}' AS col, round(lam, 2) + 0.0 AS lambd FROM (
  SELECT lam, var_pop((exp(lam * g) - 1.0) / lam) AS v FROM g_{c}, (SELECT lam + k / 10000.0::DOUBLE AS lam FROM l_{c}, (SELECT unnest(range(-100, 101)) AS k))
  WHERE lam <> 0 GROUP BY lam ORDER BY v, lam LIMIT 1)"""


ORACLE["boxcox_fit_search"] = _FITTED + " " + " UNION ALL ".join(f"({_searched(c)})" for c in BOXCOX_COLS if c != "const")
