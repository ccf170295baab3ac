"""DuckDB SQL for the queries, written apart from the engine: stages of window expressions over bars of the same quotes."""

from __future__ import annotations

SIZE = 20
NUDGE = 3.1e-8

QUOTES = """quotes AS (SELECT 'S' AS series_id, event_id, event_type, ts AS time, 1e2 + value / 1e2 AS bid,
  1e2 + value / 1e2 + 1e-3 * (10 + (31 * event_id * event_id + 7 * event_id) % 97) AS ask FROM events)"""
TICKS = QUOTES + ", ticks AS (SELECT *, (bid + ask) / 2 AS mid, row_number() OVER (ORDER BY time, bid, ask) - 1 AS tick_id FROM quotes)"
_OHLC = ", ".join(
    f"arg_min({c}, tick_id) AS {p}open, max({c}) AS {p}high, min({c}) AS {p}low, arg_max({c}, tick_id) AS {p}close" for c, p in (("mid", ""), ("bid", "bid_"), ("ask", "ask_"))
)
_BAR = f"min(time) AS start_time, max(time) AS end_time, {_OHLC}, avg(ask - bid) AS spread_mean, count(*) AS ticks"
BARS = f"{TICKS}, bars AS (SELECT 'S' AS series_id, tick_id // {SIZE} AS row_id, {_BAR} FROM ticks GROUP BY tick_id // {SIZE})"
BAR_COLUMNS = "series_id, row_id, start_time, end_time, {}, ticks".format(
    ", ".join(f"round({c}, 6) AS {c}" for c in "open high low close bid_open bid_high bid_low bid_close ask_open ask_high ask_low ask_close spread_mean".split())
)

ALL = "ORDER BY row_id"


def back(n: int) -> str:
    return f"(ORDER BY row_id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def gate(agg: str, x: str, n: int) -> str:
    return f"(CASE WHEN count({x}) OVER {back(n)} >= {n} THEN {agg} OVER {back(n)} END)"


def mean(x, n):
    return gate(f"avg({x})", x, n)


def total(x, n):
    return gate(f"sum({x})", x, n)


def low(x, n):
    return gate(f"min({x})", x, n)


def high(x, n):
    return gate(f"max({x})", x, n)


def std(x, n):
    return gate(f"stddev_samp({x})", x, n)


def lag(x, k=1):
    return f"lag({x}, {k}) OVER ({ALL})"


def zero(x):
    return f"coalesce({x}, 0e0)"


def div(a, b):
    return f"(({a}) / nullif({b}, 0e0))"


def clip(x, a, b):
    return f"(CASE WHEN ({x}) IS NOT NULL THEN least(greatest(({x}), {a}), {b}) END)"


def zs(x, n):
    return div(f"{x} - {mean(x, n)}", std(x, n))


def pct(z):
    return f"(1e0 / (1e0 + exp(-1.702e0 * {z})))"


def rv(r, n):
    return f"sqrt({total(f'{r} * {r}', n)})"


def cov(x, y, n):
    return f"({mean(f'{x} * {y}', n)} - {mean(x, n)} * {mean(y, n)})"


def var(x, n):
    square, m = mean(f"{x} * {x}", n), mean(x, n)
    v = f"({square} - {m} * {m})"
    return f"(CASE WHEN {v} > 1e-12 * {square} THEN {v} WHEN {v} IS NOT NULL THEN 0e0 END)"


def corr(x, y, n):
    return div(cov(x, y, n), f"sqrt({var(x, n)} * {var(y, n)})")


def slope(y, n):
    return gate(f"regr_slope({y}, CAST(row_id AS DOUBLE))", y, n)


def r2(y, n):
    w = back(n)
    fit = f"CASE WHEN max({y}) OVER {w} > min({y}) OVER {w} AND count({y}) OVER {w} >= {n} THEN regr_r2({y}, CAST(row_id AS DOUBLE)) OVER {w} END"
    return clip(fit, "0e0", "1e0")


def halflife(phi):
    return f"(CASE WHEN abs({phi}) > 0 AND abs({phi}) < 0.999999e0 THEN -ln(2e0) / ln(abs({phi})) END)"


def entropy(r, n):
    parts = []
    for hit in (f"{r} > 0", f"{r} < 0", f"{r} = 0"):
        p = mean(f"CASE WHEN {hit} THEN 1e0 WHEN {r} IS NOT NULL THEN 0e0 END", n)
        parts.append(f"(CASE WHEN {p} > 0 THEN {p} * ln({p}) ELSE 0e0 END)")
    return f"(-({' + '.join(parts)}) / ln(3e0))"


def ln(x):
    return f"(CASE WHEN {x} > 0 THEN ln({x}) END)"


def stage(name: str, source: str, columns: dict[str, str]) -> str:
    return f"{name} AS (SELECT *, {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source})"


def rounded(columns: list[str], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) + 0e0 AS {c}" for c in columns)


RETURNS = f"{BARS}, {stage('a', 'bars', {'lc': ln('close')})}, {stage('b', 'a', {'r': zero(f'lc - {lag("lc")}'), 'dp': f'close - {lag("close")}'})}, {stage('c', 'b', {'r_lag': lag('r')})}"


def over_returns(columns: dict[str, str], where: str = "", digits: int = 6) -> str:
    return f"WITH {RETURNS}, {stage('d', 'c', columns)} SELECT row_id, {rounded(list(columns), digits)} FROM d {where}"


# the feature catalogue

FAMILY = "log_return delta_log_return rv range_position range_width spread_mean spread_change spread_vol ticks_mean ticks_change tick_imbalance bid_change ask_change bid_ask_pressure efficiency_ratio return_sign_entropy".split()
FAMILY_PCT = "rv range_width spread_mean spread_change spread_vol bid_ask_pressure efficiency_ratio return_sign_entropy".split()


def features(wins: dict[str, int]) -> str:
    anchor = wins["XL"]
    one = {"lc": ln("close"), "mid": "(bid_close + ask_close) / 2", "duration_ms": "(epoch_us(end_time) - epoch_us(start_time)) / 1e3", "tk": "CAST(ticks AS DOUBLE)"}
    two = {"microprice_proxy": "mid - close", "ticks_per_ms": div("tk", "duration_ms"), "spread_rel_range_1": div("high - low", "spread_mean"), "log_return_1": zero(f"lc - {lag('lc')}"), "dp": f"close - {lag('close')}", "l1": f"lc - {lag('lc')}", "l5": f"lc - {lag('lc', 5)}", "l10": f"lc - {lag('lc', 10)}"}
    for n, w in wins.items():
        two |= {f"log_return_{n}": zero(f"lc - {lag('lc', w)}"), f"bid_change_{n}": zero(f"bid_close - {lag('bid_close', w)}"), f"ask_change_{n}": zero(f"ask_close - {lag('ask_close', w)}"), f"back_{n}": lag("close", w)}
    three = {"spread_rel_return_1": div("log_return_1", "spread_mean"), "log_return_1_per_ms": div("log_return_1", "duration_ms"), "sg": zero("sign(dp)"), "rl": lag("log_return_1"), "z1": zero("l1"), "z5": zero("l5"), "z10": zero("l10"), "adp": "abs(dp)"}
    for n in wins:
        three |= {f"delta_log_return_{n}": zero(f"log_return_{n} - {lag(f'log_return_{n}')}"), f"bid_ask_pressure_{n}": f"ask_change_{n} - bid_change_{n}"}
    four, five = {}, {}
    for n, w in wins.items():
        four |= {
            f"rv_{n}": rv("log_return_1", w), f"range_position_{n}": clip(div(f"close - {low('close', w)}", f"{high('close', w)} - {low('close', w)}"), "0e0", "1e0"), f"range_width_{n}": f"{high('close', w)} - {low('close', w)}",
            f"spread_mean_{n}": mean("spread_mean", w), f"spread_vol_{n}": std("spread_mean", w), f"ticks_mean_{n}": mean("tk", w), f"tick_imbalance_{n}": f"{total('sg', w)} / {w}e0",
            f"efficiency_ratio_{n}": div(f"abs(close - back_{n})", total("adp", w)), f"return_sign_entropy_{n}": entropy("log_return_1", w),
        }
        five |= {f"spread_change_{n}": zero(f"spread_mean_{n} - {lag(f'spread_mean_{n}')}"), f"ticks_change_{n}": zero(f"ticks_mean_{n} - {lag(f'ticks_mean_{n}')}")}
    for n in ("M", "L", "XL"):
        four |= {f"trend_slope_{n}": slope("close", wins[n]), f"trend_r2_{n}": r2("close", wins[n])}
        five[f"trend_strength_{n}"] = div(f"trend_slope_{n}", f"rv_{n}")
    for n in ("S", "M"):
        four[f"return_autocorr_{n}"] = corr("log_return_1", "rl", wins[n])
    for n in ("M", "L"):
        w, k = wins[n], 5 if n == "M" else 10
        four |= {f"ar1_phi_{n}": div(cov("log_return_1", "rl", w), var("rl", w)), f"corr_ret1_spread_{n}": corr("log_return_1", "spread_mean", w), f"variance_ratio_{n}_k{k}": div(var(f"z{k}", w), f"{k}e0 * {var('z1', w)}")}
        five |= {f"mean_reversion_halflife_{n}": halflife(f"ar1_phi_{n}"), f"corr_ret1_rvS_{n}": corr("log_return_1", "rv_S", w), f"corr_rvS_spread_{n}": corr("rv_S", "spread_mean", w), f"rv_change_{n}": zero(f"rv_{n} - {lag(f'rv_{n}', w)}")}
    forms = [(b, anchor, b in ("microprice_proxy", "spread_rel_return_1", "spread_rel_range_1")) for b in ("microprice_proxy", "spread_rel_return_1", "spread_rel_range_1", "ticks_per_ms", "log_return_1_per_ms")]
    forms += [(f"{f}_{n}", anchor, f in FAMILY_PCT) for n in wins for f in FAMILY]
    forms += [(f"trend_{t}_{n}", anchor, False) for n in ("M", "L", "XL") for t in ("slope", "r2", "strength")] + [(f"return_autocorr_{n}", anchor, False) for n in ("S", "M")]
    for n, k in (("M", 5), ("L", 10)):
        forms += [(f"ar1_phi_{n}", anchor, True), (f"mean_reversion_halflife_{n}", anchor, True), (f"rv_change_{n}", wins[n], True), (f"variance_ratio_{n}_k{k}", wins[n], True)]
        forms += [(f"corr_{c}_{n}", wins[n], False) for c in ("ret1_rvS", "ret1_spread", "rvS_spread")]
    six = {f"zz_{f}": zs(f, w) for f, w, _ in forms}
    base = "open high low close bid_open bid_high bid_low bid_close ask_open ask_high ask_low ask_close spread_mean duration_ms ticks_per_ms log_return_1_per_ms mid microprice_proxy log_return_1 spread_rel_return_1 spread_rel_range_1".split()
    near = lambda x, c: f"round({x} + {NUDGE!r}, 6) + 0e0 AS {c}"
    shown = [near(c, c) for c in [*base, *[f for f, _, _ in forms if f not in base]]] + [near("tk", "ticks")]
    shown += [near(zero(f"zz_{f}"), f"{f}_z") for f, _, _ in forms] + [near(pct(f"zz_{f}"), f"{f}_pct") for f, _, p in forms if p]
    stages, source = [BARS], "bars"
    for name, columns in zip(("s1", "s2", "s3", "s4", "s5", "s6"), (one, two, three, four, five, six)):
        stages.append(stage(name, source, columns))
        source = name
    return f"WITH {', '.join(stages)} SELECT row_id, {', '.join(shown)} FROM s6 WHERE row_id >= {max(wins.values())}"


# labels

H, WIN = 10, 20
N = "(SELECT count(*) FROM bars)"
_SPREAD = "1e4 * spread_mean / greatest(entry, 1e-12)"
_SPEED = "greatest(ticks / greatest((epoch_us(end_time) - epoch_us(start_time)) / 1e3, 1e0), 0e0)"
COST = f"CASE WHEN entry IS NOT NULL THEN least(greatest(2e0 * (0.8e0 * {_SPREAD} + greatest(0.2e0 * {_SPREAD} * pow(1e0 + {_SPEED}, 0.5e0), 0e0)), 0.6e0), 6e0) END"
TR = f"CASE WHEN {lag('close')} IS NOT NULL THEN greatest(high - low, abs(high - {lag('close')}), abs(low - {lag('close')})) END"


def ewm(value: str, source: str, name: str, win: int) -> str:
    """A recursive CTE (row_id, v), one row at a time."""
    alpha = 2.0 / (win + 1)
    return f"""{name}_x AS (SELECT row_id, {value} AS x, row_number() OVER (ORDER BY row_id) AS k FROM {source} WHERE ({value}) IS NOT NULL),
{name} AS (SELECT row_id, k, x AS v FROM {name}_x WHERE k = 1 UNION ALL
  SELECT n.row_id, n.k, {alpha!r}::DOUBLE * n.x + {1 - alpha!r}::DOUBLE * p.v FROM {name} p JOIN {name}_x n ON n.k = p.k + 1)"""


LABEL_BASE = f"""{BARS},
l1 AS (SELECT *, (lead(bid_open) OVER ({ALL}) + lead(ask_open) OVER ({ALL})) / 2 AS entry, (bid_close + ask_close) / 2 AS ex,
  CASE WHEN row_id = 0 THEN 0e0 ELSE ln(close) - ln({lag('close')}) END AS r, {TR} AS tr FROM bars),
l2 AS (SELECT *, {COST} AS cost, least(greatest(r, -0.02e0), 0.02e0) AS rc, least(row_id + {H}, {N} - 1) AS t1 FROM l1),
{ewm('rc * rc', 'l2', 'ev', WIN)},
{ewm('tr', 'l2', 'ea', WIN)},
l3 AS (SELECT l2.*, sqrt(ev.v) AS vol, ea.v AS atr, CASE WHEN entry > 0 THEN ea.v / entry END AS atr_ret, e.ex AS ex_h, e.end_time AS time_h
  FROM l2 LEFT JOIN ev USING (row_id) LEFT JOIN ea USING (row_id) LEFT JOIN (SELECT row_id AS t1, ex, end_time FROM l2) e USING (t1)),
l4 AS (SELECT *, CASE WHEN entry > 0 AND ex_h > 0 THEN (ex_h - entry) / entry - cost / 1e4 END AS ret_h,
  entry > 0 AND atr_ret IS NOT NULL AND row_id < {N} - 1 AS begun, 1.5e0 * greatest(atr_ret, 1e-6) AS pt, 2e0 * greatest(atr_ret, 1e-6) AS sl FROM l3),
l5 AS (SELECT *, coalesce(ret_h IS NOT NULL AND row_id + {H} < {N}, false) AS ok_h, coalesce(begun AND 1e4 * pt >= 3e0 * cost + 0.5e0, false) AS worth FROM l4)"""


def barrier(tie: str = "close") -> str:
    side = {"close": "CASE WHEN f.close >= b.entry THEN 1 ELSE -1 END", "worst": "0", "best": "1"}[tie]
    kind = {"close": "1", "worst": "-1", "best": "1"}[tie]
    return f"""{LABEL_BASE},
hits AS (SELECT b.row_id, min(f.row_id) AS hit FROM l5 b JOIN l5 f ON f.row_id > b.row_id AND f.row_id <= b.row_id + {H} AND b.worth
  AND (f.high / b.entry - 1 >= b.pt OR f.low / b.entry - 1 <= -b.sl OR b.entry / f.low - 1 >= b.pt OR f.high / b.entry - 1 >= b.sl) GROUP BY b.row_id),
h1 AS (SELECT b.*, hit, coalesce(hit, t1) AS stop_row FROM l5 b LEFT JOIN hits USING (row_id)),
h2 AS (SELECT b.*, f.ex AS ex_at, f.end_time AS time_at, hit IS NOT NULL AND f.high / b.entry - 1 >= b.pt AS lp, hit IS NOT NULL AND f.low / b.entry - 1 <= -b.sl AS ll,
  hit IS NOT NULL AND b.entry / f.low - 1 >= b.pt AS sp, hit IS NOT NULL AND f.high / b.entry - 1 >= b.sl AS ss, {side} AS tie_side, {kind} AS tie_kind FROM h1 b JOIN l5 f ON f.row_id = b.stop_row),
h3 AS (SELECT *, CASE WHEN hit IS NULL THEN 0 WHEN (lp OR ll) AND NOT (sp OR ss) THEN 1 WHEN (sp OR ss) AND NOT (lp OR ll) THEN -1 ELSE tie_side END AS side,
  CASE WHEN hit IS NULL THEN 0 WHEN (lp OR ll) AND NOT (sp OR ss) THEN CASE WHEN lp THEN 1 ELSE -1 END
    WHEN (sp OR ss) AND NOT (lp OR ll) THEN CASE WHEN sp THEN 1 ELSE -1 END ELSE tie_kind END AS kind FROM h2),
h4 AS (SELECT *, coalesce(worth AND ex_at > 0, false) AS placed, least(greatest(CASE side WHEN 1 THEN (ex_at - entry) / entry WHEN -1 THEN (entry - ex_at) / entry ELSE abs(ex_at - entry) / entry END
  - cost / 1e4, -0.2e0), 0.2e0) AS net FROM h3),
h5 AS (SELECT *, CASE WHEN placed THEN stop_row ELSE -1 END AS t1_tb, CASE WHEN placed THEN net END AS ret_tb, placed AND row_id + {H} < {N} AS ok_tb FROM h4)"""


def uniqueness(source: str, t1: str, ok: str, name: str) -> str:
    return f"""{name}_c AS (SELECT b.row_id, greatest(count(o.row_id), 1) AS conc FROM {source} b LEFT JOIN {source} o ON o.{ok} AND o.row_id <= b.row_id AND b.row_id <= o.{t1} GROUP BY b.row_id),
{name} AS (SELECT b.row_id, avg(1e0 / c.conc) AS u FROM {source} b JOIN {name}_c c ON b.{ok} AND c.row_id BETWEEN b.row_id AND b.{t1} GROUP BY b.row_id)"""


WEIGHTED = f"""{barrier()}, {uniqueness('h5', 't1', 'ok_h', 'uh')}, {uniqueness('h5', 't1_tb', 'ok_tb', 'ut')},
w AS (SELECT h5.*, coalesce(uh.u, 0e0) AS uniq_h, coalesce(ut.u, 0e0) AS uniq_tb,
  coalesce(uh.u, 0e0) * least(greatest(coalesce(abs(ret_h) / (CASE WHEN vol > 0 THEN vol END + 1e-12), 0e0), 0e0), 50e0) AS w_h,
  coalesce(ut.u, 0e0) * least(greatest(coalesce(abs(ret_tb) / (CASE WHEN atr_ret > 0 THEN atr_ret END + 1e-12), 0e0), 0e0), 50e0) AS w_tb
  FROM h5 LEFT JOIN uh USING (row_id) LEFT JOIN ut USING (row_id))"""


def nearest(source: str, column: str, share: float) -> str:
    """The value at rank round(share * (n - 1)), halves up."""
    return f"(SELECT x FROM (SELECT {column} AS x, row_number() OVER (ORDER BY {column}) - 1 AS k, count(*) OVER () AS n FROM {source} WHERE {column} IS NOT NULL) WHERE k = floor({share!r}::DOUBLE * (n - 1) + 0.5e0))"
