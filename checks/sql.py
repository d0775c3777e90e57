"""DuckDB SQL for every registered query that SQL can express.

Built from named common table expressions; each function returns a list of (name, text).
"""

import re

SPARSE_W, DENSE_W = 86_400, 14_400
WIDTHS = (43_200, 86_400)
PS = (0.05, 0.5)
DEEP, KOEFF = 6, 2
LAGS = (1, 2, 4)
SPLIT_DAY = "2024-01-15"
STEP_MS = 5 * 86_400_000
BEGIN_MS, END_MS = 1_704_434_400_000, 1_705_084_200_000  # 2024-01-05 06:00 .. 01-12 18:30


def query(ctes, final):
    body = ",\n".join(f"{name} AS ({text})" for name, text in ctes)
    return f"WITH {body}\n{final}"


def r(value, places):
    """Half up, towards +infinity."""
    scale = f"1e{places}"
    return f"(floor(({value}) * {scale} + 0.5) / {scale})"


def ticks(mapping="sparse"):
    ticker = (
        "user_id"
        if mapping == "sparse"
        else "CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 "
        "WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END"
    )
    return [
        (
            "ticks",
            f"SELECT CAST({ticker} AS BIGINT) AS ticker_id, CAST(e.ts AS DATE) AS ddate, "
            "epoch_us(e.ts) // 1000 AS ts, epoch_us(e.ts) // 1000 AS db_tsunx, "
            "value + 0.02 AS ask, value AS bid FROM events e",
        )
    ]


TICKERS = (
    "tickers",
    "SELECT c_custkey AS ticker_id, c_name AS ticker_code, c_mktsegment AS ticker_first, "
    "'' AS ticker_seconds FROM customer",
)


def bars_property(widths=WIDTHS):
    values = ", ".join(f"({w})" for w in widths)
    return (
        "bars_property",
        "SELECT ticker_id, CAST(w AS INTEGER) AS bar_width_sec, "
        "CASE WHEN ticker_id % 5 = 0 THEN 0 ELSE 1 END AS is_enabled "
        f"FROM (SELECT DISTINCT ticker_id FROM ticks), (VALUES {values}) v(w)",
    )


SPANS = (
    "spans",
    "SELECT ticker_id, min(db_tsunx) AS t_first, max(db_tsunx) AS t_last FROM ticks GROUP BY 1",
)


def all_items(width):
    return (
        "items",
        f"SELECT DISTINCT ticker_id, CAST({width} AS INTEGER) AS bar_width_sec FROM ticks",
    )


ENABLED_ITEMS = (
    "items",
    "SELECT ticker_id, bar_width_sec FROM tickers JOIN bars_property USING (ticker_id) "
    "WHERE is_enabled = 1",
)
GRIDS = ("grids", "SELECT * FROM items JOIN spans USING (ticker_id)")


def bars_on_grid(name="bars", grids="grids", source="ticks"):
    at = "(ddate, ts, db_tsunx)"
    return [
        (
            f"{name}_placed",
            "SELECT ticker_id, bar_width_sec, ddate, ts, db_tsunx, (ask + bid) / 2 AS mid, "
            "(db_tsunx - t_first) // (bar_width_sec::BIGINT * 1000) + 1 AS g, t_first, t_last "
            f"FROM {source} JOIN {grids} USING (ticker_id) "
            "WHERE db_tsunx BETWEEN t_first AND t_last",
        ),
        (
            f"{name}_raw",
            f"SELECT ticker_id, bar_width_sec, g, arg_min(mid, {at}) AS o_, max(mid) AS h_, "
            f"min(mid) AS l_, arg_max(mid, {at}) AS c_, arg_min(db_tsunx, {at}) AS first_ms, "
            f"arg_max(db_tsunx, {at}) AS last_ms, arg_max(ddate, {at}) AS last_day, "
            f"count(*) AS n, stddev_pop(mid) AS sd FROM {name}_placed "
            "WHERE t_first + g * bar_width_sec::BIGINT * 1000 <= t_last GROUP BY 1, 2, 3",
        ),
        (
            f"{name}_rounded",
            "SELECT ticker_id, last_day AS ddate, bar_width_sec, first_ms AS ts_begin, "
            "CASE WHEN n = 1 THEN first_ms + bar_width_sec::BIGINT * 1000 ELSE last_ms END "
            f"AS ts_end, {r('o_', 5)} AS o, {r('h_', 5)} AS h, {r('l_', 5)} AS l, "
            f"{r('c_', 5)} AS c, n::INTEGER AS ticks_cnt, {r('sd', 6)} AS disp FROM {name}_raw",
        ),
        (
            name,
            f"SELECT ticker_id, ddate, bar_width_sec, ts_begin, ts_end, o, h, l, c, "
            f"{r('abs(c - o)', 5)} AS h_body, {r('abs(h - l)', 5)} AS h_shad, "
            "CASE WHEN o < c THEN 'g' WHEN o = c THEN 'n' ELSE 'r' END AS btype, "
            f"ticks_cnt, disp, {r('ln(c) - ln(o)', 5)} AS log_co FROM {name}_rounded",
        ),
    ]


def bars(mapping="sparse", width=SPARSE_W):
    return [*ticks(mapping), all_items(width), SPANS, GRIDS, *bars_on_grid()]


def hits(source="bars"):
    """Outcomes by definition: every later bar of the series, the first that qualifies."""
    values = ", ".join(f"(CAST({p} AS DOUBLE))" for p in PS)
    hit = (
        "(t.up BETWEEN b.low AND b.high OR t.down BETWEEN b.low AND b.high "
        "OR (t.up <= b.high AND t.down >= b.low))"
    )
    return [
        (
            "numbered",
            "SELECT ticker_id, bar_width_sec, ddate, ts_begin, ts_end, c, "
            "least(o, h, l, c) AS low, greatest(o, h, l, c) AS high, row_number() OVER "
            "(PARTITION BY ticker_id, bar_width_sec ORDER BY ddate, ts_end, ts_begin) AS seq "
            f"FROM {source}",
        ),
        (
            "targets",
            f"SELECT n.*, p AS log_oe, {r('exp(ln(c) + p)', 4)} AS up, "
            f"{r('exp(ln(c) - p)', 4)} AS down FROM numbered n, (VALUES {values}) v(p)",
        ),
        (
            "hit_seq",
            "SELECT t.ticker_id, t.bar_width_sec, t.seq, t.log_oe, min(b.seq) AS hit "
            "FROM targets t JOIN numbered b ON t.ticker_id = b.ticker_id "
            f"AND t.bar_width_sec = b.bar_width_sec AND b.seq > t.seq AND {hit} "
            "GROUP BY 1, 2, 3, 4",
        ),
        (
            "hits",
            "SELECT t.ticker_id, t.bar_width_sec, t.ddate, t.ts_begin, t.ts_end, t.c, t.log_oe, "
            "b.ts_end AS ts_end_res, b.ddate AS ddate_res, b.c AS c_res, "
            "CASE WHEN b.seq IS NULL THEN 'nn' WHEN t.up BETWEEN b.low AND b.high THEN 'mx' "
            "WHEN t.down BETWEEN b.low AND b.high THEN 'mn' "
            "WHEN t.up <= b.high AND t.down >= b.low THEN 'bt' ELSE 'nn' END AS res_type "
            "FROM targets t LEFT JOIN hit_seq s ON t.ticker_id = s.ticker_id AND "
            "t.bar_width_sec = s.bar_width_sec AND t.seq = s.seq AND t.log_oe = s.log_oe "
            "LEFT JOIN numbered b ON b.ticker_id = s.ticker_id AND "
            "b.bar_width_sec = s.bar_width_sec AND b.seq = s.hit",
        ),
    ]


FA = (
    "fa",
    "SELECT ticker_id, ddate, bar_width_sec, ts_end, c, log_oe, ts_end_res, "
    "CAST(trunc((ts_end_res - ts_end) / 1000) AS INTEGER) AS dursec_res, ddate_res, c_res, "
    "res_type FROM hits WHERE ts_end_res IS NOT NULL",
)


def outcomes(mapping="sparse", width=SPARSE_W):
    return [*bars(mapping, width), *hits(), FA]


def islands(mapping="sparse", width=SPARSE_W):
    part = "PARTITION BY ticker_id, bar_width_sec, log_oe, res_type"
    return [
        *outcomes(mapping, width),
        (
            "gaps",
            f"SELECT *, lag(ts_end) OVER ({part} ORDER BY ddate, ts_end) AS before FROM fa "
            "WHERE res_type IN ('mx', 'mn')",
        ),
        (
            "islands",
            "SELECT * EXCLUDE (before), CAST(sum(CASE WHEN before IS NULL OR "
            f"trunc((ts_end - before) / 1000) >= bar_width_sec * {KOEFF} THEN 1 ELSE 0 END) "
            f"OVER ({part} ORDER BY ddate, ts_end) AS BIGINT) AS grp FROM gaps",
        ),
        (
            "kept",
            "SELECT * FROM islands QUALIFY ts_end = max(ts_end) OVER (PARTITION BY ticker_id, "
            "bar_width_sec, log_oe, res_type, grp)",
        ),
    ]


def form_ticks(mapping="dense", width=DENSE_W, deep=DEEP):
    return [
        *islands(mapping, width),
        (
            "windows",
            "SELECT DISTINCT ticker_id, bar_width_sec, ts_end, "
            f"ts_end - bar_width_sec::BIGINT * 1000 * {deep} AS from_ms FROM kept",
        ),
        (
            "ft",
            "SELECT w.*, t.ts, t.db_tsunx, t.ask, t.bid, row_number() OVER (PARTITION BY "
            "w.ticker_id, w.bar_width_sec, w.ts_end ORDER BY t.db_tsunx, t.ts) AS pos "
            "FROM windows w JOIN ticks t ON t.ticker_id = w.ticker_id "
            "AND t.db_tsunx BETWEEN w.from_ms AND w.ts_end",
        ),
    ]


def _third(x):
    return (
        f"CASE WHEN {x} <= lo + (hi - lo) / 3 THEN 3 "
        f"WHEN {x} < lo + (hi - lo) / 3 + (hi - lo) / 3 THEN 2 ELSE 1 END"
    )


def _code(a, b, c):
    return f"CASE WHEN {a} > greatest({b}, {c}) THEN 1 WHEN {a} < least({b}, {c}) THEN 3 ELSE 2 END"


def features(mapping="dense", width=DENSE_W, deep=DEEP, lags=LAGS):
    key = "ticker_id, bar_width_sec, ts_end"
    over = f"OVER (PARTITION BY {key} ORDER BY pos)"
    edge = [f"(lo + (hi - lo) / 10 * {i})" for i in range(11)]
    peaks = ", ".join(
        f"count(*) FILTER (ask >= {edge[i]} AND ask <= {edge[i + 1]})" for i in range(10)
    )
    acf_in, acf_out = [], []
    for role, k in zip(("acf_05_bws", "acf_1_bws", "acf_2_bws"), lags, strict=True):
        lagged = f"y_{role}"
        acf_in.append(f"lag(ask, {k}) {over} AS {lagged}")
        # Prices above the lowest of the form keep the digits of small moves.
        x, y = f"CASE WHEN {lagged} IS NOT NULL THEN ask - lo END", f"({lagged} - lo)"
        cov = f"avg(({x}) * {y}) - avg({x}) * avg({y})"
        var_x = f"greatest(avg(({x}) * ({x})) - avg({x}) * avg({x}), 0)"
        var_y = f"greatest(avg({y} * {y}) - avg({y}) * avg({y}), 0)"
        flat = f"min({x}) = max({x}) OR min({y}) = max({y})"
        acf_out.append(
            f"CASE WHEN count({y}) = 0 OR {flat} OR sqrt({var_x} * {var_y}) = 0 THEN 0.0 "
            f"ELSE {r(f'({cov}) / sqrt({var_x} * {var_y})', 3)} END AS {role}"
        )
    return [
        *form_ticks(mapping, width, deep),
        (
            "moves",
            f"SELECT *, ask - lag(ask) {over} AS move, {', '.join(acf_in)}, "
            f"min(ask) OVER w AS lo, max(ask) OVER w AS hi, min(db_tsunx) OVER w AS t0, "
            f"max(db_tsunx) OVER w AS t1 FROM ft WINDOW w AS (PARTITION BY {key})",
        ),
        (
            "steps",
            f"SELECT *, min(CASE WHEN move > 0 THEN move END) OVER w AS up_min, "
            f"max(CASE WHEN move > 0 THEN move END) OVER w AS up_max, "
            f"min(CASE WHEN move < 0 THEN -move END) OVER w AS dn_min, "
            f"max(CASE WHEN move < 0 THEN -move END) OVER w AS dn_max "
            f"FROM moves WINDOW w AS (PARTITION BY {key})",
        ),
        (
            "widths",
            f"SELECT *, {r('coalesce(up_max - up_min, 0) / 10', 6)} AS up_w, "
            f"{r('coalesce(dn_max - dn_min, 0) / 10', 6)} AS dn_w, (t1 - t0) // 3 AS third "
            "FROM steps",
        ),
        (
            "stats",
            f"SELECT {key}, any_value(lo) AS lo, any_value(hi) AS hi, any_value(t0) AS t0, "
            "any_value(t1) AS t1, count(*) AS n, arg_min(ask, pos) AS first_ask, "
            f"arg_max(ask, pos) AS last_ask, [{peaks}] AS peaks, "
            "any_value(up_w) * count(*) FILTER (move > 0 AND move < up_min + 11 * up_w) AS up, "
            "any_value(dn_w) * count(*) FILTER (move < 0 AND -move < dn_min + 11 * dn_w) AS dn, "
            f"{r('count(*) FILTER (db_tsunx <= t0 + third) / count(*)', 3)} AS p1, "
            + r(
                "count(*) FILTER (db_tsunx BETWEEN t0 + third AND t0 + 2 * third) / count(*)", 3
            )
            + f" AS p2, {r('count(*) FILTER (db_tsunx >= t0 + 2 * third) / count(*)', 3)} AS p3, "
            f"{', '.join(acf_out)} FROM widths GROUP BY {key}",
        ),
        (
            "coded",
            "SELECT *, CASE WHEN (hi - lo) / 10 = 0 THEN lo ELSE lo + (hi - lo) / 10 * "
            "(list_position(peaks, list_max(peaks)) - 1) END AS peak_price, "
            f"{_code('p1', 'p2', 'p3')} AS k1, {_code('p2', 'p1', 'p3')} AS k2, "
            f"{_code('p3', 'p1', 'p2')} AS k3 FROM stats",
        ),
        (
            "features",
            f"SELECT {key}, t0 AS ts_begin, peak_price, CAST(n AS INTEGER) AS tickscnt, "
            f"CAST(CASE WHEN t1 - t0 < 1000 * {deep - 1} * bar_width_sec::BIGINT THEN 0 ELSE "
            f"({_third('first_ask')}) * 100 + ({_third('peak_price')}) * 10 "
            f"+ ({_third('last_ask')}) END AS INTEGER) AS frmconfpeak, "
            f"CASE WHEN up + dn = 0 OR up + dn IS NULL THEN 0.0 ELSE {r('up / (up + dn)', 3)} "
            f"END AS sps, CASE WHEN up + dn = 0 OR up + dn IS NULL THEN 0.0 ELSE "
            f"{r('dn / (up + dn)', 3)} END AS sms, "
            "CAST(CASE k1 * 100 + k2 * 10 + k3 WHEN 123 THEN 1 WHEN 321 THEN 2 WHEN 213 THEN 3 "
            "WHEN 312 THEN 3 WHEN 132 THEN 4 WHEN 231 THEN 4 ELSE 0 END AS INTEGER) "
            "AS tcvolprofile, acf_05_bws, acf_1_bws, acf_2_bws FROM coded",
        ),
    ]


PROPS = "tickscnt, frmconfpeak, sps, sms, tcvolprofile, acf_05_bws, acf_1_bws, acf_2_bws"


def forms(mapping="dense", width=DENSE_W, deep=DEEP, lags=LAGS):
    """Complete forms, typed."""
    return [
        *features(mapping, width, deep, lags),
        (
            "forms",
            f"SELECT k.ticker_id, k.ddate, k.bar_width_sec, f.ts_begin, k.ts_end, k.log_oe, "
            f"k.res_type, CAST({deep} AS INTEGER) AS formdeepkoef, {PROPS} FROM kept k "
            "JOIN features f USING (ticker_id, bar_width_sec, ts_end) WHERE f.ts_begin <> 0 AND "
            f"k.ts_end - f.ts_begin >= 1000 * {deep - 1} * bar_width_sec::BIGINT",
        ),
    ]


def earlier(mapping="sparse", width=SPARSE_W):
    """State of an incremental build that stopped at the split day."""
    return [
        *ticks(mapping),
        all_items(width),
        ("old_ticks", f"SELECT * FROM ticks WHERE ddate <= DATE '{SPLIT_DAY}'"),
        (
            "old_grids",
            "SELECT * FROM items JOIN (SELECT ticker_id, min(db_tsunx) AS t_first, "
            "max(db_tsunx) AS t_last FROM old_ticks GROUP BY 1) USING (ticker_id)",
        ),
        *bars_on_grid("old", "old_grids", "old_ticks"),
        (
            "edges",
            "SELECT ticker_id, arg_min(db_tsunx, (ddate, ts, db_tsunx)) AS first_ts, "
            "arg_max(db_tsunx, (ddate, ts, db_tsunx)) AS last_tick_ts FROM ticks GROUP BY 1",
        ),
        (
            "newest",
            "SELECT ticker_id, bar_width_sec, arg_max(ts_end, (ddate, ts_end)) "
            "AS last_bar_ts_end FROM old GROUP BY 1, 2",
        ),
        (
            "points",
            "SELECT *, last_tick_ts // 1000 - begin_from // 1000 AS lag_sec FROM (SELECT "
            "i.ticker_id, i.bar_width_sec, last_bar_ts_end, first_ts, last_tick_ts, "
            "coalesce(last_bar_ts_end, first_ts, last_tick_ts, 0) AS begin_from FROM items i "
            "LEFT JOIN newest USING (ticker_id, bar_width_sec) LEFT JOIN edges USING (ticker_id))",
        ),
        (
            "started",
            "SELECT p.*, (SELECT min(db_tsunx) FROM ticks t WHERE t.ticker_id = p.ticker_id AND "
            "t.db_tsunx >= p.begin_from) AS first_read FROM points p",
        ),
        (
            "spanned",
            "SELECT s.*, (SELECT min(db_tsunx) FROM ticks t WHERE t.ticker_id = s.ticker_id AND "
            "t.db_tsunx >= coalesce(s.first_read, s.begin_from) + s.bar_width_sec::BIGINT * 1000)"
            f" AS span_at, least(begin_from + {STEP_MS}, last_tick_ts) AS planned FROM started s",
        ),
        (
            "windows",
            "SELECT ticker_id, bar_width_sec, begin_from, first_read, CAST(planned + "
            f"ceil(greatest(coalesce(span_at, last_tick_ts) - planned, 0) / {STEP_MS}) * {STEP_MS}"
            " AS BIGINT) AS read_to FROM spanned",
        ),
    ]


def resumed():
    return [
        *earlier(),
        (
            "grids",
            "SELECT w.ticker_id, w.bar_width_sec, min(db_tsunx) AS t_first, max(db_tsunx) "
            "AS t_last FROM windows w JOIN ticks t ON t.ticker_id = w.ticker_id AND t.db_tsunx "
            "BETWEEN w.begin_from AND w.read_to GROUP BY 1, 2",
        ),
        *bars_on_grid(),
    ]


def form_marks():
    return [
        *forms(),
        ("early", f"SELECT * FROM forms WHERE ddate <= DATE '{SPLIT_DAY}'"),
        (
            "per_key",
            "SELECT ticker_id, bar_width_sec, log_oe, res_type, max(ddate) AS d, "
            "max(ts_end) AS t FROM early GROUP BY ALL",
        ),
        (
            "per_way",
            "SELECT ticker_id, bar_width_sec, res_type, arg_min(d, (t, d)) AS d, min(t) AS t "
            "FROM per_key GROUP BY ALL",
        ),
        (
            "per_series",
            "SELECT ticker_id, bar_width_sec, count(*) AS ways, arg_min(d, (t, d)) AS d, "
            "min(t) AS t FROM per_way GROUP BY ALL",
        ),
        (
            "marks",
            "SELECT s.ticker_id, s.bar_width_sec, CASE WHEN ways = 2 THEN d END AS mark_ddate, "
            "CASE WHEN ways = 2 THEN t END AS mark_ts FROM (SELECT DISTINCT ticker_id, "
            "bar_width_sec FROM fa) s LEFT JOIN per_series USING (ticker_id, bar_width_sec)",
        ),
    ]


def labelled(columns, mx=1, mn=2, other=3):
    code = "frmconfpeak"
    return (
        "labelled",
        f"SELECT CAST(CASE res_type WHEN 'mx' THEN {mx} WHEN 'mn' THEN {mn} ELSE {other} END "
        f"AS DOUBLE) AS label, {columns}, round({code} / 100) AS f1, "
        f"round(({code} - round({code} / 100) * 100) / 10) AS f2, {code} % 10 AS f3 FROM forms",
    )


FEATURES = "frmconfpeak, sps, sms, tcvolprofile, acf_05_bws, acf_1_bws, acf_2_bws"
MAJORITY = (
    "majority",
    "SELECT label, frmconfpeak, f1, f2, f3 FROM (SELECT label, frmconfpeak, f1, f2, f3, "
    "count(*) AS cnt FROM labelled GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY "
    "frmconfpeak ORDER BY cnt DESC, label) = 1",
)
GUESSED = (
    "guessed",
    "SELECT l.frmconfpeak, l.label, m.label AS prediction FROM labelled l JOIN majority m "
    "USING (frmconfpeak)",
)
SPLIT_HASH = (
    "md5(concat_ws('|', '1234', ticker_id::VARCHAR, bar_width_sec::VARCHAR, ts_end::VARCHAR, "
    "res_type))"
)
# Below the hash at seven tenths of the sorted rows: training part.
PARTS = (
    "parts",
    f"SELECT *, CASE WHEN h < (SELECT {SPLIT_HASH} FROM forms ORDER BY 1 LIMIT 1 OFFSET "
    "(SELECT floor(count(*) * 0.7 + 0.5)::BIGINT FROM forms)) THEN 'train' ELSE 'test' END AS part "
    f"FROM (SELECT *, {SPLIT_HASH} AS h FROM forms)",
)
ELEMENTS = ["f1", "f2", "f3", "sps", "sms", "tcvolprofile", "acf_05_bws", "acf_1_bws", "acf_2_bws"]
SPARSE_FORMS = ("sparse", SPARSE_W)


def _trend(way, level=0.9):
    return (
        f"SELECT frmconfpeak, count(*) AS cnt, '{way}' AS res_type FROM forms WHERE sps > sms "
        f"AND res_type = '{way}' AND acf_05_bws > {level} AND acf_1_bws > {level} "
        f"AND acf_2_bws > {level} "
        "AND acf_05_bws > acf_1_bws AND acf_1_bws > acf_2_bws GROUP BY 1"
    )


def _rename(ctes, prefix):
    """The same expressions under prefixed names, so that two chains fit in one statement."""
    names = {n for n, _ in ctes}
    only_tables = re.compile(r"\b(FROM|JOIN)\s+(\w+)")

    def fix(text):
        return only_tables.sub(
            lambda m: f"{m[1]} {prefix}{m[2]}" if m[2] in names else m[0], text
        )

    return [(prefix + n, fix(t)) for n, t in ctes]


def _key_feature(columns):
    return query(features(), f"SELECT ticker_id, bar_width_sec, ts_end, {columns} FROM features")


def oracle():
    t, dense = ticks(), ticks("dense")
    interval = f"db_tsunx BETWEEN {BEGIN_MS} AND {END_MS}"
    form_columns = (
        f"ticker_id, ddate, bar_width_sec, ts_begin, ts_end, log_oe, res_type, formdeepkoef, {PROPS}"
    )
    return {
        "ticks_interval": query(t, f"SELECT * FROM ticks WHERE {interval}"),
        "ticks_whole_days": query(
            islands(),
            "SELECT t.* FROM ticks t JOIN (SELECT ticker_id, min(ts_end) AS a, max(ts_end) AS b, "
            "min(ddate) AS da, max(ddate) AS db FROM kept GROUP BY 1) k ON t.ticker_id = "
            "k.ticker_id AND t.db_tsunx BETWEEN a AND b AND t.ddate BETWEEN da AND db",
        ),
        "ticks_for_form": query(
            dense, f"SELECT * FROM ticks WHERE {interval} AND ddate <= DATE '2024-01-09'"
        ),
        "bars_of_keys": query(
            bars(),
            "SELECT * FROM bars QUALIFY ddate = max(ddate) OVER "
            "(PARTITION BY ticker_id, bar_width_sec)",
        ),
        "enabled_widths": query(
            [*t, bars_property()], "SELECT * FROM bars_property WHERE is_enabled = 1"
        ),
        "ticker_dictionary": query([TICKERS], "SELECT * FROM tickers"),
        "tick_counts_day": query(
            t, "SELECT ticker_id, ddate, count(*) AS ticks_count FROM ticks GROUP BY 1, 2"
        ),
        "counts_stored_twice": query(
            t,
            "SELECT ticker_id, ddate, count(DISTINCT (ts, db_tsunx)) AS ticks_count, "
            "arg_min(db_tsunx, (ts, db_tsunx)) AS first_ts, arg_max(db_tsunx, (ts, db_tsunx)) "
            "AS last_ts FROM ticks GROUP BY 1, 2",
        ),
        "tick_counts_total": query(
            t, "SELECT ticker_id, count(*) AS ticks_count FROM ticks GROUP BY 1"
        ),
        "tick_counts_joined": query(
            t,
            "SELECT d.*, ticks_total FROM (SELECT ticker_id, ddate, count(*) AS ticks_count FROM "
            "ticks GROUP BY 1, 2) d JOIN (SELECT ticker_id, count(*) AS ticks_total FROM ticks "
            "GROUP BY 1) USING (ticker_id)",
        ),
        "ticks_total": query(t, "SELECT count(*) AS total FROM ticks"),
        "form_keys": query(
            forms(*SPARSE_FORMS), "SELECT DISTINCT ticker_id, bar_width_sec FROM forms"
        ),
        "connector_flag": "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18, 2)) AS sval, "
        "CASE WHEN o_totalprice > 65000 THEN 1 ELSE 0 END AS cntrlparam FROM orders "
        "WHERE o_totalprice > 0",
        "catalog_scan": query(
            t, "SELECT ddate, count(*) AS cnt, max(ask) AS max_ask FROM ticks GROUP BY 1"
        ),
        "calendar_days": query(
            t,
            "SELECT ticker_id, CAST(unnest(generate_series(CAST(min(ddate) AS TIMESTAMP), "
            "CAST(max(ddate) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS ddate FROM ticks "
            "GROUP BY ticker_id",
        ),
        "first_tick": query(
            t,
            "SELECT ticker_id, min(ddate) AS first_ddate, arg_min(db_tsunx, (ddate, ts, "
            "db_tsunx)) AS first_ts FROM ticks GROUP BY 1",
        ),
        "last_tick": query(
            t,
            "SELECT ticker_id, max(ddate) AS last_tick_ddate, arg_max(db_tsunx, (ddate, ts, "
            "db_tsunx)) AS last_tick_ts FROM ticks GROUP BY 1",
        ),
        "last_bar": query(
            bars(),
            "SELECT ticker_id, bar_width_sec, max(ddate) AS last_bar_ddate, arg_max(ts_end, "
            "(ddate, ts_end)) AS last_bar_ts_end FROM bars GROUP BY 1, 2",
        ),
        "bar_day_range": query(
            bars(),
            "SELECT ticker_id, bar_width_sec, min(ddate) AS min_ddate, max(ddate) AS max_ddate "
            "FROM bars GROUP BY 1, 2",
        ),
        "outcome_days": query(
            outcomes(), "SELECT DISTINCT ticker_id, bar_width_sec, ddate FROM fa"
        ),
        "outcome_key_counts": query(
            outcomes(),
            "SELECT count(*) AS row_cnt, count(DISTINCT ticker_id) AS tickers, count(DISTINCT "
            "(ticker_id, bar_width_sec)) AS series, count(DISTINCT ddate) AS days FROM fa",
        ),
        "tickers_first_tick": query(
            [*t, TICKERS],
            "SELECT k.*, first_ddate, first_ts FROM tickers k LEFT JOIN (SELECT ticker_id, "
            "min(ddate) AS first_ddate, arg_min(db_tsunx, (ddate, ts, db_tsunx)) AS first_ts "
            "FROM ticks GROUP BY 1) USING (ticker_id)",
        ),
        "tickers_with_widths": query(
            [*t, TICKERS, bars_property()],
            "SELECT * FROM tickers WHERE ticker_id IN (SELECT ticker_id FROM bars_property)",
        ),
        "work_items": query(
            [*t, TICKERS, bars_property(), ENABLED_ITEMS], "SELECT * FROM items"
        ),
        "bars_ohlc": query(bars(), "SELECT * FROM bars"),
        "bars_ohlc_dense": query(bars("dense", 3600), "SELECT * FROM bars"),
        "bars_ohlc_multi_width": query(
            [*t, TICKERS, bars_property(), ENABLED_ITEMS, SPANS, GRIDS, *bars_on_grid()],
            "SELECT * FROM bars",
        ),
        "bars_dates_summary": query(
            bars(),
            "SELECT ticker_id, bar_width_sec, ddate, count(*) AS cnt, min(ts_end) AS ts_end_min, "
            "max(ts_end) AS ts_end_max FROM bars GROUP BY 1, 2, 3",
        ),
        "bars_stored": query(bars(), "SELECT * FROM bars"),
        "bars_streamed": query(bars(), "SELECT * FROM bars"),
        "resume_points": query(earlier(), "SELECT * FROM points"),
        "read_windows": query(earlier(), "SELECT * FROM windows"),
        "bars_resume_step": query(resumed(), "SELECT * FROM bars"),
        "outcomes_first_hit": query([*bars(), *hits()], "SELECT * FROM hits"),
        "outcomes_first_hit_dense": query(
            [*bars("dense", DENSE_W), *hits()], "SELECT * FROM hits"
        ),
        "outcomes_resolved": query(outcomes(), "SELECT * FROM fa"),
        "outcomes_two_runs": query(outcomes(), "SELECT * FROM fa"),
        "outcomes_by_type": query(
            [*bars(), *hits()], "SELECT log_oe, res_type, count(*) AS cnt FROM hits GROUP BY 1, 2"
        ),
        "outcomes_resume": query(
            outcomes(),
            "SELECT b.* FROM bars b LEFT JOIN (SELECT ticker_id, bar_width_sec, max(ddate) AS d "
            f"FROM fa WHERE ddate <= DATE '{SPLIT_DAY}' GROUP BY 1, 2) f USING (ticker_id, "
            "bar_width_sec) WHERE d IS NULL OR ddate >= d",
        ),
        "outcomes_latest_day": query(
            bars(),
            "SELECT * FROM bars QUALIFY ddate = max(ddate) OVER "
            "(PARTITION BY ticker_id, bar_width_sec)",
        ),
        "islands": query(islands(), "SELECT * FROM islands"),
        "islands_last": query(islands(), "SELECT * FROM kept"),
        "form_ticks": query(
            form_ticks(),
            "SELECT ticker_id, bar_width_sec, ts_end, ts, db_tsunx, ask, bid FROM ft",
        ),
        "form_features": query(features(), "SELECT * FROM features"),
        "form_counts": _key_feature("tickscnt, ts_begin"),
        "form_conf_peak": _key_feature("frmconfpeak"),
        "form_price_peak": _key_feature("peak_price"),
        "form_step_mass": _key_feature("sps, sms"),
        "form_volume_profile": _key_feature("tcvolprofile"),
        "form_acf": _key_feature("acf_05_bws, acf_1_bws, acf_2_bws"),
        "forms_complete": query(forms(), f"SELECT {form_columns} FROM forms"),
        "forms_sparse": query(forms(*SPARSE_FORMS), f"SELECT {form_columns} FROM forms"),
        "forms_map": query(forms(), f"SELECT {form_columns} FROM forms"),
        "forms_two_runs": query(forms(), f"SELECT {form_columns} FROM forms"),
        "form_high_water": query(
            forms(),
            "SELECT ticker_id, bar_width_sec, formdeepkoef, log_oe, res_type, max(ddate) AS "
            "max_ddate, max(ts_end) AS max_ts_end FROM forms GROUP BY ALL",
        ),
        "form_resume": query(form_marks(), "SELECT * FROM marks"),
        "fa_since_mark": query(
            form_marks(),
            "SELECT fa.* FROM fa LEFT JOIN marks USING (ticker_id, bar_width_sec) WHERE "
            "mark_ddate IS NULL OR (ddate >= mark_ddate AND ts_end > mark_ts)",
        ),
        "label_digits": query([*forms(), labelled(FEATURES)], "SELECT * FROM labelled"),
        "label_digits_from_zero": query(
            [*forms(), labelled("frmconfpeak", 1, 0, 2)], "SELECT * FROM labelled"
        ),
        "majority_label": query(
            [*forms(), labelled("frmconfpeak"), MAJORITY], "SELECT * FROM majority"
        ),
        "label_counts": query(
            [*forms(), labelled(FEATURES)],
            "SELECT label, count(*) AS cnt FROM labelled GROUP BY 1",
        ),
        "forms_by_ticker": query(
            forms(*SPARSE_FORMS),
            "SELECT ticker_id, count(*) AS forms_cnt FROM forms GROUP BY 1",
        ),
        "conf_by_type": query(
            forms(),
            "SELECT frmconfpeak, res_type, count(*) AS forms_cnt FROM forms GROUP BY 1, 2",
        ),
        "conf_counts": query(
            forms(), "SELECT frmconfpeak, count(*) AS forms_cnt FROM forms GROUP BY 1"
        ),
        "type_counts_for_code": query(
            forms(),
            "SELECT res_type, count(*) AS cnt FROM forms WHERE frmconfpeak = 333 GROUP BY 1",
        ),
        "strong_trend_forms": query(
            forms(*SPARSE_FORMS), f"{_trend('mx')} UNION ALL {_trend('mn')}"
        ),
        "falling_trend_forms": query(
            forms(*SPARSE_FORMS), f"{_trend('mx', -1)} UNION ALL {_trend('mn', -1)}"
        ),
        "forms_time_span": query(
            forms(),
            "SELECT ticker_id, bar_width_sec, ts_begin, ts_end, strftime(make_timestamp(ts_end * "
            "1000), '%d-%m-%Y') AS ts_end_ddate, (ts_end - ts_begin) / 1000 AS ts_eb_secs "
            "FROM forms",
        ),
        "forms_union": query(
            [*_rename(forms(), "d_"), *_rename(forms(*SPARSE_FORMS), "s_")],
            "SELECT 'dense' AS src, res_type, count(*) AS cnt FROM d_forms GROUP BY 2 UNION ALL "
            "SELECT 'sparse' AS src, res_type, count(*) AS cnt FROM s_forms GROUP BY 2",
        ),
        "prediction_hits": query(
            [*forms(), labelled("frmconfpeak"), MAJORITY],
            "SELECT sum(CASE WHEN l.label = m.label THEN 1 END)::BIGINT AS right_cnt, "
            "sum(CASE WHEN l.label <> m.label THEN 1 END)::BIGINT AS wrong_cnt "
            "FROM labelled l JOIN majority m USING (frmconfpeak)",
        ),
        "sql_transform": query(
            [*forms(), labelled(FEATURES)],
            "SELECT * REPLACE (CAST(label AS INTEGER) AS label) FROM labelled",
        ),
        "string_index": query(
            forms(),
            "SELECT code, CAST(row_number() OVER (ORDER BY cnt DESC, code) - 1 AS DOUBLE) AS "
            "code_index, cnt FROM (SELECT CAST(frmconfpeak AS VARCHAR) AS code, count(*) AS cnt "
            "FROM forms GROUP BY 1)",
        ),
        "split_counts": query(
            [*forms(), PARTS],
            "SELECT part, count(*) AS cnt, sum(ticker_id)::BIGINT AS ticker_sum, min(ts_end) AS "
            "first_end, max(ts_end) AS last_end FROM parts GROUP BY 1",
        ),
        "mlp_test_rows": query(
            [*forms(), PARTS],
            "SELECT CASE res_type WHEN 'mx' THEN 1.0::DOUBLE ELSE 2.0 END AS label, count(*) AS cnt, "
            "count(*) AS scored_cnt, count(*) AS whole_cnt FROM parts WHERE part = 'test' GROUP BY 1",
        ),
        "mlp_ticker_forms": query(
            [*forms(*SPARSE_FORMS), TICKERS],
            "SELECT t.ticker_id, count(f.ticker_id) AS forms_cnt, count(f.ticker_id) > 0 AS is_scored "
            "FROM tickers t LEFT JOIN forms f USING (ticker_id) GROUP BY 1",
        ),
        "getprob_totals": query(
            forms(),
            "SELECT frmconfpeak, count(*) AS cnt, count(*)::DOUBLE AS total FROM forms GROUP BY 1",
        ),
        "logreg_reloaded": query(
            forms(),
            "SELECT res_type, CAST(row_number() OVER (ORDER BY cnt DESC, res_type) - 1 AS DOUBLE) AS "
            "label, cnt, cnt AS same_cnt FROM (SELECT res_type, count(*) AS cnt FROM forms GROUP BY 1)",
        ),
        "results_stored": query(
            [*forms(), labelled("frmconfpeak"), MAJORITY, GUESSED],
            "SELECT frmconfpeak, label, prediction, count(*) AS cnt FROM guessed GROUP BY ALL",
        ),
        "libsvm_features": query(
            [*forms(), labelled(FEATURES)],
            " UNION ALL ".join(
                f"SELECT label, {i}::INTEGER AS element, count(*) AS cnt, min({c})::DOUBLE AS smallest, "
                f"max({c})::DOUBLE AS largest, count(*) FILTER ({c} = 0) AS zeros FROM labelled GROUP BY 1"
                for i, c in enumerate(ELEMENTS)
            ),
        ),
        "forms_limited": query(
            forms(),
            "SELECT ticker_id, bar_width_sec, ts_end, log_oe, res_type, ts_end - ts_begin AS span_ms "
            "FROM forms ORDER BY span_ms DESC, ticker_id, bar_width_sec, ts_end, log_oe, res_type LIMIT 10",
        ),
    }
