"""The expected result of each registered query as SQL over the same tables.

Written from the definition of each operator, with other means than the Spark plans use (joins
per block, unpivoted grids, window ranks), so agreement says something."""

from __future__ import annotations

from ledgerfold.plans.views import CODES, MART_V1, MART_V2

D = 6


def r(x: str, name: str) -> str:
    return f"round(CAST({x} AS DOUBLE), {D}) + 0e0 AS {name}"


H = """h AS (
 SELECT l_orderkey AS id, l_linenumber AS rn,
  CAST(l_linenumber AS BIGINT) * 4503599627370496 + ((l_partkey % 1000003) * 2000000011 + (l_suppkey % 1000003) * 1000000007
   + CAST(round(l_extendedprice * 100) AS BIGINT) * 9999991 + CAST(floor(l_quantity) AS BIGINT) * 7368787
   + CAST(round(l_discount * 100) AS BIGINT) * 15485863 + CAST(round(l_tax * 100) AS BIGINT) * 3276509
   + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END * 99991
   + CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END * 7919) % 4503599627370496 AS seq,
  CAST(round(l_discount * 100) AS INTEGER) AS pre_disc, CAST(round(l_tax * 100) AS INTEGER) AS pre_tax,
  CAST(floor(l_quantity / 5) AS INTEGER) AS pre_qty,
  CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE CAST(l_partkey % 7 AS INTEGER) END AS pre_part,
  CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS INTEGER) AS enc_ret,
  CAST(CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS INTEGER) AS enc_stat,
  l_discount <= 0.03 AS is_zero_a, l_tax <= 0.02 AS is_zero_b, l_quantity < 40 AS is_zero_c,
  l_returnflag = 'R' AS pclose_flag, l_linestatus = 'F' AS fclose_flag,
  CAST(round(l_discount * 100) AS INTEGER) % 5 AS grid_0, CAST(round(l_tax * 100) AS INTEGER) % 5 AS grid_1,
  CAST(floor(l_quantity / 5) AS INTEGER) % 5 AS grid_2,
  CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE CAST(l_partkey % 7 AS INTEGER) % 5 END AS grid_3,
  CAST(l_partkey % 5 AS INTEGER) AS grid_4,
  CASE WHEN l_linenumber > 5 THEN NULL ELSE CAST(l_suppkey % 5 AS INTEGER) END AS grid_5
 FROM lineitem)"""
T = "t AS (SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS INTEGER) AS flag FROM orders)"
S = """s0 AS (SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS INTEGER) AS actual,
  ((o_orderkey * 7919 + CAST(floor(o_totalprice) AS BIGINT)) % 1000) / CAST(1000 AS DOUBLE) AS p,
  o_orderpriority, o_orderstatus, o_custkey, o_totalprice FROM orders),
 s AS (SELECT *, CAST(p > 0.5 AS INTEGER) AS predicted FROM s0),
 e AS (SELECT *, CAST(actual <> predicted AS INTEGER) AS is_error,
  CASE WHEN actual = 1 THEN 1 - p ELSE p END AS confidence_mistake FROM s)"""
RES = """q AS (SELECT *, floor(o_totalprice / 1000) * CAST(1000 AS DOUBLE) + o_orderkey % 300 AS guess FROM orders),
 res AS (SELECT *, guess - o_totalprice AS error, abs(guess - o_totalprice) AS abs_error FROM q)"""
LIN = S + """, lin AS (SELECT *, o_totalprice / CAST(100000 AS DOUBLE) AS x1, CAST(o_custkey % 100 AS DOUBLE) AS x2,
  CAST(id % 10 AS DOUBLE) AS x3 FROM e)"""
CT = """ct AS (SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS INTEGER) AS flag,
  CASE WHEN o_orderkey % 7 <> 0 THEN 'b' || CAST(o_custkey % 9 AS VARCHAR) END AS brand, o_orderpriority AS prio, o_custkey AS cust,
  CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS price_num,
  o_totalprice * CASE WHEN o_orderkey % 50 = 0 THEN CAST(20 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END - 1000 AS bal_num,
  CASE WHEN o_orderkey % 20 = 0 THEN o_totalprice END AS none_num, 'same' AS const, CAST(o_custkey % 12 AS INTEGER) AS few FROM orders)"""
CLEAN_COLS = ["brand", "prio", "cust", "price_num", "bal_num", "none_num", "const", "few"]
STAT_COLS = list(MART_V2.coded)


def split_of(id_expr: str, test: str = "33333333", val: str = "4ccccccc") -> str:
    h = f"substr(md5(concat(CAST({id_expr} AS VARCHAR), '|42')), 1, 8)"
    return f"CASE WHEN {h} < '{test}' THEN 'test' WHEN {h} < '{val}' THEN 'val' ELSE 'train' END"


def q(ctes: list[str] | str, body: str) -> str:
    ctes = [ctes] if isinstance(ctes, str) else ctes
    return "WITH " + ",\n".join(ctes) + "\n" + body


def hist(body: str, *more: str) -> str:
    return q([H, *more], body)


def per_id(cols: list[str], *more: str, src: str = "h") -> str:
    return hist(f"SELECT id, {', '.join(cols)} FROM {src} GROUP BY id", *more)


def flag(f: str) -> str:
    return f"CAST({f} AS INTEGER)"


def off(f: str) -> str:
    return f"CAST(NOT {f} AS INTEGER)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


# --- fragments shared by block queries and marts ---

def counts():
    return ["count(*) AS loans_total_count", "max(rn) AS loans_max_rn"]


def snaps(cols, which):
    way = "DESC" if which == "last" else "ASC"
    return [f"first({c} ORDER BY seq {way}) AS {which}_{c}" for c in cols]


def shares(flags, ever):
    return [r(f"avg({flag(f)})", f"{f}_share") for f in flags] + [f"max({off(f)}) AS {n}" for n, f in ever.items()]


def distinct(cols):
    return [f"count(DISTINCT {c}) AS distinct_{c}_count" for c in cols]


def changed(cols):
    return [f"count(DISTINCT {c}) > 1 AS {c}_ever_changed" for c in cols]


def eq(cols):
    return [f"first({c} ORDER BY seq) = first({c} ORDER BY seq DESC) AS {c}_first_eq_last" for c in cols]


def text(cols):
    return [f"string_agg(CAST({c} AS VARCHAR), '' ORDER BY seq) AS {c}_bin_sequence" for c in cols]


def mode_cte(cols, src="h", name="gm"):
    subs = [f"(SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM {src} WHERE {c} IS NOT NULL GROUP BY {c}) ORDER BY n DESC, v LIMIT 1) AS m_{c}" for c in cols]
    return f"{name} AS (SELECT {', '.join(subs)})"


def gnd(cols):
    out = []
    for c in cols:
        d = f"CAST({c} <> m_{c} AS INTEGER)"
        out += [f"{big(f'sum({d})')} AS {c}_gnd_count", r(f"avg({d})", f"{c}_gnd_share")]
    return out


def local_ctes(cols):
    """One row per id with n, the largest count and the mode of each column."""
    out = []
    for c in cols:
        out.append(f"lc_{c} AS (SELECT id, sum(n) AS n, max(n) AS top, min(CASE WHEN rk = 1 THEN v END) AS mode FROM ("
                   f"SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, v) AS rk FROM ("
                   f"SELECT id, {c} AS v, count(*) AS n FROM h WHERE {c} IS NOT NULL GROUP BY id, {c})) GROUP BY id)")
    return out


def lnd(cols):
    out = []
    for c in cols:
        out += [f"{big(f'lc_{c}.n - lc_{c}.top')} AS {c}_lnd_count", r(f"(lc_{c}.n - lc_{c}.top) / CAST(lc_{c}.n AS DOUBLE)", f"{c}_lnd_share")]
    return out


def long_grid(src="h"):
    parts = [f"SELECT id, seq, {m} AS month, grid_{m} AS status FROM {src} WHERE grid_{m} IS NOT NULL" for m in range(6)]
    return "g AS (" + " UNION ALL ".join(parts) + ")"


ENTROPY = """en AS (SELECT id, sum(n * (n / CAST(big AS DOUBLE)) * ln(n / CAST(big AS DOUBLE))) AS entropy,
  -sum((n / CAST(big AS DOUBLE)) * ln(n / CAST(big AS DOUBLE))) AS shannon FROM
  (SELECT id, status, count(*) AS n, sum(count(*)) OVER (PARTITION BY id) AS big FROM g WHERE month <> 3 GROUP BY id, status) GROUP BY id)"""
REGULAR = f"""gr AS (SELECT id, {big('sum(CASE WHEN status NOT IN (0, 3) THEN 1 ELSE 0 END)')} AS paym_regular_outside_0_3_count,
  avg(CAST(status NOT IN (0, 3) AS INTEGER)) AS outside_share, max(CAST(status = 2 AS INTEGER)) AS paym_regular_ever_bin2
  FROM g WHERE month <> 3 GROUP BY id)"""
SPECIAL = f"""gs AS (SELECT id, {big('sum(CASE WHEN month = 3 AND status NOT IN (4, 1) THEN 1 ELSE 0 END)')} AS paym_special_outside_4_1_count,
  max(CASE WHEN month = 3 AND status = 3 THEN 1 ELSE 0 END) AS paym_special_ever_worst_bin3 FROM g GROUP BY id)"""
ROWS = """pl AS (SELECT *, lag(status) OVER (PARTITION BY id, seq ORDER BY month) AS prev FROM g),
 ps AS (SELECT id, seq, CAST(count(DISTINCT status) AS INTEGER) AS paym_row_nunique,
  CAST(sum(CAST(status <> prev AS INTEGER)) AS INTEGER) AS paym_row_change_count,
  first(status ORDER BY month) AS paym_row_first, first(status ORDER BY month DESC) AS paym_row_last,
  avg(CAST(status = 0 AS INTEGER)) AS paym_row_share_code_0, avg(CAST(status = 1 AS INTEGER)) AS paym_row_share_code_1,
  avg(CAST(status = 3 AS INTEGER)) AS paym_row_share_code_3, avg(CAST(status = 4 AS INTEGER)) AS paym_row_share_code_4
  FROM pl GROUP BY id, seq)"""


def grid_means():
    out = []
    for s in ("nunique", "change_count"):
        out += [r(f"avg(paym_row_{s})", f"paym_row_{s}_mean"), f"max(paym_row_{s}) AS paym_row_{s}_max"]
    return out + [r(f"avg(paym_row_{x})", f"paym_row_{x}_mean") for x in ("first", "last", "share_code_0", "share_code_1", "share_code_3", "share_code_4")]


def base():
    out = ["count(*) AS num_credits", "max(rn) AS max_rn", "min(rn) AS min_rn", "max(rn) - min(rn) AS rn_span",
           "CAST(count(*) = 1 AS INTEGER) AS is_single_credit", r("count(*) / CAST(nullif(max(rn), 0) AS DOUBLE)", "rn_density")]
    for f in MART_V2.flags:
        out += [r(f"avg({flag(f)})", f"{f}_share"), f"max({flag(f)}) AS {f}_any"]
    return out


def overdue():
    out = []
    for n, f in MART_V2.overdue.items():
        out += [r(f"avg({flag(f)})", f"{n}_zero_share"), f"max({off(f)}) AS {n}_has_overdue"]
    for n, f in MART_V2.usage.items():
        out += [r(f"avg({flag(f)})", f"{n}_zero_share"), f"max({off(f)}) AS {n}_has_nonzero"]
        if n in MART_V2.usage_counted:
            out.append(f"{big(f'sum({off(f)})')} AS {n}_nonzero_count")
    return out


def composite():
    out = []
    for n, fs in (("serious", MART_V2.serious), ("any", MART_V2.any)):
        c = "CASE WHEN " + " OR ".join(f"NOT {f}" for f in fs) + " THEN 1 ELSE 0 END"
        out += [f"max({c}) AS has_{n}_overdue", f"{big(f'sum({c})')} AS count_{n}_overdue", r(f"avg({c})", f"share_{n}_overdue")]
    c = "CASE WHEN " + " OR ".join(f"NOT {f}" for f in MART_V2.serious) + " THEN 1 ELSE 0 END"
    return out + [r(f"sum({c}) / CAST(nullif(sum({off(MART_V2.mild)}), 0) AS DOUBLE)", "serious_to_mild_ratio")]


def lagged(cols, src="h"):
    return f"hl AS (SELECT *, {', '.join(f'lag({c}) OVER (PARTITION BY id ORDER BY seq) AS prev_{c}' for c in cols)} FROM {src})"


def chg(c):
    return f"CAST({c} <> prev_{c} AS INTEGER)"


def stats_ctes(src: str, cols, extra=()):
    parts = [f"SELECT '{c}' AS feature, {c} AS value FROM {src} WHERE {c} IS NOT NULL" for c in cols]
    names = ", ".join(f"('{c}')" for c in [*cols, *extra])
    return [
        f"vc AS (SELECT feature, value, count(*) AS cnt FROM ({' UNION ALL '.join(parts)}) GROUP BY feature, value)",
        "tot AS (SELECT feature, sum(cnt) AS total FROM vc GROUP BY feature)",
        "md AS (SELECT feature, value AS mode_value FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY cnt DESC, value) AS k FROM vc) WHERE k = 1)",
        "rare AS (SELECT vc.feature, string_agg(CAST(vc.value AS VARCHAR), ',' ORDER BY vc.value) AS rare_text FROM vc JOIN tot USING (feature) "
        "JOIN md USING (feature) WHERE cnt / CAST(total AS DOUBLE) < 0.05 AND vc.value <> mode_value GROUP BY vc.feature)",
        f"names(feature) AS (VALUES {names})",
        "stats AS (SELECT names.feature, coalesce(mode_value, -999) AS mode_value, coalesce(rare_text, '-999') AS rare_text "
        "FROM names LEFT JOIN md USING (feature) LEFT JOIN rare USING (feature))",
    ]


TRAIN = f"tr AS (SELECT * FROM h WHERE ({split_of('id')}) = 'train')"
ALL_STATS = "SELECT feature, mode_value, rare_text FROM stats"


def m_of(c):
    return f"(SELECT mode_value FROM stats WHERE feature = '{c}')"


def rare_of(c):
    return f"list_contains(string_split((SELECT rare_text FROM stats WHERE feature = '{c}'), ','), CAST({c} AS VARCHAR))"


def is_mode(c):
    return f"CAST(coalesce({c} = {m_of(c)}, false) AS INTEGER)"


def is_rare(c):
    return f"CAST(coalesce({rare_of(c)}, false) AS INTEGER)"


def coded():
    out = []
    for c, wanted in MART_V2.coded.items():
        made = {
            "nunique": f"count(DISTINCT {c}) AS {c}_nunique", "first": f"first({c} ORDER BY seq) AS {c}_first",
            "last": f"first({c} ORDER BY seq DESC) AS {c}_last", "change_count": f"{big(f'sum({chg(c)})')} AS {c}_change_count",
            "changed_ever": f"max({chg(c)}) AS {c}_changed_ever", "share_global_mode": r(f"avg({is_mode(c)})", f"{c}_share_global_mode"),
            "share_rare_bins": r(f"avg({is_rare(c)})", f"{c}_share_rare_bins")}
        out += [made[f] for f in MART_V2.order_of_features if f in wanted]
    return out


def rows(*cols: str) -> str:
    return hist(f"SELECT id, seq, {', '.join(cols)} FROM h")


def mart_v1() -> str:
    m = MART_V1
    blocks = [*counts(), *snaps(m.last, "last"), *snaps(m.first, "first"), *shares(m.shares, m.ever_off), *distinct(m.distinct),
              *changed(m.sequences), *eq(m.first_eq_last), *text(m.sequences)]
    body = f"""SELECT a.*, b.* EXCLUDE (id), {', '.join(lnd(m.local))}, {r('en.entropy', 'paym_regular_entropy')},
  gr.paym_regular_outside_0_3_count, {r('gr.outside_share', 'paym_regular_outside_0_3_share')}, gr.paym_regular_ever_bin2,
  gs.* EXCLUDE (id), t.flag
 FROM (SELECT id, {', '.join(blocks)} FROM h GROUP BY id) a
 LEFT JOIN (SELECT id, {', '.join(gnd(m.coded))} FROM h, gm GROUP BY id) b ON a.id = b.id
 {' '.join(f'LEFT JOIN lc_{c} ON a.id = lc_{c}.id' for c in m.local)}
 LEFT JOIN en ON a.id = en.id LEFT JOIN gr ON a.id = gr.id LEFT JOIN gs ON a.id = gs.id LEFT JOIN t ON a.id = t.id"""
    return hist(body, T, mode_cte(m.coded), *local_ctes(m.local), long_grid(), ENTROPY, REGULAR, SPECIAL)


def mart_v2() -> str:
    changing = [c for c, f in MART_V2.coded.items() if "change_count" in f or "changed_ever" in f]
    body = f"""SELECT a.*, p.* EXCLUDE (id), c.* EXCLUDE (id), t.flag
 FROM (SELECT id, {', '.join([*base(), *overdue(), *composite()])} FROM h GROUP BY id) a
 LEFT JOIN (SELECT id, {', '.join(grid_means())} FROM ps GROUP BY id) p ON a.id = p.id
 LEFT JOIN (SELECT id, {', '.join(coded())} FROM hl GROUP BY id) c ON a.id = c.id LEFT JOIN t ON a.id = t.id"""
    return hist(body, T, TRAIN, *stats_ctes("tr", STAT_COLS), long_grid(), ROWS, lagged(changing))


SMALL = f"""sm AS (SELECT id, avg({is_mode('pre_disc')}) AS g1, avg({is_mode('pre_part')}) AS g2, avg({is_rare('pre_qty')}) AS r1, avg({is_rare('pre_disc')}) AS r2,
  avg(CASE WHEN NOT is_zero_a OR NOT is_zero_b THEN 1 ELSE 0 END) AS serious,
  avg(CASE WHEN NOT is_zero_a OR NOT is_zero_b OR NOT is_zero_c THEN 1 ELSE 0 END) AS anyo,
  first(pre_part ORDER BY seq) AS pf, first(pre_part ORDER BY seq DESC) AS pl_, first(enc_ret ORDER BY seq) AS rf,
  first(enc_ret ORDER BY seq DESC) AS rl, first(pre_disc ORDER BY seq DESC) AS dl, count(DISTINCT enc_ret) AS rn_, count(*) AS n
  FROM h GROUP BY id)"""


def small(body: str) -> str:
    return hist(body, TRAIN, *stats_ctes("tr", STAT_COLS), long_grid(), ROWS, SMALL)


def code(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), '-999')"


# the cleaning rules on the training part: which columns go, tops, medians, bounds
def clean_ctes():
    train = f"tr AS (SELECT * FROM ct WHERE ({split_of('id')}) = 'train')"
    tops = []
    for c in ("brand", "prio", "few"):
        tops.append(f"top_{c} AS (SELECT v FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM tr WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 3)")
    num = []
    for c in ("cust", "price_num", "bal_num"):
        num.append(f"b_{c} AS (SELECT median({c}) AS med, quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo, "
                   f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi FROM tr)")
    return [CT, train, *tops, *num]


def cat_value(c):
    return f"CASE WHEN CAST({c} AS VARCHAR) IN (SELECT v FROM top_{c}) THEN CAST({c} AS VARCHAR) ELSE 'other_collapsed' END AS {c}"


def num_value(c, clip=True):
    x = f"coalesce(CAST({c} AS DOUBLE), (SELECT med FROM b_{c}))"
    return r(f"least(greatest({x}, (SELECT lo FROM b_{c})), (SELECT hi FROM b_{c}))" if clip else x, c)


CLEANED = [*clean_ctes(), f"cleaned AS (SELECT id AS key, flag, {cat_value('brand')}, {cat_value('prio')}, {num_value('cust')}, {num_value('price_num')}, {num_value('bal_num')}, {cat_value('few')} FROM ct)"]

TX = "tx AS (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 11 <> 0 THEN p_type END AS p_type, CAST(p_size AS VARCHAR) AS p_size FROM part)"
TXT = [TX, "tk AS (SELECT p_partkey, p_brand || '|' || p_size AS p_brand, p_type FROM tx)",
       f"trn AS (SELECT * FROM tk WHERE {split_of('p_partkey')} = 'train')"]
MODEL = ["cnt AS (SELECT l_orderkey AS id, count(*) AS n FROM lineitem GROUP BY l_orderkey)",
         f"md AS (SELECT id, CAST(n > 3 AS INTEGER) AS many, CASE WHEN n <= 2 THEN 0 WHEN n <= 5 THEN 1 ELSE 2 END AS kind, {split_of('id')} AS split FROM cnt)"]


def text_counts(cols, n):
    parts = [f"SELECT '{c}' AS feature, {c} AS value FROM tx WHERE {c} IS NOT NULL" for c in cols]
    return [TX, f"vc AS (SELECT feature, value, count(*) AS cnt FROM ({' UNION ALL '.join(parts)}) GROUP BY feature, value)",
            f"tops AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY feature ORDER BY cnt DESC, value) AS INTEGER) AS rank FROM vc) WHERE rank <= {n})"]





def mi() -> str:
    cols = ["pre_disc", "pre_part", "enc_ret"]
    parts = " UNION ALL ".join(f"SELECT '{c}' AS feature, coalesce('v' || CAST({c} AS VARCHAR), 'n') AS value, flag FROM j" for c in cols)
    return hist(f"""SELECT feature, {r('sum(n / CAST(total AS DOUBLE) * ln(n * CAST(total AS DOUBLE) / (CAST(nx AS DOUBLE) * ny)))', 'mi')} FROM (
  SELECT *, sum(n) OVER (PARTITION BY feature, value) AS nx, sum(n) OVER (PARTITION BY feature, flag) AS ny, sum(n) OVER (PARTITION BY feature) AS total
  FROM (SELECT feature, value, flag, count(*) AS n FROM mm GROUP BY feature, value, flag)) GROUP BY feature""",
                T, "j AS (SELECT h.*, t.flag FROM h JOIN t ON h.id = t.id)", f"mm AS ({parts})")


def auc_sql(pairs: str) -> str:
    """AUC from ranks: the mean rank of positives, ties sharing their mean rank."""
    return (f"SELECT k, (sum(CASE WHEN y = 1 THEN rk END) - sum(y) * (sum(y) + 1) / CAST(2 AS DOUBLE)) / nullif(CAST(sum(y) AS DOUBLE) * (count(*) - sum(y)), 0) AS auc FROM ("
            f"SELECT k, y, rank() OVER (PARTITION BY k ORDER BY p) + (count(*) OVER (PARTITION BY k, p) - 1) / CAST(2 AS DOUBLE) AS rk FROM ({pairs})) GROUP BY k")


def ovr() -> str:
    parts = [f"SELECT '{c}' AS k, CAST(o_orderstatus = '{c}' AS INTEGER) AS y, ((id * {m} + CAST(floor(o_totalprice) AS BIGINT)) % 997) / CAST(997 AS DOUBLE) AS p FROM s"
             for c, m in (("F", 31), ("O", 57), ("P", 83))]
    return q(S, f"SELECT {r('avg(auc)', 'roc_auc_ovr')} FROM ({auc_sql(' UNION ALL '.join(parts))})")


REPORT = """lab AS (SELECT DISTINCT actual AS label FROM s UNION SELECT DISTINCT predicted FROM s),
 per AS (SELECT label, (SELECT count(*) FROM s WHERE actual = label) AS support, (SELECT count(*) FROM s WHERE predicted = label) AS claimed,
  (SELECT count(*) FROM s WHERE actual = label AND predicted = label) AS tp FROM lab),
 prf AS (SELECT *, CASE WHEN claimed > 0 THEN tp / CAST(claimed AS DOUBLE) ELSE 0 END AS pr, CASE WHEN support > 0 THEN tp / CAST(support AS DOUBLE) ELSE 0 END AS rc FROM per),
 f AS (SELECT *, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END AS f1 FROM prf)"""


def trends(src_cte, src, cols, k, aggs, keep):
    """Per column: the top-k categories, the rest as one."""
    parts = []
    for c in cols:
        parts.append(f"SELECT '{c}' AS feature, CASE WHEN {c} IN (SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM {src} WHERE {c} IS NOT NULL GROUP BY {c}) "
                     f"ORDER BY n DESC, v LIMIT {k}) THEN {c} ELSE '... OTHER ...' END AS category, {keep} FROM {src}")
    return q(src_cte, f"SELECT feature, category, {aggs} FROM ({' UNION ALL '.join(parts)}) GROUP BY feature, category")


def attribution(cols: dict) -> list[str]:
    return [f"SELECT '{c}' AS feature, {w} * ({c} - (SELECT avg({c}) FROM lin)) AS contribution, id FROM " for c, w in cols.items()]


def worst_of(label: int, way: str, kind: str, n: int = 5, extra: str = "") -> str:
    return f"(SELECT id, p, '{kind}' AS kind{extra} FROM e WHERE actual = {label} AND is_error = 1 ORDER BY p {way}, id LIMIT {n})"


FEATURES_VALUES = ", ".join(f"('{c}')" for c in CLEAN_COLS)


def distinct_of(c, src):
    return f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_distinct FROM {src}"


PROFILE_COLS = ["pre_part", "enc_ret", "grid_5"]
PROFILE = " UNION ALL ".join([
    "SELECT 'ids' AS metric, CAST(count(DISTINCT id) AS DOUBLE) AS value FROM j", "SELECT 'mean_of_mean_rn', avg(m) FROM (SELECT avg(rn) AS m FROM j GROUP BY id)",
    "SELECT 'ids_with_two_labels', CAST(count(*) AS DOUBLE) FROM (SELECT id FROM j GROUP BY id HAVING count(DISTINCT flag) > 1)",
    "SELECT 'rows', CAST(count(*) AS DOUBLE) FROM j", "SELECT 'label_share', avg(flag) FROM j",
    *[f"SELECT 'missing_pct_{c}', 100 * avg(CAST({c} IS NULL AS INTEGER)) FROM j" for c in PROFILE_COLS],
    "SELECT 'duplicate_rows', CAST((SELECT count(*) FROM j) - (SELECT count(*) FROM (SELECT DISTINCT * FROM j)) AS DOUBLE)",
    *[f"SELECT 'distinct_{c}', CAST(count(DISTINCT {c}) AS DOUBLE) FROM j" for c in PROFILE_COLS]])

BUCKETS = ("0.1", "0.3", "0.5", "0.7", "0.9", "1.0")


def oracle() -> dict[str, str]:
    o: dict[str, str] = {}
    # sources and sinks
    o["scan_parquet_glob"] = "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_orderkey IS NOT NULL"
    o["scan_csv_target"] = q(T, "SELECT * FROM t")
    o["sample_by_id"] = hist("SELECT id, seq, pre_disc FROM h WHERE abs(id) % 10000 / 100.0 <= 20")
    o["baseline_join_target"] = hist("SELECT h.* EXCLUDE (seq), t.flag FROM h LEFT JOIN t ON h.id = t.id", T)
    o["eda_slice"] = hist("SELECT h.id, pre_part, flag FROM h LEFT JOIN t ON h.id = t.id WHERE pre_part <> 1 OR pre_part IS NULL", T)
    o["write_predictions"] = q(S, "SELECT id, predicted, p FROM s")
    o["save_load_stats"] = o["incremental_stats"] = hist(ALL_STATS, *stats_ctes("h", STAT_COLS))
    o["feature_schema"] = hist("SELECT id, seq, rn, pre_disc, is_zero_a, pre_part FROM h")
    o["decimal_to_double"] = "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS price, o_orderkey * CAST(1.5 AS DOUBLE) AS half FROM orders"
    o["split_ids_scan"] = hist("SELECT id, first(enc_ret ORDER BY seq DESC) AS enc_ret FROM h GROUP BY id")
    o["filter_bad_rows"] = """WITH x AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 <> 0 THEN o_orderkey END AS a,
 CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS b, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS c FROM orders)
 SELECT * FROM x WHERE (CAST(id IS NULL AS INTEGER) + CAST(a IS NULL AS INTEGER) + CAST(b IS NULL AS INTEGER) + CAST(c IS NULL AS INTEGER)) / 4.0 <= 0.5"""
    o["select_by_pattern"] = rows("is_zero_a, is_zero_b, is_zero_c, grid_0, grid_1, grid_2, grid_3, grid_4, grid_5")
    o["select_except"] = hist(f"SELECT x.* EXCLUDE (rn) FROM (SELECT seq, rn, {', '.join(CODES)} FROM h) x")
    # scalars
    o["bool_to_int"] = rows("CAST(is_zero_a AS INTEGER) AS a", "CAST(NOT is_zero_b AS INTEGER) AS not_b")
    o["case_when_flags"] = rows("CASE WHEN NOT is_zero_a OR NOT is_zero_b OR NOT is_zero_c THEN 1 ELSE 0 END AS any_off")
    o["safe_ratio"] = rows(r("pre_disc / CAST(nullif(pre_tax, 0) AS DOUBLE)", "ratio"))
    o["regexp_month"] = hist("SELECT id, seq, month, value FROM (" + " UNION ALL ".join(
        f"SELECT id, seq, CAST(regexp_extract('grid_{m}', '[0-9]+') AS INTEGER) AS month, grid_{m} AS value FROM h" for m in range(6)) + ")")
    o["in_list"] = rows("pre_part IN (1, 2) AS is_in", "pre_part NOT IN (1, 2) AS not_in", "pre_part IN (0, 5) AS in_array")
    o["coalesce_false"] = rows("CAST(coalesce(pre_part = 3, false) AS INTEGER) AS hit")
    o["log_entropy_term"] = rows(r("-((pre_disc + 1) / CAST(11 AS DOUBLE)) * ln((pre_disc + 1) / CAST(11 AS DOUBLE))", "term"))
    o["concat_codes"] = rows(f"{code('pre_part')} || '_' || {code('pre_disc')} AS pair")
    x = "(pre_disc / CAST(nullif(pre_qty * 4, 0) AS DOUBLE))"
    o["bucket_label"] = rows(f"CASE WHEN {x} IS NULL THEN 'nan' WHEN {x} <= 0 THEN 'Clean' WHEN {x} <= CAST(0.2 AS DOUBLE) THEN 'Mild' ELSE 'Frequent' END AS bucket")
    o["row_mean"] = rows(r("list_avg([pre_part, grid_3, grid_5])", "mean"))
    o["threshold_flag"] = rows("CAST(coalesce(pre_part / CAST(6 AS DOUBLE) >= 0.95, false) AS INTEGER) AS high",
                               "CAST(coalesce(pre_part > 4, false) OR coalesce(grid_5 > 3, false) AS INTEGER) AS any_above")
    o["clip"] = rows("CASE WHEN pre_part IS NULL THEN NULL ELSE least(greatest(pre_part, 1), 5) END AS clipped")
    o["cast_to_category"] = rows("CAST(pre_part AS VARCHAR) AS category")
    # joins
    o["join_mart_blocks"] = hist(f"""SELECT a.*, b.last_pre_disc, c.is_zero_a_share, d.distinct_pre_part_count
 FROM (SELECT id, {', '.join(counts())} FROM h GROUP BY id) a LEFT JOIN (SELECT id, {snaps(['pre_disc'], 'last')[0]} FROM h GROUP BY id) b ON a.id = b.id
 LEFT JOIN (SELECT id, {shares(['is_zero_a'], {})[0]} FROM h GROUP BY id) c ON a.id = c.id
 LEFT JOIN (SELECT id, {distinct(['pre_part'])[0]} FROM h GROUP BY id) d ON a.id = d.id""")
    o["join_target_left"] = hist(f"SELECT a.*, flag FROM (SELECT id, {', '.join(counts())} FROM h GROUP BY id) a LEFT JOIN t ON a.id = t.id", T)
    o["join_train_ids_semi"] = hist(f"SELECT h.id, seq, pre_disc FROM h JOIN (SELECT id FROM t WHERE ({split_of('id')}) = 'train') i ON h.id = i.id", T)
    o["cross_join_global"] = hist("SELECT id, seq, m_pre_disc, pre_part <> m_pre_part AS off_part FROM h CROSS JOIN gm", mode_cte(["pre_disc", "pre_part"]))
    o["join_local_modes"] = hist("SELECT h.id, seq, lc_pre_disc.mode AS lm_pre_disc, pre_part <> lc_pre_part.mode AS off_part FROM h LEFT JOIN lc_pre_disc ON h.id = lc_pre_disc.id "
                                 "LEFT JOIN lc_pre_part ON h.id = lc_pre_part.id", *local_ctes(["pre_disc", "pre_part"]))
    o["isin_split"] = hist(f"SELECT id, seq FROM h WHERE id IN (SELECT id FROM t WHERE ({split_of('id')}) = 'val')", T)
    # first mart
    o["loan_counts"] = per_id(counts())
    o["last_snapshot"] = per_id(snaps(MART_V1.last, "last"))
    o["first_snapshot"] = per_id(snaps(MART_V1.first, "first"))
    o["flag_shares"] = per_id(shares(MART_V1.shares, MART_V1.ever_off))
    o["global_mode"] = hist("SELECT * FROM gm", mode_cte(CODES))
    lm = ["pre_disc", "pre_part", "enc_ret"]
    o["local_mode"] = hist("SELECT a.id, " + ", ".join(f"lc_{c}.mode AS lm_{c}" for c in lm) + " FROM (SELECT DISTINCT id FROM h) a "
                           + " ".join(f"LEFT JOIN lc_{c} ON a.id = lc_{c}.id" for c in lm), *local_ctes(lm))
    o["global_non_dominant"] = hist(f"SELECT id, {', '.join(gnd(['pre_disc', 'pre_part', 'enc_stat']))} FROM h, gm GROUP BY id", mode_cte(["pre_disc", "pre_part", "enc_stat"]))
    loc = MART_V1.local
    o["local_non_dominant"] = hist(f"SELECT a.id, {', '.join(lnd(loc))} FROM (SELECT DISTINCT id FROM h) a "
                                   + " ".join(f"LEFT JOIN lc_{c} ON a.id = lc_{c}.id" for c in loc), *local_ctes(loc))
    o["distinct_counts"] = per_id(distinct(CODES))
    o["bin_sequence"] = per_id(text(["pre_disc", "pre_part", "enc_ret"]))
    o["ever_changed"] = per_id(changed(MART_V1.sequences))
    o["first_eq_last"] = per_id(eq(MART_V1.first_eq_last))
    o["mart_v1"] = o["mart_v1_placed"] = mart_v1()
    # statistics
    st = stats_ctes("h", STAT_COLS)
    o["value_counts"] = hist(f"SELECT vc.feature, value, cnt, {big('total')} AS total_cnt FROM vc JOIN tot USING (feature)", *st)
    o["mode_per_feature"] = hist("SELECT feature, mode_value FROM md", *st)
    o["rare_bins"] = hist("SELECT md.feature, coalesce(rare_text, '') AS rare_text FROM md LEFT JOIN rare USING (feature)", *st)
    o["fit_population_stats"] = hist(ALL_STATS, TRAIN, *stats_ctes("tr", STAT_COLS, ["pre_none"]))
    o["inject_stats"] = hist(f"SELECT id, seq, {m_of('pre_disc')} AS m_pre_disc, {is_rare('pre_qty')} AS rare_qty FROM h", TRAIN, *stats_ctes("tr", STAT_COLS))
    # second mart
    o["base_counters"] = per_id(base())
    o["overdue_util"] = per_id(overdue())
    o["composite_overdue"] = per_id(composite())
    cc = ["pre_disc", "pre_part", "enc_ret"]
    o["change_count"] = per_id([f"{big(f'sum({chg(c)})')} AS {c}_change_count" for c in cc], lagged(cc), src="hl")
    ce = ["pre_tax", "pre_part"]
    o["changed_ever"] = per_id([f"max({chg(c)}) AS {c}_changed_ever" for c in ce], lagged(ce), src="hl")
    o["share_global_mode"] = per_id([r(f"avg({is_mode(c)})", f"{c}_share_global_mode") for c in ("pre_disc", "pre_part")]
                                    + [r(f"avg(CAST(pre_part = {m_of('pre_part')} AS INTEGER))", "pre_part_share_of_known")], TRAIN, *stats_ctes("tr", STAT_COLS))
    o["share_rare_bins"] = per_id([r(f"avg({is_rare(c)})", f"{c}_share_rare_bins") for c in ("pre_disc", "pre_qty", "pre_part")], TRAIN, *stats_ctes("tr", STAT_COLS))
    o["cat_nunique_first_last"] = per_id([x for c in ("pre_disc", "pre_part") for x in (
        f"count(DISTINCT {c}) AS {c}_nunique", f"first({c} ORDER BY seq) AS {c}_first", f"first({c} ORDER BY seq DESC) AS {c}_last")])
    o["mart_v2"] = o["mart_v2_placed"] = mart_v2()
    # grid
    o["unpivot_grid"] = hist("SELECT id, seq, month, status FROM g", long_grid())
    o["grid_entropy"] = hist(f"SELECT id, {r('entropy', 'grid_entropy')}, {r('shannon', 'grid_shannon')} FROM en", long_grid(), ENTROPY)
    o["grid_outside_normal"] = hist(f"SELECT gr.id, {r('entropy', 'paym_regular_entropy')}, paym_regular_outside_0_3_count, {r('outside_share', 'paym_regular_outside_0_3_share')} "
                                    "FROM gr JOIN en ON gr.id = en.id", long_grid(), ENTROPY, REGULAR)
    o["grid_ever_code"] = hist("SELECT id, paym_regular_ever_bin2 FROM gr", long_grid(), REGULAR)
    o["grid_special_months"] = hist("SELECT * FROM gs", long_grid(), SPECIAL)
    o["grid_row_stats"] = hist("SELECT id, seq, paym_row_nunique, paym_row_change_count, paym_row_first, paym_row_last, "
                               + ", ".join(r(f"paym_row_share_code_{v}", f"paym_row_share_code_{v}") for v in (0, 1, 3, 4)) + " FROM ps", long_grid(), ROWS)
    o["grid_entity_agg"] = hist(f"SELECT id, {', '.join(grid_means())} FROM ps GROUP BY id", long_grid(), ROWS)
    # windows
    o["row_number_dedup"] = hist("SELECT id, seq, pre_disc, pre_part, 'last' AS which FROM h QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1 "
                                 "UNION ALL SELECT id, seq, pre_disc, pre_part, 'first' FROM h QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq) = 1")
    o["lag_by_entity"] = hist("SELECT id, seq, prev_pre_disc, prev_pre_part FROM hl", lagged(["pre_disc", "pre_part"]))
    o["lag_by_entity_row"] = hist("SELECT id, seq, month, status, lag(status) OVER (PARTITION BY id, seq ORDER BY month) AS prev_status FROM g", long_grid())
    o["count_over_partition"] = rows("count(*) OVER (PARTITION BY id) AS n", "count(*) OVER (PARTITION BY id, pre_disc) AS n_same")
    o["sum_over_partition"] = rows("pre_disc", f"{big('sum(pre_disc) OVER (PARTITION BY id)')} AS disc_sum")
    o["max_by_over_partition"] = hist("SELECT feature, value, cnt, first_value(value) OVER (PARTITION BY feature ORDER BY cnt DESC, value) AS mode_value FROM vc", *st)
    # top-n and sets
    o["top_n_categories"] = q(text_counts(["p_brand", "p_type", "p_size"], 4), "SELECT feature, value, cnt, rank FROM tops")

    def keep3(c):
        return f"CASE WHEN {c} IN (SELECT value FROM tops WHERE feature = '{c}') THEN {c} ELSE 'other' END AS {c}"

    o["collapse_rare"] = q(text_counts(["p_brand", "p_type"], 3), f"SELECT p_partkey, {keep3('p_brand')}, {keep3('p_type')} FROM tx")
    o["worst_false_positives"] = q(S, worst_of(0, "DESC", "false_positive"))
    o["worst_false_negatives"] = q(S, worst_of(1, "ASC", "false_negative"))
    ex = ", round(confidence_mistake, 6) + 0e0 AS confidence_mistake"
    o["worst_predictions"] = q(S, f"SELECT * FROM {worst_of(0, 'DESC', 'false_positive', extra=ex)} UNION ALL SELECT * FROM {worst_of(1, 'ASC', 'false_negative', extra=ex)}")
    o["worst_residuals"] = q(RES, f"SELECT o_orderkey, {r('abs_error', 'abs_error')}, 'residual' AS kind FROM res ORDER BY res.abs_error DESC, o_orderkey LIMIT 10")
    w3 = {"x1": 0.7, "x2": -0.02, "x3": 0.1}
    imp = f"imp AS (SELECT feature, round(avg(abs(contribution)), 6) + 0e0 AS importance FROM ({' UNION ALL '.join(a + 'lin' for a in attribution(w3))}) GROUP BY feature)"
    o["importance_ranking"] = q([LIN, imp], "(SELECT *, 'top' AS kind FROM imp ORDER BY importance DESC, feature LIMIT 2) UNION ALL (SELECT *, 'worst' AS kind FROM imp ORDER BY importance, feature LIMIT 2)")
    o["split_disjoint_check"] = hist(f"""SELECT id, min(sp) AS first_split, max(sp) AS last_split FROM (
 SELECT id, CASE WHEN id % 100 = 0 AND rn = 1 THEN 'test' ELSE {split_of('id')} END AS sp FROM h) GROUP BY id HAVING count(DISTINCT sp) > 1""")
    o["distinct_ids"] = hist("SELECT DISTINCT id FROM h")
    o["last_label_per_id"] = hist("SELECT id, first(enc_stat ORDER BY seq DESC) AS enc_stat FROM h GROUP BY id")
    # splitting
    o["entity_split"] = rows(f"{split_of('id')} AS split")
    o["stratified_entity_split"] = q(T, """SELECT id, flag, CASE WHEN k <= round(n * CAST(0.2 AS DOUBLE)) THEN 'test'
 WHEN k <= round(n * CAST(0.2 AS DOUBLE)) + round(n * CAST(0.1 AS DOUBLE)) THEN 'val' ELSE 'train' END AS split FROM (
 SELECT id, flag, count(*) OVER (PARTITION BY flag) AS n,
  row_number() OVER (PARTITION BY flag ORDER BY md5(concat(CAST(id AS VARCHAR), '|42')), CAST(id AS VARCHAR)) AS k FROM t)""")
    # cleaning
    guard = ["brand", "prio", "cust", "few"]
    o["cardinality_guard"] = q(CT, "SELECT feature, n_distinct, NOT (feature IN ('cust', 'few') AND n_distinct > 100) AS is_category FROM ("
                               + " UNION ALL ".join(distinct_of(c, "ct") for c in guard) + ")")
    o["missing_fraction"] = q(CT, " UNION ALL ".join(f"SELECT '{c}' AS feature, {r(f'avg(CAST({c} IS NULL AS INTEGER))', 'missing_share')} FROM ct" for c in CLEAN_COLS))
    o["constant_fraction"] = q(CT, " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r('max(n) / CAST(sum(n) AS DOUBLE)', 'top_share')} FROM (SELECT count(*) AS n FROM ct GROUP BY {c})" for c in CLEAN_COLS))
    o["fit_numeric_fill"] = q(CT, " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(f'{fn}({c})', 'fill')}, '{k}' AS kind FROM ct" for c in ("price_num", "bal_num") for fn, k in (("median", "median"), ("avg", "mean")))
        + " UNION ALL SELECT 'void_num', 0e0, 'median' UNION ALL SELECT 'void_num', 0e0, 'mean'")
    o["fit_category_fill"] = q(CT, " UNION ALL ".join(
        f"SELECT '{c}' AS feature, (SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM ct WHERE {c} IS NOT NULL GROUP BY {c}) ORDER BY n DESC, v LIMIT 1) AS fill, 'mode' AS kind "
        f"UNION ALL SELECT '{c}', 'Unknown', 'word'" for c in ("brand", "prio")))
    o["outlier_zscore"] = q(CT, " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(f'avg({c}) - 3 * stddev_samp({c})', 'lower')}, {r(f'avg({c}) + 3 * stddev_samp({c})', 'upper')} FROM ct" for c in ("price_num", "bal_num")))

    def qt(c, p):
        return f"quantile_cont({c}, {p})"

    o["outlier_iqr"] = q(CT, " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(qt(c, 0.25) + ' - 1.5 * (' + qt(c, 0.75) + ' - ' + qt(c, 0.25) + ')', 'lower')}, "
        f"{r(qt(c, 0.75) + ' + 1.5 * (' + qt(c, 0.75) + ' - ' + qt(c, 0.25) + ')', 'upper')} FROM ct" for c in ("price_num", "bal_num", "cust")))
    o["transform_table"] = q(CLEANED, "SELECT * FROM cleaned")
    o["fit_transform_table"] = q(CLEANED, f"SELECT {split_of('key')} AS split, brand, count(*) AS n, {r('avg(price_num)', 'price_mean')}, {r('max(bal_num)', 'bal_max')}, {big('sum(flag)')} AS flags FROM cleaned GROUP BY 1, 2")
    o["skip_imputation"] = q(clean_ctes(), f"SELECT id AS key, {r('price_num', 'price_num')}, {num_value('bal_num', clip=False)} FROM ct")
    o["output_feature_names"] = q(CLEANED[:2], "SELECT feature FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, (SELECT avg(CAST({c} IS NULL AS INTEGER)) FROM tr) AS miss, (SELECT max(n) / CAST(sum(n) AS DOUBLE) FROM (SELECT count(*) AS n FROM tr GROUP BY {c})) AS top"
        for c in ["flag", *CLEAN_COLS]) + ") WHERE miss <= 0.9 AND top <= 0.999")
    # derived columns
    o["typicalness_score"] = small(f"SELECT id, {r('(g1 + g2) / 2', 'overall_typicalness_score')}, {r('(r1 + r2) / 2', 'overall_anomaly_score')} FROM sm")
    o["payer_flags"] = small("SELECT sm.id, CAST(coalesce(c0 >= 0.95, false) AS INTEGER) AS is_absolutely_perfect_payer, CAST(anyo > 0.3 OR serious > 0 AS INTEGER) AS is_chronic_defaulter "
                             "FROM sm LEFT JOIN (SELECT id, avg(paym_row_share_code_0) AS c0 FROM ps GROUP BY id) z ON sm.id = z.id")
    o["code_transitions"] = small(f"SELECT id, {code('pf')} || '_' || {code('pl_')} AS cat_part, {code('rf')} || '_' || {code('rl')} AS cat_ret, {code('pl_')} || '_' || {code('dl')} AS cat_mix FROM sm")
    o["util_and_history"] = small(f"SELECT id, {code('pl_')} || '_' || CASE WHEN anyo <= 0 THEN 'Clean' WHEN anyo <= 0.2 THEN 'Mild' ELSE 'Frequent' END AS cat_util_and_history FROM sm")
    o["diversity_profile"] = small("SELECT id, CAST(rn_ AS VARCHAR) || 'types_' || CAST(n AS VARCHAR) || 'loans' AS cat_diversity_profile FROM sm")
    o["mutual_information"] = mi()

    def enc(c):
        return f"coalesce((SELECT CAST(count(DISTINCT b.{c}) AS INTEGER) FROM trn b WHERE b.{c} < tk.{c}) + (SELECT min(0) FROM trn b WHERE b.{c} = tk.{c}), -1) AS {c}_code"

    o["ordinal_encode"] = q(TXT, f"SELECT p_partkey AS id, {enc('p_brand')}, {enc('p_type')} FROM tk")
    o["freeze_categories"] = q(TXT, "SELECT p_partkey AS id, CASE WHEN p_brand IN (SELECT p_brand FROM trn) THEN p_brand END AS p_brand, "
                               "CASE WHEN p_type IN (SELECT p_type FROM trn WHERE p_type IS NOT NULL) THEN p_type END AS p_type FROM tk")
    o["one_hot_encode"] = q(TXT, "SELECT p_partkey AS id, 0 AS gone_x, CAST((SELECT count(DISTINCT p_brand) FROM trn) AS INTEGER) AS n_columns, "
                            "CAST(p_brand IN (SELECT p_brand FROM trn) AS INTEGER) AS n_hot, CASE WHEN p_brand IN (SELECT p_brand FROM trn) THEN p_brand END AS hot FROM tk")
    # models: labels are exact functions of one feature, so the right answer is known
    for family in ("train_gbt", "train_random_forest", "train_logistic", "train_mlp"):
        o[family] = q(MODEL, "SELECT id, many AS predicted, many = 1 AS likely FROM md WHERE split = 'test'")
    o["multiclass_ovr"] = q(MODEL, "SELECT id, CAST(kind AS INTEGER) AS predicted, CAST(kind AS INTEGER) AS most_likely, 1e0 AS total FROM md WHERE split = 'test'")
    o["save_load_model"] = q(MODEL, "SELECT id, many AS loaded, true AS same FROM md")
    o["batch_score"] = q(MODEL, "SELECT id, many AS predicted, true AS consistent FROM md")
    o["incremental_score"] = q(MODEL, f"SELECT id, {big('1')} AS times, many AS predicted FROM md")
    o["random_search"] = "SELECT CAST(unnest([-1, 0, 1, 2]) AS INTEGER) AS trial, unnest([1e0, 5e-1, 1e0, 5e-1]) AS metric, CAST(NULL AS VARCHAR) AS error"
    o["feature_importance"] = ("SELECT unnest(['loans_total_count', 'loans_max_rn', 'is_zero_a_share', 'is_zero_b_share', 'is_zero_c_share', "
                               "'distinct_pre_disc_count', 'distinct_pre_part_count', 'last_pre_disc_idx', 'last_enc_ret_idx']) AS feature, "
                               "unnest([1e0, 0e0, 0e0, 0e0, 0e0, 0e0, 0e0, 0e0, 0e0]) AS importance")
    o["permutation_importance"] = "SELECT unnest(['loans_total_count', 'is_zero_a_share']) AS feature, unnest([1, 0]) AS sign"
    o["score_contract_checks"] = hist(f"SELECT {big('0')} AS out_of_range, {big('0')} AS bad_sum, count(DISTINCT id) AS n_scored, count(DISTINCT id) AS n_input, {big('5')} AS n_single, {big('0')} AS single_differs FROM h")
    used = ["loans_total_count", "loans_max_rn", "is_zero_a_share", "is_zero_b_share", "is_zero_c_share", "distinct_pre_disc_count",
            "distinct_pre_part_count", "last_pre_disc_idx", "last_enc_ret_idx"]
    # classes are balanced by weight, so the root's mean is 0 and the leaves' means are 1 and -1
    o["tree_attribution"] = q(MODEL, "SELECT id, feature, CASE WHEN feature <> 'loans_total_count' THEN 0e0 WHEN many = 1 THEN 1e0 ELSE -1e0 END AS contribution "
                              f"FROM md, (SELECT unnest({used!r}) AS feature) f WHERE split = 'val'")
    # metrics and errors
    o["class_weights"] = q(T, f"SELECT flag, count(*) AS n, {r('max(count(*)) OVER () / CAST(count(*) AS DOUBLE)', 'weight')} FROM t GROUP BY flag")
    o["confusion_matrix"] = q(S, "SELECT actual, predicted, count(*) AS n FROM s GROUP BY actual, predicted")
    o["classification_metrics"] = q([S, REPORT], f"SELECT {r('sum(tp) / CAST(sum(support) AS DOUBLE)', 'accuracy')}, {r('sum(f1 * support) / CAST(sum(support) AS DOUBLE)', 'f1_weighted')}, {big('sum(support)')} AS n FROM f")
    o["class_report"] = q([S, REPORT], f"SELECT label, {r('pr', 'precision')}, {r('rc', 'recall')}, {r('f1', 'f1')}, support FROM f")
    pairs = "SELECT 1 AS k, actual AS y, p FROM s"
    o["roc_auc"] = q(S, f"SELECT {r('auc', 'roc_auc')} FROM ({auc_sql(pairs)})")
    o["roc_curve"] = q(S, f"""SELECT threshold, {r('fp / CAST((SELECT count(*) FROM s WHERE actual = 0) AS DOUBLE)', 'fpr')}, {r('tp / CAST((SELECT count(*) FROM s WHERE actual = 1) AS DOUBLE)', 'tpr')} FROM (
 SELECT round(p, 6) + 0e0 AS threshold, sum(sum(CASE WHEN actual = 0 THEN 1 ELSE 0 END)) OVER (ORDER BY p DESC) AS fp,
  sum(sum(CASE WHEN actual = 1 THEN 1 ELSE 0 END)) OVER (ORDER BY p DESC) AS tp FROM s GROUP BY p)""")
    o["roc_auc_ovr"] = ovr()
    o["regression_metrics"] = q(RES, f"""SELECT {r('sqrt(avg(error * error))', 'rmse')}, {r('avg(abs(error))', 'mae')},
 {r('1 - sum(error * error) / (SELECT sum((o_totalprice - m) * (o_totalprice - m)) FROM res, (SELECT avg(o_totalprice) AS m FROM res))', 'r2')} FROM res""")
    o["error_frame"] = q(S, f"SELECT id, is_error, {r('confidence_mistake', 'confidence_mistake')} FROM e")
    o["error_trends"] = trends([S, "eg AS (SELECT *, CASE WHEN o_custkey % 13 <> 0 THEN CAST(o_custkey % 37 AS VARCHAR) END AS cust_group FROM e)"], "eg",
                               ["o_orderpriority", "cust_group"], 15, f"count(*) AS n, {big('sum(is_error)')} AS errors, {r('avg(is_error)', 'error_rate')}", "is_error")
    o["residual_trends"] = trends([RES, "rg AS (SELECT *, CAST(o_custkey % 37 AS VARCHAR) AS cust_group FROM res)"], "rg", ["o_orderpriority", "cust_group"], 5,
                                  ", ".join(r(f"quantile_cont(error, {p})", n) for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))), "error")
    o["error_probability_histogram"] = q([S, "w AS (SELECT actual, p, (SELECT min(p) FROM e WHERE is_error = 1) AS lo, (SELECT max(p) FROM e WHERE is_error = 1) AS hi FROM e WHERE is_error = 1)"],
                                         "SELECT actual, CAST(least(floor((p - lo) * 20 / (hi - lo)), 19) AS INTEGER) AS bin, count(*) AS n FROM w GROUP BY 1, 2")
    line = f"count(*) AS n, {big('sum(flag)')} AS target_sum, {r('avg(flag)', 'target_mean')}, {r('count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM j)', 'percent')}"
    jt = "j AS (SELECT h.*, t.flag FROM h LEFT JOIN t ON h.id = t.id)"
    o["target_rate_by_bin"] = hist(f"SELECT CAST(pre_part AS VARCHAR) AS category, {line} FROM j WHERE pre_part IS NOT NULL GROUP BY pre_part UNION ALL SELECT 'ALL', {line} FROM j", T, jt)
    o["dataset_profile"] = hist(f"SELECT metric, {r('value', 'value')} FROM ({PROFILE})", T,
                                "j AS (SELECT h.id, rn, pre_part, enc_ret, grid_5, t.flag FROM h LEFT JOIN t ON h.id = t.id)")
    w2 = {"x1": 0.7, "x2": -0.02}
    o["global_attribution"] = q(LIN, f"SELECT feature, {r('avg(abs(contribution))', 'mean_abs')} FROM ({' UNION ALL '.join(a + 'lin' for a in attribution(w2))}) GROUP BY feature")
    bad = "(SELECT * FROM lin WHERE actual = 0 AND is_error = 1 ORDER BY p DESC, id LIMIT 10)"
    o["local_attribution"] = q(LIN, f"SELECT id, feature, {r('contribution', 'contribution')} FROM ({' UNION ALL '.join(a + bad for a in attribution(w2))})")
    les = ", ".join(f"{big(f'sum(CAST(c <= {b} AS INTEGER))')} AS le_{b.replace('.', '_')}" for b in BUCKETS)
    o["prediction_monitor"] = o["streaming_monitor"] = q(S, f"SELECT predicted, count(*) AS n, {r('sum(c)', 'confidence_sum')}, {les} FROM (SELECT predicted, round(CASE WHEN p > 0.5 THEN p ELSE 1 - p END, 3) AS c FROM s) GROUP BY predicted")
    return o
