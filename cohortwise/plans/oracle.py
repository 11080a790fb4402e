"""SQL counterparts of the registered queries, for an engine other than Spark.

They state the same results in plain SQL over the same whole tables. Tail probabilities
are integrated numerically (Simpson), independently of the closed forms used in Spark.
"""

from __future__ import annotations

from cohortwise.functions.columns import poisson_one_cdf
from cohortwise.plans.queries import (
    BUCKETS, CTR_END, CTR_START, FEATURES, MART_END, POST, PRE, REPLICATES, RETENTION, SEGMENT_DAY,
)

# ---- shared pieces -------------------------------------------------------------------------

ARM = "CASE {k} % 3 WHEN 0 THEN 'control_1' WHEN 1 THEN 'control_2' ELSE 'test' END"
AB = """ab AS (
  SELECT user_id, coalesce(sum(CASE WHEN event_type = 'purchase' AND value > 150 THEN value END), 0) AS revenue,
         CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS testgroup
  FROM events GROUP BY user_id)"""
TX = f"""tx AS (
  SELECT o_custkey AS uid, {ARM.format(k='o_custkey')} AS "group",
         CASE o_orderpriority WHEN '1-URGENT' THEN 'premium_no_trial' WHEN '5-LOW' THEN 'trial_premium'
              ELSE 'other' END AS product_type,
         o_orderstatus AS payment_system, o_totalprice AS revenue
  FROM orders WHERE o_orderdate >= DATE '2001-01-01')"""
PEOPLE = f"""people AS (
  SELECT c_custkey AS uid, {ARM.format(k='c_custkey')} AS "group",
         CAST(15 + c_custkey % 50 AS DOUBLE) AS age, c_acctbal AS attraction_coeff,
         n_name AS country, c_mktsegment AS gender,
         (SELECT CAST(count(*) AS DOUBLE) FROM orders WHERE o_custkey = c_custkey AND o_orderdate < DATE '2001-01-01') AS views_count,
         coalesce((SELECT sum(o_totalprice) FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= DATE '2001-01-01'), 0) AS total_revenue
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
EXPERIMENT = f"""{TX}, {PEOPLE}, experiment AS (
  SELECT p.*, coalesce(t.premium_revenue, 0) AS premium_revenue,
         CAST(coalesce(t.premium_transactions, 0) AS BIGINT) AS premium_transactions,
         coalesce(t.trial, FALSE) AS trial_buyer, p.total_revenue > 0 AS payer,
         coalesce(t.premium_revenue, 0) > 0 AS premium_buyer,
         CASE WHEN p."group" LIKE 'control%' THEN 'control' ELSE 'test' END AS comparison
  FROM people p LEFT JOIN (
    SELECT uid, sum(revenue) FILTER (WHERE product_type = 'premium_no_trial') AS premium_revenue,
           count(*) FILTER (WHERE product_type = 'premium_no_trial') AS premium_transactions,
           bool_or(product_type = 'trial_premium') AS trial
    FROM tx GROUP BY uid) t USING (uid))"""
FEED = """feed AS (
  SELECT ts AS time, user_id, user_id || '-' || regexp_extract(props, '[0-9]+') AS post_id,
         CASE event_type WHEN 'click' THEN 'like' ELSE event_type END AS action,
         user_id % 2 + 1 AS exp_group
  FROM events)"""
UCTR = f"""{FEED}, uctr AS (
  SELECT exp_group, user_id, count(*) FILTER (WHERE action = 'like') AS likes,
         count(*) FILTER (WHERE action = 'view') AS views,
         count(*) FILTER (WHERE action = 'like') / nullif(count(*) FILTER (WHERE action = 'view'), 0) AS ctr
  FROM feed WHERE CAST(time AS DATE) BETWEEN DATE '{CTR_START}' AND DATE '{CTR_END}' AND exp_group IN (1, 2)
  GROUP BY exp_group, user_id)"""
REG = """reg AS (
  SELECT user_id AS uid, CAST(min(ts) AS DATE) AS cohort_date FROM events
  WHERE event_type = 'purchase' GROUP BY user_id),
auth AS (SELECT user_id AS uid, CAST(ts AS DATE) AS auth_date FROM events)"""
MESSAGES = """messages AS (
  SELECT CAST(ts AS DATE) AS date, user_id, 15 + user_id % 50 AS age, c_mktsegment AS gender
  FROM events LEFT JOIN customer ON c_custkey = user_id WHERE event_type = 'purchase')"""
SERVICES = """services AS (
  SELECT CAST(ts AS DATE) AS date, user_id, CASE WHEN event_type IN ('view', 'click') THEN 'feed'
         WHEN event_type = 'purchase' AND value > 100 THEN 'messenger' END AS service FROM events)"""
MART = f"""{FEED}, kept AS (SELECT *, CAST(time AS DATE) AS date FROM feed WHERE time < TIMESTAMP '{MART_END}'),
mart AS (
  SELECT d.date, dau, likes, views, likes / nullif(views, 0) AS ctr, unique_viewed_posts,
         coalesce(new_posts, 0) AS new_posts
  FROM (SELECT date, count(DISTINCT user_id) AS dau, count(*) FILTER (WHERE action = 'like') AS likes,
               count(*) FILTER (WHERE action = 'view') AS views,
               count(DISTINCT CASE WHEN action = 'view' THEN post_id END) AS unique_viewed_posts
        FROM kept GROUP BY date) d
  LEFT JOIN (SELECT date, count(*) AS new_posts FROM (SELECT post_id, min(date) AS date FROM kept GROUP BY post_id)
             GROUP BY date) n ON d.date = n.date)"""

WORD = "CAST('0x' || substr(md5({t}), 1, 8) AS BIGINT)"
BUCKETED = f"""{UCTR}, keyed AS (SELECT *, {WORD.format(t='CAST(user_id AS VARCHAR)')} % {BUCKETS} AS bucket FROM uctr),
buckets AS (
  SELECT exp_group, bucket, count(*) AS users, sum(likes) / nullif(sum(views), 0) AS bucket_ctr,
         list_sort(list(ctr))[least(CAST(floor(CAST(0.9 AS DOUBLE) * count(ctr)) AS BIGINT), count(ctr) - 1) + 1] AS ctr9
  FROM keyed GROUP BY exp_group, bucket)"""


def weight(key: str) -> str:
    """Poisson(1) weight of (key, replicate b): word b % 4 of the digest of block b // 4."""
    digest = f"md5({key} || '|' || (b // 4) || '|42')"
    uniform = f"(CAST('0x' || substr({digest}, 1 + 8 * (b % 4), 8) AS BIGINT) / CAST(4294967296 AS DOUBLE))"
    cases = " ".join(
        f"WHEN u < CAST('{bound!r}' AS DOUBLE) THEN {k}" for k, bound in enumerate(poisson_one_cdf())
    )
    return f"(SELECT CASE {cases} ELSE {len(poisson_one_cdf())} END FROM (SELECT {uniform} AS u))"


def replicates(source: str, group: str, numerator: str, denominator: str) -> str:
    return f"""weights AS (
  SELECT b, {group} AS g, {numerator} AS num, {denominator} AS den, {weight('user_id')} AS w
  FROM {source}, range(0, {REPLICATES}) r(b)),
reps AS (
  SELECT b AS replicate, g, sum(w * num) AS wn, sum(w * den) AS wd, sum(w * num) / nullif(sum(w * den), 0) AS value
  FROM weights GROUP BY b, g)"""


def bootstrap(control: str, test: str) -> str:
    return f"""diffs AS (
  SELECT replicate, max(value) FILTER (WHERE g = {test}) - max(value) FILTER (WHERE g = {control}) AS d
  FROM reps GROUP BY replicate),
boot AS (
  SELECT count(*) AS n, avg(d) AS mean_difference, quantile_cont(d, 0.025) AS ci_low, quantile_cont(d, 0.975) AS ci_high,
         least(1.0, 2 * (least(count(*) FILTER (WHERE d <= 0), count(*) FILTER (WHERE d >= 0)) + 1) / (count(*) + 1)) AS p_value
  FROM diffs WHERE d IS NOT NULL)"""


SIMPSON = "CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"


def chi2_tail(x: str, k: str) -> str:
    """P(X >= x): the density of sqrt(X), integrated from 0."""
    u = f"(sqrt({x}) * i / CAST(2000 AS DOUBLE))"
    return (
        f"(SELECT greatest(0.0, 1 - sum(({SIMPSON}) * pow({u}, {k} - 1) * exp(-{u} * {u} / 2)) * sqrt({x}) / 6000 "
        f"* 2 / (pow(CAST(2 AS DOUBLE), {k} / CAST(2 AS DOUBLE)) * gamma({k} / CAST(2 AS DOUBLE)))) FROM range(0, 2001) s(i))"
    )


def normal_tails(z: str) -> str:
    return chi2_tail(f"({z} * {z})", "1")


def t_tails(t: str, v: str) -> str:
    u = f"(abs({t}) * i / CAST(2000 AS DOUBLE))"
    return (
        f"(SELECT greatest(0.0, 1 - 2 * sum(({SIMPSON}) * pow(1 + {u} * {u} / {v}, -({v} + 1) / 2)) * abs({t}) / 6000 "
        f"* exp(lgamma(({v} + 1) / 2) - lgamma({v} / 2)) / sqrt({v} * pi())) FROM range(0, 2001) s(i))"
    )


Z = "CAST('1.959963984540054' AS DOUBLE)"


def t_upper(v: str) -> str:
    """Upper 97.5 % point: the normal-quantile expansion in 1 / dof, then one Newton step."""
    z = 1.959963984540054
    terms = [
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    ]
    start = f"({Z} + " + " + ".join(
        f"CAST('{c!r}' AS DOUBLE) / pow({v}, {p})" for p, c in enumerate(terms, start=1)
    ) + ")"
    density = (
        f"exp(lgamma(({v} + 1) / 2) - lgamma({v} / 2)) / sqrt({v} * pi()) "
        f"* pow(1 + {start} * {start} / {v}, -({v} + 1) / 2)"
    )
    return f"({start} + ({t_tails(start, v)} - CAST(0.05 AS DOUBLE)) / (2 * {density}))"


def long_metrics(source: str, arm: str, metrics: dict[str, str], keys: str = "") -> str:
    """Summary per (keys, metric, arm)."""
    return " UNION ALL ".join(
        f"SELECT {keys} '{name}' AS metric, {arm} AS arm, count(x) AS n, avg(x) AS mean, var_samp(x) AS var, coalesce(sum(x), 0) AS total "
        f"FROM (SELECT *, CAST({value} AS DOUBLE) AS x FROM {source}) GROUP BY ALL"
        for name, value in metrics.items()
    )


def paired(control: str, test: str, keys: str = "") -> str:
    columns = ", ".join(
        f"max({c}) FILTER (WHERE arm = {arm}) AS {c}_{s}"
        for s, arm in (("c", control), ("t", test)) for c in ("n", "mean", "var", "total")
    )
    return f"SELECT {keys} metric, {columns} FROM summary GROUP BY {keys} metric"


WELCH = """welch AS (
  SELECT *, mean_t - mean_c AS diff, sqrt(var_c / n_c + var_t / n_t) AS se,
         (mean_t - mean_c) / nullif(sqrt(var_c / n_c + var_t / n_t), 0) AS t,
         pow(var_c / n_c + var_t / n_t, 2) / nullif(pow(var_c / n_c, 2) / nullif(n_c - 1, 0) + pow(var_t / n_t, 2) / nullif(n_t - 1, 0), 0) AS dof
  FROM pairs)"""
PROPORTION = f"""prop AS (
  SELECT *, mean_t - mean_c AS diff,
         (mean_t - mean_c) / nullif(sqrt((total_c + total_t) / (n_c + n_t) * (1 - (total_c + total_t) / (n_c + n_t)) * (1.0 / n_c + 1.0 / n_t)), 0) AS z,
         {Z} * sqrt(mean_c * (1 - mean_c) / n_c + mean_t * (1 - mean_t) / n_t) AS wald,
         (mean_c + {Z} * {Z} / (2 * n_c) - {Z} * sqrt(mean_c * (1 - mean_c) / n_c + {Z} * {Z} / (4 * n_c * n_c))) / (1 + {Z} * {Z} / n_c) AS lc,
         (mean_c + {Z} * {Z} / (2 * n_c) + {Z} * sqrt(mean_c * (1 - mean_c) / n_c + {Z} * {Z} / (4 * n_c * n_c))) / (1 + {Z} * {Z} / n_c) AS uc,
         (mean_t + {Z} * {Z} / (2 * n_t) - {Z} * sqrt(mean_t * (1 - mean_t) / n_t + {Z} * {Z} / (4 * n_t * n_t))) / (1 + {Z} * {Z} / n_t) AS lt,
         (mean_t + {Z} * {Z} / (2 * n_t) + {Z} * sqrt(mean_t * (1 - mean_t) / n_t + {Z} * {Z} / (4 * n_t * n_t))) / (1 + {Z} * {Z} / n_t) AS ut
  FROM pairs)"""
AB_METRICS = {
    "conversion": "revenue > 0", "arpu": "revenue", "arppu": "CASE WHEN revenue > 0 THEN revenue END",
}
PREMIUM_METRICS = {
    "cr_payer": "payer", "cr_premium": "premium_buyer", "cr_trial": "trial_buyer",
    "arpu": "total_revenue", "premium_arpu": "premium_revenue",
    "arppu": "CASE WHEN payer THEN total_revenue END",
    "premium_arppu": "CASE WHEN premium_buyer THEN premium_revenue END",
}
AB_PAIRS = f"{AB}, summary AS ({long_metrics('ab', 'testgroup', AB_METRICS)}), pairs AS ({paired(repr('a'), repr('b'))})"


def effects(source: str, arm: str, control: str, test: str) -> str:
    """Effect table with the z-test for shares and Welch for means."""
    return f"""summary AS ({long_metrics(source, arm, PREMIUM_METRICS)}),
pairs AS ({paired(repr(control), repr(test))}), {WELCH}, {PROPORTION},
tested AS (
  SELECT metric, mean_c, mean_t, 100.0 AS scale, {normal_tails('z')} AS p, diff - wald AS lo, diff + wald AS hi
  FROM prop WHERE metric LIKE 'cr%'
  UNION ALL
  SELECT metric, mean_c, mean_t, 1.0, {t_tails('t', 'dof')}, diff - {t_upper('dof')} * se, diff + {t_upper('dof')} * se
  FROM welch WHERE metric NOT LIKE 'cr%')"""


def ranks(source: str, arm: str, arms: list[str], keys: str = "metric") -> str:
    """Mid-rank sums per key from a long table (metric, arm, value)."""
    per_arm = ", ".join(
        f"count(*) FILTER (WHERE {arm} = {a}) AS n_{i}, coalesce(sum(mid) FILTER (WHERE {arm} = {a}), 0) AS rank_sum_{i}"
        for i, a in enumerate(arms)
    )
    return f"""ranked AS (
  SELECT *, rank() OVER (PARTITION BY {keys} ORDER BY value) + (count(*) OVER (PARTITION BY {keys}, value) - 1) / 2.0 AS mid,
         count(*) OVER (PARTITION BY {keys}, value) AS t
  FROM {source} WHERE value IS NOT NULL),
sums AS (
  SELECT {keys}, count(*) AS users, sum(CAST(t AS DOUBLE) * t - 1) AS ties, {per_arm} FROM ranked GROUP BY {keys})"""


FEATURE_RANKS = f"""{PEOPLE}, long AS (
  {" UNION ALL ".join(f'SELECT "group", {chr(39)}{m}{chr(39)} AS metric, {m} AS value FROM people' for m in FEATURES)}),
{ranks('long', '"group"', ["'control_1'", "'control_2'", "'test'"])},
kw AS (
  SELECT *, greatest(0, (12 * (rank_sum_0 * rank_sum_0 / n_0 + rank_sum_1 * rank_sum_1 / n_1 + rank_sum_2 * rank_sum_2 / n_2)
             / (CAST(users AS DOUBLE) * (users + 1)) - 3 * (users + 1))
            / (1 - ties / (CAST(users AS DOUBLE) * users * users - users))) AS h
  FROM sums)"""
MANN_WHITNEY = """mw AS (
  SELECT *, rank_sum_0 - n_0 * (n_0 + 1) / 2 AS u,
         (greatest(rank_sum_0 - n_0 * (n_0 + 1) / 2, n_0 * n_1 - (rank_sum_0 - n_0 * (n_0 + 1) / 2)) - n_0 * n_1 / 2 - 0.5)
         / sqrt(CAST(n_0 AS DOUBLE) * n_1 / 12 * (n_0 + n_1 + 1 - ties / (CAST(n_0 + n_1 AS DOUBLE) * (n_0 + n_1 - 1)))) AS z
  FROM sums)"""
MW_P = f"CASE WHEN z <= 0 THEN 1.0 ELSE {normal_tails('z')} END"
CHI2_BALANCE = f"""{PEOPLE}, cells AS (
  SELECT 'country' AS feature, country AS category, "group" AS arm FROM people
  UNION ALL SELECT 'gender', gender, "group" FROM people),
observed AS (SELECT feature, category, arm, count(*) AS o FROM cells GROUP BY ALL),
rows_ AS (SELECT feature, category, count(*) AS r FROM cells GROUP BY ALL),
cols_ AS (SELECT feature, arm, count(*) AS c FROM cells GROUP BY ALL),
alls AS (SELECT feature, count(*) AS n FROM cells GROUP BY feature),
chi AS (
  SELECT r.feature, n AS users, (count(DISTINCT r.category) - 1) * (count(DISTINCT c.arm) - 1) AS dof,
         sum(pow(coalesce(o, 0) - r.r * c.c / n, 2) / (r.r * c.c / n)) AS chi2
  FROM rows_ r JOIN cols_ c USING (feature) JOIN alls USING (feature)
  LEFT JOIN observed q ON q.feature = r.feature AND q.category = r.category AND q.arm = c.arm
  GROUP BY r.feature, n)"""


def retention(start: str | None, end: str | None, days: int, by: str = "") -> str:
    """Cohort grid with active users; ``by`` is an extra key of reg with a trailing comma."""
    where = f"WHERE cohort_date BETWEEN DATE '{start}' AND DATE '{end}'" if start else ""
    return f"""cohorts AS (SELECT * FROM reg {where}),
sizes AS (SELECT {by} cohort_date, count(*) AS cohort_size FROM cohorts GROUP BY {by} cohort_date),
act AS (
  SELECT {by} cohort_date, date_diff('day', cohort_date, auth_date) AS day, count(DISTINCT uid) AS active
  FROM auth JOIN cohorts USING (uid)
  WHERE date_diff('day', cohort_date, auth_date) BETWEEN 0 AND {days} GROUP BY ALL),
obs AS (SELECT max(auth_date) AS observation_end FROM auth),
grid AS (
  SELECT s.*, i AS day, coalesce(a.active, 0) AS active, observation_end,
         coalesce(a.active, 0) / s.cohort_size AS share0,
         CASE WHEN s.cohort_date + CAST(i AS INTEGER) <= observation_end THEN coalesce(a.active, 0) / s.cohort_size END AS share
  FROM sizes s CROSS JOIN range(0, {days + 1}) g(i) CROSS JOIN obs
  LEFT JOIN act a ON a.cohort_date = s.cohort_date AND a.day = i {"AND a.channel = s.channel" if by else ""})"""


RET = f"{REG}, {retention(*RETENTION)}"
ORDERED = "activity AS (SELECT event_id, ts AS time, user_id, event_type, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS level FROM events)"


def mean_effects(keys: str) -> str:
    return f"""eff AS (
  SELECT {keys}, count(value) FILTER (WHERE pre) AS n_pre, count(value) FILTER (WHERE NOT pre) AS n_post,
         avg(value) FILTER (WHERE NOT pre) AS actual, avg(value) FILTER (WHERE pre) AS predicted,
         avg(value) FILTER (WHERE NOT pre) - avg(value) FILTER (WHERE pre) AS effect,
         sqrt((var_samp(value) FILTER (WHERE pre) * (count(value) FILTER (WHERE pre) - 1)
               + var_samp(value) FILTER (WHERE NOT pre) * (count(value) FILTER (WHERE NOT pre) - 1))
              / (count(*) - 2) * (1.0 / count(value) FILTER (WHERE pre) + 1.0 / count(value) FILTER (WHERE NOT pre))) AS se,
         CAST(count(*) - 2 AS DOUBLE) AS dof
  FROM (SELECT *, date BETWEEN DATE '{PRE[0]}' AND DATE '{PRE[1]}' AS pre FROM series
        WHERE date BETWEEN DATE '{PRE[0]}' AND DATE '{PRE[1]}' OR date BETWEEN DATE '{POST[0]}' AND DATE '{POST[1]}')
  GROUP BY {keys}),
limits AS (SELECT *, effect - {t_upper('dof')} * se AS lo, effect + {t_upper('dof')} * se AS hi FROM eff)
SELECT {keys}, n_pre, n_post, round(actual, 4) AS actual, round(predicted, 4) AS predicted, round(effect, 4) AS effect,
       round(se, 4) AS se, dof, round(lo, 4) AS ci_low, round(hi, 4) AS ci_high,
       CASE WHEN lo <= 0 AND hi >= 0 THEN 'нет убедительного изменения' WHEN effect > 0 THEN 'рост' ELSE 'снижение' END AS result
FROM limits"""


PRODUCT = """SELECT {g}, count(*) AS users, count(*) FILTER (WHERE payer) AS payers, round(sum(total_revenue), 2) AS revenue,
  count(*) FILTER (WHERE premium_buyer) AS premium_buyers, round(sum(premium_revenue), 2) AS premium_revenue,
  count(*) FILTER (WHERE trial_buyer) AS trial_buyers,
  round(count(*) FILTER (WHERE payer) / count(*), 6) AS conversion, round(sum(total_revenue) / count(*), 4) AS arpu,
  round(sum(total_revenue) / nullif(count(*) FILTER (WHERE payer), 0), 4) AS arppu,
  round(count(*) FILTER (WHERE premium_buyer) / count(*), 6) AS premium_conversion,
  round(sum(premium_revenue) / count(*), 4) AS premium_arpu,
  round(sum(premium_revenue) / nullif(count(*) FILTER (WHERE premium_buyer), 0), 4) AS premium_arppu,
  round(count(*) FILTER (WHERE trial_buyer) / count(*), 6) AS trial_conversion
FROM experiment GROUP BY {g}"""

ORACLE: dict[str, str] = {}

# ---- experiment tables and metrics ---------------------------------------------------------

ORACLE["ab_metrics"] = f"""WITH {AB} SELECT testgroup, count(*) AS users, count(*) FILTER (WHERE revenue > 0) AS payers,
  round(sum(revenue), 2) AS revenue, round(count(*) FILTER (WHERE revenue > 0) / count(*), 6) AS cr,
  round(sum(revenue) / count(*), 4) AS arpu, round(sum(revenue) / nullif(count(*) FILTER (WHERE revenue > 0), 0), 4) AS arppu
FROM ab GROUP BY testgroup"""
ORACLE["exp_user"] = f"""WITH {EXPERIMENT} SELECT "group", uid, age, round(attraction_coeff, 2) AS attraction_coeff, country, gender, views_count,
  round(total_revenue, 2) AS total_revenue, round(premium_revenue, 2) AS premium_revenue, premium_transactions,
  trial_buyer, payer, premium_buyer FROM experiment"""
ORACLE["exp_union"] = """SELECT o_orderkey, o_custkey, o_totalprice,
  CASE o_orderstatus WHEN 'F' THEN 'control_1' WHEN 'O' THEN 'control_2' ELSE 'test' END AS "group" FROM orders"""
ORACLE["src_csv"] = """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
  round(o_totalprice, 2) AS price, CAST(o_orderdate AS DATE) AS order_date FROM orders"""
ORACLE["ab_product"] = f"WITH {EXPERIMENT} " + PRODUCT.format(g='"group"')
ORACLE["ab_pooled"] = f"WITH {EXPERIMENT} " + PRODUCT.format(g="comparison")
ORACLE["late_assign"] = f"""WITH {TX}, users AS (
  SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'B' WHEN c_custkey % 2 = 0 THEN 'A' ELSE 'B' END AS grp,
         coalesce((SELECT sum(revenue) FROM tx WHERE uid = c_custkey), 0) AS rev FROM customer)
SELECT grp, count(*) AS users, count(*) FILTER (WHERE rev > 0) AS payers, round(sum(rev), 2) AS revenue,
  round(count(*) FILTER (WHERE rev > 0) / count(*), 6) AS cr, round(sum(rev) / count(*), 4) AS arpu,
  round(sum(rev) / nullif(count(*) FILTER (WHERE rev > 0), 0), 4) AS arppu FROM users GROUP BY grp"""
ORACLE["whale_share"] = f"""WITH {AB} SELECT testgroup, count(*) FILTER (WHERE revenue > 0) AS payers,
  count(*) FILTER (WHERE revenue >= 400) AS large_payers,
  round(count(*) FILTER (WHERE revenue >= 400) / nullif(count(*) FILTER (WHERE revenue > 0), 0), 6) AS payer_share,
  round(coalesce(sum(revenue) FILTER (WHERE revenue >= 400), 0) / nullif(sum(revenue) FILTER (WHERE revenue > 0), 0), 6) AS revenue_share
FROM ab GROUP BY testgroup"""
ORACLE["pay_spike"] = f"""WITH {AB} SELECT testgroup, count(*) FILTER (WHERE revenue > 0) AS payers,
  count(*) FILTER (WHERE revenue > 0 AND round_even(revenue, 0) = 400) AS spike_payers,
  round(count(*) FILTER (WHERE revenue > 0 AND round_even(revenue, 0) = 400) / nullif(count(*) FILTER (WHERE revenue > 0), 0), 6) AS spike_share
FROM ab GROUP BY testgroup"""
ORACLE["payer_stats"] = f"""WITH {AB} SELECT testgroup, count(*) AS payers, round(avg(revenue), 4) AS mean, round(min(revenue), 4) AS min,
  round(max(revenue), 4) AS max, round(median(revenue), 4) AS median FROM ab WHERE revenue > 0 GROUP BY testgroup"""
ORACLE["price_payment"] = f"""WITH {TX} SELECT "group", payment_system, count(*) AS purchases, count(DISTINCT uid) AS buyers,
  round(avg(revenue), 4) AS mean_revenue, round(median(revenue), 4) AS median_revenue
FROM tx WHERE product_type = 'premium_no_trial' GROUP BY ALL"""
ORACLE["price_country"] = f"""WITH {TX}, bought AS (
  SELECT n_name AS country, uid, revenue, CASE WHEN "group" LIKE 'control%' THEN 'control' ELSE 'test' END AS arm
  FROM tx JOIN customer ON c_custkey = uid JOIN nation ON n_nationkey = c_nationkey
  WHERE product_type = 'premium_no_trial' AND payment_system = 'O'),
wide AS (
  SELECT country, median(revenue) FILTER (WHERE arm = 'control') AS control_median,
         count(DISTINCT uid) FILTER (WHERE arm = 'control') AS control_buyers,
         median(revenue) FILTER (WHERE arm = 'test') AS test_median,
         count(DISTINCT uid) FILTER (WHERE arm = 'test') AS test_buyers FROM bought GROUP BY country)
SELECT country, round(control_median, 4) AS control_median, control_buyers, round(test_median, 4) AS test_median, test_buyers,
       round(test_median / control_median, 4) AS price_ratio FROM wide WHERE control_buyers >= 2 AND test_buyers >= 2
ORDER BY price_ratio DESC"""
ORACLE["cust_segment"] = f"""WITH shipped AS (SELECT l_orderkey, min(l_shipdate) AS delivered FROM lineitem GROUP BY l_orderkey),
o AS (
  SELECT o_custkey AS customer_id, max(o_orderdate) AS created_at, count(*) FILTER (WHERE o_orderstatus = 'F') AS orders_count,
         avg(epoch(delivered - o_orderdate) / CAST(86400 AS DOUBLE)) FILTER (WHERE o_orderstatus = 'F') AS avg_days
  FROM orders LEFT JOIN shipped ON l_orderkey = o_orderkey GROUP BY o_custkey),
p AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS n FROM events GROUP BY user_id),
c AS (
  SELECT c_custkey AS customer_id, n_name AS customer_city, CAST(created_at AS DATE) AS registration_date,
         DATE '{SEGMENT_DAY}' - CAST(created_at AS DATE) AS days, coalesce(orders_count, 0) AS orders_count,
         coalesce(p.n, 0) AS purchases, avg_days
  FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN o ON o.customer_id = c_custkey LEFT JOIN p ON p.user_id = c_custkey)
SELECT customer_id, customer_city, registration_date, CAST(days AS BIGINT) AS days_since_registration, orders_count,
  purchases AS purchase_events_count, CAST(round(CAST(avg_days AS DECIMAL(20, 6)), 2) AS DOUBLE) AS avg_delivery_days,
  CASE WHEN orders_count >= 3 THEN 'Постоянный' WHEN orders_count BETWEEN 1 AND 2 THEN 'Разовый'
       WHEN days > 30 THEN 'Неактивный' ELSE 'Новый' END AS segment FROM c ORDER BY customer_id"""

# ---- retention -----------------------------------------------------------------------------

ORACLE["retention"] = f"""WITH {RET} SELECT cohort_date, day, cohort_size, active, round(share * 100, 4) AS retention, observation_end FROM grid"""
ORACLE["retention_wide"] = f"WITH {RET} SELECT cohort_date, cohort_size, " + ", ".join(
    f"round(max(share0 * 100) FILTER (WHERE day = {d}), 2) AS d{d}" for d in range(RETENTION[2] + 1)
) + " FROM grid GROUP BY cohort_date, cohort_size"
ORACLE["retention_weighted"] = f"""WITH {RET} SELECT day, CAST(sum(cohort_size) AS BIGINT) AS users,
  round(sum(share * cohort_size) / sum(cohort_size), 6) AS weighted_retention
FROM grid WHERE share IS NOT NULL AND day IN (0, 1, 7, 14) GROUP BY day"""
ORACLE["retention_dq"] = f"""WITH {REG} SELECT (SELECT count(DISTINCT uid) FROM reg) AS registered_users,
  (SELECT count(*) FROM (SELECT uid FROM reg GROUP BY uid HAVING count(*) > 1)) AS repeated_users,
  (SELECT count(*) FROM auth) AS authorizations,
  (SELECT count(*) FROM auth WHERE uid NOT IN (SELECT uid FROM reg)) AS orphan_authorizations,
  (SELECT count(*) FROM auth JOIN reg USING (uid) WHERE auth_date < cohort_date) AS early_authorizations,
  (SELECT count(*) FROM reg WHERE NOT EXISTS (SELECT 1 FROM auth WHERE auth.uid = reg.uid AND auth_date = cohort_date)) AS users_without_d0"""
ORACLE["retention_by"] = f"""WITH base AS (SELECT user_id AS uid, CAST(min(ts) AS DATE) AS cohort_date FROM events
  WHERE event_type = 'purchase' GROUP BY user_id),
reg AS (SELECT uid, cohort_date, c_mktsegment AS channel FROM base JOIN customer ON c_custkey = uid),
auth AS (SELECT user_id AS uid, CAST(ts AS DATE) AS auth_date FROM events), {retention(None, None, 30, 'channel,')}
SELECT channel, day, CAST(sum(cohort_size) AS BIGINT) AS users, round(sum(share * cohort_size) / sum(cohort_size), 6) AS weighted_retention
FROM grid WHERE share IS NOT NULL GROUP BY channel, day"""

# ---- click-through rate --------------------------------------------------------------------

ORACLE["user_ctr"] = f"WITH {UCTR} SELECT CAST(exp_group AS BIGINT) AS exp_group, user_id, likes, views, round(ctr, 6) AS ctr FROM uctr"
ORACLE["ctr_summary"] = f"""WITH {UCTR} SELECT exp_group, count(*) AS users, CAST(sum(likes) AS BIGINT) AS likes, CAST(sum(views) AS BIGINT) AS views,
  round(avg(ctr), 6) AS mean_user_ctr, round(median(ctr), 6) AS median_user_ctr, round(sum(likes) / sum(views), 6) AS global_ctr
FROM uctr GROUP BY exp_group"""
ORACLE["ctr_effect"] = f"""WITH {UCTR}, g AS (SELECT sum(likes) FILTER (WHERE exp_group = 1) / sum(views) FILTER (WHERE exp_group = 1) AS c,
  sum(likes) FILTER (WHERE exp_group = 2) / sum(views) FILTER (WHERE exp_group = 2) AS t FROM uctr)
SELECT round(c, 6) AS control_ctr, round(t, 6) AS test_ctr, round(t - c, 6) AS absolute_effect, round(t / c - 1, 6) AS relative_effect FROM g"""
ORACLE["ctr_distribution"] = f"""WITH {UCTR} SELECT exp_group, count(ctr) AS users, round(avg(ctr), 6) AS mean, round(stddev_samp(ctr), 6) AS std,
  round(count(*) FILTER (WHERE ctr < CAST(0.8 AS DOUBLE)) / count(ctr), 6) AS share_below,
  round(count(*) FILTER (WHERE ctr > CAST(1.25 AS DOUBLE)) / count(ctr), 6) AS share_above,
  round(median(ctr), 6) AS median FROM uctr GROUP BY exp_group"""
ORACLE["ctr_smoothed"] = f"""WITH {UCTR}, p AS (SELECT sum(likes) / sum(views) AS rate FROM uctr)
SELECT exp_group, user_id, likes, views, round(ctr, 6) AS ctr, round(rate, 6) AS pooled_ctr,
  round((likes + 5 * rate) / (views + 5), 6) AS smoothed_ctr FROM uctr CROSS JOIN p"""
ORACLE["ctr_buckets"] = f"WITH {BUCKETED} SELECT exp_group, bucket, users, round(bucket_ctr, 6) AS bucket_ctr, round(ctr9, 6) AS ctr9 FROM buckets"
ORACLE["ctr_bucket_summary"] = f"""WITH {BUCKETED} SELECT exp_group, count(*) AS buckets, round(avg(bucket_ctr), 6) AS mean_bucket_ctr,
  round(median(bucket_ctr), 6) AS median_bucket_ctr FROM buckets GROUP BY exp_group"""

# ---- marts and dashboard -------------------------------------------------------------------

ORACLE["daily_mart"] = f"WITH {MART} SELECT date, dau, likes, views, round(ctr, 6) AS ctr, unique_viewed_posts, new_posts FROM mart"
ORACLE["new_entities"] = f"""WITH {FEED} SELECT date, count(*) AS new_posts FROM (
  SELECT post_id, CAST(min(time) AS DATE) AS date FROM feed GROUP BY post_id) GROUP BY date"""
ORACLE["dau_service"] = f"WITH {SERVICES} SELECT date, service, count(DISTINCT user_id) AS dau FROM services WHERE service IS NOT NULL GROUP BY date, service"
ORACLE["service_overlap"] = f"""WITH {SERVICES}, f AS (SELECT DISTINCT user_id FROM services WHERE service = 'feed'),
m AS (SELECT DISTINCT user_id FROM services WHERE service = 'messenger')
SELECT count(*) AS base_users, count(m.user_id) AS both_users, round(count(m.user_id) / count(*), 6) AS overlap
FROM f LEFT JOIN m USING (user_id)"""
ORACLE["msgs_gender"] = f"WITH {MESSAGES} SELECT gender, count(*) AS messages FROM messages WHERE gender IS NOT NULL GROUP BY gender"
ORACLE["msgs_age"] = f"""WITH {MESSAGES}, b AS (SELECT CASE WHEN age < 18 THEN 1 WHEN age <= 24 THEN 2 WHEN age <= 34 THEN 3
  WHEN age <= 44 THEN 4 WHEN age <= 54 THEN 5 ELSE 6 END AS position FROM messages)
SELECT ['до 18', '18–24', '25–34', '35–44', '45–54', '55+'][position] AS age_band, count(*) AS messages, CAST(position AS BIGINT) AS position
FROM b GROUP BY position"""
ORACLE["msgs_per_sender"] = f"""WITH {MESSAGES} SELECT date, count(*) AS messages, count(DISTINCT user_id) AS senders,
  round(count(*) / count(DISTINCT user_id), 6) AS messages_per_sender FROM messages GROUP BY date"""

# ---- data quality --------------------------------------------------------------------------

ORACLE["dq_nulls"] = f"""WITH {TX}, j AS (SELECT c_custkey, c_name, c_acctbal, (SELECT sum(revenue) FROM tx WHERE uid = c_custkey) AS revenue FROM customer)
SELECT 'uid' AS column_name, count(*) AS rows, count(*) - count(c_custkey) AS nulls FROM j
UNION ALL SELECT 'c_name', count(*), count(*) - count(c_name) FROM j
UNION ALL SELECT 'c_acctbal', count(*), count(*) - count(c_acctbal) FROM j
UNION ALL SELECT 'revenue', count(*), count(*) - count(revenue) FROM j"""
ORACLE["dq_dups"] = """SELECT l_returnflag, count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
  count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates FROM lineitem GROUP BY l_returnflag"""
ORACLE["dq_exact_dups"] = """WITH o AS (SELECT * REPLACE (CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS o_custkey) FROM orders),
j AS (SELECT * FROM o UNION ALL SELECT * FROM o WHERE o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED')),
k AS (SELECT o_orderstatus, o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, count(*) AS n FROM j GROUP BY ALL)
SELECT o_orderstatus, CAST(sum(n) AS BIGINT) AS rows, CAST(coalesce(sum(n) FILTER (WHERE o_custkey IS NULL), 0) AS BIGINT) AS missing_key,
  CAST(sum(n - 1) AS BIGINT) AS duplicates_all_rows,
  CAST(coalesce(sum(n) FILTER (WHERE o_custkey IS NOT NULL), 0) AS BIGINT) AS valid_rows,
  CAST(coalesce(sum(n - 1) FILTER (WHERE o_custkey IS NOT NULL), 0) AS BIGINT) AS duplicates_valid_rows FROM k GROUP BY o_orderstatus"""
ORACLE["dq_orphans"] = f"""WITH {TX}
SELECT 'customers_without_purchase' AS "check", count(*) AS orphan_rows, count(DISTINCT c_custkey) AS orphan_keys
FROM customer WHERE NOT EXISTS (SELECT 1 FROM tx WHERE uid = c_custkey)
UNION ALL SELECT 'buyers_without_activity', count(*), count(DISTINCT uid) FROM tx WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = uid)
UNION ALL SELECT 'active_without_customer', count(*), count(DISTINCT user_id) FROM events WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id)"""
ORACLE["dq_reconcile"] = f"""WITH u AS (SELECT o_custkey AS uid, sum(o_totalprice) AS stated,
  coalesce(sum(o_totalprice) FILTER (WHERE o_orderstatus <> 'P'), 0) AS summed FROM orders GROUP BY o_custkey)
SELECT {ARM.format(k='uid')} AS "group", count(*) AS users, round(sum(stated), 2) AS users_revenue,
  round(sum(summed), 2) AS transactions_revenue, count(*) FILTER (WHERE abs(summed - stated) > 0.005) AS mismatch_users,
  round(sum(summed) - sum(stated), 2) AS difference FROM u GROUP BY "group" """
ORACLE["dq_chronology"] = """WITH j AS (SELECT l_returnflag, CAST(o_orderdate AS DATE) AS a,
  CASE WHEN l_linestatus = 'F' THEN CAST(try_strptime(strftime(l_shipdate, '%Y-%d-%m'), '%Y-%m-%d') AS DATE) ELSE CAST(l_shipdate AS DATE) END AS b
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT l_returnflag, count(*) AS rows, count(*) FILTER (WHERE b IS NULL OR a IS NULL) AS unreadable,
  count(*) FILTER (WHERE b < a) AS before_start FROM j GROUP BY l_returnflag"""
ORACLE["dq_missing_days"] = """WITH e AS (SELECT user_id, min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events GROUP BY user_id),
s AS (SELECT user_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS missing_day FROM e)
SELECT * FROM s WHERE (user_id, missing_day) NOT IN (SELECT (user_id, CAST(ts AS DATE)) FROM events)"""
ORACLE["dq_days"] = """SELECT count(*) AS rows, count(DISTINCT d) AS days, count(*) - count(DISTINCT d) AS duplicate_days,
  CAST(max(d) - min(d) + 1 - count(DISTINCT d) AS BIGINT) AS missing_days FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)"""
ORACLE["dq_ratio"] = f"WITH {MART} SELECT count(*) AS rows, round(max(abs(round(ctr, 3) - ctr)), 8) AS max_error FROM mart"
ORACLE["dq_domain"] = """WITH s AS (SELECT event_type AS value, count(*) AS rows FROM events GROUP BY event_type),
w AS (SELECT unnest(['view', 'click', 'purchase', 'refund']) AS value)
SELECT coalesce(s.value, w.value) AS value, coalesce(rows, 0) AS rows,
  CASE WHEN w.value IS NULL THEN 'unexpected' WHEN s.value IS NULL THEN 'absent' ELSE 'ok' END AS status
FROM s FULL JOIN w ON s.value = w.value"""
ORACLE["dq_denominator"] = "SELECT count(*) AS rows, count(*) FILTER (WHERE c_acctbal IS NULL OR c_acctbal <= 0) AS non_positive FROM customer"
ORACLE["dq_user_unique_group"] = """SELECT count(*) AS users, count(*) FILTER (WHERE n > 1) AS users_in_two_groups
FROM (SELECT o_custkey, count(DISTINCT o_orderstatus) AS n FROM orders GROUP BY o_custkey)"""
ORACLE["dq_fanout"] = f"""WITH {EXPERIMENT} SELECT (SELECT count(*) FROM people) AS rows_before, (SELECT count(*) FROM experiment) AS rows_after,
  (SELECT count(*) - count(DISTINCT uid) FROM experiment) AS repeated_keys"""
ORACLE["dq_contract"] = """SELECT 'events' AS table_name, count(*) AS rows, TRUE AS header_ok, TRUE AS types_ok, TRUE AS rows_ok FROM events
UNION ALL SELECT 'customer', count(*), TRUE, TRUE, TRUE FROM customer
UNION ALL SELECT 'nation', count(*), TRUE, FALSE, count(*) = 25 FROM nation
UNION ALL SELECT 'region', count(*), FALSE, FALSE, count(*) = 5 FROM region"""
ORACLE["srm"] = f"""WITH s AS (SELECT c_mktsegment AS arm, count(*) AS n FROM customer GROUP BY c_mktsegment),
x AS (SELECT {", ".join(f"max(n) FILTER (WHERE arm = '{arm}') AS n_{i}" for i, arm in enumerate(("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")))},
  CAST(sum(n) AS BIGINT) AS users, sum(pow(n - (SELECT sum(n) FROM s) / 5, 2)) / (sum(n) / 5) AS chi2 FROM s)
SELECT n_0, n_1, n_2, n_3, n_4, users, round(chi2, 6) AS chi2, CAST(4 AS BIGINT) AS dof, round({chi2_tail('chi2', '4')}, 6) AS p_value FROM x"""

# ---- statistics ----------------------------------------------------------------------------

ORACLE["welch"] = f"""WITH {AB_PAIRS}, {WELCH} SELECT metric, n_c, n_t, round(mean_c, 4) AS mean_c, round(mean_t, 4) AS mean_t, round(diff, 4) AS diff,
  round(se, 4) AS se, round(t, 6) AS t, round(dof, 4) AS dof, round({t_tails('t', 'dof')}, 6) AS p_value,
  round(diff - {t_upper('dof')} * se, 4) AS ci_low, round(diff + {t_upper('dof')} * se, 4) AS ci_high
FROM welch WHERE metric <> 'conversion'"""
ORACLE["prop_ztest"] = f"""WITH {AB_PAIRS}, {PROPORTION} SELECT metric, n_c, n_t, round(mean_c, 6) AS mean_c, round(mean_t, 6) AS mean_t,
  round(diff, 6) AS diff, round(z, 6) AS z, round({normal_tails('z')}, 6) AS p_value FROM prop WHERE metric = 'conversion'"""
ORACLE["prop_ci"] = f"""WITH {AB_PAIRS}, {PROPORTION} SELECT metric, round(diff, 6) AS diff, round(diff - wald, 6) AS wald_low, round(diff + wald, 6) AS wald_high,
  round(diff - sqrt(pow(mean_t - lt, 2) + pow(uc - mean_c, 2)), 6) AS newcombe_low,
  round(diff + sqrt(pow(ut - mean_t, 2) + pow(mean_c - lc, 2)), 6) AS newcombe_high FROM prop WHERE metric = 'conversion'"""
ORACLE["chi2_conv"] = f"""WITH {AB}, c AS (SELECT CAST(count(*) FILTER (WHERE testgroup = 'a' AND revenue > 0) AS DOUBLE) AS a,
  CAST(count(*) FILTER (WHERE testgroup = 'b' AND revenue > 0) AS DOUBLE) AS b,
  CAST(count(*) FILTER (WHERE testgroup = 'a' AND revenue <= 0) AS DOUBLE) AS c,
  CAST(count(*) FILTER (WHERE testgroup = 'b' AND revenue <= 0) AS DOUBLE) AS d, count(*) AS n FROM ab),
x AS (
  SELECT n, FALSE AS corrected, n * pow(a * d - b * c, 2) / ((a + b) * (c + d) * (a + c) * (b + d)) AS chi2 FROM c
  UNION ALL
  SELECT n, TRUE, n * pow(greatest(abs(a * d - b * c) - n / 2, 0), 2) / ((a + b) * (c + d) * (a + c) * (b + d)) FROM c)
SELECT 'is_payer' AS feature, n AS users, CAST(1 AS BIGINT) AS dof, round(chi2, 6) AS chi2, round({chi2_tail('chi2', '1')}, 6) AS p_value, corrected FROM x"""
ORACLE["chi2_balance"] = f"WITH {CHI2_BALANCE} SELECT feature, users, dof, round(chi2, 6) AS chi2, round({chi2_tail('chi2', 'dof')}, 6) AS p_value FROM chi"
ORACLE["kruskal"] = f"""WITH {FEATURE_RANKS} SELECT metric, users, ties, n_0, round(rank_sum_0, 1) AS rank_sum_0, n_1, round(rank_sum_1, 1) AS rank_sum_1,
  n_2, round(rank_sum_2, 1) AS rank_sum_2, round(h, 6) AS h, CAST(2 AS BIGINT) AS dof, round({chi2_tail('h', '2')}, 6) AS p_value FROM kw"""
ORACLE["mann_whitney"] = f"""WITH {UCTR}, long AS (SELECT exp_group, 'ctr' AS metric, ctr AS value FROM uctr
  UNION ALL SELECT exp_group, 'views', CAST(views AS DOUBLE) FROM uctr), {ranks('long', 'exp_group', ['1', '2'])}, {MANN_WHITNEY}
SELECT metric, users, ties, n_0, round(rank_sum_0, 1) AS rank_sum_0, n_1, round(rank_sum_1, 1) AS rank_sum_1,
  round(u, 1) AS u, round(z, 6) AS z, round({MW_P}, 6) AS p_value FROM mw"""
ORACLE["balance"] = f"""WITH {CHI2_BALANCE}, {FEATURE_RANKS.split(', long AS', 1)[0].replace('people AS', 'people2 AS', 1)}, long AS{FEATURE_RANKS.split(', long AS', 1)[1]},
b AS (SELECT feature, {chi2_tail('chi2', 'dof')} AS p FROM chi UNION ALL SELECT metric, {chi2_tail('h', '2')} FROM kw)
SELECT feature, round(p, 6) AS p_value, p < 0.05 AS significant_difference FROM b"""
ORACLE["aa_check"] = f"""WITH {EXPERIMENT}, {effects('experiment', '"group"', 'control_1', 'control_2')}
SELECT metric, round(p, 6) AS p_value, p < 0.05 AS significant_difference FROM tested
WHERE metric IN ('cr_payer', 'cr_premium', 'arpu', 'premium_arpu')"""
ORACLE["effect_table"] = f"""WITH {EXPERIMENT}, {effects('experiment', 'comparison', 'control', 'test')}
SELECT metric, round(mean_c * scale, 4) AS control, round(mean_t * scale, 4) AS test, round((mean_t - mean_c) * scale, 4) AS absolute_effect,
  round((mean_t / mean_c - 1) * 100, 4) AS relative_effect_pct, round(p, 6) AS p_value, p < 0.05 AS significant,
  round(lo * scale, 2) AS ci_low, round(hi * scale, 2) AS ci_high FROM tested"""
BOOT = f"{UCTR}, {replicates('uctr', 'exp_group', 'likes', 'views')}, {bootstrap('1', '2')}"
BOOT_SELECT = """SELECT n AS replicates, round(mean_difference, {d}) AS mean_difference, round(ci_low, {d}) AS ci_low,
  round(ci_high, {d}) AS ci_high, round(p_value, 8) AS p_value FROM boot"""
ORACLE["poisson_boot"] = f"WITH {BOOT} " + BOOT_SELECT.format(d=8)
ORACLE["poisson_boot_replicates"] = f"""WITH {UCTR}, {replicates('uctr', 'exp_group', 'likes', 'views')}
SELECT replicate, g AS exp_group, CAST(wn AS BIGINT) AS weighted_numerator, CAST(wd AS BIGINT) AS weighted_denominator, round(value, 8) AS value FROM reps"""
ORACLE["poisson_boot_mean"] = f"WITH {AB}, {replicates('ab', 'testgroup', 'revenue', '1')}, {bootstrap(repr('a'), repr('b'))} " + BOOT_SELECT.format(d=4)
ORACLE["test_summary"] = f"""WITH {BUCKETED}, pool AS (SELECT sum(likes) / sum(views) AS rate FROM uctr),
smooth AS (SELECT *, (likes + 5 * rate) / (views + 5) AS smoothed FROM uctr CROSS JOIN pool),
summary AS ({long_metrics('smooth', 'exp_group', {'Welch user CTR': 'ctr', 'Welch smoothed CTR': 'smoothed'})}
  UNION ALL {long_metrics('buckets', 'exp_group', {'Welch bucket CTR': 'bucket_ctr'})}),
pairs AS ({paired('1', '2')}), {WELCH},
long AS (SELECT exp_group, 'Mann-Whitney user CTR' AS metric, ctr AS value FROM uctr
  UNION ALL SELECT exp_group, 'Mann-Whitney bucket CTR', bucket_ctr FROM buckets),
{ranks('long', 'exp_group', ['1', '2'])}, {MANN_WHITNEY},
{replicates('uctr', 'exp_group', 'likes', 'views')}, {bootstrap('1', '2')},
six AS (SELECT metric AS method, {t_tails('t', 'dof')} AS p FROM welch UNION ALL SELECT metric, {MW_P} FROM mw
  UNION ALL SELECT 'Poisson bootstrap', p_value FROM boot)
SELECT method, round(p, 6) AS p_value, p < 0.05 AS significant FROM six"""
MART_SERIES = """series AS (
  SELECT date, 'dau' AS metric, CAST(dau AS DOUBLE) AS value FROM mart UNION ALL SELECT date, 'ctr', ctr FROM mart
  UNION ALL SELECT date, 'views', views FROM mart UNION ALL SELECT date, 'new_posts', new_posts FROM mart
  UNION ALL SELECT date, 'unique_viewed_posts', unique_viewed_posts FROM mart)"""
ORACLE["intervention_mean"] = f"WITH {MART}, {MART_SERIES}, {mean_effects('metric')}"
ORACLE["intervention_segments"] = f"""WITH series AS (
  SELECT event_type, CAST(ts AS DATE) AS date, 'events' AS metric, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY ALL
  UNION ALL SELECT event_type, CAST(ts AS DATE), 'value_sum', sum(value) FROM events GROUP BY ALL), {mean_effects('event_type, metric')}"""

# ---- chart data ----------------------------------------------------------------------------

ORACLE["hist_density"] = f"""WITH {UCTR}, e AS (SELECT min(ctr) AS lo, (max(ctr) - min(ctr)) / 50 AS w FROM uctr),
k AS (SELECT exp_group, CAST(least(floor((ctr - lo) / w), 49) AS BIGINT) AS bin, count(*) AS n FROM uctr CROSS JOIN e WHERE ctr IS NOT NULL GROUP BY ALL),
s AS (SELECT exp_group, sum(n) AS total FROM k GROUP BY exp_group)
SELECT s.exp_group, i AS bin, round(lo + i * w, 6) AS left_edge, coalesce(n, 0) AS count, round(coalesce(n, 0) / (total * w), 6) AS density
FROM s CROSS JOIN range(0, 50) r(i) CROSS JOIN e LEFT JOIN k ON k.exp_group = s.exp_group AND k.bin = i"""
ORACLE["ecdf"] = f"""WITH {UCTR} SELECT exp_group, round(ctr, 6) AS ctr, count(*) AS n,
  round(sum(count(*)) OVER (PARTITION BY exp_group ORDER BY u.ctr) / sum(count(*)) OVER (PARTITION BY exp_group), 6) AS share
FROM uctr u WHERE u.ctr IS NOT NULL GROUP BY exp_group, u.ctr"""
ORACLE["box_stats"] = f"""WITH {AB}, p AS (SELECT testgroup, revenue AS value FROM ab WHERE revenue > 0),
q AS (SELECT testgroup, quantile_cont(value, 0.25) AS q1, median(value) AS median, quantile_cont(value, 0.75) AS q3 FROM p GROUP BY testgroup),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT testgroup, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
  round(min(value) FILTER (WHERE value BETWEEN lo AND hi), 4) AS whisker_low, round(max(value) FILTER (WHERE value BETWEEN lo AND hi), 4) AS whisker_high,
  count(*) FILTER (WHERE value NOT BETWEEN lo AND hi) AS outliers FROM p JOIN f USING (testgroup) GROUP BY ALL"""

# ---- event engagement ----------------------------------------------------------------------

ORACLE["event_reach"] = """WITH f AS (SELECT CAST(ts AS DATE) AS date, user_id, bool_or(event_type = 'view') AS saw, bool_or(event_type = 'click') AS began FROM events GROUP BY ALL),
d AS (SELECT date, count(*) AS dau, count(*) FILTER (WHERE saw) AS seen_users, count(*) FILTER (WHERE began) AS started_users,
  count(*) FILTER (WHERE saw AND began) AS both_users FROM f GROUP BY date),
m AS (SELECT d.date, count(DISTINCT user_id) AS mau FROM d JOIN f ON f.date BETWEEN d.date - 29 AND d.date GROUP BY d.date)
SELECT date, dau, mau, seen_users, started_users, round(seen_users / dau, 6) AS reach, round(started_users / dau, 6) AS participation,
  round(started_users / mau, 6) AS participation_of_mau, round(both_users / nullif(seen_users, 0), 6) AS seen_to_started FROM d JOIN m USING (date)"""
ORACLE["retention_event"] = f"""WITH {REG.replace("'purchase'", "'click'")}, {retention(None, None, 14)}
SELECT day, CAST(sum(cohort_size) AS BIGINT) AS users, round(sum(share * cohort_size) / sum(cohort_size), 6) AS weighted_retention
FROM grid WHERE share IS NOT NULL AND day IN (1, 7, 14) GROUP BY day"""
ORACLE["funnel"] = """WITH a AS (SELECT user_id, min(ts) AS t0 FROM events WHERE event_type = 'view' GROUP BY user_id),
b AS (SELECT a.user_id, t0, min(ts) AS t1 FROM a LEFT JOIN events e ON e.user_id = a.user_id AND event_type = 'click' AND ts >= t0 GROUP BY ALL),
d AS (SELECT b.user_id, t0, t1, min(ts) AS t2 FROM b LEFT JOIN events e ON e.user_id = b.user_id AND event_type = 'purchase' AND ts >= t1 GROUP BY ALL),
c AS (SELECT count(t0) AS c0, count(t1) AS c1, count(t2) AS c2 FROM d)
SELECT CAST(1 AS BIGINT) AS step, 'view' AS name, c0 AS users, 1.0 AS from_previous, 1.0 AS from_start, CAST(0 AS BIGINT) AS dropped FROM c
UNION ALL SELECT 2, 'click', c1, round(c1 / c0, 6), round(c1 / c0, 6), c0 - c1 FROM c
UNION ALL SELECT 3, 'purchase', c2, round(c2 / c1, 6), round(c2 / c0, 6), c1 - c2 FROM c"""
ORACLE["time_to_step"] = """WITH a AS (SELECT user_id, min(ts) AS t0 FROM events WHERE event_type = 'view' GROUP BY user_id),
f AS (SELECT a.user_id, t0, min(ts) AS t2 FROM a JOIN events e ON e.user_id = a.user_id AND event_type = 'purchase' AND ts >= t0 GROUP BY ALL),
d AS (SELECT user_id, (epoch_us(t2) - epoch_us(t0)) / 1e6 AS seconds,
  (SELECT count(*) FROM events e WHERE e.user_id = f.user_id AND event_type = 'click' AND ts <= t2) AS attempts FROM f)
SELECT count(*) AS users, round(avg(seconds), 2) AS mean_seconds, round(avg(attempts), 2) AS mean_attempts,
  round(median(seconds), 2) AS median_seconds, round(median(attempts), 2) AS median_attempts FROM d"""
SESSIONS = """s AS (SELECT user_id, CAST(ts AS DATE) AS date, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) <= 10800000000 THEN 0 ELSE 1 END AS start
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""
ORACLE["sessions"] = f"WITH {SESSIONS} SELECT user_id, date, CAST(sum(start) AS BIGINT) AS sessions, count(*) AS events FROM s GROUP BY user_id, date"
ORACLE["session_lengths"] = """WITH s AS (SELECT user_id, ts, event_id, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) <= 10800000000 THEN 0 ELSE 1 END AS start
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT user_id, ts, sum(start) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS number FROM s),
g AS (SELECT user_id, number, min(ts) AS a, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds FROM n GROUP BY ALL)
SELECT CAST(a AS DATE) AS date, count(*) AS sessions, round(avg(seconds), 2) AS mean_seconds, round(max(seconds), 2) AS longest_seconds,
  count(*) FILTER (WHERE seconds = 0) AS instant_sessions FROM g GROUP BY 1"""
ORACLE["participants_by_age"] = """WITH f AS (SELECT user_id, CAST(min(ts) AS DATE) AS born FROM events GROUP BY user_id),
d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS date FROM events WHERE event_type = 'click')
SELECT date, count(*) AS participants, count(*) FILTER (WHERE date = born) AS new_participants,
  count(*) FILTER (WHERE date <> born) AS returned_participants, round(count(*) FILTER (WHERE date = born) / count(*), 6) AS new_share
FROM d JOIN f USING (user_id) GROUP BY date"""
ORACLE["session_summary"] = f"""WITH {SESSIONS} SELECT count(DISTINCT user_id) AS users, CAST(sum(start) AS BIGINT) AS sessions,
  count(DISTINCT (user_id, date)) AS active_days, round(sum(start) / count(DISTINCT user_id), 6) AS sessions_per_user,
  round(count(*) / sum(start), 6) AS events_per_session, round(count(DISTINCT (user_id, date)) / count(DISTINCT user_id), 6) AS days_per_user FROM s"""
ORACLE["churn_after"] = """WITH p AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'view' AND CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'),
h AS (SELECT unnest([1, 3, 7]) AS days),
c AS (SELECT days, count(*) AS participants, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = p.user_id
  AND CAST(e.ts AS DATE) > DATE '2024-01-16' AND CAST(e.ts AS DATE) <= DATE '2024-01-16' + days)) AS churned FROM p CROSS JOIN h GROUP BY days)
SELECT CAST(days AS BIGINT) AS days, participants, churned, round(churned / participants, 6) AS churn FROM c"""
ORACLE["stickiness"] = """WITH a AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events), t AS (SELECT d, count(*) AS dau FROM a GROUP BY d),
m AS (SELECT t.d, count(DISTINCT user_id) AS mau FROM t JOIN a ON a.d BETWEEN t.d - 6 AND t.d GROUP BY t.d)
SELECT t.d AS date, dau, mau, round(dau / mau, 6) AS stickiness FROM t JOIN m USING (d)"""
ORACLE["rollback"] = f"""WITH {ORDERED}, w AS (
  SELECT *, lag(level) OVER o AS prev, lead(time) OVER o AS next_time,
         max(level) OVER (PARTITION BY user_id ORDER BY time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best,
         row_number() OVER o AS rn FROM activity WINDOW o AS (PARTITION BY user_id ORDER BY time, event_id)),
l AS (
  SELECT *, prev - level AS depth,
         (SELECT min(n.time) FROM w n WHERE n.user_id = w.user_id AND n.rn > w.rn AND n.level >= w.best) AS recovered_at,
         (SELECT max(time) FROM activity) AS e FROM w WHERE level < prev)
SELECT count(*) AS rollbacks, round(avg(depth), 4) AS mean_depth, round(count(recovered_at) / count(*), 4) AS recovered_share,
  round(avg((epoch_us(recovered_at) - epoch_us(time)) / 1e6), 4) AS mean_seconds_to_recover,
  {", ".join(f"round(count(*) FILTER (WHERE time + INTERVAL {n} DAY <= e AND (next_time IS NULL OR next_time > time + INTERVAL {n} DAY)) / nullif(count(*) FILTER (WHERE time + INTERVAL {n} DAY <= e), 0), 4) AS churn_{n}d" for n in (1, 3, 7))},
  round(quantile_cont(depth, 0.95), 4) AS p95_depth, round(count(*) / (SELECT count(prev) FROM w), 4) AS frequency,
  round((SELECT sum(level - prev) FROM w) / (SELECT count(DISTINCT (user_id, CAST(time AS DATE))) FROM w), 4) AS net_progress_per_day FROM l"""
CHAINS = f"""WITH {ORDERED}, w AS (
  SELECT *, lag(level) OVER o AS prev, row_number() OVER o AS rn,
         max(level) OVER (PARTITION BY user_id ORDER BY time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best
  FROM activity WINDOW o AS (PARTITION BY user_id ORDER BY time, event_id)),
f AS (SELECT *, coalesce(level < prev, false) AS drop, coalesce(level >= best, true) AS peak,
  sum(CASE WHEN coalesce(level >= best, true) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY rn) AS g FROM w),
g AS (SELECT user_id, g, min(rn) AS begins, max(rn) AS ends, min(rn) FILTER (WHERE drop) AS opens, max(max(g)) OVER (PARTITION BY user_id) AS last
  FROM f GROUP BY user_id, g),
c AS (SELECT *, g < last AS won, ends - opens + (g < last)::INT AS tries, ends + 1 AS r FROM g WHERE opens IS NOT NULL),
d AS (SELECT c.*, (SELECT min(f.rn) FROM f WHERE f.user_id = c.user_id AND f.rn > c.r AND f.drop) AS lost FROM c),
e AS (SELECT d.*, won AND EXISTS (SELECT 1 FROM f WHERE f.user_id = d.user_id AND f.rn >= d.r AND f.rn < coalesce(d.lost, 1e9) AND f.level >= 95) AS done FROM d)
"""
ORACLE["retry_chains"] = f"""{CHAINS}, u AS (SELECT user_id, count(*) - 1 AS n, max(level) - min_by(level, rn) AS gained FROM f GROUP BY user_id)
SELECT (SELECT count(*) FROM u) AS users, count(*) AS episodes, count(*) FILTER (WHERE tries > 0) AS retried, count(*) FILTER (WHERE won) AS recovered,
  count(*) FILTER (WHERE done) AS completed, count(*) FILTER (WHERE NOT won) AS stuck_users, max(tries) AS longest_chain,
  (SELECT CAST(sum(n) AS BIGINT) FROM u) AS attempts, round(count(*) FILTER (WHERE tries > 0) / count(*), 6) AS retry_share,
  round(count(*) FILTER (WHERE won) / count(*) FILTER (WHERE tries > 0), 6) AS recovery_share,
  round(count(*) FILTER (WHERE done) / count(*) FILTER (WHERE won), 6) AS completion_share,
  round(sum(tries) FILTER (WHERE won) / count(*) FILTER (WHERE won), 6) AS attempts_to_recover,
  round((SELECT sum(n) / sum(gained) FROM u), 6) AS attempts_per_level FROM e"""
ORACLE["spend_after_rollback"] = f"""{CHAINS}, b AS (SELECT user_id, rn, time, (SELECT min(n.rn) FROM f n WHERE n.user_id = f.user_id AND n.rn > f.rn AND n.peak) IS NOT NULL AS won FROM f WHERE drop),
s AS (SELECT b.user_id, b.rn, any_value(won) AS won, count(p.value) AS n, coalesce(sum(p.value), 0) AS spent FROM b LEFT JOIN events p
  ON p.user_id = b.user_id AND p.event_type = 'purchase' AND p.ts > b.time AND p.ts <= b.time + INTERVAL 24 HOUR GROUP BY b.user_id, b.rn)
SELECT count(*) AS rollbacks, count(*) FILTER (WHERE n > 0) AS paying_rollbacks, round(count(*) FILTER (WHERE n > 0) / count(*), 4) AS paying_share,
  round(sum(n) / count(*), 4) AS purchases_per_rollback, round(sum(spent) / count(*), 4) AS spent_per_rollback,
  round(count(*) FILTER (WHERE n > 0 AND won) / count(*) FILTER (WHERE n > 0), 4) AS recovered_share_paying,
  round(count(*) FILTER (WHERE n = 0 AND won) / count(*) FILTER (WHERE n = 0), 4) AS recovered_share_others FROM s"""
LIVES = """WITH l AS (SELECT user_id, CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS arm, min(CAST(ts AS DATE)) AS born, max(CAST(ts AS DATE)) AS last
  FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-27' GROUP BY ALL),
lives AS (SELECT *, DATE '2024-01-27' - last > 2 AS gone, DATE '2024-01-27' - born AS seen,
  CASE WHEN DATE '2024-01-27' - last > 2 THEN last - born ELSE DATE '2024-01-27' - born END AS age FROM l),
sets AS (SELECT arm, age, count(*) FILTER (WHERE gone) AS leavers, count(*) FILTER (WHERE NOT gone) AS censored,
  (SELECT count(*) FROM lives x WHERE x.arm = lives.arm AND x.age >= lives.age) AS at_risk FROM lives GROUP BY arm, age)"""
ORACLE["survival"] = f"""{LIVES}, p AS (SELECT a.*, (SELECT product(1 - b.leavers / b.at_risk) FROM sets b WHERE b.arm = a.arm AND b.age <= a.age) AS s,
  (SELECT coalesce(sum(b.leavers / (b.at_risk * (b.at_risk - b.leavers))) FILTER (WHERE b.leavers < b.at_risk), 0) FROM sets b WHERE b.arm = a.arm AND b.age <= a.age) AS v FROM sets a)
SELECT arm, CAST(age AS BIGINT) AS age, at_risk, leavers, censored, round(s, 6) AS survival, round(s * sqrt(v), 6) AS se FROM p"""
ORACLE["log_rank"] = f"""{LIVES}, ages AS (SELECT DISTINCT age FROM lives),
r AS (SELECT ages.age, count(*) FILTER (WHERE arm = 'a' AND gone AND l.age = ages.age) AS dc, count(*) FILTER (WHERE arm = 'b' AND gone AND l.age = ages.age) AS dt,
  count(*) FILTER (WHERE arm = 'a') AS nc, count(*) FILTER (WHERE arm = 'b') AS nt FROM ages JOIN lives l ON l.age >= ages.age GROUP BY 1),
s AS (SELECT CAST(sum(dt) AS BIGINT) AS observed, sum((dc + dt) * nt / (nc + nt)) AS expected,
  sum(CASE WHEN nc + nt > 1 THEN (dc + dt) * (nt / (nc + nt)) * (nc / (nc + nt)) * (nc + nt - dc - dt) / (nc + nt - 1) ELSE 0 END) AS variance FROM r)
SELECT observed, round(expected, 6) AS expected, round(variance, 6) AS variance, round((observed - expected) / sqrt(variance), 6) AS z,
  round({normal_tails('((observed - expected) / sqrt(variance))')}, 6) AS p_value FROM s"""
ORACLE["lifetime_value"] = f"""{LIVES}, h AS (SELECT unnest([0, 7, 14, 25]) AS day), g AS (SELECT unnest(range(0, 26)) AS age),
w AS (SELECT arm, g.age, count(*) AS users, count(*) FILTER (WHERE seen >= g.age) AS observed FROM lives CROSS JOIN g GROUP BY ALL),
v AS (SELECT l.user_id, l.arm, h.day, coalesce(sum(e.value * w.users / w.observed), 0) AS v FROM lives l CROSS JOIN h
  LEFT JOIN events e ON e.user_id = l.user_id AND e.event_type = 'purchase' AND CAST(e.ts AS DATE) - l.born BETWEEN 0 AND least(h.day, l.seen)
  LEFT JOIN w ON w.arm = l.arm AND w.age = CAST(e.ts AS DATE) - l.born GROUP BY ALL)
SELECT v.arm, CAST(v.day AS BIGINT) AS day, count(*) AS users, any_value(w.observed) AS observed,
  CASE WHEN any_value(w.observed) > 0 THEN round(avg(v), 4) END AS ltv, CASE WHEN any_value(w.observed) > 0 THEN round(stddev_samp(v) / sqrt(count(*)), 4) END AS se
FROM v JOIN w ON w.arm = v.arm AND w.age = v.day GROUP BY v.arm, v.day"""
ORACLE["stratified_assignment"] = f"""WITH {EXPERIMENT}, u AS (SELECT uid, country, gender,
  row_number() OVER (PARTITION BY country, gender ORDER BY md5('7|' || uid::VARCHAR), uid) - 1 AS r FROM experiment)
SELECT uid, country, gender, CASE WHEN r % 3 < 2 THEN 'control' ELSE 'test' END AS arm FROM u"""
TAILS = f"""WITH {EXPERIMENT}, x AS (SELECT "group" AS g, coalesce(total_revenue, 0) AS x FROM experiment),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY x DESC) AS rank FROM x WHERE x > 0), k AS (SELECT unnest([0, 1, 5, 10, 50, 100]) AS k),
t AS (SELECT g, count(*) AS users, sum(x) AS total, count(*) FILTER (WHERE x > 0) AS payers FROM x GROUP BY g),
c AS (SELECT t.*, k, coalesce((SELECT sum(x) FROM r WHERE r.g = t.g AND rank <= k), 0) AS gone,
  (SELECT sum(ln(r.x / n.x)) FROM r, r n WHERE r.g = t.g AND n.g = t.g AND n.rank = k + 1 AND r.rank <= k) AS logs FROM t CROSS JOIN k)"""
ORACLE["tail_check"] = f"""{TAILS} SELECT g AS "group", CAST(k AS BIGINT) AS removed, users, payers,
  CASE WHEN payers >= k THEN round(gone / total, 6) END AS removed_share, CASE WHEN payers >= k THEN round((total - gone) / (users - k), 6) END AS mean_left,
  CASE WHEN payers > k AND k > 0 THEN round(k / nullif(logs, 0), 6) END AS hill_index FROM c"""
ORACLE["tail_effect"] = f"""{TAILS}, m AS (SELECT k, max((total - gone) / (users - k)) FILTER (WHERE g = 'control_1' AND payers >= k) AS a,
  max((total - gone) / (users - k)) FILTER (WHERE g = 'test' AND payers >= k) AS b FROM c GROUP BY k)
SELECT CAST(k AS BIGINT) AS removed, round(a, 6) AS mean_control, round(b, 6) AS mean_test, round(b - a, 6) AS effect, round((b - a) / a * 100, 6) AS effect_pct FROM m"""
ORACLE["funnel_by"] = """WITH u AS (SELECT DISTINCT user_id, CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS arm FROM events),
a AS (SELECT user_id, min(ts) AS t FROM events WHERE event_type = 'view' GROUP BY 1),
b AS (SELECT e.user_id, min(ts) AS t FROM events e JOIN a USING (user_id) WHERE event_type = 'click' AND ts >= a.t GROUP BY 1),
c AS (SELECT e.user_id, min(ts) AS t FROM events e JOIN b USING (user_id) WHERE event_type = 'purchase' AND ts >= b.t GROUP BY 1),
d AS (SELECT e.user_id, min(ts) AS t FROM events e JOIN c USING (user_id) WHERE event_type = 'signup' AND ts >= c.t GROUP BY 1),
n AS (SELECT arm, count(a.user_id) AS n1, count(b.user_id) AS n2, count(c.user_id) AS n3, count(d.user_id) AS n4
  FROM u LEFT JOIN a USING (user_id) LEFT JOIN b USING (user_id) LEFT JOIN c USING (user_id) LEFT JOIN d USING (user_id) GROUP BY arm)
SELECT arm, CAST(1 AS BIGINT) AS step, 'view' AS name, n1 AS users, CAST(1 AS DOUBLE) AS from_previous, CAST(1 AS DOUBLE) AS from_start, CAST(0 AS BIGINT) AS dropped, round(n4 / n1, 6) AS reward_share FROM n
UNION ALL SELECT arm, 2, 'click', n2, round(n2 / n1, 6), round(n2 / n1, 6), n1 - n2, round(n4 / n1, 6) FROM n
UNION ALL SELECT arm, 3, 'purchase', n3, round(n3 / n2, 6), round(n3 / n1, 6), n2 - n3, round(n4 / n1, 6) FROM n"""
ORACLE["daily_mart_incremental"] = ORACLE["daily_mart"]
ORACLE["dq_date_order"] = """WITH r AS (SELECT o_custkey % 5 AS k, CASE WHEN o_custkey % 5 = 3 THEN o_orderkey ELSE CAST(o_orderdate AS DATE) - DATE '1970-01-01' END AS number,
  CAST(o_orderdate AS DATE) AS t, o_custkey % 5 = 1 OR (o_custkey % 5 = 4 AND o_orderkey % 2 = 0) AS swapped FROM orders),
s AS (SELECT 'file_' || k AS file, number, k, CASE WHEN swapped THEN month(t) ELSE day(t) END AS a, CASE WHEN swapped THEN day(t) ELSE month(t) END AS b, year(t) AS y
  FROM r WHERE k NOT IN (2, 3) OR day(t) <= 12),
p AS (SELECT *, TRY_CAST(y || '-' || lpad(b::VARCHAR, 2, '0') || '-' || lpad(a::VARCHAR, 2, '0') AS DATE) AS d,
  TRY_CAST(y || '-' || lpad(a::VARCHAR, 2, '0') || '-' || lpad(b::VARCHAR, 2, '0') AS DATE) AS m FROM s),
f AS (SELECT file, count(*) AS dates, count(*) FILTER (WHERE d IS NULL AND m IS NULL) AS unreadable, count(*) FILTER (WHERE d IS NOT NULL AND m IS NULL) AS day_proofs,
  count(*) FILTER (WHERE d IS NULL AND m IS NOT NULL) AS month_proofs,
  corr(number, d - DATE '1970-01-01') FILTER (WHERE d IS NOT NULL AND m IS NOT NULL) AS df, corr(number, m - DATE '1970-01-01') FILTER (WHERE d IS NOT NULL AND m IS NOT NULL) AS mf,
  count(d) AS n_d, count(m) AS n_m, count(*) FILTER (WHERE d = m) AS n_same FROM p GROUP BY file),
o AS (SELECT *, CASE WHEN day_proofs > 0 AND month_proofs = 0 THEN 'day first' WHEN month_proofs > 0 AND day_proofs = 0 THEN 'month first'
  WHEN day_proofs + month_proofs = 0 AND df >= 0.9 AND df >= mf + 0.05 THEN 'day first' WHEN day_proofs + month_proofs = 0 AND mf >= 0.9 AND mf >= df + 0.05 THEN 'month first'
  ELSE 'undecided' END AS ord FROM f)
SELECT file, ord AS "order", dates, CASE ord WHEN 'day first' THEN n_d WHEN 'month first' THEN n_m ELSE n_same END AS told, unreadable, day_proofs, month_proofs,
  round(df, 6) AS day_fit, round(mf, 6) AS month_fit FROM o"""
ORACLE["mann_whitney_exact"] = f"""WITH RECURSIVE {EXPERIMENT}, x AS (SELECT country, gender, "group" = 'control_1' AS f, total_revenue AS v FROM experiment
  WHERE "group" IN ('control_1', 'test')),
r AS (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY country, gender, v) - 1) / 2 AS m, row_number() OVER w AS i FROM x WINDOW w AS (PARTITION BY country, gender ORDER BY v)),
t AS (SELECT country, gender, count(*) AS n, count(*) FILTER (WHERE f) AS n0, sum(m) FILTER (WHERE f) AS s0, sum(m) AS s FROM r GROUP BY ALL),
d AS (SELECT country, gender, 0 AS i, 0 AS k, CAST(0 AS DOUBLE) AS s, CAST(1 AS DOUBLE) AS ways FROM t WHERE n <= 200
  UNION ALL SELECT d.country, d.gender, r.i, k + c, d.s + c * m, sum(ways) FROM d JOIN r ON r.country = d.country AND r.gender = d.gender AND r.i = d.i + 1
  CROSS JOIN (SELECT unnest([0, 1]) AS c) GROUP BY ALL),
p AS (SELECT t.country, t.gender, sum(ways) FILTER (WHERE abs(d.s * n - n0 * t.s) >= abs(s0 * n - n0 * t.s) - 1e-6) / sum(ways) AS p
  FROM d JOIN t ON t.country = d.country AND t.gender = d.gender AND d.i = t.n AND d.k = t.n0 WHERE n0 BETWEEN 1 AND n - 1 GROUP BY ALL)
SELECT t.country, t.gender, n0 AS n_0, n - n0 AS n_1, CASE WHEN n0 BETWEEN 1 AND n - 1 THEN round(s0 - n0 * (n0 + 1) / 2, 6) END AS u, round(p, 6) AS p_value FROM t LEFT JOIN p ON p.country = t.country AND p.gender = t.gender"""
DID_METRICS = {"value": "value", "events": "events"}
ORACLE["diff_in_diff"] = f"""WITH u AS (SELECT user_id, ts >= TIMESTAMP '{POST[0]} 00:00:00' AS post, sum(value) AS value, count(*) AS events,
  CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS testgroup FROM events GROUP BY ALL),
summary AS ({long_metrics('u', 'testgroup', DID_METRICS, 'post,')}), pairs AS ({paired(repr('a'), repr('b'), 'post,')}),
r AS (SELECT metric, max(mean_t - mean_c) FILTER (WHERE NOT post) AS b, max(mean_t - mean_c) FILTER (WHERE post) AS a,
  sqrt(sum(var_t / n_t + var_c / n_c)) AS se FROM pairs GROUP BY metric),
x AS (SELECT *, (a - b) / se AS z FROM r)
SELECT metric, round(b, 4) AS gap_before, round(a, 4) AS gap_after, round(se, 4) AS se, round(a - b, 4) AS effect, round(z, 4) AS z,
  round({normal_tails('z')}, 6) AS p_value FROM x"""
MDE_Z = "CAST('2.801585218112969' AS DOUBLE)"
ORACLE["mde"] = f"""WITH {AB_PAIRS} SELECT metric, n_c, n_t, round({MDE_Z} * sqrt(var_c / n_c + var_t / n_t), 4) AS mde,
  round({MDE_Z} * sqrt(var_c / n_c + var_t / n_t) / mean_c * 100, 4) AS mde_pct,
  CAST(ceil({MDE_Z} * {MDE_Z} * (var_c + var_t) / pow(0.05 * mean_c, 2)) AS BIGINT) AS n_per_arm_5pct FROM pairs"""
ORACLE["stratified"] = f"""WITH {EXPERIMENT}, summary AS ({long_metrics('experiment', 'comparison', {'arpu': 'total_revenue', 'cr_payer': 'payer'}, 'country,')}),
pairs AS ({paired(repr('control'), repr('test'), 'country,')}), {WELCH},
r AS (SELECT metric, count(*) AS strata, sum((n_c + n_t) * diff) / sum(n_c + n_t) AS diff, sqrt(sum(pow((n_c + n_t) * se, 2))) / sum(n_c + n_t) AS se
  FROM welch GROUP BY metric), x AS (SELECT *, diff / se AS z FROM r)
SELECT metric, strata, round(diff, 4) AS diff, round(se, 4) AS se, round(z, 4) AS z, round({normal_tails('z')}, 6) AS p_value FROM x"""

LEVEL_MODEL = f"""series AS (
  SELECT event_type, CAST(ts AS DATE) AS date, 'events' AS metric, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY ALL
  UNION ALL SELECT event_type, CAST(ts AS DATE), 'value_sum', sum(value) FROM events GROUP BY ALL),
pre AS (SELECT *, row_number() OVER (PARTITION BY event_type, metric ORDER BY date) AS i FROM series
  WHERE date BETWEEN DATE '{PRE[0]}' AND DATE '{PRE[1]}'),
stat AS (SELECT event_type, metric, avg(value) AS centre, stddev_samp(value) AS unit, count(*) AS n FROM pre GROUP BY ALL),
scaled AS (SELECT event_type, metric, i, (value - centre) / unit AS v FROM pre JOIN stat USING (event_type, metric)),
ratios AS (SELECT g, (-8 + CAST(12 AS DOUBLE) * g / 1200) * ln(10) AS lr, exp((-8 + CAST(12 AS DOUBLE) * g / 1200) * ln(10)) AS q FROM range(0, 1201) r(g)),
filtered AS (
  SELECT event_type, metric, g, q, lr, i, v AS level, CAST(1 AS DOUBLE) AS spread, CAST(0 AS DOUBLE) AS squares, CAST(0 AS DOUBLE) AS logs
  FROM scaled CROSS JOIN ratios WHERE i = 1
  UNION ALL
  SELECT f.event_type, f.metric, g, q, lr, s.i, level + (spread + q) / (spread + q + 1) * (s.v - level), (spread + q) / (spread + q + 1),
         squares + pow(s.v - level, 2) / (spread + q + 1), logs + ln(spread + q + 1)
  FROM filtered f JOIN scaled s ON s.event_type = f.event_type AND s.metric = f.metric AND s.i = f.i + 1),
ends AS (SELECT f.*, centre, unit, CAST(n - 1 + 32 AS DOUBLE) / 2 AS shape, (squares + 32 * CAST(0.0001 AS DOUBLE) / q) / 2 AS rate
  FROM filtered f JOIN stat USING (event_type, metric) WHERE i = n),
logged AS (SELECT *, -shape * ln(rate) - logs / 2 - 16 * lr AS lw FROM ends),
weighted AS (SELECT *, exp(lw - max(lw) OVER (PARTITION BY event_type, metric)) AS w FROM logged),
posterior AS (SELECT *, sum(w * level) OVER (PARTITION BY event_type, metric) / sum(w) OVER (PARTITION BY event_type, metric) AS mean FROM weighted),
later AS (SELECT event_type, metric, date, value, date - DATE '{PRE[1]}' AS h FROM series WHERE date BETWEEN DATE '{POST[0]}' AND DATE '{POST[1]}')"""
ORACLE["intervention_daily"] = f"""WITH RECURSIVE {LEVEL_MODEL},
f AS (SELECT event_type, metric, date, any_value(value) AS actual, any_value(centre + unit * mean) AS predicted,
  any_value(unit) * sqrt(sum(w * (rate / (shape - 1) * (spread + h * q + 1) + pow(level - mean, 2))) / sum(w)) AS deviation
  FROM later JOIN posterior USING (event_type, metric) GROUP BY event_type, metric, date)
SELECT event_type, metric, date, round(actual, 4) AS actual, round(predicted, 4) AS predicted,
  round(predicted - {Z} * deviation, 4) AS low, round(predicted + {Z} * deviation, 4) AS high FROM f"""
ORACLE["intervention_level"] = f"""WITH RECURSIVE {LEVEL_MODEL},
days AS (SELECT event_type, metric, count(*) AS m, avg(value) AS actual FROM later GROUP BY ALL),
steps AS (SELECT a.event_type, a.metric, avg(CAST(least(a.h, b.h) AS DOUBLE)) AS s FROM later a JOIN later b USING (event_type, metric) GROUP BY ALL),
f AS (SELECT event_type, metric, any_value(m) AS m, any_value(actual) AS actual, any_value(centre + unit * mean) AS predicted,
  any_value(unit) * sqrt(sum(w * (rate / (shape - 1) * (spread + s * q + CAST(1 AS DOUBLE) / m) + pow(level - mean, 2))) / sum(w)) AS deviation
  FROM days JOIN steps USING (event_type, metric) JOIN posterior USING (event_type, metric) GROUP BY event_type, metric),
e AS (SELECT *, actual - predicted AS effect, actual - predicted - {Z} * deviation AS lo, actual - predicted + {Z} * deviation AS hi FROM f)
SELECT event_type, metric, m AS n_post, round(actual, 4) AS actual, round(predicted, 4) AS predicted, round(effect, 4) AS effect,
  round(lo, 4) AS ci_low, round(hi, 4) AS ci_high,
  CASE WHEN lo <= 0 AND hi >= 0 THEN 'нет убедительного изменения' WHEN effect > 0 THEN 'рост' ELSE 'снижение' END AS result FROM e"""
# The same model for the series of the daily mart.
ORACLE["intervention"] = ORACLE["intervention_level"].replace(
    LEVEL_MODEL[:LEVEL_MODEL.index("pre AS (SELECT *, row_number()")],
    f"{MART}, {MART_SERIES.replace('series AS', 'by_metric AS')}, "
    "series AS (SELECT 'all' AS event_type, * FROM by_metric), ",
).replace("SELECT event_type, metric, m AS n_post", "SELECT metric, m AS n_post")

