"""SQL twins of the registered queries, written for DuckDB on the given tables."""

from __future__ import annotations

from catalog.queries import CASUAL, DEFAULT, DENSE, HOT_QUERIES, MIXED, SAMPLE_SIZE, STUMP_INPUTS
from catalog.tables import BLOCK_CUSTOMERS, BLOCK_ITEMS, BLOCK_USERS
from starwise.config import HASH_PRIME, Config

RATED = """
r AS (
  SELECT o_custkey AS "user", l_suppkey AS item,
         CAST(MAX(1 + FLOOR((l_quantity - 1) / 10)) AS DOUBLE) AS stars
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_suppkey
)"""

HELD_OUT = {
    "blocks": '(("user" * 31 + item * 17) % 10 = 0)',
    "plain": '(("user" * 31 + item * 17) % 10 = 0)',
    "cold": '(("user" * 31 + item * 17) % 10 = 0 OR "user" % 50 = 0 OR item % 33 = 32)',
}

MEANS = """
im AS (SELECT item, AVG(stars) AS avg_stars, COUNT(*) AS n FROM t GROUP BY item),
um AS (SELECT "user", AVG(stars) AS avg_stars, COUNT(*) AS n FROM t GROUP BY "user"),
g AS (SELECT AVG(stars) AS avg_stars, COUNT(*) AS n FROM t),
popular AS (SELECT item, n FROM im WHERE n >= 100),
active AS (SELECT "user", n FROM um WHERE n BETWEEN 2 AND 499)"""


def split(name: str) -> str:
    rule, rated = HELD_OUT[name], RATED
    if name == "blocks":
        user = f"(o_custkey - 1) // {BLOCK_CUSTOMERS}"
        item = f"{BLOCK_ITEMS} * ({user} // {BLOCK_USERS}) + l_suppkey % {BLOCK_ITEMS}"
        rated = RATED.replace("GROUP BY o_custkey, l_suppkey", f"GROUP BY {user}, {item}")
        rated = rated.replace('o_custkey AS "user", l_suppkey AS item', f'{user} AS "user", {item} AS item')
    return f"{rated},\nt AS (SELECT * FROM r WHERE NOT {rule}),\nq AS (SELECT * FROM r WHERE {rule}),{MEANS}"


def signatures(config: Config, user: str = 't."user"') -> str:
    """Signatures, buckets and candidates; ``user`` is the number that stands for a user."""
    values = ", ".join(
        f"({ix}, {', '.join(f'{value}::BIGINT' for value in row)})" for ix, row in enumerate(config.lsh.hash_table())
    )
    return f"""
params(hash_ix, a0, a1, a2, b, c0, c1, c2, d) AS (VALUES {values}),
raters AS (SELECT t.item, {user} AS u FROM t JOIN popular ON t.item = popular.item),
words AS (SELECT item, u & 4194303 AS w0, (u >> 22) & 4194303 AS w1, u >> 44 AS w2 FROM raters),
sig AS (
  SELECT item, hash_ix, MIN(((a0 * w0 + a1 * w1 + a2 * w2 + b) % {HASH_PRIME}) * 2147483648
                            + (c0 * w0 + c1 * w1 + c2 * w2 + d) % {HASH_PRIME}) AS h
  FROM words CROSS JOIN params
  GROUP BY item, hash_ix
),
bands AS (
  SELECT item, hash_ix // {config.lsh.rows} AS band, STRING_AGG(h::VARCHAR, '-' ORDER BY hash_ix) AS sig_key
  FROM sig GROUP BY item, hash_ix // {config.lsh.rows}
),
mates AS (
  SELECT DISTINCT x.item AS i, y.item AS j
  FROM bands x JOIN bands y ON x.band = y.band AND x.sig_key = y.sig_key AND x.item < y.item
),
cand AS (
  SELECT DISTINCT c.i, c.j FROM mates c
  JOIN t x ON x.item = c.i JOIN t y ON y.item = c.j AND y."user" = x."user" JOIN active a ON a."user" = x."user"
)"""


SIMILAR = """
moments AS (
  SELECT c.i, c.j, COUNT(*) AS n, SUM(x.stars) AS sum_i, SUM(y.stars) AS sum_j,
         SUM(x.stars * x.stars) AS sum_ii, SUM(y.stars * y.stars) AS sum_jj,
         SUM(x.stars * y.stars) AS sum_ij
  FROM cand c
  JOIN t x ON x.item = c.i
  JOIN t y ON y.item = c.j AND y."user" = x."user"
  JOIN active a ON a."user" = x."user"
  GROUP BY c.i, c.j
),
spread AS (
  SELECT m.*,
         sum_ij - mj.avg_stars * sum_i - mi.avg_stars * sum_j + m.n * mi.avg_stars * mj.avg_stars AS cross_ij,
         sum_ii + m.n * (mi.avg_stars * mi.avg_stars) - 2 * mi.avg_stars * sum_i AS var_i,
         sum_jj + m.n * (mj.avg_stars * mj.avg_stars) - 2 * mj.avg_stars * sum_j AS var_j
  FROM moments m JOIN im mi ON mi.item = m.i JOIN im mj ON mj.item = m.j
),
sims AS (
  SELECT i, j, n,
         CASE WHEN n >= 2 AND var_i > 1e-9::DOUBLE AND var_j > 1e-9::DOUBLE
              THEN GREATEST(-1.0::DOUBLE, LEAST(1.0::DOUBLE, cross_ij / (SQRT(var_i) * SQRT(var_j))))
                   * (LEAST(n, 60) / 60.0::DOUBLE)
              ELSE 0.0::DOUBLE END AS sim
  FROM spread
),
edges AS (SELECT i AS item, j AS nbr, sim FROM sims UNION ALL SELECT j, i, sim FROM sims),
nb AS (
  SELECT item, nbr, sim, rank FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY item ORDER BY ROUND(sim, 9) DESC, nbr) AS rank FROM edges
  ) WHERE rank <= 35
),
nc AS (SELECT item, COUNT(*) AS neighbor_cnt FROM nb GROUP BY item)"""

CF = """
hits AS (
  SELECT q."user", q.item, COUNT(*) AS n_common, SUM(t.stars * nb.sim) AS weighted, SUM(ABS(nb.sim)) AS weight
  FROM q JOIN nb ON nb.item = q.item JOIN t ON t."user" = q."user" AND t.item = nb.nbr
  GROUP BY q."user", q.item
),
asked AS (
  SELECT q."user", q.item, im.avg_stars AS item_avg, um.avg_stars AS user_avg, g.avg_stars AS mean,
         COALESCE(nc.neighbor_cnt, 0) AS neighbor_cnt, h.n_common, h.weighted, h.weight,
         CASE WHEN um."user" IS NULL THEN 'new_user'
              WHEN nc.item IS NULL THEN 'no_neighbors'
              WHEN h.n_common IS NULL THEN 'no_common'
              WHEN h.weight = 0 THEN 'zero_weight'
              ELSE 'weighted' END AS reason
  FROM q CROSS JOIN g
  LEFT JOIN im ON im.item = q.item
  LEFT JOIN um ON um."user" = q."user"
  LEFT JOIN nc ON nc.item = q.item
  LEFT JOIN hits h ON h."user" = q."user" AND h.item = q.item
),
cf AS (
  SELECT *, CASE WHEN reason = 'weighted' THEN
      GREATEST(1.0::DOUBLE, LEAST(5.0::DOUBLE,
        (1 - LEAST(0.05::DOUBLE + n_common / 400.0::DOUBLE, 0.20::DOUBLE)) * (weighted / weight)
        + LEAST(0.05::DOUBLE + n_common / 400.0::DOUBLE, 0.20::DOUBLE) * mean))
    ELSE COALESCE(item_avg, mean) END AS cf
  FROM asked
)"""

USER = '"user"'

PROFILES = """
ev AS (
  SELECT user_id, COUNT(*) FILTER (event_type = 'view') AS viewed, COUNT(*) FILTER (event_type = 'click') AS click,
         COUNT(*) FILTER (event_type = 'purchase') AS purchase, COUNT(*) FILTER (event_type = 'signup') AS signup,
         COUNT(*) FILTER (event_type = 'error') AS error
  FROM events GROUP BY user_id
),
uraw AS (
  SELECT c_custkey AS "user", c_custkey % 37 <> 0 AND c_custkey % 41 <> 0 AS ok,
    CASE WHEN c_custkey % 29 = 0 OR um.avg_stars IS NULL THEN 'NaN'::DOUBLE ELSE um.avg_stars END AS u_avg_stars,
    COALESCE(um.n, 0) AS u_review_cnt,
    CASE WHEN c_custkey % 43 = 0 THEN 12 ELSE COALESCE(viewed, 0) END AS u_fans,
    COALESCE(click, 0) AS u_useful, COALESCE(purchase, 0) AS u_cool, COALESCE(signup, 0) AS u_funny,
    CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 2 END AS u_friends_cnt,
    CASE WHEN c_custkey % 4 = 2 THEN 2 ELSE 0 END AS u_elite_years,
    COALESCE(error, 0) AS u_cmp_hot, c_nationkey AS u_cmp_cool, c_custkey % 7 AS u_cmp_funny,
    CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 11 ELSE 0 END AS u_cmp_photos
  FROM customer LEFT JOIN um ON um."user" = c_custkey LEFT JOIN ev ON ev.user_id = c_custkey
),
iraw AS (
  SELECT s_suppkey AS item, s_suppkey % 31 <> 0 AS ok, s_suppkey % 10 <> 9 AS att,
    CASE WHEN s_suppkey % 23 = 0 OR im.avg_stars IS NULL THEN 'NaN'::DOUBLE ELSE im.avg_stars END AS b_avg_stars,
    COALESCE(im.n, 0) AS b_review_cnt, s_acctbal AS b_latitude,
    CASE WHEN s_suppkey % 13 = 0 THEN 0.0::DOUBLE ELSE s_nationkey * -1.5::DOUBLE END AS b_longitude,
    CASE WHEN s_suppkey % 5 = 0 THEN 3.0::DOUBLE WHEN s_suppkey % 5 = 3 THEN 4.0::DOUBLE ELSE 2.0::DOUBLE END AS b_price,
    s_suppkey % 3 < 2 AS card, s_suppkey % 4 = 0 AS reserve, s_suppkey % 6 = 1 AS wheel,
    s_suppkey % 3 = 0 AS dining
  FROM supplier LEFT JOIN im ON im.item = s_suppkey
)"""

USER_COUNTS = (
    "u_review_cnt", "u_fans", "u_useful", "u_cool", "u_funny", "u_friends_cnt",
    "u_elite_years", "u_cmp_hot", "u_cmp_cool", "u_cmp_funny", "u_cmp_photos",
)

FEATURES = f"""
uf AS (
  SELECT "user", CASE WHEN ok THEN u_avg_stars ELSE 0.0::DOUBLE END AS u_avg_stars,
    {", ".join(f"CAST(CASE WHEN ok THEN {c} ELSE 0 END AS BIGINT) AS {c}" for c in USER_COUNTS)},
    ok AS record_ok
  FROM uraw
),
itf AS (
  SELECT item,
    CASE WHEN ok THEN b_avg_stars ELSE 0.0::DOUBLE END AS b_avg_stars,
    CASE WHEN ok THEN b_review_cnt ELSE 0 END AS b_review_cnt,
    CASE WHEN ok THEN b_latitude ELSE 0.0::DOUBLE END AS b_latitude,
    CASE WHEN ok THEN b_longitude ELSE 0.0::DOUBLE END AS b_longitude,
    CASE WHEN ok AND att THEN b_price WHEN ok THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END AS b_price,
    (ok AND att AND card)::INT::DOUBLE AS b_credit_card,
    (ok AND att AND reserve)::INT::DOUBLE AS b_reservation,
    (ok AND att)::INT::DOUBLE AS b_table_service,
    (ok AND att AND wheel)::INT::DOUBLE AS b_wheelchair,
    (ok AND dining)::INT::DOUBLE AS b_is_restaurant,
    ok AS record_ok
  FROM iraw
)"""

FALLBACK = """
fb AS (
  SELECT q."user", q.item, im.avg_stars AS item_avg, um.avg_stars AS user_avg, g.avg_stars AS mean,
    0.5::DOUBLE * (
      (0.7::DOUBLE * COALESCE(im.avg_stars, g.avg_stars)
        + (1 - 0.7::DOUBLE) * CASE WHEN itf.record_ok THEN itf.b_avg_stars ELSE g.avg_stars END)
      + (0.7::DOUBLE * COALESCE(um.avg_stars, g.avg_stars)
        + (1 - 0.7::DOUBLE) * CASE WHEN uf.record_ok THEN uf.u_avg_stars ELSE g.avg_stars END)) AS score
  FROM q CROSS JOIN g
  LEFT JOIN im ON im.item = q.item LEFT JOIN um ON um."user" = q."user"
  LEFT JOIN itf ON itf.item = q.item LEFT JOIN uf ON uf."user" = q."user"
)"""

BASELINE = """
base AS (
  SELECT q."user", q.item, q.stars, COALESCE(im.avg_stars, g.avg_stars) AS prediction,
         CASE WHEN im.item IS NULL THEN 'global_mean' ELSE 'item_mean' END AS reason
  FROM q CROSS JOIN g LEFT JOIN im ON im.item = q.item
),
err AS (SELECT ABS(prediction - stars) AS e FROM base)"""

def pair_hash(first: str = '"user"', second: str = "item", start: int = 1) -> str:
    return f"('0x' || SUBSTR(MD5({first}::VARCHAR || '-' || {second}::VARCHAR), {start}, 15))::BIGINT"


def rounded(value: str) -> str:
    return f"CASE WHEN NOT ISNAN({value}) THEN ROUND({value}, 6) END"


def confidence(n: str) -> str:
    return f"0.70::DOUBLE + 0.24::DOUBLE * (LN(1 + {n}) / (LN(1 + {n}) + 3.0::DOUBLE))"


def alpha(n: str) -> str:
    return f"0.1::DOUBLE + 0.1::DOUBLE * (LN(1 + {n}) / (LN(1 + {n}) + 2.0::DOUBLE))"


STUMP_VALUES = f"[{', '.join(f'COALESCE(itf.{name}, 0)::DOUBLE' for name in STUMP_INPUTS)}]"


def stump(rows: str) -> str:
    """The best single split per ``set_id`` of ``rows`` (set_id, stars, f: the list of inputs).

    Of all midpoints between neighbouring values of an input, the one that leaves the least squared
    error; ``low`` and ``high`` are the means on both sides.
    """
    return f"""
long AS (
  SELECT set_id, k, f[k] AS v, COUNT(*) AS n, SUM(stars) AS s
  FROM {rows} CROSS JOIN (SELECT UNNEST(RANGE(1, {len(STUMP_INPUTS) + 1})) AS k) GROUP BY ALL
),
cuts AS (
  SELECT set_id, k, (v + LEAD(v) OVER w) / 2 AS cut, SUM(n) OVER w AS nl, SUM(s) OVER w AS sl,
         SUM(n) OVER (PARTITION BY set_id, k) AS n, SUM(s) OVER (PARTITION BY set_id, k) AS s
  FROM long WINDOW w AS (PARTITION BY set_id, k ORDER BY v)
),
best AS (
  SELECT set_id, k, cut, sl / nl AS low, (s - sl) / (n - nl) AS high
  FROM cuts WHERE cut IS NOT NULL AND nl >= 4 AND n - nl >= 4
  QUALIFY ROW_NUMBER() OVER (PARTITION BY set_id ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, k, cut) = 1
)"""


STUMP_SAMPLE = f"""
x AS (SELECT * FROM t ORDER BY {pair_hash()}, "user", item LIMIT {SAMPLE_SIZE}),
marked AS (
  SELECT x.stars, {pair_hash('x."user"', "x.item", 17)} % 100 < 20 AS valid,
         {pair_hash("x.item", 'x."user"')} % 5 AS fold, {STUMP_VALUES} AS f
  FROM x LEFT JOIN itf ON itf.item = x.item
)"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def _features() -> str:
    logs = ("b_review_cnt", *USER_COUNTS)
    plain = (
        "b_latitude", "b_longitude", "b_price", "b_credit_card", "b_reservation",
        "b_table_service", "b_wheelchair", "b_is_restaurant",
    )
    columns = [f"ROUND(LN(1 + COALESCE({c}, 0)::DOUBLE), 6) AS {c}" for c in logs]
    columns += [f"ROUND(COALESCE({c}, 0.0::DOUBLE), 6) AS {c}" for c in plain]
    columns += [
        f"ROUND(CASE WHEN {c} IS NULL OR ISNAN({c}) THEN 0.0::DOUBLE ELSE {c} END, 6) AS {c}"
        for c in ("b_avg_stars", "u_avg_stars")
    ]
    return f"""SELECT q."user", q.item, {", ".join(columns)}
FROM q LEFT JOIN itf ON itf.item = q.item LEFT JOIN uf ON uf."user" = q."user" """


def oracles() -> dict[str, str]:
    plain, cold = split("plain"), split("cold")
    score = rounded("score")
    mixed = (signatures(MIXED), SIMILAR)
    dense = (signatures(DENSE), SIMILAR)
    cf_rows = 'SELECT "user", item, CASE WHEN reason = \'new_user\' THEN 0 ELSE COALESCE(n_common, 0) END AS n_common, ROUND(cf, 6) AS prediction, reason FROM cf'
    neighbor_rows = "SELECT item, nbr, ROUND(sim, 6) AS sim, rank FROM nb"
    blended = f"""
scored AS (
  SELECT cf."user", cf.item, cf.neighbor_cnt, cf.mean, fb.score AS model,
    ({confidence("cf.neighbor_cnt")}) AS trust, ({alpha("cf.neighbor_cnt")}) AS alpha, cf.cf,
    0.5::DOUBLE * (COALESCE(cf.item_avg, cf.mean) + COALESCE(cf.user_avg, cf.mean)) AS means
  FROM cf JOIN fb ON fb."user" = cf."user" AND fb.item = cf.item
),
mixed AS (
  SELECT *, CASE WHEN neighbor_cnt >= 25
    THEN alpha * (trust * cf + (1 - trust) * means) + (1 - alpha) * model ELSE model END AS score
  FROM scored
)"""
    blocks = split("blocks")
    by_default = (signatures(DEFAULT), SIMILAR)
    final = """SELECT "user", item, neighbor_cnt,
  ROUND(GREATEST(1.0::DOUBLE, LEAST(5.0::DOUBLE, 0.98::DOUBLE * score + 0.02::DOUBLE * mean)), 6) AS prediction
FROM mixed"""
    counts = """ROUND(LN(1 + COALESCE(itf.b_review_cnt, 0)::DOUBLE), 6) AS b_review_cnt,
  ROUND(LN(1 + COALESCE(uf.u_review_cnt, 0)::DOUBLE), 6) AS u_review_cnt"""
    profiled = 'LEFT JOIN itf ON itf.item = x.item LEFT JOIN uf ON uf."user" = x."user"'
    twins = {
        "csv_round_trip": _with(plain, select="SELECT 'u' || \"user\" AS \"user\", 'i' || item AS item, stars FROM r"),
        "csv_requests": _with(
            plain,
            select="""SELECT CASE WHEN "user" % 7 = 0 THEN '' ELSE 'u' || "user" END AS "user",
  CASE WHEN item % 5 = 0 THEN '' ELSE 'i' || item END AS item FROM q""",
        ),
        "csv_predictions": _with(
            cold,
            BASELINE,
            select='SELECT "user"::VARCHAR AS "user", item::VARCHAR AS item, ROUND(prediction, 6) AS prediction FROM base',
        ),
        "csv_left_out": """
WITH lines AS (
  SELECT o_custkey AS "user", l_suppkey AS item, CAST(1 + FLOOR((l_quantity - 1) / 10) AS DOUBLE) AS stars
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)
SELECT COUNT(*) FILTER ("user" % 7 <> 0 AND item % 5 <> 0) AS n, SUM(stars) FILTER ("user" % 7 <> 0 AND item % 5 <> 0) AS sum_stars,
       COUNT(*) AS lines, COUNT(*) FILTER ("user" % 7 = 0 OR item % 5 = 0) AS left_out
FROM lines""",
        "dedupe_last": """
SELECT o_custkey::VARCHAR AS "user", l_suppkey::VARCHAR AS item,
       CAST(1 + FLOOR((LAST(l_quantity ORDER BY l_orderkey, l_linenumber, l_suppkey, FLOOR((l_quantity - 1) / 10)) - 1) / 10) AS DOUBLE) AS stars
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_suppkey""",
        "csv_order": _with(
            cold,
            select="""SELECT ROW_NUMBER() OVER (ORDER BY "user" * 1000000 + item) - 1 AS position,
  "user"::VARCHAR AS "user", item::VARCHAR AS item FROM q""",
        ),
        "training_labels": _with(
            plain,
            PROFILES,
            FEATURES,
            select=f'SELECT x."user", x.item, ROUND(x.stars - g.avg_stars, 6) AS label, {counts} FROM t x CROSS JOIN g {profiled}',
        ),
        "tuning_features": _with(
            plain,
            PROFILES,
            FEATURES,
            f'x AS (SELECT * FROM t ORDER BY {pair_hash()}, "user", item LIMIT {SAMPLE_SIZE})',
            select=f"""SELECT x."user", x.item, x.stars, CASE WHEN {pair_hash('x."user"', "x.item", 17)} % 100 < 20
  THEN 'valid' ELSE 'train' END AS part, ({pair_hash("x.item", 'x."user"')} % 5)::INT AS fold, {counts} FROM x {profiled}""",
        ),
        "cf_predict_busy": _with(
            plain, *mixed, CF, select=cf_rows + ' WHERE "user" IN (SELECT "user" FROM um WHERE n BETWEEN 30 AND 499)'
        ),
        "model_stump": _with(
            plain,
            PROFILES,
            FEATURES,
            f"fit AS (SELECT 0 AS set_id, t.stars, {STUMP_VALUES} AS f FROM t LEFT JOIN itf ON itf.item = t.item)",
            stump("fit"),
            f'asked AS (SELECT q."user", q.item, {STUMP_VALUES} AS f FROM q LEFT JOIN itf ON itf.item = q.item)',
            select="""SELECT "user", item, ROUND(CASE WHEN f[k] <= cut THEN low ELSE high END, 6) AS prediction
FROM asked CROSS JOIN best""",
        ),
        "cv_rmse_stump": _with(
            plain,
            PROFILES,
            FEATURES,
            STUMP_SAMPLE,
            """fit AS (SELECT set_id, stars, f FROM marked, (SELECT UNNEST(RANGE(0, 5)) AS set_id) WHERE NOT valid AND fold <> set_id)""",
            stump("fit"),
            """errors AS (
  SELECT fold, AVG((stars - CASE WHEN f[k] <= cut THEN low ELSE high END) ** 2) AS mse
  FROM marked JOIN best ON best.set_id = fold WHERE NOT valid GROUP BY fold
)""",
            select="SELECT 1::BIGINT AS n_estimators, 1::BIGINT AS max_depth, ROUND(SQRT(AVG(mse)), 6) AS cv_rmse FROM errors",
        ),
        "holdout_rmse_stump": _with(
            plain,
            PROFILES,
            FEATURES,
            STUMP_SAMPLE,
            "fit AS (SELECT 0 AS set_id, stars, f FROM marked WHERE NOT valid)",
            stump("fit"),
            select="""SELECT COUNT(*) AS n, ROUND(SQRT(AVG((stars - CASE WHEN f[k] <= cut THEN low ELSE high END) ** 2)), 6) AS rmse
FROM marked CROSS JOIN best WHERE valid""",
        ),
        "end_to_end_stump_blocks": _with(
            blocks,
            *by_default,
            CF,
            PROFILES,
            FEATURES,
            f"fit AS (SELECT 0 AS set_id, t.stars, {STUMP_VALUES} AS f FROM t LEFT JOIN itf ON itf.item = t.item)",
            stump("fit"),
            f"""fb AS (
  SELECT q."user", q.item, GREATEST(1.0::DOUBLE, LEAST(5.0::DOUBLE,
    0.97::DOUBLE * CASE WHEN ({STUMP_VALUES})[best.k] <= cut THEN low ELSE high END + 0.03::DOUBLE * g.avg_stars)) AS score
  FROM q CROSS JOIN g CROSS JOIN best LEFT JOIN itf ON itf.item = q.item
)""",
            blended,
            select=final.replace("neighbor_cnt, ", "").replace("neighbor_cnt,", ""),
        ),
        "end_to_end_answers": _with(plain, select='SELECT "user", item, TRUE AS in_range FROM q'),
        "lsh_candidates_blocks": _with(blocks, signatures(DEFAULT), select="SELECT i, j FROM cand"),
        "pair_similarity_blocks": _with(blocks, *by_default, select="SELECT i, j, n, ROUND(sim, 6) AS sim FROM sims"),
        "top_neighbors_blocks": _with(blocks, *by_default, select=neighbor_rows),
        "cf_predict_blocks": _with(blocks, *by_default, CF, select=cf_rows),
        "hybrid_predict_blocks": _with(blocks, *by_default, CF, PROFILES, FEATURES, FALLBACK, blended, select=final),
        "ratings_scan": _with(plain, select='SELECT "user", item, stars FROM r'),
        "requests_scan": _with(plain, select='SELECT "user", item FROM q'),
        "dedupe_pairs": _with(plain, select='SELECT "user", item, stars FROM r'),
        "item_mean": _with(plain, select="SELECT item, ROUND(avg_stars, 6) AS avg_stars, n FROM im"),
        "user_mean": _with(plain, select='SELECT "user", ROUND(avg_stars, 6) AS avg_stars, n FROM um'),
        "global_mean": _with(plain, select="SELECT ROUND(avg_stars, 6) AS avg_stars, n FROM g"),
        "active_users": _with(plain, select='SELECT "user", n FROM active'),
        "active_users_busy": _with(plain, select='SELECT "user", n FROM um WHERE n BETWEEN 30 AND 499'),
        "popular_items": _with(plain, select="SELECT item, n FROM popular"),
        "popular_items_in_demand": _with(plain, select="SELECT item, n FROM im WHERE n >= 425"),
        "popular_ratings": _with(
            plain, select='SELECT "user", item, stars FROM t WHERE item IN (SELECT item FROM popular)'
        ),
        "popular_ratings_in_demand": _with(
            plain, select='SELECT "user", item, stars FROM t WHERE item IN (SELECT item FROM im WHERE n >= 425)'
        ),
        "user_history": _with(
            plain,
            select='SELECT "user", COUNT(*) AS n, SUM(stars) AS sum_stars, MIN(item) AS min_item, MAX(item) AS max_item FROM t GROUP BY "user"',
        ),
        "item_raters": _with(
            plain, select='SELECT item, COUNT(DISTINCT "user") AS n_users FROM t GROUP BY item'
        ),
        "user_index": _with(
            plain,
            select="""SELECT "user", ROW_NUMBER() OVER (ORDER BY SUBSTR(MD5("user"::VARCHAR), 1, 3), "user") - 1 AS ix
FROM (SELECT DISTINCT "user" FROM t WHERE item IN (SELECT item FROM popular))""",
        ),
        "baseline_predict": _with(
            cold, BASELINE, select='SELECT "user", item, ROUND(prediction, 6) AS prediction, reason FROM base'
        ),
        "corated_pairs": _with(
            plain,
            select="""SELECT x.item AS i, y.item AS j, COUNT(*) AS n
FROM t x JOIN t y ON y."user" = x."user" AND x.item < y.item JOIN active a ON a."user" = x."user"
GROUP BY x.item, y.item""",
        ),
        "minhash_signature": _with(plain, signatures(DEFAULT), select="SELECT item, hash_ix::BIGINT AS hash_ix, h FROM sig"),
        "lsh_bands": _with(plain, signatures(DEFAULT), select="SELECT item, band::BIGINT AS band, sig_key FROM bands"),
        "minhash_signature_text_ids": _with(
            plain,
            signatures(DEFAULT, "('0x' || SUBSTR(MD5('u' || t.\"user\"::VARCHAR), 1, 15))::BIGINT"),
            select="SELECT item, hash_ix::BIGINT AS hash_ix, h FROM sig",
        ),
        "minhash_signature_wide_ids": _with(
            plain,
            signatures(DEFAULT, f't."user" * {HASH_PRIME}::BIGINT'),
            select="SELECT item, hash_ix::BIGINT AS hash_ix, h FROM sig",
        ),
        "lsh_candidates_casual": _with(
            plain.replace("BETWEEN 2 AND 499", f"BETWEEN 2 AND {CASUAL.max_user_ratings}"),
            signatures(CASUAL),
            select="SELECT i, j FROM cand",
        ),
        "cv_folds": _with(
            plain, select=f'SELECT "user", item, ({pair_hash('item', USER)} % 5)::INT AS fold FROM r'
        ),
        "lsh_candidates": _with(plain, signatures(DEFAULT), select="SELECT i, j FROM cand"),
        "lsh_candidates_mixed": _with(plain, signatures(MIXED), select="SELECT i, j FROM cand"),
        "lsh_candidates_dense": _with(plain, signatures(DENSE), select="SELECT i, j FROM cand"),
        "pair_moments": _with(
            plain, *mixed, select="SELECT i, j, n, sum_i, sum_j, sum_ii, sum_jj, sum_ij FROM moments"
        ),
        "pair_similarity": _with(plain, *mixed, select="SELECT i, j, n, ROUND(sim, 6) AS sim FROM sims"),
        "similarity_edges": _with(plain, *mixed, select="SELECT item, nbr, ROUND(sim, 6) AS sim FROM edges"),
        "top_neighbors": _with(plain, *dense, select=neighbor_rows),
        "top_neighbors_mixed": _with(plain, *mixed, select=neighbor_rows),
        "neighbor_count": _with(plain, *mixed, select="SELECT item, neighbor_cnt FROM nc"),
        "hybrid_weights": _with(
            plain,
            *mixed,
            select=f"""SELECT item, n AS neighbor_cnt, ROUND({confidence("n")}, 6) AS cf_weight, ROUND({alpha("n")}, 6) AS alpha
FROM (SELECT im.item, COALESCE(neighbor_cnt, 0) AS n FROM im LEFT JOIN nc ON nc.item = im.item)""",
        ),
        "common_neighbors": _with(plain, *mixed, CF, select='SELECT "user", item, n_common FROM hits'),
        "cf_predict": _with(cold, *mixed, CF, select=cf_rows),
        "cf_predict_dense": _with(cold, *dense, CF, select=cf_rows),
        "fn_list_count": """SELECT p_partkey AS id, CAST(CASE WHEN p_partkey % 4 = 3
  THEN LEN(STRING_SPLIT(REPLACE(p_name, ' ', ','), ',')) ELSE 0 END AS BIGINT) AS n FROM part""",
        "fn_safe_log1p": """SELECT c_custkey AS id, ROUND(CASE WHEN c_custkey % 11 = 0 OR c_acctbal < 0
  THEN 0.0::DOUBLE ELSE LN(1 + c_acctbal) END, 6) AS v FROM customer""",
        "fn_flag": """SELECT l_orderkey * 100 + l_linenumber AS id,
  (l_orderkey % 7 <> 0 AND l_returnflag IN ('R', 'A'))::INT AS v FROM lineitem""",
        "fn_price": """SELECT p_partkey AS id, CAST(CASE WHEN p_partkey % 4 = 3 THEN p_size ELSE 2 END AS INT) AS v
FROM part""",
        "fn_finite": """SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 3 THEN c_acctbal ELSE 0.0::DOUBLE END AS v
FROM customer""",
        "user_features": _with(
            plain, PROFILES, FEATURES, select=f"SELECT * REPLACE ({rounded('u_avg_stars')} AS u_avg_stars) FROM uf"
        ),
        "item_features": _with(
            plain, PROFILES, FEATURES, select=f"SELECT * REPLACE ({rounded('b_avg_stars')} AS b_avg_stars) FROM itf"
        ),
        "feature_vectors": _with(plain, PROFILES, FEATURES, select=_features()),
        "fallback_score": _with(
            plain, PROFILES, FEATURES, FALLBACK, select=f'SELECT "user", item, {score} AS score FROM fb'
        ),
        "model_postprocess": _with(
            plain,
            PROFILES,
            FEATURES,
            FALLBACK,
            select="""SELECT "user", item, ROUND(GREATEST(1.0::DOUBLE, LEAST(5.0::DOUBLE,
  0.97::DOUBLE * CASE WHEN ("user" + item) % 7 = 0 THEN score ELSE item_avg END + 0.03::DOUBLE * mean)), 6) AS prediction
FROM fb""",
        ),
        "hybrid_predict": _with(
            plain,
            *mixed,
            CF,
            PROFILES,
            FEATURES,
            FALLBACK,
            blended,
            select=final,
        ),
        "eval_rmse": _with(cold, BASELINE, select="SELECT COUNT(*) AS n, ROUND(SQRT(AVG(e * e)), 6) AS rmse FROM err"),
        "eval_error_bins": _with(
            cold,
            BASELINE,
            select="""SELECT b.bin::BIGINT AS bin, COUNT(err.e) AS n
FROM (VALUES (0), (1), (2), (3), (4)) b(bin) LEFT JOIN err ON LEAST(FLOOR(err.e), 4) = b.bin GROUP BY b.bin""",
        ),
        "tuning_sample": _with(
            plain, select=f'SELECT "user", item FROM r ORDER BY {pair_hash()}, "user", item LIMIT {SAMPLE_SIZE}'
        ),
        "holdout_split": _with(
            plain,
            select=f"SELECT \"user\", item, CASE WHEN {pair_hash(start=17)} % 100 < 20 THEN 'valid' ELSE 'train' END AS part FROM r",
        ),
    }
    return twins | {hot: twins[hot.removesuffix("_hot")] for hot in HOT_QUERIES}
