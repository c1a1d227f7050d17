"""The same results in plain SQL, for checking the catalogue against an independent engine."""

from __future__ import annotations

from tidemark import config
from tidemark.operators.metrics import COARSE_GRID, COST_GRID, DECILES
from tidemark.plans.catalog import FEATURE_SPLIT, LOG_ROWS_READ, NOW, ROLLOUT_DAYS, SPEND_AND_K
from tidemark.sources import views


def num(x: float) -> str:
    """A DOUBLE literal (plain decimals would be DECIMAL)."""
    return f"{x!r}e0" if "e" not in repr(x) else repr(x)


def numbers(xs: list[float]) -> str:
    return "[" + ", ".join(num(x) for x in xs) + "]"


T_LOW, T_HIGH = num(views.SERVING_T_LOW), num(views.SERVING_T_HIGH)
LO, MID, HI = config.TIERS


def tier_sql(score: str, lo: str, hi: str) -> str:
    return f"CASE WHEN {score} < {lo} THEN '{LO}' WHEN {score} < {hi} THEN '{MID}' ELSE '{HI}' END"


def near_sql(score: str, lo: str, hi: str) -> str:
    band = num(config.LOW_CONFIDENCE_BAND)
    return f"(abs({score} - {lo}) <= {band} OR abs({score} - {hi}) <= {band})"


def bucket_sql(key: str) -> str:
    digest = f"sha256({key})"
    acc = "CAST(0 AS BIGINT)"
    for word in range(8):
        part = f"CAST('0x' || substr({digest}, {8 * word + 1}, 8) AS BIGINT)"
        acc = f"(({acc} * 96 + {part}) % 100)"
    return f"CAST({acc} AS INTEGER)"


def hash_mod_sql(key: str, seed: int) -> str:
    return f"CAST('0x' || substr(sha256('{seed}:' || {key}), 1, 8) AS BIGINT) % 10000"


def score_sql(weight: float) -> str:
    return (
        "least(1.0e0, greatest(0.0e0, round(l_quantity / 50.0e0 * 0.5e0 + l_discount * 3.0e0 + "
        f"CASE WHEN l_returnflag = 'R' THEN {num(weight)} ELSE 0.0e0 END, 3)))"
    )


def scored_view(weight: float) -> str:
    return f"""SELECT printf('ord_%09d', l_orderkey) AS entity_id, {score_sql(weight)} AS score,
        CAST(l_returnflag = 'R' AS INTEGER) AS label, l_shipdate AS ts, l_quantity AS quantity FROM lineitem"""


def folds_sql(source: str) -> str:
    rank = lambda seed: f"sha256('{seed}:' || entity_id), entity_id"
    return f"""SELECT * EXCLUDE (held, n_held, place, n, place_held), CASE WHEN NOT held THEN 'train'
        WHEN place_held <= floor(n_held * 0.5e0 + 0.5e0) THEN 'test' ELSE 'calibration' END AS fold
    FROM (SELECT *, count(*) FILTER (WHERE held) OVER (PARTITION BY label) AS n_held,
        row_number() OVER (PARTITION BY label, held ORDER BY {rank(7)}) AS place_held
        FROM (SELECT *, place <= floor(n * 0.3e0 + 0.5e0) AS held
            FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {rank(42)}) AS place,
                count(*) OVER (PARTITION BY label) AS n FROM {source})))"""


def long_view(factor: float) -> str:
    live = f"ts >= TIMESTAMP '{views.DRIFT_SPLIT}'"
    scaled = f"CASE WHEN {live} THEN value * {num(factor)} ELSE value END"
    return f"""SELECT {live} AS is_live, 'value' AS feature, {scaled} AS value FROM events
        UNION ALL SELECT {live}, 'k', CAST(json_extract_string(props, '$.k') AS DOUBLE) FROM events"""


def ks_view(source: str) -> str:
    """KS report per feature of a (feature, value, is_live) source."""
    lam = "((root + 0.12e0 + 0.11e0 / root) * d)"
    p = f"""CASE WHEN {lam} < 0.2e0 THEN 1.0e0 ELSE least(1.0e0, greatest(0.0e0, 2.0e0 * list_sum(
        [CASE WHEN k % 2 = 1 THEN 1.0e0 ELSE -1.0e0 END * exp(-2.0e0 * CAST(k * k AS DOUBLE) * {lam} * {lam})
         for k in range(1, 101)]))) END"""
    return f"""SELECT feature, CASE WHEN enough THEN 'checked' ELSE 'insufficient_data' END AS status, n_live,
        CASE WHEN enough THEN round(d, 4) END AS ks_stat, CASE WHEN enough THEN round(p, 6) END AS p_value,
        CASE WHEN enough THEN p < {num(config.KS_P_LIMIT)} END AS drifted
    FROM (SELECT *, n_live >= {config.MIN_LOGGED_ROWS} AS enough, {p} AS p FROM (
        SELECT *, sqrt(CAST(n_baseline AS DOUBLE) * CAST(n_live AS DOUBLE) / (n_baseline + n_live)) AS root FROM (
        SELECT feature, max(abs(ca / na - cb / nb)) AS d, CAST(max(na) AS BIGINT) AS n_baseline,
            CAST(max(nb) AS BIGINT) AS n_live
        FROM (SELECT feature, CAST(sum(a) OVER w AS DOUBLE) AS ca, CAST(sum(b) OVER w AS DOUBLE) AS cb,
                CAST(sum(a) OVER f AS DOUBLE) AS na, CAST(sum(b) OVER f AS DOUBLE) AS nb
            FROM (SELECT feature, value, count(*) FILTER (WHERE NOT is_live) AS a,
                    count(*) FILTER (WHERE is_live) AS b FROM {source} GROUP BY feature, value)
            WINDOW w AS (PARTITION BY feature ORDER BY value), f AS (PARTITION BY feature))
        GROUP BY feature)))"""


def band_sql(psi: str) -> str:
    cases = " ".join(f"WHEN {psi} > {num(least)} THEN '{name}'" for least, name in config.PSI_BANDS)
    return f"CASE {cases} ELSE '{config.PSI_STABLE}' END"


def psi_view(source: str) -> str:
    """PSI per feature over the baseline's deciles."""
    return f"""SELECT feature, 'checked' AS status, n_live, round(psi, 4) AS psi, {band_sql('psi')} AS interpretation
    FROM (SELECT feature, CAST(max(n_live) AS BIGINT) AS n_live, sum((a - e) * ln(a / e)) AS psi FROM (
        SELECT g.feature, g.n_live, greatest(1e-6, coalesce(c.a, 0) / CAST(g.n_live AS DOUBLE)) AS a,
            greatest(1e-6, coalesce(c.e, 0) / CAST(g.n_base AS DOUBLE)) AS e
        FROM (SELECT feature, n_live, n_base, unnest(range(0, 10)) AS bin FROM (
                SELECT feature, count(*) FILTER (WHERE is_live) AS n_live,
                    count(*) FILTER (WHERE NOT is_live) AS n_base FROM {source} GROUP BY feature)) g
        LEFT JOIN (SELECT s.feature, len([e for e in q.edges if s.value >= e]) AS bin,
                count(*) FILTER (WHERE is_live) AS a, count(*) FILTER (WHERE NOT is_live) AS e
            FROM {source} s JOIN (SELECT feature, quantile_cont(value, {numbers(DECILES)}) AS edges
                FROM {source} WHERE NOT is_live GROUP BY feature) q ON s.feature = q.feature
            GROUP BY 1, 2) c ON g.feature = c.feature AND g.bin = c.bin)
    GROUP BY feature)"""


def ranked(source: str, by: str = "") -> str:
    """Running counts over distinct scores, highest first."""
    part = f"PARTITION BY {by}" if by else ""
    pre = f"{by}, " if by else ""
    return f"""SELECT {pre}score, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS cum_pos,
        CAST(sum(neg) OVER w AS BIGINT) AS cum_neg, CAST(sum(pos) OVER f AS BIGINT) AS all_pos,
        CAST(sum(neg) OVER f AS BIGINT) AS all_neg
    FROM (SELECT {pre}score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
        FROM {source} GROUP BY {pre}score)
    WINDOW w AS ({part} ORDER BY score DESC), f AS ({part})"""


def ranking_sql(source: str, by: str = "") -> str:
    pre = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {pre}CAST(sum(pos + neg) AS BIGINT) AS n_rows, max(all_pos) AS n_pos,
        sum(pos / CAST(all_pos AS DOUBLE) * (cum_pos / CAST(cum_pos + cum_neg AS DOUBLE))) AS average_precision,
        sum(pos * (all_neg - cum_neg + neg / 2.0e0) / (CAST(all_pos AS DOUBLE) * all_neg)) AS roc_auc
    FROM ({ranked(source, by)}) {group}"""


def cost_rows(source: str, grid: list[float]) -> str:
    """Errors of each grid threshold, straight from the definition."""
    return f"""SELECT i, t, CAST(sum(CASE WHEN score < t AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
        CAST(sum(CASE WHEN score >= t AND label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp
    FROM {source}, (SELECT unnest({numbers(grid)}) AS t, unnest(range(0, {len(grid)})) AS i) GROUP BY i, t"""


def best_cost(rows: str, fn: int, fp: int) -> str:
    return f"""SELECT t AS threshold, CAST(fn * {fn} + fp * {fp} AS DOUBLE) AS cost FROM {rows}
        ORDER BY cost, i LIMIT 1"""


def cascade_sql(rows: str) -> str:
    low, high = best_cost(rows, *config.COST_LOW), best_cost(rows, *config.COST_HIGH)
    return f"""SELECT least(l.threshold, h.threshold) AS t_low, greatest(l.threshold, h.threshold) AS t_high,
        l.cost AS cost_low, h.cost AS cost_high FROM ({low}) l, ({high}) h"""


def prf_sql(source: str, pre: str = "", group: str = "") -> str:
    ratio = lambda top, bottom: f"CASE WHEN {bottom} = 0 THEN 0.0e0 ELSE {top} / CAST({bottom} AS DOUBLE) END"
    return f"""SELECT {pre} n_rows, {ratio('tp', '(tp + fp)')} AS precision, {ratio('tp', '(tp + fn)')} AS recall,
        {ratio('2 * tp', '(2 * tp + fp + fn)')} AS f1
    FROM (SELECT {pre} count(*) AS n_rows, count(*) FILTER (WHERE pred = 1 AND label = 1) AS tp,
        count(*) FILTER (WHERE pred = 1 AND label <> 1) AS fp,
        count(*) FILTER (WHERE pred <> 1 AND label = 1) AS fn FROM {source} {group})"""


def committee_sql(train: str, features: list[str] = config.FEATURES) -> str:
    """One row: of every feature the median (c), the shares of positives at or below it (l) and above it (h), and
    what the cut takes off the variance (g)."""
    cuts = ", ".join(f"quantile_cont({f}, 0.5e0) AS c{i}" for i, f in enumerate(features))
    side = lambda f, i, no: f"avg(label) FILTER (WHERE {no} {f} <= c{i})"
    parts = ", ".join(
        f"c{i}, coalesce({side(f, i, '')}, avg(label)) AS l{i}, coalesce({side(f, i, 'NOT')}, avg(label)) AS h{i}, "
        f"count(*) FILTER (WHERE {f} <= c{i}) AS n{i}"
        for i, f in enumerate(features)
    )
    gains = ", ".join(f"(n{i} * (l{i} - p) ** 2 + (n - n{i}) * (h{i} - p) ** 2) / n AS g{i}" for i in range(len(features)))
    group = ", ".join(f"c{i}" for i in range(len(features)))
    return f"""SELECT *, {gains} FROM (SELECT {parts}, avg(label) AS p, CAST(count(*) AS DOUBLE) AS n
        FROM (SELECT * FROM {train}), (SELECT {cuts} FROM {train}) GROUP BY {group})"""


def committee_score(alias: str, features: list[str] = config.FEATURES) -> str:
    weight = num(1.0 / len(features))
    return " + ".join(
        f"{weight} * CASE WHEN {f} <= {alias}.c{i} THEN {alias}.l{i} ELSE {alias}.h{i} END" for i, f in enumerate(features)
    )


VIEWS: dict[str, str] = {
    "raw_landing": """SELECT event_id, CASE WHEN event_type = 'error' AND value < 5 THEN NULL
        ELSE printf('cust_%06d', user_id) END AS entity_id, ts AS event_timestamp, value AS monthly_spend FROM events""",
    "feature_history": """SELECT printf('cust_%06d', user_id) AS entity_id,
        CASE WHEN event_type = 'signup' THEN ts - INTERVAL 1 DAY ELSE ts END AS ts, event_id AS write_seq,
        value AS spend, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
        FROM events WHERE event_type <> 'purchase'""",
    "label_events": """SELECT event_id AS label_id, printf('cust_%06d', user_id) AS entity_id,
        ts AS label_timestamp, CAST(value >= 50 AS INTEGER) AS label FROM events WHERE event_type = 'purchase'""",
    "features_clean": """SELECT *, CAST(support_tickets_30d >= 4 OR satisfaction_score < 1.4e0 AS INTEGER) AS label
        FROM (SELECT printf('ord_%09d', o_orderkey) AS entity_id, o_orderdate AS event_timestamp,
            CAST(coalesce(returned, 0) AS DOUBLE) AS support_tickets_30d,
            coalesce(CAST(cents AS DOUBLE) / n / 1000.0e0, 0.0e0) AS avg_message_length,
            coalesce(1.0e0 + 4.0e0 * (1.0e0 - (CAST(discount_pct AS DOUBLE) / n) / 10.0e0), 3.0e0) AS satisfaction_score,
            CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') AS DOUBLE) AS days_since_last_login,
            CAST(o_custkey % 2000 AS DOUBLE) AS tenure_days, o_totalprice * 2.1e0 AS monthly_spend,
            coalesce(n, 0) AS n_lines
        FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
            sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS cents,
            sum(CAST(round(l_discount * 100) AS BIGINT)) AS discount_pct
            FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey)""",
    "labels_delayed": f"""SELECT entity_id, event_timestamp, label,
        event_timestamp + INTERVAL {config.LABEL_DELAY_DAYS} DAY AS label_observed_timestamp
        FROM features_clean WHERE n_lines > 0""",
    "flagged": """SELECT *, CAST(coalesce(satisfaction_score < 2.5e0 OR support_tickets_30d > 3, false) AS INTEGER)
        AS pred FROM features_clean""",
    "scored": scored_view(0.15),
    "scored_b": scored_view(0.05),
    "costs": cost_rows("scored", COST_GRID),
    "costs_b": cost_rows("scored_b", COST_GRID),
    "costs_coarse": cost_rows("scored", COARSE_GRID),
    "cascade": cascade_sql("costs"),
    "cascade_b": cascade_sql("costs_b"),
    "tiered": f"""SELECT label, {tier_sql('score', 't_low', 't_high')} AS tier FROM scored, cascade""",
    "inference_log": f"""SELECT *, {tier_sql('calibrated_score', T_LOW, T_HIGH)} AS tier,
        {near_sql('calibrated_score', T_LOW, T_HIGH)} AS low_confidence,
        CASE WHEN {bucket_sql('entity_id')} < {views.CANARY_PCT} THEN 'challenger' ELSE 'champion' END AS served_by
        FROM (SELECT event_id AS request_id, printf('cust_%06d', user_id) AS entity_id, ts AS request_ts,
            least(1.0e0, value / 200.0e0) AS calibrated_score,
            CAST(event_type = 'error' AND value > 250 AS INTEGER) AS is_error, value AS spend,
            CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)""",
    "log_rows": f"""SELECT request_id, entity_id, request_ts, calibrated_score, tier, served_by, low_confidence, spend, k,
        '{views.SERVING_VERSION}' || served_by AS model_version FROM inference_log""",
    "features_long": " UNION ALL ".join(
        f"""SELECT event_timestamp >= TIMESTAMP '{FEATURE_SPLIT}' AS is_live, '{c}' AS feature,
        CAST({c} AS DOUBLE) AS value FROM features_clean WHERE {c} IS NOT NULL"""
        for c in config.FEATURES
    ),
    "model_versions": """SELECT printf('cust_%06d', user_id) AS model, event_id AS seq,
        strftime(ts, 'v%Y%m%dT%H%M%S%f') AS version, ts AS created_at FROM events WHERE event_type = 'signup'""",
    "model_cards": """SELECT printf('cust_%06d', user_id) AS model, strftime(ts, 'v%Y%m%dT%H%M%S%f') AS version,
        least(1.0e0, value / 500.0e0) AS t_low, least(1.0e0, value / 250.0e0) AS t_high,
        CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0e0 AS pr_auc
        FROM events WHERE event_type = 'signup' AND value >= 5""",
    "pointer_log": """SELECT m.model, m.seq, m.stage, m.pointed_at, v.version
        FROM (SELECT printf('cust_%06d', user_id) AS model, event_id AS seq,
            CASE WHEN event_type = 'purchase' THEN 'production' ELSE 'staging' END AS stage, ts AS pointed_at
            FROM events WHERE event_type IN ('purchase', 'click')) m
        ASOF JOIN model_versions v ON m.model = v.model AND m.pointed_at >= v.created_at""",
    "pointed": """SELECT model, stage, version FROM pointer_log QUALIFY row_number() OVER
        (PARTITION BY model, stage ORDER BY pointed_at DESC, seq DESC) = 1""",
    "pit": """SELECT l.label_id, l.entity_id, l.label_timestamp, l.label, h.ts AS feature_ts, h.spend, h.k
        FROM label_events l ASOF LEFT JOIN feature_history h
        ON l.entity_id = h.entity_id AND l.label_timestamp >= h.ts""",
    "by_time": """SELECT * FROM feature_history QUALIFY row_number() OVER
        (PARTITION BY entity_id ORDER BY ts DESC, write_seq DESC) = 1""",
    "by_write": """SELECT * FROM feature_history QUALIFY row_number() OVER
        (PARTITION BY entity_id ORDER BY write_seq DESC) = 1""",
    "mismatches": f"""SELECT o.entity_id, x.feature, x.online_value, x.offline_value FROM by_write o
        JOIN (SELECT * FROM feature_history WHERE ts <= TIMESTAMP '{NOW}' QUALIFY row_number() OVER
            (PARTITION BY entity_id ORDER BY ts DESC, write_seq DESC) = 1) f ON o.entity_id = f.entity_id,
        LATERAL (SELECT 'spend' AS feature, o.spend AS online_value, f.spend AS offline_value
            UNION ALL SELECT 'k', o.k, f.k) x
        WHERE abs(x.online_value - x.offline_value) > {num(config.RECONCILE_TOLERANCE)}""",
    "checks": f"""SELECT c.check_name, c.passed, c.observed, round(c.share, 4) AS share, c.action, rate_ok AS batch_passed
        FROM (SELECT *, rate <= {num(config.MAX_QUARANTINE_RATE)} AS rate_ok,
                dropped < {num(config.VOLUME_DROP_LIMIT)} AS volume_ok
            FROM (SELECT *, CASE WHEN n = 0 THEN 0.0e0 ELSE nulls / CAST(n AS DOUBLE) END AS rate,
                1.0e0 - CAST(n AS DOUBLE) / {num(float(config.VOLUME_BASELINE_ROWS))} AS dropped
                FROM (SELECT count(*) AS n, count(*) FILTER (WHERE entity_id IS NULL) AS nulls FROM raw_landing))) s,
        LATERAL (SELECT 'not_null_entity_id' AS check_name, rate_ok AS passed, nulls AS observed, rate AS share,
                CASE WHEN nulls = 0 THEN 'PASS'
                    WHEN rate_ok THEN nulls || ' rows ROUTED TO DEAD LETTER QUEUE, batch proceeds'
                    ELSE 'BATCH BLOCKED -- quarantine rate exceeds tolerance' END AS action
            UNION ALL SELECT 'row_count_volume_check', volume_ok, n, dropped,
                CASE WHEN volume_ok THEN 'PASS' ELSE 'ALERT: volume drop beyond threshold' END) c""",
    "orphans": """SELECT entity_id FROM features_clean EXCEPT SELECT entity_id FROM labels_delayed""",
    "tests": """SELECT 'unique_and_not_null(entity_id)' AS test,
            count(*) FILTER (WHERE entity_id IS NULL) = 0 AND count(*) = count(DISTINCT entity_id) AS passed,
            CAST(count(*) FILTER (WHERE entity_id IS NULL) AS BIGINT) AS nulls,
            CAST(count(*) - count(DISTINCT entity_id) AS BIGINT) AS duplicates, CAST(NULL AS BIGINT) AS orphaned_count
        FROM features_clean
        UNION ALL SELECT 'relationships(entity_id, features -> labels)', count(*) = 0, NULL, NULL, count(*) FROM orphans""",
    "folds": folds_sql("features_clean"),
    "keyed_folds": folds_sql("(SELECT * FROM features_clean WHERE n_lines > 0)"),
    "keyed_holdout": "SELECT * FROM keyed_folds WHERE fold <> 'train'",
    "stumps": committee_sql("keyed_folds WHERE fold = 'train'"),
    "stumps_young": committee_sql("keyed_folds WHERE fold = 'train' AND tenure_days < 1000"),
    "voted": f"SELECT k.*, {committee_score('s')} AS score FROM keyed_folds k, stumps s",
    "stump_costs": cost_rows("(SELECT * FROM voted WHERE fold = 'calibration')", COST_GRID),
    "stump_cuts": cascade_sql("stump_costs"),
    "holdout": "SELECT * FROM folds WHERE fold <> 'train'",
    "held_flagged": "SELECT pred, flagged.label FROM flagged JOIN (SELECT entity_id FROM keyed_holdout) USING (entity_id)",
    "drift_long": long_view(1.0),
    "shifted_long": long_view(1.35),
    "predictions": "SELECT entity_id, score AS calibrated_score FROM scored",
    "two_models": """SELECT version, score, label, unnest(CASE WHEN quantity >= (SELECT quantile_cont(quantity, 0.75e0)
            FROM scored) THEN ['held_out', 'high_quantity_slice'] ELSE ['held_out'] END) AS slice
        FROM (SELECT 'champion' AS version, * FROM scored UNION ALL SELECT 'challenger', * FROM scored_b)""",
    "slice_metrics": ranking_sql("two_models", "version, slice"),
    "contest": f"""SELECT slice, champion_ap, champion_auc, challenger_ap, challenger_auc,
            champion_ap - challenger_ap AS regression,
            champion_ap - challenger_ap <= {num(config.MAX_AP_REGRESSION)} AS passed
        FROM (SELECT slice, max(average_precision) FILTER (WHERE version = 'champion') AS champion_ap,
            max(roc_auc) FILTER (WHERE version = 'champion') AS champion_auc,
            max(average_precision) FILTER (WHERE version = 'challenger') AS challenger_ap,
            max(roc_auc) FILTER (WHERE version = 'challenger') AS challenger_auc FROM slice_metrics GROUP BY slice)""",
    "contested": f"""SELECT label, version, slice, score FROM (SELECT label, unnest([{{'version': 'v1', 'score': {committee_score('y')}}},
            {{'version': 'v2', 'score': {committee_score('s')}}}], recursive := true),
        CASE WHEN support_tickets_30d >= (SELECT quantile_cont(support_tickets_30d, 0.75e0) FROM keyed_holdout)
            THEN ['held_out', 'high_ticket_volume_slice'] ELSE ['held_out'] END AS slices
        FROM keyed_holdout, stumps s, stumps_young y), LATERAL (SELECT unnest(slices) AS slice)""",
    "registered_metrics": ranking_sql("contested", "version, slice"),
    "registered_contest": f"""SELECT slice, champion_ap, champion_auc, challenger_ap, challenger_auc,
            champion_ap - challenger_ap AS regression, champion_ap - challenger_ap <= {num(config.MAX_AP_REGRESSION)} AS passed
        FROM (SELECT slice, max(average_precision) FILTER (WHERE version = 'v1') AS champion_ap,
            max(roc_auc) FILTER (WHERE version = 'v1') AS champion_auc,
            max(average_precision) FILTER (WHERE version = 'v2') AS challenger_ap,
            max(roc_auc) FILTER (WHERE version = 'v2') AS challenger_auc FROM registered_metrics GROUP BY slice)""",
    "roc_points": f"""SELECT score AS threshold, cum_neg / CAST(all_neg AS DOUBLE) AS fpr,
            cum_pos / CAST(all_pos AS DOUBLE) AS tpr FROM ({ranked('scored')})
        UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0e0, 0.0e0""",
}


def needed(body: str) -> list[str]:
    """Views the body reads, in the order they were defined."""
    import re

    found: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in VIEWS:
            if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b|,\s*{name}\b", text):
                found.add(name)
                todo.append(VIEWS[name])
    return [name for name in VIEWS if name in found]


def sql(body: str) -> str:
    names = needed(body)
    if not names:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names) + "\n" + body


def backfill_sql(cutoff: str) -> str:
    return f"""SELECT '{cutoff}' AS as_of, CASE WHEN n_rows > 0 THEN 'checked' ELSE 'no_matching_labels' END AS status,
        n_rows AS n_matched, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
    FROM ({prf_sql(f'''(SELECT CAST(calibrated_score >= 0.5e0 AS INTEGER) AS pred, label FROM predictions
        JOIN (SELECT entity_id, label FROM labels_delayed
            WHERE label_observed_timestamp <= TIMESTAMP '{cutoff}') USING (entity_id))''')})"""


BACKFILL_ALL = prf_sql(
    "(SELECT CAST(calibrated_score >= 0.5e0 AS INTEGER) AS pred, label FROM predictions "
    "JOIN (SELECT entity_id, label FROM labels_delayed) USING (entity_id))"
)

PERIOD = f"event_timestamp >= TIMESTAMP '{views.CONCEPT_SPLIT}'"
CONCEPT_LONG = f"""(SELECT {PERIOD} AS is_live, 'support_tickets_30d' AS feature, support_tickets_30d AS value
    FROM features_clean)"""
CONCEPT_PREDS = f"""(SELECT {PERIOD} AS is_live, pred,
    CASE WHEN {PERIOD} AND satisfaction_score > 4 THEN 1 - label ELSE label END AS label FROM flagged)"""


CONCEPT_FEATURES = "(" + " UNION ALL ".join(
    f"SELECT {PERIOD} AS is_live, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM features_clean" for c in config.FEATURES
) + ")"
CONCEPT_FITTED = f"""(SELECT {PERIOD} AS is_live, CAST({committee_score('s')} >= s.p AS INTEGER) AS pred,
    CASE WHEN {PERIOD} AND satisfaction_score > 4 THEN 1 - label ELSE label END AS label
    FROM features_clean, ({committee_sql(f"features_clean WHERE NOT ({PERIOD})")}) s)"""


def promotion_sql(version: str, passed: str, dry: bool) -> str:
    yes = "[ALERT] " + config.MESSAGE_PROMOTED % version
    no = "[CRITICAL ALERT] " + config.MESSAGE_NOT_PROMOTED % version
    stage = "NULL" if dry else "'production'"
    line = "NULL" if dry else f"'{yes}'"
    return f"""SELECT '{version}' AS version, passed, {str(dry).lower()} AS dry_run,
        CASE WHEN NOT passed THEN 'staging' ELSE {stage} END AS stage,
        CASE WHEN NOT passed THEN '{no}' ELSE {line} END AS alert FROM (SELECT bool_and({passed}) AS passed FROM contest)"""


def chain_sql(name: str, steps: list[tuple[str, str]]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS chain, {i} AS position, '{step}' AS step, ({passed}) AS passed"
        for i, (step, passed) in enumerate(steps)
    )
    return f"""SELECT chain, position, step, CASE WHEN coalesce(bool_or(NOT passed) OVER (PARTITION BY chain
        ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) THEN 'blocked'
        WHEN passed THEN 'passed' ELSE 'failed' END AS status FROM ({rows})"""


def gate_two_sql(source: str) -> str:
    return f"""SELECT count(*) = count(DISTINCT entity_id) AND (SELECT count(*) = 0 FROM
        (SELECT entity_id FROM {source} EXCEPT SELECT entity_id FROM labels_delayed)) FROM {source}"""


TRAINABLE = """SELECT count(*) FILTER (WHERE label = 1) > 0 AND count(*) FILTER (WHERE label = 0) > 0
    FROM folds WHERE fold = 'train'"""
PROMOTED = "SELECT bool_and(passed) FROM contest"
KEYED = "(SELECT entity_id FROM features_clean WHERE n_lines > 0)"

ALERTS = f"""SELECT 'ingestion_gate' AS source, 'warning' AS severity, '[ALERT] Ingestion volume down ' ||
        printf('%.1f', share * 100) || '% vs 7-day rolling average.' AS line
    FROM checks WHERE check_name = 'row_count_volume_check' AND NOT passed
    UNION ALL SELECT 'transformation_gate', 'warning',
        '[ALERT] Transformation gate FAILED -- downstream training DAG blocked.'
    FROM (SELECT bool_and(passed) AS passed FROM tests) WHERE NOT passed
    UNION ALL SELECT 'data_drift', 'critical', '[CRITICAL ALERT] Data drift detected on features: [' || names ||
        ']. Consider moving the next retrain up sooner.'
    FROM (SELECT string_agg('''' || feature || '''', ', ' ORDER BY feature) AS names FROM ({ks_view('shifted_long')}) WHERE drifted)
    WHERE names IS NOT NULL
    UNION ALL SELECT 'score_psi', 'warning', '[ALERT] Score PSI = ' || printf('%.4f', psi) || ' (' || interpretation || ')'
    FROM ({psi_view('shifted_long')}) WHERE feature = 'value' AND psi > {num(config.PSI_MODERATE)}
    UNION ALL SELECT 'label_backfill', 'critical', '[CRITICAL ALERT] Backfilled F1 = ' || printf('%.4f', f1) || ' on ' ||
        n_rows || ' matched predictions -- this is a concept-drift signal, not just a data-drift one. '
        || 'Consider retraining soon.'
    FROM ({BACKFILL_ALL}) WHERE n_rows > 0 AND f1 < {num(config.F1_ALERT)}
    UNION ALL SELECT 'promotion', CASE WHEN passed THEN 'warning' ELSE 'critical' END, alert
    FROM ({promotion_sql('challenger', 'passed', False)})"""

FC = ", ".join(config.FEATURES)


def broken(rule: str, ok: str) -> str:
    return f"CASE WHEN NOT coalesce({ok}, false) THEN '{rule}' END"


VIOLATIONS = ", ".join(
    [broken("entity_id", f"length(entity_id) BETWEEN {config.ENTITY_ID_LENGTH[0]} AND {config.ENTITY_ID_LENGTH[1]}")]
    + [broken(c, f"{c} BETWEEN {num(lo)} AND {num(hi)}") for c, (lo, hi) in config.FEATURE_BOUNDS.items()]
)

HISTORY = "entity_id, ts, write_seq, spend, k"

BODIES: dict[str, str] = {
    "scan_raw_landing": "SELECT * FROM raw_landing",
    "scan_features_labels": "SELECT entity_id, label FROM features_clean",
    "sink_clean_batch": "SELECT * FROM raw_landing WHERE entity_id IS NOT NULL",
    "sink_dlq": """SELECT *, 'null entity_id' AS reason, 'batch_1' AS batch_id FROM raw_landing
        WHERE entity_id IS NULL""",
    "sink_offline_append": f"""SELECT {HISTORY} FROM feature_history QUALIFY row_number() OVER
        (PARTITION BY entity_id, ts ORDER BY write_seq DESC) = 1""",
    "sink_online_upsert": f"SELECT {HISTORY} FROM by_write",
    "sink_online_merge": f"SELECT {HISTORY}, CAST(0 AS INTEGER) AS files_more FROM by_write",
    "scan_log_by_day": f"""SELECT * FROM log_rows ORDER BY request_ts DESC, request_id DESC LIMIT {LOG_ROWS_READ}""",
    "log_retention_by_day": f"""SELECT * FROM log_rows WHERE CAST(request_ts AS DATE) >=
        (SELECT max(CAST(request_ts AS DATE)) - {config.RETENTION_DAYS} FROM log_rows)""",
    "sink_inference_log": "SELECT * FROM log_rows",
    "scan_inference_log": f"""SELECT * FROM log_rows ORDER BY request_ts DESC, request_id DESC
        LIMIT {LOG_ROWS_READ}""",
    "scan_model_cards": """SELECT v.model, v.version, v.seq, v.created_at, c.t_low, c.t_high, c.pr_auc,
            coalesce(p.stage, s.stage, 'none') AS stage
        FROM model_versions v JOIN model_cards c ON v.model = c.model AND v.version = c.version
        LEFT JOIN (SELECT * FROM pointed WHERE stage = 'production') p ON v.model = p.model AND v.version = p.version
        LEFT JOIN (SELECT * FROM pointed WHERE stage = 'staging') s ON v.model = s.model AND v.version = s.version""",
    "alerts_table": ALERTS,
    "log_retention": f"""SELECT * FROM log_rows WHERE CAST(request_ts AS DATE) >=
        (SELECT max(CAST(request_ts AS DATE)) - {config.RETENTION_DAYS} FROM log_rows)""",
    "holdout_table": f"SELECT entity_id, {FC}, label FROM holdout",
    "quarantine_split": """SELECT event_id, entity_id, CASE WHEN entity_id IS NULL THEN 'quarantine'
        ELSE 'clean' END AS route FROM raw_landing""",
    "request_validation": f"""SELECT entity_id, violations, violations = '' AS valid FROM (
        SELECT entity_id, concat_ws(',', {VIOLATIONS}) AS violations FROM features_clean)""",
    "feature_projection": f"SELECT entity_id, {FC} FROM features_clean",
    "heuristic_rule": f"""SELECT n_rows, n_pos, round(average_precision, 6) AS average_precision,
        round(roc_auc, 6) AS roc_auc
        FROM ({ranking_sql('(SELECT CAST(pred AS DOUBLE) AS score, label FROM flagged)')})""",
    "tier_routing": "SELECT request_id, calibrated_score, tier FROM inference_log",
    "low_confidence_flag": "SELECT request_id, calibrated_score, low_confidence FROM inference_log",
    "label_availability": "SELECT entity_id, event_timestamp, label_observed_timestamp FROM labels_delayed",
    "predict_at_cutoff": """SELECT request_id, CAST(calibrated_score >= 0.5e0 AS INTEGER) AS pred FROM inference_log""",
    "log_to_predictions": """SELECT entity_id, calibrated_score, tier FROM inference_log
        WHERE entity_id IS NOT NULL""",
    "psi_band": f"SELECT feature, psi, interpretation FROM ({psi_view('drift_long')})",
    "json_pack_unpack": """SELECT event_id, '{"spend":' || CAST(value AS VARCHAR) || ',"k":' || k || '}' AS features_json,
        value AS spend, k FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "drop_incomplete": """SELECT * FROM pit WHERE feature_ts IS NOT NULL AND spend IS NOT NULL AND k IS NOT NULL
        AND label IS NOT NULL""",
    "sticky_bucket": f"""SELECT request_id, bucket, CASE WHEN bucket < {views.CANARY_PCT} THEN 'challenger'
        ELSE 'champion' END AS served_by FROM (SELECT event_id AS request_id,
        {bucket_sql("printf('cust_%06d', user_id)")} AS bucket FROM events)""",
    "version_id": "SELECT event_id, strftime(ts, 'v%Y%m%dT%H%M%S%f') AS version FROM events",
    "status_action_text": """SELECT check_name, '[' || CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END || '] ' ||
        check_name || ': ' || action AS line FROM checks""",
    "relabel_where": """SELECT entity_id, CASE WHEN satisfaction_score > 4 THEN 1 - label ELSE label END AS label
        FROM features_clean""",
    "scale_scenario": f"""SELECT k.feature, k.ks_stat, k.drifted, p.psi, p.interpretation
        FROM ({ks_view('shifted_long')}) k JOIN ({psi_view('shifted_long')}) p ON k.feature = p.feature""",
    "pit_join": "SELECT * FROM pit",
    "pit_training_set": "SELECT * FROM pit WHERE feature_ts IS NOT NULL",
    "pit_join_prepared": "SELECT * FROM pit",
    "pit_training_set_prepared": "SELECT * FROM pit WHERE feature_ts IS NOT NULL",
    "leakage_report": f"""SELECT n_labels, n_differ, n_future,
        (SELECT round(greatest(roc_auc, 1 - roc_auc), 6) FROM ({ranking_sql('''(SELECT c.spend AS score, l.label
            FROM label_events l JOIN by_time c ON l.entity_id = c.entity_id)''')})) AS auc_leaky,
        (SELECT round(greatest(roc_auc, 1 - roc_auc), 6) FROM ({ranking_sql('''(SELECT spend AS score, label
            FROM pit WHERE spend IS NOT NULL)''')})) AS auc_pit
        FROM (SELECT count(*) AS n_labels,
            count(*) FILTER (WHERE c.spend IS NOT NULL AND p.spend IS DISTINCT FROM c.spend) AS n_differ,
            count(*) FILTER (WHERE c.ts > p.label_timestamp) AS n_future
            FROM pit p LEFT JOIN by_time c ON p.entity_id = c.entity_id)""",
    "label_backfill": backfill_sql("1998-04-15") + " UNION ALL " + backfill_sql("2002-01-01"),
    "referential_integrity": """SELECT 'relationships(entity_id, features -> labels)' AS test, count(*) = 0 AS passed,
        count(*) AS orphaned_count, coalesce((SELECT string_agg(entity_id, ',' ORDER BY entity_id) FROM
        (SELECT entity_id FROM orphans ORDER BY entity_id LIMIT 5)), '') AS orphaned_sample FROM orphans""",
    "reconcile": "SELECT * FROM mismatches",
    "serving_state": f"""SELECT s.model, CASE WHEN champion_version IS NULL THEN 'no_production_model' ELSE 'ok' END
            AS status, champion_version, a.t_low AS champion_t_low, a.t_high AS champion_t_high, challenger_version,
            b.t_low AS challenger_t_low, b.t_high AS challenger_t_high, {views.CANARY_PCT} AS canary_pct
        FROM (SELECT model, champion_version, CASE WHEN champion_version IS NOT NULL THEN staged END AS challenger_version
            FROM (SELECT model, max(version) FILTER (WHERE stage = 'production') AS champion_version,
                max(version) FILTER (WHERE stage = 'staging') AS staged
                FROM (SELECT * FROM pointer_log QUALIFY row_number() OVER
                    (PARTITION BY model, stage ORDER BY pointed_at DESC, seq DESC) = 1) GROUP BY model)) s
        LEFT JOIN model_cards a ON s.model = a.model AND s.champion_version = a.version
        LEFT JOIN model_cards b ON s.model = b.model AND s.challenger_version = b.version""",
    "champion_challenger": """SELECT slice, round(champion_ap, 6) AS champion_ap, round(champion_auc, 6) AS champion_auc,
        round(challenger_ap, 6) AS challenger_ap, round(challenger_auc, 6) AS challenger_auc,
        round(regression, 5) AS regression, passed FROM contest""",
    "route_requests": f"""SELECT request_id, entity_id, served_by, calibrated_score,
            {tier_sql('calibrated_score', 't_low', 't_high')} AS tier,
            {near_sql('calibrated_score', 't_low', 't_high')} AS low_confidence
        FROM (SELECT request_id, entity_id, served_by,
            CASE WHEN served_by = 'challenger' THEN least(1.0e0, value / 250.0e0)
                ELSE least(1.0e0, value / 200.0e0) END AS calibrated_score,
            CASE WHEN served_by = 'challenger' THEN b.t_low ELSE a.t_low END AS t_low,
            CASE WHEN served_by = 'challenger' THEN b.t_high ELSE a.t_high END AS t_high
            FROM (SELECT e.value, l.* FROM events e JOIN inference_log l ON e.event_id = l.request_id),
                cascade a, cascade_b b)""",
    "hash_equi_merge": """SELECT entity_id, calibrated_score, label FROM predictions
        JOIN (SELECT entity_id, label FROM labels_delayed) USING (entity_id)""",
    "ingestion_gate": "SELECT * FROM checks",
    "volume_check": """SELECT observed AS row_count, share AS drop_pct, passed FROM checks
        WHERE check_name = 'row_count_volume_check'""",
    "rolling_volume_check": f"""SELECT day, n_rows, round(baseline, 6) AS baseline,
            round(1.0e0 - n_rows / baseline, 6) AS drop_share,
            1.0e0 - n_rows / baseline < {num(config.VOLUME_DROP_LIMIT)} AS passed
        FROM (SELECT day, n_rows, avg(n_rows) OVER (ORDER BY day RANGE BETWEEN
            INTERVAL {config.ROLLING_VOLUME_DAYS} DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS baseline
            FROM (SELECT CAST(event_timestamp AS DATE) AS day, count(*) AS n_rows FROM raw_landing GROUP BY 1))""",
    "unique_not_null": """SELECT 'unique_and_not_null(entity_id)' AS test, nulls = 0 AND duplicates = 0 AS passed,
            nulls, duplicates, source
        FROM (SELECT source, coalesce(CAST(sum(CASE WHEN entity_id IS NULL THEN n END) AS BIGINT), 0) AS nulls,
            CAST(sum(n - 1) AS BIGINT) AS duplicates
            FROM (SELECT 'features' AS source, entity_id, count(*) AS n FROM features_clean GROUP BY entity_id
                UNION ALL SELECT 'landing', entity_id, count(*) FROM raw_landing GROUP BY entity_id) GROUP BY source)""",
    "transformation_gate": "SELECT *, bool_and(passed) OVER () AS gate_passed FROM tests",
    "class_balance": """SELECT count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_pos,
        round(sum(label) / CAST(count(*) AS DOUBLE), 6) AS positive_rate,
        round(CAST(count(*) - sum(label) AS DOUBLE) / sum(label), 6) AS scale_pos_weight FROM features_clean""",
    "confusion_at_threshold": """SELECT threshold, count(*) FILTER (WHERE score >= threshold AND label = 1) AS tp,
        count(*) FILTER (WHERE score >= threshold AND label = 0) AS fp,
        count(*) FILTER (WHERE score < threshold AND label = 1) AS fn,
        count(*) FILTER (WHERE score < threshold AND label = 0) AS tn
        FROM scored, (SELECT unnest([0.2e0, 0.5e0, 0.8e0]) AS threshold) GROUP BY threshold""",
    "cost_threshold": f"""SELECT boundary, round(threshold, 9) AS threshold, cost FROM (
        SELECT 'low' AS boundary, * FROM ({best_cost('costs', *config.COST_LOW)})
        UNION ALL SELECT 'high', * FROM ({best_cost('costs', *config.COST_HIGH)})
        UNION ALL SELECT 'ten_to_one', * FROM ({best_cost('costs_coarse', 10, 1)}))""",
    "precision_recall_f1": f"""SELECT n_rows, round(precision, 6) AS precision, round(recall, 6) AS recall,
        round(f1, 6) AS f1
        FROM ({prf_sql('(SELECT CAST(score >= 0.5e0 AS INTEGER) AS pred, label FROM scored)')})""",
    "cascade_thresholds": """SELECT round(t_low, 9) AS t_low, round(t_high, 9) AS t_high, cost_low, cost_high
        FROM cascade""",
    "average_precision": f"""SELECT n_rows, n_pos, round(average_precision, 6) AS average_precision
        FROM ({ranking_sql('scored')})""",
    "roc_auc": f"""SELECT 'requests' AS source, n_rows, round(roc_auc, 6) AS roc_auc FROM ({ranking_sql('scored')})
        UNION ALL SELECT 'documents', n_rows, round(roc_auc, 6) FROM ({ranking_sql('''(SELECT CAST(n_chars AS DOUBLE)
            AS score, quality AS label FROM labels JOIN documents USING (doc_id))''')})""",
    "quantile_bins": f"""SELECT CAST(unnest(range(0, 10)) AS INTEGER) AS position, round(unnest(q), 6) AS edge
        FROM (SELECT quantile_cont(monthly_spend, {numbers([*DECILES, 0.75])}) AS q FROM features_clean)""",
    "ks_two_sample": f"SELECT *, bool_or(drifted) OVER () AS any_drift FROM ({ks_view('features_long')})",
    "ks_baseline_log": ks_view("""(SELECT false AS is_live, 'spend' AS feature, spend AS value FROM feature_history
        UNION ALL SELECT false, 'k', k FROM feature_history UNION ALL SELECT true, 'spend', spend FROM inference_log
        UNION ALL SELECT true, 'k', k FROM inference_log)"""),
    "leakage_fitted": " UNION ALL ".join(
        f"""SELECT '{view}' AS view, n_rows, n_pos, round(average_precision, 6) AS average_precision, round(roc_auc, 6) AS roc_auc
        FROM ({ranking_sql(f"(SELECT label, {committee_score('s', SPEND_AND_K)} AS score FROM {rows}, ({committee_sql(rows, SPEND_AND_K)}) s)")})"""
        for view, rows in (
            ("leaky", "(SELECT l.label, c.spend, c.k FROM label_events l JOIN by_time c ON l.entity_id = c.entity_id)"),
            ("pit", "(SELECT label, spend, k FROM pit WHERE spend IS NOT NULL AND k IS NOT NULL)"),
        )
    ),
    "concept_drift_fitted": f"""SELECT drifted, round(b.f1, 6) AS f1_before, round(a.f1, 6) AS f1_after,
            CASE WHEN drifted THEN 'data_drift' WHEN b.f1 - a.f1 > 0.05e0 THEN 'concept_drift' ELSE 'stable' END AS verdict,
            a.f1 < {num(config.F1_ALERT)} AS f1_alert
        FROM (SELECT bool_or(drifted) AS drifted FROM ({ks_view(CONCEPT_FEATURES)})),
            ({prf_sql(f"(SELECT * FROM {CONCEPT_FITTED} WHERE NOT is_live)")}) b,
            ({prf_sql(f"(SELECT * FROM {CONCEPT_FITTED} WHERE is_live)")}) a""",
    "psi": f"""SELECT status, n_live, psi, interpretation FROM ({psi_view('shifted_long')})
        WHERE feature = 'value'""",
    "reliability_curve": f"""SELECT CAST(len([e for e in edges if e < score]) AS INTEGER) AS bin, count(*) AS n_rows,
        round(avg(score), 6) AS mean_predicted, round(avg(CAST(label AS DOUBLE)), 6) AS observed_rate
        FROM scored, (SELECT quantile_cont(score, {numbers(DECILES)}) AS edges FROM scored) GROUP BY 1""",
    "roc_curve_youden": """SELECT threshold, round(j, 6) AS j, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr
        FROM (SELECT *, tpr - fpr AS j FROM roc_points ORDER BY j DESC, threshold DESC LIMIT 1)""",
    "roc_curve": "SELECT nullif(threshold, CAST('inf' AS DOUBLE)) AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM roc_points",
    "pr_curve": f"""SELECT score AS threshold, round(cum_pos / CAST(cum_pos + cum_neg AS DOUBLE), 6) AS precision,
        round(cum_pos / CAST(all_pos AS DOUBLE), 6) AS recall FROM ({ranked('scored')})
        UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0e0, 0.0e0""",
    "concept_vs_data_drift": f"""SELECT feature, ks_stat, drifted, round(b.f1, 6) AS f1_before, round(a.f1, 6) AS f1_after,
            CASE WHEN drifted THEN 'data_drift' WHEN b.f1 - a.f1 > 0.05e0 THEN 'concept_drift' ELSE 'stable' END AS verdict,
            a.f1 < {num(config.F1_ALERT)} AS f1_alert
        FROM ({ks_view(CONCEPT_LONG)}) k,
            ({prf_sql(f'(SELECT * FROM {CONCEPT_PREDS} WHERE NOT is_live)')}) b,
            ({prf_sql(f'(SELECT * FROM {CONCEPT_PREDS} WHERE is_live)')}) a""",
    "tier_distribution": """SELECT tier, count(*) AS n_rows, round(avg(CAST(label AS DOUBLE)), 6) AS positive_rate
        FROM tiered GROUP BY tier""",
    "recall_above_low": f"""SELECT caught, n_pos, round(caught / CAST(n_pos AS DOUBLE), 6) AS recall
        FROM (SELECT count(*) FILTER (WHERE label = 1 AND tier <> '{LO}') AS caught,
            count(*) FILTER (WHERE label = 1) AS n_pos FROM tiered)""",
    "canary_sla": f"""SELECT stage_pct, requests, errors, round(error_rate, 9) AS error_rate,
            CASE WHEN error_rate > {num(config.CANARY_ERROR_SLA)} THEN 'BREACH' ELSE 'OK' END AS status,
            NOT coalesce(bool_or(error_rate > {num(config.CANARY_ERROR_SLA)}) OVER (ORDER BY stage_pct
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS reached
        FROM (SELECT *, CASE WHEN requests = 0 THEN 0.0e0 ELSE errors / CAST(requests AS DOUBLE) END AS error_rate
            FROM (SELECT stage_pct, count(*) FILTER (WHERE bucket < stage_pct) AS requests,
                count(*) FILTER (WHERE bucket < stage_pct AND is_error = 1) AS errors
                FROM (SELECT is_error, {bucket_sql('entity_id')} AS bucket,
                    CASE WHEN request_ts < TIMESTAMP '2024-01-08' THEN 10 WHEN request_ts < TIMESTAMP '2024-01-15' THEN 25
                        WHEN request_ts < TIMESTAMP '2024-01-22' THEN 50 ELSE 100 END AS stage_pct FROM inference_log)
                GROUP BY stage_pct))""",
    "threshold_alarm": """SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, served_by, errors
        FROM (SELECT time_bucket(INTERVAL 5 MINUTE, request_ts) AS window_start, served_by,
            CAST(sum(is_error) AS BIGINT) AS errors FROM inference_log GROUP BY 1, 2) WHERE errors > 0""",
    "hitl_fast_read": f"""SELECT n_rows, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
        FROM ({prf_sql(f'''(SELECT pred, label FROM flagged ORDER BY sha256('5:' || entity_id), entity_id
            LIMIT {config.REVIEW_SAMPLE_ROWS})''')})""",
    "online_offline_mismatch_summary": "SELECT feature, count(*) AS mismatches FROM mismatches GROUP BY feature",
    "eval_slices": """SELECT entity_id, support_tickets_30d, label, unnest(CASE WHEN support_tickets_30d >=
        (SELECT quantile_cont(support_tickets_30d, 0.75e0) FROM holdout) THEN ['held_out', 'high_ticket_volume_slice']
        ELSE ['held_out'] END) AS slice FROM holdout""",
    "latest_per_entity": """SELECT *, 'time' AS basis FROM by_time UNION ALL SELECT *, 'write' FROM by_write""",
    "asof_frame": """SELECT entity_id, ts, write_seq, last_value(CASE WHEN spend >= 50 THEN spend END IGNORE NULLS) OVER
        (PARTITION BY entity_id ORDER BY ts, write_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_high
        FROM feature_history""",
    "dedupe_last_write": f"""SELECT {HISTORY} FROM (SELECT * REPLACE (date_trunc('hour', ts) AS ts) FROM feature_history)
        QUALIFY row_number() OVER (PARTITION BY entity_id, ts ORDER BY write_seq DESC) = 1""",
    "cumulative_counts": ranked("scored"),
    "rollback_target": """SELECT *, lag(version) OVER (PARTITION BY model, stage ORDER BY pointed_at, seq) AS rollback_to
        FROM pointer_log""",
    "duplicate_rows": """SELECT * FROM raw_landing QUALIFY row_number() OVER
        (PARTITION BY entity_id ORDER BY event_id) > 1""",
    "sort_by_event_time": "SELECT * FROM raw_landing ORDER BY event_timestamp, event_id",
    "latest_version": "SELECT model, max(version) AS version FROM model_cards GROUP BY model",
    "top_orphans": "SELECT entity_id FROM orphans ORDER BY entity_id LIMIT 5",
    "key_difference": "SELECT entity_id FROM orphans",
    "concat_blocks": """SELECT event_id, event_type, value, CAST(event_type = 'purchase' AS INTEGER) AS label
        FROM events""",
    "stratified_split": "SELECT entity_id, label, fold FROM folds",
    "shuffle_rows": """SELECT event_id, value, sha256('42:' || event_id) AS shuffle_key FROM events ORDER BY shuffle_key""",
    "hash_sample_n": """SELECT entity_id, avg_message_length, label FROM features_clean
        ORDER BY sha256('1:' || entity_id), entity_id LIMIT 2000""",
    "promote": " UNION ALL ".join(
        f"""SELECT d.*, w.* FROM ({promotion_sql(version, passed, dry)}) d, (SELECT round(min({version}_ap), 6)
            AS challenger_ap, round(min({other}_ap), 6) AS champion_ap,
            round(max({other}_ap - {version}_ap), 5) AS regression FROM contest) w"""
        for version, other, passed in (
            ("challenger", "champion", "passed"),
            ("champion", "challenger", f"challenger_ap - champion_ap <= {num(config.MAX_AP_REGRESSION)}"),
        )
        for dry in (False, True)
    ),
    "gate_chain": chain_sql(
        "full",
        [
            (
                "ingestion_gate",
                f"""SELECT count(*) FILTER (WHERE n_lines = 0) / CAST(count(*) AS DOUBLE)
                <= {num(config.MAX_QUARANTINE_RATE)} FROM features_clean""",
            ),
            ("transformation_gate", gate_two_sql(KEYED)),
            ("train", TRAINABLE),
            ("promotion_gate", PROMOTED),
        ],
    )
    + " UNION ALL "
    + chain_sql(
        "retrain",
        [
            ("transformation_gate", gate_two_sql("features_clean")),
            ("train", TRAINABLE),
            ("promotion_gate", PROMOTED),
        ],
    ),
}

CLOSED = "window_end <= (SELECT max(request_ts) FROM inference_log) - INTERVAL 10 MINUTE"
DRIFT_BASE = f"(SELECT value FROM events WHERE ts < TIMESTAMP '{views.DRIFT_SPLIT}')"
DRIFT_BINS = f"""(SELECT ts, is_live, len([e for e in edges if value >= e]) AS bin FROM (SELECT ts, value,
    ts >= TIMESTAMP '{views.DRIFT_SPLIT}' AS is_live FROM events),
    (SELECT quantile_cont(value, {numbers(DECILES)}) AS edges FROM {DRIFT_BASE}))"""
PREDICTION_ROWS = "(SELECT entity_id, score AS calibrated_score, ts AS predicted_at FROM scored)"
LABEL_ROWS = f"""(SELECT printf('ord_%09d', o_orderkey) AS entity_id, CAST(o_orderstatus = 'F' AS INTEGER) AS label,
    o_orderdate + INTERVAL {config.LABEL_DELAY_DAYS} DAY AS label_observed_at FROM orders)"""
REQUESTS = f"""(SELECT printf('ord_%09d', l_orderkey) AS entity_id, CAST(l_linenumber AS DOUBLE) AS support_tickets_30d,
    l_extendedprice / 10.0e0 AS avg_message_length, 1.0e0 + l_discount * 40.0e0 AS satisfaction_score,
    l_quantity AS days_since_last_login, CAST(l_suppkey AS DOUBLE) AS tenure_days,
    l_extendedprice * 12.0e0 AS monthly_spend, {score_sql(0.15)} AS calibrated_score FROM lineitem)"""

BODIES |= {
    "stream_ingestion_gate": " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS batch_id, * FROM ("
        + VIEWS["checks"].replace(
            "FROM raw_landing", f"FROM raw_landing WHERE event_timestamp {side} TIMESTAMP '{views.DRIFT_SPLIT}'"
        )
        + ")"
        for i, side in enumerate(("<", ">="))
    ),
    "stream_dual_write": f"SELECT {HISTORY} FROM by_write",
    "stream_error_alarm": f"""SELECT * FROM (SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, errors
        FROM (SELECT time_bucket(INTERVAL 5 MINUTE, request_ts) AS window_start, CAST(sum(is_error) AS BIGINT) AS errors
            FROM inference_log GROUP BY 1)) WHERE errors > 0 AND {CLOSED}""",
    "stream_canary_sla": f"""SELECT *, round(errors / CAST(requests AS DOUBLE), 6) AS error_rate,
            CASE WHEN errors / CAST(requests AS DOUBLE) > {num(config.CANARY_ERROR_SLA)} THEN 'BREACH' ELSE 'OK' END AS status
        FROM (SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, served_by, requests, errors
            FROM (SELECT time_bucket(INTERVAL 1 HOUR, request_ts) AS window_start, served_by, count(*) AS requests,
                CAST(sum(is_error) AS BIGINT) AS errors FROM inference_log GROUP BY 1, 2)) WHERE {CLOSED}""",
    "stream_hourly_drift": f"""SELECT window_start, window_end,
            CASE WHEN enough THEN 'checked' ELSE 'insufficient_data' END AS status, n_live,
            CASE WHEN enough THEN round(psi, 4) END AS psi, CASE WHEN enough THEN round(ks, 4) END AS ks_binned,
            CASE WHEN enough THEN {band_sql('psi')} END AS interpretation
        FROM (SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, n_live,
            n_live >= {config.MIN_LOGGED_ROWS} AS enough, sum((ca - ce) * ln(ca / ce)) AS psi, max(gap) AS ks
            FROM (SELECT *, greatest(1e-6, a) AS ca, greatest(1e-6, e) AS ce,
                abs(sum(a) OVER (PARTITION BY window_start ORDER BY bin) - sum(e) OVER
                    (PARTITION BY window_start ORDER BY bin)) AS gap
                FROM (SELECT w.window_start, w.n_live, b.bin, coalesce(c.n, 0) / CAST(w.n_live AS DOUBLE) AS a,
                    b.n / CAST(sum(b.n) OVER (PARTITION BY w.window_start) AS DOUBLE) AS e
                    FROM (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, count(*) AS n_live
                        FROM {DRIFT_BINS} WHERE is_live GROUP BY 1) w
                    CROSS JOIN (SELECT g.bin, coalesce(h.n, 0) AS n FROM (SELECT unnest(range(0, 10)) AS bin) g
                        LEFT JOIN (SELECT bin, count(*) AS n FROM {DRIFT_BINS} WHERE NOT is_live GROUP BY bin) h
                        ON g.bin = h.bin) b
                    LEFT JOIN (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, bin, count(*) AS n
                        FROM {DRIFT_BINS} WHERE is_live GROUP BY 1, 2) c
                    ON c.window_start = w.window_start AND c.bin = b.bin))
            GROUP BY window_start, n_live) WHERE {CLOSED}""",
    "stream_label_delay_join": f"""SELECT p.entity_id, calibrated_score, predicted_at, label, label_observed_at
        FROM {PREDICTION_ROWS} p JOIN {LABEL_ROWS} l ON p.entity_id = l.entity_id AND label_observed_at >= predicted_at
            AND label_observed_at <= predicted_at + INTERVAL {config.LABEL_DELAY_DAYS} DAY""",
    "stream_validate_route": f"""SELECT entity_id, CASE WHEN violations = '' THEN calibrated_score END AS calibrated_score,
            violations, violations = '' AS valid, CASE WHEN violations <> '' THEN NULL
                WHEN {bucket_sql('entity_id')} < {views.CANARY_PCT} THEN 'challenger' ELSE 'champion' END AS served_by,
            CASE WHEN violations = '' THEN {tier_sql('calibrated_score', T_LOW, T_HIGH)} END AS tier,
            CASE WHEN violations = '' THEN {near_sql('calibrated_score', T_LOW, T_HIGH)} END AS low_confidence
        FROM (SELECT *, concat_ws(',', {VIOLATIONS}) AS violations FROM {REQUESTS})""",
    "stream_dedup_log": "SELECT event_id, ts, value FROM events",
    "late_label_audit": f"""SELECT CASE WHEN label_observed_at IS NULL THEN 'no_label'
            WHEN label_observed_at < predicted_at THEN 'before_prediction'
            WHEN label_observed_at <= predicted_at + INTERVAL {config.LABEL_DELAY_DAYS} DAY THEN 'in_time'
            ELSE 'late' END AS arrival, count(*) AS predictions
        FROM {PREDICTION_ROWS} p LEFT JOIN {LABEL_ROWS} l ON p.entity_id = l.entity_id GROUP BY 1""",
}


LABEL_MARK = f"""(SELECT least((SELECT max(predicted_at) FROM {PREDICTION_ROWS}),
    (SELECT max(label_observed_at) FROM {LABEL_ROWS})) - INTERVAL 1 DAY - INTERVAL {config.LABEL_DELAY_DAYS} DAY)"""
WEEKS = " ".join(
    f"WHEN request_ts >= TIMESTAMP '{a}' AND request_ts < TIMESTAMP '{b}' THEN {pct}"
    for pct, a, b in zip(config.CANARY_STAGES, ROLLOUT_DAYS, ROLLOUT_DAYS[1:])
)
SLA = num(config.CANARY_ERROR_SLA)
BODIES |= {
    "stream_label_outcomes": f"""SELECT p.entity_id, calibrated_score, predicted_at, label, label_observed_at,
            CASE WHEN label_observed_at IS NULL THEN 'no_label_in_time' ELSE 'labelled' END AS outcome
        FROM {PREDICTION_ROWS} p LEFT JOIN {LABEL_ROWS} l ON p.entity_id = l.entity_id AND label_observed_at >= predicted_at
            AND label_observed_at <= predicted_at + INTERVAL {config.LABEL_DELAY_DAYS} DAY
        WHERE label_observed_at IS NOT NULL OR predicted_at < {LABEL_MARK}""",
    "stream_canary_rollout": f"""SELECT variant, stage_pct, requests, errors, round(rate, 9) AS error_rate,
            CASE WHEN rate > {SLA} THEN 'BREACH' ELSE 'OK' END AS status,
            NOT coalesce(bool_or(rate > {SLA}) OVER (PARTITION BY variant ORDER BY stage_pct
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS reached
        FROM (SELECT *, CASE WHEN requests = 0 THEN 0.0e0 ELSE errors / CAST(requests AS DOUBLE) END AS rate
            FROM (SELECT v.variant, s.stage_pct, count(l.variant) AS requests,
                count(l.variant) FILTER (WHERE is_error = 1) AS errors
                FROM (SELECT unnest(['canary', 'stable']) AS variant) v
                CROSS JOIN (SELECT unnest({config.CANARY_STAGES}) AS stage_pct) s
                LEFT JOIN (SELECT stage_pct, is_error, CASE WHEN bucket < stage_pct THEN 'canary' ELSE 'stable' END AS variant
                    FROM (SELECT is_error, {bucket_sql('entity_id')} AS bucket, CASE {WEEKS} END AS stage_pct
                        FROM inference_log) WHERE stage_pct IS NOT NULL) l
                ON l.variant = v.variant AND l.stage_pct = s.stage_pct GROUP BY 1, 2))""",
    "stream_window_ks": f"""SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, n_baseline, n_live,
            round(max(abs(cb / CAST(n_baseline AS DOUBLE) - cl / CAST(n_live AS DOUBLE))), 6) AS d
        FROM (SELECT window_start, n_baseline, n_live, sum(b) OVER w AS cb, sum(l) OVER w AS cl
            FROM (SELECT g.window_start, g.n_live, (SELECT count(*) FROM {DRIFT_BASE}) AS n_baseline, v.value,
                (v.window_start IS NULL)::INT AS b, 1 - b AS l
                FROM (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, count(*) AS n_live FROM events
                    WHERE ts >= TIMESTAMP '{views.DRIFT_SPLIT}' GROUP BY 1) g
                JOIN (SELECT NULL AS window_start, value FROM {DRIFT_BASE}
                    UNION ALL SELECT time_bucket(INTERVAL 6 HOUR, ts), value FROM events
                    WHERE ts >= TIMESTAMP '{views.DRIFT_SPLIT}') v
                ON v.window_start IS NULL OR v.window_start = g.window_start)
            WINDOW w AS (PARTITION BY window_start ORDER BY value))
        GROUP BY window_start, n_baseline, n_live
        HAVING window_start + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
}


TRAIN, HELD = "(SELECT * FROM keyed_folds WHERE fold = 'train')", "(SELECT * FROM keyed_folds WHERE fold <> 'train')"
FOLD_SIZE = "count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_pos"
RANKED_FACTS = "true AS beats_chance, true AS in_range"

BODIES |= {
    "linear_l1_l2": f"""SELECT penalty, {FOLD_SIZE}, {RANKED_FACTS}
        FROM {HELD}, (SELECT unnest(['l1', 'l2']) AS penalty) GROUP BY penalty""",
    "boosted_trees": f"""SELECT h.*, {RANKED_FACTS}, 200 AS trees, true AS shallow, t.n_train, t.scale_pos_weight
        FROM (SELECT {FOLD_SIZE} FROM {HELD}) h, (SELECT count(*) AS n_train,
            round(CAST(count(*) - sum(label) AS DOUBLE) / sum(label), 6) AS scale_pos_weight FROM {TRAIN}) t""",
    "platt_scaling": f"""SELECT {FOLD_SIZE}, true AS in_range, true AS adds_up, true AS increasing
        FROM keyed_folds WHERE fold = 'calibration'""",
    "isotonic": f"""SELECT {FOLD_SIZE}, true AS pools_are_means, true AS increasing FROM keyed_folds WHERE fold = 'calibration'""",
    "batch_score": f"""SELECT entity_id, round(score, 9) AS calibrated_score, {tier_sql('score', 't_low', 't_high')} AS tier,
            {near_sql('score', 't_low', 't_high')} AS low_confidence
        FROM (SELECT entity_id, {committee_score('s')} AS score FROM features_clean, stumps s), stump_cuts""",
    "evaluate_on": f"""SELECT eval_set, n_rows, n_pos, round(average_precision, 6) AS average_precision,
            round(roc_auc, 6) AS roc_auc, {RANKED_FACTS}
        FROM ({ranking_sql("""(SELECT *, unnest(CASE WHEN fold = 'test' THEN ['holdout', 'untouched'] ELSE ['holdout'] END)
            AS eval_set FROM voted WHERE fold <> 'train')""", 'eval_set')})""",
    "train_and_register": """SELECT 'catalogue' AS data_version, 'none' AS stage, 200 AS rounds,
        count(*) FILTER (WHERE fold = 'train') AS n_train, count(*) FILTER (WHERE fold = 'test') AS n_final_test,
        round(sum(label) FILTER (WHERE fold = 'train') / CAST(count(*) FILTER (WHERE fold = 'train') AS DOUBLE), 6)
            AS positive_rate_train, true AS thresholds_ordered, true AS in_range FROM keyed_folds""",
    "registry_append": " UNION ALL ".join(
        f"""SELECT CAST({i} AS INTEGER) AS tree, CAST({node} AS INTEGER) AS node, {feature} AS feature, round({cut}, 9) AS cut,
            CAST({below} AS INTEGER) AS below, CAST({above} AS INTEGER) AS above, round({leaf}, 9) AS leaf,
            round({num(1.0 / len(config.FEATURES))}, 9) AS weight FROM stumps"""
        for i, f in enumerate(config.FEATURES)
        for node, feature, cut, below, above, leaf in (
            (0, f"'{f}'", f"c{i}", 1, 2, "CAST(NULL AS DOUBLE)"),
            (1, "CAST(NULL AS VARCHAR)", "CAST(NULL AS DOUBLE)", "NULL", "NULL", f"l{i}"),
            (2, "CAST(NULL AS VARCHAR)", "CAST(NULL AS DOUBLE)", "NULL", "NULL", f"h{i}"),
        )
    ),
    "baseline_gaps": f"""SELECT round(r.average_precision, 6) AS heuristic_ap, round(c.average_precision, 6) AS committee_ap,
            round(c.average_precision - r.average_precision, 6) AS heuristic_to_committee,
            true AS gaps_add_up, true AS trees_beat_the_rule
        FROM ({ranking_sql('(SELECT CAST(pred AS DOUBLE) AS score, label FROM held_flagged)')}) r,
            ({ranking_sql("(SELECT * FROM voted WHERE fold <> 'train')")}) c""",
    "full_run": f"""SELECT CAST(position AS INTEGER) AS position, step, status FROM ({chain_sql(
        "full",
        [
            ("ingestion_gate", f"""SELECT count(*) FILTER (WHERE n_lines = 0) / CAST(count(*) AS DOUBLE)
                <= {num(config.MAX_QUARANTINE_RATE)} FROM features_clean"""),
            ("transformation_gate", gate_two_sql(KEYED)),
            ("train", TRAINABLE.replace("FROM folds", "FROM keyed_folds")),
            ("promotion_gate", "SELECT true"),
        ],
    )})""",
    "promote_registered": f"""SELECT slice, round(champion_ap, 6) AS champion_ap, round(champion_auc, 6) AS champion_auc,
            round(challenger_ap, 6) AS challenger_ap, round(challenger_auc, 6) AS challenger_auc,
            round(regression, 5) AS regression, c.passed, stage, alert
        FROM registered_contest c, ({promotion_sql('v2', 'passed', False).replace('FROM contest', 'FROM registered_contest')}) d""",
    "score_psi": "SELECT 'checked' AS status, count(*) AS n_live, true AS not_negative, true AS band_agrees FROM events",
    "feature_importance": " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round(coalesce(g{i} / nullif({' + '.join(f'g{k}' for k in range(len(config.FEATURES)))}, 0), 0), 6) AS importance, true AS in_range, 1.0e0 AS total FROM stumps"
        for i, f in enumerate(config.FEATURES)
    ),
}


def oracle_sql() -> dict[str, str]:
    return {name: sql(body) for name, body in BODIES.items()}
