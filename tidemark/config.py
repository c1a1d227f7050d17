"""Tunables. The values below are fixed: results depend on them."""

from __future__ import annotations

# The model's feature columns, in order.
FEATURES = [
    "support_tickets_30d",
    "avg_message_length",
    "satisfaction_score",
    "days_since_last_login",
    "tenure_days",
    "monthly_spend",
]

# Inclusive request bounds per feature, and the key's length bounds.
FEATURE_BOUNDS = {
    "support_tickets_30d": (0.0, 1000.0),
    "avg_message_length": (0.0, 20000.0),
    "satisfaction_score": (1.0, 5.0),
    "days_since_last_login": (0.0, 3650.0),
    "tenure_days": (0.0, 20000.0),
    "monthly_spend": (0.0, 1000000.0),
}
ENTITY_ID_LENGTH = (1, 64)

# Ingestion gate.
VOLUME_BASELINE_ROWS = 20_000
VOLUME_DROP_LIMIT = 0.30
MAX_QUARANTINE_RATE = 0.05
ROLLING_VOLUME_DAYS = 7

# Cost matrices (false negative, false positive) of the two tier boundaries.
COST_LOW = (8, 1)
COST_HIGH = (3, 6)

# Drift alerts.
KS_P_LIMIT = 0.05
PSI_MODERATE = 0.10
PSI_MAJOR = 0.25
MIN_LOGGED_ROWS = 30

# Promotion, canary, serving and label delay.
MAX_AP_REGRESSION = 0.01
CANARY_ERROR_SLA = 0.001
CANARY_STAGES = [10, 25, 50, 100]
LOW_CONFIDENCE_BAND = 0.05
LABEL_DELAY_DAYS = 21
F1_ALERT = 0.5
RECONCILE_TOLERANCE = 0.01
RETENTION_DAYS = 14
LOG_READ_LIMIT = 10_000
REVIEW_SAMPLE_ROWS = 50

# Tier names and alert prefixes.
TIERS = ("auto_resolve", "review_queue", "senior_escalation")
ALERT_PREFIX = {"warning": "[ALERT]", "critical": "[CRITICAL ALERT]"}

# Drift bands by descending lower bound, and the band below them all.
PSI_BANDS = [
    (PSI_MAJOR, "MAJOR shift -- investigate immediately, do not wait for labels"),
    (PSI_MODERATE, "MODERATE shift -- early warning"),
]
PSI_STABLE = "stable"

# Gate actions and alert messages (printf formats).
ACTION_PASS = "PASS"
ACTION_QUARANTINE = "%d rows ROUTED TO DEAD LETTER QUEUE, batch proceeds"
ACTION_BLOCKED = "BATCH BLOCKED -- quarantine rate exceeds tolerance"
ACTION_VOLUME = "ALERT: volume drop beyond threshold"
MESSAGE_VOLUME = "Ingestion volume down %.1f%% vs 7-day rolling average."
MESSAGE_TRANSFORMATION = "Transformation gate FAILED -- downstream training DAG blocked."
MESSAGE_DATA_DRIFT = "Data drift detected on features: [%s]. Consider moving the next retrain up sooner."
MESSAGE_PSI = "Score PSI = %.4f (%s)"
MESSAGE_BACKFILL = (
    "Backfilled F1 = %.4f on %d matched predictions -- this is a concept-drift signal, "
    "not just a data-drift one. Consider retraining soon."
)
MESSAGE_PROMOTED = "Promoted %s to production (champion-challenger gate passed)."
MESSAGE_NOT_PROMOTED = "Champion-challenger gate FAILED for %s -- staged, not promoted."

# Names of checks and tests (the latter with the key), slices and report statuses.
CHECK_NOT_NULL = "not_null_entity_id"
CHECK_VOLUME = "row_count_volume_check"
TEST_UNIQUE = "unique_and_not_null(%s)"
TEST_RELATED = "relationships(%s, features -> labels)"
EVAL_SLICES = ("held_out", "high_ticket_volume_slice")
STATUS_CHECKED = "checked"
STATUS_FEW_ROWS = "insufficient_data"
STATUS_NO_LABELS = "no_matching_labels"
STATUS_NO_MODEL = "no_production_model"
