"""SQL texts that state each registered query independently of Spark."""

from __future__ import annotations

from ..functions import AMOUNT_BUCKETS, FRAUD_RULES, STATUS_BANDS, Bands
from ..schema import COMPONENTS, FEATURES
from ..sources.transactions import (
    EPOCH, LABEL_BELOW, LABEL_LINEAR, LABEL_MODULUS, LABEL_SQUARE, NOISE_INDEX, NOISE_KEY, NOISE_MODULUS,
)

_M = f"(e.event_id % {LABEL_MODULUS})"
_FRAUD = f"(({_M} * {_M} * {LABEL_SQUARE} + {_M} * {LABEL_LINEAR}) % {LABEL_MODULUS} < {LABEL_BELOW})"
_TIME = f"CAST(epoch_us(e.ts) - epoch_us(TIMESTAMP '{EPOCH}') AS DOUBLE) / 1e6"
_K = "CAST(regexp_extract(e.props, '[0-9]+') AS INTEGER)"
_AMOUNT = f"CASE WHEN {_FRAUD} THEN e.value * 4e0 ELSE e.value END"


def _component(i: int) -> str:
    z = (
        f"(CAST(m.embedding[{i}] AS DOUBLE) * 8e0 + CAST(((e.event_id % {NOISE_MODULUS}) * {NOISE_KEY}"
        f" + {i * NOISE_INDEX}) % {NOISE_MODULUS} AS DOUBLE) / {NOISE_MODULUS}e0 - 5e-1)"
    )
    return f"CASE WHEN {_FRAUD} THEN -2e0 + 3e0 * {z} ELSE {z} END"


def tx(components: list[str] | None = None, raw: bool = False) -> str:
    """CTE `tx`: the transactions, or the feed before cleaning."""
    components = COMPONENTS if components is None else components
    values = {c: _component(int(c[1:])) for c in components}
    amount = _AMOUNT
    if raw:
        amount = f"CASE {_K} WHEN 1 THEN NULL WHEN 2 THEN -({_AMOUNT}) WHEN 3 THEN 0e0 ELSE {_AMOUNT} END"
        if "V1" in values:
            values["V1"] = f"CASE WHEN {_K} <> 0 THEN {values['V1']} END"
    columns = "".join(f", {sql} AS {c}" for c, sql in values.items())
    join = (
        " LEFT JOIN embeddings m ON e.event_id % (SELECT count(*) FROM embeddings) = m.vec_id"
        if components
        else ""
    )
    return (
        f"tx AS (SELECT e.event_id, e.user_id, {_TIME} AS Time{columns}, {amount} AS Amount, "
        f"CAST({_FRAUD} AS INTEGER) AS Class FROM events e{join})"
    )


def rnd(x: str, digits: int) -> str:
    """Round half away from zero in decimal, as Spark does for the printed form of a double."""
    return f"CAST(round(CAST({x} AS DECIMAL(38, 12)), {digits}) AS DOUBLE)"


def pct(part: str, whole: str, digits: int = 4) -> str:
    return rnd(f"coalesce(CAST({part} AS DOUBLE) * 100 / nullif(CAST({whole} AS DOUBLE), 0), 0)", digits)


def div(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0)"


HOUR = "CAST(trunc(Time / 3600) AS INTEGER) % 24"
FRAUDS = "count(*) FILTER (WHERE Class = 1)"
NORMALS = "count(*) FILTER (WHERE Class = 0)"


def case_bands(column: str, bands: Bands, ordinal: bool = False) -> str:
    names = list(range(1, len(bands.labels) + 1)) if ordinal else [f"'{x}'" for x in bands.labels]
    arms = " ".join(f"WHEN {column} < {e} THEN {n}" for e, n in zip(bands.edges, names))
    return f"CASE {arms} ELSE {names[-1]} END"


BUCKET = case_bands("Amount", AMOUNT_BUCKETS)

SCORE = " + ".join(
    f"CASE WHEN {r.column} {r.op} {r.threshold} THEN CAST({r.weight} AS DOUBLE) ELSE 0e0 END" for r in FRAUD_RULES
)
RULE_COMPONENTS = ["V1", "V3", "V4", "V7", "V10"]

#: CTEs `tx` and `scored` with rule score, prediction and alert label.
SCORED = (
    tx(RULE_COMPONENTS)
    + f", ruled AS (SELECT *, {SCORE} AS fraud_score FROM tx)"
    + ", scored AS (SELECT *, CAST(fraud_score > 0.5 AS INTEGER) AS prediction, "
    "CASE WHEN fraud_score > 0.5 THEN 'FRAUD_ALERT' ELSE 'NORMAL' END AS is_alert FROM ruled)"
)

_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in ["Time", *FEATURES, "Class"])

#: CTEs for the cleaning steps over the raw feed.
CLEANING = (
    tx(raw=True)
    + f", complete AS (SELECT * FROM tx WHERE {_COMPLETE})"
    + ", valid AS (SELECT * FROM complete WHERE Amount > 0)"
    + ", bound AS (SELECT quantile_cont(Amount, 0.999) AS threshold FROM valid WHERE Class = 0)"
    + f", clean AS (SELECT v.*, {HOUR} AS Hour, {rnd('Amount', 2)} AS Amount_Log, "
    "CAST(Amount > 500 AS INTEGER) AS Is_High_Amount FROM valid v "
    "WHERE Amount <= (SELECT threshold FROM bound) OR Class = 1)"
)


def keyhash(key: str, salt: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{salt}'), 1, 8) AS BIGINT)"


def uniform(key: str, salt: str) -> str:
    return f"({keyhash(key, salt)} / 4294967296e0)"


def areas(source: str, score: str, by: str = "") -> str:
    """CTE `area`: exact areas under the curves of `source`."""
    keys, over = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    group = f" GROUP BY {by}" if by else ""
    return (
        f"sc AS (SELECT {keys}{score} AS score, {FRAUDS} AS pos, {NORMALS} AS neg FROM {source} GROUP BY ALL), "
        f"ab AS (SELECT *, sum(pos) OVER w - pos AS pa, sum(neg) OVER w - neg AS na FROM sc "
        f"WINDOW w AS ({over}ORDER BY score DESC ROWS UNBOUNDED PRECEDING)), "
        f"area AS (SELECT {keys}coalesce(CAST(sum(neg * (pa + pos / 2e0)) AS DOUBLE) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0), 0) AS auc_roc, "
        f"sum(CAST(pos AS DOUBLE) * ((pa + pos) / CAST(pa + pos + na + neg AS DOUBLE) + "
        f"coalesce(pa / nullif(CAST(pa + na AS DOUBLE), 0), (pa + pos) / CAST(pa + pos + na + neg AS DOUBLE))) / 2) "
        f"/ sum(pos) AS auc_pr FROM ab{group})"
    )


CELLS = (
    "count(*) FILTER (WHERE Class = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE Class = 0 AND prediction = 1) AS fp, "
    "count(*) FILTER (WHERE Class = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE Class = 1 AND prediction = 0) AS fn"
)
FRAUD_MEASURES = (
    f"{rnd(div('tp', 'tp + fp'), 4)} AS fraud_precision, {rnd(div('tp', 'tp + fn'), 4)} AS fraud_recall, "
    f"{rnd(div('2 * tp', '2 * tp + fp + fn'), 4)} AS fraud_f1"
)


def _weighted(fraud: str, normal: str) -> str:
    return rnd(div(f"(tp + fn) * {fraud} + (tn + fp) * {normal}", "tp + fp + tn + fn"), 4)


WEIGHTED_MEASURES = (
    f"{rnd(div('tp + tn', 'tp + fp + tn + fn'), 4)} AS accuracy, "
    f"{_weighted(div('tp', 'tp + fp'), div('tn', 'tn + fn'))} AS precision, "
    f"{_weighted(div('tp', 'tp + fn'), div('tn', 'tn + fp'))} AS recall, "
    f"{_weighted(div('2 * tp', '2 * tp + fp + fn'), div('2 * tn', '2 * tn + fn + fp'))} AS f1_score"
)

#: CTE `frauds` with exact microsecond times.
FRAUD_TIMES = (
    tx([])
    + ", frauds AS MATERIALIZED (SELECT event_id, user_id, Time, CAST(round(Time * 1000000) AS BIGINT) AS tick FROM tx WHERE Class = 1)"
    + ", pairs AS MATERIALIZED (SELECT a.event_id AS src, b.event_id AS dst FROM frauds a JOIN frauds b "
    "ON abs(a.tick - b.tick) < 3600000000 AND a.event_id <> b.event_id)"
)


def status_case() -> str:
    arms = " ".join(f"WHEN '{m}' THEN {case_bands('value', b)}" for m, b in STATUS_BANDS.items())
    return f"CASE metric {arms} END"


def component_labels(edges: str) -> str:
    """CTE `labels` (id, component) by following the symmetric edges of CTE `edges`; needs WITH RECURSIVE."""
    return (
        f"reach(id, seen) AS (SELECT DISTINCT src, src FROM {edges} UNION SELECT r.id, e.dst FROM reach r "
        f"JOIN {edges} e ON r.seen = e.src), labels AS (SELECT id, min(seen) AS component FROM reach GROUP BY id)"
    )
