"""The same answers in plain SQL for another engine.

The SQL is written on its own. It shares with the queries what defines the question: the
expressions of the call view over ``events``, patterns, spellings, column lists and the
parameters of the queries.
"""

from __future__ import annotations

from ringwatch.plans.catalog import (
    BUSY_CALLS,
    CORRECTED_DAY,
    FILTER,
    FIXED_FEATURES,
    FIXED_SCORE,
    KEYWORD_COLUMNS,
    LOOKUP_NUMBER,
    LOOKUP_PREFIX,
)
from ringwatch.schema import (
    ACTION_FLAGS,
    BASE_FEATURES,
    CALL_COLUMNS,
    CHANNEL_SPELLINGS,
    KEYWORD_PATTERNS,
    LABEL_SPELLINGS,
    LABELS,
    PROJECTION_COLUMNS,
    SCALED_FEATURES,
    SCORE_WORDS,
)
from ringwatch.sources.event_calls import CALL_EXPRESSIONS, DURATION_DRIFT, NEARLY_REPEATED, REPEATED


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "(" + ", ".join(_text(v) for v in values) + ")"


def _digits(number: str) -> str:
    return "".join(ch for ch in number if ch.isdigit())


def _case(column: str, spellings: dict[str, str]) -> str:
    whens = " ".join(f"when {_text(k)} then {_text(v)}" for k, v in spellings.items())
    return f"case {column} {whens} else {column} end"


# --- Base tables as a chain of CTEs ------------------------------------------


_DAY, _MONTH, _HOUR, _MIN, _SEC = (
    f"lpad(cast({p}(ts) as varchar), 2, '0')" for p in ("day", "month", "hour", "minute", "second")
)
_YEAR = "cast(year(ts) as varchar)"
_RAW_TIME = (
    "case event_id % 20 "
    f"when 0 then concat({_DAY}, '/', {_MONTH}, '/', {_YEAR}, ' ', {_HOUR}, ':', {_MIN}) "
    f"when 1 then concat({_MONTH}, '-', {_DAY}, '-', cast(year(ts) % 100 as varchar), ' ', {_HOUR}, ':', {_MIN}, ':', {_SEC}) "
    f"when 2 then concat({_YEAR}, '-', {_MONTH}, '-', {_DAY}, 'T', {_HOUR}, ':', {_MIN}, ':', {_SEC}, '+02:00') "
    f"when 3 then concat({_DAY}, '.', {_MONTH}, '.', {_YEAR}, ' kell ', {_HOUR}, ':', {_MIN}) "
    f"else concat({_YEAR}, '-', {_MONTH}, '-', {_DAY}, ' ', {_HOUR}, ':', {_MIN}, ':', {_SEC}) end"
)


def _projection(where: str = "", duration: str = "") -> str:
    columns = {**CALL_EXPRESSIONS, "timestamp": _RAW_TIME}
    if duration:
        columns["duration_sec"] = f"({columns['duration_sec']}) + {duration}"
    body = ", ".join(f"{columns[name]} as {name}" for name in CALL_COLUMNS)
    return f"select {body} from events" + (f" where {where}" if where else "")


_MINUTE = "date_trunc('minute', ts)"
_FRAUD = "('Confirmed_Fraud', 'High_Risk_Reported')"
_CANON = "replace(lower(trim(label_5way)), '-', '_')"
_ALL = ", ".join(CALL_COLUMNS)

_LINE = "greatest(0, 1 - coalesce(time_to_next_action_min, 60) / 120)"
_RULE = "(" + " + ".join(f"cast({c} as int)" for c in ACTION_FLAGS) + ") / 5.0::double"

_CTES = {
    "calls": (
        f"{_projection()} union all {_projection(REPEATED)} union all {_projection(NEARLY_REPEATED, DURATION_DRIFT)}"
    ),
    # Offsets in this table are all +02:00 in January, which is Tallinn time.
    "timed": (
        "select *, case when timestamp like '%kell%' then try_strptime(timestamp, '%d.%m.%Y kell %H:%M') "
        "when timestamp like '%/%' then try_strptime(timestamp, '%d/%m/%Y %H:%M') "
        "when timestamp like '%T%' then try_cast(left(timestamp, 19) as timestamp) "
        "when timestamp like '__-%' then try_strptime(timestamp, '%m-%d-%y %H:%M:%S') "
        "else try_cast(timestamp as timestamp) end as ts from calls"
    ),
    "clean": (
        f"select * replace ({_case('channel', CHANNEL_SPELLINGS)} as channel, "
        f"{_case('label_5way', LABEL_SPELLINGS)} as label_5way) from timed"
    ),
    "target": (
        f"select *, cast(label_5way in {_FRAUD} as int) as is_fraud from clean "
        f"where label_5way in ('Confirmed_Fraud', 'High_Risk_Reported', 'Verified_Legitimate')"
    ),
    "digits": (
        "select * replace (regexp_replace(caller_number, '[^0-9]', '', 'g') as caller_number, "
        "regexp_replace(called_number, '[^0-9]', '', 'g') as called_number) from timed"
    ),
    "once": "select distinct * from timed",
    "gaps": (
        "select *, duration_sec - lag(duration_sec) over (partition by caller_number, called_number, "
        f"{_MINUTE} order by duration_sec nulls last, call_id) as gap from once"
    ),
    "deduped": "select * exclude (gap) from gaps where gap is null or gap > 5",
    "dclean": (
        f"select * replace ({_case('channel', CHANNEL_SPELLINGS)} as channel, "
        f"{_case('label_5way', LABEL_SPELLINGS)} as label_5way) from deduped"
    ),
    "labelled": (
        f"select *, cast(label_5way in {_FRAUD} as int) as is_fraud from dclean "
        f"where label_5way in ('Confirmed_Fraud', 'High_Risk_Reported', 'Verified_Legitimate')"
    ),
    "placed": (
        "select *, row_number() over (order by ts nulls last, call_id) as place, count(*) over () as total from labelled"
    ),
    "split": (
        "select * exclude (place, total), case when place <= cast(floor(total * 0.8) as bigint) then 'train' "
        "else 'test' end as split from placed"
    ),
    "temporal": (
        "select *, cast(hour(ts) as int) as hour, cast(isodow(ts) - 1 as int) as weekday, "
        "coalesce(isodow(ts) >= 6, false) as is_weekend, "
        "coalesce(hour(ts) >= 9 and hour(ts) < 17 and isodow(ts) < 6, false) as is_business_hours from split"
    ),
    "looked_back": (
        "select call_id, "
        "count(*) over (partition by caller_number order by ts range between interval 24 hours preceding "
        "and interval 1 microsecond preceding) as calls_from_number_last_24h, "
        "count(distinct called_number) over (partition by caller_number order by ts range between "
        "interval 7 days preceding and interval 1 microsecond preceding) as distinct_victims_last_7d, "
        "round(avg(duration_sec) over (partition by caller_number), 6) as mean_call_duration_per_number, "
        "cast("
        + " + ".join(f"cast(contains(lower(coalesce(complaint_text, '')), {_text(w)}) as int)" for w in SCORE_WORDS)
        + " as int) as complaint_keyword_score from labelled"
    ),
    "features": (
        "select call_id, ts, split, is_fraud, duration_sec, was_answered, was_hangup_by_client, "
        + ", ".join(ACTION_FLAGS)
        + ", time_to_next_action_min, manual_severity, hour, weekday, is_weekend, is_business_hours, "
        "count(*) over (partition by substr(regexp_replace(caller_number, '[^0-9]', '', 'g'), 1, 5)) "
        "as caller_number_prefix_freq, "
        "cast(coalesce(channel = 'Mobile', false) as int) as \"channel_Mobile\", "
        "cast(coalesce(channel = 'VoIP', false) as int) as \"channel_VoIP\" from temporal"
    ),
    # Prefix counts of the training part only.
    "prefixes": (
        "select substr(regexp_replace(caller_number, '[^0-9]', '', 'g'), 1, 5) as prefix, count(*) as freq "
        "from split where split = 'train' group by 1"
    ),
    "features_train_only": (
        "select f.* replace (p.freq as caller_number_prefix_freq) from features f join labelled l using (call_id) "
        "left join prefixes p on p.prefix = substr(regexp_replace(l.caller_number, '[^0-9]', '', 'g'), 1, 5)"
    ),
    "rule": (
        "select *, (" + " + ".join(f"cast({c} as int)" for c in ACTION_FLAGS) + ") / 5.0::double as score from target"
    ),
    "scored": "select *, cast(score >= 0.4 as int) as prediction from rule",
    "cells": (
        "select count(*) filter (is_fraud = 1 and prediction = 1) as tp, "
        "count(*) filter (is_fraud = 0 and prediction = 1) as fp, "
        "count(*) filter (is_fraud = 1 and prediction = 0) as fn, "
        "count(*) filter (is_fraud = 0 and prediction = 0) as tn from scored"
    ),
    "fixed": f"select *, {_RULE} as rule_p, {_LINE} as line_p from labelled",
    "profile": (
        "select caller_number, count(call_id) as total_calls, count(distinct called_number) as distinct_victims, "
        f"avg(cast(coalesce(label_5way in {_FRAUD}, false) as int)) as fraud_rate, "
        "avg(duration_sec) as avg_duration_sec from clean where caller_number is not null group by caller_number"
    ),
    "hits": (
        "select label_5way as label, count(*) as n_complaints, "
        + ", ".join(
            f"count(*) filter (regexp_matches(lower(coalesce(complaint_text, '')), {_text(p)})) as {KEYWORD_COLUMNS[n]}"
            for n, p in KEYWORD_PATTERNS.items()
        )
        + " from clean group by label_5way"
    ),
    "kw": (
        "select label_no, l.label, coalesce(n_complaints, 0) as n_complaints, "
        + ", ".join(f"coalesce({c}, 0) as {c}" for c in KEYWORD_COLUMNS.values())
        + " from (values "
        + ", ".join(f"({i}, {_text(x)})" for i, x in enumerate(LABELS))
        + ") l(label_no, label) left join hits h on h.label = l.label"
    ),
}


def _with(body: str) -> str:
    """``body`` with the CTEs it needs, in their order."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name, text in _CTES.items():
            if name not in needed and (f"from {name}" in sql or f"join {name}" in sql):
                needed.add(name)
                visit(text)

    visit(body)
    if not needed:
        return body
    ctes = ", ".join(f"{n} as ({t})" for n, t in _CTES.items() if n in needed)
    return f"with {ctes} {body}"


def _medians(table: str, columns, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    tail = f" group by {by}" if by else ""
    return " union all ".join(
        f"select {lead}{_text(c)} as \"column\", round(median(cast({c} as double)), 6) as median from {table}{tail}"
        for c in columns
    )


def _auc(table: str, score: str, by: str = "") -> str:
    """Rank-sum form, ties at their middle rank."""
    lead, part = (f"{by}, ", f"partition by {by} ") if by else ("", "")
    ranked = (
        f"select {lead}is_fraud, rank() over ({part}order by {score}) "
        f"+ (count(*) over (partition by {lead}{score}) - 1) / 2.0 as r from {table}"
    )
    area = (
        "round((sum(r) filter (is_fraud = 1) - count(*) filter (is_fraud = 1) * (count(*) filter (is_fraud = 1) + 1) / 2.0) "
        "/ (count(*) filter (is_fraud = 1) * count(*) filter (is_fraud = 0)::double), 6) as roc_auc"
    )
    return f"select {lead}{area} from ({ranked})" + (f" group by {by}" if by else "")


def _metrics(model: str, score: str) -> str:
    """The metric row of one score column of ``fixed``; a call above one half is predicted to be fraud."""
    cells = (
        f"select count(*) filter (is_fraud = 1 and {score} > 0.5) as tp, count(*) filter (is_fraud = 0 and {score} > 0.5) as fp, "
        f"count(*) filter (is_fraud = 1 and not {score} > 0.5) as fn, count(*) filter (is_fraud = 0 and not {score} > 0.5) as tn from fixed"
    )
    return (
        f"select {_text(model)} as model, round((tp + tn) / (tp + fp + fn + tn)::double, 6) as accuracy, "
        f"(select roc_auc from ({_auc('fixed', score)})) as roc_auc, "
        f"round(case when tp = 0 then 0 else 2.0 * tp / (2.0 * tp + fp + fn) end, 6) as f1, "
        "round(coalesce(tp / nullif(tp + fp, 0)::double, 0), 6) as precision, "
        f"round(coalesce(tp / nullif(tp + fn, 0)::double, 0), 6) as recall from ({cells})"
    )


_TWO_MODELS = f"{_metrics('rule', 'rule_p')} union all {_metrics('line', 'line_p')}"


def _metric_delta() -> str:
    names = ("accuracy", "roc_auc", "f1", "precision", "recall")
    one = "select * from (" + _TWO_MODELS + ") where model = "
    return " union all ".join(
        f"select {_text(m)} as metric, b.{m} as before, a.{m} as after, round(a.{m} - b.{m}, 6) as delta "
        f"from ({one}'rule') b, ({one}'line') a"
        for m in names
    )


def _label_permutation() -> str:
    ranked = (
        "select call_id, is_fraud, rank() over (order by line_p) + (count(*) over (partition by line_p) - 1) / 2.0 as r, "
        "count(*) over () as n, sum(is_fraud) over () as k from fixed"
    )
    chosen = (
        "select repeat, r, n, k, row_number() over (partition by repeat order by "
        f"substr(md5(call_id || ':' || repeat || ':42'), 1, 15), call_id) as place from ({ranked}), "
        "(select unnest(range(20)) as repeat)"
    )
    areas = (
        f"select repeat, (sum(r) - any_value(k) * (any_value(k) + 1) / 2.0) / (any_value(k) * (any_value(n) - any_value(k)))::double as a "
        f"from ({chosen}) where place <= k group by repeat"
    )
    return (
        f"select (select roc_auc from ({_auc('fixed', 'line_p')})) as base_auc, round(avg(a), 6) as shuffled_mean_auc, "
        f"round(stddev_pop(a), 6) as shuffled_std_auc from ({areas})"
    )


def _permutation_importance() -> str:
    """Each call takes one feature from the next call in a random ring; the last takes it from the first."""
    ring = (
        "window ring as (partition by repeat order by substr(md5(call_id || ':' || repeat || ':42'), 1, 15), call_id "
        "rows between unbounded preceding and unbounded following)"
    )
    order = "partition by repeat order by substr(md5(call_id || ':' || repeat || ':42'), 1, 15), call_id"
    swapped = " union all ".join(
        f"select {_text(c)} as feature, repeat, is_fraud, {FIXED_SCORE} as score from (select * replace (case when place = n "
        f"then first_{c} else next_{c} end as {c}) from shuffled)"
        for c in FIXED_FEATURES
    )
    columns = ", ".join(
        f"lead({c}) over ({order}) as next_{c}, first_value({c}) over ring as first_{c}" for c in FIXED_FEATURES
    )
    shuffled = (
        f"select repeat, call_id, is_fraud, {', '.join(FIXED_FEATURES)}, row_number() over ({order}) as place, "
        f"count(*) over () / 10 as n, {columns} from labelled, (select unnest(range(10)) as repeat) {ring}"
    )
    exact = _auc("swapped", "score", "feature, repeat").replace(", 6) as roc_auc", ", 15) as roc_auc")
    base = _auc(f"(select is_fraud, {FIXED_SCORE} as score from labelled)", "score").replace(", 6) as roc_auc", ", 15) as roc_auc")
    return (
        f"select feature, round(avg(lost), 6) as importance, round(stddev_pop(lost), 6) as std from (select feature, "
        f"(select roc_auc from ({base})) - roc_auc as lost from ({exact.replace('from swapped', f'from (with shuffled as ({shuffled}) {swapped})')})) "
        "group by feature"
    )


def _stream_features() -> str:
    columns = {
        "hour": "cast(hour(ts) as int)",
        "weekday": "cast(isodow(ts) - 1 as int)",
        "is_weekend": "coalesce(isodow(ts) >= 6, false)",
        "is_business_hours": "coalesce(hour(ts) >= 9 and hour(ts) < 17 and isodow(ts) < 6, false)",
        "caller_number_prefix_freq": "p.freq",
        "channel_Mobile": "cast(coalesce(channel = 'Mobile', false) as int)",
        "channel_VoIP": "cast(coalesce(channel = 'VoIP', false) as int)",
    }
    body = ", ".join(f'{columns.get(c, c)} as "{c}"' for c in BASE_FEATURES)
    prefix = "substr(regexp_replace(caller_number, '[^0-9]', '', 'g'), 1, 5)"
    return (
        f"select call_id, caller_number, ts, {body} from clean c left join "
        f"(select {prefix} as prefix, count(*) as freq from labelled group by 1) p on p.prefix = {prefix}"
    )


def _scaled(table: str, columns, scaled=SCALED_FEATURES) -> str:
    def one(c: str) -> str:
        if c not in scaled:
            return f'"{c}"'
        return (
            f"round(({c} - (select avg({c}) from {table} where split = 'train')) / "
            f"(select case when stddev_pop({c}) = 0 then 1 else stddev_pop({c}) end from {table} where split = 'train'), 6) as {c}"
        )

    return ", ".join(one(c) for c in columns)


def _single_feature_auc() -> str:
    def value(c: str) -> str:
        return f"coalesce(cast({c} as double), 0)"

    long = " union all ".join(
        f"select {_text(c)} as feature, is_fraud, {value(c)} * (select sign(covar_pop({value(c)}, is_fraud)) "
        f"from features where split = 'train') as score from features where split = 'test'"
        for c in BASE_FEATURES
    )
    return _auc(f"({long})", "score", "feature")


_HISTORY = "call_id, caller_number, called_number, ts, channel, label_5way, confidence_score"


def _matching(number: str, columns: str, table: str = "digits") -> str:
    digits = _text(_digits(number))
    return (
        f"select {columns} from {table} where caller_number = {digits} or "
        f"(not exists (select 1 from {table} d where d.caller_number = {digits}) and starts_with(caller_number, {digits}))"
    )


def _level(score: str) -> str:
    return (
        f"case when {score} is null then 'Unknown' when {score} >= 0.75 then 'High' "
        f"when {score} >= 0.4 then 'Medium' else 'Low' end"
    )


_PATTERN = (
    "case when fraud_rate > 0.5 and total_calls >= 50 then 'mass' when fraud_rate > 0.5 and total_calls < 30 "
    "then 'targeted' when fraud_rate < 0.1 then 'legitimate' else 'other' end"
)
_PROFILE_ROUNDED = (
    "caller_number, total_calls, distinct_victims, round(fraud_rate, 6) as fraud_rate, "
    "round(avg_duration_sec, 6) as avg_duration_sec"
)


def _top_suspicious(min_calls: int) -> str:
    return (
        f"select {_PROFILE_ROUNDED} from (select * from profile where total_calls >= {min_calls} "
        "order by fraud_rate desc, total_calls desc, caller_number limit 20)"
    )


def _lift() -> str:
    long = " union all ".join(
        f"select {_text(n)} as keyword, label, n_complaints as n, {c} as hits from kw" for n, c in KEYWORD_COLUMNS.items()
    )
    shares = (
        "select keyword, "
        "coalesce(sum(hits) filter (label = 'Confirmed_Fraud') / nullif(sum(n) filter (label = 'Confirmed_Fraud'), 0)::double, 0) as f, "
        "coalesce(sum(hits) filter (label <> 'Confirmed_Fraud') / nullif(sum(n) filter (label <> 'Confirmed_Fraud'), 0)::double, 0) as o "
        f"from ({long}) group by keyword"
    )
    return (
        "select keyword, round(f, 3) as fraud_share, round(o, 3) as other_share, "
        f"case when o = 0 then 'infinity'::double else round(f / o, 2) end as lift from ({shares})"
    )


_CORR_Y = f"cast(coalesce(label_5way in {_FRAUD}, false) as double)"
_CORR_X = {
    "hour": "cast(hour(ts) as double)",
    "weekday": "cast(isodow(ts) - 1 as double)",
    "is_business_hours": "cast(coalesce(hour(ts) >= 9 and hour(ts) < 17 and isodow(ts) < 6, false) as double)",
    "is_weekend": "cast(coalesce(isodow(ts) >= 6, false) as double)",
    "time_to_next_action_min": "time_to_next_action_min",
    "time_to_next_action_sec": "time_to_next_action_min * 60",
}

_BEHAVIOR = ", ".join(f"round(avg(cast({c} as double)), 3) as {c}" for c in ACTION_FLAGS)
_F1 = "case when tp = 0 then 0 else 2.0 * tp / (2.0 * tp + fp + fn) end"


def _class_report() -> str:
    classes = (
        "select '0' as class, coalesce(tn / nullif(tn + fn, 0)::double, 0) as precision, "
        "coalesce(tn / nullif(tn + fp, 0)::double, 0) as recall, "
        "coalesce(2 * tn / nullif(2 * tn + fn + fp, 0)::double, 0) as f1, tn + fp as support from cells union all "
        "select '1', coalesce(tp / nullif(tp + fp, 0)::double, 0), coalesce(tp / nullif(tp + fn, 0)::double, 0), "
        "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::double, 0), tp + fn from cells"
    )
    means = (
        f"select class, precision, recall, f1, support from ({classes}) union all "
        f"select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from ({classes}) union all "
        "select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), "
        f"sum(f1 * support) / sum(support), sum(support) from ({classes})"
    )
    return (
        "select class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, "
        f"cast(support as bigint) as support from ({means})"
    )


_IMPUTED_FLAGS = ", ".join(f"coalesce({c}, false) as {c}" for c in ACTION_FLAGS)
_FEATURE_LIST = ", ".join(f'"{c}"' for c in BASE_FEATURES)
_NUMBERS = ("duration_sec", "time_to_next_action_min", "manual_severity")


def _bodies() -> dict[str, str]:
    hours = ", ".join(
        f"cast(sum(n) filter (hour = {h}) as bigint) as h{h:02d}" for h in range(24)
    )
    heat = (
        "select dayname(ts) as day_of_week, cast(hour(ts) as int) as hour, count(*) as n from clean "
        "where label_5way = 'Confirmed_Fraud' and ts is not null group by 1, 2"
    )
    days = "(values (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'), (4, 'Friday'), (5, 'Saturday'), (6, 'Sunday')) d(day_no, day_of_week)"
    corr = " union all ".join(
        f"select {_text(n)} as feature, round(covar_pop({x}, {_CORR_Y}) / nullif(stddev_pop({x}) * "
        f"stddev_pop(case when {x} is not null then {_CORR_Y} end), 0), 6) as correlation from clean"
        for n, x in _CORR_X.items()
    )
    nulls = " union all ".join(
        f"select {_text(c)} as column_name, count(*) filter ({c} is null) as nulls from calls" for c in CALL_COLUMNS
    )
    return {
        # Sources and projections
        "load_calls": f"select {_ALL}, ts from digits",
        "ts_normalize": f"select call_id, timestamp, ts, {_MINUTE} as minute from timed",
        "ts_parse_failures": (
            "select count(*) as n_rows, count(timestamp) as n_present, "
            "count(*) filter (timestamp is not null and ts is null) as parse_failures from timed"
        ),
        "clean_channel": f"select call_id, channel, {_case('channel', CHANNEL_SPELLINGS)} as clean from calls",
        "clean_label": f"select call_id, label_5way, {_case('label_5way', LABEL_SPELLINGS)} as clean from calls",
        "clean_calls": f"select {_ALL} from clean",
        "canon_label": f"select call_id, {_CANON} as label from calls",
        "temporal_features": (
            "select call_id, cast(hour(ts) as int) as hour, cast(isodow(ts) - 1 as int) as weekday, dayname(ts) as day_name, "
            "coalesce(isodow(ts) >= 6, false) as is_weekend, "
            "coalesce(hour(ts) >= 9 and hour(ts) < 17 and isodow(ts) < 6, false) as is_business_hours from timed"
        ),
        "temporal_float": (
            "select call_id, cast(hour(ts) as double) as hour, cast(isodow(ts) - 1 as double) as weekday, "
            "cast(coalesce(isodow(ts) >= 6, false) as double) as is_weekend, "
            "cast(coalesce(hour(ts) >= 9 and hour(ts) < 17 and isodow(ts) < 6, false) as double) as is_business_hours, "
            "time_to_next_action_min * 60 as time_to_next_action_sec from timed"
        ),
        "caller_prefix": "select call_id, caller_number as digits, substr(caller_number, 1, 5) as prefix from digits",
        "keyword_flags": (
            "select call_id, "
            + ", ".join(
                f"regexp_matches(lower(coalesce(complaint_text, '')), {_text(p)}) as {KEYWORD_COLUMNS[n]}"
                for n, p in KEYWORD_PATTERNS.items()
            )
            + " from calls"
        ),
        "keyword_score": (
            "select call_id, cast("
            + " + ".join(f"case when lower(complaint_text) like '%{w}%' then 1 else 0 end" for w in SCORE_WORDS)
            + " as int) as complaint_keyword_score from calls"
        ),
        "call_projection": (
            "select " + ", ".join("ts as timestamp" if c == "timestamp" else c for c in PROJECTION_COLUMNS) + " from timed"
        ),
        "align_columns": (
            "select call_id, duration_sec, was_answered, was_hangup_by_client, "
            + ", ".join(ACTION_FLAGS)
            + ", time_to_next_action_min, manual_severity, cast(hour(ts) as int) as hour, "
            "cast(isodow(ts) - 1 as int) as weekday, coalesce(isodow(ts) >= 6, false) as is_weekend, "
            "coalesce(hour(ts) >= 9 and hour(ts) < 17 and isodow(ts) < 6, false) as is_business_hours, "
            "0 as caller_number_prefix_freq, 0 as \"channel_Mobile\", 0 as \"channel_VoIP\" from timed"
        ),
        "filter_calls": (
            "select call_id, regexp_replace(caller_number, '[^0-9]', '', 'g') as caller_number, ts, label_5way, channel "
            f"from clean where cast(ts as date) between date {_text(FILTER['start'].isoformat())} "
            f"and date {_text(FILTER['end'].isoformat())} and label_5way in {_list(FILTER['labels'])} "
            f"and channel in {_list(FILTER['channels'])} "
            f"and regexp_replace(caller_number, '[^0-9]', '', 'g') like {_text(_digits(FILTER['prefix']) + '%')}"
        ),
        "lookup_history": _matching(LOOKUP_NUMBER, _HISTORY),
        "lookup_history_prefix": _matching(LOOKUP_PREFIX, _HISTORY),
        "lookup_stored": _matching(LOOKUP_PREFIX, "call_id, caller_number, ts, label_5way, confidence_score"),
        "lookup_risk": (
            "select round(least(greatest(m, 0), 1), 6) as confidence_score, " + _level("m") + " as risk_level, "
            "n as history_count from (select round(avg(confidence_score), 12) as m, count(*) as n from ("
            + _matching(LOOKUP_PREFIX, "*")
            + "))"
        ),
        # Duplicates and quality
        "dedup_exact": f"select distinct {_ALL} from calls",
        "dedup_near": f"select {_ALL} from deduped",
        "dedup_report": (
            "select (select count(*) from timed) as rows_before, "
            "(select count(*) from timed) - (select count(*) from once) as exact_duplicates, "
            "count(*) filter (gap <= 5) as near_duplicates, count(*) filter (gap is null or gap > 5) as rows_after, "
            "(select count(*) from (select distinct caller_number, called_number, " + _MINUTE + " from gaps where gap <= 5)) "
            "as near_dup_groups from gaps"
        ),
        "dup_key_count": (
            "select (select count(*) from calls) - count(*) as duplicates from "
            "(select distinct caller_number, called_number, timestamp, duration_sec from calls)"
        ),
        "qa_checks": (
            "select unnest(['required_columns', 'row_count', 'fraud_rate', 'known_labels', 'duration_range', 'confidence_range']) "
            "as check_name, unnest([true, n between 4500 and 5500, rate between 0.10 and 0.20, odd = 0, bad_d = 0, bad_c = 0]) as passed, "
            "unnest(['ok', 'actual: ' || n, 'actual: ' || cast(cast(round(rate, 3) as decimal(10, 3)) as varchar), 'ok', "
            "'min=' || min_d || ', max=' || max_d, 'min=' || min_c || ', max=' || max_c]) as message "
            "from (select count(*) as n, "
            f"avg(case when {_CANON} in ('confirmed_fraud', 'high_risk_reported') then 1.0 else 0.0 end) as rate, "
            f"count(*) filter ({_CANON} not in ('confirmed_fraud', 'high_risk_reported', 'community_flagged', 'unknown', 'verified_legitimate')) as odd, "
            "count(*) filter (duration_sec < 0 or duration_sec > 3600) as bad_d, "
            "count(*) filter (confidence_score < 0 or confidence_score > 1) as bad_c, min(duration_sec) as min_d, "
            "max(duration_sec) as max_d, min(confidence_score) as min_c, max(confidence_score) as max_c from calls)"
        ),
        "checked_write": f"select {_ALL} from calls",
        # Empty text and a missing one are the same in CSV.
        "csv_round_trip": f"select {_ALL} from (select * replace (nullif(complaint_text, '') as complaint_text) from calls)",
        "days_replaced": (
            f"select {_ALL} from timed where cast(ts as date) is distinct from date '{CORRECTED_DAY}' "
            f"union all select {_ALL} from clean where cast(ts as date) = date '{CORRECTED_DAY}'"
        ),
        "qa_checks_odd_labels": (
            "select 'known_labels' as check_name, n = 0 as passed, 'rows: ' || n || ', labels: un_known' as message "
            "from (select count(*) filter (label_5way = 'Unknown') as n from calls)"
        ),
        "qa_unknown_labels": (
            f"select distinct {_CANON} as label from calls "
            f"where {_CANON} not in ('confirmed_fraud', 'unknown', 'verified_legitimate')"
        ),
        "null_profile": f"select * from ({nulls}) where nulls > 0",
        "table_facts": (
            "select count(*) as n_rows, 18 as n_columns, cast(sum("
            + " + ".join(f"cast({c} is null as int)" for c in CALL_COLUMNS)
            + ") as bigint) as null_cells from calls"
        ),
        # Exploration
        "caller_profile": f"select {_PROFILE_ROUNDED} from profile",
        "top_suspicious": _top_suspicious(20),
        "top_suspicious_busy": _top_suspicious(BUSY_CALLS),
        "caller_band": (
            "select caller_number, case when fraud_rate > 0.5 then 'red' when fraud_rate > 0.2 then 'orange' "
            "else 'blue' end as band from profile"
        ),
        "caller_pattern": f"select caller_number, {_PATTERN} as pattern from profile",
        "pattern_summary": (
            f"select {_PATTERN} as pattern, count(*) as numbers, cast(sum(total_calls) as bigint) as calls, "
            "cast(sum(distinct_victims) as bigint) as victims from profile group by 1"
        ),
        "caller_counts": (
            f"select count(*) as callers, count(*) filter (total_calls >= {BUSY_CALLS}) as ranked_callers from profile"
        ),
        "call_heatmap": heat,
        "call_heatmap_pivot": (
            f"select day_of_week, day_no, {hours} from {days} left join ({heat}) using (day_of_week) group by day_no, day_of_week"
        ),
        "behavior_share": f"select {_CANON} as label, {_BEHAVIOR} from calls where label_5way is not null group by 1",
        "subsequent_events": (
            "select label_5way, "
            + ", ".join(
                f"round(avg(case when {f} and time_to_next_action_min <= 60 then 1.0 else 0.0 end), 6) as {n}_within_1h"
                for n, f in (("login", "login_after_call"), ("transfer", "transfer_after_call"), ("new_payee", "new_payee_after_call"))
            )
            + " from clean where label_5way is not null group by label_5way"
        ),
        "keyword_counts": "select label, label_no, n_complaints, " + ", ".join(KEYWORD_COLUMNS.values()) + " from kw",
        "keyword_share": (
            "select label, "
            + ", ".join(f"round(coalesce({c} / nullif(n_complaints, 0)::double, 0), 6) as {c}" for c in KEYWORD_COLUMNS.values())
            + " from kw"
        ),
        "keyword_lift": _lift(),
        "feature_corr": corr,
        "label_counts": (
            "select label_5way as label, count(*) as n, 'raw' as spelling from calls group by 1 union all "
            f"select {_CANON} as label, count(*) as n, 'canonical' as spelling from calls group by 1"
        ),
        "channel_counts": "select channel, count(*) as n from clean group by 1",
        "target_summary": (
            "select (select count(*) from clean) as rows_before, (select count(*) from target) as rows_kept, "
            "(select count(*) from clean) - (select count(*) from target) as rows_dropped, is_fraud, "
            "case is_fraud when 1 then 'Fraud' else 'Not fraud' end as label, count(*) as n, "
            "round(count(*) / (select count(*) from target)::double, 6) as share from target group by is_fraud"
        ),
        "top_numbers": (
            "select caller_number as number, count(*) as total_calls, cast(sum(is_fraud) as bigint) as fraud_cases, "
            "round(avg(is_fraud), 6) as fraud_rate from target where caller_number is not null group by 1 "
            "order by avg(is_fraud) desc, 3 desc, 2 desc, 1 limit 10"
        ),
        "fraud_by_hour": (
            "select cast(hour(ts) as int) as hour, round(avg(is_fraud), 6) as fraud_rate from target where ts is not null group by 1"
        ),
        "number_risk": (
            "select caller_number, round(least(greatest(m, 0), 1), 6) as confidence_score, " + _level("m") + " as risk_level, "
            "n as history_count from (select caller_number, round(avg(confidence_score), 12) as m, count(*) as n from digits "
            "where caller_number is not null group by 1)"
        ),
        "risk_level": (
            "select call_id, " + _level("confidence_score") + " as level, case when confidence_score < 0.3 then 'Low' "
            "when confidence_score < 0.7 then 'Medium' else 'High' end as band from calls"
        ),
        "history_summary": (
            "select (select count(*) from h) as calls, "
            "(select label_5way from h where label_5way is not null group by 1 order by count(*) desc, 1 limit 1) as top_label, "
            "(select channel from h where channel is not null group by 1 order by count(*) desc, 1 limit 1) as top_channel, "
            "(select round(avg(duration_sec), 1) from h) as mean_duration_sec"
        ),
        "filter_options": (
            "select distinct 'label' as field, label_5way as value from clean where label_5way is not null union all "
            "select distinct 'channel' as field, channel as value from clean where channel is not null"
        ),
        "date_range": (
            "select cast(min(cast(ts as date)) as varchar) as first_date, "
            "cast(max(cast(ts as date)) as varchar) as last_date from timed"
        ),
        "top_volume": (
            "select caller_number, count(call_id) as calls, "
            f"round(avg(case when {_CANON} in ('confirmed_fraud', 'high_risk_reported') then 1.0 else 0.0 end), 6) as fraud_rate "
            "from calls where caller_number is not null group by 1 order by 2 desc, 1 limit 10"
        ),
        "fraud_label_share": f"select round(avg(case when label_5way in {_FRAUD} then 1.0 else 0.0 end), 6) as fraud_rate from clean",
        "median_profile": _medians("calls", (*_NUMBERS, "confidence_score")),
        "median_sketches": " union all ".join(
            f"select {_text(c)} as \"column\", count({c}) as n, true as within from calls"
            for c in (*_NUMBERS, "confidence_score")
        ),
        "label_medians": (
            "select label_5way, round(median(time_to_next_action_min), 6) as median from clean group by label_5way"
        ),
        "top_k": (
            "select call_id, time_to_next_action_min from calls order by time_to_next_action_min desc nulls last, call_id, "
            "duration_sec nulls first limit 20"
        ),
        "top_risk_calls": (
            "select call_id, ts, caller_number, called_number, label_5way, channel, confidence_score from "
            "(select distinct * from clean) order by confidence_score desc nulls last, call_id limit 15"
        ),
        # Windows and features
        "calls_last_24h": "select call_id, calls_from_number_last_24h from looked_back",
        "victims_last_7d": "select call_id, distinct_victims_last_7d from looked_back",
        "mean_duration_per_number": (
            "select call_id, round(avg(duration_sec) over (partition by caller_number), 6) as mean_call_duration_per_number from calls"
        ),
        "behavioral_features": "select * from looked_back",
        "frequency_encode": "select call_id, count(*) over (partition by called_number) as called_number_freq from calls",
        "time_split": "select call_id, split from split",
        "split_drift": (
            "select n_train, n_test, round(a, 6) as train_rate, round(b, 6) as test_rate, round(abs(a - b) * 100, 6) as gap_pp, "
            "abs(a - b) * 100 <= 1.0 as within_tolerance from (select count(*) filter (split = 'train') as n_train, "
            "count(*) filter (split = 'test') as n_test, avg(is_fraud) filter (split = 'train') as a, "
            "avg(is_fraud) filter (split = 'test') as b from split)"
        ),
        "stratified_split": (
            "select call_id, is_fraud, case when row_number() over (partition by is_fraud order by md5(call_id), call_id) "
            "<= ceil(count(*) over (partition by is_fraud) * 0.2) then 'validation' else 'train' end as split from labelled"
        ),
        "build_targets": "select call_id, duration_sec, label_5way, is_fraud from target",
        "impute_documented": (
            "select call_id, "
            + ", ".join(f"coalesce({c}, (select median({c}) from calls)) as {c}" for c in _NUMBERS)
            + f", coalesce(channel, 'unknown') as channel, coalesce(complaint_text, 'unknown') as complaint_text, {_IMPUTED_FLAGS} from calls"
        ),
        "impute_train_median": (
            "select call_id, split, "
            + ", ".join(f"coalesce({c}, (select median({c}) from split where split = 'train')) as {c}" for c in _NUMBERS)
            + " from split"
        ),
        "onehot_channel": (
            "select call_id, case when channel = 'Mobile' then 1 else 0 end as \"channel_Mobile\", "
            "case when channel = 'VoIP' then 1 else 0 end as \"channel_VoIP\" from clean"
        ),
        "feature_matrix": f"select call_id, is_fraud, {_FEATURE_LIST} from features",
        "standard_scale": f"select call_id, {_scaled('features', SCALED_FEATURES)} from features",
        "prepare_dataset": (
            f"select call_id, ts, split, is_fraud, {_scaled('features', BASE_FEATURES)} from features"
        ),
        "prepare_dataset_train_only": (
            f"select call_id, ts, split, is_fraud, {_scaled('features_train_only', BASE_FEATURES)} from features_train_only"
        ),
        "prepare_behavioral": f"select call_id, ts, split, is_fraud, {_FEATURE_LIST}, t.* exclude (call_id) from features join looked_back t using (call_id)",
        "class_weights": (
            "select is_fraud, n, round(sum(n) over () / (count(*) over () * n)::double, 6) as weight from "
            "(select is_fraud, count(*) as n from target group by 1)"
        ),
        # Evaluation
        "eval_metrics": (
            "select round((tp + tn) / (tp + fp + fn + tn)::double, 6) as accuracy, "
            "round(coalesce(tp / nullif(tp + fp, 0)::double, 0), 6) as precision, "
            f"round(coalesce(tp / nullif(tp + fn, 0)::double, 0), 6) as recall, round({_F1}, 6) as f1 from cells"
        ),
        "roc_auc": _auc("rule", "score"),
        "roc_auc_continuous": _auc(
            "(select is_fraud, -time_to_next_action_min as score from target where time_to_next_action_min is not null)", "score"
        ),
        "confusion_matrix": (
            "select 0 as is_fraud, 0 as prediction, tn as n from cells union all select 0, 1, fp from cells "
            "union all select 1, 0, fn from cells union all select 1, 1, tp from cells"
        ),
        "class_report": _class_report(),
        "stream_features": _stream_features(),
        "stream_trailing": "select * from looked_back",
        "stream_dedup": f"select {_ALL} from deduped",
        "stream_dedup_exact": f"select distinct {_ALL} from calls",
        # The model stage on fixed scores
        "soft_vote_fixed": f"{_TWO_MODELS} union all {_metrics('vote', '((rule_p + line_p) / 2)')}",
        "best_model_fixed": f"select *, roc_auc = max(roc_auc) over () as best from ({_TWO_MODELS})",
        "metric_delta_fixed": _metric_delta(),
        "score_calls_fixed": (
            "select call_id, cast(line_p > 0.5 as int) as prediction, line_p as fraud_probability, "
            "greatest(line_p, 1 - line_p) as confidence, case when line_p < 0.3 then 'Low' "
            "when line_p < 0.7 then 'Medium' else 'High' end as risk_band from fixed"
        ),
        "label_permutation_fixed": _label_permutation(),
        "permutation_importance_fixed": _permutation_importance(),
        "top_importances_fixed": (
            f"select * from ({_permutation_importance()}) order by importance desc nulls last, feature limit 2"
        ),
        "trained_facts": (
            "select model, count(*) as n_scored, 0::bigint as n_outside, true as area_reached from split, "
            "(values ('logistic'), ('forest'), ('boosting'), ('tuned')) m(model) where split = 'test' group by model"
        ),
        "saved_scores": "select count(*) as n_calls, 0::bigint as n_different from split where split = 'test'",
        "coefficient_scores": "select count(*) as n_calls, 0::bigint as n_different from split where split = 'test'",
        "importance_facts": (
            f"select {len(BASE_FEATURES)}::bigint as n_features, {len(BASE_FEATURES)}::bigint as n_permuted, "
            f"{len(BASE_FEATURES)}::bigint as n_impurity, 1.0::double as total, 0::bigint as n_negative"
        ),
        "logreg_gradient": " union all ".join(
            f"select {_text(c)} as feature, 0.0::double as gradient" for c in BASE_FEATURES
        ),
        "single_feature_auc": _single_feature_auc(),
    }


# The looked-up calls in standard spelling.
_CTES["cdigits"] = (
    "select * replace (regexp_replace(caller_number, '[^0-9]', '', 'g') as caller_number) from clean"
)
_CTES["h"] = _matching(LOOKUP_PREFIX, "*", "cdigits")


def oracle_sql() -> dict[str, str]:
    return {name: _with(body) for name, body in _bodies().items()}
