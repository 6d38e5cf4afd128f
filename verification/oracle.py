"""SQL twins of the registered queries, for DuckDB.

Written from the definition of each result, by another route where there is one: gaps between raw
visits instead of per-day reductions, window totals instead of joins, closed forms instead of rules.
"""

from __future__ import annotations

from catalog_signals.config import HAS_RESERVICE, KEYWORDS, RECURRING, RESERVICE, SIGNALS, ZERO_TIME
from verification.queries import DRIVER_TABLES
from verification.standin import AS_OF, VIEWS
from verification.standin import KEYWORDS as SHORT_KEYWORDS

FLAGS = ("RESERVICE", "REGULAR_SERVICE", "FREQUENCY", "DEFAULT_LENGTH", "INITIAL_ID", "INITIAL")
API = ", ".join(f"API_{f}" for f in FLAGS)


def _integer(col: str) -> str:
    whole = rf"regexp_replace({col}, '\.0*\s*$', '')"
    return rf"CASE WHEN regexp_matches({col}, '^\s*[+-]?\d+(\.0*)?\s*$') THEN TRY_CAST({whole} AS BIGINT) END"


def _has_word(text: str, words: tuple[str, ...]) -> str:
    hits = " OR ".join(f"contains(lower(coalesce({text}, '')), '{w}')" for w in words)
    return f"CASE WHEN {hits} THEN TRUE END"


def _words(text: str, keywords) -> str:
    return ", ".join(f"{_has_word(text, keywords[s])} AS word_{s}" for s in SIGNALS)


def _pct(part: str, total: str) -> str:
    return (
        f"CASE WHEN {total} > 0 THEN "
        f"round_even(CAST({part} AS DOUBLE) / CAST({total} AS DOUBLE) * 100, 2) END"
    )


def _tf(value: str) -> str:
    return f"CASE WHEN {value} THEN 'True' ELSE 'False' END"


_FLAG_CASTS = ", ".join(f"{_integer(f)} AS API_{f}" for f in FLAGS)

# name -> (needed CTEs, SQL)
_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "service_type_raw": ((), VIEWS["service_type_raw"]),
    "merged_service_type": (("service_type_raw",), VIEWS["merged_service_type"]),
    "recurring_lookup": ((), VIEWS["recurring_lookup"]),
    "appointments": ((), VIEWS["appointments"]),
    "subscriptions": ((), VIEWS["subscriptions"]),
    "typed_raw": (
        ("service_type_raw",),
        f"SELECT CLIENT AS clientId, CAST(TYPE_ID AS BIGINT) AS TYPE_ID, DESCRIPTION, {_FLAG_CASTS}, "
        "DATE_LOADED FROM service_type_raw WHERE CLIENT IS NOT NULL",
    ),
    "types": (
        ("typed_raw",),
        "SELECT * EXCLUDE (DATE_LOADED) FROM typed_raw "
        "QUALIFY row_number() OVER (PARTITION BY clientId, TYPE_ID ORDER BY DATE_LOADED DESC) = 1",
    ),
    "rolled": (
        ("typed_raw",),
        """
        SELECT *, clientId AS sourceClient FROM typed_raw
        UNION ALL
        SELECT * REPLACE ('COMPACT' AS clientId), clientId AS sourceClient
        FROM typed_raw WHERE clientId IN ('SMALL', 'MEDIUM')
        """,
    ),
    "rolled_versions": (
        ("rolled",),
        "SELECT * FROM rolled QUALIFY row_number() OVER "
        "(PARTITION BY clientId, sourceClient, TYPE_ID ORDER BY DATE_LOADED DESC) = 1",
    ),
    "visits": (
        ("appointments",),
        f"SELECT clientID AS clientId, {_integer('type')} AS TYPE_ID, individualAccountID AS accountId, "
        "try_strptime(appointmentDate, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%m/%d/%Y', '%Y%m%d', '%b %d, %Y']) "
        "AS visitDate FROM appointments",
    ),
    "subs": (
        ("subscriptions",),
        rf"""
        SELECT clientId, subscriptionId, TYPE_ID, amountText, isActive,
               CASE WHEN regexp_matches(t, '^\(.*\)$') THEN -abs(num) ELSE num END AS amount
        FROM (
            SELECT *, CASE WHEN regexp_matches(d, '^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$')
                           THEN CASE WHEN isfinite(TRY_CAST(d AS DOUBLE)) THEN TRY_CAST(d AS DOUBLE) END END AS num
            FROM (
                SELECT *, regexp_replace(t, '[()]', '', 'g') AS d
                FROM (
                    SELECT clientID AS clientId, subscriptionID AS subscriptionId,
                           {_integer('serviceID')} AS TYPE_ID, annualRecurringServices AS amountText,
                           active IS NOT DISTINCT FROM TRUE AND dateCancelled IS NULL AS isActive,
                           regexp_replace(
                               regexp_replace(annualRecurringServices, '^\s+|\s+$', '', 'g'),
                               '[,$]', '', 'g') AS t
                    FROM subscriptions
                ) a
            ) b
        ) c
        """,
    ),
    "lookup_one": (
        ("recurring_lookup",),
        "SELECT clientId, serviceType, list(isRecurring ORDER BY upper(trim(isRecurring)) IN ('TRUE', 'FALSE') "
        "DESC NULLS LAST, isRecurring DESC NULLS LAST)[1] AS isRecurring FROM recurring_lookup GROUP BY ALL",
    ),
    "attached": (
        ("types", "lookup_one"),
        "SELECT t.*, l.isRecurring FROM types t LEFT JOIN lookup_one l "
        "ON t.clientId = l.clientId AND t.DESCRIPTION IS NOT DISTINCT FROM l.serviceType",
    ),
    "fanned": (
        ("types", "recurring_lookup"),
        "SELECT t.*, l.isRecurring FROM types t LEFT JOIN recurring_lookup l "
        "ON t.clientId = l.clientId AND t.DESCRIPTION IS NOT DISTINCT FROM l.serviceType",
    ),
    "gaps": (
        ("visits",),
        """
        SELECT *, date_sub('day', lag(visitDate) OVER (
                   PARTITION BY clientId, TYPE_ID, accountId ORDER BY visitDate), visitDate) AS gap
        FROM visits
        WHERE TYPE_ID IS NOT NULL AND accountId IS NOT NULL AND visitDate IS NOT NULL
        """,
    ),
    "accounts": (
        ("gaps",),
        """
        SELECT *, consecutive OR (visits >= 3 AND in_band) AS strong
        FROM (
            SELECT *, len(list_intersect(seen, list_transform(seen, lambda y: y + 1))) > 0 AS consecutive,
                   coalesce((median_days >= 20 AND median_days < 150)
                            OR (median_days >= 300 AND median_days < 420), FALSE) AS in_band
            FROM (
                SELECT clientId, TYPE_ID, accountId, count(*) AS visits,
                       count(DISTINCT year(visitDate)) AS years,
                       list(DISTINCT year(visitDate)) AS seen,
                       CAST(median(gap) AS DOUBLE) AS median_days
                FROM gaps GROUP BY ALL
            ) a
        ) b
        """,
    ),
    "scores": (
        ("accounts",),
        """
        SELECT clientId, TYPE_ID, count(*) AS total_accounts,
               count(*) FILTER (WHERE strong) AS strong_accounts
        FROM accounts GROUP BY ALL
        """,
    ),
    "type_visits": (
        ("visits",),
        f"""
        SELECT clientId, TYPE_ID, count(*) AS n, count(visitDate) AS dated,
               coalesce(max(visitDate) >= TIMESTAMP '{AS_OF}' - INTERVAL 2 YEARS, FALSE) AS recent
        FROM visits GROUP BY ALL
        """,
    ),
    "volume": (
        ("type_visits",),
        f"""
        SELECT clientId, TYPE_ID, n, {_pct('n', 'sum(n) OVER (PARTITION BY clientId)')} AS share_pct,
               row_number() OVER (PARTITION BY clientId ORDER BY n DESC, TYPE_ID) AS rank
        FROM type_visits WHERE TYPE_ID IS NOT NULL
        """,
    ),
    "active_types": (
        ("subs",),
        "SELECT DISTINCT clientId, TYPE_ID, TRUE AS active FROM subs WHERE isActive AND TYPE_ID IS NOT NULL",
    ),
    "revenue": (
        ("subs",),
        f"""
        SELECT clientId, TYPE_ID, CAST(revenue AS DOUBLE) AS revenue,
               {_pct('revenue', 'total')} AS share_pct,
               row_number() OVER (PARTITION BY clientId ORDER BY revenue DESC, TYPE_ID) AS rank
        FROM (
            SELECT *, sum(revenue) OVER (PARTITION BY clientId) AS total
            FROM (
                SELECT clientId, TYPE_ID, sum(TRY_CAST(amount AS DECIMAL(28, 6))) AS revenue
                FROM subs WHERE isActive AND TYPE_ID IS NOT NULL AND amount IS NOT NULL GROUP BY ALL
            ) a
        ) b
        WHERE total > 0 AND revenue IS NOT NULL
        """,
    ),
    "client_visits": (("visits",), "SELECT clientId, count(*) AS client_n FROM visits GROUP BY ALL"),
}


def _rows_cte(source: str) -> str:
    """Signals, usage and finals for every row of ``source``, by the closed forms."""
    percent = "CAST(CAST(round_even(ratio * 100, 0) AS BIGINT) AS VARCHAR)"
    return f"""
    SELECT *,
        coalesce(mapping_value, appt_bool, flagged_recurring) AS final_recurring,
        flagged_reservice AND NOT coalesce(mapping_value, appt_bool, flagged_recurring) AS final_reservice,
        coalesce(word_zero_time, flagged_zero_time) AS final_zero_time,
        coalesce(mapping_value, appt_bool, flagged_recurring)
            AND NOT coalesce(word_zero_time, flagged_zero_time) AS final_has_reservice
    FROM (
        SELECT *,
            CASE WHEN missing IS NOT NULL THEN NULL WHEN ratio >= 0.6 THEN TRUE END AS appt_bool,
            CAST(CASE WHEN missing IS NOT NULL THEN 0.0 WHEN ratio >= 0.6 AND active THEN 1.0
                 WHEN ratio >= 0.6 THEN 0.7 WHEN strong_accounts > 0 THEN 0.5 ELSE 0.0 END AS DOUBLE)
                AS appt_score,
            coalesce(missing, CAST(strong_accounts AS VARCHAR) || '/' || CAST(total_accounts AS VARCHAR)
                || ' accounts strong (' || {percent} || '%)'
                || CASE WHEN active THEN '; active subscription present' ELSE '' END
                || CASE WHEN ratio >= 0.6 AND active
                             THEN '; meets strong ratio threshold with active subscription'
                        WHEN ratio >= 0.6 THEN '; meets strong ratio threshold'
                        WHEN strong_accounts > 0 THEN '; some accounts show recurring, below threshold'
                        ELSE '; no recurring evidence' END) AS appt_reason
        FROM (
            SELECT b.*,
                API_FREQUENCY > 0 AND API_RESERVICE <> 1 AND API_INITIAL <> 1 AS flagged_recurring,
                API_RESERVICE = 1 AND API_INITIAL <> 1 AS flagged_reservice,
                API_DEFAULT_LENGTH = 0 AND API_INITIAL <> 1 AS flagged_zero_time,
                FALSE AS flagged_has_reservice,
                {_words('b.DESCRIPTION', SHORT_KEYWORDS)},
                CASE WHEN mapping IN ('TRUE', 'FALSE') THEN mapping = 'TRUE' END AS mapping_value,
                CASE WHEN mapping IN ('TRUE', 'FALSE') THEN 'SalesMapping=' || mapping END AS mapping_reason,
                coalesce(v.recent, FALSE) AS recent, coalesce(a.active, FALSE) AS active,
                coalesce(s.total_accounts, 0) AS total_accounts,
                coalesce(s.strong_accounts, 0) AS strong_accounts,
                CASE WHEN s.total_accounts > 0
                     THEN CAST(s.strong_accounts AS DOUBLE) / s.total_accounts ELSE 0.0 END AS ratio,
                CASE WHEN c.client_n IS NULL THEN 'No appointments for client'
                     WHEN v.n IS NULL THEN 'No appointments for this service type'
                     WHEN v.dated = 0 THEN 'No valid appointment dates' END AS missing
            FROM (
                SELECT * REPLACE ({', '.join(f'coalesce(API_{f}, 0) AS API_{f}' for f in FLAGS)}),
                    upper(regexp_replace(isRecurring, '^\\s+|\\s+$', '', 'g')) AS mapping,
                    DESCRIPTION IS NOT NULL
                        AND count(*) OVER (PARTITION BY clientId, DESCRIPTION) > 1 AS repeated_name
                FROM {source}
            ) b
            LEFT JOIN type_visits v ON v.clientId = b.clientId AND v.TYPE_ID = b.TYPE_ID
            LEFT JOIN active_types a ON a.clientId = b.clientId AND a.TYPE_ID = b.TYPE_ID
            LEFT JOIN scores s ON s.clientId = b.clientId AND s.TYPE_ID = b.TYPE_ID
            LEFT JOIN client_visits c ON c.clientId = b.clientId
        ) d
    ) e
    """


_USED = ("type_visits", "active_types", "scores", "client_visits")
_CTES["rows"] = (("attached", *_USED), _rows_cte("attached"))
_CTES["rows_fanned"] = (("fanned", *_USED), _rows_cte("fanned"))

# metric -> (name in reasons, [(source, value, reason)]), strongest source first
_METRICS = {
    RECURRING: (
        "isRecurring",
        [
            ("SalesMapping", "mapping_value", "mapping_reason"),
            ("Appointments", "appt_bool", "appt_reason"),
            (
                "API",
                "flagged_recurring",
                "'API derived from flags: freq=' || API_FREQUENCY || ', reservice=' || API_RESERVICE "
                "|| ', initial=' || API_INITIAL",
            ),
            ("Word", "word_recurring", "'Word keywords'"),
        ],
    ),
    RESERVICE: (
        "isRervice",
        [
            ("API", "flagged_reservice", "'API RESERVICE rule'"),
            ("Word", "word_reservice", "'Word keywords'"),
        ],
    ),
    ZERO_TIME: (
        "zeroVisitTime",
        [
            ("Word", "word_zero_time", "'Word keywords'"),
            ("API", "flagged_zero_time", "'API DEFAULT_LENGTH rule'"),
        ],
    ),
}


def _evidence_list(metric: str) -> str:
    items = ", ".join(
        f"{{'s': '{s}', 'v': {v}, 'why': {why}}}" for s, v, why in _METRICS[metric][1]
    )
    return f"list_filter([{items}], lambda x: x.v IS NOT NULL)"


def _top_two(name: str) -> str:
    return (
        f"CASE WHEN len(e) >= 2 AND e[1].v <> e[2].v THEN {name} || ': ' || e[1].s || '=' || {_tf('e[1].v')} "
        f"|| ' vs ' || e[2].s || '=' || {_tf('e[2].v')} END"
    )


def _top_vs_rest(name: str) -> str:
    return (
        "CASE WHEN len(e) > 1 AND len(list_filter(e[2:], lambda x: x.v = e[1].v)) = 0 THEN "
        f"{name} || ': ' || e[1].s || '=' || {_tf('e[1].v')} || ' vs others=[''' || array_to_string("
        f"list_transform(e[2:], lambda x: x.s || '=' || {_tf('x.v')}), ''', ''') || ''']' END"
    )


def _per_metric(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT clientId, TYPE_ID, '{name}' AS metric, {_evidence_list(m)} AS e FROM {source}"
        for m, (name, _) in _METRICS.items()
    )


_CTES["evidence"] = (("rows",), _per_metric("rows"))


def _conflict(metric: str) -> str:
    name = f"'{_METRICS[metric][0]}'"
    return f"concat_ws('; ', {_top_two(name)}, {_top_vs_rest(name)})".replace("e[", f"e_{metric}[").replace(
        "len(e)", f"len(e_{metric})"
    )


_IMPORTANT = """
    CASE WHEN vt.rank IS NOT NULL THEN 'high priority service' ELSE '' END AS volume_reason,
    CASE WHEN rt.rank IS NOT NULL THEN 'high revenue service' ELSE '' END AS revenue_reason,
    vo.share_pct AS volume_share, re.share_pct AS revenue_share
"""
_IMPORTANT_JOINS = """
    LEFT JOIN volume vo ON vo.clientId = r.clientId AND vo.TYPE_ID = r.TYPE_ID
    LEFT JOIN volume vt ON vt.clientId = r.clientId AND vt.TYPE_ID = r.TYPE_ID AND vt.rank <= 20
    LEFT JOIN revenue re ON re.clientId = r.clientId AND re.TYPE_ID = r.TYPE_ID
    LEFT JOIN revenue rt ON rt.clientId = r.clientId AND rt.TYPE_ID = r.TYPE_ID AND rt.rank <= 10
"""
_NOTHING_IMPORTANT = (
    "'' AS volume_reason, '' AS revenue_reason, CAST(NULL AS DOUBLE) AS volume_share, "
    "CAST(NULL AS DOUBLE) AS revenue_share"
)


def _asked_cte(source: str, important: str, joins: str) -> str:
    lists = ", ".join(f"{_evidence_list(m)} AS e_{m}" for m in _METRICS)
    conflicts = ", ".join(f"{_conflict(m)} AS conflict_{m}" for m in _METRICS)
    any_conflict = " OR ".join(f"conflict_{m} <> ''" for m in _METRICS)
    return f"""
    SELECT *, {any_conflict} OR volume_reason <> '' OR revenue_reason <> '' AS ask_client
    FROM (
        SELECT *, {conflicts} FROM (SELECT r.*, {lists}, {important} FROM {source} r {joins}) a
    ) b
    """


_CTES["asked"] = (
    ("rows", "volume", "revenue"), _asked_cte("rows", _IMPORTANT, _IMPORTANT_JOINS)
)
_CTES["asked_fanned"] = (("rows_fanned",), _asked_cte("rows_fanned", _NOTHING_IMPORTANT, ""))


def _signal_columns(prefix: str, title: str) -> str:
    titles = {
        RESERVICE: "Reservice", RECURRING: "Recurring", ZERO_TIME: "Zero Time",
        HAS_RESERVICE: "Has Reservice",
    }
    return ", ".join(f'{prefix}_{s} AS "{title} {t}"' for s, t in titles.items())


def _report(source: str) -> str:
    return f"""
    SELECT TYPE_ID, coalesce(DESCRIPTION, '') AS DESCRIPTION,
        API_RESERVICE AS "API RESERVICE FLAG", API_REGULAR_SERVICE AS "API REGULAR_SERVICE FLAG",
        API_FREQUENCY AS "API FREQUENCY FLAG", API_DEFAULT_LENGTH AS "API DEFAULT_LENGTH FLAG",
        API_INITIAL_ID AS "API INITIAL ID FLAG", API_INITIAL AS "API INITIAL FLAG",
        recent AS "hasVisitsInPast2Years", active AS "hasActiveSubscription",
        repeated_name AS "Repeated Name",
        {_signal_columns('flagged', 'API')}, {_signal_columns('word', 'Word Signal')},
        appt_bool AS "Appt Recurring", appt_score AS "Appt Recurring Score",
        appt_reason AS "Appt Recurring - Reason", {_signal_columns('final', 'Final')},
        NOT recent OR NOT active AS "Expired Code",
        conflict_reservice AS "AskClient Reservice - Reason",
        conflict_recurring AS "AskClient Recurring - Reason",
        conflict_zero_time AS "AskClient Zero Time - Reason",
        '' AS "AskClient Has Reservice - Reason", ask_client AS "AskClient",
        volume_share AS "Appointment Share Pct", revenue_share AS "Revenue Share Pct",
        volume_reason AS "AskClient High Priority - Reason",
        revenue_reason AS "AskClient High Revenue - Reason", clientId AS "Client"
    FROM {source}
    """


_CTES["report"] = (("asked",), _report("asked"))
_CTES["report_unfiltered"] = (("asked_fanned",), _report("asked_fanned"))
_CTES["in_use"] = (
    ("report",),
    'SELECT * FROM report WHERE "hasActiveSubscription" OR "hasVisitsInPast2Years"',
)


def _sql(body: str, *needs: str) -> str:
    """``body`` with the CTEs it needs, in dependency order."""
    ordered: dict[str, str] = {}

    def visit(name: str) -> None:
        deps, sql = _CTES[name]
        for dep in deps:
            visit(dep)
        ordered.setdefault(name, sql)

    for need in needs:
        visit(need)
    ctes = ", ".join(f"{name} AS ({sql})" for name, sql in ordered.items())
    return f"WITH {ctes} {body}" if ctes else body


_TYPE_COLUMNS = f"clientId, TYPE_ID, DESCRIPTION, {API}"
_QUEUE = """
    SELECT TYPE_ID, DESCRIPTION, "API FREQUENCY FLAG" AS "Recurrence",
           "Final Has Reservice" AS "hasReservice", "Final Reservice" AS "isRervice",
           "Final Zero Time" AS "zeroVisitTime", {share} "Client" AS "clientId"
    FROM {source} WHERE "AskClient" {more}
"""


def _count(select: str, source: str, name: str) -> str:
    return f"SELECT {select} AS clientId, '{name}' AS source, count(*) AS n FROM {source} GROUP BY ALL"


_AUDITED = {
    "service_types": _count("clientId", "types", "service_types"),
    "merged_service_types": _count("clientID", "merged_service_type", "merged_service_types"),
    "recurring_lookup": _count("clientId", "recurring_lookup", "recurring_lookup"),
    "before_dedupe": _count("clientId", "fanned", "before_dedupe"),
    "after_dedupe": _count("clientId", "types", "after_dedupe"),
    "appointments": _count("clientID", "appointments", "appointments"),
    "subscriptions": _count("clientID", "subscriptions", "subscriptions"),
    "unread_amounts": _count(
        "clientId", "(SELECT * FROM subs WHERE amountText IS NOT NULL AND TRY_CAST(amount AS DECIMAL(28, 6)) IS NULL) s",
        "unread_amounts",
    ),
}

#: Of the fact tables: their client column.
_FACTS = {
    "merged_service_types": ("merged_service_type", "clientID"), "visits": ("appointments", "clientID"),
    "subscriptions": ("subscriptions", "clientID"), "lookup": ("recurring_lookup", "clientId"),
}

_SPARK_TYPES = """
    CASE replace(data_type, '[]', '') WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
         WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT' THEN 'float'
         WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END
"""

ORACLE: dict[str, str] = {
    "clients_distinct": _sql(
        "SELECT DISTINCT CLIENT AS clientId FROM service_type_raw WHERE CLIENT IS NOT NULL",
        "service_type_raw",
    ),
    "latest_version": _sql(f"SELECT {_TYPE_COLUMNS} FROM types", "types"),
    "client_selection": _sql(
        f"SELECT {_TYPE_COLUMNS} FROM types WHERE clientId IN ('ECONOMY', 'SMALL', 'LARGE')", "types"
    ),
    "tenant_rollup": _sql(
        f"SELECT {_TYPE_COLUMNS}, sourceClient FROM rolled_versions", "rolled_versions"
    ),
    "tenant_rollup_facts": _sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, 'COMPACT' AS clientId, count(*) AS n FROM {view} "
            f"WHERE {client} IN ('SMALL', 'MEDIUM')"
            for name, (view, client) in _FACTS.items()
        ),
        "merged_service_type", "appointments", "subscriptions", "recurring_lookup",
    ),
    "dedupe_by_key": _sql(
        f"SELECT {_TYPE_COLUMNS} FROM rolled_versions QUALIFY row_number() OVER "
        "(PARTITION BY clientId, TYPE_ID ORDER BY DATE_LOADED DESC, sourceClient) = 1",
        "rolled_versions",
    ),
    "lookup_attach": _sql("SELECT clientId, TYPE_ID, DESCRIPTION, isRecurring FROM attached", "attached"),
    "lookup_attach_fanout": _sql(
        "SELECT clientId, TYPE_ID, DESCRIPTION, isRecurring FROM fanned", "fanned"
    ),
    "reference_mismatch": _sql(
        "SELECT t.clientId, t.TYPE_ID, t.DESCRIPTION, m.description AS DESCRIPTION_MERGED FROM types t "
        "LEFT JOIN merged_service_type m ON m.clientID = t.clientId "
        "AND CAST(m.typeID AS BIGINT) = t.TYPE_ID "
        "WHERE m.description IS NULL OR m.description IS DISTINCT FROM t.DESCRIPTION",
        "types", "merged_service_type",
    ),
    "api_signals": _sql(
        f"SELECT clientId, TYPE_ID, {API}, {', '.join(f'flagged_{s}' for s in SIGNALS)} FROM rows", "rows"
    ),
    "keyword_signals": _sql(
        f"SELECT clientId, TYPE_ID, {_words('DESCRIPTION', SHORT_KEYWORDS)} FROM types", "types"
    ),
    "keyword_signals_documents": f"SELECT doc_id, {_words('text', KEYWORDS)} FROM documents",
    "mapping_signal": _sql(
        "SELECT clientId, TYPE_ID, mapping_value, mapping_reason FROM rows", "rows"
    ),
    "priority_resolve": _sql(
        "SELECT clientId, TYPE_ID, metric, e[1].v AS value, e[1].s AS source, e[1].why AS reason FROM evidence",
        "evidence",
    ),
    "dissent_reasons": _sql(
        "SELECT clientId, TYPE_ID, metric, array_to_string(list_transform(d, lambda x: "
        "x.s || ' disagrees: ' || x.why), '; ') AS dissent "
        "FROM (SELECT *, list_filter(e, lambda x: x.v <> e[1].v) AS d FROM evidence) q WHERE len(d) > 0",
        "evidence",
    ),
    "constraint_correction": _sql(
        f"""
        SELECT clientId, TYPE_ID, {', '.join(f'final_{s}' for s in SIGNALS)},
            concat_ws('; ',
                CASE WHEN final_recurring THEN 'Set has_reservice to True due to recurring=True' END,
                CASE WHEN final_recurring AND final_zero_time
                     THEN 'Set has_reservice to False due to zeroVisitTime=True' END,
                CASE WHEN final_recurring AND flagged_reservice
                     THEN 'Set isRervice to False due to isRecurring=True' END) AS corrections,
            concat_ws('; ',
                CASE WHEN final_recurring AND final_zero_time
                     THEN 'zeroVisitTime=True cannot have has_reservice=True' END,
                CASE WHEN final_recurring AND flagged_reservice
                     THEN 'isRecurring=True cannot have isRervice=True' END) AS violations
        FROM rows
        """,
        "rows",
    ),
    "top_two_conflict": _sql(
        f"SELECT * FROM (SELECT clientId, TYPE_ID, metric, {_top_two('metric')} AS reason FROM evidence) q "
        "WHERE reason IS NOT NULL",
        "evidence",
    ),
    "top_vs_rest_conflict": _sql(
        f"SELECT * FROM (SELECT clientId, TYPE_ID, metric, {_top_vs_rest('metric')} AS reason "
        "FROM evidence) q WHERE reason IS NOT NULL",
        "evidence",
    ),
    "review_reasons": _sql(
        "SELECT clientId, TYPE_ID, ask_client, conflict_recurring, conflict_reservice, "
        "conflict_zero_time, '' AS conflict_has_reservice, volume_reason, revenue_reason FROM asked",
        "asked",
    ),
    "duplicate_name": _sql(
        "SELECT clientId, TYPE_ID, DESCRIPTION, DESCRIPTION IS NOT NULL AND "
        "count(*) OVER (PARTITION BY clientId, DESCRIPTION) > 1 AS repeated_name FROM types",
        "types",
    ),
    "recent_activity": _sql("SELECT clientId, TYPE_ID, recent FROM rows", "rows"),
    "active_subscription": _sql("SELECT clientId, TYPE_ID, active FROM rows", "rows"),
    "expired_flag": _sql(
        "SELECT clientId, TYPE_ID, recent, active, NOT recent OR NOT active AS expired FROM rows", "rows"
    ),
    "account_cadence": _sql(
        "SELECT clientId, TYPE_ID, accountId, visits, years, consecutive, median_days, in_band, strong "
        "FROM accounts",
        "accounts",
    ),
    "cadence_band": _sql(
        """
        SELECT clientId, TYPE_ID, accountId, median_days,
               CASE WHEN median_days >= 20 AND median_days < 50 THEN 'weekly_biweekly'
                    WHEN median_days >= 50 AND median_days < 90 THEN 'monthly'
                    WHEN median_days >= 90 AND median_days < 150 THEN 'bimonthly_quarterly'
                    WHEN median_days >= 300 AND median_days < 420 THEN 'yearly' END AS band
        FROM accounts
        """,
        "accounts",
    ),
    "recurrence_score": _sql(
        "SELECT clientId, TYPE_ID, strong_accounts, total_accounts, ratio AS strong_ratio, appt_score, "
        "appt_bool, appt_reason FROM rows",
        "rows",
    ),
    "volume_share": _sql("SELECT clientId, TYPE_ID, n, share_pct FROM volume", "volume"),
    "volume_topk": _sql(
        "SELECT clientId, TYPE_ID, n, share_pct, CAST(rank AS INTEGER) AS rank FROM volume WHERE rank <= 20",
        "volume",
    ),
    "money_parse": _sql("SELECT clientId, subscriptionId, amountText, amount FROM subs", "subs"),
    "revenue_share": _sql("SELECT clientId, TYPE_ID, revenue, share_pct FROM revenue", "revenue"),
    "revenue_topk": _sql(
        "SELECT clientId, TYPE_ID, revenue, share_pct, CAST(rank AS INTEGER) AS rank FROM revenue "
        "WHERE rank <= 10",
        "revenue",
    ),
    "share_report": _sql(
        f"""
        SELECT v.clientId, v.TYPE_ID,
               coalesce(t.DESCRIPTION, CAST(v.TYPE_ID AS VARCHAR), '<unknown>') AS service,
               v.n AS "appointmentCount",
               {_pct('v.n', 'sum(v.n) OVER (PARTITION BY v.clientId)')} AS "appointmentSharePct"
        FROM type_visits v LEFT JOIN types t
        ON t.clientId = v.clientId AND t.TYPE_ID IS NOT DISTINCT FROM v.TYPE_ID
        WHERE v.clientId IN (SELECT clientId FROM types)
        ORDER BY v.clientId, v.n DESC, v.TYPE_ID
        """,
        "type_visits", "types",
    ),
    "final_report": _sql("SELECT * FROM report", "report"),
    "final_report_unfiltered": _sql("SELECT * FROM report_unfiltered", "report_unfiltered"),
    "activity_filter": _sql("SELECT * FROM in_use", "in_use"),
    "review_queue": _sql(
        _QUEUE.format(
            share='"Appointment Share Pct",', source="in_use", more='AND NOT "Expired Code"'
        ),
        "in_use",
    ),
    "review_queue_unfiltered": _sql(
        _QUEUE.format(share="", source="report_unfiltered", more=""), "report_unfiltered"
    ),
    "review_split_true": _sql('SELECT * FROM in_use WHERE "AskClient"', "in_use"),
    "settled_summary": _sql(
        """
        SELECT TYPE_ID, DESCRIPTION, "Final Reservice" AS "Reservice", "Final Recurring" AS "Recurring",
               "Final Zero Time" AS "Zero Time", "Final Has Reservice" AS "Has Reservice",
               "API FREQUENCY FLAG", "API RESERVICE FLAG", "API REGULAR_SERVICE FLAG",
               "API DEFAULT_LENGTH FLAG", "hasVisitsInPast2Years", "hasActiveSubscription",
               "Expired Code", "Client"
        FROM in_use WHERE NOT "AskClient"
        """,
        "in_use",
    ),
    "source_row_audit": _sql(
        "SELECT clientId, "
        + ", ".join(
            f"CAST(coalesce(sum(n) FILTER (WHERE source = '{s}'), 0) AS BIGINT) AS {s}" for s in _AUDITED
        )
        + f" FROM ({' UNION ALL '.join(_AUDITED.values())}) q WHERE clientId IS NOT NULL GROUP BY clientId",
        "types", "merged_service_type", "recurring_lookup", "fanned", "appointments", "subscriptions", "subs",
    ),
    "review_metrics": _sql(
        """
        SELECT clientId, count(*) AS report_rows, count(*) FILTER (WHERE ask_client) AS to_ask,
            CAST(sum(len(string_split(conflict_recurring, '; isRecurring: '))
                     + len(string_split(conflict_reservice, '; isRervice: '))
                     + len(string_split(conflict_zero_time, '; zeroVisitTime: '))
                     - CAST(conflict_recurring = '' AS INT) - CAST(conflict_reservice = '' AS INT)
                     - CAST(conflict_zero_time = '' AS INT)) AS BIGINT) AS conflicts,
            CAST(sum(CAST(final_recurring AND final_zero_time AS INT)
                     + CAST(final_recurring AND flagged_reservice AS INT)) AS BIGINT) AS violations,
            count(*) FILTER (WHERE volume_reason <> '') AS high_priority,
            count(*) FILTER (WHERE revenue_reason <> '') AS high_revenue
        FROM asked GROUP BY clientId
        """,
        "asked",
    ),
    "table_profile": f"""
        SELECT c.table_name, c.column_name AS field_path, {_SPARK_TYPES} AS field_type,
               CASE WHEN data_type LIKE '%[]' THEN 'REPEATED' ELSE 'NULLABLE' END AS mode,
               CAST(NULL AS VARCHAR) AS comment, CAST(NULL AS VARCHAR) AS table_comment, n.num_rows,
               CAST(NULL AS VARCHAR) AS error
        FROM duckdb_columns() c
        JOIN ({' UNION ALL '.join(f"SELECT '{t}' AS table_name, count(*) AS num_rows FROM {t}" for t in DRIVER_TABLES)}) n
        ON n.table_name = c.table_name
    """,
}

# Other ways to the same rows.
ORACLE |= {
    "tenant_rollup_by_frame": ORACLE["tenant_rollup"],
    "account_cadence_of_parts": ORACLE["account_cadence"],
    "audit_of_reductions": ORACLE["source_row_audit"],
    "delivered_report": ORACLE["activity_filter"],
}
