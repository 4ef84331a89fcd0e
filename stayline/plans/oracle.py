"""The queries of the catalog in SQL, for a check by another engine."""

from __future__ import annotations

from stayline.operators.distributions import CHURN_FLAG
from stayline.operators.certificates import KINK
from stayline.operators.features import FEATURES
from stayline.operators.rules import PLAYS, TENURE
from stayline.plans.catalog import (
    ACTION_DAYS,
    DOWNGRADE_PAGE,
    LATER,
    SPOT_COEFFICIENTS,
    SPOT_INTERCEPT,
    SPOT_USER,
)
from stayline.plans.study import PLAYS_BINS, TENURE_BINS

# Each view is a common table expression; a query lists those it builds on.
VIEWS = {
    "log": """
        SELECT CASE WHEN e.user_id % 50 = 0 THEN '' ELSE CAST(e.user_id AS VARCHAR) END AS "userId",
               CASE WHEN e.event_id % 97 = 0 THEN NULL
                    ELSE CAST(floor(e.event_id / 20) AS BIGINT) END AS "sessionId",
               CASE WHEN e.event_type = 'error' AND e.value >= 200 THEN 'Cancellation Confirmation'
                    WHEN e.event_type = 'view' AND e.value >= 100 THEN 'NextSong'
                    ELSE e.event_type END AS page,
               epoch_us(e.ts) // 1000 AS ts,
               epoch_us(s.first_signup) // 1000 AS registration,
               CASE WHEN e.value >= 50 THEN 'paid' ELSE 'free' END AS level,
               CAST(CASE WHEN e.event_type = 'error' AND e.value < 10 THEN 404
                         WHEN e.event_type = 'click' THEN 307 ELSE 200 END AS BIGINT) AS status,
               CASE WHEN e.user_id % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
               c.c_name || ', ' || n.n_name AS location
        FROM events e
        LEFT JOIN customer c ON c.c_custkey = e.user_id
        LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
        LEFT JOIN (SELECT user_id, min(ts) AS first_signup FROM events
                   WHERE event_type = 'signup' GROUP BY user_id) s ON s.user_id = e.user_id""",
    "clean": """
        SELECT * FROM log WHERE "userId" IS NOT NULL AND "sessionId" IS NOT NULL AND "userId" <> ''""",
    "attributes": """
        SELECT "userId", max(CASE WHEN rg = 1 THEN gender END) AS gender,
               max(CASE WHEN rl = 1 THEN location END) AS location
        FROM (SELECT "userId", gender, location,
                     row_number() OVER (PARTITION BY "userId"
                        ORDER BY gender IS NULL, ts DESC, gender DESC) AS rg,
                     row_number() OVER (PARTITION BY "userId"
                        ORDER BY location IS NULL, ts DESC, location DESC) AS rl
              FROM clean)
        GROUP BY "userId" """,
    "facts": """
        SELECT "userId", a.gender, list_extract(string_split(a.location, ','), -1) AS area,
               f.registration_date, f.latest_date,
               CAST(f.latest_date - f.registration_date AS INTEGER) AS delta_time,
               f.song_nums, f.n_events, f.n_normal, f.n_problem, f.churn_rows,
               CASE WHEN f.churn_rows > 0 THEN 1 ELSE 0 END AS churn_users
        FROM (SELECT "userId", CAST(make_timestamp(min(registration) * 1000) AS DATE) AS registration_date,
                     CAST(make_timestamp(max(ts) * 1000) AS DATE) AS latest_date,
                     count(*) FILTER (WHERE page = 'NextSong') AS song_nums,
                     count(*) AS n_events,
                     count(*) FILTER (WHERE status = 200) AS n_normal,
                     count(*) FILTER (WHERE status = 404) AS n_problem,
                     count(*) FILTER (WHERE page = 'Cancellation Confirmation') AS churn_rows
              FROM clean GROUP BY "userId") f
        JOIN attributes a USING ("userId")""",
    "players": "SELECT * FROM facts WHERE song_nums > 0",
    "levels": """
        SELECT DISTINCT c."userId", c.level, p.churn_users FROM clean c JOIN players p USING ("userId")""",
    "ratios": """
        SELECT "userId", churn_users, CAST(n_normal AS DOUBLE) / n_events AS ratio FROM players""",
    "bucketed": """
        SELECT *, CAST(CAST('0x' || substr(md5('24:' || "userId"), 1, 8) AS BIGINT) % 100 AS INTEGER) AS bucket,
               CAST(CAST('0x' || substr(md5('fold:24:' || "userId"), 1, 8) AS BIGINT) % 3 AS INTEGER) AS fold
        FROM players""",
    "split": """
        SELECT *, CASE WHEN bucket < 64 THEN 'train' WHEN bucket < 80 THEN 'valid' ELSE 'test' END AS part
        FROM bucketed""",
    "areas": """
        SELECT area, row_number() OVER (ORDER BY count(*) DESC, area) - 1 AS idx
        FROM split WHERE part = 'train' AND area IS NOT NULL GROUP BY area""",
    "genders": """
        SELECT gender, row_number() OVER (ORDER BY count(*) DESC, gender) - 1 AS idx
        FROM split WHERE part = 'train' AND gender IS NOT NULL GROUP BY gender""",
    "vectors": """
        SELECT s.*, CAST(coalesce(a.idx, (SELECT count(*) FROM areas)) AS DOUBLE) AS area_feature,
               CAST(coalesce(g.idx, (SELECT count(*) FROM genders)) AS DOUBLE) AS gender_feature
        FROM split s LEFT JOIN areas a ON a.area = s.area LEFT JOIN genders g ON g.gender = s.gender
        """,
    "areas_events": """
        SELECT area, row_number() OVER (ORDER BY count(*) DESC, area) - 1 AS idx
        FROM clean c JOIN split s USING ("userId")
        WHERE part = 'train' AND area IS NOT NULL GROUP BY area""",
    "genders_events": """
        SELECT s.gender, row_number() OVER (ORDER BY count(*) DESC, s.gender) - 1 AS idx
        FROM clean c JOIN split s USING ("userId")
        WHERE part = 'train' AND s.gender IS NOT NULL GROUP BY s.gender""",
    "vectors_events": """
        SELECT s.*, CAST(coalesce(a.idx, (SELECT count(*) FROM areas_events)) AS DOUBLE) AS area_feature,
               CAST(coalesce(g.idx, (SELECT count(*) FROM genders_events)) AS DOUBLE) AS gender_feature
        FROM split s LEFT JOIN areas_events a ON a.area = s.area
        LEFT JOIN genders_events g ON g.gender = s.gender""",
    "event_vectors": """
        SELECT v.* FROM clean c JOIN vectors_events v USING ("userId")""",
}

NEEDS = {
    "log": [],
    "clean": ["log"],
    "attributes": ["clean"],
    "facts": ["attributes"],
    "players": ["facts"],
    "levels": ["players"],
    "ratios": ["players"],
    "bucketed": ["players"],
    "split": ["bucketed"],
    "areas": ["split"],
    "genders": ["split"],
    "vectors": ["areas", "genders"],
    "areas_events": ["split"],
    "genders_events": ["split"],
    "vectors_events": ["areas_events", "genders_events"],
    "event_vectors": ["vectors_events"],
}


def _needed(names: list[str]) -> set[str]:
    return {n for name in names for n in {name} | _needed(NEEDS[name])}


def _sql(body: str, *views: str) -> str:
    used = _needed(list(views))
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in used)
    return f"WITH {ctes}\n{body}"


def _share(table: str, by: str, users: str) -> str:
    return f"""
        SELECT {by}, count({by}) AS {users},
               count({by}) FILTER (WHERE churn_users = 1) AS churned,
               (count({by}) - count({by}) FILTER (WHERE churn_users = 1))
                   / nullif(CAST(count({by}) AS DOUBLE), 0) AS retained_share,
               count({by}) FILTER (WHERE churn_users = 1)
                   / nullif(CAST(count({by}) AS DOUBLE), 0) AS churn_share
        FROM {table} GROUP BY {by}"""


def _box(table: str, value: str, by: str = CHURN_FLAG) -> str:
    return f"""
        SELECT {by}, count(*) AS n, round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median,
               round(any_value(q3), 6) AS q3,
               round(least(any_value(q1), min(v) FILTER (WHERE v BETWEEN lo AND hi)), 6) AS whisker_lo,
               round(greatest(any_value(q3), max(v) FILTER (WHERE v BETWEEN lo AND hi)), 6) AS whisker_hi,
               count(*) FILTER (WHERE NOT v BETWEEN lo AND hi) AS n_outliers
        FROM (SELECT {by}, CAST({value} AS DOUBLE) AS v FROM {table} WHERE {value} IS NOT NULL) t
        JOIN (SELECT *, q1 - (q3 - q1) * 1.5 AS lo, q3 + (q3 - q1) * 1.5 AS hi FROM
                (SELECT {by}, quantile_cont(CAST({value} AS DOUBLE), 0.25) AS q1,
                        quantile_cont(CAST({value} AS DOUBLE), 0.5) AS q2,
                        quantile_cont(CAST({value} AS DOUBLE), 0.75) AS q3
                 FROM {table} GROUP BY {by})) q USING ({by})
        GROUP BY {by}"""


def _hist(table: str, value: str, bins: int, shared: bool = False, by: str = CHURN_FLAG) -> str:
    over = "OVER ()" if shared else f"OVER (PARTITION BY {by})"
    return f"""
        SELECT g.{by}, g.bin, round(g.lo + (g.hi - g.lo) / {bins} * (g.bin - 1), 6) AS lo,
               round(g.lo + (g.hi - g.lo) / {bins} * g.bin, 6) AS hi,
               CAST(coalesce(c.n, 0) AS BIGINT) AS n,
               round(coalesce(c.n, 0) / (g.total * ((g.hi - g.lo) / {bins})), 6) AS density
        FROM (SELECT *, unnest(range(1, {bins} + 1)) AS bin FROM
                (SELECT DISTINCT {by}, lo, hi, total FROM spread)) g
        LEFT JOIN (SELECT {by}, count(*) AS n,
                          least(CAST(floor({bins}.0::DOUBLE * (v - lo) / (hi - lo)) AS BIGINT) + 1, {bins}) AS bin
                   FROM spread GROUP BY ALL) c
          ON c.{by} = g.{by} AND c.bin = g.bin""".replace(
        "spread",
        f"""(SELECT {by}, v, total, CASE WHEN v_min = v_max THEN v_min - 0.5 ELSE v_min END AS lo,
                CASE WHEN v_min = v_max THEN v_max + 0.5 ELSE v_max END AS hi FROM
             (SELECT {by}, CAST({value} AS DOUBLE) AS v, min(CAST({value} AS DOUBLE)) {over} AS v_min,
                     max(CAST({value} AS DOUBLE)) {over} AS v_max,
                     count(*) OVER (PARTITION BY {by}) AS total
              FROM {table} WHERE {value} IS NOT NULL))""",
    )


def _scaled(table: str = "vectors", rows: str = "vectors") -> str:
    columns = ("area_feature", "gender_feature", "song_nums", "delta_time")
    parts = ", ".join(
        f"round(coalesce({c} / nullif((SELECT stddev_samp({c}) FROM {rows} WHERE part = 'train'), 0), 0), 6) AS {c}"
        for c in columns
    )
    return f'SELECT "userId", {parts} FROM {table}'


def _majority(fitting: str, scored: str, rows: str) -> str:
    """Weighted F1 of the more frequent class of some rows, on other rows."""
    return f"""(SELECT coalesce(f1, 0) FROM (SELECT share * 2 * share / (1 + share) AS f1 FROM
        (SELECT avg(CASE WHEN churn_users = m.label THEN 1.0::DOUBLE ELSE 0 END) AS share
         FROM {rows}, (SELECT CASE WHEN avg(churn_users) > 0.5 THEN 1 ELSE 0 END AS label
                       FROM {rows} WHERE {fitting}) m
         WHERE {scored})))"""


def _majority_mean(rows: str) -> str:
    folds = [
        _majority(f"part = 'train' AND fold <> {k}", f"part = 'train' AND fold = {k}", rows)
        for k in range(3)
    ]
    return f"round(({' + '.join(folds)}) / 3, 6)"


def _loss_slopes(slope: str, free: str, loss: str) -> str:
    """Slopes of a mean loss of the train users, in units of each feature's deviation."""
    products = " + ".join(f"({b}) * {c}" for b, c in zip(SPOT_COEFFICIENTS, FEATURES))
    names = [*FEATURES, "1"]
    slots = " UNION ALL ".join(
        f"SELECT {i if i < len(FEATURES) else -1} AS slot, CAST({c} AS DOUBLE) AS x, y, m FROM spot"
        for i, c in enumerate(names)
    )
    return f"""
        SELECT CAST(slot AS INTEGER) AS slot, round(d, 6) AS deviation, round((g + low) / n / d, 6) AS least,
               round((g + high) / n / d, 6) AS most, round(l / n, 6) AS loss
        FROM (SELECT slot, count(*) AS n, CASE WHEN slot = -1 THEN 1 ELSE stddev_samp(x) END AS d,
                     sum(({slope}) * x) AS g, sum(least(({free}) * x, 0)) AS low,
                     sum(greatest(({free}) * x, 0)) AS high, sum({loss}) AS l
              FROM (WITH spot AS (SELECT *, CAST(churn_users AS DOUBLE) AS y,
                                         {SPOT_INTERCEPT} + {products} AS m
                                  FROM vectors WHERE part = 'train') {slots})
              GROUP BY slot)"""


def _optimal(points: int) -> str:
    grid = " UNION ALL ".join(f"SELECT CAST({k} AS INTEGER) AS grid_pos" for k in range(points))
    return f"""
        SELECT grid_pos, CAST({len(FEATURES) + 1} AS BIGINT) AS slots, count(*) > 0 AS optimal
        FROM vectors, ({grid}) WHERE part = 'train' GROUP BY grid_pos"""


def _scaled_slots() -> str:
    """One-hot slots over the deviations that the 0/1 columns and numbers have among train users."""
    areas, genders = "(SELECT count(*) FROM areas)", "(SELECT count(*) FROM genders)"

    def category(c: str, first: str) -> str:
        return f"""
            SELECT "userId", CAST({c} + {first} AS BIGINT) AS slot, 1 / nullif(d, 0) AS value
            FROM vectors JOIN (SELECT k.{c}, stddev_samp(CASE WHEN t.{c} = k.{c} THEN 1.0::DOUBLE ELSE 0 END) AS d
                               FROM (SELECT DISTINCT {c} FROM vectors) k,
                                    (SELECT {c} FROM vectors WHERE part = 'train') t
                               GROUP BY k.{c}) USING ({c})"""

    def number(c: str, place: int) -> str:
        return f"""
            SELECT "userId", {areas} + {genders} + {place},
                   {c} / nullif((SELECT stddev_samp({c}) FROM vectors WHERE part = 'train'), 0) FROM vectors"""

    parts = [category("area_feature", "0"), category("gender_feature", f"{areas} + 1")]
    parts += [number("song_nums", 2), number("delta_time", 3)]
    return f"""SELECT "userId", CAST(slot AS BIGINT) AS slot, round(value, 6) AS value
               FROM ({" UNION ALL ".join(parts)}) WHERE value <> 0"""


def _later_scores() -> str:
    """Scores of players who registered later, by indexes and deviations of the earlier ones."""

    def index(c: str) -> str:
        return f"""(SELECT {c}, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS {c}_idx
                    FROM earlier WHERE {c} IS NOT NULL GROUP BY {c})"""

    def rows(table: str) -> str:
        return f"""
            SELECT p.*, CAST(coalesce(area_idx, (SELECT count(DISTINCT area) FROM earlier)) AS DOUBLE) AS area_feature,
                   CAST(coalesce(gender_idx, (SELECT count(DISTINCT gender) FROM earlier)) AS DOUBLE) AS gender_feature
            FROM {table} p LEFT JOIN {index("area")} USING (area) LEFT JOIN {index("gender")} USING (gender)"""

    margin = " + ".join(
        f"({b}) * coalesce({c} / nullif((SELECT stddev_samp({c}) FROM known), 0), 0)"
        for b, c in zip(SPOT_COEFFICIENTS, FEATURES)
    )
    return f"""
        SELECT "userId", area_feature, gender_feature, round(m, 6) AS margin,
               round(1 / (1 + exp(-m)), 6) AS probability
        FROM (WITH earlier AS (SELECT * FROM players WHERE registration_date < DATE '{LATER}'),
                   later AS (SELECT * FROM players WHERE registration_date >= DATE '{LATER}'),
                   known AS ({rows("earlier")})
              SELECT *, {SPOT_INTERCEPT} + {margin} AS m FROM ({rows("later")}))"""


def _splits(last: str) -> str:
    values = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {i} AS place, CAST({c} AS DOUBLE) AS v, churn_users AS y"
        f" FROM vectors WHERE part = 'train'"
        for i, c in enumerate(FEATURES)
    )
    gini = "2 * ({1} / {0}) * (1 - {1} / {0})".format
    left = gini("nl", "pl")
    right = gini("(nt - nl)", "(pt - pl)")
    return f"""
        SELECT feature, threshold, nl AS "left", nt - nl AS "right", round(gain, 6) AS gain FROM (
          SELECT *, row_number() OVER (PARTITION BY feature ORDER BY round(gain, 12) DESC, threshold) AS r
          FROM (SELECT feature, place, (v + above) / 2 AS threshold, nl, nt,
                       {gini("nt", "pt")} - nl / nt * ({left}) - (nt - nl) / nt * ({right}) AS gain
                FROM (SELECT feature, place, v, lead(v) OVER w AS above,
                             CAST(sum(n) OVER w AS DOUBLE) AS nl, CAST(sum(p) OVER w AS DOUBLE) AS pl,
                             CAST(sum(n) OVER (PARTITION BY feature) AS DOUBLE) AS nt,
                             CAST(sum(p) OVER (PARTITION BY feature) AS DOUBLE) AS pt
                      FROM (SELECT feature, place, v, count(*) AS n, sum(y) AS p FROM ({values})
                            GROUP BY ALL)
                      WINDOW w AS (PARTITION BY feature ORDER BY v))
                WHERE above IS NOT NULL))
        WHERE r = 1 {last}"""


RULES = [
    *[("plays_rule", k, f"song_nums >= {v}") for k, v in enumerate(PLAYS)],
    *[("tenure_rule", k, f"delta_time >= {v}") for k, v in enumerate(TENURE)],
    ("constant", 0, "false"),
    ("constant", 1, "true"),
]


def _rule_f1(model: str, rule: str, fitting: str, scored: str) -> str:
    """Weighted F1 of a rule whose side was learned from some rows, on other rows."""
    up = f"""(SELECT coalesce(avg(churn_users) FILTER (WHERE {rule}), 0)
                  >= coalesce(avg(churn_users) FILTER (WHERE NOT ({rule})), 0)
              FROM vectors WHERE {fitting})"""
    guess = f"CASE WHEN ({rule}) = {'true' if model == 'constant' else up} THEN 1 ELSE 0 END"
    return f"""(SELECT coalesce(sum(support * 2 * tp / (support + predicted)) / sum(support), 0) FROM (
        SELECT k, CAST(count(*) FILTER (WHERE churn_users = k) AS DOUBLE) AS support,
               CAST(count(*) FILTER (WHERE guess = k) AS DOUBLE) AS predicted,
               CAST(count(*) FILTER (WHERE churn_users = k AND guess = k) AS DOUBLE) AS tp
        FROM (SELECT churn_users, {guess} AS guess FROM vectors WHERE {scored}),
             (SELECT unnest([0, 1]) AS k) GROUP BY k) WHERE support > 0)"""


def _rules_board() -> str:
    rows = []
    for model, pos, rule in RULES:
        folds = [
            _rule_f1(model, rule, f"part = 'train' AND fold <> {k}", f"part = 'train' AND fold = {k}")
            for k in range(3)
        ]
        valid, test = (_rule_f1(model, rule, "part = 'train'", f"part = '{p}'") for p in ("valid", "test"))
        rows.append(
            f"SELECT '{model}' AS model, CAST({pos} AS INTEGER) AS grid_pos,"
            f" ({' + '.join(folds)}) / 3 AS f, {valid} AS valid_f1, {test} AS test_f1"
        )
    order = "round(f, 12) DESC, grid_pos"
    return f"""(SELECT *, row_number() OVER (ORDER BY round(f, 12) DESC, model, grid_pos) AS place,
                       row_number() OVER (PARTITION BY model ORDER BY {order}) AS own
                FROM ({" UNION ALL ".join(rows)}))"""


def _schema_report() -> str:
    columns = {
        "userId": "string",
        "sessionId": "bigint",
        "page": "string",
        "ts": "bigint",
        "registration": "bigint",
        "level": "string",
        "status": "bigint",
        "gender": "string",
        "location": "string",
    }
    return " UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS "column", '{kind}' AS type, count(*) AS n_rows,
            count(*) - count("{c}") AS n_null FROM log"""
        for i, (c, kind) in enumerate(columns.items(), 1)
    )


ROW = '"userId", "sessionId", page, ts'
DAY = "CAST(make_timestamp({} * 1000) AS DATE)"
CANCEL = "page = 'Cancellation Confirmation'"

SQL = {
    "event_log": _sql("SELECT * FROM log", "log"),
    "read_json_roundtrip": _sql("SELECT * FROM log", "log"),
    "parquet_roundtrip": _sql(f"SELECT {ROW}, {DAY.format('ts')} AS event_date FROM clean", "clean"),
    "schema_report": _sql(_schema_report(), "log"),
    "preview_topn": _sql(
        f'SELECT {ROW} FROM clean ORDER BY ts, "userId", "sessionId", page LIMIT 5', "clean"
    ),
    "clean_log": _sql(f"SELECT {ROW}, level, status, gender FROM clean", "clean"),
    "enriched_log": _sql(
        f"""SELECT c.*, {DAY.format('c.ts')} AS event_date,
               {DAY.format('c.registration')} AS registration_date, p.latest_date, p.delta_time,
               list_extract(string_split(c.location, ','), -1) AS area, p.song_nums,
               CASE WHEN c.{CANCEL} THEN 1 ELSE 0 END AS churn, p.churn_users
            FROM clean c JOIN players p USING ("userId")""",
        "players",
    ),
    "events_of_page": _sql(f"SELECT {ROW} FROM clean WHERE page = 'NextSong'", "clean"),
    "events_of_page_sql": _sql(f"SELECT {ROW} FROM clean WHERE {CANCEL}", "clean"),
    "problem_visits": _sql(
        """SELECT DISTINCT c.status, "userId", p.churn_users
           FROM clean c JOIN players p USING ("userId") WHERE c.status = 404""",
        "players",
    ),
    "user_lookup": _sql(
        f'SELECT {ROW} FROM log WHERE TRY_CAST("userId" AS INTEGER) = {SPOT_USER}', "log"
    ),
    "user_id_int": _sql(f'SELECT {ROW}, TRY_CAST("userId" AS INTEGER) AS user_number FROM log', "log"),
    "event_date": _sql(
        f"""SELECT "userId", ts, {DAY.format('ts')} AS event_date,
               strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS date_text FROM clean""",
        "clean",
    ),
    "registration_date": _sql(
        f"""SELECT "userId", registration, {DAY.format('registration')} AS registration_date FROM clean""",
        "clean",
    ),
    "events_by_hour": _sql(
        "SELECT CAST(hour(make_timestamp(ts * 1000)) AS INTEGER) AS hour, count(*) AS n FROM clean GROUP BY 1",
        "clean",
    ),
    "tenure_days": _sql(
        'SELECT "userId", registration_date, latest_date, delta_time FROM facts', "facts"
    ),
    "tenure_from_text": _sql('SELECT "userId", delta_time FROM facts', "facts"),
    "user_area": _sql('SELECT "userId", area FROM facts', "facts"),
    "churn_marker": _sql(
        f"SELECT {ROW}, CASE WHEN {CANCEL} THEN 1 ELSE 0 END AS churn FROM clean", "clean"
    ),
    "churn_users": _sql('SELECT "userId", churn_users FROM facts', "facts"),
    "latest_time": _sql(
        f"""SELECT {ROW}, {DAY.format('(max(ts) OVER (PARTITION BY "userId"))')} AS latest_date FROM clean""",
        "clean",
    ),
    "log_with_tenure": _sql(
        f'SELECT {ROW}, delta_time FROM clean JOIN facts USING ("userId")', "facts"
    ),
    "log_with_plays": _sql(
        f'SELECT {ROW}, song_nums FROM clean JOIN players USING ("userId")', "players"
    ),
    "log_with_plays_keep": _sql(
        f'SELECT {ROW}, song_nums FROM clean JOIN facts USING ("userId")', "facts"
    ),
    "churned_rows_semi": _sql(
        f'SELECT {ROW} FROM clean WHERE "userId" IN (SELECT "userId" FROM clean WHERE {CANCEL})',
        "clean",
    ),
    "retained_rows_anti": _sql(
        f'SELECT {ROW} FROM clean WHERE "userId" NOT IN (SELECT "userId" FROM clean WHERE {CANCEL})',
        "clean",
    ),
    "quality_audit": _sql(
        """SELECT count(*) AS n_rows, count(*) FILTER (WHERE "userId" IS NULL) AS "null_userId",
               count(*) FILTER (WHERE "sessionId" IS NULL) AS "null_sessionId",
               count(*) FILTER (WHERE "userId" = '') AS "blank_userId",
               CAST(0 AS BIGINT) AS n_corrupt,
               count(*) FILTER (WHERE "userId" IS NOT NULL AND "sessionId" IS NOT NULL) AS n_without_nulls,
               (SELECT count(*) FROM clean) AS n_kept,
               count(*) - (SELECT count(*) FROM clean) AS n_removed FROM log""",
        "clean",
    ),
    "distinct_users": _sql(
        'SELECT count(*) AS users FROM (SELECT DISTINCT "userId" FROM log)', "log"
    ),
    "distinct_pages": _sql("SELECT DISTINCT page FROM clean ORDER BY page", "clean"),
    "time_range": _sql(
        f"SELECT min({DAY.format('ts')}) AS first_date, max({DAY.format('ts')}) AS last_date FROM clean",
        "clean",
    ),
    "registration_range": _sql(
        f"""SELECT min({DAY.format('registration')}) AS first_date,
               max({DAY.format('registration')}) AS last_date FROM clean""",
        "clean",
    ),
    "latest_per_user": _sql(
        f"""SELECT "userId", max({DAY.format('ts')}) AS latest_date FROM clean GROUP BY "userId" """,
        "clean",
    ),
    "plays_per_user": _sql(
        """SELECT "userId", count(*) AS song_nums FROM clean WHERE page = 'NextSong' GROUP BY "userId" """,
        "clean",
    ),
    "user_facts": _sql("SELECT * FROM facts", "facts"),
    "user_facts_from_log": _sql("SELECT * FROM facts", "facts"),
    "user_attributes_distinct": _sql(
        """SELECT DISTINCT c.gender, "userId", p.churn_users
           FROM clean c JOIN players p USING ("userId")""",
        "players",
    ),
    "users_by_gender": _sql(
        "SELECT gender, count(gender) AS users FROM players GROUP BY gender", "players"
    ),
    "churn_by_gender": _sql(
        "SELECT churn_users, gender, count(gender) AS users FROM players GROUP BY ALL", "players"
    ),
    "users_by_level": _sql(
        "SELECT level, count(level) AS user_levels FROM levels GROUP BY level", "levels"
    ),
    "churn_by_level": _sql(
        "SELECT churn_users, level, count(level) AS user_levels FROM levels GROUP BY ALL", "levels"
    ),
    "events_by_status": _sql(
        """SELECT status, count(status) AS n FROM clean
           WHERE "userId" IN (SELECT "userId" FROM players) GROUP BY status""",
        "players",
    ),
    "events_per_user": _sql('SELECT "userId", n_events FROM players', "players"),
    "status_by_user": _sql(
        """SELECT "userId", p.churn_users, c.status, count(c.status) AS n
           FROM clean c JOIN players p USING ("userId") GROUP BY ALL""",
        "players",
    ),
    "normal_visit_ratio": _sql("SELECT * FROM ratios", "ratios"),
    "churn_summary": _sql(
        """SELECT CAST(sum(churn_rows) AS BIGINT) AS marker_rows,
               count(*) FILTER (WHERE churn_users = 1) AS churned_users, count(*) AS users FROM players""",
        "players",
    ),
    "share_by_gender": _sql(_share("players", "gender", "users"), "players"),
    "share_by_level": _sql(_share("levels", "level", "user_levels"), "levels"),
    "box_normal_ratio": _sql(_box("ratios", "ratio"), "ratios"),
    "hist_tenure": _sql(_hist("players", "delta_time", TENURE_BINS), "players"),
    "hist_plays": _sql(_hist("players", "song_nums", PLAYS_BINS), "players"),
    "hist_plays_shared_edges": _sql(_hist("players", "song_nums", PLAYS_BINS, True), "players"),
    "box_plays": _sql(_box("players", "song_nums"), "players"),
    "churn_running": _sql(
        f"""SELECT {ROW}, CASE WHEN {CANCEL} THEN 1 ELSE 0 END AS churn,
               CAST(sum(CASE WHEN {CANCEL} THEN 1 ELSE 0 END)
                    OVER (PARTITION BY "userId" ORDER BY ts DESC) AS BIGINT) AS churn_running
            FROM clean""",
        "clean",
    ),
    "feature_table": _sql(
        """SELECT "userId", gender, area, delta_time, song_nums, churn_users AS label,
               n_events AS weight FROM players""",
        "players",
    ),
    "feature_table_events": _sql(
        """SELECT "userId", p.gender, p.area, p.delta_time, p.song_nums, p.churn_users AS label
           FROM clean c JOIN players p USING ("userId")""",
        "players",
    ),
    "area_index": _sql('SELECT "userId", area, area_feature FROM vectors', "vectors"),
    "gender_index": _sql('SELECT "userId", gender, gender_feature FROM vectors', "vectors"),
    "assembled": _sql(
        """SELECT "userId", area_feature, gender_feature, CAST(song_nums AS DOUBLE) AS song_nums,
               CAST(delta_time AS DOUBLE) AS delta_time FROM vectors""",
        "vectors",
    ),
    "scaled_features": _sql(_scaled(), "vectors"),
    "user_split": _sql('SELECT "userId", part, fold FROM split', "split"),
    "f1_from_predictions": _sql(
        """SELECT CAST(sum(support) AS DOUBLE) AS n, round(sum(tp) / sum(support), 6) AS accuracy,
               round(sum(support * coalesce(tp / nullif(predicted, 0), 0)) / sum(support), 6)
                   AS weighted_precision,
               round(sum(support * 2 * tp / (support + predicted)) / sum(support), 6) AS f1
           FROM (SELECT k, CAST(count(*) FILTER (WHERE churn_users = k) AS DOUBLE) AS support,
                        CAST(count(*) FILTER (WHERE guess = k) AS DOUBLE) AS predicted,
                        CAST(count(*) FILTER (WHERE churn_users = k AND guess = k) AS DOUBLE) AS tp
                 FROM (SELECT churn_users, CASE WHEN song_nums <= 1 THEN 1 ELSE 0 END AS guess FROM players),
                      (SELECT unnest([0, 1]) AS k)
                 GROUP BY k)""",
        "players",
    ),
    "read_json_corrupt": _sql(
        f'SELECT {ROW}, status FROM clean WHERE "sessionId" % 7 <> 0', "clean"
    ),
    "quality_audit_corrupt": _sql(
        """SELECT count(*) AS n_rows, count(*) FILTER (WHERE "userId" IS NULL) AS "null_userId",
               count(*) FILTER (WHERE "sessionId" IS NULL) AS "null_sessionId",
               count(*) FILTER (WHERE "userId" = '') AS "blank_userId",
               count(*) FILTER (WHERE "sessionId" % 7 = 0) AS n_corrupt,
               count(*) FILTER (WHERE "userId" IS NOT NULL AND "sessionId" IS NOT NULL) AS n_without_nulls,
               (SELECT count(*) FROM clean) AS n_kept,
               count(*) - (SELECT count(*) FROM clean) AS n_removed FROM log""",
        "clean",
    ),
    "normal_visit_ratio_required": _sql(
        """SELECT "userId", churn_users, ratio FROM ratios JOIN players USING ("userId", churn_users)
           WHERE n_normal > 0""",
        "ratios",
    ),
    "churn_by_downgrade": _sql(
        f"""SELECT CASE WHEN marks > 0 THEN 1 ELSE 0 END AS churn_users, gender, count(gender) AS users
            FROM players JOIN (SELECT "userId", count(*) FILTER (WHERE page = '{DOWNGRADE_PAGE}') AS marks
                               FROM clean GROUP BY "userId") USING ("userId")
            GROUP BY ALL""",
        "players",
    ),
    "actions_in_window": _sql(
        f"""SELECT churn_users, count(*) AS users, count(*) FILTER (WHERE n > 0) AS acting_users,
                CAST(sum(n) AS BIGINT) AS actions, round(sum(n) / count(*), 6) AS actions_per_user
            FROM (SELECT "userId", CASE WHEN count(*) FILTER (WHERE {CANCEL}) > 0 THEN 1 ELSE 0 END AS churn_users,
                         count(*) FILTER (WHERE page = 'NextSong'
                                          AND ts > last - {ACTION_DAYS} * 86400000) AS n
                  FROM (SELECT *, max(ts) OVER (PARTITION BY "userId") AS last FROM clean)
                  GROUP BY "userId")
            GROUP BY churn_users""",
        "clean",
    ),
    "box_plays_by_gender": _sql(_box("players", "song_nums", "gender"), "players"),
    "area_index_events": _sql(
        'SELECT "userId", area, area_feature FROM vectors_events', "vectors_events"
    ),
    "scaled_features_events": _sql(_scaled("vectors_events", "event_vectors"), "event_vectors"),
    "onehot_features": _sql(
        """SELECT "userId", CAST(slot AS INTEGER) AS slot, CAST(value AS DOUBLE) AS value FROM (
             SELECT "userId", area_feature AS slot, 1 AS value FROM vectors UNION ALL
             SELECT "userId", gender_feature + (SELECT count(*) FROM areas) + 1, 1 FROM vectors UNION ALL
             SELECT "userId", (SELECT count(*) FROM areas) + (SELECT count(*) FROM genders) + 2,
                    song_nums FROM vectors UNION ALL
             SELECT "userId", (SELECT count(*) FROM areas) + (SELECT count(*) FROM genders) + 3,
                    delta_time FROM vectors) WHERE value <> 0""",
        "vectors",
    ),
    "onehot_scaled": _sql(_scaled_slots(), "vectors"),
    "onehot_scaled_vectors": _sql(_scaled_slots(), "vectors"),
    "scored_later_users": _sql(_later_scores(), "players"),
    "plays_of_churned_filtered": _sql(
        f'SELECT {ROW}, song_nums FROM clean JOIN players USING ("userId") WHERE churn_users = 1',
        "players",
    ),
    "log_with_churned_plays_filtered": _sql(
        f"""SELECT {ROW}, CASE WHEN churn_users = 1 THEN song_nums END AS song_nums
            FROM clean LEFT JOIN players USING ("userId")""",
        "players",
    ),
    "facts_from_bucketed": _sql("SELECT * FROM facts", "facts"),
    "log_with_tenure_bucketed": _sql(
        f'SELECT {ROW}, delta_time FROM clean JOIN facts USING ("userId")', "facts"
    ),
    "quality_audit_by_file": _sql(
        """SELECT CAST(coalesce("sessionId", 0) % 3 AS INTEGER) AS part, count(*) AS n_rows,
               count(*) FILTER (WHERE "userId" IS NULL) AS "null_userId",
               count(*) FILTER (WHERE "sessionId" IS NULL) AS "null_sessionId",
               count(*) FILTER (WHERE "userId" = '') AS "blank_userId",
               count(*) FILTER (WHERE "sessionId" % 7 = 0) AS n_corrupt,
               count(*) FILTER (WHERE "userId" IS NOT NULL AND "sessionId" IS NOT NULL) AS n_without_nulls,
               count(*) FILTER (WHERE "sessionId" IS NOT NULL AND "userId" <> '') AS n_kept,
               count(*) - count(*) FILTER (WHERE "sessionId" IS NOT NULL AND "userId" <> '') AS n_removed
           FROM log GROUP BY 1""",
        "log",
    ),
    "corrupt_lines_by_file": _sql(
        """SELECT CAST("sessionId" % 3 AS INTEGER) AS part, "sessionId", count(*) AS n_lines,
               count(*) AS n_places FROM log WHERE "sessionId" % 7 = 0 GROUP BY ALL""",
        "log",
    ),
    "incomplete_features": _sql(
        """SELECT count(*) AS n_rows,
               count(*) FILTER (WHERE song_nums IS NULL OR delta_time IS NULL) AS n_incomplete,
               count(*) FILTER (WHERE song_nums IS NULL) AS null_song_nums,
               count(*) FILTER (WHERE delta_time IS NULL) AS null_delta_time FROM players""",
        "players",
    ),
    "baseline_leaderboard": _sql(
        f"""SELECT 'majority' AS model, CAST(0 AS INTEGER) AS grid_pos, {_majority_mean("vectors")} AS avg_f1""",
        "vectors",
    ),
    "baseline_best_params": _sql(
        f"""SELECT 'majority' AS model, CAST(0 AS INTEGER) AS grid_pos, {_majority_mean("vectors")} AS avg_f1""",
        "vectors",
    ),
    "baseline_validation": _sql(
        f"""SELECT 'majority' AS model,
                round({_majority("part = 'train'", "part = 'valid'", "vectors")}, 6) AS f1""",
        "vectors",
    ),
    "baseline_test": _sql(
        f"""SELECT 'majority' AS model,
                round({_majority("part = 'train'", "part = 'test'", "vectors")}, 6) AS f1""",
        "vectors",
    ),
    "baseline_by_grain": _sql(
        f"""SELECT 'user' AS grain, {_majority_mean("vectors")} AS avg_f1 UNION ALL
            SELECT 'event', {_majority_mean("event_vectors")}""",
        "vectors",
        "event_vectors",
    ),
    "logistic_slopes": _sql(
        _loss_slopes(
            "1 / (1 + exp(-m)) - y", "0", "greatest(m, 0) - y * m + ln(1 + exp(-abs(m)))"
        ),
        "vectors",
    ),
    "hinge_slopes": _sql(
        _loss_slopes(
            f"CASE WHEN (2 * y - 1) * m < 1 - {KINK} THEN 1 - 2 * y ELSE 0 END",
            f"CASE WHEN abs(1 - (2 * y - 1) * m) <= {KINK} THEN 1 - 2 * y ELSE 0 END",
            "greatest(1 - (2 * y - 1) * m, 0)",
        ),
        "vectors",
    ),
    "lr_optimality": _sql(_optimal(4), "vectors"),
    "svc_optimality": _sql(_optimal(2), "vectors"),
    "tree_splits": _sql(_splits(""), "vectors"),
    "tree_first_split": _sql(_splits("ORDER BY round(gain, 12) DESC, place LIMIT 1"), "vectors"),
    "rules_leaderboard": _sql(
        f"""SELECT model, grid_pos, round(f, 6) AS avg_f1, CAST(place AS INTEGER) AS place
            FROM {_rules_board()}""",
        "vectors",
    ),
    "rules_best_params": _sql(
        f"SELECT model, grid_pos, round(f, 6) AS avg_f1 FROM {_rules_board()} WHERE own = 1", "vectors"
    ),
    "rules_choice": _sql(
        f"""SELECT model, round(valid_f1, 6) AS f1, c = 1 AS chosen,
                   CASE WHEN c = 1 THEN round(test_f1, 6) END AS test_f1
            FROM (SELECT *, row_number() OVER (ORDER BY round(valid_f1, 12) DESC,
                            list_position(['plays_rule', 'tenure_rule', 'constant'], model)) AS c
                  FROM {_rules_board()} WHERE own = 1)""",
        "vectors",
    ),
    "facts_merged": _sql("SELECT * FROM facts", "facts"),
    "sink_rerun": _sql(f"SELECT {ROW}, {DAY.format('ts')} AS event_date FROM clean", "clean"),
    "users_by_range_sketch": _sql(
        f"""SELECT CAST(date_trunc('month', {DAY.format('ts')}) AS DATE) AS period,
                   count(DISTINCT "userId") AS users, true AS within_bound
            FROM clean WHERE ts IS NOT NULL GROUP BY 1""",
        "clean",
    ),
    "box_plays_sketch": _sql(
        "SELECT churn_users, count(*) AS n, true AS within_bound FROM players GROUP BY churn_users",
        "players",
    ),
    "distinct_users_approx": _sql(
        'SELECT count(*) AS users, true AS within_bound FROM (SELECT DISTINCT "userId" FROM log)', "log"
    ),
}
