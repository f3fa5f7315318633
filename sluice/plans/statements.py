"""SQL twins of the registered queries, for any engine with the tables as views."""

from sluice.plans.catalog import AS_OF, RELAY_START, RETENTION_DAYS, SAVE_INTERVAL

# The change events of the ``events`` table, with every payload as JSON text.
_CHANGES = """
raw AS (
  SELECT CAST(floor(epoch(ts)) AS BIGINT) AS t, event_id AS i, user_id,
         'app' AS db, 'users_' || CAST(user_id % 4 AS VARCHAR) AS coll,
         CASE event_type WHEN 'signup' THEN 'insert' WHEN 'purchase' THEN 'replace'
                         WHEN 'error' THEN 'delete' ELSE 'update' END AS op,
         event_type, replace(props, ' ', '') AS props,
         rtrim(rtrim(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '0'), '.') AS num
  FROM events
),
changes AS (
  SELECT t, i, db, coll, op,
         '82' || printf('%08X', t) || printf('%08X', i) AS token,
         '{"_id":' || user_id || '}' AS doc_key,
         '{"coll":"' || coll || '","db":"app"}' AS ns,
         CASE WHEN op = 'delete' THEN 'null' ELSE
           '{"_id":' || user_id || ',"event_type":"' || event_type || '","props":' || props
           || ',"value":' || num || '}' END AS doc,
         CASE WHEN op <> 'update' THEN 'null' ELSE
           '{"removedFields":[],"updatedFields":{"value":' || num || '}}' END AS upd,
         make_timestamp(t * 1000000) AS event_time,
         strftime(make_timestamp(t * 1000000), '%Y-%m-%d %H:%M:%S') AS time_text,
         (t - 2147483648) * 4294967296 + i AS seq
  FROM raw
),
c AS (SELECT *, '{"_data":"' || token || '"}' AS id FROM changes)
"""

_RECORD = "id || '|' || op || '|' || time_text || '|' || doc || '|' || ns || '|' || doc_key || '|' || upd"

_FIELDS = (
    'id AS "_id", op AS "operationType", time_text AS "clusterTime", {doc} AS "fullDocument", ns, '
    'doc_key AS "documentKey", upd AS "updateDescription"'
)

_DOCUMENT = (
    """'{"_id":' || id || ',"operationType":"' || op || '","clusterTime":"'"""
    """ || replace(time_text, ' ', 'T') || 'Z","ns":' || ns || ',"fullDocument":' || doc"""
    """ || ',"documentKey":' || doc_key || ',"updateDescription":' || upd || '}'"""
)

_LINE = f"""'{{"logType":"changeStream","cs":' || {_DOCUMENT} || '}}'"""


def _over_changes(select: str, more: str = "", recursive: bool = False) -> str:
    word = "WITH RECURSIVE" if recursive else "WITH"
    return f"{word} {_CHANGES}{more}\n{select}"


def _text_changes(table: str, coll: str, second: str, ordinal: str, key: str, doc: str) -> str:
    return f"""
WITH changes AS (
  SELECT 1704067200 + {second} AS t, {ordinal} AS i, 'insert' AS op,
         '{{"coll":"{coll}","db":"app"}}' AS ns, {key} AS doc_key, {doc} AS doc, 'null' AS upd
  FROM {table}
),
c AS (
  SELECT *, '{{"_data":"82' || printf('%08X', t) || printf('%08X', i) || '"}}' AS id,
         make_timestamp(t * 1000000) AS event_time,
         strftime(make_timestamp(t * 1000000), '%Y-%m-%d %H:%M:%S') AS time_text
  FROM changes
)
"""


def _markup(text: str) -> str:
    for plain, escaped in (("<", "003c"), (">", "003e"), ("&", "0026")):
        text = f"replace({text}, '{plain}', '\\u{escaped}')"
    return text


_CONVERSATIONS = _text_changes(
    "conversations",
    "conversations",
    "conv_id",
    "turn",
    """'{"_id":' || conv_id || ',"turn":' || turn || '}'""",
    """'{"_id":' || conv_id || ',"role":' || CAST(to_json(role) AS VARCHAR) || ',"text":'"""
    """ || CAST(to_json(text) AS VARCHAR) || ',"turn":' || turn || '}'""",
)
_DOCUMENTS = _text_changes(
    "documents",
    "documents",
    "doc_id",
    "0",
    """'{"_id":' || doc_id || '}'""",
    """'{"_id":' || doc_id || ',"lang":' || CAST(to_json(lang) AS VARCHAR) || ',"n_chars":'"""
    """ || n_chars || ',"source":' || CAST(to_json(source) AS VARCHAR) || ',"text":'"""
    """ || CAST(to_json(text) AS VARCHAR) || '}'""",
)
_PAGES = _text_changes(
    "pages",
    "pages",
    "page_id",
    "0",
    """'{"_id":' || page_id || '}'""",
    """'{"_id":' || page_id || ',"html":' || CAST(to_json(html) AS VARCHAR) || ',"url":'"""
    """ || CAST(to_json(url) AS VARCHAR) || '}'""",
)

_ROUTES = """,
routes(db, coll, destination, target) AS (
  VALUES ('app', 'users_0', 'bigquery', 'users_zero'),
         ('app', 'users_1', 'bigquery', 'users_one'),
         ('app', 'users_1', 'pubsub', 'users-one'),
         ('app', 'users_2', 'kinesisStream', 'users-two'),
         ('app', 'users_2', 'file', 'users_two')
)"""

_NEWEST = """,
newest AS (
  SELECT db, coll, doc_key, arg_max(op, seq) AS op, arg_max(doc, seq) AS doc
  FROM c {where} GROUP BY db, coll, doc_key
),
state AS (SELECT db, coll, doc_key, doc FROM newest WHERE op <> 'delete')"""

# Documents after the last event of each key, where updates only say what they changed: clicks set
# ``value`` and ``props.last``, views set ``props.seen``, remove ``props.last`` and cut ``recent`` to one.
def _folded(state: str, where: str = "") -> str:
    return f""",
p_{state} AS (
  SELECT db, coll, '{{"_id":' || user_id || '}}' AS doc_key, user_id, event_type, num, i, t,
         (t - 2147483648) * 4294967296 + i AS seq, op, rtrim(props, '}}') AS props
  FROM raw {where}
),
base_{state} AS (
  SELECT db, coll, doc_key, any_value(user_id) AS user_id, max(seq) AS seq, arg_max(op, seq) AS op,
         arg_max(event_type, seq) AS event_type, arg_max(num, seq) AS num, arg_max(props, seq) AS props, arg_max(i, seq) AS i
  FROM p_{state} WHERE event_type IN ('signup', 'purchase', 'error') GROUP BY db, coll, doc_key
),
later_{state} AS (
  SELECT p.db, p.coll, p.doc_key, arg_max(p.num, p.seq) FILTER (p.event_type = 'click') AS num,
         arg_max(p.i, p.seq) FILTER (p.event_type = 'click') AS clicked, max(p.seq) FILTER (p.event_type = 'click') AS click_seq,
         arg_max(p.i, p.seq) FILTER (p.event_type = 'view') AS seen, max(p.seq) FILTER (p.event_type = 'view') AS view_seq
  FROM p_{state} p JOIN base_{state} b ON b.db = p.db AND b.coll = p.coll AND b.doc_key = p.doc_key
  WHERE p.op = 'update' AND p.seq > b.seq GROUP BY p.db, p.coll, p.doc_key
),
{state} AS (
  SELECT b.db, b.coll, b.doc_key,
         '{{"_id":' || b.user_id || ',"event_type":"' || b.event_type || '","props":' || b.props
         || CASE WHEN l.clicked IS NOT NULL AND (l.view_seq IS NULL OR l.view_seq < l.click_seq) THEN ',"last":' || l.clicked ELSE '' END
         || CASE WHEN l.seen IS NOT NULL THEN ',"seen":' || l.seen ELSE '' END || '}},"recent":[' || b.i
         || CASE WHEN l.seen IS NULL THEN ',' || (b.i + 1) || ',' || (b.i + 2) ELSE '' END
         || '],"value":' || coalesce(l.num, b.num) || '}}' AS doc
  FROM base_{state} b LEFT JOIN later_{state} l ON l.db = b.db AND l.coll = b.coll AND l.doc_key = b.doc_key WHERE b.op <> 'delete'
)"""


_SAVES = f""",
seconds AS (
  SELECT db, coll, t, arg_min(token, i) AS token, min(i) AS i FROM c GROUP BY db, coll, t
),
saves(db, coll, t) AS (
  SELECT db, coll, min(t) FROM seconds GROUP BY db, coll
  UNION ALL
  SELECT s.db, s.coll, (
    SELECT min(n.t) FROM seconds n
    WHERE n.db = s.db AND n.coll = s.coll AND n.t > s.t + {SAVE_INTERVAL}
  ) FROM saves s WHERE s.t IS NOT NULL
)"""

_THROTTLED = _over_changes(
    'SELECT s.db, s.coll, n.token, n.t AS "T", n.i AS "I" '
    "FROM saves s JOIN seconds n ON n.db = s.db AND n.coll = s.coll AND n.t = s.t",
    _SAVES,
    recursive=True,
)

_LAST = _over_changes(
    'SELECT db, coll, arg_max(token, seq) AS token, arg_max(t, seq) AS "T", '
    'arg_max(i, seq) AS "I" FROM c GROUP BY db, coll'
)

_DELIVERED = _over_changes(
    "SELECT 'bigquery' AS destination, id || '|' || op || '|' || t || '|' || doc || '|' || ns"
    " || '|' || doc_key || '|' || upd AS body FROM c"
    f" UNION ALL SELECT 'pubsub', {_RECORD} FROM c"
    f" UNION ALL SELECT 'kinesisStream', token || ' ' || {_RECORD} || chr(10) FROM c"
    f" UNION ALL SELECT 'file', {_LINE} FROM c"
)

_TOKENS_AFTER = (
    f', head AS (SELECT max(seq) AS seq FROM c WHERE t < {RELAY_START})'
)

STATEMENTS: dict[str, str] = {
    "change_log_scan": _over_changes(
        'SELECT token, op AS "operationType", t AS "T", i AS "I", db, coll, id AS "_id", '
        'doc AS "fullDocument", ns, doc_key AS "documentKey", upd AS "updateDescription" FROM c'
    ),
    "change_log_archive": _over_changes(
        'SELECT token, t AS "T", i AS "I", db, coll, CAST(CAST(event_time AS DATE) AS VARCHAR) AS cluster_date '
        f"FROM c WHERE t > {RELAY_START} OR (t = {RELAY_START} AND i > 0)"
    ),
    "namespace_filter": _over_changes(
        'SELECT token, op AS "operationType", db, coll FROM c '
        "WHERE db = 'app' AND coll = 'users_2'"
    ),
    "resume_after_token": _over_changes(
        'SELECT token, t AS "T", i AS "I" FROM c WHERE seq > (SELECT seq FROM head)',
        _TOKENS_AFTER,
    ),
    "resume_each_collection": _over_changes(
        'SELECT c.token, c.coll, c.t AS "T", c.i AS "I" FROM c '
        "LEFT JOIN saved ON saved.db = c.db AND saved.coll = c.coll "
        "WHERE saved.seq IS NULL OR c.seq > saved.seq",
        f", saved AS (SELECT db, coll, max(seq) AS seq FROM c "
        f"WHERE t < {RELAY_START} AND coll <> 'users_3' GROUP BY db, coll)",
    ),
    "start_latest": _over_changes(
        'SELECT token, t AS "T", i AS "I" FROM c WHERE seq > (SELECT seq FROM head)',
        _TOKENS_AFTER,
    ),
    "indexed_start": _over_changes(
        'SELECT c.token, c.coll, c.t AS "T", c.i AS "I" FROM c '
        "LEFT JOIN saved ON saved.db = c.db AND saved.coll = c.coll "
        "WHERE saved.seq IS NULL OR c.seq > saved.seq",
        f", saved AS (SELECT db, coll, max(seq) AS seq FROM c WHERE t < {RELAY_START} GROUP BY db, coll)",
    ),
    "event_header": _over_changes('SELECT token, db, coll, op AS "operationType" FROM c'),
    "cluster_time": _over_changes("SELECT token, event_time AS cluster_time FROM c"),
    "cluster_time_text": _over_changes(
        "SELECT token, time_text AS utc_text, "
        "strftime(event_time + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS zone_text FROM c"
    ),
    "cluster_time_rfc3339": _over_changes(
        "SELECT token, strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') AS utc_text, "
        "strftime(event_time + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S+09:00') AS zone_text FROM c"
    ),
    "json_encode_fields": _over_changes(
        'SELECT id, doc AS "fullDocument", ns, doc_key AS "documentKey", '
        'upd AS "updateDescription" FROM c'
    ),
    "null_literal": _over_changes(
        'SELECT op AS "operationType", count(*) AS events, '
        "count(*) FILTER (WHERE doc = 'null') AS null_documents, "
        "count(*) FILTER (WHERE upd = 'null') AS null_updates FROM c GROUP BY op"
    ),
    "token_extract": _over_changes('SELECT token, t AS "T", i AS "I" FROM c'),
    "warehouse_row": _over_changes(
        'SELECT id, op AS "operationType", event_time AS "clusterTime", doc AS "fullDocument", ns, '
        'doc_key AS "documentKey", upd AS "updateDescription" FROM c'
    ),
    "warehouse_row_markup": _PAGES
    + 'SELECT id, op AS "operationType", event_time AS "clusterTime", '
    + f'{_markup("doc")} AS "fullDocument", ns, doc_key AS "documentKey", '
    + 'upd AS "updateDescription" FROM c',
    "delimited_record": _over_changes(f"SELECT {_RECORD} AS value FROM c"),
    "delimited_record_text": _CONVERSATIONS
    + "SELECT "
    + _RECORD.replace("doc ||", f"{_markup('doc')} ||", 1)
    + " AS value FROM c",
    "parse_delimited": _over_changes(
        f"SELECT {_FIELDS.format(doc='doc')}, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS raw FROM c"
    ),
    "parse_delimited_text": _CONVERSATIONS
    + f"SELECT {_FIELDS.format(doc=_markup('doc'))}, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS raw FROM c"
    + " UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'not a record of seven fields',"
    + " substr(value, 1, length(value) // 2) FROM (SELECT "
    + _RECORD.replace("doc ||", f"{_markup('doc')} ||", 1)
    + " AS value FROM c)",
    "keyed_record": _over_changes(
        f"SELECT 'changes' AS stream, token AS partition_key, {_RECORD} || chr(10) AS value FROM c"
    ),
    "ordering_key": _over_changes("SELECT token, doc_key AS ordering_key FROM c"),
    "file_document": _over_changes(f"SELECT {_DOCUMENT} AS document FROM c"),
    "file_envelope": _over_changes(
        f"""SELECT '{{"logType":"audit","change":' || {_DOCUMENT} || '}}' AS value FROM c"""
    ),
    "file_envelope_text": _DOCUMENTS + f"SELECT {_LINE} AS value FROM c",
    "full_document_lookup": _over_changes(
        'SELECT c.token, c.op AS "operationType", c.doc_key AS "documentKey", '
        "CASE WHEN c.op = 'update' THEN coalesce(state.doc, 'null') ELSE c.doc END "
        'AS "fullDocument" FROM c LEFT JOIN state ON state.db = c.db '
        "AND state.coll = c.coll AND state.doc_key = c.doc_key",
        _NEWEST.format(where=""),
    ),
    "current_state": _over_changes(
        'SELECT db, coll, doc_key AS "documentKey", doc AS "fullDocument" FROM state',
        _NEWEST.format(where=""),
    ),
    "state_as_of": _over_changes(
        'SELECT db, coll, doc_key AS "documentKey", doc AS "fullDocument" FROM state',
        _NEWEST.format(where=f"WHERE t <= {AS_OF}"),
    ),
    "state_from_updates": _over_changes(
        'SELECT db, coll, doc_key AS "documentKey", doc AS "fullDocument" FROM state',
        _folded("state"),
    ),
    "state_from_bases": _over_changes(
        'SELECT db, coll, doc_key AS "documentKey", doc AS "fullDocument" FROM state',
        _folded("state", f"WHERE t <= {AS_OF}"),
    ),
    "lookup_relay": _over_changes(
        """SELECT p.id, p.op AS "operationType", CASE p.op WHEN 'delete' THEN 'null'
             WHEN 'update' THEN coalesce(CASE WHEN p.t < {start} THEN early.doc ELSE late.doc END, 'null')
             ELSE '{{"_id":' || p.user_id || ',"event_type":"' || p.event_type || '","props":' || p.props || ',"recent":['
               || p.i || ',' || (p.i + 1) || ',' || (p.i + 2) || '],"value":' || p.num || '}}' END AS "fullDocument"
           FROM (SELECT raw.*, '{{"_id":' || user_id || '}}' AS doc_key,
                   '{{"_data":"82' || printf('%08X', t) || printf('%08X', i) || '"}}' AS id FROM raw) p
           LEFT JOIN early ON early.db = p.db AND early.coll = p.coll AND early.doc_key = p.doc_key
           LEFT JOIN late ON late.db = p.db AND late.coll = p.coll AND late.doc_key = p.doc_key""".format(start=RELAY_START),
        _folded("early", f"WHERE t < {RELAY_START}") + _folded("late"),
    ),
    "relay_audit": _over_changes(
        'SELECT db, coll, op AS "operationType", count(*) AS events, max(event_time) AS last_time '
        "FROM c GROUP BY db, coll, op"
    ),
    "last_position": _LAST,
    "ordered_delivery": _over_changes(
        "SELECT doc_key AS ordering_key, seq AS sequence, token FROM c"
    ),
    "warehouse_sink": _over_changes(
        'SELECT id, op AS "operationType", event_time AS "clusterTime", \'changes\' AS "table", '
        "CAST(CAST(event_time AS DATE) AS VARCHAR) AS cluster_date, CAST(0 AS BIGINT) AS batch_id FROM c"
    ),
    "compacted_sink": _over_changes(
        'SELECT id, op AS "operationType", event_time AS "clusterTime", \'changes\' AS "table", '
        "CAST(CAST(event_time AS DATE) AS VARCHAR) AS cluster_date FROM c"
    ),
    "topic_sink": _over_changes(
        "SELECT 'changes' AS topic, doc_key AS ordering_key, seq AS sequence, "
        f"{_RECORD} AS value FROM c"
    ),
    "keyed_stream_sink": _over_changes(
        f"SELECT 'changes' AS stream, token AS partition_key, {_RECORD} || chr(10) AS value FROM c"
    ),
    "file_sink": _over_changes(
        f"SELECT 'changes' AS log, CAST(CAST(event_time AS DATE) AS VARCHAR) AS cluster_date, {_LINE} AS value FROM c"
    ),
    "rolled_file_sink": _over_changes(
        f"SELECT 'changes' AS log, CAST(CAST(event_time AS DATE) AS VARCHAR) AS cluster_date, {_LINE} AS value, true AS within_limit FROM c"
    ),
    "partition_expiration": _over_changes(
        "SELECT id, CAST(CAST(event_time AS DATE) AS VARCHAR) AS cluster_date FROM c "
        f"WHERE event_time >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL {RETENTION_DAYS} DAY"
    ),
    "route_by_collection": _over_changes(
        "SELECT c.token, c.db, c.coll, r.destination, r.target FROM c "
        "JOIN routes r ON r.db = c.db AND r.coll = c.coll",
        _ROUTES,
    ),
    "fan_out": _DELIVERED,
    "replay_idempotent": _DELIVERED,
    "position_ledger": _LAST,
    "throttled_ledger": _THROTTLED,
    "throttled_ledger_stream": _THROTTLED,
    "quarantine": _over_changes(
        "SELECT 'valid' AS outcome, count(*) AS events, CAST(0 AS BIGINT) AS raw_lines FROM c "
        "UNION ALL SELECT CASE WHEN i % 6 IN (0, 5) THEN 'not one JSON object' "
        "WHEN i % 6 = 1 THEN '_id holds no _data string' "
        "WHEN i % 6 = 2 THEN 'no operationType' WHEN i % 6 = 3 THEN 'no clusterTime' "
        "ELSE 'no ns.db and ns.coll' END, count(*), count(*) FROM c GROUP BY 1"
    ),
    "dedupe_token": _over_changes(
        'SELECT token, op AS "operationType", coll, doc AS "fullDocument" FROM c'
    ),
}
STATEMENTS["partition_expiration_filter"] = STATEMENTS["partition_expiration"]
STATEMENTS["dedupe_stream"] = STATEMENTS["compacted_sink"]
