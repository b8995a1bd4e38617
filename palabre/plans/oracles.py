"""The same results as the queries, in SQL over the test tables."""

from __future__ import annotations

_TIME = "'%Y-%m-%d %H:%M:%S'"

_MESSAGES = """messages AS (
    SELECT CAST(doc_id AS VARCHAR) AS id, text AS message,
           TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS created,
           source AS user_id, lang AS chat_id, '' AS type
    FROM documents)"""

_VERDICTS = """verdicts AS (
    SELECT CAST(doc_id AS VARCHAR) AS id_message,
           CASE WHEN toxic = 0 THEN 'true' ELSE 'false' END AS valide,
           TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS date
    FROM labels)"""

_ORDER_MESSAGES = """messages AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS message,
           CAST(o_orderdate AS TIMESTAMP) AS created, CAST(o_custkey AS VARCHAR) AS user_id,
           o_orderstatus AS chat_id, '' AS type
    FROM orders)"""

_LINE_VERDICTS = """verdicts AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS id_message,
           CASE WHEN l_returnflag = 'R' THEN 'false' ELSE 'true' END AS valide,
           l_shipdate AS date
    FROM lineitem)"""

_USERS = f"""users AS (
    SELECT c_name AS nom,
           'customer.' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || '@example.com' AS email,
           'pass' || c_custkey AS password,
           TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey) AS date_inscription
    FROM customer)"""


def _credentials(word: str = "pass") -> str:
    return f"""credentials AS (
    SELECT 'customer.' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '@example.com' AS email,
           CASE WHEN o_orderstatus = 'O' THEN 'no' ELSE '{word}' END || o_custkey AS password
    FROM orders)"""


_REGISTRATIONS = """registrations AS (
    SELECT o_orderkey AS request, o_orderpriority AS nom,
           'customer.' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '@example.com' AS email,
           o_orderdate AS date_inscription
    FROM orders)"""

_KNOWN_USERS = """known AS (
    SELECT 'customer.' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || '@example.com' AS email
    FROM customer WHERE c_mktsegment = 'BUILDING')"""

_PRODUCTS = """products AS (
    SELECT CAST(p_partkey AS INTEGER) AS produit_id, p_name AS nom, p_brand AS categorie,
           p_retailprice AS prix
    FROM part)"""

_PURCHASES = f"""purchases AS (
    SELECT CAST(l_orderkey * 8 + l_linenumber AS INTEGER) AS achat_id,
           CAST(l_partkey AS INTEGER) AS produit_id,
           strftime(l_shipdate, {_TIME}) AS date_achat,
           CAST(l_suppkey AS INTEGER) AS client_id, CAST(l_quantity AS INTEGER) AS quantite,
           l_extendedprice AS montant_total, l_returnflag
    FROM lineitem)"""

_RAW_MESSAGES = f"""raw AS (
    SELECT event_id,
           CASE WHEN user_id < 10 THEN NULL
                WHEN event_type = 'click' THEN
                  '{{"message":"click ' || event_id || '","Created_At":"' || strftime(ts, {_TIME})
                  || '","user_id":"' || user_id || '","chat_id":"0","type":""}}'
                WHEN event_type = 'view' THEN
                  '{{"message":"view ' || event_id || '","created_at":"' || strftime(ts, {_TIME})
                  || '","user_id":"' || user_id || '","chat_id":"0","type":""}}'
                WHEN event_type = 'purchase' THEN
                  '{{"message":' || event_id || ',"Created_At":"nope","user_id":' || user_id
                  || ',"chat_id":"0","type":""}}'
                WHEN event_type = 'signup' THEN
                  '{{"user_id":"' || user_id || '","chat_id":"0","type":""}}'
                ELSE '{{"message":"error ' || event_id || '","user_id":"' || user_id
           END AS record
    FROM events),
parsed AS (
    SELECT event_id, record,
           CASE WHEN json_valid(record) THEN CAST(record AS JSON) END AS data
    FROM raw)"""


def _message_fields(time: str = "data->>'$.Created_At'") -> str:
    return f"""data->>'$.message' AS message,
       strftime(TRY_CAST({time} AS TIMESTAMP), {_TIME}) AS "Created_At",
       data->>'$.user_id' AS user_id, data->>'$.chat_id' AS chat_id, data->>'$.type' AS type"""


_STATUS = f"""SELECT m.id AS message_id, m.message, strftime(m.created, {_TIME}) AS "Created_At",
       m.user_id, m.chat_id, m.type, {{valide}} AS valide
FROM messages m LEFT JOIN {{verdicts}} v ON m.id = v.id_message"""

_STATUS_ROWS = _STATUS.format(valide="COALESCE(v.valide, 'false')", verdicts="verdicts")

_LATEST = """(SELECT id_message, arg_max(valide, date) AS valide
              FROM verdicts GROUP BY id_message)"""

_COPIES = """copies AS (
    SELECT m.id AS message_id, m.message, m.created, m.user_id, m.chat_id, m.type,
           COALESCE(v.valide, 'false') AS valide, COUNT(*) AS copies
    FROM messages m LEFT JOIN verdicts v ON m.id = v.id_message
    GROUP BY ALL)"""


#: What a reply must hold, whatever its cut: the records, and that its keys are right.
_RECORDS = """SELECT record, CAST(SUM(copies) AS BIGINT) AS copies FROM records GROUP BY record
    UNION ALL SELECT 'keys and sizes are right', 1"""


def _message_json(with_id: bool) -> str:
    head = "'message_id': message_id, " if with_id else ""
    return f"""CAST(to_json({{{head}'message': message,
        'Created_At': strftime(created, '%Y-%m-%dT%H:%M:%S.000Z'), 'user_id': user_id,
        'chat_id': chat_id, 'type': type, 'valide': valide}}) AS VARCHAR)"""


def _message_records(with_id: bool) -> str:
    return f"""records AS (
    SELECT {_message_json(with_id)} AS record, copies
    FROM copies)"""


_CUSTOMER_JSON = """CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name,
    'c_nationkey': c_nationkey, 'c_acctbal': c_acctbal, 'c_mktsegment': c_mktsegment}) AS VARCHAR)"""

_SUPPLIER_JSON = """CAST(to_json({'s_suppkey': s_suppkey, 's_name': s_name,
    's_nationkey': s_nationkey, 's_acctbal': s_acctbal}) AS VARCHAR)"""

_NORMALIZED = """md5(conv_id || ':' || turn) AS id,
       CASE WHEN role = 'system' THEN '' ELSE role END AS user_id, text AS message"""


def _label(message: str) -> str:
    def count(mark: str) -> str:
        return f"length({message}) - length(replace({message}, '{mark}', ''))"

    return f"CASE WHEN {count('.')} >= {count(',')} THEN 'inapproprié' ELSE 'approprié' END"


_ENRICHED = """FROM purchases a JOIN products p ON a.produit_id = p.produit_id"""

ORACLES: dict[str, str] = {
    "messages_with_status": f"WITH {_MESSAGES}, {_VERDICTS} {_STATUS_ROWS}",
    "messages_with_many_verdicts": f"WITH {_ORDER_MESSAGES}, {_LINE_VERDICTS} {_STATUS_ROWS}",
    "messages_with_latest_verdict": f"WITH {_MESSAGES}, {_VERDICTS} "
    + _STATUS.format(valide="COALESCE(v.valide, 'false')", verdicts=_LATEST),
    "messages_raw_left_join": f"""WITH {_MESSAGES}, {_VERDICTS}
        SELECT id, message, strftime(created, {_TIME}) AS "Created_At", user_id, chat_id, type,
               v.id_message AS metadata_id_message, v.valide AS metadata_valide,
               strftime(v.date, {_TIME}) AS metadata_date
        FROM messages m LEFT JOIN verdicts v ON m.id = v.id_message""",
    "message_status_counts": f"""WITH {_ORDER_MESSAGES}, {_LINE_VERDICTS}, {_COPIES}
        SELECT message_id, valide, copies FROM copies""",
    "reply_messages_json": f"""WITH {_MESSAGES}, {_VERDICTS}, {_COPIES},
        {_message_records(True)} {_RECORDS}""",
    "reply_messages_with_copies": f"""WITH {_ORDER_MESSAGES}, {_LINE_VERDICTS}, {_COPIES},
        {_message_records(False)} {_RECORDS}""",
    "normalize_message": f"""SELECT {_NORMALIZED}, '' AS type, '0' AS chat_id,
        '2024-05-06 07:08:09' AS "Created_At" FROM conversations""",
    "route_topics": """WITH routed AS (
            SELECT event_id, CASE event_type WHEN 'signup' THEN 'register'
                WHEN 'view' THEN 'ia_message' WHEN 'click' THEN 'send_message'
                WHEN 'error' THEN 'get_users' END AS topic
            FROM events),
        readers(topic, destination) AS (VALUES ('register', 'spark'), ('ia_message', 'spark'),
            ('ia_message', 'backend'), ('send_message', 'classifier'), ('get_users', 'backend'))
        SELECT event_id, topic, destination FROM routed LEFT JOIN readers USING (topic)""",
    "classify_messages": f"""SELECT CAST(doc_id AS VARCHAR) AS id, text AS message,
        {_label('text')} AS type FROM documents""",
    "users_if_authenticated": f"""WITH {_USERS}, {_credentials()}
        SELECT nom, email, strftime(date_inscription, {_TIME}) AS date_inscription FROM users
        WHERE EXISTS (SELECT 1 FROM users u JOIN credentials c USING (email, password))""",
    "login_matches": f"""WITH {_USERS}, {_credentials()}
        SELECT nom, email FROM users u WHERE EXISTS (
            SELECT 1 FROM credentials c WHERE c.email = u.email AND c.password = u.password)""",
    "reply_users_json": f"""WITH {_USERS}, records AS (
            SELECT 1 AS copies, CAST(to_json({{'nom': nom, 'email': email,
                'date_inscription': strftime(date_inscription, '%Y-%m-%dT%H:%M:%S.000Z')}})
                AS VARCHAR) AS record
            FROM users) {_RECORDS}""",
    "users_auth_failed": f"""WITH {_USERS}, {_credentials('wrong')}
        SELECT CAST(NULL AS VARCHAR) AS key, '{{"error":"Utilisateur non trouvé"}}' AS value
        WHERE NOT EXISTS (SELECT 1 FROM users u JOIN credentials c USING (email, password))""",
    "register_unique": f"""WITH {_REGISTRATIONS}, {_KNOWN_USERS}, ranked AS (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY email
                ORDER BY date_inscription, request) AS rank
            FROM registrations)
        SELECT request, nom, email, strftime(date_inscription, {_TIME}) AS date_inscription
        FROM ranked WHERE rank = 1 AND email NOT IN (SELECT email FROM known)""",
    "table_as_json": f"""WITH records AS (
            SELECT 1 AS copies, {_CUSTOMER_JSON} AS record
            FROM customer) {_RECORDS}""",
    "table_as_json_strings": f"""WITH records AS (
            SELECT {_SUPPLIER_JSON} AS record, COUNT(*) AS copies
            FROM supplier GROUP BY ALL) {_RECORDS}""",
    "repeated_rows_as_json": f"""WITH records AS (
            SELECT CAST(to_json({{'l_returnflag': l_returnflag, 'l_linestatus': l_linestatus}})
                AS VARCHAR) AS record, COUNT(*) AS copies
            FROM lineitem GROUP BY ALL) {_RECORDS}""",
    "envelope": f"SELECT CAST(NULL AS VARCHAR) AS key, {_CUSTOMER_JSON} AS value FROM customer",
    "assign_record_id": """SELECT md5(event_type || ':' || user_id || ':' || event_id) AS id,
        event_type, user_id, event_id FROM events""",
    "decode_records": """SELECT CAST(NULL AS VARCHAR) AS key, CAST(to_json({'c_custkey': c_custkey,
        'c_name': c_name}) AS VARCHAR) AS raw_data FROM customer""",
    "producer_times": f"""SELECT event_id,
        strftime(ts - INTERVAL 9 HOUR, {_TIME}) AS utc FROM events""",
    "ingest_valid": f"""WITH {_RAW_MESSAGES}
        SELECT md5('ia_message:0:' || event_id) AS id, {_message_fields()}
        FROM parsed WHERE data->>'$.message' IS NOT NULL""",
    "ingest_invalid": f"""WITH {_RAW_MESSAGES}
        SELECT record AS corrupt_record
        FROM parsed WHERE record IS NOT NULL AND (data->>'$.message') IS NULL""",
    "ingest_stats": f"""WITH {_RAW_MESSAGES}
        SELECT COUNT(data->>'$.message') AS valid,
               COUNT(*) FILTER (record IS NOT NULL AND (data->>'$.message') IS NULL) AS invalid,
               COUNT(*) FILTER (record IS NULL) AS tombstones, COUNT(*) AS total
        FROM parsed""",
    "ingest_aliases_and_required": f"""WITH {_RAW_MESSAGES}, timed AS (
            SELECT data, COALESCE(TRY_CAST(data->>'$.Created_At' AS TIMESTAMP),
                TRY_CAST(data->>'$.created_at' AS TIMESTAMP)) AS time
            FROM parsed)
        SELECT {_message_fields('time')} FROM timed
        WHERE (data->>'$.message') IS NOT NULL AND time IS NOT NULL""",
    "ingest_keyed_products": f"""WITH {_PRODUCTS}
        SELECT p.* FROM products p JOIN part ON produit_id = p_partkey WHERE p_size <= 40""",
    "ingest_rejected_products": """SELECT CAST(p_partkey AS VARCHAR) AS produit_id
        FROM part WHERE p_size > 40""",
    "ingest_keyed_purchases": f"""WITH {_PURCHASES}
        SELECT * EXCLUDE (l_returnflag) FROM purchases WHERE l_returnflag <> 'R'""",
    "ingest_purchases_stats": """SELECT COUNT(*) FILTER (l_returnflag <> 'R') AS valid,
        COUNT(*) FILTER (l_returnflag = 'R') AS invalid, CAST(0 AS BIGINT) AS tombstones,
        COUNT(*) AS total FROM lineitem""",
    "ingest_dated_users": f"""SELECT CAST(user_id AS INTEGER) AS user_id, event_type AS nom,
        'e' || event_id || '@example.com' AS email, strftime(ts, {_TIME}) AS date_inscription,
        CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
        CAST(day(ts) AS INTEGER) AS day
        FROM events WHERE event_type <> 'error'""",
    "enrich_purchases": f"""WITH {_PRODUCTS}, {_PURCHASES}
        SELECT achat_id, a.produit_id, date_achat, client_id, quantite,
               ROUND(prix * quantite, 2) AS montant_total, nom, categorie, prix
        {_ENRICHED}""",
    "purchase_amount_mismatches": f"""WITH {_PRODUCTS}, {_PURCHASES}
        SELECT achat_id, a.produit_id, date_achat, client_id, quantite, montant_total,
               ROUND(prix * quantite, 2) AS montant_attendu
        {_ENRICHED} WHERE montant_total IS DISTINCT FROM ROUND(prix * quantite, 2)""",
    "products_min_price": f"WITH {_PRODUCTS} SELECT * FROM products WHERE prix >= 950",
    "branch_on_match": f"""WITH {_PRODUCTS} SELECT CASE WHEN EXISTS (
        SELECT 1 FROM products WHERE prix >= 950) THEN 'action1' ELSE 'action2' END AS branch""",
    "branch_on_no_match": f"""WITH {_PRODUCTS} SELECT CASE WHEN EXISTS (
        SELECT 1 FROM products WHERE prix >= 2000) THEN 'action1' ELSE 'action2' END AS branch""",
    "preview_table": f"WITH {_PRODUCTS} SELECT * FROM products ORDER BY produit_id LIMIT 10",
    "append_roundtrip": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "overwrite_roundtrip": """SELECT c_name AS nom, c_mktsegment AS prenom,
        CAST(c_nationkey AS INTEGER) AS age, c_acctbal AS ca FROM customer""",
    "bucketed_roundtrip": f"WITH {_ORDER_MESSAGES}, {_LINE_VERDICTS} {_STATUS_ROWS}",
    "parquet_roundtrip": f"""SELECT CAST(o_orderkey AS INTEGER) AS id, o_orderpriority AS value,
        strftime(o_orderdate, {_TIME}) AS load_ts FROM orders""",
    "external_roundtrip": f"WITH {_PRODUCTS} SELECT * FROM products",
    "read_json_file": "SELECT * FROM customer",
    "publish_roundtrip": f"SELECT 'suppliers' AS topic, {_SUPPLIER_JSON} AS raw_data FROM supplier",
    "stream_ingest": f"""WITH {_RAW_MESSAGES}
        SELECT {_message_fields()}, TRUE AS distinct_ids FROM parsed
        WHERE data->>'$.message' IS NOT NULL""",
    "stream_quarantine": f"""WITH {_RAW_MESSAGES}
        SELECT record AS corrupt_record
        FROM parsed WHERE record IS NOT NULL AND (data->>'$.message') IS NULL""",
    "stream_responder": f"""WITH {_USERS}, {_credentials()}
        SELECT nom, email FROM users
        WHERE EXISTS (SELECT 1 FROM users u JOIN credentials c USING (email, password))""",
    "stream_registration": f"""WITH {_REGISTRATIONS}
        SELECT email, strftime(MIN(date_inscription), {_TIME}) AS date_inscription
        FROM registrations GROUP BY email""",
    "stream_classifier": f"""SELECT md5(conv_id || ':' || turn) AS id, text AS message,
        {_label('text')} AS type FROM conversations""",
    "classify_with_pandas": f"""SELECT CAST(doc_id AS VARCHAR) AS id, text AS message,
        {_label('text')} AS type FROM documents""",
    "classify_with_model": """SELECT CAST(o_orderkey AS VARCHAR) AS id, TRUE AS known_label,
        TRUE AS agrees_with_rule FROM orders""",
    "reply_cut_by_bytes": f"""WITH records AS (
            SELECT CAST(to_json({{'doc_id': doc_id, 'text': text}}) AS VARCHAR) AS record, 1 AS copies
            FROM documents) {_RECORDS}""",
    "reply_nameless_messages": f"""WITH records AS (
            SELECT CAST(to_json({{'message': text, 'Created_At':
                strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(turn), '%Y-%m-%dT%H:%M:%S.000Z'),
                'user_id': role, 'chat_id': CAST(conv_id AS VARCHAR), 'type': '', 'valide': 'false'}})
                AS VARCHAR) AS record, 1 AS copies
            FROM conversations) {_RECORDS}""",
    "table_reply_all_columns": f"""WITH records AS (
            SELECT CAST(to_json({{'n_nationkey': n_nationkey, '_n': n_name}}) AS VARCHAR) AS record,
                1 AS copies
            FROM nation) {_RECORDS}""",
    "stream_messages_reply": f"""WITH {_MESSAGES}, {_VERDICTS}, {_COPIES},
        {_message_records(True)} {_RECORDS}""",
    "compacted_roundtrip": "SELECT * FROM customer",
    "compacted_while_read": """WITH steps(before, step) AS (
            SELECT b, s FROM (VALUES (3), (6)) AS x(b), (VALUES ('leftovers dropped'), ('target hidden'),
                ('rows copied'), ('swapped')) AS y(s)
            UNION ALL SELECT 6, 'old batches dropped')
        SELECT CAST(before AS INTEGER) AS before, step, c_mktsegment, COUNT(*) AS rows,
               COUNT(DISTINCT c_custkey) AS customers
        FROM customer, steps GROUP BY ALL""",
    "publish_replayed": f"""WITH {_RAW_MESSAGES}
        SELECT {_message_fields()}, TRUE AS distinct_ids FROM parsed
        WHERE data->>'$.message' IS NOT NULL""",
    "stream_responder_mixed": f"""WITH {_USERS}, {_credentials()}
        SELECT c.email AS key, CASE WHEN bool_or(u.email IS NOT NULL) THEN 'users'
            ELSE '{{"error":"Utilisateur non trouvé"}}' END AS answer
        FROM credentials c LEFT JOIN users u ON u.email = c.email AND u.password = c.password
        GROUP BY c.email""",
    "stream_registration_stateful": f"""WITH {_REGISTRATIONS}, {_KNOWN_USERS}
        SELECT email, strftime(COALESCE(MIN(date_inscription) FILTER (request % 2 = 0),
            MIN(date_inscription)), {_TIME}) AS date_inscription
        FROM registrations WHERE email NOT IN (SELECT email FROM known) GROUP BY email""",
    "stream_kept_status": f"""WITH {_ORDER_MESSAGES}, {_LINE_VERDICTS}, {_COPIES}
        SELECT message_id, valide, copies FROM copies""",
    "stream_classifier_updated": """SELECT CAST(o_orderkey AS VARCHAR) AS id, urgent,
            CASE WHEN urgent = (o_orderkey % 2 = 0) THEN 'inapproprié' ELSE 'approprié' END AS type
        FROM (SELECT *, contains(o_orderpriority, 'URGENT') OR contains(o_orderpriority, 'HIGH') AS urgent
              FROM orders)""",
    "stream_router_changed": """SELECT 'spark' AS reader, COUNT(*) FILTER (event_id % 3 < 2) AS records FROM events
        UNION ALL SELECT 'backend', COUNT(*) FILTER (event_id % 3 = 1) FROM events
        UNION ALL SELECT 'nobody', COUNT(*) FILTER (event_id % 3 = 2) FROM events""",
    "stream_ingest_restarted": f"""WITH {_RAW_MESSAGES}
        SELECT {_message_fields()}, TRUE AS distinct_ids FROM parsed
        WHERE data->>'$.message' IS NOT NULL""",
    "stream_registration_restarted": f"""WITH {_REGISTRATIONS}
        SELECT email, CAST(1 AS BIGINT) AS times FROM registrations GROUP BY email""",
    "stream_registration_rejects": """SELECT CASE WHEN event_type = 'error' THEN 'cut {'
            ELSE '{"email":"e' || user_id || '"}' END AS corrupt_record
        FROM events WHERE event_type <> 'click'""",
    "stream_classifier_rejects": f"""WITH {_RAW_MESSAGES}
        SELECT record AS corrupt_record
        FROM parsed WHERE record IS NOT NULL AND (data->>'$.message') IS NULL""",
    "stream_chat": f"""WITH records AS (
            SELECT CAST(to_json({{'message': text, 'Created_At': '2024-05-06T07:08:09.000Z',
                'user_id': CASE WHEN role = 'system' THEN '' ELSE role END, 'chat_id': '0',
                'type': {_label('text')}, 'valide': 'false'}}) AS VARCHAR) AS record, 1 AS copies
            FROM conversations) {_RECORDS}""",
}
