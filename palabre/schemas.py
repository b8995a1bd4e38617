"""Record schemas, topic names and other fixed values of the data model."""

from __future__ import annotations

from pyspark.sql.types import StructType


def _schema(**fields: str) -> StructType:
    schema = StructType()
    for name, data_type in fields.items():
        schema = schema.add(name, data_type)
    return schema


# Column names, order and types of the records on the wire.
USER = _schema(nom="string", email="string", password="string", date_inscription="timestamp")
USER_LOGIN = _schema(email="string", password="string")
MESSAGE = _schema(
    message="string", Created_At="timestamp", user_id="string", chat_id="string", type="string"
)
# A message on its way to the classifier: the time is still text.
SENT_MESSAGE = _schema(
    id="string",
    user_id="string",
    message="string",
    type="string",
    chat_id="string",
    Created_At="string",
)
MESSAGE_WITH_STATUS = _schema(
    message="string",
    Created_At="timestamp",
    user_id="string",
    chat_id="string",
    type="string",
    valide="string",
)
MESSAGE_METADATA = _schema(id_message="string", valide="string", date="timestamp")
PRODUIT = _schema(produit_id="integer", nom="string", categorie="string", prix="double")
ACHAT = _schema(
    achat_id="integer",
    produit_id="integer",
    date_achat="string",
    client_id="integer",
    quantite="integer",
    montant_total="double",
)
RETAIL_USER = _schema(
    user_id="integer", nom="string", email="string", date_inscription="timestamp"
)
NEW_USER = _schema(nom="string", prenom="string", age="integer", ca="double")
ROBUST_TEST = _schema(id="integer", value="string", load_ts="timestamp")

QUARANTINE = _schema(corrupt_record="string", processed_time="timestamp")
REPLY = _schema(key="string", value="string")
ENVELOPE = _schema(
    key="binary",
    value="binary",
    topic="string",
    partition="integer",
    offset="long",
    timestamp="timestamp",
    timestampType="integer",
)

# Topics.
REGISTER = "register"
IA_MESSAGE = "ia_message"
CHECK_MESSAGE = "check_message"
SEND_MESSAGE = "send_message"
SEND_ALL_MESSAGES = "send_all_messages"
SEND_USERS = "send_users"
GET_ALL_MESSAGES = "get_all_messages"
GET_USERS = "get_users"
PRODUCTS_TOPIC = "topic1"
PURCHASES_TOPIC = "topic2"

# Which services read a topic.
ROUTES = {
    REGISTER: ["spark"],
    IA_MESSAGE: ["spark", "backend"],
    CHECK_MESSAGE: ["spark"],
    SEND_ALL_MESSAGES: ["spark"],
    SEND_USERS: ["spark"],
    SEND_MESSAGE: ["classifier"],
    GET_ALL_MESSAGES: ["backend"],
    GET_USERS: ["backend"],
}

# Class labels by class number, verdict used when there is none,
# reply texts and time format.
MESSAGE_LABELS = ["inapproprié", "approprié"]
DEFAULT_VERDICT = "false"
USER_NOT_FOUND = '{"error":"Utilisateur non trouvé"}'
EMPTY_REPLY = "[]"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
EXPENSIVE_PRICE = 2000.0
TRIGGER_INTERVAL = "30 seconds"


def stored(schema: StructType) -> StructType:
    """The table form of a record: an id in front of the record's own columns."""
    result = StructType().add("id", "string")
    for field in schema.fields:
        result = result.add(field)
    return result
