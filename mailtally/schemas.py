"""Explicit schemas of messages, records and sink tables. Nothing is inferred."""

from pyspark.sql import types as T

_S, _B, _TS = T.StringType(), T.BooleanType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


ADDRESS = _struct(address=_S, name=_S)

ATTACHMENT = _struct(id=_S, name=_S, contentType=_S, size=T.LongType(), contentBytes=_S)

# Landed payload of the mail service: eight projected fields plus optional attachments.
PAYLOAD = T.StructType(
    [
        T.StructField("id", _S),
        T.StructField("subject", _S),
        T.StructField("from", _struct(emailAddress=ADDRESS)),
        T.StructField("receivedDateTime", _S),
        T.StructField("body", _struct(content=_S)),
        T.StructField("hasAttachments", _B),
        T.StructField("isRead", _B),
        T.StructField("conversationId", _S),
    ]
)

PAYLOAD_WITH_ATTACHMENTS = T.StructType(
    PAYLOAD.fields + [T.StructField("attachments", T.ArrayType(ATTACHMENT))]
)

MESSAGE = _struct(
    id=_S,
    subject=_S,
    email_sender=_S,
    sender_name=_S,
    received_at=_S,
    html_body=_S,
    has_attachments=_B,
    is_read=_B,
    conversation_id=_S,
    received_ts=_TS,
)

# What a strategy yields for one message and one rule.
EXTRACT = _struct(
    customer_name=_S,
    customer_code=_S,
    payment_amount=T.DoubleType(),
    payment_due_label=_S,
    currency=_S,
)

RECORD = T.StructType(
    EXTRACT.fields
    + _struct(
        email_unique_id=_S, email_subject=_S, email_sender=_S, email_received_at=_S, received_ts=_TS
    ).fields
)

AUDIT = _struct(
    message_id=_S,
    conversation_id=_S,
    received_at=_S,
    processed_at=_TS,
    status=_S,
    rows_extracted=T.LongType(),
    error_message=_S,
)

STATE = _struct(
    pipeline=_S,
    delta_token=_S,
    emails_processed=T.LongType(),
    records_extracted=T.LongType(),
    updated_at=_TS,
)
