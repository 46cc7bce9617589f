"""Record layouts."""

from pyspark.sql import types as T

S, TS = T.StringType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Customer payment callback. Everything arrives as text.
CALLBACK = _struct(
    TransactionType=S, TransID=S, TransTime=S, TransAmount=S, BusinessShortCode=S,
    BillRefNumber=S, InvoiceNumber=S, OrgAccountBalance=S, MSISDN=S, AccountReference=S,
    FirstName=S, MiddleName=S, LastName=S,
)

# Normalised event as it travels on the topic.
EVENT = _struct(
    event_type=S, received_at=TS, source=S, transaction_id=S, phone_number=S, amount=S,
    account_reference=S, transaction_time=S, data=T.MapType(S, S),
)

# Landed event table.
RAW_EVENT = _struct(
    event_type=S, received_at=TS, source=S, transaction_id=S, phone_number=S, amount=S,
    account_reference=S, transaction_time=S, business_shortcode=S, region=S,
    payment_method=S, transaction_status=S, reference=S, payload=S,
)

STK_CALLBACK = _struct(
    Body=_struct(
        stkCallback=_struct(
            MerchantRequestID=S, CheckoutRequestID=S, ResultCode=T.IntegerType(), ResultDesc=S,
            MpesaReceiptNumber=S,
            CallbackMetadata=_struct(Item=T.ArrayType(_struct(Name=S, Value=S))),
        )
    )
)

B2C_RESULT = _struct(ConversationID=S, ResultCode=S, Result=T.MapType(S, S))

DEAD_LETTER = _struct(
    message_id=S, original_topic=S, original_message=S, failure_reason=S, error_message=S,
    error_stacktrace=S, timestamp=TS, retry_count=T.IntegerType(), max_retries=T.IntegerType(),
    is_recoverable=T.BooleanType(),
)

# Accepted event types.
EVENT_TYPES = ["c2b_validation", "c2b_confirmation", "b2c_result", "stk_callback", "fraud_alert"]

# Dead-letter reasons.
FAILURE_REASONS = [
    "invalid_signature", "invalid_format", "duplicate_transaction", "database_error",
    "validation_error", "unknown_error", "timeout", "region_mapping_failed",
]

# Topic names; callers may pass their own.
TOPIC_TRANSACTIONS = "transactions"
TOPIC_AGGREGATED = "aggregated"
TOPIC_ALERTS = "fraud-alerts"
TOPIC_DLQ = "transactions-dlq"
TOPIC_RETRY = "transactions-retry"
