"""Row validation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import EVENT_TYPES
from .payments import blank_to_null, col, normalize_ke_phone, txn_time, txn_time_unreadable

MAX_AMOUNT = 1000000


def finite_amount(c) -> Column:
    """Text to double; null when not numeric, not finite or missing."""
    value = col(c).try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def iso_time_ok(c) -> Column:
    return F.coalesce(col(c).rlike(r"^\d{4}-\d{2}-\d{2}") & col(c).try_cast("timestamp").isNotNull(),
                      F.lit(False))


def first_failing_rule(txn_id, amount, phone, shortcode, time) -> Column:
    """Schema first, then types, then business rules; ``ok`` when all hold."""
    number = finite_amount(amount)
    chain = F.when(col(txn_id).isNull(), "missing_transaction_id")
    for name, c in (("amount", amount), ("phone", phone), ("shortcode", shortcode), ("time", time)):
        chain = chain.when(col(c).isNull(), f"missing_{name}")
    return (
        chain.when(number.isNull(), "amount_not_numeric")
        .when(~col(phone).rlike(r"^254[0-9]{9}$"), "phone_format")
        .when(~iso_time_ok(time), "time_format")
        .when(number <= 0, "amount_not_positive")
        .otherwise("ok")
    )


def c2b_request_reasons(columns: dict[str, str]) -> Column:
    """Every rule the strict request model breaks, as an array in rule order."""
    amount = finite_amount(columns["TransAmount"])
    missing = [
        F.when(col(c).isNull(), F.lit(f"missing_{field}")) for field, c in columns.items()
    ]
    present = col(columns["TransAmount"]).isNotNull()
    rules = [
        F.when(present & amount.isNull(), "amount_not_numeric"),
        F.when(amount < 1, "amount_too_small"),
        F.when(amount > MAX_AMOUNT, "amount_too_large"),
        F.when(col(columns["MSISDN"]).isNotNull() & normalize_ke_phone(columns["MSISDN"]).isNull(),
               "invalid_phone"),
        F.when(
            col(columns["TransTime"]).isNotNull()
            & ~(col(columns["TransTime"]).rlike(r"^\d{14}$") & txn_time(columns["TransTime"]).isNotNull()),
            "invalid_time",
        ),
    ]
    return F.array_compact(F.array(*missing, *rules))


def c2b_decision(reasons: Column, amount) -> dict[str, Column]:
    """Answer to a validation request. A limit breach also breaks the request model, so the
    model's own verdict comes first and the two specific texts only follow for valid models."""
    number = finite_amount(amount)
    failed = F.size(reasons) > 0
    desc = (
        F.when(failed, "Validation failed")
        .when(col(amount).isNull(), "Missing TransAmount")
        .when(number > MAX_AMOUNT, "Amount exceeds limit")
        .otherwise("Validation accepted")
    )
    return {
        "ResultCode": F.when(desc == "Validation accepted", "0").otherwise("1"),
        "ResultDesc": desc,
    }


def api_c2b_ok(amount, phone, time) -> Column:
    number = finite_amount(amount)
    time_ok = blank_to_null(time).isNull() | (
        col(time).rlike(r"^\d{14}$") & txn_time(time).isNotNull()
    )
    return F.coalesce(
        (number > 0) & (number <= MAX_AMOUNT) & normalize_ke_phone(phone).isNotNull() & time_ok,
        F.lit(False),
    )


def unsafe_text(c) -> Column:
    return F.coalesce(col(c).rlike(r"(?i)<\s*script|onerror\s*="), F.lit(False))


def stk_request_reason(phone, amount, reference, description) -> Column:
    number = finite_amount(amount)
    return (
        F.when(normalize_ke_phone(phone).isNull(), "invalid_phone")
        .when(number.isNull() | (number <= 0), "amount_not_positive")
        .when(number > MAX_AMOUNT, "amount_too_large")
        .when(col(reference).isNull() | ~F.length(col(reference)).between(1, 64), "reference_length")
        .when(unsafe_text(reference) | unsafe_text(description), "unsafe_text")
        .otherwise("ok")
    )


def landing_rule(event_type="event_type", time="transaction_time") -> Column:
    """Why an event may not land: unknown type, or a time in neither accepted format."""
    return (
        F.when(~event_type_ok(event_type), "event_type")
        .when(txn_time_unreadable(time), "unreadable_time").otherwise("ok")
    )


def event_type_ok(c) -> Column:
    return F.coalesce(col(c).isin(EVENT_TYPES), F.lit(False))
