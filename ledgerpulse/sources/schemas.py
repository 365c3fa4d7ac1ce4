"""Declared schemas; nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, type_, True) for name, type_ in columns.items()])


_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
_TS = T.TimestampNTZType()
PRICE = T.DecimalType(10, 3)
CONFIDENCE = T.DecimalType(5, 4)

RAW_INVOICES = _struct(
    invoice=_S, stockcode=_S, description=_S, quantity=_I, invoicedate=_TS, price=_D, customer_id=_S, country=_S
)
CUSTOMERS = _struct(customer_id=_I, country=_S)
PRODUCTS = _struct(stock_code=_S, description=_S)
TRANSACTIONS = _struct(
    invoice=_S, stock_code=_S, customer_id=_I, country=_S, invoice_date=_TS, quantity=_I, price=PRICE,
    is_cancellation=_B,
)
ACCOUNT_SCORES = _struct(
    customer_id=_I, recency_days=_D, frequency=_L, monetary=_D, avg_order_value=_D, tenure_days=_D, churned=_I,
    segment=_S, rfm_score=_I, churn_probability=_D, health_score=_D,
)
UTTERANCES = _struct(text=_S, intent_name=_S)
CLASSIFIED = _struct(text=_S, intent_name=_S, category=_S, pred=_S, confidence=_D, correct=_I, batch=_I)
DOCUMENTS = _struct(
    conversation_id=_S, utterance=_S, true_intent=_S, category=_S, predicted_intent=_S, confidence=_D, is_correct=_B,
    batch=_I,
)
CONVERSATIONS = _struct(
    conversation_id=_S, utterance=_S, true_intent=_S, category=_S, predicted_intent=_S, confidence=CONFIDENCE,
    is_correct=_B, batch=_I,
)
BATCH_STATS = _struct(batch=_I, n=_L, accuracy=_D, avg_confidence=_D, hard_intent_share=_D, alert=_B)

# Longest text a column may hold in the relational model (fixed values).
MAX_LENGTH = {
    "customers": {"country": 60},
    "products": {"stock_code": 20, "description": 200},
    "transactions": {"invoice": 20, "stock_code": 20, "country": 60},
    "conversations": {"conversation_id": 20, "true_intent": 40, "category": 40, "predicted_intent": 40},
}
PRIMARY_KEY = {"customers": "customer_id", "products": "stock_code", "conversations": "conversation_id"}
