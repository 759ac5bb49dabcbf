"""Declared text lengths of the layer tables."""

from __future__ import annotations

CARD_LIMITS = {"card_brand": 50, "card_type": 50, "card_number": 20, "expires": 7, "has_chip": 10,
               "acct_open_date": 7, "card_on_dark_web": 10, "issuer_bank_name": 100, "issuer_bank_state": 2,
               "issuer_bank_type": 50, "issuer_risk_rating": 20}
TX_LIMITS = {"use_chip": 50, "merchant_city": 255, "merchant_state": 10, "zip": 20, "errors": 255,
             "day_of_week": 10}
# declared text lengths: (key column, {column: length})
LENGTHS = {
    "transformation.users_data": ("id", {"gender": 20, "employment_status": 100, "education_level": 100}),
    "transformation.cards_data": ("id", CARD_LIMITS),
    "transformation.mcc_data": ("code", {"description": 255, "notes": 100, "updated_by": 100}),
    "transformation.transactions_data": ("id", TX_LIMITS),
    "curated.dim_customers": ("customer_id", {"gender": 20, "employment_status": 100, "education_level": 100}),
    "curated.dim_cards": ("card_id", {"card_brand": 50, "card_type": 50, "masked_card_number": 25, "expires": 20, "has_chip": 10,
                                      "acct_open_date": 20, "card_on_dark_web": 10, "issuer_bank_name": 100,
                                      "issuer_bank_state": 20, "issuer_bank_type": 50, "issuer_risk_rating": 20}),
    "curated.dim_mcc": ("mcc_code", {"description": 255, "notes": 100, "updated_by": 100}),
    "curated.dim_merchants": ("merchant_id", {"merchant_city": 100, "merchant_state": 20, "zip": 20}),
    "curated.dim_date": ("date_key", {"month_name": 20, "day_name": 20}),
    "curated.fact_transactions": ("transaction_id", {"use_chip": 50, "errors": 255, "is_refund": 5, "has_error": 5, "is_online": 5}),
}
