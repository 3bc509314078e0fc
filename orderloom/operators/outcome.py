"""Final outcome of an order line (B33): an ordered rule cascade over order, parcel and money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.rules import rule_cascade

# Status texts as the couriers and shops write them, without diacritics.
SELF_COURIER = "Tu Van Chuyen"
RETURNED_STATUSES = (
    "Da doi soat cong no tra hang", "Hoan hang thanh cong", "Da hoan hang", "Da tra", "Don hoan",
    "Da tra ve doi tac", "Ky nhan 1 phan", "Chuyen hoan", "Dang trung chuyen hang hoan", "Da duyet hoan",
    "Dang chuyen hoan", "Dang tra hang", "Da tra hang", "Da ky nhan hoan tra", "Ky nhan chuyen hoan",
)
DELIVERED_STATUSES = ("Da doi soat", "Da ky nhan", "Giao hang thanh cong", "Giao thanh cong", "Da giao hang")
CANCELLED_STATUSES = (
    "Huy don dat", "Boi hoan", "Khong lay duoc hang", "Don huy", "Hang that lac", "Da boi thuong", "Shop huy lay",
    "Da huy giao", "VTP huy lay", "Khach hang huy don hang", "Da huy", "Huy",
)
SELF_FINISHED = ("thanh cong", "xac nhan hoan", "dang chuyen hoan", "da chuyen hoan", "da hoan")
SELF_CANCELLED = ("hang van chuyen huy don", "khach huy", "he thong huy")
MARKET_DONE, MARKET_CANCELLED = "COMPLETED", "CANCELLED"
EXCHANGE, ADDITION = "don doi", "bo sung"
FEE_LIMIT = 30_000

SUCCESS, RETURNED, PARTLY, FEE_ONLY, CANCELLED, PENDING = (
    "Thanh cong", "Hoan", "Hoan mot phan", "Hoan thu ship", "Huy", "Pending",
)

# Parcels whose collected money counts, and parcels that cost nothing.
COD_KEPT_STATUSES = (
    *(s for s in RETURNED_STATUSES if s != "Ky nhan chuyen hoan"), *DELIVERED_STATUSES,
    "Hoan", "Thanh cong", "Thanh cong 1 phan",
)
FREE_STATUSES = CANCELLED_STATUSES


def paid(cod: Column, bank: Column, prepaid: Column) -> Column:
    """Money of an order: collected on delivery plus transfers, or the prepayment where there is no transfer."""
    return cod + F.when(bank == 0, prepaid).otherwise(bank)


def _listed(*texts: str) -> str:
    return ", ".join(f"'{t}'" for t in texts)


def _finished(exchange_rest: str, paid_up: str) -> str:
    """Label of a finished order of a known parent source, by money first and goods second."""
    return f"""CASE
      WHEN {{parentsource}} = '{ADDITION}' THEN '{SUCCESS}'
      WHEN {{paid}} <= 0 THEN '{RETURNED}'
      WHEN {{paid}} <= {FEE_LIMIT} THEN '{FEE_ONLY}'
      WHEN {{parentsource}} = '{EXCHANGE}' THEN '{exchange_rest}'
      WHEN {{paid}} >= {{total_amount}} THEN {paid_up}
      WHEN {{paid}} < {{total_amount}} THEN CASE
        WHEN {{returned}} = 0 THEN '{SUCCESS}'
        WHEN {{returned}} >= {{quantity}} THEN '{RETURNED}'
        WHEN {{returned}} > 0 AND {{returned}} < {{quantity}} THEN '{PARTLY}'
        ELSE '{PENDING}' END
      ELSE '{PENDING}' END"""


# Rules that share a condition are nested under it: a row that meets the condition but none of the
# inner rules meets no later rule either. Unknown conditions do not hold.
RULES = f"""CASE
    WHEN {{parentsource}} IS NOT NULL AND ({{paid}} IS NOT NULL OR {{parentsource}} = '{ADDITION}')
      AND {{courier}} <> '{SELF_COURIER}' AND {{delivery_status}} IN ({_listed(*RETURNED_STATUSES, *DELIVERED_STATUSES)})
      THEN {_finished(PARTLY, f"IF({{delivery_status}} IN ({_listed(*DELIVERED_STATUSES)}), '{SUCCESS}', '{RETURNED}')")}
    WHEN {{courier}} <> '{SELF_COURIER}'
      AND {{delivery_status}} IN ({_listed(*CANCELLED_STATUSES, MARKET_CANCELLED)}) THEN '{CANCELLED}'
    WHEN {{parentsource}} IS NOT NULL AND ({{paid}} IS NOT NULL OR {{parentsource}} = '{ADDITION}')
      AND coalesce({{courier}}, '{SELF_COURIER}') = '{SELF_COURIER}' AND {{order_status}} IN ({_listed(*SELF_FINISHED)})
      THEN {_finished(FEE_ONLY, f"'{SUCCESS}'")}
    WHEN coalesce({{courier}}, '{SELF_COURIER}') = '{SELF_COURIER}'
      AND {{order_status}} IN ({_listed(*SELF_CANCELLED)}) THEN '{CANCELLED}'
    WHEN {{parentsource}} IS NULL AND {{delivery_status}} = '{MARKET_DONE}' AND {{return_reason}} IS NULL THEN '{SUCCESS}'
    WHEN {{parentsource}} IS NULL AND {{delivery_status}} = '{MARKET_DONE}' AND {{total_quantity}} = 1 THEN '{RETURNED}'
    WHEN {{parentsource}} IS NULL AND {{delivery_status}} = '{MARKET_DONE}' AND {{total_quantity}} > 1
      AND {{returned}} IS NOT NULL AND ({{returned}} = 0 OR {{quantity}} IS NOT NULL) AND {{returned}} >= 0
      THEN CASE WHEN {{returned}} >= {{quantity}} THEN '{RETURNED}' WHEN {{returned}} > 0 THEN '{PARTLY}' ELSE '{SUCCESS}' END
    WHEN {{parentsource}} IS NULL AND ({{order_status}} = '{MARKET_CANCELLED}' OR {{delivery_status}} = '{MARKET_CANCELLED}')
      THEN '{CANCELLED}'
    ELSE '{PENDING}' END"""

INPUTS = ("parentsource", "order_status", "return_reason", "courier", "delivery_status", "paid", "quantity", "returned",
          "total_quantity", "total_amount")


def outcome(**columns: str) -> Column:
    """The label of the first rule that holds, from the named columns (see INPUTS)."""
    return F.expr(RULES.format(**{name: columns.get(name, name) for name in INPUTS}))


def success_value(status: Column, quantity: Column, price: Column, discount: Column, extra: Column,
                  returned: Column) -> Column:
    """Value of the goods the customer kept, by outcome."""
    kept = quantity - returned
    share = F.when(quantity == 0, F.lit(0.0)).otherwise(kept.cast("double") / quantity.cast("double"))
    return rule_cascade([
        (status.isin(CANCELLED, PENDING, RETURNED), F.lit(0.0)),
        (status.isin(SUCCESS, FEE_ONLY), (quantity * price - discount - extra).cast("double")),
        ((status == PARTLY) & (quantity > returned),
         (kept * price).cast("double") - discount.cast("double") * share - extra.cast("double") * share),
        ((status == PARTLY) & (quantity <= returned), F.lit(0.0)),
    ])
