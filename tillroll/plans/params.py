"""Report parameters used by the registered queries on the driver data.

The reference hard-codes brand names, date ranges and windows in its SQL; here they are arguments, and these are the
values chosen for the test tables (events cover January 2024, sales cover 1995-2001).
"""

# Fixed values chosen for the fixture data.
FLAGSHIP = "Flagship"

# P1 / P2 on purchase-event baskets (January 2024).
BASKET_START = "2024-01-01"
BASKET_END = "2024-02-01"
SEQ_WINDOW_DAYS = 7
LAUNCH_DATE = "2024-01-10"
MAX_DAYS_TO_NEXT = 7
TOP_N = 50

# P1 on the sales view (two years, so months_since_first is exercised).
SALES_JOURNEY_START = "1998-01-01"
SALES_JOURNEY_END = "2000-01-01"
SALES_SEQ_WINDOW_DAYS = 365

# P3 / P4 royalty statements (July 1998).
ROYALTY_START = "1998-07-01"
ROYALTY_END = "1998-08-01"
ROYALTY_AS_OF = "1998-10-03"
ROYALTY_CURRENCY = "USD"
ROYALTY_PERCENTAGE = "0.05"
REFUND_MIN_ORDER_DATE = "1998-01-01"
REFUND_EVENT_FROM = "1998-07-01"
REFUND_EVENT_TO = "1998-07-31"

# P6 - P8 reconciliation month (July 1998), as of mid August.
RECON_AS_OF = "1998-08-15"
RECON_START = "1998-07-01"
RECON_END = "1998-08-01"
PROMO_PUBLISHER = "red widget"
PROMO_SUPPLIER = "red widget"
MATCH_THRESHOLD = 90
LOW_MATCH_THRESHOLD = 50
# Publisher spellings corrected by name before matching (one present in the fixture report).
PUBLISHER_OVERRIDES = {"HOT ROD Ltd.": "HOT ROD"}
# The first script selects the promo publisher by its whole lower-cased name.
PROMO_PUBLISHER_V1 = "red widget ltd."
# The reference's own defaults: 30-day sequencing window (P1) and 30-day transition window.
REFERENCE_WINDOW_DAYS = 30

# The sales channel's and the partner's flag columns in the test tables' views.
ROYALTY_CHANNEL = "drivethrurpg"
PARTNER_FLAG = "vaultn"
#: Rows of a report's preview.
PREVIEW_ROWS = 5
