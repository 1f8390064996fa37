"""Fixed values.

Codes and literals that must equal the business rules being rebuilt, stated
once, in their natural order. Everything else in the library refers to these
names instead of repeating literals.
"""

from __future__ import annotations

# --- fixed values: product classification (current rule set) -----------------
# Product types that are frontline goods.
FRONTLINE_TYPES = ("BDGF", "CALF", "HBF", "LPF", "NBAF", "NBJF", "PBF", "TOYF", "TRF", "VGF")
# Gift-card product types.
GIFT_CARD_TYPES = ("PGC", "EGC")
# Product types whose category is the lower-cased type itself.
SCAN_TYPES = ("SCAN",)
# Product classes whose category is the lower-cased class itself.
LOWERED_CLASSES = ("SPCL", "USED")
# Class of new goods; new goods that match nothing above are distribution goods.
NEW_CLASS = "NEW"
USED_CLASS = "USED"

# Category codes.
CAT_DIST = "dist"
CAT_FRLN = "frln"
CAT_SCAN = "scan"
CAT_GC = "gc"
CAT_OTHER = "zzz"

# --- fixed values: sale and transfer type codes -------------------------------
SLD_REGISTER = 1
SLD_ISTORE_SHIPPED = 2
SLD_ISTORE_REFUND = -2
SLD_WEB_SHIPPED = 3
SLD_WEB_REFUND = -3
SLD_BOOKWORM = 0

XFR_TRASH = 1
XFR_DONATE = 2
XFR_STORE_TO_STORE = 3
XFR_DAMAGE = 7
# Removed-from-inventory transfer types: trash, donate, damage.
XFR_RFI = (1, 2, 7)
# v1 outbound transfer types.
V1_XFR_OUT_TYPES = (1, 2, 3, 7)

# --- fixed values: source filters ---------------------------------------------
SALE_STATUS_ACTIVE = "A"
SALE_XACTION_SALE = "S"
ISTORE_OPEN_STATUSES = ("New", "Pending", "Shipped")
ISTORE_SKU_PREFIX = "D"
ISTORE_ORDER_SYSTEM = "MON"
WEB_ORDER_SYSTEM = "HMP"
WEB_CANCELED_STATUSES = ("canceled",)
WEB_SHIPPED_ITEM_STATUS = "shipped"
WEB_PICKUP_SHIPPING_METHOD = "222"
FULFIL_VALID_STATUSES = (1, 4)
XFER_HEADER_DONE = 3
XFER_DETAIL_DONE = 1
BOOKWORM_PLACEHOLDER_ITEM = "00000000000010222778"

# --- fixed values: id formats --------------------------------------------------
XACTION_NUMBER_WIDTH = 9
ITEM_CODE_WIDTH = 20

# --- fixed values: report ------------------------------------------------------
LOC_ALL = "All Locations"
LOC_STORE = "Store"
LOC_DISTRICT = "District"
LOC_REGION = "Region"
RETAIL_STORE_FLAG = "Y"
LOCATION_ACTIVE = "A"
# Amount format of the report: '$'#,0.00;('$'#,0.00)
CURRENCY_PREFIX = "$"
# Month list starts on Jan 1 this many years before the run date.
MONTH_LIST_YEARS_BACK = 3
# Default rollup window starts on Jan 1 this many years back.
DEFAULT_WINDOW_YEARS_BACK = 3
