"""Codes, names and labels that decide results. Nothing here is logic."""

# Known company/year folders.
FOLDERS = ("ZF2526", "ZF2627", "ZFN2526")

# Ledger codes of internal control accounts, in every folder.
INTERNAL_LEDGER_CODES = ("26", "72", "62", "CSTK", "25", "C", "P", "S", "01", "02", "2")

# Work tables that are never loaded.
SKIPPED_TABLES = ("CRTEMP", "DBTEMP", "TBTEMP", "TEMP", "TEMP1", "PART", "ORDLIS")

# Texts read as "yes" in the service column of the item master.
SERVICE_YES = ("Y", "T", "1", "TRUE")

# Texts read as true and as false in a logical xBase field; others are unknown.
LOGICAL_TRUE = ("T", "Y", "1")
LOGICAL_FALSE = ("F", "N", "0")

# Span of the calendar dimension.
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"

# Days without a sale after which a product is slow-moving.
SLOW_MOVING_DAYS = 90

# Fixed values: (default, smallest, largest) row limit of each ranked query.
LIMITS = {
    "monthly_sales": (12, 1, 60),
    "top_customers": (20, 1, 200),
    "receivables": (50, 1, 500),
    "customer_ltv": (20, 1, 200),
    "top_products": (20, 1, 200),
    "slow_moving": (50, 1, 500),
    "transactions": (100, 1, 1000),
    "inventory_items": (100, 1, 1000),
    "cash_flow_series": (30, 1, 1000),
    "sync_history": (50, 1, 1000),
}

# Bars and label width of the product chart.
PRODUCT_BARS = 10
PRODUCT_LABEL_CHARS = 18

# Names of xBase field types.
FIELD_TYPE_LABELS = {
    "C": "Character",
    "N": "Numeric",
    "F": "Float",
    "D": "Date",
    "L": "Logical",
    "M": "Memo",
    "B": "Binary",
    "I": "Integer",
    "Y": "Currency",
    "T": "DateTime",
    "G": "General",
}

# What the well-known tables hold, and the text for all others.
TABLE_PURPOSES = {
    "ITEM": "Product / Item Master",
    "MASTER": "Ledger Master (Customers, Suppliers, Accounts)",
    "SALES1": "Sales Invoice Header",
    "SALES2": "Sales Invoice Line Items",
    "TRANS": "Accounting Transactions / Vouchers",
}
UNKNOWN_PURPOSE = "— To be analysed"

# What the well-known fields mean.
FIELD_MEANINGS = {
    "INV_NO": "Invoice Number",
    "INVNO": "Invoice Number",
    "INV_DATE": "Invoice Date",
    "INVDATE": "Invoice Date",
    "ITEM_CODE": "Item Code",
    "ITEMCODE": "Item Code",
    "CUST_CODE": "Customer Code",
    "CUSTCODE": "Customer Code",
    "QTY": "Quantity",
    "RATE": "Rate / Unit Price",
    "AMOUNT": "Line Amount",
    "DISC": "Discount",
    "BILL_AMT": "Bill Amount",
    "TAX": "Tax Amount",
    "LEDCODE": "Ledger Code",
    "NARR": "Narration",
    "VCH_NO": "Voucher Number",
    "VCH_DATE": "Voucher Date",
    "DR_CR": "Debit/Credit",
    "DRCR": "Debit/Credit Flag",
    "HSN": "HSN Code",
    "UOM": "Unit of Measure",
    "OPENING": "Opening Balance",
    "CLOSING": "Closing Balance",
    "MOBILE": "Mobile Number",
    "STATE": "State",
    "GROUP": "Account Group",
}

# Join hints for well-known shared fields, and the text for all others.
JOIN_HINTS = {
    "INV_NO": "SALES1.INV_NO = SALES2.INV_NO  (Header ↔ Lines)",
    "INVNO": "SALES1.INVNO  = SALES2.INVNO   (Header ↔ Lines)",
    "ITEM_CODE": "SALES2.ITEM_CODE = ITEM.ITEM_CODE (Lines ↔ Product)",
    "ITEMCODE": "SALES2.ITEMCODE  = ITEM.ITEMCODE  (Lines ↔ Product)",
    "CUST_CODE": "SALES1.CUST_CODE = MASTER.CODE  (Invoice ↔ Ledger)",
    "LEDCODE": "TRANS.LEDCODE    = MASTER.CODE  (Trans ↔ Ledger)",
}
UNKNOWN_JOIN = "— Analyse manually"

# Sample size of the data dictionary.
SAMPLE_ROWS = 5
