"""Table schemas, message schemas and the fixed lookup values."""

# Price per unit used for the order amount.
ORDER_PRICES = {
    "AJA001": 1250,
    "SOK001": 1230,
    "DUN001": 1180,
    "LOT001": 1200,
    "PEM001": 1250,
    "BAB001": 1210,
    "MAI001": 1190,
    "SMA001": 1190,
    "UMI001": 1215,
}

# Price shown in the price list (MAI001 differs from the order price).
LIST_PRICES = {
    "AJA001": 1250,
    "SOK001": 1230,
    "DUN001": 1180,
    "LOT001": 1200,
    "PEM001": 1250,
    "BAB001": 1210,
    "SMA001": 1190,
    "UMI001": 1215,
    "MAI001": 1170,
}

# Product names (MAI001 has none).
PRODUCT_NAMES = {
    "AJA001": "Ajab HB 2kg",
    "SOK001": "Soko HB 2kg",
    "DUN001": "Dunia HB 2kg",
    "LOT001": "Lotus HB 2kg",
    "PEM001": "Pembe HB 2kg",
    "BAB001": "Baba Lao HB 2kg",
    "SMA001": "Smatta HB 2kg",
    "UMI001": "Umi HB 2kg",
}

# Weight of one unit, stock figures, price list id and unit.
UNIT_WEIGHT = 24
STOCK = 1500
RESTOCK = 1000
PRICELIST_ID = "PRC1"
PRICELIST_UOM = "Bale"

# Order ids are BIGINT: an INT would overflow at the order counts a 100 TB input holds.
RAW_ORDERS = (
    "id BIGINT, csmcode STRING, orddate STRING, ordtime STRING, prdtid STRING, quantity INT"
)
ORDERS = (
    "id BIGINT, csmcode VARCHAR(10), orddate DATE, ordtime STRING, prdtid VARCHAR(10), "
    "quantity INT, weight INT, amount INT, eventtime TIMESTAMP_NTZ"
)
PRODUCTS = "id VARCHAR(10), name VARCHAR(50), stock INT, restock INT, unitweight INT"
PRICELIST = "id VARCHAR(10), prdtid VARCHAR(10), uom VARCHAR(10), price INT"

TABLES = {"orders": ORDERS, "products": PRODUCTS, "pricelist": PRICELIST}

ORDER_COLUMNS = [
    "id", "csmcode", "orddate", "ordtime", "prdtid", "quantity", "weight", "amount", "eventtime",
]

# Only the fields the totals use; the parser skips the others.
ORDER_MESSAGE = "id BIGINT, amount BIGINT, event_time STRING"
