"""A small CRM + ERP data set with known totals: names are made up, figures are fixed values."""

from datetime import date, datetime
from decimal import Decimal

from tidemark.schemas import CRM_SOURCES

CUSTOMERS = [
    ("CUST001", "Ho Chi Minh", "RETAIL", "INDIVIDUAL"),
    ("CUST002", "Ha Noi", "RETAIL", "INDIVIDUAL"),
    ("CUST003", "Da Nang", "WHOLESALE", "BUSINESS"),
    ("CUST004", "Ho Chi Minh", "RETAIL", "INDIVIDUAL"),
    ("CUST005", "Can Tho", "WHOLESALE", "BUSINESS"),
]
PRODUCTS = [
    ("PROD001", "ELECTRONICS", 25000000),
    ("PROD002", "ELECTRONICS", 30000000),
    ("PROD003", "ELECTRONICS", 22000000),
    ("PROD004", "AUDIO", 8000000),
    ("PROD005", "ELECTRONICS", 15000000),
]
SALES = [
    ("TXN001", datetime(2024, 1, 15, 10, 30), 1, 1, 1, 5, 26125000, "CREDIT_CARD"),
    ("TXN002", datetime(2024, 1, 16, 14, 20), 2, 2, 1, 0, 33000000, "BANK_TRANSFER"),
    ("TXN003", datetime(2024, 1, 17, 9, 15), 3, 3, 2, 10, 43560000, "CASH"),
    ("TXN004", datetime(2024, 1, 18, 16, 45), 4, 4, 1, 0, 8800000, "CREDIT_CARD"),
    ("TXN005", datetime(2024, 1, 19, 11, 30), 5, 5, 1, 5, 15675000, "BANK_TRANSFER"),
    ("TXN006", datetime(2024, 2, 1, 13, 20), 1, 4, 2, 5, 16720000, "CREDIT_CARD"),
    ("TXN007", datetime(2024, 2, 5, 10, 10), 2, 1, 1, 0, 27500000, "BANK_TRANSFER"),
    ("TXN008", datetime(2024, 2, 10, 15, 30), 3, 2, 1, 10, 29700000, "CASH"),
    ("TXN009", datetime(2024, 2, 15, 9, 45), 4, 5, 1, 0, 16500000, "CREDIT_CARD"),
    ("TXN010", datetime(2024, 2, 20, 14, 0), 5, 3, 1, 5, 22990000, "BANK_TRANSFER"),
]
REGIONS = [
    ("LOC001", "Ho Chi Minh", "SOUTH"),
    ("LOC002", "Ha Noi", "NORTH"),
    ("LOC003", "Da Nang", "CENTRAL"),
    ("LOC004", "Can Tho", "SOUTH"),
]


def frames(spark):
    rows = {
        "crm_cust_info": [
            (c, f"Person {c[-1]}", f"p{c[-1]}@mail.com", "0901234567", "1 Main St", city, "ST", "10000",
             date(2023, 1, 15), kind, "ACTIVE")
            for c, city, kind, _ in CUSTOMERS
        ],
        "crm_prd_info": [
            (p, f"Thing {p[-1]}", "A thing", category, f"Brand {p[-1]}", Decimal(price), "VND", "ACTIVE")
            for p, category, price in PRODUCTS
        ],
        "crm_sales_details": [
            (t, at, CUSTOMERS[c - 1][0], PRODUCTS[p - 1][0], qty, Decimal(PRODUCTS[p - 1][2]),
             Decimal(pct), Decimal(total // 11), Decimal(total), pay)
            for t, at, c, p, qty, pct, total, pay in SALES
        ],
        "erp_cust_az12": [
            (c, f"Person {c[-1]}", f"p{c[-1]}@mail.com", "0901234567", kind, Decimal(50000000), "ACTIVE")
            for c, _, _, kind in CUSTOMERS
        ],
        "erp_loc_a101": [
            (loc, f"{city} Branch", "1 Main St", "District 1", city, "ST", "Vietnam", "10000", region)
            for loc, city, region in REGIONS
        ],
        "erp_px_cat_g1v2": [
            (p, f"Thing {p[-1]}", "CAT001", category, "Kind", Decimal(price * 8 // 10), 50, 10)
            for p, category, price in PRODUCTS
        ],
    }
    return {name: spark.createDataFrame(r, CRM_SOURCES[name]) for name, r in rows.items()}
