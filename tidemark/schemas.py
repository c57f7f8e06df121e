"""Column layouts (DDL text) of the tables a pipeline reads or keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame

# CRM + ERP track, Bronze side.
CRM_SOURCES = {
    "crm_cust_info": (
        "cust_id string, cust_name string, email string, phone string, address string, city string, "
        "state string, zip_code string, registration_date date, customer_type string, status string"
    ),
    "crm_prd_info": (
        "product_id string, product_name string, description string, category string, brand string, "
        "unit_price decimal(18,2), currency string, status string"
    ),
    "crm_sales_details": (
        "transaction_id string, transaction_date timestamp_ntz, cust_id string, product_id string, "
        "quantity int, unit_price decimal(18,2), discount_pct decimal(5,2), tax_amount decimal(18,2), "
        "total_amount decimal(18,2), payment_method string"
    ),
    "erp_cust_az12": (
        "customer_code string, customer_full_name string, contact_email string, contact_phone string, "
        "business_type string, credit_limit decimal(18,2), account_status string"
    ),
    "erp_loc_a101": (
        "location_id string, location_name string, address_line1 string, address_line2 string, "
        "city string, state string, country string, postal_code string, region string"
    ),
    "erp_px_cat_g1v2": (
        "product_code string, product_desc string, category_code string, category_name string, "
        "subcategory string, unit_cost decimal(18,2), stock_qty int, reorder_level int"
    ),
}

# Control tables.
BATCH = (
    "batch_id string, ingested_at timestamp_ntz, row_count bigint, highest_id bigint, is_full boolean"
)
WATERMARK = (
    "table_name string, last_loaded_at timestamp_ntz, last_batch_id string, last_row_count bigint, "
    "updated_at timestamp_ntz"
)
RUN_EVENT = (
    "log_id bigint, batch_id string, table_name string, status string, rows_loaded bigint, "
    "error_message string, event_at timestamp_ntz"
)

ETL_LOG = (
    "log_id bigint, procedure_name string, layer string, status string, start_time timestamp_ntz, "
    "end_time timestamp_ntz, rows_processed bigint, error_message string"
)


def conform(df: DataFrame, layout: str) -> DataFrame:
    """Select the layout's columns in order, typed; columns the frame lacks become NULL."""
    present = set(df.columns)
    columns = []
    for field in layout.split(", "):
        name, kind = field.split(" ", 1)
        columns.append(f"CAST({name if name in present else 'NULL'} AS {kind}) AS {name}")
    return df.selectExpr(*columns)
