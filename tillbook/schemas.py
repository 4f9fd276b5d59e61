"""Column names and types: source tables and mart contracts."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "bigint": LongType(),
    "int": IntegerType(),
    "string": StringType(),
    "date": DateType(),
    "boolean": BooleanType(),
    "timestamp_ntz": TimestampNTZType(),
    "decimal(10,1)": DecimalType(10, 1),
    "decimal(12,2)": DecimalType(12, 2),
    "decimal(18,2)": DecimalType(18, 2),
    "decimal(20,6)": DecimalType(20, 6),
    "decimal(30,6)": DecimalType(30, 6),
}


def columns(text: str) -> StructType:
    """StructType of "name type [not null]; ..." without a running session."""
    fields = []
    for part in text.split("; "):
        name, kind, *rest = part.split(" ")
        fields.append(StructField(name, _TYPES[kind], nullable=not rest))
    return StructType(fields)


# The source tables as the operational database declares them.
_SOURCE = {
    "store": "id bigint not null; store_name string not null; address string not null; phone_number string",
    "category": "id bigint not null; category_name string not null",
    "brand": "id bigint not null; brand_name string not null",
    "payment_method": "id bigint not null; method string not null",
    "employee": (
        "id bigint not null; store_id bigint not null; first_name string not null; last_name string not null; "
        "date_of_birth date not null; address string; phone_number string; start_date date not null; "
        "end_date date; salary decimal(12,2) not null"
    ),
    "product": (
        "id bigint not null; product_sku string not null; category_id bigint not null; brand_id bigint not null; "
        "product_name string not null; unit_price decimal(12,2) not null; unit_cost decimal(12,2) not null"
    ),
    "promotion": (
        "id bigint not null; type string not null; amount decimal(12,2) not null; "
        "start_date date not null; end_date date not null"
    ),
    "promotion_product": "product_id bigint not null; promotion_id bigint not null",
    "sales_transaction": (
        "transaction_id bigint not null; store_id bigint not null; employee_id bigint not null; "
        "payment_method_id bigint not null; transaction_ts timestamp_ntz not null; status string not null"
    ),
    "sales_transaction_item": (
        "transaction_id bigint not null; line_number int not null; product_id bigint not null; "
        "promotion_id bigint; quantity int not null; regular_price decimal(12,2) not null; "
        "coupon_amount decimal(12,2) not null"
    ),
}
_STAMPS = "; created_at timestamp_ntz not null; updated_at timestamp_ntz not null"

SOURCE = {name: columns(ddl + _STAMPS) for name, ddl in _SOURCE.items()}

# Loaded by cursor with their primary keys, and replaced on every run.
APPENDED = {
    "sales_transaction": ["transaction_id"],
    "sales_transaction_item": ["transaction_id", "line_number"],
    "product": ["id"],
    "employee": ["id"],
}
REPLACED = ["store", "category", "brand", "payment_method", "promotion", "promotion_product"]

RAW = {
    name: columns(_SOURCE[name] + _STAMPS + ("; _load_id bigint not null" if name in APPENDED else ""))
    for name in _SOURCE
}

_VALIDITY = "valid_from timestamp_ntz not null; valid_to timestamp_ntz not null; is_current boolean not null"

# Mart contracts. NOT NULL columns are enforced, other nulls are allowed.
MART = {
    name: columns(ddl)
    for name, ddl in {
        "dim_store": (
            "store_key bigint not null; store_id bigint not null; store_name string; address string; phone_number string"
        ),
        "dim_payment_method": (
            "payment_method_key bigint not null; payment_method_id bigint not null; payment_method_name string"
        ),
        "dim_promotion": (
            "promotion_key bigint not null; promotion_id bigint not null; promotion_label string not null; "
            "promotion_type string; promotion_amount decimal(12,2); start_date date; end_date date"
        ),
        "dim_product": (
            "product_key bigint not null; product_id bigint not null; product_sku string; product_name string; "
            "category_id bigint; category_name string; brand_id bigint; brand_name string; "
            "unit_price decimal(12,2); unit_cost decimal(12,2); " + _VALIDITY
        ),
        "dim_employee": (
            "employee_key bigint not null; employee_id bigint not null; store_id bigint; employee_name string; "
            "salary decimal(12,2); address string; start_date date; end_date date; " + _VALIDITY
        ),
        "dim_date": (
            "date_key int not null; full_date date; year int; quarter int; month int; month_name string; "
            "day_of_month int; day_of_week int; day_name string; week_of_year int; is_weekend boolean"
        ),
        "dim_time": (
            "time_key int not null; time_of_day string; hour_24 int; minute int; hour_12 int; am_pm string; "
            "day_part string"
        ),
        "fct_sales": (
            "date_key int not null; time_key int not null; product_key bigint not null; store_key bigint not null; "
            "employee_key bigint not null; payment_method_key bigint not null; promotion_key bigint not null; "
            "transaction_id bigint not null; line_number int not null; transaction_ts timestamp_ntz not null; "
            "quantity int; regular_price decimal(12,2); unit_cost decimal(12,2); gross_amount decimal(18,2); "
            "discount_amount decimal(20,6); coupon_amount decimal(12,2); net_amount decimal(20,6); "
            "cost_amount decimal(18,2); gross_profit decimal(20,6); source_updated_at timestamp_ntz"
        ),
        "fct_sales_enriched": (
            "transaction_id bigint not null; line_number int not null; transaction_ts timestamp_ntz; "
            "full_date date; year int; month int; month_name string; day_name string; is_weekend boolean; "
            "store_name string not null; product_name string not null; category_name string not null; "
            "brand_name string not null; promotion_label string not null; promotion_type string; "
            "payment_method_name string not null; quantity int; gross_amount decimal(18,2); "
            "discount_amount decimal(20,6); coupon_amount decimal(12,2); net_amount decimal(20,6); "
            "cost_amount decimal(18,2); gross_profit decimal(20,6)"
        ),
        "fct_store_headcount_monthly": (
            "store_key bigint not null; store_id bigint not null; store_name string; month_start date not null; "
            "month_start_date_key int not null; opening_headcount bigint; closing_headcount bigint; joiners bigint; "
            "leavers bigint; transfers_in bigint; transfers_out bigint; average_headcount decimal(10,1); "
            "net_revenue decimal(30,6); is_month_closed boolean not null; as_of_date date not null"
        ),
    }.items()
}

# Columns that hold personal data.
PII = {"dim_employee": ["salary", "address"]}
