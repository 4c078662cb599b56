"""The exported datasets: declared schema, day column and write mode of each."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import types as T

# The declared columns of every exported dataset, in export order. Nested columns
# are lists of the item struct, as the sources repeat them (see ``Dataset.schema``).

ANALYTICS_EVENTS = """
adid DOUBLE, amplitude_attribution_ids ARRAY<STRING>, amplitude_event_type DOUBLE, amplitude_id BIGINT,
app BIGINT, city STRING, client_event_time TIMESTAMP, client_upload_time TIMESTAMP, country STRING,
data STRING, device_brand DOUBLE, device_carrier DOUBLE, device_family STRING, device_id STRING,
device_manufacturer DOUBLE, device_model DOUBLE, device_type STRING, event_id BIGINT,
event_properties STRING, event_time TIMESTAMP, event_type STRING, followed_an_identify DOUBLE,
group_properties STRING, groups STRING, idfa DOUBLE, ip_address STRING, is_attribution_event DOUBLE,
language STRING, library STRING, location_lat DOUBLE, location_lng DOUBLE, os_name STRING,
os_version STRING, paying DOUBLE, platform STRING, processed_time TIMESTAMP, region STRING,
sample_rate DOUBLE, server_received_time TIMESTAMP, server_upload_time TIMESTAMP, session_id BIGINT,
start_version DOUBLE, user_creation_time TIMESTAMP_NTZ, user_id DOUBLE, user_properties STRING,
uuid STRING, version_name DOUBLE
"""

BATCHES = """
batch_type STRING, created_at TIMESTAMP, delivery_type BIGINT, id BIGINT, latitude DOUBLE,
longitude DOUBLE, max_quantity BIGINT, ready_time TIMESTAMP, status BIGINT, updated_at TIMESTAMP,
version BIGINT, warehouse_id BIGINT, launch_id STRING
"""

OPERATIONS = """
created_at TIMESTAMP, created_by BIGINT, document_id BIGINT, document_type_id BIGINT,
feature_id BIGINT, id BIGINT, product_id BIGINT, quantity BIGINT, warehouse_id BIGINT,
launch_id STRING, is_deleted BOOLEAN
"""

ORDERS = """
address STRING, address_comment STRING, auto_finish_at TIMESTAMP, batch_id BIGINT, building STRING,
cell STRING, client_id BIGINT, client_latitude DOUBLE, client_longitude DOUBLE, code STRING,
comment_for_courier STRING, comment_for_picker STRING, courier_id BIGINT,
courier_motivation_amount BIGINT, courier_motivation_time STRING, created_at TIMESTAMP,
delivered_time STRING, delivery_time_prediction STRING, distance_to_warehouse BIGINT,
entrance STRING, flat STRING, floor BIGINT, has_alcohol BOOLEAN, has_coffee BOOLEAN,
has_tobacco BOOLEAN, order_id BIGINT, is_distant BOOLEAN, leave_at_the_door BOOLEAN,
less_packages BOOLEAN, min_amount BIGINT, courier_order_id BIGINT,
order_items ARRAY<STRUCT<is_available: BOOLEAN, mark: STRING, price: BIGINT, original_price: BIGINT,
  product_id: BIGINT, product_name: STRING, reason: STRING, reason_type: BIGINT, refund_id: BIGINT,
  return_request_id: BIGINT, scanned_at: TIMESTAMP, status: BIGINT, supplier_price: BIGINT,
  supplier_product_id: BIGINT, promo_source: BIGINT, promo_source_id: BIGINT>>,
payment_method STRING, picker_assigned_at TIMESTAMP, price BIGINT, status STRING,
status_updated_at TIMESTAMP, street_name STRING, version BIGINT, volume BIGINT,
warehouse_address STRING, warehouse_id BIGINT, warehouse_latitude STRING, warehouse_longitude STRING,
weight DOUBLE, has_energy_drinks BOOLEAN, distance_to_warehouse_by_bicycle BIGINT
"""

CANCELLED_ORDERS = """
name STRING, user_id STRING, city_name STRING, country_code STRING, event_id STRING, currency STRING,
actual_cancellation_time TIMESTAMP, order_creation_time TIMESTAMP, min_promised_delivery_time BIGINT,
max_promised_delivery_time BIGINT, cancel_reason STRING, cancel_stage STRING, cancel_initiator STRING,
cart ARRAY<STRUCT<name: STRING, id: BIGINT, price: BIGINT, original_price: BIGINT, quantity: BIGINT>>,
order_id BIGINT, payment_id STRING, promocode_name STRING, promocode_conditions STRING
"""

DELIVERED_ORDERS = """
name STRING, user_id STRING, city_name STRING, county_code STRING, event_id STRING, currency STRING,
actual_delivery_time TIMESTAMP, order_creation_time TIMESTAMP, min_promised_delivery_time BIGINT,
max_promised_delivery_time BIGINT,
delivered_products ARRAY<STRUCT<name: STRING, id: BIGINT, price: BIGINT, original_price: BIGINT,
  quantity: BIGINT>>,
order_id STRING, payment_id STRING, promocode_name STRING, promocode_conditions STRING
"""

WAREHOUSE_PRODUCTS = """
created_at TIMESTAMP, created_by BIGINT, feature_id BIGINT, features_quantity BIGINT,
fixed_quantity BIGINT, fixed_quantity_at TIMESTAMP, id BIGINT, is_active BOOLEAN, is_default BOOLEAN,
old_price BIGINT, price BIGINT, product_id BIGINT, promo_id BIGINT, quantity BIGINT,
supplier_price BIGINT, updated_at TIMESTAMP, updated_by BIGINT, warehouse_id BIGINT, launch_id STRING
"""

WAREHOUSE_PRODUCTS_HOURLY = """
created_at TIMESTAMP, created_by BIGINT, feature_id BIGINT, features_quantity BIGINT,
feature_name STRING, weight BIGINT, fixed_quantity BIGINT, fixed_quantity_at TIMESTAMP, id BIGINT,
is_active BOOLEAN, is_default BOOLEAN, old_price BIGINT, price BIGINT, product_id BIGINT,
promo_id BIGINT, quantity BIGINT, supplier_price BIGINT, updated_at TIMESTAMP, updated_by BIGINT,
warehouse_id BIGINT, catalog_updated_at TIMESTAMP
"""

PRODUCT_CATALOGUE = """
analytical_category_id BIGINT, brand_id BIGINT, brand_name STRING, country STRING,
created_at TIMESTAMP, daily_max_quantity BIGINT, degree_level BIGINT, degree_value DOUBLE,
depth DOUBLE, full_description STRING, full_description_kk STRING, has_brand BOOLEAN, height DOUBLE,
id BIGINT, is_active BOOLEAN, is_sample BOOLEAN, keywords STRING, keywords_kk STRING, labels STRING,
max_quantity BIGINT, name STRING, name_kk STRING, name_origin STRING, name_short STRING,
name_short_kk STRING, one_day_sale BOOLEAN, sort_weight BIGINT, type_uuid STRING, uuid STRING,
weight BIGINT, weight_visible BOOLEAN, width DOUBLE, wine_color STRING, wine_sugar_content STRING,
is_promo BOOLEAN, is_coffee BOOLEAN, image STRING, url STRING
"""

WAREHOUSE_CATALOGUE = """
address STRING, city_id BIGINT, city_name STRING, closes_at TIME(6), created_at TIMESTAMP,
delivery_time STRING, delivery_zone STRING, delivery_zone_geo STRING, delivery_zone_multi_geo STRING,
force_min_amount BIGINT, geo_wkt STRING, has_internship BOOLEAN, id BIGINT, is_active BOOLEAN,
is_functioning BOOLEAN, lat DOUBLE, long DOUBLE, min_amount BIGINT, name STRING, opens_at TIME(6),
products_quantity BIGINT, uuid STRING, night_delivery_zone STRING,
night_delivery_zone_multi_geo STRING, night_delivery_starts_at TIME(6), night_delivery_ends_at TIME(6)
"""

FINANCIAL_DAILY = """
platform STRING, date STRING, active_darkstores BIGINT, unique_users BIGINT, orders BIGINT,
aov DOUBLE, gmv DOUBLE, gmv_disc DOUBLE, incentives DOUBLE, delivery_fee_revenue DOUBLE,
service_fee_revenue DOUBLE, gtv DOUBLE
"""

FINANCIAL_MONTHLY = """
platform STRING, month STRING, active_darkstores BIGINT, unique_users BIGINT, orders BIGINT,
aov DOUBLE, gmv DOUBLE, delivery_fee_revenue DOUBLE, service_fee_revenue DOUBLE, gtv DOUBLE
"""

FINANCIAL_RAW = """
platform STRING, created_at STRING, warehouse_id BIGINT, user_id BIGINT, order_id BIGINT,
original_price DOUBLE, gmv_disc DOUBLE, incentives DOUBLE, delivery_fee_price DOUBLE,
service_fee_price DOUBLE, status BIGINT, payment_id STRING
"""

REFUNDS_RAW = """
created_at STRING, refund_id BIGINT, idempotency_key STRING, order_id BIGINT, price DOUBLE,
reference BIGINT, refunded_at STRING, response_data STRING, type BIGINT, uuid STRING
"""


@dataclass(frozen=True)
class Dataset:
    """One exported dataset. ``day_column`` is None for snapshots, ``mode`` as in ``write_partition``."""

    name: str
    columns: str
    day_column: str | None = None
    mode: str = "replace"
    step: str = "day"
    nested: str | None = None

    def schema(self, nested_as: str = "array") -> T.StructType:
        """The declared schema; ``nested_as="struct"`` for a source whose nested column is one item."""
        declared = T.StructType.fromDDL(self.columns)
        if nested_as == "array" or self.nested is None:
            return declared
        if nested_as != "struct":
            raise ValueError(f"nested_as must be 'array' or 'struct', not {nested_as!r}")
        return T.StructType([
            T.StructField(f.name, f.dataType.elementType if f.name == self.nested else f.dataType, True)
            for f in declared])


DATASETS = {d.name: d for d in (
    Dataset("analytics_events", ANALYTICS_EVENTS, "event_time"),
    Dataset("batches", BATCHES, "created_at"),
    Dataset("operations", OPERATIONS, "created_at"),
    Dataset("orders", ORDERS, "created_at", nested="order_items"),
    Dataset("cancelled_orders", CANCELLED_ORDERS, "order_creation_time", nested="cart"),
    Dataset("delivered_orders", DELIVERED_ORDERS, "order_creation_time", nested="delivered_products"),
    Dataset("warehouse_products", WAREHOUSE_PRODUCTS),
    Dataset("warehouse_products_hourly", WAREHOUSE_PRODUCTS_HOURLY, mode="append"),
    Dataset("product_catalogue", PRODUCT_CATALOGUE),
    Dataset("warehouse_catalogue", WAREHOUSE_CATALOGUE),
    Dataset("financial_daily", FINANCIAL_DAILY, "created_at"),
    Dataset("financial_monthly", FINANCIAL_MONTHLY, "created_at", step="month"),
    Dataset("financial_raw", FINANCIAL_RAW, "created_at"),
    Dataset("refunds_raw", REFUNDS_RAW, "created_at"),
)}

# Warehouse type names and their Spark types; any other name is kept as string.
WAREHOUSE_TYPES = {
    "STRING": T.StringType(),
    "BYTES": T.BinaryType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
    "TIME": T.TimeType(6),
    "DATETIME": T.TimestampNTZType(),
    "GEOGRAPHY": T.StringType(),
    "JSON": T.StringType(),
}


def spark_type(field: dict[str, Any]) -> T.DataType:
    """Spark type of one field of a warehouse schema in its JSON form, REPEATED mode included."""
    name = str(field.get("type", "")).upper()
    if name in ("RECORD", "STRUCT"):
        kind: T.DataType = spark_schema(field.get("fields", []))
    elif name in ("NUMERIC", "BIGNUMERIC"):
        precision = field.get("precision") or (38 if name == "NUMERIC" else 76)
        scale = field.get("scale")
        scale = scale if scale is not None else (9 if name == "NUMERIC" else 38)
        # Spark decimals end at 38 digits; wider ones stay exact as text.
        kind = T.DecimalType(precision, scale) if precision <= 38 else T.StringType()
    else:
        kind = WAREHOUSE_TYPES.get(name, T.StringType())
    return T.ArrayType(kind, True) if str(field.get("mode", "")).upper() == "REPEATED" else kind


def spark_schema(fields: list[dict[str, Any]]) -> T.StructType:
    """Spark schema of a warehouse schema given as its list of JSON field objects."""
    return T.StructType([
        T.StructField(f["name"], spark_type(f), str(f.get("mode", "")).upper() != "REQUIRED") for f in fields])
