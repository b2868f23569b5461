"""Explicit schemas of the retail files."""

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


LONG, INT, DOUBLE, STRING = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()

SCHEMAS = {
    "aisles": _struct(aisle_id=LONG, aisle=STRING),
    "departments": _struct(department_id=LONG, department=STRING),
    "products": _struct(product_id=LONG, product_name=STRING, aisle_id=LONG, department_id=LONG),
    "orders": _struct(
        order_id=LONG,
        user_id=LONG,
        eval_set=STRING,
        order_number=INT,
        order_dow=INT,
        order_hour_of_day=INT,
        days_since_prior_order=DOUBLE,
    ),
    "order_products": _struct(order_id=LONG, product_id=LONG, add_to_cart_order=INT, reordered=INT),
    "assignments": _struct(user_id=LONG, cluster=INT),
    "lifecycle_assignments": _struct(user_id=LONG, lifecycle_stage=STRING),
}
