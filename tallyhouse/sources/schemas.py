"""Table layouts the plans expect. Keys are checked by quality rules, not by the layouts."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = DecimalType(10, 2)


def _table(required: dict[str, DataType], optional: dict[str, DataType] | None = None) -> StructType:
    fields = [StructField(n, t, False) for n, t in required.items()]
    fields += [StructField(n, t, True) for n, t in (optional or {}).items()]
    return StructType(fields)


def _texts(*names: str) -> dict[str, DataType]:
    return dict.fromkeys(names, StringType())


# Raw order file: everything is text until cleaning decides what it is.
RAW_ORDERS = _table(
    {}, _texts("order_id", "order_date", "order_customer_id", "order_status", "sum")
)

STAFF = _table({}, {"id": IntegerType(), "name": StringType(), "age": IntegerType()})

SALES = _table(
    {"customer_id": StringType(), "order_date": DateType(), "product_id": IntegerType()}
)
MENU = _table({"product_id": IntegerType(), "product_name": StringType(), "price": IntegerType()})
MEMBERS = _table({"customer_id": StringType(), "join_date": DateType()})

PRODUCT_LINES = _table(
    _texts("productLine"), {**_texts("textDescription", "htmlDescription"), "image": BinaryType()}
)
PRODUCTS = _table(
    {
        **_texts(
            "productCode",
            "productName",
            "productLine",
            "productScale",
            "productVendor",
            "productDescription",
        ),
        "quantityInStock": ShortType(),
        "buyPrice": MONEY,
        "MSRP": MONEY,
    }
)
OFFICES = _table(
    _texts("officeCode", "city", "phone", "addressLine1", "country", "postalCode", "territory"),
    _texts("addressLine2", "state"),
)
EMPLOYEES = _table(
    {
        "employeeNumber": IntegerType(),
        **_texts("lastName", "firstName", "extension", "email", "officeCode", "jobTitle"),
    },
    {"reportsTo": IntegerType()},
)
CUSTOMERS = _table(
    {
        "customerNumber": IntegerType(),
        **_texts(
            "customerName",
            "contactLastName",
            "contactFirstName",
            "phone",
            "addressLine1",
            "city",
            "country",
        ),
    },
    {
        **_texts("addressLine2", "state", "postalCode"),
        "salesRepEmployeeNumber": IntegerType(),
        "creditLimit": MONEY,
    },
)
ORDERS = _table(
    {
        "orderNumber": IntegerType(),
        "orderDate": DateType(),
        "requiredDate": DateType(),
        "status": StringType(),
        "customerNumber": IntegerType(),
    },
    {"shippedDate": DateType(), "comments": StringType()},
)
PAYMENTS = _table(
    {
        "customerNumber": IntegerType(),
        "checkNumber": StringType(),
        "paymentDate": DateType(),
        "amount": MONEY,
    }
)
ORDER_DETAILS = _table(
    {
        "orderNumber": IntegerType(),
        "productCode": StringType(),
        "quantityOrdered": IntegerType(),
        "priceEach": MONEY,
        "orderLineNumber": ShortType(),
    }
)

CUSTOMER_CONTACTS = _table({"customer_id": LongType()}, _texts("customer_name", "phone"))

ITEMS = _table(
    {"item_id": IntegerType()},
    {"name": StringType(), "price": IntegerType(), "stock": IntegerType()},
)

_VIDEO_TEXTS = (
    "video_id",
    "channel_title",
    "publish_time",
    "trending_date",
    "category_id",
    "views",
    "likes",
    "dislikes",
    "comment_count",
    "comments_disabled",
    "ratings_disabled",
    "video_error_or_removed",
)
RAW_VIDEOS = _table({}, _texts(*_VIDEO_TEXTS))
BRONZE_VIDEOS = _table({}, {**_texts(*_VIDEO_TEXTS), "publish_ts": TimestampType()})
SILVER_VIDEOS = _table(
    {},
    {
        **_texts("video_id", "channel_title"),
        "trending_date": DateType(),
        "category_id": IntegerType(),
        **dict.fromkeys(("views", "likes", "dislikes", "comment_count"), LongType()),
        **dict.fromkeys(
            ("comments_disabled", "ratings_disabled", "video_error_or_removed"), BooleanType()
        ),
        "publish_ts": TimestampType(),
    },
)

PRIMARY_KEYS = {
    "product_lines": ("productLine",),
    "products": ("productCode",),
    "offices": ("officeCode",),
    "employees": ("employeeNumber",),
    "customers": ("customerNumber",),
    "orders": ("orderNumber",),
    "payments": ("customerNumber", "checkNumber"),
    "order_details": ("orderNumber", "productCode"),
}

# (child table, column, parent table, parent key)
FOREIGN_KEYS = (
    ("products", "productLine", "product_lines", "productLine"),
    ("employees", "officeCode", "offices", "officeCode"),
    ("employees", "reportsTo", "employees", "employeeNumber"),
    ("customers", "salesRepEmployeeNumber", "employees", "employeeNumber"),
    ("orders", "customerNumber", "customers", "customerNumber"),
    ("payments", "customerNumber", "customers", "customerNumber"),
    ("order_details", "orderNumber", "orders", "orderNumber"),
    ("order_details", "productCode", "products", "productCode"),
)
