"""Two dimensions and one fact over the conformed retail tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import case_of, column, person_name
from ..operators.history import IS_CURRENT
from ..operators.merge import IS_DELETED
from ..sources.tables import TableStore

# Address roles, order status names and output columns.
MAIN_OFFICE = "Main Office"
SHIPPING = "Shipping"
ORDER_STATUS = {1: "In Process", 2: "Approved", 3: "Backordered", 4: "Rejected", 5: "Shipped", 6: "Cancelled"}
UNKNOWN_STATUS = "Unknown"
CUSTOMER_ADDRESS_FIELDS = {
    "Address": "AddressLine1",
    "City": "City",
    "State": "StateProvince",
    "Country": "CountryRegion",
    "PostalCode": "PostalCode",
}
PRODUCT_COLUMNS = (
    "ProductID", "Name", "ProductNumber", "Color", "StandardCost", "ListPrice", "Size", "Weight",
    "SellStartDate", "SellEndDate", "DiscontinuedDate",
)


def dim_product(product: DataFrame) -> DataFrame:
    """Every product, with its delete flag: facts still refer to discontinued ones."""
    return product.select(*[column(c) for c in (*PRODUCT_COLUMNS, IS_DELETED)])


def dim_customer(customer: DataFrame, customer_address: DataFrame, address: DataFrame) -> DataFrame:
    """Current customers with their office and shipping address, one row per customer.

    The bridge meets the addresses once; one aggregation then picks the lowest address id of each role. It runs
    partially before the shuffle and leaves the rows partitioned by customer, as the last join needs them.
    """
    joined = customer_address.alias("b").join(
        address.alias("a"), column("AddressID", "b") == column("AddressID", "a"), "inner"
    )
    fields = F.struct(
        column("AddressID", "a").alias("AddressID"),
        *[column(source, "a").alias(name) for name, source in CUSTOMER_ADDRESS_FIELDS.items()],
    )

    def first_in_role(role: str) -> Column:
        return F.min(F.when(column("AddressType", "b") == role, fields))

    by_customer = (
        joined.filter(column("AddressType", "b").isin(MAIN_OFFICE, SHIPPING))
        .groupBy(column("CustomerID", "b").alias("_customer"))
        .agg(first_in_role(MAIN_OFFICE).alias("_office"), first_in_role(SHIPPING).alias("_shipping"))
    )
    current = customer.filter(column(IS_CURRENT) == 1)
    return current.join(by_customer, column("CustomerID") == F.col("_customer"), "left").select(
        "CustomerID",
        "Title",
        "FirstName",
        "MiddleName",
        "LastName",
        person_name(F.col("FirstName"), F.col("MiddleName"), F.col("LastName")).alias("FullName"),
        "CompanyName",
        "EmailAddress",
        "Phone",
        *[F.col(f"_office.{name}").alias(f"Office{name}") for name in CUSTOMER_ADDRESS_FIELDS],
        *[F.col(f"_shipping.{name}").alias(f"Shipping{name}") for name in CUSTOMER_ADDRESS_FIELDS],
    )


def fact_sales(header: DataFrame, detail: DataFrame, address: DataFrame) -> DataFrame:
    """Order lines that are not deleted, under the current version of their order, with both addresses.

    No join is hinted: Catalyst broadcasts the addresses while they are under the session's limit, and beyond
    that every join is an equi-join whose repeated side adaptive execution can split where one key is hot.
    """
    ship, bill = address.alias("ship"), address.alias("bill")
    return (
        header.filter(column(IS_CURRENT) == 1)
        .alias("h")
        .join(ship, column("ShipToAddressID", "h") == column("AddressID", "ship"), "left")
        .join(bill, column("BillToAddressID", "h") == column("AddressID", "bill"), "left")
        .join(
            detail.filter(column(IS_DELETED) == 0).alias("d"),
            column("SalesOrderID", "h") == column("SalesOrderID", "d"),
            "inner",
        )
        .select(
            F.col("h.SalesOrderID"),
            F.col("h.OrderDate"),
            F.col("h.DueDate"),
            F.col("h.ShipDate"),
            case_of(F.col("h.Status"), ORDER_STATUS, UNKNOWN_STATUS).alias("status_description"),
            F.col("d.SalesOrderDetailID"),
            F.col("d.OrderQty"),
            F.col("d.ProductID"),
            F.col("d.UnitPrice"),
            F.col("d.UnitPriceDiscount"),
            F.col("d.LineTotal"),
            F.col("h.OnlineOrderFlag"),
            F.col("h.SalesOrderNumber"),
            F.col("h.CustomerID"),
            F.col("h.ShipToAddressID"),
            *_address("ship", "ShipAddress", "Ship", "ShipPostalCode"),
            *_address("bill", "BillToAddress", "Bill", "BillPostal"),
            F.col("h.ShipMethod"),
        )
    )


def _address(alias: str, line: str, prefix: str, postal: str) -> list[Column]:
    return [
        F.coalesce(F.col(f"{alias}.AddressLine1"), F.col(f"{alias}.AddressLine2")).alias(line),
        F.col(f"{alias}.City").alias(f"{prefix}City"),
        F.col(f"{alias}.StateProvince").alias(f"{prefix}State"),
        F.col(f"{alias}.CountryRegion").alias(f"{prefix}Country"),
        F.col(f"{alias}.PostalCode").alias(postal),
    ]


def build_mart(store: TableStore, name: str, catalog: str | None = None) -> str:
    """Build one mart from the conformed layer and publish it under its own table; returns the table's name."""
    prefix = f"{catalog}." if catalog else ""

    def conformed(table: str) -> DataFrame:
        return store.read(f"{prefix}silver.saleslt_{table}")

    builders = {
        "dim_customer": lambda: dim_customer(
            conformed("customer"), conformed("customeraddress"), conformed("address")
        ).sortWithinPartitions("CustomerID"),
        "dim_product": lambda: dim_product(conformed("product")),
        "fact_sales": lambda: fact_sales(
            conformed("salesorderheader"), conformed("salesorderdetail"), conformed("address")
        ),
    }
    if name not in builders:
        raise ValueError(f"unknown mart {name!r}; available: {', '.join(builders)}")
    table = f"{prefix}gold.{name}"
    store.replace(builders[name](), table)
    return table
