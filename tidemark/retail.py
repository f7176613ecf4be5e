"""The retail deployment: seven source tables and the layers they land in."""

from __future__ import annotations

from .spec import ChangeFeed, LoadStrategy, SpecSet, TableSpec

# Source tables, their columns, keys and layer names.
SOURCE_SCHEMA = "SalesLT"
INITIAL_WATERMARK = "1900-01-01 00:00:00"

PRODUCT_COLUMNS = (
    "ProductID", "Name", "ProductNumber", "Color", "StandardCost", "ListPrice", "Size", "Weight",
    "ProductCategoryID", "ProductModelID", "SellStartDate", "SellEndDate", "DiscontinuedDate", "rowguid",
    "ModifiedDate",
)
ORDER_HEADER_COLUMNS = (
    "SalesOrderID", "RevisionNumber", "OrderDate", "DueDate", "ShipDate", "Status", "OnlineOrderFlag",
    "SalesOrderNumber", "PurchaseOrderNumber", "AccountNumber", "CustomerID", "ShipToAddressID",
    "BillToAddressID", "ShipMethod", "CreditCardApprovalCode", "SubTotal", "TaxAmt", "Freight", "TotalDue",
    "Comment", "rowguid", "ModifiedDate",
)
ADDRESS_COLUMNS = (
    "AddressID", "AddressLine1", "AddressLine2", "City", "StateProvince", "CountryRegion", "PostalCode",
)
CUSTOMER_ADDRESS_COLUMNS = ("CustomerID", "AddressID", "AddressType")
ORDER_DETAIL_COLUMNS = (
    "SalesOrderID", "SalesOrderDetailID", "OrderQty", "ProductID", "UnitPrice", "UnitPriceDiscount", "LineTotal",
)
CUSTOMER_COLUMNS = (
    "CustomerID", "NameStyle", "Title", "FirstName", "MiddleName", "LastName", "Suffix", "CompanyName",
    "SalesPerson", "EmailAddress", "Phone", "PasswordHash", "PasswordSalt", "rowguid", "ModifiedDate",
)
CUSTOMER_SECRETS = ("PasswordHash", "PasswordSalt")
ORDER_DETAIL_CAPTURE = "SalesLT_SalesOrderDetail"


def retail_specs(catalog: str | None = None, buckets: int = 0, parts: int = 0) -> SpecSet:
    """Specs with layer tables in ``catalog``, or in the session catalog when it is None.

    ``buckets`` is the number of buckets of new conformed tables that are merged into by key, ``parts`` the number of
    parts of new conformed tables of any kind.
    """
    prefix = f"{catalog}." if catalog else ""

    def spec(table_id: str, table: str, strategy: LoadStrategy, key: tuple[str, ...], columns: tuple[str, ...],
             conformed: str | None = None, merged: bool = False, **more) -> TableSpec:
        return TableSpec(
            table_id=table_id,
            source_schema=SOURCE_SCHEMA,
            source_table=table,
            raw_table=f"{prefix}bronze.{table_id}",
            conformed_table=f"{prefix}silver.{conformed or table_id}",
            primary_key=key,
            strategy=strategy,
            columns=columns,
            buckets=buckets if merged else 0,
            parts=parts,
            **more,
        )

    by_modified = {"watermark_column": "ModifiedDate", "initial_watermark": INITIAL_WATERMARK}
    detail_key = ("SalesOrderID", "SalesOrderDetailID")
    return SpecSet.of(
        spec("saleslt_product", "Product", LoadStrategy.INCREMENTAL_SOFT_DELETE, ("ProductID",), PRODUCT_COLUMNS,
             merged=True, soft_delete_column="DiscontinuedDate", partition_column="ProductID", **by_modified),
        spec("saleslt_salesorderheader", "SalesOrderHeader", LoadStrategy.INCREMENTAL_UPSERT, ("SalesOrderID",),
             ORDER_HEADER_COLUMNS, partition_column="SalesOrderID", **by_modified),
        spec("saleslt_address", "Address", LoadStrategy.FULL_SNAPSHOT, ("AddressID",), ADDRESS_COLUMNS,
             partition_column="AddressID"),
        spec("saleslt_customeraddress", "CustomerAddress", LoadStrategy.FULL_SNAPSHOT, ("CustomerID", "AddressID"),
             CUSTOMER_ADDRESS_COLUMNS, partition_column="CustomerID"),
        spec("saleslt_salesorderdetail_snapshot", "SalesOrderDetail", LoadStrategy.FULL_SNAPSHOT, detail_key,
             ORDER_DETAIL_COLUMNS, conformed="saleslt_salesorderdetail", merged=True, partition_column="SalesOrderID",
             baseline_capture_instance=ORDER_DETAIL_CAPTURE),
        spec("saleslt_salesorderdetail_cdc", "SalesOrderDetail", LoadStrategy.INCREMENTAL_CDC, detail_key, ("*",),
             conformed="saleslt_salesorderdetail", merged=True,
             change_feed=ChangeFeed(ORDER_DETAIL_CAPTURE, "all",
                                    baseline_table=f"{prefix}bronze.saleslt_salesorderdetail_snapshot",
                                    partition_column="SalesOrderID")),
        spec("saleslt_customer", "Customer", LoadStrategy.INCREMENTAL_UPSERT, ("CustomerID",), CUSTOMER_COLUMNS,
             exclude_columns=CUSTOMER_SECRETS, partition_column="CustomerID", **by_modified),
    )
