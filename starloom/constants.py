"""Fixed values of the warehouse contract (names, sentinels, lineage numbers)."""

# Validity sentinels.
VALID_FROM = "2013-01-01 00:00:00"
VALID_TO = "2038-01-19 03:14:07.999999"
STOCK_ITEM_VALID_TO = "9999-12-31 23:59:59"
DEFAULT_SINCE = "1900-01-01 00:00:00"

# Lineage number written to each target table.
LINEAGE = {
    "city": 1,
    "customer": 0,
    "employee": 3,
    "payment_method": 4,
    "stock_item": 0,
    "supplier": 6,
    "transaction_type": 7,
    "order": 9,
    "sale": 11,
    "stock_holding": 12,
}

# Target table names, their surrogate keys and merge keys.
TARGETS = {
    "city": ("dimension_city", "CityKey", ["WWICityID", "ValidFrom"]),
    "employee": ("dimension_employee", "EmployeeKey", ["WWIEmployeeID", "ValidFrom"]),
    "customer": ("dimension_customer", "CustomerKey", ["WWICustomerID", "ValidFrom"]),
    "stock_item": ("dimension_stockitem", "StockItemKey", ["WWIStockItemID", "ValidFrom"]),
    "transaction_type": ("dimension_transactiontype", "TransactionTypeKey", ["TransactionTypeKey", "ValidFrom"]),
    "supplier": ("dimension_supplier", "SupplierKey", ["SupplierKey", "ValidFrom"]),
    "payment_method": ("dimension_paymentmethod", "PaymentMethodKey", ["WWIPaymentMethodID", "ValidFrom"]),
    "calendar": ("dimension_date", None, ["Date"]),
    "sale": ("fact_sale", "SaleKey", ["StockItemKey", "WWIInvoiceID"]),
    "stock_holding": ("fact_stockholding", "StockHoldingKey", ["StockItemKey"]),
    "order": ("fact_order", "OrderKey", ["StockItemKey", "WWIOrderID"]),
}

DIMENSIONS = ["city", "employee", "customer", "stock_item", "transaction_type", "supplier", "payment_method"]
FACTS = ["sale", "stock_holding", "order"]

# Source tables the raw layer copies, by how their changes are found.
REGULAR_TABLES = [
    "Application_SystemParameters",
    "Sales_Invoices",
    "Sales_InvoiceLines",
    "Sales_OrderLines",
    "Sales_Orders",
    "Sales_SpecialDeals",
    "Warehouse_StockItemHoldings",
    "Warehouse_StockItemStockGroups",
    "Warehouse_StockItemTransactions",
    "Purchasing_PurchaseOrders",
    "Purchasing_PurchaseOrderLines",
]
TEMPORAL_TABLES = [
    "Application_Cities",
    "Application_Countries",
    "Application_DeliveryMethods",
    "Application_PaymentMethods",
    "Application_People",
    "Application_StateProvinces",
    "Application_TransactionTypes",
    "Purchasing_SupplierCategories",
    "Purchasing_Suppliers",
    "Sales_BuyingGroups",
    "Sales_CustomerCategories",
    "Sales_Customers",
    "Warehouse_ColdRoomTemperatures",
    "Warehouse_Colors",
    "Warehouse_PackageTypes",
    "Warehouse_StockGroups",
    "Warehouse_StockItems",
]
# Declared like the regular tables, but in no load list.
UNLISTED_TABLES = ["Sales_CustomerTransactions"]

# Geography columns that are extracted as text.
GEOGRAPHY_COLUMNS = {
    "Application_SystemParameters": ["DeliveryLocation"],
    "Application_Cities": ["Location"],
    "Application_Countries": ["Border"],
    "Application_StateProvinces": ["Border"],
    "Purchasing_Suppliers": ["DeliveryLocation"],
    "Sales_Customers": ["DeliveryLocation"],
}

# The columns a sample of each source table is ordered by.
SAMPLE_ORDER = {
    "Application_SystemParameters": ["SystemParameterID"],
    "Sales_Invoices": ["InvoiceID"],
    "Sales_InvoiceLines": ["InvoiceID"],
    "Sales_OrderLines": ["OrderLineID"],
    "Sales_Orders": ["OrderID"],
    "Sales_SpecialDeals": ["SpecialDealID"],
    "Warehouse_StockItemHoldings": ["StockItemID"],
    "Warehouse_StockItemStockGroups": ["StockItemID"],
    "Warehouse_StockItemTransactions": ["StockItemID"],
    "Application_Cities": ["CityID"],
    "Application_Countries": ["LastEditedBy", "Region"],
    "Application_DeliveryMethods": ["DeliveryMethodID"],
    "Application_PaymentMethods": ["PaymentMethodID"],
    "Application_People": ["IsPermittedToLogon", "PersonID"],
    "Application_StateProvinces": ["LastEditedBy", "StateProvinceID"],
    "Application_TransactionTypes": ["TransactionTypeID"],
    "Sales_BuyingGroups": ["BuyingGroupID"],
    "Sales_CustomerCategories": ["CustomerCategoryID"],
    "Sales_Customers": ["PrimaryContactPersonID"],
    "Warehouse_ColdRoomTemperatures": ["ColdRoomTemperatureID"],
    "Warehouse_Colors": ["ColorID"],
    "Warehouse_PackageTypes": ["PackageTypeID"],
    "Warehouse_StockGroups": ["StockGroupID"],
    "Warehouse_StockItems": ["StockItemID"],
}
