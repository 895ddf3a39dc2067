"""Column contracts of the feeds and of the published tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Feed headers as they arrive, silver column order, gold column order.
# ---------------------------------------------------------------------------

STATE_HEADERS = ["SNO", "State", "Local Government Area"]
STATE_SILVER = ["STATE_ID", "STATE_NAME", "LOCAL_GOVERNMENT_AREA"]

BOOK_STOCK_STEMS = [
    "OPENING_PMS_BALANCE", "PMS_LOAD_OUT", "CLOSING_PMS_BALANCE_LITRES",
    "OPENING_AGO_BALANCE", "AGO_LOAD_OUT", "CLOSING_AGO_BALANCE",
    "OPENING_DPK_BALANCE", "DPK_LOAD_OUT", "CLOSING_DPK_BALANCE_LITRES",
]
BOOK_STOCK_SILVER = ["SERIAL_NO", "DEPOT_NAME", *BOOK_STOCK_STEMS, "BOOK_STOCK_DATE", "FILE_NAME", "STATION"]
BOOK_STOCK_DEPOTS = ["NRL_ABUJA", "NRL_LAGOS"]

PDO_COLUMNS = [
    "METER_TICKET_NUMBER", "DISPATCH_NUMBER", "PLAN_DATE", "DOCUMENT_REFERENCE", "CUSTOMER_NAME",
    "TRUCK_NUMBER", "DESTINATION", "PRODUCT_TYPE", "LOADING_DEPOT", "LOADING_DATE", "LOCATION",
    "TD_ZONE", "MARKETER_REP", "QUANTITY_TO_LOAD", "LOADED_QUANTITY", "VARIANCE",
]

SAP_COLUMNS = [
    "SALES_QUOTATION", "RRR_NUMBER", "SALES_DOCUMENT", "DISPATCH_NUMBER", "WAYBILL_NUMBER",
    "RESERVATION_NO", "TICKET_NUMBER", "LOADING_DEPOT_NAME", "PRODUCT_TYPE", "BATCH",
    "TRANSACTION_TYPE", "QUANTITY_LOADED", "TRANSACTION_UOM12", "LOADING_DATE", "MONTH",
    "REGISTERED_OWNER", "VEHICLE_NUMBER", "RECEIVING_DEPOT", "TRANSIT_TRUCK_STATUS",
    "QUANTITY_ORDERED", "QUANTITY_DISPATCHED", "DISPATCH_DATE", "SHIPMENT_STATUS", "DESTINATION",
    "DELIVERY_STATION", "DISTRIBUTION_CHANNEL", "DELIVERY_DATE", "QUANTITY_DELIVERED",
    "TRANSACTION_UOM28", "CREATED_BY", "CHANGED_BY",
]
SAP_QUANTITIES = ["QUANTITY_ORDERED", "QUANTITY_DELIVERED", "QUANTITY_DISPATCHED", "QUANTITY_LOADED"]

DODO_DOTTED_HEADERS = {
    "Delivery Doc. Number": "Delivery_Doc_Number",
    "Shipment Doc. Number": "Shipment_Doc_Number",
    "Delivery Truck Plate Number": "Delivery_Truck_Plate_Number",
    "Clearing Doc. Number": "Clearing_Doc_Number",
}
DODO_HEADERS = [
    "Customer Name", "SAP Quotation Number", "Product", "Quantity", "RRR Number",
    "SAP Payment Number", "Amount Paid", "SAP Sales Order Number", "Quantity Sold",
    "Delivery Doc. Number", "Shipment Doc. Number", "Quantity Received",
    "Delivery Truck Plate Number", "Clearing Doc. Number", "Sales Date", "State", "Region",
    "Completed On",
]
DODO_COLUMNS = [
    "CUSTOMER_NAME", "SAP_QUOTATION_NUMBER", "PRODUCT", "QUANTITY", "RRR_NUMBER",
    "SAP_PAYMENT_NUMBER", "AMOUNT_PAID", "SAP_SALES_ORDER_NUMBER", "QUANTITY_SOLD",
    "DELIVERY_DOC_NUMBER", "SHIPMENT_DOC_NUMBER", "QUANTITY_RECEIVED",
    "DELIVERY_TRUCK_PLATE_NUMBER", "CLEARING_DOC_NUMBER", "SALES_DATE", "STATE", "REGION",
    "COMPLETED_ON", "FILE_NAME", "SALES_TIME",
]
DODO_QUANTITIES = ["QUANTITY", "QUANTITY_RECEIVED", "QUANTITY_SOLD"]

STOCK_COLUMNS = [
    "RECORD_ID", "STATION", "TANK_DESCRIPTION", "PRODUCT", "DIP_READING", "STATUS", "SALES_DATE",
    "DATE_CREATED",
]
METER_COLUMNS = [
    "RECORD_ID", "STATION", "METER_DESCRIPTION", "PRODUCT", "PREVIOUS_READING", "CURRENT_READING",
    "VOLUME", "TYPE", "UNIT_PRICE", "SALES_VALUE", "DEALER_COMMISSION", "DEALER_COMMISSION_AMOUNT",
    "STATUS", "SALES_DATE", "DATE_CREATED",
]
TRUCK_COLUMNS = [
    "RECORD_ID", "STATION", "MATERIAL", "QUANTITY", "STATUS", "DELIVERY_DATE", "DATE_CREATED",
]

CODO_RAW = [
    "STATION", "PRODUCT", "SALES_DATE", "MATERIAL", "QUANTITY", "TRUCK_DELIVERY_STATUS",
    "DELIVERY_DATE", "TRUCK_DELIVERY_DATE_CREATED", "DATE_LAG", "NEXT_DELIVERY_DAYS",
    "TANK_DESCRIPTION", "DIP_READING", "STOCK_VOLUME_STATUS", "STOCK_VOLUME_DATE_CREATED",
    "METER_DESCRIPTION", "PREVIOUS_READING", "CURRENT_READING", "VOLUME", "TYPE", "UNIT_PRICE",
    "SALES_VALUE", "DEALER_COMMISSION", "DEALER_COMMISSION_AMOUNT", "METER_READING_STATUS",
    "METER_READING_DATE_CREATED",
]
CODO_AGG = [
    "STATION", "MATERIAL", "DELIVERY_DATE", "QUANTITY", "COUNT_OF_NEW_ORDERS",
    "TOTAL_NUMBER_OF_TANKS", "TOTAL_STATION_CAPACITY", "TANK_DESCRIPTION", "MAX_DEEP_READING",
    "METER_DESCRIPTION", "TYPE", "SALES_DATE", "TOTAL_DAILY_SALES_VALUE",
    "TOTAL_DAILY_VOLUME_PRODUCT_SOLD", "TOTAL_VOLUME_SOLD_POST_CURRENT_DELIVERY_DATE",
    "CURRENT_DELIVERY_DATE", "CURRENT_DELIVERED_QUANTITY", "PRODUCT", "MAX_VOLUME_PRODUCT_SOLD",
    "MEDIAN_VOLUME_PRODUCT_SOLD", "MIN_VOLUME_PRODUCT_SOLD", "TOTAL_SALES_VALUE", "MAX_SALES_VALUE",
    "MEDIAN_SALES_VALUE", "MIN_SALES_VALUE", "MAX_CURRENT_READING", "MEDIAN_CURRENT_READING",
    "MIN_CURRENT_READING", "MAX_PREVIOUS_READING", "MEDIAN_PREVIOUS_READING", "MIN_PREVIOUS_READING",
]
SAP_DODO = [
    "SALES_QUOTATION", "RRR_NUMBER", "SALES_DOCUMENT", "DISPATCH_NUMBER", "WAYBILL_NUMBER",
    "RESERVATION_NO", "TICKET_NUMBER", "LOADING_DEPOT_NAME", "PRODUCT_TYPE", "BATCH",
    "TRANSACTION_TYPE", "TRANSACTION_UOM12", "LOADING_DATE", "MONTH", "REGISTERED_OWNER",
    "VEHICLE_NUMBER", "RECEIVING_DEPOT", "TRANSIT_TRUCK_STATUS", "QUANTITY_LOADED",
    "QUANTITY_ORDERED", "QUANTITY_DELIVERED", "QUANTITY_DISPATCHED", "QUANTITY",
    "QUANTITY_ORDERED_TEMP_TOLERANCE_MIN", "QUANTITY_ORDERED_TEMP_TOLERANCE_MAX",
    "IS_QUANTITY_DELIVERED_WITHIN_TEMP_THRESHOLD", "SALES_DATE", "SALES_TIME",
    "SALES_DATE_DAY_OF_WEEK", "DISPATCH_DATE", "DISPATCH_DATE_DAY_OF_WEEK", "DELIVERY_DATE",
    "DELIVERY_DATE_DAY_OF_WEEK", "COMPLETED_ON", "COMPLETED_ON_DATE_DAY_OF_WEEK", "DELIVERY_DAYS",
    "DELIVERY_IS_DELAYED", "ORDER_PROCESSING_DAYS", "IS_PRODUCT_IN_TRANSIST", "SHIPMENT_STATUS",
    "DESTINATION", "DELIVERY_STATION", "DISTRIBUTION_CHANNEL", "TRANSACTION_UOM28", "CREATED_BY",
    "CHANGED_BY", "CUSTOMER_NAME", "SAP_QUOTATION_NUMBER", "PRODUCT", "DODO_RRR_NUMBER",
    "SAP_PAYMENT_NUMBER", "AMOUNT_PAID", "SAP_SALES_ORDER_NUMBER", "QUANTITY_SOLD",
    "DELIVERY_DOC_NUMBER", "SHIPMENT_DOC_NUMBER", "QUANTITY_RECEIVED",
    "DELIVERY_TRUCK_PLATE_NUMBER", "CLEARING_DOC_NUMBER", "STATE", "REGION",
]

TWEET_HEADERS = [
    "Tweet_id", "Author", "Tweet Date", "Follower Count", "Friends Count", "Account Verified",
    "Favorite Count", "Accout Creation", "Retweets", "Tweet Text", "UserDesc", "Device", "Timezone",
    "Language", "Following", "Follow Request Sent", "Profile", "statuses_count", "Location",
    "filter_col", "load_date",
]
TWEETS_SENTIMENT = [
    "author", "tweet_date", "follower_count", "friends_count", "account_verified", "favorite_count",
    "accout_creation", "retweets", "tweet_text", "userdesc", "device", "timezone", "tweet_language",
    "following", "follow_request_sent", "profile", "statuses_count", "location", "country",
    "filter_col", "tweet_time", "df_tweet", "longeractions", "sentiment", "load_date",
]
TWEETS_EXPORT = [
    "tweet_id", "author", "tweet_date", "follower_count", "friends_count", "account_verified",
    "favorite_count", "accout_creation", "retweets", "tweet_text", "userdesc", "device", "timezone",
    "language", "following", "follow_request_sent", "profile", "statuses_count", "location",
    "filter_col", "tweet_time", "df_tweet", "interactions", "sentiment",
]
WEB_SENTIMENT = [
    "keywords", "site", "source", "createdat", "updatedat", "created_date", "analyzed_words",
    "sentiment",
]

AUDIT_COLUMNS = ["RUN_DATE_ID", "INSERT_LOAD_TIME_ID", "INSERT_LOAD_TIME"]

# ---------------------------------------------------------------------------


def _headers(columns: list[str]) -> list[str]:
    return [c.replace("_", " ").title() for c in columns]


@dataclass(frozen=True)
class Feed:
    """One daily landing feed: where a day's file lies, its header row and its business date."""

    name: str
    file: str
    headers: list[str]
    date_column: str
    date_format: str = "yyyy-MM-dd"
    renames: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        """Landing text is read as text; silver contracts cast it tolerantly."""
        return T.StructType([T.StructField(h, T.StringType()) for h in self.headers])


PDO_LOADING = Feed("pdo_loading", "ph_pdo_loading_report.csv", _headers(PDO_COLUMNS), "LOADING_DATE")
SAP_LOADING = Feed("sap_loading", "sap_loading_report.csv", _headers(SAP_COLUMNS), "LOADING_DATE")
DODO_ORDERS = Feed(
    "dodo_stations_order_report", "dodo_stations_order_report.csv", DODO_HEADERS, "SALES_DATE",
    "dd/MM/yyyy H:mm", DODO_DOTTED_HEADERS,
)
CODO_STOCK = Feed("codo_stations_stock_volume", "codo_stations_stock_volume.csv", _headers(STOCK_COLUMNS), "SALES_DATE")
CODO_METER = Feed("codo_station_meter_reading", "codo_station_meter_reading.csv", _headers(METER_COLUMNS), "SALES_DATE")
CODO_TRUCKS = Feed("codo_stations_truck_deliveries", "codo_stations_truck_deliveries.csv", _headers(TRUCK_COLUMNS), "DELIVERY_DATE")
