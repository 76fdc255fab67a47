"""Declared schemas: nothing is inferred, prices never pass through floating point."""

from pyspark.sql import types as T

PRICE = T.DecimalType(20, 2)


def _struct(text: str) -> T.StructType:
    kinds = {"long": T.LongType(), "int": T.IntegerType(), "bool": T.BooleanType(), "price": PRICE, "text": T.StringType(), "ts": T.TimestampType(), "date": T.DateType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (x.split(":") for x in text.split())])


#: An order as the paged interface sends it; region_id is added from the page.
ORDER = _struct("order_id:long type_id:long location_id:long system_id:long is_buy_order:bool price:price volume_remain:long volume_total:long min_volume:int duration:int range:text issued:ts")
#: A landed page with its headers, or a part of a page that has many orders; then page_orders is how many the whole page has.
PAGE = T.StructType(
    [*_struct("sweep_id:text region_id:long page:int attempt:int status:int x_pages:text remaining:int last_modified:text expires:text page_orders:long"), T.StructField("orders", T.ArrayType(ORDER))]
)
ORDER_KEY = ["region_id", "order_id"]
#: The columns whose change makes an update.
ORDER_VALUES = ["type_id", "location_id", "system_id", "is_buy_order", "price", "volume_remain", "volume_total", "min_volume", "duration", "range", "issued"]
ORDER_COLUMNS = [*ORDER_KEY, *ORDER_VALUES]
HISTORY_KEY = ["region_id", "type_id", "date"]
HISTORY_VALUES = ["average", "highest", "lowest", "order_count", "volume", "http_last_modified"]
HISTORY_COLUMNS = [*HISTORY_KEY, *HISTORY_VALUES]
HISTORY = _struct("region_id:long type_id:long date:date average:price highest:price lowest:price order_count:long volume:long http_last_modified:ts")
EVERY_DAY = _struct("day:date totals_count:long rows_upserted:long watermark:ts imported_at:ts")
STATUS = _struct("region_id:long region_name:text priority:int order_count:long http_last_modified:ts expires_at:ts refreshed_at:ts duration_ms:int consecutive_errors:int last_error:text last_error_at:ts")
