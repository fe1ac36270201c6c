"""Row schemas of the typed inputs. Event times are epoch seconds unless noted."""

from __future__ import annotations

SENSOR = "id string, ts long, vc int"
USER_BEHAVIOR = "user_id long, item_id long, category_id int, behavior string, ts long"
AD_CLICK = "user_id long, ad_id long, province string, city string, ts long"
LOGIN = "user_id long, ip string, event_type string, ts long"
ORDER_EVENT = "order_id long, event_type string, tx_id string, ts long"
RECEIPT = "tx_id string, pay_channel string, ts long"
# ts is epoch milliseconds here.
MARKETING = "user_id long, behavior string, channel string, ts long"
# Parsed from free text, so the event time is a timestamp.
ACCESS_LOG = "ip string, user_id string, event_time timestamp, method string, url string"

# Result rows of the windowed reports.
ITEM_COUNT = "item_id long, item_count long, window_end long"
PAGE_COUNT = "url string, page_count long, window_end long"
AD_COUNT_BY_PROVINCE = "ad_id long, province string, click_count long, window_end long"
AD_COUNT_BY_USER = "ad_id long, user_id long, click_count long, window_end long"
