"""Fixed values of the pipeline and the knobs that bound task sizes."""

from __future__ import annotations

# Topic names.
TOPICS = {
    "orders": "orders-topic",
    "order_events": "orders-events-topic",
    "complaints": "complaints-late-topic",
    "weather": "weather-api-topic",
}

# The steps of an order, in time order.
ORDER_RECEIVED = "order_received"
ORDER_IN_PREPARATION = "order_in_preparation"
ORDER_SENT_OUT = "order_sent_out_for_delivery"
ORDER_DELIVERED = "order_delivered"
EVENT_TYPES = (ORDER_RECEIVED, ORDER_IN_PREPARATION, ORDER_SENT_OUT, ORDER_DELIVERED)

# Order status.
ON_TIME = "on_time"
LATE = "late"

# Delay categories and their exclusive upper bounds in minutes; the rest is extreme.
DELAY_STEPS = ((5, "on_time"), (15, "minor_delay"), (60, "major_delay"))
EXTREME_DELAY = "extreme_delay"

# Gold tables count a delivery as late when its category is listed here. The default is the
# value the reports have always used; no category carries that name, so the share is 0.
REPORTED_LATE = (LATE,)
# Every category but on_time: the corrected reading.
ALL_LATE = ("minor_delay", "major_delay", "extreme_delay")

# Complaint types the quality check accepts.
COMPLAINT_TYPES = ("Late delivery", "Missing item", "Wrong order", "Cold food")

# Limits and horizons.
MAX_DELAY_MINUTES = 300
LATE_DATA_HORIZON = "48 hours"
WEATHER_BAND_SECONDS = 3600
SEVERE_PRECIPITATION = 20
SEVERE_WIND = 40

# Calendar bounds and holidays (month-day).
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2029-12-31"
HOLIDAYS = ("01-01", "12-25")
WEEKEND = ("Saturday", "Sunday")
SHORT_DAY = "Friday"
