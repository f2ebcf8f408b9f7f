from tiffin.functions.columns import (  # noqa: F401
    any_of,
    city_key,
    delay_category,
    is_severe_weather,
    minutes_between,
    order_status,
    present,
    region_of_address,
)
