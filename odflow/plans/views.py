"""The rule sets a day of trips can be prepared under."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Literal


@dataclass(frozen=True)
class ViewSpec:
    """What differs between the ways of preparing trips.

    time_column      column whose date is the service day
    snap             'all': every end is snapped; 'city': only ends in the city municipality
    gateways         replace out-of-town ends by gateway nodes
    endpoint_rule    which trips and segments are kept, by their two ends:
                     'has_geom' both have a point, 'null_geom' both have none,
                     'sentinel' neither is the outside intersection,
                     'external' either is in a neighbouring municipality,
                     'external_or_city' as before, or in the city
    valid_time       'row': stops of passengers without valid times are dropped;
                     'having': such passengers only do not count towards a pool
    segment_pickup   a segment starts at its 'stop' time or at the 'passenger' pickup time
    drop_last        the last stop is dropped before ('set') or after ('final') it is
                     decided which passengers are covered by segments
    emit_pooled      add the pooled flag
    emit_ext_trip    add the ext_trip flag
    """

    name: str
    time_column: str = "request_datetime"
    snap: Literal["all", "city"] = "all"
    gateways: bool = False
    endpoint_rule: Literal["has_geom", "null_geom", "sentinel", "external", "external_or_city"] = "has_geom"
    valid_time: Literal["row", "having"] = "row"
    segment_pickup: Literal["stop", "passenger"] = "stop"
    drop_last: Literal["set", "final"] = "set"
    emit_pooled: bool = True
    emit_ext_trip: bool = False


CITY = ViewSpec("city")
CITY_AS_WRITTEN = ViewSpec("city_as_written", endpoint_rule="null_geom")
CITY_SENTINEL = ViewSpec("city_sentinel", endpoint_rule="sentinel", valid_time="having",
                         segment_pickup="passenger", emit_pooled=False)
EXTERNAL = ViewSpec("external", snap="city", gateways=True, endpoint_rule="external", drop_last="final")
ALL_IMPUTED = ViewSpec("all_imputed", time_column="pickup_datetime", snap="city", gateways=True,
                       endpoint_rule="external_or_city", drop_last="final", emit_ext_trip=True)
