"""odflow: prepare and route origin-destination trips as Spark DataFrame jobs."""

from odflow.plans.prepare import TripInputs, prepare
from odflow.plans.routing import RouteJob, route_trips, run_job, run_jobs
from odflow.plans.views import (
    ALL_IMPUTED,
    CITY,
    CITY_AS_WRITTEN,
    CITY_SENTINEL,
    EXTERNAL,
    ViewSpec,
)
from odflow.sources.network import TimedNetwork

__all__ = [
    "ALL_IMPUTED",
    "CITY",
    "CITY_AS_WRITTEN",
    "CITY_SENTINEL",
    "EXTERNAL",
    "RouteJob",
    "TimedNetwork",
    "TripInputs",
    "ViewSpec",
    "prepare",
    "route_trips",
    "run_job",
    "run_jobs",
]
