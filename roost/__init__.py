"""Roost: device pings to stops, places, and home/work pairs, as Spark DataFrames.

Each step is a plain ``DataFrame -> DataFrame`` function, usable on its own or
chained with ``DataFrame.transform``:

    detect_stops -> cluster_stops -> localize_stops -> classify_home_work
    -> extract_home_work
"""

from roost.operators.carried import detect_stops_after, stops_still_open
from roost.operators.clusters import cluster_stops
from roost.operators.homework import classify_home_work
from roost.operators.localtime import localize_stops
from roost.operators.places import extract_home_work
from roost.operators.stops import detect_stops
from roost.params import ClusterParams, CountryParams, HomeWorkParams, StopParams
from roost.plans.full_run import run_countries, run_steps
from roost.plans.together import run_together

__all__ = [
    "ClusterParams",
    "CountryParams",
    "HomeWorkParams",
    "StopParams",
    "classify_home_work",
    "cluster_stops",
    "detect_stops",
    "detect_stops_after",
    "extract_home_work",
    "localize_stops",
    "run_countries",
    "run_steps",
    "run_together",
    "stops_still_open",
]
