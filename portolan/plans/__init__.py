from portolan.plans.cleaning import clean_arrivals, clean_demographics, clean_temperature
from portolan.plans.dimensions import (
    build_calendar_dimension,
    build_country_dimension,
    build_demographics_dimension,
    build_key_dimension,
)
from portolan.plans.etl import StarTables, build_star, check_star, loss_report, open_star, publish_star
from portolan.plans.increment import publish_increment
from portolan.plans.job import run_etl
from portolan.plans.star import build_fact, star_summary

__all__ = [
    "StarTables",
    "build_calendar_dimension",
    "build_country_dimension",
    "build_demographics_dimension",
    "build_fact",
    "build_key_dimension",
    "build_star",
    "check_star",
    "clean_arrivals",
    "clean_demographics",
    "clean_temperature",
    "loss_report",
    "open_star",
    "publish_increment",
    "publish_star",
    "run_etl",
    "star_summary",
]
