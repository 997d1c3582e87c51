"""Schemas of the source tables and comments for the columns of the star."""

from __future__ import annotations

# Column names and types of the sources.
ARRIVALS = """
    cicid double, i94yr double, i94mon double, i94cit double, i94res double, i94port string,
    arrdate double, i94mode double, i94addr string, depdate double, i94bir double, i94visa double,
    count double, dtadfile string, visapost string, occup string, entdepa string, entdepd string,
    entdepu string, matflag string, biryear double, dtaddto string, gender string, insnum string,
    airline string, admnum double, fltno string, visatype string
"""

DEMOGRAPHICS = """
    City string, State string, `Median Age` double, `Male Population` int, `Female Population` int,
    `Total Population` int, `Number of Veterans` int, `Foreign-born` int,
    `Average Household Size` double, `State Code` string, Race string, Count int
"""

TEMPERATURE = """
    dt date, AverageTemperature double, AverageTemperatureUncertainty double, City string,
    Country string, Latitude string, Longitude string
"""

MAPPING = "code int, Name string"

# Keys of the sources and of the tables built from them.
ARRIVALS_KEY = ["cicid"]
DEMOGRAPHICS_KEY = ["City", "State", "State Code", "Race"]
TEMPERATURE_KEY = ["dt", "City", "Country"]

# Columns that are almost always empty, columns that must be
# filled, and columns whose values exceed 32 bits.
SPARSE_ARRIVALS = ["occup", "entdepu", "insnum"]
REQUIRED_DEMOGRAPHICS = [
    "Male Population",
    "Female Population",
    "Number of Veterans",
    "Foreign-born",
    "Average Household Size",
]
REQUIRED_TEMPERATURE = ["AverageTemperature"]
WIDE_ARRIVALS = ["cicid", "admnum"]

# Names in the finished tables.
FACT_NAMES = {"cicid": "record_id", "i94res": "country_residence_code", "i94addr": "state_code"}
DEMOGRAPHICS_NAMES = {
    "Median Age": "median_age",
    "Male Population": "male_population",
    "Female Population": "female_population",
    "Total Population": "total_population",
    "Number of Veterans": "number_of_veterans",
    "Foreign-born": "foreign_born",
    "Average Household Size": "average_household_size",
    "State Code": "state_code",
}
CALENDAR_PARTITIONS = ["arrival_year", "arrival_month", "arrival_week"]

COMMENTS = {
    "visatype": {
        "visatype": "class of admission; null stands for rows without one",
        "visa_type_key": "surrogate key, dense from 0 in order of visatype",
    },
    "immigration_time": {
        "arrdate": "date of arrival, the key of this table",
        "arrival_day": "day of the month",
        "arrival_week": "ISO week; early January may belong to week 52 or 53",
        "arrival_month": "month, 1 to 12",
        "arrival_year": "calendar year, not ISO year",
        "arrival_weekday": "day of the week, 1 is Sunday",
        "id": "surrogate key, dense from 0 in order of arrdate",
    },
    "country": {
        "country_code": "code of the country of residence, the key of this table",
        "country_name": "name for the code; null when the mapping lacks it",
        "average_temperature": "mean of all readings of the country, in degrees Celsius",
    },
    "demographics": {
        "City": "city",
        "State": "state of the city",
        "median_age": "median age of the inhabitants",
        "male_population": "male inhabitants",
        "female_population": "female inhabitants",
        "total_population": "all inhabitants",
        "number_of_veterans": "veterans among the inhabitants",
        "foreign_born": "inhabitants born abroad",
        "average_household_size": "persons per household",
        "state_code": "two-letter code of the state",
        "Race": "group that Count refers to",
        "Count": "inhabitants of that group",
        "id": "surrogate key, dense from 0 in order of city, state, state code and race",
    },
    "immigration_fact": {
        "record_id": "number of the arrival record, the key of this table",
        "i94yr": "year of the record",
        "i94mon": "month of the record",
        "i94cit": "code of the country of birth",
        "country_residence_code": "code of the country of residence; joins country.country_code",
        "i94port": "port of entry",
        "arrdate": "date of arrival; joins immigration_time.arrdate",
        "i94mode": "way of travel: 1 air, 2 sea, 3 land, 9 not reported",
        "state_code": "state of the address; joins demographics.state_code, many rows there",
        "depdate": "date of departure",
        "i94bir": "age of the traveller in years",
        "i94visa": "purpose of the visit as a code",
        "count": "1 for every record",
        "dtadfile": "date the record was added, as text",
        "visapost": "post that issued the visa",
        "entdepa": "flag set at arrival",
        "entdepd": "flag set at departure",
        "matflag": "whether arrival and departure were matched",
        "biryear": "year of birth",
        "dtaddto": "date until which the stay is allowed, as text",
        "gender": "gender as recorded",
        "airline": "airline of arrival",
        "admnum": "admission number, 64-bit",
        "fltno": "flight of arrival",
        "visa_type_key": "joins visatype.visa_type_key; null without a visa type",
    },
}
